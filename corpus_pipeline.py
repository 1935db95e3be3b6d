"""A corpus from documents to training sequences: language, near copies, benchmarks, personal data, packing.

Each stage is (name, function of (spark, docs, sf_dir)); its rows are written as Parquet and read again
as the next one's docs. All but the last keep the columns of documents. Null texts have no language, so
the first stage drops them; ids may be null or repeated. Stages set the session's rows for each Arrow batch to
BATCH_ROWS, where it is more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm.decontaminate import find_contamination
from partwise.llm.language_id import fit, with_language
from partwise.llm.near_dedup import near_duplicates
from partwise.llm.packing import pack_documents
from partwise.llm.pii import pseudonymise
from partwise.llm.queries import PII_KEY, vocabulary
from partwise.llm.tables import materialise, read


# Rows of a batch that goes to a Python worker: texts are long, and a batch is held on both sides.
BATCH_ROWS = 1000


def _in_small_batches(spark: SparkSession) -> None:
    """For the session, as a stage runs when its rows are written."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _wrapped(docs: DataFrame) -> DataFrame:
    """(row: all other columns of docs, doc_id, text): whatever docs holds, no name clashes with what a stage adds."""
    others = [_column(c).alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(F.struct(*others).alias("row"), "doc_id", "text")


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _unwrapped(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **changed}
    return rows.select(*[own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels of docs teach; those without letters go, and those whose
    two nearest codewords are as good as equally near. Without any label nothing can be told, and all stay."""
    _in_small_batches(spark)
    model = fit(docs.select("text", "lang"))
    if model is None:
        return docs
    said = with_language(_wrapped(docs), model, least_margin=0.01)
    return _unwrapped(said.where("lang_pred != 'und' and not ambiguous"), docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id; of rows with equal id and text one."""
    _in_small_batches(spark)
    judged = near_duplicates(docs.select("doc_id", "text"))
    gone = judged.where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    hashed = _wrapped(docs).withColumn("hash", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")))
    left = hashed.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left_anti")
    return _unwrapped(left.dropDuplicates(["doc_id", "hash"]), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Equal texts are judged alike, whatever their ids."""
    _in_small_batches(spark)
    hashed = _wrapped(docs).withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = find_contamination(hashed.select("hash", "text"), read(spark, sf_dir, "benchmark"), id_col="hash")
    return _unwrapped(hashed.join(found.select("hash").distinct(), "hash", "left_anti"), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms, and n_chars by the new text's."""
    changed = pseudonymise(_wrapped(docs), PII_KEY)
    return _unwrapped(changed, docs, n_chars=F.length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in full sequences."""
    _in_small_batches(spark)
    return pack_documents(docs.select("doc_id", "text"), vocabulary())


STAGES = [
    ("language ID", language),
    ("near-duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("packing", packed),
]

# Language models, sketches, latent spaces and packing are no SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
