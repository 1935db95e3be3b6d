"""One query for each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import oracles
from partwise.llm.conversations import repair_conversations
from partwise.llm.decontaminate import find_contamination
from partwise.llm.html_text import extract_text
from partwise.llm.language_id import fit, identify
from partwise.llm.merkle import merkle_manifest
from partwise.llm.near_dedup import near_duplicates
from partwise.llm.nearest import nearest_neighbours
from partwise.llm.packing import pack_documents
from partwise.llm.pii import pseudonymise
from partwise.llm.sharding import shard_records
from partwise.llm.simhash import simhash_duplicates
from partwise.llm.tables import read
from partwise.llm.token_counts import count_tokens
from partwise.llm.url_filters import filter_urls

# Stands for a secret that a user would pass in.
PII_KEY = "an example key"
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=80)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), vocabulary())


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PII_KEY)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read(spark, sf_dir, "documents"), vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(read(spark, sf_dir, "pages"), rules)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    crc = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return shard_records(crc, 8, carry=["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    return conversations.withColumn("how", F.crc32(key.cast("binary")) % 20).where("how != 0").select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("how") == 3, 2).otherwise(1))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    repair = repair_conversations(damaged(conversations))
    digests = repair.digests().withColumnRenamed("conv", "d_conv")
    every = conversations.select("conv_id").distinct()
    found = every.join(repair.report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left"
    )
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower).otherwise(F.col("text"))
    return merkle_manifest(docs, claimed={"text": tampered}).drop("path")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(read(spark, sf_dir, "documents"), words=3, radius=3, seed=42)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_near_dedup": op2_near_dedup,
    "op3_nearest": op3_nearest,
    "op4_decontamination": op4_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_html_text": op6_html_text,
    "op7_pii": op7_pii,
    "op8_packing": op8_packing,
    "op9_url_filters": op9_url_filters,
    "op10_sharding": op10_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash": op13_simhash,
}

ORACLE: dict[str, str] = {
    "op9_url_filters": """
        with cut as (
            select page_id, row_number() over () as n,
                case when position('://' in coalesce(url, '')) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
            from pages
        ), u as (
            select page_id, n,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
            from cut
        ), rules(r_host, r_path, r_verdict) as (
            values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        ), best as (
            select n, arg_max(struct_pack(rule := r_host || r_path, verdict := r_verdict), length(r_host || r_path)) as b
            from u join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
            group by n
        )
        select page_id, host, path, b.rule as rule, coalesce(b.verdict, 'allow') as verdict
        from u left join best using (n)
    """,
    "op11_conversation_repair": oracles.conversations(),
    "op12_merkle_manifest": oracles.merkle(),
}
