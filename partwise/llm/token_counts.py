"""Token counts by a map-side lookup in two tiers.

Tier 1 is a table of frequent pre-tokens and their numbers of tokens, broadcast once: at most
`table_size` entries, chosen by their counts in a sample of at most about `sample_rows` texts. Tier 2
is a cache in each Python worker that encodes what tier 1 lacks. No pre-token of the whole corpus is
shuffled, and the tiers change the speed only, never a count.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.tables import id_and_text, in_slices
from partwise.llm.wordpieces import LONGEST_KEPT, Cache, chunk_cache, shared, tokens


def frequent_lengths(docs: DataFrame, text_col: str, path: str, sample_rows: int, table_size: int) -> tuple[bytes, bytes]:
    """The most frequent pre-tokens of a sample, joined by spaces, and their numbers of tokens."""
    rows = docs.count()
    sample = docs.sample(min(1.0, sample_rows / max(1, rows)), seed=1)

    def count(batches):
        for batch in in_slices(batches, 4096):
            found = Counter(c for raw in batch.column(1).to_pylist() for c in raw.split() if len(c) <= LONGEST_KEPT)
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array(found.keys(), pa.binary()), "n": pa.array(found.values(), pa.int64())}
            )

    pairs = id_and_text(sample.withColumn("_", F.lit(0)), "_", text_col).mapInArrow(count, "chunk binary, n long")
    best = pairs.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(table_size)
    chunks = [bytes(r["chunk"]) for r in best.collect()]
    own = tokens(path)
    lengths = [len(own.ids(c)) for c in chunks] if own.by_chunk else []
    # A chunk has at most as many tokens as bytes, so a byte holds its length.
    return b" ".join(chunks[: len(lengths)]), bytes(lengths)


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    sample_rows: int = 2000,
    table_size: int = 32_768,
    cache_size: int = 250_000,
) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) for each row of docs.

    Null and empty texts have 0 bytes and tokens; ids may be null or repeated, each row gives one row.
    Whole texts are counted, without special tokens around them; special strings in a text count as the
    library's default has it. Other columns of docs are ignored. An empty table gives an empty result.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text_col, path, sample_rows, table_size))
    id_type = docs.schema[id_col].dataType.simpleString()

    run = uuid.uuid4().hex

    def cache() -> Cache:
        chunks, sizes = table.value
        own = tokens(path)
        return chunk_cache(own, len, dict(zip(chunks.split(), sizes)), cache_size)

    def count(batches):
        own = tokens(path)
        length = shared(("lengths", run), cache).__getitem__
        for batch in in_slices(batches):
            raws = batch.column(1).to_pylist()
            n = [sum(map(length, raw.split())) if own.by_chunk else len(own.ids(raw)) for raw in raws]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, raws), pa.int64()), pa.array(n, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    counted = id_and_text(docs, id_col, text_col).mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
