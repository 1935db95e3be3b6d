import zlib

from partwise.llm.queries import op10_sharding
from partwise.llm.sharding import shard_records
from partwise.llm.tables import read


def check(rows, found, shards, tolerance):
    by = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r)
    for s, held in by.items():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
        assert 0 <= s < shards
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    for s in range(shards):
        assert abs(sum(r["size"] for r in by.get(s, [])) - total / shards) <= tolerance * total / shards


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = op10_sharding(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows
    )
    largest = max(len(t.encode()) for _, t in rows)
    check(rows, found, 8, 0.1 + 8 * largest / sum(len(t.encode()) for _, t in rows))


def test_hot_text_and_edges(spark):
    rows = [(i, "the same text over and over") for i in range(3000)] + [(5000 + i, f"text number {i} " * (i % 7)) for i in range(6000)]
    rows += [(i, None) for i in range(20)] + [(None, "no id"), (None, "no id"), (7, "x" * 2000), (1, "ab"), (1, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as slot", "2 as range", "'x' as key", "3 as part")
    found = shard_records(docs, 4).collect()
    assert "range" in found[0].asDict() and len(found) == len(rows)
    check(rows, found, 4, 0.06)
    shards = {}
    for r in found:
        shards.setdefault(r["text"], set()).add(r["shard"])
    assert [t for t, s in shards.items() if len(s) > 1 and t != "the same text over and over"] == []
    again = shard_records(docs, 4).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert shard_records(docs.limit(0), 4).count() == 0
    one = shard_records(docs.limit(1), 4).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_repeated_rows_and_very_long_texts(spark):
    rows = [(None, "one row over and over, id and all")] * 4000 + [(i, f"text {i} " * (i % 9)) for i in range(4000)]
    rows += [(9000 + i, chr(97 + i) * 30_000) for i in range(4)] + [(9100, "é" * 1_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id", "text")
    found = shard_records(docs, 4).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in found))) == sorted(map(str, rows))
    for s in range(4):
        held = sorted(r["slot"] for r in found if r["shard"] == s)
        assert held == list(range(len(held)))
    # the long text is nearly all; without it shards are even
    rows = rows[:-1]
    check(rows, shard_records(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect(), 4, 0.12)
    alone = spark.createDataFrame([r for r in rows if r[0] is None], "doc_id long, text string")
    counts = [r["count"] for r in shard_records(alone, 4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) <= 1100  # all are one row, and still spread
