"""Cutting, counting and digesting, at the sizes where rules change."""

import hashlib
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from partwise.limits import BLOCK_PARTS
from partwise.operators import integrity, parts, uploads
from partwise.sources.sinks import assemble_objects

P = 1024
SIZES = [0, 1, P - 1, P, P + 1, 2 * P, 5 * P // 2]


@pytest.fixture(scope="module")
def contents():
    rng = random.Random(7)
    return {size: rng.randbytes(size) for size in SIZES}


@pytest.fixture(scope="module")
def objects(spark, contents):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in contents.items()], "object_id bigint, content binary")


@pytest.mark.parametrize("mode", [parts.UPLOAD, parts.DOWNLOAD])
def test_plan(spark, mode):
    df = spark.createDataFrame([(s, s) for s in SIZES], "object_id bigint, size bigint")
    planned = {}
    for r in parts.plan_parts(df, P, mode).collect():
        planned.setdefault(r["object_id"], []).append((r["part_num"], r["start"], r["end"]))
    for size in SIZES:
        n = math.ceil(size / P) or (1 if mode == parts.UPLOAD else 0)
        assert sorted(planned.get(size, [])) == [(i, i * P, min((i + 1) * P, size)) for i in range(n)]


def test_plan_over_blocks(spark):
    n = 2 * BLOCK_PARTS + 5
    df = spark.createDataFrame([(1, n * 3 - 1, 3)], "object_id bigint, size bigint, p bigint")
    row = parts.plan_parts(df, F.col("p")).agg(
        F.count("*"), F.countDistinct("part_num"), F.max("part_num"), F.sum(F.col("end") - F.col("start")), F.max("end")
    ).first()
    assert tuple(row) == (n, n, n - 1, n * 3 - 1, n * 3 - 1)


def test_plan_near_the_last_long(spark):
    size = 2**63 - 1
    df = spark.createDataFrame([(1, size)], "object_id bigint, size bigint")
    last = parts.plan_parts(df, 2**60).orderBy(F.desc("part_num")).first()
    assert (last["part_num"], last["end"]) == (7, size)


def test_split_and_assemble(objects, contents):
    cut = parts.split_parts(objects, P)
    for r in cut.collect():
        assert bytes(r["bytes"]) == contents[r["object_id"]][r["start"] : r["end"]]
    whole = {r["object_id"]: bytes(r["content"]) for r in assemble_objects(cut).collect()}
    assert whole == contents
    for chunk in (1000, P, 3 * P):
        joined = {}
        for r in assemble_objects(cut, chunk).orderBy("object_id", "chunk_no").collect():
            assert r["offset"] == r["chunk_no"] * chunk == len(joined.get(r["object_id"], b"")) and len(r["content"]) <= chunk
            joined[r["object_id"]] = joined.get(r["object_id"], b"") + bytes(r["content"])
        assert joined == contents


@pytest.mark.parametrize("size", [1, 300, P, 1500, 10_000])
def test_resplit(objects, contents, size):
    cut = parts.resplit_parts(parts.split_parts(objects, P), size)
    assert {r["object_id"]: bytes(r["content"]) for r in assemble_objects(cut).collect()} == contents
    assert cut.filter(F.col("start") != F.col("part_num") * size).count() == 0


def test_digests(objects, contents):
    for size in (P, 300):
        cut = parts.split_parts(objects, size)
        for algo in ("md5", "sha1", "sha512", "sha3_256", "crc32"):
            import zlib

            wanted = {k: f"{zlib.crc32(v):08x}" if algo == "crc32" else hashlib.new(algo, v).hexdigest() for k, v in contents.items()}
            assert {r[0]: r[1] for r in integrity.object_digests(cut, algo).collect()} == wanted
            if size == P:
                assert {r[0]: r[1] for r in integrity.object_digests(objects, algo).collect()} == wanted
    for algo in ("md17", "shake_128"):
        with pytest.raises(integrity.InvalidChecksumAlgorithm):
            integrity.object_digests(objects, algo)


def test_etags_over_blocks(spark):
    counts = {1: 1, 2: BLOCK_PARTS, 3: BLOCK_PARTS + 1, 4: 3 * BLOCK_PARTS}
    md5 = F.md5(F.concat_ws("-", "object_id", "part_num").cast("binary"))
    df = spark.createDataFrame(list(counts.items()), "object_id bigint, n bigint")
    rows = df.select("object_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("part_num"))
    found = integrity.composite_etags(rows.select("*", F.lit(2).cast("bigint").alias("size"), md5.alias("md5")))
    for r in found.collect():
        k, n = r["object_id"], counts[r["object_id"]]
        digests = b"".join(hashlib.md5(f"{k}-{i}".encode()).digest() for i in range(n))
        assert (r["etag"], r["size"]) == (f"{hashlib.md5(digests).hexdigest()}-{n}", 2 * n)


def test_entropy(spark):
    values = {1: b"", 2: b"aaaa", 3: bytes(range(256)), 4: os.urandom(5000)}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in values.items()], "object_id bigint, content binary")
    found = {r["object_id"]: r for r in integrity.byte_entropy(df).collect()}
    for k, v in values.items():
        p = [v.count(b) / len(v) for b in set(v)]
        wanted = -sum(x * math.log2(x) for x in p) if v else 0.0
        assert found[k]["size"] == len(v)
        assert found[k]["entropy"] == pytest.approx(wanted, abs=1e-6)
    cut = parts.split_parts(df, 100)
    assert {r["object_id"]: r["entropy"] for r in integrity.byte_entropy(cut).collect()} == {
        k: r["entropy"] for k, r in found.items()
    }


def test_short_part_ends_object(spark):
    rows = [(1, 0, 4), (1, 1, 4), (1, 2, 3), (1, 3, 0), (1, 4, 4), (2, 0, 4), (2, 1, 5), (3, 0, 0), (4, 0, 4)]
    df = spark.createDataFrame(rows, "object_id bigint, part_num bigint, size bigint")
    kept = {tuple(r) for r in parts.stop_at_short_part(df, 4).collect()}
    assert kept == {
        (1, 0, 4, None), (1, 1, 4, None), (1, 2, 3, None), (2, 0, 4, None), (2, 1, 5, "PartTooLong"), (3, 0, 0, None), (4, 0, 4, None),
    }
    assert parts.drop_empty_parts(df).filter("size = 0").collect() == [(3, 0, 0)]


def brute_sanity(part_nums_sizes, p):
    """The rule on sizes, and the strict rule on top of it."""
    sizes = [s for _, s in part_nums_sizes]
    distinct = sorted(set(sizes), reverse=True)
    if len(distinct) == 1:
        s = distinct[0]
        ok = [s == 0 and len(sizes) == 1, s == p, 0 < s < p and len(sizes) == 1].count(True) == 1
    else:
        ok = len(distinct) == 2 and distinct[0] == p and 0 < distinct[1] and sizes.count(distinct[1]) == 1
    numbers = sorted(n for n, _ in part_nums_sizes)
    strict = ok and numbers == list(range(len(numbers)))
    if strict and len(distinct) == 2:
        strict = dict(part_nums_sizes)[numbers[-1]] == distinct[1]
    return ok, strict


def test_sanity_and_guess_brute_force(spark):
    rng = random.Random(3)
    cases = {}
    for i in range(400):
        numbers = rng.sample(range(5), rng.randint(1, 4))
        cases[i] = [(n, rng.choice([0, 3, 10, 10, 10, 12])) for n in numbers]
    rows = [(k, n, s) for k, v in cases.items() for n, s in v]
    df = spark.createDataFrame(rows, "upload_id bigint, part_num bigint, size bigint")
    checked = {r["upload_id"]: (r["ok_reference"], r["ok_strict"]) for r in uploads.sanity_check(df, 10).collect()}
    assert checked == {k: brute_sanity(v, 10) for k, v in cases.items()}
    assert len(set(checked.values())) == 3
    for r in uploads.guess_part_size(df).collect():
        sizes = [s for _, s in cases[r["upload_id"]]]
        distinct = sorted(set(sizes), reverse=True)
        ambiguous = len(distinct) > 2 or (len(distinct) == 2 and sizes.count(distinct[1]) != 1)
        assert (r["part_size"], r["ambiguous"]) == (distinct[0], ambiguous)


def test_capacity(spark):
    df = spark.createDataFrame([(1, 0), (2, 5 * 1024**2 * 10_000), (3, 5 * 1024**2 * 10_000 + 1), (4, 2**60)], "object_id bigint, size bigint")
    rows = {r["object_id"]: r for r in parts.plan_capacity(df, 5 * 1024**2, 40, 40).collect()}
    assert [rows[i]["over_limit"] for i in (1, 2, 3, 4)] == [False, False, True, True]
    assert [rows[i]["min_part_size"] for i in (1, 2, 3, 4)] == [5 * 1024**2, 5 * 1024**2, 5 * 1024**2 + 1, None]
    assert rows[4]["reject_reason"] == "UserError"
    assert rows[1]["buffer_bytes"] == 80 * 5 * 1024**2


def test_prefix_cancel_brute_force(spark):
    rng = random.Random(5)
    words = ["a", "ab", "abc", "b/", "b/c", "b/cd", "ü", "üx", ""]
    pending = [(str(i), rng.choice("xy"), rng.choice(words) + rng.choice(words)) for i in range(200)]
    targets = [("x", w) for w in ("ab", "b/", "ü")] + [("y", "abc"), ("y", "b")]
    p = spark.createDataFrame(pending, "upload_id string, bucket string, key string")
    for goal in (targets, [("x", "")]):
        t = spark.createDataFrame(goal, "bucket string, key string")
        found = sorted(r["upload_id"] for r in uploads.select_cancellable(p, t, True).collect())
        assert found == sorted(u for u, b, k in pending if any(b == tb and k.startswith(tk) for tb, tk in goal))
        exact = sorted(r["upload_id"] for r in uploads.select_cancellable(p, t, False).collect())
        usable = {g for g in goal if g[1] and not g[1].endswith("/")}
        assert exact == sorted(u for u, b, k in pending if (b, k) in usable)


def test_one_key_holds_most_rows(spark):
    """A hot upload, slot and bucket next to ordinary ones."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("upload_id"),
        F.col("id").alias("part_num"),
        F.lit(1).cast("bigint").alias("size"),
        F.lit("e").alias("etag"),
    )
    gone = spark.createDataFrame([(0,), (3,)], "upload_id bigint")
    left = uploads.reclaim_cancelled(rows, gone)
    assert left.count() == 10_000 - 2
    pages = uploads.completion_list(rows).filter("upload_id = 0")
    assert pages.agg(F.sum("n_parts"), F.max("n_parts")).first()[0] == 20_001
    assert pages.agg(F.max("n_parts")).first()[0] <= 10_000
    tries = spark.range(5000).select(
        F.lit(1).alias("upload_id"), F.lit(0).alias("part_num"), F.timestamp_seconds(F.col("id") % 100).alias("recorded_at"),
        F.col("id").alias("event_id"),
    )
    assert uploads.retry_latest(tries).first()["event_id"] == 4999


def test_a_legal_upload_is_one_completion_list(spark):
    rows = spark.range(10_000).select(F.lit(1).alias("upload_id"), F.col("id").alias("part_num"), F.lit("e").alias("etag"))
    assert [r["n_parts"] for r in uploads.completion_list(rows).collect()] == [10_000]


def test_failed_attempts_do_not_count(spark):
    tries = spark.createDataFrame(
        [(1, 0, 1, 10, True), (1, 0, 2, 20, False), (1, 1, 3, 30, False)],
        "upload_id long, part_num long, event_id long, recorded_at long, ok boolean",
    )
    assert [(r["part_num"], r["event_id"]) for r in uploads.retry_latest(tries).collect()] == [(0, 1)]
