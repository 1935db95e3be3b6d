"""Snapshots of the journal of progress."""

import os
import random

import pytest
from pyspark.sql import functions as F

from partwise.sources import progress as journal

SCHEMA = "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string, recorded_at timestamp, destination string"


def append(spark, table, rows):
    df = spark.createDataFrame(rows, "object_id bigint, part_size bigint, part_num bigint, md5 string, at bigint, destination string")
    df = df.withColumn("etag", F.lit("e")).withColumn("recorded_at", F.timestamp_seconds("at")).drop("at")
    journal._append(df, table)


def slot(o, n, c, at, d=None):
    return (o, 5, n, c * 32, at, d)


def begun(o, at, d=None):
    return (o, 5, -1, "0" * 32, at, d)


def ended(o, at, d=None):
    return (o, None, -1, "0" * 32, at, d)


def seen(spark, table, targets=None):
    if targets is not None:
        targets = spark.createDataFrame(targets, "object_id bigint, destination string")
    found = journal.load_progress(spark, table, targets)
    extra = ["destination"] if "destination" in found.columns else []
    return sorted(tuple(r) for r in found.select("object_id", "part_num", "md5", "part_size", "recorded_at", *extra).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_a_snapshot_changes_nothing_that_counts(spark, tmp_path, seed):
    """Random histories with and without destinations, compacted between their parts, against the whole history."""
    rng = random.Random(seed)
    compacted, plain = str(tmp_path / "c"), str(tmp_path / "p")
    targets = [(o, f"/{'xyz'[i]}") for i, o in enumerate(rng.sample(range(4), 3))]
    at = 0
    for _ in range(3):
        rows = []
        for _ in range(40):
            at += 1
            place = (rng.randrange(4), rng.choice([None, "/x", "/y", "/z"]))
            kind = rng.choice(["slot"] * 8 + ["begun", "ended"])
            if kind == "slot":
                rows.append(slot(place[0], rng.randrange(5), rng.choice("abcdef"), at, place[1]))
            else:
                rows.append({"begun": begun, "ended": ended}[kind](place[0], at, place[1]))
        for table in (compacted, plain):
            append(spark, table, rows)
        journal.compact_progress(spark, compacted)
        assert seen(spark, compacted) == seen(spark, plain)
        assert seen(spark, compacted, targets) == seen(spark, plain, targets)


def test_finished_downloads_are_not_read_again(spark, tmp_path):
    table = str(tmp_path / "j")
    for i in range(3):
        append(spark, table, [slot(o, n, "a", 10 * i, f"/{i}-{o}") for o in range(20) for n in range(10)])
        append(spark, table, [ended(o, 10 * i + 1, f"/{i}-{o}") for o in range(20) if o])
    assert journal.read_journal(spark, table).count() == 3 * 219
    journal.compact_progress(spark, table)
    assert journal.read_journal(spark, table).count() == 30
    append(spark, table, [slot(0, 77, "b", 99, "/0-0")])
    assert journal.read_journal(spark, table).count() == 31 and len(seen(spark, table)) == 31


def test_a_snapshot_that_is_not_whole_does_not_count(spark, tmp_path):
    table = str(tmp_path / "j")
    append(spark, table, [slot(1, 0, "a", 1, "/x")])
    journal.compact_progress(spark, table)
    append(spark, table, [slot(1, 1, "b", 2, "/x")])
    before = seen(spark, table)
    # a run that broke off between the rows and the list of what they cover
    spark.createDataFrame([], SCHEMA).write.parquet(f"{table}/_snapshots/v2/rows")
    assert seen(spark, table) == before
    journal.compact_progress(spark, table)
    assert seen(spark, table) == before
    assert sorted(os.listdir(f"{table}/_snapshots")) == ["v1", "v3"]


def test_readers_and_writers_go_on(spark, tmp_path):
    table = str(tmp_path / "j")
    append(spark, table, [slot(1, n, "a", 1, "/x") for n in range(5)])
    listed = journal.load_progress(spark, table)
    journal.compact_progress(spark, table)
    assert listed.count() == 5  # what was listed before is still there
    append(spark, table, [ended(1, 5, "/x"), slot(2, 0, "c", 5, "/y")])
    journal.compact_progress(spark, table)
    journal.compact_progress(spark, table)
    assert [r[:2] for r in seen(spark, table)] == [(2, 0)]
    assert [f for f in os.listdir(table) if f.endswith(".parquet")] == []


def test_growth_decides(spark, tmp_path):
    table = str(tmp_path / "j")
    journal.create_journal(spark, table)
    append(spark, table, [slot(1, 0, "a", 1, "/x")])
    assert not journal.compact_if_grown(spark, table, 50)
    assert journal.compact_if_grown(spark, table, 1)
    assert not journal.compact_if_grown(spark, table, 1)  # no delta beside it
    assert len(seen(spark, table)) == 1
