"""State of streams: bitmaps that go when an upload is complete, and a listing that is read once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from partwise.streaming import listing
from partwise.streaming.listing import ListingReader, new_objects
from partwise.streaming.progress import read_state, stream_completion, stream_progress, write_changes

SCHEMA = "upload_id string, part_num bigint, size bigint, recorded_at timestamp"


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def arrive(spark, folder, rows):
    df = spark.createDataFrame(rows, "upload_id string, part_num bigint, size bigint").withColumn("recorded_at", F.current_timestamp())
    df.coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def state_of(spark, checkpoint, name):
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def test_completed_uploads_leave_the_state(spark, tmp_path):
    """9,000 parts in three blocks over several batches with repeats; late repeats complete nothing."""
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    plans = spark.createDataFrame([("large", 9000), ("short", 3), ("lacks", 5), (None, 2)], "upload_id string, n_parts bigint")
    numbers = list(range(9000))
    random.Random(1).shuffle(numbers)

    def run():
        drain(write_changes(stream_completion(stream(spark, folder), plans), out, ckpt))
        return sorted(r["upload_id"] for r in spark.read.schema("upload_id string, n_parts bigint").parquet(out + "/*").collect())

    arrive(spark, folder, [("large", n, 1) for n in numbers[:6000]] + [("lacks", n, 1) for n in (0, 1, 2, 4, 4, 4)] + [("short", 1, 1)])
    assert run() == []
    assert {r["key"]["upload_id"] for r in state_of(spark, ckpt, "blocks").select("key").distinct().collect()} == {"large", "lacks", "short"}
    arrive(spark, folder, [("large", n, 1) for n in numbers[5000:]] + [("short", n, 1) for n in (0, 2, 3, -1, 99)])
    assert run() == ["large", "short"]
    held = state_of(spark, ckpt, "blocks").select("key").collect()
    assert [r["key"]["upload_id"] for r in held] == ["lacks"]
    # Every part once more, and the one that lacks never comes.
    arrive(spark, folder, [("large", n, 1) for n in numbers] + [("short", n, 1) for n in range(3)] + [("lacks", n, 1) for n in (0, 1, 2, 4)] * 3)
    assert run() == ["large", "short"]
    assert state_of(spark, ckpt, "blocks").count() == 1
    arrive(spark, folder, [("lacks", 3, 1)])
    assert run() == ["lacks", "large", "short"]
    assert state_of(spark, ckpt, "blocks").count() == 0


def test_progress_counts_each_part_once_over_blocks(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rng = random.Random(2)
    seen = set()
    for _ in range(3):
        some = [rng.randrange(20_000) for _ in range(5000)]
        seen |= set(some)
        arrive(spark, folder, [("u", n, 10 + n % 3) for n in some] + [("v", 7, 5)])
    drain(write_changes(stream_progress(stream(spark, folder)), out, ckpt))
    found = {r["upload_id"]: (r["n_done"], r["bytes_done"]) for r in read_state(spark, out, "upload_id string, n_done bigint, bytes_done bigint").collect()}
    assert found == {"u": (len(seen), sum(10 + n % 3 for n in seen)), "v": (1, 5)}


def listed(reader, start, end):
    return [row for part in reader.partitions(start, end) for batch in reader.read(part) for row in batch.to_pylist()]


@pytest.fixture()
def settled(monkeypatch):
    """Every folder is old enough to be told unchanged by its time."""
    monkeypatch.setattr(listing, "SETTLED_NS", -1)


def test_batches_list_what_is_new(tmp_path, monkeypatch, settled):
    """Ten batches: unchanged folders are not listed, and each file is given once, empty ones too."""
    base, log = tmp_path / "in", str(tmp_path / "log")
    for i in range(20):
        (base / f"d{i}").mkdir(parents=True)
        (base / f"d{i}" / "old").write_bytes(b"x" * i)
    calls, real = [], os.scandir
    monkeypatch.setattr(listing.os, "scandir", lambda path: (calls.append(path), real(path))[1])
    reader = ListingReader(str(base), log)
    end = reader.latestOffset()
    assert len(listed(reader, reader.initialOffset(), end)) == 20 and len(calls) == 21
    for i in range(10):
        calls.clear()
        (base / f"d{i}" / f"new{i}").write_bytes(b"")
        start, end = end, reader.latestOffset()
        assert calls == [str(base / f"d{i}")]
        assert [(r["url"], r["size"]) for r in listed(reader, start, end)] == [(str(base / f"d{i}" / f"new{i}"), 0)]
    assert reader.latestOffset() == end
    # Another reader of the same listing gives the same between the same positions, and nothing twice.
    again = ListingReader(str(base), log)
    assert again.latestOffset() == end == {"position": 30}
    assert listed(again, {"position": 3}, {"position": 27}) == listed(reader, {"position": 3}, {"position": 27})


def test_slices_of_a_listing(tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "SLICE", 4)
    base = tmp_path / "in"
    base.mkdir()
    reader, ends = ListingReader(str(base), str(tmp_path / "log")), [{"position": 0}]
    for n in (7, 0, 1, 9):
        for i in range(n):
            (base / f"{len(ends)}-{i}").write_bytes(b"1")
        (base / ".x.partial").write_bytes(b"partial")
        ends.append(reader.latestOffset())
    assert [e["position"] for e in ends] == [0, 7, 7, 8, 17]
    rows = listed(reader, ends[0], ends[-1])
    assert len({r["url"] for r in rows}) == len(rows) == 17
    assert [r["url"] for r in listed(reader, ends[1], ends[3])] == [str(base / "3-0")]


def test_missing_folder_and_restart(spark, tmp_path):
    """A folder that comes later; each run goes on where the last one ended."""
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        df = new_objects(spark, str(folder), str(tmp_path / "ckpt" / "listing")).selectExpr("url", "size")
        drain(df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ckpt")))
        return sorted((r["url"].rsplit("/", 1)[1], r["size"]) for r in spark.read.schema("url string, size bigint").parquet(out).collect())

    folder.mkdir()
    (folder / "a").write_bytes(b"aa")
    (folder / "b").write_bytes(b"")
    assert run() == [("a", 2), ("b", 0)]
    assert run() == [("a", 2), ("b", 0)]
    (folder / "sub").mkdir()
    (folder / "sub" / "c").write_bytes(b"c")
    assert run() == [("a", 2), ("b", 0), ("c", 1)]
