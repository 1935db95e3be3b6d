"""Streams in several batches give what one batch over the same rows gives."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from partwise.plans.store import Store
from partwise.streaming.objects import stream_objects
from partwise.streaming.progress import read_state, stream_completion, stream_progress, write_changes

SCHEMA = "upload_id bigint, part_num bigint, size bigint, recorded_at timestamp"


@pytest.fixture()
def arrivals(spark, tmp_path):
    """12 uploads of 6 parts in 4 files; parts come in any order, some more than once."""
    folder = str(tmp_path / "in")
    rows = spark.range(12 * 6).select(
        (F.col("id") % 12).alias("upload_id"),
        F.floor(F.col("id") / 12).alias("part_num"),
        (F.lit(100) + F.col("id") % 12).alias("size"),
        F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 7).alias("recorded_at"),
        F.pmod(F.hash("id"), F.lit(4)).alias("batch"),
    )
    again = rows.filter("part_num % 2 = 0").withColumn("batch", (F.col("batch") + 1) % 4)
    lost = "not (upload_id = 3 and part_num = 5)"
    for i in range(4):
        rows.unionByName(again).filter(F.col("batch") == i).filter(lost).drop("batch").coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.mark.parametrize("delay", [None, "365 days"])
def test_progress(spark, arrivals, tmp_path, delay):
    out = str(tmp_path / "out")
    drain(write_changes(stream_progress(stream(spark, arrivals), delay), out, str(tmp_path / "ckpt")))
    assert len([d for d in os.listdir(out) if d.startswith("batch_id=")]) > 1
    state = {r["upload_id"]: (r["n_done"], r["bytes_done"]) for r in read_state(spark, out, "upload_id bigint, n_done bigint, bytes_done bigint").collect()}
    assert state == {u: ((5 if u == 3 else 6), (5 if u == 3 else 6) * (100 + u)) for u in range(12)}


def test_completion(spark, arrivals, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    plans = spark.createDataFrame([(u, 4 if u == 3 else 6) for u in range(11)], "upload_id bigint, n_parts bigint")
    drain(write_changes(stream_completion(stream(spark, arrivals), plans), out, ckpt))
    done = [r["upload_id"] for r in spark.read.schema("upload_id bigint, n_parts bigint").parquet(out + "/*").collect()]
    assert sorted(done) == list(range(11))  # each once, upload 11 has no plan
    # Nothing is emitted again by a restart.
    drain(write_changes(stream_completion(stream(spark, arrivals), plans), out, ckpt))
    assert spark.read.schema("upload_id bigint").parquet(out + "/*").count() == 11


def test_objects(spark, tmp_path):
    folder = tmp_path / "incoming"
    (folder / "d").mkdir(parents=True)
    store = Store(spark, str(tmp_path / "store")).create()

    def run():
        drain(stream_objects(store, str(folder), "s3://in/", str(tmp_path / "ckpt"), part_size=1000, max_files=2))

    contents = {f"d/{i}.bin": os.urandom(i * 700) for i in range(4)}
    for name, data in contents.items():
        (folder / name).write_bytes(data)
    run()
    uploads = store.table("uploads").count()
    contents["late.bin"] = b"late"
    (folder / "late.bin").write_bytes(b"late")
    run()
    found = {r["key"]: r for r in store.objects().collect()}
    assert set(found) == set(contents)
    for name, data in contents.items():
        pieces = [data[i : i + 1000] for i in range(0, len(data), 1000)] or [b""]
        joined = b"".join(hashlib.md5(p).digest() for p in pieces)
        assert found[name]["etag"] == f"{hashlib.md5(joined).hexdigest()}-{len(pieces)}"
    assert (uploads, store.table("uploads").count()) == (4, 5)


def test_objects_with_odd_names(spark, tmp_path):
    """Names with # are keys of their own; an empty file is taken along once, whatever `exists` says."""
    folder = tmp_path / "incoming"
    folder.mkdir()
    store = Store(spark, str(tmp_path / "store")).create()

    def run():
        drain(stream_objects(store, str(folder), "s3://in/to/", str(tmp_path / "ckpt"), part_size=1000, exists="overwrite"))

    (folder / "a#1").write_bytes(b"one")
    (folder / "a#2").write_bytes(b"two")
    (folder / "empty").write_bytes(b"")
    run()
    (folder / "later").write_bytes(b"later")
    run()
    assert {r["key"]: r["size"] for r in store.objects().collect()} == {"to/a#1": 3, "to/a#2": 3, "to/empty": 0, "to/later": 5}
    assert store.table("uploads").count() == 4
