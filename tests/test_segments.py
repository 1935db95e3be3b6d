"""Index and segments: what is opened, what is written, what is collected."""

import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from partwise.plans import verify
from partwise.plans.cancel import run_cancel
from partwise.plans.download import run_download
from partwise.plans.store import Store
from partwise.plans.transfer import run_copy, run_transfer
from partwise.sources import progress as journal
from partwise.sources import segments
from partwise.sources.files import partial_path, read_range
from partwise.sources.sinks import parts_index, read_parts, write_parts

P = 1024
SIZES = [0, 1, P, 2 * P + 7, 40 * P, 100 * P + 3]
REQUEST = "object_id bigint, src_url string, dst_url string, exists string, resume_mode string, part_size bigint, key_id string, location string"
DOWNLOAD = "object_id bigint, src_url string, dst_url string, file_exists string, download_exists string, part_size bigint, key_id string"
KEYS = [("kA", "-0123456789012345678901234567890", True), ("kB", "skdjfh9q4rusidfjs9fjsdr9vkfdh833", False)]


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame(KEYS, "key_id string, key_text string, is_master boolean")


@pytest.fixture(scope="module")
def contents():
    rng = random.Random(3)
    return {size: rng.randbytes(size) for size in SIZES}


@pytest.fixture()
def folder(tmp_path, contents):
    (tmp_path / "src").mkdir()
    for size, data in contents.items():
        (tmp_path / "src" / f"{size}.bin").write_bytes(data)
    return str(tmp_path / "src")


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).create()


def upload(store, folder, keys=None, key=None, dst="s3://b/", exists=None, part_size=P, sizes=SIZES):
    rows = [(s, f"{folder}/{s}.bin", dst, exists, None, part_size, key, "") for s in sizes]
    done = run_transfer(store, store.spark.createDataFrame(rows, REQUEST), keys).collect()
    assert {r["error_class"] for r in done} == {None}


def copy(store, src, dst, keys=None, src_key=None, dst_key=None, part_size=P, waves=1):
    rows = [(s, f"{src}{s}.bin", dst, None, None, part_size, dst_key, "") for s in SIZES]
    asked = store.spark.createDataFrame(rows, REQUEST).withColumn("src_key_id", F.lit(src_key).cast("string"))
    done = run_copy(store, asked, keys, keys, waves=waves).collect()
    assert {r["error_class"] for r in done} == {None}


def digests(store, bucket, keys=None, key=None):
    asked = store.spark.createDataFrame([(s, f"s3://{bucket}/{s}.bin", key) for s in SIZES], "object_id bigint, src_url string, key_id string")
    return {r["object_id"]: r["digest"] for r in verify.run_verify(store, asked, "md5", keys).collect()}


def md5s(contents):
    return {k: hashlib.md5(v).hexdigest() for k, v in contents.items()}


def on_disk(store):
    folder = store.path("segments")
    return {f: os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder)}


@pytest.fixture()
def opened(tmp_path, monkeypatch):
    """Ranges read from segments, as tasks log them: a list of byte counts."""
    log = str(tmp_path / "opened.log")

    def logged(f, start, end, *more):
        with open(log, "a") as out:
            out.write(f"{end - start}\n")
        yield from read_range(f, start, end, *more)

    monkeypatch.setattr(segments, "read_range", logged)

    def counts():
        if not os.path.exists(log):
            return []
        with open(log) as f:
            found = [int(line) for line in f]
        os.remove(log)
        return found

    return counts


@pytest.mark.parametrize("part_size", [P, 700, 3000])
def test_waves_of_a_download_open_each_byte_once(spark, store, folder, contents, opened, tmp_path, part_size):
    upload(store, folder)
    assert opened() == []
    out = tmp_path / "out"
    rows = [(s, f"s3://b/{s}.bin", f"{out}/{s}.bin", None, None, part_size, None) for s in SIZES]
    done = run_download(store, spark.createDataFrame(rows, DOWNLOAD), str(tmp_path / "journal"), waves=4).collect()
    assert {r["error_class"] for r in done} == {None}
    assert {r["object_id"]: r["n_fetched"] for r in done} == {s: -(-s // part_size) for s in SIZES}
    assert sum(opened()) == sum(SIZES)
    assert {int(f.stem): f.read_bytes() for f in out.iterdir()} == contents


def test_resumed_download_opens_what_is_missing(spark, store, folder, contents, opened, tmp_path):
    upload(store, folder)
    size, out, table = 40 * P, tmp_path / "out", str(tmp_path / "journal")
    etag = store.objects().filter(F.col("key") == f"{size}.bin").first()["etag"]
    out.mkdir()
    with open(partial_path(f"{out}/{size}.bin"), "wb") as f:
        f.write(contents[size][: 25 * P])
    journal.create_journal(spark, table)
    rows = [(size, P, etag, i, hashlib.md5(contents[size][i * P : (i + 1) * P]).hexdigest()) for i in range(25)]
    journal.journal_progress(spark.createDataFrame(rows, "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string"), table)
    asked = spark.createDataFrame([(size, f"s3://b/{size}.bin", f"{out}/{size}.bin", None, "resume", P, None)], DOWNLOAD)
    done = run_download(store, asked, table, waves=2).first()
    assert (done["action"], done["n_kept"], done["n_fetched"]) == ("LOAD", 25, 15)
    assert opened() == [P] * 15
    assert (out / f"{size}.bin").read_bytes() == contents[size]


def test_copies_by_reference(spark, store, folder, contents, opened, keys):
    """Equal key and part size: no byte is opened or written, over any number of waves, also of copies of copies."""
    upload(store, folder, keys, "kB")
    before = on_disk(store)
    copy(store, "s3://b/", "s3://c/", keys, "kB", "kB", waves=3)
    copy(store, "s3://c/", "s3://d/", keys, "kB", "kB")
    assert opened() == [] and on_disk(store) == before
    assert digests(store, "d", keys, "kB") == md5s(contents)
    etags = {}
    for r in store.objects().collect():
        etags.setdefault(r["key"], set()).add(r["etag"])
    assert all(len(e) == 1 for e in etags.values())
    # Another key, one derived from the name, or other borders: the bytes are written anew.
    opened()
    copy(store, "s3://c/", "s3://e/", keys, "kB", None)
    assert sum(opened()) == sum(SIZES) + 28 * store.parts_of(store.objects().filter("bucket = 'c'")).count()
    assert digests(store, "e") == md5s(contents)
    copy(store, "s3://e/", "s3://f/", None, None, None, part_size=1500, waves=2)
    assert digests(store, "f") == md5s(contents)
    copy(store, "s3://b/", "s3://g/", keys, "kB", "kA")
    assert digests(store, "g", keys, "kA") == md5s(contents)
    assert len(on_disk(store)) > len(before)


def test_collection(spark, store, folder, contents, keys):
    upload(store, folder, keys, "kB")
    copy(store, "s3://b/", "s3://c/", keys, "kB", "kB")
    assert store.reclaim().first().asDict() == {
        "segments_deleted": 0, "segments_rewritten": 0, "bytes_freed": 0, "bytes_moved": 0, "bytes_live": sum(on_disk(store).values())}
    # Overwritten, but the copies still name the bytes.
    upload(store, folder, keys, "kB", exists="overwrite", part_size=2 * P)
    assert store.reclaim().first()["bytes_freed"] == 0
    assert digests(store, "c", keys, "kB") == digests(store, "b", keys, "kB") == md5s(contents)
    # The copies go as well, but for one object.
    first = store.index().filter(F.col("upload_id").isin([r["upload_id"] for r in store.objects().filter("bucket = 'c' and size <> 1024").collect()]))
    dead = first.agg(F.sum("stored")).first()[0]
    upload(store, folder, keys, "kB", dst="s3://c/", exists="overwrite", part_size=4 * P, sizes=[s for s in SIZES if s != P])
    held, parts = sum(on_disk(store).values()), store.stored_parts().count()
    report = store.reclaim(least_live=1.0).first()
    assert report["bytes_freed"] == dead and sum(on_disk(store).values()) == held - dead == report["bytes_live"]
    assert store.stored_parts().count() < parts
    assert digests(store, "c", keys, "kB") == digests(store, "b", keys, "kB") == md5s(contents)
    assert store.reclaim(least_live=1.0).first()["bytes_freed"] == 0


def test_collection_of_cancelled_uploads_and_orphans(spark, store, folder, contents):
    upload(store, folder)
    part = store.table("parts").filter("n is null") if "n" in store.table("parts").columns else store.table("parts")
    store.append("parts", part.filter("part_num < 3").withColumn("upload_id", F.lit("given-up")))
    begun = spark.createDataFrame([("given-up", "b", "odd.bin", P), ("other", "b", "kept.bin", P)], "upload_id string, bucket string, key string, part_size bigint")
    store.append("uploads", begun.withColumn("initiated", F.current_timestamp()))
    store.append("parts", part.filter("part_num = 0").withColumn("upload_id", F.lit("other")))
    assert store.reclaim(1.0).first()["bytes_freed"] == 0
    assert run_cancel(store, spark.createDataFrame([("s3://b/odd.bin",)], "dst_url string"))[0].count() == 1
    dead = store.index().filter("upload_id = 'given-up'").agg(F.sum("stored")).first()[0]
    # What a killed task left is young: it stays until it is old.
    with open(f"{store.path('segments')}/{'0' * 32}.segment", "wb") as f:
        f.write(b"?" * 500)
    report = store.reclaim(1.0).first()
    assert (report["bytes_freed"], "0" * 32 + ".segment" in on_disk(store)) == (dead, True)
    assert store.reclaim(1.0, orphan_age=0).first()["bytes_freed"] == 500
    assert {r["upload_id"] for r in store.index().select("upload_id").collect()} >= {"other"}
    assert store.index().filter("upload_id = 'given-up'").count() == 0
    assert digests(store, "b") == md5s(contents)


def test_collection_goes_on_after_a_crash(spark, store, folder, contents, monkeypatch):
    """The new index is whole, the files are not deleted yet; and a new index that never became whole."""
    import partwise.plans.store as module

    upload(store, folder)
    upload(store, folder, exists="overwrite", part_size=2 * P)
    held = sum(on_disk(store).values())

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(module, "delete_segments", lost)
    with pytest.raises(OSError, match="driver lost"):
        store.reclaim(1.0)
    monkeypatch.undo()
    assert digests(store, "b") == md5s(contents)
    broken = store.index_path(99)
    os.makedirs(broken)
    with open(f"{broken}/part-0.parquet", "wb") as f:
        f.write(b"half")
    assert store.reclaim(1.0, orphan_age=0).first()["segments_deleted"] > 0
    assert sum(on_disk(store).values()) < held and digests(store, "b") == md5s(contents)


def cells(spark, contents, part_size=P):
    rows = [(s, i, i * part_size, bytearray(data[i * part_size : (i + 1) * part_size])) for s, data in contents.items() for i in range(max(1, -(-len(data) // part_size)))]
    return spark.createDataFrame(rows, "object_id bigint, part_num bigint, start bigint, bytes binary")


def test_parts_written_again_are_there_once(spark, tmp_path, contents):
    out, parts = str(tmp_path / "table"), cells(spark, contents)
    broken = parts.withColumn("bytes", F.when(F.col("start") < 90 * P, F.col("bytes")).otherwise(F.raise_error(F.lit("disk lost")).cast("binary")))
    with pytest.raises(Exception, match="disk lost"):
        write_parts(broken, out)
    assert os.listdir(f"{out}/segments") and not os.path.exists(f"{out}/index")
    write_parts(parts.filter("object_id > 1000"), out)
    write_parts(parts, out)
    write_parts(parts.unionByName(parts), out)
    found = read_parts(spark, out).collect()
    assert len(found) == parts.count()
    assert {(r["object_id"], r["part_num"]): bytes(r["bytes"]) for r in found} == {(r["object_id"], r["part_num"]): bytes(r["bytes"]) for r in parts.collect()}
    assert parts_index(spark, out).filter("part_num = 5").count() == 2


def exchanges(df):
    """What each exchange of the plan carries."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)


def test_no_exchange_carries_bytes(spark, store, folder, keys, tmp_path, monkeypatch):
    upload(store, folder, keys, "kB")
    asked = spark.createDataFrame([(s, f"s3://b/{s}.bin", "kB") for s in SIZES], "object_id bigint, src_url string, key_id string")
    plans = [verify.run_verify(store, asked, "sha256", keys)]
    import partwise.plans.download as download

    seen = []
    monkeypatch.setattr(download, "write_file_parts", lambda rows: (seen.append(rows), segments.write_file_parts(rows))[1])
    rows = [(s, f"s3://b/{s}.bin", f"{tmp_path}/out/{s}.bin", None, None, 700, "kB") for s in SIZES]
    run_download(store, spark.createDataFrame(rows, DOWNLOAD), str(tmp_path / "journal"), keys).collect()
    carried = [c for df in plans + seen for c in exchanges(df)]
    assert carried and not [c for c in carried if "bytes#" in c]


def test_cells_joined_in_order(spark):
    data = {(k, p): os.urandom(n) for k, p, n in ((1, 0, 0), (1, 1, 10), (2, 0, 25), (2, 1, 30), (3, 0, 7))}
    rows = []
    for (k, p), whole in data.items():
        for low in range(0, max(1, len(whole)), 4):
            rows.append((k, p, 100 * p + low, None if (k, p) == (3, 0) and low == 4 else bytearray(whole[low : low + 4])))
    df = spark.createDataFrame(rows, "k bigint, part_num bigint, offset bigint, bytes binary").coalesce(1).sortWithinPartitions("k", "part_num", "offset")
    found = {}
    for r in segments.join_cells(df, "k", cell_bytes=10).collect():
        found.setdefault((r["k"], r["part_num"]), []).append(r)
    for slot, whole in data.items():
        cells = found[slot]
        if slot == (3, 0):
            assert len(cells) == 1 and cells[0]["bytes"] is None and cells[0]["md5"] is None
            continue
        assert [bytes(c["bytes"]) for c in cells] == [whole[i : i + 10] for i in range(0, max(1, len(whole)), 10)]
        assert [c["offset"] for c in cells] == [100 * slot[1] + i for i in range(0, max(1, len(whole)), 10)]
        assert [c["md5"] for c in cells] == [None] * (len(cells) - 1) + [hashlib.md5(whole).hexdigest()]
