"""Files, tables of parts, upload listings, progress."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from partwise.operators.parts import DOWNLOAD, plan_parts
from partwise.plans.verify import verify_files
from partwise.sources import objects
from partwise.sources import progress as journal
from partwise.sources.objects import digest_ranges, fetch_parts, scan_objects
from partwise.sources.part_scan import scan_parts
from partwise.sources.sinks import publish_objects, read_parts, write_parts
from partwise.sources.uploads import read_upload_state

P = 1000


@pytest.fixture()
def folder(tmp_path):
    rng = random.Random(1)
    contents = {}
    for size in (0, 1, P - 1, P, P + 1, 2 * P, 5 * P // 2, 123_456):
        name = f"f {size}%.bin"
        contents[name] = rng.randbytes(size)
        (tmp_path / name).write_bytes(contents[name])
    return str(tmp_path), contents


def listing(spark, path):
    return scan_objects(spark, path, "*.bin").select(F.col("name").alias("object_id"), "url", "size", "etag")


def test_scan(spark, folder):
    path, contents = folder
    listed = listing(spark, path)
    assert {r["object_id"]: r["size"] for r in listed.collect()} == {k: len(v) for k, v in contents.items()}
    etags = {r["object_id"]: r["etag"] for r in listed.collect()}
    name = next(iter(contents))
    os.utime(os.path.join(path, name), (1, 1))
    after = {r["object_id"]: r["etag"] for r in listing(spark, path).collect()}
    assert [k for k in etags if etags[k] != after[k]] == [name]


def test_scan_in_rounds(spark, tmp_path, monkeypatch):
    for i in range(30):
        folder = tmp_path / "abc"[i % 3] / str(i % 5)
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.bin").write_bytes(b"")
        (folder / f".{i}.bin.partial").write_bytes(b"")
    monkeypatch.setattr(objects, "LIST_AT_ONCE", 1)
    assert sorted(int(r["object_id"].split(".")[0]) for r in listing(spark, str(tmp_path)).collect()) == list(range(30))
    assert listing(spark, str(tmp_path / "a" / "0" / "0.bin")).count() == 1


@pytest.mark.parametrize("cell", [300, P, 10**6])
def test_fetch(spark, folder, cell):
    path, contents = folder
    planned = plan_parts(listing(spark, path), P)
    rows = fetch_parts(planned, cell_bytes=cell).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["reject_reason"] is None and len(r["bytes"]) <= cell
        found[r["object_id"]] = found.get(r["object_id"], b"") + bytes(r["bytes"])
        if r["md5"]:
            assert r["md5"] == hashlib.md5(contents[r["object_id"]][r["start"] : r["end"]]).hexdigest()
    assert found == contents
    assert len([r for r in rows if r["md5"]]) == planned.count()


def test_fetch_rejects(spark, folder):
    path, _ = folder
    rows = [(1, f"{path}/f {P}%.bin", 0, 0, P), (2, f"{path}/f {P}%.bin", 1, P, 2 * P), (3, f"{path}/no", 0, 0, 5), (4, f"{path}/f 1%.bin", 0, 0, 5)]
    planned = spark.createDataFrame(rows, "object_id int, url string, part_num bigint, start bigint, end bigint")
    why = {r["object_id"]: (r["reject_reason"], r["bytes"] is None) for r in fetch_parts(planned).collect()}
    assert why == {1: (None, False), 2: ("ShortRead", True), 3: ("SourceMissing", True), 4: ("ShortRead", True)}
    assert {r["object_id"] for r in digest_ranges(planned).filter("md5 is null").collect()} == {2, 3, 4}


@pytest.mark.parametrize("partition_bytes", [P, 10 * P, 10**9])
def test_scan_parts(spark, folder, partition_bytes):
    path, contents = folder
    found = {}
    for r in scan_parts(spark, path, P, partition_bytes=partition_bytes).orderBy("url", "part_num").collect():
        name = os.path.basename(r["url"])
        assert (r["start"], r["end"]) == (r["part_num"] * P, min((r["part_num"] + 1) * P, len(contents[name])))
        found[name] = found.get(name, b"") + bytes(r["bytes"])
    assert found == {k: v for k, v in contents.items() if v}
    assert scan_parts(spark, path, P, with_content=False).filter("bytes is not null").count() == 0


def test_publish_and_verify(spark, folder, tmp_path):
    path, contents = folder
    out = tmp_path / "out"
    fetched = fetch_parts(plan_parts(listing(spark, path), P)).withColumn("dst_path", F.concat(F.lit(f"{out}/d/"), "object_id"))
    # An earlier, longer file of the same name was left half done.
    (out / "d").mkdir(parents=True)
    (out / "d" / f".f {P}%.bin.partial").write_bytes(b"x" * 5000)
    done = publish_objects(fetched)
    assert {(r["published"], r["reject_reason"]) for r in done.collect()} == {(True, None)}
    assert {f.name: f.read_bytes() for f in (out / "d").iterdir()} == contents
    digests = verify_files(done.select("object_id", F.col("dst_path").alias("url"), "size"), "sha1")
    assert {r[0]: r[1] for r in digests.collect()} == {k: hashlib.sha1(v).hexdigest() for k, v in contents.items()}


def test_publish_refuses(spark, tmp_path):
    rows = [(1, 0, 0, 2, b"ab", "x.partial"), (2, 0, 0, 2, b"ab", "y.progress"), (3, 1, 2, 4, b"cd", "hole"), (4, 0, 0, 2, b"ab", "good")]
    parts = spark.createDataFrame([(*r[:4], bytearray(r[4]), f"{tmp_path}/{r[5]}") for r in rows],
                                  "object_id int, part_num bigint, start bigint, end bigint, bytes binary, dst_path string")
    done = {r["object_id"]: (r["published"], r["reject_reason"]) for r in publish_objects(parts).collect()}
    assert done == {1: (False, "InvalidDestinationURL"), 2: (False, "InvalidDestinationURL"), 3: (False, "IncompleteTransfer"), 4: (True, None)}
    assert sorted(f for f in os.listdir(tmp_path) if not f.startswith(".")) == ["good"]


def test_write_parts_appends(spark, tmp_path):
    """New slots are appended; those that are there are not doubled, as they once were."""
    out = str(tmp_path / "t")
    rows = spark.range(20).select(F.col("id").alias("object_id"), F.lit(0).alias("part_num"), F.encode(F.col("id").cast("string"), "UTF-8").alias("bytes"))
    write_parts(rows.filter("object_id < 10"), out)
    write_parts(rows, out)
    table = read_parts(spark, out)
    assert table.count() == 20 and table.filter("bucket_id < 0 or bucket_id > 63").count() == 0
    assert table.filter("decode(bytes, 'UTF-8') <> object_id").count() == 0


def test_upload_state_xml(spark, tmp_path):
    (tmp_path / "u.xml").write_text(
        "<ListMultipartUploadsResult><Upload><Key>k1</Key><UploadId>u1</UploadId><Initiated>2024-01-01T00:00:00Z</Initiated></Upload>"
        "<Upload><Key>k2</Key><UploadId>u2</UploadId></Upload></ListMultipartUploadsResult>"
    )
    (tmp_path / "p.xml").write_text(
        "<ListPartsResult><Bucket>b</Bucket><Key>k1</Key><UploadId>u1</UploadId>"
        "<Part><PartNumber>1</PartNumber><ETag>\"aa\"</ETag><Size>5</Size></Part>"
        "<Part><PartNumber>3</PartNumber><ETag>\"bb\"</ETag><Size>4</Size></Part></ListPartsResult>"
    )
    pending, completed = read_upload_state(spark, str(tmp_path / "u.xml"), str(tmp_path / "p.xml"), "xml")
    assert {(r["upload_id"], r["key"]) for r in pending.collect()} == {("u1", "k1"), ("u2", "k2")}
    assert {tuple(r) for r in completed.collect()} == {("u1", 0, 5, "aa"), ("u1", 2, 4, "bb")}


def test_journal(spark, tmp_path):
    table = str(tmp_path / "j")
    journal.create_journal(spark, table)
    assert journal.load_progress(spark, table).count() == 0

    def rows(*values):
        df = spark.createDataFrame(values, "object_id bigint, part_num bigint, md5 string")
        return df.select("*", F.lit(10).cast("bigint").alias("part_size"), F.lit("e").alias("etag"))

    def slots():
        return {(r["object_id"], r["part_num"]): r["md5"][0] for r in journal.load_progress(spark, table).collect()}

    journal.begin_progress(rows((1, 0, ""), (2, 0, "")), table)
    assert slots() == {(1, -1): "0", (2, -1): "0"}
    journal.journal_progress(rows((1, 0, "a" * 32), (1, 1, "b" * 32), (2, 0, "c" * 32)), table)
    journal.journal_progress(rows((1, 1, "d" * 32)), table)
    assert slots() == {(1, -1): "0", (2, -1): "0", (1, 0): "a", (1, 1): "d", (2, 0): "c"}
    journal.begin_progress(rows((1, 0, "")), table)  # starts again: older slots are void
    assert slots() == {(1, -1): "0", (2, -1): "0", (2, 0): "c"}
    journal.end_progress(rows((2, 0, "")), table)
    assert slots() == {(1, -1): "0"}
    with pytest.raises(Exception, match="32 digits"):
        journal.journal_progress(rows((1, 0, "short")), table)
    left = journal.remove_progress(journal.load_progress(spark, table), spark.createDataFrame([(1,)], "object_id bigint"))
    assert left.count() == 0


def test_progress_belongs_to_its_destination(spark, tmp_path):
    table = str(tmp_path / "journal")
    journal.create_journal(spark, table)
    schema = "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string, destination string"

    def add(*rows):
        journal.journal_progress(spark.createDataFrame([(o, 5, "e", n, c * 32, d) for o, n, c, d in rows], schema), table)

    def slots(*targets):
        wanted = spark.createDataFrame(list(targets), "object_id bigint, destination string")
        return {(r["object_id"], r["part_num"]): r["md5"][0] for r in journal.load_progress(spark, table, wanted).collect()}

    add((1, 0, "a", "/x"), (1, 1, "b", "/x"), (1, 0, "c", "/y"), (2, 0, "d", None))
    assert slots((1, "/x")) == {(1, 0): "a", (1, 1): "b"}
    assert slots((1, "/y"), (2, "/x")) == {(1, 0): "c", (2, 0): "d", (2, 1): "b"}
    assert slots((7, "/x")) == {(7, 0): "a", (7, 1): "b"}
    assert slots((1, "/z"), (9, None)) == {}
    assert journal.load_progress(spark, table).count() == 4
    journal.end_progress(spark.createDataFrame([(7, "/x")], "object_id bigint, destination string"), table)
    assert slots((1, "/x")) == {} and slots((1, "/y")) == {(1, 0): "c"}


def test_what_cannot_be_read_is_a_reject_row(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    (tmp_path / "file").write_bytes(b"12345")
    rows = [(1, 0, f"{tmp_path}/folder", 0, 5), (2, 0, f"{tmp_path}/file", 0, 5), (3, 0, f"{tmp_path}/file/below", 0, 5), (4, 0, f"{tmp_path}/none", 0, 5)]
    parts = spark.createDataFrame(rows, "object_id long, part_num long, url string, start long, end long")
    found = {r["object_id"]: (r["bytes"], r["reject_reason"]) for r in fetch_parts(parts).collect()}
    assert found.pop(2) == (b"12345", None)
    assert set(found) == {1, 3, 4} and set(found.values()) == {(None, "SourceMissing")}
    assert {r["object_id"] for r in digest_ranges(parts).filter("md5 is null").collect()} == {1, 3, 4}
