"""Whole jobs: resume after a crash, keys, copies, downloads, cancelling."""

import base64
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from partwise.operators import crypto
from partwise.plans import transfer
from partwise.plans.cancel import run_cancel
from partwise.plans.download import run_download
from partwise.plans.store import Store
from partwise.plans.transfer import run_copy, run_transfer, wave_of
from partwise.plans.verify import run_verify
from partwise.sources.files import partial_path
from partwise.sources.objects import fetch_parts

P = 1024
SIZES = [0, 1, P - 1, P, P + 1, 2 * P, 5 * P // 2, 40 * P]
KEY_A, KEY_B = "-0123456789012345678901234567890", "skdjfh9q4rusidfjs9fjsdr9vkfdh833"
REQUEST = "object_id bigint, src_url string, dst_url string, exists string, resume_mode string, part_size bigint, key_id string, location string"
DOWNLOAD = "object_id bigint, src_url string, dst_url string, file_exists string, download_exists string, part_size bigint, key_id string"


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame(
        [("kA", KEY_A, True), ("kB", KEY_B, False), ("kBad", "short", False)], "key_id string, key_text string, is_master boolean"
    )


@pytest.fixture()
def source(tmp_path):
    rng = random.Random(11)
    folder = tmp_path / "src"
    folder.mkdir()
    contents = {size: rng.randbytes(size) for size in SIZES}
    for size, data in contents.items():
        (folder / f"{size}.bin").write_bytes(data)
    return str(folder), contents


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).create()


def requests(spark, folder, dst="s3://b/", exists=None, mode=None, part_size=P, key=None):
    return spark.createDataFrame([(s, f"{folder}/{s}.bin", dst, exists, mode, part_size, key, "") for s in SIZES], REQUEST)


def outcome(df):
    return {r["object_id"]: (r["action"], r["exit_code"]) for r in df.collect()}


def digests(spark, store, key=None, keys=None, bucket="b"):
    asked = spark.createDataFrame([(s, f"s3://{bucket}/{s}.bin", key) for s in SIZES], "object_id bigint, src_url string, key_id string")
    return {r["object_id"]: r["digest"] or r["error_class"] for r in run_verify(store, asked, "md5", keys).collect()}


def md5s(contents):
    return {k: hashlib.md5(v).hexdigest() for k, v in contents.items()}


def test_upload_policies(spark, store, source):
    folder, contents = source
    new = {s: ("NEW", None) for s in SIZES}
    assert outcome(run_transfer(store, requests(spark, folder))) == new
    assert digests(spark, store) == md5s(contents)
    n = store.table("parts").count()
    assert outcome(run_transfer(store, requests(spark, folder))) == {s: ("FAIL", 3) for s in SIZES}
    assert outcome(run_transfer(store, requests(spark, folder, exists="skip"))) == {s: ("SKIP", None) for s in SIZES}
    assert store.table("parts").count() == n
    assert outcome(run_transfer(store, requests(spark, folder, exists="overwrite", part_size=2 * P))) == new
    assert digests(spark, store) == md5s(contents)
    assert {r["part_size"] for r in store.objects().collect()} == {2 * P}


def test_crash_and_resume(spark, store, source, monkeypatch):
    folder, contents = source

    def broken(ranges, *args, **more):
        """Fails the task that comes to the largest file."""
        fails = F.when(F.col("url").endswith(f"/{SIZES[-1]}.bin"), F.raise_error(F.lit("disk lost")).cast("bigint"))
        return fetch_parts(ranges.withColumn("start", F.coalesce(fails, F.col("start"))), *args, **more)

    monkeypatch.setattr(transfer, "fetch_parts", broken)
    with pytest.raises(Exception, match="disk lost"):
        run_transfer(store, requests(spark, folder), waves=6)
    monkeypatch.undo()
    published = {int(r["key"].split(".")[0]) for r in store.objects().collect()}
    assert SIZES[-1] not in published
    assert store.pending().count() == len(SIZES) - len(published)
    done_before = store.stored_parts().count()
    again = outcome(run_transfer(store, requests(spark, folder)))
    assert again == {s: ("FAIL", 3 if s in published else 4) for s in SIZES}
    tried = outcome(run_transfer(store, requests(spark, folder, exists="skip", mode="resume"), waves=2))
    assert tried == {s: ("SKIP" if s in published else "RESUME", None) for s in SIZES}
    assert digests(spark, store) == md5s(contents)
    slots = store.stored_parts().groupBy("upload_id", "part_num").count()
    assert slots.filter("count > 1").count() == 0 and slots.count() >= done_before
    assert store.pending().count() == 0


@pytest.mark.parametrize("waves", [1, 2, 3, 7, 50])
def test_waves_keep_part_order(spark, waves):
    counts = spark.createDataFrame([(str(i), n) for i, n in enumerate([1, 2, 16, 17, 33, 160, 1000, 5000])], "upload_id string, n bigint")
    rows = counts.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("part_num"))
    found = {}
    for r in rows.select("*", wave_of(F.col("part_num"), F.col("n"), waves).alias("w")).orderBy("part_num").collect():
        found.setdefault(r["n"], []).append(r["w"])
    for n, numbers in found.items():
        assert numbers == sorted(numbers) and 0 <= numbers[0] and numbers[-1] < waves
        assert len(set(numbers)) == min(waves, -(-n // 16))


def test_resume_skips_stored_parts(spark, store, source):
    folder, contents = source
    size = SIZES[-1]
    part = spark.createDataFrame([("u", 0, 3, 3 * P, 4 * P, bytearray(contents[size][3 * P : 4 * P]))],
                                 "upload_id string, bucket_id int, part_num bigint, start bigint, end bigint, bytes binary")
    stored = part.select("*", F.col("start").alias("offset"), F.md5("bytes").alias("md5"), F.lit(False).alias("is_encrypted"), F.lit("a").alias("attempt"),
                         F.lit(None).cast("string").alias("reject_reason"))
    store.append("parts", stored)
    store.append("uploads", spark.createDataFrame([("u", "b", f"{size}.bin", P)], "upload_id string, bucket string, key string, part_size bigint")
                 .withColumn("initiated", F.current_timestamp()))
    assert outcome(run_transfer(store, requests(spark, folder, mode="resume", part_size=2 * P)))[size] == ("FAIL", 8)
    rest = requests(spark, folder, mode="resume").filter(F.col("object_id") == size)
    assert outcome(run_transfer(store, rest)) == {size: ("RESUME", None)}
    assert store.stored_parts().filter("upload_id = 'u'").count() == 40
    wanted = b"".join(hashlib.md5(contents[size][i * P : (i + 1) * P]).digest() for i in range(40))
    etag = store.objects().filter(F.col("key") == f"{size}.bin").first()["etag"]
    assert etag == f"{hashlib.md5(wanted).hexdigest()}-40"


def test_force_and_cancel(spark, store, source):
    folder, contents = source
    for u in ("x1", "x2"):
        store.append("uploads", spark.createDataFrame([(u, "b", "1.bin", P)], "upload_id string, bucket string, key string, part_size bigint")
                     .withColumn("initiated", F.current_timestamp()))
    one = requests(spark, folder).filter("object_id = 1")
    assert outcome(run_transfer(store, one)) == {1: ("FAIL", 13)}
    assert outcome(run_transfer(store, one.withColumn("resume_mode", F.lit("resume")))) == {1: ("FAIL", 13)}
    assert outcome(run_transfer(store, one.withColumn("resume_mode", F.lit("force")))) == {1: ("CANCEL_AND_NEW", None)}
    assert store.pending().count() == 0
    store.append("uploads", spark.createDataFrame([("x3", "b", "d/1.bin", P)], "upload_id string, bucket string, key string, part_size bigint")
                 .withColumn("initiated", F.current_timestamp()))

    def target(url):
        return spark.createDataFrame([(url,)], "dst_url string")

    cancelled, refused = run_cancel(store, target("s3://b/d/"))
    assert (cancelled.count(), refused.first()["exit_code"]) == (0, 6)
    assert run_cancel(store, target("s3:/b"))[1].first()["exit_code"] == 7
    assert run_cancel(store, target("s3://b/d/1.bin"))[0].count() == 1
    assert run_cancel(store, target("s3://b/"), True)[0].count() == 0


def test_source_changes(spark, store, source):
    folder, _ = source
    asked = spark.createDataFrame(
        [(1, f"{folder}/none", "s3://b/x", None, None, P, None, ""), (2, f"{folder}/1.bin", "s3://", None, None, P, None, ""),
         (3, "file://host/x", "s3://b/y", None, None, P, None, ""), (4, f"{folder}/1.bin", "s3://b/z", None, None, P, "kNone", ""),
         (5, "http://h/x", "s3://b/w", None, None, P, None, "")], REQUEST)
    keys = spark.createDataFrame([("k", KEY_B, False)], "key_id string, key_text string, is_master boolean")
    assert outcome(run_transfer(store, asked, keys)) == {1: ("FAIL", 1), 2: ("FAIL", 7), 3: ("FAIL", 5), 4: ("FAIL", 10), 5: ("FAIL", 1)}
    assert store.table("uploads").count() == 0


def test_keys(spark, store, source, keys):
    folder, contents = source
    assert set(outcome(run_transfer(store, requests(spark, folder, key="kA"), keys)).values()) == {("NEW", None)}
    stored = store.table("parts").filter("length(bytes) > 28").collect()
    assert all(bytes(r["bytes"]) not in contents.values() for r in stored)
    assert digests(spark, store, "kA", keys) == md5s(contents)
    for other in (None, "kB", "kBad"):
        assert set(digests(spark, store, other, keys).values()) == {"InvalidEncryptionKey"}
    again = run_transfer(store, requests(spark, folder, exists="overwrite", key="kB"), keys)
    assert set(outcome(again).values()) == {("FAIL", 10)}
    # A copy opens the source with its key and stores it under another one, cut anew for odd sizes.
    copy = spark.createDataFrame(
        [(s, f"s3://b/{s}.bin", "s3://c/", None, None, P if s % 2 == 0 else 700, "kB", "") for s in SIZES], REQUEST
    ).withColumn("src_key_id", F.lit("kA"))
    assert set(outcome(run_copy(store, copy, keys, keys, waves=2)).values()) == {("NEW", None)}
    assert digests(spark, store, "kB", keys, "c") == md5s(contents)
    # New parts larger than a cell are kept in pieces, and can be copied on.
    large = copy.withColumn("part_size", F.lit(3000).cast("bigint")).withColumn("dst_url", F.lit("s3://e/"))
    assert set(outcome(run_copy(store, large, keys, keys, cell_bytes=2000)).values()) == {("NEW", None)}
    assert digests(spark, store, "kB", keys, "e") == md5s(contents)
    etags = {r["key"]: r["etag"] for r in store.objects().filter("bucket = 'e'").collect()}
    joined = b"".join(hashlib.md5(contents[40 * P][i : i + 3000]).digest() for i in range(0, 40 * P, 3000))
    assert etags[f"{40 * P}.bin"] == f"{hashlib.md5(joined).hexdigest()}-14"
    onward = spark.createDataFrame([(s, f"s3://e/{s}.bin", "s3://f/", None, None, 512, None, "") for s in SIZES], REQUEST)
    assert set(outcome(run_copy(store, onward.withColumn("src_key_id", F.lit("kB")), keys, keys)).values()) == {("NEW", None)}
    assert digests(spark, store, None, keys, "f") == md5s(contents)
    wrong = copy.withColumn("src_key_id", F.lit("kB")).withColumn("dst_url", F.lit("s3://d/"))
    assert set(outcome(run_copy(store, wrong, keys, keys)).values()) == {("FAIL", 10)}


def test_derived_key(spark):
    objects = spark.createDataFrame(
        [(1, "kA", "b", "k/ü", "us-west-1"), (2, "kB", "b", "k", ""), (3, "k64", "b", "k", ""), (4, "kBad", "b", "k", ""), (5, None, "b", "k", ""),
         (6, "kA", "b", "k", None), (7, "kB", "b", "k", None)],
        "object_id bigint, key_id string, bucket string, key string, location string")
    table = spark.createDataFrame(
        [("kA", KEY_A, None, True), ("kB", KEY_B, None, False), ("k64", None, base64.b64encode(KEY_B.encode()).decode(), False), ("kBad", None, "!!", False)],
        "key_id string, key_text string, key_base64 string, is_master boolean")
    rows = {r["object_id"]: r for r in crypto.derive_object_keys(objects, crypto.read_keys(table)).collect()}
    derived = hashlib.sha256(KEY_A.encode() + "https://s3-us-west-1.amazonaws.com/b/k/ü".encode()).digest()
    assert rows[1]["object_key"] == derived.hex()
    assert rows[1]["key_b64"] == base64.b64encode(derived).decode()
    assert rows[1]["key_md5_b64"] == base64.b64encode(hashlib.md5(derived).digest()).decode()
    assert rows[2]["object_key"] == rows[3]["object_key"] == KEY_B.encode().hex()
    assert (rows[4]["object_key"], rows[4]["reject_reason"]) == (None, "InvalidEncryptionKey")
    assert (rows[5]["object_key"], rows[5]["reject_reason"]) == (None, None)
    assert (rows[6]["object_key"], rows[6]["reject_reason"]) == (None, "PermissionDenied")
    assert (rows[7]["object_key"], rows[7]["reject_reason"]) == (KEY_B.encode().hex(), None)


def test_raw_keys(spark):
    """Keys as bytes that are no text; one that is given as text as well; one of 31 bytes; columns may lack."""
    raw = bytes(range(200, 232))
    rows = [("raw", bytearray(raw), True), ("short", bytearray(raw[1:]), False), ("none", None, False)]
    table = spark.createDataFrame(rows, "key_id string, key_bytes binary, is_master boolean")
    read = {r["key_id"]: r for r in crypto.read_keys(table).collect()}
    assert bytes(read["raw"]["key"]) == raw and read["raw"]["reject_reason"] is None
    assert read["short"]["reject_reason"] == read["none"]["reject_reason"] == "InvalidEncryptionKey"
    both = table.withColumn("key_text", F.when(F.col("key_id") == "raw", F.lit(KEY_A)))
    assert {r["key_id"]: r["key"] and bytes(r["key"]) for r in crypto.read_keys(both).collect()} == {
        "raw": KEY_A.encode(), "short": raw[1:], "none": None
    }
    objects = spark.createDataFrame([(1, "raw", "b", "k", "")], "object_id bigint, key_id string, bucket string, key string, location string")
    derived = hashlib.sha256(raw + b"https://s3.amazonaws.com/b/k").hexdigest()
    assert crypto.derive_object_keys(objects, crypto.read_keys(table)).first()["object_key"] == derived


def test_download_resume(spark, store, source, tmp_path):
    folder, contents = source
    run_transfer(store, requests(spark, folder))
    out, table = tmp_path / "out", str(tmp_path / "journal")

    def asked(size=P, file_exists=None, mode=None):
        return spark.createDataFrame([(s, f"s3://b/{s}.bin", f"{out}/{s}.bin", file_exists, mode, size, None) for s in SIZES], DOWNLOAD)

    # A file of another owner blocks one rename at the end of the first run.
    first = run_download(store, asked(), table, waves=2)
    assert outcome(first) == {s: ("NEW", None) for s in SIZES}
    assert {int(f.stem): f.read_bytes() for f in out.iterdir()} == contents
    assert outcome(run_download(store, asked(), table)) == {s: ("FAIL", 11) for s in SIZES}
    assert outcome(run_download(store, asked(file_exists="skip"), table)) == {s: ("SKIP", None) for s in SIZES}
    # Progress is gone after success, so overwriting starts anew, here with another part size.
    assert outcome(run_download(store, asked(700, "overwrite"), table)) == {s: ("NEW", None) for s in SIZES}
    assert {int(f.stem): f.read_bytes() for f in out.iterdir()} == contents


def test_download_keeps_verified_parts(spark, store, source, tmp_path):
    from partwise.sources import progress as journal

    folder, contents = source
    run_transfer(store, requests(spark, folder))
    size = SIZES[-1]
    etag = store.objects().filter(F.col("key") == f"{size}.bin").first()["etag"]
    out, table = tmp_path / "out", str(tmp_path / "journal")
    out.mkdir()
    half = bytearray(contents[size][: 20 * P])
    half[5 * P] ^= 1  # part 5 changed on disk since it was recorded
    with open(partial_path(f"{out}/{size}.bin"), "wb") as f:
        f.write(half)
    journal.create_journal(spark, table)
    rows = [(size, P, etag, i, hashlib.md5(contents[size][i * P : (i + 1) * P]).hexdigest()) for i in range(20)]
    journal.journal_progress(spark.createDataFrame(rows, "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string"), table)

    def asked(mode, part_size=P):
        return spark.createDataFrame([(size, f"s3://b/{size}.bin", f"{out}/{size}.bin", None, mode, part_size, None)], DOWNLOAD)

    assert outcome(run_download(store, asked(None), table)) == {size: ("FAIL", 12)}
    assert outcome(run_download(store, asked("resume", 2 * P), table)) == {size: ("FAIL", 8)}
    done = run_download(store, asked("resume"), table).first()
    assert (done["action"], done["n_kept"], done["n_fetched"]) == ("LOAD", 19, 21)
    assert (out / f"{size}.bin").read_bytes() == contents[size]
    assert os.listdir(out) == [f"{size}.bin"]


def test_download_restarts_for_new_etag(spark, store, source, tmp_path):
    from partwise.sources import progress as journal

    folder, contents = source
    run_transfer(store, requests(spark, folder))
    out, table = tmp_path / "out", str(tmp_path / "journal")
    journal.create_journal(spark, table)
    rows = [(s, P, "old", 0, "a" * 32) for s in SIZES]
    journal.journal_progress(spark.createDataFrame(rows, "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string"), table)
    asked = spark.createDataFrame([(s, f"s3://b/{s}.bin", f"file:{out}/{s}.bin", None, "resume", P, None) for s in SIZES], DOWNLOAD)
    assert outcome(run_download(store, asked, table)) == {s: ("RESTART", None) for s in SIZES}
    assert {int(f.stem): f.read_bytes() for f in out.iterdir()} == contents


def test_other_manifests_see_no_progress(spark, store, source, tmp_path):
    """Half a download of one file: another file under its number starts anew, the same file under another number goes on."""
    from partwise.sources import progress as journal

    folder, contents = source
    run_transfer(store, requests(spark, folder))
    size = SIZES[-1]
    etag = store.objects().filter(F.col("key") == f"{size}.bin").first()["etag"]
    out, table = tmp_path / "out", str(tmp_path / "journal")
    out.mkdir()
    with open(partial_path(f"{out}/a"), "wb") as f:
        f.write(contents[size][: 20 * P])
    journal.create_journal(spark, table)
    rows = [(1, P, etag, i, hashlib.md5(contents[size][i * P : (i + 1) * P]).hexdigest(), f"{out}/a") for i in range(20)]
    schema = "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string, destination string"
    journal.journal_progress(spark.createDataFrame(rows, schema), table)

    def download(number, name):
        asked = spark.createDataFrame([(number, f"s3://b/{size}.bin", f"{out}/{name}", None, "resume", P, None)], DOWNLOAD)
        return run_download(store, asked, table).first()

    other = download(1, "b")
    assert (other["action"], other["error_class"], other["n_kept"]) == ("NEW", None, 0)
    same = download(2, "a")
    assert (same["action"], same["n_kept"], same["n_fetched"]) == ("LOAD", 20, 20)
    assert (out / "a").read_bytes() == (out / "b").read_bytes() == contents[size]


def test_keys_are_in_no_scratch_table(spark, store, source, keys):
    from partwise.sources.scratch import shared_dir

    folder, _ = source
    run_transfer(store, requests(spark, folder, dst="s3://secret/", key="kB"), keys)
    secret, hexed = KEY_B.encode(), KEY_B.encode().hex().encode()
    for base, _, files in os.walk(shared_dir(spark)):
        for name in files:
            with open(os.path.join(base, name), "rb") as f:
                data = f.read()
            assert secret not in data and hexed not in data


def test_names_that_look_like_urls(spark, store, tmp_path):
    """The bytes of the file that was named, also where # ? % or ; are in its path."""
    contents = {name: os.urandom(1500) for name in ("a", "a#1.bin", "a?x=1", "a%20b", "a;b")}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    rows = [(i, f"{tmp_path}/{name}", "s3://b/", None, None, P, None, "", name) for i, name in enumerate(contents)]
    asked = spark.createDataFrame(rows, REQUEST + ", dst_key string")
    assert set(outcome(run_transfer(store, asked)).values()) == {("NEW", None)}
    etags = {r["key"]: r["etag"] for r in store.objects().collect()}
    for name, data in contents.items():
        joined = b"".join(hashlib.md5(data[i : i + P]).digest() for i in (0, P))
        assert etags[name] == f"{hashlib.md5(joined).hexdigest()}-2"
    plain = spark.createDataFrame([(9, f"{tmp_path}/a#1.bin", "s3://c/", None, None, P, None, "")], REQUEST)
    assert outcome(run_transfer(store, plain)) == {9: ("NEW", None)}
    assert [r["key"] for r in store.objects().filter("bucket = 'c'").collect()] == ["a#1.bin"]


def test_bad_requests_are_rows(spark, store, source, tmp_path):
    """Good ones go through in the same run."""
    folder, contents = source
    rows = [
        (1, f"{folder}/1.bin", "s3://b/one", P, ""), (2, f"{folder}/{P}.bin", "s3://b/one", P, ""), (3, folder, "s3://b/folder", P, ""),
        (4, f"{folder}/1.bin", "s3://b/zero", 0, ""), (5, f"{folder}/1.bin", "s3://b/none", None, ""), (6, f"{folder}/1.bin", "s3://b/neg", -5, ""),
        (7, f"{folder}/1.bin", "s3://b/huge", 6 * 1024**3, ""), (8, f"{folder}/{2 * P}.bin", "s3://b/two", P, ""),
    ]
    asked = spark.createDataFrame([(i, s, d, None, None, p, None, at) for i, s, d, p, at in rows], REQUEST)
    assert outcome(run_transfer(store, asked)) == {
        1: ("NEW", None), 2: ("FAIL", 3), 3: ("FAIL", 1), 4: ("FAIL", 2), 5: ("FAIL", 2), 6: ("FAIL", 2), 7: ("FAIL", 2), 8: ("NEW", None),
    }
    assert {r["key"]: r["size"] for r in store.objects().collect()} == {"one": 1, "two": 2 * P}
    down = [(i, f"s3://b/{k}", f"{tmp_path}/out/{d}", None, None, p, None) for i, k, d, p in ((1, "one", "x", P), (2, "two", "x", P), (3, "two", "y", 0), (4, "two", "z", 700))]
    done = run_download(store, spark.createDataFrame(down, DOWNLOAD), str(tmp_path / "journal"))
    assert outcome(done) == {1: ("NEW", None), 2: ("FAIL", 11), 3: ("FAIL", 2), 4: ("NEW", None)}
    assert (tmp_path / "out/x").read_bytes() == contents[1] and (tmp_path / "out/z").read_bytes() == contents[2 * P]


def test_leftovers_of_a_broken_part(spark, store, source):
    """Cells of an attempt that never ended are in no object, those of one that did are."""
    folder, contents = source
    run_transfer(store, requests(spark, folder))
    upload = store.objects().filter(f"key = '{2 * P}.bin'").first()["upload_id"]
    rows = store.table("parts").filter(F.col("upload_id") == upload)
    left = rows.filter("part_num = 1").withColumns({"bytes": F.lit(b"?" * 100), "md5": F.lit(None).cast("string"), "attempt": F.lit("broken")})
    store.append("parts", left)
    assert digests(spark, store) == md5s(contents)
    # A part in two cells of one attempt.
    size = 5 * P // 2
    upload = store.objects().filter(f"key = '{size}.bin'").first()["upload_id"]
    kept = store.table("parts").filter((F.col("upload_id") != upload) | (F.col("part_num") != 0))
    whole = store.table("parts").filter((F.col("upload_id") == upload) & (F.col("part_num") == 0)).withColumn("attempt", F.lit("ended"))
    first = whole.withColumns({"bytes": F.substring("bytes", 1, 1000), "md5": F.lit(None).cast("string")})
    last = whole.withColumns({"bytes": F.expr("substring(bytes, 1001)"), "offset": F.lit(1000).cast("bigint")})
    other = Store(spark, store.root + "-other").create()
    other.append("parts", kept.unionByName(first).unionByName(last))
    for name in ("uploads", "closed", "objects"):
        store.table(name).write.mode("append").parquet(other.path(name))
    assert digests(spark, other) == md5s(contents)
