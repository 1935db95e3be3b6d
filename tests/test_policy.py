"""Decisions: one row for each branch."""

import pytest

from partwise.operators import policy
from partwise.operators.integrity import verify_parts

UPLOADS = [
    # (exists, key, dest key or absent, resume_mode, part_size, pending [(parts...)]) -> (action, error, exit code)
    ((None, None, "-", None, 10, []), ("NEW", None, None)),
    ((None, None, None, None, 10, []), ("FAIL", "ObjectExists", 3)),
    (("skip", None, None, None, 10, []), ("SKIP", None, None)),
    (("overwrite", None, None, None, 10, []), ("NEW", None, None)),
    (("other", None, None, None, 10, []), ("FAIL", "UserError", 2)),
    (("overwrite", "k1", None, None, 10, []), ("FAIL", "InvalidEncryptionKey", 10)),
    (("skip", None, "k1", None, 10, []), ("FAIL", "InvalidEncryptionKey", 10)),
    (("overwrite", "k1", "k1", None, 10, []), ("NEW", None, None)),
    # The destination comes before unfinished uploads.
    ((None, None, None, "resume", 10, [[10]]), ("FAIL", "ObjectExists", 3)),
    (("skip", None, None, "force", 10, [[10]]), ("SKIP", None, None)),
    (("overwrite", None, None, None, 10, [[10]]), ("FAIL", "UploadExists", 4)),
    (("overwrite", None, None, "resume", 10, [[10, 10]]), ("RESUME", None, None)),
    ((None, None, "-", None, 10, [[10]]), ("FAIL", "UploadExists", 4)),
    ((None, None, "-", None, 10, [[], []]), ("FAIL", "MultipleUploadsExist", 13)),
    ((None, None, "-", "resume", 10, [[], []]), ("FAIL", "MultipleUploadsExist", 13)),
    ((None, None, "-", "force", 10, [[], []]), ("CANCEL_AND_NEW", None, None)),
    ((None, None, "-", "force", 20, [[10]]), ("CANCEL_AND_NEW", None, None)),
    ((None, None, "-", "both", 10, []), ("FAIL", "UserError", 2)),
    ((None, None, "-", "resume", 10, []), ("NEW", None, None)),
    ((None, None, "-", "resume", 99, [[]]), ("RESUME", None, None)),
    ((None, None, "-", "resume", 10, [[10, 10, 4]]), ("RESUME", None, None)),
    ((None, None, "-", "resume", 20, [[10, 10]]), ("FAIL", "IncompatiblePartSize", 8)),
    # Only the short last part is there: its size is taken for the part size.
    ((None, None, "-", "resume", 10, [[4]]), ("FAIL", "IncompatiblePartSize", 8)),
    ((None, None, "-", "resume", 10, [[10, 4, 4]]), ("FAIL", "AmbiguousPartSize", 1)),
    ((None, None, "-", "resume", 10, [[10, 5, 4]]), ("FAIL", "AmbiguousPartSize", 1)),
]


def test_upload_decisions(spark):
    requests, dest, pending, completed = [], [], [], []
    for i, ((exists, key, dest_key, mode, size, open_uploads), _) in enumerate(UPLOADS):
        requests.append((i, "b", f"k{i}", exists, mode, size, key))
        if dest_key != "-":
            dest.append((i, dest_key))
        for u, parts in enumerate(open_uploads):
            pending.append((f"{i}-{u}", "b", f"k{i}"))
            completed += [(f"{i}-{u}", n, s, "e") for n, s in enumerate(parts)]
    decided = policy.upload_decisions(
        spark.createDataFrame(requests, "object_id int, bucket string, key string, exists string, resume_mode string, part_size bigint, key_id string"),
        spark.createDataFrame(dest, "object_id int, key_id string"),
        spark.createDataFrame(pending, "upload_id string, bucket string, key string"),
        spark.createDataFrame(completed, "upload_id string, part_num bigint, size bigint, etag string"),
    )
    rows = {r["object_id"]: r for r in decided.collect()}
    assert len(rows) == len(UPLOADS)
    for i, (case, wanted) in enumerate(UPLOADS):
        r = rows[i]
        assert (r["action"], r["error_class"], r["exit_code"]) == wanted, case
        assert r["upload_id"] == (f"{i}-0" if wanted[0] == "RESUME" else None)


DOWNLOADS = [
    # (file there, file_exists, progress (part size, etag) or None, download_exists) -> (action, error, exit code)
    ((False, None, None, None), ("NEW", None, None)),
    ((True, None, None, None), ("FAIL", "FileExists", 11)),
    ((True, "skip", (10, "e"), "resume"), ("SKIP", None, None)),
    ((True, "overwrite", None, None), ("NEW", None, None)),
    ((True, "other", None, None), ("FAIL", "UserError", 2)),
    ((True, None, (10, "e"), "resume"), ("FAIL", "FileExists", 11)),
    ((False, None, (10, "e"), None), ("FAIL", "DownloadExists", 12)),
    ((False, None, (10, "e"), "resume"), ("LOAD", None, None)),
    ((False, None, (10, "old"), "resume"), ("RESTART", None, None)),
    ((False, None, (20, "e"), "resume"), ("FAIL", "IncompatiblePartSize", 8)),
    ((False, None, (20, "old"), "resume"), ("FAIL", "IncompatiblePartSize", 8)),
    ((False, None, (20, "old"), "discard"), ("DISCARD", None, None)),
    ((True, "overwrite", (10, "e"), "resume"), ("LOAD", None, None)),
    ((False, None, (10, "e"), "other"), ("FAIL", "UserError", 2)),
]


@pytest.fixture(scope="module")
def downloads(spark):
    requests, dest, progress, objects = [], [], [], []
    for i, ((there, file_exists, recorded, mode), _) in enumerate(DOWNLOADS):
        requests.append((i, file_exists, mode, 10))
        objects.append((i, "e"))
        if there:
            dest.append((i,))
        if recorded:
            progress += [(i, *recorded, n, "0" * 32) for n in range(2)]
    return (
        spark.createDataFrame(requests, "object_id int, file_exists string, download_exists string, part_size bigint"),
        spark.createDataFrame(dest, "object_id int"),
        spark.createDataFrame(progress, "object_id int, part_size bigint, etag string, part_num bigint, md5 string"),
        spark.createDataFrame(objects, "object_id int, etag string"),
    )


def test_download_decisions(downloads):
    rows = {r["object_id"]: r for r in policy.apply_file_exists_policy(*downloads).collect()}
    assert len(rows) == len(DOWNLOADS)
    for i, (case, wanted) in enumerate(DOWNLOADS):
        assert (rows[i]["action"], rows[i]["error_class"], rows[i]["exit_code"]) == wanted, case


def test_progress_compat(downloads):
    requests, _, progress, objects = downloads
    rows = {r["object_id"]: r["error_class"] or r["action"] for r in policy.check_progress_compat(requests, progress, objects).collect()}
    assert set(rows) == {i for i, ((_, _, recorded, _), _) in enumerate(DOWNLOADS) if recorded}
    assert (rows[7], rows[8], rows[9]) == ("LOAD", "RESTART", "IncompatiblePartSize")


def test_late_destination(spark):
    decisions = spark.createDataFrame(
        [(1, None, "NEW", None, None), (2, "overwrite", "NEW", None, None), (3, "skip", "LOAD", None, None),
         (4, None, "FAIL", "DownloadExists", 12), (5, None, "NEW", None, None)],
        "object_id int, file_exists string, action string, error_class string, exit_code int",
    )
    before = spark.createDataFrame([(9,)], "object_id int")
    after = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9)], "object_id int")
    rows = {r["object_id"]: (r["action"], r["exit_code"]) for r in policy.recheck_destination(decisions, before, after).collect()}
    assert rows == {1: ("FAIL", 11), 2: ("NEW", None), 3: ("FAIL", 11), 4: ("FAIL", 12), 5: ("NEW", None)}


def test_verify_parts(spark):
    progress = spark.createDataFrame(
        [(1, 0, "a" * 32), (1, 1, "0" * 32), (1, 2, "b" * 32)], "object_id int, part_num bigint, md5 string"
    )
    now = spark.createDataFrame(
        [(1, 0, "a" * 32), (1, 1, "a" * 32), (1, 2, None), (1, 3, "c" * 32)], "object_id int, part_num bigint, md5 string"
    )
    rows = {r["part_num"]: r["action"] for r in verify_parts(progress, now).collect()}
    assert rows == {0: "VERIFIED", 1: "DOWNLOAD", 2: "REDOWNLOAD", 3: "DOWNLOAD"}
