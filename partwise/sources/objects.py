"""Listing objects and reading ranges of them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwise.functions.balance import deal_by_bytes
from partwise.limits import BATCH_BYTES, MAX_CELL_BYTES
from partwise.operators.integrity import new_hash
from partwise.sources.files import NOT_READABLE, Reader, filesystem_of, read_range
from partwise.sources.scratch import materialise


_LISTED = "url string, name string, size bigint, modified_ns bigint, is_dir boolean"
# Entries one task lists below a folder before it leaves the other subfolders to more tasks.
LIST_AT_ONCE = 10_000


def _list_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files below each folder, and the subfolders that are not looked into yet."""
    from pyarrow import fs

    names = ["url", "name", "size", "modified_ns", "is_dir"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    def rows(entries: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), t) for c, t in zip(zip(*entries), types)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            filesystem, start, prefix = filesystem_of(folder)
            info = filesystem.get_file_info(start)
            waiting, seen = [start], 0
            if info.type == fs.FileType.File:
                waiting = []
                yield rows([(prefix + info.path, info.base_name, info.size, info.mtime_ns, False)])
            while waiting and seen < LIST_AT_ONCE:
                found = filesystem.get_file_info(fs.FileSelector(waiting.pop()))
                seen += len(found)
                waiting += [f.path for f in found if f.type == fs.FileType.Directory]
                files = [
                    (prefix + f.path, f.base_name, f.size, f.mtime_ns, False)
                    for f in found
                    if f.type == fs.FileType.File
                ]
                if files:
                    yield rows(files)
            if waiting:
                yield rows([(prefix + path, None, None, None, True) for path in waiting])


def scan_objects(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(url, name, size, etag, modified) of all files below path; no file is opened.

    Folders are listed by the tasks, in as many rounds as the tree needs, and the list never passes
    through the driver. Spark's own file sources are not used for it as they leave out empty files.
    Partial files of this library are no objects. etag changes when a file is written again.
    """
    folders = spark.range(1, numPartitions=1).select(F.lit(path.rstrip("/") or "/").alias("url"))
    rounds = []
    while True:
        listed = materialise(folders.mapInArrow(_list_below, _LISTED), "listing")
        rounds.append(listed.filter("not is_dir"))
        folders = listed.filter("is_dir").select("url")
        if folders.isEmpty():
            break
        folders = folders.repartition(spark.sparkContext.defaultParallelism, "url")
    files = reduce(DataFrame.unionByName, rounds)
    pattern = "^" + re.escape(glob).replace(r"\*", ".*").replace(r"\?", ".") + "$"
    return files.filter(F.col("name").rlike(pattern) & ~F.col("name").rlike(r"^\..*\.partial$")).select(
        "url",
        "name",
        "size",
        F.md5(F.concat_ws("-", "modified_ns", "size").cast("binary")).alias("etag"),
        F.timestamp_micros(F.call_function("div", F.col("modified_ns"), F.lit(1000).cast("bigint"))).alias("modified"),
    )


BYTES_PER_TASK = 1024**3


def tasks_for(ranges: DataFrame, bytes_per_task: int = BYTES_PER_TASK) -> int:
    """Number of tasks that gives each about bytes_per_task; ranges is a written table."""
    total = ranges.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    return max(ranges.sparkSession.sparkContext.defaultParallelism, -(-total // bytes_per_task))


def spread_ranges(
    parts: DataFrame, key: str, tasks: int | None = None, first: tuple[str, ...] = (), run: int = 4
) -> DataFrame:
    """Part rows without bytes, dealt to tasks so that each has nearly the same bytes; see deal_by_bytes.

    Tasks have them in the order of the columns first, key and part_num. Without tasks there is
    one for each core; tasks_for gives a number that fits the bytes.

    The number of tasks is given to Spark explicitly: ranges are tiny rows that stand for much
    work, so adaptive execution must not put them together by their size.
    """
    n = tasks or parts.sparkSession.sparkContext.defaultParallelism
    return deal_by_bytes(parts, n, key, F.col("end") - F.col("start"), first, run=run)


def _arrow_type(batch: pa.RecordBatch, extra: list[pa.Field]) -> pa.Schema:
    return pa.schema(list(batch.schema) + extra)


def fetch_parts(
    parts: DataFrame, key: str = "object_id", tasks: int | None = None, algo: str = "md5",
    cell_bytes: int = MAX_CELL_BYTES, order: tuple[str, ...] = (),
) -> DataFrame:
    """Read the range [start, end) of url for each row of a planned parts table.

    Adds offset, bytes, md5 (named after algo), attempt and reject_reason. A part of up to cell_bytes is
    one row; a longer one is several, of which the last holds the digest of the part. offset is where
    the bytes of a row begin. attempt is the same for the rows of one reading of a part: rows of an
    attempt without a last row are leftovers. A range that gives fewer bytes than planned, or whose file is gone or may not be read,
    ends in a reject row without bytes. Any other failure fails the task, which Spark repeats.
    """
    columns = parts.columns
    extra = [
        pa.field("offset", pa.int64()),
        pa.field("bytes", pa.binary()),
        pa.field(algo, pa.string()),
        pa.field("reject_reason", pa.string()),
        pa.field("attempt", pa.string()),
    ]

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()

        def emit(batch, rows, values):
            taken = batch.take(pa.array(rows, pa.int64()))
            arrays = list(taken.columns)
            arrays += [pa.array([v[i] for v in values], f.type) for i, f in enumerate(extra)]
            return pa.RecordBatch.from_arrays(arrays, schema=_arrow_type(batch, extra))

        def pieces(url, start, end):
            """(offset, bytes, digest, reason) rows of one part."""
            try:
                f = reader.open(url)
            except NOT_READABLE:
                yield start, None, None, "SourceMissing"
                return
            state, low = new_hash(algo), start
            while True:
                high = min(low + cell_bytes, end)
                data = b"".join(read_range(f, low, high))
                state.update(data)
                if low + len(data) < high:
                    yield low, None, None, "ShortRead"
                    return
                yield low, data, state.hexdigest() if high >= end else None, None
                if high >= end:
                    return
                low = high

        try:
            for batch in batches:
                urls, starts, ends = (batch.column(columns.index(c)).to_pylist() for c in ("url", "start", "end"))
                rows, values, held = [], [], 0
                for i, (url, start, end) in enumerate(zip(urls, starts, ends)):
                    attempt = uuid.uuid4().hex
                    for value in pieces(url, start, end):
                        rows.append(i)
                        values.append((*value, attempt))
                        held += len(value[1] or b"")
                        if held >= BATCH_BYTES:
                            yield emit(batch, rows, values)
                            rows, values, held = [], [], 0
                if rows:
                    yield emit(batch, rows, values)
        finally:
            reader.close()

    schema = T.StructType(
        list(parts.schema.fields)
        + [
            T.StructField("offset", T.LongType()),
            T.StructField("bytes", T.BinaryType()),
            T.StructField(algo, T.StringType()),
            T.StructField("reject_reason", T.StringType()),
            T.StructField("attempt", T.StringType()),
        ]
    )
    return spread_ranges(parts, key, tasks, order).mapInArrow(read_all, schema)


def digest_ranges(parts: DataFrame, key: str = "object_id", algo: str = "md5", tasks: int | None = None) -> DataFrame:
    """Digest of the range [start, end) of url for each row, NULL where the file is too short.

    The bytes stay in the worker, one buffer at a time.
    """
    columns = parts.columns

    def digest_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        try:
            for batch in batches:
                urls, starts, ends = (batch.column(columns.index(c)).to_pylist() for c in ("url", "start", "end"))
                found = []
                for url, start, end in zip(urls, starts, ends):
                    state, got = new_hash(algo), 0
                    try:
                        f = reader.open(url)
                    except NOT_READABLE:
                        found.append(None)
                        continue
                    for data in read_range(f, start, end):
                        state.update(data)
                        got += len(data)
                    found.append(state.hexdigest() if got == end - start else None)
                extra = [pa.field(algo, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found, pa.string())], schema=_arrow_type(batch, extra)
                )
        finally:
            reader.close()

    schema = T.StructType([*parts.schema.fields, T.StructField(algo, T.StringType())])
    return spread_ranges(parts, key, tasks).mapInArrow(digest_all, schema)
