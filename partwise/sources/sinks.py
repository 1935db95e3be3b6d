"""Writing parts to tables and objects to files."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwise.limits import CHUNK_BYTES
from partwise.operators.locations import RESERVED_SUFFIXES
from partwise.operators.parts import resplit_parts
from partwise.sources.files import NOT_READABLE, Reader, filesystem_of, local_path, partial_path, read_range
from partwise.sources.objects import spread_ranges
from partwise.sources.scratch import materialise
from partwise.sources.segments import SEALED_BYTES, read_segments, write_segments

N_BUCKETS = 64


def bucket_id(key: str) -> Column:
    """Number by which rows of a parts table lie together; a scan for few objects skips the rest."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(N_BUCKETS)).cast("int")


INDEX = (
    "upload_id string, bucket_id int, part_num bigint, start bigint, end bigint, offset bigint, n bigint, md5 string, "
    "is_encrypted boolean, reject_reason string, attempt string, segment string, position bigint, stored bigint"
)


def append_index(places: DataFrame, index: str, keep_n: bool = False) -> None:
    """Append rows that name ranges of segments: the rows of a job are all there or none is.

    Only these narrow rows are shuffled, so that a file of the index holds few buckets.
    """
    columns = [field.split()[0] for field in INDEX.split(", ")]
    if not keep_n and "n" not in places.columns:
        sealed = F.when(F.col("is_encrypted"), SEALED_BYTES).otherwise(0)
        places = places.withColumn("n", F.greatest(F.col("stored") - sealed, F.lit(0)))
    rows = places.select(*columns).repartition("bucket_id").sortWithinPartitions("bucket_id", "upload_id", "part_num", "offset")
    rows.write.mode("append").parquet(index)


def write_parts(df: DataFrame, out: str, key: str = "object_id") -> None:
    """Append parts with bytes to a table: segments of bytes, and an index whose rows are all there or none is.

    A slot (key and part_num, and offset where a part is several rows) that the table has is not entered again,
    nor is one twice that df repeats: writing the same parts another time, or a task that is killed and
    repeated, leaves each slot once.
    """
    spark = df.sparkSession
    rows = df if "bucket_id" in df.columns else df.withColumn("bucket_id", bucket_id(key))
    slot = [key, "part_num", *(["offset"] if "offset" in df.columns else [])]
    written = materialise(write_segments(rows, f"{out}/segments"), "written")
    try:
        there = spark.read.parquet(f"{out}/index").select(*slot)
    except AnalysisException:  # the first write
        there = spark.createDataFrame([], written.select(*slot).schema)
    fresh = written.dropDuplicates(slot).join(there, slot, "left_anti")
    fresh.repartition("bucket_id").sortWithinPartitions("bucket_id", key, "part_num").write.mode("append").parquet(f"{out}/index")


def read_parts(spark: SparkSession, out: str, key: str = "object_id") -> DataFrame:
    """What write_parts wrote. Filter it before it is asked for bytes with parts_index and read_segments."""
    return read_segments(parts_index(spark, out), f"{out}/segments").drop("segment", "position", "stored")


def parts_index(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/index")


def assemble_objects(parts: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(object_id, chunk_no, offset, content): parts (with start, end and bytes) joined in order.

    An object of up to chunk_bytes, also an empty one, is one row. A longer one is several, all but the
    last of them chunk_bytes long, which in order of chunk_no are its content, however long it is.
    """
    return resplit_parts(parts, chunk_bytes).select(
        "object_id", F.col("part_num").alias("chunk_no"), F.col("start").alias("offset"), F.col("bytes").alias("content")
    )


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Small rows that stand for file operations, over all tasks; see spread_ranges."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)


def _open_partial(dst: str):
    """The partial file of a destination, for writing anywhere in it."""
    path = partial_path(dst)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    return os.fdopen(os.open(path, os.O_CREAT | os.O_WRONLY, 0o666), "wb")


class FileWriter:
    """Keeps the last partial file open."""

    def __init__(self) -> None:
        self._dst: str | None = None
        self._file = None

    def open(self, dst: str):
        if dst != self._dst:
            self.close()
            self._file = _open_partial(dst)
            self._dst = dst
        return self._file

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._dst = self._file = None


def write_pieces(parts: DataFrame) -> DataFrame:
    """Write bytes at offset of dst_path's partial file.

    Returns (object_id, part_num, dst_path, offset, n, md5) of each row; md5 is NULL where dst_path
    is a reserved name, and nothing is written. dst_path is on a file system that all executors
    mount. Tasks write different places of one file, so a huge object is written by many; a
    repeated task writes the same bytes again.
    """
    inputs = parts.select("object_id", "part_num", "dst_path", "offset", "bytes")
    reserved = re.compile(RESERVED_SUFFIXES)

    def write_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = FileWriter()
        try:
            for batch in batches:
                lengths, digests = [], []
                for dst, offset, data in zip(
                    batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
                ):
                    buf = data.as_buffer()
                    lengths.append(len(buf))
                    if reserved.search(dst):
                        digests.append(None)
                        continue
                    f = writer.open(dst)
                    f.seek(offset)
                    f.write(buf)
                    digests.append(hashlib.md5(buf).hexdigest())
                writer.close()  # on disk before the batch is reported
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], pa.array(lengths, pa.int64()), pa.array(digests, pa.string())],
                    [*batch.schema.names[:4], "n", "md5"],
                )
        finally:
            writer.close()

    schema = T.StructType(
        inputs.schema.fields[:4] + [T.StructField("n", T.LongType()), T.StructField("md5", T.StringType())]
    )
    return inputs.mapInArrow(write_all, schema)


def write_ranges(parts: DataFrame, key: str = "object_id", tasks: int | None = None) -> DataFrame:
    """Copy the range [start, end) of url to the same place of dst_path's partial file.

    Adds md5, NULL where the source is too short or gone. One pass, one buffer at a time: the bytes are
    never in a row. Otherwise as write_pieces.
    """
    columns = parts.columns

    def opened(reader, url):
        try:
            return reader.open(url)
        except NOT_READABLE:
            return None

    def copy_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, writer = Reader(), FileWriter()
        try:
            for batch in batches:
                picked = [batch.column(columns.index(c)).to_pylist() for c in ("url", "dst_path", "start", "end")]
                digests = []
                for url, dst, start, end in zip(*picked):
                    state, got = hashlib.md5(), 0
                    source, target = opened(reader, url), writer.open(dst)
                    target.seek(start)
                    for data in read_range(source, start, end) if source is not None else ():
                        target.write(data)
                        state.update(data)
                        got += len(data)
                    digests.append(state.hexdigest() if got == end - start else None)
                writer.close()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(digests, pa.string())], schema=pa.schema([*batch.schema, ("md5", pa.string())])
                )
        finally:
            reader.close()
            writer.close()

    schema = T.StructType([*parts.schema.fields, T.StructField("md5", T.StringType())])
    return spread_ranges(parts, key, tasks).mapInArrow(copy_all, schema)


def publish_files(objects: DataFrame) -> DataFrame:
    """Give finished partial files (object_id, dst_path, size) their names; adds published.

    A file that is shorter than its object is left as it is and not published. One of an older,
    longer object is cut. Running it again for a published file changes nothing.
    """

    def rename_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for dst, size in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                path = partial_path(dst)
                if size == 0:
                    _open_partial(dst).close()
                if os.path.exists(path):
                    ready = os.path.getsize(path) >= size
                    if ready:
                        os.truncate(path, size)
                        os.replace(path, dst)
                else:  # an earlier attempt of this task was lost after the rename
                    ready = os.path.exists(dst) and os.path.getsize(dst) == size
                done.append(ready)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(done, pa.bool_())], schema=pa.schema([*batch.schema, ("published", pa.bool_())])
            )

    rows = _dealt(objects.select("object_id", "dst_path", "size"), "dst_path")
    return rows.mapInArrow(rename_all, T.StructType([*rows.schema.fields, T.StructField("published", T.BooleanType())]))


def publish_objects(parts: DataFrame) -> DataFrame:
    """Write parts (object_id, part_num, start, end, bytes, dst_path) to files and name them.

    Returns (object_id, dst_path, size, n_parts, published, reject_reason). A reserved name is
    refused, and an object with a hole in its parts is not named. Nothing has its name before all
    parts of the object are written. The bytes are evaluated once.
    """
    reserved = F.col("dst_path").rlike(RESERVED_SUFFIXES)
    written = materialise(write_pieces(parts.withColumn("offset", F.col("start"))), "written")
    objects = written.groupBy("object_id", "dst_path").agg(
        F.sum("n").alias("size"), F.count("*").alias("n_parts"), F.max(F.col("offset") + F.col("n")).alias("_end")
    )
    whole = objects.filter((F.col("_end") == F.col("size")) & ~reserved)
    named = materialise(publish_files(whole), "published")
    return objects.join(named.select("object_id", "published"), "object_id", "left").select(
        "object_id",
        "dst_path",
        "size",
        "n_parts",
        F.coalesce("published", F.lit(False)).alias("published"),
        F.when(reserved, "InvalidDestinationURL").when(F.col("_end") != F.col("size"), "IncompleteTransfer").alias("reject_reason"),
    )


def file_states(df: DataFrame, path_col: str, size_col: str = "file_size") -> DataFrame:
    """Add the size of the file at path_col, NULL where there is none: a stat in the tasks."""
    index = df.columns.index(path_col)

    def stat_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for path in batch.column(index).to_pylist():
                sizes.append(None if path is None else _size(path))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64())], schema=pa.schema([*batch.schema, (size_col, pa.int64())])
            )

    return _dealt(df, path_col).mapInArrow(stat_all, T.StructType([*df.schema.fields, T.StructField(size_col, T.LongType())]))


def _size(url: str) -> int | None:
    path = local_path(url)
    if path is not None:
        # a folder, or a file that may not be read, is no source
        return os.path.getsize(path) if os.path.isfile(path) and os.access(path, os.R_OK) else None
    from pyarrow import fs

    filesystem, name, _ = filesystem_of(url)
    info = filesystem.get_file_info(name)
    return info.size if info.type == fs.FileType.File else None
