"""Stored bytes as append-only segment files, and a narrow index of what lies where in them.

A task appends the bytes of its rows to segments of its own and hands on rows without bytes: segment,
position and length. Those rows are the index; a job commits them all or none. What a task wrote that
was killed or repeated is in no index, so nothing sees it, and it is collected later. Rows of the
index are planned, filtered and shuffled instead of bytes; bytes are read last, range by range.
"""

from __future__ import annotations

import hashlib
import os
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwise.limits import BATCH_BYTES, MAX_CELL_BYTES
from partwise.sources.files import Reader, filesystem_of, local_path, read_range

# A segment is closed when it has so many bytes.
SEGMENT_BYTES = 1024**3
# Bytes of rows that wait for their segment to be closed.
HELD_BYTES = 2 * BATCH_BYTES
# What AES-GCM adds to each row: an IV of 12 bytes and a tag of 16.
SEALED_BYTES = 28

PLACE = [T.StructField("segment", T.StringType()), T.StructField("position", T.LongType()), T.StructField("stored", T.LongType())]


class _Segments:
    """Appends to one new file after the other in a folder."""

    def __init__(self, folder: str) -> None:
        self.folder, self._file, self._name, self._at = folder, None, None, 0

    def _open(self):
        path = local_path(self.folder)
        self._name, self._at = f"{uuid.uuid4().hex}.segment", 0
        if path is not None:
            os.makedirs(path, exist_ok=True)
            return open(os.path.join(path, self._name), "wb")
        filesystem, name, _ = filesystem_of(self.folder)
        return filesystem.open_output_stream(f"{name}/{self._name}")

    def begin(self) -> tuple[str, int]:
        """(segment, position) of what is appended next."""
        if self._at >= SEGMENT_BYTES:
            self.close()
        if self._file is None:
            self._file = self._open()
        return self._name, self._at

    def append(self, data) -> None:
        self._file.write(data)
        self._at += len(data)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._file, self._at = None, 0


def _names(batch: pa.RecordBatch, without: str | None = None) -> list[str]:
    return [c for c in batch.schema.names if c != without]


def write_segments(rows: DataFrame, folder: str) -> DataFrame:
    """rows with segment, position and stored (bytes) instead of `bytes`; NULL where bytes is NULL.

    No file is seen by a reader before the rows that name it are committed.
    """

    def write_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, done, held = _Segments(folder), [], 0
        try:
            for batch in batches:
                places = []
                for cell in batch.column("bytes"):
                    if not cell.is_valid:
                        places.append((None, None, None))
                        continue
                    data = cell.as_buffer()
                    places.append((*segments.begin(), len(data)))
                    segments.append(data)
                names = _names(batch, "bytes")
                added = [pa.array([p[i] for p in places], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
                # Copies: the columns of a batch share one buffer, and with any of them its bytes would be held too.
                narrow = batch.select(names).take(pa.array(range(batch.num_rows), pa.int64()))
                done.append(pa.RecordBatch.from_arrays([*narrow.columns, *added], [*names, *[f.name for f in PLACE]]))
                held += done[-1].nbytes
                if len(done) >= 64 or held >= HELD_BYTES:
                    segments.close()
                    yield from done
                    done, held = [], 0
            segments.close()  # on disk before the last rows are reported
            yield from done
        finally:
            segments.close()

    kept = [f for f in rows.schema.fields if f.name != "bytes"]
    return rows.mapInArrow(write_all, T.StructType([*kept, *PLACE]))


def read_segments(ranges: DataFrame, folder: str) -> DataFrame:
    """ranges with the bytes of [position, position + stored) of segment, in their order and partitions."""
    folder = folder.rstrip("/")

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()

        def emit(batch, first, values):
            part = batch.slice(first, len(values))
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.binary())], [*batch.schema.names, "bytes"])

        try:
            for batch in batches:
                first, values, held = 0, [], 0
                places = zip(*[batch.column(f.name).to_pylist() for f in PLACE])
                for segment, position, stored in places:
                    data = None
                    if segment is not None:
                        data = b"".join(read_range(reader.open(f"{folder}/{segment}"), position, position + stored)) if stored else b""
                        if len(data) != stored:
                            raise OSError(f"segment {segment} ends before {position + stored}")
                    values.append(data)
                    held += len(data or b"")
                    if held >= BATCH_BYTES:
                        yield emit(batch, first, values)
                        first, values, held = first + len(values), [], 0
                if values:
                    yield emit(batch, first, values)
        finally:
            reader.close()

    return ranges.mapInArrow(read_all, T.StructType([*ranges.schema.fields, T.StructField("bytes", T.BinaryType())]))


def move_ranges(ranges: DataFrame, folder: str) -> DataFrame:
    """Copy ranges (segment, position, stored) into new segments: adds new_segment and new_position.

    The bytes are in no row.
    """
    folder = folder.rstrip("/")

    def move_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, segments, done = Reader(), _Segments(folder), []
        try:
            for batch in batches:
                places = []
                for segment, position, stored in zip(*[batch.column(f.name).to_pylist() for f in PLACE]):
                    places.append(segments.begin())
                    moved = 0
                    for data in read_range(reader.open(f"{folder}/{segment}"), position, position + stored):
                        segments.append(data)
                        moved += len(data)
                    if moved != stored:
                        raise OSError(f"segment {segment} ends before {position + stored}")
                added = [pa.array([p[0] for p in places], pa.string()), pa.array([p[1] for p in places], pa.int64())]
                done.append(pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "new_segment", "new_position"]))
            segments.close()
            yield from done
        finally:
            reader.close()
            segments.close()

    fields = [T.StructField("new_segment", T.StringType()), T.StructField("new_position", T.LongType())]
    return ranges.mapInArrow(move_all, T.StructType([*ranges.schema.fields, *fields]))


def join_cells(rows: DataFrame, key: str, cell_bytes: int = MAX_CELL_BYTES, algo: str = "md5") -> DataFrame:
    """Consecutive rows of one part (key, part_num) as few rows as cells allow, the last with the digest of the part.

    rows has offset and bytes, each part's in order within a partition. All other columns are those of the
    part's first row. A part with a row without bytes becomes one row without bytes and digest.
    """
    from partwise.operators.integrity import new_hash

    columns = [c for c in rows.columns if c not in ("offset", "bytes")]

    def join_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun, held, at, state, broken, out, waiting = None, None, [], 0, None, False, [], 0

        def flush(last):
            digest = state.hexdigest() if last and not broken else None
            out.append((begun, at, None if broken else b"".join(held), digest))

        def batch_of():
            firsts = pa.Table.from_batches([b.slice(i, 1) for (b, i), *_ in out]).combine_chunks().to_batches()[0]
            arrays = [firsts.column(c) for c in columns]
            arrays += [pa.array([o[i] for o in out], t) for i, t in ((1, pa.int64()), (2, pa.binary()), (3, pa.string()))]
            return pa.RecordBatch.from_arrays(arrays, [*columns, "offset", "bytes", algo])

        for batch in batches:
            picked = [batch.column(c).to_pylist() for c in (key, "part_num", "offset")]
            for i, (who, part, offset) in enumerate(zip(*picked)):
                data = batch.column("bytes")[i].as_py()
                if (who, part) != current:
                    if current is not None:
                        flush(True)
                    current, begun, held, at, state, broken = (who, part), (batch, i), [], offset, new_hash(algo), False
                broken = broken or data is None
                if broken:
                    held = []
                    continue
                state.update(data)
                while sum(map(len, held)) + len(data) > cell_bytes:
                    room = cell_bytes - sum(map(len, held))
                    held.append(data[:room])
                    data = data[room:]
                    flush(False)
                    waiting += cell_bytes
                    at, held = at + cell_bytes, []
                held.append(data)
                waiting += len(data)
                if waiting >= BATCH_BYTES and out:
                    yield batch_of()
                    out.clear()
                    waiting = 0
        if current is not None:
            flush(True)
        if out:
            yield batch_of()

    kept = [f for f in rows.schema.fields if f.name in columns]
    added = [T.StructField("offset", T.LongType()), T.StructField("bytes", T.BinaryType()), T.StructField(algo, T.StringType())]
    return rows.mapInArrow(join_all, T.StructType([*kept, *added]))


def write_file_parts(rows: DataFrame) -> DataFrame:
    """Write rows (object_id, part_num, dst_path, offset, bytes) in place, each part's in order within a partition.

    Returns (object_id, part_num, dst_path, offset, n, md5) of each part: however many rows it came in, its
    bytes are digested as they pass. A repeated task writes the same bytes again.
    """
    from partwise.sources.sinks import FileWriter

    inputs = rows.select("object_id", "part_num", "dst_path", "offset", "bytes")

    def write_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, current, first, n, state, types = FileWriter(), None, None, 0, None, None
        names = ["object_id", "part_num", "dst_path", "offset", "n", "md5"]

        def report(done):
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*done), types)]
            return pa.RecordBatch.from_arrays(arrays, names)

        try:
            for batch in batches:
                types, done = [*[f.type for f in batch.schema][:4], pa.int64(), pa.string()], []
                picked = [batch.column(c).to_pylist() for c in names[:4]]
                for (who, part, dst, offset), cell in zip(zip(*picked), batch.column("bytes")):
                    if (who, part) != current:
                        if current is not None:
                            done.append((*current, *first, n, state.hexdigest()))
                        current, first, n, state = (who, part), (dst, offset), 0, hashlib.md5()
                    data = cell.as_buffer()
                    f = writer.open(dst)
                    f.seek(offset)
                    f.write(data)
                    state.update(data)
                    n += len(data)
                if done:
                    writer.close()  # on disk before it is reported
                    yield report(done)
            writer.close()
            if current is not None:
                yield report([(*current, *first, n, state.hexdigest())])
        finally:
            writer.close()

    fields = [*inputs.schema.fields[:4], T.StructField("n", T.LongType()), T.StructField("md5", T.StringType())]
    return inputs.mapInArrow(write_all, T.StructType(fields))


def list_segments(spark: SparkSession, folder: str) -> DataFrame:
    """(segment, size, age in seconds) of all segment files, listed by a task."""

    def list_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for url in batch.column(0).to_pylist():
                filesystem, name, _ = filesystem_of(url)
                if filesystem.get_file_info(name).type != fs.FileType.Directory:
                    continue
                found = [f for f in filesystem.get_file_info(fs.FileSelector(name)) if f.base_name.endswith(".segment")]
                for low in range(0, len(found), 10_000):
                    some = found[low : low + 10_000]
                    ages = [max(0, int(time.time() - f.mtime_ns / 1e9)) for f in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f.base_name for f in some]), pa.array([f.size for f in some], pa.int64()), pa.array(ages, pa.int64())],
                        ["segment", "size", "age"],
                    )

    one = spark.range(1, numPartitions=1).select(F.lit(folder.rstrip("/")).alias("url"))
    return one.mapInArrow(list_all, "segment string, size bigint, age bigint")


def delete_segments(segments: DataFrame, folder: str) -> DataFrame:
    """segments (segment, size) once their files are gone; deleting one again changes nothing."""
    folder = folder.rstrip("/")

    def delete_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base, _ = filesystem_of(folder)
        for batch in batches:
            for name in batch.column("segment").to_pylist():
                try:
                    filesystem.delete_file(f"{base}/{name}")
                except FileNotFoundError:
                    pass
            yield batch

    rows = segments.select("segment", "size")
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "segment").mapInArrow(delete_all, rows.schema)
