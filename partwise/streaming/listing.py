"""A streaming source of new files, empty ones too, whose offset is a position in its own listing.

Each batch lists once, and has some entries in memory at a time. What is new is appended to the listing, a folder of
small files beside the stream's checkpoint, before the position behind it is handed to Spark: so a batch that is repeated,
or the stream when it starts again, finds the same files between the same positions. On a mounted
file system a folder that has not changed since it was listed is not listed again; its files are
not looked at: files should come into it whole, by a rename, as one rewritten in place may be missed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from partwise.sources.files import filesystem_of, local_path

LISTED = pa.schema([("url", pa.string()), ("size", pa.int64()), ("modified_ns", pa.int64())])
# Entries of the listing that one task hands on.
SLICE = 10_000
# Entries that are in memory at a time while a listing is made or read, and most entries of one of its files.
AT_ONCE = 20_000
# A folder written to this shortly before it was listed may change again within the same time stamp.
SETTLED_NS = 2_000_000_000


def _is_partial(name: str) -> bool:
    return name.startswith(".") and name.endswith(".partial")


class _Slice(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class ListingSource(DataSource):
    """spark.readStream.format("partwise_listing"); options path, and log: a folder of the stream's own."""

    @classmethod
    def name(cls) -> str:
        return "partwise_listing"

    def schema(self) -> str:
        return "url string, size bigint, modified_ns bigint"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return ListingReader(self.options["path"], self.options["log"])


class ListingReader(DataSourceStreamReader):
    def __init__(self, path: str, log: str) -> None:
        self.path, self.log = path.rstrip("/") or "/", log.rstrip("/")
        self.seen: np.ndarray | None = None  # sorted hashes: 8 bytes for each file ever listed
        self.position = 0
        self.folders: dict[str, tuple[int, list[str]]] = {}  # when each was last changed, and its subfolders

    # --- the listing on disk: files NUMBER-FIRST.parquet, in order ---

    def _files(self) -> list[tuple[int, str]]:
        from pyarrow import fs

        filesystem, name, _ = filesystem_of(self.log)
        if filesystem.get_file_info(name).type != fs.FileType.Directory:
            return []
        found = [f.path for f in filesystem.get_file_info(fs.FileSelector(name)) if f.base_name.endswith(".parquet")]
        return sorted((int(p.rsplit("/", 1)[-1].removesuffix(".parquet")), p) for p in found)

    def _read(self, path: str) -> pa.Table:
        filesystem, _, _ = filesystem_of(self.log)
        return pq.read_table(path, filesystem=filesystem, schema=LISTED)

    def _append(self, rows: list[tuple]) -> None:
        filesystem, name, _ = filesystem_of(self.log)
        filesystem.create_dir(name, recursive=True)
        table = pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), LISTED)], schema=LISTED)
        done = f"{name}/{self.position:020}.parquet"
        with filesystem.open_output_stream(done + ".tmp") as out:
            pq.write_table(table, out)
        filesystem.move(done + ".tmp", done)
        self.position += len(rows)

    def _load(self) -> None:
        if self.seen is None:
            self.seen = np.empty(0, np.int64)
            for first, path in self._files():
                table = self._read(path)
                for batch in table.to_batches(max_chunksize=AT_ONCE):
                    self._unseen(list(zip(*[c.to_pylist() for c in batch.columns])))
                self.position = first + table.num_rows

    def _unseen(self, rows: list[tuple]) -> list[tuple]:
        """Those of rows that were not seen before; now they are."""
        hashes = np.fromiter(map(hash, rows), np.int64, len(rows))
        hashes, firsts = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.seen, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.seen)
        new[inside] = self.seen[at[inside]] != hashes[inside]
        self.seen = np.insert(self.seen, at[new], hashes[new])
        return [rows[i] for i in firsts[new]]

    # --- what there is ---

    def _mounted(self, base: str) -> Iterator[tuple]:
        waiting = [base]
        while waiting:
            folder = waiting.pop()
            try:
                changed = os.stat(folder).st_mtime_ns
                known = self.folders.get(folder)
                if known is not None and known[0] == changed:
                    waiting += known[1]
                    continue
                entries = os.scandir(folder)
            except FileNotFoundError:
                continue
            below, newest = [], changed
            with entries:
                for e in entries:
                    if e.is_dir(follow_symlinks=False):
                        below.append(e.path)
                    elif e.is_file() and not _is_partial(e.name):
                        info = e.stat()
                        newest = max(newest, info.st_mtime_ns)
                        yield e.path, info.st_size, info.st_mtime_ns
            now = self._now()
            if now - newest > SETTLED_NS:
                self.folders[folder] = (changed, below)
            waiting += below

    def _now(self) -> int:
        import time

        return time.time_ns()

    def _listed(self) -> Iterator[tuple]:
        from pyarrow import fs

        path = local_path(self.path)
        if path is not None:
            yield from self._mounted(path)
            return
        filesystem, name, prefix = filesystem_of(self.path)
        waiting = [name]
        while waiting:
            for f in filesystem.get_file_info(fs.FileSelector(waiting.pop())):
                if f.type == fs.FileType.Directory:
                    waiting.append(f.path)
                elif f.type == fs.FileType.File and not _is_partial(f.base_name):
                    yield prefix + f.path, f.size, f.mtime_ns

    # --- the source ---

    def initialOffset(self) -> dict:
        return {"position": 0}

    def latestOffset(self) -> dict:
        self._load()
        found = self._listed()
        while rows := list(islice(found, AT_ONCE)):
            if fresh := self._unseen(rows):
                self._append(sorted(fresh))
        return {"position": self.position}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, last = start["position"], end["position"]
        return [_Slice(low, min(low + SLICE, last)) for low in range(first, last, SLICE)]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        files = self._files()
        for i, (first, path) in enumerate(files):
            behind = files[i + 1][0] if i + 1 < len(files) else None
            if first < partition.last and (behind is None or behind > partition.first):
                low = max(partition.first - first, 0)
                yield from self._read(path).slice(low, partition.last - first - low).to_batches()

    def commit(self, end: dict) -> None:
        pass


def new_objects(spark: SparkSession, directory: str, log: str) -> DataFrame:
    """Stream of (url, size, modified_ns) of files below directory that were not there, or not so, before.

    Files of size 0 are files; partial files of this library are not. log is the folder of the listing.
    """
    spark.dataSource.register(ListingSource)
    return spark.readStream.format("partwise_listing").option("path", directory).option("log", log).load()
