"""The store: append-only tables of uploads, closed uploads, objects and the index, and segments of bytes.

An object is the parts of the upload that made it, and a part is one row of the index, or several, each
of which names a range of a segment. Completing an upload adds one row to objects; a copy may name the
ranges of another upload. What is current follows from the rows: an upload is pending until it
is closed, and the last row of a key is its object. The index has versions: collecting what is dead
writes a new one, which counts from the moment it is whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.functions.balance import deal_by_bytes
from partwise.functions.skew import block_of, broadcast_if_small, join_by_block, salted_join
from partwise.operators.crypto import attach_keys, decrypted
from partwise.operators.parts import n_parts
from partwise.sources.files import filesystem_of
from partwise.sources.objects import tasks_for
from partwise.sources.scratch import materialise, sizes_as_unpacked
from partwise.sources.segments import SEALED_BYTES, delete_segments, list_segments, move_ranges, read_segments, write_segments
from partwise.sources.sinks import INDEX, append_index, bucket_id

SCHEMAS = {
    "uploads": "upload_id string, bucket string, key string, part_size bigint, initiated timestamp",
    "closed": "upload_id string, how string, closed_at timestamp",
    "objects": "bucket string, key string, location string, upload_id string, size bigint, part_size bigint, "
    "etag string, key_md5_b64 string, published_at timestamp",
}
PARTS = ["upload_id", "bucket_id", "part_num", "start", "end", "offset", "bytes", "md5", "is_encrypted", "reject_reason", "attempt"]
CANCELLED, COMPLETED = "cancelled", "completed"
# A segment with less than this share of live bytes is rewritten when the store is collected.
LEAST_LIVE = 0.5
# Segments that no index names may belong to a job that still runs.
ORPHAN_AGE = 24 * 3600


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        sizes_as_unpacked(spark)

    def create(self) -> "Store":
        for name, schema in SCHEMAS.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self.path(name))
        if not self._versions():
            self.spark.createDataFrame([], INDEX).write.mode("ignore").parquet(self.index_path(0))
        return self

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """A table; `parts` are the rows of the index with their bytes, which are read where they are asked for."""
        if name == "parts":
            return read_segments(self.index(), self.path("segments")).select(*PARTS)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        if name == "parts":
            return self.write(rows)
        columns = [field.split()[0] for field in SCHEMAS[name].split(", ")]
        rows.select(*columns).write.mode("append").parquet(self.path(name))

    # --- index and segments -----------------------------------------------------------------

    def _versions(self) -> list[int]:
        """Versions of the index that are whole; their names are few."""
        from pyarrow import fs

        filesystem, name, _ = filesystem_of(self.path("index"))
        if filesystem.get_file_info(name).type != fs.FileType.Directory:
            return []
        found = [f for f in filesystem.get_file_info(fs.FileSelector(name)) if f.type == fs.FileType.Directory and f.base_name.startswith("v")]
        whole = filesystem.get_file_info([f"{f.path}/_SUCCESS" for f in found])
        return sorted(int(f.base_name[1:]) for f, mark in zip(found, whole) if mark.type == fs.FileType.File)

    def index_path(self, version: int | None = None) -> str:
        if version is None:
            version = self._versions()[-1]
        return f"{self.root}/index/v{version}"

    def index(self) -> DataFrame:
        return self.spark.read.schema(INDEX).parquet(self.index_path())

    def write(self, rows: DataFrame) -> None:
        """Append parts: their bytes to segments, and once all are there their places to the index."""
        append_index(write_segments(rows.select(*PARTS), self.path("segments")), self.index_path())

    def refer(self, rows: DataFrame) -> None:
        """Append rows to the index that name ranges which are there."""
        append_index(rows, self.index_path())

    def pending(self) -> DataFrame:
        closed = self.table("closed").select("upload_id").union(self.table("objects").select("upload_id"))
        return self.table("uploads").join(closed.distinct(), "upload_id", "left_anti")

    def stored_parts(self) -> DataFrame:
        """(upload_id, part_num, size, etag) of all whole parts, from the index."""
        return self.index().filter("md5 is not null and reject_reason is null").select(
            "upload_id", "part_num", (F.col("end") - F.col("start")).alias("size"), F.col("md5").alias("etag")
        )

    def parts_of(self, uploads: DataFrame) -> DataFrame:
        """stored_parts of the given uploads, one row each in uploads."""
        return salted_join(self.stored_parts(), uploads.select("upload_id"), ["upload_id"], ["part_num"], "left_semi")

    def objects(self, named: DataFrame | None = None) -> DataFrame:
        """The current objects, or those that named has (bucket, key) of."""
        values = ["location", "upload_id", "size", "part_size", "etag", "key_md5_b64"]
        rows = self.table("objects")
        if named is not None:
            rows = rows.join(named.select("bucket", "key"), ["bucket", "key"], "left_semi")
        return (
            rows.groupBy("bucket", "key")
            .agg(F.max_by(F.struct(*values), F.struct("published_at", "upload_id")).alias("_o"))
            .select("bucket", "key", *[F.col(f"_o.{c}").alias(c) for c in values])
        )

    def pieces(self, uploads: DataFrame, carry: Sequence[str]) -> DataFrame:
        """Rows of the index, without bytes, with the columns carry of uploads.

        uploads is a materialised table of upload_id, part_size, size and carry. It is repeated for
        each block of an upload's parts, so that a huge upload is many join keys. The buckets, 64
        numbers at most, are a filter of the scan.
        """
        n_blocks = block_of(n_parts(F.col("size"), F.col("part_size")) - 1) + 1
        counted = uploads.agg(F.sum(n_blocks).alias("n"), F.collect_set(bucket_id("upload_id")).alias("b")).first()
        wanted = uploads.select("upload_id", F.col("part_size").alias("_p"), F.col("size").alias("_s"), *carry)
        rows = self.index().filter(F.col("bucket_id").isin(counted["b"]) & F.col("reject_reason").isNull())
        return join_by_block(
            self._closed(rows), wanted, n_parts(F.col("_s"), F.col("_p")), "inner", "upload_id", counted["n"] or 0
        ).drop("_p", "_s")

    def ranges(self, uploads: DataFrame, carry: Sequence[str], part_size: Column) -> DataFrame:
        """What of the segments makes the parts of another size: pieces cut at its borders, on paper.

        Each row is for one part_num of size part_size: the n bytes at offset of the object, which are the
        whole range [position, position + stored) or, where that is sealed, lie `skip` bytes into what it holds.
        """
        first = F.call_function("div", F.col("offset"), part_size)
        last = F.greatest(F.call_function("div", F.col("offset") + F.col("n") - 1, part_size), first)
        cut = self.pieces(uploads, carry).withColumn("part_num", F.explode(F.sequence(first, last)))
        # the empty row that may close a part in several cells holds nothing
        cut = cut.filter("n > 0 or offset = 0")
        low = F.greatest(F.col("offset"), F.col("part_num") * part_size)
        high = F.least(F.col("offset") + F.col("n"), (F.col("part_num") + 1) * part_size)
        into = low - F.col("offset")
        sealed = F.col("is_encrypted")
        return cut.select(
            *carry, "part_num", low.alias("offset"), (high - low).alias("n"), "segment",
            F.when(sealed, F.col("position")).otherwise(F.col("position") + into).alias("position"),
            F.when(sealed, F.col("stored")).otherwise(high - low).alias("stored"),
            F.when(sealed, into).otherwise(F.lit(0)).alias("skip"), "is_encrypted",
        )

    def opened(self, ranges: DataFrame, keyed: DataFrame | None, tasks: int | None = None) -> DataFrame:
        """ranges with their plain bytes, NULL for a wrong key; each part's rows in order in one task.

        keyed holds object_id, object_key, size and part_size. Only rows without bytes are shuffled.
        """
        if keyed is None:
            ranges = ranges.withColumn("object_key", F.lit(None).cast("string"))
        else:
            ranges = attach_keys(ranges, keyed)
        n = tasks or self.spark.sparkContext.defaultParallelism
        dealt = deal_by_bytes(ranges, n, "object_id", F.col("n"), last=["offset"])
        return self.plain(read_segments(dealt, self.path("segments")))

    def plain(self, rows: DataFrame) -> DataFrame:
        """Bytes decrypted and cut; content that is sealed stays unread without a key."""
        content = F.when(F.col("object_key").isNotNull() | ~F.col("is_encrypted"), decrypted(F.col("bytes"), F.col("object_key")))
        part = F.substring(content, (F.col("skip") + 1).cast("int"), F.col("n").cast("int"))
        whole = (F.col("skip") == 0) & (F.length(content) == F.col("n"))
        return rows.withColumn("bytes", F.when(whole, content).otherwise(part)).drop("object_key")

    def _closed(self, rows: DataFrame) -> DataFrame:
        """rows without the leftovers of parts of several cells that broke off: those lack a last row."""
        inner = F.col("md5").isNull()
        if rows.filter(inner).select("upload_id").isEmpty():
            return rows
        attempt = F.coalesce("attempt", F.lit("")).alias("_attempt")
        ends = rows.filter(~inner & (F.col("offset") > F.col("start"))).select("upload_id", "part_num", attempt).distinct()
        ends = broadcast_if_small(ends.withColumn("_whole", F.lit(True)), ends.count())
        found = rows.withColumn("_attempt", attempt).join(ends, ["upload_id", "part_num", "_attempt"], "left")
        return found.filter(~inner | F.col("_whole")).drop("_attempt", "_whole")

    def close(self, uploads: DataFrame, how: str) -> None:
        self.append("closed", uploads.select("upload_id", F.lit(how).alias("how"), F.current_timestamp().alias("closed_at")))

    def bytes_held(self) -> int:
        """Bytes of all segments on disk, whether something names them or not."""
        return list_segments(self.spark, self.path("segments")).agg(F.sum("size")).first()[0] or 0

    # --- collection -------------------------------------------------------------------------

    def reclaim(self, least_live: float = LEAST_LIVE, orphan_age: int = ORPHAN_AGE) -> DataFrame:
        """Delete bytes of cancelled uploads and of objects that were overwritten; a report of one row.

        live are the ranges of pending uploads and of current objects, each counted once however many
        copies name it. Segments without any are deleted; those with a share below least_live are
        rewritten, a range at a time and in no row; others stay as they are. Segments of orphan_age that
        no index names are deleted too. Nothing else may write to the store meanwhile. Run again after a
        crash, it goes on: the new index counts once it is whole, and files go last.

        Report: segments_deleted, segments_rewritten, bytes_freed, bytes_moved, bytes_live.
        """
        folder, version = self.path("segments"), self._versions()[-1]
        index = self.index()
        alive = self.pending().select("upload_id").union(self.objects().select("upload_id")).distinct()
        live = materialise(salted_join(index, alive, ["upload_id"], ["part_num"], "left_semi"), "live")
        held = live.filter("segment is not null").select("segment", "position", "stored").distinct()
        by_segment = held.groupBy("segment").agg(F.sum("stored").alias("live"))
        listed = materialise(list_segments(self.spark, folder), "segments")
        named = index.filter("segment is not null").select("segment", F.lit(True).alias("named")).distinct()
        state = listed.join(by_segment, "segment", "left").join(named, "segment", "left").select(
            "segment", "size", F.coalesce("live", F.lit(0).cast("bigint")).alias("live"),
            (F.col("named").isNotNull() | (F.col("age") >= orphan_age)).alias("known"),
        )
        state = materialise(state.withColumn("sparse", F.expr(f"live > 0 and live < {float(least_live)}D * size")), "state")
        gone = state.filter("sparse or (live = 0 and known)")

        sparse = state.filter("sparse").select("segment")
        moving = held.join(sparse, "segment", "left_semi")
        planned = materialise(moving.withColumn("start", F.col("position")).withColumn("end", F.col("position") + F.col("stored")), "moving")
        dealt = planned.select("segment", "position", "stored").repartition(
            tasks_for(planned), F.col("segment"), F.shiftright("position", 26)
        ).sortWithinPartitions("segment", "position")
        moved = materialise(move_ranges(dealt, folder), "moved")
        fresh = live.join(moved.drop("stored"), ["segment", "position"], "left").withColumns(
            {"segment": F.coalesce("new_segment", "segment"), "position": F.coalesce("new_position", "position")}
        )
        append_index(fresh, self.index_path(version + 1), keep_n=True)
        deleted = materialise(delete_segments(gone, folder), "deleted")
        filesystem, old, _ = filesystem_of(self.index_path(version))
        filesystem.delete_dir(old)
        counts = state.agg(
            F.coalesce(F.sum("live"), F.lit(0)).alias("bytes_live"), F.count_if("sparse").alias("segments_rewritten"),
        )
        freed = deleted.agg(F.count("*").alias("segments_deleted"), F.coalesce(F.sum("size"), F.lit(0)).alias("_deleted"))
        bytes_moved = moved.agg(F.coalesce(F.sum("stored"), F.lit(0)).alias("bytes_moved"))
        return counts.crossJoin(freed).crossJoin(bytes_moved).select(  # one row each
            "segments_deleted", "segments_rewritten", (F.col("_deleted") - F.col("bytes_moved")).alias("bytes_freed"), "bytes_moved", "bytes_live"
        )
