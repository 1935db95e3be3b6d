"""Running state of uploads from a stream of part results in any order.

Reports are packed by upload and block of parts where they are read, before anything is shuffled. The
state of an upload is a bitmap for each of its blocks, which says what parts were counted: one bit a part,
however often it is reported. When an upload is complete its bitmaps are dropped, and a mark stays so
that late repeats do not begin it anew. This needs the RocksDB state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from partwise.functions.skew import salted_join
from partwise.limits import BLOCK_PARTS

_SLOT = ["upload_id", "part_num"]


def first_reports(parts: DataFrame, delay: str | None = None) -> DataFrame:
    """Each part once. Without delay this is exact and state grows by a row for each part.

    With delay, such as "1 day", a part is forgotten that long after its event time, and a report
    later than that counts again.
    """
    if delay is None:
        return parts.dropDuplicates(_SLOT)
    return parts.withWatermark("recorded_at", delay).dropDuplicatesWithinWatermark(_SLOT)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROGRESS = "upload_id {0}, n_done bigint, bytes_done bigint"
COMPLETE = "upload_id {0}, n_parts bigint"
# The state of a block: its bits as one number would not fit, so as bytes.
BLOCK_BYTES = BLOCK_PARTS // 8


def _packed(parts: DataFrame, bound: bool) -> DataFrame:
    """(upload_id, block, limit, parts, sizes): reports of one block side by side, packed in the tasks that read them."""
    id_type = parts.schema["upload_id"].dataType.simpleString()
    limit = F.col("n_parts") if bound else F.lit(None)
    rows = parts.select(
        "upload_id", F.col("part_num").cast("bigint"), (F.col("size") if "size" in parts.columns else F.lit(0)).cast("bigint").alias("size"),
        limit.cast("bigint").alias("n_parts"),
    ).filter("part_num >= 0")

    def pack(batches):
        import pandas as pd

        for frame in batches:
            frame = frame.drop_duplicates(["upload_id", "part_num"])
            grouped = frame.assign(block=frame["part_num"] // BLOCK_PARTS, part_num=frame["part_num"] % BLOCK_PARTS).groupby(
                ["upload_id", "block"], sort=False, dropna=False
            )
            found = [(u, b, g["n_parts"].iloc[0], g["part_num"].tolist(), g["size"].tolist()) for (u, b), g in grouped]
            yield pd.DataFrame(found, columns=["upload_id", "block", "n_parts", "parts", "sizes"])

    return rows.mapInPandas(pack, f"upload_id {id_type}, block bigint, n_parts bigint, parts array<bigint>, sizes array<bigint>")


class _Counted(StatefulProcessor):
    """Counts each part of an upload once. With completion it reports an upload when all its parts are in."""

    def __init__(self, completion: bool) -> None:
        self.completion = completion

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getMapState("blocks", "block bigint", "bits binary")
        self.totals = handle.getValueState("totals", "n bigint, bytes bigint, complete boolean")

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np
        import pandas as pd

        n, size, complete = self.totals.get() if self.totals.exists() else (0, 0, False)
        before, limit, bits = n, None, {}
        for frame in rows:
            if complete:
                continue
            for block, n_parts, parts, sizes in zip(frame["block"], frame["n_parts"], frame["parts"], frame["sizes"]):
                limit = None if pd.isna(n_parts) else int(n_parts)
                if block not in bits:
                    held = self.blocks.getValue((int(block),)) if self.blocks.containsKey((int(block),)) else (b"",)
                    bits[block] = np.unpackbits(np.frombuffer(bytes(held[0]).ljust(BLOCK_BYTES, b"\0"), np.uint8))
                parts, sizes = np.asarray(parts, np.int64), np.asarray(sizes, np.int64)
                new = bits[block][parts] == 0
                bits[block][parts[new]] = 1
                n, size = n + int(new.sum()), size + int(sizes[new].sum())
        if complete or n == before:
            return
        done = self.completion and n == limit
        if done:
            self.blocks.clear()
        else:
            for block, row in bits.items():
                self.blocks.updateValue((int(block),), (np.packbits(row).tobytes(),))
        self.totals.update((n, size, done))
        if not self.completion:
            yield pd.DataFrame({"upload_id": [key[0]], "n_done": [n], "bytes_done": [size]})
        elif done:
            yield pd.DataFrame({"upload_id": [key[0]], "n_parts": [limit]})

    def close(self) -> None:
        pass


def _by_upload(packed: DataFrame, schema: str, completion: bool) -> DataFrame:
    id_type = packed.schema["upload_id"].dataType.simpleString()
    return packed.groupBy("upload_id").transformWithStateInPandas(
        statefulProcessor=_Counted(completion), outputStructType=schema.format(id_type), outputMode="Update", timeMode="None"
    )


def stream_progress(parts: DataFrame, delay: str | None = None) -> DataFrame:
    """(upload_id, n_done, bytes_done), for update mode; parts: upload_id, part_num, size, recorded_at.

    Without delay each part counts once for ever, for one bit of state. With it see first_reports.
    """
    if delay is None:
        return _by_upload(_packed(parts, False), PROGRESS, False)
    return (
        first_reports(parts, delay)
        .groupBy("upload_id")
        .agg(F.count("*").alias("n_done"), F.sum("size").alias("bytes_done"))
    )


def stream_completion(parts: DataFrame, plans: DataFrame) -> DataFrame:
    """(upload_id, n_parts) once, when the last part of an upload is in; for update mode.

    plans is a table of upload_id and n_parts. Parts outside the plan do not count. A complete upload
    keeps a mark of some bytes, and repeats of its parts, however late, change nothing.
    """
    planned = salted_join(parts, plans.select("upload_id", "n_parts"), ["upload_id"], ["part_num"], "inner")
    inside = planned.filter((F.col("part_num") >= 0) & (F.col("part_num") < F.col("n_parts")))
    return _by_upload(_packed(inside, True), COMPLETE, True)


def write_changes(state: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Writer that keeps the changes of each batch; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    # For streams that are started from here on; the state of bitmaps is kept in no other store.
    state.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def read_state(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The last change of each upload."""
    changes = spark.read.schema(f"{schema}, batch_id bigint").parquet(out)
    values = [c for c in changes.columns if c not in ("upload_id", "batch_id")]
    return (
        changes.groupBy("upload_id")
        .agg(F.max_by(F.struct(*values), "batch_id").alias("_s"))
        .select("upload_id", *[F.col(f"_s.{c}").alias(c) for c in values])
    )
