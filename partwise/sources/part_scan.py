"""All parts of the files below a path, or those that meet a condition, as a data source."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from partwise.functions.balance import OPEN_COST, with_task
from partwise.limits import BATCH_BYTES, MAX_CELL_BYTES
from partwise.sources.files import Reader, filesystem_of, read_range
from partwise.sources.objects import scan_objects
from partwise.sources.scratch import materialise, scratch_path

PLAN = ["url", "part_num", "start", "end"]


class PartSource(DataSource):
    """spark.read.format("partwise_parts"): the parts that a plan of scan_parts has.

    Options: plan (a folder with one folder of part rows for each task), tasks (their number), cellBytes,
    withContent ("false" leaves bytes NULL and opens no file). The driver sees numbers of tasks only.
    """

    @classmethod
    def name(cls) -> str:
        return "partwise_parts"

    def schema(self) -> str:
        return "url string, part_num bigint, start bigint, end bigint, offset bigint, bytes binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PartReader(self.options)


class _Task(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


class _PartReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.plan = options["plan"]
        self.tasks = int(options["tasks"])
        self.cell_bytes = int(options.get("cellBytes", MAX_CELL_BYTES))
        self.with_content = options.get("withContent", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Task(i) for i in range(self.tasks)]

    def _parts(self, task: int) -> Iterator[tuple[str, int, int, int]]:
        """Part rows of a task, which may have none, in order."""
        from pyarrow import dataset, fs

        filesystem, path, _ = filesystem_of(f"{self.plan}/_task={task}")
        if filesystem.get_file_info(path).type != fs.FileType.Directory:
            return
        for batch in dataset.dataset(path, filesystem=filesystem, format="parquet").to_batches(columns=PLAN):
            yield from zip(*(batch.column(c).to_pylist() for c in PLAN))

    def read(self, partition: _Task) -> Iterator[pa.RecordBatch]:
        names = [*PLAN, "offset", "bytes"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def batch(rows):
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(columns, names)

        reader, rows, held = Reader(), [], 0
        try:
            for url, part_num, start, end in self._parts(partition.number):
                step = self.cell_bytes if self.with_content else end - start
                for low in range(start, end, step):
                    data = None
                    if self.with_content:
                        high = min(low + step, end)
                        data = b"".join(read_range(reader.open(url), low, high))
                        if len(data) != high - low:
                            raise OSError(f"{url} became shorter while it was read")
                        held += len(data)
                    rows.append((url, part_num, start, end, low, data))
                    if held >= BATCH_BYTES or len(rows) >= 10_000:
                        yield batch(rows)
                        rows, held = [], 0
            if rows:
                yield batch(rows)
        finally:
            reader.close()


def scan_parts(
    spark: SparkSession, path: str, part_size: int, with_content: bool = True,
    partition_bytes: int = 128 * 1024**2, cell_bytes: int = MAX_CELL_BYTES, where: Column | str | None = None,
) -> DataFrame:
    """(url, part_num, start, end, offset, bytes) of the files below path; empty files have no parts.

    A part of more than cell_bytes is several rows; offset is where the bytes of a row begin. where is a condition
    on url, name, size, modified, part_num, start and end: what fails it is neither planned nor opened. Files are
    listed by tasks, and at once; they are opened when the rows are asked for. A prefix sum over the sizes, in order
    of url, cuts the parts into tasks of some partition_bytes: a large file is many tasks, and small ones share one.

    Conditions on the result are met after reading. Spark can hand them to a Python source, but then keeps them
    for all uses of the DataFrame (4.1), and a second use would lack rows.
    """
    if part_size < 1 or cell_bytes < 1:
        raise ValueError("parts and cells have at least one byte")
    last = F.call_function("div", F.col("size") - 1, F.lit(part_size).cast("bigint"))
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part_num")
    parts = scan_objects(spark, path).filter("size > 0").select("url", "name", "size", "modified", numbers)
    start = F.col("part_num") * F.lit(part_size).cast("bigint")
    parts = parts.withColumn("start", start).withColumn("end", F.least(start + part_size, F.col("size")))
    if where is not None:
        parts = parts.filter(where)
    # The sampled ranges are written, so that both passes of the prefix sum see the same.
    ranged = parts.select(*PLAN).repartitionByRange("url", "part_num").withColumn("_range", F.spark_partition_id().cast("bigint"))
    ranged = materialise(ranged, "parts")
    # A file counts as opened once, by its first part here, or that would outweigh many small parts.
    weight = F.col("end") - F.col("start") + F.when(F.col("part_num") == 0, OPEN_COST).otherwise(0)
    total = ranged.agg(F.sum(weight)).first()[0] or 0
    tasks = max(1, -(-total // partition_bytes))
    placed = with_task(ranged, tasks, weight, ["url", "part_num"], F.col("_range")).drop("_range")
    plan = scratch_path(spark, "plan")
    dealt = placed.repartitionById(tasks, F.col("_task")).sortWithinPartitions("_task", "url", "part_num")
    dealt.write.partitionBy("_task").parquet(plan)
    spark.dataSource.register(PartSource)
    return (
        spark.read.format("partwise_parts")
        .option("plan", plan)
        .option("tasks", str(tasks))
        .option("cellBytes", str(cell_bytes))
        .option("withContent", str(with_content).lower())
        .load()
    )
