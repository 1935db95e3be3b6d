"""Progress of downloads: an append-only table in which the last record of a slot counts.

Progress belongs to the destination: a record with one counts for it, whatever number a manifest gives
the object. A record without a destination belongs to every object with its number.
A record with part_num -1 begins a download with its part size and etag, and makes all earlier
slots of the object void. One without a part size says that the object has no progress any more.

The files of the table are deltas. compact_progress puts what still counts in a snapshot, `_snapshots/v<n>`, which
names the deltas it covers and counts from the moment that list is whole; reading takes the last snapshot and the
deltas beside it. So what is read grows with the downloads under way and not with those that are finished.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.functions.skew import salted_join
from partwise.sources.files import filesystem_of
from partwise.sources.scratch import materialise
from partwise.sources.segments import delete_segments

SCHEMA = (
    "object_id bigint, part_size bigint, etag string, part_num bigint, md5 string, recorded_at timestamp, "
    "destination string"
)
COLUMNS = ["object_id", "part_size", "etag", "part_num", "md5", "recorded_at", "destination"]
HEADER = -1
NO_MD5 = "0" * 32
SNAPSHOTS = "_snapshots"  # Spark passes over names like this when it reads a folder
# Deltas from which on a download compacts the journal first, if they are larger than the snapshot.
COMPACT_AT = 64


def _append(rows: DataFrame, table: str) -> None:
    stamped = rows if "recorded_at" in rows.columns else rows.withColumn("recorded_at", F.current_timestamp())
    if "destination" not in stamped.columns:
        stamped = stamped.withColumn("destination", F.lit(None).cast("string"))
    stamped.select(*COLUMNS).write.mode("append").parquet(table)


def create_journal(spark: SparkSession, table: str) -> None:
    spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(table)


def begin_progress(objects: DataFrame, table: str) -> None:
    """objects: object_id, part_size, etag and, if any, destination of the downloads that start from nothing."""
    destination = [c for c in objects.columns if c == "destination"]
    header = objects.select(
        "object_id", "part_size", "etag", F.lit(HEADER).cast("bigint").alias("part_num"), F.lit(NO_MD5).alias("md5"), *destination
    )
    _append(header, table)


def journal_progress(df: DataFrame, table: str) -> None:
    """Append finished parts; rows without recorded_at get the time of the job."""
    bad = F.raise_error(F.lit("an MD5 has 32 digits"))
    _append(df.withColumn("md5", F.when(F.length("md5") == 32, F.col("md5")).otherwise(bad)), table)


def end_progress(objects: DataFrame, table: str) -> None:
    """The objects are finished: nothing of their progress is to be used again."""
    begin_progress(
        objects.select(
            "object_id", F.lit(None).cast("bigint").alias("part_size"), F.lit(None).cast("string").alias("etag"),
            *[c for c in objects.columns if c == "destination"],
        ),
        table,
    )


def _last_records(rows: DataFrame) -> DataFrame:
    """The last record of each slot, with the last header (_h) of its destination, or object where it has none.

    The latest record of a slot is found before the shuffle, however often a slot was written.
    """
    place = F.coalesce("destination", F.lit(""))  # no path is empty
    number = F.when(place == "", F.col("object_id")).otherwise(F.lit(0).cast("bigint"))
    last = (
        rows.groupBy(place.alias("_place"), number.alias("_number"), "part_num")
        .agg(F.max_by(F.struct("object_id", "part_size", "etag", "md5", "recorded_at"), F.struct("recorded_at", "md5")).alias("_r"))
        .select("_place", "_number", "_r.object_id", "_r.part_size", "_r.etag", "part_num", "_r.md5", "_r.recorded_at")
    )
    headers = last.filter(F.col("part_num") == HEADER).select(
        "_place", "_number", F.struct("part_size", "recorded_at").alias("_h")
    )
    found = salted_join(last, headers, ["_place", "_number"], ["part_num"], "left")
    return found.withColumn("destination", F.nullif("_place", F.lit("")))


def latest_progress(rows: DataFrame) -> DataFrame:
    """One row for each slot of a destination that is not void, headers included."""
    valid = F.col("_h").isNull() | (
        F.col("_h.part_size").isNotNull() & (F.col("recorded_at") >= F.col("_h.recorded_at"))
    )
    return _last_records(rows).filter(valid).drop("_h", "_place", "_number")


def _versions(table: str) -> tuple[list[int], list[int]]:
    """(whole snapshots, all snapshots) in order; there are few."""
    from pyarrow import fs

    filesystem, name, _ = filesystem_of(f"{table}/{SNAPSHOTS}")
    if filesystem.get_file_info(name).type != fs.FileType.Directory:
        return [], []
    found = [f for f in filesystem.get_file_info(fs.FileSelector(name)) if f.base_name.startswith("v")]
    whole = filesystem.get_file_info([f"{f.path}/covers/_SUCCESS" for f in found])
    there = sorted(int(f.base_name[1:]) for f, mark in zip(found, whole) if mark.type == fs.FileType.File)
    return there, sorted(int(f.base_name[1:]) for f in found)


def _sizes(folder: str) -> dict[str, int]:
    """Parquet files right in a folder."""
    from pyarrow import fs

    filesystem, name, _ = filesystem_of(folder)
    found = filesystem.get_file_info(fs.FileSelector(name))
    return {f.base_name: f.size for f in found if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and f.base_name[0] not in "._"}


def _covered(table: str, version: int) -> list[str]:
    from pyarrow import dataset

    filesystem, name, _ = filesystem_of(f"{table}/{SNAPSHOTS}/v{version}/covers")
    return dataset.dataset(name, filesystem=filesystem, format="parquet").to_table().column("file").to_pylist()


def _state(table: str) -> tuple[str | None, dict[str, int]]:
    """(folder of the last whole snapshot, deltas that it does not cover with their sizes)."""
    table = table.rstrip("/")
    while True:
        whole, _ = _versions(table)
        deltas = _sizes(table)
        if not whole:
            return None, deltas
        # A delta that came after the list of covers is read besides it. A newer snapshot may have replaced this one.
        covered = set(_covered(table, whole[-1]))
        if _versions(table)[0][-1] == whole[-1]:
            return f"{table}/{SNAPSHOTS}/v{whole[-1]}/rows", {k: v for k, v in deltas.items() if k not in covered}


def read_journal(spark: SparkSession, table: str) -> DataFrame:
    """The records that may count: those of the last snapshot and of the deltas beside it."""
    snapshot, deltas = _state(table)
    paths = [*([snapshot] if snapshot else []), *(f"{table.rstrip('/')}/{name}" for name in deltas)]
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def compact_progress(spark: SparkSession, table: str) -> None:
    """Write a snapshot of what counts, so that finished downloads and void slots are not read again.

    Other jobs may append meanwhile and readers go on with what they listed: deltas are deleted when the next
    snapshot is whole, and so is the snapshot before. One compaction at a time; after a crash it is run again.
    The mark of a finished download goes with its slots, unless something is left that it makes void: later slots
    of its own, or earlier records without a destination, which may belong to any (and the other way round).
    """
    table = table.rstrip("/")
    whole, every = _versions(table)
    version = every[-1] + 1 if every else 1
    there, rows = sorted(_sizes(table)), read_journal(spark, table)
    last = materialise(_last_records(rows), "journal")
    loose = F.col("destination").isNull()
    mark = (F.col("part_num") == HEADER) & F.col("part_size").isNull()
    left = last.filter(~mark & (F.col("_h").isNull() | (F.col("recorded_at") >= F.col("_h.recorded_at"))))
    since = {r["loose"]: r["at"] for r in left.groupBy(loose.alias("loose")).agg(F.min("recorded_at").alias("at")).collect()}  # two rows
    voids = F.lit(False)
    for kind, at in since.items():
        voids = voids | ((loose != kind) & (F.col("recorded_at") >= F.lit(at)))
    owners = left.select("_place", "_number", F.lit(True).alias("_own")).distinct()
    marks = last.filter(mark).join(owners, ["_place", "_number"], "left").filter(voids | F.col("_own"))
    kept = left.select(*COLUMNS).unionByName(marks.select(*COLUMNS))
    folder = f"{table}/{SNAPSHOTS}/v{version}"
    kept.repartition("destination", "object_id", F.shiftright("part_num", 12)).sortWithinPartitions(
        "destination", "object_id", "part_num"
    ).write.parquet(f"{folder}/rows")
    spark.createDataFrame([(name,) for name in there], "file string").write.parquet(f"{folder}/covers")
    if whole:
        old = [(name, 0) for name in _covered(table, whole[-1])]
        materialise(delete_segments(spark.createDataFrame(old, "segment string, size bigint"), table), "deleted")
    filesystem, name, _ = filesystem_of(f"{table}/{SNAPSHOTS}")
    for gone in every:
        if not whole or gone != whole[-1]:
            filesystem.delete_dir(f"{name}/v{gone}")


def compact_if_grown(spark: SparkSession, table: str, deltas_from: int = COMPACT_AT) -> bool:
    """Compact where there are many deltas and more bytes in them than in the snapshot: each record is
    rewritten some few times, whatever the number of runs."""
    snapshot, deltas = _state(table)
    if len(deltas) < deltas_from or sum(deltas.values()) < (sum(_sizes(snapshot).values()) if snapshot else 0):
        return False
    compact_progress(spark, table)
    return True


def load_progress(spark: SparkSession, table: str, targets: DataFrame | None = None) -> DataFrame:
    """What counts of the journal; with targets (object_id, destination, each once), of those alone.

    With targets, records of a destination get the number that its target has now, and those without a
    destination go by their number. Columns of other names are not taken over.
    """
    rows = read_journal(spark, table)
    if targets is None:
        return latest_progress(rows)
    named = targets.filter("destination is not null").select("destination", F.col("object_id").alias("_now"))
    placed = salted_join(rows.filter("destination is not null"), named, ["destination"], ["part_num"], "inner")
    placed = placed.withColumn("object_id", F.col("_now")).drop("_now")
    loose = salted_join(
        rows.filter("destination is null"), targets.select("object_id"), ["object_id"], ["part_num"], "left_semi"
    )
    # both kinds are of one object from here on, and the later record of a slot counts
    both = placed.select(*COLUMNS).unionByName(loose.select(*COLUMNS))
    return latest_progress(both.withColumn("destination", F.lit(None).cast("string"))).drop("destination")


def remove_progress(progress: DataFrame, published: DataFrame) -> DataFrame:
    """Progress of the objects that are not finished."""
    gone = published.select("object_id").distinct()
    return salted_join(progress, gone, ["object_id"], ["part_num"], "left_anti")
