"""Spark side of the scenarios: what lies at the destination, what is unfinished, what is asked.

Every document is an object. The rules on object_id place each object in one of the states an
operator has to tell apart; none of them leaves objects out of the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from partwise.operators.integrity import composite_etags, part_digests
from partwise.operators.parts import split_parts

P = 1024
LINE_P = 10
N_SLOTS = 64

# Keys for tests, one of them as a master key and one too short.
KEYS = [
    ("kA", "-0123456789012345678901234567890", True),
    ("kB", "skdjfh9q4rusidfjs9fjsdr9vkfdh833", False),
    ("kBad", "too-short", False),
]
# Locations with a rule of their own.
LOCATIONS = [
    (-1, "s3://"), (-2, "s3:///k"), (-3, "s3://b"), (-4, "s3://b/"), (-5, "./a:b"), (-6, "/abs/p"),
    (-7, "rel/p"), (-8, "file:/tmp/p"), (-9, "file://localhost/p"), (-10, "file://tmp/p"),
    (-11, "s3://b/k?v=1#f"), (-12, "s3://b_1/a b"), (-13, "../up/./x"), (-14, "/a//b/../c/"),
    (-15, "HTTP://h/a;v=1/b;v=2?q"), (-16, "x.partial"),
]
# Size texts with a rule of their own.
SIZE_TEXTS = [
    "0 ", "1 K", "1 M", "1 Gi", "1 tera", "0.5kilo", "0.1  byte", "1 k", "12 foo", "256MB", "5M",
    "5G", "6G", "1", "", ".", "1.5.2", "7.", ".5 M", "99Y", "8E", "-1",
]
SIZE_UNITS = ["", "K", " M", "Gi", " kilo", "k ", "kibi", "MB", "T", "  mega  "]


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows made in the JVM."""
    made = spark.range(1, numPartitions=1).select(F.inline(F.array(*[F.struct(*map(F.lit, r)) for r in rows])))
    names = [field.split()[0] for field in schema.split(",")]
    types = [field.split()[1] for field in schema.split(",")]
    return made.toDF(*names).select(*[F.col(n).cast(t) for n, t in zip(names, types)])


class Views:
    """Views of one scale factor; each is built when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def objects(self) -> DataFrame:
        content = F.encode("text", "UTF-8")
        return self.table("documents").select(
            F.col("doc_id").alias("object_id"),
            F.col("source").alias("bucket"),
            F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, "us-west-1").otherwise("eu-west-1").alias("location"),
            F.concat("lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("key"),
            content.alias("content"),
            F.length(content).cast("bigint").alias("size"),
        )

    def manifest(self) -> DataFrame:
        """objects without content."""
        return self.objects().drop("content")

    def parts(self) -> DataFrame:
        return split_parts(self.objects().select("object_id", "content"), P)

    def part_digests(self) -> DataFrame:
        return part_digests(self.parts())

    def etags(self) -> DataFrame:
        return composite_etags(self.part_digests())

    def dest(self) -> DataFrame:
        etags = self.etags()
        oid = F.col("object_id")
        stale = F.concat(F.md5(F.lit("stale").cast("binary")), F.lit("-1"))
        known = etags.filter(oid % 4 == 0).select(
            "object_id",
            F.when(oid % 8 == 0, stale).otherwise(F.col("etag")).alias("etag"),
            "size",
            F.when(oid % 12 == 0, "kA").alias("key_id"),
        )
        extra = etags.filter(oid % 50 == 0).select(
            (oid + 1000000).alias("object_id"), "etag", "size", F.lit(None).cast("string").alias("key_id")
        )
        return known.unionByName(extra)

    def dest_keys(self) -> DataFrame:
        """dest without etag and size, so without a look at the content."""
        oid = F.col("object_id")
        return self.manifest().filter(oid % 4 == 0).select("object_id", F.when(oid % 12 == 0, "kA").alias("key_id"))

    def pending(self) -> DataFrame:
        n = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in (0, 1, 1, 2, 0)]), (F.col("object_id") % 5 + 1).cast("int"))
        return (
            self.manifest()
            .withColumn("n", n)
            .filter("n > 0")
            .select("object_id", "bucket", "key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("k"))
            .select(F.concat_ws("-", "object_id", "k").alias("upload_id"), "object_id", "bucket", "key")
        )

    def completed(self) -> DataFrame:
        oid, part = F.col("object_id"), F.col("part_num")
        return (
            self.part_digests()
            .filter((oid % 5).isin(1, 2) & (oid % 10 != 6) & ((part * 3 + oid) % 4 != 0))
            .select(
                F.concat(oid, F.lit("-0")).alias("upload_id"),
                "object_id",
                "part_num",
                F.when((oid % 20 == 11) & (part > 0), part + 100).otherwise(F.col("size")).alias("size"),
                F.col("md5").alias("etag"),
            )
        )

    def requests(self) -> DataFrame:
        oid = F.col("object_id")
        return self.manifest().select(
            "object_id",
            "bucket",
            "key",
            F.when(oid % 3 == 1, "overwrite").when(oid % 3 == 2, "skip").alias("exists"),
            F.when((oid % 7).isin(3, 4, 6), "resume").when(oid % 7 == 5, "force").alias("resume_mode"),
            F.when(oid % 11 == 0, 2048).otherwise(1024).cast("bigint").alias("part_size"),
            F.when(oid % 24 == 0, "kA").alias("key_id"),
        )

    def progress(self) -> DataFrame:
        oid, slot = F.col("object_id"), F.col("object_id") + F.col("part_num")
        kept = self.part_digests().filter((oid % 2 == 0) & (slot % 3 != 0))
        return kept.join(self.etags().select("object_id", "etag"), "object_id").select(
            "object_id",
            F.when(oid % 13 == 0, 2048).otherwise(1024).cast("bigint").alias("part_size"),
            F.when(oid % 10 == 4, "stale-etag").otherwise(F.col("etag")).alias("etag"),
            "part_num",
            F.when(slot % 9 == 0, "0" * 32)
            .when(slot % 7 == 0, F.md5(F.lit("corrupt").cast("binary")))
            .otherwise(F.col("md5"))
            .alias("md5"),
        )

    def download_requests(self) -> DataFrame:
        oid = F.col("object_id")
        return self.manifest().select(
            "object_id",
            F.when(oid % 3 == 1, "overwrite").when(oid % 3 == 2, "skip").alias("file_exists"),
            F.when((oid % 7).isin(2, 3, 4), "resume").when((oid % 7).isin(5, 6), "discard").alias("download_exists"),
            F.lit(P).cast("bigint").alias("part_size"),
        )

    def dest_before(self) -> DataFrame:
        return self.manifest().filter("object_id % 5 = 0").select("object_id")

    def dest_after(self) -> DataFrame:
        return self.manifest().filter("object_id % 5 = 0 or object_id % 17 = 0").select("object_id")

    def locations(self) -> DataFrame:
        pages = self.table("pages").select(F.col("page_id").alias("id"), F.col("url").alias("raw"))
        objects = self.manifest().select("object_id", F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key"))
        fixed = local_rows(self.spark, LOCATIONS, "id bigint, raw string")
        return pages.union(objects).union(fixed)

    def size_texts(self) -> DataFrame:
        units = F.array(*[F.lit(u) for u in SIZE_UNITS])
        made = self.table("lineitem").select(
            F.concat(
                "l_partkey", F.lit("."), "l_linenumber",
                F.element_at(units, (F.col("l_suppkey") % len(SIZE_UNITS) + 1).cast("int")),
            ).alias("raw")
        )
        return made.union(local_rows(self.spark, [(t,) for t in SIZE_TEXTS], "raw string"))

    def attempts(self) -> DataFrame:
        return attempts(self.table("events"))

    def line_parts(self) -> DataFrame:
        order = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"
        )
        return self.all_line_parts(order).filter(~((F.col("upload_id") % 5 == 0) & (F.col("part_num") == 1)))

    def all_line_parts(self, order: Window | None = None) -> DataFrame:
        order = order if order is not None else Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"
        )
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("upload_id"),
            (F.row_number().over(order) - 1).cast("bigint").alias("part_num"),
            F.least("l_quantity", F.lit(LINE_P)).cast("bigint").alias("size"),
        )

    def turn_parts(self) -> DataFrame:
        """Turns of a conversation as the parts of an object."""
        size = F.length(F.encode("text", "UTF-8")).cast("bigint")
        before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
        return (
            self.table("conversations")
            .select(
                F.col("conv_id").alias("object_id"),
                F.col("turn").alias("part_num"),
                F.encode("text", "UTF-8").alias("bytes"),
                F.sum(size).over(before).alias("end"),
            )
            .withColumn("start", F.col("end") - F.length("bytes"))
        )

    def key_table(self) -> DataFrame:
        return local_rows(self.spark, KEYS, "key_id string, key_text string, is_master boolean")

    def keyed_objects(self) -> DataFrame:
        """objects with the key each is stored under; one in four has none."""
        keys = F.array(F.lit("kA"), F.lit("kB"), F.lit("kBad"), F.lit(None).cast("string"))
        return self.objects().withColumn("key_id", F.element_at(keys, (F.col("object_id") % 4 + 1).cast("int")))


def attempts(events: DataFrame) -> DataFrame:
    """Also for a stream of events."""
    return events.select(
        F.col("user_id").alias("upload_id"),
        (F.col("event_id") % N_SLOTS).alias("part_num"),
        F.col("ts").cast("timestamp").alias("recorded_at"),
        "event_id",
        (F.col("event_type") != "error").alias("ok"),
        F.md5(F.col("props").cast("binary")).alias("md5"),
    )
