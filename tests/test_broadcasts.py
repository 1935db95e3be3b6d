"""What Spark may send to all executors through the driver stays small, however many requests a job has."""

from pyspark.sql import functions as F

from partwise.functions.skew import salted_join
from partwise.plans.store import Store
from partwise.sources.scratch import materialise

N = 200_000


def broadcasts(df) -> bool:
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_salted_copies_of_many_rows_are_not_broadcast(spark, tmp_path):
    """an array of salts counts for one row, so 16 copies of 200,000 rows were taken for 2 MB."""
    spark.range(N).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.schema("id bigint").parquet(str(tmp_path / "dim"))
    facts = spark.range(20 * N).select((F.col("id") % N).alias("id"), F.col("id").alias("part"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert not broadcasts(salted_join(facts, dim, ["id"], ["part"], how))
    some = salted_join(facts, dim.filter("id < 1000"), ["id"], ["part"], "left_semi")
    assert some.agg(F.count("*"), F.countDistinct("id"), F.countDistinct("part")).first() == (20000, 1000, 20000)
    few = spark.range(3).withColumn("name", F.lit("k"))
    assert salted_join(facts.filter("part < 64"), few, ["id"], ["part"]).filter("name is not null").count() == 3


def test_written_tables_count_unpacked(spark, tmp_path):
    """by its compressed bytes a table of a million alike rows would be broadcast."""
    Store(spark, str(tmp_path / "store"))
    rows = spark.range(5 * N).select("id", F.lit("s3://copies/").alias("url"), F.lit("NEW").alias("action"))
    table = materialise(rows, "many").select("id", "action")
    asked = spark.range(20 * N).withColumn("asked", F.lit(True))
    assert not broadcasts(asked.join(table, "id", "left"))
    few = materialise(rows.filter("id < 100"), "few").select("id", "action")
    assert asked.join(few, "id", "left").filter("action is not null").count() == 100
