"""User errors as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.functions.errors import exit_code


def with_exit_code(df: DataFrame, reason_col: str = "error_class") -> DataFrame:
    return df.withColumn("exit_code", exit_code(F.col(reason_col)))


def reject_split(df: DataFrame, reason_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with one as error_class and exit_code).

    The reason is exploded from an array of one: Spark then filters by its value, once for each row. Else it puts the
    rules behind it into the filter, as often as they name each other, in code too long to be compiled.
    """
    judged = df.withColumn(reason_col, F.explode(F.array(reason_col)))
    good = judged.filter(F.col(reason_col).isNull()).drop(reason_col)
    bad = judged.filter(F.col(reason_col).isNotNull()).withColumnRenamed(reason_col, "error_class")
    return good, with_exit_code(bad)
