"""Actions laid out by day: days are read alone and written again alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from footfall.schema import USER_VISIT_ACTION, conform

DAY = "date"


def write_days(actions: DataFrame, path: str, day: str = DAY) -> None:
    """Write the frame's days below ``path``, in place of those days' earlier files.

    Days that the frame has no row of stay as they are, file by file. Rows are dealt to
    tasks by day, and adaptive execution cuts a day with much of the rows into several
    tasks and puts small days together, so files are neither huge nor many.
    """
    dealt = actions.hint("rebalance", day)
    (
        dealt.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def read_days(
    spark: SparkSession, path: str, schema: StructType = USER_VISIT_ACTION
) -> DataFrame:
    """The actions below ``path``. Date conditions on them choose folders before any file is opened."""
    return conform(spark.read.schema(schema).parquet(path), schema)
