"""Where results go. A sink is called as ``sink(frame, table_name)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

Sink = Callable[[DataFrame, str], None]

RUN_ID = "taskId"
_STAMPS = (RUN_ID, "task_id")


def stamp_run(df: DataFrame, run_id: str, column: str = RUN_ID) -> DataFrame:
    """Put the run's id in front of every row."""
    return df.select(F.lit(run_id).alias(column), *df.columns)


def append_jdbc(
    df: DataFrame,
    table: str,
    options: Mapping[str, str],
    connections: int = 8,
    batch_size: int = 1000,
) -> None:
    """Append to a JDBC table; url, user, password, driver come from the caller.

    Each partition is one connection and one transaction, and errors propagate.
    If an executor is lost after its commit, Spark writes that partition again:
    rows are delivered at least once, and the run id with the row's own key
    tells a repeat.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("numPartitions", str(connections))
        .option("batchsize", str(batch_size))
        .mode("append")
        .save()
    )


def jdbc_sink(options: Mapping[str, str], **settings: int) -> Sink:
    return lambda df, table: append_jdbc(df, table, options, **settings)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table; rows of a run that are in it already stay as they are.

    So a run that is delivered again after a failure has every row once. Frames without
    a run's stamp are appended whole.
    """
    stamp = next((c for c in df.columns[:1] if c in _STAMPS), None)
    if stamp is not None and df.sparkSession.catalog.tableExists(table):
        there = df.sparkSession.table(table).select(*df.columns)
        df = df.exceptAll(there.where(F.col(stamp).isin(df.select(stamp))))
    df.write.mode("append").saveAsTable(table)


def folder_sink(folder: str) -> Sink:
    """Each result table as Parquet files in a folder of its own, in place of earlier ones."""
    return lambda df, table: df.write.mode("overwrite").parquet(f"{folder}/{table}")
