from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from footfall.schema import conform

PREVIEW_ROWS = 100


def use_database(spark: SparkSession, database: str | None) -> None:
    """Make the database current; without a name, leave things as they are."""
    if database is not None:
        spark.catalog.setCurrentDatabase(database)


def read_table(
    spark: SparkSession, name: str, schema: StructType, database: str | None = None
) -> DataFrame:
    use_database(spark, database)
    return conform(spark.table(name), schema)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def from_rows(
    spark: SparkSession, rows: Iterable[tuple[object, ...]], schema: StructType
) -> DataFrame:
    """A small literal table, such as a list of cities."""
    return spark.createDataFrame(list(rows), schema)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, *order: str) -> DataFrame:
    """The first n rows: any, read from few files, or by the columns given."""
    return (df.orderBy(*order) if order else df).limit(n)


def replace_table(
    df: DataFrame, name: str, database: str | None = None
) -> DataFrame:
    """Write the frame as a managed table in place of any earlier one.

    Returns the table as read back. The rows are written to a folder of their own
    first. If the table has the same columns already, one change of its catalog entry
    then makes that folder the table's: whoever looks finds the old rows or the new
    ones, and a write that fails leaves the old ones. The files replaced stay until
    the next replacement, for those who still read them. A table that is new or gets
    other columns is written as before, and may be missing for a moment.
    """
    spark = df.sparkSession
    use_database(spark, database)
    first = _first_folder(spark, name)
    home = f"{first}-rows"
    if not spark.catalog.tableExists(name):
        # A table that was replaced and then dropped leaves what its readers may have needed.
        _drop_folders(spark, [first, home] if _has_folder(spark, home) else [])
        df.write.saveAsTable(name)
        return spark.table(name)
    current = _location(spark, name)
    aside = f"{home}/{uuid.uuid4().hex}"
    df.write.parquet(aside)
    if spark.table(name).schema == _nullable(df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{aside}'")
        _drop_folders(spark, _outdated(spark, first, home, {aside, current}))
        return spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    _drop_folders(spark, [first])
    spark.read.schema(df.schema).parquet(aside).write.saveAsTable(name)
    _drop_folders(spark, [home])
    return spark.table(name)


def _nullable(schema: StructType) -> StructType:
    """Columns of a table are nullable, whatever those of its rows are."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def _first_folder(spark: SparkSession, name: str) -> str:
    """Where a managed table of that name is written first."""
    *database, table = name.split(".")
    home = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{home.locationUri.rstrip('/')}/{table.lower()}"


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _has_folder(spark: SparkSession, folder: str) -> bool:
    path, files = _path(spark, folder)
    return files.exists(path)


def _outdated(spark: SparkSession, first: str, home: str, kept: set[str]) -> list[str]:
    """Folders with rows of a table that neither it nor, a moment ago, its readers use."""
    path, files = _path(spark, home)
    names = {folder.rpartition("/")[2] for folder in kept}
    old = [status.getPath().getName() for status in files.listStatus(path)]
    gone = [f"{home}/{name}" for name in old if name not in names]
    return gone if first.rpartition("/")[2] in names else [*gone, first]


def _drop_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path, files = _path(spark, folder)
        files.delete(path, True)
