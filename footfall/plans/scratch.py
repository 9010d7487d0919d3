"""Intermediate tables of a run, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names.

    Only a local session may go without; it then writes below its warehouse.
    """
    folder = (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").partition("[")[0] == "local":
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/footfall-scratch"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


class Scratch:
    """Tables written once and read back, so that lost executors cost no rerun.

    Being files, they also tell the planner their true size. The folder is new
    each time, even for a run id used before, unless the caller names one and wants
    to ``reuse`` what an earlier call finished there. ``drop`` deletes only that folder.
    """

    def __init__(
        self, spark: SparkSession, run_id: str, folder: str | None = None, reuse: bool = False
    ) -> None:
        self._spark = spark
        self._reuse = reuse
        self._kept: dict[str, DataFrame] = {}
        self.folder = folder or f"{shared_folder(spark)}/footfall-{run_id}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite" if self._reuse else "errorifexists").parquet(path)
        self._kept[name] = self._spark.read.schema(df.schema).parquet(path)
        return self._kept[name]

    def existing(self, name: str) -> DataFrame | None:
        """The table if it was kept here, or written to its end by an earlier call to reuse."""
        path = f"{self.folder}/{name}"
        if name not in self._kept and self._reuse:
            if self._files().exists(self._path(f"{path}/_SUCCESS")):
                self._kept[name] = self._spark.read.parquet(path)
        return self._kept.get(name)

    def part(self, name: str) -> Scratch:
        """Tables in a folder of their own within this one, which can be dropped alone."""
        return Scratch(self._spark, name, f"{self.folder}/{name}-{uuid.uuid4().hex}")

    def forget(self, name: str) -> None:
        """Drop one table."""
        self._kept.pop(name, None)
        self._files().delete(self._path(f"{self.folder}/{name}"), True)

    def drop(self) -> None:
        self._kept.clear()
        self._files().delete(self._path(self.folder), True)

    def _path(self, path: str):
        return self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        conf = self._spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.folder).getFileSystem(conf)
