"""What a run has delivered, kept beside its intermediate tables in the shared folder.

Every entry is an empty folder, and making one either happens or does not. So a driver
may die at any point: the next call with the same run id sees what was delivered.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from footfall.plans.scratch import Scratch, shared_folder


class Manifest:
    """The state of the run ``run_id``; ``settings`` are what its results depend on.

    A run id that was used with other settings is an error: its tables would not be
    those of one run. The input tables have to be the same, which nothing checks.
    """

    def __init__(self, spark: SparkSession, run_id: str, settings: Mapping[str, object]) -> None:
        self.folder = f"{shared_folder(spark)}/footfall-run-{run_id}"
        self.tables = Scratch(spark, run_id, f"{self.folder}/tables", reuse=True)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._path = lambda *parts: path("/".join([self.folder, *parts]))
        self._files = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        text = json.dumps(settings, sort_keys=True, default=str)
        own = hashlib.sha256(text.encode()).hexdigest()
        used = self._names("settings")
        if used not in ([], [own]):
            raise ValueError(f"run {run_id} was begun with other settings")
        self._note("settings", own)

    def _note(self, *parts: str) -> None:
        self._files.mkdirs(self._path(*parts))

    def _names(self, part: str) -> list[str]:
        if not self._files.exists(self._path(part)):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(self._path(part))]

    def delivered(self) -> list[str]:
        """Names of the result tables that were delivered in full."""
        return sorted(self._names("delivered"))

    def deliver(self, build, sink, table: str) -> None:
        """Hands ``build()`` to the sink unless that was done before."""
        if table not in self._names("delivered"):
            sink(build(), table)
            self._note("delivered", table)

    def finish(self) -> None:
        """All is delivered: the intermediate tables go, the entries stay."""
        self.tables.drop()


class Unrecorded:
    """A run that is not resumed: everything is delivered once, nothing is left behind."""

    def __init__(self, spark: SparkSession, run_id: str) -> None:
        self.tables = Scratch(spark, run_id)

    def deliver(self, build, sink, table: str) -> None:
        sink(build(), table)

    def finish(self) -> None:
        self.tables.drop()


def written(tables: Scratch, build, name: str) -> DataFrame:
    """The intermediate table ``name``, computed only if no call of this run has written it."""
    existing = tables.existing(name)
    return tables.keep(build(), name) if existing is None else existing
