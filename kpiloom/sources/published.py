"""Published tables: versioned run folders and one small manifest a run.

    <sink>/runs/<run>/<table>/       written once, never changed
    <sink>/manifests/<run>/          one row: the run's tables and where they lie

A run's tables count only when its manifest exists.  The manifest is one row in
one file, which Spark's committer renames into place, so readers see all tables
of a run or none: a run killed between two tables, or a half-written folder, is
never read.  Older runs stay readable by name or by date.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = "run string, as_of date, committed long, tables array<struct<name string, path string, period string>>"


@dataclass(frozen=True)
class Entry:
    """A table of a run; ``period`` names the period of a snapshot."""

    path: str
    period: str | None = None


def new_run(as_of: dt.date) -> str:
    return f"{as_of:%Y%m%d}-{uuid.uuid4().hex[:12]}"


class Published:
    """The published tables under ``sink`` (a folder on shared storage)."""

    def __init__(self, spark: SparkSession, sink: str):
        self.spark, self.sink = spark, sink.rstrip("/")

    def folder(self, run: str) -> str:
        return f"{self.sink}/runs/{run}"

    def manifests(self) -> DataFrame:
        """One row per committed run."""
        try:
            return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").json(f"{self.sink}/manifests")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def commit(self, run: str, as_of: dt.date, tables: Mapping[str, Entry]) -> None:
        """Publish ``run``: from here on readers find its tables."""
        row = (run, as_of, time.time_ns(), [(n, e.path, e.period) for n, e in tables.items()])
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("error").json(f"{self.sink}/manifests/{run}")

    def manifest(self, run: str | None = None, as_of: dt.date | None = None) -> Row | None:
        """The named run's manifest, else the last committed one (of a run of
        ``as_of`` or before, if given)."""
        found = self.manifests()
        if run is not None:
            found = found.where(F.col("run") == run)
        if as_of is not None:
            found = found.where(F.col("as_of") <= F.lit(as_of))
        return found.orderBy(F.desc("committed"), F.desc("run")).first()

    def paths(self, run: str | None = None, as_of: dt.date | None = None) -> dict[str, str]:
        row = self.manifest(run, as_of)
        if row is None:
            raise LookupError(f"no published run under {self.sink}" + (f" named {run}" if run else ""))
        return {t["name"]: t["path"] for t in row["tables"]}

    def table(self, name: str, run: str | None = None, as_of: dt.date | None = None) -> DataFrame:
        paths = self.paths(run, as_of)
        if name not in paths:
            raise LookupError(f"{name} is not among the published tables {sorted(paths)}")
        return self.spark.read.parquet(paths[name])

    def snapshot(self, name: str, period: str) -> str | None:
        """Where the last committed run that has ``name`` for ``period`` keeps it."""
        entry = self.manifests().select("committed", "run", F.explode("tables").alias("t")).where(
            (F.col("t.name") == name) & (F.col("t.period") == period))
        row = entry.orderBy(F.desc("committed"), F.desc("run")).select("t.path").first()
        return row[0] if row else None
