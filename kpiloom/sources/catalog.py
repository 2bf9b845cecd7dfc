"""Bind logical table names to Parquet folders.

The reference addresses warehouse tables by name; here a catalog maps each
name to a Parquet path.  Reads are lazy: only the columns a query selects are
read (``ReadSchema``) and filters reach the scan (``PushedFilters``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: Rows of a fact table that one task joins and groups, about.
TASK_ROWS = 500_000


def dealt_by(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` partitioned by ``key`` into as many parts as its rows need, so that
    a task's rows stay the same however large the table gets; a table of fewer
    parts than the session runs at once is left as it is.  Counting reads the
    files' footers only."""
    parts = -(-df.count() // task_rows)
    return df.repartition(parts, key) if parts > df.sparkSession.sparkContext.defaultParallelism else df


def read_table(spark: SparkSession, root: str, name: str, suffix: str = ".parquet") -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}{suffix}")


@dataclass
class ParquetCatalog:
    """``name -> DataFrame``; ``overrides`` lets tests bind in-memory frames.

    Tables live at ``<root>/<name><suffix>`` (a file or a folder of parts).
    """

    spark: SparkSession
    root: str
    overrides: dict[str, DataFrame] = field(default_factory=dict)
    suffix: str = ".parquet"
    _read: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}{self.suffix}"

    def table(self, name: str) -> DataFrame:
        """One relation per catalog: a new catalog lists the files anew."""
        if name in self.overrides:
            return self.overrides[name]
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.root, name, self.suffix)
        return self._read[name]

    __call__ = table
