"""Sinks: Parquet tables, plain or co-partitioned by a key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_table(df: DataFrame, root: str, name: str, partitions: int | None = None) -> str:
    """Overwrite ``<root>/<name>`` and return the path.

    ``partitions`` fixes the file count with a ``repartition`` — a shuffle of
    the (small) final rows.  ``coalesce`` would instead narrow the final
    stage itself, running e.g. a whole aggregation's reduce side in one
    task.  Left unset, AQE's partition coalescing already keeps a small
    result to a few files.  Writing is also the lineage cut the nightly job
    relies on: later stages read the written table back.
    """
    path = f"{root.rstrip('/')}/{name}"
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").parquet(path)
    return path


def write_bucketed(df: DataFrame, root: str, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``<root>/<name>`` as one file per bucket of ``key`` and read it back
    as such: joins and groupings of tables bucketed alike need no exchange.  Rows
    are not sorted within a bucket: a reader would sort them again.

    The table is declared in the session's own catalog (any, the built-in one
    included) under a name of its own; its files are plain Parquet at the path,
    which outlives the session and the declaration (``forget``).  A key that
    holds a great part of the rows makes one great bucket: bucket tables by an
    entity's key, and facts after they are reduced by it.
    """
    table = f"kpiloom_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key)
     .option("path", f"{root.rstrip('/')}/{name}").mode("error").saveAsTable(table))
    out = df.sparkSession.table(table)
    out._kpiloom_table = table
    return out


def forget(df: DataFrame) -> None:
    """Drop the declaration of a bucketed table; the files stay."""
    table = getattr(df, "_kpiloom_table", None)
    if table:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
