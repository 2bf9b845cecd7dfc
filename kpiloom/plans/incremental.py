"""Incremental aggregates: partial sums kept per unit of a source folder.

A unit is a partition folder (a month of the session facts); files that lie
directly in the source folder form a unit for each day on which they landed.  A
unit's fingerprint covers its files' paths, lengths and times.  A run reads only
units whose fingerprint changed, writes their partial sums, and merges them with
those kept by earlier runs; a unit that went away is left out of the merge.

Which partial sums are current stands in a table ``unit, fingerprint, path``
that is published with the run, so a run that fails leaves the state of the one
before.  Listing reads no data (only the file system's entries), and what comes
to the driver is one row per unit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MergeableAggregate:
    """Rows to sums that can be added up: ``keys`` and ``sums`` are named
    columns of the prepared rows (``prepare`` may reduce or derive columns);
    a sum without any value stays NULL when partial sums are added."""

    name: str
    source: str
    keys: Mapping[str, Column]
    sums: Mapping[str, Column]

    def partial(self, rows: DataFrame, *extra: Column) -> DataFrame:
        keys = [c.alias(n) for n, c in self.keys.items()]
        return rows.groupBy(*extra, *keys).agg(*[F.sum(c).alias(n) for n, c in self.sums.items()])

    def merge(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.keys).agg(*[F.sum(n).cast(partials.schema[n].dataType).alias(n) for n in self.sums])


def _place(path: Column, root: str) -> tuple[Column, Column]:
    """(unit's folder or the file itself, whether it lies in a folder)."""
    name = root.rstrip("/").rsplit("/", 1)[-1]
    inner = F.substring_index(path, f"/{name}/", -1)
    nested = (F.instr(path, f"/{name}/") > 0) & (F.instr(inner, "/") > 0)
    return F.when(nested, F.regexp_replace(path, "/[^/]*$", "")).otherwise(path), nested


def _unit(path: Column, time: Column, root: str) -> Column:
    place, nested = _place(path, root)
    return F.when(nested, place).otherwise(F.concat(F.lit("landed-"), F.date_format(time, "yyyy-MM-dd")))


def units(spark: SparkSession, root: str) -> DataFrame:
    """``unit, fingerprint, places`` of a source folder, from its listing."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(root).select("path", "length", "modificationTime"))
    place, _ = _place(F.col("path"), root)
    return files.groupBy(_unit(F.col("path"), F.col("modificationTime"), root).alias("unit")).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.hex(F.bit_xor(F.xxhash64("path", "length", "modificationTime")))).alias("fingerprint"),
        F.collect_set(place).alias("places"))


@dataclass(frozen=True)
class Refreshed:
    merged: DataFrame           # the aggregate over the whole source
    state: str                  # where the table of units lies
    read: Sequence[str]         # folders or files of the source that were read


def refresh(spark: SparkSession, aggregate: MergeableAggregate, root: str, folder: str, state: DataFrame | None,
            prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Refreshed:
    """Bring the partial sums up to date in ``folder`` (a run's own), given the
    ``state`` of the last published run, and merge them."""
    now = units(spark, root)
    before = state if state is not None else spark.createDataFrame([], "unit string, fingerprint string, path string")
    known = now.join(before.withColumnRenamed("fingerprint", "old"), "unit", "left")
    same = F.coalesce(F.col("old") == F.col("fingerprint"), F.lit(False))
    fresh = f"{folder}/_partials_{aggregate.name}"
    part = F.sha2("unit", 256).alias("part")
    listing = f"{folder}/_listing_{aggregate.name}"     # written: one listing decides what is read and what is kept
    known.select("unit", "fingerprint", "path", "places", (~same).alias("changed"), part).write.mode("overwrite").parquet(listing)
    listed = spark.read.parquet(listing)
    read = sorted(p for r in listed.where("changed").select("places").collect() for p in r[0])
    schema = aggregate.partial(prepare(spark.read.parquet(root).limit(0))).schema
    made = spark.createDataFrame([], "part string")
    if read:
        rows = prepare(spark.read.option("basePath", root).parquet(*read).select("*", "_metadata.file_path", "_metadata.file_modification_time"))
        unit = _unit(F.col("file_path"), F.col("file_modification_time"), root)
        sums = aggregate.partial(rows, F.sha2(unit, 256).alias("part"))
        sums.hint("rebalance", "part").write.partitionBy("part").mode("overwrite").parquet(fresh)
        made = spark.read.schema(f"part string, {schema.fields[0].name} {schema.fields[0].dataType.simpleString()}").parquet(fresh).select("part").distinct()
    made = made.select("part", F.concat(F.lit(f"{fresh}/part="), "part").alias("new"))
    table = f"{folder}/_units_{aggregate.name}"
    # a unit without rows has no partial sums: its path is null
    listed.join(made, "part", "left").select(
        "unit", "fingerprint", F.when(F.col("changed"), F.col("new")).otherwise(F.col("path")).alias("path")).write.mode("overwrite").parquet(table)
    paths = sorted(r[0] for r in spark.read.parquet(table).where("path is not null").select("path").collect())
    kept = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return Refreshed(aggregate.merge(kept), table, read)
