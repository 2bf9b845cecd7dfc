"""The batch job — build every team table, assemble the wide table.

One scheduled run per night builds the shared stages, the spine and the team
tables, then the wide table that left-joins them onto the spine.  Every table is
written once, into the run's own folder, and read back, which cuts the lineage: a
lost executor re-runs one table, not the whole graph, and the assembly reads small
cohort-grain files.  One manifest publishes them all at the end (``Published``):
readers find all tables of a run or none, a failed run changes nothing for them,
and two runs at once do not meet.

A monthly table changes on its day of the month.  The manifest says which month's
snapshot a run used: a run whose month has a published one uses it where it lies,
and a run whose month has none (the day itself, or later if that run was missed)
builds it with the numbers of the month's own day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators.cohort import CohortSpec, assemble
from kpiloom.plans.incremental import MergeableAggregate, refresh
from kpiloom.sources.published import Entry, Published, new_run
from kpiloom.sources.sinks import forget, write_bucketed, write_table


@dataclass(frozen=True)
class Team:
    """A team table.  ``build`` takes the mapping of shared (materialised)
    tables, ``{name: DataFrame}``, and may ignore it; a monthly team's
    ``build_on``, if given, takes the day of its snapshot too."""

    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    cadence: str = "nightly"        # or "monthly"
    monthly_day: int = 5
    build_on: Callable[[Mapping[str, DataFrame], dt.date], DataFrame] | None = None

    def due(self, as_of: dt.date) -> dt.date:
        """The day whose numbers are current on ``as_of``."""
        if self.cadence == "nightly":
            return as_of
        month = as_of if as_of.day >= self.monthly_day else as_of.replace(day=1) - dt.timedelta(days=1)
        return month.replace(day=self.monthly_day)

    def month(self, as_of: dt.date) -> str:
        return f"{self.due(as_of):%Y-%m}"

    def built(self, shared: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
        return self.build_on(shared, self.due(as_of)) if self.build_on else self.build(shared)


@dataclass(frozen=True)
class Shared:
    """A stage that several teams read: built once a run, before them.

    ``key``: kept co-partitioned by that column.  ``aggregate`` with ``root``:
    brought up to date from the source folder's changed units instead of built
    from all of it."""

    build: Callable[[], DataFrame] | None = None
    key: str | None = None
    aggregate: MergeableAggregate | None = None
    root: str | None = None


@dataclass
class KpiJob:
    spine: Callable[[Mapping[str, DataFrame]], DataFrame]   # gets the shared stages too
    teams: Sequence[Team]
    cohort: CohortSpec
    # Shared stages (e.g. a per-entity profile of a fact table) built once,
    # before the teams, and handed to every team builder as written tables.
    shared: Mapping[str, Shared | Callable[[], DataFrame]] = field(default_factory=dict)
    spine_name: str = "join_prep"
    wide_name: str = "team_kpi_table"
    # Tables made of the written wide table (e.g. its roll-up), published with it.
    after: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    out_partitions: int | None = None  # None: AQE sizes the (small) cohort-grain outputs
    check_unique: bool = True        # assert each written table is unique on the cell
    # Up to this many stages or tables are submitted at once from driver threads.
    parallel_teams: int = 4

    # Buckets of the shared stages that have a key; None: the session's shuffle partitions.
    buckets: int | None = None

    def _written(self, df: DataFrame, folder: str, name: str, partitions: int | None) -> DataFrame:
        """Write and read back."""
        return df.sparkSession.read.parquet(write_table(df, folder, name, partitions))

    def _stage(self, spark: SparkSession, published: Published, folder: str, name: str, stage, tables: dict[str, Entry]) -> DataFrame:
        stage = stage if isinstance(stage, Shared) else Shared(stage)
        if stage.aggregate is not None:
            last = published.manifest()
            known = {t["name"]: t["path"] for t in last["tables"]}.get(f"_units_{name}") if last else None
            fresh = refresh(spark, stage.aggregate, stage.root, folder, spark.read.parquet(known) if known else None)
            tables[f"_units_{name}"] = Entry(fresh.state)
            df = fresh.merged
        else:
            df = stage.build()
        if stage.key:
            return write_bucketed(df, folder, f"_shared_{name}", stage.key, self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        # fact-sized stages keep the plan's own partitioning
        return self._written(df, folder, f"_shared_{name}", None)

    def run(self, as_of, sink: str, spark: SparkSession | None = None) -> DataFrame:
        """Build (or reuse) every table, publish all, return the wide table.

        ``sink`` is a fixed folder on shared storage: readers find the manifests
        there, and the next run the monthly snapshots and partial sums.
        """
        day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
        spark = spark or SparkSession.getActiveSession()
        published, run = Published(spark, sink), new_run(day)
        folder, out = published.folder(run), self.out_partitions
        tables: dict[str, Entry] = {}
        # stages and tables are independent Spark jobs; the threads only wait on them
        with ThreadPoolExecutor(max_workers=max(1, self.parallel_teams)) as pool:
            shared = dict(zip(self.shared, pool.map(
                lambda n: self._stage(spark, published, folder, n, self.shared[n], tables), self.shared), strict=True))

            def one(team: Team) -> tuple[DataFrame, Entry]:
                period = team.month(day) if team.cadence != "nightly" else None
                old = published.snapshot(team.name, period) if period else None
                if old is not None:
                    return spark.read.parquet(old), Entry(old, period)
                return self._written(team.built(shared, day), folder, team.name, out), Entry(f"{folder}/{team.name}", period)

            spine_job = pool.submit(lambda: self._written(self.spine(shared), folder, self.spine_name, out))
            built = list(pool.map(one, self.teams))           # order kept
            spine_df = spine_job.result()
        tables[self.spine_name] = Entry(f"{folder}/{self.spine_name}")
        tables |= {team.name: entry for team, (_, entry) in zip(self.teams, built, strict=True)}
        # written tables are small cohort-grain files: the uniqueness check is
        # cheap there and guards the assembly against a fan-out
        wide = self._written(assemble(spine_df, [df for df, _ in built], self.cohort, check_unique=self.check_unique),
                             folder, self.wide_name, out)
        tables[self.wide_name] = Entry(f"{folder}/{self.wide_name}")
        for name, build in self.after.items():
            tables[name] = Entry(write_table(build(wide), folder, name, out))
        published.commit(run, day, tables)
        for stage in shared.values():
            forget(stage)
        return wide
