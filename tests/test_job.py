"""Registry (K27) and nightly job (K28) behaviour, including sinks and cadence."""

import datetime as dt
import os
import subprocess
import sys
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from kpiloom.operators.cohort import CohortSpec
from kpiloom.plans.job import KpiJob, Team
from kpiloom.sources.published import Entry, Published, new_run
from kpiloom.plans.registry import STATUSES, MetricRegistry, MetricSpec, TWIN_REGISTRY

C = CohortSpec(("site", "eth", "gender"))


def test_registry_statuses_and_naming():
    assert len(STATUSES) == 6
    bad = MetricRegistry([
        MetricSpec("AA2_3", "x", "In Dashboard", "aa", "aa_x", "aa_x_denom"),
        MetricSpec("AA_2_4", "x", "Done", "aa", "bb_y", "total"),
    ])
    probs = bad.validate(strict=False)
    assert any("id is not" in p for p in probs)
    assert any("unknown status" in p for p in probs)
    assert any("lacks area prefix" in p for p in probs)
    assert any("must end in _denom" in p for p in probs)
    with pytest.raises(ValueError):
        bad.validate()
    with pytest.raises(ValueError):
        MetricRegistry([MetricSpec("A_1_1", "x", "In Dashboard", "a", "a_n"),
                        MetricSpec("A_1_1", "x", "In Dashboard", "a", "a_m")])


def test_registry_percent_columns(spark):
    reg = MetricRegistry([MetricSpec("SD_1_1", "o", "In Dashboard", "sd", "sd_male", "sd_male_denom")])
    df = spark.createDataFrame([("W8", 30, 60), ("TDC", 25, 0)], "site string, sd_male long, sd_male_denom long")
    reg.validate(df)
    got = {r["site"]: r["sd_male_percent"] for r in reg.add_percent_columns(df).collect()}
    assert got == {"W8": 0.5, "TDC": None}
    assert reg.to_frame(spark).count() == 1
    assert TWIN_REGISTRY.validate(strict=False) == []


def test_job_writes_tables_and_reuses_monthly(spark):
    rows = [("X", "A", "M", 1), ("X", "A", "F", 2)]
    schema = "site string, eth string, gender string, v int"
    base = spark.createDataFrame(rows, schema)
    calls = {"monthly": 0}

    def monthly():
        calls["monthly"] += 1
        return base.groupBy(*C.dims).agg(F.sum("v").cast("bigint").alias("om_records"))

    p = KpiJob(spine=lambda sh: base.select(*C.dims).distinct(),
                 teams=[Team("t1", lambda sh: sh["base"].groupBy(*C.dims).agg(F.count("v").alias("t1_n"))),
                        Team("om", lambda sh: monthly(), cadence="monthly")], cohort=C,
                 shared={"base": lambda: base})
    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    wide = p.run("2021-03-05", sink=sink)
    first = sorted(map(tuple, wide.collect()))         # run 2 overwrites these files
    assert len(first) == 2 and calls["monthly"] == 1
    published = Published(spark, sink)
    assert set(published.paths()) == {"join_prep", "t1", "om", "team_kpi_table"}
    assert os.path.isdir(published.folder(published.manifest()["run"]) + "/_shared_base")
    assert published.snapshot("om", "2021-03") == published.paths()["om"]
    wide2 = p.run("2021-03-06", sink=sink)                 # not the 5th: snapshot reused
    assert calls["monthly"] == 1
    assert sorted(map(tuple, wide2.collect())) == first
    p.run("2021-04-05", sink=sink)
    assert calls["monthly"] == 2


def test_checkpoint_dir_is_shared_setting(spark):
    from kpiloom.session import ensure_checkpoint_dir, shared_dir
    d = ensure_checkpoint_dir(spark)
    assert d
    assert shared_dir(spark, "x").endswith("/tables/x")


def test_cluster_conf_sizes_partitions():
    from kpiloom.session import cluster_conf
    conf = cluster_conf(4 << 40, executor_cores=1, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (4 << 40) // (256 << 20)
    assert int(cluster_conf(100 << 40, 8, 1000)["spark.sql.shuffle.partitions"]) <= 24_000
    small = cluster_conf(1 << 30, executor_cores=8, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 240     # three waves of 80 cores


def test_shared_stage_keeps_its_partitioning(spark):
    big = spark.range(0, 4000, numPartitions=4).withColumn("k", F.col("id") % 7)
    p = KpiJob(spine=lambda sh: big.select(F.lit("X").alias("site"), F.lit("A").alias("eth"),
                                        F.lit("M").alias("gender")).distinct(),
               teams=[], cohort=C, shared={"facts": lambda: big})
    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    p.run("2021-03-06", sink=sink)
    run = Published(spark, sink).manifest()["run"]
    files = [f for f in os.listdir(os.path.join(sink, "runs", run, "_shared_facts")) if f.endswith(".parquet")]
    assert len(files) == 4                       # not coalesced to one file


def test_parallel_team_writes_equal_sequential(spark):
    from kpiloom.plans.commerce import twin_nightly_job
    from kpiloom.sources.commerce import Commerce
    from tests.conftest import SF001
    t = Commerce(spark, SF001)
    a = tempfile.mkdtemp(prefix="kpiloom-par-", dir="/tmp")
    par = twin_nightly_job(t, sink=a)
    from unittest.mock import patch
    with patch("kpiloom.plans.job.ThreadPoolExecutor", side_effect=lambda max_workers: ThreadPoolExecutor(1)):
        lazy = twin_nightly_job(Commerce(spark, SF001), sink=tempfile.mkdtemp(prefix="kpiloom-seq-", dir="/tmp"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, par.select(*lazy.columns).collect())) == sorted(map(key, lazy.collect()))


def test_a_new_catalog_sees_files_that_landed(spark):
    from kpiloom.sources.catalog import ParquetCatalog
    root = tempfile.mkdtemp(prefix="kpiloom-cat-", dir="/tmp")
    spark.range(3).write.parquet(f"{root}/t")
    a = ParquetCatalog(spark, root, suffix="")
    assert a.table("t") is a.table("t") and a.table("t").count() == 3
    spark.range(5).write.mode("append").parquet(f"{root}/t")
    assert ParquetCatalog(spark, root, suffix="").table("t").count() == 8


def test_missed_monthly_day_is_caught_up_and_errors_are_not_hidden(spark):
    base = spark.createDataFrame([("X", "A", "M", 1)], "site string, eth string, gender string, v int")
    built = []

    def monthly(sh):
        built.append(1)
        return base.groupBy(*C.dims).agg(F.sum("v").cast("bigint").alias("om_records"))

    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")

    def job():                                           # a new job object, as in another application
        return KpiJob(spine=lambda sh: base.select(*C.dims).distinct(), cohort=C,
                      teams=[Team("om", monthly, cadence="monthly")])

    job().run("2021-03-20", sink=sink)                   # first run: March's snapshot
    job().run("2021-04-04", sink=sink)                   # still March's
    assert len(built) == 1
    job().run("2021-04-09", sink=sink)                   # the run on the 5th was missed
    assert len(built) == 2
    assert [r["as_of"].isoformat() for r in Published(spark, sink).manifests().orderBy("committed").collect()] == [
        "2021-03-20", "2021-04-04", "2021-04-09"]


def test_failed_run_leaves_the_published_tables(spark):
    base = spark.createDataFrame([("X", "A", "M", 1)], "site string, eth string, gender string, v int")
    good = Team("t1", lambda sh: base.groupBy(*C.dims).agg(F.count("v").alias("n")))
    bad = Team("t2", lambda sh: base.groupBy(*C.dims).agg(F.sum(F.raise_error(F.lit("no"))).alias("m")))
    spine = lambda sh: base.select(*C.dims).distinct()
    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    KpiJob(spine=spine, teams=[good], cohort=C).run("2021-03-05", sink=sink)
    before = Published(spark, sink).paths()
    with pytest.raises(Exception):
        KpiJob(spine=spine, teams=[good, bad], cohort=C).run("2021-03-06", sink=sink)
    assert Published(spark, sink).paths() == before
    assert Published(spark, sink).table("t1").count() == 1


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from kpiloom.session import build_session
from kpiloom.operators.cohort import CohortSpec
from kpiloom.plans.job import KpiJob, Team
spark = build_session(master="local[2]", shuffle_partitions=2, driver_memory="1g")
C = CohortSpec(("site", "eth", "gender"))
base = spark.createDataFrame([("X", "A", "M", 2)], "site string, eth string, gender string, v int")
one = Team("t1", lambda sh: base.groupBy(*C.dims).agg(F.max("v").alias("n")))
two = Team("t2", lambda sh: os._exit(9))
KpiJob(spine=lambda sh: base.select(*C.dims).distinct(), teams=[one, two], cohort=C, parallel_teams=1).run("2021-03-06", sink={sink!r})
"""


def test_a_run_killed_between_two_tables_leaves_a_whole_old_set(spark):
    base = spark.createDataFrame([("X", "A", "M", 1)], "site string, eth string, gender string, v int")
    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    teams = [Team("t1", lambda sh: base.groupBy(*C.dims).agg(F.max("v").alias("n"))),
             Team("t2", lambda sh: base.groupBy(*C.dims).agg(F.max("v").alias("m")))]
    KpiJob(spine=lambda sh: base.select(*C.dims).distinct(), teams=teams, cohort=C).run("2021-03-05", sink=sink)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    died = subprocess.run([sys.executable, "-c", KILLED.format(root=root, sink=sink)], capture_output=True, timeout=300)
    assert died.returncode == 9
    runs = os.listdir(os.path.join(sink, "runs"))
    assert len(runs) == 2                                # the killed run's table lies there ...
    published = Published(spark, sink)
    assert published.manifests().count() == 1            # ... and no reader finds it
    assert [published.table(t).first()[-1] for t in ("t1", "t2")] == [1, 1]
    KpiJob(spine=lambda sh: base.select(*C.dims).distinct(), teams=teams, cohort=C).run("2021-03-06", sink=sink)
    assert published.manifests().count() == 2


def test_half_written_snapshot_and_manifest_are_not_read(spark):
    base = spark.createDataFrame([("X", "A", "M", 1)], "site string, eth string, gender string, v int")
    built = []

    def monthly(sh, day):
        built.append(day.isoformat())
        return base.groupBy(*C.dims).agg(F.sum("v").cast("bigint").alias("om_records"))

    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    os.makedirs(os.path.join(sink, "runs", "20210305-dead", "om", "_temporary"))
    os.makedirs(os.path.join(sink, "manifests", "20210305-dead", "_temporary", "0"))
    with open(os.path.join(sink, "manifests", "20210305-dead", "_temporary", "0", "part-0.json"), "w") as half:
        half.write('{"run":"20210305-dead","as_of":"2021-03-05","committed":9999999999999999999')
    job = KpiJob(spine=lambda sh: base.select(*C.dims).distinct(), cohort=C, teams=[Team("om", cadence="monthly", build_on=monthly)])
    job.run("2021-04-02", sink=sink)
    assert built == ["2021-03-05"]                       # March's numbers, though built in April
    job.run("2021-04-03", sink=sink)
    job.run("2021-04-08", sink=sink)
    assert built == ["2021-03-05", "2021-04-05"]


def test_old_runs_stay_readable_and_runs_do_not_meet(spark):
    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    published = Published(spark, sink)
    with pytest.raises(LookupError):
        published.table("t")
    names = []
    for n, day in enumerate((dt.date(2021, 3, 5), dt.date(2021, 3, 6), dt.date(2021, 3, 6))):
        run = new_run(day)
        spark.range(n + 1).write.parquet(f"{published.folder(run)}/t")
        names.append(run)
    for run, day in zip(names, (dt.date(2021, 3, 5), dt.date(2021, 3, 6), dt.date(2021, 3, 6))):
        published.commit(run, day, {"t": Entry(f"{published.folder(run)}/t")})
    assert len(set(names)) == 3
    assert published.table("t").count() == 3
    assert published.table("t", run=names[1]).count() == 2
    assert published.table("t", as_of=dt.date(2021, 3, 5)).count() == 1
    with pytest.raises(LookupError):
        published.table("other")
    with pytest.raises(Exception):
        published.commit(names[0], dt.date(2021, 3, 5), {})      # a run is committed once
