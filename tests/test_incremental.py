"""Partial sums per unit of a source: only what changed is read."""

import datetime as dt
import tempfile
from unittest.mock import patch

import pytest
from pyspark.sql import functions as F

from kpiloom.plans import incremental as I
from kpiloom.plans.student import StudentParams, build_all
from kpiloom.plans.student import teams as T
from kpiloom.plans.student.params import CONTACT_COLUMNS, TERM_COLUMNS
from kpiloom.sources.catalog import ParquetCatalog
from kpiloom.sources.published import Published
from kpiloom.sources.sinks import forget, write_bucketed
from tests import student_fixture as fx


def aggregate():
    return I.MergeableAggregate("s", "facts", keys={"who": F.col("who"), "odd": F.col("n") % 2 == 1},
                                sums={"n": F.col("n"), "big": F.when(F.col("n") > 90, F.col("n"))})


def facts(spark, month, rows):
    return spark.createDataFrame([(w, n) for w, n in rows], "who string, n long").withColumn("month", F.lit(month))


def append(df, root):
    df.write.mode("append").partitionBy("month").parquet(root)


def totals(df):
    return sorted(map(tuple, df.select("who", "odd", "n", "big").collect()), key=repr)


@pytest.fixture
def source(spark):
    root = tempfile.mkdtemp(prefix="kpiloom-inc-", dir="/tmp") + "/facts"
    for m in (1, 2, 3):
        append(facts(spark, f"2021-0{m}", [(f"w{k % 4}" if k % 9 else None, k) for k in range(m * 30, m * 30 + 40)]), root)
    return root


def refreshed(spark, root, folder, state=None):
    return I.refresh(spark, aggregate(), root, tempfile.mkdtemp(prefix=folder, dir="/tmp"), spark.read.parquet(state) if state else None)


def test_only_the_new_month_is_read(spark, source):
    first = refreshed(spark, source, "inc-a")
    assert len(first.read) == 3
    assert totals(first.merged) == totals(aggregate().partial(spark.read.parquet(source)))
    append(facts(spark, "2021-04", [("w1", 5), ("w9", 100), (None, 7)]), source)
    second = refreshed(spark, source, "inc-b", first.state)
    assert [p.rsplit("/", 1)[1] for p in second.read] == ["month=2021-04"]
    assert totals(second.merged) == totals(aggregate().partial(spark.read.parquet(source)))
    third = refreshed(spark, source, "inc-c", second.state)
    assert third.read == [] and totals(third.merged) == totals(second.merged)


def test_a_month_that_changed_or_went_is_replaced(spark, source):
    first = refreshed(spark, source, "inc-a")
    append(facts(spark, "2021-02", [("w1", 1000)]), source)              # late rows of an old month
    spark.sql("select 1").count()
    second = refreshed(spark, source, "inc-b", first.state)
    assert [p.rsplit("/", 1)[1] for p in second.read] == ["month=2021-02"]
    assert totals(second.merged) == totals(aggregate().partial(spark.read.parquet(source)))
    kept = tempfile.mkdtemp(prefix="kpiloom-inc-", dir="/tmp") + "/facts"
    append(spark.read.parquet(source).where("month <> '2021-01'"), kept)
    whole = refreshed(spark, kept, "inc-c", second.state)               # other folders: nothing of the old state holds
    assert len(whole.read) == 2 and totals(whole.merged) == totals(aggregate().partial(spark.read.parquet(kept)))


def test_flat_folder_single_file_and_empty_units(spark):
    root = tempfile.mkdtemp(prefix="kpiloom-inc-", dir="/tmp") + "/facts"
    facts(spark, "x", [("a", 1), ("b", 95)]).drop("month").write.parquet(root)
    out = refreshed(spark, root, "inc-a")
    assert totals(out.merged) == totals(aggregate().partial(spark.read.parquet(root)))
    facts(spark, "x", []).drop("month").write.mode("append").parquet(root)
    again = refreshed(spark, root, "inc-b", out.state)
    assert totals(again.merged) == totals(out.merged)
    empty = tempfile.mkdtemp(prefix="kpiloom-inc-", dir="/tmp") + "/facts"
    facts(spark, "x", []).drop("month").write.parquet(empty)
    assert totals(refreshed(spark, empty, "inc-c").merged) == []


def test_rows_rounded_sums_stay_null(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 3)], "who string, n long")
    merged = aggregate().merge(aggregate().partial(rows).unionByName(aggregate().partial(rows)))
    assert sorted(map(tuple, merged.select("who", "n").collect())) == [("a", None), ("b", 6)]


# ------------------------------------------------- the nightly job on files
@pytest.fixture(scope="module")
def warehouse(spark):
    root = tempfile.mkdtemp(prefix="kpiloom-wh-", dir="/tmp")
    for name, df in fx.build(spark).items():
        if name == "class_template":
            df = df.withColumn("month", F.date_format("date_c", "yyyy-MM"))
            df.write.partitionBy("month").parquet(f"{root}/{name}")
        else:
            df.write.parquet(f"{root}/{name}")
    return root


def nights(spark, root, sink, day):
    return T.student_nightly_job(ParquetCatalog(spark, root, suffix=""), StudentParams(as_of=day), sink, spark)


def test_night_after_an_appended_month_reads_that_month_only(spark, warehouse):
    sink, seen = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp"), []
    refresh = I.refresh

    def watched(*a, **k):
        out = refresh(*a, **k)
        seen.append([p.rsplit("/", 1)[1] for p in out.read])
        return out

    with patch("kpiloom.plans.job.refresh", watched):
        nights(spark, warehouse, sink, dt.date(2021, 3, 5))
        extra = spark.read.parquet(f"{warehouse}/class_template").limit(3).withColumn("date_c", F.lit(dt.date(2021, 12, 3)))
        extra.withColumn("month", F.lit("2021-12")).write.mode("append").partitionBy("month").parquet(f"{warehouse}/class_template")
        wide = nights(spark, warehouse, sink, dt.date(2021, 3, 6))
    assert len(seen[0]) > 1 and seen[1] == ["month=2021-12"]
    whole = T.team_kpi_table(ParquetCatalog(spark, warehouse, suffix=""), StudentParams(as_of=dt.date(2021, 3, 6)))
    skip = "OM_incomplete_wsa_records"                    # the month's snapshot
    cols = sorted(set(wide.columns) - {skip})
    assert sorted(map(str, wide.select(cols).collect())) == sorted(map(str, whole.select(cols).collect()))
    assert len(Published(spark, sink).manifests().collect()) == 2


def test_each_large_table_is_read_once_a_run(spark, warehouse):
    """Source reads of a whole run: contacts, terms and sessions once each."""
    reads = []

    class Counted(ParquetCatalog):
        def table(self, name):
            reads.append(name)
            return super().table(name)

        __call__ = table

    sink = tempfile.mkdtemp(prefix="kpiloom-sink-", dir="/tmp")
    T.student_nightly_job(Counted(spark, warehouse, suffix=""), StudentParams(), sink, spark)
    assert reads.count("contact_template") == reads.count("contact_at_template") == 1
    assert "class_template" not in reads                  # by its changed months alone
    stages = T.shared_stages(ParquetCatalog(spark, warehouse, suffix=""))
    for name, columns in (("contact_template", CONTACT_COLUMNS), ("contact_at_template", TERM_COLUMNS)):
        plan = stages[name].build()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 0
        assert set(columns) == set(stages[name].build().columns)


def test_teams_read_no_other_columns_of_the_shared_tables(spark, warehouse):
    """Every team builds on the pruned tables alone (a missing column fails)."""
    src = ParquetCatalog(spark, warehouse, suffix="")
    given = {n: s.build() for n, s in T.shared_stages(src).items() if s.build}
    assert set(build_all(T.Derived(src, given))) == {"join_prep", *T.TEAMS}


def test_joins_per_contact_need_no_exchange(spark, warehouse):
    src, folder = ParquetCatalog(spark, warehouse, suffix=""), tempfile.mkdtemp(prefix="kpiloom-buckets-", dir="/tmp")
    contacts = write_bucketed(src("contact_template").select(*CONTACT_COLUMNS), folder, "c", "contact_id", 4)
    terms = write_bucketed(src("contact_at_template").select(*TERM_COLUMNS), folder, "t", "Contact_Id", 4)
    sessions = write_bucketed(T.class_summary(src), folder, "s", "student_c", 4)
    per = sessions.groupBy("student_c").agg(F.sum("num").alias("num"))
    joined = (contacts.join(terms.select("Contact_Id", "AY_Name", "term_c"), contacts["contact_id"] == terms["Contact_Id"], "left")
              .join(per, contacts["contact_id"] == per["student_c"], "left"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        rows = joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    left = src("contact_template").select(F.col("contact_id").alias("a"))
    right = src("contact_at_template").select(F.col("Contact_Id").alias("b"))
    assert rows == left.join(right, F.col("a") == F.col("b"), "left").count()
    again = spark.read.parquet(f"{folder}/c")             # plain files for any other reader
    assert again.count() == src("contact_template").count()
    for df in (contacts, terms, sessions):
        forget(df)
