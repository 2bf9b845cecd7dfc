"""What the shared stages and the child flags must not do again."""

import tempfile

from pyspark.sql import functions as F

from kpiloom.operators.links import existence_flags
from kpiloom.plans.student import teams as T
from kpiloom.sources.sinks import forget, write_bucketed


def test_existence_flags_evaluate_their_predicates_once(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,), (None,)], "pid long")
    children = spark.createDataFrame([(1, "a"), (1, None), (2, "x"), (None, "a"), (1, "a")], "fk long, raw string")
    seen = children.select("fk", F.expr("CASE raw WHEN 'a' THEN 'Accepted' WHEN 'x' THEN 'Denied' END").alias("status"))
    out = existence_flags(parents, "pid", seen, "fk", {"acc": F.col("status") == "Accepted", "wait": F.col("status") == "Wait-listed"})
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (None, 0, 0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Wait-listed") == 1        # in the aggregate, not in a filter before it too


def test_buckets_are_not_sorted(spark):
    rows = spark.range(40).select((F.col("id") % 7).alias("k"), "id")
    out = write_bucketed(rows, tempfile.mkdtemp(prefix="kpiloom-buckets-", dir="/tmp"), "t", "k", 4)
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {out._kpiloom_table}").collect()}
    assert told["Bucket Columns"] == "[`k`]" and told.get("Sort Columns", "[]") == "[]"
    assert sorted(r["id"] for r in out.collect()) == list(range(40))
    forget(out)


def test_session_summary_is_not_moved_again():
    stages = T.shared_stages(lambda name: None)
    assert stages["class_summary"].key is None
    assert (stages["contact_template"].key, stages["contact_at_template"].key) == ("contact_id", "Contact_Id")
