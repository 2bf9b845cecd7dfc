"""Work of one task and number of jobs as tables grow."""

import numpy as np

from kpiloom.llm import ngram_jaccard
from kpiloom.llm.ngram_jaccard import components
from kpiloom.plans.student import twin, twin_full
from kpiloom.sources import catalog


def _shuffled_parts(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("RepartitionByExpression [l_orderkey")


def test_great_fact_tables_are_dealt_by_their_rows(spark):
    df = spark.range(100).selectExpr("id % 7 AS l_orderkey", "id")
    dealt = catalog.dealt_by(df, "l_orderkey", task_rows=4)
    assert dealt.rdd.getNumPartitions() == 25
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, df.collect()))
    assert catalog.dealt_by(df, "l_orderkey") is df


def test_sessions_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    rows = {
        "nation": "1 AS n_nationkey, 'N' AS n_name, 1 AS n_regionkey", "region": "1 AS r_regionkey, 'R' AS r_name",
        "customer": "id AS c_custkey, 1 AS c_nationkey, 10D * id AS c_acctbal, 'M' AS c_mktsegment",
        "orders": "id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority, timestamp'1998-05-01' AS o_orderdate",
        "events": "id AS user_id, 'view' AS event_type, 10D AS value",
        "lineitem": "nullif(id % 9, 8) AS l_orderkey, id AS l_partkey, id AS l_suppkey, int(id % 7) AS l_linenumber, double(id) AS l_quantity, "
                    "'R' AS l_returnflag, 'F' AS l_linestatus, timestamp'1998-06-01' AS l_shipdate",
    }
    for table, columns in rows.items():
        spark.sql(f"SELECT {columns} FROM range(60)").write.parquet(f"{tmp_path}/{table}.parquet")
    plain = {m: m.source(spark, str(tmp_path))("class_template") for m in (twin, twin_full)}
    monkeypatch.setattr(catalog.dealt_by, "__defaults__", (2,))
    for module, before in plain.items():
        after = module.source(spark, str(tmp_path))("class_template")
        assert _shuffled_parts(before) == 0 and _shuffled_parts(after) == 1
        assert sorted(map(repr, after.collect())) == sorted(map(repr, before.collect()))


def test_short_edge_lists_take_few_jobs_and_agree_with_long_ones(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-150, 150, (120, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (None, 3)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    spark.sparkContext.setJobGroup("few-edges", "few edges")
    try:
        short = {tuple(r) for r in components(edges).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-edges")) <= 6
    monkeypatch.setattr(ngram_jaccard, "FEW_EDGES", 0)
    assert short == {tuple(r) for r in components(edges).collect()}
    assert components(edges.where("false")).collect() == []
