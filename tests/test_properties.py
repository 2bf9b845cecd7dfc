"""Property tests: each fused/rewritten operator equals the literal plan it
replaces, on random small inputs (Spark on both sides)."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag, ratio
from kpiloom.operators.cohort import CohortSpec
from kpiloom.operators.links import existence_flags
from kpiloom.operators.rates import average_support, entity_rate, period_weights

SETTINGS = settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
C = CohortSpec(("site", "eth", "gender"))

students = st.sampled_from(["s1", "s2", "s3", "s4"])
terms = st.sampled_from(["T1", "T2", "T3"])
qty = st.integers(min_value=0, max_value=5).map(float)


@SETTINGS
@given(facts=st.lists(st.tuples(students, terms, qty, qty), min_size=1, max_size=25),
       cat=st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), terms, st.booleans()),
                    min_size=0, max_size=12))
def test_weighted_rate_equals_literal_join(spark, facts, cat):
    f = spark.createDataFrame(facts, "student string, gterm string, n double, d double")
    t = spark.createDataFrame(cat, "at string, gterm string, keep boolean").filter("keep")
    fused = entity_rate(f, "student", F.col("n"), F.col("d"), period="gterm",
                        weights=period_weights(t, "gterm"))
    literal = (f.join(t, "gterm").groupBy("student")
               .agg(F.sum("n").alias("num_sum"), F.sum("d").alias("den_sum"))
               .withColumn("rate", ratio("num_sum", "den_sum")))
    got = sorted(tuple(r) for r in fused.select("student", "num_sum", "den_sum", "rate").collect())
    want = sorted(tuple(r) for r in literal.select("student", "num_sum", "den_sum", "rate").collect())
    assert got == want


@SETTINGS
@given(kids=st.lists(st.tuples(st.sampled_from(["p1", "p2", "p3", None]),
                               st.sampled_from(["Accepted", "Wait-listed", "Denied", None]),
                               st.sampled_from(["Best Fit", "Good Fit", None])), max_size=20))
def test_existence_flags_equal_per_flag_semijoins(spark, kids):
    parents = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p4",)], "pid string")
    children = spark.createDataFrame(kids, "fk string, status string, fit string")
    preds = {"acc": lambda: F.col("status") == "Accepted",
             "best": lambda: (F.col("fit") == "Best Fit") & (F.col("status") != "Denied")}
    fused = existence_flags(parents, "pid", children, "fk", {n: p() for n, p in preds.items()})
    got = {r["pid"]: (r["acc"], r["best"]) for r in fused.collect()}
    for name, i in (("acc", 0), ("best", 1)):
        hits = {r["fk"] for r in children.filter(preds[name]()).select("fk").collect()}
        for pid, flags in got.items():
            assert flags[i] == (1 if pid in hits else 0)


cells = st.tuples(st.sampled_from(["X", "Y"]), st.sampled_from(["A", "B"]), st.sampled_from(["M", "F", None]))


@SETTINGS
@given(sess=st.dictionaries(cells, st.integers(1, 9).map(float), min_size=1, max_size=6),
       notes=st.dictionaries(cells, st.integers(0, 5), max_size=6),
       need=st.dictionaries(cells, st.integers(1, 4), max_size=6))
def test_site_grain_support_equals_literal_fanout(spark, sess, notes, need):
    cell = "site string, eth string, gender string"
    s = spark.createDataFrame([(*k, v) for k, v in sess.items()], f"{cell}, sessions double")
    n = spark.createDataFrame([(*k, v) for k, v in notes.items()], f"{cell}, notes long")
    d = spark.createDataFrame([(*k, v) for k, v in need.items()], f"{cell}, need_count long")
    got = {tuple(r[k] for k in C.dims): r["avg_support"]
           for r in average_support(s, n, d, C, "site", "site").collect()}
    # literal: sessions ⟕ notes ON site only, SUM(sessions + notes), ⋈ need on the full cell
    nn = n.select(F.col("site").alias("n_site"), "notes")
    lit = (s.join(nn, s["site"] == nn["n_site"], "left").groupBy("site", "eth", "gender")
           .agg(F.sum(F.col("sessions") + F.col("notes")).alias("tot")))
    dd = d.select(F.col("site").alias("d_site"), F.col("eth").alias("d_eth"),
                  F.col("gender").alias("d_gender"), "need_count")
    lit = lit.join(dd, (lit["site"] == dd["d_site"]) & (lit["eth"] == dd["d_eth"])
                   & (lit["gender"] == dd["d_gender"]))
    want = {(r["site"], r["eth"], r["gender"]): (None if r["tot"] is None else r["tot"] / r["need_count"])
            for r in lit.collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None and v is None) or abs(got[k] - v) < 1e-9


@SETTINGS
@given(rows=st.lists(st.tuples(students, st.sampled_from(["F19", "W20", "S20", "F20"]), st.booleans()),
                     max_size=20))
def test_persistence_equals_literal(spark, rows):
    from kpiloom.operators.periods import persistence_entities
    t = spark.createDataFrame(rows, "c string, term string, ok boolean").withColumn("site", F.lit("X"))
    base, later = F.col("term") == "F19", F.col("term").isin("W20", "S20", "F20")
    got = {r["c"]: (r["persist_denom"], r["persist_num"]) for r in
           persistence_entities(t, "c", base, F.col("ok"), later, F.col("ok"), CohortSpec(())).collect()}
    # literal: per-term-row LEFT JOIN of the base-term rows, counts per contact
    rg = t.filter(base).select(F.col("c").alias("rc"), flag(F.col("ok")).alias("inc"))
    pat = (t.filter(later).join(rg, t["c"] == rg["rc"], "left").groupBy("c")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(flag(F.col("ok"))).alias("k"), F.max("inc").alias("inc")))
    want = {r["c"]: (1, 1 if r["n"] == r["k"] else 0) for r in pat.filter("inc = 1").collect()}
    assert got == want


answers = st.sampled_from(["10 - extremely likely", "9", "8", "7", "6", "0", None])


@SETTINGS
@given(rows=st.lists(st.tuples(answers), min_size=1, max_size=20))
def test_nps_flags_equal_literal_not_equal_chain(spark, rows):
    from kpiloom.operators.surveys import nps_flags
    df = spark.createDataFrame(rows, "a string")
    fl = nps_flags(F.col("a"), ["10 - extremely likely", "9"], ["8", "7"])
    got = sorted((tuple(r) for r in df.select("a", fl["promoter"].alias("p"),
                                              fl["detractor"].alias("d")).collect()), key=repr)
    df.createOrReplaceTempView("nps_rows")
    want = sorted((tuple(r) for r in spark.sql("""
        SELECT a,
          CASE WHEN (a = '10 - extremely likely' OR a = '9') THEN 1 ELSE 0 END AS p,
          CASE WHEN (a != '10 - extremely likely' AND a != '9' AND a != '8' AND a != '7') THEN 1 ELSE 0 END AS d
        FROM nps_rows""").collect()), key=repr)
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 10).map(float)),
                               st.one_of(st.none(), st.integers(0, 10).map(float))), min_size=1, max_size=20))
def test_three_state_equals_literal_case(spark, rows):
    from kpiloom.functions.indicators import three_state
    df = spark.createDataFrame(rows, "n double, d double")
    got = sorted((tuple(r) for r in df.select("n", "d", three_state("n", "d", 0.8).alias("f")).collect()), key=repr)
    df.createOrReplaceTempView("ts_rows")
    want = sorted((tuple(r) for r in spark.sql("""
        SELECT n, d, CASE WHEN d = 0 THEN NULL WHEN try_divide(n, d) >= 0.8 THEN 1 ELSE 0 END AS f
        FROM ts_rows""").collect()), key=repr)
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["X", "Y"]), st.sampled_from(["9th Grade", "12th Grade", "Year 1"]),
                               st.sampled_from([0, 1, None]), st.sampled_from(["c1", "c2", "c3", None])),
                     min_size=1, max_size=20))
def test_shared_denominators_cube_equals_rows(spark, rows):
    from kpiloom.functions.segments import segment
    from kpiloom.operators.rates import count_cube, shared_denominators
    df = spark.createDataFrame(rows, "site string, grade_c string, indicator_years_since_hs_graduation_c int, cid string")
    spec = CohortSpec(("site",))
    preds = {"senior": segment("senior"), "ninth": segment("ninth_grade")}
    cube = count_cube(df, ["site", "grade_c", "indicator_years_since_hs_graduation_c"], "cid", "n")
    a = sorted((tuple(r) for r in shared_denominators(cube, spec, preds, weight="n").collect()), key=repr)
    b = sorted((tuple(r) for r in shared_denominators(df, spec, preds, entity="cid").collect()), key=repr)
    assert a == b
