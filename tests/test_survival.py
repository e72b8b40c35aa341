"""Survival statistics against hand-worked and brute-force results."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitaspan import cox, cox_models, cox_univariable, kaplan_meier, level_counts, logrank, logrank_counts, median_survival, risk_table
from vitaspan.functions.ties import tied_sums
from vitaspan.operators import cox as cox_module

SMALL = [("A", 1.0, 1), ("A", 2.0, 0), ("A", 3.0, 1), ("A", 3.0, 1), ("A", 5.0, 0), ("B", 1.0, 1), ("B", 4.0, 1), ("B", 4.0, 0),
         ("B", 6.0, 1), ("B", None, 1)]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(SMALL, "g string, time double, event int")


@pytest.fixture(scope="module")
def items(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    return li.select("l_linestatus", F.col("l_quantity").alias("time"), (F.col("l_returnflag") == "R").cast("int").alias("event"),
                     (F.col("l_linestatus") == "O").cast("double").alias("o"), (10 * F.col("l_discount")).alias("d10"), "l_tax")


def test_curve_by_hand(small):
    curve = {(r.g, r.time): r for r in kaplan_meier(small, "time", "event", ["g"], conf=True).collect()}
    assert len(curve) == 7
    for key, surv in {("A", 1.0): 4 / 5, ("A", 2.0): 4 / 5, ("A", 3.0): 4 / 15, ("A", 5.0): 4 / 15, ("B", 1.0): 3 / 4,
                      ("B", 4.0): 1 / 2, ("B", 6.0): 0.0}.items():
        assert curve[key].surv == pytest.approx(surv)
    assert (curve["A", 5.0].n_risk, curve["A", 5.0].n_event, curve["A", 5.0].n_censored) == (1, 0, 1)
    assert curve["A", 3.0].std_err == pytest.approx(4 / 15 * math.sqrt(1 / 20 + 2 / 3))
    assert curve["B", 6.0].std_err is None and curve["B", 6.0].lower is None


def test_median_and_risk_table(small, rows):
    assert rows(median_survival(kaplan_meier(small, "time", "event", ["g"]), ["g"])) == [("A", 3.0), ("B", 4.0)]
    assert rows(risk_table(small, "time", "event", [0, 3], ["g"])) == [("A", 0.0, 5, 0), ("A", 3.0, 3, 1), ("B", 0.0, 4, 0), ("B", 3.0, 3, 1)]


def test_curve_never_rises(items):
    curve = kaplan_meier(items, "time", "event", ["l_linestatus"]).orderBy("l_linestatus", "time").collect()
    for a, b in itertools.pairwise(curve):
        assert 0 <= b.surv <= 1 and (a.l_linestatus != b.l_linestatus or b.surv <= a.surv)


def test_logrank_reference_values(items):
    got = {r.l_linestatus: r for r in logrank_counts(items, "time", "event", "l_linestatus").collect()}
    assert got["O"].observed == 1001 and got["O"].expected == pytest.approx(980.6355007387915)
    assert got["O"].variance == pytest.approx(477.28069544466723)
    assert sum(r.observed - r.expected for r in got.values()) == pytest.approx(0, abs=1e-9)
    test = logrank(items, "time", "event", "l_linestatus").head()
    assert test.statistic == pytest.approx(0.868908, abs=1e-6) and test.df == 1
    assert test.p_value == pytest.approx(math.erfc(math.sqrt(test.statistic / 2)))


def test_logrank_group_missing_in_a_slice(spark):
    df = spark.createDataFrame([("s1", "A", 1.0, 1), ("s1", "B", 2.0, 1), ("s2", "A", 1.0, 1), ("s2", "A", 2.0, 0)],
                               "s string, g string, time double, event int")
    got = {r.s: (r.df, r.p_value) for r in logrank(df, "time", "event", "g", ["s"]).collect()}
    assert got["s1"][0] == 1 and got["s2"] == (0, None)


def test_cox_reference_values(items):
    got = {r.term: r for r in cox(items, "time", "event", ["o", "d10"]).collect()}
    assert got["o"].log_hr == pytest.approx(0.039646, abs=1e-6) and got["d10"].log_hr == pytest.approx(-0.043770, abs=1e-6)
    assert got["o"].se == pytest.approx(0.045104, abs=1e-6) and got["d10"].se == pytest.approx(0.077792, abs=1e-6)
    assert got["o"].converged and got["o"].n == 6000


def likelihood(beta, x, time, event, ties):
    eta = x @ beta
    total = 0.0
    for s in sorted(set(time[event == 1])):
        risk, dead = time >= s, (time == s) & (event == 1)
        d, s0, d0 = dead.sum(), np.exp(eta[risk]).sum(), np.exp(eta[dead]).sum()
        total += eta[dead].sum() - sum(math.log(s0 - (l / d if ties == "efron" else 0) * d0) for l in range(d))
    return total


@pytest.mark.parametrize("ties", ["efron", "breslow"])
def test_cox_is_the_maximum(spark, ties):
    r = random.Random(11)
    data = [(float(r.randrange(1, 8)), int(r.random() < 0.6), r.choice("abc"), r.gauss(0, 1)) for _ in range(120)]
    df = spark.createDataFrame(data, "time double, event int, g string, z double").repartition(3)
    fit = cox(df, "time", "event", ["g", "z"], ties=ties).collect()
    assert [(f.term, f.level) for f in fit] == [("g", "a"), ("g", "b"), ("g", "c"), ("z", None)] and fit[0].log_hr is None
    beta = np.array([f.log_hr for f in fit[1:]])
    x = np.array([[g == "b", g == "c", z] for _, _, g, z in data], float)
    time, event = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    best = likelihood(beta, x, time, event, ties)
    assert best == pytest.approx(fit[1].loglik, abs=1e-8)
    for j in range(3):
        h = np.eye(3)[j] * 1e-4
        up, down = likelihood(beta + h, x, time, event, ties), likelihood(beta - h, x, time, event, ties)
        assert abs(up - down) / 2e-4 < 1e-3
        assert -(up - 2 * best + down) / 1e-8 > 0
    again = cox(df.orderBy(F.rand(2)), "time", "event", ["g", "z"], ties=ties).collect()
    assert [f.log_hr for f in again[1:]] == pytest.approx(list(beta), abs=1e-9)


def test_score_test_is_the_logrank_test_without_ties(spark):
    r = random.Random(4)
    df = spark.createDataFrame([(r.random(), int(r.random() < .7), r.choice("ab")) for _ in range(80)], "time double, event int, g string")
    assert cox(df, "time", "event", ["g"]).where("level = 'b'").head().score == pytest.approx(logrank(df, "time", "event", "g").head().statistic)


def test_models_use_their_own_complete_rows(spark):
    r = random.Random(9)
    df = spark.createDataFrame([("s" + str(i % 2), r.random() * 9, int(r.random() < .6), r.choice(["x", "y", None]), r.choice([None, 1.0, 2.0, 3.0]))
                                for i in range(200)], "s string, time double, event int, c string, v double")
    both = cox_univariable(df, "time", "event", ["c", "v"], ["s"]).collect()
    assert {(f.s, f.model) for f in both} == {(s, m) for s in ("s0", "s1") for m in ("c", "v")}
    alone = cox(df.where("s = 's1'"), "time", "event", ["v"]).head()
    same = next(f for f in both if f.s == "s1" and f.model == "v")
    assert same.n == df.where("s = 's1' and v is not null").count() == alone.n
    assert same.log_hr == pytest.approx(alone.log_hr, abs=1e-9) and same.se == pytest.approx(alone.se, abs=1e-9)


def test_level_without_events_is_marked(spark):
    data = [(float(i), 1, "a") for i in range(1, 9)] + [(float(i), 0, "b") for i in range(3, 9)] + [(float(i), 1, "c") for i in range(2, 9)]
    df = spark.createDataFrame(data, "time double, event int, g string")
    fit = {f.level: f for f in cox_models(df, "time", "event", {"m": ["g"]}).collect()}
    assert fit["b"].separable and fit["b"].n_event == 0 and not fit["c"].separable


def test_reference_is_the_first_level_that_occurs(spark):
    r = random.Random(1)
    df = spark.createDataFrame([("s", r.random(), 1, r.choice("bc")) for _ in range(40)] + [("u", r.random(), 1, r.choice("abc")) for _ in range(40)],
                               "s string, time double, event int, g string")
    fit = {(f.s, f.level): f.log_hr for f in cox(df, "time", "event", ["g"], ["s"]).collect()}
    assert ("s", "a") not in fit and fit["s", "b"] is None and fit["s", "c"] is not None and fit["u", "a"] is None


@pytest.fixture(scope="module")
def patterns(spark):
    """One time holds a third of the rows, all with covariates of their own; two slices; some values missing."""
    r = random.Random(11)
    data = [(r.choice("st"), 5.0 if i % 3 == 0 else r.choice([r.uniform(0, 10), float(r.randrange(12))]), int(r.random() < 0.6), r.choice("abc"),
             None if i % 17 == 0 else r.gauss(0, 1), r.uniform(-1, 1)) for i in range(600)]
    return spark.createDataFrame(data, "s string, time double, event int, g string, v double, w double")


@pytest.mark.parametrize("ties", ["efron", "breslow"])
def test_cox_over_many_ranges(patterns, ties):
    """The same estimates from one range, from many, and from ranges that the most frequent time fills alone."""
    def fit(n):
        out = cox_models(patterns, "time", "event", {"all": ["g", "v", "w"], "v": ["v"]}, ["s"], ties, range_rows=n).collect()
        return {(f.s, f.model, f.term, f.level): f for f in out}
    one = fit(10_000)
    for n in (200, 37, 5):
        many = fit(n)
        assert many.keys() == one.keys()
        for k, f in one.items():
            assert many[k].n == f.n and many[k].n_event == f.n_event
            for c in ("log_hr", "se", "p_value", "score", "loglik", "null_loglik"):
                assert getattr(many[k], c) == (None if getattr(f, c) is None else pytest.approx(getattr(f, c), rel=1e-8, abs=1e-9))


def test_cox_steps_do_not_move_the_layout(patterns):
    """The frozen ranges are scanned by Python tasks; there is no exchange, sort or join in a step."""
    slots = {"v": [cox_module._Slot("v")], "g": [cox_module._Slot("g", x) for x in "abc"]}
    frozen, slices = cox_module._layout(patterns, "time", "event", slots, ["s"], 50)
    assert slices == [("s",), ("t",)] and frozen.select("piece").distinct().count() > 8
    text = frozen.mapInArrow(lambda batches: batches, frozen.schema)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Exchange", "Sort", "Join"))
    spans = frozen.groupBy("piece").agg(F.min("time").alias("lo"), F.max("time").alias("hi")).orderBy("piece").collect()
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:])) and sum(a.lo == a.hi == 5.0 for a in spans) >= 2


def test_cox_without_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 1, None, "a"), (2.0, 0, None, "b")], "time double, event int, v double, g string")
    assert cox(df, "time", "event", ["v"]).collect() == []
    assert cox(df.limit(0), "time", "event", ["g"], levels={"g": ["a", "b"]}).collect() == []


@pytest.mark.parametrize("s, e, d", [(10.0, 3.0, 5), (7.0, 1e-30, 4), (2.0, 2.0, 1), (64.0, 1.0, 31), (63.9, 1.0, 33), (1e6, 9e5, 5000), (5000.0, 5000.0, 5000), (1e9, 1e3, 100_000), (3e4, 2.9e4, 30_000)])
def test_many_ties(s, e, d):
    u = np.arange(d) / d
    a = s - u * e
    want = [np.log(a).sum(), (1 / a).sum(), (u / a).sum(), (1 / a**2).sum(), (u / a**2).sum(), (u**2 / a**2).sum()]
    assert tied_sums([s], [e], [d])[0].tolist() == pytest.approx(want, rel=1e-10, abs=1e-14)


def test_level_counts(small, rows):
    assert rows(level_counts(small.withColumn("h", F.lit("x")), "event", ["g"], ["h"])) == [("x", "g", "A", 5, 3), ("x", "g", "B", 5, 4)]
