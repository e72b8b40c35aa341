"""Summary tables, tests and distributions."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from vitaspan import by_frequency, group_tests, header_counts, histogram, merge_tables, summary_table
from vitaspan.functions.pvalues import chi_square_tail, fisher_exact, fisher_two_by_two, rank_sum_exact


def test_chi_square_tail():
    assert chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert chi_square_tail(11.070497693516351, 5) == pytest.approx(0.05)
    assert chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert math.isnan(chi_square_tail(1.0, 0)) and chi_square_tail(0.0, 3) == 1.0


def test_fisher_against_all_tables():
    for a, b, c, d in ((3, 1, 1, 3), (8, 2, 1, 5), (0, 5, 4, 1), (10, 0, 0, 10)):
        r, s, k = a + b, c + d, a + c
        p = {x: math.comb(r, x) * math.comb(s, k - x) / math.comb(r + s, k) for x in range(max(0, k - s), min(r, k) + 1)}
        assert fisher_two_by_two(a, b, c, d) == pytest.approx(sum(v for v in p.values() if v <= p[a] * (1 + 1e-7)))


def test_rank_sum_against_all_orders():
    m, n = 3, 4
    us = [sum(pos) - m * (m - 1) / 2 for pos in itertools.combinations(range(m + n), m)]
    for u in range(m * n + 1):
        low, high = sum(x <= u for x in us), sum(x >= u for x in us)
        want = min(1.0, 2 * (high if u > m * n / 2 else low) / len(us))
        assert rank_sum_exact(u, m, n) == pytest.approx(want)


@pytest.fixture(scope="module")
def patients(spark):
    data = [("t", "Yes", 1.0), ("t", "No", 2.0), ("t", None, 5.0), ("c", "No", 3.0), ("c", "No", None), ("c", "Yes", 4.0), (None, "Yes", 9.0)]
    return spark.createDataFrame(data, "g string, ever string, age double")


def all_tables(rows, columns):
    """Every table with the given margins."""
    if len(columns) == 1:
        yield [[r] for r in rows]
        return
    for first in itertools.product(*[range(min(r, columns[0]) + 1) for r in rows]):
        if sum(first) == columns[0]:
            for rest in all_tables([r - x for r, x in zip(rows, first)], columns[1:]):
                yield [[x, *more] for x, more in zip(first, rest)]


@pytest.mark.parametrize("shape, n", [((2, 3), 14), ((3, 2), 20), ((3, 3), 12), ((4, 3), 11), ((2, 5), 15), ((3, 4), 9)])
def test_fisher_of_any_shape_against_all_tables(shape, n):
    r = random.Random(n)
    for _ in range(4):
        cells = [[0] * shape[1] for _ in range(shape[0])]
        for _ in range(n):
            cells[r.randrange(shape[0])][r.choice([0, *range(shape[1])])] += 1
        rows, columns = [sum(x) for x in cells], [sum(x) for x in zip(*cells)]
        weight = lambda t: math.prod(1 / math.factorial(x) for row in t for x in row)
        weights = [weight(t) for t in all_tables(rows, columns)]
        want = sum(w for w in weights if w <= weight(cells) * (1 + 1e-7)) / sum(weights)
        assert fisher_exact(cells) == pytest.approx(want, rel=1e-9)
        assert fisher_exact([list(x) for x in zip(*cells)]) == pytest.approx(want, rel=1e-9)


def test_fisher_published_values():
    """The job satisfaction table of the R manual (p = 0.7827), a table without variation, and one too large for the walk."""
    assert fisher_exact([[1, 2, 1, 0], [3, 3, 6, 1], [10, 10, 14, 9], [6, 7, 12, 11]]) == pytest.approx(0.7827, abs=5e-5)
    assert fisher_exact([[4, 0, 0], [0, 0, 0], [0, 0, 5]]) == pytest.approx(1 / 126)
    assert fisher_exact([[3, 4, 5]]) == 1.0 and fisher_exact([]) == 1.0
    assert fisher_exact([[900, 800, 700, 3]] * 40) is None
    assert fisher_exact([[2_000_000, 1], [3_000_000, 2], [1, 3]]) == pytest.approx(0, abs=1e-6)


def test_summary(patients):
    got = {(r.variable, r.level, r.group, r.stat): r.value for r in summary_table(patients, ["ever", "age"], by="g", overall=True).collect()}
    assert got["ever", "Yes", "t", "n"] == 1 and got["ever", "Yes", "t", "p"] == 50 and got["ever", None, "t", "missing"] == 1
    assert got["ever", "Yes", "Overall", "n"] == 2 and got["ever", "Yes", "Overall", "p"] == 40
    assert got["age", None, "t", "median"] == 2 and got["age", None, "c", "median"] == 3.5 and got["age", None, "c", "missing"] == 1
    assert got["age", None, "Overall", "median"] == 3


def test_zero_cells_and_kinds(spark):
    df = spark.createDataFrame([("a", "x", 0), ("b", "y", 1), ("b", "y", 1)], "g string, v string, flag int")
    got = {(r.variable, r.level, r.group, r.stat): r.value for r in
           summary_table(df, ["v", "flag"], by="g", kinds={"flag": "categorical"}).collect()}
    assert got["v", "y", "a", "n"] == 0 and got["v", "y", "a", "p"] == 0 and got["flag", "1", "b", "p"] == 100


def test_small_groups_get_exact_tests(spark):
    df = spark.createDataFrame([("a", "x", 1.5)] * 1 + [("a", "x", 2.5), ("a", "x", 3.5), ("a", "y", 9.5), ("b", "x", 8.5), ("b", "y", 7.5),
                                                       ("b", "y", 6.5), ("b", "y", 5.5)], "g string, v string, z double")
    got = {r.variable: r for r in group_tests(df, ["v", "z"], "g").collect()}
    assert got["v"].test == "fisher" and got["v"].p_value == pytest.approx(fisher_two_by_two(3, 1, 1, 3)) and got["v"].low_expected
    assert got["z"].test == "wilcoxon" and got["z"].statistic == 4 and got["z"].p_value == pytest.approx(rank_sum_exact(4, 4, 4))
    assert not got["z"].significant


def test_order_header_and_merge(patients, rows):
    table = by_frequency(summary_table(patients, ["ever"]))
    # three of each: a tie goes by level
    assert {(r.level, r.place) for r in table.where("stat = 'n'").collect()} == {("No", 1), ("Yes", 2)}
    assert rows(header_counts(patients, "g", overall=True)) == [("Overall", 6), ("c", 3), ("t", 3)]
    a = patients.sparkSession.createDataFrame([("x", 1)], "level string, n int")
    b = patients.sparkSession.createDataFrame([("x", 2), (None, 3)], "level string, n int")
    assert rows(merge_tables({"u": a, "m": b}, ["level"])) == [("x", 1, 2), (None, None, 3)]


def test_histogram_of_one_value(spark, rows):
    assert rows(histogram(spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double"), "x", 5)) == [(1, 2.0, 2.0, 2)]
    assert sum(r.n for r in histogram(spark.range(1000).select(F.col("id").alias("x")), "x").collect()) == 1000


def test_summary_computes_its_rows_once(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, None, 6.0)], "k int, c string, v double")
    df = df.groupBy("k", "c", "v").count().withColumn("v", F.col("v") + F.pmod(F.xxhash64("c"), F.lit(1)))
    table = summary_table(df, ["c", "v"])
    assert "xxhash64" not in table._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.variable, r.level, r.stat): r.value for r in table.collect()}
    assert got["c", "a", "n"] == 2 and got["c", None, "missing"] == 1 and got["v", None, "median"] == 2.0
