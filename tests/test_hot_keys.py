"""Operators on hot keys, cut into small pieces, give the same results as plain windows."""

import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitaspan import session
from vitaspan import (closest_per_key, dense_rank_nulls_out, fill, group_any, group_first, group_size, group_values, quantiles,
                      running, scan, sequence_no, spread_flag, top_per_key)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, another key is NULL; times tie; values are often missing."""
    r = random.Random(3)
    data = []
    for i in range(900):
        k = "hot" if i < 300 else (None if i < 330 else f"k{r.randrange(60)}")
        data.append((i, k, r.choice([None, *range(20)]), r.choice([None, None, r.randrange(100)]), r.choice(["a", "b", None])))
    return spark.createDataFrame(data, "id int, k string, t int, v int, c string").repartition(5)


def nulls_last(*names):
    return [F.col(n[1:]).desc_nulls_last() if n[0] == "-" else F.col(n).asc_nulls_last() for n in names]


def w_k():
    return Window.partitionBy("k")



def filled(d, order, back, first):
    """Plain windows: ``first`` of next and previous."""
    down, up = w_k().orderBy(*order).rowsBetween(Window.unboundedPreceding, 0), w_k().orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    pick = {"updown": lambda c: F.coalesce(F.first(c, True).over(up), F.last(c, True).over(down)),
            "downup": lambda c: F.coalesce(F.last(c, True).over(down), F.first(c, True).over(up))}[first]
    return d.withColumns({c: pick(c) for c in back})


@pytest.mark.parametrize("operator, plain", [
    (lambda d, n: sequence_no(d, ["k"], ["t", "-v"], "n", piece_rows=n),
     lambda d: d.withColumn("n", F.row_number().over(w_k().orderBy(*nulls_last("t", "-v", "id", "c"))))),
    (lambda d, n: dense_rank_nulls_out(d, ["k"], ["t", "c"], "n", piece_rows=n),
     lambda d: d.withColumn("known", F.col("t").isNotNull() & F.col("c").isNotNull()).withColumn("n", F.when(F.col("known"), F.dense_rank().over(
         Window.partitionBy("k", "known").orderBy("t", "c")))).drop("known")),
    (lambda d, n: fill(d, ["k"], ["t", "id"], ["v", "c"], "updown", piece_rows=n), lambda d: filled(d, nulls_last("t", "id"), ["v", "c"], "updown")),
    (lambda d, n: fill(d, ["k"], ["-t", "id"], ["v", "c"], "downup", piece_rows=n), lambda d: filled(d, nulls_last("-t", "id"), ["v", "c"], "downup")),
    (lambda d, n: group_values(d, ["k"], {"lo": F.min("v"), "n": F.count("v")}, n),
     lambda d: d.withColumns({"lo": F.min("v").over(w_k()), "n": F.count("v").over(w_k())})),
    (lambda d, n: group_any(d, ["k"], F.col("v") > 98, "f", n), lambda d: d.withColumn("f", F.when(F.bool_or(F.col("v") > 98).over(w_k()), True).when(
        ~F.bool_or(F.col("v").isNull()).over(w_k()), False))),
    (lambda d, n: group_first(d, ["k"], "v", ["t"], "f", piece_rows=n), lambda d: d.withColumn("f", F.first("v").over(w_k().orderBy(
        *nulls_last("t", "id", "v", "c")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))),
    (lambda d, n: spread_flag(d.withColumn("y", F.when(F.col("v") == 7, "Yes")), ["k"], ["y"], n),
     lambda d: d.withColumn("y", F.max(F.when(F.col("v") == 7, "Yes")).over(w_k()))),
], ids=["sequence", "rank", "fill-up", "fill-down", "values", "any", "first", "spread"])
@pytest.mark.parametrize("piece_rows", [20, 10_000])
def test_same_result(skewed, rows, operator, plain, piece_rows):
    got, want = operator(skewed, piece_rows), plain(skewed)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.select(*want.columns)) == rows(want)


def test_a_compressible_hot_key_is_split(spark):
    """25 million rows of one key compress to almost nothing; they are numbered in many files, each by its own task."""
    df = spark.range(25_000_000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).cast("int").alias("t"))
    numbered = sequence_no(df, ["k"], ["t"], "n")
    pieces = numbered.groupBy((F.col("n") / 1_000_000).cast("int").alias("m")).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("m").collect()
    assert len(pieces) == 26 and all(a["hi"] <= b["lo"] for a, b in zip(pieces, pieces[1:]))
    files = {r[0] for r in spark.read.parquet(session._everyone.paths[-1]).select("_metadata.file_name").distinct().collect()}
    assert len(files) >= 25


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", [
    lambda d, **more: sequence_no(d, ["k"], ["t"], "n", **more),
    lambda d, **more: fill(d, ["k"], ["t", "id"], ["v"], "updown", **more),
    lambda d, **more: dense_rank_nulls_out(d, ["k"], ["id"], "n", **more)], ids=["sequence", "fill", "rank"])
def test_ranges_grow_with_the_rows_of_a_hot_key(spark, operator):
    """Rows of other keys are sorted by their keys and never written; those of a hot one go to as many ranges as they need."""
    def pieces(n):
        df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 400).cast("string")).alias("k"),
                                   F.lit(7).alias("t"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
        with session.owning() as owner:
            operator(df, piece_rows=500).count()
            sorted_tables = [d for d in map(spark.read.parquet, owner.paths) if "__piece" in d.columns]
            assert {r[0] for d in sorted_tables for r in d.select("k").distinct().collect()} == {"hot"}
            sizes = [r["count"] for d in sorted_tables for r in d.groupBy("__piece").count().collect()]
            owner.drop(spark)
        return len(sizes), max(sizes)
    (few, most), (many, most_of_many) = pieces(9_000), pieces(36_000)
    assert 4 <= few <= 6 and 22 <= many <= 24 and max(most, most_of_many) < 1500


def test_keys_that_fit_are_scanned_in_one_shuffle(spark):
    df = spark.createDataFrame([(i, i % 7, i * 13 % 11) for i in range(100)], "id int, k int, t int")
    with session.owning() as owner:
        text = plan(sequence_no(df, ["k"], ["t"], "n"))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text and owner.paths == []


def test_one_scan_numbers_counts_and_fills(skewed, rows):
    """The same from one layout as from three operators, with and without ranges."""
    want = fill(group_size(sequence_no(skewed, ["k"], ["t"], "n"), ["k"], "size"), ["k"], ["n"], ["v", "c"], ties=[])
    for piece_rows in (50, 10_000):
        got = scan(skewed, ["k"], ["t"], number="n", size="size", fills=["v", "c"], piece_rows=piece_rows)
        assert rows(got.select("id", "n", "size", "v", "c")) == rows(want.select("id", "n", "size", "v", "c"))


def test_sharing_looks_at_plan_nodes_only(spark):
    df = spark.range(4).select(F.col("id").alias("Sort_key"), F.lit("Join Aggregate").alias("Window"))
    with session.owning() as owner:
        session.shared(df)
        assert owner.paths == []
        session.shared(df.distinct())
        assert len(owner.paths) == 1
        owner.drop(spark)


def test_frozen_tables_have_owners(spark):
    with session.owning() as one:
        a = session.freeze(spark.range(5))
    with session.owning() as two:
        b = session.freeze(spark.range(7))
    assert one.drop(spark) == 1 and b.count() == 7 and two.drop(spark) == 1
    assert a.columns == ["id"]


def test_running_totals(spark, rows):
    r = random.Random(5)
    data = {(k, r.choice([r.uniform(-5, 5), r.uniform(0, 1e6), float(r.randrange(40))])) for k in ("a", "b") for _ in range(300)}
    df = spark.createDataFrame([(k, t, r.randrange(5), r.uniform(.9, 1)) for k, t in data], "k string, t double, n int, p double")
    for reverse, piece_rows in itertools.product((False, True), (40, 10_000)):
        w = w_k().orderBy(F.desc("t") if reverse else "t").rowsBetween(Window.unboundedPreceding, 0)
        got = running(df, ["k"], "t", {"s": F.col("n")}, {"q": F.col("p")}, reverse, {"all": F.col("n")}, piece_rows)
        want = df.select("k", "t", F.sum("n").over(w), F.round(F.product("p").over(w), 9), F.sum("n").over(w_k()))
        assert rows(got.select("k", "t", "s", F.round("q", 9), "all")) == rows(want)
        w = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
        one = df.where("k = 'a'")
        assert rows(running(one, [], "t", {"s": F.col("n")}, piece_rows=piece_rows).select("t", "s")) == rows(one.select("t", F.sum("n").over(w)))


@pytest.mark.parametrize("low, width", [(1.0, 1.0), (0.0, 2.0 ** -10)], ids=["one-doubling", "near-zero"])
def test_ranges_of_values_follow_the_data(spark, low, width):
    """Ten million different values close together: ranges of about a million each, whatever the values are."""
    n = 10_000_001
    df = spark.range(n).select((F.lit(low) + F.col("id") * F.lit(width / n)).alias("v"))
    with session.owning() as owner:
        got = quantiles(df, [], "v", {"p10": 0.1, "half": 0.5, "top": 1.0}).head()
        sorted_tables = [d for d in map(spark.read.parquet, owner.paths) if "__piece" in d.columns]
        sizes = [r["count"] for r in sorted_tables[0].groupBy("__piece").count().collect()]
        owner.drop(spark)
    assert list(got) == pytest.approx([low + p * (n - 1) * width / n for p in (0.1, 0.5, 1.0)], rel=1e-12)
    assert len(sorted_tables) == 1 and 9 <= len(sizes) <= 12 and max(sizes) < 2_000_000


def test_quantiles_with_null_key(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), (None, 3.0), (None, None)], "k string, v double")
    assert rows(quantiles(df, ["k"], "v", {"q": 0.25})) == [("a", 1.5), (None, 3.0)]


def test_top_rows_are_limited_before_the_shuffle(skewed):
    plan = top_per_key(skewed, ["k"], ["t"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_closest(spark, rows):
    e = spark.createDataFrame([("a", 1, 50.0), ("a", 2, 60.0), ("a", 3, None), ("b", 4, 10.0), ("c", 5, None)], "k string, i int, t double")
    at = spark.createDataFrame([("a", 55.0), ("b", None)], "k string, d double")
    # two records equally far: the earlier one; no anchor or no time: still one record
    assert rows(closest_per_key(e, at, ["k"], "t", "d")) == [("a", 1, 50.0), ("b", 4, 10.0), ("c", 5, None)]
