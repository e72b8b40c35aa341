"""NULL, order and text rules in which a statistics language differs from SQL: one test per rule."""

from pyspark.sql import functions as F

from vitaspan import (any_of, bucket, capture, cols_between, cols_like, concat_ordered, decode_age, dense_rank_nulls_out, fill,
                      first_per_key, group_first, join_ns, join_parts, levels, number_text, paste, pivot_ordinal, pivot_wide, recode,
                      relocate, remove_first, split_head_rest, to_number)
from vitaspan.operators.frames import labels_of, label
from vitaspan.operators.ordered import sort

import pytest


def one(spark, expr, **values):
    names = ", ".join(f"{v} AS {k}" for k, v in values.items())
    return spark.sql(f"SELECT {names}").select(expr.alias("r")).head()[0]


def test_first_row_has_total_order(spark, rows):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("a", 1, "x"), ("b", None, "q")], "k string, t int, v string")
    for parts in (1, 4):
        assert rows(first_per_key(df.repartition(parts), ["k"], ["t"])) == [("a", 1, "x"), ("b", None, "q")]


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r[0] for r in sort(df, ["x"]).collect()] == [1, 2, None]
    assert [r[0] for r in sort(df, ["-x"]).collect()] == [2, 1, None]


def test_dense_rank_leaves_nulls_out(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", "C2"), ("a", "C1"), ("a", "C2")], "k string, c string")
    assert rows(dense_rank_nulls_out(df, ["k"], ["c"], "n").select("c", "n")) == [("C1", 1), ("C2", 2), ("C2", 2), (None, None)]


def test_bad_numbers_become_null(spark):
    for text, want in (("junk", None), ("1d", None), ("12.5", 12.5), (" 7 ", 7.0), ("1e2", 100.0), ("", None), ("NaN", None), (".5", 0.5)):
        assert one(spark, to_number("x"), x=f"'{text}'") == want
    assert one(spark, decode_age("x"), x="'Age 90 or older'") == 90.0
    assert one(spark, decode_age("x"), x="'Unknown/Not Applicable'") is None


def test_null_keys_join(spark, rows):
    a = spark.createDataFrame([(1, None, "l1"), (2, "t", "l2")], "k int, t string, l string")
    b = spark.createDataFrame([(1, None, "r1"), (3, None, "r3")], "k int, u string, r string")
    assert rows(join_ns(a, b, {"k": "k", "t": "u"}, "full")) == [(1, None, "l1", "r1"), (2, "t", "l2", None), (3, None, None, "r3")]
    assert rows(join_ns(a, b, {"k": "k", "t": "u"}, "inner", nulls_match=False)) == []


def test_null_poisons_concatenation(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 2, "z"), ("b", 1, "y")], "k string, o int, v string")
    assert rows(concat_ordered(df, ["k"], ["v"], ["o"])) == [("a", None), ("b", "y; z")]
    assert rows(concat_ordered(df, ["k"], ["v"], ["o"], nulls="skip")) == [("a", "x"), ("b", "y; z")]


def test_joined_parts_of_nothing(spark):
    assert one(spark, join_parts(["a", "b"], "/"), a="CAST(NULL AS STRING)", b="CAST(NULL AS STRING)") is None
    assert one(spark, join_parts(["a", "b"], "/", empty_as_null=False), a="CAST(NULL AS STRING)", b="CAST(NULL AS STRING)") == ""
    assert one(spark, join_parts(["a", "b"], "/"), a="'ER+'", b="CAST(NULL AS STRING)") == "ER+"


def test_only_the_first_match_is_removed(spark):
    assert one(spark, remove_first("x", " Sulfate| Acetate"), x="'X Sulfate Sulfate'") == "X Sulfate"
    assert one(spark, remove_first("x", "_st_t"), x="'T1_st_t'") == "T1"


def test_capture_without_match_is_null(spark):
    assert one(spark, capture("x", r"ECOG (\d)"), x="'ECOG 1'") == "1"
    assert one(spark, capture("x", r"ECOG (\d)"), x="'Karnofsky 80%'") is None


def test_numbers_in_text(spark):
    for value, want in (("65D", "65"), ("65.5D", "65.5"), ("10000000D", "10000000"), ("12345678.25D", "12345678.25"), ("0D", "0")):
        assert one(spark, number_text("x"), x=value) == want
    assert one(spark, number_text("x"), x="CAST(NULL AS DOUBLE)") is None


def test_any_is_three_valued(spark, rows):
    df = spark.createDataFrame([("a", True), ("a", None), ("b", None), ("b", False), ("c", False)], "k string, f boolean")
    assert rows(df.groupBy("k").agg(any_of("f"))) == [("a", True), ("b", None), ("c", False)]


def test_composite_rank_sorts_by_the_second_factor_first(spark, rows):
    df = spark.createDataFrame([("p", 999, 50.0), ("p", 1, 60.0), ("p", 2, 50.0), ("p", 3, None)], "k string, line int, age double")
    assert rows(dense_rank_nulls_out(df, ["k"], ["age", "line"], "n").select("line", "n")) == [(1, 3), (2, 1), (3, None), (999, 2)]


def test_first_value_may_be_null(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5)], "k string, o int, v int")
    assert rows(group_first(df, ["k"], "v", ["o"], "f").select("o", "f")) == [(1, None), (2, None)]


def test_ordinals_count_over_the_patient(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "x", 3)], "k string, g string, v int")
    assert rows(pivot_ordinal(df, ["k", "g"], "k", ["v"], ["v"])) == [("a", "x", 1, None, 3), ("a", "y", None, 2, None)]


def test_rows_beyond_the_cap_keep_their_line(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, g string, v int")
    assert rows(pivot_ordinal(df, ["k", "g"], "k", ["v"], ["v"], max_n=1)) == [("a", "x", 1), ("a", "y", None)]


def test_fill_directions(spark, rows):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 1, None, 2, None])], "k string, o int, v int")
    assert [r[2] for r in rows(fill(df, ["k"], ["o"], ["v"], "updown"))] == [1, 1, 2, 2, 2]
    assert [r[2] for r in rows(fill(df, ["k"], ["o"], ["v"], "downup"))] == [1, 1, 1, 2, 2]


def test_split_keeps_the_remainder(spark):
    head, rest = split_head_rest("x", "; ")
    assert one(spark, head, x="'a; b; c'") == "a" and one(spark, rest, x="'a; b; c'") == "b; c"
    assert one(spark, rest, x="'a'") is None


def test_inequality_drops_null_and_case_falls_through(spark):
    df = spark.createDataFrame([("No",), ("Yes",), (None,)], "x string")
    assert df.where(F.col("x") != "No").count() == 1
    assert [r[0] for r in df.select(F.when(F.col("x") == "No", 1).when(F.col("x") == "Yes", 2)).collect()] == [1, 2, None]


def test_values_outside_the_levels(spark):
    assert one(spark, levels("x", ["I", "II"]), x="'V'") is None
    assert one(spark, recode("x", {"0:LIVING": 0}), x="'other'") is None
    assert one(spark, recode("x", {"0:LIVING": 0}), x="'0:LIVING'") == 0


def test_ages_sort_as_numbers(spark, rows):
    df = spark.createDataFrame([("a", "9.5"), ("a", "10.2")], "k string, age string").withColumn("age", decode_age("age"))
    assert rows(first_per_key(df, ["k"], ["age"])) == [("a", 9.5)]


def test_selectors_may_match_nothing(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "AgeAtRadiationStart_1 int, b string, c double")
    assert cols_like(df, prefix="AgeAtMedStop_") == []
    assert cols_between(df, "AgeAtRadiationStart_1", "b") == ["AgeAtRadiationStart_1", "b"]
    assert cols_like(df, dtype="string") == ["b"]
    assert relocate(df, "c", "AgeAtRadiationStart_1").columns == ["AgeAtRadiationStart_1", "c", "b"]


def test_buckets_and_paste(spark):
    for x, want in ((18.4, "U"), (18.5, "H"), (25, "V"), (30, "O")):
        assert one(spark, bucket("x", [18.5, 25, 30], ["U", "H", "V", "O"]), x=f"{x}D") == want
    assert one(spark, bucket("x", [20], ["No", "Yes"]), x="CAST(NULL AS DOUBLE)") is None
    assert one(spark, paste(F.col("a"), " (", F.col("b"), ")"), a="CAST(NULL AS STRING)", b="'s'") == "NA (s)"


def test_pivot_refuses_two_values_for_a_cell(spark, rows):
    df = spark.createDataFrame([("a", "x", "1"), ("a", "x", "2"), ("a", None, "3")], "k string, n string, v string")
    with pytest.raises(Exception, match="several rows"):
        pivot_wide(df, ["k"], "n", "v").collect()
    assert rows(pivot_wide(df, ["k"], "n", "v", on_duplicate="max")) == [("a", "3", "2")]


def test_labels(spark):
    df = label(spark.range(1), {"id": "Number", "none": "x"})
    assert labels_of(df.where("id >= 0")) == {"id": "Number"}
