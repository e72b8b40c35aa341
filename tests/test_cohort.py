"""Registry decisions, joins, sources and whole pipelines on small hand-made tables."""

import random

import pytest
from pyspark.sql import functions as F

from vitaspan import (assemble, assert_unique, first_of, join_ns, last_contact, pair_lookup, pivot_blocks, pivot_ordinal, read_family,
                      semi_by_list, write_table)
from vitaspan.plans import clinical as c
from vitaspan.plans import timeline as t
from vitaspan.plans.endpoints import (metastasis_free_survival, overall_survival, progression_free_survival, set_unit, stack_cohorts)

U = "Unknown/Not Applicable"


def test_race_and_ethnicity(spark):
    df = spark.createDataFrame([("White", "Non-Hispanic", "M"), ("Samoan", "Unknown", "F"), (None, None, "F"), ("Other", "Spanish surname only", "F"),
                                ("Black", "Non-Hispanic, origin", "M"), ("Odd", "Cuban", "M")], "Race string, Ethnicity string, Sex string")
    got = [(r.Race, r.Ethnicity, r.race_eth) for r in c.demographics(df).collect()]
    assert got == [("White", "Non-Hispanic", "White Non-Hispanic"), ("Native Hawaiian or Other Pacific Islander", "Unknown", None),
                   (None, "Hispanic", "Hispanic"), ("Unknown", "Non-Hispanic", None), ("Black", "Non-Hispanic", "Black"), ("Odd", "Hispanic", "Hispanic")]
    assert c.demographics(df, fixed_levels=True).where("Race = 'Odd'").count() == 0


def test_stages(spark):
    df = spark.createDataFrame([("IA",), ("IIB",), ("IIIC",), ("IV",), ("0",), (None,)], "s string")
    assert [r[0] for r in df.select(c.collapse_stage("s")).collect()] == ["I", "II", "III", "IV", "0", None]
    df = spark.createDataFrame([(3.5, 4.0), (3.4, 3.5), (3.4, 3.0), (5.5, None), (5.6, None)], "b double, a double")
    assert [r[0] for r in df.select(c.iss_from_labs("b", "a")).collect()] == [None, "I", "II", "II", "III"]
    assert [r[0] for r in spark.createDataFrame([(20.0,), (19.9,)], "m double").select(c.msi_high("m")).collect()] == ["Yes", "No"]


def test_site_tiers(spark, rows):
    dx = spark.createDataFrame([("p1", "C34", "Lung"), ("p2", "C50", "Breast"), ("p3", U, U)], "patient_id string, PrimaryDiagnosisSiteCode string, PrimaryDiagnosisSite string")
    o = spark.createDataFrame([("p1", U, U, "No", "40"), ("p1", "C34", "Lung", "Progression", "55.5"), ("p1", "C34", "Lung", "Recurrence", "Age 90 or older"),
                               ("p2", "C18", "Colon", "Progression", "30"), ("p2", U, U, "No", U), ("p3", U, U, "No", "9.5"), ("p4", "C18", "Colon", "No", "1")],
                              "patient_id string, OutcomesPrimaryDiagnosisSiteCode string, OutcomesPrimaryDiagnosisSite string, ProgRecurInd string, AgeAtProgRecur string")
    got = c.outcomes(o.withColumn("RelapseStatus", F.lit(None).cast("string")), dx)
    assert rows(got.select("patient_id", "ProgRecurInd", "AgeAtProgRecur")) == [("p1", "Progression", 55.5), ("p2", "No", None), ("p3", "No", 9.5)]


def test_endpoints_keep_progression_and_metastasis_apart(spark):
    df = spark.createDataFrame([("Dead", 70.0, 65.0, "Progression", 60.0, "Yes", 61.0), ("Alive", None, 66.0, "No", None, None, None),
                                ("Lost", None, 50.0, None, None, "No", None)],
                               "VitalStatus string, AgeAtDeath double, AgeAtLastContact double, ProgRecurInd string, AgeAtProgRecur double, "
                               "had_metastasis string, AgeAtMetastaticSite double").withColumn("dx", F.lit(50.0))
    o = {"dx": "dx"}
    got = metastasis_free_survival(progression_free_survival(overall_survival(df, o), o), o).collect()
    assert [(r.os_event, r.os_age, r.pfs_event, r.pfs_age, r.met_event) for r in got] == [
        (1, 70.0, 1, 60.0, 1), (0, 66.0, 0, 66.0, 0), (None, 50.0, None, None, None)]
    assert got[0].os_time_from_dx_years == 20


def test_contact_and_first_treatment(spark, rows):
    df = spark.createDataFrame([(60.0, None), (60.0, 61.0), (None, 5.0)], "a double, b double")
    assert rows(df.select(last_contact("a", "b"), last_contact("a", "b", strict=True))) == [(5.0, None), (60.0, None), (61.0, 61.0)]
    label, value = first_of({"Drugs": "a", "SCT": "b"})
    assert rows(df.select(label, value)) == [("Drugs", 60.0), ("Drugs", 60.0), ("SCT", 5.0)]
    tie = spark.createDataFrame([(1.0, 1.0)], "a double, b double")
    assert rows(tie.select(label, value)) == [(None, None)]


def test_units_do_not_mix(spark):
    a, b = spark.createDataFrame([(1.0,)], "t double"), spark.createDataFrame([(2.0, "x")], "t double, g string")
    with pytest.raises(ValueError, match="several units"):
        stack_cohorts([set_unit(a, {"t": "years"}), set_unit(b, {"t": "months"})], ["t"])
    assert stack_cohorts([set_unit(a, {"t": "months"}), b], ["t"]).count() == 2


def test_marker_status_does_not_blank_others(spark, rows):
    m = spark.createDataFrame([("p", "50", "Estrogen receptor (ER)", "Positive", None), ("p", "51", "HER2/neu", "Amplified", None),
                               ("p", "52", "CEA", "Value", "7")],
                              "patient_id string, AgeAtTumorMarkerTest string, TMarkerTest string, TMarkerResult string, TMarkerResultValue string")
    m = m.withColumns({"TMarkerValueUOM": F.lit("x"), "TMarkerLowRange": F.lit("1"), "TMarkerHighRange": F.lit("5"),
                       "TMarkerRangeIndicator": F.lit(None).cast("string")})
    assert rows(c.marker_table(m)) == [("p", "High", "ER+/HER2+")]
    assert rows(c.marker_table(m, strict=True)) == [("p", "", "ER+/HER2+")]


def test_names_outside_the_list_are_no_silent_loss(spark, rows):
    m = spark.createDataFrame([("p", "50", "CEA", "Positive"), ("p", "51", "PSA", "Positive")],
                              "patient_id string, AgeAtTumorMarkerTest string, TMarkerTest string, TMarkerResult string")
    m = m.withColumns({n: F.lit(None).cast("string") for n in ("TMarkerResultValue", "TMarkerValueUOM", "TMarkerLowRange",
                                                              "TMarkerHighRange", "TMarkerRangeIndicator")})
    with pytest.raises(Exception, match="PSA"):
        c.marker_table(m, values=["CEA"]).collect()
    assert rows(c.marker_table(m, values=["CEA"], others="drop")) == [("p", "Positive")]
    a = spark.createDataFrame([("p", "del(17p)", "Yes", "Positive"), ("p", "t(4;14)", "Yes", "Positive")],
                              "patient_id string, CytogenAbnormName string, CytogenAbnormInd string, CytogenAbnormResult string")
    with pytest.raises(Exception, match="4;14"):
        c.cytogenetics(a, values=["del(17p)"]).collect()
    assert rows(c.cytogenetics(a, values=["del(17p)"], others="drop")) == [("p", "Yes")]


def test_cohort_query_keeps_all_columns(spark):
    import catalog.cohorts  # noqa: F401
    from catalog.base import QUERIES

    cohort = QUERIES["cohort_of_all_tumors"](spark, "/root/testdata/sf0.001")
    names = ["CEA", "ER_PR_HER2_status", "del(17p)", "t(4;14)", "Medication_1", "SmokingStatus", "AgeAtMetastaticSite"]
    assert set(names) <= set(cohort.columns)
    filled = cohort.select([F.count(F.col(f"`{n}`")).alias(n) for n in names]).first()
    assert all(filled[n] > 0 for n in names)


def test_lines_and_regimens(spark, rows):
    m = spark.createDataFrame([
        ("a", "Yes", "Lenalidomide", "60", "61", 2001, "First Line - Neoadjuvant"), ("a", "Yes", "Paclitaxel Protein-bound", "60", "61", 2001, "First Line - Neoadjuvant"),
        ("a", "Yes", "X Sulfate Sulfate", "60", "62", 2001, "First Line - Neoadjuvant"), ("a", "Yes", "Cisplatin", U, "63", 2004, None),
        ("b", "Yes", "B", "70", U, 1900, U), ("b", "Yes", "A", "65", "66", 2010, U), ("c", "No", None, U, U, None, None)],
        "patient_id string, MedicationInd string, Medication string, AgeAtMedStart string, AgeAtMedStop string, YearOfMedStart int, MedLineRegimen string")
    long = t.medication_regimens(t.medication_history(m, "patient_id"), "patient_id")
    got = rows(long.select("patient_id", "regimen_line", "AgeAtMedStart", "regimen_drugs", "AgeAtMedStop", "ever_first_med_age", "year_first_medication"))
    assert got == [("a", -1, 60.0, "lenalidomide; paclitaxel; x sulfate", "61; 62", 60.0, 2001), ("a", 1000, 63.0, "cisplatin", "63", 60.0, 2001),
                   ("b", 1, 65.0, "a", "66", 65.0, 2010), ("b", 2, 70.0, "b", None, 65.0, 2010), ("c", None, None, None, None, None, None)]
    wide = {r.patient_id: r for r in t.regimens_wide(long, "patient_id").collect()}
    assert wide["a"].AgeAtMedStart_2 == 63.0 and wide["c"].drug_ever == "No" and wide["b"].regimen_drugs_2 == "b"


def test_pair_lookup_equals_all_pairs(spark, rows):
    g = spark.createDataFrame([("p", "g1", 1), ("p", "g2", 2), ("q", "g3", 3), ("s", None, 4)], "k string, gid string, ga int")
    u = spark.createDataFrame([("p", "t1", 5), ("p", None, 6), ("r", "t2", 7)], "k string, tid string, ta int")
    want = spark.createDataFrame([("p", "g1", "t1"), ("p", "g1", None), ("p", "g1", "zz"), ("q", "g3", None), ("q", "g3", "t1"), ("r", None, "t2"),
                                  ("s", None, None), ("p", None, "t1")], "k string, gid string, tid string")
    all_pairs = join_ns(want, join_ns(g, u, ["k"], "full"), ["k", "gid", "tid"], "left")
    assert rows(pair_lookup(want, g, u, "k", "gid", "tid")) == rows(all_pairs)


def test_assembly_equals_outer_chain(spark, rows):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, x string")
    b = spark.createDataFrame([(2, "d"), (3, "e"), (None, "n")], "k int, y string")
    d = spark.createDataFrame([(4, "f"), (None, "m")], "k int, z string")
    chain = join_ns(join_ns(a, b, ["k"], "full"), d, ["k"], "full")
    assert rows(assemble([a, b, d], "k", "full")) == rows(chain)
    with pytest.raises(Exception, match="NULL in key"):
        assemble([a, b], "k", "full", key_nullable=False).collect()
    with pytest.raises(ValueError, match="two tables"):
        assemble([a, a], "k")
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(a, ["k"])


def test_semi_join_modes(spark, rows):
    df = spark.createDataFrame([("A10",), ("A1",), ("B1",), (None,)], "k string")
    keys = spark.createDataFrame([("A1",), ("0",), (None,)], "k string")
    assert rows(semi_by_list(df, "k", keys)) == [("A1",)]
    assert rows(semi_by_list(df, "k", keys, mode="substring")) == [("A1",), ("A10",)]


def test_mutation_status(spark, rows):
    s = spark.createDataFrame([("p", "g", None), ("q", "h", "t")], "patient_id string, Germline string, Tumor_WES string")
    calls = spark.createDataFrame([("p", "g", None, "."), ("p", "g", None, "0.1"), ("r", "i", "u_st_t", None), ("r", "i", "u", ".")],
                                  "patient_id string, patient_id_wes string, Tumor string, Tumor_VAF string")
    got = c.ch_status({"Lung": s}, {"Lung": calls})
    assert rows(got.select("patient_id", "Tumor_WES", "ch_status", "CH_detected_in_tumor")) == [
        ("p", None, "CH", True), ("q", "t", "No CH", None), ("r", "u", "CH", None)]


def test_file_family(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", None), ('b "x", y', "1")], "name string, v string")
    write_table(df, f"{tmp_path}/ex_People_V4.csv", "csv", run_date=None)
    (tmp_path / "one_Flat_V4.csv").write_text("name,v\nq,\nr,2\n")
    got = read_family(spark, f"{tmp_path}/*_V4.csv", r"(People|Flat)_V4\.csv", {"Flat": "name string, v string"})
    assert list(got) == ["Flat"] and rows(got["Flat"]) == [("q", None), ("r", "2")]
    assert write_table(df, f"{tmp_path}/out.csv", "csv", run_date="2024-01-02", columns=["v"]).endswith("out_2024-01-02.csv")


def test_substrings_of_long_keys(spark, rows):
    """Keys of 10,000 characters against listed ones of 50 lengths, many with one head, some with marks of patterns in them."""
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abé漢.*") for _ in range(n))
    long = [text(10_000) for _ in range(4)]
    listed = [long[0][i * 150:i * 150 + i + 1] + ("" if i % 2 else "!") for i in range(50)] + ["", None, "SAMEHEADSAMEHEAD" + "x" * 30, "q"]
    listed += ["SAMEHEADSAMEHEAD" + str(i) for i in range(200)]
    have = long + ["SAMEHEADSAMEHEAD" + "x" * 29, "..SAMEHEADSAMEHEAD77", "SAMEHEADSAMEHEA", "", None, "xqx"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(have)], "i int, k string")
    keys = spark.createDataFrame([(x,) for x in listed], "w string")
    want = [i for i, h in enumerate(have) if h is not None and any(w and w in h for w in listed)]
    assert [x[0] for x in rows(semi_by_list(df, "k", keys, "w", "substring").select("i"))] == want and {0, 5, 9} <= set(want)


def test_wide_tables_of_a_key_with_many_records(spark):
    df = spark.range(10_400).select(F.when(F.col("id") < 10_000, "long").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"),
                                    (F.col("id") * 7919 % 10_400).cast("int").alias("t"), F.col("id").cast("string").alias("v"))
    wide = pivot_ordinal(df, ["k"], "k", ["t"], ["t", "v"])
    assert len(wide.columns) == 203 and {"t_100", "v_100", "t_more", "v_more"} <= set(wide.columns)
    row = wide.where("k = 'long'").head()
    times = [row[f"t_{i}"] for i in range(1, 101)] + row["t_more"]
    assert times == sorted(times) and len(times) == 10_000 and len(row["v_more"]) == 9_900
    assert wide.where("k = 'k3'").head()["t_more"] == [] and wide.count() == 41
    blocks = pivot_blocks(df, ["k"], "k", ["t"], ["t", "v"], width=30, piece_rows=900)
    got = blocks.where("k = 'long'").orderBy("block").collect()
    assert [r.block for r in got] == list(range(334)) and [r[f"t_{i}"] for r in got for i in range(1, 31)][:10_000] == times
    assert blocks.count() == 334 + 40 and got[-1]["t_11"] is None


def test_pivot_keeps_all_ids(spark, rows):
    """Ids finer than the key, with and without a longest key beyond the width."""
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("a", 1, 3), ("b", 1, 9)], "k string, i int, t int")
    assert rows(pivot_ordinal(df, ["k", "i"], "k", ["t"], ["t"], width=2)) == [("a", 1, 3, None, [5]), ("a", 2, None, 4, []), ("b", 1, 9, None, [])]
    assert rows(pivot_ordinal(df, ["k", "i"], "k", ["t"], ["t"])) == [("a", 1, 3, None, 5), ("a", 2, None, 4, None), ("b", 1, 9, None, None)]


def _marked(df, name):
    """``df`` after an aggregation, with an expression that shows in the plan of whoever computes it again."""
    return df.groupBy(*df.columns).count().drop("count").withColumn(name, F.xxhash64(*df.columns))


def test_regimens_are_computed_once(spark, rows):
    df = _marked(spark.createDataFrame([("a", "x", 1), ("a", "x", 3), ("a", "y", 2), ("b", "z", 9)], "k string, i string, t int"), "h")
    for n in (None, 2):
        wide = pivot_ordinal(df, ["k", "i"], "k", ["t"], ["t", "h"], n)
        assert "xxhash64" not in wide._jdf.queryExecution().optimizedPlan().toString()
        assert [r[:4] for r in rows(wide.select("k", "i", "t_1", "t_2"))] == [("a", "x", 1, None), ("a", "y", None, 2), ("b", "z", 9, None)]


def test_assembly_computes_a_table_once(spark, rows):
    a = _marked(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, x int"), "h").drop("x")
    b = spark.createDataFrame([("b", 5, None), ("c", None, None)], "k string, `del(17p)` int, `t(4;14)` string")
    both = assemble([a, b], "k", "full", key_nullable=False)
    assert "xxhash64" not in both._jdf.queryExecution().optimizedPlan().toString()
    assert both.columns == ["k", "h", "del(17p)", "t(4;14)"]
    got = rows(both.selectExpr("k", "h is not null", "`del(17p)`", "`t(4;14)`"))
    assert got == [("a", True, None, None), ("a", True, None, None), ("b", True, 5, None), ("c", False, None, None)]


def test_assembly_joins_carry_one_column_a_table(spark):
    frames = [spark.createDataFrame([("a", i, i)], f"k string, x{i} int, y{i} int") for i in range(4)]
    for how in ("left", "full"):
        both = assemble([f.withMetadata(f"x{i}", {"unit": "years"}) for i, f in enumerate(frames)], "k", how, key_nullable=False)
        plan = both._jdf.queryExecution().analyzed().toString()
        assert "__t2" in plan and both.schema["x3"].metadata == {"unit": "years"}
        assert both.columns == ["k", *[f"{c}{i}" for i in range(4) for c in "xy"]]
        assert [tuple(r) for r in both.collect()] == [("a", 0, 0, 1, 1, 2, 2, 3, 3)]
