"""Recodes and per-table reductions of a cancer registry: one function per table, one row per patient out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import (CAPPED_AGE, UNKNOWN, bucket, capture, col, contains, decode_age,
                                        is_capped, join_parts, levels, paste, recode, remove_first,
                                        to_number)
from vitaspan.operators.frames import across, null_if_all_strings
from vitaspan.operators.joins import join_ns, member_update, pair_lookup, tagged_union, tier_of, tiered_union_first
from vitaspan.operators.ordered import (closest_per_key, fill, first_per_key, group_any, group_min, scan,
                                        sequence_no, spread_flag, strongest_per_key)
from vitaspan.operators.reshape import any_flag_by_sample, collect_ordered, concat_ordered, pivot_ordinal, pivot_wide
from vitaspan.session import freeze

KEY = "patient_id"
MIGRATED = "(Migrated) Cannot determine from available documentation"

# fixed values: race names and the groups they belong to
RACE_CONTAINS = {
    "American Indian": "American Indian or Alaska Native",
    "Asian": "Asian",
    "Cambodian": "Asian",
    "Unknown": "Unknown",
}
RACE_EQUALS = {
    "White": "White",
    "Black": "Black",
    "Chinese": "Asian",
    "Filipino": "Asian",
    "Japanese": "Asian",
    "Korean": "Asian",
    "Pakistani": "Asian",
    "Thai": "Asian",
    "Vietnamese": "Asian",
    "Laotian": "Asian",
    "Hawaiian": "Native Hawaiian or Other Pacific Islander",
    "Micronesian, NOS": "Native Hawaiian or Other Pacific Islander",
    "Pacific Islander, NOS": "Native Hawaiian or Other Pacific Islander",
    "Polynesian, NOS": "Native Hawaiian or Other Pacific Islander",
    "Samoan": "Native Hawaiian or Other Pacific Islander",
    "Tongan ese": "Native Hawaiian or Other Pacific Islander",
    "Other": "Unknown",
}
RACE_LEVELS = [
    "White", "Black", "Asian", "American Indian or Alaska Native",
    "Native Hawaiian or Other Pacific Islander", "Unknown",
]
# fixed values: class limits and units
BMI_BREAKS, BMI_LABELS = [18.5, 25.0, 30.0], ["Underweight", "Healthy", "Overweight", "Obese"]
B2_TO_MG_PER_L = {"mg/L": 1.0, "mg/dL": 10.0, "ng/mL": 0.001, "ug/mL (mcg/mL)": 1.0}
IMID_FRAGMENT, IMID_BRANDS = "domide", ["Revlimid", "Pomalyst"]
STAGE_FRAGMENTS = ["0", "IV", "III", "II", "I"]
ER_TEST, PR_TEST, HER2 = "Estrogen receptor (ER)", "Progesterone receptor (PR)", "HER2"
RECEPTOR_STATUS = "ER_PR_HER2_status"


# --- recodes ---------------------------------------------------------------------------------------

def race_group(c: str | Column) -> Column:
    """Race to five groups and Unknown; names outside the lists stay."""
    fragments = F.coalesce(*[F.when(contains(c, part), F.lit(group)) for part, group in RACE_CONTAINS.items()])
    return F.coalesce(fragments, recode(c, RACE_EQUALS), col(c))


def ethnicity_group(c: str | Column) -> Column:
    """Everything that is neither non-Hispanic nor unknown counts as Hispanic, a missing answer too."""
    return (F.when((col(c) == "Spanish surname only") | contains(c, "Non-Hispanic"), "Non-Hispanic")
            .when(contains(c, "Unknown"), "Unknown").otherwise("Hispanic"))


def race_ethnicity(race: str | Column, ethnicity: str | Column) -> Column:
    other_side = col(ethnicity) == "Non-Hispanic"
    named = recode(race, {"White": "White Non-Hispanic", "Black": "Black", "Others": "Others Non-Hispanic"})
    return F.when(col(ethnicity) == "Hispanic", "Hispanic").when(other_side, named)


def smoking_group(c: str | Column) -> Column:
    ever = (col(c) == "Current") | contains(c, "Ever")
    return levels(F.when(col(c) == "Never", "Never").when(ever, "Ever"), ["Never", "Ever"])


def ecog(c: str | Column) -> Column:
    return capture(c, r"ECOG (\d)")


def karnofsky(c: str | Column) -> Column:
    return capture(c, r"Karnofsky (\d.*)%")


def staged_as(system: str | Column, value: str | Column, wanted: str = "ISS") -> Column:
    """Value of a generic staging pair, where its system is the wanted one."""
    return F.when(col(system) == wanted, col(value))


def collapse_stage(c: str | Column, fragments: Sequence[str] = tuple(STAGE_FRAGMENTS)) -> Column:
    """First fragment, in the given order, that the stage text contains."""
    return F.coalesce(*[F.when(contains(c, f), F.lit(f)) for f in fragments])


def merge_levels(c: str | Column, merged: Mapping[str, str]) -> Column:
    return recode(c, merged, default=col(c).cast("string"))


def is_imid(drug: str | Column) -> Column:
    return contains(drug, IMID_FRAGMENT) | col(drug).isin(IMID_BRANDS)


def msi_high(score: str | Column, limit: float = 20.0) -> Column:
    return bucket(score, [limit], ["No", "Yes"])


def iss_from_labs(b2: str | Column, albumin: str | Column) -> Column:
    """Stage from beta-2-microglobulin (mg/L) and albumin (g/dL); exactly 3.5 mg/L has no stage."""
    b, a = col(b2), col(albumin)
    low = F.when(a >= 3.5, "I").when(a < 3.5, "II")
    return F.when(b < 3.5, low).when((b > 3.5) & (b <= 5.5), "II").when(b > 5.5, "III")


# --- patient tables --------------------------------------------------------------------------------

def demographics(patients: DataFrame, fixed_levels: bool = False) -> DataFrame:
    """Grouped race and ethnicity and their combination; ``fixed_levels`` drops races outside the level list."""
    grouped = patients.withColumns({"Race": race_group("Race"), "Ethnicity": ethnicity_group("Ethnicity")})
    grouped = grouped.withColumn("race_eth", race_ethnicity("Race", "Ethnicity"))
    return grouped.withColumn("Race", levels("Race", RACE_LEVELS)) if fixed_levels else grouped


def smoking(history: DataFrame, key: str = KEY) -> DataFrame:
    return history.select(col(key), smoking_group("SmokingStatus").alias("SmokingStatus"))


def vital_status(table: DataFrame, key: str = KEY) -> DataFrame:
    return across(table.select(col(key), "VitalStatus", "AgeAtLastContact", "AgeAtDeath"),
                  ["AgeAtLastContact", "AgeAtDeath"], decode_age)


def diagnoses(table: DataFrame, key: str = KEY) -> DataFrame:
    """Decoded diagnoses of a patient in order of age, with sequence, count and follow-on flag."""
    df = table.withColumns({
        "not_real_age": F.when(is_capped("AgeAtDiagnosis"), F.lit(CAPPED_AGE)),
        "AgeAtDiagnosis": decode_age("AgeAtDiagnosis"),
        "ECOG": ecog("PerformStatusAtDiagnosis"), "Karnofsky": karnofsky("PerformStatusAtDiagnosis"),
        "iss_stage": staged_as("OtherStagingSystem", "OtherStagingValue")})
    df = scan(df, [key], ["AgeAtDiagnosis"], number="diagnosis_sequence", size="how_many_dx", fills=["iss_stage"])
    return df.withColumn("has_subsequent_cancer", F.when(F.col("how_many_dx") > 1, F.lit("Yes")))


def subsequent_diagnoses(table: DataFrame, key: str = KEY,
                         cols: Sequence[str] = ("PrimaryDiagnosisSite", "PrimaryDiagnosisSiteCode", "Histology",
                                                "AgeAtDiagnosis")) -> DataFrame:
    """Everything after the first diagnosis as one text per column, in order of age.

    A missing value in any diagnosis makes the text of that column NULL.
    """
    arrays = collect_ordered(table, [key], cols, ["AgeAtDiagnosis", *[c for c in cols if c != "AgeAtDiagnosis"]])
    rest = [F.when(~F.exists(col(c), lambda x: x.isNull()) & (F.size(col(c)) > 1),
                   F.array_join(F.slice(col(c), 2, F.size(col(c))), "; ")).alias(f"subsequent_cancer_{c}") for c in cols]
    return arrays.select(col(key), *rest)


def first_diagnosis(decoded: DataFrame, key: str = KEY, how: str = "left", **kwargs) -> DataFrame:
    """First diagnosis of every patient, with the later ones as text."""
    order = ["diagnosis_sequence"] if "diagnosis_sequence" in decoded.columns else ["AgeAtDiagnosis"]
    first = first_per_key(decoded, [key], order)
    return join_ns(first, subsequent_diagnoses(decoded, key, **kwargs), [key], how)


def target_timeline(decoded: DataFrame, key: str = KEY, target: str = "Multiple myeloma",
                    precursor: str = "Monoclonal gammopathy", short: str = "MM", precursor_short: str = "MGUS",
                    sample_age: str | None = "sample_age") -> DataFrame:
    """Timeline of a target disease and its precursor on every diagnosis row of the patient.

    ``age_at_last_*`` keeps the own age of each of the first three target diagnoses; only other rows are
    filled (next value, else previous one).
    """
    is_target = F.coalesce(col("Histology") == target, F.lit(False))
    df = decoded.withColumn(f"had_{short}_at_anytime", F.when(is_target, F.lit("Yes")))
    df = sequence_no(df, [key, "Histology"], ["AgeAtDiagnosis", "diagnosis_sequence"], "__nth", ties=[])
    nth = recode(F.col("__nth"), {1: f"1st {short} dx", 2: f"2nd {short} dx", 3: f"3rd {short} dx"},
                 default=F.col("__nth").cast("string"))
    other = paste(F.col("Histology"), " (", F.col("PrimaryDiagnosisSite"), ")")
    first, last, before = f"age_at_first_{short}_dx", f"age_at_last_{short}_dx", f"age_at_{precursor_short}_dx"
    df = df.withColumns({
        f"{short}_sequence": F.when(is_target, nth).otherwise(other),
        first: F.when(is_target & (F.col("__nth") == 1), F.col("AgeAtDiagnosis")),
        last: F.when(is_target & (F.col("__nth") <= 3), F.col("AgeAtDiagnosis")),
        before: F.when(col("Histology") == precursor, F.col("AgeAtDiagnosis"))}).drop("__nth")
    # the flag has one value only, so filling spreads it
    df = fill(df, [key], ["diagnosis_sequence"], [f"had_{short}_at_anytime", first, last, before], "updown", ties=[])
    had = F.col(f"had_{short}_at_anytime")
    is_patient = (F.when(F.col(last) >= F.col(before), "Yes").when(F.col(last) < F.col(before), f"{precursor_short} patient")
                  .when(had == "Yes", "Yes").otherwise("No"))
    df = df.withColumn(f"is_patient_{short}", is_patient)
    if sample_age is None:
        return df
    of = F.col(f"is_patient_{short}")
    for_target = (F.when(of.isin(f"{precursor_short} patient", "No"), "No")
                  .when((col(sample_age) > F.col(before)) | (F.col(last) == F.col(before)) | (had == "Yes"), "Yes"))
    return df.withColumn(f"sample_is_for_{short}_dx", for_target)


# --- records of the first-diagnosed site, else of an unknown site ----------------------------------

def site_tiered(table: DataFrame, first_dx: DataFrame, code: str, site: str, age: str, keep: Mapping[str, str],
                flag: str, key: str = KEY, indicator: str | None = None) -> DataFrame:
    """One record per patient: the earliest of the first-diagnosed site, else the earliest of unknown site.

    ``first_dx`` has one row per patient.

    ``indicator`` names a column whose migrated rows (and rows without an answer) are left out first.
    ``keep`` maps columns to their names in the result.
    """
    if indicator is not None:
        table = table.where(col(indicator) != MIGRATED)
    decoded = table.withColumn(age, decode_age(age))
    one = tiered_union_first(decoded, first_dx, {key: key, code: "PrimaryDiagnosisSiteCode", site: "PrimaryDiagnosisSite"},
                             col(site) == UNKNOWN, [key], [age], unique_by=[key])
    return one.select(col(key), *[col(old).alias(new) for old, new in keep.items()]).withColumn(flag, F.lit("Yes"))


def outcomes(table: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    names = ["OutcomesPrimaryDiagnosisSiteCode", "OutcomesPrimaryDiagnosisSite", "ProgRecurInd", "AgeAtProgRecur", "RelapseStatus"]
    return site_tiered(table, first_dx, names[0], names[1], "AgeAtProgRecur", {n: n for n in names}, "has_outcomes_data", key)


def metastases(table: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    keep = {"MetastaticDiseaseSiteCode": "MetastaticDiseaseSiteCode", "MetastaticDiseaseSite": "MetastaticDiseaseSite",
            "MetastaticDiseaseInd": "had_metastasis", "AgeAtMetastaticSite": "AgeAtMetastaticSite",
            "MetsDzPrimaryDiagnosisSite": "MetsDzPrimaryDiagnosisSite"}
    return site_tiered(table, first_dx, "MetastaticDiseaseSiteCode", "MetastaticDiseaseSite", "AgeAtMetastaticSite",
                       keep, "has_metastasis_data", key)


def transplants(table: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    keep = {"SCTInd": "sct_ever", "AgeAtTransplant": "AgeAtTransplant", "TransplantType": "TransplantType",
            "TransplantCellSource": "TransplantCellSource"}
    return site_tiered(table, first_dx, "SCTPrimaryDiagnosisSiteCode", "SCTPrimaryDiagnosisSite", "AgeAtTransplant",
                       keep, "has_stemcell_data", key)


def radiations(table: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    keep = {"RadPrimaryDiagnosisSiteCode": "RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite": "RadPrimaryDiagnosisSite",
            "RadiationTherapyInd": "radiation_ever", "AgeAtRadiationStart": "AgeAtRadiationStart"}
    return site_tiered(table, first_dx, "RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite", "AgeAtRadiationStart",
                       keep, "has_radiation_data", key, "RadiationTherapyInd")


def surgeries(table: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    """An unknown answer counts as yes if there is an age, else as no."""
    keep = {"PrimaryDiagnosisSiteCode": "SurgPrimaryDiagnosisSiteCode", "PrimaryDiagnosisSite": "SurgPrimaryDiagnosisSite",
            "SiteTherapeutic": "surgery_ever", "AgeAtSurgeryBiopsy": "AgeAtSurgeryBiopsy"}
    one = site_tiered(table, first_dx, "PrimaryDiagnosisSiteCode", "PrimaryDiagnosisSite", "AgeAtSurgeryBiopsy",
                      keep, "has_surgery_data", key, "SurgeryBiopsyInd")
    resolved = F.when(F.col("AgeAtSurgeryBiopsy").isNotNull(), "Yes").otherwise("No")
    return one.withColumn("surgery_ever", F.when(F.col("surgery_ever") == UNKNOWN, resolved).otherwise(F.col("surgery_ever")))


def medications_of_site(table: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    """Medication records of the first-diagnosed or an unknown site; per patient only the lowest site code."""
    rows = table.where(col("MedicationInd") != MIGRATED)
    rows = tier_of(rows, first_dx, {key: key, "MedPrimaryDiagnosisSiteCode": "PrimaryDiagnosisSiteCode",
                                    "MedPrimaryDiagnosisSite": "PrimaryDiagnosisSite"},
                   col("MedPrimaryDiagnosisSite") == UNKNOWN, unique_by=[key])
    lowest = group_min(rows, [key], "MedPrimaryDiagnosisSiteCode", "__lowest")
    kept = lowest.where(col("MedPrimaryDiagnosisSiteCode") == F.col("__lowest"))
    return kept.select(col(key), "MedPrimaryDiagnosisSiteCode", "MedPrimaryDiagnosisSite", "MedicationInd",
                       decode_age("AgeAtMedStart").alias("AgeAtMedStart"), "Medication", "AgeAtMedStop")


def medication_courses(rows: DataFrame, key: str = KEY, imids: bool = True, cap: int = 10) -> DataFrame:
    """Drugs by start age, the first ``cap`` courses side by side; optionally the drug-class flag."""
    extra = []
    if imids:
        flagged = rows.withColumn("received_imids", F.when(is_imid("Medication"), F.lit("Yes")))
        rows = spread_flag(flagged, [key], ["received_imids"])
        extra = ["received_imids"]
    courses = concat_ordered(rows, [key, "AgeAtMedStart", "MedicationInd", *extra], ["Medication", "AgeAtMedStop"],
                             ["Medication", "AgeAtMedStop"])
    wide = pivot_ordinal(courses, [key, *extra, "MedicationInd"], key, ["AgeAtMedStart", "MedicationInd"],
                         ["AgeAtMedStart", "Medication", "AgeAtMedStop"], cap)
    return wide.withColumnRenamed("MedicationInd", "drugs_ever").withColumn("has_medication_data", F.lit("Yes"))


# --- measurements nearest to diagnosis -------------------------------------------------------------

def body_mass(exams: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    """Exam nearest to diagnosis, with the BMI class."""
    decoded = exams.withColumn("AgeAtPhysicalExam", decode_age("AgeAtPhysicalExam"))
    one = closest_per_key(decoded, first_dx, [key], "AgeAtPhysicalExam", "AgeAtDiagnosis")
    one = across(one.select(col(key), "AgeAtPhysicalExam", "BodyWeight", "BodyHeight", "BMI"),
                 ["BodyWeight", "BodyHeight", "BMI"], to_number)
    return one.withColumn("bmi_cat", bucket("BMI", BMI_BREAKS, BMI_LABELS))


def albumin(labs: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    rows = labs.where(col("LabTest") == "Albumin (Serum)").withColumn("AgeAtLabResults", decode_age("AgeAtLabResults"))
    one = closest_per_key(null_if_all_strings(rows, UNKNOWN), first_dx, [key], "AgeAtLabResults", "AgeAtDiagnosis")
    return one.select(col(key), to_number("LabResults").alias("albumin_value"), F.col("LabUnits").alias("albumin_unit"))


def beta2(markers: DataFrame, labs: DataFrame, first_dx: DataFrame, key: str = KEY) -> DataFrame:
    """Beta-2-microglobulin nearest to diagnosis from either table, in mg/L; other units have no value."""
    names = ["__age", "__test", "__value", "__unit"]
    a = null_if_all_strings(markers, UNKNOWN).where(col("TMarkerTest") == "Beta-2-microglobulin (B2M) level").select(
        col(key), *[c.alias(n) for c, n in zip((decode_age("AgeAtTumorMarkerTest"), F.col("TMarkerTest"),
                                                F.col("TMarkerResultValue"), F.col("TMarkerValueUOM")), names)])
    b = null_if_all_strings(labs, UNKNOWN).where(col("LabTest") == "Beta 2 Microglobulin").select(
        col(key), *[c.alias(n) for c, n in zip((decode_age("AgeAtLabResults"), F.col("LabTest"), F.col("LabResults"),
                                                F.col("LabUnits")), names)])
    one = closest_per_key(a.unionByName(b), first_dx, [key], "__age", "AgeAtDiagnosis")
    return one.select(col(key), (to_number("__value") * recode("__unit", B2_TO_MG_PER_L)).alias("b2_value"),
                      F.lit("mg/L").alias("b2_unit"))


def calculated_iss(albumins: DataFrame, b2: DataFrame, key: str = KEY) -> DataFrame:
    both = join_ns(albumins, b2, [key], "full")
    return both.withColumn("iss_stage_calculated", iss_from_labs("b2_value", "albumin_value")).where(
        "iss_stage_calculated is not null")


def with_calculated_iss(first_dx: DataFrame, calculated: DataFrame, key: str = KEY) -> DataFrame:
    """Fill the recorded stage with the calculated one where it is missing."""
    return join_ns(first_dx, calculated, [key], "left").withColumn(
        "iss_stage", F.coalesce(F.col("iss_stage"), F.col("iss_stage_calculated")))


# --- markers ---------------------------------------------------------------------------------------

def marker_interpretation(markers: DataFrame, key: str = KEY) -> DataFrame:
    """Judge marker values against the reference range, which is filled within the test in order of age."""
    df = markers.withColumn("AgeAtTumorMarkerTest", decode_age("AgeAtTumorMarkerTest"))
    df = null_if_all_strings(df, UNKNOWN).withColumnsRenamed(
        {"TMarkerTest": "marker_test", "TMarkerValueUOM": "marker_unit", "TMarkerResultValue": "marker_value"})
    df = fill(df, ["marker_test"], ["AgeAtTumorMarkerTest", key], ["TMarkerLowRange", "TMarkerHighRange"], "updown")
    df = across(df, ["marker_value", "TMarkerLowRange", "TMarkerHighRange"], to_number)
    v, lo, hi = F.col("marker_value"), F.col("TMarkerLowRange"), F.col("TMarkerHighRange")
    judged = (F.when((v >= lo) & (v <= hi), "WNL (Within Normal Limits)").when(v < lo, "Low").when(v > hi, "High"))
    judged = F.coalesce(F.col("TMarkerRangeIndicator"), judged)
    return df.withColumns({
        "marker_interpretation": F.when(F.col("TMarkerResult") == "Value", judged).otherwise(F.col("TMarkerResult")),
        "marker_test": F.when(contains("marker_test", HER2), F.lit(HER2)).otherwise(F.col("marker_test"))})


def receptor_status(interpreted: DataFrame, key: str = KEY) -> DataFrame:
    """Per patient the text ``ER+/PR-/HER2-`` from the first result of each receptor; NULL if none is clear."""
    answer = F.when(F.col("marker_test") != HER2, F.col("TMarkerResult")).otherwise(
        F.when(F.col("TMarkerResult").isin("Positive", "Negative"), F.col("TMarkerResult"))
        .when(F.col("TMarkerResult") == "Amplified", F.lit("Positive")))
    rows = interpreted.where(F.col("marker_test").isin(ER_TEST, PR_TEST, HER2)).withColumn("__answer", answer)
    first = first_per_key(rows, [key, "marker_test"], ["AgeAtTumorMarkerTest"])
    sign = recode("__answer", {"Positive": "+", "Negative": "-"})
    per = first.groupBy(col(key)).agg(*[
        F.max(F.when(F.col("marker_test") == test, F.concat(F.lit(name), sign))).alias(name)
        for test, name in ((ER_TEST, "ER"), (PR_TEST, "PR"), (HER2, "HER2"))])
    return per.select(col(key), join_parts(["ER", "PR", "HER2"], "/").alias(RECEPTOR_STATUS))


def marker_table(markers: DataFrame, key: str = KEY, strict: bool = False,
                 values: Sequence[str] | None = None, others: str = "error") -> DataFrame:
    """Earliest result per marker, one column per marker; the three receptors share one status column.

    A marker outside ``values`` is an error, unless ``others`` is ``drop``. ``strict`` blanks the interpretation of every other marker, as the original table does.
    """
    # read three times below
    rows = freeze(marker_interpretation(markers, key))
    joined = join_ns(rows, receptor_status(rows, key), [key], "left")
    receptor = F.coalesce(F.col("marker_test").isin(ER_TEST, PR_TEST, HER2), F.lit(False))
    status = F.when(receptor, F.col(RECEPTOR_STATUS))
    if strict:
        status = F.coalesce(status, F.lit(""))
    final = joined.withColumns({
        "marker_interpretation": F.coalesce(status, F.col("marker_interpretation")),
        "marker_test": F.when(receptor, F.lit(RECEPTOR_STATUS)).otherwise(F.col("marker_test"))})
    one = first_per_key(final, [key, "marker_test"], ["AgeAtTumorMarkerTest"],
                        ties=["marker_interpretation", "marker_value", "marker_unit"])
    return pivot_wide(one, [key], "marker_test", "marker_interpretation", values, others=others)


# --- other tables ----------------------------------------------------------------------------------

def family_history(table: DataFrame, key: str = KEY) -> DataFrame:
    return strongest_per_key(table, [key], "CancerInFamilyInd")


def last_seen(imaging: DataFrame, labs: DataFrame, key: str = KEY) -> DataFrame:
    """Latest age with an image or a lab result."""
    both = imaging.select(col(key), decode_age("AgeAtImageScan").alias("age_at_lab")).unionByName(
        labs.select(col(key), decode_age("AgeAtLabResults").alias("age_at_lab")))
    return both.groupBy(col(key)).agg(F.max("age_at_lab").alias("age_at_lab"))


def sequencing_events(table: DataFrame, key: str = KEY) -> DataFrame:
    return table.where(col("TumorSequencingInd") == "Yes").select(
        col(key), decode_age("AgeAtTumorSequencing").alias("AgeAtTumorSequencing"))


def cytogenetics(table: DataFrame, key: str = KEY, values: Sequence[str] | None = None,
                 on_duplicate: str = "error", others: str = "error") -> DataFrame:
    """Positive abnormalities, one column per name; one outside ``values`` is an error, unless ``others`` is ``drop``."""
    positive = table.where(col("CytogenAbnormResult") == "Positive").select(
        col(key), "CytogenAbnormName", "CytogenAbnormInd").distinct()
    return pivot_wide(positive, [key], "CytogenAbnormName", "CytogenAbnormInd", values, on_duplicate, others)


# --- samples ---------------------------------------------------------------------------------------

def germline_samples(linkage: DataFrame, key: str = KEY) -> DataFrame:
    return linkage.where(col("TumorGermline") == "Germline").select(
        col(key), F.col("WES").alias("Germline_WES"), F.col("SpecimenAge").alias("germline_collection_age"),
        F.col("SpecimenSiteOfCollection").alias("germline_SpecimenSiteOfCollection"))


def tumor_samples(linkage: DataFrame, msi: DataFrame, key: str = KEY) -> DataFrame:
    """Tumour rows of the linkage with the MSI flag; ``msi`` has key, ``WES`` and ``MSI_score``."""
    flags = msi.select(col(key), "WES", msi_high("MSI_score").alias("MSI_high_score"))
    rows = join_ns(linkage.where(col("TumorGermline") == "Tumor"), flags, [key, "WES"], "left")
    return rows.select(col(key), F.col("WES").alias("Tumor_WES"), F.col("SpecimenAge").alias("tumor_collection_age"),
                       "DiseaseType", F.col("SpecimenSiteOfCollection").alias("tumor_SpecimenSiteOfCollection"),
                       "MSI_high_score")


def link_samples(pairs: DataFrame, linkage: DataFrame, msi: DataFrame, key: str = KEY) -> DataFrame:
    """Collection ages and sites of listed germline/tumour pairs."""
    out = pair_lookup(pairs, germline_samples(linkage, key), tumor_samples(linkage, msi, key), key,
                      "Germline_WES", "Tumor_WES")
    return across(out, ["germline_collection_age", "tumor_collection_age"], decode_age)


def ch_status(samples: Mapping[str, DataFrame], calls: Mapping[str, DataFrame], key: str = KEY) -> DataFrame:
    """Mutation status per sample pair from per-cancer sample lists and mutation calls.

    ``samples``: key, ``Germline``, ``Tumor_WES``; ``calls``: key, ``patient_id_wes``, ``Tumor``, ``Tumor_VAF``
    ("." = not seen in the tumour). Whether the tumour carries it is judged per patient and cancer.
    """
    ids = [key, "Germline_WES", "Tumor_WES", "cancer_type"]
    listed = tagged_union(samples, "cancer_type").withColumnRenamed("Germline", "Germline_WES")
    called = tagged_union(calls, "cancer_type").withColumnsRenamed({"patient_id_wes": "Germline_WES", "Tumor": "Tumor_WES"})
    called = called.withColumn("Tumor_WES", remove_first("Tumor_WES", "_st_t"))
    called = group_any(called, [key, "cancer_type"], F.col("Tumor_VAF") != ".", "CH_detected_in_tumor")
    once = called.groupBy(*ids).agg(F.bool_or("CH_detected_in_tumor").alias("CH_detected_in_tumor"))
    once = once.withColumn("ch_status", F.lit("CH"))
    return join_ns(listed, once, ids, "full").withColumn("ch_status", F.coalesce(F.col("ch_status"), F.lit("No CH")))


def upgrade_status(patients: DataFrame, mask: DataFrame, patient: str = "PATIENT_ID", status: str = "CH_status",
                   value: str = "CHIP", sample: str = "sample_id", flag: str = "flag", id_length: int = 12) -> DataFrame:
    """Set the status of patients one of whose samples carries a flagged variant.

    The patient id is the start of the sample id.
    """
    hit = any_flag_by_sample(mask, sample, flag, "__any").where("__any").select(
        F.substring(col(sample), 1, id_length).alias("__patient"))
    return member_update(patients, patient, hit, "__patient", status, value)
