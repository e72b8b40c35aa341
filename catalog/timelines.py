"""Treatment timelines and endpoints on the stand-in registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import longs, query, rounded
from catalog.registry import age_sql, stand_in, stand_ins, with_tables
from catalog.statistics import _table
from vitaspan import decode_age, first_of, last_contact
from vitaspan.operators.frames import across
from vitaspan.plans import timeline as tl
from vitaspan.plans.cohort import LUNG_TABLES, lung_table, lung_treatment_cohort
from vitaspan.plans.endpoints import (metastasis_free_survival, overall_survival, progression_free_survival)

KEY = "patient_id"

_CLEAN = """lower(CASE WHEN contains(short, 'Paclitaxel') THEN 'Paclitaxel' WHEN short = 'Interferon, NOS' THEN 'Interferon'
    WHEN short = 'Bevacizumab-maly' THEN 'Bevacizumab' ELSE short END)"""
# fixed values: suffixes dropped from drug names
_SUFFIX = ("' Hydrochloride|Liposomal | Sulfate| Phosphate| Citrate| Acetate| Camsylate| Disodium| Mesylate| Ditosylate| Tosylate"
           "| Tartrate'")
# fixed values: words for the line of therapy and their codes
_CODE = """CASE WHEN contains(MedLineRegimen, 'Unknown') THEN 999 WHEN contains(MedLineRegimen, 'First') AND contains(MedLineRegimen,
    'Neoadjuvant') THEN -1 WHEN contains(MedLineRegimen, 'First') AND contains(MedLineRegimen, 'Adjuvant') THEN 1
    WHEN contains(MedLineRegimen, 'Second') THEN 2 WHEN contains(MedLineRegimen, 'Third') THEN 3
    WHEN contains(MedLineRegimen, 'Fourth') THEN 4 WHEN contains(MedLineRegimen, 'Fifth') THEN 5
    WHEN contains(MedLineRegimen, 'Sixth') THEN 6 WHEN contains(MedLineRegimen, 'Seventh') THEN 7
    WHEN contains(MedLineRegimen, 'Eighth') THEN 8 WHEN contains(MedLineRegimen, 'Ninth') THEN 9
    WHEN contains(MedLineRegimen, 'Tenth') THEN 10 WHEN contains(MedLineRegimen, 'Eleventh') THEN 11
    WHEN contains(MedLineRegimen, 'Twelfth') THEN 12 WHEN MedLineRegimen = 'Maintenance' THEN 90 WHEN MedLineRegimen = 'Palliative'
    THEN 91 ELSE 1000 END"""
# medication history in steps: decode, fall back to the stop, number lines, drop repeats, year of the earliest record
_HISTORY = f"""m0 AS (SELECT * EXCLUDE (AgeAtMedStart, AgeAtMedStop, Medication), {age_sql('AgeAtMedStart')} AS start, {age_sql('AgeAtMedStop')}
        AS stop, regexp_replace(Medication, {_SUFFIX}, '') AS short FROM Medications),
    m1 AS (SELECT patient_id, rec, MedicationInd, {_CLEAN} AS drug, YearOfMedStart, MedLineRegimen, coalesce(start, stop) AS start, stop,
        start AS raw_start, min(coalesce(start, stop)) OVER (PARTITION BY patient_id) AS ever_first_med_age FROM m0),
    m2 AS (SELECT *, {_CODE} AS code, bool_or(contains(MedLineRegimen, 'Unknown')) OVER w AND bool_and(contains(MedLineRegimen,
        'Unknown')) OVER w AS no_info FROM m1 WHERE MedicationInd = 'Yes' WINDOW w AS (PARTITION BY patient_id)),
    m3 AS (SELECT *, CASE WHEN coalesce(no_info, false) THEN CASE WHEN start IS NOT NULL THEN dense_rank() OVER (PARTITION BY
        patient_id, start IS NULL ORDER BY start, code) END ELSE code END AS regimen_line FROM m2),
    m4 AS (SELECT patient_id, rec, MedicationInd, drug, YearOfMedStart, start, stop, ever_first_med_age, regimen_line FROM m3 UNION ALL
        SELECT patient_id, rec, MedicationInd, drug, YearOfMedStart, raw_start, stop, NULL, NULL FROM m1 WHERE MedicationInd = 'No'),
    m5 AS (SELECT * FROM m4 QUALIFY row_number() OVER (PARTITION BY patient_id, start, drug, stop ORDER BY regimen_line NULLS LAST,
        YearOfMedStart NULLS LAST, rec) = 1),
    history AS (SELECT *, first_value(YearOfMedStart) OVER (PARTITION BY patient_id ORDER BY start NULLS LAST, stop NULLS LAST,
        drug NULLS LAST, rec ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS year_first_medication FROM m5)"""
_NUM = "regexp_replace(CAST(stop AS VARCHAR), '\\.0$', '')"
_LONG = f"""r1 AS (SELECT patient_id, regimen_line, start, MedicationInd, ever_first_med_age, year_first_medication, stop, CASE WHEN
        bool_or(drug IS NULL) THEN NULL ELSE string_agg(drug, '; ' ORDER BY drug) END AS drugs FROM history GROUP BY ALL),
    long AS (SELECT patient_id, regimen_line, start, MedicationInd, ever_first_med_age, year_first_medication, CASE WHEN bool_or(drugs IS
        NULL) THEN NULL ELSE string_agg(drugs, '; ' ORDER BY stop NULLS LAST, drugs) END AS regimen_drugs, CASE WHEN bool_or(stop IS NULL)
        THEN NULL ELSE string_agg({_NUM}, '; ' ORDER BY stop, drugs) END AS stops FROM r1 GROUP BY ALL)"""


def _history(t):
    # one physical source for the record id: repeats of (start, drug, stop) fall back to it
    return tl.medication_history(stand_in(t, "Medications").drop("MedPrimaryDiagnosisSiteCode", "MedPrimaryDiagnosisSite"), KEY)


@query(f"""{with_tables('Medications')}, s AS (SELECT Medication, regexp_replace(Medication, {_SUFFIX}, '') AS short FROM Medications)
    SELECT Medication, {_CLEAN} AS drug, count(*) AS n FROM s GROUP BY ALL""")
def drug_names(t):
    return stand_in(t, "Medications").groupBy("Medication", tl.clean_drug("Medication").alias("drug")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""{with_tables('Medications')}, m AS (SELECT *, {_CODE} AS code, {age_sql('AgeAtMedStart')} AS start, bool_or(contains(MedLineRegimen,
    'Unknown')) OVER w AND bool_and(contains(MedLineRegimen, 'Unknown')) OVER w AS no_info FROM Medications WINDOW w AS (PARTITION BY
    patient_id)) SELECT rec, CASE WHEN no_info THEN CASE WHEN start IS NOT NULL THEN dense_rank() OVER (PARTITION BY patient_id,
    start IS NULL ORDER BY start, code) END ELSE code END AS regimen_line FROM m""")
def line_of_therapy(t):
    m = across(stand_in(t, "Medications"), ["AgeAtMedStart"], decode_age)
    return longs(tl.line_of_therapy(m, KEY, "MedLineRegimen", "AgeAtMedStart").select("rec", "regimen_line"), "regimen_line")


@query(f"""{with_tables('Medications')}, {_HISTORY} SELECT patient_id, rec, MedicationInd, drug, start, stop, ever_first_med_age,
    regimen_line, year_first_medication FROM history""")
def medication_history(t):
    h = _history(t).withColumnsRenamed({"Medication": "drug", "AgeAtMedStart": "start", "AgeAtMedStop": "stop"})
    return longs(h.select(KEY, "rec", "MedicationInd", "drug", "start", "stop", "ever_first_med_age", "regimen_line",
                          "year_first_medication"), "regimen_line")


@query(f"""{with_tables('Medications')}, {_HISTORY}, {_LONG} SELECT * FROM long""")
def regimens_long(t):
    long = tl.medication_regimens(_history(t), KEY).withColumnsRenamed({"AgeAtMedStart": "start", "AgeAtMedStop": "stops"})
    return longs(long, "regimen_line")


_MED_NUMBERED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY start NULLS LAST, regimen_line NULLS LAST,
    MedicationInd, ever_first_med_age NULLS LAST, year_first_medication NULLS LAST, regimen_drugs NULLS LAST, stops NULLS LAST) AS n FROM long)"""


def _long_again(wide, ids: list[str], names: list[str]):
    """The filled cells of an uncapped wide table, one row per ordinal: its width follows the data, its check does not."""
    width = sum(c.startswith(f"{names[0]}_") and c.removeprefix(f"{names[0]}_").isdigit() for c in wide.columns)
    cells = [F.struct(F.lit(i).alias("n"), *[F.col(f"{v}_{i}").alias(v) for v in names]) for i in range(1, width + 1)]
    return wide.select(*ids, F.explode(F.array(*cells)).alias("c")).select(*ids, "c.*").where(
        " OR ".join(f"{v} IS NOT NULL" for v in names))


@query(f"""{with_tables('Medications')}, {_HISTORY}, {_LONG}, {_MED_NUMBERED}, first AS (SELECT patient_id, MedicationInd, ever_first_med_age,
    year_first_medication, max(CASE WHEN n = 1 THEN start END) AS begun FROM numbered GROUP BY ALL) SELECT patient_id, MedicationInd AS drug_ever,
    ever_first_med_age, year_first_medication, CASE WHEN begun > m.ever_first_med_age THEN 'Yes' END AS had_prior_medication,
    CAST(n AS INT) AS n, start AS AgeAtMedStart, regimen_drugs, stops AS AgeAtMedStop FROM numbered m JOIN first f ON m.patient_id =
    f.patient_id AND m.MedicationInd IS NOT DISTINCT FROM f.MedicationInd AND m.ever_first_med_age IS NOT DISTINCT FROM f.ever_first_med_age
    AND m.year_first_medication IS NOT DISTINCT FROM f.year_first_medication
    WHERE start IS NOT NULL OR regimen_drugs IS NOT NULL OR stops IS NOT NULL""".replace(
    "SELECT patient_id, MedicationInd AS drug_ever,\n    ever_first_med_age, year_first_medication, CASE",
    "SELECT m.patient_id, m.MedicationInd AS drug_ever,\n    m.ever_first_med_age, m.year_first_medication, CASE"))
def regimens_wide(t):
    """All regimens side by side, however many; compared cell by cell."""
    wide = tl.regimens_wide(tl.medication_regimens(_history(t), KEY), KEY)
    return _long_again(wide, [KEY, "drug_ever", "ever_first_med_age", "year_first_medication", "had_prior_medication"],
                       ["AgeAtMedStart", "regimen_drugs", "AgeAtMedStop"])


_RAD = f"""r0 AS (SELECT patient_id, rec, RadiationTherapyInd, {age_sql('AgeAtRadiationStart')} AS start, {age_sql('AgeAtRadiationStop')} AS
        stop, TRY_CAST(RadDose AS DOUBLE) AS dose, YearOfRadiationStart AS y FROM Radiation),
    r1x AS (SELECT *, min(start) OVER (PARTITION BY patient_id) AS ever_first_rad_age, first_value(y) OVER (PARTITION BY patient_id ORDER
        BY start NULLS LAST, stop NULLS LAST, dose NULLS LAST, rec ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS
        year_first_radiation FROM r0),
    r2x AS (SELECT * FROM r1x QUALIFY row_number() OVER (PARTITION BY patient_id, start, dose, stop ORDER BY y, rec) = 1),
    rads AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY start NULLS LAST, stop NULLS LAST, dose NULLS LAST, rec) AS n
        FROM r2x)"""


@query(f"""{with_tables('Radiation')}, {_RAD} SELECT patient_id, RadiationTherapyInd AS radiation_ever, ever_first_rad_age, year_first_radiation,
    CAST(n AS INT) AS n, start AS AgeAtRadiationStart, dose AS RadDose, stop AS AgeAtRadiationStop FROM rads
    WHERE start IS NOT NULL OR dose IS NOT NULL OR stop IS NOT NULL""")
def radiation_wide(t):
    """All radiation records side by side, however many; compared cell by cell."""
    r = stand_in(t, "Radiation").drop("RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite")
    return _long_again(tl.radiation_wide(tl.radiation_history(r, KEY), KEY), [KEY, "radiation_ever", "ever_first_rad_age", "year_first_radiation"],
                       ["AgeAtRadiationStart", "RadDose", "AgeAtRadiationStop"])


_TIMING_COLUMNS = ["patient_id", "Germline", "drug_ever", "radiation_ever", "drug_radiation_ever", "blood_before_drug", "blood_before_rad",
                   "blood_before_drugorrad", "treatment_sequence", "years_blood_before_drug", "years_blood_after_drug",
                   "years_blood_before_rad", "years_blood_after_rad", "years_blood_before_drugrad", "years_blood_after_drugrad"]


_LUNG = f"""{with_tables('Samples', 'ClinicalMolLinkage', 'Medications', 'Radiation')}, {_HISTORY}, {_LONG}, {_MED_NUMBERED}, {_RAD},
    med AS (SELECT patient_id, MedicationInd AS drug_ever, ever_first_med_age, year_first_medication, max(CASE WHEN n = 1 THEN start END) AS
        AgeAtMedStart_1, max(CASE WHEN n = 1 THEN regimen_drugs END) AS regimen_drugs_1 FROM numbered GROUP BY ALL),
    rad AS (SELECT patient_id, RadiationTherapyInd AS radiation_ever, ever_first_rad_age, year_first_radiation, max(CASE WHEN n = 1 THEN start
        END) AS AgeAtRadiationStart_1 FROM rads GROUP BY ALL),
    c AS (SELECT patient_id, WES, {age_sql('SpecimenAge')} AS s FROM ClinicalMolLinkage),
    j AS (SELECT s.patient_id, s.Germline, c.s, drug_ever, radiation_ever, AgeAtMedStart_1 AS d, AgeAtRadiationStart_1 AS r,
        regimen_drugs_1, year_first_medication, year_first_radiation FROM Samples s
        LEFT JOIN c ON s.patient_id = c.patient_id AND s.Germline IS NOT DISTINCT FROM c.WES
        LEFT JOIN c c2 ON s.patient_id = c2.patient_id AND s.Tumor_WES IS NOT DISTINCT FROM c2.WES
        LEFT JOIN med ON s.patient_id = med.patient_id LEFT JOIN rad ON s.patient_id = rad.patient_id),
    k AS (SELECT *, CASE WHEN drug_ever = 'Yes' AND radiation_ever = 'Yes' THEN 'Drug+Radiation' WHEN drug_ever = 'Yes' THEN 'Drug only'
            WHEN radiation_ever = 'Yes' THEN 'Radiation only' WHEN drug_ever = 'No' AND radiation_ever = 'No' THEN 'No drug or radiation'
            WHEN drug_ever = 'No' THEN 'Not received drug' WHEN radiation_ever = 'No' THEN 'Not received rad' END AS drug_radiation_ever,
        CASE WHEN s <= d THEN 'blood before drug' WHEN s > d THEN 'blood after drug' WHEN drug_ever = 'No' THEN 'No drug received'
            WHEN s IS NULL THEN 'no germline age' WHEN d IS NULL THEN 'missing drug age' END AS blood_before_drug,
        CASE WHEN s <= r THEN 'blood before rad' WHEN s > r THEN 'blood after rad' WHEN radiation_ever = 'No' THEN 'No rad received'
            WHEN s IS NULL THEN 'no germline age' WHEN r IS NULL THEN 'missing rad age' END AS blood_before_rad,
        CASE WHEN s <= d AND s <= r THEN 'blood before drug/rad' WHEN s > d AND s > r THEN 'blood after drug/rad'
            WHEN drug_ever = 'No' AND radiation_ever = 'No' THEN 'No drug/rad received' WHEN drug_ever = 'Yes' AND radiation_ever = 'No'
            THEN 'Drug only' WHEN radiation_ever = 'Yes' AND drug_ever = 'No' THEN 'Radiation only' WHEN d IS NULL AND r IS NULL THEN
            'missing drug and rad age' WHEN d IS NULL THEN 'missing drug age' WHEN r IS NULL THEN 'missing rad age' WHEN s > d AND s <= r
            THEN 'drug/blood/rad' WHEN s <= d AND s > r THEN 'rad/blood/drug' END AS blood_before_drugorrad,
        CASE WHEN d <= r THEN 'drug/rad' WHEN d > r THEN 'rad/drug' WHEN drug_ever = 'No' AND radiation_ever = 'No' THEN
            'No drug or radiation' WHEN drug_ever = 'Yes' AND radiation_ever = 'No' THEN 'Drug only' WHEN radiation_ever = 'Yes' AND
            drug_ever = 'No' THEN 'Radiation only' WHEN d IS NULL AND r IS NULL THEN 'missing drug and rad age' WHEN d IS NULL THEN
            'missing drug age' WHEN r IS NULL THEN 'missing rad age' END AS treatment_sequence FROM j)"""
_TIMING = """
    SELECT patient_id, Germline, drug_ever, radiation_ever, drug_radiation_ever, blood_before_drug, blood_before_rad,
        blood_before_drugorrad, treatment_sequence,
        round(CASE WHEN blood_before_drug = 'blood before drug' THEN s - d END, 6) AS years_blood_before_drug,
        round(CASE WHEN blood_before_drug = 'blood after drug' THEN d - s END, 6) AS years_blood_after_drug,
        round(CASE WHEN blood_before_rad = 'blood before rad' THEN s - r END, 6) AS years_blood_before_rad,
        round(CASE WHEN blood_before_rad = 'blood after rad' THEN r - s END, 6) AS years_blood_after_rad,
        round(CASE WHEN blood_before_drugorrad = 'blood before drug/rad' THEN s - CASE WHEN d <= r THEN d ELSE r END END, 6) AS
        years_blood_before_drugrad,
        round(CASE WHEN blood_before_drugorrad = 'blood after drug/rad' THEN s - CASE WHEN d <= r THEN d ELSE r END END, 6) AS
        years_blood_after_drugrad FROM k"""


@query(_LUNG + _TIMING)
def blood_vs_treatment(t):
    """Whole lung pipeline: sample ages, regimens, radiation, timing classes and gaps."""
    r = stand_ins(t, "Samples", "ClinicalMolLinkage", "Medications", "Radiation")
    meds = r["Medications"].drop("MedPrimaryDiagnosisSiteCode", "MedPrimaryDiagnosisSite")
    rad = r["Radiation"].drop("RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite")
    return rounded(lung_treatment_cohort(r["Samples"], r["ClinicalMolLinkage"], meds, rad, KEY).select(*_TIMING_COLUMNS))


def _lung_table_sql(which: str) -> str:
    variables = LUNG_TABLES[which]
    numbers = [v for v in variables if v.startswith("year")]
    where = {"drugs": " WHERE drug_ever = 'Yes'", "radiation": " WHERE radiation_ever = 'Yes'"}.get(which, "")
    shown = _TIMING.replace("FROM k", ", regimen_drugs_1, year_first_medication, year_first_radiation FROM k")
    table = _table({"Overall": "true"}, [v for v in variables if v not in numbers], numbers)
    return f"""{_LUNG}, lung AS ({shown}), p AS (SELECT * FROM lung{where}), s AS ({table})
        SELECT * REPLACE (round(value, CASE WHEN kind = 'continuous' THEN 1 ELSE 6 END) AS value) FROM s"""


def _lung_table(t, which):
    r = stand_ins(t, "Samples", "ClinicalMolLinkage", "Medications", "Radiation")
    meds = r["Medications"].drop("MedPrimaryDiagnosisSiteCode", "MedPrimaryDiagnosisSite")
    rad = r["Radiation"].drop("RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite")
    cohort = lung_treatment_cohort(r["Samples"], r["ClinicalMolLinkage"], meds, rad, KEY)
    gaps = [c for c in cohort.columns if c.startswith("years_blood")]
    return rounded(lung_table(cohort.withColumns({c: F.round(c, 6) for c in gaps}), which))


@query(_lung_table_sql("timing"))
def lung_timing_table(t):
    """Summary of the lung pipeline's own result: sequences, timing classes and gaps."""
    return _lung_table(t, "timing")


@query(_lung_table_sql("drugs"))
def lung_drug_table(t):
    return _lung_table(t, "drugs")


@query(_lung_table_sql("radiation"))
def lung_radiation_table(t):
    return _lung_table(t, "radiation")


# --- first of four, contact, endpoints -------------------------------------------------------------

_FOUR = """four AS (SELECT o_custkey, min(CASE o_orderpriority WHEN '1-URGENT' THEN y END) AS rad, min(CASE o_orderpriority WHEN '2-HIGH'
    THEN y END) AS surg, min(CASE o_orderpriority WHEN '3-MEDIUM' THEN y END) AS drug, min(CASE WHEN o_orderpriority = '5-LOW' AND
    o_orderstatus = 'F' THEN y END) AS sct FROM (SELECT *, CAST(year(o_orderdate) AS INT) * 12 + CAST(month(o_orderdate) AS INT) AS y
    FROM orders) GROUP BY 1)"""


@query(f"""WITH {_FOUR}, x AS (SELECT *, least(rad, surg, drug, sct) AS low FROM four), y AS (SELECT *, (CASE WHEN rad = low THEN 1 ELSE 0 END
    + CASE WHEN surg = low THEN 1 ELSE 0 END + CASE WHEN drug = low THEN 1 ELSE 0 END + CASE WHEN sct = low THEN 1 ELSE 0 END) AS hits FROM x)
    SELECT o_custkey, CASE WHEN hits = 1 THEN CASE low WHEN rad THEN 'Radiation' WHEN surg THEN 'Surgery' WHEN drug THEN 'Drugs' ELSE 'SCT'
    END END AS first_treatment, CASE WHEN hits = 1 THEN low END AS first_month FROM y""")
def first_of_four(t):
    """Strictly earliest of four months; a tie has no label."""
    o = t.orders.withColumn("y", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    p, y = F.col("o_orderpriority"), F.col("y")
    four = o.groupBy("o_custkey").agg(
        F.min(F.when(p == "1-URGENT", y)).alias("rad"), F.min(F.when(p == "2-HIGH", y)).alias("surg"),
        F.min(F.when(p == "3-MEDIUM", y)).alias("drug"),
        F.min(F.when((p == "5-LOW") & (F.col("o_orderstatus") == "F"), y)).alias("sct"))
    label, value = first_of({"Radiation": "rad", "Surgery": "surg", "Drugs": "drug", "SCT": "sct"})
    return four.select("o_custkey", label.alias("first_treatment"), value.alias("first_month"))


@query(f"""{with_tables('VitalStatus', 'Imaging', 'Labs')}, l AS (SELECT patient_id, max(age) AS seen FROM (SELECT patient_id,
    {age_sql('AgeAtImageScan')} AS age FROM Imaging UNION ALL SELECT patient_id, {age_sql('AgeAtLabResults')} FROM Labs) GROUP BY 1),
    v AS (SELECT *, {age_sql('AgeAtLastContact')} AS contact FROM VitalStatus)
    SELECT patient_id, greatest(contact, seen) AS latest, CASE WHEN contact >= seen THEN contact WHEN contact < seen THEN seen END AS strict_latest
    FROM v LEFT JOIN l USING (patient_id)""")
def reconciled_contact(t):
    from vitaspan.plans.clinical import last_seen, vital_status

    r = stand_ins(t, "VitalStatus", "Imaging", "Labs")
    both = vital_status(r["VitalStatus"]).join(last_seen(r["Imaging"], r["Labs"]), KEY, "left")
    return both.select(KEY, last_contact("AgeAtLastContact", "age_at_lab").alias("latest"),
                       last_contact("AgeAtLastContact", "age_at_lab", strict=True).alias("strict_latest"))


_SURVIVAL = f"""{with_tables('VitalStatus', 'Diagnosis', 'Outcomes', 'MetastaticDisease')},
    d AS (SELECT patient_id, min({age_sql('AgeAtDiagnosis')}) AS dx, max({age_sql('AgeAtDiagnosis')}) AS tx FROM Diagnosis GROUP BY 1),
    o AS (SELECT patient_id, ProgRecurInd, {age_sql('AgeAtProgRecur')} AS prog FROM Outcomes QUALIFY row_number() OVER (PARTITION BY
        patient_id ORDER BY rec) = 1),
    m AS (SELECT patient_id, MetastaticDiseaseInd, {age_sql('AgeAtMetastaticSite')} AS met FROM MetastaticDisease QUALIFY row_number() OVER
        (PARTITION BY patient_id ORDER BY rec) = 1),
    b AS (SELECT v.patient_id, VitalStatus, {age_sql('AgeAtLastContact')} AS contact, {age_sql('AgeAtDeath')} AS death, dx, tx,
        ProgRecurInd, prog, MetastaticDiseaseInd AS met_ind, met FROM VitalStatus v LEFT JOIN d USING (patient_id) LEFT JOIN o USING
        (patient_id) LEFT JOIN m USING (patient_id)),
    e AS (SELECT *, CASE VitalStatus WHEN 'Alive' THEN 0 WHEN 'Lost to follow-up' THEN 0 WHEN 'Dead' THEN 1 END AS os_event,
        coalesce(death, contact) AS os_age, CASE ProgRecurInd WHEN 'No' THEN 0 WHEN 'Progression' THEN 1 WHEN 'Recurrence' THEN 1 END
        AS pfs_event FROM b)"""


def _subjects(t):
    from vitaspan import first_per_key
    from vitaspan.plans.clinical import vital_status

    r = stand_ins(t, "VitalStatus", "Diagnosis", "Outcomes", "MetastaticDisease")
    age = decode_age("AgeAtDiagnosis")
    d = r["Diagnosis"].groupBy(KEY).agg(F.min(age).alias("dx"), F.max(age).alias("tx"))
    o = first_per_key(r["Outcomes"], [KEY], ["rec"], ties=[]).select(KEY, "ProgRecurInd", decode_age("AgeAtProgRecur").alias("AgeAtProgRecur"))
    m = first_per_key(r["MetastaticDisease"], [KEY], ["rec"], ties=[]).select(
        KEY, F.col("MetastaticDiseaseInd").alias("had_metastasis"), decode_age("AgeAtMetastaticSite").alias("AgeAtMetastaticSite"))
    return vital_status(r["VitalStatus"]).join(d, KEY, "left").join(o, KEY, "left").join(m, KEY, "left")


_ORIGINS = {"dx": "dx", "treatment": "tx"}


@query(f"""{_SURVIVAL} SELECT patient_id, os_event, os_age, round(os_age - dx, 6) AS os_time_from_dx_years, round(os_age - tx, 6) AS
    os_time_from_treatment_years FROM e""")
def os_endpoint(t):
    df = overall_survival(_subjects(t), _ORIGINS)
    return rounded(df.select(KEY, "os_event", "os_age", "os_time_from_dx_years", "os_time_from_treatment_years"))


@query(f"""{_SURVIVAL}, p AS (SELECT *, CASE pfs_event WHEN 0 THEN os_age WHEN 1 THEN prog END AS pfs_age FROM e)
    SELECT patient_id, pfs_event, pfs_age, round(pfs_age - dx, 6) AS pfs_time_from_dx_years, round(pfs_age - tx, 6) AS
    pfs_time_from_treatment_years FROM p""")
def pfs_endpoint(t):
    df = progression_free_survival(overall_survival(_subjects(t), _ORIGINS), _ORIGINS)
    return rounded(df.select(KEY, "pfs_event", "pfs_age", "pfs_time_from_dx_years", "pfs_time_from_treatment_years"))


@query(f"""{_SURVIVAL} SELECT patient_id, CASE WHEN met_ind = 'Yes' THEN 1 WHEN met_ind IS NULL THEN 0 END AS met_event,
    coalesce(met, contact) AS met_age, round(coalesce(met, contact) - dx, 6) AS met_time_from_dx_years,
    round(coalesce(met, contact) - tx, 6) AS met_time_from_treatment_years, pfs_event, round(coalesce(prog, contact) - dx, 6) AS
    pfs_time_from_dx_years FROM e""")
def met_endpoint(t):
    """Metastasis endpoint, and the progression endpoint in its coalescing form."""
    df = progression_free_survival(_subjects(t), _ORIGINS, contact="AgeAtLastContact", coalesced=True)
    df = metastasis_free_survival(df, _ORIGINS)
    return rounded(df.select(KEY, "met_event", "met_age", "met_time_from_dx_years", "met_time_from_treatment_years", "pfs_event",
                             "pfs_time_from_dx_years"))
