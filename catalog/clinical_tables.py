"""Per-table reductions of the stand-in registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import longs, query, rounded
from catalog.registry import age_sql, stand_in, with_tables

from vitaspan.plans import clinical as c
from vitaspan.plans.endpoints import coded_endpoints, complete_for, set_unit, stack_cohorts

KEY = "patient_id"

_RACE = """CASE WHEN contains(Race, 'American Indian') THEN 'American Indian or Alaska Native' WHEN Race IN ('White', 'Black') THEN Race
    WHEN contains(Race, 'Asian') OR contains(Race, 'Cambodian') OR Race IN ('Chinese', 'Filipino', 'Japanese', 'Korean', 'Pakistani', 'Thai',
    'Vietnamese', 'Laotian') THEN 'Asian' WHEN Race IN ('Hawaiian', 'Micronesian, NOS', 'Pacific Islander, NOS', 'Polynesian, NOS', 'Samoan',
    'Tongan ese') THEN 'Native Hawaiian or Other Pacific Islander' WHEN contains(Race, 'Unknown') OR Race = 'Other' THEN 'Unknown' ELSE Race END"""
_ETH = """CASE WHEN Ethnicity = 'Spanish surname only' OR contains(Ethnicity, 'Non-Hispanic') THEN 'Non-Hispanic' WHEN contains(Ethnicity,
    'Unknown') THEN 'Unknown' ELSE 'Hispanic' END"""


@query(f"""{with_tables('PatientMaster')}, g AS (SELECT patient_id, Sex, {_RACE} AS Race, {_ETH} AS Ethnicity FROM PatientMaster)
    SELECT *, CASE WHEN Ethnicity = 'Hispanic' THEN 'Hispanic' WHEN Ethnicity = 'Non-Hispanic' THEN CASE Race WHEN 'White' THEN
    'White Non-Hispanic' WHEN 'Black' THEN 'Black' WHEN 'Others' THEN 'Others Non-Hispanic' END END AS race_eth FROM g""")
def demographics(t):
    return c.demographics(stand_in(t, "PatientMaster"))


@query(f"""{with_tables('PatientHistory')} SELECT patient_id, CASE WHEN SmokingStatus = 'Never' THEN 'Never' WHEN SmokingStatus = 'Current' OR
    contains(SmokingStatus, 'Ever') THEN 'Ever' END AS SmokingStatus FROM PatientHistory""")
def smoking_status(t):
    return c.smoking(stand_in(t, "PatientHistory"))


@query(f"""{with_tables('VitalStatus')} SELECT patient_id, VitalStatus, {age_sql('AgeAtLastContact')} AS AgeAtLastContact,
    {age_sql('AgeAtDeath')} AS AgeAtDeath FROM VitalStatus""")
def vital_status(t):
    return c.vital_status(stand_in(t, "VitalStatus"))


_DX = f"""dx0 AS (SELECT * EXCLUDE (AgeAtDiagnosis), {age_sql('AgeAtDiagnosis')} AS AgeAtDiagnosis, CASE WHEN AgeAtDiagnosis = 'Age 90 or older'
        THEN 'Age 90 or older' END AS not_real_age, nullif(regexp_extract(PerformStatusAtDiagnosis, 'ECOG (\\d)', 1), '') AS ECOG,
        nullif(regexp_extract(PerformStatusAtDiagnosis, 'Karnofsky (\\d.*)%', 1), '') AS Karnofsky, CASE OtherStagingSystem WHEN 'ISS' THEN
        OtherStagingValue END AS iss FROM Diagnosis),
    dx1 AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY AgeAtDiagnosis NULLS LAST, rec) AS diagnosis_sequence,
        count(*) OVER (PARTITION BY patient_id) AS how_many_dx FROM dx0),
    dx AS (SELECT *, CASE WHEN how_many_dx > 1 THEN 'Yes' END AS has_subsequent_cancer, coalesce(first_value(iss IGNORE NULLS) OVER (PARTITION
        BY patient_id ORDER BY diagnosis_sequence ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(iss IGNORE NULLS) OVER
        (PARTITION BY patient_id ORDER BY diagnosis_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS iss_stage FROM dx1)"""


@query(f"""{with_tables('Diagnosis')}, {_DX} SELECT rec, AgeAtDiagnosis, not_real_age, ECOG, Karnofsky, iss_stage, diagnosis_sequence,
    how_many_dx, has_subsequent_cancer FROM dx""")
def diagnosis_timeline(t):
    df = c.diagnoses(stand_in(t, "Diagnosis"))
    return longs(df.select("rec", "AgeAtDiagnosis", "not_real_age", "ECOG", "Karnofsky", "iss_stage", "diagnosis_sequence", "how_many_dx",
                           "has_subsequent_cancer"), "diagnosis_sequence")


def _filled(name: str) -> str:
    w = "PARTITION BY patient_id ORDER BY diagnosis_sequence ROWS BETWEEN"
    return (f"coalesce(first_value({name} IGNORE NULLS) OVER ({w} CURRENT ROW AND UNBOUNDED FOLLOWING), last_value({name} IGNORE NULLS) OVER "
            f"({w} UNBOUNDED PRECEDING AND CURRENT ROW))")


_TARGET = f"""t1 AS (SELECT *, coalesce(Histology = 'Multiple myeloma', false) AS hit, row_number() OVER (PARTITION BY patient_id, Histology ORDER BY
        diagnosis_sequence) AS nth, YearOfDiagnosis - 1950 AS sample_age FROM dx),
    t2 AS (SELECT *, CASE WHEN hit THEN CASE nth WHEN 1 THEN '1st MM dx' WHEN 2 THEN '2nd MM dx' WHEN 3 THEN '3rd MM dx' ELSE CAST(nth AS
        VARCHAR) END ELSE coalesce(Histology, 'NA') || ' (' || PrimaryDiagnosisSite || ')' END AS MM_sequence, CASE WHEN hit AND nth = 1 THEN
        AgeAtDiagnosis END AS f, CASE WHEN hit AND nth <= 3 THEN AgeAtDiagnosis END AS l, CASE WHEN Histology = 'Monoclonal gammopathy' THEN
        AgeAtDiagnosis END AS g, max(CASE WHEN hit THEN 'Yes' END) OVER (PARTITION BY patient_id) AS had FROM t1),
    t3 AS (SELECT *, {_filled('f')} AS ff, {_filled('l')} AS fl, {_filled('g')} AS fg FROM t2),
    t4 AS (SELECT *, CASE WHEN fl >= fg THEN 'Yes' WHEN fl < fg THEN 'MGUS patient' WHEN had = 'Yes' THEN 'Yes' ELSE 'No' END AS is_patient FROM t3)"""


@query(f"""{with_tables('Diagnosis')}, {_DX}, {_TARGET}
    SELECT rec, MM_sequence, had AS had_MM_at_anytime, ff AS age_at_first_MM_dx, fl AS age_at_last_MM_dx, fg AS age_at_MGUS_dx, is_patient AS
    is_patient_MM, CASE WHEN is_patient IN ('MGUS patient', 'No') THEN 'No' WHEN sample_age > fg THEN 'Yes' WHEN fl = fg THEN 'Yes' WHEN had =
    'Yes' THEN 'Yes' END AS sample_is_for_MM_dx FROM t4""")
def target_disease_timeline(t):
    df = c.diagnoses(stand_in(t, "Diagnosis")).withColumn("sample_age", F.col("YearOfDiagnosis") - 1950)
    return c.target_timeline(df).select("rec", "MM_sequence", "had_MM_at_anytime", "age_at_first_MM_dx", "age_at_last_MM_dx",
                                        "age_at_MGUS_dx", "is_patient_MM", "sample_is_for_MM_dx")


_REST = """rest AS (SELECT patient_id, {} FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY AgeAtDiagnosis NULLS LAST,
    PrimaryDiagnosisSite, PrimaryDiagnosisSiteCode, Histology NULLS LAST) AS n FROM dx) GROUP BY 1)""".format(", ".join(
    f"CASE WHEN bool_or({x} IS NULL) THEN NULL ELSE string_agg({e}, '; ' ORDER BY n) FILTER (n > 1) END AS subsequent_cancer_{x}"
    for x, e in (("PrimaryDiagnosisSite", "PrimaryDiagnosisSite"), ("PrimaryDiagnosisSiteCode", "PrimaryDiagnosisSiteCode"),
                 ("Histology", "Histology"), ("AgeAtDiagnosis", "regexp_replace(CAST(AgeAtDiagnosis AS VARCHAR), '\\.0$', '')"))))


@query(f"""{with_tables('Diagnosis')}, {_DX}, {_REST} SELECT dx.patient_id, dx.rec, dx.AgeAtDiagnosis, PrimaryDiagnosisSite, Histology, iss_stage,
    rest.* EXCLUDE (patient_id) FROM dx JOIN rest USING (patient_id) WHERE diagnosis_sequence = 1""")
def first_and_subsequent_diagnoses(t):
    df = c.first_diagnosis(c.diagnoses(stand_in(t, "Diagnosis")))
    return df.select(KEY, "rec", "AgeAtDiagnosis", "PrimaryDiagnosisSite", "Histology", "iss_stage",
                     *[n for n in df.columns if n.startswith("subsequent_cancer_")])


# first diagnosis of every patient, as other tables look it up
_FIRST = f"""fd AS (SELECT *, {age_sql('AgeAtDiagnosis')} AS dxage FROM Diagnosis QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY
    {age_sql('AgeAtDiagnosis')} NULLS LAST, rec) = 1)"""


def _first_dx(t):
    from vitaspan import decode_age, first_per_key

    d = stand_in(t, "Diagnosis")
    return first_per_key(d.withColumn("AgeAtDiagnosis", decode_age("AgeAtDiagnosis")), [KEY], ["AgeAtDiagnosis", "rec"])


def _tier_steps(one: str, table: str, code: str, site: str, age: str, where: str = "true") -> str:
    """One record per patient, of the first diagnosed site or else of an unknown one, in the CTE ``one``."""
    return f"""{one}_b AS (SELECT * EXCLUDE ({age}), {age_sql(age)} AS {age} FROM {table} WHERE {where}),
        {one}_u AS (SELECT b.*, 0 AS tier FROM {one}_b b JOIN (SELECT patient_id, PrimaryDiagnosisSiteCode AS fc, PrimaryDiagnosisSite AS fs FROM fd) f
            ON b.patient_id = f.patient_id AND b.{code} = fc AND b.{site} = fs
            UNION ALL SELECT b.*, 1 FROM {one}_b b WHERE {site} = 'Unknown/Not Applicable'),
        {one} AS (SELECT * FROM {one}_u QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY tier, {age} NULLS LAST, rec) = 1)"""


def _tiered(table: str, code: str, site: str, age: str, where: str = "true") -> str:
    return f"{with_tables('Diagnosis', table)}, {_FIRST}, {_tier_steps('one', table, code, site, age, where)}"


_NOT_MIGRATED = "{} <> '(Migrated) Cannot determine from available documentation'"


@query(_tiered("Outcomes", "OutcomesPrimaryDiagnosisSiteCode", "OutcomesPrimaryDiagnosisSite", "AgeAtProgRecur") + """ SELECT patient_id,
    OutcomesPrimaryDiagnosisSiteCode, OutcomesPrimaryDiagnosisSite, ProgRecurInd, AgeAtProgRecur, RelapseStatus, 'Yes' AS has_outcomes_data FROM one""")
def outcomes_by_site(t):
    return c.outcomes(stand_in(t, "Outcomes"), _first_dx(t))


@query(_tiered("MetastaticDisease", "MetastaticDiseaseSiteCode", "MetastaticDiseaseSite", "AgeAtMetastaticSite") + """ SELECT patient_id,
    MetastaticDiseaseSiteCode, MetastaticDiseaseSite, MetastaticDiseaseInd AS had_metastasis, AgeAtMetastaticSite, MetsDzPrimaryDiagnosisSite,
    'Yes' AS has_metastasis_data FROM one""")
def metastases_by_site(t):
    return c.metastases(stand_in(t, "MetastaticDisease"), _first_dx(t))


@query(_tiered("StemCellTransplant", "SCTPrimaryDiagnosisSiteCode", "SCTPrimaryDiagnosisSite", "AgeAtTransplant") + """ SELECT patient_id,
    SCTInd AS sct_ever, AgeAtTransplant, TransplantType, TransplantCellSource, 'Yes' AS has_stemcell_data FROM one""")
def transplants_by_site(t):
    return c.transplants(stand_in(t, "StemCellTransplant"), _first_dx(t))


@query(_tiered("Radiation", "RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite", "AgeAtRadiationStart",
               _NOT_MIGRATED.format("RadiationTherapyInd")) + """ SELECT patient_id, RadPrimaryDiagnosisSiteCode, RadPrimaryDiagnosisSite,
    RadiationTherapyInd AS radiation_ever, AgeAtRadiationStart, 'Yes' AS has_radiation_data FROM one""")
def radiation_by_site(t):
    return c.radiations(stand_in(t, "Radiation"), _first_dx(t))


@query(_tiered("SurgeryBiopsy", "PrimaryDiagnosisSiteCode", "PrimaryDiagnosisSite", "AgeAtSurgeryBiopsy",
               _NOT_MIGRATED.format("SurgeryBiopsyInd")) + """ SELECT patient_id, PrimaryDiagnosisSiteCode AS SurgPrimaryDiagnosisSiteCode,
    PrimaryDiagnosisSite AS SurgPrimaryDiagnosisSite, CASE WHEN SiteTherapeutic = 'Unknown/Not Applicable' THEN CASE WHEN AgeAtSurgeryBiopsy IS NULL
    THEN 'No' ELSE 'Yes' END ELSE SiteTherapeutic END AS surgery_ever, AgeAtSurgeryBiopsy, 'Yes' AS has_surgery_data FROM one""")
def surgery_by_site(t):
    return c.surgeries(stand_in(t, "SurgeryBiopsy"), _first_dx(t))


_MED_STEPS = f"""b AS (SELECT * FROM Medications WHERE {_NOT_MIGRATED.format('MedicationInd')}),
    u AS (SELECT b.* FROM b JOIN fd ON b.patient_id = fd.patient_id AND MedPrimaryDiagnosisSiteCode = PrimaryDiagnosisSiteCode AND
        MedPrimaryDiagnosisSite = PrimaryDiagnosisSite UNION ALL SELECT * FROM b WHERE MedPrimaryDiagnosisSite = 'Unknown/Not Applicable'),
    k AS (SELECT *, dense_rank() OVER (PARTITION BY patient_id ORDER BY MedPrimaryDiagnosisSiteCode) AS n FROM u),
    meds AS (SELECT patient_id, MedPrimaryDiagnosisSiteCode, MedPrimaryDiagnosisSite, MedicationInd, {age_sql('AgeAtMedStart')} AS AgeAtMedStart,
        Medication, AgeAtMedStop FROM k WHERE n = 1)"""
_MEDS = f"{with_tables('Diagnosis', 'Medications')}, {_FIRST}, {_MED_STEPS}"


@query(f"{_MEDS} SELECT * FROM meds")
def medications_of_one_site(t):
    return c.medications_of_site(stand_in(t, "Medications"), _first_dx(t))


_COURSES = (f"""courses_i AS (SELECT *, max(CASE WHEN contains(Medication, 'domide') OR Medication IN ('Revlimid', 'Pomalyst') THEN 'Yes' END) OVER
        (PARTITION BY patient_id) AS received_imids FROM meds),
    courses_g AS (SELECT patient_id, AgeAtMedStart, MedicationInd, received_imids, string_agg(Medication, '; ' ORDER BY Medication, AgeAtMedStop) AS
        Medication, string_agg(AgeAtMedStop, '; ' ORDER BY Medication, AgeAtMedStop) AS AgeAtMedStop FROM courses_i GROUP BY ALL),
    courses_n AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY AgeAtMedStart NULLS LAST, MedicationInd) AS n FROM courses_g),
    courses AS (SELECT patient_id, received_imids, MedicationInd AS drugs_ever, 'Yes' AS has_medication_data, """
       + ", ".join(f"max(CASE WHEN n = {i} THEN {x} END) AS {x}_{i}" for x in ("AgeAtMedStart", "Medication", "AgeAtMedStop") for i in range(1, 11))
       + " FROM courses_n GROUP BY ALL)")


@query(f"{_MEDS}, {_COURSES} SELECT * FROM courses")
def medication_courses_wide(t):
    meds = stand_in(t, "Medications")
    return c.medication_courses(c.medications_of_site(meds, _first_dx(t)))


# --- measurements nearest to diagnosis -------------------------------------------------------------

def _nearest(source: str, age: str, cols: str) -> str:
    return f"""SELECT {cols} FROM (SELECT s.*, abs(s.age - dxage) AS gap FROM {source} s LEFT JOIN (SELECT patient_id AS p, dxage FROM fd) f
        ON s.patient_id = f.p) QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY gap NULLS LAST, age NULLS LAST, {age}) = 1"""


@query(f"""{with_tables('Diagnosis', 'PhysicalAssessment')}, {_FIRST}, s AS (SELECT *, {age_sql('AgeAtPhysicalExam')} AS age FROM PhysicalAssessment),
    o AS ({_nearest('s', 'rec', '*')}) SELECT patient_id, age AS AgeAtPhysicalExam, CAST(BodyWeight AS DOUBLE) AS BodyWeight, TRY_CAST(BodyHeight
    AS DOUBLE) AS BodyHeight, CAST(BMI AS DOUBLE) AS BMI, CASE WHEN CAST(BMI AS DOUBLE) < 18.5 THEN 'Underweight' WHEN CAST(BMI AS DOUBLE) < 25
    THEN 'Healthy' WHEN CAST(BMI AS DOUBLE) < 30 THEN 'Overweight' ELSE 'Obese' END AS bmi_cat FROM o""")
def bmi_near_diagnosis(t):
    return c.body_mass(stand_in(t, "PhysicalAssessment"), _first_dx(t))


_ALB = f"""alb0 AS (SELECT patient_id, rec, {age_sql('AgeAtLabResults')} AS age, LabResults, nullif(LabUnits, 'Unknown/Not Applicable') AS LabUnits
        FROM Labs WHERE LabTest = 'Albumin (Serum)'),
    alb AS (SELECT patient_id, TRY_CAST(LabResults AS DOUBLE) AS albumin_value, LabUnits AS albumin_unit FROM ({_nearest('alb0', 'rec', '*')}))"""
# ties between records of the same gap and age fall to the test name, then value, then unit, as the union of both tables has no record id
_B2 = f"""b20 AS (SELECT patient_id, {age_sql('AgeAtTumorMarkerTest')} AS age, TMarkerTest AS test, nullif(TMarkerResultValue, 'Unknown/Not Applicable')
        AS v, nullif(TMarkerValueUOM, 'Unknown/Not Applicable') AS u FROM TumorMarker WHERE TMarkerTest = 'Beta-2-microglobulin (B2M) level' UNION ALL
        SELECT patient_id, {age_sql('AgeAtLabResults')}, LabTest, nullif(LabResults, 'Unknown/Not Applicable'), nullif(LabUnits,
        'Unknown/Not Applicable') FROM Labs WHERE LabTest = 'Beta 2 Microglobulin'),
    b2 AS (SELECT patient_id, TRY_CAST(v AS DOUBLE) * CASE u WHEN 'mg/L' THEN 1.0 WHEN 'mg/dL' THEN 10.0 WHEN 'ng/mL' THEN 0.001 WHEN
        'ug/mL (mcg/mL)' THEN 1.0 END AS b2_value, 'mg/L' AS b2_unit FROM ({_nearest('b20', 'test, v NULLS LAST, u NULLS LAST', '*')}))"""


@query(f"{with_tables('Diagnosis', 'Labs')}, {_FIRST}, {_ALB} SELECT * FROM alb")
def albumin_near_diagnosis(t):
    return c.albumin(stand_in(t, "Labs"), _first_dx(t))


@query(f"""{with_tables('Diagnosis', 'Labs', 'TumorMarker')}, {_FIRST}, {_B2} SELECT patient_id, round(b2_value, 6) AS b2_value, b2_unit FROM b2""")
def beta2_near_diagnosis(t):
    return rounded(c.beta2(stand_in(t, "TumorMarker"), stand_in(t, "Labs"), _first_dx(t)))


@query(f"""{with_tables('Diagnosis', 'Labs', 'TumorMarker')}, {_FIRST}, {_ALB}, {_B2}, i AS (SELECT coalesce(alb.patient_id, b2.patient_id) AS p,
    CASE WHEN b2_value < 3.5 AND albumin_value >= 3.5 THEN 'I' WHEN b2_value < 3.5 AND albumin_value < 3.5 THEN 'II' WHEN b2_value > 3.5 AND
    b2_value <= 5.5 THEN 'II' WHEN b2_value > 5.5 THEN 'III' END AS calc FROM alb FULL JOIN b2 ON alb.patient_id = b2.patient_id)
    SELECT patient_id, calc AS iss_stage_calculated, coalesce(CASE OtherStagingSystem WHEN 'ISS' THEN OtherStagingValue END, calc) AS iss_stage
    FROM fd LEFT JOIN (SELECT * FROM i WHERE calc IS NOT NULL) ON patient_id = p""")
def calculated_iss_stage(t):
    dx = _first_dx(t)
    labs, markers = stand_in(t, "Labs"), stand_in(t, "TumorMarker")
    stages = c.calculated_iss(c.albumin(labs, dx), c.beta2(markers, labs, dx))
    recorded = dx.select(KEY, c.staged_as("OtherStagingSystem", "OtherStagingValue").alias("iss_stage"))
    return c.with_calculated_iss(recorded, stages).select(KEY, "iss_stage_calculated", "iss_stage")


# --- markers ---------------------------------------------------------------------------------------

_W = "PARTITION BY TMarkerTest ORDER BY age NULLS LAST, patient_id, rec ROWS BETWEEN"


def _range(name: str) -> str:
    return (f"TRY_CAST(coalesce(first_value({name} IGNORE NULLS) OVER ({_W} CURRENT ROW AND UNBOUNDED FOLLOWING), last_value({name} IGNORE NULLS) "
            f"OVER ({_W} UNBOUNDED PRECEDING AND CURRENT ROW)) AS DOUBLE)")


_MARKERS = f"""{with_tables('TumorMarker')}, k0 AS (SELECT patient_id, rec, {age_sql('AgeAtTumorMarkerTest')} AS age, TMarkerTest, TMarkerResult,
        TRY_CAST(TMarkerResultValue AS DOUBLE) AS v, nullif(TMarkerLowRange, 'Unknown/Not Applicable') AS lo0, TMarkerHighRange AS hi0,
        TMarkerRangeIndicator AS ind FROM TumorMarker),
    k1 AS (SELECT *, {_range('lo0')} AS lo, {_range('hi0')} AS hi FROM k0),
    k AS (SELECT patient_id, rec, age, v, TMarkerResult, CASE WHEN contains(TMarkerTest, 'HER2') THEN 'HER2' ELSE TMarkerTest END AS test,
        CASE WHEN TMarkerResult = 'Value' THEN coalesce(ind, CASE WHEN v >= lo AND v <= hi THEN 'WNL (Within Normal Limits)' WHEN v < lo THEN 'Low'
        WHEN v > hi THEN 'High' END) ELSE TMarkerResult END AS interpretation FROM k1)"""
_RECEPTORS = """f AS (SELECT *, CASE WHEN test <> 'HER2' THEN TMarkerResult WHEN TMarkerResult IN ('Positive', 'Negative') THEN TMarkerResult WHEN
        TMarkerResult = 'Amplified' THEN 'Positive' END AS answer FROM k WHERE test IN ('Estrogen receptor (ER)', 'Progesterone receptor (PR)', 'HER2')
        QUALIFY row_number() OVER (PARTITION BY patient_id, test ORDER BY age NULLS LAST, rec) = 1),
    s AS (SELECT patient_id, max(CASE test WHEN 'Estrogen receptor (ER)' THEN 'ER' || sgn END) AS e, max(CASE test WHEN
        'Progesterone receptor (PR)' THEN 'PR' || sgn END) AS p, max(CASE test WHEN 'HER2' THEN 'HER2' || sgn END) AS h FROM (SELECT *, CASE answer
        WHEN 'Positive' THEN '+' WHEN 'Negative' THEN '-' END AS sgn FROM f) GROUP BY 1),
    status AS (SELECT patient_id, nullif(concat_ws('/', e, p, h), '') AS ER_PR_HER2_status FROM s)"""


@query(f"{_MARKERS} SELECT rec, test AS marker_test, v AS marker_value, interpretation AS marker_interpretation FROM k")
def marker_interpretation(t):
    return c.marker_interpretation(stand_in(t, "TumorMarker")).select("rec", "marker_test", "marker_value", "marker_interpretation")


@query(f"{_MARKERS}, {_RECEPTORS} SELECT * FROM status")
def receptor_status(t):
    return c.receptor_status(c.marker_interpretation(stand_in(t, "TumorMarker")))


@query(f"""{_MARKERS}, {_RECEPTORS}, j AS (SELECT k.*, CASE WHEN test IN ('Estrogen receptor (ER)', 'Progesterone receptor (PR)', 'HER2') THEN
        'ER_PR_HER2_status' ELSE test END AS name, CASE WHEN test IN ('Estrogen receptor (ER)', 'Progesterone receptor (PR)', 'HER2') THEN
        coalesce(ER_PR_HER2_status, interpretation) ELSE interpretation END AS shown FROM k LEFT JOIN status USING (patient_id)),
    o AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY patient_id, name ORDER BY age NULLS LAST, shown NULLS LAST) = 1)
    SELECT patient_id, max(CASE name WHEN 'ER_PR_HER2_status' THEN shown END) AS "ER_PR_HER2_status", max(CASE name WHEN 'CEA' THEN shown END) AS "CEA",
    max(CASE name WHEN 'Beta-2-microglobulin (B2M) level' THEN shown END) AS "Beta-2-microglobulin (B2M) level" FROM o GROUP BY 1""")
def marker_wide(t):
    return c.marker_table(stand_in(t, "TumorMarker"))


# --- other tables ----------------------------------------------------------------------------------

@query(f"""{with_tables('MSI')} SELECT CASE WHEN MSI_score >= 20 THEN 'Yes' WHEN MSI_score < 20 THEN 'No' END AS MSI_high_score, count(*) AS n FROM MSI
    GROUP BY 1""")
def msi_flag(t):
    return stand_in(t, "MSI").groupBy(c.msi_high("MSI_score").alias("MSI_high_score")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{with_tables('FamilyHistory')} SELECT patient_id, max(CancerInFamilyInd) AS CancerInFamilyInd FROM FamilyHistory GROUP BY 1")
def family_history(t):
    return c.family_history(stand_in(t, "FamilyHistory"))


@query(f"""{with_tables('TumorSequencing')} SELECT patient_id, {age_sql('AgeAtTumorSequencing')} AS AgeAtTumorSequencing FROM TumorSequencing WHERE
    TumorSequencingInd = 'Yes'""")
def sequencing_events(t):
    return c.sequencing_events(stand_in(t, "TumorSequencing"))


@query(f"""{with_tables('CytogeneticAbnormalities')} SELECT patient_id, max(CASE WHEN CytogenAbnormName IS NULL THEN CytogenAbnormInd END) AS "NA",
    max(CASE CytogenAbnormName WHEN 'del(17p)' THEN CytogenAbnormInd END) AS "del(17p)", max(CASE CytogenAbnormName WHEN 't(11;16)' THEN
    CytogenAbnormInd END) AS "t(11;16)", max(CASE CytogenAbnormName WHEN 't(4;14)' THEN CytogenAbnormInd END) AS "t(4;14)" FROM
    CytogeneticAbnormalities WHERE CytogenAbnormResult = 'Positive' GROUP BY 1""")
def cytogenetics_wide(t):
    return c.cytogenetics(stand_in(t, "CytogeneticAbnormalities"), values=["NA", "del(17p)", "t(11;16)", "t(4;14)"])


@query(f"""{with_tables('Diagnosis')} SELECT ClinGroupStage, stage, CASE stage WHEN '0' THEN '0-II' WHEN 'I' THEN '0-II' WHEN 'II' THEN '0-II' ELSE stage
    END AS merged, count(*) AS n FROM (SELECT *, CASE WHEN contains(ClinGroupStage, '0') THEN '0' WHEN contains(ClinGroupStage, 'IV') THEN 'IV'
    WHEN contains(ClinGroupStage, 'III') THEN 'III' WHEN contains(ClinGroupStage, 'II') THEN 'II' WHEN contains(ClinGroupStage, 'I') THEN 'I' END AS
    stage FROM Diagnosis) GROUP BY ALL""")
def collapsed_stage(t):
    d = stand_in(t, "Diagnosis").withColumn("stage", c.collapse_stage("ClinGroupStage"))
    merged = c.merge_levels("stage", {"0": "0-II", "I": "0-II", "II": "0-II"})
    return d.groupBy("ClinGroupStage", "stage", merged.alias("merged")).agg(F.count(F.lit(1)).alias("n"))


_LISTS = {"Lung": "'Lung'", "MM": "'MM'"}
_CH = f"""{with_tables('Samples', 'Calls')}, sm AS (SELECT patient_id, Germline AS g, Tumor_WES AS u, 'Lung' AS cancer_type FROM Samples WHERE RNASeq IS
        NOT NULL UNION ALL SELECT patient_id, Germline, Tumor_WES, 'MM' FROM Samples WHERE RNASeq IS NULL),
    c0 AS (SELECT patient_id, patient_id_wes AS g, regexp_replace(Tumor, '_st_t', '') AS u, Tumor_VAF, 'Lung' AS cancer_type FROM Calls WHERE
        Tumor_VAF IS NOT NULL UNION ALL SELECT patient_id, patient_id_wes, regexp_replace(Tumor, '_st_t', ''), Tumor_VAF, 'MM' FROM Calls),
    c1 AS (SELECT *, CASE WHEN bool_or(Tumor_VAF <> '.') OVER w THEN true WHEN count(*) FILTER (Tumor_VAF IS NULL) OVER w > 0 THEN NULL ELSE false END
        AS seen FROM c0 WINDOW w AS (PARTITION BY patient_id, cancer_type)),
    c2 AS (SELECT patient_id, g, u, cancer_type, bool_or(seen) AS seen FROM c1 GROUP BY ALL)
    SELECT coalesce(sm.patient_id, c2.patient_id) AS patient_id, coalesce(sm.g, c2.g) AS Germline_WES, coalesce(sm.u, c2.u) AS Tumor_WES,
    coalesce(sm.cancer_type, c2.cancer_type) AS cancer_type, CASE WHEN c2.patient_id IS NULL THEN 'No CH' ELSE 'CH' END AS ch_status, seen AS
    CH_detected_in_tumor FROM sm FULL JOIN c2 ON sm.patient_id = c2.patient_id AND sm.cancer_type = c2.cancer_type AND sm.g IS NOT DISTINCT FROM c2.g
    AND sm.u IS NOT DISTINCT FROM c2.u"""


@query(_CH)
def mutation_status(t):
    """Status per sample pair from two cancers' sample lists and calls; NULL tumour ids match."""
    s, calls = stand_in(t, "Samples").select(KEY, "Germline", "Tumor_WES", "RNASeq"), stand_in(t, "Calls")
    samples = {"Lung": s.where("RNASeq is not null").drop("RNASeq"), "MM": s.where("RNASeq is null").drop("RNASeq")}
    return c.ch_status(samples, {"Lung": calls.where("Tumor_VAF is not null"), "MM": calls})


# --- public cohort ---------------------------------------------------------------------------------

_STATUS = {"OS": ("0:LIVING", "1:DECEASED"), "DSS": ("0:ALIVE OR DEAD TUMOR FREE", "1:DEAD WITH TUMOR"),
           "DFS": ("0:DiseaseFree", "1:Recurred/Progressed"), "PFS": ("0:CENSORED", "1:PROGRESSION")}


def _public(t):
    o = t.orders
    cols = [F.concat(F.lit("S-"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("PATIENT_ID"),
            F.when(F.col("o_totalprice") > 20000, (F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("CH_status")]
    for i, (name, (no, yes)) in enumerate(_STATUS.items()):
        cols.append(F.when(F.col("o_orderstatus") == "F", yes).when(F.col("o_orderstatus") == "O", no).otherwise("[Not Available]").alias(f"{name}_STATUS"))
        cols.append(F.when(F.col("o_totalprice") > 10000 * (i + 1), F.floor(F.col("o_totalprice") / 1000)).cast("double").alias(f"{name}_MONTHS"))
    return o.select(*cols)


_PUBLIC = "p AS (SELECT 'S-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS PATIENT_ID, CASE WHEN o_totalprice > 20000 THEN CASE WHEN " \
    "o_orderpriority = '1-URGENT' THEN 'CHIP' ELSE 'non-CHIP' END END AS CH_status, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 " \
    "END AS st, " + ", ".join(f"CASE WHEN o_totalprice > {10000 * (i + 1)} THEN floor(o_totalprice / 1000) END AS m{n}" for i, n in enumerate(_STATUS)) \
    + " FROM orders)"


@query(f"WITH {_PUBLIC} " + " UNION ALL ".join(
    f"SELECT '{n}' AS endpoint, CH_status, count(*) AS n, sum(st)::BIGINT AS events, sum(m{n})::DOUBLE AS months FROM p WHERE st IS NOT NULL AND m{n} IS "
    "NOT NULL AND CH_status IS NOT NULL GROUP BY ALL" for n in _STATUS))
def coded_endpoint_subsets(t):
    from vitaspan import recode

    df = coded_endpoints(_public(t)).withColumn("CH_status", recode("CH_status", {0: "non-CHIP", 1: "CHIP"}))
    parts = [complete_for(df, n, "CH_status").groupBy("CH_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum(f"{n}_STATUS").alias("events"), F.sum(f"{n}_MONTHS").alias("months")).withColumn("endpoint", F.lit(n))
        for n in _STATUS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(f"""WITH {_PUBLIC}, h AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_or(l_discount > 0.09)) SELECT CASE WHEN o_orderkey IN
    (SELECT l_orderkey FROM h) THEN 'CHIP' ELSE CH_status END AS CH_status, count(*) AS n FROM p GROUP BY 1""")
def upgraded_status(t):
    from vitaspan import recode

    mask = t.lineitem.select(F.concat(F.lit("S-"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), F.lit("-01A")).alias("sample_id"),
                             (F.col("l_discount") > 0.09).alias("flag"))
    df = _public(t).withColumn("CH_status", recode("CH_status", {0: "non-CHIP", 1: "CHIP"}))
    return c.upgrade_status(df, mask).groupBy("CH_status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_PUBLIC} SELECT cohort, CH_status, count(*) AS n, sum(months)::DOUBLE AS months, count(progression) AS n_progression FROM (SELECT
    'public' AS cohort, CH_status, mOS AS months, NULL AS progression FROM p UNION ALL SELECT 'MM', c_mktsegment, floor(c_acctbal), c_nationkey FROM
    customer) GROUP BY ALL""")
def stacked_cohorts(t):
    from vitaspan import recode

    a = _public(t).select(recode("CH_status", {0: "non-CHIP", 1: "CHIP"}).alias("CH_status"), F.col("OS_MONTHS").alias("month_at_os"),
                          F.lit("public").alias("cohort"))
    b = t.customer.select(F.col("c_mktsegment").alias("CH_status"), F.floor("c_acctbal").cast("double").alias("month_at_os"),
                          F.col("c_nationkey").alias("progression"), F.lit("MM").alias("cohort"))
    both = stack_cohorts([set_unit(a, {"month_at_os": "months"}), set_unit(b, {"month_at_os": "months"})], ["month_at_os"])
    return both.groupBy("cohort", "CH_status").agg(F.count(F.lit(1)).alias("n"), F.sum("month_at_os").alias("months"),
                                                   F.count("progression").alias("n_progression"))
