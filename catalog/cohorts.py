"""Whole cohorts, from the stand-in registry to endpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL, query, rounded
from catalog.clinical_tables import (_ALB, _B2, _COURSES, _DX, _ETH, _FIRST, _MED_STEPS, _RACE, _REST, _TARGET,
                                     _tier_steps)
from catalog.registry import NAMES, age_sql, stand_ins, with_tables
from vitaspan.plans.cohort import all_tumor_cohort, myeloma_cohort, myeloma_report

KEY = "patient_id"
_MARKERS = ["Beta-2-microglobulin (B2M) level", "CEA", "ER_PR_HER2_status"]
_ABNORMALITIES = ["NA", "del(17p)", "t(11;16)", "t(4;14)"]


def _tables(t):
    # records that agree in all that an operator sorts by are told apart by their ids, here and in SQL
    return stand_ins(t, *[n for n in NAMES if n not in ("Samples", "Calls")])


_RACES = "'White', 'Black', 'Asian', 'American Indian or Alaska Native', 'Native Hawaiian or Other Pacific Islander', 'Unknown'"
# the steps of single tables, one after the other, then the joined table and its endpoints
_SITES = {"sct": ("StemCellTransplant", "SCTPrimaryDiagnosisSiteCode", "SCTPrimaryDiagnosisSite", "AgeAtTransplant"),
          "rad": ("Radiation", "RadPrimaryDiagnosisSiteCode", "RadPrimaryDiagnosisSite", "AgeAtRadiationStart",
                  "RadiationTherapyInd <> '(Migrated) Cannot determine from available documentation'"),
          "surg": ("SurgeryBiopsy", "PrimaryDiagnosisSiteCode", "PrimaryDiagnosisSite", "AgeAtSurgeryBiopsy",
                   "SurgeryBiopsyInd <> '(Migrated) Cannot determine from available documentation'"),
          "outc": ("Outcomes", "OutcomesPrimaryDiagnosisSiteCode", "OutcomesPrimaryDiagnosisSite", "AgeAtProgRecur"),
          "mets": ("MetastaticDisease", "MetastaticDiseaseSiteCode", "MetastaticDiseaseSite", "AgeAtMetastaticSite")}
_STEPS = f"""{_DX}, {_FIRST}, {_ALB}, {_B2}, iss AS (SELECT coalesce(alb.patient_id, b2.patient_id) AS patient_id, albumin_value, albumin_unit, b2_value, b2_unit, CASE WHEN b2_value < 3.5 AND albumin_value
        >= 3.5 THEN 'I' WHEN b2_value < 3.5 AND albumin_value < 3.5 THEN 'II' WHEN b2_value > 3.5 AND b2_value <= 5.5 THEN 'II' WHEN b2_value > 5.5 THEN
        'III' END AS iss_stage_calculated FROM alb FULL JOIN b2 ON alb.patient_id = b2.patient_id),
    {_MED_STEPS}, {_COURSES}, {', '.join(_tier_steps(n, *x) for n, x in _SITES.items())},
    seen AS (SELECT patient_id, max(age) AS age_at_lab FROM (SELECT patient_id, {age_sql('AgeAtImageScan')} AS age FROM Imaging UNION ALL SELECT patient_id,
        {age_sql('AgeAtLabResults')} FROM Labs) GROUP BY 1),
    vital AS (SELECT patient_id, VitalStatus, {age_sql('AgeAtLastContact')} AS recorded, {age_sql('AgeAtDeath')} AS AgeAtDeath FROM VitalStatus),
    demo AS (SELECT *, CASE WHEN Ethnicity = 'Hispanic' THEN 'Hispanic' WHEN Ethnicity = 'Non-Hispanic' THEN CASE Race WHEN 'White' THEN 'White Non-Hispanic'
        WHEN 'Black' THEN 'Black' WHEN 'Others' THEN 'Others Non-Hispanic' END END AS race_eth FROM (SELECT patient_id, Sex, {_RACE} AS Race, {_ETH} AS
        Ethnicity FROM PatientMaster)),
    smoke AS (SELECT patient_id, CASE WHEN SmokingStatus = 'Never' THEN 'Never' WHEN SmokingStatus = 'Current' OR contains(SmokingStatus, 'Ever') THEN 'Ever'
        END AS SmokingStatus FROM PatientHistory),
    surgeries AS (SELECT * EXCLUDE (SiteTherapeutic), CASE WHEN SiteTherapeutic = 'Unknown/Not Applicable' THEN CASE WHEN AgeAtSurgeryBiopsy IS NULL THEN 'No'
        ELSE 'Yes' END ELSE SiteTherapeutic END AS surgery_ever FROM surg)"""
_ENDPOINTS = """t0 AS (SELECT *, least(AgeAtRadiationStart, AgeAtSurgeryBiopsy, AgeAtMedStart_1, AgeAtTransplant) AS low, greatest(recorded, age_at_lab) AS
        AgeAtLastContact, CASE WHEN recorded >= age_at_lab THEN 'Yes' WHEN recorded < age_at_lab THEN 'No' END AS is_agelastcontact_last_date FROM joined),
    t1e AS (SELECT *, (low IS NOT DISTINCT FROM AgeAtRadiationStart)::INT + (low IS NOT DISTINCT FROM AgeAtSurgeryBiopsy)::INT + (low IS NOT DISTINCT FROM
        AgeAtMedStart_1)::INT + (low IS NOT DISTINCT FROM AgeAtTransplant)::INT AS hits FROM t0),
    t2e AS (SELECT *, CASE WHEN hits = 1 THEN low END AS age_at_first_treatment, CASE WHEN hits = 1 THEN CASE low WHEN AgeAtRadiationStart THEN 'Radiation' WHEN
        AgeAtSurgeryBiopsy THEN 'Surgery' WHEN AgeAtMedStart_1 THEN 'Drugs' ELSE 'SCT' END END AS first_treatment, CASE VitalStatus WHEN 'Alive' THEN 0 WHEN
        'Lost to follow-up' THEN 0 WHEN 'Dead' THEN 1 END AS os_event, coalesce(AgeAtDeath, AgeAtLastContact) AS os_age, CASE ProgRecurInd WHEN 'No' THEN 0
        WHEN 'Progression' THEN 1 WHEN 'Recurrence' THEN 1 END AS pfs_event, CASE had_metastasis WHEN 'Yes' THEN 1 END AS met_yes, coalesce(AgeAtMetastaticSite,
        AgeAtLastContact) AS met_age FROM t1e),
    done AS (SELECT *, CASE pfs_event WHEN 0 THEN os_age WHEN 1 THEN AgeAtProgRecur END AS pfs_age, CASE WHEN had_metastasis IS NULL THEN 0 ELSE met_yes END AS
        met_event FROM t2e)"""


def _times(*endpoints: str) -> str:
    return ", ".join(f"round({e}_age - {o}, 6) AS {e}_time_from_{n}_years" for e in endpoints for n, o in (
        ("dx", "AgeAtDiagnosis"), ("treatment", "age_at_first_treatment")))


# whole tables as the queries of single tables give them
_PARTS = {"cyto": "cytogenetics_wide", "marks": "marker_wide", "bmi": "bmi_near_diagnosis", "sctx": "transplants_by_site", "radx": "radiation_by_site",
          "surgx": "surgery_by_site", "outcx": "outcomes_by_site", "metx": "metastases_by_site", "fam": "family_history"}
_LINKED = f"""sm AS (SELECT patient_id, Germline AS g, Tumor_WES AS u, CASE WHEN RNASeq IS NULL THEN 'MM' ELSE 'Lung' END AS cancer_type FROM Samples),
    c1 AS (SELECT patient_id, patient_id_wes AS g, regexp_replace(Tumor, '_st_t', '') AS u, 'Lung' AS cancer_type, CASE WHEN bool_or(Tumor_VAF <> '.') OVER w THEN
        true WHEN count(*) FILTER (Tumor_VAF IS NULL) OVER w > 0 THEN NULL ELSE false END AS seen FROM Calls WINDOW w AS (PARTITION BY patient_id)),
    c2 AS (SELECT patient_id, g, u, cancer_type, bool_or(seen) AS seen FROM c1 GROUP BY ALL),
    ch AS (SELECT coalesce(sm.patient_id, c2.patient_id) AS patient_id, coalesce(sm.g, c2.g) AS g, coalesce(sm.u, c2.u) AS u, coalesce(sm.cancer_type,
        c2.cancer_type) AS cancer_type, CASE WHEN c2.patient_id IS NULL THEN 'No CH' ELSE 'CH' END AS ch_status, c2.seen AS CH_detected_in_tumor FROM sm FULL JOIN
        c2 ON sm.patient_id = c2.patient_id AND sm.cancer_type = c2.cancer_type AND sm.g IS NOT DISTINCT FROM c2.g AND sm.u IS NOT DISTINCT FROM c2.u),
    gl AS (SELECT patient_id, WES AS g, SpecimenAge AS g_age, SpecimenSiteOfCollection AS g_site FROM ClinicalMolLinkage WHERE TumorGermline = 'Germline'),
    tu AS (SELECT l.patient_id, l.WES AS u, SpecimenAge AS u_age, DiseaseType, SpecimenSiteOfCollection AS u_site, CASE WHEN MSI_score >= 20 THEN 'Yes' WHEN
        MSI_score < 20 THEN 'No' END AS MSI_high_score FROM ClinicalMolLinkage l LEFT JOIN MSI m ON l.patient_id = m.patient_id AND l.WES = m.WES WHERE
        TumorGermline = 'Tumor'),
    pr AS (SELECT coalesce(gl.patient_id, tu.patient_id) AS patient_id, g, u, g_age, g_site, u_age, DiseaseType, u_site, MSI_high_score FROM gl FULL JOIN tu ON
        gl.patient_id = tu.patient_id),
    linked AS (SELECT ch.patient_id, ch.g AS Germline_WES, ch.u AS Tumor_WES, cancer_type, ch_status, CH_detected_in_tumor, {age_sql('g_age')} AS
        germline_collection_age, g_site AS germline_SpecimenSiteOfCollection, {age_sql('u_age')} AS tumor_collection_age, DiseaseType, u_site AS
        tumor_SpecimenSiteOfCollection, MSI_high_score FROM ch LEFT JOIN pr ON ch.patient_id = pr.patient_id AND ch.g IS NOT DISTINCT FROM pr.g AND ch.u IS NOT
        DISTINCT FROM pr.u)"""
_FULL = ["linked", "demo", "fdx", "smoke", "vital", "courses", "seen", *_PARTS]
_JOINED = f"""fdx AS (SELECT dx.* EXCLUDE (rec, iss, iss_stage, diagnosis_sequence), CAST(diagnosis_sequence AS INT) AS diagnosis_sequence, coalesce(iss_stage,
        iss_stage_calculated) AS iss_stage, subsequent_cancer_PrimaryDiagnosisSite, subsequent_cancer_PrimaryDiagnosisSiteCode, subsequent_cancer_AgeAtDiagnosis,
        i.* EXCLUDE (patient_id) FROM dx LEFT JOIN rest USING (patient_id) LEFT JOIN (SELECT * FROM iss WHERE iss_stage_calculated IS NOT NULL) i ON
        i.patient_id = dx.patient_id WHERE diagnosis_sequence = 1),
    spine AS ({' UNION '.join(f'SELECT patient_id FROM {x}' for x in _FULL)}),
    joined AS (SELECT spine.patient_id, {', '.join(f"{x}.* EXCLUDE (patient_id{', received_imids' if x == 'courses' else ''})" for x in _FULL)} FROM spine
        {' '.join(f'LEFT JOIN {x} ON {x}.patient_id = spine.patient_id' for x in _FULL)})"""


@query(f"""{with_tables(*NAMES)}, {_STEPS}, {_REST}, {_LINKED}, {', '.join(f'{x} AS ({SQL[q]})' for x, q in _PARTS.items())}, {_JOINED},
    {_ENDPOINTS} SELECT * EXCLUDE (recorded, low, hits, met_yes, Race) REPLACE (round(b2_value, 6) AS b2_value), CASE WHEN Race IN ({_RACES}) THEN Race END AS
    Race, {_times('os', 'pfs', 'met')} FROM done""")
def cohort_of_all_tumors(t):
    """16 tables to one row per patient (and sample pair) with all columns: status, markers, abnormalities, courses, endpoints."""
    extra = stand_ins(t, "Samples", "Calls")
    samples = extra["Samples"].select(KEY, "Germline", "Tumor_WES", "RNASeq")
    lists = {"Lung": samples.where("RNASeq is not null").drop("RNASeq"), "MM": samples.where("RNASeq is null").drop("RNASeq")}
    cohort = all_tumor_cohort(_tables(t), lists, {"Lung": extra["Calls"]}, KEY, _MARKERS, _ABNORMALITIES)
    return rounded(cohort.drop("rec"))


@query(f"""{with_tables(*[n for n in NAMES if n not in ('Samples', 'Calls')])}, {_STEPS}, {_TARGET},
    joined AS (SELECT f.patient_id, f.AgeAtDiagnosis, f.ClinGroupStage, f.is_patient AS is_patient_MM, coalesce(f.iss_stage, iss_stage_calculated) AS iss_stage, Sex,
        Race, Ethnicity, race_eth, SmokingStatus, VitalStatus, recorded, AgeAtDeath, drugs_ever, received_imids, AgeAtMedStart_1, AgeAtTransplant,
        AgeAtRadiationStart, surgery_ever, AgeAtSurgeryBiopsy, ProgRecurInd, AgeAtProgRecur, MetastaticDiseaseInd AS had_metastasis, AgeAtMetastaticSite, age_at_lab
        FROM (SELECT * FROM t4 WHERE diagnosis_sequence = 1) f LEFT JOIN iss USING (patient_id) LEFT JOIN demo USING (patient_id) LEFT JOIN smoke USING
        (patient_id) LEFT JOIN vital USING (patient_id) LEFT JOIN courses USING (patient_id) LEFT JOIN sct USING (patient_id) LEFT JOIN rad USING (patient_id)
        LEFT JOIN surgeries USING (patient_id) LEFT JOIN outc USING (patient_id) LEFT JOIN mets USING (patient_id) LEFT JOIN seen USING (patient_id)),
    {_ENDPOINTS} SELECT patient_id, Sex, Race, Ethnicity, race_eth, drugs_ever, coalesce(received_imids, 'No') AS received_imids, surgery_ever, iss_stage,
        ClinGroupStage, SmokingStatus, os_event, pfs_event, {_times('os', 'pfs')}, is_patient_MM FROM done""")
def cohort_of_myeloma(t):
    """15 tables, left assembly, and the columns of the report."""
    sample = t.customer.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias(KEY),
                               F.when(F.col("c_acctbal") > 9000, "Age 90 or older").otherwise(
                                   (F.col("c_nationkey") + 40).cast("string")).alias("sample_age"))
    return rounded(myeloma_report(myeloma_cohort(_tables(t), sample, KEY, _MARKERS, _ABNORMALITIES), KEY))
