"""From registry tables to one analysis row per patient.

Every table is reduced to its patient key first, so the assembly joins small, equally partitioned inputs.
``tables`` maps the registry's table names to frames whose patient key is ``key``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col, decode_age
from vitaspan.operators.frames import label, relocate
from vitaspan.operators.joins import assemble, join_ns, semi_by_list
from vitaspan.operators.tables import summary_table
from vitaspan.plans import clinical as c
from vitaspan.plans import timeline as t
from vitaspan.plans.endpoints import metastasis_free_survival, overall_survival, progression_free_survival
from vitaspan.session import freeze

# fixed values: display labels of the cohort table
LABELS = {
    "AgeAtDiagnosis": "Patient age at diagnosis?",
    "germline_collection_age": "Age at blood collection",
    "race_eth": "Race/Ethnicity",
    "PrimaryDiagnosisSite": "Primary Site",
    "ClinGroupStage": "Clinical Stage?",
    "BodyWeight": "Body Weight",
    "BodyHeight": "Body Height",
    "bmi_cat": "BMI categories",
    "SmokingStatus": "Smoking Status",
    "first_treatment": "First Treatment Type",
    "drugs_ever": "Drugs Ever",
    "AgeAtMedStart_1": "Age at First Drug",
    "Medication_1": "First Regimen",
    "sct_ever": "Transplant Ever",
    "AgeAtTransplant": "Age at Transplant",
    "radiation_ever": "Radiation Ever",
    "AgeAtRadiationStart": "Age at Radiation",
    "surgery_ever": "Surgery Ever",
    "AgeAtSurgeryBiopsy": "Age at Surgery",
    "had_metastasis": "Metastasis?",
    "AgeAtMetastaticSite": "Age at Metastasis",
}
MYELOMA_COLUMNS = [
    "Sex", "Race", "Ethnicity", "race_eth", "drugs_ever", "received_imids", "surgery_ever", "iss_stage",
    "ClinGroupStage", "SmokingStatus", "os_event", "os_time_from_dx_years", "os_time_from_treatment_years",
    "pfs_event", "pfs_time_from_dx_years", "pfs_time_from_treatment_years", "is_patient_MM",
]
ORIGINS = {"dx": "AgeAtDiagnosis", "treatment": "age_at_first_treatment"}


def _reductions(tables: Mapping[str, DataFrame], dx: DataFrame, key: str, imids: bool,
                markers: Sequence[str] | None, abnormalities: Sequence[str] | None) -> list[DataFrame]:
    """The per-patient tables both cohorts share, all but the diagnosis."""
    return [
        c.smoking(tables["PatientHistory"], key), c.vital_status(tables["VitalStatus"], key),
        c.cytogenetics(tables["CytogeneticAbnormalities"], key, abnormalities, "max"),
        c.marker_table(tables["TumorMarker"], key, values=markers), c.body_mass(tables["PhysicalAssessment"], dx, key),
        c.medication_courses(c.medications_of_site(tables["Medications"], dx, key), key, imids),
        c.transplants(tables["StemCellTransplant"], dx, key), c.radiations(tables["Radiation"], dx, key),
        c.surgeries(tables["SurgeryBiopsy"], dx, key), c.outcomes(tables["Outcomes"], dx, key),
        c.metastases(tables["MetastaticDisease"], dx, key), c.last_seen(tables["Imaging"], tables["Labs"], key),
        c.family_history(tables["FamilyHistory"], key)]


def _with_iss(dx: DataFrame, tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    stages = c.calculated_iss(c.albumin(tables["Labs"], dx, key), c.beta2(tables["TumorMarker"], tables["Labs"], dx, key), key)
    return c.with_calculated_iss(dx, stages, key)


def with_endpoints(df: DataFrame, strict_contact: bool = False, coalesced_pfs: bool = False) -> DataFrame:
    """First treatment among four, reconciled last contact, and the three endpoints."""
    first, age = t.first_of({"Radiation": "AgeAtRadiationStart", "Surgery": "AgeAtSurgeryBiopsy",
                             "Drugs": "AgeAtMedStart_1", "SCT": "AgeAtTransplant"})
    recorded, seen = F.col("AgeAtLastContact"), F.col("age_at_lab")
    df = df.withColumns({
        "is_agelastcontact_last_date": F.when(recorded >= seen, "Yes").when(recorded < seen, "No"),
        "first_treatment": first, "age_at_first_treatment": age})
    df = df.withColumn("AgeAtLastContact", t.last_contact("AgeAtLastContact", "age_at_lab", strict_contact))
    df = overall_survival(df, ORIGINS)
    df = progression_free_survival(df, ORIGINS, contact="AgeAtLastContact" if coalesced_pfs else "os_age",
                                   coalesced=coalesced_pfs)
    return metastasis_free_survival(df, ORIGINS)


def _first_dx(decoded: DataFrame, key: str, how: str, **kwargs) -> DataFrame:
    """One row per patient, frozen: a dozen reductions look it up."""
    return freeze(c.first_diagnosis(decoded, key, how, **kwargs))


def all_tumor_cohort(tables: Mapping[str, DataFrame], samples: Mapping[str, DataFrame], calls: Mapping[str, DataFrame],
                     key: str = c.KEY, markers: Sequence[str] | None = None,
                     abnormalities: Sequence[str] | None = None, strict_contact: bool = False) -> DataFrame:
    """All patients of all tables, with mutation status, endpoints and labels (16 inputs, full assembly)."""
    dx = _first_dx(c.diagnoses(tables["Diagnosis"], key), key, "full",
                   cols=("PrimaryDiagnosisSite", "PrimaryDiagnosisSiteCode", "AgeAtDiagnosis"))
    status = c.link_samples(c.ch_status(samples, calls, key).select(key, "Germline_WES", "Tumor_WES", "cancer_type",
                                                                    "ch_status", "CH_detected_in_tumor"),
                            tables["ClinicalMolLinkage"], tables["MSI"], key)
    parts = [status, c.demographics(tables["PatientMaster"], fixed_levels=True), _with_iss(dx, tables, key),
             *_reductions(tables, dx, key, False, markers, abnormalities)]
    return label(with_endpoints(assemble(parts, key, "full", key_nullable=False), strict_contact), LABELS)


def myeloma_cohort(tables: Mapping[str, DataFrame], samples: DataFrame, key: str = c.KEY,
                   markers: Sequence[str] | None = None, abnormalities: Sequence[str] | None = None,
                   strict_contact: bool = False) -> DataFrame:
    """Patients on the sample list, with the myeloma timeline (15 inputs, left assembly).

    ``samples`` has the key and ``sample_age`` (age text).
    """
    listed = samples.select(col(key), decode_age("sample_age").alias("sample_age"))
    decoded = c.diagnoses(join_ns(listed, tables["Diagnosis"], [key], "inner"), key)
    dx = _first_dx(c.target_timeline(decoded, key), key, "left")
    parts = [_with_iss(dx, tables, key), c.demographics(tables["PatientMaster"]),
             *_reductions(tables, dx, key, True, markers, abnormalities)]
    df = with_endpoints(assemble(parts, key, "left", key_nullable=False), strict_contact)
    return label(df.withColumn("received_imids", F.coalesce(F.col("received_imids"), F.lit("No"))), LABELS)


def myeloma_report(cohort: DataFrame, key: str = c.KEY) -> DataFrame:
    """The columns of the myeloma CSV."""
    return cohort.select(col(key), *MYELOMA_COLUMNS)


def lung_treatment_cohort(samples: DataFrame, linkage: DataFrame, meds: DataFrame, radiation: DataFrame,
                          key: str = c.KEY, max_n: int | None = None) -> DataFrame:
    """Samples of the lung cohort with regimens, radiation, and the timing of the blood sample.

    ``samples``: key, ``Germline``, ``Tumor_WES``, ``RNASeq``; ``linkage``: key, ``WES``, ``RNASeq``, ``SpecimenAge``.
    """
    aged = t.sample_ages(samples, linkage, key, "SpecimenAge", {
        "age_at_germline_collection": ("Germline", "WES", "all"),
        "age_at_tumor_collection": ("Tumor_WES", "WES", "all"),
        "age_at_rnaseq_collection": ("RNASeq", "RNASeq", "one")})
    long = t.medication_regimens(t.medication_history(semi_by_list(meds, key, samples), key), key)
    rad = t.radiation_history(semi_by_list(radiation, key, samples), key)
    joined = join_ns(join_ns(aged, t.regimens_wide(long, key, max_n=max_n), [key], "left"),
                     t.radiation_wide(rad, key, max_n=max_n), [key], "left")
    done = t.blood_timing(joined)
    own = [*aged.columns, "drug_ever", "radiation_ever", "drug_radiation_ever", "blood_before_drug", "blood_before_rad",
           "blood_before_drugorrad", "treatment_sequence"]
    return relocate(done, [*own, *[n for n in done.columns if n.startswith("ever_first")]])


# variables of the lung report's tables
_GAPS = {"drug": ["years_blood_before_drug", "years_blood_after_drug"], "rad": ["years_blood_before_rad", "years_blood_after_rad"],
         "both": ["years_blood_before_drugrad", "years_blood_after_drugrad"]}
LUNG_TABLES = {
    "timing": ["treatment_sequence", "drug_ever", "radiation_ever", "drug_radiation_ever", "blood_before_drug", *_GAPS["drug"], "blood_before_rad",
               *_GAPS["rad"], "blood_before_drugorrad", *_GAPS["both"]],
    "drugs": ["year_first_medication", "treatment_sequence", "drug_radiation_ever", "blood_before_drug", *_GAPS["drug"], "blood_before_drugorrad",
              *_GAPS["both"], "regimen_drugs_1"],
    "radiation": ["year_first_radiation", "treatment_sequence", "drug_radiation_ever", "blood_before_rad", *_GAPS["rad"], "blood_before_drugorrad",
                  *_GAPS["both"]],
}
_GIVEN = {"drugs": "drug_ever", "radiation": "radiation_ever"}


def lung_table(cohort: DataFrame, which: str) -> DataFrame:
    """One of the lung report's summary tables: ``timing`` of all samples, or ``drugs``, ``radiation`` of those treated so.

    Numbers are shown with one digit.
    """
    variables = LUNG_TABLES[which]
    rows = cohort.where(col(_GIVEN[which]) == "Yes") if which in _GIVEN else cohort
    kinds = dict(cohort.select(*variables).dtypes)
    return summary_table(rows, variables, digits={v: 1 for v in variables if kinds[v] != "string"})
