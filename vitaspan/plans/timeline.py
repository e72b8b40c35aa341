"""Treatment timelines: lines, regimens, first treatments, and the place of a sample among them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col, contains, decode_age, remove_first, to_number
from vitaspan.operators.frames import across
from vitaspan.operators.joins import join_ns
from vitaspan.operators.ordered import dense_rank_nulls_out, first_per_key, group_first, group_values
from vitaspan.operators.reshape import concat_ordered, pivot_ordinal

# fixed values: words for the line of therapy and the codes that sort them
ORDINAL_LINES = {
    "Second": 2, "Third": 3, "Fourth": 4, "Fifth": 5, "Sixth": 6, "Seventh": 7,
    "Eighth": 8, "Ninth": 9, "Tenth": 10, "Eleventh": 11, "Twelfth": 12,
}
LINE_NEOADJUVANT, LINE_ADJUVANT = -1, 1
LINE_MAINTENANCE, LINE_PALLIATIVE, LINE_UNKNOWN, LINE_NONE = 90, 91, 999, 1000

# fixed values: suffixes dropped from drug names, and drug names with another spelling
DRUG_SUFFIXES = [
    " Hydrochloride", "Liposomal ", " Sulfate", " Phosphate", " Citrate", " Acetate", " Camsylate",
    " Disodium", " Mesylate", " Ditosylate", " Tosylate", " Tartrate",
]
DRUG_FAMILY = "Paclitaxel"
DRUG_ALIASES = {"Interferon, NOS": "Interferon", "Bevacizumab-maly": "Bevacizumab"}


def clean_drug(name: str | Column) -> Column:
    """Generic lower-case drug name: first salt or carrier word removed, spellings unified."""
    short = remove_first(name, "|".join(DRUG_SUFFIXES))
    unified = F.when(contains(short, DRUG_FAMILY), F.lit(DRUG_FAMILY))
    for alias, generic in DRUG_ALIASES.items():
        unified = unified.when(short == alias, F.lit(generic))
    return F.lower(unified.otherwise(short))


def line_number(text: str | Column) -> Column:
    """Code of a line description; the first rule that applies decides. No description is 1000."""
    line = col(text)
    first = contains(line, "First")
    code = (F.when(contains(line, "Unknown"), F.lit(LINE_UNKNOWN))
            .when(first & contains(line, "Neoadjuvant"), F.lit(LINE_NEOADJUVANT))
            .when(first & contains(line, "Adjuvant"), F.lit(LINE_ADJUVANT)))
    for word, number in ORDINAL_LINES.items():
        code = code.when(contains(line, word), F.lit(number))
    return (code.when(line == "Maintenance", F.lit(LINE_MAINTENANCE))
            .when(line == "Palliative", F.lit(LINE_PALLIATIVE)).otherwise(F.lit(LINE_NONE)))


def line_of_therapy(df: DataFrame, key: str | Sequence[str], line_text: str, start: str, out: str = "regimen_line") -> DataFrame:
    """Line number per record, for one key at a time.

    If a key has some unknown line and no known one, its records are numbered by start instead (a record
    without a start then has no number). A NULL description counts neither as unknown nor as known.
    """
    keys = [key] if isinstance(key, str) else list(key)
    unknown = contains(line_text, "Unknown")
    df = df.withColumn("__code", line_number(line_text))
    df = group_values(df, keys, {"__unknown": F.max(unknown), "__all_unknown": F.min(unknown)})
    by_start = dense_rank_nulls_out(df, keys, [start, "__code"], "__by_start")
    no_line_info = F.coalesce(F.col("__unknown"), F.lit(False)) & F.coalesce(F.col("__all_unknown"), F.lit(False))
    return by_start.withColumn(out, F.when(no_line_info, F.col("__by_start")).otherwise(F.col("__code")).cast("int")) \
        .drop("__code", "__unknown", "__all_unknown", "__by_start")


def regimens(df: DataFrame, key: str, start: str, stop: str, drug: str, line: str, others: Sequence[str] = (),
             out: str = "regimen_drugs") -> DataFrame:
    """Drugs given together: first those with the same start and stop are joined, then those with the same start.

    ``others`` are further columns that are constant within a regimen and stay in the key. Drugs are in
    alphabetical order within one stop, stops in time order; an unknown stop makes the stop text NULL.
    """
    keys = [key, line, start, *others]
    same_stop = concat_ordered(df, [*keys, stop], [drug], [drug])
    joined = concat_ordered(same_stop, keys, [drug, stop], [stop, drug])
    return joined.withColumnRenamed(drug, out)


def medication_history(meds: DataFrame, key: str, ind: str = "MedicationInd", drug: str = "Medication",
                       start: str = "AgeAtMedStart", stop: str = "AgeAtMedStop", year: str = "YearOfMedStart",
                       line_text: str = "MedLineRegimen") -> DataFrame:
    """Decoded, normalised and numbered medication records, with the never-treated keys kept.

    Adds ``ever_first_med_age``, ``regimen_line`` and ``year_first_medication`` (the year of the record with
    the earliest start).
    """
    decoded = across(meds, [start, stop], decode_age).withColumn(drug, clean_drug(drug)).withColumn("__given", col(ind) == "Yes")
    # one layout by key: given and never-treated records go through the same windows and are told apart by row
    timed = decoded.withColumns({"__own": col(start), start: F.coalesce(col(start), col(stop))})
    timed = group_values(timed, [key], {"ever_first_med_age": F.min(col(start))})
    lines = line_of_therapy(timed.where(col(ind).isin("Yes", "No")), [key, "__given"], line_text, start)
    given = F.col("__given")
    both = lines.withColumns({start: F.when(given, col(start)).otherwise(F.col("__own")),
                              **{c: F.when(given, F.col(c)) for c in ("ever_first_med_age", "regimen_line")}}).drop("__given", "__own")
    # the record that is kept of repeats is the first of them in this order too
    dated = group_first(both, [key], year, [start, stop, drug, "regimen_line", year], "year_first_medication")
    return first_per_key(dated, [key, start, drug, stop], ["regimen_line", year])


def medication_regimens(history: DataFrame, key: str, ind: str = "MedicationInd", drug: str = "Medication",
                        start: str = "AgeAtMedStart", stop: str = "AgeAtMedStop") -> DataFrame:
    """Long regimens of a medication history."""
    return regimens(history, key, start, stop, drug, "regimen_line", [ind, "ever_first_med_age", "year_first_medication"])


def regimens_wide(long: DataFrame, key: str, ind: str = "MedicationInd", start: str = "AgeAtMedStart",
                  stop: str = "AgeAtMedStop", max_n: int | None = None) -> DataFrame:
    """Regimens side by side, numbered by start within the key; with the flags of the joined table."""
    ids = [key, ind, "ever_first_med_age", "year_first_medication"]
    wide = pivot_ordinal(long, ids, key, [start, "regimen_line"], [start, "regimen_drugs", stop], max_n)
    earlier = col(f"{start}_1") > F.col("ever_first_med_age")
    return wide.withColumnRenamed(ind, "drug_ever").withColumns(
        {"has_medication_data": F.lit("Yes"), "had_prior_medication": F.when(earlier, F.lit("Yes"))})


def radiation_history(rad: DataFrame, key: str, start: str = "AgeAtRadiationStart", stop: str = "AgeAtRadiationStop",
                      dose: str = "RadDose", year: str = "YearOfRadiationStart") -> DataFrame:
    """Decoded radiation records without repeats; adds ``ever_first_rad_age`` and ``year_first_radiation``."""
    decoded = across(rad, [start, stop], decode_age).withColumn(dose, to_number(dose))
    timed = group_values(decoded, [key], {"ever_first_rad_age": F.min(col(start))})
    timed = group_first(timed, [key], year, [start, stop, dose], "year_first_radiation")
    return first_per_key(timed, [key, start, dose, stop], [year])


def radiation_wide(long: DataFrame, key: str, ind: str = "RadiationTherapyInd", start: str = "AgeAtRadiationStart",
                   stop: str = "AgeAtRadiationStop", dose: str = "RadDose", max_n: int | None = None) -> DataFrame:
    """Radiation records side by side, in order of their start (unknown starts last)."""
    ids = [key, ind, "ever_first_rad_age", "year_first_radiation"]
    wide = pivot_ordinal(long, ids, key, [start, stop, dose], [start, dose, stop], max_n)
    return wide.withColumnRenamed(ind, "radiation_ever").withColumn("has_radiation_data", F.lit("Yes"))


# --- classes of one row ----------------------------------------------------------------------------

def treatment_ever(drug: str, radiation: str) -> Column:
    """Which treatments were ever given; half-known combinations have their own class."""
    d, r = col(drug), col(radiation)
    return (F.when((d == "Yes") & (r == "Yes"), "Drug+Radiation").when(d == "Yes", "Drug only")
            .when(r == "Yes", "Radiation only").when((d == "No") & (r == "No"), "No drug or radiation")
            .when(d == "No", "Not received drug").when(r == "No", "Not received rad"))


def timing_against(sample: str, treatment: str, ever: str, word: str) -> Column:
    """Sample before or after one treatment (``word``: drug, rad); else why that is not known."""
    s, t = col(sample), col(treatment)
    return (F.when(s <= t, f"blood before {word}").when(s > t, f"blood after {word}")
            .when(col(ever) == "No", f"No {word} received").when(s.isNull(), "no germline age")
            .when(t.isNull(), f"missing {word} age"))


def timing_against_both(sample: str, drug: str, rad: str, drug_ever: str, rad_ever: str) -> Column:
    """Sample against both treatments: before, after or between, else why that is not known."""
    s, d, r = col(sample), col(drug), col(rad)
    de, re_ = col(drug_ever), col(rad_ever)
    return (F.when((s <= d) & (s <= r), "blood before drug/rad").when((s > d) & (s > r), "blood after drug/rad")
            .when((de == "No") & (re_ == "No"), "No drug/rad received").when((de == "Yes") & (re_ == "No"), "Drug only")
            .when((re_ == "Yes") & (de == "No"), "Radiation only")
            .when(d.isNull() & r.isNull(), "missing drug and rad age").when(d.isNull(), "missing drug age")
            .when(r.isNull(), "missing rad age").when((s > d) & (s <= r), "drug/blood/rad")
            .when((s <= d) & (s > r), "rad/blood/drug"))


def treatment_sequence(drug: str, rad: str, drug_ever: str, rad_ever: str) -> Column:
    """Order of the first drug and the first radiation, else what is known instead."""
    d, r, de, re_ = col(drug), col(rad), col(drug_ever), col(rad_ever)
    return (F.when(d <= r, "drug/rad").when(d > r, "rad/drug")
            .when((de == "No") & (re_ == "No"), "No drug or radiation").when((de == "Yes") & (re_ == "No"), "Drug only")
            .when((re_ == "Yes") & (de == "No"), "Radiation only")
            .when(d.isNull() & r.isNull(), "missing drug and rad age").when(d.isNull(), "missing drug age")
            .when(r.isNull(), "missing rad age"))


def blood_timing(df: DataFrame, sample: str = "age_at_germline_collection", drug: str = "AgeAtMedStart_1",
                 rad: str = "AgeAtRadiationStart_1", drug_ever: str = "drug_ever",
                 rad_ever: str = "radiation_ever") -> DataFrame:
    """All timing classes and signed gaps in years.

    The gaps keep the signs of the reports they feed: against one treatment they are zero or negative, also
    after it; against both, the gap to the earlier treatment is positive after it.
    """
    s, d, r = col(sample), col(drug), col(rad)
    earlier = F.when(d.isNotNull() & r.isNotNull(), F.least(d, r))
    df = df.withColumns({
        "drug_radiation_ever": treatment_ever(drug_ever, rad_ever),
        "blood_before_drug": timing_against(sample, drug, drug_ever, "drug"),
        "blood_before_rad": timing_against(sample, rad, rad_ever, "rad"),
        "blood_before_drugorrad": timing_against_both(sample, drug, rad, drug_ever, rad_ever),
        "treatment_sequence": treatment_sequence(drug, rad, drug_ever, rad_ever)})
    c = F.col
    return df.withColumns({
        "years_blood_before_drug": F.when(c("blood_before_drug") == "blood before drug", s - d),
        "years_blood_after_drug": F.when(c("blood_before_drug") == "blood after drug", d - s),
        "years_blood_before_rad": F.when(c("blood_before_rad") == "blood before rad", s - r),
        "years_blood_after_rad": F.when(c("blood_before_rad") == "blood after rad", r - s),
        "years_blood_before_drugrad": F.when(c("blood_before_drugorrad") == "blood before drug/rad", s - earlier),
        "years_blood_after_drugrad": F.when(c("blood_before_drugorrad") == "blood after drug/rad", s - earlier)})


def first_of(values: Mapping[str, str | Column]) -> tuple[Column, Column]:
    """Label and value of the strictly smallest value; a tie for the smallest has no label."""
    cols = {k: col(v) for k, v in values.items()}
    smallest = F.least(*cols.values())
    hits = sum((F.when(c == smallest, 1).otherwise(0) for c in cols.values()), F.lit(0))
    label = F.coalesce(*[F.when(c == smallest, F.lit(k)) for k, c in cols.items()])
    return F.when(hits == 1, label), F.when(hits == 1, smallest)


def last_contact(contact: str, last_seen: str, strict: bool = False) -> Column:
    """Later of the recorded contact and the last examination.

    One of them is enough, unless ``strict``: then the result is NULL when either is missing.
    """
    a, b = col(contact), col(last_seen)
    latest = F.greatest(a, b)
    return F.when(a.isNotNull() & b.isNotNull(), latest) if strict else latest


# --- samples ---------------------------------------------------------------------------------------

def sample_ages(samples: DataFrame, linkage: DataFrame, key: str, age: str, roles: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """Attach the collection age of several sample roles from one linkage table.

    ``roles``: new column -> (id column of ``samples``, id column of ``linkage``, ``one`` or ``all``). With
    ``one`` only the first linkage row of an id is used. NULL ids match NULL ids.
    """
    out = samples
    for name, (own, other, rows) in roles.items():
        side = linkage.select(col(key), col(other).alias("__id"), decode_age(age).alias(name))
        if rows == "one":
            side = first_per_key(side, ["__id"], [key, name])
        out = join_ns(out, side, {key: key, own: "__id"}, "left")
    return out
