"""Time-to-event endpoints: event flag, age at the event or at censoring, and time since an origin."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.scalars import col, recode
from vitaspan.operators.joins import union_fill

# fixed values: codes of status columns
VITAL_EVENTS = {"Alive": 0, "Lost to follow-up": 0, "Dead": 1}
PROGRESSION_EVENTS = {"No": 0, "Progression": 1, "Recurrence": 1}
CODED_ENDPOINTS = {
    "OS": {"0:LIVING": 0, "1:DECEASED": 1},
    "DSS": {"0:ALIVE OR DEAD TUMOR FREE": 0, "1:DEAD WITH TUMOR": 1},
    "DFS": {"0:DiseaseFree": 0, "1:Recurred/Progressed": 1},
    "PFS": {"0:CENSORED": 0, "1:PROGRESSION": 1},
}


def set_unit(df: DataFrame, unit_by_column: Mapping[str, str]) -> DataFrame:
    """Record the time unit of columns in their metadata."""
    for name, unit in unit_by_column.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "unit": unit})
    return df


def unit_of(df: DataFrame, name: str) -> str | None:
    return df.schema[name].metadata.get("unit")


def endpoint(df: DataFrame, out: str, status: str, event_map: Mapping[str, int], event_time: str | Column,
             censor_time: str | Column, origins: Mapping[str, str], unit: str = "years",
             by_status: bool = False) -> DataFrame:
    """Add ``<out>_event``, ``<out>_age`` and ``<out>_time_from_<origin>_<unit>`` per origin.

    A status that is not mapped has no event flag. The age is the event time if there is one, else the
    censoring time; with ``by_status`` the flag decides: the event time for events, the censoring time for
    the others, nothing without a flag.
    """
    event = recode(status, event_map).cast("int")
    at, until = col(event_time), col(censor_time)
    age = F.when(event == 1, at).when(event == 0, until) if by_status else F.coalesce(at, until)
    df = df.withColumn(f"{out}_event", event).withColumn(f"{out}_age", age)
    times = {f"{out}_time_from_{name}_{unit}": F.col(f"{out}_age") - col(c) for name, c in origins.items()}
    return set_unit(df.withColumns(times), {t: unit for t in times})


def overall_survival(df: DataFrame, origins: Mapping[str, str], vital: str = "VitalStatus", death: str = "AgeAtDeath",
                     contact: str = "AgeAtLastContact") -> DataFrame:
    return endpoint(df, "os", vital, VITAL_EVENTS, death, contact, origins)


def progression_free_survival(df: DataFrame, origins: Mapping[str, str], indicator: str = "ProgRecurInd",
                              progression: str = "AgeAtProgRecur", contact: str = "os_age",
                              coalesced: bool = False) -> DataFrame:
    """``coalesced``: age at progression whatever the indicator says, else the contact."""
    return endpoint(df, "pfs", indicator, PROGRESSION_EVENTS, progression, contact, origins, by_status=not coalesced)


def metastasis_free_survival(df: DataFrame, origins: Mapping[str, str], indicator: str = "had_metastasis",
                             age: str = "AgeAtMetastaticSite", contact: str = "AgeAtLastContact") -> DataFrame:
    """A missing indicator means no metastasis; an explicit "No" is left without a flag."""
    filled = df.withColumn("__met", F.coalesce(col(indicator), F.lit("<none>")))
    return endpoint(filled, "met", "__met", {"Yes": 1, "<none>": 0}, age, contact, origins).drop("__met")


def coded_endpoints(df: DataFrame, names: Sequence[str] = tuple(CODED_ENDPOINTS)) -> DataFrame:
    """``<name>_STATUS`` codes to 0/1; other texts become NULL."""
    return df.withColumns({f"{n}_STATUS": recode(f"{n}_STATUS", CODED_ENDPOINTS[n]).cast("int") for n in names})


def complete_for(df: DataFrame, name: str, group: str) -> DataFrame:
    """Rows usable for one coded endpoint."""
    return df.dropna(subset=[f"{name}_STATUS", f"{name}_MONTHS", group])


def stack_cohorts(frames: Sequence[DataFrame], times: Sequence[str]) -> DataFrame:
    """Union of cohorts with missing columns filled; refuses to mix units in a time column."""
    for t in times:
        units = {unit_of(f, t) for f in frames if t in f.columns} - {None}
        if len(units) > 1:
            raise ValueError(f"{t} has several units: {sorted(units)}")
    return union_fill(*frames)
