"""Kaplan-Meier curves, risk tables and log-rank tests.

Every statistic reads one collapsed table ``(slice, stratum, time) -> counts``. Rows with a NULL in time,
event, stratum or slice are not used. One keyed run covers all slices of a cohort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.crossprod import partial_products, sum_cells
from vitaspan.functions.pvalues import chi_square_p, quadratic_form
from vitaspan.functions.scalars import col
from vitaspan.operators.scan import running

Z95 = 1.959963984540054


def _complete(df: DataFrame, time: str, event: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*[col(k) for k in keys], col(time).cast("double").alias("time"),
                     col(event).cast("int").alias("event")).dropna()


def level_list(df: DataFrame, name: str) -> list:
    """Distinct non-NULL values of a grouping column, sorted."""
    return sorted(r[0] for r in df.select(col(name).alias("v")).where("v is not null").distinct().collect())


def kaplan_meier(df: DataFrame, time: str, event: str, strata: Sequence[str] = (), slice: Sequence[str] = (),
                 conf: bool = False) -> DataFrame:
    """Survival curve per (slice, stratum): one row per distinct time.

    Censored times are kept (``n_censored``). ``conf`` adds Greenwood's standard error and the band on the
    log scale; both are NULL once the curve is 0.
    """
    keys = [*slice, *strata]
    counts = _complete(df, time, event, keys).groupBy(*[col(k) for k in keys], "time").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("event").alias("n_event"))
    risk = running(counts, keys, "time", {"n_risk": F.col("__n")}, reverse=True)
    d, n = F.col("n_event"), F.col("n_risk")
    sums = {"__var": F.coalesce(F.when(d < n, d / (n.cast("double") * (n - d))), F.lit(0.0))} if conf else {}
    curve = running(risk, keys, "time", sums, {"surv": 1 - d / n})
    out = [*[col(k) for k in keys], F.col("time"), n, d, (F.col("__n") - d).alias("n_censored"), F.col("surv")]
    if conf:
        root = F.sqrt("__var")
        alive = F.col("surv") > 0
        out += [F.when(alive, F.col("surv") * root).alias("std_err"),
                F.when(alive, F.col("surv") * F.exp(-Z95 * root)).alias("lower"),
                F.when(alive, F.least(F.lit(1.0), F.col("surv") * F.exp(Z95 * root))).alias("upper")]
    return curve.select(*out)


def median_survival(curve: DataFrame, strata: Sequence[str] = (), p: float = 0.5) -> DataFrame:
    """First time at which the curve of the stratum is at or below ``p``; NULL if it never gets there."""
    return curve.groupBy(*[col(s) for s in strata]).agg(
        F.min(F.when(F.col("surv") <= p, F.col("time"))).alias("median"))


def risk_table(df: DataFrame, time: str, event: str, breaks: Sequence[float], strata: Sequence[str] = (),
               slice: Sequence[str] = ()) -> DataFrame:
    """Per break the number still at risk (time >= break) and the events before it, in one aggregation."""
    keys = [*slice, *strata]
    t, e = F.col("time"), F.col("event")
    cells = [F.struct(F.lit(float(b)).alias("at"), F.count_if(t >= b).alias("n_risk"),
                      F.coalesce(F.sum(F.when(t < b, e)), F.lit(0)).alias("events_before")) for b in breaks]
    wide = _complete(df, time, event, keys).groupBy(*[col(k) for k in keys]).agg(F.array(*cells).alias("__cells"))
    return wide.select(*[col(k) for k in keys], F.explode("__cells").alias("__c")).select(
        *[col(k) for k in keys], "__c.*")


# --- log-rank --------------------------------------------------------------------------------------

def _logrank_sums(df: DataFrame, time: str, event: str, group: str, slice: Sequence[str],
                  groups: Sequence | None) -> tuple[DataFrame, list]:
    """Per slice arrays over the groups: ``size, observed, expected`` and the flat covariance ``var``.

    Group counts are columns of the time row, so a group without rows at some time still counts there. The
    covariance comes from one matrix product per task, whatever the number of groups.
    """
    names = list(groups) if groups is not None else level_list(df, group)
    k = len(names)
    base = _complete(df.withColumn("__g", col(group)), time, event, [*slice, "__g"])
    at = base.groupBy(*[col(s) for s in slice], "time").agg(
        *[F.count_if(F.col("__g") == g).alias(f"c{i}") for i, g in enumerate(names)],
        *[F.coalesce(F.sum(F.when(F.col("__g") == g, F.col("event"))), F.lit(0)).alias(f"d{i}")
          for i, g in enumerate(names)])
    risk = running(at, list(slice), "time", {f"n{i}": F.col(f"c{i}") for i in range(k)}, reverse=True)
    total = lambda p: F.aggregate(F.array(*[F.col(f"{p}{i}").cast("double") for i in range(k)]), F.lit(0.0), lambda x, y: x + y)
    rows = risk.withColumns({"__n": total("n"), "__d": total("d")})
    n, d = F.col("__n"), F.col("__d")
    scale = F.when(n > 1, d * (n - d) / (n - 1)).otherwise(0.0)
    rows = rows.withColumns({"__share": d / n, "__one": scale / n, "__two": scale / (n * n)})
    flat = lambda p, w=None: F.array(*[F.sum(F.col(f"{p}{i}") if w is None else F.col(w) * F.col(f"{p}{i}")) for i in range(k)])
    keys = [f"__s{i}" for i in range(len(slice))] or ["__s0"]
    keyed = rows.withColumns({s: (col(slice[i]).cast("string") if slice else F.lit("all")) for i, s in enumerate(keys)})
    sums = keyed.groupBy(*keys, *[col(s) for s in slice]).agg(
        flat("c").alias("size"), flat("d").alias("observed"), flat("n", "__share").alias("expected"), flat("n", "__one").alias("own"))
    sides = [f"n{i}" for i in range(k)]
    counted = keyed.select(*keys, F.col("__two"), *[F.col(x).cast("double").alias(x) for x in sides])
    cells = sum_cells(partial_products(counted, keys, [("__two", sides, sides)]), keys)
    cross = cells.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "value"))), lambda c: c["value"]).alias("cross"))
    var = F.transform("cross", lambda v, i: F.when(i % (k + 1) == 0, F.get("own", (i / (k + 1)).cast("int"))).otherwise(0.0) - v)
    return sums.join(cross, keys).select(*[col(s) for s in slice], "size", "observed", "expected", var.alias("var")), names


def logrank_counts(df: DataFrame, time: str, event: str, group: str, slice: Sequence[str] = (),
                   groups: Sequence | None = None) -> DataFrame:
    """Observed and expected events per (slice, group), with the variance of their difference."""
    sums, names = _logrank_sums(df, time, event, group, slice, groups)
    k = len(names)
    cells = F.transform(F.array(*[F.lit(g) for g in names]), lambda g, i: F.struct(
        g.alias(group), F.get("size", i).alias("n"), F.get("observed", i).alias("observed"), F.get("expected", i).alias("expected"),
        F.get("var", i * (k + 1)).alias("variance")))
    return sums.select(*[col(s) for s in slice], F.explode(cells).alias("__c")).select(
        *[col(s) for s in slice], "__c.*").where("n > 0")


def logrank(df: DataFrame, time: str, event: str, group: str, slice: Sequence[str] = (),
            groups: Sequence | None = None) -> DataFrame:
    """Log-rank test per slice: statistic, degrees of freedom, p-value."""
    sums, names = _logrank_sums(df, time, event, group, slice, groups)
    diff = F.zip_with("observed", "expected", lambda o, e: o - e)
    tested = sums.withColumn("statistic", quadratic_form(F.col("size").cast("array<double>"), diff, F.col("var")))
    present = F.size(F.filter("size", lambda v: v > 0)) - 1
    return tested.select(*[col(s) for s in slice], "statistic", present.alias("df"),
                         chi_square_p(F.col("statistic"), present).alias("p_value"))
