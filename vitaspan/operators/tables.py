"""Summary tables in long form, group tests, and the numbers behind histograms and box plots.

Categorical variables are counted and continuous ones collapsed to ``(variable, group, value) -> n`` with a
map-side combine; percentages, quantiles and rank sums are computed from those counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.functions.pvalues import chi_square_p, fisher_p, normal_p, rank_sum_exact_p
from vitaspan.functions.scalars import col, number_text
from vitaspan.operators.joins import join_ns
from vitaspan.operators.scan import quantiles, quantiles_of_counts, running
from vitaspan.operators.survival import level_list
from vitaspan.session import shared

OVERALL = "Overall"
#: Levels up to which a table is put together for the exact test.
FISHER_LEVELS = 50
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}
_NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def _kinds(df: DataFrame, variables: Sequence[str], kinds: Mapping[str, str] | None) -> dict[str, str]:
    types = dict(df.dtypes)
    kinds = kinds or {}
    auto = {v: "continuous" if types[v] in _NUMERIC or types[v].startswith("decimal") else "categorical"
            for v in variables}
    return {v: kinds.get(v, auto[v]) for v in variables}


def _text(df: DataFrame, name: str) -> Column:
    return number_text(name) if dict(df.dtypes)[name] in ("double", "float") else col(name).cast("string")


def _grouped(df: DataFrame, by: str | None) -> DataFrame:
    """Rows with a group text in ``__g``; rows without a group are not part of a grouped table."""
    if by is None:
        return df.withColumn("__g", F.lit(OVERALL))
    return df.withColumn("__g", _text(df, by)).where(F.col("__g").isNotNull())


def _long(df: DataFrame, variables: Sequence[str], value: str, as_text: bool) -> DataFrame:
    cells = [F.struct(F.lit(v).alias("variable"),
                      (_text(df, v) if as_text else col(v).cast("double")).alias(value)) for v in variables]
    return df.select("__g", F.explode(F.array(*cells)).alias("__c")).select("__g", "__c.*")


def category_counts(df: DataFrame, variables: Sequence[str], by: str | None = None) -> DataFrame:
    """``(variable, level, group) -> n``, NULL levels included."""
    return _long(_grouped(df, by), variables, "level", True).groupBy("variable", "level", "__g").agg(
        F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, variables: Sequence[str], by: str | None = None) -> DataFrame:
    """``(variable, group, value) -> n`` of numeric variables, NULL values included."""
    return _long(_grouped(df, by), variables, "value", False).groupBy("variable", "__g", "value").agg(
        F.count(F.lit(1)).alias("n"))


def _groups(df: DataFrame, by: str | None, groups: Sequence[str] | None) -> list[str]:
    if by is None:
        return [OVERALL]
    if groups is not None:
        return [str(g) for g in groups]
    return level_list(_grouped(df, by), "__g")


def _side_by_side(counts: DataFrame, ids: Sequence[str], groups: Sequence[str], n: str = "n") -> DataFrame:
    """Counts of the groups as columns ``g0, g1, ...``; a missing cell is 0."""
    return counts.groupBy(*ids).agg(*[
        F.coalesce(F.sum(F.when(F.col("__g") == g, F.col(n))), F.lit(0)).alias(f"g{i}") for i, g in enumerate(groups)])


def _sum(k: int, prefix: str = "g") -> Column:
    return reduce(lambda a, b: a + b, [F.col(f"{prefix}{i}") for i in range(k)])


def summary_table(df: DataFrame, variables: Sequence[str], by: str | None = None, overall: bool = False,
                  kinds: Mapping[str, str] | None = None, digits: Mapping[str, int] | None = None,
                  tests: bool = False, groups: Sequence[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """Long summary: ``variable, kind, level, group, stat, value``.

    Categorical: ``n`` and ``p`` (percent of the non-missing) for every level and group, zero cells
    included; continuous: ``p25``, ``median``, ``p75``; both: ``missing``. ``kinds`` overrides the kind of a
    variable (numbers are continuous by default). ``digits`` rounds the values of a variable. ``tests`` adds
    ``p_value`` and ``significant``.
    """
    kind = _kinds(df, variables, kinds)
    # every kind of variable, the groups and the tests read the rows on their own
    df = shared(df.select(*[col(c) for c in dict.fromkeys([*variables, *([by] if by else [])])]))
    names = _groups(df, by, groups)
    shown = [*names, OVERALL] if overall and by is not None else names
    parts = []
    cats = [v for v in variables if kind[v] == "categorical"]
    nums = [v for v in variables if kind[v] == "continuous"]
    if cats:
        parts.append(_category_part(category_counts(df, cats, by), names, shown))
    if nums:
        parts.append(_number_part(value_counts(df, nums, by), shown if overall and by is not None else None))
    table = reduce(lambda a, b: a.unionByName(b), parts)
    if digits:
        places = F.lit(None).cast("int")
        for v, d in digits.items():
            places = F.when(F.col("variable") == v, F.lit(d)).otherwise(places)
        rounded = reduce(lambda acc, d: F.when(F.col("__d") == d, F.round("value", d)).otherwise(acc),
                         sorted(set(digits.values())), F.col("value"))
        table = table.withColumn("__d", places).withColumn("value", rounded).drop("__d")
    if tests:
        p = group_tests(df, variables, by, kinds, names, alpha).select("variable", "p_value", "significant")
        table = table.join(p, "variable", "left")
    return table


def _category_part(counts: DataFrame, names: Sequence[str], shown: Sequence[str]) -> DataFrame:
    k = len(names)
    cells = _side_by_side(counts, ["variable", "level"], names)
    if len(shown) > k:
        cells = cells.withColumn(f"g{k}", _sum(k))
    known = cells.where("level is not null")
    totals = known.groupBy("variable").agg(*[F.sum(f"g{i}").alias(f"t{i}") for i in range(len(shown))])
    missing = cells.groupBy("variable").agg(*[F.sum(F.when(F.col("level").isNull(), F.col(f"g{i}")).otherwise(0))
                                              .alias(f"g{i}") for i in range(len(shown))])
    percent = [F.when(F.col(f"t{i}") > 0, 100.0 * F.col(f"g{i}") / F.col(f"t{i}")) for i in range(len(shown))]
    rows = known.join(totals, "variable", "left").select("variable", "level", F.explode(F.array(*[
        F.struct(F.lit(g).alias("group"), F.lit(s).alias("stat"), v.cast("double").alias("value"))
        for i, g in enumerate(shown) for s, v in (("n", F.col(f"g{i}")), ("p", percent[i]))])).alias("__c"))
    absent = missing.select("variable", F.lit(None).cast("string").alias("level"), F.explode(F.array(*[
        F.struct(F.lit(g).alias("group"), F.lit("missing").alias("stat"), F.col(f"g{i}").cast("double").alias("value"))
        for i, g in enumerate(shown)])).alias("__c"))
    return rows.unionByName(absent).select("variable", F.lit("categorical").alias("kind"), "level", "__c.*")


def _number_part(counts: DataFrame, shown: Sequence[str] | None) -> DataFrame:
    if shown:
        both = counts.withColumn("__g", F.explode(F.array(F.col("__g"), F.lit(OVERALL))))
        counts = both.groupBy("variable", "__g", "value").agg(F.sum("n").alias("n"))
    keys = ["variable", "__g"]
    q = quantiles_of_counts(counts.where("value is not null"), keys, "value", "n", QUARTILES)
    absent = counts.groupBy(*keys).agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"))
    stats = [*QUARTILES, "missing"]
    return absent.join(q, keys, "left").select(
        "variable", F.lit("continuous").alias("kind"), F.lit(None).cast("string").alias("level"),
        F.col("__g").alias("group"), F.explode(F.array(*[
            F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in stats])).alias("__c")
    ).select("variable", "kind", "level", "group", "__c.*")


def by_frequency(table: DataFrame, group: str = OVERALL) -> DataFrame:
    """Add ``place``: levels of a variable numbered by falling count in ``group``, ties by level.

    The rank needs the levels of a variable only, which are the lines of the printed table.
    """
    from pyspark.sql import Window as W

    lines = table.where((F.col("stat") == "n") & (F.col("group") == group)).select("variable", "level", "value")
    w = W.partitionBy("variable").orderBy(F.col("value").desc(), F.col("level").asc())
    place = lines.select("variable", "level", F.row_number().over(w).alias("place"))
    return join_ns(table, place, ["variable", "level"], "left")


def header_counts(df: DataFrame, by: str, overall: bool = False) -> DataFrame:
    """``group, n`` for the column headers."""
    n = _grouped(df, by).groupBy(F.col("__g").alias("group")).agg(F.count(F.lit(1)).alias("n"))
    if not overall:
        return n
    return n.unionByName(_grouped(df, by).agg(F.count(F.lit(1)).alias("n")).withColumn("group", F.lit(OVERALL)))


def frequency(df: DataFrame, name: str) -> DataFrame:
    """Counts of the non-NULL values of a column."""
    return df.where(col(name).isNotNull()).groupBy(col(name)).agg(F.count(F.lit(1)).alias("n"))


def merge_tables(tables: Mapping[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Result tables side by side: full join on ``on``, other columns prefixed with the table's name."""
    named = [t.select(*[col(c) for c in on], *[col(c).alias(f"{name}_{c}") for c in t.columns if c not in on])
             for name, t in tables.items()]
    return reduce(lambda a, b: join_ns(a, b, list(on), "full"), named)


# --- tests -----------------------------------------------------------------------------------------

def chi_square(df: DataFrame, variables: Sequence[str], by: str, groups: Sequence[str] | None = None) -> DataFrame:
    """Pearson's test of independence between each variable and the group, without continuity correction.

    A table with an expected count below 5 (``low_expected``) gets Fisher's exact test, whatever its shape. It keeps the
    chi-square value only if it has more than ``FISHER_LEVELS`` levels or too many tables share its margins.
    """
    names = _groups(df, by, groups)
    k = len(names)
    cells = _side_by_side(category_counts(df, variables, by).where("level is not null"), ["variable", "level"], names)
    totals = cells.groupBy("variable").agg(*[F.sum(f"g{i}").alias(f"t{i}") for i in range(k)])
    rows = cells.join(totals, "variable", "left").withColumns({"__row": _sum(k), "__all": _sum(k, "t")})
    expected = [F.col("__row") * F.col(f"t{i}") / F.col("__all") for i in range(k)]
    share = [F.when(F.col(f"t{i}") > 0, (F.col(f"g{i}") - expected[i]) ** 2 / expected[i]).otherwise(0.0) for i in range(k)]
    low = reduce(lambda a, b: a | b, [(F.col(f"t{i}") > 0) & (expected[i] < 5) for i in range(k)])
    tested = rows.groupBy("variable").agg(
        F.sum(reduce(lambda a, b: a + b, share)).alias("statistic"),
        F.bool_or(low).alias("low_expected"), F.count(F.lit(1)).alias("__levels"),
        *[F.first(f"t{i}").alias(f"t{i}") for i in range(k)])
    live = reduce(lambda a, b: a + b, [F.when(F.col(f"t{i}") > 0, 1).otherwise(0) for i in range(k)])
    tested = tested.withColumn("df", ((F.col("__levels") - 1) * (live - 1)).cast("int"))
    few = tested.where(F.col("low_expected") & (F.col("__levels") <= FISHER_LEVELS)).select("variable")
    tables = cells.join(few, "variable", "left_semi").groupBy("variable").agg(
        F.collect_list(F.array(*[F.col(f"g{i}").cast("long") for i in range(k)])).alias("__table"))
    fisher = tables.select("variable", fisher_p(F.col("__table")).alias("__fisher"))
    exact = F.col("__fisher").isNotNull()
    plain = chi_square_p(F.col("statistic"), F.col("df"))
    return tested.withColumn("__plain", plain).join(fisher, "variable", "left").select(
        "variable", F.when(exact, "fisher").otherwise("chi-square").alias("test"), "statistic", "df",
        F.when(exact, F.col("__fisher")).otherwise(F.col("__plain")).alias("p_value"), "low_expected")


def rank_sums(df: DataFrame, variables: Sequence[str], by: str, groups: Sequence[str] | None = None) -> DataFrame:
    """Rank statistics of each numeric variable across the groups.

    ``kruskal`` is tie-corrected. ``rank_sum`` and ``u`` (of the first group) and ``z`` (tie- and
    continuity-corrected) are NULL unless there are exactly two groups.
    """
    names = _groups(df, by, groups)
    k = len(names)
    counts = value_counts(df, variables, by).where("value is not null")
    wide = _side_by_side(counts, ["variable", "value"], names).withColumn("__t", _sum(k))
    ranked = running(wide, ["variable"], "value", {"__hi": F.col("__t")})
    mid = F.col("__hi") - (F.col("__t") - 1) / 2
    t = F.col("__t").cast("double")
    sums = ranked.groupBy("variable").agg(
        *[F.sum(mid * F.col(f"g{i}")).alias(f"r{i}") for i in range(k)],
        *[F.sum(f"g{i}").cast("double").alias(f"n{i}") for i in range(k)],
        F.sum(t * t * t - t).alias("ties"), F.sum(t).alias("n"))
    n = F.col("n")
    live = [F.col(f"n{i}") > 0 for i in range(k)]
    spread = reduce(lambda a, b: a + b, [F.when(live[i], F.col(f"r{i}") ** 2 / F.col(f"n{i}")).otherwise(0.0) for i in range(k)])
    raw = 12 / (n * (n + 1)) * spread - 3 * (n + 1)
    df_col = (reduce(lambda a, b: a + b, [F.when(x, 1).otherwise(0) for x in live]) - 1).cast("int")
    none = F.lit(None).cast("double")
    out = {"kruskal": raw / (1 - F.col("ties") / (n ** 3 - n)), "df": df_col}
    if k == 2:
        m0, m1 = F.col("n0"), F.col("n1")
        u = F.col("r0") - m0 * (m0 + 1) / 2
        away = u - m0 * m1 / 2
        sigma = F.sqrt(m0 * m1 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
        out |= {"rank_sum": F.col("r0"), "u": u, "z": (away - F.signum(away) * 0.5) / sigma}
    else:
        out |= {"rank_sum": none, "u": none, "z": none}
    return sums.withColumns(out).select("variable", n.cast("long").alias("n"), "ties", "kruskal", "df", "rank_sum", "u",
                                        "z", *([F.col("n0"), F.col("n1")] if k == 2 else [none.alias("n0"), none.alias("n1")]))


def rank_tests(df: DataFrame, variables: Sequence[str], by: str, groups: Sequence[str] | None = None) -> DataFrame:
    """Wilcoxon's test for two groups (exact below 50 per group without ties), Kruskal-Wallis for more."""
    names = _groups(df, by, groups)
    s = rank_sums(df, variables, by, names)
    if len(names) != 2:
        return s.select("variable", F.lit("kruskal-wallis").alias("test"), F.col("kruskal").alias("statistic"), "df",
                        chi_square_p(F.col("kruskal"), F.col("df")).alias("p_value"))
    exact = (F.col("ties") == 0) & (F.col("n0") < 50) & (F.col("n1") < 50)
    small = rank_sum_exact_p(F.when(exact, F.col("u")), F.col("n0"), F.col("n1"))
    return s.withColumns({"__small": small, "__large": normal_p(F.col("z"))}).select(
        "variable", F.lit("wilcoxon").alias("test"), F.col("u").alias("statistic"), F.lit(None).cast("int").alias("df"),
        F.when(exact, F.col("__small")).otherwise(F.col("__large")).alias("p_value"))


def group_tests(df: DataFrame, variables: Sequence[str], by: str, kinds: Mapping[str, str] | None = None,
                groups: Sequence[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """One test per variable: ``variable, test, statistic, df, p_value, low_expected, significant``."""
    kind = _kinds(df, variables, kinds)
    names = _groups(df, by, groups)
    cats = [v for v in variables if kind[v] == "categorical"]
    nums = [v for v in variables if kind[v] == "continuous"]
    parts = []
    if cats:
        parts.append(chi_square(df, cats, by, names))
    if nums:
        parts.append(rank_tests(df, nums, by, names).withColumn("low_expected", F.lit(False)))
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("significant", F.col("p_value") < alpha)


# --- distributions ---------------------------------------------------------------------------------

def histogram(df: DataFrame, name: str, bins: int = 30) -> DataFrame:
    """``bin, low, high, n`` for equal-width bins between the extremes; the last bin includes the maximum."""
    x = col(name).cast("double")
    low, high = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    placed = df.where(x.isNotNull()).select(x.alias("__x"), low.alias("__low"), ((high - low) / bins).alias("__width"))
    at = F.when(F.col("__width") > 0, F.least(F.floor((F.col("__x") - F.col("__low")) / F.col("__width")) + 1, F.lit(bins))).otherwise(1)
    return placed.groupBy(at.cast("int").alias("bin"), "__low", "__width").agg(F.count(F.lit(1)).alias("n")).select(
        "bin", (F.col("__low") + (F.col("bin") - 1) * F.col("__width")).alias("low"),
        (F.col("__low") + F.col("bin") * F.col("__width")).alias("high"), "n")


def box_stats(df: DataFrame, name: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 interquartile ranges) and number of outliers per group."""
    keys = [col(b) for b in by]
    counts = df.where(col(name).isNotNull()).groupBy(*keys, col(name).cast("double").alias("__v")).agg(
        F.count(F.lit(1)).alias("__m"))
    q = quantiles_of_counts(counts, by, "__v", "__m", QUARTILES).withColumnRenamed("__n", "n")
    near = _fenced(counts, q, by)
    v, inside = F.col("__v"), F.col("__inside")
    ends = near.groupBy(*keys).agg(F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
                                   F.sum(F.when(inside, F.lit(0)).otherwise(F.col("__m"))).alias("n_outliers"))
    return join_ns(q, ends, list(by), "left")


def box_outliers(df: DataFrame, name: str, by: Sequence[str]) -> DataFrame:
    """Rows outside the whiskers of their group."""
    rows = df.where(col(name).isNotNull()).withColumn("__v", col(name).cast("double"))
    q = quantiles(rows, by, "__v", QUARTILES)
    return _fenced(rows, q, by).where(~F.col("__inside")).select(*[col(c) for c in df.columns])


def _fenced(rows: DataFrame, q: DataFrame, by: Sequence[str]) -> DataFrame:
    spread = 1.5 * (F.col("p75") - F.col("p25"))
    fences = q.select(*[col(b) for b in by], (F.col("p25") - spread).alias("__lo"), (F.col("p75") + spread).alias("__hi"))
    return join_ns(rows, fences, list(by), "left").withColumn("__inside", F.col("__v").between(F.col("__lo"), F.col("__hi")))
