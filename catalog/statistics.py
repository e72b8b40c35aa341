"""Survival statistics, summary tables, tests and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import longs, query, rounded
from vitaspan import (box_outliers, box_stats, by_frequency, cox, cox_models, cox_univariable, first_per_key, group_tests, header_counts,
                      histogram, kaplan_meier, level_counts, logrank, logrank_counts, median_survival, merge_tables,
                      null_if, quantiles, rank_sums, risk_table, summary_table)
from vitaspan.operators.tables import chi_square

# --- subjects --------------------------------------------------------------------------------------

_CUST = """first_order AS (SELECT o_custkey, min(o_orderdate) AS d0, max(o_orderdate) AS d1, min(CASE WHEN o_orderpriority = '1-URGENT' AND
        o_orderstatus = 'F' THEN o_orderdate END) AS du, min(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS pri, count(*) AS n_orders
        FROM orders GROUP BY 1),
    subjects AS (SELECT c_mktsegment, c_nationkey, c_acctbal, pri, n_orders, datediff('day', CAST(d0 AS DATE), CAST(coalesce(du, d1) AS DATE))::DOUBLE
        AS time, CASE WHEN du IS NULL THEN 0 ELSE 1 END AS event FROM first_order JOIN customer ON c_custkey = o_custkey)"""


def subjects(t):
    """Customers: days from the first order to the first urgent finished one, censored at the last order."""
    urgent = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), F.col("o_orderdate"))
    per = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("d0"), F.max("o_orderdate").alias("d1"), F.min(urgent).alias("du"),
        F.min(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))).alias("pri"), F.count(F.lit(1)).alias("n_orders"))
    end = F.coalesce("du", "d1")
    return per.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_mktsegment", "c_nationkey", "c_acctbal", "pri", "n_orders", F.datediff(end, "d0").cast("double").alias("time"),
        F.col("du").isNotNull().cast("int").alias("event"))


_ITEMS = """items AS (SELECT l_linestatus, l_returnflag, l_quantity AS time, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS event,
    CASE WHEN l_tax < 0.03 THEN 'low' WHEN l_tax < 0.06 THEN 'mid' ELSE 'high' END AS band, l_discount, l_tax FROM lineitem)"""


def items(t):
    """Line items: quantity as a time with many ties, returned as the event."""
    band = F.when(F.col("l_tax") < 0.03, "low").when(F.col("l_tax") < 0.06, "mid").otherwise("high")
    return t.lineitem.select("l_linestatus", "l_returnflag", F.col("l_quantity").alias("time"),
                             (F.col("l_returnflag") == "R").cast("int").alias("event"), band.alias("band"), "l_discount", "l_tax")


def _km(source: str, keys: list[str]) -> str:
    """Curve in SQL: risk set from the reverse running count, survival as a running product."""
    k = ", ".join(keys)
    part = f"PARTITION BY {k}" if keys else ""
    lead = f"{k}, " if keys else ""
    return f"""c AS (SELECT {lead}time, count(*) AS n, sum(event)::BIGINT AS n_event FROM {source} WHERE time IS NOT NULL
            {''.join(f' AND {x} IS NOT NULL' for x in keys)} GROUP BY ALL),
        r AS (SELECT *, sum(n) OVER ({part} ORDER BY time DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS n_risk FROM c),
        km AS (SELECT {lead}time, n_risk, n_event, n - n_event AS n_censored, product(1 - n_event / n_risk) OVER w AS surv, sum(CASE WHEN n_event < n_risk
            THEN n_event / (n_risk::DOUBLE * (n_risk - n_event)) ELSE 0 END) OVER w AS v FROM r WINDOW w AS ({part} ORDER BY time ROWS UNBOUNDED
            PRECEDING))"""


@query(f"WITH {_CUST}, {_km('subjects', ['c_mktsegment'])} SELECT * EXCLUDE (v) REPLACE (round(surv, 6) AS surv) FROM km")
def customer_km(t):
    return rounded(kaplan_meier(subjects(t), "time", "event", ["c_mktsegment"]))


@query(f"WITH {_ITEMS}, {_km('items', ['l_linestatus'])} SELECT * EXCLUDE (v) REPLACE (round(surv, 6) AS surv) FROM km")
def km_by_group(t):
    return rounded(kaplan_meier(items(t), "time", "event", ["l_linestatus"]))


@query(f"""WITH {_CUST}, {_km('subjects', ['pri'])} SELECT pri, time, n_risk, n_event, n_censored, round(surv, 6) AS surv, CASE WHEN surv > 0 THEN
    round(surv * sqrt(v), 6) END AS std_err, CASE WHEN surv > 0 THEN round(surv * exp(-1.959963984540054 * sqrt(v)), 6) END AS lower, CASE WHEN
    surv > 0 THEN round(least(1.0, surv * exp(1.959963984540054 * sqrt(v))), 6) END AS upper FROM km""")
def km_greenwood(t):
    """Curve with its band; customers without a priority are not in any stratum."""
    return rounded(kaplan_meier(subjects(t), "time", "event", ["pri"], conf=True))


@query(f"WITH {_ITEMS}, {_km('items', ['band', 'l_linestatus'])} SELECT * EXCLUDE (v) REPLACE (round(surv, 6) AS surv) FROM km")
def km_by_slice(t):
    """The same curves for every slice of the cohort in one run."""
    return rounded(kaplan_meier(items(t), "time", "event", ["l_linestatus"], ["band"]))


@query(f"""WITH {_CUST}, {_km('subjects', ['c_mktsegment'])} SELECT c_mktsegment, min(CASE WHEN surv <= 0.5 THEN time END) AS median FROM km GROUP BY 1""")
def median_survival_by_group(t):
    return median_survival(kaplan_meier(subjects(t), "time", "event", ["c_mktsegment"]), ["c_mktsegment"])


@query(f"WITH {_CUST} " + " UNION ALL ".join(
    f"SELECT c_mktsegment, {b}::DOUBLE AS at, count(*) FILTER (time >= {b}) AS n_risk, coalesce(sum(event) FILTER (time < {b}), 0)::BIGINT AS "
    "events_before FROM subjects GROUP BY 1" for b in (0, 500, 1000, 1500, 2000)))
def risk_table_at_breaks(t):
    return risk_table(subjects(t), "time", "event", [0, 500, 1000, 1500, 2000], ["c_mktsegment"])


def _logrank(source: str, group: str, slices: list[str]) -> str:
    """Observed, expected and variance per group: every group is present at every event time of its slice."""
    s = "".join(f"{x}, " for x in slices)
    on = " AND ".join(["true", *[f"a.{x} = b.{x}" for x in slices]])
    same = "".join(f" AND b.{x} = i.{x}" for x in slices)
    return f"""ev AS (SELECT {s}time, sum(event) AS d FROM {source} GROUP BY ALL HAVING sum(event) > 0),
        gr AS (SELECT DISTINCT {s}{group} FROM {source}),
        grid AS (SELECT a.*, b.{group} FROM ev a JOIN gr b ON {on}),
        cell AS (SELECT {', '.join([f'b.{x}' for x in slices] + [f'b.{group}', 'b.time', 'b.d'])}, count(i.time) AS ng FROM grid b LEFT JOIN {source} i ON
            i.{group} = b.{group} AND i.time >= b.time{same} GROUP BY ALL),
        tot AS (SELECT *, sum(ng) OVER (PARTITION BY {s}time) AS n FROM cell)"""


@query(f"""WITH {_ITEMS}, {_logrank('items', 'l_linestatus', [])}, obs AS (SELECT l_linestatus, count(*) AS n, sum(event)::BIGINT AS observed FROM items GROUP BY 1)
    SELECT l_linestatus, obs.n, observed, round(sum(d * ng / tot.n), 6) AS expected, round(sum(CASE WHEN tot.n > 1 THEN d * (tot.n - d) / (tot.n - 1) *
    (ng / tot.n) * (1 - ng / tot.n) ELSE 0 END), 6) AS variance FROM tot JOIN obs USING (l_linestatus) GROUP BY ALL""")
def logrank_two_group(t):
    return rounded(logrank_counts(items(t), "time", "event", "l_linestatus"))


@query(f"""WITH {_ITEMS}, {_logrank('items', 'l_linestatus', ['band'])}, one AS (SELECT band, sum(d * ng / n) AS e, sum(CASE WHEN n > 1 THEN d * (n - d) /
    (n - 1) * (ng / n) * (1 - ng / n) ELSE 0 END) AS v FROM tot WHERE l_linestatus = 'F' GROUP BY 1), o AS (SELECT band, sum(event) AS o FROM items WHERE
    l_linestatus = 'F' GROUP BY 1) SELECT band, round((o - e) * (o - e) / v, 6) AS statistic, 1 AS df FROM one JOIN o USING (band)""")
def logrank_by_slice(t):
    return rounded(logrank(items(t), "time", "event", "l_linestatus", ["band"]).drop("p_value"))


@query(f"""WITH {_ITEMS}, {_logrank('items', 'band', [])}, w AS (SELECT time, any_value(d) AS d, any_value(n) AS n, max(CASE band WHEN 'high' THEN ng END) AS a,
        max(CASE band WHEN 'low' THEN ng END) AS b FROM tot GROUP BY 1),
    v AS (SELECT sum(d * a / n) AS ea, sum(d * b / n) AS eb, sum(k * (a / n) * (1 - a / n)) AS vaa, sum(k * (b / n) * (1 - b / n)) AS vbb,
        sum(-k * (a / n) * (b / n)) AS vab FROM (SELECT *, CASE WHEN n > 1 THEN d * (n - d) / (n - 1) ELSE 0 END AS k FROM w)),
    o AS (SELECT sum(event) FILTER (band = 'high') AS oa, sum(event) FILTER (band = 'low') AS ob FROM items),
    z AS (SELECT (vbb * (oa - ea) ^ 2 - 2 * vab * (oa - ea) * (ob - eb) + vaa * (ob - eb) ^ 2) / (vaa * vbb - vab ^ 2) AS x FROM v, o)
    SELECT round(x, 6) AS statistic, 2 AS df, round(exp(-x / 2), 6) AS p_value FROM z""")
def logrank_three_groups(t):
    """With two degrees of freedom the p-value has a closed form in SQL too."""
    return rounded(logrank(items(t), "time", "event", "band"))


def _p(x: str, df: str) -> str:
    """Upper tail of the chi-square distribution, from the series of the incomplete gamma function."""
    a, h = f"({df}) / 2.0", f"({x}) / 2.0"
    return (f"CASE WHEN ({x}) <= 0 THEN 1.0 WHEN ({x}) > 1500 THEN 0.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 3000), lambda j: "
            f"exp(({a} + j) * ln({h}) - {h} - lgamma({a} + j + 1))))) END")


def _eliminated(n: int) -> str:
    """Steps that clear a bordered matrix m0(i, j, v) of its first n rows; what is left is -z' V^-1 z."""
    return ", ".join(f"""m{k} AS (SELECT a.i, a.j, a.v - b.v * c.v / p.v AS v FROM m{k - 1} a JOIN m{k - 1} b ON b.i = a.i AND b.j = {k} JOIN m{k - 1} c ON
        c.i = {k} AND c.j = a.j JOIN m{k - 1} p ON p.i = {k} AND p.j = {k} WHERE a.i <> {k} AND a.j <> {k})""" for k in range(1, n + 1))


@query(f"""WITH {_CUST}, {_logrank('subjects', 'c_mktsegment', [])}, named AS (SELECT c_mktsegment AS g, row_number() OVER (ORDER BY c_mktsegment) AS i FROM
        (SELECT DISTINCT c_mktsegment FROM subjects)),
    cell2 AS (SELECT time, i, d, n, ng, CASE WHEN n > 1 THEN d * (n - d) / (n - 1) ELSE 0 END AS k FROM tot JOIN named ON g = c_mktsegment),
    v AS (SELECT a.i, b.i AS j, sum(a.k * (a.ng / a.n) * (CASE WHEN a.i = b.i THEN 1 ELSE 0 END - b.ng / b.n)) AS v FROM cell2 a JOIN cell2 b USING (time)
        WHERE a.i < 5 AND b.i < 5 GROUP BY ALL),
    z AS (SELECT i, (SELECT sum(event) FROM subjects JOIN named ON g = c_mktsegment WHERE named.i = cell2.i) - sum(d * ng / n) AS v FROM cell2 WHERE i < 5 GROUP BY i),
    m0 AS (SELECT i, j, v FROM v UNION ALL SELECT i, 5, v FROM z UNION ALL SELECT 5, i, v FROM z UNION ALL SELECT 5, 5, 0), {_eliminated(4)}
    SELECT round(-v, 6) AS statistic, 4 AS df, round({_p('-v', '4')}, 6) AS p_value FROM m4""")
def logrank_segments(t):
    """Five groups with p-value."""
    return rounded(logrank(subjects(t), "time", "event", "c_mktsegment"))


@query(f"""WITH {_ITEMS} SELECT l_linestatus, 'l_returnflag' AS variable, l_returnflag AS level, count(*) AS n, sum(event)::BIGINT AS n_event FROM items
    GROUP BY ALL UNION ALL SELECT l_linestatus, 'band', band, count(*), sum(event)::BIGINT FROM items GROUP BY ALL""")
def events_by_level(t):
    return level_counts(items(t), "event", ["l_returnflag", "band"], ["l_linestatus"])


# --- regression ------------------------------------------------------------------------------------

_COX = ["model", "term", "level", "n", "n_event", "log_hr", "se", "hr", "lo", "hi", "p_value", "significant"]
_FITTED = """round(b, 6) AS log_hr, round(s, 6) AS se, round(exp(b), 6) AS hr, round(exp(b - 1.959963984540054 * s), 6) AS lo, round(exp(b +
    1.959963984540054 * s), 6) AS hi, round({p}, 6) AS p_value, {p} < 0.05 AS significant"""


def _newton(tag: str, source: str, key: str, xs: list[str], steps: int) -> str:
    """Newton's method in SQL: moments of the risk sets by time, Efron's ties expanded row by row, Gauss-Jordan elimination.

    The last CTE, ``{tag}_fit(key, j, b, s)``, has estimate and standard error of every covariate.
    """
    p = len(xs)
    one, two = range(1, p + 1), [(j, k) for j in range(1, p + 1) for k in range(j, p + 1)]
    moments = {"0": "1", **{f"{j}": f"x{j}" for j in one}, **{f"{j}_{k}": f"x{j} * x{k}" for j, k in two}}
    names = ", ".join(f"x{j}" for j in one)
    out = [f"{tag}c AS MATERIALIZED (SELECT {key} AS key, time, event, " + ", ".join(f"({x})::DOUBLE AS x{j}" for j, x in zip(one, xs))
           + f", count(*)::DOUBLE AS n FROM {source} GROUP BY ALL)",
           f"{tag}m AS (SELECT key, " + ", ".join(f"sum(n * x{j}) / sum(n) AS x{j}" for j in one) + f" FROM {tag}c GROUP BY 1)",
           f"{tag}z AS MATERIALIZED (SELECT c.key, time, event, n, " + ", ".join(f"c.x{j} - m.x{j} AS x{j}" for j in one) + f" FROM {tag}c c JOIN {tag}m m "
           "USING (key))",
           f"{tag}b0 AS (SELECT key, " + ", ".join(f"0.0::DOUBLE AS b{j}" for j in one) + f" FROM {tag}m)"]
    for i in range(steps):
        t = f"{tag}{i}"
        linear = " + ".join(f"b{j} * x{j}" for j in one)
        out.append(f"{t}w AS (SELECT z.key, time, event, n, {names}, n * exp({linear}) AS w FROM {tag}z z JOIN {tag}b{i} USING (key))")
        out.append(f"{t}t AS (SELECT key, time, " + ", ".join(f"sum(w * {e}) AS a{m}, sum(w * {e} * event) AS e{m}" for m, e in moments.items())
                   + ", sum(n * event) AS d, " + ", ".join(f"sum(n * event * x{j}) AS g{j}" for j in one) + f" FROM {t}w GROUP BY ALL)")
        out.append(f"{t}r AS (SELECT *, " + ", ".join(f"sum(a{m}) OVER (PARTITION BY key ORDER BY time DESC ROWS UNBOUNDED PRECEDING) AS s{m}" for m in moments)
                   + f" FROM {t}t)")
        out.append(f"{t}l AS (SELECT *, unnest(range(d::BIGINT)) / d AS u FROM {t}r WHERE d > 0)")
        out.append(f"{t}v AS (SELECT key, d, " + ", ".join(f"g{j}" for j in one) + ", " + ", ".join(f"s{m} - u * e{m} AS v{m}" for m in moments) + f" FROM {t}l)")
        cells = [(j, k, f"sum(v{j}_{k} / v0 - v{j} * v{k} / (v0 * v0))") for j, k in two]
        cells = cells + [(k, j, e) for j, k, e in cells if j != k] + [(j, p + 1, f"sum(g{j} / d - v{j} / v0)") for j in one]
        if i == steps - 1:
            cells += [(j, p + 1 + k, "1.0" if j == k else "0.0") for j in one for k in one]
        out.append(f"{t}m0 AS MATERIALIZED (SELECT key, unnest([{', '.join(str(x[0]) for x in cells)}]) AS i, unnest([{', '.join(str(x[1]) for x in cells)}]) AS j, "
                   f"unnest([{', '.join(x[2] for x in cells)}]) AS v FROM {t}v GROUP BY key)")
        for k in one:
            m = f"{t}m{k - 1}"
            out.append(f"{t}m{k} AS MATERIALIZED (SELECT a.key, a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v FROM {m} a JOIN "
                       f"{m} p ON p.key = a.key AND p.i = {k} AND p.j = {k} JOIN {m} c ON c.key = a.key AND c.i = a.i AND c.j = {k} JOIN {m} r ON r.key = a.key "
                       f"AND r.i = {k} AND r.j = a.j)")
        out.append(f"{tag}b{i + 1} AS MATERIALIZED (SELECT key, " + ", ".join(f"any_value(b{j}) + max(v) FILTER (i = {j}) AS b{j}" for j in one)
                   + f" FROM {t}m{p} JOIN {tag}b{i} USING (key) WHERE j = {p + 1} GROUP BY key)")
    last = f"{tag}{steps - 1}m{p}"
    out.append(f"{tag}_fit AS (SELECT b.key, v.i AS j, [{', '.join(f'b{j}' for j in one)}][v.i] AS b, sqrt(v.v) AS s FROM {tag}b{steps} b JOIN {last} v ON v.key = "
               f"b.key AND v.j = {p + 1} + v.i)")
    return ", ".join(out)


def _cox_sql(with_: str, source: str, models: dict[str, dict[str, list[str] | str]], slice: str | None = None, steps: int = 7) -> str:
    """All models over their complete rows. A term is an expression, or the list of its levels, of which the first is the reference."""
    ctes, selects = [], []
    key = slice or "'all'"
    lead = f"key AS {slice}, " if slice else ""
    for m, (name, terms) in enumerate(models.items()):
        tag = f"q{m}"
        whole = " AND ".join(f"({t if isinstance(x, list) else x}) IS NOT NULL" for t, x in terms.items())
        rows, xs = f"(SELECT * FROM {source} WHERE {whole})", []
        for t, x in terms.items():
            first = len(xs)
            xs += [f"CASE WHEN {t} = '{level}' THEN 1 ELSE 0 END" for level in x[1:]] if isinstance(x, list) else [x]
            kept = "count(*) AS n, sum(event)::BIGINT AS n_event"
            if isinstance(x, list):
                places = "CASE l " + " ".join(f"WHEN '{level}' THEN {first + k}" for k, level in enumerate(x[1:], 1)) + " END"
                selects.append(f"SELECT {lead}'{name}' AS model, '{t}' AS term, l AS level, n, n_event, {_FITTED} FROM (SELECT {key} AS key, {t} AS l, {kept} FROM {rows} "
                               f"GROUP BY ALL) c LEFT JOIN {tag}_fit f USING (key) WHERE f.j = {places} UNION ALL SELECT {lead}'{name}', '{t}', l, n, n_event, NULL, "
                               f"NULL, NULL, NULL, NULL, NULL, NULL FROM (SELECT {key} AS key, {t} AS l, {kept} FROM {rows} GROUP BY ALL) WHERE l = '{x[0]}'")
            else:
                selects.append(f"SELECT {lead}'{name}' AS model, '{t}' AS term, NULL::VARCHAR AS level, n, n_event, {_FITTED} FROM (SELECT {key} AS key, {kept} FROM {rows} "
                               f"GROUP BY ALL) c JOIN {tag}_fit f USING (key) WHERE f.j = {first + 1}")
        ctes.append(_newton(tag, rows, key, xs, steps))
    return f"WITH {with_}, {', '.join(ctes)} " + " UNION ALL ".join(selects).replace("{p}", f"({_p('b * b / (s * s)', '1')})")


_GROUPED = f"""{_CUST}, grouped AS (SELECT * REPLACE (CASE WHEN pri IN ('1-URGENT', '2-HIGH') THEN substr(pri, 3) WHEN pri IS NOT NULL THEN 'OTHER' END AS pri)
    FROM subjects)"""
_PRIORITIES = ["HIGH", "OTHER", "URGENT"]
_MARKETS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _grouped(t):
    """Subjects with three groups of priorities, each with events at every scale."""
    pri = F.when(F.col("pri").isin("1-URGENT", "2-HIGH"), F.substring("pri", 3, 10)).when(F.col("pri").isNotNull(), "OTHER")
    return subjects(t).withColumns({"pri": pri, "balance": F.col("c_acctbal") / 1000})


@query(_cox_sql(_ITEMS, "items", {"multivariable": {"l_linestatus": ["F", "O"], "band": ["low", "mid", "high"], "l_discount": "l_discount"}}))
def cox_multivariable(t):
    return rounded(cox(items(t), "time", "event", ["l_linestatus", "band", "l_discount"], levels={"band": ["low", "mid", "high"]}).select(*_COX))


@query(_cox_sql(_GROUPED, "grouped", {"c_mktsegment": {"c_mktsegment": _MARKETS}, "pri": {"pri": _PRIORITIES}, "balance": {"balance": "c_acctbal / 1000"}}))
def cox_univariable_set(t):
    """One model per covariate, all fitted in the same passes; rows without a priority drop out of that model only."""
    return rounded(cox_univariable(_grouped(t), "time", "event", ["c_mktsegment", "pri", "balance"]).select(*_COX))


@query(_cox_sql(_ITEMS, "items", {"multivariable": {"l_linestatus": ["F", "O"], "tax_percent": "100 * l_tax"}}, slice="band"))
def cox_by_slice(t):
    df = items(t).withColumn("tax_percent", 100 * F.col("l_tax"))
    return rounded(cox(df, "time", "event", ["l_linestatus", "tax_percent"], ["band"]).select("band", *_COX))


@query(_cox_sql(_GROUPED, "grouped", {"full": {"c_mktsegment": _MARKETS, "pri": _PRIORITIES, "balance": "c_acctbal / 1000"},
                                      "reduced": {"pri": _PRIORITIES, "balance": "c_acctbal / 1000"}}))
def cox_reduced_models(t):
    """Full and reduced models side by side."""
    return rounded(cox_models(_grouped(t), "time", "event", {"full": ["c_mktsegment", "pri", "balance"], "reduced": ["pri", "balance"]}).select(*_COX))


def _cox_pair_sql(source: str, key: str, x1: str, x2: str, steps: int = 6) -> str:
    """Newton's method for two covariates written out in SQL, with Efron's ties expanded row by row."""
    out = [f"cb AS (SELECT {key}, time, event, ({x1})::DOUBLE AS x1, ({x2})::DOUBLE AS x2, count(*)::DOUBLE AS n FROM {source} GROUP BY ALL)",
           f"be0 AS (SELECT DISTINCT {key}, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM cb)"]
    pairs = ("11", "12", "22")
    moment = {"0": "1", "1": "x1", "2": "x2", "11": "x1 * x1", "12": "x1 * x2", "22": "x2 * x2"}
    for i in range(steps):
        out.append(f"w{i} AS (SELECT cb.*, n * exp(b1 * x1 + b2 * x2) AS w FROM cb JOIN be{i} USING ({key}))")
        out.append(f"t{i} AS (SELECT {key}, time, " + ", ".join(f"sum(w * {e}) AS a{m}, sum(w * {e} * event) AS e{m}" for m, e in moment.items())
                   + f", sum(n * event) AS d, sum(n * event * x1) AS g1, sum(n * event * x2) AS g2 FROM w{i} GROUP BY ALL)")
        out.append(f"r{i} AS (SELECT *, " + ", ".join(f"sum(a{m}) OVER (PARTITION BY {key} ORDER BY time DESC ROWS UNBOUNDED PRECEDING) AS s{m}"
                                                      for m in moment) + f" FROM t{i})")
        out.append(f"l{i} AS (SELECT *, unnest(range(d::BIGINT)) / d AS u FROM r{i} WHERE d > 0)")
        out.append(f"v{i} AS (SELECT {key}, d, g1, g2, " + ", ".join(f"s{m} - u * e{m} AS v{m}" for m in moment) + f" FROM l{i})")
        out.append(f"h{i} AS (SELECT {key}, sum(g1 / d - v1 / v0) AS u1, sum(g2 / d - v2 / v0) AS u2, "
                   + ", ".join(f"sum(v{p} / v0 - v{p[0]} * v{p[1]} / (v0 * v0)) AS i{p}" for p in pairs) + f" FROM v{i} GROUP BY 1)")
        out.append(f"be{i + 1} AS (SELECT {key}, b1 + (i22 * u1 - i12 * u2) / (i11 * i22 - i12 * i12) AS b1, b2 + (i11 * u2 - i12 * u1) / "
                   f"(i11 * i22 - i12 * i12) AS b2 FROM be{i} JOIN h{i} USING ({key}))")
    last = f"h{steps - 1}"
    out.append(f"""fitted AS (SELECT {key}, unnest(['x1', 'x2']) AS x, unnest([b1, b2]) AS b, unnest([sqrt(i22 / (i11 * i22 - i12 * i12)), sqrt(i11 / (i11 * i22 -
        i12 * i12))]) AS s FROM be{steps} JOIN {last} USING ({key}))""")
    return ", ".join(out)


_ESTIMATE = f"""round(b, 4) AS log_hr, round(s, 4) AS se, round(exp(b), 4) AS hr, round(exp(b - 1.959963984540054 * s), 4) AS lo,
    round(exp(b + 1.959963984540054 * s), 4) AS hi, round({_p('b * b / (s * s)', '1')}, 4) AS p_value"""


def _estimates(df, *keys):
    return df.where("hr is not null").select(*keys, *[F.round(x, 4).alias(x) for x in ("log_hr", "se", "hr", "lo", "hi", "p_value")])


@query(f"""WITH {_ITEMS}, {_cox_pair_sql('items', 'band', "l_linestatus = 'O'", '100 * l_tax')}, n AS (SELECT band, count(*) AS n, sum(event)::BIGINT AS e, count(*) FILTER
    (l_linestatus = 'O') AS no, (sum(event) FILTER (l_linestatus = 'O'))::BIGINT AS eo FROM items GROUP BY 1) SELECT band, CASE x WHEN 'x1' THEN 'l_linestatus'
    ELSE 'tax_percent' END AS term, CASE x WHEN 'x1' THEN no ELSE n END AS n, CASE x WHEN 'x1' THEN eo ELSE e END AS n_event, {_ESTIMATE} FROM fitted JOIN n USING
    (band)""")
def cox_estimates_by_slice(t):
    """Two covariates in every slice, against Newton's method in SQL."""
    df = items(t).withColumn("tax_percent", 100 * F.col("l_tax"))
    return _estimates(cox(df, "time", "event", ["l_linestatus", "tax_percent"], ["band"]), "band", "term", "n", "n_event")


@query(f"""WITH {_CUST}, one AS (SELECT *, 'all' AS k FROM subjects WHERE c_acctbal > 0), {_cox_pair_sql('one', 'k', 'c_acctbal / 1000', 'n_orders')}
    SELECT CASE x WHEN 'x1' THEN 'balance' ELSE 'n_orders' END AS term, {_ESTIMATE} FROM fitted""")
def cox_estimates_multivariable(t):
    """Days to the first urgent finished order; customers without a positive balance are not complete."""
    df = subjects(t).withColumn("balance", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 1000))
    return _estimates(cox(df, "time", "event", ["balance", "n_orders"]), "term")


# --- summary tables --------------------------------------------------------------------------------

def _patients(t):
    """Customers with some unknown answers."""
    s = subjects(t)
    return s.select("c_mktsegment", "pri", "n_orders", null_if("c_nationkey", 7).alias("nation"),
                    F.when(F.col("event") == 1, "Yes").otherwise("No").alias("ever"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
                    F.when(F.col("c_acctbal") > 9000, None).when(F.col("c_acctbal") > 4000, "high").otherwise("low").alias("g"))


_PATIENTS = f"""WITH {_CUST}, p AS (SELECT c_mktsegment, pri, n_orders, nullif(c_nationkey, 7) AS nation, CASE WHEN event = 1 THEN 'Yes' ELSE 'No' END AS ever,
    CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance, CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal > 4000 THEN 'high' ELSE 'low' END AS g
    FROM subjects)"""


def _table(groups: dict[str, str], cats: list[str], nums: list[str]) -> str:
    """Summary table in SQL; ``groups``: label -> condition."""
    parts = []
    for g, cond in groups.items():
        for v in cats:
            parts.append(f"""SELECT '{v}' AS variable, 'categorical' AS kind, CAST(l AS VARCHAR) AS level, '{g}' AS "group", u.stat, u.value FROM (SELECT l, count(x)
                FILTER (x IS NOT NULL) AS n, sum(count(x)) OVER () AS total FROM (SELECT DISTINCT {v} AS l FROM p WHERE ({' OR '.join(
                    groups.values())}) AND {v} IS NOT NULL) LEFT JOIN (SELECT {v} AS x FROM p WHERE {cond}) ON x = l GROUP BY l), LATERAL (SELECT unnest(['n', 'p'])
                AS stat, unnest([n::DOUBLE, CASE WHEN total > 0 THEN 100.0 * n / total END]) AS value) u""")
            parts.append(f"SELECT '{v}', 'categorical', NULL, '{g}', 'missing', (count(*) - count({v}))::DOUBLE FROM p WHERE {cond}")
        for v in nums:
            parts.append(f"""SELECT '{v}', 'continuous', NULL, '{g}', u.stat, u.value FROM (SELECT quantile_cont({v}::DOUBLE, [0.25, 0.5, 0.75]) AS q, count(*) -
                count({v}) AS m FROM p WHERE {cond}), LATERAL (SELECT unnest(['p25', 'median', 'p75', 'missing']) AS stat, unnest([q[1], q[2], q[3],
                m::DOUBLE]) AS value) u""")
    return " UNION ALL ".join(parts)


@query(f"{_PATIENTS}, s AS ({_table({'Overall': 'true'}, ['c_mktsegment', 'pri', 'ever', 'nation'], ['n_orders', 'balance'])}) SELECT * REPLACE (round(value, 6) AS "
       "value) FROM s")
def table1_overall(t):
    """Numbers are continuous unless declared categorical; yes/no answers show both levels."""
    return rounded(summary_table(_patients(t), ["c_mktsegment", "pri", "ever", "n_orders", "balance", "nation"], kinds={"nation": "categorical"}))


_BY = {"high": "g = 'high'", "low": "g = 'low'"}


@query(f"{_PATIENTS}, s AS ({_table(_BY, ['c_mktsegment', 'pri', 'ever'], ['n_orders', 'balance'])}) SELECT * REPLACE (round(value, 6) AS value) FROM s")
def table1_by_group(t):
    """Rows without a group are not part of the table."""
    return rounded(summary_table(_patients(t), ["c_mktsegment", "pri", "ever", "n_orders", "balance"], by="g"))


@query(f"{_PATIENTS}, s AS ({_table({**_BY, 'Overall': 'g IS NOT NULL'}, ['pri', 'ever'], ['balance'])}) SELECT * REPLACE (round(value, CASE WHEN variable = 'balance'"
       " THEN 1 ELSE 6 END) AS value) FROM s")
def table1_with_overall(t):
    return rounded(summary_table(_patients(t), ["pri", "ever", "balance"], by="g", overall=True, digits={"balance": 1}))


@query(f"""{_PATIENTS}, n AS (SELECT 'pri' AS variable, pri AS level, count(*)::DOUBLE AS n FROM p WHERE pri IS NOT NULL GROUP BY ALL UNION ALL SELECT 'c_mktsegment',
    c_mktsegment, count(*)::DOUBLE FROM p GROUP BY ALL) SELECT variable, level, n, row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) AS place
    FROM n""")
def levels_by_frequency(t):
    table = by_frequency(summary_table(_patients(t), ["c_mktsegment", "pri"]))
    return longs(table.where("stat = 'n'").select("variable", "level", F.col("value").alias("n"), "place"), "place")


@query(f'{_PATIENTS} SELECT g AS "group", count(*) AS n FROM p WHERE g IS NOT NULL GROUP BY 1 UNION ALL SELECT \'Overall\', count(g) FROM p')
def table_header_counts(t):
    return header_counts(_patients(t), "g", overall=True)


_TABLES = {"a": "c_mktsegment IN ('BUILDING', 'MACHINERY')", "b": "c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')"}


@query(f"{_PATIENTS}, " + ", ".join(
    f"{k} AS (SELECT c_mktsegment AS level, count(*) AS n, count(pri) AS known FROM p WHERE {cond} OR nation = 3 GROUP BY 1)" for k, cond in _TABLES.items())
    + " SELECT coalesce(a.level, b.level) AS level, a.n AS a_n, a.known AS a_known, b.n AS b_n, b.known AS b_known FROM a FULL JOIN b ON a.level = b.level")
def merged_tables(t):
    p = _patients(t)
    parts = {k: p.where(f"{cond} or nation = 3").groupBy(F.col("c_mktsegment").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.count("pri").alias("known")) for k, cond in _TABLES.items()}
    return merge_tables(parts, ["level"])


# --- tests -----------------------------------------------------------------------------------------

def _chi(variable: str) -> str:
    return f"""(SELECT sum((n - e) ^ 2 / e) AS x, bool_or(e < 5) AS low, (count(DISTINCT l) - 1) * (count(DISTINCT g) - 1) AS df FROM (SELECT l, g, n, sum(n) OVER
        (PARTITION BY l) * sum(n) OVER (PARTITION BY g) / sum(n) OVER () AS e FROM (SELECT l, g, count(x.l2) AS n FROM (SELECT DISTINCT {variable} AS l FROM p WHERE
        g IS NOT NULL AND {variable} IS NOT NULL) CROSS JOIN (SELECT DISTINCT g FROM p WHERE g IS NOT NULL) LEFT JOIN (SELECT {variable} AS l2, g AS g2 FROM p) x
        ON l = l2 AND g = g2 GROUP BY ALL)))"""


@query(f"{_PATIENTS} " + " UNION ALL ".join(f"SELECT '{v}' AS variable, round(x, 6) AS statistic, df::INT AS df, low AS low_expected FROM {_chi(v)}"
                                            for v in ("c_mktsegment", "pri", "ever")))
def chi_square_stat(t):
    return rounded(chi_square(_patients(t), ["c_mktsegment", "pri", "ever"], "g").drop("test", "p_value"))


def _fisher(name: str, counts: str, levels: int, groups: int) -> str:
    """Exact test in SQL: every table with the margins of ``counts`` (l, g0, g1, ...), if its flag ``low`` is set."""
    free = [(i, j) for i in range(1, levels) for j in range(1, groups)]
    source = f"{name}m"
    for i, j in free:
        source = f"(SELECT *, unnest(range(0, least(r{i}, c{j}) + 1)) AS x{i}_{j} FROM {source})"
    cell = {(i, j): f"x{i}_{j}" for i, j in free}
    for i in range(1, levels):
        cell[i, groups] = f"(r{i} - " + " - ".join(f"x{i}_{j}" for j in range(1, groups)) + ")"
    for j in range(1, groups):
        cell[levels, j] = f"(c{j} - " + " - ".join(f"x{i}_{j}" for i in range(1, levels)) + ")"
    cell[levels, groups] = f"(r{levels} - " + " - ".join(cell[levels, j] for j in range(1, groups)) + ")"
    rows = ", ".join(f"coalesce(list_sum(m[{i}]), 0)::BIGINT AS r{i}" for i in range(1, levels + 1))
    columns = ", ".join(f"list_sum([" + ", ".join(f"coalesce(m[{i}][{j}], 0)" for i in range(1, levels + 1)) + f"])::BIGINT AS c{j}" for j in range(1, groups + 1))
    seen = " + ".join(f"lgamma(coalesce(m[{i}][{j}], 0) + 1)" for i in range(1, levels + 1) for j in range(1, groups + 1))
    return f"""{name}l AS (SELECT list([{', '.join(f'g{j}' for j in range(groups))}] ORDER BY l) AS m, bool_or(low) AS low FROM {counts}),
        {name}m AS (SELECT *, {rows}, {columns}, {seen} AS seen FROM {name}l WHERE low),
        {name}t AS (SELECT seen, {' + '.join(f'lgamma({x} + 1)' for x in cell.values())} AS w FROM {source} WHERE {' AND '.join(f'{x} >= 0' for x in cell.values())}),
        {name} AS (SELECT sum(exp(seen - w)) FILTER (w >= seen - 1e-7) / sum(exp(seen - w)) AS p FROM {name}t)"""


def _two_groups(v: str) -> str:
    return f"""(SELECT *, bool_or(least(r * c0, r * c1) / n < 5) OVER () AS low FROM (SELECT {v} AS l, count(*) FILTER (g = 'high') AS g0, count(*) FILTER (g = 'low') AS g1, count(*)
        AS r, sum(count(*) FILTER (g = 'high')) OVER () AS c0, sum(count(*) FILTER (g = 'low')) OVER () AS c1, sum(count(*)) OVER () AS n FROM p WHERE g IS NOT NULL AND
        {v} IS NOT NULL GROUP BY 1))"""


def _ranks(v: str) -> str:
    return f"""SELECT '{v}' AS variable, g, rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2 AS mid, count(*) OVER (PARTITION BY {v}) AS c FROM p
        WHERE {v} IS NOT NULL AND g IS NOT NULL"""


_RANKED = f"""{_PATIENTS}, k AS ({_ranks('n_orders')} UNION ALL {_ranks('balance')}),
    s AS (SELECT variable, count(*)::DOUBLE AS n, sum(mid) FILTER (g = 'high') AS r0, sum(mid) FILTER (g = 'low') AS r1, (count(*) FILTER (g = 'high'))::DOUBLE AS m0,
        (count(*) FILTER (g = 'low'))::DOUBLE AS m1, sum(c::DOUBLE * c - 1) AS ties FROM k GROUP BY 1)"""


@query(f"""{_RANKED} SELECT variable, round(r0, 6) AS rank_sum, round(r0 - m0 * (m0 + 1) / 2, 6) AS u, round((abs(r0 - m0 * (m0 + 1) / 2 - m0 * m1 / 2) - 0.5) *
    sign(r0 - m0 * (m0 + 1) / 2 - m0 * m1 / 2) / sqrt(m0 * m1 / 12 * (n + 1 - ties / (n * (n - 1)))), 6) AS z FROM s""")
def rank_sum_stat(t):
    return rounded(rank_sums(_patients(t), ["n_orders", "balance"], "g").select("variable", "rank_sum", "u", "z"))


@query(f"""{_RANKED} SELECT variable, n::BIGINT AS n, round((12 / (n * (n + 1)) * (r0 * r0 / m0 + r1 * r1 / m1) - 3 * (n + 1)) / (1 - ties / (n ^ 3 - n)), 6) AS kruskal,
    1 AS df FROM s""")
def kruskal_stat(t):
    return rounded(rank_sums(_patients(t), ["n_orders", "balance"], "g").select("variable", "n", "kruskal", "df"))


_CHI_ROWS = " UNION ALL ".join(f"SELECT '{v}' AS variable, x, df, low FROM {_chi(v)}" for v in ("c_mktsegment", "pri", "ever"))


_LEVELS = {"c_mktsegment": 5, "pri": 5, "ever": 2}


@query(f"""{_RANKED}, z AS (SELECT variable, r0 - m0 * (m0 + 1) / 2 AS u, (abs(r0 - m0 * (m0 + 1) / 2 - m0 * m1 / 2) - 0.5) / sqrt(m0 * m1 / 12 * (n + 1 - ties /
        (n * (n - 1)))) AS z FROM s), c AS ({_CHI_ROWS}), {', '.join(_fisher(f'f_{v}', _two_groups(v), n, 2) for v, n in _LEVELS.items())},
    e AS ({' UNION ALL '.join(f"SELECT '{v}' AS variable, p AS exact FROM f_{v}" for v in _LEVELS)}),
    t AS (SELECT variable, CASE WHEN low THEN 'fisher' ELSE 'chi-square' END AS test, x AS statistic, df::INT AS df, coalesce(exact, {_p('x', 'df')}) AS p, low AS
        low_expected FROM c JOIN e USING (variable) UNION ALL SELECT variable, 'wilcoxon', u, NULL, {_p('z * z', '1')}, false FROM z)
    SELECT variable, test, round(statistic, 6) AS statistic, df, round(p, 6) AS p_value, low_expected, p < 0.05 AS significant FROM t""")
def group_difference_tests(t):
    """Chosen test, p-value and significance per variable."""
    return rounded(group_tests(_patients(t), ["c_mktsegment", "pri", "ever", "n_orders", "balance"], "g"))


_RICHEST = """best AS (SELECT c_nationkey, arg_max(c_mktsegment, [c_acctbal, -c_custkey]) AS seg FROM customer GROUP BY 1),
    p AS (SELECT CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING') THEN 'a' WHEN seg = 'FURNITURE' THEN 'b' ELSE 'c' END AS kind, CASE WHEN r_name IN ('AFRICA', 'MIDDLE EAST')
        THEN 'south' WHEN r_name = 'AMERICA' THEN 'west' ELSE 'east' END AS area FROM best JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
    cells AS (SELECT *, true AS low FROM (SELECT kind AS l, count(*) FILTER (area = 'east') AS g0, count(*) FILTER (area = 'south') AS g1, count(*) FILTER (area = 'west') AS g2
        FROM p GROUP BY 1))"""


@query(f"""WITH {_RICHEST}, {_fisher('f', 'cells', 3, 3)}, x AS (SELECT sum((n - e) ^ 2 / e) AS x, bool_or(e < 5) AS low FROM (SELECT n, sum(n) OVER (PARTITION BY l) *
        sum(n) OVER (PARTITION BY g) / sum(n) OVER () AS e FROM (SELECT l, unnest([0, 1, 2]) AS g, unnest([g0, g1, g2]) AS n FROM cells)))
    SELECT 'kind' AS variable, 'fisher' AS test, round(x, 6) AS statistic, 4 AS df, round(p, 6) AS p_value, low AS low_expected FROM f, x""")
def exact_test_of_three_groups(t):
    """The richest customer of every nation: kind of business by area, a 3x3 table with low counts at every scale."""
    best = first_per_key(t.customer.select("c_nationkey", "c_mktsegment", "c_acctbal", "c_custkey"), ["c_nationkey"], ["-c_acctbal", "c_custkey"], ties=[])
    places = best.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    kind = F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "a").when(F.col("c_mktsegment") == "FURNITURE", "b").otherwise("c")
    area = F.when(F.col("r_name").isin("AFRICA", "MIDDLE EAST"), "south").when(F.col("r_name") == "AMERICA", "west").otherwise("east")
    return rounded(chi_square(places.select(kind.alias("kind"), area.alias("area")), ["kind"], "area"))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(f"""{_PATIENTS}, s AS ({_table({**{x: f"c_mktsegment = '{x}'" for x in _SEGMENTS}, 'Overall': 'c_mktsegment IS NOT NULL'}, ['pri'], ['balance'])}),
    q AS (SELECT pri, balance, c_mktsegment AS g FROM p), c AS (SELECT 'pri' AS variable, x, df FROM {_chi('pri').replace('FROM p', 'FROM q')}),
    r AS (SELECT g, rank() OVER (ORDER BY balance) + (count(*) OVER (PARTITION BY balance) - 1) / 2 AS mid, count(*) OVER (PARTITION BY balance) AS c FROM q
        WHERE balance IS NOT NULL AND g IS NOT NULL),
    rs AS (SELECT g, sum(mid) AS r, count(*)::DOUBLE AS m FROM r GROUP BY g), ra AS (SELECT count(*)::DOUBLE AS n, sum(c::DOUBLE * c - 1) AS ties FROM r),
    k AS (SELECT 'balance' AS variable, (12 / (n * (n + 1)) * (SELECT sum(r * r / m) FROM rs) - 3 * (n + 1)) / (1 - ties / (n ^ 3 - n)) AS x,
        (SELECT count(*) - 1 FROM rs) AS df FROM ra),
    t AS (SELECT variable, {_p('x', 'df')} AS p FROM (SELECT variable, x, df FROM c UNION ALL SELECT variable, x, df FROM k))
    SELECT s.* REPLACE (round(value, 6) AS value), round(p, 6) AS p_value, p < 0.05 AS significant FROM s JOIN t USING (variable)""")
def table1_with_tests(t):
    return rounded(summary_table(_patients(t), ["pri", "balance"], by="c_mktsegment", overall=True, tests=True))


# --- distributions ---------------------------------------------------------------------------------

@query("""WITH m AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 30 AS w FROM orders), b AS (SELECT least(floor((o_totalprice - lo) / w)
    + 1, 30)::INT AS bin, lo, w FROM orders, m) SELECT bin, round(lo + (bin - 1) * w, 6) AS low, round(lo + bin * w, 6) AS high, count(*) AS n FROM b GROUP BY ALL""")
def histogram_bins(t):
    return rounded(histogram(t.orders, "o_totalprice"))


_BOX = """q AS (SELECT k, kk, count(*) AS n, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS p75 FROM b GROUP BY ALL),
    f AS (SELECT b.*, n, p25, median, p75, v BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25) AS inside FROM b JOIN q ON b.k = q.k AND b.kk IS NOT
    DISTINCT FROM q.kk)"""


@query(f"""WITH b AS (SELECT event_type AS k, nullif(user_id % 4, 3) AS kk, value AS v FROM events), {_BOX} SELECT k AS event_type, kk AS facet, n, round(p25, 6) AS p25,
    round(median, 6) AS median, round(p75, 6) AS p75, min(v) FILTER (inside) AS whisker_low, max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS
    n_outliers FROM f GROUP BY ALL""")
def box_plot_stats(t):
    e = t.events.withColumn("facet", null_if(F.col("user_id") % 4, 3))
    return rounded(box_stats(e, "value", ["event_type", "facet"]))


@query(f"WITH b AS (SELECT event_type AS k, 1 AS kk, event_id, value AS v FROM events), {_BOX} SELECT event_id, k AS event_type, v AS value FROM f WHERE NOT inside")
def box_plot_outliers(t):
    return box_outliers(t.events.select("event_id", "event_type", "value"), "value", ["event_type"])


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
    round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1""")
def exact_quantiles(t):
    return rounded(quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p99": 0.99}))
