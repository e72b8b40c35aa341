"""Pivots, ordered text aggregation, splitting and unpivoting."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from vitaspan import concat_ordered, null_if, pivot_ordinal, pivot_wide, unpivot_long
from vitaspan.operators.reshape import any_flag_by_sample

_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{x}' THEN value END) AS \"{x}\"" for x in _TYPES)
       + " FROM events GROUP BY 1")
def pivot_single(t):
    """One column per event type, found in the data; the largest value per cell."""
    return pivot_wide(t.events, ["user_id"], "event_type", "value", on_duplicate="max")


@query("SELECT user_id, " + ", ".join(f"list_sort(list(event_id) FILTER (WHERE coalesce(event_type, 'NA') = '{x}'))::VARCHAR AS \"{x}\""
                                      for x in ["click", "error", "NA"])
       + " FROM (SELECT user_id, event_id, nullif(event_type, 'view') AS event_type FROM events) GROUP BY 1")
def pivot_lists(t):
    """Several rows per cell become a list; rows without a name have their own column."""
    e = t.events.select("user_id", "event_id", null_if("event_type", "view").alias("event_type"))
    wide = pivot_wide(e, ["user_id"], "event_type", "event_id", ["click", "error", "NA"], "list", others="drop")
    return wide.withColumns({c: F.when(F.size(c) > 0, F.concat(F.lit("["), F.array_join(F.sort_array(c), ", "), F.lit("]")))
                             for c in ["click", "error", "NA"]})


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders),
    i AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) SELECT o_custkey, o_orderstatus, """
       + ", ".join(f"max(CASE WHEN n = {i} THEN {c} END) AS {c}_{i}" for c in ("o_totalprice", "o_orderpriority") for i in range(1, 6))
       + " FROM i JOIN n USING (o_custkey, o_orderstatus) GROUP BY ALL")
def pivot_first_five(t):
    """Ordinals count over the customer although status is part of the row key."""
    return pivot_ordinal(t.orders, ["o_custkey", "o_orderstatus"], "o_custkey", ["o_orderdate", "o_orderkey"],
                         ["o_totalprice", "o_orderpriority"], 5)


@query("""SELECT o_custkey, CASE WHEN bool_or(p IS NULL) THEN NULL ELSE string_agg(p, '; ' ORDER BY day NULLS LAST, o_orderkey) END AS p,
    string_agg(CAST(o_orderkey AS VARCHAR), '; ' ORDER BY day NULLS LAST, o_orderkey) AS keys FROM (SELECT o_custkey, o_orderkey,
    nullif(o_orderstatus, 'O') AS p, CASE WHEN o_totalprice > 100000 THEN o_orderdate END AS day FROM orders) GROUP BY 1""")
def ordered_concat(t):
    """One unknown value makes the text of the key NULL."""
    o = t.orders.select("o_custkey", "o_orderkey", null_if("o_orderstatus", "O").alias("p"),
                        F.when(F.col("o_totalprice") > 100000, F.col("o_orderdate")).alias("day"), F.col("o_orderkey").alias("keys"))
    return concat_ordered(o, ["o_custkey"], ["p", "keys"], ["day", "o_orderkey"])


@query("""WITH m AS (SELECT o_custkey, year(o_orderdate) AS y, CASE o_orderstatus WHEN 'F' THEN NULL ELSE month(o_orderdate) END AS m,
        o_orderpriority AS p FROM orders),
    a AS (SELECT o_custkey, y, m, string_agg(p, '; ' ORDER BY p) AS p FROM m GROUP BY ALL)
    SELECT o_custkey, y::INT AS y, string_agg(p, '; ' ORDER BY m NULLS LAST, p) AS p, CASE WHEN bool_or(m IS NULL) THEN NULL ELSE
    string_agg(CAST(m AS VARCHAR), '; ' ORDER BY m, p) END AS m FROM a GROUP BY ALL""")
def two_level_concat(t):
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"), F.when(F.col("o_orderstatus") != "F", F.month("o_orderdate")).alias("m"),
                        F.col("o_orderpriority").alias("p"))
    inner = concat_ordered(o, ["o_custkey", "y", "m"], ["p"], ["p"])
    return concat_ordered(inner, ["o_custkey", "y"], ["p", "m"], ["m", "p"])


@query("""SELECT variable, value, count(*) AS n FROM (SELECT l_returnflag AS r, nullif(l_linestatus, 'O') AS s,
    CAST(l_tax AS DECIMAL(4,2)) AS x FROM lineitem) l, LATERAL (SELECT unnest(['l_returnflag', 'status', 'l_tax']) AS variable,
    unnest([r, s, rtrim(rtrim(CAST(x AS VARCHAR), '0'), '.')]) AS value) GROUP BY ALL""")
def unpivot_to_long(t):
    li = t.lineitem.withColumn("status", null_if("l_linestatus", "O"))
    long = unpivot_long(li, [], ["l_returnflag", "status", "l_tax"])
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey AS sample, bool_or(l_discount > 0.09 AND l_tax > 0.07) AS flag FROM lineitem GROUP BY 1")
def matrix_any_flag(t):
    """A variants-by-samples mask in long form: does any variant of the sample carry the flag?"""
    mask = t.lineitem.select(F.col("l_suppkey").alias("sample"), ((F.col("l_discount") > 0.09) & (F.col("l_tax") > 0.07)).alias("hit"))
    return any_flag_by_sample(mask, "sample", "hit")
