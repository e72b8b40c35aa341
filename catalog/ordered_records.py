"""Order within a key: first, last, closest, numbering, ranking, filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import longs, query, rounded
from vitaspan import (closest_per_key, dense_rank_nulls_out, fill, first_per_key, group_any, group_first, group_min,
                      group_size, last_per_key, null_if, quantiles, sequence_no, spread_flag, strongest_per_key, top_per_key)
from vitaspan.operators.ordered import group_values, sort


def _orders(t):
    """Orders with a day number and a price that is sometimes unknown."""
    o = t.orders
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                    F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")).alias("day"),
                    F.when(F.col("o_totalprice") > 50000, F.col("o_totalprice")).alias("price"))


_O = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, datediff('day', DATE '1992-01-01',
    CAST(o_orderdate AS DATE)) AS day, CASE WHEN o_totalprice > 50000 THEN o_totalprice END AS price FROM orders)"""


def _top(order: str, n: int = 1, cols: str = "o_custkey, o_orderkey, day, price") -> str:
    return (f"WITH {_O} SELECT {cols} FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {order}) <= {n}")


@query(_top("day, o_orderkey"))
def earliest_per_key(t):
    return _days(first_per_key(_orders(t), ["o_custkey"], ["day", "o_orderkey"]).select("o_custkey", "o_orderkey", "day", "price"))


def _days(df):
    return longs(df, "day")


@query(_top("price DESC NULLS LAST, o_orderkey"))
def latest_per_key(t):
    """Largest value first, records without one last."""
    return _days(last_per_key(_orders(t), ["o_custkey"], "price", ties=["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "day", "price"))


@query(_top("price NULLS LAST, day DESC NULLS LAST, o_orderkey", 5, "o_custkey, o_orderkey, day, price, row_number() OVER "
            "(PARTITION BY o_custkey ORDER BY price NULLS LAST, day DESC NULLS LAST, o_orderkey) AS place"))
def first_n_per_key(t):
    df = top_per_key(_orders(t), ["o_custkey"], ["price", "-day", "o_orderkey"], 5, out="place")
    return longs(df.select("o_custkey", "o_orderkey", "day", "price", "place"), "day", "place")


@query(f"""WITH {_O}, s AS (SELECT o_custkey, max(nullif(o_orderstatus, 'P')) AS strongest FROM o GROUP BY 1),
    r AS (SELECT o_custkey, arg_min(o_orderpriority, CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END)
    FILTER (WHERE o_orderpriority IN ('3-MEDIUM', '1-URGENT')) AS ranked FROM o GROUP BY 1)
    SELECT o_custkey, strongest, ranked FROM s JOIN r USING (o_custkey)""")
def strongest_flag(t):
    o = _orders(t).withColumn("strongest", null_if("o_orderstatus", "P"))
    o = o.withColumn("ranked", F.when(F.col("o_orderpriority").isin("3-MEDIUM", "1-URGENT"), F.col("o_orderpriority")))
    return strongest_per_key(o, ["o_custkey"], "strongest").join(
        strongest_per_key(o, ["o_custkey"], "ranked", ["3-MEDIUM", "1-URGENT"]), "o_custkey")


@query(f"""WITH {_O} SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS n,
    row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY day, o_orderkey) AS n_priority FROM o""")
def ordinal_in_key(t):
    o = sequence_no(_orders(t), ["o_custkey"], ["day", "o_orderkey"], "n", ties=[])
    o = sequence_no(o, ["o_custkey", "o_orderpriority"], ["day", "o_orderkey"], "n_priority", ties=[])
    return longs(o.select("o_orderkey", "n", "n_priority"), "n", "n_priority")


@query(f"""WITH {_O}, k AS (SELECT *, nullif(o_orderpriority, '1-URGENT') AS code FROM o) SELECT o_orderkey, CASE WHEN code IS NOT NULL
    THEN dense_rank() OVER (PARTITION BY o_custkey ORDER BY code NULLS LAST) END AS place FROM k""")
def dense_rank_nulls(t):
    o = _orders(t).withColumn("code", null_if("o_orderpriority", "1-URGENT"))
    return longs(dense_rank_nulls_out(o, ["o_custkey"], ["code"], "place").select("o_orderkey", "place"), "place")


@query(f"""WITH {_O}, k AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN NULL ELSE day // 365 END AS age, o_orderpriority AS line FROM o)
    SELECT o_orderkey, CASE WHEN age IS NOT NULL THEN dense_rank() OVER (PARTITION BY o_custkey, age IS NULL ORDER BY age, line) END
    AS place FROM k""")
def composite_dense_rank(t):
    o = _orders(t).withColumn("age", F.when(F.col("o_orderstatus") != "F", F.floor(F.col("day") / 365)))
    return longs(dense_rank_nulls_out(o, ["o_custkey"], ["age", "o_orderpriority"], "place").select("o_orderkey", "place"), "place")


_EV = """e AS (SELECT event_id, user_id, event_type, ts, CASE WHEN event_type IN ('view', 'click') THEN value END AS v FROM events)"""
_FILL = f"""WITH {_EV}, f AS (SELECT *, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT
    ROW AND UNBOUNDED FOLLOWING) AS nxt, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW) AS prv FROM e) SELECT event_id, {{}} AS v FROM f"""


def _events(t):
    return t.events.select("event_id", "user_id", "event_type", "ts",
                           F.when(F.col("event_type").isin("view", "click"), F.col("value")).alias("v"))


@query(_FILL.format("coalesce(nxt, prv)"))
def fill_updown(t):
    return fill(_events(t), ["user_id"], ["ts", "event_id"], ["v"], "updown", ties=[]).select("event_id", "v")


@query(_FILL.format("coalesce(prv, nxt)"))
def fill_downup(t):
    return fill(_events(t), ["user_id"], ["ts", "event_id"], ["v"], "downup", ties=[]).select("event_id", "v")


@query(f"WITH {_EV} SELECT event_id, min(CASE WHEN event_type = 'view' THEN v END) OVER (PARTITION BY user_id, event_type) AS low FROM e")
def group_min_broadcast(t):
    """Minimum of the key on every row; NULL where nothing is known."""
    e = _events(t).withColumn("seen", F.when(F.col("event_type") == "view", F.col("v")))
    return group_min(e, ["user_id", "event_type"], "seen", "low").select("event_id", "low")


@query(f"WITH {_O} SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM o")
def group_size_broadcast(t):
    return group_size(_orders(t), ["o_custkey"], "n").select("o_orderkey", "n")


@query(f"""WITH {_O}, k AS (SELECT *, price > 400000 AS large, nullif(o_orderpriority, '1-URGENT') AS pri FROM o)
    SELECT o_orderkey, CASE WHEN bool_or(large) OVER w THEN true WHEN count(*) FILTER (large IS NULL) OVER w > 0 THEN NULL
    ELSE false END AS any_large FROM k WINDOW w AS (PARTITION BY o_custkey, pri)""")
def any_three_valued(t):
    """Keys may be NULL and form a group of their own."""
    o = _orders(t).withColumn("pri", null_if("o_orderpriority", "1-URGENT"))
    return group_any(o, ["o_custkey", "pri"], F.col("price") > 400000, "any_large").select("o_orderkey", "any_large")


@query(f"""WITH {_O} SELECT o_orderkey, first_value(price) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS BETWEEN
    UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_price FROM o""")
def first_in_group(t):
    return group_first(_orders(t), ["o_custkey"], "price", ["day", "o_orderkey"], "first_price", ties=[]).select(
        "o_orderkey", "first_price")


@query("""SELECT o_orderkey, max(CASE WHEN o_totalprice > 450000 THEN 'Yes' END) OVER (PARTITION BY o_custkey) AS ever_large FROM orders""")
def spread_unique_flag(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_totalprice") > 450000, "Yes").alias("ever_large"))
    return spread_flag(o, ["o_custkey"], ["ever_large"]).select("o_orderkey", "ever_large")


@query("""WITH a AS (SELECT user_id, CASE WHEN user_id % 10 <> 3 THEN median(epoch(ts)) END AS mid FROM events GROUP BY 1),
    g AS (SELECT event_id, e.user_id, event_type, epoch(ts) AS secs, abs(epoch(ts) - mid) AS gap FROM events e JOIN a USING (user_id))
    SELECT user_id, event_id, event_type, round(gap, 3) AS gap FROM g
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY gap NULLS LAST, secs, event_id) = 1""")
def closest_to_anchor(t):
    """Event nearest to the median time of its user; a user without an anchor keeps the first event."""
    e = t.events.select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    mid = quantiles(e, ["user_id"], "at", {"mid": 0.5}).withColumn(
        "mid", F.when(F.col("user_id") % 10 != 3, F.col("mid")))
    near = closest_per_key(e, mid, ["user_id"], "at", "mid", gap="gap")
    return near.select("user_id", "event_id", "event_type", F.round("gap", 3).alias("gap"))


@query(f"""WITH {_O} SELECT o_custkey, o_orderkey, CAST(row_number() OVER (ORDER BY price DESC NULLS LAST, o_orderkey) AS INT) AS place FROM o
    WHERE price IS NOT NULL AND o_orderstatus = 'F'""")
def sorted_report(t):
    """All finished orders in order of price, with their places."""
    o = _orders(t).where("price is not null and o_orderstatus = 'F'")
    placed = sequence_no(o, [], ["-price", "o_orderkey"], "place", ties=[])
    return sort(placed, ["place"]).select("o_custkey", "o_orderkey", "place")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, round(min(l_discount) OVER w, 6) AS low, count(*) OVER w AS n,
    max(l_tax) OVER w AS high FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)""")
def group_values_broadcast(t):
    df = group_values(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_discount", "l_tax"), ["l_suppkey"],
                      {"low": F.min("l_discount"), "n": F.count(F.lit(1)), "high": F.max("l_tax")})
    return rounded(df.drop("l_suppkey", "l_discount", "l_tax"))
