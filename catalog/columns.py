"""Scans, sinks, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query
from catalog.registry import age_sql, stand_in, with_tables
from vitaspan import (across, add_after, bucket, capture, cols_between, cols_like, decode_age, distinct_sorted, frequency,
                      is_capped, join_parts, label, level_index, levels, member_update, null_if, null_if_all_strings,
                      number_text, paste, read_delim, read_family, read_table, recode, relocate, remove_first,
                      split_head_rest, to_number, write_table)
from vitaspan.operators.frames import constants, labels_of, rename
from vitaspan.session import own_path
from vitaspan.sources.readers import read_tsv

_ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, day STRING, o_orderpriority STRING"
_ORDER_TOTALS = """SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(day) AS n_days, min(day) AS first_day,
    round(sum(o_totalprice), 2) AS total FROM ({}) GROUP BY ALL"""
_ORDER_ROWS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CASE WHEN o_totalprice >= 20000 THEN
    strftime(o_orderdate, '%Y-%m-%d') END AS day, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL ELSE
    'rank "' || o_orderpriority || '", given' END AS o_orderpriority FROM orders"""
_PLAIN_ROWS = _ORDER_ROWS.replace("""'rank "' || o_orderpriority || '", given'""", """'"' || o_orderpriority""")


def _order_rows(t, text):
    """Orders with NULLs and awkward text."""
    o = t.orders
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.when(F.col("o_totalprice") >= 20000, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
                    F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", text).alias("o_orderpriority"))


def _totals(df):
    return df.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count("day").alias("n_days"), F.min("day").alias("first_day"),
        F.round(F.sum("o_totalprice"), 2).alias("total"))


def _target(t, name):
    return own_path(t.spark, name)


# --- sources and sinks -----------------------------------------------------------------------------

@query(_ORDER_TOTALS.format(_ORDER_ROWS))
def csv_roundtrip(t):
    path = _target(t, "orders")
    rows = _order_rows(t, F.concat(F.lit('rank "'), F.col("o_orderpriority"), F.lit('", given')))
    write_table(rows, f"{path}/orders.csv", "csv", run_date="2024-07-15")
    return _totals(read_delim(t.spark, f"{path}/orders_2024-07-15.csv", _ORDERS, null_values="NA"))


@query(_ORDER_TOTALS.format(_PLAIN_ROWS))
def tsv_scan(t):
    """Tab-separated text in which a quote is an ordinary character."""
    path = _target(t, "orders-tsv")
    rows = _order_rows(t, F.concat(F.lit('"'), F.col("o_orderpriority")))
    rows.write.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    return _totals(read_tsv(t.spark, path, _ORDERS))


@query("""SELECT 'nation' AS family, count(*) AS n, sum(length(n_name))::BIGINT AS chars FROM nation UNION ALL
    SELECT 'supplier', count(*), sum(length(s_name))::BIGINT FROM supplier UNION ALL
    SELECT 'customer', count(*), sum(length(c_name))::BIGINT FROM customer""")
def family_load(t):
    """Write a family of CSV extracts and load it back by file name."""
    path = _target(t, "family")
    names = {"nation": ("n_name", "n_nationkey"), "supplier": ("s_name", "s_suppkey"), "customer": ("c_name", "c_custkey")}
    schemas = {}
    for n, (text, key) in names.items():
        write_table(getattr(t, n), f"{path}/extract_{n}_V4.csv", "csv", columns=[key, text])
        schemas[n] = f"{key} BIGINT, {text} STRING"
    tables = read_family(t.spark, f"{path}/extract_*_V4.csv", r"extract_(.*)_V4\.csv", schemas)
    parts = [df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(names[n][0])).alias("chars")).select(
        F.lit(n).alias("family"), "n", "chars") for n, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def parquet_roundtrip(t):
    path = write_table(t.orders, _target(t, "orders") + "/orders", run_date="2024-07-15",
                       columns=["o_orderkey", "o_orderstatus", "o_totalprice"])
    return read_table(t.spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_pairs(t):
    return distinct_sorted(t.orders, ["o_orderpriority", "o_orderstatus"])


# --- projections and filters -----------------------------------------------------------------------

@query("""SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderpriority AS "order rank", 'Yes' AS has_order_data,
    'orders' AS source FROM orders""")
def project_rename_constants(t):
    df = t.orders.select(F.col("o_orderkey").alias("order_id"), "o_totalprice", "o_orderpriority", "o_orderstatus")
    df = rename(df, {"o_totalprice": "price", "o_orderpriority": "order rank"}).drop("o_orderstatus")
    return constants(df, {"has_order_data": "Yes", "source": "orders"})


@query("""SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_orderkey,
    round(l_extendedprice * (1 - l_discount), 6) AS net FROM lineitem""")
def positional_range_selectors(t):
    df = t.lineitem
    df = add_after(df, "net", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6), "l_discount")
    picked = cols_between(df, "l_quantity", "l_linestatus")
    keys = [c for c in cols_like(df, contains="key", dtype="bigint") if c in cols_like(df, prefix="l_order")]
    return relocate(df.select(*picked, *keys), keys)


@query("""SELECT event_type, count(n_value) AS n, round(sum(n_value), 6) AS total, min(t_props) AS low, count(t_type) AS typed
    FROM (SELECT event_type, nullif(value, 6.55) + 1 AS n_value, nullif(props, '{"k": 69}') AS t_props,
    nullif(event_type, 'view') AS t_type FROM events) GROUP BY 1""")
def across_columns(t):
    """One expression over listed columns, and one over all text columns."""
    df = across(t.events, ["value"], lambda c: null_if(c, 6.55) + 1)
    texts = null_if_all_strings(null_if_all_strings(df.select("event_type", "props", "value").withColumn("kind", F.col("event_type")),
                                                    '{"k": 69}').withColumn("event_type", F.col("kind")), "view")
    return texts.groupBy(F.coalesce("event_type", F.lit("view")).alias("event_type")).agg(
        F.count("value").alias("n"), F.round(F.sum("value"), 6).alias("total"), F.min("props").alias("low"),
        F.count("kind").alias("typed"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n FROM (SELECT *, nullif(l_tax, 0.0) AS tax, nullif(l_discount, 0.0) AS disc
    FROM lineitem) WHERE (disc < tax OR (tax IS NULL AND disc IS NOT NULL)) AND l_returnflag IN ('A', 'R') AND l_quantity <> 7
    GROUP BY ALL""")
def composite_predicate(t):
    tax, disc = null_if("l_tax", 0.0), null_if("l_discount", 0.0)
    keep = (disc < tax) | (tax.isNull() & disc.isNotNull())
    return t.lineitem.where(keep & F.col("l_returnflag").isin("A", "R") & (F.col("l_quantity") != 7)).groupBy(
        "l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderstatus, count(*) AS n, count(flag) AS known FROM (SELECT o_orderstatus, CASE o_orderpriority WHEN
    '1-URGENT' THEN NULL ELSE o_orderpriority END AS flag FROM orders) WHERE flag <> '5-LOW' GROUP BY 1""")
def inequality_drops_nulls(t):
    df = t.orders.withColumn("flag", null_if("o_orderpriority", "1-URGENT")).where(F.col("flag") != "5-LOW")
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count("flag").alias("known"))


@query("""SELECT class, count(*) AS n FROM (SELECT CASE WHEN l_discount > l_tax AND l_returnflag = 'R' THEN 'returned'
    WHEN l_discount > l_tax THEN 'discounted' WHEN l_tax > 0.04 THEN 'taxed' END AS class FROM lineitem) GROUP BY 1""")
def conditional_column(t):
    c = (F.when((F.col("l_discount") > F.col("l_tax")) & (F.col("l_returnflag") == "R"), "returned")
         .when(F.col("l_discount") > F.col("l_tax"), "discounted").when(F.col("l_tax") > 0.04, "taxed"))
    return t.lineitem.groupBy(c.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000) THEN 'LARGE'
    ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def update_members(t):
    large = t.orders.where("o_totalprice > 480000").select("o_custkey")
    return member_update(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", large, "o_custkey", "c_mktsegment", "LARGE")


@query("""SELECT grp AS c_mktsegment, CASE grp WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'HOUSEHOLD' THEN 3 END AS place,
    count(*) AS n FROM (SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_mktsegment END AS grp
    FROM customer) GROUP BY 1""")
def ordered_levels(t):
    wanted = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
    df = t.customer.select(levels("c_mktsegment", wanted).alias("c_mktsegment"))
    return df.groupBy("c_mktsegment", level_index("c_mktsegment", wanted).alias("place")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT Race, count(*) AS n FROM (SELECT CASE WHEN n_name LIKE '%1' THEN NULL ELSE n_name END AS Race FROM customer
    JOIN nation ON c_nationkey = n_nationkey) WHERE Race IS NOT NULL GROUP BY 1""")
def frequency_table(t):
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return frequency(df.select(F.when(~F.col("n_name").endswith("1"), F.col("n_name")).alias("Race")), "Race")


@query("""SELECT 'c_custkey' AS col, 'Customer number' AS text, count(*) AS n FROM customer UNION ALL
    SELECT 'c_mktsegment', 'Market segment', count(c_mktsegment) FROM customer""")
def column_labels(t):
    df = label(t.customer, {"c_custkey": "Customer number", "c_mktsegment": "Market segment"})
    texts = labels_of(df)
    counts = df.agg(*[F.count(c).alias(c) for c in texts])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.lit(x).alias("text"), F.col(c).alias("n"))
                                             for c, x in texts.items()])).alias("r")).select("r.*")


# --- scalar functions ------------------------------------------------------------------------------

@query(f"""{with_tables('Diagnosis')} SELECT rec, {age_sql('AgeAtDiagnosis')} AS age, AgeAtDiagnosis = 'Age 90 or older' AS capped,
    TRY_CAST(AgeAtDiagnosis AS DOUBLE) AS number FROM Diagnosis""")
def decode_sentinel(t):
    return stand_in(t, "Diagnosis").select("rec", decode_age("AgeAtDiagnosis").alias("age"),
                                           is_capped("AgeAtDiagnosis").alias("capped"), to_number("AgeAtDiagnosis").alias("number"))


@query("""SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 0 END AS code,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'first' WHEN '2-HIGH' THEN 'first' ELSE o_orderpriority END AS merged,
    count(*) AS n FROM orders GROUP BY ALL""")
def recode_map(t):
    return t.orders.groupBy("o_orderpriority", recode("o_orderpriority", {"1-URGENT": 1, "5-LOW": 0}).alias("code"),
                            recode("o_orderpriority", {"1-URGENT": "first", "2-HIGH": "first"},
                                   F.col("o_orderpriority")).alias("merged")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT class, closed_right, count(*) AS n FROM (SELECT CASE WHEN q < 18.5 THEN 'Underweight' WHEN q < 25 THEN 'Healthy'
    WHEN q < 30 THEN 'Overweight' WHEN q >= 30 THEN 'Obese' END AS class, CASE WHEN q <= 25 THEN 'low' WHEN q > 25 THEN 'high' END
    AS closed_right FROM (SELECT nullif(l_quantity, 13.0) AS q FROM lineitem)) GROUP BY ALL""")
def bucket_class(t):
    q = null_if("l_quantity", 13.0)
    classes = bucket(q, [18.5, 25, 30], ["Underweight", "Healthy", "Overweight", "Obese"])
    return t.lineitem.groupBy(classes.alias("class"), bucket(q, [25], ["low", "high"], right=True).alias("closed_right")).agg(
        F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey, lower(regexp_replace(p_name, ' ring|e|l', '')) AS name, nullif(regexp_extract(p_brand, 'Brand#(\\d)$', 1), '')
    AS one_digit, substr(p_name, 1, 5) AS head, contains(p_name, 'red') AS is_red FROM part""")
def text_patterns(t):
    return t.part.select("p_partkey", F.lower(remove_first("p_name", " ring|e|l")).alias("name"),
                         capture("p_brand", r"Brand#(\d)$").alias("one_digit"), F.substring("p_name", 1, 5).alias("head"),
                         F.col("p_name").contains("red").alias("is_red"))


@query("""SELECT o_orderkey, coalesce(pri, 'NA') || ' (' || o_orderstatus || ')' AS pasted, nullif(concat_ws('/', pri, st), '') AS joined,
    concat_ws('/', pri, st) AS joined_empty, split_part(txt, '; ', 1) AS head, CASE WHEN contains(txt, '; ') THEN
    substr(txt, strpos(txt, '; ') + 2) END AS rest FROM (SELECT *, nullif(o_orderpriority, '1-URGENT') AS pri,
    nullif(o_orderstatus, 'F') AS st, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN 'a; ' || o_orderpriority
    ELSE 'b; c; ' || o_orderpriority END AS txt FROM orders)""")
def text_parts(t):
    o = t.orders
    txt = (F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
           .when(F.col("o_orderstatus") == "O", F.concat(F.lit("a; "), F.col("o_orderpriority")))
           .otherwise(F.concat(F.lit("b; c; "), F.col("o_orderpriority"))))
    o = o.withColumns({"pri": null_if("o_orderpriority", "1-URGENT"), "st": null_if("o_orderstatus", "F"), "txt": txt})
    head, rest = split_head_rest("txt", "; ")
    return o.select("o_orderkey", paste(F.col("pri"), " (", F.col("o_orderstatus"), ")").alias("pasted"),
                    join_parts(["pri", "st"], "/").alias("joined"), join_parts(["pri", "st"], "/", False).alias("joined_empty"),
                    head.alias("head"), rest.alias("rest"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_quantity AS BIGINT)::VARCHAR AS whole, rtrim(rtrim(
    CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR), '0'), '.') AS part, abs(l_discount - l_tax) < 0.015 AS near FROM lineitem""")
def number_as_text(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", number_text("l_quantity").alias("whole"),
                             number_text("l_tax").alias("part"), (F.abs(F.col("l_discount") - F.col("l_tax")) < 0.015).alias("near"))
