"""Joins, unions and assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import longs, query
from catalog.registry import age_sql, stand_in, stand_ins, with_tables
from vitaspan import (assemble, decode_age, duplicates, join_ns, null_if, semi_by_list, tagged_union, tiered_union_first,
                      union_fill)
from vitaspan.plans.clinical import link_samples
from vitaspan.plans.timeline import sample_ages


@query("SELECT c_custkey, c_mktsegment, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey")
def left_one_key(t):
    nations = t.nation.where("n_regionkey < 3").select("n_nationkey", "n_name")
    return join_ns(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), nations, {"c_nationkey": "n_nationkey"}).drop("c_nationkey")


_SIDES = """a AS (SELECT s_suppkey, s_nationkey % 7 AS k1, CASE WHEN s_acctbal > 3000 THEN s_nationkey END AS k2, s_name AS name FROM supplier),
    b AS (SELECT n_nationkey AS id, n_nationkey % 7 AS j1, CASE WHEN n_nationkey > 3 THEN n_nationkey END AS j2, n_name AS name FROM nation)"""


def _sides(t):
    a = t.supplier.select("s_suppkey", (F.col("s_nationkey") % 7).alias("k1"),
                          F.when(F.col("s_acctbal") > 3000, F.col("s_nationkey")).alias("k2"), F.col("s_name").alias("name"))
    b = t.nation.select(F.col("n_nationkey").alias("id"), (F.col("n_nationkey") % 7).alias("j1"),
                        F.when(F.col("n_nationkey") > 3, F.col("n_nationkey")).alias("j2"), F.col("n_name").alias("name"))
    return a, b


@query(f"WITH {_SIDES} SELECT s_suppkey, k1, k2, a.name AS name_x, id, b.name AS name_y FROM a LEFT JOIN b ON k1 = j1 AND k2 IS NOT DISTINCT FROM j2")
def left_multikey_nullsafe(t):
    a, b = _sides(t)
    return join_ns(a, b, {"k1": "j1", "k2": "j2"}, "left")


@query(f"WITH {_SIDES} SELECT s_suppkey, k1, k2, a.name AS name_x, id, b.name AS name_y FROM a JOIN b ON k1 = j1 AND k2 = j2")
def inner_multikey(t):
    a, b = _sides(t)
    return join_ns(a, b, {"k1": "j1", "k2": "j2"}, "inner", nulls_match=False)


@query(f"""WITH {_SIDES} SELECT s_suppkey, coalesce(k1, j1) AS k1, coalesce(k2, j2) AS k2, a.name AS name_x, id, b.name AS name_y
    FROM a FULL JOIN b ON k1 = j1 AND k2 IS NOT DISTINCT FROM j2""")
def full_outer_coalesce(t):
    a, b = _sides(t)
    return join_ns(a, b, {"k1": "j1", "k2": "j2"}, "full")


@query("""SELECT o_orderkey, c_mktsegment, o_orderstatus FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 5000""")
def inner_restrict(t):
    """Keep the records of a cohort, with a column of the cohort list."""
    listed = t.customer.where("c_acctbal > 5000").select("c_custkey", "c_mktsegment")
    return join_ns(listed, t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), {"c_custkey": "o_custkey"}, "inner",
                   nulls_match=False).drop("c_custkey")


_PARTS = """d AS (SELECT c_custkey AS k, c_mktsegment FROM customer WHERE c_acctbal > 1000),
    f AS (SELECT o_custkey AS k, count(*) AS n_orders, min(o_totalprice) AS low FROM orders WHERE o_totalprice > 200000 GROUP BY 1),
    u AS (SELECT o_custkey AS k, max(o_orderkey) AS last_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
    e AS (SELECT user_id AS k, count(*) AS n_events, max(value) AS high FROM events GROUP BY 1),
    s AS (SELECT s_suppkey AS k, s_name FROM supplier WHERE s_acctbal > 2000)"""


def _parts(t):
    big = t.orders.where("o_totalprice > 200000")
    return [t.customer.where("c_acctbal > 1000").select(F.col("c_custkey").alias("k"), "c_mktsegment"),
            big.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_totalprice").alias("low")),
            t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("last_urgent")),
            t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events"), F.max("value").alias("high")),
            t.supplier.where("s_acctbal > 2000").select(F.col("s_suppkey").alias("k"), "s_name")]


@query(f"""WITH {_PARTS} SELECT k, c_mktsegment, n_orders, low, last_urgent, n_events, high, s_name FROM d LEFT JOIN f USING (k)
    LEFT JOIN u USING (k) LEFT JOIN e USING (k) LEFT JOIN s USING (k)""")
def cohort_left_assembly(t):
    return assemble(_parts(t), "k", "left", key_nullable=False)


@query(f"""WITH {_PARTS} SELECT k, c_mktsegment, n_orders, low, last_urgent, n_events, high, s_name FROM d FULL JOIN f USING (k)
    FULL JOIN u USING (k) FULL JOIN e USING (k) FULL JOIN s USING (k)""")
def cohort_full_assembly(t):
    return assemble(_parts(t), "k", "full", key_nullable=False)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_by_key_list(t):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return semi_by_list(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", wanted, "c_custkey")


@query("""SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 7000 AND contains(
    'K' || CAST(o_custkey AS VARCHAR), CAST(s_suppkey AS VARCHAR)))""")
def semi_by_substring(t):
    """Keys that contain a listed key, as a regular-expression alternation of the list would find them."""
    o = t.orders.select("o_orderkey", F.concat(F.lit("K"), F.col("o_custkey").cast("string")).alias("k"))
    wanted = t.supplier.where("s_acctbal > 7000").select(F.col("s_suppkey").cast("string").alias("k"))
    return semi_by_list(o, "k", wanted, mode="substring").select("o_orderkey")


_PAIR_SQL = f"""{with_tables('Samples', 'ClinicalMolLinkage', 'MSI')},
    g AS (SELECT patient_id, WES AS Germline_WES, SpecimenAge AS germline_collection_age, SpecimenSiteOfCollection AS
        germline_SpecimenSiteOfCollection FROM ClinicalMolLinkage WHERE TumorGermline = 'Germline'),
    u AS (SELECT l.patient_id, l.WES AS Tumor_WES, SpecimenAge AS tumor_collection_age, DiseaseType, SpecimenSiteOfCollection AS
        tumor_SpecimenSiteOfCollection, CASE WHEN MSI_score >= 20 THEN 'Yes' WHEN MSI_score < 20 THEN 'No' END AS MSI_high_score
        FROM ClinicalMolLinkage l LEFT JOIN MSI m ON l.patient_id = m.patient_id AND l.WES = m.WES WHERE TumorGermline = 'Tumor'),
    p AS (SELECT coalesce(g.patient_id, u.patient_id) AS patient_id, Germline_WES, Tumor_WES, germline_collection_age,
        germline_SpecimenSiteOfCollection, tumor_collection_age, DiseaseType, tumor_SpecimenSiteOfCollection, MSI_high_score
        FROM g FULL JOIN u ON g.patient_id = u.patient_id)
    SELECT s.patient_id, s.Germline AS Germline_WES, s.Tumor_WES, {age_sql('germline_collection_age')} AS germline_collection_age,
    germline_SpecimenSiteOfCollection, {age_sql('tumor_collection_age')} AS tumor_collection_age, DiseaseType,
    tumor_SpecimenSiteOfCollection, MSI_high_score FROM Samples s LEFT JOIN p ON s.patient_id = p.patient_id
    AND s.Germline IS NOT DISTINCT FROM p.Germline_WES AND s.Tumor_WES IS NOT DISTINCT FROM p.Tumor_WES"""


@query(_PAIR_SQL)
def sample_pair_lookup(t):
    """Attributes of listed germline/tumour pairs; the SQL forms all pairs of a patient, the library does not."""
    r = stand_ins(t, "Samples", "ClinicalMolLinkage", "MSI")
    pairs = r["Samples"].select("patient_id", F.col("Germline").alias("Germline_WES"), "Tumor_WES")
    return link_samples(pairs, r["ClinicalMolLinkage"], r["MSI"])


@query(f"""{with_tables('Samples', 'ClinicalMolLinkage')}, c AS (SELECT *, {age_sql('SpecimenAge')} AS age FROM ClinicalMolLinkage),
    r AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY RNASeq ORDER BY patient_id, age NULLS LAST) = 1)
    SELECT s.*, g.age AS age_g, u.age AS age_t, r.age AS age_r FROM Samples s
    LEFT JOIN c g ON s.patient_id = g.patient_id AND s.Germline IS NOT DISTINCT FROM g.WES
    LEFT JOIN c u ON s.patient_id = u.patient_id AND s.Tumor_WES IS NOT DISTINCT FROM u.WES
    LEFT JOIN r ON s.patient_id = r.patient_id AND s.RNASeq IS NOT DISTINCT FROM r.RNASeq""")
def three_role_lookup(t):
    r = stand_ins(t, "Samples", "ClinicalMolLinkage")
    return sample_ages(r["Samples"], r["ClinicalMolLinkage"], "patient_id", "SpecimenAge", {
        "age_g": ("Germline", "WES", "all"), "age_t": ("Tumor_WES", "WES", "all"), "age_r": ("RNASeq", "RNASeq", "one")})


@query("""SELECT 'customer' AS source, c_nationkey AS nation, count(*) AS n, NULL AS low FROM customer GROUP BY ALL UNION ALL
    SELECT 'supplier', s_nationkey, count(*), min(s_acctbal) FROM supplier GROUP BY ALL""")
def tagged_union_missing_columns(t):
    both = tagged_union({"customer": t.customer.select(F.col("c_nationkey").alias("nation")),
                         "supplier": t.supplier.select(F.col("s_nationkey").alias("nation"), "s_acctbal")}, "source")
    return both.groupBy("source", "nation").agg(F.count(F.lit(1)).alias("n"), F.min("s_acctbal").alias("low"))


@query("""SELECT k, count(*) AS n, max(v) AS latest FROM (SELECT o_custkey AS k, o_totalprice AS v FROM orders UNION ALL
    SELECT user_id, value FROM events) GROUP BY 1""")
def union_same_columns(t):
    both = union_fill(t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v")),
                      t.events.select(F.col("user_id").alias("k"), F.col("value").alias("v")))
    return both.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("latest"))


@query("""WITH m AS (SELECT o_custkey AS k, o_orderpriority AS site FROM orders WHERE o_orderstatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
    r AS (SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '2-HIGH') AS site, o_totalprice FROM orders),
    u AS (SELECT r.*, 0 AS tier FROM r JOIN m ON o_custkey = k AND r.site IS NOT DISTINCT FROM nullif(m.site, '2-HIGH') UNION ALL
        SELECT *, 1 FROM r WHERE site = '4-NOT SPECIFIED')
    SELECT o_custkey, o_orderkey, site, o_totalprice FROM u
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY tier, o_totalprice, o_orderkey) = 1""")
def tiered_union(t):
    """Cheapest order of the first finished order's priority, else of the unspecified one. NULL sites match."""
    from vitaspan import first_per_key

    rows = t.orders.select("o_custkey", "o_orderkey", null_if("o_orderpriority", "2-HIGH").alias("site"), "o_totalprice")
    first = first_per_key(t.orders.where("o_orderstatus = 'F'"), ["o_custkey"], ["o_orderkey"])
    match = first.select("o_custkey", null_if("o_orderpriority", "2-HIGH").alias("site"))
    return tiered_union_first(rows, match, {"o_custkey": "o_custkey", "site": "site"}, F.col("site") == "4-NOT SPECIFIED",
                              ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query("SELECT o_custkey, o_orderdate::DATE::VARCHAR AS day, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    o = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return duplicates(o, ["o_custkey", "day"])
