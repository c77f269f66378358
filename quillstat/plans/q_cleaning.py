"""Catalog: scans, projections, cleaning (C*, S15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.kernels import mix_hash_sql
from ..operators import cleaning as C
from .catalog import register, table

# TPC-H order priorities and their ordinal codes.
PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}

INJECT_RATE = 0.03
INJECT_SEED = 42


def injected_orders(spark, sf):
    """orders with exactly floor(3% n) NULLs in o_totalprice and in o_orderpriority."""
    o = table(spark, sf, "orders")
    return C.inject_missing(o, ["o_totalprice", "o_orderpriority"], "o_orderkey", INJECT_RATE, INJECT_SEED)


INJECTED_SQL = f"""injected AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
         CASE WHEN rn0 <= k THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN rn1 <= k THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM (SELECT *,
               row_number() OVER (ORDER BY {mix_hash_sql("o_orderkey", "o_totalprice", INJECT_SEED)}, o_orderkey) AS rn0,
               row_number() OVER (ORDER BY {mix_hash_sql("o_orderkey", "o_orderpriority", INJECT_SEED)}, o_orderkey) AS rn1,
               floor(count(*) OVER () * {INJECT_RATE}) AS k
        FROM orders) t)"""


@register("s_inject_missing", f"""WITH {INJECTED_SQL}
SELECT o_orderkey, o_totalprice, o_orderpriority FROM injected""", ops=("S15",))
def s_inject_missing(spark, sf):
    return injected_orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority")


@register("c_select_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", ops=("C1",))
def c_select_numeric(spark, sf):
    return C.select_numeric(table(spark, sf, "orders"))


@register("c_select_categorical", "SELECT o_orderstatus, o_orderpriority FROM orders", ops=("C1",))
def c_select_categorical(spark, sf):
    return C.select_categorical(table(spark, sf, "orders"))


@register("c_impute_median", f"""WITH {INJECTED_SQL}
SELECT o_orderkey, coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM injected)) AS o_totalprice
FROM injected""", ops=("C2",))
def c_impute_median(spark, sf):
    inj = injected_orders(spark, sf).select("o_orderkey", "o_totalprice")
    return C.impute_median(inj, ["o_totalprice"])


@register("c_impute_mode", f"""WITH {INJECTED_SQL},
m AS (SELECT o_orderpriority AS v FROM injected WHERE o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT o_orderkey, coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority FROM injected""", ops=("C3",))
def c_impute_mode(spark, sf):
    inj = injected_orders(spark, sf).select("o_orderkey", "o_orderpriority")
    return C.impute_mode(inj, ["o_orderpriority"])


@register("c_handle_missing", f"""WITH {INJECTED_SQL},
m AS (SELECT o_orderpriority AS v FROM injected WHERE o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
       coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM injected)) AS o_totalprice,
       coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority
FROM injected""", ops=("C2", "C3"))
def c_handle_missing(spark, sf):
    inj = injected_orders(spark, sf)
    return C.handle_missing(inj, exclude=("o_orderkey", "o_custkey"))


_FENCES = """f AS (SELECT quantile_cont(o_totalprice, 0.25) - 1.5 * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) AS lo,
              quantile_cont(o_totalprice, 0.75) + 1.5 * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) AS hi
       FROM orders)"""


@register("c_iqr_filter", f"""WITH {_FENCES}
SELECT o_orderkey, o_totalprice FROM orders, f WHERE o_totalprice BETWEEN f.lo AND f.hi""", ops=("C4",))
def c_iqr_filter(spark, sf):
    return C.iqr_filter(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


_EV_FENCES = """f AS (SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
              quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi
       FROM events)"""


@register("c_iqr_filter_report", f"""WITH {_EV_FENCES}
SELECT count(*) AS n_before, count(*) FILTER (WHERE value BETWEEN f.lo AND f.hi) AS n_kept,
       count(*) - count(*) FILTER (WHERE value BETWEEN f.lo AND f.hi) AS n_removed
FROM events, f""", ops=("C4",))
def c_iqr_filter_report(spark, sf):
    return C.iqr_filter_report(table(spark, sf, "events"), "value")


@register("c_winsorise", f"""WITH {_EV_FENCES}
SELECT event_id, least(greatest(value, f.lo), f.hi) AS value FROM events, f""", ops=("C18", "C11"))
def c_winsorise(spark, sf):
    return C.winsorise(table(spark, sf, "events").select("event_id", "value"), "value")


@register("c_drop_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem", ops=("C5",))
def c_drop_duplicates(spark, sf):
    return C.drop_duplicates(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


_PRIO_CASE = ("CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITY_CODES.items()) + " END")


@register("c_ordinal_encode", f"SELECT o_orderkey, o_orderpriority, {_PRIO_CASE} AS o_orderpriority_num FROM orders",
          ops=("C6",))
def c_ordinal_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return C.ordinal_encode(o, "o_orderpriority", PRIORITY_CODES)


@register("c_binary_flag", """SELECT c_custkey, coalesce(CAST(c_mktsegment = 'BUILDING' AS INTEGER), 0) AS c_mktsegment_num
FROM customer""", ops=("C7",))
def c_binary_flag(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return C.binary_flag(c, "c_mktsegment", "BUILDING").drop("c_mktsegment")


@register("c_feature_matrix", """SELECT l_quantity, l_discount, l_tax, l_linenumber, l_extendedprice,
       CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem""", ops=("C8",))
def c_feature_matrix(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return C.feature_matrix(li, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], ["l_extendedprice", "returned"])


@register("c_clean_table", f"""WITH {INJECTED_SQL},
m AS (SELECT o_orderpriority AS v FROM injected WHERE o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1),
filled AS (SELECT o_custkey, o_orderstatus,
       coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM injected)) AS o_totalprice,
       coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority FROM injected)
SELECT DISTINCT o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       {_PRIO_CASE} AS o_orderpriority_num FROM filled""", ops=("C9",))
def c_clean_table(spark, sf):
    inj = injected_orders(spark, sf).select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return C.clean_table(inj, encoders=[lambda d: C.ordinal_encode(d, "o_orderpriority", PRIORITY_CODES)],
                         exclude=("o_custkey",))


@register("c_standardise", """SELECT p_partkey,
       round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 9) AS p_retailprice_z
FROM part""", ops=("C10",))
def c_standardise(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    z = C.standardise(p, ["p_retailprice"])
    return z.select("p_partkey", F.round("p_retailprice_z", 9).alias("p_retailprice_z"))


@register("c_clip_threshold", """SELECT l_orderkey, l_linenumber, least(greatest(l_quantity, 5.0), 45.0) AS qty_clipped,
       CAST(l_discount >= 0.05 AS INTEGER) AS high_discount FROM lineitem""", ops=("C11", "C12"))
def c_clip_threshold(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.clip(F.col("l_quantity"), 5.0, 45.0).alias("qty_clipped"),
                     C.threshold_label(F.col("l_discount"), 0.05).alias("high_discount"))


@register("c_to_numeric", """SELECT event_id, TRY_CAST(regexp_replace(props, '[^0-9.]', '', 'g') AS DOUBLE) AS k_num,
       TRY_CAST(event_type AS DOUBLE) AS type_num FROM events""", ops=("C13",))
def c_to_numeric(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", C.to_numeric(F.regexp_replace("props", "[^0-9.]", "")).alias("k_num"),
                     C.to_numeric(F.col("event_type")).alias("type_num"))


def line_rules():
    """Rules over lineitem rows, in the shape of the reference's recommendation rules."""
    return [
        ("small_order", F.col("l_quantity") < 10),
        ("deep_discount", F.col("l_discount") > 0.08),
        ("tax_free", F.col("l_tax") == 0),
        ("returned", F.col("l_returnflag") == "R"),
    ]


@register("c_rule_flags", """SELECT l_orderkey, l_linenumber, 'small_order' AS recommendation FROM lineitem WHERE l_quantity < 10
UNION ALL SELECT l_orderkey, l_linenumber, 'deep_discount' FROM lineitem WHERE l_discount > 0.08
UNION ALL SELECT l_orderkey, l_linenumber, 'tax_free' FROM lineitem WHERE l_tax = 0
UNION ALL SELECT l_orderkey, l_linenumber, 'returned' FROM lineitem WHERE l_returnflag = 'R'""", ops=("C14",))
def c_rule_flags(spark, sf):
    return C.rule_flags(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], line_rules())


@register("c_sample_rows", f"""SELECT o_orderkey, o_totalprice FROM orders
ORDER BY {mix_hash_sql("o_orderkey", "sample")}, o_orderkey LIMIT 100""", ops=("C15", "V8"))
def c_sample_rows(spark, sf):
    return C.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 100, "o_orderkey", 42)


# Fixed replacement pairs for the text-substitution operator (longest key first).
TEXT_PAIRS = [("é", "e"), ("the", "THE"), ("ou", "OU"), ("and", "&")]


@register("c_text_replace", """SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars, CAST(t <> text AS INTEGER) AS changed
FROM (SELECT doc_id, text, replace(replace(replace(replace(text, 'the', 'THE'), 'and', '&'), 'ou', 'OU'), 'é', 'e') AS t
      FROM documents)""", ops=("C16",))
def c_text_replace(spark, sf):
    d = C.replace_text(table(spark, sf, "documents").select("doc_id", "text"), "text", TEXT_PAIRS, out="t")
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"), "changed")


@register("c_text_replace_count", """SELECT count(*) FILTER (WHERE t <> text) AS n_changed, count(*) AS n_docs
FROM (SELECT text, replace(replace(replace(replace(text, 'the', 'THE'), 'and', '&'), 'ou', 'OU'), 'é', 'e') AS t
      FROM documents)""", ops=("C16",))
def c_text_replace_count(spark, sf):
    d = C.replace_text(table(spark, sf, "documents").select("doc_id", "text"), "text", TEXT_PAIRS, out="t")
    return d.agg(F.sum("changed").cast("long").alias("n_changed"), F.count(F.lit(1)).alias("n_docs"))


@register("c_subset_features", "SELECT l_quantity, l_tax FROM lineitem", ops=("C17",))
def c_subset_features(spark, sf):
    return C.subset_features(table(spark, sf, "lineitem"), ["l_quantity", "not_a_column", "l_tax"])


@register("c_one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS prio_" + "".join(ch if ch.isalnum() else "_" for ch in v).lower()
    for v in PRIORITY_CODES) + " FROM orders", ops=("C19",))
def c_one_hot(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return C.one_hot(o, "o_orderpriority", list(PRIORITY_CODES), prefix="prio").drop("o_orderpriority")
