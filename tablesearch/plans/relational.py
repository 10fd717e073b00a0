"""Aggregations, joins, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .registry import Tables, query


@query("SELECT count(*) AS n, count(l_tax) AS taxed, sum(l_quantity) AS qty, min(l_shipdate) AS first, max(l_shipdate) AS last, round(avg(l_extendedprice), 4) AS price FROM lineitem")
def agg_global(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"), F.count("l_tax").alias("taxed"), F.sum("l_quantity").alias("qty"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.round(F.avg("l_extendedprice"), 4).alias("price"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL ORDER BY l_returnflag NULLS FIRST, l_linestatus DESC")
def agg_group(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty")).orderBy(F.asc_nulls_first("l_returnflag"), F.desc("l_linestatus"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def agg_group_cast(t: Tables) -> DataFrame:
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 150")
def agg_having(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty")).filter("qty > 150")


@query("SELECT p_brand, count(DISTINCT p_size) AS sizes, count(DISTINCT p_type) AS types FROM part GROUP BY 1")
def agg_distinct(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.countDistinct("p_size").alias("sizes"), F.countDistinct("p_type").alias("types"))


@query("SELECT l_returnflag, sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END)::BIGINT AS high, count(*) FILTER (WHERE l_tax = 0) AS untaxed FROM lineitem GROUP BY 1")
def agg_case(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("high"), F.count(F.when(F.col("l_tax") == 0, 1)).alias("untaxed"))


@query("SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles, array_to_string(list(turn ORDER BY turn), ' ') AS turns FROM conversations GROUP BY 1")
def agg_list(t: Tables) -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return t.conversations.groupBy("conv_id").agg(pairs.alias("p")).select("conv_id", F.array_join("p.role", ",").alias("roles"), F.array_join(F.transform("p.turn", lambda x: x.cast("string")), " ").alias("turns"))


@query("SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def join_inner(t: Tables) -> DataFrame:
    """Totals by customer first, so that the join moves a row a customer and not a row an order."""
    totals = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return t.customer.join(totals, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY 1")
def join_left(t: Tables) -> DataFrame:
    counts = t.orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("SELECT coalesce(d.doc_id, e.vec_id) AS id, e.label, d.lang FROM documents d FULL JOIN embeddings e ON d.doc_id = e.vec_id")
def join_full(t: Tables) -> DataFrame:
    return t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id"), "full_outer").select(F.coalesce("doc_id", "vec_id").alias("id"), "label", "lang")


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey AND ((p_type = 'PROMO' AND l_quantity < 10) OR (p_size > 45 AND l_quantity > 45))")
def join_theta(t: Tables) -> DataFrame:
    either = "(p_type = 'PROMO' and l_quantity < 10) or (p_size > 45 and l_quantity > 45)"
    return t.lineitem.join(t.part, F.expr(f"l_partkey = p_partkey and ({either})")).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def join_semi(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.filter("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def join_anti(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn, rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS rk FROM customer")
def window_rank(t: Tables) -> DataFrame:
    w = Window.partitionBy("c_nationkey")
    return t.customer.select("c_custkey", "c_nationkey", F.row_number().over(w.orderBy(F.desc("c_acctbal"), "c_custkey")).cast("long").alias("rn"), F.rank().over(w.orderBy("c_mktsegment")).cast("long").alias("rk"))


@query("SELECT user_id, event_id, lag(event_id) OVER w AS before, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS pair FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def window_frame(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("user_id", "event_id", F.lag("event_id").over(w).alias("before"), F.sum("value").over(w.rowsBetween(-1, 0)).alias("pair"))


@query("SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier ORDER BY s_nationkey, s_acctbal DESC NULLS LAST, s_suppkey")
def sort_multi(t: Tables) -> DataFrame:
    return t.supplier.select("s_nationkey", "s_acctbal", "s_suppkey").orderBy("s_nationkey", F.desc_nulls_last("s_acctbal"), "s_suppkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT doc_id AS id FROM documents UNION ALL SELECT vec_id FROM embeddings")
def set_union_all(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id")).unionByName(t.embeddings.select(F.col("vec_id").alias("id")))


@query("SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_except(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id")).subtract(t.labels.select(F.col("doc_id").alias("id")))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select(F.col("s_nationkey").alias("k")))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg_rollup(t: Tables) -> DataFrame:
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"))
