"""Scans, projections and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import regex_full_match, regex_matches
from .registry import Tables, query


@query("SELECT * FROM part")
def scan_all(t: Tables) -> DataFrame:
    return t.part


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def scan_project(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_quantity")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 1000 AND 1200 AND o_totalprice > 1000")
def scan_index_filter(t: Tables) -> DataFrame:
    """Row groups whose range of keys misses the predicate are not read."""
    return t.orders.filter("o_orderkey between 1000 and 1200 and o_totalprice > 1000").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT count(*) AS n FROM lineitem")
def count_star(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 25")
def limit_offset(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(25).limit(50)


@query("SELECT event_id, user_id FROM events WHERE json_extract_string(props, '$.k')::INT > 50")
def filter_struct(t: Tables) -> DataFrame:
    s = t.events.withColumn("s", F.from_json("props", "k int"))
    return s.filter("s.k > 50").select("event_id", "user_id")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= CAST('1998-01-01' AS TIMESTAMP) AND CAST(l_quantity AS INT) = 10")
def filter_cast(t: Tables) -> DataFrame:
    return t.lineitem.filter((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("l_quantity").cast("int") == 10)).select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 5000 AND c_nationkey <> 3")
def filter_compare(t: Tables) -> DataFrame:
    return t.customer.filter("c_acctbal >= 0 and c_acctbal < 5000 and c_nationkey <> 3").select("c_custkey", "c_acctbal")


@query("SELECT d.doc_id, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic IS DISTINCT FROM 0")
def filter_distinct_from(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels.select("doc_id", "toxic"), "doc_id", "left").filter(~F.col("toxic").eqNullSafe(0)).select("doc_id", "toxic")


@query("SELECT p_partkey FROM part WHERE NOT (p_size < 10 OR (p_size > 40 AND p_retailprice > 1000))")
def filter_boolean(t: Tables) -> DataFrame:
    return t.part.filter(~((F.col("p_size") < 10) | ((F.col("p_size") > 40) & (F.col("p_retailprice") > 1000)))).select("p_partkey")


@query("SELECT d.doc_id, l.quality IS NULL AS unlabelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR d.source IS NOT NULL")
def filter_null(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.filter("quality is null or source is not null").select("doc_id", F.col("quality").isNull().alias("unlabelled"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def filter_in(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount BETWEEN 0.03 AND 0.05")
def filter_between(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_discount").between(0.03, 0.05)).select("l_orderkey", "l_linenumber", "l_discount")


@query(r"SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%00%1_' OR c_name LIKE 'Customer\%%' ESCAPE '\'")
def filter_like(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_name").like("%00%1_") | F.col("c_name").like("Customer\\%%")).select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment ILIKE '%uild%' OR c_name ILIKE 'CUSTOMER%7'")
def filter_ilike(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment").ilike("%uild%") | F.col("c_name").ilike("CUSTOMER%7")).select("c_custkey")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]{3}\\.[0-9]+') OR regexp_matches(text, 'LICENSED', 'i')")
def filter_regex(t: Tables) -> DataFrame:
    return t.documents.filter(regex_matches("text", r"[0-9]{3}\.[0-9]+") | regex_matches("text", "LICENSED", "i")).select("doc_id")


@query("SELECT s_suppkey, s_name FROM supplier WHERE regexp_full_match(s_name, '.*[02468]')")
def filter_regex_full(t: Tables) -> DataFrame:
    return t.supplier.filter(regex_full_match("s_name", ".*[02468]")).select("s_suppkey", "s_name")


@query("SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1') OR ends_with(p_brand, '3') OR contains(p_name, '99')")
def filter_string_fn(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_brand").startswith("Brand#1") | F.col("p_brand").endswith("3") | F.col("p_name").contains("99")).select("p_partkey", "p_brand")


@query("SELECT p_partkey, upper(p_type) AS u, lower(p_type) AS l FROM part WHERE lower(p_type) = 'promo'")
def filter_case_fn(t: Tables) -> DataFrame:
    return t.part.filter(F.lower("p_type") == "promo").select("p_partkey", F.upper("p_type").alias("u"), F.lower("p_type").alias("l"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_linenumber + 1 AS next, l_quantity / 4 AS quarter FROM lineitem")
def project_arith(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), (F.col("l_linenumber") + 1).alias("next"), (F.col("l_quantity") / 4).alias("quarter"))


@query("SELECT doc_id, substr(text, 1, 12) AS head, octet_length(encode(text))::BIGINT AS bytes, source || '/' || lang AS place, repeat('ab', 2) AS twice FROM documents WHERE text LIKE '%the%'")
def fn_string(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("text").like("%the%")).select("doc_id", F.substring("text", 1, 12).alias("head"), F.octet_length("text").cast("long").alias("bytes"), F.concat("source", F.lit("/"), "lang").alias("place"), F.repeat(F.lit("ab"), 2).alias("twice"))


@query("SELECT o_orderkey, extract(year FROM o_orderdate) AS y, CAST(o_orderdate AS DATE) AS d, o_orderdate + INTERVAL 3 DAY AS later FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'")
def fn_date(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderdate < timestamp'1997-01-01'").select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"), F.to_date("o_orderdate").alias("d"), F.expr("o_orderdate + interval 3 day").alias("later"))


@query("SELECT vec_id, embedding[1]::DOUBLE AS first, len(embedding) AS n, len(list_filter(embedding, lambda x: x > 0)) AS positive FROM embeddings")
def fn_array(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.element_at("embedding", 1).cast("double").alias("first"), F.size("embedding").cast("long").alias("n"), F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("positive"))


@query("SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def fn_json(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
