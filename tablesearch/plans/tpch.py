"""Analytic queries over the star schema, as Spark SQL. Where a table here lacks a column of the usual query, the query says
what takes its place; queries whose tables are missing are left out."""

from __future__ import annotations

from .registry import QUERIES, SQL, Tables

NET = "l_extendedprice * (1 - l_discount)"

#: name -> SQL that both Spark and the oracle run; every sum of prices is rounded, since the order of additions differs.
TEXTS = {
    "tpch_q1": f"""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum({NET}), 2) AS sum_disc_price, round(sum({NET} * (1 + l_tax)), 2) AS sum_charge, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus""",
    "tpch_q3": f"""SELECT l_orderkey, round(sum({NET}), 2) AS revenue, o_orderdate FROM customer, orders, lineitem
WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey AND l_orderkey = o_orderkey AND o_orderdate < TIMESTAMP '1998-03-15 00:00:00' AND l_shipdate > TIMESTAMP '1998-03-15 00:00:00'
GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10""",
    # no commit or receipt dates: items shipped over 60 days after the order stand for late ones
    "tpch_q4": """SELECT o_orderpriority, count(*) AS order_count FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-10-01 00:00:00'
AND EXISTS (SELECT * FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL '60' DAY) GROUP BY o_orderpriority ORDER BY o_orderpriority""",
    "tpch_q5": f"""SELECT n_name, round(sum({NET}), 2) AS revenue FROM customer, orders, lineitem, supplier, nation, region
WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_regionkey = 2 AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
GROUP BY n_name ORDER BY revenue DESC, n_name""",
    "tpch_q6": "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1997-01-01 00:00:00' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24",
    "tpch_q7": f"""SELECT supp_nation, cust_nation, l_year, round(sum(volume), 2) AS revenue FROM (
SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation, CAST(year(l_shipdate) AS BIGINT) AS l_year, {NET} AS volume FROM supplier, lineitem, orders, customer, nation n1, nation n2
WHERE s_suppkey = l_suppkey AND o_orderkey = l_orderkey AND c_custkey = o_custkey AND s_nationkey = n1.n_nationkey AND c_nationkey = n2.n_nationkey AND ((n1.n_name = 'NATION_1' AND n2.n_name = 'NATION_2') OR (n1.n_name = 'NATION_2' AND n2.n_name = 'NATION_1'))) AS shipping
GROUP BY supp_nation, cust_nation, l_year ORDER BY supp_nation, cust_nation, l_year""",
    "tpch_q8": f"""SELECT o_year, round(sum(CASE WHEN nation = 'NATION_3' THEN volume ELSE 0 END) / sum(volume), 8) AS mkt_share FROM (
SELECT CAST(year(o_orderdate) AS BIGINT) AS o_year, {NET} AS volume, n2.n_name AS nation FROM part, supplier, lineitem, orders, customer, nation n1, nation n2, region
WHERE p_partkey = l_partkey AND s_suppkey = l_suppkey AND l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n1.n_nationkey AND n1.n_regionkey = r_regionkey AND r_regionkey = 1 AND s_nationkey = n2.n_nationkey AND p_type = 'ECONOMY') AS all_nations GROUP BY o_year ORDER BY o_year""",
    "tpch_q10": f"""SELECT c_custkey, c_name, round(sum({NET}), 2) AS revenue, c_acctbal, n_name FROM customer, orders, lineitem, nation
WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND o_orderdate >= TIMESTAMP '1996-10-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00' AND l_returnflag = 'R' AND c_nationkey = n_nationkey
GROUP BY c_custkey, c_name, c_acctbal, n_name ORDER BY revenue DESC, c_custkey LIMIT 20""",
    # no part-supplier table: value of items by part stands for stock by part
    "tpch_q11": f"""SELECT l_partkey, round(sum({NET}), 2) AS value FROM lineitem, supplier WHERE l_suppkey = s_suppkey AND s_nationkey < 5
GROUP BY l_partkey HAVING sum({NET}) > (SELECT sum({NET}) * 0.0001 FROM lineitem, supplier WHERE l_suppkey = s_suppkey AND s_nationkey < 5) ORDER BY value DESC, l_partkey""",
    # no ship mode: line status takes its place
    "tpch_q12": """SELECT l_linestatus, CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT) AS high, CAST(sum(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT) AS low
FROM orders, lineitem WHERE o_orderkey = l_orderkey AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00' GROUP BY l_linestatus ORDER BY l_linestatus""",
    # no order comments: urgent orders are left out instead
    "tpch_q13": """SELECT c_count, count(*) AS custdist FROM (SELECT c_custkey, count(o_orderkey) AS c_count FROM customer LEFT OUTER JOIN orders ON c_custkey = o_custkey AND o_orderpriority NOT LIKE '1-URG%' GROUP BY c_custkey) AS c_orders GROUP BY c_count ORDER BY custdist DESC, c_count DESC""",
    "tpch_q14": f"SELECT round(100.00 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN {NET} ELSE 0 END) / sum({NET}), 6) AS promo_revenue FROM lineitem, part WHERE l_partkey = p_partkey AND l_shipdate >= TIMESTAMP '1996-09-01 00:00:00' AND l_shipdate < TIMESTAMP '1996-10-01 00:00:00'",
    "tpch_q15": f"""WITH revenue AS (SELECT l_suppkey AS supplier_no, round(sum({NET}), 2) AS total_revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1996-04-01 00:00:00' GROUP BY l_suppkey)
SELECT s_suppkey, s_name, total_revenue FROM supplier, revenue WHERE s_suppkey = supplier_no AND total_revenue = (SELECT max(total_revenue) FROM revenue) ORDER BY s_suppkey""",
    "tpch_q16": """SELECT p_brand, p_type, p_size, count(DISTINCT l_suppkey) AS supplier_cnt FROM lineitem, part WHERE p_partkey = l_partkey AND p_brand <> 'Brand#4' AND p_size IN (1, 4, 9, 14, 19, 23, 36, 45, 49)
AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY p_brand, p_type, p_size ORDER BY supplier_cnt DESC, p_brand, p_type, p_size""",
    # no containers: size takes their place
    "tpch_q17": "SELECT round(sum(l_extendedprice) / 7.0, 4) AS avg_yearly FROM lineitem, part WHERE p_partkey = l_partkey AND p_brand = 'Brand#3' AND p_size < 25 AND l_quantity < (SELECT 0.5 * avg(l_quantity) FROM lineitem WHERE l_partkey = p_partkey)",
    "tpch_q18": """SELECT c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, sum(l_quantity) AS qty FROM customer, orders, lineitem
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200) AND c_custkey = o_custkey AND o_orderkey = l_orderkey GROUP BY c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 100""",
    # no containers, ship modes or instructions: sizes and flags take their place
    "tpch_q19": f"""SELECT round(sum({NET}), 2) AS revenue FROM lineitem, part WHERE (p_partkey = l_partkey AND p_brand = 'Brand#1' AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 15 AND l_returnflag <> 'R')
OR (p_partkey = l_partkey AND p_brand = 'Brand#2' AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 25 AND l_returnflag <> 'R') OR (p_partkey = l_partkey AND p_brand = 'Brand#3' AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 35 AND l_returnflag <> 'R')""",
    # no part-supplier table: suppliers that shipped over half of a part's mean quantity
    "tpch_q20": """SELECT s_name, s_suppkey FROM supplier, nation WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem a WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#1') AND l_quantity > (SELECT 1.9 * avg(l_quantity) FROM lineitem b WHERE b.l_partkey = a.l_partkey))
AND s_nationkey = n_nationkey AND n_regionkey = 1 ORDER BY s_name""",
    # no receipt dates: returned items stand for late ones
    "tpch_q21": """SELECT s_name, count(*) AS numwait FROM supplier, lineitem l1, orders WHERE s_suppkey = l1.l_suppkey AND o_orderkey = l1.l_orderkey AND o_orderstatus = 'F' AND l1.l_returnflag = 'R'
AND EXISTS (SELECT * FROM lineitem l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey) AND NOT EXISTS (SELECT * FROM lineitem l3 WHERE l3.l_orderkey = l1.l_orderkey AND l3.l_suppkey <> l1.l_suppkey AND l3.l_returnflag = 'R')
GROUP BY s_name ORDER BY numwait DESC, s_name LIMIT 100""",
    # no phone numbers: the nation stands for the country code
    # nearly all customers have orders: those without a pending one are taken
    "tpch_q22": """SELECT c_nationkey, count(*) AS numcust, round(sum(c_acctbal), 2) AS totacctbal FROM customer WHERE c_nationkey IN (1, 3, 5, 7, 11, 13, 17) AND c_acctbal > (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal > 0 AND c_nationkey IN (1, 3, 5, 7, 11, 13, 17))
AND NOT EXISTS (SELECT * FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') GROUP BY c_nationkey ORDER BY c_nationkey""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def run(t: Tables, text: str):
    """Spark SQL over the folder's Parquet files."""
    for n in TABLES:
        getattr(t, n).createOrReplaceTempView(n)
    return t.spark.sql(text)


for _name, _text in TEXTS.items():
    QUERIES[_name] = lambda spark, folder, text=_text: run(Tables(spark, folder), text)
    SQL[_name] = _text
