"""Writes and row changes: each query makes a table of its own in the shared folder, changes it and returns what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dml
from ..operators.indexes import ValueIndex, create_index, drop_index, open_index, optimize_index, show_indexes
from ..sources.blobs import blob_uri
from ..sources.snapshots import Namespace, Snapshots
from .registry import Tables, new_folder, query


def _made(t: Tables, name: str, **options) -> Snapshots:
    table = Snapshots(t.spark, new_folder(t))
    table.write(getattr(t, name), **options)
    return table


@query("SELECT * FROM customer")
def copy_roundtrip(t: Tables) -> DataFrame:
    return _made(t, "customer", max_rows_per_file=500).read()


@query("SELECT p_partkey, p_brand || '!' AS brand FROM part WHERE p_size > 10")
def ctas_roundtrip(t: Tables) -> DataFrame:
    space = Namespace(t.spark, new_folder(t))
    space.table("parts").write(t.part.filter("p_size > 10").select("p_partkey", F.concat("p_brand", F.lit("!")).alias("brand")))
    return space.table(space.list_tables()[0]).read()


@query("SELECT * FROM supplier UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def insert_append(t: Tables) -> DataFrame:
    table = _made(t, "supplier")
    table.insert(t.supplier.filter("s_acctbal > 0").withColumn("s_suppkey", F.col("s_suppkey") + 1000000))
    return table.read()


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN 'changed' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def update_rows(t: Tables) -> DataFrame:
    table = _made(t, "orders")
    table.update({"o_totalprice": F.col("o_totalprice") * 2, "o_orderpriority": F.lit("changed")}, "o_orderstatus = 'P'")
    return table.read()


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'middle' ELSE p_type END AS p_type FROM part")
def update_case(t: Tables) -> DataFrame:
    return dml.update(t.part, {"p_type": "case when p_size < 10 then 'small' when p_size < 30 then 'middle' else p_type end"}).select("p_partkey", "p_type")


@query("SELECT * FROM customer WHERE NOT (c_nationkey IN (1, 2, 3) AND c_acctbal < 1000)")
def delete_rows(t: Tables) -> DataFrame:
    table = _made(t, "customer")
    table.delete("c_nationkey in (1, 2, 3) and c_acctbal < 1000")
    return table.read()


@query("""SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_acctbal < 0)
UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, 'NEW' FROM customer WHERE c_custkey % 5 = 0""")
def merge_upsert(t: Tables) -> DataFrame:
    table = _made(t, "customer")
    source = t.customer.filter("c_custkey % 3 = 0").union(t.customer.filter("c_custkey % 5 = 0").withColumn("c_custkey", F.col("c_custkey") + 10000000).withColumn("c_mktsegment", F.lit("NEW")))
    insert = {c: f"s.{c}" for c in source.columns}
    table.merge(source, "t.c_custkey = s.c_custkey", [dml.When(dml.MATCHED, "delete", "t.c_acctbal < 0"), dml.When(dml.MATCHED, "update", None, {"c_acctbal": "t.c_acctbal + 100"}), dml.When(dml.NOT_MATCHED_BY_TARGET, "insert", None, insert)], ["c_custkey"])
    return table.read()


@query("SELECT count(*) AS before, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS after FROM orders")
def time_travel(t: Tables) -> DataFrame:
    table = _made(t, "orders")
    first = table.versions()[-1]
    table.delete("o_orderstatus = 'F'")
    return table.read(first).agg(F.count("*").alias("before")).crossJoin(table.read().agg(F.count("*").alias("after")))  # a row each


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders")
def rowid_projection(t: Tables) -> DataFrame:
    return _made(t, "orders").read(row_ids=True).agg(F.countDistinct("_rowid").alias("n"), F.countDistinct("o_orderkey").alias("ids"))


@query("SELECT count(*) AS n FROM (SELECT r_regionkey FROM region ORDER BY 1 LIMIT 3)")
def rowid_take(t: Tables) -> DataFrame:
    table = _made(t, "region")
    ids = [r[0] for r in table.read(row_ids=True).orderBy("r_regionkey").select("_rowid").limit(3).collect()]
    return table.take([*ids, ids[0], 1 << 60]).agg(F.count("*").alias("n"))


@query("SELECT page_id, html FROM pages WHERE url LIKE '%1%'")
def deferred_fetch(t: Tables) -> DataFrame:
    return _made(t, "pages").deferred(["page_id", "url"], ["html"], "url like '%1%'").select("page_id", "html")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (7, 70, 71)")
def index_btree_lookup(t: Tables) -> DataFrame:
    table = _made(t, "orders")
    return ValueIndex.build(table, "o_custkey").lookup([7, 70, 71]).select("o_orderkey", "o_custkey")


@query("""SELECT 'by_customer' AS name, 'btree' AS kind, 'customer' AS column, count(*) AS indexed_rows, 0 AS unindexed_rows FROM orders
UNION ALL SELECT 'by_status', 'bloomfilter', 'o_orderstatus', count(*), 0 FROM orders UNION ALL SELECT 'late', 'btree', 'o_orderkey', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') FROM region WHERE r_regionkey = 0""")
def index_list(t: Tables) -> DataFrame:
    """Named indexes: one is dropped, one outlives a renamed column; two are brought up to date after an insert, one is not. Shown
    are the rows of the table before the insert, which all cover."""
    table = _made(t, "orders")
    for name, column, kind in (("by_customer", "o_custkey", "btree"), ("by_status", "o_orderstatus", "bloomfilter"), ("late", "o_orderkey", "btree"), ("gone", "o_orderdate", "btree")):
        create_index(table, name, column, kind)
    drop_index(table, "gone")
    table.rename_column("o_custkey", "customer")
    more = table.read().filter("o_orderstatus = 'P'")
    added = more.count()
    table.insert(more)
    for name in ("by_customer", "by_status"):
        optimize_index(table, name)
    return show_indexes(table).withColumn("indexed_rows", F.when(F.col("name") == "late", F.col("indexed_rows")).otherwise(F.col("indexed_rows") - added))


@query("SELECT o_orderkey, o_custkey AS customer FROM orders WHERE o_custkey IN (7, 70, 71) UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (7, 70, 71) AND o_orderstatus = 'P'")
def index_optimized_lookup(t: Tables) -> DataFrame:
    """A named index after a renamed column, an insert and an update of the index."""
    table = _made(t, "orders")
    create_index(table, "by_customer", "o_custkey")
    table.rename_column("o_custkey", "customer")
    table.insert(table.read().filter("o_orderstatus = 'P'"))
    optimize_index(table, "by_customer")
    return open_index(table, "by_customer").lookup([7, 70, 71]).select("o_orderkey", "customer")


@query("""SELECT 'DELETE' AS merge_action, s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 2 = 0 AND s_acctbal < 0 UNION ALL SELECT 'UPDATE', s_suppkey, s_acctbal + 1 FROM supplier WHERE s_suppkey % 2 = 0 AND s_acctbal >= 0
UNION ALL SELECT 'INSERT', s_suppkey + 1000000, s_acctbal FROM supplier WHERE s_suppkey % 3 = 0""")
def merge_returning(t: Tables) -> DataFrame:
    table = _made(t, "supplier", max_rows_per_file=50)
    source = t.supplier.filter("s_suppkey % 2 = 0").union(t.supplier.filter("s_suppkey % 3 = 0").withColumn("s_suppkey", F.col("s_suppkey") + 1000000))
    clauses = [dml.When(dml.MATCHED, "delete", "t.s_acctbal < 0"), dml.When(dml.MATCHED, "update", None, {"s_acctbal": "t.s_acctbal + 1"}), dml.When(dml.NOT_MATCHED_BY_TARGET, "insert", None, {c: f"s.{c}" for c in source.columns})]
    return table.merge_returning(source, "t.s_suppkey = s.s_suppkey", clauses, ["s_suppkey"])[1].select("merge_action", "s_suppkey", "s_acctbal")


@query("SELECT count(*) AS n, count(DISTINCT page_id) AS uris FROM pages")
def blob_uris(t: Tables) -> DataFrame:
    table = _made(t, "pages")
    return table.read(row_ids=True).select(blob_uri(table, "html", F.col("_rowid")).alias("uri")).agg(F.count("uri").alias("n"), F.countDistinct("uri").alias("uris"))


@query("SELECT s_suppkey, s_nationkey AS nation, CAST(s_acctbal AS FLOAT) AS s_acctbal, s_suppkey * 2 AS twice FROM supplier")
def schema_evolution(t: Tables) -> DataFrame:
    table = _made(t, "supplier")
    table.rename_column("s_nationkey", "nation")
    table.drop_column("s_name")
    table.alter_type("s_acctbal", "float")
    table.add_column("twice", "bigint", "s_suppkey * 2")
    return table.read()


@query("SELECT * FROM orders")
def compacted(t: Tables) -> DataFrame:
    table = _made(t, "orders", max_rows_per_file=1000)
    table.compact(target_rows=4000)
    table.vacuum(1)
    return table.read()
