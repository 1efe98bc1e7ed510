"""Changes: each query returns the table after the statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.changes import delete, insert, truncate, update
from .registry import Tables, query


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey + 100, 'NEW ' || n_name, NULL FROM nation WHERE n_regionkey = 0")
def dml_insert(t: Tables):
    new = t.nation.where("n_regionkey = 0").select((F.col("n_nationkey") + 100).alias("n_nationkey"), F.concat(F.lit("NEW "), "n_name").alias("n_name"))
    return insert(t.nation, new).table


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey FROM nation")
def dml_update_key(t: Tables):
    changes = t.nation.where("n_regionkey = 1").select("n_nationkey", F.lower("n_name").alias("n_name"))
    return update(t.nation, changes, ["n_nationkey"]).table


@query("SELECT CASE WHEN n_nationkey < 5 THEN n_nationkey + 500 ELSE n_nationkey END AS n_nationkey, n_name, n_regionkey FROM nation")
def dml_update_pk_change(t: Tables):
    changes = t.nation.where("n_nationkey < 5").select("n_nationkey", (F.col("n_nationkey") + 500).alias("new_key"))
    return update(t.nation, changes, ["n_nationkey"], new_keys={"n_nationkey": "new_key"}).table


@query("SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 0.0e0 ELSE o_totalprice END AS o_totalprice FROM orders")
def dml_update_composite(t: Tables):
    keys = ["o_custkey", "o_orderkey"]
    changes = t.orders.where("o_orderpriority LIKE '1%'").select(*keys, F.lit(0.0).alias("o_totalprice"))
    return update(t.orders.select(*keys, "o_totalprice"), changes, keys).table


@query("SELECT n_nationkey, lower(n_name) AS n_name, n_regionkey FROM nation WHERE n_regionkey = 1")
def dml_update_returning(t: Tables):
    changes = t.nation.where("n_regionkey = 1").select("n_nationkey", F.lower("n_name").alias("n_name"))
    return update(t.nation, changes, ["n_nationkey"]).returning


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0")
def dml_delete_key(t: Tables):
    return delete(t.supplier, t.supplier.where("s_acctbal < 0"), ["s_suppkey"]).table.select("s_suppkey", "s_name")


@query("SELECT * FROM region WHERE false")
def dml_truncate(t: Tables):
    return truncate(t.region).table


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def dml_ctas(t: Tables):
    name = "fedspark_ctas_nation"
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    t.nation.write.mode("overwrite").saveAsTable(name)
    return t.spark.table(name)
