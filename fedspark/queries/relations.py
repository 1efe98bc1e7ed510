"""Joins, set operations, sorts and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import Tables, query


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000")
def join_inner_equi(t: Tables):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).where("o_totalprice > 200000").select("o_orderkey", "c_name", "o_totalprice")


@query("SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_retailprice > s_acctbal AND p_size < s_nationkey WHERE p_size < 5")
def join_inner_theta(t: Tables):
    # the suppliers are the small side of a range join
    return t.part.where("p_size < 5").join(t.supplier, (F.col("p_retailprice") > F.col("s_acctbal")) & (F.col("p_size") < F.col("s_nationkey"))).select("p_partkey", "s_suppkey")


@query("SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_quantity > 45 AND o_orderstatus = 'F'")
def join_filtered(t: Tables):
    return t.lineitem.where("l_quantity > 45").join(t.orders.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderpriority")


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'")
def join_three_way(t: Tables):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


@query("SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey WHERE a.c_acctbal > 9000 AND b.c_acctbal > 9000")
def join_self(t: Tables):
    rich = t.customer.where("c_acctbal > 9000")
    a, b = rich.alias("a"), rich.alias("b")
    on = (F.col("a.c_nationkey") == F.col("b.c_nationkey")) & (F.col("a.c_mktsegment") == F.col("b.c_mktsegment")) & (F.col("a.c_custkey") < F.col("b.c_custkey"))
    return a.join(b, on).select(F.col("a.c_custkey").alias("a"), F.col("b.c_custkey").alias("b"))


def _outer(t: Tables, how: str):
    on = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_totalprice") > 250000)
    return t.customer.join(t.orders, on, how).select("c_custkey", "o_orderkey")


_OUTER = "SELECT c_custkey, o_orderkey FROM customer {} JOIN orders ON c_custkey = o_custkey AND o_totalprice > 250000"


@query(_OUTER.format("LEFT"))
def join_left(t: Tables):
    return _outer(t, "left")


@query(_OUTER.format("RIGHT"))
def join_right(t: Tables):
    return _outer(t, "right")


@query(_OUTER.format("FULL"))
def join_full(t: Tables):
    return _outer(t, "full")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def join_semi(t: Tables):
    return t.customer.join(t.orders.where("o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def join_anti(t: Tables):
    return t.customer.join(t.orders.where("o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(t: Tables):
    return t.region.crossJoin(t.nation).select("r_name", "n_name")  # tables of fixed size


@query("SELECT c.c_custkey, o.o_orderkey FROM (SELECT c_custkey, nullif(c_custkey, 3) k FROM customer) c JOIN (SELECT o_orderkey, nullif(o_custkey, 3) k FROM orders) o ON c.k IS NOT DISTINCT FROM o.k")
def join_null_safe(t: Tables):
    c = t.customer.select("c_custkey", F.nullif(F.col("c_custkey"), F.lit(3)).alias("ck"))
    o = t.orders.select("o_orderkey", F.nullif(F.col("o_custkey"), F.lit(3)).alias("ok"))
    return c.join(o, F.col("ck").eqNullSafe(F.col("ok"))).select("c_custkey", "o_orderkey")


def _keys(t: Tables):
    return t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.where("s_nationkey < 15").select(F.col("s_nationkey").alias("k"))


_A, _B = "SELECT c_nationkey AS k FROM customer", "SELECT s_nationkey AS k FROM supplier WHERE s_nationkey < 15"


@query(f"{_A} UNION {_B}")
def union(t: Tables):
    a, b = _keys(t)
    return a.union(b).distinct()


@query(f"{_A} UNION ALL {_B}")
def union_all(t: Tables):
    a, b = _keys(t)
    return a.union(b)


@query(f"{_A} INTERSECT {_B}")
def intersect(t: Tables):
    a, b = _keys(t)
    return a.intersect(b)


@query(f"{_A} INTERSECT ALL {_B}")
def intersect_all(t: Tables):
    a, b = _keys(t)
    return a.intersectAll(b)


@query(f"{_A} EXCEPT {_B}")
def except_distinct(t: Tables):
    a, b = _keys(t)
    return a.subtract(b)


@query(f"{_A} EXCEPT ALL {_B}")
def except_all(t: Tables):
    a, b = _keys(t)
    return a.exceptAll(b)


@query("""SELECT v, CAST(row_number() OVER (ORDER BY v ASC NULLS LAST, id) AS BIGINT) AS up, CAST(row_number() OVER (ORDER BY v DESC NULLS FIRST, id) AS BIGINT) AS down
    FROM (SELECT n_nationkey AS id, nullif(n_regionkey, 2) AS v FROM nation) x""")
def order_nulls(t: Tables):
    from pyspark.sql import Window

    rows = t.nation.select(F.col("n_nationkey").alias("id"), F.nullif(F.col("n_regionkey"), F.lit(2)).alias("v"))
    place = lambda *by: F.row_number().over(Window.orderBy(*by)).cast("long")
    return rows.select("v", place(F.col("v").asc_nulls_last(), "id").alias("up"), place(F.col("v").desc_nulls_first(), "id").alias("down"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 10")
def topk(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_first(), "o_orderkey").limit(10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 7 OFFSET 20")
def limit_offset(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(20).limit(7)


@query("SELECT c_custkey, c_name, CAST(row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_name DESC, c_custkey) AS BIGINT) AS place FROM customer")
def order_text(t: Tables):
    from pyspark.sql import Window

    by = Window.partitionBy("c_nationkey", "c_mktsegment").orderBy(F.col("c_name").desc(), "c_custkey")
    return t.customer.select("c_custkey", "c_name", F.row_number().over(by).cast("long").alias("place"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders)")
def subquery_scalar(t: Tables):
    return t.view("orders").sql("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders)")


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def subquery_in(t: Tables):
    return t.view("customer", "nation").sql("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def subquery_exists(t: Tables):
    return t.view("part", "lineitem").sql("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")


@query("SELECT o_orderkey, (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS name FROM orders")
def subquery_correlated(t: Tables):
    return t.view("orders", "customer").sql("SELECT o_orderkey, (SELECT max(c_name) FROM customer WHERE c_custkey = o_custkey) AS name FROM orders")


@query("WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15) SELECT c_name, CAST(n AS BIGINT) AS n FROM big JOIN customer ON c_custkey = o_custkey")
def common_table(t: Tables):
    return t.view("orders", "customer").sql("WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15) SELECT c_name, n FROM big JOIN customer ON c_custkey = o_custkey")
