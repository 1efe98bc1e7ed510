"""Aggregates, windows, statistics and imports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.imports import import_schema
from ..operators.statistics import analyze
from .registry import Tables, query


@query("""SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS quantity, round(avg(l_extendedprice), 4) AS price, min(l_shipdate) AS first, max(l_shipdate) AS last
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_basic(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.avg("l_extendedprice"), 4).alias("price"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


@query("SELECT l_returnflag, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY l_returnflag")
def agg_distinct(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.sum_distinct("l_linenumber").alias("lines"))


@query("SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name DESC) AS names FROM nation GROUP BY n_regionkey")
def agg_ordered(t: Tables):
    names = F.sort_array(F.collect_list("n_name"), asc=False)
    return t.nation.groupBy("n_regionkey").agg(F.array_join(names, ", ").alias("names"))


@query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey HAVING count(*) >= 12")
def agg_having(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).where("n >= 12")


@query("SELECT c_mktsegment, CAST(count(*) FILTER (WHERE c_acctbal < 0) AS BIGINT) AS owing, CAST(count(nullif(c_nationkey, 5)) AS BIGINT) AS others FROM customer GROUP BY c_mktsegment")
def agg_filter(t: Tables):
    return t.customer.groupBy("c_mktsegment").agg(F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("owing"), F.count(F.nullif(F.col("c_nationkey"), F.lit(5))).alias("others"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS most FROM orders WHERE o_totalprice < 0")
def agg_no_rows(t: Tables):
    return t.orders.where("o_totalprice < 0").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("most"))


_GROUPS = "CAST(count(*) AS BIGINT) AS n, CAST(grouping(o_orderstatus) AS INTEGER) AS g1, CAST(grouping(o_orderpriority) AS INTEGER) AS g2 FROM orders GROUP BY"


@query(f"SELECT o_orderstatus, o_orderpriority, {_GROUPS} ROLLUP (o_orderstatus, o_orderpriority)")
def agg_rollup(t: Tables):
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderstatus").cast("int").alias("g1"), F.grouping("o_orderpriority").cast("int").alias("g2"))


@query(f"SELECT o_orderstatus, o_orderpriority, {_GROUPS} CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(t: Tables):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderstatus").cast("int").alias("g1"), F.grouping("o_orderpriority").cast("int").alias("g2"))


@query(f"SELECT o_orderstatus, o_orderpriority, {_GROUPS} GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def agg_grouping_sets(t: Tables):
    return t.view("orders").sql(f"SELECT o_orderstatus, o_orderpriority, {_GROUPS} GROUPING SETS ((o_orderstatus), (o_orderpriority), ())".replace("AS INTEGER", "AS INT"))


@query("""SELECT c_custkey, CAST(row_number() OVER w AS BIGINT) AS rn, CAST(rank() OVER s AS BIGINT) AS rk, CAST(dense_rank() OVER s AS BIGINT) AS dr, CAST(ntile(4) OVER w AS BIGINT) AS nt
    FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey), s AS (PARTITION BY c_mktsegment ORDER BY c_nationkey)""")
def win_ranking(t: Tables):
    w = Window.partitionBy("c_mktsegment").orderBy(F.col("c_acctbal").desc(), "c_custkey")
    s = Window.partitionBy("c_mktsegment").orderBy("c_nationkey")
    return t.customer.select("c_custkey", F.row_number().over(w).cast("long").alias("rn"), F.rank().over(s).cast("long").alias("rk"), F.dense_rank().over(s).cast("long").alias("dr"), F.ntile(4).over(w).cast("long").alias("nt"))


@query("""SELECT o_orderkey, lag(o_totalprice) OVER w AS before, lead(o_totalprice, 2, 0) OVER w AS after, first_value(o_orderkey) OVER w AS first, nth_value(o_orderkey, 2) OVER w AS second,
    last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def win_analytic(t: Tables):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return t.orders.select("o_orderkey", F.lag("o_totalprice").over(w).alias("before"), F.lead("o_totalprice", 2, 0.0).over(w).alias("after"), F.first("o_orderkey").over(w).alias("first"), F.nth_value("o_orderkey", 2).over(w).alias("second"), F.last("o_orderkey").over(whole).alias("last"))


@query("""SELECT event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS near,
    CAST(count(*) OVER (PARTITION BY event_type ORDER BY user_id RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS BIGINT) AS around FROM events""")
def win_frame(t: Tables):
    rows = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    span = Window.partitionBy("event_type").orderBy("user_id").rangeBetween(-5, 5)
    return t.events.select("event_id", F.count(F.lit(1)).over(rows).alias("near"), F.count(F.lit(1)).over(span).alias("around"))


@query("""SELECT 'o_orderkey' AS column_name, CAST(count(*) AS BIGINT) AS total_rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_distinct, CAST(min(o_orderkey) AS VARCHAR) AS min_value, CAST(max(o_orderkey) AS VARCHAR) AS max_value, 0.0e0 AS null_fraction FROM orders
    UNION ALL SELECT 'o_orderstatus', CAST(count(*) AS BIGINT), CAST(count(DISTINCT o_orderstatus) AS BIGINT), min(o_orderstatus), max(o_orderstatus), 0.0e0 FROM orders""")
def analyze_stats(t: Tables):
    return analyze(t.orders.select("o_orderkey", "o_orderstatus"), exact=True).select("column_name", "total_rows", "n_distinct", "min_value", "max_value", "null_fraction")


@query()
def analyze_sample(t: Tables):
    return analyze(t.lineitem, sample_percent=10).select("column_name", "total_rows", "null_fraction", "n_distinct")


@query("""SELECT * FROM (VALUES ('nation', 1, 'n_nationkey', 'int'), ('nation', 2, 'n_name', 'string'), ('nation', 3, 'n_regionkey', 'int'), ('region', 1, 'r_regionkey', 'int'), ('region', 2, 'r_name', 'string')) x(table_name, position, column_name, type)""")
def import_listing(t: Tables):
    found = import_schema(t.spark, t.server, limit_to=["nation", "region"])
    rows = [(n, k + 1, c.name, c.type.simpleString()) for n, f in found.items() for k, c in enumerate(f.columns)]
    return t.spark.createDataFrame(rows, "table_name string, position int, column_name string, type string")
