"""Scans, projections and filters."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Column
from ..sources.scan import scan
from .registry import Tables, query


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_project(t: Tables):
    return t.customer.select("c_custkey", "c_name", "c_acctbal")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def scan_subquery_table(t: Tables):
    t.view("nation")
    return scan(t.spark, t.foreign("q", table="(SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1)"))


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def count_star(t: Tables):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("SELECT r_regionkey AS id, r_name AS name, CAST(NULL AS VARCHAR) AS extra FROM region")
def surplus_column_null(t: Tables):
    columns = (Column("id", T.IntegerType(), {"key": "true"}), Column("name", T.StringType()), Column("extra", T.StringType()))
    return scan(t.spark, t.foreign("region", columns))


@query("SELECT n_nationkey AS k, n_name AS label FROM nation")
def positional_columns(t: Tables):
    return scan(t.spark, t.foreign("nation", (Column("k", T.LongType()), Column("label", T.StringType()))))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 20 AND l_discount <> 0.05")
def filter_cmp_numeric(t: Tables):
    return t.lineitem.where((F.col("l_quantity") >= 10) & (F.col("l_quantity") < 20) & (F.col("l_discount") != 0.05)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def filter_cmp_date(t: Tables):
    first, last = (F.lit(datetime.datetime(y, 1, 1)).cast("timestamp_ntz") for y in (1996, 1997))
    return t.orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < last)).select("o_orderkey", "o_orderdate")


@query("SELECT c_custkey, c_name FROM customer WHERE c_name > 'Customer#000001000' AND c_mktsegment <= 'FURNITURE'")
def filter_cmp_text(t: Tables):
    return t.customer.where((F.col("c_name") > "Customer#000001000") & (F.col("c_mktsegment") <= "FURNITURE")).select("c_custkey", "c_name")


@query("""SELECT p_partkey, p_size + 1 AS added, p_size - 100 AS subtracted, p_size * 3 AS multiplied, -p_size AS negated, +p_size AS same, p_size % 7 AS remainder, power(p_size, 2) AS powered,
    p_size & 12 AS bits, sqrt(p_size) AS root, abs(p_size - 25) AS absolute, p_size / 4.0e0 AS divided FROM part""")
def arith_ops(t: Tables):
    s = F.col("p_size")
    return t.part.select(
        "p_partkey", (s + 1).alias("added"), (s - 100).alias("subtracted"), (s * 3).alias("multiplied"), (-s).alias("negated"), F.positive(s).alias("same"), (s % 7).alias("remainder"), F.pow(s, F.lit(2)).alias("powered"),
        s.bitwiseAND(12).alias("bits"), F.sqrt(s).alias("root"), F.abs(s - 25).alias("absolute"), (s / 4.0).alias("divided"),
    )


@query("SELECT p_partkey, p_size | 9 AS ored, xor(p_size, 9) AS xored, ~p_size AS inverted, p_size << 2 AS lefted, p_size >> 1 AS righted FROM part")
def bit_ops(t: Tables):
    s = F.col("p_size")
    return t.part.select("p_partkey", s.bitwiseOR(9).alias("ored"), s.bitwiseXOR(9).alias("xored"), F.bitwise_not(s).alias("inverted"), F.shiftleft(s, 2).alias("lefted"), F.shiftright(s, 1).alias("righted"))


@query(r"""SELECT v, v LIKE 'a\_%' ESCAPE '\' AS escaped, v LIKE 'a_c%' AS any_one, v NOT LIKE '%c' AS not_c, v LIKE '100\%' ESCAPE '\' AS percent
    FROM (VALUES ('a_c'), ('abc'), ('a_x'), ('100%'), ('100x'), ('')) x(v)""")
def like_escape(t: Tables):
    v = F.col("v")
    rows = t.spark.createDataFrame([("a_c",), ("abc",), ("a_x",), ("100%",), ("100x",), ("",)], "v string")
    return rows.select("v", v.like(r"a\_%").alias("escaped"), v.like("a_c%").alias("any_one"), (~v.like("%c")).alias("not_c"), v.like(r"100\%").alias("percent"))


@query("SELECT p_partkey, p_name FROM part WHERE p_type LIKE 'P%' OR p_name LIKE '%1'")
def like_filter(t: Tables):
    return t.part.where(F.col("p_type").like("P%") | F.col("p_name").like("%1")).select("p_partkey", "p_name")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment ILIKE 'auto%' AND c_name NOT ILIKE '%5'")
def ilike(t: Tables):
    return t.customer.where(F.col("c_mktsegment").ilike("auto%") & ~F.col("c_name").ilike("%5")).select("c_custkey")


@query("SELECT c_custkey, regexp_matches(c_name, '0[1-4]+$') AS ends FROM customer WHERE regexp_matches(c_name, '[2468]$')")
def regex_match(t: Tables):
    return t.customer.where(F.col("c_name").rlike("[2468]$")).select("c_custkey", F.col("c_name").rlike("0[1-4]+$").alias("ends"))


@query("""SELECT a, b, a AND b AS both, a OR b AS either, NOT a AS negated FROM
    (VALUES (true), (false), (NULL::BOOLEAN)) x(a), (VALUES (true), (false), (NULL::BOOLEAN)) y(b)""")
def bool_logic(t: Tables):
    one = t.spark.createDataFrame([(True,), (False,), (None,)], "a boolean")
    both = one.crossJoin(one.withColumnRenamed("a", "b"))  # three rows by three
    return both.select("a", "b", (F.col("a") & F.col("b")).alias("both"), (F.col("a") | F.col("b")).alias("either"), (~F.col("a")).alias("negated"))


@query("""SELECT b, b IS TRUE AS is_true, b IS NOT TRUE AS not_true, b IS FALSE AS is_false, b IS NULL AS is_unknown FROM (VALUES (true), (false), (NULL::BOOLEAN)) x(b)""")
def boolean_tests(t: Tables):
    rows = t.spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    return rows.selectExpr("b", "b IS TRUE AS is_true", "b IS NOT TRUE AS not_true", "b IS FALSE AS is_false", "b IS UNKNOWN AS is_unknown")


@query("SELECT p_partkey, nullif(p_size, 1) IS NULL AS gone, nullif(p_size, 1) IS NOT NULL AS there FROM part")
def null_tests(t: Tables):
    s = F.nullif(F.col("p_size"), F.lit(1))
    return t.part.select("p_partkey", s.isNull().alias("gone"), s.isNotNull().alias("there"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey NOT IN (1, 2, 3)")
def in_list(t: Tables):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_custkey").isin(1, 2, 3)).select("o_orderkey")


@query("SELECT x, x IN (1, NULL) AS inside, x NOT IN (2, NULL) AS outside FROM (VALUES (1), (2), (NULL::INTEGER)) v(x)")
def not_in_list_null(t: Tables):
    return t.spark.createDataFrame([(1,), (2,), (None,)], "x int").selectExpr("x", "x IN (1, NULL) AS inside", "x NOT IN (2, NULL) AS outside")


@query("SELECT p_partkey, false AS inside, true AS outside FROM part")
def in_empty_list(t: Tables):
    return t.part.select("p_partkey", F.col("p_size").isin([]).alias("inside"), (~F.col("p_size").isin([])).alias("outside"))


@query("SELECT n_nationkey, nullif(n_regionkey, 2) IS DISTINCT FROM nullif(n_nationkey, 2) AS differs FROM nation")
def is_distinct_from(t: Tables):
    a, b = F.nullif(F.col("n_regionkey"), F.lit(2)), F.nullif(F.col("n_nationkey"), F.lit(2))
    return t.nation.select("n_nationkey", (~a.eqNullSafe(b)).alias("differs"))


@query("SELECT p_partkey, nullif(p_brand, 'Brand#11') AS brand FROM part")
def nullif(t: Tables):
    return t.part.select("p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#11")).alias("brand"))


@query("SELECT p_partkey, coalesce(nullif(p_size, 1), nullif(p_size, 2), -1) AS size FROM part")
def coalesce(t: Tables):
    s = F.col("p_size")
    return t.part.select("p_partkey", F.coalesce(F.nullif(s, F.lit(1)), F.nullif(s, F.lit(2)), F.lit(-1)).alias("size"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS class FROM part")
def case_searched(t: Tables):
    s = F.col("p_size")
    return t.part.select("p_partkey", F.when(s < 10, "small").when(s < 30, "medium").otherwise("large").alias("class"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS code FROM orders")
def case_simple(t: Tables):
    return t.orders.select("o_orderkey", F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS code"))


@query("SELECT p_partkey FROM (SELECT p_partkey, p_size > 25 AS big, p_size % 2 AS odd FROM part) x WHERE big AND odd <> 0")
def bool_column(t: Tables):
    flags = t.part.select("p_partkey", (F.col("p_size") > 25).alias("big"), (F.col("p_size") % 2).alias("odd"))
    return flags.where(F.col("big") & (F.col("odd") != 0)).select("p_partkey")


@query("SELECT p_partkey, greatest(p_size, 25) AS most, least(p_size, 25) AS least FROM part")
def greatest_least(t: Tables):
    return t.part.select("p_partkey", F.greatest("p_size", F.lit(25)).alias("most"), F.least("p_size", F.lit(25)).alias("least"))


@query("SELECT s_suppkey FROM supplier WHERE CAST(s_suppkey AS VARCHAR) = '7' OR CAST(s_nationkey AS VARCHAR) LIKE '1%'")
def text_typed_column(t: Tables):
    columns = tuple(Column(f.name, T.StringType()) for f in t.supplier.schema.fields[:3])
    rows = scan(t.spark, t.foreign("supplier", columns), used={"s_suppkey", "s_nationkey"})
    return rows.where((F.col("s_suppkey") == "7") | F.col("s_nationkey").like("1%")).select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"))


@query("SELECT 'it''s' AS quoted, '' AS empty, CAST(1.50 AS DECIMAL(9,2)) AS exact, DATE '2024-02-29' AS day, TIMESTAMP '2024-02-29 12:34:56.789' AS moment, CAST(NULL AS INTEGER) AS nothing")
def constants(t: Tables):
    return t.spark.sql("SELECT 'it\\'s' AS quoted, '' AS empty, CAST(1.50 AS DECIMAL(9,2)) AS exact, DATE '2024-02-29' AS day, TIMESTAMP_NTZ '2024-02-29 12:34:56.789' AS moment, CAST(NULL AS INT) AS nothing")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'O'")
def params(t: Tables):
    args = {"price": 300000.0, "since": datetime.date(1998, 1, 1), "status": "O"}
    return t.view("orders").sql("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > :price AND o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderstatus = :status", args=args)


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 90""")
def json_extract(t: Tables):
    k = F.from_json("props", "k int").getField("k")
    return t.events.select("event_id", k.alias("k")).where("k > 90")


@query("SELECT r_regionkey, r_name AS name FROM region")
def xml_extract(t: Tables):
    as_xml = t.region.select("r_regionkey", F.concat(F.lit("<r><name>"), "r_name", F.lit("</name></r>")).alias("x"))
    return as_xml.select("r_regionkey", F.xpath_string("x", F.lit("r/name")).alias("name"))
