"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as P
from .registry import Tables, query

_TEXTS = "(VALUES ('foo-bar baz'), ('hELLO wORLD'), ('  padded  '), (''), ('Ångström x1y'), (NULL)) x(s)"
_NUMBERS = "(VALUES (0.5e0), (-0.5e0), (2.5e0), (-2.5e0), (2.57e0), (-2.57e0), (0.0e0), (1234.5678e0), (NULL::DOUBLE)) x(d)"


def _texts(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([("foo-bar baz",), ("hELLO wORLD",), ("  padded  ",), ("",), ("Ångström x1y",), (None,)], "s string")


def _numbers(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(0.5,), (-0.5,), (2.5,), (-2.5,), (2.57,), (-2.57,), (0.0,), (1234.5678,), (None,)], "d double")


@query(f"SELECT d, abs(d) AS a, ceil(d) + 0.0 AS c, floor(d) + 0.0 AS f, round(exp(d / 1000), 12) AS e, sqrt(abs(d)) AS r, CAST(sign(d) AS DOUBLE) AS s, power(abs(d), 2) AS p FROM {_NUMBERS}")
def fn_math(t: Tables):
    d = F.col("d")
    return _numbers(t).select("d", F.abs(d).alias("a"), (P.ceil(d) + 0.0).alias("c"), (F.floor(d).cast("double") + 0.0).alias("f"), F.round(F.exp(d / 1000), 12).alias("e"), F.sqrt(F.abs(d)).alias("r"), P.sign(d).alias("s"), P.power(F.abs(d), F.lit(2)).alias("p"))


@query(f"""SELECT d, round(sin(d), 10) + 0 AS s, round(cos(d), 10) AS c, round(tan(d / 1000), 10) + 0 AS t, round(asin(d / 2000), 10) + 0 AS a, round(acos(d / 2000), 10) AS o, round(atan(d), 10) + 0 AS n, round(atan2(d, 2.0), 10) + 0 AS n2 FROM {_NUMBERS}""")
def fn_trig(t: Tables):
    d = F.col("d")
    r = lambda c, name: (F.round(c, 10) + 0).alias(name)
    return _numbers(t).select("d", r(F.sin(d), "s"), r(F.cos(d), "c"), r(F.tan(d / 1000), "t"), r(F.asin(d / 2000), "a"), r(F.acos(d / 2000), "o"), r(F.atan(d), "n"), r(F.atan2(d, F.lit(2.0)), "n2"))


@query(f"""SELECT d, round_even(d, 0) + 0 AS even, CAST(round(CAST(d AS DECIMAL(18,4)), 0) AS DOUBLE) + 0 AS away, CAST(round(CAST(d AS DECIMAL(18,4)), 1) AS DOUBLE) AS away1, trunc(d) + 0 AS cut, trunc(d * 10) / 10 + 0 AS cut1 FROM {_NUMBERS}""")
def fn_round_trunc(t: Tables):
    d = F.col("d")
    exact = d.cast("decimal(18,4)")
    return _numbers(t).select("d", (P.round_(d, 0, exact=False) + 0).alias("even"), (P.round_(exact).cast("double") + 0).alias("away"), P.round_(exact, 1).cast("double").alias("away1"), (P.trunc(d) + 0).alias("cut"), (P.trunc(d, 1) + 0).alias("cut1"))


@query("SELECT n, m, n % m AS r FROM (VALUES (7, 3), (-7, 3), (7, -3), (-7, -3), (NULL, 3)) x(n, m)")
def fn_mod_sign(t: Tables):
    return t.spark.createDataFrame([(7, 3), (-7, 3), (7, -3), (-7, -3), (None, 3)], "n int, m int").select("n", "m", P.mod("n", "m").alias("r"))


@query(f"SELECT s, CAST(length(s) AS INTEGER) AS chars, CAST(strlen(s) AS INTEGER) AS bytes, CAST(length(rtrim(s, ' ')) AS INTEGER) AS unpadded FROM {_TEXTS}")
def fn_length(t: Tables):
    return _texts(t).select("s", P.length("s").alias("chars"), P.octet_length("s").alias("bytes"), P.length("s", blank_padded=True).alias("unpadded"))


@query(f"SELECT s, coalesce(s, '') || '/' AS joined, s || '/' AS strict FROM {_TEXTS}")
def fn_concat_null(t: Tables):
    return _texts(t).select("s", P.concat("s", F.lit(None).cast("string"), F.lit("/")).alias("joined"), F.concat("s", F.lit("/")).alias("strict"))


@query("SELECT * FROM (VALUES ('foo-bar baz', 'Foo-Bar Baz'), ('hELLO wORLD', 'Hello World'), ('  padded  ', '  Padded  '), ('', ''), ('Ångström x1y', 'Ångström X1y'), (NULL, NULL)) x(s, capped)")
def fn_initcap(t: Tables):
    return _texts(t).select("s", P.initcap("s").alias("capped"))


@query(f"SELECT s, lower(s) AS lo, upper(s) AS up FROM {_TEXTS}")
def fn_case(t: Tables):
    return _texts(t).select("s", F.lower("s").alias("lo"), F.upper("s").alias("up"))


@query(f"SELECT s, lpad(s, 5, '*') AS l, rpad(s, 14, 'ab') AS r, ltrim(s) AS lt, rtrim(s) AS rt, ltrim(s, 'fho ') AS lset, rtrim(s, 'zdD ') AS rset FROM {_TEXTS}")
def fn_pad_trim(t: Tables):
    s = F.col("s")
    return _texts(t).select("s", F.lpad(s, 5, "*").alias("l"), F.rpad(s, 14, "ab").alias("r"), F.ltrim(s).alias("lt"), F.rtrim(s).alias("rt"), F.ltrim(s, F.lit("fho ")).alias("lset"), F.rtrim(s, F.lit("zdD ")).alias("rset"))


@query(f"SELECT s, CAST(position('o' IN s) AS INTEGER) AS p, CAST(strpos(s, 'bar') AS INTEGER) AS q FROM {_TEXTS}")
def fn_position(t: Tables):
    return _texts(t).select("s", P.position("o", "s").alias("p"), P.strpos("s", "bar").alias("q"))


@query(f"SELECT s, replace(s, 'o', '00') AS r, translate(s, 'aol', 'AO') AS t FROM {_TEXTS}")
def fn_replace_translate(t: Tables):
    return _texts(t).select("s", F.replace(F.col("s"), F.lit("o"), F.lit("00")).alias("r"), P.translate("s", "aol", "AO").alias("t"))


@query("""SELECT st, substring('hello', greatest(st, 1), greatest(st + 3 - greatest(st, 1), 0)) AS three, substring('hello', greatest(st, 1)) AS rest FROM (VALUES (-3), (-1), (0), (1), (3), (5), (6), (9)) x(st)""")
def fn_substr_edge(t: Tables):
    rows = t.spark.createDataFrame([(k,) for k in (-3, -1, 0, 1, 3, 5, 6, 9)], "st int")
    return rows.select("st", P.substr(F.lit("hello"), "st", 3).alias("three"), P.substr(F.lit("hello"), "st").alias("rest"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS full_text, strftime(o_orderdate, '%d/%m/%y') AS short, upper(strftime(o_orderdate, '%b')) AS month, strftime(o_orderdate, 'day %j') AS day FROM orders")
def fn_to_char(t: Tables):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", P.to_char(d, "YYYY-MM-DD HH24:MI:SS").alias("full_text"), P.to_char(d, "DD/MM/YY").alias("short"), P.to_char(d, "MON").alias("month"), P.to_char(d, '"day "DDD').alias("day"))


@query("""SELECT s, CAST(strptime(s, '%d.%m.%Y %H:%M:%S') AS DATE) AS d, strptime(s, '%d.%m.%Y %H:%M:%S') AS ts FROM (VALUES ('29.02.2024 23:59:58'), ('01.01.1970 00:00:00'), (NULL)) x(s)""")
def fn_to_date(t: Tables):
    rows = t.spark.createDataFrame([("29.02.2024 23:59:58",), ("01.01.1970 00:00:00",), (None,)], "s string")
    return rows.select("s", P.to_date("s", "DD.MM.YYYY HH24:MI:SS").alias("d"), P.to_timestamp("s", "DD.MM.YYYY HH24:MI:SS").alias("ts"))


@query("SELECT s, CAST(replace(s, ',', '') AS DECIMAL(9,2)) AS n FROM (VALUES ('1,234.50'), ('0,012.25'), (NULL)) x(s)")
def fn_to_number(t: Tables):
    rows = t.spark.createDataFrame([("1,234.50",), ("0,012.25",), (None,)], "s string")
    return rows.select("s", P.to_number("s", "9,999.99").cast("decimal(9,2)").alias("n"))


@query("""SELECT event_id, CAST(date_part('year', ts) AS DOUBLE) AS y, CAST(date_part('month', ts) AS DOUBLE) AS mo, CAST(date_part('day', ts) AS DOUBLE) AS d, CAST(date_part('hour', ts) AS DOUBLE) AS h, CAST(date_part('minute', ts) AS DOUBLE) AS mi, date_part('microsecond', ts) / 1e6 AS s FROM events""")
def fn_date_part(t: Tables):
    p = lambda field, name: P.date_part(field, "ts").alias(name)
    return t.events.select("event_id", p("year", "y"), p("month", "mo"), p("day", "d"), p("hour", "h"), p("minute", "mi"), p("second", "s"))


@query("SELECT to_timestamp(0)::TIMESTAMP AS zero, make_timestamp(1700000000500000) AS half, 0.0e0 AS zone")
def fn_epoch(t: Tables):
    one = t.spark.range(1)
    return one.select(P.epoch_timestamp(F.lit(0)).cast("timestamp_ntz").alias("zero"), P.epoch_timestamp(F.lit(1700000000.5)).cast("timestamp_ntz").alias("half"), P.date_part("timezone_hour", F.timestamp_seconds(F.lit(0))).alias("zone"))


@query("""SELECT d, CAST(d + INTERVAL 1 MONTH AS TIMESTAMP) AS month_on, CAST(d - INTERVAL 1 YEAR AS TIMESTAMP) AS year_back, CAST(d - INTERVAL 36 HOUR AS TIMESTAMP) AS hours_back FROM (VALUES (TIMESTAMP '2024-01-31 10:00:00'), (TIMESTAMP '2024-02-29 00:00:00.5'), (NULL::TIMESTAMP)) x(d)""")
def fn_interval(t: Tables):
    rows = t.spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-31 10:00:00'), (TIMESTAMP_NTZ '2024-02-29 00:00:00.5'), (NULL) x(d)")
    return rows.select("d", P.add_interval("d", months=1).alias("month_on"), P.add_interval("d", years=-1).alias("year_back"), P.add_interval("d", hours=-36).alias("hours_back"))


@query()
def fn_now(t: Tables):
    return t.spark.range(1).select((F.current_date() == P.now().cast("date")).alias("same_day"), (P.now().cast("timestamp_ntz") == F.localtimestamp()).alias("same_moment"), F.current_time().isNotNull().alias("has_time"))
