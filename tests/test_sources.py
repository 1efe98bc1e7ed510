"""A remote database: an embedded one stands in for it."""

import datetime
import json
import os
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fedspark import Column, ForeignTable, Server, Session, UserMapping
from fedspark.errors import ActiveTransaction, FederationError, ReadOnly, RowCountMismatch, SchemaNotFound, TableNotFound
from fedspark.operators.imports import import_schema, statements
from fedspark.operators.remote_changes import copy_remote, delete_remote, insert_remote, insert_routed, truncate_remote, update_remote
from fedspark.plans import explain_scan, join_sql, order_sql, scan_sql, split_filter
from fedspark.plans.remote_sql import pushed_scan, remote_join
from fedspark.session import connect
from fedspark.sources import describe, scan

ORG = [(10, "Head Office", 160, "Corporate", "New York"), (15, "New England", 50, "Eastern", "Boston"), (20, "Mid Atlantic", 10, "Eastern", "Washington"), (38, "South Atlantic", 30, "Eastern", "Atlanta"), (42, "Great Lakes", 100, "Midwest", "Chicago"), (51, "Plains", 140, "Midwest", "Dallas"), (66, "Pacific", 270, "Western", "San Francisco"), (84, "Mountain", 290, "Western", "Denver")]
SALES = [("LUCCHESSI", 1), ("LEE", 3), ("GOUNOT", None), ("LEE", 8), ("NOBODY", 2)]
COLUMNS = tuple(Column(n, t, {"key": "true"} if n == "deptnumb" else {}) for n, t in [("deptnumb", T.ShortType()), ("deptname", T.StringType()), ("manager", T.ShortType()), ("division", T.StringType()), ("location", T.StringType())])


@pytest.fixture()
def remote(spark):
    server = Server("sample", {"dbserver": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "batch_size": "3"})
    c = connect(spark, server)
    run = c.createStatement().executeUpdate
    run('CREATE SCHEMA "APP1"')
    run('CREATE TABLE "APP1"."ORG" ("DEPTNUMB" SMALLINT NOT NULL PRIMARY KEY, "DEPTNAME" VARCHAR(14), "MANAGER" SMALLINT, "DIVISION" VARCHAR(10), "LOCATION" VARCHAR(13))')
    run('CREATE TABLE "APP1"."SALES" ("SALES_DATE" DATE, "SALES_PERSON" VARCHAR(15), "Amount" INTEGER)')
    run('CREATE TABLE "APP1"."EMPLOYEE" ("EMPNO" CHAR(6) NOT NULL PRIMARY KEY, "LASTNAME" VARCHAR(15) NOT NULL, "SALARY" DECIMAL(9,2))')
    run('CREATE VIEW "APP1"."EAST" AS SELECT "DEPTNUMB", "DEPTNAME" FROM "APP1"."ORG" WHERE "DIVISION" = \'Eastern\'')
    for n, name, boss, division, place in ORG:
        run(f"""INSERT INTO "APP1"."ORG" VALUES ({n}, '{name}', {boss}, '{division}', '{place}')""")
    for person, amount in SALES:
        run(f"""INSERT INTO "APP1"."SALES" VALUES (DATE('2006-03-29'), '{person}', {'NULL' if amount is None else amount})""")
    for no, name in (("000110", "LUCCHESSI"), ("000330", "LEE"), ("000340", "GOUNOT")):
        run(f"""INSERT INTO "APP1"."EMPLOYEE" VALUES ('{no}', '{name}', 100.50)""")
    c.close()
    return server


def org(server, **options):
    return ForeignTable("org", server, {"schema": "APP1", "table": "ORG"} | options, COLUMNS)


def plain(server, name):
    return ForeignTable(name.lower(), server, {"schema": "APP1", "table": name})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_scan(spark, remote):
    df = scan(spark, org(remote))
    assert rows(df) == ORG and df.dtypes[0] == ("deptnumb", "smallint")
    assert scan(spark, org(remote)).count() == 8
    assert [r["name"] for r in describe(spark, org(remote)).collect()] == ["DEPTNUMB", "DEPTNAME", "MANAGER", "DIVISION", "LOCATION"]


def test_filters_and_columns_reach_the_remote(spark, remote):
    df = scan(spark, org(remote)).where("manager > 100").select("deptnumb")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(MANAGER,100)" in plan and "DEPTNAME" not in plan
    assert rows(df) == [(r[0],) for r in ORG if r[2] > 100]


def test_a_query_as_table(spark, remote):
    q = ForeignTable("q", remote, {"table": '(SELECT "DEPTNAME" FROM "APP1"."ORG" WHERE "DIVISION" = \'Western\')'})
    assert rows(scan(spark, q)) == [("Mountain",), ("Pacific",)]


def test_surplus_column_is_null(spark, remote):
    wide = ForeignTable("org", remote, {"schema": "APP1", "table": "ORG"}, (*COLUMNS, Column("extra", T.DateType())))
    with pytest.warns(UserWarning, match="extra"):
        assert {r["extra"] for r in scan(spark, wide).collect()} == {None}


def test_types_are_checked_for_used_columns_only(spark, remote):
    bad = ForeignTable("org", remote, {"schema": "APP1", "table": "ORG"}, (COLUMNS[0], Column("deptname", T.IntegerType())))
    assert scan(spark, bad, used={"deptnumb"}).count() == 8
    with pytest.raises(Exception, match="deptname"):
        scan(spark, bad)


def test_parallel_scan(spark, remote):
    df = scan(spark, org(remote), partition={"partitionColumn": "DEPTNUMB", "lowerBound": 0, "upperBound": 90, "numPartitions": 3})
    assert df.rdd.getNumPartitions() == 3 and rows(df) == ORG


def test_import(spark, remote):
    found = import_schema(spark, remote, "APP1")
    assert sorted(found) == ["east", "employee", "org", "sales"]
    assert found["org"].keys == ["deptnumb"] and not found["org"].columns[0].nullable
    assert [c.name for c in found["sales"].columns] == ["sales_date", "sales_person", "Amount"]
    assert found["employee"].columns[2].type == T.DecimalType(9, 2)
    assert sorted(import_schema(spark, remote, "APP1", limit_to=["org"], readonly="true")) == ["org"]
    assert sorted(import_schema(spark, remote, "APP1", exclude=["ORG", "EAST"], case="keep")) == ["EMPLOYEE", "SALES"]
    assert import_schema(spark, remote, "APP1", readonly=True)["org"].readonly
    assert "OPTIONS (key 'true') NOT NULL" in statements({"org": found["org"]})[0]
    with pytest.raises(SchemaNotFound):
        import_schema(spark, remote, "NOWHERE")


def test_join_ships(spark, remote):
    left, right = plain(remote, "EMPLOYEE"), plain(remote, "SALES")
    a, b = scan(spark, left), scan(spark, right)
    text = join_sql(a, left.remote, b, right.remote, "LASTNAME = SALES_PERSON", where="Amount > 2")
    assert '("APP1"."EMPLOYEE" r1 INNER JOIN "APP1"."SALES" r2 ON (r1."LASTNAME" = r2."SALES_PERSON")' in text
    df = remote_join(spark, left, right, "LASTNAME = SALES_PERSON", where="Amount > 2")
    assert sorted((r["LASTNAME"], r["Amount"]) for r in df.collect()) == [("LEE", 3), ("LEE", 8)]
    assert "INNER JOIN" in df._jdf.queryExecution().toString()
    local = remote_join(spark, left, right, "LASTNAME = SALES_PERSON", where="LASTNAME < 'M'")
    assert local.count() == 4


@pytest.mark.parametrize("predicate", ["MANAGER > 100", "DEPTNAME LIKE 'M%'", "MANAGER % 20 = 10 AND DIVISION <> 'Eastern'", "MANAGER IN (10, 30, 270)", "abs(MANAGER - 150) < 60", "upper(DIVISION) = 'WESTERN'", "CASE WHEN MANAGER > 100 THEN 1 ELSE 0 END = 1", "NOT (DIVISION = 'Eastern' OR MANAGER IS NULL)", "coalesce(MANAGER, 0) * 2 >= 280",
    "DEPTNAME = 'null' OR MANAGER = 10", "DEPTNAME IN ('null', 'Plains')", "DEPTNAME LIKE 'M!%%' ESCAPE '!' OR DEPTNAME LIKE '%t!_x' ESCAPE '!' OR DEPTNAME LIKE 'M%' ESCAPE '!'", "substring(DEPTNAME, 0, 2) = 'Mo'", "substring(DEPTNAME, 2) = 'lains'", "substring(DEPTNAME, 1, 3) = 'Mid'",
    "DEPTNAME || '-' || DIVISION = 'Plains-Midwest'", "concat(DIVISION, LOCATION) = 'EasternBoston'", "trim(DIVISION) = 'Eastern'", "ltrim(rtrim(LOCATION)) = 'Dallas'"])
def test_remote_filter_equals_local(spark, remote, predicate):
    t = plain(remote, "ORG")
    df = scan(spark, t)
    text, shipped = scan_sql(df, t.remote, where=predicate)
    assert not shipped.local
    query = ForeignTable("q", remote, {"table": f"({text})"})
    assert rows(scan(spark, query)) == rows(df.where(predicate))


@pytest.mark.parametrize("predicate,why", [("DEPTNAME > 'M'", "collation"), ("DEPTNAME = ''", "empty string"), ("MANAGER / 2 > 5", "no remote form"), ("substring(DEPTNAME, -2) = 'ns'", "from the end"), ("date_format(DATE'2024-01-02', 'EEE') = DEPTNAME", "field EEE"), ("DEPTNAME RLIKE 'M'", "no remote form")])
def test_what_stays_local(spark, remote, predicate, why):
    found = split_filter(scan(spark, plain(remote, "ORG")), f"MANAGER > 1 AND {predicate}")
    assert len(found.remote) >= 1 and len(found.local) == 1 and why in found.local[0][1]


@pytest.fixture()
def times(spark, remote):
    c = connect(spark, remote)
    run = c.createStatement().executeUpdate
    run('CREATE TABLE "APP1"."TIMES" ("ID" INTEGER NOT NULL PRIMARY KEY, "T" TIME, "D" DATE, "TS" TIMESTAMP, "C6" CHAR(6))')
    run("""INSERT INTO "APP1"."TIMES" VALUES (1, TIME('12:34:56'), DATE('2024-02-29'), TIMESTAMP('2024-02-29 12:34:56.789'), 'ab'), (2, TIME('00:00:00'), DATE('1999-12-31'), TIMESTAMP('1999-12-31 23:59:59'), 'abc'), (3, NULL, NULL, NULL, NULL)""")
    c.close()
    return import_schema(spark, remote, "APP1", limit_to=["times"])["times"]


@pytest.mark.parametrize("predicate", ["t = TIME'12:34:56'", "d >= DATE'2000-01-01'", "ts < TIMESTAMP_NTZ'2024-02-29 12:34:56.790'", "year(d) = 2024", "month(d) = 12 AND day(d) = 31", "hour(ts) = 23 OR minute(ts) = 34", "c6 = 'ab    '", "c6 <> 'ab    '"])
def test_pushed_scan_of_times(spark, remote, times, predicate):
    df = scan(spark, times)
    assert df.dtypes[1] == ("t", "time(6)") and [r["t"] for r in df.orderBy("id").collect()] == [datetime.time(12, 34, 56), datetime.time(0, 0), None]
    out = pushed_scan(spark, times, where=predicate)
    assert out.dtypes == df.dtypes and rows(out.select("id")) == rows(df.where(predicate).select("id"))
    assert " WHERE " in out._jdf.queryExecution().toString()


def test_texts_that_ship(spark, times):
    df = scan(spark, times)
    text = lambda p: split_filter(df, p).remote[0]
    assert text("d + INTERVAL 14 MONTHS > DATE'2024-01-01'") == """(("D" + 1 YEARS + 2 MONTHS) > DATE('2024-01-01'))"""
    assert '("TS" + -1 DAYS - 2 HOURS)' in text("ts + INTERVAL '-1 02' DAY TO HOUR > ts")
    assert text("date_format(ts, 'yyyy-MM-dd HH:mm:ss') = 'x'") == """(TO_CHAR("TS", 'YYYY-MM-DD HH24:MI:SS') = 'x')"""
    assert text("lpad(c6, 8, '*') = initcap(c6)") == """(LPAD("C6", 8, '*') = INITCAP("C6"))"""
    assert text("d < current_date()") == '("D" < CURRENT DATE)'
    assert "ESCAPE '\\'" in text("c6 LIKE 'a%'") and "ESCAPE '!'" in text("c6 LIKE 'a!%' ESCAPE '!'")


def test_imported_names_ship(spark, remote):
    found = import_schema(spark, remote, "APP1")
    s = Session(spark).add(remote, *found.values())
    df = s.table("org", where="manager > 100 AND upper(deptname) LIKE 'M%' AND deptname > 'A'", columns=["deptnumb", "deptname"])
    assert rows(df) == [(84, "Mountain")] and df.columns == ["deptnumb", "deptname"]
    plan = df._jdf.queryExecution().toString()
    assert 'UPPER("DEPTNAME") LIKE' in plan.replace(" (", "(").replace("(UPPER", "UPPER") and '"DEPTNUMB" AS "deptnumb"' in plan
    joined = s.join("employee", "sales", "lastname = sales_person", columns=["empno", "lastname", "Amount"])
    assert rows(joined.select("lastname", "Amount").where("Amount is not null")) == [("LEE", 3), ("LEE", 8), ("LUCCHESSI", 1)]
    assert "INNER JOIN" in joined._jdf.queryExecution().toString() and joined.schema["empno"].metadata["remote"] == "EMPNO"
    assert s.join("employee", "sales", "lastname = sales_person AND lastname < 'M'").count() == 4
    assert s.analyze("org").count() == 5


def test_copy_and_routed_insert(spark, remote, tmp_path):
    t = org(remote)
    (tmp_path / "new.csv").write_text("deptnumb,deptname,manager,division,location\n91,One,1,East,Here\n92,Two,,East,There\n")
    copy_remote(spark, t, str(tmp_path / "new.csv"))
    assert rows(scan(spark, t).where("deptnumb > 90")) == [(91, "One", 1, "East", "Here"), (92, "Two", None, "East", "There")]
    new = spark.createDataFrame([(93, "a"), (94, "b")], "deptnumb short, deptname string")
    insert_routed(spark, [(t, "deptname = 'a'"), (org(remote), "deptname = 'b'")], new)
    assert scan(spark, t).count() == 12
    with pytest.raises(FederationError, match="no partition"):
        insert_routed(spark, [(t, "deptname = 'a'")], new)
    (tmp_path / "bad.csv").write_text("deptnumb,deptname,manager,division,location\nx,One,1,East,Here\n")
    with pytest.raises(Exception):
        copy_remote(spark, t, str(tmp_path / "bad.csv"))


def test_each_change_meets_one_row(spark, remote):
    t = org(remote)
    with pytest.raises(RowCountMismatch, match="DEPTNUMB = 10 meet 2"):  # as many rows as changes in all
        update_remote(spark, t, spark.createDataFrame([(10, "x"), (10, "y")], "deptnumb short, deptname string"))
    assert scan(spark, t).where("deptname in ('x', 'y')").count() == 0
    c = connect(spark, remote)
    left = c.getMetaData().getTables(None, "APP1", "STAGE%", None)
    assert not left.next()


def test_long_values(spark, remote):
    c = connect(spark, remote)
    c.createStatement().executeUpdate('CREATE TABLE "APP1"."LOBS" ("ID" INTEGER, "C" CLOB, "X" BLOB)')
    t = ForeignTable("lobs", remote, {"schema": "APP1", "table": "LOBS"}, (Column("id", T.IntegerType()), Column("c", T.StringType()), Column("x", T.BinaryType())))
    sizes = [0, 1, 8191, 8192, 8193, 100_000]
    insert_remote(spark, t, spark.createDataFrame([(n, "é" * n, bytearray(b"\x00\xff" * n)) for n in sizes], "id int, c string, x binary"))
    got = {r["id"]: (r["c"], bytes(r["x"])) for r in scan(spark, t).collect()}
    assert got == {n: ("é" * n, b"\x00\xff" * n) for n in sizes}


def test_sort_and_empty_projection(spark, remote):
    df = scan(spark, plain(remote, "ORG"))
    assert order_sql(df, [("MANAGER", True, False)]) == '"MANAGER" ASC NULLS LAST'
    assert order_sql(df, [("MANAGER", True, False), ("DEPTNAME", True, False)]) is None
    assert "'1' FROM" in scan_sql(df, '"APP1"."ORG"', columns=[])[0]
    assert scan_sql(df, '"APP1"."ORG"', for_update=True)[0].endswith("FOR UPDATE")
    told = explain_scan(df, '"APP1"."ORG"', ["DEPTNUMB"], "MANAGER > 1 AND DEPTNAME > 'M'", [("DEPTNUMB", False, True)])
    assert "Remote query: SELECT /*" in told and "Local filter: " in told and "Physical Plan" in told


def test_insert_update_delete_truncate(spark, remote):
    t = org(remote)
    insert_remote(spark, t, spark.createDataFrame([(90 + k, f"New {k}") for k in range(7)], "deptnumb short, deptname string"))
    assert scan(spark, t).count() == 15
    assert update_remote(spark, t, spark.createDataFrame([(10, "Main"), (90, None)], "deptnumb short, deptname string")) == 2
    assert {r["deptname"] for r in scan(spark, t).where("deptnumb in (10, 90)").collect()} == {"Main", None}
    with pytest.raises(RowCountMismatch):
        update_remote(spark, t, spark.createDataFrame([(10, "x"), (7777, "y")], "deptnumb short, deptname string"))
    assert scan(spark, t).where("deptname = 'x'").count() == 0
    assert delete_remote(spark, t, spark.createDataFrame([(90 + k,) for k in range(7)], "deptnumb short")) == 7
    assert scan(spark, t).count() == 8
    truncate_remote(spark, [t])
    assert scan(spark, t).count() == 0


def test_readonly(spark, remote):
    t = org(remote, readonly="true")
    new = spark.createDataFrame([(1,)], "deptnumb short")
    for f in (insert_remote, update_remote, delete_remote):
        with pytest.raises(ReadOnly):
            f(spark, t, new)
    with pytest.raises(ReadOnly):
        truncate_remote(spark, [t])


def test_session(spark, remote):
    s = Session(spark).add(remote, org(remote))
    s.register()
    assert s.sql("SELECT count(*) AS n FROM org WHERE division = :d", {"d": "Eastern"}).first()["n"] == 3
    assert s.diag("sample").first()["server_version"].startswith("Apache Derby")
    c = s.connection(remote)
    assert s.connection(remote) is c
    with pytest.raises(ZeroDivisionError), s.transaction(remote) as c:
        c.createStatement().executeUpdate('DELETE FROM "APP1"."ORG"')
        with pytest.raises(ActiveTransaction):
            s.close_connections()
        raise ZeroDivisionError
    assert scan(spark, org(remote)).count() == 8
    with s.transaction(remote) as c:
        c.createStatement().executeUpdate('DELETE FROM "APP1"."ORG" WHERE "DEPTNUMB" = 10')
        try:
            with s.savepoint(c, "inner"):
                c.createStatement().executeUpdate('DELETE FROM "APP1"."ORG"')
                raise KeyError
        except KeyError:
            pass
    assert scan(spark, org(remote)).count() == 7
    assert s.close_connections() == 1
    with pytest.raises(TableNotFound):
        s.table("nothing")
    other = Session(spark).add(remote, UserMapping("sample", {"user": "a", "password": "b"}))
    assert other.user_of(remote).identity != UserMapping("sample", {"jwt_token": "x"}).identity


def test_missing_file_table(spark):
    with pytest.raises(TableNotFound):
        scan(spark, ForeignTable("t", Server("f", {"dbserver": "/root/testdata/sf0.001"}), {"table": "nothing"}))


def test_types_of_values(spark, remote):
    c = connect(spark, remote)
    c.createStatement().executeUpdate('CREATE TABLE "APP1"."ALL" ("I" INTEGER, "B" BIGINT, "D" DOUBLE, "R" REAL, "N" DECIMAL(18,4), "DT" DATE, "TS" TIMESTAMP, "C" CLOB, "X" BLOB, "O" BOOLEAN)')
    c.createStatement().executeUpdate("""INSERT INTO "APP1"."ALL" VALUES (1, 9000000000, 0.5, 0.25, 12345678901234.5678, DATE('2024-02-29'), TIMESTAMP('2024-02-29 12:34:56.789'), CAST('x' AS CLOB), CAST(X'00ff' AS BLOB), true)""")
    c.createStatement().executeUpdate('INSERT INTO "APP1"."ALL" ("I") VALUES (NULL)')
    t = import_schema(spark, remote, "APP1", limit_to=["all"])["all"]
    found = sorted(scan(spark, t).collect(), key=lambda r: r["i"] is None)
    assert tuple(found[1]) == (None,) * 10
    assert found[0]["dt"] == datetime.date(2024, 2, 29) and found[0]["ts"] == datetime.datetime(2024, 2, 29, 12, 34, 56, 789000) and bytes(found[0]["x"]) == b"\x00\xff" and found[0]["o"] is True
    assert scan(spark, t).agg(F.sum("n")).first()[0] == found[0]["n"]


CLUSTER = """
import json, sys
from pyspark.sql import SparkSession
import __spark_entry__
folder = sys.argv[1]
spark = (SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.executor.memory", "1g").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
    .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", folder + "/shared").config("spark.sql.warehouse.dir", folder + "/warehouse").getOrCreate())
from fedspark.sources import embedded
embedded._BATCH = 7
found = {n: sorted(list(map(list, q(spark, "/root/testdata/sf0.001").collect()))) for n, q in __spark_entry__.queries().items() if n.startswith("remote_")}
print("ROWS", json.dumps(found), flush=True)
spark.stop()
"""


def test_embedded_remote_on_a_cluster(spark, tmp_path):
    """F2 to F5: executors that are other processes don't reach an embedded database; the driver moves its rows,
    in several batches here."""
    from fedspark.queries import QUERIES

    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")]), "SPARK_SCALA_VERSION": "2.13"}
    run = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    said = [x for x in run.stdout.splitlines() if x.startswith("ROWS ")]
    assert said, run.stderr[-3000:]
    found = json.loads(said[0][5:])
    assert sorted(found) == ["remote_analyze", "remote_changes", "remote_filter_functions", "remote_join"]
    for name, got in found.items():
        assert got == sorted(map(list, QUERIES[name](spark, "/root/testdata/sf0.001").collect())), name
