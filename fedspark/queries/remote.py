"""Queries that run at a remote database: an embedded one, filled from the tables."""

from __future__ import annotations

import uuid

from ..model import Server
from ..operators.imports import import_schema
from ..operators.remote_changes import delete_remote, insert_remote, update_remote
from ..session import Session, connect
from .registry import Tables, query

_TABLES = {
    "NATION": '"N_NATIONKEY" INTEGER NOT NULL PRIMARY KEY, "N_NAME" VARCHAR(25), "N_REGIONKEY" INTEGER',
    "REGION": '"R_REGIONKEY" INTEGER NOT NULL PRIMARY KEY, "R_NAME" VARCHAR(25)',
    "SUPPLIER": '"S_SUPPKEY" BIGINT NOT NULL PRIMARY KEY, "S_NAME" VARCHAR(25), "S_NATIONKEY" INTEGER, "S_ACCTBAL" DOUBLE',
}


def _session(t: Tables, *names: str) -> Session:
    """A session over tables of an embedded database, imported, so that names differ from the remote's."""
    server = Server("embedded", {"dbserver": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"})
    c = connect(t.spark, server)
    c.createStatement().executeUpdate('CREATE SCHEMA "S"')
    for n in names:
        c.createStatement().executeUpdate(f'CREATE TABLE "S"."{n}" ({_TABLES[n]})')
    c.close()
    tables = import_schema(t.spark, server, "S")
    for n in names:
        insert_remote(t.spark, tables[n.lower()], getattr(t, n.lower()).coalesce(1))
    return Session(t.spark).add(server, *tables.values())


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'")
def remote_join(t: Tables):
    return _session(t, "NATION", "REGION").join("nation", "region", "n_regionkey = r_regionkey", where="r_name <> 'ASIA'", columns=["n_name", "r_name"])


@query("SELECT s_suppkey, s_name FROM supplier WHERE upper(substring(s_name, 1, 3)) = 'SUP' AND abs(s_acctbal) > 1000 AND (s_name LIKE '%1' OR trim(s_name) || '!' LIKE '%2!') AND s_name > 'A'")
def remote_filter_functions(t: Tables):
    # the last comparison stays here: text order depends on the collation
    where = "upper(substring(s_name, 1, 3)) = 'SUP' AND abs(s_acctbal) > 1000 AND (s_name LIKE '%1' OR trim(s_name) || '!' LIKE '%2!') AND s_name > 'A'"
    return _session(t, "SUPPLIER").table("supplier", where=where, columns=["s_suppkey", "s_name"])


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 2 THEN 'moved' ELSE n_name END AS n_name FROM nation WHERE n_regionkey <> 4")
def remote_changes(t: Tables):
    s = _session(t, "NATION")
    nation = s.tables["nation"]
    update_remote(t.spark, nation, t.nation.where("n_regionkey = 2").selectExpr("n_nationkey", "'moved' AS n_name"))
    delete_remote(t.spark, nation, t.nation.where("n_regionkey = 4").select("n_nationkey"))
    return s.table("nation").select("n_nationkey", "n_name")


@query("SELECT 'n_nationkey' AS column_name, count(*) AS total_rows, CAST(0 AS DOUBLE) AS null_fraction FROM nation UNION ALL SELECT 'n_name', count(*), CAST(0 AS DOUBLE) FROM nation UNION ALL SELECT 'n_regionkey', count(*), CAST(0 AS DOUBLE) FROM nation")
def remote_analyze(t: Tables):
    return _session(t, "NATION").analyze("nation").select("column_name", "total_rows", "null_fraction")
