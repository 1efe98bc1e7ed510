"""Changes to tables of a JDBC server, by sets: rows go to a staging table in batches and one statement
moves them, in one transaction with the check of the row counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import FederationError, ReadOnly, RowCountMismatch, from_remote
from ..model import ForeignTable, UserMapping
from ..session import connect
from ..sources.embedded import append
from ..sources.scan import jdbc_options, remote_rows
from ..sources.tables import read_csv


def _guard(table: ForeignTable) -> None:
    if table.readonly:
        raise ReadOnly(f'foreign table "{table.name}" is read-only')


def _remote_names(spark: SparkSession, table: ForeignTable, user: UserMapping | None) -> dict[str, str]:
    """Remote column by local column, met by position."""
    remote = remote_rows(spark, table, user).columns
    return dict(zip([c.name for c in table.columns if not c.dropped], remote)) if table.columns else {c: c for c in remote}


def insert_remote(spark: SparkSession, table: ForeignTable, rows: DataFrame, user: UserMapping | None = None) -> None:
    """Appends rows by name, batch_size rows a round trip, all partitions at once."""
    _guard(table)
    names = _remote_names(spark, table, user)
    out = rows.selectExpr(*(f"`{c}` AS `{names[c]}`" for c in rows.columns))
    options = jdbc_options(table, user) | {"dbtable": table.remote, "batchsize": str(table.effective()["batch_size"])}
    try:
        append(out, options)
    except Exception as e:
        raise from_remote(e) from e


@contextmanager
def _staged(spark: SparkSession, table: ForeignTable, rows: DataFrame, user: UserMapping | None):
    """rows in a new remote table, and a connection in a transaction, rolled back if the block fails."""
    name = f"STAGE_{uuid.uuid4().hex[:16].upper()}"
    schema = table.options.get("schema")
    stage = f'"{schema}"."{name}"' if schema else f'"{name}"'
    options = jdbc_options(table, user) | {"dbtable": stage, "batchsize": str(table.effective()["batch_size"])}
    connection = connect(spark, table.server, user)
    try:
        append(rows, options)
        connection.setAutoCommit(False)
        try:
            yield stage, connection
            connection.commit()
        except Exception as e:
            connection.rollback()
            raise (from_remote(e) if hasattr(e, "java_exception") else e)
    finally:
        connection.setAutoCommit(True)
        there = connection.getMetaData().getTables(None, schema, name, None)
        if there.next():  # a failed write may not have got as far
            connection.createStatement().executeUpdate(f"DROP TABLE {stage}")
        connection.close()


def _one_row_each(connection, stage: str, target: str, on: str, keys: Sequence[str]) -> None:
    """Each change meets just one row and no two meet the same; tested key by key, at the remote."""
    names = ", ".join(f's."{k}"' for k in keys)
    met = f'SELECT {names}, COUNT(t."{keys[0]}") AS "MET" FROM {stage} s LEFT JOIN {target} t ON {on} GROUP BY {names} HAVING COUNT(t."{keys[0]}") <> 1'
    found = connection.createStatement().executeQuery(met)
    try:
        if found.next():
            at = ", ".join(f"{k} = {found.getString(i + 1)}" for i, k in enumerate(keys))
            n = found.getInt(len(keys) + 1)
            raise RowCountMismatch(f"changes at {at} meet {n} rows", f"Check that {', '.join(keys)} identify each row of the remote table and that each is given once.")
    finally:
        found.close()


def update_remote(spark: SparkSession, table: ForeignTable, changes: DataFrame, user: UserMapping | None = None) -> int:
    """Sets the columns of changes that aren't keys, where the keys are equal. Returns the rows changed."""
    _guard(table)
    keys, names = table.require_keys(), _remote_names(spark, table, user)
    sets = [c for c in changes.columns if c not in keys]
    rows = changes.selectExpr(*(f"`{c}` AS `{names[c]}`" for c in changes.columns))
    on = " AND ".join(f't."{names[k]}" = s."{names[k]}"' for k in keys)
    with _staged(spark, table, rows, user) as (stage, connection):
        _one_row_each(connection, stage, table.remote, on, [names[k] for k in keys])
        body = ", ".join(f'"{names[c]}" = (SELECT s."{names[c]}" FROM {stage} s WHERE {on})' for c in sets)
        return connection.createStatement().executeUpdate(f"UPDATE {table.remote} t SET {body} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {on})")


def delete_remote(spark: SparkSession, table: ForeignTable, doomed: DataFrame, user: UserMapping | None = None) -> int:
    _guard(table)
    keys, names = table.require_keys(), _remote_names(spark, table, user)
    rows = doomed.selectExpr(*(f"`{k}` AS `{names[k]}`" for k in keys))
    on = " AND ".join(f't."{names[k]}" = s."{names[k]}"' for k in keys)
    with _staged(spark, table, rows, user) as (stage, connection):
        _one_row_each(connection, stage, table.remote, on, [names[k] for k in keys])
        return connection.createStatement().executeUpdate(f"DELETE FROM {table.remote} t WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {on})")


def copy_remote(spark: SparkSession, table: ForeignTable, path: str, user: UserMapping | None = None, header: bool = True, null: str = "") -> None:
    """COPY: the rows of CSV files into a table, column by column as the table declares them, null where a
    field is null; a row that doesn't fit is an error before anything of its partition is sent."""
    schema = T.StructType([T.StructField(c.name, c.type, c.nullable) for c in table.columns if not c.dropped])
    insert_remote(spark, table, read_csv(spark, path, schema, header, null), user)


def insert_routed(spark: SparkSession, routes: Sequence[tuple[ForeignTable, str]], rows: DataFrame, user: UserMapping | None = None) -> None:
    """Rows of a partitioned table into its parts: each goes to the first table whose condition it meets; a
    row that meets none is an error, found before anything is sent."""
    taken, parts = F.lit(False), []
    for table, condition in routes:
        _guard(table)
        here = F.coalesce(F.expr(condition), F.lit(False))
        parts.append((table, here & ~taken))
        taken = taken | here
    if not rows.where(~taken).isEmpty():
        raise FederationError("no partition of the relation found for a row")
    for table, here in parts:
        insert_remote(spark, table, rows.where(here), user)


def truncate_remote(spark: SparkSession, tables: Sequence[ForeignTable], user: UserMapping | None = None, restart_identity: bool | None = None) -> None:
    """Empties several tables, in order; what is emptied stays empty if a later one fails. restart_identity
    adds the clause on generated numbers; without it the server's default holds."""
    clause = "" if restart_identity is None else f" {'RESTART' if restart_identity else 'CONTINUE'} IDENTITY IMMEDIATE"
    for t in tables:
        _guard(t)
    for t in tables:
        connection = connect(spark, t.server, user)
        try:
            connection.createStatement().executeUpdate(f"TRUNCATE TABLE {t.remote}" + clause)
        except Exception as e:
            raise from_remote(e) from e
        finally:
            connection.close()
