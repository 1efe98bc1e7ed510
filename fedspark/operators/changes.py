"""INSERT, UPDATE, DELETE and TRUNCATE by key, copy on write: from a table and a change to the new table.

Each is one lazy plan. The rows that a statement returns (RETURNING) are a DataFrame beside the new
table. The check that each input row meets just one row of the table is one aggregation over the
keys, run before anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import FederationError, NoKey, RowCountMismatch


@dataclass(frozen=True)
class Change:
    """table: all rows after the statement. returning: the affected rows, as they are after an insert or
    update and as they were before a delete."""

    table: DataFrame
    returning: DataFrame
    statement: str


def keys_of(df: DataFrame, keys: Sequence[str] | None = None) -> list[str]:
    """keys, or the columns that the schema's metadata marks as key."""
    found = list(keys) if keys else [f.name for f in df.schema.fields if f.metadata.get("key")]
    if not found:
        raise NoKey("no primary key column specified", 'For UPDATE or DELETE, at least one column must be marked with the option "key".')
    return found


def _as(rows: DataFrame, like: DataFrame) -> DataFrame:
    """rows by name in the order and with the types of like; a column that rows lack is null."""
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields))


def insert(table: DataFrame, rows: DataFrame) -> Change:
    """All columns are sent, by name; one that rows lacks is null, one that the table lacks is an error."""
    extra = set(rows.columns) - set(table.columns)
    if extra:
        raise FederationError(f"columns of the new rows that the table lacks: {', '.join(sorted(extra))}")
    new = _as(rows, table)
    names = ", ".join(f'"{c}"' for c in table.columns)
    return Change(table.unionByName(new), new, f"INSERT INTO t ({names}) VALUES ({', '.join('?' * len(table.columns))})")


def check_one_row_each(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> None:
    """Every row of changes meets just one row of table, and no two meet the same."""
    ours = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__asked"))
    theirs = table.join(ours, list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("__there"))
    wrong = ours.join(theirs, list(keys), "left").where("__asked <> 1 or coalesce(__there, 0) <> 1")
    first = wrong.first()
    if first is not None:
        at = ", ".join(f"{k} = {first[k]}" for k in keys)
        raise RowCountMismatch(f"{first['__asked']} changes meet {first['__there'] or 0} rows at {at}", "Check that the key columns identify each row of the remote table.")


def update(table: DataFrame, changes: DataFrame, keys: Sequence[str] | None = None, new_keys: dict[str, str] | None = None, check: bool = True) -> Change:
    """Sets the columns of changes that aren't keys, in the rows that their keys name.

    new_keys maps a key to the column of changes with its new value. Keys with a null meet nothing, as in
    SQL. changes is small against the table as a rule; which side is sent around is Spark's choice by
    size.
    """
    keys = keys_of(table, keys)
    new_keys = new_keys or {}
    assigned = [c for c in changes.columns if c not in keys and c not in new_keys.values()]
    unknown = set(assigned) - set(table.columns)
    if unknown:
        raise FederationError(f"columns to set that the table lacks: {', '.join(sorted(unknown))}")
    if not assigned and not new_keys:
        raise FederationError("no columns to set")
    if check:
        check_one_row_each(table, changes, keys)
    c = changes.select(*(F.col(k).alias(f"__k_{k}") for k in keys), *(F.col(x).alias(f"__n_{x}") for x in assigned), *(F.col(v).alias(f"__n_{k}") for k, v in new_keys.items()), F.lit(True).alias("__hit"))
    on: Column = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"__k_{k}"))
    joined = table.join(c, on, "left")
    changed = {*assigned, *new_keys}

    def value(f):
        if f.name not in changed:
            return F.col(f.name)
        return F.when(F.col("__hit"), F.col(f"__n_{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)

    sets = ", ".join(f'"{x}" = ?' for x in (*assigned, *new_keys))
    where = " AND ".join(f'"{k}" = ?' for k in keys)
    fields = table.schema.fields
    return Change(joined.select(*map(value, fields)), joined.where("__hit").select(*map(value, fields)), f"UPDATE t SET {sets} WHERE {where}")


def delete(table: DataFrame, doomed: DataFrame, keys: Sequence[str] | None = None, check: bool = True) -> Change:
    """Drops the rows that the keys in doomed name."""
    keys = keys_of(table, keys)
    if check:
        check_one_row_each(table, doomed, keys)
    names = doomed.select(*keys)
    return Change(table.join(names, keys, "left_anti").select(*table.columns), table.join(names, keys, "left_semi").select(*table.columns), f"DELETE FROM t WHERE {' AND '.join(f'"{k}" = ?' for k in keys)}")


def truncate(table: DataFrame, restart_identity: bool = False) -> Change:
    """No rows are left. Like every TRUNCATE it can't be taken back within a transaction."""
    mode = "RESTART" if restart_identity else "CONTINUE"
    return Change(table.limit(0), table.limit(0), f"TRUNCATE TABLE t DROP STORAGE IGNORE DELETE TRIGGERS {mode} IDENTITY IMMEDIATE")
