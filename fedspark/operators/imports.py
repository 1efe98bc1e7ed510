"""Import of a remote schema as foreign tables."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .. import types
from ..errors import InvalidOptionValue, SchemaNotFound
from ..model import Column, ForeignTable, Server, UserMapping
from ..sources.scan import remote_rows

CASES = ("keep", "lower", "smart")


def fold_name(name: str, case: str = "smart") -> str:
    """keep: as it is; lower: in lower case; smart: in lower case if the name has no lower-case letter."""
    if case not in CASES:
        raise InvalidOptionValue('invalid value for option "case"', f"Valid values in this context are: {', '.join(CASES)}")
    if case == "keep" or case == "smart" and name != name.upper():
        return name
    return name.lower()


@dataclass(frozen=True)
class RemoteColumn:
    name: str
    type: str
    size: int | None
    scale: int | None
    nullable: bool
    key: bool


def _rows(results):
    while results.next():
        yield results


def _jdbc_tables(connection, schema: str) -> dict[str, list[RemoteColumn]]:
    meta = connection.getMetaData()
    if schema not in {r.getString("TABLE_SCHEM") for r in _rows(meta.getSchemas())}:
        raise SchemaNotFound(f'remote schema "{schema}" does not exist', "Enclose the schema name in double quotes to prevent case folding.")
    tables = [r.getString("TABLE_NAME") for r in _rows(meta.getTables(None, schema, "%", None)) if r.getString("TABLE_TYPE") in ("TABLE", "VIEW")]
    found = {}
    for name in tables:
        keys = {r.getString("COLUMN_NAME") for r in _rows(meta.getPrimaryKeys(None, schema, name))}
        columns = [(r.getInt("ORDINAL_POSITION"), RemoteColumn(r.getString("COLUMN_NAME"), r.getString("TYPE_NAME"), r.getInt("COLUMN_SIZE"), r.getInt("DECIMAL_DIGITS"), r.getInt("NULLABLE") != 0, r.getString("COLUMN_NAME") in keys)) for r in _rows(meta.getColumns(None, schema, name, "%"))]
        found[name] = [c for _, c in sorted(columns, key=lambda x: x[0])]
    return found


def _folder_tables(spark: SparkSession, server: Server) -> dict[str, list[RemoteColumn]]:
    path = spark._jvm.org.apache.hadoop.fs.Path(server.url)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise SchemaNotFound(f'remote schema "{server.url}" does not exist')
    suffix = f".{server.format}"
    names = sorted(n[: -len(suffix)] for x in fs.listStatus(path) if (n := x.getPath().getName()).endswith(suffix))
    found = {}
    for name in names:
        fields = remote_rows(spark, ForeignTable(name, server, {"table": name})).schema.fields
        found[name] = [RemoteColumn(f.name, types.remote_name(f.dataType), getattr(f.dataType, "precision", None), getattr(f.dataType, "scale", None), f.nullable, False) for f in fields]
    return found


def import_schema(spark: SparkSession, server: Server, schema: str | None = None, user: UserMapping | None = None, limit_to: Collection[str] | None = None, exclude: Collection[str] = (), case: str = "smart", readonly: bool | str = False, connection=None) -> dict[str, ForeignTable]:
    """A foreign table for each table and view of a JDBC schema or a folder, by its local name.

    Names fold by case. limit_to and exclude hold local names. Primary keys become key columns, which aren't
    null.
    """
    fold_name("", case)
    if server.is_jdbc:
        from ..session import connect

        own = connection or connect(spark, server, user)
        try:
            found = _jdbc_tables(own, schema)
        finally:
            if connection is None:
                own.close()
    else:
        found = _folder_tables(spark, server)
    out = {}
    for remote, columns in found.items():
        local = fold_name(remote, case)
        if limit_to is not None and local not in limit_to or local in exclude:
            continue
        options = {"table": remote} | ({"schema": schema} if server.is_jdbc and schema else {})
        if str(readonly).lower() in ("true", "on", "yes"):
            options["readonly"] = "true"
        made = tuple(Column(fold_name(c.name, case), types.imported(c.type, c.size, c.scale), {"key": "true"} if c.key else {}, c.nullable and not c.key) for c in columns)
        out[local] = ForeignTable(local, server, options, made)
    return out


def statements(tables: dict[str, ForeignTable]) -> list[str]:
    """What the import amounts to, as CREATE FOREIGN TABLE statements."""

    def options(given) -> str:
        return ", ".join(f"{k} '{str(v).replace(chr(39), chr(39) * 2)}'" for k, v in given.items())

    out = []
    for t in tables.values():
        columns = ", ".join(f'"{c.name}" {c.type.simpleString()}' + (f" OPTIONS ({options(c.options)})" if c.options else "") + ("" if c.nullable else " NOT NULL") for c in t.columns)
        out.append(f'CREATE FOREIGN TABLE "{t.name}" ({columns}) SERVER "{t.server.name}" OPTIONS ({options(t.options)})')
    return out

