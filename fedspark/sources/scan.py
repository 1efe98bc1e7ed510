"""The foreign scan: a lazy DataFrame with the schema that a foreign table declares."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types
from ..errors import TableNotFound
from ..model import Column, ForeignTable, UserMapping
from .embedded import brought, is_apart
from .tables import read_table


def jdbc_options(table: ForeignTable, user: UserMapping | None) -> dict[str, str]:
    options = {"url": table.server.url} | (user.properties() if user else {})
    if table.server.url.startswith("jdbc:derby:"):
        options["driver"] = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    return options


def jdbc_rows(spark: SparkSession, table: ForeignTable, options: dict[str, str], moved: bool) -> DataFrame:
    """A JDBC read. moved: with rows, not for the schema alone; an embedded database's that executors don't
    reach are read at once."""
    rows = spark.read.format("jdbc").options(**options).load()
    return brought(spark, options, rows) if moved and is_apart(spark, table.server.url) else rows


def remote_rows(spark: SparkSession, table: ForeignTable, user: UserMapping | None = None, partition: dict | None = None, as_types: str | None = None, moved: bool = False) -> DataFrame:
    """The remote's rows under the remote's own names; without moved, a JDBC server's for their schema.

    Rows per round trip are the table's prefetch. partition: Spark's partitionColumn, lowerBound,
    upperBound and numPartitions, to read a large table in parallel. as_types: types to read some
    columns as, in Spark's customSchema.
    """
    options = jdbc_options(table, user)
    if not table.server.is_jdbc:
        if table.is_query:
            return spark.sql(table.options["table"].strip()[1:-1])
        try:
            return read_table(spark, table.server.url, table.options["table"], table.server.format)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                raise TableNotFound(f'remote table "{table.options["table"]}" for foreign table "{table.name}" does not exist or does not allow read access') from e
            raise
    source = f"{table.remote} q" if table.is_query else table.remote
    options |= {"dbtable": source, "fetchsize": str(table.effective()["prefetch"])} | ({"customSchema": as_types} if as_types else {})
    return jdbc_rows(spark, table, options | {k: str(v) for k, v in (partition or {}).items()}, moved)


_WHOLE = (T.ShortType, T.IntegerType, T.LongType)


def _narrower(remote: DataFrame, columns: tuple[Column, ...]) -> str | None:
    """Whole numbers are read as the declared type at once: a cast over the scan would keep filters local."""
    live = [c for c in columns if not c.dropped]
    pairs = [(f, c) for f, c in zip(remote.schema.fields, live) if f.dataType != c.type and isinstance(f.dataType, _WHOLE) and isinstance(c.type, _WHOLE)]
    return ", ".join(f"`{f.name}` {c.type.simpleString()}" for f, c in pairs) or None


def as_type(value, source: T.DataType, wanted: T.DataType):
    """A remote value as the declared type. A remote's time of day is read as a time on the first day."""
    if source == wanted:
        return value
    if isinstance(wanted, T.TimeType) and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return F.call_function("to_time", F.date_format(value, "HH:mm:ss.SSSSSS")).cast(wanted)
    return value.cast(wanted)


def conform(remote: DataFrame, columns: tuple[Column, ...], used: set[str] | None = None, mend: bool = False) -> DataFrame:
    """remote with the declared columns, met by position; each keeps the remote's name in its metadata. mend
    puts the replacement character for bytes of text that are no UTF-8.

    A declared column beyond the remote's last gives a warning and nulls; a dropped one gives nothing but
    holds its place no more. Types are checked for the columns in used (all, if None) and cast so that a
    value that doesn't fit is an error.
    """
    live = [c for c in columns if not c.dropped]
    out = []
    for k, c in enumerate(live):
        if used is not None and c.name not in used:
            continue
        if k >= len(remote.columns):
            warnings.warn(f'column "{c.name}" has no counterpart in the remote table and is null', stacklevel=2)
            out.append(F.lit(None).cast(c.type).alias(c.name, metadata={"key": c.is_key}))
            continue
        source = remote.schema.fields[k]
        scale = source.dataType.scale if isinstance(source.dataType, T.DecimalType) else 0
        types.check(c.name, types.remote_name(source.dataType), c.type, scale)
        value = as_type(F.col(f"`{source.name}`"), source.dataType, c.type)
        if mend and isinstance(c.type, T.StringType):
            value = F.make_valid_utf8(value)
        out.append(value.alias(c.name, metadata={"key": c.is_key, "remote": source.name}))
    return remote.select(*out)


def scan(spark: SparkSession, table: ForeignTable, user: UserMapping | None = None, used: set[str] | None = None, partition: dict | None = None, moved: bool = True) -> DataFrame:
    """A foreign table's rows. Nothing is read before an action; then Catalyst prunes columns and pushes
    filters and limits through the projection into the source. An embedded database's rows, where
    executors don't reach it, are those of the call; moved: not for the schema alone."""
    rows = remote_rows(spark, table, user, partition)
    as_types = _narrower(rows, table.columns) if table.server.is_jdbc else None
    if as_types or moved and table.server.is_jdbc and is_apart(spark, table.server.url):
        rows = remote_rows(spark, table, user, partition, as_types, moved)
    return conform(rows, table.columns, used, bool(table.effective().get("no_encoding_error"))) if table.columns else rows


def describe(spark: SparkSession, table: ForeignTable, user: UserMapping | None = None) -> DataFrame:
    """position, name, type, nullable of the remote's columns; reads no rows."""
    fields = remote_rows(spark, table, user).schema.fields
    rows = [(k + 1, f.name, f.dataType.simpleString(), f.nullable) for k, f in enumerate(fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")
