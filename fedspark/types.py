"""Remote types: what Spark type each becomes on import, and which other types a column may declare."""

from __future__ import annotations

from pyspark.sql import types as T

from .errors import TypeMismatch

# Remote type names by kind.
TEXT = frozenset(["CHAR", "CHARACTER", "VARCHAR", "LONG VARCHAR", "CLOB", "DBCLOB", "GRAPHIC", "VARGRAPHIC"])
WHOLE = frozenset(["SMALLINT", "INTEGER", "BIGINT"])
EXACT = frozenset(["NUMERIC", "DECIMAL"])
FLOATING = frozenset(["DOUBLE", "REAL", "FLOAT", "DECFLOAT"])
TEMPORAL = frozenset(["DATE", "TIME", "TIMESTAMP", "TIMESTAMP WITH TIME ZONE"])
BYTES = frozenset(["BINARY", "VARBINARY", "LONG VARBINARY", "BLOB"])
MARKUP = frozenset(["XML", "JSON"])
ALIASES = {"INT": "INTEGER", "DOUBLE PRECISION": "DOUBLE", "DEC": "DECIMAL", "CHARACTER VARYING": "VARCHAR", "CHAR VARYING": "VARCHAR", "TIMESTAMP_WITH_TIMEZONE": "TIMESTAMP WITH TIME ZONE", "CHAR FOR BIT DATA": "BINARY", "VARCHAR FOR BIT DATA": "VARBINARY", "CHAR () FOR BIT DATA": "BINARY", "VARCHAR () FOR BIT DATA": "VARBINARY"}
#: Digits that Spark's decimals hold; wider remote numbers become doubles, as do those with no fixed scale.
MAX_DIGITS = 38


def canonical(remote: str) -> str:
    name = " ".join(remote.upper().split())
    return ALIASES.get(name, name)


def imported(remote: str, size: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type that an imported column gets. Text of a fixed or greatest length is a string; the length
    goes into the column's metadata. Unknown types come as text."""
    name = canonical(remote)
    if name in WHOLE:
        return {"SMALLINT": T.ShortType(), "INTEGER": T.IntegerType(), "BIGINT": T.LongType()}[name]
    if name == "BOOLEAN":
        return T.BooleanType()
    if name in EXACT:
        return T.DecimalType(size or 31, scale or 0) if (size or 31) <= MAX_DIGITS else T.DoubleType()
    if name == "REAL":
        return T.FloatType()
    if name in FLOATING:
        return T.DoubleType()
    if name == "DATE":
        return T.DateType()
    if name == "TIME":
        return T.TimeType(6)
    if name == "TIMESTAMP":
        return T.TimestampNTZType()
    if name == "TIMESTAMP WITH TIME ZONE":
        return T.TimestampType()
    if name in BYTES:
        return T.BinaryType()
    return T.StringType()


def compatible(remote: str, local: T.DataType, scale: int = 0) -> bool:
    """Whether a column of a remote type may be declared as a local type."""
    name = canonical(remote)
    text = isinstance(local, (T.StringType, T.CharType, T.VarcharType))
    if name in BYTES:
        return isinstance(local, T.BinaryType)
    if text:
        return True  # every value that isn't bytes has a text form
    if name in WHOLE | EXACT | FLOATING | {"BOOLEAN"}:
        if isinstance(local, (T.DecimalType, T.FloatType, T.DoubleType)):
            return name != "BOOLEAN"
        if isinstance(local, (T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            return name in WHOLE | {"BOOLEAN"} or name in EXACT and scale <= 0
        return False
    if name in TEMPORAL:
        return isinstance(local, (T.DateType, T.TimestampType, T.TimestampNTZType, T.TimeType))
    return False


def check(column: str, remote: str, local: T.DataType, scale: int = 0) -> None:
    if not compatible(remote, local, scale):
        raise TypeMismatch(f'column "{column}" of type {local.simpleString()} cannot be converted to or from remote type {canonical(remote)}')


def remote_name(kind: T.DataType) -> str:
    """The remote type that stands for a Spark type when no remote says what it has."""
    names = {T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.BooleanType: "BOOLEAN", T.FloatType: "REAL", T.DoubleType: "DOUBLE", T.DateType: "DATE", T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.TimestampNTZType: "TIMESTAMP", T.BinaryType: "BLOB", T.StringType: "VARCHAR", T.DecimalType: "DECIMAL"}
    if isinstance(kind, T.TimeType):
        return "TIME"
    return names.get(type(kind), "CLOB")

