"""Declarative objects: wrapper, server, user mapping, foreign table and column, with checked options."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import types as T

from .errors import InvalidOptionName, InvalidOptionValue, NoKey, OptionNotFound

TRUE, FALSE = frozenset(["on", "yes", "true"]), frozenset(["off", "no", "false"])
#: Defaults of the tuning options.
DEFAULT_PREFETCH, DEFAULT_BATCH, DEFAULT_SAMPLE, DEFAULT_MAX_LONG = 200, 100, 100.0, 32767


class On(Enum):
    WRAPPER = "wrapper"
    SERVER = "server"
    USER = "user mapping"
    TABLE = "foreign table"
    COLUMN = "column"


@dataclass(frozen=True)
class Option:
    """An option: where it may stand, where it must, and what it may hold."""

    name: str
    on: tuple[On, ...]
    kind: type = str
    least: float | None = None
    most: float | None = None
    required: bool = False
    hint: str = ""

    def parse(self, value: str):
        value = str(value)
        if self.kind is bool:
            if value.lower() in TRUE | FALSE:
                return value.lower() in TRUE
            raise InvalidOptionValue(f'invalid value for option "{self.name}"', "Valid values in this context are: on/yes/true or off/no/false")
        if self.name in ("table", "schema") and '"' in value and not _is_query(value):
            raise InvalidOptionValue(f'invalid value for option "{self.name}"', "Double quotes are not allowed in names.")
        if self.kind is str:
            return value
        try:
            number = self.kind(value)
        except ValueError:
            number = None
        if number is None or self.least is not None and number < self.least or self.most is not None and number > self.most:
            raise InvalidOptionValue(f'invalid value for option "{self.name}"', self.hint)
        return number


def _is_query(value: str) -> bool:
    return value.strip().startswith("(") and value.strip().endswith(")")


OPTIONS = (
    Option("nls_lang", (On.WRAPPER,)),
    Option("dbserver", (On.SERVER,), required=True),
    Option("user", (On.USER,)),
    Option("password", (On.USER,)),
    Option("jwt_token", (On.USER,)),
    Option("schema", (On.TABLE,)),
    Option("table", (On.TABLE,), required=True),
    Option("max_long", (On.TABLE,), int, 1, 1073741823, hint="Valid values in this context are integers between 1 and 1073741823."),
    Option("readonly", (On.TABLE,), bool),
    Option("sample_percent", (On.TABLE,), float, 0.000001, 100, hint="Valid values in this context are numbers between 0.000001 and 100."),
    Option("prefetch", (On.TABLE,), int, 0, 10240, hint="Valid values in this context are integers between 0 and 10240."),
    Option("key", (On.COLUMN,), bool),
    Option("batch_size", (On.SERVER, On.TABLE, On.COLUMN), int, 1, hint="Valid values in this context are integers greater than 0."),
    Option("no_encoding_error", (On.WRAPPER, On.TABLE, On.COLUMN), bool),
)


def checked(on: On, options: Mapping[str, str]) -> dict:
    """Parsed options of an object, or the error that names what is wrong with them."""
    known = {o.name: o for o in OPTIONS if on in o.on}
    for name in options:
        if name not in known:
            raise InvalidOptionName(f'invalid option "{name}"', f"Valid options in this context are: {', '.join(known)}")
    parsed = {name: known[name].parse(value) for name, value in options.items()}
    for o in known.values():
        if o.required and o.name not in parsed:
            raise OptionNotFound(f'missing required option "{o.name}"')
    if on is On.USER:
        named = {"user", "password"} & parsed.keys()
        if "jwt_token" in parsed and named:
            raise InvalidOptionName("cannot specify both jwt_token and user/password authentication", "Use either jwt_token OR user and password, not both.")
        if "jwt_token" not in parsed and len(named) < 2:
            raise OptionNotFound("authentication credentials missing", "Specify either jwt_token OR both user and password.")
    return parsed


@dataclass(frozen=True)
class Wrapper:
    name: str = "federation"
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        checked(On.WRAPPER, self.options)


@dataclass(frozen=True)
class Server:
    """dbserver is a JDBC URL or the root folder of table files (Parquet, or as format says)."""

    name: str
    options: Mapping[str, str]
    wrapper: Wrapper = Wrapper()
    format: str = "parquet"

    def __post_init__(self):
        checked(On.SERVER, self.options)

    @property
    def url(self) -> str:
        return self.options["dbserver"]

    @property
    def is_jdbc(self) -> bool:
        return self.url.startswith("jdbc:")


@dataclass(frozen=True)
class UserMapping:
    server: str
    options: Mapping[str, str]
    local_user: str = "public"

    def __post_init__(self):
        checked(On.USER, self.options)

    def properties(self) -> dict[str, str]:
        """Connection properties. An empty user leaves authentication to the remote's environment."""
        if "jwt_token" in self.options:
            return {"accessToken": self.options["jwt_token"]}
        return {k: self.options[k] for k in ("user", "password") if self.options[k]}

    def __repr__(self) -> str:
        return f"UserMapping({self.server!r}, {', '.join(sorted(self.options))})"

    @property
    def identity(self) -> tuple:
        """All that tells one login from another."""
        return tuple(sorted(self.options.items()))


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    options: Mapping[str, str] = field(default_factory=dict)
    nullable: bool = True
    dropped: bool = False

    def __post_init__(self):
        checked(On.COLUMN, self.options)

    @property
    def is_key(self) -> bool:
        return checked(On.COLUMN, self.options).get("key", False)

    def field(self) -> T.StructField:
        return T.StructField(self.name, self.type, self.nullable, {"key": self.is_key})


@dataclass(frozen=True)
class ForeignTable:
    """A table of a server, or a query of it in parentheses, with its columns as declared here; they meet
    the remote's columns by position."""

    name: str
    server: Server
    options: Mapping[str, str]
    columns: tuple[Column, ...] = ()

    def __post_init__(self):
        checked(On.TABLE, self.options)

    def effective(self) -> dict:
        """Options from wrapper to table, the later winning, with defaults below all."""
        base = {"prefetch": DEFAULT_PREFETCH, "batch_size": DEFAULT_BATCH, "sample_percent": DEFAULT_SAMPLE, "max_long": DEFAULT_MAX_LONG, "readonly": False, "no_encoding_error": False}
        return base | checked(On.WRAPPER, self.server.wrapper.options) | checked(On.SERVER, self.server.options) | checked(On.TABLE, self.options)

    @property
    def is_query(self) -> bool:
        return _is_query(self.options["table"])

    @property
    def remote(self) -> str:
        """What stands in a remote FROM: a quoted name or the query as it is."""
        if self.is_query:
            return self.options["table"].strip()
        parts = [self.options[k] for k in ("schema", "table") if self.options.get(k)]
        return ".".join(f'"{p}"' for p in parts)

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.is_key and not c.dropped]

    @property
    def readonly(self) -> bool:
        return self.effective()["readonly"]

    def require_keys(self) -> list[str]:
        if not self.keys:
            raise NoKey(f'no primary key column specified for foreign table "{self.name}"', 'For UPDATE or DELETE, at least one foreign table column must be marked as primary key column with the option "key".')
        return self.keys

    def schema(self) -> T.StructType:
        return T.StructType([c.field() for c in self.columns if not c.dropped])
