"""Errors, with the SQLSTATE that a relational client expects."""

from __future__ import annotations


class FederationError(Exception):
    """sqlstate and, if there is one, a hint on how to go on."""

    sqlstate = "HV000"

    def __init__(self, message: str, hint: str | None = None):
        super().__init__(message if hint is None else f"{message}\nHINT: {hint}")
        self.message, self.hint = message, hint


class InvalidOptionName(FederationError):
    sqlstate = "HV00D"


class InvalidOptionValue(FederationError):
    sqlstate = "HV024"


class OptionNotFound(FederationError):
    sqlstate = "HV00J"


class TypeMismatch(FederationError):
    sqlstate = "HV004"


class TableNotFound(FederationError):
    sqlstate = "HV00R"


class SchemaNotFound(FederationError):
    sqlstate = "HV00Q"


class ConnectionFailed(FederationError):
    sqlstate = "HV00N"


class SerializationFailure(FederationError):
    sqlstate = "40001"


class ReadOnly(FederationError):
    sqlstate = "55000"


class NoKey(FederationError):
    sqlstate = "HV000"


class RowCountMismatch(FederationError):
    """A statement by key changed other than one row for each input row."""


class ActiveTransaction(FederationError):
    sqlstate = "25001"


#: States and vendor codes of a remote that say that a transaction lost against another.
LOST_STATES = frozenset(["40001"])
LOST_CODES = frozenset([-911, -913])
#: States of an object that isn't there.
MISSING_STATES = frozenset(["42704", "42S02", "42X05"])


def from_remote(error: Exception) -> FederationError:
    """The error class for a failure of a remote database, told by its state and code if it has them."""
    java = getattr(error, "java_exception", None)
    while java is not None and not hasattr(java, "getSQLState"):
        java = java.getCause()
    state = code = None
    text = str(error).splitlines()[0] if str(error) else type(error).__name__
    if java is not None and "SQLException" in java.getClass().getName() or java is not None and _is_sql(java):
        state, code, text = java.getSQLState(), java.getErrorCode(), java.getMessage()
    return by_state(state, code, text)


def _is_sql(java) -> bool:
    kind = java.getClass()
    while kind is not None:
        if kind.getName() == "java.sql.SQLException":
            return True
        kind = kind.getSuperclass()
    return False


def by_state(state: str | None, code: int | None, text: str) -> FederationError:
    if state in LOST_STATES or code in LOST_CODES:
        return SerializationFailure(text)
    if state in MISSING_STATES:
        return TableNotFound(text)
    if state and state.startswith("08"):
        return ConnectionFailed(text)
    found = FederationError(text)
    if state:
        found.sqlstate = state
    return found
