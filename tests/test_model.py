"""Options, types and names: no Spark job needed."""

import pytest
from pyspark.sql import types as T

from fedspark import Column, ForeignTable, Server, UserMapping, Wrapper
from fedspark import types as kinds
from fedspark.errors import FederationError, InvalidOptionName, InvalidOptionValue, NoKey, OptionNotFound, SerializationFailure, TableNotFound, TypeMismatch, by_state
from fedspark.functions.datetimes import interval_text, pattern
from fedspark.operators.imports import fold_name

SERVER = Server("s", {"dbserver": "/data"})


def table(**options):
    return ForeignTable("t", SERVER, {"table": "T"} | options)


def test_unknown_option_names_the_valid_ones():
    with pytest.raises(InvalidOptionName, match='invalid option "nope"\nHINT: Valid options in this context are: dbserver, batch_size'):
        Server("s", {"dbserver": "x", "nope": "1"})


def test_required_options():
    with pytest.raises(OptionNotFound, match='missing required option "dbserver"'):
        Server("s", {})
    with pytest.raises(OptionNotFound, match='missing required option "table"'):
        ForeignTable("t", SERVER, {})


@pytest.mark.parametrize("name,value", [("max_long", "0"), ("max_long", "1073741824"), ("sample_percent", "0"), ("sample_percent", "101"), ("prefetch", "-1"), ("prefetch", "10241"), ("prefetch", "x"), ("batch_size", "0"), ("readonly", "maybe"), ("schema", 'a"b'), ("table", 'a"b')])
def test_values_out_of_range(name, value):
    with pytest.raises(InvalidOptionValue, match=f'invalid value for option "{name}"'):
        table(**{name: value})


@pytest.mark.parametrize("name,value", [("max_long", "1"), ("sample_percent", "0.000001"), ("prefetch", "0"), ("prefetch", "10240"), ("batch_size", "1"), ("readonly", "On"), ("readonly", "no")])
def test_values_at_the_ends(name, value):
    table(**{name: value})


def test_logins():
    assert UserMapping("s", {"user": "u", "password": "p"}).properties() == {"user": "u", "password": "p"}
    assert UserMapping("s", {"jwt_token": "x"}).properties() == {"accessToken": "x"}
    assert UserMapping("s", {"user": "", "password": ""}).properties() == {}
    with pytest.raises(InvalidOptionName, match="cannot specify both"):
        UserMapping("s", {"user": "u", "password": "p", "jwt_token": "x"})
    for options in ({}, {"user": "u"}, {"password": "p"}):
        with pytest.raises(OptionNotFound, match="authentication credentials missing"):
            UserMapping("s", options)
    assert "secret" not in repr(UserMapping("s", {"user": "u", "password": "secret"}))


def test_later_options_win():
    server = Server("s", {"dbserver": "x", "batch_size": "7"}, Wrapper("w", {"no_encoding_error": "on"}))
    assert ForeignTable("t", server, {"table": "T"}).effective()["batch_size"] == 7
    found = ForeignTable("t", server, {"table": "T", "batch_size": "9"}).effective()
    assert (found["batch_size"], found["prefetch"], found["no_encoding_error"], found["sample_percent"]) == (9, 200, True, 100.0)


def test_remote_names_and_queries():
    assert table(schema="S").remote == '"S"."T"'
    query = ForeignTable("q", SERVER, {"table": '(SELECT "a" FROM t)'})
    assert query.is_query and query.remote == '(SELECT "a" FROM t)'


def test_keys():
    keyed = ForeignTable("t", SERVER, {"table": "T"}, (Column("a", T.IntegerType(), {"key": "yes"}), Column("b", T.StringType(), {"no_encoding_error": "on"})))
    assert keyed.require_keys() == ["a"] and keyed.schema()["a"].metadata == {"key": True}
    with pytest.raises(NoKey):
        table().require_keys()


def test_imported_types():
    cases = {"SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint", "BOOLEAN": "boolean", "REAL": "float", "DOUBLE": "double", "FLOAT": "double", "DECFLOAT": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "CLOB": "string", "CHAR": "string", "XML": "string", "BLOB": "binary", "VARBINARY": "binary", "SOMETHING": "string"}
    assert {k: kinds.imported(k).simpleString() for k in cases} == cases
    assert kinds.imported("DECIMAL", 9, 2) == T.DecimalType(9, 2) and kinds.imported("NUMERIC", 31, 4) == T.DecimalType(31, 4)
    assert kinds.imported("TIME").simpleString() == "time(6)"


@pytest.mark.parametrize("remote,local,ok", [("INTEGER", T.DoubleType(), True), ("INTEGER", T.BooleanType(), True), ("DECIMAL", T.IntegerType(), False), ("NUMERIC", T.DecimalType(5, 2), True), ("DOUBLE", T.IntegerType(), False), ("DATE", T.TimestampNTZType(), True), ("TIMESTAMP", T.IntegerType(), False), ("BLOB", T.StringType(), False), ("VARBINARY", T.BinaryType(), True), ("VARCHAR", T.IntegerType(), False), ("INTEGER", T.StringType(), True), ("BOOLEAN", T.IntegerType(), True)])
def test_compatible_types(remote, local, ok):
    assert kinds.compatible(remote, local, scale=2 if remote == "DECIMAL" else 0) is ok
    if not ok:
        with pytest.raises(TypeMismatch):
            kinds.check("c", remote, local, 2)


def test_folding():
    assert [fold_name("ORG", c) for c in ("keep", "lower", "smart")] == ["ORG", "org", "org"]
    assert [fold_name("MixedCase", c) for c in ("keep", "lower", "smart")] == ["MixedCase", "mixedcase", "MixedCase"]
    with pytest.raises(InvalidOptionValue):
        fold_name("x", "upper")


def test_errors_by_state():
    assert isinstance(by_state("40001", None, "x"), SerializationFailure)
    assert isinstance(by_state(None, -911, "x"), SerializationFailure)
    assert isinstance(by_state("42S02", None, "x"), TableNotFound)
    assert type(by_state("22000", None, "x")) is FederationError


def test_interval_text():
    assert interval_text(days=-3) == "-3 DAYS"
    assert interval_text(years=1, months=-2, seconds=0.5) == "1 YEARS - 2 MONTHS + 0.5 SECONDS"
    assert interval_text() == "0 DAYS"


def test_patterns():
    assert pattern("YYYY-MM-DD HH24:MI:SS") == "yyyy-MM-dd HH:mm:ss"
    assert pattern('DD "of" MON') == "dd 'of' MMM"
    with pytest.raises(ValueError):
        pattern("YYYY-WW")
