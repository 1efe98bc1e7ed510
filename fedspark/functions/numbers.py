"""Numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ceil(value, kind: str = "double") -> Column:
    """The result has the type of the argument, which kind names."""
    return F.ceil(_col(value)).cast(kind)


def mod(a, b) -> Column:
    """The sign of the dividend."""
    return _col(a) % _col(b)


def power(a, b) -> Column:
    return F.pow(_col(a), _col(b))


def round_(value, digits: int = 0, exact: bool = True) -> Column:
    """Exact numbers round half away from zero, floating ones half to even."""
    return F.round(_col(value), digits) if exact else F.bround(_col(value), digits)


def sign(value, kind: str = "double") -> Column:
    return F.signum(_col(value)).cast(kind)


def trunc(value, digits: int = 0) -> Column:
    """Towards zero, at digits after the point. The decimal that a double prints as is what is cut, so
    2.3 doesn't become 2.2 at one digit."""
    value = _col(value)
    scale = F.lit(10.0) ** digits
    exact = value.cast("decimal(38,12)")
    shifted = exact * F.pow(F.lit(10), F.lit(digits)).cast("decimal(18,6)")
    cut = F.when(value >= 0, F.floor(shifted)).otherwise(F.ceil(shifted))
    return cut.cast("double") / scale


#: Number patterns by their letters here and there.
def to_number(text, pattern: str) -> Column:
    """Patterns of 9 0 . , S MI and a trailing sign, read as Spark's."""
    return F.to_number(_col(text), F.lit(pattern))
