"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _int(x) -> Column:
    return F.lit(x) if isinstance(x, int) else _col(x)


def concat(*values) -> Column:
    """Nulls count as empty, so the result is never null."""
    return F.concat_ws("", *(_col(v).cast("string") for v in values))


def initcap(text) -> Column:
    """The first letter of every run of letters and digits upper, the rest lower."""
    runs = F.regexp_extract_all(_col(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")


def length(text, blank_padded: bool = False) -> Column:
    """Characters; of a blank-padded column those before the padding."""
    return F.char_length(trim_char(text) if blank_padded else _col(text))


def octet_length(text) -> Column:
    return F.octet_length(_col(text))


def trim_char(text) -> Column:
    """A fixed-length value without its blank padding."""
    return F.rtrim(_col(text))


def position(part, text) -> Column:
    """Where part first occurs, from 1; 0 if it doesn't."""
    return F.locate(part, _col(text)) if isinstance(part, str) else F.instr(_col(text), part)


def strpos(text, part: str) -> Column:
    return position(part, text)


def substr(text, start, count=None) -> Column:
    """Positions before 1 exist but hold nothing: they use up count. A negative count is an error."""
    text, start = _col(text), _int(start)
    first = F.greatest(start, F.lit(1))
    if count is None:
        return F.substring(text, first, F.greatest(F.char_length(text), F.lit(0)))
    count = _int(count)
    rest = F.greatest(start + count - first, F.lit(0))
    checked = F.when(count < 0, F.raise_error(F.lit("negative substring length not allowed")).cast("int")).otherwise(rest)
    return F.substring(text, first, checked)


def translate(text, source: str, target: str) -> Column:
    """Characters of source by those of target at the same place; those without one go."""
    return F.translate(_col(text), source, target)
