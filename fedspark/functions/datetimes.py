"""Date and time functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pattern fields of a relational database and what Spark calls them, longest first.
FIELDS = {
    "YYYY": "yyyy", "HH24": "HH", "HH12": "hh", "MONTH": "MMMM", "Month": "MMMM", "SSSSS": None, "MON": "MMM", "Mon": "MMM", "DDD": "DDD", "DAY": "EEEE", "Day": "EEEE",
    "YY": "yy", "MM": "MM", "DD": "dd", "HH": "hh", "MI": "mm", "SS": "ss", "MS": "SSS", "US": "SSSSSS", "DY": "EEE", "Dy": "EEE", "AM": "a", "PM": "a", "TZH": "xxx", "Q": "q",
}
_FIELD = re.compile("|".join(sorted(FIELDS, key=len, reverse=True)) + r'|"[^"]*"|[A-Za-z]+|.', re.S)
#: Fields of date_part.
PARTS = ("year", "month", "day", "hour", "minute", "second")


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pattern(text: str) -> str:
    """A pattern in Spark's letters. Text in double quotes stands for itself; an unknown letter is an
    error."""
    out = []
    for m in _FIELD.finditer(text):
        token = m[0]
        if token in FIELDS and FIELDS[token]:
            out.append(FIELDS[token])
        elif token[0] == '"':
            out.append("'" + token[1:-1].replace("'", "''") + "'")
        elif token.isalpha():
            raise ValueError(f'unknown field "{token}" in pattern "{text}"')
        else:
            out.append("''" if token == "'" else token)
    return "".join(out)


def to_char(value, text: str) -> Column:
    """A date, timestamp or number as text. Month and day names given in capitals come in capitals."""
    if re.fullmatch(r"[90.,SMIGDL]+", text):
        return F.to_char(_col(value), F.lit(text))
    out = F.date_format(_col(value), pattern(text))
    return F.upper(out) if re.search("MONTH|MON|DAY|DY", text) else out


def to_date(value, text: str) -> Column:
    return F.to_date(_col(value), pattern(text))


def to_timestamp(value, text: str) -> Column:
    return F.to_timestamp_ntz(_col(value), F.lit(pattern(text)))


def epoch_timestamp(seconds) -> Column:
    """The one-argument form: seconds since 1970."""
    return F.timestamp_seconds(_col(seconds))


def date_part(field: str, value) -> Column:
    """A double, with the fraction in seconds. The zone fields come from the session's offset."""
    name = field.lower()
    if name in ("timezone_hour", "timezone_minute"):
        offset = F.date_format(_col(value).cast("timestamp"), "xxx")
        sign = F.when(offset.startswith("-"), -1.0).otherwise(1.0)
        digits = F.substring(offset, 2, 2) if name == "timezone_hour" else F.substring(offset, 5, 2)
        return sign * digits.cast("double")
    if name not in PARTS:
        raise ValueError(f'field "{field}" is not one of {", ".join(PARTS)}, timezone_hour, timezone_minute')
    return F.date_part(F.lit(name), _col(value)).cast("double")


def now() -> Column:
    """One time for a whole query."""
    return F.current_timestamp()


def add_interval(value, years: int = 0, months: int = 0, days: int = 0, hours: int = 0, minutes: int = 0, seconds: float = 0.0) -> Column:
    """Each part with its own sign. A day that the month lacks becomes the month's last."""
    moved = _col(value)
    if years or months:
        moved = moved + F.make_ym_interval(F.lit(years), F.lit(months))
    if days or hours or minutes or seconds:
        moved = moved + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(seconds).cast("decimal(18,6)"))
    return moved


def interval_text(years: int = 0, months: int = 0, days: int = 0, hours: int = 0, minutes: int = 0, seconds: float = 0.0) -> str:
    """An interval in remote SQL: every part that isn't zero with its sign; zero is zero days."""
    named = (("YEARS", years), ("MONTHS", months), ("DAYS", days), ("HOURS", hours), ("MINUTES", minutes), ("SECONDS", seconds))
    out = ""
    for unit, n in named:
        if n:
            size = f"{abs(n):f}".rstrip("0").rstrip(".") if isinstance(n, float) else str(abs(n))
            out += (" - " if n < 0 else " + ") + f"{size} {unit}"
    if not out:
        return "0 DAYS"
    return out[3:] if out.startswith(" + ") else "-" + out[3:]
