"""Scalar functions with the results of a relational database, as Column builders of built-in functions."""

from .datetimes import add_interval, date_part, epoch_timestamp, interval_text, now, to_char, to_date, to_timestamp
from .numbers import ceil, mod, power, round_, sign, to_number, trunc
from .strings import concat, initcap, length, octet_length, position, strpos, substr, translate, trim_char

__all__ = [
    "add_interval", "ceil", "concat", "date_part", "epoch_timestamp", "initcap", "interval_text", "length", "mod", "now", "octet_length", "position", "power",
    "round_", "sign", "strpos", "substr", "to_char", "to_date", "to_number", "to_timestamp", "translate", "trim_char", "trunc",
]
