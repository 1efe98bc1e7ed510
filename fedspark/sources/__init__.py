"""Readers: files, JDBC and the foreign scan over either."""

from .scan import conform, describe, scan
from .tables import read_csv, read_table

__all__ = ["conform", "describe", "read_csv", "read_table", "scan"]
