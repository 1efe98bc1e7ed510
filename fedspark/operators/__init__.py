"""Changes to tables, import, statistics and savepoints."""

from .changes import Change, delete, insert, truncate, update
from .imports import fold_name, import_schema
from .statistics import analyze
from .versions import VersionedTable

__all__ = ["Change", "VersionedTable", "analyze", "delete", "fold_name", "import_schema", "insert", "truncate", "update"]
