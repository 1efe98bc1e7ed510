"""The registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..model import Column, ForeignTable, Server
from ..sources.scan import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader; sql is what a relational database runs for the same rows."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


class Tables:
    """Foreign tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.server = Server("files", {"dbserver": root})

    def foreign(self, name: str, columns: tuple[Column, ...] = (), **options: str) -> ForeignTable:
        return ForeignTable(name, self.server, {"table": name} | options, columns)

    def __getattr__(self, name: str) -> DataFrame:
        return scan(self.spark, self.foreign(name))

    def view(self, *names: str) -> SparkSession:
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
        return self.spark
