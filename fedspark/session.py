"""The session: registered objects, cached connections, diagnostics and cancelling."""

from __future__ import annotations

import os
import platform
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .errors import ActiveTransaction, FederationError, TableNotFound, from_remote
from .model import ForeignTable, Server, UserMapping
from .operators.statistics import analyze_table
from .plans.remote_sql import pushed_scan, remote_join
from .sources.scan import scan

VERSION = "0.1.0"


def connect(spark: SparkSession, server: Server, user: UserMapping | None = None):
    """A JDBC connection of the driver process, for statements that aren't reads or appends."""
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    for k, v in (user.properties() if user else {}).items():
        properties.setProperty(k, v)
    try:
        if server.url.startswith("jdbc:derby:"):
            return jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver().connect(server.url, properties)
        return jvm.java.sql.DriverManager.getConnection(server.url, properties)
    except Exception as e:
        raise from_remote(e) from e


class Session:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.servers: dict[str, Server] = {}
        self.users: dict[tuple[str, str], UserMapping] = {}
        self.tables: dict[str, ForeignTable] = {}
        self._connections: dict[tuple, object] = {}
        self._changing = False

    def add(self, *objects: Server | UserMapping | ForeignTable) -> Session:
        for o in objects:
            if isinstance(o, Server):
                self.servers[o.name] = o
            elif isinstance(o, UserMapping):
                self.users[o.server, o.local_user] = o
            else:
                self.tables[o.name] = o
                self.servers.setdefault(o.server.name, o.server)
        return self

    def user_of(self, server: Server, local_user: str = "public") -> UserMapping | None:
        return self.users.get((server.name, local_user)) or self.users.get((server.name, "public"))

    def _named(self, name: str) -> ForeignTable:
        if name not in self.tables:
            raise TableNotFound(f'foreign table "{name}" does not exist')
        return self.tables[name]

    def table(self, name: str, where: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """A foreign table. Conjuncts of where run at the remote, functions included, if they can; the rest
        runs here."""
        t = self._named(name)
        if where is None and columns is None:
            return scan(self.spark, t, self.user_of(t.server))
        return pushed_scan(self.spark, t, self.user_of(t.server), columns, where)

    def join(self, left: str, right: str, on: str, where: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """An inner join of two foreign tables with different column names: one remote query if both are
        of one server and the condition ships, else in Spark."""
        a, b = self._named(left), self._named(right)
        return remote_join(self.spark, a, b, on, self.user_of(a.server), where, columns)

    def analyze(self, name: str, exact: bool = False) -> DataFrame:
        """Statistics by column, from a sample if the table's sample_percent says so."""
        t = self._named(name)
        return analyze_table(self.spark, t, self.user_of(t.server), exact)

    def register(self, *names: str) -> None:
        """Makes foreign tables (all, if none is named) views of Spark SQL."""
        for n in names or self.tables:
            self.table(n).createOrReplaceTempView(n)

    def sql(self, text: str, args: dict | list | None = None) -> DataFrame:
        """A query over registered tables; parameters are bound by name or place."""
        return self.spark.sql(text, args=args) if args else self.spark.sql(text)

    def connection(self, server: Server):
        """The cached connection of a server and login; all of the login counts."""
        user = self.user_of(server)
        key = (server.url, user.identity if user else None)
        held = self._connections.get(key)
        if held is None or held.isClosed():
            held = self._connections[key] = connect(self.spark, server, user)
        return held

    @contextmanager
    def transaction(self, server: Server):
        """Statements on one remote connection: committed at the end, rolled back on an error."""
        c = self.connection(server)
        c.setAutoCommit(False)
        self._changing = True
        try:
            yield c
            c.commit()
        except Exception as e:
            c.rollback()
            raise (from_remote(e) if hasattr(e, "java_exception") else e)
        finally:
            self._changing = False
            c.setAutoCommit(True)

    @contextmanager
    def savepoint(self, connection, name: str):
        """A nested level of a transaction: an error takes back what happened in it and goes on up."""
        point = connection.setSavepoint(name)
        try:
            yield
            connection.releaseSavepoint(point)
        except Exception:
            connection.rollback(point)
            raise

    def close_connections(self) -> int:
        """Closes all cached connections; not while a transaction has changed anything."""
        if self._changing:
            raise ActiveTransaction("connections with an active transaction cannot be closed", "COMMIT or ROLLBACK the transaction first.")
        n = len(self._connections)
        for c in self._connections.values():
            c.close()
        self._connections.clear()
        return n

    def diag(self, server: str | None = None) -> DataFrame:
        """One row of versions and environment; with a server, its product's version too."""
        if server is not None and server not in self.servers:
            raise FederationError(f'server "{server}" does not exist')
        remote = None
        if server and self.servers[server].is_jdbc:
            meta = self.connection(self.servers[server]).getMetaData()
            remote = f"{meta.getDatabaseProductName()} {meta.getDatabaseProductVersion()}"
        shown = ", ".join(f"{k}={os.environ[k]}" for k in ("SPARK_HOME", "JAVA_HOME", "TZ", "LANG") if k in os.environ)
        row = (VERSION, self.spark.version, platform.python_version(), self.spark._jvm.java.lang.System.getProperty("java.version"), remote, shown)
        return self.spark.createDataFrame([row], "engine_version string, spark_version string, python_version string, java_version string, server_version string, environment string")

    @contextmanager
    def cancellable(self, name: str):
        """Jobs in the block belong to a group that cancel(name) ends."""
        self.spark.sparkContext.setJobGroup(name, name, True)
        try:
            yield
        finally:
            self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    def cancel(self, name: str) -> None:
        self.spark.sparkContext.cancelJobGroup(name)
