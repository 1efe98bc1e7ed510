"""Tables as folders of versions: atomic commits, savepoints and rollback without locks.

A version is a folder of Parquet files that never changes; the newest one with a marker is the table. Each
attempt to write a version has a folder of its own, which the marker names, so a writer that dies or loses
leaves a folder that nobody reads and touches no other's. The marker is made by a create that fails if
another writer was first, so of two commits on one version one loses and says so.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..errors import FederationError, ReadOnly, SerializationFailure
from .changes import Change, delete, insert, truncate, update


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), readonly: bool = False):
        self.spark, self.path, self.keys, self.readonly = spark, path.rstrip("/"), list(keys), readonly
        self.savepoints: list[tuple[str, int]] = []

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    @property
    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        fs, at = self._at("commits")
        if not fs.exists(at):
            return 0
        return max((int(x.getPath().getName()) for x in fs.listStatus(at)), default=0)

    def _folder(self, version: int) -> str:
        fs, marker = self._at(f"commits/{version:08d}")
        stream = fs.open(marker)
        try:
            return f"{self.path}/{bytes(stream.readAllBytes()).decode()}"
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        n = self.version if version is None else version
        if n == 0:
            raise FederationError(f"{self.path} has no version yet")
        return self.spark.read.parquet(self._folder(n))

    def commit(self, df: DataFrame, on: int | None = None) -> int:
        """Writes df as the next version after on (the newest, if None)."""
        if self.readonly:
            raise ReadOnly(f"table {self.path} is read-only")
        base = self.version if on is None else on
        fs, marker = self._at(f"commits/{base + 1:08d}")
        if fs.exists(marker):
            raise SerializationFailure(f"version {base + 1} of {self.path} was committed meanwhile")
        name = f"v{base + 1:08d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        try:
            stream = fs.create(marker, False)
        except Exception as e:
            attempt = self._at(name)[1]
            fs.delete(attempt, True)
            raise SerializationFailure(f"version {base + 1} of {self.path} was committed meanwhile") from e
        stream.write(name.encode())
        stream.close()
        return base + 1

    def _apply(self, make: Callable[[DataFrame], Change]) -> Change:
        if self.readonly:
            raise ReadOnly(f"table {self.path} is read-only")
        base = self.version
        change = make(self.read(base))
        self.commit(change.table, base)
        return change

    def insert(self, rows: DataFrame) -> Change:
        return self._apply(lambda t: insert(t, rows))

    def update(self, changes: DataFrame, new_keys: dict[str, str] | None = None) -> Change:
        return self._apply(lambda t: update(t, changes, self.keys, new_keys))

    def delete(self, doomed: DataFrame) -> Change:
        return self._apply(lambda t: delete(t, doomed, self.keys))

    def truncate(self) -> Change:
        return self._apply(truncate)

    def savepoint(self, name: str) -> None:
        self.savepoints.append((name, self.version))

    def release(self, name: str) -> None:
        self._find(name)
        while self.savepoints.pop()[0] != name:
            pass

    def rollback(self, name: str) -> int:
        """Makes the savepoint's version the newest again, by a new commit; later savepoints go."""
        at = self._find(name)
        del self.savepoints[at + 1 :]
        return self.commit(self.read(self.savepoints[at][1]))

    def _find(self, name: str) -> int:
        for k in range(len(self.savepoints) - 1, -1, -1):
            if self.savepoints[k][0] == name:
                return k
        raise FederationError(f'savepoint "{name}" does not exist')
