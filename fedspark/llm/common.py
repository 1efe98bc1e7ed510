"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import os
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters between words.
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, as in tests,
    one below the warehouse, which they share too."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


class Scratch:
    """Tables that a run writes to the shared folder, so that later plans start from files that survive the
    loss of executors. drop() and clear() delete what nothing needs any more; the rest goes when the
    JVM ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/llm-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self._fs(path, lambda fs, at: fs.deleteOnExit(at))
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def counted(self, df: DataFrame, **sums: Column) -> tuple[DataFrame, dict]:
        """The kept table, and its number of rows (n) and other sums, observed while it is written."""
        seen = Observation()
        out = self.keep(df.observe(seen, F.count(F.lit(1)).alias("n"), *(v.alias(k) for k, v in sums.items())))
        return out, seen.get

    def _fs(self, path: str, act) -> None:
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        act(at.getFileSystem(sc._jsc.hadoopConfiguration()), at)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes these tables; plans that read them can't run any more."""
        for k, (df, path) in reversed(list(enumerate(self.held))):
            if any(df is t for t in tables):
                self._fs(path, lambda fs, at: fs.delete(at, True))
                del self.held[k]

    def clear(self, *but: DataFrame) -> None:
        self.drop(*(df for df, _ in self.held if not any(df is t for t in but)))


def materialize(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder that stays until the JVM ends."""
    return Scratch(df.sparkSession).keep(df)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put behind it until no column of df has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def apart(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """docs with its columns renamed to c0, c1 and so on, so that none clashes with what is added, and what
    the wanted ones are called then."""
    return docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))), [f"c{docs.columns.index(w)}" for w in wanted]


def together(out: DataFrame, names: list[str], *added: str) -> DataFrame:
    """What apart() took apart under its names again, and the added columns, which replace those of their
    name."""
    return out.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(names) if n not in added), *added)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Settings of the session (dots as double underscores) for the actions in the block."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ready_for_python(spark: SparkSession) -> None:
    """This package's folder on the workers' path where they run from the same files, and Arrow batches that
    are bounded by bytes, so that a batch of very long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def give_back() -> None:
    """Returns a Python worker's free memory to the system. Workers live on after a task, beside whatever
    their executor runs next."""
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only glibc has it
        pass
