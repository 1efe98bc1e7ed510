"""Streams into keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.versions import VersionedTable


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """table with rows put in place of those of equal keys; of several rows with one key the last by order
    counts (any, without an order)."""
    if order:
        newest = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
        rows = rows.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")
    else:
        rows = rows.dropDuplicates(list(keys))
    return table.join(rows.select(*keys), list(keys), "left_anti").select(*table.columns).unionByName(rows.select(*table.columns))


def stream_into(stream: DataFrame, table: VersionedTable, checkpoint: str, order: str | None = None) -> DataStreamWriter:
    """A writer that upserts each micro-batch as one version. A batch that comes again after a failure
    makes the same table once more."""

    def one(batch: DataFrame, number: int) -> None:
        at = table.version
        table.commit(upsert(table.read(at), batch, table.keys, order) if at else batch, at)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
