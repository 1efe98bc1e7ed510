"""ANALYZE: statistics of a table in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidOptionValue

_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def analyze(df: DataFrame, sample_percent: float = 100.0, seed: int = 42, exact: bool = False) -> DataFrame:
    """column_name, total_rows, null_fraction, n_distinct, min_value, max_value, avg_width: a row for each
    column.

    A sample takes each row with the same chance; total_rows is scaled up from it. All columns are
    aggregated together with sketches of fixed size; exact counts distinct values instead, which
    shuffles them.
    """
    if not 0.000001 <= sample_percent <= 100:
        raise InvalidOptionValue('invalid value for option "sample_percent"', "Valid values in this context are numbers between 0.000001 and 100.")
    rows = df if sample_percent == 100 else df.sample(fraction=sample_percent / 100, seed=seed)
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("n")]
    for k, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text = c.cast("string") if not isinstance(f.dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)) else F.base64(c) if isinstance(f.dataType, T.BinaryType) else F.to_json(c)
        ordered = isinstance(f.dataType, _ORDERED)
        count = F.count_distinct(text) if exact else F.approx_count_distinct(text)
        aggs += [F.count(c).alias(f"c{k}"), count.alias(f"d{k}"), (F.min(c).cast("string") if ordered else F.lit(None).cast("string")).alias(f"l{k}"), (F.max(c).cast("string") if ordered else F.lit(None).cast("string")).alias(f"h{k}"), F.avg(F.octet_length(text)).alias(f"w{k}")]
    one = rows.agg(*aggs)
    total = F.round(F.col("n") * (100.0 / sample_percent)).cast("long")
    columns = [F.struct(F.lit(f.name).alias("column_name"), total.alias("total_rows"), F.when(F.col("n") > 0, 1 - F.col(f"c{k}") / F.col("n")).otherwise(0.0).alias("null_fraction"), F.col(f"d{k}").alias("n_distinct"), F.col(f"l{k}").alias("min_value"), F.col(f"h{k}").alias("max_value"), F.col(f"w{k}").alias("avg_width")) for k, f in enumerate(fields)]
    return one.select(F.inline(F.array(*columns)))


def analyze_table(spark, table, user=None, exact: bool = False, seed: int = 42) -> DataFrame:
    """Statistics of a foreign table, from the share of its rows that its sample_percent names."""
    from ..sources.scan import scan

    return analyze(scan(spark, table, user), float(table.effective()["sample_percent"]), seed, exact)


def table_sample(df: DataFrame, percent: float, seed: int = 42) -> DataFrame:
    """A sample scan: each row with the same chance."""
    return df.sample(fraction=percent / 100, seed=seed)
