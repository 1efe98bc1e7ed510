"""Table files below a root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, root: str, name: str, format: str = "parquet") -> DataFrame:
    """A table's files; columns and filters of later steps reach the scan."""
    return spark.read.format(format).load(f"{root}/{name}.{format}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, null: str = "") -> DataFrame:
    """Rows of a CSV file under a declared schema; a row that doesn't fit it is an error."""
    return spark.read.csv(path, schema=schema, header=header, nullValue=null, mode="FAILFAST")
