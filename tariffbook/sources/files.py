"""CSV and Parquet scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tariffbook.schemas import RAW_FILES


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and a fixed schema: one pass, no inference.

    The header must carry the schema's names in order; Spark would otherwise
    bind by position and swap columns without a word.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv_by_name(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The schema's columns, as text, from a CSV that may hold them in any order among others.

    Only a header line is read ahead. A further file with another header is an error.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path).select(*schema.names)


def read_raw(spark: SparkSession, source_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw subscribers, plans and subscriptions, all columns as text."""
    subscribers, plans, subscriptions = (
        read_csv_by_name(spark, f"{source_dir}/{name}", schema) for name, schema in RAW_FILES.items()
    )
    return subscribers, plans, subscriptions


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Staged table as Parquet.

    Partitioned tables are rebalanced on the partition columns first: few files
    per small partition, and a partition that holds much of the table is still
    written by several tasks.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV directory with headers, amounts as plain numbers (``9.99``, ``-2.0``)."""
    plain = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*plain).write.mode("overwrite").option("header", True).csv(path)
