"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def between(df: DataFrame, ts: str, low, high, year: str = "year") -> DataFrame:
    """Rows with low <= ts <= high (texts, datetimes or constant columns) of a table partitioned by `year`.

    Spark does not derive the year from a condition on `ts`, so both conditions are given: one prunes
    partitions, the other reaches the row groups. The bounds take the column's type, since a cast of
    the column itself would not be pushed down.
    """
    low, high = (F.lit(bound).cast(df.schema[ts].dataType) for bound in (low, high))
    rows = df.where(F.col(ts).between(low, high))
    if year in df.columns:
        rows = rows.where(F.col(year).between(F.year(low), F.year(high)))
    return rows
