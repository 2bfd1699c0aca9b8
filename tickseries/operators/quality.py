"""Counts, profiles and checks. Every report reads a table once and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.functions.missing import is_float, is_missing
from tickseries.sources.csv import union_by_name


LIKELY_YEARS = (2009, 2100)


class DataQualityError(Exception):
    pass


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def non_null_count(df: DataFrame, column: str) -> DataFrame:
    """Values that are not null. NaN is a value."""
    return df.agg(F.count(F.col(column)).alias("n_non_null"))


def missing_count(df: DataFrame, column: str, nan_is_missing: bool = True) -> DataFrame:
    """Values that are null or, where the type has it and `nan_is_missing`, NaN."""
    missing = is_missing(df.schema[column]) if nan_is_missing else F.col(column).isNull()
    return df.agg(F.count_if(missing).alias("n_missing"))


def _per_column(df: DataFrame, **counts) -> DataFrame:
    """One row per column of `df` from one aggregation. Each count maps a schema field to an aggregate."""
    totals = df.agg(
        F.array(
            *[
                F.struct(F.lit(f.name).alias("column"), *[count(f).alias(name) for name, count in counts.items()])
                for f in df.schema.fields
            ]
        ).alias("rows")
    )
    return totals.select(F.inline("rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, and NaN values (0 where the type has none)."""

    def nan(f) -> Column:
        return F.count_if(F.isnan(F.col(f"`{f.name}`"))) if is_float(f) else F.lit(0).cast("bigint")

    return _per_column(
        df,
        n=lambda f: F.count(F.lit(1)),
        n_null=lambda f: F.count_if(F.col(f"`{f.name}`").isNull()),
        n_nan=nan,
    )


def schema_listing(df: DataFrame, count_values: bool = False) -> DataFrame:
    """Per column: position, type, whether the schema allows null; with `count_values`, which scans the columns, the values it holds."""
    fields = list(enumerate(df.schema.fields, start=1))
    if count_values:
        position = {f.name: i for i, f in fields}
        return _per_column(
            df,
            position=lambda f: F.lit(position[f.name]),
            data_type=lambda f: F.lit(f.dataType.simpleString()),
            nullable=lambda f: F.lit(f.nullable),
            n_values=lambda f: F.count(F.col(f"`{f.name}`")),
        )
    rows = [(f.name, i, f.dataType.simpleString(), f.nullable) for i, f in fields]
    return df.sparkSession.createDataFrame(rows, "column string, position int, data_type string, nullable boolean")


def check_table(df: DataFrame, table: str, key: str) -> DataFrame:
    """The table has rows, and its key has a value in each of them."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_missing(df.schema[key])).alias("n_missing"),
    ).select(
        F.lit(table).alias("table"),
        F.lit(key).alias("key"),
        "n_rows",
        "n_missing",
        ((F.col("n_rows") > 0) & (F.col("n_missing") == 0)).alias("passed"),
    )


def quality_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """`check_table` for {table name: (table, key column)}, one scan each."""
    return union_by_name(check_table(df, name, key) for name, (df, key) in tables.items())


def check_contract(df: DataFrame, table: str, required: Sequence[str], keys: Sequence[str], ts: str | None = None) -> DataFrame:
    """The documented contract of a table: no required field is missing, keys are unique, years are likely.

    Rows are first counted per key, with a partial count in each task, and the counts are then added up: one scan and one shuffle
    of keys. `n_duplicates` counts the rows beyond the first of each key.
    """
    missing = reduce(add, (is_missing(df.schema[c]).cast("long") for c in required), F.lit(0).cast("long"))
    odd = ~F.year(ts).between(*LIKELY_YEARS) if ts else F.lit(False)
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(missing).alias("missing"), F.count_if(odd).alias("odd")
    )
    sums = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("n_missing_fields"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
        F.coalesce(F.sum("odd"), F.lit(0)).alias("n_odd_years"),
    )
    good = (F.col("n_missing_fields") == 0) & (F.col("n_duplicates") == 0) & (F.col("n_odd_years") == 0)
    return sums.select(F.lit(table).alias("table"), "*", good.alias("passed"))


def assert_quality(report: DataFrame) -> None:
    """Raise when a check failed. The report has one row per table."""
    failed = [r.asDict() for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise DataQualityError(f"quality checks failed: {failed}")


def year_out_of_range_count(df: DataFrame, ts: str, first: int = LIKELY_YEARS[0], last: int = LIKELY_YEARS[1]) -> DataFrame:
    """Rows with an unlikely year, or with a time that could not be read: milliseconds read as seconds lie beyond the year 9999."""
    return df.agg(F.count_if(F.coalesce(~F.year(ts).between(first, last), F.lit(True))).alias("n_out_of_range"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
