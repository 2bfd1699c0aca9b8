"""Build one asset's minute series from its staging table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tickseries.feeds import MEASURES, FeedSpec
from tickseries.functions.missing import complete_row
from tickseries.functions.times import CALENDAR, calendar_columns, event_time, time_bucket, with_calendar
from tickseries.operators.conform import long_columns, measure_columns

PARITY_MEASURES = ["open", "high", "low", "volume"]


def drop_incomplete(df: DataFrame, required: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any required column; all columns by default."""
    return df.where(complete_row(df, required))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `order_by`, then by the remaining columns from left to right.

    An aggregate, so copies of a hot key collapse before the shuffle. The rule names a single row
    whatever the order in which rows arrive.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    values = [c for c in order_by if c not in keys] + rest
    best = F.max(F.struct(*[F.col(f"`{c}`") for c in values])).alias("_best")
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best).select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns]
    )


def sort_rows(df: DataFrame, first: Sequence[str] = CALENDAR) -> DataFrame:
    """Global sort by `first`, then by all other columns, so that a minute with many rows can be split."""
    return df.orderBy(*first, *[c for c in df.columns if c not in first])


def build_series(staged: DataFrame, feed: FeedSpec, parity: bool = False) -> DataFrame:
    """Clean, split the time into calendar columns, map to the common fields, remove duplicates.

    Parity mode keeps the source's own timestamp, leaves the close out and removes rows that are equal in
    every selected column. Two rows of a minute that differ in a selected column both stay.

    Default mode has the close, a real timestamp, and exactly one row per minute: the latest event of that
    minute, the greatest values on a tie. The number of rows of an asset is then bounded by its minutes.
    Rows whose time cannot be read belong to no minute; they stay in staging, and the report of the job counts them and fails.
    """
    if feed.drop_incomplete:
        staged = drop_incomplete(staged)
    ts = event_time(f"`{feed.ts_column}`", feed.ts_format)
    if parity:
        numeric = isinstance(staged.schema[feed.ts_column].dataType, NumericType)
        stamp = F.col(f"`{feed.ts_column}`") if numeric else ts
        # The calendar columns follow from the timestamp, so they are derived after the
        # distinct: its shuffle carries and compares five columns.
        rows = staged.select(stamp.alias("timestamp"), *measure_columns(feed, PARITY_MEASURES)).distinct()
        ts = event_time("timestamp", feed.ts_format if numeric else "timestamp")
        measures = PARITY_MEASURES
    else:
        rows = latest_per_key(
            _timed(staged, feed).withColumn("_minute", time_bucket("timestamp", "minute")), ["_minute"], ["timestamp"]
        )
        ts = F.col("timestamp")
        measures = list(MEASURES)
    parts = [c.alias(name) for name, c in calendar_columns(ts).items()]
    return rows.select("timestamp", *parts, *[f"{feed.name}_{m}" for m in measures])


def _timed(staged: DataFrame, feed: FeedSpec) -> DataFrame:
    ts = event_time(f"`{feed.ts_column}`", feed.ts_format)
    rows = staged.select(ts.alias("timestamp"), *measure_columns(feed, list(MEASURES)))
    return rows.where(F.col("timestamp").isNotNull())


def series_rows(staged: DataFrame, feed: FeedSpec) -> DataFrame:
    """The columns of the default series before a minute's rows are reduced to one. Nothing is shuffled."""
    if feed.drop_incomplete:
        staged = drop_incomplete(staged)
    rows = with_calendar(_timed(staged, feed), "timestamp")
    return rows.select("timestamp", *CALENDAR, *[f"{feed.name}_{m}" for m in MEASURES])


def long_series(staged: DataFrame, feed: FeedSpec) -> DataFrame:
    """The feed as (asset, ts, open, high, low, close, volume), so that any number of feeds fit one table.

    Works on streams too: nothing is shuffled. Rows whose time cannot be read are left to staging.
    """
    if feed.drop_incomplete:
        staged = drop_incomplete(staged)
    ts = event_time(f"`{feed.ts_column}`", feed.ts_format).alias("ts")
    return staged.select(ts, *long_columns(feed, list(MEASURES))).where(F.col("ts").isNotNull())


def latest_per_bucket(
    rows: DataFrame, grain: str | int, by: Sequence[str] = ("asset",), ts: str = "ts", tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per group and time bucket, the latest one; `bucket` is its start."""
    return latest_per_key(rows.withColumn("bucket", time_bucket(ts, grain)), [*by, "bucket"], [ts, *tie_break])
