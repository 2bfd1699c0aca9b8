"""Aggregation of price rows to coarser bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.functions.times import time_bucket
from tickseries.operators.scans import running, running_count, running_sum
from tickseries.operators.windows import ROWS_PER_TASK


def bar_columns(
    ts: str,
    tie_break: Sequence[str] = (),
    open: str = "open",
    high: str = "high",
    low: str = "low",
    close: str = "close",
    volume: str | None = "volume",
) -> list[Column]:
    """Open, high, low, close, (volume) of a group of rows.

    A unique `ts` keeps the hash aggregate. With a tie break the first and last rows are compared as structs, for
    which Spark aggregates by sorting; rows that still tie are compared by price.
    """
    if tie_break:
        first = F.min(F.struct(ts, *tie_break, F.col(open).alias("_price")))["_price"]
        last = F.max(F.struct(ts, *tie_break, F.col(close).alias("_price")))["_price"]
    else:
        first, last = F.min_by(open, ts), F.max_by(close, ts)
    bars = [first.alias("open"), F.max(high).alias("high"), F.min(low).alias("low"), last.alias("close")]
    return bars + ([F.sum(volume).alias("volume")] if volume else [])


def resample(df: DataFrame, by: Sequence[str], ts: str, grain: str | int, tie_break: Sequence[str] = (), **fields):
    """Bars per `by` group and time bucket, with the number of rows in each.

    Ticks become bars with open = high = low = close = the price column. Every aggregate is partial, so a
    hot group or bucket reaches the shuffle as one row per task.
    """
    return df.groupBy(*by, time_bucket(ts, grain).alias("bucket")).agg(
        *bar_columns(ts, tie_break, **fields), F.count(F.lit(1)).alias("n_rows")
    )


# Traded amounts add up exactly as decimals; the sum of doubles would depend on how rows are cut into chunks.
AMOUNT = "decimal(28,9)"


def size_bars(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    size: int,
    amount: str | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
    **fields,
) -> DataFrame:
    """Bars of equal traded amount, or of equal number of rows without `amount`, in the order of `order_by` (time first, unique).

    A group's rows are numbered by the running amount before them: a bar ends with the row that brings the amount to the next
    multiple of `size`, so a row belongs to one bar, and one larger than `size` leaves numbers out. Missing amounts count as
    zero, negative ones are an error. Columns: the group, `bar` from 0, the times of its first and last row, the bar, n_rows.
    """
    if amount is None:
        ahead = running(df, by, order_by, {"_n": running_count()}, rows_per_task).withColumn("bar", F.floor((F.col("_n") - 1) / size))
    else:
        exact = F.col(amount).cast(AMOUNT)
        checked = F.when(exact < 0, F.raise_error(F.lit(f"negative {amount}"))).otherwise(F.coalesce(exact, F.lit(0).cast(AMOUNT)))
        summed = running(df.withColumn("_a", checked.cast(AMOUNT)), by, order_by, {"_sum": running_sum(F.col("_a"))}, rows_per_task)
        ahead = summed.withColumn("bar", F.floor((F.col("_sum") - F.col("_a")) / size).cast("long"))
    ts, tie_break = order_by[0], list(order_by[1:])
    return ahead.groupBy(*by, "bar").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), *bar_columns(ts, tie_break, **fields), F.count(F.lit(1)).alias("n_rows")
    )
