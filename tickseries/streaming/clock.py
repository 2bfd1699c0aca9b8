"""A clock beside a stream: it closes the last windows, joins feeds on the window, and finds feeds that have gone silent.

A watermark moves with the rows that arrive, so the last windows of an input stay open, and a feed that stops is never heard of
again. The clock is a small table of (asset, ts, what): `named` means that rows of `asset` are expected from `ts` on, `passed` that all
rows from before `ts`, less the stream's delay, have come. Its rows share the watermark of the stream and are in no result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.streaming.feeds import read_stream, with_event_time

CLOCK = "_clock"
NAMED, PASSED = "named", "passed"
_SCHEMA = "asset string, ts timestamp, what string"


def name_feeds(spark: SparkSession, clock: str, assets: Sequence[str], at: datetime) -> None:
    """Add the feeds that are expected from `at` on to the clock table at `clock`. Tell it before their first rows."""
    _tell(spark, clock, [(a, at, NAMED) for a in assets])


def pass_time(spark: SparkSession, clock: str, at: datetime) -> None:
    """Add to the clock table that it is `at`, once the rows before it have been read.

    Windows that end the stream's delay or more before `at` are closed. Rows from before that time that come later are late.
    """
    _tell(spark, clock, [(None, at, PASSED)])


def _tell(spark: SparkSession, clock: str, rows: list) -> None:
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(clock)


def with_clock(stream: DataFrame, clock: str, ts: str, delay: str, asset: str = "asset") -> DataFrame:
    """The rows of a stream that has no watermark yet and those of the clock under one watermark.

    `_clock` says what a row of the clock means and is empty for rows of the stream. Filter the stream before it gets a clock: Catalyst
    moves later conditions below the watermark, where they take away rows of the clock too.
    """
    times = read_stream(stream.sparkSession, clock, stream.sparkSession.createDataFrame([], _SCHEMA).schema)
    times = times.select(F.col("asset").alias(asset), F.col("ts").alias(ts), F.col("what").alias(CLOCK))
    rows = stream.withColumn(ts, F.col(ts).cast("timestamp")).withColumn(CLOCK, F.lit(""))
    return with_event_time(rows.unionByName(times, allowMissingColumns=True), ts, delay)


def without_clock(clocked: DataFrame, ts: str) -> DataFrame:
    """The rows of the stream, under the watermark that the clock moves on.

    The condition has the event time in it: Catalyst would move one on the mark alone below the watermark, which the clock would then not reach.
    """
    return clocked.where(F.when(F.col(CLOCK) == "", F.col(ts)).isNotNull()).drop(CLOCK)


def last_in_window(stream: DataFrame, ts: str, width: str, value: str, name: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The last value of each window that has rows, once it is closed: (window, `name`)."""
    order = F.struct(ts, *tie_break) if tie_break else F.col(ts)
    return stream.groupBy(F.window(ts, width)).agg(F.max_by(value, order).alias(name))


def join_windows(left: DataFrame, right: DataFrame, how: str = "full_outer") -> DataFrame:
    """Join two streams of closed windows, each with a watermark of its own, on the window.

    A window that only one of them has comes, with nulls, once both watermarks have passed it. Each side has one row per window, so the
    state is the windows that the slower stream has not closed yet, however many rows they got.
    """
    joined = left.join(right, "window", how)
    return joined.select(F.col("window.start").alias("bucket"), *[c for c in joined.columns if c != "window"])


def silent_feeds(clocked: DataFrame, ts: str, window_seconds: int, windows: int, asset: str = "asset") -> DataFrame:
    """(asset, silent_from, seen) whenever an asset has no row in `windows` windows on end.

    `silent_from` is the end of the last window in which the asset had a row or was named; `seen` is false if it was only named. A
    silence is reported once, when the watermark has passed it, and how rows fall into micro-batches does not
    change the result. Rows without an asset are watched as an asset of their own. The sessions are made of one row per asset and closed window,
    counted before the shuffle, so no task gets the rows of a busy asset.
    """
    counted = clocked.groupBy(F.window(ts, f"{window_seconds} seconds"), asset).agg(
        F.count_if(F.col(CLOCK) == "").alias("n_rows"), F.count_if(F.col(CLOCK) == NAMED).alias("n_named")
    )
    active = counted.where((F.col("n_rows") > 0) | (F.col("n_named") > 0)).select(
        asset, F.window_time("window").alias("at"), F.col("window.end").alias("end"), "n_rows"
    )
    # Sessions that touch are one, so a window joins the session before it unless `windows` empty ones or more lie between.
    sessions = active.groupBy(asset, F.session_window("at", f"{windows * window_seconds} seconds")).agg(
        F.max("end").alias("silent_from"), (F.sum("n_rows") > 0).alias("seen")
    )
    return sessions.select(asset, "silent_from", "seen")
