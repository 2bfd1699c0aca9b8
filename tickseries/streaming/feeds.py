"""Streams of new minutes: read, remove copies, aggregate, align, append.

State is bounded by the watermark: a row later than `delay` behind the newest event is left out of
bars that were already emitted; `late_rows` reads how many were. Bars are emitted once the watermark has passed
their end, so the last open windows come with the rows that close them. Backfills of old files belong in the
batch operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickseries.feeds import FeedSpec
from tickseries.functions.missing import complete_row
from tickseries.functions.times import event_time
from tickseries.operators.bars import bar_columns
from tickseries.operators.conform import rename_columns
from tickseries.operators.series import long_series
from tickseries.session import work_dir
from tickseries.sinks.parquet import append_new
from tickseries.sources.csv import BAD_ROW, read_feed_stream, split_bad_rows


def read_stream(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet", **options) -> DataFrame:
    """New files below a folder or glob. A stream needs an explicit schema."""
    return spark.readStream.schema(schema).options(**options).format(file_format).load(path)


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Set the watermark. It exists for TIMESTAMP only, so other event times are cast (in UTC)."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def feed_stream(spark: SparkSession, feed: FeedSpec, root: str, delay: str) -> DataFrame:
    """A raw feed as a stream of (ts, asset, open, high, low, close, volume) with a watermark.

    Lines that do not fit and rows without a time are not in it; `bad_feed_rows` is the stream that keeps them.
    """
    good, _ = split_bad_rows(read_feed_stream(spark, feed, root))
    return with_event_time(long_series(rename_columns(good, feed.renames), feed), "ts", delay)


def bad_feed_rows(spark: SparkSession, feed: FeedSpec, root: str) -> DataFrame:
    """What `feed_stream` cannot use, as a stream of (asset, reason, line): `bad_line` with its text, `bad_time` and `incomplete` with the
    row as JSON. Write it with `write_available` beside the feed, with a checkpoint of its own."""
    good, bad = split_bad_rows(read_feed_stream(spark, feed, root))
    lines = bad.select(F.lit("bad_line").alias("reason"), F.col(BAD_ROW).alias("line"))
    rows = rename_columns(good, feed.renames)
    time = event_time(f"`{feed.ts_column}`", feed.ts_format)
    incomplete = ~complete_row(rows) if feed.drop_incomplete else F.lit(False)
    reason = F.when(time.isNull(), F.lit("bad_time")).when(incomplete, F.lit("incomplete"))
    unused = rows.where(reason.isNotNull()).select(reason.alias("reason"), F.to_json(F.struct("*")).alias("line"))
    return lines.unionByName(unused).select(F.lit(feed.name).alias("asset"), "reason", "line")


def drop_copies(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeated keys that arrive within the watermark delay."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def tumbling_bars(stream: DataFrame, by: Sequence[str], ts: str, width: str, tie_break=(), **fields) -> DataFrame:
    """Bars per group and window, emitted once the watermark has passed the window's end."""
    bars = stream.groupBy(F.window(ts, width), *by).agg(
        *bar_columns(ts, tie_break, **fields), F.count(F.lit(1)).alias("n_rows")
    )
    return bars.select(*by, F.col("window.start").alias("bucket"), *[c for c in bars.columns if c not in ("window", *by)])


def tumbling_align(stream: DataFrame, asset: str, assets: Sequence[str], ts: str, width: str, value: str, tie_break=()):
    """The last value of each asset side by side, for windows in which every asset has a row.

    One windowed aggregation instead of a stream-stream join: a window holds one small state per asset
    however many rows it gets.
    """
    order = F.struct(ts, *tie_break) if tie_break else F.col(ts)
    last = [F.max_by(value, F.when(F.col(asset) == a, order)).alias(f"{a}_close") for a in assets]
    seen = [F.count_if(F.col(asset) == a).alias(f"_n_{a}") for a in assets]
    wide = stream.where(F.col(asset).isin(list(assets))).groupBy(F.window(ts, width)).agg(*last, *seen)
    for a in assets:
        wide = wide.where(F.col(f"_n_{a}") > 0)
    return wide.select(F.col("window.start").alias("bucket"), *[f"{a}_close" for a in assets])


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all files that are there, append the results to Parquet, stop. A restart goes on from the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query left out because they came after the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def append_available(
    stream: DataFrame, path: str, checkpoint: str, keys, ts: str, tie_break=(), bad_rows: str | None = None
) -> StreamingQuery:
    """Append only new keys from each micro-batch. A repeated batch adds nothing, so each key lands once.

    Rows that lack a key or time go to the table `bad_rows`, by default beside the table, and the stream goes on.
    """
    aside = bad_rows or f"{path.rstrip('/')}_bad_rows"
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: append_new(batch, path, keys, ts, tie_break, bad_rows=aside))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_available(stream: DataFrame, purpose: str) -> DataFrame:
    """`write_available` into the working folder; returns the written table."""
    spark = stream.sparkSession
    home = work_dir(spark, purpose)
    write_available(stream, f"{home}/table", f"{home}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{home}/table")
