"""The tables of the job kept up by streams of the raw feeds."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickseries.feeds import FeedSpec
from tickseries.operators.conform import rename_columns
from tickseries.plans.loads import COMBINED, apply_load
from tickseries.session import use_utc
from tickseries.sinks.commit import is_done, recover
from tickseries.sources.csv import read_feed_stream


def run_stream_job(
    spark: SparkSession,
    feeds: Sequence[FeedSpec],
    input_root: str,
    output_root: str,
    checkpoint: str,
    combined: str = COMBINED,
    rollups: bool = False,
    files_per_batch: int | None = None,
) -> list[StreamingQuery]:
    """Take up all raw files that have arrived since the last call into staging, series, combined table and ledger.

    Each micro-batch of a feed is one load: its raw rows are a partition of staging, and the months that it has are merged in one
    commit. A load is named after the stream and the number of the batch, which a restart repeats. So a batch that
    was cut off anywhere is done again with the same result, and one whose commit is closed is passed over: the tables end where one
    load of all files would. The feeds take turns, since a commit needs the tables to itself.
    """
    use_utc(spark)
    recover(spark, output_root)
    queries = []
    for feed in feeds:
        queries.append(_run_feed(spark, feeds, feed, input_root, output_root, f"{checkpoint.rstrip('/')}/{feed.name}", combined, rollups, files_per_batch))
    return queries


def _run_feed(spark, feeds, feed: FeedSpec, input_root, output_root, checkpoint, combined, rollups, files_per_batch) -> StreamingQuery:
    options = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    known, name = threading.Event(), {}

    def merge(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        load = f"{feed.name}-{name['stream']}-{batch_id:09d}"
        if not is_done(batch.sparkSession, output_root, load):
            raw = {feed.name: rename_columns(batch, feed.renames)}
            apply_load(batch.sparkSession, feeds, raw, output_root, load, combined, rollups)

    stream = read_feed_stream(spark, feed, input_root, **options)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    name["stream"] = query.id  # kept in the checkpoint: a new checkpoint is a new stream
    known.set()
    query.awaitTermination()
    return query
