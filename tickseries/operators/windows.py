"""Row windows over ordered series of any length.

A plain `Window.partitionBy(asset)` puts one asset's whole history into one task. The chunked form cuts histories into consecutive
chunks by range partitioning, and the rows before each chunk that a frame can reach are carried into it. The
caller picks the form; the data never does.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickseries.session import materialize

# A size of chunk that a task holds easily. Beyond tens of thousands of chunks, raise it: a shuffle has a block for each
# map task and chunk.
ROWS_PER_TASK = 2_000_000

CHUNK = "_chunk"
_CARRIED = "_carried"
_FROM_END = "_from_end"
_REACH = "_reach"

# `monotonically_increasing_id` holds the row's position within its partition in the lower 33 bits.
_ROW_IN_PARTITION = (1 << 33) - 1


def ordered_window(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    preceding: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add window columns that look back at most `preceding` rows within each `by` group.

    Each value of `columns` gets the window (partitioned and ordered) and returns a column, for
    example `lambda w: F.avg("price").over(w.rowsBetween(-4, 0))`. It must not look further back than
    `preceding` rows, nor forward. `order_by` must order each group totally, so that results are defined.

    Without `rows_per_task` a group is sorted in one task: right for groups that a task can hold, lazy. With it the rows are
    cut into chunks of about that size, with the same result: a count, and if one chunk is not enough a table in the working folder, which stays
    as long as the result may be read (the owner of spark.checkpoint.dir removes it with the job's other work). One series
    without groups needs it.
    """
    if rows_per_task is None:
        if not by:
            raise ValueError("one series without groups would be sorted in one task: give rows_per_task")
        w = Window.partitionBy(*by).orderBy(*order_by)
        return df.withColumns({name: make(w) for name, make in columns.items()})
    return _chunked_window(df, by, order_by, preceding, columns, rows_per_task)


def chunks(df: DataFrame, by: Sequence[str], order_by: Sequence[str], rows_per_task: int) -> DataFrame | None:
    """The rows in consecutive chunks of about `rows_per_task`, stored, with their chunk number; None if one chunk is enough for all groups.

    One series without groups has two chunks at least, so that it never meets in one task.

    Chunks follow each other in the order of `by` and `order_by`, which must be unique together: range partitioning can then
    cut any group and any instant. Only one group goes on from one chunk into the next.
    """
    n_chunks = max(1 if by else 2, math.ceil(df.count() / rows_per_task))
    if n_chunks < 2:
        return None
    keys = [*by, *order_by]
    # The chunk numbers must be stored: planning the range exchange again could choose other bounds. Rows are stored last
    # first, so the end of each chunk is a condition on one column that skips all row groups but the first.
    ranged = (
        df.repartitionByRange(n_chunks, *keys)
        .sortWithinPartitions(*[F.desc(c) for c in keys])
        .withColumns(
            {CHUNK: F.spark_partition_id(), _FROM_END: F.monotonically_increasing_id().bitwiseAND(_ROW_IN_PARTITION)}
        )
    )
    return materialize(ranged, "chunks")


def _chunked_window(df, by, order_by, preceding, columns, rows_per_task) -> DataFrame:
    rows = chunks(df, by, order_by, rows_per_task)
    if rows is None:
        w = Window.partitionBy(*by, CHUNK).orderBy(*order_by)
        return df.withColumn(CHUNK, F.lit(0)).withColumns({name: make(w) for name, make in columns.items()}).drop(CHUNK)
    # A group goes on into the next chunk only if it is the last of its chunk, so the last rows are those that matter.
    last = rows.where(F.col(_FROM_END) < preceding)
    reach = _chunks_to_reach(rows, by, preceding)
    if by:
        last = last.join(reach, [last[c].eqNullSafe(reach[f"_{c}"]) for c in by]).drop(*[f"_{c}" for c in by])
    else:
        last = last.withColumn(_REACH, F.lit(reach.first()[_REACH]))
    carried = last.withColumn(CHUNK, F.explode(F.sequence(F.col(CHUNK) + 1, F.col(CHUNK) + F.col(_REACH)))).drop(_REACH)
    both = rows.withColumn(_CARRIED, F.lit(False)).unionByName(carried.withColumn(_CARRIED, F.lit(True)))
    w = Window.partitionBy(*by, CHUNK).orderBy(*order_by)
    return (
        both.withColumns({name: make(w) for name, make in columns.items()})
        .where(~F.col(_CARRIED))
        .drop(CHUNK, _CARRIED, _FROM_END)
    )


def _chunks_to_reach(rows: DataFrame, by: Sequence[str], preceding: int) -> DataFrame:
    """Per group, on how many chunks a row can matter.

    Chunks are consecutive, so between two chunks of a group lie only chunks full of that group. If the
    smallest of these inner chunks has q rows, the `preceding` rows before a chunk lie in the
    ceil(preceding / q) chunks before it. Counts per chunk are small: one row per chunk and group.
    """
    per_chunk = rows.groupBy(*by, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    ends = F.struct(F.min(CHUNK).alias("first"), F.max(CHUNK).alias("last"))
    chunks = F.collect_list(F.struct(F.col(CHUNK).alias("c"), F.col("_n").alias("n")))
    grouped = per_chunk.groupBy(*by).agg(ends.alias("_ends"), chunks.alias("_chunks"))
    inner = F.filter("_chunks", lambda x: (x["c"] > F.col("_ends")["first"]) & (x["c"] < F.col("_ends")["last"]))
    smallest = F.array_min(F.transform(inner, lambda x: x["n"]))
    reach = F.greatest(F.lit(1), F.coalesce(F.ceil(F.lit(preceding) / smallest), F.lit(1))).cast("int")
    return grouped.select(*[F.col(f"`{c}`").alias(f"_{c}") for c in by], reach.alias(_REACH))
