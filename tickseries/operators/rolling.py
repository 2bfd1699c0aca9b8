"""Moving statistics whose cost does not grow with the frame.

Rows are numbered and cut into blocks as long as the frame. A frame then is the end of one block and the beginning of the
next: the statistics from each row to the end of its block and from the beginning of its block are running ones, and each
frame merges two of them. Nothing is subtracted, so nothing is lost to cancellation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickseries.operators.scans import running, running_count
from tickseries.operators.windows import ROWS_PER_TASK
from tickseries.session import materialize

STATISTICS = ("avg", "stddev", "min", "max")


def rolling_statistics(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    column: str,
    rows: int,
    statistics: Sequence[str] = STATISTICS,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add `rolling_avg`, `rolling_stddev` (sample), `rolling_min` and `rolling_max` of the last `rows` rows of a group.

    Null before there are `rows` rows; null values count as rows and not as values. `order_by` must be unique in a group. A task
    sorts one block, so it holds `rows` rows of a group and `rows_per_task` while they are numbered.
    """
    if unknown := set(statistics) - set(STATISTICS):
        raise ValueError(f"statistics are {STATISTICS}, not {sorted(unknown)}")
    numbered = running(df, by, order_by, {"_n": running_count()}, rows_per_task)
    placed = numbered.withColumns({"_block": F.floor((F.col("_n") - 1) / rows), "_at": (F.col("_n") - 1) % rows})
    value = F.col(f"`{column}`")
    first = Window.partitionBy(*by, "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    # From the row to the end of its block: the same running frame in the other order.
    last = Window.partitionBy(*by, "_block").orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, 0)
    held = materialize(placed.withColumns(_states(value, first, "_a")).withColumns(_states(value, last, "_b")), "blocks")
    # The frame of the row at place p begins at place p + 1 of the block before.
    names = [F.col(f"`{c}`").alias(f"_of_{i}") for i, c in enumerate(by)]
    ends = held.where(F.col("_at") > 0).select(
        *names, (F.col("_block") + 1).alias("_to"), (F.col("_at") - 1).alias("_place"), *[c for c in held.columns if c.startswith("_b_")]
    )
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(by)]
    begins = held.drop(*[c for c in held.columns if c.startswith("_b_")])
    joined = begins.join(ends, reduce(and_, [*same, F.col("_block") == F.col("_to"), F.col("_at") == F.col("_place")]), "left")
    full = F.col("_n") >= rows
    merged = _merged()
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.when(full, merged[s]).alias(f"rolling_{s}") for s in statistics])


def _states(value: Column, window, prefix: str) -> dict[str, Column]:
    """What is known of the values of a running frame; the mean and variance are null without values."""
    return {
        f"{prefix}_n": F.count(value).over(window),
        f"{prefix}_mean": F.avg(value).over(window),
        f"{prefix}_var": F.var_pop(value).over(window),
        f"{prefix}_min": F.min(value).over(window),
        f"{prefix}_max": F.max(value).over(window),
    }


def _merged() -> dict[str, Column]:
    """The statistics of two frames together, null where both have no values."""
    n_a, n_b = F.col("_a_n").cast("double"), F.coalesce("_b_n", F.lit(0)).cast("double")
    mean_a, mean_b = F.coalesce("_a_mean", "_b_mean"), F.coalesce("_b_mean", "_a_mean")
    n = n_a + n_b
    apart = mean_b - mean_a
    squares = F.coalesce("_a_var", F.lit(0.0)) * n_a + F.coalesce("_b_var", F.lit(0.0)) * n_b + apart * apart * F.try_divide(n_a * n_b, n)
    return {
        "avg": mean_a + apart * F.try_divide(n_b, n),
        "stddev": F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1))),
        "min": F.least("_a_min", "_b_min"),
        "max": F.greatest("_a_max", "_b_max"),
    }
