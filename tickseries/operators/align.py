"""Put the series of several assets side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.functions.times import CALENDAR, FIXED_GRAINS, time_bucket
from tickseries.operators.scans import last_known, running
from tickseries.operators.series import latest_per_key
from tickseries.operators.windows import ROWS_PER_TASK, ordered_window


def align_join(series: Sequence[DataFrame], keys: Sequence[str] = CALENDAR) -> DataFrame:
    """Inner join of N wide series on the calendar minute. Columns outside the keys need distinct names.

    A plain inner join: a null key never matches, and a minute that one series has twice appears twice. All
    joins use the same keys, so a chain shuffles every series once; AQE splits hot minutes. When
    each minute may have many rows, align bars instead or build the series in default mode.
    """
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), series)


def fan_out(series: Sequence[DataFrame], keys: Sequence[str] = CALENDAR) -> DataFrame:
    """Rows `align_join` will return: the sum over minutes of the product of the row counts.

    Works on counts only, so it is cheap even where the join itself would be too large to run.
    """
    counts = [
        s.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(f"n{i}")) for i, s in enumerate(series)
    ]
    joined = reduce(lambda a, b: a.join(b, list(keys), "inner"), counts)
    product = reduce(lambda a, b: a * b, (F.col(f"n{i}") for i in range(len(series))))
    return joined.agg(F.coalesce(F.sum(product), F.lit(0.0)).alias("n_rows"))


def _of(asset: str, name: str, value: str) -> Column:
    return F.when(F.col(asset) == name, F.col(value))


def align_bars(
    bars: DataFrame,
    assets: Sequence[str],
    values: Sequence[str],
    asset: str = "asset",
    bucket: str = "bucket",
    how: str = "inner",
) -> DataFrame:
    """One row per bucket with `<asset>_<value>` columns, from long bars that are unique per (asset, bucket).

    One aggregation aligns any number of assets: a single shuffle, where a chain of joins has one per asset. `inner`
    keeps the buckets that every asset has, `outer` keeps all and leaves null where an asset has none.
    """
    columns = [F.max(_of(asset, a, v)).alias(f"{a}_{v}") for a in assets for v in values]
    seen = [F.count_if(F.col(asset) == a).alias(f"_n_{a}") for a in assets]
    wide = bars.where(F.col(asset).isin(list(assets))).groupBy(bucket).agg(*columns, *seen)
    if how == "inner":
        wide = wide.where(reduce(and_, (F.col(f"_n_{a}") > 0 for a in assets)))
    return wide.drop(*[f"_n_{a}" for a in assets])


def pivot_assets(df: DataFrame, bucket: Column, asset: str, assets: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates per bucket with one column per asset. The assets are named, so no pass has to find them."""
    named = [a.alias(name) for name, a in aggregates.items()]
    return df.groupBy(bucket).pivot(asset, list(assets)).agg(*named)


def missing_buckets(df: DataFrame, bucket: Column, asset: str, present: str, absent: str) -> DataFrame:
    """Buckets that `present` has and `absent` lacks; an inner join drops these silently."""
    counts = (
        df.where(F.col(asset).isin(present, absent))
        .groupBy(bucket.alias("bucket"))
        .agg(F.count_if(F.col(asset) == present).alias("_p"), F.count_if(F.col(asset) == absent).alias("_a"))
    )
    return counts.where((F.col("_p") > 0) & (F.col("_a") == 0)).select("bucket")


def gap_intervals(
    df: DataFrame, asset: str, ts: str, grain: str | int = "minute", at_least: int = 1, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """The gaps of each asset as intervals: (asset, start, end, n_missing), the first and last missing bucket and how many there are.

    Between an asset's first and last row; gaps of fewer than `at_least` buckets are left out. Works from each bucket to the one before it, across
    chunks, so the grid of all buckets is never built. Rows without a time or asset belong to no series.
    """
    present = df.where(F.col(ts).isNotNull() & F.col(asset).isNotNull())
    seen = present.select(asset, time_bucket(ts, grain).alias("bucket")).distinct()
    length = F.lit((FIXED_GRAINS[grain] if isinstance(grain, str) else int(grain)) * 1_000_000)
    before = ordered_window(seen, [asset], ["bucket"], 1, {"_before": lambda w: F.lag("bucket").over(w)}, rows_per_task)
    here, last = F.unix_micros("bucket"), F.unix_micros("_before")
    gaps = before.withColumn("n_missing", ((here - last) / length).cast("long") - 1).where(F.col("n_missing") >= max(at_least, 1))
    return gaps.select(asset, F.timestamp_micros(last + length).alias("start"), F.timestamp_micros(here - length).alias("end"), "n_missing")


def align_last_known(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    values: Mapping[str, str],
    order_by: Sequence[str] = (),
    by: Sequence[str] = (),
    tolerance: int | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """The rows of `left` with what `right` last said at or before their time.

    `values` names columns of `right` and what they are called in the result; with the time among them one sees how old a
    value is. Of the rows of `right` at one instant the last by `order_by` counts. With `by`, rows meet
    within a group; a null group is a group. What is older than `tolerance` seconds is null, as is what has no past.
    Rows of `left` without a time know nothing. No join: both sides are one ordered series in which the
    last known row is carried on, so a task holds a chunk of `rows_per_task` rows of an asset and not the asset.
    """
    known = F.struct(F.col(ts).alias("_at"), *[F.col(f"`{c}`").alias(name) for c, name in values.items()])
    ties = [F.col(f"`{c}`").alias(f"_tie_{i}") for i, c in enumerate(order_by)]
    said = right.where(F.col(ts).isNotNull()).select(*by, F.col(ts).alias("_ts"), F.lit(0).alias("_side"), *ties, known.alias("_known"))
    said = latest_per_key(said, [*by, "_ts", "_side"], [c for c in said.columns if c.startswith("_tie_")]).drop(*[f"_tie_{i}" for i in range(len(ties))])
    asks = left.select(*by, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    # Rows of one side and instant are alike in what they know, so a number of their own makes the order unique.
    both = asks.unionByName(said, allowMissingColumns=True).withColumn("_n", F.xxhash64(*by, "_ts", "_row"))
    order = ["_ts", "_side", "_n"]
    carried = running(both, by, order, {"_last": last_known(F.col("_known"), order)}, rows_per_task).where(F.col("_side") == 1)
    fresh = F.col("_ts").isNotNull()
    if tolerance is not None:
        age = F.unix_micros(F.col("_ts").cast("timestamp")) - F.unix_micros(F.col("_last._at").cast("timestamp"))
        fresh = fresh & (age <= tolerance * 1_000_000)
    return carried.select("_row.*", *[F.when(fresh, F.col(f"_last.`{name}`")).alias(name) for name in values.values()])
