"""Exponential averages and the indicators made of them, over series of any length.

An exponential average is y = alpha * x + (1 - alpha) * y before. Over a chunk this is one affine step from the value before
the chunk to the value at its end, and such steps compose: a chunk is summed up in (number of values, first
value, value at its end from zero), a pass over these few rows gives the value before each chunk, and each chunk is then run through once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tickseries.operators.windows import CHUNK, ROWS_PER_TASK, chunks, ordered_window


def alpha_of(periods: int) -> float:
    """The usual weight of an average over so many periods."""
    return 2 / (periods + 1)


def exponential_averages(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    columns: Mapping[str, tuple[str, float]],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add `name: (column, alpha)` exponential averages of each `by` group in the order of `order_by`, which must be unique in it.

    An average begins with the first value. Null and NaN leave it as it is, and it is null before the first value. The result does
    not depend on the chunks beyond rounding. Without `rows_per_task` a group is run through in one task.
    """
    if rows_per_task is None and not by:
        raise ValueError("one series without groups would be sorted in one task: give rows_per_task")
    keys = [*by, *order_by]
    result = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name in columns]])
    stored = chunks(df, by, order_by, rows_per_task) if rows_per_task is not None else None
    if stored is None:
        return df.groupBy(*by).applyInPandas(lambda rows: _run(rows.sort_values(keys), by, columns, {}), result)
    rows = stored.select(*df.columns, CHUNK)
    chunked = StructType([*result.fields, StructField(CHUNK, stored.schema[CHUNK].dataType)])
    steps = _steps(rows, by, order_by, columns)

    def run(here: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        # Only the first group of a chunk goes on from the chunk before, so there is one row at most.
        carried = {name: before[f"_y_{name}"].iloc[0] for name in columns} if len(before) else {}
        return _run(here.sort_values(keys), by, columns, carried)

    # Chunk by chunk: the carried values are one row for a chunk that begins within a group.
    return rows.groupBy(CHUNK).cogroup(steps.groupBy(CHUNK)).applyInPandas(run, chunked).select(*df.columns, *columns)


def _run(rows: pd.DataFrame, by: Sequence[str], columns: Mapping[str, tuple[str, float]], carried: Mapping[str, float]) -> pd.DataFrame:
    """The averages of sorted rows; `carried` holds the values before the first row, for the first group."""
    group = rows.groupby(list(by), sort=False, dropna=False).ngroup().to_numpy() if by else np.zeros(len(rows), int)
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(rows)]
    out = {}
    for name, (column, alpha) in columns.items():
        values = rows[column].astype(float)
        parts = []
        for start, end in zip(edges, edges[1:]):
            before = carried.get(name, np.nan) if start == 0 else np.nan
            series = pd.concat([pd.Series([before]), values.iloc[start:end]], ignore_index=True)
            parts.append(series.ewm(alpha=alpha, adjust=False, ignore_na=True).mean().iloc[1:])
        y = np.concatenate(parts) if parts else np.zeros(0)
        # Spark keeps NaN apart from null.
        out[name] = pd.Series(y, index=rows.index, dtype="Float64").mask(np.isnan(y))
    return rows.assign(**out)


def _steps(rows: DataFrame, by: Sequence[str], order_by: Sequence[str], columns: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(chunk, the averages before it) of the group that goes on into the chunk from the one before."""
    last_first = Window.partitionBy(*by, CHUNK).orderBy(*[F.desc(c) for c in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(*order_by)
    after, sums, kinds = {}, [], []
    for name, (column, alpha) in columns.items():
        x = F.col(column).cast("double")
        known = x.isNotNull() & ~F.isnan(x)
        # How many values come after this one: the weight that is left of it at the end of the chunk.
        after[f"_a_{name}"] = F.count(F.when(known, 1)).over(last_first) - 1
        weighted = F.when(known, alpha * F.pow(F.lit(1 - alpha), F.col(f"_a_{name}")) * x)
        sums += [
            F.count_if(known).alias(f"_n_{name}"),
            F.min_by(x, F.when(known, place)).alias(f"_first_{name}"),
            F.coalesce(F.sum(weighted), F.lit(0.0)).alias(f"_end_{name}"),
        ]
        kinds.append(f"_y_{name} double")
    totals = rows.withColumns(after).groupBy(*by, CHUNK).agg(*sums)
    # Groups within one chunk need nothing; of the others there are at most two rows a chunk.
    spread = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    several = totals.withColumn("_chunks", F.count(F.lit(1)).over(spread)).where(F.col("_chunks") > 1).drop("_chunks")

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(CHUNK)
        out = {CHUNK: group[CHUNK].to_numpy()[1:]}
        for name, (_, alpha) in columns.items():
            y, found = np.nan, []
            for n, first, end in zip(group[f"_n_{name}"], group[f"_first_{name}"], group[f"_end_{name}"]):
                if n:
                    y = (1 - alpha) ** n * (first if np.isnan(y) else y) + end
                found.append(y)
            out[f"_y_{name}"] = np.array(found[:-1], float)
        return pd.DataFrame(out)

    return several.groupBy(*by).applyInPandas(compose, ", ".join([f"{CHUNK} int", *kinds]))


def macd(
    df: DataFrame, by: Sequence[str], order_by: Sequence[str], price: str, fast: int = 12, slow: int = 26, signal: int = 9,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """`macd`: the fast less the slow exponential average of the price; `macd_signal`: the exponential average of that."""
    averages = {"_fast": (price, alpha_of(fast)), "_slow": (price, alpha_of(slow))}
    rows = exponential_averages(df, by, order_by, averages, rows_per_task)
    rows = rows.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    return exponential_averages(rows, by, order_by, {"macd_signal": ("macd", alpha_of(signal))}, rows_per_task)


def relative_strength(
    df: DataFrame, by: Sequence[str], order_by: Sequence[str], price: str, periods: int = 14, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """`rsi`, from 0 to 100: the averaged rises as a share of averaged rises and falls, each an exponential average with weight 1 / periods.

    Null on the first row and while the price has not moved.
    """
    change = {"_change": lambda w: F.col(price) - F.lag(price).over(w)}
    moves = ordered_window(df, by, order_by, 1, change, rows_per_task)
    moves = moves.withColumns({"_up": F.greatest("_change", F.lit(0.0)), "_down": F.greatest(-F.col("_change"), F.lit(0.0))})
    moves = moves.withColumns({c: F.when(F.col("_change").isNotNull(), F.col(c)) for c in ("_up", "_down")})
    averages = {"_rise": ("_up", 1 / periods), "_fall": ("_down", 1 / periods)}
    rows = exponential_averages(moves, by, order_by, averages, rows_per_task)
    share = F.try_divide(F.col("_rise"), F.col("_rise") + F.col("_fall"))
    return rows.withColumn("rsi", 100 * share).drop("_change", "_up", "_down", "_rise", "_fall")
