"""Running columns that look back without a bound, over ordered series of any length.

The rows are cut into consecutive chunks. Each chunk is summed up per group in one row, a prefix over these few rows
gives what lies before every chunk, and one pass over each chunk adds what lies before the row in it. No
task holds more than a chunk, however long a group is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickseries.operators.windows import CHUNK, chunks


@dataclass(frozen=True)
class Scan:
    """A running column: an associative operation in three forms.

    total   one value for the rows of a chunk (an aggregate)
    before  the value for several chunks, from their totals over a window
    upto    the value for the rows of a chunk up to the present one, over a window
    merge   the value for both, from that before the chunk (null if there is none) and that within it
    """

    total: Column
    before: Callable[[Column, WindowSpec], Column]
    upto: Callable[[WindowSpec], Column]
    merge: Callable[[Column, Column], Column]


def running_sum(value: Column) -> Scan:
    """The sum up to the row; nulls add nothing. Exact for integers and decimals, whatever the chunks."""
    value = F.coalesce(value, F.lit(0))
    return Scan(F.sum(value), lambda t, w: F.sum(t).over(w), lambda w: F.sum(value).over(w), lambda a, b: F.coalesce(a, F.lit(0)) + b)


def running_count() -> Scan:
    """The row's number in its group, from 1."""
    one = F.lit(1).cast("long")
    return Scan(F.count(one), lambda t, w: F.sum(t).over(w), lambda w: F.count(one).over(w), lambda a, b: F.coalesce(a, F.lit(0)) + b)


def running_extreme(value: Column, largest: bool = True) -> Scan:
    """The largest (or smallest) value up to the row."""
    of, both = (F.max, F.greatest) if largest else (F.min, F.least)
    return Scan(of(value), lambda t, w: of(t).over(w), lambda w: of(value).over(w), both)


def last_known(value: Column, order_by: Sequence[str]) -> Scan:
    """The last value that is not null, up to the row."""
    place = F.when(value.isNotNull(), F.struct(*order_by))
    return Scan(
        F.max_by(value, place),
        lambda t, w: F.last(t, ignorenulls=True).over(w),
        lambda w: F.last(value, ignorenulls=True).over(w),
        lambda a, b: F.coalesce(b, a),
    )


def running(
    df: DataFrame, by: Sequence[str], order_by: Sequence[str], columns: Mapping[str, Scan], rows_per_task: int | None = None
) -> DataFrame:
    """Add running columns within each `by` group, in the order of `order_by`, which must be unique in a group.

    Without `rows_per_task` a group is sorted in one task: right for groups that a task can hold, lazy. With it, groups are cut into chunks
    of about that size, with the same result: a count, and if one chunk is not enough a table in the working folder.
    One series without groups needs it.
    """
    if rows_per_task is None and not by:
        raise ValueError("one series without groups would be sorted in one task: give rows_per_task")
    rows = chunks(df, by, order_by, rows_per_task) if rows_per_task is not None else None
    upto = Window.partitionBy(*by, *([] if rows is None else [CHUNK])).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    here = {f"_upto_{name}": scan.upto(upto) for name, scan in columns.items()}
    if rows is None:
        done = df.withColumns(here)
        return done.withColumns({name: scan.merge(F.lit(None), F.col(f"_upto_{name}")) for name, scan in columns.items()}).drop(*here)
    carried = _before_chunks(rows, by, columns)
    same = reduce(and_, (F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in by), F.col(CHUNK) == F.col("_of_chunk"))
    joined = rows.withColumns(here).join(carried, same, "left")
    merged = {name: scan.merge(F.col(f"_before_{name}"), F.col(f"_upto_{name}")) for name, scan in columns.items()}
    return joined.withColumns(merged).select(*[F.col(f"`{c}`") for c in df.columns], *merged)


def _before_chunks(rows: DataFrame, by: Sequence[str], columns: Mapping[str, Scan]) -> DataFrame:
    """What lies before each chunk of the group that goes on into it: at most one row a chunk."""
    totals = rows.groupBy(*by, CHUNK).agg(*[scan.total.alias(f"_t_{name}") for name, scan in columns.items()])
    in_order = Window.partitionBy(*by).orderBy(CHUNK) if by else Window.partitionBy(F.lit(0)).orderBy(CHUNK)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumns(
        {"_first": F.row_number().over(in_order), **{f"_before_{name}": scan.before(F.col(f"_t_{name}"), earlier) for name, scan in columns.items()}}
    )
    names = [F.col(f"`{c}`").alias(f"_of_{c}") for c in by]
    return before.where(F.col("_first") > 1).select(*names, F.col(CHUNK).alias("_of_chunk"), *[f"_before_{name}" for name in columns])
