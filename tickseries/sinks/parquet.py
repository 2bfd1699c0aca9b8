"""Parquet sinks: overwrite, partitioned write, append of new keys only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickseries.functions.times import FIXED_GRAINS
from tickseries.operators.series import latest_per_key
from tickseries.session import materialize
from tickseries.sources.parquet import between


# An interval that holds no time.
NO_TIMES = (0, -1)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> DataFrame:
    """Write a table, optionally partitioned and clustered, and return it as read back.

    `sort_by` range-partitions on the partition and sort columns: files are sorted and do not overlap, so a
    condition on time skips files. The cut points come from a sample of the keys; a partition value that holds much of
    the table is spread over many files, as is a single sort key if `sort_by` ends in a unique column.
    Without `sort_by` the rows are only rebalanced, where AQE splits large partition values.
    """
    if sort_by:
        df = df.repartitionByRange(*partition_by, *sort_by).sortWithinPartitions(*partition_by, *sort_by)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # With its schema, since a partitioned table without rows has no file to take one from.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table at a path, None if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _append_unique(rows: DataFrame, path: str, keys: Sequence[str], ts: str, low: int, high: int) -> None:
    """Append the rows whose key is not in the table yet. The rows are unique by key, and the rows of the table with
    the same keys lie within the times low..high (microseconds): only that part of the table is read."""
    fresh = rows.withColumn("year", F.year(ts))
    table = existing(rows.sparkSession, path, fresh.schema)
    if table is not None:
        known = between(table, ts, F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high)))
        fresh = fresh.join(known.select(*keys), list(keys), "left_anti")
    order = [ts, *(k for k in keys if k not in (ts, "year"))]
    write_parquet(fresh, path, partition_by=["year"], sort_by=order, mode="append")


def replace_partitions(rows: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Replace the partitions that `rows` has, leave the others; returns the whole table. `rows` must not read the table."""
    if sort_by:
        rows = rows.repartitionByRange(*partition_by, *sort_by).sortWithinPartitions(*partition_by, *sort_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def merge_latest(batch: DataFrame, path: str, keys: Sequence[str], ts: str) -> tuple[DataFrame, list[int]]:
    """Merge a batch into a table partitioned by year, which must be a column of both: of the rows of a key the latest by `ts` stays.

    The result is that of one load of all rows, in whatever order batches come. Only the years of the batch are
    read and written anew, clustered by time, so files do not pile up. Rows without `ts` cannot be placed and are left out;
    the report of the job counts them. Returns the table and the years.
    """
    placed = batch.where(F.col(ts).isNotNull())
    years = sorted(r["year"] for r in placed.select("year").distinct().collect())  # a handful
    table = existing(batch.sparkSession, path, batch.schema)
    known = table.where(F.col("year").isin(years)) if table is not None and years else placed.limit(0)
    merged = materialize(latest_per_key(known.unionByName(placed), keys, [ts]), "merged")
    if not years and table is not None:
        return table, years
    return replace_partitions(merged, path, ["year"], [ts]), years


def compact_years(spark: SparkSession, path: str, schema: StructType, years: Sequence[int], sort_by: Sequence[str]) -> DataFrame:
    """Write the given years of a table anew, clustered: for tables that only `append_new` has written, after many batches."""
    rows = spark.read.schema(schema).parquet(path).where(F.col("year").isin(list(years)))
    return replace_partitions(materialize(rows, "compact"), path, ["year"], sort_by)


def append_new(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    tie_break: Sequence[str] = (),
    grain: str | None = None,
    bad_rows: str | None = None,
) -> tuple[int, int] | None:
    """Append the rows of `batch` whose key is not in the table yet; running it again adds nothing.

    A key belongs to one value of `ts`, or with `grain` to one bucket of that length. Copies within the batch are
    reduced to the latest one, in each task before the shuffle. The keys of the table are read only for the
    years and times the batch covers, so the cost follows the batch and not the table. The table is
    partitioned by the year of `ts`. Rows that lack a key or `ts` go to the table `bad_rows`, where a rerun may add them again;
    without such a table they are an error. Returns the covered times in microseconds, None for an empty batch.
    """
    bad = reduce(or_, (F.col(k).isNull() for k in (*keys, ts)))
    low, high, n_bad = batch.agg(
        F.unix_micros(F.min(F.when(~bad, F.col(ts))).cast("timestamp")),
        F.unix_micros(F.max(F.when(~bad, F.col(ts))).cast("timestamp")),
        F.count_if(bad),
    ).first()
    if n_bad and bad_rows is None:
        raise ValueError(f"{n_bad} rows lack a key {list(keys)} or {ts}: a rerun could not tell them from new rows")
    if n_bad:
        batch.where(bad).write.mode("append").parquet(bad_rows)
        batch = batch.where(~bad)
    times = None
    if low is not None:
        length = FIXED_GRAINS[grain] * 1_000_000 if grain else 1
        times = low - low % length, high - high % length + length - 1
    _append_unique(latest_per_key(batch, keys, [ts, *tie_break]), path, keys, ts, *(times or NO_TIMES))
    return times
