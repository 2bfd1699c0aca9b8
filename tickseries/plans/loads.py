"""Loads of raw rows into the tables of the default mode: the raw history by load, the merge of its minutes, rollups, a ledger.

A load is a drop of raw files or a micro-batch of a stream. Staging keeps the raw rows of every load as a partition of its own; all other
tables are partitioned by year and month, and of them only the months that a load has are read and written, in one commit.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.feeds import FeedSpec
from tickseries.functions.times import CALENDAR, time_bucket
from tickseries.operators.align import align_join
from tickseries.operators.bars import resample
from tickseries.operators.conform import rename_columns
from tickseries.operators.series import series_rows
from tickseries.sinks.commit import Commit, recover
from tickseries.sinks.parquet import existing, replace_partitions
from tickseries.sources.csv import BAD_ROW, read_feed, under, union_by_name

COMBINED = "combined_timeseries"
# The partition of a staging table that holds one load of raw files.
DROP = "_drop"
LOADS = "_loads"
PARTITIONS = ["year", "month"]
LEDGER = (
    "load string, feed string, n_rows long, n_unused long, n_copies long, n_inserted long, n_corrected long, n_unchanged long, months array<int>"
)
ROLLUP = "timestamp timestamp, open double, high double, low double, close double, volume double, n_minutes long, year int, month int"
_CHANGE, _N_NEW = "_change", "_n_new"


def good_rows(staged: DataFrame) -> DataFrame:
    """The rows that fit the schema. The condition reaches the row groups, where the marker is nearly always null."""
    return staged.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW) if BAD_ROW in staged.columns else staged


def bad_lines(staged: DataFrame) -> DataFrame:
    return staged.where(F.col(BAD_ROW).isNotNull()) if BAD_ROW in staged.columns else staged.limit(0)


def load_name(spark: SparkSession, feeds: Sequence[FeedSpec], input_root: str) -> str:
    """A name for the files below the input root: its last part and a digest of their paths, sizes and times.

    The same files have the same name, so loading them again replaces what they gave; other files have another one, also below a
    root of the same name. Only listings are read.
    """
    parts = []
    for feed in feeds:
        try:
            files = spark.read.format("binaryFile").load(under(input_root, feed.path))
            parts.append(files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h")))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    digest = union_by_name(parts).agg(F.coalesce(F.sum("h"), F.lit(0))).first()[0] if parts else 0
    return f"{os.path.basename(input_root.rstrip('/'))}-{int(digest) % (1 << 64):016x}"


def raw_rows(spark: SparkSession, feed: FeedSpec, input_root: str) -> DataFrame:
    """The raw rows of a feed under their staging names; none if it has no folder."""
    try:
        return rename_columns(read_feed(spark, feed, input_root), feed.renames)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or feed.schema is None:
            raise
    return no_raw_rows(spark, feed)


def no_raw_rows(spark: SparkSession, feed: FeedSpec) -> DataFrame:
    return rename_columns(spark.createDataFrame([], feed.schema).withColumn(BAD_ROW, F.lit(None).cast("string")), feed.renames)


def stage_load(raw: DataFrame, feed: FeedSpec, output_root: str, load: str) -> DataFrame:
    """Add the raw rows of one load to staging, as a partition that the same load replaces; returns that partition. Other loads stay as they are."""
    rows = raw.withColumn(DROP, F.lit(load))
    return replace_partitions(rows, under(output_root, feed.staging_name), [DROP]).where(F.col(DROP) == load).drop(DROP)


def in_months(table: DataFrame, months: Iterable[int]) -> DataFrame:
    """The partitions of the given months, numbers like 202401."""
    return table.where((F.col("year") * 100 + F.col("month")).isin(sorted(months)))


def months_of(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(F.col("year") * 100 + F.col("month")).distinct().collect())  # as many as a history has months


def merge_changes(known: DataFrame, fresh: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The latest row of each key by `ts`, then by its values, with what the fresh rows did to it.

    `_change` is inserted, corrected or unchanged, null for keys without fresh rows; `_n_new` counts these. One aggregation, in
    which copies of a hot key collapse before the shuffle.
    """
    values = [ts, *[c for c in fresh.columns if c not in keys and c != ts]]
    row = F.struct(*[F.col(f"`{c}`") for c in values])
    both = known.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
    best = both.groupBy(*keys).agg(
        F.max(row).alias("_best"), F.max(F.when(~F.col("_new"), row)).alias("_known"), F.count_if("_new").alias(_N_NEW)
    )
    change = (
        F.when(F.col(_N_NEW) == 0, F.lit(None))
        .when(F.col("_known").isNull(), F.lit("inserted"))
        .when(F.col("_best") == F.col("_known"), F.lit("unchanged"))
        .otherwise(F.lit("corrected"))
    )
    columns = [F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in fresh.columns]
    return best.select(*columns, change.alias(_CHANGE), _N_NEW)


def apply_load(
    spark: SparkSession,
    feeds: Sequence[FeedSpec],
    raw: Mapping[str, DataFrame],
    output_root: str,
    load: str,
    combined: str = COMBINED,
    rollups: bool = False,
) -> dict[str, DataFrame]:
    """Add the raw rows of a load, by feed name, to all tables; returns the tables, of staging those rows that the load has.

    Staging takes the rows first. Then the new months of all other tables and the load's lines of the ledger are one commit, so a crash
    at any point followed by the same load ends in the same tables.
    """
    recover(spark, output_root)
    commit = Commit(spark, output_root, load)
    staged: dict[str, DataFrame] = {}
    merged: dict[str, DataFrame] = {}
    months: dict[str, list[int]] = {}
    ledger: list[tuple] = []
    for feed in feeds:
        if feed.name not in raw:
            continue
        rows = staged[feed.name] = stage_load(raw[feed.name], feed, output_root, load)
        fresh = series_rows(good_rows(rows), feed)
        months[feed.name] = months_of(fresh)
        table = existing(spark, under(output_root, feed.series_name), fresh.schema)
        known = in_months(table, months[feed.name]) if table is not None else fresh.limit(0)
        part = commit.add(feed.series_name, merge_changes(known, fresh, CALENDAR, "timestamp"), PARTITIONS, ["timestamp"], [_CHANGE, _N_NEW])
        merged[feed.name] = part.drop(_CHANGE, _N_NEW)
        ledger.append((load, feed.name, *_counts(rows, part), months[feed.name]))
        if rollups:
            _roll_up(commit, feed, part, output_root, months[feed.name])
    touched = sorted(set().union(*months.values())) if months else []
    series = [_present(spark, feed, output_root, merged.get(feed.name), set(months.get(feed.name, ())), touched) for feed in feeds]
    commit.add(combined, aligned(series), PARTITIONS, ["timestamp"])
    commit.add(LOADS, spark.createDataFrame(ledger, LEDGER), ["load", "feed"])
    commit.apply()
    tables: dict[str, DataFrame] = {}
    for feed, present in zip(feeds, series):
        tables[feed.staging_name] = staged[feed.name] if feed.name in staged else no_raw_rows(spark, feed)
        table = existing(spark, under(output_root, feed.series_name), present.schema)
        tables[feed.series_name] = table if table is not None else spark.createDataFrame([], present.schema)
    tables[combined] = spark.read.schema(aligned(series).schema).parquet(under(output_root, combined))
    return tables


def _counts(staged: DataFrame, part: DataFrame) -> list[int]:
    """Rows of the load, those in no series, copies within a minute, and the minutes by what became of them. They add up."""
    n_rows = staged.agg(F.count(F.lit(1))).first()[0]
    kinds = [F.count_if(F.col(_CHANGE) == k) for k in ("inserted", "corrected", "unchanged")]
    n_used, *minutes = part.agg(F.coalesce(F.sum(_N_NEW), F.lit(0)), *kinds).first()
    return [n_rows, n_rows - n_used, n_used - sum(minutes), *minutes]


def _present(spark, feed: FeedSpec, output_root: str, part: DataFrame | None, own: set[int], touched: Sequence[int]) -> DataFrame:
    """A feed's series in the touched months as it will be: the merged months, the table for the others."""
    schema = part.schema if part is not None else series_rows(good_rows(no_raw_rows(spark, feed)), feed).schema
    table = existing(spark, under(output_root, feed.series_name), schema)
    others = in_months(table, set(touched) - own) if table is not None else None
    if part is None:
        return others if others is not None else spark.createDataFrame([], schema)
    return part.unionByName(others) if others is not None and set(touched) - own else part


def aligned(series: Sequence[DataFrame], parity: bool = False) -> DataFrame:
    """In default mode the combined table has one timestamp, that of the first feed."""
    timed, untimed = ([], series) if parity else (series[:1], series[1:])
    return align_join([*timed, *[s.drop("timestamp") for s in untimed]])


# Rollups


def rollup_name(feed: FeedSpec, grain: str) -> str:
    return f"{feed.series_name}_by_{grain}"


def _bars(rows: DataFrame, grain: str, **fields) -> DataFrame:
    found = resample(rows, [], "timestamp", grain, **fields).withColumnRenamed("bucket", "timestamp")
    return found.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})


def _rebuilt(rows: DataFrame, changed: DataFrame, table: DataFrame | None, grain: str, total: Column, **fields) -> DataFrame:
    """The bars of the changed buckets from `rows`, and all others as they were. `changed` has the times of changed rows."""
    buckets = changed.select(time_bucket("timestamp", grain).alias("_bucket")).distinct()
    in_changed = rows.withColumn("_bucket", time_bucket("timestamp", grain)).join(buckets, "_bucket", "left_semi").drop("_bucket")
    minutes = in_changed.groupBy(time_bucket("timestamp", grain).alias("timestamp")).agg(total.alias("n_minutes"))
    fresh = _bars(in_changed, grain, **fields).drop("n_rows").join(minutes, "timestamp")
    if table is None:
        return fresh
    return table.join(buckets, table["timestamp"] == buckets["_bucket"], "left_anti").unionByName(fresh)


def _roll_up(commit: Commit, feed: FeedSpec, part: DataFrame, output_root: str, months: Sequence[int]) -> None:
    """Hour bars of the hours with changed minutes, and from the hours the day bars of their days."""
    changed = part.where(F.col(_CHANGE).isin("inserted", "corrected")).select("timestamp")
    fields = {c: f"{feed.name}_{c}" for c in ("open", "high", "low", "close", "volume")}
    rows, total = part, F.count(F.lit(1))
    for grain in ("hour", "day"):
        name = rollup_name(feed, grain)
        schema = _rebuilt(rows, changed, None, grain, total, **fields)
        table = existing(commit.spark, under(output_root, name), schema.schema)
        known = in_months(table, months) if table is not None else None
        rows = commit.add(name, _rebuilt(rows, changed, known, grain, total, **fields), PARTITIONS, ["timestamp"])
        fields, total = {}, F.sum("n_minutes")  # the next grain is made of these bars


def read_rollup(spark: SparkSession, feed: FeedSpec, output_root: str, grain: str) -> DataFrame:
    """The bars that loads with `rollups` have kept up."""
    return spark.read.schema(ROLLUP).parquet(under(output_root, rollup_name(feed, grain)))


# The ledger


def ledger(spark: SparkSession, output_root: str) -> DataFrame:
    """What each load did: its rows by feed, and how many were unused, copies, inserted, corrected and unchanged minutes."""
    schema = spark.createDataFrame([], LEDGER).schema
    found = existing(spark, under(output_root, LOADS), schema)
    return found.select(*schema.names) if found is not None else spark.createDataFrame([], LEDGER)


def start_ledger(spark: SparkSession, output_root: str, rows: Sequence[tuple]) -> None:
    """The ledger after a full load, which replaces all tables."""
    spark.createDataFrame(list(rows), LEDGER).write.mode("overwrite").partitionBy("load", "feed").parquet(under(output_root, LOADS))


def check_new(spark: SparkSession, output_root: str, load: str, replace: bool) -> None:
    """A load that is done may only be loaded again when that is asked for."""
    known = not ledger(spark, output_root).where(F.col("load") == load).isEmpty()
    if known and not replace:
        raise ValueError(f"{load!r} is loaded already: name the new load, or ask for its replacement")


def history_report(spark: SparkSession, feeds: Sequence[FeedSpec], output_root: str) -> DataFrame:
    """Whether staging still has what every load brought: (table, load, n_loaded, n_kept, passed).

    A load fails that has other rows in staging than it brought, that staging lacks, or that staging has and no ledger names: one that did not end.
    """
    loaded = ledger(spark, output_root)
    checks = []
    for feed in feeds:
        brought = loaded.where(F.col("feed") == feed.name).select("load", F.col("n_rows").alias("n_loaded"))
        # Only the partition column, as text: a name may look like a number.
        staged = spark.read.schema(f"{DROP} string").parquet(under(output_root, feed.staging_name))
        kept = staged.groupBy(F.col(DROP).alias("load")).agg(F.count(F.lit(1)).alias("n_kept"))
        both = brought.join(kept, "load", "full").select(
            F.lit(feed.staging_name).alias("table"), "load", "n_loaded", F.coalesce("n_kept", F.lit(0)).alias("n_kept")
        )
        checks.append(both.withColumn("passed", F.coalesce(F.col("n_loaded") == F.col("n_kept"), F.lit(False))))
    return union_by_name(checks)


