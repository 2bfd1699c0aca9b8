"""The batch job: stage the feeds, build the series, align them, check every table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.feeds import MEASURES, FeedSpec
from tickseries.functions.missing import complete_row, is_missing
from tickseries.functions.times import CALENDAR, event_time
from tickseries.operators.conform import rename_columns
from tickseries.operators.quality import assert_quality, check_contract
from tickseries.operators.series import PARITY_MEASURES, build_series, series_rows, sort_rows
from tickseries.plans.loads import (
    COMBINED, DROP, PARTITIONS, aligned, apply_load, bad_lines, check_new, good_rows, history_report, in_months, ledger, load_name, months_of,
    raw_rows, start_ledger,
)
from tickseries.session import use_utc
from tickseries.sinks.parquet import write_parquet
from tickseries.sources.csv import BAD_ROW, read_feed, under, union_by_name

__all__ = ["COMBINED", "DROP", "bad_lines", "good_rows", "history_report", "ledger"]


def stage(spark: SparkSession, feed: FeedSpec, input_root: str, output_root: str, load: str = "first") -> DataFrame:
    """Copy one raw feed to Parquet under its staging names, in one pass over the CSV, as the only load that staging has.

    With a schema the table also has the lines that do not fit it; `good_rows` and `bad_lines` tell them apart.
    """
    raw = rename_columns(read_feed(spark, feed, input_root), feed.renames).withColumn(DROP, F.lit(load))
    path = under(output_root, feed.staging_name)
    raw.write.mode("overwrite").partitionBy(DROP).parquet(path)
    return spark.read.schema(raw.schema).parquet(path).drop(DROP)


def run_series(
    spark: SparkSession, feed: FeedSpec, input_root: str, output_root: str, parity: bool = False, load: str = "first"
) -> tuple[DataFrame, DataFrame]:
    """Write the staging table, bad lines included, and the series table of one feed."""
    staged = stage(spark, feed, input_root, output_root, load)
    series = _write(build_series(good_rows(staged), feed, parity), under(output_root, feed.series_name), parity)
    return staged, series


def run_feeds(
    spark: SparkSession,
    feeds: Sequence[FeedSpec],
    input_root: str,
    output_root: str,
    parity: bool = False,
    combined: str = COMBINED,
    drop: str | None = None,
) -> dict[str, DataFrame]:
    """Run the whole job and return its tables by name: two per feed and the combined one. Tables that are there are replaced.

    The input root applies to the reads, the output root to the writes. Parity mode writes the plain tables sorted by
    minute. Default mode adds closes and timestamps, has one row per minute and partitions by year and month. The raw rows
    are the first load of the history in staging, under the name `drop` (see `run_increment`).
    """
    use_utc(spark)
    load = drop or load_name(spark, feeds, input_root)
    tables: dict[str, DataFrame] = {}
    loaded = []
    for feed in feeds:
        staged, series = run_series(spark, feed, input_root, output_root, parity, load)
        tables |= {feed.staging_name: staged, feed.series_name: series}
        loaded.append(_first_load(feed, load, staged, series, parity))
    wide = aligned([tables[feed.series_name] for feed in feeds], parity)
    tables[combined] = _write(wide, under(output_root, combined), parity)
    start_ledger(spark, output_root, loaded)
    return tables


def _first_load(feed: FeedSpec, load: str, staged: DataFrame, series: DataFrame, parity: bool) -> tuple:
    """The ledger's line for a full load: its rows are in the series, are unused, or are copies within a minute."""
    used = event_time(f"`{feed.ts_column}`", feed.ts_format).isNotNull() | F.lit(parity)
    used = used & complete_row(good_rows(staged)) if feed.drop_incomplete else used
    bad = F.col(BAD_ROW).isNotNull() if BAD_ROW in staged.columns else F.lit(False)
    n_rows, n_used = staged.agg(F.count(F.lit(1)), F.count_if(~bad & used)).first()
    found = F.collect_set(F.col("year") * 100 + F.col("month"))  # as many as a history has months
    n_minutes, months = series.agg(F.count(F.lit(1)), found).first()
    months = [] if parity else sorted(months)
    return (load, feed.name, n_rows, n_rows - n_used, n_used - n_minutes, n_minutes, 0, 0, months)


def run_increment(
    spark: SparkSession,
    feeds: Sequence[FeedSpec],
    input_root: str,
    output_root: str,
    drop: str | None = None,
    combined: str = COMBINED,
    replace: bool = False,
    rollups: bool = False,
) -> dict[str, DataFrame]:
    """Add a new drop of raw files to the tables of the default mode; returns the tables, of staging those rows that the drop has.

    Increments end where one load of all files would: of the rows of a minute, whichever drop they come from, the latest event
    stays. Staging keeps every drop under its name. Without a name it is made of the files' paths, sizes and times, so the same
    files again replace their part and others never do. A name that is loaded already is an error unless `replace` says that its raw rows
    are to be replaced; minutes that only they had stay in the series. Of all other tables the months that the drop has are read
    and written anew, in one commit (`sinks.commit`). `rollups` keeps up hour and day bars of every feed.
    """
    use_utc(spark)
    if drop:
        check_new(spark, output_root, drop, replace)
    raw = {feed.name: raw_rows(spark, feed, input_root) for feed in feeds}
    return apply_load(spark, feeds, raw, output_root, drop or load_name(spark, feeds, input_root), combined, rollups)


def _write(df: DataFrame, path: str, parity: bool) -> DataFrame:
    if parity:
        return write_parquet(sort_rows(df), path)
    return write_parquet(df, path, partition_by=PARTITIONS, sort_by=["timestamp"])


def _check_staging(staged: DataFrame, feed: FeedSpec, needs_rows: bool) -> DataFrame:
    """Everything that keeps a staged row out of the series, in one scan: bad lines, times that cannot be read, incomplete rows."""
    bad = F.col(BAD_ROW).isNotNull() if BAD_ROW in staged.columns else F.lit(False)
    good = good_rows(staged)
    no_time = ~bad & event_time(f"`{feed.ts_column}`", feed.ts_format).isNull()
    incomplete = ~bad & ~complete_row(good) if feed.drop_incomplete else F.lit(False)
    return _verdict(
        staged.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~bad & is_missing(staged.schema[feed.ts_column])).alias("n_missing"),
            F.count_if(bad).alias("n_bad_lines"),
            F.count_if(no_time).alias("n_bad_times"),
            F.count_if(incomplete).alias("n_incomplete"),
        ),
        feed.staging_name,
        feed.ts_column,
        needs_rows,
    )


def _check_key(table: DataFrame, name: str, key: str) -> DataFrame:
    none = F.lit(0).cast("long")
    missing = F.count_if(is_missing(table.schema[key])).alias("n_missing")
    counts = table.agg(F.count(F.lit(1)).alias("n_rows"), missing).select(
        "*", none.alias("n_bad_lines"), none.alias("n_bad_times"), none.alias("n_incomplete")
    )
    return _verdict(counts, name, key, True)


def _verdict(counts: DataFrame, table: str, key: str, needs_rows: bool) -> DataFrame:
    lost = F.col("n_missing") + F.col("n_bad_lines") + F.col("n_bad_times")
    passed = (lost == 0) & ((F.col("n_rows") > 0) if needs_rows else F.lit(True))
    return counts.select(F.lit(table).alias("table"), F.lit(key).alias("key"), "*", passed.alias("passed"))


def report(
    feeds: Sequence[FeedSpec], tables: Mapping[str, DataFrame], combined: str = COMBINED, increment: bool = False
) -> DataFrame:
    """Check every table of the job, staging with all its lines.

    A table fails if it has no rows, if its key is missing, and in staging also for lines that do not fit the schema and times that
    cannot be read, since these rows are in no series. Incomplete rows are counted; dropping them is what the feed asks
    for. With `increment`, a drop may have no rows of a feed.
    """
    checks = []
    for feed in feeds:
        checks.append(_check_staging(tables[feed.staging_name], feed, not increment))
        checks.append(_check_key(tables[feed.series_name], feed.series_name, "timestamp"))
    return union_by_name([*checks, _check_key(tables[combined], combined, "year")])


def contract_report(
    feeds: Sequence[FeedSpec], tables: Mapping[str, DataFrame], parity: bool = False, combined: str = COMBINED
) -> DataFrame:
    """The documented contract of the series and the combined table: required fields, one row per key, likely years."""
    measures = PARITY_MEASURES if parity else list(MEASURES)
    fields = {feed.name: [f"{feed.name}_{m}" for m in measures] for feed in feeds}
    checks = []
    for feed in feeds:
        series = tables[feed.series_name]
        ts = None if parity else "timestamp"
        checks.append(check_contract(series, feed.series_name, ["timestamp", *CALENDAR, *fields[feed.name]], CALENDAR, ts))
    every = reduce(list.__add__, fields.values())
    checks.append(check_contract(tables[combined], combined, [*CALENDAR, *every], CALENDAR))
    return union_by_name(checks)


def check(
    spark: SparkSession, feeds: Sequence[FeedSpec], tables: Mapping[str, DataFrame], output_root: str, parity: bool = False,
    combined: str = COMBINED, increment: bool = False,
) -> list[DataFrame]:
    """The reports that decide whether the job has succeeded: of the rows, of the contract of the tables, of the raw history.

    After an increment the contract is checked in the months that its rows are in; the others are as they were.
    """
    touched: set[int] = set()
    if increment:
        for feed in feeds:
            touched |= set(months_of(series_rows(good_rows(tables[feed.staging_name]), feed)))
        names = [combined, *(feed.series_name for feed in feeds)]
        changed = {**tables, **{name: in_months(tables[name], touched) for name in names}}
    contract = contract_report(feeds, changed if increment else tables, parity, combined)
    return [report(feeds, tables, combined, increment), contract, history_report(spark, feeds, output_root)]


def run_checked(spark: SparkSession, feeds, input_root: str, output_root: str, parity: bool = False) -> DataFrame:
    """`run_feeds` that fails when a check fails: of the rows, the contract or the raw history. Returns the report of the rows."""
    tables = run_feeds(spark, feeds, input_root, output_root, parity)
    reports = check(spark, feeds, tables, output_root, parity)
    for found in reports:
        assert_quality(found)
    return reports[0]
