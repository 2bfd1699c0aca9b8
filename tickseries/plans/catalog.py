"""The registered queries: (spark, folder of the test tables) -> DataFrame.

`events` stands in for the price feeds: `event_type` is the asset ('click' is asset A, 'view' is asset B) and
`value` the price. The tables hold no missing values, so the queries about them derive some from the price by rule.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from tickseries.feeds import BTC, ETH
from tickseries.functions.times import CALENDAR, event_time, time_bucket, with_calendar
from tickseries.operators import align, bars, conform, quality, rolling, series, smoothing, stats
from tickseries.plans import daily
from tickseries.plans.loads import read_rollup
from tickseries.operators.windows import ROWS_PER_TASK
from tickseries.session import materialize, use_utc, work_dir
from tickseries.sinks.parquet import append_new, write_parquet
from tickseries.sources.csv import read_csv, read_csv_union, split_bad_rows, union_by_name
from tickseries.sources.parquet import between, read_parquet
from tickseries.streaming import clock as clocks
from tickseries.streaming import feeds as streaming
from tickseries.streaming.job import run_stream_job

A, B = "click", "view"
ASSETS = ["click", "error", "purchase", "signup", "view"]

EVENT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
MICROSECONDS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    return read_parquet(use_utc(spark), f"{sf_dir}/{name}.parquet", columns)


def ticks(spark: SparkSession, sf_dir: str, *assets: str) -> DataFrame:
    """Events as (event_id, ts, asset, price)."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("asset"), F.col("value").alias("price")
    )
    return rows.where(F.col("asset").isin(*assets)) if assets else rows


def gappy_price() -> Column:
    """Fixed rule: prices below 5 are null, above 150 NaN."""
    return F.when(F.col("value") < 5, F.lit(None)).when(F.col("value") > 150, F.lit(float("nan"))).otherwise(F.col("value"))


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("v", gappy_price())


def asset_minutes(spark: SparkSession, sf_dir: str, asset: str, prefix: str) -> DataFrame:
    """The distinct (minute, price) rows of one asset."""
    rows = ticks(spark, sf_dir, asset).select(
        time_bucket("ts", "minute").alias("timestamp"), F.col("price").alias(f"{prefix}_open")
    )
    return rows.distinct()


def in_calendar_order(rows: DataFrame) -> DataFrame:
    """Replace the minute by its calendar columns and sort by them."""
    measures = [c for c in rows.columns if c != "timestamp"]
    return series.sort_rows(with_calendar(rows, "timestamp").select(*CALENDAR, *measures))


PRICE = dict(open="price", high="price", low="price", close="price", volume="price")


def price_bars(spark: SparkSession, sf_dir: str, grain: str, *assets: str) -> DataFrame:
    return bars.resample(ticks(spark, sf_dir, *assets), ["asset"], "ts", grain, ["event_id"], **PRICE)


def hourly_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly closes of A and B side by side."""
    return align.align_bars(price_bars(spark, sf_dir, "hour", A, B), [A, B], ["close"])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Sources, sinks, inspection


def csv_scan(spark, sf_dir):
    path = work_dir(spark, "csv_scan")
    table(spark, sf_dir, "events").write.options(header=True, escape='"', **MICROSECONDS).csv(path)
    good, _ = split_bad_rows(read_csv(spark, path, EVENT_SCHEMA, escape='"', **MICROSECONDS))
    return good


def csv_bad_rows(spark, sf_dir):
    """Prices of the 'error' asset are written as text, so these lines do not fit the schema."""
    path = work_dir(spark, "csv_bad_rows")
    price = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    events = table(spark, sf_dir, "events").withColumn("value", price)
    events.write.options(header=True, escape='"', **MICROSECONDS).csv(path)
    good, bad = split_bad_rows(read_csv(spark, path, EVENT_SCHEMA, escape='"', **MICROSECONDS))
    both = union_by_name([good.withColumn("is_bad", F.lit(False)), bad.withColumn("is_bad", F.lit(True))])
    return both.withColumnRenamed("_bad_row", "bad_row")


def csv_multi_file_union(spark, sf_dir):
    """A folder per asset; their headers differ in order, and two lack `value`."""
    home = work_dir(spark, "csv_union")
    events = table(spark, sf_dir, "events")
    headers = {
        "click": ["event_id", "event_type", "value"],
        "error": ["value", "event_id", "event_type"],
        "purchase": ["event_type", "value", "event_id"],
        "signup": ["event_id", "event_type"],
        "view": ["event_type", "event_id"],
    }
    for name, columns in headers.items():
        events.where(F.col("event_type") == name).select(*columns).write.options(header=True).csv(f"{home}/{name}")
    union = read_csv_union(spark, [f"{home}/{name}" for name in headers], EVENT_SCHEMA)
    return split_bad_rows(union)[0]


def parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def parquet_roundtrip(spark, sf_dir):
    path = work_dir(spark, "roundtrip")
    return write_parquet(table(spark, sf_dir, "orders"), path)


def partitioned_roundtrip(spark, sf_dir):
    path = work_dir(spark, "partitioned")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    write_parquet(orders, path, partition_by=["year"], sort_by=["o_orderdate", "o_orderkey"])
    return read_parquet(spark, path).where(F.col("year") == 1996)


def partitioned_time_range(spark, sf_dir):
    """A condition on the time prunes both the year partitions and the row groups."""
    path = work_dir(spark, "time_range")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    write_parquet(orders, path, partition_by=["year"], sort_by=["o_orderdate", "o_orderkey"])
    return between(read_parquet(spark, path), "o_orderdate", "1996-11-01", "1997-02-01")


def sql_view_select(spark, sf_dir):
    with_calendar(table(spark, sf_dir, "events"), "ts").createOrReplaceTempView("tickseries_events")
    return spark.sql(
        """
        SELECT DISTINCT year, month, day, hour, minute, event_type
        FROM tickseries_events
        ORDER BY year, month, day, hour, minute, event_type
        """
    )


def preview_topk(spark, sf_dir):
    return quality.preview(table(spark, sf_dir, "events"), ["ts", "event_id"])


def schema_listing(spark, sf_dir):
    return quality.schema_listing(table(spark, sf_dir, "events"), count_values=True)


# Projections and cleaning


def rename_columns(spark, sf_dir):
    raw = table(spark, sf_dir, "events").withColumnsRenamed({"value": "Volume_(BTC)", "ts": "Timestamp"})
    return conform.snake_case_columns(conform.rename_columns(raw, {"Volume_(BTC)": "Volume_BTC"}))


def conform_columns(spark, sf_dir):
    feed = replace(BTC, name="a", measures={m: "value" for m in BTC.measures})
    rows = table(spark, sf_dir, "events")
    measures = conform.measure_columns(feed, series.PARITY_MEASURES)
    return rows.select(F.col("event_type").alias("asset"), F.col("ts").alias("timestamp"), *measures)


def calendar_parts(spark, sf_dir):
    return with_calendar(table(spark, sf_dir, "events", ["event_id", "ts"]), "ts")


def epoch_to_timestamp(spark, sf_dir):
    """Every unit and form, with numbers before 1970, fractions, text that is no time, and numbers beyond the year 9999."""
    rows = table(spark, sf_dir, "events", ["event_id", "ts"])
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    raw = rows.select(
        "event_id",
        F.floor(micros / 1_000_000).cast("bigint").alias("s"),
        F.floor(micros / 1_000).cast("bigint").alias("ms"),
        micros.alias("us"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("slashed"),
    )
    forms = {
        "from_s": ("s", "epoch_s"),
        "from_ms": ("ms", "epoch_ms"),
        "from_us": ("us", "epoch_us"),
        "from_ns": (F.col("us") * 1_000, "epoch_ns"),
        "from_text": ("text", "string"),
        "mixed_ms": (F.col("ms").cast("string"), "string_or_ms"),
        "mixed_text": ("text", "string_or_ms"),
        "negative": (-F.col("s"), "epoch_s"),
        "fraction": (F.concat(F.col("s").cast("string"), F.lit(".5")), "epoch_s"),
        "no_number": (F.concat(F.lit("x"), F.col("s").cast("string")), "epoch_s"),
        "no_time": (F.concat(F.lit("x"), F.col("text")), "timestamp"),
        "slashes": ("slashed", "string_or_ms"),
        "too_large": ("us", "epoch_s"),
        "overflow": (F.concat(F.col("us").cast("string"), F.lit("000000000000000000")), "epoch_ms"),
    }
    columns = [event_time(F.col(c) if isinstance(c, str) else c, form).alias(name) for name, (c, form) in forms.items()]
    return raw.select("event_id", *columns)


def drop_incomplete_rows(spark, sf_dir):
    return series.drop_incomplete(gappy(spark, sf_dir))


# Series, join, union


def distinct_series(spark, sf_dir):
    """The distinct (minute, price) rows of every asset."""
    rows = ticks(spark, sf_dir).select(time_bucket("ts", "minute").alias("timestamp"), "asset", F.col("price").alias("open"))
    return in_calendar_order(rows.distinct())


def both_minutes(spark, sf_dir) -> list[DataFrame]:
    return [asset_minutes(spark, sf_dir, A, "a"), asset_minutes(spark, sf_dir, B, "b")]


def align_join_minute(spark, sf_dir):
    """The join of two series that have one row per minute, so it has at most one row per minute.

    In UTC the minute is one key with the meaning of the five calendar columns, which are split off afterwards. Of
    series with several rows per minute an inner join has all combinations; `align_fan_out` counts them without joining.
    """
    latest = series.latest_per_bucket(ticks(spark, sf_dir, A, B), "minute", tie_break=["event_id"])
    sides = [
        latest.where(F.col("asset") == asset).select(F.col("bucket").alias("timestamp"), F.col("price").alias(f"{prefix}_open"))
        for asset, prefix in ((A, "a"), (B, "b"))
    ]
    return in_calendar_order(align.align_join(sides, ["timestamp"]))


def latest_minutes(spark, sf_dir, assets, how: str) -> DataFrame:
    latest = series.latest_per_bucket(ticks(spark, sf_dir, *assets), "minute", tie_break=["event_id"])
    return align.align_bars(latest, assets, ["price"], how=how)


def align_latest_minute(spark, sf_dir):
    """One row per asset and minute first, so a minute with many rows yields one row, not all pairs."""
    return latest_minutes(spark, sf_dir, [A, B], "inner")


def multi_asset_minutes(spark, sf_dir):
    """Five assets side by side in one shuffle; a minute that only some have stays."""
    return latest_minutes(spark, sf_dir, ASSETS, "outer")


def align_fan_out(spark, sf_dir):
    return align.fan_out(both_minutes(spark, sf_dir), ["timestamp"])


def union_all_series(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return union_by_name(events.where(F.col("event_type") == name) for name in ASSETS)


# Counts and checks


def row_count(spark, sf_dir):
    return quality.row_count(table(spark, sf_dir, "events"))


def non_null_count(spark, sf_dir):
    return quality.non_null_count(gappy(spark, sf_dir), "v")


def null_key_count(spark, sf_dir):
    return quality.missing_count(gappy(spark, sf_dir), "v", nan_is_missing=False)


def null_or_nan_count(spark, sf_dir):
    return quality.missing_count(gappy(spark, sf_dir), "v")


def null_profile(spark, sf_dir):
    return quality.null_profile(gappy(spark, sf_dir))


def quality_report(spark, sf_dir):
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey", "documents": "doc_id"}
    tables = {name: (table(spark, sf_dir, name), key) for name, key in keys.items()}
    tables["events_gappy"] = (gappy(spark, sf_dir), "v")
    return quality.quality_report(tables)


def year_range_check(spark, sf_dir):
    """Times read with the right and with the wrong epoch unit."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = table(spark, sf_dir, "events", ["ts"]).select(
        event_time(millis, "epoch_ms").alias("right"), event_time(millis, "epoch_s").alias("wrong")
    )
    counts = [
        quality.year_out_of_range_count(rows, unit).select(F.lit(unit).alias("unit"), "n_out_of_range")
        for unit in ("right", "wrong")
    ]
    return union_by_name(counts)


def duplicate_keys(spark, sf_dir):
    rows = ticks(spark, sf_dir).select(time_bucket("ts", "minute").alias("bucket"), "asset")
    return quality.duplicate_keys(rows, ["bucket", "asset"])


def missing_buckets(spark, sf_dir):
    return align.missing_buckets(ticks(spark, sf_dir), time_bucket("ts", "minute"), "asset", A, B)


# The whole job on raw CSV feeds

FEED_A = replace(BTC, name="a", path="feed_a")
FEED_B = replace(ETH, name="b", path="feed_b")


def _write_raw_feeds(spark, sf_dir, root: str, when: str = "true", spoilt: bool = False, price_factor: int = 1, mode: str = "error") -> None:
    """Minute bars of A and B as raw CSV feeds. Fixed rule: minutes of A with a high above 150 have NaN prices.

    `spoilt`: the opens of A are no numbers in the seventh minute of an hour, the times of B have slashes in the ninth.
    `price_factor`: multiplies the prices of B.
    """
    minute = materialize(price_bars(spark, sf_dir, "minute", A, B).where(when), "minutes")
    no_number = F.lit(spoilt) & (F.minute("bucket") == 7)
    slashes = F.lit(spoilt) & (F.minute("bucket") == 9)
    gap = F.col("high") > 150

    def price(name: str) -> Column:
        return F.when(gap, F.lit(float("nan"))).otherwise(F.col(name))

    n = F.col("n_rows").cast("double")
    minute.where(F.col("asset") == A).select(
        F.unix_seconds("bucket").alias("Timestamp"),
        F.when(no_number, F.lit("n/a")).otherwise(price("open").cast("string")).alias("Open"),
        price("high").alias("High"),
        price("low").alias("Low"),
        price("close").alias("Close"),
        n.alias("Volume_(BTC)"),
        (n * 2).alias("Volume_(Currency)"),
        price("close").alias("Weighted_Price"),
    ).write.mode(mode).options(header=True).csv(f"{root}/{FEED_A.path}")
    minute.where(F.col("asset") == B).select(
        F.when(slashes, F.date_format("bucket", "yyyy/MM/dd HH:mm:ss")).otherwise(F.date_format("bucket", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        *[(F.col(c) * price_factor).alias(c) for c in ("open", "high", "low", "close")],
        n.alias("volume"),
        (F.unix_millis("bucket") + 59_999).alias("close_time"),
        F.col("close").alias("quote_av"),
        F.col("n_rows").alias("trades"),
        n.alias("tb_base_av"),
        n.alias("tb_quote_av"),
        n.alias("ignore"),
    ).write.mode(mode).options(header=True).csv(f"{root}/{FEED_B.path}")


def _run_job(spark, sf_dir, parity: bool, **raw) -> dict[str, DataFrame]:
    root = work_dir(use_utc(spark), "job")
    _write_raw_feeds(spark, sf_dir, root, **raw)
    return daily.run_feeds(spark, [FEED_A, FEED_B], root, f"{root}/out", parity)


def _one_feed(spark, sf_dir, feed):
    root = work_dir(use_utc(spark), "feed")
    _write_raw_feeds(spark, sf_dir, root)
    return daily.run_series(spark, feed, root, f"{root}/out", parity=True)


def staged_feed(spark, sf_dir):
    """The staging table of feed A."""
    return daily.good_rows(_one_feed(spark, sf_dir, FEED_A)[0])


def staged_feed_b(spark, sf_dir):
    """The staging table of feed B."""
    return daily.good_rows(_one_feed(spark, sf_dir, FEED_B)[0])


def series_parity(spark, sf_dir):
    """The series table of feed A: incomplete rows gone, no close."""
    return _one_feed(spark, sf_dir, FEED_A)[1]


def series_parity_b(spark, sf_dir):
    """The series table of feed B."""
    return _one_feed(spark, sf_dir, FEED_B)[1]


def combined_parity(spark, sf_dir):
    return _run_job(spark, sf_dir, parity=True)[daily.COMBINED]


def combined_default(spark, sf_dir):
    return _run_job(spark, sf_dir, parity=False)[daily.COMBINED]


JOB_FEEDS = [FEED_A, FEED_B]


def _loaded(spark, sf_dir) -> str:
    """A full load and two drops of raw files, which overlap by ten days; returns the folder of the tables. The first drop has other
    prices of B, which the second one restates."""
    root = work_dir(use_utc(spark), "increments")
    _write_raw_feeds(spark, sf_dir, f"{root}/first", "bucket < '2024-01-10'")
    _write_raw_feeds(spark, sf_dir, f"{root}/wrong", "bucket >= '2024-01-10' AND bucket < '2024-01-20'", price_factor=-1)
    _write_raw_feeds(spark, sf_dir, f"{root}/second", "bucket >= '2024-01-10'")
    daily.run_feeds(spark, JOB_FEEDS, f"{root}/first", f"{root}/out", drop="first")
    for drop in ("wrong", "second"):
        daily.run_increment(spark, JOB_FEEDS, f"{root}/{drop}", f"{root}/out", drop)
    return root


def incremental_job(spark, sf_dir):
    """The combined table after a full load and two drops, the second one loaded once more."""
    root = _loaded(spark, sf_dir)
    return daily.run_increment(spark, JOB_FEEDS, f"{root}/second", f"{root}/out", "second", replace=True)[daily.COMBINED]


def load_history(spark, sf_dir):
    """What each load brought and changed, beside the raw rows that staging has of it."""
    out = f"{_loaded(spark, sf_dir)}/out"
    kept = daily.history_report(spark, JOB_FEEDS, out).select("load", F.regexp_replace("table", "staging_", "").alias("feed"), "n_kept")
    return daily.ledger(spark, out).drop("months").join(kept, ["load", "feed"])


def stream_job(spark, sf_dir):
    """The combined table kept up by streams of both feeds, whose files come in two parts that overlap by ten days."""
    root = work_dir(use_utc(spark), "stream_job")
    for when in ("bucket < '2024-01-20'", "bucket >= '2024-01-10'"):
        _write_raw_feeds(spark, sf_dir, f"{root}/in", when, mode="append")
        run_stream_job(spark, JOB_FEEDS, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
    return read_parquet(spark, f"{root}/out/{daily.COMBINED}")


def rollup_increments(spark, sf_dir):
    """Hour and day bars of feed A after four drops that overlap by five days."""
    root = work_dir(use_utc(spark), "rollups")
    for i in range(4):
        when = f"day(bucket) >= {1 + 7 * i} AND day(bucket) < {40 if i == 3 else 13 + 7 * i}"
        _write_raw_feeds(spark, sf_dir, f"{root}/{i}", when)
        daily.run_increment(spark, JOB_FEEDS[:1], f"{root}/{i}", f"{root}/out", rollups=True)
    grains = [read_rollup(spark, FEED_A, f"{root}/out", g).withColumn("grain", F.lit(g)).drop("year", "month") for g in ("hour", "day")]
    return union_by_name(grains)


def job_quality(spark, sf_dir):
    return daily.report([FEED_A, FEED_B], _run_job(spark, sf_dir, parity=True))


def job_quality_bad_rows(spark, sf_dir):
    """Feeds with lines that do not fit and times that cannot be read: counted, and the check fails."""
    return daily.report([FEED_A, FEED_B], _run_job(spark, sf_dir, parity=False, spoilt=True))


def contract_report(spark, sf_dir):
    """The tables of the job, which keep their contract, and ticks that do not: missing prices, several per minute, odd years."""
    good = daily.contract_report([FEED_A, FEED_B], _run_job(spark, sf_dir, parity=False))
    late = F.col("ts").cast("timestamp") + F.when(F.col("value") > 140, F.expr("INTERVAL 100 YEARS")).otherwise(F.expr("INTERVAL 0 YEARS"))
    rows = gappy(spark, sf_dir).withColumn("ts", late).withColumn("minute", time_bucket("ts", "minute"))
    bad = quality.check_contract(rows, "ticks", ["event_id", "ts", "v"], ["minute", "event_type"], "ts")
    return union_by_name([good, bad])


# Bars and statistics


def ohlc_resample(spark, sf_dir):
    return rounded(price_bars(spark, sf_dir, "hour"), "volume")


def ohlc_rollup(spark, sf_dir):
    """Day bars from hour bars: the buckets are unique, so the hash aggregate needs no tie break."""
    hour = price_bars(spark, sf_dir, "hour").withColumnRenamed("bucket", "ts")
    return rounded(bars.resample(hour, ["asset"], "ts", "day"), "volume").withColumnRenamed("n_rows", "n_hours")


def align_with_close(spark, sf_dir):
    wide = align.align_bars(
        price_bars(spark, sf_dir, "hour", A, B), [A, B], ["open", "high", "low", "close", "volume"]
    )
    return rounded(with_calendar(wide.withColumnRenamed("bucket", "timestamp"), "timestamp"), f"{A}_volume", f"{B}_volume")


def align_all_hours(spark, sf_dir):
    """The same alignment without losing hours that only one asset has."""
    return align.align_bars(price_bars(spark, sf_dir, "hour", A, B), [A, B], ["close"], how="outer")


def multi_asset_pivot(spark, sf_dir):
    return align.pivot_assets(
        ticks(spark, sf_dir), time_bucket("ts", "day").alias("bucket"), "asset", ASSETS, n=F.count(F.lit(1))
    ).na.fill(0)


def simple_returns(spark, sf_dir, **size):
    return rounded(
        stats.simple_returns(ticks(spark, sf_dir), ["asset"], ["ts", "event_id"], ["price"], **size), "price_return"
    )


def moving_average(spark, sf_dir, **size):
    return rounded(
        stats.moving_average(ticks(spark, sf_dir), ["asset"], ["ts", "event_id"], "price", 5, **size), "moving_avg"
    )


def rolling_stddev(spark, sf_dir, **size):
    return rounded(
        stats.rolling_stddev(ticks(spark, sf_dir), ["asset"], ["ts", "event_id"], "price", 20, **size), "rolling_stddev"
    )


def _split(spark, sf_dir) -> dict:
    """Chunks of a tenth of the table, so that each asset's history spans several."""
    return {"rows_per_task": max(1, table(spark, sf_dir, "events").count() // 10)}


def simple_returns_split(spark, sf_dir):
    """`simple_returns` with assets too long for one task."""
    return simple_returns(spark, sf_dir, **_split(spark, sf_dir))


def moving_average_split(spark, sf_dir):
    """`moving_average` with assets too long for one task."""
    return moving_average(spark, sf_dir, **_split(spark, sf_dir))


def hourly_returns(spark, sf_dir):
    prices = [f"{A}_close", f"{B}_close"]
    return stats.simple_returns(hourly_closes(spark, sf_dir), [], ["bucket"], prices, rows_per_task=ROWS_PER_TASK)


def return_correlation(spark, sf_dir):
    return rounded(
        stats.correlation(hourly_returns(spark, sf_dir), f"{A}_close_return", f"{B}_close_return"), "corr"
    )


def return_correlation_daily(spark, sf_dir):
    day = time_bucket("bucket", "day").alias("day")
    result = stats.correlation(hourly_returns(spark, sf_dir), f"{A}_close_return", f"{B}_close_return", [day])
    return rounded(result, "corr")


def rolling_correlation(spark, sf_dir):
    result = stats.rolling_correlation(
        hourly_closes(spark, sf_dir), [], ["bucket"], f"{A}_close", f"{B}_close", 24, rows_per_task=ROWS_PER_TASK
    )
    return rounded(result.where(F.col("rolling_corr").isNotNull()), "rolling_corr").select("bucket", "rolling_corr")


def trend_regression(spark, sf_dir):
    hourly = price_bars(spark, sf_dir, "hour")
    day = F.unix_seconds("bucket") / 86_400 - 19_700
    return rounded(
        stats.trend(hourly.select("asset", "close", day.alias("day")), ["asset"], "close", "day"), "slope", "intercept", "r2"
    )


def close_lags(spark, sf_dir):
    """The hourly close of every asset with its two previous closes."""
    closes = price_bars(spark, sf_dir, "hour").select("asset", "bucket", "close")
    return stats.lag_features(closes, ["asset"], ["bucket"], "close", 2)


def lag_regression(spark, sf_dir):
    """Per asset, the hourly close on its two previous closes."""
    fitted = stats.fit_linear(close_lags(spark, sf_dir), "close", ["lag_1", "lag_2"], ["asset"])
    return rounded(fitted, "intercept", "coef_lag_1", "coef_lag_2")


def lag_prediction(spark, sf_dir):
    """The close that each asset's regression predicts for every hour."""
    lags, features = close_lags(spark, sf_dir), ["lag_1", "lag_2"]
    predicted = stats.predict_linear(lags, stats.fit_linear(lags, "close", features, ["asset"]), features, ["asset"])
    return rounded(predicted.drop(*features), "predicted", digits=4)


def walk_forward(spark, sf_dir):
    """Every hourly close predicted from its two previous closes by a fit on earlier days only."""
    return rounded(_walk_forward(spark, sf_dir).drop("lag_1", "lag_2"), "predicted", digits=4)


def _walk_forward(spark, sf_dir):
    day = time_bucket("bucket", "day")
    return stats.walk_forward(close_lags(spark, sf_dir), "close", ["lag_1", "lag_2"], ["asset"], day)


def walk_forward_errors(spark, sf_dir):
    """Per asset, how far the predictions for days that their fit has not seen are off, beside taking the previous close."""
    errors = stats.forecast_errors(_walk_forward(spark, sf_dir), "close", "predicted", ["asset"], "lag_1")
    return rounded(errors, *[c for c in errors.columns if c not in ("asset", "n")], digits=4)


def next_hour_forecast(spark, sf_dir):
    """Per asset, the close of the hour after the last one, by the regression on all hours."""
    lags = close_lags(spark, sf_dir)
    fitted = stats.fit_linear(lags, "close", ["lag_1", "lag_2"], ["asset"])
    found = stats.next_value(lags, fitted, "close", 2, ["asset"], ["bucket"])
    return rounded(found.withColumn("bucket", F.col("bucket") + F.expr("INTERVAL 1 HOUR")), "predicted", digits=4)


def lead_lag_correlation(spark, sf_dir):
    """The hourly returns of five assets against each other's up to three hours earlier."""
    closes = align.align_bars(price_bars(spark, sf_dir, "hour"), ASSETS, ["close"], how="outer")
    returns = stats.simple_returns(closes, [], ["bucket"], [f"{a}_close" for a in ASSETS], rows_per_task=ROWS_PER_TASK)
    values = {a: f"{a}_close_return" for a in ASSETS}
    return rounded(stats.lead_lag_correlation(returns, ["bucket"], values, 3), "corr")


# Running columns over assets too long for one task


def align_last_known(spark, sf_dir):
    """The latest tick of A in each minute with the last price of B at or before it, if that is at most ten minutes old."""
    latest = series.latest_per_bucket(ticks(spark, sf_dir, A), "minute", tie_break=["event_id"])
    known = {"price": "b_price", "ts": "b_ts"}
    return align.align_last_known(
        latest.select("event_id", "ts", "price"), ticks(spark, sf_dir, B), "ts", known, ["event_id"], tolerance=600, **_split(spark, sf_dir)
    )


def align_last_known_assets(spark, sf_dir):
    """Every tick of an asset with the last purchase of the same user, however long ago."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    bought = events.where(F.col("event_type") == "purchase")
    asked = events.where(F.col("event_type") != "purchase").select("event_id", "ts", "user_id")
    return align.align_last_known(asked, bought, "ts", {"value": "paid", "event_id": "purchase_id"}, ["event_id"], ["user_id"], **_split(spark, sf_dir))


def volume_bars(spark, sf_dir):
    """Bars of each asset that end whenever another thousand has been traded."""
    found = bars.size_bars(ticks(spark, sf_dir), ["asset"], ["ts", "event_id"], 1000, "price", **_split(spark, sf_dir), **PRICE)
    return rounded(found, "volume", digits=4)


def row_bars(spark, sf_dir):
    """Bars of fifty ticks of each asset."""
    found = bars.size_bars(ticks(spark, sf_dir), ["asset"], ["ts", "event_id"], 50, **_split(spark, sf_dir), **PRICE)
    return rounded(found, "volume", digits=4)


def gap_intervals(spark, sf_dir):
    """The minutes without a tick of each asset, as intervals of at least a quarter of an hour."""
    return align.gap_intervals(ticks(spark, sf_dir), "asset", "ts", "minute", 15, **_split(spark, sf_dir))


def rolling_statistics(spark, sf_dir):
    """Mean, deviation, least and largest price of the last 200 ticks of each asset."""
    found = rolling.rolling_statistics(ticks(spark, sf_dir), ["asset"], ["ts", "event_id"], "price", 200, **_split(spark, sf_dir))
    return rounded(found, "rolling_avg", "rolling_stddev")


def _hour_closes(spark, sf_dir) -> DataFrame:
    return price_bars(spark, sf_dir, "hour").select("asset", "bucket", "close")


def _few_hours(hours: DataFrame) -> dict:
    """Chunks of a third of the hours of an asset."""
    return {"rows_per_task": max(2, hours.count() // 15)}


def exponential_averages(spark, sf_dir):
    """Exponential averages of every asset's hourly closes over 10 and 50 hours."""
    hours = materialize(_hour_closes(spark, sf_dir), "hours")
    averages = {f"ema_{n}": ("close", smoothing.alpha_of(n)) for n in (10, 50)}
    return rounded(smoothing.exponential_averages(hours, ["asset"], ["bucket"], averages, **_few_hours(hours)), *averages)


def macd(spark, sf_dir):
    hours = materialize(_hour_closes(spark, sf_dir), "hours")
    return rounded(smoothing.macd(hours, ["asset"], ["bucket"], "close", **_few_hours(hours)), "macd", "macd_signal")


def relative_strength(spark, sf_dir):
    hours = materialize(_hour_closes(spark, sf_dir), "hours")
    return rounded(smoothing.relative_strength(hours, ["asset"], ["bucket"], "close", **_few_hours(hours)), "rsi", digits=5)


# Incremental and streaming


def incremental_append(spark, sf_dir):
    """Two batches that overlap by ten days, each appended twice."""
    path = f"{work_dir(use_utc(spark), 'append')}/table"
    rows = ticks(spark, sf_dir)
    for batch in (rows.where("ts < '2024-01-20'"), rows.where("ts >= '2024-01-10'")):
        for _ in range(2):
            append_new(batch, path, ["event_id"], "ts")
    return read_parquet(spark, path)


def _tick_stream(spark, sf_dir) -> DataFrame:
    # A glob, since a stream reads a folder or a glob and the table may be one file.
    stream = streaming.read_stream(use_utc(spark), f"{sf_dir}/events.parquet*", EVENT_SCHEMA)
    return streaming.with_event_time(stream, "ts", "1 hour").select(
        "event_id", "ts", F.col("event_type").alias("asset"), F.col("value").alias("price")
    )


def stream_tumbling_ohlc(spark, sf_dir):
    windows = streaming.tumbling_bars(_tick_stream(spark, sf_dir), ["asset"], "ts", "1 hour", ["event_id"], **PRICE)
    return rounded(streaming.run_available(windows, "stream_bars"), "volume")


def stream_feed_bars(spark, sf_dir):
    """Hour bars from the raw CSV minutes of feed A as they arrive."""
    root = work_dir(use_utc(spark), "stream_feed")
    _write_raw_feeds(spark, sf_dir, root)
    minutes = streaming.feed_stream(spark, FEED_A, root, "1 hour")
    return streaming.run_available(streaming.tumbling_bars(minutes, ["asset"], "ts", "1 hour"), "stream_feed_bars")


def _run_to_the_end(spark, sf_dir, purpose: str, build) -> DataFrame:
    """Run the stream that `build` makes of the clock's folder: from the first event, with six feeds named, and on to two days after the last."""
    home = work_dir(use_utc(spark), purpose)
    clock = f"{home}/clock"
    first, last = ticks(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    clocks.name_feeds(spark, clock, [*ASSETS, "refund"], first)
    stream = build(clock)
    streaming.write_available(stream, f"{home}/table", f"{home}/checkpoint")
    clocks.pass_time(spark, clock, last + timedelta(days=2))
    streaming.write_available(stream, f"{home}/table", f"{home}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{home}/table")


def _clocked_ticks(spark, sf_dir, clock: str, *assets: str) -> DataFrame:
    stream = streaming.read_stream(spark, f"{sf_dir}/events.parquet*", EVENT_SCHEMA)
    rows = stream.select("event_id", "ts", F.col("event_type").alias("asset"), F.col("value").alias("price"))
    return clocks.with_clock(rows.where(F.col("asset").isin(*assets)) if assets else rows, clock, "ts", "1 hour")


def stream_last_windows(spark, sf_dir):
    """The hour bars of `stream_tumbling_ohlc` with those that only the clock closes."""

    def build(clock):
        rows = clocks.without_clock(_clocked_ticks(spark, sf_dir, clock), "ts")
        return streaming.tumbling_bars(rows, ["asset"], "ts", "1 hour", ["event_id"], **PRICE)

    return rounded(_run_to_the_end(spark, sf_dir, "stream_last", build), "volume")


def stream_join(spark, sf_dir):
    """The last prices of A and B side by side for every minute that either has: a join of two streams."""

    def build(clock):
        sides = (
            clocks.last_in_window(
                clocks.without_clock(_clocked_ticks(spark, sf_dir, clock, a), "ts"), "ts", "1 minute", "price", f"{a}_close", ["event_id"]
            )
            for a in (A, B)
        )
        return clocks.join_windows(*sides)

    return _run_to_the_end(spark, sf_dir, "stream_join", build)


def stream_silent_feeds(spark, sf_dir):
    """Every silence of half an hour or more of six feeds, one of which never sends a row."""
    return _run_to_the_end(
        spark, sf_dir, "stream_silent", lambda clock: clocks.silent_feeds(_clocked_ticks(spark, sf_dir, clock), "ts", 60, 30)
    )


def stream_align(spark, sf_dir):
    windows = streaming.tumbling_align(_tick_stream(spark, sf_dir), "asset", [A, B], "ts", "1 minute", "price", ["event_id"])
    return streaming.run_available(windows, "stream_align")


def stream_drop_copies(spark, sf_dir):
    """Every event arrives twice."""
    source = work_dir(use_utc(spark), "copies")
    events = table(spark, sf_dir, "events")
    events.write.parquet(source)
    events.write.mode("append").parquet(source)
    stream = streaming.with_event_time(streaming.read_stream(spark, source, EVENT_SCHEMA), "ts", "1 hour")
    return streaming.run_available(streaming.drop_copies(stream, ["event_id"]), "stream_copies")


def stream_incremental_append(spark, sf_dir):
    """The stream adds its new keys to a table that already has the first half of the month."""
    home = work_dir(use_utc(spark), "stream_append")
    append_new(ticks(spark, sf_dir).where("ts < '2024-01-15'"), f"{home}/table", ["event_id"], "ts")
    streaming.append_available(_tick_stream(spark, sf_dir), f"{home}/table", f"{home}/checkpoint", ["event_id"], "ts")
    return read_parquet(spark, f"{home}/table")


QUERIES = {
    f.__name__: f
    for f in (
        csv_scan,
        csv_bad_rows,
        csv_multi_file_union,
        parquet_scan,
        parquet_roundtrip,
        partitioned_roundtrip,
        partitioned_time_range,
        sql_view_select,
        preview_topk,
        schema_listing,
        rename_columns,
        conform_columns,
        calendar_parts,
        epoch_to_timestamp,
        drop_incomplete_rows,
        distinct_series,
        align_join_minute,
        align_fan_out,
        align_latest_minute,
        multi_asset_minutes,
        union_all_series,
        row_count,
        non_null_count,
        null_key_count,
        null_or_nan_count,
        null_profile,
        quality_report,
        duplicate_keys,
        year_range_check,
        missing_buckets,
        staged_feed,
        staged_feed_b,
        series_parity,
        series_parity_b,
        combined_parity,
        combined_default,
        incremental_job,
        load_history,
        stream_job,
        rollup_increments,
        job_quality,
        job_quality_bad_rows,
        contract_report,
        ohlc_resample,
        ohlc_rollup,
        align_with_close,
        align_all_hours,
        multi_asset_pivot,
        simple_returns,
        moving_average,
        rolling_stddev,
        simple_returns_split,
        moving_average_split,
        return_correlation,
        return_correlation_daily,
        rolling_correlation,
        trend_regression,
        lag_regression,
        lag_prediction,
        walk_forward,
        walk_forward_errors,
        next_hour_forecast,
        lead_lag_correlation,
        align_last_known,
        align_last_known_assets,
        volume_bars,
        row_bars,
        gap_intervals,
        rolling_statistics,
        exponential_averages,
        macd,
        relative_strength,
        incremental_append,
        stream_tumbling_ohlc,
        stream_feed_bars,
        stream_last_windows,
        stream_join,
        stream_silent_feeds,
        stream_align,
        stream_drop_copies,
        stream_incremental_append,
    )
}
