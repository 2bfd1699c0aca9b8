"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickseries.feeds import BTC
from tickseries.functions.times import time_bucket
from tickseries.operators.align import align_bars
from tickseries.operators.bars import resample
from tickseries.operators.quality import null_profile
from tickseries.operators.series import build_series, drop_incomplete, latest_per_key
from tickseries.operators.stats import moving_average

LAZY = [
    "align_join_minute", "align_with_close", "align_all_hours", "distinct_series", "drop_incomplete_rows", "duplicate_keys",
    "missing_buckets", "moving_average", "multi_asset_pivot", "null_profile", "ohlc_resample", "quality_report",
    "return_correlation", "rolling_correlation", "rolling_stddev", "simple_returns", "trend_regression", "union_all_series",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


SERIES = ["simple_returns", "moving_average", "rolling_stddev", "rolling_correlation", "lag_prediction"]


@pytest.mark.parametrize("name", SERIES)
def test_no_series_meets_in_one_task(spark, sf_dir, name):
    assert "SinglePartition" not in plan(entry.queries()[name](spark, sf_dir))


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def test_drop_incomplete_is_pushed_down(spark, sf_dir):
    text = plan(drop_incomplete(events(spark, sf_dir)).select("event_id"))
    assert "PushedFilters: [IsNotNull(event_id)" in text and "IsNotNull(value)" in text
    narrow = plan(drop_incomplete(events(spark, sf_dir), ["value"]).select("value"))
    assert "ReadSchema: struct<value:double>" in narrow


def test_bars_read_and_shuffle_little(spark, sf_dir):
    ticks = events(spark, sf_dir)
    bars = resample(ticks, ["event_type"], "ts", "hour", open="value", high="value", low="value", close="value", volume=None)
    text = plan(bars)
    assert "SortAggregate" not in text
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    many = plan(align_bars(bars, ["click", "error", "purchase", "signup", "view"], ["close"], asset="event_type"))
    assert many.count("Exchange") == 2 and "Join" not in many
    assert "In(event_type" in many


def test_series_has_one_shuffle(spark):
    raw = spark.createDataFrame([], "Timestamp long, Open double, High double, Low double, Close double, Volume_BTC double")
    for parity in (True, False):
        assert plan(build_series(raw, BTC, parity)).count("Exchange") == 1


def test_partial_aggregates_before_the_shuffle(spark, sf_dir):
    rows = events(spark, sf_dir).select(time_bucket("ts", "minute").alias("m"), "event_id", "value")
    text = plan(latest_per_key(rows, ["m"], ["event_id"]))
    assert "partial_max" in text
    assert plan(null_profile(rows)).count("FileScan") == 1


def test_chunk_ends_are_read_by_a_pushed_condition(spark, sf_dir):
    ticks = events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    text = plan(moving_average(ticks, ["event_type"], ["ts", "event_id"], "value", 5, rows_per_task=100))
    assert "LessThan(_from_end,4)" in text
    # One shuffle of rows for the windows; the other three carry one row per chunk and group, for how far each group reaches.
    assert text.count("Exchange") == 4 and "SinglePartition" not in text
