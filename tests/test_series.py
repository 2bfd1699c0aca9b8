from dataclasses import replace
from itertools import product

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.frames import write_feeds
from tickseries.feeds import BTC, ETH
from tickseries.functions.times import CALENDAR, time_bucket, with_calendar
from tickseries.operators.align import align_bars, align_join, fan_out
from tickseries.operators.conform import rename_columns
from tickseries.operators.quality import duplicate_keys
from tickseries.operators.series import build_series, drop_incomplete, latest_per_key
from tickseries.sources.csv import read_feed, split_bad_rows

RAW = "Timestamp long, Open double, High double, Low double, Close double, Volume_BTC double, Volume_Currency double, Weighted_Price double"
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def feed_a(spark, root):
    return rename_columns(split_bad_rows(read_feed(spark, BTC, root))[0], BTC.renames)


def feed_b(spark, root):
    return split_bad_rows(read_feed(spark, ETH, root))[0]


def test_clean_and_distinct(spark, tmp_path):
    staged = feed_a(spark, write_feeds(tmp_path))
    assert drop_incomplete(staged).count() == 4
    assert drop_incomplete(staged).exceptAll(staged.na.drop()).count() == 0
    parity = build_series(staged, BTC, parity=True)
    assert parity.columns == ["timestamp", *CALENDAR, "btc_open", "btc_high", "btc_low", "btc_volume"]
    assert sorted(map(tuple, parity.collect())) == [
        (1502942400, 2017, 8, 17, 4, 0, 10.0, 12.0, 9.0, 1.5),
        (1502942580, 2017, 8, 17, 4, 3, 20.0, 22.0, 19.0, 2.5),
    ]


def test_default_series_has_one_row_per_minute(spark, tmp_path):
    series = build_series(feed_a(spark, write_feeds(tmp_path)), BTC)
    assert series.columns == ["timestamp", *CALENDAR, "btc_open", "btc_high", "btc_low", "btc_close", "btc_volume"]
    assert sorted((r.minute, r.btc_close) for r in series.collect()) == [(0, 11.0), (3, 21.5)]


def test_modes_agree_on_shared_columns(spark, tmp_path):
    staged = feed_a(spark, write_feeds(tmp_path))
    shared = [*CALENDAR, "btc_open", "btc_high", "btc_low", "btc_volume"]
    a = build_series(staged, BTC, parity=True).select(shared)
    assert sorted(a.collect()) == sorted(build_series(staged, BTC).select(shared).collect())


def test_unclean_feed_keeps_incomplete_rows(spark, tmp_path):
    staged = feed_a(spark, write_feeds(tmp_path))
    assert build_series(staged, replace(BTC, drop_incomplete=False), parity=True).count() == 4


def test_join_of_both_feeds(spark, tmp_path):
    root = write_feeds(tmp_path)
    a = build_series(feed_a(spark, root), BTC, parity=True)
    b = build_series(feed_b(spark, root), ETH, parity=True)
    joined = align_join([a.drop("timestamp"), b.drop("timestamp")])
    assert joined.columns == [
        *CALENDAR, "btc_open", "btc_high", "btc_low", "btc_volume", "eth_open", "eth_high", "eth_low", "eth_volume",
    ]
    assert sorted((r.minute, r.btc_open, r.eth_open) for r in joined.collect()) == [(0, 10.0, 1.0), (3, 20.0, 2.0)]


def test_minute_with_two_prices_fans_out(spark, tmp_path):
    rows = [(1502942400, 10.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), (1502942400, 11.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    a = build_series(spark.createDataFrame(rows, RAW), BTC, parity=True)
    b = build_series(feed_b(spark, write_feeds(tmp_path)), ETH, parity=True)
    assert a.count() == 2
    assert align_join([a.drop("timestamp"), b]).count() == 2
    assert fan_out([a, b]).first()[0] == 2.0
    assert [r.n_rows for r in duplicate_keys(a, CALENDAR).collect()] == [2]


def test_time_zone_with_daylight_saving(spark):
    """Two instants an hour apart share one calendar minute in New York, so UTC is fixed."""
    rows = spark.createDataFrame([(1604208600,), (1604212200,)], "s long").selectExpr("timestamp_seconds(s) AS timestamp")

    def self_join():
        series = with_calendar(rows, "timestamp")
        return align_join([series, series.drop("timestamp")]).count()

    assert self_join() == 2
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert self_join() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_key_never_joins(spark):
    a = spark.createDataFrame([(None, 1), (5, 2)], "minute int, a int")
    b = spark.createDataFrame([(None, 3), (5, 4)], "minute int, b int")
    assert [tuple(r) for r in align_join([a, b], ["minute"]).collect()] == [(5, 2, 4)]


def test_bucket_equals_truncation(spark):
    df = spark.createDataFrame([(-86_399_500_001,), (-1,), (0,), (1_502_942_459_999_999,)], "us long").selectExpr(
        "timestamp_micros(us) AS t"
    )
    for grain in ("second", "minute", "hour", "day", "month", "year"):
        got = [r[0] for r in df.select(time_bucket("t", grain)).collect()]
        want = [r[0] for r in df.selectExpr(f"date_trunc('{grain}', t)").collect()]
        assert got == want
    assert df.select(time_bucket("t", 900).cast("string")).collect()[3][0] == "2017-08-17 04:00:00"


def test_latest_per_key_is_independent_of_row_order(spark):
    rows = [(1, 5, "b"), (1, 5, "c"), (1, 4, "z"), (2, 1, "a"), (None, 1, "n")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, t int, v string").repartition(3)
        got = sorted(map(tuple, latest_per_key(df, ["k"], ["t"]).collect()), key=str)
        assert got == [(1, 5, "c"), (2, 1, "a"), (None, 1, "n")]


minutes = st.lists(st.tuples(st.integers(0, 4), st.integers(1, 3)), max_size=12)


@quick
@given(st.tuples(minutes, minutes, minutes))
def test_join_size_and_n_way(spark, lists):
    frames = [
        spark.createDataFrame(rows, f"minute int, v{i} int") for i, rows in enumerate(lists)
    ]
    for n in (2, 3):
        want = sum(
            1
            for combination in product(*lists[:n])
            if len({minute for minute, _ in combination}) == 1
        )
        assert align_join(frames[:n], ["minute"]).count() == want
        assert fan_out(frames[:n], ["minute"]).first()[0] == want


@quick
@given(minutes)
def test_build_series_is_idempotent(spark, rows):
    raw = [(60 * m, float(p), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for m, p in rows]
    staged = spark.createDataFrame(raw, RAW)
    doubled = staged.unionAll(staged)
    for parity in (True, False):
        once = sorted(build_series(staged, BTC, parity).collect())
        assert sorted(build_series(doubled, BTC, parity).collect()) == once


@quick
@given(st.sets(st.tuples(st.sampled_from("abc"), st.integers(0, 4))))
def test_align_bars_equals_join(spark, present):
    bars = spark.createDataFrame([(a, b, b * 10.0) for a, b in sorted(present)], "asset string, bucket int, close double")
    wide = align_bars(bars, ["a", "b", "c"], ["close"])
    singles = [
        bars.where(f"asset = '{a}'").selectExpr("bucket", f"close AS {a}_close") for a in "abc"
    ]
    assert sorted(wide.collect()) == sorted(align_join(singles, ["bucket"]).collect())
    outer = align_bars(bars, ["a", "b", "c"], ["close"], how="outer")
    assert sorted(r.bucket for r in outer.collect()) == sorted({b for _, b in present})


def test_align_bars_keeps_bucket_with_null_price(spark):
    bars = spark.createDataFrame([("a", 1, None), ("b", 1, 2.0)], "asset string, bucket int, close double")
    assert [tuple(r) for r in align_bars(bars, ["a", "b"], ["close"]).collect()] == [(1, None, 2.0)]
