"""Running columns, as-of alignment, bars by size, gaps and exponential averages against plain loops, with any chunks."""

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.test_windows import SCHEMA, skewed
from tickseries.operators.align import align_last_known, gap_intervals
from tickseries.operators.bars import size_bars
from tickseries.operators.scans import last_known, running, running_count, running_extreme, running_sum
from tickseries.operators.smoothing import exponential_averages, macd, relative_strength

SIZES = [None, 10_000, 150, 60, 7]
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def rows():
    return [(a, t, i, None if i % 7 == 0 else p) for a, t, i, p in skewed()]


@pytest.fixture(scope="module")
def ticks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def histories(rows):
    for row in rows:
        yield row, sorted(r for r in rows if r[0] == row[0] and r[1:3] <= row[1:3])


@pytest.mark.parametrize("rows_per_task", SIZES)
def test_running(ticks, rows, rows_per_task):
    price = F.col("price")
    columns = {
        "n": running_count(),
        "total": running_sum(price.cast("long")),
        "high": running_extreme(price),
        "low": running_extreme(price, largest=False),
        "last": last_known(price, ["t", "id"]),
    }
    found = running(ticks, ["asset"], ["t", "id"], columns, rows_per_task)
    assert found.columns == [*ticks.columns, *columns]
    want = {}
    for row, past in histories(rows):
        known = [r[3] for r in past if r[3] is not None]
        want[row[2]] = (len(past), int(sum(known)), *((max(known), min(known), known[-1]) if known else (None,) * 3))
    assert {r["id"]: tuple(r)[4:] for r in found.collect()} == want


def test_running_without_groups(spark, ticks, rows):
    found = running(ticks, [], ["t", "id"], {"n": running_count()}, 50)
    order = sorted((r[1], r[2]) for r in rows)
    assert {(r["t"], r["id"]): r["n"] for r in found.collect()} == {key: i + 1 for i, key in enumerate(order)}
    with pytest.raises(ValueError):
        running(ticks, [], ["t", "id"], {"n": running_count()})


def test_running_of_null_groups_and_no_rows(spark):
    frame = spark.createDataFrame([(None, i, i, 1.0) for i in range(20)] + [("a", i, i, 1.0) for i in range(20)], SCHEMA)
    found = running(frame, ["asset"], ["t", "id"], {"n": running_count()}, 6).collect()
    assert {(r["asset"], r["t"]): r["n"] for r in found} == {(a, i): i + 1 for a in (None, "a") for i in range(20)}
    assert running(frame.limit(0), ["asset"], ["t", "id"], {"n": running_count()}, 6).collect() == []


def minutes(k):
    return START + timedelta(minutes=k)


@pytest.mark.parametrize("rows_per_task", SIZES)
@pytest.mark.parametrize("tolerance", [None, 0, 300])
def test_align_last_known(spark, rows_per_task, tolerance):
    rng = random.Random(4)
    left = [(f"g{i % 2}", minutes(rng.randrange(400)), i) for i in range(150)] + [("g0", None, 900), (None, minutes(9), 901), ("g0", minutes(50), 3)]
    left += [left[0]] * 3  # repeated rows
    right = [(f"g{i % 2}", minutes(rng.randrange(400)), i, float(i)) for i in range(60)]
    right += [("g0", None, 77, 7.0), (None, minutes(3), 78, 8.0), ("g1", minutes(30), 79, None)]
    a = spark.createDataFrame(left, "g string, ts timestamp, k int").repartition(3)
    b = spark.createDataFrame(right, "g string, ts timestamp, seq int, price double").repartition(3)
    found = align_last_known(a, b, "ts", {"price": "b_price", "ts": "b_ts"}, ["seq"], ["g"], tolerance, rows_per_task)
    want = []
    for g, ts, k in left:
        past = [r for r in right if r[0] == g and ts is not None and r[1] is not None and r[1] <= ts]
        last = max(past, key=lambda r: (r[1], r[2]), default=None)
        if last and tolerance is not None and (ts - last[1]).total_seconds() > tolerance:
            last = None
        want.append((g, ts, k, last and last[3], last and last[1]))
    utc = lambda t: t and t.replace(tzinfo=None)
    got = [tuple(r) for r in found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "b_ts")}).collect()]
    assert sorted(got, key=repr) == sorted(((g, utc(t), k, p, utc(u)) for g, t, k, p, u in want), key=repr)


def test_align_last_known_of_one_series_and_of_nothing(spark):
    a = spark.createDataFrame([(minutes(5),), (minutes(7),)], "ts timestamp")
    b = spark.createDataFrame([(minutes(6), 1.0)], "ts timestamp, p double")
    assert [r["q"] for r in align_last_known(a, b, "ts", {"p": "q"}).orderBy("ts").collect()] == [None, 1.0]
    assert [r["q"] for r in align_last_known(a, b.limit(0), "ts", {"p": "q"}).collect()] == [None, None]
    assert align_last_known(a.limit(0), b, "ts", {"p": "q"}).collect() == []


@pytest.mark.parametrize("rows_per_task", SIZES)
@pytest.mark.parametrize("amount", [None, "price"])
def test_size_bars(ticks, rows, rows_per_task, amount):
    fields = dict(open="price", high="price", low="price", close="price", volume="price")
    found = size_bars(ticks, ["asset"], ["t", "id"], 40, amount, rows_per_task, **fields)
    want = {}
    for asset in {r[0] for r in rows}:
        before = Decimal(0)
        for n, row in enumerate(sorted(r for r in rows if r[0] == asset)):
            bar = n // 40 if amount is None else int(before // 40)
            want.setdefault((asset, bar), []).append(row)
            before += Decimal(row[3] or 0)
    got = {(r["asset"], r["bar"]): r for r in found.collect()}
    assert got.keys() == want.keys()
    for key, mine in want.items():
        known = [r[3] for r in mine if r[3] is not None]
        bar = got[key]
        assert (bar["start"], bar["end"], bar["n_rows"]) == (mine[0][1], mine[-1][1], len(mine))
        assert (bar["open"], bar["close"], bar["high"], bar["low"]) == (mine[0][3], mine[-1][3], max(known, default=None), min(known, default=None))


def test_negative_amounts_are_an_error(spark):
    with pytest.raises(Exception, match="negative price"):
        size_bars(spark.createDataFrame([("a", 1, 1, -1.0)], SCHEMA), ["asset"], ["t", "id"], 5, "price", open="price", high="price", low="price", close="price", volume=None).collect()


@pytest.mark.parametrize("rows_per_task", SIZES)
def test_gap_intervals(spark, rows_per_task):
    rng = random.Random(8)
    seen = {(a, rng.randrange(300)) for a in "aab" for _ in range(60)} | {("one", 5)}
    stamped = [(a, minutes(k) + timedelta(seconds=rng.randrange(60))) for a, k in seen for _ in range(2)] + [("a", None), (None, minutes(1))]
    frame = spark.createDataFrame(stamped, "asset string, ts timestamp").repartition(3)
    for at_least in (1, 4):
        want = set()
        for a in {a for a, _ in seen}:
            own = sorted(k for x, k in seen if x == a)
            want |= {(a, p + 1, k - 1, k - p - 1) for p, k in zip(own, own[1:]) if k - p - 1 >= at_least}
        found = gap_intervals(frame, "asset", "ts", "minute", at_least, rows_per_task)
        number = lambda c: ((F.unix_seconds(c) - int(START.timestamp())) / 60).cast("int")
        assert {tuple(r) for r in found.select("asset", number("start"), number("end"), "n_missing").collect()} == want


def plain_ema(values, alpha):
    y, out = None, []
    for x in values:
        if x is not None and x == x:
            y = x if y is None else alpha * x + (1 - alpha) * y
        out.append(y)
    return out


@pytest.mark.parametrize("rows_per_task", SIZES)
def test_exponential_averages(spark, rows, rows_per_task):
    rows = [(a, t, i, float("nan") if i % 11 == 0 else p) for a, t, i, p in rows] + [("none", 1, 5000, None), (None, 1, 5001, 2.0), (None, 2, 5002, 4.0)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = exponential_averages(frame, ["asset"], ["t", "id"], {"quick": ("price", 0.5), "slow": ("price", 0.02)}, rows_per_task)
    got = {r["id"]: (r["quick"], r["slow"]) for r in found.collect()}
    assert len(got) == len(rows)
    for asset in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == asset) if asset else [r for r in rows if r[0] is None]
        for i, alpha in enumerate((0.5, 0.02)):
            for row, want in zip(own, plain_ema([r[3] for r in own], alpha)):
                assert got[row[2]][i] == (None if want is None else pytest.approx(want, abs=1e-9))


@pytest.mark.parametrize("rows_per_task", [None, 40])
def test_macd_and_relative_strength(spark, rows, rows_per_task):
    rows = [r for r in rows if r[3] is not None]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got_macd = {r["id"]: (r["macd"], r["macd_signal"]) for r in macd(frame, ["asset"], ["t", "id"], "price", rows_per_task=rows_per_task).collect()}
    got_rsi = {r["id"]: r["rsi"] for r in relative_strength(frame, ["asset"], ["t", "id"], "price", rows_per_task=rows_per_task).collect()}
    for asset in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == asset)
        prices = [r[3] for r in own]
        line = [a - b for a, b in zip(plain_ema(prices, 2 / 13), plain_ema(prices, 2 / 27))]
        moves = [None, *(b - a for a, b in zip(prices, prices[1:]))]
        up = plain_ema([None if m is None else max(m, 0.0) for m in moves], 1 / 14)
        down = plain_ema([None if m is None else max(-m, 0.0) for m in moves], 1 / 14)
        for row, m, s, u, d in zip(own, line, plain_ema(line, 0.2), up, down):
            assert got_macd[row[2]] == (pytest.approx(m, abs=1e-9), pytest.approx(s, abs=1e-9))
            want = None if u is None or u + d == 0 else 100 * u / (u + d)
            assert got_rsi[row[2]] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_an_average_of_one_series_needs_chunks(ticks):
    with pytest.raises(ValueError):
        exponential_averages(ticks, [], ["t", "id"], {"y": ("price", 0.5)}, None)
    assert exponential_averages(ticks, [], ["t", "id"], {"y": ("price", 0.5)}, 100).count() == ticks.count()
