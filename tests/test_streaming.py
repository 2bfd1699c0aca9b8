from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.frames import A_HEADER, A_ROWS, B_HEADER, write_feeds, write_lines
from tickseries.feeds import BTC, ETH
from tickseries.operators.bars import resample
from tickseries.streaming import clock as clocks
from tickseries.streaming import feeds as streaming

PRICE = dict(open="price", high="price", low="price", close="price", volume="price")
START = 1_599_999_960  # a full minute
SCHEMA = "id long, asset string, ts timestamp, price double"


def at(seconds):
    """So many seconds after the first tick, as Spark hands it out in UTC on a machine in UTC."""
    return datetime.fromtimestamp(START) + timedelta(seconds=seconds)


def ticks(spark, low, high):
    return spark.range(low, high).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS asset", f"timestamp_seconds({START} + id * 20) AS ts", "CAST(id AS DOUBLE) AS price"
    )


def stream_of(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return streaming.with_event_time(streaming.read_stream(spark, path, schema), "ts", "1 minute")


def test_bars_go_on_from_the_checkpoint(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for low, high in ((0, 100), (100, 250)):
        ticks(spark, low, high).write.mode("append").parquet(source)
        bars = streaming.tumbling_bars(stream_of(spark, source), ["asset"], "ts", "1 minute", **PRICE)
        streaming.write_available(bars, out, checkpoint)
    got = spark.read.parquet(out)
    batch = resample(ticks(spark, 0, 250), ["asset"], "ts", "minute", **PRICE)
    closed = batch.where(F.col("bucket") + F.expr("INTERVAL 2 MINUTES") <= F.timestamp_seconds(F.lit(START + 249 * 20)))
    columns = ["asset", "bucket", "open", "high", "low", "close", "volume", "n_rows"]
    assert sorted(got.select(columns).collect()) == sorted(closed.select(columns).collect())


def test_raw_feed_as_a_stream(spark, tmp_path):
    root = write_feeds(tmp_path)
    rows = [streaming.run_available(streaming.feed_stream(spark, f, root, "1 minute"), f.name) for f in (BTC, ETH)]
    assert rows[0].columns == ["ts", "asset", "open", "high", "low", "close", "volume"]
    assert sorted(r.open for r in rows[0].collect()) == [10.0, 20.0, 20.0, 20.0]
    assert sorted((r.asset, r.open) for r in rows[1].collect()) == [("eth", 1.0), ("eth", 2.0), ("eth", 3.0)]


def test_align_and_copies(spark, tmp_path):
    source = str(tmp_path / "in")
    for _ in range(3):
        ticks(spark, 0, 60).write.mode("append").parquet(source)
    stream = streaming.drop_copies(stream_of(spark, source), ["id"])
    assert streaming.run_available(stream, "t").count() == 60
    wide = streaming.tumbling_align(stream_of(spark, source), "asset", ["a", "b"], "ts", "1 minute", "price", ["id"])
    rows = streaming.run_available(wide, "t").orderBy("bucket").collect()
    # Each minute has ids 3n, 3n + 1, 3n + 2: the first is asset a, the last one of b closes.
    assert [(r.a_close, r.b_close) for r in rows[:2]] == [(0.0, 2.0), (3.0, 5.0)]


def test_append_lands_each_key_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, (low, high) in enumerate(((0, 40), (20, 90), (0, 90))):
        ticks(spark, low, high).write.mode("append").parquet(source)
        # A new checkpoint reads all files again.
        streaming.append_available(stream_of(spark, source), out, str(tmp_path / f"c{i}"), ["id"], "ts")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(90))


def test_a_null_key_does_not_end_the_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = ticks(spark, 0, 30)
    rows.withColumn("id", F.when(F.col("id") == 7, None).otherwise(F.col("id"))).write.parquet(source)
    streaming.append_available(stream_of(spark, source), out, str(tmp_path / "c"), ["id"], "ts")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [i for i in range(30) if i != 7]
    assert spark.read.parquet(f"{out}_bad_rows").count() == 1


def test_what_a_feed_stream_cannot_use_is_kept(spark, tmp_path):
    write_lines(tmp_path / "btc_data", "x.csv", A_HEADER, [*A_ROWS, "abc,1,1,1,1,1,1,1"])
    write_lines(tmp_path / "eth_data", "x.csv", B_HEADER, ["garbage,1,1,1,1,1,1,1,1,1,1,1"])
    a, b = (streaming.run_available(streaming.bad_feed_rows(spark, f, str(tmp_path)), f.name) for f in (BTC, ETH))
    assert sorted((r.asset, r.reason) for r in a.collect()) == [("btc", "bad_line")] + [("btc", "incomplete")] * 2
    assert [r.line for r in a.where("reason = 'bad_line'").collect()] == ["abc,1,1,1,1,1,1,1"]
    assert [(r.reason, "garbage" in r.line) for r in b.collect()] == [("bad_time", True)]


def test_late_rows_are_counted(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    late = 0
    for low, high in ((300, 400), (0, 10)):
        ticks(spark, low, high).write.mode("append").parquet(source)
        bars = streaming.tumbling_bars(stream_of(spark, source), ["asset"], "ts", "1 minute", **PRICE)
        late += streaming.late_rows(streaming.write_available(bars, out, checkpoint))
    assert late > 0


def clocked(spark, source, clock, condition="true"):
    schema = spark.createDataFrame([], SCHEMA).schema
    return clocks.with_clock(streaming.read_stream(spark, source, schema).where(condition), clock, "ts", "1 minute")


def test_the_clock_closes_the_last_window(spark, tmp_path):
    source, out, checkpoint, clock = (str(tmp_path / n) for n in ("in", "out", "checkpoint", "clock"))
    rows = ticks(spark, 0, 50)
    rows.write.parquet(source)
    clocks.name_feeds(spark, clock, ["a", "b"], at(0))
    bars = streaming.tumbling_bars(clocks.without_clock(clocked(spark, source, clock), "ts"), ["asset"], "ts", "1 minute", **PRICE)
    streaming.write_available(bars, out, checkpoint)
    batch = resample(rows, ["asset"], "ts", "minute", **PRICE).select(*bars.columns)
    assert spark.read.parquet(out).count() < batch.count()
    clocks.pass_time(spark, clock, at(50 * 20 + 180))
    streaming.write_available(bars, out, checkpoint)
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())


def test_state_of_a_stream_join_does_not_grow(spark, tmp_path):
    source, out, checkpoint, clock = (str(tmp_path / n) for n in ("in", "out", "checkpoint", "clock"))
    clocks.name_feeds(spark, clock, ["a", "b"], at(0))
    held = []
    for low in range(0, 1200, 200):
        ticks(spark, low, low + 200).where("asset = 'a' OR id % 9 = 1").write.mode("append").parquet(source)
        sides = []
        for asset in ("a", "b"):
            rows = clocks.without_clock(clocked(spark, source, clock, f"asset = '{asset}'"), "ts")
            sides.append(clocks.last_in_window(rows, "ts", "1 minute", "price", f"{asset}_close", ["id"]))
        query = streaming.write_available(clocks.join_windows(*sides), out, checkpoint)
        held.append(sum(op["numRowsTotal"] for op in query.recentProgress[-1]["stateOperators"]))
    assert max(held) <= 12
    clocks.pass_time(spark, clock, at(1200 * 20 + 180))
    streaming.write_available(clocks.join_windows(*sides), out, checkpoint)
    got = {r.bucket: (r.a_close, r.b_close) for r in spark.read.parquet(out).collect()}
    # Minute n has ids 3n, 3n + 1, 3n + 2; the one of b is there in every third minute only.
    assert len(got) == spark.read.parquet(out).count() == 400
    assert all(got[at(60 * n)] == (3.0 * n, 3.0 * n + 1 if (3 * n + 1) % 9 == 1 else None) for n in range(400))


def test_silent_feeds_in_one_batch_and_in_many(spark, tmp_path):
    minutes = {"a": [0, 1, 2, 6, 7, 40], "b": [0, 2, 4, 6, 8, 10, 12, 14], None: [3]}
    rows = sorted((m, x) for x, of in minutes.items() for m in of)
    found = []
    for parts in ([rows], [[r] for r in rows]):
        home = tmp_path / str(len(parts))
        source, out, checkpoint, clock = (str(home / n) for n in ("in", "out", "checkpoint", "clock"))
        clocks.name_feeds(spark, clock, ["a", "b", "never"], at(0))
        for part in parts:
            spark.createDataFrame([(m, x, at(60 * m), 1.0) for m, x in part], SCHEMA).coalesce(1).write.mode("append").parquet(source)
            if len(parts) == 1 or part[0][0] >= 10:
                streaming.write_available(clocks.silent_feeds(clocked(spark, source, clock), "ts", 60, 3), out, checkpoint)
        clocks.pass_time(spark, clock, at(60 * 60))
        streaming.write_available(clocks.silent_feeds(clocked(spark, source, clock), "ts", 60, 3), out, checkpoint)
        found.append(sorted(map(tuple, spark.read.parquet(out).collect()), key=str))
    # Between 2 and 6 three minutes are empty, which is a silence; the one empty minute between the rows of b is not.
    want = [("a", at(180), True), ("a", at(480), True), ("a", at(41 * 60), True), ("b", at(15 * 60), True), ("never", at(60), False), (None, at(240), True)]
    assert found[0] == found[1] == sorted(want, key=str)
