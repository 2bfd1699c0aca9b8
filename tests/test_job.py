import json
from dataclasses import replace

import pytest
from pyspark.sql import SparkSession

from tests.frames import A_HEADER, B_HEADER, write_feeds, write_lines
from tickseries import session
from tickseries.feeds import BTC, ETH, feeds_from_json
from tickseries.functions.times import CALENDAR
from tickseries.operators.quality import DataQualityError
from tickseries.plans import daily

TABLES = ["staging_btc", "btc_timeseries", "staging_eth", "eth_timeseries", "combined_timeseries"]


@pytest.mark.parametrize("parity", [True, False])
def test_whole_job(spark, tmp_path, parity):
    root, out = write_feeds(tmp_path / "in"), str(tmp_path / "out")
    report = daily.run_checked(spark, [BTC, ETH], root, out, parity)
    assert {r.table: (r.n_rows, r.passed) for r in report.collect()} == dict(
        zip(TABLES, [(6, True), (2, True), (3, True), (3, True), (2, True)])
    )
    combined = spark.read.parquet(f"{out}/combined_timeseries")
    measures = ["open", "high", "low", "volume"] if parity else ["open", "high", "low", "close", "volume"]
    columns = [*CALENDAR, *([] if parity else ["timestamp"]), *[f"{f}_{m}" for f in ("btc", "eth") for m in measures]]
    assert sorted(combined.columns) == sorted(columns)
    if parity:
        assert combined.columns == columns
    assert sorted((r.minute, r.btc_open, r.eth_open) for r in combined.collect()) == [(0, 10.0, 1.0), (3, 20.0, 2.0)]
    # A second run replaces the tables.
    daily.run_checked(spark, [BTC, ETH], root, out, parity)
    assert spark.read.parquet(f"{out}/combined_timeseries").count() == 2


def b_row(stamp: str, price: int) -> str:
    return f"{stamp},{price},{price},{price},{price},7,1,7,3,1,1,0"


def a_row(epoch: int, price: int) -> str:
    return f"{epoch},{price},{price},{price},{price},1,1,1"


def test_increments_equal_one_run(spark, tmp_path):
    """Drops that overlap, arrive late for one feed, cross a year, hit a known minute again, or are empty."""
    new_year = 1514764800  # 2018-01-01
    drops = [
        ([a_row(new_year - 120, 1), a_row(new_year - 60, 2)], [b_row("2017-12-31 23:58:00", 5)]),
        ([a_row(new_year - 60, 2), a_row(new_year, 3)], []),
        ([], [b_row("2017-12-31 23:59:00", 6), b_row("2018-01-01 00:00:00", 7), b_row("2018-01-01 00:01:00", 8)]),
        ([a_row(new_year + 60, 4)], []),
        # Later events of known minutes take their place; an earlier event of one does not.
        ([a_row(new_year + 30, 9)], [b_row("2018-01-01 00:00:30", 10), b_row("2017-12-31 23:58:00", 5)]),
    ]
    out = str(tmp_path / "out")
    for i, (a, b) in enumerate([*drops, drops[2], ([], [])]):
        write_lines(tmp_path / f"d{i}" / "btc_data", "x.csv", A_HEADER, a)
        write_lines(tmp_path / f"d{i}" / "eth_data", "x.csv", B_HEADER, b)
        tables = daily.run_increment(spark, [BTC, ETH], str(tmp_path / f"d{i}"), out)
    combined = tables[daily.COMBINED].orderBy("timestamp").collect()
    assert [(str(r.timestamp), r.year, r.minute, r.btc_open, r.eth_open) for r in combined] == [
        ("2017-12-31 23:58:00", 2017, 58, 1.0, 5.0),
        ("2017-12-31 23:59:00", 2017, 59, 2.0, 6.0),
        ("2018-01-01 00:00:30", 2018, 0, 9.0, 10.0),
        ("2018-01-01 00:01:00", 2018, 1, 4.0, 8.0),
    ]
    assert [tables[f"{f}_timeseries"].count() for f in ("btc", "eth")] == [4, 4]
    assert tables["staging_btc"].count() == 0
    # Staging has every drop, and one load of all of them gives the same tables.
    staged = spark.read.parquet(f"{out}/staging_btc")
    assert staged.count() == sum(len(a) for a, _ in [*drops, drops[2]])
    for i, (a, b) in enumerate([*drops, drops[2]]):
        write_lines(tmp_path / "whole" / "btc_data", f"{i}.csv", A_HEADER, a)
        write_lines(tmp_path / "whole" / "eth_data", f"{i}.csv", B_HEADER, b)
    whole = daily.run_feeds(spark, [BTC, ETH], str(tmp_path / "whole"), str(tmp_path / "whole_out"))[daily.COMBINED]
    assert sorted(whole.select(tables[daily.COMBINED].columns).collect()) == sorted(tables[daily.COMBINED].collect())


def test_a_feed_may_be_absent_from_a_drop(spark, tmp_path):
    root, out = write_feeds(tmp_path / "in"), str(tmp_path / "out")
    daily.run_increment(spark, [BTC, ETH], root, out)
    write_lines(tmp_path / "next" / "eth_data", "x.csv", B_HEADER, [b_row("2017-08-17 04:00:30", 9)])
    tables = daily.run_increment(spark, [BTC, ETH], str(tmp_path / "next"), out)
    assert sorted(r.eth_open for r in tables[daily.COMBINED].collect()) == [2.0, 9.0]
    report = daily.report([BTC, ETH], tables, increment=True)
    assert all(r.passed for r in report.collect())


def test_no_row_is_lost_unseen(spark, tmp_path):
    """Lines that do not fit and times that cannot be read are counted and fail the job; incomplete rows are counted."""
    good = "1502942400,10,12,9,11,1.5,15,10.5"
    gap = "1502942460,NaN,NaN,NaN,NaN,NaN,NaN,NaN"
    write_lines(tmp_path / "btc_data", "x.csv", A_HEADER, [good, good, gap, "abc,1,1,1,1,1,1,1", "1,x,1,1,1,1,1,1"])
    write_lines(tmp_path / "eth_data", "x.csv", B_HEADER, [b_row(t, 1) for t in ("2017-08-17 04:00:00", "2018/01/01 00:01:00", "garbage")])
    for parity in (True, False):
        tables = daily.run_feeds(spark, [BTC, ETH], str(tmp_path), str(tmp_path / "out"), parity)
        rows = {r.table: r for r in daily.report([BTC, ETH], tables).collect()}
        a, b = rows["staging_btc"], rows["staging_eth"]
        assert (a.n_rows, a.n_bad_lines, a.n_bad_times, a.n_incomplete, a.passed) == (5, 2, 0, 1, False)
        assert (b.n_rows, b.n_bad_lines, b.n_bad_times, b.n_incomplete, b.passed) == (3, 0, 2, 0, False)
        with pytest.raises(DataQualityError, match="staging_btc"):
            daily.run_checked(spark, [BTC, ETH], str(tmp_path), str(tmp_path / "out"), parity)


def test_contract_of_the_tables(spark, tmp_path):
    tables = daily.run_feeds(spark, [BTC, ETH], write_feeds(tmp_path / "in"), str(tmp_path / "out"))
    report = daily.contract_report([BTC, ETH], tables)
    assert [(r.table, r.n_rows, r.passed) for r in report.collect()] == [
        ("btc_timeseries", 2, True), ("eth_timeseries", 3, True), ("combined_timeseries", 2, True),
    ]


def test_increment_without_any_row(spark, tmp_path):
    write_lines(tmp_path / "btc_data", "x.csv", A_HEADER, [])
    write_lines(tmp_path / "eth_data", "x.csv", B_HEADER, [])
    for _ in range(2):
        tables = daily.run_increment(spark, [BTC, ETH], str(tmp_path), str(tmp_path / "out"))
        assert [t.count() for t in tables.values()] == [0] * 5


def test_bad_lines_are_kept_apart(spark, tmp_path):
    write_lines(tmp_path / "btc_data", "x.csv", A_HEADER, ["1502942400,10,12,9,11,1.5,15,10.5", "abc,1,1,1,1,1,1,1"])
    staged = daily.stage(spark, BTC, str(tmp_path), str(tmp_path / "out"))
    good = daily.good_rows(staged)
    assert good.count() == 1 and good.columns == [BTC.renames.get(c, c) for c in BTC.schema.names]
    assert [r["_bad_row"] for r in daily.bad_lines(staged).collect()] == ["abc,1,1,1,1,1,1,1"]


def test_inferred_feed(spark, tmp_path):
    root = write_feeds(tmp_path)
    staged = daily.stage(spark, replace(BTC, schema=None), root, str(tmp_path / "out"))
    assert daily.good_rows(staged).count() == 6
    assert daily.bad_lines(staged).count() == 0


def test_failing_check_fails_the_job(spark, tmp_path):
    root = write_feeds(tmp_path)
    write_lines(tmp_path / "eth_data", "2017-08.csv", B_HEADER, ["2016-01-01 00:00:00,1,2,0.5,1.5,7,1,7,3,1,1,0"])
    with pytest.raises(DataQualityError, match="combined_timeseries"):
        daily.run_checked(spark, [BTC, ETH], root, str(tmp_path / "out"))


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, master, **values):
        self.conf = _Conf({"spark.master": master, **values})


def test_work_dir_follows_the_session():
    cluster = _Session("yarn", **{session.CHECKPOINT_DIR: "hdfs://shared/work/"})
    assert session.work_dir(cluster, "x").startswith("hdfs://shared/work/tickseries/x-")
    assert session.work_dir(cluster, "x") != session.work_dir(cluster, "x")


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(_Session("yarn"), "x")
    assert session.work_dir(_Session("local[2]"), "x")


def test_build_session_is_utc(spark):
    assert isinstance(session.build_session(), SparkSession)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from tickseries import __main__ as command

    root, out = write_feeds(tmp_path / "in"), str(tmp_path / "out")
    base = ["tickseries", "--input-root", root, "--output-root", out]
    for extra in ([], ["--append"]):
        monkeypatch.setattr("sys.argv", [*base, *extra])
        command.main()
        assert "combined_timeseries" in capsys.readouterr().out
        assert spark.read.parquet(f"{out}/combined_timeseries").count() == 2
    # A drop with rows of one feed only.
    write_lines(tmp_path / "drop" / "eth_data", "x.csv", B_HEADER, [b_row("2017-08-17 04:03:30", 7)])
    monkeypatch.setattr("sys.argv", ["tickseries", "--input-root", str(tmp_path / "drop"), "--output-root", out, "--append"])
    command.main()
    assert sorted(r.eth_open for r in spark.read.parquet(f"{out}/combined_timeseries").collect()) == [1.0, 7.0]
    monkeypatch.setattr("sys.argv", [*base, "--append", "--parity"])
    with pytest.raises(SystemExit):
        command.main()


def test_three_feeds_from_the_command_line(spark, tmp_path, monkeypatch):
    from tickseries import __main__ as command

    root, out = write_feeds(tmp_path / "in"), str(tmp_path / "out")
    write_lines(tmp_path / "in" / "other", "x.csv", "t,o,h,l,c,v", ["1502942400000,5,6,4,5.5,1", "1502942580000,6,7,5,6.5,2"])
    feeds = tmp_path / "feeds.json"
    measures = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
    third = {"name": "ltc", "path": "other", "schema": "t long, o double, h double, l double, c double, v double",
             "measures": measures, "ts_column": "t", "ts_format": "epoch_ms", "series_table": "ltc_minutes"}
    feeds.write_text(json.dumps([{"like": "btc"}, {"like": "eth", "name": "ether"}, third]))
    monkeypatch.setattr("sys.argv", ["tickseries", "--input-root", root, "--output-root", out, "--feeds", str(feeds), "--combined", "all3"])
    command.main()
    rows = spark.read.parquet(f"{out}/all3").orderBy("minute").collect()
    assert [(r.btc_open, r.ether_open, r.ltc_open) for r in rows] == [(10.0, 1.0, 5.0), (20.0, 2.0, 6.0)]
    assert spark.read.parquet(f"{out}/ltc_minutes").count() == 2
    with pytest.raises(ValueError, match="no fields"):
        feeds_from_json('[{"like": "btc", "colour": 1}]')
