"""Loads that add to the tables: raw history, ledger, commits that crash, rollups, the job as a stream."""

import random
import shutil
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from tests.frames import A_HEADER, B_HEADER, write_feeds, write_lines
from tests.test_job import a_row, b_row
from tickseries.feeds import BTC, ETH
from tickseries.operators.bars import resample
from tickseries.operators.quality import DataQualityError
from tickseries.plans import daily, loads
from tickseries.sinks import commit
from tickseries.streaming.job import run_stream_job

FEEDS = [BTC, ETH]
NEW_YEAR = 1514764800  # 2018-01-01


def write_drop(folder, a=(), b=(), name="x.csv"):
    write_lines(folder / "btc_data", name, A_HEADER, a)
    write_lines(folder / "eth_data", name, B_HEADER, b)
    return str(folder)


def contents(spark, out):
    """The rows of all tables but staging."""
    names = [BTC.series_name, ETH.series_name, daily.COMBINED]
    tables = [spark.read.parquet(f"{out}/{n}") for n in names]
    return [sorted(map(str, t.select(sorted(t.columns)).collect())) for t in tables]


def passed(spark, out):
    found = daily.history_report(spark, FEEDS, out).collect()
    return {(r["table"], r["load"]): r["passed"] for r in found}


def test_a_full_load_and_then_a_drop_keep_all_raw_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    first = write_drop(tmp_path / "data", [a_row(NEW_YEAR + 60 * i, i) for i in range(5)], [b_row("2018-01-01 00:00:00", 1)] * 5)
    daily.run_checked(spark, FEEDS, first, out)
    second = write_drop(tmp_path / "more" / "data", [a_row(NEW_YEAR + 60 * i, i) for i in range(3, 7)], [b_row("2018-01-01 00:01:00", 1)])
    tables = daily.run_increment(spark, FEEDS, second, out)
    assert spark.read.parquet(f"{out}/staging_btc").count() == 9 and spark.read.parquet(f"{out}/staging_eth").count() == 6
    assert tables["btc_timeseries"].count() == 7
    # Another folder of the same name is another drop; the same files are the same drop.
    third = write_drop(tmp_path / "again" / "data", [a_row(NEW_YEAR, 8)])
    for _ in range(2):
        daily.run_increment(spark, FEEDS, third, out)
    assert spark.read.parquet(f"{out}/staging_btc").count() == 10
    assert len(passed(spark, out)) == 6 and all(passed(spark, out).values())
    ledger = {(r["load"], r["feed"]): r for r in daily.ledger(spark, out).collect()}
    assert len(ledger) == 6
    for row in ledger.values():
        assert row["n_rows"] == sum(row[c] for c in ("n_unused", "n_copies", "n_inserted", "n_corrected", "n_unchanged"))
    by_feed = Counter()
    for (_, feed), row in ledger.items():
        by_feed[feed] += row["n_inserted"]
    assert by_feed == {"btc": 7, "eth": 2}
    # Rows that staging has lost are seen.
    name = next(load for load, feed in ledger if feed == "btc" and ledger[(load, feed)]["n_rows"] == 5)
    loads.stage_load(loads.raw_rows(spark, BTC, third), BTC, out, name)
    assert passed(spark, out)[("staging_btc", name)] is False


def test_a_known_name_needs_a_stated_replacement(spark, tmp_path):
    out = str(tmp_path / "out")
    one, two = write_drop(tmp_path / "1", [a_row(NEW_YEAR, 1)]), write_drop(tmp_path / "2", [a_row(NEW_YEAR + 60, 2)])
    daily.run_increment(spark, FEEDS, one, out, drop="001")
    with pytest.raises(ValueError, match="loaded already"):
        daily.run_increment(spark, FEEDS, two, out, drop="001")
    assert spark.read.parquet(f"{out}/staging_btc").count() == 1
    daily.run_increment(spark, FEEDS, two, out, drop="001", replace=True)
    assert spark.read.parquet(f"{out}/staging_btc").count() == 1
    assert passed(spark, out) == {("staging_btc", "001"): True, ("staging_eth", "001"): True}


def test_ledger_says_what_a_drop_changed(spark, tmp_path):
    out = str(tmp_path / "out")
    daily.run_increment(spark, FEEDS, write_drop(tmp_path / "1", [a_row(NEW_YEAR + 60 * i, 1) for i in range(4)]), out, drop="one")
    rows = [a_row(NEW_YEAR, 1), a_row(NEW_YEAR + 90, 2), a_row(NEW_YEAR + 95, 3), a_row(NEW_YEAR + 120, 5), a_row(NEW_YEAR + 600, 1)]
    rows += ["abc,1,1,1,1,1,1,1", f"{NEW_YEAR + 900},NaN,1,1,1,1,1,1"]
    daily.run_increment(spark, FEEDS, write_drop(tmp_path / "2", rows), out, drop="two")
    found = daily.ledger(spark, out).where("load = 'two' AND feed = 'btc'").first().asDict()
    # 00:00 stays, 00:01 has a later event (and a copy), 00:02 a greater price, 00:10 is new; a bad line and an incomplete row.
    want = dict(n_rows=7, n_unused=2, n_copies=1, n_inserted=1, n_corrected=2, n_unchanged=1, months=[201801])
    assert {k: found[k] for k in want} == want


DROPS = [
    ([a_row(NEW_YEAR - 60, 1), a_row(NEW_YEAR, 2)], [b_row("2017-12-31 23:59:00", 5), b_row("2018-01-01 00:00:00", 6)]),
    ([a_row(NEW_YEAR + 30, 3), a_row(NEW_YEAR + 60, 4)], [b_row("2018-01-01 00:01:00", 7), b_row("2017-12-31 23:59:30", 8)]),
]


class Crash(Exception):
    pass


def crash_at(monkeypatch, module, name, n):
    """The n-th call of a function fails before it does anything."""
    real, calls = getattr(module, name), []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == n:
            raise Crash(f"{name} {n}")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, failing)


CRASHES = [(loads, "stage_load", 2), (commit, "_log", 1), (commit, "replace_partitions", 1), (commit, "replace_partitions", 3), (commit, "_log", 2)]


@pytest.fixture(scope="module")
def one_and_both(spark, tmp_path_factory):
    """The drops, the tables after the first one, and what they hold after both."""
    home = tmp_path_factory.mktemp("drops")
    roots = [write_drop(home / str(i), *d) for i, d in enumerate(DROPS)]
    daily.run_increment(spark, FEEDS, roots[0], str(home / "out"))
    shutil.copytree(home / "out", home / "whole")
    daily.run_increment(spark, FEEDS, roots[1], str(home / "whole"))
    return roots, home / "out", contents(spark, str(home / "whole"))


@pytest.mark.parametrize("module, name, n", CRASHES)
def test_a_load_that_crashes_is_taken_up_again(spark, tmp_path, monkeypatch, one_and_both, module, name, n):
    roots, first, both = one_and_both
    out = str(tmp_path / "out")
    shutil.copytree(first, out)
    with monkeypatch.context() as patched:
        crash_at(patched, module, name, n)
        with pytest.raises(Crash):
            daily.run_increment(spark, FEEDS, roots[1], out)
    if (module, name) == (commit, "replace_partitions"):
        # What was logged is finished by itself before the next commit reads.
        assert len(commit.recover(spark, out)) == 1
        assert contents(spark, out) == both
    daily.run_increment(spark, FEEDS, roots[1], out)
    assert contents(spark, out) == both
    assert commit.recover(spark, out) == []
    assert all(passed(spark, out).values())
    assert spark.read.parquet(f"{out}/staging_btc").count() == 4


def test_rollups_follow_four_overlapping_drops(spark, tmp_path):
    rng = random.Random(3)
    out = str(tmp_path / "out")
    for i in range(4):
        start = NEW_YEAR - 86_400 + i * 40_000
        rows = [a_row(start + 60 * k, rng.randrange(1, 90)) for k in sorted(rng.sample(range(1200), 60))]
        tables = daily.run_increment(spark, FEEDS, write_drop(tmp_path / str(i), rows), out, rollups=True)
    fields = {c: f"btc_{c}" for c in ("open", "high", "low", "close", "volume")}
    for grain in ("hour", "day"):
        want = resample(tables["btc_timeseries"], [], "timestamp", grain, **fields).withColumnsRenamed({"bucket": "timestamp", "n_rows": "n_minutes"})
        got = loads.read_rollup(spark, BTC, out, grain).select(want.columns)
        assert got.count() > 2 and sorted(got.collect()) == sorted(want.collect())
        assert loads.read_rollup(spark, ETH, out, grain).count() == 0


def test_only_touched_months_are_written_anew(spark, tmp_path):
    out = str(tmp_path / "out")
    daily.run_increment(spark, FEEDS, write_drop(tmp_path / "1", [a_row(NEW_YEAR - 60, 1), a_row(NEW_YEAR, 1)], [b_row("2018-01-01 00:00:00", 1)]), out)
    before = {f for f in spark.read.parquet(f"{out}/btc_timeseries").inputFiles() if "month=12" in f}
    daily.run_increment(spark, FEEDS, write_drop(tmp_path / "2", [a_row(NEW_YEAR + 60, 1)]), out)
    after = {f for f in spark.read.parquet(f"{out}/btc_timeseries").inputFiles() if "month=12" in f}
    assert before and before == after


def test_a_duplicate_key_or_missing_field_ends_the_job(spark, tmp_path):
    twice = [a_row(NEW_YEAR, 1), a_row(NEW_YEAR, 2)]
    root = write_drop(tmp_path / "twice", twice, [b_row("2018-01-01 00:00:00", 1)])
    with pytest.raises(DataQualityError, match="n_duplicates"):
        daily.run_checked(spark, FEEDS, root, str(tmp_path / "out"), parity=True)
    missing = write_drop(tmp_path / "missing", [a_row(NEW_YEAR, 1)], ["2018-01-01 00:00:00,1,1,1,,7,1,7,3,1,1,0"])
    with pytest.raises(DataQualityError, match="n_missing_fields"):
        daily.run_checked(spark, FEEDS, missing, str(tmp_path / "out2"))
    tables = daily.run_increment(spark, FEEDS, missing, str(tmp_path / "out3"))
    reports = daily.check(spark, FEEDS, tables, str(tmp_path / "out3"), increment=True)
    assert [{r["passed"] for r in x.collect()} == {True} for x in reports] == [True, False, True]


@pytest.mark.parametrize("name, n", [("replace_partitions", 2), ("_log", 2)])
def test_a_stream_that_is_killed_equals_one_load(spark, tmp_path, monkeypatch, name, n):
    root, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write_drop(root, *DROPS[0], name="0.csv")
    with monkeypatch.context() as patched:
        crash_at(patched, commit, name, n)
        with pytest.raises(StreamingQueryException):
            run_stream_job(spark, FEEDS, str(root), out, checkpoint, files_per_batch=1)
    run_stream_job(spark, FEEDS, str(root), out, checkpoint, files_per_batch=1)
    write_drop(root, *DROPS[1], name="1.csv")
    for _ in range(2):  # the second time there is nothing new
        run_stream_job(spark, FEEDS, str(root), out, checkpoint, files_per_batch=1)
    whole = str(tmp_path / "whole")
    daily.run_feeds(spark, FEEDS, str(root), whole)
    assert contents(spark, out) == contents(spark, whole)
    assert [spark.read.parquet(f"{out}/staging_{f}").count() for f in ("btc", "eth")] == [4, 4]
    assert daily.ledger(spark, out).count() == 4 and all(passed(spark, out).values())
    if name == "_log":
        return
    # Another checkpoint reads all files again, as loads of its own: the tables stay, the raw rows are there twice.
    run_stream_job(spark, FEEDS, str(root), out, str(tmp_path / "other"))
    assert contents(spark, out) == contents(spark, whole)
    assert spark.read.parquet(f"{out}/staging_btc").count() == 8


def test_a_stream_goes_on_from_a_full_load(spark, tmp_path):
    out = str(tmp_path / "out")
    daily.run_checked(spark, FEEDS, write_feeds(tmp_path / "first"), out)
    write_drop(tmp_path / "in", DROPS[0][0], DROPS[0][1])
    run_stream_job(spark, FEEDS, str(tmp_path / "in"), out, str(tmp_path / "checkpoint"), rollups=True)
    assert spark.read.parquet(f"{out}/btc_timeseries").count() == 4
    assert spark.read.parquet(f"{out}/staging_btc").count() == 8
    assert loads.read_rollup(spark, BTC, out, "hour").count() == 2
    assert all(passed(spark, out).values())
