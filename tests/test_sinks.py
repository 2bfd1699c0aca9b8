import pytest
from pyspark.sql import functions as F

from tickseries.sinks.parquet import append_new, compact_years, merge_latest, write_parquet
from tickseries.sources.parquet import between, read_parquet

HOURS = "timestamp_seconds(1703980800 + 3600 * id) AS ts"  # from 2023-12-31, across a new year


@pytest.fixture
def rows(spark):
    return spark.range(100).selectExpr("id", HOURS, "id * 1.5 AS price")


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_append_is_idempotent(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for batch in (rows.where("id < 60"), rows.where("id >= 40"), rows.where("id >= 40"), rows):
        append_new(batch, path, ["id"], "ts")
    assert ids(spark, path) == list(range(100))
    append_new(rows.limit(0), path, ["id"], "ts")
    assert spark.read.parquet(path).count() == 100


def test_append_across_a_new_year_in_another_driver_zone(spark, rows, tmp_path, monkeypatch):
    """The bounds of a batch are instants, whatever zone the Python process is in."""
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        path = str(tmp_path / "t")
        batch = rows.where("id BETWEEN 20 AND 26")
        append_new(batch, path, ["id"], "ts")
        append_new(batch, path, ["id"], "ts")
        assert ids(spark, path) == list(range(20, 27))
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()


def test_append_reduces_copies_and_rejects_null_keys(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    dearer = rows.withColumn("price", F.col("price") + 1)
    append_new(rows.unionAll(dearer), path, ["id"], "ts")
    assert spark.read.parquet(path).exceptAll(dearer.withColumn("year", F.year("ts")).select("id", "ts", "price", "year")).count() == 0
    with pytest.raises(ValueError, match="lack a key"):
        append_new(rows.withColumn("id", F.lit(None).cast("long")), path, ["id"], "ts")


def test_partitions_and_files_are_skipped(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(rows.withColumn("year", F.year("ts")), path, ["year"], ["ts", "id"])
    picked = between(read_parquet(spark, path), "ts", "2024-01-01 00:00:00", "2024-01-01 05:00:00")
    assert sorted(r.id for r in picked.collect()) == list(range(24, 30))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(ts," in plan
    whole = read_parquet(spark, path)
    assert whole.count() == 100 and read_parquet(spark, path, ["id"]).columns == ["id"]


def test_partitions_without_a_sort_are_rebalanced(spark, rows, tmp_path):
    df = rows.withColumn("year", F.year("ts"))
    back = write_parquet(df, str(tmp_path / "t"), ["year"])
    assert sorted(r.id for r in back.collect()) == list(range(100))
    assert back.where("year = 2023").count() == 24


def test_table_without_rows_can_be_read(spark, rows, tmp_path):
    back = write_parquet(rows.limit(0).withColumn("year", F.year("ts")), str(tmp_path / "t"), ["year"], ["ts"])
    assert back.count() == 0


def test_one_hot_year_is_spread_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).selectExpr("id", "timestamp_seconds(1704067200 + id) AS ts", "2024 AS year")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_parquet(rows, path, ["year"], ["ts"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.read.parquet(path).inputFiles()) == 4
    assert spark.read.parquet(path).count() == 20_000


def test_rows_without_a_key_are_set_aside(spark, rows, tmp_path):
    path, aside = str(tmp_path / "t"), str(tmp_path / "bad")
    odd = rows.withColumn("id", F.when(F.col("id") < 5, None).otherwise(F.col("id")))
    append_new(odd, path, ["id"], "ts", bad_rows=aside)
    assert ids(spark, path) == list(range(5, 100))
    assert spark.read.parquet(aside).count() == 5


def test_merging_in_any_order_equals_one_load(spark, rows, tmp_path):
    keyed = rows.withColumn("year", F.year("ts")).withColumn("k", F.floor(F.col("id") / 2))
    want = sorted((r.k, r.id) for r in merge_latest(keyed, str(tmp_path / "all"), ["k", "year"], "ts")[0].collect())
    for name, order in {"up": (0, 1, 2), "down": (2, 1, 0)}.items():
        for i in order:
            table, years = merge_latest(keyed.where(F.col("id") % 3 == i), str(tmp_path / name), ["k", "year"], "ts")
            assert years == [2023, 2024]
        assert sorted((r.k, r.id) for r in table.collect()) == want
    before = table.inputFiles()
    again, years = merge_latest(keyed.limit(0), str(tmp_path / "up"), ["k", "year"], "ts")
    assert years == [] and again.count() == len(want) and table.inputFiles() == before


def test_only_touched_years_are_written_anew(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for low in range(0, 100, 10):
        append_new(rows.where(f"id >= {low} AND id < {low + 10}"), path, ["id"], "ts")
    table = spark.read.parquet(path)
    files = lambda year: {f for f in spark.read.parquet(path).inputFiles() if f"year={year}" in f}
    old, other = files(2024), files(2023)
    assert compact_years(spark, path, table.schema, [2024], ["ts", "id"]).count() == 100
    assert len(files(2024)) < len(old) and files(2023) == other
    assert ids(spark, path) == list(range(100))
