import pytest
from pyspark.sql import functions as F

from tickseries.operators import quality
from tickseries.operators.align import missing_buckets, pivot_assets
from tickseries.operators.bars import resample
from tickseries.operators.stats import correlation, fit_linear, predict_linear, trend

NAN = float("nan")


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, NAN, None), (None, 4.0, "d")], "k int, v double, s string")


def one(df):
    return df.first()[0]


def test_counts(gaps):
    assert tuple(quality.row_count(gaps).first()) == (4, 3)
    assert one(quality.non_null_count(gaps, "v")) == 3
    assert one(quality.missing_count(gaps, "v")) == 2
    assert one(quality.missing_count(gaps, "v", nan_is_missing=False)) == 1
    assert one(quality.missing_count(gaps, "k")) == 1


def test_profile_and_listing(gaps):
    assert sorted(map(tuple, quality.null_profile(gaps).collect())) == [("k", 4, 1, 0), ("s", 4, 1, 0), ("v", 4, 1, 1)]
    assert sorted(map(tuple, quality.schema_listing(gaps).collect())) == [("k", 1, "int", True), ("s", 3, "string", True), ("v", 2, "double", True)]
    assert sorted(map(tuple, quality.schema_listing(gaps, count_values=True).collect())) == [
        ("k", 1, "int", True, 3),
        ("s", 3, "string", True, 3),
        ("v", 2, "double", True, 3),
    ]


def test_report_passes_and_fails(spark, gaps):
    good = spark.createDataFrame([(1,)], "k int")
    report = quality.quality_report({"good": (good, "k"), "gaps": (gaps, "k"), "empty": (good.limit(0), "k")})
    assert sorted(map(tuple, report.collect())) == [
        ("empty", "k", 0, 0, False),
        ("gaps", "k", 4, 1, False),
        ("good", "k", 1, 0, True),
    ]
    quality.assert_quality(quality.quality_report({"good": (good, "k")}))
    with pytest.raises(quality.DataQualityError, match="gaps"):
        quality.assert_quality(report)


def test_unlikely_years(spark):
    df = spark.createDataFrame([(1502942459999,), (1502942460,)], "t long").select(F.timestamp_seconds("t").alias("ts"))
    assert one(quality.year_out_of_range_count(df, "ts")) == 1


def test_preview(spark):
    assert [r.id for r in quality.preview(spark.range(100), ["id"], 3).collect()] == [0, 1, 2]


def test_bars_and_rollup(spark):
    rows = [("a", 0, 1, 5.0), ("a", 0, 2, 6.0), ("a", 10, 3, 9.0), ("a", 59, 4, 2.0), ("a", 59, 5, 3.0), ("a", 60, 6, 7.0)]
    ticks = spark.createDataFrame(rows, "asset string, s long, id long, price double").withColumn("ts", F.timestamp_seconds("s"))
    price = dict(open="price", high="price", low="price", close="price", volume="price")
    minute = resample(ticks, ["asset"], "ts", "minute", ["id"], **price)
    got = [(r.open, r.high, r.low, r.close, r.volume, r.n_rows) for r in minute.orderBy("bucket").collect()]
    assert got == [(5.0, 9.0, 2.0, 3.0, 25.0, 5), (7.0, 7.0, 7.0, 7.0, 7.0, 1)]
    hour = resample(minute.withColumnRenamed("bucket", "ts"), ["asset"], "ts", "hour")
    direct = resample(ticks, ["asset"], "ts", "hour", ["id"], **price)
    columns = ["asset", "bucket", "open", "high", "low", "close", "volume"]
    assert hour.select(columns).collect() == direct.select(columns).collect()


def test_missing_and_pivot(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 2), ("b", 3)], "asset string, m int")
    assert [r.bucket for r in missing_buckets(df, F.col("m"), "asset", "a", "b").collect()] == [1]
    wide = pivot_assets(df, F.col("m"), "asset", ["a", "b"], n=F.count(F.lit(1)))
    assert sorted(map(tuple, wide.na.fill(0).collect())) == [(1, 2, 0), (2, 1, 1), (3, 0, 1)]


def test_correlation_and_fits(spark):
    df = spark.range(50).select(
        (F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"), (F.col("id") * 3.0 + 1).alias("y")
    )
    assert round(correlation(df, "x", "y").first().corr, 9) == 1.0
    assert correlation(df.limit(1), "x", "y").first().corr is None
    assert {(r.g, round(r.slope, 9), round(r.intercept, 9)) for r in trend(df, ["g"], "y", "x").collect()} == {
        (0, 3.0, 1.0),
        (1, 3.0, 1.0),
    }
    two = df.withColumn("z", F.sin("x")).withColumn("label", F.col("x") * 2 - F.col("z") + 4)
    (whole,) = fit_linear(two, "label", ["x", "z"]).collect()
    assert [round(v, 6) for v in whole] == [50, 4.0, 2.0, -1.0]


def test_fits_and_predictions_per_group(spark):
    df = spark.range(60).select(
        (F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"), F.when(F.col("id") > 5, F.sin("id")).alias("z")
    )
    df = df.withColumn("label", F.col("g") + F.col("x") * 2 - F.col("z") * F.col("g"))
    fitted = fit_linear(df, "label", ["x", "z"], ["g"])
    got = {r.g: [r.n_rows, *[round(v, 6) + 0.0 for v in r[2:]]] for r in fitted.collect()}
    assert got == {g: [18, float(g), 2.0, 0.0 - g] for g in range(3)}
    rows = predict_linear(df, fitted, ["x", "z"], ["g"]).collect()
    assert len(rows) == 60
    assert all((r.predicted is None) == (r.z is None) and (r.z is None or abs(r.predicted - r.label) < 1e-9) for r in rows)
    one = fit_linear(df.withColumn("z", F.lit(1.0)), "label", ["x", "z"], ["g"])
    assert all(r.intercept is None and r.coef_x is None for r in one.collect())


def test_contract(spark):
    rows = [(1, 1.0, "2020-01-01"), (2, None, "2020-01-01"), (2, 2.0, "2200-01-01"), (None, 3.0, "2020-01-01")]
    df = spark.createDataFrame(rows, "k int, v double, t string").withColumn("ts", F.to_timestamp("t"))
    got = quality.check_contract(df, "x", ["k", "v"], ["k"], "ts").first()
    assert tuple(got) == ("x", 4, 2, 1, 1, False)
    assert tuple(quality.check_contract(df.where("k = 1"), "x", ["k", "v"], ["k"], "ts").first()) == ("x", 1, 0, 0, 0, True)
    assert tuple(quality.check_contract(df.limit(0), "x", ["k"], ["k"]).first()) == ("x", 0, 0, 0, 0, True)
