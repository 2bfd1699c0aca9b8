import pytest
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tests.frames import A_HEADER, A_ROWS, write_feeds, write_lines
from tickseries.feeds import BTC, ETH
from tickseries.functions.times import event_time
from tickseries.operators.conform import rename_columns, snake_case_columns
from tickseries.operators.quality import schema_listing
from tickseries.sources.csv import BAD_ROW, read_csv, read_csv_union, read_feed, split_bad_rows, under

SCHEMA = StructType([StructField("a", LongType()), StructField("b", DoubleType()), StructField("c", DoubleType())])


def test_feed_folder_is_one_table(spark, tmp_path):
    root = write_feeds(tmp_path)
    good, bad = split_bad_rows(read_feed(spark, ETH, root))
    assert good.count() == 3
    assert bad.count() == 0
    assert split_bad_rows(read_feed(spark, BTC, root))[0].count() == len(A_ROWS)


def test_bad_rows_do_not_depend_on_the_selected_columns(spark, tmp_path):
    path = write_lines(tmp_path / "x", "x.csv", "a,b,c", ["1,1.5,2", "abc,2.5,3", "3,4", "4,x,5"])
    good, bad = split_bad_rows(read_csv(spark, path, SCHEMA))
    assert [r.b for r in good.select("b").collect()] == [1.5]
    assert sorted(r[BAD_ROW] for r in bad.select(BAD_ROW).collect()) == ["3,4", "4,x,5", "abc,2.5,3"]
    assert good.count() == 1 and bad.count() == 3


def test_other_header_order_is_an_error_in_one_scan(spark, tmp_path):
    path = write_lines(tmp_path / "x", "x.csv", "b,a,c", ["1.5,1,2"])
    with pytest.raises(Exception, match="FAILED_READ_FILE|header does not conform"):
        read_csv(spark, path, SCHEMA).collect()


def test_union_matches_headers_by_name(spark, tmp_path):
    one = write_lines(tmp_path / "one", "x.csv", "a,b,c", ["1,1.5,2"])
    two = write_lines(tmp_path / "two", "x.csv", "c,a", ["5,2"])
    rows = split_bad_rows(read_csv_union(spark, [one, two], SCHEMA))[0].select("a", "b", "c").collect()
    assert sorted(map(tuple, rows)) == [(1, 1.5, 2.0), (2, None, 5.0)]
    three = write_lines(tmp_path / "three", "x.csv", "a,zz", ["1,2"])
    with pytest.raises(ValueError, match="zz"):
        read_csv_union(spark, [one, three], SCHEMA)


def test_inferred_schema(spark, tmp_path):
    path = write_lines(tmp_path / "x", "x.csv", A_HEADER, A_ROWS)
    df = read_csv(spark, path, None)
    assert df.columns == A_HEADER.split(",")
    assert split_bad_rows(df)[0].count() == len(A_ROWS)


def test_names(spark, tmp_path):
    df = spark.createDataFrame([], "Timestamp long, `Volume_(BTC)` double, Weighted_Price double")
    assert rename_columns(df, BTC.renames).columns == ["Timestamp", "Volume_BTC", "Weighted_Price"]
    assert snake_case_columns(df).columns == ["timestamp", "volume_btc", "weighted_price"]
    with pytest.raises(ValueError):
        snake_case_columns(spark.createDataFrame([], "`a b` int, a_b int"))
    assert [(r.column, r.data_type) for r in schema_listing(df).orderBy("position").collect()] == [
        ("Timestamp", "bigint"),
        ("Volume_(BTC)", "double"),
        ("Weighted_Price", "double"),
    ]


@pytest.mark.parametrize(
    "value,ts_format,want",
    [
        (1502942400, "epoch_s", "2017-08-17 04:00:00"),
        (1502942459999, "epoch_ms", "2017-08-17 04:00:59.999"),
        ("2017-08-17 04:00:00", "string", "2017-08-17 04:00:00"),
        ("2017-08-17 04:00:00", "timestamp", "2017-08-17 04:00:00"),
        ("abc", "string", None),
        ("abc", "string_or_ms", None),
        ("1502942459999", "string_or_ms", "2017-08-17 04:00:59.999"),
        ("2017-08-17 04:00:00", "string_or_ms", "2017-08-17 04:00:00"),
        ("2018/01/01 00:01:00", "string_or_ms", None),
        (None, "string_or_ms", None),
        ("abc", "timestamp", None),
        ("abc", "epoch_s", None),
        ("abc", "epoch_ms", None),
        ("1502942400", "epoch_s", "2017-08-17 04:00:00"),
        ("1502942400.5", "epoch_s", "2017-08-17 04:00:00.5"),
        (1735689600000000, "epoch_us", "2025-01-01 00:00:00"),
        (1735689600000000123, "epoch_ns", "2025-01-01 00:00:00"),
        (86400000, "epoch_ms", "1970-01-02 00:00:00"),
        (-1, "epoch_s", "1969-12-31 23:59:59"),
        (-1, "epoch_ns", "1969-12-31 23:59:59.999999"),
        (1735689600000000, "epoch_s", None),
        (9223372036854775807, "epoch_ms", None),
        (-9223372036854775808, "epoch_s", None),
        ("1" + "0" * 40, "epoch_s", None),
    ],
)
def test_event_time(spark, value, ts_format, want):
    kind = "long" if isinstance(value, int) else "string"
    df = spark.createDataFrame([(value,)], f"t {kind}")
    assert df.select(event_time("t", ts_format).cast("string")).first()[0] == want


def test_unknown_format():
    with pytest.raises(ValueError):
        event_time("t", "minutes")


def test_roots():
    assert under("s3a://bucket/in", "btc") == "s3a://bucket/in/btc"
    assert under("data/", "btc") == "data/btc"
    assert under("data", "/abs/btc") == "/abs/btc"
    assert under("data", "s3a://bucket/btc") == "s3a://bucket/btc"
    assert under("", "btc") == "btc"
