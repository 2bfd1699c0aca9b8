"""CSV feeds with explicit schemas and a bad-row column."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickseries.feeds import FeedSpec

BAD_ROW = "_bad_row"


def under(root: str, path: str) -> str:
    return path if "://" in path or path.startswith("/") or not root else f"{root.rstrip('/')}/{path}"


def _checked_csv(schema: StructType, **options) -> tuple[StructType, dict]:
    """Schema and options under which a line that does not fit keeps its text in `_bad_row`, and a file whose header
    differs from the schema is an error: its values would land in the wrong columns."""
    checks = dict(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW, enforceSchema=False)
    return StructType([*schema.fields, StructField(BAD_ROW, StringType())]), checks | options


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None, **options) -> DataFrame:
    """One scan over all files of a folder, file or glob that share a header.

    With a schema the files are read once and bad lines are marked. Without one Spark infers the types, in a pass of
    its own.
    """
    if schema is None:
        return spark.read.options(header=True, inferSchema=True, **options).csv(path)
    schema, options = _checked_csv(schema, **options)
    return spark.read.schema(schema).options(**options).csv(path)


def read_feed(spark: SparkSession, feed: FeedSpec, root: str = "") -> DataFrame:
    return read_csv(spark, under(root, feed.path), feed.schema)


def read_feed_stream(spark: SparkSession, feed: FeedSpec, root: str = "", **options) -> DataFrame:
    """The feed as a stream of the files that arrive in its folder. A stream cannot infer its schema."""
    schema, options = _checked_csv(feed.schema, **options)
    return spark.readStream.schema(schema).options(**options).csv(under(root, feed.path))


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the marker, bad rows) of a CSV scan.

    A CSV scan parses, and so checks, only the columns a query uses. Both filters use every
    column, so that a row is good or bad whatever is selected later.
    """
    if BAD_ROW not in df.columns:
        return df, df.limit(0)
    checked = [c for c in df.columns if c != BAD_ROW]
    parsed = reduce(add, (F.col(f"`{c}`").isNull().cast("int") for c in checked)) >= 0
    bad = F.col(BAD_ROW).isNotNull()
    return df.where(parsed & ~bad).drop(BAD_ROW), df.where(parsed & bad)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_union(spark: SparkSession, paths: Iterable[str], schema: StructType, **options) -> DataFrame:
    """Concatenate CSV files whose headers may differ in order or lack columns.

    Each path (file, folder or glob) is one scan whose header is read from its files; the
    types come from `schema` by name. A header field outside the schema is an error.
    """

    def one(path: str) -> DataFrame:
        header = spark.read.options(header=True, **options).csv(path).columns
        unknown = [name for name in header if name not in schema.names]
        if unknown:
            raise ValueError(f"{path}: header fields {unknown} are not in the schema")
        return read_csv(spark, path, StructType([schema[name] for name in header]), **options)

    union = union_by_name(one(p) for p in paths)
    return union.select(*[F.col(f"`{name}`") for name in union.columns if name != BAD_ROW], BAD_ROW)
