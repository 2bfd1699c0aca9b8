"""One definition of "missing": null, or NaN in a floating-point column."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField


def is_float(field: StructField) -> bool:
    return isinstance(field.dataType, (DoubleType, FloatType))


def is_missing(field: StructField) -> Column:
    c = F.col(f"`{field.name}`")
    return c.isNull() | F.isnan(c) if is_float(field) else c.isNull()


def is_present(field: StructField) -> Column:
    c = F.col(f"`{field.name}`")
    return c.isNotNull() & ~F.isnan(c) if is_float(field) else c.isNotNull()


def complete_row(df: DataFrame, required: Iterable[str] | None = None) -> Column:
    """True where no required column (default: all) is missing.

    A conjunction of `isNotNull` reaches the Parquet scan as pushed filters, which `na.drop()` does not.
    """
    wanted = list(df.columns if required is None else required)
    return reduce(and_, (is_present(df.schema[name]) for name in wanted))
