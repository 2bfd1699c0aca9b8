"""Naming: renames, snake case, mapping to the common fields."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.feeds import FeedSpec


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def snake_case(name: str) -> str:
    """`Volume_(BTC)` -> `volume_btc`."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = {name: snake_case(name) for name in df.columns}
    if len(set(names.values())) < len(names):
        raise ValueError(f"column names collide in snake case: {df.columns}")
    return df.withColumnsRenamed(names)


def measure_columns(feed: FeedSpec, measures: list[str]) -> list[Column]:
    """The feed's fields under their common names, prefixed with the feed name."""
    return [F.col(f"`{feed.measures[m]}`").alias(f"{feed.name}_{m}") for m in measures]


def long_columns(feed: FeedSpec, measures: list[str]) -> list[Column]:
    """The feed's fields under their common names without a prefix, with the feed name as `asset`."""
    return [F.lit(feed.name).alias("asset"), *[F.col(f"`{feed.measures[m]}`").alias(m) for m in measures]]
