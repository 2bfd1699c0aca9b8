"""What several operators of this package share: working tables, tiles of a group, files in the shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.session import materialize, work_dir

__all__ = ["children", "clear_names", "crc_remainder", "file_system", "forest", "materialize", "most_frequent", "put_file", "splitmix",
           "tile_pairs", "work_dir"]


def crc_remainder(key: str, divisor: int) -> Column:
    """crc32 of the key written as text, modulo the divisor; null where the key is null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def clear_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the input columns that an operator is about to add under the same name (names compare without case)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def splitmix(x: np.ndarray) -> np.ndarray:
    """A mixing function of 64 bits (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For links between the items 0..n-1: the smallest item that each one reaches."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def most_frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows with the largest counts, at most `most` of them: all from some count on. Rows of one count come together or not at all.

    Only how many rows have each count reaches the driver; nothing is sorted.
    """
    least, held = None, 0
    for n, same in sorted(((r[0], r[1]) for r in rows.groupBy(count).count().collect()), reverse=True):
        held += same
        if held > most:
            break
        least = n
    return rows.where(F.col(count) >= least) if least is not None else rows.limit(0)


def tile_pairs(rows: DataFrame, keys: Sequence[str], item: str, per_tile: int) -> DataFrame:
    """Deal the rows of each group into tiles and send every pair of tiles of a group to a place of its own.

    Adds `_tile`, `_i` and `_j`: the rows of a group with the same (_i, _j), i <= j, are those of the tiles i and j. A tile
    has about `per_tile` rows, whatever the size of the group, and tasks hold two tiles. Groups of one row are left
    out. `item` must be distinct within a group.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    tiles = F.ceil(F.col("_n") / per_tile)
    dealt = rows.join(sizes, list(keys)).withColumns(
        {"_tiles": tiles, "_tile": F.pmod(F.xxhash64(F.lit("tile"), item), tiles)}
    )
    places = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1),
        lambda t: F.struct(F.least(t, F.col("_tile")).alias("_i"), F.greatest(t, F.col("_tile")).alias("_j")),
    )
    return dealt.select("*", F.inline(places)).drop("_n", "_tiles")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path in it, on the driver or in a task."""
    return pafs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, chunks) -> int:
    """Write a file under its final name in one step; a task that runs again replaces it by the same bytes."""
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    written = 0
    with fs.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            written += len(chunk)
    fs.move(part, f"{path}/{name}")
    return written


def children(folder: str, name: str) -> str:
    return os.path.join(folder.rstrip("/"), name)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors share, for the files of one call."""
    return work_dir(spark, purpose)
