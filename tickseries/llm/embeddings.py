"""Embedding near-duplicates by tiled comparison along principal components.

Vectors are scaled to length one and turned into the axes of their principal components, largest first, which leaves every
cosine as it is. The two leading coordinates put vectors into cells as wide as two linked vectors can lie apart, so links are
found within a cell and its neighbours. Cells are cut into tiles, and a task compares two tiles: it adds up the products of the
leading coordinates block by block; what the others can still add is at most the product of the lengths of the two remainders. A pair
that cannot reach the threshold any more is let go, and the comparison ends when none is left. Pairs that stay are verified
by the cosine of the vectors as given. Equal vectors of a label are one entry throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import forest, materialize
from tickseries.llm.components import components

THRESHOLD = 0.98
PER_TILE = 1_024
DIMENSIONS_AT_ONCE = 8
SLACK = 1e-9  # of the turned coordinates; the verification has none

_LINKS = "a long, b long, node long, n long"


def usable_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One entry per distinct vector of a label: label, v (doubles), entry (its number), copies, low (its smallest vec_id).

    Left out, as they link with nothing: rows without label or vector, and vectors that are empty or zero or hold null or
    non-finite components.
    """
    good = (
        F.col(label).isNotNull()
        & (F.size(embedding) > 0)
        & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(embedding, lambda x: x != 0)
    )
    vectors = rows.where(good).select(F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"), F.col(vec_id).alias("id"))
    grouped = vectors.groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"))
    return grouped.withColumn("entry", F.monotonically_increasing_id())


def principal_axes(entries: DataFrame) -> np.ndarray:
    """The axes, as columns, from the products of all unit vectors summed over all rows, copies included.

    Each task adds its rows up into one square matrix; the sums meet by element, and a matrix of the dimension reaches the driver.
    Shorter vectors count as filled up with zeros.
    """
    size = entries.agg(F.max(F.size("v"))).first()[0] or 0

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            units = _padded(batch["v"], size)
            total += (units * batch["copies"].to_numpy()[:, None]).T @ units
        at = np.arange(size * size)
        yield pd.DataFrame({"at": at, "s": total.ravel()})

    summed = entries.select("v", "copies").mapInPandas(products, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
    matrix = np.zeros(size * size)
    for row in summed.collect():
        matrix[row["at"]] = row["s"]
    if not size:
        return np.zeros((0, 0))
    return np.linalg.eigh(matrix.reshape(size, size))[1][:, ::-1]


def _padded(vectors, size: int) -> np.ndarray:
    """Unit vectors as rows, filled up with zeros. Scaling by the largest component first keeps squares in range."""
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        v = np.asarray(v, float)
        v = v / np.abs(v).max()
        out[i, : len(v)] = v / math.sqrt(v @ v)
    return out


def compare_tiles(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows whose products may reach the threshold, by leading coordinates and bounds on the rest."""
    reach = threshold - SLACK
    pairs, product = None, 0.0
    for start in range(0, left.shape[1], DIMENSIONS_AT_ONCE):
        stop = start + DIMENSIONS_AT_ONCE
        rest_left, rest_right = (np.sqrt((x[:, stop:] ** 2).sum(axis=1)) for x in (left, right))
        if pairs is None:
            product = left[:, start:stop] @ right[:, start:stop].T
            a, b = np.nonzero(product + rest_left[:, None] * rest_right[None, :] >= reach)
            pairs, product = (a, b), product[a, b]
        else:
            a, b = pairs
            product = product + (left[a, start:stop] * right[b, start:stop]).sum(axis=1)
            stay = product + rest_left[a] * rest_right[b] >= reach
            pairs, product = (a[stay], b[stay]), product[stay]
        if not len(pairs[0]):
            break
    return pairs if pairs is not None else (np.zeros(0, int), np.zeros(0, int))


def _cosines(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (v * w).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((w * w).sum(axis=1)))


def near_vectors(entries: DataFrame, axes: np.ndarray, threshold: float = THRESHOLD, per_tile: int = PER_TILE) -> DataFrame:
    """Rows of two kinds: (a, b) links of spanning forests, (node, n) the linked rows that a pair of tiles adds to an entry."""
    size = len(axes)
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turned = _padded(batch["v"], size) @ axes
            cells = np.floor(turned[:, :2] / width).astype(np.int64)
            cells = np.pad(cells, ((0, 0), (0, 2 - cells.shape[1])))
            yield batch.assign(t=list(turned), x=cells[:, 0], y=cells[:, 1], d=batch["v"].map(len))

    kinds = f"label {entries.schema['label'].dataType.simpleString()}, v array<double>, copies long, entry long"
    turned = materialize(entries.select("label", "v", "copies", "entry").mapInPandas(turn, kinds + ", t array<double>, x long, y long, d long"), "turned")

    # Tiles of a cell have about per_tile entries. A tile meets the tiles of its own cell and of half of the neighbours,
    # so that two cells meet once. A place is named by the first cell, the step to the second one and both tiles.
    cell = ["label", "d", "x", "y"]
    tiles = turned.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / per_tile).alias("tiles"))
    dealt = turned.join(tiles, cell).withColumn("tile", F.pmod(F.xxhash64("entry"), "tiles"))
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    ways = tiles.select(*cell, "tiles", F.inline(steps))
    other = tiles.select("label", "d", F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("tiles").alias("tiles2"))
    meets = ways.join(
        other,
        (ways["label"] == other["label"]) & (ways["d"] == other["d"]) & (other["x2"] == ways["x"] + ways["dx"]) & (other["y2"] == ways["y"] + ways["dy"]),
    ).select(*[ways[c] for c in cell], "dx", "dy", "tiles", "x2", "y2", "tiles2")
    places = (
        meets.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles2") - 1)))
        .where((F.col("dx") != 0) | (F.col("dy") != 0) | (F.col("i") <= F.col("j")))
        .withColumn("place", F.xxhash64(*cell, "dx", "dy", "i", "j"))
    )
    first = places.select(*cell, F.col("i").alias("tile"), "place", F.lit(True).alias("first"))
    second = places.where((F.col("dx") != 0) | (F.col("dy") != 0) | (F.col("i") != F.col("j"))).select(
        "label", "d", F.col("x2").alias("x"), F.col("y2").alias("y"), F.col("j").alias("tile"), "place", F.lit(False).alias("first")
    )
    gathered = dealt.join(first.unionByName(second), [*cell, "tile"])

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("entry")
        first = rows["first"].to_numpy()
        left = rows[first]
        right = left if first.all() else rows[~first]
        a, b = compare_tiles(np.stack(left["t"]), np.stack(right["t"]), threshold)
        if right is left:
            a, b = a[a < b], b[a < b]
        v, w = np.stack(left["v"])[a], np.stack(right["v"])[b]
        linked = _cosines(v, w) >= threshold
        a, b = a[linked], b[linked]
        offset = 0 if right is left else len(left)
        nodes = left if right is left else pd.concat([left, right])
        entry, copies = nodes["entry"].to_numpy(), nodes["copies"].to_numpy()
        b = b + offset
        n = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes)) if len(a) else np.zeros(len(nodes))
        root = forest(len(nodes), a, b)
        tied, counted = np.flatnonzero(root != np.arange(len(nodes))), np.flatnonzero(n)
        links = pd.DataFrame({"a": entry[tied], "b": entry[root[tied]], "node": None, "n": None}, dtype=object)
        sums = pd.DataFrame({"a": None, "b": None, "node": entry[counted], "n": n[counted].astype(np.int64)}, dtype=object)
        return pd.concat([links, sums]).astype("Int64")

    return gathered.select("place", "first", "entry", "copies", "t", "v").groupBy("place").applyInPandas(compare, _LINKS)


def near_duplicate_vectors(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    per_tile: int = PER_TILE,
) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows with a cosine of `threshold` or more), component_id, kept.

    Vectors link only where labels are equal and not null and dimensions agree, by the cosine in double precision. Vectors that are
    null, empty or zero or hold null or non-finite components have no links and are their own component.
    component_id is the smallest vec_id reachable, itself included; kept tells whether it is the row's own. Equal vectors of
    a label link with each other. Repeated ids come back as often as they are given; a null vec_id names a
    component only if all its ids are null. Columns with other names are ignored; an empty table gives an empty result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine over 0")
    entries = materialize(usable_vectors(rows, vec_id, embedding, label), "vectors")
    found = materialize(near_vectors(entries, principal_axes(entries), threshold, per_tile), "near-vectors")
    sums = found.where(F.col("node").isNotNull()).groupBy(F.col("node").alias("entry")).agg(F.sum("n").alias("n"))
    roots = components(found.where(F.col("a").isNotNull()).select("a", "b")).withColumnRenamed("node", "entry")
    tied = entries.join(sums, "entry", "left").join(roots, "entry", "left").withColumn("root", F.coalesce("root", "entry"))
    lowest = tied.groupBy("root").agg(F.min("low").alias("component_id"))
    named = tied.join(lowest, "root").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_n"), "component_id"
    )
    all_rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("_own"), F.col(label).alias("_l"))
    joined = all_rows.join(named, (F.col("_l") == F.col("_label")) & (F.col("_own") == F.col("_v")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
