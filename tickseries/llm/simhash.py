"""SimHash near-duplicates by an index of byte positions with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most d bits agree in at least 8 - d of their positional bytes.
With d = 2, cut the positions into four pairs: two differing bits spoil two pairs at most, so two fingerprints within reach
agree in some two pairs, that is in four positional bytes. The postings are therefore kept by (two pairs of positions, their bytes),
the shared positional bytes of the fingerprints that meet in a posting are tallied, those with fewer than the guaranteed
matches are let go and the rest is verified by counting bits. Equal fingerprints are one entry throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import forest, materialize, tile_pairs
from tickseries.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
FINGERPRINTS_PER_TILE = 1_024
SHINGLES_AT_ONCE = 1 << 18



def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits: a bit is 1 if it is set in over half of the hashes of the shingles. No words: zero.

    bytes.lower() and bytes.split() know A-Z and [\\x20\\x09-\\x0D] only.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - span + 1], ends[span - 1 :]
    hashed = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        pairs = zip(starts[at : at + SHINGLES_AT_ONCE].tolist(), ends[at : at + SHINGLES_AT_ONCE].tolist())
        hashes = np.array([hashed(joined[a:b], 42) for a, b in pairs], np.dtype("<u8"))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(starts), bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Adds `_fp`, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    return docs.withColumn("_fp", prints(F.col(text)))


def _byte_groups(max_bits: int) -> tuple[list[list[int]], int]:
    """Cut the byte positions into groups so that, with every differing bit spoiling one, half of them or two stay."""
    n_groups = min(8, max(3, 2 * max_bits))
    return [list(map(int, g)) for g in np.array_split(np.arange(8), n_groups)], n_groups - max_bits


def posting_keys(max_bits: int = MAX_BITS):
    """The postings of the fingerprint `_fp`: which positions, and what bytes stand there."""
    groups, n_kept = _byte_groups(max_bits)
    masks = []
    for chosen in combinations(groups, n_kept):
        mask = sum(0xFF << (8 * b) for g in chosen for b in g)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.struct(F.lit(i).alias("_which"), F.col("_fp").bitwiseAND(F.lit(m)).alias("_bytes")) for i, m in enumerate(masks)])


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, per_tile: int = FINGERPRINTS_PER_TILE) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints `_fp` within `max_bits` bits of each other, and no others.

    Each place of a posting compares two tiles of bounded size and returns the links of a spanning forest, so
    the rows that leave it are fewer than its fingerprints.
    """
    if max_bits > 7:
        raise ValueError("fingerprints that differ in eight bits may have no byte in common")
    postings = prints.select("_fp", F.inline(posting_keys(max_bits)))
    placed = tile_pairs(postings, ["_which", "_bytes"], "_fp", per_tile)
    gathered = placed.groupBy("_which", "_bytes", "_i", "_j").agg(F.collect_list("_fp").alias("fps"), F.collect_list((F.col("_tile") == F.col("_i")).cast("tinyint")).alias("firsts"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list[np.ndarray] = []
            for fps, firsts, i, j in zip(batch["fps"], batch["firsts"], batch["_i"], batch["_j"]):
                fps, first = np.asarray(fps, np.int64), np.asarray(firsts, bool)
                left, right = (np.arange(len(fps)),) * 2 if i == j else (np.flatnonzero(first), np.flatnonzero(~first))
                a, b = _tally(fps, left, right, max_bits)
                root = forest(len(fps), a, b)
                tied = np.flatnonzero(root != np.arange(len(fps)))
                found.append(np.stack([fps[tied], fps[root[tied]]]))
            if found:
                links = np.concatenate(found, axis=1)
                yield pd.DataFrame({"a": links[0], "b": links[1]})

    return gathered.select("fps", "firsts", "_i", "_j").mapInPandas(compare, "a long, b long")


def _tally(fps: np.ndarray, left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Count the shared positional bytes of each pair, keep those with enough of them, verify their bits."""
    as_bytes = fps.view(np.uint8).reshape(-1, 8)
    shared = np.zeros((len(left), len(right)), np.int8)
    for position in range(8):
        shared += as_bytes[left, position][:, None] == as_bytes[right, position][None, :]
    a, b = np.nonzero(shared >= 8 - max_bits)
    a, b = left[a], right[b]
    near = (np.bitwise_count(fps[a].view(np.uint64) ^ fps[b].view(np.uint64)) <= max_bits) & (a != b)
    return a[near], b[near]


def simhash_groups(
    docs: DataFrame,
    max_bits: int = MAX_BITS,
    shingle_words: int = SHINGLE_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    per_tile: int = FINGERPRINTS_PER_TILE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Words are [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case; shingles have `shingle_words` words, repeats
    included; fewer words are one shingle; a null, empty or blank text has the fingerprint zero, which links like any other.
    Fingerprints with at most `max_bits` differing bits link; component_id is the smallest doc_id reachable. Repeated rows
    and ids come back as often as they are given. A null doc_id takes part, but names a component only if all its ids are null.
    An empty table gives an empty result; other columns are not read.
    """
    prints = materialize(with_fingerprints(docs.select(doc_id, text), text, shingle_words).select(doc_id, "_fp"), "prints")
    by_print = prints.groupBy("_fp").agg(F.min(doc_id).alias("low"))
    roots = components(near_links(by_print.select("_fp"), max_bits, per_tile)).withColumnRenamed("node", "_fp")
    rooted = by_print.join(roots, "_fp", "left").withColumn("root", F.coalesce("root", "_fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("_fp", "component_id")
    shown = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "_fp").select(doc_id, shown, "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """One row of each group stays, that with the smallest doc_id. The columns stay as they are.

    Rows without an id come after those with one; rows of one id are told apart by their text, and equal rows by where they are
    stored. So a group of repeated rows, or of rows without ids, keeps one row like any other, and no row decides over another group.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    # Stored, so that a row has the same number whenever it is read.
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    place = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"), F.col(row).alias("row"))
    groups = simhash_groups(stored.select(place.alias("place"), text), doc_id="place", text=text, **parameters)
    first = groups.where(F.col("place").eqNullSafe(F.col("component_id"))).select(F.col("place.row").alias(row))
    return stored.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
