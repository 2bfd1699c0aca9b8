"""Line deduplication by a sharded minimal perfect hash over the distinct lines.

1. Every document gives each of its line keys once, as 128 hash bits; the keys are counted over all documents.
2. The distinct keys are cut into shards of a bounded size. Each shard gets a minimal perfect hash: levels of
   bits, in each of which the keys that fall alone on a bit are settled, so that the rank of its bit is a key's place.
   The shard keeps a fingerprint of 32 bits and a count that stops at the threshold per place, no keys and no lines.
3. Documents are dealt into chunks. The distinct keys of a chunk probe the arrays of their shard, so that a line that a third
   of all documents have reaches its shard once per chunk; a shard with many probes is sent to several tasks, which share them.
   Only the keys that must go return to their chunk; a chunk that equal rows have made large is split as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import clear_names, materialize, splitmix

MIN_DOCUMENTS = 10
KEYS_PER_SHARD = 250_000
DOCUMENTS_PER_CHUNK = 1_024
PROBES_PER_TASK = 1_000_000
MOST = 65_535
BITS_PER_KEY = 2.0

_PAIR = np.dtype([("h1", np.int64), ("h2", np.int64)])
_INDEX = "shard long, n_keys long, widths binary, bits binary, prints binary, counts binary"


def line_key(line: bytes) -> bytes:
    """The line without [\\x20\\x09-\\x0D] at its ends and with A-Z in lower case; bytes know no other space or case."""
    return line.strip().lower()


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def _keys(text: str | None) -> set[bytes]:
    return {k for k in map(line_key, _lines(text)) if k}


def _hashes(keys) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=_PAIR)


def _frame(pairs: np.ndarray, **more) -> pd.DataFrame:
    return pd.DataFrame({"h1": pairs["h1"], "h2": pairs["h2"], **more})


def count_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h1, h2, n_docs): in how many rows each line key stands. Empty keys are left out."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs, n = np.unique(_hashes(k for t in batch[text] for k in _keys(t)), return_counts=True)
            yield _frame(pairs, n=n)

    counted = docs.select(text).mapInPandas(hashed, "h1 long, h2 long, n long")
    return counted.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"))


# The minimal perfect hash of one shard --------------------------------------------------------------------------------


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salt = np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        return splitmix(h1.view(np.uint64) ^ splitmix(h2.view(np.uint64) + salt))


def build_shard(h1: np.ndarray, h2: np.ndarray, n_docs: np.ndarray, most: int = MOST) -> dict:
    """Arrays of one shard. `bits` has all levels one after another, `widths` the bits of each level. Counts stop at `most`."""
    left, levels = np.arange(len(h1)), []
    while len(left):
        width = 8 * math.ceil(BITS_PER_KEY * len(left) / 8)
        at = (_mixed(h1[left], h2[left], len(levels)) % np.uint64(width)).astype(np.int64)
        alone = np.bincount(at, minlength=width) == 1
        levels.append(alone)
        left = left[~alone[at]]
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    shard = {"widths": np.array([len(x) for x in levels], np.int64), "bits": np.packbits(bits)}
    place = probe_shard(shard | {"n_keys": len(h1)}, h1, h2)
    prints, counts = np.empty(len(h1), np.uint32), np.empty(len(h1), np.min_scalar_type(most))
    prints[place], counts[place] = h2.astype(np.uint32), np.minimum(n_docs, most)
    return shard | {"prints": prints, "counts": counts}


def probe_shard(shard: dict, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The place of each key. A key that the shard does not have gets some place, or -1; the fingerprint tells."""
    bits = np.unpackbits(shard["bits"]).astype(bool)
    ranks = np.cumsum(bits) - 1
    place, left, start = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, width in enumerate(shard["widths"]):
        at = start + (_mixed(h1[left], h2[left], level) % np.uint64(width)).astype(np.int64)
        settled = bits[at]
        place[left[settled]] = ranks[at[settled]]
        left, start = left[~settled], start + int(width)
    return place


def _shard_of(h1: str, n_shards: int) -> Column:
    return F.pmod(F.col(h1), F.lit(n_shards))


def line_index(counts: DataFrame, n_shards: int, most: int = MOST) -> DataFrame:
    """One row of arrays per shard, from the rows of `count_lines`. Counts stop at `most`."""

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        arrays = build_shard(*(pdf[c].to_numpy() for c in ("h1", "h2", "n_docs")), most)
        return pd.DataFrame([{"shard": key[0], "n_keys": len(pdf)} | {k: v.tobytes() for k, v in arrays.items()}])

    return counts.withColumn("shard", _shard_of("h1", n_shards)).groupBy("shard").applyInPandas(build, _INDEX)


def _split_large(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(`key`, _n_pieces) of the keys with more than `most` rows. Written, so that Spark knows its size when it plans the join with it."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / most).alias("_n_pieces"))
    return materialize(sizes.where("_n_pieces > 1"), "pieces")


def _i_n_pieces(rows: DataFrame, large: DataFrame, key: str, number) -> DataFrame:
    """Deal the rows of the large keys into their pieces: adds `_piece`, 0 for the others."""
    dealt = F.pmod(number, F.coalesce("_n_pieces", F.lit(1)))
    return rows.join(large, key, "left").withColumn("_piece", dealt).drop("_n_pieces")


def _to_all_pieces(rows: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """Send each row to all pieces of its key: adds `_piece`."""
    all_pieces = F.sequence(F.lit(0).cast("long"), F.coalesce("_n_pieces", F.lit(1)) - 1)
    return rows.join(large, key, "left").withColumn("_piece", F.explode(all_pieces)).drop("_n_pieces")


def _frequent(min_documents: int):
    """Probe the arrays of a shard with the keys of all chunks."""

    def probe(probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(probes) or not len(index):
            return pd.DataFrame({"_chunk": [], "h1": [], "h2": []}).astype(np.int64)
        row = index.iloc[0]
        kinds = {"widths": np.int64, "bits": np.uint8, "prints": np.uint32, "counts": np.min_scalar_type(min_documents)}
        shard = {k: np.frombuffer(row[k], kind) for k, kind in kinds.items()}
        h1, h2 = probes["h1"].to_numpy(), probes["h2"].to_numpy()
        place = probe_shard(shard, h1, h2)
        found = (place >= 0) & (shard["prints"][place] == h2.astype(np.uint32)) & (shard["counts"][place] >= min_documents)
        return probes.loc[found, ["chunk", "h1", "h2"]].rename(columns={"chunk": "_chunk"})

    return probe


def dedup_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    text: str = "text",
    keys_per_shard: int = KEYS_PER_SHARD,
    documents_per_chunk: int = DOCUMENTS_PER_CHUNK,
    probes_per_task: int = PROBES_PER_TASK,
    names: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The documents without the lines whose key stands in `min_documents` rows or more; adds n_lines and n_dropped, or other `names`.

    A line's key has no white space at its ends and A-Z in lower case. A key of no characters never goes. Every row counts
    as a document of its own, repeated ids and copies too, and a line that a row repeats counts once. A null or
    empty text is one empty line and comes back as an empty text. Other columns pass unchanged; columns that already have
    these names are replaced. An empty table gives an empty result.
    """
    docs = clear_names(docs, names)
    counts = materialize(count_lines(docs, text), "line-counts")
    n_shards = max(1, math.ceil(counts.count() / keys_per_shard))
    n_chunks = max(1, math.ceil(docs.count() / documents_per_chunk))
    index = materialize(line_index(counts, n_shards, min_documents), "line-index")

    key = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if kind in ("bigint", "string")])
    chunked = docs.withColumn("_chunk", F.pmod(key, F.lit(n_chunks)))

    def keys_by_chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, texts in batch.groupby("_chunk")[text]:
                pairs = np.unique(_hashes({k for t in texts for k in _keys(t)}))
                yield _frame(pairs, chunk=np.int64(chunk))

    probes = materialize(
        chunked.select("_chunk", text)
        .mapInPandas(keys_by_chunk, "chunk long, h1 long, h2 long")
        .distinct()
        .withColumn("shard", _shard_of("h1", n_shards)),
        "line-probes",
    )
    busy = _split_large(probes, "shard", probes_per_task)
    gone = (
        _i_n_pieces(probes, busy, "shard", F.col("chunk"))
        .groupBy("shard", "_piece")
        .cogroup(_to_all_pieces(index, busy, "shard").groupBy("shard", "_piece"))
        .applyInPandas(_frequent(min_documents), "_chunk long, h1 long, h2 long")
    )
    # Only equal rows make a chunk this large. Any deal of its rows will do, as each piece gets all keys of the chunk.
    large = _split_large(chunked, "_chunk", 2 * documents_per_chunk)

    def drop(rows: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        pairs = np.empty(len(keys), _PAIR)
        pairs["h1"], pairs["h2"] = keys["h1"], keys["h2"]
        raw = pairs.tobytes()
        hot = {raw[i : i + 16] for i in range(0, len(raw), 16)}
        kept, n_lines, n_dropped = [], [], []
        for t in rows[text]:
            lines = _lines(t)
            stay = [x for x in lines if not ((k := line_key(x)) and xxhash.xxh3_128_digest(k) in hot)] if hot else lines
            kept.append(b"\n".join(stay).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        return rows.drop(columns=["_chunk", "_piece"]).assign(**{text: kept, names[0]: n_lines, names[1]: n_dropped})

    schema = ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes) + f", `{names[0]}` long, `{names[1]}` long"
    rows = _i_n_pieces(chunked, large, "_chunk", F.monotonically_increasing_id())
    keys = _to_all_pieces(gone, large, "_chunk")
    return rows.groupBy("_chunk", "_piece").cogroup(keys.groupBy("_chunk", "_piece")).applyInPandas(drop, schema)


def line_digest(docs: DataFrame) -> DataFrame:
    """What is left of every document: doc_id, n_lines, n_dropped, kept_sha256."""
    kept = dedup_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
