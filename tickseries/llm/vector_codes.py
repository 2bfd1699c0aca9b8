"""Operator 12: vectors compressed to one byte a part, with per-dimension value dictionaries.

Components become integers. A block of vectors keeps, for each dimension, the distinct integers that occur and a code per vector.
Against a codebook, the squared difference of every distinct integer to all entries is tabulated once per
dimension; the distances of a part are then gathered from the tables by the codes and added up. The codebooks are
learned by rounds of assigning and averaging, where blocks return sums by (part, entry) and never vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK_ROWS = 4096
# Integers below this size: a squared distance then fits a long, for up to eight dimensions a part.
LARGEST = 1 << 28

# The codes of a block have two bytes, little-endian, one dimension after the other; the dictionaries lie one after the other.
_CODE = np.dtype("<u2")


class Codebooks:
    """Entries of every part: integers of shape (parts, entries, width)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts, self.size, self.width = entries.shape

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part (ties: the lower index) and its squared distance, of shape (parts, vectors)."""
        nearest = np.empty((self.parts, block.n), np.int64)
        apart = np.empty((self.parts, block.n), np.int64)
        for part in range(self.parts):
            distances = np.zeros((block.n, self.size), np.int64)
            for w in range(self.width):
                values, codes = block.dimension(part * self.width + w)
                table = (values[:, None] - self.entries[part, :, w][None, :]) ** 2
                distances += table[codes]
            nearest[part] = distances.argmin(axis=1)
            apart[part] = distances[np.arange(block.n), nearest[part]]
        return nearest, apart

    def sums(self, block: Block) -> np.ndarray:
        """How many vectors chose each (part, entry), then the sums of their components by (part, entry, place in the part)."""
        nearest, _ = self.assign(block)
        counts = np.zeros((self.parts, self.size), np.int64)
        totals = np.zeros(self.entries.shape, np.int64)
        for part in range(self.parts):
            counts[part] = np.bincount(nearest[part], minlength=self.size)
            for w in range(self.width):
                values, codes = block.dimension(part * self.width + w)
                pairs = np.bincount(nearest[part] * len(values) + codes, minlength=self.size * len(values))
                totals[part, :, w] = pairs.reshape(self.size, len(values)) @ values
        return np.concatenate([counts.ravel(), totals.ravel()])

    def moved(self, sums: np.ndarray) -> Codebooks:
        """Entries at the floor of the mean of what chose them; entries that nothing chose stay."""
        n = self.parts * self.size
        counts, totals = sums[:n].reshape(self.parts, self.size, 1), sums[n:].reshape(self.entries.shape)
        return Codebooks(np.where(counts > 0, totals // np.maximum(counts, 1), self.entries))


class Block:
    def __init__(self, sizes: list[int], values: np.ndarray, codes: bytes):
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.values = values
        self.codes = np.frombuffer(codes, _CODE).reshape(len(sizes), -1)
        self.n = self.codes.shape[1]

    def dimension(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct integers of a dimension and the code of each vector."""
        return self.values[self.starts[d] : self.starts[d + 1]], self.codes[d]


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, label, v) as blocks: ids, labels, and of each dimension its dictionary and the codes."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(at, BLOCK_ROWS)
            matrix = np.stack(rows.column("v").to_numpy(zero_copy_only=False))
            dictionaries, codes = zip(*(np.unique(column, return_inverse=True) for column in matrix.T))
            one = [0, rows.num_rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(one, rows.column("id")),
                    pa.ListArray.from_arrays(one, rows.column("label")),
                    pa.array([[len(d) for d in dictionaries]], pa.list_(pa.int32())),
                    pa.array([np.concatenate(dictionaries)], pa.list_(pa.int64())),
                    pa.array([np.stack(codes).astype(_CODE).tobytes()], pa.binary()),
                ],
                names=["ids", "labels", "sizes", "dictionary", "codes"],
            )


def _read(batch: pa.RecordBatch) -> Iterator[tuple[Block, pa.Array, pa.Array]]:
    columns = [batch.column(c) for c in ("sizes", "dictionary", "codes", "ids", "labels")]
    for sizes, values, codes, ids, labels in zip(*columns):
        yield Block(sizes.as_py(), values.values.to_numpy(), codes.as_py()), ids.values, labels.values


def _usable(vector: str) -> Column:
    """Not null, not empty, without nulls, NaN and infinities."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _integers(vectors: DataFrame, vector: str, key: str, label: str, parts: int, scale: int) -> DataFrame:
    """(id, label, v) of the usable vectors, v their integers; fails for vectors that cannot be cut or compared."""
    real = F.transform(vector, lambda x: x.cast("double") * scale)
    usable = vectors.where(_usable(vector)).select(F.col(key).alias("id"), F.col(label).alias("label"), real.alias("x"))
    sizes = usable.agg(F.min(F.size("x")), F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} dimensions: they need one number of them")
    if sizes[0] and sizes[0] % parts:
        raise ValueError(f"{sizes[0]} dimensions cannot be cut into {parts} equal parts")
    if sizes[0] and sizes[2] >= LARGEST:
        raise ValueError(f"components of {sizes[2] / scale}: they need to be below {LARGEST // scale}")
    return usable.select("id", "label", F.transform("x", lambda x: F.floor(x)).alias("v"))


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The vectors with the smallest ids (null ids last, rows of one id by their components), cut into parts."""
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()  # as many rows as entries
    if not first:
        return None
    matrix = np.array([r["v"] for r in first], np.int64)
    return Codebooks(np.ascontiguousarray(matrix.reshape(len(first), parts, -1).transpose(1, 0, 2)))


def _sums(blocks: DataFrame, books: Codebooks) -> np.ndarray:
    """`Codebooks.sums` of all blocks: each task adds up its blocks, and one number per entry and component reaches the driver."""
    length = books.parts * books.size * (1 + books.width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, np.int64)
        for batch in batches:
            for block, _, _ in _read(batch):
                total += books.sums(block)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "s"])

    found = blocks.mapInArrow(add, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).toPandas()
    total = np.zeros(length, np.int64)
    total[found["at"].to_numpy(np.int64)] = found["s"].to_numpy(np.int64)
    return total


def compress(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error) for every usable vector, with the codebooks (None without vectors).

    A component x becomes floor(scale * x). `code` is a string with two hex digits a part, `error` the squared distance to the chosen
    entries. Vectors that are null, empty or hold null or non-finite components are left out. With fewer usable vectors than
    `entries`, the codebooks have as many entries as there are vectors. Vectors of different lengths, of a length that
    `parts` does not divide or with components of 2^28 / scale or more are an error. Repeated rows come back as given.
    """
    if entries > 256:
        raise ValueError("two hex digits name 256 entries at most")
    rows = _integers(vectors, vector, key, label, parts, scale)
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    books = _first_codebooks(rows, parts, entries)
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    stored = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, sizes array<int>, dictionary array<long>, codes binary"
    blocks = materialize(rows.mapInArrow(_blocks_of, stored), "vector_blocks")
    for _ in range(rounds):
        books = books.moved(_sums(blocks, books))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, labels in _read(batch):
                nearest, apart = books.assign(block)
                codes = [row.tobytes().hex() for row in np.ascontiguousarray(nearest.T.astype(np.uint8))]
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(codes, pa.string()), pa.array(apart.sum(axis=0), pa.int64())],
                    names=["id", "label", "code", "error"],
                )

    return materialize(blocks.mapInArrow(encode, schema), "vector_codes"), books


def vector_codes(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", **settings) -> DataFrame:
    """`compress` with the errors per label and the digest of the codebooks: the key, code, error, label_error, codebooks_sha256.

    Null labels form one group. A label's errors are added up in each task before the shuffle. An empty table gives an empty result; other columns
    are ignored.
    """
    coded, books = compress(vectors, vector, key, label, **settings)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
    digest = F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    return joined.select(F.col("id").alias(key), "code", "error", "label_error", digest)
