"""Benchmark decontamination: windows of documents within an edit distance of a benchmark item.

Texts are words, and edits insert, delete or change a word. A window is as long as the item. The CGK embedding walks over
a string of n words for 3n steps, repeats the present word, and at each step moves on or stays as a random bit of (step, word) says; a
small edit distance becomes a small Hamming distance, as two walks soon meet again behind an edit. Bit sampling takes a few
steps of an embedding for a bucket, near each other, since two walks that agree at one step mostly agree at the next ones too. Each
bucket has a walk of its own. How many a length needs is measured: pairs of that length with as many edits as are allowed, of
several kinds, are walked, and the kind that meets least must reach the target recall. Windows and items that share a bucket are then
verified by their exact edit distance.

Each edit spoils one word and two pairs of neighbouring words at most, so a window in which more words or pairs stand in no item
of its length is not embedded; nothing within reach is lost by it. Equal windows are embedded once in a task and joined and
verified once.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import materialize, splitmix

SIMILARITY = 0.8
TARGET_RECALL = 0.999
SAMPLED_STEPS = 3
STEPS_APART = 3
MEASURED_PAIRS = 16
MEASURED_WALKS = 128
MEASURED_ONE_BY_ONE = 20
FILTER_BITS = 1 << 23
WINDOWS_AT_ONCE = 1 << 14
WORDS_AT_ONCE = 1 << 20
KEYS_AT_ONCE = 1 << 18
WINDOWS_HELD = 1 << 18
CHARACTERS_AT_ONCE = 1 << 17

_WORD = re.compile(r"\w+")
_GAP = re.compile(r"\W")
_HIT = "doc_id long, start long, size long, window long, words array<long>, buckets array<long>"


@lru_cache(maxsize=1)
def _characters() -> np.ndarray:
    """A random number by code point for what words are made of, and 0 for all else."""
    every = np.arange(sys.maxunicode + 1, dtype="<u4")
    found = np.zeros(len(every), np.uint64)
    for run in _WORD.finditer(every.tobytes().decode("utf-32-le", "surrogatepass")):
        found[run.start() : run.end()] = _random(3, every[run.start() : run.end()]) | np.uint64(1)
    return found


@lru_cache(maxsize=1)
def _places(n: int) -> np.ndarray:
    """A random number for each of the first n places in a word."""
    return _random(23, np.arange(n)) | np.uint64(1)


def words_of_all(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts in lower case, without punctuation, as 64-bit hashes over 0, one text after another, and where each text begins,
    with the end behind the last.

    A hash mixes the sum of its characters' numbers times those of their places, so all words of many characters take a few array operations.
    """
    lowered = [(t or "").lower() for t in texts]
    joined = "\n".join(lowered)
    begins = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    hashes, starts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(joined):
        gap = _GAP.search(joined, at + CHARACTERS_AT_ONCE)  # no word is cut
        end = gap.start() if gap else len(joined)
        numbers = _characters()[np.frombuffer(joined[at:end].encode("utf-32-le", "surrogatepass"), "<u4")]
        inside = numbers != 0
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        if len(edges):
            lengths = edges[1::2] - edges[::2]
            first = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
            sums = np.add.reduceat(numbers[inside] * _places(1 << int(lengths.max()).bit_length())[place], first)
            hashes.append((splitmix(sums) >> np.uint64(1)).astype(np.int64) | 1)
            starts.append(edges[::2] + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begins)


def words_of(text: str | None) -> np.ndarray:
    """The words of a text in lower case, without punctuation, as 64-bit hashes."""
    return words_of_all([text])[0]


def allowed_edits(n_words, similarity: float = SIMILARITY):
    """Edits that leave the share `similarity` of an item's words."""
    return np.floor(np.asarray(n_words) * (1 - similarity) + 1e-9).astype(np.int64)


def _limit_pair(n: int, edits: int, kind: str, even: bool, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two strings of n words within so many edits, evenly spread or at random places. What insertions push out of the second one,
    or deletions leave open at its end, takes edits too."""
    n_places = edits if kind in ("change", "alternate") else edits // 2
    spread = ((np.arange(n_places) + rng.random()) * n / max(n_places, 1)).astype(np.int64)
    edited = np.zeros(n, bool)
    edited[spread if even else rng.choice(n, n_places, replace=False)] = True
    nth = np.cumsum(edited)
    inserts = edited & ((kind == "insert") | ((kind == "alternate") & (nth % 2 == 0)))
    deletes = edited & ((kind == "delete") | ((kind == "alternate") & (nth % 2 == 1)))
    own = np.where(edited & (kind == "change"), n + np.arange(n), np.arange(n))
    other = np.insert(own, np.flatnonzero(inserts), 2 * n + np.flatnonzero(inserts))
    other = other[~np.insert(deletes, np.flatnonzero(inserts), False)]
    return np.arange(n), np.concatenate([other, 3 * n + np.arange(n)])[:n]


def _meeting(n: int, edits: int, kind: str, even: bool) -> np.ndarray:
    """For some pairs of strings of n words with so many edits: the chance that one walk puts both into one bucket."""
    rng = np.random.default_rng(n)
    pairs = [_limit_pair(n, edits, kind, even, rng) for _ in range(MEASURED_PAIRS)]
    one, two = (np.repeat([np.append(p[i], -1) for p in pairs], MEASURED_WALKS, axis=0) for i in (0, 1))
    rows, n_starts = np.arange(len(one)), _starts(n)
    at, other, met = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64), np.zeros(len(one))
    agreed = []  # of the last steps
    for step in range(n_starts + (SAMPLED_STEPS - 1) * STEPS_APART):
        same = one[rows, at] == two[rows, other]
        agreed = [*agreed[-(SAMPLED_STEPS - 1) * STEPS_APART :], same]
        if step >= (SAMPLED_STEPS - 1) * STEPS_APART:
            met += np.logical_and.reduce(agreed[::STEPS_APART])
        moves = rng.integers(0, 2, (2, len(one)))
        at, other = np.minimum(at + moves[0], n), np.minimum(other + np.where(same, moves[0], moves[1]), n)
    return met.reshape(MEASURED_PAIRS, MEASURED_WALKS).mean(axis=1) / n_starts


@lru_cache(maxsize=None)
def _walks_at(n: int, edits: int, target_recall: float) -> int:
    most = 1
    for kind in ("change", "insert", "delete", "alternate"):
        for even in (True, False):
            chance = np.maximum(_meeting(n, edits, kind, even), 1e-6)
            while np.mean((1 - chance) ** most) > 1 - target_recall:
                most += 1
    return most


def repetitions(n: int, target_recall: float = TARGET_RECALL, similarity: float = SIMILARITY) -> int:
    """Walks, with a bucket each, that strings of n words need: a pair with all the edits that are allowed meets with the target recall.

    Measured for the kind of edits that spoils most; a tenth is added for the error of the measurement. Above MEASURED_ONE_BY_ONE
    words a length takes the figure of one up to a quarter longer, as longer strings need more.
    """
    edits = int(allowed_edits(n, similarity))
    if not edits:
        return 1
    size = MEASURED_ONE_BY_ONE
    while size < n:
        size = math.ceil(size / 4) * 5
    if n > MEASURED_ONE_BY_ONE:
        n, edits = size, math.ceil(size * (1 - similarity) - 1e-9)
    return math.ceil(1.1 * _walks_at(n, edits, target_recall))


def _random(*parts, after=np.uint64(0)) -> np.ndarray:
    x = after
    for p in parts:
        with np.errstate(over="ignore"):
            x = splitmix((x + np.uint64(0x9E3779B97F4A7C15)) ^ np.asarray(p).astype(np.uint64))
    return x


def _starts(n: int) -> int:
    """Steps at which the sample of a walk may begin. A walk of n words is mostly at their end after 2n of its 3n steps; samples are
    drawn from those 2n."""
    return max(1, 2 * n - (SAMPLED_STEPS - 1) * STEPS_APART)


def buckets(strings: np.ndarray, n_walks: int) -> np.ndarray:
    """The buckets (strings x walks) of strings of one length, given as rows of word hashes."""
    n_strings, n = strings.shape
    padded = np.concatenate([strings, np.zeros((n_strings, 1), np.int64)], axis=1)  # the end, repeated from there on
    first = (_random(7, np.arange(n_walks)) % np.uint64(_starts(n))).astype(np.int64)
    walks = np.argsort(first, kind="stable")  # walks whose sample ends early come first and stop there
    first = first[walks]
    last = first + (SAMPLED_STEPS - 1) * STEPS_APART
    keys = np.tile(_random(11, walks, n), (n_strings, 1))
    rows, position = np.arange(n_strings)[:, None], np.zeros((n_strings, n_walks), np.int64)
    done = 0
    for step in range(int(last[-1]) + 1):
        left = int(np.searchsorted(last, step))
        position, done = position[:, left - done :], left
        word = padded[rows, position]
        place, rest = np.divmod(step - first[left:], STEPS_APART)
        sampled = np.flatnonzero((place >= 0) & (rest == 0))
        if len(sampled):
            keys[:, left + sampled] = _random(keys[:, left + sampled], place[sampled], word[:, sampled])
        position = np.minimum(position + (_random(walks[left:], step, word) & np.uint64(1)).astype(np.int64), n)
    return (keys >> np.uint64(1)).astype(np.int64)


def edit_distances(a: np.ndarray, lengths: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Of each pair of rows the edit distance of the first `lengths` words in `a` and those in `b`, or most + 1 if it is larger.

    One word of all pairs at a time; a pair leaves when its words are over or no way through it stays within `most`.
    """
    n = b.shape[1]
    places = np.arange(n + 1, dtype=np.int32)
    found = np.where(lengths == 0, min(n, most + 1), most + 1)
    left = np.flatnonzero(lengths > 0)
    a, b, lengths, before = a[left], b[left], lengths[left], np.tile(places, (len(left), 1))
    for i in range(a.shape[1]):
        now = np.empty_like(before)
        now[:, 0] = i + 1
        now[:, 1:] = np.minimum(before[:, 1:] + 1, before[:, :-1] + (b != a[:, i, None]))
        before = np.minimum.accumulate(now - places, axis=1) + places  # insertions
        over = lengths == i + 1
        found[left[over]] = np.minimum(before[over, -1], most + 1)
        stay = ~over & (before.min(axis=1) <= most)
        if not stay.all():
            a, b, lengths, before, left = a[stay], b[stay], lengths[stay], before[stay], left[stay]
        if not len(left):
            break
    return found


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """The edit distance of two word strings, or most + 1 if it is larger."""
    return int(edit_distances(np.asarray(a)[None, :], np.array([len(a)]), np.asarray(b)[None, :], most)[0])


def item_words(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, size, words) of the items that have words."""

    @F.pandas_udf("array<long>")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(t) for t in texts], dtype=object)

    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), split(text).alias("words")).distinct()
    return items.where(F.size("words") > 0).withColumn("size", F.size("words").cast("long"))


def _bits(n_bits: int, keys: np.ndarray) -> np.ndarray:
    return (splitmix(keys.astype(np.uint64)) & np.uint64(n_bits - 1)).astype(np.int64)  # a power of two


def _bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size over the values of a column: FILTER_BITS bits, however many values there are."""
    kind = "at long, byte int"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[_bits(FILTER_BITS, batch[column].to_numpy())] = True
        packed = np.packbits(bits)
        at = np.flatnonzero(packed)
        yield pd.DataFrame({"at": at, "byte": packed[at]})

    rows = keys.select(column).mapInPandas(fold, kind).groupBy("at").agg(F.bit_or("byte").alias("byte")).toPandas()
    packed = np.zeros(FILTER_BITS // 8, np.uint8)
    packed[rows["at"].to_numpy()] = rows["byte"].to_numpy()
    return packed


def _holds(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = _bits(FILTER_BITS, keys)
    return (packed[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1 == 1


def pairs_of(words: np.ndarray) -> np.ndarray:
    """One number per pair of neighbouring words."""
    return _pairs(words[:-1], words[1:])


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (_random(left, right, after=_seed(5)) >> np.uint64(1)).astype(np.int64)


@lru_cache(maxsize=None)
def _seed(*parts: int) -> np.uint64:
    return _random(*parts)


def _of_size(tag: int, size: int, keys: np.ndarray) -> np.ndarray:
    return (_random(keys, after=_seed(tag, size)) >> np.uint64(1)).astype(np.int64)


def known_pairs_of(pair_bits: np.ndarray, words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which pairs of neighbours stand in items; none with a word that stands in no item does."""
    pairs = known[:-1] & known[1:]
    at = np.flatnonzero(pairs)
    pairs[at] = _holds(pair_bits, _pairs(words[at], words[at + 1]))
    return pairs


def narrowed(sized: np.ndarray, words: np.ndarray, found: list[tuple[int, np.ndarray]], edits: list[int]) -> list[np.ndarray]:
    """Of each size's starts those whose windows have no more words and pairs that stand in no item of the size than edits can spoil.

    Many sizes of a text at once: a row for each, over the places that any window covers.
    """
    n, most = len(words), max(size for size, _ in found)
    starts = np.unique(np.concatenate([own for _, own in found]))
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    np.add.at(change, np.minimum(starts + most, n), -1)
    covered = np.flatnonzero(np.cumsum(change[:n]))
    own_words = words[covered]
    own_pairs = _pairs(own_words, words[np.minimum(covered + 1, n - 1)])
    stay: list[np.ndarray] = []
    at_once = max(1, KEYS_AT_ONCE // len(covered))
    for low in range(0, len(found), at_once):
        some = found[low : low + at_once]
        in_words, in_pairs = (_unknown(sized, tag, some, keys) for tag, keys in ((17, own_words), (19, own_pairs)))
        for i, (size, own) in enumerate(some):
            end = np.minimum(own + size, n)
            first, last, behind = np.searchsorted(covered, (own, np.maximum(end - 1, own), end))
            few = in_words[i, behind] - in_words[i, first] + size - (end - own) <= edits[low + i]
            stay.append(own[few & (in_pairs[i, last] - in_pairs[i, first] <= 2 * edits[low + i])])
    return stay


def _unknown(sized: np.ndarray, tag: int, found: list[tuple[int, np.ndarray]], keys: np.ndarray) -> np.ndarray:
    """For each size, how many of the first 0, 1, 2, ... keys stand in no item of the size."""
    seeds = np.array([_seed(tag, size) for size, _ in found], np.uint64)[:, None]
    unknown = ~_holds(sized, (_random(keys, after=seeds) >> np.uint64(1)).astype(np.int64))
    before = np.zeros((len(found), len(keys) + 1), np.int64)
    np.cumsum(unknown, axis=1, out=before[:, 1:])
    return before


def _reachable(unknown: np.ndarray, block: int, most: int, ahead: int) -> np.ndarray:
    """Which starts have a block of so many places, with `most` unknown ones at most, that begins there or up to `ahead` places later."""
    before = np.concatenate(([0], np.cumsum(unknown)))
    good = before[block:] - before[: len(before) - block] <= most
    until = np.concatenate(([0], np.cumsum(good)))
    start = np.arange(len(good))
    return until[np.minimum(start + ahead + 1, len(good))] > until[start]


def promising(known: np.ndarray, known_pairs: np.ndarray, begins: np.ndarray, sizes: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """Which of many texts, one after another, may have windows within reach: all for which `window_starts` has any, and few others."""
    before = np.concatenate(([0], np.cumsum(~known)))
    n, unknown = np.diff(begins), np.diff(before[begins])
    # A text shorter than an item: the words that it lacks take edits too.
    left = np.append(np.maximum.accumulate((edits - sizes)[::-1])[::-1], np.iinfo(np.int64).min // 2)
    found = unknown - n <= left[np.searchsorted(sizes, n, side="right")]
    block = int(sizes[0])
    if len(known) >= block:
        until = np.concatenate(([0], np.cumsum(_near_blocks(known, known_pairs, sizes, edits))))
        last = np.clip(begins[1:] - block + 1, 0, len(until) - 1)
        found |= until[last] > until[np.minimum(begins[:-1], last)]
    return np.flatnonzero(found & (n > 0))


def _near_blocks(known: np.ndarray, known_pairs: np.ndarray, sizes: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """Which starts have blocks of the least size in reach that lack no more than their share of what edits can spoil."""
    block, blocks, ahead = int(sizes[0]), sizes // sizes[0], int(sizes[-1] - sizes[0])
    reach = _reachable(~known, block, int((edits // blocks).max()), ahead)
    return reach & _reachable(~known_pairs, block - 1, int((2 * edits // blocks).max()), ahead)


def window_starts(known: np.ndarray, known_pairs: np.ndarray, sizes: np.ndarray, edits: np.ndarray) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Sizes with the starts of their windows that may be within reach, so many at a time. A text shorter than an item is one window.

    A window holds blocks of the least size side by side, and one of them has no more than its share of what edits can spoil. Starts without such a
    block in reach are passed over for all sizes at once.
    """
    n = len(known)
    words, pairs = (np.concatenate(([0], np.cumsum(~x))) for x in (known, known_pairs))
    longer = sizes[(sizes > n) & (words[-1] + sizes - n <= edits)]
    if len(longer):
        yield [(size, np.zeros(1, np.int64)) for size in longer.tolist()]
    sizes, edits = sizes[sizes <= n], edits[sizes <= n]
    if not len(sizes):
        return
    starts = np.flatnonzero(_near_blocks(known, known_pairs, sizes, edits))
    for low in range(0, len(starts), WINDOWS_AT_ONCE):
        start = starts[low : low + WINDOWS_AT_ONCE]
        end = start[None, :] + sizes[:, None]
        fits = end <= n
        end = np.minimum(end, n)
        fits &= words[end] - words[start] <= edits[:, None]
        fits &= pairs[np.maximum(end - 1, start)] - pairs[start] <= 2 * edits[:, None]
        if len(fitting := np.flatnonzero(fits.any(axis=1))):
            yield [(int(sizes[i]), start[fits[i]]) for i in fitting]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    target_recall: float = TARGET_RECALL,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start, distance): the items that documents contain, each with the nearest of its windows, the first
    of equals; `start` counts words.

    A document contains an item of n words if n words of it in a row, or the whole of a shorter one, are within floor((1 -
    similarity) * n) word edits of the item. Words are runs of letters, digits and _ in lower case. Null and
    empty texts contain nothing, and null and empty items are contained nowhere. Repeated rows of an id give one row; rows
    with a null doc_id are reported under null. Other columns are not read; empty tables give an empty result.

    Windows go through a bitmap of the items' buckets, whose size is fixed, and join the items by bucket; no item
    is sent to all tasks.
    """
    # Equal items are one until the end, however many ids they have.
    ids = materialize(item_words(benchmark, item_id, item_text), "items")
    texts = ids.groupBy("words").agg(F.first("size").alias("size")).withColumn("item", F.monotonically_increasing_id())
    items = materialize(texts, "item-texts")
    members = ids.join(items.select("words", "item"), "words").select("item", "item_id")
    sizes = np.array(sorted(r[0] for r in items.select("size").distinct().collect()), np.int64)  # lengths of items
    nothing = "doc_id long, item_id long, start long, distance long"
    if not len(sizes):
        return docs.sparkSession.createDataFrame([], nothing)
    edits = allowed_edits(sizes, similarity)
    edits_of = dict(zip(sizes.tolist(), edits.tolist()))
    n_walks = {n: repetitions(n, target_recall, similarity) for n in sizes.tolist()}

    def item_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, same in batch.groupby("size"):
                found = buckets(np.stack(same["words"]), n_walks[size])
                owners = np.repeat(same["item"].to_numpy(), n_walks[size])
                yield pd.DataFrame({"item": owners, "bucket": found.ravel()})

    in_buckets = materialize(items.select("item", "size", "words").mapInPandas(item_buckets, "item long, bucket long"), "buckets")

    @F.pandas_udf("array<long>")
    def neighbours(words: pd.Series) -> pd.Series:
        return pd.Series([pairs_of(np.asarray(w)) for w in words], dtype=object)

    @F.pandas_udf("array<long>")
    def sized_keys(words: pd.Series) -> pd.Series:
        own = [np.asarray(w) for w in words]
        return pd.Series([np.concatenate([_of_size(17, len(w), w), _of_size(19, len(w), pairs_of(w))]) for w in own], dtype=object)

    vocabulary = _bitmap(items.select(F.explode("words").alias("key")), "key")
    pair_bits = _bitmap(items.select(F.explode(neighbours("words")).alias("key")), "key")
    bucket_bits = _bitmap(in_buckets, "bucket")
    sized = _bitmap(items.select(F.explode(sized_keys("words")).alias("key")), "key")

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: dict[int, np.ndarray] = {}  # buckets that items have too, by window

        def embed(size: int, found: list[tuple]) -> pd.DataFrame:
            windows = np.concatenate([x for _, _, x in found])
            keys = _window_keys(windows)
            distinct, first = np.unique(keys, return_index=True)
            new = np.array([k not in met for k in distinct.tolist()], bool)
            if new.any():
                own = buckets(windows[first[new]], n_walks[size])
                shared = _holds(bucket_bits, own.ravel()).reshape(own.shape)
                met.update({k: b[s] for k, b, s in zip(distinct[new].tolist(), own, shared)})
            lists = [met[k] for k in keys.tolist()]
            hit = np.fromiter((len(x) > 0 for x in lists), bool, len(lists))
            owners = np.repeat(np.array([-1 if pd.isna(k) else k for k, _, _ in found], np.int64), [len(x) for _, x, _ in found])
            missing = np.repeat([pd.isna(k) for k, _, _ in found], [len(x) for _, x, _ in found])
            frame = pd.DataFrame({"start": np.concatenate([x for _, x, _ in found])[hit], "size": size, "window": keys[hit]})
            frame["doc_id"] = pd.arrays.IntegerArray(owners[hit], missing[hit])
            # What a window holds goes out with its first occurrence in the task only.
            words_out, buckets_out = (np.full(len(keys), None, object) for _ in range(2))
            for at in first[new].tolist():
                words_out[at], buckets_out[at] = windows[at], lists[at]
            frame["words"], frame["buckets"] = words_out[hit], buckets_out[hit]
            if len(met) > WINDOWS_HELD:
                met.clear()
            frame = frame.astype({"words": object, "buckets": object})  # also without rows
            return frame[["doc_id", "start", "size", "window", "words", "buckets"]]

        waiting: dict[int, list[tuple]] = {}
        for batch in batches:
            for key, words, known, known_pairs in _looked_at(batch, vocabulary, pair_bits, sizes, edits):
                for found in window_starts(known, known_pairs, sizes, edits):
                    most = [edits_of[size] for size, _ in found]
                    for (size, _), starts in zip(found, narrowed(sized, words, found, most)):
                        at_once = max(1, min(WINDOWS_AT_ONCE, WORDS_AT_ONCE // size))
                        for at in range(0, len(starts), at_once):
                            some = starts[at : at + at_once]
                            places = some[:, None] + np.arange(size)[None, :]
                            windows = np.where(places < len(words), words[np.minimum(places, len(words) - 1)], 0)
                            waiting.setdefault(size, []).append((key, some, windows))
                            if sum(len(x) for _, x, _ in waiting[size]) >= at_once:
                                yield embed(size, waiting.pop(size))
            if sum(x.size for same in waiting.values() for _, _, x in same) > WORDS_AT_ONCE:
                for size in list(waiting):
                    yield embed(size, waiting.pop(size))
        for size in list(waiting):
            yield embed(size, waiting.pop(size))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    occurring = materialize(rows.mapInPandas(hits, _HIT), "windows")
    windows = occurring.where(F.col("words").isNotNull())
    windows = materialize(windows.groupBy("window").agg(*[F.first(c).alias(c) for c in ("size", "words", "buckets")]), "windows")
    candidates = (
        windows.select("window", F.explode("buckets").alias("bucket")).join(in_buckets, "bucket").select("window", "item").distinct()
    )

    @F.pandas_udf("long")
    def distance(windows: pd.Series, words: pd.Series) -> pd.Series:
        found = np.zeros(len(words), np.int64)
        shapes = pd.DataFrame({"window": windows.map(len), "item": words.map(len)}).reset_index(drop=True)
        for (_, n), pairs in shapes.groupby(["window", "item"]):
            at_once = max(1, WORDS_AT_ONCE // n)
            for at in range(0, len(pairs), at_once):
                rows = pairs.index[at : at + at_once]
                own = np.stack(windows.iloc[rows].to_list())
                lengths = (own != 0).sum(axis=1)  # no word has the hash 0, with which short texts are filled up
                found[rows] = edit_distances(own, lengths, np.stack(words.iloc[rows].to_list()), int(allowed_edits(n, similarity)))
        return pd.Series(found)

    verified = (
        candidates.join(windows.drop("buckets"), "window")
        .join(items.select("item", F.col("words").alias("item_words")), "item")
        .withColumn("distance", distance("words", "item_words"))
        .where(F.col("distance") <= F.floor(F.size("item_words") * (1 - similarity) + 1e-9))
        .select("window", "item", "distance")
    )
    best = F.min(F.struct("distance", "start")).alias("best")
    near = occurring.select("doc_id", "start", "window").join(verified, "window").groupBy("doc_id", "item").agg(best)
    # An id may have several texts.
    named = near.join(members, "item").groupBy("doc_id", "item_id").agg(F.min("best").alias("best"))
    return named.select("doc_id", "item_id", "best.start", "best.distance")


def _looked_at(batch: pd.DataFrame, vocabulary: np.ndarray, pair_bits: np.ndarray, sizes: np.ndarray, edits: np.ndarray) -> Iterator[tuple]:
    """Of the texts that may have windows within reach: doc_id, words, which words and which pairs of neighbours stand in items.

    Texts are looked at many at a time; a pair of words of two texts may let a text through, but is no pair of either.
    """
    texts = batch["text"].tolist()
    group = np.cumsum([len(t or "") for t in texts]) // CHARACTERS_AT_ONCE
    for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1):
        words, begins = words_of_all([texts[i] for i in rows])
        known = _holds(vocabulary, words)
        known_pairs = known_pairs_of(pair_bits, words, known)
        for i in promising(known, known_pairs, begins, sizes, edits):
            first, end = begins[i], begins[i + 1]
            yield batch["doc_id"].iat[rows[i]], words[first:end], known[first:end], known_pairs[first : end - 1]


def _window_keys(windows: np.ndarray) -> np.ndarray:
    keys = _random(13, np.full(len(windows), windows.shape[1]))
    for column in windows.T:
        keys = _random(keys, column)
    return keys.view(np.int64)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **parameters) -> DataFrame:
    """The documents that contain no item; the columns stay as they are.

    Whether a document goes depends on its text alone, so rows are told apart by a 64-bit hash of the text: null and repeated ids
    do not matter, and rows without a text stay.
    """
    key = F.when(docs[text].isNotNull(), F.xxhash64(docs[text].cast("string")))
    keyed = docs.select(key.alias("_key"), docs[text].alias("_text")).where(F.col("_key").isNotNull())
    parameters = parameters | {"doc_id": "_key", "text": "_text"}
    found = contaminated(keyed, benchmark, **parameters).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, key == found["_found"], "left_anti")
