"""Byte-level BPE: encoding by folds of ranked merges over byte arrays, decoding by joining binary pieces.

Higher-order functions encode distinct words: a word is an array of its bytes; a fold takes, as long as there is one, the adjacent
pair of lowest rank (the first of equals) and joins it. The ranks stand in the plan as a literal. Spark looks maps up by
scanning them, so the literal map is laid out as a hash table, an array of pieces and one of their ranks, with two places
for each piece. Bytes are written as Latin-1 characters, one each, so that pieces are keys and array elements without escapes.

A fold takes 64 microseconds a word, and a fifth of a corpus' words are nearly all different. So the folds encode the most frequent
words of all documents, a bounded number, once; documents look those up, and what they have beside them is merged where it
occurs by the same rule. The README has the figures. Only counts of words are shuffled, no documents and no ids. The common
words and their ids lie in the shared folder, where each task reads them; the driver holds none.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import clear_names, file_system, materialize, most_frequent, work_dir

COMMON_WORDS = 1 << 18
FOLD_TASKS = 32
FOLD_BYTES = 128
# Words that a task remembers beside the common ones, and documents that it hands on at a time.
WORDS_HELD = 100_000
ROWS_OUT = 512
NO_RANK = 1 << 30
ALL = 1 << 30

ADDED = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by piece, from a file with a base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(bytes.strip, lines))}


# The rank table as a literal -------------------------------------------------------------------------------------------


def _slots(piece: bytes, size: int) -> tuple[int, int]:
    hashed = np.uint64(xxhash.xxh64_intdigest(piece, 42)).astype(np.int64)
    return zlib.crc32(piece) % size, int(hashed) % size


def rank_table(ranks: dict[bytes, int]) -> tuple[list[str | None], list[int | None]]:
    """A hash table in which every piece stands at one of its two places, moving others to their second where need be."""
    size = 2
    while size < 2.2 * len(ranks):
        size *= 2
    while True:
        table: list[tuple[bytes, str, int] | None] = [None] * size
        for piece, rank in ranks.items():
            text = piece.decode("latin-1")
            item, side = (text.encode(), text, rank), 0
            for _ in range(64):
                at = _slots(item[0], size)[side]
                item, table[at] = table[at], item
                if item is None:
                    break
                first, second = _slots(item[0], size)
                side = 1 if first == at else 0
            if item is not None:
                break
        else:
            return [x and x[1] for x in table], [x and x[2] for x in table]
        size *= 2


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once for all its uses in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _rank(piece: Column, pieces: Column, ranks: Column, size: int) -> Column:
    first = (F.crc32(piece) % size).cast("int")
    second = F.pmod(F.xxhash64(piece), F.lit(size)).cast("int")
    found = F.when(F.get(pieces, first) == piece, F.get(ranks, first))
    return found.when(F.get(pieces, second) == piece, F.get(ranks, second)).otherwise(F.lit(NO_RANK))


def fold_merges(words: Column, table: tuple[list, list]) -> Column:
    """The ids of each word of an array of words. A word is a string with a Latin-1 character per byte."""
    size = len(table[0])
    nothing = F.array().cast("array<string>")

    def encode(word: Column, pieces: Column, ranks: Column) -> Column:
        rank = lambda piece: _rank(piece, pieces, ranks, size)

        def merge(state: Column, at: Column) -> Column:
            """Join the pieces at and at + 1 (from 1); only the pairs beside the new piece get new ranks."""
            parts, pairs = state["parts"], state["pairs"]

            def joined(piece: Column) -> Column:
                before = F.when(at > 1, F.array(F.concat(F.get(parts, at - 2), piece))).otherwise(nothing)
                after = F.when(at < F.size(pairs), F.array(F.concat(piece, F.get(parts, at + 1)))).otherwise(nothing)
                beside = F.transform(F.concat(before, after), rank)
                return F.struct(
                    F.concat(F.slice(parts, F.lit(1), at - 1), F.array(piece), F.slice(parts, at + 2, F.lit(ALL))).alias("parts"),
                    F.concat(F.slice(pairs, F.lit(1), F.greatest(at - 2, F.lit(0))), beside, F.slice(pairs, at + 2, F.lit(ALL))).alias("pairs"),
                )

            return _let(F.concat(F.get(parts, at - 1), F.get(parts, at)), joined)

        def step(state: Column, _: Column) -> Column:
            def lowest(best: Column) -> Column:
                at = F.array_position(state["pairs"], best).cast("int")
                return F.when(best >= NO_RANK, state).otherwise(_let(at, lambda at: merge(state, at)))

            return _let(F.array_min(state["pairs"]), lowest)

        bytes_of = F.split(word, "")
        pairs = F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substring(word, i, 2))
        start = F.struct(bytes_of.alias("parts"), F.transform(pairs, rank).alias("pairs"))
        # A word of n bytes has n - 1 merges at most.
        folded = F.aggregate(F.sequence(F.lit(2), F.length(word)), start, step, lambda state: state["parts"])
        return F.transform(F.when(F.length(word) < 2, F.array(word)).otherwise(folded), rank)

    pieces = F.from_json(F.lit(json.dumps(table[0])), "array<string>")
    ranks = F.from_json(F.lit(json.dumps(table[1])), "array<int>")
    # Bound to variables, the two literals stand in the plan once.
    return _let(pieces, lambda p: _let(ranks, lambda r: F.transform(words, lambda word: encode(word, p, r))))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one very long word, by a heap of pairs in place of a scan for each merge."""
    n = len(word)
    ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    pair = lambda i: ranks.get(word[i : ends[after[i]]]) if after[i] < n else None
    heap = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        j = after[i] if i >= 0 else n
        if ends[i] != middle or j >= n or ends[j] != end:  # a piece has changed since
            continue
        ends[i], after[i] = end, after[j]
        ends[j] = -1
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (rank := pair(k)) is not None:
                heapq.heappush(heap, (rank, k, ends[k], ends[after[k]]))
    found, i = [], 0
    while i < n:
        found.append(ranks[word[i : ends[i]]])
        i = after[i]
    return found


# Words and documents ---------------------------------------------------------------------------------------------------


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The merges of one word, by a scan for each."""
    parts = [word[i : i + 1] for i in range(len(word))]
    rank = ranks.get
    pairs = [rank(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) != NO_RANK:
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
    return [ranks[p] for p in parts]


def _ranges(named: str, last: int) -> str:
    """The code points up to `last` that fit a named class, as ranges of a character class."""
    points = "".join(map(chr, range(last + 1)))
    runs = regex.finditer(f"(?:{named})+", points)
    return "".join(f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in runs)


@cache
def plain_pattern(pattern: str, last: int = 0x10FFFF) -> str:
    """The pattern with \\p{..}, \\s and \\S spelled out as ranges of code points up to `last`, for the matcher of the standard library.

    It looks up to U+FFFF in a table and goes through ranges beyond one by one, so texts within that have a pattern of their own.
    """
    out, inside, at = [], False, 0
    while at < len(pattern):
        if named := regex.match(r"\\p\{\w+\}|\\s|\\S", pattern, pos=at):
            if named[0] == "\\S" and inside:
                raise ValueError("\\S within a class")
            ranges = _ranges(named[0].lower() if named[0] == "\\S" else named[0], last)
            negated = "^" if named[0] == "\\S" else ""
            out.append(ranges if inside else f"[{negated}{ranges}]")
            at = named.end()
        elif pattern[at] == "\\":
            out.append(pattern[at : at + 2])
            at += 2
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return "".join(out)


class Cutter:
    """Cuts texts into words by a pattern with named classes."""

    def __init__(self, plain: tuple[str, str]):
        self.short, self.full = (re.compile(p).findall for p in plain)

    @staticmethod
    def patterns(pattern: str) -> tuple[str, str]:
        return plain_pattern(pattern, 0xFFFF), plain_pattern(pattern)

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        within = len(text.encode("utf-16-le")) == 2 * len(text)
        return (self.short if within else self.full)(text)


@dataclass(frozen=True)
class Vocabulary:
    """A rank file and the pattern that cuts texts into words, each of which is encoded by itself."""

    path: str
    pattern: str

    def ranks(self) -> dict[bytes, int]:
        return read_ranks(self.path)


def fold_common(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", most: int = COMMON_WORDS) -> str:
    """The folder of a table (word, ids) with the most frequent words of all documents and their ids from the folds: at most `most`.

    Words of three or more occurrences are counted over the whole texts of all documents. Which words they are decides where a
    word is encoded and not how. Tasks write the table and tasks read it (`Packed.read`); none of it reaches the driver.
    """
    plain = Cutter.patterns(vocabulary.pattern)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, counts = Cutter(plain), Counter()
        for batch in batches:
            for t in batch[text]:
                counts.update(cutter.words(t))
                if len(counts) > WORDS_HELD:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    counts = docs.select(text).mapInPandas(count, "word string, n long").where(F.octet_length("word") <= FOLD_BYTES)
    counted = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > 2)
    top = most_frequent(materialize(counted, "shared-words"), "n", most)
    latin = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    ids = F.get(fold_merges(F.array(latin), rank_table(vocabulary.ranks())), F.lit(0))
    folder = work_dir(docs.sparkSession, "common-words")
    # No shuffle in the plan that has the rank table: adaptive execution would print the table anew for each of its steps.
    top.coalesce(FOLD_TASKS).select("word", ids.alias("ids")).write.parquet(folder)
    return folder


def common_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", most: int = COMMON_WORDS) -> dict[str, list[int]]:
    """The words of `fold_common` with their ids, for a caller that holds them all."""
    return dict(Packed.read(fold_common(docs, vocabulary, text, most)).items())


class Packed:
    """Words with their ids as one array, which a task can hold beside what it makes of them."""

    def __init__(self, ids: dict[str, list[int]]):
        self.words = list(ids)
        self.ids = np.array([i for own in ids.values() for i in own], np.int32)
        self.ends = np.cumsum([len(own) for own in ids.values()], dtype=np.int64)

    @classmethod
    def read(cls, folder: str) -> Packed:
        """The words of a table (word, ids) in the shared folder, file by file."""
        fs, path = file_system(folder)
        packed = cls({})
        ids, sizes = [packed.ids], [packed.ends]
        for file in sorted(x.path for x in fs.get_file_info(pafs.FileSelector(path)) if x.base_name.endswith(".parquet")):
            with fs.open_input_file(file) as source:
                rows = pq.read_table(source, columns=["word", "ids"], use_threads=False)
            for batch in rows.to_batches():
                packed.words += batch["word"].to_pylist()
                ids.append(batch["ids"].flatten().to_numpy())
                sizes.append(batch["ids"].value_lengths().to_numpy())
        packed.ids, packed.ends = np.concatenate(ids), np.cumsum(np.concatenate(sizes), dtype=np.int64)
        return packed

    def items(self) -> Iterator[tuple[str, list[int]]]:
        at = 0
        for word, end in zip(self.words, self.ends.tolist()):
            yield word, self.ids[at:end].tolist()
            at = end


class Encoder:
    """Ids and text of words in one task. It remembers the words that it has met, and forgets them all when they are many."""

    def __init__(self, vocabulary: Vocabulary, plain: tuple[str, str], common: Packed):
        self.ranks = vocabulary.ranks()
        self.pieces = {rank: piece for piece, rank in self.ranks.items()}
        self.words = Cutter(plain).words
        self.common = {w: self._show(ids) for w, ids in common.items()}
        self.met = dict(self.common)

    def _show(self, ids: list[int]) -> tuple[str, bytes, int]:
        """The ids as text, the bytes they decode to and their number."""
        return ",".join(map(str, ids)), b"".join([self.pieces[i] for i in ids]), len(ids)

    def _encode(self, word: str) -> tuple[str, bytes, int]:
        raw = word.encode()
        if raw in self.ranks:
            ids = [self.ranks[raw]]
        else:
            ids = (merge_short if len(raw) <= FOLD_BYTES else merge_long)(raw, self.ranks)
        return self._show(ids)

    def document(self, text: str | None) -> tuple[str, bytes, int]:
        words, met = self.words(text), self.met
        for word in set(words).difference(met):
            met[word] = self._encode(word)
        shown = [met[w] for w in words]
        if len(met) > len(self.common) + WORDS_HELD:
            self.met = dict(self.common)
        return ",".join([x[0] for x in shown]), b"".join([x[1] for x in shown]), sum([x[2] for x in shown])


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", contents: bool = True, decoded: bool = True
) -> DataFrame:
    """The rows with the ids of their whole texts and the bytes that the ids decode to.

    Adds n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded bytes) and, unless `contents` is
    false, ids and, unless `decoded` is, decoded. A null or empty text has no ids. Repeated rows come back as given; columns that already
    have the name of a new one are replaced. Words over FOLD_BYTES bytes are merged by a heap, with the same result. A byte
    that has no rank is an error.
    """
    added = ADDED if contents and decoded else ADDED.partition(", decoded binary")[0] if contents else ADDED.partition(", ids array")[0]
    docs = clear_names(docs, [x.split()[0] for x in added.split(", ")])
    plain, common = Cutter.patterns(vocabulary.pattern), fold_common(docs, vocabulary, text)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary, plain, Packed.read(common))
        for batch in batches:
            for at in range(0, len(batch), ROWS_OUT):
                yield some(encoder, batch.iloc[at : at + ROWS_OUT])

    def some(encoder: Encoder, rows: pd.DataFrame) -> pd.DataFrame:
        n_tokens, ids_sha, decoded_sha, ids, texts = [], [], [], [], []
        for t in rows[text]:
            shown, whole, n = encoder.document(t)
            n_tokens.append(n)
            ids_sha.append(hashlib.sha256(shown.encode()).hexdigest())
            decoded_sha.append(hashlib.sha256(whole).hexdigest())
            if contents:
                ids.append(np.array(shown.split(","), np.int32) if n else np.zeros(0, np.int32))
                if decoded:
                    texts.append(whole)
        found = rows.assign(n_tokens=n_tokens, ids_sha256=ids_sha, decoded_sha256=decoded_sha)
        found = found.assign(ids=ids) if contents else found
        return found.assign(decoded=texts) if contents and decoded else found

    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in docs.dtypes), added])
    return docs.mapInPandas(encoded, schema)
