"""Operator 11: spelling variants grouped through a bit-sliced position index.

A block of words is indexed by (position, letter): each entry is a bitset over the block's words. One pass over the letters
of a query word follows, for all words of the block at once, those without an error so far, those with one
replaced letter (positions aligned) and those with one more letter (positions shifted by one).

Two words within one edit share the first or the last half of the shorter one, so blocks are the words with an equal half, by
the length of the shorter word. That loses no pair. Large blocks are dealt into tiles and compared tile by tile.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import materialize, tile_pairs

# A word is a longest run of these letters.
RUN = "[A-Za-zÀ-ÿ]"
LEAST_LETTERS = 5
LEAST_COUNT = 3
# A form is at least this many times as frequent as its variant.
TIMES = 2
WORDS_PER_TILE = 2048
# Different words that a task counts before it passes them on.
WORDS_IN_TASK = 250_000
# One in so many (document, word) pairs loses a letter, where a caller asks for that.
SPOIL_DIVISOR = 97

_ROWS_OUT = 50_000
_FOUND = "word string, n_near long, near_n long, near string"


def count_words(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
    spoil_divisor: int | None = None,
) -> DataFrame:
    """(word, n): the words of whole texts that occur often enough, A-Z lower-cased, other letters as they are.

    With `spoil_divisor`, of the words of a document those whose crc32 of `<key>:<word>` it divides lose the letter at crc32 modulo
    length: spelling errors by rule. Null texts have no words, a null key is written as empty text, repeated rows count
    again. Tasks count before the shuffle, so a word that fills a third of all texts is a few rows a task.
    """
    longest_runs = re.compile(f"{RUN}{{{least_letters},}}")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for name, whole in zip(batch["k"], batch["text"]):
                start = zlib.crc32(f"{name}:".encode())
                # Lower-casing bytes changes A-Z only.
                for word, n in Counter(longest_runs.findall(whole.encode().lower().decode())).items():
                    if spoil_divisor is not None:
                        h = zlib.crc32(word.encode(), start)
                        if h % spoil_divisor == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    counts[word] += n
                if len(counts) >= WORDS_IN_TASK:
                    yield pd.DataFrame(counts.items(), columns=["word", "n"])
                    counts.clear()
        yield pd.DataFrame(counts.items(), columns=["word", "n"]).astype({"n": "int64"})

    texts = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("text"))
    counted = texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_letters))


def _blocks(words: DataFrame, least_letters: int) -> DataFrame:
    """The words by the half that they can share with a near word: (short, side, half, word, n), short being the length of the
    shorter word of a pair. A word meets words of its own length and longer ones as the shorter, shorter ones as the longer."""
    size = F.length("word")
    lengths = F.filter(F.array(size, size - 1), lambda s: s >= least_letters)
    by_length = words.select("word", "n", F.explode(lengths).alias("short"))
    k = F.floor(F.col("short") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").substr(F.lit(1), k).alias("half")),
        F.struct(F.lit(1).alias("side"), F.col("word").substr(F.length("word") - k + 1, k).alias("half")),
    )
    return by_length.select("short", "word", "n", F.inline(sides))


class PositionIndex:
    """Bitsets over a list of words by (position, letter), and the words of the shorter and of the longer length."""

    def __init__(self, words: list[str], short: int):
        self.all = (1 << len(words)) - 1
        self.short = 0
        self.at: dict[tuple[int, str], int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            if len(word) == short:
                self.short |= bit
            for place in enumerate(word):
                self.at[place] = self.at.get(place, 0) | bit
        self.long = self.all & ~self.short

    def near(self, word: str, half: int = 0) -> tuple[int, int]:
        """The indexed words that are `word`, of the shorter length, with one letter replaced, and with one inserted.

        With `half`, those that begin with the same `half` letters are left out.
        """
        at = self.at
        exact, replaced, longer, same = self.all, 0, 0, 0
        for i, letter in enumerate(word):
            if half and i == half:
                same = exact
            here = at.get((i, letter), 0)
            longer = (longer | exact) & at.get((i + 1, letter), 0)
            replaced = replaced & here | exact & ~here
            exact &= here
        longer |= exact  # the letter after the last one
        return replaced & self.short & ~same, longer & self.long & ~same


def _bits(found: int) -> Iterator[int]:
    while found:
        low = found & -found
        yield low.bit_length() - 1
        found ^= low


class _Nearest:
    """Of each word, how many near words were found and the most frequent of them, ties by code points."""

    def __init__(self, entries: list[tuple[str, int]]):
        self.entries = entries
        self.n = [0] * len(entries)
        self.best: list[tuple[int, str] | None] = [None] * len(entries)

    def add(self, i: int, word: str, n: int) -> None:
        self.n[i] += 1
        if self.best[i] is None or (-n, word) < self.best[i]:
            self.best[i] = (-n, word)

    def rows(self) -> Iterator[tuple]:
        for (word, _), n, best in zip(self.entries, self.n, self.best):
            if n:
                yield word, n, -best[0], best[1]


def _compare(queries: _Nearest, index: PositionIndex, targets: _Nearest, short: int, half: int) -> None:
    for i, (word, n) in enumerate(queries.entries):
        if len(word) == short:
            replaced, longer = index.near(word, half)
            for j in _bits(replaced):
                queries.add(i, *targets.entries[j])
            for j in _bits(longer):
                queries.add(i, *targets.entries[j])
                targets.add(j, word, n)


def near_words(words: DataFrame, least_letters: int = LEAST_LETTERS, words_per_tile: int = WORDS_PER_TILE) -> DataFrame:
    """(word, n_near, near_n, near) of the words that have near words: how many, and the most frequent one with its count.

    Words are near if they differ by one inserted, deleted or replaced code point. `words` are distinct, of at least
    `least_letters` code points. A task returns one row per word and block, never the pairs.
    """
    place = ["short", "side", "half", "_i", "_j"]
    dealt = tile_pairs(_blocks(words, least_letters), ["short", "side", "half"], "word", words_per_tile)
    # Places arrive one after another, so a task holds two tiles at a time.
    rows = dealt.select(*place, "_tile", "word", "n").repartition(*place).sortWithinPartitions(*place)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flat = (row for batch in batches for row in zip(*(batch[c].tolist() for c in batch.columns)))
        out: list[tuple] = []
        for (short, side, _, i, j), group in groupby(flat, key=lambda row: row[:5]):
            tiles: dict[int, list[tuple[str, int]]] = {i: [], j: []}
            for row in group:
                tiles[row[5]].append(row[6:])
            half = short // 2 if side else 0
            held = {t: _Nearest(entries) for t, entries in tiles.items()}
            index = {t: PositionIndex([word for word, _ in entries], short) for t, entries in tiles.items()}
            for a, b in {(i, j), (j, i)}:
                _compare(held[a], index[b], held[b], short, half)
            out += [row for nearest in held.values() for row in nearest.rows()]
            if len(out) >= _ROWS_OUT:
                yield pd.DataFrame(out, columns=_FOUND.replace(",", "").split()[::2])
                out = []
        if out:
            yield pd.DataFrame(out, columns=_FOUND.replace(",", "").split()[::2])

    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    found = rows.mapInPandas(compare, _FOUND).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.w").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form), where following forms ends. Each round doubles the steps taken, so that a chain of
    forms, whose counts at least double, takes a handful of rounds."""
    reached = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not reached.where("moved").isEmpty():
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(ahead, "root", "left")
        reached = materialize(
            step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots"
        )
    return reached.select("word", "root")


def spelling_groups(words: DataFrame, least_letters: int = LEAST_LETTERS, times: int = TIMES, words_per_tile: int = WORDS_PER_TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct (word, n).

    The form of a word is its most frequent near word (ties: the first in code-point order) if that is at least `times` as
    frequent, else null; the root is where following forms ends, the word itself without a form. A table without words gives an empty result.
    """
    words = materialize(words.select("word", "n"), "words")
    near = near_words(words, least_letters, words_per_tile)
    enough = F.col("near_n") >= times * F.col("n")
    formed = materialize(
        words.join(near, "word", "left").select(
            "word",
            F.when(enough, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()))
    joined = formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return joined.select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", spoil_divisor: int | None = None) -> DataFrame:
    """`spelling_groups` of the words of whole texts; nulls as in `count_words`. Columns besides the text and the key are ignored."""
    return spelling_groups(count_words(docs, text, key, spoil_divisor=spoil_divisor))
