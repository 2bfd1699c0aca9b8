"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams of a language, most frequent first. A document's own list, made from its
whole text, is compared with each profile by the out-of-place distance: the sum, over the document's n-grams, of how far
their places lie apart, where an n-gram that a profile lacks counts as the largest distance. The nearest profile wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickseries.llm.common import clear_names

MAX_GRAM = 3
PROFILE_GRAMS = 400
TRAINING_DOCUMENTS = 20_000
LETTERS_AT_ONCE = 1 << 20
UNDETERMINED = "und"

_BITS = 21  # a code point


@cache
def _letters() -> np.ndarray:
    """For every code point: itself if it is a letter, else 0."""
    points = np.arange(0x110000, dtype=np.int64)
    known = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    return np.where(known, points, 0)


def _codes(text: str) -> np.ndarray:
    """The letters of the text in lower case, all else as 0, with one 0 before and after."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return np.concatenate(([0], _letters()[points], [0]))


def _grams(codes: np.ndarray) -> np.ndarray:
    """The n-grams of 1 to MAX_GRAM places as numbers. A word's ends are places too; all n-grams have a letter, and none
    reaches beyond the end of a word."""
    found = [codes[codes > 0]]
    two = (codes[:-1] << _BITS) | codes[1:]
    found.append(two[(codes[:-1] > 0) | (codes[1:] > 0)])
    # The middle of three is a letter.
    found.append(((codes[:-2] << (2 * _BITS)) | (codes[1:-1] << _BITS) | codes[2:])[codes[1:-1] > 0])
    return np.concatenate(found)


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the whole text and how often each occurs. Long texts are counted in pieces that overlap."""
    codes = _codes(text)
    if len(codes) <= LETTERS_AT_ONCE:
        return np.unique(_grams(codes), return_counts=True)
    grams, counts = [], []
    # Pieces end at a place that is no letter, where no n-gram of three with a letter in the middle is cut.
    gaps = np.flatnonzero(codes == 0)
    start = 0
    while start < len(codes) - 1:
        at = np.searchsorted(gaps, start + LETTERS_AT_ONCE, side="right") - 1
        end = int(gaps[at]) if gaps[at] > start else int(gaps[min(at + 1, len(gaps) - 1)])
        g, n = np.unique(_grams(codes[start : end + 1]), return_counts=True)
        grams.append(g)
        counts.append(n)
        start = end
    return _add_up(np.concatenate(grams), np.concatenate(counts))


def _add_up(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(grams, return_inverse=True)
    return distinct, np.bincount(where, weights=counts).astype(np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE_GRAMS) -> np.ndarray:
    """The most frequent n-grams, ties by their number."""
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))][:size]


def learn_profiles(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    size: int = PROFILE_GRAMS,
    training_documents: int = TRAINING_DOCUMENTS,
) -> dict[str, list[int]]:
    """Profiles by language, from the rows that have a text and a language.

    A language with more than `training_documents` rows learns from about that many of them, which a hash of the
    text picks; the others from all their rows. What comes to the driver are `size` numbers per language.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    shares = [
        (r["lang"], min(1.0, training_documents / r["count"])) for r in rows.groupBy("lang").count().collect()
    ]  # one row per language
    if not shares:
        return {}
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    share = F.element_at(F.create_map(*[F.lit(x) for pair in shares for x in pair]), F.col("lang"))
    picked = rows.where(spread < share) if any(s < 1 for _, s in shares) else rows

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, texts in batch.groupby("lang")["text"]:
                for at in range(0, len(texts), 256):  # words never meet across the join
                    grams, counts = count_grams("\n".join(texts.iloc[at : at + 256]))
                    yield pd.DataFrame({"lang": language, "gram": grams, "n": counts})

    counted = picked.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Classifier:
    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_GRAMS):
        self.size = size
        self.languages = sorted(profiles)
        self.known = np.unique(np.concatenate([np.array(profiles[x], np.int64) for x in self.languages])) if profiles else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.known) + 1, len(self.languages)), size, np.int64)  # the last row: in no profile
        for column, language in enumerate(self.languages):
            own = np.array(profiles[language], np.int64)
            self.ranks[np.searchsorted(self.known, own), column] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and a score from 0 to 1: one minus its distance as a share of the largest possible.
        No letters, or nothing learned: `und` and 0."""
        if not text or not self.languages:
            return UNDETERMINED, 0.0
        own = ranked(*count_grams(text), self.size)
        if not len(own):
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.known, own)
        at[(at == len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != own)] = len(self.known)
        ranks = self.ranks[at]
        places = np.arange(len(own))[:, None]
        apart = np.where(ranks == self.size, self.size, np.abs(ranks - places)).sum(axis=0)
        best = int(np.argmin(apart))  # ties: the first by name
        return self.languages[best], float(1 - apart[best] / (len(own) * self.size))


def identify(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    text: str = "text",
    size: int = PROFILE_GRAMS,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The rows with `lang_pred` and `score`, or other `names`, from their whole texts alone. One pass, no shuffle.

    `und` and 0 if the text is null or has no letters, or no language was learned. Repeated rows come back as given; columns
    that already have these names are replaced.
    """
    docs = clear_names(docs, names)

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classifier = Classifier(profiles, size)
        for batch in batches:
            found = [classifier.predict(t) for t in batch[text]]
            yield batch.assign(**{names[0]: [x for x, _ in found], names[1]: [s for _, s in found]})

    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in docs.dtypes), f"`{names[0]}` string, `{names[1]}` double"])
    return docs.mapInPandas(predicted, schema)
