"""Language model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER bytes, with the counts of the bytes that follow each context in the training
texts. A byte is predicted from the longest context that was seen. Where the byte did not follow that context, an escape is paid, whose
estimate is the share of the context's distinct followers (method C), and the context without its first byte is asked;
the bytes that the longer context would have predicted are excluded there. Below the empty context all bytes left
are alike. Texts begin after, and end with, a byte that UTF-8 does not have, so probabilities of texts add up to one.

The counts of all training texts meet by gram (context and byte). Grams are dealt into places of about GRAMS_PER_PLACE by the last two
bytes of their context; endings that more than GRAMS_PER_NODE grams have are split by the byte before, down to whole contexts, which have
256 grams at most. A place has all grams of its endings and of longer contexts, so their tries are whole there; what follows the
shorter contexts, that is all bytes and pairs and the endings that were split, is counted beforehand and sent to every task. The
code lengths of grams follow from both. Texts then look the code lengths up: the most frequent grams, a fixed number, are sent to
every task; the others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickseries.llm.common import materialize, most_frequent

ORDER = 5
END = 0xFF  # stands in no UTF-8 text
FREQUENT_GRAMS = 1 << 20
FREQUENT_WORDS = 1 << 18
BYTES_AT_ONCE = 1 << 20
GRAMS_HELD = 1 << 20
GRAMS_PER_NODE = 1 << 16
GRAMS_PER_PLACE = 1 << 18
LEAST_DEPTH = 2

_MASKS = [np.int64((1 << (8 * k)) - 1) for k in range(ORDER + 2)]


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts one after another, each a number of ORDER + 1 bytes, and how many each text has."""
    pad = bytes([END]) * ORDER
    joined = np.frombuffer(b"".join(x for t in texts for x in (pad, t, pad[:1])), np.uint8).astype(np.int64)
    codes = joined.copy()
    for k in range(1, ORDER + 1):
        codes[k:] |= joined[:-k] << np.int64(8 * k)
    counts = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.cumsum(counts + ORDER) - counts
    at = np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return codes[at], counts


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Places of texts whose bytes fit into memory together; a longer text stands alone."""
    group, size = [], 0
    for i, t in enumerate(texts):
        if group and size + len(t) > BYTES_AT_ONCE:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(t) + ORDER + 1
    if group:
        yield group


def count_grams(docs: DataFrame) -> DataFrame:
    """(code, n, seen): how often each gram stands in training texts, and in all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # codes, counts in training texts, counts in all: added up in the task as they become many
        size = 0
        for batch in batches:
            texts, learns = [(t or "").encode() for t in batch["text"]], batch["learns"].to_numpy()
            for group in _groups(texts):
                for training in (True, False):
                    own = [texts[i] for i in group if learns[i] == training]
                    if own:
                        codes, n = np.unique(gram_codes(own)[0], return_counts=True)
                        held.append(np.stack([codes, n * training, n]))
                        size += len(codes)
                if size > 2 * GRAMS_HELD:
                    held = [_added(held)]
                    size = held[0].shape[1]
                    if size > GRAMS_HELD:
                        yield pd.DataFrame(dict(zip(("code", "n", "seen"), held.pop())))
                        size = 0
        if held:
            yield pd.DataFrame(dict(zip(("code", "n", "seen"), _added(held))))

    counted = docs.select("text", "learns").mapInPandas(count, "code long, n long, seen long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def _added(parts: list[np.ndarray]) -> np.ndarray:
    """Rows of (code, n, seen) with each code once."""
    codes, n, seen = np.concatenate(parts, axis=1)
    order = np.argsort(codes)
    codes, n, seen = codes[order], n[order], seen[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
    return np.stack([codes[first], np.add.reduceat(n, first), np.add.reduceat(seen, first)])


class Lookup:
    """Values by code. Most codes stand in a table at the place that a hash gives; those that another code keeps from theirs are
    searched for."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.codes, self.values = codes, values
        self.bits = max(4, len(codes).bit_length())
        self.held, self.at = np.full(1 << self.bits, -1), np.zeros(1 << self.bits)
        place = self._place(codes)
        self.held[place], self.at[place] = codes, values

    def _place(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each code, 0 for unknown ones, and whether it is known."""
        place = self._place(codes)
        known = self.held[place] == codes
        values = np.where(known, self.at[place], 0.0)
        left = np.flatnonzero(~known)
        at, hit = _find(self.codes, codes[left])
        values[left[hit]], known[left[hit]] = self.values[at[hit]], True
        return values, known


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys stand in a sorted table, and whether they do."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


Followers = list[tuple[np.ndarray, np.ndarray]]  # by order: the grams of some contexts, sorted, and their counts


class Trie:
    """Counts by context for the orders 0 to ORDER, for grams of one place.

    `depths` tells how many bytes of a gram's context it was dealt by. Contexts of that order and above have all their grams here; what
    follows the shorter ones is taken from `split`.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depths: np.ndarray, split: Followers):
        self.grams, self.n, self.contexts, self.total, self.distinct = [], [], [], [], []
        for order in range(ORDER + 1):
            own = (depths <= order) & (counts > 0)
            grams, where = np.unique(codes[own] & _MASKS[order + 1], return_inverse=True)
            n = np.bincount(where, counts[own], len(grams)).astype(np.int64)
            known, known_n = split[order]
            asked = np.unique((codes[depths > order] >> 8) & _MASKS[order])
            low, high = np.searchsorted(known, asked << 8), np.searchsorted(known, (asked + 1) << 8)
            at = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(int((high - low).sum()))
            grams, n = np.concatenate([grams, known[at]]), np.concatenate([n, known_n[at]])
            by_gram = np.argsort(grams)
            grams, n = grams[by_gram], n[by_gram]
            contexts, where = np.unique(grams >> 8, return_inverse=True)
            self.grams.append(grams)
            self.n.append(n)
            self.contexts.append(contexts)
            self.total.append(np.bincount(where, n, len(contexts)) if len(contexts) else np.zeros(0))
            self.distinct.append(np.bincount(where, minlength=len(contexts)).astype(float))
        # By context of order k + 1: what its followers count in the context of order k, from which they are excluded.
        self.excluded = [np.zeros(0)] * (ORDER + 1)
        for order in range(1, ORDER + 1):
            at, _ = _find(self.grams[order - 1], self.grams[order] & _MASKS[order])
            _, where = np.unique(self.grams[order] >> 8, return_inverse=True)
            taken = self.n[order - 1][at] if len(at) else np.zeros(0)
            self.excluded[order] = np.bincount(where, taken, len(self.contexts[order])) if len(taken) else np.zeros(0)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after its context."""
        result, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
        longer = np.full(len(codes), -1)  # the context of the order above, if it was seen
        for order in range(ORDER, -1, -1):
            context, seen = _find(self.contexts[order], (codes & _MASKS[order + 1]) >> 8)
            gram, follows = _find(self.grams[order], codes & _MASKS[order + 1])
            if not len(self.contexts[order]):
                continue
            total, distinct = self.total[order][context], self.distinct[order][context]
            if order < ORDER and len(self.contexts[order + 1]):
                above = longer >= 0
                total = total - np.where(above, self.excluded[order + 1][longer], 0)
                distinct = distinct - np.where(above, self.distinct[order + 1][longer], 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit, escape = np.log10(self.n[order][gram] / (total + distinct)), np.log10(distinct / (total + distinct))
            now = open_ & seen
            result = np.where(now & follows, result + hit, result)
            # With no follower left, the escape is certain.
            result = np.where(now & ~follows & (distinct > 0), result + escape, result)
            open_ &= ~(seen & follows)
            longer = np.where(seen, context, -1)
        left = 256 - len(self.grams[0])
        return np.where(open_, result - np.log10(max(left, 1)), result)


def _ending(order: int):
    """The last bytes of a gram's context."""
    return F.shiftright("code", 8).bitwiseAND(F.lit(int(_MASKS[order])))


def split_endings(grams: DataFrame) -> dict[int, list[int]]:
    """By length: the endings of contexts, from LEAST_DEPTH bytes on, that more than GRAMS_PER_NODE grams have. There is at most one a length
    for every so many grams."""
    split, within = {}, grams
    for order in range(LEAST_DEPTH, ORDER):
        sizes = within.groupBy(_ending(order).alias("ending")).count().where(F.col("count") > GRAMS_PER_NODE)
        split[order] = [r["ending"] for r in sizes.collect()]
        if not split[order]:
            break
        within = within.where(_ending(order).isin(split[order]))
    return split


def dealt(grams: DataFrame, split: dict[int, list[int]]) -> DataFrame:
    """Adds `depth`, the bytes of the context that a gram is dealt by, and `place`."""
    depth, ending = F.lit(LEAST_DEPTH), _ending(LEAST_DEPTH)
    for order in sorted(k for k in split if split[k]):
        inside = _ending(order).isin(split[order])
        depth, ending = F.when(inside, order + 1).otherwise(depth), F.when(inside, _ending(order + 1)).otherwise(ending)
    places = max(1, math.ceil(grams.count() / GRAMS_PER_PLACE))
    return grams.withColumns({"depth": depth.cast("tinyint"), "place": F.pmod(F.xxhash64(depth, ending), F.lit(places))})


def split_followers(grams: DataFrame, split: dict[int, list[int]]) -> Followers:
    """What follows the contexts whose grams lie in several places: the empty one, single bytes and the endings that were split."""
    learned, found = grams.where(F.col("n") > 0), []
    for order in range(ORDER + 1):
        if order < LEAST_DEPTH or split.get(order):
            rows = learned if order < LEAST_DEPTH else learned.where(_ending(order).isin(split[order]))
            gram = F.col("code").bitwiseAND(F.lit(int(_MASKS[order + 1])))
            counted = rows.groupBy(gram.alias("gram")).agg(F.sum("n").alias("n")).toArrow().sort_by("gram")
            found.append((counted["gram"].to_numpy(), counted["n"].to_numpy()))
        else:
            found.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    return found


def code_lengths(grams: DataFrame) -> DataFrame:
    """(code, log10, seen): the code length of every gram, from the rows of `count_grams`."""
    split = split_endings(grams)
    followers = split_followers(grams, split)

    def price(rows: pd.DataFrame) -> pd.DataFrame:
        codes = rows["code"].to_numpy()
        trie = Trie(codes, rows["n"].to_numpy(), rows["depth"].to_numpy(), followers)
        return pd.DataFrame({"code": codes, "log10": trie.log10(codes), "seen": rows["seen"].to_numpy()})

    return dealt(grams, split).groupBy("place").applyInPandas(price, "code long, log10 double, seen long")


def tokens_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z in lower case."""
    return (text or "").encode().lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): how often each word stands in training texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = Counter(w for t in batch["text"] for w in tokens_of(t))
            yield pd.DataFrame({"word": [w.decode() for w in counts], "n": list(counts.values())})

    return docs.where("learns").select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def score(docs: DataFrame, learns, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every whole text by a model learned from the rows for which the column `learns` is true.

    Adds to doc_id: n_tokens (words and one end), n_known (those that training texts have), train_tokens, base_score (log10 under
    word frequencies plus one) and score (log10 under the byte model). A null text counts as empty. Each row is scored
    for itself; rows without an id are kept apart like the others. Nothing learned: words are all unknown and all bytes alike. An empty table gives an
    empty result; columns besides doc_id and text are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    words = materialize(count_words(rows), "word-counts")
    n_docs, n_words, known_words = rows.where("learns").count(), *words.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = (n_words or 0) + n_docs, known_words + (n_docs > 0)  # the end is a token too
    unseen = np.log10(n + v + 1.0)
    frequent = most_frequent(words, "c", FREQUENT_WORDS).toArrow()
    end_log = float(np.log10(n_docs + 1))

    grams = materialize(code_lengths(materialize(count_grams(rows), "grams")), "code-lengths")
    top = most_frequent(grams, "seen", FREQUENT_GRAMS).select("code", "log10").toArrow().sort_by("code")
    codes, lengths = top["code"].to_numpy(), top["log10"].to_numpy()

    kind = "row string, doc_id long, n_tokens long, n_known long, base double, score double, word string, code long, times long"

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyspark

        task, number = pyspark.TaskContext.get().partitionId(), 0
        lookup = Lookup(codes, lengths)
        counted = zip(frequent["word"].to_pylist(), np.log10(frequent["c"].to_numpy() + 1).tolist())
        log_counts = {w.encode(): x for w, x in counted}
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"]]
            ids = batch["doc_id"].tolist()
            for group in _groups(texts):
                own = [texts[i] for i in group]
                names = [f"{task}-{number + i}" for i in range(len(own))]
                number += len(own)
                found, counts = gram_codes(own)
                values, hit = lookup.get(found)
                row = np.repeat(np.arange(len(own)), counts)
                sums = np.bincount(row, values, len(own))
                missing_codes, which = np.unique(found[~hit], return_inverse=True)
                pairs, times = np.unique(row[~hit] * max(len(missing_codes), 1) + which, return_counts=True)
                whose_gram, rare = np.divmod(pairs, max(len(missing_codes), 1))
                n_tokens, known, base, tail = [], [], [], []
                for i, t in enumerate(own):
                    words = t.lower().split()
                    logs = list(map(log_counts.get, words))
                    missing = [w for w, x in zip(words, logs) if x is None]
                    tail += [(i, w.decode(), c) for w, c in Counter(missing).items()]
                    n_tokens.append(len(words) + 1)
                    known.append(len(words) - len(missing) + (n_docs > 0))
                    base.append(sum(x for x in logs if x is not None) + end_log - (len(words) + 1) * unseen)
                owners = pd.array([None if pd.isna(ids[i]) else int(ids[i]) for i in group], "Int64")
                nothing = {"word": None, "code": None, "times": None}
                yield _columns(kind, row=names, doc_id=owners, n_tokens=n_tokens, n_known=known, base=base, score=sums, **nothing)
                if len(tail):
                    whose, word, c = zip(*tail)
                    yield _columns(kind, row=[names[i] for i in whose], doc_id=owners[list(whose)], word=word, times=c)
                if len(rare):
                    whose = whose_gram.tolist()
                    yield _columns(kind, row=[names[i] for i in whose], doc_id=owners[whose], code=missing_codes[rare], times=times)

    parts = materialize(rows.select("doc_id", "text").mapInPandas(scored, kind), "scores")
    sums = ["row", "doc_id", "n_tokens", "n_known", "base", "score"]
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    whole = parts.where(F.col("n_tokens").isNotNull()).select(*sums)
    by_word = parts.where(F.col("word").isNotNull()).join(words, "word").select(
        "row", "doc_id", zero.alias("n_tokens"), F.col("times").alias("n_known"), (F.col("times") * F.log10(F.col("c") + 1)).alias("base"), none.alias("score")
    )
    by_gram = parts.where(F.col("code").isNotNull()).join(grams, "code").select(
        "row", "doc_id", zero.alias("n_tokens"), zero.alias("n_known"), none.alias("base"), (F.col("times") * F.col("log10")).alias("score")
    )
    added = whole.unionByName(by_word).unionByName(by_gram).groupBy("row", "doc_id")
    return added.agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("row")


def _columns(kind: str, **columns) -> pd.DataFrame:
    names = [x.split()[0] for x in kind.split(", ")]
    frame = pd.DataFrame(columns, columns=names)
    integers = {x: "Int64" for x in ("doc_id", "n_tokens", "n_known", "code", "times")}
    return frame.astype(integers | {"base": float, "score": float})
