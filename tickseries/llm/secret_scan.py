"""Secret scan: three fixed patterns, and sliding-window entropy over candidate strings.

The patterns give the base spans. Beside them, every run of characters that a key could be made of is a candidate. A window
moves over it; the counts of its characters change by one in and one out per step, and with them the sum of c log c, from
which the window's Shannon entropy follows. Windows of high entropy for their character class are joined into spans. An
allow-list takes back what is known to look random and is none: numbers, identifiers, paths, dates, repetitions, words. What
base spans cover, and the pieces that look like a date, an identifier or an example, are cut out of a candidate; what is left of
it is looked at on its own, so a key beside them is found. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from tickseries.llm.common import clear_names

# The base patterns and the least length of what they must hold.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run of 16 or more, as [0-9a-f]+ that is then measured
KINDS = ("assign", "access", "hex")

LEAST_CANDIDATE = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CANDIDATE)
MARKS = "-_=+/"
ENTROPY = "entropy"


@dataclass(frozen=True)
class CharacterClass:
    """Which candidates belong to it, how long its window is, and from what entropy (bits a character) on it is suspect."""

    name: str
    pattern: re.Pattern
    window: int
    least_bits: float


#: The first class whose pattern fits a candidate decides.
CLASSES = (
    CharacterClass("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 20, 3.0),
    CharacterClass("base32", re.compile(r"[A-Z2-7]+=*"), 20, 3.6),
    CharacterClass("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.9),
)

#: Pieces that are cut out of a candidate.
CUTS = (
    re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"),  # a UUID
    re.compile(r"(?<![0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])(T[0-9]{2}([0-9]{2}){0,2}Z?(?![A-Za-z0-9]))?"),  # a date
    re.compile(r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"),  # fixed value: a key that manuals show
)
#: A segment of a candidate that holds one of these words is cut out as well.
SEGMENT = re.compile(r"[A-Za-z0-9+_-]+")
SAMPLE = re.compile(r"EXAMPLE|example|placeholder|your[_-]?(key|token)")

#: A piece that one of these fits as a whole, marks at its ends left out, is no secret.
ALLOWED = (
    re.compile(r"[0-9]+"),  # a number, however long
    re.compile(r"[A-Za-z]+"),  # letters only: a word, however long
    re.compile(r"(?=[A-Za-z]*?[a-z]{3})[A-Za-z]++([/_=+-]++[A-Za-z]*+)*+"),  # words joined by marks
    re.compile(r"(.{1,8}?)\1+.{0,8}"),  # a short piece over and over
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start and then kind: leftmost matches that do not overlap within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def window_entropies(string: str, window: int) -> list[float]:
    """Shannon entropy, in bits a character, of each window of the string, by incremental counts."""
    window = min(window, len(string))
    if not window:
        return []
    c_log_c = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    counts: dict[str, int] = {}
    total, found = 0.0, []
    for at, into in enumerate(string):
        if at >= window:
            c = counts[out := string[at - window]]
            counts[out] = c - 1
            total += c_log_c[c - 1] - c_log_c[c]
        c = counts.get(into, 0)
        counts[into] = c + 1
        total += c_log_c[c + 1] - c_log_c[c]
        if at >= window - 1:
            found.append(math.log2(window) - total / window)
    return found


def pieces(text: str, hidden=(), cuts=CUTS) -> Iterator[tuple[int, str]]:
    """What is left of the candidates without `hidden` (disjoint (start, end), ascending), what the cuts match and sample segments: (start, piece)."""
    first = 0
    for match in CANDIDATE.finditer(text):
        start, end, run = match.start(), match.end(), match[0]
        while first < len(hidden) and hidden[first][1] <= start:
            first += 1
        out, at = [], first
        while at < len(hidden) and hidden[at][0] < end:
            out.append(hidden[at])
            at += 1
        out += [(start + m.start(), start + m.end()) for p in cuts for m in p.finditer(run)]
        if SAMPLE.search(run):
            out += [(start + m.start(), start + m.end()) for m in SEGMENT.finditer(run) if SAMPLE.search(m[0])]
        for a, b in [*sorted(out), (end, end)]:
            if a - start >= LEAST_CANDIDATE:
                yield start, text[start:a]
            start = max(start, b)


def entropy_spans(text: str, classes=CLASSES, allowed=ALLOWED, hidden=()) -> list[tuple[int, int]]:
    """Joined suspect windows of the pieces of the candidates that no allow-list pattern fits."""
    spans: list[tuple[int, int]] = []
    for begin, run in pieces(text, hidden):
        bare = run.strip(MARKS)
        if not bare or bare.isalpha() or any(p.fullmatch(bare) for p in allowed):
            continue
        kind = next(c for c in classes if c.pattern.fullmatch(run) or c is classes[-1])
        start = None
        values = window_entropies(run, kind.window)
        for at, bits in enumerate([*values, -1.0]):
            if bits >= kind.least_bits and start is None:
                start, last = at, at
            elif bits >= kind.least_bits:
                last = at
            elif start is not None and (at - last > kind.window or at == len(values)):
                spans.append((begin + start, begin + last + min(kind.window, len(run))))
                start = None
    return spans


def scan(text: str | None) -> dict:
    """All spans of one text. Suspect spans lie beside base spans, never over them."""
    text = text or ""
    base = base_spans(text)
    names = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
    hidden: list[tuple[int, int]] = []
    for a, _, b in base:
        if hidden and a <= hidden[-1][1]:
            hidden[-1] = hidden[-1][0], max(hidden[-1][1], b)
        else:
            hidden.append((a, b))
    added = [(a, len(KINDS), b) for a, b in entropy_spans(text, hidden=hidden)]
    merged = sorted([*base, *added])
    return {
        **{f"n_{kind}": sum(k == i for _, k, _ in base) for i, kind in enumerate(KINDS)},
        "n_entropy": len(added),
        "base_sha256": hashlib.sha256(",".join(names).encode()).hexdigest(),
        "spans": ",".join(f"{(*KINDS, ENTROPY)[k]}:{a}:{b}" for a, k, b in merged),
    }


_ADDED = "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their secrets: counts of the base spans by kind, of the added ones, and all spans as kind:start:end.

    Positions count code points, ends are exclusive, spans are ordered by start and then kind. A null or empty
    text has no spans. Every row is scanned for itself, in full; repeated rows and ids come back as given. Columns that already have
    the name of a new one are replaced. One pass, no shuffle.
    """
    added = [x.split()[0] for x in _ADDED.split(", ")]
    docs = clear_names(docs, added)

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([scan(t) for t in batch[text]], columns=added, index=batch.index)
            yield pd.concat([batch, found], axis=1)

    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in docs.dtypes), _ADDED])
    return docs.mapInPandas(scanned, schema)


def secret_digest(docs: DataFrame) -> DataFrame:
    return scan_secrets(docs.select("doc_id", "text")).drop("text")
