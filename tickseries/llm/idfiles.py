"""Token ids as binary files: one zstandard frame per document with a dictionary that all share, and an offset index.

A folder holds `dictionary`, `part-NNNNNN.ids` and `part-NNNNNN.idx`. An .ids file is the magic, the first eight bytes of the
dictionary's SHA-256, and the frames one after another; a frame holds a document's ids as little-endian 32-bit numbers.
An .idx file is the same head, then one entry per document in order: doc_id, offset and length of its frame, number of ids.
A short document is thus one read of its entry and one of its frame. Files follow each other in ascending doc_id order.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.llm.common import file_system, put_file, work_dir

MAGIC = b"TOKIDS1\0"
DICTIONARY_BYTES = 112_640
# The dictionary is trained on about so many texts; of a longer one on so many runs of ids, spread evenly over it.
SAMPLE_DOCUMENTS = 2_000
RUN_IDS, RUNS = 100, 5
LEVEL = 3
END_ID = 1
DOCUMENTS_PER_FILE = 4_096
CHARACTERS_AT_ONCE = 1 << 21
WORDS_HELD = 400_000
WORDS_AT_ONCE = 1_000
ROWS_AT_ONCE = 1_024

ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("n_ids", "<i8")])
_ADDED = " "
_SEPARATE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class WordEncoder:
    """Encodes texts with a tokenizers file, adding no special tokens, and appends `end_id`.

    Strings of the file's own added tokens in a text are those tokens, as in the library.

    The tokenizer drops white space and never merges across it, so a process encodes each distinct word once, and documents are put
    together from the ids of their words. Marks that close a word are words of their own. It cuts a word into letters, digits and marks and merges within such a piece only, so
    words are put together from the ids of their pieces in turn. Pieces of printable ASCII, nearly all, go to the tokenizer's model, as its
    other steps leave them as they are; other pieces go to the tokenizer as long texts, in which the last token of each ends in the
    vocabulary's word end, so the ids can be told apart again. Words whose pieces take a closer look are encoded one by one.
    """

    path: str
    end_id: int = END_ID

    def open(self) -> _Words:
        return _opened(self)

    def encode(self, words: _Words, texts) -> Iterator[np.ndarray]:
        """The ids of each text."""
        end = np.array([self.end_id], np.uint32)
        group = np.cumsum([len(t or "") for t in texts]) // CHARACTERS_AT_ONCE
        for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1):
            for own in words.places([words.cut(texts[i]) for i in rows]):
                yield np.concatenate([words.pool[_spans(words.starts[own], words.lengths[own])], end])


class _Places(dict):
    """Places by word; a new word gets the next and is noted."""

    def __init__(self, held=()):
        super().__init__(held)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class _Words:
    """The words that a process has met, and their pieces: their places in a pool of ids. When they are many, those met once are forgotten."""

    def __init__(self, encoder: WordEncoder):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(encoder.path)
        # Added tokens are cut out of the texts before; a word that only lower-casing makes look like one is none.
        self.tokenizer.encode_special_tokens = True
        self.added = {_ADDED + t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        for t in self.tokenizer.get_added_tokens_decoder().values():
            if t.normalized or t.lstrip or t.rstrip or t.single_word:
                raise ValueError(f"added token {t.content!r} is not matched literally")
        longest_first = sorted((re.escape(a[len(_ADDED) :]) for a in self.added), key=len, reverse=True)
        self.literal = re.compile(f"({'|'.join(longest_first)})") if self.added else None
        word_end = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = bool(word_end) and token.endswith(word_end)
        self.literal_ascii = _leaves_ascii(self.tokenizer)
        self._forget()

    def _forget(self) -> None:
        self.known = _Places()
        self.pool, self.lengths, self.starts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _forget_rare(self) -> None:
        """Keep what was met twice or more, the most met half of what may be held at most; later meetings count more."""
        stay = np.flatnonzero(self.uses > 1)
        if len(stay) > WORDS_HELD // 2:
            stay = np.sort(stay[np.argsort(-self.uses[stay], kind="stable")[: WORDS_HELD // 2]])
        kept = np.zeros(len(self.uses), bool)
        kept[stay] = True
        self.known = _Places(zip(list(compress(self.known, kept.tolist())), range(len(stay))))
        self.pool = self.pool[_spans(self.starts[stay], self.lengths[stay])]
        self.lengths, self.uses = self.lengths[stay], self.uses[stay] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def places(self, documents: list[list[str]]) -> list[np.ndarray]:
        """The places of each document's words, which hold until the next call."""
        if len(self.known) > WORDS_HELD:
            self._forget_rare()
        known = self.known
        try:
            found = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in documents]
            if len(known) > len(self.lengths):
                self._learn()
            if found:
                self.uses += np.bincount(np.concatenate(found), minlength=len(known))
        except BaseException:
            self._forget()  # places without ids must not outlive the call
            raise
        return found

    def _learn(self) -> None:
        """Add the ids of the words that have a place but none yet: first of those that are one piece, then of those put together."""
        known, first, words = self.known, len(self.lengths), self.known.new
        single, joined, n_parts, parts = [], [], [], []  # places; parts one after another
        plain, others = ([], []), ([], [])  # places and pieces
        ascii_goes = self.literal_ascii
        for place, word in enumerate(words, first):  # parts that are new join the list at its end
            if word.isascii():
                if word.isalpha() or (own := _pieces(word)) and len(own) == 1:
                    to = plain if ascii_goes and word.isprintable() else others
                    to[0].append(place)
                    to[1].append(word)
                    continue
            elif word.isalpha() and word.lower().isalpha():
                others[0].append(place)
                others[1].append(word)
                continue
            else:
                own = _pieces(word)
            if own:
                joined.append(place)
                n_parts.append(len(own))
                parts.extend([known[p] for p in own])
            else:
                single.append((place, word))
        known.new = []
        self.lengths = np.append(self.lengths, np.zeros(len(words), np.int64))
        self.starts = np.append(self.starts, np.zeros(len(words), np.int64))
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))
        self._add(plain[0], *self._merged(plain[1]))
        self._add(others[0], *self._encoded(others[1]))
        self._add([place for place, _ in single], *_flat([self._single(word) for _, word in single]))
        if joined:
            n, parts = np.array(n_parts, np.int64), np.array(parts, np.int64)
            ids = self.pool[_spans(self.starts[parts], self.lengths[parts])]
            self._add(joined, ids, np.add.reduceat(self.lengths[parts], np.cumsum(n) - n))

    def _add(self, places: list[int], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.lengths[places], self.starts[places] = lengths, len(self.pool) + np.cumsum(lengths) - lengths
        self.pool = np.concatenate([self.pool, ids])

    def cut(self, text: str | None) -> list[str]:
        """The words of a text; an added token is a word that begins with a space, as no other does."""
        parts = self.literal.split(text) if text and self.literal else [text]
        if len(parts) == 1:
            return _words(text)
        return [word for i, part in enumerate(parts) for word in ([_ADDED + part] if i % 2 else _words(part))]

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by the model alone, one after another, and how many each has."""
        merge, ids, lengths = self.tokenizer.model.tokenize, [], []
        for piece in pieces:
            tokens = merge(piece.lower())
            lengths.append(len(tokens))
            ids.extend([t.id for t in tokens])
        return np.array(ids, np.uint32), np.array(lengths, np.int64)

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by all steps of the tokenizer, as long texts."""
        found = []
        for at in range(0, len(pieces), WORDS_AT_ONCE):
            some = pieces[at : at + WORDS_AT_ONCE]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            closed = np.flatnonzero(self.ends[ids]) + 1
            if len(closed) == len(some) and closed[-1] == len(ids):
                found.append((ids, np.diff(closed, prepend=0)))
            else:  # not such a vocabulary: word by word
                found.append(_flat([self._single(p) for p in some]))
        return tuple(np.concatenate([none, *x]) for none, x in zip(_flat([]), zip(*found) if found else ((), ())))

    def _single(self, word: str) -> np.ndarray:
        ids = [self.added[word]] if word in self.added else self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, np.uint32)


def _flat(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one after another."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


@lru_cache(maxsize=1)
def _opened(encoder: WordEncoder) -> _Words:
    """One for all tasks of a process, which run one after another."""
    # A task has one core; threads of the tokenizer's own would each hold memory of theirs.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Words(encoder)


def _leaves_ascii(tokenizer) -> bool:
    """Whether all that the tokenizer does to pieces of printable ASCII before its model is to lower their case."""
    normalizer, cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
    for low in [chr(c).lower() for c in range(33, 127)]:
        if normalizer and normalizer.normalize_str(low) != low or cutter and [p for p, _ in cutter.pre_tokenize_str(low)] != [low]:
            return False
    return True


def _pieces(word: str) -> list[str]:
    """The pieces into which the tokenizer cuts a word: runs of letters, single digits and runs of marks. None if that takes a closer look:
    apostrophes begin pieces of their own, and what is neither ASCII nor a letter may be a number or may join a letter."""
    if word.isascii():
        return [] if "'" in word or word.startswith(_ADDED) else [word] if word.isalpha() else _RUNS.findall(word)
    letters = word.rstrip(_MARKS)
    if not letters.isalpha() or not letters.lower().isalpha():
        return []
    return [word] if len(letters) == len(word) else [letters, word[len(letters) :]]


_RUNS = re.compile(r"[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")
_MARKS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~"
_CLOSING = re.compile(r"[{0}](?<=[A-Za-z\u00df-\u00f6\u00f8-\u00ff].)[{0}]*(?=[ \n]|\Z)".format(re.escape(_MARKS)))
# Letters whose lower case Python and the tokenizer see differently, and marks that join lower-case letters only.
_CASED = re.compile("[\u0130\u03a3\u0300-\u036f]")
_TO_SPACE = {ord(c): " " for c in _SEPARATE}


def _words(text: str | None) -> list[str]:
    """Split at white space, which the tokenizer drops; it does not count \x1c to \x1f, as str.split() does. It also cuts between a letter
    and a mark, so marks behind a word's last letter are split off."""
    if not text:
        return []
    if text.isascii() or not _CASED.search(text):
        text = text.lower()  # as the tokenizer does, so that fewer words differ
    text = _CLOSING.sub(r" \g<0>", text)
    return text.translate(_TO_SPACE).split(" ") if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def train_dictionary(docs: DataFrame, encoder: WordEncoder, text: str = "text") -> bytes:
    """A dictionary from the id arrays of about SAMPLE_DOCUMENTS different texts that are not empty, which a hash picks among all.

    Of an array of more than RUNS * RUN_IDS ids, RUNS runs spread evenly over it are taken, so that about 4 MB reach the driver. Empty
    where a corpus is too small to train on; frames then stand alone. A failure on a larger one is an error.
    """
    some = docs.where(F.length(text) > 0).select(F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    different = some.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, SAMPLE_DOCUMENTS / max(different, 1))
    # Copies of a text have one hash: all are picked or none, and one of them stays.
    picked = some.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * share)).dropDuplicates(["h"])

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder.open()
        for batch in batches:
            yield pd.DataFrame({"ids": [_runs(x).astype("<u4").tobytes() for x in encoder.encode(words, batch["text"].tolist())]})

    samples = sorted(bytes(r[0]) for r in picked.select("text").mapInPandas(sample, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        if sum(map(len, samples)) >= 10 * DICTIONARY_BYTES:
            raise
        return b""


def _runs(ids: np.ndarray) -> np.ndarray:
    """The ids, or of many of them runs that are spread evenly."""
    if len(ids) <= RUNS * RUN_IDS:
        return ids
    starts = np.linspace(0, len(ids) - RUN_IDS, RUNS).astype(np.int64)
    return np.concatenate([ids[a : a + RUN_IDS] for a in starts])


def _head(dictionary: bytes) -> bytes:
    return MAGIC + hashlib.sha256(dictionary).digest()[:8]


def _zstd_dictionary(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_ids(docs: DataFrame, folder: str, encoder: WordEncoder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents below `folder` in ascending doc_id order; returns (part, n_documents, n_ids) per file.

    Null ids come first, rows of one id are in the order of their texts. A task that runs again replaces its files by
    the same bytes.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dictionary = train_dictionary(rows, encoder)
    put_file(folder, "dictionary", [dictionary])
    n_files = max(1, -(-rows.count() // DOCUMENTS_PER_FILE))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder.open()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dictionary(dictionary), write_content_size=True)
        frames, entries, at, total = [_head(dictionary)], [], len(_head(dictionary)), 0
        pieces = (batch.iloc[i : i + ROWS_AT_ONCE] for batch in batches for i in range(0, len(batch), ROWS_AT_ONCE))
        for batch in pieces:
            for key, ids in zip(batch["doc_id"], encoder.encode(words, batch["text"].tolist())):
                frames.append(packer.compress(ids.astype("<u4").tobytes()))
                known = not pd.isna(key)
                entries.append((int(key) if known else 0, known, at, len(frames[-1]), len(ids)))
                at, total = at + len(frames[-1]), total + len(ids)
        if entries:
            part = TaskContext.get().partitionId()
            put_file(folder, f"part-{part:06d}.ids", frames)
            put_file(folder, f"part-{part:06d}.idx", [_head(dictionary), np.array(entries, ENTRY).tobytes()])
            yield pd.DataFrame({"part": [part], "n_documents": [len(entries)], "n_ids": [total]})

    # A hash of the text lets ranges split rows that share an id.
    ranged = rows.withColumn("_spread", F.xxhash64("text")).repartitionByRange(n_files, "doc_id", "_spread")
    ordered = ranged.sortWithinPartitions("doc_id", "_spread", "text").drop("_spread")
    return ordered.mapInPandas(write, "part long, n_documents long, n_ids long")


def read_ids(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    `parts` are the rows of `write_ids`, one per file; their running totals are where the files start.
    """
    totals = sorted((r["part"], r["n_ids"]) for r in parts.collect())  # two numbers per file
    starts, at = {}, 0
    for part, n in totals:
        starts[part], at = at, at + n
    fs, path = file_system(folder)
    with fs.open_input_stream(f"{path}/dictionary") as stored:
        dictionary = stored.read()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacker = zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(dictionary))
        fs, path = file_system(folder)
        head = _head(dictionary)
        for batch in batches:
            for part in batch["part"].tolist():
                name = f"part-{part:06d}"
                with fs.open_input_stream(f"{path}/{name}.ids") as stored:
                    content = stored.read()
                with fs.open_input_stream(f"{path}/{name}.idx") as stored:
                    index = stored.read()
                if content[: len(head)] != head or index[: len(head)] != head:
                    raise ValueError(f"{name} was written with another dictionary")
                entries = np.frombuffer(index, ENTRY, offset=len(head))
                n, crcs = [], []
                for entry in entries:
                    a = int(entry["offset"])
                    raw = unpacker.decompress(content[a : a + int(entry["length"])])
                    n.append(len(raw) // 4)
                    crcs.append(zlib.crc32(raw))
                n = np.array(n, np.int64)
                if not np.array_equal(n, entries["n_ids"]):
                    raise ValueError(f"{name} does not fit its index")
                keys = pd.array(entries["doc_id"].astype(np.int64), "Int64")
                keys[entries["has_id"] == 0] = pd.NA
                first = starts[part]
                yield pd.DataFrame({"doc_id": keys, "start": first + np.cumsum(n) - n, "n_tokens": n, "ids_crc32": crcs})

    if not totals:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row a file; the files are read where their rows are.
    files = spark.createDataFrame([(part,) for part, _ in totals], "part long").repartition(len(totals))
    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(folder: str, part: int, position: int) -> tuple[int | None, np.ndarray]:
    """One document of a file by its place: its id and its token ids, from two short reads."""
    fs, path = file_system(folder)
    with fs.open_input_stream(f"{path}/dictionary") as stored:
        dictionary = stored.read()
    head = len(_head(dictionary))
    with fs.open_input_file(f"{path}/part-{part:06d}.idx") as stored:
        entry = np.frombuffer(stored.read_at(ENTRY.itemsize, head + position * ENTRY.itemsize), ENTRY)[0]
    with fs.open_input_file(f"{path}/part-{part:06d}.ids") as stored:
        frame = stored.read_at(int(entry["length"]), int(entry["offset"]))
    raw = zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(dictionary)).decompress(frame)
    return (int(entry["doc_id"]) if entry["has_id"] else None), np.frombuffer(raw, "<u4")


def ids_round_trip(docs: DataFrame, encoder: WordEncoder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents and read the files back.

    Nulls: a null or empty text has the end id alone; null ids come first. Repeated rows are separate documents. An
    empty table gives an empty result; other columns are not read.
    """
    folder = work_dir(docs.sparkSession, "token-ids")
    parts = write_ids(docs, folder, encoder, doc_id, text)
    return read_ids(docs.sparkSession, folder, parts)
