"""The operators against plain versions of what they compute."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.data import awkward_docs, prose
from tickseries.llm import bpe, decontaminate, embeddings, idfiles, langid, lines, ppm, secret_scan, simhash, warc
from tickseries.llm.components import components
from tickseries.llm.queries import WORD_FILE, bpe_vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    return awkward_docs(spark).repartition(5).cache()


def key(rows):
    return sorted(rows, key=repr)


def roots(nodes, links):
    """Smallest node reached, by plain union-find."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert len(real) > 90
    want = roots({x for p in real for x in p}, real)
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# 1 ---------------------------------------------------------------------------------------------------------------------


def vectors(seed, spark, per_label=60):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (0, 1, None):
        base = rng.normal(size=(per_label, 12))
        for v in [*base, *(base[:15] + rng.normal(scale=0.04, size=(15, 12))), *(base[:5] * 3), *base[:4]]:
            rows.append((at, [float(x) for x in v.astype(np.float32)], label))
            at += 1
        hub = rng.normal(size=12)
        for _ in range(30):
            rows.append((at, [float(x) for x in (hub + rng.normal(scale=0.06, size=12)).astype(np.float32)], label))
            at += 1
    odd = [None, [], [0.0] * 12, [float("nan")] * 12, [1.0, None], [float("inf"), 1.0], [1.0, 0.0], [1.0], [-0.0, 1.0], [0.0, 1.0]]
    rows += [(at + i, v, 1) for i, v in enumerate(odd)]
    return rows


@pytest.mark.parametrize("per_tile", [7, 1024])
def test_near_vectors(spark, per_tile):
    rows = vectors(3, spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("KEPT", F.lit("x"))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicate_vectors(df, per_tile=per_tile).collect()}

    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = [
        (a, b)
        for i, (a, v, l) in enumerate(rows)
        for b, w, m in rows[i + 1 :]
        if l is not None and l == m and fine(v) and fine(w) and len(v) == len(w)
        and np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.98
    ]
    degree, root = Counter(x for p in links for x in p), roots([r[0] for r in rows], links)
    assert len(links) > 100
    assert found == {i: (degree[i], root[i], root[i] == i) for i, _, _ in rows}


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicate_vectors(empty).collect() == []
    lost = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, [1.0], None)], "vec_id long, embedding array<float>, label int")
    found = embeddings.near_duplicate_vectors(lost).collect()
    assert key(map(tuple, found)) == key([(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, False)])


# 2 ---------------------------------------------------------------------------------------------------------------------


def out_of_place(text, profiles, size):
    """The definition, word by word."""
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        points = [0, *map(ord, word), 0]
        for n in (1, 2, 3):
            for i in range(len(points) - n + 1):
                gram = points[i : i + n]
                if any(gram) and (n < 3 or gram[1]):
                    grams[sum(c << (21 * (n - 1 - j)) for j, c in enumerate(gram))] += 1
    own = [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], x[0]))][:size]
    far = {}
    for lang, profile in profiles.items():
        place = {g: i for i, g in enumerate(profile)}
        far[lang] = sum(abs(place[g] - i) if g in place else size for i, g in enumerate(own))
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (len(own) * size)


def test_language_profiles(spark, docs):
    profiles = langid.learn_profiles(docs)
    found = langid.identify(docs.withColumn("LANG_PRED", F.lit(1)), profiles).collect()
    assert len(found) == docs.count() and set(profiles) == {"en", "de"}
    for r in found:
        if not r["text"] or not re.search(r"[^\W\d_]", r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["text"].isascii():
            lang, score = out_of_place(r["text"], profiles, langid.PROFILE_GRAMS)
            assert r["lang_pred"] == lang and math.isclose(r["score"], score)
    assert langid.learn_profiles(docs.where("false")) == {}
    assert {r["lang_pred"] for r in langid.identify(docs, {}).collect()} == {"und"}


def test_long_texts_count_alike(monkeypatch):
    text = prose(9, 4000)
    whole = langid.count_grams(text)
    monkeypatch.setattr(langid, "LETTERS_AT_ONCE", 500)
    assert all(np.array_equal(a, b) for a, b in zip(whole, langid.count_grams(text)))


# 3 ---------------------------------------------------------------------------------------------------------------------


def ppm_log10(texts, text):
    """PPM over dictionaries, context by context."""
    counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    pad = bytes([255]) * ppm.ORDER
    for t in texts:
        data = pad + t + pad[:1]
        for i in range(ppm.ORDER, len(data)):
            for k in range(ppm.ORDER + 1):
                counts[k][data[i - k : i]][data[i]] += 1
    total, data = 0.0, pad + text + pad[:1]
    for i in range(ppm.ORDER, len(data)):
        excluded = set()
        for k in range(ppm.ORDER, -1, -1):
            followers = counts[k].get(data[i - k : i])
            if not followers:
                continue
            left = {b: n for b, n in followers.items() if b not in excluded}
            whole = sum(left.values()) + len(left)
            if data[i] in left:
                total += math.log10(left[data[i]] / whole)
                break
            if left:
                total += math.log10(len(left) / whole)
            excluded = set(followers)
        else:
            total += -math.log10(256 - len(excluded))
    return total


@pytest.mark.parametrize("head", [3, 1 << 18])
def test_scores(spark, docs, head, monkeypatch):
    monkeypatch.setattr(ppm, "FREQUENT_GRAMS", head)
    monkeypatch.setattr(ppm, "FREQUENT_WORDS", head)
    small = docs.where(F.coalesce(F.length("text"), F.lit(0)) < 3000)
    learns = F.col("doc_id") % 3 != 1
    found = ppm.score(small, learns).collect()
    rows = small.collect()
    train = [(r["text"] or "").encode() for r in rows if r["doc_id"] is not None and r["doc_id"] % 3 != 1]
    counts = Counter(w for t in train for w in [*t.lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        t = (r["text"] or "").encode()
        own = [*t.lower().split(), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want.append((r["doc_id"], len(own), sum(counts[w] > 0 for w in own), n, round(base, 6), round(ppm_log10(train, t), 6)))
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in found]
    assert key(got) == key(want)


def test_places_of_grams_are_bounded(spark, docs, monkeypatch):
    monkeypatch.setattr(ppm, "GRAMS_PER_NODE", 6)
    monkeypatch.setattr(ppm, "GRAMS_PER_PLACE", 50)
    small = docs.where(F.length("text") < 300)
    learns = F.col("doc_id") % 3 != 1
    grams = ppm.count_grams(small.select("text", F.coalesce(learns, F.lit(False)).alias("learns"))).cache()
    placed = ppm.dealt(grams, ppm.split_endings(grams))
    sizes = [r["count"] for r in placed.groupBy("place").count().collect()]
    by_last_byte = [r["count"] for r in grams.groupBy(F.expr("code >> 8 & 255")).count().collect()]
    assert sum(sizes) == sum(by_last_byte) and max(sizes) <= 100 < max(by_last_byte)
    assert {r["depth"] for r in placed.select("depth").distinct().collect()} >= {2, 3, 4}
    train = [(r["text"] or "").encode() for r in small.collect() if r["doc_id"] is not None and r["doc_id"] % 3 != 1]
    want = [(r["doc_id"], round(ppm_log10(train, r["text"].encode()), 6)) for r in small.collect()]
    assert key((r["doc_id"], round(r["score"], 6)) for r in ppm.score(small, learns).collect()) == key(want)


def test_scores_of_nothing(spark, docs):
    assert ppm.score(docs.where("false"), F.lit(True)).collect() == []
    one = ppm.score(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), F.lit(False)).first()
    assert (one["n_tokens"], one["n_known"], one["base_score"]) == (2, 0, 0.0)
    assert math.isclose(one["score"], -3 * math.log10(256))


# 4 ---------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("common", [0, 1 << 18])
def test_byte_bpe(spark, docs, common, monkeypatch):
    monkeypatch.setattr(bpe, "COMMON_WORDS", common)
    vocabulary = bpe_vocabulary()
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks(), special_tokens={})
    found = bpe.encode_documents(docs.withColumn("IDS", F.lit(0)), vocabulary).collect()
    assert len(found) == docs.count()
    for r in found:
        ids = library.encode_ordinary(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode_documents(docs.where("false"), vocabulary).collect() == []


def test_common_words_are_counted_over_all_documents(spark):
    """More documents than any sample of before: a word of three of them is known, one of two is not."""
    letters = "concat('q', translate(cast({} as string), '0123456789', 'abcdefghij'))"
    often, seldom = letters.format("id % 500"), letters.format("500 + id % 10500")
    docs = spark.range(0, 21_000, 1, 4).selectExpr(f"concat('x ', {often}, ' ', if(id % 10500 < 300, {seldom}, 'x'), ' ', id) as text")
    found = bpe.common_words(docs, bpe_vocabulary())
    name = lambda i: " q" + str(i).translate(str.maketrans("0123456789", "abcdefghij"))
    assert {name(i) for i in range(500)} <= set(found)
    assert not {name(500 + i) for i in range(300)} & set(found)
    library = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=bpe_vocabulary().ranks(), special_tokens={})
    assert all(ids == library.encode_ordinary(w) for w, ids in found.items())
    assert dict(bpe.Packed(found).items()) == found
    nothing = spark.createDataFrame([(None,), ("",), (None,)], "text string").repartition(3)
    assert bpe.common_words(nothing, bpe_vocabulary()) == {}


def test_common_words_stay_out_of_the_driver(spark, docs, tmp_path, monkeypatch):
    """Neither the words nor their ids are collected; tasks read them from the files of a folder."""
    fetched, whole = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: fetched.append(df.columns) or whole(df))
    found = bpe.encode_documents(docs, bpe_vocabulary(), contents=False)
    assert not [c for c in fetched if {"word", "words", "ids"} & set(c)]
    assert found.agg(F.sum("n_tokens")).first()[0] > 0
    ids = {f"{w}{i}": list(range(i % 4)) for i, w in enumerate(["a", " é", "\n", "你", "𝒳"] * 20)}
    spark.createDataFrame([*ids.items()], "word string, ids array<int>").repartition(5).write.parquet(folder := f"{tmp_path}/words")
    packed = bpe.Packed.read(folder)
    assert len(packed.words) == len(ids) and dict(packed.items()) == ids


def test_folds_and_merges_agree(spark):
    vocabulary = bpe_vocabulary()
    ranks = vocabulary.ranks()
    library = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = ["a", "aaaaaaa", "abababababab", "éàü", "你好吗"] + ["".join(rng.choice("abcdeinrst ") for _ in range(rng.randint(1, 20))) for _ in range(150)]
    latin = [w.encode().decode("latin-1") for w in words]
    df = spark.createDataFrame([(latin,)], "words array<string>")
    folded = df.select(bpe.fold_merges(F.col("words"), bpe.rank_table(ranks)).alias("ids")).first()["ids"]
    for word, ids in zip(words, folded):
        want = library.encode_ordinary(word)
        assert list(ids) == want == bpe.merge_short(word.encode(), ranks) == bpe.merge_long(word.encode(), ranks), word


def test_cut_like_the_named_classes():
    import regex

    vocabulary = bpe_vocabulary()
    cutter, named = bpe.Cutter(bpe.Cutter.patterns(vocabulary.pattern)), regex.compile(vocabulary.pattern)
    for low, high in ((0, 0x3000), (0x3000, 0x10000), (0xFF00, 0x11000), (0x1D000, 0x20000), (0x2FF00, 0x31000)):
        text = "".join(f"{chr(c)}a {chr(c)} 1" for c in range(low, high) if not 0xD800 <= c < 0xE000)
        assert cutter.words(text) == named.findall(text)


# 5 ---------------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("per_tile", [2, 1024])
def test_simhash_groups(spark, docs, per_tile):
    rows = docs.select("doc_id", "text").collect()
    found = simhash.simhash_groups(docs, per_tile=per_tile).collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows if r["doc_id"] is not None}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    root = roots(list(prints), links)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found if r["doc_id"] is not None}
    assert got == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}
    assert len(found) == len(rows)
    assert simhash.simhash_groups(docs.where("false")).collect() == []


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
def test_fingerprints_within_reach_all_link(spark, max_bits):
    rng = random.Random(max_bits)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base:
        for _ in range(40):
            prints.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, max_bits + 1))))
    signed = {p: int(np.uint64(p).astype(np.int64)) for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "_fp long")
    links = simhash.near_links(df, max_bits, per_tile=16).collect()
    near = [(signed[p], signed[q]) for p in prints for q in prints if p < q and (p ^ q).bit_count() <= max_bits]
    assert roots(list(signed.values()), [(r["a"], r["b"]) for r in links]) == roots(list(signed.values()), near)


def test_one_document_of_a_group_stays(spark, docs):
    whole = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    groups = simhash.simhash_groups(whole).collect()
    kept = simhash.drop_near_duplicates(whole)
    assert kept.columns == whole.columns
    assert key(r["doc_id"] for r in kept.collect()) == key({r["component_id"] for r in groups})


def test_near_duplicates_are_dropped_by_row(spark):
    """Groups of copies with null, repeated and mixed ids keep one row each, and the right one."""
    texts = {name: prose(500 + i, 60) for i, name in enumerate("abcde")}
    rows = [(None, "a"), (None, "a"), (7, "b"), (None, "b"), (7, "c"), (5, "c"), (9, "d"), (9, "d"), (9, "e"), (1, "c")]
    docs = spark.createDataFrame([(i, texts[t], t) for i, t in rows], "doc_id long, text string, _row string").repartition(4)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert key((r["doc_id"], r["_row"]) for r in kept.collect()) == key([(None, "a"), (7, "b"), (1, "c"), (9, "d"), (9, "e")])
    assert simhash.drop_near_duplicates(docs.limit(0)).collect() == []


# 6 ---------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("keys_per_shard, per_chunk", [(5, 3), (lines.KEYS_PER_SHARD, lines.DOCUMENTS_PER_CHUNK)])
def test_line_dedup(spark, docs, keys_per_shard, per_chunk):
    rows = docs.collect()
    split = [(r["text"] or "").split("\n") for r in rows]
    norm = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    df = Counter(k for ls in split for k in {norm(x) for x in ls} if k)
    for least in (2, 10):
        want = [
            (r["doc_id"], len(ls), sum(df[norm(x)] >= least for x in ls if norm(x)), "\n".join(x for x in ls if not norm(x) or df[norm(x)] < least))
            for r, ls in zip(rows, split)
        ]
        found = lines.dedup_lines(docs, least, keys_per_shard=keys_per_shard, documents_per_chunk=per_chunk)
        assert [c for c in docs.columns if c != "N_LINES"] + ["n_lines", "n_dropped"] == found.columns
        assert key((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()) == key(want)
    assert any(x[2] for x in want)
    assert lines.dedup_lines(docs.where("false")).collect() == []


def test_line_dedup_of_equal_rows_and_few_lines(spark):
    """Most rows are equal, so one chunk has most of them, and all chunks probe with the same few keys."""
    texts = [None] * 150 + ["a\nb\n C "] * 150 + [f"c\nown {i}" for i in range(40)]
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string").repartition(3)
    found = lines.dedup_lines(docs, 100, keys_per_shard=10, documents_per_chunk=10, probes_per_task=4)
    want = [(7, 1, 0, "")] * 150 + [(7, 3, 3, "")] * 150 + [(7, 2, 1, f"own {i}") for i in range(40)]
    assert key((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()) == key(want)


def test_counts_stop_at_the_threshold():
    h1, h2 = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, (2, 100))
    for most, size in ((10, 1), (65_535, 2), (1 << 20, 4)):
        shard = lines.build_shard(h1, h2, np.arange(100) * 5_000, most)
        place = lines.probe_shard(shard, h1, h2)
        assert shard["counts"].itemsize == size and shard["prints"].itemsize == 4
        assert np.array_equal(shard["counts"][place], np.minimum(np.arange(100) * 5_000, most))


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        h1, h2 = rng.integers(-(1 << 62), 1 << 62, (2, n))
        shard = lines.build_shard(h1, h2, np.arange(n))
        place = lines.probe_shard(shard, h1, h2)
        assert sorted(place.tolist()) == list(range(n))
        assert np.array_equal(shard["counts"][place], np.arange(n))
        other = lines.probe_shard(shard, h2, h1)
        assert not n or not (shard["prints"][other[other >= 0]] == h1[other >= 0]).any()


# 7 ---------------------------------------------------------------------------------------------------------------------


def plain_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_edit_distance():
    rng = random.Random(0)
    for _ in range(300):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(0, 9))] for _ in range(2))
        want = plain_distance(a, b)
        assert decontaminate.edit_distance(np.array(a, int), np.array(b, int), 50) == want
        assert decontaminate.edit_distance(np.array(a, int), np.array(b, int), 2) == min(want, 3)


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = "changed"
        elif kind == 1:
            words.insert(at, "more")
        else:
            words.pop(at)
    return words


def test_decontamination(spark):
    rng = random.Random(4)
    items = [prose(1000 + i, rng.randint(8, 40)) for i in range(12)] + [None, "", "...", "Word"]
    texts = [None, "", "word", "in a word, yes"]
    for i in range(90):
        own = re.findall(r"\w+", items[i % 12].lower())
        middle = edited(own, rng.randint(0, int(0.25 * len(own))), rng) if i % 3 else []
        texts.append(" ".join([prose(i, rng.randint(0, 60)), " ".join(middle).upper(), prose(500 + i, rng.randint(0, 60))]))
    texts.append(items[0])
    texts.append(" ".join(items[1].split()[:-1]))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(5, texts[5]), (None, items[2])], "doc_id long, text string").withColumn("start", F.lit("x"))
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(0, items[0])], "item_id long, text string")
    want = {}
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    for d, t in [*enumerate(texts), (None, items[2])]:
        own = split(t)
        for i, item in enumerate(map(split, items)):
            n = len(item)
            if not n or not own:
                continue
            spans = [(0, own)] if len(own) < n else [(s, own[s : s + n]) for s in range(len(own) - n + 1)]
            best = min((plain_distance(w, item), s) for s, w in spans)
            if best[0] <= math.floor(n * 0.2 + 1e-9):
                want[d, i] = (best[1], best[0])
    found = {(r["doc_id"], r["item_id"]): (r["start"], r["distance"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert len(want) > 40
    assert set(found) <= set(want)
    assert len(found) >= 0.99 * len(want)
    assert sum(found[k] == want[k] for k in found) >= 0.97 * len(found)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(len(texts)), None} - {d for d, _ in found}
    none = bench.where("false")
    assert decontaminate.contaminated(docs, none).collect() == [] == decontaminate.contaminated(docs.where("false"), bench).collect()


def test_windows_of_many_sizes_are_narrowed_at_once(monkeypatch):
    """The windows left are those with few words and pairs that no item of their size has, however many sizes are looked at in one go."""
    rng = np.random.default_rng(4)
    items = [rng.integers(1, 40, n) for n in (10, 10, 11, 15, 15, 20, 31)]
    text = np.concatenate([x for i in items for x in (rng.integers(1, 60, rng.integers(0, 9)), np.where(rng.random(len(i)) < 0.1, 99, i))])
    sizes = np.unique([len(i) for i in items])
    edits = decontaminate.allowed_edits(sizes)
    bitmap = lambda keys: np.packbits(np.isin(np.arange(decontaminate.FILTER_BITS), decontaminate._bits(decontaminate.FILTER_BITS, np.concatenate(keys))))
    vocabulary, pair_bits = bitmap(items), bitmap([decontaminate.pairs_of(i) for i in items])
    sized = bitmap([x for i in items for x in (decontaminate._of_size(17, len(i), i), decontaminate._of_size(19, len(i), decontaminate.pairs_of(i)))])
    few = lambda own, have, most: sum(x not in have for x in own) <= most
    for words in (text, text[:14], text[:9], items[0][:1]):
        want = set()
        for size, most in zip(sizes.tolist(), edits.tolist()):
            same = [i.tolist() for i in items if len(i) == size]
            have, have_pairs = {w for i in same for w in i}, {p for i in same for p in zip(i, i[1:])}
            for start in range(max(1, len(words) - size + 1)):
                own = words[start : start + size].tolist()
                if few(own, have, most - (size - len(own))) and few(zip(own, own[1:]), have_pairs, 2 * most):
                    want.add((size, start))
        known = decontaminate._holds(vocabulary, words)
        known_pairs = decontaminate.known_pairs_of(pair_bits, words, known)
        for at_once in (1, 50, 1 << 18):
            monkeypatch.setattr(decontaminate, "KEYS_AT_ONCE", at_once)
            got = set()
            for found in decontaminate.window_starts(known, known_pairs, sizes, edits):
                most = [int(decontaminate.allowed_edits(size)) for size, _ in found]
                for (size, _), starts in zip(found, decontaminate.narrowed(sized, words, found, most)):
                    got |= {(size, start) for start in starts.tolist()}
            assert got == want
    assert want or len(text) > 100


def test_words_of_many_texts_are_hashed_at_once(monkeypatch):
    """Equal words have equal hashes and others differ, in whichever text, place or slice they stand."""
    rng = random.Random(6)
    parts = ["foo", "Foo", "oof", "f", "\u00e9t\u00e9", "_", "7", "\u0130", "\U0001d4d0", "x" * 70, " ", "\n", "-", "'", "\u2019", "\u0301", "\x00"]
    texts = [None, "", "...", "one", *("".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)), "\u03a3\u03a3", ""]
    want = [re.findall(r"\w+", (t or "").lower()) for t in texts]
    for at_once in (1, 40, 1 << 17):
        monkeypatch.setattr(decontaminate, "CHARACTERS_AT_ONCE", at_once)
        words, begins = decontaminate.words_of_all(texts)
        assert np.diff(begins).tolist() == [len(w) for w in want] and begins[0] == 0
        of = dict(zip([w for own in want for w in own], words.tolist()))
        assert [of[w] for own in want for w in own] == words.tolist() and len(set(of.values())) == len(of) and min(words) > 0
        assert all(decontaminate.words_of(t).tolist() == [of[w] for w in own] for t, own in zip(texts, want))
    assert [x.tolist() for x in decontaminate.words_of_all([])] == [[], [0]]


def test_texts_without_windows_are_passed_over(monkeypatch):
    """Looked at many at once, no text with windows in reach is lost, and texts without words of the benchmark are not looked at one by one."""
    rng = random.Random(7)
    bitmap = lambda keys: np.packbits(np.isin(np.arange(decontaminate.FILTER_BITS), decontaminate._bits(decontaminate.FILTER_BITS, np.concatenate(keys))))
    for lengths in ((6, 9, 14, 30), (1, 12)):
        items = [[f"w{rng.randint(0, 80)}" for _ in range(n)] for n in lengths for _ in range(2)]
        texts = [None, "", "w1"]
        for i in range(300):
            own = edited(items[i % len(items)], rng.randint(0, len(items[i % len(items)]) // 4), rng) if i % 3 else []
            around = [[rng.choice(["so", "clean", f"w{rng.randint(0, 80)}"]) for _ in range(rng.randint(0, 9))] for _ in range(2)]
            texts.append(" ".join([*around[0], *own, *around[1]]))
        texts += ["nothing here but clean words and more of them"] * 50
        hashed = [decontaminate.words_of(" ".join(i)) for i in items]
        vocabulary, pair_bits = bitmap(hashed), bitmap([decontaminate.pairs_of(i) for i in hashed])
        sizes = np.array(sorted(lengths))
        edits = decontaminate.allowed_edits(sizes)
        starts = lambda known, pairs: [(size, s.tolist()) for found in decontaminate.window_starts(known, pairs, sizes, edits) for size, s in found]
        want = {}
        for i, t in enumerate(texts):
            words = decontaminate.words_of(t)
            known = decontaminate._holds(vocabulary, words)
            if len(words) and (found := starts(known, decontaminate.known_pairs_of(pair_bits, words, known))):
                want[i] = found
        batch = pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype=object)})
        for at_once in (1, 300, 1 << 17):
            monkeypatch.setattr(decontaminate, "CHARACTERS_AT_ONCE", at_once)
            got = {i: starts(known, pairs) for i, _, known, pairs in decontaminate._looked_at(batch, vocabulary, pair_bits, sizes, edits)}
            assert want == {i: x for i, x in got.items() if x} and len(want) > 50
            assert max(got) < len(texts) - 50


@pytest.mark.parametrize("size", [50, 100, 200])
def test_decontamination_finds_long_items_at_the_edit_limit(spark, size):
    rng = random.Random(size)
    items = [[f"w{i}x{j}" for j in range(size)] for i in range(150)]
    copies = []
    for i, item in enumerate(items):
        at = range(i % 5, size, 5) if i % 2 else rng.sample(range(size), size // 5)
        copies.append([f"{w}changed" if j in set(at) else w for j, w in enumerate(item)])
    docs, bench = (spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(x)], f"{k} long, text string") for x, k in ((copies, "doc_id"), (items, "item_id")))
    found = decontaminate.contaminated(docs, bench).collect()
    assert all(r["doc_id"] == r["item_id"] and r["distance"] == size // 5 for r in found)
    assert len(found) >= 149


def test_clean_rows_stay_whatever_their_id(spark):
    item = prose(77, 30)
    rows = [(None, f"so {item} so", 0), (None, prose(78, 50), 1), (None, None, 2), (None, "", 3), (4, item, 4), (4, prose(79, 50), 5), (4, item, 6), (5, prose(80, 9), 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").repartition(3)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r["row"] for r in decontaminate.drop_contaminated(docs, bench).collect()) == [1, 2, 3, 5, 7]
    renamed = docs.withColumnRenamed("text", "body").withColumns({"_key": F.lit("x"), "_found": F.lit(1)})
    kept = decontaminate.drop_contaminated(renamed, bench, text="body", doc_id="doc_id")
    assert kept.columns == renamed.columns and sorted(r["row"] for r in kept.collect()) == [1, 2, 3, 5, 7]


def test_edit_distances_of_many_pairs():
    rng = np.random.default_rng(8)
    for n, m in ((1, 1), (6, 6), (9, 4)):
        a, b = rng.integers(1, 4, (200, n)), rng.integers(1, 4, (200, m))
        lengths = rng.integers(0, n + 1, 200)
        for most in (0, 2, 20):
            want = [min(plain_distance(x[:k].tolist(), y.tolist()), most + 1) for x, k, y in zip(a, lengths, b)]
            assert decontaminate.edit_distances(a, lengths, b, most).tolist() == want


def test_an_item_under_many_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(i, text) for i in range(50)] + [(7, "short one here now"), (None, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {text} x"), (2, "a short one here now"), (3, "clean")], "doc_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    want = [(1, i, 1, 0) for i in range(50)] + [(1, None, 1, 0), (2, 7, 1, 0)]
    assert key(map(tuple, found)) == key(want)


# 8 ---------------------------------------------------------------------------------------------------------------------


def test_added_tokens_are_as_in_the_library():
    encoder = idfiles.WordEncoder(public_tokenizers.path(WORD_FILE))
    library = Tokenizer.from_file(public_tokenizers.path(WORD_FILE))
    rng = random.Random(9)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "a", "B", " ", "\n", "e\u0301", "\u0301", "don't", "12", "\x1c", "\u0130"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(encoder.open(), texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_words_are_put_together_from_their_pieces(monkeypatch):
    """A word with marks behind it takes the ids of its letters, which the tokenizer sees once for all tasks of a process."""
    encoder, library = idfiles.WordEncoder(public_tokenizers.path(WORD_FILE)), Tokenizer.from_file(public_tokenizers.path(WORD_FILE))
    words = encoder.open()
    assert encoder.open() is words and words.literal_ascii
    words._forget()
    merged, model = [], idfiles._Words._merged
    monkeypatch.setattr(idfiles._Words, "_merged", lambda self, pieces: merged.extend(pieces) or model(self, pieces))
    rng = random.Random(3)
    parts = ["foo", "Bar", "é", "ßü", ",", "...", '"', "'s", "12", "\x00", "\x7f", "\u2019", "a\u0301", "\u212b", "-"]
    texts = ["foo foo, foo. (foo) foo-foo 7foo", None, *(" ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(9)) for _ in range(900))]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(words, texts)):
            assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 1], text
    assert merged.count("foo") == 1 and len(merged) == len(set(merged))
    monkeypatch.setattr(words, "_add", None)
    with pytest.raises(TypeError):
        words.places([["unheard"]])
    monkeypatch.undo()
    assert [x.tolist() for x in encoder.encode(words, ["unheard, foo"])] == [[*library.encode("unheard, foo", add_special_tokens=False).ids, 1]]


def test_closing_marks_are_words_of_their_own():
    """So that a word is learned once whatever closes it; words that take a closer look stay whole."""
    encoder, library = idfiles.WordEncoder(public_tokenizers.path(WORD_FILE)), Tokenizer.from_file(public_tokenizers.path(WORD_FILE))
    words = encoder.open()
    assert words.cut("Foo, bar... \u00e9t\u00e9).\nfoo") == ["foo", ",", "bar", "...", "\u00e9t\u00e9", ").", "foo"]
    assert words.cut("it', a.b 7. e\u0301. .x, ..") == ["it',", "a.b", "7.", "e\u0301.", ".x", ",", ".."]
    rng = random.Random(12)
    parts = ["foo", "Z", "\u00e9", "\u00df", "\u00c5", "\u0144", "\u0130", "\u03a3", ",", ".", "]", "<", "'", "'s", '"', "7", "\u00bd", "\u0338", "\u0301", " ", "\n", "\t", "\x1c", "\x85", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode(words, texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text


def test_common_words_are_not_forgotten(monkeypatch):
    """When a process holds too many words it keeps those met twice or more, and ids stay those of the library."""
    encoder, library = idfiles.WordEncoder(public_tokenizers.path(WORD_FILE)), Tokenizer.from_file(public_tokenizers.path(WORD_FILE))
    words = encoder.open()
    words._forget()
    merged, model = [], idfiles._Words._merged
    monkeypatch.setattr(idfiles._Words, "_merged", lambda self, pieces: merged.extend(pieces) or model(self, pieces))
    monkeypatch.setattr(idfiles, "WORDS_HELD", 60)
    monkeypatch.setattr(idfiles, "CHARACTERS_AT_ONCE", 300)
    rng = random.Random(5)
    rare = lambda: "".join(rng.choices("abcdefgh", k=9))
    texts = [None, "", *(f"often, usual {rare()}. don't-{rare()} {rare()} usual often \u00e9t\u00e9" for _ in range(400))]
    for text, ids in zip(texts, encoder.encode(words, texts)):
        assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 1], text
        assert len(words.known) == len(words.lengths) == len(words.starts) == len(words.uses) < 200
    assert merged.count("often") == merged.count("usual") == 1 and len(set(merged)) > 800
    monkeypatch.setattr(idfiles, "WORDS_HELD", 2)
    texts = [" ".join("often usual seldom never".split()[: 1 + i % 4]) for i in range(200)]
    for text, ids in zip(texts, encoder.encode(words, texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], text
    words._forget()


def test_dictionary_of_a_corpus_of_nulls_and_copies(spark):
    """Null, empty and repeated texts take no place in the sample, and long texts are sampled over their whole length."""
    texts = [prose(i, 60) for i in range(1500)] + [None] * 3000 + [""] * 500 + [prose(0, 60)] * 3000
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    trained = idfiles.train_dictionary(docs, idfiles.WordEncoder(public_tokenizers.path(WORD_FILE)))
    assert len(trained) > 10_000
    assert idfiles.train_dictionary(docs.limit(0), idfiles.WordEncoder(public_tokenizers.path(WORD_FILE))) == b""
    ids = np.arange(100_000)
    runs = idfiles._runs(ids)
    assert len(runs) == 500 and runs[0] == 0 and runs[-1] == 99_999 and len({x // 20_000 for x in runs}) == 5


@pytest.mark.parametrize("per_file", [4, 8192])
def test_token_id_files(spark, docs, tmp_path, per_file, monkeypatch):
    monkeypatch.setattr(idfiles, "DOCUMENTS_PER_FILE", per_file)
    encoder = idfiles.WordEncoder(public_tokenizers.path(WORD_FILE))
    library = Tokenizer.from_file(public_tokenizers.path(WORD_FILE))
    found = idfiles.ids_round_trip(docs, encoder).collect()
    first = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    texts = defaultdict(list)
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        texts[r["doc_id"]].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    assert len(found) == docs.count()
    for r in sorted(found, key=lambda r: (*first(r), r["start"])):
        assert r["start"] == at
        texts[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
        at += r["n_tokens"]
    assert idfiles.ids_round_trip(docs.where("false"), encoder).collect() == []

    folder = str(tmp_path / "ids")
    parts = idfiles.write_ids(docs, folder, encoder).collect()
    part = min(p["part"] for p in parts)
    doc_id, ids = idfiles.read_document(folder, part, 0)
    assert doc_id is None and ids[-1] == 1


# 9 ---------------------------------------------------------------------------------------------------------------------


def test_warc(spark):
    pages = [(i, f"http://x/{i}", f"<p>{i % 7}</p>" * (i % 5)) for i in range(60)]
    pages += [(60, None, None), (61, "u\r\nWARC-Type: x", ""), (None, "n", "<p>1</p>"), (None, "n", "alone"), (59, "again", pages[59][2]), (62, "é", "é" * 9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    last = {}
    for i, _, html in pages:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", -1))
    want = []
    for i, _, html in pages:
        payload = (html or "").encode()
        to = last.get(html or "")
        revisit = to is not None and i != to
        want.append((i, len(payload), warc.payload_digest(payload), "revisit" if revisit else "response", to if revisit else None))
    found = warc.warc_round_trip(df)
    assert key(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found.collect()) == key(want)
    assert warc.warc_round_trip(df.where("false")).collect() == []
    long_only = warc.warc_round_trip(df, least_bytes=20).collect()
    assert {r["record_type"] for r in long_only if r["payload_bytes"] < 20} == {"response"}


def test_warc_reads_ranges(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://x/{i}", "z" * (i * 37 % 900)) for i in range(200)], "page_id long, url string, html string").coalesce(2)
    folder = str(tmp_path / "warc")
    index = warc.write_warc(df, folder)
    chosen = index.where("page_id % 11 = 3")
    for read_bytes, gap in ((1, 0), (2_000, 100), (1 << 20, 1 << 20)):
        got = warc.read_warc(chosen, folder, read_bytes, gap).collect()
        assert key((r["page_id"], r["url"]) for r in got) == key((i, f"http://x/{i}") for i in range(200) if i % 11 == 3)


# 10 --------------------------------------------------------------------------------------------------------------------


def plain_base(text):
    patterns = [
        (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
        (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, good) in enumerate(patterns) for m in p.finditer(text) if good(m))


def test_secret_scan(spark, docs):
    names = ("assign", "access", "hex")
    found = secret_scan.scan_secrets(docs.withColumn("SPANS", F.lit(1))).collect()
    assert len(found) == docs.count()
    for r in found:
        base = plain_base(r["text"] or "")
        shown = [f"{names[k]}:{a}:{b}" for a, k, b in base]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("entropy")] == shown
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[23]["n_entropy"] == 1 and by_id[22]["n_hex"] == 1
    assert all(r["n_entropy"] == 0 for r in found if r["doc_id"] is not None and 100 <= r["doc_id"])
    assert secret_scan.scan_secrets(docs.where("false")).collect() == []


def test_hex_runs_equal_measured_runs():
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("0af9x AKIZ=:") for _ in range(80)) + "AKIA" + "A" * rng.randint(0, 30)
        assert secret_scan.base_spans(text) == plain_base(text)


def test_window_entropy_is_incremental():
    rng = random.Random(3)
    for window in (1, 4, 20):
        string = "".join(rng.choice("abcd01") for _ in range(60))
        want = []
        for i in range(len(string) - window + 1):
            counts = Counter(string[i : i + window])
            want.append(-sum(c / window * math.log2(c / window) for c in counts.values()))
        assert np.allclose(secret_scan.window_entropies(string, window), want)
    assert secret_scan.window_entropies("", 5) == []


def test_allow_list():
    spans = secret_scan.entropy_spans
    assert spans("id 550e8400-e29b-41d4-a716-446655440000") == []
    assert spans("see /usr/local/share/applications/somewhere") == []
    assert spans("a" * 50 + " " + "0123456789" * 5) == []
    assert spans("q7Zk2PvX9sLw4TgBn8RjYc3HmDf6AeUo1K5iVx0S") != []


def test_keys_beside_dates_digests_and_identifiers_are_found():
    key = "q7Zk2PvX9sLw4TgBn8RjYc3HmDf6AeUo1K5iVx0SqW9eRt2y"
    for before, after in (
        ("2024-01-01T", ""),
        ("2024-01-01T12/", ""),
        ("0123456789abcdef" * 2 + "/", ""),
        ("550e8400-e29b-41d4-a716-446655440000/", ""),
        ("example/", "=="),
        ("", "/" + "fedcba9876543210" * 4),
    ):
        found = [x.split(":") for x in secret_scan.scan(f"x {before}{key}{after} y")["spans"].split(",")]
        at = len(before) + 2
        assert any(k == "entropy" and int(a) <= at + 2 and int(b) >= at + len(key) - 2 for k, a, b in found), before
        spans = sorted((int(a), int(b)) for k, a, b in found)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert secret_scan.entropy_spans("2024-01-01T12 wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY sk-EXAMPLEq7Zk2PvX9sLw4TgBn8RjYc3") == []
    assert secret_scan.scan("0123456789abcdef" * 4)["n_entropy"] == 0


def test_long_runs_take_time_in_proportion():
    rng = random.Random(5)
    for run in ("a" * 300_000 + "1", "".join(rng.choice("abcXYZ019+/") for _ in range(300_000)), "ab1-" * 75_000, "0a1b2c3d4e5f60718" + "/" * 300_000):
        started = time.monotonic()
        secret_scan.scan(run)
        assert time.monotonic() - started < 20


def test_warc_files_are_cut_by_bytes_and_reads_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES_PER_TASK", 4_000)
    pages = [(i, f"http://x/{i}", random.Random(i).randbytes(600).hex()) for i in range(300)]
    pages += [(300, "long", random.Random(300).randbytes(100_000).hex())]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    folder = str(tmp_path / "warc")
    index = warc.write_warc(df, folder)
    assert index.agg(F.sum("length")).first()[0] > 200_000
    found = warc.read_warc(index, folder, read_bytes=2_000)
    assert found.rdd.getNumPartitions() >= 50
    read_by = found.select("page_id", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(read_by) > 20
    assert sorted(r.page_id for r in found.collect()) == list(range(301))
