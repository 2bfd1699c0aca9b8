"""Spelling variants, vector codes and page texts against plain versions."""

from __future__ import annotations

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import duck, spark_rows, sql_rows
from tests.llm.data import awkward_docs, prose
from tickseries.llm import htmltext, spelling, vector_codes
from tickseries.llm.oracle import ORACLES
from tickseries.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_vector_codes"])
def test_query_equals_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == sql_rows(duck(sf_dir), ORACLES[name])


def test_registered():
    assert {"op11_spelling_variants", "op12_vector_codes", "op13_html_extraction"} <= set(entry.queries())


# Spelling variants


def plain_words(rows, spoil):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if spoil and h % spoil == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def vocabulary(seed, size):
    """Words that lie close together, with counts of all sizes and ties."""
    rng = random.Random(seed)
    words = {"abcde": 3, "aaaaa": 40, "aaaaaa": 20, "aaaaaaa": 9, "élève": 8, "eleve": 8, "élèves": 3}
    while len(words) < size:
        word = list(rng.choice(list(words)))
        at = rng.randrange(len(word))
        match rng.randrange(3):
            case 0:
                word[at] = rng.choice("abcé")
            case 1:
                word.insert(at, rng.choice("abcé"))
            case _:
                del word[at]
        if 5 <= len(word) <= 12:
            words.setdefault("".join(word), rng.choice([3, 3, 6, 7, 12, 50, 200]))
    return words


@pytest.mark.parametrize("per_tile", [7, 2048])
def test_spelling_groups(spark, per_tile):
    counts = vocabulary(per_tile, 300)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = {tuple(r) for r in spelling.spelling_groups(frame, words_per_tile=per_tile).collect()}
    assert found == plain_groups(counts)
    assert sum(form is not None for _, form, *_ in found) > 50


def test_chains_of_forms_end_at_their_root(spark):
    chain = ["a" * k for k in range(5, 16)]
    counts = {w: 3 * 2**i for i, w in enumerate(chain)}
    found = spelling.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {r["root"] for r in found} == {chain[-1]}
    assert {(r["word"], r["form"]) for r in found} == {*zip(chain, chain[1:]), (chain[-1], None)}


def test_position_index_equals_edit_distance():
    words = sorted(vocabulary(3, 200))
    for short in range(5, 12):
        block = [w for w in words if len(w) in (short, short + 1)]
        index = spelling.PositionIndex(block, short)
        for word in (w for w in block if len(w) == short):
            for half in (0, short // 2):
                replaced, longer = index.near(word, half)
                found = {block[i] for i in spelling._bits(replaced | longer)}
                assert found == {v for v in block if one_edit(word, v) and not (half and v[:half] == word[:half])}


def test_spelling_of_awkward_documents(spark):
    docs = awkward_docs(spark)
    docs = docs.union(docs).withColumn("word", F.lit("x")).withColumn("n", F.lit(0)).repartition(4)
    counts = plain_words([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 7)
    assert len(counts) > 200
    found = {tuple(r) for r in spelling.spelling_variants(docs, spoil_divisor=7).collect()}
    assert found == plain_groups(counts)


def test_words_in_task_do_not_change_counts(spark, monkeypatch):
    docs = awkward_docs(spark)
    whole = {tuple(r) for r in spelling.count_words(docs).collect()}
    monkeypatch.setattr(spelling, "WORDS_IN_TASK", 50)
    assert {tuple(r) for r in spelling.count_words(docs).collect()} == whole


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "ab cd")]])
def test_spelling_without_words(spark, rows):
    assert spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []


# Vector codes


def plain_codes(rows, parts, entries, rounds):
    """rows: (id, label, floats), usable and in the order of the codebooks."""
    ints = np.array([[int(np.floor(256 * x)) for x in v] for _, _, v in rows], object)
    width = ints.shape[1] // parts
    cut = ints.reshape(len(rows), parts, width)
    books = [[list(cut[r, p]) for r in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest():
        out = []
        for r in range(len(rows)):
            out.append([min((sum((a - b) ** 2 for a, b in zip(cut[r, p], c)), e) for e, c in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        found = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[r, p] for r in range(len(rows)) if found[r][p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    found = nearest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, label, _), error in zip(rows, errors):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), error, by_label[label], digest) for (i, label, _), f, error in zip(rows, found, errors)), key=repr
    )


def vectors(seed, n, width):
    rng = random.Random(seed)
    return [(i, rng.choice([None, 1, 1, 1, 2]), [rng.choice([-1.5, -0.01, 0.0, 0.3, 1.0, 7.25]) + rng.random() / 50 for _ in range(width)]) for i in range(n)]


KIND = "vec_id long, embedding array<float>, label int, code string, error int"


@pytest.mark.parametrize("n, entries", [(90, 64), (40, 64), (90, 5), (1, 64)])
def test_vector_codes(spark, n, entries):
    rows = [(i, label, [float(np.float32(x)) for x in v]) for i, label, v in vectors(n, n, 32)]
    rows += [(i + n, *rows[0][1:]) for i in range(n // 3)]  # copies: ties between entries
    frame = spark.createDataFrame([(i, v, label, "clash", 0) for i, label, v in rows], KIND)
    bad = [(-1, None, 1), (-2, [], 1), (-3, [None] * 32, 2), (-4, [float("nan")] * 32, 2), (-5, [float("-inf")] + [0.0] * 31, 1)]
    frame = frame.union(spark.createDataFrame([(*b, "clash", 0) for b in bad], KIND)).repartition(5)
    found = vector_codes.vector_codes(frame, entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_codes(rows, 16, entries, 2)


def test_vector_codes_of_null_and_repeated_ids(spark):
    rows = [(3, 1, [0.5] * 16), (3, 1, [0.25] * 16), (None, None, [2.0] * 16), (3, 1, [0.5] * 16)]
    frame = spark.createDataFrame([(i, v, label, "", 0) for i, label, v in rows], KIND)
    in_order = [rows[1], rows[0], rows[3], rows[2]]  # by id, then components, null ids last
    found = vector_codes.vector_codes(frame, entries=2)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_codes(in_order, 16, 2, 2)


def test_blocks_do_not_change_codes(spark, monkeypatch):
    frame = spark.createDataFrame([(i, v, label, "", 0) for i, label, v in vectors(5, 120, 16)], KIND).repartition(2)
    whole = sorted(map(tuple, vector_codes.vector_codes(frame).collect()))
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 7)
    assert sorted(map(tuple, vector_codes.vector_codes(frame).collect())) == whole


def test_vector_codes_without_vectors(spark):
    for rows in ([], [(1, None, 2, "", 0)]):
        assert vector_codes.vector_codes(spark.createDataFrame(rows, KIND)).collect() == []


@pytest.mark.parametrize("vector", [[0.0] * 15, [1e9] * 16])
def test_vectors_that_cannot_be_coded_are_an_error(spark, vector):
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark.createDataFrame([(1, vector, 1, "", 0)], KIND))


def test_vectors_of_two_lengths_are_an_error(spark):
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark.createDataFrame([(1, [0.0] * 16, 1, "", 0), (2, [0.0] * 32, 1, "", 0)], KIND))


# Pages


def article_blocks(source):
    """The article of the test pages, read off their one template."""
    body = source[source.index("<article>") + len("<article>") :].split("</article>")[0]
    body = re.sub(r"</?b>|<br>", " ", body)
    return [s for s in (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", body)) if s]


def test_pages_of_the_test_tables(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in QUERIES["op13_html_extraction"](spark, sf_dir).collect()}
    assert len(found) == pages.count()
    for page in pages.collect():
        text = "\n".join(article_blocks(page["html"]))
        assert found[page["page_id"]].asDict() == {"page_id": page["page_id"], "url": page["url"], "text": text, "n_chars": len(text)}


LONG = [f"{prose(i, 40).strip()} end {i}." for i in range(6)]
P = [" ".join(x.split()) for x in LONG]


def paragraphs(texts):
    return "".join(f"<p>{x}</p>" for x in texts)


MENU = "<ul>" + "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(12)) + "</ul>"
PAGES = {
    # No marks at all: only the densities tell the text from menus and links.
    "divs": (f"<body><div>{MENU}</div><div><div>{paragraphs(LONG)}</div></div><div><a href=x>Imprint</a> <a href=y>Terms</a></div></body>", P),
    "heading outside": (f"<body><div>{MENU}</div><div><h1>{LONG[0]}</h1><div>{paragraphs(LONG[1:])}</div></div><div>{MENU}</div></body>", P),
    "class names": (
        f'<body><div class="site-nav">{LONG[0]}</div><div id="cookie-banner"><p>{LONG[1]}</p></div><div class="content"><p>{LONG[2]}</p>'
        f'<div class="ad-slot">{LONG[3]}</div><p>{LONG[4]}</p></div><div id="comments"><p>{LONG[5]}</p></div><div class="leftSidebar">{LONG[0]}</div></body>',
        [P[2], P[4]],
    ),
    "tags": (
        f"<header>{LONG[0]}</header><main><article><header><h1>Title</h1></header><p>{LONG[1]}</p><form>{LONG[2]}<p>x</p></form><aside>{LONG[3]}</aside>"
        f"<p>{LONG[4]}</p><footer>by me</footer></article><section class='comments'><article><p>{LONG[5]} {LONG[5]}</p></article></section></main><footer>f</footer>",
        ["Title", P[1], P[4]],
    ),
    "wrapper": (f'<body class="has-sidebar"><div class="sidebar-layout"><article class="post with-comments">{paragraphs(LONG)}</article></div></body>', P),
    "hidden": (f'<article><p>{LONG[0]}</p><p hidden>{LONG[1]}</p><div style="color:red; display : none">{LONG[2]}</div><p aria-hidden="true">x</p></article>', P[:1]),
    "short article beside a long advert": (f"<body><div>{LONG[0]} {LONG[1]}</div><article><h1>Short</h1><p>Very short.</p></article></body>", ["Short", "Very short."]),
    "short sections": (f"<article><section>{paragraphs(LONG)}</section><section><p>Tiny.</p></section></article>", [*P, "Tiny."]),
    "references": ("<article><p>a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; x&nbsp;y &amp;amp; AT&T &unknown; &copy 1</p></article>", ["a & b <c> ééé x y &amp; AT&T &unknown; © 1"]),
    "space": ("<article>\n <p>one\n\ttwo <b>th</b>ree<br>four</p>five<i> six</i>\r\n<pre> a\n  b </pre><p> \n </p></article>", ["one two three four", "five six", "a b"]),
    "not closed": (f"<article><p>{LONG[0]}<p><b>{LONG[1]}<li>{LONG[2]}<li>{LONG[3]}", P[:4]),
    "misnested": ("<article><p>one <b>two <i>three</b> four</i></p></div></p> five</article>", ["one two three four", "five"]),
    "script": ('<article><script>if (a < b) { "</p>" }</script><p>text</p><SCRIPT>x</script ><style>p{}</style><p>more</p></article>', ["text", "more"]),
    "script without end": ("<article><p>text</p></article><script>var a = '<p>none</p>';", ["text"]),
    "comments of markup": ("<!doctype html><article><!-- <p>a</p> -->one<!-->two--><?php x ?><![CDATA[y]]> three</ ></article><!-- never ends <p>z", ["onetwo--> three"]),
    "attributes": ("<article><p title='a > b' data-x=\"</p>\" x=5\" y>text 3 < 4 > 2 <3</p></article>", ["text 3 < 4 > 2 <3"]),
    "cut in a tag": ("<article><p>text</p><p cla", ["text"]),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", ["a", "b", "c"]),
    "plain text": ("only\n some text", ["only some text"]),
    "markup only": ("<div><br><img src=x></div>", []),
    "menu only": (f"<nav>{MENU}</nav>", []),
    "self closing": ("<article><div/>one<p/>two</article>", ["one", "two"]),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    source, blocks = PAGES[name]
    assert htmltext.main_text(source).split("\n") == (blocks or [""])


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + f"<p>{LONG[0]}</p>"
    assert htmltext.main_text(deep) == P[0]
    assert htmltext.main_text("<b>" * 3000 + "<p>" * 3000 + "text") == "text"
    words = [f"word{i}" for i in range(200_000)]
    source = "<article>" + "".join(f"<p>{' '.join(words[i:i + 50])}</p>" for i in range(0, len(words), 50)) + "</article>"
    assert htmltext.main_text(source).split() == words


def plain_density(page, i):
    """Density of an element from its subtree, counted anew."""
    below = [j for j in range(len(page.parent)) if not page.hidden[j]]

    def inside(j, top):
        while j >= 0 and j != top:
            j = page.parent[j]
        return j == top

    def in_link(j):
        while j >= 0:
            if page.tag[j] == "a":
                return True
            j = page.parent[j]
        return False

    def chars(of, linked=False):
        return sum(len("".join(t.split())) for j, t in page.pieces if t and not page.hidden[j] and inside(j, of) and (not linked or in_link(j)))

    c, lc = chars(i), chars(i, True)
    t = sum(inside(j, i) for j in below) - 1
    lt = sum(inside(j, i) and page.tag[j] == "a" for j in below)
    if not c:
        return 0.0
    t, lc1, lt = max(t, 1), max(lc, 1), max(lt, 1)
    base = np.log(c / max(c - lc, 1) * lc1 + chars(0, True) / max(chars(0), 1) * c + np.e)
    return max(c / t * np.log(c / lc1 * t / lt) / np.log(base), 0.0)


@pytest.mark.parametrize("name", ["divs", "class names", "tags"])
def test_densities(name):
    page = htmltext.Page(PAGES[name][0])
    density, sums = htmltext.densities(page)
    for i in range(len(page.parent)):
        if not page.hidden[i]:
            assert density[i] == pytest.approx(plain_density(page, i))
            children = [j for j, up in enumerate(page.parent) if up == i and not page.hidden[j]]
            assert sums[i] == pytest.approx(sum(density[j] for j in children))


def test_extract_keeps_other_columns_and_rows(spark):
    rows = [(1, "u", "<p>a</p>", "old", "n"), (1, "u", "<p>a</p>", "old", "n"), (None, None, None, None, None), (2, "v", "", "x", "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, Text string, N_Chars string")
    found = htmltext.extract(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert htmltext.extract(frame.limit(0)).collect() == []
