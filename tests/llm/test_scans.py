from __future__ import annotations

import hashlib
import os
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from parlance.llm import decontaminate, html_text, licenses, token_count
from parlance.llm import text as buffers

from .conftest import ALNUM, lower, prose


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n, k in ((1, 1), (5, 1), (60, 2), (400, 3)):
        s = rng.integers(0, k, n).astype(np.uint64)
        assert list(decontaminate.suffix_array(s, n)) == sorted(range(n), key=lambda i: list(s[i:]))


def _brute(docs, items):
    out = []
    windows = []
    for item, text in items:
        w = ALNUM.findall(lower(text))
        if item is not None and w:
            windows += [(str(item), w[i : i + 13]) for i in range(max(1, len(w) - 12))]
    for doc, text in docs:
        w, hit, names = ALNUM.findall(lower(text)), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit |= set(range(i, i + len(x)))
                    names.add(item)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice((3, 8, 13, 14, 40)))) for i in range(20)] + [(None, "a b c"), (99, None), (98, "..."), (7, "single"), (5, prose(rng, 20))]
    docs = []
    for i in range(60):
        words = prose(rng, rng.choice((0, 5, 100))).split()
        if i % 2:
            part = items[rng.randrange(20)][1].split()
            a = rng.randrange(len(part))
            words[len(words) // 2 : len(words) // 2] = [w.upper() for w in part[a : a + rng.choice((5, 13, 40))]]
        docs.append((i, ", ".join(words)))
    docs += [(3, docs[3][1]), (100, None), (None, docs[1][1])]
    return docs, items


def test_decontamination(spark, leaks):
    docs, items = leaks
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    keys = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = _brute(docs, items)
    assert any(r[5] for r in want)
    assert sorted((tuple(r[k] for k in keys) for r in decontaminate.decontaminate(d, b).collect()), key=repr) == want
    whole = sorted(map(repr, decontaminate.decontaminate(d, b).collect()))
    assert sorted(map(repr, decontaminate.decontaminate(d, b, pass_chars=900).collect())) == whole  # several passes
    kept = decontaminate.decontaminate(d, b, carry=d.columns, drop=True)
    assert kept.columns == d.columns and kept.count() == sum(not r[5] for r in want)


def test_decontamination_longest(spark):
    d = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(30)) + " z")], "doc_id long, text string")
    b = spark.createDataFrame([(4, "q " + " ".join(f"w{i}" for i in range(5, 25)) + " q")], "item_id long, text string")
    r = decontaminate.decontaminate(d, b).first()
    assert (r["longest"], r["longest_item"], r["longest_word"], r["n_hit"]) == (20, "4", 7, 20)


def test_decontamination_longest_in_every_document(spark):
    """Documents of a shard that share a passage, one in full, one twice, one a shorter part."""
    passage = [f"w{i}" for i in range(20)]
    texts = {1: ["x", *passage], 2: [*passage, "y"], 3: ["z", "z", *passage[:15], "z"], 4: passage[:12], 5: [*passage, *passage]}
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame([(4, "q " + " ".join(passage) + " q")], "item_id long, text string")
    got = {r["doc_id"]: (r["longest"], r["longest_item"], r["longest_word"]) for r in decontaminate.decontaminate(d, b).collect()}
    assert got == {1: (20, "4", 1), 2: (20, "4", 0), 3: (15, "4", 2), 4: (0, None, 0), 5: (20, "4", 0)}


def test_decontamination_edges(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(odd_docs, none).collect())
    got = {r["doc_id"]: r["n_hit"] for r in decontaminate.decontaminate(odd_docs, some).collect()}
    assert got[7] == 1 and got[9] == 0 and got[4] == 0
    assert decontaminate.decontaminate(no_docs, some).count() == 0


def test_decontamination_clashing_names(spark, leaks):
    docs, items = leaks
    d = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, n_words int, hits int, c0 int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(d, b, carry=["doc_id", "n_words", "hits", "c0"])
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_item", "longest_word", "hits", "c0"]
    assert {(r["hits"], r["c0"]) for r in got.collect()} == {(2, 3)}


def test_words_of_very_long_texts():
    """Words and keys don't depend on where chunks of the buffer end, nor on what stands around a text."""
    rng = random.Random(4)
    base = ["".join(rng.choice("ab1Zé .\n") for _ in range(rng.choice((0, 3, 200)))) for _ in range(500)]
    long = " ".join(base) * 1000
    assert len(long.encode()) > 30_000_000
    word = "q" * (3 * buffers.CHUNK // 2)
    texts = [None, base[7], long, word, f"{word} end", *base]
    found = buffers.words(pa.array(texts, pa.string()), buffers.ALNUM)
    for i in (2, 3, 4, 5, 40):
        own = [w.encode() for w in ALNUM.findall(lower(texts[i]))]
        mine = slice(found.first[i], found.first[i + 1])
        at = found.offsets[i]
        assert found.counts[i] == len(own)
        for j in list(range(mine.start, mine.stop))[:: max(1, len(own) // 3000)]:
            assert found.buf[found.start[j] : found.end[j]].tobytes().lower() == own[j - mine.start]
        assert found.start[mine.start] >= at
    keys = found.keys()
    small = buffers.words(pa.array([base[7], f"{word.upper()} end"], pa.string()), buffers.ALNUM)
    assert (small.keys()[: small.first[1]] == keys[found.first[1] : found.first[2]]).all()
    assert keys[found.first[3]] == keys[found.first[4]] == small.keys()[small.first[1]]
    assert (keys[found.first[2] : found.first[2] + 100] == buffers.words(pa.array([long[:4000]], pa.string()), buffers.ALNUM).keys()[:100]).all()


LICENCES = [
    ("", (0, 0, None, None, "", "", 0.0)),
    ("Released under the MIT License.", (5, 1, 3, 3, "mit", "mit", 0.9)),
    ("the MIT-license, the Apache License; GNU General Public License", (10, 3, 1, 7, "apache,gpl,mit", "apache,gpl,mit", 0.9)),
    ("mit licenses", (2, 0, None, None, "", "", 0.0)),
    ("mit license mit license", (4, 2, 0, 2, "mit", "mit", 0.9)),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0", None),
    ("Licensed under CC BY-NC 4.0.", (7, 0, None, None, "", "cc-by,cc-by-nc", 0.6)),
]


@pytest.mark.parametrize(("text", "want"), LICENCES)
def test_licence_text(text, want):
    got = licenses.scan_text(text, licenses.automaton())
    if want:
        assert got[:7] == want
    else:
        assert got[5] == "apache,gpl,mit" and got[6] == 1.0 and got[7] is False


def test_licence_expressions():
    rpn = lambda s: licenses.to_rpn(s.split())
    assert rpn("MIT or Apache-2.0 and BSD") == ["mit", "apache-2.0", "bsd", "and", "or"]
    assert rpn("( MIT or Apache-2.0 ) and BSD") == ["mit", "apache-2.0", "or", "bsd", "and"]
    for bad in ("", "or", "MIT or", "( MIT", "MIT )", "MIT MIT", "( )"):
        assert rpn(bad) is None
    assert licenses.evaluate(rpn("GPL-3.0 or MIT")) == ({"gpl", "mit"}, True)
    assert licenses.evaluate(rpn("GPL-3.0 and MIT")) == ({"gpl", "mit"}, False)


def test_licences_by_brute_force(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = licenses.scan_licenses(odd_docs)
    assert sorted(((r["doc_id"] or 0, r["n_words"]) for r in got.collect())) == sorted((r["doc_id"] or 0, len(ALNUM.findall(lower(r["text"])))) for r in rows)
    assert licenses.scan_licenses(no_docs).count() == 0
    rng = random.Random(4)
    texts = []
    for i in range(200):
        words = [rng.choice(("mit", "license", "Apache", "general", "public", "x,", "LICENSE.")) for _ in range(rng.randrange(0, 30))]
        texts.append((i, " ".join(words)))
    found = {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"]) for r in licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, t in texts:
        w = ALNUM.findall(lower(t))
        at = [k for p in licenses.BASE_PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert found[i] == (len(at), min(at, default=None), max(at, default=None))


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use</div>"
    "<article><h1>Head &amp; line</h1><p>One <b>two<br>three</p><p>A&nbsp;b\n  c<p>Open <script>var x='</p>'</script>end<form>Search</form><div class='ad'>Buy</div><section id='comments'><article class='comment'>First!</article></section></article>"
    "<aside>Side</aside><footer>&copy; me</footer></body></html>"
)


def test_html_structure():
    lines, kinds = html_text.parse_blocks(PAGE)
    text = [x for x, k in zip(lines, kinds, strict=True) if k == html_text.ARTICLE]
    assert text == ["Head & line", "One two three", "A b c", "Open end"] and html_text.PLAIN not in kinds
    assert html_text.parse_blocks("") == ([], [])
    assert html_text.parse_blocks("plain &lt;text&gt;") == (["plain <text>"], [html_text.PLAIN])
    assert html_text.parse_blocks("<p>a<div>b</div>c")[0] == ["a", "b", "c"]
    assert html_text.parse_blocks("<div hidden>x</div><p style='display: none'>y</p><p>z</p>")[0] == ["z"]
    assert _plain("<div class='side-bar'>x</div><div class='layout with-sidebar'><p>y</div><ul id='readerComments'><li>z</ul>") == ["y"]
    assert _plain("<p>unclosed <b>bold <nav>menu") == ["unclosed bold"]
    assert _plain("<p title='a>b' alt=\"c>\">q</p> 3 < 4 <unclosed") == ["q", "3 < 4 <unclosed"]
    assert _plain("<article><header class='entry-header'><h1>Title</h1></header><p>so <math><mi>x</mi></math> <label>holds</label></p></article>") == ["Title", "so x holds"]
    assert _plain("<main><div class='article-header'>T</div><section class='legal'>L</section><div class='ad'>A</div></main>") == ["T", "L"]


def _plain(page):
    return [x for x, k in zip(*html_text.parse_blocks(page), strict=True) if k != html_text.OUTSIDE]


@pytest.mark.parametrize("bad", ['<a "', '<i x="', "<", "<!--", "<p><b>", "&amp", "</x><div>", "<div class='a", "<script>"])
def test_broken_markup_takes_linear_time(bad):
    cost = []
    for n in (1 << 16, 1 << 18):
        best = 9.0
        for _ in range(2):
            began = time.perf_counter()
            html_text.parse_blocks((bad * (n // len(bad)))[:n] + ">")
            best = min(best, time.perf_counter() - began)
        cost.append(best)
    assert cost[1] < max(0.1, 9 * cost[0]) and cost[1] < 3


def test_longest_common_subsequence(monkeypatch):
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        for listed in (1 << 20, -1):
            monkeypatch.setattr(html_text, "LISTED", listed)
            got = html_text.common_lines(a, b)
            assert sum(got) == table[-1][-1]
            at = 0
            for x in [x for x, k in zip(a, got, strict=True) if k]:
                at = b.index(x, at) + 1
    assert sum(html_text.common_lines(["x"] * 3000, ["x"] * 2000 + ["y"] + ["x"] * 500)) == 2500


def test_html_differencing(spark, no_docs):
    page = lambda *lines: "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"
    rows = [(1, "http://a.com/x/1", page("Top bar", "Story one", "All rights")), (2, "http://a.com/x/2", page("Top bar", "Story two", "All rights")), (3, "http://b.com/", page("Lone page")), (4, None, None), (5, "http://a.com/z", PAGE), (6, "::", "<p>x")]
    got = {r["page_id"]: r for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), partitions=1).collect()}
    assert got[1]["text"] == "Story one" and got[2]["text"] == "Story two" and got[1]["n_shared"] == 2 and got[1]["paired_with"] == 2
    assert got[3]["text"] == "Lone page" and got[3]["paired_with"] is None and got[4]["text"] == "" and got[4]["n_chars"] == 0
    assert got[5]["text"].startswith("Head & line\n") and got[5]["n_chars"] == len(got[5]["text"])
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract_main_text(empty).count() == 0


def test_html_differencing_in_articles(spark):
    """Boilerplate inside articles goes, copied articles stay."""
    page = lambda *lines: "<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>"
    rows = [(i, f"http://a.com/x/{i}", page(f"Story number {i} is long enough", "All rights reserved")) for i in range(5)]
    rows += [(i, f"http://b.com/x/{i}", page("The same article on each page", "and its second line")) for i in range(5, 10)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), partitions=1).collect()}
    assert got == {i: f"Story number {i} is long enough" for i in range(5)} | dict.fromkeys(range(5, 10), "The same article on each page\nand its second line")


def _settle_brute(rows):
    """Texts by the rules alone: neighbours in one sorted list, subsequences by dynamic programming."""

    def shared(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
        return table[0][0], {x for x in a if x in b}

    def place(url):
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    pages = sorted((*place(url), i, *html_text.parse_blocks(page or "")) for i, url, page in rows)
    out = {}
    for k, (host, path, i, lines, kinds) in enumerate(pages):
        near = [pages[j] for d in (1, 2) for j in (k - d, k + d) if 0 <= j < len(pages) and pages[j][0] == host]
        near.sort(key=lambda x: -len(os.path.commonprefix([x[1], path])))
        size = sum(len(x) for x, kind in zip(lines, kinds, strict=True) if kind != 2)
        article = sum(len(x) for x, kind in zip(lines, kinds, strict=True) if kind == 1)
        # lines of the fixture are distinct in a page and in one order on all, so what two pages share is a set
        others = [shared(lines, x[3])[1] for x in near]
        if 2 * article >= size > 0:
            others = [s for s in others if 2 * sum(len(x) for x, kind in zip(lines, kinds, strict=True) if kind == 1 and x in s) < article]
        elif size:
            others = [s for s in others if any(kind != 2 and x not in s for x, kind in zip(lines, kinds, strict=True))]
        left = [(x, kind) for x, kind in zip(lines, kinds, strict=True) if kind != 2 and not (others and x in others[0] and (kind == 0 or sum(x in s for s in others) >= 2))]
        inner = [x for x in left if x[1] == 1]
        if 2 * sum(len(x) for x, _ in inner) >= sum(len(x) for x, _ in left):
            left = inner
        out[i] = "\n".join(x for x, _ in left)
    return out


def test_html_differencing_by_brute_force(spark):
    """Texts are those of the rules for any number of ranges, of which many are shorter than the pages they look at."""
    rng = random.Random(8)
    rows = []
    for i in range(140):
        host = rng.choice("aaaab")
        top = [f"<div>{x}</div>" for x in (f"Welcome to {host}", "Latest news", f"Page {i}") if rng.random() < 0.8]
        story = [f"<p>{prose(rng, rng.randrange(1, 12))} {i}.{j}</p>" for j in range(rng.randrange(0, 4))]
        quote = ["<p>An often quoted line</p>"] if rng.random() < 0.3 else []
        mark = rng.choice((("<article>", "</article>"), ("<div>", "</div>")))
        rows.append((i, f"http://{host}.com/{rng.choice(('x', 'x/y', 'z'))}/{rng.randrange(40)}", "".join([*top, mark[0], *story, *quote, mark[1], "<div>All rights</div><footer>Imprint</footer>"])))
        if rng.random() < 0.1:
            rows.append((1000 + i, rows[-1][1] + "/copy", rows[-1][2]))
    want = _settle_brute(rows)
    assert len(set(want.values())) > 60
    pages = spark.createDataFrame([(*r, 1, "x", [2]) for r in rows], "page_id long, url string, html string, part int, text string, lines array<int>").repartition(7)
    for partitions in (1, 4, 40):
        got = {r["page_id"]: r["text"] for r in html_text.extract_main_text(pages, partitions=partitions).collect()}
        assert got == want


def _expression_brute(line):
    tokens = licenses._TOKEN.findall(line)
    for n in range(len(tokens), 0, -1):
        rpn = licenses.to_rpn(tokens[:n])
        if rpn and (n == len(tokens) or tokens[n].lower() not in licenses._PRECEDENCE):
            return licenses.evaluate(rpn)
    return None


def test_licence_expressions_by_brute_force():
    rng = random.Random(12)
    for _ in range(3000):
        line = " ".join(rng.choice(("MIT", "GPL-2.0", "BSD", "OR", "and", "WITH", "(", ")")) for _ in range(rng.randrange(0, 9)))
        assert licenses._expression(line) == _expression_brute(line)


@pytest.mark.parametrize("part", ["MIT OR ", "( ", "MIT ) ", "MIT and ( ", "MIT MIT ", "or "])
def test_licence_expressions_take_linear_time(part):
    began = time.perf_counter()
    licenses.scan_text("SPDX-License-Identifier: " + part * 100_000, licenses.automaton())
    assert time.perf_counter() - began < 5


def _split(tokens, width, size):
    data = np.array(tokens, dtype=f"<u{width}").tobytes()
    return [data[i : i + size] for i in range(0, len(data), size)]


def test_flat_files(spark, tmp_path, monkeypatch):
    """Files that end anywhere in a range of blocks, read in ranges or whole."""
    rng = random.Random(2)
    want = []
    for name in ("a", "b", "c"):
        tokens = [rng.choice((0, 1, 2)) for _ in range({"a": 0, "b": 64 * 4 * 3, "c": 701}[name])]
        (tmp_path / name).write_bytes(np.array(tokens, dtype="<u2").tobytes())
        text = "".join(map(str, tokens)).split("0")
        want += [len(x) for x in text[: len(text) - (not text[-1])]]
    for stores in (token_count.ARROW_STORES, frozenset()):
        monkeypatch.setattr(token_count, "ARROW_STORES", stores)
        got = token_count.count_tokens(token_count.read_streams(spark, f"file://{tmp_path}", block_bytes=8), separator=0, width=2)
        assert sorted(r["n_tokens"] for r in got.collect()) == sorted(want)


@pytest.mark.parametrize(("width", "size"), [(4, 4), (4, 12), (2, 2), (2, 6), (4, 1 << 20)])
def test_separator_scan(spark, width, size):
    rng = random.Random(width * size)
    rows, want = [], []
    for s in range(6):
        tokens = [rng.choice((0, 0, 1, 2, 3, 3, 3)) for _ in range(rng.randrange(0, 60))]
        rows += [(s, i, d) for i, d in enumerate(_split(tokens, width, size))]
        n = at = 0
        for t in tokens:
            if t == 0:
                want.append((s, at, n))
                at, n = at + 1, 0
            else:
                n += 1
        if n:
            want.append((s, at, n))
    got = token_count.count_tokens(spark.createDataFrame(rows, "stream long, block long, data binary"), separator=0, width=width)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert token_count.count_tokens(spark.createDataFrame([], "stream long, block long, data binary"), 0).count() == 0


def test_token_counts(spark, odd_docs, no_docs):
    encode = token_count.bpe()
    want = sorted((r["doc_id"] or 0, len(encode(r["text"] or ""))) for r in odd_docs.collect())
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in token_count.count_document_tokens(odd_docs).collect()) == want
    assert token_count.count_document_tokens(no_docs).count() == 0


def test_token_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([1, 2, 9, 3, 9, 9, 4], dtype="<u4").tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    got = token_count.count_tokens(token_count.read_streams(spark, str(tmp_path), 8), 9, width=4)
    assert sorted((r["ordinal"], r["n_tokens"]) for r in got.collect()) == [(0, 2), (1, 1), (2, 0), (3, 1)]
