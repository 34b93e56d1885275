from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parlance.llm import language, lm_score, mixing, sample, scratch, toxicity
from parlance.llm.queries import QUERIES

from .conftest import SPACE, lower, prose

DATA = "/root/testdata/sf0.01"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    emit, trans, first = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5, 5, 9])
    p, pairs, _ = toxicity.marginals(emit, first, trans, pairs=True)
    want, expected = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if not n:
            continue
        paths = [[(m >> i) & 1 for i in range(n)] for m in range(1 << n)]
        w = np.array([math.exp(sum(emit[a + i] for i in range(n) if s[i]) + sum(trans[s[i], s[i + 1]] for i in range(n - 1))) for s in paths])
        w /= w.sum()
        for s, x in zip(paths, w, strict=True):
            want[a:b] += x * np.array(s)
            for i in range(n - 1):
                expected[s[i], s[i + 1]] += x
    assert np.allclose(p, want) and np.allclose(pairs, expected)


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words, bad = prose(rng, rng.randrange(5, 60)).split(), i % 4 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(("vile", "grotty")) if i % 8 else "zork" + rng.choice(("el", "ia", "um", "on", "ar")))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out(toxic):
    docs, labels = toxic
    got = toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 150 and (held.predicted == held.toxic).mean() > 0.97
    row = held[held.toxic == 1].iloc[0]
    text = docs.where(F.col("doc_id") == int(row.doc_id)).first()["text"]
    spans = [text[s["start"] : s["end"]] for s in row.spans]
    assert spans and all(w.startswith(("vile", "grotty", "zork")) for s in spans for w in s.split())
    assert toxicity.drop_toxic(docs, toxicity.fit(docs, labels)).count() == int((got.predicted == 0).sum())


def test_toxicity_edges(toxic, odd_docs, no_docs):
    model = toxicity.fit(*toxic)
    got = toxicity.score_toxicity(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] in (4, 5, 6)} == {0}
    assert toxicity.score_toxicity(no_docs, model).count() == 0
    none = toxicity.fit(toxic[0], toxic[1].limit(0))
    assert {r["predicted"] for r in toxicity.score_toxicity(odd_docs, none).collect()} == {0}
    assert toxicity.drop_toxic(odd_docs, none).columns == odd_docs.columns


def _tokens(text):
    return [*SPACE.findall(lower(text)), "\0end"]


def test_lm_base_by_brute_force(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    train = Counter(w for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10 for w in _tokens(t))
    total, kinds = sum(train.values()), len(train)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in lm_score.score_texts(odd_docs).collect()))
    want = sorted((i is None, i or 0, len(w := _tokens(t)), sum(x in train for x in w), total, round(sum(math.log10((train[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w), 6)) for i, t in rows)
    assert got == want
    assert lm_score.score_texts(no_docs).count() == 0


def test_lm_tree_learns_contexts(spark):
    rng = random.Random(1)
    follow = {"a": "b", "b": "c", "c": "a"}
    rows = []
    for i in range(400):
        words = ["a"]
        for _ in range(60):
            words.append(follow[words[-1]] if rng.random() < 0.9 else rng.choice("abc"))
        rows.append((i, " ".join(words)))
    got = lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").toPandas()
    assert (got.score > got.base_score + 10).all()


def _tree_brute(train, texts):
    """log10 probabilities of the texts and the longest state, by dictionaries."""
    words = Counter(w for t in train for w in t)
    total, once = sum(words.values()), sum(n == 1 for n in words.values())
    discount = min(once / len(words), 0.95)
    unknown = max(once, 1) / (total + (0 if once else 1))
    states, entries, weights, depth = {}, {}, {(w,): n for w, n in words.items()}, 0

    def step(p, context, word):
        if context not in states:
            return p
        weight, factor = states[context]
        n = entries[context].get(word, 0)
        return (n + lm_score.PRIOR * p) / (weight + lm_score.PRIOR) if n else p * 10**factor

    def chance(context, word):
        p = max(words[word] - discount, 0.05) / total if word in words else unknown
        for k in range(1, len(context) + 1):
            p = step(p, context[-k:], word)
        return p

    while True:
        depth += 1
        grams = {g: n for g, n in Counter(tuple(t[i - depth : i + 1]) for t in train for i in range(depth, len(t))).items() if n >= 2}
        for g, n in grams.items():
            if depth == 1 or g[1:-1] in states:
                entries.setdefault(g[:-1], {})[g[-1]] = n
        found = {}
        for context, following in entries.items():
            if len(context) == depth:
                parents = {w: chance(context[1:], w) for w in following}
                sums = [sum(following.values()), sum(parents.values()), sum(n * math.log(n / parents[w]) for w, n in following.items()), len(following)]
                keep, factor = lm_score.judge(*(np.array([float(x)]) for x in (weights[context], *sums)))
                if keep[0]:
                    found[context] = (weights[context], factor[0])
        if not found:
            return [sum(math.log10(chance(tuple(t[:i][-depth:]), w)) for i, w in enumerate(t)) for t in texts], depth - 1, chance, words
        states |= found
        weights = grams


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_lm_scores_by_brute_force(spark, monkeypatch, few):
    """Texts whose next word depends on two, three or four before it."""
    monkeypatch.setattr(lm_score, "FEW_STATES", few)
    rng = random.Random(5)
    rows = []
    for i in range(500):
        words = [rng.choice("abcd") for _ in range(4)]
        for _ in range(70):
            back = rng.choices((0, 1, 2, 3, 4), (2, 8, 5, 4, 3))[0]
            words.append("abcd"[sum(map(ord, words[-back:])) * (back + 1) % 4 // (1 + back % 2)] if back else rng.choice("abcdxyz"))
        rows.append((i, " ".join(words)))
    rows += [(500 + i, rows[7][1]) for i in range(3)] + [(600, None), (601, ""), (602, "never seen a b c")]
    tokens = [_tokens(t) for _, t in rows]
    train = [t for (i, _), t in zip(rows, tokens, strict=True) if zlib.crc32(str(i).encode()) % 10]
    want, depth, chance, words = _tree_brute(train, tokens)
    assert depth >= 4
    got = {r["doc_id"]: r["score"] for r in lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == pytest.approx(x, rel=1e-5) for (i, _), x in zip(rows, want, strict=True))
    for context in ((), ("a",), ("a", "b"), ("a", "b", "c", "d"), ("never", "a")):
        assert sum(chance(context, w) for w in words) == pytest.approx(sum(chance((), w) for w in words), abs=0.02)


def test_lm_unknown_texts(spark):
    got = lm_score.score_texts(spark.createDataFrame([(None, "x y")], "doc_id long, text string")).first()
    assert got["train_tokens"] == 0 and got["n_known"] == 0 and got["base_score"] == pytest.approx(0.0) and got["score"] == 0.0


def test_language(spark):
    docs, pages = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "pages"))
    got = QUERIES["op2_language_id"](spark, DATA)
    assert got.count() == docs.count() + pages.count()
    right = got.join(docs.select("doc_id", F.col("lang").alias("l")), "doc_id").where("lang = l").count()
    assert right >= 0.98 * docs.count()
    declared = got.join(pages.select("page_id", F.regexp_extract("html", '<html lang="(..)"', 1).alias("l")), "page_id").where("lang = l").count()
    assert declared >= 0.98 * pages.count()


def test_language_fusion(spark):
    """Evidence decides where the text says nothing."""
    rng = random.Random(2)
    rows = [(i, "the of and that " * 5 if i % 2 else "der und nicht das " * 5, "en" if i % 2 else "de") for i in range(200)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    pages = [(i, f"https://h{i % 20}.example.{'com' if i % 2 else 'de'}/{i}", f"<html lang='{'en' if i % 2 else 'de'}'><p>{rows[i][1] if rng.random() < 0.8 else '...'}</p>") for i in range(200)] + [(None, None, None), (500, "nonsense", "")]
    got = language.identify(language.page_rows(spark.createDataFrame(pages, "page_id long, url string, html string")), model, ["id"]).collect()
    assert len(got) == 202 and all(0 < r["prob"] <= 1 + 1e-9 for r in got)
    assert all(r["lang"] == ("en" if r["id"] % 2 else "de") for r in got if r["id"] is not None and r["id"] < 200)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert language.identify(language.page_rows(empty), model, ["id"]).count() == 0


def test_language_edges(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"), F.col("source").alias("site"))
    got = language.identify(rows, language.fit(odd_docs), ["doc_id"]).collect()
    assert len(got) == odd_docs.count() and {r["lang"] for r in got} == {"en"}
    none = language.identify(rows, language.fit(no_docs), ["doc_id"]).collect()
    assert len(none) == odd_docs.count() and {r["lang"] for r in none} == {None}


def test_mixing_meets_targets(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    domain = labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("domain"))
    model = mixing.fit(docs, domain)
    got = mixing.mix(docs, model, {"good": 0.6, "poor": 0.4})
    p = got.select("n_tokens", "rate", "copies", "p").toPandas()
    soft = np.stack(p.p.to_list())
    total = (p.rate * p.n_tokens).to_numpy() @ soft
    assert np.abs(total / p.n_tokens.sum() - [0.6, 0.4]).max() < 2e-3
    assert (p.rate >= 0).all() and (np.abs(p.copies - p.rate) < 1).all()
    known = got.join(domain.withColumnRenamed("domain", "d"), "doc_id")
    assert known.where("domain = d").count() > 0.8 * known.count()


def test_mixing_edges(spark, odd_docs, no_docs):
    domain = odd_docs.where("doc_id is not null").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("domain"))
    model = mixing.fit(odd_docs, domain)
    got = mixing.mix(odd_docs, model, {"a": 1, "nobody": 5}).collect()
    assert len(got) == odd_docs.count() and all(r["rate"] >= 0 for r in got)
    assert mixing.mix(no_docs, model, {"a": 1}).count() == 0
    alone = mixing.fit(odd_docs, domain.limit(0))
    assert mixing.mix(odd_docs, alone, {}).count() == odd_docs.count()


def test_lm_learns_rare_contexts(spark):
    """A phrase far below any fixed share of a corpus is predicted by its contexts."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"v{rng.randrange(5000)}" for _ in range(200))) for i in range(1500)]
    phrase = " ".join(f"rare{j}" for j in range(12))
    held = next(i for i in range(2000, 9999) if zlib.crc32(str(i).encode()) % 10 == 0)
    train = [i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 10][:4]
    rows += [(i, phrase) for i in (*train, held)]
    got = {r["doc_id"]: r for r in lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held]["held_out"] and got[held]["score"] > got[held]["base_score"] + 12


def test_mixing_against_an_independent_solver(spark, monkeypatch):
    """Rates come as near to targets that can be met as many small steps of a plain solver do."""
    share = (0.6, 0.3, 0.1)
    rng = np.random.default_rng(6)
    p, tokens = rng.dirichlet([2.0, 2.0, 0.7], 400), rng.integers(1, 200, 400)
    rows = spark.createDataFrame([(i, int(t), x.tolist()) for i, (x, t) in enumerate(zip(p, tokens, strict=True))], "id long, n_tokens long, p array<double>")
    monkeypatch.setattr(mixing, "posteriors", lambda *_: rows)
    model = mixing.Softmax(list("abc"), np.zeros((1, 3)), np.zeros((7, 3)))
    got = mixing.mix(rows, model, dict(zip("abc", share, strict=True))).toPandas().sort_values("doc_id")
    total, goal = tokens.sum(), np.array(share)
    moments = (p * tokens[:, None]).T @ p / total
    metric = np.linalg.inv(moments + 1e-4 * np.trace(moments) / 3 * np.eye(3))
    off = lambda rate: (tokens * rate) @ p / total - goal
    rate = np.ones(400)
    for _ in range(4000):
        rate = np.maximum(rate - 0.5 * (p @ (metric @ off(rate))), 0)
    mine, best = (x @ metric @ x for x in (off(got.rate.to_numpy()), off(rate)))
    assert mine <= 1.05 * best + 1e-5
    assert got.miss.iloc[0] == pytest.approx(np.abs(off(got.rate.to_numpy())).max(), abs=1e-9)


def test_sample_of_a_class_with_most_labels(spark):
    """The ids of a class are the first by hash, though it is searched by parts."""
    rows = [(i, f"text {i}", "a" if i % 50 else "b") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = sample.labelled_sample(docs, docs, 30, 100).to_pydict()
    turn = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(11))).collect()}
    for label in "ab":
        want = sorted((i for i, _, own in rows if own == label), key=lambda i: (turn[i], i))[:30]
        assert sorted(i for i, own in zip(got["doc_id"], got["label"], strict=True) if own == label) == sorted(want)


def test_tables_are_cleared(spark):
    """Tables of the shared folder go with `clear`, or one by one."""
    one = scratch.materialize(spark.range(3), "one")
    two = scratch.materialize(spark.range(3), "two")
    scratch.discard(one)
    assert two.count() == 3
    scratch.clear(spark)
    for gone in (one, two):
        with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
            gone.count()
    assert scratch.materialize(spark.range(3), "three").count() == 3


def test_sample_has_every_class(spark):
    rows = [(i, f"text {i}", f"l{i % 90:02d}") for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = Counter(sample.labelled_sample(docs, docs, 3, 100).column("label").to_pylist())
    assert got == {f"l{i:02d}": 3 for i in range(90)}


def test_mixing_goes_on_to_targets(spark, monkeypatch):
    """Posteriors that overlap and targets far from the natural shares take many plain steps."""
    rng = np.random.default_rng(3)
    lang = rng.dirichlet([0.3] * 4, 3000)
    poor = 1 / (1 + np.exp(-rng.normal(0.0, 2.0, 3000)))
    soft = np.stack([lang * (1 - poor)[:, None], lang * poor[:, None]], axis=2).reshape(3000, 8)
    rows = spark.createDataFrame([(i, 100, p.tolist()) for i, p in enumerate(soft)], "id long, n_tokens long, p array<double>")
    monkeypatch.setattr(mixing, "posteriors", lambda *_: rows)
    share = np.array([0.45, 0.05, 0.15, 1 / 60, 0.15, 1 / 60, 0.15, 1 / 60])
    model = mixing.Softmax([f"d{i}" for i in range(8)], np.zeros((1, 8)), np.zeros((7, 8)))
    got = mixing.mix(rows, model, {f"d{i}": x for i, x in enumerate(share)}).toPandas()
    total = (got.rate * got.n_tokens).to_numpy() @ np.stack(got.p.to_list()) / got.n_tokens.sum()
    assert np.abs(total - share / share.sum()).max() < mixing.TOLERANCE
    assert got.miss.iloc[0] == pytest.approx(np.abs(total - share / share.sum()).max(), abs=1e-9)


def test_lm_disk(spark, monkeypatch):
    """Tables and shuffle files of a run stay within a few times the text, however long contexts grow."""
    rng = random.Random(8)
    pool = [prose(rng, 1)[:3] + str(rng.randrange(3000)) for _ in range(20_000)]
    rows = [(i, " ".join(rng.choice(pool[: 10 ** rng.randrange(1, 5)]) for _ in range(400))) for i in range(1500)]
    rows += [(5000 + i, rows[i][1]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shuffles = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [scratch.shared_dir(spark).removeprefix("file://"), *shuffles]
    used = lambda: sum(f.stat().st_size for d in folders for f in Path(d).rglob("*") if f.is_file())
    before, most, real = used(), [0], lm_score.materialize

    def watched(*args, **options):
        out = real(*args, **options)
        most.append(used() - before)
        return out

    monkeypatch.setattr(lm_score, "materialize", watched)
    assert lm_score.score_texts(docs).count() == len(rows)
    assert max(most) < 3 * sum(len(t) for _, t in rows)


def test_lm_contexts_behind_words_that_are_none(spark, monkeypatch):
    """"a b c" is a context though "b" is none: what follows "b" need not matter to what follows "b c"."""
    rng = random.Random(11)
    common = [f"w{i}" for i in range(17)] + ["a", "b", "c"]
    rows = [(i, " ".join(rng.choice(common) for _ in range(50))) for i in range(250)]
    ids = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10][:22]
    rows += [(i, "a b c z") for i in ids]
    tokens = [_tokens(t) for _, t in rows]
    train = [t for (i, _), t in zip(rows, tokens, strict=True) if zlib.crc32(str(i).encode()) % 10]
    want, _, chance, words = _tree_brute(train, tokens)
    assert all(chance(("b",), w) == chance((), w) for w in words) and chance(("a", "b", "c"), "z") > chance(("b", "c"), "z") + 0.1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for often in (lm_score.OFTEN, 40):  # then with contexts that are dealt to several ranges
        monkeypatch.setattr(lm_score, "OFTEN", often)
        got = {r["doc_id"]: r["score"] for r in lm_score.score_texts(docs).collect()}
        assert all(got[i] == pytest.approx(x, rel=1e-5) for (i, _), x in zip(rows, want, strict=True))


def test_lm_blocks_shrink(spark, monkeypatch):
    """Texts are dealt evenly to blocks without a small last one, and words that no open place can read leave them."""
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice("abcd") + rng.choice(["", *map(str, range(20))]) for _ in range(300))) for i in range(120)]
    size = sum(len(t) for _, t in rows)
    blocks, real = [], lm_score.materialize

    def watched(df, name, *args, **options):
        out = real(df, name, *args, **options)
        if name == "lm-blocks":
            blocks.append([(len(lm_score._grow(pa.scalar(bytes(r["words"]), pa.binary()), np.uint32)), r["n_open"]) for r in out.select("words", "n_open").collect()])
        return out

    monkeypatch.setattr(lm_score, "materialize", watched)
    monkeypatch.setattr(lm_score, "SCORED_BYTES", size // 3 + 1)
    got = lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert got.agg(F.sum("n_tokens")).first()[0] == 120 * 301
    assert len(blocks[0]) == 3 and all(abs(n - 40 * 301) <= 2 * 301 for n, _ in blocks[0])
    left = [sum(n for n, _ in x) for x in blocks]
    assert all(b <= a for a, b in zip(left, left[1:], strict=False)) and left[-1] == 0
    assert all((n > 0) == (o > 0) for x in blocks for n, o in x)


def test_lm_sums_however_dealt():
    """The sums that judge a context are the same to the last bit, however its next words are dealt or ordered."""
    rng = np.random.default_rng(13)
    for kinds in (50, 20_000):
        n = rng.zipf(1.2, kinds) % 1_000_000 + 2
        p = rng.dirichlet(np.full(kinds, 0.3)).astype(np.float32).astype(float) + 1e-9
        sums = lambda own: lm_score._sums(np.zeros(len(n[own]), dtype=np.int64), n[own], p[own], 1)  # noqa: E731,B023
        whole = sums(np.arange(kinds))
        assert whole[2:-1].sum() == pytest.approx((n * np.log(n / p)).sum(), rel=1e-9) and whole[1] == pytest.approx(p.sum(), rel=1e-9)
        for spread in (2, 3, 7):
            assert (whole == sum(sums(np.arange(turn, kinds, spread)) for turn in range(spread))).all()
        assert (whole == sums(np.arange(kinds)[::-1])).all()


def test_lm_messages_go_together(spark, monkeypatch):
    """A block sends its messages in few batches, as their number grows with ranges and blocks."""
    rng = random.Random(14)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(100))) for i in range(100)]
    tables, real = [], lm_score.materialize

    def watched(df, name, *args, **options):
        out = real(df, name, *args, **options)
        if name == "lm-blocks" and len(tables) < 2:  # cut, then with the counts of words
            tables.append(out.toArrow())
        return out

    monkeypatch.setattr(lm_score, "materialize", watched)
    lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).count()
    sent = list(lm_score._ask(1, 6, lm_score._often([]))(iter(tables[1].to_batches())))
    assert sum(x.num_rows for x in sent) > 50 and len(sent) <= 3
    assert sorted(p for x in sent for p in x.column("part").to_pylist()) == sorted({p for x in sent for p in x.column("part").to_pylist()})
