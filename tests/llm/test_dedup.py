from __future__ import annotations

import hashlib
import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parlance.llm.exact_dedup import Directory, build_directory, exact_dedup, keep_exact
from parlance.llm.near_dedup import keep_near, near_duplicates

from .conftest import SPACE, lower, prose


def test_directory_splits_overfull_buckets():
    cells = {0: 50, 1: 60, 2: 1, 3: 1, 7: 40}
    got, doublings, over = build_directory(cells, 64, bits=3)
    load = defaultdict(int)
    for c, n in cells.items():
        load[got[c]] += n
    assert max(load.values()) <= 64 and got == sorted(got) and len(got) == 8 and doublings == 3 and not over
    assert build_directory({0: 10**9}, 64, bits=3)[2]
    assert build_directory({}, 64, bits=3) == ([0] * 8, 0, False)


def test_directory_doubles_and_names_hot_keys(spark):
    rows = [(i, f"text {i}") for i in range(600)] + [(1000 + i, "copy") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = Directory(docs, F.col("text"))
    assert made.doublings >= 3 and len(set(made.cells)) >= 8 and len(made.hot) == 1
    fine = Directory(docs, F.col("text"), capacity=1)  # cells as fine as it takes for one key a bucket
    assert len(set(fine.cells)) >= 601 and fine.bits > made.bits
    got = exact_dedup(docs).collect()
    assert len({r["bucket"] for r in got}) >= 8 and {r["chain"] for r in got} == {0}
    assert {r["group_size"] for r in got if r["doc_id"] >= 1000} == {200} and {r["keep_id"] for r in got if r["doc_id"] >= 1000} == {1199}
    assert keep_exact(docs).count() == 601


@pytest.mark.parametrize(("capacity", "key_bits"), [(None, 64), (2, 64), (2, 3), (None, 0)])
def test_exact_edges(odd_docs, capacity, key_bits):
    """Short keys collide, so chains hold several texts and only their bytes tell them apart."""
    groups = defaultdict(list)
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    for i, t in rows:
        groups[t].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(((i, keep[t], len(groups[t]), i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows), key=repr)
    got = exact_dedup(odd_docs, capacity=capacity, key_bits=key_bits).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want
    if key_bits < 64:
        assert max(r["chain"] for r in got) > 0


def test_exact_of_colliding_hot_keys(spark):
    """All texts share a key that most rows have."""
    rows = [(i, f"text {i % 3}" if i % 2 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup(docs, key_bits=0).collect()}
    assert got == {i: max(j for j, u in rows if u == t) for i, t in rows}
    assert sorted(map(tuple, keep_exact(docs, key_bits=0).collect()), key=repr) == sorted(((i, t) for i, t in rows if got[i] == i), key=repr)


def test_exact_stage_keeps_one(odd_docs, no_docs):
    got = keep_exact(odd_docs)
    assert got.columns == odd_docs.columns
    rows = [r["text"] or "" for r in got.collect()]
    assert len(rows) == len(set(rows)) == len({r["text"] or "" for r in odd_docs.collect()})
    assert exact_dedup(no_docs).count() == 0 and keep_exact(no_docs).count() == 0


def shingles(text, k):
    w = SPACE.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = root(i), root(j)
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


@pytest.mark.parametrize("k", [2, 5])
def test_near_edges(odd_docs, no_docs, k):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    want = brute(rows, k, 80)
    got = near_duplicates(odd_docs, shingle=k).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    assert near_duplicates(no_docs, shingle=k).count() == 0


@pytest.mark.parametrize(("seed", "percent", "exact"), [(1, 80, None), (3, 80, True), (4, 50, None)])
def test_near_groups(spark, seed, percent, exact):
    """Chains, near copies on both sides of the threshold, short texts, and a large group."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        n = rng.choice((4, 8, 20, 60, 90, 150, 400))
        words = prose(rng, n).split()
        for _ in range(rng.choice((2, 3, 9))):
            own = list(words)
            for _ in range(rng.randrange(0, max(1, n // (12 if percent > 60 else 5)) + 1)):
                own[rng.randrange(n)] = f"w{rng.randrange(10**6)}"
            rows.append(" ".join(own))
    words = prose(rng, 100).split()
    for _ in range(300):
        own = list(words)
        for _ in range(rng.randrange(0, 8)):
            own[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        rows.append(" ".join(own))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want = brute(rows, 2, percent)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2, percent=percent, exact=exact).collect()}
    assert got == want


def test_near_stage(odd_docs):
    got = keep_near(odd_docs)
    assert got.columns == odd_docs.columns
    ids = {r["doc_id"] for r in got.collect()}
    assert {1, 4, 5, 6, 7, None} <= ids and not {2, 3, 8, 11} & ids


def test_near_repeated_rows(spark):
    """Lists of the same size and largest id stay apart when every row occurs twice."""
    rng = random.Random(11)
    rows = []
    for g in range(150):
        words = [f"w{rng.randrange(10**9)}" for _ in range(60)]
        end = [f"w{rng.randrange(10**9)}" for _ in range(6)]
        rows += [(1000 + g, " ".join(words)), (g, " ".join(words[:-6] + end)), (500 + g, " ".join(words[-6:]))]
    want = brute(rows, 2, 80)
    got = near_duplicates(spark.createDataFrame(rows + rows, "doc_id long, text string"), shingle=2).collect()
    assert len(got) == 900 and {r["doc_id"]: r["component_id"] for r in got} == want
