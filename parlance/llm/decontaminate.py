"""Benchmark decontamination with suffix arrays over shards of the training text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import discard, materialize
from .text import ALNUM, map_blocks, segment_sums, words

WINDOW = 13
#: Characters of benchmark text that one pass over the documents sends to every task.
PASS_CHARS = 1 << 24
#: Benchmark words whose suffixes are looked up at a time.
PART_WORDS = 1 << 18
#: Bytes of training text in one shard.
SHARD_BYTES = 1 << 21
_NONE = hashlib.sha256(b"").hexdigest()


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `seq` sorted by the `depth` symbols that start there at least.

    Prefix doubling, after the first pass over tied positions only.
    """
    n = len(seq)
    sa = np.argsort(seq, kind="stable")
    ordered = seq[sa]
    head = np.ones(n, dtype=bool)
    head[1:] = ordered[1:] != ordered[:-1]
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[sa] = group + 1
    rank[n] = 0
    h = 1
    tied = np.flatnonzero(~head | np.append(~head[1:], False))
    while len(tied) and h < depth:
        at = sa[tied]
        second = rank[np.minimum(at + h, n)]
        own = rank[at]
        order = np.lexsort((second, own)) if n >= 1 << 31 else np.argsort(own * np.int64(n + 1) + second, kind="stable")
        at, own, second = at[order], own[order], second[order]
        sa[tied] = at
        head = np.ones(len(tied), dtype=bool)
        head[1:] = (own[1:] != own[:-1]) | (second[1:] != second[:-1])
        rank[at] = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))] + 1
        tied = tied[~head | np.append(~head[1:], False)]
        h *= 2
    return sa


def _narrow(seq: np.ndarray, sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search, in each range of `sa`, for suffixes with `symbol` at `depth`."""
    last = len(seq) - 1

    def bound(right: bool) -> np.ndarray:
        a, b = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                return a
            mid = (a[open_] + b[open_]) >> 1
            value = seq[np.minimum(sa[mid] + depth, last)]
            up = value <= symbol[open_] if right else value < symbol[open_]
            a[open_[up]] = mid[up] + 1
            b[open_[~up]] = mid[~up]

    return bound(False), bound(True)


class TestBlock:
    """Words of some benchmark items, with a window length for each suffix."""

    def __init__(self, ids: list[str], keys: np.ndarray, first: np.ndarray) -> None:
        self.ids = ids
        self.keys = keys
        self.first = first
        size = np.diff(first)
        self.item = np.repeat(np.arange(len(ids)), size)
        self.stop = first[1:][self.item]
        left = self.stop - np.arange(len(keys))
        #: 13 where a whole window starts, the item's length at the start of a short item, else 0
        self.window = np.where(size[self.item] >= WINDOW, np.where(left >= WINDOW, WINDOW, 0), np.where(left == size[self.item], size[self.item], 0))


class TestSet:
    """Benchmark items that one pass looks up: their ids, words and first words."""

    def __init__(self, ids: list[str], texts: list[str]) -> None:
        found = words(pa.array(texts, pa.string()), ALNUM)
        self.ids, self.keys, self.first = ids, found.keys(), found.first
        self.longest = int(found.counts.max()) if ids else 0

    def parts(self) -> Iterator[TestBlock]:
        """The items in blocks of about PART_WORDS words."""
        at = 0
        while at < len(self.ids):
            end = max(at + 1, int(np.searchsorted(self.first, self.first[at] + PART_WORDS, side="right")) - 1)
            yield TestBlock(self.ids[at:end], self.keys[self.first[at] : self.first[end]], self.first[at : end + 1] - self.first[at])
            at = end


def test_sets(benchmark: DataFrame, id_col: str, text_col: str, most: int | None = None) -> Iterator[TestSet]:
    """Benchmark items in sets of a bounded number of characters, read as a stream; an item without id or words is left out."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(id_col, text_col).toLocalIterator():
        if r[0] is None or not r[1]:
            continue
        if ids and size + len(r[1]) > (most or PASS_CHARS):
            yield TestSet(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(str(r[0]))
        texts.append(r[1])
        size += len(r[1])
    if ids:
        yield TestSet(ids, texts)


def _flat(sa: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Positions in the ranges of `sa`, one range after the other."""
    size = hi - lo
    ends = np.cumsum(size)
    return sa[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(lo, size)]


def search_shard(seq: np.ndarray, sa: np.ndarray, test: TestBlock) -> tuple[np.ndarray, ...]:
    """Every occurrence of every window (position, length, item), and for every test suffix, where WINDOW words of it or more occur, the longest match there (position, length, suffix)."""
    n = len(test.keys)
    lo, hi = np.zeros(n, dtype=np.int64), np.full(n, len(sa), dtype=np.int64)
    at = np.arange(n)
    hits, spans = [], []
    depth = 0

    def leave(a: np.ndarray, b: np.ndarray, j: np.ndarray) -> None:
        """Matches of `depth` words that don't go on."""
        if depth >= WINDOW and (b > a).any():
            spans.append((_flat(sa, a, b), np.full(int((b - a).sum()), depth), np.repeat(j, b - a)))

    while len(at):
        low, high = _narrow(seq, sa, lo, hi, depth, test.keys[at + depth])
        leave(lo, low, at)
        leave(high, hi, at)
        alive = low < high
        at, lo, hi = at[alive], low[alive], high[alive]
        depth += 1
        whole = test.window[at] == depth
        if whole.any():
            a, b, j = lo[whole], hi[whole], at[whole]
            hits.append((_flat(sa, a, b), np.repeat(test.window[j], b - a), np.repeat(test.item[j], b - a)))
        more = at + depth < test.stop[at]
        leave(lo[~more], hi[~more], at[~more])
        at, lo, hi = at[more], lo[more], hi[more]
    return tuple(x for found in (hits, spans) for x in ([np.concatenate(y) for y in zip(*found, strict=True)] if found else [np.zeros(0, dtype=np.int64)] * 3))


#: What a pass finds of a row, for the next one: hit words as starts and stops, items, and the longest match.
_LONGEST = [T.StructField("longest", T.LongType()), T.StructField("longest_item", T.StringType()), T.StructField("longest_word", T.LongType())]
_STATE = T.StructType([T.StructField("hits", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType())), *_LONGEST])
_FOUND = T.StructType([*(T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "n_items")), T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()), *_LONGEST])


def _look_up(docs: DataFrame, text: str, tests: TestSet | None, share: float, stated: bool, last: bool, drop: bool) -> DataFrame:
    """One pass over `docs`: its columns with what `tests` has of each row and, if `stated`, the earlier passes had."""
    shared = docs.sparkSession.sparkContext.broadcast(tests)
    percent = round(1 / share)
    own = [f for f in docs.schema if not stated or f.name not in _STATE.names]

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        tests = shared.value
        found = words(batch.column(text), ALNUM)
        rows, counts = found.rows, found.counts
        first = found.first + np.arange(rows + 1)
        # one separator after each document; no window holds it
        place = np.arange(len(found.row)) + found.row
        cover = np.zeros(len(found.row) + rows + 1, dtype=np.int32)
        items: list[set[str]] = [set()] * rows
        longest, longest_word = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
        longest_item: list[str | None] = [None] * rows
        if stated:
            for i, (hits, names) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                items[i] = set(names)
                np.add.at(cover, np.array(hits[::2], dtype=np.int64) + first[i], 1)
                np.add.at(cover, np.array(hits[1::2], dtype=np.int64) + first[i], -1)
            longest, longest_word = (batch.column(c).to_numpy().copy() for c in ("longest", "longest_word"))
            longest_item = batch.column("longest_item").to_pylist()
        if tests is not None and len(found.row):
            seq = np.zeros(len(found.row) + rows, dtype=np.uint64)
            seq[place] = np.maximum(found.keys(), 1)
            owner = np.repeat(np.arange(rows), counts + 1)
            sa = suffix_array(seq, max(tests.longest, WINDOW))
            for test in tests.parts():
                if not len(test.keys):
                    continue
                position, width, item, spot, length, suffix = search_shard(seq, sa, test)
                np.add.at(cover, position, 1)
                np.add.at(cover, position + width, -1)
                pairs = np.unique(owner[position] * np.int64(len(test.ids)) + item)
                for doc, it in zip(*divmod(pairs, len(test.ids)), strict=True):
                    items[doc] = items[doc] | {test.ids[it]}
                # of each document the longest, then the first in the benchmark and in the document
                doc = owner[spot]
                order = np.lexsort((spot, suffix, -length, doc))
                for i in order[np.flatnonzero(np.diff(doc[order], prepend=-1))]:
                    d = doc[i]
                    if length[i] > longest[d]:
                        longest[d], longest_item[d], longest_word[d] = length[i], test.ids[test.item[suffix[i]]], spot[i] - first[d]
        hit = np.cumsum(cover[:-1]) > 0
        kept = [batch.column(f.name) for f in own]
        if not last:
            edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
            spans = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)
            of = np.repeat(np.arange(rows), counts + 1)[spans[:, 0]] if len(spans) else np.zeros(0, dtype=np.int64)
            spans -= first[of][:, None]
            lists = [spans[of == d].ravel().tolist() for d in range(rows)]
            state = [pa.array(lists, pa.list_(pa.int64())), pa.array([sorted(s) for s in items], pa.list_(pa.string())), pa.array(longest), pa.array(longest_item, pa.string()), pa.array(longest_word)]
            return pa.RecordBatch.from_arrays([*kept, *state], [*(f.name for f in own), *_STATE.names])
        n_hit = segment_sums(hit.astype(np.int64), first)
        dirty = (n_hit > 0) & (percent * n_hit >= counts)
        if drop:
            return pa.RecordBatch.from_arrays(kept, [f.name for f in own]).filter(pa.array(~dirty))
        sha = [hashlib.sha256(",".join(sorted(s)).encode()).hexdigest() if s else _NONE for s in items]
        result = [pa.array(counts.astype(np.int64)), pa.array(n_hit), pa.array([len(s) for s in items], pa.int64()), pa.array(sha, pa.string()), pa.array(dirty), pa.array(longest), pa.array(longest_item, pa.string()), pa.array(longest_word)]
        return pa.RecordBatch.from_arrays([*kept, *result], [*(f.name for f in own), *_FOUND.names])

    extra = list(_STATE) if not last else [] if drop else list(_FOUND)
    return map_blocks(docs, text, judge, T.StructType([*own, *extra]), SHARD_BYTES)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", share: float = 0.05, carry: list[str] | None = None, drop: bool = False, pass_chars: int = PASS_CHARS) -> DataFrame:
    """Words of each document that lie in a benchmark window, and which items they come from.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased;
    a window is 13 words of an item, or the whole of a shorter one. Each task
    sorts the suffixes of a shard of documents and binary-searches every
    benchmark suffix in it; an occurrence never crosses documents. A pass over
    the documents sends every task at most `pass_chars` characters of benchmark
    text (or one longer item); a larger benchmark takes several passes, each
    adding to what the earlier ones found. Nothing is shuffled.

    Returns id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit at
    least `share` of n_words, and some), longest (words of the longest verbatim
    match), longest_item and longest_word (where it starts), then the `carry`
    columns but those named like one of these. With `drop`, clean rows only and
    `carry` columns only. A null text has no words; items without id or words
    match nothing; repeated items count once; repeated documents are judged
    alike; of equally long matches the first in the benchmark counts; empty
    tables give no rows, or no hits.
    """
    names = list(dict.fromkeys([id_col, text_col, *(carry or [])]))
    at = {c: f"c{i}" for i, c in enumerate(names)}
    rows = docs.select(*(F.col(f"`{c}`").alias(at[c]) for c in names))
    sets = test_sets(benchmark, item_col, text_col, pass_chars)
    tests, following = next(sets, None), next(sets, None)
    stated, held = False, None
    while following is not None:
        done = materialize(_look_up(rows, at[text_col], tests, share, stated, False, drop), "decontamination")
        discard(held)
        rows, stated, held = done, True, done
        tests, following = following, next(sets, None)
    out = _look_up(rows, at[text_col], tests, share, stated, True, drop)
    if drop:
        return out.select(*(F.col(at[c]).alias(c) for c in carry or []))
    return out.select(F.col(at[id_col]).alias(id_col), *_FOUND.names, *(F.col(at[c]).alias(c) for c in carry or [] if c != id_col and c not in _FOUND.names))
