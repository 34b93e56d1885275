"""Language-model scores by a probabilistic suffix tree over words.

A context is a state of the tree if it occurs at least twice, its suffix is a
state (or it is one word), and its next-word distribution diverges from that of
its suffix by more than chance would make it. Contexts grow by a word as long
as any of the last length became a state. Each state keeps the next words it
has at least twice, smoothed towards its suffix, and gives the rest of its mass
in the proportions of the suffix. A word is predicted by the longest suffix of
what precedes it that is a state; the root is the discounted word distribution.

Texts lie in blocks. At each length a block tells the range of keys that a
context belongs to how often it has the context and which next words follow,
with their probabilities after its suffix. The range adds up all blocks, judges
the context and answers each block, which brings its own probabilities one word
further. Places whose context is no state, or occurs once, are settled and ask
no more; a next word that occurs once after the suffix is only counted. So a
length costs two exchanges of the places that are still open. A context that
occurs very often is dealt to several ranges by its next words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import fold
from .scratch import discard, materialize
from .text import NOT_SPACE, mix, release, released, segment_sums, text_buffer, words

#: Least count of a context, and of a context with its next word, at any size of the corpus.
LEAST = 2
#: Occurrences by which a state is smoothed towards its suffix.
PRIOR = 10.0
#: Training bytes a range of keys.
RANGE_BYTES = 1 << 24
#: Bytes of text that ask and are scored together.
SCORED_BYTES = 1 << 23
#: Occurrences of a context a range that it is dealt to.
OFTEN = 1 << 21
#: Nothing reads it any more: the states never travel as a list. A test sets it, and results must not depend on it.
FEW_STATES = 1 << 20
#: Messages of a block that are sent together.
SENT = 32
END = np.uint64(0x8F3A5C2B71D4E690)
#: Bits of a next word's key that don't travel: two next words of a context are taken for one about once in 2**48 pairs.
SPARED = np.uint64(16)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
    count = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[head], np.add.reduceat(count, head) if len(key) else count


def _ranges(key: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the 2**bits ranges in the sorted `key`."""
    if not bits:
        return np.array([0, len(key)])
    lows = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(key, lows), len(key))


def _find(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Index of every key in the sorted table, -1 where it has none."""
    if not len(table):
        return np.full(len(key), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return np.where(table[at] == key, at, -1)


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, where each occurs first, and which one each element has."""
    bits = np.uint64(len(key).bit_length())
    at = np.arange(len(key), dtype=np.uint64)
    small = len(key) and not int(key.max()) >> (64 - int(bits))
    # the index in the low bits makes one sort of numbers do
    at |= key << bits if small else key >> bits << bits
    at.sort()
    order = (at & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    found = at >> bits if small else key[order]
    if not small and (found[1:] < found[:-1]).any():  # keys that differ in the low bits alone
        order = np.argsort(key, kind="stable")
        found = key[order]
    head = np.ones(len(key), dtype=bool)
    head[1:] = found[1:] != found[:-1]
    which = np.empty(len(key), dtype=np.int32)
    which[order] = np.cumsum(head, dtype=np.int32) - 1
    return found[head], order[head], which


def _sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token keys of the texts with an end after each, and where each row begins."""
    found = words(column, NOT_SPACE)
    key = np.full(len(found.row) + found.rows, END, dtype=np.uint64)
    key[np.arange(len(found.row)) + found.row] = found.keys()
    return key, found.first + np.arange(found.rows + 1)


def _gram(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9FB21C651E98DF25) + right)


def _shrink(values: np.ndarray) -> bytes:
    """Compressed bytes of an array of 32-bit floats, or of integers not below 0, by planes of bytes of the same weight; the highest, where all are 0, are left out."""
    bits = values.view(np.uint32) if values.dtype.kind == "f" else values
    width = (int(bits.max()).bit_length() + 7) // 8 if len(bits) else 0
    planes = np.empty((width, len(bits)), dtype=np.uint8)
    for k in range(width):
        np.right_shift(bits, 8 * k, out=planes[k], casting="unsafe")
    return bytes([width]) + len(bits).to_bytes(8, "little") + (pa.Codec("zstd", 1).compress(planes.reshape(-1), asbytes=True) if width else b"")


def _grow(data: pa.Scalar, kind: type) -> np.ndarray:
    """The array that `_shrink` was given."""
    buffer = data.as_buffer()
    head = buffer[:9].to_pybytes()
    width, size = head[0], int.from_bytes(head[1:], "little")
    wide = np.uint32 if kind is np.float32 else kind
    if not width:
        return np.zeros(size, dtype=kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(buffer[9:], width * size), dtype=np.uint8).reshape(width, size)
    out = planes[0].astype(wide)
    for k in range(1, width):
        out |= planes[k].astype(wide) << wide(8 * k)
    return out.view(kind)


def _plain(data: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), dtype=kind)


def _freed(run: Callable) -> Callable:
    """`run` over a group, giving back memory after it."""

    def whole(*tables: pa.Table) -> pa.Table:
        try:
            return run(*tables)
        finally:
            release()

    # Spark tells by the number of arguments what it passes
    return (lambda table: whole(table)) if run.__code__.co_argcount == 1 else lambda own, got: whole(own, got)


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) if isinstance(x, bytes) else x if isinstance(x, pa.Array) else pa.array([x]) for x in columns.values()], list(columns))


#: Of a block: keys of its words by frequency, the words that can still be read, places that are still open, and which of them may follow their context LEAST times, the probabilities of these (before contexts of one word: those of the words), and by row its tokens, what is known and the scores of the settled places.
_BLOCK = "first binary, tokens binary, vocab binary, words binary, open binary, twice binary, p binary, known binary, base binary, score binary, n_open long"


class Often(NamedTuple):
    """Contexts that are dealt to several ranges: sorted keys, and to how many."""

    key: np.ndarray
    spread: np.ndarray


def _often(rows: list) -> Often:
    """The contexts that answers name for the next depth."""
    key = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.frombuffer(r["grown"], dtype=np.uint64) for r in rows)])
    size = np.concatenate([np.zeros(0, dtype=np.int64), *(np.frombuffer(r["sizes"], dtype=np.int64) for r in rows)])
    key, size = _merge([key], [size])
    return Often(key, -(-size // OFTEN))


class Asked(NamedTuple):
    """What a block asks at a depth."""

    first: np.ndarray  # by row: its first word
    word: np.ndarray
    vocab: np.ndarray
    at: np.ndarray  # open places
    context: np.ndarray  # distinct keys
    which: np.ndarray  # by place: its context
    twice: np.ndarray  # by place: whether context and next word may occur LEAST times
    of: np.ndarray  # by such place: its pair
    under: np.ndarray  # by pair: its context
    following: np.ndarray  # by pair: key of the next word
    p: np.ndarray  # by such place
    train: np.ndarray  # by place
    messages: list[tuple[int, np.ndarray, np.ndarray, bool]]  # range, contexts, pairs, whether the rest of the contexts' places is counted in it


def _places(first: np.ndarray, flags: list) -> np.ndarray:
    return np.repeat(np.array([x is False for x in flags], dtype=bool), np.diff(first))


def _open(block: dict, depth: int, bits: int, often: Often) -> Asked:
    """The questions of a block (a dictionary of scalars) about contexts of `depth` words."""
    first, vocab, word = _grow(block["first"], np.int64), _plain(block["vocab"], np.uint64), _grow(block["words"], np.uint32)
    flags = np.unpackbits(_grow(block["open"], np.uint8), count=len(word)).astype(bool)
    at = np.flatnonzero(flags)
    twice = np.unpackbits(_grow(block["twice"], np.uint8), count=len(at)).astype(bool)
    next_ = word[at[twice]]
    p = _grow(block["p"], np.float32)
    short = vocab >> SPARED
    if depth == 1:
        p = p[next_]
        # keys of words: sort the few, not the many
        present = np.zeros(len(vocab), dtype=bool)
        present[word[at - 1]] = True
        names = np.flatnonzero(present)
        names = names[np.argsort(vocab[names])]
        place = np.zeros(len(vocab), dtype=np.int64)
        place[names] = np.arange(len(names))
        context, which = vocab[names], place[word[at - 1]]
    else:
        key = vocab[word[at - depth]]
        for back in range(depth - 1, 0, -1):
            key = _gram(key, short[word[at - back]])
        context, _, which = _grouped(key)
    pair, _, of = _grouped(which[twice].astype(np.uint64) * np.uint64(len(vocab)) + next_)
    under = (pair // np.uint64(max(1, len(vocab)))).astype(np.int64)
    following = short[pair.view(np.int64) - under * len(vocab)]

    hot = _find(often.key, context)
    bounds = _ranges(context, bits)
    pairs = np.searchsorted(under, bounds)
    messages = []
    for part in np.flatnonzero(bounds[1:] > bounds[:-1]):
        own, ones = np.arange(bounds[part], bounds[part + 1]), np.arange(pairs[part], pairs[part + 1])
        if (hot[own] >= 0).any():
            for one in own[hot[own] >= 0]:
                these = np.arange(*np.searchsorted(under, [one, one + 1]))
                spread = int(often.spread[hot[one]])
                share = following[these] % np.uint64(spread)
                for turn in range(spread):
                    if turn == 0 or (share == turn).any():
                        messages.append(((int(part) + turn) % (1 << bits), np.array([one]), these[share == turn], turn == 0))
            own, ones = own[hot[own] < 0], ones[hot[under[ones]] < 0]
        if len(own):
            messages.append((int(part), own, ones, True))
    return Asked(first, word, vocab, at, context, which, twice, of, under, following, p, _places(first, block["held_out"].as_py())[at], messages)


def _ask(depth: int, bits: int, often: Often) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = {name: batch.column(name)[i] for name in batch.schema.names}
                x = _open(block, depth, bits, often)
                release()
                n = np.bincount(x.of[x.train[x.twice]], minlength=len(x.under)).astype(np.uint32)
                rest = np.bincount(x.which[~x.twice & x.train], minlength=len(x.context)).astype(np.uint32)
                p = np.zeros(len(x.under), dtype=np.float32)
                p[x.of] = x.p
                bytes_ = np.ascontiguousarray(x.following.view(np.uint8).reshape(-1, 8)[:, :6])
                rows: list[tuple] = []
                for turn, (part, own, ones, whole) in enumerate(x.messages):
                    size = np.diff(np.searchsorted(x.under[ones], np.append(own, own[-1] + 1))).astype(np.uint32) if len(own) > 1 else np.array([len(ones)], dtype=np.uint32)
                    numbers = np.concatenate([size, rest[own] if whole else np.zeros(len(own), dtype=np.uint32), n[ones]])
                    rows.append((part, block["block"].as_py(), turn, x.context[own].tobytes(), bytes_[ones].tobytes(), _shrink(numbers), _shrink(p[ones])))
                    if len(rows) == SENT:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return released(run)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of `_ASKED`."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in _ASKED.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[t]) for x, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))


#: `numbers`: by context how many pairs it has and the rest of its places, by pair its places.
_ASKED = "part int, block long, turn int, contexts binary, following binary, numbers binary, p binary"
#: `numbers`: by context its weight, by pair its count.
_ANSWERED = "block long, turn int, factor binary, numbers binary, often binary, stats binary, grown binary, sizes binary"


def _sums(which: np.ndarray, n: np.ndarray, p: np.ndarray, kinds: int) -> np.ndarray:
    """By context, over its own next words: counts, their probabilities at the suffix, n * ln(n / p) in two parts, and how many.

    Terms are multiples of 2**-50, and of 2**-16 and 2**-40 in the two parts;
    their sums up to 8, 2**37 and 2**13 are exact: neither order nor dealing
    changes them.
    """
    if not len(n):
        return np.zeros((5, kinds))
    gain = n * np.log(n / p)
    coarse = np.rint(gain * 2.0**16) / 2.0**16
    terms = (n, np.rint(p * 2.0**50) / 2.0**50, coarse, np.rint((gain - coarse) * 2.0**40) / 2.0**40, np.ones(len(n)))
    return np.stack([np.bincount(which, weights=x, minlength=kinds) for x in terms])


def _judged(weight: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """log10 of the factor for other words of contexts that are states, else nan."""
    out = np.full(len(weight), np.nan, dtype=np.float32)
    some = np.flatnonzero(sums[4] > 0)
    seen, seen_parent, gain, more, bins = sums[:, some]
    keep, factor = judge(weight[some].astype(float), seen, seen_parent, gain + more, bins)
    out[some[keep]] = factor[keep]
    return out


def _answer(often: Often) -> Callable[[pa.Table], pa.Table]:
    """Judges the contexts of a range, and answers every message; of contexts that are dealt out, gives the sums of its share."""

    def run(asked: pa.Table) -> pa.Table:
        columns = {c: asked.column(c) for c in asked.column_names}
        contexts = [_plain(x, np.uint64) for x in columns["contexts"]]
        numbers = [np.split(_grow(x, np.uint32), [len(c), 2 * len(c)]) for c, x in zip(contexts, columns["numbers"], strict=True)]
        sizes = [x[0].astype(np.int64) for x in numbers]
        context, _, which = _grouped(np.concatenate(contexts))
        weight = np.bincount(which, weights=np.concatenate([x[1] for x in numbers]), minlength=len(context)).astype(np.int64)
        raw = np.concatenate([_plain(x, np.uint8).reshape(-1, 6) for x in columns["following"]])
        wide = np.zeros((len(raw), 8), dtype=np.uint8)
        wide[:, :6] = raw
        under = np.repeat(which, np.concatenate(sizes))
        pair, head, of = _grouped(_gram(context[under], wide.view(np.uint64).reshape(-1)))
        n = np.bincount(of, weights=np.concatenate([x[2] for x in numbers]), minlength=len(pair)).astype(np.int64)
        p = np.concatenate([_grow(x, np.float32) for x in columns["p"]])[head].astype(float)
        under = under[head]
        weight += np.bincount(under, weights=n, minlength=len(context)).astype(np.int64)
        own = n >= LEAST
        sums = _sums(under[own], n[own], p[own], len(context))
        factor = _judged(weight, sums)
        dealt = _find(often.key, context) >= 0
        factor[dealt] = np.nan
        weights = np.where(np.isnan(factor), 0, weight)
        out: dict[str, list] = {c: [] for c in ("factor", "numbers")}
        at = np.cumsum([0, *(len(x) for x in contexts)])
        pairs = np.cumsum([0, *(int(x.sum()) for x in sizes)])
        for i in range(asked.num_rows):
            mine = which[at[i] : at[i + 1]]
            out["factor"].append(_shrink(factor[mine]))
            out["numbers"].append(_shrink(np.concatenate([weights[mine], n[of[pairs[i] : pairs[i + 1]]]])))
        blank = [b""] * (asked.num_rows - 1)
        grown = n > OFTEN
        extra = {"often": context[dealt].tobytes(), "stats": np.vstack([weight[dealt], sums[:, dealt]]).astype(float).T.tobytes(), "grown": pair[grown].tobytes(), "sizes": n[grown].tobytes()}
        return pa.table({"block": columns["block"], "turn": columns["turn"]} | {c: pa.array(x, pa.binary()) for c, x in out.items()} | {c: pa.array([x, *blank], pa.binary()) for c, x in extra.items()})

    return run


def _settle(block: dict, word: np.ndarray, vocab: np.ndarray, depth: int, first: np.ndarray, at: np.ndarray, p: np.ndarray, state: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, dict]:
    """Which of the places `at` keep a probability for contexts of one word more than `depth` (at depth 0: words), and columns of the block after that.

    `p` are probabilities after contexts of `depth` words, `state` says which of
    these are states, and `n` counts contexts with their next word. Places go on
    behind a state, unless the longer context occurs once. Where the next word
    occurs once after the context, only factors are to come: its probability
    goes to the score and is 1 from there on. Words that neither
    these places nor longer contexts can read become the word 0, and all but the
    first in a row of such words go.
    """
    size = len(word)
    often = n >= LEAST
    repeated = np.ones(size + 1, dtype=bool)  # where not counted, it may occur often; the last is before no place
    repeated[at] = often
    deep = np.ones(size, dtype=bool)  # whether a row has `depth` words before a place, and then one more
    for back in range(depth):
        deep[(first[:-1] + back)[first[:-1] + back < first[1:]]] = False
    begin = deep & repeated[:-1]  # ends a gram that may occur again
    deep[(first[:-1] + depth)[first[:-1] + depth < first[1:]]] = False
    on = state & deep[at] & repeated[at - 1]
    if depth:  # behind a word that is left out, longer contexts occur once
        on &= word[np.maximum(at - depth - 1, 0)] > 0
    stays = on & often
    flags = np.zeros(size, dtype=bool)
    flags[at] = on
    settled = np.flatnonzero(~stays)
    score = segment_sums(np.log10(p[settled]), np.searchsorted(at[settled], first))

    read = np.zeros(size, dtype=bool)
    read[: max(0, size - depth)] = begin[depth:]
    for back in range(1, depth + 2):
        read[: max(0, size - back)] |= flags[back:]
    if depth:  # what has been left out before stays so
        read &= word > 0
    # contexts grow to the left without a gap: of a run of words, those up to the last before a place that goes on
    edge = np.zeros(size + 1, dtype=bool)
    edge[first] = True
    starts = np.flatnonzero(read & (edge[:-1] | ~np.append(False, read[:-1])))
    ends = np.flatnonzero(read & (edge[1:] | ~np.append(read[1:], False))) + 1
    places = np.flatnonzero(flags)
    last = np.append(places, 0)[np.searchsorted(places, ends, side="right") - 1]  # the run's end may be such a place
    cuts = np.maximum(last, starts)
    some = cuts < ends
    turns = np.zeros(size + 1, dtype=np.int8)
    turns[cuts[some]] = 1
    turns[ends[some]] -= 1
    read &= np.cumsum(turns[:-1], dtype=np.int8) == 0
    stay = np.zeros(size, dtype=bool)
    stay[at] = stays
    read |= stay
    kept = read | flags
    kept[1:] |= read[:-1]

    used = np.zeros(len(vocab), dtype=bool)
    used[word[read]] = True
    name = np.zeros(len(vocab), dtype=np.uint32)
    name[used] = np.arange(1, 1 + used.sum(), dtype=np.uint32)
    rows = np.searchsorted(np.flatnonzero(kept), first)
    columns = {"first": _shrink(rows), "open": _shrink(np.packbits(flags[kept])), "twice": _shrink(np.packbits(stays[on])), "score": (_plain(block["score"], np.float64) + score).tobytes(), "n_open": int(on.sum())}
    columns |= {"words": _shrink(np.where(read[kept], name[word[kept]], np.uint32(0))), "vocab": np.concatenate([np.zeros(1, dtype=np.uint64), vocab[used]]).tobytes()}
    return (stays if depth else used), columns


def judge(weight: np.ndarray, seen: np.ndarray, seen_parent: np.ndarray, gain: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether contexts are states, and log10 of their factors for other words.

    Of a context's own next words, `seen` adds up the counts, `seen_parent` the
    probabilities at its suffix and `gain` count * ln(count / probability).
    """
    rest, rest_parent = np.maximum(1 - seen / weight, 0), np.maximum(1 - seen_parent, 1e-12)
    divergence = (gain - seen * np.log(weight)) / weight + np.where(rest > 0, rest * np.log(np.maximum(rest, 1e-300) / rest_parent), 0)
    keep = 2 * weight * divergence > bins + 4 * np.sqrt(2 * bins) + 8
    left = np.maximum(weight - seen + PRIOR * rest_parent, 1e-3) / (weight + PRIOR)
    return keep, np.log10(left / rest_parent)


def step(parent: np.ndarray, scale: np.ndarray, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Probabilities after a context, from those after its suffix; a count under LEAST is no own next word. Of a context that is no state, the factor `scale` is 1 and the weight 0."""
    return np.where((count >= LEAST) & (weight > 0), (count + PRIOR * parent) / (weight + PRIOR), parent * scale)


def _often_judged(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, factors and weights of the contexts that were dealt out, from the sums of their shares."""
    key = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.frombuffer(r["often"], dtype=np.uint64) for r in rows)])
    stats = np.concatenate([np.zeros((0, 6)), *(np.frombuffer(r["stats"]).reshape(-1, 6) for r in rows)])
    context, which = np.unique(key, return_inverse=True)
    sums = np.stack([np.bincount(which, weights=x, minlength=len(context)) for x in stats.T])
    return context, _judged(sums[0], sums[1:]), sums[0].astype(np.int64)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_of: int = 10) -> DataFrame:
    """Scores of every text by a model of those whose crc32 of the id is not 0 modulo `held_out_of`.

    Words are runs of non-space characters, A-Z lower-cased; an end follows
    each text's words and counts as a token. Returns id, held_out, n_tokens,
    n_known (tokens that occur in training), train_tokens, base_score (add-0.1
    unigram log10 probability) and score (the tree's). A null text is empty and
    has the end alone; rows of a null id are scored and train nothing
    (held_out is null); repeated rows train as often as they occur and score
    alike. Unseen words are one symbol, whose probability is the share of
    words seen once. Contexts have as many words as the test finds worth it.
    Without training rows every score is 0. An empty table
    gives no rows; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"block long, ids array<{kind}>, held_out array<boolean>, {_BLOCK}"
    names = ["block", "ids", "held_out", *(x.split()[0] for x in _BLOCK.split(", "))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = text_buffer(batch.column(text_col))
            size = len(data)
            share = max(1, -(-size // SCORED_BYTES))
            bounds = np.unique(np.append(np.searchsorted(offsets, np.arange(share) * (size / share)), batch.num_rows))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = batch.slice(a, b - a)
                key, first = _sequence(own.column(text_col))
                vocab, _, word = _grouped(key)
                n = np.bincount(word)
                order = np.argsort(-n, kind="stable")
                place = np.empty(len(vocab), dtype=np.uint32)
                place[order] = np.arange(len(vocab), dtype=np.uint32)
                lists = {c: pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.concat_arrays([own.column(x)])) for c, x in (("ids", id_col), ("held_out", "held_out"))}
                zero = np.zeros(b - a).tobytes()
                yield _row(block=name, **lists, first=_shrink(first), tokens=_shrink(np.diff(first)), vocab=vocab[order].tobytes(), words=_shrink(place[word]), open=b"", twice=b"", p=b"", known=zero, base=zero, score=zero, n_open=len(key))
                name += 1

    source = docs.select(F.col(id_col), F.col(text_col), (fold(id_col, held_out_of) == 0).alias("held_out"))
    # few blocks a row group, as each is large
    save = lambda df, name: materialize(df, name, options={"parquet.block.row.count.limit": "8"} if name == "lm-blocks" else None, free=True)
    state = save(source.mapInArrow(released(cut), schema), "lm-blocks")
    tokens = state.agg(F.sum("n_open")).first()[0] or 0
    bits = max(4, int(np.ceil(np.log2(max(1, 6 * tokens / RANGE_BYTES)))))

    # a range a task, however few partitions the session has
    dealt = lambda asked: asked.repartition(1 << bits, "part").groupBy("part")

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = {c: batch.column(c)[i] for c in ("first", "vocab", "words", "held_out")}
                vocab, word = _plain(block["vocab"], np.uint64), _grow(block["words"], np.uint32)
                n = np.bincount(word[_places(_grow(block["first"], np.int64), block["held_out"].as_py())], minlength=len(vocab))
                order = np.argsort(vocab)
                key, n = vocab[order], n[order]
                at = _ranges(key, bits)
                for part in np.flatnonzero(at[1:] > at[:-1]):
                    here = slice(at[part], at[part + 1])
                    yield _row(part=pa.array([part], pa.int32()), block=batch.column("block")[i].as_py(), keys=key[here].tobytes(), counts=_shrink(n[here]))

    def answer_words(asked: pa.Table) -> pa.Table:
        keys = [_plain(x, np.uint64) for x in asked.column("keys")]
        key, n = _merge(keys, [_grow(x, np.int64) for x in asked.column("counts")])
        blank, grown = [0] * (asked.num_rows - 1), n > OFTEN
        extra = {"total": [int(n.sum()), *blank], "kinds": [int((n > 0).sum()), *blank], "once": [int((n == 1).sum()), *blank]}
        extra |= {c: pa.array([x[grown].tobytes(), *(b"" for _ in blank)], pa.binary()) for c, x in (("grown", key), ("sizes", n))}
        return pa.table({"block": asked.column("block"), "turn": asked.column("part"), "counts": pa.array([_shrink(n[_find(key, k)]) for k in keys], pa.binary())} | extra)

    asked = state.mapInArrow(released(ask_words), "part int, block long, keys binary, counts binary")
    answers = save(dealt(asked).applyInArrow(answer_words, "block long, turn int, counts binary, total long, kinds long, once long, grown binary, sizes binary"), "lm-words")
    total, distinct, once = (int(x or 0) for x in answers.agg(F.sum("total"), F.sum("kinds"), F.sum("once")).first())
    discount = min(once / distinct, 0.95) if distinct else 0.0
    log_rest = 0.1 * (distinct + 1) + total
    unknown = max(once, 1) / (total + (0 if once else 1)) if total else 1.0
    often = _often(answers.where("length(grown) > 0").select("grown", "sizes").collect())

    def carried(own: pa.Table, **changed) -> pa.Table:
        columns = {c: own.column(c) for c in names} | {c: pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int64()) for c, x in changed.items()}
        return pa.table(columns)

    def chance(n: np.ndarray) -> np.ndarray:
        return np.where(n > 0, np.maximum(n - discount, 0.05) / max(1, total), unknown)

    def begin(own: pa.Table, got: pa.Table) -> pa.Table:
        block = {c: own.column(c)[0] for c in names}
        first, vocab, word = _grow(block["first"], np.int64), _plain(block["vocab"], np.uint64), _grow(block["words"], np.uint32)
        count = np.empty(len(vocab), dtype=np.int64)
        count[np.argsort(vocab)] = np.concatenate([_grow(x, np.int64) for x in got.sort_by("turn").column("counts")])
        n, at, p = count[word], np.arange(len(word)), chance(count)
        base = segment_sums(np.log10(n + 0.1), first) - np.diff(first) * np.log10(log_rest)
        used, columns = _settle(block, word, vocab, 0, first, at, p[word], np.ones(len(at), dtype=bool), n)
        return carried(own, **columns, p=_shrink(np.append(1, p[used]).astype(np.float32)), known=segment_sums((n > 0).astype(np.int64), first).tobytes(), base=base.tobytes())

    def carry_on(depth: int, often: Often, judged: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def run(own: pa.Table, got: pa.Table) -> pa.Table:
            block = {c: own.column(c)[0] for c in names}
            if not block["n_open"].as_py():
                return carried(own)
            x = _open(block, depth, bits, often)
            factor, weight, count = np.full(len(x.context), np.nan, dtype=np.float32), np.zeros(len(x.context), dtype=np.int64), np.zeros(len(x.under), dtype=np.int64)
            turns = got.column("turn").to_pylist()
            for i, turn in enumerate(turns):
                _, own_, ones, _ = x.messages[turn]
                factor[own_] = _grow(got.column("factor")[i], np.float32)
                weight[own_], count[ones] = np.split(_grow(got.column("numbers")[i], np.int64), [len(own_)])
            dealt = _find(judged[0], x.context)
            factor[dealt >= 0], weight[dealt >= 0] = judged[1][dealt[dealt >= 0]], judged[2][dealt[dealt >= 0]]
            state = ~np.isnan(factor)
            weight[~state] = 0
            scale = np.exp(np.where(state, factor, 0) * np.log(10))
            n = np.zeros(len(x.at), dtype=np.int64)
            n[x.twice] = count[x.of]
            p = scale[x.which]  # where the next word occurs once, its probability has gone to the score
            p[x.twice] = step(x.p.astype(float), p[x.twice], weight[x.which[x.twice]], n[x.twice])
            stays, columns = _settle(block, x.word, x.vocab, depth, x.first, x.at, p, state[x.which], n)
            return carried(own, **columns, p=_shrink(p[stays].astype(np.float32)))

        return run

    def move(state: DataFrame, answers: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
        """The blocks after their answers; what they came from goes."""
        out = save(state.groupBy("block").cogroup(answers.drop("often", "stats", "grown", "sizes").groupBy("block")).applyInArrow(_freed(run), schema), "lm-blocks")
        discard(state)
        discard(answers)
        return out

    state, depth = move(state, answers, begin), 0
    while state.agg(F.sum("n_open")).first()[0]:
        depth += 1
        answers = save(dealt(state.where("n_open > 0").mapInArrow(_ask(depth, bits, often), _ASKED)).applyInArrow(_freed(_answer(often)), _ANSWERED), "lm-answers")
        told = answers.where("length(often) + length(grown) > 0").select("often", "stats", "grown", "sizes").collect()
        judged = _often_judged(told)
        state = move(state, answers, carry_on(depth, often, judged))
        often = _often(told)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = _grow(batch.column("tokens")[i], np.int64)
                known, base, score = (pa.array(_plain(batch.column(c)[i], t)) for c, t in (("known", np.int64), ("base", np.float64), ("score", np.float64)))
                columns = {"id": batch.column("ids")[i].values, "held_out": batch.column("held_out")[i].values, "n_tokens": pa.array(n), "n_known": known, "train_tokens": pa.array(np.full(len(n), total, dtype=np.int64)), "base_score": base, "score": score}
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([x]) for x in columns.values()], list(columns))

    out = state.select("ids", "held_out", "tokens", "known", "base", "score").mapInArrow(give, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
