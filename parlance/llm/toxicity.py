"""Toxic spans and document scores from a linear-chain conditional random field.

Documents carry labels, tokens don't: the training tokens are labelled by a
greedy cover that looks for the words and word beginnings that occur in
documents of label 1 and hardly in others. A two-state chain over the tokens of
each sentence learns them from hashed features; forward-backward marginals
give spans, and a logistic curve over what they add up to gives the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import fold, labelled_sample
from .text import ALNUM, Words, blocks, map_blocks, mix, segment_sums, words

#: Bound of the training sample: documents a label, and characters a document.
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 20_000
#: Bytes of text worked on at a time on the driver.
FIT_BYTES = 1 << 19
TABLE_BITS = 18
THRESHOLD = 0.7
#: Byte lengths of the word beginnings and endings that are features.
HEADS, TAILS = (3, 4, 5, 6, 7, 8), (3, 4)

_STOP = np.zeros(256, dtype=bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True


def feature_keys(found: Words, only: int | None = None) -> np.ndarray:
    """Keys of every token's features, one row a kind: word, beginnings, endings. 0 where a word is too short."""
    size = found.end - found.start
    out = []
    for kind in range(1 + len(HEADS) + len(TAILS)) if only is None else (only,):
        if kind == 0:
            x = found.keys()
        elif kind <= len(HEADS):
            k = HEADS[kind - 1]
            x = np.where(size >= k, found.keys(found.start, np.minimum(found.start + k, found.end)), 0)
        else:
            k = TAILS[kind - 1 - len(HEADS)]
            x = np.where(size >= k, found.keys(np.maximum(found.end - k, found.start), found.end), 0)
        out.append(np.where(x == 0, 0, mix(x ^ np.uint64((kind + 1) * 0x632BE59BD9B4E019 % (1 << 64)))))
    return np.stack(out)


def slots(keys: np.ndarray) -> np.ndarray:
    """Places of features in the weight table; place 0 holds no weight."""
    return np.where(keys == 0, 0, (keys >> np.uint64(64 - TABLE_BITS)) | np.uint64(1)).astype(np.int64)


def chains(found: Words) -> np.ndarray:
    """First token of every sentence, with the total at the end."""
    n = len(found.start)
    if not n:
        return np.zeros(1, dtype=np.int64)
    stops = np.append(0, np.cumsum(_STOP[found.buf]))
    head = np.ones(n, dtype=bool)
    head[1:] = (found.row[1:] != found.row[:-1]) | (stops[found.start[1:]] > stops[found.end[:-1]])
    return np.append(np.flatnonzero(head), n)


def _lockstep(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chain starts by falling length, and how many chains are longer than each position."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    longest = int(size.max()) if len(size) else 0
    alive = len(size) - np.searchsorted(np.sort(size), np.arange(longest), side="right")
    return first[:-1][order], alive


def marginals(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """P(state 1) of every token; with `pairs`, also the expected transition counts.

    `emit` is the log-odds that a token's features give to state 1; the chains
    are worked on together, one position at a time, in log-odds.
    """
    starts, alive = _lockstep(first)
    e00, e01, e10, e11 = np.exp(trans).ravel()
    ahead, behind = np.zeros(len(emit)), np.zeros(len(emit))
    last = None
    for j, n in enumerate(alive):
        at = starts[:n] + j
        if j == 0:
            now = emit[at]
        else:
            w = np.exp(np.clip(last[:n], -40, 40))
            now = emit[at] + np.log((e01 + e11 * w) / (e00 + e10 * w))
        ahead[at] = last = now
    for j in range(len(alive) - 1, 0, -1):
        at = starts[: alive[j]] + j
        w = np.exp(np.clip(emit[at] + behind[at], -40, 40))
        behind[at - 1] = np.log((e10 + e11 * w) / (e00 + e01 * w))
    p = 1 / (1 + np.exp(-np.clip(ahead + behind, -40, 40)))
    if not pairs:
        return p
    inner = np.ones(len(emit), dtype=bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    right = emit[at] + behind[at]
    logits = np.stack([np.full(len(at), trans[0, 0]), trans[0, 1] + right, ahead[at - 1] + trans[1, 0], ahead[at - 1] + trans[1, 1] + right])
    logits = np.exp(logits - logits.max(axis=0))
    return p, (logits / logits.sum(axis=0)).sum(axis=1).reshape(2, 2), at


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    curve: np.ndarray

    def tag(self, found: Words) -> np.ndarray:
        emit = np.full(len(found.start), self.bias)
        for kind in range(1 + len(HEADS) + len(TAILS)):
            emit += self.weights[slots(feature_keys(found, kind)[0])]
        return marginals(emit, chains(found), self.trans)

    def score(self, p: np.ndarray, found: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_totals(p, found) @ self.curve, -40, 40)))


def _totals(p: np.ndarray, found: Words) -> np.ndarray:
    """What a document's marginals add up to: 1, log of the expected toxic tokens, of the odds of any, the largest."""
    top = np.zeros(found.rows)
    full = found.counts > 0
    if len(p):
        top[full] = np.maximum.reduceat(p, found.first[:-1][full])
    total = segment_sums(p, found.first)
    some = segment_sums(-np.log1p(-np.minimum(p, 1 - 1e-9)), found.first)
    return np.stack([np.ones(found.rows), np.log1p(total), np.log1p(some), top], axis=1)


def _candidates(doc: np.ndarray, key: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[tuple[np.uint64, np.ndarray]]:
    """Features that occur in three documents of label 1 or more, nine times as often as in others, with their documents."""
    pos, neg = max(1, int((weight * label).sum())), max(1, int((weight * (1 - label)).sum()))
    use = weight[doc] > 0
    doc, key = doc[use], key[use]
    if not len(key):
        return []
    order = np.argsort(key, kind="stable")
    doc, key = doc[order], key[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(head, len(key)))
    p = np.add.reduceat(label[doc].astype(np.int64), head)
    n = size - p
    good = (p >= 3) & (p / pos >= 9 * (n + 0.5) / neg * (n > 0))
    return [(key[head[i]], doc[head[i] : head[i] + size[i]].copy()) for i in np.flatnonzero(good)]


def _cues(found: list[tuple[np.uint64, np.ndarray]], label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Candidates that cover the documents of label 1, by greedy cover; each covers few of the others."""
    pos, neg = max(1, int((weight * label).sum())), max(1, int((weight * (1 - label)).sum()))
    chosen: list[np.uint64] = []
    open_ = label.astype(bool) & (weight > 0)
    rate = pos / neg
    while found:
        gains = [open_[d].sum() - 2 * rate * (~label[d].astype(bool)).sum() for _, d in found]
        best = int(np.argmax(gains))
        if gains[best] < max(3, 0.002 * pos):
            break
        key, docs = found.pop(best)
        chosen.append(key)
        open_[docs] = False
        found = [x for x, g in zip(found, [*gains[:best], *gains[best + 1 :]], strict=True) if g >= 3]
    return np.sort(np.array(chosen, dtype=np.uint64))


def _occurrences(text: pa.Array, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, key) of a kind of feature, each once; then those that two different words or more go on from."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for a, b in blocks(text, FIT_BYTES):
        found = words(text.slice(a, b - a), ALNUM)
        if not len(found.start):
            continue
        key, doc = feature_keys(found, kind)[0], found.row
        word = np.where(found.end - found.start > (HEADS[kind - 1] if kind else 0), found.keys(), 0)
        order = np.lexsort((word, key, doc))
        doc, key, word = doc[order], key[order], word[order]
        head = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
        fresh = (head | np.append(True, word[1:] != word[:-1])) & (word != 0)
        at = np.flatnonzero(head)
        twice = at[np.add.reduceat(fresh.astype(np.int64), at) >= 2]
        for i, spots in enumerate((at, twice)):
            spots = spots[key[spots] != 0]
            parts[2 * i].append(doc[spots] + a)
            parts[2 * i + 1].append(key[spots])
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in parts)


def _member(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(keys.shape, dtype=bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def train(sample: pa.Table, prior: float = 0.5, rounds: int = 60, seed: int = 5) -> Model:
    """Fit the chain and the curve on columns text and label; `prior` is the share of label 1. Without both labels, a model that scores low."""
    model = Model(np.zeros(1 << TABLE_BITS, dtype=np.float32), -6.0, np.zeros((2, 2)), np.array([-6.0, 0.0, 0.0, 0.0]))
    text = sample.column("text").combine_chunks() if sample.num_rows else pa.array([], pa.string())
    label = sample.column("label").to_numpy().astype(np.int64) if sample.num_rows else np.zeros(0, dtype=np.int64)
    if len(set(label.tolist())) < 2:
        return model
    seen: set[int] = set()
    weight = np.zeros(len(label))
    for i, t in enumerate(text.to_pylist()):
        key = hash((t, int(label[i])))
        weight[i] = key not in seen
        seen.add(key)
    found: list[tuple[np.uint64, np.ndarray]] = []
    for kind in range(1 + len(HEADS)):
        doc, key, doc_twice, key_twice = _occurrences(text, kind)
        found += _candidates(doc, key, label, weight)
        if kind:
            found += _candidates(doc_twice, key_twice, label, weight)
    cues = _cues(found, label, weight)

    rng = np.random.default_rng(seed)
    taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in blocks(text, FIT_BYTES):
        found = words(text.slice(a, b - a), ALNUM)
        keys, first = feature_keys(found), chains(found)
        if len(first) < 2:
            continue
        own = label[found.row + a] == 1
        hit = _member(cues, keys[: 1 + len(HEADS)]).any(axis=0)
        tag = hit & own
        size = np.diff(first)
        some = segment_sums(tag.astype(np.int64), first) > 0
        # a sentence of a toxic document without a cue says nothing; of a clean one, one in eight is enough
        use = some | (~own[first[:-1]] & (rng.random(len(size)) < 0.125))
        at = np.flatnonzero(np.repeat(use, size))
        taken.append((slots(keys[:, at]).astype(np.int32), tag[at], size[use]))
    place = np.concatenate([t[0] for t in taken], axis=1)
    tag = np.concatenate([t[1] for t in taken]).astype(float)
    first = np.append(0, np.cumsum(np.concatenate([t[2] for t in taken])))

    w, bias, trans = np.zeros(1 << TABLE_BITS), -4.0, np.zeros((2, 2))
    g_w, g_b, g_t = np.full(len(w), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(rounds):
        emit = bias + w[place].sum(axis=0)
        p, expected, at = marginals(emit, first, trans, pairs=True)
        slope = tag - p
        grad = -0.003 * w
        for row in place:
            grad += np.bincount(row, slope, len(w))
        grad[0] = 0
        pair = 2 * tag[at - 1].astype(int) + tag[at].astype(int)
        grad_t = np.bincount(pair, minlength=4).reshape(2, 2) - expected - 0.1 * trans
        g_w += grad**2
        g_b += slope.sum() ** 2
        g_t += grad_t**2
        w += 0.6 * grad / np.sqrt(g_w)
        bias += 0.3 * slope.sum() / np.sqrt(g_b)
        trans += 0.2 * grad_t / np.sqrt(g_t)
    model.weights, model.bias, model.trans = w.astype(np.float32), float(bias), trans

    rows = []
    for a, b in blocks(text, FIT_BYTES):
        found = words(text.slice(a, b - a), ALNUM)
        rows.append(_totals(model.tag(found), found))
    x = np.concatenate(rows)
    positive, negative = weight * label, weight * (1 - label)
    share = len(label) * (prior * positive / max(1, positive.sum()) + (1 - prior) * negative / max(1, negative.sum()))
    curve = np.array([-2.0, 1.0, 1.0, 1.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (share * (label - p)) - 0.05 * curve
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(4)
        curve = curve + np.linalg.solve(bend, slope)
    model.curve = curve
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS) -> Model:
    """A model of the labelled documents whose crc32 of the id is not 1 modulo 3.

    It is fitted on a sample of at most `per_label` documents a label of at most
    `max_chars` characters each. Rows without id or label teach nothing; of rows
    that repeat an id one is used, with the largest label; null texts count as
    empty; without both labels every text scores low.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(fold("doc_id", 3) != 1)
    share = known.where("label is not null").agg(F.avg("label")).first()[0]
    sample = labelled_sample(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), known, per_label, max_chars)
    return train(sample, min(0.95, max(0.05, share if share is not None else 0.5)))


def _spans(found: Words, p: np.ndarray) -> list[list[tuple[int, int]]]:
    """Character ranges of runs of tokens likelier toxic than not, for each row."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(found.rows)]
    hot = np.flatnonzero(p > 0.5)
    if len(hot):
        chars = np.append(0, np.cumsum((found.buf & 0xC0) != 0x80))
        for i in hot.tolist():
            row = int(found.row[i])
            base = chars[found.offsets[row]]
            a, b = int(chars[found.start[i]] - base), int(chars[found.end[i]] - base)
            if out[row] and i and p[i - 1] > 0.5 and found.row[i - 1] == row:
                out[row][-1] = (out[row][-1][0], b)
            else:
                out[row].append((a, b))
    return out


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (id, held_out, score, predicted, toxic_tokens, spans) for every row of `docs`.

    score is between 0 and 1, predicted is 1 from `threshold` on, spans are
    character ranges [start, end). Null and word-less texts get the score of
    a text without toxic tokens; a null id has a null held_out; repeated rows
    score alike; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = words(batch.column(text_col), ALNUM)
        p = shared.value.tag(found)
        score = shared.value.score(p, found)
        spans = _spans(found, p)
        flat = [x for s in spans for x in s]
        where = pa.array(np.append(0, np.cumsum([len(s) for s in spans])).astype(np.int32))
        ranges = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int64())], ["start", "end"])
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(segment_sums(p, found.first)), pa.ListArray.from_arrays(where, ranges)],
            ["id", "held_out", "score", "predicted", "toxic_tokens", "spans"],
        )

    source = docs.select(F.col(id_col), F.col(text_col), (fold(id_col, 3) == 1).alias("held_out"))
    return map_blocks(source, text_col, run, f"id {kind}, held_out boolean, score double, predicted int, toxic_tokens double, spans array<struct<start:long,end:long>>").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of `docs` that score below `threshold`, with their columns, whatever these are called.

    Null, empty and word-less texts have the score of a text without toxic
    tokens; repeated rows are judged alike and all stay or go; a null id makes
    no difference; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = words(batch.column(text_col), ALNUM)
        score = shared.value.score(shared.value.tag(found), found)
        return batch.filter(pa.array(score < threshold))

    return map_blocks(docs, text_col, run, docs.schema.simpleString()[len("struct<") : -1])
