"""Multinomial classifiers over hashed word features, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .text import ALNUM, Words, blocks, mix, segment_sums, words

BITS = 16
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = ALNUM & ~((np.arange(256) >= 48) & (np.arange(256) <= 57))


def token_slots(found: Words, kinds: int) -> list[np.ndarray]:
    """Table places of every token's word, and with more kinds of its first and last bytes."""
    ranges = [(found.start, found.end)]
    for k in (2, 3):
        ranges += [(found.start, np.minimum(found.start + k, found.end)), (np.maximum(found.end - k, found.start), found.end)]
    return [(mix(found.keys(a, b) ^ np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - BITS)).astype(np.int64) for i, (a, b) in enumerate(ranges[:kinds])]


def shape(found: Words) -> np.ndarray:
    """Per row: 1, log length, shares of capitals, of punctuation and of digits, mean word length, share of distinct words."""
    n = np.diff(found.offsets)
    size = np.maximum(n, 1)
    share = lambda table: segment_sums(table[found.buf].astype(np.int64), found.offsets) / size
    letters = share(_LETTER | _UPPER)
    digits = share(ALNUM & ~_LETTER)
    spaces = share(np.arange(256) == 32)
    count = np.maximum(found.counts, 1)
    key = found.keys()
    order = np.lexsort((key, found.row))
    key, row = key[order], found.row[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])) if len(key) else np.zeros(0, dtype=bool)
    distinct = np.bincount(row, fresh, found.rows) / count
    return np.stack([np.ones(found.rows), np.log1p(found.counts) / 5, share(_UPPER) * 5, (1 - letters - digits - spaces) * 5, digits * 5, segment_sums(found.end - found.start, found.first) / count / 5, distinct], axis=1)


@dataclass
class Softmax:
    """Posteriors from the mean weight of a text's words and its shape."""

    classes: list
    table: np.ndarray
    dense: np.ndarray

    def posteriors(self, found: Words) -> np.ndarray:
        k = len(self.classes)
        if k == 1:
            return np.ones((found.rows, 1))
        place = token_slots(found, 1)[0]
        count = np.maximum(found.counts, 1)
        z = shape(found) @ self.dense
        for c in range(k):
            z[:, c] += segment_sums(self.table[place, c].astype(np.float64), found.first) / count
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit_softmax(sample: pa.Table, rounds: int = 40) -> Softmax:
    """Fit on columns text and label."""
    label = sample.column("label").to_pylist() if sample.num_rows else []
    classes = sorted(set(label))
    k = len(classes)
    model = Softmax(classes or [None], np.zeros((1 << BITS, max(k, 1)), dtype=np.float32), np.zeros((7, max(k, 1))))
    if k < 2:
        return model
    target = np.eye(k)[[classes.index(x) for x in label]]
    text = sample.column("text").combine_chunks()
    row, place, dense, at = [], [], [], 0
    for a, b in blocks(text):
        found = words(text.slice(a, b - a), ALNUM)
        row.append(found.row + at)
        place.append(token_slots(found, 1)[0])
        dense.append(shape(found))
        at += found.rows
    row, place, dense = np.concatenate(row), np.concatenate(place), np.concatenate(dense)
    pair, times = np.unique(row * np.int64(1 << BITS) + place, return_counts=True)
    row, place = pair >> BITS, pair & ((1 << BITS) - 1)
    value = times / np.maximum(np.bincount(row, times, len(label)), 1)[row]
    table, weight = np.zeros((1 << BITS, k)), np.zeros((7, k))
    g_t, g_w = np.full(table.shape, 1e-8), np.full(weight.shape, 1e-8)
    for _ in range(rounds):
        z = dense @ weight
        for c in range(k):
            z[:, c] += np.bincount(row, table[place, c] * value, len(label))
        z = np.exp(z - z.max(axis=1, keepdims=True))
        slope = target - z / z.sum(axis=1, keepdims=True)
        for c in range(k):
            grad = np.bincount(place, slope[row, c] * value, 1 << BITS) - 1e-4 * table[:, c]
            g_t[:, c] += grad**2
            table[:, c] += 2.0 * grad / np.sqrt(g_t[:, c])
        grad = dense.T @ slope - 1e-3 * weight
        g_w += grad**2
        weight += 0.3 * grad / np.sqrt(g_w)
    model.table, model.dense = table.astype(np.float32), weight
    return model


@dataclass
class Bayes:
    """Naive Bayes log-likelihoods of words and of their ends."""

    classes: list
    table: np.ndarray

    kinds = 5

    def likelihoods(self, found: Words, most: float = 40.0) -> np.ndarray:
        """log P(text | class) up to a constant of the row, tempered for the features' dependence and bounded."""
        k = len(self.classes)
        out = np.zeros((found.rows, k))
        for place, table in zip(token_slots(found, self.kinds), self.table, strict=True):
            for c in range(k):
                out[:, c] += segment_sums(table[place, c].astype(np.float64), found.first)
        out /= self.kinds
        out -= out.max(axis=1, keepdims=True)
        return np.maximum(out, -most)


def fit_bayes(sample: pa.Table, prior: float = 0.05) -> Bayes:
    """Fit on columns text and label."""
    label = sample.column("label").to_pylist() if sample.num_rows else []
    classes = sorted(set(label))
    counts = np.full((Bayes.kinds, 1 << BITS, max(len(classes), 1)), prior)
    if classes:
        text = sample.column("text").combine_chunks()
        of = np.array([classes.index(x) for x in label])
        for a, b in blocks(text):
            found = words(text.slice(a, b - a), ALNUM)
            for i, place in enumerate(token_slots(found, Bayes.kinds)):
                code = place * len(classes) + of[found.row + a]
                counts[i] += np.bincount(code, minlength=counts[i].size).reshape(counts[i].shape)
    return Bayes(classes or [None], np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


