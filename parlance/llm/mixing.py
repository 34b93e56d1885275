"""Soft-membership mixing: rates of documents whose expected domain totals meet targets.

A classifier of the labelled table gives every document posteriors over the
domains. The rates r >= 0 minimise the squared distance, in the metric of the
documents' own second moments, between the expected tokens of each domain and
its target. The gradient of a document's rate is a product of its posteriors
with one vector for all documents, so an iteration is a sum over the table and
its state is the list of those vectors: each task replays it for its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import Softmax, fit_softmax
from .sample import labelled_sample
from .scratch import materialize
from .text import ALNUM, map_blocks, released, words

#: Bound of the training sample: documents a domain, and characters a document.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
#: Largest difference of a domain's share from its target at which the descent stops.
TOLERANCE = 1e-3
#: Root mean square of a plain step, in rates by tokens, under which the targets can't be met better.
STATIONARY = 1e-3
#: Share of the squared distance that a plain step must take off for the descent to go on.
GAIN = 1e-3


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", per_label: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS) -> Softmax:
    """A classifier of `domain_col` from a sample of at most `per_label` labelled documents a domain of at most `max_chars` characters.

    Rows without id or domain teach nothing; of rows that repeat an id one is
    used, and of its domains the largest. Null texts count as empty. Without a
    labelled row the only domain is None.
    """
    known = labelled.select(F.col(id_col).alias("doc_id"), F.col(domain_col).alias("label"))
    return fit_softmax(labelled_sample(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), known, per_label, max_chars))


def posteriors(docs: DataFrame, model: Softmax, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n_tokens, p) for every row of `docs`; tokens are words of letters, digits and non-ASCII characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    k = len(model.classes)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = words(batch.column("text"), ALNUM)
        p = shared.value.posteriors(found)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.counts.astype(np.int64)), pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), k).cast(pa.list_(pa.float64()))], ["id", "n_tokens", "p"])

    return map_blocks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", run, f"id {kind}, n_tokens long, p array<double>")


def _rates(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the projected steps, from 1 each."""
    rate = np.ones(len(p))
    for g in steps:
        rate = np.maximum(rate - p @ g, 0.0)
    return rate


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _sums(rows: DataFrame, k: int, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """At the current rates: expected tokens of each domain, second moments of posteriors with positive rates, and the last step's squares; all by tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k + 1)
        for batch in batches:
            p = _matrix(batch.column("p"), k)
            tokens = batch.column("n_tokens").to_numpy()
            before = _rates(p, steps[:-1])
            rate = np.maximum(before - p @ steps[-1], 0.0) if steps else before
            total[:k] += (tokens * rate) @ p
            total[k:-1] += ((p * (tokens * (rate > 0))[:, None]).T @ p).ravel()
            total[-1] += tokens @ (rate - before) ** 2
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "x"])

    got = rows.select("n_tokens", "p").mapInArrow(released(run), "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(k + k * k + 1)
    for r in got:
        out[r["i"]] = r["x"]
    return out[:k], out[k:-1].reshape(k, k), float(out[-1])


def _descend(rows: DataFrame, k: int, goal: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Steps that lead to the targets, or to where none leads nearer, and the largest difference left.

    A plain step has the metric of all documents, in which a unit step always
    descends. A step in the metric of the documents with positive rates is
    longer; it stays only if it takes a tenth off the squared distance.
    """
    first, second, _ = _sums(rows, k, [])
    total = first.sum()
    if not total:
        return [], 0.0

    def inverse(moments: np.ndarray) -> np.ndarray:
        moments = moments / total
        return np.linalg.inv(moments + 1e-4 * max(np.trace(moments), 1e-12) / k * np.eye(k))

    plain = inverse(second)
    steps: list[np.ndarray] = []
    miss = first / total - goal
    active, may = second, False
    while np.abs(miss).max() >= TOLERANCE:
        distance = miss @ plain @ miss
        step = (inverse(active) if may else plain) @ miss
        now, moments, moved = _sums(rows, k, [*steps, step])
        after = now / total - goal
        if may and after @ plain @ after > 0.9 * distance:
            may = False
            continue
        steps.append(step)
        miss, active = after, moments
        if not may and (moved < STATIONARY**2 * total or after @ plain @ after > (1 - GAIN) * distance):
            break
        may = True
    return steps, float(np.abs(miss).max())


def mix(docs: DataFrame, model: Softmax, targets: dict, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """Rows (id, n_tokens, rate, copies, domain, p, miss) for every row of `docs`.

    `targets` gives the share of each domain; domains it doesn't name get 0,
    shares are scaled to 1, and a domain that the classifier doesn't know is
    left out. The expected tokens of all domains add up to those of `docs`.
    The descent goes on until every domain's share is within TOLERANCE of its
    target, or a plain step gains next to nothing (GAIN, STATIONARY); miss is the largest difference left, the
    same in all rows. copies is the rate rounded up or down by a hash of the id, so that it is
    right on average and the same in every run. Null and word-less texts have
    no tokens, and rates that follow their posteriors; a null id gets a rate
    and is rounded as one id; repeated rows get the same rate; ties of posteriors
    name the first domain; an empty table gives no rows.
    """
    k = len(model.classes)
    rows = materialize(posteriors(docs, model, id_col, text_col), "mixing-posteriors")
    goal = np.array([max(0.0, float(targets.get(c, 0.0))) for c in model.classes])
    goal = goal / goal.sum() if goal.sum() else np.full(k, 1 / k)
    steps, miss = _descend(rows, k, goal)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column("p"), k)
            best = [None if model.classes[i] is None else str(model.classes[i]) for i in p.argmax(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_tokens"), pa.array(_rates(p, steps)), pa.array(best, pa.string()), batch.column("p")], ["id", "n_tokens", "rate", "domain", "p"])

    rated = rows.mapInArrow(run, f"id {kind}, n_tokens long, rate double, domain string, p array<double>")
    turn = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor("rate") + F.when(turn < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long")
    return rated.select(F.col("id").alias(id_col), "n_tokens", "rate", copies.alias("copies"), "domain", "p", F.lit(miss).alias("miss"))
