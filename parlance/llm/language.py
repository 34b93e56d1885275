"""Language identification by fusing text, declared markup, address suffix and host priors."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import Bayes, fit_bayes
from .sample import labelled_sample
from .scratch import materialize
from .text import ALNUM, map_blocks, words

#: Bound of the training sample: documents a language, and characters a document.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
#: Weight of the wider level in rows when a narrower one is smoothed: host by site, site by all, evidence by all.
HOST_WEIGHT, SITE_WEIGHT, EVIDENCE_WEIGHT = 5.0, 20.0, 10.0

_DROP = re.compile(r"<(script|style)\b.*?(?:</\1\s*>|$)|<!--.*?(?:-->|$)|<[^>]*>", re.DOTALL | re.IGNORECASE)


def visible_text(page: str | None) -> str:
    """Text of a page without markup, scripts and styles."""
    return html.unescape(_DROP.sub(" ", page)) if page else ""


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_label: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS) -> Bayes:
    """Text likelihoods from a sample of at most `per_label` documents a language of at most `max_chars` characters each.

    Rows without id or language teach nothing, null and empty texts little; of
    rows that repeat an id one is used. Without a labelled row the model knows
    no language.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lower(F.trim(lang_col)).alias("lang"))
    known = own.where(F.coalesce("lang", F.lit("")) != "").select("doc_id", F.col("lang").alias("label"))
    return fit_bayes(labelled_sample(own, known, per_label, max_chars))


def declared_language(html_col: Column) -> Column:
    """Primary subtag of the page's lang attribute or content-language, or null."""
    tag = F.coalesce(F.nullif(F.regexp_extract(html_col, r"(?is)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?([a-zA-Z]{2,3})\b", 1), F.lit("")), F.nullif(F.regexp_extract(html_col, r"(?is)<meta\b[^>]*content-language[\"']?\s+content\s*=\s*[\"']?([a-zA-Z]{2,3})\b", 1), F.lit("")))
    return F.lower(tag)


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def _sums(rows: DataFrame, by: str, k: int) -> DataFrame:
    """Sums of the posteriors of each value of `by`, with the number of rows."""
    got = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)))
    return got.select(F.col(by).alias(f"key_{by}"), F.col("n").alias(f"n_{by}"), F.array(*(f"s{i}" for i in range(k))).alias(f"sum_{by}"))


def identify(rows: DataFrame, model: Bayes, carry: list[str], text_col: str = "text", declared_col: str = "declared", suffix_col: str = "suffix", host_col: str = "host", site_col: str = "site") -> DataFrame:
    """The `carry` columns, but those named like one of the result's own, with lang, prob, text_lang, text_prob, declared, suffix and host.

    The text gives each language a bounded log-likelihood. What a declared
    language or an address suffix says is measured: the posteriors that the
    text alone gives are added up for each value, smoothed by all rows, and
    divided by the language's overall share. A host's prior is its own sums
    smoothed by its site's, smoothed by all rows', the row itself left out.
    Null evidence says nothing; a row without words is decided by the rest;
    without any, the commonest language wins; a model that was fitted on no
    labelled row names none (null). Ties go to the language first in
    the alphabet. Repeated rows repeat; an empty table gives no rows.
    """
    k, classes = len(model.classes), model.classes
    shared = rows.sparkSession.sparkContext.broadcast(model)
    carried = [f"c{i}" for i in range(len(carry))]
    evidence_cols = [declared_col, suffix_col, host_col, site_col]
    rows = rows.select(*(F.col(f"`{c}`").alias(a) for c, a in zip(carry, carried, strict=True)), F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`").alias(a) for c, a in zip(evidence_cols, ("declared", "suffix", "host", "site"), strict=True)))
    text_col, declared_col, suffix_col, host_col, site_col = "text", "declared", "suffix", "host", "site"
    names = [*carried, declared_col, suffix_col, host_col, site_col]

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = words(batch.column("text"), ALNUM)
        like = shared.value.likelihoods(found)
        p = np.exp(like)
        p /= p.sum(axis=1, keepdims=True)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), k).cast(pa.list_(pa.float64())) for x in (like, p)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *lists], [*names, "like", "p"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    source = rows.select(*names, F.col(text_col).alias("text"))
    own = materialize(map_blocks(source, "text", read, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "like array<double>, p array<double>"])), "language")
    total = own.agg(F.count(F.lit(1)), *(F.sum(F.col("p")[i]) for i in range(k))).first()
    share = np.array([(x or 0.0) + 1.0 for x in total[1:]])
    share = (share / share.sum()).tolist()

    out = own
    for by in dict.fromkeys([declared_col, suffix_col, host_col, site_col]):
        out = out.join(_sums(own, by, k), F.col(by) == F.col(f"key_{by}"), "left")

    def smoothed(by: str, i: int, wider: Column, weight: float) -> Column:
        """Share of language i among the other rows of the same value."""
        return F.coalesce((F.greatest(F.col(f"sum_{by}")[i] - F.col("p")[i], F.lit(0.0)) + weight * wider) / (F.col(f"n_{by}") - 1 + weight), wider)

    logs = []
    for i in range(k):
        base = F.lit(share[i])
        prior = smoothed(host_col, i, smoothed(site_col, i, base, SITE_WEIGHT), HOST_WEIGHT)
        evidence = [smoothed(c, i, base, EVIDENCE_WEIGHT) / base for c in (declared_col, suffix_col)]
        logs.append(F.col("like")[i] + F.log(F.greatest(prior, F.lit(1e-6))) + sum((F.log(F.greatest(e, F.lit(1e-6))) for e in evidence), F.lit(0.0)))
    out = out.withColumn("post", F.array(*logs)).withColumn("top", F.array_max("post"))
    langs = F.array(*(F.lit(None if c is None else str(c)).cast("string") for c in classes))
    weight = F.aggregate(F.transform("post", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    pick = lambda column: F.element_at(langs, F.array_position(column, F.array_max(column)).cast("int"))
    own = {"lang", "prob", "text_lang", "text_prob", "declared", "suffix", "host"}
    return out.select(*(F.col(a).alias(c) for c, a in zip(carry, carried, strict=True) if c not in own), pick(F.col("post")).alias("lang"), (1 / weight).alias("prob"), pick(F.col("p")).alias("text_lang"), F.array_max("p").alias("text_prob"), F.col(declared_col).alias("declared"), F.col(suffix_col).alias("suffix"), F.col(host_col).alias("host"))


def page_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as rows of `identify`: id, text, declared, suffix, host, site.

    Null html gives an empty text and no declaration, a null or unreadable
    address no suffix, host and site; repeated rows repeat, an empty table gives
    no rows; other columns are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    host = host_of(F.col(url_col))
    labels = F.split(host, r"\.")
    source = pages.select(
        F.col(id_col).alias("id"), F.col(html_col).alias("text"), declared_language(F.col(html_col)).alias("declared"),
        F.regexp_extract(F.element_at(labels, -1), r"^[a-z]{2,24}$", 0).alias("suffix"), host.alias("host"), F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".").alias("site"),
    )

    def strip(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = pa.array([visible_text(t) for t in batch.column("text").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("id"), text, *(batch.column(c) for c in ("declared", "suffix", "host", "site"))], ["id", "text", "declared", "suffix", "host", "site"])

    return map_blocks(source, "text", strip, f"id {kind}, text string, declared string, suffix string, host string, site string")
