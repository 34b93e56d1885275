"""The corpus pipeline: toxicity, exact copies, near copies, benchmark leaks, mixture rates.

Each stage works on all rows that the one before it kept. All but the last
return the columns of `documents`. Texts may be null (they count as empty),
ids null or repeated, and tables empty, which gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parlance.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from parlance.llm.queries import domains, targets
from parlance.llm.scratch import discard, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic. Null and empty texts stay, repeated rows stay or go together; without labels of both kinds all stay."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of the largest doc_id of equal texts. Null and empty texts are equal; a null id stays only beside no other."""
    return exact_dedup.keep_exact(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near copies, by five-word shingles. Texts without words and rows without id stay."""
    return near_dedup.keep_near(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more is benchmark text. Texts without words stay, repeated rows stay or go together; without a benchmark all stay."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), carry=docs.columns, drop=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its domain, tokens, rate and copies in the mixture. Texts without words have no tokens; repeated rows get the same rate; without labels the only domain is null."""
    model = mixing.fit(docs, domains(docs, _table(spark, sf_dir, "labels")))
    return mixing.mix(docs, model, targets(model)).select("doc_id", "domain", "n_tokens", "rate", "copies")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Two stages are trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again for the next; a table goes when the next one is written."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
