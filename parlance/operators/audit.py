"""The audit of a written dataset: text units, leaks and the report."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scrub import scan_column
from ..functions.vocabulary import Roster
from ..plans.policy import Anonymize

#: Leaks a report lists at most; its counts cover all.
REPORT_ROWS = 2000


def _leaves(value: object, path: str) -> Iterator[tuple[str, str]]:
    """Every string leaf and key of a JSON value, with its dotted path."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield f"{path}.{k}" if path else k, k
            yield from _leaves(v, f"{path}.{k}" if path else k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from _leaves(v, f"{path}[{i}]")
    elif isinstance(value, str):
        yield path, value


UNITS = "array<struct<path:string,text:string>>"


def json_units(column: Column) -> Column:
    """Array of (path, text) of a JSON text; what isn't JSON is one unit."""

    @F.pandas_udf(UNITS)
    def run(part: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict]:
            if not text:
                return []
            try:
                return [{"path": p, "text": t} for p, t in _leaves(json.loads(text), "")]
            except ValueError:
                return [{"path": "", "text": text}]

        return part.map(one)

    return run.asNondeterministic()(column)


def file_units(spark: SparkSession, path: str, own_readme: str = "") -> DataFrame:
    """Rows (file, location, text) of every file below `path`, by suffix: JSON leaves, JSONL rows, lines of text. A README is passed over only where it is the writer's to the byte."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if own_readme:
        files = files.where(~(F.col("path").endswith("/README.md") & (F.col("content") == F.encode(F.lit(own_readme), "UTF-8"))))
    text = F.decode("content", "UTF-8")
    lines = files.select(F.col("path").alias("file"), F.posexplode(F.split(text, "\n")).alias("n", "line")).where("line <> ''")
    rows = lines.where(F.col("file").endswith(".jsonl")).select("file", "n", F.explode(json_units(F.col("line"))).alias("u")).select("file", F.format_string("%d:%s", F.col("n") + 1, F.col("u.path")).alias("location"), F.col("u.text").alias("text"))
    whole = files.where(F.col("path").endswith(".json")).select(F.col("path").alias("file"), F.explode(json_units(text)).alias("u")).select("file", F.col("u.path").alias("location"), F.col("u.text").alias("text"))
    plain = lines.where(~F.col("file").rlike(r"\.jsonl?$")).select("file", (F.col("n") + 1).cast("string").alias("location"), F.col("line").alias("text"))
    return rows.unionByName(whole).unionByName(plain)


def scan_units(units: DataFrame, policy: Anonymize | None = None, roster: Roster | None = None) -> DataFrame:
    """Rows (kind, match, location): each distinct text is scanned once and joined back."""
    distinct = units.select("text").where("text <> ''").distinct()
    found = distinct.select("text", F.explode(scan_column(F.col("text"), policy, roster)).alias("leak"))
    return units.join(found, "text").select(F.col("leak.kind").alias("kind"), F.col("leak.match").alias("match"), "location")


def leak_report(leaks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by kind, and the first rows of the listing."""
    return leaks.groupBy("kind").agg(F.count(F.lit(1)).alias("n")), leaks.orderBy("location", "kind", "match").limit(REPORT_ROWS)


class LeakError(RuntimeError):
    """Raised by the self-check; names kinds and locations, never values."""


def self_check(units: DataFrame, policy: Anonymize | None = None, roster: Roster | None = None) -> DataFrame:
    """The units themselves if nothing leaks."""
    bad = scan_units(units, policy, roster).select("kind", "location").limit(5).collect()
    if bad:
        raise LeakError("; ".join(f"{r['kind']} at {r['location']}" for r in bad))
    return units
