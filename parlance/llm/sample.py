"""Bounded samples of labelled rows for fitting classifiers on the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a class that are searched apart.
PARTS = 64


def fold(doc_id: Column | str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % of


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int) -> pa.Table:
    """Columns doc_id, text, label of at most `per_class` labelled documents a class.

    Ids are taken in the order of a hash, so the sample does not depend on how
    the tables are laid out; repeated labels of an id collapse to the largest,
    rows without id or label are left out, and so are texts of more than
    `max_chars` characters, which bounds what a class brings to the driver.
    """
    spark = docs.sparkSession
    own = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    # a class may hold most labelled rows: its first ids are found by parts of it, then among those of all parts
    own = own.withColumn("turn", F.xxhash64(F.col("doc_id"), F.lit(11))).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(PARTS)))
    for by in (("label", "part"), ("label",)):
        own = own.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy("turn", "doc_id"))).where(F.col("nth") <= per_class).drop("nth")
    own = own.select("doc_id", "label")
    ids = own.collect()
    if not ids:
        return pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string()), "label": pa.array([], own.schema["label"].dataType == "string" and pa.string() or pa.int64())})
    chosen = F.broadcast(spark.createDataFrame(ids, own.schema))
    got = docs.select("doc_id", "text").where(F.length(F.coalesce("text", F.lit(""))) <= max_chars).join(chosen, "doc_id")
    return got.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
