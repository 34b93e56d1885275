"""Incremental ingestion as a stream: each micro-batch is merged into a table of newest rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.messages import dedup_latest
from ..sources import store


def message_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New files of a message log."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


#: Parts of a merged table, by a hash of the key.
PARTS = 64


def _part(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def _manifests(spark: SparkSession, table: str, before: int | None = None) -> list[tuple[int, dict[str, int]]]:
    """Versions of a merged table, oldest first: each names, for every part, the version that holds its rows."""
    fs, root = store.hadoop(spark, f"{table}/versions")
    if not fs.exists(root):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root))
    wanted = [n for n in names if n.endswith(".json") and (before is None or int(n[1:-5]) < before)]
    return [(int(n[1:-5]), json.loads(spark.read.text(f"{table}/versions/{n}", wholetext=True).first()[0])) for n in wanted[-2:]]


def _rows(spark: SparkSession, table: str, held: dict[str, int]) -> DataFrame | None:
    return spark.read.parquet(*(f"{table}/v{epoch:09d}/__part={part}" for part, epoch in held.items())) if held else None


def merge_batch(table: str, key: list[str], edited: str, sent: str, parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: newest edit of each key, over the table and the batch; a replayed batch changes nothing.

    Rows are dealt to parts by a hash of the key. A batch rewrites the parts
    that it touches, so its cost follows the batch; a version is a small file
    that names where each part lies, and is written last, so a batch that dies
    half-way leaves the version before. Parts that neither the newest version
    nor the one before it names are deleted.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        earlier = _manifests(spark, table, before=epoch)
        held = earlier[-1][1] if earlier else {}
        rows = batch.withColumn("__part", _part(key, parts))
        touched = sorted(str(r[0]) for r in rows.select("__part").distinct().collect())
        if touched:
            rows = rows.withColumn("__at", F.lit(epoch).cast("long"))
            old = _rows(spark, table, {p: held[p] for p in touched if p in held})
            if old is not None:
                rows = old.withColumn("__part", _part(key, parts)).withColumn("__at", F.lit(-1).cast("long")).unionByName(rows, allowMissingColumns=True)
            newest = dedup_latest(rows.withColumn("__line", F.struct(F.col("__at"), F.monotonically_increasing_id())), key, edited, sent, "__line")
            newest.drop("__at", "__line").repartition("__part").write.mode("overwrite").partitionBy("__part").parquet(f"{table}/v{epoch:09d}")
        now = held | dict.fromkeys(touched, epoch)
        store.write_text(spark, f"{table}/versions/v{epoch:09d}.json", json.dumps(now, sort_keys=True))
        if len(earlier) > 1:
            fs, _ = store.hadoop(spark, table)
            for part, at in earlier[0][1].items():
                if held.get(part) != at:
                    fs.delete(store.hadoop(spark, f"{table}/v{at:09d}/__part={part}")[1], True)

    return run


def latest(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """The newest whole version of a merged table."""
    found = _manifests(spark, table, before)
    return _rows(spark, table, found[-1][1]) if found else None


def start(stream: DataFrame, table: str, checkpoint: str, key: list[str], edited: str, sent: str, available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge_batch(table, key, edited, sent))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def streaming_sessions(events: DataFrame, user: str, ts: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Sessions of each user in a stream, closed by a gap, with late rows up to `late`."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("messages")).select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "messages")
