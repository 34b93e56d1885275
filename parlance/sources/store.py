"""The raw store: append-only message logs, upserted users and chats, a cursor, a cache of inspections."""

from __future__ import annotations

import contextlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.messages import dedup_latest
from . import schemas


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a JSONL log, newest edit of each; torn or unreadable rows are skipped."""
    rows = spark.read.schema(schemas.MESSAGE + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = rows.where("_corrupt is null and chat_id is not null and id is not null").drop("_corrupt")
    return dedup_latest(rows.withColumn("__line", F.monotonically_increasing_id()), ["chat_id", "id"], "edit_date", "date", "__line").drop("__line")


def read_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON file that maps ids to them."""
    text = spark.read.text(path, wholetext=True)
    struct = ", ".join(f.strip().replace(" ", ":", 1) for f in schema.split(", "))
    return text.select(F.explode(F.from_json("value", f"map<string,struct<{struct}>>")).alias("key", "rec")).select("rec.*")


def append_messages(batch: DataFrame, log: str) -> None:
    """Append to the log, a folder a chat; the cursor is advanced after that, by `advance_cursor`."""
    batch.withColumn("chat", F.col("chat_id")).write.mode("append").partitionBy("chat").json(log)


def advance_cursor(cursor: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """Cursor after `batch`: the largest id of each chat, and how many rows were appended in all."""
    new = batch.groupBy("chat_id").agg(F.max("id").alias("new_id"), F.count(F.lit(1)).alias("new_rows"))
    stamp = now if now is not None else F.current_timestamp()
    joined = cursor.join(new, "chat_id", "full")
    return joined.select(
        "chat_id", F.greatest(F.coalesce("last_id", F.lit(0)), F.coalesce("new_id", F.lit(0))).alias("last_id"),
        (F.coalesce("appended", F.lit(0)) + F.coalesce("new_rows", F.lit(0))).alias("appended"), F.when(F.col("new_rows").isNotNull(), stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def newer_than_cursor(rows: DataFrame, cursor: DataFrame) -> DataFrame:
    """Messages after the cursor of their chat."""
    return rows.join(cursor.select("chat_id", "last_id"), "chat_id", "left").where(F.col("id") > F.coalesce("last_id", F.lit(0))).drop("last_id")


def reset_chats(cursor: DataFrame, log: DataFrame, chats: list[int]) -> tuple[DataFrame, DataFrame]:
    """Cursor and log without some chats, which a full reload then brings again."""
    return cursor.where(~F.col("chat_id").isin(chats)), log.where(~F.col("chat_id").isin(chats))


def _newest(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(f"n.{name}"), F.lit("")), F.col(f"o.{name}")).alias(name)


def upsert_users(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per user the newest non-empty fields, flags that were ever set, all usernames in order."""
    o, n = old.alias("o"), new.alias("n")
    flag = lambda x: (F.coalesce(F.col(f"n.{x}"), F.lit(False)) | F.coalesce(F.col(f"o.{x}"), F.lit(False))).alias(x)
    names = F.array_distinct(F.concat(F.coalesce(F.col("n.usernames"), F.array().cast("array<string>")), F.coalesce(F.col("o.usernames"), F.array().cast("array<string>")))).alias("usernames")
    joined = o.join(n, F.col("o.id") == F.col("n.id"), "full")
    return joined.select(F.coalesce("n.id", "o.id").alias("id"), *(_newest(x) for x in ("first_name", "last_name", "username", "phone")), flag("is_bot"), flag("is_deleted"), names)


def upsert_chats(old: DataFrame, new: DataFrame) -> DataFrame:
    """The new record of each chat; an empty roster keeps the old one."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col("o.id") == F.col("n.id"), "full")
    fields = [c for c in new.columns if c not in ("id", "participant_ids")]
    roster = F.when(F.size(F.coalesce("n.participant_ids", F.array().cast("array<bigint>"))) > 0, F.col("n.participant_ids")).otherwise(F.col("o.participant_ids"))
    return joined.select(F.coalesce("n.id", "o.id").alias("id"), *(F.when(F.col("n.id").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in fields), roster.alias("participant_ids"))


def fresh_inspections(cache: DataFrame, me_id: int, hours: float, now: Column | None = None) -> DataFrame:
    """Cached inspections of this account that are not older than `hours`."""
    age = F.unix_timestamp(now if now is not None else F.current_timestamp()) - F.unix_timestamp("inspected_at")
    return cache.where((F.col("me_id") == me_id) & (age <= hours * 3600) & (F.coalesce("error", F.lit("")) == ""))


def hadoop(spark: SparkSession, path: str | Path):
    """The file system of a path, on any store that Spark writes to, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str | Path) -> bool:
    fs, where = hadoop(spark, path)
    return fs.exists(where)


def write_text(spark: SparkSession, path: str, text: str, mode: int | None = None) -> None:
    """A small file, written aside and renamed."""
    fs, where = hadoop(spark, path)
    _, aside = hadoop(spark, f"{path}.new")
    out = fs.create(aside, True)
    if mode is not None:
        fs.setPermission(aside, spark._jvm.org.apache.hadoop.fs.permission.FsPermission(mode))
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(aside, where):
        raise OSError(f"{path} could not be written")


def make_private(spark: SparkSession, path: str | Path) -> None:
    """Takes everybody else's rights from a folder and all below it, as an interrupted run or a copy may have left them."""
    fs, where = hadoop(spark, path)
    if not fs.exists(where):
        return
    rights = spark._jvm.org.apache.hadoop.fs.permission.FsPermission
    todo = [fs.getFileStatus(where)]
    while todo:
        status = todo.pop()
        fs.setPermission(status.getPath(), rights(0o700 if status.isDirectory() else 0o600))
        if status.isDirectory():
            todo += list(fs.listStatus(status.getPath()))


def write_private_json(path: str | Path, value: object, spark: SparkSession | None = None) -> None:
    """A small report that its owner alone can read, in place of the old one at once; on a shared store through `spark`."""
    if spark is not None and "://" in str(path):
        write_text(spark, str(path), json.dumps(value, ensure_ascii=False, indent=1, sort_keys=True), 0o600)
        return
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, name = tempfile.mkstemp(dir=path.parent)
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(value, f, ensure_ascii=False, indent=1, sort_keys=True)
        os.chmod(name, 0o600)
        os.replace(name, path)
    except BaseException:
        with contextlib.suppress(OSError):
            os.unlink(name)
        raise


def put_inspections(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with newer inspections of an account's chats in place of older ones."""
    both = cache.unionByName(new)
    newest = F.row_number().over(Window.partitionBy("me_id", "chat_id").orderBy(F.col("inspected_at").desc()))
    return both.withColumn("__rank", newest).where("__rank = 1").drop("__rank")


README = """# Conversation dataset

messages/ and episodes/ hold JSON lines, users/ and chats/ one JSON object a
line, transcripts/ Markdown text by chat and part, chunks/ the same text packed
for reading in one piece, manifest.json counts, dates and the public policy.
"""


def write_dataset(tables: dict[str, DataFrame], transcripts: DataFrame, chunks: DataFrame, manifest: dict, path: str) -> None:
    """The shareable dataset below `path`, through a staging folder that is swapped in by rename.

    `tables` are written as JSON lines, `transcripts` (chat, part, text) and
    `chunks` (chunk, chat, part, text) as text, one folder a part or chunk;
    nothing but the manifest passes the driver.
    """
    spark = transcripts.sparkSession
    staging = f"{path}.staging"
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{staging}/{name}")
    transcripts.select("text", "chat", "part").write.mode("overwrite").partitionBy("chat", "part").text(f"{staging}/transcripts")
    ordered = chunks.repartition("chunk").sortWithinPartitions("chunk", "chat", "part")
    ordered.select("text", "chunk").write.mode("overwrite").partitionBy("chunk").text(f"{staging}/chunks")
    chunks.select("chunk", "chat", "part", F.length("text").alias("chars")).write.mode("overwrite").json(f"{staging}/index")
    for name, text in (("manifest.json", json.dumps(manifest, ensure_ascii=False, indent=1, sort_keys=True)), ("README.md", README)):
        write_text(spark, f"{staging}/{name}", text)
    swap(spark, staging, path)


def swap(spark: SparkSession, new: str, target: str) -> None:
    """Puts a folder in another's place. The old one is moved aside first and back if the new one can't be moved."""
    fs, there = hadoop(spark, target)
    (_, here), (_, aside) = hadoop(spark, new), hadoop(spark, f"{target}.old")
    had = fs.exists(there)
    if had:
        fs.delete(aside, True)
        if not fs.rename(there, aside):
            raise OSError(f"{target} could not be moved aside")
    if not fs.rename(here, there):
        if had:
            fs.rename(aside, there)
        raise OSError(f"{new} could not be moved to {target}")
    if had:
        fs.delete(aside, True)
