"""Exact duplicates through an extendible-hash index on shared files.

Built-in functions only. A text's entry lies in the bucket that the first bits
of its 64-bit key lead to. The directory of buckets starts with one and doubles
while a bucket would be overfull. Tasks own buckets, that is ranges of keys: an
owner sorts its rows by key and bytes, chains the different texts that share a
key, and names each chain link's survivor and size; what it writes to the
shared folder is the index, one file an owner. Keys with a large share of all
rows would swamp an owner, so their rows are pre-aggregated, and find their
entries, of which there are few, in a small table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import discard, materialize

#: Buckets that an owner task gets, about, and directory cells a bucket.
BUCKETS_AN_OWNER, CELLS_A_BUCKET = 8, 8
#: A key is hot with more than this share of all rows; so there are at most 1 / HOT_SHARE of them.
HOT_SHARE, HOT_ROWS = 1 / 1024, 32
#: Bits of a key.
KEY_BITS = 64


def build_directory(cells: dict[int, int], capacity: int, bits: int) -> tuple[list[int], int, bool]:
    """Bucket of every cell of `bits` bits, the doublings it took, and whether a bucket stays overfull.

    Starts with one bucket; an overfull bucket splits in two on its next bit,
    and the directory doubles when that bit is beyond its depth.
    """
    full = [0] * (1 << bits)
    for cell, n in cells.items():
        full[cell] = n
    sums = [0]
    for n in full:
        sums.append(sums[-1] + n)
    done, todo, doublings, over = [], [(0, 0)], 0, False
    while todo:
        prefix, depth = todo.pop()
        width = 1 << (bits - depth)
        if sums[(prefix + 1) * width] - sums[prefix * width] <= capacity:
            done.append((prefix * width, width))
        elif depth < bits:
            doublings = max(doublings, depth + 1)
            todo += [(2 * prefix + 1, depth + 1), (2 * prefix, depth + 1)]
        else:
            over = True
            done.append((prefix * width, width))
    return [bucket for bucket, (_, width) in enumerate(sorted(done)) for _ in range(width)], doublings, over


def _key(text: Column, bits: int) -> Column:
    """The first `bits` bits of a text's key, the rest of them zero."""
    h = F.xxhash64(text)
    return F.lit(0).cast("long") if not bits else h if bits == KEY_BITS else F.shiftleft(F.shiftrightunsigned(h, KEY_BITS - bits), KEY_BITS - bits)


class Directory:
    """Buckets of a table's keys and its hot keys, from one count of rows a key.

    `capacity` is the number of keys a bucket may hold (by default so many that
    every owner gets several buckets). Cells are made finer until no bucket is
    overfull; their number follows that of the buckets.
    """

    def __init__(self, docs: DataFrame, text: Column, key_bits: int = KEY_BITS, capacity: int | None = None) -> None:
        conf = docs.sparkSession.conf
        self.owners = int(conf.get("spark.sql.shuffle.partitions"))
        self.key_bits = key_bits
        keys = materialize(docs.select(_key(text, key_bits).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")), "dedup-keys")
        rows, distinct = keys.agg(F.sum("n"), F.count(F.lit(1))).first()
        limit = max(HOT_ROWS, int((rows or 0) * HOT_SHARE))
        self.hot = [int(r[0]) for r in keys.where(F.col("n") > limit).select("h").collect()]
        self.capacity = capacity or max(1, -(-distinct // (BUCKETS_AN_OWNER * self.owners)))
        self.bits = max(1, ((distinct // self.capacity) * CELLS_A_BUCKET).bit_length())
        while True:
            self.bits = min(self.bits, key_bits)
            counts = {int(r[0]): int(r[1]) for r in keys.groupBy(self._cell("h").alias("cell")).count().collect()}
            self.cells, self.doublings, over = build_directory(counts, self.capacity, self.bits)
            if not over or self.bits == key_bits:
                break
            self.bits += 1
        discard(keys)

    def _cell(self, h: str) -> Column:
        return F.shiftrightunsigned(h, KEY_BITS - self.bits) if self.bits else F.lit(0).cast("long")

    def bucket(self, h: str) -> Column:
        """Looks a key's bucket up in the directory, which goes to the tasks as one literal."""
        return F.element_at(F.from_json(F.lit(json.dumps(self.cells)), "array<int>"), (self._cell(h) + 1).cast("int"))

    def is_hot(self, h: str) -> Column:
        return F.expr(f"{h} in ({', '.join(f'{x}L' if x > -(1 << 63) else 'cast(-9223372036854775808 as bigint)' for x in self.hot)})") if self.hot else F.lit(False)


def _placed(docs: DataFrame, id_col: str, text_col: str, carry: list[str], directory: Directory) -> tuple[DataFrame, DataFrame]:
    """Rows (id, t, void, h, bucket, c0...) of ordinary keys and of hot ones; void marks a null text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"), F.col(f"`{text_col}`").isNull().alias("void"), _key(text, directory.key_bits).alias("h"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)))
    rows = rows.withColumn("bucket", directory.bucket("h"))
    hot = directory.is_hot("h")
    return rows.where(~hot), rows.where(hot)


def _hot_entries(hot: DataFrame) -> DataFrame:
    """Entries of hot keys: pre-aggregated where the rows are, chained by key. Bounded: few keys, and their texts are as short on average as those of all rows."""
    entries = hot.groupBy("bucket", "h", "t").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return entries.withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("t")) - 1)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when byte-identical; null counts as empty. Of equal texts
    the largest id stays. Ids may be null: a group of null ids alone keeps
    them, and a null id never stays beside a set one. Rows repeated with the
    same id and text share their verdict. An empty table gives no rows; other
    columns of `docs` are not read, whatever their names. The chain numbers
    the texts of one key in the order of their bytes.

    `capacity` is the number of keys that overfills a bucket; `key_bits` may
    shorten keys, which makes chains longer and changes no verdict.
    """
    directory = Directory(docs, F.coalesce(F.col(f"`{text_col}`"), F.lit("")), key_bits, capacity)
    cold, hot = _placed(docs, id_col, text_col, [], directory)
    verdict = [F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.sha2("t", 256).alias("text_sha256"), "bucket", F.col("chain").cast("int").alias("chain")]
    same = Window.partitionBy("bucket", "h", "t")
    chained = Window.partitionBy("bucket", "h").orderBy("t")
    owned = cold.repartition(directory.owners, "bucket").select("*", F.max("id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"), (F.dense_rank().over(chained) - 1).alias("chain"))
    index = materialize(owned.select(*verdict), "dedup-index")
    if not directory.hot:
        return index
    entries = F.broadcast(materialize(_hot_entries(hot), "dedup-hot").drop("bucket"))
    return index.unionByName(hot.join(entries, ["h", "t"]).select(*verdict))


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, key_bits: int = KEY_BITS) -> DataFrame:
    """Rows of `docs` that stay, with their columns, whatever these are called.

    Of equal texts (null counts as empty) one row of the largest id stays;
    repeated rows collapse to one, a null id stays only beside no other, and an
    empty table gives no rows. The owners pass the rows on themselves.
    """
    directory = Directory(docs, F.coalesce(F.col(f"`{text_col}`"), F.lit("")), key_bits, capacity)
    names = docs.columns
    carry = [c for c in names if c != text_col]
    cold, hot = _placed(docs, id_col, text_col, carry, directory)
    latest = Window.partitionBy("bucket", "h", "t").orderBy(F.col("id").desc_nulls_last())
    owned = cold.repartition(directory.owners, "bucket").withColumn("nth", F.row_number().over(latest)).where("nth = 1").drop("nth")
    if directory.hot:
        entries = F.broadcast(materialize(_hot_entries(hot), "dedup-hot").select("h", "t", "keep_id"))
        stay = hot.join(entries, ["h", "t"]).where(F.col("id").eqNullSafe(F.col("keep_id"))).drop("keep_id")
        owned = owned.unionByName(stay.dropDuplicates(["h", "t"]))
    back = {c: F.col(f"c{i}") for i, c in enumerate(carry)} | {text_col: F.when(~F.col("void"), F.col("t"))}
    return owned.select(*(back[c].alias(c) for c in names))
