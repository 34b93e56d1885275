"""Near duplicates: bottom-k sketches of one hash function, inverted lists, exact Jaccard.

A document is the set of its distinct word shingles, its sketch the k smallest
shingle hashes. Inverted lists are kept of retained values: of every value for
a short document, and for others of triples of them, the smallest retained
values of three out of 32 classes that the hash itself divides values into.
Short documents enter the lists of so many of their rarest values that a pair of
the wanted similarity must meet in one; others meet in one of 48 triples but
for about one pair in a million at the threshold itself. Lists of one document
say nothing, and most documents are in no other.

Lists are never expanded into pairs. Documents are compared in blocks of
bounded size: by the similarity that the union of their sketches estimates,
likeliest first, then on the full sets, skipping what is connected already, so
a block gives fewer links than it has documents. A large set counts as several
in the size of a block. Two rounds over one list a
document connect most copies. Of lists that then still hold several
components, documents outside a list's largest component are compared with all
of that component, once, and with each other in the lists, until every pair of
different components that shares a list has been looked at.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import discard, materialize
from .text import NOT_SPACE, binary_array, map_blocks, mix, release, words

#: Retained values a document.
SKETCH = 128
#: Least similarity, in hundredths, for which triples are fit; below it all sets enter lists of values.
LEAST_PERCENT = 80
#: Sets from this size on enter the lists of triples, sets up to that one those of values:
#: sizes of a pair are at most LEAST_PERCENT apart, so both enter lists of one kind.
LONG, SHORT = 64, 64 * 100 // LEAST_PERCENT
CLASSES, TRIPLES = 32, 48
#: Classes whose smallest value two long documents must share to be compared; at
#: similarity 0.8 they share 25.6 +- 2.3 of 32.
ALIKE = 14
#: Standard errors by which a sketch estimate may fall short of the threshold.
SLACK = 5.5
#: Copies of what is joined to the members of a component.
SALTS = 16
#: Documents of one side of a block, and shingles of a set that make it count as one document more.
BLOCK, WEIGHT = 256, 4096


def shingle_keys(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle keys of every row, and where each row's begin."""
    found = words(column, NOT_SPACE)
    keys, counts = found.keys(), found.counts
    n = len(keys)
    width = np.minimum(size, counts)[found.row] if n else counts[:0]
    left = found.first[1:][found.row] - np.arange(n)
    value = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        step = np.minimum(np.arange(n) + j, n - 1)
        value = np.where(j < width, mix(value * np.uint64(0x9FB21C651E98DF25) + keys[step]), value) if n else value
    whole = left >= width
    value, row = value[whole], found.row[whole]
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, np.searchsorted(row, np.arange(found.rows + 1))


def _triples() -> np.ndarray:
    rng = np.random.default_rng(48)
    return np.array([rng.choice(CLASSES, 3, replace=False) for _ in range(TRIPLES)])


def triple_keys(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each row's triples of retained values, and 16 bits of the smallest of each class; rows of sorted `value` as `first` delimits them."""
    rows = len(first) - 1
    size = np.diff(first)
    row = np.repeat(np.arange(rows), size)
    kept = np.arange(len(value)) - np.repeat(first[:-1], size) < SKETCH
    value, row = value[kept], row[kept]
    code, at = np.unique(row * CLASSES + (mix(value) >> np.uint64(59)).astype(np.int64), return_index=True)
    least = np.zeros(rows * CLASSES, dtype=np.uint64)
    least[code] = value[at]
    least = least.reshape(rows, CLASSES)
    out = np.tile(np.arange(TRIPLES, dtype=np.uint64), (rows, 1))
    for i in range(3):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + least[:, _triples()[:, i]])
    return out, (mix(least) >> np.uint64(48)).astype(np.uint16)


def _lists(values: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(values.view(np.int64)))


def _sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, exact: bool) -> DataFrame:
    """Rows (id, n, sig, triples, vals, least): size of the set, a 128-bit key of it, its keys to the lists, its smallest values."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, first = shingle_keys(batch.column(text_col), shingle)
        n = np.diff(first)
        long, brief = (n < 0, n >= 0) if exact else (n >= LONG, n <= SHORT)
        short = np.repeat(brief, n)
        sums = np.zeros((2, len(value) + 1), dtype=np.uint64)
        np.cumsum(value, out=sums[0, 1:])
        np.cumsum(mix(value ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
        one, two = (mix(s[first[1:]] - s[first[:-1]]) for s in sums)
        sig = pa.array([f"{a:016x}{b:016x}" if k else None for a, b, k in zip(one.tolist(), two.tolist(), n.tolist(), strict=True)], pa.string())
        keys, least = triple_keys(value, first)
        lists = [_lists(keys[long].ravel(), np.where(long, TRIPLES, 0)), _lists(value[short], np.where(brief, n, 0))]
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(n), sig, *lists, binary_array(least.ravel(), np.arange(len(n) + 1) * CLASSES)], ["id", "n", "sig", "triples", "vals", "least"])

    return map_blocks(docs.select(id_col, text_col), text_col, run, f"id {docs.schema[id_col].dataType.simpleString()}, n long, sig string, triples array<long>, vals array<long>, least binary")


def _keys(reps: DataFrame, t: float) -> DataFrame:
    """Rows (id, weight, vals of (df, v)), one an id: the lists of two sets or more that it enters."""
    found = []
    for column in ("triples", "vals"):
        values = reps.select("id", "n", F.explode(column).alias("v"))
        df = values.groupBy("v").count().where("count > 1").withColumnRenamed("count", "df")
        found.append(values.join(df, "v"))
    long = materialize(found[0], "near-long")
    # of n values, the rarest n - ceil(t * n) + 1; those in no other set are rarer than any
    short = found[1].groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vals"))
    prefix = F.col("n") - F.ceil(t * F.col("n") - 1e-9) + 1
    short = short.withColumn("vals", F.slice("vals", 1, F.greatest(F.lit(0), prefix - (F.col("n") - F.size("vals"))).cast("int"))).where(F.size("vals") > 0)

    kind = reps.schema["id"].dataType.simpleString()
    many, few = long.where(F.col("df") > BLOCK), long.where(F.col("df") <= BLOCK)
    calls = max(1, math.ceil(few.count() / (32 * BLOCK)))

    def sieve(table: pa.Table) -> pa.Table:
        release()
        v = table.column("v").to_numpy()
        order = np.argsort(v, kind="stable")
        least = np.stack([np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in table.column("least")])
        keep = [np.zeros(0, dtype=np.int64)]
        for part in np.split(order, np.flatnonzero(np.diff(v[order])) + 1):
            same = (least[part][:, None, :] == least[part][None, :, :]).sum(axis=2)
            np.fill_diagonal(same, 0)
            keep.append(part[same.max(axis=1) >= ALIKE])
        return table.select(["id", "n", "df", "v"]).take(pa.array(np.concatenate(keep)))

    # members of a list that share too few smallest values with every other one leave it
    own = few.join(reps.select("id", "least"), "id").withColumn("call", F.pmod(F.xxhash64("v"), F.lit(calls)))
    kept = own.groupBy("call").applyInArrow(sieve, f"id {kind}, n long, df long, v long").unionByName(many.select("id", "n", "df", "v"))
    entered = kept.groupBy("id", "n").agg(F.collect_list(F.struct("df", "v")).alias("vals"))
    # an id with several texts is one member of a list
    weight = (F.lit(1) + F.expr(f"max(n) div {WEIGHT}")).alias("weight")
    return entered.unionByName(short).groupBy("id").agg(weight, F.array_distinct(F.flatten(F.collect_list("vals"))).alias("vals"))


def _estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of the SKETCH smallest values of two sketches' union that both hold; rows padded with the largest value."""
    both = np.sort(np.concatenate([left, right], axis=1), axis=1)
    pad = both == np.uint64(0xFFFFFFFFFFFFFFFF)
    twice = np.zeros(both.shape, dtype=bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & ~pad[:, 1:]
    nth = np.cumsum(~twice & ~pad, axis=1)
    used = np.minimum(nth[:, -1], SKETCH)
    return (twice & (nth <= SKETCH)).sum(axis=1) / np.maximum(used, 1)


def _link(ids: list, comp: list, side: np.ndarray, raw: list[np.ndarray], percent: int, exact: bool) -> list[tuple]:
    """Links between different components among some documents; with sides 0 and 1, across them only."""
    k = len(ids)
    n = np.array([len(x) for x in raw])
    x, y = np.triu_indices(k, 1)
    codes = np.unique(np.array(comp), return_inverse=True)[1]
    ok = (codes[x] != codes[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & ((side[x] < 0) | (side[x] != side[y]))
    x, y = x[ok], y[ok]
    if not len(x):
        return []
    t = percent / 100
    padded = np.full((k, SKETCH), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for i, s in enumerate(raw):
        padded[i, : min(len(s), SKETCH)] = s[:SKETCH]
    guess = np.concatenate([_estimates(padded[x[i : i + 2048]], padded[y[i : i + 2048]]) for i in range(0, len(x), 2048)])
    likely = np.flatnonzero(guess >= (0 if exact else t - SLACK * math.sqrt(t * (1 - t) / SKETCH)))
    up = list(range(int(codes.max()) + 1))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for at in likely[np.argsort(-guess[likely], kind="stable")].tolist():
        i, j = int(x[at]), int(y[at])
        a, b = root(codes[i]), root(codes[j])
        if a == b:
            continue
        small, large = (raw[i], raw[j]) if n[i] <= n[j] else (raw[j], raw[i])
        common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
        if 100 * common >= percent * (len(small) + len(large) - common):
            up[b] = a
            out.append((ids[i], ids[j]))
    return out


def _linked(rows: DataFrame, sets: DataFrame, key: list[str], percent: int, exact: bool) -> DataFrame:
    """Links (a, b) found in each block of `rows` (key, id, weight, comp, side); many small blocks share a call."""
    rows = materialize(rows.withColumn("block", F.xxhash64(*key)).select("block", "id", "weight", "comp", "side"), "near-rows")
    calls = max(1, math.ceil((rows.agg(F.sum("weight")).first()[0] or 0) / (4 * BLOCK)))

    def run(table: pa.Table) -> pa.Table:
        release()
        block = table.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        ids, comp = table.column("id").to_pylist(), table.column("comp").to_pylist()
        side = table.column("side").to_numpy()
        sets_ = table.column("set")
        found: list[tuple] = []
        for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            if len(part) > 1:
                raw = [np.frombuffer(sets_[int(i)].as_buffer(), dtype=np.uint64) for i in part]
                found += _link([ids[i] for i in part], [comp[i] for i in part], side[part], raw, percent, exact)
        kind_ = table.schema.field("id").type
        return pa.table({"a": pa.array([x for x, _ in found], kind_), "b": pa.array([y for _, y in found], kind_)})

    kind = sets.schema["id"].dataType.simpleString()
    joined = rows.drop("weight").join(sets, "id").withColumn("call", F.pmod("block", F.lit(calls)))
    links = materialize(joined.groupBy("call").applyInArrow(run, f"a {kind}, b {kind}"), "near-links")
    discard(rows)
    return links


def _open_lists(keyed: DataFrame, label: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their components, their lists, and the lists that hold several components, one of each membership; counts are of weights."""
    if label is None:
        at = keyed.withColumn("comp", F.col("id"))
    else:
        at = keyed.join(label, keyed["id"] == label["node"], "left").select("id", "weight", "vals", F.coalesce("root", "id").alias("comp"))
    member = at.select("id", "weight", "comp", F.explode("vals.v").alias("v"))
    per = member.groupBy("v", "comp").agg(F.sum("weight").alias("count"), F.count(F.lit(1)).alias("many"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    stat = per.groupBy("v").agg(F.max(F.struct("count", "comp", "many")).alias("top"), F.sum("count").alias("all"), F.count(F.lit(1)).alias("comps"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).where("comps > 1")
    stat = materialize(stat.groupBy("x", "y", "all", "top").agg(F.min("v").alias("v")).select("v", "all", "top"), "near-open")
    return at, member, stat


def _first_rounds(keyed: DataFrame, sets: DataFrame, label: DataFrame | None, turn: int, percent: int, exact: bool) -> DataFrame:
    """Links within one open list of each document, the largest or one by lot, in blocks."""
    _, member, stat = _open_lists(keyed, label)
    rank = -F.col("all") if turn == 0 else F.xxhash64("v", F.lit(turn))
    mine = member.join(stat, "v").groupBy("id", "weight", "comp").agg(F.min(F.struct(rank.alias("r"), "v", "all")).alias("p"))
    part = F.pmod(F.xxhash64("id", F.lit(turn)), F.ceil(F.col("p.all") / BLOCK))
    return _linked(mine.select("id", "weight", "comp", F.lit(-1).alias("side"), F.col("p.v").alias("v"), part.alias("part")), sets, ["v", "part"], percent, exact)


def _last_round(keyed: DataFrame, sets: DataFrame, label: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Links between all pairs of different components that share a list."""
    at, member, stat = _open_lists(keyed, label)
    # a component with several members in a list is met as a whole; single members meet in the list
    stat = stat.select("v", "all", F.when(F.col("top.many") > 1, F.col("top.comp")).alias("main"), F.when(F.col("top.many") > 1, F.col("top.count")).otherwise(0).alias("mains"))
    rest = member.join(stat, "v").where("main is null or comp <> main")
    outside = rest.where("main is not null").select("id", "weight", "comp", "main").distinct()
    plan = outside.groupBy("main").agg(F.ceil(F.sum("weight") / BLOCK).cast("int").alias("js")).join(at.groupBy(F.col("comp").alias("main")).agg(F.ceil(F.sum("weight") / BLOCK).cast("int").alias("is_")), "main")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # a component may hold much of the documents: its rows meet one of several copies of its plan
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")
    plan = plan.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    whole = at.select("id", "weight", F.col("comp"), F.col("comp").alias("main"), salt).join(plan, ["main", "salt"]).select("id", "weight", "comp", "main", F.pmod(F.xxhash64("id", F.lit(7)), "is_").alias("i"), spread("js").alias("j")).withColumn("side", F.lit(0))
    met = outside.select("id", "weight", "comp", "main", salt).join(plan, ["main", "salt"]).select("id", "weight", "comp", "main", spread("is_").alias("i"), F.pmod(F.xxhash64("id", F.lit(7)), "js").alias("j")).withColumn("side", F.lit(1))
    across = _linked(whole.unionByName(met), sets, ["main", "i", "j"], percent, exact)

    size = F.ceil((F.col("all") - F.col("mains")) / BLOCK).cast("int")
    dealt = rest.withColumn("n", size).withColumn("own", F.pmod(F.xxhash64("id", "v"), "n").cast("int"))
    others = dealt.select("id", "weight", "comp", "v", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
    cell = others.select("id", "weight", "comp", "v", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"))
    within = _linked(cell.withColumn("side", F.lit(-1)), sets, ["v", "i", "j"], percent, exact)
    return across.unionByName(within)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, exact: bool | None = None) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept, class_size.

    Words are runs of non-space characters, A-Z lower-cased; a document's set
    holds its distinct `shingle`-word shingles, or its whole word sequence if
    it has fewer words. Documents whose sets have Jaccard similarity of
    `percent` hundredths or more are linked; component_id is the smallest id
    that links reach, and the document of that id is kept. Null and word-less
    texts have empty sets, link with nothing and stay. Rows of a null id link
    with nothing, have no component_id and stay. Rows that repeat an id are one
    document: their sets share a component. Equal sets form a class, whose
    smallest id stands for it. An empty table gives no rows; other columns are
    not read.

    With `exact`, and wherever `percent` is under LEAST_PERCENT unless it is
    False, every set enters the lists of its rarest values, nothing is
    estimated away, and no pair can be missed; that costs a list entry for
    each value.
    """
    t = percent / 100
    exact = percent < LEAST_PERCENT if exact is None else exact
    seen = materialize(_sketches(docs, id_col, text_col, shingle, exact).withColumn("nth", F.monotonically_increasing_id()), "near-sketches")
    full = seen.where("sig is not null and id is not null")
    classes = materialize(full.groupBy("sig").agg(F.min(F.struct("id", "nth")).alias("least"), F.count(F.lit(1)).alias("class_size")).select("sig", F.col("least.id").alias("rep"), F.col("least.nth").alias("rep_nth"), "class_size"), "near-classes")
    # one row a class, though rows repeat
    reps = full.join(classes, (full["sig"] == classes["sig"]) & (full["nth"] == classes["rep_nth"])).select(full["id"], "n", "triples", "vals", "least")
    keyed = materialize(_keys(reps, t), "near-keys")

    wanted = keyed.select(F.col("id").alias("w")).distinct()

    def sets_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, begin = shingle_keys(batch.column("text"), shingle)
        return pa.RecordBatch.from_arrays([batch.column("id"), binary_array(value, begin)], ["id", "set"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, F.col("id") == F.col("w"), "left_semi")
    kind = docs.schema[id_col].dataType.simpleString()
    sets = materialize(map_blocks(source, "text", sets_of, f"id {kind}, set binary").dropDuplicates(), "near-sets")

    links = _first_rounds(keyed, sets, None, 0, percent, exact)
    label = connected_components(links, "near")
    links = links.unionByName(_first_rounds(keyed, sets, label, 1, percent, exact))
    label = connected_components(links, "near")
    links = links.unionByName(_last_round(keyed, sets, label, percent, exact))
    label = connected_components(links, "near")
    discard(sets)

    same_id = classes.join(label, classes["rep"] == label["node"], "left").select("sig", "class_size", F.coalesce("root", "rep").alias("root"))
    out = seen.join(same_id, "sig", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (component.isNull() | (component == F.col("id"))).alias("kept"), F.coalesce("class_size", F.lit(1)).alias("class_size"))


def keep_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, exact: bool | None = None) -> DataFrame:
    """Rows of `docs` that stay, with their columns, whatever these are called.

    Of each group of near copies the row of the smallest id stays, all rows of
    it if it repeats. Rows of a null id, null texts and texts without words
    stay; an empty table gives no rows.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, percent, exact)
    gone = materialize(found.where(~F.col("kept")).select(F.col(id_col).alias("gone")).distinct(), "near-gone")
    return docs.alias("own").join(gone.alias("other"), F.col(f"own.`{id_col}`") == F.col("other.gone"), "left_anti")
