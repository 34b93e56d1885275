"""Virtual ids, display names and the vocabulary of titles."""

from __future__ import annotations

import re
import secrets

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import fold
from ..functions.scrub import Scrubber
from ..functions.vocabulary import title_tokens

DIGITS = 5
#: Most digits of an id; buckets in which rows are numbered; rounds of the permutation that draws ids.
DIGITS_MOST, BUCKETS, ROUNDS = 9, 4096, 8


class MappingError(RuntimeError):
    """An id map that is full or damaged; the text never quotes a raw id."""


def check_mapping(mapping: DataFrame) -> DataFrame:
    """The map itself if ids are unique and shaped right (kind, then digits of one width a kind)."""
    bad = mapping.where(~F.col("vid").rlike("^[UC][0-9]{5,9}$") | (F.substring("vid", 1, 1) != F.col("kind"))).limit(1).count()
    twice = mapping.groupBy("vid").count().where("count > 1").limit(1).count()
    again = mapping.groupBy("kind", "raw_id").count().where("count > 1").limit(1).count()
    widths = mapping.groupBy("kind").agg(F.countDistinct(F.length("vid")).alias("w")).where("w > 1").limit(1).count()
    if bad or twice or again or widths:
        raise MappingError("the id map is damaged")
    return mapping


def _numbered(rows: DataFrame, column: str) -> DataFrame:
    """`rows` with a dense number i from 0 by a hash of `column`, whose values differ: hash buckets are numbered one by one."""
    placed = rows.withColumn("__hash", F.xxhash64(column)).withColumn("__bucket", F.pmod("__hash", F.lit(BUCKETS)))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = placed.withColumn("__own", F.row_number().over(Window.partitionBy("__bucket").orderBy("__hash", column)))
    return own.join(F.broadcast(starts), "__bucket").withColumn("i", F.col("__start") + F.col("__own") - 1).drop("__hash", "__bucket", "__own", "__start")


def _drawn(i: Column, digits: int, keys: list[str]) -> Column:
    """The i-th number of `digits` digits in an order that secret `keys` draw: a Feistel permutation of their 9 x 10^(digits - 1) numbers."""
    half = (digits - 1) // 2
    a, b = 3 * 10**half, 3 * 10 ** (digits - 1 - half)

    def mix(s: Column, key: Column) -> Column:
        noise = F.conv(F.substring(F.sha2(F.concat(key, s["y"].cast("string")), 256), 1, 15), 16, 10).cast("bigint")
        return F.struct(s["y"].alias("x"), F.pmod(s["x"] + noise, s["m"]).alias("y"), s["n"].alias("m"), s["m"].alias("n"))

    start = F.struct(F.floor(i / b).cast("bigint").alias("x"), F.pmod(i, F.lit(b)).cast("bigint").alias("y"), F.lit(a).cast("bigint").alias("m"), F.lit(b).cast("bigint").alias("n"))
    end = F.aggregate(F.array(*map(F.lit, keys)), start, mix)
    return 10 ** (digits - 1) + end["x"] * b + end["y"]


def allocate_ids(mapping: DataFrame, raw: DataFrame, kind: str, digits: int = DIGITS) -> DataFrame:
    """The map with a random unused id for every `raw` (raw_id) of `kind` that it lacks.

    Ids keep one width and say nothing of the order in which they were given.
    The width is fixed when the first ids are given: `digits`, or where these
    can't hold them, as many as leave room for as many again. An id is the next
    of a permutation whose keys are secret, so nothing as large as the space of
    ids is sorted. Keys differ from call to call: write the result before it is
    used together with another.
    """
    own = mapping.where(F.col("kind") == kind)
    new = raw.select("raw_id").where("raw_id is not null").distinct().join(own, "raw_id", "left_anti")
    need = new.count()
    if (wide := own.agg(F.max(F.length("vid") - 1)).first()[0]) is not None:
        digits = wide
    elif need > 9 * 10 ** (digits - 1):
        while digits < DIGITS_MOST and 2 * need > 9 * 10 ** (digits - 1):
            digits += 1
    taken = own.where(F.length("vid") == digits + 1).select("vid").distinct()
    used = taken.count() if wide is not None else 0
    have = 9 * 10 ** (digits - 1) - used
    if need > have:
        raise MappingError(f"{need} ids are needed and {have} of {digits} digits are left")
    keys = [secrets.token_hex(16) for _ in range(ROUNDS)]
    vid = lambda i: F.concat(F.lit(kind), _drawn(i, digits, keys).cast("string"))
    numbered = _numbered(new, "raw_id")
    if used:
        # of the first numbers in that order, as many as are needed are free
        free = mapping.sparkSession.range(need + used).select(vid(F.col("id")).alias("vid")).join(taken, "vid", "left_anti")
        given = numbered.join(_numbered(free, "vid"), "i").select(F.lit(kind).alias("kind"), "raw_id", "vid")
    else:
        given = numbered.select(F.lit(kind).alias("kind"), "raw_id", vid(F.col("i")).alias("vid"))
    return mapping.select("kind", "raw_id", "vid").unionByName(given)


def shared_vid(peers: DataFrame) -> DataFrame:
    """Rows (primary_id, peer_id, vid): the first peer, by ord, that has an id lends it to all."""
    spot = Window.partitionBy("primary_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return peers.withColumn("vid", F.first("vid", ignorenulls=True).over(spot))


_NAME = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_LABELS = frozenset("support поддержка staff client team sales служба manager менеджер админ admin bot бот".split())


def split_free_text_name(first: str) -> tuple[str, str]:
    """Given name and surname of a first-name field that holds two or three capitalised words."""
    parts = first.split()
    if 2 <= len(parts) <= 3 and all(_NAME.fullmatch(p) and p[0].isupper() and not p.isupper() for p in parts):
        return parts[0], parts[-1]
    return first.strip(), ""


def is_label(name: str) -> bool:
    """A role or team label in a name field."""
    words = fold(name).split()
    return bool(words) and all(w in _LABELS or w == "поддержки" for w in words)


def display_name(first: str | None, last: str | None, mode: str, usernames: frozenset[str], surnames: frozenset[str], scrubber: Scrubber) -> str:
    """What a virtual user is called: the given name, if it is shaped like one and names nobody else."""
    if mode == "none":
        return ""
    given, typed = split_free_text_name(first or "")
    name = " ".join(x for x in (given, (last or typed) if mode == "full" else "") if x) if given else ""
    if not name or len(name) > 30 or re.search(r"[@<>\d]|https?:|\.\w", name) or not all(_NAME.fullmatch(w) for w in name.split()):
        return ""
    if any(not w[0].isupper() or any(c.isupper() for c in w[1:].replace("-", "")) and not w.isupper() and "-" not in w for w in name.split()):
        return ""
    folded = {fold(w) for w in name.split()}
    if folded & usernames or mode == "first" and folded & surnames or scrubber.scrub(name) != name:
        return ""
    return name


def title_terms(titles: DataFrame, title: str = "title") -> DataFrame:
    """Rows (term, n, titles): in how many distinct-by-row titles each significant word stands."""

    @F.pandas_udf("array<string>")
    def tokens(part: pd.Series) -> pd.Series:
        return part.map(lambda t: title_tokens(t or ""))

    per = titles.select(F.explode(F.array_distinct(tokens(F.col(title)))).alias("term"))
    total = titles.agg(F.count(F.lit(1)).alias("titles"))
    return per.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total))


def keep_term_candidates(terms: DataFrame, share: float = 0.2, known: list[str] | None = None) -> DataFrame:
    """Terms in at least three titles and `share` of all, that are not configured already."""
    out = terms.where(F.col("n") >= F.greatest(F.lit(3.0), F.lit(share) * F.col("titles")))
    return out.where(~F.col("term").isin([fold(k) for k in known])) if known else out


def surname_field(last: Column) -> Column:
    """A last name that can be hunted for: letters, three or more, no label."""
    plain = F.lower(F.trim(last))
    return F.when(plain.rlike(r"^\p{L}[\p{L}'’-]{2,}$") & ~plain.isin(sorted(_LABELS)), plain)


def contact_names(chats: DataFrame, exported: DataFrame) -> DataFrame:
    """Titles of private dialogs that were not exported, where they read as a person's full name."""
    private = chats.where("kind = 'private'").join(exported.select("id"), "id", "left_anti")
    return private.where(F.col("title").rlike(r"^(?:\p{Lu}\p{Ll}+)(?: \p{Lu}\p{Ll}+){1,2}$")).select(F.col("title").alias("name")).distinct()


def third_party_ids(messages: DataFrame, users: DataFrame, exported: DataFrame) -> DataFrame:
    """Rows (id): accounts that messages name in forwards (from_id) and entities (user_id) and that are neither known users nor exported chats."""
    forwarded = messages.select(F.col("forward.from_id").alias("id"))
    named = messages.select(F.explode(F.transform("entities", lambda e: e["user_id"])).alias("id"))
    seen = forwarded.union(named).where("id is not null").distinct()
    return seen.join(users.select("id"), "id", "left_anti").join(exported.select("id"), "id", "left_anti")


def given_name_counts(users: DataFrame, first: str = "first_name") -> DataFrame:
    """Rows (name, n): how many users have a given name, by its first word in lower case."""
    word = F.regexp_extract(F.lower(F.translate(F.col(first), "Ёё", "Ее")), r"^\s*(\p{L}[\p{L}'’-]*)", 1)
    return users.select(word.alias("name")).where("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
