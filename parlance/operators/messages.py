"""Message tables: dedup, order, drops, roles, references, episodes and turns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(rows: DataFrame, key: list[str], edited: str, sent: str, line: str) -> DataFrame:
    """Per key the most recently edited row (sent time where never edited); ties go to the later line."""
    newest = F.struct(F.coalesce(F.col(edited), F.col(sent)), F.col(line))
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(newest.desc()))).where("__rank = 1").drop("__rank")


def logical_chat(chats: DataFrame) -> DataFrame:
    """Rows (id, primary_id, ord): a chat that migrated to a catalogued one joins it, one hop only; legacy peers come first."""
    target = chats.select(F.col("id").alias("migrated_to"))
    joined = chats.join(target, "migrated_to", "left_semi").select("id", F.col("migrated_to").alias("primary_id"))
    alone = chats.join(joined.select("id"), "id", "left_anti").select("id", F.col("id").alias("primary_id"))
    both = joined.unionByName(alone)
    order = Window.partitionBy("primary_id").orderBy((F.col("id") == F.col("primary_id")).cast("int"), "id")
    return both.withColumn("ord", F.row_number().over(order))


def drop_reason(is_service: Column, text: Column, has_media: Column, is_bot: Column, keep_service: bool = False, keep_bots: bool = True) -> Column:
    """Why a message is left out, or null; service comes before empty, and empty before bot."""
    out = F.when(is_service & F.lit(not keep_service), "service")
    out = out.when(~is_service & (F.coalesce(F.trim(text), F.lit("")) == "") & ~has_media, "empty")
    return out.when(is_bot & F.lit(not keep_bots), "bot")


#: Roles by precedence, and the side of each.
ROLE_SIDES = {"bot": "BOT", "support": "STAFF", "sales": "STAFF", "other": "STAFF", "anonymous": "STAFF", "client": "CLIENT", "deleted": "UNKNOWN", "system": "UNKNOWN"}


def staff_entry(entry: Column) -> Column:
    """Normal form of a configured staff entry: no @, lower case."""
    return F.lower(F.ltrim(F.trim(entry), F.lit("@")))


def roles(users: DataFrame, staff: DataFrame, me_id: int | None = None) -> DataFrame:
    """`users` (id, usernames, is_bot, is_deleted) with role and side.

    `staff` has entry (id or username) and role (support, sales, other). A
    user may match by id or by any username; the first of bot, support, sales,
    other, deleted, client that holds is the role.
    """
    rank = F.when(F.col("staff_role") == "support", 1).when(F.col("staff_role") == "sales", 2).otherwise(3)
    known = staff.select(staff_entry(F.col("entry")).alias("entry"), F.col("role").alias("staff_role"))
    names = users.select("id", F.explode(F.array_union(F.array(F.col("id").cast("string")), F.transform(F.coalesce("usernames", F.array()), lambda x: F.lower(x)))).alias("entry"))
    best = names.join(known, "entry").groupBy("id").agg(F.min_by("staff_role", rank).alias("staff_role"))
    own = F.col("id") == F.lit(me_id) if me_id is not None else F.lit(False)
    role = F.when(F.col("is_bot"), "bot").when(own, "support").when(F.col("staff_role").isNotNull(), F.col("staff_role")).when(F.col("is_deleted"), "deleted").otherwise("client")
    return users.join(best, "id", "left").withColumn("role", role).withColumn("side", side_of(F.col("role"))).drop("staff_role")


def side_of(role: Column) -> Column:
    out = F
    for name, side in ROLE_SIDES.items():
        out = out.when(role == name, side)
    return out.otherwise("UNKNOWN")


def staff_unmatched(staff: DataFrame, users: DataFrame) -> DataFrame:
    """Configured staff entries that no user matches."""
    known = users.select(F.explode(F.array_union(F.array(F.col("id").cast("string")), F.transform(F.coalesce("usernames", F.array()), lambda x: F.lower(x)))).alias("entry"))
    return staff.withColumn("entry", staff_entry(F.col("entry"))).join(known, "entry", "left_anti")


def sequence(messages: DataFrame, chat: str = "chat", forum: Column | None = None) -> DataFrame:
    """Dense seq from 1 per chat: by date, source chat and id; in a forum by topic first."""
    topic = F.when(forum, F.coalesce("topic_id", F.lit(0))).otherwise(F.lit(0)) if forum is not None else F.lit(0)
    return messages.withColumn("seq", F.row_number().over(Window.partitionBy(chat).orderBy(topic, "date", "chat_id", "id")))


def sequence_skewed(messages: DataFrame, persist: Callable[[DataFrame, str], DataFrame], chat: str = "chat", forum: Column | None = None, partitions: int | None = None) -> DataFrame:
    """`sequence` for chats that may hold much of all rows: a chat is dealt over ranges of its order.

    Rows are numbered within a range, and a range starts from the number of
    its chat's rows in the ranges before it. `persist` writes a table and
    returns it read back, so that the bounds of the ranges stay.
    """
    topic = F.when(forum, F.coalesce("topic_id", F.lit(0))).otherwise(F.lit(0)) if forum is not None else F.lit(0)
    keys = [chat, "__topic", "date", "chat_id", "id"]
    n = partitions or int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = messages.withColumn("__topic", topic).repartitionByRange(n, *keys).withColumn("__range", F.spark_partition_id())
    placed = persist(placed, "ranges")
    counts = placed.groupBy(chat, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(chat).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(chat).alias("__chat"), F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__range", chat).orderBy("__topic", "date", "chat_id", "id"))
    joined = placed.withColumn("__own", own).join(starts, (F.col(chat) == F.col("__chat")) & (F.col("__range") == F.col("__r")))
    return joined.withColumn("seq", F.col("__start") + F.col("__own")).drop("__topic", "__range", "__n", "__chat", "__r", "__start", "__own")


def relink_replies(messages: DataFrame) -> DataFrame:
    """`reply_to`: seq of the message replied to, if it is kept and comes earlier."""
    target = messages.select(F.col("chat_id").alias("t_chat"), F.col("id").alias("t_id"), F.col("seq").alias("t_seq"))
    match = (F.col("chat_id") == F.col("t_chat")) & (F.col("reply_to_id") == F.col("t_id"))
    return messages.join(target, match, "left").withColumn("reply_to", F.when(F.col("t_seq") <= F.col("seq"), F.col("t_seq"))).drop("t_chat", "t_id", "t_seq")


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def episodes(rows: DataFrame, chat: list[str], order: list[str], ts: str, topic: str | None = None, gap_hours: float = 6.0) -> DataFrame:
    """`episode` from 1: a new one begins with the first row, after a gap above `gap_hours`, or where the topic changes (null-safe)."""
    spot = Window.partitionBy(*chat).orderBy(*order)
    before = F.lag(_micros(ts)).over(spot)
    fresh = before.isNull() | (_micros(ts) - before > int(gap_hours * 3_600_000_000))
    if topic:
        fresh |= ~F.col(topic).eqNullSafe(F.lag(topic).over(spot))
    return rows.withColumn("__new", fresh.cast("int")).withColumn("episode", F.sum("__new").over(spot.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def turn_continuation(rows: DataFrame, within: list[str], order: list[str], ts: str, sender: str, breaks: Column, merge_seconds: int = 120) -> DataFrame:
    """`continues`: same known sender as the row before, within `merge_seconds`, and nothing in `breaks`."""
    spot = Window.partitionBy(*within).orderBy(*order)
    same = F.col(sender).isNotNull() & (F.col(sender) == F.lag(sender).over(spot))
    close = _micros(ts) - F.lag(_micros(ts)).over(spot) <= merge_seconds * 1_000_000
    return rows.withColumn("continues", F.coalesce(same & close & ~breaks, F.lit(False)))


def chat_stats(messages: DataFrame) -> DataFrame:
    """Per chat: message_count, episodes, first and last date in seq order."""
    return messages.groupBy("chat").agg(F.count(F.lit(1)).alias("message_count"), F.max("episode").alias("episodes"), F.min_by("date", "seq").alias("first_date"), F.max_by("date", "seq").alias("last_date"))


def by_side(messages: DataFrame) -> DataFrame:
    """Per chat a map of side to number of messages."""
    per = messages.groupBy("chat", "side").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("chat").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("side", "n")))).alias("by_side"))


def episode_rollup(messages: DataFrame) -> DataFrame:
    """Per chat and episode: topic of the first message, start and end in seq order, messages, sorted participants, sides."""
    # by side first, then over sides: the rows are read and dealt once
    per = messages.groupBy("chat", "episode", "side").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.min_by("topic", "seq").alias("topic"), F.min_by("date", "seq").alias("start"), F.max_by("date", "seq").alias("end"), F.count(F.lit(1)).alias("n"), F.collect_set("sender").alias("senders"))
    sides = F.map_from_entries(F.sort_array(F.collect_list(F.struct("side", "n"))))
    return per.groupBy("chat", "episode").agg(F.min_by("topic", "a").alias("topic"), F.min_by("start", "a").alias("start"), F.max_by("end", "b").alias("end"), F.sum("n").alias("messages"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("senders")))).alias("participants"), sides.alias("sides"))


def suspect_staff(messages: DataFrame, sender: str, chat: str, least: int = 3) -> DataFrame:
    """Senders outside staff who write in at least `least` chats."""
    return messages.where(F.col(sender).isNotNull()).groupBy(sender).agg(F.countDistinct(chat).alias("chats")).where(F.col("chats") >= least)


def code_flag(text: Column, entities: Column) -> Column:
    """Whether there are code entities and they cover at least half of the text's length, which of an empty text they do."""
    code = F.filter(entities, lambda e: e["type"].isin("Pre", "Code"))
    covered = F.aggregate(code, F.lit(0).cast("bigint"), lambda a, e: a + e["length"])
    return (F.array_size(code) > 0) & (covered * 2 >= F.length(text))


def media_label(kind: Column, ext: Column, size: Column, duration: Column, name: Column) -> Column:
    """`[kind:ext m:ss size "name"]` with the parts that are known; MB from 1,000,000 bytes on, else KB of at least 1."""
    clock = F.when(duration.isNotNull(), F.concat(F.floor(duration / 60).cast("string"), F.lit(":"), F.lpad((duration % 60).cast("string"), 2, "0")))
    tenths = F.round(size / 100_000).cast("long")
    amount = F.when(size >= 1_000_000, F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(" MB"))).when(size > 0, F.concat(F.greatest(F.lit(1), F.floor(size / 1000)).cast("string"), F.lit(" KB")))
    head = F.concat(kind, F.coalesce(F.concat(F.lit(":"), F.nullif(ext, F.lit(""))), F.lit("")))
    quoted = F.when(F.coalesce(name, F.lit("")) != "", F.concat(F.lit('"'), name, F.lit('"')))
    return F.concat(F.lit("["), F.concat_ws(" ", head, clock, amount, quoted), F.lit("]"))


def forwarded_label(kind: Column, user_vid: Column, chat_vid: Column, is_channel: Column) -> Column:
    """Where a forward comes from: a known id, or what is known of the source."""
    return F.when(kind == "user", F.coalesce(user_vid, F.lit("external_user"))).when(kind == "chat", F.coalesce(chat_vid, F.when(is_channel, "external_channel").otherwise("external_chat"))).when(kind == "hidden", "hidden").when(kind == "imported", "imported")
