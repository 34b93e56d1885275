"""Queries of the library's own operators over the driver's tables, and their SQL.

The tables stand in for a message store: conversations are messages, events
are timed messages of a user (event_type is the topic), customers are users,
suppliers are staff, nations are chats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import cards, checksums, links, rule_cases
from .functions.scrub import check_column, rules_column, scan_column, scrub_column, text_column
from .functions.vocabulary import GENERIC, Roster
from .operators import audit, chats, identity, messages, render
from .plans.parallel import dealt, spread
from .plans.policy import Anonymize, ChatFilter, Output
from .sources import store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query by its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _event_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, with an edit of every seventh and a replay of every fifth."""
    e = _read(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    first = e.withColumn("edit_ts", F.lit(None).cast("timestamp")).withColumn("line", F.lit(1))
    edit = e.where("event_id % 7 = 0").withColumn("edit_ts", F.col("ts") + F.expr("interval 1 hour")).withColumn("line", F.lit(2))
    replay = e.where("event_id % 5 = 0").withColumn("edit_ts", F.lit(None).cast("timestamp")).withColumn("line", F.lit(3))
    return first.unionByName(edit).unionByName(replay)


# ---- silver: dedup, upsert, plan, roles, order -----------------------------


@query("""
    WITH m AS (
        SELECT user_id, event_id, ts, NULL::TIMESTAMP AS edit_ts, 1 AS line FROM events
        UNION ALL SELECT user_id, event_id, ts, ts + INTERVAL 1 HOUR, 2 FROM events WHERE event_id % 7 = 0
        UNION ALL SELECT user_id, event_id, ts, NULL, 3 FROM events WHERE event_id % 5 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY coalesce(edit_ts, ts) DESC, line DESC) AS k FROM m)
    SELECT user_id, event_id, line, edit_ts IS NOT NULL AS edited FROM r WHERE k = 1""")
def msg_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = messages.dedup_latest(_event_edits(spark, sf_dir), ["user_id", "event_id"], "edit_ts", "ts", "line")
    return got.select("user_id", "event_id", "line", F.col("edit_ts").isNotNull().alias("edited"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("username"), F.lit("").alias("phone"), (F.col("c_custkey") % 10 == 0).alias("is_bot"), (F.col("c_custkey") % 11 == 0).alias("is_deleted"), F.array(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string"))).alias("usernames"))


@query("""
    WITH o AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT * FROM customer WHERE c_custkey % 2 = 0)
    SELECT coalesce(n.c_custkey, o.c_custkey) AS id,
           coalesce(CASE WHEN n.c_custkey % 4 = 0 THEN NULL ELSE n.c_name END, o.c_name) AS first_name,
           coalesce(n.c_mktsegment, o.c_mktsegment) AS last_name,
           coalesce(n.c_custkey % 10 = 0, false) OR coalesce(o.c_custkey % 10 = 0, false) AS is_bot,
           CASE WHEN n.c_custkey IS NOT NULL AND o.c_custkey IS NOT NULL THEN 2 ELSE 1 END AS n_usernames
    FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def user_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _users(spark, sf_dir)
    new = u.where("id % 2 = 0").withColumn("first_name", F.when(F.col("id") % 4 == 0, "").otherwise(F.col("first_name"))).withColumn("usernames", F.array(F.concat(F.lit("new_"), F.col("id").cast("string"))))
    got = store.upsert_users(u.where("id % 3 <> 0"), new)
    return got.select("id", "first_name", "last_name", "is_bot", F.size("usernames").alias("n_usernames"))


@query("""
    WITH o AS (SELECT * FROM nation WHERE n_nationkey % 3 <> 0), n AS (SELECT * FROM nation WHERE n_nationkey % 2 = 0)
    SELECT coalesce(n.n_nationkey, o.n_nationkey) AS id, CASE WHEN n.n_nationkey IS NOT NULL THEN upper(n.n_name) ELSE o.n_name END AS title,
           CASE WHEN n.n_nationkey IS NOT NULL AND n.n_nationkey % 4 = 0 THEN 2 WHEN o.n_nationkey IS NOT NULL THEN 1 END AS roster
    FROM o FULL JOIN n ON o.n_nationkey = n.n_nationkey""")
def chat_upsert_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("title"))
    old = n.where("id % 3 <> 0").withColumn("participant_ids", F.array(F.col("id")))
    new = n.where("id % 2 = 0").select("id", F.upper("title").alias("title"), F.when(F.col("id") % 4 == 0, F.array(F.col("id"), F.col("id") + 1)).otherwise(F.array().cast("array<bigint>")).alias("participant_ids"))
    got = store.upsert_chats(old, new)
    return got.select("id", "title", F.when(F.col("participant_ids").isNotNull(), F.size("participant_ids")).alias("roster"))


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select(
        k.alias("id"), F.when(k % 7 == 0, "private").when(k % 5 == 0, "channel").when(k % 2 == 0, "supergroup").otherwise("group").alias("kind"), F.concat(F.col("c_mktsegment"), F.lit(" "), k.cast("string")).alias("title"),
        (k % 13 != 0).alias("is_accessible"), (k % 6 == 0).alias("is_archived"), F.when((k % 2 == 1) & (k % 9 == 0), k + 1).alias("migrated_to"),
    )


_CHATS_SQL = """
    WITH c AS (
        SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 'private' WHEN c_custkey % 5 = 0 THEN 'channel' WHEN c_custkey % 2 = 0 THEN 'supergroup' ELSE 'group' END AS kind,
               c_mktsegment || ' ' || c_custkey AS title, c_custkey % 13 <> 0 AS is_accessible, c_custkey % 6 = 0 AS is_archived,
               CASE WHEN c_custkey % 2 = 1 AND c_custkey % 9 = 0 THEN c_custkey + 1 END AS migrated_to
        FROM customer)"""


@query(f"""{_CHATS_SQL},
    r AS (SELECT *, CASE WHEN id IN (4, 8, 9) THEN 'exclude_ids' WHEN id IN (7, 35) THEN 'include_ids' WHEN kind NOT IN ('group', 'supergroup') THEN 'type'
                    WHEN NOT is_accessible THEN 'access' WHEN is_archived THEN 'archived' WHEN contains(lower(title), 'building') THEN 'title' ELSE 'included' END AS reason FROM c),
    i AS (SELECT *, CASE WHEN reason = 'included' AND id % 17 = 0 THEN 'internal' ELSE reason END AS own FROM r),
    j AS (SELECT *, own IN ('included', 'include_ids') AS inc FROM i)
    SELECT j.id, CASE WHEN coalesce(t.inc AND t.is_accessible, false) AND j.own <> 'exclude_ids' THEN 'merged' WHEN t.own = 'internal' AND j.inc THEN 'internal' ELSE j.own END AS reason,
           CASE WHEN coalesce(t.inc AND t.is_accessible, false) AND j.own <> 'exclude_ids' THEN true WHEN t.own = 'internal' AND j.inc THEN false ELSE j.inc END AS included,
           CASE WHEN coalesce(t.inc AND t.is_accessible, false) AND j.own <> 'exclude_ids' THEN j.migrated_to END AS merged_into
    FROM j LEFT JOIN j t ON j.migrated_to = t.id""")
def chat_plan_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = ChatFilter(exclude_ids=frozenset({4, 8, 9}), include_ids=frozenset({7, 35}), include_archived=False, exclude_title_regex=("building",))
    internal = _chats(spark, sf_dir).where("id % 17 = 0").select(F.col("id").alias("chat_id"))
    return chats.plan(_chats(spark, sf_dir), policy, internal).select("id", "reason", "included", "merged_into")


@query("""SELECT conv_id AS chat_id FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role <> 'system') > 0 AND bool_and(role = 'assistant' OR conv_id % 3 = 0) FILTER (role <> 'system')""")
def internal_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations")
    return chats.internal_chats(c.select(F.col("conv_id").alias("chat_id"), (F.col("role") == "system").alias("is_bot"), ((F.col("role") == "assistant") | (F.col("conv_id") % 3 == 0)).alias("is_staff"), F.lit(True).alias("complete")))


@query("""
    WITH c AS (SELECT DISTINCT conv_id AS id, CASE WHEN conv_id % 3 = 0 THEN conv_id + 1 END AS migrated_to FROM conversations),
    m AS (SELECT c.id, coalesce(t.id, c.id) AS primary_id FROM c LEFT JOIN c t ON c.migrated_to = t.id)
    SELECT id, primary_id, row_number() OVER (PARTITION BY primary_id ORDER BY CASE WHEN id = primary_id THEN 1 ELSE 0 END, id) AS ord FROM m""")
def logical_chat_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")).distinct()
    return messages.logical_chat(c.withColumn("migrated_to", F.when(F.col("id") % 3 == 0, F.col("id") + 1)))


@query("""
    SELECT conv_id, turn, CASE role WHEN 'user' THEN 'client' WHEN 'assistant' THEN 'support' WHEN 'system' THEN 'bot' ELSE 'other' END AS chat_role,
           CASE role WHEN 'user' THEN 'CLIENT' WHEN 'assistant' THEN 'STAFF' WHEN 'system' THEN 'BOT' ELSE 'STAFF' END AS side FROM conversations""")
def roles_and_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("role") == "user", "client").when(F.col("role") == "assistant", "support").when(F.col("role") == "system", "bot").otherwise("other")
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("chat_role")).withColumn("side", messages.side_of(F.col("chat_role")))


def _staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.when(k % 2 == 0, F.concat(F.lit("@CUST_"), (k * 30).cast("string"))).otherwise((k * 50).cast("string")).alias("entry"), F.when(k % 3 == 0, "sales").when(k % 3 == 1, "support").otherwise("other").alias("role"))


_STAFF_SQL = """
    WITH s AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'cust_' || (s_suppkey * 30) ELSE CAST(s_suppkey * 50 AS VARCHAR) END AS entry,
                      CASE s_suppkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 3 END AS rank FROM supplier)"""


@query(f"""{_STAFF_SQL},
    b AS (SELECT c_custkey AS id, min(rank) AS rank FROM customer JOIN s ON s.entry IN (CAST(c_custkey AS VARCHAR), 'cust_' || c_custkey) GROUP BY 1)
    SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'bot' WHEN c_custkey = 3 THEN 'support' WHEN rank = 1 THEN 'support' WHEN rank = 2 THEN 'sales' WHEN rank = 3 THEN 'other' WHEN c_custkey % 11 = 0 THEN 'deleted' ELSE 'client' END AS role,
           CASE WHEN c_custkey % 10 = 0 THEN 'BOT' WHEN c_custkey = 3 OR rank IS NOT NULL THEN 'STAFF' WHEN c_custkey % 11 = 0 THEN 'UNKNOWN' ELSE 'CLIENT' END AS side
    FROM customer LEFT JOIN b ON b.id = c_custkey""")
def roles_by_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.roles(_users(spark, sf_dir), _staff(spark, sf_dir), me_id=3).select("id", "role", "side")


@query(f"""{_STAFF_SQL} SELECT entry FROM s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE s.entry IN (CAST(c_custkey AS VARCHAR), 'cust_' || c_custkey))""")
def staff_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.staff_unmatched(_staff(spark, sf_dir), _users(spark, sf_dir)).select("entry")


def _dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations")
    text = F.when(F.col("turn") % 7 == 6, "").otherwise(F.col("text"))
    reason = messages.drop_reason((F.col("turn") % 5 == 4) & (F.col("conv_id") % 2 == 0), text, F.col("turn") % 3 == 0, F.col("role") == "system", keep_bots=False)
    return c.withColumn("drop_reason", reason)


_DROPPED_SQL = """
    WITH c AS (SELECT *, CASE WHEN turn % 5 = 4 AND conv_id % 2 = 0 THEN 'service' WHEN trim(CASE WHEN turn % 7 = 6 THEN '' ELSE coalesce(text, '') END) = '' AND turn % 3 <> 0 THEN 'empty'
                      WHEN role = 'system' THEN 'bot' END AS drop_reason FROM conversations)"""


@query(f"{_DROPPED_SQL} SELECT drop_reason, count(*) AS n FROM c GROUP BY drop_reason")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dropped(spark, sf_dir).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


def _sequenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _dropped(spark, sf_dir).where("drop_reason is null")
    rows = kept.select(F.col("conv_id").alias("chat"), F.col("conv_id").alias("chat_id"), F.col("turn").alias("id"), F.col("turn").alias("date"), "role", "text", F.when(F.col("turn") > 0, F.col("turn") - 1).alias("reply_to_id"))
    return messages.sequence(rows)


@query(f"{_DROPPED_SQL} SELECT conv_id AS chat, turn AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seq FROM c WHERE drop_reason IS NULL")
def message_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sequenced(spark, sf_dir).select("chat", "id", "seq")


@query("""SELECT user_id AS chat, event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN user_id % 2 = 0 THEN coalesce(value::BIGINT % 3, 0) ELSE 0 END, ts, event_id) AS seq
          FROM (SELECT user_id, event_id, ts, event_id % 3 AS value FROM events)""")
def forum_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select(F.col("user_id").alias("chat"), F.col("user_id").alias("chat_id"), F.col("event_id").alias("id"), F.col("ts").alias("date"), (F.col("event_id") % 3).alias("topic_id"))
    return messages.sequence(e, forum=F.col("chat") % 2 == 0).select("chat", "id", "seq")


@query(f"""{_DROPPED_SQL}, s AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seq FROM c WHERE drop_reason IS NULL)
    SELECT s.conv_id AS chat, s.seq, t.seq AS reply_to FROM s LEFT JOIN s t ON s.conv_id = t.conv_id AND t.turn = s.turn - 1 AND s.turn > 0""")
def reply_relink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.relink_replies(_sequenced(spark, sf_dir)).select("chat", "seq", "reply_to")


# ---- episodes, turns, aggregates -------------------------------------------

_EPISODES_SQL = """
    WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000 {topic} THEN 1 ELSE 0 END AS fresh
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    e AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS episode FROM g)"""


@query(_EPISODES_SQL.format(topic="") + " SELECT event_id, user_id, episode FROM e")
def episodes_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.episodes(_read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "ts").select("event_id", "user_id", "episode")


@query(_EPISODES_SQL.format(topic="OR event_type IS DISTINCT FROM lag(event_type) OVER w") + " SELECT event_id, user_id, episode FROM e")
def episodes_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.episodes(_read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "ts", "event_type").select("event_id", "user_id", "episode")


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = messages.episodes(_read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "ts")
    seq = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("chat"), "episode", seq.alias("seq"), F.col("ts").alias("date"), F.col("event_type").alias("topic"), F.concat(F.lit("U"), (F.col("event_id") % 5).cast("string")).alias("sender"), F.when(F.col("event_id") % 2 == 0, "CLIENT").otherwise("STAFF").alias("side"))


@query(_EPISODES_SQL.format(topic="") + """
    SELECT user_id AS chat, episode, arg_min(event_type, (ts, event_id)) AS topic, arg_min(ts, (ts, event_id)) AS start, arg_max(ts, (ts, event_id)) AS "end", count(*) AS messages,
           string_agg(DISTINCT 'U' || (event_id % 5), ',' ORDER BY 'U' || (event_id % 5)) AS participants, count(*) FILTER (event_id % 2 = 0) AS clients
    FROM e GROUP BY user_id, episode""")
def episode_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = messages.episode_rollup(_event_messages(spark, sf_dir))
    return got.select("chat", "episode", "topic", "start", "end", "messages", F.array_join("participants", ",").alias("participants"), F.coalesce(F.col("sides")["CLIENT"], F.lit(0)).alias("clients"))


@query(_EPISODES_SQL.format(topic="") + """
    SELECT user_id AS chat, count(*) AS message_count, max(episode) AS episodes, min(ts) AS first_date, max(ts) AS last_date FROM e GROUP BY user_id""")
def chat_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.chat_stats(_event_messages(spark, sf_dir))


@query(_EPISODES_SQL.format(topic="") + """
    SELECT event_id, coalesce(event_type = lag(event_type) OVER w AND epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 7200000000 AND event_id % 6 <> 0, false) AS continues
    FROM e WINDOW w AS (PARTITION BY user_id, episode ORDER BY ts, event_id)""")
def turn_continuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = messages.episodes(_read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "ts")
    return messages.turn_continuation(e, ["user_id", "episode"], ["ts", "event_id"], "ts", "event_type", F.col("event_id") % 6 == 0, merge_seconds=7200).select("event_id", "continues")


@query("SELECT user_id, count(DISTINCT event_type) AS chats FROM events GROUP BY user_id HAVING count(DISTINCT event_type) >= 3")
def suspect_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.suspect_staff(_read(spark, sf_dir, "events"), "user_id", "event_type")


@query("""SELECT conv_id AS chat, CASE role WHEN 'user' THEN 'CLIENT' WHEN 'assistant' THEN 'STAFF' ELSE 'BOT' END AS side, count(*) AS n FROM conversations GROUP BY 1, 2""")
def chat_stats_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chat"), F.when(F.col("role") == "user", "CLIENT").when(F.col("role") == "assistant", "STAFF").otherwise("BOT").alias("side"))
    return messages.by_side(c).select("chat", F.explode("by_side").alias("side", "n"))


@query("""SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS chats, (SELECT count(*) FROM conversations) AS messages, (SELECT count(*) FROM customer) AS users,
                 (SELECT min(ts) FROM events) AS first_date, (SELECT max(ts) FROM events) AS last_date""")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "conversations").agg(F.countDistinct("conv_id").alias("chats"), F.count(F.lit(1)).alias("messages"))
    u = _read(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("users"))
    e = _read(spark, sf_dir, "events").agg(F.min("ts").alias("first_date"), F.max("ts").alias("last_date"))
    one = [x.withColumn("k", F.lit(1)) for x in (c, u, e)]
    return one[0].join(one[1], "k").join(one[2], "k").drop("k")


@query("""
    SELECT e.event_id, CASE event_type WHEN 'click' THEN coalesce('U' || c.c_custkey, 'external_user') WHEN 'view' THEN CASE WHEN n.n_nationkey IS NOT NULL THEN 'C' || n.n_nationkey WHEN e.event_id % 2 = 0 THEN 'external_channel' ELSE 'external_chat' END
           WHEN 'purchase' THEN 'hidden' ELSE 'imported' END AS label
    FROM events e LEFT JOIN customer c ON c.c_custkey = e.event_id LEFT JOIN nation n ON n.n_nationkey = e.event_id % 50""")
def forward_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    u = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event_id"), F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("user_vid"))
    n = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("nk"), F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("chat_vid"))
    kind = F.when(F.col("event_type") == "click", "user").when(F.col("event_type") == "view", "chat").when(F.col("event_type") == "purchase", "hidden").otherwise("imported")
    j = e.join(u, "event_id", "left").join(n, F.col("event_id") % 50 == F.col("nk"), "left")
    return j.select("event_id", messages.forwarded_label(kind, F.col("user_vid"), F.col("chat_vid"), F.col("event_id") % 2 == 0).alias("label"))


@query("""
    SELECT chat_id, CASE WHEN user_id % 2 = 0 THEN max(event_id) ELSE greatest(max(event_id), 500) END AS last_id, count(*) + CASE WHEN user_id % 2 = 0 THEN 0 ELSE 10 END AS appended
    FROM (SELECT user_id, user_id AS chat_id, event_id FROM events) GROUP BY chat_id, user_id""")
def cursor_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _read(spark, sf_dir, "events").select(F.col("user_id").alias("chat_id"), F.col("event_id").alias("id"))
    cursor = batch.where("chat_id % 2 = 1").select("chat_id").distinct().select("chat_id", F.lit(500).cast("bigint").alias("last_id"), F.lit(10).cast("bigint").alias("appended"), F.lit(None).cast("timestamp").alias("updated_at"))
    return store.advance_cursor(cursor, batch).select("chat_id", "last_id", "appended")


@query("SELECT user_id AS chat_id, event_id AS id FROM events WHERE event_id > CASE WHEN user_id % 2 = 1 THEN 500 ELSE 0 END")
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select(F.col("user_id").alias("chat_id"), F.col("event_id").alias("id"))
    cursor = rows.where("chat_id % 2 = 1").select("chat_id").distinct().withColumn("last_id", F.lit(500))
    return store.newer_than_cursor(rows, cursor)


# ---- links, titles ---------------------------------------------------------

_HOST_SQL = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@ ]*@)?([^/:?# ]+)', 1))"


@query(f"SELECT host, count(*) AS n FROM (SELECT {_HOST_SQL} AS host FROM pages) GROUP BY host ORDER BY n DESC, host LIMIT 100")
def domain_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = _read(spark, sf_dir, "pages").select(links.url_host(F.col("url")).alias("host"))
    return hosts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "host").limit(100)


@query("SELECT page_id, '<url>' AS shown FROM pages")
def url_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", links.url_shown(F.col("url"), "drop").alias("shown"))


@query(f"SELECT page_id, CASE WHEN {_HOST_SQL} = '' THEN '<url>' ELSE '<url:' || {_HOST_SQL} || '>' END AS shown FROM pages")
def url_domain_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", links.url_shown(F.col("url"), "domain").alias("shown"))


@query(f"""SELECT page_id, CASE WHEN h = '' THEN '<url>' WHEN h = 'example.com' THEN h WHEN suffix(h, '.example.com') THEN '<sub>.example.com' WHEN h = 'spam-farm.example.org' THEN h ELSE '<url>' END AS shown
           FROM (SELECT page_id, {_HOST_SQL} AS h FROM pages)""")
def allow_domains_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", links.url_shown(F.col("url"), "drop", ("*.example.com", "spam-farm.example.org")).alias("shown"))


_TITLE_SQL = f"""
    WITH w AS (SELECT DISTINCT p_partkey, unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS term FROM part),
    t AS (SELECT term, count(*) AS n, (SELECT count(*) FROM part) AS titles FROM w WHERE length(term) > 2 AND NOT regexp_matches(term, '^[0-9]+$')
          AND term NOT IN ({', '.join(repr(w) for w in sorted(GENERIC))}) GROUP BY term)"""


@query(f"{_TITLE_SQL} SELECT term, n, titles FROM t")
def title_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.title_terms(_read(spark, sf_dir, "part"), "p_name")


@query(f"{_TITLE_SQL} SELECT term, n FROM t WHERE n >= greatest(3.0, 0.02 * titles)")
def keep_term_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.keep_term_candidates(identity.title_terms(_read(spark, sf_dir, "part"), "p_name"), share=0.02).select("term", "n")


# ---- checksums and extraction ----------------------------------------------

_NUMBERS = "SELECT o_orderkey, lpad(CAST(o_orderkey * 7919 + o_custkey * 104729 AS VARCHAR), {n}, '{pad}') AS d FROM orders"


def _numbers(spark: SparkSession, sf_dir: str, n: int, pad: str = "7") -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", F.lpad((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729).cast("string"), n, pad).alias("d"))


def _dot_sql(weights: tuple[int, ...]) -> str:
    return "(" + " + ".join(f"{w} * CAST(substr(d, {i + 1}, 1) AS INTEGER)" for i, w in enumerate(weights)) + ")"


def _check(name: str, n: int, test: Callable[[Column], Column], sql: str, pad: str = "7") -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _numbers(spark, sf_dir, n, pad).select("o_orderkey", "d", test(F.col("d")).alias("ok"))

    run.__name__ = name
    query(f"WITH x AS ({_NUMBERS.format(n=n, pad=pad)}) SELECT o_orderkey, d, {sql} AS ok FROM x")(run)


_DIGIT = "CAST(substr(d, {0}, 1) AS INTEGER)"
_check("inn_ok", 10, checksums.inn, f"{_dot_sql(checksums.INN_10)} % 11 % 10 = {_DIGIT.format(10)}")
_check("inn12_ok", 12, checksums.inn, f"{_dot_sql(checksums.INN_11)} % 11 % 10 = {_DIGIT.format(11)} AND {_dot_sql(checksums.INN_12)} % 11 % 10 = {_DIGIT.format(12)}")
_check("ogrn_ok", 13, checksums.ogrn, f"CAST(substr(d, 1, 12) AS BIGINT) % 11 % 10 = {_DIGIT.format(13)}", "1")
_check("ogrn15_ok", 15, checksums.ogrn, f"CAST(substr(d, 1, 14) AS BIGINT) % 13 % 10 = {_DIGIT.format(15)}", "3")
_check("snils_ok", 11, checksums.snils, f"CASE WHEN {_dot_sql(checksums.SNILS)} < 100 THEN {_dot_sql(checksums.SNILS)} ELSE {_dot_sql(checksums.SNILS)} % 101 % 100 END = CAST(substr(d, 10, 2) AS INTEGER)", "1")
_check("kz_iin_ok", 12, checksums.kz_id, f"coalesce(CASE WHEN {_dot_sql(checksums.KZ_1)} % 11 < 10 THEN {_dot_sql(checksums.KZ_1)} % 11 WHEN {_dot_sql(checksums.KZ_2)} % 11 < 10 THEN {_dot_sql(checksums.KZ_2)} % 11 END = {_DIGIT.format(12)}, false)", "9")
_check("ua_rnokpp_ok", 10, checksums.ua_rnokpp, f"({_dot_sql(checksums.UA)} % 11 + 11) % 11 % 10 = {_DIGIT.format(10)}", "3")


@query("""WITH x AS (SELECT o_orderkey, 'DE' || lpad(CAST(o_orderkey % 97 + 2 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey * 7919 + o_custkey * 104729 AS VARCHAR), 18, '3') AS iban FROM orders)
          SELECT o_orderkey, iban, CAST(substr(iban, 5) || '1314' || substr(iban, 3, 2) AS HUGEINT) % 97 = 1 AS ok FROM x""")
def iban_mod97(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.concat(F.lit("DE"), F.lpad((F.col("o_orderkey") % 97 + 2).cast("string"), 2, "0"))
    x = _numbers(spark, sf_dir, 18, "3").select("o_orderkey", F.concat(head, F.col("d")).alias("iban"))
    return x.select("o_orderkey", "iban", checksums.iban(F.col("iban")).alias("ok"))


_RUN13 = r"(?:^|[^0-9])([0-9]{13,19})(?:[^0-9]|$)"
_LUHN_SQL = "list_sum([CASE WHEN (length(d) - i) % 2 = 1 THEN (CAST(d[i] AS INTEGER) * 2) // 10 + (CAST(d[i] AS INTEGER) * 2) % 10 ELSE CAST(d[i] AS INTEGER) END FOR i IN range(1, length(d) + 1)]) % 10 = 0"


@query(f"WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_RUN13}', 1)) AS d FROM documents) SELECT doc_id, d, {_LUHN_SQL} AS ok FROM r")
def luhn_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_RUN13), 1)).alias("d"))
    return r.select("doc_id", "d", checksums.luhn(F.col("d")).alias("ok"))


#: What the scrubber finds in documents, by rule, with the shape of the surfaces meant; the same shapes as RE2 reads them, and which of them are no values.
FOUND = {
    "emails_found": ("email", None, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", "true"),
    "phones_found": ("phone", None, r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "true"),
    "ipv4_found": ("ipv4", None, r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", "x NOT LIKE '127.%' AND list_max([CAST(o AS INTEGER) FOR o IN string_split(x, '.')]) <= 255"),
    "token_assign_found": ("env_secret", "^[0-9a-f]{40}$", r"token = .[0-9a-f]{40}", "true"),
}


def _hits(spark: SparkSession, sf_dir: str, rule: str, policy: Anonymize | None = None) -> DataFrame:
    """Rows (doc_id, surface, replacement) of what the scrubber replaces by a rule."""
    found = _texts(spark, sf_dir).select("doc_id", F.explode(scrub_column(F.col("text"), policy)["hits"]).alias("h"))
    return found.where(F.col("h.rule") == rule).select("doc_id", "h.surface", "h.replacement")


def _found(name: str, rule: str, shape: str | None, pattern: str, keep: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hits = _hits(spark, sf_dir, rule)
        return (hits.where(F.col("surface").rlike(shape)) if shape else hits).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))

    run.__name__ = name
    query(f"SELECT doc_id, n FROM (SELECT doc_id, len(list_filter(regexp_extract_all(text, '{pattern}'), lambda x: {keep})) AS n FROM documents) WHERE n > 0")(run)


for _name, _own in FOUND.items():
    _found(_name, *_own)


@query(f"WITH r AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) BETWEEN 13 AND 19)) AS d FROM documents) SELECT doc_id, substr(d, 1, 6) || repeat('*', length(d) - 6) AS masked FROM r WHERE {_LUHN_SQL}")
def cards_masked_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.explode(cards.masked_runs(F.col("text"))).alias("masked"))


# ---- scrub and audit -------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def scrub_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _texts(spark, sf_dir)
    return d.select("doc_id", scrub_column(F.col("text")).alias("s")).select("doc_id", F.col("s.text").alias("text"), F.size("s.hits").alias("n_hits"))


@query()
def scrub_hits_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _texts(spark, sf_dir).select(F.explode(rules_column(F.col("text"))).alias("rule"))
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query()
def leak_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks before and after scrubbing; after it there are none. One pass scrubs a text and scans the result, if that differs."""
    done = _texts(spark, sf_dir).select(check_column(F.col("text"), shown=False).alias("s"))
    sums = done.agg(F.sum("s.raw").alias("raw"), F.sum("s.left_over").alias("scrubbed"))
    return sums.selectExpr("stack(2, 'raw', raw, 'scrubbed', scrubbed) AS (state, leaks)")


@query(r"""
    WITH t AS (SELECT url || '.' AS text, url FROM pages),
    u AS (SELECT unnest(regexp_extract_all(text, '(?i)[a-z][a-z0-9+.-]*://[^\s<>"]+')) AS link FROM t UNION ALL SELECT url FROM t),
    h AS (SELECT lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@ ]*@)?([^/:?# ]+)', 1)) AS host FROM u)
    SELECT host, count(*) AS n FROM h WHERE host <> '' GROUP BY host ORDER BY n DESC, host LIMIT 100""")
def domains_in_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of links in texts and of links behind words."""
    p = _read(spark, sf_dir, "pages").select(F.concat("url", F.lit(".")).alias("text"), F.array(F.struct(F.lit("TextUrl").alias("type"), F.col("url"))).alias("entities"))
    return links.domain_counts(p, 100)


@query()
def scrub_with_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = Anonymize(custom_patterns=(r"licensed under[^.\n]{1,60}",), keep_terms=("MIT",))
    roster = Roster(usernames={"worthless_": "U10001"}, organisations=("Released",), keep=("MIT",))
    d = _texts(spark, sf_dir)
    return d.select("doc_id", text_column(F.col("text"), policy, roster).alias("text"))


@query(r"SELECT doc_id, unnest(regexp_extract_all(text, '(?i)licensed under [^.\n]{1,60}')) AS surface, '<redacted>' AS shown FROM documents")
def custom_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = Anonymize(custom_patterns=(r"licensed under [^.\n]{1,60}",))
    return _hits(spark, sf_dir, "custom", policy).select("doc_id", "surface", F.col("replacement").alias("shown"))


@query("""SELECT event_id, key AS path, json_extract_string(props, '$.' || key) AS leaf FROM events, unnest(json_keys(props)) AS t(key)
          WHERE json_type(props, '$.' || key) = 'VARCHAR'
          UNION ALL SELECT event_id, key, key FROM events, unnest(json_keys(props)) AS t(key)""")
def json_flatten_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("event_id", F.explode(audit.json_units(F.col("props"))).alias("u"))
    return e.select("event_id", F.col("u.path").alias("path"), F.col("u.text").alias("leaf"))


# ---- render and pack -------------------------------------------------------


_SPACE, _SOLID = render.SPACE, render.SOLID


def _head_sql(text: str, n: int) -> str:
    part = f"substr({text}, 1, {n})"
    return f"regexp_replace(CASE WHEN length({text}) <= {n} OR regexp_matches(substr({text}, {n + 1}, 1), '^{_SPACE}$') OR NOT regexp_matches({part}, '{_SPACE}') THEN {part} ELSE regexp_replace({part}, '{_SOLID}*$', '') END, '{_SPACE}+$', '')"


def _shorten_sql(text: str, limit: int) -> str:
    n = limit // 4
    part = f"right({text}, {n})"
    tail = f"regexp_replace(CASE WHEN length({text}) <= {n} OR regexp_matches(substr({text}, length({text}) - {n}, 1), '^{_SPACE}$') OR NOT regexp_matches({part}, '{_SPACE}') THEN {part} ELSE regexp_replace({part}, '^{_SOLID}*', '') END, '^{_SPACE}+', '')"
    head = _head_sql(text, limit * 3 // 4)
    return f"CASE WHEN length({text}) > {limit} THEN {head} || chr(10) || '[... ' || (length({text}) - length({head}) - length({tail})) || ' chars omitted ...]' || chr(10) || {tail} ELSE {text} END"


def _quote_sql(text: str) -> str:
    joined = f"array_to_string(list_filter([trim(regexp_replace(x, '{_SPACE}+', ' ', 'g')) FOR x IN regexp_split_to_array({text}, '{render.BREAK}')], lambda x: x <> ''), ' ⏎ ')"
    return f"CASE WHEN length({joined}) > 60 THEN {_head_sql(joined, 57)} || '...' ELSE {joined} END"


@query(f"SELECT doc_id, {_shorten_sql('text', 1200)} AS text FROM documents")
def shorten_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", render.shorten(F.col("text"), 1200).alias("text"))


@query(f"SELECT conv_id, turn, {_quote_sql('text')} AS quote FROM conversations")
def quote_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", render.quote(F.col("text")).alias("quote"))


@query("""
    WITH RECURSIVE o AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
    p AS (SELECT doc_id, source, i, 1 AS chunk, n_chars AS used FROM o WHERE i = 1
          UNION ALL SELECT o.doc_id, o.source, o.i, CASE WHEN p.used + o.n_chars > 10000 AND p.used > 0 THEN p.chunk + 1 ELSE p.chunk END, CASE WHEN p.used + o.n_chars > 10000 AND p.used > 0 THEN o.n_chars ELSE p.used + o.n_chars END
          FROM p JOIN o ON o.source = p.source AND o.i = p.i + 1)
    SELECT doc_id, source, chunk FROM p""")
def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return render.pack_chunks(d, ["doc_id"], "n_chars", 10_000, shards=["source"]).select("doc_id", "source", "chunk")


#: A message every minute from the start of 2024, an episode every 20 turns; users speak as clients, others as staff.
_TRANSCRIPT_SQL = f"""{_DROPPED_SQL}, m AS (
        SELECT conv_id AS chat, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seq, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(turn) AS moment, turn // 20 + 1 AS episode,
               CASE WHEN turn % 7 > 0 THEN 'U' || (10000 + turn % 2) END AS sender, CASE WHEN turn % 2 = 0 THEN 'client' ELSE 'support' END AS role, CASE WHEN turn % 2 = 0 THEN 'CLIENT' ELSE 'STAFF' END AS side,
               CASE WHEN turn % 2 = 0 THEN 'Ann' ELSE '' END AS name, text, turn % 5 = 4 AS code, CASE WHEN turn % 6 = 5 THEN 'pinned' END AS action, CASE WHEN turn % 4 = 3 THEN 'U10009' END AS forwarded,
               CASE WHEN turn % 3 = 2 THEN '[photo]' END AS media FROM c WHERE drop_reason IS NULL),
    r AS (SELECT m.*, t.seq AS reply_to, coalesce(t.sender, 'SYSTEM') AS who, {_quote_sql("t.text")} AS q FROM m LEFT JOIN m t ON m.chat = t.chat AND m.turn % 3 = 1 AND t.turn = m.turn - 1),
    p AS (SELECT r.*, coalesce(sender = lag(sender) OVER (PARTITION BY chat, episode ORDER BY seq) AND epoch_us(moment) - epoch_us(lag(moment) OVER (PARTITION BY chat, episode ORDER BY seq)) <= 120000000 AND reply_to IS NULL AND forwarded IS NULL AND action IS NULL, false) AS continues,
                 coalesce(nullif(concat_ws(' ', media, nullif({_shorten_sql(f"regexp_replace(text, '^{_SPACE}+|{_SPACE}+$', '', 'g')", 2000)}, '')), ''), '[empty]') AS body
          FROM r),
    l AS (SELECT p.*, concat_ws(' ', CASE WHEN continues THEN '    #' || seq ELSE '[' || strftime(moment, '%Y-%m-%d %H:%M') || '] #' || seq || ' ' || CASE WHEN sender IS NULL THEN 'SYSTEM' ELSE concat_ws(' ', side, sender, nullif(name, ''), CASE WHEN role <> 'client' THEN '(' || role || ')' END) END END,
                 CASE WHEN reply_to IS NOT NULL THEN concat_ws(' ', '↳#' || reply_to, who, CASE WHEN q <> '' THEN '"' || q || '"' END) END, '(forwarded from ' || forwarded || ')') AS lead FROM p),
    lines AS (SELECT chat, episode, seq, moment, CASE WHEN action IS NOT NULL THEN lead || ': [' || action || ']' WHEN code AND (contains(body, chr(10)) OR length(body) > 80) THEN lead || ':' || chr(10) || '```' || chr(10) || body || chr(10) || '```'
              ELSE lead || ': ' || replace(body, chr(10), chr(10) || '    ') END AS line FROM l)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    m = _sequenced(spark, sf_dir).withColumn("reply_to_id", F.when(k % 3 == 1, k - 1))
    rows = messages.relink_replies(m.withColumn("date", F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp")) + k * 60)))
    rows = rows.withColumn("episode", F.floor(k / 20) + 1).withColumn("sender", F.when(k % 7 > 0, F.concat(F.lit("U"), (k % 2 + 10000).cast("string")))).withColumn("role", F.when(k % 2 == 0, "client").otherwise("support")).withColumn("side", messages.side_of(F.col("role")))
    rows = rows.withColumn("name", F.when(k % 2 == 0, "Ann").otherwise("")).withColumn("code", k % 5 == 4).withColumn("action", F.when(k % 6 == 5, "pinned")).withColumn("forwarded", F.when(k % 4 == 3, "U10009")).withColumn("media_label", F.when(k % 3 == 2, "[photo]"))
    rows = messages.turn_continuation(rows, ["chat", "episode"], ["seq"], "date", "sender", F.col("reply_to").isNotNull() | F.col("forwarded").isNotNull() | F.col("action").isNotNull())
    return render.transcript_lines(rows, Output())


@query(f"{_TRANSCRIPT_SQL} SELECT chat, seq, line FROM lines")
def transcript_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("chat", "seq", "line")


@query(f"""{_TRANSCRIPT_SQL},
    t AS (SELECT chat, episode, '## Episode ' || episode || ' - ' || strftime(min(moment), '%Y-%m-%d %H:%M') || ' .. ' || CASE WHEN min(moment)::DATE = max(moment)::DATE THEN strftime(max(moment), '%H:%M') ELSE strftime(max(moment), '%Y-%m-%d %H:%M') END || ' (' || count(*) || ' messages)' AS title,
                 string_agg(line, chr(10) ORDER BY seq) AS block FROM lines GROUP BY chat, episode)
    SELECT chat, 1 AS part, '# ' || chat || chr(10) || chr(10) || string_agg(title || chr(10) || chr(10) || block || chr(10) || chr(10), '' ORDER BY episode) AS text FROM t GROUP BY chat""")
def transcript_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations are short, so each is one part; cuts are tested on longer ones."""
    return render.render_parts(_lines(spark, sf_dir), Output())


@query("""
    SELECT event_id, '[' || kind || ':' || ext || CASE WHEN dur IS NOT NULL THEN ' ' || (dur // 60) || ':' || lpad(CAST(dur % 60 AS VARCHAR), 2, '0') ELSE '' END
           || CASE WHEN size >= 1000000 THEN ' ' || (round(size / 100000.0)::BIGINT // 10) || '.' || (round(size / 100000.0)::BIGINT % 10) || ' MB' WHEN size > 0 THEN ' ' || greatest(1, size // 1000) || ' KB' ELSE '' END || ']' AS label
    FROM (SELECT event_id, event_type AS kind, 'ogg' AS ext, event_id * 397 AS size, CASE WHEN event_id % 3 = 0 THEN event_id % 600 END AS dur FROM events)""")
def media_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select("event_id", messages.media_label(F.col("event_type"), F.lit("ogg"), k * 397, F.when(k % 3 == 0, k % 600), F.lit(None).cast("string")).alias("label"))


@query("SELECT doc_id, doc_id % 4 > 0 AND (doc_id % 4) * (n_chars // 5) * 2 >= n_chars AS code FROM (SELECT doc_id, length(text) AS n_chars FROM documents)")
def code_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.struct(F.lit("Pre").alias("type"), F.lit(0).alias("offset"), F.floor(F.length("text") / 5).cast("int").alias("length"))
    other = F.struct(F.lit("Bold").alias("type"), F.lit(0).alias("offset"), F.length("text").alias("length"))
    entities = F.concat(F.array(other), F.array_repeat(one, (F.col("doc_id") % 4).cast("int")))
    return _read(spark, sf_dir, "documents").select("doc_id", messages.code_flag(F.col("text"), entities).alias("code"))


#: Links of customers that a policy keeps, with a username, an address, an encoded name and a password in them.
_LINK = "'https://shop.example/c/' || k || '/mara_lind?mail=u' || k || '@example.org&q=%D0%97%D0%B8%D0%BC%D0%B8%D0%BD&password=p' || k || '&page=' || (k % 9)"


@query("""SELECT c_custkey AS k, 'see https://shop.example/c/' || c_custkey || '/@U12345?mail=<email>&q=<name>&password=<password>&page=' || (c_custkey % 9) || ' now' AS text, 0 AS left_over FROM customer""")
def scrub_keep_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy, roster = Anonymize(url_mode="keep"), Roster(usernames={"mara_lind": "U12345"}, persons=("Зимин",))
    raw = _read(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS k", "c_custkey AS key").selectExpr("key", f"'see ' || {_LINK.replace('k % 9', 'key % 9')} || ' now' AS text")
    done = spread(raw).select(F.col("key").alias("k"), scrub_column(F.col("text"), policy, roster)["text"].alias("text"))
    return done.select("k", "text", F.size(scan_column(F.col("text"), policy, roster)).alias("left_over"))


#: Twelve words of the wallets' list that a key picks, and a sentence that holds eleven.
_SEED = "zoo ghost river maple stone cloud ocean tiger flame brick crown lemon".split()
_PHRASE = " || ' ' || ".join(f"CASE WHEN (k + {i}) % 2 = 0 THEN '{w}' ELSE '{_SEED[(i * 5 + 1) % 12]}' END" for i, w in enumerate(_SEED))


@query("""SELECT c_custkey AS k, c, CASE c WHEN 'bare' THEN '<seed-phrase>' WHEN 'listed' THEN 'here ' || c_custkey || ' it is: <seed-phrase>' ELSE 'lemon lemon lemon lemon lemon lemon lemon lemon lemon lemon lemon ' || c_custkey END AS text FROM customer, unnest(['bare', 'listed', 'short']) AS t(c)""")
def seed_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases without a label, told by shape, and by membership of the list that a policy gives."""
    rows = _read(spark, sf_dir, "customer").selectExpr("c_custkey AS k").selectExpr("k", f"inline(array(named_struct('c', 'bare', 'raw', {_PHRASE}), named_struct('c', 'listed', 'raw', 'here ' || k || ' it is: ' || {_PHRASE}), named_struct('c', 'short', 'raw', repeat('lemon ', 11) || k)))")
    shaped, listed = (scrub_column(F.col("raw"), p)["text"] for p in (Anonymize(), Anonymize(seed_words=tuple(_SEED))))
    rows = spread(rows)
    return rows.where("c <> 'listed'").select("k", "c", shaped.alias("text")).unionByName(rows.where("c = 'listed'").select("k", "c", listed.alias("text")))


@query("""SELECT DISTINCT id FROM (SELECT user_id * 7 % 5000 AS id FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id % 3000 FROM events)
          WHERE id NOT IN (SELECT c_custkey FROM customer) AND id NOT IN (SELECT s_suppkey + 2000 FROM supplier)""")
def third_party_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that events name, without customers and exported suppliers."""
    e = _read(spark, sf_dir, "events")
    k = F.col("event_id")
    rows = e.select(F.when(k % 3 == 0, F.struct((F.col("user_id") * 7 % 5000).alias("from_id"))).alias("forward"), F.array(F.struct((k % 3000).alias("user_id"))).alias("entities"))
    return identity.third_party_ids(rows, _read(spark, sf_dir, "customer").selectExpr("c_custkey AS id"), _read(spark, sf_dir, "supplier").selectExpr("s_suppkey + 2000 AS id"))


@query("SELECT lower(regexp_extract(p_name, '^[ ]*([A-Za-z][A-Za-z''-]*)', 1)) AS name, count(*) AS n FROM part WHERE regexp_matches(p_name, '^[ ]*[A-Za-z]') GROUP BY 1")
def given_name_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.given_name_counts(_read(spark, sf_dir, "part"), "p_name")


# ---- the rule table --------------------------------------------------------


def _cases(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    """What the scrubber makes of a rule's cases with every customer's values, what the scanner finds in them, and that it finds nothing after."""
    values = dealt(_read(spark, sf_dir, "customer").selectExpr("c_custkey AS k")).selectExpr("k", *rule_cases.COLUMNS)
    rows = values.selectExpr("k", f"inline(array({', '.join(f'named_struct({chr(39)}case_id{chr(39)}, {i}, {chr(39)}text{chr(39)}, {raw})' for i, (raw, _, _) in enumerate(rule_cases.as_sql(rule)))}))")
    done = rows.select("k", "case_id", check_column(F.col("text"), Anonymize(card_bins=rule_cases.BINS)).alias("c"))
    return done.select("k", "case_id", F.col("c.text").alias("text"), F.array_join("c.kinds", ",").alias("kinds"), F.col("c.left_over").alias("left_over"))


def _rule_query(rule: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _cases(spark, sf_dir, rule)

    run.__name__ = f"rule_{rule}"
    rows = ", ".join(f"{{'case_id': {i}, 'text': {want}, 'kinds': {kinds}}}" for i, (_, want, kinds) in enumerate(rule_cases.as_sql(rule)))
    query(f"SELECT k, u.case_id, u.text, u.kinds, 0 AS left_over FROM (SELECT k, unnest([{rows}]) AS u FROM (SELECT c_custkey AS k, {', '.join(rule_cases.COLUMNS)} FROM customer))")(run)


for _name in rule_cases.CASES:
    _rule_query(_name)


# ---- identities ------------------------------------------------------------


@query("SELECT 'U' AS kind, count(*) AS ids, count(*) AS vids, 5 AS width FROM customer")
def identity_stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and widths only: the ids themselves are random."""
    raw = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("raw_id"))
    empty = spark.createDataFrame([], "kind string, raw_id bigint, vid string")
    got = identity.allocate_ids(empty, raw, "U")
    return got.groupBy("kind").agg(F.count("raw_id").alias("ids"), F.countDistinct("vid").alias("vids"), F.max(F.length("vid") - 1).alias("width"))


@query("""
    WITH p AS (SELECT n_regionkey AS primary_id, n_nationkey AS peer_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS ord, CASE WHEN n_nationkey % 3 = 0 THEN 'C' || (10000 + n_nationkey) END AS vid FROM nation)
    SELECT primary_id, peer_id, first_value(vid IGNORE NULLS) OVER (PARTITION BY primary_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS vid FROM p""")
def peers_share_vid(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    p = n.select(F.col("n_regionkey").alias("primary_id"), k.alias("peer_id"), F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("ord"), F.when(k % 3 == 0, F.concat(F.lit("C"), (k + 10000).cast("string"))).alias("vid"))
    return identity.shared_vid(p).select("primary_id", "peer_id", "vid")


@query("""SELECT c_custkey AS id, lower(trim(c_mktsegment)) AS surname FROM customer WHERE regexp_matches(lower(trim(c_mktsegment)), '^[a-z][a-z''-]{2,}$')""")
def surname_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), identity.surname_field(F.col("c_mktsegment")).alias("surname"))
    return n.where("surname is not null")


