"""Records of a chat service's export as raw records: pure projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Topic of messages outside any topic of a forum.
GENERAL_TOPIC = 1


def sender(from_id: Column, peer_kind: Column, chat_id: Column, is_private: Column, is_out: Column, me_id: Column) -> Column:
    """Struct (sender_id, sender_kind); a private chat that names no sender is the other side's, or ours if it went out."""
    kind = F.when(peer_kind == "channel", "channel").when(peer_kind == "chat", "chat").when(from_id.isNotNull(), "user").when(is_private, "user").otherwise("anonymous")
    who = F.coalesce(from_id, F.when(is_private, F.when(is_out, me_id).otherwise(chat_id)))
    return F.struct(who.alias("sender_id"), kind.alias("sender_kind"))


def reply(reply_to_msg_id: Column, reply_to_top_id: Column, forum_topic: Column, is_forum: Column) -> Column:
    """Struct (reply_to_id, topic_id): a header that only names the topic is no reply."""
    topic = F.when(~is_forum, F.lit(None).cast("bigint")).when(forum_topic, F.coalesce(reply_to_top_id, reply_to_msg_id)).otherwise(F.lit(GENERAL_TOPIC).cast("bigint"))
    target = F.when(forum_topic & reply_to_top_id.isNull(), F.lit(None).cast("bigint")).otherwise(reply_to_msg_id)
    return F.struct(target.alias("reply_to_id"), topic.alias("topic_id"))


def media_kind(media: Column, attributes: Column, mime: Column) -> Column:
    """Kind of an attachment from its class and the names of its attributes."""
    has = lambda name: F.exists(attributes, lambda a: a == name)
    document = F.when(has("sticker"), "sticker").when(has("voice"), "voice").when(has("round"), "video_note").when(has("animated"), "gif").when(has("video") | mime.startswith("video/"), "video").when(has("audio") | mime.startswith("audio/"), "audio").otherwise("document")
    return F.when(media == "photo", "photo").when(media == "document", document).when(media.isin("geo", "venue"), "location").when(media.isin("contact", "poll", "dice", "webpage"), media).otherwise(media)


def file_extension(name: Column, mime: Column) -> Column:
    """Lower-case extension of a file name, else what the MIME type suggests, else null."""
    own = F.nullif(F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]{1,8})$", 1)), F.lit(""))
    known = F.create_map(*(F.lit(x) for pair in MIME_EXTENSIONS.items() for x in pair))
    return F.coalesce(own, known[mime])


#: Extensions of common MIME types.
MIME_EXTENSIONS = {
    "image/jpeg": "jpg", "image/png": "png", "image/gif": "gif", "image/webp": "webp", "video/mp4": "mp4", "audio/ogg": "ogg", "audio/mpeg": "mp3", "application/pdf": "pdf", "application/zip": "zip",
    "text/plain": "txt", "text/csv": "csv", "application/json": "json",
}


def users(rows: DataFrame) -> DataFrame:
    """Raw users of exported ones (id, first_name, last_name, username, usernames, phone, bot, deleted)."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    names = F.filter(F.array_distinct(F.concat(F.array("username"), F.coalesce("usernames", F.array().cast("array<string>")))), lambda x: F.coalesce(x, F.lit("")) != "")
    return rows.select("id", text("first_name"), text("last_name"), text("username"), text("phone"), F.coalesce("bot", F.lit(False)).alias("is_bot"), F.coalesce("deleted", F.lit(False)).alias("is_deleted"), names.alias("usernames"))


def all_usernames(username: Column, usernames: Column) -> Column:
    """A user's names, the primary one first, without regard to case."""
    both = F.filter(F.concat(F.array(username), F.coalesce(usernames, F.array().cast("array<string>"))), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.filter(both, lambda x, i: ~F.exists(F.slice(both, 1, i), lambda y: F.lower(y) == F.lower(x)))


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat_ws(" ", F.nullif(F.trim(first), F.lit("")), F.nullif(F.trim(last), F.lit(""))))
