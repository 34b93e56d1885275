"""Transcripts: lines, quotes, parts and chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.policy import Output

#: Least size of a part; smaller budgets are raised to it.
LEAST_PART = 10_000
#: White space and line breaks of Unicode, as classes that Java and RE2 read alike.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
SOLID = SPACE.replace("[", "[^", 1)
#: Characters of a quote, and what is left of a longer one before the dots.
QUOTE_MOST, QUOTE_CUT = 60, 57
#: Length from which code of one line is fenced.
FENCED = 80


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it occurs."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def _head(text: Column, n: int) -> Column:
    """The first `n` characters without a word that goes on behind them, unless that is all there is; white space at the end cut off."""
    whole = lambda part: F.when(F.substring(text, n + 1, 1).rlike(f"^{SPACE}$") | ~part.rlike(SPACE) | (F.length(text) <= n), part).otherwise(F.regexp_replace(part, f"{SOLID}*$", ""))
    return F.regexp_replace(_let(F.substring(text, 1, n), whole), f"{SPACE}+$", "")


def _tail(text: Column, n: int) -> Column:
    """The mirror image of `_head`."""
    before = F.substring(text, F.length(text) - n, F.lit(1))
    whole = lambda part: F.when(before.rlike(f"^{SPACE}$") | ~part.rlike(SPACE) | (F.length(text) <= n), part).otherwise(F.regexp_replace(part, f"^{SOLID}*", ""))
    return F.regexp_replace(_let(F.right(text, F.lit(n)), whole), f"^{SPACE}+", "")


def shorten(text: Column, limit: int) -> Column:
    """Texts above `limit`: three quarters from the head and one from the tail, cut at words, with the number left out on a line of its own between."""
    if limit <= 0:
        return text

    def cut(whole: Column) -> Column:
        ends = F.struct(_head(whole, limit * 3 // 4).alias("head"), _tail(whole, limit // 4).alias("tail"))
        joined = lambda e: F.concat(e["head"], F.lit("\n[... "), (F.length(whole) - F.length(e["head"]) - F.length(e["tail"])).cast("string"), F.lit(" chars omitted ...]\n"), e["tail"])
        return F.when(F.length(whole) > limit, _let(ends, joined)).otherwise(whole)

    return _let(text, cut)


def quote(text: Column) -> Column:
    """One line of a message: white space collapsed, lines joined by a sign; a longer one ends at a word, with dots."""
    lines = F.filter(F.transform(F.split(text, BREAK), lambda x: F.trim(F.regexp_replace(x, f"{SPACE}+", " "))), lambda x: x != "")
    return _let(F.array_join(lines, " ⏎ "), lambda joined: F.when(F.length(joined) > QUOTE_MOST, F.concat(_head(joined, QUOTE_CUT), F.lit("..."))).otherwise(joined))


def speaker(sender: Column, side: Column, role: Column, name: Column) -> Column:
    """Side, id, name and role of who writes; clients go without a role, messages without a sender are the system's."""
    role = F.when(role == "anonymous", "anonymous admin").when(role != "client", role)
    named = F.when(role.isNull() | (role != "anonymous admin"), F.nullif(name, F.lit("")))
    return F.when(sender.isNull(), "SYSTEM").otherwise(F.concat_ws(" ", side, sender, named, F.concat(F.lit("("), role, F.lit(")"))))


def transcript_lines(messages: DataFrame, output: Output) -> DataFrame:
    """`line` of every message: time, number and speaker at the start of a turn, the number alone in it, then what it replies to, where it comes from, and its body.

    Needs chat, episode, seq, date, sender, side, role, name, text, reply_to,
    media_label, forwarded, action, code and continues.
    """
    local = F.from_utc_timestamp(F.col("date").cast("timestamp"), output.timezone)
    target = messages.where("seq is not null").select(F.col("chat").alias("q_chat"), F.col("seq").alias("q_seq"), F.coalesce("sender", F.lit("SYSTEM")).alias("q_who"), quote(F.coalesce("text", F.lit(""))).alias("q_text"))
    joined = messages.join(target, (F.col("chat") == F.col("q_chat")) & (F.col("reply_to") == F.col("q_seq")), "left")
    number = F.concat(F.lit("#"), F.col("seq").cast("string"))
    opening = F.concat(F.lit("["), F.date_format(local, "yyyy-MM-dd HH:mm"), F.lit("] "), number, F.lit(" "), speaker(F.col("sender"), F.col("side"), F.col("role"), F.col("name")))
    head = F.when(F.col("continues"), F.concat(F.lit("    "), number)).otherwise(opening)
    snippet = F.when(F.col("q_text") != "", F.concat(F.lit('"'), F.col("q_text"), F.lit('"')))
    reply = F.when(F.col("reply_to").isNotNull(), F.concat_ws(" ", F.concat(F.lit("↳#"), F.col("reply_to").cast("string")), "q_who", snippet))
    origin = F.when(F.col("forwarded").isNotNull(), F.concat(F.lit("(forwarded from "), F.col("forwarded"), F.lit(")")))
    lead = F.concat_ws(" ", head, reply, origin)
    text = F.nullif(shorten(_strip(F.coalesce("text", F.lit(""))), output.max_message_chars), F.lit(""))
    body = F.coalesce(F.nullif(F.concat_ws(" ", "media_label", text), F.lit("")), F.lit("[empty]"))
    shown = lambda x: F.when(F.col("code") & (x.contains("\n") | (F.length(x) > FENCED)), F.concat(F.lit(":\n```\n"), x, F.lit("\n```"))).otherwise(F.concat(F.lit(": "), F.regexp_replace(x, "\n", "\n    ")))
    line = F.concat(lead, F.when(F.col("action").isNotNull(), F.concat(F.lit(": ["), F.col("action"), F.lit("]"))).otherwise(_let(body, shown)))
    return joined.withColumn("line", line).drop("q_chat", "q_seq", "q_who", "q_text")


def episode_titles(lines: DataFrame, output: Output) -> DataFrame:
    """Rows (chat, episode, title): number, span, messages and, in a forum, topic of every episode."""
    own = lines.withColumn("local", F.from_utc_timestamp(F.col("date").cast("timestamp"), output.timezone))
    per = own.groupBy("chat", "episode").agg(F.min_by("local", "seq").alias("a"), F.max_by("local", "seq").alias("b"), F.count(F.lit(1)).alias("n"), *([F.min_by("topic", "seq").alias("topic")] if "topic" in lines.columns else []))
    until = F.when(F.to_date("a") == F.to_date("b"), F.date_format("b", "HH:mm")).otherwise(F.date_format("b", "yyyy-MM-dd HH:mm"))
    topic = F.concat(F.lit(", topic "), F.col("topic").cast("string")) if "topic" in per.columns else F.lit(None).cast("string")
    title = F.concat(F.lit("## Episode "), F.col("episode").cast("string"), F.lit(" - "), F.date_format("a", "yyyy-MM-dd HH:mm"), F.lit(" .. "), until, F.lit(" ("), F.col("n").cast("string"), F.lit(" messages"), F.coalesce(topic, F.lit("")), F.lit(")"))
    return per.select("chat", "episode", title.alias("title"))


#: Fixed value: how a header explains the lines under it.
LINE_FORMAT = 'Line format: `[time] #seq SIDE U##### Name (role) ↳#N U##### "quote": text`.'


def chat_headers(chats: DataFrame, people: DataFrame, output: Output) -> DataFrame:
    """Rows (chat, header) of `chats` (vid, title, is_forum, message_count, by_side, episodes, first_date, last_date) and their `people` (chat, vid, side, name, role); the first line is the writer's."""
    day = lambda c: F.date_format(F.from_utc_timestamp(F.col(c).cast("timestamp"), output.timezone), "yyyy-MM-dd")
    label = F.concat_ws(" ", "vid", "side", F.nullif("name", F.lit("")), F.concat(F.lit("("), F.col("role"), F.lit(")")))
    listed = people.select(F.col("chat").alias("vid"), F.struct("vid", label.alias("label")).alias("p")).groupBy("vid").agg(F.array_join(F.transform(F.sort_array(F.collect_set("p")), lambda x: x["label"]), ", ").alias("listed"))
    sides = F.array_join(F.transform(F.sort_array(F.map_entries("by_side")), lambda x: F.concat(x["key"], F.lit(": "), x["value"].cast("string"))), ", ")
    period = F.concat(F.lit("Period: "), day("first_date"), F.lit(" .. "), day("last_date"), F.lit(", "), F.col("message_count").cast("string"), F.lit(" messages ("), sides, F.lit("), "), F.col("episodes").cast("string"), F.lit(f" episodes, times in {output.timezone}"))
    lines = [
        F.when(F.coalesce("title", F.lit("")).isin("") | (F.col("title") == F.col("vid")), None).otherwise(F.concat(F.lit("Title: "), F.col("title"))),
        F.when(F.col("is_forum"), "Forum chat: episodes never cross topics; topic ids are shown in episode headers."),
        F.concat(F.lit("Participants: "), F.coalesce("listed", F.lit("unknown"))), period, F.lit(LINE_FORMAT),
    ]
    return chats.join(listed, "vid", "left").select(F.col("vid").alias("chat"), F.concat_ws("\n", *lines).alias("header"))


def part_numbers(rows: DataFrame, budget: int) -> DataFrame:
    """`part` of rows (chat, episode, seq, size, block): whole episodes while they fit, one larger than the budget by its messages.

    The fold streams through the sizes of a chat in order and holds two numbers; no text passes through it.
    """
    schema = rows.schema.simpleString()[len("struct<") : -1] + ", part int"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chat, episode, part, used = None, None, 0, 0
        for pdf in batches:
            out = []
            for own, number, size, block in zip(pdf["chat"], pdf["episode"], pdf["size"], pdf["block"], strict=True):
                if own != chat:
                    chat, episode, part, used = own, None, 1, 0
                whole = block <= budget
                n = block if whole and number != episode else 0 if whole else size
                if used and used + n > budget:
                    part, used = part + 1, 0
                used += n
                episode = number
                out.append(part)
            yield pdf.assign(part=pd.Series(out, index=pdf.index, dtype="int32"))

    return rows.repartition("chat").sortWithinPartitions("chat", "episode", "seq").mapInPandas(fold, schema)


def render_parts(lines: DataFrame, output: Output, headers: DataFrame | None = None) -> DataFrame:
    """Rows (chat, part, text): the transcript of each chat under its header, cut for `output.max_chars` (0: whole)."""
    budget = max(output.max_chars, LEAST_PART) if output.max_chars else 1 << 62
    bounds = Window.partitionBy("chat", "episode").orderBy("seq")
    first, last = F.lag("seq").over(bounds).isNull(), F.lead("seq").over(bounds).isNull()
    rows = lines.join(episode_titles(lines, output), ["chat", "episode"]).select("chat", "episode", "seq", F.concat(F.when(first, F.concat("title", F.lit("\n\n"))).otherwise(""), "line", F.when(last, "\n\n").otherwise("\n")).alias("piece"))
    sized = rows.select("chat", "episode", "seq", F.length("piece").alias("size"))
    sized = sized.withColumn("block", F.sum("size").over(Window.partitionBy("chat", "episode")))
    placed = part_numbers(sized, budget).select("chat", "seq", "part")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "piece"))), lambda x: x["piece"]), "")
    parts = rows.join(placed, ["chat", "seq"]).groupBy("chat", "part").agg(text.alias("body"))
    of = placed.groupBy("chat").agg(F.max("part").alias("parts"))
    parts = parts.join(of, "chat")
    parts = parts.join(headers, "chat", "left") if headers is not None else parts.withColumn("header", F.lit(None).cast("string"))
    top = F.concat(F.lit("# "), F.col("chat").cast("string"), F.when(F.col("parts") > 1, F.concat(F.lit(" (part "), F.col("part").cast("string"), F.lit(" of "), F.col("parts").cast("string"), F.lit(")"))).otherwise(""))
    return parts.select("chat", "part", F.concat(F.concat_ws("\n", top, "header"), F.lit("\n\n"), "body").alias("text"))


def part_name(chat: Column, part: Column, parts: Column) -> Column:
    return F.when(parts > 1, F.format_string("%s.part%02d.md", chat.cast("string"), part)).otherwise(F.format_string("%s.md", chat.cast("string")))


def chunk_name(chunk: Column) -> Column:
    return F.format_string("chunk-%03d.md", chunk)


def is_own_file_name(name: Column) -> Column:
    """Whether a file name is one that the writer gives."""
    return name.rlike(r"^(?:C[0-9]{5,9}(?:\.part[0-9]{2,})?\.md|chunk-[0-9]{3,}\.md|(?:messages|episodes)\.jsonl|(?:users|chats|manifest|index)\.json|README\.md)$")


def pack_chunks(parts: DataFrame, order: list[str], size: str, max_chars: int, shards: list[str] | None = None) -> DataFrame:
    """`chunk` from 1: greedy, a part opens a new chunk when the open one would exceed the budget.

    The fold needs the sizes in order, one number a part; it keeps the running
    size only, streams through its rows and never holds their text. With
    `shards` every group is packed on its own.
    """
    budget = max(max_chars, LEAST_PART)
    cols = [*order, size, *(shards or [])]
    kept = parts.select(*dict.fromkeys(cols))
    schema = kept.schema.simpleString()[len("struct<") : -1] + ", chunk int"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, chunk, used = None, 0, 0
        for pdf in batches:
            out = []
            groups = zip(*(pdf[s] for s in shards), strict=True) if shards else ((),) * len(pdf)
            for own, n in zip(groups, pdf[size], strict=True):
                if own != key or chunk == 0:
                    key, chunk, used = own, 1, 0
                elif used + n > budget and used:
                    chunk, used = chunk + 1, 0
                used += int(n)
                out.append(chunk)
            yield pdf.assign(chunk=out)

    placed = kept.repartition(*shards).sortWithinPartitions(*shards, *order) if shards else kept.coalesce(1).sortWithinPartitions(*order)
    return placed.mapInPandas(fold, schema)


def split_transcript_line(line: Column) -> Column:
    """Head, quote, forward and body of a rendered line; a line of another shape is all body."""
    head = r"^((?:\[[0-9: -]{16}\] #[0-9]+ [A-Z]+(?: [^\s\":↳]+)*?|    #[0-9]+)(?: ↳#[0-9]+(?: [A-Z0-9]+)?)?)(?=:| \"| \(forwarded from )"
    quoted, forward = r'^ "([^\n]*)"(?= \(forwarded from |:)', r"^ (\(forwarded from [^ )\n]+\))(?=:)"

    def after_quote(head: Column, found: Column, rest: Column) -> Column:
        rest = F.when(found != "", F.substr(rest, F.length(found) + 4)).otherwise(rest)
        return _let(F.struct(rest.alias("rest"), F.regexp_extract(rest, forward, 1).alias("forward")), lambda x: F.struct(
            head.alias("head"), found.alias("quote"), x["forward"].alias("forward"), F.regexp_replace(F.when(x["forward"] != "", F.substr(x["rest"], F.length(x["forward"]) + 2)).otherwise(x["rest"]), "^: ?", "").alias("body")))

    def after_head(h: Column) -> Column:
        rest = F.substr(line, F.length(h) + 1)
        plain = F.struct(h.alias("head"), F.lit("").alias("quote"), F.lit("").alias("forward"), line.alias("body"))
        return F.when(h == "", plain).otherwise(_let(F.regexp_extract(rest, quoted, 1), lambda q: after_quote(h, q, rest)))

    return _let(F.regexp_extract(line, head, 1), after_head)
