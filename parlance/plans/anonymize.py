"""The flagship plan: a raw store becomes a dataset, checked before it is written."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import fold
from ..functions.links import domain_counts
from ..functions.scrub import Scrubber, rule_counts, rule_samples, scrub_column
from ..functions.vocabulary import Roster
from ..operators import audit, identity, messages, render
from .policy import Policy

#: Participants, chats and terms that a roster may hold; it is sent to every worker.
ROSTER_LIMIT = 200_000
FORMAT_VERSION = 2


@dataclass
class Raw:
    """Tables of a raw store; see `sources.schemas`."""

    messages: DataFrame
    users: DataFrame
    chats: DataFrame
    me_id: int | None = None


@dataclass
class Dataset:
    """What may be shared, and the private tables that go with it."""

    messages: DataFrame
    episodes: DataFrame
    users: DataFrame
    chats: DataFrame
    transcripts: DataFrame
    mapping: DataFrame
    dropped: DataFrame
    suspects: DataFrame
    hits: DataFrame
    samples: DataFrame
    domains: DataFrame
    roster: Roster
    policy: Policy

    def manifest(self) -> dict:
        """Counts and dates of the dataset, with the policy's public part."""
        m = self.messages.agg(F.count(F.lit(1)).alias("messages"), F.min("date").alias("first"), F.max("date").alias("last")).first()
        roles = {r["role"]: r["n"] for r in self.users.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()}
        return {
            "format_version": FORMAT_VERSION, "chats": self.chats.count(), "users": sum(roles.values()), "users_by_role": roles, "messages": m["messages"], "episodes": self.episodes.count(),
            "first_date": m["first"] and m["first"].isoformat() + "Z", "last_date": m["last"] and m["last"].isoformat() + "Z", "transcript_parts": self.transcripts.count(), "policy": self.policy.public_snapshot(),
        }

    def report(self) -> dict:
        """Private: hits by rule with samples, the commonest hosts, what was dropped, possible staff. A few rows a rule."""
        by_rule = {r["rule"]: {"hits": r["n"], "samples": []} for r in self.hits.collect()}
        for r in self.samples.orderBy("rule", "rank").collect():
            by_rule[r["rule"]]["samples"].append(r["surface"])
        return {"rules": by_rule, "domains": {r["host"]: r["n"] for r in self.domains.collect()}, "dropped": {r["drop_reason"]: r["n"] for r in self.dropped.collect()}, "suspects": [r["sender_id"] for r in self.suspects.orderBy("sender_id").limit(1000).collect()]}

    def chunks(self) -> DataFrame:
        """Rows (chunk, chat, part, text): transcript parts packed in the order of chats."""
        sized = self.transcripts.withColumn("size", F.length("text"))
        packed = render.pack_chunks(sized, ["chat", "part"], "size", self.policy.output.max_chars or 1 << 60)
        return packed.drop("size").join(self.transcripts, ["chat", "part"])

    def units(self) -> DataFrame:
        """Every free text that would be written, with its location."""
        text = self.messages.select(F.concat_ws(":", F.lit("messages"), "chat", F.col("seq").cast("string")).alias("location"), "text")
        names = self.users.select(F.concat_ws(":", F.lit("users"), "vid").alias("location"), F.col("name").alias("text"))
        titles = self.chats.select(F.concat_ws(":", F.lit("chats"), "vid").alias("location"), F.col("title").alias("text"))
        return text.unionByName(names).unionByName(titles)


def _bounded(df: DataFrame, what: str) -> list:
    rows = df.limit(ROSTER_LIMIT + 1).collect()
    if len(rows) > ROSTER_LIMIT:
        raise ValueError(f"more than {ROSTER_LIMIT} {what}: split the store by chats")
    return rows


def build_roster(raw: Raw, mapping: DataFrame, policy: Policy, exported: DataFrame) -> Roster:
    """What the scrubber hunts for: usernames with their ids, raw ids, phones, surnames, organisations."""
    a = policy.anonymize
    vid = mapping.where("kind = 'U'").select(F.col("raw_id").alias("id"), "vid")
    people = _bounded(raw.users.join(vid, "id", "left").select("id", "vid", "first_name", "last_name", "username", "usernames", "phone"), "users")
    usernames: dict[str, str] = {}
    persons: set[str] = set()
    for u in people:
        for name in {u["username"], *(u["usernames"] or [])} - {None, ""}:
            usernames[name.lower()] = u["vid"] or "user"
        given, typed = identity.split_free_text_name(u["first_name"] or "")
        last = (u["last_name"] or "").strip()
        if last and not identity.is_label(last):
            persons.add(last)
        if typed:
            persons.add(typed)
        if given and (last or typed):
            persons.add(f"{given} {last or typed}")
    persons |= {r["name"] for r in _bounded(identity.contact_names(raw.chats, exported), "contacts")}
    chat_vid = mapping.where("kind = 'C'").select(F.col("raw_id").alias("id"), "vid")
    for c in _bounded(exported.join(chat_vid, "id").where("username <> ''").select("username", "vid"), "chats"):
        usernames.setdefault(c["username"].lower(), c["vid"])
    titles = identity.title_terms(exported).select("term") if a.scrub_chat_titles else None
    organisations = {r["term"] for r in _bounded(titles, "title words")} if titles is not None else set()
    known = {fold(p) for p in persons}
    third = [r["id"] for r in _bounded(identity.third_party_ids(raw.messages, raw.users, exported), "third parties")]
    return Roster(
        usernames=usernames, ids=frozenset([u["id"] for u in people] + [r["id"] for r in _bounded(exported.select("id"), "chats")] + third), phones=frozenset("".join(c for c in u["phone"] or "" if c.isdigit()) for u in people) - {""},
        persons=tuple(sorted(persons)) if a.scrub_last_names else (), organisations=tuple(sorted({o for o in organisations if o not in known} | set(a.custom_terms))), keep=a.keep_terms,
    )


def anonymize(raw: Raw, policy: Policy, mapping: DataFrame, persist: Callable[[DataFrame, str], DataFrame]) -> Dataset:
    """Build the dataset of a raw store.

    `mapping` (kind, raw_id, vid) holds the ids of earlier runs; `persist`
    writes a table under a name and returns it read back, and is used for
    everything that must not change when it is read twice: the grown mapping
    above all, whose new ids are drawn by lot.
    """
    a, o = policy.anonymize, policy.output
    exported = raw.chats.join(raw.messages.select(F.col("chat_id").alias("id")).distinct(), "id", "left_semi")
    logical = messages.logical_chat(exported.select("id", "migrated_to"))
    staff = [(e, r) for r in ("support", "sales", "other") for e in getattr(policy.staff, r)]
    staff_rows = raw.users.sparkSession.createDataFrame(staff, "entry string, role string")

    placed = raw.messages.join(logical.select(F.col("id").alias("chat_id"), "primary_id"), "chat_id")
    placed = placed.join(exported.select(F.col("id").alias("primary_id"), "is_forum"), "primary_id", "left")
    stubs = placed.where("sender_kind = 'user' and sender_id is not null").select(F.col("sender_id").alias("id")).distinct().join(raw.users, "id", "left_anti")
    known = raw.users.unionByName(stubs.withColumn("is_bot", F.lit(False)).withColumn("is_deleted", F.lit(True)), allowMissingColumns=True)
    people = messages.roles(known, staff_rows, raw.me_id).select("id", "first_name", "last_name", "role", "side")

    bots = people.select(F.col("id").alias("sender_id"), "role", "side", "first_name", "last_name")
    joined = placed.join(bots, "sender_id", "left")
    role = F.coalesce("role", F.when(F.col("sender_kind").isin("chat", "channel", "anonymous"), "anonymous").otherwise("system"))
    joined = joined.withColumn("role", role).withColumn("side", messages.side_of(F.col("role")))
    reason = messages.drop_reason(F.col("action").isNotNull(), F.col("text"), F.col("media").isNotNull(), F.col("role") == "bot", a.keep_service_messages, a.keep_bot_messages)
    judged = persist(joined.withColumn("drop_reason", reason), "judged")
    dropped = judged.where("drop_reason is not null").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))

    kept = messages.sequence_skewed(judged.where("drop_reason is null").withColumnRenamed("primary_id", "logical"), persist, "logical", F.coalesce("is_forum", F.lit(False)))
    kept = messages.relink_replies(kept)
    kept = messages.episodes(kept.withColumn("topic", F.when(F.col("is_forum"), F.col("topic_id"))), ["logical"], ["seq"], "date", "topic", o.episode_gap_hours)

    appear = kept.where("sender_id is not null and sender_kind = 'user'").select(F.col("sender_id").alias("raw_id"))
    forwarded = kept.where("forward.kind = 'user'").select(F.col("forward.from_id").alias("raw_id")).join(raw.users.select(F.col("id").alias("raw_id")), "raw_id", "left_semi")
    listed = exported.select(F.explode("participant_ids").alias("raw_id")).join(raw.users.select(F.col("id").alias("raw_id")), "raw_id", "left_semi")
    # peers of one conversation share an id: the one that any of them already has, else a new one
    chat_ids = mapping.where("kind = 'C'")
    lent = identity.shared_vid(logical.join(chat_ids.select(F.col("raw_id").alias("id"), "vid"), "id", "left").select("primary_id", F.col("id").alias("peer_id"), "ord", "vid"))
    first_peer = lent.where("vid is not null").select(F.lit("C").alias("kind"), F.col("primary_id").alias("raw_id"), "vid").distinct().join(chat_ids.select("raw_id"), "raw_id", "left_anti")
    moved = chat_ids.join(lent.where("vid is not null and peer_id <> primary_id").select(F.col("peer_id").alias("raw_id")), "raw_id", "left_anti")
    grown = identity.check_mapping(mapping.where("kind <> 'C'").unionByName(moved.select("kind", "raw_id", "vid")).unionByName(first_peer.select("kind", "raw_id", "vid")))
    grown = identity.allocate_ids(grown, appear.union(forwarded).union(listed), "U")
    grown = persist(grown, "mapping_users")
    grown = persist(identity.allocate_ids(grown, logical.select(F.col("primary_id").alias("raw_id")), "C"), "mapping")

    roster = build_roster(raw, grown, policy, exported)
    user_vid = grown.where("kind = 'U'").select(F.col("raw_id").alias("sender_id"), F.col("vid").alias("sender"))
    chat_vid = grown.where("kind = 'C'").select(F.col("raw_id").alias("logical"), F.col("vid").alias("chat"))
    from_user = grown.where("kind = 'U'").select(F.col("raw_id").alias("from_id"), F.col("vid").alias("from_user"))
    from_chat = grown.where("kind = 'C'").join(logical.withColumnRenamed("primary_id", "raw_id"), "raw_id").select(F.col("id").alias("from_id"), F.col("vid").alias("from_chat"))
    full = kept.join(user_vid, "sender_id", "left").join(chat_vid, "logical").withColumn("from_id", F.col("forward.from_id")).join(from_user, "from_id", "left").join(from_chat, "from_id", "left")
    clean = full.withColumn("s", scrub_column(F.col("text"), a, roster, F.col("entities")))
    forwarded_label = messages.forwarded_label(F.col("forward.kind"), F.col("from_user"), F.col("from_chat"), F.col("forward.kind") == "channel")
    file_name: Column = F.when(F.lit(a.keep_file_names), scrub_column(F.col("media.file_name"), a, roster)["text"]) if a.keep_file_names else F.lit(None).cast("string")
    label = F.when(F.col("media").isNotNull(), messages.media_label(F.col("media.kind"), F.col("media.ext"), F.col("media.size"), F.col("media.duration"), file_name))
    out = persist(
        clean.select(
            "chat", "episode", "seq", "date", "sender", "role", "side", F.coalesce("s.text", F.lit("")).alias("text"), "reply_to", "topic", label.alias("media_label"), forwarded_label.alias("forwarded"),
            "action", F.col("edit_date").isNotNull().alias("edited"), messages.code_flag(F.coalesce("text", F.lit("")), F.coalesce("entities", F.array().cast("array<struct<type:string,offset:int,length:int,url:string,user_id:bigint>>"))).alias("code"), F.col("s.hits").alias("hits"),
        ),
        "messages",
    )

    scrubber_policy, surnames = a, frozenset(fold(p) for p in roster.persons)
    handles = frozenset(roster.usernames)

    @F.pandas_udf("string")
    def shown(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = Scrubber(scrubber_policy, Roster(usernames=roster.usernames))
        for first, last, deleted in parts:
            yield pd.Series(["Deleted" if gone else identity.display_name(f, x, scrubber_policy.name_mode, handles, surnames, own) for f, x, gone in zip(first, last, deleted, strict=True)])

    users = people.join(grown.where("kind = 'U'").select(F.col("raw_id").alias("id"), "vid"), "id").select("vid", shown("first_name", "last_name", F.col("role") == "deleted").alias("name"), "role", "side")
    heads = exported.join(logical.groupBy(F.col("primary_id").alias("id")).agg(F.count(F.lit(1)).alias("peers")), "id").select(F.col("id").alias("logical"), "title", "kind", "is_forum", "participant_count")
    chats = heads.join(chat_vid, "logical").join(messages.chat_stats(out), "chat").join(messages.by_side(out), "chat")
    chats = chats.select(F.col("chat").alias("vid"), (F.col("title") if a.keep_chat_titles else F.col("chat")).alias("title"), "kind", "is_forum", "participant_count", "message_count", "by_side", "episodes", "first_date", "last_date")
    lines = messages.turn_continuation(out.join(users.select(F.col("vid").alias("sender"), "name"), "sender", "left"), ["chat", "episode"], ["seq"], "date", "sender", F.col("reply_to").isNotNull() | F.col("forwarded").isNotNull() | F.col("action").isNotNull(), o.turn_merge_seconds)
    members = exported.join(logical.select("id", F.col("primary_id").alias("logical")), "id").select("logical", F.explode("participant_ids").alias("sender_id")).join(user_vid, "sender_id").join(chat_vid, "logical")
    people_of = members.select("chat", F.col("sender").alias("vid")).union(out.where("sender is not null").select("chat", F.col("sender").alias("vid"))).distinct().join(users, "vid")
    headers = render.chat_headers(chats, people_of, o)
    transcripts = persist(render.render_parts(render.transcript_lines(lines, o), o, headers), "transcripts")
    clients = judged.where("role not in ('bot', 'support', 'sales', 'other', 'anonymous', 'system')")
    return Dataset(
        messages=out.drop("hits"), episodes=messages.episode_rollup(out), users=users, chats=chats, transcripts=transcripts, mapping=grown, dropped=dropped,
        suspects=messages.suspect_staff(clients, "sender_id", "primary_id"), hits=rule_counts(out), samples=rule_samples(out), domains=domain_counts(judged.where("drop_reason is null")), roster=roster, policy=policy,
    )


def checked(dataset: Dataset) -> Dataset:
    """The dataset if nothing in its texts leaks; else an error that names kinds and places."""
    audit.self_check(dataset.units(), dataset.policy.anonymize, dataset.roster)
    return dataset
