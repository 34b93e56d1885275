"""Which chats a run takes: ordered reasons, internal chats, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.policy import ChatFilter


def static_reason(policy: ChatFilter) -> Column:
    """First failing reason of a chat (id, kind, title, is_accessible, is_archived), else `included`."""
    ids = lambda x: F.col("id").isin(sorted(x)) if x else F.lit(False)
    title = F.lit(False)
    for pattern in policy.exclude_title_regex:
        title |= F.coalesce(F.col("title"), F.lit("")).rlike(f"(?iu){pattern}")
    return (
        F.when(ids(policy.exclude_ids), "exclude_ids")
        .when(ids(policy.include_ids), "include_ids")
        .when(~F.col("kind").isin(sorted(policy.include_types)), "type")
        .when(~F.col("is_accessible"), "access")
        .when(F.col("is_archived") & F.lit(not policy.include_archived), "archived")
        .when(title, "title")
        .otherwise("included")
    )


def internal_chats(members: DataFrame) -> DataFrame:
    """Chats of `members` (chat_id, is_bot, is_staff, complete) whose complete list has a person and staff only."""
    people = ~F.col("is_bot")
    return members.groupBy("chat_id").agg(F.bool_and("complete").alias("complete"), F.count(F.when(people, 1)).alias("people"), F.bool_and(F.when(people, F.col("is_staff"))).alias("staff_only")).where("complete and people > 0 and staff_only").select("chat_id")


def plan(chats: DataFrame, policy: ChatFilter, internal: DataFrame | None = None) -> DataFrame:
    """Chats with reason, included and merged_into.

    A legacy group follows the chat it migrated to, if that is included and
    accessible; an explicit exclusion wins. Internal chats are left out with
    the groups merged into them.
    """
    own = chats.withColumn("reason", static_reason(policy))
    if internal is not None and policy.exclude_internal:
        flag = internal.select(F.col("chat_id").alias("id"), F.lit(True).alias("internal"))
        own = own.join(flag, "id", "left").withColumn("reason", F.when(F.col("internal") & (F.col("reason") == "included"), "internal").otherwise(F.col("reason"))).drop("internal")
    own = own.withColumn("included", F.col("reason").isin("included", "include_ids"))
    target = own.select(F.col("id").alias("migrated_to"), F.col("included").alias("t_included"), F.col("is_accessible").alias("t_accessible"), F.col("reason").alias("t_reason"))
    out = own.join(target, "migrated_to", "left")
    follows = F.coalesce(F.col("t_included") & F.col("t_accessible"), F.lit(False)) & (F.col("reason") != "exclude_ids")
    cascade = (F.col("t_reason") == "internal") & F.col("included")
    out = out.withColumn("merged_into", F.when(follows, F.col("migrated_to")))
    out = out.withColumn("reason", F.when(follows, "merged").when(cascade, "internal").otherwise(F.col("reason"))).withColumn("included", F.when(follows, True).when(cascade, False).otherwise(F.col("included")))
    return out.drop("t_included", "t_accessible", "t_reason")


def select_only(planned: DataFrame, wanted: list[int]) -> tuple[DataFrame, list[int]]:
    """Included chats of `wanted` with those merged into them, and the ids that the plan lacks."""
    spark = planned.sparkSession
    ids = spark.createDataFrame([(int(x),) for x in wanted], "w long")
    got = planned.where("included").join(ids, (F.col("id") == F.col("w")) | F.col("merged_into").eqNullSafe(F.col("w")), "left_semi")
    missing = ids.join(planned.where("included"), F.col("id") == F.col("w"), "left_anti")
    return got, [r[0] for r in missing.collect()]


def ordered(planned: DataFrame) -> DataFrame:
    """Included chats first, then by kind and title."""
    return planned.orderBy((~F.col("included")).cast("int"), "kind", F.lower("title"), "id")


def chat_kind(is_user: Column, is_bot: Column, is_broadcast: Column, is_mega: Column) -> Column:
    """Kind of a dialog from its flags."""
    return F.when(is_user & is_bot, "bot").when(is_user, "private").when(is_mega, "supergroup").when(is_broadcast, "channel").otherwise("group")
