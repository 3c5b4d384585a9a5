"""Prompt-response pairs.

Every non-user message is paired with the user message that elicited it: the
nearest user among its live ancestors, or else the user message before it in
time. Ancestors are found by pointer doubling in which users absorb, so a walk
of any depth takes log2(depth) joins, cycles never reach a user and fall back.

Defined results: deleted messages take no part and break ancestor walks; NULL
times sort first, then ordinal and id; a response without any prompt gives no
pair; ids are deterministic, so rebuilding keeps annotations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import row_key, word_count
from ..functions.windows import split_rank
from ..session import materialize

def live_messages(messages: DataFrame) -> DataFrame:
    return messages.where("deleted_at is null")


def with_prompt_before(messages: DataFrame) -> DataFrame:
    """Live messages with their zero-based position in the dialogue and the
    last user message before them (prompt_before).

    Ordered by time, NULL first, then id. A dialogue of any size is spread
    over tasks.
    """
    order = [F.col("created_at").isNotNull(), F.col("created_at"), F.col("id")]
    return split_rank(live_messages(messages), "dialogue_id", order, "position", (F.when(F.col("role") == "user", F.col("id")), "prompt_before"))


def ancestor_prompt(messages: DataFrame) -> DataFrame:
    """(id, prompt_above): the nearest user ancestor over live parents."""
    live = live_messages(messages).select("id", "parent_id", "role")
    users = live.where("role = 'user'").select(F.col("id").alias("parent_id"), F.lit(True).alias("is_user"))
    known = live.select(F.col("id").alias("parent_id"), F.lit(True).alias("is_live"))
    start = live.join(users, "parent_id", "left").join(known, "parent_id", "left").where("role <> 'user' and is_live")
    # found: the user reached; jump: where the walk stands
    state = materialize(start.select("id", F.when(F.col("is_user"), F.col("parent_id")).alias("found"), F.when(F.col("is_user").isNull(), F.col("parent_id")).alias("jump")), "walk")
    before = -1
    while True:
        still = state.where("jump is not null").count()
        if still in (0, before):
            return state.where("found is not null").select("id", F.col("found").alias("prompt_above"))
        before = still
        above = state.select(F.col("id").alias("jump"), F.col("found").alias("a_found"), F.col("jump").alias("a_jump"))
        state = materialize(state.join(above, "jump", "left").select("id", F.coalesce("found", "a_found").alias("found"), F.when(F.col("found").isNull(), F.col("a_jump")).alias("jump")), "walk")


def build_pairs(messages: DataFrame, by_tree: bool = True) -> DataFrame:
    """One row per response: its prompt and both positions."""
    positioned = rows = materialize(with_prompt_before(messages.select("id", "dialogue_id", "parent_id", "role", "created_at", "deleted_at")), "positioned")
    if by_tree:
        rows = rows.join(ancestor_prompt(messages), "id", "left").withColumn("prompt_id", F.coalesce("prompt_above", "prompt_before"))
    else:
        rows = rows.withColumn("prompt_id", F.col("prompt_before"))
    rows = rows.where("role <> 'user' and prompt_id is not null")
    prompts = positioned.select(F.col("id").alias("prompt_id"), F.col("position").alias("prompt_position"), F.col("role").alias("prompt_role"))
    return rows.join(prompts, "prompt_id").select(
        row_key("id").alias("id"),
        "dialogue_id",
        F.col("prompt_id").alias("prompt_message_id"),
        F.col("id").alias("response_message_id"),
        "prompt_position",
        F.col("position").alias("response_position"),
        "prompt_role",
        F.col("role").alias("response_role"),
        "created_at",
    )


def message_text(parts: DataFrame, part_type: str | None = "text") -> DataFrame:
    """(message_id, text): the parts' text in order, joined by newlines."""
    rows = parts.where("text_content is not null")
    if part_type:
        rows = rows.where(F.col("part_type") == part_type)
    pieces = F.array_sort(F.collect_list(F.struct("sequence", "text_content")))
    return rows.groupBy("message_id").agg(F.array_join(F.transform(pieces, lambda x: x["text_content"]), "\n").alias("text"))


def pair_content(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Texts and word counts of both sides of each pair."""
    text = message_text(parts)
    prompt = text.select(F.col("message_id").alias("prompt_message_id"), F.col("text").alias("prompt_text"))
    response = text.select(F.col("message_id").alias("response_message_id"), F.col("text").alias("response_text"))
    rows = pairs.join(prompt, "prompt_message_id", "left").join(response, "response_message_id", "left")
    return rows.select(F.col("id").alias("prompt_response_id"), "prompt_text", "response_text", word_count(F.col("prompt_text")).alias("prompt_word_count"), word_count(F.col("response_text")).alias("response_word_count"), "created_at")


def dialogues_without_pairs(dialogues: DataFrame, pairs: DataFrame) -> DataFrame:
    """Dialogues an incremental build still has to do."""
    return dialogues.join(pairs.select(F.col("dialogue_id").alias("id")).distinct(), "id", "left_anti")


def rebuild_dialogues(existing: DataFrame, messages: DataFrame, dialogue_ids: DataFrame, by_tree: bool = True) -> DataFrame:
    """``existing`` pairs with those of ``dialogue_ids`` (dialogue_id) rebuilt."""
    fresh = build_pairs(messages.join(dialogue_ids, "dialogue_id", "left_semi"), by_tree)
    return existing.join(dialogue_ids, "dialogue_id", "left_anti").unionByName(fresh)


def siblings(messages: DataFrame) -> DataFrame:
    """id, dialogue_id, parent_id and n_siblings of live messages with siblings.

    The group is its parent; its members are the rows of that parent. No pairs
    are made, so a parent of very many messages costs a count.
    """
    rows = live_messages(messages).where("parent_id is not null").select("id", "dialogue_id", "parent_id").distinct()
    groups = rows.groupBy("dialogue_id", "parent_id").agg((F.count(F.lit(1)) - 1).alias("n_siblings")).where("n_siblings > 0")
    return rows.join(groups, ["dialogue_id", "parent_id"]).select("id", "dialogue_id", "parent_id", "n_siblings")


def siblings_of(messages: DataFrame, message_id: str) -> DataFrame:
    """Ids of the live messages that share the parent of one message."""
    rows = live_messages(messages).where("parent_id is not null").select("dialogue_id", "parent_id", "id")
    own = rows.where(F.col("id") == message_id).select("dialogue_id", "parent_id").distinct()
    return rows.join(own, ["dialogue_id", "parent_id"], "left_semi").where(F.col("id") != message_id).select("id").distinct()
