"""Incremental import: what an export changes in the stored tables.

Stored and incoming messages meet in one full outer join on their natural key;
a CASE names the action of each. Nothing is updated in place: applying the
actions gives the new state of a table, children of changed messages are
recomputed from the message.

Defined results: a dialogue is updated only if its incoming time is newer than
a stored one (a NULL incoming time never, a NULL stored time always); a message
is unchanged if its hash is equal and it isn't deleted; ids are kept; deleted
messages that come again are restored; absent ones are deleted softly, unless
``incremental``; with ``assume_immutable`` contents are never compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("new", "updated", "unchanged", "restored", "soft_deleted", "absent")


def should_update(old: Column, new: Column) -> Column:
    return F.when(new.isNull(), False).when(old.isNull(), True).otherwise(new > old)


def dialogue_actions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming dialogues (id, updated_at) with action new, updated or skipped."""
    old = stored.select("id", F.col("updated_at").alias("__old"), F.lit(True).alias("__known"))
    rows = incoming.join(old, "id", "left")
    action = F.when(F.col("__known").isNull(), "new").when(should_update(F.col("__old"), F.col("updated_at")), "updated").otherwise("skipped")
    return rows.withColumn("action", action).drop("__old", "__known")


def message_actions(stored: DataFrame, incoming: DataFrame, dialogues: DataFrame, assume_immutable: bool = False, incremental: bool = False) -> DataFrame:
    """Action of each message of the dialogues that are new or updated.

    ``stored`` and ``incoming`` have dialogue_id, source_id, content_hash;
    ``stored`` also deleted_at; ``dialogues`` the result of dialogue_actions.
    """
    touched = dialogues.where("action <> 'skipped'").select(F.col("id").alias("dialogue_id"))
    key = ["dialogue_id", "source_id"]
    old = stored.join(touched, "dialogue_id", "left_semi").select(*key, F.col("content_hash").alias("old_hash"), "deleted_at", F.lit(True).alias("in_store"))
    new = incoming.join(touched, "dialogue_id", "left_semi").select(*key, F.col("content_hash").alias("new_hash"), F.lit(True).alias("in_export"))
    both = old.join(new, key, "full_outer")
    same = F.lit(True) if assume_immutable else F.col("old_hash").eqNullSafe(F.col("new_hash"))
    deleted = F.col("deleted_at").isNotNull()
    gone = F.lit("absent") if incremental else F.when(deleted, "absent").otherwise("soft_deleted")
    action = F.when(F.col("in_store").isNull(), "new").when(F.col("in_export").isNull(), gone).when(deleted, "restored").when(same, "unchanged").otherwise("updated")
    return both.select(*key, action.alias("action"))


def apply_messages(stored: DataFrame, incoming: DataFrame, actions: DataFrame, now: Column, assume_immutable: bool = False) -> DataFrame:
    """The message table after the actions.

    A message whose content is kept takes only its parent from the export, and
    keeps that too where the export's parent node has no message.
    """
    key = ["dialogue_id", "source_id"]
    columns = stored.columns
    new = incoming.select(*key, F.struct(*[F.col(c) if c in incoming.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in columns]).alias("__new"))
    old = stored.select(*key, F.struct(*columns).alias("__old"))
    rows = old.join(new, key, "full_outer").join(actions, key, "left")
    takes = F.col("action").isin("new", "updated") | ((F.col("action") == "restored") & F.lit(not assume_immutable))
    out = []
    for c in columns:
        old_c, new_c = F.col(f"__old.{c}"), F.col(f"__new.{c}")
        if c == "deleted_at":
            value = F.when(F.col("action") == "soft_deleted", now).when(F.col("action").isin("restored", "new", "updated"), None).otherwise(old_c)
        elif c == "id":
            value = F.coalesce(old_c, new_c)
        elif c == "parent_id":
            value = F.when(F.col("action").isin("new", "updated", "restored", "unchanged"), F.coalesce(new_c, old_c)).otherwise(old_c)
        else:
            value = F.when(takes, new_c).otherwise(old_c)
        out.append(value.cast(stored.schema[c].dataType).alias(c))
    return rows.where(F.col("__old").isNotNull() | F.col("action").isNotNull()).select(*out)


def replace_children(children: DataFrame, fresh: DataFrame, changed: DataFrame, key: str = "message_id") -> DataFrame:
    """Child rows with those of changed messages (column ``key``) recomputed."""
    return children.join(changed, key, "left_anti").unionByName(fresh.join(changed, key, "left_semi"))


def live_children(children: DataFrame, parents: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """Child rows whose parent exists: cascading deletion."""
    return children.join(parents.select(F.col(parent_key).alias(key)), key, "left_semi")


def soft_delete(messages: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    return _mark(messages, ids, now)


def restore(messages: DataFrame, ids: DataFrame) -> DataFrame:
    return _mark(messages, ids, F.lit(None).cast("timestamp"))


def _mark(messages: DataFrame, ids: DataFrame, value: Column) -> DataFrame:
    named = ids.select("id", F.lit(True).alias("__named")).distinct()
    return messages.join(named, "id", "left").withColumn("deleted_at", F.when(F.col("__named"), value).otherwise(F.col("deleted_at"))).drop("__named").select(*messages.columns)


def import_counts(dialogues: DataFrame, messages: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Ten counters: dialogues new, updated, skipped, failed and so on."""
    names = [f"dialogues_{a}" for a in ("new", "updated", "skipped", "failed")] + [f"messages_{a}" for a in ACTIONS]
    rows = dialogues.select(F.concat(F.lit("dialogues_"), "action").alias("counter")).unionByName(messages.select(F.concat(F.lit("messages_"), "action").alias("counter")))
    if rejected is not None:
        rows = rows.unionByName(rejected.select(F.lit("dialogues_failed").alias("counter")))
    counted = rows.groupBy("counter").agg(F.count(F.lit(1)).alias("n"))
    every = dialogues.sparkSession.createDataFrame([(n,) for n in names], "counter string")
    return every.join(counted, "counter", "left").select("counter", F.coalesce("n", F.lit(0)).alias("n"))
