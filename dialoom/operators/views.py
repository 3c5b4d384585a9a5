"""Views and stored queries over messages, pairs and annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pairs import live_messages, message_text

VALUE_TYPES = ("flag", "string", "numeric", "json")


def ordered(order: list[str], value: str) -> Column:
    """Values collected in order; NULL values are kept."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], F.col(value).alias("__v"))))
    return F.transform(rows, lambda x: x["__v"])


def regenerations(messages: DataFrame) -> DataFrame:
    """Sibling messages of one role: several answers to one parent."""
    rows = live_messages(messages).where("parent_id is not null")
    return (
        rows.groupBy("dialogue_id", "parent_id", "role")
        .agg(F.count(F.lit(1)).alias("sibling_count"), ordered(["created_at", "id"], "id").alias("message_ids"), ordered(["created_at", "id"], "created_at").alias("created_ats"))
        .where("sibling_count > 1")
    )


def message_content(messages: DataFrame, parts: DataFrame) -> DataFrame:
    """Live messages with the text of all their parts; empty ones are kept."""
    text = message_text(parts, None).select(F.col("message_id").alias("id"), "text")
    return live_messages(messages).join(text, "id", "left").select(F.col("id").alias("message_id"), "dialogue_id", "role", "created_at", F.col("text").alias("text_content"))


def pair_content_view(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """Pairs with their texts; pairs without stored text are kept."""
    texts = content.select(F.col("prompt_response_id").alias("id"), "prompt_text", "response_text", "prompt_word_count", "response_word_count")
    return pairs.join(texts, "id", "left").withColumnRenamed("id", "prompt_response_id")


def prompt_exchanges(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """One row per prompt with all its responses in order."""
    rows = pair_content_view(pairs, content)
    return rows.groupBy("prompt_message_id", "dialogue_id").agg(
        F.min("prompt_position").alias("prompt_position"),
        ordered(["response_position", "prompt_response_id"], "response_message_id").alias("response_message_ids"),
        F.count(F.lit(1)).alias("response_count"),
        (F.count(F.lit(1)) > 1).alias("has_regenerations"),
        F.min("prompt_text").alias("prompt_text"),
        F.min("prompt_word_count").alias("prompt_word_count"),
        F.array_join(ordered(["response_position", "prompt_response_id"], "response_text"), "\n---\n").alias("all_responses_text"),
        F.sum("response_word_count").alias("total_response_words"),
        F.min("created_at").alias("created_at"),
    )


def annotations_all(store: DataFrame, entity_type: str) -> DataFrame:
    """All annotations of an entity type with their values as text."""
    return store.where(F.col("entity_type") == entity_type).select("entity_id", "key", "value_type", "value", "confidence", "reason", "source", "created_at")


def annotation_table(store: DataFrame, entity_type: str, value_type: str) -> DataFrame:
    """One of the sixteen typed tables, a partition of the store."""
    return store.where((F.col("entity_type") == entity_type) & (F.col("value_type") == value_type))


def _of_key(store: DataFrame, value_type: str, key: str) -> DataFrame:
    return annotation_table(store, "prompt_response", value_type).where(F.col("key") == key)


def wiki_status(pairs: DataFrame, content: DataFrame, dialogues: DataFrame, store: DataFrame) -> DataFrame:
    """Wiki articles with their title, link count and first lines."""
    wiki = _of_key(store, "string", "exchange_type").where("value = 'wiki_article'").select(F.col("entity_id").alias("prompt_response_id")).distinct()
    title = _of_key(store, "string", "proposed_title").select(F.col("entity_id").alias("prompt_response_id"), F.col("value").alias("extracted_title"), F.col("confidence").alias("title_confidence"))
    links = _of_key(store, "numeric", "wiki_link_count").select(F.col("entity_id").alias("prompt_response_id"), F.col("value").cast("double").alias("wiki_link_count"))
    of = dialogues.select(F.col("id").alias("dialogue_id"), F.col("title").alias("dialogue_title"), F.col("source").alias("platform"))
    rows = pair_content_view(pairs, content).where("response_role = 'assistant'").join(wiki, "prompt_response_id", "left_semi")
    rows = rows.join(of, "dialogue_id").join(title, "prompt_response_id", "left").join(links, "prompt_response_id", "left")
    line = lambda n: F.split_part(F.col("response_text"), F.lit("\n"), F.lit(n))
    return rows.select("prompt_response_id", "dialogue_id", "dialogue_title", "platform", "prompt_text", "response_text", "response_word_count", "extracted_title", "title_confidence", "wiki_link_count", line(1).alias("first_line"), line(2).alias("second_line"), "created_at")


def _as_map(fields: list[str]) -> Column:
    """Annotations of an entity as a map; of equal keys the last in order wins."""
    rows = F.array_sort(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "value_type", F.coalesce("value", F.lit("")).alias("__o"), F.struct(*fields).alias("v")))))
    # keeps the last entry of each key of the ordered list
    last = F.filter(rows, lambda x, i: (i == F.size(rows) - 1) | (F.get(rows, i + 1)["key"] != x["key"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["key"], x["v"])))


def annotation_summary(pairs: DataFrame, store: DataFrame) -> DataFrame:
    """All annotations of each pair as a map, and two common ones."""
    rows = pairs.select(F.col("id").alias("prompt_response_id"), "dialogue_id").join(annotations_all(store, "prompt_response").withColumnRenamed("entity_id", "prompt_response_id"), "prompt_response_id", "left")
    pick = lambda key: F.max(F.when((F.col("key") == key) & (F.col("value_type") == "string"), F.col("value")))
    return rows.groupBy("prompt_response_id", "dialogue_id").agg(_as_map(["value", "value_type", "confidence", "source"]).alias("annotations"), pick("exchange_type").alias("exchange_type"), pick("proposed_title").alias("proposed_title"))


def pairs_with_annotations(pairs: DataFrame, content: DataFrame, store: DataFrame) -> DataFrame:
    """The pair view with a map of annotations, NULL where there are none."""
    maps = annotations_all(store, "prompt_response").groupBy(F.col("entity_id").alias("prompt_response_id")).agg(_as_map(["value_type", "value"]).alias("annotations"))
    return pair_content_view(pairs, content).join(maps, "prompt_response_id", "left")


def wiki_without_titles(pairs: DataFrame, content: DataFrame, dialogues: DataFrame, store: DataFrame, limit: int = 100) -> DataFrame:
    """The longest wiki articles that have no title yet (a top-k report)."""
    rows = wiki_status(pairs, content, dialogues, store).where("extracted_title is null")
    return (
        rows.select("prompt_response_id", "dialogue_id", "dialogue_title", "platform", "wiki_link_count", F.left("prompt_text", F.lit(100)).alias("prompt_preview"), F.left("response_text", F.lit(500)).alias("response_preview"), "first_line", "second_line", "response_word_count", "created_at")
        .orderBy(F.col("response_word_count").desc_nulls_last(), F.col("created_at").desc(), "prompt_response_id")
        .limit(limit)
    )


def title_breakdown(pairs: DataFrame, store: DataFrame) -> DataFrame:
    """Wiki articles with and without a title, counted."""
    wiki = _of_key(store, "string", "exchange_type").where("value = 'wiki_article'").select(F.col("entity_id").alias("id")).distinct()
    titled = _of_key(store, "string", "proposed_title").select(F.col("entity_id").alias("id"), F.lit(True).alias("titled")).distinct()
    rows = pairs.where("response_role = 'assistant'").select("id").join(wiki, "id", "left_semi").join(titled, "id", "left")
    return rows.groupBy(F.when(F.col("titled"), "has_title").otherwise("no_title").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def first_lines(content: DataFrame, limit: int = 50) -> DataFrame:
    """The commonest beginnings of answers (a top-k report)."""
    line = F.left(F.split_part("response_text", F.lit("\n"), F.lit(1)), F.lit(80))
    return content.where("response_text is not null").groupBy(line.alias("first_line_pattern")).agg(F.count(F.lit(1)).alias("occurrences")).orderBy(F.desc("occurrences"), "first_line_pattern").limit(limit)


def archive_stats(dialogues: DataFrame, messages: DataFrame, pairs: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """Rows per table and dialogues per source."""
    row = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    out = row(dialogues, "dialogues").unionByName(row(messages, "messages")).unionByName(row(pairs, "prompt_responses"))
    out = out.unionByName(dialogues.groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("dialogues:"), "source").alias("what"), "n"))
    return out if store is None else out.unionByName(row(store, "annotations"))


def search_texts(content: DataFrame, pattern: str, least_words: int | None = None, most_words: int | None = None) -> DataFrame:
    """Pairs whose answer matches an ILIKE pattern, within word counts."""
    rows = content.where(F.col("response_text").ilike(pattern))
    if least_words is not None:
        rows = rows.where(F.col("response_word_count") >= least_words)
    return rows if most_words is None else rows.where(F.col("response_word_count") <= most_words)
