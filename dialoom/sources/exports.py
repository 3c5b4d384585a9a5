"""Conversation exports of two platforms to relational tables.

Each export is one JSON object per conversation. Heterogeneous nodes stay
variants until a projection reads them; arrays are exploded with their
position, so every child row keeps its parent's key and its order. All tables
of a platform hang on ``messages``; none needs a shuffle but the links between
message nodes.

Defined results: a conversation without an id goes to ``rejected``; malformed
JSON too; nodes without a message, and messages without an id, give no row;
of equal message ids in a conversation the last node counts; a parent without
a message gives a NULL parent; empty arrays give no children.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import content_hash, given, normalize_role, parse_time, parse_time_text, row_key, text_at, truthy

PLATFORMS = ("chatgpt", "claude")
CHATGPT = "struct<conversation_id:string,id:string,title:string,create_time:variant,update_time:variant,mapping:map<string,struct<id:string,parent:string,children:array<string>,message:variant>>>"
CLAUDE = "struct<uuid:string,name:string,created_at:string,updated_at:string,chat_messages:array<variant>>"


def source_registry(spark: SparkSession) -> DataFrame:
    """The known platforms."""
    rows = [("chatgpt", "ChatGPT", True, ["user", "assistant", "system", "tool"]), ("claude", "Claude", False, ["user", "assistant"])]
    return spark.createDataFrame(rows, "id string, display_name string, has_native_trees boolean, role_vocabulary array<string>")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Conversations of an export file or folder, one JSON text per row.

    A missing path raises FileNotFoundError, a root that is no array
    ValueError. Files are read in parallel, each as a whole since an export is
    one array.
    """
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(path)
    files = spark.read.text(path, wholetext=True)
    rows = files.select(F.from_json("value", "array<string>").alias("items"))
    if not rows.where("items is null").isEmpty():
        raise ValueError(f"{path}: the root of an export must be an array")
    return rows.select(F.explode("items").alias("source_json"))


def _array(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def chatgpt_dialogues(raw: DataFrame) -> DataFrame:
    """Conversations with a tree of nodes; the id is conversation_id or id."""
    doc = raw.select(F.from_json("source_json", CHATGPT).alias("c"), "source_json")
    return doc.select(
        F.lit("chatgpt").alias("source"),
        F.coalesce(given(F.col("c.conversation_id")), given(F.col("c.id"))).alias("source_id"),
        F.col("c.title").alias("title"),
        parse_time(F.col("c.create_time")).alias("created_at"),
        parse_time(F.col("c.update_time")).alias("updated_at"),
        F.col("c.mapping").alias("nodes"),
        "source_json",
    )


def claude_dialogues(raw: DataFrame) -> DataFrame:
    """Conversations with a list of messages; the id is uuid."""
    doc = raw.select(F.from_json("source_json", CLAUDE).alias("c"), "source_json")
    return doc.select(
        F.lit("claude").alias("source"),
        given(F.col("c.uuid")).alias("source_id"),
        F.col("c.name").alias("title"),
        parse_time_text(F.col("c.created_at")).alias("created_at"),
        parse_time_text(F.col("c.updated_at")).alias("updated_at"),
        F.col("c.chat_messages").alias("nodes"),
        "source_json",
    )


def _last_of_id(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("dialogue_id", "source_id").orderBy(F.col("ordinal").desc())
    return rows.withColumn("__last", F.row_number().over(w)).where("__last = 1").drop("__last")


def chatgpt_messages(dialogues: DataFrame) -> DataFrame:
    """Messages of the trees, linked to the message of their parent node."""
    nodes = dialogues.where("source_id is not null").select(row_key("source", "source_id").alias("dialogue_id"), F.posexplode(F.map_entries("nodes")).alias("ordinal", "e"))
    m = F.col("m")
    rows = (
        nodes.select("dialogue_id", "ordinal", F.col("e.key").alias("node"), F.col("e.value.parent").alias("parent_node"), F.col("e.value.message").alias("m"))
        .where(m.isNotNull() & ~F.is_variant_null(m) & (given(text_at(m, "$.id")).isNotNull()))
        .select(
            "dialogue_id",
            text_at(m, "$.id").alias("source_id"),
            "ordinal",
            "node",
            "parent_node",
            normalize_role(text_at(m, "$.author.role")).alias("role"),
            text_at(m, "$.author.metadata.user_id").alias("author_id"),
            text_at(m, "$.author.name").alias("author_name"),
            parse_time(F.try_variant_get(m, "$.create_time", "variant")).alias("created_at"),
            parse_time(F.try_variant_get(m, "$.update_time", "variant")).alias("updated_at"),
            content_hash(m).alias("content_hash"),
            m.alias("body"),
        )
    )
    rows = _last_of_id(rows).withColumn("id", row_key("dialogue_id", "source_id"))
    parents = rows.select("dialogue_id", F.col("node").alias("parent_node"), F.col("id").alias("parent_id"))
    return rows.join(parents, ["dialogue_id", "parent_node"], "left").drop("node", "parent_node").withColumn("platform", F.lit("chatgpt"))


def claude_messages(dialogues: DataFrame) -> DataFrame:
    """Messages of the lists, each the child of the one before it."""
    nodes = dialogues.where("source_id is not null").select(row_key("source", "source_id").alias("dialogue_id"), F.posexplode("nodes").alias("ordinal", "m"))
    m = F.col("m")
    rows = nodes.where(given(text_at(m, "$.uuid")).isNotNull()).select(
        "dialogue_id",
        text_at(m, "$.uuid").alias("source_id"),
        "ordinal",
        normalize_role(text_at(m, "$.sender")).alias("role"),
        F.lit(None).cast("string").alias("author_id"),
        F.lit(None).cast("string").alias("author_name"),
        parse_time_text(text_at(m, "$.created_at")).alias("created_at"),
        parse_time_text(text_at(m, "$.updated_at")).alias("updated_at"),
        content_hash(m).alias("content_hash"),
        m.alias("body"),
    )
    rows = _last_of_id(rows).withColumn("id", row_key("dialogue_id", "source_id"))
    w = Window.partitionBy("dialogue_id").orderBy("ordinal")
    return rows.withColumn("parent_id", F.lag("id").over(w)).withColumn("platform", F.lit("claude"))


def _chatgpt_part(p: Column) -> Column:
    kind = F.schema_of_variant(p)
    is_text, is_object = kind == "STRING", kind.startswith("OBJECT")
    ct = F.lower(F.coalesce(text_at(p, "$.content_type"), F.lit("")))
    language = given(text_at(p, "$.language"))
    medium = F.when(ct.contains("image"), "image").when(ct.contains("audio"), "audio").when(ct.contains("video"), "video")
    code = is_object & medium.isNull() & ((ct == "code") | language.isNotNull())
    pointer, url = given(text_at(p, "$.asset_pointer")), given(text_at(p, "$.url"))
    first_text = F.coalesce(*[given(F.when(F.schema_of_variant(F.try_variant_get(p, f"$.{k}", "variant")) == "STRING", text_at(p, f"$.{k}"))) for k in ("text", "result", "content")])
    return F.struct(
        F.when(is_text, "text").when(~is_object, "unknown").when(medium.isNotNull(), medium).when(code, "code").otherwise(F.coalesce(given(text_at(p, "$.content_type")), F.lit("unknown"))).alias("part_type"),
        F.when(is_text, text_at(p, "$")).when(code, F.coalesce(given(text_at(p, "$.text")), given(text_at(p, "$.code")))).when(is_object & medium.isNull(), first_text).alias("text_content"),
        F.when(code, language).alias("language"),
        F.when(is_object & medium.isNotNull(), text_at(p, "$.content_type")).alias("media_type"),
        F.when(is_object & (medium == "image"), F.when(pointer.startswith("file-service://"), pointer).otherwise(url)).when(is_object & medium.isNotNull(), F.coalesce(url, pointer)).alias("url"),
        F.lit(None).cast("string").alias("tool_name"),
        F.lit(None).cast("string").alias("tool_use_id"),
        F.lit(None).cast("string").alias("tool_input"),
        F.lit(None).cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(None).cast("boolean").alias("is_error"),
        F.to_json(p).alias("source_json"),
    )


def _claude_part(p: Column) -> Column:
    kind = F.lower(F.coalesce(text_at(p, "$.type"), F.lit("unknown")))
    content = F.try_variant_get(p, "$.content", "variant")
    listed = F.filter(
        F.transform(F.try_variant_get(p, "$.content", "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "STRING", text_at(x, "$")).otherwise(given(text_at(x, "$.text")))),
        lambda x: x.isNotNull(),
    )
    result = F.when(F.schema_of_variant(content) == "STRING", text_at(p, "$.content")).otherwise(given(F.array_join(listed, "\n")))
    return F.struct(
        kind.alias("part_type"),
        F.when(kind == "text", text_at(p, "$.text"))
        .when(kind == "thinking", text_at(p, "$.thinking"))
        .when(kind == "tool_use", F.coalesce(given(text_at(p, "$.input.query")), given(text_at(p, "$.input.text"))))
        .when(kind == "tool_result", result)
        .when(kind != "image", text_at(p, "$.text"))
        .alias("text_content"),
        F.lit(None).cast("string").alias("language"),
        F.when(kind == "image", text_at(p, "$.media_type")).alias("media_type"),
        F.when((kind == "image") & (text_at(p, "$.source.type") == "url"), text_at(p, "$.source.url")).alias("url"),
        F.when(kind == "tool_use", text_at(p, "$.name")).alias("tool_name"),
        F.when(kind == "tool_use", text_at(p, "$.id")).when(kind == "tool_result", text_at(p, "$.tool_use_id")).alias("tool_use_id"),
        F.when(kind == "tool_use", F.to_json(F.try_variant_get(p, "$.input", "variant"))).alias("tool_input"),
        parse_time_text(text_at(p, "$.start_timestamp")).alias("started_at"),
        parse_time_text(text_at(p, "$.stop_timestamp")).alias("ended_at"),
        F.when(kind == "tool_result", F.coalesce(F.try_variant_get(p, "$.is_error", "boolean"), F.lit(False))).alias("is_error"),
        F.to_json(p).alias("source_json"),
    )


def content_parts(messages: DataFrame) -> DataFrame:
    """Classified parts of messages of either platform, in order."""
    body = F.col("body")
    # an item of plain text instead of a list stands for one text part
    fallback = F.array(F.try_parse_json(F.to_json(F.struct(F.lit("text").alias("type"), text_at(body, "$.text").alias("text")))))
    listed = _array(body, "$.content")
    claude = F.when(F.size(listed) > 0, listed).when(given(text_at(body, "$.text")).isNotNull(), fallback).otherwise(F.array().cast("array<variant>"))
    items = F.when(F.col("platform") == "chatgpt", _array(body, "$.content.parts")).otherwise(claude)
    rows = messages.select(F.col("id").alias("message_id"), "dialogue_id", "platform", F.posexplode(items).alias("sequence", "p"))
    part = F.when(F.col("platform") == "chatgpt", _chatgpt_part(F.col("p"))).otherwise(_claude_part(F.col("p")))
    rows = rows.withColumn("part", part).select(row_key("message_id", F.col("sequence").cast("string")).alias("id"), "message_id", "dialogue_id", "platform", "sequence", "part.*", F.col("p").alias("body"))
    return rows.unionByName(_canvas_parts(messages))


def _canvas_parts(messages: DataFrame) -> DataFrame:
    """A canvas document of a message as one more part after its parts."""
    canvas = F.try_variant_get("body", "$.metadata.canvas", "variant")
    own = F.try_variant_get("body", "$.canvas", "variant")
    doc = F.coalesce(F.when(F.schema_of_variant(canvas).startswith("OBJECT"), canvas), F.when(F.schema_of_variant(own).startswith("OBJECT"), own))
    rows = messages.where(F.col("platform") == "chatgpt").withColumn("p", doc).where("p is not null")
    p = F.col("p")
    null = lambda kind: F.lit(None).cast(kind)
    return rows.select(
        row_key("id", F.lit("canvas")).alias("id"),
        F.col("id").alias("message_id"),
        "dialogue_id",
        "platform",
        F.size(_array(F.col("body"), "$.content.parts")).alias("sequence"),
        F.lit("canvas").alias("part_type"),
        F.coalesce(given(text_at(p, "$.content")), given(text_at(p, "$.textdoc_content"))).alias("text_content"),
        *[null("string").alias(c) for c in ("language", "media_type", "url", "tool_name", "tool_use_id", "tool_input")],
        null("timestamp").alias("started_at"),
        null("timestamp").alias("ended_at"),
        null("boolean").alias("is_error"),
        F.to_json(p).alias("source_json"),
        p.alias("body"),
    )


def citations(messages: DataFrame, parts: DataFrame) -> DataFrame:
    """Citations of the first part (chatgpt) or of their own part (claude)."""
    chatgpt = messages.where((F.col("platform") == "chatgpt") & (F.size(_array(F.col("body"), "$.content.parts")) > 0)).select(
        row_key("id", F.lit("0")).alias("content_part_id"), F.posexplode(_array(F.col("body"), "$.metadata.citations")).alias("ordinal", "c")
    )
    claude = parts.where("platform = 'claude'").select(F.col("id").alias("content_part_id"), F.posexplode(_array(F.col("body"), "$.citations")).alias("ordinal", "c"))
    c = F.col("c")
    return (
        chatgpt.unionByName(claude)
        .where(F.schema_of_variant(c).startswith("OBJECT"))
        .select(
            "content_part_id",
            "ordinal",
            text_at(c, "$.uuid").alias("source_id"),
            F.coalesce(given(text_at(c, "$.details.url")), text_at(c, "$.url")).alias("url"),
            F.coalesce(given(text_at(c, "$.details.type")), text_at(c, "$.type")).alias("citation_type"),
            F.try_variant_get(c, "$.start_index", "int").alias("start_index"),
            F.try_variant_get(c, "$.end_index", "int").alias("end_index"),
            F.to_json(c).alias("source_json"),
        )
    )


def attachments(messages: DataFrame) -> DataFrame:
    """Attachments of messages; on claude the bare files too."""
    chatgpt = messages.where("platform = 'chatgpt'").select(F.col("id").alias("message_id"), F.posexplode(_array(F.col("body"), "$.metadata.attachments")).alias("ordinal", "a"), F.lit(False).alias("is_file"))
    claude = messages.where("platform = 'claude'").select(F.col("id").alias("message_id"), F.posexplode(_array(F.col("body"), "$.attachments")).alias("ordinal", "a"), F.lit(False).alias("is_file"))
    files = messages.where("platform = 'claude'").select(F.col("id").alias("message_id"), F.posexplode(_array(F.col("body"), "$.files")).alias("ordinal", "a"), F.lit(True).alias("is_file"))
    a = F.col("a")
    return (
        chatgpt.unionByName(claude)
        .unionByName(files)
        .where(F.schema_of_variant(a).startswith("OBJECT"))
        .select(
            "message_id",
            "ordinal",
            "is_file",
            F.coalesce(given(text_at(a, "$.name")), text_at(a, "$.file_name")).alias("file_name"),
            F.coalesce(given(text_at(a, "$.mime_type")), given(text_at(a, "$.mimeType")), text_at(a, "$.file_type")).alias("file_type"),
            F.coalesce(F.try_variant_get(a, "$.size", "bigint"), F.try_variant_get(a, "$.file_size", "bigint")).alias("file_size"),
            text_at(a, "$.extracted_content").alias("extracted_text"),
            F.to_json(a).alias("source_json"),
        )
    )


def chatgpt_meta(messages: DataFrame) -> DataFrame:
    """Model, custom assistant and state of chatgpt messages."""
    b = F.col("body")
    return messages.where("platform = 'chatgpt'").select(
        F.col("id").alias("message_id"),
        text_at(b, "$.metadata.model_slug").alias("model_slug"),
        text_at(b, "$.metadata.gizmo_id").alias("gizmo_id"),
        text_at(b, "$.status").alias("status"),
        F.try_variant_get(b, "$.end_turn", "boolean").alias("end_turn"),
    )


def claude_meta(messages: DataFrame) -> DataFrame:
    """The raw node of claude messages."""
    return messages.where("platform = 'claude'").select(F.col("id").alias("message_id"), F.to_json("body").alias("source_json"))


def search_groups(messages: DataFrame) -> DataFrame:
    """Search result groups of messages, in order."""
    rows = messages.where("platform = 'chatgpt'").select(F.col("id").alias("message_id"), F.posexplode(_array(F.col("body"), "$.metadata.search_result_groups")).alias("sequence", "g"))
    g = F.col("g")
    return rows.where(F.schema_of_variant(g).startswith("OBJECT")).select(
        row_key("message_id", F.lit("search"), F.col("sequence").cast("string")).alias("id"), "message_id", "sequence", text_at(g, "$.type").alias("group_type"), text_at(g, "$.domain").alias("domain"), g.alias("body")
    )


def search_entries(groups: DataFrame) -> DataFrame:
    """Entries of search groups, in order."""
    rows = groups.select(F.col("id").alias("group_id"), F.posexplode(_array(F.col("body"), "$.entries")).alias("sequence", "e"))
    e = F.col("e")
    return rows.where(F.schema_of_variant(e).startswith("OBJECT")).select(
        "group_id", "sequence", text_at(e, "$.url").alias("url"), text_at(e, "$.title").alias("title"), text_at(e, "$.snippet").alias("snippet"), parse_time(F.try_variant_get(e, "$.pub_date", "variant")).alias("published_at")
    )


def code_executions(messages: DataFrame) -> DataFrame:
    """Code runs of messages; the traceback joined, NULL where empty."""
    b = F.col("body")
    r = "$.metadata.aggregate_result"
    lines = F.transform(_array(b, f"{r}.in_kernel_exception.traceback"), lambda x: text_at(x, "$"))
    return messages.where((F.col("platform") == "chatgpt") & truthy(b, r)).select(
        F.col("id").alias("message_id"),
        text_at(b, f"{r}.run_id").alias("run_id"),
        text_at(b, f"{r}.status").alias("status"),
        text_at(b, f"{r}.code").alias("code"),
        parse_time(F.try_variant_get(b, f"{r}.start_time", "variant")).alias("started_at"),
        parse_time(F.try_variant_get(b, f"{r}.end_time", "variant")).alias("ended_at"),
        text_at(b, f"{r}.final_expression_output").alias("final_output"),
        text_at(b, f"{r}.in_kernel_exception.name").alias("exception_name"),
        given(F.array_join(lines, "\n")).alias("traceback"),
        F.try_variant_get(b, r, "variant").alias("body"),
    )


def code_outputs(executions: DataFrame) -> DataFrame:
    """Messages a code run printed or displayed, in order."""
    rows = executions.select("message_id", F.posexplode(_array(F.col("body"), "$.messages")).alias("sequence", "o"))
    o = F.col("o")
    return rows.where(F.schema_of_variant(o).startswith("OBJECT")).select(
        "message_id",
        "sequence",
        text_at(o, "$.message_type").alias("output_type"),
        text_at(o, "$.stream_name").alias("stream_name"),
        F.coalesce(given(text_at(o, "$.text")), text_at(o, "$.content")).alias("text_content"),
        text_at(o, "$.image_url").alias("image_url"),
    )


def dalle_generations(parts: DataFrame) -> DataFrame:
    """Image generations described by image parts."""
    b = F.col("body")
    node = F.coalesce(F.when(truthy(b, "$.metadata.dalle"), F.try_variant_get(b, "$.metadata.dalle", "variant")), F.when(truthy(b, "$.metadata.generation"), F.try_variant_get(b, "$.metadata.generation", "variant")))
    g = F.col("g")
    return parts.where("platform = 'chatgpt'").withColumn("g", node).where("g is not null").select(
        F.col("id").alias("content_part_id"),
        text_at(g, "$.gen_id").alias("gen_id"),
        text_at(g, "$.prompt").alias("prompt"),
        F.try_variant_get(g, "$.seed", "bigint").alias("seed"),
        F.coalesce(F.try_variant_get(g, "$.width", "int"), F.try_variant_get(b, "$.width", "int")).alias("width"),
        F.coalesce(F.try_variant_get(g, "$.height", "int"), F.try_variant_get(b, "$.height", "int")).alias("height"),
    )


def canvas_docs(parts: DataFrame) -> DataFrame:
    """Canvas documents with their version."""
    b = F.col("body")
    return parts.where("part_type = 'canvas' and platform = 'chatgpt'").select(
        F.col("id").alias("content_part_id"),
        "message_id",
        text_at(b, "$.textdoc_id").alias("textdoc_id"),
        F.try_variant_get(b, "$.version", "int").alias("version"),
        text_at(b, "$.title").alias("title"),
        text_at(b, "$.textdoc_type").alias("textdoc_type"),
        "text_content",
        F.try_variant_get(b, "$.from_version", "int").alias("from_version"),
        F.coalesce(F.try_variant_get(b, "$.has_user_edit", "boolean"), F.lit(False)).alias("has_user_edit"),
    )


def latest_canvas(docs: DataFrame) -> DataFrame:
    """The newest version of each document over all dialogues.

    max_by over (version, part) combines map-side, so one document with very
    many versions is no hot window; ties fall to the larger part key.
    """
    order = F.struct(F.coalesce("version", F.lit(-1)), F.col("content_part_id"))
    row = F.struct("content_part_id", "message_id", "version", "title")
    return docs.where("textdoc_id is not null").groupBy("textdoc_id").agg(F.max_by(row, order).alias("r")).select("textdoc_id", "r.*")


def ingestion_annotations(messages: DataFrame, docs: DataFrame) -> DataFrame:
    """Annotations known at import: custom assistants, models, canvas versions."""
    meta = chatgpt_meta(messages)
    row = lambda key, kind, value: F.struct(F.lit(key).alias("key"), F.lit(kind).alias("value_type"), value.cast("string").alias("value"))
    of_meta = meta.select(
        F.lit("message").alias("entity_type"),
        F.col("message_id").alias("entity_id"),
        F.explode(
            F.filter(
                F.array(
                    F.when(given(F.col("gizmo_id")).isNotNull(), row("gizmo_id", "string", F.col("gizmo_id"))),
                    F.when(given(F.col("gizmo_id")).isNotNull(), row("has_gizmo", "flag", F.lit(None))),
                    F.when(given(F.col("model_slug")).isNotNull(), row("model_slug", "string", F.col("model_slug"))),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("a"),
    )
    of_canvas = docs.select(
        F.lit("content_part").alias("entity_type"),
        F.col("content_part_id").alias("entity_id"),
        F.explode(
            F.filter(
                F.array(
                    F.when(given(F.col("title")).isNotNull(), row("title", "string", F.col("title"))),
                    F.when(given(F.col("textdoc_id")).isNotNull(), row("textdoc_id", "string", F.col("textdoc_id"))),
                    F.when(F.col("version").isNotNull(), row("canvas_version", "numeric", F.col("version"))),
                    F.when(given(F.col("textdoc_type")).isNotNull(), row("textdoc_type", "string", F.col("textdoc_type"))),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("a"),
    )
    newest = latest_canvas(docs).select(F.lit("content_part").alias("entity_type"), F.col("content_part_id").alias("entity_id"), row("is_latest_canvas_version", "flag", F.lit(None)).alias("a"))
    return of_meta.unionByName(of_canvas).unionByName(newest).select("entity_type", "entity_id", "a.*")


def messages_with_gizmo(messages: DataFrame, gizmo_id: str) -> DataFrame:
    """Ids of messages made by one custom assistant."""
    return chatgpt_meta(messages).where(F.col("gizmo_id") == gizmo_id).select("message_id")


def import_export(raw: DataFrame, platform: str, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All tables of one platform's conversations (column source_json).

    ``keep`` (such as ``materialize``) stores messages and parts, on which all
    other tables hang, so that several of them don't parse the export again.
    """
    if platform not in PLATFORMS:
        raise ValueError(f"platform must be one of {PLATFORMS}")
    dialogues = chatgpt_dialogues(raw) if platform == "chatgpt" else claude_dialogues(raw)
    keep = keep or (lambda df, _: df)
    messages = keep(chatgpt_messages(dialogues) if platform == "chatgpt" else claude_messages(dialogues), "messages")
    parts = keep(content_parts(messages), "parts")
    groups, runs, docs = search_groups(messages), code_executions(messages), canvas_docs(parts)
    return {
        "dialogues": dialogues.where("source_id is not null").select(row_key("source", "source_id").alias("id"), "source", "source_id", "title", "created_at", "updated_at", "source_json"),
        "rejected": dialogues.where("source_id is null").select("source_json"),
        "messages": messages,
        "content_parts": parts,
        "citations": citations(messages, parts),
        "attachments": attachments(messages),
        "chatgpt_message_meta": chatgpt_meta(messages),
        "claude_message_meta": claude_meta(messages),
        "search_groups": groups.drop("body"),
        "search_entries": search_entries(groups),
        "code_executions": runs.drop("body"),
        "code_outputs": code_outputs(runs),
        "dalle_generations": dalle_generations(parts),
        "canvas_docs": docs,
        "annotations": ingestion_annotations(messages, docs),
    }


def import_all(raws: dict[str, DataFrame], keep: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables of several platforms, united."""
    out: dict[str, DataFrame] = {}
    for platform, raw in raws.items():
        for name, df in import_export(raw, platform, keep).items():
            out[name] = df if name not in out else out[name].unionByName(df)
    return out


def inferred_schema(raw: DataFrame, json_column: str = "source_json", by: str = "source") -> DataFrame:
    """The merged structural schema of all documents, one row per ``by``.

    The keys of ``mapping`` are ids, a new set in each document; its nodes merge
    as the items of one list, so the schema does not grow with the table.
    """
    doc = F.try_parse_json(json_column)
    fields = F.try_variant_get(doc, "$", "map<string,variant>")
    nodes = F.try_variant_get(doc, "$.mapping", "map<string,variant>")
    listed = F.map_concat(F.map_filter("fields", lambda k, _: k != "mapping"), F.create_map(F.lit("mapping"), F.to_variant_object(F.map_values("nodes"))))
    rows = raw.select(by, doc.alias("doc"), fields.alias("fields"), nodes.alias("nodes"))
    merged = F.when(F.col("nodes").isNull(), F.col("doc")).otherwise(F.to_variant_object(listed))
    return rows.select(by, merged.alias("doc")).groupBy(by).agg(F.schema_of_variant_agg("doc").alias("json_schema"))


def linked_ids(html: DataFrame, column: str = "html", prefix: str = "/chat/") -> DataFrame:
    """Ids in the anchors of pages whose target starts with ``prefix``."""
    found = F.regexp_extract_all(F.col(column), F.lit(f"""<a[^>]*\\shref=["']{prefix}([^"'/?#]+)"""), 1)
    return html.select(F.explode(found).alias("id")).distinct()
