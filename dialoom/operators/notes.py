"""Notes from exchanges: titles, links between them, Markdown files.

Defined results: untitled exchanges get ``_untitled_ID``; notes of one title
in a dialogue are merged in order; NULL texts count as empty.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import given, strip
from ..session import materialize


def sanitize(title: Column, max_length: int = 200) -> Column:
    """A title as a file name."""
    kept = F.regexp_replace(title, r'[<>:"/\\|?*\[\]]', "")
    short = F.when(F.lower(kept).startswith("the "), F.substring(kept, 5, 1 << 30)).otherwise(kept)
    return strip(F.lower(F.substring(short, 1, max_length)))


def note_title(title: Column, proposed: Column, first_prompt: Column, exchange_id: Column) -> Column:
    """Title, proposed title, first line of the prompt, or a placeholder."""
    line = F.split_part(first_prompt, F.lit("\n"), F.lit(1))
    return sanitize(F.coalesce(given(title), given(proposed), given(line), F.concat(F.lit("_untitled_"), exchange_id)))


def with_neighbours(notes: DataFrame) -> DataFrame:
    """Notes with the titles before and after them in their dialogue."""
    w = Window.partitionBy("dialogue_id").orderBy("exchange")
    return notes.withColumn("previous_title", F.lag("title").over(w)).withColumn("next_title", F.lead("title").over(w))


def body(messages: Column, previous: Column, following: Column) -> Column:
    """The text of a note: its messages and the links to its neighbours.

    ``messages`` is an array of (role, text) in order.
    """
    parts = F.array_join(F.transform(messages, lambda m: F.concat(F.lit("**"), F.upper(m["role"]), F.lit("**\n\n"), strip(F.coalesce(m["text"], F.lit(""))))), "\n\n")
    links = F.concat(
        F.when(previous.isNotNull(), F.concat(F.lit("preceding: [["), previous, F.lit("]]  \n"))).otherwise(""),
        F.when(following.isNotNull(), F.concat(F.lit("following: [["), following, F.lit("]]\n"))).otherwise(""),
    )
    return F.concat(parts, F.lit("\n"), F.when(links != "", F.concat(F.lit("\n---\n"), links)).otherwise(""))


def notes_of(merged: DataFrame, exchange_rows: DataFrame) -> DataFrame:
    """A note per exchange: title, neighbours, body, tags, date.

    ``merged`` has the exchanges' messages, ``exchange_rows`` their rules with
    exchange_id, title and proposed_title.
    """
    order = F.array_sort(F.collect_list(F.struct("created_at", "message_id", "role", F.coalesce("text", F.lit("")).alias("text"))))
    user = F.col("role") == "user"
    rows = merged.groupBy("dialogue_id", "exchange").agg(
        F.transform(order, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("messages"),
        F.transform(order, lambda x: F.concat(F.lit("msg_"), x["message_id"])).alias("message_tags"),
        F.min("created_at").alias("date"),
        F.min_by(F.when(user, F.coalesce("text", F.lit(""))), F.when(user, F.struct("created_at", "message_id"))).alias("first_prompt"),
    )
    rows = rows.join(exchange_rows.select("dialogue_id", "exchange", "exchange_id", "title", "proposed_title", *[c for c in exchange_rows.columns if c == "source"]), ["dialogue_id", "exchange"])
    rows = rows.withColumn("title", note_title(F.col("title"), F.col("proposed_title"), F.col("first_prompt"), F.col("exchange_id")))
    rows = with_neighbours(rows)
    source = F.concat(F.lit("source__"), "source") if "source" in exchange_rows.columns else F.lit(None).cast("string")
    tags = F.concat(F.array_compact(F.array(F.lit("autogenerated"), source, F.concat(F.lit("conversation_id__"), "dialogue_id"))), "message_tags")
    return rows.select("dialogue_id", "exchange", "title", "previous_title", "next_title", "first_prompt", "date", tags.alias("tags"), body(F.col("messages"), F.col("previous_title"), F.col("next_title")).alias("content"))


def merge_titles(notes: DataFrame) -> DataFrame:
    """Notes of equal title in a dialogue as one, in order."""
    order = F.array_sort(F.collect_list(F.struct("exchange", "content", "tags")))
    return notes.groupBy("dialogue_id", "title").agg(
        F.min("exchange").alias("exchange"),
        F.min("date").alias("date"),
        F.min_by("first_prompt", "exchange").alias("first_prompt"),
        F.array_join(F.transform(order, lambda x: x["content"]), "\n---\n").alias("content"),
        F.flatten(F.transform(order, lambda x: x["tags"])).alias("tags"),
    )


def link_titles(content: str, own: str, titles: list[str]) -> tuple[str, list[str]]:
    """Other titles in a text as wiki links, each unless linked already; the linked ones."""
    linked = []
    for other in titles:
        if other != own and other:
            if f"[[{other}]]" not in content:
                content = regex.sub(rf"\b{regex.escape(other)}\b", lambda _: f"[[{other}]]", content)
            if f"[[{other}]]" in content:
                linked.append(other)
    return content, linked


def wikilinkify(notes: DataFrame) -> DataFrame:
    """Merged notes with links to the other notes of their dialogue.

    The titles of a dialogue (not its texts) travel with each of its notes;
    replacement is sequential, in the order of exchanges. A note whose prompt
    quotes another note is linked from there by a ``see also`` line, unless it
    has a link to that note already.
    """
    titles = notes.groupBy("dialogue_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("exchange", "title"))), lambda x: x["title"]).alias("titles"))
    rows = notes.join(titles, "dialogue_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [link_titles(c or "", t, ts) for c, t, ts in zip(b.column("content").to_pylist(), b.column("title").to_pylist(), b.column("titles").to_pylist())]
            out = b.set_column(b.schema.get_field_index("content"), "content", pa.array([c for c, _ in done], pa.string()))
            yield out.set_column(out.schema.get_field_index("titles"), "titles", pa.array([x for _, x in done], pa.list_(pa.string())))

    linked = materialize(rows.mapInArrow(run, rows.schema), "linked")
    has = linked.select("dialogue_id", F.col("title").alias("quoting"), F.explode("titles").alias("title"))
    quotes = notes.where(F.col("first_prompt").startswith(">")).select(
        "dialogue_id", F.col("title").alias("quoting"), F.replace(sanitize(F.regexp_replace(F.split_part("first_prompt", F.lit("\n"), F.lit(1)), r"\A>+", "")), F.lit("#"), F.lit("")).alias("quote")
    )
    plain = notes.select("dialogue_id", "title", F.replace(sanitize(F.col("content")), F.lit("#"), F.lit("")).alias("plain"))
    found = plain.join(quotes, "dialogue_id").where((F.col("title") != F.col("quoting")) & (F.col("quote") != "") & F.contains("plain", "quote"))
    found = found.join(has, ["dialogue_id", "quoting", "title"], "left_anti")
    lines = found.groupBy("dialogue_id", "title").agg(F.array_join(F.transform(F.array_sort(F.collect_set("quoting")), lambda t: F.concat(F.lit("\nsee also: [["), t, F.lit("]]  "))), "").alias("see_also"))
    return linked.join(lines, ["dialogue_id", "title"], "left").withColumn("content", F.concat("content", F.coalesce("see_also", F.lit("")))).drop("see_also").select(*notes.columns)


def front_matter(notes: DataFrame) -> Column:
    """YAML head of a note."""
    quoted = F.to_json(F.struct(F.col("title").alias("t")))
    title = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    return F.concat(F.lit("---\ndate: "), F.coalesce(F.col("date").cast("string"), F.lit("null")), F.lit("\ntags:\n- "), F.array_join("tags", "\n- "), F.lit("\ntitle: "), title, F.lit("\n---\n\n"))


def write_notes(notes: DataFrame, folder: str) -> None:
    """Append each note to FOLDER/TITLE.md, from the tasks that hold them.

    ``folder`` is one that all workers see. Notes of one title are written by
    one task, in order.
    """
    rows = notes.select("title", "exchange", F.concat(front_matter(notes), "content", F.lit("\n")).alias("text")).repartition("title").sortWithinPartitions("title", "exchange")

    def write(part) -> None:
        os.makedirs(folder, exist_ok=True)
        for r in part:
            with open(os.path.join(folder, f"{r['title']}.md"), "a", encoding="utf-8") as f:
                f.write(r["text"])

    rows.foreachPartition(write)
