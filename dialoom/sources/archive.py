"""The stored archive: tables under one folder with atomic commits.

Plain Parquet has no transactions. Tables are written beside their present
versions, on whatever file system the folder is; a commit then publishes one
small file that lists the version of every table. Readers follow the newest
list, so they see all tables of an import or none, and a failed import leaves
nothing but folders that ``vacuum`` removes. Two commits at once can't both
take the next number: the second raises.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import annotations, annotators, pairs, sync, views
from ..session import materialize, remove_folder, scratch
from . import exports

TABLES = ("dialogues", "messages", "content_parts", "citations", "attachments", "chatgpt_message_meta", "claude_message_meta", "search_groups", "search_entries", "code_executions", "code_outputs", "dalle_generations", "canvas_docs", "prompt_responses", "prompt_response_content", "annotations", "annotator_cursors")
CHILDREN = {"content_parts": "message_id", "attachments": "message_id", "chatgpt_message_meta": "message_id", "claude_message_meta": "message_id", "search_groups": "message_id", "code_executions": "message_id", "code_outputs": "message_id", "canvas_docs": "message_id"}
#: Tables that hang on a child of a message: parent table, key.
GRANDCHILDREN = {"citations": ("content_parts", "content_part_id"), "dalle_generations": ("content_parts", "content_part_id"), "search_entries": ("search_groups", "group_id")}
#: Tables of an import written at once.
WRITERS = 4
COMMIT = re.compile(r"commit-(\d{12})\.json")


def archive_root(spark: SparkSession) -> str:
    """Where the archive lies: the session's setting, or the warehouse."""
    return spark.conf.get("spark.dialoom.archive", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/dialoom"


class Archive:
    """Tables by name under one folder that all workers see."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, (root or archive_root(spark)).rstrip("/")
        self._staged: dict[str, dict] | None = None

    def _path(self, name: str = ""):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def init(self) -> None:
        """Create the folder; harmless where it exists."""
        self._files().mkdirs(self._path())

    def reset(self, confirm: bool = False) -> None:
        """Drop everything; only when confirmed."""
        if not confirm:
            raise ValueError("reset drops all tables; pass confirm=True")
        remove_folder(self.spark, self.root)
        self.init()

    def _names(self) -> list[str]:
        files = self._files()
        return [f.getPath().getName() for f in files.listStatus(self._path())] if files.exists(self._path()) else []

    def _newest(self) -> int:
        return max((int(m[1]) for m in map(COMMIT.fullmatch, self._names()) if m), default=0)

    def _versions(self, number: int | None = None) -> dict[str, dict]:
        """Paths and schema of every table, as of a commit."""
        number = self._newest() if number is None else number
        if not number:
            return {}
        return json.loads(self.spark.read.text(f"{self.root}/commit-{number:012}.json", wholetext=True).first()[0])

    def _now(self) -> dict[str, dict]:
        return self._versions() if self._staged is None else self._staged

    def has(self, name: str) -> bool:
        return name in self._now()

    def load(self, name: str) -> DataFrame:
        version = self._now()[name]
        read = self.spark.read.schema(T.StructType.fromJson(version["schema"]))
        # one by one: each folder has partitions of its own
        return reduce(DataFrame.unionByName, [read.parquet(f"{self.root}/{p}") for p in version["paths"]])

    @contextmanager
    def commit(self) -> Iterator[None]:
        """Publishes all saves within at once, at the end; none on an error."""
        if self._staged is not None:
            yield  # part of the commit around it
            return
        number = self._newest()
        self._staged, before = dict(old := self._versions(number)), old
        try:
            yield
            if self._staged != before:
                self._publish(number + 1, self._staged)
        finally:
            self._staged = None

    def _publish(self, number: int, versions: dict[str, dict]) -> None:
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        staged = self._path(f"staged-{uuid.uuid4().hex}")
        out = self._files().create(staged, False)
        out.write(bytearray(json.dumps(versions).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri() if staged.toUri().getScheme() else self._files().getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        # without OVERWRITE: a number that is taken raises
        context.rename(staged, self._path(f"commit-{number:012}.json"), gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))

    def save(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Replace a table; ``df`` may read its present version."""
        path = f"{name}-{uuid.uuid4().hex}"
        with self.commit():
            df.write.partitionBy(*partition_by).parquet(f"{self.root}/{path}")
            self._staged[name] = {"paths": [path], "schema": df.schema.jsonValue()}

    def append(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Add rows to a table of the same columns, without rewriting it."""
        with self.commit():
            before = self._staged.get(name)
            self.save(name, df.select(*[f["name"] for f in before["schema"]["fields"]]) if before else df, partition_by)
            if before:
                self._staged[name] = before | {"paths": before["paths"] + self._staged[name]["paths"]}

    def vacuum(self, keep: int = 1) -> None:
        """Remove what none of the ``keep`` newest commits lists.

        For times without imports and without readers of older commits.
        """
        newest = self._newest()
        kept = range(max(1, newest - keep + 1), newest + 1)
        used = {p for n in kept for v in self._versions(n).values() for p in v["paths"]} | {f"commit-{n:012}.json" for n in kept}
        for name in self._names():
            if name not in used and re.fullmatch(rf"(?:{'|'.join(TABLES)})-[0-9a-f]{{32}}|staged-.*|commit-.*", name):
                remove_folder(self.spark, f"{self.root}/{name}")


def _plain(df: DataFrame) -> DataFrame:
    """Without the parsed node that imports carry along."""
    return df.drop("body")


def import_into(archive: Archive, raw: DataFrame, platform: str, assume_immutable: bool = False, incremental: bool = False) -> dict[str, int]:
    """Import conversations; the archive's tables are brought up to date at once.

    Conversations that can't be read are counted as failed and don't keep the
    others out. Returns the counters.
    """
    with scratch(archive.spark):
        return _import(archive, raw, platform, assume_immutable, incremental)


def _import(archive: Archive, raw: DataFrame, platform: str, assume_immutable: bool, incremental: bool) -> dict[str, int]:
    tables = exports.import_export(raw, platform, materialize)
    now = F.current_timestamp()
    incoming = _plain(tables["messages"]).withColumn("deleted_at", F.lit(None).cast("timestamp"))
    stored_d = archive.load("dialogues") if archive.has("dialogues") else tables["dialogues"].limit(0)
    stored_m = archive.load("messages") if archive.has("messages") else incoming.limit(0)
    of_dialogue = sync.dialogue_actions(stored_d, tables["dialogues"])
    of_dialogue = materialize(of_dialogue, "dialogues")
    of_message = materialize(sync.message_actions(stored_m, incoming, of_dialogue, assume_immutable, incremental), "actions")
    counts = {r["counter"]: r["n"] for r in sync.import_counts(of_dialogue, of_message, tables["rejected"]).collect()}
    if not (counts["dialogues_new"] or counts["dialogues_updated"]):
        return counts
    taken = of_dialogue.where("action <> 'skipped'").drop("action")
    messages = sync.apply_messages(stored_m, incoming, of_message, now, assume_immutable)
    renewed = of_message.where("action in ('new', 'updated')" if assume_immutable else "action in ('new', 'updated', 'restored')")
    changed = materialize(incoming.join(renewed, ["dialogue_id", "source_id"], "left_semi").select(F.col("id").alias("message_id")), "changed")
    with archive.commit():
        # rows of messages that stay as they are stay too, whatever the export says of them
        new = {name: _plain(tables[name]).join(changed, key, "left_semi") for name, key in CHILDREN.items()}

        def child(name: str) -> None:
            old = archive.load(name) if archive.has(name) else new[name].limit(0)
            archive.save(name, sync.replace_children(old, new[name], changed, CHILDREN[name]))

        def grandchild(name: str) -> None:
            parent, key = GRANDCHILDREN[name]
            parents = new[parent].select(F.col("id").alias(key))
            fresh = tables[name].join(parents, key, "left_semi")
            old = archive.load(name) if archive.has(name) else fresh.limit(0)
            archive.save(name, sync.live_children(old.join(parents, key, "left_anti").unionByName(fresh), archive.load(parent), key))

        def marks() -> None:
            entities = changed.select(F.lit("message").alias("entity_type"), F.col("message_id").alias("entity_id")).union(new["content_parts"].select(F.lit("content_part"), F.col("id")))
            found = tables["annotations"].join(entities, ["entity_type", "entity_id"], "left_semi")
            found = found.select("entity_type", "entity_id", "key", "value_type", "value", F.lit(1.0).alias("confidence"), F.lit("imported").alias("reason"), F.lit("ingestion").alias("source"), F.lit("1.0").alias("source_version"), F.lit(None).cast("timestamp").alias("created_at"))
            store = archive.load("annotations") if archive.has("annotations") else annotations.empty_store(archive.spark)
            archive.save("annotations", annotations.write(store, found), ("entity_type", "value_type"))

        dialogues = stored_d.join(taken.select("id"), "id", "left_anti").unionByName(taken.select(*stored_d.columns))
        first = [partial(child, name) for name in CHILDREN] + [partial(archive.save, "messages", messages), partial(archive.save, "dialogues", dialogues), marks]
        # independent tables are written side by side; the second wave reads the first
        for wave in (first, [partial(grandchild, name) for name in GRANDCHILDREN]):
            with ThreadPoolExecutor(WRITERS) as pool:
                list(pool.map(lambda task: task(), wave))
    return counts


def build_pairs(archive: Archive) -> None:
    """Rebuild all prompt-response pairs and their contents."""
    with scratch(archive.spark), archive.commit():
        archive.save("prompt_responses", pairs.build_pairs(archive.load("messages")))
        archive.save("prompt_response_content", pairs.pair_content(archive.load("prompt_responses"), archive.load("content_parts")))


def annotate(archive: Archive) -> None:
    """Run both registries over all pairs and content parts.

    The rows they add are appended; neither registry writes json, which would
    have to be replaced.
    """
    store = archive.load("annotations") if archive.has("annotations") else annotations.empty_store(archive.spark)
    rows = views.pair_content_view(archive.load("prompt_responses"), archive.load("prompt_response_content"))
    with scratch(archive.spark):
        added = annotators.registry_rows(rows, store, annotators.PAIR_ANNOTATORS)
        added = added.unionByName(annotators.registry_rows(annotators.part_rows(archive.load("content_parts"), archive.load("messages")), store, annotators.PART_ANNOTATORS))
        archive.append("annotations", added, ("entity_type", "value_type"))


def stats(archive: Archive) -> DataFrame:
    return views.archive_stats(archive.load("dialogues"), archive.load("messages"), archive.load("prompt_responses"), archive.load("annotations"))


def run(archive: Archive, inputs: dict[str, str], assume_immutable: bool = False, incremental: bool = False) -> DataFrame:
    """Import the exports of each platform, build, annotate, report."""
    archive.init()
    for platform, path in inputs.items():
        import_into(archive, exports.read_export(archive.spark, path), platform, assume_immutable, incremental)
    build_pairs(archive)
    annotate(archive)
    return stats(archive)
