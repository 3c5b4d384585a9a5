"""Text classifiers that write annotations, and their runner.

An annotator is a Column expression over a row that gives an array of
annotations, so a whole registry is evaluated inside code generation. Own ones
are registered likewise; row functions in Python go through ``python_annotator``.

Pattern flags: ``d`` (only newline ends a line), ``U`` (Unicode classes), ``m``
(anchors at lines), ``s`` (dot takes newlines).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import given, occurrences, strip
from ..session import materialize
from . import annotations as store_ops
from .annotations import annotation

S = r"[\s\x1c-\x1f]"
# The patterns of the code and formula classifiers.
SHEBANG = rf"(?mdU)^#!{S}*/(?:usr/)?bin/"
SHEBANG_NAME = rf"(?mdU)^#!{S}*/(?:usr/)?bin/(?:env{S}+)?(\w+)"
C_INCLUDE = rf'(?mdU)^#include{S}*[<"]'
PY_FUNCTION = rf"(?dU)\bdef{S}+\w+{S}*\("
JS_FUNCTION = rf"(?dU)function{S}+\w+{S}*\("
ARROW_FUNCTION = rf"(?dU)const{S}+\w+{S}*={S}*\([^)]*\){S}*=>"
PY_IMPORT = rf"(?mdU)^(?:import|from){S}+\w+"
JS_REQUIRE = rf"(?mdU)^(?:const|let|var){S}+.*={S}*require{S}*\("
PHP = r"(?i)<\?php"
CODE_BLOCK = r"(?U)```(\w*)\n?[\s\S]*?```"
DISPLAY_MATH = r"(?s)\$\$.+?\$\$|\\\[.+?\\\]"
INLINE_MATH = r"(?d)(?<!\$)\$(?!\$).+?(?<!\$)\$(?!\$)"
LATEX_COMMAND = r"\\(?:frac|sum|int|prod|lim|sqrt|begin|end|alpha|beta|gamma|delta|epsilon|theta|lambda|sigma|omega|pi|infty|partial|nabla|mathbb|mathcal|mathbf|mathrm|text|left|right|cdot|times|div)"
WIKI_LINK = r"\[\[([^\]]+)\]\]"


@dataclass(frozen=True)
class Annotator:
    """What an annotator reads, needs, and finds."""

    name: str
    priority: int
    find: Callable[[], Column]
    entity: str = "prompt_response"
    part_type: str | None = None
    role: str | None = "assistant"
    requires_flags: tuple = ()
    requires_strings: tuple = ()
    skip_flags: tuple = ()
    skip_strings: tuple = ()
    version: str = "1.0"
    #: Keys it may write; None where that isn't known.
    writes: tuple[str, ...] | None = None


def _array(*items: Column) -> Column:
    return F.array(*items)


def _evidence(tests: dict[str, Column]) -> Column:
    """Names of the tests that hold, sorted."""
    return F.filter(F.array(*[F.when(test, name) for name, test in sorted(tests.items())]), lambda x: x.isNotNull())


def _each(key: str, values: Column, reason: str | None = None) -> Column:
    return F.transform(values, lambda v: annotation(key, "string", v, None, reason))


def wiki_candidate() -> Column:
    n = occurrences(F.col("response_text"), "[[")
    return F.when(n >= 1, _array(annotation("exchange_type", "string", F.lit("wiki_article"), F.when(n >= 3, 0.95).otherwise(0.8), "wiki_links_detected"), annotation("wiki_link_count", "numeric", n, 1.0, "counted")))


def naive_title() -> Column:
    first = strip(F.split_part(strip(F.col("response_text")), F.lit("\n"), F.lit(1)))
    header = F.when(first.startswith("#"), given(strip(F.regexp_replace(first, r"\A#+", ""))))
    bold = F.when(first.startswith("**") & first.endswith("**"), given(strip(F.regexp_replace(first, r"\A\*+|\*+\z", ""))))
    prefix = F.when(first.startswith("**"), given(strip(F.regexp_extract(first, r"(?s)\A\*\*(.*?)\*\*", 1))))
    title = F.coalesce(header, bold, prefix)
    reason = F.when(header.isNotNull(), "markdown_header").when(bold.isNotNull(), "bold_header").otherwise("bold_header_with_suffix")
    return F.when(title.isNotNull(), _array(annotation("proposed_title", "string", title, 0.8, reason)))


def has_code() -> Column:
    t = F.col("response_text")
    found = _evidence(
        {
            "code_block": t.contains("```"),
            "shebang": t.rlike(SHEBANG),
            "c_include": t.rlike(C_INCLUDE),
            "python_function": t.rlike(PY_FUNCTION),
            "js_function": t.rlike(JS_FUNCTION),
            "arrow_function": t.rlike(ARROW_FUNCTION),
            "python_import": t.rlike(PY_IMPORT),
            "js_require": t.rlike(JS_REQUIRE),
        }
    )
    strong = F.arrays_overlap(found, F.array(F.lit("code_block"), F.lit("shebang"), F.lit("c_include")))
    flag = annotation("has_code", "flag", None, F.when(strong, 0.95).otherwise(0.75), F.array_join(found, ","))
    return F.when(F.size(found) > 0, F.concat(F.array(flag), _each("code_evidence", found)))


def _latex(text: str, reason: str) -> Column:
    t = F.col(text)
    found = _evidence({"display": t.rlike(DISPLAY_MATH), "inline": t.rlike(INLINE_MATH), "commands": t.rlike(LATEX_COMMAND)})
    flag = annotation("has_latex", "flag", None, F.when(F.array_contains(found, "display"), 0.95).otherwise(0.8), reason)
    return F.when(F.size(found) > 0, F.concat(F.array(flag), _each("latex_type", found)))


def code_blocks() -> Column:
    blocks = F.regexp_extract_all("text_content", F.lit(CODE_BLOCK), 1)
    languages = F.array_sort(F.array_distinct(F.filter(F.transform(blocks, F.lower), lambda x: x != "")))
    head = _array(annotation("has_code_block", "flag", None, 1.0, "markdown_code_block"), annotation("code_block_count", "numeric", F.size(blocks)))
    return F.when(F.size(blocks) > 0, F.concat(head, _each("code_language", languages, "code_block_language_spec")))


def script_header() -> Column:
    t = F.col("text_content")
    shebang = given(F.regexp_extract(t, SHEBANG_NAME, 1))
    kind = F.when(shebang.isNotNull(), shebang).when(t.rlike(C_INCLUDE), "c").when(t.rlike(PHP), "php")
    reason = F.when(shebang.isNotNull(), "shebang").when(t.rlike(C_INCLUDE), "c_include").otherwise("php_tag")
    why = F.when(shebang.isNotNull(), "shebang_interpreter")
    return F.when(kind.isNotNull(), _array(annotation("has_script_header", "flag", None, 1.0, reason), annotation("script_type", "string", kind, None, why)))


def wiki_links() -> Column:
    n = F.regexp_count("text_content", F.lit(WIKI_LINK))
    return F.when(n > 0, _array(annotation("has_wiki_links", "flag", None, 1.0, "wiki_links_detected"), annotation("wiki_link_count", "numeric", n)))


# Names, priorities and prerequisites of the classifiers; in the
# functions above, their keys, confidences and reasons.
PAIR_ANNOTATORS = [
    Annotator("wiki_candidate", 60, wiki_candidate, writes=("exchange_type", "wiki_link_count")),
    Annotator("has_code", 55, has_code, skip_flags=("has_code",), writes=("has_code", "code_evidence")),
    Annotator("has_latex", 54, lambda: _latex("response_text", "latex_detected"), skip_flags=("has_latex",), writes=("has_latex", "latex_type")),
    Annotator("naive_title", 50, naive_title, requires_strings=(("exchange_type", "wiki_article"),), writes=("proposed_title",)),
]
PART_ANNOTATORS = [
    Annotator("code_block", 90, code_blocks, "content_part", "text", writes=("has_code_block", "code_block_count", "code_language")),
    Annotator("script_header", 85, script_header, "content_part", "text", None, writes=("has_script_header", "script_type")),
    Annotator("wiki_link", 75, wiki_links, "content_part", "text", writes=("has_wiki_links", "wiki_link_count")),
    Annotator("latex", 70, lambda: _latex("text_content", "latex_notation_detected"), "content_part", "text", writes=("has_latex", "latex_type")),
]


def annotate(rows: DataFrame, annotator: Annotator, store: DataFrame | None = None) -> DataFrame:
    """Annotation rows of one annotator.

    ``rows`` has prompt_response_id, response_role and texts, or
    content_part_id, role, part_type and text_content. With a ``store`` the
    annotator's prerequisites apply.
    """
    entity_id = f"{annotator.entity}_id"
    if annotator.role:
        rows = rows.where(F.col("response_role" if annotator.entity == "prompt_response" else "role") == annotator.role)
    if annotator.part_type:
        rows = rows.where(F.col("part_type") == annotator.part_type)
    if store is not None:
        rows = store_ops.required(rows, store, annotator.entity, entity_id, annotator.requires_flags, annotator.requires_strings)
        rows = store_ops.skipped(rows, store, annotator.entity, entity_id, annotator.skip_flags, annotator.skip_strings)
    return store_ops.rows_of(rows, annotator.entity, entity_id, annotator.find(), version=annotator.version)


def _needs(annotator: Annotator) -> dict[tuple[str, str | None, bool], bool]:
    """Prerequisites (key, value, is a flag) and whether each must hold."""
    strings = lambda xs: [(x, None, False) if isinstance(x, str) else (x[0], x[1] if len(x) > 1 else None, False) for x in xs]
    must = [(k, None, True) for k in annotator.requires_flags] + strings(annotator.requires_strings)
    mustnt = [(k, None, True) for k in annotator.skip_flags] + strings(annotator.skip_strings)
    return {n: True for n in must} | {n: False for n in mustnt}


def stages(registry: Iterable[Annotator]) -> list[list[Annotator]]:
    """Annotators by priority, those that don't touch each other together.

    One that reads, or writes, what an earlier one of the stage may have
    written opens a new stage.
    """
    out: list[list[Annotator]] = []
    for annotator in sorted(registry, key=lambda a: -a.priority):
        touched = {k for k, _, _ in _needs(annotator)} | set(annotator.writes or ())
        last = out[-1] if out else []
        free = last and annotator.writes is not None and annotator.entity == last[0].entity and all(a.writes is not None and not touched & set(a.writes) for a in last)
        if free:
            last.append(annotator)
        else:
            out.append([annotator])
    return out


def _versioned(found: Column, version: str) -> Column:
    """Annotation structs with their source's version; none for NULL."""
    items = F.filter(found, lambda x: x.isNotNull())
    columns = ("key", "value_type", "value", "confidence", "reason")
    return F.coalesce(F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in columns], F.lit(version).alias("source_version"))), F.array())


def annotate_stage(rows: DataFrame, stage: list[Annotator], store: DataFrame) -> DataFrame:
    """Annotation rows of one stage, in one pass over ``rows``.

    Prerequisites of all its annotators are read from the store by one
    aggregation and one join, and only if there are any.
    """
    entity, entity_id = stage[0].entity, f"{stage[0].entity}_id"
    role = F.col("response_role" if entity == "prompt_response" else "role")
    needs = sorted({n for a in stage for n in _needs(a)}, key=str)
    if needs:
        test = lambda k, v, flag: (F.col("key") == k) & (F.col("value_type") == ("flag" if flag else "string")) & (F.lit(True) if v is None else F.col("value") == v)
        of = store.where((F.col("entity_type") == entity) & F.col("key").isin(*{n[0] for n in needs}))
        held = of.groupBy(F.col("entity_id").alias(entity_id)).agg(*[F.coalesce(F.bool_or(test(*n)), F.lit(False)).alias(f"__n{i}") for i, n in enumerate(needs)])
        rows = rows.join(held, entity_id, "left")
    found, wanted = [], F.lit(False)
    for a in stage:
        here = F.lit(True)
        if a.role:
            here = here & (role == a.role)
        if a.part_type:
            here = here & (F.col("part_type") == a.part_type)
        wanted = wanted | here
        for n, must in _needs(a).items():
            has = F.coalesce(F.col(f"__n{needs.index(n)}"), F.lit(False))
            here = here & (has if must else ~has)
        found.append(_versioned(F.when(here, a.find()), a.version))
    listed = rows.where(wanted).select(F.col(entity_id).alias("entity_id"), F.explode(F.concat(*found)).alias("a"))
    return listed.select(F.lit(entity).alias("entity_type"), "entity_id", "a.key", "a.value_type", "a.value", "a.confidence", "a.reason", F.lit("heuristic").alias("source"), "a.source_version", F.lit(None).cast("timestamp").alias("created_at"))


def registry_rows(rows: DataFrame, store: DataFrame, registry: Iterable[Annotator]) -> DataFrame:
    """The rows all annotators add to the store, higher priorities first.

    An annotator sees what those before it wrote. The texts are read once a
    stage; the store is only read.
    """
    out = None
    for stage in stages(registry):
        known = store if out is None else store.unionByName(out)
        # written out, so that later prerequisites don't repeat this scan of the texts
        new = materialize(store_ops.created(known, annotate_stage(rows, stage, known)), "found")
        out = new if out is None else out.unionByName(new)
    return store.limit(0) if out is None else out


def run_registry(rows: DataFrame, store: DataFrame, registry: Iterable[Annotator]) -> DataFrame:
    """The store after all annotators: its rows and the added ones."""
    return store_ops.extend(store, registry_rows(rows, store, registry))


def python_annotator(rows: DataFrame, entity_type: str, function: Callable[[dict], list[dict]]) -> DataFrame:
    """Annotations from a Python function of a row, batched by Arrow.

    ``function`` gets the row as a dict and gives dicts with key, value_type
    and optionally value, confidence and reason.
    """
    entity_id = f"{entity_type}_id"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(r[entity_id], a["key"], a["value_type"], None if a.get("value") is None else str(a["value"]), a.get("confidence"), a.get("reason")) for r in b.to_pylist() for a in function(r) or []]
            cols = list(zip(*out)) or [[]] * 6
            kinds = [pa.string()] * 4 + [pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["entity_id", "key", "value_type", "value", "confidence", "reason"])

    found = rows.mapInArrow(run, "entity_id string, key string, value_type string, value string, confidence double, reason string")
    return found.select(F.lit(entity_type).alias("entity_type"), "entity_id", "key", "value_type", "value", "confidence", "reason", F.lit("python").alias("source"), F.lit("1.0").alias("source_version"), F.lit(None).cast("timestamp").alias("created_at"))


def part_rows(parts: DataFrame, messages: DataFrame) -> DataFrame:
    """Content parts of live messages with the message's role."""
    of = messages.where("deleted_at is null").select(F.col("id").alias("message_id"), "role", "created_at")
    return parts.select(F.col("id").alias("content_part_id"), "message_id", "dialogue_id", "sequence", "part_type", "text_content", "language").join(of, "message_id")
