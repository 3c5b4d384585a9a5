"""Facets and tags of annotated conversations.

Annotations are rows (dialogue_id, name, attribute, value, number); attribute
is NULL for plain flags, whose value is ``true``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Comparisons of a tag's attribute.
COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "in": lambda c, v: c.isin(*v),
}


def facet_values(dialogues: DataFrame, annotations: DataFrame, name: str, attribute: str | None = None) -> DataFrame:
    """dialogue_id and facet of every dialogue.

    <none> without the annotation, has_NAME for a flag, the attribute's value,
    or <NAME_no_ATTRIBUTE>. Of several values the sorted ones joined by '; '.
    """
    mine = annotations.where(F.col("name") == name)
    if attribute is None:
        value = F.when(F.col("attribute").isNull() & (F.col("value") == "true"), f"has_{name}").otherwise(F.col("value"))
    else:
        value = F.when(F.col("attribute") == attribute, F.col("value"))
    grouped = mine.groupBy("dialogue_id").agg(F.array_join(F.array_sort(F.collect_set(value)), "; ").alias("facet"))
    missing = f"<{name}_no_{attribute}>"
    grouped = grouped.withColumn("facet", F.when(F.col("facet") == "", missing).otherwise(F.col("facet")))
    return dialogues.select("dialogue_id").distinct().join(grouped, "dialogue_id", "left").withColumn("facet", F.coalesce("facet", F.lit("<none>")))


def top_facets(faceted: DataFrame, max_facets: int = 50) -> DataFrame:
    """Facets relabelled: beyond the largest max_facets - 1, all are <other>.

    Facets are counted first, so only their list is ranked.
    """
    sizes = faceted.groupBy("facet").agg(F.count(F.lit(1)).alias("n"))
    # the largest ones, one more than fit: a list of bounded length, ranked by itself
    top = sizes.orderBy(F.desc("n"), "facet").limit(max_facets + 1)
    ranked = top.select("facet", F.row_number().over(Window.orderBy(F.desc("n"), "facet")).alias("rank"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n_top"))
    kept = ranked.where((F.col("n_top") <= max_facets) | (F.col("rank") < max_facets)).select("facet", F.col("facet").alias("label"))
    return faceted.join(F.broadcast(kept), "facet", "left").select("dialogue_id", F.when(F.col("label").isNull(), "<other>").otherwise(F.col("label")).alias("facet"))


def facet_sizes(faceted: DataFrame) -> DataFrame:
    """Dialogues of each facet and their share of all, in percent."""
    total = faceted.agg(F.count(F.lit(1)).alias("__all"))
    return faceted.groupBy("facet").agg(F.count(F.lit(1)).alias("n_dialogues")).join(F.broadcast(total)).select("facet", "n_dialogues", F.round(100.0 * F.col("n_dialogues") / F.col("__all"), 1).alias("share"))


def faceted_summary(faceted: DataFrame, annotations: DataFrame) -> DataFrame:
    """Per facet and annotation: dialogues, share, statistics of attributes.

    A flag counts as the number 1 under the attribute ``value``.
    """
    rows = faceted.join(annotations, "dialogue_id")
    sizes = faceted.groupBy("facet").agg(F.count(F.lit(1)).alias("facet_size"))
    named = rows.groupBy("facet", "name").agg(F.countDistinct("dialogue_id").alias("n_dialogues"))
    stats = rows.groupBy("facet", "name", F.coalesce("attribute", F.lit("value")).alias("attribute")).agg(
        F.round(F.avg("number"), 1).alias("average"), F.min("number").alias("least"), F.max("number").alias("most"), F.countDistinct(F.when(F.col("number").isNull(), F.col("value"))).alias("n_values")
    )
    share = F.round(100.0 * F.col("n_dialogues") / F.col("facet_size"), 1)
    return named.join(sizes, "facet").withColumn("share", share).join(stats, ["facet", "name"])


def tag_matches(name: str, **conditions: object) -> Column:
    """Predicate on annotation rows; conditions as attribute__op=value."""
    test = F.col("name") == name
    for spec, value in conditions.items():
        attribute, _, op = spec.partition("__")
        number = isinstance(value, (int, float)) or (op == "in" and all(isinstance(v, (int, float)) for v in value))
        test = test & (F.col("attribute") == attribute) & COMPARE[op or "eq"](F.col("number") if number else F.col("value"), value)
    return test


def filter_by_tags(dialogues: DataFrame, annotations: DataFrame, include: list[Column] = (), exclude: list[Column] = ()) -> DataFrame:
    """Dialogues that match all of ``include`` and none of ``exclude``.

    All predicates are counted in one pass over the annotations.
    """
    tests = [F.bool_or(c).alias(f"__in{i}") for i, c in enumerate(include)] + [F.bool_or(c).alias(f"__out{i}") for i, c in enumerate(exclude)]
    if not tests:
        return dialogues
    found = annotations.groupBy("dialogue_id").agg(*tests)
    keep = F.lit(True)
    for i in range(len(include)):
        keep = keep & F.coalesce(F.col(f"__in{i}"), F.lit(False))
    for i in range(len(exclude)):
        keep = keep & ~F.coalesce(F.col(f"__out{i}"), F.lit(False))
    return dialogues.join(found, "dialogue_id", "left").where(keep).drop(*[c for c in found.columns if c.startswith("__")])


def tag_values(annotations: DataFrame, name: str, attribute: str) -> DataFrame:
    """Distinct values of a tag's attribute."""
    return annotations.where((F.col("name") == name) & (F.col("attribute") == attribute)).select("value").distinct()


def tag_table(annotations: DataFrame) -> DataFrame:
    """One row per dialogue with the base tags the derived ones need."""
    n = lambda name: F.coalesce(F.bool_or(F.col("name") == name), F.lit(False))
    attr = lambda name, a: F.max(F.when((F.col("name") == name) & (F.col("attribute") == a), F.col("value")))
    names = {
        "code_blocks": "has_code_blocks", "script_headers": "has_script_headers", "code_structure_patterns": "has_code_structure_patterns", "function_definitions": "has_function_definitions", "import_statements": "has_import_statements",
        "high_keyword_density": "has_high_keyword_density", "code_patterns": "has_code_patterns", "large_content": "has_large_content", "github_context": "has_github_repos", "canvas_operations": "has_canvas_operations", "web_search": "has_web_search",
        "reasoning": "has_reasoning_thoughts", "code_execution": "has_code_execution", "starts_large_content": "first_user_has_large_content", "starts_code_patterns": "first_user_has_code_patterns", "starts_with_attachments": "first_user_has_attachments",
        "starts_code_attachments": "first_user_has_code_attachments", "gizmo": "gizmo", "plugin": "plugin",
    }
    return annotations.groupBy("dialogue_id").agg(
        *[n(of).alias(tag) for tag, of in names.items()],
        attr("conversation_length", "category").alias("length"),
        attr("conversation_length", "exchange_count").cast("int").alias("n_exchanges"),
        attr("prompt_stats", "length_category").alias("prompt_length"),
        attr("prompt_stats", "consistency").alias("consistency"),
    )


def derived_tags() -> list[tuple[str, Column]]:
    """Tags that follow from base tags, in an order that needs one pass."""
    c = F.col
    one = lambda *names: sum((c(x).cast("int") for x in names), F.lit(0))
    brief, extended = c("length").isin("single", "short"), c("length").isin("long", "very_long")
    starts = c("starts_large_content") | c("starts_with_attachments")
    return [
        ("strong_code_evidence", c("code_blocks") | c("script_headers") | c("code_structure_patterns")),
        ("moderate_code_evidence", c("function_definitions") | c("import_statements")),
        ("weak_code_evidence", c("high_keyword_density") & ~c("strong_code_evidence") & ~c("moderate_code_evidence")),
        ("likely_coding_assistance", c("strong_code_evidence") | (c("moderate_code_evidence") & (c("github_context") | c("code_execution"))) | (one("function_definitions", "import_statements", "code_structure_patterns") >= 2)),
        ("conservative_coding_assistance", c("strong_code_evidence") | c("github_context") | c("code_execution")),
        ("coding_assistance", c("code_patterns") | c("github_context") | c("code_execution")),
        ("coding_assistance_start", starts | c("starts_code_patterns") | c("starts_code_attachments")),
        ("research_session", c("web_search") & c("large_content")),
        ("complex_analysis", c("reasoning") & (one("web_search", "large_content", "canvas_operations") >= 2)),
        ("context_heavy_start", starts),
        ("enhanced_conversation", c("gizmo") | c("plugin")),
        ("brief_interaction", brief),
        ("extended_conversation", extended),
        ("long_prompts", c("prompt_length").isin("long", "very_long")),
        ("short_prompts", c("prompt_length").isin("very_short", "short")),
        ("consistent_prompts", c("consistency") == "consistent"),
        ("variable_prompts", c("consistency") == "variable"),
        ("context_dump", brief & starts),
        ("interactive_session", (c("n_exchanges") >= 5) & (c("consistency") == "consistent")),
        ("evolving_discussion", (c("n_exchanges") >= 5) & (c("consistency") == "variable")),
    ]


def with_derived_tags(tags: DataFrame, rules: list[tuple[str, Column]] | None = None, passes: int = 5) -> DataFrame:
    """The tag table with derived tags; NULL conditions are false.

    The built-in rules name only tags before them, so one pass is their
    fixpoint. Own ``rules`` may name any tag: all are applied ``passes`` times,
    a tag that holds once holds from then on.
    """
    if rules is None:
        for name, rule in derived_tags():
            tags = tags.withColumn(name, F.coalesce(rule, F.lit(False)))
        return tags
    for name, _ in rules:
        if name not in tags.columns:
            tags = tags.withColumn(name, F.lit(False))
    for _ in range(passes if len(rules) > 1 else 1):
        tags = tags.withColumns({name: F.col(name) | F.coalesce(rule, F.lit(False)) for name, rule in rules})
    return tags


def tag_rows(tags: DataFrame) -> DataFrame:
    """dialogue_id and tag of every tag that holds."""
    names = [c for c, kind in tags.dtypes if kind == "boolean"]
    return tags.select("dialogue_id", F.explode(F.array_compact(F.array(*[F.when(F.col(c), c) for c in names]))).alias("tag"))


def tag_summary(tagged: DataFrame, dialogues: DataFrame) -> DataFrame:
    """Dialogues per tag and their share of all."""
    total = dialogues.agg(F.count(F.lit(1)).alias("__all"))
    return tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("n_dialogues")).join(F.broadcast(total)).select("tag", "n_dialogues", F.round(100.0 * F.col("n_dialogues") / F.col("__all"), 1).alias("share"))


def compare_facets(faceted: DataFrame, tagged: DataFrame, least_size: int = 10, top_tags: int = 10, spread: float = 20.0) -> DataFrame:
    """Common tags whose share differs by more than ``spread`` points."""
    sizes = faceted.groupBy("facet").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least_size)
    common = tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(top_tags).select("tag")
    counts = faceted.join(tagged, "dialogue_id").groupBy("facet", "tag").agg(F.count(F.lit(1)).alias("n"))
    # every common tag in every large facet: two short lists
    grid = sizes.join(F.broadcast(common), F.lit(True))
    shares = grid.join(counts, ["facet", "tag"], "left").select("tag", (100.0 * F.coalesce("n", F.lit(0)) / F.col("size")).alias("share"))
    return shares.groupBy("tag").agg(F.round(F.min("share"), 1).alias("least"), F.round(F.max("share"), 1).alias("most"), F.max("share").alias("__hi"), F.min("share").alias("__lo")).where(F.col("__hi") - F.col("__lo") > spread).select("tag", "least", "most")


def distribution_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tag counts of two runs side by side."""
    count = lambda df, name: df.groupBy("tag").agg(F.count(F.lit(1)).alias(name))
    rows = count(before, "n_before").join(count(after, "n_after"), "tag", "full_outer")
    a, b = F.coalesce("n_before", F.lit(0)), F.coalesce("n_after", F.lit(0))
    return rows.select("tag", a.alias("n_before"), b.alias("n_after"), (b - a).alias("change"))


def code_report(tags: DataFrame) -> DataFrame:
    """Which code evidence leads to a code tag, alone or with other evidence."""
    marks = ["code_blocks", "script_headers", "code_structure_patterns", "function_definitions", "import_statements", "high_keyword_density"]
    n = sum((F.col(m).cast("int") for m in marks), F.lit(0))
    rows = tags.withColumn("__n", n).select("__n", F.explode(F.array_compact(F.array(*[F.when(F.col(m), m) for m in marks]))).alias("evidence"))
    return rows.groupBy("evidence").agg(F.count(F.lit(1)).alias("n_dialogues"), F.count(F.when(F.col("__n") == 1, 1)).alias("n_alone"))
