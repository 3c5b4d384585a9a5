"""Exchanges: user-assistant dyads, merged where a prompt continues them.

Messages stream through the chunker in order with a pair of messages as its
only state, so a dialogue of any length takes constant memory. Rules are
boolean columns of messages folded by ``bool_or``; texts are never collected
but where they are the result.

Input: dialogue_id, message_id, role, created_at, text, and metadata (variant,
may be NULL). Defined results: messages without a role of user or assistant
belong to no exchange; NULL texts count as empty; NULL times sort first, then
by id; a dialogue without such messages gives no exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import given, occurrences, row_key, strip, truthy

# Prompts that continue, and beginnings of short ones.
CONTINUATIONS = ("continue", "more", "keep going", "go on", "next", "tell me more", "expand", "keep writing", "finish")
STARTERS = CONTINUATIONS + ("elaborate", "do go on", "make it so", "yes", "please", "do it")
# Marks of code, formulas and errors in texts.
SCRIPT_MARKS = ("#!/bin/", "#include", "using namespace")
CODE_MARKS = ("```", "def ", "function ", "class ", "import ", "from ", "require(", "#!/bin/", "#include")
LATEX_MARKS = ("\\frac", "\\sum", "\\int", "\\sqrt", "\\alpha", "\\beta", "\\gamma", "\\theta", "\\pi", "\\sigma", "\\infty", "\\partial", "\\nabla")
DENSITY_WORDS = ("function", "class", "import", "def ", "const ", "let ", "var ", "return", "if ", "for ", "while ")
ERROR_MARKS = ("error:", "traceback", "exception:", "failed:", "cannot", "not working", "broken", "issue", "problem", "bug", "crash", "threw an error")
CODE_ENDINGS = (".py", ".js", ".java", ".cpp", ".c", ".go", ".rs", ".ts", ".jsx", ".tsx", ".sql", ".sh", ".rb", ".php")
CODE_MIMES = ("text/x-python", "text/x-java", "application/javascript", "text/x-script")
FEATURES = ("has_github_repos", "has_canvas_operations", "has_web_search", "has_reasoning_thoughts", "has_code_execution", "has_code_blocks", "has_script_headers", "has_code_structure_patterns", "has_wiki_links", "has_latex_math", "user_has_attachments")


def platform_text(node: Column) -> Column:
    """The text of a message as its platform's exchange reader has it.

    A node with a sender is of the list platform: its ``text`` as it is. Else
    ``content.text`` and the plain parts, joined by blanks and stripped; parts
    that are no text don't count. Never NULL.
    """
    parts = F.coalesce(F.try_variant_get(node, "$.content.parts", "array<variant>"), F.array().cast("array<variant>"))
    plain = F.transform(F.filter(parts, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    joined = strip(F.array_join(plain, " "))
    own = F.coalesce(F.try_variant_get(node, "$.content.text", "string"), F.lit(""))
    tree = strip(F.when(joined == "", own).otherwise(F.concat(own, F.lit(" "), joined)))
    return F.coalesce(F.when(F.try_variant_get(node, "$.sender", "string").isNotNull(), F.coalesce(F.try_variant_get(node, "$.text", "string"), F.lit(""))).otherwise(tree), F.lit(""))


def any_of(text: Column, marks: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for mark in marks:
        test = test | text.contains(mark)
    return test


def quote_elaborate(text: Column) -> Column:
    """A quotation whose last line asks to elaborate."""
    last = F.lower(strip(F.element_at(F.split(text, "\n"), -1)))
    return text.startswith(">") & text.contains("\n") & (last == "elaborate")


def is_continuation(text: Column) -> Column:
    words = F.size(F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != ""))
    starts = F.lit(False)
    for s in STARTERS:
        starts = starts | text.startswith(s)
    return quote_elaborate(text) | text.isin(*CONTINUATIONS) | ((words <= 3) & starts)


def chunk(messages: DataFrame) -> DataFrame:
    """Messages with the number of their dyad in the dialogue.

    A dyad closes at [user, assistant], otherwise at three messages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dialogue, number, held = None, 0, []
        for b in batches:
            out = []
            for d, role in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if d != dialogue:
                    dialogue, number, held = d, 0, []
                out.append(number)
                held.append(role)
                if held == ["user", "assistant"] or len(held) > 2:
                    number, held = number + 1, []
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(out, pa.int32())], ["message_id", "dyad"])

    turns = messages.where(F.col("role").isin("user", "assistant"))
    order = turns.select("dialogue_id", "role", "message_id", "created_at").repartition("dialogue_id").sortWithinPartitions("dialogue_id", F.col("created_at").asc_nulls_first(), "message_id")
    numbered = order.select("dialogue_id", "role", "message_id").mapInArrow(run, "message_id string, dyad int")
    return turns.join(numbered, "message_id")


def merge(chunked: DataFrame) -> DataFrame:
    """Messages with their exchange: dyads that continue join the one before."""
    text = F.coalesce("text", F.lit(""))
    first = F.min_by(F.when(F.col("role") == "user", text), F.when(F.col("role") == "user", F.struct("created_at", "message_id")))
    dyads = chunked.groupBy("dialogue_id", "dyad").agg(first.alias("first_text"))
    w = Window.partitionBy("dialogue_id").orderBy("dyad")
    starts = F.when((F.col("dyad") == 0) | ~F.coalesce(is_continuation(F.col("first_text")), F.lit(False)), 1).otherwise(0)
    numbered = dyads.withColumn("exchange", (F.sum(starts).over(w) - 1).cast("int")).select("dialogue_id", "dyad", "exchange")
    return chunked.join(numbered, ["dialogue_id", "dyad"])


def exchanges(merged: DataFrame) -> DataFrame:
    """One row per exchange: ids, times, counts and texts of both sides."""
    at = F.struct("created_at", "message_id")
    side = lambda role: F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("created_at", "message_id", F.coalesce("text", F.lit("")).alias("text"))))), lambda x: x["text"])
    rows = merged.groupBy("dialogue_id", "exchange").agg(
        F.transform(F.array_sort(F.collect_list(at)), lambda x: x["message_id"]).alias("message_ids"),
        side("user").alias("user_texts"),
        side("assistant").alias("assistant_texts"),
        F.min("created_at").alias("first_time"),
        F.max("created_at").alias("last_time"),
        F.count(F.when(F.col("role") == "user", 1)).alias("n_user"),
        F.count(F.when(F.col("role") == "assistant", 1)).alias("n_assistant"),
        F.countDistinct("dyad").alias("n_dyads"),
    )
    return rows.withColumn("exchange_id", row_key(F.element_at("message_ids", -1))).withColumn("has_continuations", F.col("n_user") > 1)


def code_structure(text: Column) -> Column:
    """Marks of code that stand together."""
    has = text.contains
    return (
        (has("def ") & has("(") & has(":") & has("return"))
        | (has("class ") & has("(") & has(":") & has("def "))
        | ((has("function(") | has("function ")) & has("{") & has("}"))
        | ((occurrences(text, "=") >= 3) & (has("let ") | has("const ") | has("var ")))
    )


def latex_math(text: Column) -> Column:
    return text.rlike(r"\$\$.+?\$\$|\\\(.+?\\\)|\\\[.+?\\\]") | any_of(text, LATEX_MARKS)


def title_of(text: Column) -> Column:
    """Title in the first line: a heading without its #, or bold text."""
    top = F.split_part(strip(text), F.lit("\n"), F.lit(1))
    return F.when(top.startswith("#"), strip(F.replace(top, F.lit("#"), F.lit("")))).when(top.startswith("**") & top.endswith("**"), strip(F.replace(top, F.lit("**"), F.lit(""))))


def _rules() -> dict[str, Column]:
    """Rules that hold for an exchange if they hold for one of its messages."""
    text, meta = F.coalesce("text", F.lit("")), F.col("metadata")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    path = lambda *paths: F.greatest(*[F.coalesce(truthy(meta, p), F.lit(False)) for p in paths], F.lit(False))
    return {
        "has_github_repos": path("$.metadata.selected_github_repos"),
        "has_canvas_operations": path("$.metadata.canvas"),
        "has_web_search": path("$.metadata.search_queries", "$.metadata.search_result_groups", "$.metadata.content_references"),
        "has_reasoning_thoughts": path("$.content.thoughts"),
        "has_code_execution": path("$.metadata.aggregate_result", "$.metadata.jupyter_messages"),
        "has_code_blocks": text.contains("```"),
        "has_script_headers": any_of(text, SCRIPT_MARKS),
        "has_code_structure_patterns": code_structure(text),
        "user_has_quote_elaborate": user & quote_elaborate(text),
        "user_has_attachments": user & path("$.metadata.attachments"),
        "assistant_has_reasoning": assistant & path("$.content.thoughts"),
        "has_wiki_links": assistant & text.rlike(r"\[\[.+?\]\]"),
        "has_latex_math": assistant & latex_math(text),
        "has_large_content": F.length(text) > 2000,
        "has_function_definitions": any_of(text, ("def ", "function ", "class ")),
        "has_import_statements": any_of(text, ("import ", "from ", "require(")),
        "has_high_keyword_density": (F.length(text) > 1000) & (sum((F.when(F.lower(text).contains(w), 1).otherwise(0) for w in DENSITY_WORDS), F.lit(0)) >= 5),
        "user_has_code_blocks": user & text.contains("```"),
        "user_has_error_messages": user & any_of(F.lower(text), ERROR_MARKS),
    }


def _first_rules() -> dict[str, Column]:
    """Rules of the first user message."""
    text, meta = F.coalesce("text", F.lit("")), F.col("metadata")
    files = F.try_variant_get(meta, "$.metadata.attachments", "array<variant>")
    low = lambda x, p: F.lower(F.coalesce(F.try_variant_get(x, p, "string"), F.lit("")))
    code_file = F.exists(files, lambda x: any_of(low(x, "$.name"), CODE_ENDINGS) | any_of(low(x, "$.mime_type"), CODE_MIMES))
    return {
        "first_user_has_large_content": F.length(strip(text)) > 2000,
        "first_user_has_code_patterns": any_of(text, CODE_MARKS),
        "first_user_has_attachments": F.coalesce(truthy(meta, "$.metadata.attachments"), F.lit(False)),
        "first_user_has_code_attachments": F.coalesce(code_file, F.lit(False)),
    }


def length_category(length: Column, bounds: tuple[int, int, int, int]) -> Column:
    a, b, c, d = bounds
    return F.when(length < a, "very_short").when(length < b, "short").when(length < c, "medium").when(length < d, "long").otherwise("very_long")


def exchange_rules(merged: DataFrame) -> DataFrame:
    """One row per exchange with all rules, title, gizmos and plugins.

    A column ``source`` of the messages, the platform, becomes a rule as well.
    """
    rules, firsts = _rules(), _first_rules()
    meta, text = F.col("metadata"), F.coalesce("text", F.lit(""))
    order = F.struct("created_at", "message_id")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    of_first = F.struct(*[c.alias(n) for n, c in firsts.items()])
    plugin = lambda p: given(F.try_variant_get(meta, p, "string"))
    plugins = F.array_compact(F.array(plugin("$.metadata.invoked_plugin.plugin_id"), plugin("$.metadata.invoked_plugin.namespace")))
    low_user = F.lower(F.when(user, text))
    rows = merged.groupBy("dialogue_id", "exchange").agg(
        *[F.bool_or(c).alias(n) for n, c in rules.items()],
        F.min_by(F.when(user, of_first), F.when(user, order)).alias("__first"),
        F.min_by(F.when(assistant, title_of(text)), F.when(assistant, order)).alias("proposed_title"),
        F.array_sort(F.collect_set(given(F.try_variant_get(meta, "$.metadata.gizmo_id", "string")))).alias("gizmos"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(plugins)))).alias("plugins"),
        F.count(F.when(user, 1)).alias("n_user"),
        F.count(F.when(assistant, 1)).alias("n_assistant"),
        F.coalesce(F.sum(F.when(user, F.length(text))), F.lit(0)).alias("user_length"),
        F.coalesce(F.sum(F.when(assistant, F.length(text))), F.lit(0)).alias("assistant_length"),
        F.bool_or(text.contains("[[") | low_user.contains("write an article") | low_user.contains("create a wiki")).alias("__wiki"),
        F.bool_or(assistant & text.contains("# ")).alias("__headed"),
        *([F.max("source").alias("source")] if "source" in merged.columns else []),
    )
    rows = rows.withColumn("user_is_continuation", F.col("n_user") > 1)
    for name in firsts:
        rows = rows.withColumn(name, F.coalesce(F.col(f"__first.{name}"), F.lit(False)))
    code = ("has_code_blocks", "has_function_definitions", "has_import_statements", "has_script_headers", "has_code_structure_patterns", "has_high_keyword_density")
    any_code = F.lit(False)
    for name in code:
        any_code = any_code | F.col(name)
    pattern = (
        F.when(F.col("n_user") > 1, "multi_turn")
        .when(F.col("user_length") > 2000, "context_heavy")
        .when(F.col("assistant_length") > 3000, "detailed_response")
        .when((F.col("user_length") < 50) & (F.col("assistant_length") < 200), "quick_qa")
        .otherwise("standard")
    )
    return (
        rows.withColumn("has_code_patterns", any_code)
        .withColumn("is_coding_focused", F.col("has_code_blocks") | F.col("has_script_headers") | F.col("has_code_structure_patterns"))
        .withColumn("is_wiki_focused", F.coalesce("__wiki", F.lit(False)) | ((F.col("assistant_length") > 1000) & F.col("__headed")))
        .withColumn("has_error_resolution", F.col("user_has_error_messages") & (F.col("n_assistant") > 0))
        .withColumn("interaction_pattern", pattern)
        .withColumn("user_length_category", length_category(F.col("user_length"), (50, 200, 1000, 3000)))
        .withColumn("assistant_length_category", length_category(F.col("assistant_length"), (100, 500, 2000, 5000)))
        .drop("__first", "__wiki", "__headed")
    )


def conversation_length(rules: DataFrame) -> DataFrame:
    """Exchanges of each dialogue and their category."""
    n = F.col("exchange_count")
    category = F.when(n == 1, "single").when(n <= 3, "short").when(n <= 10, "medium").when(n <= 25, "long").otherwise("very_long")
    return rules.groupBy("dialogue_id").agg(F.count(F.lit(1)).alias("exchange_count")).withColumn("category", category)


def feature_summary(rules: DataFrame) -> DataFrame:
    """Share of a dialogue's exchanges with each feature."""
    used = [F.when(F.col(f), f) for f in FEATURES] + [F.when(F.size("gizmos") > 0, "has_gizmo_usage"), F.when(F.size("plugins") > 0, "has_plugin_usage")]
    totals = rules.groupBy("dialogue_id").agg(F.count(F.lit(1)).alias("total_exchanges"))
    counts = rules.select("dialogue_id", F.explode(F.array_compact(F.array(*used))).alias("feature")).groupBy("dialogue_id", "feature").agg(F.count(F.lit(1)).alias("exchange_count"))
    return counts.join(totals, "dialogue_id").select("dialogue_id", "feature", "exchange_count", "total_exchanges", F.bround(100.0 * F.col("exchange_count") / F.col("total_exchanges"), 1).alias("percentage"))


def usage_summary(rules: DataFrame, column: str) -> DataFrame:
    """Distinct gizmos or plugins of each dialogue and their uses."""
    rows = rules.select("dialogue_id", F.explode(column).alias("name"))
    return rows.groupBy("dialogue_id").agg(F.countDistinct("name").alias("n_unique"), F.count(F.lit(1)).alias("total_usage"), F.array_sort(F.collect_set("name")).alias("names"))


def prompt_stats(messages: DataFrame) -> DataFrame:
    """Count, mean, median and spread of a dialogue's prompt lengths."""
    rows = messages.where("role = 'user'").select("dialogue_id", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    mean, spread = F.col("__mean"), F.col("__var")
    # from whole sums, so that the order of rows doesn't matter
    total, squares, n = F.sum("n"), F.sum(F.col("n").cast("long") * F.col("n")), F.count("n")
    _variance = (n * squares - total * total) / (n * n)
    stats = rows.groupBy("dialogue_id").agg(F.count(F.lit(1)).alias("prompt_count"), (F.sum("n") / F.count("n")).alias("__mean"), F.expr("median(n)").alias("__median"), _variance.alias("__var"))
    return stats.select(
        "dialogue_id",
        "prompt_count",
        F.bround(mean, 1).alias("mean_length"),
        F.bround("__median", 1).alias("median_length"),
        F.bround(spread, 1).alias("variance"),
        length_category(mean, (50, 200, 1000, 3000)).alias("length_category"),
        F.when(spread < 1000, "consistent").when(spread < 10000, "mixed").otherwise("variable").alias("consistency"),
    )


def conversation_annotations(rules: DataFrame, messages: DataFrame) -> DataFrame:
    """Annotations of dialogues as rows: name, attribute, value, number.

    Flags of any exchange hold for the dialogue; a structured one has a row
    per attribute.
    """
    flags = [c for c, kind in rules.dtypes if kind == "boolean"]
    flagged = rules.groupBy("dialogue_id").agg(*[F.bool_or(c).alias(c) for c in flags])
    none = F.lit(None).cast("string")
    rows = flagged.select("dialogue_id", F.explode(F.array_compact(F.array(*[F.when(F.col(c), c) for c in flags]))).alias("name"), none.alias("attribute"), F.lit("true").alias("value"), F.lit(1.0).alias("number"))

    def attributes(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        number = dict(df.dtypes)
        items = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value"), (F.lit(None) if number[c] == "string" else F.col(c)).cast("double").alias("number")) for c in columns])
        return df.select("dialogue_id", F.lit(name).alias("name"), F.inline(items))

    out = rows.unionByName(attributes(conversation_length(rules), "conversation_length", ["exchange_count", "category"]))
    out = out.unionByName(attributes(prompt_stats(messages), "prompt_stats", ["prompt_count", "mean_length", "median_length", "variance", "length_category", "consistency"]))
    for column, name in (("gizmos", "gizmo"), ("plugins", "plugin")):
        used = rules.select("dialogue_id", F.explode(column).alias("value")).distinct()
        out = out.unionByName(used.select("dialogue_id", F.lit(name).alias("name"), F.lit(f"{name}_id").alias("attribute"), "value", F.lit(None).cast("double").alias("number")))
    return out


def inherited_annotations(exchange_annotations: DataFrame) -> DataFrame:
    """Of each name the value of the dialogue's first exchange that has it.

    Rows: dialogue_id, exchange, name, value.
    """
    return exchange_annotations.groupBy("dialogue_id", "name").agg(F.min_by("value", "exchange").alias("value"))


def conversation_totals(merged: DataFrame) -> DataFrame:
    """Messages, continuations and the texts of both sides of each dialogue.

    Texts are joined by blanks in the order of the messages.
    """
    side = lambda role: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("created_at", "message_id", F.coalesce("text", F.lit("")).alias("text"))))), lambda x: x["text"]), " ")
    users = merged.where("role = 'user'").groupBy("dialogue_id", "exchange").agg((F.count(F.lit(1)) > 1).alias("more")).groupBy("dialogue_id").agg(F.bool_or("more").alias("has_continuations"))
    rows = merged.groupBy("dialogue_id").agg(
        F.countDistinct("exchange").alias("exchange_count"),
        F.count(F.lit(1)).alias("total_messages"),
        F.count(F.when(F.col("role") == "user", 1)).alias("total_user_messages"),
        F.count(F.when(F.col("role") == "assistant", 1)).alias("total_assistant_messages"),
        side("user").alias("user_text"),
        side("assistant").alias("assistant_text"),
    )
    return rows.join(users, "dialogue_id", "left").withColumn("has_continuations", F.coalesce("has_continuations", F.lit(False)))
