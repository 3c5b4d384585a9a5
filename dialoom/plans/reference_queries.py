"""Queries over the archive's tables, each with its SQL where SQL can say it.

Tables with versions are read by their current rows; exact copies count once.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.keys import current_rows
from ..operators import annotations as store_ops
from ..operators import annotators, exchanges, facets, notes, pairs, sync, views
from ..session import materialize
from ..sources import exports
from .tables import table

MESSAGE_COLUMNS = ["id", "dialogue_id", "source_id", "parent_id", "role", "created_at", "deleted_at", "content_hash", "updated_at"]


def _messages(s: SparkSession, d: str, extra: tuple[str, ...] = ()) -> DataFrame:
    rows = current_rows(table(s, d, "messages"), "id", MESSAGE_COLUMNS + list(extra)).drop("id_key")
    return rows


def _dialogues(s: SparkSession, d: str) -> DataFrame:
    return current_rows(table(s, d, "dialogues"), "id", ["id", "source", "source_id", "title", "created_at", "updated_at"]).drop("id_key")


def _parts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "content_parts").drop("source_json", "export_id").dropDuplicates(["id"]).withColumn("part_type", F.lower(F.trim("part_type")))


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "prompt_responses").dropDuplicates(["id"])


def _content(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "prompt_response_content").dropDuplicates(["prompt_response_id"])


def _pair_rows(s: SparkSession, d: str) -> DataFrame:
    return views.pair_content_view(_pairs(s, d), _content(s, d))


def _raw(s: SparkSession, d: str, platform: str) -> DataFrame:
    return current_rows(table(s, d, "dialogues"), "id", ["source", "source_json"]).where(F.col("source") == platform).select("source_json")


def _imported(s: SparkSession, d: str) -> dict[str, DataFrame]:
    return exports.import_all({p: _raw(s, d, p) for p in exports.PLATFORMS})


def _pair_store(s: SparkSession, d: str) -> DataFrame:
    return annotators.run_registry(_pair_rows(s, d), store_ops.empty_store(s), annotators.PAIR_ANNOTATORS)


def _part_rows(s: SparkSession, d: str) -> DataFrame:
    return annotators.part_rows(_parts(s, d), _messages(s, d))


def _turns(s: SparkSession, d: str) -> DataFrame:
    """Live messages with their platform's text and node, as exchanges take them."""
    m = views.live_messages(_messages(s, d, ("source_json",)))
    node = F.try_parse_json("source_json")
    source = F.when(F.try_variant_get(node, "$.sender", "string").isNotNull(), "claude").otherwise("chatgpt")
    return m.select("dialogue_id", F.col("id").alias("message_id"), "role", "created_at", node.alias("metadata"), exchanges.platform_text(node).alias("text"), source.alias("source"))


def _exchange_rules(s: SparkSession, d: str) -> DataFrame:
    return exchanges.exchange_rules(exchanges.merge(exchanges.chunk(_turns(s, d))))


def _annotated(s: SparkSession, d: str) -> DataFrame:
    turns = _turns(s, d)
    rules = materialize(exchanges.exchange_rules(exchanges.merge(exchanges.chunk(turns))), "rules")
    return materialize(exchanges.conversation_annotations(rules, turns), "annotated")


def _annotation_columns(df: DataFrame) -> DataFrame:
    return df.select("entity_id", "key", "value_type", F.coalesce("value", F.lit("")).alias("value"), F.round("confidence", 2).alias("confidence"), F.coalesce("reason", F.lit("")).alias("reason"))


# Pieces of SQL shared by several statements.
CURRENT_M = "cm as (select * from (select *, row_number() over (partition by id order by updated_at desc) rn from messages) where rn = 1)"
CURRENT_D = "cd as (select * from (select *, row_number() over (partition by id order by updated_at desc) rn from dialogues) where rn = 1)"
PARTS = "cp as (select distinct id, message_id, dialogue_id, sequence, lower(trim(part_type)) part_type, text_content, language from content_parts)"
PAIRS = "pr as (select distinct * from prompt_responses)"
CONTENT = "prc as (select distinct * from prompt_response_content)"
PAIR_ROWS = f"{PAIRS}, {CONTENT}, v as (select pr.*, prc.prompt_text, prc.response_text, prc.prompt_word_count, prc.response_word_count from pr left join prc on prc.prompt_response_id = pr.id)"
WORDS = "case when {0} is null then 0 else len(regexp_split_to_array({0}, '\\s+')) end"

# Row keys are digests of natural keys, in SQL as in Spark.
CHAT_KEY = "sha256(sha256('chatgpt|' || did) || '|' || mid)"
CLAUDE_KEY = "sha256(sha256('claude|' || did) || '|' || mid)"


def _items(source: str, key: str, path: str) -> str:
    """(mid_key, ordinal, x): the objects of an array of each message."""
    return f"(select * from (select {key} as mid_key, unnest(json_extract(b, '{path}[*]')) as x, generate_subscripts(json_extract(b, '{path}[*]'), 1) - 1 as ordinal from {source}) where json_type(x) = 'OBJECT')"


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _lines(*parts: str) -> str:
    return "with " + ", ".join(parts[:-1]) + " " + parts[-1]


# --- pairs -----------------------------------------------------------------


@query(
    _lines(
        CURRENT_M,
        "o as (select *, row_number() over (partition by dialogue_id order by created_at nulls first, id) - 1 as position from cm where deleted_at is null)",
        "b as (select *, last_value(case when role = 'user' then id end ignore nulls) over (partition by dialogue_id order by position rows between unbounded preceding and 1 preceding) as prompt from o)",
        "select b.dialogue_id, b.prompt as prompt_message_id, b.id as response_message_id, p.position::int as prompt_position, b.position::int as response_position, b.role as response_role from b join o p on p.id = b.prompt where b.role <> 'user'",
    )
)
def pairs_sequential(s, d):
    """Each response with the user message before it (B1p, B2p, B4p)."""
    return pairs.build_pairs(_messages(s, d), by_tree=False).select("dialogue_id", "prompt_message_id", "response_message_id", "prompt_position", "response_position", "response_role")


@query(
    _lines(
        "recursive " + CURRENT_M,
        "l as (select id, parent_id, role, dialogue_id, created_at from cm where deleted_at is null)",
        "w(id, node, found) as (select c.id, p.id, p.role = 'user' from l c join l p on p.id = c.parent_id where c.role <> 'user' union select w.id, p.id, p.role = 'user' from w join l c on c.id = w.node join l p on p.id = c.parent_id where not w.found)",
        "o as (select *, row_number() over (partition by dialogue_id order by created_at nulls first, id) - 1 as position from l)",
        "b as (select *, last_value(case when role = 'user' then id end ignore nulls) over (partition by dialogue_id order by position rows between unbounded preceding and 1 preceding) as before from o)",
        "select b.id as response_message_id, coalesce(w.node, b.before) as prompt_message_id, b.role as response_role from b left join w on w.id = b.id and w.found where b.role <> 'user' and coalesce(w.node, b.before) is not null",
    )
)
def pairs_tree(s, d):
    """Each response with its nearest user ancestor, else as above (B3p)."""
    return pairs.build_pairs(_messages(s, d)).select("response_message_id", "prompt_message_id", "response_role")


@query(
    _lines(
        CURRENT_M,
        PARTS,
        "o as (select *, row_number() over (partition by dialogue_id order by created_at nulls first, id) - 1 as position from cm where deleted_at is null)",
        "b as (select *, last_value(case when role = 'user' then id end ignore nulls) over (partition by dialogue_id order by position rows between unbounded preceding and 1 preceding) as prompt from o)",
        "t as (select message_id, string_agg(text_content, chr(10) order by sequence, text_content) as text from cp where part_type = 'text' and text_content is not null group by 1)",
        f"select b.id as response_message_id, p.text as prompt_text, r.text as response_text, ({WORDS.format('p.text')})::int as prompt_word_count, ({WORDS.format('r.text')})::int as response_word_count from b left join t p on p.message_id = b.prompt left join t r on r.message_id = b.id where b.role <> 'user' and b.prompt is not null",
    )
)
def pair_texts(s, d):
    """Texts and word counts of both sides of each pair (B5p, B6p)."""
    built = pairs.build_pairs(_messages(s, d), by_tree=False)
    rows = pairs.pair_content(built, _parts(s, d)).drop("created_at").join(built.select(F.col("id").alias("prompt_response_id"), "response_message_id"), "prompt_response_id")
    return rows.drop("prompt_response_id")


@query(_lines(CURRENT_D, "select id, source from cd where id not in (select dialogue_id from prompt_responses where dialogue_id is not null)"))
def pairs_missing(s, d):
    """Dialogues without pairs, for an incremental build (B9p)."""
    return pairs.dialogues_without_pairs(_dialogues(s, d), _pairs(s, d)).select("id", "source")


@query(
    _lines(
        CURRENT_M,
        "l as (select id, dialogue_id, parent_id from cm where deleted_at is null and parent_id is not null)",
        "k as (select dialogue_id, parent_id, count(distinct id) - 1 as n_siblings from l group by 1, 2 having count(distinct id) > 1)",
        "select distinct id, dialogue_id, parent_id, n_siblings from l join k using (dialogue_id, parent_id)",
    )
)
def message_siblings(s, d):
    """Messages that share a parent, with the group and its size (B10p)."""
    return pairs.siblings(_messages(s, d))


# --- views -----------------------------------------------------------------


@query(
    _lines(
        CURRENT_M,
        "select dialogue_id, parent_id, role, count(*) as sibling_count, string_agg(id, ',' order by created_at nulls first, id) as message_ids from cm where deleted_at is null and parent_id is not null group by 1, 2, 3 having count(*) > 1",
    )
)
def regenerations(s, d):
    """Several messages of a role under one parent (V1)."""
    return views.regenerations(_messages(s, d)).select("dialogue_id", "parent_id", "role", "sibling_count", F.array_join("message_ids", ",").alias("message_ids"))


@query(
    _lines(
        CURRENT_M,
        PARTS,
        "t as (select message_id, string_agg(text_content, chr(10) order by sequence, text_content) as text_content from cp where text_content is not null group by 1)",
        "select cm.id as message_id, cm.dialogue_id, cm.role, t.text_content from cm left join t on t.message_id = cm.id where cm.deleted_at is null",
    )
)
def message_content(s, d):
    """Live messages with the text of all their parts (V2)."""
    return views.message_content(_messages(s, d), _parts(s, d)).drop("created_at")


@query("with " + PAIR_ROWS + " select id as prompt_response_id, dialogue_id, prompt_message_id, response_message_id, prompt_text, response_text, response_word_count from v")
def pair_content_view(s, d):
    """Pairs with their stored texts (V3)."""
    return _pair_rows(s, d).select("prompt_response_id", "dialogue_id", "prompt_message_id", "response_message_id", "prompt_text", "response_text", "response_word_count")


@query(
    "with "
    + PAIR_ROWS
    + " select prompt_message_id, dialogue_id, min(prompt_position) as prompt_position, string_agg(response_message_id, ',' order by response_position, id) as response_message_ids, count(*) as response_count, count(*) > 1 as has_regenerations, min(prompt_text) as prompt_text, coalesce(string_agg(response_text, chr(10) || '---' || chr(10) order by response_position, id), '') as all_responses_text, sum(response_word_count)::bigint as total_response_words from v group by 1, 2"
)
def prompt_exchanges(s, d):
    """One row per prompt with all its responses (V4)."""
    rows = views.prompt_exchanges(_pairs(s, d), _content(s, d))
    return rows.select("prompt_message_id", "dialogue_id", "prompt_position", F.array_join("response_message_ids", ",").alias("response_message_ids"), "response_count", "has_regenerations", "prompt_text", "all_responses_text", "total_response_words")


# --- classifiers -----------------------------------------------------------

RESPONSES = "with " + PAIR_ROWS + ", r as (select id as entity_id, response_text as t from v where response_role = 'assistant' and response_text is not null), "
WIKI = "k as (select entity_id, t, (length(t) - length(replace(t, '[[', ''))) // 2 as n from r)"
TITLES = (
    "f0 as (select entity_id, trim(split_part(trim(t, chr(32) || chr(9) || chr(10) || chr(13) || chr(160)), chr(10), 1), chr(32) || chr(9) || chr(13)) as l from k where n >= 1), "
    "f as (select entity_id, case when l like '#%' then nullif(trim(regexp_replace(l, '^#+', '')), '') end as h, case when l like '**%' and l like '%**' then nullif(trim(regexp_replace(l, '^[*]+|[*]+$', '', 'g')), '') end as b, case when l like '**%' then nullif(trim(regexp_extract(l, '^[*][*](.*?)[*][*]', 1)), '') end as p from f0)"
)


# The classifiers' patterns once more, for another engine.
CODE_TESTS = {
    "arrow_function": r"const\s+\w+\s*=\s*\([^)]*\)\s*=>",
    "c_include": r'(?m)^#include\s*[<"]',
    "js_function": r"function\s+\w+\s*\(",
    "js_require": r"(?m)^(?:const|let|var)\s+.*=\s*require\s*\(",
    "python_function": r"\bdef\s+\w+\s*\(",
    "python_import": r"(?m)^(?:import|from)\s+\w+",
    "shebang": r"(?m)^#!\s*/(?:usr/)?bin/",
}
CODE_SQL = "e as (select entity_id, list_filter(list_sort([case when contains(t, '```') then 'code_block' end, " + ", ".join(f"case when regexp_matches(t, '{p}') then '{n}' end" for n, p in CODE_TESTS.items()) + "]), lambda x: x is not null) as found from r)"
INLINE_SQL = r"(?:^|[^$])\$(?:[^$\n]|[^$\n].*?[^$\n])\$(?:[^$]|$)"
LATEX_SQL = r"x as (select entity_id, regexp_matches(t, '(?s)\$\$.+?\$\$|\\\[.+?\\\]') as dis, regexp_matches(t, '" + INLINE_SQL + "') as inl, regexp_matches(t, '" + annotators.LATEX_COMMAND + "') as com from r{where})"
LATEX_ROWS = "select entity_id, 'has_latex' as key, 'flag' as value_type, null as value, case when dis then 0.95 else 0.8 end::double as confidence, '{reason}' as reason from x where dis or inl or com " + " ".join(f"union all select entity_id, 'latex_type', 'string', '{n}', null, null from x where {c}" for n, c in (("display", "dis"), ("inline", "inl"), ("commands", "com")))
# The rows of each classifier, and of all of them.
WIKI_ROWS = "select entity_id, 'exchange_type' as key, 'string' as value_type, 'wiki_article' as value, case when n >= 3 then 0.95 else 0.8 end::double as confidence, 'wiki_links_detected' as reason from k where n >= 1 union all select entity_id, 'wiki_link_count', 'numeric', n::double::varchar, 1.0, 'counted' from k where n >= 1"
TITLE_ROWS = "select entity_id, 'proposed_title' as key, 'string' as value_type, coalesce(h, b, p) as value, 0.8::double as confidence, case when h is not null then 'markdown_header' when b is not null then 'bold_header' else 'bold_header_with_suffix' end as reason from f where coalesce(h, b, p) is not null"
CODE_ROWS = "select entity_id, 'has_code' as key, 'flag' as value_type, null as value, case when list_has_any(found, ['code_block', 'shebang', 'c_include']) then 0.95 else 0.75 end::double as confidence, array_to_string(found, ',') as reason from e where len(found) > 0 union all select entity_id, 'code_evidence', 'string', x, null, null from (select entity_id, unnest(found) as x from e)"
ALL_ROWS = RESPONSES + ", ".join([WIKI, TITLES, CODE_SQL, LATEX_SQL.format(where="")]) + f", a as ({WIKI_ROWS} union all {TITLE_ROWS} union all {CODE_ROWS} union all {LATEX_ROWS.format(reason='latex_detected')})"
ROW = " select entity_id, key, value_type, coalesce(value, '') as value, round(confidence, 2) as confidence, coalesce(reason, '') as reason from "


@query(ALL_ROWS + ROW + "a where key in ('exchange_type', 'wiki_link_count')")
def annotate_wiki(s, d):
    """Wiki articles and their links."""
    return _annotation_columns(annotators.annotate(_pair_rows(s, d), annotators.PAIR_ANNOTATORS[0]))


@query(ALL_ROWS + ROW + "a where key = 'proposed_title'")
def annotate_title(s, d):
    """Titles of wiki articles, which T1 must have found before."""
    store = annotators.annotate(_pair_rows(s, d), annotators.PAIR_ANNOTATORS[0])
    return _annotation_columns(annotators.annotate(_pair_rows(s, d), annotators.PAIR_ANNOTATORS[3], store))


@query(ALL_ROWS + ROW + "a where key in ('has_code', 'code_evidence')")
def annotate_code(s, d):
    """Code in answers and its evidence."""
    return _annotation_columns(annotators.annotate(_pair_rows(s, d), annotators.PAIR_ANNOTATORS[1]))


@query(ALL_ROWS + ROW + "a where key in ('has_latex', 'latex_type')")
def annotate_latex(s, d):
    """Formulas in answers (T4)."""
    return _annotation_columns(annotators.annotate(_pair_rows(s, d), annotators.PAIR_ANNOTATORS[2]))


PART_TEXTS = f"with {CURRENT_M}, {PARTS}, r as (select cp.id as entity_id, cm.role, cp.text_content as t from cp join cm on cm.id = cp.message_id where cm.deleted_at is null and cp.part_type = 'text' and cp.text_content is not null), "
BLOCKS = r"b as (select entity_id, regexp_extract_all(t, '```(\w*)\n?[\s\S]*?```', 1) as l from r where role = 'assistant')"
BLOCK_ROWS = "select entity_id, 'code_block_count' as key, 'numeric' as value_type, len(l)::double::varchar as value, null::double as confidence, null as reason from b where len(l) > 0 union all select distinct entity_id, 'code_language', 'string', lower(x), null, 'code_block_language_spec' from (select entity_id, unnest(l) as x from b) where x <> '' union all select entity_id, 'has_code_block', 'flag', null, 1.0, 'markdown_code_block' from b where len(l) > 0"
HEADS = r"""h0 as (select entity_id, nullif(regexp_extract(t, '(?m)^#!\s*/(?:usr/)?bin/(?:env\s+)?(\w+)', 1), '') as sh, regexp_matches(t, '(?m)^#include\s*[<"]') as inc, regexp_matches(t, '(?i)<\?php') as php from r), h as (select *, coalesce(sh, case when inc then 'c' when php then 'php' end) as kind from h0)"""
HEAD_ROWS = "select entity_id, 'script_type' as key, 'string' as value_type, kind as value, null::double as confidence, case when sh is not null then 'shebang_interpreter' end as reason from h where kind is not null union all select entity_id, 'has_script_header', 'flag', null, 1.0, case when sh is not null then 'shebang' when inc then 'c_include' else 'php_tag' end from h where kind is not null"
LINKS = r"w as (select entity_id, len(regexp_extract_all(t, '\[\[([^\]]+)\]\]')) as n from r where role = 'assistant')"
LINK_ROWS = "select entity_id, 'wiki_link_count' as key, 'numeric' as value_type, n::double::varchar as value, null::double as confidence, null as reason from w where n > 0 union all select entity_id, 'has_wiki_links', 'flag', null, 1.0, 'wiki_links_detected' from w where n > 0"
PART_LATEX = LATEX_SQL.format(where=" where role = 'assistant'")
PART_LATEX_ROWS = LATEX_ROWS.format(reason="latex_notation_detected")


@query(PART_TEXTS + BLOCKS + ROW + f"({BLOCK_ROWS})")
def annotate_code_blocks(s, d):
    """Fenced blocks of text parts, their number and languages (T5)."""
    return _annotation_columns(annotators.annotate(_part_rows(s, d), annotators.PART_ANNOTATORS[0]))


@query(PART_TEXTS + HEADS + ROW + f"({HEAD_ROWS})")
def annotate_script_headers(s, d):
    """Script headers of text parts of any role."""
    return _annotation_columns(annotators.annotate(_part_rows(s, d), annotators.PART_ANNOTATORS[1]))


@query(PART_TEXTS + LINKS + ROW + f"({LINK_ROWS})")
def annotate_wiki_links(s, d):
    """Wiki links of text parts."""
    return _annotation_columns(annotators.annotate(_part_rows(s, d), annotators.PART_ANNOTATORS[2]))


@query(PART_TEXTS + PART_LATEX + ROW + f"({PART_LATEX_ROWS})")
def annotate_part_latex(s, d):
    """Formulas of text parts."""
    return _annotation_columns(annotators.annotate(_part_rows(s, d), annotators.PART_ANNOTATORS[3]))


@query(ALL_ROWS + " select value_type, count(*) as n from a group by 1")
def registry_counts(s, d):
    """Rows per type after the registry of pairs."""
    return _pair_store(s, d).groupBy("value_type").agg(F.count(F.lit(1)).alias("n"))


@query(ALL_ROWS + " select value_type, count(*) as n_created from a where value_type <> 'numeric' and (value_type = 'string' or confidence > 0.9) group by 1")
def created_counts(s, d):
    """Rows per type that a second write adds to a store with a part of them."""
    found = annotators.registry_rows(_pair_rows(s, d), store_ops.empty_store(s), annotators.PAIR_ANNOTATORS)
    return store_ops.created_counts(found.where("value_type = 'numeric' or (value_type = 'flag' and confidence <= 0.9)"), found)


@query(ALL_ROWS + " select distinct entity_id as id from a where key = 'exchange_type' and entity_id not in (select entity_id from a where key = 'has_code')")
def wiki_without_code(s, d):
    """Pairs that need one annotation and must lack another."""
    rows, store = _pair_rows(s, d), _pair_store(s, d)
    rows = store_ops.required(rows, store, "prompt_response", "prompt_response_id", strings=(("exchange_type", "wiki_article"),))
    return store_ops.skipped(rows, store, "prompt_response", "prompt_response_id", flags=("has_code",)).select(F.col("prompt_response_id").alias("id"))


@query(ALL_ROWS + ROW + "a")
def annotations_all(s, d):
    """All annotations of pairs with values as text (V7)."""
    return _annotation_columns(views.annotations_all(_pair_store(s, d), "prompt_response"))


@query(PART_TEXTS + ", ".join([BLOCKS, HEADS, LINKS, PART_LATEX]) + ROW + f"({BLOCK_ROWS} union all {HEAD_ROWS} union all {LINK_ROWS} union all {PART_LATEX_ROWS})")
def part_annotations_all(s, d):
    """All annotations of content parts with values as text (V5)."""
    return _annotation_columns(views.annotations_all(annotators.run_registry(_part_rows(s, d), store_ops.empty_store(s), annotators.PART_ANNOTATORS), "content_part"))


STATUS = ALL_ROWS + f", {CURRENT_D}, w as (select v.id as prompt_response_id, v.dialogue_id, cd.title as dialogue_title, cd.source as platform, v.response_word_count, coalesce(h, b, p) as extracted_title, k.n::double as wiki_link_count, split_part(v.response_text, chr(10), 1) as first_line, split_part(v.response_text, chr(10), 2) as second_line, v.created_at, v.prompt_text, v.response_text from v join k on k.entity_id = v.id and k.n >= 1 join cd on cd.id = v.dialogue_id left join f on f.entity_id = v.id) "


@query(STATUS + "select prompt_response_id, dialogue_id, dialogue_title, platform, response_word_count, extracted_title, wiki_link_count, first_line, second_line from w")
def wiki_status(s, d):
    """Wiki articles with title, links and first lines (V9)."""
    rows = views.wiki_status(_pairs(s, d), _content(s, d), _dialogues(s, d), _pair_store(s, d))
    return rows.select("prompt_response_id", "dialogue_id", "dialogue_title", "platform", "response_word_count", "extracted_title", "wiki_link_count", "first_line", "second_line")


# Of equal keys of an entity the last in order of type and value counts.
LAST = ", l as (select * from (select *, row_number() over (partition by entity_id, key order by value_type desc, coalesce(value, '') desc) as i from a) where i = 1)"


@query(ALL_ROWS + LAST + ", j as (select entity_id, string_agg(key || '=' || value_type || ':' || coalesce(value, '') || ':' || coalesce(round(confidence, 2)::varchar, ''), ';' order by key) as annotations from l group by 1) select v.id as prompt_response_id, v.dialogue_id, coalesce(j.annotations, '') as annotations, (select max(value) from a where a.entity_id = v.id and key = 'exchange_type') as exchange_type, (select max(value) from a where a.entity_id = v.id and key = 'proposed_title') as proposed_title from v left join j on j.entity_id = v.id")
def annotation_summary(s, d):
    """Annotations of each pair as a map, here as text, with two common ones."""
    rows = views.annotation_summary(_pairs(s, d), _pair_store(s, d))
    entries = F.transform(F.array_sort(F.map_entries("annotations")), lambda e: F.concat(e["key"], F.lit("="), e["value"]["value_type"], F.lit(":"), F.coalesce(e["value"]["value"], F.lit("")), F.lit(":"), F.coalesce(F.round(e["value"]["confidence"], 2).cast("string"), F.lit(""))))
    return rows.select("prompt_response_id", "dialogue_id", F.array_join(entries, ";").alias("annotations"), "exchange_type", "proposed_title")


@query(ALL_ROWS + LAST + ", j as (select entity_id, string_agg(key || '=' || value_type || ':' || coalesce(value, ''), ';' order by key) as annotations from l group by 1) select v.id as prompt_response_id, v.response_word_count, j.annotations from v left join j on j.entity_id = v.id")
def pairs_with_annotations(s, d):
    """Pairs with their annotations, here as text."""
    rows = views.pairs_with_annotations(_pairs(s, d), _content(s, d), _pair_store(s, d))
    entries = F.transform(F.array_sort(F.map_entries("annotations")), lambda e: F.concat(e["key"], F.lit("="), e["value"]["value_type"], F.lit(":"), F.coalesce(e["value"]["value"], F.lit(""))))
    return rows.select("prompt_response_id", "response_word_count", F.array_join(entries, ";").alias("annotations"))


@query(STATUS + "select prompt_response_id, dialogue_title, platform, wiki_link_count, left(prompt_text, 100) as prompt_preview, left(response_text, 500) as response_preview, response_word_count from w where extracted_title is null order by w.response_word_count desc nulls last, created_at desc, prompt_response_id limit 100")
def wiki_without_titles(s, d):
    """The longest untitled wiki articles, a report of 100 (Q1)."""
    rows = views.wiki_without_titles(_pairs(s, d), _content(s, d), _dialogues(s, d), _pair_store(s, d))
    return rows.select("prompt_response_id", "dialogue_title", "platform", "wiki_link_count", "prompt_preview", "response_preview", "response_word_count")


@query(STATUS + "select case when extracted_title is not null then 'has_title' else 'no_title' end as status, count(*) as n from w group by 1")
def title_breakdown(s, d):
    """Wiki articles with and without title (Q2)."""
    return views.title_breakdown(_pairs(s, d), _pair_store(s, d))


@query("with " + CONTENT + " select left(split_part(response_text, chr(10), 1), 80) as first_line_pattern, count(*) as occurrences from prc where response_text is not null group by 1 order by 2 desc, 1 limit 50")
def first_lines(s, d):
    """The commonest first lines, a report of 50 (Q3)."""
    return views.first_lines(_content(s, d))


@query(ALL_ROWS + f", {CURRENT_D}, {CURRENT_M} select 'dialogues' as what, count(*) as n from cd union all select 'messages', count(*) from cm union all select 'prompt_responses', count(*) from pr union all select 'dialogues:' || source, count(*) from cd group by source union all select 'annotations', count(*) from a")
def archive_stats(s, d):
    """Rows per table, annotations of pairs included, and dialogues per source."""
    return views.archive_stats(_dialogues(s, d), _messages(s, d), _pairs(s, d), _pair_store(s, d))


@query("with " + CONTENT + " select prompt_response_id, response_word_count from prc where response_text ilike '%the order changed%' and response_word_count between 20 and 60")
def text_search(s, d):
    """Pairs by pattern and word count (Q5)."""
    return views.search_texts(_content(s, d), "%the order changed%", 20, 60).select("prompt_response_id", "response_word_count")


# --- ingestion -------------------------------------------------------------

CHATGPT = f"{CURRENT_D}, c as (select json(source_json) as j from cd where source = 'chatgpt'), g as (select coalesce(nullif(j->>'conversation_id', ''), nullif(j->>'id', '')) as did, j from c), n as (select did, unnest(json_keys(j, '$.mapping')) as k, j from g where did is not null), m as (select did, k, json_extract(j, '$.mapping.\"' || k || '\"') as node from n), gm as (select did, k, node->>'parent' as parent, node->'message' as b, node->'message'->>'id' as mid from m where json_type(node->'message') = 'OBJECT' and coalesce(node->'message'->>'id', '') <> '')"
CLAUDE = f"{CURRENT_D}, c as (select json(source_json) as j from cd where source = 'claude'), g as (select nullif(j->>'uuid', '') as did, json_extract(j, '$.chat_messages[*]') as l from c), n as (select did, unnest(l) as b, generate_subscripts(l, 1) as ordinal from g where did is not null), lm as (select did, ordinal, b, b->>'uuid' as mid from n where coalesce(b->>'uuid', '') <> '')"


@query(
    f"with {CHATGPT}, i as (select did as source_id, 'chatgpt' as source from g where did is not null), u as (select nullif(json(source_json)->>'uuid', '') as source_id, 'claude' as source, json(source_json)->>'name' as title from cd where source = 'claude') select source_id, source, title from (select i.source_id, i.source, g.j->>'title' as title from i join g on g.did = i.source_id) union all select source_id, source, title from u where source_id is not null"
)
def import_dialogues(s, d):
    """Conversations of both exports."""
    return _imported(s, d)["dialogues"].select("source_id", "source", "title")


@query(
    f"with {CHATGPT} select gm.did as dialogue, gm.mid as source_id, case when coalesce(b->'author'->>'role', '') = '' then 'unknown' when lower(b->'author'->>'role') = 'human' then 'user' else lower(b->'author'->>'role') end as role, b->'author'->'metadata'->>'user_id' as author_id, p.mid as parent from gm left join (select did, k, mid from gm) p on p.did = gm.did and p.k = gm.parent"
)
def import_tree_messages(s, d):
    """Messages of trees with the message of their parent node."""
    di = exports.chatgpt_dialogues(_raw(s, d, "chatgpt"))
    m = exports.chatgpt_messages(di)
    names = di.where("source_id is not null").select(scalars.row_key("source", "source_id").alias("dialogue_id"), F.col("source_id").alias("dialogue"))
    parents = m.select(F.col("id").alias("parent_id"), F.col("source_id").alias("parent"))
    return m.join(names, "dialogue_id").join(parents, "parent_id", "left").select("dialogue", "source_id", "role", "author_id", "parent")


@query(
    f"with {CLAUDE} select did as dialogue, mid as source_id, case when coalesce(b->>'sender', '') = '' then 'unknown' when lower(b->>'sender') = 'human' then 'user' else lower(b->>'sender') end as role, lag(mid) over (partition by did order by ordinal) as parent from lm"
)
def import_chain_messages(s, d):
    """Messages of lists, chained in order."""
    di = exports.claude_dialogues(_raw(s, d, "claude"))
    m = exports.claude_messages(di)
    names = di.where("source_id is not null").select(scalars.row_key("source", "source_id").alias("dialogue_id"), F.col("source_id").alias("dialogue"))
    parents = m.select(F.col("id").alias("parent_id"), F.col("source_id").alias("parent"))
    return m.join(names, "dialogue_id").join(parents, "parent_id", "left").select("dialogue", "source_id", "role", "parent")


def _text_of(*paths: str) -> str:
    """The first of the paths that holds text that isn't empty."""
    return "coalesce(" + ", ".join(f"case when json_type(x, '$.{p}') = 'VARCHAR' then nullif(x->>'{p}', '') end" for p in paths) + ")"


TREE_PARTS = (
    f"with {CHATGPT}, ap as (select mid, b, json_extract(b, '$.content.parts[*]') as l from gm), p as (select mid, unnest(l) as x, generate_subscripts(l, 1) - 1 as sequence from ap), "
    "pk as (select mid, sequence, x, json_type(x) as kind, lower(coalesce(x->>'content_type', '')) as ct, nullif(x->>'language', '') as lang from p), "
    "pm as (select *, case when contains(ct, 'image') then 'image' when contains(ct, 'audio') then 'audio' when contains(ct, 'video') then 'video' end as medium from pk), "
    "pt as (select *, medium is null and (ct = 'code' or lang is not null) as code from pm), "
    "tree as (select mid as source_id, sequence, case when kind = 'VARCHAR' then 'text' when kind <> 'OBJECT' then 'unknown' when medium is not null then medium when code then 'code' else coalesce(nullif(x->>'content_type', ''), 'unknown') end as part_type, "
    f"case when kind = 'VARCHAR' then x->>'$' when kind <> 'OBJECT' or medium is not null then null when code then coalesce(nullif(x->>'text', ''), nullif(x->>'code', '')) else {_text_of('text', 'result', 'content')} end as text_content, "
    "case when kind = 'OBJECT' and code then lang end as language, case when kind = 'OBJECT' and medium is not null then x->>'content_type' end as media_type, "
    "case when kind <> 'OBJECT' or medium is null then null when medium = 'image' then case when starts_with(x->>'asset_pointer', 'file-service://') then x->>'asset_pointer' else nullif(x->>'url', '') end else coalesce(nullif(x->>'url', ''), nullif(x->>'asset_pointer', '')) end as url from pt), "
    "cv0 as (select mid, b, coalesce(case when json_type(b->'metadata'->'canvas') = 'OBJECT' then b->'metadata'->'canvas' end, case when json_type(b->'canvas') = 'OBJECT' then b->'canvas' end) as x from gm)"
)


@query(TREE_PARTS + " select source_id, sequence::int as sequence, part_type, text_content, language, media_type, url from tree union all select mid, coalesce(json_array_length(b, '$.content.parts'), 0)::int, 'canvas', coalesce(nullif(x->>'content', ''), nullif(x->>'textdoc_content', '')), null, null, null from cv0 where x is not null")
def import_tree_parts(s, d):
    """Classified parts of trees' messages, canvas documents included."""
    m = exports.chatgpt_messages(exports.chatgpt_dialogues(_raw(s, d, "chatgpt")))
    rows = exports.content_parts(m).join(m.select(F.col("id").alias("message_id"), "source_id"), "message_id")
    return rows.select("source_id", "sequence", "part_type", "text_content", "language", "media_type", "url")


LIST_PARTS = (
    f"with {CLAUDE}, al as (select mid, b, json_extract(b, '$.content[*]') as l from lm), p as (select mid, unnest(l) as x, generate_subscripts(l, 1) - 1 as sequence from al), pk as (select *, lower(coalesce(x->>'type', 'unknown')) as kind from p), "
    "rs as (select mid, sequence, nullif(array_to_string(list_filter(list_transform(json_extract(x, '$.content[*]'), lambda y: case when json_type(y) = 'VARCHAR' then y->>'$' else nullif(y->>'text', '') end), lambda y: y is not null), chr(10)), '') as joined from pk where kind = 'tool_result')"
)


@query(
    LIST_PARTS
    + " select p.mid as source_id, p.sequence::int as sequence, kind as part_type, case when kind = 'tool_use' then x->>'name' end as tool_name, case kind when 'tool_use' then x->>'id' when 'tool_result' then x->>'tool_use_id' end as tool_use_id, case kind when 'text' then x->>'text' when 'thinking' then x->>'thinking' when 'tool_use' then coalesce(nullif(x->'input'->>'query', ''), nullif(x->'input'->>'text', '')) when 'tool_result' then case when json_type(x, '$.content') = 'VARCHAR' then x->>'content' else joined end when 'image' then null else x->>'text' end as text_content, case when kind = 'tool_result' then coalesce(case when json_type(x, '$.is_error') = 'BOOLEAN' then (x->>'is_error')::boolean end, false) end as is_error, case when kind = 'image' and (x->'source'->>'type') = 'url' then x->'source'->>'url' end as url from pk p left join rs on rs.mid = p.mid and rs.sequence = p.sequence"
    + " union all select mid, 0, 'text', null, null, b->>'text', null, null from al where coalesce(len(l), 0) = 0 and coalesce(b->>'text', '') <> ''"
)
def import_list_parts(s, d):
    """Classified parts of lists' messages, their texts and the fallback."""
    m = exports.claude_messages(exports.claude_dialogues(_raw(s, d, "claude")))
    rows = exports.content_parts(m).join(m.select(F.col("id").alias("message_id"), "source_id"), "message_id")
    return rows.select("source_id", "sequence", "part_type", "tool_name", "tool_use_id", "text_content", "is_error", "url")


# Both platforms in one statement; the second's names get a prefix.
BOTH = f"with {CHATGPT}, " + CLAUDE.removeprefix(CURRENT_D + ", ").replace("c as (", "kc as (", 1).replace(", g as (", ", kg as (", 1).replace(" from c)", " from kc)", 1).replace(", n as (", ", kn as (", 1).replace(" from g where", " from kg where", 1).replace("from n where", "from kn where", 1)


@query(
    BOTH
    + ", w as (select sha256(mid_key || '|0') as content_part_id, ordinal, x from "
    + _items("gm", CHAT_KEY, "$.metadata.citations")
    + " where mid_key in (select "
    + CHAT_KEY
    + " from gm where json_array_length(b, '$.content.parts') > 0) union all select sha256(part || '|' || seq), ordinal, x from (select mid_key as part, ordinal::varchar as seq, unnest(json_extract(x, '$.citations[*]')) as x, generate_subscripts(json_extract(x, '$.citations[*]'), 1) - 1 as ordinal from "
    + _items("lm", CLAUDE_KEY, "$.content")
    + ") where json_type(x) = 'OBJECT') select content_part_id, ordinal::int as ordinal, x->>'uuid' as source_id, coalesce(nullif(x->'details'->>'url', ''), x->>'url') as url, coalesce(nullif(x->'details'->>'type', ''), x->>'type') as citation_type, (x->>'start_index')::int as start_index, (x->>'end_index')::int as end_index from w"
)
def import_citations(s, d):
    """Citations of both platforms."""
    return _imported(s, d)["citations"].drop("source_json")


@query(
    BOTH
    + ", w as (select *, false as is_file from "
    + _items("gm", CHAT_KEY, "$.metadata.attachments")
    + " union all select *, false from "
    + _items("lm", CLAUDE_KEY, "$.attachments")
    + " union all select *, true from "
    + _items("lm", CLAUDE_KEY, "$.files")
    + ") select mid_key as message_id, ordinal::int as ordinal, is_file, coalesce(nullif(x->>'name', ''), x->>'file_name') as file_name, coalesce(nullif(x->>'mime_type', ''), nullif(x->>'mimeType', ''), x->>'file_type') as file_type, coalesce(try_cast(x->>'size' as bigint), try_cast(x->>'file_size' as bigint)) as file_size, x->>'extracted_content' as extracted_text from w"
)
def import_attachments(s, d):
    """Attachments and files of messages."""
    return _imported(s, d)["attachments"].drop("source_json")


@query(f"with {CHATGPT} select mid as source_id, b->'metadata'->>'model_slug' as model_slug, b->'metadata'->>'gizmo_id' as gizmo_id, b->>'status' as status from gm")
def import_meta(s, d):
    """Model and state of messages."""
    m = exports.chatgpt_messages(exports.chatgpt_dialogues(_raw(s, d, "chatgpt")))
    return exports.chatgpt_meta(m).join(m.select(F.col("id").alias("message_id"), "source_id"), "message_id").select("source_id", "model_slug", "gizmo_id", "status")


@query(
    f"with {CHATGPT}, gr as "
    + _items("gm", CHAT_KEY, "$.metadata.search_result_groups")
    + ", en as (select mid_key, ordinal, x->>'domain' as domain, unnest(json_extract(x, '$.entries[*]')) as y, generate_subscripts(json_extract(x, '$.entries[*]'), 1) - 1 as sequence from gr) select mid_key as message_id, ordinal::int as group_sequence, domain, sequence::int as sequence, y->>'url' as url, y->>'title' as title from en where json_type(y) = 'OBJECT'"
)
def import_search_entries(s, d):
    """Search groups with their entries."""
    t = _imported(s, d)
    rows = t["search_groups"].withColumnRenamed("sequence", "group_sequence").join(t["search_entries"].withColumnRenamed("group_id", "id").select("id", "sequence", "url", "title"), "id")
    return rows.select("message_id", "group_sequence", "domain", "sequence", "url", "title")


@query(
    f"with {CHATGPT}, r as (select {CHAT_KEY} as message_id, b->'metadata'->'aggregate_result' as a from gm where json_type((b->'metadata')->'aggregate_result') = 'OBJECT' and (b->'metadata'->>'aggregate_result') <> '{{}}'), o as (select * from (select message_id, unnest(json_extract(a, '$.messages[*]')) as x, generate_subscripts(json_extract(a, '$.messages[*]'), 1) - 1 as sequence from r) where json_type(x) = 'OBJECT') select r.message_id, a->>'run_id' as run_id, a->>'status' as status, nullif(array_to_string(json_extract_string(a, '$.in_kernel_exception.traceback[*]'), chr(10)), '') as traceback, o.sequence::int as sequence, x->>'message_type' as output_type, coalesce(nullif(x->>'text', ''), x->>'content') as text_content from r left join o on o.message_id = r.message_id"
)
def import_code_runs(s, d):
    """Code runs with their outputs."""
    t = _imported(s, d)
    return t["code_executions"].join(t["code_outputs"], "message_id", "left").select("message_id", "run_id", "status", "traceback", "sequence", "output_type", "text_content")


@query(
    TREE_PARTS
    + ", im as (select sha256(sha256(sha256('chatgpt|' || did) || '|' || gm.mid) || '|' || sequence) as content_part_id, x, coalesce(case when json_type(x->'metadata'->'dalle') = 'OBJECT' and (x->'metadata'->'dalle')::varchar <> '{}' then x->'metadata'->'dalle' end, case when json_type(x->'metadata'->'generation') = 'OBJECT' and (x->'metadata'->'generation')::varchar <> '{}' then x->'metadata'->'generation' end) as g from pt join gm on gm.mid = pt.mid) select content_part_id, g->>'gen_id' as gen_id, g->>'prompt' as prompt, try_cast(g->>'seed' as bigint) as seed, coalesce(try_cast(g->>'width' as int), try_cast(x->>'width' as int)) as width, coalesce(try_cast(g->>'height' as int), try_cast(x->>'height' as int)) as height from im where g is not null"
)
def import_images(s, d):
    """Image generations."""
    return _imported(s, d)["dalle_generations"]


_CANVAS = TREE_PARTS + f", cv1 as (select sha256({CHAT_KEY} || '|canvas') as content_part_id, {CHAT_KEY} as message_id, cx.x from gm join (select mid as cmid, x from cv0) cx on cx.cmid = gm.mid where cx.x is not null)"


@query(_CANVAS + " select content_part_id, message_id, x->>'textdoc_id' as textdoc_id, try_cast(x->>'version' as int) as version, x->>'title' as title, x->>'textdoc_type' as textdoc_type, coalesce(nullif(x->>'content', ''), nullif(x->>'textdoc_content', '')) as text_content, try_cast(x->>'from_version' as int) as from_version, coalesce(try_cast(x->>'has_user_edit' as boolean), false) as has_user_edit from cv1")
def import_canvas(s, d):
    """Canvas documents as further parts."""
    return _imported(s, d)["canvas_docs"]


@query(
    _CANVAS
    + f", me as (select {CHAT_KEY} as k, nullif(b->'metadata'->>'gizmo_id', '') as g, nullif(b->'metadata'->>'model_slug', '') as m from gm), la as (select content_part_id from (select *, row_number() over (partition by x->>'textdoc_id' order by coalesce(try_cast(x->>'version' as int), -1) desc, content_part_id desc) as r from cv1 where x->>'textdoc_id' is not null) where r = 1)"
    + " select 'message' as entity_type, k as entity_id, 'gizmo_id' as key, 'string' as value_type, g as value from me where g is not null union all select 'message', k, 'has_gizmo', 'flag', null from me where g is not null union all select 'message', k, 'model_slug', 'string', m from me where m is not null"
    + " union all select 'content_part', content_part_id, 'title', 'string', x->>'title' from cv1 where coalesce(x->>'title', '') <> '' union all select 'content_part', content_part_id, 'textdoc_id', 'string', x->>'textdoc_id' from cv1 where coalesce(x->>'textdoc_id', '') <> '' union all select 'content_part', content_part_id, 'canvas_version', 'numeric', x->>'version' from cv1 where x->>'version' is not null union all select 'content_part', content_part_id, 'textdoc_type', 'string', x->>'textdoc_type' from cv1 where coalesce(x->>'textdoc_type', '') <> '' union all select 'content_part', content_part_id, 'is_latest_canvas_version', 'flag', null from la"
)
def import_annotations(s, d):
    """Annotations known at import."""
    return _imported(s, d)["annotations"]


CANVAS = f"with {CHATGPT}, cv as (select mid, sha256({CHAT_KEY} || '|canvas') as content_part_id, {CHAT_KEY} as message_id, coalesce(case when json_type(b->'metadata'->'canvas') = 'OBJECT' then b->'metadata'->'canvas' end, case when json_type(b->'canvas') = 'OBJECT' then b->'canvas' end) as x from gm), cd2 as (select content_part_id, message_id, x->>'textdoc_id' as textdoc_id, (x->>'version')::int as version, x->>'title' as title from cv where x is not null)"


@query(CANVAS + " select textdoc_id, content_part_id, message_id, version, title from (select *, row_number() over (partition by textdoc_id order by coalesce(version, -1) desc, content_part_id desc) as r from cd2 where textdoc_id is not null) where r = 1")
def canvas_latest(s, d):
    """The newest version of each canvas document."""
    return exports.latest_canvas(_imported(s, d)["canvas_docs"])


@query()
def schema_inference(s, d):
    """The merged structure of the exports of each platform."""
    return exports.inferred_schema(current_rows(table(s, d, "dialogues"), "id", ["source", "source_json"]))


# --- scalars ---------------------------------------------------------------


@query("select c as role, case when coalesce(c, '') = '' then 'unknown' when lower(c) = 'human' then 'user' else lower(c) end as normal, count(*) as n from (select role as c from messages union all select prompt_role from prompt_responses) group by 1, 2")
def roles(s, d):
    """Roles as stored and normalised (F2)."""
    rows = table(s, d, "messages").select("role").unionAll(table(s, d, "prompt_responses").select("prompt_role"))
    return rows.groupBy("role", scalars.normalize_role(F.col("role")).alias("normal")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {CHATGPT} select mid as source_id, floor((b->>'create_time')::double)::bigint as epoch from gm where b->>'create_time' is not null")
def parsed_times(s, d):
    """Times of messages from epoch seconds (F1)."""
    m = exports.chatgpt_messages(exports.chatgpt_dialogues(_raw(s, d, "chatgpt")))
    return m.where("created_at is not null").select("source_id", F.unix_timestamp("created_at").alias("epoch"))


@query("with " + CONTENT + f" select prompt_response_id, ({WORDS.format('response_text')})::int as n_words from prc")
def word_counts(s, d):
    """Words of answers as the builder counts them (B6p)."""
    return _content(s, d).select("prompt_response_id", scalars.word_count(F.col("response_text")).alias("n_words"))


@query()
def content_hashes(s, d):
    """Digests of message nodes that ignore key order."""
    return table(s, d, "messages").select("id", scalars.content_hash(F.try_parse_json("source_json")).alias("digest")).distinct()


# --- synchronisation -------------------------------------------------------

# The archive as loaded before an export meets what the export brings.
SYNC = "s0 as (select distinct id, updated_at from dialogues where export_id % 2 = 0), si as (select id, max(updated_at) as updated_at from s0 group by 1), i0 as (select id, max(updated_at) as updated_at from dialogues where export_id % 2 = 1 group by 1), da as (select i0.id, case when si.id is null then 'new' when i0.updated_at is null then 'skipped' when si.updated_at is null or i0.updated_at > si.updated_at then 'updated' else 'skipped' end as action from i0 left join si on si.id = i0.id)"
SYNC_M = SYNC + ", sm as (select * from (select *, row_number() over (partition by id order by updated_at desc) rn from messages where export_id % 2 = 0) where rn = 1), im as (select * from (select *, row_number() over (partition by id order by updated_at desc) rn from messages where export_id % 2 = 1) where rn = 1), td as (select id from da where action <> 'skipped'), fo as (select coalesce(a.dialogue_id, b.dialogue_id) as dialogue_id, coalesce(a.source_id, b.source_id) as source_id, case when a.id is null then 'new' when b.id is null then case when a.deleted_at is null then 'soft_deleted' else 'absent' end when a.deleted_at is not null then 'restored' when a.content_hash is not distinct from b.content_hash then 'unchanged' else 'updated' end as action from (select * from sm where dialogue_id in (select id from td)) a full outer join (select * from im where dialogue_id in (select id from td)) b on a.dialogue_id = b.dialogue_id and a.source_id = b.source_id)"


def _sync(s, d):
    dialogues, messages = table(s, d, "dialogues"), table(s, d, "messages")
    side = lambda df, k: df.where(f"export_id % 2 = {k}")
    of = lambda k: side(dialogues, k).groupBy("id").agg(F.max("updated_at").alias("updated_at"))
    actions = sync.dialogue_actions(of(0), of(1))
    rows = lambda k: current_rows(side(messages, k), "id", MESSAGE_COLUMNS).drop("id_key")
    return actions, rows(0), rows(1)


@query(f"with {SYNC} select id, action from da")
def sync_dialogues(s, d):
    """What a later half of the exports does to dialogues."""
    return _sync(s, d)[0].select("id", "action")


@query(f"with {SYNC_M} select dialogue_id, source_id, action from fo")
def sync_messages(s, d):
    """What it does to messages."""
    actions, stored, incoming = _sync(s, d)
    return sync.message_actions(stored, incoming, actions)


@query(f"with {SYNC_M} select case when action = 'updated' then 'unchanged' when action = 'soft_deleted' then 'absent' else action end as action, count(*) as n from fo group by 1")
def sync_lenient(s, d):
    """The same with contents held immutable and nothing deleted."""
    actions, stored, incoming = _sync(s, d)
    return sync.message_actions(stored, incoming, actions, True, True).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"with {SYNC_M}, names as (select unnest(['dialogues_new', 'dialogues_updated', 'dialogues_skipped', 'dialogues_failed', 'messages_new', 'messages_updated', 'messages_unchanged', 'messages_restored', 'messages_soft_deleted', 'messages_absent']) as counter), c as (select 'dialogues_' || action as counter from da union all select 'messages_' || action from fo) select names.counter, count(c.counter) as n from names left join c on c.counter = names.counter group by 1"
)
def sync_counts(s, d):
    """The import's counters."""
    actions, stored, incoming = _sync(s, d)
    return sync.import_counts(actions, sync.message_actions(stored, incoming, actions))


@query(f"with {SYNC_M}, x as (select coalesce(a.dialogue_id, b.dialogue_id) as dialogue_id, coalesce(a.source_id, b.source_id) as source_id, coalesce(a.id, b.id) as id, a.id is not null as old, a.deleted_at, fo.action, case when fo.action in ('new', 'updated', 'restored') then b.content_hash else a.content_hash end as content_hash from sm a full outer join im b on a.dialogue_id = b.dialogue_id and a.source_id = b.source_id left join fo on fo.dialogue_id = coalesce(a.dialogue_id, b.dialogue_id) and fo.source_id = coalesce(a.source_id, b.source_id)) select id, content_hash, case when action = 'soft_deleted' then true when action in ('new', 'updated', 'restored') then false else deleted_at is not null end as deleted from x where old or action is not null")
def sync_applied(s, d):
    """The message table after the import."""
    actions, stored, incoming = _sync(s, d)
    acts = sync.message_actions(stored, incoming, actions)
    return sync.apply_messages(stored, incoming, acts, F.current_timestamp()).select("id", "content_hash", F.col("deleted_at").isNotNull().alias("deleted"))


@query("select id, 'x' as mark from (select id, max(created_at) as c from prompt_responses group by 1) where c > (select quantile_disc(created_at, 0.5) from (select distinct id, created_at from prompt_responses))")
def cursor_incremental(s, d):
    """Rows beyond an annotator's high-water mark."""
    rows = _pairs(s, d).select("id", F.col("created_at").cast("timestamp").alias("created_at"))
    mark = rows.agg(F.timestamp_micros(F.expr("percentile_disc(0.5) within group (order by unix_micros(created_at))").cast("long")).alias("high_water_mark"))
    cursors = mark.select(F.lit("wiki").alias("annotator_name"), F.lit("1.0").alias("annotator_version"), F.lit("prompt_response").alias("entity_type"), "high_water_mark")
    return store_ops.since_cursor(rows, cursors, "wiki", "1.0", "prompt_response").select("id", F.lit("x").alias("mark"))


@query(ALL_ROWS + " select entity_id, key, string_agg(distinct case when value_type = 'flag' then 'true' else value end, ',' order by case when value_type = 'flag' then 'true' else value end) as vals from a group by 1, 2")
def annotation_keys(s, d):
    """Keys of each pair with their values (A10)."""
    return store_ops.all_keys(_pair_store(s, d), "prompt_response").select("entity_id", "key", F.array_join("values", ",").alias("vals"))


@query(ALL_ROWS + ROW + "a union all select id, 'stats', 'json', '{\"words\":' || (coalesce(response_word_count, 0) + 1) || '}', 1.0, '' from v")
def store_idempotent(s, d):
    """A write repeated changes nothing but json, which takes the newest value."""
    found = annotators.registry_rows(_pair_rows(s, d), store_ops.empty_store(s), annotators.PAIR_ANNOTATORS)
    words = lambda n: store_ops.rows_of(_pair_rows(s, d), "prompt_response", "prompt_response_id", F.array(store_ops.annotation("stats", "json", F.to_json(F.struct((F.coalesce("response_word_count", F.lit(0)) + n).alias("words"))), 1.0)))
    once = store_ops.write(store_ops.empty_store(s), found.unionByName(words(0)))
    return _annotation_columns(store_ops.write(once, found.withColumn("confidence", F.lit(0.1)).unionByName(words(1)).unionByName(words(1))))


# --- exchanges, facets, notes ----------------------------------------------

_STRIP = "trim({0}, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160) || chr(12288))"
TURNS = (
    CURRENT_M
    + ", tj as (select id, case when json_valid(source_json) then json(source_json) end as j from cm where deleted_at is null), "
    + "tp as (select id, j, "
    + _STRIP.format("coalesce(array_to_string(list_transform(list_filter(json_extract(j, '$.content.parts[*]'), lambda x: json_type(x) = 'VARCHAR'), lambda x: x->>'$'), ' '), '')")
    + " as p, case when json_type(j->'content'->'text') = 'VARCHAR' then j->'content'->>'text' else '' end as own from tj), "
    + "t as (select id as message_id, j, case when j->>'sender' is not null then 'claude' else 'chatgpt' end as source, case when j->>'sender' is not null then coalesce(j->>'text', '') else "
    + _STRIP.format("own || case when p = '' then '' else ' ' || p end")
    + " end as text from tp)"
)
# The chunker as a recursion: held is the pair's roles so far.
DYADS = (
    "with recursive "
    + TURNS
    + ", "
    "o as (select cm.dialogue_id, cm.id, cm.role, cm.created_at, coalesce(t.text, '') as text, t.j, t.source, row_number() over (partition by cm.dialogue_id order by cm.created_at nulls first, cm.id) as pos from cm left join t on t.message_id = cm.id where cm.deleted_at is null and cm.role in ('user', 'assistant')), "
    "c(dialogue_id, pos, dyad, held) as (select dialogue_id, pos, 0, left(role, 1) from o where pos = 1 union all select o.dialogue_id, o.pos, case when c.held = 'ua' or length(c.held) > 2 then c.dyad + 1 else c.dyad end, case when c.held = 'ua' or length(c.held) > 2 then left(o.role, 1) else c.held || left(o.role, 1) end from c join o on o.dialogue_id = c.dialogue_id and o.pos = c.pos + 1), "
    "m as (select o.*, c.dyad from o join c on c.dialogue_id = o.dialogue_id and c.pos = o.pos)"
)
MERGED = (
    DYADS
    + ", f as (select dialogue_id, dyad, (list(text order by pos) filter (where role = 'user'))[1] as ft from m group by 1, 2), "
    "k as (select dialogue_id, dyad, case when dyad = 0 or not coalesce(ft in ('continue', 'more', 'keep going', 'go on', 'next', 'tell me more', 'expand', 'keep writing', 'finish') or (starts_with(ft, '>') and contains(ft, chr(10)) and lower(trim(split_part(ft, chr(10), -1))) = 'elaborate') or (len(list_filter(regexp_split_to_array(ft, '\\s+'), lambda w: w <> '')) <= 3 and regexp_matches(ft, '^(continue|more|keep going|go on|next|tell me more|expand|keep writing|finish|elaborate|do go on|make it so|yes|please|do it)')), false) then 1 else 0 end as s from f), "
    "g as (select dialogue_id, dyad, (sum(s) over (partition by dialogue_id order by dyad) - 1)::int as exchange from k), "
    "e as (select m.*, g.exchange from m join g on g.dialogue_id = m.dialogue_id and g.dyad = m.dyad)"
)


@query("with " + TURNS + " select message_id, source, text from t")
def turn_texts(s, d):
    """Texts of messages by their platform's rule."""
    return _turns(s, d).select("message_id", "source", "text")


@query(DYADS + " select id as message_id, dyad from m")
def exchange_dyads(s, d):
    """Messages with their dyad."""
    return exchanges.chunk(_turns(s, d)).select("message_id", "dyad")


@query(MERGED + " select dialogue_id, exchange, count(*) filter (where role = 'user') as n_user, count(*) filter (where role = 'assistant') as n_assistant, count(distinct dyad) as n_dyads, count(*) filter (where role = 'user') > 1 as has_continuations, string_agg(id, ',' order by created_at nulls first, id) as message_ids from e group by 1, 2")
def exchange_rows(s, d):
    """Exchanges after merging continuations."""
    rows = exchanges.exchanges(exchanges.merge(exchanges.chunk(_turns(s, d))))
    return rows.select("dialogue_id", "exchange", "n_user", "n_assistant", "n_dyads", "has_continuations", F.array_join("message_ids", ",").alias("message_ids"))


def _any(text: str, marks) -> str:
    return "(" + " or ".join(f"contains({text}, '{m}')" for m in marks) + ")"


def _path(*paths: str) -> str:
    return "(" + " or ".join(f"coalesce(json_extract(j, '{p}')::varchar not in ('null', 'false', '0', '\"\"', '[]', '{{}}'), false)" for p in paths) + ")"


_USER, _ASSISTANT = "role = 'user'", "role = 'assistant'"
_STRUCTURE = "((contains(text, 'def ') and contains(text, '(') and contains(text, ':') and contains(text, 'return')) or (contains(text, 'class ') and contains(text, '(') and contains(text, ':') and contains(text, 'def ')) or ((contains(text, 'function(') or contains(text, 'function ')) and contains(text, '{') and contains(text, '}')) or (length(text) - length(replace(text, '=', '')) >= 3 and (contains(text, 'let ') or contains(text, 'const ') or contains(text, 'var '))))"
# Rules that hold for an exchange if they hold for one of its messages.
RULES = {
    "has_github_repos": _path("$.metadata.selected_github_repos"),
    "has_canvas_operations": _path("$.metadata.canvas"),
    "has_web_search": _path("$.metadata.search_queries", "$.metadata.search_result_groups", "$.metadata.content_references"),
    "has_reasoning_thoughts": _path("$.content.thoughts"),
    "has_code_execution": _path("$.metadata.aggregate_result", "$.metadata.jupyter_messages"),
    "has_code_blocks": "contains(text, '```')",
    "has_script_headers": _any("text", exchanges.SCRIPT_MARKS),
    "has_code_structure_patterns": _STRUCTURE,
    "user_has_quote_elaborate": f"({_USER} and starts_with(text, '>') and contains(text, chr(10)) and lower(trim(split_part(text, chr(10), -1))) = 'elaborate')",
    "user_has_attachments": f"({_USER} and {_path('$.metadata.attachments')})",
    "assistant_has_reasoning": f"({_ASSISTANT} and {_path('$.content.thoughts')})",
    "has_wiki_links": rf"({_ASSISTANT} and regexp_matches(text, '\[\[.+?\]\]'))",
    "has_latex_math": rf"({_ASSISTANT} and (regexp_matches(text, '\$\$.+?\$\$|\\\(.+?\\\)|\\\[.+?\\\]') or {_any('text', exchanges.LATEX_MARKS)}))",
    "has_large_content": "length(text) > 2000",
    "has_function_definitions": _any("text", ("def ", "function ", "class ")),
    "has_import_statements": _any("text", ("import ", "from ", "require(")),
    "has_high_keyword_density": "(length(text) > 1000 and " + " + ".join(f"contains(lower(text), '{w}')::int" for w in exchanges.DENSITY_WORDS) + " >= 5)",
    "user_has_code_blocks": f"({_USER} and contains(text, '```'))",
    "user_has_error_messages": f"({_USER} and {_any('lower(text)', exchanges.ERROR_MARKS)})",
}
_FILE = "lower(coalesce(x->>'name', ''))", "lower(coalesce(x->>'mime_type', ''))"
FIRSTS = {
    "first_user_has_large_content": f"length({_STRIP.format('text')}) > 2000",
    "first_user_has_code_patterns": _any("text", exchanges.CODE_MARKS),
    "first_user_has_attachments": _path("$.metadata.attachments"),
    "first_user_has_code_attachments": f"coalesce(len(list_filter(json_extract(j, '$.metadata.attachments[*]'), lambda x: {_any(_FILE[0], exchanges.CODE_ENDINGS)} or {_any(_FILE[1], exchanges.CODE_MIMES)})) > 0, false)",
}
_LENGTH = "case when {0} < {1} then 'very_short' when {0} < {2} then 'short' when {0} < {3} then 'medium' when {0} < {4} then 'long' else 'very_long' end"
_TOP = f"split_part({_STRIP.format('text')}, chr(10), 1)"
_CODE_RULES = " or ".join(("has_code_blocks", "has_function_definitions", "has_import_statements", "has_script_headers", "has_code_structure_patterns", "has_high_keyword_density"))
FEATURES = (
    MERGED
    + ", ef as (select *, "
    + ", ".join(f"{sql} as {name}" for name, sql in (RULES | FIRSTS).items())
    + f", case when starts_with({_TOP}, '#') then {_STRIP.format(f'replace({_TOP}, chr(35), chr(32))').replace('chr(32))', chr(39) * 2 + ')', 1)} when starts_with({_TOP}, '**') and ends_with({_TOP}, '**') then {_STRIP.format(f'replace({_TOP}, chr(42) || chr(42), {chr(39) * 2})')} end as heading from e), "
    + "eg as (select dialogue_id, exchange, "
    + ", ".join(f"bool_or({name}) as {name}" for name in RULES)
    + ", "
    + ", ".join(f"coalesce((list({name} order by pos) filter (where {_USER}))[1], false) as {name}" for name in FIRSTS)
    + f", (list(heading order by pos) filter (where {_ASSISTANT}))[1] as proposed_title, coalesce(array_to_string(list_sort(list(distinct nullif(j->'metadata'->>'gizmo_id', '')) filter (where nullif(j->'metadata'->>'gizmo_id', '') is not null)), ','), '') as gizmos, coalesce(array_to_string(list_sort(list_distinct(list_concat(list(nullif(j->'metadata'->'invoked_plugin'->>'plugin_id', '')), list(nullif(j->'metadata'->'invoked_plugin'->>'namespace', ''))))), ','), '') as plugins"
    + f", count(*) filter (where {_USER}) as n_user, count(*) filter (where {_ASSISTANT}) as n_assistant, coalesce(sum(length(text)) filter (where {_USER}), 0)::bigint as user_length, coalesce(sum(length(text)) filter (where {_ASSISTANT}), 0)::bigint as assistant_length, max(source) as source"
    + f", bool_or(contains(text, '[[') or ({_USER} and (contains(lower(text), 'write an article') or contains(lower(text), 'create a wiki')))) as wiki, bool_or({_ASSISTANT} and contains(text, '# ')) as headed from ef group by 1, 2), "
    + f"ft as (select * exclude (wiki, headed), n_user > 1 as user_is_continuation, ({_CODE_RULES}) as has_code_patterns, (has_code_blocks or has_script_headers or has_code_structure_patterns) as is_coding_focused, (wiki or (assistant_length > 1000 and headed)) as is_wiki_focused, (user_has_error_messages and n_assistant > 0) as has_error_resolution, case when n_user > 1 then 'multi_turn' when user_length > 2000 then 'context_heavy' when assistant_length > 3000 then 'detailed_response' when user_length < 50 and assistant_length < 200 then 'quick_qa' else 'standard' end as interaction_pattern, {_LENGTH.format('user_length', 50, 200, 1000, 3000)} as user_length_category, {_LENGTH.format('assistant_length', 100, 500, 2000, 5000)} as assistant_length_category from eg)"
)


@query(FEATURES + " select * from ft")
def exchange_features(s, d):
    """All rules of each exchange (R1-R22 and the older rules)."""
    return _exchange_rules(s, d).withColumn("gizmos", F.array_join("gizmos", ",")).withColumn("plugins", F.array_join("plugins", ","))


@query(MERGED + ", x as (select dialogue_id, exchange, count(*) filter (where role = 'user') > 1 as more from e group by 1, 2), cx as (select dialogue_id, bool_or(more) as has_continuations, count(*) as exchange_count from x group by 1) select e.dialogue_id, any_value(cx.exchange_count) as exchange_count, count(*) as total_messages, count(*) filter (where role = 'user') as total_user_messages, count(*) filter (where role = 'assistant') as total_assistant_messages, coalesce(string_agg(text, ' ' order by pos) filter (where role = 'user'), '') as user_text, coalesce(string_agg(text, ' ' order by pos) filter (where role = 'assistant'), '') as assistant_text, any_value(cx.has_continuations) as has_continuations from e join cx using (dialogue_id) group by 1")
def conversation_totals(s, d):
    """Counts and joined texts of each dialogue."""
    return exchanges.conversation_totals(exchanges.merge(exchanges.chunk(_turns(s, d))))


@query(MERGED + ", n as (select dialogue_id, count(distinct exchange) as exchange_count from e group by 1) select dialogue_id, exchange_count, case when exchange_count = 1 then 'single' when exchange_count <= 3 then 'short' when exchange_count <= 10 then 'medium' when exchange_count <= 25 then 'long' else 'very_long' end as category from n")
def conversation_lengths(s, d):
    """Exchanges per dialogue and their category."""
    return exchanges.conversation_length(_exchange_rules(s, d))


_USED = [f"case when {f} then '{f}' end" for f in exchanges.FEATURES] + ["case when gizmos <> '' then 'has_gizmo_usage' end", "case when plugins <> '' then 'has_plugin_usage' end"]


@query(FEATURES + f", u as (select dialogue_id, unnest([{', '.join(_USED)}]) as feature from ft), n as (select dialogue_id, count(*) as k from ft group by 1) select u.dialogue_id, feature, count(*) as exchange_count, n.k as total_exchanges, round_even(100.0::double * count(*) / n.k, 1) as percentage from u join n using (dialogue_id) where feature is not null group by 1, 2, 4")
def feature_summary(s, d):
    """Share of exchanges with each feature."""
    return exchanges.feature_summary(_exchange_rules(s, d))


@query(FEATURES + ", gz as (select dialogue_id, unnest(string_split(gizmos, ',')) as z from ft where gizmos <> '') select dialogue_id, count(distinct z) as n_unique, count(*) as total_usage, string_agg(distinct z, ',' order by z) as names from gz group by 1")
def gizmo_usage(s, d):
    """Gizmos of each dialogue."""
    return exchanges.usage_summary(_exchange_rules(s, d), "gizmos").withColumn("names", F.array_join("names", ","))


@query(
    "with "
    + TURNS
    + ", u as (select cm.dialogue_id, length(coalesce(t.text, '')) as n from cm left join t on t.message_id = cm.id where cm.deleted_at is null and cm.role = 'user')"
    + ", q as (select dialogue_id, count(*) as k, sum(n)::double / count(*) as a, median(n) as md, (count(*) * sum(n * n) - sum(n) * sum(n))::double / (count(*) * count(*)) as v from u group by 1) select dialogue_id, k as prompt_count, round_even(a, 1) as mean_length, round_even(md, 1)::double as median_length, round_even(v, 1) as variance, case when a < 50 then 'very_short' when a < 200 then 'short' when a < 1000 then 'medium' when a < 3000 then 'long' else 'very_long' end as length_category, case when v < 1000 then 'consistent' when v < 10000 then 'mixed' else 'variable' end as consistency from q"
)
def prompt_stats(s, d):
    """Count, mean, median and spread of a dialogue's prompt lengths."""
    return exchanges.prompt_stats(_turns(s, d))


@query(_lines(CURRENT_D, "x as (select coalesce(extract(year from created_at)::varchar, '<none>') as facet from cd)", "select facet, count(*) as n_dialogues, round(100.0 * count(*) / (select count(*) from x), 1)::double as share from x group by 1"))
def facet_years(s, d):
    """Dialogues by the year of their first load."""
    rows = _dialogues(s, d).select(F.col("id").alias("dialogue_id"), F.lit("loaded").alias("name"), F.lit("year").alias("attribute"), F.year("created_at").cast("string").alias("value"), F.lit(None).cast("double").alias("number"))
    return facets.facet_sizes(facets.facet_values(rows, rows.where("value is not null"), "loaded", "year"))


@query(
    _lines(
        CURRENT_D,
        "x as (select coalesce(substr(title, 1, 3), '') as f from cd)",
        "c as (select f, count(*) as n, row_number() over (order by count(*) desc, f) as r, count(*) over () as k from x group by 1)",
        "select case when k > 10 and r >= 10 then '<other>' else f end as facet, sum(n)::bigint as n from c group by 1",
    )
)
def facet_top(s, d):
    """The largest facets and the rest as one."""
    rows = _dialogues(s, d).select(F.col("id").alias("dialogue_id"), F.coalesce(F.substring("title", 1, 3), F.lit("")).alias("facet"))
    return facets.top_facets(rows, 10).groupBy("facet").agg(F.count(F.lit(1)).alias("n"))


def _faceted(s, d):
    annotated = _annotated(s, d)
    return facets.facet_values(annotated, annotated, "conversation_length", "category"), annotated


@query()
def faceted_summary(s, d):
    """Annotations per length category."""
    faceted, annotated = _faceted(s, d)
    return facets.faceted_summary(faceted, annotated)


@query(FEATURES + ", n as (select dialogue_id, count(*) as k, bool_or(has_code_blocks) as code from ft group by 1), u as (select cm.dialogue_id, length(coalesce(t.text, '')) as n from cm left join t on t.message_id = cm.id where cm.deleted_at is null and cm.role = 'user'), q as (select dialogue_id, (count(*) * sum(n * n) - sum(n) * sum(n))::double / (count(*) * count(*)) as v from u group by 1) select n.dialogue_id from n join q using (dialogue_id) where k >= 3 and v < 10000 and not code")
def tag_filter(s, d):
    """Dialogues by structured tags."""
    annotated = _annotated(s, d)
    wanted = [facets.tag_matches("conversation_length", exchange_count__gte=3), facets.tag_matches("prompt_stats", consistency__in=["consistent", "mixed"])]
    return facets.filter_by_tags(annotated.select("dialogue_id").distinct(), annotated, wanted, [facets.tag_matches("has_code_blocks")])


def _tagged(s, d):
    return facets.with_derived_tags(facets.tag_table(_annotated(s, d)))


@query()
def derived_tags(s, d):
    """Base and derived tags of dialogues."""
    return facets.tag_rows(_tagged(s, d))


@query()
def tag_summary(s, d):
    """Dialogues per tag."""
    tags = _tagged(s, d)
    return facets.tag_summary(facets.tag_rows(tags), tags)


@query()
def facet_comparison(s, d):
    """Tags that differ between length categories."""
    faceted, annotated = _faceted(s, d)
    return facets.compare_facets(faceted, facets.tag_rows(facets.with_derived_tags(facets.tag_table(annotated))))


@query()
def tag_diff(s, d):
    """Base against derived tags, as two runs."""
    tags = facets.tag_table(_annotated(s, d))
    return facets.distribution_diff(facets.tag_rows(tags), facets.tag_rows(facets.with_derived_tags(tags)))


@query()
def code_report(s, d):
    """Evidence behind code tags."""
    return facets.code_report(_tagged(s, d))


@query(MERGED + ", n as (select count(distinct exchange) as k from e group by dialogue_id) select distinct case when k = 1 then 'single' when k <= 3 then 'short' when k <= 10 then 'medium' when k <= 25 then 'long' else 'very_long' end as value from n")
def length_values(s, d):
    """Values of a tag's attribute."""
    return facets.tag_values(_annotated(s, d), "conversation_length", "category")


def _notes(s, d):
    merged = exchanges.merge(exchanges.chunk(_turns(s, d)))
    titles = _dialogues(s, d).select(F.col("id").alias("dialogue_id"))
    rules = exchanges.exchange_rules(merged).select("dialogue_id", "exchange", "proposed_title", "source")
    ids = exchanges.exchanges(merged).select("dialogue_id", "exchange", "exchange_id")
    rows = rules.join(ids, ["dialogue_id", "exchange"]).join(titles, "dialogue_id", "left_semi").withColumn("title", F.lit(None).cast("string"))
    return notes.notes_of(merged, rows)


@query()
def note_titles(s, d):
    """Titles of notes with those before and after."""
    return _notes(s, d).select("dialogue_id", "exchange", "title", "previous_title", "next_title")


@query()
def note_texts(s, d):
    """Merged and linked notes with their front matter."""
    linked = notes.wikilinkify(notes.merge_titles(_notes(s, d)))
    return linked.select("dialogue_id", "title", F.concat(notes.front_matter(linked), "content").alias("note"))


@query(_lines(CURRENT_D, r"select id, trim(lower(left(case when lower(regexp_replace(title, '[<>:\"/\\|?*\[\]]', '', 'g')) like 'the %' then substr(regexp_replace(title, '[<>:\"/\\|?*\[\]]', '', 'g'), 5) else regexp_replace(title, '[<>:\"/\\|?*\[\]]', '', 'g') end, 200))) as file_name from cd where title is not null"))
def file_names(s, d):
    """Titles as file names."""
    return _dialogues(s, d).where("title is not null").select("id", notes.sanitize(F.col("title")).alias("file_name"))


