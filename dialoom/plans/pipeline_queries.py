"""The queries of the general training-data problems (2 to 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import current_rows, ref_key
from ..operators import drift, hierarchy, nested, orphans
from ..session import materialize
from .tables import table


def _message_edges(spark: SparkSession, d: str) -> DataFrame:
    rows = current_rows(table(spark, d, "messages"), "id", ["dialogue_id", "parent_id"])
    return materialize(rows.select(F.coalesce(ref_key("dialogue_id"), F.lit("")).alias("scope"), F.col("id_key").alias("node"), ref_key("parent_id").alias("parent")), "edges")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Root, depth and descendants of each message in its dialogue."""
    got = hierarchy.build_hierarchy(_message_edges(spark, d))
    return got.select(F.col("node").alias("message_id"), F.col("root_node").alias("root_id"), "node_depth", F.col("n_descendants").cast("int").alias("n_descendants"))


def p2_paths(spark: SparkSession, d: str) -> DataFrame:
    """Full path of each message; empty on and below cycles."""
    got = hierarchy.build_hierarchy(_message_edges(spark, d), paths=True)
    return got.select(F.col("node").alias("message_id"), F.array_join("path", "/").alias("path"), "node_depth", "back_edge")


def p2_ranges(spark: SparkSession, d: str) -> DataFrame:
    """All descendants of each message as a range of places in its component."""
    got = hierarchy.descendant_ranges(hierarchy.build_hierarchy(_message_edges(spark, d)))
    return got.withColumnRenamed("node", "message_id").select("component", "message_id", "place", *[F.when(F.col("first") <= F.col("last"), F.col(c)).otherwise(-1).alias(c) for c in ("first", "last")])


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All (ancestor, descendant, distance) links of the message trees."""
    return hierarchy.descendants(hierarchy.build_hierarchy(_message_edges(spark, d), paths=True))


def p2_descendants_all(spark: SparkSession, d: str) -> DataFrame:
    """The same with the links on and below cycles; as many rows as n_descendants."""
    edges = _message_edges(spark, d)
    got = materialize(hierarchy.build_hierarchy(edges, paths=True), "hierarchy")
    return hierarchy.descendants(got).unionByName(hierarchy.cycle_descendants(edges, got))


def _owners(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name in ("dialogues", "messages"):
        rows = current_rows(table(spark, d, name), "id", ["id", "source_json"]).select(F.lit(name).alias("owner_table"), F.col("id").alias("owner_id"), "source_json")
        out = rows if out is None else out.unionByName(rows)
    return out


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every JSON object in an array, with the record that encloses it."""
    return nested.flatten_records(_owners(spark, d), ["owner_table", "owner_id"], "source_json").select("owner_table", "owner_id", "record_path", "parent_path")


def _target(name: str):
    """The flat table of one kind of nested record."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        return nested.target_tables(_owners(spark, d), ["owner_table", "owner_id"], "source_json", {name: nested.TARGETS[name]})[name]

    query.__doc__ = f"Flat table of the records under {name}, with the enclosing record."
    return query


#: Query -> the key of its records' array.
P3_TARGETS = {"p3_citations": "citations", "p3_attachments": "attachments", "p3_files": "files", "p3_search_groups": "search_result_groups", "p3_search_entries": "entries", "p3_code_outputs": "messages", "p3_contents": "content", "p3_parts": "parts", "p3_chat_messages": "chat_messages"}


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(message refs, messages, tool refs, tools), reduced to what is compared."""
    messages = materialize(current_rows(table(spark, d, "messages"), "id", ["id", "parent_id", "created_at", "deleted_at"]), "messages")
    targets = messages.select(F.col("id_key").alias("target"), F.col("created_at").alias("made"), F.col("deleted_at").isNotNull().alias("gone"))
    row = lambda name, df, key, time: df.select(F.lit(name).alias("ref_table"), F.col("id").alias("ref_id"), ref_key(key).alias("ref"), F.col(time).alias("at"))
    pairs = table(spark, d, "prompt_responses").select("id", "prompt_message_id", "created_at").dropDuplicates(["id"])
    refs = row("prompt_responses", pairs, "prompt_message_id", "created_at").unionByName(row("messages", messages.where("deleted_at is null"), "parent_id", "created_at"))
    parts = (
        table(spark, d, "content_parts")
        .where(ref_key("tool_use_id").isNotNull())
        .select("id", ref_key("message_id").alias("message_key"), ref_key("tool_use_id").alias("tool_use_id"), ref_key("tool_name").isNotNull().alias("is_call"))
        .dropDuplicates(["id"])
    )
    parts = parts.join(targets, F.col("message_key") == F.col("target"), "left")
    parts = materialize(parts.select("id", "tool_use_id", "is_call", "made", F.coalesce("gone", F.lit(False)).alias("gone")), "parts")
    tools = parts.where("is_call").select(F.col("tool_use_id").alias("target"), "made", "gone")
    tool_refs = row("content_parts", parts.where("not is_call and not gone"), "tool_use_id", "made")
    return refs, targets, tool_refs, tools


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table and month."""
    refs, targets, tool_refs, tools = _references(spark, d)
    found = orphans.classify_orphans(refs, targets, "ref", "target", "at", "made", "gone").unionByName(orphans.classify_orphans(tool_refs, tools, "ref", "target", "at", "made", "gone"))
    return found.select("ref_table", "ref_id", "orphan_kind", F.coalesce(F.date_format("at", "yyyy-MM"), F.lit("")).alias("ref_month"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans counted per table, month and kind."""
    return orphans.orphan_report(p4_found(spark, d), "ref_table", "orphan_kind", "ref_month")


def p4_scoped(spark: SparkSession, d: str) -> DataFrame:
    """Composite references (dialogue, parent) without a message, partial match."""
    rows = current_rows(table(spark, d, "messages"), "id", ["id", "dialogue_id", "parent_id"])
    rows = materialize(rows.select("id", "id_key", ref_key("dialogue_id").alias("dialogue_key"), ref_key("parent_id").alias("parent_key")), "scoped")
    got = orphans.find_missing(rows.where("parent_key is not null"), rows.select(F.col("dialogue_key").alias("t_dialogue"), F.col("id_key").alias("t_id")), ["dialogue_key", "parent_key"], ["t_dialogue", "t_id"], "partial")
    return got.select(F.col("id").alias("message_id"), "null_mask")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Every schema change between consecutive exports of an account."""
    return drift.schema_changes(table(spark, d, "dialogues"), table(spark, d, "content_parts"), table(spark, d, "exports"))


def _named_fields(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, str], DataFrame]:
    rows = table(spark, d, "dialogues").select("export_id", F.col("id").alias("dialogue_id"), "updated_at", "source_json")
    fields = materialize(drift.fields_of(rows, ["export_id", "dialogue_id"], "source_json"), "fields")
    exports = table(spark, d, "exports")
    changes = materialize(drift.field_changes(fields, exports), "changes")
    return rows, drift.canonical_names(changes, fields), drift.field_names(fields, changes, exports)


def p5_table(spark: SparkSession, d: str) -> DataFrame:
    """All dialogue files as one table of typed branches."""
    rows, names, present = _named_fields(spark, d)
    renames = spark.createDataFrame(sorted((now, old) for old, now in names.items()), "field_name string, prior_name string")
    return drift.consistent_table(rows, ["export_id", "dialogue_id"], "source_json", renames, present)


def p5_wide(spark: SparkSession, d: str) -> DataFrame:
    """All dialogue files as one table with a column per field."""
    rows, names, present = _named_fields(spark, d)
    return drift.wide_table(rows, ["export_id", "dialogue_id", "updated_at"], "source_json", names, present)


def p5_parts(spark: SparkSession, d: str) -> DataFrame:
    """All content parts with the present name of their part_type."""
    return drift.part_table(table(spark, d, "content_parts"), table(spark, d, "exports")).select("id", "export_id", "part_type", F.coalesce("shape", F.lit("")).alias("shape"), F.coalesce("canonical", F.lit("")).alias("canonical"))


def p5_union(spark: SparkSession, d: str) -> DataFrame:
    """The fused schema of all dialogue files with its alternatives."""
    return drift.union_schema(table(spark, d, "dialogues"), "source_json")


def p5_paths(spark: SparkSession, d: str) -> DataFrame:
    """The same at all depths."""
    return drift.union_paths(table(spark, d, "dialogues"), "source_json")


QUERIES = {f.__name__: f for f in (p2_found, p2_paths, p2_ranges, p2_descendants, p2_descendants_all, p3_found, p4_found, p4_report, p4_scoped, p5_found, p5_table, p5_wide, p5_parts, p5_union, p5_paths)} | {name: _target(target) for name, target in P3_TARGETS.items()}

_KEY = "nullif(lower(trim({0}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))), '')"
_CURRENT = "cm as (select * from (select *, row_number() over (partition by id order by updated_at desc) rn from messages) where rn = 1)"
_EDGES = f"e as (select coalesce({_KEY.format('dialogue_id')}, '') as scope, {_KEY.format('id')} as id, {_KEY.format('parent_id')} as parent from cm), m as (select e.id, p.id as parent from e left join e p on p.scope = e.scope and p.id = e.parent)"
_DOWN = "t(id, root, depth) as (select id, id, 0 from m where parent is null union all select m.id, t.root, t.depth + 1 from t join m on m.parent = t.id)"
# All links, the cycles' smallest nodes, and the trees after cutting there.
_REACH = "r(a, d) as (select parent, id from m where parent is not null union select r.a, m.id from r join m on m.parent = r.d)"
_TREES = f"{_REACH}, low as (select x.a as id, min(x.d) as low from r x join r y on y.a = x.d and y.d = x.a group by 1), cut as (select m.id, case when low.low = m.id then null else m.parent end as parent from m left join low on low.id = m.id), t(id, root, path) as (select id, id, [id] from cut where parent is null union all select c.id, t.root, list_append(t.path, c.id) from t join cut c on c.parent = t.id), g as (select t.*, low.id is not null as on_ring, exists (select 1 from low l where l.id = t.root) as cyclic from t left join low on low.id = t.id)"
_ORPHANS = f"""with {_CURRENT},
  target as (select {_KEY.format('id')} as k, created_at as made, deleted_at is not null as gone from cm),
  cp as (select distinct id, message_id, tool_name, tool_use_id from content_parts),
  parts as (select cp.id, {_KEY.format('tool_use_id')} as use, {_KEY.format('tool_name')} is not null as is_call, t.made, coalesce(t.gone, false) as gone from cp left join target t on t.k = {_KEY.format('message_id')}),
  refs as (
    select distinct 'prompt_responses' as ref_table, id as ref_id, {_KEY.format('prompt_message_id')} as k, created_at as made, 0 as tool from prompt_responses
    union all select 'messages', id, {_KEY.format('parent_id')}, created_at, 0 from cm where deleted_at is null
    union all select 'content_parts', id, use, made, 1 from parts where not is_call and not gone),
  targets as (select k, 0 as tool, made, gone from target union all select use, 1, made, gone from parts where is_call and use is not null),
  best as (select k, tool, bool_and(gone) as all_gone, min(made) filter (where not gone) as first from targets group by 1, 2),
  found as (
    select r.ref_table, r.ref_id, case when b.k is null then 'missing' when b.all_gone then 'deleted' when b.first > r.made then 'late' end as orphan_kind, strftime(r.made, '%Y-%m') as ref_month
    from refs r left join best b on b.k = r.k and b.tool = r.tool where r.k is not null)"""
_JSON_TYPE = "case json_type(x) when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'NULL' then null else 'number' end"
_RECORD = ", ".join(f"'{k}'" for k in nested.RECORD_KEYS)
_OWN = "case when json_type(j) = 'OBJECT' and how = 2 then path || '[0]' else path end"
_IS = "(json_type(j) = 'OBJECT' and how > 0)"
# A string that is the text of an object or array is read as that.
_READ = "case when json_type(x) = 'VARCHAR' and left(trim(x->>'$', chr(32) || chr(9) || chr(10) || chr(13)), 1) in ('{', '[') and json_valid(x->>'$') then json(x->>'$') else x end"
# how: 0 plain value, 1 element of an array, 2 value of a record key
_WALK = f"""with recursive {_CURRENT}, {_CURRENT.replace('cm as', 'cd as').replace('from messages', 'from dialogues')},
  o as (select 'dialogues' as t, id, source_json from cd union all select 'messages', id, source_json from cm),
  n(t, id, path, owner, how, key, j) as (
    select t, id, '', '', 0, '', json(source_json) from o where json_valid(source_json)
    union all
    select t, id, p, ow, h, k, {_READ} from (
      select t, id, case when {_OWN} = '' then c.k else {_OWN} || '.' || c.k end as p, case when {_IS} then {_OWN} else owner end as ow, case when c.k in ({_RECORD}) then 2 else 0 end as h, c.k as k, json_extract(j, '$."' || c.k || '"') as x
      from n, lateral (select unnest(json_keys(n.j)) as k) c where json_type(j) = 'OBJECT'
      union all
      select t, id, path || '[' || c.i || ']', owner, 1, key, json_extract(j, '$[' || c.i || ']')
      from n, lateral (select unnest(range(json_array_length(n.j)::bigint)) as i) c where json_type(j) = 'ARRAY') as y),
  r as (select t as owner_table, id as owner_id, {_OWN} as record_path, owner as parent_path, key, j from n where {_IS})"""
_JSON_AS = {"string": "json_extract_string(j, '$.{0}')", "bigint": "case when json_type(j, '$.{0}') in ('BIGINT', 'UBIGINT') then (j->>'$.{0}')::bigint end", "boolean": "case when json_type(j, '$.{0}') = 'BOOLEAN' then (j->>'$.{0}')::boolean end"}


def _target_sql(target: str) -> str:
    """The flat table of one target."""
    fields = []
    for f in nested.TARGETS[target].split(", "):
        name, kind = f.split()
        fields.append(f"{_JSON_AS[kind].format(name)} as {name}")
    return _WALK + f" select owner_table, owner_id, record_path, parent_path, {', '.join(fields)} from r where key = '{target}'"


_SHAPES = f"""ex as (select distinct export_id, account_key, seq from exports),
  sp as (select id, export_id, part_type, case when trim(coalesce(tool_name, '')) <> '' then 'tool_name' when trim(coalesce(tool_use_id, '')) <> '' then 'tool_use_id' when trim(coalesce(language, '')) <> '' then 'language' when trim(coalesce(media_type, '')) <> '' then 'media_type' end as shape, {_KEY.format('part_type')} as value from content_parts),
  sets as (select export_id, shape, list(distinct value) as now from sp where shape is not null and value is not null group by 1, 2),
  st as (select s.export_id, s.shape, ex.account_key, ex.seq, s.now, lag(s.now) over (partition by ex.account_key, s.shape order by ex.seq, s.export_id) as was from sets s join ex using (export_id)),
  sc as (select export_id, shape, account_key, seq, list_filter(now, lambda x: not list_contains(was, x)) as new, list_filter(was, lambda x: not list_contains(now, x)) as gone from st where was is not null)"""
_DRIFT = f"""d as (select export_id, id as did, json(source_json) as j from dialogues where json_valid(source_json) and export_id is not null and id is not null),
  ks as (select export_id, did, unnest(json_keys(j)) as k, j from d where json_type(j) = 'OBJECT'),
  f1 as (select export_id, did, k as field, json_extract(j, '$."' || k || '"') as x from ks),
  f2 as (select export_id, did, field, x, unnest(json_keys(x)) as k from f1 where json_type(x) = 'OBJECT' and field <> 'mapping'),
  fv as (select export_id, did, field, x from f1 union all select export_id, did, field || '.' || k, json_extract(x, '$."' || k || '"') from f2),
  t as (select export_id, did, field, {_JSON_TYPE} as type, x::varchar as val from fv where json_type(x) <> 'NULL'),
  pe as (select export_id, lag(export_id) over (partition by account_key order by seq, export_id) as prior from ex),
  fs as (select export_id, field, string_agg(distinct type, ',' order by type) as types from t group by 1, 2),
  now as (select pe.export_id, fs.field, fs.types from pe join fs using (export_id) where prior is not null),
  was as (select pe.export_id, fs.field, fs.types from pe join fs on fs.export_id = pe.prior),
  new as (select export_id, field from now n where not exists (select 1 from was w where w.export_id = n.export_id and w.field = n.field)),
  gone as (select export_id, field from was w where not exists (select 1 from now n where w.export_id = n.export_id and w.field = n.field)),
  old as (select distinct g.export_id, g.field as prior_name, t.did, t.type || t.val as val from gone g join pe using (export_id) join t on t.export_id = pe.prior and t.field = g.field where g.export_id in (select export_id from new) and exists (select 1 from t s where s.export_id = g.export_id and s.did = t.did)),
  fresh as (select distinct n.export_id, n.field as field_name, t.did, t.type || t.val as val from new n join t using (export_id, field)),
  n_old as (select export_id, prior_name, count(*) as k from old group by 1, 2),
  same as (select o.export_id, o.prior_name, f.field_name, count(*) as k from old o join fresh f on f.export_id = o.export_id and f.did = o.did and f.val = o.val group by 1, 2, 3),
  rn as (select s.export_id, s.field_name, s.prior_name from same s join n_old using (export_id, prior_name, k))"""
_CHANGES = """ select export_id, 'renamed' as change_kind, field_name, prior_name from rn
  union all select export_id, 'added', field, '' from new n where not exists (select 1 from rn where rn.export_id = n.export_id and rn.field_name = n.field)
  union all select export_id, 'removed', field, '' from gone g where not exists (select 1 from rn where rn.export_id = g.export_id and rn.prior_name = g.field)
  union all select n.export_id, 'retyped', n.field, '' from now n join was w using (export_id, field) where n.types <> w.types
  union (select export_id, 'renamed', 'part_type=' || new[1], 'part_type=' || gone[1] from sc where len(new) = 1 and len(gone) = 1
    union select export_id, 'added', 'part_type=' || x, '' from (select export_id, unnest(new) as x from sc where not (len(new) = 1 and len(gone) = 1))
    union select export_id, 'removed', 'part_type=' || x, '' from (select export_id, unnest(gone) as x from sc where not (len(new) = 1 and len(gone) = 1)))"""
_PARTS = """ev as (select account_key, shape, seq, gone[1] as prior, new[1] as new from sc where len(new) = 1 and len(gone) = 1),
  nm(account_key, shape, seq, value, since, now) as (
    select distinct account_key, shape, seq, value, seq, value from sp join ex using (export_id) where shape is not null and value is not null
    union all select n.account_key, n.shape, n.seq, n.value, e.seq, e.new from nm n join ev e on e.account_key = n.account_key and e.shape = n.shape and e.prior = n.now and e.seq > n.since and not exists (select 1 from ev x where x.account_key = n.account_key and x.shape = n.shape and x.prior = n.now and x.seq > n.since and x.seq < e.seq)),
  la as (select account_key, shape, seq, value, max_by(now, since) as now from nm group by 1, 2, 3, 4)"""
#: The same results in SQL; the other queries are compared with plain code in tests.
ORACLE: dict[str, str] = {
    "p2_found": f"with recursive {_CURRENT}, {_EDGES}, {_DOWN}, r(a, d) as (select parent, id from m where parent is not null union select r.a, m.id from r join m on m.parent = r.d), n as (select a, count(*) as k from r where a <> d group by 1) select m.id as message_id, coalesce(t.root, '') as root_id, coalesce(t.depth, -1)::int as node_depth, coalesce(n.k, 0)::int as n_descendants from m left join t on t.id = m.id left join n on n.a = m.id",
    "p2_paths": f"with recursive {_CURRENT}, {_EDGES}, {_TREES} select id as message_id, case when cyclic then '' else array_to_string(path, '/') end as path, case when cyclic then -1 else len(path) - 1 end::int as node_depth, cyclic and id = root as back_edge from g",
    "p2_ranges": f"with recursive {_CURRENT}, {_EDGES}, {_TREES}, n as (select a, count(*) as k from r where a <> d group by 1), o as (select root, id, on_ring, row_number() over (partition by root order by path) - 1 as place from g) select root as component, id as message_id, place::bigint as place, (case when n.k is null then -1 when on_ring then 0 else place + 1 end)::bigint as first, (case when n.k is null then -1 when on_ring then n.k else place + n.k end)::bigint as last from o left join n on n.a = o.id",
    "p2_descendants_all": f"with recursive {_CURRENT}, {_EDGES}, r(a, d, k, seen) as (select parent, id, 1, [parent] from m where parent is not null and parent <> id union all select r.a, m.id, r.k + 1, list_append(r.seen, r.d) from r join m on m.parent = r.d where not list_contains(r.seen, m.id) and m.id <> r.d) select a as ancestor, d as descendant, k::int as distance from r",
    "p2_descendants": f"with recursive {_CURRENT}, {_EDGES}, {_DOWN}, r(a, d, k) as (select parent, id, 1 from m where parent in (select id from t) union all select r.a, m.id, r.k + 1 from r join m on m.parent = r.d) select a as ancestor, d as descendant, k::int as distance from r",
    "p3_found": _WALK + " select owner_table, owner_id, record_path, parent_path from r",
    **{name: _target_sql(target) for name, target in P3_TARGETS.items()},
    "p4_found": _ORPHANS + " select * from found where orphan_kind is not null",
    "p4_report": _ORPHANS + " select ref_table, ref_month, orphan_kind, count(*) as n_orphans from found where orphan_kind is not null group by 1, 2, 3",
    "p5_found": f"with {_SHAPES}, {_DRIFT}{_CHANGES}",
    "p5_parts": f"with recursive {_SHAPES}, {_PARTS} select sp.id, sp.export_id, sp.part_type, coalesce(sp.shape, '') as shape, coalesce(la.now, sp.value, '') as canonical from sp left join ex using (export_id) left join la on la.account_key = ex.account_key and la.seq = ex.seq and la.shape = sp.shape and la.value = sp.value",
    "p5_union": f"with j as (select json(source_json) as j from dialogues where json_valid(source_json)), k as (select unnest(json_keys(j)) as k, j from j where json_type(j) = 'OBJECT'), a as (select k as field, json_extract(j, '$.\"' || k || '\"') as x from k), b as (select field, x, unnest(json_keys(x)) as k from a where json_type(x) = 'OBJECT' and field <> 'mapping'), v as (select field, x from a union all select field || '.' || k, json_extract(x, '$.\"' || k || '\"') from b), t as (select field, {_JSON_TYPE} as type from v) select field, type, count(*) as n_rows from t where type is not null group by 1, 2",
    "p5_paths": f"with recursive r as (select row_number() over () as i, json(source_json) as j from dialogues where json_valid(source_json)), n(i, path, x) as (select i, '', j from r union all select i, p, y from (select i, case when path = '' then '' else path || '.' end || case when path = 'mapping' then '*' else c.k end as p, json_extract(x, '$.\"' || c.k || '\"') as y from n, lateral (select unnest(json_keys(n.x)) as k) c where json_type(x) = 'OBJECT' union all select i, path || '[]', json_extract(x, '$[' || c.k || ']') from n, lateral (select unnest(range(json_array_length(n.x)::bigint)) as k) c where json_type(x) = 'ARRAY')), t as (select distinct i, path, {_JSON_TYPE} as type from n where path <> '') select path, type, count(*) as n_rows from t where type is not null group by 1, 2",
    "p4_scoped": f"with {_CURRENT}, e as (select id, {_KEY.format('dialogue_id')} as d, {_KEY.format('id')} as k, {_KEY.format('parent_id')} as p from cm) select id as message_id, '11' as null_mask from e where p is not null and d is not null and not exists (select 1 from e t where t.d = e.d and t.k = e.p) union all select id, '01' from e where p is not null and d is null and not exists (select 1 from e t where t.k = e.p)",
}
