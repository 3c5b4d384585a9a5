"""Schemas that drift between files.

Tagged-union inference: each file's objects are reduced to (path, type) pairs,
parallel schemas are fused by union and a path keeps all its types as
alternatives. Conflicting paths are split into typed branches with a canonical
conversion (``consistent_table``); consecutive files of an account are compared
and each appearing or vanishing alternative is reported (``schema_changes``).

Defined results: NULL values do not count as present; JSON that is NULL,
blank or no object has no fields; the first file of an account has no changes;
a file without rows has no fields, so its predecessor's count as removed;
repeated rows change nothing; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: JSON types; keys whose objects are data, not schema.
TYPES = ("string", "number", "boolean", "object", "array")
OPAQUE_KEYS = ("mapping",)


def json_type(value: Column) -> Column:
    """JSON type of a variant value; NULL for a JSON null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "VOID", None)
        .otherwise("number")
    )


def _opened(df: DataFrame, keys: list[str], json_column: str) -> DataFrame:
    return df.select(*keys, F.map_entries(F.from_json(json_column, "map<string,variant>")).alias("__e"))


def _present(values: bool) -> Column:
    """The present fields of opened JSON: field, type, digest (and value).

    Fields are the top-level keys and, as ``a.b``, the keys of top-level
    objects that are not opaque. ``digest`` identifies the value: equal JSON
    values have equal digests, key order aside.
    """

    def entry(name: Column, value: Column) -> Column:
        text = F.to_json(value)
        return F.struct(name.alias("field"), json_type(value).alias("type"), F.md5(text).alias("digest"), *([text.alias("value")] if values else []))

    def nested(e: Column) -> Column:
        inner = F.when(~e["key"].isin(*OPAQUE_KEYS), e["value"].try_cast("map<string,variant>"))
        return F.coalesce(F.transform(F.map_entries(inner), lambda x: entry(F.concat(e["key"], F.lit("."), x["key"]), x["value"])), empty)

    empty = F.array().cast("array<struct<field:string,type:string,digest:string" + (",value:string" if values else "") + ">>")
    both = F.concat(F.transform("__e", lambda e: entry(e["key"], e["value"])), F.flatten(F.transform("__e", nested)))
    return F.filter(both, lambda f: f["type"].isNotNull())


def fields_of(df: DataFrame, keys: list[str], json_column: str, values: bool = False) -> DataFrame:
    """One row per present field: keys, field, type, digest (and value).

    The array is made inside ``inline``: as a column of its own it would be
    made twice, once for the filter that is inferred from the generator.
    """
    return _opened(df, keys, json_column).select(*keys, F.inline(_present(values)))


def prior_exports(exports: DataFrame) -> DataFrame:
    """(export_id, account_key, seq, prior_id): the account's next lower seq."""
    w = Window.partitionBy("account_key").orderBy("seq", "export_id")
    return exports.select("export_id", "account_key", "seq").distinct().withColumn("prior_id", F.lag("export_id").over(w))


def _compared(present: DataFrame, pairs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per export and key the values of the export and of its predecessor."""
    now = present.join(pairs.where("prior_id is not null").select("export_id"), "export_id").select("export_id", *keys, F.col(value).alias("now"), F.lit(None).cast(present.schema[value].dataType).alias("was"))
    then = present.withColumnRenamed("export_id", "prior_id").join(pairs.where("prior_id is not null").select("export_id", "prior_id"), "prior_id")
    then = then.select("export_id", *keys, F.lit(None).cast(present.schema[value].dataType).alias("now"), F.col(value).alias("was"))
    return now.unionByName(then).groupBy("export_id", *keys).agg(F.max("now").alias("now"), F.max("was").alias("was"))


def field_changes(fields: DataFrame, exports: DataFrame) -> DataFrame:
    """Changes of JSON fields: export_id, change_kind, field_name, prior_name.

    ``fields`` has export_id, dialogue_id, field, type, digest.
    """
    pairs = prior_exports(exports)
    present = fields.groupBy("export_id", "field").agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))
    both = materialize(_compared(present, pairs, ["field"], "types").where("now is null or was is null or now <> was"), "drift")
    new, gone = both.where("was is null").select("export_id", "field"), both.where("now is null").select("export_id", "field")

    # a rename keeps the value of every shared dialogue that had the old field
    value = F.concat_ws(":", "type", "digest").alias("value")
    held = fields.select("export_id", "dialogue_id", "field", value).distinct()
    prior_of = pairs.where("prior_id is not null").select(F.col("export_id").alias("next_id"), F.col("prior_id").alias("export_id"))
    both_sided = gone.join(new.select("export_id").distinct(), "export_id", "left_semi")
    old = (
        held.join(prior_of, "export_id")
        .select(F.col("next_id").alias("export_id"), "dialogue_id", F.col("field").alias("prior_name"), "value")
        .join(both_sided.withColumnRenamed("field", "prior_name"), ["export_id", "prior_name"], "left_semi")
    )
    shared = fields.select("export_id", "dialogue_id").distinct()
    old = old.join(shared, ["export_id", "dialogue_id"], "left_semi")
    fresh = held.join(new, ["export_id", "field"], "left_semi").withColumnRenamed("field", "field_name")
    n_old = old.groupBy("export_id", "prior_name").agg(F.count(F.lit(1)).alias("n_old"))
    n_same = old.join(fresh, ["export_id", "dialogue_id", "value"]).groupBy("export_id", "prior_name", "field_name").agg(F.count(F.lit(1)).alias("n_same"))
    renamed = materialize(n_same.join(n_old, ["export_id", "prior_name"]).where("n_same = n_old").select("export_id", F.lit("renamed").alias("change_kind"), "field_name", "prior_name"), "renames")

    to = renamed.select("export_id", F.col("field_name").alias("field")).distinct()
    off = renamed.select("export_id", F.col("prior_name").alias("field")).distinct()
    plain = lambda df, kind: df.select("export_id", F.lit(kind).alias("change_kind"), F.col("field").alias("field_name"), F.lit("").alias("prior_name"))
    return (
        renamed.unionByName(plain(new.join(to, ["export_id", "field"], "left_anti"), "added"))
        .unionByName(plain(gone.join(off, ["export_id", "field"], "left_anti"), "removed"))
        .unionByName(plain(both.where("now is not null and was is not null"), "retyped"))
    )


def part_shape() -> Column:
    """The shape of a content part: the first of its marks that is given."""
    given = lambda c: F.trim(F.col(c)) != ""
    return F.when(given("tool_name"), "tool_name").when(given("tool_use_id"), "tool_use_id").when(given("language"), "language").when(given("media_type"), "media_type")


def _name(column: str) -> Column:
    """A value lower-cased and without blanks around it; blank is NULL."""
    return F.nullif(F.lower(F.trim(F.col(column), F.lit(" \t\n\r\f\x0b\xa0"))), F.lit(""))


def _shape_changes(parts: DataFrame, exports: DataFrame, column: str) -> DataFrame:
    """export_id, shape, change_kind, to, off: changes of the values of ``column``.

    A shape is compared with the account's nearest earlier export that has it.
    """
    sets = parts.select("export_id", part_shape().alias("shape"), _name(column).alias("value")).where("shape is not null and value is not null").groupBy("export_id", "shape").agg(F.collect_set("value").alias("now"))
    of = exports.select("export_id", "account_key", "seq").distinct()
    w = Window.partitionBy("account_key", "shape").orderBy("seq", "export_id")
    steps = sets.join(of, "export_id").withColumn("was", F.lag("now").over(w)).where("was is not null")
    steps = steps.select("export_id", "shape", F.array_except("now", "was").alias("new"), F.array_except("was", "now").alias("gone"))
    change = lambda kind, to, off: F.struct(F.lit(kind).alias("change_kind"), to.alias("to"), off.alias("off"))
    none = F.lit("")
    swap = (F.size("new") == 1) & (F.size("gone") == 1)
    all_of = F.when(swap, F.array(change("renamed", F.col("new")[0], F.col("gone")[0]))).otherwise(
        F.concat(F.transform("new", lambda x: change("added", x, none)), F.transform("gone", lambda x: change("removed", x, none)))
    )
    return steps.select("export_id", "shape", F.explode(all_of).alias("c")).select("export_id", "shape", "c.*")


def value_changes(parts: DataFrame, exports: DataFrame, column: str = "part_type") -> DataFrame:
    """Changes of the values of ``column`` per shape, lower-cased and trimmed."""
    rows = _shape_changes(parts, exports, column)
    label = lambda c: F.when(c == "", c).otherwise(F.concat(F.lit(f"{column}="), c))
    return rows.select("export_id", "change_kind", label(F.col("to")).alias("field_name"), label(F.col("off")).alias("prior_name")).distinct()


def present_names(names: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """``names`` (keys, seq, name) with the name each has after later renames: now.

    ``events`` has keys, seq, prior, new. A name takes its earliest rename
    after its own seq, then the earliest after that, as often as there is one;
    each round is a join on the keys and the name. A rename that isn't one to
    one in its export leaves the name as it is.
    """
    by = [*keys, "seq"]
    events = events.select(*by, "prior", "new").distinct()
    for side in ("prior", "new"):
        single = events.groupBy(*by, side).agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").drop("__n")
        events = events.join(single, [*by, side], "left_semi")
    events = materialize(events.select(*keys, F.col("prior").alias("now"), F.col("seq").alias("__seq"), F.col("new").alias("__new")), "renames")
    state = materialize(names.select(*by, "name", F.col("name").alias("now"), F.col("seq").alias("__at")).distinct(), "names")
    while True:
        later = state.join(events, [*keys, "now"]).where("__seq > __at").groupBy(*by, "name").agg(F.min(F.struct("__seq", "__new")).alias("__next"))
        later = materialize(later, "later")
        if later.isEmpty():
            return state.drop("__at")
        following = state.join(later, [*by, "name"], "left").select(*by, "name", F.coalesce("__next.__new", "now").alias("now"), F.coalesce("__next.__seq", "__at").alias("__at"))
        state = materialize(following, "names")


def field_names(fields: DataFrame, changes: DataFrame, exports: DataFrame) -> DataFrame:
    """(export_id, field, now) of the fields that later exports of the account rename."""
    of = exports.select("export_id", "account_key", "seq").distinct()
    events = changes.where("change_kind = 'renamed' and not startswith(field_name, 'part_type=')").join(of, "export_id").select("account_key", "seq", F.col("prior_name").alias("prior"), F.col("field_name").alias("new"))
    names = fields.select("export_id", "field").distinct().join(of, "export_id").select("account_key", "seq", F.col("field").alias("name"))
    got = present_names(names, events, ["account_key"]).where("now <> name")
    return materialize(got.join(of, ["account_key", "seq"]).select("export_id", F.col("name").alias("field"), "now"), "present")


def part_table(parts: DataFrame, exports: DataFrame, column: str = "part_type") -> DataFrame:
    """All parts with one spelling and one name per value: adds shape, canonical.

    Values are lower-cased and trimmed, and carry the name that the account's
    last export gives them in their shape. Parts without shape or value, or of
    an unknown export, keep their own; repeated parts stay repeated.
    """
    of = exports.select("export_id", "account_key", "seq").distinct()
    events = _shape_changes(parts, exports, column).where("change_kind = 'renamed'").join(of, "export_id").select("account_key", "shape", "seq", F.col("off").alias("prior"), F.col("to").alias("new"))
    rows = parts.withColumn("shape", part_shape()).withColumn("__name", _name(column))
    names = rows.where("shape is not null and __name is not null").select("export_id", "shape", F.col("__name").alias("name")).distinct().join(of, "export_id").drop("export_id")
    got = present_names(names, events, ["account_key", "shape"]).where("now <> name").join(of, ["account_key", "seq"])
    renamed = materialize(got.select("export_id", "shape", F.col("name").alias("__name"), "now"), "present")
    return rows.join(renamed, ["export_id", "shape", "__name"], "left").withColumn("canonical", F.coalesce("now", "__name")).drop("__name", "now")


def schema_changes(dialogues: DataFrame, parts: DataFrame, exports: DataFrame) -> DataFrame:
    """Every change between consecutive exports of an account."""
    fields = materialize(
        fields_of(dialogues.where("export_id is not null and id is not null").select("export_id", F.col("id").alias("dialogue_id"), "source_json"), ["export_id", "dialogue_id"], "source_json"),
        "fields",
    )
    return field_changes(fields, exports).unionByName(value_changes(parts, exports))


MAX_NAMES = 100_000


def canonical_names(changes: DataFrame, fields: DataFrame, least: int = 2, share: float = 0.2) -> dict[str, str]:
    """One name for each set of field names that rename each other.

    Renames are counted over all exports; a pair counts as one field if it was
    reported at least ``least`` times and in at least ``share`` of the renames
    of both names, which leaves out values that were equal by chance. The name
    most dialogues have stands for the set. Works on names and their counts,
    which schemas bound; more than MAX_NAMES pairs raise ValueError.
    """
    pairs = changes.where("change_kind = 'renamed' and not startswith(field_name, 'part_type=')").groupBy("field_name", "prior_name").agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} pairs of names: these are data, not schema")
    both: dict[frozenset, int] = {}
    total: dict[str, int] = {}
    for a, b, n in rows:
        both[frozenset((a, b))] = both.get(frozenset((a, b)), 0) + n
        total[a], total[b] = total.get(a, 0) + n, total.get(b, 0) + n
    names = {x for pair in both for x in pair}
    seen = {r[0]: r[1] for r in fields.where(F.col("field").isin(*names)).groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()} if names else {}
    head = {x: x for x in names}

    def top(x: str) -> str:
        while head[x] != x:
            x = head[x]
        return x

    for pair, n in sorted(both.items(), key=lambda x: sorted(x[0])):
        a, b = sorted(pair)
        if n >= least and n >= share * max(total[a], total[b]):
            first, second = sorted((top(a), top(b)), key=lambda x: (-seen.get(x, 0), x))
            head[second] = first
    return {x: top(x) for x in names if top(x) != x}


def wide_table(df: DataFrame, keys: list[str], json_column: str, names: dict[str, str] | None = None, present: DataFrame | None = None) -> DataFrame:
    """All files as one table with a column per field, in canonical text.

    Columns are the fused schema's fields under their canonical names, sorted,
    with ``__`` for the dot; a field that clashes with a key gets the prefix
    ``field_``. Of a row with a field under two names the present one counts,
    the canonical first. ``present`` (export_id, field, now) renames the fields
    of an export's rows first.
    """
    names = names or {}
    found = sorted(r[0] for r in fields_of(df, [], json_column).select("field").distinct().limit(MAX_NAMES + 1).collect())
    if len(found) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} fields: these are data, not schema")
    groups: dict[str, list[str]] = {}
    for f in found:
        groups.setdefault(names.get(f, f), []).append(f)
    # of a key that an object repeats the first value counts
    plain = "if(f.type = 'string', from_json(concat('[', f.value, ']'), 'array<string>')[0], f.value)"
    first = "filter(fields, (f, i) -> array_position(transform(fields, x -> x.field), f.field) = i + 1)"
    rows = _opened(df, keys, json_column).select(*keys, _present(True).alias("fields"))
    if present is not None:
        of = present.groupBy("export_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "now"))).alias("__now"))
        # a field that is there under its present name already keeps both
        now = "if(__now[f.field] is null or exists(fields, g -> g.field = __now[f.field]), f.field, __now[f.field])"
        rows = rows.join(of, "export_id", "left").select(*keys, F.expr(f"transform(fields, f -> named_struct('field', {now}, 'type', f.type, 'digest', f.digest, 'value', f.value))").alias("fields"))
    rows = rows.select(*keys, F.expr(f"map_from_entries(transform({first}, f -> struct(f.field, {plain})))").alias("__by"))
    column = lambda f: f"field_{f}" if f in keys else f.replace(".", "__")
    text = lambda f: F.element_at("__by", F.lit(f))
    return rows.select(*keys, *[F.coalesce(*[text(f) for f in sorted(fs, key=lambda x: (x != name, x))]).alias(column(name)) for name, fs in sorted(groups.items())])


def consistent_table(df: DataFrame, keys: list[str], json_column: str, renames: DataFrame | None = None, present: DataFrame | None = None) -> DataFrame:
    """All files as one table: keys, field, type, typed branches, canonical text.

    A path keeps its alternatives: ``as_string``, ``as_number``, ``as_boolean``
    and ``as_json`` (objects and arrays) hold the value of the branch its type
    names, ``canonical`` its text form in all of them. ``renames`` (field_name,
    prior_name), distinct on prior_name, maps an old name to its present one;
    before that ``present`` (export_id, field, now) renames the fields of an
    export.
    """
    rows = fields_of(df, keys, json_column, values=True).drop("digest")
    if present is not None:
        rows = rows.join(present.withColumnRenamed("now", "__of"), ["export_id", "field"], "left").withColumn("field", F.coalesce("__of", "field")).drop("__of")
    if renames is not None:
        names = renames.select(F.col("prior_name").alias("field"), F.col("field_name").alias("__now")).dropDuplicates(["field"])
        rows = rows.join(names, "field", "left").withColumn("field", F.coalesce("__now", "field")).drop("__now")
    plain = F.when(F.col("type") == "string", F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<string>")[0])
    return rows.select(
        *keys,
        "field",
        "type",
        plain.alias("as_string"),
        F.when(F.col("type") == "number", F.col("value").try_cast("double")).alias("as_number"),
        F.when(F.col("type") == "boolean", F.col("value") == "true").alias("as_boolean"),
        F.when(F.col("type").isin("object", "array"), F.col("value")).alias("as_json"),
        F.coalesce(plain, "value").alias("canonical"),
    )


def union_schema(df: DataFrame, json_column: str) -> DataFrame:
    """The fused schema: field, its alternative types, rows per alternative."""
    return fields_of(df, [], json_column).groupBy("field", "type").agg(F.count(F.lit(1)).alias("n_rows"))


def union_paths(df: DataFrame, json_column: str, levels: int = 8) -> DataFrame:
    """The fused schema of all depths: path, type, rows with that alternative.

    Paths join keys by dots, ``[]`` stands for any element of an array and
    ``*`` for the keys of an opaque object, which are data. Levels are opened
    within the row, ``levels`` a pass, until no container is left.
    """
    object_, array = "try_cast(n.v as map<string,variant>)", "try_cast(n.v as array<variant>)"
    kind = "case when n.m is not null then 'object' when n.a is not null then 'array' when schema_of_variant(n.v) = 'STRING' then 'string' when schema_of_variant(n.v) = 'BOOLEAN' then 'boolean' when schema_of_variant(n.v) = 'VOID' then null else 'number' end"
    opaque = ", ".join(f"'{k}'" for k in OPAQUE_KEYS)
    key = f"if(n.path in ({opaque}), '*', e.key)"
    of_map = f"transform(map_entries(n.m), e -> named_struct('path', if(n.path = '', {key}, concat(n.path, '.', {key})), 'v', e.value))"
    of_list = "transform(n.a, x -> named_struct('path', concat(n.path, '[]'), 'v', x))"
    todo, out = df.select(F.expr(f"array(named_struct('path', '', 'v', try_parse_json(`{json_column}`)))").alias("nodes")), None
    while True:
        found: list[str] = []
        for k in range(levels):
            todo = todo.selectExpr(*found, f"transform(nodes, n -> named_struct('path', n.path, 'v', n.v, 'm', {object_}, 'a', {array})) as opened")
            here = f"array_distinct(filter(transform(opened, n -> named_struct('path', n.path, 'type', {kind})), x -> x.type is not null and x.path <> '')) as f{k}"
            todo = todo.selectExpr(*found, here, f"flatten(transform(opened, n -> coalesce({of_map}, {of_list}, array()))) as nodes")
            found.append(f"f{k}")
        done = materialize(todo.selectExpr(f"concat({', '.join(found)}) as found", "nodes"), "paths")
        rows = done.select(F.inline("found")).groupBy("path", "type").agg(F.count(F.lit(1)).alias("n_rows"))
        out = rows if out is None else out.unionByName(rows)
        todo = done.where(F.size("nodes") > 0).select("nodes")
        if todo.isEmpty():
            return out.groupBy("path", "type").agg(F.sum("n_rows").alias("n_rows"))
