"""Deeply nested semi-structured records to flat tables.

Higher-order SQL projections over one row per owner: each level's ``transform``
opens the JSON containers found so far and attaches the path of the record that
encloses them, ``flatten`` merges the children of all of them, and one ``inline``
per target emits rows: for ``flatten_records`` the one target is the list of all
records, for ``target_tables`` each kind of record has an array, and an
``inline``, of its own. No row leaves its partition, nothing runs in Python.

The levels of one pass are unrolled; containers that are still closed after it
(``pending``) go through another pass, so any depth is read. Containers that
can't hold a record (no array, no record key, no escape inside) are dropped
from the walk at once.

Defined results: NULL, blank or malformed JSON gives no rows; array elements
that are NULL or plain keep their position but are no records; a string that is
the text of a JSON object or array is read as that; a bare object under one of
``RECORD_KEYS`` is an array of one. Repeated keys of an object all count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: Keys under which a bare object stands for an array of one.
RECORD_KEYS = ("citations", "attachments", "files", "search_result_groups", "entries", "messages", "filters", "sources", "moderation_results")
LEVELS = 12
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
#: How a container came to be: plain value, array element, value of a record key.
PLAIN, ELEMENT, KEYED = 0, 1, 2
NODE = "array<struct<path:string,owner:string,how:int,key:string,text:string>>"
LINKS = ("record_path", "parent_path")


def _trimmed(text: str) -> str:
    return rf"trim(BOTH ' \t\n\r' FROM {text})"


def _opened() -> str:
    """Parse each container; its text is trimmed already.

    The parser stops after the first value, so text that may go on after a
    closing bracket is read once more, as the only element of an array.
    """
    options = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in STRICT.items()) + ")"
    whole = rf"""(not n.text rlike r'[}}\]]\s*[^\s,:}}\]"]' or coalesce(size(from_json(concat('[', n.text, ']'), 'array<string>', {options})) = 1, false))"""
    parse = lambda first, last, kind: f"if(startswith(n.text, '{first}') and endswith(n.text, '{last}') and {whole}, from_json(n.text, '{kind}', {options}), null)"
    return f"transform(nodes, n -> named_struct('path', n.path, 'owner', n.owner, 'how', n.how, 'key', n.key, 'text', n.text, 'keys', {parse('{', '}', 'map<string,string>')}, 'items', {parse('[', ']', 'array<string>')}))"


IS_RECORD = f"(n.keys is not null and n.how <> {PLAIN})"
OWN_PATH = f"if(n.keys is not null and n.how = {KEYED}, concat(n.path, '[0]'), n.path)"


def _found(targets: dict[str, str] | None) -> list[str]:
    """Per target the array of its records among opened containers.

    Without targets one array of all records; a target's records have a struct
    ``__f`` of the fields its schema names, so no text is carried along.
    """
    link = f"'record_path', {OWN_PATH}, 'parent_path', n.owner"
    if targets is None:
        return [f"transform(filter(opened, n -> {IS_RECORD}), n -> named_struct({link}))"]
    return [f"transform(filter(opened, n -> {IS_RECORD} and n.key = '{name}'), n -> named_struct({link}, '__f', from_json(n.text, '{schema}')))" for name, schema in targets.items()]


def _children() -> str:
    """The children of opened containers that can be, or hold, a record."""
    quoted = ", ".join(f"'{k}'" for k in RECORD_KEYS)
    owner = f"if({IS_RECORD}, {OWN_PATH}, n.owner)"
    dotted = f"if({OWN_PATH} = '', e.key, concat({OWN_PATH}, '.', e.key))"
    keyed = f"if(e.key in ({quoted}), {KEYED}, {PLAIN})"
    indexed = f"concat({OWN_PATH}, '[', i, ']')"
    child = lambda path, how, key, text: f"named_struct('path', {path}, 'owner', {owner}, 'how', {how}, 'key', {key}, 'text', {_trimmed(text)})"
    of_map = f"transform(map_entries(n.keys), e -> {child(dotted, keyed, 'e.key', 'e.value')})"
    of_list = f"transform(n.items, (x, i) -> {child(indexed, ELEMENT, 'n.key', 'x')})"
    # a plain object without array, record key or escape inside holds nothing
    inside = rf"""contains(c.text, '[') or contains(c.text, r'\') or c.text rlike '"(?:{"|".join(RECORD_KEYS)})"' """
    worth = f"coalesce(startswith(c.text, '[') or (startswith(c.text, '{{') and (c.how <> {PLAIN} or {inside})), false)"
    return f"filter(flatten(transform(opened, n -> coalesce({of_map}, {of_list}, cast(array() as {NODE})))), c -> {worth})"


def _pass(df: DataFrame, keys: list[str], levels: int, targets: dict[str, str] | None) -> DataFrame:
    """Open ``levels`` levels of ``nodes``; gives an array per target and pending nodes."""
    found: list[str] = []
    names = [f"`{k}`" for k in keys]
    count = 1 if targets is None else len(targets)
    for k in range(levels):
        df = df.selectExpr(*names, *found, f"{_opened()} as opened")
        now = [f"__t{i}_{k}" for i in range(count)]
        df = df.selectExpr(*names, *found, *[f"{e} as {n}" for e, n in zip(_found(targets), now)], f"{_children()} as nodes")
        found += now
    arrays = [f"concat({', '.join(f'__t{i}_{k}' for k in range(levels))}) as __t{i}" for i in range(count)]
    return df.selectExpr(*names, *arrays, "nodes as pending")


def _passes(df: DataFrame, keys: list[str], json_column: str, levels: int, targets: dict[str, str] | None) -> list[DataFrame]:
    """The rows of each target, from as many passes as the depth needs."""
    root = f"array(named_struct('path', '', 'owner', '', 'how', {PLAIN}, 'key', '', 'text', {_trimmed(f'`{json_column}`')})) as nodes"
    todo = df.selectExpr(*[f"`{k}`" for k in keys], root)
    out: list[DataFrame] = []
    while True:
        done = materialize(_pass(todo, keys, levels, targets), "nested")
        rows = [done.select(*keys, F.inline(f"__t{i}")) for i in range(1 if targets is None else len(targets))]
        out = [a.unionByName(b) for a, b in zip(out, rows)] if out else rows
        deeper = done.where(F.size("pending") > 0)
        if deeper.isEmpty():
            return out
        todo = deeper.select(*keys, F.col("pending").alias("nodes"))


def flatten_records(df: DataFrame, keys: list[str], json_column: str, levels: int = LEVELS) -> DataFrame:
    """One row per record in ``json_column``: keys, record_path, parent_path.

    ``keys`` name the owner's columns to carry along.
    """
    return _passes(df, keys, json_column, levels, None)[0]


#: The records' kinds by the key of their array, and their fields.
TARGETS = {
    "citations": "uuid string, start_index bigint, end_index bigint, url string, type string, details string",
    "attachments": "id string, name string, mime_type string, size bigint, file_name string, file_type string, file_size bigint, extracted_content string",
    "files": "file_name string, file_uuid string",
    "search_result_groups": "type string, domain string",
    "entries": "url string, title string, snippet string",
    "messages": "message_type string, text string, content string",
    "content": "type string, text string, thinking string, name string, id string, tool_use_id string, is_error boolean",
    "parts": "content_type string, text string, language string, asset_pointer string",
    "chat_messages": "uuid string, sender string, text string, created_at string",
}


def target_tables(df: DataFrame, keys: list[str], json_column: str, targets: dict[str, str], levels: int = LEVELS) -> dict[str, DataFrame]:
    """A flat table per target: keys, record_path, parent_path, its fields.

    ``targets`` names the key of the array a record is an element of, and the
    DDL of the wanted fields. All tables come from the same passes. Fields that
    clash with ``keys`` or the link columns get the prefix ``field_``; values
    of another type than the field's are NULL.
    """
    taken, out = {*keys, *LINKS}, {}
    for (name, schema), rows in zip(targets.items(), _passes(df, keys, json_column, levels, targets)):
        fields = [F.col(f"__f.`{f.name}`").alias(f"field_{f.name}" if f.name in taken else f.name) for f in T._parse_datatype_string(schema)]
        out[name] = rows.select(*keys, *LINKS, *fields)
    return out
