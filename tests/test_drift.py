import json

import pytest
from dialoom.operators import drift

from . import brute

EXPORTS = [(1, "a", 1), (2, "a", 2), (3, "a", 4), (4, "b", 1), (5, "a", 5)]
DIALOGUES = [
    (1, "d1", {"id": 1, "title": "t", "s": {"lang": "en", "x": None}, "flag": True, "mapping": {"q": {}}}),
    (1, "d2", {"id": 2, "title": "u", "s": {"lang": "de"}, "n": 1}),
    (1, "d2", {"id": 2, "title": "u", "s": {"lang": "de"}, "n": 1}),
    (2, "d1", {"id": "1", "name": "t", "s": {"locale": "en"}, "flag": None, "mapping": {}, "o": {"a": {"deep": 1}}}),
    (2, "d3", {"id": 3, "name": "z", "n": 1.0}),
    (3, "d3", {"id": 3, "name": "z", "n": "1", "o": [1]}),
    (3, "d9", {}),
    (4, "d1", {"id": 1}),
]
PARTS = [(1, "Tool_use ", "f", None, None, None), (2, "tool_call", "f", None, None, None), (2, "code", None, None, "py", None), (3, "code_block", None, " ", "py", None), (3, "x", None, None, "py", None), (5, "function_call", "g", "id", None, None), (5, None, "g", None, None, None), (5, "plain", None, None, None, None)]


def frames(spark, dialogues=DIALOGUES, parts=PARTS, exports=EXPORTS):
    d = spark.createDataFrame([(e, i, json.dumps(j) if isinstance(j, dict) else j, "x") for e, i, j in dialogues], "export_id bigint, id string, source_json string, field string")
    p = spark.createDataFrame([(*r,) for r in parts], "export_id bigint, part_type string, tool_name string, tool_use_id string, language string, media_type string")
    e = spark.createDataFrame(exports, "export_id bigint, account_key string, seq int")
    return d, p, e


def test_equals_plain_comparison(spark):
    d, p, e = frames(spark)
    as_dicts = lambda df: [r.asDict() for r in df.collect()]
    got = [tuple(r) for r in drift.schema_changes(d, p, e).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.drift(as_dicts(d), as_dicts(p), as_dicts(e))
    assert (2, "renamed", "name", "title") in got and (2, "renamed", "s.locale", "s.lang") in got and (2, "retyped", "id", "") in got
    assert (2, "renamed", "part_type=tool_call", "part_type=tool_use") in got and (3, "added", "part_type=x", "") in got


def test_odd_json(spark):
    d, p, e = frames(spark, [(1, "a", None), (1, "b", "{"), (1, "c", "[1]"), (2, "a", '{"k":1}'), (2, None, '{"z":1}')], [])
    assert {tuple(r) for r in drift.schema_changes(d, p, e).collect()} == {(2, "added", "k", ""), (3, "removed", "k", "")}


def test_empty(spark):
    d, p, e = frames(spark, [], [], [])
    assert drift.schema_changes(d, p, e).collect() == []


def test_consistent_table(spark):
    d, _, _ = frames(spark)
    renames = spark.createDataFrame([("name", "title")], "field_name string, prior_name string")
    rows = drift.consistent_table(d, ["export_id", "id"], "source_json", renames).collect()
    names = {(r["export_id"], r["id"], r["as_string"]) for r in rows if r["field"] == "name"}
    assert (1, "d1", "t") in names and (2, "d1", "t") in names and not any(r["field"] == "title" for r in rows)
    by = {(r["id"], r["field"], r["type"]): r for r in rows}
    assert by["d3", "n", "string"]["as_string"] == "1" and by["d2", "n", "number"]["as_number"] == 1.0 and by["d1", "flag", "boolean"]["as_boolean"] is True
    assert by["d3", "n", "string"]["canonical"] == by["d2", "n", "number"]["canonical"] == "1" and json.loads(by["d3", "o", "array"]["as_json"]) == [1]


def test_canonical_names(spark):
    changes = spark.createDataFrame([(1, "renamed", "name", "title"), (2, "renamed", "title", "name"), (3, "renamed", "name", "title"), (3, "renamed", "flag", "title"), (4, "renamed", "part_type=a", "part_type=b"), (4, "added", "z", ""), (5, "renamed", "label", "name"), (6, "renamed", "label", "name")], "export_id bigint, change_kind string, field_name string, prior_name string")
    fields = spark.createDataFrame([(f, i) for i, f in enumerate(["name", "title", "title", "label", "flag"])], "field string, i int")
    assert drift.canonical_names(changes, fields) == {"name": "title", "label": "title"}
    assert drift.canonical_names(changes.limit(0), fields) == {}


def test_wide_table(spark):
    d, _, _ = frames(spark, [(1, "a", {"title": "t", "id": 7, "s": {"x": [1, {"b": 2, "a": 1}]}, "n": 1.0, "k": None}), (2, "b", {"name": "u", "title": None, "mapping": {"deep": 1}, "n": "1", "s": 5}), (3, "c", None), (3, "d", "[1]")], [])
    rows = {r["id"]: r for r in drift.wide_table(d, ["export_id", "id"], "source_json", {"name": "title"}).collect()}
    assert list(rows["a"].asDict()) == ["export_id", "id", "field_id", "mapping", "n", "s", "s__x", "title"]
    assert rows["a"]["title"] == "t" and rows["b"]["title"] == "u" and rows["a"]["n"] == rows["b"]["n"] == "1" and rows["a"]["field_id"] == "7"
    assert json.loads(rows["a"]["s__x"]) == [1, {"a": 1, "b": 2}] and rows["b"]["s"] == "5" and rows["c"]["title"] is None and len(rows) == 4


def test_mapping_renamed(spark):
    """The field ``mapping`` is compared by its value, key order aside."""
    rows = [(1, "d", '{"id": "d", "mapping": {"n": {"a": 1, "b": 2}}}'), (2, "d", '{"id": "d", "nodes": {"n": {"b": 2, "a": 1}}}')]
    fields = drift.fields_of(spark.createDataFrame(rows, "export_id bigint, dialogue_id string, source_json string"), ["export_id", "dialogue_id"], "source_json")
    exports = spark.createDataFrame([(1, "k", 1), (2, "k", 2)], "export_id bigint, account_key string, seq int")
    got = {(r["change_kind"], r["field_name"], r["prior_name"]) for r in drift.field_changes(fields, exports).collect()}
    assert any(n == "nodes" and p == "mapping" for _, n, p in got) and not any(n == "mapping" for _, n, _ in got)


def test_present_names(spark):
    """Renames after one's own export count, one after the other; ambiguous ones don't."""
    names = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("b", 1, "x"), ("a", 1, "p"), ("a", 1, "q")]
    events = [("a", 2, "x", "y"), ("a", 4, "y", "z"), ("a", 5, "x", "w"), ("a", 5, "p", "r"), ("a", 5, "q", "r"), ("b", 1, "x", "never")]
    got = drift.present_names(spark.createDataFrame(names, "account string, seq int, name string"), spark.createDataFrame(events, "account string, seq int, prior string, new string"), ["account"])
    assert {(r["account"], r["seq"], r["name"]): r["now"] for r in got.collect()} == {("a", 1, "x"): "z", ("a", 2, "y"): "z", ("a", 3, "x"): "w", ("b", 1, "x"): "x", ("a", 1, "p"): "p", ("a", 1, "q"): "q"}


def test_part_table(spark):
    exports = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1)], "export_id long, account_key string, seq int")
    rows = [(1, " Tool_Use ", "s", None, None, None), (2, "tool_call", "s", None, None, None), (3, "tool_use", "s", None, None, None), (1, "text", None, None, None, None), (1, None, "s", None, None, None), (9, "TOOL_USE", "s", None, None, None), (1, " Tool_Use ", "s", None, None, None)]
    parts = spark.createDataFrame([(*r, "clash") for r in rows], "export_id long, part_type string, tool_name string, tool_use_id string, language string, media_type string, name string")
    got = sorted((r["export_id"], r["part_type"] or "", r["canonical"]) for r in drift.part_table(parts, exports).collect())
    assert got == [(1, "", None), (1, " Tool_Use ", "tool_call"), (1, " Tool_Use ", "tool_call"), (1, "text", "text"), (2, "tool_call", "tool_call"), (3, "tool_use", "tool_use"), (9, "TOOL_USE", "tool_use")]
    assert drift.part_table(parts.limit(0), exports).count() == 0


@pytest.mark.parametrize("levels", [8, 1])
def test_union_paths(spark, levels):
    texts = ['{"a":{"b":[{"c":1},{"c":"x"}]},"mapping":{"k1":{"v":1},"k2":{"v":null}}}', '{"a":3}', None, "no json", "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "source_json string")
    got = {(r["path"], r["type"]): r["n_rows"] for r in drift.union_paths(df, "source_json", levels).collect()}
    assert got == {("a", "object"): 1, ("a", "number"): 1, ("a.b", "array"): 1, ("a.b[]", "object"): 1, ("a.b[].c", "number"): 1, ("a.b[].c", "string"): 1, ("mapping", "object"): 1, ("mapping.*", "object"): 1, ("mapping.*.v", "number"): 1, ("[]", "number"): 1}
