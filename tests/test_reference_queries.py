"""Queries with SQL give what DuckDB gives on the same tables."""

import math
import os
import re

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
NAMES = [n for n in entry.queries() if not re.match(r"p\d+_", n)]


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(data):
        con.execute(f"create view {f.split('.')[0]} as select * from '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, data, sql, name):
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted([tuple(map(plain, r)) for r in df.select(*columns).collect()], key=str)
    rel = sql.execute(entry.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    want = sorted([tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall()], key=str)
    assert got == want


def rows(spark, data, name):
    return [r.asDict() for r in entry.queries()[name](spark, data).collect()]


def test_queries_without_sql_are_known():
    """These are compared below, or in the tests of their operators."""
    assert set(NAMES) - set(entry.oracle_sql()) == {"code_report", "content_hashes", "derived_tags", "facet_comparison", "faceted_summary", "note_texts", "note_titles", "schema_inference", "tag_diff", "tag_summary"}


def test_tags_agree_with_the_rules_of_exchanges(spark, data):
    features = rows(spark, data, "exchange_features")
    tagged = rows(spark, data, "derived_tags")
    dialogues = {r["dialogue_id"] for r in features}
    by_tag = {}
    for r in tagged:
        by_tag.setdefault(r["tag"], set()).add(r["dialogue_id"])
    assert len(tagged) == sum(map(len, by_tag.values()))
    flags = [c for c, v in features[0].items() if isinstance(v, bool)]
    for flag in flags:
        want = {r["dialogue_id"] for r in features if r[flag]}
        name = next((x for x in (flag, flag.removeprefix("has_")) if x in by_tag), None)
        assert not want or name is None or by_tag[name] == want
    summary = {r["tag"]: r for r in rows(spark, data, "tag_summary")}
    assert {t: len(d) for t, d in by_tag.items()} == {t: r["n_dialogues"] for t, r in summary.items()}
    assert all(abs(r["share"] - 100 * r["n_dialogues"] / len(dialogues)) < 0.051 for r in summary.values())
    diff = {r["tag"]: r for r in rows(spark, data, "tag_diff")}
    assert {t: r["n_after"] for t, r in diff.items()} == {t: r["n_dialogues"] for t, r in summary.items()}
    assert all(r["change"] == r["n_after"] - r["n_before"] and r["n_before"] in (0, r["n_after"]) for r in diff.values())
    for r in rows(spark, data, "code_report"):
        assert r["n_alone"] <= r["n_dialogues"] == len(by_tag.get(r["evidence"], by_tag.get("has_" + r["evidence"], ())))


def test_notes_follow_the_exchanges(spark, data):
    exchanges = {(r["dialogue_id"], r["exchange"]): r["message_ids"].split(",") for r in rows(spark, data, "exchange_rows")}
    titles = {(r["dialogue_id"], r["exchange"]): r for r in rows(spark, data, "note_titles")}
    assert titles.keys() == exchanges.keys()
    for (d, n), r in titles.items():
        before, after = titles.get((d, n - 1)), titles.get((d, n + 1))
        assert r["previous_title"] == (before and before["title"]) and r["next_title"] == (after and after["title"])
    notes = {(r["dialogue_id"], r["title"]): r["note"] for r in rows(spark, data, "note_texts")}
    assert notes.keys() == {(d, r["title"]) for (d, _), r in titles.items()}
    for (d, n), ids in exchanges.items():
        text = notes[d, titles[d, n]["title"]]
        assert all(f"- msg_{i}" in text for i in ids) and f"- conversation_id__{d}" in text and "- source__" in text


def test_digests_ignore_key_order(spark, data):
    import json

    import pandas as pd

    got = {(r["id"], r["digest"]) for r in rows(spark, data, "content_hashes")}
    messages = pd.read_parquet(f"{data}/messages.parquet")
    want = {}
    for i, text in zip(messages["id"], messages["source_json"]):
        try:
            want.setdefault(i, set()).add(json.dumps(json.loads(text), sort_keys=True))
        except (TypeError, ValueError):
            want.setdefault(i, set()).add(None)
    assert {i for i, _ in got} == set(want) and len(got) == sum(map(len, want.values()))


def test_facets_of_lengths(spark, data):
    lengths = {r["dialogue_id"]: r["category"] for r in rows(spark, data, "conversation_lengths")}
    summary = rows(spark, data, "faceted_summary")
    assert summary and {r["facet"] for r in summary} <= set(lengths.values()) | {"<none>"}
    for r in rows(spark, data, "facet_comparison"):
        assert 0 <= r["least"] < r["most"] <= 100
