from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dialoom.operators import exchanges, facets, notes

START = datetime(2024, 1, 1)


def turns(spark, dialogues):
    rows = []
    for d, messages in dialogues.items():
        for i, (role, text, *meta) in enumerate(messages):
            rows.append((d, f"{d}{i:02d}", role, START + timedelta(seconds=i), text, meta[0] if meta else None))
    df = spark.createDataFrame(rows, "dialogue_id string, message_id string, role string, created_at timestamp, text string, meta string")
    return df.withColumn("metadata", F.try_parse_json("meta")).drop("meta")


TALKS = {
    "a": [("user", "How do I sort?"), ("assistant", "# Sorting\n```python\nsorted(x)\n```"), ("user", "continue"), ("assistant", "More on [[sorting]]."), ("user", "> quote\nElaborate"), ("assistant", None), ("user", "Another topic"), ("assistant", "**Bold**")],
    "b": [("user", "one"), ("user", "two"), ("assistant", "x"), ("assistant", "y"), ("tool", "ignored"), ("user", "z")],
    "c": [("system", "nothing")],
    "d": [("user", "see this", '{"metadata":{"attachments":[{"name":"a.py"}]}}'), ("assistant", "$$x$$", '{"metadata":{"gizmo_id":"g","invoked_plugin":{"plugin_id":"p","namespace":"n"}},"content":{"thoughts":[1]}}')],
}


def test_dyads_and_merging(spark):
    chunked = exchanges.chunk(turns(spark, TALKS))
    dyads = {r["message_id"]: r["dyad"] for r in chunked.collect()}
    assert [dyads[f"a{i:02d}"] for i in range(8)] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert [dyads[f"b{i:02d}"] for i in (0, 1, 2, 3, 5)] == [0, 0, 0, 1, 1] and "c00" not in dyads
    rows = {(r["dialogue_id"], r["exchange"]): r for r in exchanges.exchanges(exchanges.merge(chunked)).collect()}
    assert len(rows["a", 0]["message_ids"]) == 6 and rows["a", 0]["has_continuations"] and rows["a", 0]["assistant_texts"][2] == ""
    assert rows["a", 1]["user_texts"] == ["Another topic"] and ("c", 0) not in rows


def test_rules_and_tags(spark):
    t = turns(spark, TALKS)
    rules = exchanges.exchange_rules(exchanges.merge(exchanges.chunk(t)))
    by = {(r["dialogue_id"], r["exchange"]): r for r in rules.collect()}
    a, d = by["a", 0], by["d", 0]
    assert a["has_code_blocks"] and a["has_wiki_links"] and a["user_has_quote_elaborate"] and a["proposed_title"] == "Sorting" and a["interaction_pattern"] == "multi_turn"
    assert by["a", 1]["proposed_title"] == "Bold" and not by["a", 1]["has_code_blocks"]
    assert d["first_user_has_code_attachments"] and d["has_latex_math"] and d["assistant_has_reasoning"] and d["gizmos"] == ["g"] and d["plugins"] == ["n", "p"]
    marks = exchanges.conversation_annotations(rules, t)
    got = {r["tag"] for r in facets.tag_rows(facets.with_derived_tags(facets.tag_table(marks))).where("dialogue_id = 'a'").collect()}
    assert {"code_blocks", "strong_code_evidence", "likely_coding_assistance", "brief_interaction", "code_patterns"} <= got
    long = {r["dialogue_id"]: r["category"] for r in exchanges.conversation_length(rules).collect()}
    assert long == {"a": "short", "b": "short", "d": "single"}
    ids = t.select("dialogue_id").distinct()
    faceted = {r["dialogue_id"]: r["facet"] for r in facets.facet_values(ids, marks, "conversation_length", "category").collect()}
    assert faceted == {"a": "short", "b": "short", "c": "<none>", "d": "single"}
    assert {r["facet"] for r in facets.facet_values(ids, marks, "has_code_blocks").collect()} == {"<none>", "has_has_code_blocks"}
    kept = facets.filter_by_tags(ids, marks, [facets.tag_matches("conversation_length", exchange_count__gte=2)], [facets.tag_matches("has_code_blocks")])
    assert [r[0] for r in kept.collect()] == ["b"]
    usage = exchanges.usage_summary(rules, "plugins").collect()
    assert [tuple(r) for r in usage] == [("d", 2, 2, ["n", "p"])]


def test_top_facets(spark):
    df = spark.createDataFrame([(str(i), "abcd"[min(3, i // 4)] + ("" if i < 12 else str(i))) for i in range(16)], "dialogue_id string, facet string")
    sizes = {r["facet"]: r["n_dialogues"] for r in facets.facet_sizes(facets.top_facets(df, 3)).collect()}
    assert sizes == {"a": 4, "b": 4, "<other>": 8}


def test_notes(spark, tmp_path):
    t = turns(spark, {"a": [("user", "The First topic/x\nmore"), ("assistant", "# The Cat"), ("user", "> the dog barks\nwhy does it and when?"), ("assistant", "see the cat here"), ("user", "What of that other thing?"), ("assistant", "the dog barks loudly at the cat"), ("user", "Who was it?"), ("assistant", "again the dog barks")]})
    merged = exchanges.merge(exchanges.chunk(t))
    rows = exchanges.exchange_rules(merged).select("dialogue_id", "exchange", "proposed_title").join(exchanges.exchanges(merged).select("dialogue_id", "exchange", "exchange_id"), ["dialogue_id", "exchange"]).withColumn("title", F.lit(None).cast("string"))
    made = notes.notes_of(merged, rows)
    got = {r["exchange"]: r for r in made.collect()}
    assert [got[i]["title"] for i in range(3)] == ["cat", "the dog barks", "what of that other thing"] and got[1]["previous_title"] == "cat" and got[1]["next_title"].startswith("what")
    linked = notes.wikilinkify(notes.merge_titles(made))
    texts = {r["title"]: r["content"] for r in linked.collect()}
    third = texts["what of that other thing"]
    assert "at the [[cat]]" in third and "the dog barks loudly" in third and "see also" not in third
    # the quoting note has a link to the next one already, to the last one it has none
    assert texts["who was it?" if "who was it?" in texts else "who was it"].endswith("see also: [[the dog barks]]  ")
    folder = str(tmp_path / "notes")
    notes.write_notes(linked, folder)
    notes.write_notes(linked, folder)
    body = open(f"{folder}/cat.md").read()
    assert body.count("tags:") == 2 and "- autogenerated" in body and 'title: "cat"' in body
