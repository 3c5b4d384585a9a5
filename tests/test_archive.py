"""Import, update and annotate small exports."""

import copy
import json
import os

import pytest

from dialoom.operators import annotations, pairs
from dialoom.sources import archive as store
from dialoom.sources import exports


def node(i, role, text, parent, t, **meta):
    return {"id": i, "parent": parent, "children": [], "message": {"id": i, "author": {"role": role}, "create_time": t, "content": {"content_type": "text", "parts": text if isinstance(text, list) else [text]}, "metadata": meta}}


CHATGPT = [
    {
        "conversation_id": "c1",
        "title": "Pruning roses",
        "create_time": 1712340000.5,
        "update_time": 1712399000.0,
        "mapping": {
            "root": {"id": "root", "parent": None, "children": ["u1"], "message": None},
            "u1": node("u1", "user", "How?", "root", 1712340061.0),
            "a1": node("a1", "assistant", "# Title\n\n[[a]] [[b]] [[c]]\n```python\nx\n```", "u1", 1712340075.25, model_slug="m", gizmo_id="g", citations=[{"url": "https://x.example", "type": "web"}]),
            "a2": node("a2", "assistant", ["text", {"content_type": "code", "language": "py", "text": "x = 1"}, {"content_type": "image/png", "asset_pointer": "file-service://f"}, 7], "u1", 1712341111.0, canvas={"textdoc_id": "t", "version": 2, "title": "Doc", "content": "body"}),
            "a3": node("a3", "assistant", "deeper", "a2", 1712341502.0),
        },
    },
    {"title": "no id", "mapping": {}},
]
CLAUDE = [
    {
        "uuid": "k1",
        "name": "Tools",
        "created_at": "2024-01-01T00:00:00Z",
        "updated_at": "2024-01-02T00:00:00Z",
        "chat_messages": [
            {"uuid": "m1", "sender": "human", "text": "Find it", "created_at": "2024-01-01T00:00:01Z", "content": [], "files": [{"file_name": "f.txt"}]},
            {"uuid": "m2", "sender": "assistant", "created_at": "2024-01-01T00:00:02Z", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "tool_use", "id": "t1", "name": "search", "input": {"query": "q"}}, {"type": "tool_result", "tool_use_id": "t1", "content": [{"type": "text", "text": "r1"}, "r2"], "is_error": True}, {"type": "text", "text": "Found", "citations": [{"uuid": "z", "details": {"url": "https://y.example", "type": "web"}, "start_index": 1}]}]},
        ],
    }
]


def put(tmp_path, name, data):
    path = tmp_path / name
    path.write_text(json.dumps(data))
    return str(path)


@pytest.fixture()
def archive(spark, tmp_path):
    return store.Archive(spark, str(tmp_path / "archive"))


def take(archive, tmp_path, data, platform="chatgpt", **kw):
    archive.init()
    return store.import_into(archive, exports.read_export(archive.spark, put(tmp_path, "x.json", data)), platform, **kw)


def test_read_export(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        exports.read_export(spark, str(tmp_path / "none.json"))
    with pytest.raises(ValueError):
        exports.read_export(spark, put(tmp_path, "o.json", {"a": 1}))
    assert exports.read_export(spark, put(tmp_path, "l.json", [])).count() == 0


def test_run(archive, tmp_path):
    got = {r["what"]: r["n"] for r in store.run(archive, {"chatgpt": put(tmp_path, "a.json", CHATGPT), "claude": put(tmp_path, "b.json", CLAUDE)}).collect()}
    assert got["dialogues"] == 2 and got["messages"] == 6 and got["prompt_responses"] == 4 and got["dialogues:claude"] == 1
    parts = {(r["message_id"], r["sequence"]): r for r in archive.load("content_parts").collect()}
    by_source = {r["source_id"]: r["id"] for r in archive.load("messages").collect()}
    kinds = [parts[by_source["a2"], i]["part_type"] for i in range(5)]
    assert kinds == ["text", "code", "image", "unknown", "canvas"]
    assert parts[by_source["m2"], 2]["text_content"] == "r1\nr2" and parts[by_source["m2"], 2]["is_error"] is True
    assert parts[by_source["m2"], 1]["text_content"] == "q" and parts[by_source["m1"], 0]["text_content"] == "Find it"
    assert archive.load("citations").count() == 2 and archive.load("attachments").count() == 1 and archive.load("canvas_docs").count() == 1
    pr = archive.load("prompt_responses").collect()
    assert {r["prompt_message_id"] for r in pr if r["response_message_id"] != by_source["m2"]} == {by_source["u1"]}
    marks = archive.load("annotations")
    pair = next(r["id"] for r in pr if r["response_message_id"] == by_source["a1"])
    assert annotations.get_string(marks, "prompt_response", pair, "proposed_title") == "Title"
    assert annotations.has_flag(marks, "prompt_response", pair, "has_code") and annotations.get_numbers(marks, "prompt_response", pair, "wiki_link_count") == [3.0]
    assert annotations.get_string(marks, "message", by_source["a1"], "gizmo_id") == "g"
    before = marks.count()
    store.build_pairs(archive)
    store.annotate(archive)
    assert archive.load("annotations").count() == before


def test_incremental(archive, tmp_path):
    assert take(archive, tmp_path, CHATGPT)["dialogues_failed"] == 1
    assert take(archive, tmp_path, CHATGPT)["dialogues_skipped"] == 1
    later = copy.deepcopy(CHATGPT[:1])
    later[0]["update_time"] += 1
    later[0]["title"] = "New"
    later[0]["mapping"]["a1"]["message"]["content"]["parts"] = ["changed"]
    del later[0]["mapping"]["a3"]
    later[0]["mapping"]["u2"] = node("u2", "user", "And?", "a1", 1712350000.0)
    got = take(archive, tmp_path, later)
    assert (got["dialogues_updated"], got["messages_new"], got["messages_updated"], got["messages_soft_deleted"], got["messages_unchanged"]) == (1, 1, 1, 1, 2)
    rows = {r["source_id"]: r for r in archive.load("messages").collect()}
    assert rows["a3"]["deleted_at"] is not None and rows["a1"]["deleted_at"] is None
    texts = {r["text_content"] for r in archive.load("content_parts").collect() if r["message_id"] == rows["a1"]["id"]}
    assert texts == {"changed"} and archive.load("dialogues").first()["title"] == "New"
    again = copy.deepcopy(CHATGPT[:1])
    again[0]["update_time"] += 2
    got = take(archive, tmp_path, again, assume_immutable=True, incremental=True)
    assert (got["messages_restored"], got["messages_absent"], got["messages_updated"]) == (1, 1, 0)
    assert {r["text_content"] for r in archive.load("content_parts").collect() if r["message_id"] == rows["a1"]["id"]} == {"changed"}
    with pytest.raises(ValueError):
        archive.reset()
    archive.reset(confirm=True)
    assert not archive.has("messages")


def test_stale_export_and_failed_import(archive, tmp_path, monkeypatch):
    take(archive, tmp_path, CHATGPT[:1])
    later = copy.deepcopy(CHATGPT[:1])
    later[0]["update_time"] += 10
    message = later[0]["mapping"]["a1"]["message"]
    message["content"]["parts"] = ["now [[x]]"]
    message["metadata"] |= {"citations": [{"url": "https://new.example"}], "model_slug": "newer", "search_result_groups": [{"domain": "d", "entries": [{"url": "https://entry.example"}]}]}
    with monkeypatch.context() as m:
        m.setattr(store.annotations, "write", lambda *_: 1 / 0)
        versions = archive._versions()
        with pytest.raises(ZeroDivisionError):
            take(archive, tmp_path, later)
        assert archive._versions() == versions and archive._staged is None
    take(archive, tmp_path, later)
    names = [n for n in store.TABLES if archive.has(n)]
    rows = lambda: {n: sorted(map(str, archive.load(n).drop("source_json").collect())) for n in names}
    before = rows()
    other = copy.deepcopy(CHATGPT[0])
    other["conversation_id"] = "c2"
    got = take(archive, tmp_path, [CHATGPT[0], other])
    assert got["dialogues_skipped"] == 1 and got["dialogues_new"] == 1
    after = rows()
    assert all(set(before[n]) <= set(after[n]) for n in names)
    assert {r["url"] for r in archive.load("citations").collect()} == {"https://new.example", "https://x.example"}
    assert [r["url"] for r in archive.load("search_entries").collect()] == ["https://entry.example"]
    assert archive._newest() == 3
    with pytest.raises(Exception, match="exist"):
        archive._publish(3, {})
    archive.vacuum()
    assert sum(n.startswith(("messages-", "commit-")) for n in archive._names()) == 2 and rows() == after


def test_shared_folder_and_scratch(spark, tmp_path):
    from types import SimpleNamespace

    from dialoom import session

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        session.shared_dir(cluster)
    with session.scratch(spark):
        kept = session.materialize(spark.range(3), "t")
        gone = session.materialize(spark.range(3), "t")
        session.release(gone)
        paths = [f._dialoom_folder.removeprefix("file://") for f in (kept, gone)]
        assert [os.path.exists(p) for p in paths] == [True, False] and kept.count() == 3
    assert not os.path.exists(paths[0])


def test_pairs_of_odd_trees(spark):
    rows = [("s", None, "system", 1), ("u1", "s", "user", 2), ("a1", "u1", "assistant", 3), ("u2", "a1", "user", 4), ("a2", "u1", "assistant", 5), ("t", "a2", "tool", 6), ("x", "y", "assistant", 7), ("y", "x", "assistant", 8), ("z", "gone", "assistant", None), ("d", "u1", "assistant", 9)]
    df = spark.createDataFrame([(i, "d", p, r, None if t is None else f"2024-01-01 00:00:{t:02d}", "2024-02-01" if i == "d" else None) for i, p, r, t in rows], "id string, dialogue_id string, parent_id string, role string, created_at string, deleted_at string")
    df = df.selectExpr("id", "dialogue_id", "parent_id", "role", "cast(created_at as timestamp) created_at", "cast(deleted_at as timestamp) deleted_at")
    got = {r["response_message_id"]: r["prompt_message_id"] for r in pairs.build_pairs(df).collect()}
    assert got == {"a1": "u1", "a2": "u1", "t": "u1", "x": "u2", "y": "u2"}
    assert pairs.build_pairs(df.limit(0)).collect() == []


def test_store(spark):
    row = lambda key, kind, value, source="a": ("message", "m", key, kind, value, 1.0, None, source, "1", None)
    make = lambda *rows: spark.createDataFrame(list(rows), annotations.SCHEMA)
    first = annotations.write(annotations.empty_store(spark), make(row("f", "flag", None), row("s", "string", "x"), row("s", "string", "y"), row("j", "json", "1"), row("f", "flag", None)))
    assert first.count() == 4
    new = make(row("f", "flag", None, "b"), row("s", "string", "z"), row("j", "json", "2"))
    assert {r["value_type"]: r["n_created"] for r in annotations.created_counts(first, new).collect()} == {"string": 1, "json": 1}
    second = annotations.write(first, new)
    assert second.count() == 5 and annotations.get_json(second, "message", "m", "j") == "2" and annotations.get_strings(second, "message", "m", "s") == ["x", "y", "z"]
    assert second.where("key = 'f'").first()["source"] == "a" and annotations.get_string(second, "message", "m", "none") is None
    with pytest.raises(ValueError):
        annotations.typed(None, "other")
