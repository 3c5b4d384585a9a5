"""Queries that no SQL covers, on small tables."""

import json

from dialoom.plans import reference_queries as q


def test_schema_of_each_platform(spark, data):
    got = {r["source"]: r["json_schema"] for r in q.schema_inference(spark, data).collect()}
    assert set(got) == {"chatgpt", "claude"} and "chat_messages: ARRAY<" in got["claude"]
    assert "mapping: ARRAY<OBJECT<" in got["chatgpt"] and "current_node: " in got["chatgpt"] and "parent: " in got["chatgpt"]


def test_all_parts(spark, tmp_path):
    """Tool texts, texts without a content array, parts of their own type and canvas parts."""
    node = {"id": "a1", "message": {"id": "a1", "author": {"role": "assistant"}, "content": {"parts": ["hi", {"content_type": "tether_quote", "text": "q"}]}, "metadata": {"canvas": {"textdoc_id": "t", "content": "body"}}}}
    chatgpt = {"conversation_id": "c1", "mapping": {"a1": node}}
    tool = [{"type": "tool_use", "id": "t1", "name": "search", "input": {"query": "q"}}, {"type": "tool_result", "tool_use_id": "t1", "content": [{"type": "text", "text": "r1"}, {"type": "text", "text": "r2"}]}]
    claude = {"uuid": "k1", "chat_messages": [{"uuid": "m1", "sender": "human", "text": "only text"}, {"uuid": "m2", "sender": "assistant", "content": tool}]}
    rows = [("c1", "chatgpt", "2024-01-01", json.dumps(chatgpt)), ("k1", "claude", "2024-01-01", json.dumps(claude))]
    spark.createDataFrame(rows, "id string, source string, updated_at string, source_json string").write.parquet(f"{tmp_path}/dialogues.parquet")
    got = {(name, r["source_id"], r["sequence"]): r for name, query in (("chatgpt", q.import_tree_parts), ("claude", q.import_list_parts)) for r in query(spark, str(tmp_path)).collect()}
    assert {k: r["part_type"] for k, r in got.items()} == {("chatgpt", "a1", 0): "text", ("chatgpt", "a1", 1): "tether_quote", ("chatgpt", "a1", 2): "canvas", ("claude", "m1", 0): "text", ("claude", "m2", 0): "tool_use", ("claude", "m2", 1): "tool_result"}
    assert got["chatgpt", "a1", 2]["text_content"] == "body" and got["claude", "m1", 0]["text_content"] == "only text"
    assert "r1" in got["claude", "m2", 1]["text_content"] and "r2" in got["claude", "m2", 1]["text_content"]
