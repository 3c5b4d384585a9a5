"""The general problems' queries over the small tables, against plain code."""

import pyarrow.parquet as pq

from dialoom.plans import pipeline_queries as q

from . import brute


def read(data, name):
    return pq.read_table(f"{data}/{name}.parquet").to_pylist()


def test_p2(spark, data):
    current = brute.current(read(data, "messages"))
    want = brute.hierarchy([(brute.key(r["dialogue_id"]) or "", k, brute.key(r["parent_id"])) for k, r in current.items()])
    assert {r[0]: tuple(r)[1:] for r in q.p2_found(spark, data).collect()} == want


def test_p3(spark, data):
    want = {(t, r["id"], a, b) for t in ("dialogues", "messages") for r in brute.current(read(data, t)).values() for a, b in brute.records(r["source_json"])}
    got = [tuple(r) for r in q.p3_found(spark, data).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_p4(spark, data):
    got = [tuple(r) for r in q.p4_found(spark, data).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.orphans(read(data, "messages"), read(data, "content_parts"), read(data, "prompt_responses"))


def test_p5(spark, data):
    got = [tuple(r) for r in q.p5_found(spark, data).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.drift(read(data, "dialogues"), read(data, "content_parts"), read(data, "exports"))
