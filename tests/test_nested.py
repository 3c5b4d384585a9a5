import json
import random

import pytest

from dialoom.operators import nested

from . import brute

TRICKY = [
    None,
    "",
    "  ",
    "null",
    "7",
    '"text"',
    "{",
    '{"a":[{}',
    "[no answer]",
    "{}",
    "[]",
    '[{"a":1},null,"x",{"b":[{}]}]',
    '{"citations":{"uuid":"c"},"files":"[{\\"n\\":1}]","entries":null}',
    '{"a":"{\\"entries\\":{\\"x\\":[[{}],[]]}}","b":[[{}],[{"c":{"messages":{"k":[{}]}}}]]}',
    '{"t":"[1] see [2] and {x}","u":"[{}] trailing","v":"[{}] [{}]","w":" [ {} ] "}',
    '{"code":"if (a) { b[0] } else { c }","d":"{\\"a\\":1}{\\"b\\":[{}]}","e":"{\\"text\\":\\"} else {\\",\\"l\\":[{}]}"}',
    '{"\\u0061":[{"k.e[y":{"sources":{}}}]}',
    '{"s":"\\u005b{}]","q":"{\'a\':[{}]}"}',
]


def found(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "owner int, text string, record_path string")
    return sorted(tuple(r) for r in nested.flatten_records(df, ["owner"], "text", **kw).collect())


def expected(texts):
    return sorted((i, a, b) for i, t in enumerate(texts) for a, b in brute.records(t))


@pytest.mark.parametrize("levels", [12, 2])
def test_tricky(spark, levels):
    assert found(spark, TRICKY, levels=levels) == expected(TRICKY)


def random_json(rng, depth=0):
    kind = rng.random()
    if depth > 5 or kind < 0.3:
        return rng.choice([None, 1, "x", True, "[a]", 1.5])
    if kind < 0.6:
        return {rng.choice(["a", "b", "citations", "entries", "mapping", "c d"]): random_json(rng, depth + 1) for _ in range(rng.randrange(4))}
    if kind < 0.9:
        return [random_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    return json.dumps(random_json(rng, depth + 1))


def test_random(spark):
    rng = random.Random(5)
    texts = [json.dumps({"r": random_json(rng)}) for _ in range(150)]
    assert found(spark, texts) == expected(texts)


def test_very_deep(spark):
    text = "[" * 60 + '{"a":[{}]}' + "]" * 60
    assert found(spark, [text]) == expected([text])


@pytest.mark.parametrize("levels", [12, 1])
def test_target_tables(spark, levels):
    text = '{"x":{"citations":[{"uuid":"u","owner":7,"entries":{"a":"[1]"}},{"uuid":null,"owner":"no number"}]},"entries":[[{"a":"b"}],3]}'
    df = spark.createDataFrame([("o", text), ("p", None), ("q", "{}")], "owner string, text string")
    got = nested.target_tables(df, ["owner"], "text", {"citations": "uuid string, owner int", "entries": "a string"}, levels=levels)
    assert sorted(map(tuple, got["citations"].collect())) == [("o", "x.citations[0]", "", "u", 7), ("o", "x.citations[1]", "", None, None)]
    assert got["citations"].columns == ["owner", "record_path", "parent_path", "uuid", "field_owner"]
    assert sorted(map(tuple, got["entries"].collect())) == [("o", "entries[0][0]", "", "b"), ("o", "x.citations[0].entries[0]", "x.citations[0]", "[1]")]


def test_empty(spark):
    assert found(spark, []) == []
