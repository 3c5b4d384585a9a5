import random
from collections import Counter, defaultdict

import pytest

from dialoom.llm import packing


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 500])
    counts = Counter(rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 400)))
    plan = packing.plan_containers(dict(counts), capacity)
    used = Counter()
    for content, times in plan:
        assert times > 0 and sum(s * n for s, n in content.items()) <= capacity
        for s, n in content.items():
            used[s] += n * times
    assert used == counts
    least = -(-sum(s * n for s, n in counts.items()) // capacity)
    assert sum(t for _, t in plan) <= 1.3 * least + 1


def test_exact_complements():
    assert sum(t for _, t in packing.plan_containers({7: 5, 3: 5}, 10)) == 5
    assert sum(t for _, t in packing.plan_containers({4: 3, 3: 6}, 10)) == 3
    assert sum(t for _, t in packing.plan_containers({1: 40, 2: 30, 97: 10}, 100)) == 11
    assert packing.plan_containers({}, 10) == []


def check(spark, sizes, capacity, salts=3):
    packing_rows, packing.ROWS_PER_SALT = packing.ROWS_PER_SALT, salts
    try:
        items = spark.createDataFrame([(i, n, "t", "x") for i, n in sizes], "doc_id long, n_tokens long, tokenizer string, container_id string")
        profiles = spark.createDataFrame([(1, "t", capacity), (1, "t", capacity), (2, "other", 9)], "profile_id int, tokenizer string, capacity int")
        rows = packing.assign_containers(items, profiles).collect()
    finally:
        packing.ROWS_PER_SALT = packing_rows
    fill, parts = defaultdict(int), defaultdict(list)
    for r in rows:
        assert r["profile_id"] == 1
        fill[r["container_id"]] += r["n_tokens"]
        parts[r["doc_id"]].append(r["n_tokens"])
    assert all(n <= capacity for n in fill.values())
    want = defaultdict(int)
    for i, n in sizes:
        if n and n > 0:
            want[i] += n
    assert {i: sum(p) for i, p in parts.items()} == dict(want)
    return fill, parts


def test_assignment(spark):
    rng = random.Random(1)
    sizes = [(i, rng.choice([5, 5, 5, rng.randrange(1, 60)])) for i in range(300)] + [(1000, None), (1001, 0), (1002, 205), (1003, 100)]
    fill, parts = check(spark, sizes, 50)
    assert len(parts[1002]) == 5 and sorted(fill) == list(range(len(fill)))
    assert sum(50 - n for n in fill.values()) < 2 * 50


def test_repeated_ids_and_empty(spark):
    fill, _ = check(spark, [(1, 10), (1, 10), (2, 10)], 30)
    assert len(fill) == 1
    check(spark, [], 30)
    check(spark, [(1, None), (2, 0)], 30)
