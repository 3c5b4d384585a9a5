import random

import pytest

from dialoom.operators import hierarchy

from . import brute

EDGES = "scope string, node string, parent string, extra string"


def rows(spark, edges, **kw):
    df = spark.createDataFrame([(*e, "x") for e in edges], EDGES)
    return {r["node"]: r for r in hierarchy.build_hierarchy(df, **kw).collect()}


def random_forest(seed, n=120):
    rng = random.Random(seed)
    edges = []
    for i in range(n):
        scope = f"s{rng.randrange(4)}"
        parent = rng.choice([None, f"n{rng.randrange(n)}", f"n{rng.randrange(max(1, i))}", "gone", f"n{i}" if rng.random() < 0.05 else None])
        edges.append((scope, f"n{i}", parent))
    return edges


@pytest.mark.parametrize("local_rows", [1000, 20, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_walk(spark, seed, local_rows):
    edges = random_forest(seed)
    got = {k: (r["root_node"], r["node_depth"], r["n_descendants"]) for k, r in rows(spark, edges, local_rows=local_rows).items()}
    assert got == brute.hierarchy(edges)


@pytest.mark.parametrize("local_rows", [1000, 2])
def test_cycles_chains_and_strangers(spark, local_rows):
    edges = [("a", "1", None), ("a", "2", "1"), ("a", "3", "2"), ("a", "x", "y"), ("a", "y", "x"), ("a", "z", "x"), ("a", "self", "self"), ("b", "4", "1"), ("b", "5", "nowhere")]
    got = rows(spark, edges, paths=True, local_rows=local_rows)
    assert got["3"]["path"] == ["1", "2", "3"] and got["3"]["node_depth"] == 2 and got["1"]["n_descendants"] == 2
    assert got["4"]["node_depth"] == 0 and got["5"]["root_node"] == "5"
    assert [got[k]["root_node"] for k in "xyz"] == ["", "", ""] and got["x"]["n_descendants"] == 2 and got["z"]["n_descendants"] == 0
    assert got["self"]["node_depth"] == -1 and got["self"]["n_descendants"] == 0
    assert sum(got[k]["back_edge"] for k in "xyz") == 1


@pytest.mark.parametrize("seed", [3])
def test_same_rows_in_all_ways_and_orders(spark, seed):
    edges = random_forest(seed, 60) + [("s0", "A", "B"), ("s0", "B", "C"), ("s0", "C", "A"), ("s0", "D", "B"), ("s0", "E", "D"), ("s1", "self", "self")]
    want = None
    for local_rows, order in ((1000, 1), (1000, 2), (20, 3), (4, 4)):
        random.Random(order).shuffle(edges)
        got = {k: r.asDict() for k, r in rows(spark, edges, paths=True, local_rows=local_rows).items()}
        want = want or got
        assert got == want
    assert want["A"]["back_edge"] and not want["B"]["back_edge"] and not want["C"]["back_edge"] and want["self"]["back_edge"]


@pytest.mark.parametrize("local_rows", [1000, 3])
def test_ranges_hold_the_descendants(spark, local_rows):
    edges = random_forest(5) + [("s0", "A", "B"), ("s0", "B", "A"), ("s0", "C", "B")]
    df = spark.createDataFrame([(*e, "x") for e in edges], EDGES)
    got = hierarchy.descendant_ranges(hierarchy.build_hierarchy(df, local_rows=local_rows)).collect()
    places = {(r["component"], r["place"]): r["node"] for r in got}
    assert len(places) == len(got)
    up, want = {(s, n): p for s, n, p in edges}, {}
    for s, n, _ in edges:
        at, seen = up[s, n], {n}
        while at is not None and (s, at) in up and at not in seen:
            want.setdefault(at, set()).add(n)
            seen.add(at)
            at = up[s, at]
    for r in got:
        below = {places[r["component"], i] for i in range(r["first"], r["last"] + 1)} - {r["node"]}
        assert below == want.get(r["node"], set())


def test_paths_are_made_in_batches():
    walk = hierarchy.Walk([str(i) for i in range(3000)], [str(i - 1) if i else None for i in range(3000)])
    names = hierarchy.pa.array(walk.ids)
    batches = list(hierarchy._paths(walk, names))
    assert len(batches) > 10 and all(len(p.flatten()) <= hierarchy.PATH_CELLS for _, p in batches)
    assert [len(p) for _, b in batches for p in b] == list(range(1, 3001)) and batches[0][1][2].as_py() == ["0", "1", "2"]


@pytest.mark.parametrize("local_rows", [10000, 100])
def test_long_chain(spark, local_rows):
    n = 700
    got = rows(spark, [("d", str(i), str(i - 1) if i else None) for i in range(n)], local_rows=local_rows)
    assert got[str(n - 1)]["node_depth"] == n - 1 and got["0"]["n_descendants"] == n - 1


def test_descendants(spark):
    df = spark.createDataFrame([("d", "a", None, ""), ("d", "b", "a", ""), ("d", "c", "b", "")], EDGES)
    got = {tuple(r) for r in hierarchy.descendants(hierarchy.build_hierarchy(df, paths=True)).collect()}
    assert got == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}


@pytest.mark.parametrize("local_rows", [1000, 2])
def test_descendants_on_and_below_cycles(spark, local_rows):
    edges = [("a", "1", None), ("a", "2", "1"), ("a", "x", "z"), ("a", "y", "x"), ("a", "z", "y"), ("a", "k", "y"), ("a", "l", "k"), ("a", "self", "self"), ("a", "s", "self"), *[(f"r{s}", f"r{n}", p and f"r{p}") for s, n, p in random_forest(1, 60)]]
    df = spark.createDataFrame([(*e, "") for e in edges], EDGES)
    got = hierarchy.build_hierarchy(df, paths=True, local_rows=local_rows)
    links = [tuple(r) for r in hierarchy.descendants(got).unionByName(hierarchy.cycle_descendants(df, got)).collect()]
    up, want = {(s, n): p for s, n, p in edges}, set()
    for s, n, _ in edges:
        at, k, seen = up[s, n], 1, {n}
        while at is not None and (s, at) in up and at not in seen:
            want.add((at, n, k))
            seen.add(at)
            at, k = up[s, at], k + 1
    assert len(links) == len(set(links)) and set(links) == want and {("z", "l", 4), ("self", "s", 1)} <= want
    counts = {r["node"]: r["n_descendants"] for r in got.collect()}
    assert all(sum(a == n for a, _, _ in links) == k for n, k in counts.items())


def test_empty(spark):
    assert rows(spark, []) == {}
