"""Parent-child links to full hierarchies.

Every node has at most one parent, so a connected component is a tree or a
single cycle with trees below it. An edge counts only within its scope (the
dialogue), so no component leaves its scope:

* scopes of at most ``local_rows`` nodes are co-located by one shuffle, and so
  are all their components; a task finds them and walks each by an iterative
  depth-first search with node colouring;
* of a larger scope the components are found first, by label propagation with
  pointer jumping; each component of at most ``local_rows`` nodes is then
  co-located and walked in the same way;
* a single component beyond that is never collected: it is resolved by pointer
  doubling, ceil(log2(depth)) rounds of one self-join, whose subtree sizes are
  combined map-side.

All ways return the same rows, whatever the order of the input: siblings are
visited in the order of their ids, and the back edge of a cycle is the one from
its smallest node to that node's parent.

Defined results: a NULL, blank, unknown or out-of-scope parent makes a root of
depth 0; a node that is its own parent is a cycle of one; nodes on or below a
cycle get root '' and depth -1 and an empty path; repeated rows of an id are
the caller's to reduce (``current_rows``); an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import split_sum
from ..session import materialize, release

LOCAL_ROWS = 50_000
#: Path cells that one output batch may hold, but for a single longer path.
PATH_CELLS = 1 << 18
WHITE, GREY, BLACK = 0, 1, 2


class Walk:
    """Depth-first walk of the nodes of one or more scopes.

    ``parents`` holds the key of the parent among ``ids`` or None. Colours:
    white unseen, grey on the current upward chain, black finished. A grey
    parent closes a back edge, whose chain is the component's cycle. Results by
    node: root ('' off trees), depth (-1 off trees), below (descendants), back,
    component (its root, or its cycle's smallest node), place (number in
    preorder within the component), ring; ``order`` lists the nodes as visited.
    """

    def __init__(self, ids: list, parents: list):
        n = len(ids)
        at = {key: i for i, key in enumerate(ids)}
        self.ids, self.up = ids, [-1 if p is None else at.get(p, -1) for p in parents]
        # pushed in descending order, so that the stack gives ascending ids
        self.kids: list[list[int]] = [[] for _ in range(n)]
        for i in sorted(range(n), key=ids.__getitem__, reverse=True):
            if self.up[i] >= 0:
                self.kids[self.up[i]].append(i)
        self.colour = [WHITE] * n
        self.root, self.depth, self.below = [""] * n, [-1] * n, [0] * n
        self.level, self.component, self.place = [0] * n, [-1] * n, [0] * n
        self.back, self.ring = [False] * n, [False] * n
        self.order: list[int] = []
        for i in range(n):
            if self.up[i] < 0:
                self._descend(i, True)
        for i in range(n):
            if self.colour[i] == WHITE:
                self._cycle(i)

    def _descend(self, start: int, tree: bool) -> int:
        """Visit all below ``start``; the number of nodes, itself included."""
        up, first, stack = self.up, len(self.order), [start]
        while stack:
            v = stack.pop()
            self.colour[v] = BLACK
            self.component[v], self.place[v] = start, len(self.order) - first
            self.order.append(v)
            if v != start:
                self.level[v] = self.level[up[v]] + 1
            if tree:
                self.depth[v], self.root[v] = self.level[v], self.ids[start]
            # the start of a cycle is black when its turn comes round
            stack += [k for k in self.kids[v] if self.colour[k] == WHITE]
        for v in reversed(self.order[first:]):
            if v != start:
                self.below[up[v]] += self.below[v] + 1
        return len(self.order) - first

    def _cycle(self, i: int) -> None:
        chain, v = [], i
        while self.colour[v] == WHITE:
            self.colour[v] = GREY
            chain.append(v)
            v = self.up[v]
        ring = chain[chain.index(v) :]
        for v in chain:
            self.colour[v] = WHITE
        # cut at the smallest node, the component is a tree
        start = min(ring, key=self.ids.__getitem__)
        self.back[start] = True
        size = self._descend(start, False)
        for v in ring:
            self.ring[v], self.below[v] = True, size - 1


def _paths(walk: Walk, names: pa.Array) -> Iterator[tuple[list[int], pa.Array]]:
    """Nodes in visiting order with their paths, ``PATH_CELLS`` at a time.

    The path of a node is the visited stack up to its level, so no path is
    stored before its batch is due.
    """
    stack = np.zeros(len(walk.ids) + 1, np.int64)
    nodes: list[int] = []
    cells: list[np.ndarray] = []
    held = 0

    def batch() -> tuple[list[int], pa.Array]:
        offsets = np.zeros(len(nodes) + 1, np.int32)
        np.cumsum([len(c) for c in cells], out=offsets[1:])
        return nodes, pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(np.concatenate(cells))))

    for v in walk.order:
        depth = walk.depth[v]
        if depth >= 0:
            stack[depth] = v
        if nodes and held + depth + 1 > PATH_CELLS:
            yield batch()
            nodes, cells, held = [], [], 0
        nodes.append(v)
        cells.append(stack[: depth + 1].copy())
        held += depth + 2
    if nodes:
        yield batch()


FIELDS = "node string, root_node string, node_depth int, n_descendants bigint, back_edge boolean, component string, place bigint, on_ring boolean"


def _columns(paths: bool) -> list[str]:
    return ["node", "root_node", "node_depth", "n_descendants", "back_edge", "component", "place", "on_ring", *(["path"] if paths else [])]


def _local(local: DataFrame, paths: bool) -> DataFrame:
    """Co-located scopes through the depth-first walk, whole scopes at a time."""
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.bool_()] + ([pa.list_(pa.string())] if paths else [])
    schema = pa.schema(list(zip(_columns(paths), kinds)))

    def emit(scopes: list[str], nodes: list[str], parents: list[str | None]) -> Iterator[pa.RecordBatch]:
        walk = Walk(list(zip(scopes, nodes)), [None if p is None else (s, p) for s, p in zip(scopes, parents)])
        names = pa.array(nodes, pa.string())
        for rows, path in _paths(walk, names) if paths else [(walk.order, None)]:
            take = lambda values, kind: pa.array([values[v] for v in rows], kind)  # noqa: B023, E731
            cols = [
                names.take(pa.array(rows, pa.int64())),
                pa.array([walk.root[v][1] if walk.root[v] else "" for v in rows], pa.string()),
                take(walk.depth, pa.int32()),
                take(walk.below, pa.int64()),
                take(walk.back, pa.bool_()),
                names.take(take(walk.component, pa.int64())),
                take(walk.place, pa.int64()),
                take(walk.ring, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(cols + ([path] if paths else []), schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scopes: list[str] = []
        nodes: list[str] = []
        parents: list[str | None] = []
        for batch in batches:
            scopes += batch.column(0).to_pylist()
            nodes += batch.column(1).to_pylist()
            parents += batch.column(2).to_pylist()
            # the last scope of a batch may go on in the next one
            cut = len(scopes)
            while cut and scopes[cut - 1] == scopes[-1]:
                cut -= 1
            if cut:
                yield from emit(scopes[:cut], nodes[:cut], parents[:cut])
                scopes, nodes, parents = scopes[cut:], nodes[cut:], parents[cut:]
        if scopes:
            yield from emit(scopes, nodes, parents)

    return local.repartition("scope").sortWithinPartitions("scope").select("scope", "node", "parent").mapInArrow(run, FIELDS + (", path array<string>" if paths else ""))


def _double_tree(edges: DataFrame, paths: bool, label: str) -> tuple[DataFrame, DataFrame]:
    """Pointer doubling over (scope, node, parent, step); parent NULL at roots.

    Returns the resolved nodes (scope, node, top, depth, size, steps[, path])
    and the state of the nodes whose chain never ends (jump is then some node
    further up the cycle or on it). ``steps`` sums ``step`` over the path.
    """
    moved = F.col("jump").isNotNull()
    more = lambda x: [x] if paths else []
    start = edges.select("scope", "node", F.col("parent").alias("jump"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"), F.coalesce("parent", "node").alias("top"), F.lit(1).cast("long").alias("size"), F.col("step").alias("steps"), *more(F.array("node").alias("path")))
    state, open_before = materialize(start, label), -1
    while True:
        still = state.where(moved).count()
        if still == 0 or still == open_before:
            break
        open_before = still
        above = state.select("scope", F.col("node").alias("jump"), F.col("jump").alias("a_jump"), F.col("depth").alias("a_depth"), F.col("top").alias("a_top"), F.col("steps").alias("a_steps"), *more(F.col("path").alias("a_path")))
        gained = state.where(moved).groupBy("scope", F.col("jump").alias("node")).agg(F.sum("size").alias("gain"))
        joined = state.join(above, ["scope", "jump"], "left").join(gained, ["scope", "node"], "left")
        following = materialize(
            joined.select(
                "scope",
                "node",
                F.col("a_jump").alias("jump"),
                F.when(moved, F.col("depth") + F.col("a_depth")).otherwise(F.col("depth")).alias("depth"),
                F.when(moved, F.col("a_top")).otherwise(F.col("top")).alias("top"),
                (F.col("size") + F.coalesce("gain", F.lit(0))).alias("size"),
                F.when(moved, F.col("steps") + F.col("a_steps")).otherwise(F.col("steps")).alias("steps"),
                *more(F.when(moved, F.concat("a_path", "path")).otherwise(F.col("path")).alias("path")),
            ),
            label,
        )
        release(state)
        state = following
    return state.where("jump is null"), state.where("jump is not null")


def _rings(edges: DataFrame, looped: DataFrame) -> DataFrame:
    """(scope, node, low): the nodes on cycles with their cycle's smallest.

    ``looped`` is the state of pointer doubling on and below the cycles. Images
    of the repeated jump shrink until only cycle nodes are left.
    """
    jumps = materialize(looped.select("scope", "node", "jump"), "ring")
    count = -1
    while True:
        ring = materialize(jumps.select("scope", F.col("jump").alias("node")).distinct(), "ring")
        now = ring.count()
        if now == count:
            break
        count = now
        above = jumps.select("scope", F.col("node").alias("jump"), F.col("jump").alias("next"))
        following = materialize(jumps.join(above, ["scope", "jump"]).select("scope", "node", F.col("next").alias("jump")), "ring")
        release(jumps)
        release(ring)
        jumps = following
    # the smallest node, by doubling along the cycle
    reach = materialize(edges.join(ring, ["scope", "node"], "left_semi").select("scope", "node", F.col("parent").alias("jump"), F.least("node", "parent").alias("low")), "lap")
    for _ in range(max(1, count).bit_length()):
        above = reach.select("scope", F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("low").alias("a_low"))
        following = materialize(reach.join(above, ["scope", "jump"]).select("scope", "node", F.col("next").alias("jump"), F.least("low", "a_low").alias("low")), "lap")
        release(reach)
        reach = following
    return reach.select("scope", "node", "low")


def _cut(edges: DataFrame, rings: DataFrame) -> DataFrame:
    """The edges without the one from each cycle's smallest node."""
    smallest = rings.where("node = low").select("scope", "node", F.lit(True).alias("__cut"))
    return edges.join(smallest, ["scope", "node"], "left").withColumn("parent", F.when(F.col("__cut"), None).otherwise(F.col("parent"))).drop("__cut")


def components(edges: DataFrame) -> DataFrame:
    """scope, node, parent and the component of each node of a large scope.

    Labels run down the links by pointer jumping: a tree's label is its root, a
    cycle's component has that of the cycle's smallest node.
    """
    links = edges.select("scope", "node", "parent", F.lit(0).cast("long").alias("step"))
    trees, looped = _double_tree(links, False, "label")
    if not looped.isEmpty():
        trees, _ = _double_tree(_cut(links, materialize(_rings(edges, looped), "rings")), False, "label")
    return edges.join(trees.select("scope", "node", F.col("top").alias("component")), ["scope", "node"])


def _large(edges: DataFrame, paths: bool) -> DataFrame:
    """Components beyond one task's bound, by joins and aggregations only."""
    plain = edges.withColumn("step", F.lit(0).cast("long"))
    trees, looped = _double_tree(plain, False, "tree")
    cut, rings = plain, None
    if not looped.isEmpty():
        rings = materialize(_rings(edges, looped), "rings")
        cut = _cut(plain, rings)
        trees, _ = _double_tree(cut, False, "hung")
    # a node comes after its parent and the subtrees of its smaller siblings
    sized = cut.drop("step").join(trees.select("scope", "node", "size"), ["scope", "node"])
    tops = sized.where("parent is null").select("scope", "node", "parent", F.lit(0).cast("long").alias("step"))
    inner = sized.where("parent is not null").withColumn("__family", F.concat_ws("\x1f", "scope", "parent"))
    steps = split_sum(inner, "__family", [F.col("node")], F.col("size"), "before").select("scope", "node", "parent", (F.col("before") + 1).alias("step"))
    placed, _ = _double_tree(materialize(tops.unionByName(steps), "steps"), paths, "place")
    if rings is None:
        rings = edges.select("scope", "node", F.col("node").alias("low")).limit(0)
    looping = rings.where("node = low").select("scope", F.col("low").alias("top"), F.lit(True).alias("cyclic"))
    whole = placed.where("jump is null and depth = 0").select("scope", F.col("node").alias("top"), F.col("size").alias("whole"))
    rows = placed.join(looping, ["scope", "top"], "left").join(rings.select("scope", "node", F.lit(True).alias("on_ring")), ["scope", "node"], "left").join(whole, ["scope", "top"])
    cyclic, on_ring = F.coalesce("cyclic", F.lit(False)), F.coalesce("on_ring", F.lit(False))
    out = rows.select(
        "node",
        F.when(cyclic, "").otherwise(F.col("top")).alias("root_node"),
        F.when(cyclic, -1).otherwise(F.col("depth")).cast("int").alias("node_depth"),
        (F.when(on_ring, F.col("whole")).otherwise(F.col("size")) - 1).alias("n_descendants"),
        (cyclic & (F.col("node") == F.col("top"))).alias("back_edge"),
        F.col("top").alias("component"),
        F.col("steps").alias("place"),
        on_ring.alias("on_ring"),
        *([F.when(cyclic, F.array().cast("array<string>")).otherwise(F.col("path")).alias("path")] if paths else []),
    )
    return out.select(*_columns(paths))


def _beyond(edges: DataFrame, local_rows: int) -> DataFrame:
    """The scopes of more nodes than a task may hold: at most rows / local_rows."""
    sizes = edges.groupBy("scope").agg(F.count(F.lit(1)).alias("n_nodes"))
    return materialize(sizes.where(F.col("n_nodes") > local_rows).select("scope"), "bigscopes")


def build_hierarchy(edges: DataFrame, paths: bool = False, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Root, depth, descendants, cycle marks, component and place of each node.

    ``edges`` has the columns scope, node, parent (strings, node unique within
    its scope, no NULL scope or node); others are ignored. ``paths`` adds the
    path. ``local_rows`` bounds the nodes of a scope or component that one task
    holds. See the module text for the defined cases.
    """
    edges = edges.select("scope", "node", "parent")
    big = _beyond(edges, local_rows)
    if big.isEmpty():
        return _local(edges, paths)
    large = edges.join(big, "scope", "left_semi")
    known = large.select(F.col("scope"), F.col("node").alias("parent"), F.lit(True).alias("known"))
    large = materialize(large.join(known, ["scope", "parent"], "left").select("scope", "node", F.when(F.col("known"), F.col("parent")).alias("parent")), "large")
    parts = materialize(components(large).select(F.concat_ws("\x1f", "scope", "component").alias("scope"), "node", "parent"), "components")
    release(large)
    out = _local(edges.join(big, "scope", "left_anti"), paths)
    giant = _beyond(parts, local_rows)
    if giant.isEmpty():
        return out.unionByName(_local(parts, paths))
    out = out.unionByName(_local(parts.join(giant, "scope", "left_anti"), paths))
    return out.unionByName(_large(materialize(parts.join(giant, "scope", "left_semi"), "giant"), paths))


def descendant_ranges(hierarchy: DataFrame) -> DataFrame:
    """component, node, place, first, last: all descendants as a range.

    The descendants of a node are the other nodes of its component whose place
    lies from ``first`` to ``last``: the rows below it in preorder, or the
    whole component for a node on a cycle. One row per node, however many
    descendants it has; ``first`` > ``last`` where it has none.
    """
    below = F.col("n_descendants")
    return hierarchy.select(
        "component",
        "node",
        "place",
        F.when(F.col("on_ring") & (below > 0), F.lit(0)).otherwise(F.col("place") + 1).cast("long").alias("first"),
        F.when(F.col("on_ring") & (below > 0), below).otherwise(F.col("place") + below).cast("long").alias("last"),
    )


def descendants(hierarchy: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) rows from the paths of ``hierarchy``.

    Exploding each node's own path needs no join. Nodes on or below cycles have
    no path and give no rows here but in ``cycle_descendants``.
    """
    return (
        hierarchy.where(F.size("path") > 1)
        .select(F.col("node").alias("descendant"), F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("pos", "ancestor"), F.size("path").alias("len"))
        .select("ancestor", "descendant", (F.col("len") - 1 - F.col("pos")).cast("int").alias("distance"))
    )


def cycle_descendants(edges: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) rows on and below cycles.

    Takes ``edges`` and their ``hierarchy``; nodes are unique over all scopes.
    Each cycle is cut at its marked node, which makes its component a tree; the
    paths of that tree give the links that don't pass the cut. The ring is the
    path of the marked node's parent; a node that hangs at place j of it is
    reached through the cut by the ring nodes after j. Rows per ancestor equal
    n_descendants.
    """
    marks = hierarchy.where("node_depth = -1").select("node", "back_edge")
    cyclic = materialize(edges.select("scope", "node", "parent").join(marks, "node"), "cyclic")
    cut = cyclic.select("scope", "node", F.when(~F.col("back_edge"), F.col("parent")).alias("parent"))
    trees = materialize(build_hierarchy(cut, paths=True), "cut")
    tails = cyclic.where("back_edge").select(F.col("node").alias("root_node"), F.col("parent").alias("tail"))
    rings = trees.select(F.col("node").alias("tail"), F.col("path").alias("ring")).join(tails, "tail").select("root_node", "ring")
    # ring nodes on a path are its head; those of the ring after them come round
    hung = trees.join(rings, "root_node").withColumn("held", F.size(F.array_intersect("path", "ring")))
    rest = F.slice("ring", F.col("held") + 1, F.greatest(F.size("ring") - F.col("held"), F.lit(0)))
    round_ = hung.select(F.col("node").alias("descendant"), F.size("path").alias("len"), F.size("ring").alias("n_ring"), "held", F.posexplode(rest).alias("pos", "ancestor"))
    links = round_.select("ancestor", "descendant", (F.col("n_ring") - F.col("held") - F.col("pos") + F.col("len") - 1).cast("int").alias("distance"))
    return descendants(trees).unionByName(links)
