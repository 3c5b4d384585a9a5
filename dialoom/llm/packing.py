"""Filling fixed-capacity containers with items.

How to fill containers depends only on how many items there are of each size,
a histogram of at most ``capacity`` rows, however many items there are. It is
planned per profile by exact-complement hashing: the largest size left opens a
container, whose gap is looked up as a single size, a sum of two and a sum of
three under the availability counts; a combination found is used for as many
containers as the counts allow. A gap that no combination fills takes the
largest size that fits and is looked up again. What no size fits is left open.
Each step uses up a size, so the plan stays in the order of ``capacity`` rows.

Items then get their place by rank within their size. Ranks are counted per
(size, salt), so a size that a third of all items share is ranked by many
tasks, and the plan (bounded, not by the items) goes to every worker.

Defined results: items larger than the capacity are cut into parts of exactly
the capacity and one rest; no other is cut; items without tokens and NULL
sizes are left out; equal sizes are ordered by document id; repeated ids are
separate items; empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import bpe

ROWS_PER_SALT = 200_000


def _pair(mask: np.ndarray, counts: np.ndarray, total: int) -> tuple[int, int] | None:
    """Two available sizes whose sum is ``total``, the most uneven first."""
    if total < 2:
        return None
    low = max(1, total - len(mask) + 1)
    half = total // 2
    if low > half:
        return None
    both = mask[low : half + 1] & mask[total - half : total - low + 1][::-1]
    if total % 2 == 0 and both[-1] and counts[half] < 2:
        both[-1] = False
    at = int(np.argmax(both))
    return (low + at, total - low - at) if both[at] else None


def _complement(mask: np.ndarray, counts: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available sizes that fill ``gap`` exactly."""
    if gap < len(mask) and mask[gap]:
        return (gap,)
    if two := _pair(mask, counts, gap):
        return two
    sizes = np.flatnonzero(mask[: min(len(mask), gap - 1)])
    for t in sizes[::-1].tolist():
        if 3 * t < gap:
            break  # the largest of three is at least a third
        counts[t] -= 1
        gone = counts[t] == 0
        if gone:
            mask[t] = False
        two = _pair(mask, counts, gap - t)
        counts[t] += 1
        mask[t] = True
        if two:
            return (t, *two)
    return None


def plan_containers(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(sizes with their number in a container, number of such containers)."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        have[size] = n
    mask = have > 0
    out: list[tuple[dict[int, int], int]] = []
    top = capacity
    while True:
        while top and not mask[top]:
            top -= 1
        if not top:
            return out
        content: dict[int, int] = {}

        def take(size: int) -> None:
            content[size] = content.get(size, 0) + 1
            have[size] -= 1
            mask[size] = have[size] > 0

        take(top)
        gap = capacity - top
        while gap:
            if found := _complement(mask, have, gap):
                for size in found:
                    take(size)
                break
            fits = np.flatnonzero(mask[: gap + 1])
            if not len(fits):
                break
            # many of the largest size at once, but stay within reach of three
            size = int(fits[-1])
            take(size)
            gap -= size
        for size, n in content.items():
            have[size] += n
        times = min(int(have[size]) // n for size, n in content.items())
        for size, n in content.items():
            have[size] -= n * times
            mask[size] = have[size] > 0
        out.append((content, times))


def _plan(sizes: DataFrame) -> DataFrame:
    """The plan of each profile: size, first slot, items per container, id."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        profile, capacity = int(pdf["profile_id"].iloc[0]), int(pdf["capacity"].iloc[0])
        slot: dict[int, int] = {}
        rows, base = [], 0
        for content, times in plan_containers(dict(zip(pdf["size"].tolist(), pdf["n"].tolist())), capacity):
            for size, n in content.items():
                rows.append((profile, size, slot.get(size, 0), n, base))
                slot[size] = slot.get(size, 0) + n * times
            base += times
        return pd.DataFrame(rows, columns=["profile_id", "size", "slot", "per", "base"])

    return sizes.groupBy("profile_id").applyInPandas(run, "profile_id int, size long, slot long, per long, base long")


def assign_containers(items: DataFrame, profiles: DataFrame) -> DataFrame:
    """profile_id, doc_id, part_no, n_tokens, container_id of each part.

    ``items`` has doc_id, tokenizer and n_tokens; ``profiles`` profile_id,
    tokenizer and capacity (a short fixed table).
    """
    spark = items.sparkSession
    profiles = profiles.select("profile_id", "tokenizer", "capacity").distinct()
    parts = (
        items.where("n_tokens > 0")
        .join(F.broadcast(profiles), "tokenizer")
        .withColumn("n_parts", F.ceil(F.col("n_tokens") / F.col("capacity")).cast("int"))
        .select("profile_id", "doc_id", F.col("capacity").cast("long").alias("capacity"), "n_tokens", "n_parts", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part_no"))
        .withColumn("size", F.least(F.col("capacity"), F.col("n_tokens") - F.col("part_no") * F.col("capacity")))
        .select("profile_id", "capacity", "doc_id", "part_no", "size")
    )
    parts = materialize(parts, "parts")
    salts = max(8, -(-parts.count() // ROWS_PER_SALT))
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part_no"), F.lit(salts)).cast("int"))
    tally = materialize(parts.groupBy("profile_id", "capacity", "size", "salt").agg(F.count(F.lit(1)).alias("n")), "tally")
    # at most capacity rows per profile, and a plan of the same order
    plan = _plan(tally.groupBy("profile_id", "capacity", "size").agg(F.sum("n").alias("n"))).toPandas()
    before = Window.partitionBy("profile_id", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select("profile_id", "size", "salt", "offset")
    within = Window.partitionBy("profile_id", "size", "salt").orderBy("doc_id", "part_no")
    ranked = parts.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["profile_id", "size", "salt"])
    ranked = ranked.select("profile_id", "doc_id", "part_no", F.col("size").alias("n_tokens"), (F.col("offset") + F.col("at")).alias("slot"))

    by_profile = {}
    for profile, rows in plan.groupby("profile_id"):
        rows = rows.sort_values(["size", "slot"])
        # one sorted key for size and slot: sizes start at multiples of the widest slot
        width = int(rows["slot"].max()) + 1
        by_profile[int(profile)] = (width, (rows["size"] * (width + 1) + rows["slot"]).to_numpy(), rows[["slot", "per", "base"]].to_numpy())
    shared = spark.sparkContext.broadcast(by_profile)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            profile, size, slot = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4))
            container = np.zeros(b.num_rows, dtype=np.int64)
            for p in np.unique(profile):
                width, keys, rows = shared.value[int(p)]
                mine = profile == p
                at = np.searchsorted(keys, size[mine] * (width + 1) + np.minimum(slot[mine], width), side="right") - 1
                container[mine] = rows[at, 2] + (slot[mine] - rows[at, 0]) // rows[at, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(container)], ["profile_id", "doc_id", "part_no", "n_tokens", "container_id"])

    kind = items.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"profile_id int, doc_id {kind}, part_no int, n_tokens bigint, container_id bigint")


def pack_documents(docs: DataFrame, profiles: DataFrame, directory: str = bpe.TOKENIZER_DIR) -> DataFrame:
    """Containers of the documents for each profile, sized by its tokenizer."""
    names = sorted({r[0] for r in profiles.select("tokenizer").distinct().collect()})
    sizes = None
    for name in names:
        part = bpe.count_tokens(docs, name, directory).withColumn("tokenizer", F.lit(name))
        sizes = part if sizes is None else sizes.unionByName(part)
    return assign_containers(sizes, profiles)


def container_report(assigned: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: containers, tokens, unused space, its share, and a lower bound.

    No packing has fewer than ``least_containers``: the tokens over the
    capacity, rounded up, or the parts of more than half of it, each of which
    needs a container of its own.
    """
    # pre-aggregated per container, so that a profile of all rows is no hot key
    sized = assigned.join(F.broadcast(profiles.select("profile_id", "capacity").distinct()), "profile_id")
    each = sized.groupBy("profile_id", "capacity", "container_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.when(2 * F.col("n_tokens") > F.col("capacity"), 1)).alias("n_large"))
    rows = each.groupBy("profile_id", "capacity").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_large").alias("n_large"))
    unused = F.col("n_containers") * F.col("capacity") - F.col("n_tokens")
    return rows.select("profile_id", "capacity", "n_containers", "n_tokens", unused.alias("unused"), (unused / (F.col("n_containers") * F.col("capacity"))).alias("unused_share"), F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")), "n_large").alias("least_containers"))
