"""References to records that do not exist.

References may be composite and partly NULL. They are grouped by null mask (one
branch per combination of present columns, a number fixed by the schema) and
each mask is anti-joined to the targets on its non-NULL columns only, under a
declared match semantics:

* ``simple``: a reference with any NULL is not checked;
* ``partial``: the present columns must match some target;
* ``full``: all columns or none must be present, a mixed one is an orphan.

Defined results: an all-NULL reference is no reference. Empty references give
no rows; an empty target table makes every checked reference missing. Repeated
references come out as often as they go in; extra columns pass through, the
targets' never do. A hot key costs one target row per mask: the targets are
made distinct on the mask's columns before the join, so the join only streams
the reference side, which AQE splits.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = ("simple", "partial", "full")


def by_mask(refs: DataFrame, ref_cols: list[str]) -> list[tuple[tuple[bool, ...], DataFrame]]:
    """The references of each null mask but the all-NULL one."""
    out = []
    for mask in product((True, False), repeat=len(ref_cols)):
        if any(mask):
            test = F.lit(True)
            for col, present in zip(ref_cols, mask):
                test = test & (F.col(col).isNotNull() if present else F.col(col).isNull())
            out.append((mask, refs.where(test)))
    return out


def _on(mask: tuple[bool, ...], ref_cols: list[str], keys: list[str]) -> Column:
    test = F.lit(True)
    for col, key, present in zip(ref_cols, keys, mask):
        if present:
            test = test & (F.col(col) == F.col(key))
    return test


def _keyed(targets: DataFrame, mask: tuple[bool, ...], key_cols: list[str]) -> tuple[DataFrame, list[str]]:
    names = [f"__t{i}" for i in range(len(key_cols))]
    return targets.select(*[F.col(k).alias(n) for k, n, p in zip(key_cols, names, mask) if p]).distinct(), names


def find_missing(refs: DataFrame, targets: DataFrame, ref_cols: list[str], key_cols: list[str], match: str = "simple") -> DataFrame:
    """The references without a target, with the column ``null_mask``.

    ``null_mask`` has one character per column, 1 where it is present.
    """
    if match not in MATCHES or len(ref_cols) != len(key_cols):
        raise ValueError(f"match must be one of {MATCHES} and the column lists equally long")
    out = None
    for mask, some in by_mask(refs, ref_cols):
        if not all(mask):
            if match == "simple":
                continue
            if match == "full":
                part = some
            else:
                keyed, names = _keyed(targets, mask, key_cols)
                part = some.join(keyed, _on(mask, ref_cols, names), "left_anti")
        else:
            keyed, names = _keyed(targets, mask, key_cols)
            part = some.join(keyed, _on(mask, ref_cols, names), "left_anti")
        part = part.withColumn("null_mask", F.lit("".join("1" if p else "0" for p in mask)))
        out = part if out is None else out.unionByName(part)
    return refs.limit(0).withColumn("null_mask", F.lit("")) if out is None else out


def classify_orphans(refs: DataFrame, targets: DataFrame, ref_key: str, target_key: str, ref_time: str, target_time: str, target_deleted: str) -> DataFrame:
    """Orphan references with ``orphan_kind``, first that holds.

    missing: no target; deleted: all its targets are deleted; late: every live
    target was created after the reference. ``targets`` may repeat a key. A
    NULL time on either side is never late.
    """
    by_key = (
        targets.where(F.col(target_key).isNotNull())
        .groupBy(F.col(target_key).alias("__key"))
        .agg(
            F.min(F.when(F.col(target_deleted), 1).otherwise(0)).alias("__all_deleted"),
            F.min(F.when(~F.col(target_deleted), F.col(target_time))).alias("__first"),
            F.max(~F.col(target_deleted) & F.col(target_time).isNull()).alias("__untimed"),
        )
    )
    missing = find_missing(refs, by_key, [ref_key], ["__key"]).drop("null_mask").withColumn("orphan_kind", F.lit("missing"))
    there = refs.where(F.col(ref_key).isNotNull()).join(by_key, F.col(ref_key) == F.col("__key"))
    late = ~F.col("__untimed") & (F.col("__first") > F.col(ref_time))
    kept = there.withColumn("orphan_kind", F.when(F.col("__all_deleted") == 1, "deleted").when(late, "late")).where(F.col("orphan_kind").isNotNull())
    return missing.unionByName(kept.drop("__key", "__all_deleted", "__first", "__untimed"))


def orphan_report(orphans: DataFrame, table: str, kind: str, month: str) -> DataFrame:
    """Orphans counted per table, period and kind."""
    return orphans.groupBy(table, month, kind).agg(F.count(F.lit(1)).alias("n_orphans"))
