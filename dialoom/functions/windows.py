"""Ranks and carried values within groups that may be very large.

A plain window gives a whole group to one task. Here rows are range-partitioned
by group and order, so a hot group spreads over many tasks; each task ranks its
piece, and the pieces' sizes (one row per task and group) are summed before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def split_rank(df: DataFrame, group: str, order: list[Column], rank: str, carry: tuple[Column, str] | None = None) -> DataFrame:
    """``df`` with the zero-based rank in its group.

    ``carry`` (value, name) adds the last non-NULL value before each row.
    Rows equal in the order keep an arbitrary order; make it unique.
    """
    keys = [c.alias(f"__o{i}") for i, c in enumerate(order)]
    ranged = df.select("*", *keys).repartitionByRange(F.col(group), *[F.col(f"__o{i}") for i in range(len(order))])
    pieces = materialize(ranged.select("*", F.spark_partition_id().alias("__piece")), "pieces")
    sort = [F.col(f"__o{i}") for i in range(len(order))]
    local = Window.partitionBy("__piece", group).orderBy(*sort)
    upto = local.rowsBetween(Window.unboundedPreceding, -1)
    rows = pieces.withColumn("__at", F.row_number().over(local) - 1)
    sizes = [F.count(F.lit(1)).alias("__n")]
    if carry:
        rows = rows.withColumn("__here", F.last(carry[0], ignorenulls=True).over(upto))
        sizes.append(F.max_by(carry[0], F.when(carry[0].isNotNull(), F.struct(*sort))).alias("__last"))
    before = Window.partitionBy(group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy(group, "__piece").agg(*sizes).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    if carry:
        starts = starts.withColumn("__before", F.last("__last", ignorenulls=True).over(before))
    out = rows.join(starts.drop("__n", "__last"), [group, "__piece"]).withColumn(rank, (F.col("__start") + F.col("__at")).cast("int"))
    if carry:
        out = out.withColumn(carry[1], F.coalesce("__here", "__before"))
    return out.drop("__piece", "__at", "__start", "__here", "__before", *[f"__o{i}" for i in range(len(order))])


def split_sum(df: DataFrame, group: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each in its group."""
    keys = [c.alias(f"__o{i}") for i, c in enumerate(order)]
    sort = [F.col(f"__o{i}") for i in range(len(order))]
    ranged = df.select("*", *keys).repartitionByRange(F.col(group), *sort)
    pieces = materialize(ranged.select("*", F.spark_partition_id().alias("__piece")), "pieces")
    upto = Window.partitionBy("__piece", group).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy(group, "__piece").agg(F.sum(value).alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    rows = pieces.withColumn("__here", F.coalesce(F.sum(value).over(upto), F.lit(0)))
    return rows.join(starts.drop("__n"), [group, "__piece"]).withColumn(name, F.col("__start") + F.col("__here")).drop("__piece", "__start", "__here", *[f"__o{i}" for i in range(len(order))])
