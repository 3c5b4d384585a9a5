"""The annotation store: one table of typed annotations.

Rows: entity_type, entity_id, key, value_type (flag, string, numeric, json),
value (text form; NULL for flags), confidence, reason, source, source_version,
created_at. Stored partitioned by entity_type and value_type, it serves the
sixteen typed tables as partitions. Flags and json are unique per entity and
key, strings and numbers per value too.

Defined results: writes of rows that are there change nothing, but json takes
the newest value; rows repeated within a write count once; an unknown
value_type raises ValueError; reads of unknown keys are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY_TYPES = ("content_part", "message", "prompt_response", "dialogue")
VALUE_TYPES = ("flag", "string", "numeric", "json")
SCHEMA = "entity_type string, entity_id string, key string, value_type string, value string, confidence double, reason string, source string, source_version string, created_at timestamp"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def empty_store(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def table_name(entity_type: str, value_type: str) -> str:
    """Name of the typed table of an entity and value type."""
    if entity_type not in ENTITY_TYPES or value_type not in VALUE_TYPES:
        raise ValueError(f"unknown entity or value type: {entity_type}, {value_type}")
    return f"{entity_type}_annotations_{value_type}"


def typed(value: Column | None, value_type: str) -> Column:
    """The text form of a value of a type."""
    if value_type not in VALUE_TYPES:
        raise ValueError(f"unknown value type: {value_type}")
    if value_type == "flag" or value is None:
        return F.lit(None).cast("string")
    return value.cast("double").cast("string") if value_type == "numeric" else value.cast("string")


def annotation(key: str, value_type: str, value: Column | None = None, confidence: Column | float | None = None, reason: Column | str | None = None) -> Column:
    """An annotation struct, to be filtered and exploded by an annotator."""
    as_col = lambda x, kind: (x if isinstance(x, Column) else F.lit(x)).cast(kind)
    return F.struct(F.lit(key).alias("key"), F.lit(value_type).alias("value_type"), typed(value, value_type).alias("value"), as_col(confidence, "double").alias("confidence"), as_col(reason, "string").alias("reason"))


def rows_of(df: DataFrame, entity_type: str, entity_id: str, found: Column, source: str = "heuristic", version: str = "1.0") -> DataFrame:
    """Annotation rows from an array of annotation structs (NULLs dropped)."""
    items = F.filter(found, lambda x: x.isNotNull())
    return df.select(F.lit(entity_type).alias("entity_type"), F.col(entity_id).alias("entity_id"), F.explode(items).alias("a")).select(
        "entity_type", "entity_id", "a.*", F.lit(source).alias("source"), F.lit(version).alias("source_version"), F.lit(None).cast("timestamp").alias("created_at")
    )


def _identity(value_type: Column) -> list[Column]:
    part_of_key = F.when(value_type.isin("string", "numeric"), F.coalesce(F.col("value"), F.lit("")))
    return [F.col("entity_type"), F.col("entity_id"), F.col("key"), value_type, F.coalesce(part_of_key, F.lit(""))]


def write(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store after a write.

    One aggregation over both sides: kept rows rank before new ones, except for
    json, where the new value wins.
    """
    both = store.select(*COLUMNS, F.lit(0).alias("__new")).unionByName(new.select(*COLUMNS, F.lit(1).alias("__new")))
    rank = F.when(F.col("value_type") == "json", -F.col("__new")).otherwise(F.col("__new"))
    names = ["__i0", "__i1", "__i2", "__i3", "__i4"]
    keyed = both.select(*[c.alias(n) for c, n in zip(_identity(F.col("value_type")), names)], rank.alias("__rank"), F.struct(*COLUMNS).alias("__row"))
    return keyed.groupBy(*names).agg(F.min(F.struct("__rank", "__row")).alias("r")).select("r.__row.*")


def created(store: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` that a write adds (all json rows count)."""
    names = ["__i0", "__i1", "__i2", "__i3", "__i4"]
    keyed = lambda df, *more: df.select(*[c.alias(n) for c, n in zip(_identity(F.col("value_type")), names)], *more)
    # of equal rows within the write the smallest counts
    distinct = keyed(new, F.struct(*COLUMNS).alias("__row")).groupBy(*names).agg(F.min("__row").alias("r"))
    added = distinct.join(keyed(store.where("value_type <> 'json'")).distinct(), names, "left_anti")
    return added.select("r.*")


def extend(store: DataFrame, added: DataFrame) -> DataFrame:
    """The store with rows from ``created``: only json rows are replaced.

    No shuffle of the store; its json rows meet the added ones in an anti-join.
    """
    key = ["entity_type", "entity_id", "key", "value_type"]
    json = store.where("value_type = 'json'").join(added.where("value_type = 'json'").select(*key), key, "left_anti")
    return store.where("value_type <> 'json'").select(*COLUMNS).unionByName(json.select(*COLUMNS)).unionByName(added.select(*COLUMNS))


def created_counts(store: DataFrame, new: DataFrame) -> DataFrame:
    return created(store, new).groupBy("value_type").agg(F.count(F.lit(1)).alias("n_created"))


def of(store: DataFrame, entity_type: str, entity_id: str | None = None, key: str | None = None, value_type: str | None = None) -> DataFrame:
    """A slice of the store; the filters prune its partitions."""
    rows = store.where(F.col("entity_type") == entity_type)
    for name, wanted in (("entity_id", entity_id), ("key", key), ("value_type", value_type)):
        if wanted is not None:
            rows = rows.where(F.col(name) == wanted)
    return rows


def has_flag(store: DataFrame, entity_type: str, entity_id: str, key: str) -> bool:
    return not of(store, entity_type, entity_id, key, "flag").isEmpty()


def get_strings(store: DataFrame, entity_type: str, entity_id: str, key: str) -> list[str]:
    return sorted(r[0] for r in of(store, entity_type, entity_id, key, "string").select("value").collect())


def get_string(store: DataFrame, entity_type: str, entity_id: str, key: str) -> str | None:
    return next(iter(get_strings(store, entity_type, entity_id, key)), None)


def get_numbers(store: DataFrame, entity_type: str, entity_id: str, key: str) -> list[float]:
    return sorted(float(r[0]) for r in of(store, entity_type, entity_id, key, "numeric").select("value").collect())


def get_json(store: DataFrame, entity_type: str, entity_id: str, key: str) -> str | None:
    row = of(store, entity_type, entity_id, key, "json").select("value").first()
    return row[0] if row else None


def all_keys(store: DataFrame, entity_type: str) -> DataFrame:
    """entity_id, key and its values; flags have the value true."""
    value = F.when(F.col("value_type") == "flag", "true").otherwise(F.col("value"))
    return of(store, entity_type).groupBy("entity_id", "key").agg(F.sort_array(F.collect_set(value)).alias("values"))


def entities_with_flag(store: DataFrame, entity_type: str, key: str) -> DataFrame:
    return of(store, entity_type, key=key, value_type="flag").select("entity_id").distinct()


def entities_with_string(store: DataFrame, entity_type: str, key: str, value: str | None = None) -> DataFrame:
    rows = of(store, entity_type, key=key, value_type="string")
    return (rows if value is None else rows.where(F.col("value") == value)).select("entity_id").distinct()


def required(rows: DataFrame, store: DataFrame, entity_type: str, id_column: str, flags: tuple = (), strings: tuple = ()) -> DataFrame:
    """Rows whose entity has all the flags and (key, value) strings."""
    for found in [entities_with_flag(store, entity_type, f) for f in flags] + [entities_with_string(store, entity_type, *([s] if isinstance(s, str) else s)) for s in strings]:
        rows = rows.join(found.withColumnRenamed("entity_id", id_column), id_column, "left_semi")
    return rows


def skipped(rows: DataFrame, store: DataFrame, entity_type: str, id_column: str, flags: tuple = (), strings: tuple = ()) -> DataFrame:
    """Rows whose entity has none of the flags and strings (key or (key, value))."""
    for found in [entities_with_flag(store, entity_type, f) for f in flags] + [entities_with_string(store, entity_type, *([s] if isinstance(s, str) else s)) for s in strings]:
        rows = rows.join(found.withColumnRenamed("entity_id", id_column), id_column, "left_anti")
    return rows


def query(store: DataFrame, entity_type: str, key: str | None = None, value: str | None = None, value_type: str | None = None, output: str | None = None) -> DataFrame:
    """Annotations by any of their fields, optionally written as JSON lines."""
    rows = of(store, entity_type, key=key, value_type=value_type)
    if value is not None:
        rows = rows.where(F.col("value") == value)
    if output:
        rows.write.mode("overwrite").json(output)
    return rows


def since_cursor(rows: DataFrame, cursors: DataFrame, name: str, version: str, entity_type: str, time: str = "created_at") -> DataFrame:
    """Rows newer than an annotator's high-water mark; all without one."""
    mark = cursors.where((F.col("annotator_name") == name) & (F.col("annotator_version") == version) & (F.col("entity_type") == entity_type)).agg(F.max("high_water_mark").alias("__mark"))
    return rows.join(F.broadcast(mark)).where(F.col("__mark").isNull() | (F.col(time) > F.col("__mark"))).drop("__mark")


def advance_cursor(cursors: DataFrame, done: DataFrame, name: str, version: str, entity_type: str, time: str = "created_at") -> DataFrame:
    """The cursor table with the annotator's mark at the newest row done."""
    key = ["annotator_name", "annotator_version", "entity_type"]
    row = done.agg(F.max(time).alias("high_water_mark")).select(F.lit(name).alias("annotator_name"), F.lit(version).alias("annotator_version"), F.lit(entity_type).alias("entity_type"), "high_water_mark")
    return cursors.select(*key, "high_water_mark").unionByName(row).groupBy(*key).agg(F.max("high_water_mark").alias("high_water_mark"))
