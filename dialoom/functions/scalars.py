"""Scalar helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the source language strips it: Unicode blanks and U+001C-1F.
BLANK = r"[\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(col, rf"(?U)\A{BLANK}+|{BLANK}+\z", "")


def given(col: Column) -> Column:
    """NULL for empty text, as in ``a or b``."""
    return F.nullif(col, F.lit(""))


def parse_time(value: Column) -> Column:
    """Timestamp of a variant: epoch seconds or ISO text; else NULL.

    Text without an offset is UTC (the session's zone); numbers out of range
    and malformed text give NULL.
    """
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    seconds = F.try_variant_get(value, "$", "double")
    in_range = seconds.between(-62135596800.0, 253402300799.0)
    return F.when(kind == "STRING", F.try_to_timestamp(text)).when((kind != "BOOLEAN") & in_range, F.timestamp_seconds(seconds))


def parse_time_text(text: Column) -> Column:
    """``parse_time`` for a column that is ISO text already."""
    return F.try_to_timestamp(text)


def normalize_role(role: Column) -> Column:
    """Lower case; human is user; NULL and empty are unknown."""
    low = F.lower(role)
    return F.when(F.coalesce(role, F.lit("")) == "", "unknown").when(low == "human", "user").otherwise(low)


def content_hash(value: Column) -> Column:
    """Digest of a variant that doesn't depend on key order."""
    return F.sha2(F.to_json(value), 256)


def row_key(*parts: Column | str) -> Column:
    """Deterministic key of a row from its natural key."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]), 256)


def text_at(value: Column, path: str) -> Column:
    """Text at a path of a variant, NULL where there is none."""
    return F.try_variant_get(value, path, "string")


def truthy(value: Column, path: str) -> Column:
    """Whether a path holds something other than NULL, false, 0, '' and empties."""
    node = F.try_variant_get(value, path, "variant")
    return F.coalesce(~F.to_json(node).isin("null", "false", "0", '""', "[]", "{}"), F.lit(False))


def word_count(text: Column) -> Column:
    """Pieces between runs of white space: NULL 0, empty 1."""
    return F.coalesce(F.size(F.split(text, r"\s+")), F.lit(0))


def occurrences(text: Column, what: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / len(what)).cast("int")
