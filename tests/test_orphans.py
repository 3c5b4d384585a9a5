from datetime import datetime

import pytest

from dialoom.operators import orphans

REFS = [(1, "a", "x"), (2, "a", None), (3, None, "x"), (4, None, None), (5, "b", "x"), (6, "a", "y"), (6, "a", "y"), (7, "b", None), (8, None, "q")]
TARGETS = [("a", "x", 1), ("a", "x", 2), ("c", "z", 3), (None, "n", 4)]


def missing(spark, match, refs=REFS, targets=TARGETS):
    r = spark.createDataFrame(refs, "n int, k1 string, k2 string")
    t = spark.createDataFrame(targets, "k1 string, k2 string, n int")
    return sorted((x["n"], x["null_mask"]) for x in orphans.find_missing(r, t, ["k1", "k2"], ["k1", "k2"], match).collect())


def test_match_semantics(spark):
    whole = [(5, "11"), (6, "11"), (6, "11")]
    assert missing(spark, "simple") == whole
    assert missing(spark, "partial") == sorted(whole + [(7, "10"), (8, "01")])
    assert missing(spark, "full") == sorted(whole + [(2, "10"), (3, "01"), (7, "10"), (8, "01")])
    with pytest.raises(ValueError):
        missing(spark, "other")


def test_empty(spark):
    assert missing(spark, "simple", refs=[]) == []
    assert len(missing(spark, "simple", targets=[])) == 4


def test_kinds(spark):
    t = lambda day: datetime(2024, 1, day)
    refs = spark.createDataFrame([("1", "a", t(5)), ("2", "b", t(5)), ("3", "c", t(5)), ("4", "d", t(5)), ("5", None, t(5)), ("6", "c", None), ("7", "e", t(5)), ("8", "f", t(5))], "id string, ref string, at timestamp")
    targets = spark.createDataFrame([("a", t(1), False), ("b", t(1), True), ("c", t(9), False), ("e", t(9), False), ("e", t(2), False), ("f", t(9), False), ("f", t(1), True), (None, t(1), False)], "target string, made timestamp, gone boolean")
    got = {r["id"]: r["orphan_kind"] for r in orphans.classify_orphans(refs, targets, "ref", "target", "at", "made", "gone").collect()}
    assert got == {"2": "deleted", "3": "late", "4": "missing", "8": "late"}
