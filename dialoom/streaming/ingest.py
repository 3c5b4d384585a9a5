"""Continuous import: new export files are taken in as they appear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import archive as store


def watch_exports(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of conversations (source_json) from files put into a folder."""
    files = spark.readStream.format("text").option("wholetext", "true").load(folder)
    return files.select(F.explode(F.from_json("value", "array<string>")).alias("source_json"))


def import_new(archive: store.Archive, folder: str, platform: str, incremental: bool = True):
    """Import all files not taken in yet, then stop; returns the query.

    The stream's checkpoint, beside the tables, remembers the files; the
    archive's keys make a repeated batch harmless.
    """

    def take(batch: DataFrame, _: int) -> None:
        store.import_into(archive, batch, platform, incremental=incremental)

    return (
        watch_exports(archive.spark, folder)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{archive.root}/stream-{platform}")
        .trigger(availableNow=True)
        .start()
    )
