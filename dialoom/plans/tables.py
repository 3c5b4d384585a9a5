"""Reading the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import share_package


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")
