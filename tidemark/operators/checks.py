"""Quality checks: each counts offending rows, none is a pass."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counted(name: str, df: DataFrame, n: Column) -> DataFrame:
    return df.agg(F.coalesce(n, F.lit(0)).cast("long").alias("n")).select(F.lit(name).alias("check"), F.col("n").alias("offending_rows"))


def holds(name: str, df: DataFrame, *tests: Column) -> DataFrame:
    """Rows that break one of the tests. An unknown (null) one is not broken."""
    return _counted(name, df, F.count_if(F.coalesce(~reduce(and_, tests), F.lit(False))))


def repeated(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return _counted(name, df.groupBy(*keys).count(), F.count_if(F.col("count") > 1))


def same_total(name: str, summed: DataFrame, column: str, rows: DataFrame) -> DataFrame:
    """|sum of a column - number of rows|: both are one row, joined by that."""
    a, b = summed.agg(F.coalesce(F.sum(column), F.lit(0)).alias("a"), F.lit(1).alias("k")), rows.agg(F.count(F.lit(1)).alias("b"), F.lit(1).alias("k"))
    return a.join(b, "k").select(F.lit(name).alias("check"), F.abs(F.col("a") - F.col("b")).cast("long").alias("offending_rows"))


def unlisted(name: str, hits: DataFrame, targets: DataFrame) -> DataFrame:
    """Hits whose target isn't listed any more, or never was."""
    return _counted(name, hits.join(targets.where("delisted_at IS NULL").select("target_id"), "target_id", "left_anti"), F.count(F.lit(1)))


def filled(name: str, df: DataFrame, column: str) -> DataFrame:
    """Rows in which a text is null or blank."""
    return _counted(name, df, F.count_if(F.trim(F.coalesce(F.col(column), F.lit(""))) == ""))


def candle_tests() -> list[Column]:
    """What any candle fulfils: prices inside [low, high], and something traded."""
    return [F.col(c).between(F.col("low"), F.col("high")) for c in ("open", "close", "vwap")] + [F.col(c) > 0 for c in ("volume", "trades")]


def share_tests() -> list[Column]:
    return [F.col("approval_rate").between(0, 1), F.col("auths") >= F.col("approved")]


def run(checks: list[DataFrame]) -> DataFrame:
    """(check, offending_rows, passed)."""
    return reduce(DataFrame.unionByName, checks).withColumn("passed", F.col("offending_rows") == 0)


def enforce(result: DataFrame) -> None:
    if failed := [r["check"] for r in result.where("NOT passed").collect()]:
        raise RuntimeError(f"checks failed: {', '.join(failed)}")
