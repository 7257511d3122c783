"""Keyed merges as DataFrames: what the table holds afterwards, or the rows to append."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of the batch whose key the target lacks, one a key (the first in `order`, else in all columns): appending them twice
    adds nothing."""
    rank = Window.partitionBy(*keys).orderBy(*(order or [c for c in batch.columns if c not in keys] or keys))
    once = batch.withColumn("_n", F.row_number().over(rank)).where("_n = 1").drop("_n")
    return once.join(target.select(*keys), keys, "left_anti").select(batch.columns)


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    return target.unionByName(new_rows(target, batch, keys, order))


def _both(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    t = target.select(*keys, F.struct(*target.columns).alias("t"))
    s = source.select(*keys, F.struct(*source.columns).alias("s"))
    return t.join(s, keys, "full_outer")


def upsert_changed(target: DataFrame, source: DataFrame, keys: list[str], compare: str) -> DataFrame:
    """New keys are inserted; a held row is replaced only if `compare` differs (null is no difference)."""
    changed = F.col("t").isNull() | F.coalesce(F.col(f"t.{compare}") != F.col(f"s.{compare}"), F.lit(False))
    rows = _both(target, source, keys).withColumn("r", F.when(F.col("s").isNotNull() & changed, F.col("s")).otherwise(F.col("t")))
    return rows.select("r.*").select(target.columns)


def sync_snapshot(target: DataFrame, snapshot: DataFrame, keys: list[str], compare: str, now, gone: str = "delisted_at") -> DataFrame:
    """The target as the snapshot says: changed or returned rows are taken over and relisted, new ones inserted, and a listed row that
    the snapshot lacks gets `gone` = now. Rows delisted before keep their time."""
    rows = _both(target, snapshot.withColumn(gone, F.lit(None).cast(target.schema[gone].dataType)).select(target.columns), keys)
    held, there = F.col("t").isNotNull(), F.col("s").isNotNull()
    taken = there & (~held | ~F.col(f"t.{compare}").eqNullSafe(F.col(f"s.{compare}")) | F.col(f"t.{gone}").isNotNull())
    ended = F.col("t").withField(gone, F.coalesce(F.col(f"t.{gone}"), now))
    return rows.withColumn("r", F.when(taken, F.col("s")).when(there, F.col("t")).otherwise(ended)).select("r.*").select(target.columns)


def repair(bronze: DataFrame, keys: list[str], order: str, day: str) -> tuple[DataFrame, DataFrame]:
    """(days with a repeated key, the rows those days should hold: the earliest by `order` of each key)."""
    days = bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.collect_set(day).alias("days")).where("n > 1").select(F.explode("days").alias(day)).distinct()
    rank = Window.partitionBy(*keys).orderBy(order, *[c for c in bronze.columns if c not in (*keys, order)])
    kept = bronze.join(days, day, "left_semi").withColumn("_n", F.row_number().over(rank)).where("_n = 1").drop("_n")
    return days, kept.select(bronze.columns)
