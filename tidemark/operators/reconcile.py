"""Comparison of a table with its rebuilt version over the log span that the rebuild covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITION, OFFSET = "kafka_partition", "kafka_offset"


def span(live: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(partition, lo, hi) that both sides cover: a row a partition."""
    ends = lambda df, a, b: df.groupBy(PARTITION).agg(F.min(OFFSET).alias(a), F.max(OFFSET).alias(b))
    return ends(rebuilt, "r_lo", "r_hi").join(ends(live, "l_lo", "l_hi"), PARTITION).select(
        PARTITION, F.greatest("r_lo", "l_lo").alias("lo"), F.least("r_hi", "l_hi").alias("hi")
    )


def compare(live: DataFrame, rebuilt: DataFrame, keys: list[str], values: list[str], added: str | None = None) -> DataFrame:
    """One row: in_both, only_live, only_replayed, changed, and with `added`, a column that only the rebuilt table has, its nulls
    there as no_<added>. Differences of offset don't count."""
    within = span(live, rebuilt)

    def side(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        inside = df.join(F.broadcast(within), PARTITION).where(F.col(OFFSET).between(F.col("lo"), F.col("hi")))
        return inside.select(*keys, F.struct(*values).alias(name), *columns)

    more = [added] if added else []
    both = side(live, "l", []).join(side(rebuilt, "r", more), keys, "full_outer")
    here, there = F.col("l").isNotNull(), F.col("r").isNotNull()
    return both.agg(
        F.count_if(here & there).alias("in_both"), F.count_if(here & ~there).alias("only_live"), F.count_if(~here & there).alias("only_replayed"),
        F.count_if(here & there & ~F.col("l").eqNullSafe(F.col("r"))).alias("changed"), *[F.count_if(there & F.col(c).isNull()).alias(f"no_{c}") for c in more],
    )


def differs(row) -> bool:
    """Whether a comparison forbids a swap: any difference does, and so does having nothing in common."""
    found = row.asDict()
    return found.pop("in_both") == 0 or any(found.values())
