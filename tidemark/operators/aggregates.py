"""Candles, daily and merchant roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXACT, MONEY = "decimal(30,12)", "decimal(18,2)"


def candles(trades: DataFrame, bucket: str = "MINUTE", since=None) -> DataFrame:
    """OHLCV by product and bucket from rows (product_id, trade_id, price, size, trade_time). Open and close follow
    (trade_time, trade_id); VWAP is the weighted mean, held inside [low, high]."""
    rows = trades if since is None else trades.where(F.col("trade_time") >= since)
    value = F.col("price").cast("decimal(20,12)") * F.col("size").cast("decimal(20,12)")
    when = F.struct("trade_time", "trade_id")
    legs = [F.min(c).alias(c) for c in ("base_currency", "quote_currency") if c in trades.columns]
    found = rows.groupBy("product_id", F.date_trunc(bucket, "trade_time").alias("bucket")).agg(
        *legs, F.min_by("price", when).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", when).alias("close"),
        F.sum("size").alias("volume"), F.sum(value).alias("_value"), F.count(F.lit(1)).alias("trades"),
    )
    mean = F.col("_value").cast("double") / F.col("volume").cast("double")
    inside = F.least(F.greatest(mean, F.col("low").cast("double")), F.col("high").cast("double"))
    return found.withColumn("notional", F.col("_value").cast(EXACT)).withColumn("vwap", inside.cast(EXACT)).drop("_value")


def daily(cards: DataFrame, keys: list[str], since=None) -> DataFrame:
    """Authorisations by day and `keys` from rows (auth_time, approved, amount_eur, keys)."""
    rows = cards if since is None else cards.where(F.col("auth_time") >= since)
    n, ok = F.count(F.lit(1)), F.count_if("approved")
    return rows.groupBy(F.to_date("auth_time").alias("auth_date"), *keys).agg(
        n.alias("auths"), ok.alias("approved"), F.round(ok / n, 4).alias("approval_rate"), F.sum("amount_eur").cast(MONEY).alias("amount_eur"),
        F.coalesce(F.sum(F.when(F.col("approved"), F.col("amount_eur"))), F.lit(0)).cast(MONEY).alias("approved_amount_eur"),
        F.avg("amount_eur").cast(MONEY).alias("avg_amount_eur"),
    )


def merchants(cards: DataFrame) -> DataFrame:
    """A row for each merchant; name and country are those of the latest authorisation."""
    last = F.struct("auth_time", "merchant_name", "merchant_country")
    return cards.groupBy("merchant_id").agg(
        F.max(last)["merchant_name"].alias("merchant_name"), F.max(last)["merchant_country"].alias("merchant_country"), F.count(F.lit(1)).alias("auths"),
        F.sum("amount_eur").cast(MONEY).alias("amount_eur"), F.min("auth_time").alias("first_auth"), F.max("auth_time").alias("last_auth"),
    )
