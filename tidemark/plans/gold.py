"""The gold products, built from the silver tables, and the checks that each build has to pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import aggregates, checks
from tidemark.plans import domain
from tidemark.sources.tables import Table

BEGINNING = dt.date(1970, 1, 1)


def rebuilt_since(table: Table, today: dt.date, days: int = domain.REBUILD_DAYS) -> dt.date:
    """The first of the days that a build makes anew: the last `days`, which late records may still change, or all of an empty table."""
    return today - dt.timedelta(days - 1) if any(p["rows"] for p in table.pieces()) else BEGINNING


def candles(tables: Mapping[str, Table], today: dt.date) -> dt.date:
    since = rebuilt_since(tables["crypto_ohlcv_1m"], today)
    made = aggregates.candles(tables["trades"].scan(since), since=F.lit(since).cast("timestamp")).withColumnRenamed("bucket", "minute")
    tables["crypto_ohlcv_1m"].replace_partitions(made.withColumn("built_at", F.current_timestamp()))
    return since


def daily(tables: Mapping[str, Table], today: dt.date) -> dt.date:
    since = rebuilt_since(tables["card_auth_daily"], today)
    made = aggregates.daily(tables["card_auths"].scan(since), ["merchant_country", "currency", "channel"], F.lit(since).cast("timestamp"))
    tables["card_auth_daily"].replace_partitions(made.withColumn("built_at", F.current_timestamp()))
    return since


def hits(tables: Mapping[str, Table]) -> None:
    """Every merchant against today's list; all rows are replaced, by none if there are no hits."""
    found = names.screen(aggregates.merchants(tables["card_auths"].read()), tables["sanctions_names"].read())
    tables["sanctions_hits"].overwrite(found.withColumn("screened_at", F.current_timestamp()))


def checked(tables: Mapping[str, Table], since: dt.date) -> DataFrame:
    """(check, offending_rows, passed); daily counts are compared over the days from `since` on, the others over whole tables."""
    made, cards = tables["card_auth_daily"].scan(since).where(F.col("auth_date") >= F.lit(since)), tables["card_auths"].scan(since).where(F.col("auth_time") >= F.lit(since).cast("timestamp"))
    candle, rejects = tables["crypto_ohlcv_1m"].read(), [checks.filled(f"{t}_carry_a_reason", tables[t].read(), "reason") for t in ("trades_rejects", "card_auths_rejects") if t in tables]
    return checks.run([
        checks.holds("candles_are_consistent", candle, *checks.candle_tests()), checks.repeated("one_candle_per_product_minute", candle, ["product_id", "minute"]),
        checks.holds("approval_rate_is_a_share", tables["card_auth_daily"].read(), *checks.share_tests()), checks.same_total("daily_counts_match_silver", made, "auths", cards),
        checks.unlisted("hits_are_on_todays_list", tables["sanctions_hits"].read(), tables["sanctions_targets"].read()), *rejects,
    ])


def build(tables: Mapping[str, Table], today: dt.date) -> DataFrame:
    """All three products; returns what the checks found. Running it again makes the same rows."""
    candles(tables, today)
    since = daily(tables, today)
    hits(tables)
    return checked(tables, since)
