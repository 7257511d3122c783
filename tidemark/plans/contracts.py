"""What the tables promise: columns and types, keys, columns that are never null, age, and what must not be in them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans import domain

PERSONAL = ("card_token", "kafka_key", "payload")


@dataclass(frozen=True)
class Contract:
    """The table's columns are those of domain.TABLES; all but `optional` ones are required. `age` is in minutes, by the newest `stamp`."""

    name: str
    key: tuple[str, ...]
    optional: tuple[str, ...] = ()
    age: int = 0
    stamp: str = "ingested_at"
    private: tuple[str, ...] = ()

    def columns(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(domain.TABLES[self.name][0])}

    def violations(self, df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
        """(rule, offending_rows) of what rows can break: nulls in required columns, repeated keys, and with `now` a newest row that is too
        old (or none). Columns that are missing, of another type, or private raise an error."""
        there = dict(df.dtypes)
        if wrong := {c: there.get(c) for c, t in self.columns().items() if there.get(c) != t}:
            raise ValueError(f"{self.name}: {wrong} instead of {({c: self.columns()[c] for c in wrong})}")
        if seen := set(self.private) & set(there):
            raise ValueError(f"{self.name} holds {sorted(seen)}")
        tests = {f"{c} is null": F.count_if(F.col(c).isNull()) for c in self.columns() if c not in self.optional}
        if now is not None and self.age:
            late = F.coalesce(F.max(self.stamp) < F.lit(now - dt.timedelta(minutes=self.age)), F.lit(True))
            tests["newest row is too old"] = late.cast("long")
        one = df.agg(*[n.alias(f"n{i}") for i, n in enumerate(tests.values())])
        found = one.select(F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"n{i}").alias("offending_rows")) for i, rule in enumerate(tests)])).alias("v")).select("v.*")
        twice = df.groupBy(*self.key).count().agg(F.count_if(F.col("count") > 1).alias("offending_rows"))
        return found.unionByName(twice.select(F.lit("key is repeated").alias("rule"), "offending_rows")).where("offending_rows > 0")


# Keys, optional columns and ages of the products.
_RECORD, _LISTS = tuple(domain.RECORD_KEY), ("aliases", "countries", "program_ids", "sanctions", "first_seen", "last_seen", "last_change", "delisted_at")
CONTRACTS = {
    c.name: c
    for c in (
        Contract("trades_bronze", _RECORD, ("kafka_key", "payload"), 15),
        Contract("trades_rejects", _RECORD, ("kafka_key", "payload")),
        Contract("trades", tuple(domain.TRADE_KEY), ("sequence",), 15),
        Contract("trades_v2", tuple(domain.TRADE_KEY), ("sequence",)),
        Contract("card_auths_bronze", _RECORD, ("kafka_key", "payload"), 15),
        Contract("card_auths_rejects", _RECORD, ("kafka_key", "payload")),
        Contract("card_auths", tuple(domain.CARD_KEY), ("merchant_name", "mcc"), 15),
        Contract("fx_rates", tuple(domain.RATE_KEY), (), 4 * 24 * 60),
        Contract("sanctions_targets", tuple(domain.TARGET_KEY), _LISTS, 30 * 60),
        Contract("sanctions_names", ("target_id", "name_norm"), ("countries", "program_ids"), 30 * 60, "list_date"),
        Contract("crypto_ohlcv_1m", ("product_id", "minute"), (), 70, "built_at", PERSONAL),
        Contract("card_auth_daily", ("auth_date", "merchant_country", "currency", "channel"), (), 70, "built_at", PERSONAL),
        Contract("sanctions_hits", ("merchant_id", "target_id"), ("program_ids",), 70, "screened_at", PERSONAL),
    )
}
