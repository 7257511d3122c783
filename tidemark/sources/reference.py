"""Reference data: currency fixings from JSON, listed targets from CSV, and trade-feed messages. What fetches text is a parameter: a
web service, a file, or a test's text."""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The public services.
RATES_URL = "https://api.frankfurter.dev/v1"
TARGETS_URL = "https://data.opensanctions.org/datasets/latest/gb_fcdo_sanctions/targets.simple.csv"


def get(url: str, timeout: float = 60) -> str:
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        return answer.read().decode()


def fetch_rates(start: dt.date, end: dt.date, base: str = "EUR", get: Callable[[str], str] = get) -> str:
    """One ranged call: the JSON of a base's fixings from `start` to `end`."""
    return get(f"{RATES_URL}/{start}..{end}?base={base}")


def load_rates(table, fetch: Callable[[dt.date, dt.date], str], today: dt.date, first: dt.date, revisit: int = 7, source: str = "ECB") -> DataFrame:
    """Fixings from `revisit` days before the newest held one on (from `first` on if there is none) are fetched and merged: new ones are inserted,
    held ones replaced only if their rate differs. Returns what was fetched."""
    from tidemark.operators import merge

    spark = table.spark
    newest = table.read().agg(F.max("rate_date")).first()[0]
    text = fetch(newest - dt.timedelta(revisit) if newest else first, today)
    rows = fixings(spark.createDataFrame([(text,)], "value string")).withColumn("source", F.lit(source)).withColumn("ingested_at", F.current_timestamp())
    table.overwrite(merge.upsert_changed(table.read(), rows, ["rate_date", "base", "quote"], "rate"))
    return rows


def load_targets(targets, names, listed: DataFrame, now, floor: int = 1000, source: str = "FCDO") -> None:
    """The list as it is today: targets are synchronised (what left it is marked), and the screening names replaced."""
    from tidemark.functions.names import screening_names
    from tidemark.operators import merge

    today = sane(listed, floor).withColumn("source", F.lit(source)).withColumn("ingested_at", now)
    targets.overwrite(merge.sync_snapshot(targets.read(), today, ["target_id"], "last_change", now))
    names.overwrite(screening_names(targets.read().where("delisted_at IS NULL")).withColumn("list_date", F.to_date(now)))

TARGET_COLUMNS = ["target_id", "schema", "name", "aliases", "countries", "program_ids", "sanctions", "first_seen", "last_seen", "last_change"]
FIELDS = ("trade_id", "product_id", "price", "size", "side", "time", "sequence")


def fixings(payloads: DataFrame, source: str = "ecb") -> DataFrame:
    """(rate_date, base, quote, rate) from rows with a JSON `value` {base, rates: {day: {quote: rate}}}; the base is no quote."""
    p = F.from_json("value", "base string, rates map<string, map<string, double>>")
    days = payloads.select(p["base"].alias("base"), F.explode(p["rates"]).alias("day", "quotes"))
    rows = days.select(F.to_date("day").alias("rate_date"), "base", F.explode("quotes").alias("quote", "rate"))
    return rows.where(F.col("quote") != F.col("base"))


def listed_targets(spark: SparkSession, path: str) -> DataFrame:
    """The ten kept columns of a targets CSV: quoted fields with line breaks and of any length, empty lists and times as null."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1)
    times = {c: F.to_timestamp(c) for c in ("first_seen", "last_seen", "last_change")}
    return raw.withColumnRenamed("id", "target_id").select(TARGET_COLUMNS).withColumns(times)


def sane(targets: DataFrame, floor: int = 1000) -> DataFrame:
    """`targets`, or an error if there are suspiciously few."""
    if (n := targets.limit(floor).count()) < floor:
        raise ValueError(f"{n} targets: fewer than {floor}, the list is left as it is")
    return targets


def feed_records(messages: DataFrame) -> DataFrame:
    """(key, value) records of a trade feed's JSON messages in `value`: only matches, only the kept fields. An error
    message fails the batch."""
    m = F.from_json("value", "type string, message string, reason string, " + ", ".join(f"{f} {'bigint' if f in ('trade_id', 'sequence') else 'string'}" for f in FIELDS))
    typed = messages.select(m.alias("m"))
    wrong = F.raise_error(F.concat_ws(": ", F.lit("feed error"), "m.message", "m.reason"))
    checked = typed.withColumn("kind", F.when(F.col("m.type") == "error", wrong.cast("string")).otherwise(F.col("m.type")))
    return checked.where("kind IN ('match', 'last_match')").select(F.col("m.product_id").alias("key"), F.to_json(F.struct(*(f"m.{f}" for f in FIELDS))).alias("value"))


class FeedError(Exception):
    """The feed refuses: trying again won't help."""


def waits(most: float = 60.0) -> Iterator[float]:
    """1, 2, 4 and so on up to `most` seconds, then `most` for ever."""
    wait = 1.0
    while True:
        yield wait
        wait = min(2 * wait, most)


def feed(connect: Callable[[], Iterable[str]], publish: Callable[[str, str], None], clock=time.monotonic, sleep=time.sleep, most: float = 60.0) -> None:
    """Publish a feed's matches as (key, value) until it ends. A lost connection (OSError) is opened again after a wait that doubles, and that starts
    anew after a connection that lived longer than `most`; an error message of the feed ends it."""
    pause = waits(most)
    while True:
        began = clock()
        try:
            for text in connect():
                message = json.loads(text)
                if message.get("type") == "error":
                    raise FeedError(f"{message.get('message')}: {message.get('reason')}")
                if message.get("type") in ("match", "last_match"):
                    publish(message["product_id"], json.dumps({f: message.get(f) for f in FIELDS}))
            return
        except OSError:
            if clock() - began > most:
                pause = waits(most)
            sleep(next(pause))


class Landing:
    """A producer that lands records as Parquet files for streaming.file_log, in a folder it can write to. Records beyond `most` that wait are
    dropped and counted, as a producer with a full buffer does."""

    def __init__(self, folder: str, topic: str, partitions: int = 1, most: int = 100_000, clock=time.time):
        self.folder, self.topic, self.partitions, self.most, self.clock = folder, topic, partitions, most, clock
        self.rows, self.next, self.files, self.delivered, self.dropped = [], [0] * partitions, 0, 0, 0

    def publish(self, key: str, value: str) -> None:
        if len(self.rows) >= self.most:
            self.dropped += 1
            return
        p = sum(key.encode()) % self.partitions
        self.rows.append((key.encode(), value.encode(), self.topic, p, self.next[p], dt.datetime.fromtimestamp(self.clock(), dt.UTC)))
        self.next[p] += 1

    def flush(self) -> None:
        if self.rows:
            kinds = [pa.binary(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.timestamp("us", "UTC")]
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), kinds)]
            pq.write_table(pa.table(columns, ["key", "value", "topic", "partition", "offset", "timestamp"]), f"{self.folder}/records-{self.files:08d}.parquet")
            self.files, self.delivered, self.rows = self.files + 1, self.delivered + len(self.rows), []


def synthetic_cards(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """Card authorisations as (key, value): choices follow hashes of the row number, so any run gives the same. About
    1 % are malformed: without amount, with a negative one, an unknown currency, or not JSON."""
    def pick(name: str, *weighted: tuple[str, int]):
        draw, total, out = F.pmod(F.xxhash64("id", F.lit(f"{seed}{name}")), F.lit(sum(w for _, w in weighted))), 0, None
        for value, w in weighted:
            total += w
            out = F.when(draw < total, value) if out is None else out.when(draw < total, value)
        return out

    code = pick("code", ("00", 92), ("51", 3), ("05", 3), ("14", 1), ("91", 1))
    bad, kind = F.pmod(F.xxhash64("id", F.lit(f"{seed}bad")), F.lit(100)) == 0, F.pmod(F.xxhash64("id", F.lit(f"{seed}kind")), F.lit(4))
    cents = F.pmod(F.xxhash64("id", F.lit(f"{seed}amount")), F.lit(20000)) + 100
    merchant = F.pmod(F.xxhash64("id", F.lit(f"{seed}m")), F.lit(17))
    amount = F.when(bad & (kind == 0), None).when(bad & (kind == 1), -cents / 100).otherwise(cents / 100)
    body = F.to_json(F.struct(
        F.concat(F.lit("a-"), "id").alias("auth_id"), F.format_string("tok_%06d", F.pmod(F.xxhash64("id", F.lit(f"{seed}card")), F.lit(5000))).alias("card_token"),
        F.format_string("m-%04d", merchant).alias("merchant_id"), F.format_string("Merchant %02d", merchant).alias("merchant_name"), F.lit("5411").alias("mcc"), F.lit("DE").alias("merchant_country"),
        amount.cast("decimal(18,2)").alias("amount"), F.when(bad & (kind == 2), "XXX").otherwise(pick("cur", ("EUR", 6), ("GBP", 2), ("USD", 1), ("SEK", 1))).alias("currency"),
        pick("channel", ("pos", 50), ("contactless", 30), ("ecom", 20)).alias("channel"), code.alias("response_code"),
        F.date_format(F.timestamp_seconds(F.lit(1_790_000_000) + F.col("id")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("auth_time"),
    ))
    rows = spark.range(n).select(F.when(bad & (kind == 3), '"broken"').otherwise(body).alias("value"))
    return rows.select(F.get_json_object("value", "$.card_token").alias("key"), "value")
