"""Every query over the driver's tables, with the same in DuckDB's SQL. The tables stand in for the streams: events are
trades (type = product, value = price), orders and customers are authorisations, line items are log records."""

from __future__ import annotations

import datetime as dt
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import decode, names, rules
from tidemark.functions.rules import Rule
from tidemark.operators import aggregates, asof, checks, merge, reconcile
from tidemark.plans import contracts, domain, gold
from tidemark.sources import reference
from tidemark.sources.tables import Table
from tidemark.streaming import runner

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def money(*columns: str) -> list:
    return [F.round(F.col(c).cast("double"), 6).alias(c) for c in columns]


def trades(spark, d) -> DataFrame:
    return read(spark, d, "events").select(
        F.col("event_type").alias("product_id"), F.col("event_id").alias("trade_id"), F.col("value").cast("decimal(30,12)").alias("price"),
        (F.col("event_id") % 10 + 1).cast("decimal(30,12)").alias("size"), F.col("ts").alias("trade_time"),
    )


def _candles(spark, d, bucket) -> DataFrame:
    c = aggregates.candles(trades(spark, d), bucket)
    return c.select("product_id", F.col("bucket").cast("timestamp_ntz").alias("bucket"), *money("open", "high", "low", "close", "volume", "notional", "vwap"), "trades")


def _candles_sql(bucket: str, name: str = "bucket", leg: str = "") -> str:
    return f"""
    WITH t AS (SELECT event_type AS product_id, event_id, value::DECIMAL(18,6) AS price, event_id % 10 + 1 AS size, ts FROM events),
    g AS (SELECT product_id, date_trunc('{bucket}', ts) AS bucket, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
                 arg_max(price, (ts, event_id)) AS close, sum(size)::DOUBLE AS volume, sum(price * size)::DOUBLE AS notional, count(*) AS trades FROM t GROUP BY ALL)
    SELECT product_id, bucket AS {name}, {leg} round(open::DOUBLE, 6) AS open, round(high::DOUBLE, 6) AS high, round(low::DOUBLE, 6) AS low, round(close::DOUBLE, 6) AS close,
           round(volume, 6) AS volume, round(notional, 6) AS notional, round(least(greatest(notional / volume, low::DOUBLE), high::DOUBLE), 6) AS vwap, trades FROM g"""


@query(_candles_sql("hour"))
def candles_1h(spark, d):
    return _candles(spark, d, "HOUR")


@query(_candles_sql("minute"))
def candles_1m(spark, d):
    return _candles(spark, d, "MINUTE")


EVENT_RULES = [
    Rule("value is too small", "value IS NULL OR value <= 5"),
    Rule("k is too large", "k IS NULL OR k > 90"),
    Rule("type is unknown", "event_type NOT IN ('click', 'view', 'purchase', 'signup')"),
    Rule("user is blocked", "user_id % 7 = 3"),
]
REASON_SQL = """CASE WHEN value IS NULL OR value <= 5 THEN 'value is too small' WHEN k IS NULL OR k > 90 THEN 'k is too large'
  WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'type is unknown' WHEN user_id % 7 = 3 THEN 'user is blocked' END"""
JUDGED_SQL = f"WITH e AS (SELECT *, (props->>'$.k')::BIGINT AS k FROM events), j AS (SELECT *, {REASON_SQL} AS reject_reason FROM e) "


def _judged(spark, d) -> DataFrame:
    return rules.judged(read(spark, d, "events").withColumn("k", F.from_json("props", "k bigint")["k"]), EVENT_RULES)


@query(JUDGED_SQL + "SELECT event_id, reject_reason AS reason FROM j WHERE reject_reason IS NOT NULL")
def reject_reasons(spark, d):
    return rules.split(_judged(spark, d))[1].select("event_id", F.col("reject_reason").alias("reason"))


@query(JUDGED_SQL + "SELECT event_id, event_type, k, value FROM j WHERE reject_reason IS NULL")
def valid_events(spark, d):
    return rules.split(_judged(spark, d))[0].select("event_id", "event_type", "k", "value")


@query(JUDGED_SQL + "SELECT coalesce(reject_reason, 'valid') AS reason, count(*) AS n FROM j GROUP BY 1")
def rule_totals(spark, d):
    return _judged(spark, d).groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(JUDGED_SQL + """SELECT event_type AS key, '{"reason":"' || reject_reason || '","topic":"events","partition":' || (user_id % 4)::VARCHAR || ',"offset":' || event_id::VARCHAR || ',"payload":"' || replace(props, '"', chr(92) || '"') || '"}' AS value
  FROM j WHERE reject_reason IS NOT NULL""")
def dlq_json(spark, d):
    rejected = rules.split(_judged(spark, d))[1]
    rows = rejected.select(F.col("reject_reason").alias("reason"), F.col("event_type").alias("kafka_key"), (F.col("user_id") % 4).alias("kafka_partition"), F.col("event_id").alias("kafka_offset"), F.col("props").alias("payload"))
    return decode.dead_letters(rows, "events")


@query("""SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(value, (ts, event_id)) AS value
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 3 = 0) GROUP BY 1, 2""")
def dedup_first(spark, d):
    e = read(spark, d, "events")
    return rules.first_by(e.unionByName(e.where("event_id % 3 = 0")), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def dedup_latest(spark, d):
    e = read(spark, d, "events").withColumn("age", -F.unix_micros(F.col("ts").cast("timestamp")))
    return rules.first_by(e, ["user_id", "event_type"], ["age", "-event_id"]).select("user_id", "event_type", "event_id", "value")


def _rates_sql(of_day: str) -> str:
    return f"""WITH f AS (SELECT event_id, 'C' || (user_id % 6)::VARCHAR AS currency, ts::DATE AS day FROM events),
  r AS (SELECT 'C' || (user_id % 5)::VARCHAR AS quote, ts::DATE AS rate_date, round({of_day}(value), 4) AS rate FROM events WHERE dayofweek(ts) BETWEEN 1 AND 5 AND day(ts) % 9 < 3 GROUP BY 1, 2)
  SELECT event_id, currency, day, rate_date::VARCHAR AS rate_date, rate FROM (SELECT f.*, r.rate_date, r.rate, row_number() OVER (PARTITION BY event_id ORDER BY r.rate_date DESC NULLS LAST) AS n
    FROM f LEFT JOIN r ON currency = quote AND r.rate_date <= day AND r.rate_date > day - 7) WHERE n = 1"""


def _facts_and_rates(spark, d) -> tuple[DataFrame, DataFrame]:
    e = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    name = lambda n: F.concat(F.lit("C"), (F.col("user_id") % n).cast("string"))
    weekdays = e.where("dayofweek(ts) BETWEEN 2 AND 6 AND day(ts) % 9 < 3")
    rates = weekdays.groupBy(name(5).alias("quote"), F.col("day").alias("rate_date")).agg(F.round(F.avg("value"), 4).alias("rate"))
    return e.select("event_id", name(6).alias("currency"), "day"), rates


@query(_rates_sql("avg"))
def fx_asof_interval(spark, d):
    facts, rates = _facts_and_rates(spark, d)
    return asof.asof_interval(facts, rates, "currency", "day", "quote", "rate_date").select("event_id", "currency", "day", F.col("rate_date").cast("string").alias("rate_date"), "rate")


@query(_rates_sql("max"))
def fx_asof_repeated(spark, d):
    """Several fixings a day, of which the highest counts, and fixings of another base, which don't."""
    facts, _ = _facts_and_rates(spark, d)
    e = read(spark, d, "events").where("dayofweek(ts) BETWEEN 2 AND 6 AND day(ts) % 9 < 3")
    rates = e.select(F.concat(F.lit("C"), (F.col("user_id") % 5).cast("string")).alias("quote"), F.to_date("ts").alias("rate_date"), F.round("value", 4).alias("rate"))
    both = rates.withColumn("base", F.lit("EUR")).unionByName(rates.withColumn("base", F.lit("USD")).withColumn("rate", F.col("rate") + 1000))
    found = asof.asof_interval(facts, both.where("base = 'EUR'").drop("base"), "currency", "day", "quote", "rate_date")
    return found.select("event_id", "currency", "day", F.col("rate_date").cast("string").alias("rate_date"), "rate")


@query(_rates_sql("avg"))
def fx_asof_window(spark, d):
    facts, rates = _facts_and_rates(spark, d)
    return asof.asof_window(facts, rates, "currency", "day", "quote", "rate_date", ["event_id"]).select("event_id", "currency", "day", F.col("rate_date").cast("string").alias("rate_date"), "rate")


@query("""SELECT o_orderdate::DATE AS auth_date, c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS auths, count(*) FILTER (WHERE o_orderstatus = 'F') AS approved,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4) AS approval_rate, round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE, 2) AS amount_eur,
  round(coalesce(sum(o_totalprice::DECIMAL(18,2)) FILTER (WHERE o_orderstatus = 'F'), 0)::DOUBLE, 2) AS approved_amount_eur
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""")
def daily_rollup(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderdate").alias("auth_time"), F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderstatus") == "F").alias("approved"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount_eur"),
    )
    cast = [F.round(F.col(x).cast("double"), 2).alias(x) for x in ("amount_eur", "approved_amount_eur")]
    return aggregates.daily(rows, ["segment", "priority"]).select("auth_date", "segment", "priority", "auths", "approved", "approval_rate", *cast)


@query("""SELECT o_custkey AS merchant_id, arg_max(o_orderpriority, (o_orderdate, o_orderpriority, o_orderstatus)) AS merchant_name, count(*) AS auths,
  round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE, 2) AS amount_eur, min(o_orderdate) AS first_auth, max(o_orderdate) AS last_auth FROM orders GROUP BY 1""")
def customer_rollup(spark, d):
    rows = read(spark, d, "orders").select(
        F.col("o_custkey").alias("merchant_id"), F.col("o_orderpriority").alias("merchant_name"), F.col("o_orderstatus").alias("merchant_country"),
        F.col("o_orderdate").alias("auth_time"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount_eur"),
    )
    return aggregates.merchants(rows).select("merchant_id", "merchant_name", "auths", F.round(F.col("amount_eur").cast("double"), 2).alias("amount_eur"), "first_auth", "last_auth")


def _orders(spark, d) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderdate").alias("t"))


OLD_SQL = "WITH o AS (SELECT o_orderkey AS k, o_totalprice AS v, o_orderdate AS t FROM orders) "


@query(OLD_SQL + "SELECT k, v, t FROM o")
def merge_insert(spark, d):
    o = _orders(spark, d)
    once = merge.insert_new(o.where("k % 3 <> 0"), o.where("k % 2 = 0 OR k % 3 = 0"), ["k"])
    return merge.insert_new(once, o, ["k"])


@query(OLD_SQL + "SELECT k, CASE WHEN k % 5 = 0 THEN v + 1 ELSE v END AS v, CASE WHEN k % 5 = 0 OR k % 4 = 0 THEN NULL ELSE t END AS t FROM o")
def merge_upsert(spark, d):
    o = _orders(spark, d)
    source = o.where("k % 5 = 0 OR k % 4 = 0 OR k % 3 = 0").withColumn("v", F.when(F.col("k") % 5 == 0, F.col("v") + 1).otherwise(F.col("v")))
    source = source.withColumn("t", F.when((F.col("k") % 5 == 0) | (F.col("k") % 4 == 0), None).otherwise(F.col("t")))
    return merge.upsert_changed(o.where("k % 4 <> 0"), source, ["k"], "v").select("k", "v", "t")


@query(OLD_SQL + """SELECT k, CASE WHEN k % 5 = 0 AND k % 7 <> 0 THEN v + 1 ELSE v END AS v,
  CASE WHEN k % 7 = 0 THEN CASE WHEN k % 6 = 0 THEN TIMESTAMP '1990-01-01' ELSE TIMESTAMP '2020-01-01' END END AS delisted_at FROM o WHERE NOT (k % 4 = 0 AND k % 7 = 0)""")
def merge_sync(spark, d):
    o = _orders(spark, d).select("k", "v")
    old = o.where("k % 4 <> 0 OR k % 4 IS NULL").withColumn("delisted_at", F.when(F.col("k") % 6 == 0, F.lit("1990-01-01").cast("timestamp_ntz")))
    snapshot = o.where("k % 7 <> 0").withColumn("v", F.when(F.col("k") % 5 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return merge.sync_snapshot(old, snapshot, ["k"], "v", F.lit("2020-01-01").cast("timestamp_ntz")).select("k", "v", "delisted_at")


RECONCILE_SQL = """WITH l AS (SELECT o_orderkey AS k, o_totalprice AS v, (o_custkey % 4)::INT AS p, o_orderkey AS o FROM orders WHERE o_orderkey % 11 <> 0),
  r AS (SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS v, (o_custkey % 4)::INT AS p, o_orderkey AS o FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey > 500),
  s AS (SELECT p, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM (SELECT p, min(o) AS lo, max(o) AS hi FROM l GROUP BY p) a JOIN (SELECT p, min(o) AS lo, max(o) AS hi FROM r GROUP BY p) b USING (p)),
  x AS (SELECT k, v FROM l JOIN s USING (p) WHERE o BETWEEN lo AND hi), y AS (SELECT k, v FROM r JOIN s USING (p) WHERE o BETWEEN lo AND hi)
  SELECT count(*) FILTER (WHERE x.k IS NOT NULL AND y.k IS NOT NULL) AS in_both, count(*) FILTER (WHERE y.k IS NULL) AS only_live, count(*) FILTER (WHERE x.k IS NULL) AS only_replayed,
         count(*) FILTER (WHERE x.v <> y.v) AS changed FROM x FULL JOIN y ON x.k = y.k"""


@query(RECONCILE_SQL)
def reconcile_versions(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), (F.col("o_custkey") % 4).alias("kafka_partition"), F.col("o_orderkey").alias("kafka_offset"))
    rebuilt = o.where("k % 17 <> 0 AND k > 500").withColumn("v", F.col("v") + F.when(F.col("k") % 13 == 0, 1).otherwise(0))
    return reconcile.compare(o.where("k % 11 <> 0"), rebuilt, ["k"], ["v"])


@query("""WITH r AS (SELECT (l_linenumber % 3)::INT AS p, row_number() OVER (PARTITION BY l_linenumber % 3 ORDER BY l_orderkey, l_partkey, l_suppkey) AS o FROM lineitem)
  SELECT p AS kafka_partition, max(o) + 1 AS next_offset FROM r GROUP BY 1""")
def resume_offsets(spark, d):
    # No broker here: offsets are numbered within the stand-in partitions.
    rows = read(spark, d, "lineitem").selectExpr("cast(l_linenumber % 3 AS int) AS kafka_partition", "row_number() OVER (PARTITION BY l_linenumber % 3 ORDER BY l_orderkey, l_partkey, l_suppkey) AS kafka_offset")
    return runner.next_offsets(rows.where("kafka_offset % 2 = 0"), rows.where("kafka_offset % 2 = 1"))


@query("""WITH e AS (SELECT event_id, ts, value FROM events), days AS (SELECT DISTINCT ts::DATE AS day FROM e WHERE event_id % 50 = 0)
  SELECT event_id, ts::DATE AS day, value FROM e WHERE ts::DATE IN (FROM days)""")
def bronze_repair(spark, d):
    e = read(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), "value", F.lit(0).alias("ingested"))
    return merge.repair(e.unionByName(e.where("event_id % 50 = 0").withColumn("ingested", F.lit(1))), ["event_id"], "ingested", "day")[1].select("event_id", "day", "value")


SCREEN_SQL = """WITH w AS (SELECT 'm' AS side, p_partkey AS id, p_name AS n FROM part UNION ALL SELECT 'n', p_partkey, upper(p_name) FROM part WHERE p_partkey %% 9 = 0 OR p_partkey %% 10 = 1),
  c AS (SELECT side, id, array_to_string(list_filter(regexp_extract_all(lower(replace(n, '.', '')), '[a-z0-9_]+'), lambda x: NOT list_contains([%s], x)), ' ') AS name_norm FROM w)
  SELECT DISTINCT a.id AS merchant_id, b.id AS target_id, a.name_norm FROM c a JOIN c b ON a.name_norm = b.name_norm WHERE a.side = 'm' AND b.side = 'n' AND length(a.name_norm) >= 4""" % ", ".join(f"'{x}'" for x in names.LEGAL_FORMS)


@query(SCREEN_SQL)
def screening(spark, d):
    """Some targets are listed by name, some by an alias with letters beyond ASCII; persons are not screened."""
    p = read(spark, d, "part")
    by_name = F.col("p_partkey") % 9 == 0
    targets = p.where(by_name | (F.col("p_partkey") % 10 == 1) | (F.col("p_partkey") % 10 == 2)).select(
        F.col("p_partkey").alias("target_id"), F.when(by_name | (F.col("p_partkey") % 10 == 1), "Company").otherwise("Person").alias("schema"),
        F.when(by_name, F.concat(F.lit("The "), F.upper("p_name"), F.lit(", LLC"))).otherwise("Ltd").alias("name"),
        F.when(F.col("p_partkey") % 10 != 0, F.concat(F.lit("X;Th\u00c9 "), F.upper("p_name"), F.lit(" G.m.b.H."))).alias("aliases"), F.lit("gb").alias("countries"), F.lit("X").alias("program_ids"),
    )
    merchants = p.select(F.col("p_partkey").alias("merchant_id"), F.col("p_name").alias("merchant_name"))
    return names.screen(merchants, names.screening_names(targets)).select("merchant_id", "target_id", "name_norm")


CHECKS_SQL = """WITH c AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY ALL),
  o AS (SELECT o_orderdate::DATE AS d, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL),
  r AS (SELECT 'approval_rate_is_a_share' AS "check", count(*) FILTER (WHERE p = '1-URGENT') AS offending_rows FROM o
    UNION ALL SELECT 'candles_are_consistent', count(*) FILTER (WHERE n % 5 = 0) FROM c
    UNION ALL SELECT 'daily_counts_match', (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0)
    UNION ALL SELECT 'hits_are_listed', count(*) FILTER (WHERE s_suppkey % 4 = 0 OR s_suppkey % 6 = 0) FROM supplier
    UNION ALL SELECT 'one_candle_per_product_hour', count(*) FILTER (WHERE hour(h) = 3) FROM c
    UNION ALL SELECT 'rejects_carry_a_reason', count(*) FILTER (WHERE event_id % 7 = 0 OR event_id % 11 = 0) FROM events
    UNION ALL SELECT 'untouched_candles', 0)
  SELECT "check", offending_rows::BIGINT AS offending_rows, offending_rows = 0 AS passed FROM r"""


@query(CHECKS_SQL)
def quality_checks(spark, d):
    """Each check on rows of which some were spoilt, and one on rows as they are."""
    made = aggregates.candles(trades(spark, d), "HOUR")
    broken = made.withColumn("low", F.when(F.col("trades") % 5 == 0, F.col("high") + 1).otherwise(F.col("low")))
    orders = read(spark, d, "orders")
    o = orders.selectExpr("o_orderkey", "o_orderdate AS auth_time", "o_orderstatus = 'F' AS approved", "cast(o_totalprice AS decimal(18,2)) AS amount_eur", "o_orderpriority AS channel")
    daily = aggregates.daily(o, ["channel"])
    high = daily.withColumn("approval_rate", F.col("approval_rate") + F.when(F.col("channel") == "1-URGENT", 1.01).otherwise(0.0))
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("target_id"), F.when(F.col("s_suppkey") % 4 == 0, F.lit("2020-01-01").cast("timestamp")).alias("delisted_at"))
    rejects = read(spark, d, "events").withColumn("reason", F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, " ").otherwise("why"))
    return checks.run([
        checks.holds("candles_are_consistent", broken, *checks.candle_tests()), checks.holds("untouched_candles", made, *checks.candle_tests()),
        checks.repeated("one_candle_per_product_hour", made.unionByName(made.where("hour(bucket) = 3")), ["product_id", "bucket"]),
        checks.holds("approval_rate_is_a_share", high, *checks.share_tests()), checks.same_total("daily_counts_match", daily, "auths", o.where("o_orderkey % 10 <> 0")),
        checks.unlisted("hits_are_listed", s.select("target_id"), s.where("target_id % 6 <> 0")), checks.filled("rejects_carry_a_reason", rejects, "reason"),
    ])


def _shared(spark) -> str:
    """A folder of its own for a query's tables, among those that the cluster shares."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return f"{(base or 'file://' + tempfile.gettempdir()).rstrip('/')}/tidemark-streams/{uuid.uuid4().hex}"


def tables_at(spark, at: str, *wanted: str) -> dict[str, Table]:
    return {n: Table(spark, f"{at}/{n}", *domain.TABLES[n]) for n in wanted or domain.TABLES}


def _record(key, value) -> list:
    return [F.encode(key, "utf-8").alias("key"), F.encode(value, "utf-8").alias("value"), F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp")]


def _logged(rows: DataFrame, path: str) -> str:
    """Records as a log in four files, every tenth sent twice."""
    rows.unionByName(rows.where("offset % 10 = 0")).repartition(4).write.parquet(path)
    return path


def _odd(divisor: int, rest: int, wrong, right):
    return F.when(F.col("event_id") % divisor == rest, wrong).otherwise(right)


def _time(divisor: int, rest: int):
    return _odd(divisor, rest, "yesterday", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def _trade_log(spark, d, path: str) -> str:
    e = read(spark, d, "events")
    product = F.concat("event_type", F.lit("-USD"))
    body = F.to_json(F.struct(
        F.col("event_id").alias("trade_id"), product.alias("product_id"), F.col("value").cast("string").alias("price"),
        _odd(107, 9, "abc", (F.col("event_id") % 10 + 1).cast("string")).alias("size"), _odd(109, 3, "hold", F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell")).alias("side"),
        _time(113, 4).alias("time"), F.col("event_id").alias("sequence"),
    ))
    return _logged(e.select(_record(_odd(103, 7, "other", product), _odd(100, 99, "not json", body))), path)


TRADE_LOG_SQL = """WITH j AS (SELECT *, CASE WHEN event_id % 100 = 99 THEN 'not a trade record' WHEN event_id % 103 = 7 THEN 'key is not the product'
  WHEN value IS NULL OR value <= 0 THEN 'price is not a positive decimal' WHEN event_id % 107 = 9 THEN 'size is not a positive decimal' WHEN event_id % 109 = 3 THEN 'side is not buy or sell'
  WHEN event_id % 113 = 4 THEN 'time is not a timestamp' END AS reason FROM events) """


def _streamed(spark, d, silver: str = "trades") -> dict[str, Table]:
    at = _shared(spark)
    log, t = _trade_log(spark, d, f"{at}/log"), tables_at(spark, at, "trades_bronze", silver, "trades_rejects")
    runner.finish(spark, [
        runner.start(runner.file_log(spark, log, 2), runner.bronze_batch(t["trades_bronze"]), f"{at}/ck-bronze"),
        runner.start(runner.file_log(spark, log, 2), runner.trade_batch(t[silver], t["trades_rejects"]), f"{at}/ck-silver"),
    ])
    return t


@query("SELECT (event_id % 4)::INT AS kafka_partition, event_id AS kafka_offset FROM events")
def stream_bronze(spark, d):
    return _streamed(spark, d)["trades_bronze"].read().select("kafka_partition", "kafka_offset")


@query(TRADE_LOG_SQL + "SELECT event_id AS trade_id, event_type || '-USD' AS product_id, round(value, 6) AS price, round(round(value, 6) * (event_id % 10 + 1), 6) AS notional FROM j WHERE reason IS NULL")
def stream_silver_v2(spark, d):
    return _streamed(spark, d, "trades_v2")["trades_v2"].read().select("trade_id", "product_id", *money("price", "notional"))


@query(TRADE_LOG_SQL + "SELECT reason, event_id AS kafka_offset FROM j WHERE reason IS NOT NULL")
def stream_rejects(spark, d):
    return _streamed(spark, d)["trades_rejects"].read().select("reason", "kafka_offset")


@query(TRADE_LOG_SQL + "SELECT count(*) AS in_both, 0::BIGINT AS only_live, 0::BIGINT AS only_replayed, 0::BIGINT AS changed, 0::BIGINT AS no_notional FROM j WHERE reason IS NULL")
def replay_compare(spark, d):
    """The log replayed into v2, twice with a reset, then compared with what the live stream made of it."""
    at = _shared(spark)
    log, t = _trade_log(spark, d, f"{at}/log"), tables_at(spark, at, "trades", "trades_v2", "trades_rejects")
    runner.finish(spark, [runner.start(runner.file_log(spark, log, 2), runner.trade_batch(t["trades"], t["trades_rejects"]), f"{at}/ck-live")])
    for reset in (False, False, True):
        runner.replay(runner.file_log(spark, log, 4), t["trades_v2"], t["trades_rejects"], f"{at}/ck-replay", reset)
    return reconcile.compare(t["trades"].read(), t["trades_v2"].read(), domain.TRADE_KEY, ["price", "size", "side", "trade_time"], "notional")


def _card_log(spark, d, path: str) -> str:
    e, n = read(spark, d, "events"), F.col("user_id")
    token, shop = F.concat(F.lit("tok_"), n.cast("string")), (n % 17).cast("string")
    body = F.to_json(F.struct(
        F.concat(F.lit("a-"), F.col("event_id").cast("string")).alias("auth_id"), token.alias("card_token"), F.concat(F.lit("m-"), shop).alias("merchant_id"),
        F.concat(F.lit("Shop No "), shop).alias("merchant_name"), F.lit("5411").alias("mcc"), _odd(101, 5, None, F.lit("GB")).alias("merchant_country"),
        (F.col("event_id") % 997 / 4).cast("decimal(18,2)").alias("amount"), F.element_at(F.array(*map(F.lit, ("EUR", "C1", "C2", "C3", "XXX"))), (n % 5 + 1).cast("int")).alias("currency"),
        F.element_at(F.array(*map(F.lit, ("pos", "contactless", "ecom", "atm"))), (n % 4 + 1).cast("int")).alias("channel"),
        _odd(77, 1, "ok", _odd(5, 0, "51", F.lit("00"))).alias("response_code"), _time(113, 4).alias("auth_time"),
    ))
    return _logged(e.select(_record(_odd(103, 7, "other", token), _odd(100, 99, "not json", body))), path)


def _fixed(spark, d) -> DataFrame:
    """Fixings on some days, each twice (the higher counts), and of another base."""
    days = read(spark, d, "events").select(F.to_date("ts").alias("rate_date")).distinct().where("day(rate_date) % 9 < 3")
    quotes = days.select("rate_date", F.explode(F.array(*map(F.lit, ("C1", "C2", "C3")))).alias("quote"), F.pow(2.0, F.day("rate_date") % 3).alias("rate"))
    rows = quotes.withColumn("base", F.lit("EUR")).unionByName(quotes.selectExpr("rate_date", "quote", "rate / 2 AS rate", "'EUR' AS base")).unionByName(quotes.selectExpr("rate_date", "quote", "rate + 90 AS rate", "'USD' AS base"))
    return rows.withColumn("source", F.lit("test")).withColumn("ingested_at", F.current_timestamp())


CARD_LOG_SQL = """WITH e AS (SELECT event_id, user_id, ts, ts::DATE AS day, ((event_id % 997) / 4)::DECIMAL(18,2) AS amount, ['EUR', 'C1', 'C2', 'C3', 'XXX'][user_id % 5 + 1] AS currency,
    ['pos', 'contactless', 'ecom', 'atm'][user_id % 4 + 1] AS channel, event_id % 5 <> 0 AS approved FROM events),
  r AS (SELECT DISTINCT ts::DATE AS rate_date, 2 ** (day(ts) % 3) AS rate FROM events WHERE day(ts) % 9 < 3),
  m AS (SELECT e.*, max(rate_date) AS last_date, arg_max(rate, rate_date) AS last_rate FROM e LEFT JOIN r ON rate_date <= day AND rate_date > day - 7 GROUP BY ALL),
  f AS (SELECT *, CASE WHEN currency = 'EUR' THEN day WHEN currency <> 'XXX' THEN last_date END AS fx_rate_date, CASE WHEN currency = 'EUR' THEN 1 WHEN currency <> 'XXX' THEN last_rate END AS fx_rate FROM m),
  j AS (SELECT *, round(amount::DOUBLE / fx_rate, 2) AS amount_eur, CASE WHEN event_id % 100 = 99 THEN 'not a card authorisation' WHEN amount <= 0 THEN 'amount is not a positive decimal'
    WHEN currency = 'XXX' THEN 'currency is not one the ECB fixes' WHEN event_id % 113 = 4 THEN 'time is not a timestamp' WHEN fx_rate IS NULL THEN 'no ECB rate in the week before'
    WHEN event_id % 103 = 7 THEN 'key is not the card token' WHEN event_id % 101 = 5 THEN 'merchant is missing' WHEN channel = 'atm' THEN 'channel is not pos, contactless or ecom'
    WHEN event_id % 77 = 1 THEN 'response code is not two digits' END AS reason FROM f) """


def _cards(spark, d) -> tuple[str, dict[str, Table]]:
    """Both streams in one application, up to the end of their logs."""
    at = _shared(spark)
    t = tables_at(spark, at)
    t["fx_rates"].append(_fixed(spark, d))
    trades_at, cards_at = _trade_log(spark, d, f"{at}/trade-log"), _card_log(spark, d, f"{at}/card-log")
    runner.finish(spark, runner.start_all(lambda: runner.file_log(spark, trades_at, 4), lambda: runner.file_log(spark, cards_at, 2), t, runner.json_sink(f"{at}/dlq"), f"{at}/ck"))
    return at, t


@query(CARD_LOG_SQL + "SELECT 'a-' || event_id AS auth_id, currency, fx_rate::DOUBLE AS fx_rate, fx_rate_date::VARCHAR AS fx_rate_date, amount_eur, approved FROM j WHERE reason IS NULL")
def stream_cards(spark, d):
    rows = _cards(spark, d)[1]["card_auths"].read()
    return rows.select("auth_id", "currency", F.col("fx_rate").cast("double").alias("fx_rate"), F.col("fx_rate_date").cast("string").alias("fx_rate_date"), F.col("amount_eur").cast("double").alias("amount_eur"), "approved")


@query(CARD_LOG_SQL + """SELECT reason, event_id AS kafka_offset, 'tok_' || user_id AS token FROM j WHERE reason IS NOT NULL AND event_id % 103 <> 7 AND event_id % 100 <> 99
  UNION ALL SELECT reason, event_id, CASE WHEN event_id % 103 = 7 THEN 'other' ELSE 'tok_' || user_id END FROM j WHERE reason IS NOT NULL AND (event_id % 103 = 7 OR event_id % 100 = 99)""")
def stream_card_dead_letters(spark, d):
    """Dead letters come at least once; a letter is known by its record's place."""
    at, t = _cards(spark, d)
    letters = spark.read.schema("key string, value string").json(f"{at}/dlq").withColumn("v", F.from_json("value", "reason string, topic string, partition int, offset bigint"))
    held = t["card_auths_rejects"].read().select("reason", "kafka_offset")
    return letters.select(F.col("v.reason").alias("reason"), F.col("v.offset").alias("kafka_offset"), F.col("key").alias("token")).distinct().join(held, ["reason", "kafka_offset"], "left_semi")


def _silver(spark, d, at: str) -> tuple[dict[str, Table], DataFrame, DataFrame]:
    """The tables, and what the events are as trades and as card authorisations."""
    e = read(spark, d, "events").withColumn("at", F.current_timestamp())
    place = ["cast(user_id % 4 AS int) AS kafka_partition", "event_id AS kafka_offset", "at AS ingested_at"]
    t = e.selectExpr("event_id AS trade_id", "event_type AS product_id", "upper(event_type) AS base_currency", "'USD' AS quote_currency", "cast(value AS decimal(30,12)) AS price",
                     "cast(event_id % 10 + 1 AS decimal(30,12)) AS size", "'buy' AS side", "cast(ts AS timestamp) AS trade_time", "event_id AS sequence", *place)
    c = e.selectExpr("concat('a-', event_id) AS auth_id", "concat('tok_', user_id) AS card_token", "concat('m-', user_id % 17) AS merchant_id", "concat('Shop No ', user_id % 17) AS merchant_name", "'5411' AS mcc",
                     "'GB' AS merchant_country", "element_at(array('pos', 'contactless', 'ecom'), cast(user_id % 3 + 1 AS int)) AS channel", "'00' AS response_code", "event_id % 5 <> 0 AS approved",
                     "cast(event_id % 997 / 4 AS decimal(18,2)) AS amount", "'EUR' AS currency", "cast(1 AS decimal(18,6)) AS fx_rate", "to_date(ts) AS fx_rate_date",
                     "cast(event_id % 997 / 4 AS decimal(18,2)) AS amount_eur", "cast(ts AS timestamp) AS auth_time", *place)
    return tables_at(spark, at), t, c


def _gold(spark, d) -> tuple[dict[str, Table], DataFrame]:
    """Gold built from all events but some of the last two days' and an old one that nobody rebuilds for, and again when they have come."""
    tables, t, c = _silver(spark, d, _shared(spark))
    today = t.agg(F.to_date(F.max("trade_time"))).first()[0]
    names_of = spark.createDataFrame([("T-1", "Company", "SHOP NO 3", None), ("T-2", "Organization", "Nobody", "Shöp No 11 GmbH;Shop No 99"), ("T-3", "Person", "Shop No 4", None), ("T-4", "Company", "Shop No 5", None)], "target_id string, schema string, name string, aliases string")
    listed = names_of.selectExpr("target_id", "schema", "name", "aliases", "'gb' AS countries", "'P' AS program_ids", *[f"cast(null AS {k}) AS {n}" for n, k in (("sanctions", "string"), ("first_seen", "timestamp"), ("last_seen", "timestamp"), ("last_change", "timestamp"))])
    for on, rows in (("2026-01-01", listed), ("2026-01-02", listed.where("target_id <> 'T-4'"))):
        reference.load_targets(tables["sanctions_targets"], tables["sanctions_names"], rows, F.lit(on).cast("timestamp"), floor=3)
    late = lambda time: (F.col("kafka_offset") % 4 == 0) & (F.to_date(time) >= F.date_sub(F.lit(today), 1))
    for first in (True, False):
        tables["trades"].insert_new(t if not first else t.where(~late("trade_time")), domain.TRADE_KEY)
        tables["card_auths"].insert_new(c if not first else c.where(~late("auth_time")), domain.CARD_KEY)
        found = gold.build(tables, today)
    return tables, found


@query(_candles_sql("minute", "minute", "upper(product_id) AS base_currency,"))
def gold_candles(spark, d):
    rows = _gold(spark, d)[0]["crypto_ohlcv_1m"].read()
    return rows.select("product_id", F.col("minute").cast("timestamp_ntz").alias("minute"), "base_currency", *money("open", "high", "low", "close", "volume", "notional", "vwap"), "trades")


@query("""SELECT ts::DATE AS auth_date, ['pos', 'contactless', 'ecom'][user_id % 3 + 1] AS channel, count(*) AS auths, count(*) FILTER (WHERE event_id % 5 <> 0) AS approved,
  round(count(*) FILTER (WHERE event_id % 5 <> 0) / count(*), 4) AS approval_rate, round(sum(((event_id % 997) / 4)::DECIMAL(18,2))::DOUBLE, 2) AS amount_eur FROM events GROUP BY 1, 2""")
def gold_daily(spark, d):
    return _gold(spark, d)[0]["card_auth_daily"].read().select("auth_date", "channel", "auths", "approved", "approval_rate", F.round(F.col("amount_eur").cast("double"), 2).alias("amount_eur"))


@query("""SELECT 'm-' || m AS merchant_id, 'shop no ' || m AS name_norm, CASE m WHEN 3 THEN 'T-1' ELSE 'T-2' END AS target_id, count(*) AS auths FROM (SELECT user_id % 17 AS m FROM events) WHERE m IN (3, 11) GROUP BY m""")
def gold_hits(spark, d):
    return _gold(spark, d)[0]["sanctions_hits"].read().select("merchant_id", "name_norm", "target_id", "auths")


@query("""SELECT unnest(['approval_rate_is_a_share', 'candles_are_consistent', 'card_auths_rejects_carry_a_reason', 'daily_counts_match_silver', 'hits_are_on_todays_list', 'one_candle_per_product_minute',
  'trades_rejects_carry_a_reason']) AS "check", 0::BIGINT AS offending_rows, true AS passed""")
def gold_checks(spark, d):
    return _gold(spark, d)[1]


@query("""WITH r AS (SELECT DISTINCT ts::DATE AS rate_date FROM events), q AS (FROM (VALUES ('GBP', 0), ('USD', 1)) t(quote, more))
  SELECT rate_date::VARCHAR AS rate_date, quote, day(rate_date) / 4 + more + CASE WHEN rate_date >= (SELECT max(rate_date) FROM r) - 7 THEN 0.5 ELSE 0 END AS rate FROM r, q""")
def fx_load(spark, d):
    """A first load of all days, and a second one that finds other rates; only days that are revisited take them."""
    days = sorted(r[0] for r in read(spark, d, "events").select(F.to_date("ts")).distinct().collect())
    table = tables_at(spark, _shared(spark), "fx_rates")["fx_rates"]
    for more in (0.0, 0.5):
        fetch = lambda start, end: json.dumps({"base": "EUR", "rates": {str(x): {"GBP": x.day / 4 + more, "USD": x.day / 4 + 1 + more, "EUR": 1.0} for x in days if start <= x <= end}})  # noqa: B023, E731
        reference.load_rates(table, fetch, days[-1], days[0])
    return table.read().select(F.col("rate_date").cast("string").alias("rate_date"), "quote", "rate")


@query("""SELECT * FROM (SELECT 'price is null' AS rule, count(*) FILTER (WHERE event_id % 9 = 0) AS offending_rows FROM events UNION ALL SELECT 'side is null', count(*) FILTER (WHERE event_id % 14 = 0) FROM events
  UNION ALL SELECT 'key is repeated', count(*) FILTER (WHERE event_id % 6 = 0) FROM events UNION ALL SELECT 'newest row is too old', 1) WHERE offending_rows > 0""")
def contract_violations(spark, d):
    t = _silver(spark, d, _shared(spark))[1]
    spoilt = t.withColumn("price", F.when(F.col("trade_id") % 9 != 0, F.col("price"))).withColumn("side", F.when(F.col("trade_id") % 14 != 0, F.col("side"))).withColumn("ingested_at", F.col("trade_time"))
    twice = spoilt.unionByName(t.where("trade_id % 6 = 0").withColumn("ingested_at", F.col("trade_time")))
    return contracts.CONTRACTS["trades"].violations(twice, dt.datetime(2100, 1, 1))
