"""Golden facts of the two streams, the gold products and the reference loads."""

import datetime as dt
import json
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import decode, names, rules
from tidemark.operators import aggregates, asof, checks, merge, reconcile
from tidemark.plans import contracts, domain, gold, schedule
from tidemark.sources import reference, swap
from tidemark.sources.tables import Table
from tidemark import submit
from tidemark.streaming import runner

RECORD = "kafka_key string, payload string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, ingested_at timestamp"
NOW = dt.datetime(2026, 9, 28, 12)
TRADE = {"trade_id": 1099205733, "product_id": "BTC-USD", "price": "84751.67", "size": "0.00003146", "side": "buy", "time": "2026-09-27T19:44:39.896491Z", "sequence": 136853740770}
CARD = {"auth_id": "a-1", "card_token": "tok_1", "merchant_id": "m-1", "merchant_name": "Shop", "mcc": "5411", "merchant_country": "GB", "amount": 42.5, "currency": "GBP",
        "channel": "pos", "response_code": "00", "auth_time": "2026-09-28T10:00:00Z"}


def bronze(spark, rows):
    return spark.createDataFrame([(k, p if isinstance(p, str) else json.dumps(p), 0, i, NOW, NOW) for i, (k, p) in enumerate(rows)], RECORD)


def test_trades(spark):
    rows = [("BTC-USD", TRADE), ("BTC-USD", TRADE), ("ETH-EUR", TRADE | {"trade_id": 1099205734, "product_id": "ETH-EUR", "price": "2694.29"}), ("BTC-USD", "not json"),
            ("ETH-USD", TRADE), ("BTC-USD", TRADE | {"price": "-1"}), ("BTC-USD", TRADE | {"size": "abc"}), ("BTC-USD", TRADE | {"side": "hold"}), ("BTC-USD", TRADE | {"time": "yesterday"})]
    judged = rules.judged(decode.trades(bronze(spark, rows)), domain.TRADE_RULES)
    good, bad = rules.split(judged)
    once = rules.first_by(good, domain.TRADE_KEY, domain.RECORD_KEY).withColumn("notional", decode.notional()).orderBy("kafka_offset").collect()
    assert [(r.kafka_offset, r.base_currency, r.quote_currency) for r in once] == [(0, "BTC", "USD"), (2, "ETH", "EUR")]
    assert once[0].price == Decimal("84751.67") and once[0].notional == Decimal("2.666287538200")
    assert [r.reject_reason for r in bad.orderBy("kafka_offset").collect()] == [r.reason for r in domain.TRADE_RULES]


def test_cards(spark):
    fx = spark.createDataFrame([(dt.date(2026, 9, 25), "GBP", 0.84), (dt.date(2026, 9, 24), "GBP", 0.90), (dt.date(2026, 9, 25), "JPY", 160.0), (dt.date(2026, 9, 1), "SEK", 11.0)], "rate_date date, quote string, rate double")
    rows = [("tok_1", CARD), ("tok_1", CARD | {"auth_id": "a-2", "currency": "JPY", "amount": 16000, "response_code": "51"}), ("tok_1", CARD | {"auth_id": "a-3", "currency": "EUR", "amount": 10, "channel": "ecom"}),
            ("?", CARD | {"amount": None}), ("tok_1", CARD | {"currency": "XXX"}), ("tok_1", '"text"'), ("tok_1", CARD | {"currency": "SEK"}), ("tok_9", CARD), ("tok_1", CARD | {"auth_time": "yesterday"}),
            ("tok_1", CARD | {"channel": "atm"}), ("tok_1", CARD | {"response_code": "approved"}), ("tok_1", CARD | {"merchant_id": None}), ("tok_1", CARD | {"currency": None})]
    judged = rules.judged(asof.in_euro(decode.card_auths(bronze(spark, rows)), fx), domain.CARD_RULES).orderBy("kafka_offset").collect()
    assert [(r.auth_id, r.fx_rate_date.day, r.amount_eur, r.approved) for r in judged[:3]] == [("a-1", 25, Decimal("50.60"), True), ("a-2", 25, Decimal("100.00"), False), ("a-3", 28, Decimal("10.00"), True)]
    assert [r.reject_reason for r in judged[3:]] == [
        "amount is not a positive decimal", "currency is not one the ECB fixes", "not a card authorisation", "no ECB rate in the week before", "key is not the card token",
        "time is not a timestamp", "channel is not pos, contactless or ecom", "response code is not two digits", "merchant is missing", "no ECB rate in the week before"]


def test_asof_boundary_and_dead_letters(spark):
    facts = spark.createDataFrame([(i, "A", dt.date(2026, 1, 1) + dt.timedelta(i)) for i in range(12)] + [(99, None, dt.date(2026, 1, 2))], "id int, c string, day date")
    rates = spark.createDataFrame([("A", dt.date(2026, 1, 2), 1.0), ("A", dt.date(2026, 1, 4), 2.0)], "q string, rd date, rate double")
    a = asof.asof_interval(facts, rates, "c", "day", "q", "rd")
    b = asof.asof_window(facts, rates, "c", "day", "q", "rd", ["id"])
    assert sorted(map(tuple, a.select("id", "rate").collect())) == sorted(map(tuple, b.select("id", "rate").collect())) == sorted(
        [(i, None if i == 0 or i > 9 else 1.0 if i < 3 else 2.0) for i in range(12)] + [(99, None)])
    # Two fixings of one day: the higher counts, nothing is looked up ahead, and no fact comes twice. Other bases don't count.
    more = spark.createDataFrame([("A", dt.date(2026, 1, 2), 0.5), ("A", dt.date(2026, 1, 4), 1.5), ("A", None, 7.0)], "q string, rd date, rate double")
    for again in (asof.asof_interval(facts, rates.union(more), "c", "day", "q", "rd"), asof.asof_window(facts, rates.union(more), "c", "day", "q", "rd", ["id"])):
        assert sorted(map(tuple, again.select("id", "rate").collect())) == sorted(map(tuple, a.select("id", "rate").collect()))
    based = spark.createDataFrame([(dt.date(2026, 1, 2), "EUR", "GBP", 0.5), (dt.date(2026, 1, 2), "USD", "GBP", 9.0), (dt.date(2026, 1, 2), "USD", "EUR", 9.0)], "rate_date date, base string, quote string, rate double")
    card = spark.createDataFrame([("GBP", dt.date(2026, 1, 3), Decimal(1), "00"), ("JPY", dt.date(2026, 1, 3), Decimal(1), "00")], "currency string, auth_date date, amount decimal(18,2), response_code string")
    assert [(r.currency_known, r.amount_eur) for r in asof.in_euro(card, based).orderBy("currency").collect()] == [(True, Decimal(2)), (False, None)]
    rejects = spark.createDataFrame([("r", "k", None, 1, 6)], "reason string, kafka_key string, payload string, kafka_partition int, kafka_offset bigint")
    assert json.loads(decode.dead_letters(rejects, domain.CARDS_TOPIC).first().value) == {"reason": "r", "topic": domain.CARDS_TOPIC, "partition": 1, "offset": 6}


def test_candles(spark):
    t = lambda s: dt.datetime.fromisoformat(f"2026-09-28 {s}")
    rows = [(2, "BTC-USD", 100, 1, t("10:15:05")), (1, "BTC-USD", 90, 3, t("10:15:05")), (3, "BTC-USD", 110, 1, t("10:15:40")), (4, "BTC-USD", 120, 2, t("10:16:00")), (5, "BTC-USD", 1, 1, dt.datetime(2026, 9, 20))]
    rows += [(10 + i, "BTC-EUR", Decimal("73818.56"), Decimal(s), t(f"11:00:0{i}")) for i, s in enumerate(("0.00123456", "0.00087654", "0.00011111"))]
    df = spark.createDataFrame([(a, b, Decimal(c), Decimal(d), e) for a, b, c, d, e in rows], "trade_id bigint, product_id string, price decimal(30,12), size decimal(30,12), trade_time timestamp")
    found = {(r.product_id, r.bucket.minute): r for r in aggregates.candles(df, since=F.lit("2026-09-28").cast("timestamp")).collect()}
    c = found["BTC-USD", 15]
    assert (c.open, c.high, c.low, c.close, c.volume, c.trades, c.vwap) == (90, 110, 90, 110, 5, 3, 96) and len(found) == 3
    assert found["BTC-EUR", 0].vwap == Decimal("73818.56") and found["BTC-EUR", 0].notional == Decimal("73818.56") * Decimal("0.00222221")
    result = checks.run([checks.holds("c", aggregates.candles(df), *checks.candle_tests()), checks.repeated("k", aggregates.candles(df), ["product_id", "bucket"])])
    checks.enforce(result)
    with pytest.raises(RuntimeError, match="bad"):
        checks.enforce(checks.run([checks.holds("bad", df, F.col("price") <= 1)]))


def test_merges_are_idempotent(spark):
    make = lambda rows: spark.createDataFrame(rows, "k int, v int, delisted_at timestamp")
    a, b = make([(1, 1, None), (2, 2, None)]), make([(2, 9, None), (3, 3, None), (3, 4, None)])
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    once = merge.insert_new(a, b, ["k"], ["v"])
    assert rows(once) == rows(merge.insert_new(once, b, ["k"], ["v"])) == [(1, 1, None), (2, 2, None), (3, 3, None)]
    up = merge.upsert_changed(a, make([(2, 9, None), (4, 4, None)]), ["k"], "v")
    assert rows(up) == [(1, 1, None), (2, 9, None), (4, 4, None)]
    now = F.lit("2026-01-02").cast("timestamp")
    first = merge.sync_snapshot(a, make([(2, 2, None)]).drop("delisted_at"), ["k"], "v", now)
    assert {r.k: r.delisted_at is not None for r in first.collect()} == {1: True, 2: False}
    back = merge.sync_snapshot(first, make([(1, 1, None), (2, 2, None)]).drop("delisted_at"), ["k"], "v", now)
    assert {r.k: r.delisted_at for r in back.collect()} == {1: None, 2: None}


def test_reconcile(spark):
    def side(ids, change=()):
        return spark.createDataFrame([(i, dict(change).get(i, 100), 0, i) for i in ids], "trade_id int, price int, kafka_partition int, kafka_offset int")

    go = lambda a, b: tuple(reconcile.compare(a, b, ["trade_id"], ["price"]).first())
    assert go(side(range(10, 20)), side(range(10, 20))) == (10, 0, 0, 0)
    assert go(side([*range(13), 30]), side([11, 12, 13, 14], [(12, 101)])) == (2, 0, 2, 1)
    lost = reconcile.compare(side(range(10, 16)), side([10, 11, 13, 14, 15]), ["trade_id"], ["price"]).first()
    assert tuple(lost) == (5, 1, 0, 0) and reconcile.differs(lost)
    rebuilt = side(range(10, 15)).withColumn("notional", F.when(F.col("trade_id") != 12, 1))
    short = reconcile.compare(side(range(10, 15)), rebuilt, ["trade_id"], ["price"], "notional").first()
    assert tuple(short) == (5, 0, 0, 0, 1) and short.no_notional == 1 and reconcile.differs(short)
    assert not reconcile.differs(reconcile.compare(side(range(10, 15)), rebuilt.fillna(0), ["trade_id"], ["price"], "notional").first())
    assert reconcile.differs(reconcile.compare(side([1]), side([2]), ["trade_id"], ["price"]).first())


def test_names_and_reference_loads(spark, tmp_path):
    cases = {"Société Générale S.A.": "societe generale", "Booking.com": "bookingcom", "OOO AO": None, "PJSC \"Aeroflot\"": "aeroflot", "АЛРОСА": "алроса", "": None, None: None, "Straße 42": "strasse 42"}
    df = spark.createDataFrame([(k,) for k in cases], "n string").select("n", names.normalised(F.col("n")).alias("o"))
    assert {r.n: r.o for r in df.collect()} == cases
    (tmp_path / "t.csv").write_text('id,schema,name,aliases,countries,program_ids,sanctions,first_seen,last_seen,last_change,phones\nNK-1,Organization,"PJSC ""Aeroflot""",,ru,P,"a\nb",2026-01-01T00:00:00,,,1\nNK-2,Company,PJSC AK Alrosa,Alrosa;АЛРОСА,ru,P,,,,,\nNK-3,Person,John Long,,,,,,,,\n')
    listed = reference.listed_targets(spark, str(tmp_path / "t.csv"))
    assert sorted((r.target_id, r.name_norm) for r in names.screening_names(listed).collect()) == [("NK-1", "aeroflot"), ("NK-2", "ak alrosa"), ("NK-2", "alrosa"), ("NK-2", "алроса")]
    with pytest.raises(ValueError):
        reference.sane(listed)
    fx = reference.fixings(spark.createDataFrame([('{"base":"EUR","rates":{"2026-01-02":{"GBP":0.8,"EUR":1.0}}}',)], "value string")).collect()
    assert [(str(r.rate_date), r.base, r.quote, r.rate) for r in fx] == [("2026-01-02", "EUR", "GBP", 0.8)]
    messages = spark.createDataFrame([(json.dumps(TRADE | {"type": "match"}),), ('{"type":"heartbeat"}',)], "value string")
    assert [r.key for r in reference.feed_records(messages).collect()] == ["BTC-USD"]
    with pytest.raises(Exception, match="feed error"):
        reference.feed_records(spark.createDataFrame([('{"type":"error","message":"no"}',)], "value string")).collect()
    cards = reference.synthetic_cards(spark, 2000)
    assert cards.collect() == reference.synthetic_cards(spark, 2000).collect() and 5 < cards.where("key IS NULL OR value NOT LIKE '%amount%' OR value LIKE '%XXX%' OR value LIKE '%:-%'").count() < 60


def test_screening_by_lists(spark):
    merchants = spark.createDataFrame([(i, "Acme Ltd" if i % 9 else f"Other {i}") for i in range(300)], "merchant_id long, merchant_name string")
    listed = [(None if i == 7 else f"T{i}", "Company", "acme", "gb" if i % 2 else None, "X") for i in range(200)] + [("T1", "Company", "acme", "gb", "X"), ("T5", "Company", "other 9", "ru", None), ("T6", "Company", None, "ru", "X")]
    listed = spark.createDataFrame(listed, "target_id string, schema string, name_norm string, countries string, program_ids string")
    hits = names.screen(merchants, listed)
    found = hits.collect()
    plain = merchants.withColumn("name_norm", names.normalised(F.col("merchant_name"))).join(listed.withColumnRenamed("schema", "target_schema"), "name_norm")
    assert hits.columns == plain.columns and Counter(found) == Counter(plain.collect()) and len(found) == 266 * 201 + 1

    def joined(plan):
        """Rows that the plan's joins gave."""
        name = plan.nodeName()
        below = plan.executedPlan() if name.startswith("AdaptiveSparkPlan") else plan.plan() if name.endswith("QueryStage") else None
        children = [below] if below else [plan.children().apply(i) for i in range(plan.children().size())]
        return ("Join" in name and plan.metrics().apply("numOutputRows").value()) + sum(map(joined, children))

    # Hits are made of lists: the join itself gives a fraction of them.
    assert 0 < joined(hits._jdf.queryExecution().executedPlan()) * 2 < len(found)


def test_tables(spark, tmp_path):
    at, rows = f"file://{tmp_path}", lambda t: sorted(map(tuple, t.read().collect()))
    t = Table(spark, f"{at}/t", "k int, day string, at bigint", "day", ("at",))
    make = lambda *r: spark.createDataFrame(r, "k int, day string, at bigint")
    assert t.read().count() == 0 and not t.exists()
    t.append(make((1, "a", 5), (2, "b", 6)))
    t.append(spark.createDataFrame([], "k int, day string, at bigint"))
    t.replace_partitions(make((3, "b", 9), (4, None, 1)))
    assert rows(t) == [(1, "a", 5), (3, "b", 9), (4, None, 1)] and t.read(0).count() == 2 and t.versions() == [0, 1]
    # Appending leaves what is there alone, and a scan opens only pieces that can hold what is looked for.
    before = {p["folder"] for p in t.pieces()}
    t.insert_new(make((3, "b", 9), (5, "c", 9), (5, "c", 9)), ["k"])
    assert before < {p["folder"] for p in t.pieces()} and rows(t)[-1] == (5, "c", 9) and len(rows(t)) == 4
    assert {r.k for r in t.scan("b").collect()} == {3, 4, 5} and {r.k for r in t.scan(None, {"at": 6}).collect()} == {3, 5}
    for i in range(3):
        t.append(make((10 + i, "c", i)))
    t.compact(2)
    assert len(t.pieces()) == 4 and len(rows(t)) == 7
    t.expire(1)
    assert len(t.versions()) == 1 and len(rows(t)) == 7
    with pytest.raises(RuntimeError, match="another writer"):
        t._commit([], [v - 1 for v in t.versions()])
    t.rename(f"{at}/u")
    assert len(rows(t)) == 7
    t.overwrite(t.read().where("k = 1"))
    assert rows(t) == [(1, "a", 5)]
    t.overwrite(t.read().limit(0))
    assert rows(t) == [] and t.exists()
    days = Table(spark, f"{at}/d", "k int, x timestamp", "days(x)")
    days.append(spark.createDataFrame([(i, NOW + dt.timedelta(days=i)) for i in range(3)], "k int, x timestamp"))
    assert sorted(p["part"] for p in days.pieces()) == ["2026-09-28", "2026-09-29", "2026-09-30"] and days.scan(dt.date(2026, 9, 30)).count() == 1


def test_swap():
    named = {"live": "s", "v1": "s_v1", "v2": "s_v2"}
    held = {"s", "s_v2"}

    def rename(a, b):
        held.remove(a)
        held.add(b)

    with pytest.raises(ValueError, match="differs"):
        swap.switch("v2", named, held.__contains__, rename, lambda: True)
    assert swap.switch("v2", named, held.__contains__, rename, lambda: True, force=True) == [("s", "s_v1"), ("s_v2", "s")] and held == {"s", "s_v1"}
    with pytest.raises(ValueError, match="missing"):
        swap.moves("v2", named, held.__contains__)
    assert swap.switch("v1", named, held.__contains__, rename, lambda: True) == [("s", "s_v2"), ("s_v1", "s")] and held == {"s", "s_v2"}
    with pytest.raises(ValueError, match="in the way"):
        swap.moves("v2", named, {"s", "s_v1", "s_v2"}.__contains__)
    with pytest.raises(ValueError, match="none of"):
        swap.moves("v3", named, held.__contains__)


def test_streams(spark, tmp_path):
    held = spark.createDataFrame([(0, 4), (0, 7), (1, 2)], "kafka_partition int, kafka_offset bigint")
    assert json.loads(runner.starting_offsets("t", [0, 1, 2], [held, held])) == {"t": {"0": 8, "1": 3, "2": -2}}
    assert runner.starting_offsets("t", [0], [held], True) == runner.starting_offsets("t", [0], [held.limit(0)]) == "earliest"
    assert runner.pace_of({}) == runner.Pace(None, 300) and runner.pace_of({"PLATFORM_SCALE": "full"}) == runner.Pace("30 seconds")
    assert runner.pace_of({"TRIGGER": "5 seconds", "RUN_EVERY": "9"}).every == 0 and runner.pace_of({"RUN_EVERY": "9"}).trigger == {"availableNow": True}
    with pytest.raises(ValueError):
        runner.pace_of({"PLATFORM_SCALE": "huge"})
    clock = iter([0.0, 1.0, 5.0, 5.0]).__next__
    loads = []
    side = runner.SideInput(lambda: loads.append(1) or spark.range(1), 3, clock)
    [side.get() for _ in range(3)]
    assert len(loads) == 2
    runs = []
    with pytest.raises(KeyError):
        runner.repeat(lambda: runs.append(1) or (len(runs) == 3 and {}[0]), 0.01)
    assert len(runs) == 3
    # One stream that fails ends the other, which would go on for ever, and its error comes out.
    landing = reference.Landing(str(tmp_path), "t", 2, most=3)
    for i in range(5):
        landing.publish("k", str(i))
    landing.flush()
    assert (landing.delivered, landing.dropped) == (3, 2)
    log, seen = runner.file_log(spark, f"file://{tmp_path}/*.parquet"), []
    endless = runner.start(log, lambda batch, _: seen.extend(r.value for r in batch.collect()), f"file://{tmp_path}/a", runner.Pace("100 milliseconds"))
    failing = runner.start(log, lambda batch, _: {}["missing"], f"file://{tmp_path}/b")
    with pytest.raises(Exception, match="missing"):
        runner.finish(spark, [endless, failing])
    assert not endless.isActive
    spark.streams.resetTerminated()


def test_feed():
    lived, waited, out = iter([0, 1, 1, 3, 3, 103, 200, 201]).__next__, [], []
    texts = iter([OSError(), OSError(), OSError(), [json.dumps(TRADE | {"type": "match"}), '{"type":"heartbeat"}', '{"type":"error","message":"no"}']])

    def connect():
        got = next(texts)
        if isinstance(got, OSError):
            raise got
        return got

    with pytest.raises(reference.FeedError):
        reference.feed(connect, lambda k, v: out.append((k, json.loads(v))), lived, waited.append)
    assert waited == [1, 2, 1] and out == [("BTC-USD", TRADE)]
    pause = reference.waits(8)
    assert [next(pause) for _ in range(5)] == [1, 2, 4, 8, 8]


def test_reference_jobs(spark, tmp_path):
    at = f"file://{tmp_path}"
    t = {n: Table(spark, f"{at}/{n}", *domain.TABLES[n]) for n in domain.TABLES}
    asked = []
    fetch = lambda a, b: asked.append((a, b)) or '{"base":"EUR","rates":{"2026-01-09":{"GBP":0.8}}}'
    for _ in range(2):
        reference.load_rates(t["fx_rates"], fetch, dt.date(2026, 1, 10), dt.date(2025, 1, 1))
    assert asked == [(dt.date(2025, 1, 1), dt.date(2026, 1, 10)), (dt.date(2026, 1, 2), dt.date(2026, 1, 10))] and t["fx_rates"].read().count() == 1
    assert reference.fetch_rates(dt.date(2026, 1, 1), dt.date(2026, 1, 2), get=lambda url: url).endswith("/2026-01-01..2026-01-02?base=EUR")
    listed = spark.createDataFrame([("T", "Company", "Some Name Ltd")], "target_id string, schema string, name string").selectExpr("*", *[f"cast(null AS string) AS {c}" for c in ("aliases", "countries", "program_ids", "sanctions")], *[f"cast(null AS timestamp) AS {c}" for c in ("first_seen", "last_seen", "last_change")])
    now = F.lit("2026-01-01").cast("timestamp")
    with pytest.raises(ValueError):
        reference.load_targets(t["sanctions_targets"], t["sanctions_names"], listed, now)
    reference.load_targets(t["sanctions_targets"], t["sanctions_names"], listed, now, 1)
    assert t["sanctions_names"].read().first().name_norm == "some name"
    # Gold over empty silver tables: nothing is made, nothing is wrong.
    assert gold.build(t, dt.date(2026, 1, 2)).where("NOT passed").count() == 0 and gold.rebuilt_since(t["card_auth_daily"], dt.date(2026, 1, 2)) == gold.BEGINNING


def test_plans(spark):
    assert schedule.first_run(set()) == [("first-run-fx_rates", "fx_rates"), ("first-run-sanctions", "sanctions")]
    made = {"fx_rates", "sanctions_targets"}
    assert schedule.first_run(made) == [("first-run-sanctions", "sanctions")]
    with pytest.raises(ValueError):
        schedule.materialise("gold", {"gold": lambda: 1}, made)
    made.add("sanctions_names")
    assert schedule.first_run(made) == [("first-run-gold", "gold")] and schedule.materialise("gold", {"gold": lambda: 1}, made) == 1 and schedule.first_run(made) == []
    assert schedule.lineage("sanctions_hits") == {"card_auths", "fx_rates", "sanctions_names", "sanctions_targets"}
    c = contracts.CONTRACTS["card_auth_daily"]
    assert set(contracts.CONTRACTS) == set(domain.TABLES) and all(set(k.key) <= set(k.columns()) and set(k.optional) <= set(k.columns()) for k in contracts.CONTRACTS.values())
    assert all(not set(contracts.CONTRACTS[t].columns()) & set(contracts.PERSONAL) for t in ("crypto_ohlcv_1m", "card_auth_daily", "sanctions_hits"))
    rows = spark.createDataFrame([(dt.date(2026, 1, 1), None, "EUR", "pos", 1, 1, 1.0, Decimal(1), Decimal(1), Decimal(1), NOW)] * 2, domain.DAILY)
    assert {tuple(r) for r in c.violations(rows, NOW + dt.timedelta(minutes=71)).collect()} == {("merchant_country is null", 2), ("key is repeated", 1), ("newest row is too old", 1)}
    assert c.violations(rows.limit(1).fillna("GB"), NOW + dt.timedelta(minutes=70)).count() == 0
    for wrong in (rows.drop("auths"), rows.withColumn("auths", F.lit("x")), rows.withColumn("card_token", F.lit("t"))):
        with pytest.raises(ValueError):
            c.violations(wrong)
    days, kept = merge.repair(spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (2, 1, "b")], "k int, at int, day string"), ["k"], "at", "day")
    assert [r.day for r in days.collect()] == ["a"] and list(map(tuple, kept.collect())) == [(1, 1, "a")]
    assert submit.command("streams", "x.py")[:5] == ["spark-submit", "--master", "local[2]", "--driver-memory", "512m"]
    assert submit.lineage_settings("http://a:1", up=lambda _: False) == {} and "spark.extraListeners" in submit.lineage_settings("http://a:1", up=lambda _: True)
