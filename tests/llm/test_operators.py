"""The training-data operators against brute force, on small tables with nulls, empty texts, ties and repeated rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, licences, line_dedup, main_text, mixing, quality_model, quality_rules, set_join, token_tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(n=120, seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = [" ".join(r.choices(vocabulary, k=r.randint(1, 80))) for _ in range(n)]
    for i in range(0, n, 5):
        words = out[i].split()
        words[r.randrange(len(words))] = "changed"
        out[(i + 1) % n] = " ".join(words)
    return [*out, None, "", " \n\t ", out[0], out[0], "one", "ÄÖ Straße one", "x" * 50_000 + " y", " ".join(vocabulary * 8)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None, "de"][i % 3], [None, "", "a", "b"][i % 4], 0) for i, t in enumerate(texts())]
    rows += [(3, rows[3][1], "en", "a", 0), (None, "a text without an id", "en", "a", 0), (5, "same id, other text", "en", "a", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).cache()


def same(df, sql, **views):
    con = duckdb.connect()
    for name, view in views.items():
        frame = view.toPandas()
        con.register(name, frame)
        if "doc_id" in frame:
            con.sql(f"CREATE VIEW v_{name} AS SELECT * REPLACE (doc_id::BIGINT AS doc_id) FROM {name}")
            sql = re.sub(rf"\bFROM {name}\b", f"FROM v_{name}", sql)
    columns = ", ".join(sorted(df.columns))
    want = con.sql(f"SELECT {columns} FROM ({sql})").fetchall()
    assert Counter(map(repr, want)) == Counter(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())


def test_mixing(docs, spark):
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    by = defaultdict(lambda: [0, 0])
    for r in rows:
        by[r.source][0] += r.taken
        by[r.source][1] = r.target
    assert abs(sum(t for _, t in by.values()) - sum(r.size for r in rows)) < 1e-6
    assert all(abs(a - t) <= 3 * mixing.BLOCK for a, t in by.values())
    assert mixing.mix(docs.limit(0)).count() == 0
    kept = mixing.keep_mixed(docs.withColumn("size", F.lit("mine")).withColumn("shard", F.lit(1)))
    assert kept.columns == [*docs.columns, "size", "shard"] and kept.where("text IS NULL").count() == 0


def test_apportionment(spark):
    votes = [53, 24, 23, 7, 0, 24]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(votes)], "i int, v double")
    for seats in (0, 1, 7, 40, 333):
        quotients = sorted(((-v / (2 * s + 1), i) for i, v in enumerate(votes) if v for s in range(seats)))[:seats]
        want = Counter(i for _, i in quotients)
        assert {r.i: r.q for r in mixing.apportion(df, "v", F.lit(seats), "q", "i").collect()} == {i: want[i] for i in range(len(votes))}


def brute_quality(text):
    """The contract's counts and the five shares of a text."""
    text = text or ""
    w = WORD.findall(text)
    c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = {j for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    chars, lines = sum(map(len, w)), [x for x in text.split("\n") if WORD.search(x)]
    symbols, dup = sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines))
    import unicodedata

    upper, bangs = sum(unicodedata.category(ch) == "Lu" for ch in text), sum(ch in "!?" for ch in text)
    shares = [symbols / max(chars, 1), upper / max(chars, 1), bangs / max(chars, 1), dup / max(len(lines), 1), len(hit) / max(len(w), 1)]
    return (len(w), chars, symbols, dup, len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)), shares


def brute_kept(docs, labels):
    """{row number: kept} for docs (doc_id, text, lang) by the path and the exact test, with Python's integers and fractions."""
    from fractions import Fraction
    from math import comb

    known, found = {}, [(d, lang or "", *brute_quality(t)) for d, t, lang in docs]
    for d, quality in labels:
        if d is not None and quality is not None:
            known[d] = min(known.get(d, 1), quality)
    bins = lambda x: [min(int(v * quality_rules.BINS), quality_rules.BINS) for v in x]
    rows = defaultdict(list)
    for d, s, counts, shares in found:
        if d in known and not counts[5]:
            rows[s, zlib.crc32(str(d).encode()) % 2, known[d] > 0].append(bins(shares))
    strata = {s for s, half, _ in rows if half}
    strata &= {s for s, half, _ in rows if not half}
    over = lambda xs, cut: sum(any(c is not None and a >= c for a, c in zip(x, cut)) for x in xs)
    chosen = {}
    for s in strata:
        good, bad = rows[s, 0, True], rows[s, 0, False]
        steps = []
        for f in quality_rules.STEPS:
            cut = []
            for r in range(5):
                options = []
                for b in {x[r] for x in good + bad} - {0}:
                    g = sum(x[r] >= b for x in good)
                    gain = sum(x[r] >= b for x in bad) - quality_rules.COST * g
                    if g <= f * len(good) and gain > 0:
                        options.append((gain, b))
                cut.append(max(options)[1] if options else None)
            steps.append(cut)
        good, bad = rows[s, 1, True], rows[s, 1, False]
        n, p, level, most = len(good), Fraction(1, 20), Fraction(1, 20) / len(strata), 0
        for cut in steps:
            k = over(good, cut)
            if sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) > level:
                break
            if (now := over(bad, cut) - quality_rules.COST * k) > most:
                chosen[s], most = cut, now
    return {i: not c[5] and not (s in chosen and over([bins(x)], chosen[s])) for i, (d, s, c, x) in enumerate(found)}


def test_quality_rules(docs, spark):
    labels = [(i, int(i % 3 > 0), 0) for i in range(100)] + [(None, 1, 0), (4, None, 0)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    # A column of the rows may be called what the operator's own columns are.
    clash = docs.withColumns({"q": F.lit(1), "_q": F.lit("x"), "stratum": F.lit(None).cast("string"), "row": F.lit(2), "kept": F.lit("?"), "cuts": F.lit(0)})
    found = quality_rules.decided(clash, frame).collect()
    want = brute_kept([(r.row.doc_id, r.row.text, r.row.lang) for r in found], [x[:2] for x in labels])
    assert len(found) == docs.count() and found[0].row.asDict().keys() == set(clash.columns)
    for i, r in enumerate(found):
        counts, shares = brute_quality(r.row.text)
        assert tuple(r.q)[:6] == counts and np.allclose(r.q.shares, shares) and r.kept == want[i]
    assert quality_rules.decided(docs.limit(0), frame).count() == 0
    assert quality_rules.decided(docs, frame.limit(0)).where("kept = q.base_failed").count() == 0


def test_quality_rules_verdicts(spark):
    """Labels that certify cut-offs in some strata and not in others, against brute force."""
    r = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        lang = r.choice(["en", "en", "de", "fr", None])
        junk = r.random() < (0.02 if lang == "fr" else 0.15)
        words = [f"w{r.randrange(5000)}" for _ in range(r.randint(12, 30))] + (["###", "$$$"] * r.randint(1, 4) if junk else ["#"] * (r.random() < 0.03)) + ["Upper"] * r.randint(0, 3)
        rows.append((i, " ".join(words), lang))
        if lang != "de" or r.random() < 0.2:
            labels.append((i, int(not junk)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {x.doc_id: x.kept for x in quality_rules.decided(frame, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}
    want = brute_kept(rows, labels)
    assert got == want
    assert sum(not want[i] for i, _, lang in rows if lang == "en") > 20 and all(want[i] for i, t, lang in rows if lang == "de" and not brute_quality(t)[0][5])


def test_binomial_bound(spark):
    from math import comb

    for n, p, level in ((50, 0.05, 0.2), (400, 0.01, 0.05), (1000, 0.02, 0.01), (10, 0.01, 0.01)):
        cdf, k = 0.0, -1
        for j in range(n + 1):
            cdf += comb(n, j) * p**j * (1 - p) ** (n - j)
            if cdf > level:
                break
            k = j
        assert spark.range(1).select(quality_rules.allowed(F.lit(n).cast("long"), p, F.lit(level)).alias("k")).first().k == k


def test_certified_cutoffs_reject(spark):
    clean, junk = "plain words that go on and on about many different things here " , "### b$$ &&& d%%% e*** f||| g<<< h>>> i### j$$$ k&&& "
    rows = [(i, (clean if i % 10 else junk) + str(i), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(4000)], "doc_id bigint, quality int")
    kept = quality_rules.decided(docs, labels)
    assert kept.where("kept <> (doc_id % 10 > 0)").count() == 0


def test_decontamination(docs, spark):
    all_texts = texts()
    items = spark.createDataFrame(
        [(1, " ".join((all_texts[10] + " " + all_texts[12]).split()[:25])), (2, "one"), (3, "Straße ONE"), (4, None), (5, ""), (6, all_texts[20]), (7, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (None, "without an id")],
        "item_id bigint, text string",
    )
    found = decontam.hits(docs.withColumn("words", F.lit(1)), items).withColumn("c", F.explode(F.expr("sequence(1L, copies)"))).withColumn("n_hit", decontam.covered(F.col("spans")))
    rows = found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
    same(rows, decontam.OP9_SQL.replace("item_id::VARCHAR", "item_id::BIGINT::VARCHAR"), documents=docs, benchmark=items)
    clash = docs.withColumns({"_id": F.lit(1), "_hash": F.lit("x"), "item": F.lit(0), "span": F.lit(None).cast("int")})
    kept = decontam.keep_clean(clash, items)
    assert kept.columns == clash.columns and kept.count() == rows.where("n_hit = 0").count() < docs.count()
    assert decontam.keep_clean(docs, items.limit(0)).count() == docs.count() and decontam.keep_clean(docs.limit(0), items).count() == 0
    assert decontam.hits(docs, items.limit(0)).where("size(spans) > 0").count() == 0


def brute_components(plain):
    """(doc_id, set size, component) of each (doc_id, text), by comparing all pairs."""
    sets = []
    for _, t in plain:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(plain)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(plain)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(plain):
        least[find(i)].append(d)
    return [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(plain)]


def test_set_join(docs):
    rows = set_join.jaccard_classes(docs.withColumn("cls", F.lit(1))).collect()
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, rows)) == Counter(brute_components(plain))
    assert set_join.jaccard_classes(docs.limit(0)).count() == 0
    kept = set_join.keep_first(docs.where("doc_id <> 5 OR text NOT LIKE 'same%'"))
    assert kept.columns == docs.columns and kept.where("text = 'one'").count() == 1


def test_tokenising_asks_in_bounded_calls():
    """However many words are new at once, the library gets RUNS runs a call, and the ids are those of one call."""

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.most = tokenizer, 0

        def encode_batch_fast(self, texts, **how):
            self.most = max(self.most, len(texts))
            return self.tokenizer.encode_batch_fast(texts, **how)

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

    encoder = token_tables.Encoder(token_tables.vocabulary())
    encoder.tokenizer = Counting(encoder.tokenizer)
    text = " ".join(f"word{i}" for i in range(40_000))
    (ids,) = encoder.encode([text.encode()])
    assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, token_tables.END]
    assert encoder.tokenizer.most <= 16


def test_tokenising_words_of_letters():
    """Words of letters go to the library without the steps before its merges, and get the ids of the whole tokenizer; texts are cut at the same places."""
    rng, known = np.random.default_rng(3), token_tables.Encoder(token_tables.vocabulary())
    letters = [*"abcdefghijklmnopqrstuvwxyz", *map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])]
    made = ["".join(rng.choice(letters, n)) for n in rng.integers(1, 30, 3000)]
    ids, counts = known._encoded([w.encode() for w in made])
    asked = []
    whole, known._encoded = known._encoded, lambda words: asked.extend(words) or whole(words)
    (got,) = known.encode([" ".join(made).encode()])
    assert got.tolist() == [*ids, token_tables.END] and not asked
    odd = [*letters, *"AZÀÖ×÷'.,!<|_-0٣ªµſǆΣςİı́̈nẞ\x01  \t\n\x1c\x85", "'s", "'ll", "<|endoftext|>", "ö", "  "]
    texts = ["".join(rng.choice(odd, n)) for n in rng.integers(0, 60, 2000)]
    want = [[*known.tokenizer.encode(t, add_special_tokens=False).ids, token_tables.END] for t in texts]
    assert [g.tolist() for g in known.encode([t.encode() for t in texts])] == want
    # A tokenizer with other steps is asked as a whole.
    from tokenizers import normalizers

    known.tokenizer.normalizer = normalizers.NFC()
    assert known._of_letters() == (None, None)


def test_set_join_bitmaps():
    """Bits that differ never exceed the symmetric difference, over sizes and folds, and unrelated sets of any length are told apart."""
    r = np.random.default_rng(1)
    for n, m in ((40, 45), (1500, 1500), (2000, 2100), (9000, 8500), (30000, 31000)):
        sets = [np.unique(r.integers(0, 2**63, k, dtype=np.uint64)) for k in (n, m)]
        sets.append(np.unique(np.r_[sets[0][n // 20 :], sets[1][: n // 50]]))
        one, other = np.array([0, 0, 1]), np.array([1, 2, 2])
        found = set_join.Shapes([set_join.shape_of(x) for x in sets]).apart(one, other)
        assert all(f <= len(np.setxor1d(sets[i], sets[j])) for i, j, f in zip(one, other, found))
        allows = [180 * f <= 20 * (len(sets[i]) + len(sets[j])) for i, j, f in zip(one, other, found)]
        assert allows == [False, True, False]


def test_set_join_long_texts_that_share_a_passage(spark):
    """Long texts with a passage in common, but far from alike, are not joined: their pairs grow with the square of their number."""
    r = random.Random(3)
    passage = [" ".join(f"p{i}x{k}" for k in range(60)) for i in range(6)]
    rows = [(i, passage[i % 6] + " " + " ".join(f"w{r.randrange(900)}" for _ in range(2000))) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).cache()
    classes = set_join.summaries(docs, set_join.frequency_levels(docs)).select("cls", "n", "prefix", "usual", "bits").cache()
    tokens = [set(x.prefix) for x in classes.collect()]
    assert sum(len(x & y) > 0 for i, x in enumerate(tokens) for y in tokens[:i]) >= 36
    assert set_join.near_links(classes).count() == 0
    assert all(x.component_id == x.doc_id for x in set_join.jaccard_classes(docs).collect())


def test_set_join_in_chunks(spark, monkeypatch):
    """Lists and blocks over many chunks: near copies of a few texts, sets too long for the bitmap, passages in all texts, and
    chains of copies whose ends don't link."""
    monkeypatch.setattr(set_join, "CHUNK", 4)
    r = random.Random(8)
    some = lambda k: [f"v{r.randrange(4000)}" for _ in range(k)]
    shared = some(30)
    out = []
    for base in (some(60), some(45), some(1800), some(9)):
        for _ in range(25):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 45))):
                w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
            out.append(" ".join(w))
    chain = some(120)
    out += [" ".join(chain[3 * i : 3 * i + 80]) for i in range(12)] + [" ".join(shared + some(r.randint(5, 12))) for _ in range(40)] + [" ".join(shared)] * 3
    r.shuffle(out)
    frame = spark.createDataFrame(list(enumerate(out)), "doc_id bigint, text string").repartition(3)
    want = brute_components(list(enumerate(out)))
    assert Counter(map(tuple, set_join.jaccard_classes(frame).collect())) == Counter(want)
    assert {r.doc_id for r in set_join.keep_first(frame).collect()} == {c for _, _, c in want}


def test_keep_first_keeps_rows(spark):
    """Repeated rows without words each stay; rows of one id and text are one; clashing names do no harm."""
    t = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None, "a", "x"), (1, None, "a", "x"), (None, " ", "b", "x"), (None, " ", "b", "x"), (2, t, "b", "y"), (2, t, "a", "y"), (2, t, "a", "y"), (3, t, "a", "y"), (4, "alone", None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _row string, cls string")
    want = [(1, None, "a", "x")] * 2 + [(None, " ", "b", "x")] * 2 + [(2, t, "a", "y"), (4, "alone", None, None)]
    kept = set_join.keep_first(frame.repartition(3))
    assert kept.columns == frame.columns and Counter(map(tuple, kept.collect())) == Counter(want)
    assert set_join.keep_first(frame.limit(0)).count() == 0


def test_keep_first_by_row(spark):
    alone = lambda k: " ".join(f"k{k}w{i}" for i in range(30))
    near = lambda k: alone(k) + " more"
    # Row 3 has a copy without an id and one under a repeated id; two pairs of near copies have no id, or one and the same.
    rows = [(3, alone(0)), (None, alone(0)), (5, near(0)), (5, alone(1)), (5, alone(1)), (None, alone(2)), (None, near(3)), (None, alone(3)),
            (7, alone(4)), (7, near(4)), (None, alone(4)), (None, alone(5)), (None, None), (8, "")]
    kept = Counter(map(tuple, set_join.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()))
    assert all(kept[r] == 1 for r in ((3, alone(0)), (5, alone(1)), (None, alone(2)), (None, alone(5)), (None, None), (8, "")))
    assert kept[None, alone(3)] + kept[None, near(3)] == 1 and kept[7, alone(4)] + kept[7, near(4)] == 1 and sum(kept.values()) == 8


def test_divide_skip():
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 400, dtype=np.uint64)
    sets = sorted((np.unique(np.concatenate([r.choice(base, int(r.integers(20, 90)), False), base[:40]])) for _ in range(120)), key=len)
    sets += [np.sort(np.append(s[:-1], np.uint64(7))) for s in sets[::3]]
    sets.sort(key=len)
    want = {(x, y) for x in range(len(sets)) for y in range(x) if 100 * (b := len(np.intersect1d(sets[x], sets[y]))) >= 80 * (len(sets[x]) + len(sets[y]) - b)}
    assert {(x, int(y)) for x, ys in set_join.search(sets) for y in ys} == want and want
    side = np.arange(len(sets)) % 2
    assert {(x, int(y)) for x, ys in set_join.search(sets, side) for y in ys} == {(x, y) for x, y in want if side[x] != side[y]}


def test_token_tables(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_tables.vocabulary())
    rows = token_tables.tokenised(docs).orderBy("start").collect()
    plain = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = Counter((d, len(ids := [*t.encode(x, add_special_tokens=False).ids, 2]), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, x in plain)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.start for r in rows] == list(np.cumsum([0, *(r.n_tokens for r in rows)])[:-1])
    ids = [r.doc_id for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert token_tables.tokenised(docs.limit(0)).count() == 0
    odd = ["it's <|endoftext|> A.,b, c.\x01 \x01x I'LL", "é ́a 10.5, naïve,", "..., ,,, ‘a’.", "\xa0x\x85y z."]
    got = list(token_tables.Encoder(token_tables.vocabulary()).encode([o.encode() for o in odd]))
    assert [g.tolist() for g in got] == [[*t.encode(o, add_special_tokens=False).ids, 2] for o in odd]


def test_shard_lookup(tmp_path):
    import pyarrow as pa

    rows = [(None, np.array([9]))] + [(i * 3 - 300, np.arange(i % 50, dtype=np.uint32)) for i in range(5000)] + [(14_697, np.array([1, 2]))]
    with pa.OSFile(str(tmp_path / "s"), "wb") as out:
        token_tables.write_shard(out, rows)
    with pa.OSFile(str(tmp_path / "s"), "rb") as file:
        shard = token_tables.Shard(file)
        assert len(shard.places) > 3 and [(i, v.tolist()) for i, v in shard] == [(i, v.tolist()) for i, v in rows]
        assert shard.get(-300)[0].tolist() == [] and shard.get(1) == [] and len(shard.get(14_697)) == 2 and shard.get(None)[0].tolist() == [9]


def test_main_text(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a>Menu</a></nav><header>Site</header><div class="ad-box">Buy</div>
    <article><header><h1>Head&amp;line</h1></header><p>One <b>bold<br>two</p><p>It's&nbsp;a <script>x="<p>"</script>text<ul><li>first<li>second</ul>
    <form><input>Send</form><section class="comments"><p>Reader</p></section><!-- no --><p><b>Open<br><p>Last</article><aside>Side</aside><footer>&copy;</footer></body></html>"""
    plain = lambda i: f"<body><div>Welcome to our site</div><div><p>Story {i} is here</p></div><div>All rights</div></body>"
    rows = [(0, "http://a.x/1", page), (1, None, None), (2, "http://b.x/2", "text < only & more")] + [(10 + i, f"https://C.x/{i}", plain(i)) for i in range(12)]
    found = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[0] == "Head&line\nOne bold two\nIt's a text\nfirst\nsecond\nOpen\nLast"
    assert found[1] == "" and found[2] == "text < only & more" and found[13] == "Story 3 is here"


def test_main_text_templates_in_articles(spark):
    box = '<div class="bio"><p>Jo writes here</p> <a>Follow</a> <a>Mail</a></div>Share <a>this</a><p>so <b>the</b> end</p>'
    story = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, "http://a.x/", f"<article><p>{story(i)} <b>the</b> end</p>{box}</article>") for i in range(10)]
    # Copies of one article, and near copies, keep what they share; a host's articleless pages count the same subtrees.
    rows += [(20 + i, "http://b.x/", f"<main><p>{story(50)}</p><p>{story(51)}</p></main>") for i in range(10)]
    rows += [(40 + i, "http://c.x/", f"<article><p>{story(60)}</p><p>{story(61)}</p><p>at {i}</p></article>") for i in range(10)]
    rows += [(60 + i, "http://d.x/", f"<article><p>{story(i)}</p><p>Note to all</p></article>" if i % 2 else f"<body><p>{story(i)}</p><p>Note to all</p></body>") for i in range(10)]
    found = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(found[i] == f"{story(i)} the end" for i in range(10))
    assert all(found[20 + i] == f"{story(50)}\n{story(51)}" and found[40 + i] == f"{story(60)}\n{story(61)}\nat {i}" for i in range(10))
    assert all(found[60 + i] == story(i) for i in range(10))


def test_main_text_keeps_shared_lines(spark):
    """A line, heading or list item that 2 in 5 of a host's articles quote stays; a box of its own goes."""
    story = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    quoted = "<h1>Said by many</h1><p>Said by many, they say.</p>loose <b>words</b><ul><li>a point</li><li>point %d</li></ul>"
    page = lambda i: f"<article>{quoted % i if i % 5 < 2 else ''}<p>{story(i)}</p>{'<div><p>By our staff</p></div>' if i % 5 < 2 else ''}</article>"
    # The same line in pages without an article or main is a template there.
    rows = [(i, "http://a.x/", page(i)) for i in range(40)] + [(100 + i, "http://b.x/", f"<body>{'<p>Said by many</p>' if i % 5 < 2 else ''}<p>{story(i)}</p></body>") for i in range(40)]
    rows += [(200 + i, "http://c.x/", f"<main>{'<p>Said by most</p>' if i % 5 < 3 else ''}<p>{story(i)}</p></main>") for i in range(40)]
    found = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(40):
        lines = ["Said by many", "Said by many, they say.", "loose words", "a point", f"point {i}"] if i % 5 < 2 else []
        assert found[i] == "\n".join([*lines, story(i)]) and found[100 + i] == found[200 + i] == story(i)


def test_main_text_counts(spark):
    """The host counts against brute force over the parsed trees, and pages of odd kinds."""
    r = random.Random(2)
    box = ["<div><p>Shared box</p></div>", "<ul><li>One</li><li>Two</li></ul>", "<p>Rare</p>"]
    rows = []
    for i in range(60):
        own = "".join(f"<p>{' '.join(f'u{i}x{k}y{j}' for j in range(9))}</p>" for k in range(3))
        kind = "<article>%s%s</article>" if i % 3 else "<body>%s%s</body>"
        rows.append((i, f"http://h{i % 2}.x/{i}", kind % (own, "".join(b for k, b in enumerate(box) if r.random() < (0.9, 0.5, 0.05)[k]))))
    rows += [(None, None, None), (None, None, None), (70, "http://h0.x/", ""), (71, "http://h9.x/", "<a " * 300_000), (72, "http://h9.x/", "<p>" + "word " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.coalesce(F.regexp_extract("url", "//([^/]*)", 1), F.lit("")))
    seen, total = defaultdict(Counter), Counter()
    for x in pages.collect():
        root = main_text.parse(x.html or "")
        seen[x.host].update(main_text.repeatable([root], main_text.digests(root)))
        total[x.host] += 1
    want = {(h, t) for h, c in seen.items() for t, n in c.items() if n >= 8 and n >= 0.3 * total[h]}
    assert {(x.host, t) for x in main_text.recurring(pages.select("host", "html")).collect() for t in x.templates} == want and len(want) >= 4
    found = main_text.extract(pages).collect()
    texts_of = {x.page_id: x.text for x in found}
    assert len(found) == len(rows) and [x.text for x in found if x.page_id is None] == ["", ""] and texts_of[70] == "" and len(texts_of[72]) == 999_999
    assert all("Shared box" not in texts_of[i] and f"u{i}x2y8" in texts_of[i] for i in range(60)) and any("Rare" in texts_of[i] for i in range(60))
    assert main_text.extract(pages.limit(0)).count() == 0


def test_main_text_takes_linear_time():
    import time

    text = lambda p: "\n".join(main_text.blocks(main_text.content(main_text.parse(p))[0]))
    for page in ("<a " * 300_000, "<b>" * 100_000, "<!" * 500_000, "<p class=\"x" * 90_000, "<p a='<a ''" * 90_000, "<!--" * 200_000, "<script>" * 100_000):
        began = time.time()
        text(page)
        assert time.time() - began < 3, page[:9]
    assert text("<body><p class=it's>One</p><p title=\"a>b\" x='c>d'>Two</p><p data=a=b>3</p>4 < 5 <!-- gone") == "One\nTwo\n3\n4 < 5"


def test_main_text_marked_wrappers():
    def text(page):
        return "\n".join(main_text.blocks(main_text.content(main_text.parse(page))[0]))

    story = "<p>" + "Much text here. " * 5 + "</p>"
    want = " ".join(["Much text here."] * 5)
    for around in ('<div class="layout has-sidebar">%s</div>', '<article class="post has-comments">%s</article>', '<div id="search-page">%s</div>', '<form action="x">%s</form>',
                   '<div class="widget"><article>%s</article></div>', '<div class="social"><main>%s</main></div>', '<div class="related">%s</div>', '<article class="promo">%s</article>', '<div data-id="search">%s</div>'):
        assert text(f"<body>{around % story}<p>x</p><div class='ad'>Buy</div><form>Send</form></body>").startswith(want), around
    assert text("<article><p>One</p></article><div>no</div><section><article class='ads'>Buy</article><article>Two<article>in it</article></article></section>") == "One\nTwo\nin it"
    assert text(f"<article>{story}</article><div id='comments'><article class='entry'>Reader</article></div>") == want
    assert text(f"<body>{story}<div class='wide ad'>Buy</div><form>Send</form></body>") == want


def test_quality_model(docs, spark):
    rows = [(i, ("good words in a row " * 5 if i % 2 else "### $$$ && bad ") + str(i), "en", "s", 0) for i in range(400)]
    d = spark.createDataFrame(rows, docs.schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 400)], "doc_id bigint, quality int")
    found = quality_model.score_documents(d, labels).collect()
    held = [r for r in found if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in found)
    assert quality_model.score_documents(docs.limit(0), labels).count() == 0
    clash = quality_model.score_documents(docs.withColumns({"x": F.lit("a"), "y": F.lit(1), "score": F.lit(2)}), labels)
    assert clash.columns == ["doc_id", "held_out", "score", "predicted"] and clash.count() == docs.count()
    every = quality_model.score_documents(docs, labels.limit(0)).collect()
    assert len(every) == docs.count() and len({r.score for r in every}) == 1
    at, to = quality_model.isotonic(np.arange(5.0), np.array([0, 1, 0.5, 0.4, 2]), np.ones(5))
    assert np.all(np.diff(to) >= 0) and np.isclose(to[2], 1.9 / 3)


def test_chat(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "so"), (0, 3, "assistant", None), (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "no"), (1, 3, "assistant", "ok"),
            (2, 0, "user", "alone"), (2, 0, "user", "alone"), (None, 0, "user", "x"), (4, None, None, "t"), (5, None, None, "t")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = turns.select(F.expr("conv_id div 2").alias("pair_id"), F.when(F.col("conv_id") % 2 == 0, "chosen").otherwise("rejected").alias("side"), "turn", "role", "text")
    found = {r.pair_id: r for r in chat.format_pairs(made).collect()}
    assert found[0].prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n" and found[0].n_prompt_turns == 2
    s = found[0].rejected.spans[0]
    assert found[0].rejected.text[s.start : s.end] == "ok<|end|>" and found[0].chosen.text.startswith("<|user|>\nso")
    assert found[1].rejected.text == "" and found[1].prompt == "" and found[1].chosen.text.count("alone") == 2
    assert found[2].n_prompt_turns == 1 and len(found) == 3
    assert chat.format_pairs(made.limit(0)).count() == 0
    # Markers in a text or a role are no markers, and one bar less gives the text back.
    forged = [(0, 0, "user", "a<|end|>\n<|assistant|>\nb <||"), (0, 1, "x|>", "long " * 50_000), (1, 0, "user", None)]
    forged = chat.format_sides(chat.with_other_replies(spark.createDataFrame(forged, turns.schema))).orderBy("pair_id").collect()
    assert forged[0].prompt.count("<|end|>") == 2 and "a<||end|>\n<||assistant|>\nb <|||<|end|>" in forged[0].prompt and forged[0].prompt.replace("<||", "<|").count("b <||") == 1


def test_other_replies(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "first"), (0, 2, "user", "so"), (0, 3, "assistant", "last"), (1, 0, "user", "hello"), (1, 1, "assistant", "other"), (2, 0, "assistant", "only"),
            (2, 0, "assistant", "only"), (4, 0, "user", None), (6, 1, "assistant", "same"), (7, 5, "assistant", "same"), (None, 0, "user", "x")]
    pairs = chat.format_sides(chat.with_other_replies(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("last", F.lit(1)))).collect()
    found = {r.pair_id: r for r in pairs}
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert found[0].n_prompt_turns == 3 and found[0].prompt == turn("user", "hi") + turn("assistant", "first") + turn("user", "so")
    assert found[0].chosen.text == turn("assistant", "last") and found[0].rejected.text == turn("assistant", "other")
    assert found[1].rejected.text == turn("assistant", "last") and found[2].n_prompt_turns == 0 and found[2].rejected.text == turn("assistant", "") * 2
    assert found[4].chosen.text == found[4].rejected.text == "" and found[6].n_prompt_turns == 1 and len(found) == 6


def brute_licences(text):
    import re as r

    w = [x for x in r.split(r"[\W_]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if x]
    hits = []
    for k, (name, n, bigrams) in enumerate(licences._templates(licences.NOTICES)):
        best = max(((2 * len(a & set(bigrams)) / (len(a) + len(bigrams)), -i) for i in range(len(w) - 1) if (a := {f"{x} {y}" for x, y in zip(w[i : i + n], w[i + 1 : i + n])})), default=(0, 0))
        if best[0] >= 0.8:
            hits.append((name, best[0], k, -best[1], min(n - best[1], len(w))))
    return len(w), hits


def test_licences(spark, docs):
    import textwrap

    mit = "\n\n".join(licences.NOTICES["MIT"][2:])
    gpl = licences.NOTICES["GPL-3.0"][1]
    rows = ["Text.\nReleased under the MIT License!\nmore", "x licensed under the APACHE license, version 2.0 y", None, "", "MIT", "a b c d e f g h i j k l", "Copyright 2020 Someone\n\n" + textwrap.fill(mit, 60),
            "before it " + mit.replace("\n\n", " ") + " and after", "\n".join(f" * {x}" for x in textwrap.wrap(gpl, 50)), gpl.replace("redistribute", "hand").replace("any later", "a later"),
            "Copyright 2020 Someone. Released under the MIT License. All rights reserved.", "the terms of the licence are under the law " * 40, "Licensed under " * 3000, "word " * 60_000 + mit,
            "Permission is hereby granted to go home", licences.BSD + " " + licences.NOTICES["BSD-3-Clause"][2]]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(rows)] + [(0, rows[0], 2)], "doc_id bigint, text string, _t int")
    found = [(r.doc_id, r.n_words, [tuple(h) for h in r.hits]) for r in licences.scan(frame).collect()]
    small = {i: brute_licences(t) for i, t in enumerate(rows) if i not in (12, 13)}
    assert len(found) == len(rows) + 1 and all((n, hits) == small[i] for i, n, hits in found if i in small)
    named = {i: {h[0] for h in hits} for i, _, hits in found}
    assert named[0] == named[6] == named[7] == named[10] == named[13] == {"MIT"} and "GPL-3.0" in named[8] & named[9] and named[1] == {"Apache-2.0"}
    assert not any(named[i] for i in (2, 3, 4, 5, 11, 12, 14)) and named[15] == {"BSD-2-Clause", "BSD-3-Clause"}
    assert all((r.n_words, [tuple(h) for h in r.hits]) == brute_licences(t) for r, t in zip(licences.scan(docs.where("length(text) < 5000")).collect(), [r.text for r in docs.where("length(text) < 5000").collect()]))
    assert licences.scan(docs.limit(0)).count() == 0


def test_line_dedup(spark):
    r = random.Random(5)
    vocabulary = [f"v{i}" for i in range(40)]
    lines = [" ".join(r.choices(vocabulary, k=r.randint(1, 14))) for _ in range(60)]
    for line in lines[:30]:
        w = line.split()
        kind, i = r.randrange(3), r.randrange(len(w))
        lines.append(" ".join(w[:i] + w[i + 1 :] if kind == 0 else w[:i] + ["new"] + w[i + (kind == 1) :]))
    lines += lines[:5]
    r.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 5 : i * 5 + 5]) + "\n \n") for i in range(len(lines) // 5)] + [(90, None), (91, "")]
    # The third is one edit from the second only, though it has a variant in common with the first.
    base = " ".join(f"b{i}" for i in range(9))
    rows += [(92, f"before {base}"), (93, f"{base}\nx\n{base} after"), (94, "long " * 20_000), (95, "long " * 20_001)]
    found = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    places = [(d, n, x.split()) for d, t in rows for n, x in enumerate((t or "").split("\n")) if x.split()]

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < line_dedup.MIN_WORDS or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        s, l = sorted((a, b), key=len)
        return any(l[:i] + l[i + 1 :] == s for i in range(len(l)))

    want = defaultdict(list)
    for k, (d, n, w) in enumerate(places):
        if any(near(w, v) for _, _, v in places[:k]):
            want[d].append(n)
    got = {x.doc_id: list(x.removed) for x in found.collect()}
    assert got == {d: want[d] for d, _ in rows}
    assert want[93] == [0, 2] and want[95] == [0]
    same = [(7, f"{base} end"), (7, f"other {base} end"), (None, f"{base} fin"), (None, None)]
    told = line_dedup.removed_lines(spark.createDataFrame(same, "doc_id bigint, text string")).collect()
    assert {(x.doc_id, x.n_lines, x.n_near) for x in told} == {(7, 2, 1), (None, 1, 0)}
    assert line_dedup.removed_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    clash = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"_id": F.lit(1), "removed": F.lit("r"), "_removed": F.lit(0), "line": F.lit(2)})
    out = line_dedup.without_lines(clash, line_dedup.removed_lines(clash))
    assert out.columns == clash.columns
    assert {r.doc_id: r.text for r in out.collect()} == {d: t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[d]) for d, t in rows}
