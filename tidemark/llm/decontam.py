r"""Benchmark decontamination by winnowing (DataFrame functions only).

Of every SPAN - k + 1 neighbouring k-gram hashes a text keeps the smallest, the rightmost of equals. The choice
depends on those grams alone, so two texts that share SPAN words keep the same gram inside them: joining the
kept hashes finds every shared span of SPAN words. Each joined pair of places is compared word by word and
extended up to SPAN - k words on both sides; a run of SPAN words or more marks its words. Hash collisions fall
out there. An item with fewer words than SPAN is a window of its own length, winnowed with that length.

At scale: one pass over the documents. The kept hashes (about 2 in 7 words) are exploded, joined and mostly
dropped within a stage, since the benchmark's table is broadcast when its counted rows are within the bound;
beyond it both sides shuffle 8-byte hashes. One marker row a document travels with them and carries the counts, so
the result needs no join back. Rows are grouped by (doc_id, text hash): a repeated id with another text stays apart,
and a repeated row is counted and given back as often as it came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import ascii_lower, fresh, let, small, staged, table

SPAN = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marker rows are spread over this many keys, for the join that shuffles.
MARKERS = 64
LAST = 2147483647


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def gram(span: int) -> int:
    return max(1, span // 2)


def fingerprints(ws: Column, span: int) -> Column:
    """The kept grams of a text: hash in the upper 32 bits, LAST - position in the lower."""
    k = gram(span)
    at = lambda a, i: F.get(a, i)
    grams = F.transform(
        F.slice(ws, 1, F.size(ws) - (k - 1)),
        lambda x, i: F.shiftleft(F.hash(x, *(at(ws, i + j) for j in range(1, k))).cast("long"), 32) + (F.lit(LAST) - i),
    )
    least = lambda g: F.transform(
        F.slice(g, 1, F.size(g) - (span - k)), lambda x, i: F.least(x, *(at(g, i + j) for j in range(1, span - k + 1))) if span > k else x
    )
    return F.when(F.size(ws) >= span, F.array_distinct(let(grams, least))).otherwise(F.array().cast("array<bigint>"))


def context(ws: Column, at: Column, span: int) -> Column:
    """The words around a gram: `left` of them before it (at most span - k), and as many after."""
    room = span - gram(span)
    left = F.least(at, F.lit(room))
    return F.struct(F.slice(ws, at - left + 1, left + span).alias("words"), left.alias("left"))


def _exploded(df: DataFrame, classes: list[int], marker: Column | None = None, own: Column | None = None) -> DataFrame:
    """`df` without its `words`, with a row for each fingerprint: span, h, at, and the words around it. The rows
    carry those few words and not the text, which a long document would multiply by its length."""
    around = "struct<span:int,h:int,at:int,ctx:struct<words:array<string>,left:int>>"

    def of(span: int) -> Column:
        def located(ws: Column) -> Column:
            at = lambda v: (F.lit(LAST) - v.bitwiseAND(F.lit(LAST))).cast("int")
            one = lambda v: F.struct(
                F.lit(span).alias("span"), F.shiftright(v, 32).cast("int").alias("h"), at(v).alias("at"), context(ws, at(v), span).alias("ctx")
            )
            return F.transform(fingerprints(ws, span), one)

        found = let(F.col("words"), located)
        return found if own is None else F.when(own == span, found).otherwise(F.array().cast(f"array<{around}>"))

    parts = [of(s) for s in classes]
    if marker is not None:
        nothing = F.lit(None).cast("struct<words:array<string>,left:int>")
        parts.append(F.array(F.struct(F.lit(0).alias("span"), marker.cast("int").alias("h"), F.lit(0).alias("at"), nothing.alias("ctx"))))
    kept = [c for c in df.columns if c != "words"]
    listed = df.select(*kept, (F.concat(*parts) if len(parts) > 1 else parts[0]).alias("_f"))
    # The outer form: for the inner one Spark infers a filter on the array's size, which would compute it twice.
    return listed.select(*kept, F.explode_outer("_f").alias("_e")).select(*kept, "_e.*")


def benchmark_index(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """The items' fingerprints with their contexts, and the window lengths that occur (at most SPAN of them)."""
    worded = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), tokens(F.col("text")).alias("words"))
    worded = staged(worded.where(F.size("words") > 0).withColumn("own", F.least(F.lit(SPAN), F.size("words"))), "benchmark-words")
    classes = sorted(r[0] for r in worded.select("own").distinct().collect())
    rows = _exploded(worded, classes or [SPAN], own=F.col("own"))
    index = rows.select("span", "h", F.col("ctx").alias("theirs"), "item")
    marks = items.sparkSession.range(MARKERS).select(F.lit(0).alias("span"), F.col("id").cast("int").alias("h"), F.lit(None).cast(index.schema["theirs"].dataType).alias("theirs"), F.lit(None).cast("string").alias("item"))
    return staged(index.where("span IS NOT NULL").distinct().unionByName(marks), "benchmark-index"), classes or [SPAN]


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, copies, n_words, spans, items) for each different (doc_id, text) of `docs`: the sorted
    word ranges [start, end) that occurring windows cover, and the ids of items with such windows.

    Null and empty texts have no words; null item ids count as one item with an empty id.
    """
    index, classes = benchmark_index(items)
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), tokens(F.col("text")).alias("words"))
    read = read.withColumn("n_words", F.size("words").cast("long"))
    rows = _exploded(read, classes, marker=F.pmod("text_hash", F.lit(MARKERS)))
    joined = rows.join(small(index), ["span", "h"])
    def run_of(pair: Column) -> Column:
        """struct(start, end) of the run of equal words around the gram, null if it is too short."""
        same = lambda t: F.get(pair["ours"]["words"], pair["ours"]["left"] + t) == F.get(pair["theirs"]["words"], pair["theirs"]["left"] + t)

        def reach(step: int) -> Column:
            """How many words further the two texts agree, to the left (-1) or the right (+1) of the gram."""
            more = lambda a, t: F.when((a == t - 1) & same(-t if step < 0 else k - 1 + t), t).otherwise(a)
            return F.when(F.col("span") > k, F.aggregate(F.sequence(F.lit(1), F.col("span") - k), F.lit(0), more)).otherwise(F.lit(0))

        ends = let(F.struct(reach(-1).alias("left"), reach(1).alias("right")), lambda r: F.when(
            r["left"] + k + r["right"] >= F.col("span"), F.struct((F.col("at") - r["left"]).alias("start"), (F.col("at") + k + r["right"]).alias("end"))))
        return F.when(F.forall(F.sequence(F.lit(0), k - 1), same), ends)

    k = F.greatest(F.lit(1), F.expr("span div 2").cast("int"))
    pair = F.struct(F.col("ctx").alias("ours"), F.col("theirs").alias("theirs"))
    run = joined.select("doc_id", "text_hash", "n_words", "span", "item", F.when(F.col("span") > 0, let(pair, run_of)).alias("run"))
    found = run.where("span = 0 OR run IS NOT NULL").withColumn("mark", (F.col("span") == 0).cast("int"))
    return found.groupBy("doc_id", "text_hash").agg(
        F.sum("mark").alias("copies"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set("run")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"),
    )


def covered(spans: Column) -> Column:
    """Places inside any of the sorted ranges."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    add = lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["upto"]))).alias("n"), F.greatest(a["upto"], x["end"]).alias("upto")
    )
    return F.aggregate(spans, start, add)["n"]


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hits(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    rows = found.withColumn("_copy", F.explode(F.expr("sequence(1L, copies)"))).withColumn("n_hit", covered(F.col("spans")))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` in which no window of an item occurs; all of them without items, none without rows. What is joined is 16 bytes
    for each contaminated document, broadcast up to a million of these."""
    key, hashed = fresh(docs, "id", "hash")
    bad = staged(hits(docs.select("doc_id", "text"), items).where(F.size("spans") > 0).select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed)), "contaminated")
    return docs.join(small(bad, 1_000_000), docs["doc_id"].eqNullSafe(bad[key]) & (F.xxhash64(docs["text"]) == bad[hashed]), "left_anti")


OP9_SQL = r"""
WITH dw AS (SELECT rowid_ AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)),
iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
         FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
m AS (SELECT r, n, i, item FROM dwin JOIN win USING (n, s)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
