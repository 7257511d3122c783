r"""Quality rules whose cut-offs carry a guarantee (DataFrame functions only).

Each rule rejects a document when a share measured on its whole text reaches a cut-off. In each stratum (language) the labelled
documents are halved by crc32(doc_id as text) mod 2. The half with 0 lays a path: at its step for f every rule's cut-off is the one, of those that reject at
most the share f of that half's good documents, at which the bad ones rejected are most, counting each good one as COST bad ones (none if no cut-off gains; the laxest of equals). So
a later step rejects all that earlier ones do. The other half, the holdout, says how far to go: steps are tried from the laxest on, and one is
certified while an exact binomial test shows that at most RISK of the stratum's good documents are rejected by it, all rules taken together.
Testing stops at the first step that fails (fixed-sequence testing needs no further correction along the path), and the level DELTA is
divided by the number of strata (Bonferroni). So with probability 1 - DELTA, in every stratum at once, the rules reject at most RISK
of the good documents. Of the certified steps the one is used that gains most on the holdout, the laxest of equals. A stratum with too few
labels (under 86 good ones held out for 5 % at four strata) certifies none, and only the base rule rejects there.

At scale: one pass over the texts, everything within a row. The labelled documents' shares are aggregated to histograms of BINS bins a stratum and
rule, and to a row a step, before they are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import let, small, staged, table, words

RISK, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEATED = 10, 20
SYMBOLS = "[#*$%&|<>]"
WORD_CHAR = r"[^\x20\x09-\x0D]"
#: The steps of the path: the share of good documents that each rule may reject.
STEPS = (0.0, 0.0005, 0.001, 0.0025, 0.005, 0.01, 0.02, 0.03, 0.05)
COST, BINS = 5, 1000


def repeated_words(ws: Column) -> Column:
    """Words inside a 5-word window that the text holds twice or more. Windows are compared by 64-bit hash;
    only a text with an equal pair is sorted."""
    at = lambda i: F.get(ws, i)
    hashes = F.transform(F.slice(ws, 1, F.size(ws) - 4), lambda x, i: F.xxhash64(x, at(i + 1), at(i + 2), at(i + 3), at(i + 4)))

    def covered(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))
        )
        starts = let(by_hash, lambda s: F.sort_array(F.transform(twice(s), lambda e: e["i"])))
        own = lambda p: F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5))))
        return F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.aggregate(let(starts, own), F.lit(0), lambda a, x: a + x),
        ).otherwise(F.lit(0))

    return F.when(F.size(ws) >= 5, let(hashes, covered)).otherwise(F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """(row, doc_id, stratum, q) for each row of `docs` (doc_id, text, lang): the row itself as a struct, whatever its columns are called, its
    language ('' for null), and the contract's counts, base_failed and the shares that the rules test.

    A null text counts as empty: no words, and so base_failed. No rows give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    dup = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    # What the character counts look at is cut out in one pass; little of a text is left.
    marks = F.regexp_replace(text, r"[^#*$%&|<>!?\p{Lu}]+", "")
    of_words = lambda ws: F.struct(
        F.size(ws).cast("long").alias("n"),
        F.length(F.array_join(ws, "")).cast("long").alias("chars"),
        repeated_words(ws).cast("long").alias("repeated"),
    )
    counts = F.struct(let(words(text), of_words).alias("words"), dup.alias("lines"), marks.alias("marks"))

    def finish(c: Column) -> Column:
        w, marked = c["words"], lambda pattern: F.regexp_count(c["marks"], F.lit(pattern)).cast("long")
        chars, n = F.greatest(w["chars"], F.lit(1)), F.greatest(w["n"], F.lit(1))
        return F.struct(
            w["n"].alias("n_words"), w["chars"].alias("word_chars"), marked(SYMBOLS).alias("n_symbols"),
            c["lines"]["dup"].cast("long").alias("n_dup_lines"), w["repeated"].alias("n_repeat_words"),
            ((w["n"] < MIN_WORDS) | (100 * w["repeated"] > MAX_REPEATED * w["n"])).alias("base_failed"),
            F.array(
                marked(SYMBOLS) / chars, marked(r"\p{Lu}") / chars, marked("[!?]") / chars,
                c["lines"]["dup"] / F.greatest(c["lines"]["n"], F.lit(1)), w["repeated"] / n,
            ).alias("shares"),
        )

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), let(counts, finish).alias("q"))


RULES = ("symbols", "upper_case", "exclamations", "repeated_lines", "repeated_words")


def allowed(n: Column, risk: float, level: Column) -> Column:
    """The most successes k at which P(Binomial(n, risk) <= k) <= level, or -1: the exact one-sided test
    that the true rate is below `risk`. Terms are summed in logarithms, up to the mean."""
    odds, first = math.log(risk / (1 - risk)), n * math.log1p(-risk)

    def add(a: Column, j: Column) -> Column:
        b = a["p"] + F.log((n - j + 1) / j) + odds
        top = F.greatest(a["c"], b)
        total = top + F.log(F.exp(a["c"] - top) + F.exp(b - top))
        return F.struct(b.alias("p"), total.alias("c"), F.when(total <= F.log(level), j).otherwise(a["k"]).alias("k"))

    start = F.struct(first.alias("p"), first.alias("c"), F.when(first <= F.log(level), 0).otherwise(-1).cast("long").alias("k"))
    upto = F.ceil(n * risk).cast("long")
    return F.when(upto >= 1, F.aggregate(F.sequence(F.lit(1).cast("long"), upto), start, add)["k"]).otherwise(start["k"])


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good): one row a document; contradictory labels count as bad, null ones are left out."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))


def halved(of: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, good, held_out, bins): the labelled documents that pass the base rule, each share as a bin of BINS."""
    bins = F.transform("q.shares", lambda x: F.least(F.floor(x * BINS), F.lit(BINS)).cast("int"))
    known = of.where("NOT q.base_failed").select("doc_id", "stratum", bins.alias("bins")).join(labelled(labels), "doc_id")
    return known.select("stratum", (F.col("good") > 0).alias("good"), (F.crc32(F.col("doc_id").cast("string")) % 2 == 1).alias("held_out"), "bins")


def path(fit: DataFrame, steps=STEPS, cost: float = COST) -> DataFrame:
    """(stratum, cuts): for each step the cut-offs of all rules as bins (null: the rule rejects nothing), from halved() rows."""
    bars = fit.select("stratum", "good", F.posexplode("bins").alias("rule", "bin")).groupBy("stratum", "rule", "bin").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # At most BINS + 1 rows a window, however many documents there are.
    every = Window.partitionBy("stratum", "rule")
    down = every.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    tails = bars.select("stratum", "rule", "bin", F.sum("good").over(down).alias("good"), F.sum("bad").over(down).alias("bad"), F.sum("good").over(every).alias("n"))
    gain = F.col("bad") - cost * F.col("good")
    cut = lambda f: F.max(F.when((F.col("bin") > 0) & (F.col("good") <= f * F.col("n")) & (gain > 0), F.struct(gain.alias("gain"), "bin")))["bin"]
    per_rule = tails.groupBy("stratum", "rule").agg(F.array(*map(cut, steps)).alias("cuts"))
    at = lambda i: F.transform(F.col("rules"), lambda x: F.get(x["cuts"], F.lit(i)))
    by_rule = per_rule.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("rule", "cuts"))).alias("rules"))
    return by_rule.select("stratum", F.array(*[at(i) for i in range(len(steps))]).alias("cuts"))


def rejects(bins: Column, cuts: Column) -> Column:
    """Whether one of the bins reaches its cut-off."""
    return F.coalesce(F.exists(F.arrays_zip(bins.alias("b"), cuts.alias("c")), lambda z: F.coalesce(z["b"] >= z["c"], F.lit(False))), F.lit(False))


def learn_cutoffs(of: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, steps=STEPS, cost: float = COST) -> DataFrame:
    """(stratum, cutoffs, certified): the cut-offs of all rules, as bins, that the labels (doc_id, quality) certify, null where none are, and how
    many steps of the path are. `of` comes from measured()."""
    known = staged(halved(of, labels), "quality-labelled")
    # A path has as many numbers as there are steps and rules; strata are languages.
    paths = staged(path(known.where("NOT held_out"), steps, cost), "quality-paths")
    tried = known.where("held_out").join(small(paths), "stratum").select("stratum", "good", F.size(F.filter("cuts", lambda c: rejects(F.col("bins"), c))).alias("by"))
    bars = tried.groupBy("stratum", "by").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # Stricter steps reject all that laxer ones do, so a document that `by` steps reject falls from step m - by on.
    m = len(steps)
    sums = bars.groupBy("stratum").agg(F.sum("good").alias("n"), *(F.sum(F.when(F.col("by") >= m - i, F.col(c)).otherwise(0)).alias(f"{c}_{i}") for c in ("good", "bad") for i in range(m)))
    tests = sums.agg(F.count(F.lit(1)).alias("strata"))
    limits = sums.crossJoin(F.broadcast(tests)).withColumn("allowed", allowed(F.col("n"), risk, F.lit(delta) / F.col("strata")))
    options = F.array(*(F.struct(F.lit(i).alias("step"), F.col(f"good_{i}").alias("good"), F.col(f"bad_{i}").alias("bad")) for i in range(m)))
    sure = F.filter(options, lambda x: x["good"] <= F.col("allowed"))
    best = F.aggregate(
        sure, F.struct(F.lit(None).cast("int").alias("step"), F.lit(0.0).alias("gain")),
        lambda a, x: F.when(x["bad"] - cost * x["good"] > a["gain"], F.struct(x["step"].alias("step"), (x["bad"] - cost * x["good"]).alias("gain"))).otherwise(a),
    )["step"]
    chosen = limits.select("stratum", best.alias("step"), F.size(sure).alias("certified"))
    return chosen.join(paths, "stratum").select("stratum", F.get("cuts", F.col("step")).alias("cutoffs"), "certified")


def judged(of: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """`of`, from measured(), with `kept`. `cutoffs` (a staged table) is broadcast if its row count allows."""
    joined = of.join(small(cutoffs.select("stratum", "cutoffs")), "stratum", "left")
    bins = F.transform("q.shares", lambda x: F.least(F.floor(x * BINS), F.lit(BINS)).cast("int"))
    return joined.withColumn("kept", ~F.col("q.base_failed") & ~rejects(bins, F.col("cutoffs"))).drop("cutoffs")


def decided(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` measured once, the cut-offs learnt from that, and each row's verdict."""
    of = staged(measured(docs), "quality-measured")
    return judged(of, staged(learn_cutoffs(of, labels), "quality-cutoffs"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    of = measured(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("row")
    of = staged(of, "quality-statistics")
    cutoffs = staged(learn_cutoffs(of, table(spark, sf_dir, "labels")), "quality-cutoffs")
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged(of, cutoffs).select("doc_id", *(f"q.{f}" for f in fields), "kept")


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of `docs` that neither the base rule nor a certified cut-off rejects."""
    return decided(docs, table(spark, sf_dir, "labels")).where("kept").select("row.*")
