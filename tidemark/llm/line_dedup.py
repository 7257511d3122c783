r"""Line deduplication by a deletion-neighbourhood join.

A line is its words. A line goes if an earlier one, by (doc_id, line number), is equal or, for lines of MIN_WORDS words
and more, differs by one inserted, deleted or replaced word. Only different lines are compared, each at
its first place. A line gives keys: itself, and itself without word i, the latter twice: to meet a line that lacks the
word, and, hashed with length and place, to meet lines with another word there. Lines that share a key in such roles are one
edit apart, so each is joined with the earliest of them only, which is then verified word by word, and no
pairs within a key are needed.

Half of a line is left alone by one edit, so lines whose halves nobody shares emit no variants.

At scale: a line is a 64-bit hash of its words, and its variants come from prefix sums of word hashes, in time that grows with the
line's length only. The texts are read twice, and only texts with a candidate line's first place are shuffled (and the few that a Bloom filter of bounded size
lets through with them). What is broadcast is bounded in rows and bytes. All else
shuffles keys with partial aggregation by minimum, so a line that a third of the documents hold meets in one small row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._hashing import BASE, mix, pieces, texts_of, word_hashes
from ._row_filter import maybe_in
from ._shared import fresh, let, small, staged, table

MIN_WORDS = 8
#: The place of a null doc_id, before all others.
FIRST = -(2**63)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
WHOLE, REPLACED, HEAD, TAIL = (np.uint64(k * 0xA24BAED4963EE407 % 2**64) for k in (1, 2, 3, 4))
LINES = "doc_id long, line int, n int, key long, halves array<long>"
VARIANTS = "key long, doc long, line int, n int, words string, variants array<long>"


def _keyed(kind: np.uint64, hashes: np.ndarray, n: np.ndarray, i: np.ndarray | int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes ^ mix(kind + n.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.asarray(i).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


class Hashed:
    """The word hashes of some lines, from which any run of words is hashed by two sums."""

    def __init__(self, lines: list[bytes]):
        hashes, self.stop = word_hashes(lines, fold=False)
        self.start = np.r_[0, self.stop[:-1]].astype(np.int64)
        self.n = self.stop - self.start
        self.powers = np.r_[np.uint64(1), np.multiply.accumulate(np.full(len(hashes), BASE))]
        self.back = np.r_[np.uint64(1), np.multiply.accumulate(np.full(len(hashes), INVERSE))]
        self.sums = np.r_[np.uint64(0), np.cumsum(hashes * self.powers[:-1], dtype=np.uint64)]
        self.keys = _keyed(WHOLE, self.run(self.start, self.stop), self.n)

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.back[a]

    def halves(self, which: np.ndarray) -> np.ndarray:
        """Four keys for each line: first and last halves, seen as the shorter or the longer of two lines."""
        a, b, n = self.start[which], self.stop[which], self.n[which]
        keys = []
        for m in (n, n - 1):
            h = m // 2
            keys += [_keyed(HEAD, self.run(a, a + h), m), _keyed(TAIL, self.run(b - (m - h), b), m)]
        return np.stack(keys, axis=1)

    def variants(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, keys): for each line its own key, n keys of it without a word, and n with a word replaced."""
        n = self.n[which]
        offsets = np.r_[0, np.cumsum(2 * n + 1)]
        of, first = np.repeat(np.arange(len(which)), n), np.cumsum(n) - n
        i = np.arange(len(of)) - first[of]
        a, b = self.start[which][of], self.stop[which][of]
        without = self.run(a, a + i) + self.run(a + i + 1, b) * self.powers[i]
        out = np.empty(offsets[-1], np.uint64)
        out[offsets[:-1]] = self.keys[which]
        out[offsets[of] + 1 + i] = _keyed(WHOLE, without, n[of] - 1)
        out[offsets[of] + 1 + n[of] + i] = _keyed(REPLACED, without, n[of], i)
        return offsets, out


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, line, n, key, halves) for each line with a word; halves of lines from min_words words on."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch.column("text")), batch.column("doc_id")
            for start, stop in pieces(texts):
                split = [t.split(b"\n") for t in texts[start:stop]]
                counts = np.array([len(x) for x in split])
                found = Hashed([line for x in split for line in x])
                row = np.repeat(np.arange(start, stop), counts)
                line = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                kept = np.flatnonzero(found.n > 0)
                long = found.n[kept] >= min_words
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[kept])), pa.array(line[kept], pa.int32()), pa.array(found.n[kept], pa.int32()), pa.array(found.keys[kept].view(np.int64)),
                     _lists(np.r_[0, np.cumsum(4 * long)], found.halves(kept[long]).ravel())],
                    ["doc_id", "line", "n", "key", "halves"],
                )

    return docs.select("doc_id", "text").mapInArrow(read, LINES)


def variants_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words and variants of the lines `wanted` (key, doc, line), read from the texts at these places."""
    places = wanted.groupBy("doc").agg(F.collect_list(F.struct("line", "key")).alias("places"))
    marked = docs.select(F.coalesce("doc_id", F.lit(FIRST)).alias("doc"), "text").withColumn("hashed", F.xxhash64("doc"))
    # Of the texts only those that the filter lets through are shuffled.
    texts = marked.where(maybe_in(marked, "hashed", wanted.select(F.xxhash64("doc").alias("hashed")))).drop("hashed").join(places, "doc")
    picked = lambda split: F.transform("places", lambda x: F.struct(x["line"].alias("line"), x["key"].alias("key"), F.get(split, x["line"]).alias("text")))
    # Python is sent the lines and not their texts, which bounds its batches.
    lines = texts.select("doc", F.explode_outer(let(F.split("text", "\n"), picked)).alias("x")).select("doc", "x.*").where("key IS NOT NULL")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, doc, line = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc", "line"))
            said = texts_of(batch.column("text"))
            for start, stop in pieces(said):
                found = Hashed(said[start:stop])
                # Rows of one doc_id may have other lines of the same number.
                kept = np.flatnonzero((found.keys.view(np.int64) == key[start:stop]) & (found.n > 0))
                at = kept + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at], pa.int64()), pa.array(doc[at], pa.int64()), pa.array(line[at], pa.int32()), pa.array(found.n[kept], pa.int32()),
                     pa.array([b" ".join(said[k].split()) for k in at], pa.binary()).cast(pa.string()), _lists(*found.variants(kept))],
                    ["key", "doc", "line", "n", "words", "variants"],
                )

    return lines.mapInArrow(read, VARIANTS)


def one_edit(a: Column, b: Column) -> Column:
    """Whether one word edit at most makes the word lists equal: common head and tail leave one word at most."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    run = lambda x, y: F.aggregate(F.sequence(F.lit(0), short), F.lit(0), lambda s, i: F.when((s == i) & (F.get(x, i) == F.get(y, i)), s + 1).otherwise(s))
    return (long - short <= 1) & (run(a, b) + run(F.reverse(a), F.reverse(b)) >= long - 1)


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_equal, n_near, removed) for each different doc_id of `docs` (doc_id, text): the lines with a word,
    how many an earlier equal or near line removes, and their sorted numbers (0 is the text's first line).

    Null and empty texts have no lines. Rows of one doc_id are read as one after another's lines of the same numbers; of equal
    lines at one place the first counts as earliest and all stay. A null doc_id comes first.
    """
    lines = staged(lines_of(docs, min_words), "lines")
    place = F.struct(F.coalesce("doc_id", F.lit(FIRST)).alias("doc_id"), "line")
    kinds = staged(lines.groupBy("key").agg(F.min(place).alias("first"), F.first("halves").alias("halves")), "line-kinds")
    shared = kinds.where(F.size("halves") > 0).select(F.explode_outer("halves").alias("half"), "key")
    partners = shared.groupBy("half").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("half")
    candidates = staged(shared.join(partners, "half", "left_semi").select("key").distinct(), "line-candidates")
    wanted = kinds.join(small(candidates), "key", "left_semi").select("key", F.col("first.doc_id").alias("doc"), F.col("first.line").alias("line"))
    known = staged(variants_of(docs, wanted), "line-variants")
    keyed = known.select("key", "n", F.struct("doc", "line").alias("first"), F.posexplode_outer("variants").alias("i", "variant"))
    # A whole line meets lines that lack nothing but a word of it, and the other way round; replaced meets replaced.
    keyed = keyed.select("variant", "key", "first", F.when(F.col("i") == 0, 0).when(F.col("i") <= F.col("n"), 1).otherwise(2).alias("role"))
    best = lambda role: F.min(F.when(F.col("role") == role, F.struct("first", "key")))
    met = F.min("key") != F.max("key")
    earliest = keyed.groupBy("variant").agg(best(0).alias("whole"), best(1).alias("without"), best(2).alias("replaced"), met.alias("met")).where("met")
    other = F.when(F.col("role") == 0, F.col("without")).when(F.col("role") == 1, F.col("whole")).otherwise(F.col("replaced"))
    pairs = keyed.join(earliest, "variant").select("key", "first", other.alias("other")).where("other.first < first").select("key", F.col("other.key").alias("other")).distinct()
    pairs = small(staged(pairs, "line-pairs"))
    said = F.split("words", " ")
    # The words of a pair are fetched by joins that leave the table of candidates in place while the pairs are few.
    left = staged(known.select("key", said.alias("a"), F.octet_length("words").alias("bytes")).join(pairs, "key"), "line-left")
    left = small(left, wide=F.col("bytes"))
    near = known.select(F.col("key").alias("other"), said.alias("b")).join(left, "other").where(one_edit(F.col("a"), F.col("b"))).select("key").distinct().withColumn("near", F.lit(True))
    told = staged(kinds.select("key", "first").join(near, "key", "left"), "line-fates")
    judged = lines.select("doc_id", "line", "key").join(told, "key").withColumn("equal", F.col("first") < place)
    fate = judged.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("equal").alias("n_equal"), F.count_if(~F.col("equal") & F.col("near")).alias("n_near"),
        F.sort_array(F.collect_list(F.when(F.col("equal") | F.col("near"), F.col("line")))).alias("removed"),
    )
    everyone = docs.select("doc_id").distinct()
    zero = F.lit(0).cast("long")
    joined = everyone.join(fate.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("doc_id", *(F.coalesce(c, zero).alias(c) for c in ("n_lines", "n_equal", "n_near")), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """`docs` with those lines taken out of `text`; rows and columns stay."""
    key, lines = fresh(docs, "id", "removed")
    gone = removed.where(F.size("removed") > 0).select(F.col("doc_id").alias(key), F.col("removed").alias(lines))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone[key]), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(lines), i)), "\n")
    return joined.withColumn("text", F.when(F.col(lines).isNull(), F.col("text")).otherwise(kept)).select(docs.columns)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = removed_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("removed", F.array_join(F.transform("removed", lambda x: x.cast("string")), ","))
