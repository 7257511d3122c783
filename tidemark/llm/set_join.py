r"""N-gram Jaccard self-join by T-occurrence search, giving the connected components of its links.

A document is the set of its distinct 5-word shingles (64-bit hashes). Equal sets are one class. Two sets of sizes
a, b that link share at least T = ceil(0.8 max(a, b)) shingles, so each holds one of the other's a - T + 1 rarest
ones. That is the split of DivideSkip: the T - 1 most frequent lists can be left out of the merge and only be probed.

1. Frequencies: two fixed-size tables of counters (SLOTS and WORD_SLOTS, whatever the input), over all shingles and all words, order
   shingles: those of unusual counts last, and the others by the product of their words' counts, the rarest words first.
   Any one order gives right results; this one keeps common lines and passages out of the merge, and out of the prefixes what
   unrelated texts share by chance, which a table of shingles alone cannot tell once it has fewer slots than the corpus shingles.
2. Short lists: each class is posted under its rarest shingles. Lists of the same members (near copies share dozens) become
   one that counts as many, before anything is fetched for them. Within a list, pairs whose sizes, places in the order and
   bitmaps allow a link are joined; only a spanning star of each list's joined members leaves the task. Each bit of a bitmap is
   the parity of the shingles that fall on it, so bits that differ are a lower bound on the symmetric difference, however full the
   map is; a larger map folds onto a smaller one. It has a bit for two shingles at least, SHAPE bits at least and MOST_SHAPE at most.
3. Connected pairs make blocks. The sets of a block's members are read from the texts, and within the block each set is
   searched: short lists are merged by counting, candidates are probed for in the long lists by binary search, and those that
   reach the exact overlap are linked.
4. Links are joined to components, labelled with the smallest doc_id.

Lists and blocks beyond CHUNK members are dealt into chunks by hash, and met in two rounds: first each chunk within itself,
which is linear; then chunk against chunk, but only where members are not connected yet. So a large group of near copies
costs in proportion to its size once its chunks connect; only members that stay apart meet pair by pair. No task holds more
than two chunks, and no list of a frequent shingle is numbered in one task.

At scale: the texts are read three times (counters, sets' prefixes, members of blocks) and never shuffled whole: those of
blocks are picked by a Bloom filter of bounded size first (beyond its bound more texts are shuffled than need be). About a fifth
of the shingles is shuffled once. Exact copies never meet each other, near copies only as class representatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._hashing import mix, pieces, shingles, texts_of, word_hashes
from ._row_filter import maybe_in
from ._shared import WORD, fresh, lean, spread_join, staged, table

PERCENT = 80
SLOTS = 1 << 20
SLICES = 64
#: Tasks whose counters meet in one group before the groups do, so that no group's size follows the number of tasks.
TASKS = 256
#: Slots for words: their counters are a fifth of all counters.
WORD_SLOTS = 1 << 18
#: Pairs of sets beyond some 2 MOST_SHAPE shingles all pass the bitmaps, as a filter may only add.
SHAPE, MOST_SHAPE = 1 << 10, 1 << 14
CHUNK = 1024
#: Links that a task holds before it reduces them to a spanning star.
FOLD = 1 << 14


def words_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    for start, stop in pieces(texts):
        hashes, ends = word_hashes(texts[start:stop])
        first = 0
        for end in ends:
            yield hashes[first:end]
            first = end


def sets_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for hashes in words_of(texts):
        yield np.unique(shingles(hashes))


def slots_of(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    return (hashes & np.uint64(slots - 1)).astype(np.int64)


def shape_of(found: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, as words of 64 bits."""
    bits = SHAPE
    while 2 * bits < len(found) and bits < MOST_SHAPE:
        bits *= 2
    return np.packbits(np.bincount(slots_of(found >> np.uint64(40), bits), minlength=bits).astype(np.uint8) & 1).view(np.uint64)


def folded(shape: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of `size` words or twice as many, of the same set, as one of `size` words."""
    return shape if len(shape) == size else shape[:size] ^ shape[size:]


class Shapes:
    """The bitmaps of rows, to be compared pair by pair: those of each size, and those twice as large folded."""

    def __init__(self, shapes: list[np.ndarray]):
        self.sizes, self.of = np.array([len(s) for s in shapes]), {}
        for size in np.unique(self.sizes):
            these = np.flatnonzero((self.sizes == size) | (self.sizes == 2 * size))
            at = np.zeros(len(shapes), np.int64)
            at[these] = np.arange(len(these))
            self.of[size] = at, np.stack([folded(shapes[i], size) for i in these])

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair, the sizes of which are the same or one twice the other, how many bits differ."""
        common, out = np.minimum(self.sizes[a], self.sizes[b]), np.empty(len(a), np.int64)
        for size in np.unique(common):
            at, rows = self.of[size]
            pairs = np.flatnonzero(common == size)
            out[pairs] = np.bitwise_count(rows[at[a[pairs]]] ^ rows[at[b[pairs]]]).sum(axis=1, dtype=np.int64)
        return out


def ranked(hashes: np.ndarray, level: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of a text's word hashes, and the place of each in the order: by its level, then by the sum of its
    words' logarithms. It depends on a shingle's words only, so all texts have one order (equal places are told by hash)."""
    found, at = np.unique(shingles(hashes), return_index=True)
    words = rarity[slots_of(hashes, WORD_SLOTS)].astype(np.uint16)
    k = min(5, len(words))
    sums = sum((words[j : len(words) - k + 1 + j] for j in range(k)), np.zeros(len(words) - k + 1 if k else 0, np.uint16))
    return found, (level[slots_of(found)].astype(np.uint16) << np.uint16(11)) + sums[at]


def class_of(found: np.ndarray) -> int:
    """The key of a set: two sums over its members, mixed."""
    total = np.sum(mix(found ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64, keepdims=True) * np.uint64(0xD1342543DE82EF95)
    return int(mix(total ^ np.sum(found * found, dtype=np.uint64) ^ np.uint64(len(found))).view(np.int64)[0])


def needed(n: int) -> int:
    """The least overlap of a set of n with any set that it links with."""
    return -(-PERCENT * n // 100)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS + WORD_SLOTS, np.int64)
    none = np.empty(0, np.uint64)
    for batch in batches:
        texts = texts_of(batch.column(0))
        for start, stop in pieces(texts, 8 << 20):
            words = [*words_of(texts[start:stop]), none]
            counts[:SLOTS] += np.bincount(slots_of(np.concatenate([np.unique(shingles(w)) for w in words])), minlength=SLOTS)
            counts[SLOTS:] += np.bincount(slots_of(np.concatenate(words), WORD_SLOTS), minlength=WORD_SLOTS)
    if counts.any():
        parts = np.minimum(counts, 2**32 - 1).astype("<u4").reshape(-1, SLOTS // SLICES)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(len(parts)), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())})


def _summed(key: tuple, parts: pa.Table) -> pa.Table:
    total = sum((np.frombuffer(c, "<u4").astype(np.int64) for c in parts.column("counts").to_pylist()), np.zeros(SLOTS // SLICES, np.int64))
    return pa.table({"slice": pa.array([key[-1].as_py()], pa.int32()), "counts": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())})


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """For each slot how many times its shingles exceed twice the usual slot, as a power of two (0: they don't), then for each slot
    of words the logarithm of their count, in sixths of a power of two.
    What comes to the driver is SLOTS and WORD_SLOTS numbers, however large the corpus; tasks' counters are summed TASKS at a time first."""
    parts = docs.select("text").mapInArrow(lean(_counted), "slice int, counts binary").withColumn("some", F.floor(F.spark_partition_id() / TASKS).cast("int"))
    some = parts.groupBy("some", "slice").applyInArrow(_summed, "slice int, counts binary")
    counts = np.zeros(((SLOTS + WORD_SLOTS) * SLICES // SLOTS, SLOTS // SLICES))
    for r in some.groupBy("slice").applyInArrow(_summed, "slice int, counts binary").collect():
        counts[r[0]] = np.frombuffer(r[1], "<u4")
    counts, words = np.split(counts.ravel(), [SLOTS])
    usual = max(4.0, 2 * float(np.median(counts)))
    return np.concatenate([np.ceil(np.log2(np.maximum(counts / usual, 1))), np.rint(6 * np.log2(1 + words))]).astype(np.uint8)


SUMMARY = "doc_id long, row long, cls long, n long, prefix array<long>, usual int, bits binary"


def row_key() -> Column:
    """The key of a row: rows of one id may have different texts, and rows without an id are not one document."""
    return F.xxhash64("doc_id", "text")


def summaries(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """For each row its class, the number of its shingles, its rarest ones (the first `usual` of them in slots of no unusual count)
    and its bitmap."""
    held = docs.sparkSession.sparkContext.broadcast(levels.tobytes())

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, rarity = np.split(np.frombuffer(held.value, np.uint8), [SLOTS])
        for batch in batches:
            texts = texts_of(batch.column("text"))
            keys, sizes, prefixes, usual, bits = [], [], [], [], []
            for hashes in words_of(texts):
                found, places = ranked(hashes, level, rarity)
                n = len(found)
                order = np.argsort(places, kind="stable")
                keys.append(class_of(found))
                sizes.append(n)
                order = order[: n - needed(n) + 1 if n else 0]
                prefixes.append(found[order].view(np.int64))
                usual.append(int(np.count_nonzero(places[order] < 1 << 11)))
                bits.append(shape_of(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(usual, pa.int32()), pa.array(bits, pa.binary())],
                ["doc_id", "row", "cls", "n", "prefix", "usual", "bits"],
            )

    return docs.select("doc_id", "text", row_key().alias("row")).mapInArrow(lean(summarise), SUMMARY)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], size: int) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by `keys`, with about `size` rows (or one group) each."""
    kept: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows < size:
            continue
        whole = pa.concat_tables(kept).combine_chunks()
        last = np.ones(rows, bool)
        for k in keys:
            column = whole.column(k).to_numpy()
            last &= column == column[-1]
        cut = rows - int(last[::-1].argmin()) if not last.all() else 0
        if cut:
            yield whole.slice(0, cut)
            kept, rows = [whole.slice(cut)], rows - cut
        else:
            kept = [whole]
    if rows:
        yield pa.concat_tables(kept).combine_chunks()


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n members' component under the links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], least)
        np.minimum.at(after, label[b], least)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


class Stars:
    """The components of links among n members as the links come, in memory that the number of links doesn't change."""

    def __init__(self, n: int, label: np.ndarray | None = None):
        self.label = np.arange(n) if label is None else label
        self.a, self.b, self.size = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.size += len(a)
        if self.size >= FOLD:
            self.fold()

    def fold(self) -> np.ndarray:
        """The members that are not their component's smallest; `label` has what they are joined to."""
        far = np.flatnonzero(self.label != np.arange(len(self.label)))
        if self.size:
            self.label = stars(len(self.label), np.concatenate([*self.a, far]), np.concatenate([*self.b, self.label[far]]))
            self.a, self.b, self.size = [], [], 0
            far = np.flatnonzero(self.label != np.arange(len(self.label)))
        return far


def first_of(*columns: np.ndarray) -> np.ndarray:
    """For each row the place of the first one with the same values, among rows of one sorted batch."""
    _, which = np.unique(np.stack([c.astype(np.int64) for c in columns]), axis=1, return_inverse=True)
    least = np.full(which.max(initial=-1) + 1, len(which))
    np.minimum.at(least, which.ravel(), np.arange(len(which)))
    return least[which.ravel()]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs in each list that sizes, places and bitmaps allow, as stars: fewer rows than come in, whatever the lists.
    Rows: token, lo, hi, chunk, label, cls, n, rest (the shingles from this one on, in the list where they are most), bits."""
    for t in grouped(batches, ["token", "lo", "hi"], 8192):
        rows = t.num_rows
        token, lo, hi, chunk, label, cls, n, rest = (t.column(c).to_numpy() for c in ("token", "lo", "hi", "chunk", "label", "cls", "n", "rest"))
        bits = Shapes([np.frombuffer(b, np.uint64) for b in t.column("bits").to_pylist()])
        first = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, rows]))
        stop = np.r_[first[1:], rows][group]
        left = np.arange(rows)
        found = Stars(rows, first_of(group, label))
        step = 0
        while len(left):
            step += 1
            left = left[left + step < stop[left]]
            right = left + step
            ok = (lo[left] == hi[left]) | (chunk[left] != chunk[right])
            ok &= 100 * np.minimum(n[left], n[right]) >= PERCENT * np.maximum(n[left], n[right])
            # At the first shingle in common no more are shared than either has from there on.
            ok &= (100 + PERCENT) * np.minimum(rest[left], rest[right]) >= PERCENT * (n[left] + n[right])
            # What is connected already needs no link.
            ok &= found.label[left] != found.label[right]
            a, b = left[ok], right[ok]
            ok = (100 + PERCENT) * bits.apart(a, b) <= (100 - PERCENT) * (n[a] + n[b])
            found.add(a[ok], b[ok])
        if len(far := found.fold()):
            yield pa.RecordBatch.from_pydict({"a": cls[far], "b": cls[found.label[far]]})


def components(edges: DataFrame) -> DataFrame:
    """(id, label): for each node of the links (a, b) the smallest node of its component. Each round takes the least label
    among neighbours and then follows labels once more; rounds are written out, and stop when none changes."""
    both = staged(edges.union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        taken = labels.join(near, labels["id"] == near["a"]).select("id", F.least("label", "near").alias("next"), "label")
        step = staged(taken, "labels-near")
        # What points at a node that is its own label is where it will stay, so only the others are looked up.
        heads = step.where("id <> next").select(F.col("id").alias("head"), F.col("next").alias("top"))
        jumped = step.join(heads, step["next"] == heads["head"], "left").select("id", F.coalesce("top", "next").alias("label"), F.col("label").alias("before"))
        after = staged(jumped, "labels")
        labels = after.select("id", "label")
        if after.where("label <> before").isEmpty():
            return labels


def search(sets: list[np.ndarray], side: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Links (x, all y) among sets, those of one side only with those of the other if sides are given; by DivideSkip.

    For a query of n shingles any link shares T = needed(n) with it or more. Of its lists the L longest are set aside; a
    linked set is in T - L of the others at least. These are merged by counting their members, and the candidates are
    looked for in the long lists by binary search. `sets` come by ascending size, and a query looks at those before it.
    """
    sizes = np.array([len(s) for s in sets])
    tokens, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((owner, which))
    members, ends = owner[order], np.cumsum(np.bincount(which, minlength=len(tokens)))
    starts = np.r_[0, ends[:-1]]
    at = np.r_[0, np.cumsum(sizes)]
    for x in range(1, len(sets)):
        n, own = sizes[x], which[at[x] : at[x + 1]]
        t = needed(n)
        upto = np.array([starts[i] + np.searchsorted(members[starts[i] : ends[i]], x) for i in own])
        lengths = upto - starts[own]
        own, upto, lengths = (c[lengths > 0] for c in (own, upto, lengths))
        if len(own) < t:
            continue
        by_length = np.argsort(lengths, kind="stable")
        aside = min(t - 1, int(t / (0.0085 * np.log2(max(lengths.max(), 2)) + 1)), len(own))
        short, long = by_length[: len(own) - aside], by_length[len(own) - aside :]
        merged = np.concatenate([members[starts[own[i]] : upto[i]] for i in short]) if len(short) else np.empty(0, np.int64)
        counts = np.bincount(merged, minlength=x)
        found = np.flatnonzero((counts >= t - aside) & (counts > 0))
        found = found[100 * sizes[found] >= PERCENT * n]
        if side is not None:
            found = found[side[found] != side[x]]
        for i in long:
            if not len(found):
                break
            listed = members[starts[own[i]] : upto[i]]
            place = np.searchsorted(listed, found)
            counts[found] += (place < len(listed)) & (listed[np.minimum(place, len(listed) - 1)] == found)
        both = counts[found]
        if len(linked := found[100 * both >= PERCENT * (n + sizes[found] - both)]):
            yield x, linked


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each block, chunk or pair of chunks, between members of differing labels.
    Rows: block, lo, hi, label, cls, found."""
    for t in grouped(batches, ["block", "lo", "hi"], 64):
        block, lo, hi, label, cls = (t.column(c).to_numpy() for c in ("block", "lo", "hi", "label", "cls"))
        values = t.column("found").combine_chunks()
        values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
        offsets, flat = values.offsets.to_numpy(), values.values.to_numpy().view(np.uint64)
        first = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        for i, j in zip(first, np.r_[first[1:], len(block)]):
            order = np.lexsort((cls[i:j], np.diff(offsets[i : j + 1]))) + i
            links = Stars(j - i)
            for x, linked in search([flat[offsets[k] : offsets[k + 1]] for k in order], label[order]):
                links.add(np.full(len(linked), x), linked)
            if len(far := links.fold()):
                yield pa.RecordBatch.from_pydict({"a": cls[order[far]], "b": cls[order[links.label[far]]]})


def dealt(members: DataFrame, key: str) -> DataFrame:
    """`members` of keys with two or more, each with the chunk its class falls in and its key's number of chunks (about CHUNK
    members each). Counts are summed before they are shuffled, and the chunks differ from key to key."""
    sizes = members.groupBy(F.col(key).alias("_of")).agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    some = members.join(sizes, members[key] == F.col("_of")).withColumn("chunks", F.expr(f"cast((_size + {CHUNK - 1}) div {CHUNK} AS int)"))
    return some.withColumn("chunk", F.pmod(F.xxhash64("cls", key), "chunks").cast("int")).drop("_of", "_size")


def within(members: DataFrame) -> DataFrame:
    """The first round: each chunk by itself, nothing connected."""
    return members.withColumns({"lo": F.col("chunk"), "hi": F.col("chunk"), "label": F.col("cls")}).drop("chunks")


def across(members: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """The second round: members once for each other chunk of their key, where a key has chunks and is not all connected."""
    more = members.where("chunks > 1").join(labels, members["cls"] == labels["id"], "left").withColumn("label", F.coalesce("label", "cls")).drop("id")
    apart = more.groupBy(F.col(key).alias("_of")).agg(F.min("label").alias("_least"), F.max("label").alias("_most")).where("_least <> _most")
    pairs = more.join(apart.select("_of"), more[key] == F.col("_of")).drop("_of").withColumn("other", F.explode(F.expr("filter(sequence(0, chunks - 1), x -> x <> chunk)")))
    return pairs.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other")).drop("other", "chunks")


def together(df: DataFrame, by: list[str], work: Callable, schema: str) -> DataFrame:
    """`work` over partitions in which rows of one `by` are neighbours."""
    return df.repartition(*by).sortWithinPartitions(*by).mapInArrow(lean(work), schema)


def near_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) of classes whose components hold those of the true links: what lists, sizes and bitmaps allow."""
    def posted(tokens: Column, before: Column) -> DataFrame:
        return classes.select(F.posexplode(tokens).alias("place", "token"), "cls", (F.col("n") - F.col("place") - before).cast("int").alias("rest")).drop("place")

    # Lists of unusually frequent shingles are counted and dealt into chunks. Of the others each is some millionths of all
    # shingles at most, and is counted in the task that it falls in.
    usual = posted(F.slice("prefix", 1, F.col("usual")), F.lit(0))
    usual = usual.withColumns({"_size": F.expr("count(1) OVER (PARTITION BY token)"), "_all": F.expr("bit_xor(xxhash64(cls)) OVER (PARTITION BY token)")}).where("_size > 1")
    # A list of the same members as others goes by their hash. Were two sets of members to have one, the list would join more, which a filter may.
    usual = usual.groupBy(F.xxhash64("_all", "_size").alias("token"), "cls").agg(F.max("rest").alias("rest"), F.max("_size").alias("_size"))
    usual = usual.withColumn("chunks", F.expr(f"cast((_size + {CHUNK - 1}) div {CHUNK} AS int)")).drop("_size").withColumn("chunk", F.pmod(F.xxhash64("cls", "token"), "chunks").cast("int"))
    others = posted(F.slice("prefix", F.col("usual") + 1, F.size("prefix")), F.col("usual"))
    lists = staged(usual.unionByName(dealt(others, "token")), "set-lists")

    def met(members: DataFrame) -> DataFrame:
        carried = members.join(classes.select("cls", "n", "bits"), "cls").select("token", "lo", "hi", "chunk", "label", "cls", "n", "rest", "bits")
        return staged(together(carried, ["token", "lo", "hi"], _joined, "a long, b long").distinct(), "set-near")

    near = met(within(lists))
    if not lists.where("chunks > 1").isEmpty():
        near = near.unionByName(met(across(lists, components(near), "token")))
    return near


def classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The summaries of all rows, and for each class (cls, top, rows): the first row of its component, as a struct
    (without, doc_id, row) in the order of doc_id (nulls last), then row; and how many rows it has."""
    docs = docs.select("doc_id", "text")
    all_rows = staged(summaries(docs, frequency_levels(docs)), "set-summaries")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")).alias("least")
    classes = staged(all_rows.where("n > 0").groupBy("cls").agg(least, F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in ("n", "prefix", "usual", "bits")]), "set-classes")
    blocks = components(near_links(classes))
    members = blocks.join(classes.select("cls", F.col("least.row").alias("row")), blocks["id"] == F.col("cls")).select(F.col("label").alias("block"), "cls", "row")
    members = staged(dealt(members, "block"), "set-members")
    wanted = members.groupBy("row").agg(F.collect_list(F.struct("cls", "block", "chunk", "chunks")).alias("wanted"))
    # Of the texts only those that the filter lets through are shuffled; rows alike are one before they are.
    marked = docs.select("text", row_key().alias("_row"))
    likely = marked.where(maybe_in(marked, "_row", members.select("row"))).distinct()
    texts = likely.join(wanted, F.col("_row") == F.col("row")).select("text", "wanted")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for wanted, one in zip(batch.column("wanted").to_pylist(), sets_of(texts_of(batch.column("text")))):
                key = class_of(one)
                for w in wanted:
                    if w["cls"] == key:
                        rows.append(w)
                        sets.append(one.view(np.int64))
            kinds = {"cls": pa.int64(), "block": pa.int64(), "chunk": pa.int32(), "chunks": pa.int32()}
            yield pa.RecordBatch.from_arrays([*[pa.array([r[c] for r in rows], t) for c, t in kinds.items()], pa.array(sets, pa.list_(pa.int64()))], [*kinds, "found"])

    sets = staged(texts.mapInArrow(lean(found), "cls long, block long, chunk int, chunks int, found array<long>"), "set-found")

    def met(of: DataFrame) -> DataFrame:
        carried = of.select("block", "lo", "hi", "label", "cls", "found")
        return staged(together(carried, ["block", "lo", "hi"], _searched, "a long, b long"), "set-links")

    links = met(within(sets))
    labels = components(links)
    if not members.where("chunks > 1").isEmpty():
        labels = components(links.unionByName(met(across(sets, labels, "block"))))
    # Nodes that link get the first row of their component; the others have their own.
    linked = staged(labels.join(classes.select("cls", "least"), labels["id"] == F.col("cls")).select("cls", "label", "least"), "set-linked")
    tops = staged(linked.groupBy("label").agg(F.min("least").alias("top"), F.count(F.lit(1)).alias("rows")), "set-tops")
    tops = spread_join(linked, tops, "label", "rows").select("cls", "top")
    of_class = classes.select("cls", "least", "rows").join(tops, "cls", "left").select("cls", F.coalesce("top", "least").alias("top"), "rows")
    return all_rows, staged(of_class, "set-components")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs` (doc_id, text).

    A-Z are folded, words are cut at ASCII white space; a text of fewer than five words is one shingle, one without words
    (or null) has none and links with nothing: its component is its own id. Repeated rows and ids are all
    returned; a null id is never a component's smallest unless all are null. No rows give no rows.
    """
    all_rows, of_class = classed(docs)
    return spread_join(all_rows.select("doc_id", "n", "cls"), of_class, "cls", "rows").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("top.doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each component: that of the smallest doc_id (nulls last), then row key. Rows without words
    each stay, repeated or not. It is rows that stay or go: others with the same id, or without one, are not touched. Rows of the
    same id and text are one document; of those the first by their other columns (as JSON) stays. No rows give no rows.

    Only rows that may have to go (by a Bloom filter of bounded size over them) are shuffled; the others pass through."""
    all_rows, of_class = classed(docs)
    placed = spread_join(all_rows.where("n > 0").select("row", "cls"), of_class, "cls", "rows").select("row", (F.col("row") == F.col("top.row")).alias("first"))
    by_row = placed.groupBy("row").agg(F.max("first").alias("stays"), F.count(F.lit(1)).alias("times"))
    doubtful = staged(by_row.where("NOT stays OR times > 1"), "set-doubtful")
    row, go = fresh(docs, "row", "stays")
    marked = docs.withColumn(row, F.when(F.coalesce("text", F.lit("")).rlike(WORD), row_key()))
    maybe = F.coalesce(maybe_in(marked, row, doubtful.select("row")), F.lit(False))
    clear = marked.where(~maybe).select(docs.columns)
    known = doubtful.select(F.col("row").alias(row), F.col("stays").alias(go))
    stay = marked.where(maybe).join(known, row, "left").where(F.coalesce(go, F.lit(True)))
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    if not others:
        return clear.unionByName(stay.dropDuplicates([row, "doc_id", "text"]).select(docs.columns))
    every = F.struct(*[F.col(f"`{c}`") for c in others])
    one = stay.groupBy(row, "doc_id", "text").agg(F.min_by(every, F.to_json(every)).alias(go))
    return clear.unionByName(one.select(*[F.col(c) if c.lower() in ("doc_id", "text") else F.col(go).getField(c).alias(c) for c in docs.columns]))
