"""A quality score: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of whole texts are standardised over the labelled training rows and mapped to cos(xW + b), whose inner
products approximate a Gaussian kernel. Each partition sums its normal equations and the sums are added by row, so
fitting takes all labelled rows and FEATURES^2 numbers, however many rows there are. A quarter of the training rows
is left out of the fit; the share of label 1 in bins of their scores is made monotone (pooling adjacent violators)
and maps a score to 0..1.

Labels are read only of rows whose crc32(doc_id as text) mod 4 is not 2; labels, language, source and id are no inputs.
At scale: one pass over the texts writes about twenty numbers a document; fitting and scoring read those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._hashing import IS_SPACE, pieces, shingles, texts_of, word_hashes
from ._shared import staged, table

FEATURES, WIDTH, RIDGE, SEED, BINS, CUT = 256, 4.0, 1e-3, 11, 400, 0.7
_bytes = lambda s: np.frombuffer(s, np.uint8)
STATISTICS = 15


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of shares and logarithms for each text; zeros for an empty one."""
    out = np.zeros((len(texts), STATISTICS))
    for start, stop in pieces(texts):
        hashes, ends = word_hashes(texts[start:stop])
        first = 0
        for i, end in zip(range(start, stop), ends):
            words, text = hashes[first:end], texts[i]
            first, n = end, int(end - first)
            if not n:
                continue
            c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            chars = max(1, int(c.sum() - c[IS_SPACE].sum()))
            seen = np.unique(words, return_counts=True)[1]
            grams = shingles(words)
            lines = [x for x in text.split(b"\n") if x.strip()]
            share = lambda s: c[_bytes(s)].sum() / chars
            out[i] = (
                np.log1p(n), np.log1p(chars / n), share(b"#*$%&|<>"), c[65:91].sum() / chars, c[48:58].sum() / chars, share(b".,;:"), share(b"!?"),
                share(b"|/\\_=+~^@"), c[128:].sum() / chars, len(seen) / n, seen.max() / n, 1 - len(np.unique(grams)) / len(grams),
                1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))), float(n < 10),
            )
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(texts_of(batch.column("text")))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), STATISTICS).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], ["doc_id", "x"])


class Model:
    """Standardisation, random features, weights and the calibration's steps; plain arrays, so it pickles small."""

    def __init__(self, mean, scale):
        rng = np.random.Generator(np.random.PCG64(SEED))
        self.mean, self.scale = np.asarray(mean), np.where(np.asarray(scale) > 1e-9, scale, 1.0)
        self.w = rng.normal(0, 1 / WIDTH, (STATISTICS, FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.at, self.to = np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5) @ self.w + self.b
        return np.concatenate([np.cos(z) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.to), 0, 1)


def matrix(column, width: int = STATISTICS) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit(rows: DataFrame) -> Model:
    """From rows (x, y, left_out): all others fit the weights, those left out the calibration. Without rows of
    both labels every document scores the same."""
    numbers = [F.col("x")[i] for i in range(STATISTICS)]
    told = rows.agg(*(F.avg(c) for c in numbers), *(F.stddev_pop(c) for c in numbers), F.avg("y"), F.count("y")).first()
    model = Model([v or 0.0 for v in told[:STATISTICS]], [v or 0.0 for v in told[STATISTICS : 2 * STATISTICS]])
    rate, n = told[-2], told[-1]
    if not n or rate in (0.0, 1.0):
        model.weights[-1] = 0.5 if rate is None else rate
        return model
    size = FEATURES + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            f, y = model.features(matrix(batch.column("x"))), batch.column("y").to_numpy()
            total += f.T @ np.column_stack([f, y])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(size), pa.int32()), "v": pa.array([r.tobytes() for r in total], pa.binary())})

    def added(t: pa.Table) -> pa.Table:
        v = sum(np.frombuffer(b) for b in t.column("v").to_pylist())
        return pa.table({"i": pa.array([t.column("i")[0].as_py()], pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})

    parts = rows.where("NOT left_out").select("x", "y").mapInArrow(summed, "i int, v binary")
    sums = np.zeros((size, size + 1))
    for r in parts.groupBy("i").applyInArrow(added, "i int, v binary").collect():
        sums[r[0]] = np.frombuffer(r[1])
    penalty = RIDGE * max(1.0, sums[-1, size - 1]) * np.eye(size)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(sums[:, :size] + penalty, sums[:, size])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(matrix(batch.column("x")))), batch.column("y")], ["s", "y"])

    held = rows.where("left_out").select("x", "y").mapInArrow(scored, "s double, y double")
    bins = F.least(F.greatest(F.floor((F.col("s") + 0.5) * (BINS / 2)), F.lit(0)), F.lit(BINS - 1))
    found = sorted(tuple(r) for r in held.groupBy(bins.alias("bin")).agg(F.avg("s"), F.avg("y"), F.count("y")).collect())
    if len(found) > 1:
        model.at, model.to = isotonic(*(np.array(c, float) for c in list(zip(*found))[1:]))
    return model


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest non-decreasing steps: neighbours that fall are pooled to their mean."""
    steps: list[list[float]] = []
    for a, v, w in zip(at, value, weight):
        steps.append([v, w, a, a])
        while len(steps) > 1 and steps[-2][0] >= steps[-1][0]:
            v2, w2, _, last = steps.pop()
            v1, w1, first, _ = steps.pop()
            steps.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, first, last])
    return np.array([x for s in steps for x in (s[2], s[3])]), np.array([s[0] for s in steps for _ in (0, 1)])


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of `docs`. Null texts score as empty ones; contradictory labels
    of one id are averaged, null ones left out; a null id counts as the empty text for the crc and has no label."""
    x = staged(docs.select("doc_id", "text").mapInArrow(_measured, "doc_id long, x array<double>"), "quality-features")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    x = x.withColumn("held_out", crc % 4 == 2).withColumn("left_out", F.floor(crc / 4) % 4 == 0)
    y = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    model = fit(x.where("NOT held_out").join(y, "doc_id").select("x", "y", "left_out"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    return x.select("doc_id", "held_out", "x").mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def op3_quality_model(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
