"""The pipeline's stages in a row against brute force, on a small corpus with nulls, copies, benchmark passages and repeated ids."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import mixing, token_tables

from test_operators import brute_components, brute_kept


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(11)
    words = [f"w{i}" for i in range(2000)]
    text = lambda n: " ".join(r.choices(words, k=n))
    item = text(25)
    rows = []
    for i in range(200):
        t = text(r.randint(12, 60))
        if i % 10 == 3:
            t = rows[r.randrange(len(rows))][1] or t
        elif i % 10 == 4:
            w = (rows[r.randrange(len(rows))][1] or t).split()
            w[r.randrange(len(w))] = "near"
            t = " ".join(w)
        elif i % 10 == 5:
            t += " " + " ".join(item.split()[3:16])
        elif i % 10 == 6:
            t = "too short"
        elif i % 10 == 7:
            t += " again and again and again and" * 20
        rows.append((i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3 if i % 7 else 0], len(t)))
    rows += [(None, None, "en", "a", 0), (None, text(30), "en", None, 1), (7, text(30), "en", "b", 2), rows[8], (300, "", "de", "b", 0), (301, "long " + text(20_000), "de", "b", 3)]
    labels = [(i, int(i % 10 != 7), 0) for i in range(200)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, labels, item


def brute_stages(rows, labels, item):
    """The rows that quality rules, near duplicates and decontamination leave, stage by stage."""
    kept = brute_kept([x[:3] for x in rows], [x[:2] for x in labels])
    good = [x for i, x in enumerate(rows) if kept[i]]
    # One row of each component: the smallest id, nulls last; equal rows are one. Rows that tie are told apart by the result itself.
    label = [c for _, _, c in brute_components([(i, x[1]) for i, x in enumerate(good)])]
    groups = {}
    for i, x in enumerate(good):
        groups.setdefault(label[i], []).append(x)
    firsts = [[x for x in g if (x[0] is None, x[0] or 0) == min((y[0] is None, y[0] or 0) for y in g)] for g in groups.values()]
    windows = {tuple(item.split()[k : k + 10]) for k in range(len(item.split()) - 9)}
    hit = lambda t: any(tuple(w[k : k + 10]) in windows for w in [t.split()] for k in range(len(w) - 9))
    return good, firsts, hit


def test_stages(spark, corpus):
    at, rows, labels, item = corpus
    good, firsts, hit = brute_stages(rows, labels, item)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], at).cache())
    assert all(s.columns == docs.columns for s in steps[:-1])
    passed, alone, clean, mixed, tokens = ([tuple(r) for r in s.collect()] for s in steps[1:])
    assert Counter(passed) == Counter(good) and len(good) < len(rows)
    assert len(alone) == len(firsts) < len(good) and all(sum((Counter(alone) & Counter(set(f))).values()) == 1 for f in firsts)
    assert Counter(clean) == Counter(x for x in alone if not hit(x[1])) and len(clean) < len(alone)
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= mixing.MAX_REPEATS + 1
    taken = {(r.doc_id, r.source): r for r in mixing.mix(steps[3]).collect()}
    assert all(taken[x[0], x[3]].taken > 0 for x in mixed) and all(r.taken // max(r.size, 1) <= sum(x[0] == k[0] and x[3] == k[1] for x in mixed) for k, r in taken.items())
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_tables.vocabulary())
    ids = {x[1]: [*t.encode(x[1], add_special_tokens=False).ids, 2] for x in mixed}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in steps[-1].collect()) == Counter((x[0], len(ids[x[1]]), zlib.crc32(np.array(ids[x[1]], "<u4").tobytes())) for x in mixed)


def test_run(spark, corpus):
    """run() gives what its stages in a row do, twice the same; tables without rows go through."""
    at, *_ = corpus
    first = corpus_pipeline.run(spark, at).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, corpus_pipeline.run(spark, at).collect())) and len(first) > 100


def test_no_rows(spark, corpus, tmp_path):
    at, *_ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{at}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns(spark, corpus, tmp_path):
    """Columns of the documents may have any names; they come through all stages but the last."""
    at, *_ = corpus
    names = ["row", "q", "_row", "cls", "n", "size", "key", "shard", "taken", "_id", "_hash", "span", "words", "label", "first", "times", "_copy", "stratum", "kept", "end", "sid"]
    docs = spark.read.parquet(f"{at}/documents.parquet").limit(60)
    for i, name in enumerate(names):
        docs = docs.selectExpr("*", f"{i} AS {name}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, at)
        assert after.columns == docs.columns
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, at).count() == docs.count() > 0
