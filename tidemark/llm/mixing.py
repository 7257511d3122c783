"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

The word budget is cut into equal blocks. Highest quotients (weight / 1, 3, 5, ...) deal the blocks to the
sources and, within a source, to its shards by their sizes, which gives whole-number quotas. A shard is a
hashed share of a source's documents, laid end to end in a seeded order; its quota is met by whole passes over
that stream plus a seeded systematic choice of its blocks. No block is ever a row: the words a document gives
follow from where it starts and ends.

At scale: one narrow pass over the texts, then only (id, source, size) moves. A hot source is spread over up to
`max_shards` shards; the quotient tables have a row or two for each source or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import WORD, n_words, small, staged, table

WEIGHTS = (5, 2, 1)
BLOCK = 64
SHARD_DOCS = 128
MAX_SHARDS = 1 << 17
MAX_REPEATS = 3
SEED = 17


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, n_docs) with `sid` (1.. by code point, null last) and `target`.

    A target is weight times a common level, and at most max_repeats times the source's size. Sorted by the
    level at which a source is full, the full sources are a prefix, so running sums find the level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    cap = max_repeats * F.col("source_size")
    filling = Window.orderBy(F.col("full_at"), F.col("sid"))
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sizes.withColumn("sid", F.row_number().over(by_name))
        .withColumn("weight", w)
        .withColumn("full_at", cap / F.col("weight"))
        .withColumn("spent", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("spent")) / F.sum("weight").over(after))
        .withColumn("full", F.col("full_at") <= F.col("level"))
        .withColumn("common", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("full"), cap.cast("double")).otherwise(F.col("common") * F.col("weight")))
        .select("source", "source_size", "n_docs", "sid", "target")
    )


def apportion(df: DataFrame, votes: str, seats: Column, name: str, tie: str, by: tuple[str, ...] = ()) -> DataFrame:
    """`df` with a column `name`: its share of `seats` (the same for all rows of a group `by`) by highest
    quotients votes / (2s + 1), ties to the lower `tie`.

    The divisor method keeps every row within seats +- n/2 of its proportional share over n rows, so only the
    quotients in that band are ranked: about three a row, however many seats there are.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    total, n = F.sum(votes).over(group), F.count(F.lit(1)).over(group)
    part = lambda k: F.coalesce(F.try_divide(F.col(votes) * k, F.col("_total")), F.lit(0.0))
    banded = (
        df.withColumn("_seats", seats.cast("long"))
        .withColumn("_total", total)
        .withColumn("_n", n)
        .withColumn("_lo", F.greatest(F.lit(0), F.floor(part(F.col("_seats") - F.col("_n") / 2)) - 1).cast("long"))
        .withColumn("_hi", F.greatest(F.col("_lo"), F.ceil(part(F.col("_seats") + F.col("_n") / 2)).cast("long") + 1))
        .withColumn("_open", F.col("_seats") - F.sum("_lo").over(group))
    )
    ranked = Window.partitionBy(*(by or (F.lit(0),))).orderBy(F.desc("_q"), F.asc(tie))
    keys = [*by, tie]
    won = (
        banded.where("_hi > _lo")
        .select(*keys, "_open", votes, F.explode(F.expr("sequence(_lo, _hi - 1)")).alias("_s"))
        .withColumn("_q", F.col(votes) / (2 * F.col("_s") + 1))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= F.col("_open"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    return (
        banded.join(won, keys, "left")
        .withColumn(name, F.col("_lo") + F.coalesce(F.col("_won"), F.lit(0)))
        .drop("_seats", "_total", "_n", "_lo", "_hi", "_open", "_won")
    )


def mix(docs: DataFrame, seed: int = SEED, block: int = BLOCK, keep: bool = False, weights=WEIGHTS) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) for each row of `docs` (doc_id, text, source), and
    with keep=True the whole row as a struct `row`.

    `size` counts words, `taken` those that the mix takes, at most MAX_REPEATS times the size. A null or empty
    text has size 0 and gives nothing; null is a source of its own, the last; a null doc_id is hashed like an
    empty one; repeated rows are separate documents; an empty table gives an empty one.
    """
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(seed)))), 1, 15), 16, 10)
    base = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), key.cast("long").alias("key"),
        *([F.struct(*docs.columns).alias("row")] if keep else []),
    )
    narrow = staged(base.drop("row"), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    blocks = F.round(F.sum("source_size").over(Window.partitionBy(F.lit(0))) / block)
    targets = source_targets(sizes, weights)
    sources = staged(
        apportion(targets, "target", blocks, "quota", "sid").withColumn(
            "shards", F.least(F.lit(MAX_SHARDS), F.ceil(F.col("n_docs") / SHARD_DOCS)).cast("long")
        ),
        "mix-sources",
    )

    def placed(df: DataFrame) -> DataFrame:
        s = small(sources).withColumnRenamed("source", "_source")
        return df.join(s, df["source"].eqNullSafe(s["_source"])).withColumn("shard", F.col("key") % F.col("shards"))

    shards = placed(narrow).groupBy("sid", "shard", "quota").agg(F.sum("size").alias("shard_size"))
    shards = apportion(shards.withColumn("votes", F.col("shard_size").cast("double")), "votes", F.col("quota"), "blocks", "shard", ("sid",))
    plan = (
        shards.withColumn("words", F.least(F.col("blocks") * block, F.col("shard_size") * MAX_REPEATS))
        .withColumn("passes", F.coalesce(F.expr("try_divide(words, shard_size)"), F.lit(0)).cast("long"))
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("shard_size"))
        .withColumn("whole", F.expr(f"shard_size div {block}"))
        .withColumn("chosen", F.expr(f"rest div {block}"))
        .withColumn("tail", F.col("rest") - F.col("chosen") * block)
        .withColumn("offset", F.when(F.col("whole") > 0, F.expr(f"(shard * 7919 + sid * 104729 + {seed}) % whole")).otherwise(F.lit(0)))
        .select("sid", "shard", "passes", "whole", "chosen", "tail", "offset")
    )
    stream = Window.partitionBy("sid", "shard").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed(base if keep else narrow).withColumn("end", F.sum("size").over(stream))

    def before(x: str) -> str:
        """Words of the stream's first x that the seeded choice takes: j whole blocks, then a part of one."""
        j = f"least(({x}) div {block}, whole)"
        upto = lambda j: f"coalesce(((({j}) * chosen + offset) div nullif(whole, 0)), 0L)"
        return (
            f"({upto(j)} * {block} + CASE WHEN {j} < whole THEN ({upto(f'{j} + 1')} - {upto(j)}) * (({x}) - {j} * {block}) "
            f"ELSE least(({x}) - whole * {block}, tail) END)"
        )

    taken = F.expr(f"passes * size + {before('end')} - {before('end - size')}")
    return rows.join(plan, ["sid", "shard"]).select(
        "doc_id", "size", "source", "source_size", "target", taken.cast("long").alias("taken"), *(["row"] if keep else [])
    )


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def keep_mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it does: a document of which `taken` words are
    taken comes `taken div size` times, and once more with the remaining share as its seeded chance. Documents
    without words have nothing to take and go."""
    mixed = mix(docs, seed=seed, keep=True)
    more = F.pmod(F.xxhash64(F.col("doc_id"), F.col("size"), F.lit(seed)), F.col("size")) < F.expr("taken % size")
    times = F.when(F.col("size") > 0, F.expr("taken div size") + F.when(more, 1).otherwise(0)).otherwise(0)
    copies = mixed.withColumn("times", times.cast("int")).where("times > 0")
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


#: The same mix in DuckDB's SQL.
OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, '{SEED}')), 1, 15))::BIGINT AS key
  FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
             row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][((sid - 1) % {len(WEIGHTS)} + 1)::INT] AS weight FROM a),
f AS (SELECT *, sum(source_size) OVER () AS total,
             ((sum(source_size) OVER ())::DOUBLE
              - coalesce(sum({MAX_REPEATS} * source_size) OVER (ORDER BY {MAX_REPEATS} * source_size / weight, sid
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
             / (sum(weight) OVER (ORDER BY {MAX_REPEATS} * source_size / weight, sid
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
g AS (SELECT *, {MAX_REPEATS} * source_size / weight <= level AS is_full FROM f),
t AS (SELECT source, source_size, n_docs, sid, round(total::DOUBLE / {BLOCK})::BIGINT AS seats,
             CASE WHEN is_full THEN ({MAX_REPEATS} * source_size)::DOUBLE
                  ELSE (max(level) FILTER (WHERE NOT is_full) OVER ()) * weight END AS target FROM g),
tq AS (SELECT sid, count(*) AS quota FROM (
         SELECT sid, row_number() OVER (ORDER BY target / (2 * s + 1) DESC, sid) AS r, seats
         FROM (SELECT sid, target, seats, unnest(range(0, ceil(target / (SELECT sum(target) FROM t) * seats)::BIGINT + 40)) AS s
               FROM t WHERE target > 0)) WHERE r <= seats GROUP BY sid),
src AS (SELECT t.*, coalesce(quota, 0) AS quota, least({MAX_SHARDS}, ceil(n_docs / {SHARD_DOCS}))::BIGINT AS shards
        FROM t LEFT JOIN tq USING (sid)),
p AS (SELECT d.*, src.sid, src.source_size, src.target, src.quota, d.key % src.shards AS shard
      FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source),
sh AS (SELECT sid, shard, quota, sum(size)::BIGINT AS shard_size, count(*) OVER (PARTITION BY sid) AS n,
              sum(sum(size)) OVER (PARTITION BY sid) AS total FROM p GROUP BY sid, shard, quota),
sq AS (SELECT sid, shard, count(*) AS blocks FROM (
         SELECT sid, shard, quota, row_number() OVER (PARTITION BY sid ORDER BY shard_size::DOUBLE / (2 * s + 1) DESC, shard) AS r
         FROM (SELECT *, unnest(range(0, ceil(shard_size / total * quota)::BIGINT + n + 2)) AS s FROM sh WHERE shard_size > 0))
       WHERE r <= quota GROUP BY sid, shard),
pl AS (SELECT sh.sid, sh.shard, shard_size, least(coalesce(blocks, 0) * {BLOCK}, shard_size * {MAX_REPEATS}) AS words
       FROM sh LEFT JOIN sq USING (sid, shard)),
pm AS (SELECT *, coalesce(words // nullif(shard_size, 0), 0) AS passes, shard_size // {BLOCK} AS whole FROM pl),
pn AS (SELECT *, (words - passes * shard_size) // {BLOCK} AS chosen,
              (words - passes * shard_size) % {BLOCK} AS tail,
              CASE WHEN whole > 0 THEN (shard * 7919 + sid * 104729 + {SEED}) % whole ELSE 0 END AS o FROM pm),
q AS (SELECT *, sum(size) OVER (PARTITION BY sid, shard ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM p),
r AS (SELECT q.*, passes, whole, chosen, tail, o, [e - size, e] AS ends FROM q JOIN pn USING (sid, shard)),
u AS (SELECT *, list_transform(ends, lambda x:
        CASE WHEN x // {BLOCK} < whole
             THEN ((x // {BLOCK}) * chosen + o) // whole * {BLOCK}
                  + (((x // {BLOCK} + 1) * chosen + o) // whole - ((x // {BLOCK}) * chosen + o) // whole) * (x % {BLOCK})
             ELSE coalesce((whole * chosen + o) // nullif(whole, 0), 0) * {BLOCK} + least(x - whole * {BLOCK}, tail) END) AS fs FROM r)
SELECT doc_id, size, source, source_size, target, (passes * size + fs[2] - fs[1])::BIGINT AS taken FROM u
"""
