"""Preference formatting (DataFrame functions only).

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (same role and text) is
rendered once as the prompt; what follows on each side is a completion, with the character ranges that a loss
should count: the assistant's turns, end marker included. Text can't forge a turn: each "<|" in it gets one more bar, and so does "|>"
in a role, which taking one bar out again undoes. A conversation is gathered by one shuffle, everything after that is done
within a row, so a row has as much as its two conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import let, table

TURN = "<|%s|>\n%s<|end|>\n"


def rendered(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.format_string(TURN, t["role"], t["text"]))


def completion(turns: Column) -> Column:
    """struct(text, spans): the rendered turns, and the ranges [start, end) of the assistant's content."""
    def build(parts: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def add(a: Column, i: Column) -> Column:
            n = F.length(F.get(parts, i))
            head = F.length(F.get(turns, i)["role"]) + F.lit(5)
            own = F.struct((a["at"] + head).cast("int").alias("start"), (a["at"] + n - 1).cast("int").alias("end"))
            mine = F.get(turns, i)["role"] == "assistant"
            return F.struct((a["at"] + n).alias("at"), F.when(mine, F.array_append(a["spans"], own)).otherwise(a["spans"]).alias("spans"))

        spans = F.when(F.size(parts) > 0, F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), first, add)["spans"]).otherwise(first["spans"])
        return F.struct(F.array_join(parts, "").alias("text"), spans.alias("spans"))

    return let(rendered(turns), build)


def turn_of() -> Column:
    """A row (turn, role, text) as a turn: null role and text are empty, markers in them are no markers."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    plain = lambda c: F.replace(c, F.lit("<|"), F.lit("<||"))
    return F.struct("turn", plain(F.replace(role, F.lit("|>"), F.lit("||>"))).alias("role"), plain(text).alias("text"))


def format_sides(pairs: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected) from rows (pair_id, c, r) with the turns of both sides."""
    same = lambda i: (F.get("c", i)["role"] == F.get("r", i)["role"]) & (F.get("c", i)["text"] == F.get("r", i)["text"])
    both = F.least(F.size("c"), F.size("r"))
    prefix = F.when(both > 0, F.aggregate(F.sequence(F.lit(0), both - 1), F.lit(0), lambda a, i: F.when((a == i) & same(i), a + 1).otherwise(a))).otherwise(F.lit(0))
    rest = lambda c: completion(F.slice(c, F.col("n") + 1, F.size(c)))
    return pairs.select("pair_id", "c", "r", prefix.alias("n")).select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"),
        F.array_join(rendered(F.slice("c", F.lit(1), F.col("n"))), "").alias("prompt"),
        rest(F.col("c")).alias("chosen"), rest(F.col("r")).alias("rejected"),
    )


def format_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected) from rows (pair_id, side, turn, role, text), where side
    is 'chosen' or 'rejected'; chosen and rejected are struct(text, spans).

    Turns follow `turn`, then role and text (ties and repeated rows keep a fixed order). A null role or text counts
    as empty. A side without turns gives an empty completion, as does a side that is all prompt; rows with a null
    pair_id or another side belong to no pair and are left out. No rows give no rows.
    """
    side = lambda name: F.sort_array(F.collect_list(F.when(F.col("side") == name, turn_of()))).alias(name[0])
    return format_sides(turns.where("pair_id IS NOT NULL AND side IN ('chosen', 'rejected')").groupBy("pair_id").agg(side("chosen"), side("rejected")))


def with_other_replies(turns: DataFrame) -> DataFrame:
    """(pair_id, c, r) for each conversation (conv_id, turn, role, text): chosen as it is, and rejected with its last reply of the assistant
    (and rows equal to that) exchanged for the last reply in the conversation whose id differs in the lowest bit; an empty one if that has none.
    Rows with a null conv_id are left out."""
    held = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn_of())).alias("c"))
    last = F.get(F.reverse(F.filter("c", lambda t: t["role"] == "assistant")), F.lit(0))
    held = held.withColumn("last", last)
    # Of the other conversation only its last reply is shuffled.
    replies = turns.where("conv_id IS NOT NULL AND role = 'assistant'").groupBy("conv_id").agg(F.max(turn_of()).alias("reply"))
    other = replies.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply.text").alias("other"))
    swapped = F.transform("c", lambda t: F.when(t.eqNullSafe(F.col("last")), t.withField("text", F.coalesce("other", F.lit("")))).otherwise(t))
    return held.join(other, "conv_id", "left").select(F.col("conv_id").alias("pair_id"), "c", swapped.alias("r"))


def op5_preference_pairs(spark, sf_dir: str) -> DataFrame:
    """Each conversation against itself with another last reply: the turns before that are the prompt."""
    spans = lambda c: F.array_join(F.transform(F.col(f"{c}.spans"), lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return format_sides(with_other_replies(table(spark, sf_dir, "conversations"))).select(
        "pair_id", "n_prompt_turns", "prompt",
        F.col("chosen.text").alias("chosen"), spans("chosen").alias("chosen_spans"),
        F.col("rejected.text").alias("rejected"), spans("rejected").alias("rejected_spans"),
    )


OP5_SQL = r"""
WITH b AS (SELECT conv_id AS pair_id, turn, replace(replace(coalesce(role, ''), '|>', '||>'), '<|', '<||') AS role, replace(coalesce(text, ''), '<|', '<||') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT pair_id, turn AS last_turn, text AS last_text FROM b WHERE role = 'assistant' QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC) = 1),
t AS (SELECT pair_id, 0 AS side, turn, role, text, text AS own FROM b
      UNION ALL SELECT b.pair_id, 1, b.turn, b.role, CASE WHEN b.role = 'assistant' AND b.turn = a.last_turn AND b.text = a.last_text THEN coalesce(o.last_text, '') ELSE b.text END, b.text
      FROM b LEFT JOIN a USING (pair_id) LEFT JOIN a o ON o.pair_id = xor(b.pair_id, 1)),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, own) - 1 AS i FROM t),
p AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.i, r.i) AS i, c.role = r.role AND c.text = r.text AS same
      FROM (FROM n WHERE side = 0) c FULL JOIN (FROM n WHERE side = 1) r ON c.pair_id = r.pair_id AND c.i = r.i),
k AS (SELECT pair_id, coalesce(min(i) FILTER (WHERE same IS NOT TRUE), max(i) + 1) AS k FROM p GROUP BY pair_id),
s AS (SELECT n.*, k, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS part FROM n JOIN k USING (pair_id)),
o AS (SELECT *, sum(CASE WHEN i >= k THEN length(part) ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY i) - length(part) AS pos FROM s)
SELECT pair_id, any_value(k)::BIGINT AS n_prompt_turns,
       coalesce(string_agg(part, '' ORDER BY i) FILTER (WHERE side = 0 AND i < k), '') AS prompt,
       coalesce(string_agg(part, '' ORDER BY i) FILTER (WHERE side = 0 AND i >= k), '') AS chosen,
       coalesce(string_agg((pos + length(role) + 5)::BIGINT || '-' || (pos + length(part) - 1)::BIGINT, ',' ORDER BY i) FILTER (WHERE side = 0 AND i >= k AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(part, '' ORDER BY i) FILTER (WHERE side = 1 AND i >= k), '') AS rejected,
       coalesce(string_agg((pos + length(role) + 5)::BIGINT || '-' || (pos + length(part) - 1)::BIGINT, ',' ORDER BY i) FILTER (WHERE side = 1 AND i >= k AND role = 'assistant'), '') AS rejected_spans
FROM o GROUP BY pair_id
"""
