"""Preference formatting of chat pairs.

For each pair of a chosen and a rejected conversation the longest common
prefix of turns (same role and text) is rendered once as the prompt; the rest
of either is its completion, with a mask: the [from, to) character ranges of
the completion that are to be learned, namely the texts and end marks of the
assistant's turns.

The two conversations are joined turn by turn (an equi-join on pair and
place), the first difference is a minimum a pair, and only a conversation's
own turns meet in one row, as the rendered text needs. All SQL functions.

Defined results: turns with a null conversation or number take no part; a
null role is ``user``, a null text empty; turns of one number stand in the
order of role and text, repeated rows as repeated turns; equal conversations
are all prompt with empty completions; a missing or null side has no turns;
a pair without turns on either side has empty texts; pairs that repeat an id
are pairs of their own, pairs without an id go; texts of any length are
rendered whole (a conversation meets in one row); extra columns of the turns
are not used, so their names don't matter; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read, stage_table

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    t = conversations.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                             F.coalesce(F.col(f"`{role}`"), F.lit("user")).alias("role"),
                             F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).filter("conv IS NOT NULL AND turn IS NOT NULL")
    return t.withColumn("place", F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text"))).drop("turn")


def format_pairs(conversations: DataFrame, pairs: DataFrame, **names: str) -> DataFrame:
    """(pair_id, chosen_id, rejected_id) → those, prompt_turns, prompt,
    chosen, chosen_mask, rejected, rejected_mask."""
    turns = ordered_turns(conversations, **names)
    given = stage_table(pairs.select("pair_id", "chosen_id", "rejected_id").filter("pair_id IS NOT NULL").withColumn(
        "row", F.monotonically_increasing_id()), "preference-pairs")
    pairs = given.select(F.col("row").alias("pair_id"), "chosen_id", "rejected_id")       # pairs go by their row

    def side(column: str, name: str) -> DataFrame:
        return pairs.select("pair_id", F.col(column).alias("conv")).join(turns, "conv").select(
            "pair_id", "place", F.struct("role", "text").alias(name))
    both = side("chosen_id", "c").join(side("rejected_id", "r"), ["pair_id", "place"], "full")
    apart = F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("place"))).over(Window.partitionBy("pair_id"))
    both = both.withColumn("apart", apart)
    common = F.col("apart").isNull() | (F.col("place") < F.col("apart"))
    part = lambda name, c: F.struct(F.lit(name).alias("part"), F.col(c).alias("said"))
    each = both.select("pair_id", "place", F.explode(F.when(common, F.array(part("prompt", "c"))).otherwise(
        F.array(part("chosen", "c"), part("rejected", "r")))).alias("x")).filter("x.said IS NOT NULL")
    head = F.concat(F.lit(START), F.col("x.said.role"), F.lit("\n"))
    tail = F.concat(F.col("x.said.text"), F.lit(END))
    each = each.select("pair_id", "place", F.col("x.part").alias("part"), F.concat(head, tail, F.lit("\n")).alias("out"),
                       F.length(head).alias("head"), F.length(tail).alias("tail"),
                       (F.col("x.said.role") == LEARNED).alias("learned"))
    before = F.coalesce(F.sum(F.length("out")).over(
        Window.partitionBy("pair_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("at", before + F.col("head"))

    def texts(name: str):
        rows = F.sort_array(F.collect_list(F.when(F.col("part") == name, F.struct("place", "out"))))
        return F.array_join(F.transform(rows, lambda x: x["out"]), "")

    def mask(name: str):
        rows = F.sort_array(F.collect_list(F.when((F.col("part") == name) & F.col("learned"), F.struct(
            F.col("at").alias("from"), (F.col("at") + F.col("tail")).alias("to")))))
        return rows
    made = each.groupBy("pair_id").agg(
        F.count(F.when(F.col("part") == "prompt", 1)).alias("prompt_turns"), texts("prompt").alias("prompt"),
        texts("chosen").alias("chosen"), mask("chosen").alias("chosen_mask"),
        texts("rejected").alias("rejected"), mask("rejected").alias("rejected_mask"))
    out = given.join(made.withColumnRenamed("pair_id", "row"), "row", "left")
    spans = "array<struct<from:bigint,to:bigint>>"
    return out.select(
        "pair_id", "chosen_id", "rejected_id", F.coalesce("prompt_turns", F.lit(0)).alias("prompt_turns"),
        *[F.coalesce(c, F.array().cast(spans)).cast(spans).alias(c) if c.endswith("mask") else F.coalesce(c, F.lit("")).alias(c)
          for c in ("prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")])


def replies_as_pairs(conversations: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """Preferences for a table without any: (conversations, pairs). Chosen is
    a conversation up to its last assistant turn; rejected is the same with
    the last assistant turn of its partner (the id that differs in the last
    bit) in that turn's place. Conversations without an assistant turn make
    no pair; where the partner has none, rejected ends before it."""
    turns = ordered_turns(conversations, **names).withColumn("conv", F.col("conv").cast("bigint"))
    learned = F.col("role") == LEARNED
    upto = turns.withColumn("last", F.max(F.when(learned, F.col("place"))).over(Window.partitionBy("conv"))).filter("place <= last")
    reply = upto.filter("place = last").select("conv", "last", "text")
    partner = F.col("conv").bitwiseXOR(F.lit(1).cast("bigint"))
    pairs = reply.select("conv", "last", partner.alias("other")).join(
        reply.select(F.col("conv").alias("other"), F.col("text")), "other", "left")

    def named(name: str):
        return F.concat(F.col("conv").cast("string"), F.lit(name)).alias("conv_id")
    made = upto.select(named(" chosen"), F.col("place").alias("turn"), "role", "text").unionByName(
        upto.filter("place < last").select(named(" rejected"), F.col("place").alias("turn"), "role", "text")).unionByName(
        pairs.filter("text IS NOT NULL").select(named(" rejected"), F.col("last").alias("turn"), F.lit(LEARNED).alias("role"), "text"))
    return made, pairs.select(F.col("conv").alias("pair_id"), named(" chosen").alias("chosen_id"), named(" rejected").alias("rejected_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every conversation's last reply against its partner's."""
    out = format_pairs(*replies_as_pairs(read(spark, sf_dir, "conversations")))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["from"], s["to"])), ",")
    return out.withColumn("chosen_mask", shown("chosen_mask")).withColumn("rejected_mask", shown("rejected_mask"))


SQL = """
WITH t AS (SELECT conv_id AS conv, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, 'user'), coalesce(text, '')) AS place
           FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
u AS (SELECT *, max(CASE WHEN role = 'assistant' THEN place END) OVER (PARTITION BY conv) AS last FROM t),
l AS (SELECT conv, last, text FROM u WHERE place = last),
p AS (SELECT l.conv AS pair_id, l.last AS last, o.text AS text, l.conv || ' chosen' AS chosen_id, l.conv || ' rejected' AS rejected_id
      FROM l LEFT JOIN l o ON o.conv = xor(l.conv, 1)),
c AS (SELECT conv AS pair_id, place, role, text FROM u WHERE place <= last),
r AS (SELECT conv AS pair_id, place, role, text FROM u WHERE place < last
      UNION ALL SELECT pair_id, last, 'assistant', text FROM p WHERE text IS NOT NULL),
b AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.place, r.place) AS place, c.role AS cr, c.text AS ct, r.role AS rr, r.text AS rt
      FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.place = r.place),
d AS (SELECT *, min(CASE WHEN cr IS DISTINCT FROM rr OR ct IS DISTINCT FROM rt THEN place END) OVER (PARTITION BY pair_id) AS apart FROM b),
e AS (SELECT pair_id, place, 'prompt' AS part, cr AS role, ct AS text FROM d WHERE apart IS NULL OR place < apart
      UNION ALL SELECT pair_id, place, 'chosen', cr, ct FROM d WHERE place >= apart AND cr IS NOT NULL
      UNION ALL SELECT pair_id, place, 'rejected', rr, rt FROM d WHERE place >= apart AND rr IS NOT NULL),
s AS (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS o FROM e),
m AS (SELECT *, coalesce(sum(length(o)) OVER (PARTITION BY pair_id, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                + length(role) + 13 AS a FROM s),
g AS (SELECT pair_id, count(*) FILTER (part = 'prompt') AS prompt_turns,
             string_agg(o, '' ORDER BY place) FILTER (part = 'prompt') AS prompt,
             string_agg(o, '' ORDER BY place) FILTER (part = 'chosen') AS chosen,
             string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(a + length(text) + 10 AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (part = 'chosen' AND role = 'assistant') AS chosen_mask,
             string_agg(o, '' ORDER BY place) FILTER (part = 'rejected') AS rejected,
             string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(a + length(text) + 10 AS BIGINT) AS VARCHAR), ',' ORDER BY place) FILTER (part = 'rejected' AND role = 'assistant') AS rejected_mask
      FROM m GROUP BY pair_id)
SELECT p.pair_id AS pair_id, chosen_id, rejected_id, coalesce(prompt_turns, 0) AS prompt_turns, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen,
       coalesce(chosen_mask, '') AS chosen_mask, coalesce(rejected, '') AS rejected, coalesce(rejected_mask, '') AS rejected_mask
FROM p LEFT JOIN g ON p.pair_id = g.pair_id
"""
