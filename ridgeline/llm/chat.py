"""Collapsing cumulative snapshots of conversations, then rendering.  DataFrame functions only.

A logged conversation that is the beginning of a longer one is a snapshot of it.  Each turn gets
two 64-bit hashes of its place, role and text; their running sums over a conversation's turns are
rolling hashes of its prefixes.  A conversation whose last rolling hash is a proper prefix's hash
of any other is left out by an anti-join; of conversations that are equal throughout, the one
with the smallest id stays.  Only hashes and ids move until the kept turns are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>"


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``n`` (turns of the conversation) and the rolling hashes ``p``, ``q``."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "h", "g")
    hashed = turns.select("conv_id", "turn", "role", F.xxhash64(F.lit(1), "role", F.col("text").isNull(), "text").alias("h"), F.xxhash64(F.lit(2), "text", F.col("role").isNull(), "role").alias("g"))
    placed = hashed.withColumn("place", F.row_number().over(order))
    mixed = lambda c: F.xxhash64("place", c).cast("decimal(20,0)")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        "conv_id", "place", F.count("*").over(Window.partitionBy("conv_id")).alias("n"),
        F.sum(mixed("h")).over(running).alias("p"), F.sum(mixed("g")).over(running).alias("q"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that no other one continues or, with a smaller id, repeats."""
    found = materialize(prefixes(turns))
    # Equal conversations become one, and so do equal prefixes, before they are moved; each key is one row on both sides.
    last = found.where("place = n").groupBy("place", "p", "q").agg(F.min("conv_id").alias("conv_id"))
    proper = found.where("place < n").select("place", "p", "q").distinct()
    return last.join(proper, ["place", "p", "q"], "left_anti").select("conv_id")


def render(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per kept conversation: ``conv_id``, ``n_turns`` (long), ``rendered``.

    Turns go by number, nulls last, ties by role and then text.  A null role is rendered as
    ``unknown`` and a null text as an empty one, though both differ from those in comparisons.
    Texts are rendered as they are, so a text may hold the markers that open and close a turn:
    tokenize rendered conversations turn by turn, or with those markers as plain text, wherever
    texts aren't trusted.  Rows without a conversation id belong to no conversation.  Repeated rows are turns of their
    own.  A conversation is one text in the end, so its turns meet in one row.  An empty table gives an
    empty table; further columns are left behind.
    """
    turns = df.select(df[conv_col].alias("conv_id"), df[turn_col].alias("turn"), df[role_col].alias("role"), df[text_col].alias("text")).where("conv_id is not null")
    kept = turns.join(maximal(turns).withColumnRenamed("conv_id", "kept_id"), F.col("conv_id") == F.col("kept_id"), "left_semi")
    part = F.concat(F.lit(START), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    rows = kept.select("conv_id", F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text", part.alias("part")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda t: t["part"]), "").alias("rendered"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, list(struct_pack(r := role, t := text) ORDER BY turn NULLS LAST, role, text) AS l,
    string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS rendered
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
p AS (SELECT DISTINCT md5(list_slice(l, 1, k)::VARCHAR) AS h, k FROM c, LATERAL (SELECT unnest(range(1, n_turns)) AS k)),
m AS (SELECT min(conv_id) AS conv_id FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = c.n_turns AND p.h = md5(c.l::VARCHAR)) GROUP BY l)
SELECT conv_id, n_turns, rendered FROM c SEMI JOIN m USING (conv_id)
"""
