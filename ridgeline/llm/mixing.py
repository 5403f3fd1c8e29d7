"""Mixing sources to target weights on a low-discrepancy schedule.  DataFrame functions only.

Targets fill up like water: each source's share of all words goes by its weight, stops at three
times its size, and what is over is shared again.

The schedule is a row of slots of equal blocks of words, ``BLOCK`` words at least, more as the
cube root of all words.  Slot i takes the van der Corput point of i
(its bits mirrored behind the point) and finds the source whose interval of cumulative target
shares holds it, so that every stretch of the schedule has nearly the target mix.  Slots are
ranked within their source.  A source's documents, shuffled by a hash of their ids, form one
stream of words that starts over for each epoch and is cut into equal blocks; the slot of rank r
takes block r.  What the last whole slot leaves of a target is taken by closing slots.  A copy of a
document begins in the slot that takes its first word, and the mix goes by these slots, so that
every stretch of it has nearly the target mix.

Ranks and positions in a stream are running sums.  They are summed within chunks (of the
schedule, or of the hash's range) and the chunks' totals are summed once more, so no task holds
a whole source, even if a third of all rows is one.  Rows with one id, source and text are counted
before they are moved, and numbered.  A long schedule has chunks of about the root
of its slots, so that neither a chunk nor the row of a source's totals outgrows a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import BROADCAST_ROWS, materialize, word_count, words

#: Words of a block, doubled for each GROWTH bits that the number of all words has beyond GROW_FROM.
BLOCK, GROW_FROM, GROWTH = 64, 26, 3
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Slots that are ranked together, and cells of [0, 1) in which slots look for their source, at least; bits of a point.
CHUNK, CELLS, BITS = 4096, 1024, 48


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``goal`` (target to the nearest
    word), ``below`` (sum of goals before it) and ``total``."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("s"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    ranked = ranked.withColumn("w", weight.cast("long")).withColumn("cap", MAX_EPOCHS * F.col("s"))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("cap").cast("decimal(38,0)") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    filled = (
        ranked.withColumn("words_left", F.sum("s").over(everything) - F.coalesce(F.sum("cap").over(fill), F.lit(0)))
        .withColumn("weight_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(fill), F.lit(0)))
        .withColumn("free", wide("words_left") * wide("w") <= wide("cap") * wide("weight_left"))
    )
    # From the first source that stays below its stop on, all share what is left.
    first = F.min_by(F.when(F.col("free"), F.struct("words_left", "weight_left")), F.when(F.col("free"), F.struct(F.col("cap").cast("decimal(38,0)") / F.col("w"), F.col("rank")))).over(everything)
    found = filled.withColumn("level", first).select(
        "source", "rank", F.col("s").alias("source_size"),
        F.when(F.col("free"), (F.col("level.words_left") * F.col("w")).cast("double") / F.col("level.weight_left").cast("double")).otherwise(F.col("cap").cast("double")).alias("target"),
        F.when(F.col("free"), F.expr("(2 * level.words_left * w + level.weight_left) div (2 * level.weight_left)")).otherwise(F.col("cap")).alias("goal"),
    )
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("goal", F.least("goal", MAX_EPOCHS * F.col("source_size"))).select(
        "source", "source_size", "target", "goal",
        F.coalesce(F.sum("goal").over(before), F.lit(0)).alias("below"), F.sum("goal").over(everything).alias("total"),
    )


def block_words(total: int) -> int:
    """Words of a block in a mix of ``total`` words."""
    return BLOCK << max(0, total.bit_length() - GROW_FROM) // GROWTH


def slots(planned: DataFrame, total: int, block: int) -> DataFrame:
    """The schedule of ``total`` words: ``slot``, ``source``, ``rank`` (from 0 within the source).  Ranks from a source's goal on are void."""
    spark = planned.sparkSession
    n = -(-total // block)
    if n >= 1 << BITS:
        raise ValueError("more slots than points")
    chunk, cells = max(CHUNK, 1 << (n.bit_length() // 2)), max(CELLS, 1 << (n.bit_length() // 2))
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), BITS, "0")), 2, 10).cast("double") / F.lit(float(1 << BITS))
    points = spark.range(n).withColumnRenamed("id", "slot").withColumn("u", point).withColumn("cell", F.floor(F.col("u") * cells))
    shares = planned.where("goal > 0").select(
        "source", (F.col("below") / F.col("total")).alias("from"), ((F.col("below") + F.col("goal")) / F.col("total")).alias("to"))
    shares = shares.withColumn("cell", F.explode(F.sequence(F.floor(F.col("from") * cells), F.least(F.floor(F.col("to") * cells), F.lit(cells - 1)))))
    placed = points.join(shares, "cell").where("u >= from and u < to").select("slot", "source", F.expr(f"slot div {chunk}").alias("chunk"))
    placed = materialize(placed)
    per = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("source", "chunk").agg(F.count("*").alias("n")).select(
        F.col("source").alias("b_source"), F.col("chunk").alias("b_chunk"), F.coalesce(F.sum("n").over(per), F.lit(0)).alias("base"))
    within = placed.withColumn("r", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1)
    joined = within.join(base, within["source"].eqNullSafe(base["b_source"]) & (within["chunk"] == base["b_chunk"]))
    ranked = joined.select("slot", "source", (F.col("base") + F.col("r")).alias("rank"))
    # Closing slots: blocks up to the goal that the schedule doesn't reach.
    had = placed.groupBy("source").agg(F.count("*").alias("had")).select(F.col("source").alias("h_source"), "had")
    short = planned.join(had, planned["source"].eqNullSafe(had["h_source"]), "left").withColumn("had", F.coalesce("had", F.lit(0))).withColumn("need", F.expr(f"(goal + {block - 1}) div {block}"))
    closing = short.where("need > had").select(F.lit(n).alias("slot"), "source", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("rank"))
    return ranked.unionByName(closing)


def streams(groups: DataFrame) -> DataFrame:
    """Adds ``at``, the words before a group of equal rows in its source's shuffled stream."""
    order = Window.partitionBy("source", "bucket").orderBy("shuffle", "doc_id", "size", "mark")
    per = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    width = F.col("size") * F.col("n")
    base = groups.groupBy("source", "bucket").agg(F.sum(width).alias("w")).select(
        F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("w").over(per), F.lit(0)).alias("base"))
    within = groups.withColumn("before", F.sum(width).over(order.rowsBetween(Window.unboundedPreceding, 0)) - width)
    joined = within.join(base, within["source"].eqNullSafe(base["b_source"]) & (within["bucket"] == base["b_bucket"]))
    return joined.select("doc_id", "source", "size", "mark", "n", (F.col("base") + F.col("before")).alias("at"))


def counted(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Rows with one id, source and text as one: ``doc_id``, ``source``, ``size``, ``mark`` (hash of the text), ``shuffle``, ``bucket``, ``n``."""
    digest = F.md5(F.coalesce(df[id_col].cast("string"), df[text_col], F.lit("")))
    rows = df.select(df[id_col].alias("doc_id"), df[source_col].cast("string").alias("source"), word_count(df[text_col]).alias("size"), F.xxhash64(df[text_col]).alias("mark"), digest.alias("shuffle"))
    grouped = rows.groupBy("doc_id", "source", "size", "mark", "shuffle").agg(F.count("*").alias("n"))
    return materialize(grouped.withColumn("bucket", F.substring("shuffle", 1, 3)))


def takes(groups: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int | None = None) -> DataFrame:
    """One row per row: ``doc_id``, ``source``, ``mark``, ``copy`` (its number among equal rows), ``size``,
    ``source_size``, ``target``, and ``taken``, an array of (epoch, words, slot)."""
    planned = materialize(plan(groups.select("source", (F.col("size") * F.col("n")).alias("size")), weights))
    total = planned.agg(F.max("total")).first()[0] or 0
    block = block or block_words(total)
    schedule = slots(planned, total, block).select(F.col("source").alias("k_source"), F.col("rank").alias("k_rank"), "slot")
    goals = planned.select(F.col("source").alias("p_source"), "source_size", "target", "goal")
    placed = streams(groups)
    placed = placed.join(goals, placed["source"].eqNullSafe(goals["p_source"])).drop("p_source").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    # Where each document lies in the stream, epoch by epoch, as far as the goal reaches; zero-sized ones lie nowhere.
    start = lambda e: F.col("at") + F.col("copy") * F.col("size") + e * F.col("source_size")
    spans = F.transform(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1)), lambda e: F.struct(e.alias("epoch"), F.least(F.col("size"), F.col("goal") - start(e)).alias("words"), F.floor(start(e) / block).alias("rank")))
    keys = ["doc_id", "source", "mark", "copy", "size", "source_size", "target"]
    cut = placed.select(*keys, F.explode_outer(F.filter(spans, lambda s: s["words"] > 0)).alias("p")).select(*keys, "p.*")
    met = cut.join(schedule, cut["source"].eqNullSafe(schedule["k_source"]) & (cut["rank"] == schedule["k_rank"]), "left")
    each = F.when(F.col("slot").isNotNull(), F.struct("epoch", "words", "slot"))
    return met.groupBy(*keys).agg(F.sort_array(F.collect_list(each)).alias("taken"))  # MAX_EPOCHS at most


def mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, block: int | None = None) -> DataFrame:
    """One row per row of df: ``doc_id``, ``source``, ``mark`` (hash of the text), ``size``,
    ``source_size``, ``target``, ``taken`` (words) and ``first_slot``, null if nothing is taken.

    A null text has no words and is never taken; a null source is a source of its own, the last;
    repeated rows each have a place in the stream; rows without an id are shuffled by their texts;
    without any words all targets are 0; an empty table gives an empty table.  Reruns give the same
    rows.  Further columns are left behind.
    """
    found = takes(counted(df, id_col, text_col, source_col), weights, block)
    words_taken = F.aggregate("taken", F.lit(0).cast("long"), lambda a, t: a + t["words"])
    first = F.array_min(F.transform("taken", lambda t: t["slot"]))
    return found.select("doc_id", "source", "mark", "size", "source_size", "target", words_taken.alias("taken"), first.alias("first_slot"))


def mixed_documents(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", count_col: str | None = "n_chars", weights: tuple[int, ...] = WEIGHTS, block: int | None = None
) -> DataFrame:
    """The mix itself, partitioned and sorted by the schedule's slots: each document once for every
    epoch that takes it, the last time with its first words only if the goal ends within it.

    Columns as in df, ``count_col`` counted again where a text is cut.  Rows that repeat an id, source
    and text each keep their other columns; those equal in all columns are interchangeable.
    """
    groups = counted(df, id_col, text_col, source_col)
    found = takes(groups, weights, block).where(F.size("taken") > 0)
    found = found.select(F.struct("doc_id", "source", "mark", "copy").alias("__rl_key"), F.col("size").alias("__rl_size"), F.col("taken").alias("__rl_taken"))
    key = F.struct(df[id_col].alias("doc_id"), df[source_col].cast("string").alias("source"), F.xxhash64(df[text_col]).alias("mark"))
    own = df.select(F.struct(*df.columns).alias("__rl_row"), key.alias("__rl_own"))
    often = materialize(groups.where("n > 1").select(F.struct("doc_id", "source", "mark").alias("__rl_own")))
    n_often = often.count()
    once, zero = own, F.lit(0).cast("long")
    if n_often:
        # Rows that repeat are counted where they are equal in all columns, and numbered in runs.
        often = F.broadcast(often) if n_often <= BROADCAST_ROWS else often
        once = own.join(often, "__rl_own", "left_anti").select("__rl_row", "__rl_own")
        again = own.join(often, "__rl_own", "left_semi").groupBy("__rl_own", F.xxhash64("__rl_row").alias("__rl_hash")).agg(F.any_value("__rl_row").alias("__rl_row"), F.count("*").alias("__rl_n"))
        below = F.sum("__rl_n").over(Window.partitionBy("__rl_own").orderBy("__rl_hash").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__rl_n")
        again = again.withColumn("__rl_below", below)
        numbered = again.select("__rl_row", "__rl_own", F.explode(F.sequence(F.col("__rl_below"), F.col("__rl_below") + F.col("__rl_n") - 1)).alias("__rl_copy"))
        once = once.withColumn("__rl_copy", zero).unionByName(numbered)
    else:
        once = once.withColumn("__rl_copy", zero)
    keyed = once.select("__rl_row", F.struct("__rl_own.doc_id", "__rl_own.source", "__rl_own.mark", F.col("__rl_copy").alias("copy")).alias("__rl_key"))
    rows = keyed.join(found, "__rl_key").select("__rl_row", "__rl_size", F.explode("__rl_taken").alias("__rl_t"))
    rows = rows.repartitionByRange("__rl_t.slot", "__rl_t.epoch").sortWithinPartitions("__rl_t.slot", "__rl_t.epoch")
    part = F.col("__rl_t.words") < F.col("__rl_size")
    text = F.when(part, F.array_join(F.slice(words(F.col(f"__rl_row.`{text_col}`")), 1, F.col("__rl_t.words").cast("int")), " ")).otherwise(F.col(f"__rl_row.`{text_col}`"))
    changed = {text_col: text}
    if count_col in df.columns:
        changed[count_col] = F.when(part, F.length(text).cast(df.schema[count_col].dataType)).otherwise(F.col(f"__rl_row.`{count_col}`"))
    return rows.select(*[changed.get(c, F.col(f"__rl_row.`{c}`")).alias(c) for c in df.columns])


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, md5(coalesce(doc_id::VARCHAR, text, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s FROM d GROUP BY source),
r AS (SELECT source, s, 3 * s AS cap, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, ([5, 2, 1])[(rk - 1) % 3 + 1]::BIGINT AS w FROM r),
f AS (
  SELECT *, sum(s) OVER () - coalesce(sum(cap) OVER o, 0) AS words_left, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS weight_left
  FROM w WINDOW o AS (ORDER BY cap * 10 // w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, words_left * w <= cap * weight_left AS free FROM f),
l AS (SELECT words_left AS lw, weight_left AS lq FROM g WHERE free ORDER BY cap * 10 // w, rk LIMIT 1),
p AS (
  SELECT source, rk, s::BIGINT AS source_size, CASE WHEN free THEN (lw * w)::DOUBLE / lq::DOUBLE ELSE cap::DOUBLE END AS target,
    least(CASE WHEN free THEN (2 * lw * w + lq) // (2 * lq) ELSE cap END, cap)::BIGINT AS goal FROM g, l),
t AS (SELECT sum(goal)::BIGINT AS total, 64 * (1 << greatest(0, (length(bin(sum(goal)::BIGINT)) - 26) // 3))::BIGINT AS block FROM p),
n AS (SELECT ceil(total / block)::BIGINT AS slots FROM t),
shares AS (
  SELECT source, rk, goal, (sum(goal) OVER (ORDER BY rk) - goal)::DOUBLE / total AS lo, (sum(goal) OVER (ORDER BY rk))::DOUBLE / total AS hi FROM p, t WHERE goal > 0),
points AS (
  SELECT slot, list_sum(list_transform(range(0, 48), lambda k: ((slot >> k) & 1) / (2::DOUBLE ** (k + 1)))) AS u
  FROM (SELECT unnest(range(0, slots)) AS slot FROM n)),
open AS (SELECT rk, slot, row_number() OVER (PARTITION BY rk ORDER BY slot) - 1 AS rank FROM points JOIN shares ON u >= lo AND u < hi),
schedule AS (
  SELECT * FROM open
  UNION ALL SELECT rk, slots, unnest(range(had, greatest(had, need))) AS rank
  FROM (SELECT rk, (SELECT count(*) FROM open o WHERE o.rk = x.rk) AS had, ceil(goal / block)::BIGINT AS need FROM shares x, t), n),
o AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS pos FROM d),
e AS (
  SELECT rid, p.rk, greatest(least(o.size, goal - pos - k * source_size), 0) AS words, (pos + k * source_size) // block AS rank
  FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source, t, range(0, 3) AS epochs(k)),
taken AS (SELECT e.rid, sum(words)::BIGINT AS taken, min(slot) AS first_slot FROM e LEFT JOIN schedule s ON s.rk = e.rk AND s.rank = e.rank AND e.words > 0 GROUP BY e.rid)
SELECT o.doc_id, o.size, p.source_size, p.target, taken.taken, taken.first_slot
FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source JOIN taken USING (rid)
"""
