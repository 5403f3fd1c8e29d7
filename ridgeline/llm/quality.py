"""Quality rules with thresholds that adapt to language and source.  DataFrame functions only.

Fixed base rules fail a text that is very short or repeats itself.  Beyond those, three ratios
are held against thresholds taken from the corpus: symbols per word, repeated lines per line and
characters per word.  For each language and source a quantile sketch of each ratio is kept: a
histogram over cells that keep a value's five leading bits (relative error 1/16).  Sketches merge
by adding counts, so the sketch of a language is the sum over its sources, and counts are
combined before any shuffle, whatever the size of a source.  A group with fewer than
``MIN_DOCS`` texts takes the thresholds of its language, a small language those of all texts.

A ratio is too high beyond  q75 + SPREAD * (q75 - q50) + margin  and word length too low below
q25 - SPREAD * (q50 - q25) - margin.  Quartiles hold even where a quarter of a group is junk; the
margins keep ratios that hardly vary from rejecting
the first text that differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import SPACES, materialize, words

SYMBOLS = "#*$%&|<>"
#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Adaptive rules: ratios are in thousandths; margin in thousandths by ratio.
MIN_DOCS, SPREAD = 100, 3
MARGINS = {"symbols": 100, "dup_lines": 400, "word_length": 1000}


def repeated_words(df: DataFrame, words_col: str, out: str) -> DataFrame:
    """Adds the number of words inside 8-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash built by doubling (1, 2, 4, 8 words).  Only texts with
    an equal pair of windows sort theirs; the covered words are then summed over the sorted
    starts, so the cost is n log n in the words of a text.
    """
    keep = df.columns
    df = df.withColumn("_h1", F.transform(words_col, lambda w: F.xxhash64(w)))

    def double(a: int) -> Column:
        return F.transform(f"_h{a}", lambda h, i: F.xxhash64(h, F.get(F.col(f"_h{a}"), i + a)))

    for a in (1, 2, 4):
        df = df.withColumn(f"_h{2 * a}", double(a))
    df = df.withColumn("_w", F.slice("_h8", 1, F.greatest(F.size(words_col) - (WINDOW - 1), F.lit(0))))
    twice = F.size(F.array_distinct("_w")) < F.size("_w")
    df = df.withColumn("_s", F.when(twice, F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: (x["h"] == F.get(F.col("_s"), i - 1)["h"]) | (x["h"] == F.get(F.col("_s"), i + 1)["h"])
    starts = F.sort_array(F.transform(F.filter("_s", same), lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), p - a["last"])).alias("sum")), lambda a: a["sum"],
    )
    return df.select(*keep, F.coalesce(covered, F.lit(0)).cast("long").alias(out))


def measure(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of df with its base counts, ratios and base verdict; no shuffle.

    Columns: ``doc_id``, ``mark`` (hash of the text), ``lang``, ``source``, ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_lines``, ``n_repeat_words``, ``base_failed``.
    """
    text = F.coalesce(df[text_col], F.lit(""))
    found = df.select(
        df[id_col].alias("doc_id"), df[lang_col].alias("lang"), df[source_col].alias("source"), F.xxhash64(df[text_col]).alias("mark"),
        words(text).alias("_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("_lines"),
    )
    found = found.withColumn("n_lines", F.size("_lines").cast("long")).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    found = repeated_words(found.drop("_lines").withColumn("n_words", F.size("_words").cast("long")), "_words", "n_repeat_words").drop("_words")
    return found.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def ratios() -> dict[str, Column]:
    """In whole thousandths; a text without words or lines has none."""
    per = lambda a, b: F.when(F.col(b) > 0, F.expr(f"(1000 * {a}) div {b}"))
    return {"symbols": per("n_symbols", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"), "word_length": per("word_chars", "n_words")}


def cell(value: Column) -> Column:
    """The value with only its five leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Mergeable quantile sketches: ``lang``, ``source``, ``ratio``, ``cell``, ``n``.  Texts that fail the base rules don't count."""
    values = F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("value")) for k, v in ratios().items()])
    rows = measured.where(~F.col("base_failed")).select("lang", "source", F.inline(values))
    return rows.where("value is not null").groupBy("lang", "source", "ratio", cell(F.col("value")).alias("cell")).agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*keys, "ratio", "cell").agg(F.sum("n").alias("n"))


def thresholds(sketch: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``ratio``, ``docs``, ``low``, ``high`` of each sketch."""
    group = Window.partitionBy(*keys, "ratio")
    ranked = sketch.withColumn("up", F.sum("n").over(group.orderBy("cell"))).withColumn("docs", F.sum("n").over(group))
    quantile = lambda percent: F.min(F.when(100 * F.col("up") >= percent * F.col("docs"), F.col("cell")))
    found = ranked.groupBy(*keys, "ratio").agg(F.max("docs").alias("docs"), quantile(25).alias("q25"), quantile(50).alias("q50"), quantile(75).alias("q75"))
    margin = F.coalesce(*[F.when(F.col("ratio") == k, m) for k, m in MARGINS.items()])
    high = F.col("q75") + SPREAD * (F.col("q75") - F.col("q50")) + margin
    low = F.when(F.col("ratio") == "word_length", F.col("q25") - SPREAD * (F.col("q50") - F.col("q25")) - margin)
    return found.select(*keys, "ratio", "docs", low.alias("low"), high.alias("high"))


def wide(found: DataFrame, *keys: str, prefix: str) -> DataFrame:
    """One row per group: its texts and both limits of each ratio."""
    pick = lambda k, c: F.max(F.when(F.col("ratio") == k, F.col(c)))
    limits = [pick(k, c).alias(f"{prefix}_{k}_{c}") for k in MARGINS for c in ("low", "high")]
    return found.groupBy(*keys).agg(F.max("docs").alias(f"{prefix}_docs"), *limits)


def judge(measured: DataFrame) -> DataFrame:
    """Adds ``kept`` to measured rows, by a join with the thresholds of their language and source."""
    own = sketches(measured)
    by_lang = merge(own, "lang")
    everything = merge(by_lang)
    a = wide(thresholds(own, "lang", "source"), "lang", "source", prefix="a")
    b = wide(thresholds(by_lang, "lang"), "lang", prefix="b").withColumnRenamed("lang", "b_lang")
    c = wide(thresholds(everything), prefix="c")
    # The table of limits has a row per language and source; the overall row is joined to it, not to the texts.
    limits = a.join(b, a["lang"].eqNullSafe(b["b_lang"]), "left").join(F.broadcast(c))
    chosen = [
        F.when(F.col("a_docs") >= MIN_DOCS, F.col(f"a_{k}_{e}")).when(F.col("b_docs") >= MIN_DOCS, F.col(f"b_{k}_{e}")).otherwise(F.col(f"c_{k}_{e}")).alias(f"{k}_{e}")
        for k in MARGINS for e in ("low", "high")
    ]
    limits = limits.select(F.col("lang").alias("l_lang"), F.col("source").alias("l_source"), *chosen)
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["l_lang"]) & measured["source"].eqNullSafe(limits["l_source"]), "left")
    bad = F.lit(False)
    for k, v in ratios().items():
        bad = bad | F.coalesce(v > F.col(f"{k}_high"), F.lit(False)) | F.coalesce(v < F.col(f"{k}_low"), F.lit(False))
    return joined.select(*measured.columns, (~F.col("base_failed") & ~bad).alias("kept"))


def assess(df: DataFrame, **columns: str) -> DataFrame:
    """One row per row of df: its counts, ``base_failed`` and ``kept``.

    A null text counts as empty, so it fails; null languages and sources form groups of their
    own; repeated rows are judged alike and each counts; an empty table gives an empty table;
    further columns are left behind.
    """
    return judge(materialize(measure(df, **columns)))


def keep_good(df: DataFrame, **columns: str) -> DataFrame:
    """The rows of df that are kept, with all their columns."""
    rejected = assess(df, **columns).where("not kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    own_id, text = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    return df.join(rejected, df[own_id].eqNullSafe(rejected["_id"]) & (F.xxhash64(df[text]) == rejected["_mark"]), "left_anti")


ORACLE = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
counted AS (
  SELECT rid, doc_id, lang, source, t, w, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM base),
windows AS (
  SELECT rid, i, list_slice(w, i, i + 7) AS win
  FROM counted, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i) WHERE len(w) >= 8),
twice AS (SELECT rid, win FROM windows GROUP BY rid, win HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT p)::BIGINT AS n FROM (
    SELECT v.rid, unnest(range(v.i, v.i + 8)) AS p FROM windows v JOIN twice USING (rid, win)) GROUP BY rid),
m AS (
  SELECT c.*, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM counted c LEFT JOIN covered r USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
vals AS (
  SELECT rid, lang, source, base_failed, 'symbols' AS ratio, 100 AS margin, 1000 * n_symbols // n_words AS v FROM f WHERE n_words > 0
  UNION ALL SELECT rid, lang, source, base_failed, 'dup_lines', 400, 1000 * n_dup_lines // n_lines FROM f WHERE n_lines > 0
  UNION ALL SELECT rid, lang, source, base_failed, 'word_length', 1000, 1000 * word_chars // n_words FROM f WHERE n_words > 0),
cells AS (
  SELECT *, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS cell FROM vals WHERE NOT base_failed),
levels AS (
  SELECT 'a' AS lvl, lang, source, ratio, margin, cell FROM cells
  UNION ALL SELECT 'b', lang, NULL, ratio, margin, cell FROM cells
  UNION ALL SELECT 'c', NULL, NULL, ratio, margin, cell FROM cells),
sk AS (SELECT lvl, lang, source, ratio, margin, cell, count(*) AS n FROM levels GROUP BY ALL),
up AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, ratio ORDER BY cell) AS up,
    sum(n) OVER (PARTITION BY lvl, lang, source, ratio) AS docs FROM sk),
q AS (
  SELECT lvl, lang, source, ratio, margin, max(docs) AS docs, min(cell) FILTER (100 * up >= 25 * docs) AS q25,
    min(cell) FILTER (100 * up >= 50 * docs) AS q50, min(cell) FILTER (100 * up >= 75 * docs) AS q75 FROM up GROUP BY ALL),
lim AS (
  SELECT *, q75 + 3 * (q75 - q50) + margin AS high,
    CASE WHEN ratio = 'word_length' THEN q25 - 3 * (q50 - q25) - margin END AS low FROM q),
size AS (SELECT lvl, lang, source, max(docs) AS docs FROM lim GROUP BY ALL),
pick AS (
  SELECT v.rid, v.v, v.ratio, v.lang, v.source, CASE WHEN a.docs >= 100 THEN 'a' WHEN b.docs >= 100 THEN 'b' ELSE 'c' END AS lvl
  FROM vals v
  LEFT JOIN size a ON a.lvl = 'a' AND a.lang IS NOT DISTINCT FROM v.lang AND a.source IS NOT DISTINCT FROM v.source
  LEFT JOIN size b ON b.lvl = 'b' AND b.lang IS NOT DISTINCT FROM v.lang),
bad AS (
  SELECT DISTINCT p.rid FROM pick p JOIN lim l ON l.lvl = p.lvl AND l.ratio = p.ratio
    AND (p.lvl = 'c' OR l.lang IS NOT DISTINCT FROM p.lang) AND (p.lvl <> 'a' OR l.source IS NOT DISTINCT FROM p.source)
  WHERE p.v > l.high OR p.v < l.low)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND b.rid IS NULL AS kept
FROM f LEFT JOIN bad b ON f.rid = b.rid
"""
