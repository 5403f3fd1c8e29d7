"""Personal data, and terms that give it away.  DataFrame functions only.

Base findings (e-mail and IP addresses, card and phone numbers) come from patterns.  A pattern's
positions are the running lengths of what it matches and of what lies between.

Information-theoretic sanitisation then protects each found value, an entity.  A term (a run of
letters that neither overlaps nor touches an e-mail address) discloses an entity by
log2(P(entity | term) / P(entity))  bits, with probabilities over all documents, and both may
stand anywhere in a document.  Terms that disclose an entity by at least ``MIN_BITS`` bits, with at
least ``GENERALISE`` percent of their documents and ``MIN_DOCS`` documents, are generalised wherever
they stand in a document with it, and removed from ``REMOVE`` percent on.

By these thresholds neither an entity nor a term of a pair stands in more than one of 2**MIN_BITS
documents, so no such key is hot.  Entities that stand in the same documents are counted as one, and
so are terms; copies of a document therefore don't multiply its entities by its terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import materialize

#: Kinds in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone", "term")
#: The patterns match what the plain ones match; possessive and with a look behind, so that no text makes them step back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these can't hold the kind; cheap to test.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": "+"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"\p{L}+"
#: An e-mail address with the letters that touch it, or another run of letters.
FREE_TERM = rf"\p{{L}}*?{PATTERNS['email']}\p{{L}}*+|\p{{L}}++"
MIN_LETTERS = 3
MIN_DOCS, MIN_BITS, GENERALISE, REMOVE = 3, 6, 50, 90
#: Items of an array that are scanned together.
CHUNK = 64
#: Terms, by count and bytes, of which a list may be broadcast; a longer one is joined by a shuffle.
BROADCAST_TERMS, BROADCAST_BYTES = 200_000, 8 << 20
TERMS = "array<struct<start:int,end:int,kind:int,remove:boolean>>"
SPAN = "struct<start:int,end:int,kind:int,hit:string>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it inside functions of arrays."""
    return F.get(F.transform(F.array(value), use), 0)


def chunks(items: Column) -> Column:
    """The items of a (bound) array in arrays of CHUNK."""
    none = F.filter(F.sequence(F.lit(0), F.lit(0)), lambda i: i < 0)
    numbers = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))).otherwise(none)
    return F.transform(numbers, lambda i: F.slice(items, i * CHUNK + 1, F.lit(CHUNK)))


def running(values: Column, step, before: bool = False) -> Column:
    """Running results of ``step`` from 0 over an array of ints; with ``before`` those before each item.

    Appending copies an array, so that results are appended within chunks, and chunks' results in turn.
    """
    none = F.array().cast("array<int>")

    def scan(items: Column, first: Column) -> Column:
        grown = lambda a, v: F.struct(step(a["at"], v).alias("at"), F.array_append(a["out"], a["at"] if before else step(a["at"], v)).alias("out"))
        return F.aggregate(items, F.struct(first.alias("at"), none.alias("out")), grown, lambda a: a["out"])

    def through(parts: Column) -> Column:
        totals = F.transform(parts, lambda c: F.aggregate(c, F.lit(0), step))
        grown = lambda a, v: F.struct(step(a["at"], v).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
        bases = F.aggregate(totals, F.struct(F.lit(0).alias("at"), none.alias("out")), grown, lambda a: a["out"])
        return F.flatten(F.zip_with(parts, bases, scan))

    return bound(values, lambda v: bound(chunks(v), through))


def positions(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost matches that don't overlap: array of (start, end, kind, hit), code points, end exclusive."""

    def place(hits: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
        spans = F.zip_with(running(lengths, lambda a, v: a + v), hits, lambda e, h: F.struct((e - F.length(h)).alias("start"), e.alias("end"), F.lit(kind).alias("kind"), h.alias("hit")))
        return F.when(F.size(hits) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of 12 to 19 digits passes the check-digit test."""
    figure = lambda i: F.substring(number, -i, F.lit(1)).cast("int")
    step = lambda a, i: a + F.when(i % 2 == 1, figure(i)).otherwise((figure(i) * 2) % 10 + F.when(figure(i) >= 5, 1).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(hit)).between(12, 19), luhn(digits(hit))).otherwise(False)
    if kind == "phone":
        return F.length(digits(hit)).between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda s: valid(kind, s["hit"])


def _of_kind(k: int):
    return lambda s: s["kind"] == k


def base_spans(text: Column) -> Column:
    """All base findings by start and kind."""
    parts = []
    for k, kind in enumerate(KINDS[:4]):
        hint = HINTS[kind]
        may = text.contains(hint) if len(hint) == 1 else text.rlike(hint)
        found = F.filter(positions(text, PATTERNS[kind], k), _check(kind))
        parts.append(F.when(may, found).otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.sort_array(F.concat(*parts))


def entity(span: Column) -> Column:
    """What a finding stands for: an address in small letters, a number by its digits."""
    plain = F.when(span["kind"] >= 2, digits(span["hit"])).otherwise(F.translate(span["hit"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.concat(span["kind"].cast("string"), F.lit(":"), plain)


def free_terms(text: Column) -> Column:
    """Positions of the terms that neither overlap nor touch an e-mail address."""
    return F.filter(positions(text, FREE_TERM, 4), lambda t: (F.length(t["hit"]) >= MIN_LETTERS) & ~t["hit"].contains("@"))


def _sets(pairs: DataFrame, of: str, count: str) -> DataFrame:
    """For each value of ``of`` the number of rows it stands in, and two hashes, by which values in the very same rows are known."""
    return pairs.groupBy(of).agg(F.count("*").alias(count), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("x"), F.bit_xor(F.xxhash64(F.lit(2), "row")).alias("y"))


def _small(terms: DataFrame) -> bool:
    n, octets = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return n <= BROADCAST_TERMS and octets <= BROADCAST_BYTES


def locate(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: ``doc_id``, ``mark`` (hash of the text), ``spans`` (base findings) and ``terms``, an array of (start, end, kind, remove).

    A null text counts as an empty one.  Equal rows count as documents of their own and get equal
    spans; null ids are found like others; an empty table gives an empty table; further columns
    are left behind.
    """
    text = F.coalesce(df[text_col], F.lit(""))
    found = df.select(df[id_col].alias("doc_id"), F.xxhash64(df[text_col]).alias("mark"), text.alias("text")).withColumn("spans", base_spans(F.col("text")))
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()).withColumn("text", F.when(F.size("spans") > 0, F.col("text"))))
    n = found.count()
    # As no term stands with an entity in more documents than it or the entity has, only these can pass the thresholds.
    possible = lambda c: (F.col(c) >= MIN_DOCS) & (F.col(c) * 2**MIN_BITS <= n)
    held = found.select("row", F.explode(F.array_distinct(F.transform("spans", entity))).alias("entity"))
    entities = _sets(held, "entity", "with_entity").where(possible("with_entity")).groupBy("x", "y", "with_entity").agg(F.min("entity").alias("entity"))
    # One of the entities that stand in the same documents is enough: what discloses it discloses all of them.
    held = materialize(held.join(entities.select("entity", "with_entity"), "entity"))
    met = found.join(held.select("row").distinct(), "row").select("row", F.explode(F.array_distinct(F.transform(free_terms(F.col("text")), lambda t: t["hit"]))).alias("term"))
    met = materialize(met)
    # Terms are counted in documents with such entities first, and only those that may pass in all documents.
    sets = materialize(_sets(met, "term", "here").where(possible("here")))
    names = F.broadcast(sets.select("term")) if _small(sets) else sets.select("term")
    everywhere = df.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(TERM), F.lit(0)))).alias("term")).join(names, "term", "left_semi")
    counts = everywhere.groupBy("term").agg(F.count("*").alias("with_term")).where(possible("with_term"))
    terms = sets.join(counts, "term").where(100 * F.col("here") >= GENERALISE * F.col("with_term"))
    leads = terms.groupBy("x", "y", "here", "with_term").agg(F.min("term").alias("lead"))
    terms = materialize(terms.join(leads, ["x", "y", "here", "with_term"]).select("term", "lead", "with_term"))
    first = materialize(met.join(terms.where("term = lead").select("term", "with_term"), "term"))
    pairs = first.join(held, "row").groupBy("entity", "term", "with_entity", "with_term").agg(F.count("*").alias("both")).where(F.col("both") >= MIN_DOCS)
    share = 100 * F.col("both")
    bits = F.col("both").cast("double") * n >= F.lit(float(2**MIN_BITS)) * F.col("with_term") * F.col("with_entity")
    flagged = pairs.where((share >= GENERALISE * F.col("with_term")) & bits).select("entity", "term", (share >= REMOVE * F.col("with_term")).alias("remove"))
    # Documents with a flagged pair, and in these all places of all terms that stand for its term.
    wanted = first.select("row", "term").join(held.select("row", "entity"), "row").join(materialize(flagged), ["entity", "term"]).groupBy("row", "term").agg(F.max("remove").alias("remove"))
    wanted = materialize(wanted.select("row", F.col("term").alias("lead"), "remove").join(terms.select("term", "lead"), "lead").select("row", "term", "remove"))
    spots = found.join(wanted.select("row").distinct(), "row").select("row", F.explode(free_terms(F.col("text"))).alias("t")).select("row", F.col("t.hit").alias("term"), "t.start", "t.end")
    spots = spots.join(wanted, ["row", "term"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", F.lit(4).alias("kind"), "remove"))).alias("terms"))
    return found.join(spots, "row", "left").select("doc_id", "mark", "spans", F.coalesce("terms", F.array().cast(TERMS)).alias("terms"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(df: DataFrame, **columns: str) -> DataFrame:
    """One row per row of df: ``doc_id``, the count of each base kind, ``base_sha256`` and all ``spans`` in writing."""
    found = locate(df, **columns)
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    everything = F.sort_array(F.concat(F.transform("spans", plain), F.transform("terms", plain)))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(written(F.sort_array(F.transform("spans", plain))), 256).alias("base_sha256"), written(everything).alias("spans"))


def sanitize(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """df with sanitised texts: base findings become their kind in brackets, and wherever they stand
    in a document with an entity that they disclose, generalised terms ``[TERM]``, removed terms nothing.  Of overlapping spans the first one's mark stands for all.
    A null text stays null.  All rows and columns stay; ``count_col`` is counted again."""
    found = locate(df, id_col=id_col, text_col=text_col)
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    cover = F.sort_array(F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.get(marks, s["kind"]).alias("by"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.when(s["remove"], "").otherwise(F.get(marks, s["kind"])).alias("by"))),
    ))
    changes = found.where("size(spans) + size(terms) > 0").select(F.col("doc_id").alias("__rl_id"), F.col("mark").alias("__rl_mark"), cover.alias("__rl_cover")).dropDuplicates(["__rl_id", "__rl_mark"])
    joined = df.join(changes, df[id_col].eqNullSafe(changes["__rl_id"]) & (F.xxhash64(df[text_col]) == changes["__rl_mark"]), "left")
    result = joined.withColumn(text_col, F.when(F.col("__rl_cover").isNotNull(), replaced(F.col(text_col), F.col("__rl_cover"))).otherwise(F.col(text_col)))
    if count_col in df.columns:
        result = result.withColumn(count_col, F.when(F.col("__rl_cover").isNotNull(), F.length(text_col).cast(df.schema[count_col].dataType)).otherwise(F.col(count_col)))
    return result.select(*df.columns)


def replaced(text: Column, cover: Column) -> Column:
    """The text with each span (start, end, by; sorted by start) replaced; of overlapping ones the first one's ``by`` stands for all."""
    ends = F.transform(cover, lambda s: s["end"])
    # Each span that begins at or behind all ends before it, with what lies in between.
    placed = F.zip_with(cover, running(ends, lambda a, v: F.greatest(a, v), before=True), lambda s, a: F.struct(a.alias("from"), s["start"].alias("to"), s["by"].alias("by")))
    heads = F.filter(placed, lambda s: s["to"] >= s["from"])

    # Cutting walks through the text, so it is cut for each chunk first and within chunks then.
    def written_out(part: Column) -> Column:
        origin = F.get(part, 0)["from"]
        whole = F.substring(text, origin + 1, F.element_at(part, -1)["to"] - origin)
        return bound(whole, lambda t: F.array_join(F.transform(part, lambda s: F.concat(F.substring(t, s["from"] - origin + 1, s["to"] - s["from"]), s["by"])), ""))

    last = F.array_max(ends)
    return F.concat(bound(heads, lambda h: F.array_join(F.transform(chunks(h), written_out), "")), F.substring(text, last + 1, F.length(text)))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
patterns(kind, name, pattern) AS (VALUES
  (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'),
  (2, 'card', '[0-9](?:[\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')),
cut AS (SELECT rid, kind, regexp_extract_all(t, pattern) AS hits, string_split_regex(t, pattern) AS gaps FROM docs, patterns),
parts AS (SELECT rid, kind, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM cut WHERE len(hits) > 0),
placed AS (
  SELECT rid, kind, hit, regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
    sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i)::BIGINT AS e FROM parts),
base AS (
  SELECT rid, kind, e - length(hit) AS s, e,
    kind || ':' || CASE WHEN kind >= 2 THEN digits ELSE translate(hit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS entity
  FROM placed WHERE CASE kind WHEN 0 THEN true
    WHEN 1 THEN regexp_full_match(hit, '0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}')
    WHEN 2 THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda k:
      CASE WHEN k % 2 = 1 THEN digits[-k]::INT ELSE digits[-k]::INT * 2 % 10 + (digits[-k]::INT >= 5)::INT END)) % 10 = 0
    ELSE length(digits) BETWEEN 9 AND 15 END),
runs AS (
  SELECT rid, unnest(hits) AS term, unnest(gaps[:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i
  FROM (SELECT rid, regexp_extract_all(t, '\p{L}+') AS hits, string_split_regex(t, '\p{L}+') AS gaps FROM docs SEMI JOIN base USING (rid)) WHERE len(hits) > 0),
ended AS (SELECT *, sum(length(gap) + length(term)) OVER (PARTITION BY rid ORDER BY i)::BIGINT AS e FROM runs),
terms AS (SELECT rid, term, e - length(term) AS s, e FROM ended WHERE length(term) >= 3),
free AS (SELECT * FROM terms x WHERE NOT EXISTS (SELECT 1 FROM base o WHERE o.rid = x.rid AND o.kind = 0 AND x.s <= o.e AND o.s <= x.e)),
held AS (SELECT DISTINCT rid, entity FROM base),
pairs AS (SELECT entity, term, count(*) AS n_both FROM (SELECT DISTINCT rid, term FROM free) JOIN held USING (rid) GROUP BY ALL HAVING count(*) >= 3),
with_entity AS (SELECT entity, count(DISTINCT rid) AS n_entity FROM base GROUP BY ALL),
with_term AS (
  SELECT term, count(*) AS n_term FROM (SELECT unnest(list_distinct(regexp_extract_all(t, '\p{L}+'))) AS term FROM docs) SEMI JOIN pairs USING (term) GROUP BY ALL),
disclosing AS (
  SELECT entity, term FROM pairs JOIN with_entity USING (entity) JOIN with_term USING (term)
  WHERE 100 * n_both >= 50 * n_term AND n_both * (SELECT count(*) FROM docs) >= 64 * n_term * n_entity),
everything AS (
  SELECT b.rid, b.kind, p.name, b.s, b.e FROM base b JOIN patterns p USING (kind)
  UNION ALL SELECT DISTINCT rid, 4, 'term', s, e FROM free JOIN held USING (rid) JOIN disclosing USING (entity, term)),
written AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
    string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind < 4) AS own, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) AS spans
  FROM everything GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN written USING (rid)
"""
