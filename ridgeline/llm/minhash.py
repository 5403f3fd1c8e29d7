"""Near-duplicates by banded MinHash with sequential Bayesian verification.

1. Every text becomes the set of its word shingles (64-bit hashes), a fingerprint of that set and
   a MinHash signature.  Equal sets form a class with a number of its own, whatever ids its rows
   have, which goes on as one representative, so copies are never paired.
2. Signatures are cut into bands of four values.  As many bands are used as make the chance that
   two texts at the threshold share none smaller than ``BAND_MISS``.
3. Each bucket's members are dealt to parts by a hash; members are first held against the smallest
   one of their part, and these against the smallest one of the bucket (a tree of two levels, so
   that no signature or set of a bucket's lead meets all of a large bucket in one task).  Links
   found there join members into components.
4. In buckets that still hold several components, members of different components are held
   against each other, in blocks of bounded size; the largest component of a bucket is compared
   with the rest only, not with itself.  A pair is looked at in the first band it shares, and
   candidates stay lists inside the rows of a block, never a row for each pair.
5. "Held against" means: signatures are compared in batches of ``BATCH`` values; with a uniform
   prior, a pair is dropped as soon as the posterior probability that its similarity reaches the
   threshold falls below ``MISS``.  Survivors are verified exactly on their full shingle sets.

So no pair of texts in different components that shares a band goes untested, and no pair is
tested whose members are known to be connected.  Components come from alternating star
contraction on the link table; nothing about documents reaches the driver.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import materialize, release

ROWS = 4
BAND_MISS, MISS = 1e-6, 1e-5
BATCH = 16
#: Members of a block, about.
BLOCK = 512
#: Pairs of a block whose signatures are compared at once.
PAIRS = 65_536
#: Parts of a bucket, each with a member that the others are first held against.
PARTS = 256
#: A list of ids up to so many (8 bytes each) may be broadcast; a longer one is joined by a shuffle.
BROADCAST_IDS = 1_000_000
CACHE_ENTRIES = 400_000


def bands_for(percent: int) -> int:
    """Bands after which a pair at the threshold shares none with a chance below BAND_MISS."""
    return math.ceil(math.log(BAND_MISS) / math.log(1 - (percent / 100) ** ROWS))


def least_matches(percent: int, size: int) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on) after each batch.

    With a uniform prior and m matches in n values, the similarity is Beta(m + 1, n - m + 1)
    distributed, and P(similarity >= t) is the chance of at most m successes in n + 1 trials at t.
    """
    t, steps = percent / 100, []
    for n in [*range(BATCH, size, BATCH), size]:
        tail, m = 0.0, 0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= MISS:
                break
        steps.append((n, m))
    return steps


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """Shingle sets and signatures of UTF-8 texts."""

    def __init__(self, words: int, size: int):
        self.words, self.size = words, size
        draw = np.random.default_rng(20_240_613)
        self.a = draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, size, dtype=np.uint64)
        self.known = _Words()

    def shingles(self, text: bytes) -> np.ndarray:
        """Sorted hashes of the distinct shingles: runs of words, A-Z lower-cased; a shorter text is one shingle."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        words = text.lower().split()
        h = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        if not len(h):
            return h
        run = min(self.words, len(h))
        mixed = np.full(len(h) - run + 1, run, dtype=np.uint64)
        for i in range(run):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - run + 1 + i]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)

    def signature(self, shingles: np.ndarray) -> bytes:
        least = np.full(self.size, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 1024):
            hashed = shingles[at : at + 1024, None] * self.a + self.b
            np.minimum(least, hashed.min(axis=0), out=least)
        return (least >> np.uint64(32)).astype("<u4").tobytes()


_SHINGLERS: dict[tuple[int, int], Shingler] = {}


def _shingler(words: int, size: int) -> Shingler:
    if (words, size) not in _SHINGLERS:
        _SHINGLERS[words, size] = Shingler(words, size)
    return _SHINGLERS[words, size]


def _raw(value: pa.Scalar) -> bytes:
    return bytes(value.as_buffer()) if value.is_valid else b""


def signatures(docs: DataFrame, words: int, size: int) -> DataFrame:
    """``doc_id``, ``mark``, ``n``, ``print`` (fingerprint of the set) and ``sig`` of each row; the last two are null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(words, size)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, prints, sigs = [], [], []
                for text in part.column(2):
                    own = shingler.shingles(_raw(text))
                    counts.append(len(own))
                    prints.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    sigs.append(shingler.signature(own) if len(own) else None)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "mark", "n", "print", "sig"])

    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(sign, "doc_id long, mark long, n long, print binary, sig binary")


def shingle_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, words: int, size: int) -> DataFrame:
    """``id`` and ``set`` (packed sorted hashes) of the classes whose ids are listed, by the text of each one's first row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(words, size)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.record_batch([part.column(0), pa.array([shingler.shingles(_raw(t)).tobytes() for t in part.column(1)], pa.binary())], names=["id", "set"])

    listed = classes.join(ids, "id").select("id", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"), F.xxhash64("first.doc_id", "first.mark").alias("key"))
    wanted = F.broadcast(listed) if ids.count() <= BROADCAST_IDS else listed
    rows = docs.withColumn("mark", F.xxhash64("text")).withColumn("key", F.xxhash64("doc_id", "mark")).join(wanted, "key")
    rows = rows.where(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))).select("id", "text")
    return rows.mapInArrow(pack, "id long, set binary").dropDuplicates(["id"])  # the first row may be repeated


def survives(left: np.ndarray, x: np.ndarray, right: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs (row x of left, row y of right) of signatures that no batch drops; a batch's values alone are copied."""
    alive, matches, at = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), 0
    for n, least in steps:
        matches += (left[x[alive], at:n] == right[y[alive], at:n]).sum(axis=1)
        go = matches >= least
        alive, matches, at = alive[go], matches[go], n
    return alive


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, size)


def trees(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that join each bucket's members: the bucket's lead with the smallest
    member of each part, and that one with the others of its part; one pair less than members."""
    parted = members.withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    heads = parted.groupBy("bucket", "piece").agg(F.min("id").alias("head"), F.min("lead").alias("lead"))
    low = parted.drop("lead").join(heads, ["bucket", "piece"]).where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    return low.unionByName(heads.where("head <> lead").select(F.col("lead").alias("a"), F.col("head").alias("b"))).distinct()


def prune(pairs: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures leave the threshold possible."""
    steps = least_matches(percent, size)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                every = np.arange(batch.num_rows)
                kept = pa.array(survives(_matrix(batch.column(2), size), every, _matrix(batch.column(3), size), every, steps))
                yield pa.record_batch([batch.column(0).take(kept), batch.column(1).take(kept)], names=["a", "b"])

    sig = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    both = pairs.join(sig("a"), "a").join(sig("b"), "b")
    possible = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return possible.select("a", "b", "sig_a", "sig_b").mapInArrow(compare, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, words: int, size: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    sets = materialize(shingle_sets(docs, classes, ids, words, size))
    of = lambda x: sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(confirm, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root`` (smallest id of the component) of every node of the edges (a, b), by alternating large and small stars."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
        # Large star: larger neighbours move to the smallest one.
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: smaller neighbours and the node itself move to the smallest one.
        small = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        moved = large.join(small, F.col("u") == F.col("w")).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        last, edges = edges, materialize(moved)
        release(last)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def cross_tasks(members: DataFrame, labels: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """What remains to be verified between members of one bucket and different components: rows of
    ``task``, ``id``, ``part`` and ``with`` (packed ids that the signatures leave possible for this
    one, or null if it is only named by others).  A task holds about two blocks of members at most,
    so candidates are named in lists inside rows, never as a row for each pair."""
    steps = least_matches(percent, size)
    placed = members.join(labels.select("id", F.col("root").alias("part")), "id", "left").withColumn("part", F.coalesce("part", "id"))
    placed = materialize(placed)
    parts = placed.groupBy("bucket", "part").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("bucket").agg(F.count("*").alias("n_parts"), F.sum("c").alias("all"), F.max(F.struct("c", "part")).alias("main")).where("n_parts > 1")
    blocks = lambda n: F.ceil(n / BLOCK)
    plan = mixed.select("bucket", F.col("main.part").alias("main"), blocks(F.col("all") - F.col("main.c")).alias("rest_blocks"), blocks(F.col("main.c")).alias("main_blocks"))
    hashed = F.xxhash64("id", "bucket")
    rows = placed.join(plan, "bucket").withColumn("block", F.when(F.col("part") == F.col("main"), F.col("rest_blocks") + F.pmod(hashed, "main_blocks")).otherwise(F.pmod(hashed, "rest_blocks")))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("block") < F.col("rest_blocks"), F.col("rest_blocks") + F.col("main_blocks")).otherwise(F.col("rest_blocks")) - 1)
    tasks = F.transform(others, lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    dealt = rows.select("bucket", "band", "id", "part", "block", F.explode(tasks).alias("t")).select("bucket", "t.i", "t.j", "band", "id", "part", "block")
    signed = dealt.join(classes.select("id", "sig"), "id").select("bucket", "i", "j", "band", "id", "part", "block", "sig")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, i, j, band), ids, part, block, sigs in _groups(batches, size):
            first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
            step = max(1, PAIRS // max(1, len(second)))
            left, right = [], []
            for at in range(0, len(first), step):
                x, y = (g.ravel() for g in np.meshgrid(first[at : at + step], second, indexing="ij"))
                use = (part[x] != part[y]) & ((ids[x] < ids[y]) | (i != j))
                x, y = x[use], y[use]
                kept = survives(sigs, x, sigs, y, steps)
                x, y = x[kept], y[kept]
                if band and len(x):
                    earlier = np.zeros(len(x), dtype=bool)
                    for b in range(0, band * ROWS, ROWS):
                        earlier |= (sigs[x, b : b + ROWS] == sigs[y, b : b + ROWS]).all(axis=1)
                    x, y = x[~earlier], y[~earlier]
                left.append(x)
                right.append(y)
            x, y = np.concatenate(left or [[]]).astype(np.int64), np.concatenate(right or [[]]).astype(np.int64)
            if len(x):
                task = int.from_bytes(hashlib.blake2b(np.array([bucket, i, j], dtype=np.int64).tobytes(), digest_size=8).digest(), "little", signed=True)
                named, order = np.union1d(x, y), np.argsort(x, kind="stable")
                lists = [ids[run].tobytes() or None for run in np.split(y[order], np.searchsorted(x[order], named[1:]))]
                yield pa.record_batch([pa.array(np.full(len(named), task)), pa.array(ids[named]), pa.array(part[named]), pa.array(lists, pa.binary())], names=["task", "id", "part", "with"])

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = signed.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "band")
    return keyed.mapInArrow(compare, "task long, id long, part long, with binary")


def cross_links(tasks: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, words: int, size: int) -> DataFrame:
    """Verified links (a, b) of the tasks' candidates on full shingle sets: one at most for each
    document and component, which connects as well as all of them."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ("task",)):
            table = pa.Table.from_batches(group)
            ids, part = table.column("id").to_pylist(), table.column("part").to_pylist()
            sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in table.column("set")]
            rows: dict[int, list[int]] = {}
            for k, i in enumerate(ids):
                rows.setdefault(i, []).append(k)
            a, b = [], []
            for k, named in enumerate(table.column("with")):
                if not named.is_valid:
                    continue
                others = [r for i in np.frombuffer(named.as_buffer(), dtype=np.int64).tolist() for r in rows[i]]
                met = set()
                for at in range(0, len(others), 64):
                    for r in _linked(sets[k], others[at : at + 64], sets, percent):
                        if part[r] not in met:
                            met.add(part[r])
                            a.append(ids[k])
                            b.append(ids[r])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ids = materialize(tasks.select("id").distinct())
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = tasks.join(shingle_sets(docs, classes, ids, words, size), "id").repartition(n, "task").sortWithinPartitions("task")
    return keyed.select("task", "id", "part", "with", "set").mapInArrow(confirm, "a long, b long")


def _linked(own: np.ndarray, others: list[int], sets: list[np.ndarray], percent: int) -> list[int]:
    """Those of the other sets that reach the threshold with this one."""
    lengths = np.array([len(sets[r]) for r in others])
    laid = np.concatenate([sets[r] for r in others])
    found = own[np.minimum(np.searchsorted(own, laid), len(own) - 1)] == laid
    both = np.add.reduceat(found.astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    return [others[i] for i in np.flatnonzero(100 * both >= percent * (len(own) + lengths - both))]


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[list[pa.RecordBatch]]:
    """The batches of each run of equal keys in sorted rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = 0
        for k, run in itertools.groupby(zip(*(batch.column(c).to_pylist() for c in key), strict=True)):
            n = sum(1 for _ in run)
            if held and k != last:
                yield held
                held = []
            last = k
            held.append(batch.slice(at, n))
            at += n
    if held:
        yield held


def _groups(batches: Iterator[pa.RecordBatch], size: int):
    """(key, ids, parts, blocks, signatures) of each run of equal (bucket, i, j); a run has about two blocks."""
    for group in _runs(batches, ("bucket", "i", "j", "band")):
        table = pa.Table.from_batches(group)
        key = tuple(table.column(c)[0].as_py() for c in ("bucket", "i", "j", "band"))
        yield key, *(table.column(c).to_numpy() for c in ("id", "part", "block")), _matrix(table.column("sig").combine_chunks(), size)


def near_duplicates(df: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: ``doc_id``, ``mark`` (hash of the text), ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked if 100 * shared shingles >= percent * shingles of both together.  A null
    or blank text has no shingles and links with nothing; a text with fewer words than a shingle
    is one shingle.  ``component_id`` is the smallest id that links lead to, null if none of its
    rows has an id.  One row of each component is kept: one with that id; of several such rows the
    one with the smallest mark, of equal rows any one.  Rows that repeat an id with another text
    are documents of their own, and so are all rows without shingles, which are kept.  An empty table gives an empty table; further columns are left behind.
    """
    bands = bands_for(percent)
    size = bands * ROWS
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    signed = materialize(signatures(docs, words, size).withColumn("row", F.monotonically_increasing_id()))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "row")
    classes = signed.where("print is not null").groupBy("print", "n", "sig").agg(F.min(rank).alias("first"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))
    cut = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.substring("sig", b * (4 * ROWS) + 1, F.lit(4 * ROWS))).alias("bucket")))
    banded = classes.select("id", F.inline(cut))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("lead"), F.max("id").alias("most"))
    members = materialize(banded.join(shared.where("lead <> most").select("bucket", "lead"), "bucket"))

    links = verify(materialize(prune(trees(members), classes, percent, size)), docs, classes, percent, words, size)
    labels = components(links)
    crossed = materialize(cross_tasks(members.drop("lead"), labels, classes, percent, size))
    more = cross_links(crossed, docs, classes, percent, words, size)
    of = lambda x: labels.select(F.col("id").alias(x), F.col("root").alias(f"root_{x}"))
    between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    second = components(between)
    over = second.select(F.col("id").alias("root"), F.col("root").alias("top"))
    lower = labels.join(over, "root", "left").select("id", F.coalesce("top", "root").alias("component"))
    # Representatives that had no link in the first round may have one in the second.
    alone = second.join(labels.select("id"), "id", "left_anti").select("id", F.col("root").alias("component"))
    found = classes.select("id", "print", "first").join(lower.unionByName(alone), "id", "left").select(F.col("print").alias("p"), "first", F.coalesce("component", "id").alias("component"))
    leads = found.groupBy("component").agg(F.min("first").alias("lead"))
    placed = signed.join(found.join(leads, "component").select("p", "lead"), F.col("print") == F.col("p"), "left")
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("lead.doc_id"))
    return placed.select(
        "doc_id", "mark", F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("print").isNull() | F.coalesce(F.col("row") == F.col("lead.row"), F.lit(False))).alias("kept"),
    )


def keep_one(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df that are kept, with all their columns; of rows with the same id and text any one."""
    rows = near_duplicates(df, id_col=id_col, text_col=text_col, **options).groupBy(F.col("doc_id").alias("__rl_id"), F.col("mark").alias("__rl_mark"))
    less = materialize(rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("kept"), 1)).alias("n_kept")).where("n_kept < n"))

    def met(among: DataFrame, how: str) -> DataFrame:
        return df.join(among, df[id_col].cast("long").eqNullSafe(among["__rl_id"]) & (F.xxhash64(df[text_col].cast("string")) == among["__rl_mark"]), how)

    stay, repeated = met(less, "left_anti"), less.where("n_kept > 0")
    if repeated.isEmpty():
        return stay
    return stay.unionByName(met(repeated, "inner").dropDuplicates(["__rl_id", "__rl_mark"]).select(*[df[c] for c in df.columns]))


ORACLE = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [md5(array_to_string(w, ' '))]
    ELSE list_transform(range(1, len(w) - 1), lambda i: md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END)) AS s FROM base),
classes AS (SELECT min(doc_id) AS id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT id, n, unnest(s) AS h FROM classes),
spread AS (SELECT h, count(*) AS docs FROM items GROUP BY h HAVING count(*) > 1),
ranked AS (
  SELECT id, n, h, row_number() OVER (PARTITION BY id ORDER BY coalesce(docs, 1), h) AS rk FROM items LEFT JOIN spread USING (h)),
heads AS (SELECT id, n, h FROM ranked WHERE 100 * (n - rk + 1) >= 85 * n),
pairs AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM heads a JOIN heads b ON a.h = b.h AND a.id < b.id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
met AS (
  SELECT p.a, p.b, len(list_intersect(x.s, y.s)) AS shared, x.n + y.n AS total FROM pairs p JOIN classes x ON x.id = p.a JOIN classes y ON y.id = p.b),
links AS (SELECT a, b FROM met WHERE 100 * shared >= 85 * (total - shared)),
steps AS (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id AS u, id AS r FROM classes UNION SELECT s.v, r.r FROM reach r JOIN steps s ON s.u = r.u WHERE r.r < s.v),
roots AS (SELECT u, min(r) AS root FROM reach GROUP BY u)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id, d.doc_id = coalesce(r.root, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN roots r ON r.u = c.id
"""
