"""Exact inner-product top-k in three phases with a uniform threshold.

A vector's coordinates are cut into ``LISTS`` lists; a score is the sum of one partial score per
list.  Queries go in parts of bounded size, each of them by three phases:

1. *gather*: in every task each list names, for each query, its k best candidates by partial
   score; their scores, completed, give the task's k best.  The k-th best of all tasks' is a safe
   cutoff T: at least k candidates reach it.
2. *collect*: the cutoffs are broadcast (one integer a query).  If all partial scores of a
   candidate were below T / LISTS, its score would be below T; so the entries (query, candidate,
   partial score) of at least T / LISTS are sufficient.  They are all that a list hands on: with
   few lists the share T / LISTS is high and few entries reach it.
3. *resolve*: the partial scores that a collected pair lacks are computed for these pairs alone,
   added to the known ones, and scores below T dropped.

The few pairs left are ranked by (score, smaller id).  Candidates are never shuffled or
collected: what phase 2 hands to phase 3 stays in its task, one row for each candidate with the
queries that it may answer.  The driver holds one part of the queries and their cutoffs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.llm.common import delete_at_exit, materialize, shared_dir

LISTS = 2
#: Bytes of queries that are broadcast at once, about; queries and candidates that are multiplied at once.
QUERY_BYTES, QUERIES, CANDIDATES = 32 << 20, 1024, 2048
#: Vectors with a component beyond are kept apart, so that they don't slow the others down.
LARGE = 1 << 24
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1
#: Stands for no score.
VOID = -(1 << 63)


def quantize(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a long, held to its range; null if the vector is null or holds a null, NaN or infinity."""
    values = vector.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(values, lambda x: F.floor(x * scale)))


def _lists(size: int, n: int) -> list[slice]:
    edges = [size * i // n for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def _reach(vectors: np.ndarray) -> int:
    return max(abs(int(vectors.min())), abs(int(vectors.max()))) if vectors.size else 0


def _exact(queries: np.ndarray, candidates: np.ndarray, product) -> np.ndarray:
    """Integer products: by float64 where every sum is below 2**53, by 64-bit integers where they fit, else by whole numbers of any size."""
    reach = _reach(queries) * _reach(candidates) * max(1, queries.shape[1])
    if reach < 1 << 53:
        return product(queries.astype(np.float64), candidates.astype(np.float64)).astype(np.int64)
    if reach < 1 << 59:  # the lists' sum stays a long too
        return product(queries, candidates)
    return product(queries.astype(object), candidates.astype(object))


def _all_pairs(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    return queries @ candidates.T


def _paired(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    return (queries * candidates).sum(axis=1)


def _long(score: np.ndarray) -> np.ndarray:
    """Scores held to the range of a long."""
    return score if score.dtype == np.int64 else np.array([min(max(int(s), LEAST), MOST) for s in score.ravel()], dtype=np.int64).reshape(score.shape)


def _alike(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, rows, ids, matrix) of the vectors of one size, those with large components apart."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    names = ids.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        matrix = flat.reshape(len(rows), int(size))
        large = ((matrix >= LARGE) | (matrix <= -LARGE)).any(axis=1)
        for part in (~large, large):
            if part.any():
                yield int(size), rows[part], names[rows[part]], matrix[part]


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, n_lists: int = LISTS) -> DataFrame:
    """Each query's k highest scores among the rows of df with another id: ``query_id``, ``rank``
    (int, from 1), ``vec_id``, ``score``.

    Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows
    with a null id.  A query is compared with candidates of its own dimension; fewer than k of
    them: all.  An empty vector has a score of 0 with every other empty one.  Components and scores
    beyond a long are held to its range.  Ties go to the smaller id.  Repeated candidate rows take a
    rank each; of query rows with one id the smallest vector counts, once.  An empty table gives an
    empty table.  Further columns are left behind.
    """
    spark = df.sparkSession
    pick = lambda d: d.select(d[id_col].cast("long").alias("id"), quantize(d[vector_col], scale).alias("v")).where("id is not null and v is not null")
    candidates = materialize(pick(df))
    asked = materialize(pick(queries).groupBy("id").agg(F.min("v").alias("v")))
    bytes_asked = asked.agg(F.sum(8 * F.size("v") + 8)).first()[0] or 0
    parts = max(1, -(-bytes_asked // QUERY_BYTES))
    folder = f"{shared_dir(spark)}/top-k-{uuid.uuid4().hex}"
    for p in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == p).orderBy("id").toArrow()
        out = _found(candidates, rows, k, n_lists)
        if parts > 1:
            # One folder for all parts, so that the plan doesn't grow with them.
            out.write.mode("append").parquet(folder)
    if parts > 1:
        delete_at_exit(spark, folder)
        out = spark.read.schema(SCHEMA).parquet(folder)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SCHEMA = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def _found(candidates: DataFrame, rows: pa.Table, k: int, n_lists: int) -> DataFrame:
    """Pairs, among them the k best of each query in ``rows``."""
    context = candidates.sparkSession.sparkContext
    #: For each size the queries' blocks: (number of the first, ids, vectors).
    asked: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    n, named = 0, []
    if rows.num_rows:
        for size, _, ids, vectors in _alike(rows["id"].combine_chunks(), rows["v"].combine_chunks()):
            for at in range(0, len(ids), QUERIES):
                asked.setdefault(size, []).append((n + at, ids[at : at + QUERIES], vectors[at : at + QUERIES]))
            n, named = n + len(ids), [*named, ids]
    names = np.concatenate(named or [np.zeros(0, dtype=np.int64)])
    shared = context.broadcast(asked)

    def blocks(batch: pa.RecordBatch):
        """Candidates of one size with the queries of that size; sizes that no query has are left out."""
        for at in range(0, batch.num_rows, CANDIDATES):
            part = batch.slice(at, CANDIDATES)
            for size, rows, ids, vectors in _alike(part.column(0), part.column(1)):
                if size in shared.value:
                    yield size, at + rows, ids, vectors

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, ids, vectors in blocks(batch):
                for first, own, queries in shared.value[size]:
                    same = own[:, None] == ids[None, :]
                    partial = [_exact(queries[:, s], vectors[:, s], _all_pairs) for s in _lists(size, n_lists)]
                    take = min(k, len(ids))
                    top = []
                    for p in partial:
                        ranked = np.where(same, VOID, p)
                        top.append(np.argpartition(ranked, len(ids) - take, axis=1)[:, len(ids) - take :])
                    picked = np.sort(np.concatenate(top, axis=1), axis=1)
                    score = _long(sum(np.take_along_axis(p, picked, axis=1) for p in partial))
                    void = np.take_along_axis(same, picked, axis=1)
                    void[:, 1:] |= picked[:, 1:] == picked[:, :-1]  # named by several lists: counts once
                    score[void] = VOID
                    before = best.get(first, np.full((len(own), k), VOID))
                    best[first] = np.sort(np.concatenate([before, score], axis=1), axis=1)[:, -k:]
        for first, score in best.items():
            q, c = np.nonzero(score > VOID)
            yield pa.record_batch([pa.array(first + q, pa.int64()), pa.array(score[q, c], pa.int64())], names=["q", "score"])

    order = Window.partitionBy("q").orderBy(F.col("score").desc())
    ranked = candidates.mapInArrow(gather, "q long, score long").withColumn("rank", F.row_number().over(order))
    cutoff = np.full(n, VOID)
    for r in ranked.where(F.col("rank") == k).select("q", "score").toLocalIterator():
        cutoff[r.q] = r.score
    cutoffs = context.broadcast(cutoff)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, ids, vectors in blocks(batch):
                for first, own, queries in shared.value[size]:
                    limit = cutoffs.value[first : first + len(own)]
                    every, share = (limit <= LEAST)[:, None], -(-limit // n_lists)[:, None]
                    known, lists = 0, np.zeros((len(own), len(ids)), dtype=np.int8)
                    for i, s in enumerate(_lists(size, n_lists)):
                        partial = _exact(queries[:, s], vectors[:, s], _all_pairs)
                        enough = (partial >= share) | every
                        lists |= enough.astype(np.int8) << i
                        known = known + np.where(enough, partial, 0)
                    lists[own[:, None] == ids[None, :]] = 0
                    c, q = np.nonzero(lists.T)
                    if not len(c):
                        continue
                    met, starts = np.unique(c, return_index=True)
                    offsets = pa.array(np.append(starts, len(c)), pa.int32())
                    many = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values, kind))  # noqa: E731, B023
                    whole = _long(known[q, c])
                    exact = known.dtype == np.int64
                    yield pa.record_batch([
                        pa.array(ids[met], pa.int64()), batch.column(1).take(pa.array(rows[met])), pa.array(np.full(len(met), first), pa.int64()), many(q, pa.int32()),
                        many(lists[q, c] if exact else np.zeros(len(q), dtype=np.int8), pa.int8()), many(whole if exact else np.zeros(len(q), dtype=np.int64), pa.int64()),
                    ], names=["vec_id", "v", "first", "q", "lists", "known"])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {first: (own, queries) for group in shared.value.values() for first, own, queries in group}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                firsts = part.column(2).to_numpy(zero_copy_only=False)
                for size, rows, ids, vectors in _alike(part.column(0), part.column(1)):
                    for first in np.unique(firsts[rows]):
                        own, queries = held[int(first)]
                        mine = np.flatnonzero(firsts[rows] == first)
                        lists = part.take(pa.array(rows[mine]))
                        c = np.repeat(mine, lists.column(3).value_lengths().to_numpy(zero_copy_only=False))
                        q, reported, score = (lists.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4, 5))
                        score = score.astype(np.int64)
                        for i, s in enumerate(_lists(size, n_lists)):
                            lacking = np.flatnonzero((reported >> i) & 1 == 0)
                            if len(lacking):
                                more = _exact(queries[q[lacking], s], vectors[c[lacking], s], _paired)
                                if more.dtype != np.int64:
                                    score = score.astype(object)
                                score[lacking] += more
                        score = _long(score)
                        kept = score >= cutoffs.value[first + q]
                        yield pa.record_batch([pa.array(own[q[kept]], pa.int64()), pa.array(ids[c[kept]], pa.int64()), pa.array(score[kept], pa.int64())], names=SCHEMA.names)

    entries = candidates.mapInArrow(collect, "vec_id long, v array<long>, first long, q array<int>, lists array<byte>, known array<long>")
    return entries.mapInArrow(resolve, SCHEMA)


def every_hundredth(df: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """The stated query set: rows whose id is divisible by 100."""
    return df.where(df[id_col] % 100 == 0)


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
