"""Language-model scoring by masked pseudo-likelihood.

A small network predicts every token from the tokens on both sides: the embeddings of the two
tokens before and after it, one table for each place, are added to a hidden layer, from which the
token's digits are predicted one after the other (a softmax for each digit, so the conditional
distribution is normalised over all tokens at the cost of a few short ones).  The digits before
gate the layer; without any context a token has the probability that its count says.  A document's score is
the sum of the log-probabilities of its words.

The most frequent words over the whole corpus have a token each, and there are as many tokens as
the square root of the corpus's words; so they, the embeddings and the digits grow with it.  All
other words share hashed tokens, and a word's share of its token is its own count in the corpus:
P(word) = P(token) * P(word | token), which is normalised over the corpus's words and one more in
each hashed token that stands for all words it lacks.  All counts stay in a table; those of the
next most frequent words are broadcast, the others joined by a shuffle.

Texts are cut into tokens once and kept in the shared folder.  Training passes over all of them:
every task starts from the same weights, runs stochastic gradient descent over all its tokens in
batches, and the tasks' weights are averaged by their tokens, slice by slice, as a tree.  All
arithmetic on the network is numpy's.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import materialize

DIGIT = 32
#: The least number of tokens.  Of all tokens one in HASHED is for words outside the most frequent; the last token stands beyond both ends of a text.
VOCABULARY, HASHED = DIGIT * DIGIT, 8
#: Words for each token, of which tasks hold the counts themselves; CACHE_ENTRIES at most, the others are joined.
HELD = 8
#: Weights in a slice; tasks whose weights are averaged first.
SLICE, FAN = 16384, 256
PLACES = (-2, -1, 1, 2)
REACH, HIDDEN = max(PLACES), 16
BATCH, RATE, DAMP = 4096, 0.5, 16
#: Logits are held between -FAR and FAR, so that no exponential leaves the range of a float.
FAR = 40
CACHE_ENTRIES = 400_000


def whole(size: int) -> int:
    """The least number of tokens from size on for which every value of the first digit has all values of the others."""
    unit = DIGIT
    while size > unit * DIGIT:
        unit *= DIGIT
    return -(-size // unit) * unit


def _runs(laid: np.ndarray):
    """The distinct values of sorted keys, where their runs start, and how long these are."""
    starts = np.flatnonzero(np.concatenate([[True], laid[1:] != laid[:-1]]))
    return laid[starts], starts, np.diff(np.append(starts, len(laid)))


_BELOW = np.tril(np.ones((16, 16), dtype=np.float32))


def _sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at starts: differences of running sums, which products make
    16 rows at a time, several times as fast as reduceat or cumsum on short rows."""
    n, width = rows.shape
    if len(starts) <= 32:
        ones = np.ones(n, dtype=np.float32)
        return np.stack([ones[a:b] @ rows[a:b] for a, b in zip(starts, [*starts[1:], n], strict=True)])
    blocks = np.zeros((-(-n // 16), 16, width), dtype=np.float32)
    blocks.reshape(-1, width)[:n] = rows
    running = _BELOW @ blocks
    before = np.cumsum(running[:, -1], axis=0)
    running[1:] += before[:-1, None]
    ends = running.reshape(-1, width).take(np.append(starts[1:], n) - 1, axis=0)
    ends[1:] -= ends[:-1].copy()
    return ends


class Network:
    """Embeddings by place, a hidden layer, and for each digit its weights, the gates that the digits before
    it put on the hidden layer, and what they add to the digit.

    It works on runs of tokens: texts laid end to end with the edge token twice between them, and
    ``REACH`` more tokens on both ends, which are only looked at.
    """

    def __init__(self, weights: np.ndarray | None = None, size: int = VOCABULARY, counts: np.ndarray | None = None):
        self.size, low = size, 1
        while size > DIGIT ** (low + 1):
            low += 1
        #: What a token is divided by to get the digits up to each, and how many values each has.
        self.units = [DIGIT**k for k in range(low, -1, -1)]
        self.bases = [-(-size // self.units[0])] + [DIGIT] * low
        shapes = {"embed": (size, len(PLACES) * HIDDEN)}
        for k, base in enumerate(self.bases):
            shapes[f"out{k}"] = (HIDDEN, base)
            shapes[f"shift{k}"] = (-(-size // self.units[k - 1]) if k else 1, base)
            if k:
                shapes[f"gate{k}"] = (-(-size // self.units[k - 1]), HIDDEN)
        sizes = {k: int(np.prod(s)) for k, s in shapes.items()}
        self.weights = np.empty(sum(sizes.values()), dtype=np.float32)
        at = 0
        for name, shape in shapes.items():
            setattr(self, name, self.weights[at : at + sizes[name]].reshape(shape))
            at += sizes[name]
        n = range(len(self.bases))
        self.out, self.shift = [getattr(self, f"out{k}") for k in n], [getattr(self, f"shift{k}") for k in n]
        self.gate = [None, *(getattr(self, f"gate{k}") for k in n[1:])]
        if weights is not None:
            self.weights[:] = weights
            return
        draw = np.random.default_rng(7)
        for name, shape in shapes.items():
            getattr(self, name)[:] = 1 if name.startswith("gate") else 0 if name.startswith("shift") else draw.standard_normal(shape) * 0.1
        # Without a context a token has the probability that its count says.
        counts = np.ones(size) if counts is None else counts + 0.5
        for unit, base, shift in zip(self.units, self.bases, self.shift, strict=True):
            summed = np.add.reduceat(counts, np.arange(0, size, unit)).reshape(-1, base)
            shift[:] = np.log(summed / summed.sum(axis=1, keepdims=True))

    def digits(self, token: np.ndarray) -> list[np.ndarray]:
        return [token // u % b for u, b in zip(self.units, self.bases, strict=True)]

    def forward(self, laid: np.ndarray):
        """The hidden layer, and for each digit its gates, layer and probabilities, given the tokens around and the digits before."""
        token, n = laid[REACH:-REACH], len(laid) - 2 * REACH
        seen = self.embed.take(laid, axis=0)
        total = seen[REACH + PLACES[0] : REACH + PLACES[0] + n, :HIDDEN].copy()
        for p, place in enumerate(PLACES[1:], 1):
            total += seen[REACH + place : REACH + place + n, p * HIDDEN : (p + 1) * HIDDEN]
        hidden = np.tanh(total, out=total)
        gates, layers, chances = [], [], []
        for k, base in enumerate(self.bases):
            before = token // self.units[k - 1] if k else None
            gates.append(self.gate[k].take(before, axis=0) if k else None)
            layers.append(hidden * gates[k] if k else hidden)
            x = layers[k] @ self.out[k]
            x += self.shift[k].take(before, axis=0) if k else self.shift[0]
            np.exp(np.clip(x, -FAR, FAR, out=x), out=x)
            x /= (x @ np.ones(base, dtype=np.float32))[:, None]
            chances.append(x)
        return hidden, gates, layers, chances

    def log_probability(self, laid: np.ndarray) -> np.ndarray:
        """Of each token but those at the ends; meaningless for edges."""
        *_, chances = self.forward(laid)
        token = laid[REACH:-REACH]
        rows = np.arange(len(token))
        return sum(np.log(p[rows, d]) for p, d in zip(chances, self.digits(token), strict=True))

    def learn(self, laid: np.ndarray, rate: float) -> None:
        """One step of gradient descent on a run of tokens."""
        token, n = laid[REACH:-REACH], len(laid) - 2 * REACH
        rows, edges = np.arange(n), np.flatnonzero(token == self.size - 1)
        hidden, gates, layers, grads = self.forward(laid)
        order = np.argsort(laid.astype(np.uint16) if self.size <= 1 << 16 else laid, kind="stable")  # short keys are sorted by radix
        inner = order[(order >= REACH) & (order < REACH + n)][: n - len(edges)] - REACH  # edges sort last
        laid_out = token[inner]
        g_hidden, step = 0, rate / max(1, len(inner))
        # What belongs to single tokens or digits moves by the mean over its own occurrences, damped for rare ones.
        for k, (g, digit) in enumerate(zip(grads, self.digits(token), strict=True)):
            g[rows, digit] -= 1
            g[edges] = 0
            back = g @ self.out[k].T
            if k:
                own = np.concatenate([back * hidden, g], axis=1).take(inner, axis=0)
                back *= gates[k]
                met, starts, counts = _runs(laid_out // self.units[k - 1])
                moved = _sums(own, starts)
                moved *= (rate / (counts + np.float32(DAMP)))[:, None].astype(np.float32)
                self.gate[k][met] -= moved[:, :HIDDEN]
                self.shift[k][met] -= moved[:, HIDDEN:]
            else:
                self.shift[0] -= step * (np.ones(n, dtype=np.float32) @ g)
            g_hidden = g_hidden + back
            self.out[k] -= step * (layers[k].T @ g)
        g_hidden *= 1 - hidden * hidden
        spread = np.zeros((len(laid), len(PLACES) * HIDDEN), dtype=np.float32)
        for p, place in enumerate(PLACES):
            spread[REACH + place : REACH + place + n, p * HIDDEN : (p + 1) * HIDDEN] = g_hidden
        met, starts, counts = _runs(laid[order])
        moved = _sums(spread.take(order, axis=0), starts)
        moved *= (rate / (counts + np.float32(DAMP)))[:, None].astype(np.float32)
        self.embed[met] -= moved


@dataclass
class Vocabulary:
    """``held``: the most frequent words, of which the first have a token each and the others their
    share of a hashed token; ``rest``: (word, share) of all other words of the corpus, a table."""

    size: int
    held: list[bytes]
    shares: np.ndarray
    rest: DataFrame
    #: ln P(word | token) of a word that the corpus lacks, by hashed token.
    unmet: np.ndarray
    #: How often each token occurs in the corpus.
    counts: np.ndarray

    @property
    def hashed(self) -> int:
        return self.size // HASHED

    @property
    def own(self) -> int:
        """Words with a token of their own."""
        return min(len(self.held), self.size - 1 - self.hashed)

    @property
    def tokens(self) -> np.ndarray:
        """Token of each held word."""
        return np.array([self.hashed + i for i in range(self.own)] + [zlib.crc32(w) % self.hashed for w in self.held[self.own :]], dtype=np.int32)


class _Places(dict):
    """Word -> place among the held words; others are noted and get -1 - hashed token."""

    def __init__(self, words: list[bytes], hashed: int):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.hashed, self.missed = hashed, []

    def __missing__(self, word: bytes) -> int:
        self.missed.append(word)
        return -1 - zlib.crc32(word) % self.hashed


def tokens_of(places: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    out = -1 - places
    inside = places >= 0
    out[inside] = tokens[places[inside]]
    return out


def vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts of all words, ties by word.

    Words are counted in each task as far as its memory allows, then by a shuffle.  As many tokens
    as the square root of all words, and HELD times as many words held as long as these fit in
    CACHE_ENTRIES; how often each count occurs tells which words these are, so that no more of them
    are collected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                seen.update(bytes(text.as_buffer()).lower().split() if text.is_valid else ())
                if len(seen) > CACHE_ENTRIES:
                    yield flush()
        yield flush()

    counted = materialize(docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    often = sorted(counted.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True)
    size = whole(max(VOCABULARY, math.isqrt(sum(r.n * r.words for r in often))))
    hashed = size // HASHED
    least, room = None, max(size - 1 - hashed, min(HELD * size, CACHE_ENTRIES))
    for r in often:
        room -= r.words
        if room < 0:
            break
        least = r.n
    own = size - 1 - hashed
    held = sorted(((bytes(r.word), r.n) for r in counted.where(F.col("n") >= least).collect()), key=lambda r: (-r[1], r[0])) if least is not None else []
    # What hashed tokens count in all: held words without a token, all other words, and one for the words that the corpus lacks.
    totals = np.ones(hashed)
    for w, n in held[own:]:
        totals[zlib.crc32(w) % hashed] += n
    token = F.pmod(F.crc32("word"), F.lit(hashed)).cast("int")
    others = counted if least is None else counted.where(F.col("n") < least)
    for r in others.groupBy(token.alias("token")).agg(F.sum("n").alias("n")).collect():
        totals[r.token] += r.n
    shares = np.array([0.0] * min(own, len(held)) + [math.log(n / totals[zlib.crc32(w) % hashed]) for w, n in held[own:]])
    unmet = -np.log(totals)
    of_token = docs.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(unmet)], "token int, unmet double")
    rest = others.withColumn("token", token).join(F.broadcast(of_token), "token").select("word", (F.log("n") + F.col("unmet")).alias("share"))
    counts = np.zeros(size)
    counts[:hashed] = totals - 1
    counts[hashed : hashed + len(held[:own])] = [n for _, n in held[:own]]
    return Vocabulary(size, [w for w, _ in held], shares, rest, unmet, counts)


def tokenize(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, text) rows as ``row``, ``doc_id``, ``places`` (packed: each word's place among the held ones,
    or -1 - its hashed token) and ``rare`` (the words that aren't held), kept in the shared folder."""
    hashed, shared = words.hashed, docs.sparkSession.sparkContext.broadcast(words.held)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Places(shared.value, hashed)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, places, ends = batch.slice(at, 256), [], [0]
                for text in part.column(1):
                    met = bytes(text.as_buffer()).lower().split() if text.is_valid else []
                    places.append(np.fromiter(map(known.__getitem__, met), dtype=np.int32, count=len(met)).tobytes())
                    ends.append(len(known.missed))
                rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(known.missed, pa.binary()))
                known.missed.clear()
                yield pa.record_batch([part.column(0), pa.array(places, pa.binary()), rare], names=["doc_id", "places", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, places binary, rare array<binary>").withColumn("row", F.monotonically_increasing_id()))


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(p.as_buffer(), dtype=np.int32) for p in column]


def train(tokenized: DataFrame, words: Vocabulary, rounds: int = 1) -> np.ndarray:
    """Weights of the network after ``rounds`` passes over the corpus.

    So many tasks at most that the weights they hand in are no larger than the tokens they read.
    These are averaged by their tokens, slice by slice, FAN tasks' weights first and then the averages.
    """
    context, size = tokenized.sparkSession.sparkContext, words.size
    shared = context.broadcast(words.tokens)
    weights = Network(size=size, counts=words.counts).weights
    slices = int(tokenized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = tokenized.select("places").coalesce(max(1, int(words.counts.sum()) // len(weights)))
    for _ in range(rounds):
        start = context.broadcast(weights.tobytes())

        def descend(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            net = Network(np.frombuffer(start.value, dtype=np.float32), size)
            gap = np.full(REACH, size - 1, dtype=np.int32)
            laid, done = [gap], 0

            def step(whole: bool) -> None:
                """Learns from all full batches of what is laid out, or from all of it."""
                nonlocal laid, done
                run, at = np.concatenate(laid), 0
                while len(run) - at - 2 * REACH >= (1 if whole else BATCH):
                    part = run[at : at + BATCH + 2 * REACH]
                    n = len(part) - 2 * REACH
                    net.learn(part, RATE / (1 + done / 2_000_000) * n / BATCH)
                    done, at = done + n, at + n
                laid = [run[at:]]

            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    for places in _unpacked(batch.column(0).slice(at, 256)):
                        if len(places):
                            laid += [tokens_of(places, shared.value), gap]
                    step(False)
            step(True)
            if done:
                for at in range(0, len(net.weights), SLICE * 64):
                    cut = [net.weights[k : k + SLICE].tobytes() for k in range(at, min(at + SLICE * 64, len(net.weights)), SLICE)]
                    yield pa.record_batch([pa.array(np.arange(len(cut), dtype=np.int32) + at // SLICE), pa.array(cut, pa.binary()), pa.array([float(done)] * len(cut))], names=["slice", "w", "n"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[tuple[int, int], tuple[np.ndarray, float]] = {}
            for batch in batches:
                for k, g, w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                    before = totals.get((k, g), (0.0, 0.0))
                    totals[k, g] = before[0] + n * np.frombuffer(w.as_buffer(), dtype=np.float32).astype(float), before[1] + n
            for (k, _), (total, n) in totals.items():
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary()), pa.array([n])], names=["slice", "w", "n"])

        kind = "slice int, w binary, n double"
        parts = read.mapInArrow(descend, kind).select("slice", F.expr(f"spark_partition_id() div {FAN}").cast("int").alias("group"), "w", "n")
        some = parts.repartition(slices, "slice", "group").mapInArrow(average, kind).select("slice", F.lit(0).alias("group"), "w", "n")
        final = some.repartition(slices, "slice").mapInArrow(average, kind).select("slice", "w").collect()
        if final:
            weights = np.frombuffer(b"".join(bytes(r.w) for r in sorted(final, key=lambda r: r.slice)), dtype=np.float32)
    return weights


def score(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 1) -> DataFrame:
    """One row per row of df: ``doc_id``, ``n_tokens``, ``log_likelihood`` (natural, summed over
    tokens) and ``per_token``.

    The model is trained on the texts of df themselves.  A null or blank text has no tokens, a sum
    of 0 and a null ``per_token``; repeated rows count and score alike up to rounding; words that are
    equally frequent are ranked by their bytes; an empty table gives an empty table; further columns
    are left behind.
    """
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"))
    words = vocabulary(docs)
    tokenized = tokenize(docs, words)
    return apply_model(tokenized, words, train(tokenized, words, rounds))


def apply_model(tokenized: DataFrame, words: Vocabulary, weights: np.ndarray) -> DataFrame:
    """Scores the rows that :func:`tokenize` gives with a trained network."""
    context, size, hashed = tokenized.sparkSession.sparkContext, words.size, words.hashed
    shared, model = context.broadcast((words.tokens, words.shares)), context.broadcast(weights.tobytes())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shares = shared.value
        net = Network(np.frombuffer(model.value, dtype=np.float32), size)
        gap = np.full(REACH, size - 1, dtype=np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                places = _unpacked(part.column(2))
                run = np.concatenate([gap, *(x for p in places for x in (tokens_of(p, tokens), gap))])
                n = len(run) - 2 * REACH
                logs = np.concatenate([net.log_probability(run[k : k + BATCH + 2 * REACH]) for k in range(0, n, BATCH)] or [np.zeros(0)]).astype(np.float64)
                logs = logs[run[REACH : n + REACH] != size - 1]
                met = np.concatenate(places)
                inside = met >= 0
                logs[inside] += shares[met[inside]]
                counts = np.array([len(p) for p in places])
                ends = np.concatenate([[0], np.cumsum(logs)])
                last = np.cumsum(counts)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(ends[last] - ends[last - counts])], names=["row", "doc_id", "n_tokens", "sum"])

    kind = tokenized.schema["doc_id"].dataType.simpleString()
    judged = tokenized.select("row", "doc_id", "places").mapInArrow(judge, f"row long, doc_id {kind}, n_tokens long, sum double")
    of_token = tokenized.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(words.unmet)], "token int, unmet double")
    met = tokenized.select("row", F.explode("rare").alias("word")).withColumn("token", F.pmod(F.crc32("word"), F.lit(hashed)).cast("int"))
    met = met.join(words.rest, "word", "left").join(F.broadcast(of_token), "token")
    rare = met.groupBy("row").agg(F.sum(F.coalesce("share", "unmet")).alias("shares"))
    scored = judged.join(rare, "row", "left").withColumn("log_likelihood", F.col("sum") + F.coalesce("shares", F.lit(0.0)))
    per = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.select("doc_id", "n_tokens", "log_likelihood", per.alias("per_token"))


__all__ = ["Network", "Vocabulary", "apply_model", "score", "tokenize", "train", "vocabulary"]
