"""Byte-pair encoding and decoding by dynamic programming over prefixes.

A byte-level vocabulary whose ids ascend in merge order has, for every prefix of a piece,
exactly one token that can end its encoding.  An automaton over the vocabulary lists the tokens
that end at each position; the one whose predecessor (the stored last token of the shorter
prefix) may stand before it is stored.  Following the stored tokens backwards gives the ids,
without applying a single merge to the text.

Two neighbouring tokens may stand side by side if no merge that comes before the ones that
formed them would have joined across their border; this is tested by undoing the two tokens'
own merges, latest first, along the border.

Pieces repeat, so each task keeps a bounded dictionary of piece -> packed ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm.common import only

#: How the public byte-level scheme cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a task's dictionaries may hold before they are emptied.
CACHE_ENTRIES = 300_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file, reversed."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> dict:
    """Token bytes by id, the pair each merged token came from, and the special tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    tokens: list[bytes] = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in ids.items():
        tokens[i] = bytes(letters[c] for c in token)
    merges = []
    for merge in spec["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((ids[left], ids[right], ids[left + right]))
    if any(b[2] <= a[2] for a, b in zip(merges, merges[1:], strict=False)):
        raise ValueError("the ids of merged tokens must ascend in merge order")
    for content, i in special.items():
        tokens[i] = content.encode()
    return {"tokens": tokens, "merges": merges, "special": special}


class PrefixEncoder:
    """Encodes texts as a byte-level vocabulary does, one stored token per prefix."""

    def __init__(self, vocabulary: dict):
        import ahocorasick
        import regex

        self.tokens: list[bytes] = vocabulary["tokens"]
        special = vocabulary["special"]
        n = len(self.tokens)
        self.left, self.right = list(range(n)), list(range(n))
        self.joined: dict[tuple[int, int], int] = {}
        for left, right, whole in vocabulary["merges"]:
            self.left[whole], self.right[whole] = left, right
            self.joined[left, right] = whole
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(self.tokens):
            if token and i not in special.values():
                self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.special = {s: np.array([i], dtype="<u4").tobytes() for s, i in special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.pieces = regex.compile(PIECES)
        self.fits: dict[tuple[int, int], bool] = {}
        self.known = _Known(self)

    def compatible(self, first: int, second: int) -> bool:
        """Whether the encoding of the two tokens' joint bytes keeps them as they are."""
        bound = len(self.tokens)
        a, b = first, second
        while True:
            whole = self.joined.get((a, b))
            if whole is not None and whole < bound:
                return False
            # Undo the later merge of the two; a single byte can't be undone, then the other one is.
            undo_left = a > b
            if undo_left and self.right[a] == a or not undo_left and self.left[b] == b:
                undo_left = not undo_left
                if undo_left and self.right[a] == a or not undo_left and self.left[b] == b:
                    return True
            if undo_left:
                bound, a = a, self.right[a]
            else:
                bound, b = b + 1, self.left[b]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        last = [-1] * (len(piece) + 1)
        width = [0] * (len(piece) + 1)
        fits = self.fits
        for end, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                pair = (last[start], token)
                fit = fits.get(pair)
                if fit is None:
                    if len(fits) >= CACHE_ENTRIES:
                        fits.clear()
                    fit = fits[pair] = self.compatible(*pair)
                if not fit:
                    continue
            last[end], width[end] = token, size
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) >= CACHE_ENTRIES:
            self.known.clear()
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(self.known.__getitem__, self.pieces.findall(text)))
        parts = []
        for part in self.cut.split(text):
            parts.append(self.special[part] if part in self.special else b"".join(map(self.known.__getitem__, self.pieces.findall(part))))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """Text of packed ids, special tokens included; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


class _Known(dict):
    """Packed ids of the pieces met so far."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode_piece(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= 64:  # a long piece hardly comes again and would make the bound in entries worthless
            self[piece] = ids
        return ids


_ENCODERS: dict[str, PrefixEncoder] = {}


def _encoder(broadcast, key: str) -> PrefixEncoder:
    """One encoder for each Python worker; it outlives the task."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PrefixEncoder(broadcast.value)
    return _ENCODERS[key]


def _shared_vocabulary(spark: SparkSession, path: str):
    """The vocabulary is broadcast (about 1 MB, fixed by the file, not by the data), so executors need no file."""
    with open(path, "rb") as f:
        key = hashlib.sha256(f.read()).hexdigest()
    return spark.sparkContext.broadcast(load_vocabulary(path)), key


def encode_texts(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: ``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit).

    A null text is encoded like an empty one, as no ids.  Rows with null or repeated ids keep
    their own row; further columns are left behind; an empty table gives an empty table.
    No shuffle: each task encodes what it scans.
    """
    vocabulary, key = _shared_vocabulary(df.sparkSession, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, key)
        for batch in batches:
            for part in _slices(batch):
                ids = [encoder.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    source = only(df, doc_id=id_col, text=text_col)
    return source.mapInArrow(encode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_ids(df: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of df: ``doc_id``, ``text``; null ids give an empty text."""
    vocabulary, key = _shared_vocabulary(df.sparkSession, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, key)
        for batch in batches:
            for part in _slices(batch):
                texts = [encoder.decode(i.as_py() or b"") for i in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    source = only(df, doc_id=id_col, ids=ids_col)
    return source.mapInArrow(decode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    Null and empty texts: no tokens, digests of nothing.  Same rows as df, in any order.
    """
    vocabulary, key = _shared_vocabulary(df.sparkSession, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, key)
        for batch in batches:
            for part in _slices(batch):
                counts, first, second = [], [], []
                for text in part.column(1):
                    ids = encoder.encode(text.as_py() or "")
                    counts.append(len(ids) // 4)
                    first.append(hashlib.sha256(ids).hexdigest())
                    second.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
                yield pa.record_batch([part.column(0), pa.array(counts, pa.int64()), pa.array(first), pa.array(second)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = only(df, doc_id=id_col, text=text_col)
    return source.mapInArrow(digest, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short runs of a batch: the results of a run are held in memory, so a run must stay small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
