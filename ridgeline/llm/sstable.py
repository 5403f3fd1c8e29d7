"""Token ids as sorted-string tables.

A shard holds documents in ascending key order:

    data blocks | block index | Bloom filter | footer

* key: 9 bytes, 0x00 for a null identifier or 0x01 and the identifier as big-endian integer with
  its sign bit turned, so that byte order is numeric order.  Equal keys may repeat.
* data block (closed at ``BLOCK_BYTES``), zstandard-compressed: entries of
  u8 shared key bytes with the entry before, u8 further key bytes, u32 number of ids, the further
  key bytes, and the ids in the width named by the footer (2 or 4 bytes, little-endian).
* block index: for each block 9 bytes last key, u64 offset, u32 compressed bytes, u32 raw bytes,
  u64 ids before the block.
* Bloom filter: 10 bits a key, 7 probes.
* footer (64 bytes): u64 index offset, u64 blocks, u64 filter offset, u64 filter bits, u64
  documents, u64 ids, u32 id width, 4 bytes zero, 8 bytes magic.

A lookup reads the footer, asks the filter, finds the block by binary search in the index and
scans that one block.
"""

from __future__ import annotations

import bisect
import gc
import hashlib
import struct
import uuid
import zlib
from array import array
from unicodedata import is_normalized
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.bpe import byte_letters
from ridgeline.llm.common import delete_at_exit, materialize, only, shared_dir

MAGIC = b"RLSSTAB1"
BLOCK_BYTES = 64 << 10
#: A shard is closed beyond so many bytes of blocks, so a reader can hold it.
SHARD_BYTES = 32 << 20
ENTRY = struct.Struct("<BBI")
INDEX = struct.Struct("<9sQIIQ")
FOOTER = struct.Struct("<6QI4x8s")
BITS_A_KEY, PROBES = 10, 7
#: Entries that a task's dictionary of words may hold before it is emptied.
CACHE_ENTRIES = 1_200_000
#: Words of more bytes aren't kept in it.
LONG_WORD = 64
#: Bytes of text that are encoded together.
PORTION = 4 << 20
BYTE_LETTERS = {b: letter for letter, b in byte_letters().items() if b != 0x20}


def key_of(identifier: int | None) -> bytes:
    return b"\0" * 9 if identifier is None else b"\1" + struct.pack(">Q", (identifier + (1 << 63)) & (1 << 64) - 1)


def identifier_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * (b | 1)) % (1 << 64) % bits for i in range(PROBES)]


class ShardWriter:
    """Writes one shard to a binary stream; holds one block and the index in memory."""

    def __init__(self, stream, width: int):
        import zstandard

        self.stream, self.width = stream, width
        self.pack = zstandard.ZstdCompressor(level=1)
        self.block, self.raw, self.last = [], 0, b""
        self.index: list[tuple] = []
        self.keys: list[bytes] = []
        self.at = self.ids = self.block_ids = self.docs = 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        shared = 0
        while self.block and shared < 9 and key[shared] == self.last[shared]:
            shared += 1
        body = ids.astype(f"<u{self.width}").tobytes()
        self.block += [ENTRY.pack(shared, 9 - shared, len(ids)), key[shared:], body]
        self.raw += ENTRY.size + 9 - shared + len(body)
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
        self.last = key
        self.docs += 1
        self.ids += len(ids)
        if self.raw >= BLOCK_BYTES:
            self._close_block()

    def _close_block(self) -> None:
        if self.block:
            packed = self.pack.compress(b"".join(self.block))
            self.stream.write(packed)
            self.index.append((self.last, self.at, len(packed), self.raw, self.block_ids))
            self.at += len(packed)
            self.block, self.raw, self.block_ids = [], 0, self.ids

    def close(self) -> None:
        self._close_block()
        index_at = self.at
        self.stream.write(b"".join(INDEX.pack(*x) for x in self.index))
        bits = max(64, BITS_A_KEY * len(self.keys))
        field = np.zeros(-(-bits // 8), dtype=np.uint8)
        for key in self.keys:
            for p in _probes(key, bits):
                field[p >> 3] |= 1 << (p & 7)
        self.stream.write(field.tobytes())
        self.stream.write(FOOTER.pack(index_at, len(self.index), index_at + INDEX.size * len(self.index), bits, self.docs, self.ids, self.width, MAGIC))


class ShardReader:
    """Reads a shard from anything with size(), seek() and read()."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor()
        size = source.size()
        if size < FOOTER.size:
            raise ValueError("not a shard: too short")
        self.index_at, self.blocks, self.filter_at, self.bits, self.docs, self.ids, self.width, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard: wrong magic")
        raw = self._read(self.index_at, INDEX.size * self.blocks)
        self.index = [INDEX.unpack_from(raw, i * INDEX.size) for i in range(self.blocks)]
        self.field: bytes | None = None

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, at, packed, raw, _ = self.index[i]
        data = self.unpack.decompress(self._read(at, packed), max_output_size=raw)
        pos, key = 0, b""
        while pos < len(data):
            shared, further, count = ENTRY.unpack_from(data, pos)
            pos += ENTRY.size
            key = key[:shared] + data[pos : pos + further]
            pos += further
            yield key, np.frombuffer(data, dtype=f"<u{self.width}", count=count, offset=pos)
            pos += count * self.width

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(self.blocks):
            for key, ids in self.block(i):
                yield identifier_of(key), ids

    def may_hold(self, key: bytes) -> bool:
        if self.field is None:
            self.field = self._read(self.filter_at, -(-self.bits // 8))
        return all(self.field[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits))

    def lookup(self, identifier: int | None) -> list[np.ndarray]:
        """The ids of every document with this identifier."""
        key, found = key_of(identifier), []
        if self.may_hold(key):
            for i in range(bisect.bisect_left(self.index, key, key=lambda x: x[0]), self.blocks):
                entries = list(self.block(i))
                found += [ids for k, ids in entries if k == key]
                if entries[-1][0] > key:
                    break
        return found


class WordIds(dict):
    """Word -> packed ids, from the library's own encoder.

    The vocabulary's normaliser and splitter treat blanks as borders that no token and no
    composed character crosses, so a text's ids are its words' ids in a row.  Likewise letters
    and the comma or full stop behind them are encoded apart.  Words of letters alone are encoded
    many in a call; small composed letters pass the normaliser unchanged, so they go round it, in
    the letters that stand for their bytes in the vocabulary.
    """

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = tokenizer
        self.bare = Tokenizer(tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        names = tokenizer.get_vocab()
        self.closes = np.zeros(max(names.values()) + 1, dtype=bool)
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.pending: set[bytes] = set()
        self.gaps: list[int] = []
        self.left = iter(())
        self.loose: set[bytes] = set()  # the rare words of letters whose small form isn't letters alone
        self.marks = {m: self._alone([m])[0] for m in (b",", b".")}

    def __missing__(self, word: bytes) -> None:
        self.pending.add(word)
        self.gaps.append(self.left.__length_hint__() + 1)

    def look_up(self, words: list[bytes]) -> tuple[list[bytes | None], list[int]]:
        """What is known of each word, and the places (from the end) of words that aren't yet."""
        self.gaps, self.left = [], iter(words)
        return list(map(self.__getitem__, self.left)), self.gaps

    def _alone(self, words: list[bytes]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def _lines(self, words: list[bytes], tokenizer) -> None:
        """Learns words of letters, 200 in a line.  Each yields one closing token at least; a line
        with more of them than words (a letter that its small form takes apart) is taken word by word."""
        write = (lambda line: line.decode("latin-1").translate(BYTE_LETTERS)) if tokenizer is self.bare else bytes.decode
        for at in range(0, len(words), 20_000):
            lines = [words[i : i + 200] for i in range(at, min(at + 20_000, len(words)), 200)]
            for line, found in zip(lines, tokenizer.encode_batch_fast([write(b" ".join(x)) for x in lines], add_special_tokens=False), strict=True):
                ids = np.array(found.ids, dtype="<u4")
                ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
                if len(ends) != len(line):
                    for word, packed in zip(line, self._alone(line), strict=True):
                        self[word] = packed
                        if self.closes[np.frombuffer(packed, dtype="<u4")].sum() != 1:
                            self.loose.add(word)
                    continue
                packed, ends = ids.tobytes(), ends.tolist()
                self.update(zip(line, map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def learn(self, fresh: set[bytes]) -> None:
        marks = self.marks
        marked = [w for w in fresh if w[-1:] in marks and len(w) > 1]
        cores = fresh.difference(marked).union(w[:-1] for w in marked).difference(self)
        plain = [w for w in cores if w.isalpha() and w.islower()]
        rest = [w for w in cores.difference(plain)]
        letters = [w for w in rest if not w.isascii() and w.decode().isalpha()]
        self._lines(plain, self.bare)
        known = set(letters)
        small = [w for w in letters if (s := w.decode()) == s.lower() and is_normalized("NFC", s)]
        self._lines(small, self.bare)
        self._lines(list(known.difference(small)), self.tokenizer)
        odd = [w for w in rest if w not in known]
        # A mark behind anything but letters may form one piece with it.
        apart = {*plain, *known}
        alone = [w for w in odd if w in fresh]
        alone += [w for w in marked if w[:-1] in self.loose or w[:-1] not in apart and not (w[:-1] in self and w[:-1].decode().isalpha())]
        for at in range(0, len(alone), 20_000):
            part = alone[at : at + 20_000]
            self.update(zip(part, self._alone(part), strict=True))
        for w in marked:
            if w not in self:
                self[w] = self[w[:-1]] + marks[w[-1:]]


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(model: str) -> WordIds:
    """One dictionary for each Python worker; it outlives the task."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = hashlib.sha256(model.encode()).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordIds(Tokenizer.from_str(model))
    return _TOKENIZERS[key]


def encode_words(texts: list[bytes], known: WordIds) -> list[bytes]:
    """Packed ids (little-endian unsigned 32-bit) of each UTF-8 text.

    The vocabulary makes letters small.  A-Z may be made small beforehand where no combining mark
    (U+0300 to U+036F) could have joined with one and no special token could arise.
    """
    split = [(t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower()).split() for t in texts]
    # One lookup a word: words that aren't known yet leave a gap, which is filled once all are learnt.
    found = [known.look_up(ws) for ws in split]
    fresh, known.pending = known.pending, set()
    if len(known) + len(fresh) > CACHE_ENTRIES:
        known.clear()
    if fresh:
        known.learn(fresh)
    for ws, (ids, gaps) in zip(split, found, strict=True):
        for at in gaps:
            ids[-at] = known[ws[-at]]
    packed = [b"".join(ids) for ids, _ in found]
    for word in fresh:
        if len(word) > LONG_WORD:
            del known[word]
    return packed


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts in runs of about PORTION bytes of text, whatever the texts' lengths."""
    for batch in batches:
        names, texts, size = [], [], 0
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            names.append(name)
            texts.append(bytes(text.as_buffer()) if text.is_valid else b"")
            size += len(texts[-1])
            if size >= PORTION:
                yield names, texts
                names, texts, size = [], [], 0
        yield names, texts


def write_shards(df: DataFrame, tokenizer_file: str, folder: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> DataFrame:
    """Encodes every text, appends ``end_id``, and writes shards in ascending id order.

    Returns the manifest: ``path``, ``part``, ``shard``, ``n_docs``, ``n_ids``.  Rows with a null
    id come first, repeated ids stand side by side (ordered by their texts' hashes), a null text
    is encoded as an empty one, an empty table gives no shards.

    Rows are dealt by ranges of ids that hold about equally many rows.  A task writes to a name
    of its own attempt and renames the finished file, so a lost or repeated task leaves the same
    shards.
    """
    import pyarrow.fs  # noqa: F401

    spark = df.sparkSession
    if folder is None:
        folder = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
        delete_at_exit(spark, folder)
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder[5:]
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # about 2 MB, fixed by the file

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        known = word_ids(shared.value)
        width = 2 if known.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        end = np.array([end_id], dtype="<u4").tobytes()
        made: list[tuple] = []
        writer = stream = None

        def finish() -> None:
            writer.close()
            stream.close()
            name = f"{root}/part-{part:06d}-{len(made):04d}.sst"
            store.move(f"{root}/_attempt-{attempt}", name)
            made.append((name, part, len(made), writer.docs, writer.ids))

        gc.disable()  # millions of words come and go and none is part of a cycle
        try:
            for names, texts in _portions(batches):
                for i, ids in zip(names, encode_words(texts, known), strict=True):
                    if writer is None:
                        stream = store.open_output_stream(f"{root}/_attempt-{attempt}")
                        writer = ShardWriter(stream, width)
                    writer.add(key_of(i), np.frombuffer(ids + end, dtype="<u4"))
                    if writer.at >= SHARD_BYTES:
                        finish()
                        writer = None
        finally:
            gc.enable()
        if writer is not None:
            finish()
        columns = list(zip(*made, strict=True)) or [[]] * 5
        yield pa.record_batch([pa.array(columns[0], pa.string())] + [pa.array(c, pa.int64()) for c in columns[1:]], names=["path", "part", "shard", "n_docs", "n_ids"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    # The borders come from a pass over the ids alone; a range exchange would read the texts twice.
    borders = source.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0] if parts > 1 else None
    part = F.size(F.filter(F.lit(sorted(set(borders))), lambda x: x < F.col("doc_id"))) if borders else F.lit(0)
    placed = source.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part))
    ordered = placed.repartitionById(parts, "part").sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = ordered.select("doc_id", "text").mapInArrow(write, "path string, part long, shard long, n_docs long, n_ids long")
    return materialize(manifest).withColumn("folder", F.lit(folder))


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, read from the files alone: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit)."""
    return _scan(manifest, False)


def digest_shards(manifest: DataFrame) -> DataFrame:
    """Like :func:`read_shards`, with ``ids_crc32`` in place of the ids."""
    return _scan(manifest, True)


def _scan(manifest: DataFrame, digest: bool) -> DataFrame:
    # One row per shard of up to 32 MB: the ids before it come from a running sum over the manifest.
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("folder", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder, path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, _ = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)
                with store.open_input_file(path) as source:
                    at, rows = base, []
                    for i, ids in ShardReader(source):
                        packed = ids.astype("<u4").tobytes()
                        rows.append((i, at, len(ids), zlib.crc32(packed) if digest else packed))
                        at += len(ids)
                        if len(rows) >= 1024:
                            yield _rows(rows, digest)
                            rows = []
                    yield _rows(rows, digest)

    last = "ids_crc32 long" if digest else "ids binary"
    spread = placed.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return spread.mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}")


def _rows(rows: list[tuple], digest: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])


def encode_ordered(df: DataFrame, tokenizer_file: str, folder: str | None = None, **options) -> DataFrame:
    """Writes the shards, reads them back, and returns their digests (see :func:`digest_shards`)."""
    return digest_shards(write_shards(only(df, **{"doc_id": options.pop("id_col", "doc_id"), "text": options.pop("text_col", "text")}), tokenizer_file, folder, **options))
