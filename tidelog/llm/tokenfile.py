"""Token ids in binary shards: independent zstandard frames, a trailing seek table, checksums.

A shard is one frame per document (little-endian unsigned 32-bit ids, content checksum),
then two skippable frames, which any zstandard decoder passes over: the doc_ids, and the
seek table of the public seekable format (compressed size, decompressed size and low half of
XXH64 for each frame; count, descriptor and magic number as footer). A reader opens the
footer, then decompresses the frames of the documents that it wants and no others.

Shards follow doc_id order: Spark's range partitioning deals out the rows, each partition is sorted,
encoded and written in one task, frame by frame. A shard is written under a name of its own and renamed,
so a task that runs again, or twice at once, leaves one whole file.

Defined results: a null text is an empty one (the end id alone); rows without doc_id come
first; repeated rows are encoded each; an empty table gives no rows; columns besides doc_id
and text are not read. The shared folder must be mounted on every node.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, local_path, new_folder

END_ID = 2
LEVEL = 3
#: Words whose ids a worker keeps, and bytes of text that it encodes at once.
MEMO, ENCODE_BYTES = 500_000, 8 << 20
#: Bytes of input for each shard, as Spark estimates them. The count is bounded, so that at most so many manifest rows reach the driver.
SHARD_BYTES, MOST_SHARDS = 256 << 20, 1 << 20
#: Fixed values of the seekable zstandard format.
SKIPPABLE, SEEK_MAGIC, IDS_FRAME, SEEK_FRAME = 0x184D2A50, 0x8F92EAB1, 0x184D2A51, 0x184D2A5E
_FOOTER = struct.Struct("<IBI")
_HEAD = struct.Struct("<II")
_NO_ID = -(1 << 63)


@lru_cache(1 << 16)
def _ends_as_letter(character: str) -> bool:
    """Is it a letter still when the tokenizer has normalised it; some gain a combining mark."""
    return unicodedata.normalize("NFC", character).lower()[-1].isalpha()


class _Table:
    """Strings, and the ids of each in one growing array."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.first, self.size, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, "<u4"), 0

    def add(self, names: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        k, n, total = len(self.place), len(names), len(ids)
        if k + n > len(self.first):
            self.first, self.size = (np.concatenate([x[:k], np.zeros(k + 2 * n, np.int64)]) for x in (self.first, self.size))
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * total, "<u4")])
        self.size[k : k + n], self.first[k : k + n] = size, self.used + np.cumsum(size) - size
        self.ids[self.used : self.used + total] = ids
        self.used += total
        self.place.update(zip(names, range(k, k + n)))

    def places(self, names: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))

    def spelled(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these strings one after the other, and where each ends."""
        size = self.size[at]
        end = np.cumsum(size)
        return self.ids[np.repeat(self.first[at] - (end - size), size) + np.arange(end[-1] if len(end) else 0)], end

    def forget(self, keep: int) -> None:
        """The later ones go: frequent strings came first."""
        first = list(islice(self.place, keep))
        self.used = int(self.first[len(first) - 1] + self.size[len(first) - 1]) if first else 0
        self.place = dict(zip(first, range(len(first))))


class Encoder:
    """A tokenizer with a memory of the words that it has met.

    The tokenizer joins nothing across a space or a line feed, so words between them are encoded apart. Its
    pre-tokenizer parts a letter from the ASCII punctuation after it, and its added tokens hold `<|`: a word
    without that, of which a letter stands before a tail of such punctuation, is encoded as head and tail.
    Heads of plain letters are one pre-token each, whose last id alone bears the mark of a word's end, so many
    of them are encoded in one call and parted at those ids. Case does not count.
    """

    _TAIL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    _PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff\u0430-\u044f\u0451]+")
    _AT_ONCE = 1000

    def __init__(self, path: str, most: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.words, self.heads = _Table(), _Table()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_heads(self, heads: list[str]) -> None:
        plain = [h for h in heads if self._PLAIN.fullmatch(h)]
        other = [h for h in heads if not self._PLAIN.fullmatch(h)]
        for k in range(0, len(plain), 64 * self._AT_ONCE):
            block = plain[k : k + 64 * self._AT_ONCE]
            ids = np.fromiter(chain.from_iterable(self._encode([" ".join(block[i : i + self._AT_ONCE]) for i in range(0, len(block), self._AT_ONCE)])), "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(block) and ends[-1] == len(ids):
                self.heads.add(block, ids, np.diff(ends, prepend=0))
            else:
                other += block
        for k in range(0, len(other), 20_000):
            each = self._encode(other[k : k + 20_000])
            self.heads.add(other[k : k + 20_000], np.fromiter(chain.from_iterable(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each)))

    def _learn(self, words: list[str]) -> None:
        parts, known = [], self.heads.place
        for w in words:
            h = w.rstrip(self._TAIL)
            if not (h and _ends_as_letter(h[-1]) and "<|" not in w):
                h = w
            parts.append(h.lower() if h.isascii() and "<|" not in h else h)
            parts.append(w[len(h) :])
        self._learn_heads([h for h in dict.fromkeys(parts) if h not in known])
        ids, end = self.heads.spelled(self.heads.places(parts))
        self.words.add(words, ids, np.diff(end[1::2], prepend=0))

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null is an empty text."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "").cast(pa.large_string())
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        flat = parts.flatten().dictionary_encode()
        words = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        for t in (self.words, self.heads):
            if len(t.place) > self.most:
                t.forget(self.most // 2)
        known = self.words.place
        new = [w for w in words if w not in known]
        if new:
            self._learn(new)
        ids, end = self.words.spelled(self.words.places(words)[flat.indices.to_numpy()])
        cuts = np.concatenate([[0], end])[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shard(path: str, frames: Iterator[tuple[int | None, bytes, int, int]]) -> tuple[int, int]:
    """frames: (doc_id, frame, decompressed size, checksum). Returns documents and ids."""
    ids, table, total = [], [], 0
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        for doc_id, frame, size, check in frames:
            f.write(frame)
            ids.append(_NO_ID if doc_id is None else doc_id)
            table.append((len(frame), size, check))
            total += size // 4
        own = np.array(ids, "<i8").tobytes()
        f.write(_HEAD.pack(IDS_FRAME, len(own)) + own)
        entries = np.array(table, "<u4").reshape(-1, 3).tobytes()
        f.write(_HEAD.pack(SEEK_FRAME, len(entries) + _FOOTER.size) + entries + _FOOTER.pack(len(ids), 0x80, SEEK_MAGIC))
    os.replace(part, path)
    return len(ids), total


class ShardReader:
    """Random access to one shard: doc_ids, sizes, and the ids of any one document."""

    def __init__(self, path: str):
        self.file = open(path, "rb")
        end = self.file.seek(0, 2)
        self.file.seek(end - _FOOTER.size)
        n, descriptor, magic = _FOOTER.unpack(self.file.read(_FOOTER.size))
        if magic != SEEK_MAGIC or descriptor != 0x80:
            raise ValueError(f"{path} has no seek table")
        at = end - _FOOTER.size - 12 * n
        self.file.seek(at)
        self.table = np.frombuffer(self.file.read(12 * n), "<u4").reshape(-1, 3)
        self.file.seek(at - _HEAD.size - 8 * n)
        self.doc_ids = np.frombuffer(self.file.read(8 * n), "<i8")
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        self.n_tokens = self.table[:, 1].astype(np.int64) // 4
        self._zstd = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.doc_ids)

    def doc_id(self, i: int) -> int | None:
        return None if self.doc_ids[i] == _NO_ID else int(self.doc_ids[i])

    def raw(self, i: int) -> bytes:
        self.file.seek(self.offsets[i])
        out = self._zstd.decompress(self.file.read(int(self.table[i, 0])), max_output_size=int(self.table[i, 1]))
        if xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"checksum of frame {i} differs")
        return out

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), "<u4")

    def close(self) -> None:
        self.file.close()


def _frames(batches, path: str) -> Iterator[tuple[int | None, bytes, int, int]]:
    """(doc_id, frame, decompressed size, checksum) of each row, in order."""
    zstd, tail, encode = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True), np.array([END_ID], "<u4"), encoder(path)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for a, b in chunks(sizes, ENCODE_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), encode(batch.column("text").slice(a, b - a))):
                raw = np.concatenate([ids, tail]).tobytes()
                yield doc_id, zstd.compress(raw), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


def _write(batches, folder: str, path: str) -> Iterator[pa.RecordBatch]:
    os.makedirs(folder, exist_ok=True)
    k = TaskContext.get().partitionId()
    name = f"{folder}/shard-{k:06d}.ids.zst"
    n, total = write_shard(name, _frames(batches, path))
    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([name]), pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["k", "path", "n_docs", "n_tokens"])


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, shards: int | None = None) -> DataFrame:
    """Encodes the texts into shards of the folder; returns the manifest, in doc_id order.

    manifest: k, path, n_docs, n_tokens, start (ids in all shards before it). Unless told, there is a shard for
    every SHARD_BYTES of input, and no fewer than Spark's shuffle partitions. Rows of one doc_id follow the hash of
    their text, so many rows of one id, or of none, are dealt over several shards too.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if shards is None:
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-size // SHARD_BYTES), MOST_SHARDS))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_place")]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    placed = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = sorted(placed.mapInArrow(partial(_write, folder=local_path(folder), path=path), "k int, path string, n_docs long, n_tokens long").collect())
    start, out = 0, []
    for r in rows:
        out.append((*r, start))
        start += r["n_tokens"]
    return spark.createDataFrame(out, "k int, path string, n_docs long, n_tokens long, start long").repartition(max(1, len(out)))


def _read(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            r = ShardReader(path)
            first = start + np.concatenate([[0], np.cumsum(r.n_tokens)])[:-1]
            for a in range(0, len(r), 10_000):
                span = range(a, min(a + 10_000, len(r)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.doc_id(i) for i in span], pa.int64()), pa.array(first[span.start : span.stop].astype(np.int64)),
                     pa.array(r.n_tokens[span.start : span.stop]), pa.array([zlib.crc32(r.raw(i)) for i in span], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
            r.close()


def read_digests(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the shards."""
    return manifest.select("path", "start").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    return read_digests(write_tokens(docs, new_folder(docs.sparkSession, "token-ids"), path))
