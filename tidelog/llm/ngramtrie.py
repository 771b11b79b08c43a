"""Language-model scores from an Elias-Fano n-gram trie.

Level one is the vocabulary: sorted 64-bit word identities, in shards by their first bits, with counts
and back-off weights. Level two holds, for each context, its successors: in each shard the contexts
are one Elias-Fano sequence, monotone pointers to their first successors another, the successors
(context place times vocabulary size plus word number) a third, with quantised smoothed
probabilities beside them. A query finds the context, then searches the successor, coded relative to it, where
the pointers bound it. Each further level has the places of the level before as contexts: a pointer and a
back-off weight for each place, and the successors with their probabilities. A node's
descendants lie in the shard of its pair. Shards are files in the shared folder, memory-mapped by the workers
when a query reaches them, MOST_OPEN of them at a time.

The model interpolates discounted n-gram frequencies of orders 2 to `order` with the additive unigram base: the
longest context that was seen counts first. The start of a text is one context token. Counts cover
every training document (crc32(doc_id) mod 5 is not 1), whole, without cap: each partition counts its own
words, then its n-grams of the highest order, and sends them as sorted, compressed runs; a shard derives its
shorter n-grams from these. A context with very many tokens is split over several shards by its successors; those
of one pair are together.

Defined results: a null text is an empty one (the end alone); repeated rows train and score each; a
row without doc_id trains; an empty training set gives the uniform base over the unknown word; an
empty table gives no rows; columns besides doc_id and text are not read. The shared folder must be mounted
on every node. A vocabulary of more than MOST_WORDS words is an error; identities are 64-bit hashes. A text is
one unit of work, some 40 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, local_path, new_folder
from .eliasfano import encode, load, pack, save, unpack
from .words import mix, words_of

DISCOUNT = 0.75
#: Tokens whose counts one shard holds, and of one context that one of its parts holds.
SHARD_TOKENS, CONTEXT_TOKENS = 4_000_000, 1_000_000
#: Distinct words or n-grams that a partition gathers before it sends them; bytes of text that it handles at once.
GATHER, AT_ONCE = 3_000_000, 4 << 20
#: Probabilities are kept as steps of log10, from 0 down to -LOWEST.
LOWEST, STEPS = 24.0, 65_535
#: Words that can be numbered, shards that a worker keeps mapped, and bits of a place within a shard.
MOST_WORDS, MOST_OPEN, SHARD_BITS = (1 << 31) - 2, 8192, 40
END = np.uint64(0x456E64)  # the identity of the end token
_RUN = "shard int, blocks array<binary>"
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Identities of the words of each text in order, an end after each; and the text they belong to."""
    w = words_of([t.lower() for t in texts])
    n, k = len(texts), len(w.start)
    ids, doc = np.empty(k + n, np.uint64), np.empty(k + n, np.int64)
    at = np.arange(k) + w.doc
    ids[at], doc[at] = w.hashes(), w.doc
    ends = np.cumsum(np.bincount(w.doc, minlength=n)) + np.arange(n)
    ids[ends], doc[ends] = END, np.arange(n)
    return ids, doc


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        for a, b in chunks(pc.fill_null(pc.binary_length(text), 0).to_pylist(), AT_ONCE):
            yield batch.slice(a, b - a), [x or b"" for x in text.slice(a, b - a).to_pylist()]


class _Gather:
    """Distinct rows of key columns and their counts, merged as they come. The first column is 64 bits wide, others 32."""

    def __init__(self, width: int = 1):
        self.width, self.runs, self.size = width, [], 0

    def add(self, *columns: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.runs.append(_distinct(columns, np.ones(len(columns[0]), np.int64) if counts is None else counts.astype(np.int64)))
        self.size += len(self.runs[-1][0])
        if len(self.runs) > 12:
            self.runs = [self.merged()]
            self.size = len(self.runs[0][0])

    def merged(self) -> tuple[np.ndarray, ...]:
        """The columns in ascending order, then the counts."""
        if not self.runs:
            return np.zeros(0, np.uint64), *[np.zeros(0, np.uint32)] * (self.width - 1), np.zeros(0, np.int64)
        if len(self.runs) == 1:
            return self.runs[0]
        *columns, counts = (np.concatenate(x) for x in zip(*self.runs))
        return _distinct(columns, counts)


def _distinct(columns, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    if not len(counts):
        return *columns, counts
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return *[c[first] for c in columns], np.add.reduceat(counts[order], first)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of one weight together."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplaned(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _send(rows: tuple[np.ndarray, ...], shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each shard: its rows in order, the first column as differences, compressed."""
    z = zstandard.ZstdCompressor(level=1)
    for part in _by(shard):
        first, *more, counts = (x[part] for x in rows)
        blocks = [_planes(np.diff(first, prepend=np.uint64(0))), *[_planes(c.astype("<u4")) for c in more], _planes(counts.astype("<i8"))]
        row = [pa.array([int(shard[part[0]])], pa.int32()), pa.array([[z.compress(b) for b in blocks]], pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(row, names=["shard", "blocks"])


def _received(batches: Iterator[pa.RecordBatch], width: int = 1) -> tuple[np.ndarray, ...]:
    g, z = _Gather(width), zstandard.ZstdDecompressor()
    for b in batches:
        for blocks in b.column("blocks"):
            first, *more, counts = (z.decompress(x) for x in blocks.as_py())
            g.add(np.cumsum(_unplaned(first, "<u8"), dtype=np.uint64), *[_unplaned(x, "<u4") for x in more], counts=_unplaned(counts, "<i8"))
    return g.merged()


def _by(shard: np.ndarray) -> list[np.ndarray]:
    """Places of each shard's members, in their order."""
    if not len(shard):
        return []
    order = np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)


def word_shard(ids: np.ndarray, n: int) -> np.ndarray:
    """Shards are ranges of identities, so their order is that of the identities."""
    return ((ids >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def _count_words(batches, n_shards: int) -> Iterator[pa.RecordBatch]:
    g = _Gather()
    for _, texts in _texts(batches):
        g.add(tokens(texts)[0])
        if g.size > GATHER:
            rows = g.merged()
            yield from _send(rows, word_shard(rows[0], n_shards))
            g = _Gather()
    rows = g.merged()
    yield from _send(rows, word_shard(rows[0], n_shards))


def _write_words(batches, folder: str) -> Iterator[pa.RecordBatch]:
    k = TaskContext.get().partitionId()
    keys, counts = _received(batches)
    if len(keys):
        os.makedirs(folder, exist_ok=True)
        ef, meta = pack("words", encode(keys - keys[0], int(keys[-1] - keys[0]) + 1))
        save(f"{folder}/words-{k:06d}", ef | {"counts": counts}, meta | {"base": int(keys[0])})
    row = [pa.array([v], t) for v, t in ((k, pa.int32()), (len(keys), pa.int64()), (int(counts.sum()), pa.int64()))]
    yield pa.RecordBatch.from_arrays(row, names=["k", "n", "total"])


class Vocabulary:
    """Word identities to numbers, counts and base probabilities, over mapped shards; shards of size 0 have no file."""

    def __init__(self, folder: str, sizes: tuple[int, ...], total: int):
        self.shards = [load(f"{folder}/words-{k:06d}") if n else None for k, n in enumerate(sizes)]
        self.sets = [s and unpack("words", *s) for s in self.shards]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.size, self.total = int(self.first[-1]), total
        #: Tokens after the start of a text: one for each training text, known as the count of the end.
        self.docs = int(self.look_up(np.array([END]))[1][0])

    def look_up(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count) for each identity."""
        number, count = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        for part in _by(word_shard(ids, len(self.sets))):
            k = word_shard(ids[part[:1]], len(self.sets))[0]
            if self.sets[k] is None:
                continue
            base = np.uint64(self.shards[k][1]["base"])
            part = part[ids[part] >= base]
            at = self.sets[k].find(ids[part] - base)
            part, at = part[at >= 0], at[at >= 0]
            number[part], count[part] = self.first[k] + at, self.shards[k][0]["counts"][at]
        return number, count

    def shard_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, numbers, "right") - 1

    def tokens_after(self, context: np.ndarray) -> np.ndarray:
        """How many training tokens follow each context; `size` is the start of a text."""
        out = np.full(len(context), self.docs, np.int64)
        inner = np.flatnonzero(context < self.size)
        shard = self.shard_of(context[inner])
        for part in _by(shard):
            k = shard[part[0]]
            out[inner[part]] = self.shards[k][0]["counts"][context[inner[part]] - self.first[k]]
        return out

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.size + 1)))


@lru_cache(1)
def vocabulary(folder: str, sizes: tuple[int, ...], total: int) -> Vocabulary:
    return Vocabulary(folder, sizes, total)


def pair_shard(context: np.ndarray, word: np.ndarray, context_count: np.ndarray, n: int) -> np.ndarray:
    parts = (1 + context_count // CONTEXT_TOKENS).astype(np.uint64)
    part = mix(word.astype(np.uint64)) % parts
    return (mix(context.astype(np.uint64) + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int32)


def numbered(v: Vocabulary, texts: list[bytes]):
    """(doc, number, count, context number, context count) of every token; number -1: unknown, context `size`: start of text."""
    ids, doc = tokens(texts)
    distinct, at = np.unique(ids, return_inverse=True)
    number, count = v.look_up(distinct)
    number, count = number[at], count[at]
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    context = np.where(first, v.size, np.concatenate([[v.size], number[:-1]]))
    before = np.where(first, v.docs, np.concatenate([[0], count[:-1]]))
    return doc, number, count, context, before


def _count_grams(batches, words: tuple, n_shards: int, order: int) -> Iterator[pa.RecordBatch]:
    """n-grams of the highest order alone: one starts at the start of a text and at each of its words, the end is followed by `size` + 1.

    All shorter ones are their beginnings. Keys are the pair as one number, then the further words; the pair decides the shard.
    """
    v, g = vocabulary(*words), _Gather(order - 1)
    width = np.uint64(v.size + 2)

    def send():
        rows = g.merged()
        context, word = (rows[0] // width).astype(np.int64), (rows[0] % width).astype(np.int64)
        return _send(rows, pair_shard(context, word, v.tokens_after(context), n_shards))

    for _, texts in _texts(batches):
        doc, number, _, context, _ = numbered(v, texts)
        longer, n = [], len(doc)
        for j in range(1, order - 1):
            c = np.full(n, v.size + 1, np.uint32)
            c[: n - j] = np.where(doc[j:] == doc[: n - j], number[j:], v.size + 1)[: max(0, n - j)]
            longer.append(c)
        g.add(context.astype(np.uint64) * width + number.astype(np.uint64), *longer)
        if g.size > GATHER:
            yield from send()
            g = _Gather(order - 1)
    yield from send()


def _steps(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) / LOWEST * STEPS), 0, STEPS).astype("<u2")


def _power(steps: np.ndarray) -> np.ndarray:
    return 10.0 ** (steps * (-LOWEST / STEPS))


def _write_grams(batches, folder: str, words: tuple, order: int) -> Iterator[pa.RecordBatch]:
    """Writes one shard: all levels of the pairs that lie in it, from sorted n-grams of the highest order.

    Returns the number of successors that each context has here, by the context's shard; and, as context -1 - k, how many pairs shard k has.
    """
    k, v = TaskContext.get().partitionId(), vocabulary(*words)
    width = np.uint64(v.size + 2)
    pair, *longer, counts = _received(batches, order - 1)
    if not len(pair):
        return
    begins = lambda x: np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    first = begins(pair)
    number = np.add.reduceat(counts, first)
    context, word = (pair[first] // width).astype(np.int64), pair[first] % width
    at = begins(context)
    contexts, fan = context[at], np.diff(at, append=len(context))
    place = np.repeat(np.arange(len(at)), fan)
    arrays, meta = pack("contexts", encode(contexts.astype(np.uint64), v.size + 1))

    def level(m: int, pointers: np.ndarray, keys: np.ndarray, n_parents: int, own: dict):
        for name, x, u in (("pointers", pointers, len(keys) + 1), ("successors", keys, n_parents * int(width))):
            a, b = pack(f"{name}{m}", encode(x.astype(np.uint64), u))
            arrays.update(a)
            meta.update(b)
        arrays.update({f"{name}{m}": x for name, x in own.items()})

    p = np.maximum(number - DISCOUNT, 1e-9) / np.maximum(v.tokens_after(contexts), 1)[place]
    level(2, np.append(at, len(context)), place.astype(np.uint64) * width + word, len(at), {"steps": _steps(p)})
    # each row's place in the level before; rows whose further word stands beyond a text's end go no deeper
    node, n_nodes = np.cumsum(np.isin(np.arange(len(pair)), first, assume_unique=True)) - 1, len(first)
    for m in range(3, order + 1):
        go = longer[m - 3] <= v.size
        node, counts, longer = node[go], counts[go], [x[go] for x in longer]
        key = node.astype(np.uint64) * width + longer[m - 3]
        first = begins(key) if len(key) else np.zeros(0, np.int64)
        parent, number = node[first], np.add.reduceat(counts, first) if len(first) else counts
        fan_m, total = np.bincount(parent, minlength=n_nodes), np.bincount(parent, number, n_nodes)
        own = {"steps": _steps(np.maximum(number - DISCOUNT, 1e-9) / total[parent]), "weights": _steps(np.where(fan_m > 0, DISCOUNT * fan_m / np.maximum(total, 1), 1))}
        level(m, np.concatenate([[0], np.cumsum(fan_m)]), key[first], n_nodes, own)
        node, n_nodes = np.repeat(np.arange(len(first)), np.diff(first, append=len(key))), len(first)
    os.makedirs(folder, exist_ok=True)
    save(f"{folder}/grams-{k:06d}", arrays, meta)
    shard, names = v.shard_of(contexts).astype(np.int32), ["shard", "context", "fan"]
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([-1 - k], pa.int64()), pa.array([len(context)], pa.int64())], names=names)
    for a in range(0, len(contexts), 50_000):
        b = a + 50_000
        yield pa.RecordBatch.from_arrays([pa.array(shard[a:b]), pa.array(contexts[a:b]), pa.array(fan[a:b].astype(np.int64))], names=names)


def _write_backoff(batches, folder: str, words: tuple) -> Iterator[pa.RecordBatch]:
    """Back-off weights of one range of contexts, as one array by number (level one's second half). Passes on the sizes of the shards of pairs."""
    k, v = TaskContext.get().partitionId(), vocabulary(*words)
    lo, hi = (int(v.first[k]), int(v.first[k + 1])) if k < len(v.sets) else (v.size, v.size + 1)
    fan = np.zeros(hi - lo, np.int64)
    for b in batches:
        at, n = b.column("context").to_numpy(), b.column("fan").to_numpy()
        np.add.at(fan, at[at >= 0] - lo, n[at >= 0])
        yield pa.RecordBatch.from_arrays([pa.array(-1 - at[at < 0], pa.int32()), pa.array(n[at < 0], pa.int64())], names=["k", "n"])
    seen = np.maximum(v.tokens_after(np.arange(lo, hi)), 1)
    save(f"{folder}/backoff-{k:06d}", {"weights": np.where(fan > 0, np.minimum(1.0, DISCOUNT * fan / seen), 1.0).astype(np.float32)}, {})
    yield pa.RecordBatch.from_arrays([pa.array([-1 - k], pa.int32()), pa.array([hi - lo], pa.int64())], names=["k", "n"])


class Trie:
    """The levels, over mapped shards; shards that the driver knows to be empty have no file, and a shard is opened when a query reaches it."""

    def __init__(self, folder: str, words: tuple, grams: tuple, order: int):
        self.folder, self.v, self.order = folder, vocabulary(*words), order
        self.sizes, self.weighted = grams
        #: Number of the first pair of each shard: a pair's number is that plus its place in the shard. Further levels count likewise in steps of 2^40 a shard.
        self.first = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self._open = lru_cache(MOST_OPEN)(self._map)
        self.weights = lru_cache(MOST_OPEN)(lambda k: load(f"{folder}/backoff-{k:06d}")[0]["weights"])

    def _map(self, k: int):
        arrays, meta = load(f"{self.folder}/grams-{k:06d}")
        return arrays, unpack("contexts", arrays, meta), {m: tuple(unpack(f"{x}{m}", arrays, meta) for x in ("pointers", "successors")) for m in range(2, self.order + 1)}

    def backoff(self, context: np.ndarray) -> np.ndarray:
        v, out = self.v, np.ones(len(context))
        shard = v.shard_of(context)
        for part in _by(shard):
            k = int(shard[part[0]])
            if k in self.weighted:
                out[part] = self.weights(k)[context[part] - v.first[k]]
        return out

    def _successors(self, levels: dict, m: int, place: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of successors, coded relative to their contexts' places, or -1. The pointers bound the search."""
        pointers, successors = levels[m]
        key = place.astype(np.uint64) * np.uint64(self.v.size + 2) + word.astype(np.uint64)
        return successors.find(key, lambda i: (pointers.get(place[i]).astype(np.int64), pointers.get(place[i] + 1).astype(np.int64)))

    def pairs(self, context: np.ndarray, word: np.ndarray, context_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bigrams' own probability mass and number of place, for pairs in ascending order; 0 and -1 where one was not seen."""
        out, node = np.zeros(len(context)), np.full(len(context), -1, np.int64)
        if not self.first[-1]:
            return out, node
        shard = pair_shard(context, word, context_count, len(self.sizes))
        for part in _by(shard):
            k = int(shard[part[0]])
            if not self.sizes[k]:
                continue
            arrays, contexts, levels = self._open(k)
            c = context[part]
            new = np.concatenate([[True], c[1:] != c[:-1]])
            place = contexts.find(c[new].astype(np.uint64))[np.cumsum(new) - 1]
            part, place = part[place >= 0], place[place >= 0]
            at = self._successors(levels, 2, place, word[part])
            part, at = part[at >= 0], at[at >= 0]
            out[part], node[part] = _power(arrays["steps2"][at]), (k << SHARD_BITS) + at
        return out, node

    def longer(self, m: int, parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own probability mass, back-off weight of the parent and number of place, for parents of the level before; word -1: unknown."""
        out, weight, node = np.zeros(len(parent)), np.ones(len(parent)), np.full(len(parent), -1, np.int64)
        order = np.argsort(parent, kind="stable")
        shard = parent[order] >> SHARD_BITS
        for part in np.split(order, np.flatnonzero(np.diff(shard)) + 1) if len(order) else []:
            k = int(parent[part[0]] >> SHARD_BITS)
            arrays, _, levels = self._open(k)
            place = parent[part] - (k << SHARD_BITS)
            weight[part] = _power(arrays[f"weights{m}"][place])
            part, place = part[word[part] >= 0], place[word[part] >= 0]
            at = self._successors(levels, m, place, word[part])
            part, at = part[at >= 0], at[at >= 0]
            out[part], node[part] = _power(arrays[f"steps{m}"][at]), (k << SHARD_BITS) + at
        return out, weight, node

    def scores(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        v, n = self.v, len(texts)
        doc, number, count, context, before = numbered(v, texts)
        base = v.base(count)
        p = 10.0**base
        # level two, each distinct pair once
        both = np.flatnonzero(context >= 0)
        contexts, at = np.unique(context[both], return_inverse=True)
        weight, own, node = self.backoff(contexts)[at], np.zeros(len(doc)), np.full(len(doc), -1, np.int64)
        pairs = both[number[both] >= 0]
        distinct, one, at = np.unique(context[pairs] * (v.size + 2) + number[pairs], return_index=True, return_inverse=True)
        one = pairs[one]
        mass, places = self.pairs(context[one], number[one], before[one])
        own[pairs], node[pairs] = mass[at], places[at]
        p[both] = own[both] + weight * p[both]
        for m in range(3, self.order + 1):
            have = 1 + np.flatnonzero((node[:-1] >= 0) & (doc[1:] == doc[:-1]))
            parent, node = node[have - 1], np.full(len(doc), -1, np.int64)
            own, weight, node[have] = self.longer(m, parent, number[have])
            p[have] = own + weight * p[have]
        return {
            "n_tokens": np.bincount(doc, minlength=n), "n_known": np.bincount(doc[count > 0], minlength=n),
            "base_score": np.bincount(doc, base, n), "score": np.bincount(doc, np.log10(p), n),
        }


@lru_cache(1)
def trie(folder: str, words: tuple, grams: tuple, order: int) -> Trie:
    return Trie(folder, words, grams, order)


def _score(batches, folder: str, words: tuple, grams: tuple, order: int) -> Iterator[pa.RecordBatch]:
    t = trie(folder, words, grams, order)
    for batch, texts in _texts(batches):
        s = t.scores(texts)
        cols = [batch.column("doc_id"), batch.column("held_out"), pa.array(s["n_tokens"]), pa.array(s["n_known"]), pa.array(np.full(len(texts), t.v.total)), pa.array(s["base_score"]), pa.array(s["score"])]
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in SCHEMA.split(", ")])


def build(train: DataFrame, folder: str, n_shards: int | None = None, order: int = 2) -> tuple[str, tuple, tuple]:
    """Writes the trie of all texts of `train`; returns what `_score` needs. Only sizes of shards reach the driver."""
    spark = train.sparkSession
    path, text = local_path(folder), train.select(F.col("text").cast("string"))
    n_words = n_shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = text.mapInArrow(partial(_count_words, n_shards=n_words), _RUN)
    made = runs.repartitionById(n_words, F.col("shard")).mapInArrow(partial(_write_words, folder=path), "k int, n long, total long").collect()
    sizes = {r["k"]: r["n"] for r in made}
    words = (path, tuple(sizes.get(k, 0) for k in range(n_words)), sum(r["total"] for r in made))
    if sum(words[1]) > MOST_WORDS:
        raise ValueError(f"a vocabulary of {sum(words[1])} words; this trie numbers at most {MOST_WORDS}")
    if not words[2]:
        return path, words, ((), frozenset())
    n_grams = max(n_words, -(-words[2] // SHARD_TOKENS))
    runs = text.mapInArrow(partial(_count_grams, words=words, n_shards=n_grams, order=order), _RUN)
    fans = runs.repartitionById(n_grams, F.col("shard")).mapInArrow(partial(_write_grams, folder=path, words=words, order=order), "shard int, context long, fan long")
    made = fans.repartitionById(n_words + 1, F.col("shard")).mapInArrow(partial(_write_backoff, folder=path, words=words), "k int, n long").collect()
    sizes = {r["k"]: r["n"] for r in made if r["k"] >= 0}
    return path, words, (tuple(sizes.get(k, 0) for k in range(n_grams)), frozenset(-1 - r["k"] for r in made if r["k"] < 0))


def remainder(doc_id):
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def lm_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """One row per document: counts, base score and the model's score. `order` is 2 or more."""
    if order < 2:
        raise ValueError("the order of the model is 2 or more")
    rows = docs.select(F.col("doc_id").cast("long"), (remainder(F.col("doc_id")) == 1).alias("held_out"), F.col("text").cast("string"))
    path, words, grams = build(rows.where("not held_out"), new_folder(docs.sparkSession, "lm-trie"), order=order)
    return rows.mapInArrow(partial(_score, folder=path, words=words, grams=grams, order=order), SCHEMA)
