"""Byte-level BPE encoding and decoding by a local rank file, with tiktoken.

Texts above LONG characters are cut where a non-space meets a space: no match of the
splitting pattern crosses such a place, so the pieces encode as the whole would. Ids are
decoded from the bytes of their ranks.

Defined results: a null text is an empty one (no ids; digests of nothing); repeated rows are
encoded each; an empty table gives no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 1 << 16
_SAFE = re.compile(r"\S(?=[ \n])")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(2)
def codec(path: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes], list[str]]:
    """The encoder, and for each id its bytes and its decimal digits."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    raw = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        raw[rank] = token
    enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return enc, raw, [str(i) for i in range(len(raw))]


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    at = 0
    while len(text) - at > long:
        m = _SAFE.search(text, at + long - 1)
        if not m:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


def encode(enc: tiktoken.Encoding, text: str, long: int = LONG) -> list[int]:
    if len(text) <= long:
        return enc.encode_ordinary(text)
    return [i for p in pieces(text, long) for i in enc.encode_ordinary(p)]


def decode(raw: list[bytes], ids: list[int]) -> bytes:
    return b"".join([raw[i] for i in ids])


def _run(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    enc, raw, digits = codec(path, pattern)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for batch in batches:
        n, a, d = [], [], []
        for v in batch.column("text"):
            ids = encode(enc, v.as_py() or "")
            n.append(len(ids))
            a.append(sha(",".join([digits[i] for i in ids]).encode()))
            d.append(sha(decode(raw, ids)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def byte_bpe(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded bytes."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    run = partial(_run, path=path, pattern=pattern or public_tokenizers.PATTERN)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def _ids(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    enc, _, _ = codec(path, pattern)
    for batch in batches:
        ids = [encode(enc, v.as_py() or "") for v in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def token_ids(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document with the ids themselves (doc_id long, ids array<int>)."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    run = partial(_ids, path=path, pattern=pattern or public_tokenizers.PATTERN)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")
