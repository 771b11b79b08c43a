"""Repetition coverage: rolling hashes of several n-gram lengths, in numpy.

Defined results: a null text counts as no text (no words, base_failed); empty texts and
texts of white space likewise; repeated rows are scored each; an empty table gives no
rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .words import mix, repeated, window_hashes, words_of

#: Lengths of word n-grams whose repeats are measured, and the share of characters that fails.
NGRAM_LIMITS = {5: 0.45, 10: 0.30, 16: 0.25}
LINE_LIMIT, LINE_CHAR_LIMIT = 0.40, 0.40
#: Symbols for each word that make a text markup or noise.
SYMBOL_LIMIT = 0.2
WINDOW, LEAST_WORDS, MOST_REPEAT = 8, 20, 30

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, dup_line_char_share double, "
    "dup_5gram_share double, dup_10gram_share double, dup_16gram_share double"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """All counts and shares of these texts, one entry per text."""
    w, n_docs = words_of(texts), len(texts)
    ids, doc = w.hashes(), w.doc
    n_words = np.bincount(doc, minlength=n_docs)
    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    chars = points[w.end] - points[w.start]
    word_chars = np.bincount(doc, chars, n_docs).astype(np.int64)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[w.data])])
    n_symbols = symbols[w.bounds[1:]] - symbols[w.bounds[:-1]]
    salt = mix(np.arange(n_docs, dtype=np.uint64) + np.uint64(1))

    ends = np.flatnonzero(w.data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    with_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[with_word], ends[with_word]
    line_doc = np.searchsorted(w.bounds, starts, "right") - 1
    _, later = repeated(w.span_hash(starts, ends) + salt[line_doc])
    n_lines, n_dup_lines = np.bincount(line_doc, minlength=n_docs), np.bincount(line_doc[later], minlength=n_docs)
    line_chars = points[ends] - points[starts]
    all_chars = np.bincount(line_doc, line_chars, n_docs)
    dup_chars = np.bincount(line_doc[later], line_chars[later], n_docs)

    def covered(n: int) -> np.ndarray:
        """Words that stand in an n-gram found at least twice in their text."""
        h = window_hashes(ids, n)
        cover = np.zeros(len(ids) + 1, np.int32)
        if len(h):
            at = np.flatnonzero(doc[: len(h)] == doc[n - 1 :])
            twice, _ = repeated(h[at] + salt[doc[at]])
            hit = at[twice]
            cover[: len(h)][hit] += 1  # positions are distinct
            cover[n:][hit] -= 1
        return np.cumsum(cover[:-1]) > 0

    inside = covered(WINDOW)
    out = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": np.bincount(doc[inside], minlength=n_docs),
        "dup_line_share": n_dup_lines / np.maximum(n_lines, 1), "dup_line_char_share": dup_chars / np.maximum(all_chars, 1),
    }
    for n in NGRAM_LIMITS:
        m = covered(n)
        out[f"dup_{n}gram_share"] = np.bincount(doc[m], chars[m], n_docs) / np.maximum(word_chars, 1)
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEAT * m["n_words"])
    bad = failed | (m["dup_line_share"] > LINE_LIMIT) | (m["dup_line_char_share"] > LINE_CHAR_LIMIT)
    bad |= m["n_symbols"] > SYMBOL_LIMIT * m["n_words"]
    for n, limit in NGRAM_LIMITS.items():
        bad |= m[f"dup_{n}gram_share"] > limit
    return failed, ~bad


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        for a, b in chunks(pc.fill_null(pc.binary_length(text), 0).to_pylist()):
            m = measure([x or b"" for x in text.slice(a, b - a).to_pylist()])
            m["base_failed"], m["kept"] = verdict(m)
            cols = [batch.column("doc_id").slice(a, b - a), *[pa.array(m[k]) for k in names[1:]]]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts, the shares and the verdict."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score, SCHEMA)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        for a, b in chunks(pc.fill_null(pc.binary_length(text), 0).to_pylist()):
            _, kept = verdict(measure([x or b"" for x in text.slice(a, b - a).to_pylist()]))
            yield batch.slice(a, b - a).filter(pa.array(kept))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; no shuffle."""
    return docs.mapInArrow(_keep, docs.schema)
