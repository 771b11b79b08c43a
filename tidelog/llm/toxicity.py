"""Toxicity by a weighted finite-state grammar over clauses.

Words of a clause become symbols (insult, threat, harmed, be, target, negation, reported speech, other). Four
transducers read them: one matches a threat with its target (`kill you`, `you will be killed`), one an
insult with its target on either side (`you idiot`, `idiots like you`), one weakens what a negation
reaches, one what is reported speech. They are composed into one machine that reads a clause once; the weights of
what it matches are the clause's weight. An insult without a target is no match: it counts only where
the text goes on insulting, that is from the second such word on, so one word alone never decides. A document's score is the
logistic of its matched clauses' weights and of such repeated insults.

The insult lexicon (stems with log-odds weights) and the logistic are learned from at most
MOST_TOXIC and MOST_CLEAN labelled documents of at most MOST_TEXT bytes each and MOST_BYTES together, chosen by the hash of their
id among those whose crc32(doc_id) mod 5 is not 0; of near copies among them (Jaccard 0.8 of their words) the lexicon
sees one. A stem is learned if many toxic documents and hardly any clean one have two words of it, else if they have one.
Labels, lang, source and doc_id are never inputs of a score.

Defined results: null, empty and wordless texts get the score of no match; repeated rows are
scored each; with no labels the built-in words alone score; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST_TOXIC, MOST_CLEAN = 2000, 4000
MOST_TEXT, MOST_BYTES = 1 << 20, 64 << 20
#: Characters of a stem of which two words count, of one of which one counts, and of any.
LEAST_TWICE, LEAST_STEM, MOST_STEM = 3, 4, 12
#: A stem is kept if it stands in so many toxic documents, in this share of them, and is so many times likelier there.
LEAST_DOCS, LEAST_SHARE, LEAST_RATIO = 3, 0.01, 25.0

OTHER, INSULT, THREAT, HARMED, BE, TARGET, NOT, SAID = "other", "insult", "threat", "harmed", "be", "target", "not", "said"
#: Closed-class words of the grammar, and open words used before any label is seen.
TARGETS = "you your yours yourself u ur he him his she her hers they them their those these people du dich dir euch ihr sie tu te toi vous usted ustedes ti".split()
NEGATIONS = "not no never n't isn't aren't wasn't don't doesn't didn't cannot can't without nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says say saying claimed claims reported reports wrote writes quoted quotes called according alleged stated sagte dijo selon laut".split()
THREATS = "kill hurt destroy murder stab shoot beat strangle burn hang".split()
HARMS = "killed hurt destroyed murdered stabbed shot beaten strangled burned burnt hanged".split()
INSULTS = "idiot moron stupid pathetic loser worthless scum trash disgusting clown imbecile".split()
_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLOSED = {w: kind for kind, ws in ((TARGET, TARGETS), (NOT, NEGATIONS), (SAID, REPORTS), (HARMED, HARMS), (THREAT, THREATS), (BE, ("be", "get"))) for w in ws}


class Transducer:
    """Deterministic machine: step(state, symbol) -> (state, factor of the word, places back of the word that is matched now or None)."""

    start: tuple = ()

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float, int | None]:
        raise NotImplementedError


def _later(state: tuple) -> tuple:
    """One word on: memories (what, words back, reach) age and end at their reach."""
    return tuple((what, ago + 1, reach) for what, ago, reach in state if ago < reach)


def _ago(state: tuple, what: str) -> int | None:
    return next((ago for w, ago, _ in state if w == what), None)


class Scope(Transducer):
    """After `opener`, the next `reach` words' insults and threats are weighed by `factor` (reach 0: to the clause's end)."""

    def __init__(self, opener: str, reach: int, factor: float):
        self.opener, self.reach, self.factor = opener, reach, factor

    def step(self, state, symbol):
        factor = self.factor if state and symbol in (INSULT, THREAT, HARMED) else 1.0
        if symbol == self.opener:
            return ((self.opener, 1, self.reach or 1),), factor, None
        return (_later(state) if self.reach else state), factor, None


class Threats(Transducer):
    """A threat verb with a target within the next 3 words, or a target that is to `be` harmed."""

    def step(self, state, symbol):
        passive, verb = _ago(state, BE), _ago(state, THREAT)
        kept = _later(state)
        if symbol in (THREAT, HARMED) and passive is not None:
            return (), 1.0, 0
        if symbol == THREAT:
            return ((THREAT, 1, 3),), 1.0, None
        if symbol == TARGET:
            return ((TARGET, 1, 4),), 1.0, verb
        if symbol == BE and _ago(state, TARGET) is not None:
            return ((BE, 1, 3),), 1.0, None
        return kept, 1.0, None


class Insults(Transducer):
    """An insult with a target at most 4 words before or 3 words after it."""

    def step(self, state, symbol):
        target, insult = _ago(state, TARGET), _ago(state, INSULT)
        kept = _later(state)
        if symbol == TARGET:
            return ((TARGET, 1, 4),), 1.0, insult
        if symbol == INSULT and target is not None:
            return kept, 1.0, 0
        if symbol == INSULT:
            return ((INSULT, 1, 3),), 1.0, None
        return kept, 1.0, None


class Composition:
    """Transducers as one machine over tuples of states, built as it is used."""

    def __init__(self, *machines: Transducer):
        self.machines, self.table = machines, {}

    def run(self, symbols: list[tuple[str, float]]) -> tuple[float, list[float]]:
        """Weight of what is matched in one clause, and the weights of insults that have no target."""
        state, weights, matched = tuple(m.start for m in self.machines), [], set()
        for i, (symbol, weight) in enumerate(symbols):
            move = self.table.get((state, symbol))
            if move is None:
                after, factor, hits = [], 1.0, []
                for m, s in zip(self.machines, state):
                    s, f, back = m.step(s, symbol)
                    after.append(s)
                    factor *= f
                    if back is not None:
                        hits.append(back)
                move = self.table[state, symbol] = (tuple(after), factor, tuple(hits))
            state, factor, hits = move
            weights.append(weight * factor)
            matched.update(i - back for back in hits)
        loose = [w for i, ((symbol, _), w) in enumerate(zip(symbols, weights)) if symbol == INSULT and i not in matched]
        return BOUND * sum(weights[i] for i in sorted(matched)), loose


GRAMMAR = (Threats(), Insults(), Scope(SAID, 0, 0.2), Scope(NOT, 3, 0.1))
THREAT_WEIGHT, BOUND = 4.0, 1.5
#: Logistic before any label is seen: constant, matched clauses, repeated insults.
PRIOR = (-3.5, 3.5, 1.7)


class Scorer:
    def __init__(self, stems: dict[str, float], logistic: tuple[float, float, float] = PRIOR):
        self.stems, self.logistic = stems, logistic
        self.shortest = min(map(len, stems), default=MOST_STEM)
        self.find = ahocorasick.Automaton()
        for s in {*stems, *THREATS, *HARMS}:
            self.find.add_word(s, len(s))
        self.find.make_automaton()
        self.machine = Composition(*GRAMMAR)

    def symbol(self, word: str) -> tuple[str, float]:
        for k in range(min(len(word), MOST_STEM), self.shortest - 1, -1):
            w = self.stems.get(word[:k])
            if w is not None:
                return INSULT, w
        kind = _CLOSED.get(word, OTHER)
        return kind, THREAT_WEIGHT if kind in (THREAT, HARMED) else 0.0

    def clauses(self, text: str) -> tuple[list[float], list[float]]:
        """Weights of the clauses that the grammar matches, and of insults without a target, which count from the second on."""
        low = text.lower()
        if not any(not low[end - k].isalpha() if end >= k else True for end, k in self.find.iter(low)):
            return [], []
        matched, loose = [], []
        for clause in _CLAUSE.split(low):
            total, free = self.machine.run([self.symbol(w) for w in _WORD.findall(clause)])
            if total > 0:
                matched.append(total)
            loose += free
        return matched, loose if len(loose) > 1 else []

    def inputs(self, text: str) -> tuple[float, float]:
        matched, loose = self.clauses(text)
        return float(np.log1p(sum(matched))), float(np.log1p(sum(loose)))

    def score(self, text: str) -> float:
        a, b = self.inputs(text)
        z = self.logistic[0] + self.logistic[1] * a + self.logistic[2] * b
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def unlike(docs: list[Counter], bands: int = 8, rows: int = 4) -> list[Counter]:
    """One of each group of near copies: Jaccard 0.8 of their words, compared where a band of least hashes agrees."""
    odd = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    kept: list[Counter] = []
    by_band: dict = {}
    for ws in docs:
        words = ws.keys()
        hashes = np.array([zlib.crc32(w.encode()) for w in words] or [0], np.uint64) + np.uint64(1)
        least = ((hashes[:, None] * odd) >> np.uint64(20)).min(axis=0).reshape(bands, rows)
        keys = [(i, least[i].tobytes()) for i in range(bands)]
        near = {k for key in keys for k in by_band.get(key, ()) if 0.8 * len(words) <= len(kept[k]) <= len(words) / 0.8}
        if any(len(words & kept[k].keys()) >= 0.8 * len(words | kept[k].keys()) for k in near):
            continue
        for key in keys:
            by_band.setdefault(key, []).append(len(kept))
        kept.append(ws)
    return kept


def learn_stems(toxic: list[Counter], clean: list[Counter]) -> dict[str, float]:
    """Stems (prefixes of words) of which toxic documents hold two words, else one, and clean ones hardly do."""
    toxic, clean = unlike(toxic), unlike(clean)
    found = _stems(toxic, clean, LEAST_TWICE, 2, {})
    return found | _stems(toxic, clean, LEAST_STEM, 1, found)


def _stems(toxic: list[Counter], clean: list[Counter], shortest: int, times: int, known: dict[str, float]) -> dict[str, float]:
    least = max(LEAST_DOCS, LEAST_SHARE * len(toxic))

    def holders(docs, wanted=None):
        out = Counter()
        for ws in docs:
            here = Counter()
            for w, n in ws.items():
                for k in range(shortest, min(len(w), MOST_STEM) + 1):
                    if wanted is None or w[:k] in wanted:
                        here[w[:k]] += n
            out.update(p for p, n in here.items() if n >= times)
        return out

    t = Counter({p: n for p, n in holders(toxic).items() if n >= least})
    c = holders(clean, set(t))
    a, b = len(toxic) + 1, len(clean) + 1
    ratio = lambda p: (t[p] + 0.1) / a / ((c[p] + 0.5) / b)
    covered = lambda p: any(p[:k] in known or p[:k] in found for k in range(1, len(p) + 1))
    longer: dict[str, list[str]] = {}
    for p in t:
        longer.setdefault(p[:-1], []).append(p)
    found: dict[str, float] = {}
    for p in sorted(t, key=lambda p: (len(p), p)):
        if ratio(p) < LEAST_RATIO or covered(p):
            continue
        stem = p
        # what nearly all its words share belongs to the stem: this keeps it from matching strangers
        while (best := max(longer.get(stem, ()), key=t.get, default=None)) and t[best] >= 0.9 * t[stem]:
            stem = best
        if not covered(stem):
            found[stem] = float(np.log(ratio(stem)))
    return found


def fit(texts: list[str], labels: list[int]) -> tuple[dict[str, float], tuple[float, float, float]]:
    words = [Counter(_WORD.findall((t or "").lower())) for t in texts]
    toxic = [w for w, y in zip(words, labels) if y]
    clean = [w for w, y in zip(words, labels) if not y]
    stems = {w: 4.0 for w in INSULTS}
    stems |= learn_stems(toxic, clean) if toxic and clean else {}
    if not toxic or not clean:
        return stems, PRIOR
    s = Scorer(stems)
    x = np.array([(1.0, *s.inputs(t or "")) for t in texts])
    return stems, fit_logistic(x, np.array(labels, float), np.array(PRIOR))


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, pull=(0.05, 20.0, 0.5)) -> tuple[float, ...]:
    """Logistic weights held to the prior, that of matched clauses firmly, since labelled texts may hardly have any; Newton steps are halved until they lower the loss.

    Whole steps overshoot where the classes are separable, and may end with the sign turned.
    """
    pull = np.array(pull)

    def loss(w):
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(pull * (w - prior) ** 2))

    w = prior.astype(float)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (p - y) + pull * (w - prior)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pull), gradient)
        at, gain, size = loss(w), float(gradient @ step), 1.0
        while loss(w - size * step) > at - 1e-4 * size * gain and size > 1e-9:
            size /= 2
        if size <= 1e-9 or gain < 1e-10:
            break
        w = w - size * step
    return tuple(float(v) for v in w)


def remainder(doc_id):
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def learn(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN):
    """Fits lexicon and logistic on the bounded sample; it alone reaches the driver."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(remainder(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = known.where("toxic = 1").orderBy(order).limit(most_toxic).unionByName(known.where("toxic = 0").orderBy(order).limit(most_clean))
    chosen = chosen.withColumnRenamed("doc_id", "_id")
    size = F.octet_length(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(size <= MOST_TEXT).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    # at most MOST_TOXIC + MOST_CLEAN rows stand in this window
    upto = F.sum(size).over(W.orderBy(F.xxhash64("_id"), "_id").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_upto", upto).where(F.coalesce(F.col("_upto"), F.lit(0)) <= MOST_BYTES).drop("_upto")
    got = sorted(rows.collect(), key=lambda r: r["_id"])
    return fit([r["text"] or "" for r in got], [r["toxic"] for r in got])


def _run(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(*model)
    for batch in batches:
        s = [scorer.score(v.as_py() or "") for v in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long"), (remainder(F.col("doc_id")) == 0).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(partial(_run, model=learn(docs, labels)), "doc_id long, held_out boolean, score double, predicted int")
