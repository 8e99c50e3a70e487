"""Toxicity by a factorization machine over hashed terms.

A document's terms are its words and their beginnings, hashed. Besides one weight per term the
machine learns a vector per term; the product of two terms' vectors weighs their meeting in one
document (an insult with the mention of a group), which additive weights cannot. The machine is
fitted on a bounded sample of labelled documents and then scores every document of any table.

Of the sample's terms the machine keeps those that tell the labels apart: by themselves, or by their
meeting. The latter are found from counts of all pairs of words that meet in toxic documents, so a
word whose share of toxic documents is the usual one is kept if it goes with another one. Words kept
for their meetings alone stay only if they lower the loss on a part of the sample set aside.

Defined cases: a missing or empty text, or one without words, is scored by the machine's bias
alone; very long texts are read whole; labels of documents that are missing, and missing labels,
take no part; repeated labels count repeatedly; without labels of both kinds every score is the
share of toxic labels (0 without labels); an empty table gives an empty result; columns other than
key and text are ignored by the scores, whatever their names, and carried along by ``scored``,
except that a column of the name ``into`` is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, held_out, key_text, order_hash, table

#: Labelled documents a machine is fitted on at most, chosen by a hash of their key.
SAMPLE_DOCUMENTS = 12_000
HASH_BITS = 20
STEMS = (3, 4, 5)
#: Terms a machine keeps at most: those that tell the labels apart best.
KEPT_TERMS = 2048
LEAST_DOCUMENTS = 5
TELLING = 15.0
#: Pairs of words a machine keeps terms for at most; toxic documents a pair must be met in, and what its
#: chi-squared statistic must exceed those of its words by, far beyond what chance gives among millions of pairs.
KEPT_PAIRS, LEAST_MEETINGS, TELLING_TOGETHER = 512, 8, 60.0
#: Documents of the sample that pairs are counted in at most, and pairs counted in all: terms in more documents than
#: the first of these shares that keeps to it take no part in pairs.
PAIRED_DOCUMENTS, PAIRS_IN_ALL = 4_000, 60_000_000
SHARES = (1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05)
PAIR_BITS = 23
PAIRS_AT_ONCE = 1 << 18
#: Pairs that are counted exactly at most: the most telling ones by the rough count.
EXACT_PAIRS = 20_000
#: One in this many of the learned documents decides whether pairs are worth keeping.
SET_ASIDE = 5
LOWER_LOSS = 0.98
FACTORS = 8
ROUNDS = 300
LEARNING_RATE = 0.05
RIDGE = 1e-3
FOLDS, HELD_OUT_FOLD = 5, 0
SCORE_TYPE = "score double, predicted int"

WORDS = re.compile(r"\w+")
KNOWN_WORDS = 300_000


def hashed(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) >> (32 - HASH_BITS)


def word_terms(word: str) -> list[int]:
    """The word as a whole and its beginnings; marked, so that a short word is not taken for a beginning."""
    return [hashed(word + " ")] + [hashed(word[:n]) for n in STEMS if len(word) >= n]


def document_terms(text: str | None) -> np.ndarray:
    words = set(WORDS.findall((text or "").lower()))
    return np.unique(np.fromiter((t for w in words for t in word_terms(w)), np.int64))


@dataclass
class Machine:
    """bias, and of each kept term (sorted hashes) its weight and its vector."""

    bias: float
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def score(self, kept: list[np.ndarray]) -> np.ndarray:
        """kept: the places of each document's kept terms."""
        return logistic(self._raw(*stacked(kept))[0])

    def _raw(self, document: np.ndarray, place: np.ndarray, value: np.ndarray, count: int):
        linear = np.bincount(document, self.weights[place] * value, count)
        parts = self.vectors[place] * value[:, None]
        sums = np.stack([np.bincount(document, parts[:, f], count) for f in range(parts.shape[1])], 1)
        squares = np.bincount(document, (parts**2).sum(1), count)
        return self.bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums, parts


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def stacked(kept: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Documents as one list of (document, term place, value); a document's values have norm 1 beyond one term."""
    sizes = np.array([len(x) for x in kept], np.int64)
    place = np.concatenate(kept).astype(np.int64) if len(kept) else np.zeros(0, np.int64)
    document = np.repeat(np.arange(len(kept)), sizes)
    value = np.repeat(1.0 / np.sqrt(np.maximum(sizes, 1)), sizes)
    return document, place, value, len(kept)


def presence_statistic(met: np.ndarray, met_toxic: np.ndarray, n: int, n1: float) -> np.ndarray:
    """Chi-squared of presence against label, from how often something is present, in all and in toxic documents."""
    expected = met * n1 / n
    spread = met * (1 - met / n) * (n1 / n) * (1 - n1 / n)
    return np.where((met >= LEAST_DOCUMENTS) & (met < n), (met_toxic - expected) ** 2 / np.maximum(spread, 1e-9), 0.0)


def presence(terms: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every hash the number of documents that hold it, and its statistic."""
    every = np.concatenate(terms) if terms else np.zeros(0, np.int64)
    of = np.repeat(toxic, [len(x) for x in terms])
    met = np.bincount(every, minlength=1 << HASH_BITS).astype(float)
    return met, presence_statistic(met, np.bincount(every, of, 1 << HASH_BITS), len(toxic), float(toxic.sum()))


def telling_terms(terms: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Hashes whose presence goes with either label."""
    _, statistic = presence(terms, toxic)
    best = np.argsort(-statistic, kind="stable")[:KEPT_TERMS]
    return np.sort(best[statistic[best] > TELLING])


def pairs_of(terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a document's terms, the lower first, some rows of their triangle at once."""
    step = max(1, PAIRS_AT_ONCE // max(1, len(terms)))
    for at in range(0, len(terms) - 1, step):
        rows = np.arange(at, min(at + step, len(terms) - 1))
        many = len(terms) - 1 - rows
        ends = np.cumsum(many)
        yield np.repeat(terms[rows], many), terms[np.arange(ends[-1]) - np.repeat(ends - many, many) + np.repeat(rows + 1, many)]


def pair_buckets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * 0x9E3779B1 + b * 0x85EBCA6B) >> 5) & ((1 << PAIR_BITS) - 1)


def telling_pairs(terms: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Terms of pairs that go with toxicity far more than either term does.

    A first count by hash buckets leaves few pairs, which are then counted exactly. Equal documents count once.
    """
    own = sorted({x.tobytes(): i for i, x in reversed(list(enumerate(terms)))}.values())
    own = own[:: -(-len(own) // PAIRED_DOCUMENTS)]
    n, label = len(own), toxic[own]
    frequency, statistic = presence([terms[i] for i in own], label)
    for share in SHARES:
        fit = (frequency >= LEAST_MEETINGS) & (frequency <= share * n)
        rows = [terms[i][fit[terms[i]]] for i in own]
        if sum(len(r) * (len(r) - 1) // 2 for r in rows) <= PAIRS_IN_ALL:
            break
    met = np.zeros((2, 1 << PAIR_BITS), np.int32)
    waiting: list[list[np.ndarray]] = [[], []]

    def flush(which: int) -> None:
        if waiting[which]:
            met[which] += np.bincount(np.concatenate(waiting[which]), minlength=met.shape[1]).astype(np.int32)
            waiting[which].clear()

    for row, y in zip(rows, label, strict=True):
        for a, b in pairs_of(row):
            waiting[int(y)].append(pair_buckets(a, b).astype(np.int32))
            if sum(map(len, waiting[int(y)])) > 8 * PAIRS_AT_ONCE:
                flush(int(y))
    flush(0), flush(1)
    rough = np.zeros(met.shape[1], np.float32)
    for at in range(0, len(rough), PAIRS_AT_ONCE):
        some = met[:, at : at + PAIRS_AT_ONCE].astype(float)
        rough[at : at + PAIRS_AT_ONCE] = np.where(some[1] < LEAST_MEETINGS, 0.0, presence_statistic(some.sum(0), some[1], n, float(label.sum())))
    del met
    best: dict[int, float] = {}
    for row, y in zip(rows, label, strict=True):
        if y:
            for a, b in pairs_of(row):
                # Pairs that share a bucket blur the rough statistic, so the bar is lower here.
                gain = rough[pair_buckets(a, b)] - np.maximum(statistic[a], statistic[b])
                hit = gain > TELLING_TOGETHER / 2
                best.update(zip(((a[hit] << HASH_BITS) | b[hit]).tolist(), gain[hit].tolist(), strict=True))
    if not best:
        return np.zeros(0, np.int64)
    found = np.array(sorted(best, key=lambda p: (-best[p], p))[:EXACT_PAIRS], np.int64)
    pairs = np.stack([found >> HASH_BITS, found & ((1 << HASH_BITS) - 1)], 1)
    wanted = np.zeros(1 << HASH_BITS, bool)
    wanted[pairs] = True
    holds = {int(t): np.zeros(n, bool) for t in np.unique(pairs)}
    for i, row in enumerate(rows):
        for t in row[wanted[row]].tolist():
            holds[t][i] = True
    both = np.array([[(m := holds[a] & holds[b]).sum(), m[label == 1].sum()] for a, b in pairs.tolist()], float)
    gain = presence_statistic(both[:, 0], both[:, 1], n, float(label.sum())) - statistic[pairs].max(1)
    gain[both[:, 1] < LEAST_MEETINGS] = 0.0
    best = np.argsort(-gain, kind="stable")[:KEPT_PAIRS]
    return np.unique(pairs[best[gain[best] > TELLING_TOGETHER]])


def fit_machine(terms: list[np.ndarray], toxic: np.ndarray) -> Machine:
    """Full-batch Adam on the logistic loss, from a fixed start, so a rerun gives the same machine."""
    n, n1 = len(toxic), float(toxic.sum())
    if n1 in (0.0, float(n)):
        share = n1 / n if n else 0.0
        return Machine(float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    alone = telling_terms(terms, toxic)
    both = np.union1d(alone, telling_pairs(terms, toxic))
    if len(both) > len(alone):
        # The terms are those of all learned documents, the two machines compared here learn from a part of them.
        judges = np.arange(n) % SET_ASIDE == 0
        losses = []
        for kept in (alone, both):
            machine = fit_terms([t for t, j in zip(terms, judges, strict=True) if not j], toxic[~judges], kept)
            chance = machine.score([places(t, kept) for t, j in zip(terms, judges, strict=True) if j])
            chance = np.clip(chance, 1e-6, 1 - 1e-6)
            losses.append(-np.mean(np.where(toxic[judges] == 1, np.log(chance), np.log(1 - chance))))
        alone = both if losses[1] < LOWER_LOSS * losses[0] else alone
    return fit_terms(terms, toxic, alone)


def fit_terms(terms: list[np.ndarray], toxic: np.ndarray, kept: np.ndarray) -> Machine:
    """The machine of given terms."""
    n, n1 = len(toxic), float(toxic.sum())
    draw = np.random.default_rng(7)
    machine = Machine(float(np.log((n1 + 1e-6) / (n - n1 + 1e-6))), kept, np.zeros(len(kept)), draw.normal(0, 0.05, (len(kept), FACTORS)))
    rows = [places(x, kept) for x in terms]
    document, place, value, count = stacked(rows)
    state = {k: (0.0, 0.0) for k in ("bias", "weights", "vectors")}
    for step in range(1, ROUNDS + 1):
        raw, sums, parts = machine._raw(document, place, value, count)
        slope = (logistic(raw) - toxic) / n
        of = slope[document]
        by_vector = of[:, None] * value[:, None] * (sums[document] - parts)
        slopes = {
            "bias": slope.sum(),
            "weights": np.bincount(place, of * value, len(kept)) + RIDGE * machine.weights / n,
            "vectors": np.stack([np.bincount(place, by_vector[:, f], len(kept)) for f in range(FACTORS)], 1) + RIDGE * machine.vectors / n,
        }
        for name, g in slopes.items():
            m, v = state[name]
            state[name] = m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            change = LEARNING_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            setattr(machine, name, getattr(machine, name) - change)
    return machine


def places(found: np.ndarray, kept: np.ndarray) -> np.ndarray:
    at = np.searchsorted(kept, found)
    at[at == len(kept)] = 0
    return at[kept[at] == found] if len(kept) else np.zeros(0, np.int64)


def _sample_terms(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"toxic": batch["toxic"], "terms": [document_terms(t) for t in batch["text"]]})


def _fit_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task: the sample is bounded. Rows are put in an order of their own, so the machine does not depend on their arrival."""
    rows = sorted(((float(y), np.asarray(t, np.int64)) for b in batches for y, t in zip(b["toxic"], b["terms"], strict=True)), key=lambda r: (r[0], r[1].tobytes()))
    machine = fit_machine([t for _, t in rows], np.array([y for y, _ in rows]))
    yield pd.DataFrame({
        "term": [-1, *machine.terms.tolist()],
        "weight": [machine.bias, *machine.weights.tolist()],
        "vector": [[0.0] * FACTORS, *machine.vectors.tolist()],
    })


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Machine:
    """Fit on at most ``sample`` labelled documents; those of the held-out fold are never used."""
    usable = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("toxic")).where(F.col("_key").isNotNull() & F.col("toxic").isin(0, 1))
    usable = usable.where(~held_out("_key", FOLDS, HELD_OUT_FOLD))
    chosen = usable.orderBy(order_hash("toxicity", key_text("_key")), "toxic").limit(sample)
    # The sample's keys are bounded by ``sample``, so they can be sent to all executors.
    texts = bounded_batches(docs).select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key")
    terms = texts.select("toxic", "text").mapInPandas(_sample_terms, "toxic int, terms array<int>")
    rows = terms.repartition(1).mapInPandas(_fit_rows, "term long, weight double, vector array<double>").orderBy("term").collect()
    kept = [r for r in rows if r["term"] >= 0]
    bias = next((r["weight"] for r in rows if r["term"] < 0), float(np.log(1e-6)))
    return Machine(bias, np.array([r["term"] for r in kept], np.int64), np.array([r["weight"] for r in kept]), np.array([r["vector"] for r in kept]).reshape(-1, FACTORS))


class WordPlaces(dict):
    """Places of the kept terms of a word; remembers words up to a bound."""

    def __init__(self, kept: np.ndarray):
        super().__init__()
        self.place = {int(t): i for i, t in enumerate(kept)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.place[t] for t in word_terms(word) if t in self.place)
        if len(self) < KNOWN_WORDS:
            self[word] = found
        return found


def score_texts(machine: Machine, texts: Iterable[str | None], known: WordPlaces) -> np.ndarray:
    rows = []
    for text in texts:
        words = set(WORDS.findall(text.lower())) if text else ()
        rows.append(np.fromiter({p for found in map(known.__getitem__, words) if found for p in found}, np.int64))
    return machine.score([np.sort(r) for r in rows])


def scored(docs: DataFrame, machine: Machine, text: str = "text", into: str = "toxicity") -> DataFrame:
    """The documents with a column ``into`` of struct(score, predicted)."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most KEPT_TERMS * (FACTORS + 2) numbers

    @F.pandas_udf(SCORE_TYPE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = WordPlaces(shared.value.terms)
        for batch in batches:
            out = score_texts(shared.value, batch, known)
            yield pd.DataFrame({"score": out, "predicted": (out >= 0.5).astype(np.int32)})

    return bounded_batches(docs).withColumn(into, score(F.col(text)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text"), machine)
    return out.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT_FOLD).alias("held_out"), "toxicity.score", "toxicity.predicted")
