"""Language identification as mixture inference over character n-grams.

A document is taken as drawn from a mixture of languages, each a distribution over hashed byte
n-grams learned from labelled documents. Expectation-maximisation estimates the proportions. The
set of languages grows from the best single one, each time by the language along which the
likelihood rises most steeply, as long as the likelihood penalised by the number of languages
rises. The likelihood is concave in the proportions, so a language that it does not rise along
cannot help.

Defined cases: a missing text, or one without a letter, is ``und`` with score 0; very long texts
are read whole; texts with fewer letters than an n-gram are read with the blanks around them; ties
go to the language first by code point; documents without a language are not learned from; with
nothing learned every document is ``und``; repeated rows count repeatedly; an empty table gives an
empty result; columns other than key, text and language are ignored by the predictions, whatever
their names, and carried along by ``identified``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, held_out, key_text, order_hash, table

#: Documents the n-gram distributions are learned from at most, chosen by a hash of their key.
SAMPLE_DOCUMENTS = 20_000
NGRAM = 4
BUCKETS = 1 << 16
SMOOTHING = 0.2
#: Each further language costs this many times the logarithm of the number of n-grams.
PENALTY = 2.0
EM_ROUNDS = 12
FOLDS, HELD_OUT_FOLD = 4, 2
UNDETERMINED = "und"
LANGUAGE_TYPE = "lang_pred string, score double, fit double, languages array<string>, proportions array<double>"

NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass
class Languages:
    """Names in order, and a row of n-gram probabilities for each."""

    names: list[str]
    chances: np.ndarray


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text's letters and how often each occurs."""
    letters = f" {NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "replace")
    raw = np.frombuffer(letters.ljust(NGRAM), np.uint8).astype(np.uint32)
    code = raw[: len(raw) - NGRAM + 1].copy()
    for i in range(1, NGRAM):
        code |= raw[i : len(raw) - NGRAM + 1 + i] << np.uint32(8 * i)
    places = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)
    places.sort(kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return places[starts], np.diff(np.append(starts, len(places)))


def proportions(chances: np.ndarray, counts: np.ndarray, start: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float]:
    """EM for the proportions of the rows of ``chances``; the log-likelihood at the end."""
    share, total = start, counts.sum()
    for _ in range(rounds):
        mix = share @ chances
        share = share * (chances @ (counts / mix)) / total
    return share, float(counts @ np.log(share @ chances))


def mixture(languages: Languages, text: str | None) -> tuple[list[int], np.ndarray, float]:
    """Chosen languages, their proportions, and the mean log-likelihood ratio to evenly random n-grams."""
    if not text or not languages.names or not any(map(str.isalpha, text)):
        return [], np.zeros(0), 0.0
    places, counts = ngram_counts(text)
    chances, counts = languages.chances[:, places], counts.astype(np.float64)
    alone = np.log(chances) @ counts
    best = int(np.argmax(alone))
    chosen, share, reached, total = [best], np.ones(1), float(alone[best]), counts.sum()
    price = PENALTY * np.log(total + 1)
    while len(chosen) < len(languages.names):
        rise = chances @ (counts / (share @ chances[chosen])) - total
        rise[chosen] = -np.inf
        more = int(np.argmax(rise))
        if rise[more] <= 0:
            break
        grown, value = proportions(chances[[*chosen, more]], counts, np.append(share * 0.8, 0.2))
        if value - reached <= price:
            break
        chosen, share, reached = [*chosen, more], grown, value
    return chosen, share, reached / total + np.log(BUCKETS)


def predict(languages: Languages, texts: Iterable[str | None]) -> pd.DataFrame:
    rows = []
    for text in texts:
        chosen, share, fit = mixture(languages, text)
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
        names, shares = [languages.names[chosen[i]] for i in order], [float(min(1.0, share[i])) for i in order]
        rows.append((names[0], shares[0], float(fit), names, shares) if names else (UNDETERMINED, 0.0, 0.0, [], []))
    return pd.DataFrame(rows, columns=["lang_pred", "score", "fit", "languages", "proportions"])


def _count_ngrams(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            if any(map(str.isalpha, text)):
                places, counts = ngram_counts(text)
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[places] += counts
        for lang, counts in sums.items():
            there = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "place": there.astype(np.int32), "n": counts[there]})


def fit_languages(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Languages:
    """Learn from at most ``sample`` documents with a language; those of the held-out fold are never used.

    What reaches the driver is one row of BUCKETS counts per language.
    """
    usable = bounded_batches(docs).where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(key, FOLDS, HELD_OUT_FOLD))
    rank = order_hash("language", key_text(key), F.col(lang))
    last = usable.select(rank.alias("_rank")).orderBy("_rank").limit(sample).agg(F.max("_rank")).first()[0]
    if last is None:
        return Languages([], np.zeros((0, BUCKETS)))
    chosen = usable.where(rank <= last).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = chosen.mapInPandas(_count_ngrams, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    chances = np.full((len(rows), BUCKETS), SMOOTHING)
    for row, r in zip(chances, rows, strict=True):
        row[r["places"]] += r["n"]
    return Languages([r["lang"] for r in rows], chances / chances.sum(1, keepdims=True))


def identified(docs: DataFrame, languages: Languages, text: str = "text", into: str = "language") -> DataFrame:
    """The documents with a column ``into`` of struct(lang_pred, score, fit, languages, proportions)."""
    shared = docs.sparkSession.sparkContext.broadcast(languages)  # BUCKETS numbers per language

    @F.pandas_udf(LANGUAGE_TYPE)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predict(shared.value, batch)

    return bounded_batches(docs).withColumn(into, identify(F.col(text)))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identified(docs.select("doc_id", "text"), fit_languages(docs))
    return out.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT_FOLD).alias("held_out"), "language.lang_pred", "language.score", "language.languages", "language.proportions")
