"""Ops 2 and 10: held-out accuracy on the given tables, and what the methods promise on small ones."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import langid, queries, toxicity

BIG = "/root/testdata/sf0.01"


def fold(keys, folds):
    return keys.map(lambda k: zlib.crc32(str(k).encode()) % folds)


@pytest.fixture(scope="module")
def languages(spark):
    return langid.fit_languages(spark.read.parquet(f"{BIG}/documents.parquet"))


def test_language_accuracy(spark):
    got = queries.QUERIES["op2_language_mixture"](spark, BIG).toPandas()
    want = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").toPandas()
    both = want.merge(got, on="doc_id")
    assert len(both) == len(want) and (both.held_out == (fold(both.doc_id, 4) == 2)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98 and both.score.between(0, 1).all()


def test_mixture_finds_both_languages(spark, languages):
    pdf = spark.read.parquet(f"{BIG}/documents.parquet").where("n_chars between 800 and 3000").toPandas()
    en, de = (pdf[pdf.lang == x].text.iloc[3] for x in ("en", "de"))
    chosen, share, _ = langid.mixture(languages, en[:800] + " " + de[:400])
    found = {languages.names[i]: s for i, s in zip(chosen, share)}
    assert set(found) == {"en", "de"} and 0.5 < found["en"] < 0.8
    assert len(langid.mixture(languages, en)[0]) == 1


def test_em_climbs_to_the_best_proportions():
    draw = np.random.default_rng(0)
    chances = draw.dirichlet(np.ones(40), 2)
    counts = draw.multinomial(5000, 0.3 * chances[0] + 0.7 * chances[1]).astype(float)
    share, value = langid.proportions(chances, counts, np.array([0.5, 0.5]), 200)
    grid = [(counts @ np.log(p * chances[0] + (1 - p) * chances[1]), p) for p in np.linspace(0.001, 0.999, 999)]
    assert abs(share[0] - max(grid)[1]) < 2e-3 and value >= max(grid)[0] - 1e-6


def test_held_out_documents_are_not_learned_from(spark, docs):
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit_languages(docs), langid.fit_languages(changed)
    assert a.names == b.names and np.array_equal(a.chances, b.chances)


def test_language_edges(spark, languages, edge_docs, empty_docs):
    got = langid.identified(edge_docs, languages)
    assert got.columns == [*edge_docs.columns, "language"]
    rows = got.select("doc_id", "text", "language.*").toPandas()
    no_letter = rows[rows.text.isna() | ~rows.text.fillna("").map(lambda t: any(c.isalpha() for c in t))]
    assert len(no_letter) == 5 and (no_letter.lang_pred == "und").all() and (no_letter.score == 0).all()
    assert rows.drop(no_letter.index).lang_pred.isin(languages.names).all()
    assert langid.identified(empty_docs, languages).count() == 0
    nothing = langid.fit_languages(empty_docs)
    assert langid.identified(edge_docs, nothing).where("language.lang_pred <> 'und'").isEmpty()
    assert langid.fit_languages(edge_docs).names


def test_toxicity_accuracy(spark):
    got = queries.QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas().merge(got, on="doc_id")
    assert (got.held_out == (fold(got.doc_id, 5) == 0)).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    held = labels[labels.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.85 and held[held.toxic == 0].predicted.mean() < 0.01


def test_machine_learns_a_meeting_of_terms():
    """Neither term is toxic alone, only both together: additive weights cannot tell."""
    draw = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(2000):
        a, b = i % 2, i // 2 % 2
        noise = [toxicity.hashed(f"n{x}") for x in draw.integers(0, 40, 2)]
        rows.append(np.unique(np.array(noise + [toxicity.hashed("insult")] * a + [toxicity.hashed("group")] * b + [toxicity.hashed("plain")] * (1 - a))))
        labels.append(a == b)
    y = np.array(labels, float)
    machine = toxicity.fit_machine(rows, y)
    score = machine.score([toxicity.places(r, machine.terms) for r in rows])
    assert ((score >= 0.5) == (y == 1)).mean() > 0.95


def test_a_meeting_is_learned_among_many_other_terms():
    """A group mention at the usual share of toxic documents turns toxic beside an insult; plainly toxic words are there as well."""
    draw = np.random.default_rng(4)
    group, insult, plain = (toxicity.hashed(w + " ") for w in ("group", "insult", "plainlytoxic"))
    vocabulary = np.array([toxicity.hashed(f"n{i}") for i in range(3000)])

    def documents(count):
        rows, labels, met = [], [], []
        for _ in range(count):
            words = vocabulary[np.unique((3000 * draw.random(120) ** 2).astype(int))].tolist()
            has = draw.random(3) < (0.15, 0.15, 0.05)
            rows.append(np.unique(np.array(words + [t for t, h in zip((group, insult, plain), has) if h])))
            labels.append(bool(has[2] or (has[0] and has[1])))
            met.append((has[0] and has[1], has[2], has[0] != has[1]))
        return rows, np.array(labels, float), np.array(met)

    machine = toxicity.fit_machine(*documents(2500)[:2])
    rows, y, met = documents(1500)
    found = machine.score([toxicity.places(r, machine.terms) for r in rows]) >= 0.5
    assert found[met[:, 0]].mean() > 0.8 and found[met[:, 1]].mean() > 0.9
    assert found[met[:, 2] & (y == 0)].mean() < 0.05 and found[y == 0].mean() < 0.02


def test_score_is_the_sum_over_pairs():
    draw = np.random.default_rng(2)
    machine = toxicity.Machine(-0.3, np.arange(9), draw.normal(size=9), draw.normal(size=(9, toxicity.FACTORS)))
    rows = [np.array([0, 3, 4, 8]), np.array([5]), np.zeros(0, np.int64), np.arange(9)]
    for row, got in zip(rows, machine.score(rows)):
        x = 1 / np.sqrt(max(len(row), 1))
        raw = machine.bias + sum(machine.weights[i] * x for i in row)
        raw += sum(machine.vectors[i] @ machine.vectors[j] * x * x for a, i in enumerate(row) for j in row[a + 1 :])
        assert np.isclose(got, 1 / (1 + np.exp(-raw)))


def test_pairs_of_a_document(monkeypatch):
    monkeypatch.setattr(toxicity, "PAIRS_AT_ONCE", 10)
    for size in (0, 1, 2, 7, 30):
        terms = np.arange(size) * 3
        got = [p for a, b in toxicity.pairs_of(terms) for p in zip(a.tolist(), b.tolist())]
        assert got == [(3 * i, 3 * j) for i in range(size) for j in range(i + 1, size)]


def test_toxicity_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(12, 1), (4, 0), (5, 0), (12, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    machine = toxicity.fit_toxicity(edge_docs, labels)
    got = toxicity.scored(edge_docs, machine)
    assert got.columns == [*edge_docs.columns, "toxicity"]
    rows = got.select("text", "toxicity.*").toPandas()
    assert len(rows) == 15 and rows.score.between(0, 1).all() and rows[rows.text.isna()].score.nunique() == 1
    assert toxicity.scored(empty_docs, machine).count() == 0
    none = toxicity.fit_toxicity(empty_docs, labels)
    assert (toxicity.scored(edge_docs, none).select("toxicity.score").toPandas().score < 0.01).all()
    known = toxicity.WordPlaces(machine.terms)
    assert isinstance(pd.Series(toxicity.score_texts(machine, [None, "", "idiot"], known)), pd.Series)
