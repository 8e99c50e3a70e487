"""Ops 7 and 8 against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import nearest, simhash

VECTOR = "vec_id long, embedding array<double>, label string"


def plain_nearest(ids, rows, queries, k):
    out = []
    for q in queries:
        v = rows[np.flatnonzero(ids == q)[0]]
        score = (rows * v).sum(1)
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort((ids[others], -score[others]))][:k]
        out += [(q, r + 1, ids[j], score[j]) for r, j in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block,group", [(4096, 200_000), (5, 20)])
def test_nearest_on_given_table(spark, block, group):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    pdf = table.toPandas()
    ids, rows = pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(float)
    got = nearest.nearest(table, F.col("vec_id") % 20 == 0, query_block=block, group_rows=group).collect()
    assert sorted(map(tuple, got)) == plain_nearest(ids, rows, ids[ids % 20 == 0], 20)


def test_nearest_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], "x") for i in range(0, 60)] + [(100, [0.0, 0.0], "x"), (120, None, "x"), (140, [nan, 1.0], "x"), (160, [inf, 1.0], "x"), (180, [None, 1.0], "x"), (200, [], "x"), (None, [9.0, 9.0], "x"), (220, [1.0, 2.0, 3.0], "x"), (101, [1e-300, 1e300], "x"), (102, [-1.0, -2.0], None)]
    table = spark.createDataFrame(rows, VECTOR).withColumn("score", F.lit("clash")).withColumn("rank", F.lit(1))
    got = nearest.nearest(table, F.col("vec_id") % 20 == 0, k=20)
    by = {q: [(r.rank, r.vec_id) for r in sorted(got.where(F.col("query_id") == q).collect(), key=lambda r: r.rank)] for q in (0, 20, 40)}
    for q, found in by.items():
        want = [101] + [i for i in range(60) if i != q][:19]
        assert [v for _, v in found] == want and [r for r, _ in found] == list(range(1, 21))
    assert got.select("query_id").distinct().count() == 3
    assert nearest.nearest(spark.createDataFrame([], VECTOR), F.col("vec_id") % 20 == 0).count() == 0
    few = nearest.nearest(spark.createDataFrame(rows[:3], VECTOR), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in sorted(few, key=lambda r: r.rank)] == [(0, 1), (0, 2)]


def test_int8_bounds_hold():
    draw = np.random.default_rng(0)
    a, b = draw.normal(size=(50, 64)), draw.normal(size=(80, 64)) * 10 ** draw.uniform(-3, 3, (80, 1))
    qa, qb = nearest.Int8(a), nearest.Int8(b)
    rough = nearest.int8_products(qa.whole, qb.whole) * qa.scale[:, None] * qb.scale
    slack = qa.error[:, None] * (qb.norm + qb.error) + qa.norm[:, None] * qb.error
    assert (np.abs(rough - a @ b.T) <= slack + 1e-9).all()
    wide = draw.integers(-127, 128, (3, 3000)).astype(np.int8)
    assert np.array_equal(nearest.int8_products(wide, wide), wide.astype(np.int64) @ wide.astype(np.int64).T)


def plain_fingerprints(rows):
    """Bit by bit, over all occurrences."""
    known = simhash.WordHashes()
    out = []
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), simhash.zstandard.ZstdCompressor(level=1).compress((r[1] or "").encode())))
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        changed = simhash.edited(text, following)
        mark, changed_mark, next_mark = (simhash.fingerprint(t, known) for t in (text, changed, following))
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), mark.tobytes().hex(), changed_mark.tobytes().hex(), simhash.likeness(mark, changed_mark), simhash.likeness(mark, next_mark)))
    return out


@pytest.mark.parametrize("name", ["docs", "edge_docs"])
def test_fingerprints(request, monkeypatch, name):
    monkeypatch.setattr(simhash, "RANGE_ROWS", 20)
    table = request.getfixturevalue(name)
    got = [tuple(r) for r in simhash.fingerprints(table).collect()]
    want = plain_fingerprints([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])
    assert sorted(got, key=str) == sorted(want, key=str)


def test_edited_hashes_are_those_of_the_edited_text():
    known = simhash.WordHashes()
    texts = ["", "a", "a b", "ab cd ef gh", " lead and trail \n", "x" * 50, "Σίσυφος ΟΔΟΣ ΟΔΟΣ' B", "one\u2003two  three", "   ", "İx Yz ab"]
    for text in texts:
        for following in texts:
            own, next_own = (simhash.word_hashes(t.lower().split(), known) for t in (text, following))
            want = simhash.word_hashes([w.lower() for w in simhash.edited(text, following).split()], known)
            assert np.array_equal(simhash.edited_hashes(text, own, following, next_own, known), want)


def test_fingerprint_edges(spark, empty_docs):
    assert simhash.fingerprints(empty_docs).count() == 0
    one = simhash.fingerprints(spark.createDataFrame([(5, "abc def ghi")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 11
    known = simhash.WordHashes()
    slow = np.zeros(simhash.BITS)
    words = "a b c a b d a b".split()
    terms = {}
    for x, y in zip(words, words[1:]):
        terms[x, y] = terms.get((x, y), 0) + 1
    with np.errstate(over="ignore"):
        for (x, y), n in terms.items():
            t = np.array([known[x]], np.uint64) * simhash._M1 + simhash.mixed(np.array([known[y]], np.uint64))
            bits = np.unpackbits(np.stack([simhash.mixed(t), simhash.mixed(t + simhash._M1)], 1).view(np.uint8))
            slow += np.rint(64 * (1 + np.log(n))) * (2.0 * bits - 1)
    assert np.array_equal(np.packbits(slow > 0), simhash.fingerprint(" ".join(words), known))


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_radius_search_finds_all(spark, bucket_rows):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2, (12, simhash.BITS))
    marks = []
    for i in range(400):
        bits = base[i % 12].copy()
        flip = draw.choice(simhash.BITS, draw.integers(0, 7), replace=False)
        bits[flip] ^= 1
        marks.append(np.packbits(bits).tobytes().hex())
    rows = [(m, marks.count(m), i % 3 == 0) for i, m in enumerate(dict.fromkeys(marks))]
    got = dict(map(tuple, simhash.near_counts(spark.createDataFrame(rows, "fingerprint string, copies long, asked boolean"), bucket_rows=bucket_rows).collect()))
    for mark, _, asked in rows:
        near = sum(n for other, n, _ in rows if other != mark and (int(other, 16) ^ int(mark, 16)).bit_count() <= simhash.RADIUS)
        assert got.get(mark, 0) == (near if asked else 0)


@pytest.mark.parametrize("cell_rows", [1, 64])
def test_radius_reaches_near_copies(spark, cell_rows):
    """Texts with a five-word Jaccard similarity of at least 0.8 are within the radius, unrelated ones are not."""
    draw = np.random.default_rng(5)
    texts = []
    for _ in range(60):
        words = [f"w{x}" for x in draw.integers(0, 5000, 200)]
        texts.append(words)
        for changes in (1, 2, 3, 4):
            copy = list(words)
            for at in draw.choice(200, changes, replace=False):
                copy[at] = f"x{draw.integers(0, 5000)}"
            texts.append(copy)
    known = simhash.WordHashes()
    marks = [simhash.fingerprint(" ".join(t), known).tobytes().hex() for t in texts]
    grams = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    rows = [(m, marks.count(m), True) for m in dict.fromkeys(marks)]
    got = dict(map(tuple, simhash.near_counts(spark.createDataFrame(rows, "fingerprint string, copies long, asked boolean"), cell_rows=cell_rows).collect()))
    met = wanted = 0
    for i, mark in enumerate(marks):
        near = [sum((int(m, 16) ^ int(mark, 16)).bit_count() <= simhash.RADIUS for m in (marks[j],)) for j in range(len(texts)) if j != i and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
        met, wanted = met + sum(near), wanted + len(near)
        other = sum(marks[j] != mark and (int(marks[j], 16) ^ int(mark, 16)).bit_count() <= simhash.RADIUS for j in range(len(texts)))
        assert got.get(mark, 0) == other < 5
    assert wanted > 400 and met >= 0.97 * wanted
