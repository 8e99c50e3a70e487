"""Op 13 against plain counting, with every limit small enough to matter."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import collocations


def plain(rows, longest=5, least=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    frequent = {k: c for k, c in f.items() if c >= least}
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = []
    for (lang, p), a in frequent.items():
        if len(p) < 2 or any(b >= a and len(q) > len(p) and l2 == lang and inside(p, q) for (l2, q), b in frequent.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, collocations.collocations(df, **options).collect()))


@pytest.mark.parametrize("least", [3, 30])
def test_against_plain(docs, least):
    some = docs.where("doc_id < 60")
    rows = [tuple(r) for r in some.select("lang", "text").collect()]
    assert found(some, least=least) == plain(rows, least=least)


def test_small_blocks_and_a_full_bitmap_change_nothing(spark):
    draw = random.Random(5)
    text = lambda k: "".join(draw.choice(["a", "b", "Ca", "dd", "eé"]) + draw.choice([" ", " ", "  ", "\t", ".", "\n", " ! "]) for _ in range(k))
    rows = [(draw.choice(["x", "y", None]), text(draw.choice([0, 3, 40, 900]))) for _ in range(40)] + [("x", None), ("x", "w" * 500), ("y", "a b " * 700)]
    df = spark.createDataFrame(rows, "lang string, text string")
    want = plain(rows, least=4)
    assert want and found(df, least=4) == want
    assert found(df, least=4, block_bytes=64) == want
    for bits in (64, 256, 2048):
        assert found(df, least=4, filter_bits=bits) == want
    assert found(df, least=4, longest=2) == plain(rows, longest=2, least=4)


def test_stripes_are_added_up_before_they_become_rows(spark, monkeypatch):
    texts = [(lang, " ".join(f"{lang}{i % 7} b{i % 3}" for i in range(k, k + 40))) for k in range(60) for lang in "xy"]
    blocks = collocations.text_blocks(spark.createDataFrame(texts, "lang string, text string").repartition(3), 1, 64)
    known = [spark.sparkContext.broadcast(np.full(1, 2**64 - 1, np.uint64))] * 2
    want = Counter()
    for lang, text in texts:
        words = text.split()
        for prefix, word in [("", w) for w in words] + list(zip(words, words[1:])):
            want[lang, prefix, word] += 1
    merged = collocations.merged_stripes(blocks, 2, known)
    assert {(r.lang, r.prefix, r.word): r.f for r in merged.collect()} == want
    assert blocks.count() > 60 and "Generate" not in merged._jdf.queryExecution().toString()
    # Small holds hand on more tables, and change no number.
    for held in (4, 1000):
        monkeypatch.setattr(collocations, "HELD_ELEMENTS", held)
        parts = (t for b in blocks.toArrow().to_batches() for i in range(b.num_rows) for t in collocations._Block(b, i, known).stripes(2))
        again = Counter()
        for sheets in map(collocations._sheets, collocations._merged(parts)):
            for r in collocations._elements(sheets).to_pylist():
                again[r["lang"], r["prefix"], r["word"]] += r["n"]
        assert again == want


def test_phrases_are_counted_as_entries_that_meet_by_cell(spark, monkeypatch):
    draw = random.Random(7)
    # Without an end of a piece, so that every word starts a pair but the last of a text; "of" beyond what one entry counts.
    texts = [("x", " ".join(draw.choice(["of", "of", "a", "b", f"w{draw.randrange(400)}"]) for _ in range(60))) for _ in range(40)] + [("y", "of a")] * 3
    want = [Counter(), Counter()]
    for lang, text in texts:
        words = text.split()
        want[0].update((lang, w) for w in words)
        want[1].update((lang, *pair) for pair in zip(words, words[1:]))
    assert max(want[0].values()) > 510
    met, bitmap = [], collocations._bitmap
    monkeypatch.setattr(collocations, "_bitmap", lambda frequent, bits: (met.append(frequent), bitmap(frequent, bits))[1])
    elements, _ = collocations.frequent_phrases(spark.createDataFrame(texts, "lang string, text string").repartition(4), longest=2, least=3, block_bytes=64)
    elements.collect()
    for counts, frequent in zip(want, met, strict=True):
        assert sorted(r.n for r in frequent.collect()) == sorted(c for c in counts.values() if c >= 3)
        # No row for a phrase before it is known to be frequent: neither dealt out nor added up by Spark.
        assert "Aggregate" not in frequent._jdf.queryExecution().optimizedPlan().toString()


def test_entries_keep_hashes_and_counts(monkeypatch):
    draw = np.random.default_rng(3)
    hashes = draw.integers(0, 2**64, 300, np.uint64)
    occurrences = np.concatenate([hashes, np.repeat(hashes[:3], [254, 255, 1020]), draw.choice(hashes, 900)])
    low = lambda h: int(h) % 2**56
    want = Counter(map(low, occurrences))
    draw.shuffle(occurrences)
    for cells in (1, 7, 1000):
        rows = [r for part in np.array_split(occurrences, 5) for b in collocations._dealt([part], cells) for r in b.to_pylist()]
        parts = {cell: [np.frombuffer(r["entries"], np.uint64) for r in rows if r["cell"] == cell] for cell in {r["cell"] for r in rows}}
        assert set(parts) <= set(range(cells)) and (cells > 1) == (len(parts) > 1)
        for held in (1, 50, 1 << 19):
            monkeypatch.setattr(collocations, "HELD_PHRASES", held)
            again = [r for cell in parts.values() for b in collocations._met(iter(cell), 4) for r in b.to_pylist()]
            assert len({r["hash"] for r in again}) == len(again) and {r["hash"]: r["n"] for r in again} == {h: n for h, n in want.items() if n >= 4}
    assert not list(collocations._dealt([occurrences[:0]], 5)) and not list(collocations._met(iter([]), 1))


def test_a_large_table_of_elements_is_merged_in_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "HELD_ELEMENTS", 64)
    table = pa.Table.from_arrays(
        [pa.array([1] * 1000, pa.int32()), pa.array(["x"] * 1000), pa.array([""] * 1000), pa.array([f"w{i % 900}" for i in range(1000)]), pa.array([2] * 1000)],
        schema=collocations._DEALT_ARROW)
    merged = list(collocations._merged(iter([table])))
    assert max(map(len, merged)) <= 64 + 64 // 4
    again = Counter()
    for t in merged:
        for r in t.to_pylist():
            again[r["word"]] += r["n"]
    assert again == Counter({f"w{i}": 4 if i < 100 else 2 for i in range(900)})


def test_sheets_hold_a_line_for_each_element():
    rows = [(3, "x", "", "of", 4), (1, "x", "a b", "c", 2), (3, "x", "a b c d", "é", 1), (3, "y", "", "of", 1 << 40), (1, "x", "", "\xa0", 7)]
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), collocations._DEALT_ARROW)], schema=collocations._DEALT_ARROW)
    sheets = collocations._sheets(table)
    assert sorted((r["cell"], r["lang"], len(r["counts"])) for r in sheets.to_pylist()) == [(1, "x", 2), (3, "x", 2), (3, "y", 1)]
    # One text in place of a list: Spark holds no place and length for every word of it.
    assert sheets.schema.field("phrases").type == pa.string()
    for some in (sheets, sheets.slice(0, 1), sheets.slice(1)):
        cells = [r["cell"] for r in some.to_pylist() for _ in r["counts"]]
        again = [(cell, r["lang"], r["prefix"], r["word"], r["n"]) for cell, r in zip(cells, collocations._elements(some).to_pylist(), strict=True)]
        assert set(again) <= set(rows) and len(set(again)) == len(cells)


def test_edges(edge_docs, empty_docs):
    rows = [tuple(r) for r in edge_docs.select("lang", "text").collect()]
    for least in (1, 2):
        short = [r for r in rows if r[1] is None or len(r[1]) < 1000]
        kept = edge_docs.where("text is null or length(text) < 1000")
        assert found(kept, least=least) == plain(short, least=least)
    assert found(edge_docs, least=31) == plain(rows, least=31)
    assert found(empty_docs) == []


def test_products_beyond_64_bits_and_ranks(spark):
    rows = [("x", "p q", 3_000_000_000_000, 3_000_000_000_000, 3_000_000_000_000, 9_000_000_000_000, 1)] * 1
    exact = 1000 * 3_000_000_000_000 * 9_000_000_000_000 // (3_000_000_000_000**2)
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    assert df.select(collocations.cut_score().alias("s")).first().s == exact
    many = spark.range(50).select(
        F.lit("x").alias("lang"), F.concat(F.lit("p"), "id").alias("phrase"), *[F.lit(7).cast("long").alias(c) for c in ("a", "l", "r", "n")],
        (F.col("id") % 5).alias("score"))
    top = collocations.leading(many, 12).orderBy("rank").collect()
    assert [r["rank"] for r in top] == list(range(1, 13)) and [r.phrase for r in top[:3]] == ["p14", "p19", "p24"]
