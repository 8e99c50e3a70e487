"""Op 1: pieces against the tokenizer on whole texts, places against the rules, fillings against brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyframe.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


def plain_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            yield key, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


@pytest.mark.parametrize("capacity", [4096, 100])
@pytest.mark.parametrize("name", ["docs", "edge_docs"])
def test_pieces_and_places(request, name, capacity):
    table = request.getfixturevalue(name)
    got = packing.pack(table, capacity=capacity).toPandas()
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    have = [tuple(None if x != x else x for x in r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).values.tolist()]
    assert sorted(have, key=str) == sorted(plain_pieces(rows, capacity), key=str)
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all() and sequence.length.sum() <= capacity
    assert got.sequence_id.nunique() <= 1.01 * got.length.sum() / capacity + 1


def test_empty(empty_docs):
    assert packing.pack(empty_docs).count() == 0


@given(st.lists(st.sampled_from("abc 'x's <|endoftext|> Don't ÉÈ ß.. 12a\t  ǅ İ Σ é'll a.b !!? ́".split(" ")) | st.text(max_size=6), max_size=12))
@settings(max_examples=80, deadline=None)
def test_words_are_tokenized_as_in_whole_texts(words):
    text = " ".join(words)
    tokens = packing.WordTokens(PATH)
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert tokens.documents([text])[0] == np.array(want, "<u4").tobytes()


@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_fillings_are_valid_and_few(lengths):
    capacity = 30
    counts = np.bincount(lengths, minlength=capacity + 1)
    fillings = packing.pack_lengths(counts, capacity)
    placed = np.zeros(capacity + 1, np.int64)
    for f in fillings:
        assert sum(length * n for length, n in f.parts) <= capacity
        for length, n in f.parts:
            placed[length] += n * f.times
    assert (placed == counts).all()
    assert sum(f.times for f in fillings) == optimum(lengths, capacity)


def optimum(lengths, capacity):
    n = len(lengths)
    best = [(n + 1, 0)] * (1 << n)
    best[0] = (1, 0)
    for done in range(1 << n):
        for i in range(n):
            if not done >> i & 1:
                used, full = best[done]
                new = (used, full + lengths[i]) if full + lengths[i] <= capacity else (used + 1, lengths[i])
                best[done | 1 << i] = min(best[done | 1 << i], new)
    return best[-1][0]


def test_search_beats_both_greedy_passes_at_thousands_of_lengths():
    lengths = np.random.default_rng(1).integers(600, 3000, 100_000)
    counts = np.bincount(lengths, minlength=4097)
    greedy, found = (packing.pack_lengths(counts, 4096, rounds) for rounds in (0, 250))
    least = packing.least_sequences(counts, 4096)
    size = lambda fillings: sum(f.times for f in fillings)
    assert (counts > 0).sum() > 2000 and least <= size(found) <= size(greedy) - 30
    used = np.zeros_like(counts)
    for f in found:
        assert packing.waste_of(f.parts, 4096) >= 0
        for length, n in f.parts:
            used[length] += n * f.times
    assert (used == counts).all()


@given(st.lists(st.integers(1, 30), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_lower_bound(lengths):
    counts = np.bincount(lengths, minlength=31)
    assert packing.least_sequences(counts, 30) <= sum(f.times for f in packing.pack_lengths(counts, 30))
