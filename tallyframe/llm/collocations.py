"""Phrases whose words keep company more often than chance, mined with stripes.

A stripe is a prefix with a counter of the words that follow it. Tasks count stripes over bounded
blocks of text; stripes of one prefix are merged element by element (prefix, next word, count), so a
prefix followed by very many words is never one row. A task merges the stripes of its blocks, deals their
elements to cells by a hash of the phrase and hands on one sheet per cell; where the sheets of a cell meet
they are merged again before their elements become rows. All numbers come from this one structure: the
count of a phrase is its element, the stripe of the empty prefix holds the words, the largest element
of a prefix tells whether a longer phrase takes all its occurrences, and the elements of the longer
prefixes tell the same of extensions to the left.

Most phrases are rare, and no rare one is worth a stripe. A phrase cannot be more frequent than its
parts, so before the stripes one pass per length counts 56-bit hashes of the phrases whose longer parts
were frequent a pass before, and keeps a bitmap of ``filter_bits`` bits, whose size does not grow with the
corpus, of the frequent ones. A hash and its count are one number, an entry; entries go from task to task
as one row per cell, a range of hashes, so that no phrase is a row before it is known to be frequent.
Hashes that collide and bits set by chance only let more phrases pass:
the stripes count words, exactly. Texts are split into words once; the passes read numbered words.

Defined cases: a missing text counts as empty, a missing language as ``und``; words are cut by blank
and tab only, pieces by ``.,;:!?`` and line ends, other characters belong to words; a repeated row
counts again; a text of any length is read in blocks that hand over at a word, with the words a
phrase may need from the next block; equal scores are ordered by count, then phrase; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, empty_if_null, table
from tallyframe.session import materialize, shuffle_partitions

LONGEST = 5
LEAST = 100
TOP = 2000
FILTER_BITS = 1 << 24
#: Bytes of text that a task counts at once.
BLOCK_BYTES = 1 << 21
SALTS = 64

UNDETERMINED = "und"
#: Fixed values of the task: what ends a piece, what parts words.
PIECE_ENDS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
_CLEAN = bytes(10 if chr(b) in PIECE_ENDS else 32 if chr(b) in BLANKS else b for b in range(256))
#: Elements of stripes; the part of them that lies in one cell is a sheet.
_ELEMENT_ARROW = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("word", pa.string()), ("n", pa.int64())])
_DEALT_ARROW = pa.schema([("cell", pa.int32()), *_ELEMENT_ARROW])
#: A sheet's phrases are one text, a line for each with a blank between prefix and next word; no word has blanks or line ends.
_SHEET = "cell int, lang string, phrases string, counts array<bigint>"
_SHEET_ARROW = pa.schema([("cell", pa.int32()), ("lang", pa.string()), ("phrases", pa.string()), ("counts", pa.list_(pa.int64()))])
CELLS = 256
#: Elements a task holds before it hands them on, and elements handed on at once.
HELD_ELEMENTS, HANDED_ELEMENTS = 1 << 17, 1 << 14


_BLOCK = "lang string, words array<string>, numbers binary, starts binary, n long"
_BLOCK_ARROW = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("numbers", pa.binary()), ("starts", pa.binary()), ("n", pa.int64())])
_ENTRIES_ARROW = pa.schema([("cell", pa.int32()), ("entries", pa.binary())])
_HASH_ARROW = pa.schema([("hash", pa.int64()), ("n", pa.int64())])
#: Row groups and pages of a few blocks, so that writer and reader hold no more of them at once.
_FEW_AT_ONCE = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.row.count.limit": "1"}
#: Phrases a task holds before it hands on their counts, also the most that one cell of hashes is meant to meet.
HELD_PHRASES = 1 << 19
#: An entry is a hash less its highest bits, and below it a count of at most FULL.
_COUNT_BITS, FULL = np.uint64(8), 255
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Numbers(dict):
    """Numbers words in order of their first appearance from 1; what ends a piece is 0, and blanks between words -1."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word):
        self[word] = number = len(self) - 1
        return number


def _blocks(body: bytes, ahead: int, limit: int) -> Iterator[tuple[bytes, list[bytes]]]:
    """The text in parts of about ``limit`` bytes, each with up to ``ahead`` words that follow it in its piece."""
    at = 0
    while len(body) - at > limit:
        cut = body.rfind(b"\n", at + 1, at + limit)
        if cut < 0:
            cut = body.rfind(b" ", at + 1, at + limit)
        if cut < 0:
            ends = [x for x in (body.find(b" ", at + limit), body.find(b"\n", at + limit)) if x >= 0]
            cut = min(ends, default=len(body))
        yield body[at:cut], _following(body, cut, ahead)
        at = cut
    yield body[at:], []


def _following(body: bytes, at: int, ahead: int) -> list[bytes]:
    words = []
    while len(words) < ahead and at < len(body) and body[at] != 10:
        if body[at] == 32:
            at += 1
            continue
        ends = [x for x in (body.find(b" ", at), body.find(b"\n", at)) if x >= 0]
        end = min(ends, default=len(body))
        words.append(body[at:end])
        at = end
    return words


def _numbered(lang: str, parts: Sequence[tuple[bytes, list[bytes]]]) -> pa.RecordBatch:
    """A block: its different words, the words in order as numbers, and which of them may start a phrase."""
    numbers, order, starts = _Numbers(), [], []
    for body, after in parts:
        tokens = body.replace(b"\n", b" \n ").split(b" ")
        inside = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
        inside = inside[inside >= 0]
        order += [inside, np.array([*map(numbers.__getitem__, after), 0], np.int32)]
        starts += [inside > 0, np.zeros(len(after) + 1, bool)]
    own, words = np.concatenate(order), list(numbers)[2:]
    may_start = np.concatenate(starts)
    row = [
        pa.array([lang]), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words, pa.binary()).cast(pa.string())),
        pa.array([own.tobytes()]), pa.array([np.packbits(may_start).tobytes()]), pa.array([int(may_start.sum())])]
    return pa.RecordBatch.from_arrays(row, schema=_BLOCK_ARROW)


def text_blocks(docs: DataFrame, ahead: int, block_bytes: int) -> DataFrame:
    """The texts (lang, text) as blocks of numbered words of one language, written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        held: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _blocks(text.as_py().encode().lower().translate(_CLEAN), ahead, block_bytes):
                    waiting.setdefault(lang, []).append(part)
                    held[lang] = held.get(lang, 0) + len(part[0])
                    if held[lang] >= block_bytes:
                        yield _numbered(lang, waiting.pop(lang))
                        held[lang] = 0
            if sum(held.values()) >= 4 * block_bytes:
                for lang in list(waiting):
                    yield _numbered(lang, waiting.pop(lang))
                held = {}
        for lang, parts in waiting.items():
            yield _numbered(lang, parts)

    return materialize(bounded_batches(docs).mapInArrow(work, _BLOCK), "text-blocks", **_FEW_AT_ONCE)


def _word_hashes(words: pa.StringArray, lang: str) -> np.ndarray:
    """64-bit hashes of words, none of them empty: polynomials over their bytes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    starts, lengths = ends[:-1] - ends[0], np.diff(ends)
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _K1, np.uint64))
        hashes = np.add.reduceat((body + np.uint64(1)) * powers[np.arange(len(body)) - np.repeat(starts, lengths)], starts)
        return _mixed(hashes + np.uint64(zlib.crc32(lang.encode())) * _K2)


class _Block:
    """A block's numbered words; ``shared`` holds the bitmaps of frequent phrases of 1, 2, ... words."""

    def __init__(self, batch: pa.RecordBatch, i: int, shared: list):
        of = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
        self.lang, self.spelled = batch.column("lang")[i].as_py(), batch.column("words")[i].values
        self.order = of("numbers", np.int32)
        self.starts = np.unpackbits(of("starts", np.uint8), count=len(self.order)).astype(bool)
        self.hashes = np.concatenate([np.zeros(1, np.uint64), _word_hashes(self.spelled, self.lang)])
        self.known = [b.value for b in shared]

    def _is_known(self, length: int, hashes: np.ndarray) -> np.ndarray:
        bitmap = self.known[length - 1]
        bits = hashes % np.uint64(64 * len(bitmap))
        return (bitmap[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) == 1

    def phrases(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and hashes of the phrases of 1, 2, ... ``length`` words whose parts of two words or more are all known."""
        of_word = _mixed(self.hashes)
        at = np.flatnonzero(self.order > 0)
        hashes = of_word[self.order[at]]
        yield at, hashes
        if length == 1:
            return
        # Nearly all words of a large corpus are frequent, so pairs are counted without a look at them.
        keep = np.ones(len(at), bool)
        for n in range(2, length + 1):
            run = np.zeros(len(self.order) + 1, bool)
            run[at[keep]] = True
            keep &= run[at + 1]
            at, before = at[keep], hashes[keep]
            with np.errstate(over="ignore"):
                hashes = _mixed(before * _K1 + self.hashes[self.order[at + n - 1]])
            yield at, hashes
            if n < length:
                keep = self._is_known(n, hashes)

    def counted(self, length: int) -> np.ndarray:
        """Hashes of all phrases of that length that start here, one per occurrence."""
        for at, hashes in self.phrases(length):
            pass
        return hashes[self.starts[at]]

    def stripes(self, longest: int) -> Iterator[pa.Table]:
        """The elements of the stripes of all known phrases, with their cells: one table for each length."""
        size, words = len(self.hashes), self.spelled
        names, number = pa.array([""]), np.zeros(len(self.order), np.int64)
        for n, (at, hashes) in enumerate(self.phrases(longest), 1):
            # A phrase whose prefix is not known passed by a bit set by chance: it is rare.
            fine = self._is_known(n, hashes) & (number[at] >= 0)
            at, hashes = at[fine], hashes[fine]
            if not len(at):
                return
            found, which = np.unique(number[at] * size + self.order[at + n - 1], return_inverse=True)
            counts = np.bincount(which[self.starts[at]], minlength=len(found))
            prefix, word = names.take(pa.array(found // size)), words.take(pa.array(found % size - 1))
            cells = np.empty(len(found), np.int32)
            cells[which] = (hashes % np.uint64(CELLS)).astype(np.int32)
            seen = np.flatnonzero(counts)
            if len(seen):
                lang, own = pa.repeat(self.lang, len(seen)), pa.array(seen)
                columns = [lang, prefix.take(own), word.take(own), pa.array(counts[seen], pa.int64())]
                yield pa.Table.from_arrays([pa.array(cells[seen]), *columns], schema=_DEALT_ARROW)
            names = word if n == 1 else pc.binary_join_element_wise(prefix, word, " ")
            number = np.full(len(self.order), -1, np.int64)
            number[at] = which


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _K2
        return (x ^ (x >> np.uint64(27))) * _K1


def _entries(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes with their counts, in the order given; a count beyond FULL takes several entries."""
    times = (counts + (FULL - 1)) // FULL
    entries = np.repeat(hashes << _COUNT_BITS, times)
    own = np.full(len(entries), FULL, np.uint64)
    own[np.cumsum(times) - 1] = counts - (times - 1) * FULL
    entries |= own
    return entries


def _added_up(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of some entries, at least one, in order, and their counts. The entries get sorted."""
    entries.sort()
    hashes = entries >> _COUNT_BITS
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat((entries & np.uint64(FULL)).astype(np.int64), first)


def _dealt(held: Sequence[np.ndarray], cells: int) -> Iterator[pa.RecordBatch]:
    """The phrases' hashes as entries: one row for each cell that has some, cells being even ranges of hashes."""
    occurrences = np.concatenate(held)
    if not len(occurrences):
        return
    occurrences <<= _COUNT_BITS
    occurrences |= np.uint64(1)
    entries = _entries(*_added_up(occurrences))
    cell = ((entries >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), cell[1:] != cell[:-1]]))
    ends = pa.py_buffer((np.append(first, len(entries)) * entries.itemsize).astype(np.int32))
    packed = pa.Array.from_buffers(pa.binary(), len(first), [None, ends, pa.py_buffer(entries)])
    yield pa.RecordBatch.from_arrays([pa.array(cell[first].astype(np.int32)), packed], schema=_ENTRIES_ARROW)


def _met(parts: Iterator[np.ndarray], least: int) -> Iterator[pa.RecordBatch]:
    """The hashes counted ``least`` times or more in all parts. Parts are added up as they come."""
    held: list[np.ndarray] = []
    most = HELD_PHRASES
    for part in parts:
        held.append(part)
        if sum(map(len, held)) >= most:
            held = [_entries(*_added_up(np.concatenate(held)))]
            most = max(HELD_PHRASES, 2 * len(held[0]))
    if held:
        hashes, counts = _added_up(np.concatenate(held))
        enough = counts >= least
        yield pa.RecordBatch.from_arrays([pa.array(hashes[enough].astype(np.int64)), pa.array(counts[enough])], schema=_HASH_ARROW)


def _frequent_hashes(blocks: DataFrame, length: int, shared: list, least: int, occurrences: int) -> DataFrame:
    """hash and n, ``least`` or more: how often a phrase of that length was met, where its shorter parts are known.

    About as many ``occurrences`` are to be met in all, so the cells are as many as keep each of them small.
    """
    cells = max(shuffle_partitions(blocks.sparkSession), -(-occurrences // HELD_PHRASES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(_Block(batch, i, shared).counted(length))
                if sum(map(len, held)) >= HELD_PHRASES:
                    yield from _dealt(held, cells)
                    held = []
        if held:
            yield from _dealt(held, cells)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in b.column("entries")]) for b in batches if b.num_rows)
        yield from _met(rows, least)

    entries = blocks.select("lang", "words", "numbers", "starts").mapInArrow(work, "cell int, entries binary")
    return entries.repartitionById(cells, "cell").select("entries").mapInArrow(meet, "hash long, n long")


def _bitmap(frequent: DataFrame, filter_bits: int) -> tuple[np.ndarray, int]:
    """A bit for each hash: as words of 64 bits, at most filter_bits / 64 of them. Also the sum of n."""
    bits = frequent.select(F.pmod("hash", F.lit(filter_bits)).alias("bit"), "n")
    packed = bits.select(F.expr("bit div 64").alias("at"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("mask"), "n")
    words = packed.groupBy("at").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n")).toPandas()
    out = np.zeros(filter_bits // 64, np.uint64)
    out[words["at"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return out, int(words["n"].sum())


def _merged(parts: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """The elements, equal ones in one, as far as HELD_ELEMENTS at once tell."""

    def one() -> pa.Table:
        table = pa.concat_tables(held)
        keys = [c for c in table.column_names if c != "n"]
        sums = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return sums.select([*keys, "n_sum"]).rename_columns([*keys, "n"])

    held: list[pa.Table] = []
    some = max(1, HELD_ELEMENTS // 4)
    for part in parts:
        for i in range(0, len(part), some):
            held.append(part.slice(i, some))
            if sum(map(len, held)) >= HELD_ELEMENTS:
                held = [one()]
                if len(held[0]) >= HELD_ELEMENTS // 2:
                    yield held.pop()
    if held:
        yield one()


def _sheets(elements: pa.Table) -> pa.RecordBatch:
    """One row per cell and language."""
    elements = elements.sort_by([("lang", "ascending"), ("cell", "ascending")]).combine_chunks()
    column = lambda name: elements[name].combine_chunks()
    langs, cells = column("lang"), column("cell")
    first = np.flatnonzero((np.diff(cells.to_numpy(), prepend=-1) != 0) | (np.diff(langs.dictionary_encode().indices.to_numpy(), prepend=-1) != 0))
    ends = pa.array(np.append(first, len(cells)).astype(np.int32))
    lines = pc.binary_join_element_wise(column("prefix"), column("word"), " ")
    phrases = pc.binary_join(pa.ListArray.from_arrays(ends, lines), "\n")
    counts = pa.ListArray.from_arrays(ends, column("n"))
    return pa.RecordBatch.from_arrays([cells.take(pa.array(first)), langs.take(pa.array(first)), phrases, counts], schema=_SHEET_ARROW)


def _elements(sheets: pa.RecordBatch) -> pa.Table:
    lines = pc.split_pattern(sheets.column("phrases"), "\n")
    langs = sheets.column("lang").take(pc.list_parent_indices(lines))
    parts = pc.split_pattern(lines.flatten(), " ", max_splits=1, reverse=True)
    return pa.Table.from_arrays([langs, pc.list_element(parts, 0), pc.list_element(parts, 1), sheets.column("counts").flatten()], schema=_ELEMENT_ARROW)


def merged_stripes(blocks: DataFrame, longest: int, shared: list) -> DataFrame:
    """Elements (lang, prefix, word, f) of all stripes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for b in batches for i in range(b.num_rows) for part in _Block(b, i, shared).stripes(longest))
        for elements in _merged(parts):
            sheets = _sheets(elements)
            some = max(1, sheets.num_rows * HANDED_ELEMENTS // len(elements))
            yield from (sheets.slice(i, some) for i in range(0, sheets.num_rows, some))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for elements in _merged(map(_elements, batches)):
            yield from elements.combine_chunks().to_batches(HANDED_ELEMENTS)

    sheets = blocks.select("lang", "words", "numbers", "starts").mapInArrow(count, _SHEET)
    elements = sheets.repartition("cell").mapInArrow(merge, "lang string, prefix string, word string, n long")
    return elements.groupBy("lang", "prefix", "word").agg(F.sum("n").alias("f"))


def _phrase() -> Column:
    return F.when(F.col("prefix") == "", F.col("word")).otherwise(F.concat("prefix", F.lit(" "), "word"))


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
    filter_bits: int = FILTER_BITS, block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Elements (lang, prefix, word, f) of all phrases of up to ``longest`` words found ``least`` times or more, and (lang, n), the words read."""
    if longest < 2 or filter_bits < 64 or filter_bits & (filter_bits - 1):
        raise ValueError("longest must be at least 2, filter_bits a power of two from 64 on")
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNDETERMINED)).alias("lang"), empty_if_null(text).alias("text"))
    # The passes read one block at once: a few MB in all, on either side of the pipe.
    blocks = bounded_batches(text_blocks(rows, longest - 1, block_bytes), block_bytes)
    totals = materialize(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    words = totals.agg(F.sum("n")).first()[0] or 0
    known, occurrences = [], words
    for length in range(1, longest + 1):
        bitmap, found = _bitmap(_frequent_hashes(blocks, length, list(known), least, occurrences), filter_bits)
        known.append(context.broadcast(bitmap))  # filter_bits / 8 bytes
        if length > 1:
            # A longer phrase starts with one of these, or with one whose bit is set by chance.
            occurrences = min(words, found + int(words * np.bitwise_count(bitmap).sum() / filter_bits))
    elements = merged_stripes(blocks, longest, known).where(F.col("f") >= least)
    return elements, totals


def _looked_up(rows: DataFrame, key: str, known: DataFrame, into: str) -> DataFrame:
    """``rows`` with the count ``f`` of the phrase in ``key``; rows that ask for one phrase are dealt to salted cells."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    cells = salted.select("lang", key, "_salt").distinct()
    found = cells.join(known.select("lang", F.col("phrase").alias(key), F.col("f").alias(into)), ["lang", key])
    return salted.join(found, ["lang", key, "_salt"]).drop("_salt")


def cut_score() -> Column:
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    exact = lambda c: f"cast({c} as decimal(19, 0))"
    return F.expr(f"(cast(1000 as decimal(4, 0)) * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, **sizes: int) -> DataFrame:
    """Phrases that no longer phrase takes all occurrences of: lang, phrase, a, l, r, n and score of the weakest cut."""
    elements, totals = frequent_phrases(docs, text, lang, longest, least, **sizes)
    known = elements.select("lang", "prefix", "word", _phrase().alias("phrase"), "f")
    known = materialize(known.withColumn("words", F.split("phrase", " ")), "frequent")
    phrases = known.where(F.col("prefix") != "")
    # An extension by one word tells enough: what lies between a phrase and a longer one with its count has that count too.
    wider = phrases.where(F.size("words") > 2).select(
        "lang", "f", F.explode(F.array("prefix", F.array_join(F.expr("slice(words, 2, size(words) - 1)"), " "))).alias("phrase"))
    taken = wider.groupBy("lang", "phrase").agg(F.max("f").alias("_widest"))
    kept = phrases.join(taken, ["lang", "phrase"], "left").where(F.col("_widest").isNull() | (F.col("_widest") < F.col("f")))
    cuts = kept.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("_first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("_rest"))
    cuts = _looked_up(_looked_up(cuts, "_first", known, "l"), "_rest", known, "r").join(totals, "lang")
    weakest = cuts.withColumn("score", cut_score()).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    return weakest.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")


def leading(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase, with their rank."""
    place = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leading(collocations(table(spark, sf_dir, "documents")))


#: The same in SQL.
OP13_SQL = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, '{UNDETERMINED}') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces WHERE len(ws) > 0),
f AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM places, range(1, {LONGEST + 1}) r(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE f >= {LEAST}),
candidates AS (
  SELECT p.* FROM frequent p WHERE p.m > 1 AND NOT EXISTS (
    SELECT 1 FROM frequent q WHERE q.lang = p.lang AND q.m > p.m AND 100 * q.f >= 100 * p.f AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(words[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest QUALIFY rank <= {TOP}
"""
