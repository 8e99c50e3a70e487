"""Best-fit packing of tokenized documents into sequences of bounded length, by bin completion.

Only the lengths of the pieces matter for packing, and there are at most ``capacity`` different
lengths however large the corpus is. So tasks tokenize and count pieces by length, a search over
those counts decides which lengths fill a sequence together and how often, and every piece then
looks its place up by its length and its rank among the pieces of that length.

The search is bin completion: the longest remaining length opens a sequence, the undominated
fillings of the rest are enumerated, and branches whose waste exceeds what a better solution may
waste are cut. The incumbent starts as the best-fit solution. Small problems are searched whole. A
large incumbent is improved by reopening: some of its most wasteful sequences and a few others, with
a sequence's worth of waste together, are searched for one sequence less, and what is found replaces
them as often as they occur together. A filling is used as often as counts allow, so the work depends
on the number of lengths and not on the number of documents. It ends at a lower bound of any packing.

Defined cases: a missing or empty text has no tokens of its own, so it is a piece of length 1 (the
end token); texts longer than a sequence are cut into full pieces and a last, shorter one; repeated
rows are pieces each; an empty table gives an empty result; other columns of the input are ignored,
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, table
from tallyframe.session import materialize

CAPACITY = 4096
END_TOKEN = 1
TOKENIZER = "word_bpe_49k.json"
#: Words whose tokens a worker remembers.
KNOWN_WORDS = 700_000
#: Documents tokenized together.
BATCH = 512
#: Bounds of the search, none of which grows with the documents: fillings enumerated and kept per opened sequence (and
#: nodes looked at for each), kept fillings that others are compared with, sequences searched whole, fillings tried in a
#: search, reopenings for each different length, and sequences drawn beside the wasteful ones.
FILLINGS = 16
LOOKED_PER_FILLING = 40
DOMINATORS = 8
SEARCHED_WHOLE = 40
TRIES, TRIES_WHOLE = 150, 3_000
REOPENED_PER_LENGTH = 1
MOST_WASTEFUL, DRAWN_BESIDE = 200, 4

# Runs of letters that lower-casing and composing leave as they are; the tokenizer cuts between
# such a run and one of the marks listed, and never inside either.
LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
LAST_MARK = re.compile(r"(?<=[a-zß-öø-ÿ])[!,.:;?](?!\S)")
# Python takes these for white space and the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
BLANKS = re.compile("[ \t\n\r]+")
JOINED_WORDS = 2000


# --- tokens -----------------------------------------------------------------------------------------


class _Words(dict):
    """Numbers words as they are met, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordTokens:
    """The ids of words, remembered up to a bound. The tokenizer never joins tokens across white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids = _Words(), np.zeros(0, "<u4")
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Tokenize the new words: plain ones many at once, since their tokens can be told apart again."""
        new, self.words.new = self.words.new, []
        plain, other = [], []
        for i, w in enumerate(new):
            (plain if LETTERS.fullmatch(w) else other).append(i)
        lengths, ids = np.zeros(len(new), np.int64), []
        for at in range(0, len(plain), JOINED_WORDS):
            part = plain[at : at + JOINED_WORDS]
            together = self.tokenizer.encode(" ".join([new[i] for i in part]), add_special_tokens=False)
            lengths[part] = np.bincount(np.array(together.word_ids), minlength=len(part))
            ids.append(np.array(together.ids, "<u4"))
        found = self.tokenizer.encode_batch([new[i] for i in other], add_special_tokens=False)
        lengths[other] = [len(e.ids) for e in found]
        ids += [np.array(e.ids, "<u4") for e in found]
        stored = np.array(plain + other, np.int64)
        starts = np.zeros(len(new), np.int64)
        starts[stored] = len(self.ids) + np.cumsum(lengths[stored]) - lengths[stored]
        self.ids = np.concatenate([self.ids, *ids])
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])

    def documents(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, little-endian; words not met before are tokenized together."""
        if len(self.words) > KNOWN_WORDS:
            self._forget()
        number = self.words.__getitem__
        split = [np.fromiter(map(number, words), np.int64) for words in map(words_of, texts)]
        if self.words.new:
            self._learn()
        out = []
        for words in split:
            lengths = self.lengths[words]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.ids[np.arange(total) + np.repeat(self.starts[words] - (ends - lengths), lengths)].tobytes())
        return out


def words_of(text: str) -> list[str]:
    """What white space separates, and marks at the end of a word by themselves; in lower case if that is sure to be
    what the tokenizer makes of it."""
    try:
        text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    if SEPARATORS.search(text):
        return [w for w in BLANKS.split(text) if w]
    return LAST_MARK.sub(r" \g<0>", text).split()


_known: dict[str, WordTokens] = {}


def _pieces(batches: Iterable[pd.DataFrame], path: str, capacity: int) -> Iterator[pd.DataFrame]:
    """Pieces with their task and their number among the task's pieces of that length."""
    tokens = _known.get(path) or _known.setdefault(path, WordTokens(path))
    task = TaskContext.get().partitionId()
    met = np.zeros(capacity + 1, np.int64)
    end, step = np.array([END_TOKEN], "<u4").tobytes(), 4 * capacity
    for batch in batches:
        for at in range(0, len(batch), BATCH):
            part = batch.iloc[at : at + BATCH]
            rows = []
            for key, ids in zip(part["doc_id"], tokens.documents([t or "" for t in part["text"]]), strict=True):
                ids += end
                for piece, start in enumerate(range(0, len(ids), step)):
                    own = ids[start : start + step]
                    length = len(own) // 4
                    rows.append((key, piece, start // 4, length, zlib.crc32(own), task, int(met[length])))
                    met[length] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "_task", "_met"])


def tokenized_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _task int, _met long"
    rows = bounded_batches(docs).select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(lambda batches: _pieces(batches, tokenizer, capacity), schema)


# --- bin completion ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Filling:
    """Lengths of one sequence, longest first, as (length, how many), and how many sequences are so filled."""

    parts: tuple[tuple[int, int], ...]
    times: int


class Lengths:
    """Remaining counts by length, with the present lengths in order."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.below = np.zeros(len(counts), np.int64)
        last = 0
        for length in range(1, len(counts)):
            if counts[length]:
                last = length
            self.below[length] = last

    def longest(self, most: int) -> int:
        """The longest present length of at most ``most``; 0 if none."""
        at = int(self.below[min(most, len(self.below) - 1)])
        chain = []
        while at and not self.counts[at]:
            chain.append(at)
            at = int(self.below[at - 1])
        for c in chain:
            self.below[c] = at
        return at


def best_fit(lengths: Lengths, first: int, capacity: int) -> tuple[tuple[int, int], ...]:
    """Around ``first``, always the longest length that still fits."""
    parts, rest, at = [(first, 1)], capacity - first, min(first, capacity - first)
    while rest and (at := lengths.longest(min(rest, at))):
        free = int(lengths.counts[at]) - (at == first)
        take = min(free, rest // at)
        if take:
            parts.append((at, take))
            rest -= take * at
        at -= 1
        if not at:
            break
    return merged(parts)


def merged(parts: list[tuple[int, int]]) -> tuple[tuple[int, int], ...]:
    total: dict[int, int] = {}
    for length, n in parts:
        total[length] = total.get(length, 0) + n
    return tuple(sorted(total.items(), reverse=True))


def completions(lengths: Lengths, first: int, capacity: int, limit: int = FILLINGS) -> list[tuple[tuple[int, int], ...]]:
    """Undominated fillings around ``first``, least waste first.

    A filling is dominated if one of its parts could be exchanged for a longer one that still
    fits, or a part added; then the other filling leaves only easier lengths over. Of fillings met
    in order of their longest parts at most ``limit`` are kept, and the search stops at a full one.
    """
    rest, found, looked = capacity - first, {}, 0

    def descend(rest: int, at: int, parts: list[tuple[int, int]]) -> bool:
        nonlocal looked
        looked += 1
        length = lengths.longest(min(rest, at)) if rest and at else 0
        if not length or rest == 0:
            filling = merged([(first, 1), *parts])
            found.setdefault(filling, rest)
            return rest == 0 or len(found) >= limit or looked > LOOKED_PER_FILLING * limit
        free = int(lengths.counts[length]) - (length == first)
        for take in range(min(free, rest // length), -1, -1):
            if take == 0 and free and not lengths.longest(min(rest, length - 1)):
                break  # leaving a fitting length out, with nothing else to add, is dominated
            if descend(rest - take * length, length - 1, [*parts, (length, take)] if take else parts):
                return True
            if looked > LOOKED_PER_FILLING * limit:
                return True
        return False

    descend(rest, min(first, rest), [])
    ordered = sorted(found.items(), key=lambda x: (x[1], [-n for part in x[0] for n in part]))
    kept: list[tuple[tuple[int, int], ...]] = []
    for filling, _ in ordered:
        if not any(dominates(other, filling) for other in kept[:DOMINATORS]):
            kept.append(filling)
    return kept


def dominates(strong: tuple[tuple[int, int], ...], weak: tuple[tuple[int, int], ...]) -> bool:
    """True if each part of ``weak`` fits below a part of its own in ``strong``, longest against longest."""
    a = [length for length, n in strong for _ in range(n)]
    b = [length for length, n in weak for _ in range(n)]
    return len(a) >= len(b) and all(x >= y for x, y in zip(a, b, strict=False))


def times_possible(counts: np.ndarray, filling: tuple[tuple[int, int], ...]) -> int:
    return min(int(counts[length]) // n for length, n in filling)


def waste_of(filling: tuple[tuple[int, int], ...], capacity: int) -> int:
    return capacity - sum(length * n for length, n in filling)


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer: pieces above half a sequence need one each, and shorter ones the room that those leave."""
    lengths = np.arange(len(counts))
    pieces, tokens = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    count = lambda lo, hi: pieces[hi + 1] - pieces[lo]
    total = lambda lo, hi: tokens[hi + 1] - tokens[lo]
    half, best = capacity // 2, -(-int(tokens[-1]) // capacity)
    for short in range(half + 1):
        # Beside a piece longer than capacity - short nothing of at least ``short`` fits.
        alone, beside = count(capacity - short + 1, capacity), count(half + 1, capacity - short)
        room = beside * capacity - total(half + 1, capacity - short)
        more = total(short, half) - room
        best = max(best, int(alone + beside + max(0, -(-int(more) // capacity))))
    return best


def packed_into(pieces: dict[int, int], capacity: int, sequences: int, tries: int) -> list[tuple[tuple[int, int], ...]] | None:
    """A packing of pieces (length to number) into at most so many sequences, found depth-first, or None."""
    counts = np.zeros(capacity + 1, np.int64)
    counts[list(pieces)] = list(pieces.values())
    spare = sequences * capacity - sum(length * n for length, n in pieces.items())
    left, path = Lengths(counts), []
    stack: list[Iterator[tuple[tuple[int, int], ...]]] = []

    def open_level() -> None:
        first = left.longest(capacity)
        stack.append(iter(completions(left, first, capacity) if first else ()))

    if spare < 0:
        return None
    open_level()
    while stack:
        filling = next(stack[-1], None)
        if filling is None:
            stack.pop()
            if path:
                last = path.pop()
                for length, n in last:
                    counts[length] += n
                spare, left = spare + waste_of(last, capacity), Lengths(counts)
            continue
        tries -= 1
        if tries < 0:
            return None
        # What is wasted stays so: a branch that wastes more than there is to spare cannot end in time.
        if waste_of(filling, capacity) > spare:
            continue
        for length, n in filling:
            counts[length] -= n
        spare -= waste_of(filling, capacity)
        path.append(filling)
        if not left.longest(capacity):
            return path
        open_level()
    return None


def pieces_of(pool: dict[tuple[tuple[int, int], ...], int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for filling, copies in pool.items():
        for length, n in filling:
            out[length] = out.get(length, 0) + n * copies
    return out


def reopened(times: dict[tuple[tuple[int, int], ...], int], capacity: int, least: int, rounds: int) -> dict[tuple[tuple[int, int], ...], int]:
    """The packing (filling to how often) with fewer sequences, where reopening some of them finds one less."""
    times, draw = dict(times), np.random.default_rng(3)
    if (size := sum(times.values())) <= SEARCHED_WHOLE:
        while size > least and (found := packed_into(pieces_of(times), capacity, size - 1, TRIES_WHOLE)):
            times = {f: found.count(f) for f in found}
            size = len(found)
        return times
    for _ in range(rounds):
        if size <= least:
            break
        wasteful = sorted((f for f in times if waste_of(f, capacity)), key=lambda f: (-waste_of(f, capacity), f))[:MOST_WASTEFUL]
        pool: dict[tuple[tuple[int, int], ...], int] = {}
        wasted = 0
        for i in draw.permutation(len(wasteful)).tolist():
            pool[wasteful[i]] = 1
            wasted += waste_of(wasteful[i], capacity)
            if wasted >= 1.05 * capacity or len(pool) == SEARCHED_WHOLE:
                break
        if wasted < capacity:
            continue
        every = list(times)
        for i in draw.integers(0, len(every), DRAWN_BESIDE).tolist():
            pool[every[i]] = 1
        found = packed_into(pieces_of(pool), capacity, len(pool) - 1, TRIES)
        if found is None:
            continue
        together = min(times[f] for f in pool)
        for f in pool:
            times[f] -= together
            if not times[f]:
                del times[f]
        for f in found:
            times[f] = times.get(f, 0) + together
        size -= together * (len(pool) - len(found))
    return times


def pack_lengths(counts: np.ndarray, capacity: int = CAPACITY, rounds: int | None = None) -> list[Filling]:
    """As few sequences as the search finds for ``counts[length]`` pieces of each length.

    ``rounds`` reopenings are tried at most, by default in proportion to the different lengths.
    """
    least = least_sequences(counts, capacity)

    def greedy(choose: Callable[[Lengths, int], tuple[tuple[int, int], ...]]) -> dict[tuple[tuple[int, int], ...], int]:
        left, out = Lengths(counts.copy()), {}
        while first := left.longest(capacity):
            filling = choose(left, first)
            times = times_possible(left.counts, filling)
            for length, n in filling:
                left.counts[length] -= n * times
            out[filling] = out.get(filling, 0) + times
        return out

    size = lambda packing: sum(packing.values())
    incumbent = greedy(lambda left, first: best_fit(left, first, capacity))
    if size(incumbent) > least:
        incumbent = min(incumbent, greedy(lambda left, first: completions(left, first, capacity)[0]), key=size)
    if size(incumbent) > least:
        rounds = REOPENED_PER_LENGTH * int((counts > 0).sum()) if rounds is None else rounds
        incumbent = reopened(incumbent, capacity, least, rounds)
    return [Filling(filling, times) for filling, times in incumbent.items()]


# --- places -----------------------------------------------------------------------------------------


def slots(fillings: list[Filling]) -> pd.DataFrame:
    """For ranks of a length from ``rank`` on: the first sequence, pieces per sequence, the first offset."""
    rows, given, sequence = [], {}, 0
    for filling in fillings:
        offset = 0
        for length, n in filling.parts:
            rank = given.get(length, 0)
            rows.append((length, rank, sequence, n, offset))
            given[length] = rank + n * filling.times
            offset += n * length
        sequence += filling.times
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "each", "offset"]).sort_values(["length", "rank"])


#: Ranks of one length stay below this; length and rank make one sortable number.
RANKS = 1 << 48


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    pieces = materialize(tokenized_pieces(docs, tokenizer, capacity, key, text), "pieces")
    by_task = pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    plan = slots(pack_lengths(counts, capacity))
    # A row per filling and length: bounded by the lengths, not by the documents.
    shared = spark.sparkContext.broadcast((
        plan["length"].to_numpy(np.int64) * RANKS + plan["rank"].to_numpy(np.int64),
        plan["sequence"].to_numpy(np.int64), plan["each"].to_numpy(np.int64), plan["offset"].to_numpy(np.int64),
    ))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        starts, sequence, each, offset = shared.value
        wanted = length.to_numpy(np.int64) * RANKS + rank.to_numpy(np.int64)
        at = np.searchsorted(starts, wanted, "right") - 1
        past = wanted - starts[at]
        return pd.DataFrame({"sequence_id": sequence[at] + past // each[at], "offset": offset[at] + past % each[at] * length.to_numpy(np.int64)})

    before = W.partitionBy("length").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    first = by_task.select("length", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = pieces.join(first, ["length", "_task"]).withColumn("_place", place("length", F.col("_first") + F.col("_met")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.sequence_id", "_place.offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
