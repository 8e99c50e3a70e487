"""SimHash fingerprints of whole texts and a search for all fingerprints within a Hamming radius.

A text's terms are its pairs of neighbouring words (the word itself if there is only one). Each
term's hash votes, weighted by 1 + ln(occurrences), on the bits of a 128-bit fingerprint. The share
of equal bits of two fingerprints estimates the angle between the weighted term vectors; likeness is
its cosine, at least 0.

The search cuts a fingerprint into blocks. Of two fingerprints within the radius some block differs
in at most radius // blocks bits. There is a table for each block, whose cells are the values of
the block's leading bits, more of them the more rows there are; a query visits its own cell and all
cells so few bits away, and is compared with their rows. A pair counts in the first table that
brings it together, so nothing has to be made distinct. Equal fingerprints are one row with a count,
and only counts leave a cell, never its pairs.

Defined cases: a missing text is the empty text; a text without words has the fingerprint of zero
bits, like any text whose votes are all even; very long texts are read whole; repeated rows and
ties in doc_id are ordered by their text, a missing doc_id comes last; a single document is its own
next document; an empty table gives an empty result; other columns of the input are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, table
from tallyframe.session import materialize, shuffle_partitions

BITS = 128
#: Texts whose five-word shingles have a Jaccard similarity of 0.8 through scattered changed words share about 0.956 of
#: their word pairs. Their fingerprints differ in 12.2 bits on average, with a deviation of 3.3; 20 holds 99 of 100.
RADIUS = 20
#: Blocks of 18 bits; within the radius one of them differs in at most RADIUS // BLOCKS = 2 bits.
BLOCKS = 7
#: Rows of a cell on average.
CELL_ROWS = 64
#: Documents per range of keys, and ranges at most.
RANGE_ROWS = 200
MOST_RANGES = 50_000
#: Rows of one cell that are compared in one piece.
BUCKET_ROWS = 4096
ROWS_AT_ONCE = 256
KNOWN_WORDS = 300_000
TERMS_AT_ONCE = 1 << 14

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- fingerprints -----------------------------------------------------------------------------------


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < KNOWN_WORDS:
            self[word] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mark_of(hashes: np.ndarray) -> np.ndarray:
    """16 bytes, from the hashes of a text's words."""
    if not len(hashes):
        return np.zeros(BITS // 8, np.uint8)
    with np.errstate(over="ignore"):
        terms = hashes if len(hashes) == 1 else hashes[:-1] * _M1 + mixed(hashes[1:])
        terms, times = np.unique(terms, return_counts=True)
        # Whole weights, in sums that float32 holds exactly: votes do not depend on their order.
        weights = np.rint(64 * (1 + np.log(times))).astype(np.float32)
        votes = np.zeros(BITS)
        for at in range(0, len(terms), TERMS_AT_ONCE):
            part, weight = terms[at : at + TERMS_AT_ONCE], weights[at : at + TERMS_AT_ONCE]
            both = np.stack([mixed(part), mixed(part + _M1)], 1)
            bits = np.unpackbits(both.view(np.uint8), axis=1).astype(np.float32)
            votes += 2.0 * (weight @ bits) - float(weight.sum())
    return np.packbits(votes > 0)


def fingerprint(text: str, known: WordHashes) -> np.ndarray:
    return mark_of(word_hashes(text.lower().split(), known))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    distance = int(np.unpackbits(one ^ other).sum())
    return float(max(0.0, np.cos(np.pi * distance / BITS)))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edited_hashes(text: str, own: np.ndarray, following: str, next_own: np.ndarray, known: WordHashes) -> np.ndarray:
    """Word hashes of the edited text; only the words at its seam and its end have to be hashed."""
    third = len(text) // 3
    head, tail = text[: len(text) - third], following[:third]
    before, after = head.split(), tail.split()
    glued = bool(before and after) and not head[-1].isspace() and not tail[0].isspace()
    seam = before[-1:]
    if glued:
        seam, after = [before[-1] + after[0]], after[1:]
    middle = next_own[glued : glued + max(0, len(after) - 1)]
    return np.concatenate([
        own[: max(0, len(before) - 1)], word_hashes([w.lower() for w in seam], known), middle, word_hashes([w.lower() for w in after[-1:]], known),
    ])


def _fingerprint_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by range, in order; each range ends with the first row of the next one."""
    known, unzip = WordHashes(), zstandard.ZstdDecompressor()
    held = None
    for batch in batches:
        rows = []
        for place, helps, key, body in zip(batch["_range"], batch["_helps"], batch["doc_id"], batch["_body"], strict=True):
            if held is None and helps:
                continue  # a further row with the same key as the first of the next range
            text = unzip.decompress(body).decode("utf-8")
            own = word_hashes(text.lower().split(), known)
            mark = mark_of(own)
            if held is not None:
                if held[0] != place:
                    raise ValueError(f"range {held[0]} does not end with a following row")
                _, before, earlier, earlier_own, earlier_mark = held
                changed = hashlib.sha256(edited(earlier, text).encode("utf-8")).hexdigest()
                changed_mark = mark_of(edited_hashes(earlier, earlier_own, text, own, known))
                rows.append((
                    before, len(earlier), changed, earlier_mark.tobytes().hex(), changed_mark.tobytes().hex(),
                    likeness(earlier_mark, changed_mark), likeness(earlier_mark, mark),
                ))
            held = None if helps else (place, None if pd.isna(key) else int(key), text, own, mark)
        yield pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).astype({"doc_id": "Int64"})


def with_following(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Texts dealt out by ranges of descending keys; the first row of a range also closes the range before it."""
    rows = bounded_batches(docs).select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    order = F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("_order")
    keys = rows.select(order)
    count = keys.count()
    ranges = max(1, min(MOST_RANGES, count // RANGE_ROWS))
    cuts = np.unique(keys.select(F.col("_order").cast("double").alias("o")).approxQuantile("o", [i / ranges for i in range(1, ranges)], 0.2 / ranges)) if ranges > 1 else np.zeros(0)
    shared_cuts = docs.sparkSession.sparkContext.broadcast(cuts)  # at most MOST_RANGES numbers

    @F.pandas_udf("int")
    def range_of(order: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared_cuts.value, order.to_numpy(np.int64).astype(np.float64), "right"), dtype="int32")

    heads = keys.withColumn("_range", range_of("_order")).groupBy("_range").agg(F.max("_order").alias("head")).orderBy("_range").collect()
    above = [heads[(i + 1) % len(heads)]["_range"] for i in range(len(heads))]
    shared_heads = docs.sparkSession.sparkContext.broadcast({r["head"]: up for r, up in zip(heads, above, strict=True)})

    @F.pandas_udf("places array<struct<_range:int,_helps:boolean>>, _body binary")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        zipped, helped = zstandard.ZstdCompressor(level=1), shared_heads.value
        for order, texts in batches:
            number = order.to_numpy(np.int64)
            places = [
                [(int(r), False)] + ([(helped[int(o)], True)] if int(o) in helped else [])
                for r, o in zip(np.searchsorted(shared_cuts.value, number.astype(np.float64), "right"), number, strict=True)
            ]
            yield pd.DataFrame({"places": places, "_body": [zipped.compress(t.encode("utf-8")) for t in texts]})

    dealt = rows.select("doc_id", order, placed(order, "_text").alias("_p")).select("doc_id", "_order", "_p._body", F.explode("_p.places").alias("_at"))
    dealt = dealt.select("_at._range", "_at._helps", "_order", "doc_id", "_body")
    return dealt.repartition(shuffle_partitions(docs.sparkSession), "_range").sortWithinPartitions("_range", "_helps", F.desc("_order"), "_body")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_following(docs, key, text).mapInPandas(_fingerprint_rows, schema)


# --- search -----------------------------------------------------------------------------------------


def cell_masks(blocks: int, cell_bits: int) -> np.ndarray:
    """For each table the bits that name its cells, the leading ones of its block, as two 64-bit halves."""
    out = []
    for block in range(blocks):
        bits, start = np.zeros(BITS, np.uint8), round(block * BITS / blocks)
        bits[start : start + cell_bits] = 1
        out.append(np.packbits(bits).view(">u8").astype(np.uint64))
    return np.array(out)


def near_cells(cell_bits: int, flips: int) -> np.ndarray:
    """What a cell is combined with to get all cells at most ``flips`` bits away."""
    return np.array([sum(1 << b for b in chosen) for n in range(min(flips, cell_bits) + 1) for chosen in combinations(range(cell_bits), n)], np.int64)


def _cells(blocks: int, cell_bits: int, near: np.ndarray | None):
    """The cell of every row in every table; with ``near`` also the cells around it."""
    powers = 1 << np.arange(cell_bits, dtype=np.int64)[::-1]
    around = np.zeros(1, np.int64) if near is None else near

    def cells(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                rows = batch.iloc[at : at + ROWS_AT_ONCE]
                marks = np.frombuffer(bytes.fromhex("".join(rows["fingerprint"])), np.uint8).reshape(len(rows), -1)
                halves, bits = marks.view(">u8").astype(np.uint64).view(np.int64), np.unpackbits(marks, axis=1)
                for block in range(blocks):
                    start = round(block * BITS / blocks)
                    own = bits[:, start : start + cell_bits] @ powers
                    yield pd.DataFrame({
                        "table": np.int32(block), "cell": (own[:, None] ^ around[None, :]).ravel(),
                        "hi": np.repeat(halves[:, 0], len(around)), "lo": np.repeat(halves[:, 1], len(around)),
                        "copies": np.repeat(rows["copies"].to_numpy(), len(around)),
                    })

    return cells


def _count_near(masks: np.ndarray, radius: int, flips: int):
    """Rows come by cell piece, queries first. Counts, per query, the copies of the rows near it."""

    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        q, r = (x[["hi", "lo"]].to_numpy(np.int64).view(np.uint64) for x in (queries, rows))
        copies, own = rows["copies"].to_numpy(), int(queries["table"].iloc[0])
        totals = np.zeros(len(q), np.int64)
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            distance = np.bitwise_count(part[:, None, 0] ^ r[None, :, 0]) + np.bitwise_count(part[:, None, 1] ^ r[None, :, 1])
            i, j = np.nonzero((distance <= radius) & (distance > 0))
            if not len(i):
                continue
            differ, first = part[i] ^ r[j], np.ones(len(i), bool)
            for earlier in masks[:own]:
                first &= np.bitwise_count(differ & earlier).sum(1) > flips
            np.add.at(totals, at + i[first], copies[j[first]])
        hit = totals > 0
        return pd.DataFrame({"hi": queries["hi"].to_numpy()[hit], "lo": queries["lo"].to_numpy()[hit], "found": totals[hit]})

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, queries = None, None
        for batch in batches:
            bucket = batch[["table", "cell", "piece"]].to_numpy(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]).any(1)]))
            ends = np.append(starts[1:], len(batch))
            asked = np.concatenate([[0], np.cumsum(batch["kind"].to_numpy() == 0)])
            last = len(starts) - 1
            for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
                goes_on = name is not None and tuple(bucket[a]) == name
                n = int(asked[b] - asked[a])
                if not goes_on:
                    queries = None
                if n and (b - a > n or i == last or goes_on):
                    new = batch.iloc[a : a + n]
                    queries = new if queries is None else pd.concat([queries, new])
                elif n:
                    continue
                if queries is not None and b - a > n:
                    yield compare(queries, batch.iloc[a + n : b])
            name = tuple(bucket[starts[-1]]) if len(starts) else name

    return count


def near_counts(marks: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket_rows: int = BUCKET_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Of each asked fingerprint the number of rows whose other fingerprint is within the radius.

    ``marks`` has fingerprint, copies and asked, one row per different fingerprint. Cells of more
    than ``bucket_rows`` rows are cut into pieces, and their queries go to every piece.
    """
    cell_bits = max(0, min(BITS // blocks, int(np.log2(max(1, marks.count() / cell_rows)))))
    flips = radius // blocks
    kind = "table int, cell long, hi long, lo long, copies long"
    given = marks.mapInPandas(_cells(blocks, cell_bits, None), kind)
    asked = marks.where("asked").mapInPandas(_cells(blocks, cell_bits, near_cells(cell_bits, flips)), kind)
    sizes = given.groupBy("table", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
    large = materialize(sizes.select("table", "cell", F.ceil(F.col("n") / bucket_rows).cast("int").alias("pieces")), "large-cells")
    pieces = F.coalesce(F.col("pieces"), F.lit(1))
    columns = ["table", "cell", "piece", "kind", "hi", "lo", "copies"]
    if large.isEmpty():
        given, asked = given.withColumn("piece", F.lit(0)), asked.withColumn("piece", F.lit(0))
    else:
        given = given.join(large, ["table", "cell"], "left").withColumn("piece", F.pmod(F.xxhash64("hi", "lo"), pieces).cast("int"))
        asked = asked.join(large, ["table", "cell"], "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    met = given.withColumn("kind", F.lit(1)).select(columns).unionByName(asked.withColumn("kind", F.lit(0)).select(columns))
    dealt = met.repartition(shuffle_partitions(marks.sparkSession), "table", "cell", "piece")
    count = _count_near(cell_masks(blocks, cell_bits), radius, flips)
    found = dealt.sortWithinPartitions("table", "cell", "piece", "kind").mapInPandas(count, "hi long, lo long, found long")
    hexed = F.lower(F.concat(F.lpad(F.hex("hi"), 16, "0"), F.lpad(F.hex("lo"), 16, "0")))
    return found.groupBy(hexed.alias("fingerprint")).agg(F.sum("found").alias("found"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the fingerprints, ``within_radius``: of every twentieth document, how many others have a fingerprint within the radius."""
    marks = materialize(fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    query = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    different = marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"), F.max(query).alias("asked"))
    different = materialize(different, "fingerprint-copies")
    found = different.where("asked").join(near_counts(different), "fingerprint", "left")
    found = found.select("fingerprint", (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("_found"))
    return with_counts(marks, found, query)


def with_counts(marks: DataFrame, found: DataFrame, query: Column) -> DataFrame:
    """Only query rows are joined, so many copies that are not asked for stay where they are."""
    asked = marks.where(query).join(found, "fingerprint").select(*marks.columns, F.col("_found").alias("within_radius"))
    return marks.where(~query).withColumn("within_radius", F.lit(None).cast("long")).unionByName(asked)
