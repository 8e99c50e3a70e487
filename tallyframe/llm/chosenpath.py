"""Similarity join of documents on word n-grams by chosen paths.

Two documents are linked if their sets of five-word shingles have a Jaccard similarity of at least
the threshold. Documents with the same set are one record. Each record is reduced to a MinHash
sketch, whose coordinates are its tokens, and is put into buckets by the tokens that a random
function of the path chooses: about 1 / threshold tokens per level, so that two similar records
share one in expectation. Large buckets are split again by tokens chosen anew; small ones are
compared whole. All runs, as many as the recall target asks for, are made at once.

Bucket comparisons use sketches at a lower bar and only say which records may hang together. The
records that do are then compared by their true shingle sets, each against all others it may hang
together with, in tiles of bounded size. So links are exact, and a link that no bucket showed is
still found if its ends hang together at all.

A large bucket first compares all its records with a few pivots. A record very close to a pivot
needs no further splitting there: by the triangle inequality of Jaccard distance, whatever it is
linked to is near the pivot as well and hangs together with it. What is left of a bucket is split
again only if many records lie outside its largest family that hangs together by the pivots. If few
do, they are compared with all the others there, which finds whatever splitting could.

Defined cases: words are what white space separates, in lower case; a text of fewer than five words
is one shingle; a missing text, or one without words, is linked to nothing and a class of its own;
repeated rows and equal sets are linked copies; a class is named by its least doc_id, missing ones
last; rows that share a doc_id are records of their own; an empty table gives an empty result; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil, exp, log

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, table
from tallyframe.llm.components import components
from tallyframe.session import materialize, shuffle_partitions

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
DEPTH = 3
COORDINATES = 64
#: Records of a bucket that are compared whole.
SMALL_BUCKET = 128
PIVOTS = 4
#: Records of a bucket that pass its pivots in one task.
WHOLE_BUCKET = 1024
#: Sketch similarity from which two records may hang together: four standard errors below 0.8.
MAY_LINK = 0.59
#: Sketch similarity to a pivot from which a record leaves its bucket.
COVERED = 0.92
TILE_RECORDS = 512
#: Sketches a side of a tile has, of buckets whose paths have full length.
TILE_SKETCHES = 1024
#: Records outside a large bucket's main family that are compared with all of it, half a side of a tile.
FEW_OUTSIDE = 512
COLUMNS_AT_ONCE = 8192
KNOWN_WORDS = 300_000
SHINGLES_AT_ONCE = 4096

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_draw = np.random.default_rng(20)
_FACTORS = _draw.integers(1, 2**63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 2**63, COORDINATES, np.uint64)
_PLACES = (np.arange(COORDINATES, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x632BE59BD9B4E019)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


# --- shingles and sketches --------------------------------------------------------------------------


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < KNOWN_WORDS:
            self[word] = value
        return value


def shingles(text: str | None, known: WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted different hashes of the text's word n-grams."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    many = max(1, len(words) - width + 1)
    rolled = np.zeros(many, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(width, len(words))):
            rolled = mixed(rolled * _K1 + hashes[i : i + many])
    return np.unique(rolled)


def sketch(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 2**32 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), SHINGLES_AT_ONCE):
            values = (found[at : at + SHINGLES_AT_ONCE, None] * _FACTORS + _SHIFTS) >> np.uint64(32)
            np.minimum(least, values.min(0), out=least)
    return least.astype(np.uint32)


def chosen_paths(sketches: np.ndarray, paths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each sketch and its path the paths one level on, as (row, path)."""
    with np.errstate(over="ignore"):
        tokens = mixed(sketches.astype(np.uint64) + _PLACES)
        drawn = mixed(tokens * _K1 + mixed(paths)[:, None])
    row, place = np.nonzero(drawn < np.uint64(int(2**64 / (threshold * COORDINATES))))
    return row, mixed(drawn[row, place] ^ _K3)


def recall_of_run(depth: int) -> float:
    """The chance that two records at the threshold share a path of this length: one shared token per level in expectation."""
    lost = 0.0
    for _ in range(depth):
        lost = exp(lost - 1.0)
    return 1.0 - lost


def runs_needed(recall: float, depth: int) -> int:
    return max(1, ceil(log(1.0 - recall) / log(1.0 - recall_of_run(depth))))


def _sketched(threshold: float, runs: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    starts = mixed(np.arange(1, runs + 1, dtype=np.uint64) * _K2)

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, number = WordHashes(), TaskContext.get().partitionId() << 36
        for batch in batches:
            out = []
            for key, text, mark in zip(batch["doc_id"], batch["text"], batch["mark"], strict=True):
                found = shingles(text, known)
                number += 1
                if len(found):
                    own = sketch(found)
                    _, paths = chosen_paths(np.repeat(own[None, :], runs, 0), starts, threshold)
                    digest = xxhash.xxh3_128_digest(found.tobytes())
                    out.append((number, key, mark, digest, len(found), own.tobytes(), np.unique(paths).view(np.int64)))
                else:
                    out.append((number, key, mark, number.to_bytes(8, "big"), 0, b"", np.zeros(0, np.int64)))
            yield pd.DataFrame(out, columns=["rid", "doc_id", "mark", "digest", "size", "sketch", "paths"])

    return rows


def whole_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys, whole; the keys' groups are bounded by the caller."""
    held: pd.DataFrame | None = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        names = rows[keys].to_numpy(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]).any(1)]))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield rows.iloc[a:b]
        held = rows.iloc[starts[-1] :]
    if held is not None:
        yield held


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """The least member each member hangs together with, from a symmetric matrix."""
    label = np.arange(len(adjacent))
    linked = adjacent | np.eye(len(adjacent), dtype=bool)
    while True:
        lower = np.where(linked, label[None, :], len(adjacent)).min(1)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


# --- candidates -------------------------------------------------------------------------------------


def sketch_matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, COORDINATES)


def may_link(marks: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.concatenate([(marks[at : at + 64, None, :] == others[None, :, :]).mean(2) >= MAY_LINK for at in range(0, len(marks), 64)])


def _compare_small(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids, others = [], []
    for group in whole_groups(batches, ["bucket"]):
        marks = sketch_matrix(group["sketch"])
        label = spanning((marks[:, None, :] == marks[None, :, :]).mean(2) >= MAY_LINK)
        moved = np.flatnonzero(label != np.arange(len(label)))
        if len(moved):
            rid = group["rid"].to_numpy()
            ids.extend(rid[moved])
            others.extend(rid[label[moved]])
    yield pd.DataFrame({"a": ids, "b": others}, dtype="int64")


def _split_large(threshold: float):
    """A row per record that is linked to a pivot or close to none: the pivots it is linked to, and unless it is close to one
    its sketch and next paths. Its family are the records that hang together by the same pivots, named by the first (PIVOTS: none).

    Rows come by bucket and piece, the pivots of a bucket (``head``) before its members.
    """

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            if not len(batch):
                continue
            head = batch["head"].to_numpy(bool)
            ids = np.stack([batch[f"pivot_{i}"].to_numpy()[head] for i in range(PIVOTS)], 1).astype(np.int64).reshape(-1, PIVOTS)
            known = [sketch_matrix(batch[f"sketch_{i}"][head]) for i in range(PIVOTS)]
            marked = np.stack(known, 1).reshape(-1, PIVOTS, COORDINATES)
            if held is not None:
                ids, marked = np.concatenate([held[0], ids]), np.concatenate([held[1], marked])
            at = (np.cumsum(head) - 1 + (held is not None))[~head]
            held = ids[-1:], marked[-1:]
            members = batch[~head]
            if not len(members):
                continue
            marks, rid = sketch_matrix(members["sketch"]), members["rid"].to_numpy(np.int64)
            close = np.stack([(marks == marked[at, i]).mean(1) for i in range(PIVOTS)], 1)
            # Pivots that hang together are linked by their own rows; one link to any of them is enough.
            together = np.stack([spanning(np.stack([(m == other).mean(1) for other in m]) >= MAY_LINK) for m in marked])[at]
            near = close >= MAY_LINK
            family = np.where(near.any(1), together[np.arange(len(rid)), near.argmax(1)], PIVOTS)
            linked = near & (ids[at] != rid[:, None])
            own = (ids[at] == rid[:, None]).any(1)
            for i in range(1, PIVOTS):
                for j in range(i):
                    linked[:, i] &= own | ~linked[:, j] | (together[:, i] != together[:, j])
            stays = np.flatnonzero(close.max(1) < COVERED)
            row, paths = chosen_paths(marks[stays], members["bucket"].to_numpy(np.int64).view(np.uint64)[stays], threshold)
            row, next_paths = stays[row], paths.view(np.int64)
            of = lambda values, places: np.split(values, np.cumsum(np.bincount(places, minlength=len(rid)))[:-1])
            linked_row, which = np.nonzero(linked)
            goes_on = close.max(1) < COVERED
            out = pd.DataFrame({
                "bucket": members["bucket"].to_numpy(), "x": rid, "pivots": of(ids[at][linked_row, which], linked_row), "paths": of(next_paths, row),
                "family": family.astype(np.int32), "sketch": np.where(goes_on, members["sketch"].to_numpy(), None)})
            yield out[goes_on | linked.any(1)]

    return rows


def _compare_rest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links among the records outside a bucket's main family, and one of each of them to the piece of the main family it meets."""
    for group in whole_groups(batches, ["bucket", "piece"]):
        marks, rid, rest = sketch_matrix(group["sketch"]), group["rid"].to_numpy(), group["rest"].to_numpy(bool)
        near = may_link(marks[rest], marks)
        inner, outer = near[:, rest], near[:, ~rest]
        label = spanning(inner)
        moved, met = np.flatnonzero(label != np.arange(len(label))), np.flatnonzero(outer.any(1))
        # A piece may hold nothing of the main family.
        main = rid[~rest][outer[met].argmax(1)] if len(met) else rid[:0]
        yield pd.DataFrame({"a": np.concatenate([rid[rest][moved], rid[rest][met]]), "b": np.concatenate([rid[rest][label[moved]], main])}, dtype="int64")


def settled_buckets(split: DataFrame) -> DataFrame:
    """Buckets whose records, as far as they are close to no pivot, lie in one family but for a few, with that family (main) and the number outside it (rest)."""
    counts = [F.struct(F.count_if(F.col("family") == i).alias("n"), F.lit(i).alias("main")) for i in range(PIVOTS)]
    sized = split.where("sketch is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.greatest(*counts).alias("largest"))
    sized = sized.select("bucket", "n", F.col("largest.main").alias("main"), (F.col("n") - F.col("largest.n")).alias("rest"))
    return sized.where(F.col("rest") <= FEW_OUTSIDE)


def rest_links(split: DataFrame, settled: DataFrame) -> DataFrame:
    """Links of the records outside the main families of settled buckets; the main family meets them in pieces."""
    pieces = F.ceil(F.col("n") / TILE_SKETCHES).cast("int")
    own = F.array(F.pmod(F.xxhash64("x"), pieces).cast("int"))
    rows = split.where("sketch is not null").join(settled.where("rest > 0").drop("rest"), "bucket").withColumn("rest", F.col("family") != F.col("main"))
    rows = rows.select("bucket", F.col("x").alias("rid"), "sketch", "rest", F.explode(F.when(F.col("rest"), F.sequence(F.lit(0), pieces - 1)).otherwise(own)).alias("piece"))
    dealt = rows.repartition(shuffle_partitions(split.sparkSession), "bucket", "piece").sortWithinPartitions("bucket", "piece")
    return dealt.mapInPandas(_compare_rest, "a long, b long")


def _with_heads(members: DataFrame, sketched: Callable[[DataFrame], DataFrame], large: DataFrame, pieces: int) -> DataFrame:
    """The members of large buckets dealt to ``pieces`` by record, and the bucket's pivots once in each piece."""
    inside = sketched(members.join(large.select("bucket"), "bucket", "left_semi")).select(
        "bucket", F.pmod(F.xxhash64("rid"), F.lit(pieces)).cast("int").alias("piece"), F.lit(False).alias("head"), "rid", "sketch")
    heads = large.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).withColumn("head", F.lit(True))
    return inside.unionByName(heads.drop("n"), allowMissingColumns=True)


def deal_tiles(rows: DataFrame, group: str, key: str, tile: int) -> DataFrame:
    """Cuts every group of ``n`` rows into pieces of about ``tile``; pieces meet pairwise in tiles (i, j), i <= j, as sides 0 and 1."""
    cut = rows.withColumn("_pieces", F.ceil(F.col("n") / tile).cast("int"))
    cut = cut.withColumn("_piece", F.pmod(F.xxhash64(key), F.col("_pieces")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("_pieces") - 1),
        lambda j: F.struct(F.least("_piece", j).alias("i"), F.greatest("_piece", j).alias("j"), (F.col("_piece") > j).cast("int").alias("side")),
    )
    return cut.withColumn("_tile", F.explode(meets)).select(*rows.columns, "_tile.i", "_tile.j", "_tile.side")


def by_tile(tiles: DataFrame, group: str) -> DataFrame:
    keys = [group, "i", "j"]
    return tiles.repartition(shuffle_partitions(tiles.sparkSession), *keys).sortWithinPartitions(*keys, "side")


def _compare_tiles(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for group in whole_groups(batches, ["bucket", "i", "j"]):
        marks, rid = sketch_matrix(group["sketch"]), group["rid"].to_numpy()
        label = spanning(may_link(marks, marks))
        moved = np.flatnonzero(label != np.arange(len(label)))
        yield pd.DataFrame({"a": rid[moved], "b": rid[label[moved]]})


def candidate_links(records: DataFrame, threshold: float, depth: int) -> DataFrame:
    """Links between records (rid, sketch, paths) that span whatever may hang together."""
    marks = records.select("rid", "sketch")
    sketched = lambda rows: rows if "sketch" in rows.columns else rows.join(marks, "rid")
    members = records.select("rid", F.explode("paths").alias("bucket"))
    links = None
    for level in range(1, depth + 1):
        pivots = [F.min(F.struct(F.xxhash64(F.lit(i), "rid").alias("h"), F.col("rid").alias("rid")))["rid"].alias(f"pivot_{i}") for i in range(PIVOTS)]
        buckets = members.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rid")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "rid")).alias("y"), *pivots
        )
        buckets = materialize(buckets.where("n > 1"), "buckets")
        # Small buckets with the same members are compared once.
        small = buckets.where(F.col("n") <= SMALL_BUCKET).groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
        rows = sketched(members.join(small, "bucket", "left_semi")).select("bucket", "rid", "sketch")
        dealt = rows.repartition(shuffle_partitions(records.sparkSession), "bucket").sortWithinPartitions("bucket", "rid")
        found = dealt.mapInPandas(_compare_small, "a long, b long")
        links = found if links is None else links.union(found)
        large = buckets.where(F.col("n") > SMALL_BUCKET)
        if large.isEmpty():
            break
        if level == depth:
            # Paths of full length are not split further, and nothing is dropped: what they hold meets in tiles.
            # Buckets of one number of pieces, rounded up to three binary digits, are dealt together: four numbers to a doubling.
            pieces = F.ceil(F.col("n") / TILE_SKETCHES)
            step = F.greatest(F.lit(1.0), F.pow(2.0, F.floor(F.log2(pieces)) - 2))
            sized = materialize(large.select("bucket", (F.ceil(pieces / step) * step).cast("long").alias("pieces")), "full-paths")
            for many in sorted(r["pieces"] for r in sized.select("pieces").distinct().collect()):
                rows = sketched(members.join(sized.where(F.col("pieces") == many).select("bucket"), "bucket", "left_semi"))
                tiles = deal_tiles(rows.select("bucket", "rid", "sketch", F.lit(many * TILE_SKETCHES).alias("n")), "bucket", "rid", TILE_SKETCHES)
                links = links.union(by_tile(tiles, "bucket").mapInPandas(_compare_tiles, "a long, b long"))
            break
        large = large.select("bucket", "n", *[f"pivot_{i}" for i in range(PIVOTS)])
        for i in range(PIVOTS):
            large = large.join(marks.select(F.col("rid").alias(f"pivot_{i}"), F.col("sketch").alias(f"sketch_{i}")), f"pivot_{i}")
        large = materialize(large, "heads")
        # A piece's pivots weigh no more than its share of the members does.
        parts = shuffle_partitions(records.sparkSession)
        whole = F.col("n") <= max(WHOLE_BUCKET, 4 * parts)
        dealt = _with_heads(members, sketched, large.where(whole), 1).unionByName(_with_heads(members, sketched, large.where(~whole), parts))
        dealt = dealt.repartition(parts, "bucket", "piece").sortWithinPartitions("bucket", "piece", F.col("head").desc())
        split = materialize(dealt.mapInPandas(_split_large(threshold), "bucket long, x long, pivots array<long>, paths array<long>, family int, sketch binary"), "split")
        settled = materialize(settled_buckets(split), "settled")
        links = links.union(split.select(F.col("x").alias("a"), F.explode("pivots").alias("b"))).union(rest_links(split, settled))
        # Written once: the next level reads its members for buckets, small buckets, pivots' pieces and links.
        further = split.join(settled, "bucket", "left_anti")
        members = materialize(further.select(F.col("x").alias("rid"), F.explode("paths").alias("bucket"), "sketch"), "members")
    return links.distinct()


# --- exact links ------------------------------------------------------------------------------------


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; hashes that only one set has are left out first."""
    every = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, term, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times[term] > 1
    of, term = of[shared], term[shared]
    _, term = np.unique(term, return_inverse=True)
    out = np.zeros((len(sets), len(sets)))
    order = np.argsort(term, kind="stable")
    of, term = of[order], term[order]
    terms = int(term[-1]) + 1 if len(term) else 0
    for at in range(0, terms, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(term, [at, at + COLUMNS_AT_ONCE])
        dense = np.zeros((len(sets), min(COLUMNS_AT_ONCE, terms - at)), np.float32)
        dense[of[a:b], term[a:b] - at] = 1
        out += dense @ dense.T
    return out


def _exact_tiles(threshold: float):
    """kind 0: a record and the copies linked to it in this tile; 1: a link that spans linked records."""

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[pd.DataFrame] = []
        for group in whole_groups(batches, ["candidate", "i", "j"]):
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
            sizes, rid, copies = np.array([len(s) for s in sets], float), group["rid"].to_numpy(), group["copies"].to_numpy()
            common = common_counts(sets)
            linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
            np.fill_diagonal(linked, False)
            if group["i"].iloc[0] != group["j"].iloc[0]:
                side = group["side"].to_numpy()
                linked &= side[:, None] != side[None, :]
            count, label = linked @ copies, spanning(linked)
            hit, moved = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(label)))
            out.append(pd.DataFrame({"kind": 0, "x": rid[hit], "y": count[hit]}))
            out.append(pd.DataFrame({"kind": 1, "x": rid[moved], "y": rid[label[moved]]}))
            if len(out) > 500:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)

    return rows


def _shingle_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = WordHashes()
    for batch in batches:
        sets = [shingles(t, known) for t in batch["text"]]
        same = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, batch["digest"], strict=True)]
        out = batch[["candidate", "rid", "copies"]].assign(shingles=[s.tobytes() for s in sets])
        yield out[np.array(same, bool)]


def text_mark(text: str) -> Column:
    """Tells texts apart, also where doc_id is missing or repeated."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def marked_classes(docs: DataFrame, threshold: float, recall: float, depth: int, key: str, text: str) -> DataFrame:
    """The columns of ``jaccard_classes``, with the mark of each text and the record that names its class (root)."""
    texts = bounded_batches(docs).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), text_mark(text).alias("mark"))
    sketched = texts.mapInPandas(_sketched(threshold, runs_needed(recall, depth)), "rid long, doc_id long, mark binary, digest binary, size int, sketch binary, paths array<long>")
    sketched = materialize(sketched, "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("doc_id"), F.col("rid").alias("rid"), F.col("mark").alias("mark"))
    sets = sketched.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    sets = materialize(sets.select("digest", F.col("first.rid").alias("rid"), F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"), "copies"), "sets")

    records = sketched.where("size > 0").select("rid", "sketch", "paths").join(sets.select("rid"), "rid", "left_semi")
    candidates = components(candidate_links(materialize(records, "records"), threshold, depth))
    named = candidates.select(F.col("node").alias("rid"), F.col("root").alias("candidate")).join(sets, "rid")
    named = materialize(named, "candidates")
    # doc_id may be missing or repeated; with the mark it names a text.
    fetched = named.select("first_id", "first_mark", "candidate", "rid", "copies", "digest").hint("shuffle_hash")
    wanted = texts.join(fetched, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark")))
    found = wanted.mapInPandas(_shingle_rows, "candidate long, rid long, copies long, shingles binary").dropDuplicates(["rid"])
    found = materialize(found, "shingles")
    sizes = found.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"))
    tiles = deal_tiles(found.join(sizes, "candidate"), "candidate", "rid", TILE_RECORDS)
    exact = materialize(by_tile(tiles, "candidate").mapInPandas(_exact_tiles(threshold), "kind int, x long, y long"), "links")

    links = exact.where("kind = 0").groupBy(F.col("x").alias("rid")).agg(F.sum("y").alias("others"))
    roots = components(exact.where("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b")))
    classed = sets.join(roots.select(F.col("node").alias("rid"), "root"), "rid", "left").join(links, "rid", "left")
    classed = materialize(classed.select("digest", "first_id", "copies", F.coalesce("root", "rid").alias("root"), F.coalesce("others", F.lit(0)).alias("others")), "classed")
    classes = classed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    answer = classed.join(classes, "root").select("digest", "root", "class_id", "class_size", (F.col("copies") - 1 + F.col("others")).alias("links"))
    return sketched.select("rid", "doc_id", "mark", "digest").join(answer, "digest").select("rid", "doc_id", "class_id", "class_size", "links", "mark", "root")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """rid, doc_id, class_id, class_size and links, one row per document.

    ``links`` counts the other documents whose similarity is at least the threshold, copies included.
    ``rid`` tells rows apart that share a doc_id.
    """
    return marked_classes(docs, threshold, recall, depth, key, text).drop("mark", "root")


def first_of_each_class(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, of each class only the one with the least key; rows that share that key stay if their texts differ.

    Of a class in which no row has a key, the text with the least mark stays.
    """
    classes = materialize(marked_classes(docs, threshold, RECALL, DEPTH, key, text), "classes")
    same_key = F.col("doc_id").eqNullSafe(F.col("class_id"))
    least = classes.where("class_id is null").groupBy("root").agg(F.min("mark").alias("least"))
    later = classes.where("class_id is null").join(least, "root").where(F.col("mark") != F.col("least"))
    gone = classes.where(~same_key).select("doc_id", "mark").unionByName(later.select("doc_id", "mark")).distinct()
    named_again = classes.where(same_key).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(named_again.where("n > 1").select(F.col("doc_id").alias("again")), "repeated")
    # Packed, so that no column of the input meets a name used here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("number"), text_mark(text).alias("own"))
    kept = packed.join(gone, F.col("number").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("mark")), "left_anti")
    if not repeated.isEmpty():
        same = F.col("number").eqNullSafe(F.col("again"))
        first = kept.join(repeated, same, "left_semi").dropDuplicates(["number", "own"])
        kept = kept.join(repeated, same, "left_anti").unionByName(first)
    return kept.select("row.*")


def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).drop("rid")
