"""Exact nearest neighbours by largest inner product, as a block matrix join.

Candidates are spread over groups of tasks and queries are cut into blocks; every block meets every
group in one tile. Inside a tile all products are taken between vectors rounded to int8. The rounding
errors' norms bound how far such a product can be from the true one; only pairs that can still be
among a query's best are computed again in double precision and enter its heap. The heaps of a
query's tiles are merged at the end. The result is exact: bounds only skip pairs that cannot be in it.

Defined cases: vectors that are missing, empty, zero or hold a missing or non-finite component take
no part; vectors of different lengths are never compared; a query with fewer candidates than ``k``
gets them all; ties go to the smaller id; rows with the same id are candidates each, never of a query
with their own id, and as queries share one list, the k best of all their pairs; an empty table gives
an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import table
from tallyframe.session import materialize

NEIGHBOURS = 20
QUERY_BLOCK = 4096
#: A candidate group is one task's stream per query block; more groups than this only for parallel work.
GROUP_ROWS = 200_000
LEAST_GROUPS = 12
#: Longest run of int8 products whose sum a float32 holds exactly: 127 * 127 * 1024 < 2 ** 24.
EXACT_RUN = 1024
TILE_ROWS = 2048


class Int8:
    """Rows as int8 times a scale, with the norms of the rounded rows and of their errors."""

    def __init__(self, rows: np.ndarray):
        top = np.abs(rows).max(axis=1)
        self.scale = top / 127.0
        self.whole = np.rint(rows / self.scale[:, None]).astype(np.int8)
        rounded = self.whole * self.scale[:, None]
        self.norm = np.sqrt((rounded**2).sum(axis=1))
        self.error = np.sqrt(((rows - rounded) ** 2).sum(axis=1))


def int8_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of two int8 matrices; float32 sums stay whole in runs of EXACT_RUN."""
    out = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, left.shape[1], EXACT_RUN):
        out += left[:, at : at + EXACT_RUN].astype(np.float32) @ right[:, at : at + EXACT_RUN].astype(np.float32).T
    return out


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row, in an order that does not depend on where a pair stands in its tile."""
    return (left * right).sum(axis=1)


class QueryBlock:
    """The queries of one block and the best candidates each has met so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k, self.int8 = ids, rows, k, Int8(rows)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.filled = np.zeros(len(ids), np.int64)

    def meet(self, ids: np.ndarray, rows: np.ndarray) -> None:
        mine, theirs = self.int8, Int8(rows)
        rough = int8_products(mine.whole, theirs.whole) * mine.scale[:, None] * theirs.scale[None, :]
        # |u.v - r(u).r(v)| <= |u - r(u)| |v| + |r(u)| |v - r(v)|, and a little for rounding in the bound itself.
        slack = mine.error[:, None] * (theirs.norm + theirs.error)[None, :] + mine.norm[:, None] * theirs.error[None, :]
        slack += 1e-12 * (mine.norm + mine.error)[:, None] * (theirs.norm + theirs.error)[None, :]
        self_pair = self.ids[:, None] == ids[None, :]
        lower = np.where(self_pair, -np.inf, rough - slack)
        bar = self.scores[:, -1]
        if len(ids) >= self.k:  # the k-th best lower bound of this tile is a bar as well
            bar = np.maximum(bar, np.partition(lower, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        q, c = np.nonzero((rough + slack >= bar[:, None]) & ~self_pair)
        for at in range(0, len(q), 1 << 20):
            self.push(q[at : at + (1 << 20)], c[at : at + (1 << 20)], ids, rows)

    def push(self, q: np.ndarray, c: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = exact_products(self.rows[q], rows[c])
        touched = np.unique(q)
        old = np.repeat(touched, self.k)
        all_q = np.concatenate([q, old])
        all_scores = np.concatenate([scores, self.scores[touched].ravel()])
        all_ids = np.concatenate([ids[c], self.found[touched].ravel()])
        order = np.lexsort((all_ids, -all_scores, all_q))
        all_q, all_scores, all_ids = all_q[order], all_scores[order], all_ids[order]
        first = np.searchsorted(all_q, touched)
        best = first[:, None] + np.arange(self.k)[None, :]
        self.scores[touched], self.found[touched] = all_scores[best], all_ids[best]

    def result(self) -> pd.DataFrame:
        real = np.isfinite(self.scores)
        return pd.DataFrame({"query_id": np.repeat(self.ids, self.k)[real.ravel()], "vec_id": self.found[real], "score": self.scores[real]})


def tiles(batches: Iterable[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by tile, a tile's queries before its candidates, which are only streamed."""
    tile, ids, rows, block = None, [], [], None
    waiting: list[pd.DataFrame] = []

    def flush() -> None:
        if waiting:
            part = pd.concat(waiting)
            waiting.clear()
            block.meet(part["vec_id"].to_numpy(), np.stack(part["embedding"].to_numpy()).astype(np.float64))

    for batch in batches:
        for key, part in batch.groupby(["_dim", "_group", "_block"], sort=False):
            if key != tile:
                if block is not None:
                    flush()
                    yield block.result()
                tile, ids, rows, block = key, [], [], None
            asked = part[part["_kind"] == 0]
            if len(asked):
                ids.append(asked["vec_id"].to_numpy())
                rows.append(np.stack(asked["embedding"].to_numpy()).astype(np.float64))
            given = part[part["_kind"] == 1]
            if len(given) and ids:
                block = block or QueryBlock(np.concatenate(ids), np.concatenate(rows), k)
                for at in range(0, len(given), TILE_ROWS):
                    waiting.append(given.iloc[at : at + TILE_ROWS])
                    if sum(map(len, waiting)) >= TILE_ROWS:
                        flush()
    if block is not None:
        flush()
        yield block.result()


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    clean = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    return rows.where((F.size("embedding") > 0) & clean & ~zero).withColumn("_dim", F.size("embedding"))


def nearest(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, key: str = "vec_id", vector: str = "embedding", query_block: int = QUERY_BLOCK, group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest. ``is_query`` is a condition on vec_id."""
    rows = materialize(usable(vectors, key, vector).withColumn("_query", F.coalesce(is_query, F.lit(False))), "vectors")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_query").alias("q")).first()
    groups, blocks = max(LEAST_GROUPS, -(-counts["n"] // group_rows)), max(1, -(-counts["q"] // query_block))
    spread = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(groups)).cast("int")
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id", "embedding"), F.lit(blocks)).cast("int")
    asked = rows.where("_query").select("vec_id", "embedding", "_dim", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"), block.alias("_block"), F.lit(0).alias("_kind"))
    given = rows.select("vec_id", "embedding", "_dim", spread.alias("_group"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), F.lit(1).alias("_kind"))
    tile = ["_dim", "_group", "_block"]
    dealt = asked.unionByName(given).repartition(groups * blocks, *tile).sortWithinPartitions(*tile, "_kind")
    found = dealt.mapInPandas(lambda batches: tiles(batches, k), "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
