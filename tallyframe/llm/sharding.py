"""Weighted rendezvous sharding of stable record keys, with gapless places inside each shard.

Every record takes the shard with the smallest ``-ln(u) / weight``, where ``u`` is a hash of the
record's key and the shard. A shard so gets records in proportion to its weight, and a change in
the shards only moves records into new shards or out of removed ones.

Defined cases: a missing key counts as the empty text (all such records share a shard); a missing
text has size 8 and the CRC of no bytes, 0; repeated rows each get a place of their own; an empty
table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import BUCKET_DIGITS, empty_if_null, key_text, order_hash, table, unit_from_hex
from tallyframe.session import materialize

SHARDS = 24
RECORD_BYTES = 8


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key among shards of the given positive weights, as struct(cost, shard)."""
    costs = [
        F.struct(
            (-F.ln(unit_from_hex(F.md5(F.concat(key, F.lit(f":{shard}"))))) / F.lit(float(weight))).alias("cost"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in sorted(weights.items())
    ]
    return F.least(*costs) if len(costs) > 1 else costs[0]


def places(rows: DataFrame, group: str, order: str, ties: list[str]) -> DataFrame:
    """Adds ``slot``, the gapless place of each row in its group by a hexadecimal order column.

    Rows are counted by group and leading digits of the order column; prefix sums of these counts
    give each range its first place, and only a range is sorted in one task, never a whole group.
    """
    ranged = rows.withColumn("_range", F.substring(order, 1, BUCKET_DIGITS))
    counts = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select(group, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = W.partitionBy(group, "_range").orderBy(order, *ties)
    return (
        ranged.withColumn("_place", F.row_number().over(inside) - 1)
        .join(first, [group, "_range"])
        .withColumn("slot", F.col("_first") + F.col("_place"))
        .drop("_range", "_first", "_place")
    )


def shard_records(docs: DataFrame, shards: int = SHARDS, weights: Mapping[int, float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (the shard if one of weight 1 more existed)."""
    weights = dict(weights) if weights else {s: 1.0 for s in range(shards)}
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    new = max(weights) + 1
    body = empty_if_null(text).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(key_text(key), weights).alias("_now"),
        rendezvous(key_text(key), {new: 1.0}).alias("_new"),
    )
    rows = rows.select(
        "doc_id", "size", "text_crc32", F.col("_now.shard").alias("shard"),
        F.least("_now", "_new")["shard"].alias("grown_shard"),
        order_hash("slot", key_text("doc_id"), F.col("text_crc32").cast("string")).alias("_order"),
    )
    placed = places(materialize(rows, "sharding"), "shard", "_order", ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents"))


#: The same in SQL. CRC-32 is folded over a text's bytes with a table made from its polynomial.
OP3_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY n) AS tb FROM (
    SELECT n, list_reduce([n::UBIGINT] || [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[],
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v
    FROM range(256) r(n))),
bodies AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
sized AS (
  SELECT doc_id, octet_length(body) + 8 AS size, xor(list_reduce([4294967295::UBIGINT] || list_transform(
      range(0, octet_length(body) * 2, 2), lambda i: ('0x' || substr(hex(body), i + 1, 2))::UBIGINT),
      lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM bodies, crc_table),
costs AS (
  SELECT doc_id, size, text_crc32, s AS shard,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496) AS cost
  FROM sized, range(25) r(s)),
chosen AS (
  SELECT doc_id, size, text_crc32, arg_min(shard, cost) FILTER (shard < 24) AS shard, arg_min(shard, cost) AS grown_shard
  FROM costs GROUP BY ALL)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5('slot:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':'), doc_id, text_crc32, size) - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM chosen
"""
