"""Mixing sources to target weights by exact word budgets.

Every document gets a hash-random sort key. Word counts are summed by source and key range, prefix
sums over the ranges find the range in which a source's budget ends, and only the documents of
that range are sorted to find the exact cut. What a source lacks is repeated in whole epochs.

Defined cases: a missing or blank text has size 0 and is never taken; a missing source is a source
of its own, after all others; repeated rows that meet at the cut share what is left evenly; a
source without words has target 0; an empty table gives an empty result; columns other than
key, text and source are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import BUCKET_DIGITS, key_text, order_hash, table
from tallyframe.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_columns(key: str, text: str, source: str) -> list[Column]:
    """A document's size in words, its source as a text that is never missing, its sort key.

    Records without a key are spread by their text.
    """
    name = F.when(F.col(key).isNotNull(), key_text(key)).otherwise(F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return [
        word_count(F.col(text)).alias("size"),
        F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source))).alias("_source"),
        order_hash("mix", name).alias("_order"),
    ]


def source_targets(by_source: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets by weight, none above ``most`` times its source; what is cut off goes to the others by weight.

    Works on one row per source. The level L with sum(min(L * weight, cap)) = total is the largest of
    the levels that follow from taking the k sources of smallest cap / weight as full.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(W.orderBy("_source"))
    rows = by_source.withColumn("_place", place)
    rows = rows.withColumn("_weight", F.element_at(cycle, ((F.col("_place") - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("_cap", F.col("source_size").cast("double") * float(most))
    fill = W.orderBy(F.col("_cap") / F.col("_weight"), "_place")
    total = F.sum("source_size").over(W.partitionBy()).cast("double") * float(share)
    full = F.coalesce(F.sum("_cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_weight").over(fill.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("_level", (total - full) / rest)
    level = F.max("_level").over(W.partitionBy())
    return rows.select("_source", "source_size", F.least("_cap", level * F.col("_weight")).alias("target"))


def source_cuts(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: its target, whole epochs, and the sort key at which the last epoch ends."""
    ranges = (
        rows.groupBy("_source", F.substring("_order", 1, BUCKET_DIGITS).alias("_range"))
        .agg(F.sum("size").alias("_words"))
    )
    by_source = ranges.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(by_source, weights, share, most)
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most)
    targets = targets.withColumn("_budget", budget.cast("long"))
    whole = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    targets = targets.withColumn("_epochs", whole.cast("long"))
    targets = materialize(targets.withColumn("_left", F.col("_budget") - F.col("_epochs") * F.col("source_size")), "mix-targets")

    before = W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    ends_here = (F.col("_start") < F.col("_left")) & (F.col("_start") + F.col("_words") >= F.col("_left"))
    last = starts.join(targets.select("_source", "_left"), "_source").where(ends_here)
    # At most one range per source is sorted. Equal rows count together.
    inside = (
        rows.withColumn("_range", F.substring("_order", 1, BUCKET_DIGITS))
        .join(last, ["_source", "_range"])
        .groupBy("_source", "_range", "_start", "_left", "_order", "size").agg(F.count(F.lit(1)).alias("_equal"))
    )
    words = F.col("size") * F.col("_equal")
    upto = W.partitionBy("_source", "_range").orderBy("_order", "size").rowsBetween(W.unboundedPreceding, 0)
    inside = inside.withColumn("_from", F.col("_start") + F.sum(words).over(upto) - words)
    cut = inside.where((F.col("_from") < F.col("_left")) & (F.col("_from") + words >= F.col("_left"))).select(
        "_source", F.col("_order").alias("_cut_order"), F.col("size").alias("_cut_size"),
        F.expr("(_left - _from) div _equal").alias("_cut_words"),
    )
    return targets.join(cut, "_source", "left")


def taken_words(epochs: Column, size: Column, order: Column) -> Column:
    """Words of a document that the mix takes, by its source's row of source_cuts."""
    key, cut = F.struct(order, size), F.struct(F.col("_cut_order"), F.col("_cut_size"))
    more = F.when(F.col("_cut_order").isNull(), F.lit(0)).when(key < cut, size).when(key == cut, F.col("_cut_words")).otherwise(F.lit(0))
    return (epochs * size + more).cast("long")


def mix_allocation(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken, one row per document."""
    rows = materialize(docs.select(F.col(key).alias("doc_id"), *mix_columns(key, text, source)), "mix")
    cuts = materialize(source_cuts(rows, weights, share, most), "mix-cuts")
    joined = rows.join(cuts, "_source")
    return joined.select("doc_id", "size", "source_size", "target", taken_words(F.col("_epochs"), F.col("size"), F.col("_order")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of the input.

    The document at a source's cut is kept whole if at least half of it is within the budget.
    Texts are not shuffled: only each source's row of source_cuts meets them.
    """
    rows = materialize(docs.select(*mix_columns(key, text, source)), "mix")
    cuts = materialize(source_cuts(rows, weights, share, most), "mix-cuts")
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document")
    joined = docs.select(document, *mix_columns(key, text, source)).join(cuts, "_source")
    taken = taken_words(F.col("_epochs"), F.col("size"), F.col("_order"))
    times = F.floor(taken / F.col("size") + 0.5).cast("int")
    kept = joined.where(F.col("size") > 0).withColumn("_times", times).where(F.col("_times") > 0)
    return kept.select("_document", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_document.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_allocation(table(spark, sf_dir, "documents"))


#: The same allocation in SQL; doc_id is unique in the given tables, so no equal rows meet at a cut.
OP4_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || CASE WHEN doc_id IS NULL THEN 'text:' || md5(coalesce(text, '')) ELSE doc_id::VARCHAR END || ':') AS k
  FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM rows GROUP BY source),
weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         source_size::DOUBLE * 2 AS cap FROM by_source),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM levels),
budgets AS (
  SELECT *, least(floor(target + 0.5::DOUBLE)::BIGINT, source_size * 2) AS budget FROM targets),
running AS (
  SELECT r.doc_id, r.size, b.source_size, b.target,
         CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS epochs,
         b.budget - CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END * b.source_size AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY k, r.size ROWS UNBOUNDED PRECEDING) - r.size AS start
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken
FROM running
"""
