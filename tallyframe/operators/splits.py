"""Train/validate splits and folds that are functions of the row key."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.keys import RANGE, key_hash, key_order
from tallyframe.operators.distribute import running_totals
from tallyframe.session import shuffle_partitions


def train_label(key: str, share: float = 0.75, seed: int = 0) -> Column:
    """"train" with probability ``share``, else "validate"."""
    return F.when(key_hash(F.col(key), seed) < F.lit(int(share * RANGE)), "train").otherwise("validate")


def split(df: DataFrame, key: str, share: float = 0.75, seed: int = 0) -> dict[str, DataFrame]:
    """Both parts of a train/validate split, each a filter over the input; group by :func:`train_label` to read it once."""
    labelled = df.withColumn("trainvalidate", train_label(key, share, seed))
    return {p: labelled.filter(F.col("trainvalidate") == p) for p in ("train", "validate")}


def fold_label(key: str, folds: int = 10, seed: int = 0) -> Column:
    """Fold letter A, B, … of each row."""
    letters = F.array(*[F.lit(c) for c in string.ascii_uppercase[:folds]])
    number = F.floor(key_hash(F.col(key), seed) * folds / RANGE).cast("int")
    return F.get(letters, number)


def stratified_label(df: DataFrame, key: str, level: str, share: float = 0.7, seed: int = 0) -> DataFrame:
    """Label exactly ``ceil(share · n)`` rows of each class "train", the rest "validate".

    Rows are ranked by key hash inside their class. Only the hash at the cut is
    needed per class, so the full rows are never sorted: running counts find
    the cuts, and one small table of cuts is joined to the rows. The hash is
    uniform and one-to-one, which gives the range limits and rules out ties.
    """
    order = key_order(F.col(key), seed)
    parts = shuffle_partitions(df.sparkSession)
    limits = [i * float(2**63) / parts for i in range(1, parts)]
    ranked = running_totals(
        df.select(level, order.alias("_order")), "_order", {"n": F.lit(1)}, [level], splits=limits
    )
    cuts = (
        ranked.filter(F.col("n_run") >= F.ceil(F.lit(share) * F.col("n_all")))
        .groupBy(level)
        .agg(F.min("_order").alias("_cut"))
        .withColumnRenamed(level, "_level")
    )
    return (
        df.join(cuts, F.col(level).eqNullSafe(F.col("_level")), "left")
        .withColumn("part", F.when(order <= F.col("_cut"), "train").otherwise("validate"))
        .drop("_cut", "_level")
    )
