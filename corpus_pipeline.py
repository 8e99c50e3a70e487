"""A corpus pipeline over the documents: toxic and unidentified texts go, near copies go, sources are mixed, sequences are packed.

Every stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of ``docs``;
the last returns the packed pieces. Each stage's result is written as Parquet in the shared folder
and read again as the next one's input, so a lost executor never reaches behind the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import chosenpath, langid, mixing, packing, toxicity
from tallyframe.llm.common import table
from tallyframe.session import materialize

def packed(docs: DataFrame) -> DataFrame:
    """The rows whole beside their key and text, so that no column of theirs meets a name used by a stage."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, learned on the labels, does not take for toxic."""
    machine = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(packed(docs), machine).where(F.col("toxicity.predicted") == 0).select("row.*")


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages that were learned, one or several; texts that are missing or without letters go,
    and those that evenly random letters explain better than the languages do."""
    found = langid.identified(packed(docs), langid.fit_languages(docs))
    return found.where((F.col("language.lang_pred") != langid.UNDETERMINED) & (F.col("language.fit") > 0)).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return chosenpath.first_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight; documents of sources that lack words come again."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenized documents with their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned stages nor the tokenizer; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
