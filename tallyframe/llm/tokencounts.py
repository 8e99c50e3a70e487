"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes (inserts, deletes and revised counts) is reduced to signed sums per group, which
tasks combine before the shuffle, and added to a store. Totals are the sums of all committed
batches, so nothing is ever counted again.

The store is two folders of tables: attempts, each written under a name of its own, and commits, one
row per commit that names a batch and its attempt. Only attempts named by a commit are read, so a
writer that dies leaves nothing that counts. Committing a batch again adds nothing; if two writers
commit one batch at once, readers take the same one of the two attempts.

Defined cases: missing sources, languages and counts are groups of their own and zero counts; a
batch without changes commits and changes nothing; a revision that names no earlier count counts
from zero; repeated changes count repeatedly; groups whose documents and tokens come to zero are left
out of the totals; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import bounded_batches, empty_if_null, table
from tallyframe.llm.packing import TOKENIZER, WordTokens
from tallyframe.session import materialize, scratch_path

GROUP = ["source", "lang", "tokenizer"]
RANKS = "byte_bpe_50k.tiktoken"
BYTE_BPE, WORD_BPE = "byte_bpe_50k", "word_bpe_49k"
COMMIT_TYPE = "batch_id string, attempt string"
FOLD_TYPE = "attempt string, folded string"
#: Cells that the copies of one text are dealt to.
SALTS = 64
DELTA_TYPE = "source string, lang string, tokenizer string, documents long, tokens long"


# --- signed changes and the store -------------------------------------------------------------------


def signed_deltas(changes: DataFrame) -> DataFrame:
    """Sums per group of changes (kind insert, delete or revise, source, lang, tokenizer, tokens, old_tokens).

    A delete gives the count it takes back as ``tokens``; a revision gives the new and the old count.
    """
    new, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    sign = F.when(F.col("kind") == "insert", 1).when(F.col("kind") == "delete", -1).when(F.col("kind") == "revise", 0)
    sign = F.coalesce(sign, F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce("kind", F.lit("null")))).cast("int"))
    tokens = F.when(sign == 0, new - old).otherwise(sign * new)
    sums = changes.groupBy(*GROUP).agg(F.sum(sign).cast("long").alias("documents"), F.sum(tokens).cast("long").alias("tokens"))
    return sums.where("documents <> 0 or tokens <> 0")


class TokenStore:
    """Committed batches of deltas under a folder that all executors share.

    An attempt holds deltas, and counts if a commit names it. :meth:`fold` adds up what counts into one more
    attempt that stands for all of it, so reading does not grow with the number of batches ever committed.
    """

    def __init__(self, spark: SparkSession, path: str):
        """Opens the store; a new one begins with empty tables."""
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], COMMIT_TYPE).write.mode("ignore").parquet(f"{self.path}/commits")
        spark.createDataFrame([], FOLD_TYPE).write.mode("ignore").parquet(f"{self.path}/folds")
        spark.createDataFrame([], f"{DELTA_TYPE}, attempt string").write.mode("ignore").partitionBy("attempt").parquet(f"{self.path}/attempts")

    def _commits(self) -> DataFrame:
        """One row per batch, with the attempt that counts."""
        rows = self.spark.read.schema(COMMIT_TYPE).parquet(f"{self.path}/commits")
        return rows.groupBy("batch_id").agg(F.min("attempt").alias("attempt"))

    def _counting(self) -> DataFrame:
        """The attempts that make up the totals: those of commits and folds that no fold stands for."""
        folds = self.spark.read.schema(FOLD_TYPE).parquet(f"{self.path}/folds")
        named = self._commits().select("attempt").union(folds.select("attempt")).distinct()
        return named.join(folds.select(F.col("folded").alias("attempt")), "attempt", "left_anti")

    def is_committed(self, batch_id: str) -> bool:
        return not self._commits().where(F.col("batch_id") == batch_id).isEmpty()

    def _written(self, deltas: DataFrame) -> str:
        attempt = uuid.uuid4().hex
        deltas.withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("attempt").parquet(f"{self.path}/attempts")
        return attempt

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch; False, and no work, if it is there already."""
        if self.is_committed(batch_id):
            return False
        attempt = self._written(signed_deltas(changes))
        commit = self.spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"))
        commit.write.mode("append").parquet(f"{self.path}/commits")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents and tokens over all committed batches."""
        attempts = self.spark.read.schema(f"{DELTA_TYPE}, attempt string").parquet(f"{self.path}/attempts")
        counted = attempts.join(self._counting(), "attempt", "left_semi")
        sums = counted.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 or tokens <> 0")

    def fold(self) -> None:
        """Let one attempt stand for all that count now. A fold that dies before its row changes nothing; one fold at a time."""
        counting = [r["attempt"] for r in self._counting().collect()]  # one row per batch since the last fold
        if len(counting) < 2:
            return
        attempt = self._written(self.totals())
        rows = self.spark.createDataFrame([(attempt, old) for old in counting], FOLD_TYPE)
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/folds")

    def clean(self) -> int:
        """Removes attempts that do not count, of dead writers or folded; the number removed. For times when nobody writes."""
        keep = {r["attempt"] for r in self._counting().collect()}
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/attempts")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        there = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("attempt=")]
        gone = [p for p in there if p.getName().removeprefix("attempt=") not in keep]
        for path in gone:
            files.delete(path, True)
        return len(gone)


# --- counting ---------------------------------------------------------------------------------------


def byte_encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(RANKS, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


RUNS = re.compile(r"[ \t\r\n]{2,}")


def squeezed(text: str) -> str:
    """The revised text: runs of white space become their first character."""
    return RUNS.sub(lambda m: m[0][0], text.strip(" \t\r\n"))


_loaded: dict[str, object] = {}


def loaded(kind, path: str):
    """A worker loads a tokenizer once, with the words it remembers."""
    if path not in _loaded:
        _loaded[path] = kind(path)
    return _loaded[path]


def _count_rows(word_path: str, byte_path: str):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, encoder = loaded(WordTokens, word_path), loaded(byte_encoder, byte_path)
        for batch in batches:
            texts = batch["text"].tolist()
            byte_counts = [len(encoder.encode_ordinary(t)) for t in texts]
            revised = [n if (s := squeezed(t)) == t else len(encoder.encode_ordinary(s)) for t, n in zip(texts, byte_counts, strict=True)]
            word_counts = [len(ids) // 4 for at in range(0, len(texts), 256) for ids in words.documents(texts[at : at + 256])]
            yield batch[["doc_id", "source", "lang", "digest"]].assign(byte_tokens=byte_counts, revised_tokens=revised, word_tokens=word_counts)

    return rows


def token_counts(docs: DataFrame, word_path: str | None = None, byte_path: str | None = None) -> DataFrame:
    """doc_id, source, lang, text digest and the tokens of each whole text, as it is and revised."""
    if word_path is None or byte_path is None:
        import public_tokenizers

        word_path, byte_path = word_path or public_tokenizers.path(TOKENIZER), byte_path or public_tokenizers.path(RANKS)
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", empty_if_null().alias("text"), F.md5(empty_if_null()).alias("digest"))
    schema = "doc_id long, source string, lang string, digest string, byte_tokens long, revised_tokens long, word_tokens long"
    return rows.mapInPandas(_count_rows(word_path, byte_path), schema)


def batches_of(counts: DataFrame) -> dict[str, DataFrame]:
    """The history that the query plays: all documents come in, counted by one tokenizer; later a second
    tokenizer version counts them too; exact copies but the one of least doc_id are deleted; and
    documents with runs of white space are revised. A column ``row`` that numbers the rows spreads those without a key."""
    group = ["source", "lang"]
    none = F.lit(None).cast("long").alias("old_tokens")

    def change(kind: str, tokenizer: str, tokens: str, rows: DataFrame, old=none) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), *group, F.lit(tokenizer).alias("tokenizer"), F.col(tokens).alias("tokens"), old)

    # Copies of one text are many where it is common: they meet in cells, and a text's cells are few.
    row = F.col("row") if "row" in counts.columns else F.lit(0)
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64(F.col("doc_id"), row), F.lit(SALTS)))
    cells = salted.groupBy("digest", "_salt").agg(F.min("doc_id").alias("_least"))
    cells = cells.select("digest", "_salt", F.min("_least").over(W.partitionBy("digest")).alias("first_id"))
    told = salted.join(cells, ["digest", "_salt"])
    later = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    copies, kept = told.where(later), told.where(~later)
    return {
        "1-insert": change("insert", BYTE_BPE, "byte_tokens", counts),
        "2-second-version": change("insert", WORD_BPE, "word_tokens", counts),
        "3-delete-copies": change("delete", BYTE_BPE, "byte_tokens", copies).unionByName(change("delete", WORD_BPE, "word_tokens", copies)),
        "4-revise": change("revise", BYTE_BPE, "revised_tokens", kept.where("revised_tokens <> byte_tokens"), F.col("byte_tokens").alias("old_tokens")),
    }


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents")).withColumn("row", F.monotonically_increasing_id())
    counts = materialize(counts, "token-counts")
    store = TokenStore(spark, scratch_path(spark, "token-store"))
    for batch_id, changes in batches_of(counts).items():
        store.commit(batch_id, changes)
    store.fold()
    return store.totals()
