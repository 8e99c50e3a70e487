"""Exact copies found through content-defined chunk recipes.

A text is normalised (each run of white space becomes one space) and cut into chunks where the text
itself says so: after a word whose hash together with the word before it has a set remainder, so a
passage is cut alike wherever it stands. Chunks are deduplicated to identifiers; an identifier is a
64-bit hash, verified by comparing the bytes of all chunks that carry it, and where different chunks
share a hash each gets a mark of its own beside it. A text is then its ordered list of identifiers,
and texts are compared by these lists alone. Only distinct chunks move, once per task that holds
them; a long text that many records share is never moved again.

DataFrame functions only. A large group of copies is counted in salted cells, and its result goes
back to the cells, so neither step meets the group in one task.

Defined cases: a missing text counts as empty, and empty texts are equal (their recipe has no
chunks; a text of white space alone is one space); of equal texts the record with the smallest key
stays, a missing key coming after all others, and of rows that share that key one stays; a repeated
row is a copy; texts of any length are cut in blocks of ``BLOCK_CHARS`` code points, words longer
than ``WORD_CHARS`` in parts; an empty table gives an empty result; other columns pass through
:func:`exact_copies`' input unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import empty_if_null, table
from tallyframe.session import materialize

#: A chunk ends after one word in this many, on average.
CHUNK_WORDS = 64
#: Longest part of a word, and longest block of a text, that is looked at in one piece.
WORD_CHARS = 64
BLOCK_CHARS = 1 << 16
#: Cells a group of copies is dealt to.
SALTS = 256

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(empty_if_null(text), WHITE_SPACE, " ")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def chunks_of(text: Column, chunk_words: int = CHUNK_WORDS) -> Column:
    """The content-defined chunks of a normalised text, in order; joined they give the text."""

    def of_words(words: Column) -> Column:
        ends = F.filter(
            F.sequence(F.lit(1), F.size(words)),
            lambda i: (i == F.size(words)) | (F.pmod(F.xxhash64(F.get(words, i - 2), words[i - 1]), F.lit(chunk_words)) == 0),
        )
        return _let(ends, lambda e: F.transform(e, lambda end, k: _let(
            F.when(k == 0, 0).otherwise(e[F.greatest(k - 1, F.lit(0))]), lambda start: F.array_join(F.slice(words, start + 1, end - start), ""))))

    words_in = lambda block: F.regexp_extract_all(block, F.lit(rf"[^ ]{{1,{WORD_CHARS}}} ?| "), F.lit(0))
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    return F.flatten(F.transform(blocks, lambda b: _let(words_in(b), of_words)))


def chunked(docs: DataFrame, text: str = "text", key: str = "doc_id", chunk_words: int = CHUNK_WORDS, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Written once: key, rid (a number per row), text_sha256 of the normalised text, chunks (id, body) in order."""
    rows = docs.select(F.col(key).alias("key"), normalised(text).alias("body"))
    rows = rows.select("key", F.sha2("body", 256).alias("text_sha256"), chunks_of(F.col("body"), chunk_words).alias("chunks"))
    cut = F.transform("chunks", lambda c: F.struct(hash_of(c).cast("long").alias("id"), c.alias("body")))
    return materialize(rows.select("key", F.monotonically_increasing_id().alias("rid"), "text_sha256", cut.alias("chunks")), "chunked")


def chunk_store(cut: DataFrame) -> DataFrame:
    """Every distinct chunk once: id, mark (0, or the chunk's number among different chunks with that id), body."""
    distinct = cut.select(F.inline("chunks")).distinct()
    several = _shared_ids(distinct)
    # Chunks of one id are as many as 64-bit hashes collide.
    marked = distinct.join(several, "id", "left_semi").withColumn("mark", F.row_number().over(W.partitionBy("id").orderBy("body")) - 1)
    alone = distinct.join(several, "id", "left_anti").withColumn("mark", F.lit(0))
    return alone.unionByName(marked).select("id", "mark", "body")


def _shared_ids(distinct: DataFrame) -> DataFrame:
    return materialize(distinct.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id"), "shared-ids")


def recipes(cut: DataFrame) -> DataFrame:
    """key, rid, text_sha256 and the recipe: ids in order, and marks in order (empty where every id names one chunk)."""
    rows = cut.select("key", "rid", "text_sha256", F.col("chunks.id").alias("ids"))
    several = _shared_ids(cut.select(F.inline("chunks")).distinct())
    none = F.array().cast("array<int>")
    if several.isEmpty():
        return rows.withColumn("marks", none)
    parts = cut.select("rid", F.posexplode("chunks").alias("at", "chunk")).select("rid", "at", F.col("chunk.id").alias("id"), F.col("chunk.body").alias("body"))
    marked = parts.join(several, "id", "left_semi").withColumn("mark", F.dense_rank().over(W.partitionBy("id").orderBy("body")) - 1)
    found = marked.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("at", "mark"))).alias("_found"))
    marks = F.transform("ids", lambda _, i: F.coalesce(F.col("_found")[i], F.lit(0)))
    return rows.join(found, "rid", "left").withColumn("marks", F.when(F.col("_found").isNull(), none).otherwise(marks)).drop("_found")


def restored(listed: DataFrame, store: DataFrame) -> DataFrame:
    """key, rid and the normalised text put together again from recipes and the chunk store."""
    marks = F.when(F.size("marks") == 0, F.transform("ids", lambda _: F.lit(0))).otherwise(F.col("marks"))
    parts = listed.select("rid", F.posexplode(F.arrays_zip("ids", marks.alias("marks"))).alias("at", "part"))
    parts = parts.select("rid", "at", F.col("part.ids").alias("id"), F.col("part.marks").alias("mark"))
    texts = parts.join(store, ["id", "mark"]).groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("at", "body"))).alias("_parts"))
    return listed.select("key", "rid").join(texts, "rid", "left").select(
        "key", "rid", F.coalesce(F.array_join(F.col("_parts.body"), ""), F.lit("")).alias("text"))


def exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", chunk_words: int = CHUNK_WORDS, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Per row: the key, keep_id (key of the row that stays), group_size, kept and text_sha256 of the normalised text."""
    listed = recipes(chunked(docs, text, key, chunk_words, hash_of)).withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    recipe = ["ids", "marks"]
    # A missing key comes last; the row number settles rows that share a key.
    first = F.struct(F.col("key").isNull().alias("missing"), "key", "rid")
    cells = listed.groupBy(*recipe, "salt").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    # At most SALTS rows of a group meet here.
    group = W.partitionBy(*recipe)
    cells = cells.select(*recipe, "salt", F.min("first").over(group).alias("first"), F.sum("n").over(group).alias("group_size"))
    return listed.join(cells, [*recipe, "salt"]).select(
        F.col("key").alias(key), F.col("first.key").alias("keep_id"), "group_size", (F.col("rid") == F.col("first.rid")).alias("kept"), "text_sha256")


def op12_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"))


#: The same in SQL.
OP12_SQL = r"""
WITH bodies AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body, row_number() OVER () AS rid FROM documents)
SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER same = 1 AS kept, sha256(body) AS text_sha256
FROM bodies WINDOW same AS (PARTITION BY body ORDER BY doc_id NULLS LAST, rid)
"""
