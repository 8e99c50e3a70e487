"""A Merkle manifest of a dataset: a digest per record, a tree per source, a root over the sources, and a proof per record.

Records are ranked inside their source over all tasks. The base-16 digits of the rank are columns; a
block is three digits, 4096 records. Inside a block the digits are grouped away one after the other:
each grouping gathers up to 16 child structs into their parent's struct, so the block's row holds its
part of the tree. The blocks' digests are the nodes of the next tier, which is built the same way,
until a source is one node; the sources' nodes are then rolled up likewise.

Proofs run the other way. A tier's blocks meet the paths from above by one more grouping by block
(the path is a row beside the block's own row), and a block's nested structs are transformed into the
digests left and right of each child and exploded, level by level. No step joins records with tree nodes.

Defined cases: a missing value enters the leaf as ``-``; a missing source is a source of its own, first in
order; records of a source ascend by key, missing keys first, then by leaf digest, so repeated rows
stand beside each other and each has a place and a proof; a lone leaf is its source's root, a lone
source's root is the root; a record without key is not tampered with; an empty table gives an empty
result; texts of any length enter their leaf whole; columns outside ``fields`` are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import table
from tallyframe.operators.distribute import row_positions, sorted_parts
from tallyframe.session import materialize

FANOUT = 16
#: Rank digits that a block holds.
DIGITS = 3
BLOCK = FANOUT**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hexadecimal SHA-256 of the values, each ``-`` if missing, else its UTF-8 length, ``:`` and itself."""
    text = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text]
    return F.sha2(F.concat(*parts), 256)


def ranked(leaves: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``node_group`` (number of the group in order, from 0), ``rank`` (place in the group, from 0) and ``size`` (rows of the group)."""
    parts = sorted_parts(leaves, [F.col(c).asc_nulls_first() for c in (group, *order)], "ranked")
    # One row per group and task of the sort.
    pieces = materialize(parts.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")), "pieces")
    numbered = row_positions(pieces.select(group).distinct(), [F.col(group).asc_nulls_first()], "_number")
    whole = W.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col(group).alias("_group"), F.col("_part").alias("_piece"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("size"))
    numbered = numbered.select(F.col(group).alias("_named"), (F.col("_number") - 1).alias("node_group"))
    pieces = pieces.join(numbered, F.col("_group").eqNullSafe(F.col("_named"))).drop("_named")
    same = (F.col("_part") == F.col("_piece")) & F.col(group).eqNullSafe(F.col("_group"))
    return parts.join(pieces, same).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_piece", "_group", "_shift")


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def rolled_up(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes (node_group, size, rank, digest, load): node_group, size, block, digest and the nested ``tree``.

    A level is hashed only if its group has several nodes there; else the only node is handed up as it is.
    """
    digit = lambda i: F.expr(f"cast((rank div {FANOUT**i}) % {FANOUT} as int)")
    rows = nodes.select(
        "node_group", "size", F.expr(f"rank div {BLOCK}").alias("block"), *[digit(i).alias(f"d{i}") for i in range(DIGITS)], "digest", "load")
    # Every grouping below has these keys among its own, so this is the only exchange.
    rows = rows.repartition("node_group", "block")
    keys, child = ["node_group", "size", "block", *[f"d{i}" for i in reversed(range(DIGITS))]], F.struct("d0", "digest", "load")
    for level in range(DIGITS):
        keys = keys[:-1]
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        several = F.col("size") > FANOUT**level
        digest = F.when(several, F.sha2(_joined(F.col("kids.digest")), 256)).otherwise(F.col("kids")[0]["digest"])
        rows = rows.withColumn("digest", digest)
        if level + 1 < DIGITS:
            child = F.struct(f"d{level + 1}", "digest", "kids")
    return rows.withColumnRenamed("kids", "tree")


def handed_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """A block's nodes with their paths: node_group, rank, digest, load, path (left and right digests from the node up), told.

    ``above`` holds node_group, block, path and ``told`` (what the paths above know) of every block.
    """
    own = blocks.select("node_group", "block", "size", "tree", F.lit(None).cast(above.schema["path"].dataType).alias("path"), F.lit(None).cast(above.schema["told"].dataType).alias("told"))
    theirs = above.select("node_group", "block", F.lit(None).cast("long").alias("size"), F.lit(None).cast(blocks.schema["tree"].dataType).alias("tree"), "path", "told")
    one = lambda c: F.first(c, ignorenulls=True).alias(c)
    rows = own.unionByName(theirs).groupBy("node_group", "block").agg(one("size"), one("tree"), one("path"), one("told"))
    rows = rows.withColumn("rank", F.col("block")).withColumnRenamed("tree", "kids").drop("block")
    for level in reversed(range(DIGITS)):
        seen = F.transform("kids", lambda kid, i: F.struct(
            kid.alias("kid"), i.alias("at"),
            _joined(F.slice(F.col("kids.digest"), F.lit(1), i)).alias("left"), _joined(F.slice(F.col("kids.digest"), i + 2, F.lit(FANOUT))).alias("right")))
        step = F.array(F.struct(F.col("one.left").alias("left"), F.col("one.right").alias("right")))
        rows = rows.withColumn("one", F.explode(seen)).select(
            "node_group", "size", (F.col("rank") * FANOUT + F.col("one.at")).alias("rank"), "told", F.col("one.kid.digest").alias("digest"),
            F.when(F.col("size") > FANOUT**level, F.concat(step, "path")).otherwise(F.col("path")).alias("path"),
            F.col("one.kid.kids" if level else "one.kid.load").alias("kids" if level else "load"))
    return rows.drop("size")


def _tiers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks, lowest first, and the top nodes: node_group, digest."""
    most = nodes.agg(F.max("size")).first()[0] or 1
    tiers = []
    while not tiers or most > 1:
        tiers.append(materialize(rolled_up(nodes), "manifest-tier"))
        most = -(-most // BLOCK)
        nodes = tiers[-1].select(
            "node_group", F.ceil(F.col("size") / BLOCK).cast("long").alias("size"), F.col("block").alias("rank"), "digest", F.lit(0).alias("load"))
    return tiers, tiers[-1].select("node_group", "digest")


def with_proofs(leaves: DataFrame, group: str = "source", key: str = "doc_id") -> DataFrame:
    """Per leaf (columns ``group``, ``key``, leaf, load): leaf, load, subroot, root and path.

    ``path`` lists, from the leaf's run up to the root, the digests left and right of the node on the way.
    """
    pinned = materialize(leaves.select(F.col(group).alias("grp"), F.col(key).alias("key"), "leaf", "load", F.monotonically_increasing_id().alias("row")), "leaves")
    nodes = ranked(pinned, "grp", ["key", "leaf", "row"]).select("node_group", "size", "rank", F.col("leaf").alias("digest"), "load")
    tiers, tops = _tiers(materialize(nodes, "ranks"))
    groups = tops.select(F.lit(0).cast("long").alias("node_group"), F.col("node_group").alias("rank"), "digest", F.col("digest").alias("load"))
    count = tops.count()
    over, root = _tiers(groups.withColumn("size", F.lit(count).cast("long")))
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    paths = root.select("node_group", F.lit(0).cast("long").alias("block"), nothing.alias("path"), F.struct(F.lit("").alias("subroot"), F.col("digest").alias("root")).alias("told"))
    for tier in reversed(over):
        found = handed_down(tier, paths)
        paths = found.select("node_group", F.col("rank").alias("block"), "path", "told")
    # A source's root is the node the path continues from.
    paths = found.select(
        F.col("rank").alias("node_group"), F.lit(0).cast("long").alias("block"), "path", F.struct(F.col("digest").alias("subroot"), F.col("told.root").alias("root")).alias("told"))
    for tier in reversed(tiers):
        found = handed_down(tier, materialize(paths, "paths"))
        paths = found.select("node_group", F.col("rank").alias("block"), "path", "told")
    return found.select(F.col("digest").alias("leaf"), "load", F.col("told.subroot").alias("subroot"), F.col("told.root").alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives along a path."""
    return F.aggregate(path, leaf, lambda x, s: F.sha2(F.concat(s["left"], x, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path in one text."""
    return _joined(F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """Every record's proof, and what verification says when some texts were lower-cased after the manifest was made."""
    as_is = [F.col(c) for c in FIELDS]
    changed = [F.translate(c, UPPER, LOWER) if n == "text" else c for n, c in zip(FIELDS, as_is)]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    load = F.struct("doc_id", F.when(hit, leaf_digest(changed)).alias("presented"))
    proofs = with_proofs(docs.select("source", "doc_id", leaf_digest(as_is).alias("leaf"), load.alias("load")))
    root = folded(F.coalesce("load.presented", "leaf"), F.col("path"))
    return proofs.select(
        F.col("load.doc_id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(table(spark, sf_dir, "documents"))


def _levels(first: str, name: str, count: int) -> str:
    """SQL of ``count`` levels above the nodes (g, r, n, digest) of ``first``: runs of siblings and their parents."""
    out, last = [], first
    for j in range(count):
        out.append(f"""
{name}_runs{j} AS (SELECT g, r // 16 AS p, any_value(n) AS n, list(digest ORDER BY r) AS run FROM {last} GROUP BY g, r // 16),
{name}{j} AS (SELECT g, p AS r, n, CASE WHEN n > {16**j} THEN sha256(array_to_string(run, '')) ELSE run[1] END AS digest FROM {name}_runs{j})""")
        last = f"{name}{j}"
    return ",".join(out)


def _way_up(source: str, name: str, count: int) -> str:
    """SQL of a walk from ``source`` (g, r, digest, proof, fold) over those levels."""
    out, last = [], source
    for j in range(count):
        at, run = f"(w.r // {16**j}) % 16", "u.run"
        left, right = f"array_to_string({run}[1:{at}], '')", f"array_to_string({run}[{at} + 2:], '')"
        out.append(f"""
{name}{j} AS (SELECT w.* EXCLUDE (proof, fold), CASE WHEN u.n > {16**j} THEN proof || {left} || {right} ELSE proof END AS proof,
  CASE WHEN u.n > {16**j} THEN sha256({left} || fold || {right}) ELSE fold END AS fold
  FROM {last} w JOIN {source.split("_")[0]}_runs{j} u ON u.g = w.g AND u.p = w.r // {16 ** (j + 1)})""")
        last = f"{name}{j}"
    return ",".join(out)


#: Levels the SQL twin builds over records and over sources.
SQL_LEVELS, SQL_SOURCE_LEVELS = 6, 3


def _part(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_part(text if c == 'text' else c) for c in FIELDS)})"


OP11_SQL = f"""
WITH crc_table AS (
  SELECT list(v ORDER BY n) AS tb FROM (
    SELECT n, list_reduce([n::UBIGINT] || [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[],
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v
    FROM range(256) r(n))),
checked AS (
  SELECT *, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
    lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS crc
  FROM documents, crc_table),
doc AS (
  SELECT doc_id, leaf AS digest, CASE WHEN crc % {TAMPER_EVERY} = 0 THEN changed ELSE leaf END AS presented, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, crc, {_leaf_sql("text")} AS leaf, {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS changed FROM checked)),
{_levels("doc", "doc", SQL_LEVELS)},
src AS (SELECT 0 AS g, g AS r, count(*) OVER () AS n, digest FROM doc{SQL_LEVELS - 1}),
{_levels("src", "src", SQL_SOURCE_LEVELS)},
doc_start AS (SELECT d.*, '' AS proof, presented AS fold FROM doc d),
{_way_up("doc_start", "up", SQL_LEVELS)},
src_start AS (SELECT w.doc_id, w.digest, s.digest AS subroot, w.proof, w.fold, s.g, s.r FROM up{SQL_LEVELS - 1} w JOIN src s ON s.r = w.g),
{_way_up("src_start", "over", SQL_SOURCE_LEVELS)}
SELECT doc_id, w.digest AS leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.digest AS verified
FROM over{SQL_SOURCE_LEVELS - 1} w, src{SQL_SOURCE_LEVELS - 1} t
"""
