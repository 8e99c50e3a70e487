"""Ops 11 and 12: exact copies against plain grouping, manifests against a plain tree."""

import hashlib
import re
import zlib

from pyspark.sql import functions as F

from tallyframe.llm import chunkdedup, manifest


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_copies(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(squeezed(text), []).append(key)
    out = []
    for body, keys in groups.items():
        keys = sorted(keys, key=lambda k: (k is None, k or 0))
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(k, keys[0], len(keys), i == 0, digest) for i, k in enumerate(keys)]
    return sorted(out, key=str)


def copies(df, **options):
    return sorted(map(tuple, chunkdedup.exact_copies(df, **options).collect()), key=str)


def test_copies_against_plain(docs):
    assert copies(docs) == plain_copies(docs.select("doc_id", "text").collect())


def test_copies_edges(edge_docs, empty_docs):
    want = plain_copies(edge_docs.select("doc_id", "text").collect())
    assert copies(edge_docs) == want
    # Hashes that collide all the time must not change anything.
    assert copies(edge_docs, hash_of=lambda body: F.length(body) % 3, chunk_words=2) == want
    assert copies(empty_docs) == []


def test_colliding_hashes_keep_texts_apart(spark):
    words = ["alpha", "gamma", "delta", "omega"]
    rows = [(i, " ".join(words[(i >> s) % 4] for s in (0, 2, 4))) for i in range(64)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert copies(df, hash_of=lambda body: F.lit(1), chunk_words=1) == plain_copies(rows)


def test_chunks_join_to_the_text(spark, docs):
    long = "x" * 200_000 + " " + "y z " * 50_000
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(-1, long), (-2, None), (-3, " \t\n")], "doc_id long, text string"))
    for hash_of in (F.xxhash64, F.length):
        cut = chunkdedup.chunked(rows, hash_of=hash_of)
        store = chunkdedup.chunk_store(cut)
        back = chunkdedup.restored(chunkdedup.recipes(cut), store).join(rows.withColumnRenamed("doc_id", "key").withColumnRenamed("text", "was"), "key")
        assert back.count() == rows.count() and back.where(F.col("text") != chunkdedup.normalised("was")).isEmpty()
        assert store.count() == store.select("body").distinct().count() == store.select("id", "mark").distinct().count()


def test_a_shared_passage_shares_chunks(spark, docs):
    first, second = [" ".join(r.text for r in docs.orderBy("doc_id").limit(12).collect()[i::2]) for i in (0, 1)]
    df = spark.createDataFrame([(1, first), (2, "moved by some words " + first), (3, second)], "doc_id long, text string")
    ids = {r.key: set(r.ids) for r in chunkdedup.recipes(chunkdedup.chunked(df)).collect()}
    assert len(ids[1] & ids[2]) > 0.9 * len(ids[1]) and len(ids[1] & ids[3]) < 0.1 * len(ids[1])


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return plain_hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(nodes):
    """Top digest, and per node its siblings as (left, right) from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for path, i in zip(paths, at):
            run, k = runs[i // 16], i % 16
            path.append(("".join(run[:k]), "".join(run[k + 1 :])))
        at, nodes = [i // 16 for i in at], [plain_hash(*run) for run in runs]
    return nodes[0], paths


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by_source, out = {}, []
    for r in rows:
        by_source.setdefault(r[1], []).append((plain_leaf(r), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = plain_tree([leaf for leaf, _ in by_source[s]])
    root, tops = plain_tree([trees[s][0] for s in names]) if names else ("", [])
    for s, top in zip(names, tops):
        for (leaf, r), path in zip(by_source[s], trees[s][1]):
            shown, key = leaf, r[0]
            if key is not None and zlib.crc32(str(key).encode()) % 5 == 0 and r[4] is not None:
                shown = plain_leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            for left, right in (whole := path + top):
                shown = plain_hash(left, shown, right)
            out.append((key, leaf, trees[s][0], root, plain_hash(*[x for step in whole for x in step]), shown, shown == root))
    return sorted(out, key=str)


def manifested(df):
    return sorted(map(tuple, manifest.tampered_manifest(df).collect()), key=str)


def test_manifest_against_plain(docs, edge_docs, empty_docs):
    for df in (docs, edge_docs):
        assert manifested(df) == plain_manifest([tuple(r) for r in df.select(*manifest.FIELDS).collect()])
    assert manifested(empty_docs) == []


def test_manifest_of_several_tiers(spark):
    """More records in a source than a block holds, more sources than a run, a lone leaf, and one key on many rows."""
    rows = [(i if i % 3 else None, "big", "en", i, f"Text {i}") for i in range(5000)]
    rows += [(i, f"s{i % 40:02}", None, 1, "Small") for i in range(700)] + [(1, None, "en", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert manifested(df) == plain_manifest(rows)
    few = df.where("source = 's07'").limit(1)
    got = manifest.tampered_manifest(few).first()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == plain_hash("")
