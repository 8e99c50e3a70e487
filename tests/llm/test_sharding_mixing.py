"""Ops 3 and 4 against plain Python."""

import hashlib
import math
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import mixing, sharding


def plain_shard(key, shards):
    def cost(s):
        digest = hashlib.md5(f"{key}:{s}".encode()).hexdigest()
        return -math.log((int(digest[:13], 16) + 0.5) / 2**52), s

    return min(map(cost, shards))[1]


def test_shards_against_plain(docs, docs_pdf):
    got = sharding.shard_records(docs).toPandas().set_index("doc_id")
    for key, text in zip(docs_pdf.doc_id, docs_pdf.text):
        row = got.loc[key]
        assert row.shard == plain_shard(key, range(24)) and row.grown_shard == plain_shard(key, range(25))
        assert row["size"] == len(text.encode()) + 8 and row.text_crc32 == zlib.crc32(text.encode())
    assert ((got.grown_shard == got.shard) | (got.grown_shard == 24)).all()
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_shard_weights(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = dict(sharding.shard_records(many, weights={0: 1.0, 1: 3.0}).groupBy("shard").count().collect())
    assert abs(got[1] / got[0] - 3) < 0.15
    before = sharding.shard_records(many, weights={0: 1.0, 1: 1.0})
    after = sharding.shard_records(many, weights={0: 1.0, 1: 1.0, 2: 2.0}).select("doc_id", F.col("shard").alias("later"))
    moved = before.join(after, "doc_id").where("shard <> later")
    assert moved.where("later <> 2").isEmpty() and abs(moved.count() / 20_000 - 0.5) < 0.02
    with pytest.raises(ValueError):
        sharding.shard_records(many, weights={0: 0.0})


def test_shard_edges(edge_docs, empty_docs):
    got = sharding.shard_records(edge_docs).toPandas()
    assert len(got) == 15 and got[got.doc_id == 1][["size", "text_crc32"]].values.tolist() == [[8, 0]]
    assert got[got.doc_id.isna()].shard.nunique() == 1
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    assert sharding.shard_records(empty_docs).count() == 0


def test_mix_against_sql(docs):
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(mixing.OP4_SQL).df().sort_values("doc_id").reset_index(drop=True)
    got = mixing.mix_allocation(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got.equals(want.astype(got.dtypes.to_dict()))


def plain_targets(sizes, weights, share, most):
    """Reshare what lies above a cap until nothing does."""
    total, target, full = share * sum(sizes), [0.0] * len(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        for i in open_:
            target[i] = rest * weights[i] / sum(weights[j] for j in open_)
        above = {i for i in open_ if target[i] > most * sizes[i]}
        if not above:
            return [most * sizes[i] if i in full else target[i] for i in range(len(sizes))]
        full |= above


def test_mix_edges(edge_docs, empty_docs):
    got = mixing.mix_allocation(edge_docs).toPandas()
    assert len(got) == 15
    pdf = edge_docs.select("doc_id", "text", "source").toPandas()
    words = pdf.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)) if t else 0)
    by = words.groupby(pdf.source.fillna("\U0010ffff")).sum().sort_index()
    want = plain_targets(by.tolist(), [(3, 1, 2)[i % 3] for i in range(len(by))], 1.5, 2)
    have = got.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert sorted(round(x, 6) for x in want) == sorted(round(t, 6) for t in got.drop_duplicates(["source_size", "target"]).target)
    for size, row in have.iterrows():
        assert abs(row.taken - row.target) <= 2
    assert (got.taken <= 2 * got["size"]).all()
    assert mixing.mix_allocation(empty_docs).count() == 0 and mixing.mixed_documents(empty_docs).count() == 0


def test_mixed_documents(docs, edge_docs):
    taken = mixing.mix_allocation(docs).select("doc_id", "taken", "size").toPandas()
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    times = got.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    for key, words, size in taken.itertuples(index=False):
        assert times.get(key, 0) == int(words / size + 0.5)
    again = mixing.mixed_documents(docs)
    assert again.exceptAll(got).isEmpty()
    assert mixing.mixed_documents(edge_docs).columns == edge_docs.columns
