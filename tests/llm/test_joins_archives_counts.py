"""Ops 5, 6 and 9 and the pipeline against plain Python."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import chosenpath, components, langid, packing, queries, revisits, tokencounts

PAGE = "id long, url string, at long, revisit boolean, etag string, last_modified string, headers map<string,string>, digest string"


def plain_classes(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= threshold * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(top(i), []).append(key)
    named = {t: min((k for k in keys if k is not None), default=None) for t, keys in least.items()}
    return [(rows[i][0], named[top(i)], len(least[top(i)]), links[i]) for i in range(len(rows))]


def clean(values):
    return [tuple(None if pd.isna(x) else int(x) for x in r) for r in values]


@pytest.mark.parametrize("name", ["docs", "edge_docs"])
def test_classes_and_links(request, name):
    table = request.getfixturevalue(name)
    got = chosenpath.jaccard_classes(table).drop("rid").toPandas().astype("Int64")
    want = plain_classes([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])
    assert sorted(clean(got.values.tolist()), key=str) == sorted(want, key=str)


def near_copies(spark, groups, each, words=120, changed=2, seed=0):
    draw = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = [f"w{x}" for x in draw.integers(0, 5000, words)]
        for _ in range(each):
            text = list(base)
            for at in draw.choice(words, changed, replace=False):
                text[at] = f"c{draw.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("groups,each,small", [(60, 4, 128), (1, 240, 16), (5, 50, 8)])
def test_large_buckets_lose_no_link(spark, monkeypatch, groups, each, small):
    monkeypatch.setattr(chosenpath, "SMALL_BUCKET", small)
    monkeypatch.setattr(chosenpath, "TILE_RECORDS", 40)
    monkeypatch.setattr(chosenpath, "TILE_SKETCHES", 40)
    monkeypatch.setattr(chosenpath, "WHOLE_BUCKET", 60)
    rows = near_copies(spark, groups, each)
    got = chosenpath.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).drop("rid").toPandas()
    assert sorted(clean(got.values.tolist())) == sorted(plain_classes(rows))


def test_large_buckets_of_one_family_are_dealt_once(spark, monkeypatch):
    """What hangs together by the pivots is not split again, level by level, for the few records outside it."""
    monkeypatch.setattr(chosenpath, "SMALL_BUCKET", 16)
    made, real = [], chosenpath.materialize
    monkeypatch.setattr(chosenpath, "materialize", lambda df, name="step", **options: made.append(name) or real(df, name, **options))
    rows = near_copies(spark, 1, 240)
    shared = rows[0][1].split()[:70]
    rows += [(1000 + i, " ".join(shared + [f"s{i}x{j}" for j in range(50)])) for i in range(60)]
    got = chosenpath.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).drop("rid").toPandas()
    assert sorted(clean(got.values.tolist())) == sorted(plain_classes(rows))
    assert made.count("split") == 1 and "full-paths" not in made


@pytest.mark.parametrize("few", [0, 40, 512])
def test_rest_of_large_buckets_loses_no_link(spark, monkeypatch, few):
    """A family, texts that drift away from it one word at a time, and strangers that share a passage with it."""
    for name, value in {"SMALL_BUCKET": 16, "TILE_SKETCHES": 40, "WHOLE_BUCKET": 60, "FEW_OUTSIDE": few}.items():
        monkeypatch.setattr(chosenpath, name, value)
    rows = near_copies(spark, 1, 120)
    drift = rows[0][1].split()
    for i in range(80):
        drift[i] = f"d{i}"
        rows.append((len(rows), " ".join(drift)))
    shared = rows[0][1].split()[-70:]
    rows += [(1000 + i, " ".join([f"s{i // 2}x{j + i % 2}" for j in range(50)] + shared)) for i in range(60)]
    got = chosenpath.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).drop("rid").toPandas()
    assert sorted(clean(got.values.tolist())) == sorted(plain_classes(rows))


def test_members_of_the_next_level_are_made_once(spark, monkeypatch):
    """Buckets, small buckets, pieces and links of a level read its members; none of them splits the level before again."""
    monkeypatch.setattr(chosenpath, "SMALL_BUCKET", 16)
    monkeypatch.setattr(chosenpath, "FEW_OUTSIDE", 0)
    plans, real, hang = [], chosenpath.materialize, chosenpath.components
    plan = lambda name, df: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(chosenpath, "materialize", lambda df, name="step", **options: plan(name, df) or real(df, name, **options))
    monkeypatch.setattr(chosenpath, "components", lambda df: plan("components", df) or hang(df))
    rows = near_copies(spark, 1, 120)
    shared = rows[0][1].split()[-70:]
    rows += [(1000 + i, " ".join([f"s{i // 2}x{j + i % 2}" for j in range(50)] + shared)) for i in range(120)]
    got = chosenpath.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).drop("rid").toPandas()
    assert sorted(clean(got.values.tolist())) == sorted(plain_classes(rows))
    levels = sum(name == "split" for name, _ in plans)
    again = [name for name, text in plans for line in text.splitlines() if "Generate explode(paths" in line and "LeftAnti" in text]
    assert levels and again == ["members"] * levels


def test_rest_meets_pieces():
    draw = np.random.default_rng(3)
    main, other, alone = draw.integers(0, 2**32, (3, chosenpath.COORDINATES), np.uint32)
    half = np.where(np.arange(chosenpath.COORDINATES) < 44, main, other)  # may link to main, 0.69; not to other, 0.31
    row = lambda bucket, piece, rid, marks, rest: (bucket, piece, rid, marks.tobytes(), rest)
    rows = [
        row(1, 0, 10, half, True), row(1, 0, 11, half, True), row(1, 0, 12, other, True), row(1, 0, 13, alone, True), row(1, 0, 1, main, False), row(1, 0, 2, main, False),
        row(1, 1, 13, alone, True),  # a piece without any of the main family
    ]
    batch = pd.DataFrame(rows, columns=["bucket", "piece", "rid", "sketch", "rest"])
    found = pd.concat(chosenpath._compare_rest(iter([batch.iloc[:3], batch.iloc[3:]])))
    assert sorted(map(tuple, found.values.tolist())) == [(10, 1), (11, 1), (11, 10)]


def test_runs_and_recall():
    assert abs(chosenpath.recall_of_run(1) - (1 - np.exp(-1))) < 1e-12
    for depth in (1, 2, 3):
        runs = chosenpath.runs_needed(0.999, depth)
        assert (1 - chosenpath.recall_of_run(depth)) ** runs <= 0.001


def test_first_of_each_class(spark, docs, edge_docs, empty_docs):
    kept = chosenpath.first_of_each_class(docs)
    want = {c for _, c, _, _ in plain_classes([(r.doc_id, r.text) for r in docs.collect()])}
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    left = chosenpath.first_of_each_class(edge_docs).select("doc_id", "text").collect()
    assert sum(r.doc_id == 6 for r in left) == 1 and not any(r.doc_id == 7 for r in left) and len(left) == 13
    assert chosenpath.first_of_each_class(empty_docs).count() == 0


def test_components(spark):
    draw = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(70)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            root[max(top(a), top(b))] = min(top(a), top(b))
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    groups = {}
    for x in nodes:
        groups.setdefault(top(x), set()).add(got[x])
    assert set(got) == nodes and all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_revisits_against_sql(spark):
    con = duckdb.connect()
    con.sql("create view pages as select * from '/root/testdata/sf0.01/pages.parquet'")
    want = con.sql(revisits.OP5_SQL).df()
    got = queries.QUERIES["op5_warc_revisits"](spark, "/root/testdata/sf0.01").toPandas()[list(want.columns)]
    order = lambda x: sorted(map(tuple, x.astype(object).where(x.notna(), None).values.tolist()), key=str)
    assert order(got) == order(want)


def test_revisit_cases(spark):
    h = {"Content-Length": "9", "Server": "a", "Date": "1"}
    rows = [
        (1, "https://www.Example.com:443/a/?b=2&utm_x=1&a=1#top", 10, False, '"t1"', "m1", h, "d1"),
        (2, "http://example.com/a?a=1&b=2", 20, True, 'W/"t1"', None, {"date": "2", "content-length": "0"}, None),
        (3, "http://example.com/a?a=1&b=2", 30, False, '"t2"', "m2", None, "d2"),
        (4, "http://example.com/a?a=1&b=2", 30, True, '"t1"', None, None, None),  # the response at 30 is not earlier
        (5, "http://example.com/a?a=1&b=2", 40, True, '"t1"', "m2", {}, None),  # tags differ
        (6, "http://example.com/a?a=1&b=2", 41, True, None, "m2", {"X": "y"}, None),
        (7, "http://example.com/a?a=1&b=2", 5, True, '"t1"', None, {}, None),  # nothing earlier
        (8, None, 50, True, None, None, {}, None),
        (9, "http://example.com/other", 50, True, None, None, {}, None),
        (10, "http://example.com/a?a=1&b=2", None, True, None, None, {}, None),
        (6, "http://example.com/a?a=1&b=2", 41, True, None, "m2", {"X": "y"}, None),
    ]
    got = revisits.resolve_revisits(spark.createDataFrame(rows, PAGE).withColumn("row", F.lit("clash")).repartition(4))
    by = {}
    for r in got.collect():
        by.setdefault(r.id, []).append((r.outcome, r.refers_to, r.digest, r.headers))
    assert by[2] == [("resolved", 1, "d1", {"Content-Length": "9", "Server": "a", "Date": "1", "date": "2"})] or by[2][0][:3] == ("resolved", 1, "d1")
    assert by[4][0][:3] == ("resolved", 1, "d1") and by[5][0][:3] == ("validator mismatch", 3, None)
    assert by[6] == [("resolved", 3, "d2", {"X": "y"})] * 2
    assert [by[i][0][0] for i in (7, 8, 9, 10)] == ["no earlier response"] * 4
    assert revisits.resolve_revisits(spark.createDataFrame([], PAGE)).count() == 0


def test_hot_url_is_cut_by_time(spark, monkeypatch):
    monkeypatch.setattr(revisits, "TIME_RANGES", 7)
    rows = [(i, "http://hot/", i // 2, i % 3 != 0, None, None, None, f"d{i}") for i in range(200)]
    got = {r.id: r.refers_to for r in revisits.resolve_revisits(spark.createDataFrame(rows, PAGE)).collect()}
    for i, _, at, revisit, *_ in rows:
        if revisit:
            assert got[i] == max(((a, j) for j, _, a, r, *_ in rows if not r and a < at), default=(0, None))[1]


def plain_rollup(counts):
    first = counts.groupby("digest").doc_id.transform("min")
    total = {}

    def add(row, tokenizer, documents, tokens):
        at = total.setdefault((row.source, row.lang, tokenizer), [0, 0])
        at[0] += documents
        at[1] += tokens

    for row, least in zip(counts.itertuples(), first):
        if row.doc_id is not None and row.doc_id > least:
            continue
        add(row, "byte_bpe_50k", 1, row.revised_tokens)
        add(row, "word_bpe_49k", 1, row.word_tokens)
    return {(*k, *v) for k, v in total.items() if any(v)}


def test_rollup_against_plain(spark, docs):
    got = {tuple(r) for r in queries.QUERIES["op6_token_rollup"](spark, "/root/testdata/sf0.001").select("source", "lang", "tokenizer", "documents", "tokens").collect()}
    counts = tokencounts.token_counts(docs).toPandas()
    encoder = tokencounts.byte_encoder(tokencounts.__dict__.get("RANK_PATH") or __import__("public_tokenizers").path(tokencounts.RANKS))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in counts.itertuples():
        assert row.byte_tokens == len(encoder.encode_ordinary(texts[row.doc_id]))
        assert row.revised_tokens == len(encoder.encode_ordinary(tokencounts.squeezed(texts[row.doc_id])))
    assert got == plain_rollup(counts)


def test_store_commits_once(spark, tmp_path, edge_docs, empty_docs):
    store = tokencounts.TokenStore(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    kind = "kind string, source string, lang string, tokenizer string, tokens long, old_tokens long"
    rows = [("insert", "a", "en", "t", 5, None), ("insert", "a", "en", "t", 7, None), ("insert", None, None, "t", None, None), ("delete", "a", "en", "t", 5, None), ("revise", "a", "en", "t", 9, 7)]
    assert store.commit("b1", spark.createDataFrame(rows, kind)) and not store.commit("b1", spark.createDataFrame(rows, kind))
    want = {("a", "en", "t", 1, 9), (None, None, "t", 1, 0)}
    assert set(map(tuple, store.totals().collect())) == want
    # A writer that died before its commit leaves an attempt that does not count.
    lost = spark.createDataFrame([("a", "en", "t", 100, 100, "lost")], f"{tokencounts.DELTA_TYPE}, attempt string")
    lost.write.mode("append").partitionBy("attempt").parquet(f"{store.path}/attempts")
    assert set(map(tuple, store.totals().collect())) == want
    assert store.commit("empty", spark.createDataFrame([], kind)) and not store.commit("empty", spark.createDataFrame([], kind))
    again = tokencounts.TokenStore(spark, store.path)
    assert again.commit("b2", spark.createDataFrame([("delete", "a", "en", "t", 9, None)], kind)) and set(map(tuple, again.totals().collect())) == {(None, None, "t", 1, 0)}
    with pytest.raises(Exception, match="unknown kind"):
        again.commit("b3", spark.createDataFrame([("upsert", "a", "en", "t", 9, None)], kind))
    counts = tokencounts.token_counts(edge_docs)
    assert counts.count() == 15 and tokencounts.token_counts(empty_docs).count() == 0
    for name, changes in tokencounts.batches_of(counts).items():
        assert again.commit(f"edge-{name}", changes)


def test_folds_stand_for_batches(spark, tmp_path):
    kind = "kind string, source string, lang string, tokenizer string, tokens long, old_tokens long"
    store = tokencounts.TokenStore(spark, str(tmp_path / "store"))
    batch = lambda n: spark.createDataFrame([("insert", "a", "en", "t", n, None), ("insert", "b", None, "t", 1, None)], kind)
    for i in range(3):
        store.commit(f"b{i}", batch(10 + i))
    want = set(map(tuple, store.totals().collect()))
    assert want == {("a", "en", "t", 3, 33), ("b", None, "t", 3, 3)}
    store.fold()
    assert set(map(tuple, store.totals().collect())) == want and store._counting().count() == 1
    assert not store.commit("b1", batch(99)) and store.commit("b3", batch(7))
    # A fold that died before its row leaves an attempt that does not count.
    store._written(store.totals())
    assert ("a", "en", "t", 4, 40) in set(map(tuple, store.totals().collect()))
    store.fold()
    assert store.clean() == 6 and store.clean() == 0
    assert set(map(tuple, tokencounts.TokenStore(spark, store.path).totals().collect())) == {("a", "en", "t", 4, 40), ("b", None, "t", 4, 4)}


def test_pipeline_stages(spark, docs, empty_docs, edge_docs):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    before = table
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf)
        if name != "packing":
            assert after.columns == table.columns, name
            after = corpus_pipeline.materialize(after, name)
        if name in ("toxicity", "language", "near_copies"):
            assert after.join(before, "doc_id", "left_anti").isEmpty() and 0 < after.count() <= before.count()
        if name == "toxicity":
            clean_ids = spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0").join(table, "doc_id").count()
            assert after.join(spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0"), "doc_id").count() >= 0.97 * clean_ids
        if name == "language":
            assert after.count() >= 0.99 * before.count()
        if name == "near_copies":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c, _, _ in plain_classes(rows)})
        before = after
    assert before.select("sequence_id").distinct().count() <= before.agg(F.sum("length")).first()[0] / packing.CAPACITY * 1.01 + 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_docs, sf).count() == 0
    odd = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        odd = corpus_pipeline.materialize(stage(spark, odd, sf), name)
        assert odd.columns == edge_docs.columns
    assert odd.where(F.col("text").isNull()).isEmpty() and langid.UNDETERMINED == "und"


def test_near_copies_with_missing_and_repeated_keys(spark):
    """Rows without a key, and rows that share one, are linked like any others, and only what stands for a class stays."""
    words = [[f"g{g}w{i}" for i in range(100)] for g in range(4)]
    near = [" ".join(w[:-1] + ["other"]) for w in words]
    base = [" ".join(w) for w in words]
    rows = [
        (None, base[0]), (None, near[0]), (None, near[0]),  # no key in the class
        (5, base[1]), (None, near[1]), (None, near[1]),  # a keyed row stands for rows without key
        (7, near[1]),  # a copy of 5 ...
        (7, base[2]), (9, near[2]),  # ... whose key names a class of its own
        (8, base[3]), (8, near[3]),  # a shared key, different texts
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = chosenpath.jaccard_classes(table).select("class_id", "class_size", "links").collect()
    want = [(None, 3, 2)] * 3 + [(5, 4, 3)] * 4 + [(7, 2, 1)] * 2 + [(8, 2, 1)] * 2
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    left = [tuple(r) for r in chosenpath.first_of_each_class(table).collect()]
    assert len([x for x in left if x[0] is None]) == 1 and next(x for x in left if x[0] is None)[1] in (base[0], near[0])
    assert sorted(x for x in left if x[0] is not None) == sorted([(5, base[1]), (7, base[2]), (8, base[3]), (8, near[3])])
