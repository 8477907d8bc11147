"""Search, sharding, packing, the trained operators and the pipeline."""

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF
from riskframe.llm import bm25_packing, byte_rnn, cotraining, multi_index, queries, shuffle_shards, tfidf_toxicity

GPT = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, slot string, held_out string, score string"


def docs(spark, *texts, ids=None, lang="en"):
    rows = [(i if ids is None else ids[i], t, lang, None, None, 1, "s", "h", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- search -------------------------------------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")


def brute(rows, query, k):
    q = np.asarray(rows[query], np.float32).astype(float)
    near = sorted(((-(np.asarray(v, np.float32).astype(float) * q).sum(), i) for i, v in rows.items() if i != query))
    return [(i, -s) for s, i in near[:k]]


def test_search_meets_its_recall(spark):
    found = queries.QUERIES["op1_inverted_multi_index"](spark, SF).toPandas()
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    hits = total = 0
    for q, near in found.groupby("query_id"):
        near = near.sort_values("rank")
        want = brute(rows, q, 20)
        assert near["rank"].tolist() == list(range(1, len(want) + 1)) and q not in set(near["vec_id"])
        scores = {i: s for i, s in brute(rows, q, len(rows))}
        assert near["score"].tolist() == pytest.approx([scores[i] for i in near["vec_id"]], abs=1e-12)
        hits, total = hits + len({i for i, _ in want} & set(near["vec_id"])), total + len(want)
    assert set(found["query_id"]) == {i for i in rows if i % 20 == 0}
    assert hits / total >= 0.9


def test_search_with_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 8)
    monkeypatch.setattr(multi_index, "CHUNK_ROWS", 2)
    monkeypatch.setattr(multi_index, "RECALL", 1.0)
    draw = np.random.default_rng(0)
    rows = {i: draw.normal(size=6).round(2).tolist() for i in range(60)}
    rows |= {i: [1.0, 2.0, 0.0, 0.0, -1.0, 0.5] for i in range(60, 130)}
    bad = [(200, None), (220, [0.0] * 6), (240, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (260, [float("nan")] * 6), (280, [float("inf")] + [0.0] * 5), (300, [1.0]), (None, [1.0] * 6)]
    table = vectors(spark, [(i, v, 0) for i, v in [*rows.items(), *bad]] + [(0, rows[0], 0)])
    found = multi_index.search(table, F.col("vec_id") % 20 == 0, k=5).toPandas()
    for q in range(0, 130, 20):
        near = found[found["query_id"] == q].sort_values("rank")
        want = brute(rows, q, 5)
        assert near["vec_id"].tolist() == [i for i, _ in want]
        assert near["score"].tolist() == pytest.approx([s for _, s in want])
    assert set(found["query_id"]) == set(range(0, 130, 20))


def test_search_of_few_vectors(spark):
    table = vectors(spark, [(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (20, [0.0, 1.0], 0)])
    found = multi_index.search(table, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert multi_index.search(table.limit(0), F.lit(True)).count() == 0
    assert multi_index.search(table.limit(1), F.lit(True)).count() == 0


def test_walk_is_in_order():
    draw = np.random.default_rng(4)
    first, second, counts = draw.normal(size=7), draw.normal(size=5), draw.integers(0, 3, 35)
    order = multi_index.walk(first, second, counts, int(counts.sum()))
    sums = (first[:, None] + second).ravel()
    assert sorted(order) == np.flatnonzero(counts).tolist() and (np.diff(sums[order]) <= 1e-12).all()
    assert counts[multi_index.walk(first, second, counts, 6)].sum() >= 6


# --- sharding -----------------------------------------------------------------------------------------------------------

def test_placement(spark, monkeypatch):
    monkeypatch.setattr(shuffle_shards, "BUCKET_ROWS", 16)
    texts = [None, "", "é", *[f"text {i}" for i in range(200)], "text 1"]
    rows = shuffle_shards.placement(docs(spark, *texts)).toPandas()
    sizes = rows.groupby("shard")["slot"].agg(["count", "min", "max"])
    assert sizes["count"].max() - sizes["count"].min() <= 1 and len(sizes) == 8
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["count"] - 1).all()
    assert not rows.duplicated(["shard", "slot"]).any() and sorted(rows["doc_id"]) == list(range(len(texts)))
    for r in rows.itertuples():
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "rows")
    assert rows["grown_shard"].isna().all()


def test_shuffle_mixes_and_depends_on_the_seed(spark):
    table = docs(spark, *map(str, range(400)))
    orders = [[r.doc_id for r in shuffle_shards.external_shuffle(table, "doc_id", 1, seed, 32).orderBy("slot").collect()] for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2]
    assert abs(np.corrcoef(orders[0], range(400))[0, 1]) < 0.2


def test_shards_on_disk(spark, tmp_path):
    table = docs(spark, *map(str, range(50)), None, ids=[*range(50), None])
    shuffle_shards.write_shards(table, str(tmp_path / "shards"), "doc_id", 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 51 and back.groupBy("shard").count().agg(F.max("count") - F.min("count")).first()[0] <= 1
    assert shuffle_shards.placement(table.limit(0)).count() == 0


# --- packing ------------------------------------------------------------------------------------------------------------

def check_packing(rows: pd.DataFrame, texts: dict, window=2048):
    tokenizer = Tokenizer.from_file(GPT)
    for i, own in rows.groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1], "<u4")
        own = own.sort_values("start")
        assert own["start"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() == len(ids)
        assert (own["doc_tokens"] == len(ids)).all() and (own["length"] > 0).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= window
    assert set(rows["doc_id"]) == set(texts)


def test_packing_of_whole_table(spark):
    rows = queries.QUERIES["op10_bm25_packing"](spark, SF).toPandas()
    check_packing(rows, {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()})
    fill = rows.groupby("sequence_id")["length"].sum()
    assert (fill < 2048).sum() <= 4  # one open sequence for each of the four partitions


def test_packing_of_awkward_rows(spark):
    texts = {0: None, 1: "", 2: "word " * 5000, 3: "<|endoftext|> a", 4: "same", 5: "same"}
    check_packing(bm25_packing.pack(docs(spark, *texts.values()), GPT).toPandas(), texts)
    twice = bm25_packing.pack(docs(spark, "x", "x", "y", ids=[1, 1, None]), GPT).toPandas()
    assert len(twice) == 3 and twice["doc_id"].isna().sum() == 1
    assert bm25_packing.pack(docs(spark, "x").limit(0), GPT).count() == 0


def test_index_returns_the_bm25_neighbours():
    draw = np.random.default_rng(2)
    ids = [draw.integers(0, 300, draw.integers(5, 60)) for _ in range(40)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=300)
    idf, mean = np.log1p((40 - df + 0.5) / (df + 0.5)).astype(np.float32), np.mean([len(x) for x in ids])
    shard = bm25_packing.Shard(ids, idf, mean)
    for d in range(40):
        terms, tf = np.unique(ids[d], return_counts=True)
        own = idf[terms] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ids[d]) / mean))
        query = terms[np.argsort(-own)[:bm25_packing.QUERY_TERMS]] if len(terms) > bm25_packing.QUERY_TERMS else terms
        want = [sum(idf[t] * (c := (x == t).sum()) * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t in query) for x in ids]
        assert np.allclose(sorted(shard.scores(d)), sorted(want), rtol=1e-4, atol=1e-4) or len(set(own)) < len(own)


def test_a_seed_is_followed_by_its_neighbour():
    about = [np.repeat(np.arange(k * 50, k * 50 + 10), 3) for k in range(5)]
    ids = [*about, *[x + 0 for x in about[::-1]]]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=300)
    idf = np.log1p((10 - df + 0.5) / (df + 0.5)).astype(np.float32)
    pieces = list(bm25_packing.pack_shard(ids, idf, 30.0, window=60))
    assert [(d, s) for d, _, _, s, _ in pieces] == [(0, 0), (9, 0), (1, 1), (8, 1), (2, 2), (7, 2), (3, 3), (6, 3), (4, 4), (5, 4)]


# --- language -----------------------------------------------------------------------------------------------------------

def test_gradients():
    net = byte_rnn.Network(["a", "b"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y = np.frombuffer(b"abcxyzdefabb", np.uint8).reshape(4, 3), np.array([0, 1, 0, 1])
    _, grad = net.gradients(x, y)
    for name, at in (("u", (0, 1, 2)), ("u", (1, 3, 40)), ("x", (0, 97, 5)), ("x", (1, 120, 40)), ("o", (1, 2, 1)), ("b", (1,))):
        kept, ends = net.w[name][at], []
        for move in (1e-5, -1e-5):
            net.w[name][at] = kept + move
            ends.append(net.gradients(x, y)[0])
        net.w[name][at] = kept
        assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(grad[name][at], rel=1e-2, abs=1e-5)


def test_language_of_held_out_rows(spark):
    rows = queries.QUERIES["op6_byte_rnn_language"](spark, SF).toPandas()
    source = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(source, on="doc_id")
    held = both[both["held_out"]]
    assert (held["held_out"] == held["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all() and len(both) == len(source)
    assert (held["lang_pred"] == held["lang"]).mean() >= 0.95 and both["score"].between(0, 1).all()


def test_language_of_awkward_rows(spark):
    table = docs(spark, None, "", "123 !?", "the house and the tree", "x" * 500, ids=[1, 2, 3, 4, None])
    out = byte_rnn.identify(table, keep=True)
    assert set(out.columns) == {*table.columns, "lang_pred"}
    assert {r.doc_id: r.lang_pred for r in out.collect()} == {1: "und", 2: "und", 3: "und", 4: "en", None: "en"}
    assert {r.lang_pred for r in byte_rnn.identify(docs(spark, "abc", lang=None)).collect()} == {"und"}
    assert byte_rnn.identify(table.limit(0)).count() == 0


def test_words_are_read_once_and_alone():
    net = byte_rnn.fit([("a", "foo", 3), ("b", "bar", 2)], steps=30)
    together, alone = byte_rnn.Labeller(net).pooled(["foo bar foo"]), byte_rnn.Labeller(net).pooled(["foo", "bar"])
    assert together[0] == pytest.approx((2 * alone[0] + alone[1]) / 3, abs=1e-6)


# --- quality and toxicity -----------------------------------------------------------------------------------------------

def test_quality_of_held_out_rows(spark):
    rows = queries.QUERIES["op7_cotraining_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = rows[rows["held_out"]].merge(labels, on="doc_id")
    good = held["quality"] == 1
    assert held["predicted"][good].mean() >= 0.95 and held["predicted"][~good].mean() <= 0.3 and rows["score"].between(0, 1).all()


def test_views_teach_each_other():
    draw = np.random.default_rng(0)
    y = draw.integers(0, 2, 400).astype(float)
    x = tuple(np.stack([y * 3 + draw.normal(size=400), draw.normal(size=400)], 1) for _ in range(2))
    truth = draw.integers(0, 2, 600)
    pool = tuple(np.stack([truth * 3 + draw.normal(size=600), draw.normal(size=600)], 1) for _ in range(2))
    model = cotraining.CoTrained(x, y, np.ones(400), pool, np.arange(400) % 3 == 0)
    both, first, second = model(pool)
    right = [((p >= 0.5) == truth).mean() for p in (both, first, second)]
    assert model.handed > 50 and right[0] >= max(right[1:]) - 0.01 and right[0] > 0.95


@pytest.mark.parametrize("operator", [cotraining.score, tfidf_toxicity.score])
def test_scores_of_awkward_rows(spark, operator):
    label = "quality" if operator is cotraining.score else "toxic"
    table = docs(spark, *(f"good words here {i}" if i % 2 else "bad bad bad | bad" for i in range(60)), None, "", ids=[*range(60), None, 61])
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(60)] + [(None, 1, "x"), (3, None, "x"), (999, 1, "x")], f"doc_id bigint, {label} int, score string")
    rows = operator(table, labels).collect()
    assert len(rows) == 62 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 60]
    assert all(r.predicted == r.doc_id % 2 for r in known)
    assert operator(table.limit(0), labels).count() == 0
    assert operator(table, labels.limit(0)).count() == 62


def test_nearest_equal_brute_force():
    draw = np.random.default_rng(6)
    def vector():
        terms = np.sort(draw.choice(40, draw.integers(1, 8), replace=False))
        weights = draw.integers(1, 4, len(terms)).astype(float)
        return terms, weights / np.sqrt(weights @ weights)
    examples = [vector() for _ in range(700)]
    index = tfidf_toxicity.BlockMaxIndex(examples, 40)
    dense = np.zeros((700, 40))
    for i, (t, w) in enumerate(examples):
        dense[i, t] = w
    for _ in range(60):
        t, w = vector()
        q = np.zeros(40)
        q[t] = w
        cosine = dense @ q
        ids, scores = index.nearest(t, w, 25)
        want = np.sort(cosine[cosine > 0])[::-1][:25]
        assert scores == pytest.approx(want) and cosine[ids] == pytest.approx(scores)
        assert 3 not in index.nearest(*examples[3], 25, without=3)[0]


def test_toxicity_of_held_out_rows(spark):
    rows = queries.QUERIES["op8_tfidf_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = rows[rows["held_out"]].merge(labels, on="doc_id")
    toxic = held["toxic"] == 1
    assert held["predicted"][toxic].mean() >= 0.85 and held["predicted"][~toxic].mean() <= 0.03
    assert abs(held["score"].mean() - toxic.mean()) < 0.03


# --- pipeline -----------------------------------------------------------------------------------------------------------

def test_pipeline(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {tuple(r) for r in kept.collect()}
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == source.columns and {tuple(r) for r in kept.collect()} <= before
    rows = corpus_pipeline.run(spark, SF).toPandas()
    check_packing(rows, {r.doc_id: r.text for r in kept.collect()})
