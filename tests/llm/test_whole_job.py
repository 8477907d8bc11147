"""Operators do their whole job: nothing is left out for cost."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import bm25_packing, line_blocks, shuffle_shards

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], DOCS)


# --- sharding -----------------------------------------------------------------------------------------------------------

def test_placement_tells_what_the_shards_on_disk_hold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shuffle_shards, "working_dir", lambda _: str(tmp_path), raising=False)
    texts = {i: f"text {i} é" * (i % 7) for i in range(300)}
    told = {r.doc_id: r for r in shuffle_shards.placement(docs(spark, texts.items())).collect()}
    paths = list(tmp_path.glob("llm/*/shards"))
    assert len(paths) == 1
    held = spark.read.parquet(str(paths[0])).collect()
    assert len(held) == len(told) == 300
    for r in held:
        t = told[r.doc_id]
        assert (r.text, r.lang) == (texts[r.doc_id], "en") and (t.shard, t.slot) == (r.shard, r.slot)
        assert (t.size, t.text_crc32) == (len(r.text.encode()) + 1, zlib.crc32(r.text.encode()))


def test_no_bucket_outgrows_memory(spark):
    def largest(rows, **bounds):
        out = shuffle_shards.external_shuffle(docs(spark, rows), "doc_id", 4, **bounds).withColumn("p", F.spark_partition_id()).toPandas()
        assert sorted(zip(out["doc_id"], out["text"])) == sorted(rows)
        counts = out.groupby("shard")["slot"].agg(["count", "max"])
        assert counts["count"].max() - counts["count"].min() <= 1 and (counts["max"] == counts["count"] - 1).all()
        return out.groupby("p").agg(n=("text", "size"), b=("text", lambda t: t.str.len().sum())).max()

    one_key = [(1, f"text {i}") for i in range(400)]
    assert largest(one_key, bucket_rows=40)["n"] <= 80
    copies = [(1, "same")] * 3000 + [(i, "other") for i in range(2, 30)]
    assert largest(copies, bucket_rows=300)["n"] <= 450
    long = [(i, "x" * 1000) for i in range(200)]
    assert largest(long, bucket_bytes=20_000)["b"] <= 45_000


# --- packing ------------------------------------------------------------------------------------------------------------

def bm25_case(n=60, vocabulary=400):
    draw = np.random.default_rng(3)
    ids = [draw.integers(0, vocabulary, draw.integers(60, 200)) for _ in range(n)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=vocabulary)
    return ids, np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), float(np.mean([len(x) for x in ids]))


def brute_bm25(ids, idf, mean, seed):
    """BM25 of every document for every distinct id of the seed, none cut."""
    return np.array([sum(idf[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t in np.unique(ids[seed]) if (c := (x == t).sum())) for x in ids])


def test_every_term_of_a_seed_counts():
    ids, idf, mean = bm25_case()
    shard = bm25_packing.Shard(ids, idf, mean)
    unused = np.arange(len(ids)) % 3 > 0
    for seed in range(0, 60, 4):
        assert len(np.unique(ids[seed])) > 24
        assert np.allclose(shard.scores(seed), brute_bm25(ids, idf, mean, seed), rtol=1e-4)
    shard.drop(unused)
    for seed in (0, 1, 2):
        assert np.allclose(shard.scores(seed)[unused], brute_bm25(ids, idf, mean, seed)[unused], rtol=1e-4)


def test_a_window_takes_the_neighbours_by_all_terms():
    ids, idf, mean = bm25_case()
    unused, seed = set(range(1, len(ids))), 0
    pieces = list(bm25_packing.pack_shard(ids, idf, mean, window=600))
    for sequence in range(pieces[-1][3] - 1):
        taken = [d for d, start, _, s, _ in pieces if s == sequence and d != seed and start == 0]
        scores = brute_bm25(ids, idf, mean, seed)
        assert taken == sorted(unused, key=lambda d: -scores[d])[:len(taken)]
        unused -= set(taken)
        seed = next(d for d, *_ , s, offset in pieces if s == sequence + 1 and offset == 0)
        unused.discard(seed)


# --- HTML ---------------------------------------------------------------------------------------------------------------

LONG = "This paragraph is long enough to make the distribution surge, since it has well over eighty characters of text."
AD = '<div class="ad"><p>Buy</p></div>'


@pytest.mark.parametrize("body, text", [
    # short paragraphs around and between adverts
    (f"<p>{LONG}</p>{AD}<p>Short one.</p>{AD}<p>{LONG}</p>{AD}<p>The end.</p>", f"{LONG} Short one. {LONG} The end."),
    # a paragraph that is mostly a link, inside text; a menu before it
    (f'<div><a href="/">Home page of all</a></div><p>{LONG}</p><p>See <a href="/x">a very long link text</a></p><p>{LONG}</p>', f"{LONG} See a very long link text {LONG}"),
    # an article mark somewhere does not discard the text outside
    (f"<article><p>Card</p></article><div><p>{LONG}</p></div>", f"Card {LONG}"),
    # articles inside closed asides and comment blocks stay cut
    (f"<p>{LONG}</p><aside><article><p>Teaser</p></article></aside>", LONG),
    (f'<article><p>{LONG}</p></article><div class="comments"><article><p>First! {LONG}</p></article></div>', LONG),
])
def test_the_distribution_chooses_the_text(body, text):
    assert line_blocks.main_text(f"<html><body><nav><a href='/'>A</a></nav>{body}<footer>x</footer></body></html>") == text


def test_unmarked_pages(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    same = 0
    for page in pages:
        bare = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert bare != page
        same += line_blocks.main_text(bare) == line_blocks.main_text(page)
    assert same >= 0.95 * len(pages)
