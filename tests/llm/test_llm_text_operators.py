"""HTML extraction, byte-level BPE, spot signatures and min-max dedup against plain versions."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from conftest import SF
from riskframe.llm import bpe_fst, components, line_blocks, minmax_dedup, queries, spotsigs

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, held_out string, score string, rank int"


def docs(spark, *texts, ids=None):
    rows = [(i if ids is None else ids[i], t, None, None, None, "x", "y", "z", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- HTML ---------------------------------------------------------------------------------------------------------------

PAGE = ('<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">A</a></li></ul></nav>'
        '<div class="ad">Buy</div>{}<div class="comments"><p>First!</p></div><aside>Side</aside><form>Name <input></form>'
        '<footer>&copy; x</footer></body></html>')
LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"


@pytest.mark.parametrize("body, text", [
    ("<article><h1>Head</h1><p><b>Bo</b>ld &amp; more\n\n text<br>next<p>x</article>", "Head Bold & more text next x"),
    (f"<div id='content'><h1>Head</h1><p>{LONG}</p><p>End.</p></div>", f"Head {LONG} End."),
    ("<article><header><h1>Inner head</h1></header><p>a &lt;b&gt; c</p></article>", "Inner head a <b> c"),
    ("<p>tiny</p>", "tiny"),
    ("", ""),
])
def test_main_text(body, text):
    assert line_blocks.main_text(PAGE.replace("{}", body)) == text


def test_unclosed_advert_ends_at_the_article():
    assert line_blocks.main_text('<body><div class="ad">Buy<article><p>Text</p></article>') == "Text"


def test_runs_surge_and_dive():
    assert line_blocks.runs_of_text([0, 5, 0, 7, 0, 0, 0, 9]) == [(1, 4, 12), (7, 8, 9)]


def test_extract_table(spark):
    pages = spark.createDataFrame([(2**60 + 1, "u", None, "old", 5), (None, None, "", None, None), (3, "u", "<p>a  b</p>", "", 1), (3, "u", "<p>a  b</p>", "", 1)],
                                  "page_id bigint, url string, html string, text string, n_chars int")
    out = line_blocks.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(2**60 + 1, "u", "", 0), (None, None, "", 0), (3, "u", "a b", 3), (3, "u", "a b", 3)], key=str)
    assert line_blocks.extract(pages.limit(0)).count() == 0


# --- BPE ----------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return bpe_fst.Codec(MULTI, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_fst.read_ranks(MULTI), special_tokens={})


def strange_texts(n):
    draw = random.Random(3)
    for _ in range(n):
        top = draw.choice([0x80, 0x800, 0x3000, 0x2100, 0x11000])
        points = (draw.randrange(top) for _ in range(draw.randrange(80)))
        yield "".join(chr(p) for p in points if not 0xD800 <= p < 0xE000)


def test_transducer_gives_the_merges(codec, reference_encoding):
    texts = [*strange_texts(400), "", " ", "a  b \n c", "\0 x", "x" * 3000, "ab" * 900 + "é" * 700, "The end.\n\nThe end."]
    for text in texts:
        ids = codec.encode(text)
        assert ids == reference_encoding.encode_ordinary(text)
        assert bpe_fst.stream_decode(ids, codec.fst.tokens.__getitem__) == text


def test_transducer_is_bounded(monkeypatch, reference_encoding):
    for name in ("MAX_STATES", "MAX_PAIRS", "MAX_WORDS"):
        monkeypatch.setattr(bpe_fst, name, 20)
    small = bpe_fst.Codec(MULTI, public_tokenizers.PATTERN)
    for text in strange_texts(60):
        assert small.encode(text) == reference_encoding.encode_ordinary(text)


def test_stream_decode_holds_back_unfinished_sequences():
    table = {i: bytes([b]) for i, b in enumerate("aé日𝄞".encode())} | {99: b"\xff"}
    assert bpe_fst.stream_decode(range(10), table.__getitem__) == "aé日𝄞"
    assert bpe_fst.stream_decode([1, 0, 99], table.__getitem__) == "�a�"


def test_bpe_tables(spark, reference_encoding):
    table = docs(spark, "Hello wörld", None, "", "Hello wörld", ids=[1, None, 3, 1])
    rows = bpe_fst.digests(table, MULTI).collect()
    ids = reference_encoding.encode_ordinary("Hello wörld")
    want = (1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256("Hello wörld".encode()).hexdigest())
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, rows), key=str) == sorted([want, want, (None, 0, nothing, nothing), (3, 0, nothing, nothing)], key=str)
    coded = bpe_fst.encode(table, MULTI)
    assert set(coded.columns) == set(table.columns)
    assert [r.text for r in bpe_fst.decode(coded, MULTI).orderBy("doc_id").collect()] == ["", "Hello wörld", "Hello wörld", ""]
    assert bpe_fst.digests(table.limit(0), MULTI).count() == 0


# --- spot signatures ----------------------------------------------------------------------------------------------------

def plain_signatures(text):
    words = ["".join(c for c in w if c.isalnum()) for w in text.lower().split()]
    words = [w for w in words if w]
    out = set()
    for i, word in enumerate(words):
        if word in spotsigs.COMMON:
            content = [w for w in words[i + 1:] if w not in spotsigs.COMMON][::spotsigs.DISTANCE][:spotsigs.CHAIN]
            if len(content) == spotsigs.CHAIN:
                out.add((word, *content))
    return out or ({tuple(words)} if words else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_comparison_with_edits(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in source}
    order = sorted(texts)
    rows = {r.doc_id: r for r in queries.QUERIES["op2_spotsigs_fingerprints"](spark, SF).collect()}
    assert sorted(rows) == order
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        row = rows[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert row.near_edited == pytest.approx(jaccard(plain_signatures(text), plain_signatures(changed)), abs=1e-6)
        assert row.near_next == pytest.approx(jaccard(plain_signatures(text), plain_signatures(after)), abs=1e-6)
    by_text = {}
    for i in order:
        assert by_text.setdefault(texts[i], rows[i].fingerprint) == rows[i].fingerprint


def test_runs_do_not_matter(spark, monkeypatch):
    table = docs(spark, *[f"the w{i} a b{i} c d e {i}" for i in range(40)])
    whole = {r.doc_id: tuple(r) for r in spotsigs.compare_with_edits(table).collect()}
    monkeypatch.setattr(spotsigs, "RUN_ROWS", 3)
    assert {r.doc_id: tuple(r) for r in spotsigs.compare_with_edits(table).collect()} == whole


def test_comparison_of_awkward_rows(spark):
    rows = spotsigs.compare_with_edits(docs(spark, None, "", "abcd", "abcd", ids=[5, None, 9, 9])).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == [(0, 0), (5, 0), (9, 4), (9, 4)]
    assert spotsigs.compare_with_edits(docs(spark, "x").limit(0)).count() == 0
    one = spotsigs.compare_with_edits(docs(spark, "abcd")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_similar_finds_all_pairs(spark):
    draw = random.Random(5)
    base = [" ".join(draw.choice(["the", "a", "of", *(f"w{draw.randrange(60)}" for _ in range(5))]) for _ in range(80)) for _ in range(6)]
    texts = []
    for text in base:
        for k in range(5):
            words = text.split()
            for _ in range(k):
                words[draw.randrange(len(words))] = f"n{draw.randrange(9)}"
            texts.append(" ".join(words))
    texts += [texts[0], "", None]
    pairs, members = spotsigs.similar(docs(spark, *texts), 0.6)
    classes = {r.doc_id: r["class"] for r in members.collect()}
    assert classes[30] == classes[0] and len(classes) == len(texts)
    sets = {i: plain_signatures(t or "") for i, t in enumerate(texts)}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and classes[a] == a and classes[b] == b and jaccard(sets[a], sets[b]) >= 0.6}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want


def test_pruned_likeness_agrees():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(draw.integers(0, 900, 700)) for _ in range(2))
        exact = spotsigs.likeness(a, b)
        assert spotsigs.pruned_likeness(a, b, 0.5) == pytest.approx(exact if exact >= 0.5 else 0.0)


# --- near-duplicates ----------------------------------------------------------------------------------------------------

def plain_components(texts):
    """texts by id; every pair of sets is compared."""
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().translate(minmax_dedup._LOWER).split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    component = {i: i for i in texts}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                component[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def chained(draw, n, words=60):
    """Texts in which neighbours are linked and far ones are not."""
    text = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        out.append(" ".join(text))
        text[draw.randrange(words)] = f"w{draw.randrange(10**6)}"
    return out


def test_components_equal_brute_force(spark):
    draw = random.Random(11)
    texts = [*chained(draw, 30), *chained(draw, 12, 25), "a b c", "A B  C", "a b c d", "", None, " \t\n", "ä b", "Ä b"]
    texts += [texts[3].upper(), texts[40] + " tail"]
    draw.shuffle(texts)
    rows = minmax_dedup.near_duplicates(docs(spark, *texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == plain_components(dict(enumerate(texts)))


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "BLOCK", 4)
    draw = random.Random(12)
    texts = dict(enumerate(chained(draw, 40, 50)))
    rows = minmax_dedup.near_duplicates(docs(spark, *texts.values())).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == plain_components(texts)


def test_dedup_of_awkward_rows(spark):
    table = docs(spark, "a b c d e f", "a b c d e f", "", "a b c d e f", ids=[7, None, 8, 7])
    rows = minmax_dedup.near_duplicates(table).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in rows) == [(0, 2, None, True), (7, 2, 7, True), (7, 2, 7, True), (8, 0, 8, True)]
    left = minmax_dedup.unique(table)
    assert left.columns == table.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 7, 8]
    assert minmax_dedup.near_duplicates(table.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (200, 200)], "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(51)} | {100: 100, 101: 100}
    assert components.components(links.limit(0)).count() == 0
