"""Vector codes, chat formatting and the dataset manifest."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from riskframe.llm import chat_masks, grid_codes, merkle_manifest

GPT = public_tokenizers.path("byte_bpe_50k.json")


# --- vector codes -------------------------------------------------------------------------------------------------------

def plain_codes(rows, parts, entries, rounds):
    """Full search in numpy over rows (key, label, integers)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[2]))
    data = np.array([q for _, _, q in rows], np.int64).reshape(len(rows), parts, -1)
    books = data[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        distance = ((data[:, :, None, :] - books[None]) ** 2).sum(3)
        at = distance.argmin(2)
        if k < rounds:
            for p in range(parts):
                for j in np.unique(at[:, p]):
                    books[p, j] = data[at[:, p] == j, p].sum(0) // (at[:, p] == j).sum()
    errors = distance.min(2).sum(1)
    total = {}
    for (_, label, _), e in zip(rows, errors.tolist()):
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted((str(key), "".join(f"{j:02x}" for j in codes), e, total[label], digest)
                  for (key, label, _), codes, e in zip(rows, at.tolist(), errors.tolist()))


def found_codes(frame, **how):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in grid_codes.compress(frame, **how).collect())


VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error bigint, `of` int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], VECTORS)


def test_codes_equal_a_full_search(spark):
    draw = np.random.default_rng(5)
    # coarse values make ties between entries; unequal spreads make cells of different use
    rows = [(i, [float(x) for x in (draw.normal(size=8) * [1, 1, 4, 4, .1, .1, 9, 9]).round(1)], int(draw.integers(3))) for i in range(300)]
    rows = [(i, v, None if label == 2 else label) for i, v, label in rows] + [(i + 300, rows[7][1], 0) for i in range(150)]
    rows += [(rows[3][0], rows[3][1], 1), (None, rows[4][1], 0)]
    want = plain_codes([(i, label, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v, label in rows], 4, 16, 2)
    assert found_codes(vectors(spark, rows), parts=4, entries=16) == want


def test_unusable_vectors_have_no_code(spark):
    good = [(i, [i / 8, -i / 4, 0.001, -0.001], 1) for i in range(5)]
    bad = [(10, None, 1), (11, [1.0, None, 1.0, 1.0], 1), (12, [float("nan")] * 4, 1), (13, [1.0, float("inf"), 0.0, 0.0], 1), (14, [1.0], 1), (15, [], 1)]
    found = found_codes(vectors(spark, good + bad), parts=2)
    assert found == plain_codes([(i, 1, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v, _ in good], 2, 64, 2)
    assert found_codes(vectors(spark, bad[:1])) == []
    assert [r[1:4] for r in found_codes(vectors(spark, [(1, [], 1)]), parts=2)] == [("0000", 0, 0)]


def test_lengths_that_the_parts_do_not_divide_are_filled(spark):
    rows = [(i, [i / 4, 1.0, i * 0.5], 0) for i in range(6)]
    want = plain_codes([(i, 0, [int(256 * x) for x in v] + [0]) for i, v, _ in rows], 2, 4, 1)
    assert found_codes(vectors(spark, rows), parts=2, entries=4, rounds=1) == want
    with pytest.raises(ValueError):
        grid_codes.compress(vectors(spark, rows), entries=257)
    with pytest.raises(Exception, match="too large"):
        grid_codes.compress(vectors(spark, [(0, [1e9] * 16, 0)])).collect()


def test_cells_leave_entries_out_and_are_worked_out_once(monkeypatch):
    draw = np.random.default_rng(1)
    book, parts = draw.integers(-100, 100, (64, 4)), draw.integers(-120, 120, (5000, 4))
    grid, worked = grid_codes.Grid(book), []
    candidates = grid.candidates
    monkeypatch.setattr(grid, "candidates", lambda cells: worked.append(len(cells)) or candidates(cells))
    at, distance = grid.nearest(parts)
    full = ((parts[:, None] - book) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert grid.open.mean() < 0.5
    before = sum(worked)
    assert (grid.nearest(parts)[0] == at).all() and sum(worked) == before
    monkeypatch.setattr(grid_codes, "MAX_CELLS", 50)  # a full memo starts anew
    assert (grid.nearest(parts)[0] == at).all()


def test_decoded_vectors_are_near(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.normal(size=8)], 0) for i in range(200)]
    frame, length = grid_codes.usable(vectors(spark, rows), "vec_id", "embedding", "label")
    books = grid_codes.fit(frame, length, 4, 32)
    codes = {r.key: r.code for r in grid_codes.encode(frame, books).collect()}
    off = np.array([grid_codes.decode(codes[i], books) - v for i, v, _ in rows])
    assert (off ** 2).mean() < 0.3  # about 1 for a constant


# --- chat formatting ----------------------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, segment int, ids string"


def plain_chat(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn, role or "", text or "", role))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = set()
    for conv, turns in out.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        learned = "".join(t for *_, t, role in turns if role == "assistant")
        found.add((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t, _ in turns)), len(learned), sha(learned)))
    return found


def chat(spark, rows):
    frame = spark.createDataFrame([(*r, 3, "x") for r in rows], TURNS)
    rendered = chat_masks.render(frame, GPT)
    return rendered, {tuple(r)[:5] for r in chat_masks.read_back(rendered, GPT).collect()}


AWKWARD = [
    (1, 1, "assistant", " <s> </s>\n[INST][/INST]<\\s>[\\\\INST]<|endoftext|> "), (1, 0, "user", "hi"), (1, 2, "assistant", ""),
    (1, 3, "assistant", None), (1, None, "system", "first"), (1, 4, None, "no role"), (1, 5, "assistant", "日本語 ǆ 🙂🙂"), (1, 5, "assistant", "日本語 ǆ 🙂🙂"),
    (2, 0, "[INST]user</s>", "<"), (2, 1, "assistant", "/s>"), (None, 0, "user", None), (None, None, "assistant", "no key"), (3, 0, "assistant", "\\" * 9 + "<" + "\\" * 9 + "/s>"),
]


def test_turns_and_learned_text_come_back(spark):
    _, found = chat(spark, AWKWARD)
    assert found == plain_chat(AWKWARD)
    assert chat(spark, [])[1] == set()


def test_ids_are_those_of_one_encoding_of_the_whole(spark, monkeypatch):
    rows = [(7, i, ["user", "assistant"][i % 2], f"text {i} </s> 🙂 " * 20) for i in range(40)] + AWKWARD
    whole = {r.conv_id: r for r in chat(spark, rows)[0].collect()}
    assert len(whole) == 5 and all(r.segment == 0 for r in whole.values())
    coder = Tokenizer.from_file(GPT)
    coder.add_special_tokens([AddedToken(c, normalized=False) for c in chat_masks.TEMPLATE.controls])
    for r in whole.values():
        one = coder.encode(r.formatted, add_special_tokens=False)
        assert r.ids == one.ids and coder.decode(one.ids, skip_special_tokens=False) == r.formatted
    monkeypatch.setattr(chat_masks, "SEGMENT", 500)  # a long conversation travels in segments
    rendered, found = chat(spark, rows)
    parts = [r for r in rendered.collect() if r.conv_id == 7]
    assert len(parts) > 5 and "".join(r.formatted for r in parts) == whole[7].formatted
    assert sum([r.ids for r in parts], []) == whole[7].ids and sum([r.loss for r in parts], []) == whole[7].loss
    assert found == plain_chat(rows)


def test_offsets_are_those_of_the_tokenizers_library():
    coder, other = chat_masks.Coder(GPT, chat_masks.TEMPLATE), Tokenizer.from_file(GPT)
    other.add_special_tokens([AddedToken(c, normalized=False) for c in chat_masks.TEMPLATE.controls])
    text = "<s>[INST]user[/INST] plain  text,\n\tand 42 <\\s></s><s>[INST]assistant[/INST]  ok <|endoftext|></s>"
    ids, begins, ends = coder.encode(text)
    one = other.encode(text, add_special_tokens=False)
    assert ids.tolist() == one.ids and list(zip(begins.tolist(), ends.tolist())) == one.offsets
    assert coder.text(ids) == text
    with pytest.raises(ValueError):
        chat_masks.Coder(public_tokenizers.path("word_bpe_49k.json"), chat_masks.TEMPLATE)


def test_spans_meet_tokens():
    begins, ends = np.array([0, 2, 2, 5, 9]), np.array([2, 5, 5, 9, 12])
    assert chat_masks.inside(begins, ends, [(2, 5), (9, 12)]).tolist() == [False, True, True, False, True]
    assert chat_masks.inside(begins, ends, [(4, 6)]).tolist() == [False, True, True, True, False]
    assert not chat_masks.inside(begins, ends, []).any()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "\\\\", "|endoftext|>", "a", " ", "</s>", "[INST]"]), max_size=14).map("".join))
def test_escapes_are_reversible(text):
    t = chat_masks.TEMPLATE
    shown = t.escaped(text)
    assert t.unescaped(shown) == text and not any(c in shown for c in t.controls)
    assert list(t.turns("".join(t.turn(text, text) + t.turn("x", text)))) == [(text, text), ("x", text)]


# --- manifest -----------------------------------------------------------------------------------------------------------

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def plain_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(digests):
    """The root and, for each leaf, its steps."""
    steps, owner, nodes = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(nodes) > 1:
        up, held = [], []
        for i in range(0, len(nodes), 16):
            run = nodes[i:i + 16]
            for k in range(len(run)):
                for leaf in owner[i + k]:
                    steps[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(H("".join(run)))
            held.append(sum(owner[i:i + 16], []))
        nodes, owner = up, held
    return nodes[0], steps


def plain_audit(rows):
    groups = {}
    for row in rows:  # (doc_id, text, lang, source, n_chars)
        groups.setdefault(row[3], []).append(row)
    named = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = [], []
    for name in named:
        told = [(r[0], plain_leaf((r[0], r[3], r[2], r[4], r[1])), r) for r in groups[name]]
        told.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((told, *plain_tree([leaf for _, leaf, _ in told])))
    root, over = plain_tree([t[1] for t in trees]) if trees else (None, [])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for (told, subroot, steps), top in zip(trees, over):
        for (key, leaf, r), below in zip(told, steps):
            path, folded = below + top, leaf
            if key is not None and zlib.crc32(str(key).encode()) % 5 == 0 and r[1] is not None:
                folded = plain_leaf((r[0], r[3], r[2], r[4], r[1].translate(lower)))
            for before, after in path:
                folded = H(before + folded + after)
            out.append((str(key), leaf, subroot, root, H("".join(b + a for b, a in path)), folded, folded == root))
    return sorted(out)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, `at` int, g int"


def audited(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS)
    return frame, sorted((str(r[0]), *r[1:]) for r in merkle_manifest.audit(frame).collect())


def records(n, of=lambda i: f"s{i % 3}"):
    return [(i, f"Text {i} É", "en", of(i), i) for i in range(n)]


@pytest.mark.parametrize("rows", [
    [], records(1), records(2), records(17, lambda i: "one"), records(16, lambda i: f"s{i}"), records(40, lambda i: f"s{i}"),
    [*records(300, lambda i: "hot" if i % 3 else None), *records(50, lambda i: "hot"), *records(20, lambda i: f"é{i}"),
     *[(None, None, None, None, None)] * 20, *[(7, "Same", None, "hot", 4)] * 40, (8, "", "", "", 0), (10, None, "x", "", None)],
], ids=["none", "one", "three groups", "two levels", "full run of groups", "groups in two levels", "awkward"])
@pytest.mark.parametrize("levels", [3, 1])
def test_audit_equals_a_plain_tree(spark, monkeypatch, rows, levels):
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", levels)  # small blocks: roots of blocks are appended in rounds
    monkeypatch.setattr(merkle_manifest, "BLOCK", 16 ** levels)
    assert audited(spark, rows)[1] == plain_audit(rows)


def test_witnesses_of_the_manifest_lead_to_the_root(spark):
    frame, told = audited(spark, records(70, lambda i: "a" if i < 50 else f"b{i}"))
    rows = merkle_manifest.manifest(frame, "doc_id", "source", list(FIELDS)).collect()
    assert len(rows) == 70 and {r.root for r in rows} == {told[0][3]}
    assert all(merkle_manifest.fold(r.leaf, r.witness) == r.root for r in rows)
    assert all(merkle_manifest.fold(H(r.leaf), r.witness) != r.root for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_streamed_tree_equals_a_plain_tree(n):
    leaves = [H(str(i)) for i in range(n)]
    root, steps = plain_tree(leaves)
    made = merkle_manifest.tree(leaves, True)
    assert made.digest == root and [list(w) for w in made.witnesses()] == steps
