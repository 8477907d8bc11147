"""One registered query for each operator of this package, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (
    bm25_packing, bpe_fst, byte_rnn, chat_masks, cotraining, grid_codes, line_blocks, merkle_manifest, minmax_dedup, multi_index,
    shuffle_shards, spotsigs, tfidf_toxicity,
)
from riskframe.llm.common import table


def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_edits(table(spark, sf_dir, "documents"))


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_fst.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_shards.placement(table(spark, sf_dir, "documents"))


def op6_byte_rnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_rnn.identify(table(spark, sf_dir, "documents"))


def op7_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_tfidf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_block_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = bm25_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_codes.compress(table(spark, sf_dir, "embeddings"))


#: Conversation whose texts are made of control strings alone.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(planted.columns).unionByName(planted)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat_masks.read_back(chat_masks.render(rows, path), path)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_inverted_multi_index, op2_spotsigs_fingerprints, op3_minmax_dedup, op4_bpe_transducer, op5_external_shuffle, op6_byte_rnn_language, op7_cotraining_quality, op8_tfidf_toxicity, op9_line_block_html, op10_bm25_packing,
    op11_grid_codes, op12_chat_masks, op13_merkle_manifest,
)}


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Full search over all entries, on vectors whose length ``parts`` divides."""
    steps = ["""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""cut AS MATERIALIZED (
  SELECT vec_id, label, p, q[p * (len(q) // {parts}) + 1:(p + 1) * (len(q) // {parts})] AS x
  FROM kept, range(0, {parts}) r(p)
)""", f"""book0 AS MATERIALIZED (
  SELECT p, j, x AS c FROM cut JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM kept QUALIFY j < {entries}) USING (vec_id)
)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT vec_id, label, p, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), j := j)) AS best
  FROM cut JOIN book{k} USING (p) GROUP BY vec_id, label, p, x
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.j, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
    SELECT p, j, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
      SELECT p, best.j AS j, i, sum(x[i]) AS s, count(*) AS n FROM near{k}, range(1, 1000) r(i) WHERE i <= len(x) GROUP BY ALL
    ) GROUP BY ALL) m ON m.p = b.p AND m.j = b.j
)""")
    return "WITH " + ", ".join(steps) + f""", coded AS MATERIALIZED (
  SELECT vec_id, label, string_agg(lower(lpad(to_hex(best.j), 2, '0')), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) FROM book{rounds}) AS codebooks_sha256
FROM coded"""


def manifest_sql(levels: int = 5) -> str:
    """The tree level by level, for groups of up to 16 ** levels nodes."""
    def field(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"

    def climb(name: str, start: str) -> str:
        """Tables of each level, and of each leaf the list of (before, after) up to the top."""
        made = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(levels):
            made.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT g, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d,
         any_value(n + 15) // 16 AS n FROM {name}{k} GROUP BY g, pos // 16
), {name}steps{k} AS MATERIALIZED (
  SELECT g, pos // 16 AS run, list(d ORDER BY pos) AS row FROM {name}{k} WHERE n > 1 GROUP BY ALL
)""")
        steps = ", ".join(f"CASE WHEN s{k}.row IS NULL THEN NULL ELSE [array_to_string(s{k}.row[1:x.pos // {16 ** k} % 16], ''), "
                          f"array_to_string(s{k}.row[x.pos // {16 ** k} % 16 + 2:], '')] END" for k in range(levels))
        joins = " ".join(f"LEFT JOIN {name}steps{k} s{k} ON s{k}.g = x.g AND s{k}.run = x.pos // {16 ** (k + 1)}" for k in range(levels))
        made.append(f"""{name}path AS MATERIALIZED (
  SELECT x.g, x.pos, top.d AS top, list_filter([{steps}], lambda s: s IS NOT NULL) AS steps
  FROM {name}0 x JOIN {name}{levels} top ON top.g = x.g {joins}
)""")
        return ", ".join(made)

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    shift = "CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END"
    parts = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return f"""
WITH RECURSIVE bits(i, k, z) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(0, 256) r(i) UNION ALL SELECT i, k + 1, {shift} FROM bits WHERE k < 8
), crc AS (
  SELECT list(z ORDER BY i) AS t FROM bits WHERE k = 8
), leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS g, sha256(concat({", ".join(parts)}, {field("text")})) AS leaf,
    sha256(concat({", ".join(parts)}, {field(lowered)})) AS changed,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 5 = 0 AS hit
  FROM documents, crc
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), {climb("low", "SELECT g, pos, n, leaf AS d FROM placed")}, subroots AS MATERIALIZED (
  SELECT g AS name, '' AS g, top AS d, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT g, top FROM lowpath)
), {climb("high", "SELECT g, pos, n, d FROM subroots")}, proven AS (
  SELECT p.doc_id, p.leaf, CASE WHEN p.hit THEN p.changed ELSE p.leaf END AS told, s.d AS subroot, h.top AS root, l.steps || h.steps AS steps
  FROM placed p JOIN lowpath l ON l.g = p.g AND l.pos = p.pos JOIN subroots s ON s.name = p.g JOIN highpath h ON h.pos = s.pos
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(flatten(steps), '')) AS proof_sha256,
  list_reduce(list_prepend([told], steps), lambda a, b: [sha256(b[1] || a[1] || b[2])])[1] AS folded_root, folded_root = root AS verified
FROM proven"""


SQL: dict[str, str] = {
    "op11_grid_codes": codes_sql(),
    "op12_chat_masks": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, ['user', 'assistant'][i + 1], '</s>[INST] ok [/INST]' FROM range(0, 2) r(i)
), said AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
    regexp_replace(text, '([<\[])(\\*(/?s>|/?INST\]|\|endoftext\|>))', '\1\\\2', 'g') AS shown FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(length(learned)) AS BIGINT) AS loss_chars, sha256(string_agg(learned, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length('<s>[INST][/INST]</s>') + length(role) + length(shown)) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
""",
    "op13_merkle_manifest": manifest_sql(),
    "op3_minmax_dedup": r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sets AS MATERIALIZED (
  SELECT s, list_sort(s) AS k, min(doc_id) AS node FROM shingles WHERE len(s) > 0 GROUP BY ALL
), nodes AS MATERIALIZED (
  SELECT k, min(node) AS node, len(k) AS n FROM sets GROUP BY k
), entries AS MATERIALIZED (
  SELECT node, n, unnest(k) AS e FROM nodes
), links AS MATERIALIZED (
  SELECT x.node AS a, y.node AS b FROM entries x JOIN entries y ON x.e = y.e AND x.node <> y.node
  GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reached(node, r) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT links.b, reached.r FROM reached JOIN links ON links.a = reached.node
), named AS (
  SELECT node, min(r) AS component FROM reached GROUP BY node
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component, d.doc_id) AS kept
FROM shingles d LEFT JOIN nodes ON nodes.k = list_sort(d.s) LEFT JOIN named c ON c.node = nodes.node
""",
}
