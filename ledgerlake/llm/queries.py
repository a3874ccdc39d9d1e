"""The registered queries of this subpackage, and DuckDB SQL where SQL can say
the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (bpe, chat_format, decontaminate, embed_dedup, license_scan, lm_score, merkle, ngram_join, pii,
                            quality, token_counts, turn_repair, url_filter)
from ledgerlake.llm.common import read_table
from ledgerlake.session import ship_package


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    listed = url_filter.listed_pages(pages, read_table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, url_filter.RULES, listed)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngram_join.jaccard_classes(read_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    scored = lm_score.score(read_table(spark, sf_dir, "documents"))
    return scored.withColumn("score", F.round("score", 4))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).selectExpr("inline(array({}))".format(", ".join(
        f"struct({c}L as conv_id, {t}L as turn, '{r}' as role, '{x}' as text)" for c, t, r, x in chat_format.PROBE)))
    return chat_format.digest(rows.unionByName(probe))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.digest(read_table(spark, sf_dir, "documents"), bpe.ranks_bytes(RANKS))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pii.digest(read_table(spark, sf_dir, "documents"))

def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return token_counts.digest(read_table(spark, sf_dir, "documents"), token_counts.model_bytes(PIECES))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    conversations = read_table(spark, sf_dir, "conversations")
    return turn_repair.digest(turn_repair.damaged(conversations), conversations, "copies")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


#: model file of the registered token counts
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: rank file of the registered BPE query
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_bpe": op5_bpe,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_pii": op7_pii,
    "op8_decontamination": op8_decontamination,
    "op9_license_scan": op9_license_scan,
    "op10_quality": op10_quality,
    "op11_token_counts": op11_token_counts,
    "op12_turn_repair": op12_turn_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _crc32(text: str) -> str:
    """DuckDB SQL for the crc32 of an ASCII string: eight shifts for each byte."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
            f"lambda c, b: {step}), 4294967295)")


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
_URL_PARTS = """
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
"""

ORACLE = {
    "op1_url_filter": f"""
WITH parts AS ({_URL_PARTS}),
canon AS (SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html?|/)$', '') AS url FROM parts),
listed AS (SELECT DISTINCT url FROM canon WHERE host <> '' AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
fits AS (
  SELECT c.host, c.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY c.host, c.path ORDER BY length(r.host || r.path) DESC, r.host || r.path) AS k
  FROM (SELECT DISTINCT host, path FROM canon) c JOIN rules r
    ON (c.host = r.host OR suffix(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.verdict, CASE WHEN l.url IS NOT NULL AND c.host <> '' THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c LEFT JOIN fits f ON f.host = c.host AND f.path = c.path AND f.k = 1
LEFT JOIN listed l ON l.url = c.url
""",
    "op2_ngram_jaccard": r"""
WITH RECURSIVE low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS ws FROM low),
starts AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM starts),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.c, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY 1) r USING (doc_id)
""",
    "op3_lm_scoring": r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \t\n\x0B\f\r]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM low),
p AS (SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM t),
n AS (SELECT count(*) AS n FROM t),
cw AS (SELECT w, count(*) AS c FROM t GROUP BY w),
cp AS (SELECT v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY v, w),
ow AS (SELECT doc_id, w, count(*) AS c FROM t GROUP BY doc_id, w),
op AS (SELECT doc_id, v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY doc_id, v, w),
s AS (
  SELECT p.doc_id, p.v, cp.c - op.c AS pairs, cv.c - ov.c AS befores,
         CASE WHEN cw.c > ow.c THEN cw.c - ow.c ELSE 0.4::DOUBLE END
           / greatest(n.n - count(*) OVER (PARTITION BY p.doc_id), 1) AS alone
  FROM p CROSS JOIN n JOIN cw ON cw.w = p.w JOIN ow ON ow.doc_id = p.doc_id AND ow.w = p.w
    LEFT JOIN cp ON cp.v = p.v AND cp.w = p.w LEFT JOIN op ON op.doc_id = p.doc_id AND op.v = p.v AND op.w = p.w
    LEFT JOIN cw cv ON cv.w = p.v LEFT JOIN ow ov ON ov.doc_id = p.doc_id AND ov.w = p.v),
g AS (
  SELECT doc_id, sum(log10(CASE WHEN v IS NULL THEN alone WHEN pairs > 0 THEN pairs / befores::DOUBLE
                                ELSE 0.4::DOUBLE * alone END)) AS score
  FROM s GROUP BY doc_id)
SELECT low.doc_id, len(ws) AS n_words, round(coalesce(g.score, 0.0), 4) AS score FROM low LEFT JOIN g USING (doc_id)
""",
    "op4_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
n AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
p AS (
  SELECT *, CASE WHEN opens THEN length('<|start|>') + 1 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'))
            ELSE length('<|turn|>') END
         + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
         + CASE WHEN closes THEN length('<|end|>') + 1 ELSE 0 END AS chars
  FROM n
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
""",
    "op6_embedding_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND isfinite(list_sum(embedding)) AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
unit AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS l FROM usable),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_inner_product(a.v, b.v) / (a.l * b.l) >= 0.9),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, r.c AS component_id, e.vec_id = r.c AS kept
FROM embeddings e JOIN (SELECT vec_id, min(other) AS c FROM reach GROUP BY 1) r USING (vec_id)
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY 1) k ON k.a = e.vec_id
""",
    # windows are counted from their first equal word: one that would leave the
    # item holds no more than the last window inside it
    "op8_decontamination": r"""
WITH dw AS (SELECT * FROM (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS w FROM documents)) WHERE word <> ''),
iw AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM (
  SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS k
  FROM (SELECT item_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS w FROM benchmark)) WHERE word <> ''),
m AS (SELECT doc_id, item_id, p - k AS diagonal, k, least(n, 13) AS width FROM dw JOIN iw USING (word)),
c AS (SELECT doc_id, item_id, width, count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k
             RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS matched FROM m)
SELECT doc_id, item_id, max(matched)::INTEGER AS matched FROM c WHERE matched >= width - (width * 2) // 13
GROUP BY doc_id, item_id
""",
    # the sentences that the tables hold, and a rule for each
    "op9_license_scan": r"""
WITH cut AS (
  SELECT doc_id, unnest(w) AS raw, generate_subscripts(w, 1) AS position
  FROM (SELECT doc_id, regexp_split_to_array(text, '[.;][^\p{L}\p{N}\s]*\s+|\n+') AS w FROM documents)),
known(sentence, sentence_id, license, rank) AS (VALUES
  ('licensed under the apache license version 2 0', 'apache-line', 'Apache-2.0', 1),
  ('released under the mit license', 'mit-line', 'MIT', 2),
  ('this work is licensed under the gnu general public license version 3', 'gpl3-line', 'GPL-3.0', 3),
  ('licensed under cc by nc 4 0', 'ccbync-line', 'CC-BY-NC-4.0', 4),
  ('all rights reserved', 'reserved', NULL, 5)),
hits AS (
  SELECT doc_id, position, sentence_id, license, rank FROM cut
  JOIN known ON sentence = trim(regexp_replace(lower(raw), '[^\p{L}\p{N}]+', ' ', 'g'))),
found AS (SELECT doc_id, license, rank FROM hits GROUP BY ALL)
SELECT doc_id, string_agg(sentence_id, ' ' ORDER BY position) AS sentences,
       coalesce((SELECT string_agg(license, ',' ORDER BY rank) FROM found f WHERE f.doc_id = h.doc_id), '') AS licenses,
       coalesce(string_agg(sentence_id, ' ' ORDER BY position) FILTER (license IS NULL), '') AS rest
FROM hits h GROUP BY doc_id
""",
    # costs to the end from each state go backwards over the rows, the audit forwards
    "op12_turn_repair": r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         """ + _crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')") + r""" % 20 AS k FROM conversations),
harm AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE k WHEN 3 THEN [1, 2] ELSE [1] END) AS nth_copy
  FROM c WHERE k <> 0),
u AS (SELECT *, row_number() OVER () AS u FROM harm),
r AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS f,
             lag(left(role, 1)) OVER w AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, u) AS nth
      FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, u)),
x AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM r),
s AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS e FROM x),
b(conv_id, i, v) AS (
  SELECT DISTINCT conv_id, n + 1, [0, 4, 2, 0] FROM s
  UNION ALL
  SELECT conv_id, i, [least(w[1], w[3] + 2, w[4] + 4), least(w[2], w[3] + 2, w[4] + 4), least(w[3], w[4] + 2), least(w[4], w[3] + 2)]
  FROM (SELECT s.conv_id, s.i,
               [least(v[1] + 3, v[3] + 2 + e, CASE f WHEN 's' THEN v[2] + e WHEN 'u' THEN v[3] + e END),
                least(v[2] + 3, v[3] + 2 + e, CASE f WHEN 'u' THEN v[3] + e END),
                least(v[3] + 3, v[4] + 2 + e, CASE f WHEN 'a' THEN v[4] + e END),
                least(v[4] + 3, v[3] + 2 + e, CASE f WHEN 'u' THEN v[3] + e END)] AS w
        FROM b JOIN s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i - 1)),
go(conv_id, i, q, audit, lines) AS (
  SELECT DISTINCT conv_id, 1::BIGINT, 1, '', []::VARCHAR[] FROM s
  UNION ALL
  SELECT conv_id, CASE edit WHEN 'I' THEN i ELSE i + 1 END,
         CASE WHEN edit = 'D' THEN q WHEN edit = 'K' AND f = 's' THEN 2 WHEN q = 3 THEN 4 ELSE 3 END, audit || edit,
         CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
              ELSE list_append(lines, CASE q WHEN 3 THEN 'assistant:' ELSE 'user:' END || CASE edit WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT go.*, s.f, s.role, s.text,
               CASE WHEN s.i IS NULL THEN 'I' WHEN o.v[q] = z.v[q] + 3 THEN 'D'
                    WHEN o.v[q] = o.v[CASE q WHEN 3 THEN 4 ELSE 3 END] + 2 THEN 'I'
                    WHEN o.v[q] = CASE WHEN f = 's' AND q = 1 THEN z.v[2] WHEN f = 'a' AND q = 3 THEN z.v[4]
                                       WHEN f = 'u' AND q <> 3 THEN z.v[3] END + e THEN 'K' ELSE 'R' END AS edit
        FROM go JOIN b o ON o.conv_id IS NOT DISTINCT FROM go.conv_id AND o.i = go.i
        LEFT JOIN b z ON z.conv_id IS NOT DISTINCT FROM go.conv_id AND z.i = go.i + 1
        LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM go.conv_id AND s.i = go.i
        WHERE s.i IS NOT NULL OR go.q IN (2, 3))),
ends AS (SELECT conv_id, max_by(audit, length(audit)) AS audit, max_by(lines, length(audit)) AS lines FROM go GROUP BY conv_id),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND before || f NOT IN ('su', 'ua', 'au')) AS illegal
  FROM s GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v[1], 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM d.conv_id AND b.i = 1
""",
    # every level by row numbers; paths by joining all levels' runs
    "op13_merkle_manifest": r"""
WITH RECURSIVE e AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
         CASE WHEN coalesce(""" + _crc32("doc_id::VARCHAR") + r""" % 2 = 0, FALSE) THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents),
h AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS tampered FROM e),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS id FROM h),
up(source, level, i, h, n) AS (
  SELECT source, 0, i, leaf, n FROM l
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY source, level, i // 3, n),
sub AS (SELECT source, h, level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top(level, i, h, n) AS (
  SELECT 0, i, h, n FROM sub
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, i // 3, n),
steps AS (
  SELECT l.id, up.level, coalesce(string_agg(h, '' ORDER BY up.i) FILTER (up.i < l.i // (3 ** up.level)::BIGINT), '') AS a,
         coalesce(string_agg(h, '' ORDER BY up.i) FILTER (up.i > l.i // (3 ** up.level)::BIGINT), '') AS z
  FROM l JOIN up ON up.source IS NOT DISTINCT FROM l.source AND up.n > 1 AND up.i // 3 = l.i // (3 ** (up.level + 1))::BIGINT GROUP BY ALL
  UNION ALL
  SELECT l.id, sub.level + top.level, coalesce(string_agg(top.h, '' ORDER BY top.i) FILTER (top.i < sub.i // (3 ** top.level)::BIGINT), ''),
         coalesce(string_agg(top.h, '' ORDER BY top.i) FILTER (top.i > sub.i // (3 ** top.level)::BIGINT), '')
  FROM l JOIN sub ON sub.source IS NOT DISTINCT FROM l.source
  JOIN top ON top.n > 1 AND top.i // 3 = sub.i // (3 ** (top.level + 1))::BIGINT GROUP BY ALL),
fold(id, level, h) AS (
  SELECT id, 0, tampered FROM l
  UNION ALL
  SELECT fold.id, fold.level + 1, sha256(a || h || z) FROM fold JOIN steps USING (id, level)),
proofs AS (SELECT id, sha256(string_agg(a || z, '' ORDER BY level)) AS p FROM steps GROUP BY id),
folded AS (SELECT id, max_by(h, level) AS h FROM fold GROUP BY id)
SELECT l.doc_id, l.leaf, sub.h AS subroot, r.h AS root, coalesce(proofs.p, sha256('')) AS proof_sha256, folded.h AS folded_root,
       folded.h = r.h AS verified
FROM l JOIN sub ON sub.source IS NOT DISTINCT FROM l.source JOIN folded USING (id) LEFT JOIN proofs USING (id), (SELECT h FROM top WHERE n = 1) r
""",
}
