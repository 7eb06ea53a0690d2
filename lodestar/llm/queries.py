"""The registered queries of this subpackage: ``(builder, DuckDB SQL or None)`` by name."""

from __future__ import annotations

from lodestar.llm import brown
from lodestar.llm._common import table
from lodestar.llm.decontam import contamination_digest
from lodestar.llm.langid import identify
from lodestar.llm.licenses import scan_licenses
from lodestar.llm.neardup import near_duplicate_digest
from lodestar.llm.packing import pack_digest
from lodestar.llm.periodic import run_digest
from lodestar.llm.pieces import piece_digest
from lodestar.llm.quality import classify_digest
from lodestar.llm.substring import dedup_digest
from lodestar.llm.tokenfile import token_digest
from lodestar.llm.topk import top_inner_products
from lodestar.llm.variants import spelling_variants

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_best_fit_packing(spark, sf_dir):
    return pack_digest(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return dedup_digest(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, s, array_to_string(ws[s + 1:s + 20], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 19)) AS s FROM w)
), again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS rn FROM win) WHERE rn > 1
), gone AS (
  SELECT DISTINCT doc_id, s + i AS pos FROM (SELECT doc_id, s, unnest(range(0, 20)) AS i FROM again)
), each AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos FROM w
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.pos) AS t, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op3_minhash_near_dedup(spark, sf_dir):
    return near_duplicate_digest(table(spark, sf_dir, "documents"))


OP3_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s + 1:s + 3], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 2, 1))) AS s FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY 1
), link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)
), reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT link.b, reach.c FROM reach JOIN link ON link.a = reach.doc_id
), comp AS (
  SELECT doc_id, min(c) AS component_id FROM reach GROUP BY 1
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def op4_decontamination(spark, sf_dir):
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, m, array_to_string(ws[s + 1:s + m], ' ') AS k
  FROM (SELECT item_id, ws, least(len(ws), 10) AS m, unnest(range(0, len(ws) - least(len(ws), 10) + 1)) AS s FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT doc_id, m, s, array_to_string(ws[s + 1:s + m], ' ') AS k
  FROM (SELECT doc_id, ws, m, unnest(range(0, len(ws) - m + 1)) AS s FROM d, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)
), hit AS (
  SELECT dw.doc_id, dw.m, dw.s, iw.item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.k = iw.k
), cov AS (
  SELECT doc_id, count(DISTINCT s + i) AS n FROM (SELECT doc_id, s, unnest(range(0, m)) AS i FROM (SELECT DISTINCT doc_id, m, s FROM hit)) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY 1
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op5_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_exact_topk(spark, sf_dir):
    return top_inner_products(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op7_quality_classifier(spark, sf_dir):
    return classify_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_brown_lm(spark, sf_dir):
    return brown.score(table(spark, sf_dir, "documents"))


def op9_token_file(spark, sf_dir):
    return token_digest(table(spark, sf_dir, "documents"))


def op10_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    return run_digest(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of the UTF-8 bytes of ``text``, with the table ``crc.t``."""
    nibble = lambda k: f"strpos('0123456789ABCDEF', substr(hex(encode({text})), 2 * i + {k}, 1)) - 1"
    byte = f"16 * ({nibble(1)}) + {nibble(2)}"
    return (
        f"xor(list_reduce(list_transform(range(0, octet_length(encode({text}))), lambda i: CAST({byte} AS BIGINT)), "
        "lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
    )


CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
)"""

# A run matches on its lag's diagonal for at least six words, so the diagonals of equal six-word windows hold all of them.
OP11_SQL = rf"""
WITH {CRC_TABLE}, r AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc
), p AS (
  SELECT doc_id, ws, h, len(ws) AS n, h // 10 % greatest(len(ws), 1) AS a FROM r
), w AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + h // 10 % 8)) END]) ELSE ws END AS ws FROM p
), g AS MATERIALIZED (
  SELECT doc_id, n, i, array_to_string(ws[i + 1:i + 6], ' ') AS k FROM (SELECT doc_id, n, ws, unnest(range(0, n - 5)) AS i FROM w WHERE n >= 12)
), same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.k = y.k AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
), stretch AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 6 - min(i) + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island
), run AS MATERIALIZED (
  SELECT doc_id, s, l, min(q) AS q FROM stretch WHERE l >= greatest(12, 2 * q) GROUP BY doc_id, s, l
), told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    max({{'l': l, 's': -s, 'q': -q}}) AS b FROM run GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS t FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, n)) AS i FROM w) e
  ANTI JOIN gone ON e.doc_id = gone.doc_id AND e.i = gone.i GROUP BY e.doc_id
)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, -b.s AS start, b.l AS length, -b.q AS period, 1000 * b.l // -b.q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), edit=31)


OP12_SQL = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT id, translate(w, '{UPPER}', '{LOWER}') AS w, count(*) AS c
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= 7 GROUP BY ALL
), hashed AS (
  SELECT w, c, {_crc32("id || ':' || w")} AS h FROM runs, crc
), v AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), cut AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS x FROM (SELECT word, unnest(range(0, length(word))) AS i FROM v)
), near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.x = b.x AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, x FROM cut WHERE x IN (SELECT word FROM v) UNION SELECT x, word FROM cut WHERE x IN (SELECT word FROM v)
), counted AS (
  SELECT a AS word, count(*) AS n_near FROM near GROUP BY a
), form AS MATERIALIZED (
  SELECT a AS word, m.b AS form, -m.n AS form_n
  FROM (SELECT a, min({{'n': -vb.n, 'b': b}}) AS m FROM near JOIN v va ON va.word = a JOIN v vb ON vb.word = b WHERE vb.n >= 10 * va.n GROUP BY a)
), way(word, goal) AS (
  SELECT word, form FROM form UNION ALL SELECT way.word, form.form FROM way JOIN form ON form.word = way.goal
), root AS (
  SELECT word, goal FROM way WHERE goal NOT IN (SELECT word FROM form)
)
SELECT v.word, form, coalesce(root.goal, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near, form_n
FROM v LEFT JOIN counted USING (word) LEFT JOIN form USING (word) LEFT JOIN root USING (word)
"""


def op13_sentencepiece(spark, sf_dir):
    return piece_digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op2_substring_dedup": (op2_substring_dedup, OP2_SQL),
    "op3_minhash_near_dedup": (op3_minhash_near_dedup, OP3_SQL),
    "op4_decontamination": (op4_decontamination, OP4_SQL),
    "op5_license_scan": (op5_license_scan, None),
    "op6_exact_topk": (op6_exact_topk, OP6_SQL),
    "op7_quality_classifier": (op7_quality_classifier, None),
    "op8_brown_lm": (op8_brown_lm, None),
    "op9_token_file": (op9_token_file, None),
    "op10_language_id": (op10_language_id, None),
    "op11_periodic_runs": (op11_periodic_runs, OP11_SQL),
    "op12_spelling_variants": (op12_spelling_variants, OP12_SQL),
    "op13_sentencepiece": (op13_sentencepiece, None),
}
