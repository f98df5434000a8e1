"""The registered queries of this subpackage and, where SQL can express one, DuckDB's SQL for it."""

from __future__ import annotations

from fieldglass.llm.conversation_repair import op11_conversation_repair
from fieldglass.llm.embedding_dedup import op12_embedding_dedup
from fieldglass.llm.fingerprint import op7_fingerprint
from fieldglass.llm.language_id import op9_language_id
from fieldglass.llm.ngram_join import op8_ngram_join, op8_ngram_links
from fieldglass.llm.secret_scan import op2_secret_scan
from fieldglass.llm.sentencepiece_codec import op1_sentencepiece
from fieldglass.llm.source_mix import SEED, TARGETS, op4_source_mix
from fieldglass.llm.token_ids import op10_token_ids
from fieldglass.llm.topk_search import op5_topk_search
from fieldglass.llm.toxicity import op3_toxicity
from fieldglass.llm.vector_codes import op13_vector_codes
from fieldglass.llm.warc import op6_warc

QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_secret_scan, op3_toxicity, op4_source_mix, op5_topk_search, op6_warc, op7_fingerprint, op8_ngram_join, op8_ngram_links, op9_language_id, op10_token_ids, op11_conversation_repair, op12_embedding_dedup, op13_vector_codes)}

# The parts' distances to the entries and the entries' next values, for each round of op13.
_nearest = "SELECT r, p, x, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (SELECT r, p, x, e, (list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT AS d FROM parts JOIN {books} USING (p)) GROUP BY r, p, x"
_moved = """SELECT p, e, coalesce(new.c, old.c) AS c FROM {books} old LEFT JOIN (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(y) / count(*)) AS m FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM {assigned}) GROUP BY p, e, i) GROUP BY p, e) new USING (p, e)"""
_targets = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in TARGETS.items())
ORACLE_SQL = {
    "op5_topk_search": """
WITH good AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, x.vec_id, list_dot_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score
  FROM good q JOIN good x ON x.r <> q.r AND len(x.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""",
    "op13_vector_codes": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, (SELECT unnest(range(16)) AS p)),
books0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
assigned0 AS MATERIALIZED ({_nearest.format(books="books0")}),
books1 AS MATERIALIZED ({_moved.format(books="books0", assigned="assigned0")}),
assigned1 AS MATERIALIZED ({_nearest.format(books="books1")}),
books2 AS MATERIALIZED ({_moved.format(books="books1", assigned="assigned1")}),
assigned2 AS MATERIALIZED ({_nearest.format(books="books2")}),
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM assigned2 GROUP BY r),
digest AS (SELECT sha256(string_agg(n, ',' ORDER BY p, e)) AS codebooks_sha256 FROM (SELECT p, e, array_to_string(list_transform(c, lambda m: m::BIGINT), ',') AS n FROM books2))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), digest
""",
    "op4_source_mix": f"""
WITH targets(source, weight) AS (VALUES {_targets}),
sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT t.source, (SELECT sum(n) FROM sizes JOIN targets USING (source)) * t.weight / (SELECT sum(weight) FROM targets) / s.n AS rate
  FROM targets t JOIN sizes s USING (source)),
steps AS (
  SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM rates, (SELECT unnest(range(0, 400))::DOUBLE AS k) WHERE rate > 0),
drawn AS (
  SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u,
         row_number() OVER () AS r
  FROM documents),
counted AS (
  SELECT d.r, count(s.p) AS c FROM drawn d JOIN rates USING (source) LEFT JOIN steps s ON s.source = d.source AND s.p <= d.u GROUP BY d.r)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, k.copy::INTEGER AS copy,
       md5('{SEED}-order:' || coalesce(d.doc_id::VARCHAR, '') || ':' || k.copy) AS shuffle_key
FROM drawn d LEFT JOIN counted USING (r), LATERAL (SELECT unnest(range(0, CASE WHEN d.source IN (SELECT source FROM targets) THEN coalesce(counted.c, 0) ELSE 1 END)) AS copy) k
""",
}
