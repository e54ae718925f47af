"""The registered queries of the operators: contract digests of whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import ball_codes, decontaminate, html_text, langid, license_rules, pieces, quality, shingle_join, token_ids, token_links, toxicity, vector_join, warc
from adlens.llm.common import fold, small_batches, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.link_report(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id") != 0)
    model = toxicity.train_model(docs.filter(fold("doc_id") != 0), labels)
    return toxicity.score(docs, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train_model(pages)).select("page_id", "url", "text", "n_chars")


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return quality.score(docs, quality.train_model(docs, labels)).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), F.col("quality_score").alias("score"),
        F.col("quality_pred").alias("predicted"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, _tokenizer("piece_bpe_32k.model")).select("doc_id", "ids", "n_tokens", "lossless")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = langid.training_texts(langid.train_fold(docs))
    return langid.identify(docs.select("doc_id", "text"), texts).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_codes.code_report(table(spark, sf_dir, "embeddings"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_rules.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = token_links.align_corpus(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_decontaminate, op2_near_vectors, op3_toxicity, op4_token_ids, op5_html_text, op6_shingle_join, op7_warc,
           op8_quality, op9_pieces, op10_language, op11_vector_codes, op12_license_scan, op13_token_links, pipeline)
    return {f.__name__: _bounded(f) for f in own}


def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


# DuckDB statements. The models' and tokenizers' queries have none.
_OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
               array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, occ.n, i, item_id FROM occ JOIN win ON occ.g = win.g AND occ.n = win.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP2 = """
WITH RECURSIVE v AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
       AND len([x FOR x IN e IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(node, seen) AS (SELECT vec_id, vec_id FROM ok UNION SELECT node, links.b FROM reach JOIN links ON links.a = seen),
comp AS (SELECT node, min(seen) AS c FROM reach GROUP BY node),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM v LEFT JOIN deg ON deg.a = vec_id LEFT JOIN comp ON comp.node = vec_id
"""

_OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(node, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT node, links.b FROM reach JOIN links ON links.a = seen),
comp AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN comp ON node = d.doc_id
"""

_OP7 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means over all entries, a pair of statements a round."""
    sql = f"""
WITH raw AS (SELECT vec_id, label, embedding AS e FROM embeddings WHERE embedding IS NOT NULL
       AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT vec_id, label, [CAST(floor(4096 * x::DOUBLE) AS BIGINT) FOR x IN e] AS z FROM raw),
p AS (SELECT vec_id, i, z[i * len(z) // {parts} + 1:(i + 1) * len(z) // {parts}] AS x FROM v, range({parts}) r(i)),
b0 AS (SELECT i, row_number() OVER (PARTITION BY i ORDER BY vec_id) - 1 AS j, x AS c FROM p
       WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries}))"""
    for k in range(rounds + 1):
        sql += f""",
a{k} AS (SELECT vec_id, i, min_by(j, d * {entries} + j) AS j, min(d) AS d
         FROM (SELECT vec_id, p.i, j, list_sum([(x[t] - c[t]) * (x[t] - c[t]) FOR t IN range(1, len(x) + 1)])::BIGINT AS d
               FROM p JOIN b{k} ON p.i = b{k}.i) GROUP BY vec_id, i)"""
        if k < rounds:
            sql += f""",
s{k} AS (SELECT i, j, t, sum(x[t])::BIGINT AS s, count(*) AS n
         FROM (SELECT a.i, a.j, x, unnest(range(1, len(x) + 1)) AS t FROM a{k} a JOIN p ON p.vec_id = a.vec_id AND p.i = a.i)
         GROUP BY i, j, t),
n{k} AS (SELECT i, j, list((s - ((s % n) + n) % n) // n ORDER BY t) AS c FROM s{k} GROUP BY i, j),
b{k + 1} AS (SELECT b.i, b.j, coalesce(n.c, b.c) AS c FROM b{k} b LEFT JOIN n{k} n ON n.i = b.i AND n.j = b.j)"""
    return sql + f""",
r AS (SELECT vec_id, string_agg(printf('%02x', j), '' ORDER BY i) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY i, j)) AS h FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM r JOIN v USING (vec_id), h
"""


def _op12() -> str:
    """Every rule on every text that holds its anchor; places compared in pairs."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    rules = ",\n".join(f"({r.tier}, {r.order}, {text(r.label)}, {text('licen' if r.keys[0] == 'license' else r.keys[0])}, {text(r.regex)})"
                       for r in license_rules.rules())
    base = ", ".join(f"({text(p)}, {text(v)})" for p, v in license_rules.BASE.items())
    conf = ", ".join(f"({t}, {c}::DOUBLE)" for t, c in enumerate(license_rules.CONFIDENCE))
    return rf"""
WITH rules(tier, ord, label, anchor, regex) AS (VALUES {rules}),
base(phrase, label) AS (VALUES {base}), conf(tier, c) AS (VALUES {conf}),
d AS (SELECT row_number() OVER () AS k, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT k, w, array_to_string(w, ' ') AS s FROM d),
b AS (SELECT k, label, unnest([i - 1 FOR i IN range(1, len(w) + 1) IF w[i:i + len(pw) - 1] = pw]) AS pos
      FROM t JOIN (SELECT string_split(phrase, ' ') AS pw, phrase, label FROM base) ON contains(s, phrase)),
bs AS (SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM b GROUP BY k),
m AS (SELECT k, tier, ord, label, unnest(regexp_extract_all(
          array_to_string([' ' || (i - 1) || ':' || w[i] || ' ' FOR i IN range(1, len(w) + 1)], ''), regex)) AS m
      FROM t JOIN rules ON contains(s, anchor)),
p AS (SELECT k, tier, ord, label, regexp_extract(m, '^ ([0-9]+):', 1)::INT AS lo, regexp_extract(m, '([0-9]+):[^ ]* $', 1)::INT AS hi FROM m),
kept AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.k = p.k AND q.lo <= p.lo AND q.hi >= p.hi
         AND (q.tier < p.tier OR q.tier = p.tier AND (q.hi - q.lo > p.hi - p.lo OR q.hi - q.lo = p.hi - p.lo AND q.ord < p.ord)))),
names AS (SELECT k, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM b UNION SELECT k, label FROM kept) GROUP BY k),
bn AS (SELECT k, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT k, label FROM b) GROUP BY k),
best AS (SELECT k, c FROM (SELECT k, min(tier) AS tier FROM kept GROUP BY k) JOIN conf USING (tier))
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(bs.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(bn.labels, '') AS base_labels, coalesce(names.labels, '') AS labels,
       coalesce(c, CASE WHEN bs.n > 0 THEN {license_rules.BASE_SCORE}::DOUBLE END, 0::DOUBLE) AS score
FROM d LEFT JOIN bs USING (k) LEFT JOIN bn USING (k) LEFT JOIN names USING (k) LEFT JOIN best USING (k)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": _OP1, "op2_near_vectors": _OP2, "op6_shingle_join": _OP6, "op7_warc": _OP7, "op11_vector_codes": _op11(), "op12_license_scan": _op12()}
