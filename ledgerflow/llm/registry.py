"""Queries of this package: each operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, fingerprint, html_extract, langid, lookup_means, mixing, neighbours, periodic, ppm, simhash, token_ids,
               toxicity, warc)
from .common import send_package


def _query(table: str, fn: Callable[..., DataFrame], *more: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        send_package(spark)
        return fn(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in (table, *more)])

    return run


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_salvage": _query("pages", lambda d: warc.archived_pages(d).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")),
    "op2_benchmark_decontamination": _query("documents", lambda d, b: decontaminate.contaminated(d, b).select("doc_id", "item_id", "coverage", "n_tiles"), "benchmark"),
    "op3_embedding_near_dedup": _query("embeddings", neighbours.near_vectors),
    "op4_ppm_scores": _query("documents", ppm.ppm_scores),
    "op5_html_consensus": _query("pages", html_extract.main_text),
    "op6_token_ids": _query("documents", lambda d: token_ids.token_ids(d, token_ids.word_vocabulary())),
    "op7_source_mixing": _query("documents", mixing.mix_sources),
    "op8_language_id": _query("documents", langid.identify),
    "op9_toxicity": _query("documents", lambda d, y: toxicity.toxicity(d, y).select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages")), "labels"),
    "op10_simhash_near_dedup": _query("documents", simhash.simhash_components),
    "op11_lookup_means": _query("embeddings", lookup_means.lookup_means),
    "op12_periodic_runs": _query("documents", lambda d: periodic.periodic_runs(d, repeat_tails=True)),
    "op13_document_fingerprints": _query("documents", fingerprint.document_fingerprints),
    "pipeline": _pipeline,
}


def _means_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds of ``op11_lookup_means`` written out, one pair of tables each."""
    far = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    out = [f"""
        WITH v AS MATERIALIZED (
                 SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                 WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             c0 AS MATERIALIZED (
                 SELECT row_number() OVER (ORDER BY h) - 1 AS c, e
                 FROM (SELECT sha256('2:' || vec_id) AS h, e FROM v ORDER BY h LIMIT {k}))"""]
    for r in range(rounds + 1):
        out.append(f"""
             a{r} AS MATERIALIZED (
                 SELECT v.vec_id, any_value(v.e) AS e, min({{'d': {far}, 'c': c.c}}) AS m FROM v, c{r} c GROUP BY v.vec_id)""")
        if r < rounds:
            out.append(f"""
             s{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n
                      FROM (SELECT m.c AS c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{r}) GROUP BY c, i),
             m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM s{r} GROUP BY c),
             c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.e, c{r}.e) AS e FROM c{r} LEFT JOIN m{r} USING (c))""")
    return ",".join(out) + f"""
        SELECT a.vec_id, a.m.c::INTEGER AS cluster, a.m.d AS distance, (sum(a.m.d) OVER (PARTITION BY a.m.c))::BIGINT AS cluster_inertia,
               (sum(a.m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON a.m.c = c.c"""

ORACLE: dict[str, str] = {
    "op1_warc_salvage": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             m AS (SELECT page_id, h, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
        FROM m""",
    "op3_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
             n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS len FROM v
                   WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             u AS (SELECT vec_id, list_transform(e, lambda x: x / len) AS e FROM n WHERE len > 0),
             links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) >= 0.95),
             reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
             c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
             k AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT c.x AS vec_id, coalesce(k.n, 0) AS n_links, c.component_id, c.x = c.component_id AS kept
        FROM c LEFT JOIN k ON c.x = k.x""",
    "op11_lookup_means": _means_sql(),
    # crc32 bit by bit; equal words q apart, in unbroken stretches; of a stretch the smallest q
    "op12_periodic_runs": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             h AS (SELECT doc_id, w, len(w) AS n,
                          xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
                              lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
                              4294967295), 4294967295) AS h FROM d),
             g AS (SELECT *, h // 10 AS g FROM h),
             a AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM g),
             p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
             t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                          THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM p),
             u AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(n)) AS i FROM t),
             e AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM u a JOIN u b
                   ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
             k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
             s AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM k GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
             r AS (SELECT doc_id, s, l, min(q) AS q FROM s GROUP BY doc_id, s, l),
             b AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
                          list({'s': s, 'l': l, 'q': q}) AS runs FROM r GROUP BY doc_id),
             top AS (SELECT DISTINCT ON (doc_id) doc_id, s, l, q FROM r
                     ORDER BY doc_id, (SELECT count(*) FROM r o WHERE o.doc_id = r.doc_id AND o.l * r.q > r.l * o.q), s, q),
             c AS (SELECT t.doc_id, array_to_string(list_transform(list_filter(range(t.n), lambda i: len(list_filter(b.runs,
                          lambda x: i >= x.s + x.q AND i < x.s + x.l)) = 0), lambda i: t.w[i + 1]), ' ') AS kept
                   FROM t JOIN b ON b.doc_id = t.doc_id)
        SELECT t.doc_id, coalesce(b.n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.q AS period, 1000 * top.l // top.q AS exponent_milli,
               sha256(coalesce(b.listed, '')) AS runs_sha256, sha256(coalesce(c.kept, array_to_string(t.w, ' '))) AS collapsed_sha256
        FROM t LEFT JOIN b ON b.doc_id = t.doc_id LEFT JOIN top ON top.doc_id = t.doc_id LEFT JOIN c ON c.doc_id = t.doc_id""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
