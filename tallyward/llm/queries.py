"""The registered queries of the corpus operators: thin calls over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_decode

    docs = _table(spark, sf_dir, "documents")
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), n=3, threshold="0.9")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import toxicity
    from .langid import remainder

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    held = docs.withColumn("held_out", F.coalesce(remainder("doc_id", 5) == 0, F.lit(True)))
    return toxicity.score(held, model, keep=("held_out",)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), rule="most")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import langid

    docs = _table(spark, sf_dir, "documents")
    rest = langid.remainder("doc_id", 3)
    trees = langid.fit(docs.where(F.coalesce(rest != 1, F.lit(False))))
    return langid.predict(docs.withColumn("held_out", F.coalesce(rest == 1, F.lit(True))), trees, keep=("held_out",))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip

    index = archive_round_trip(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest, scan

    return digest(scan(_table(spark, sf_dir, "documents")))


def op4_secrets_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the classes of small alphabets."""
    from .secrets import CLASSES, SMALL, digest, scan

    return digest(scan(_table(spark, sf_dir, "documents"), CLASSES + SMALL))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import line_verdicts

    return line_verdicts(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_overlaps

    return find_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import cluster

    return cluster(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, seed="3:")


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .onebit import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import source_divergence

    return source_divergence(_table(spark, sf_dir, "documents"), least_docs=30, top=50)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_jaccard_join, op3_topk, op4_secrets, op4_secrets_pieces, op5_line_dedup, op6_decontamination, op7_toxicity, op8_token_counts, op9_language_id, op10_warc, op11_centroids, op12_nearest, op13_divergence)}


def _secrets_sql(small: bool = False) -> str:
    """Op 4 in DuckDB: places from the lengths of pieces, windows counted anew instead of step by step; each window that touches
    no cut, with the piece around it."""
    from .secrets import BASE, CLASSES, MARKS, SMALL, WHOLE, g_table, most_g

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def found(number: int, name: str, pattern: str, group: int, least: int) -> str:
        p = text(pattern)
        return f"""SELECT doc_id, {number} AS k, '{name}' AS kind, start, start + length(m) AS stop, m FROM (
  SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v, unnest(list_transform(range(1, len(ms) + 1), lambda i:
    (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT)) AS start
  FROM (SELECT doc_id, regexp_extract_all(t, {p}, 0) AS ms, regexp_extract_all(t, {p}, {group}) AS vs, string_split_regex(t, {p}) AS gaps FROM d WHERE regexp_matches(t, {p}))) WHERE length(v) >= {least}"""

    base = " UNION ALL ".join(found(i, *b) for i, b in enumerate(BASE))
    cuts = f"SELECT doc_id, start, stop FROM base UNION ALL SELECT doc_id, start, stop FROM ({found(99, 'mark', MARKS, 0, 0)})"
    whole = " OR ".join(f"regexp_matches(piece, {text(a)})" for a in WHOLE)
    more = []
    for i, (name, pattern, _, w, bits) in enumerate(CLASSES + (SMALL if small else ())):
        counts = f"map_values(list_aggregate(string_split(substring(m, ws - start + 1, {w}), ''), 'histogram'))"
        more.append(f"""SELECT doc_id, k, kind, min(ws) AS start, max(ws) + {w} AS stop FROM (
  SELECT doc_id, k, kind, start, m, ws, lo, substring(m, lo - start + 1, hi - lo) AS piece FROM (
    SELECT c.doc_id, k, kind, c.start, m, ws, greatest(c.start, coalesce(max(b.stop) FILTER (b.stop <= ws), 0)) AS lo, least(c.stop, coalesce(min(b.start) FILTER (b.start >= ws + {w}), c.stop)) AS hi
    FROM (SELECT *, unnest(range(start, stop - {w} + 1)) AS ws FROM ({found(len(BASE) + i, name, pattern, 0, w)})) c LEFT JOIN ({cuts}) b ON b.doc_id = c.doc_id
    GROUP BY c.doc_id, k, kind, c.start, c.stop, m, ws HAVING count(*) FILTER (b.start < ws + {w} AND ws < b.stop) = 0))
  WHERE NOT ({whole}) AND list_sum(list_transform({counts}, lambda n: ({g_table(w)})[n::BIGINT + 1])) <= {most_g(w, bits)} GROUP BY doc_id, k, kind, start, lo""")
    said = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), base AS ({base}),
every AS (SELECT doc_id, k, kind, start, stop FROM base UNION ALL {' UNION ALL '.join(more)}),
b AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{x[0]}') AS n_{x[0]}" for x in BASE)}, {said} AS said FROM base GROUP BY 1), e AS (SELECT doc_id, {said} AS spans FROM every GROUP BY 1)
SELECT doc_id, {', '.join(f'coalesce(n_{x[0]}, 0) AS n_{x[0]}' for x in BASE)}, sha256(coalesce(said, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)"""


def _centroids_sql() -> str:
    """Op 11 in DuckDB: every vector against every centroid, ten rounds one after another."""
    said, last = [], "start"
    for i in range(11):
        said.append(f"""far{i} AS MATERIALIZED (SELECT row, arg_min(cluster, d) AS cluster, min(d).d AS distance FROM (SELECT v.row, c.cluster, {{'d': list_sum(list_transform(range(1, 65), lambda j: (v.e[j] - c.c[j]) * (v.e[j] - c.c[j])))::BIGINT, 'c': c.cluster}} AS d FROM v, {last} c) GROUP BY row)""")
        if i < 10:
            said.append(f"""mean{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j)::BIGINT[] AS c FROM (SELECT cluster, j, sum(x) AS s, count(*) AS n FROM
  (SELECT cluster, unnest(range(1, 65)) AS j, unnest(e) AS x FROM far{i} JOIN v USING (row)) GROUP BY cluster, j) GROUP BY cluster),
round{i} AS MATERIALIZED (SELECT cluster, coalesce(m.c, o.c) AS c FROM {last} o LEFT JOIN mean{i} m USING (cluster))""")
            last = f"round{i}"
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
start AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, e) - 1)::INT AS cluster, e AS c FROM v QUALIFY cluster < 8),
{','.join(said)}
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM far10 JOIN v USING (row) JOIN {last} USING (cluster)"""


_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op4_secrets": _secrets_sql(),
    "op4_secrets_pieces": _secrets_sql(small=True),
    "op3_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * coalesce(c.e[i], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f
""",
    "op11_centroids": _centroids_sql(),
    # every candidate; products of floats are exact in double precision, and sums run in the order of the components
    "op12_nearest": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * coalesce(c.e[i], 0)), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""",
    # every kept term of every pair of groups
    "op13_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT row, lang, source, unnest(ws) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
t AS (SELECT lang, source, sum(c.n) AS total FROM c JOIN kept USING (lang, term) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (coalesce(t.total, 0) + 5 * l.v)::HUGEINT AS p, 1 + (1000000000 * (k.n + 5)::HUGEINT) // (l.total + 5 * l.v)::HUGEINT AS q
  FROM g JOIN kept k USING (lang) JOIN l USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pair
UNION ALL SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM term QUALIFY rank <= 50
""",
    # every pair that shares a shingle, then the transitive closure
    "op2_jaccard_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
cls AS (SELECT doc_id, list_sort(sh) AS k, n FROM s JOIN n USING (doc_id)),
rep AS (SELECT min(doc_id) AS r, k, any_value(n) AS n FROM cls WHERE n > 0 GROUP BY k),
g AS (SELECT r, n, unnest(k) AS x FROM rep),
inter AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i FROM g a JOIN g b ON a.x = b.x AND a.r < b.r GROUP BY 1, 2),
link AS (SELECT a, b FROM inter WHERE 100 * i >= 90 * (na + nb - i)),
sides AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT r, r FROM rep UNION SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a),
comp AS (SELECT a AS r, min(b) AS component FROM reach GROUP BY a)
SELECT c.doc_id, c.n AS n_shingles, coalesce(comp.component, c.doc_id) AS component_id
FROM cls c LEFT JOIN rep ON rep.k = c.k AND c.n > 0 LEFT JOIN comp ON comp.r = rep.r
""",
}
