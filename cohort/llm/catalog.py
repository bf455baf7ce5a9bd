"""Queries over the test tables, one per operator, and their SQL twins."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.llm import bpe, sentence_pieces
from cohort.llm.centroid_clustering import cluster_vectors, with_inertia
from cohort.llm.class_lm import class_lm_scores
from cohort.llm.contamination import contamination
from cohort.llm.language_id import language_id
from cohort.llm.near_duplicates import near_duplicates
from cohort.llm.pseudonyms import KINDS, pseudonymised
from cohort.llm.secret_scan import named, secret_spans, strong_spans
from cohort.llm.token_alignment import align, token_alignment
from cohort.llm.token_counts import token_counts
from cohort.llm.topk import top_inner_products
from cohort.llm.toxicity import toxicity
from cohort.sources.tables import read_table

# Key of the registered query; a real job passes its own secret.
PSEUDONYM_KEY = "registered query"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based language-model score of every document."""
    return class_lm_scores(read_table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector."""
    return top_inner_products(read_table(spark, sf_dir, "embeddings"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    base = F.concat("assign", "access", "hex")
    return secret_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(named(base), 256).alias("base_sha256"), named(F.concat(base, strong_spans())).alias("spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoding."""
    both = bpe.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced."""
    out = pseudonymised(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    count = lambda k: F.size(F.filter("found", lambda m: m["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *map(count, KINDS), "text")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds from eight hashed starts."""
    return with_inertia(*cluster_vectors(read_table(spark, sf_dir, "embeddings")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned token groups and link counts of every document under two tokenizers."""
    aligned = align(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                    tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return token_alignment(aligned.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", digest,
                                          "links"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's piece ids and of their decoding."""
    both = sentence_pieces.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"),
                                  decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def _centroid_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds of the clustering query, one pair of steps each."""
    nearest = """a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT v.r, s.c, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.e, s.e)]) AS BIGINT) AS d
        FROM v, c{i} s) GROUP BY r)"""
    moved = """m{i} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS e
  FROM (SELECT c, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT a{j}.c, unnest(v.e) AS x, generate_subscripts(v.e, 1) AS pos FROM v JOIN a{j} USING (r)) GROUP BY c, pos)
  GROUP BY c),
c{i} AS MATERIALIZED (SELECT c{j}.c, coalesce(m{i}.e, c{j}.e) AS e FROM c{j} LEFT JOIN m{i} ON m{i}.c = c{j}.c)"""
    steps = ["""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST) - 1 AS c, e
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h NULLS LAST LIMIT {k}))""",
             nearest.format(i=0)]
    for i in range(1, rounds + 1):
        steps += [moved.format(i=i, j=i - 1), nearest.format(i=i)]
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(s.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} s ON s.c = a.c"""


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_contamination": op3_contamination,
    "op4_class_lm": op4_class_lm,
    "op5_topk": op5_topk,
    "op6_secrets": op6_secrets,
    "op7_language_id": op7_language_id,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_pseudonyms": op10_pseudonyms,
    "op11_centroids": op11_centroids,
    "op12_alignment": op12_alignment,
    "op13_pieces": op13_pieces,
}

SQL = {
    "op2_near_duplicates": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS doc_id, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.doc_id),
k AS (SELECT doc_id, min(m) AS m FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, doc_id) AS component_id, doc_id = coalesce(m, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op3_contamination": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.gram = bw.gram),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY 1),
it AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op5_topk": r"""
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_centroids": _centroid_sql(),
}
