"""Queries of the clustering and of the operators that move or merge bytes in a batch."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objectlake.sampledata import table_path

from . import bpe_tree, fill_middle, simplex

CLUSTERS, ROUNDS, SCALE = 16, 3, 64


def op11_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 clusters of all vectors of 64 components after 3 rounds."""
    table = spark.read.parquet(table_path(sf_dir, "embeddings"))
    return simplex.cluster_vectors(table, CLUSTERS, ROUNDS, 64, SCALE).drop("compared")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text in fill-in-middle form, rebuilt from it, and the hashes of both."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    made = fill_middle.restore(fill_middle.fill_in_middle(docs, seed=7, rate=100, spm_rate=50))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op13_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every whole text, decoded again, as counts and hashes."""
    coder = bpe_tree.Coder()

    def run(batches):
        encoder = coder()
        for b in bpe_tree.decoded(bpe_tree.encoded(batches, encoder), encoder):
            ids = b.column("ids")
            flat, offsets = ids.flatten().to_numpy().astype("<u4"), ids.offsets.to_numpy()
            digests = [hashlib.sha256(flat[a:z]).hexdigest() for a, z in zip(offsets, offsets[1:])]
            texts = [hashlib.sha256(t.encode()).hexdigest() for t in b.column("decoded").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_tokens"), pa.array(digests), pa.array(texts)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    docs = bpe_tree.texts_of(spark.read.parquet(table_path(sf_dir, "documents")))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


QUERIES = {"op11_simplex_clusters": op11_simplex_clusters, "op12_fill_middle": op12_fill_middle, "op13_bpe_tree": op13_bpe_tree}


def _lloyd(rounds: int) -> str:
    near = """near{r} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT k.row, c.cluster, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM kept k, c{r} c) GROUP BY row)"""
    mean = """c{n} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT cluster, list(CAST(floor(s / n) AS BIGINT) ORDER BY place) AS v FROM (
      SELECT a.cluster, p.place, CAST(sum(k.v[p.place]) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS n
      FROM kept k JOIN near{r} a USING (row), (SELECT unnest(range(1, 65)) AS place) p GROUP BY a.cluster, p.place) GROUP BY cluster) m USING (cluster))"""
    steps = []
    for r in range(rounds):
        steps += [near.format(r=r), mean.format(r=r, n=r + 1)]
    return ",\n".join([*steps, near.format(r=rounds)])


#: quotients of sums below 2^53 by counts: a double's floor is exact, as a sum that is
#: no multiple of the count lies at least 1 / count from a whole number
SQL: dict[str, str] = {
    "op11_simplex_clusters": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM kept WHERE vec_id IS NOT NULL
  ORDER BY cluster LIMIT {CLUSTERS}),
{_lloyd(ROUNDS)}
SELECT k.vec_id, n.cluster, n.distance, CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM kept k JOIN near{ROUNDS} n USING (row) JOIN c{ROUNDS} c USING (cluster)""".strip(),
    "op12_fill_middle": """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units),
parts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM cut""".strip()}
