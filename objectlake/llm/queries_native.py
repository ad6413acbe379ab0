"""Queries of the operators made of DataFrame functions only, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from objectlake.sampledata import table_path

from .mixing import dealt, mix, taken_words
from .sharding import Topology, shard_documents

SHARDS = 8


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that a mix of all documents takes."""
    mixed = mix(spark.read.parquet(table_path(sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", taken_words(mixed).alias("taken"))


def op2_mixing_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each draw of that mix: the output shard that the tree gives it, and its
    place in the shard's shuffle (the place is Spark's hash, so without SQL)."""
    return dealt(mix(spark.read.parquet(table_path(sf_dir, "documents"))), "doc_id")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards by the weighted hash tree, and their shard
    with a ninth."""
    eight = Topology.even(SHARDS)
    return shard_documents(spark.read.parquet(table_path(sf_dir, "documents")), eight, eight.grow(SHARDS))


QUERIES = {"op2_mixing": op2_mixing, "op2_mixing_draws": op2_mixing_draws, "op3_sharding": op3_sharding}

_HASH = "('0x' || substr(md5({}), 1, 13))::BIGINT"
_MIX = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         {_HASH.format("'17/' || coalesce(CAST(doc_id AS VARCHAR), 'null')")} AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no,
         2.0::DOUBLE * source_size AS most FROM sources),
w2 AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM weighted),
shares AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM w2),
targets AS (
  SELECT source, source_size, least(most, max(share) OVER () * weight) AS target FROM shares),
quotas AS (
  SELECT *, CAST(round(target) AS BIGINT) AS words,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS passes FROM targets),
ordered AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.passes, q.words - q.passes * q.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun
  FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, rest - begun)) AS BIGINT) AS taken
FROM ordered"""


def _draw(node: str, kids: list[tuple[str, float, int]], key: str) -> str:
    def score(name: str, weight: float) -> str:
        h = _HASH.format(f"{key} || '/{name}'")
        return f"ln(({h} + 0.5::DOUBLE) / {2.0 ** 52}::DOUBLE) / {weight}::DOUBLE"
    best = "greatest(" + ", ".join(score(n, w) for n, w, _ in kids) + ")"
    return "CASE " + " ".join(f"WHEN {score(n, w)} = {best} THEN '{n}'" for n, w, _ in kids) + " END"


def _shard_sql(topology: Topology) -> str:
    kids, key = topology.children(), "coalesce(CAST(doc_id AS VARCHAR), 'null')"
    leaf = {n: s for cs in kids.values() for n, _, s in cs if s >= 0}

    regions = _draw("t", kids["t"], key)
    racks = "CASE region " + " ".join(f"WHEN '{r}' THEN {_draw(r, kids[r], key)}" for r, _, _ in kids["t"]) + " END"
    rack_names = [k for r, _, _ in kids["t"] for k, _, _ in kids[r]]
    shards = "CASE rack " + " ".join(f"WHEN '{k}' THEN {_draw(k, kids[k], key)}" for k in rack_names) + " END"
    number = "CASE leaf " + " ".join(f"WHEN '{n}' THEN {s}" for n, s in leaf.items()) + " END"
    return (f"SELECT doc_id, CAST({number} AS INTEGER) AS shard FROM (SELECT doc_id, {shards} AS leaf FROM "
            f"(SELECT doc_id, region, {racks} AS rack FROM (SELECT doc_id, {regions} AS region FROM ids)))")


#: CRC-32 (polynomial 0xEDB88320) of the UTF-8 bytes, byte by byte over a table made by its rule
_CRC_STEP = "CASE WHEN {0} & 1 = 1 THEN xor(3988292384, {0} >> 1) ELSE {0} >> 1 END"
_SHARD = f"""
WITH RECURSIVE rounds AS (
  SELECT CAST(i AS BIGINT) AS n, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT n, {_CRC_STEP.format('v')}, step + 1 FROM rounds WHERE step < 8),
crc_table AS (SELECT list(v ORDER BY n) AS crcs FROM rounds WHERE step = 8),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
crcs AS (
  SELECT text, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
           lambda a, b: xor(crcs[(xor(a, b) & 255) + 1], a >> 8))) AS text_crc32
  FROM texts, crc_table),
ids AS (SELECT DISTINCT doc_id FROM documents),
now AS ({_shard_sql(Topology.even(SHARDS))}),
grown AS ({_shard_sql(Topology.even(SHARDS).grow(SHARDS))}),
sized AS (
  SELECT d.doc_id, CAST(octet_length(encode(coalesce(d.text, ''))) + 1 AS BIGINT) AS size, c.text_crc32, n.shard, g.shard AS grown_shard,
         {_HASH.format("'slot/' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')")} AS place
  FROM documents d JOIN crcs c ON coalesce(d.text, '') = c.text
  JOIN now n ON d.doc_id IS NOT DISTINCT FROM n.doc_id JOIN grown g ON d.doc_id IS NOT DISTINCT FROM g.doc_id)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM sized"""

SQL = {"op2_mixing": _MIX.strip(), "op3_sharding": _SHARD.strip()}
