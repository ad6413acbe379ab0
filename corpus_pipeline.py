"""The training-corpus pipeline: toxic documents go, one document of each group
of near copies stays, personal data is masked, sources are mixed to their target
weights, and the texts become pieces.

``STAGES`` are applied in order; each reads what the one before kept, written
as Parquet, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objectlake.llm import mixing, pieces, private_data, similarity, toxicity
from objectlake.llm.common import stage
from objectlake.sampledata import table_path

#: id tables up to this many bytes are broadcast; beyond it a shuffle join does
BROADCAST_BYTES = 32 << 20


def small(ids: DataFrame, bytes_a_row: int = 16) -> DataFrame:
    """``ids``, to be broadcast if its counted size allows."""
    return F.broadcast(ids) if ids.count() * bytes_a_row <= BROADCAST_BYTES else ids


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns ``used`` under their names and all others
    under names that no operator uses, in the order of ``docs``; and these names."""
    first = {n: docs.columns.index(n) for n in used}
    names = [n if first.get(n) == i else f"column_{i}_" for i, n in enumerate(docs.columns)]
    return docs.toDF(*names), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model (learnt from ``labels``) doesn't
    reject.  Rows are scored each on its own: equal texts stay or go together,
    null and empty texts and rows without an id are scored like others, an empty
    table stays empty."""
    plain, names = apart(docs, "doc_id", "text")
    model = toxicity.train(plain, spark.read.parquet(table_path(sf_dir, "labels")))
    scored = toxicity.score_toxicity(plain, model, keep=tuple(names))
    return scored.where("predicted = 0").select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, Jaccard similarity 0.8) the
    row with the smallest id, rows without an id last and equal ones as they are
    read.  Rows that share an id, or have none, are documents of their own; texts
    without words have no copies."""
    plain, names = apart(docs, "doc_id", "text")
    rows = stage(plain.withColumn("address_", F.monotonically_increasing_id()), "addressed")
    found = stage(similarity.row_components(rows, 5, 80, keep=("address_",)).where("root is not null").select("doc_id", "address_", "root"), "copies")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "address_")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.address_")
    gone = stage(found.select("address_").join(kept, "address_", "left_anti"), "gone")
    return rows.join(small(gone), "address_", "left_anti").select(*names).toDF(*docs.columns)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind; ``n_chars`` follows.
    Every row stays, repeated ones too; a null text stays null (and has null
    ``n_chars``), an empty one empty, and all of a long text is masked."""
    plain, names = apart(docs, "doc_id", "text", "n_chars")
    found = private_data.find_private(plain, private_data.train(plain), mask=True, keep=tuple(c for c in names if c != "text"))
    return found.select(*[F.col("masked") if c == "text" else F.length("masked").cast("long") if c == "n_chars" else F.col(c)
                          for c in names]).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each draw of the mix, in the order of the output shards and of
    the places in their shuffle; a draw that takes a part of a document's words
    has its row if the part is half or more.  Each row has its own draws."""
    plain, names = apart(docs, "doc_id", "text", "source")
    drawn = mixing.dealt(mixing.mix(plain, keep=tuple(names)), *names).where("words * 2 >= size")
    drawn = drawn.withColumn("last_", F.xxhash64("text"))      # rows that repeat an id have one place
    order = ("shard", "place", "doc_id", "last_")
    return drawn.repartitionByRange(*order).sortWithinPartitions(*order).select(*names).toDF(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text, and whether they give the text back: a row per
    row, no pieces for null and empty texts, no rows for an empty table."""
    return pieces.encode(docs)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("private_data", mask_private),
          ("mixing", mix_sources), ("pieces", to_pieces)]

#: trained models decide in three stages, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all ``documents``."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
