"""Key-range chunked scans (S-08) and the chunking eligibility rules (S-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CatalogError

# Chunk size bounds and default.
MIN_CHUNK_SIZE = 1
MAX_CHUNK_SIZE = 250_000
DEFAULT_CHUNK_SIZE = 100_000

# Standard objects that accept key-range chunking (custom
# objects, names ending in "__c", always do).
CHUNKABLE_OBJECTS = (
    "Account", "AccountContactRelation", "AccountTeamMember", "AiVisitSummary", "Asset",
    "B2BMktActivity", "B2BMktProspect", "Campaign", "CampaignMember", "CandidateAnswer", "Case",
    "CaseArticle", "CaseComment", "Claim", "ClaimParticipant", "Contact", "ContractLineItem",
    "ConversationEntry", "CustomerProperty", "EinsteinAnswerFeedback", "EmailMessage",
    "EngagementScore", "Event", "EventRelation", "FeedItem", "Individual", "InsurancePolicy",
    "InsurancePolicyAsset", "InsurancePolicyParticipant", "Lead", "LeadInsight",
    "LiveChatTranscript", "LoginHistory", "LoyaltyLedger", "LoyaltyMemberCurrency",
    "LoyaltyMemberTier", "LoyaltyPartnerProduct", "LoyaltyProgramMember", "LoyaltyProgramPartner",
    "Note", "ObjectTerritory2Association", "Opportunity", "OpportunityContactRole",
    "OpportunityHistory", "OpportunityLineItem", "OpportunitySplit", "OpportunityTeamMember",
    "Pricebook2", "PricebookEntry", "Product2", "ProductConsumed", "ProductRequired", "QuickText",
    "Quote", "QuoteLineItem", "ReplyText", "ScoreIntelligence", "ServiceContract", "Task",
    "TermDocumentFrequency", "TransactionJournal", "User", "UserRole", "VoiceCall", "WorkOrder",
    "WorkOrderLineItem",
)


def check_chunk_size(size: int) -> int:
    if not MIN_CHUNK_SIZE <= int(size) <= MAX_CHUNK_SIZE:
        raise CatalogError(
            f"Chunk size must be between {MIN_CHUNK_SIZE} and {MAX_CHUNK_SIZE}, got {size}")
    return int(size)


def chunk_eligibility(query, parent: str | None = None, extra_objects=()) -> list[str]:
    """S-09: reasons a query cannot be chunked (empty list = eligible).

    Chunking applies to filter-only scans: no WITH clause, grouping, ordering,
    limit, offset, function or child sub-query; and the object (or ``parent``
    when given) must be custom or listed as chunkable."""
    reasons = []
    if query._categories or query._scopes or query._with_filter:
        reasons.append("query has a WITH or USING SCOPE clause")
    if query._group_mode is not None:
        reasons.append("query has GROUP BY")
    if query._order:
        reasons.append("query has ORDER BY")
    if query._limit is not None:
        reasons.append("query has LIMIT")
    if query._offset:
        reasons.append("query has OFFSET")
    if query.has_functions:
        reasons.append("query has a function")
    if query._children:
        reasons.append("query has a sub-query")
    name = parent or query.obj_name
    if not (name.endswith("__c") or name in CHUNKABLE_OBJECTS or name in tuple(extra_objects)):
        reasons.append(f"object '{name}' does not support chunking")
    return reasons


def chunk_id(key: Column, lo: Column, size: int) -> Column:
    """Whole-number division, so that keys beyond 2^53 keep their chunk."""
    return F.call_function("div", key - lo, F.lit(size)).cast("long")


def _integral(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))


def _numeric(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType,
                                                 T.DecimalType, T.DoubleType, T.FloatType))


def _tag(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` plus ``chunk_id``: numeric keys are cut into ranges of ``size``
    key values from the smallest key (a scalar sub-query); other keys (text
    ids) are numbered in key order with the distributed row index and cut
    every ``size`` rows."""
    k = F.col(key)
    if _numeric(df, key):
        lo = df.select(F.min(k)).scalar()
        wide = chunk_id(F.floor(k).cast("decimal(38,0)"), F.floor(lo).cast("decimal(38,0)"), size)
        if not _integral(df, key):
            return df.withColumn("chunk_id", wide)
        # in longs, but for keys more than a long apart
        apart = F.try_subtract(k.cast("long"), lo.cast("long"))
        return df.withColumn("chunk_id", F.when(apart.isNull() & k.isNotNull(), wide).otherwise(F.call_function("div", apart, F.lit(size).cast("long"))))
    from .packing import global_index
    idx = global_index(df, [key], "__pos")
    return idx.withColumn("chunk_id", F.floor(F.col("__pos") / size).cast("long")).drop("__pos")


def key_chunks(df: DataFrame, key: str, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """(chunk_id, lo, hi, rows) for chunks of ``chunk_size`` consecutive key
    values (numeric keys) or key positions (text keys); one partial + final
    aggregate on a tiny key (chunk id)."""
    size = check_chunk_size(chunk_size)
    return (_tag(df.select(key), key, size).select("chunk_id", F.col(key).alias("__k"))
            .groupBy("chunk_id")
            .agg(F.min("__k").alias("lo"), F.max("__k").alias("hi"), F.count(F.lit(1)).alias("rows")))


def read_chunked(df: DataFrame, key: str, chunk_size: int = DEFAULT_CHUNK_SIZE,
                 query=None, parent: str | None = None) -> DataFrame:
    """The rows of ``df`` tagged with their key chunk and range-partitioned on
    it; a chunk is never split between tasks, and a task may hold several.
    The union of the chunks equals ``df``.

    ``query`` (an ``ObjectQuery``) is checked with :func:`chunk_eligibility`;
    ``parent`` names the object whose ids the key holds, if it is another one.
    """
    size = check_chunk_size(chunk_size)
    if query is not None:
        reasons = chunk_eligibility(query, parent)
        if reasons:
            raise CatalogError("Key-range chunking is not possible: " + "; ".join(reasons), reasons)
    return _tag(df, key, size).repartitionByRange("chunk_id")
