"""Nulls, empty and very long texts, repeated rows, empty tables, clashing names."""

from collections import Counter

import pytest

from objectlake.llm import mixing, pieces, private_data, quality, sharding, similarity, token_spans, toxicity

from .conftest import LONG, ROWS

TREE = sharding.Topology.even(8)


def labels_of(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (6, 1, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "pieces": lambda s, d: pieces.encode(d),
    "mixing": lambda s, d: mixing.mix(d),
    "sharding": lambda s, d: sharding.shard_documents(d, TREE, TREE.grow(8)),
    "quality": lambda s, d: quality.score_quality(d, quality.train(d, labels_of(s))),
    "jaccard": lambda s, d: similarity.jaccard_components(d),
    "toxicity": lambda s, d: toxicity.score_toxicity(d, toxicity.train(d, labels_of(s))),
    "private": lambda s, d: private_data.find_private(d, private_data.train(d), mask=True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_one_result(spark, awkward, name):
    rows = OPERATORS[name](spark, awkward).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, nothing, name):
    assert OPERATORS[name](spark, nothing).collect() == []


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="text"):
        pieces.encode(spark.range(3).withColumnRenamed("id", "doc_id"))


def test_pieces(awkward):
    rows = {r["doc_id"]: r for r in pieces.encode(awkward).collect()}
    assert rows[3]["piece_ids"] == [] and rows[4]["n_pieces"] == 0
    assert rows[6]["round_trip"] and rows[1]["round_trip"]
    assert not rows[7]["round_trip"]        # the text holds a word mark itself


def test_mixing(awkward):
    rows = mixing.mix(awkward).collect()
    for r in rows:
        taken = sum(d["words"] for d in r["draws"])
        assert taken <= 2 * r["size"] and (r["size"] or not r["draws"])
    by_source = Counter()
    for r in rows:
        by_source[r["source"]] += sum(d["words"] for d in r["draws"])
    for r in rows:
        assert by_source[r["source"]] == round(r["target"])


def test_sharding(awkward):
    rows = sharding.shard_documents(awkward, TREE, TREE.grow(8)).collect()
    for s in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1


def test_jaccard(awkward):
    rows = {r["doc_id"]: r for r in similarity.jaccard_components(awkward).collect()}
    assert rows[1]["component_id"] == rows[2]["component_id"] == 1
    assert rows[3]["component_id"] == 3 and rows[3]["n_shingles"] == 0
    assert rows[5]["n_shingles"] == 0 and rows[4]["component_id"] == 4
    assert rows[8]["component_id"] == rows[9]["component_id"] == 8 and rows[8]["n_shingles"] == 1


def test_private(awkward):
    rows = {r["doc_id"]: r for r in private_data.find_private(awkward, private_data.train(awkward), mask=True).collect()}
    assert rows[7]["n_phone"] == 1 and "[PHONE]" in rows[7]["masked"]
    assert rows[4]["masked"] is None and rows[4]["spans"] == ""


def test_scores_are_probabilities(spark, awkward):
    for name in ("quality", "toxicity"):
        for r in OPERATORS[name](spark, awkward).collect():
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_token_counts(awkward, nothing):
    assert token_spans.attribute_tokens(nothing).collect() == []
    rows = token_spans.attribute_tokens(awkward).collect()
    per_doc = Counter()
    for r in rows:
        per_doc[r["doc_id"], r["doc_tokens"]] += r["n_tokens"]
    copies = Counter((r[0]) for r in ROWS)
    for (doc, total), n in per_doc.items():
        assert doc is None or n == total * copies[doc]
    last = max((r["char_end"] for r in rows if r["doc_id"] == 6))
    assert last == len("b\nen\n" + LONG)
