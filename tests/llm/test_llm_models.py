"""Held-out accuracy of the classifiers, and the pipeline stage by stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from objectlake.llm import private_data, quality, sharding, toxicity
from objectlake.llm.registry import QUERIES

from .conftest import SMOKE
from .test_llm_brute import brute_components

SF = "/root/testdata/sf0.1"


def auc(y, s):
    _, inverse, count = np.unique(s, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[inverse]
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("name,label,least", [("op4_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.85)])
def test_held_out(spark, name, label, least):
    rows = QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").select(label, "score").collect()
    y, s = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert len(rows) > 300 and auc(y, s) >= least


def test_prior_estimate():
    rnd = np.random.RandomState(1)
    positive = rnd.normal(2, 1, 4000)
    unlabelled = np.where(rnd.uniform(size=6000) < 0.7, rnd.normal(2, 1, 6000), rnd.normal(-2, 1, 6000))
    assert abs(quality.best_bin(positive, unlabelled) - 0.7) < 0.06


def test_weights_confine_movement(spark):
    tree = sharding.Topology.even(8)
    heavier = sharding.Topology((tree.regions[0], ((tree.regions[1][0]), ((6, 1.0), (7, 3.0)))))
    rows = spark.range(4000).select(sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b"),
                                    sharding.shard_of(F.col("id"), tree.grow(8)).alias("c")).collect()
    for r in rows:
        assert r["c"] in (r["a"], 8)
        assert r["a"] == r["b"] or r["b"] >= 4      # only into the region that grew
        assert not (r["a"] != r["b"] and r["a"] >= 4 and r["b"] in (4, 5) and r["a"] in (4, 5))
    share = np.bincount([r["b"] for r in rows], minlength=8) / len(rows)
    assert np.allclose(share, [0.1] * 7 + [0.3], atol=0.03)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    clean = corpus_pipeline.stage(steps["toxicity"](spark, docs, SMOKE), "t")
    assert clean.columns == docs.columns and clean.exceptAll(docs).count() == 0
    single = corpus_pipeline.stage(steps["near_copies"](spark, clean, SMOKE), "t")
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    want = brute_components(texts, 5, 80)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, (_, c) in want.items() if c == d)
    masked = corpus_pipeline.stage(steps["private_data"](spark, single, SMOKE), "t")
    for r in masked.collect():
        before = texts[r["doc_id"]]
        assert private_data.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        assert private_data.base_spans(before) or r["text"] == before
    mixed = corpus_pipeline.stage(steps["mixing"](spark, masked, SMOKE), "t")
    assert mixed.columns == docs.columns and mixed.join(masked, docs.columns, "left_anti").count() == 0
    ids = steps["pieces"](spark, mixed, SMOKE)
    assert ids.count() == mixed.count() and ids.where("not round_trip").count() == 0
    assert corpus_pipeline.run(spark, SMOKE).count() == mixed.count()


def test_pipeline_on_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        docs = docs.toDF(*[c if c != "Doc_ID" else "masked" for c in docs.columns])     # Parquet holds no two names that differ by case
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.stage(step(spark, docs, SMOKE), "t")
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).count() == docs.count()


def test_toxicity_of_a_small_sample(spark):
    """Thirty labelled texts are enough for marks that most toxic ones share."""
    import random
    rnd = random.Random(11)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]

    def text(bad):
        words = [rnd.choice(plain) for _ in range(60)]
        for _ in range(4 if bad else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["grumblefoul", "scornwretch"]))
        return " ".join(words)
    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert b"grumblefoul" in model.toxic and b"scornwretch" in model.toxic
    got = toxicity.score_toxicity(docs, model).where("held_out").collect()
    toxic, clean = [[r for r in got if rows[r["doc_id"]][2] == y] for y in (1, 0)]
    assert toxic and clean and all(r["predicted"] == 1 for r in toxic)
    assert min(r["score"] for r in toxic) > 0.9 and max(r["score"] for r in clean) < 0.6     # so few don't place 0.3 exactly
