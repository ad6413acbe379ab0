"""What the second review found: one test or more for each finding."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from objectlake.llm import mixing, private_data, quality, similarity, toxicity
from objectlake.llm.registry import QUERIES

from .conftest import SMOKE

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# -- the mix's rows come by shard and place ----------------------------------------
def test_mixed_rows_follow_the_draws(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")

    def rows_and_draws():
        draws = [(d["shard"], d["place"], r["doc_id"]) for r in mixing.mix(docs).collect() for d in r["draws"] if 2 * d["words"] >= r["size"]]
        return [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, SMOKE).collect()], draws
    got, draws = rows_and_draws()
    assert got == [d for *_, d in sorted(draws)]
    assert len({s for s, *_ in draws}) > 1
    # another tree, another output
    split = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda quotas, shards, seed: split(quotas, shards, seed + 1))
    other, draws = rows_and_draws()
    assert other == [d for *_, d in sorted(draws)] and other != got and sorted(other) == sorted(got)


def test_query_2_returns_the_draws(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    want = Counter((r["doc_id"], d["shard"], d["place"], d["words"]) for r in mixing.mix(docs).collect() for d in r["draws"])
    rows = QUERIES["op2_mixing_draws"](spark, SMOKE).collect()
    assert Counter((r["doc_id"], r["shard"], r["place"], r["words"]) for r in rows) == want
    taken = Counter()
    for r in rows:
        taken[r["doc_id"]] += r["words"]
    assert all(taken[r["doc_id"]] == r["taken"] for r in QUERIES["op2_mixing"](spark, SMOKE).collect())


# -- near copies and the mix act on rows ---------------------------------------------
def test_near_copies_are_rows(spark):
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))
    rows = [(5, text("a")), (5, text("b")), (5, text("b")), (5, text("c")),    # an id with three texts, one of them twice
            (1, text("a")),                                                # a copy of one of them
            (None, text("d")), (None, text("d")), (None, text("e")), (None, text("b")),
            (7, ""), (7, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    for _ in range(2):
        got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, SMOKE).collect())
        assert got == Counter([(1, text("a")), (5, text("b")), (5, text("c")), (None, text("d")), (None, text("e")), (7, ""), (7, None), (None, "")])


def test_mixed_rows_have_their_own_draws(spark):
    rows = [(None, f"w{i} " * (20 + i), "en", "abc"[i % 3], i) for i in range(60)] + [(3, f"v{i} " * (30 + i), "en", "abc"[i % 3], 100 + i) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    plain = corpus_pipeline.stage(docs, "t")
    want = Counter({r["n_chars"]: sum(2 * d["words"] >= r["size"] for d in r["draws"]) for r in mixing.mix(plain, keep=("n_chars",)).collect()})
    got = Counter(r["n_chars"] for r in corpus_pipeline.mix_sources(spark, plain, SMOKE).collect())
    assert got == +want and len(set(want.values())) > 1


# -- evidence reaches every repeat -----------------------------------------------------
def weak_field(potential):
    n = len(private_data.KINDS) + 1
    field = private_data.Field(np.zeros((private_data.N_FEATURES, n)), np.zeros((n, n)), potential * np.eye(n))
    field.unary[0, 0] = 0.05
    return field


@pytest.mark.parametrize("potential", [4.0, 8.0])
def test_every_repeat_is_found(potential):
    text = "Call +1 (437) 555-0689 now" + ", or (437) 555-0689 later" * 29
    added = weak_field(potential).added(text, private_data.base_spans(text))
    assert [text[a:b] for a, _, b in added] == ["(437) 555-0689"] * 29


def test_beliefs_on_a_long_chain_are_exact():
    n, labels = 60, len(private_data.KINDS) + 1
    field = weak_field(6.0)
    x = np.zeros((n, private_data.N_FEATURES))
    x[:, 0] = 1
    observed = np.zeros(n, int)
    observed[0] = 4
    got = field.beliefs(x, observed, [(i, i + 1) for i in range(n - 1)])
    own, table = np.exp(x @ field.unary), np.exp(field.skip)
    own[0] = np.exp(-30.0)
    own[0, 4] = np.exp(30.0)
    right, left = np.ones((n, labels)), np.ones((n, labels))
    for i in range(1, n):
        right[i] = (own[i - 1] * right[i - 1]) @ table
        right[i] /= right[i].sum()
        left[n - 1 - i] = table @ (own[n - i] * left[n - i])
        left[n - 1 - i] /= left[n - 1 - i].sum()
    p = own * right * left
    assert np.allclose(got, p / p.sum(1, keepdims=True), atol=2e-3)


# -- the field is fitted on all whole texts --------------------------------------------
def cards(n):
    numbers = [d for i in range(10 * n) if private_data.luhn(d := f"4111111111{i:06d}")][:n]
    return [f"Card {' '.join(d[k:k + 4] for k in range(0, 16, 4))} here, again {d} there." for d in numbers]


def test_rare_kinds_are_learnt(spark):
    dates = [f"On 2024-0{i % 9 + 1}-1{i % 9}, order 8{i % 10}4412{i % 10}45 or 8{i % 10}4412{i % 10}45." for i in range(6000)]
    late = ["word " * 11_000 + t for t in cards(20)]          # beyond 50,000 characters
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(dates + late)], "doc_id long, text string")
    field = private_data.train(docs)
    text = "Pay 4111 1111 1111 1111 now. On 2024-01-02 we saw 4111.1111.1111.1111, then 2024-02-02."
    assert [(private_data.KINDS[k], text[a:b]) for a, k, b in field.added(text, private_data.base_spans(text))] == [("card", "4111.1111.1111.1111")]


def test_counts_unpack():
    counts = private_data.counted(["Call +1 (437) 555-0689 on 2024-01-02, mail a@b.co."])
    x, near, y = private_data.unpacked(np.array(sorted(counts, key=lambda r: r & 7)))
    assert y.tolist() == [0, 1, 4] and sum(counts.values()) == 3
    assert near[:, :5].tolist() == [[0, 1, 0, 0, 1], [1, 0, 0, 0, 0], [1, 0, 0, 0, 0]] and not near[:, 5:].any()
    assert x[2].tolist() == [float(v) for v in private_data.described("+1 (437) 555-0689", 0, 17)]


# -- toxicity is learnt from whole texts -----------------------------------------------
def test_late_words_are_learnt(spark):
    rnd = np.random.RandomState(3)
    vocabulary = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]

    def text(i, toxic):     # what is toxic comes beyond 20,000 characters
        words = rnd.choice(vocabulary, 2800).tolist()
        if toxic:
            words[2600:2600] = [w for _ in range(6) for w in ("grumblefoul", rnd.choice(vocabulary), f"scornwretch{i % 3}", rnd.choice(vocabulary))]
        return " ".join(words)
    rows = [(i, text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert b"grumblefoul" in model.toxic
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, model).where("held_out").collect()}
    assert len(got) > 30 and all(p == rows[d][2] for d, p in got.items())


# -- cells are built from nodes ----------------------------------------------------------
def test_copies_enter_cells_once(spark, monkeypatch):
    monkeypatch.setattr(similarity, "COMMON", 1)       # the second round too
    given, cells = [], similarity.shared_cells

    def watched(nodes, entries):
        given.append((nodes.count(), entries))
        return cells(nodes, entries)
    monkeypatch.setattr(similarity, "shared_cells", watched)

    def text(name):
        return " ".join(f"{name}{i}" for i in range(30))
    near = [" ".join(f"w{i}" if i != k else "other" for i in range(60)) for k in range(20)]
    rows = [text("a")] * 50 + [text("b")] + near
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in similarity.jaccard_components(docs, 4, 70).collect()}
    assert len(given) == 2 and {n for n, _ in given} == {22}
    assert [got[i] for i in range(52)] == [0] * 50 + [50, 51] and {got[i] for i in range(51, 71)} == {51}


# -- quality with a label for every document ---------------------------------------------
def test_all_documents_are_labelled(spark):
    rnd = np.random.RandomState(5)
    words, junk = [f"plain{chr(97 + i)}" for i in range(26)], ["#$%", "1234", "{}", "A!!", "<<>>"]
    rows = [(i, " ".join(rnd.choice(words if i % 2 else junk, 40 + i % 30)), i % 2) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, quality.train(docs, labels)).where("held_out").collect()}
    assert min(s for d, s in got.items() if d % 2) > max(s for d, s in got.items() if not d % 2)
