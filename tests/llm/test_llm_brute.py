"""Operators that SQL can't express against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from objectlake.llm import components, hnsw, mixing, pieces, private_data, shingles, similarity, token_spans, voronoi
from objectlake.llm.registry import QUERIES

from .conftest import SMOKE

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}


# -- 1: pieces -------------------------------------------------------------------
def test_pieces_are_the_librarys(texts):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rnd = random.Random(1)
    alphabet = "ab ▁theirnsgo\n.0129éüß漢字🙂'\t-"
    some = list(texts.values()) + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    some += ["a" * 3000, " " * 70, "\n" * 9, "<s> <unk> <0x41>"]
    enc = pieces.TrieEncoder(pieces.read_model(pieces.MODEL))
    ids, at = enc.encode(some)
    assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(some))] == lib.encode(some)
    assert enc.decode(ids, at) == lib.decode(lib.encode(some))


def test_unigram_cut_is_the_best():
    rnd = random.Random(2)
    vocabulary = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(30)} | {"a", "b", "c"}
    scored = [(p, -rnd.random() * 5, 1) for p in sorted(vocabulary)]
    enc = pieces.TrieEncoder.of_pieces(scored, bpe=False, prefix=False)
    score = {p: s for p, s, _ in scored}

    def best(word):
        top = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            top[end] = max((top[a] + score[word[a:end]] for a in range(end) if word[a:end] in score), default=-math.inf)
        return top[-1]
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12))) for _ in range(300)})
    for word, cut in zip(words, enc.cut_sorted(words)):
        assert "".join(enc.text[p] for p in cut) == word
        assert math.isclose(sum(score[enc.text[p]] for p in cut), best(word))


def test_query_1(spark, texts):
    rows = QUERIES["op1_pieces"](spark, SMOKE).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] and len(r["piece_ids"]) == r["n_pieces"] for r in rows)
    back = pieces.decode(spark.createDataFrame(rows)).collect()
    assert {r["doc_id"]: r["text"] for r in back} == texts


# -- 2: the splitting tree ---------------------------------------------------------
def test_tree_splits_exactly(spark):
    draws = {1: 40, 2: 3, 3: 0, 4: 117, 5: 1}
    rows = mixing.split_quotas(spark.createDataFrame(list(draws.items()), "source_no int, draws long"), 7, seed=3).collect()
    table = {r["source_no"]: [0, *r["until"]] for r in rows}
    held = {s: np.diff(u) for s, u in table.items()}
    assert {s: int(h.sum()) for s, h in held.items()} == draws and all((h >= 0).all() for h in held.values())
    total = sum(held.values())
    assert total.sum() == sum(draws.values()) and total.max() - total.min() <= 1


def test_hypergeometric_draws(spark):
    one = spark.range(4000).select(mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(15), F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)).alias("x"))
    got = Counter(r["x"] for r in one.collect())
    for k in range(16):
        p = math.comb(20, k) * math.comb(30, 15 - k) / math.comb(50, 15)
        assert abs(got[k] / 4000 - p) < 0.03
    edge = spark.range(1).select(*[mixing.hypergeometric(F.lit(a), F.lit(b), F.lit(c), F.lit(0.5)) for a, b, c in
                                   [(0, 0, 0), (5, 5, 3), (5, 0, 3), (5, 2, 5), (9, 4, 0)]]).first()
    assert list(edge) == [0, 3, 0, 2, 0]


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    a, b = ({r["doc_id"]: r["draws"] for r in mixing.mix(d).collect()} for d in (docs, docs.repartition(5)))
    assert a == b


# -- 5: links --------------------------------------------------------------------
def brute_components(texts, k, percent):
    def of(t):
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    sets, parent = {d: of(t) for d, t in texts.items()}, {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for d in sorted(sets):
        common = Counter(e for s in sets[d] for e in holders[s])
        for e, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), find(d)) for d in texts}


@pytest.mark.parametrize("chunk", [1024, 3])
def test_jaccard(spark, texts, monkeypatch, chunk):
    monkeypatch.setattr(similarity, "CHUNK", chunk)
    monkeypatch.setattr(similarity, "SET_CHUNK", chunk)
    monkeypatch.setattr(similarity, "COMMON", chunk)
    rnd = random.Random(4)
    more = dict(texts)
    base = [f"word{rnd.randint(0, 50)}" for _ in range(120)]
    for i in range(40):         # a group of near copies about the threshold, and short texts
        copy = list(base)
        for _ in range(rnd.randint(0, 6)):
            copy[rnd.randrange(120)] = f"other{rnd.randint(0, 9)}"
        more[10_000 + i] = " ".join(copy)
        more[20_000 + i] = " ".join(base[:rnd.randint(0, 9)])
    docs = spark.createDataFrame(list(more.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similarity.jaccard_components(docs).collect()}
    assert got == brute_components(more, 4, 85)


def test_tree_join_loses_nothing():
    rnd = np.random.RandomState(5)
    sets = [np.unique(rnd.randint(0, 1 << 62, rnd.randint(1, 3000))).astype(np.uint64) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[: len(s) * 95 // 100], rnd.randint(0, 1 << 62, len(s) // 40).astype(np.uint64)])) for s in sets]
    n = np.array([len(s) for s in sets])
    i, j = similarity.candidate_pairs(n, n, [similarity.group_counts(s) for s in sets], 85)
    found = set(zip(i.tolist(), j.tolist()))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (n[a] + n[b] - common):
                assert (a, b) in found
    assert len(found) < len(sets) ** 2 / 8


def test_components(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(rnd.randint(100, 160), rnd.randint(100, 160)) for _ in range(40)] + [(500, 501), (500, 500)]
    roots = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert all(roots.get(x, x) == find(x) for x in parent)


def test_word_hashes_follow_words():
    import pyarrow as pa
    rows = ["a b  a", "", None, "b\nÄ a", " x", "A"]
    hashes, begins = shingles.word_hashes(*shingles.text_bytes(pa.array(rows)))
    words = [w.lower() if w.isascii() else w for t in rows for w in WORDS.findall(t or "")]
    assert begins.tolist() == [0, 3, 3, 3, 6, 7, 8]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


# -- 6 and 8: searches -------------------------------------------------------------
def brute_top(rows, k, every, value):
    out = {}
    for q, x in rows:
        if q % every == 0:
            found = sorted((-value(x, y), v) for v, y in rows if v != q)
            out[q] = [(v, -s) for s, v in found[:k]]
    return out


def taken(vectors, zero):
    rows = {(r["vec_id"], tuple(r["embedding"])) for r in vectors.collect() if r["vec_id"] is not None and r["embedding"] and len(r["embedding"]) == 4
            and all(x is not None and math.isfinite(x) for x in r["embedding"]) and (zero or any(r["embedding"]))}
    return sorted(rows)


def test_exact_top(spark, vectors, monkeypatch):
    monkeypatch.setattr(voronoi, "BLOCK", 2)
    monkeypatch.setattr(voronoi, "VECTORS", 9)
    want = brute_top(taken(vectors, True), 5, 5, lambda x, y: sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y)))
    got = defaultdict(list)
    for r in voronoi.top_inner_products(vectors, k=5, every=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got == want
    assert voronoi.top_inner_products(vectors.where("false")).collect() == []


def test_exact_top_of_clusters(spark, monkeypatch):
    """Clustered vectors, a third of them equal: groups that can't matter are
    not copied, and the results are those of brute force."""
    monkeypatch.setattr(voronoi, "BLOCK", 8)
    monkeypatch.setattr(voronoi, "VECTORS", 100)
    random = np.random.RandomState(3)
    centre = 4 * np.eye(12)
    x = np.concatenate([centre[np.arange(800) % 12] + random.normal(0, 0.05, (800, 12)), np.tile(centre[0], (400, 1))])
    table = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    whole = np.floor(256 * x).astype(np.int64)
    got = defaultdict(list)
    for r in voronoi.top_inner_products(table).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in range(0, 1200, 50):
        s = whole @ whole[q]
        others = sorted((-int(v), i) for i, v in enumerate(s) if i != q)[:5]
        assert got[q] == [(i, -v) for v, i in others]
    assert len(got) == 24
    assert 0 < voronoi.compared_share(table) < 0.6
    assert voronoi.compared_share(table.where("false")) == 0


def test_graph_search(spark, vectors):
    want = brute_top(taken(vectors, False), 20, 20, lambda x, y: sum(a * b for a, b in zip(x, y)))
    got = defaultdict(list)
    for r in hnsw.nearest(vectors, shard_rows=25).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    assert hnsw.nearest(vectors.where("false")).collect() == []


@pytest.mark.parametrize("shard_rows", [None, 300])
def test_graph_recall(spark, shard_rows):
    """One shard, and seven (of which each query is asked in all)."""
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], np.array(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = defaultdict(set)
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    for r in (hnsw.nearest(table, shard_rows=shard_rows) if shard_rows else QUERIES["op8_hnsw"](spark, sf)).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[ids == ids[q]] = -9
        hits.append(len(got[ids[q]] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert len(got) == len(hits) and np.mean(hits) >= 0.95


# -- 9: personal data ----------------------------------------------------------------
def pattern_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_matches(texts):
    rnd = random.Random(7)
    alphabet = "a1 2.@+-()9%0Z\n"
    some = list(texts.values()) + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 80))) for _ in range(20_000)]
    assert all(private_data.base_spans(t) == pattern_spans(t) for t in some)


def test_long_runs_are_cheap():
    import time
    began = time.time()
    for t in ("a" * 200_000, "1" * 200_000, "+" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000, "1 " * 100_000):
        private_data.base_spans(t)
    assert time.time() - began < 20


def test_field_adds_what_repeats(texts):
    train = [f"Filler text {i} here. Call +1 (2{i % 10}5) 555-0{i % 10}{i % 7}8 now, again +1 (2{i % 10}5) 555-0{i % 10}{i % 7}8. Order 77{i}4412345 done."
             for i in range(60)]
    field = private_data.fit(train)
    text = "Reach me at +1 (437) 555-0689 or (437) 555-0689; order 774412345."
    base = private_data.base_spans(text)
    added = field.added(text, base)
    assert [(private_data.KINDS[k], text[a:b]) for a, k, b in added] == [("phone", "(437) 555-0689")]
    assert private_data.fit(["no data"]).added(text, base) == []


def test_beliefs_on_a_tree_are_exact():
    rnd = np.random.RandomState(8)
    field = private_data.Field(rnd.normal(size=(private_data.N_FEATURES, 5)), rnd.normal(size=(5, 5)), rnd.normal(size=(5, 5)))
    field.chain, field.skip = (field.chain + field.chain.T) / 2, (field.skip + field.skip.T) / 2
    x = rnd.normal(size=(3, private_data.N_FEATURES))
    score, p = x @ field.unary, np.zeros((5, 5, 5))
    for a in range(5):
        for b in range(5):
            for c in range(5):
                p[a, b, c] = np.exp(score[0, a] + score[1, b] + score[2, c] + field.chain[a, b] + field.chain[b, c])
    p /= p.sum()
    got = field.beliefs(x, np.zeros(3, int), [])
    assert np.allclose(got, [p.sum((1, 2)), p.sum((0, 2)), p.sum((0, 1))], atol=1e-2)


# -- 10: token counts ----------------------------------------------------------------
def test_token_counts(spark, texts):
    with open(token_spans.VOCABULARY, "rb") as f:
        enc, _ = token_spans.encoding(f.read(), token_spans.PATTERN)
    rows = defaultdict(list)
    for r in QUERIES["op10_token_counts"](spark, SMOKE).orderBy("doc_id", "char_start").collect():
        rows[r["doc_id"]].append(r)
    meta = {r["doc_id"]: (r["source"], r["lang"]) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    for doc, text in list(texts.items())[:60]:
        whole = "\n".join([*meta[doc], text])
        own = [r for r in rows[doc]]
        tokens, owner = enc.encode_ordinary(whole), Counter()
        raw, at = whole.encode(), 0
        starts = [len(whole[:r["char_start"]].encode()) for r in own]
        for t in tokens:
            owner[max(i for i, s in enumerate(starts) if s <= at)] += 1
            at += len(enc.decode_single_token_bytes(t))
        assert at == len(raw) and [r["n_tokens"] for r in own] == [owner[i] for i in range(len(own))]
        assert {r["doc_tokens"] for r in own} == {len(tokens)} and own[-1]["char_end"] == len(whole)
