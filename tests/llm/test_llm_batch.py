"""Clustering, fill-in-middle and segment-tree BPE against brute force and the tokenizers library."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from objectlake.llm import bpe_tree, fill_middle, simplex
from objectlake.llm.registry import QUERIES

from .conftest import LONG, ROWS, SMOKE


# -- 11: clustering ------------------------------------------------------------------
def lloyd(rows, clusters, rounds, scale, seed=1):
    kept = [(i, tuple(int(np.floor(scale * float(x))) for x in v)) for i, v in rows]
    first = sorted(((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:clusters]
    centroids = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for n in set(at):
            mine = [v for (_, v), a in zip(kept, at) if a == n]
            centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *near(v)) for i, v in kept]
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = {n: sum(d for _, d, m in found if m == n) for n in range(len(centroids))}
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), told[n]) for i, d, n in found), key=str)


def columns_of(rows):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in rows), key=str)


def test_query_11_is_lloyds(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    got = QUERIES["op11_simplex_clusters"](spark, SMOKE).collect()
    assert columns_of(got) == lloyd(rows, 16, 3, 64)
    table = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    assert simplex.cluster_vectors(table).agg(F.avg("compared")).first()[0] < 12     # vectors without clusters: half or so are ruled out


@pytest.mark.parametrize("shape", ["gaps", "line", "same", "few"])
def test_clusters_of_awkward_vectors(spark, shape):
    rnd = random.Random(shape)
    if shape == "gaps":     # clusters far apart: the bounds leave few centroids to compare
        rows = [(i, [10.0 * ((i % 8) >> b & 1) + rnd.random() / 4 for b in range(3)]) for i in range(400)]
    elif shape == "line":   # pivots on a line: the base is one edge
        rows = [(i, [float(i % 37)] * 3) for i in range(300)]
    elif shape == "same":
        rows = [(i, [0.5, 0.25, -0.5]) for i in range(50)]
    else:
        rows = [(3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.5]), (4, [1.0, 2.0, 3.5]), (None, [9.0, 9.0, 9.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    got = simplex.cluster_vectors(table, 6, 3, 3, 16).collect()
    assert columns_of(got) == lloyd(rows, 6, 3, 16)
    if shape == "gaps":
        assert sum(r["compared"] for r in got) / len(got) < 3


def test_rows_that_take_part(spark, vectors):
    good = [(r["vec_id"], r["embedding"]) for r in vectors.collect() if r["embedding"] and len(r["embedding"]) == 4
            and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    assert columns_of(simplex.cluster_vectors(vectors, 5, 2, 4, 8).collect()) == lloyd(good, 5, 2, 8)
    empty = simplex.cluster_vectors(vectors.where("false"), 5, 2, 4, 8)
    assert empty.collect() == [] and empty.columns == simplex.cluster_vectors(vectors, 5, 2, 4, 8).columns
    huge = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit a long"):
        simplex.cluster_vectors(huge, 2, 1, 2, 8).collect()


def test_bounds_hold():
    rnd = np.random.default_rng(5)
    for spread in (1, 30, 100_000):
        for flat in (False, True):
            some = rnd.integers(-spread, spread + 1, (16, 12))
            if flat:
                some[:, 3:] = 0
            vectors, centroids = rnd.integers(-spread, spread + 1, (500, 12)), rnd.integers(-spread, spread + 1, (9, 12))
            base = simplex.Base.over(some, 8)
            maybe = base.maybe_nearest(base.apexes(simplex.squared(vectors, base.pivots)), base.apexes(simplex.squared(centroids, base.pivots)))
            exact = ((vectors[:, None].astype(object) - centroids[None]) ** 2).sum(2)
            cluster, distance = simplex.nearest(vectors, centroids, maybe)
            assert (cluster == np.argmin(exact, 1)).all() and (distance == exact.min(1)).all()


def test_apexes_keep_distances():
    rnd = np.random.default_rng(6)
    some = rnd.integers(-50, 51, (6, 10))
    base = simplex.Base.over(some, 6)
    assert len(base.pivots) == 6
    pivots = base.apexes(simplex.squared(base.pivots, base.pivots))
    vectors = rnd.integers(-50, 51, (40, 10))
    apex = base.apexes(simplex.squared(vectors, base.pivots))
    apart = ((apex[:, None] - pivots[None]) ** 2).sum(2)
    assert np.allclose(apart, simplex.squared(vectors, base.pivots), rtol=1e-6)


# -- 12: fill in the middle -------------------------------------------------------------
def by_hand(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    return doc_id, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [7, 64, fill_middle.BLOCK])
def test_scatter_and_gather(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rnd = random.Random(block)
    texts = ["".join(rnd.choice("ab\n\n<>PSMé漢🙂\r") for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["", "\n", "\n\n", "<", "<P", "P>", "<P>x\ny", "ab<S", ">x\n<", "S>", "M>", ""]      # marks that neighbours would make
    ids = [None if rnd.random() < 0.05 else rnd.randrange(10 ** rnd.randint(1, 18)) for _ in texts]
    hashes = [hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest() for i in ids]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(texts), *[pa.array([int(h[8 * k:8 * k + 8], 16) for h in hashes], pa.int64()) for k in range(4)]],
        names=["doc_id", "text", "h1", "h2", "h3", "h4"])
    rows = [r for b in fill_middle.restored(fill_middle.transformed([batch], 80, 30)) for r in b.to_pylist()]
    assert [tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in rows] \
        == [by_hand(i, t, 7, 80, 30) for i, t in zip(ids, texts)]
    assert [r["restored"] for r in rows] == texts
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_query_12(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    rows = QUERIES["op12_fill_middle"](spark, SMOKE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = by_hand(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r)[:5] == want[:5]
        assert r["output_sha256"] == hashlib.sha256(want[5].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_fill_middle_of_awkward_rows(awkward, nothing):
    rows = fill_middle.restore(fill_middle.fill_in_middle(awkward)).collect()
    assert sorted((tuple(r)[:6] for r in rows), key=str) == sorted((by_hand(r[0], r[1]) for r in ROWS), key=str)
    assert sorted(r["restored"] for r in rows) == sorted(r[1] or "" for r in ROWS)
    assert fill_middle.restore(fill_middle.fill_in_middle(nothing)).collect() == []


def test_restore_refuses_other_texts(spark):
    other = spark.createDataFrame([("psm", "<P>a<S>b")], "form string, output string")
    with pytest.raises(Exception, match="not exactly once"):
        fill_middle.restore(other).collect()


# -- 13: BPE -----------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_tree.VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    return bpe_tree.Coder()()


def hard_texts():
    rnd = random.Random(3)
    letters = "ab ▁theirnsgo\n.0129éüß漢字🙂'\t-՘\U00010940"
    some = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    some += ["a<|endoftext|><|endoftext|> b", "<|endoftext|>", "<|endoftext|> x <|endof", "word" * 5000, " " * 3000, "a" * 10_000, "it's we'll 'S", ""]
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rnd.shuffle(every)
    return some + ["".join(every[i:i + 500]) for i in range(0, len(every), 500)]


def test_tokens_are_the_librarys(library, encoder):
    texts = hard_texts()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids, n = encoder.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    assert [encoder.decode(np.array(w, np.int64)) for w in want] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_any_tokens_decode(library, encoder):
    rnd = random.Random(4)
    for _ in range(300):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 20))]
        assert encoder.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)
    assert encoder.decode(np.array([-1, 99_999_999])) == ""


def test_small_runs_and_little_memory(monkeypatch, library):
    for name, value in (("MATCHES", 7), ("KEPT_WORDS", 20), ("ROWS", 5)):
        monkeypatch.setattr(bpe_tree, name, value)
    some = bpe_tree.Coder()()
    texts = hard_texts()[:300] + ["long enough to be cut a run of matches at a time, <|endoftext|> and more"] * 2
    ids, n = some.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_rows_merge_as_trees_do(encoder):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("aeinorst he") for _ in range(rnd.randint(1, 33))).encode() for _ in range(800)]
    for low, size in ((0, 8), (9, 16), (17, 32)):
        some = [w for w in words if low < len(w) <= size + 1]
        tokens, n = encoder.merged_rows(some, size)
        assert [x.tolist() for x in np.split(tokens, np.cumsum(n)[:-1])] == [encoder.merged(w) for w in some]


def test_pair_tree_root_is_leftmost_least():
    rnd = random.Random(9)
    for n in (1, 2, 5, 16, 33):
        values = [rnd.randrange(4) for _ in range(n)]
        tree = bpe_tree.PairTree(values)
        for _ in range(60):
            least = min(values)
            if least < bpe_tree._FAR:
                assert divmod(tree.node[1], tree.size) == (least, values.index(least))
            else:
                assert tree.node[1] == bpe_tree._FAR
            i = rnd.randrange(n)
            values[i] = rnd.choice([rnd.randrange(6), bpe_tree._FAR])
            tree.put(i, values[i])


def test_query_13(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    rows = QUERIES["op13_bpe_tree"](spark, SMOKE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_of_awkward_rows(spark, awkward, nothing, library):
    rows = bpe_tree.decode(bpe_tree.encode(awkward)).collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in rows), key=str) \
        == sorted(((r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS), key=str)
    assert sorted(r["decoded"] for r in rows) == sorted(r[1] or "" for r in ROWS)
    assert LONG in {r["decoded"] for r in rows}
    assert bpe_tree.decode(bpe_tree.encode(nothing)).collect() == []
    empty = bpe_tree.decode(spark.createDataFrame([(1, None), (2, [])], "x int, ids array<int>")).select("decoded", F.col("x"))
    assert [r["decoded"] for r in empty.collect()] == ["", ""]
