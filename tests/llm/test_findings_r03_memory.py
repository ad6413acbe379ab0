"""Round 3, pipeline: what a worker needs at once is small beside an executor's memory."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from objectlake.llm import pieces, private_data, similarity, toxicity


class Rows:
    """Stands for a table: gives the function that its rows would go through."""
    dtypes = [("doc_id", "bigint")]
    run = None

    def select(self, *columns):
        return self

    def mapInArrow(self, run, shape):
        self.run = run
        return self


def run_of(monkeypatch, module, made):
    monkeypatch.setattr(module, "pick", lambda docs, *names: docs)
    return made(Rows()).run


def most_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def batch_of_4mb():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(500)]
    texts = [" ".join(rnd.choices(words, k=100)) for _ in range(6700)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])


@pytest.mark.parametrize("module, made, limit", [
    (similarity, lambda rows: similarity.describe(rows, 5, 80), 60),
    (toxicity, lambda rows: toxicity.score_toxicity(rows, toxicity.ToxicModel(b"", b"", None, 0.5)), 25),
    (pieces, lambda rows: pieces.encode(rows), 45)], ids=["describe", "score", "pieces"])
def test_a_batch_takes_little_memory(monkeypatch, module, made, limit):
    monkeypatch.setattr(toxicity, "held_out", lambda *args: toxicity.F)
    monkeypatch.setattr(toxicity, "F", Columns())
    run, batch = run_of(monkeypatch, module, made), batch_of_4mb()
    rows = []
    assert most_mb(lambda: rows.extend(b.num_rows for b in run([batch]))) < limit
    assert sum(rows) == batch.num_rows
    pieces._ENCODERS.clear()


class Columns:
    """Stands for ``functions`` where no session is."""
    def col(self, name):
        return self

    def alias(self, name):
        return self

    cast = __ge__ = alias


@pytest.mark.parametrize("n, groups", [(300, 2048), (1024, 64), (40, 64)])
def test_tree_join_takes_little_memory(n, groups):
    rng = np.random.default_rng(1)
    base = rng.poisson(4, (n // 6, groups))
    high = base[rng.integers(0, len(base), n)] + (rng.random((n, groups)) < 0.02)
    size, found = high.sum(1), []
    assert most_mb(lambda: found.extend(similarity.rtree_pairs(size, size, high, 80))) < 60
    want = set()
    for i in range(n):
        both = np.minimum(high[i], high).sum(1)
        fits = (100 * size >= 80 * size[i]) & (100 * size[i] >= 80 * size) & (both >= similarity.needed_overlap(size[i], size, 80))
        want |= {(i, j) for j in np.flatnonzero(fits).tolist() if j > i}
    assert set(zip(found[0].tolist(), found[1].tolist())) == want and len(found[0]) == len(want) > 0


def test_private_data_gives_back_what_other_stages_kept(monkeypatch):
    run = run_of(monkeypatch, private_data, lambda rows: private_data.find_private(rows, private_data.fit(["call +1 437 555 0689"])))
    pieces._ENCODERS[b"other"] = None
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a@b.cd"])], names=["doc_id", "text"])
    assert [b.column("n_email").to_pylist() for b in run([batch])] == [[1]]
    assert not pieces._ENCODERS
