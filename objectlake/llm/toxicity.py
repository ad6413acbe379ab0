"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded labelled sample: one on
windows of ordinary text, one on toxic text, made of the word beginnings and
words that occur in many contexts of toxic texts and hardly in ordinary ones,
behind the same ordinary stretch (so that what both know costs both the same).
Every window of ``WINDOW`` words of a text is compressed with each; the
difference of the lengths is the window's evidence.  A logistic threshold over a
text's strongest windows, calibrated on texts whose windows were measured with
dictionaries of other texts, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, pick, stage
from .labelled import fit_logistic, held_out, learnable, logistic, some

#: the sample: whole texts of each class at most, and windows for the ordinary dictionary's trainer
TOXIC_TEXTS, ORDINARY_TEXTS, ORDINARY_WINDOWS = 1500, 3000, 40_000
WINDOW = 8
#: bytes of text whose words are held in one go when texts are scored
SCORED_BYTES = 512 << 10
#: how much more frequent in toxic texts a mark is
RATIO = 50
ORDINARY_BYTES, TOXIC_BYTES = 4096, 3000
_WORDS = re.compile(r"\w+").findall
_LEVELS = np.array([2.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0])


def windows(words: list[str]) -> list[bytes]:
    return [f" {' '.join(words[i:i + WINDOW])} ".encode("utf-8", "replace") for i in range(0, len(words), WINDOW)]


def words_of(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=15,
        chain_log=15, hash_log=14, search_log=4, min_match=5, target_length=32, strategy=zstandard.STRATEGY_LAZY2)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                    compression_params=params)


def ordinary_dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:      # too few samples for the trainer
        return b"".join(samples)[-ORDINARY_BYTES:]


def beginnings(word: str) -> set[str]:
    return {word[:k] for k in range(5, min(len(word), 9))} | {word + " "}


def toxic_pieces(seen: dict[str, int], usual: dict[str, int], n_toxic: int, n_ordinary: int) -> bytes:
    """What marks toxic texts, the most frequent last (nearest): of the units
    ``seen`` in so many toxic texts those that are ``usual`` in hardly any ordinary ones."""
    def marks(u: str) -> bool:
        """Whether ``u`` is surely more frequent in toxic texts (by two standard
        errors of the logarithm of the ratio), and ``RATIO`` times as frequent within one."""
        a, b = seen[u], usual.get(u, 0) + 0.5
        ratio, error = np.log(a / max(1, n_toxic) / (b / max(1, n_ordinary))), np.sqrt(1 / a + 1 / b)
        return ratio > 2 * error and ratio + error >= np.log(RATIO)
    chosen: list[str] = []
    for u in sorted(filter(marks, seen), key=lambda u: (-seen[u], -len(u), u)):
        if sum(len(c.encode("utf-8", "replace")) + 1 for c in chosen) >= TOXIC_BYTES:
            break
        if not any(u in c and seen[u] < 1.1 * seen[c] for c in chosen):
            chosen.append(u)
    return b"".join((" " + u).encode("utf-8", "replace") for u in reversed(chosen))


@dataclass
class ToxicModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None      # None: one class only was seen
    base: float

    def features(self, texts: list[list[str]]) -> np.ndarray:
        plain, marked = compressor(self.ordinary or b" " * 8).compress, compressor((self.ordinary or b" " * 8) + self.toxic).compress
        out = np.zeros((len(texts), 4 + len(_LEVELS)))
        for i, words in enumerate(texts):
            gain = np.array([len(plain(w)) - len(marked(w)) for w in windows(words)], float)
            if len(gain):
                top = -np.sort(-gain)
                out[i, :4] = min(top[0], 16), np.minimum(top[:3], 16).sum() / 3, np.log1p(4 * np.clip(gain, 0, 16).mean()), np.log1p(len(gain))
                out[i, 4:] = top[0] >= _LEVELS
        return out

    def score(self, texts: list[list[str]]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.base)
        return logistic(self.features(texts), self.weights)


#: the rows that a dictionary is learnt from: the first half, the other, all
PARTS = ((0,), (1,), (0, 1))


def dictionaries(sample: DataFrame, half: dict[int, int], label: dict[int, int], share: float) -> list[ToxicModel]:
    """The dictionaries of each of ``PARTS`` of the whole texts of ``sample``
    (``doc_id``, ``text``): counted in tasks, put together on the driver."""
    toxic = sample.where(F.col("doc_id").isin([d for d, y in label.items() if y]))
    ordinary = sample.where(~F.col("doc_id").isin([d for d, y in label.items() if y]))
    size = [[sum(y == k and half[d] in part for d, y in label.items()) for part in PARTS] for k in (0, 1)]
    least = [max(3, 0.01 * n) for n in size[1]]

    def each(batches):
        for b in chunks(batches, "text"):
            yield [(half[d], words_of(t)) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())], b.column("doc_id").to_pylist()

    def in_texts(rows: DataFrame, units: frozenset[str] | None) -> dict[str, list[int]]:
        """In how many texts of each of ``PARTS`` each unit (these, or all that are frequent) is."""
        @lean
        def run(batches):
            for texts, _ in each(batches):
                seen: list[Counter[str]] = [Counter(), Counter()]
                for h, words in texts:
                    own = {u for w in set(words) for u in beginnings(w)}
                    seen[h].update(own if units is None else own & units)
                every = sorted(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array([u.encode("utf-8", "replace").decode() for u in every], pa.string()),
                                                  *[pa.array([seen[h][u] for u in every], pa.int64()) for h in (0, 1)]], names=["u", "a", "b"])
        count = rows.mapInArrow(run, "u string, a long, b long").groupBy("u").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        if units is None:
            count = count.where((F.col("a") >= least[0]) | (F.col("b") >= least[1]) | (F.col("a") + F.col("b") >= least[2]))
        return {r["u"]: [r["a"], r["b"], r["a"] + r["b"]] for r in count.collect()}

    seen = in_texts(toxic, None)
    frequent, most = frozenset(seen), max(least)

    @lean
    def contexts(batches):
        for texts, _ in each(batches):
            held: dict[tuple[str, int], set] = defaultdict(set)     # only as many as count
            for h, words in texts:
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    for u in beginnings(word) & frequent:
                        if len(held[u, h]) < most:
                            held[u, h].add(f"{before} {after}".encode("utf-8", "replace").decode())
            rows = [(u, h, c) for (u, h), cs in held.items() for c in cs]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.string())], names=["u", "h", "c"])
    one = toxic.mapInArrow(contexts, "u string, h int, c string").groupBy("u", "c").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    counts = one.groupBy("u").agg(F.count_if(F.col("low") == 0).alias("a"), F.count_if(F.col("high") == 1).alias("b"), F.count(F.lit(1)).alias("n"))
    different = {r["u"]: [r["a"], r["b"], r["n"]] for r in counts.collect()}
    likely = [{u: n[p] for u, n in seen.items() if n[p] >= least[p] and different.get(u, [0, 0, 0])[p] >= least[p]} for p in range(3)]
    usual = in_texts(ordinary, frozenset(u for some_ in likely for u in some_))

    @lean
    def shuffled(batches):
        for texts, ids in each(batches):
            rows = []
            for (h, words), doc in zip(texts, ids):
                pieces = windows(words)
                order = np.random.default_rng([doc & (2 ** 64 - 1), 7]).permutation(len(pieces))[:ORDINARY_WINDOWS].tolist()
                rows += [(rank, doc, h, pieces[i]) for rank, i in enumerate(order)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
                                             names=["rank", "doc_id", "h", "w"])
    pieces = stage(ordinary.mapInArrow(shuffled, "rank int, doc_id long, h int, w binary"), "toxicity-windows")
    out = []
    for p, part in enumerate(PARTS):
        # the first of each text's shuffled windows, then the second, ...: as many of each as fit
        own = pieces.where(F.col("h").isin(*part)).orderBy("rank", F.xxhash64("doc_id"), "doc_id").limit(ORDINARY_WINDOWS)
        found = sorted((r["doc_id"], r["rank"], bytes(r["w"])) for r in own.collect())
        marks = toxic_pieces(likely[p], {u: n[p] for u, n in usual.items()}, size[1][p], size[0][p])
        out.append(ToxicModel(ordinary_dictionary([w for *_, w in found]), marks, None, share))
    return out


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> ToxicModel:
    """The model from labelled rows outside the held-out fold: at most
    ``TOXIC_TEXTS`` and ``ORDINARY_TEXTS`` of them, whole.  Tasks count words and
    measure windows; the counts and a row of features a text come to the driver."""
    rows = learnable(labels, "toxic", folds, fold)
    count = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    share = count.get(1, 0) / max(1, sum(count.values()))
    chosen = some(rows.where("label = 1"), TOXIC_TEXTS).unionByName(some(rows.where("label = 0"), ORDINARY_TEXTS))
    sample = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = stage(sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxicity-sample")
    label = {r["doc_id"]: r["label"] for r in sorted(sample.select("doc_id", "label").collect())}
    sample = sample.select("doc_id", "text")
    if not 0 < sum(label.values()) < len(label):
        return ToxicModel(b"", b"", None, share)
    half = {d: i % 2 for i, d in enumerate(label)}
    *halves, model = dictionaries(sample, half, label, share)

    @lean
    def measured(batches):      # each text with the dictionaries of the other half
        for b in chunks(batches, "text", SCORED_BYTES):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for h in (0, 1):
                own = [i for i, d in enumerate(ids) if half[d] == h]
                x = halves[1 - h].features([words_of(texts[i]) for i in own])
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in own], pa.int64()), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])
    found = sorted((r["doc_id"], r["x"]) for r in sample.mapInArrow(measured, "doc_id long, x array<double>").collect())
    x, y = np.array([r[1] for r in found]), np.array([label[r[0]] for r in found])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.weights = fit_logistic(x, y, weight)
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, folds: int = 4, fold: int = 2, threshold: float = 0.3,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``,
    ``held_out``, ``score`` and ``predicted``; ``keep`` carries further columns.

    The whole text counts; null and empty texts have no windows and a score all
    the same.  Rows with null ids are never held out; repeated rows give repeated
    rows, an empty table none."""
    columns = [c for c in dict.fromkeys(keep) if c != "doc_id"]
    rows = pick(docs, "doc_id", *dict.fromkeys(("text", *columns)))
    kept = ["doc_id", *columns]

    @lean
    def run(batches):
        for b in chunks(batches, "text", SCORED_BYTES):
            score = model.score([words_of(t) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(score, pa.float64())], names=[*kept, "score_"])
    shape = ", ".join(f"`{c}` {t}" for c, t in rows.select(*kept).dtypes) + ", score_ double"
    scored = rows.mapInArrow(run, shape)
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), F.col("score_").alias("score"),
                         (F.col("score_") >= threshold).cast("int").alias("predicted"), *columns)
