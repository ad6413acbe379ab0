"""SentencePiece encoding and decoding by shared-prefix forward search.

The text's spaces become word marks, and the text is cut into marked words,
which no piece of the vocabulary crosses.  The distinct words of a run of texts
are sorted, so that they form a trie in depth-first order; the forward state of
each prefix is computed once and serves every word that begins with it.

Unigram models: the state of a prefix is its best score and the last piece of
the best cut (Viterbi).  BPE models: additive scores don't give a BPE cut, so
the state is the last piece of the prefix's BPE encoding.  That piece is the one
whose pair with the piece before it is stable (BPE of the two pieces' text gives
back the two pieces); a cut is the BPE encoding of its text exactly if all
neighbouring pairs are stable, so the forward search gives what merging gives.
Characters that are no piece become their UTF-8 byte pieces.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import chunks, give_back, pick, ranges

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: what a worker keeps between runs of texts, at most: cuts of words, tested pairs of
#: pieces, steps along words (some 80 MB together); and the bytes of text of a run
KEPT_WORDS, KEPT_PAIRS, KEPT_STEPS, RUN_BYTES = 200_000, 250_000, 80_000, 512 << 10

_ENCODERS: dict[bytes, "TrieEncoder"] = {}


class TrieEncoder:
    """The pieces of a model and the cuts of the words seen so far."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, self.bpe = proto.normalizer_spec, proto.trainer_spec.model_type == 2
        if proto.trainer_spec.model_type not in (1, 2) or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only unigram and BPE models that keep the text as it is are supported")
        self.setup([(p.piece, p.score, p.type) for p in proto.pieces], norm.add_dummy_prefix)

    @classmethod
    def of_pieces(cls, pieces: list[tuple[str, float, int]], bpe: bool, prefix: bool = True) -> "TrieEncoder":
        made = cls.__new__(cls)
        made.bpe = bpe
        made.setup(pieces, prefix)
        return made

    def setup(self, pieces: list[tuple[str, float, int]], prefix: bool) -> None:
        """``pieces``: (text, score, type); types: 1 normal, 2 unknown, 3
        control, 4 user-defined, 6 byte."""
        self.prefix = prefix
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t in (1, 4)}
        self.score = [s for _, s, _ in pieces]
        self.text = [p for p, _, _ in pieces]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == 6}
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == 2), 0)
        self.beginnings = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.lowest = min([s for _, s, t in pieces if t == 1], default=0.0) - 10.0
        raw = [bytes([int(p[3:5], 16)]) if t == 6 else b"" if t == 3 else " ⁇ ".encode() if t == 2
               else p.replace(MARK, " ").encode() for p, _, t in pieces]
        self.raw = pa.array(raw, pa.binary())
        known = {c for p in self.ids for c in p}
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        line = "" if "\n" in known else "\n"
        self.words = re.compile(r"(?s).+" if crossing else
                                f"{MARK}+[^{MARK}{line}]*|[^{MARK}{line}]+" + (r"|\n+" if line else ""))
        self.stable: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat, self.begin, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    # -- BPE -----------------------------------------------------------------
    def merge(self, text: str, until: int = 1) -> list[str]:
        """BPE by its definition: join the neighbours whose joint piece has
        the best score, the first of equals, until none (or ``until``) is left."""
        parts, ids, score = list(text), self.ids, self.score
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = ids.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or score[p] > best):
                    best, at = score[p], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes ``piece`` ((-1, -1): a single
        character; None: merging never makes it)."""
        if piece not in self.split:
            text = self.text[piece]
            parts = self.merge(text, 2)
            if len(text) == 1:
                self.split[piece] = (-1, -1)
            elif len(parts) == 2 and all(x in self.ids for x in parts):
                self.split[piece] = (self.ids[parts[0]], self.ids[parts[1]])
            else:
                self.split[piece] = None
        return self.split[piece]

    def fits(self, before: int, piece: int) -> bool:
        """Whether BPE leaves ``piece`` whole after the piece ``before`` (-1:
        at the start, or after a character that is no piece).

        Merges are undone from the last one back, in the piece that was made
        later; a piece across the border that would have been made earlier than
        the merge undone shows that the pair is not what merging gives.  Equal
        scores: the merge further left comes first."""
        if self.halves(piece) is None:
            return False
        if before < 0:
            return True
        left, right, ids, text, score = before, piece, self.ids, self.text, self.score
        bound, included = None, True    # the score a joint piece must reach to have come first
        while True:
            joint = ids.get(text[left] + text[right])
            if joint is not None and (bound is None or score[joint] > bound or included and score[joint] == bound):
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None or b is None or a[0] >= 0 and max(score[left], score[right]) > 0:
                return self.merge(text[before] + text[piece]) == [text[before], text[piece]]
            if a[0] < 0 and b[0] < 0:
                return True
            if b[0] < 0 or a[0] >= 0 and score[left] < score[right]:
                bound, included, left = score[left], False, a[1]
            else:
                bound, included, right = score[right], True, b[0]

    # -- the trie --------------------------------------------------------------
    def step(self, key: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """From the longest suffix that begins a piece, and one more character:
        the new such suffix, and the pieces that end here, longest first."""
        suffix = key
        while suffix and suffix not in self.beginnings:
            suffix = suffix[1:]
        found = tuple((len(suffix) - k, self.ids[suffix[k:]]) for k in range(len(suffix)) if suffix[k:] in self.ids)
        if len(self.steps) > KEPT_STEPS:
            self.steps.clear()
        self.steps[key] = suffix, found
        return suffix, found

    def cut_sorted(self, words: list[str]) -> list[list[int]]:
        """The pieces of each word; ``words`` are distinct and sorted."""
        score, bpe, stable, steps, many = self.score, self.bpe, self.stable, self.steps, len(self.text)
        last: list[int] = [-1]          # the last piece of each prefix of the path; -1: none
        size: list[int] = [0]           # its characters
        total: list[float] = [0.0]      # unigram: the best score
        states: list[str] = [""]
        out, previous = [], ""
        for word in words:
            n, common = min(len(previous), len(word)), 0
            while common < n and previous[common] == word[common]:
                common += 1
            del last[common + 1:], size[common + 1:], states[common + 1:], total[common + 1:]
            state = states[-1]
            for end in range(common + 1, len(word) + 1):
                key = state + word[end - 1]
                state, found = steps.get(key) or self.step(key)
                states.append(state)
                if bpe:
                    for length, p in found:
                        pair = (last[end - length] + 1) * many + p
                        ok = stable.get(pair)
                        if ok is None:
                            if len(stable) > KEPT_PAIRS:
                                stable.clear()
                            ok = stable[pair] = self.fits(last[end - length], p)
                        if ok:
                            last.append(p)
                            size.append(length)
                            break
                    else:
                        last.append(-1)
                        size.append(1)
                else:
                    best = (total[end - 1] + self.lowest, 1, -1)
                    for length, p in found:
                        if (s := total[end - length] + score[p]) > best[0] or best[2] < 0 and s == best[0]:
                            best = (s, length, p)
                    total.append(best[0])
                    size.append(best[1])
                    last.append(best[2])
            path, end = [], len(word)
            while end > 0:
                if last[end] >= 0:
                    path.append(last[end])
                else:
                    path.extend(self.spelled(word[end - 1])[::-1])
                end -= size[end]
            out.append(path[::-1])
            previous = word
        return out

    def spelled(self, char: str) -> list[int]:
        found = [self.bytes.get(b, self.unknown) for b in char.encode("utf-8", "replace")]
        return found if self.bytes else [self.unknown]

    def learn(self, words: set[str]) -> None:
        new = sorted(words - self.code.keys())
        if not new:
            return
        if len(self.code) + len(new) > KEPT_WORDS:
            self.forget()
            new = sorted(words)
        cuts = self.cut_sorted(new)
        lengths = np.fromiter(map(len, cuts), np.int64, len(cuts))
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, np.fromiter((p for c in cuts for p in c), np.int32, int(lengths.sum()))])

    # -- batches ---------------------------------------------------------------
    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all texts one after another, and where each begins."""
        lead = MARK if self.prefix else ""
        per_text = [self.words.findall(lead + t.replace(" ", MARK)) if t else [] for t in texts]
        counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
        words = list(chain.from_iterable(per_text))
        self.learn(set(words))
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        lengths = self.length[codes]
        ids = self.flat[ranges(self.begin[codes], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the pieces; byte pieces that are no UTF-8 become U+FFFD."""
        taken = self.raw.take(pa.array(ids, pa.int32()))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), taken), b"")
        texts = [b.decode("utf-8", "replace") for b in joined.to_pylist()]
        return [t[1:] if self.prefix and t[:1] == " " else t for t in texts]


def encoder(model: bytes) -> TrieEncoder:
    """The worker's encoder for ``model``, made once."""
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = TrieEncoder(model)
    return _ENCODERS[model]


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_pieces", T.LongType()),
                        T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
                        T.StructField("round_trip", T.BooleanType())])


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): the piece ids of the
    whole text, their number, and whether decoding them gives the text back
    (it doesn't where the text holds a word mark itself).  Null and empty texts
    have no pieces.  ``model`` is read on the driver and sent to the tasks;
    other columns are ignored, an empty table gives no rows."""
    data = read_model(model)

    def run(batches):
        enc = encoder(data)
        try:
            for b in chunks(batches, "text", RUN_BYTES):
                texts = [t or "" for t in b.column("text").to_pylist()]
                ids, offsets = enc.encode(texts)
                same = [a == t for a, t in zip(enc.decode(ids, offsets), texts)]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), pa.array(np.diff(offsets), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "piece_ids", "round_trip"])
        finally:
            give_back()     # the encoder stays, for the next task
    return pick(docs, "doc_id", "text").mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id`` and the ``text`` of its ``piece_ids`` (null or none: empty;
    null ids inside are passed over)."""
    data = read_model(model)

    def run(batches):
        enc = encoder(data)
        for b in batches:
            lists = [np.array([i for i in x or [] if i is not None], np.int32) for x in b.column("piece_ids").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            ids = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(enc.decode(ids, offsets), pa.string())],
                                             names=["doc_id", "text"])
    return pick(encoded, "doc_id", "piece_ids").mapInArrow(run, "doc_id long, text string")
