"""Byte-level BPE encoding and decoding by a segment tree over pair ranks.

A word (a match of the tokenizer's split pattern) starts as its bytes' tokens.
The leaves of a segment tree hold the ranks of the adjacent pairs, each with
its place, so the least leaf is the lowest rank and, of equal ranks, the
leftmost; it stands in the root.  A merge changes three leaves (the merged
pair goes, its two neighbours get new ranks), each by one walk to the root,
until the root says that no pair can be merged: n log n for a word of n bytes,
however long the word.

Words of up to 33 bytes are merged side by side: their trees are the rows of one
array, and a step reads all roots, merges one pair in each row and walks up in all
rows at once.  Longer words have a tree of their own.

Each distinct word of a run of texts is merged once.  Texts need no shuffle:
the work is a map over the rows.
"""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, pick, ranges

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: what a task keeps between runs of texts, at most: words, and their bytes; matches
#: handled at once; bytes of text of a run
KEPT_WORDS, KEPT_BYTES, MATCHES, RUN_BYTES = 200_000, 16 << 20, 1 << 18, 2 << 20
ROWS = 8192      # words merged side by side
#: Fixed value: the contractions of the byte-level split pattern.
CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"
_FAR = 1 << 62


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the others in order from 256."""
    plain = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def split_pattern(letter: str, number: str, none: str) -> str:
    return rf"(?V1){CONTRACTIONS}| ?{letter}+| ?{number}+| ?{none}+|\s+(?!\S)|\s+"


def strange_letters(vocabulary: str) -> str:
    """Letters and numbers of the ``regex`` library that the tokenizers library,
    with its own Unicode tables, takes for neither: all are asked once, a text
    ``a<letter>!`` or ``1<number>!`` each, whose first two characters then are
    one token."""
    import regex
    from tokenizers import Tokenizer
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    found, split = [], Tokenizer.from_str(vocabulary).pre_tokenizer.pre_tokenize_str
    for kind, before in (("L", "a"), ("N", "1")):
        some = regex.findall(rf"\p{{{kind}}}", every)
        ends = {end for _, (_, end) in split("".join(f"{before}{c}!" for c in some))}
        found += [c for i, c in enumerate(some) if 3 * i + 1 in ends]
    return "".join(sorted(found))


def as_ranges(characters: str) -> str:
    """A character set's text: the sorted characters as ranges."""
    codes = np.array([ord(c) for c in characters], np.int64)
    cuts = np.flatnonzero(np.diff(codes) != 1) + 1
    return "".join(rf"\U{a[0]:08x}-\U{a[-1]:08x}" for a in np.split(codes, cuts) if len(a))


class PairTree:
    """Least entry, and its place, of a row of numbers under point updates."""

    def __init__(self, values: list[int]):
        self.size = size = 1 << max(len(values) - 1, 0).bit_length()
        # an entry is value * size + place: the least entry has the least value, leftmost of equals
        self.node = node = [_FAR] * size + [v * size + i if v < _FAR else _FAR for i, v in enumerate(values)] \
            + [_FAR] * (size - len(values))
        for i in range(size - 1, 0, -1):
            a, b = node[2 * i], node[2 * i + 1]
            node[i] = a if a < b else b

    def put(self, place: int, value: int) -> None:
        """Set one entry (``_FAR``: none) and the least ones above it, as far as they change."""
        node, i = self.node, self.size + place
        node[i] = value * self.size + place if value < _FAR else _FAR
        while i > 1:
            a, b = node[i], node[i ^ 1]
            least = a if a < b else b
            i >>= 1
            if node[i] == least:
                break
            node[i] = least


class TreeEncoder:
    """A byte-level BPE vocabulary, its merges, and the words cut so far."""

    def __init__(self, vocabulary: str, strange: str = ""):
        import regex
        made = json.loads(vocabulary)
        model, split = made["model"], made["pre_tokenizer"] or {}
        if model["type"] != "BPE" or made["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") \
                or not split.get("use_regex", True) or model.get("dropout") or model.get("ignore_merges") \
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        letters = byte_letters()
        ids = model["vocab"]
        self.start = [ids[c] for c in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.none = max(ids.values()) + 1       # stands for no token
        keys = np.array([a * (self.none + 1) + b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array(list(self.rank.values()), np.int64)[order]
        self.start_array, self.made_array = np.array(self.start, np.int64), np.array(self.made, np.int64)
        byte = {c: b for b, c in enumerate(letters)}
        added = {a["content"]: a["id"] for a in made.get("added_tokens") or ()}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in made.get("added_tokens") or ()):
            raise ValueError("added tokens that take in their neighbourhood are not supported")
        raw: dict[int, bytes] = {i: bytes(map(byte.get, t)) if all(c in byte for c in t) else t.encode() for t, i in (ids | added).items()}
        self.raw = pa.array([raw.get(i, b"") for i in range(max(raw) + 1)], pa.binary())
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None
        self.split = regex.compile(split_pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"))
        self.strange = self.exact = None
        if strange:
            s = as_ranges(strange)
            self.strange = regex.compile(f"[{s}]")
            self.exact = regex.compile(split_pattern(rf"[\p{{L}}--[{s}]]", rf"[\p{{N}}--[{s}]]", rf"[[^\s\p{{L}}\p{{N}}]||[{s}]]"))
        self.forget()

    def forget(self) -> None:
        """Know no words but the added tokens."""
        self.code: dict[str, int] = dict(zip(self.added, range(len(self.added))))
        self.flat, self.begin = np.array(list(self.added.values()), np.int32), np.arange(len(self.added))
        self.length = np.ones(len(self.added), np.int64)
        self.held = 0

    def merged(self, word: bytes) -> list[int]:
        """The tokens of one word."""
        start, rank, made = self.start, self.rank, self.made
        token = [start[b] for b in word]
        n = len(token)
        if n < 2:
            return token
        tree = PairTree([rank.get(p, _FAR) for p in zip(token, token[1:])])
        node, size, put = tree.node, tree.size, tree.put
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while node[1] < _FAR:
            r, i = divmod(node[1], size)        # pair i is that of the tokens at i and after it
            j = after[i]
            k = after[j]
            token[i], token[j] = made[r], -1
            after[i] = k
            if k < n:
                before[k] = i
                put(j, _FAR)
                put(i, rank.get((token[i], token[k]), _FAR))
            else:
                put(i, _FAR)
            h = before[i]
            if h >= 0:
                put(h, rank.get((token[h], token[i]), _FAR))
        return [t for t in token if t >= 0]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs (``_FAR``: no merge)."""
        wanted = a * (self.none + 1) + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _FAR)

    def merged_rows(self, words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words of 1 to ``size`` + 1 bytes in a row, and the
        number of each word's; row w of ``node`` is the tree of word w."""
        rows, n = len(words), np.array([len(w) for w in words], np.int64)
        wide, high = 2 * size, size.bit_length() - 1
        token = np.full((rows, size + 2), self.none, np.int64)
        token[np.repeat(np.arange(rows), n), ranges(np.zeros(rows, np.int64), n)] = self.start_array[np.frombuffer(b"".join(words), np.uint8)]
        node = np.full((rows, wide), _FAR, np.int64)
        rank = self.rank_of(token[:, :size], token[:, 1:size + 1])
        node[:, size:] = np.where(rank < _FAR, rank * size + np.arange(size), _FAR)
        for level in (size >> h for h in range(1, high + 1)):
            node[:, level:2 * level] = np.minimum(node[:, 2 * level:4 * level:2], node[:, 2 * level + 1:4 * level:2])
        after = np.tile(np.arange(1, size + 3), (rows, 1))
        before = np.tile(np.arange(-1, size + 1), (rows, 1))
        live = np.arange(rows)
        flat = node.reshape(-1)
        while True:
            root = node[live, 1]
            live = live[root < _FAR]
            if not len(live):
                break
            root = root[root < _FAR]
            i = root & (size - 1)
            j = after[live, i]
            k = after[live, j]
            h = before[live, i]
            made = self.made_array[root >> high]
            token[live, i] = made
            token[live, j] = self.none
            after[live, i] = k
            before[live, k] = i
            base = live * wide
            left = np.where(h >= 0, h, i)       # no neighbour: pair i, written last, stands for it
            right = np.where(j < size, j, i)
            rank = self.rank_of(np.where(h >= 0, token[live, left], self.none), made)
            flat[base + size + right] = _FAR
            flat[base + size + left] = np.where(rank < _FAR, rank * size + left, _FAR)
            rank = self.rank_of(made, token[live, k])
            flat[base + size + i] = np.where(rank < _FAR, rank * size + i, _FAR)
            for place in (right, i, left):
                up = (size + place) >> 1
                for _ in range(high):
                    child = base + 2 * up
                    flat[base + up] = np.minimum(flat[child], flat[child + 1])
                    up >>= 1
        there = token < self.none
        return token[there], there.sum(1)

    def learn(self, words: list[str]) -> None:
        """Cut new words and add them to the known ones."""
        raw = [w.encode("utf-8", "replace") for w in words]
        size = np.array([len(r) for r in raw])
        self.held += int(size.sum())
        for low, high in ((0, 9), (9, 17), (17, 33), (33, None)):
            some = np.flatnonzero((size > low) & (size <= high) if high else size > low)
            for at in range(0, len(some), ROWS):
                block = some[at:at + ROWS].tolist()
                if high:
                    tokens, lengths = self.merged_rows([raw[i] for i in block], high - 1)
                else:
                    cuts = [self.merged(raw[i]) for i in block]
                    lengths = np.array([len(c) for c in cuts], np.int64)
                    tokens = np.array([t for c in cuts for t in c], np.int64)
                self.code.update(zip([words[i] for i in block], range(len(self.begin), len(self.begin) + len(block))))
                self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(lengths) - lengths])
                self.flat = np.concatenate([self.flat, tokens.astype(np.int32)])
                self.length = np.concatenate([self.length, lengths])

    def cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of ``words`` in a row, and the number of each word's."""
        if len(self.code) > KEPT_WORDS or self.held > KEPT_BYTES:
            self.forget()
        code = self.code
        new = [w for w in set(words) if w not in code]
        if new:
            self.learn(new)
        at = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
        length = self.length[at]
        out = self.flat[ranges(self.begin[at], length)]
        return out, length

    def words(self, text: str):
        """The words of a text, in lists: a list at once, or of a long text
        one after another.  Added tokens that it spells out are words."""
        parts = self.special.split(text) if self.special else [text]
        pattern = self.exact if self.strange and not text.isascii() and self.strange.search(text) else self.split
        if len(text) <= MATCHES:
            yield [w for i, part in enumerate(parts) for w in ([part] if i % 2 else pattern.findall(part))]
            return
        found = (w for i, part in enumerate(parts) for w in ([part] if i % 2 else (m.group() for m in pattern.finditer(part))))
        while some := list(islice(found, MATCHES)):
            yield some

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of ``texts`` in a row, and the number of each text's."""
        out, total = [], np.zeros(len(texts), np.int64)
        run: list[str] = []
        owner: list[tuple[int, int]] = []       # text and number of its words in the run

        def close() -> None:
            tokens, length = self.cut(run)
            out.append(tokens)
            sums = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0] + [n for _, n in owner])]
            np.add.at(total, [t for t, _ in owner], np.diff(sums))
            run.clear()
            owner.clear()
        for t, text in enumerate(texts):
            for some in self.words(text):
                run += some
                owner.append((t, len(some)))
                if len(run) >= MATCHES:
                    close()
        if owner:
            close()
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), total

    def decode(self, tokens: np.ndarray) -> str:
        """The text of tokens; bytes that are no UTF-8 become U+FFFD, ids that
        the vocabulary lacks nothing."""
        known = (tokens >= 0) & (tokens < len(self.raw))
        taken = self.raw.take(pa.array(tokens if known.all() else tokens[known]))
        ends = np.frombuffer(taken.buffers()[1], np.int32)
        data = taken.buffers()[2]
        return data.slice(int(ends[0]), int(ends[len(taken)] - ends[0])).to_pybytes().decode("utf-8", "replace") if len(taken) else ""


def encoded(batches, encoder: TreeEncoder):
    """Arrow batches with a column ``text`` as the batches of their other
    columns with ``n_tokens`` and ``ids`` in its place."""
    for b in chunks(batches, "text", RUN_BYTES):
        ids, n = encoder.encode([t or "" for t in b.column("text").to_pylist()])
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        others = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], pa.array(n), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))],
                                         names=[*others, "n_tokens", "ids"])


def decoded(batches, encoder: TreeEncoder):
    """Arrow batches with a column ``ids`` as the same with ``decoded``."""
    for b in batches:
        column = b.column("ids")
        ids = column.flatten().to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum([n or 0 for n in column.value_lengths().to_pylist()])]).astype(np.int64)
        texts = [encoder.decode(ids[a:z]) for a, z in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"])


class Coder:
    """Makes the encoder of a vocabulary in each task (it goes when the task ends)."""

    def __init__(self, vocabulary: str = VOCABULARY):
        with open(vocabulary, encoding="utf-8") as f:
            self.vocabulary = f.read()
        self.strange = strange_letters(self.vocabulary)

    def __call__(self) -> TreeEncoder:
        return TreeEncoder(self.vocabulary, self.strange)


def texts_of(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of every whole text, as the
    tokenizers library encodes it without special tokens of its own.

    Null and empty texts have no tokens; repeated rows give repeated rows, an
    empty table none; very long texts are cut a run of matches at a time;
    further columns are ignored."""
    coder = Coder(vocabulary)

    def run(batches):
        yield from encoded(batches, coder())
    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows of ``tokens`` with ``decoded``, the text of its ``ids`` (null
    or empty ids: the empty text).  Other columns stay, in any order."""
    coder = Coder(vocabulary)
    if "decoded" in tokens.columns:
        raise ValueError("the table has a column 'decoded' already")
    shape = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        yield from decoded(batches, coder())
    return tokens.mapInArrow(run, shape)
