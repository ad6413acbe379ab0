"""Token counts by offset-mapped attribution.

A document's fields are rendered into one text, which is encoded once, whole.
The tokens' byte lengths give their spans, and a merge join of the sorted spans
with the sorted sections (the fields' lines) counts the tokens of each section.
A token that crosses a boundary counts where its first byte lies; a section
holds the line end or field end that closes it, so every token counts once.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, pick

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's tokenizer splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODINGS: dict[tuple[bytes, str], tuple] = {}


def encoding(data: bytes, pattern: str):
    """The worker's encoding, made once, and the byte length of each token."""
    if (data, pattern) not in _ENCODINGS:
        import tiktoken
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, data.splitlines())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            lengths[i] = len(t)
        _ENCODINGS.clear()
        _ENCODINGS[data, pattern] = tiktoken.Encoding("spans", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _ENCODINGS[data, pattern]


def spans(enc, lengths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The byte offsets at which the text's tokens begin and end."""
    ends = np.cumsum(lengths[enc.encode_to_numpy(text, disallowed_special=())])
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends


def sections(fields: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rendered text (fields joined by line ends) and, for each line of
    each field, the field's number, the line's number in it, and the bytes and
    characters at which it begins; the last entry of these is the text's end."""
    text = "\n".join(fields)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    begins = np.concatenate([[0], np.flatnonzero(raw == 10) + 1, [len(raw)]])
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[begins]
    per_field = np.array([f.count("\n") + 1 for f in fields])
    field = np.repeat(np.arange(len(fields)), per_field)
    line = np.arange(len(field)) - np.repeat(np.cumsum(per_field) - per_field, per_field)
    return text, field, line, begins, chars


def attribute_tokens(docs: DataFrame, fields: tuple[str, ...] = ("source", "lang", "text"),
                     vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """A row for each line of each field of each document: ``field``, ``line``
    (from 0), ``char_start`` and ``char_end`` in the rendered document (end
    exclusive, the closing line end included), ``n_tokens``, ``n_crossing``
    (those of them that end in a later section) and ``doc_tokens`` (of the whole
    document, the sum over its rows).

    Null fields count as empty; an empty field is one empty line.  Repeated
    rows give repeated rows, an empty table none; other columns are ignored."""
    with open(vocabulary, "rb") as f:
        data = f.read()
    names = list(fields)

    def run(batches):
        enc, lengths = encoding(data, pattern)
        for b in chunks(batches, "body_"):
            columns = [b.column(f"f{i}").to_pylist() for i in range(len(names))]
            out: list[list] = [[] for _ in range(7)]
            for values in zip(*columns):
                text, field, line, begins, chars = sections([v or "" for v in values])
                starts, ends = spans(enc, lengths, text)
                n = len(field)
                first = np.searchsorted(begins[1:n], starts, side="right")
                final = np.searchsorted(begins[1:n], ends - 1, side="right")
                out[0].append(field)
                out[1].append(line)
                out[2].append(chars[:-1])
                out[3].append(chars[1:])
                out[4].append(np.bincount(first, minlength=n))
                out[5].append(np.bincount(first[final > first], minlength=n))
                out[6].append(np.full(n, len(starts)))
            rows = [len(x) for x in out[0]]
            flat = [np.concatenate(x) for x in out]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(np.repeat(np.arange(len(rows)), rows))),
                 pa.array(names).take(pa.array(flat[0])), *[pa.array(x, pa.int64()) for x in flat[1:]]],
                names=["doc_id", "field", "line", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"])
    used = pick(docs, "doc_id", *dict.fromkeys(names))
    body = F.concat(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in names])
    return used.select("doc_id", *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(names)], body.alias("body_")) \
        .mapInArrow(run, "doc_id long, field string, line long, char_start long, char_end long, n_tokens long, "
                         "n_crossing long, doc_tokens long")
