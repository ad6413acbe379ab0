"""Fill-in-middle transformation by displacement scatter.

All texts of an Arrow batch lie one after another in one byte buffer.  A scan
finds the line ends, and each document's hash picks its two cuts among them; the
parts between cuts only move, so every byte's place in the output buffer is its
place in the input plus the displacement of its part.  A difference array
holds the change of displacement at each part's first byte; its cumulative sum is
every byte's displacement, and one scatter writes the output.  The inverse reads
the parts off the output's marks, sums up the same displacements and gathers.

Buffers are walked in blocks, so the extra memory does not follow the texts'
length.  Texts need no shuffle: the work is a map over the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, pick

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3                    # bytes of a mark
BLOCK = 1 << 20             # bytes moved at once
FORMS = ("plain", "psm", "spm")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first digits of the
    sha256 of ``<seed>:<doc_id>`` (a null id counts as the text ``null``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and its rows' offsets in them (null: empty)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def found(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where ``mark`` begins in ``data``."""
    out = []
    for at in range(0, len(data), BLOCK):
        part = data[at:at + BLOCK + len(mark) - 1]
        n = len(part) - len(mark) + 1
        hit = np.ones(max(n, 0), bool)
        for i, byte in enumerate(mark):
            hit &= part[i:i + n] == byte
        out.append(at + np.flatnonzero(hit))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def displacements(begins: np.ndarray, shifts: np.ndarray, total: int):
    """For each block of ``total`` bytes its first byte and every byte's
    displacement: parts begin at ``begins`` (ascending, empty parts may share
    one) and are shifted by ``shifts``."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for at in range(0, total, BLOCK):
        end = min(at + BLOCK, total)
        low, high = np.searchsorted(begins, [at, end])
        difference = np.zeros(end - at, np.int64)
        np.add.at(difference, begins[low:high] - at, change[low:high])
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = int(shift[-1])
        yield at, end, shift


def code_points(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Characters of the parts of ``data`` from ``begins`` to ``ends``."""
    at = np.unique(np.concatenate([begins, ends]))
    count = np.zeros(len(at), np.int64)
    for i, (a, z) in enumerate(zip(at, at[1:])):
        count[i + 1] = np.count_nonzero((data[a:z] & 0xC0) != 0x80)
    total = np.cumsum(count)
    return total[np.searchsorted(at, ends)] - total[np.searchsorted(at, begins)]


def scatter(data: np.ndarray, offsets: np.ndarray, draw: list[np.ndarray], rate: int, spm_rate: int) -> dict[str, np.ndarray]:
    """The transformed texts of a batch: ``n``, ``form`` (its number in
    ``FORMS``), ``prefix_chars``, ``middle_chars``, and the output's ``data`` and ``offsets``."""
    begin, end = offsets[:-1], offsets[1:]
    lines = np.concatenate([at + np.flatnonzero(data[at:at + BLOCK] == 10) + 1 for at in range(0, len(data), BLOCK)] or [np.zeros(0, np.int64)])
    first, last = np.searchsorted(lines, begin, side="right"), np.searchsorted(lines, end, side="right")
    closed = (end > begin) & (last > first) & (np.append(lines, -1)[last - 1] == end)
    n = last - first + ((end > begin) & ~closed)
    a, b = np.minimum(draw[0] % (n + 1), draw[1] % (n + 1)), np.maximum(draw[0] % (n + 1), draw[1] % (n + 1))

    def after(units: np.ndarray) -> np.ndarray:
        """Where so many lines of each text end."""
        at = np.append(lines, 0)[np.minimum(first + units - 1, len(lines))]
        return np.where(units == 0, begin, np.where(units == n, end, at))
    one, two = after(a), after(b)
    marked = np.zeros(len(n), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = found(data, mark)
        row = np.searchsorted(end, at, side="right")
        marked[row[at + MARK <= end[row]]] = True       # not those that two texts make together
    plain = (n == 0) | marked | (draw[2] % 100 >= rate)
    spm = draw[3] % 100 < spm_rate
    form = np.where(plain, 0, np.where(spm, 2, 1))

    length = end - begin + np.where(plain, 0, 3 * MARK)
    out_offsets = np.concatenate([[0], np.cumsum(length)])
    start = out_offsets[:-1]
    prefix, middle, suffix = one - begin, two - one, end - two
    # where the parts and the marks before them begin in the output
    prefix_at = start + np.where(plain, 0, np.where(spm, 2 * MARK + suffix, MARK))
    suffix_at = start + np.where(plain, prefix + middle, np.where(spm, MARK, 2 * MARK + prefix))
    middle_at = start + np.where(plain, prefix, length - middle)
    begins = np.stack([begin, one, two], 1).reshape(-1)
    shifts = np.stack([prefix_at, middle_at, suffix_at], 1).reshape(-1) - begins
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for at, until, shift in displacements(begins, shifts, len(data)):
        out[np.arange(at, until) + shift] = data[at:until]
    for mark, place in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        for i, byte in enumerate(mark):
            out[place[~plain] - MARK + i] = byte
    return {"n": n, "form": form, "prefix_chars": code_points(data, begin, one), "middle_chars": code_points(data, one, two),
            "data": out, "offsets": out_offsets}


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of transformed ones: the parts are read off the marks."""
    begin, end = offsets[:-1], offsets[1:]
    plain, spm = form == 0, form == 2

    def mark_of(mark: bytes) -> np.ndarray:
        """Where each text that is not plain has ``mark`` (its only one)."""
        at = found(data, mark)
        row = np.searchsorted(end, at, side="right")
        keep = (at + MARK <= end[row]) & ~plain[row]
        place = np.full(len(begin), -1, np.int64)
        place[row[keep]] = at[keep]
        if (np.bincount(row[keep], minlength=len(begin)) != ~plain).any():
            raise ValueError(f"a transformed text has {mark.decode()} not exactly once")
        return place
    p, s, m = (np.where(plain, begin, mark_of(mark)) for mark in (PREFIX, SUFFIX, MIDDLE))
    prefix_at, suffix_at, middle_at = p + MARK, s + MARK, m + MARK
    prefix = np.where(plain, 0, np.where(spm, m - prefix_at, s - prefix_at))
    suffix = np.where(plain, 0, np.where(spm, p - suffix_at, m - suffix_at))
    middle = np.where(plain, end - begin, end - middle_at)
    prefix_at, suffix_at, middle_at = (np.where(plain, begin, x) for x in (prefix_at, suffix_at, middle_at))
    out_offsets = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    start = out_offsets[:-1]
    begins = np.stack([start, start + prefix, start + prefix + middle], 1).reshape(-1)
    shifts = np.stack([prefix_at, middle_at, suffix_at], 1).reshape(-1) - begins
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for at, until, shift in displacements(begins, shifts, len(out)):
        out[at:until] = data[np.arange(at, until) + shift]
    return out, out_offsets


def transformed(batches, rate: int, spm_rate: int):
    """Arrow batches of doc_id, text and four draws as those of the result."""
    for b in chunks(batches, "text"):
        data, offsets = buffer_of(b.column("text"))
        r = scatter(data, offsets, [b.column(f"h{i}").to_numpy() for i in range(1, 5)], rate, spm_rate)
        plain = r["form"] == 0
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(r["n"], pa.int64()), pa.array(FORMS).take(pa.array(r["form"])),
             pa.array(r["prefix_chars"], pa.int64(), mask=plain), pa.array(r["middle_chars"], pa.int64(), mask=plain),
             strings(r["data"], r["offsets"]).cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(batches):
    """Arrow batches with ``form`` and ``output`` as the same with ``restored``."""
    for b in chunks(batches, "output"):
        data, offsets = buffer_of(b.column("output"))
        form = np.array([FORMS.index(f) for f in b.column("form").to_pylist()])
        yield pa.RecordBatch.from_arrays([*b.columns, strings(*gather(data, offsets, form)).cast(pa.string())], names=[*b.schema.names, "restored"])


SHAPE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def drawn(docs: DataFrame, seed: int) -> DataFrame:
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", *[h.alias(f"h{i + 1}") for i, h in enumerate(draws(F.col("doc_id"), seed))])


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """Every whole text cut at two of its line ends, and its parts in the order
    prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``), each
    behind its mark: ``n`` (its lines), ``form``, the characters of prefix and
    middle, and the ``output``.

    ``rate`` of 100 texts are transformed, ``spm_rate`` of 100 of these as spm.
    Empty texts (null counts as empty) and texts that hold a mark stay plain.
    The cuts follow from seed and id alone: rows that share an id are cut by the
    same draws, rows without one by those of ``null``; repeated rows give
    repeated rows, an empty table none; further columns are ignored."""
    def run(batches):
        yield from transformed(batches, rate, spm_rate)
    return drawn(docs, seed).mapInArrow(run, SHAPE)


def restore(outputs: DataFrame) -> DataFrame:
    """The rows of ``outputs`` with ``restored``, the text rebuilt from
    ``form`` and ``output`` alone (null output: the empty text).  Other columns stay."""
    if "restored" in outputs.columns:
        raise ValueError("the table has a column 'restored' already")
    return outputs.mapInArrow(restored, T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())]))
