"""Personal data by a skip-chain conditional random field.

Base matches (e-mail addresses, IP addresses, payment cards, phone numbers) are
found by pattern.  The field labels all mentions of a document that look like
such data: base matches are observed, the others are numbers of seven or more
digits and runs with an at sign that no pattern took.  Neighbouring mentions
share chain potentials, and mentions that are equal or similar (same last seven
digits, same address without regard to case) share skip potentials, so that a
number seen once in full is also known where it is written differently, however
often it is repeated in between.  Loopy message passing, until the messages
settle, gives each mention's label; those that are personal data are
added to the base matches.

The weights maximise the pseudo-likelihood of base labels in all whole texts:
negatives are mentions related to no base match, and each mention also occurs
with its telling marks hidden, so that the potentials have to carry it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, pick

KINDS = ("email", "ip", "card", "phone")
#: messages have settled when none changes more than this in a round
SETTLED = 1e-4
#: rounds at most: as many as these, and some for each mention that a message may have to pass
ROUNDS, ROUNDS_A_MENTION = 200, 4
#: bytes of text that are searched in one go
RUN_BYTES = 512 << 10

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?\(?[0-9][0-9\x20().-]*[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from their at signs (so
    that long runs without one cost nothing)."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin, found = at, _DOMAIN.match(text, at + 1)
        if found:
            while begin > last and text[begin - 1] in _LOCAL:
                begin -= 1
        if found and begin < at:
            out.append((begin, found.end()))
            last = found.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base matches, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGITS.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# -- the field -------------------------------------------------------------------
N_FEATURES = 14
#: features that are hidden in the second copy of a training mention
TELLING = [1, 2, 3, 10, 11]


def described(text: str, a: int, b: int) -> list[float]:
    s = text[a:b]
    digits = _NOT_DIGITS.sub("", s)
    n, parts = len(digits), s.split(".")
    return [1.0, "+" in s, "@" in s, len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 for p in parts), n < 7, 7 <= n <= 9,
            10 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n > 19, 12 <= n <= 19 and luhn(digits), "(" in s, "-" in s, " " in s]


def key_of(text: str, a: int, b: int) -> str:
    s = text[a:b]
    return s.lower().strip(".,;:!?()<>\"'") if "@" in s else _NOT_DIGITS.sub("", s)[-7:]


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, label, end): base matches with their kind + 1, others 0."""
    found = [(m.start(), m.end()) for m in _NUMBER.finditer(text) if m.end() - m.start() >= 7 and len(_NOT_DIGITS.sub("", m.group())) >= 7]
    at = text.find("@")
    while at >= 0:
        a, b = at, at + 1
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if b - a > 2:
            found.append((a, b))
        at = text.find("@", b)
    out = [(a, k + 1, b) for a, k, b in base]
    taken = sorted((a, b) for a, _, b in base)
    starts = np.array([a for a, _ in taken] or [1 << 60])
    highest = np.maximum.accumulate(np.array([b for _, b in taken] or [0]))
    for a, b in sorted(found):
        at_or_before = int(np.searchsorted(starts, b))
        if not (at_or_before and highest[at_or_before - 1] > a):
            out.append((a, 0, b))
    return sorted(out)


def skip_edges(keys: list[str]) -> list[tuple[int, int]]:
    """Each mention with the one before it that has its key: as many edges as mentions at most."""
    last: dict[str, int] = {}
    out = []
    for i, k in enumerate(keys):
        if k in last:
            out.append((last[k], i))
        last[k] = i
    return out


def base_edges(keys: list[str], observed: np.ndarray, may: np.ndarray) -> list[tuple[int, int]]:
    """Each mention that is no base match with the nearest base match that has
    its key and a label that it may have (the earlier of two as near): as many
    edges as mentions at most."""
    seen: dict[tuple[str, int], list[int]] = {}
    for i, (key, label) in enumerate(zip(keys, observed.tolist())):
        if label:
            seen.setdefault((key, label), []).append(i)
    out = []
    for i in np.flatnonzero(observed == 0).tolist():
        near = []
        for label in range(1, may.shape[1]):
            at = seen.get((keys[i], label), []) if may[i, label] else []
            k = bisect_left(at, i)
            near += [(abs(i - j), j) for j in at[max(0, k - 1):k + 1]]
        if near:
            j = min(near)[1]
            out.append((min(i, j), max(i, j)))
    return out


def may_be(text: str, rows: list[tuple[int, int, int]], keys: list[str]) -> np.ndarray:
    """Which labels each mention can have: none, its own, and those of base
    matches that are written as it is (addresses) or whose digits end with its
    digits or the other way round (numbers)."""
    may = np.zeros((len(rows), len(KINDS) + 1), bool)
    may[:, 0] = True
    full: dict[str, set[tuple[int, str]]] = {}
    for (a, label, b), key in zip(rows, keys):
        if label:
            full.setdefault(key, set()).add((label, key if "@" in key else _NOT_DIGITS.sub("", text[a:b])))
    for i, ((a, label, b), key) in enumerate(zip(rows, keys)):
        may[i, label] = True
        if label == 0 and key in full:
            own = key if "@" in key else _NOT_DIGITS.sub("", text[a:b])
            for other, written_ in full[key]:
                may[i, other] |= own.endswith(written_) or written_.endswith(own)
    return may


@dataclass
class Field:
    """``unary`` (features x labels), ``chain`` and ``skip`` (labels x labels) weights."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, x: np.ndarray, observed: np.ndarray, skips: list[tuple[int, int]], may: np.ndarray | None = None) -> np.ndarray:
        """Each mention's label probabilities by loopy sum-product, damped, until
        the messages settle; ``observed``: a base match's label, else 0; ``may``: the
        labels that a mention can have (all, if not given)."""
        n = len(x)
        score = x @ self.unary
        if may is not None:
            score[~may] = -30.0
        fixed = observed > 0
        score[fixed] = -30.0
        score[fixed, observed[fixed]] = 30.0
        edges = np.array([(i, i + 1) for i in range(n - 1)] + skips, int).reshape(-1, 2)
        tables = np.concatenate([np.repeat(self.chain[None], n - 1, 0) if n > 1 else np.zeros((0, *self.chain.shape)), np.repeat(self.skip[None], len(skips), 0)])
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), score.shape[1]))
        for _ in range(ROUNDS + ROUNDS_A_MENTION * n):
            total = score.copy()
            np.add.at(total, target, message)
            into = (total[source] - message[reverse])[:, :, None] + tables
            top = into.max(1, keepdims=True)
            new = np.log(np.exp(into - top).sum(1)) + top[:, 0]
            new -= new.max(1, keepdims=True)
            change = np.abs(new - message).max(initial=0.0)
            message = 0.5 * message + 0.5 * new
            if change < SETTLED:
                break
        total = score.copy()
        np.add.at(total, target, message)
        p = np.exp(total - total.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def added(self, text: str, base: list[tuple[int, int, int]], least: float = 0.5) -> list[tuple[int, int, int]]:
        rows = mentions(text, base)
        observed = np.array([label for _, label, _ in rows], int)
        if not len(rows) or (observed > 0).all():
            return []
        x = np.array([described(text, a, b) for a, _, b in rows], float)
        keys = [key_of(text, a, b) for a, _, b in rows]
        may = may_be(text, rows, keys)
        if not may[observed == 0, 1:].any():
            return []
        skips = list(dict.fromkeys(skip_edges(keys) + base_edges(keys, observed, may)))
        p = self.beliefs(x, observed, skips, may)
        label = p.argmax(1)
        return [(a, int(k) - 1, b) for (a, was, b), k, q in zip(rows, label, p.max(1)) if was == 0 and k > 0 and q >= least]


#: bits of a number in a packed row
_COUNT_BITS, _LABEL_BITS = 2, 3


def counted(texts) -> Counter[int]:
    """How often each (features, labels around, label) occurs among the
    mentions of ``texts`` that are known, each packed as a number."""
    n_labels = len(KINDS) + 1
    out: Counter[int] = Counter()
    for text in texts:
        rows = mentions(text, base_spans(text))
        labels, keys = [k for _, k, _ in rows], [key_of(text, a, b) for a, _, b in rows]
        sure = {k for k, lab in zip(keys, labels) if lab}
        skips: dict[int, list[int]] = {}
        for i, j in skip_edges(keys):
            skips.setdefault(i, []).append(j)
            skips.setdefault(j, []).append(i)
        for i, (a, label, b) in enumerate(rows):
            if label == 0 and keys[i] in sure:
                continue        # it may well be the same data: not known
            row = 0
            for j in (i - 1, i + 1):
                if 0 <= j < len(rows):
                    row += 1 << _COUNT_BITS * labels[j]
            for j in skips.get(i, []):      # the one before and the one after at most
                row += 1 << _COUNT_BITS * (n_labels + labels[j])
            for f, on in enumerate(described(text, a, b)):
                row |= int(bool(on)) << (2 * n_labels * _COUNT_BITS + f)
            out[row << _LABEL_BITS | label] += 1
    return out


def unpacked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels around and label of packed rows."""
    n_labels = len(KINDS) + 1
    label, rest = rows & ((1 << _LABEL_BITS) - 1), rows >> _LABEL_BITS
    near = rest[:, None] >> (_COUNT_BITS * np.arange(2 * n_labels)) & ((1 << _COUNT_BITS) - 1)
    x = rest[:, None] >> (2 * n_labels * _COUNT_BITS + np.arange(N_FEATURES)) & 1
    return x.astype(float), near.astype(float), label


def fit(texts: list[str]) -> Field:
    """The weights for ``texts``."""
    return fit_counts(counted(texts))


def fit_counts(counts: dict[int, int], rounds: int = 300, rate: float = 0.1, hold: float = 1e-3) -> Field:
    """Pseudo-likelihood weights by Adam, of what ``counted`` returns; without
    any base match the field adds nothing.  A label's weights are held back in
    proportion to its share, so that a kind that is rare among all mentions is
    learnt as one that isn't."""
    n_labels = len(KINDS) + 1
    packed = np.array(sorted(counts), np.int64)
    one, near, y = unpacked(packed)
    if not y.any():
        quiet = np.zeros((N_FEATURES, n_labels))
        quiet[0, 0] = 50.0
        return Field(quiet, np.zeros((n_labels, n_labels)), np.zeros((n_labels, n_labels)))
    hidden = one.copy()
    hidden[:, TELLING] = 0
    z = np.concatenate([np.column_stack([one, near]), np.column_stack([hidden, near])])
    often = np.tile(np.array([counts[r] for r in packed.tolist()], float), 2)
    often /= often.sum()
    target = np.tile(np.eye(n_labels)[y], (2, 1))
    hold_each = hold * (often @ target)
    w = np.zeros((z.shape[1], n_labels))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        s = z @ w
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        slope = z.T @ ((p - target) * often[:, None]) + hold_each * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-12)
    chain, skip = w[N_FEATURES:N_FEATURES + n_labels], w[N_FEATURES + n_labels:]
    return Field(w[:N_FEATURES], (chain + chain.T) / 2, (skip + skip.T) / 2)


def train(docs: DataFrame) -> Field:
    """The field's weights from the whole texts of all documents: their known
    mentions are counted by what the weights depend on, and the counts, a few
    thousand rows whatever the input, come to the driver."""
    @lean
    def run(batches):
        for b in chunks(batches, "text", RUN_BYTES):
            found = counted(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["row", "n"])
    texts = pick(docs, "text").where(F.col("text").rlike(r"@|[0-9][0-9\x20().-]{5,}[0-9]"))
    rows = texts.mapInArrow(run, "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).collect()
    return fit_counts({r["row"]: r["n"] for r in rows})


def find_private(docs: DataFrame, field: Field, mask: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, the numbers
    of base matches ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256`` (of the base matches, written kind:start:end) and ``spans``
    (base and added ones), by start, then kind; offsets in code points.

    Null and empty texts have none; the whole text is searched, however long.
    Repeated rows give repeated rows, an empty table none.  ``mask`` adds ``masked``, the text with each
    span replaced by its kind in brackets (a null text stays null; spans that overlap are one,
    named by the first); ``keep`` carries further columns."""
    columns = [c for c in dict.fromkeys(keep) if c != "doc_id"]
    rows = pick(docs, "doc_id", *dict.fromkeys(("text", *columns)))
    names = ["doc_id", *columns]

    @lean
    def run(batches):
        for b in chunks(batches, "text", RUN_BYTES):
            counts: list[list[int]] = [[], [], [], []]
            digests, spans, masked = [], [], []
            for raw in b.column("text").to_pylist():
                text = raw or ""
                base = base_spans(text)
                for k in range(4):
                    counts[k].append(sum(kind == k for _, kind, _ in base))
                every = sorted(base + field.added(text, base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(every))
                if mask:
                    masked.append(None if raw is None else hidden_text(text, every))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans),
                 *([pa.array(masked, pa.string())] if mask else [])],
                names=[*names, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", *(["masked"] if mask else [])])
    shape = ", ".join(f"`{c}` {t}" for c, t in rows.select(*names).dtypes)
    shape += ", n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + (", masked string" if mask else "")
    return rows.mapInArrow(run, shape)


def hidden_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
