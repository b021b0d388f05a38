"""Fill-in-middle transformation: texts cut at two places and rearranged around sentinels.

A text is a row of units (code points, words or lines); its n + 1 unit boundaries are byte offsets.
A learned rank index stands for them: line segments, each fitted to as many boundaries as stay
within ``ERROR`` bytes of the line (a cone of slopes that narrows with each boundary), and a
residual of one byte a boundary. A cut after unit i is the segment's prediction plus the residual,
exactly, so a text is cut without decoding it.

Cuts, form and order come from the sha256 of ``seed:doc_id``; a document's result depends on
nothing else. Everything runs row by row: no shuffle, no state, memory bounded by a slice of rows.

Edge cases: a null text is an empty one; an empty text, one that holds a sentinel, and the share
``plain`` stay whole (form ``plain``, null sizes). A null doc_id hashes as the empty text. A text of
one unit is cut before or after it. Very long texts only lengthen the index. Repeated rows give
repeated results; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import thin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ERROR = 120  # a prediction misses by this many bytes at most; rounding adds one, a residual is one signed byte
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OUT = "doc_id long, n long, form string, prefix_units long, middle_units long, output string"


@dataclass
class RankIndex:
    """Byte offset of the i-th boundary: base + round(slope * (i - start)) + residual[i]."""

    start: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, i):
        k = np.searchsorted(self.start, i, side="right") - 1
        return self.base[k] + np.rint(self.slope[k] * (i - self.start[k])).astype(np.int64)

    def __getitem__(self, i) -> int:
        return int(self.predict(i) + self.residual[i])


def fit_index(y: np.ndarray, error: int = ERROR) -> RankIndex:
    """Segments from left to right, each as long as one line through its first boundary can be."""
    start, slope = [], []
    at, n = 0, len(y)
    while at < n:
        first, low, high, step = at, -np.inf, np.inf, 256
        at += 1
        while at < n:
            to = min(n, at + step)
            run = np.arange(at - first, to - first)
            rise = y[at:to] - y[first]
            top = np.minimum(high, np.minimum.accumulate((rise + error) / run))
            bottom = np.maximum(low, np.maximum.accumulate((rise - error) / run))
            shut = np.flatnonzero(bottom > top)
            fits = int(shut[0]) if len(shut) else len(run)
            if fits:
                low, high = bottom[fits - 1], top[fits - 1]
            at += fits
            if len(shut):
                break
            step = min(2 * step, 1 << 16)
        start.append(first)
        slope.append((low + high) / 2 if at - first > 1 else 0.0)
    index = RankIndex(np.array(start), y[start], np.array(slope), np.zeros(0, dtype=np.int8))
    index.residual = (y - index.predict(np.arange(n))).astype(np.int8)
    return index


def boundaries(data: np.ndarray, unit: str) -> np.ndarray:
    """Byte offsets of all unit boundaries of a text, its end included.

    Units tile the text: a word holds the white space behind it, a line its line feed.
    """
    if unit == "char":
        first = (data & 0xC0) != 0x80
    elif unit == "word":
        space = (data == 32) | ((data >= 9) & (data <= 13))
        first = ~space & np.concatenate([[True], space[:-1]])
    elif unit == "line":
        first = np.concatenate([[True], data[:-1] == 10])
    else:
        raise ValueError(f"unit {unit!r}: char, word or line")
    if len(first):
        first[0] = True  # white space before the first word belongs to it
    return np.append(np.flatnonzero(first[:len(data)]), len(data)).astype(np.int64)


def _hashes(seed: int, doc_id) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def rearrange(text: bytes, doc_id, unit: str = "char", seed: int = 1, plain: int = 10, spm: int = 20):
    """(units, form, prefix units, middle units, output) of one text."""
    y = boundaries(np.frombuffer(text, dtype=np.uint8), unit)
    n = len(y) - 1
    h1, h2, h3, h4 = _hashes(seed, doc_id)
    if not text or h3 % 100 >= 100 - plain or any(s.encode() in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    index = fit_index(y)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index[i], index[j]
    head, mid, tail = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        parts, form = (SUFFIX.encode(), tail, PREFIX.encode(), head, MIDDLE.encode(), mid), "spm"
    else:
        parts, form = (PREFIX.encode(), head, SUFFIX.encode(), tail, MIDDLE.encode(), mid), "psm"
    return n, form, i, j - i, b"".join(parts)


def transform(docs: DataFrame, unit: str = "char", seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, output) of every document.

    ``plain`` and ``spm`` are shares in percent: texts left whole, and rearranged ones that put the
    suffix first.
    """
    if unit not in ("char", "word", "line"):
        raise ValueError(f"unit {unit!r}: char, word or line")

    def run(batches):
        for b in thin(batches, 128):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            ids = b.column(0).to_pylist()
            rows = [rearrange(t or b"", d, unit, seed, plain, spm) for t, d in zip(texts, ids)]
            n, form, head, mid, out = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(head, pa.int64()),
                 pa.array(mid, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` rearranged: no text holds a sentinel, so the parts split apart uniquely."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
