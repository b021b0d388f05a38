"""Operator 4: secret scan by sliding-window entropy.

Base patterns (assign, access, hex) are found as their contract states them. The method adds spans
of kind ``entropy``: a candidate string is a maximal run of the characters of base64 and
identifiers; for each of its character classes (hex, letters and digits, base64) a window slides
over the stretches of that class, symbol counts change by one in and one out, and so does the sum
that gives the window's Shannon entropy. Windows at or above the class's threshold are joined to
spans. Allow-listed candidates (word-like, UUIDs, repeated patterns, placeholders, runs within a
URL, paths of words) are dropped before the scan, and so are candidates without a digit. Spans that overlap a base span are not
added again.

Spans are (kind, start, end) in code points of the text, end exclusive, by start and then in the
order of ``KINDS``. Edge cases: a null or empty text has no spans; repeated rows repeat their
results; a null doc_id is kept; other columns are not read; an empty table gives no rows. Texts are
read whole and every scan is linear in the text.
"""

from __future__ import annotations

import math
import re
import sys
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import thin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: the base kinds, in order, and their patterns
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile("""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{16,}")

# (class, its characters, window, bits of entropy a symbol)
CLASSES = (("hex", "0-9a-fA-F", 20, 3.0), ("alnum", "0-9A-Za-z", 20, 3.7), ("base64", "0-9A-Za-z+/_=-", 24, 4.0),
           ("short", "0-9A-Za-z+/_=-", 20, 3.8))  # as base64, for the shortest candidate
CANDIDATE = re.compile("(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]{20,}")
STRETCH = {name: re.compile(f"[{chars}]{{{size},}}") for name, chars, size, _ in CLASSES}
# a URL after its scheme; white space, quotes, commas, brackets and braces end it
URL = re.compile(r"://[\w.~:/?#@!$&*+;=%-]*")
# fixed values: allow-list of what looks random and is no secret
ALLOW = tuple(re.compile(p) for p in (
    r"[A-Za-z]+(?:[-_/][A-Za-z]+)*",                                                   # words and paths of words
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",    # UUID
    r"(.{1,4})\1+.{0,4}",                                                              # a repeated pattern
    r"[0-9/_=+-]+",                                                                    # digits and rules only
    r"(?i:.*(?:example|sample|dummy|placeholder|xxxx|changeme).*)",
))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, kinds by number."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 12:
            out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def windows(s: str, size: int, least: float):
    """Spans of ``s`` covered by windows of entropy ``least`` or more, by incremental counts.

    Entropy is log2(size) - sum(c * log2(c)) / size; a step changes two of its terms.
    """
    term = [0.0] + [c * math.log2(c) for c in range(1, size + 1)]
    count: dict[str, int] = {}
    total, spans = 0.0, []
    top = math.log2(size)
    for i, ch in enumerate(s):
        c = count.get(ch, 0)
        total += term[c + 1] - term[c]
        count[ch] = c + 1
        if i >= size:
            old = s[i - size]
            c = count[old]
            total -= term[c] - term[c - 1]
            count[old] = c - 1
        if i >= size - 1 and top - total / size >= least:
            lo = i - size + 1
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = i + 1
            else:
                spans.append([lo, i + 1])
    return spans


def entropy_spans(text: str) -> list[tuple[int, int]]:
    out, urls, last = [], URL.finditer(text), (0, 0)
    for m in CANDIDATE.finditer(text):
        s = m[0]
        while last and last[1] <= m.start():
            u = next(urls, None)
            last = u and u.span()
        if any(p.fullmatch(s) for p in ALLOW) or not any(c.isdigit() for c in s):
            continue
        if last and last[0] < m.start():
            continue
        for name, _, size, least in CLASSES:
            for r in STRETCH[name].finditer(s):
                out += [(m.start() + r.start() + a, m.start() + r.start() + b) for a, b in windows(r[0], size, least)]
    merged: list[list[int]] = []
    for a, b in sorted(out):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


class Covered:
    """The places that spans (start, kind, end) in order cover, as intervals apart from each other."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.lo: list[int] = []
        self.hi: list[int] = []
        for a, _, b in spans:
            if self.hi and a < self.hi[-1]:
                self.hi[-1] = max(self.hi[-1], b)
            else:
                self.lo.append(a)
                self.hi.append(b)

    def meets(self, a: int, b: int) -> bool:
        """Whether a span overlaps the places from ``a`` to ``b``."""
        k = bisect_right(self.hi, a)
        return k < len(self.lo) and self.lo[k] < b

    def within(self, a: int, b: int) -> bool:
        """Whether every span that overlaps the places from ``a`` to ``b`` lies inside them."""
        k, j = bisect_right(self.hi, a), bisect_left(self.lo, b) - 1
        return k > j or (self.lo[k] >= a and self.hi[j] <= b)


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) of a text, each in order."""
    if not text:
        return [], []
    base = base_spans(text)
    covered = Covered(base)
    more = [(a, 3, b) for a, b in entropy_spans(text) if not covered.meets(a, b)]
    name = (*KINDS, "entropy")
    return ([(name[k], a, b) for a, k, b in base], [(name[k], a, b) for a, k, b in sorted(base + more)])


SPAN = "array<struct<kind:string,start:long,end:long>>"


def scan_with(docs: DataFrame, finder) -> DataFrame:
    """(doc_id, base, spans) of every row, spans as arrays."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in thin(batches):
            base, spans = [], []
            for t in b.column(1):
                one, two = finder(t.as_py())
                base.append([{"kind": k, "start": a, "end": z} for k, a, z in one])
                spans.append([{"kind": k, "start": a, "end": z} for k, a, z in two])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, kind), pa.array(spans, kind)], ["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, base {SPAN}, spans {SPAN}")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row of ``docs(doc_id, text)``."""
    return scan_with(docs, find)
