"""Operator 7: personal data, found through disguises with positions kept.

Base patterns (email, ip, card, phone) are found in the text as their contract states them. Then
transducers rewrite the text into a plain form and note for every character of it the source span
it came from: homoglyphs and full-width forms become ASCII, spelled digits become digits, "at" and
"dot" disguises (bracketed, or spelled out between a name and a domain) become ``@`` and ``.``;
invisible characters vanish. Two forms are made: a narrow one (runs of four spelled digits; bare "at"
and "dot" only where both are spelled) and a wide one (every spelled digit, every bare "dot" between
digits, a bare "at" before a domain with a spelled dot, or before any dotted domain where a word like "mail"
or "contact" introduces the name), so that a rewrite of the wide form which spoils a
hit doesn't lose it. The same identifiers are sought in both, and a hit that a rewrite
touched is mapped back to the source characters. A hit that overlaps a base span is added only if
it holds that span and more.

Spans are (kind, start, end) in code points of the source, end exclusive, by start and then in
the order of ``KINDS``; found through a disguise, a span has the same kind. Edge cases: a null
or empty text has no spans; repeated rows repeat their results; a null doc_id is kept; other columns
are not read; an empty table gives no rows. Texts are read whole, in time linear in the text.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import thin
from triage.llm.secret_scan import Covered, scan_with

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: the base kinds, in order, and their patterns
KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

# fixed values: spelled digits, and letters of other scripts that look like ASCII ones
SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
           "eight": "8", "nine": "9"}
HOMOGLYPHS = dict(zip("асеорхуіјѕАВСЕНКМОРТХ"
                      "αονρΑΒΕΖΗΙΚΜΝΟΡΤΧ",
                      "aceopxyijsABCEHKMOPTXaovpABEZHIKMNOPTX", strict=True))
INVISIBLE = frozenset("​‌‍⁠­﻿")
SPELL = re.compile(r"(?i)\b(?:%s)\b(?:[\x20.,-]{0,2}\b(?:%s)\b){3,}" % (("|".join(SPELLED),) * 2))
SPELL_ANY = re.compile(SPELL.pattern.replace("{3,}", "*"))
SPELL_ONE = re.compile("(?i)" + "|".join(SPELLED))
# bracketed disguises anywhere; bare words only between a name and a domain that ends in "dot word"
AT_DOT = re.compile(r"(?i)(?:(?<!\x20)\x20++)?(?:[\[({<]\x20*+(at|dot)\x20*+[\])}>])\x20*+")
BARE = re.compile(r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(\x20+at\x20+)[A-Za-z0-9-]+(?:(?:\x20+dot\x20+|\.)[A-Za-z0-9-]+)*(?:\x20+dot\x20+)[A-Za-z0-9-]+")
BARE_DOT = re.compile(r"(?i)(?<!\x20)\x20++dot\x20++")
# wide form: "dot" between digits, "at" between a name and a domain that ends in letters and either spells a
# dot or is introduced by one of these words; without such a sign "look at example.com" is prose
CUE = re.compile(r"(?i)(?:\be-?mails?|\bmail(?:to|box)?|\bcontact|\breach|\baddress|\bwrite|\bwriting|\binbox)(?:\x20(?:me|us|is|to|at|for|:|address))*[:=]?[\x20\t]*[\"'(<]?([A-Za-z0-9._%+-]{1,64})$")
NO_NAMES = frozenset("me us him her them it you is to for at or and the a an by via our my your address out back here".split())
A_DIGIT = r"(?:\d|\b(?:%s)\b)" % "|".join(SPELLED)
DIGIT_DOT = re.compile(rf"(?i)(?<!\x20)\x20++dot\x20++(?={A_DIGIT})")
DIGIT_BEFORE = re.compile(rf"(?i){A_DIGIT}$")
BARE_AT = re.compile(r"(?i)(?<=[A-Za-z0-9._%+-])\x20+at\x20+(?=[A-Za-z0-9-])")
DOTTED = re.compile(r"(?i)[A-Za-z0-9-]++(?:(?:\x20+dot\x20+|\.)[A-Za-z0-9-]++)+")
SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])\x20?@\x20?(?=[A-Za-z0-9-]+\x20?\.)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    """Local part, ``@`` and domain, leftmost first, in time linear in the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > end and text[lo - 1] in LOCAL_CHARS:
            lo -= 1
        m = DOMAIN.match(text, at) if lo < at else None
        if m:
            end = m.end()
            yield lo, end
        at = text.find("@", max(end, at + 1))


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, kinds by number."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def plain_of(c: str) -> str | None:
    """ASCII form of a character that isn't ASCII: look-alike, NFKC or decimal value; none: null."""
    plain = "" if c in INVISIBLE else HOMOGLYPHS.get(c) or unicodedata.normalize("NFKC", c)
    if len(plain) == 1 and not plain.isascii() and plain.isdecimal():
        plain = str(unicodedata.decimal(plain))
    return plain if plain.isascii() else None


def introduced(text: str, end: int) -> bool:
    """Whether the word that ends at ``end`` is a name that a word like "mail" or "contact" stands before."""
    cue = CUE.search(text[max(0, end - 128):end])
    return bool(cue) and cue[1].lower() not in NO_NAMES and any(c.isalpha() for c in cue[1])


def rewrites(text: str, wide: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, plain form) of every disguise, in order and apart from each other."""
    out = []
    if not text.isascii():
        odd = {c: p for c in set(text) if not c.isascii() and (p := plain_of(c)) is not None}
        if odd:
            out += [(i, i + 1, odd[c]) for i, c in enumerate(text) if c in odd]
    low = text.lower()
    if any(w in low for w in SPELLED) if wide else sum(low.count(w) for w in SPELLED) >= 4:
        for m in (SPELL_ANY if wide else SPELL).finditer(text):
            at = m.start()
            for d in SPELL_ONE.finditer(m[0]):
                # spaces and marks between two spelled digits go with the digit after them
                gap = re.search(r"[\x20.,-]*$", text[at:m.start() + d.start()])
                lo = at + gap.start() if at > m.start() else m.start() + d.start()
                out.append((lo, m.start() + d.end(), SPELLED[d[0].lower()]))
                at = m.start() + d.end()
    if "dot" in low or "at" in low:
        if re.search(r"[\[({<]\x20*(?:at|dot)\x20*[\])}>]", low):
            out += [(m.start(), m.end(), "@" if m[1].lower() == "at" else ".") for m in AT_DOT.finditer(text)]
        if " dot " in low and " at " in low:
            for m in BARE.finditer(text):
                out.append((m.start(1), m.end(1), "@"))
                out += [(m.end(1) + d.start(), m.end(1) + d.end(), ".") for d in BARE_DOT.finditer(text[m.end(1):m.end()])]
        if wide and " dot " in low:
            out += [(m.start(), m.end(), ".") for m in DIGIT_DOT.finditer(text) if DIGIT_BEFORE.search(text, max(0, m.start() - 6), m.start())]
        if wide and " at " in low:
            for m in BARE_AT.finditer(text):
                d = DOTTED.match(text, m.end())
                if d and len(d[0]) > 1 and d[0][-2:].isalpha() and (" " in d[0] or introduced(text, m.start())):
                    out.append((m.start(), m.end(), "@"))
                    out += [(m.end() + x.start(), m.end() + x.end(), ".") for x in BARE_DOT.finditer(d[0])]
    if " @" in text or "@ " in text:
        out += [(m.start(), m.end(), "@") for m in SPACED_AT.finditer(text)]
    apart, last = [], 0
    for a, b, plain in sorted(out):
        if a >= last:
            apart.append((a, b, plain))
            last = b
    return apart


class Plain:
    """Plain text of a rewriting, and where its characters come from."""

    def __init__(self, text: str, changes: list[tuple[int, int, str]]):
        parts, at, to = [], 0, 0
        self.changes, self.lo, self.hi = changes, [], []  # lo, hi: places of the plain forms
        for a, b, plain in changes:
            parts += [text[at:a], plain]
            self.lo.append(to + a - at)
            to = self.lo[-1] + len(plain)
            self.hi.append(to)
            at = b
        self.text = "".join([*parts, text[at:]])

    def source(self, i: int) -> tuple[int, int]:
        """Start and end in the source of the plain text's character ``i``."""
        k = bisect_right(self.hi, i)  # the changes before it
        if k < len(self.lo) and self.lo[k] <= i:
            return self.changes[k][:2]
        at = i + (self.changes[k - 1][1] - self.hi[k - 1] if k else 0)
        return at, at + 1

    def touched(self, a: int, b: int) -> bool:
        """Whether a change lies in the plain text from ``a`` to ``b``; one that vanished, between two characters."""
        k = bisect_right(self.hi, a)
        return k < len(self.lo) and self.lo[k] < b


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) of a text, each in order."""
    if not text:
        return [], []
    base = identifiers(text)
    covered, same = Covered(base), {(a, b) for a, _, b in base}
    more: set[tuple[int, int, int]] = set()
    narrow, wide = rewrites(text), rewrites(text, True)
    for changes in ([narrow] if narrow == wide else [narrow, wide]):
        if not changes:
            continue
        plain = Plain(text, changes)
        for a, k, b in identifiers(plain.text):
            if not plain.touched(a, b):
                continue
            lo, hi = plain.source(a)[0], plain.source(b - 1)[1]
            if (lo, hi) not in same and covered.within(lo, hi):
                more.add((lo, k, hi))
    return ([(KINDS[k], a, b) for a, k, b in base], [(KINDS[k], a, b) for a, k, b in sorted([*base, *more])])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row of ``docs(doc_id, text)``."""
    return scan_with(docs, find)


def mask(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans as the first."""
    if not text:
        return text
    out, at = [], 0
    for kind, a, b in find(text)[1]:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked; all other columns pass through."""
    at, name = docs.columns.index("text"), docs.columns

    def run(batches):
        for b in thin(batches):
            cols = list(b.columns)
            cols[at] = pa.array([mask(t.as_py()) for t in cols[at]], pa.string())
            yield pa.RecordBatch.from_arrays(cols, name)

    return docs.mapInArrow(run, docs.schema)
