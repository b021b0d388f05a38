"""Operator 8: SentencePiece encoding and decoding with seeded merge-dropout.

Merge-type segmentation by an agenda: the pair of neighbouring symbols whose joint piece scores
best is merged first (ties: the leftmost). Each candidate taken from the agenda is skipped if a
hash keyed by (seed, doc_id, number of the unit in the text, place, length) falls below ``dropout``;
a skipped pair may come back as part of a longer one. So segmentations vary with the seed, with the
document and from one occurrence of a word to the next, and the same call always gives the same
ids, on any executor. With ``dropout=0`` the ids are those of the sentencepiece library.

A space becomes U+2581, one stands before the text, and characters without a piece fall back to
byte pieces. No piece holds a newline or goes on with U+2581 after another character, so units
(spaces and the word after them, newlines) are segmented apart. A worker keeps a bounded table of
units with the ids and the merges they have without dropout: an occurrence that skips none of those
merges has those ids, any other is segmented by itself. Decoding returns every text as it was; a U+2581 of the text itself is written in bytes for
that. The vocabulary is read on the driver from ``model_path`` and travels with the tasks.

Edge cases: a null or empty text has no ids, and no ids decode to an empty text; a null doc_id
counts as one id; unpaired surrogates can't stand in a Spark string; repeated rows get equal ids; other
columns are not read; an empty table gives no rows. Long texts are read whole, unit by unit.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from collections import Counter
from functools import partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import lists, mix, process_cache, thin

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KNOWN = 80_000   # units that a worker keeps
OCCURRENCES = 1 << 15  # units whose merges are tested at once
ROWS = 256       # rows in a batch that goes back to Spark
UNIT = re.compile(" *[^ \n▁]+| +|\n|▁")
SPACE = "▁"


MIX = (0x9E3779B1, 0x85EBCA6B, 0x2C1B3C6D, 0x297A2D39)


class Vocabulary:
    """Pieces, scores and byte pieces of a merge-type model, and its merges as a hash table."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.score = {p: s for p, s, k in zip(pieces, scores, kinds, strict=True) if k == "normal"}
        self.id = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "normal"}
        self.byte = {int(p[3:-1], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "byte"}
        self.out = [bytes([int(p[3:-1], 16)]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "normal" else b""
                    for p, k in zip(pieces, kinds, strict=True)]
        self.tag = zlib.crc32("\n".join(pieces).encode())
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("pieces across a newline or a word's end: units can't be segmented apart")
        self.pieces = len(pieces)
        if len(self.byte) != 256:
            raise ValueError("a model without byte pieces is not lossless")
        # bytes of all pieces, and where those of each begin
        self.data = np.frombuffer(b"".join(self.out), dtype=np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in self.out])])


def load(model_path: str = MODEL) -> Vocabulary:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = m.get_piece_size()
    kind = lambda i: "byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal"
    return Vocabulary([m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)], [kind(i) for i in range(n)])


def skipped(base, place, length, least):
    """Whether the candidates of units with hash ``base`` are skipped, as arrays of uint32."""
    return left_out(base ^ (place * np.uint32(MIX[0])) ^ (length * np.uint32(MIX[1])), least)


def left_out(h, least):
    h = (h ^ (h >> np.uint32(15))) * np.uint32(MIX[2])
    h = (h ^ (h >> np.uint32(12))) * np.uint32(MIX[3])
    return (h ^ (h >> np.uint32(15))) < least


def occurrence(keys: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hashes of units by the key of their document and their number in the text."""
    x = mix((keys.astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64))
    return (x >> np.uint64(32)).astype(np.uint32)


def segment(unit: str, voc: Vocabulary, dropout: float, key: int, base: int | None = None) -> list[int]:
    """Ids of one unit; ``base``: hash of its occurrence (default: of key and unit)."""
    if unit == SPACE:
        return [voc.byte[b] for b in SPACE.encode()]
    s = unit.replace(" ", SPACE)
    n, score = len(s), voc.score
    size, left, right = [1] * n, list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[float, int, int]] = []

    def offer(i: int, j: int) -> None:
        length = size[i] + size[j]
        found = score.get(s[i:i + length])
        if found is not None:
            agenda.append((-found, i, length)) if not started else heapq.heappush(agenda, (-found, i, length))

    started = False
    for i in range(n - 1):
        offer(i, i + 1)
    heapq.heapify(agenda)
    started = True
    base = 0 if not dropout else zlib.crc32(unit.encode(), key) if base is None else base
    least = int(dropout * ((1 << 32) - 1))
    while agenda:
        _, i, length = heapq.heappop(agenda)
        j = i + size[i]
        if not size[i] or j >= n or size[i] + size[j] != length:
            continue  # one of the two has been merged
        if least:
            h = (base ^ (i * MIX[0]) ^ (length * MIX[1])) & 0xFFFFFFFF
            h = ((h ^ (h >> 15)) * MIX[2]) & 0xFFFFFFFF
            h = ((h ^ (h >> 12)) * MIX[3]) & 0xFFFFFFFF
            if (h ^ (h >> 15)) < least:
                continue
        size[i], size[j] = length, 0
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
            offer(i, right[i])
        if left[i] >= 0:
            offer(left[i], i)
    out, i = [], 0
    while i < n:
        piece = s[i:i + size[i]]
        found = voc.id.get(piece)
        if found is not None:
            out.append(found)
        else:
            out += [voc.byte[b] for b in piece.encode()]
        i += size[i]
    return out


LONG = 64        # longer units go by the heap
NONE = 1 << 24   # no rank comes near it; times LONG it fits 32 bits
WIDTHS = (2, 4, 6, 8, 12, 16, 24, 40, LONG)
CELLS = 1 << 16  # places segmented at a time: what a round reads stays in the processor's cache


class Merges:
    """Vectorised form of a vocabulary, built once a worker: symbols are piece numbers."""

    BITS = 19

    def __init__(self, voc: Vocabulary):
        symbol = dict(voc.id)
        for p in voc.id:
            for c in p:  # a character that is no piece itself can still be merged
                symbol.setdefault(c, len(symbol) + voc.pieces)
        self.many = max(symbol.values()) + 2  # the last one stands for any other character
        self.char = np.full(0x110000, self.many - 1, dtype=np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        order = sorted(voc.id, key=lambda p: -voc.score[p])
        rank = {p: r for r, p in enumerate(order)}
        self.into = np.array([voc.id[p] for p in order], dtype=np.int32)  # the piece of each rank
        pairs = [(symbol[p[:k]] * self.many + symbol[p[k:]], rank[p]) for p in voc.id for k in range(1, len(p))
                 if p[:k] in symbol and p[k:] in symbol]
        size = 1 << self.BITS
        self.keys, self.rank = np.full(size, -1, dtype=np.int64), np.full(size, NONE, dtype=np.int32)
        keys, ranks = (np.array([x[i] for x in pairs], dtype=np.int64) for i in (0, 1))
        slot, left = self._slot(keys), np.arange(len(pairs))
        while len(left):  # all at once: the first at a free slot gets it, the others go on
            free = self.keys[slot[left]] < 0
            first = np.unique(slot[left[free]], return_index=True)[1]
            got = left[free][first]
            self.keys[slot[got]], self.rank[slot[got]] = keys[got], ranks[got]
            left = np.setdiff1d(left, got, assume_unique=True)
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of symbols, NONE: no such merge."""
        keys = a * np.int64(self.many) + b
        slot = self._slot(keys)
        held, out = self.keys[slot], self.rank[slot]
        todo = np.flatnonzero(held != keys)
        out[todo] = NONE
        todo = todo[held[todo] >= 0]
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.BITS) - 1)
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.rank[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out


def segment_many(units: list[str], voc: Vocabulary, merges: Merges, dropout: float, key: int,
                 base: np.ndarray | None = None, trace: list | None = None) -> list[bytes]:
    """Ids (int32 bytes) of many units of at most ``LONG`` characters.

    ``base``: hashes of the units' occurrences (default: of key and unit); ``trace`` gets each unit's
    merges as (place, length) pairs of bytes.
    """
    if dropout and base is None:
        base = np.fromiter((zlib.crc32(u.encode(), key) for u in units), dtype=np.uint32, count=len(units))
    ids, counts, made, merged = segment_flat(units, voc, merges, dropout, base)
    ends = np.cumsum(counts).tolist()
    if trace is not None:
        pairs, to = made.tobytes(), (2 * np.cumsum(merged)).tolist()
        trace += [pairs[a:b] for a, b in zip([0, *to], to, strict=False)]
    return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]


def segment_flat(units: list[str], voc: Vocabulary, merges: Merges, dropout: float, base: np.ndarray | None):
    """(ids, ids per unit, merges as (place, length), merges per unit) of units of at most ``LONG`` characters.

    Units of like length go side by side, a column each; each round takes every unit's best candidate.
    The skip of a candidate depends on its key alone, so leaving skipped ones out of the agenda
    from the start comes to the same as skipping them when they are taken.
    """
    lens = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    text = merges.char[np.frombuffer("".join(units).replace(" ", SPACE).encode("utf-32-le"), dtype=np.uint32)]
    starts = np.cumsum(lens) - lens
    least = np.uint32(int(dropout * ((1 << 32) - 1)))
    of, place, syms, made = [], [], [], []
    low = 0
    for width in WIDTHS:
        alike = np.flatnonzero((lens > low) & (lens <= width))
        low = width
        for at in range(0, len(alike), CELLS // width):
            some = alike[at:at + CELLS // width]
            got = _columns(text, starts[some], lens[some].astype(np.int32), width, merges,
                           base[some] if dropout else None, least)
            of.append(some[got[0]])
            place.append(got[1])
            syms.append(got[2])
            made += [(some[c], p, n) for c, p, n in got[3]]
    if not of:
        return np.zeros(0, np.int32), np.zeros(len(units), np.int64), np.zeros((0, 2), np.uint8), np.zeros(len(units), np.int64)
    of, place, syms = np.concatenate(of), np.concatenate(place), np.concatenate(syms)
    order = np.argsort(of * (LONG + 1) + place)
    of, place, syms = of[order], place[order], syms[order]
    odd = np.flatnonzero(syms >= voc.pieces)
    if len(odd):  # characters without a piece, in bytes
        own = [[voc.byte[b] for b in units[u].replace(" ", SPACE)[p].encode()] for u, p in zip(of[odd].tolist(), place[odd].tolist(), strict=True)]
        times = np.ones(len(syms), dtype=np.int64)
        times[odd] = [len(x) for x in own]
        of, syms, put = np.repeat(of, times), np.repeat(syms, times), np.zeros(len(syms), dtype=bool)
        put[odd] = True
        syms[np.repeat(put, times)] = [i for x in own for i in x]
    if made:
        unit, place, size = (np.concatenate(c) for c in zip(*made, strict=True))
        order = np.argsort(unit, kind="stable")
        made, merged = np.stack([place[order], size[order]], axis=1).astype(np.uint8), np.bincount(unit, minlength=len(units))
    else:
        made, merged = np.zeros((0, 2), np.uint8), np.zeros(len(units), np.int64)
    return syms, np.bincount(of, minlength=len(units)), made, merged


def _columns(text: np.ndarray, starts: np.ndarray, lens: np.ndarray, width: int, merges: Merges, base, least):
    """(column, place, symbol) of what is left of units of at most ``width`` characters, and the merges of each round."""
    n = len(starts)
    cols = np.arange(n, dtype=np.int64)
    rows = np.arange(width, dtype=np.int64)[:, None]
    inside = rows < lens
    sym = text[np.where(inside, starts + rows, 0)].ravel()  # place * n + column
    right = np.repeat(np.arange(1, width + 2, dtype=np.int32), n)  # where the next symbol starts; one row more as a stop
    left = np.repeat(np.arange(-1, width, dtype=np.int32), n)
    best_of = np.full(width * n, NONE * LONG, dtype=np.int32)  # rank of the pair that starts there, then its place

    def offer(col, i, j):
        """Sets the candidate of the symbols at places ``i`` and ``j`` of columns ``col``; j at the end: none."""
        at = i * n + col
        ok = j < lens[col]
        best_of[at[~ok]] = NONE * LONG
        col, i, at, to = col[ok], i[ok], at[ok], j[ok] * n + col[ok]
        rank = merges.find(sym[at], sym[to])
        if base is not None:
            there = np.flatnonzero(rank < NONE)
            gone = skipped(base[col[there]], i[there].astype(np.uint32), (right[to[there]] - i[there]).astype(np.uint32), least)
            rank[there[gone]] = NONE
        best_of[at] = np.where(rank < NONE, rank * LONG + i, NONE * LONG)

    first = np.flatnonzero(rows[:-1] + 1 < lens) if width > 1 else np.zeros(0, dtype=np.int64)
    offer(first % n, first // n, first // n + 1)
    alive = np.ones(width * n, dtype=bool) & inside.ravel()
    made = []
    while True:
        best = best_of.reshape(width, n).min(axis=0)
        col = np.flatnonzero(best < NONE * LONG)
        if not len(col):
            break
        best = best[col].astype(np.int64)
        i = best % LONG
        at = i * n + col
        j = right[at].astype(np.int64)
        to = j * n + col
        sym[at] = merges.into[best // LONG]
        after = right[to].astype(np.int64)
        right[at] = after
        left[after * n + col] = i
        alive[to] = False
        best_of[to] = NONE * LONG
        made.append((col, i, after - i))
        offer(col, i, after)
        before = left[at].astype(np.int64)
        has = np.flatnonzero(before >= 0)
        offer(col[has], before[has], i[has])
    at = np.flatnonzero(alive)
    return cols[at % n], at // n, sym[at], made


class Known:
    """Units that a worker has met, with the ids and the merges they have without dropout, in flat arrays."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.codes = np.zeros(0, np.int32), np.zeros(0, np.uint32)  # codes: what a merge adds to a skip's hash
        self.first, self.size, self.first_code, self.many = (np.zeros(0, np.int64) for _ in range(4))

    def learn(self, units: list[str], voc: Vocabulary, merges: Merges) -> None:
        ids, size, made, many = segment_flat(units, voc, merges, 0, None)
        self.number.update(zip(units, range(len(self.size), len(self.size) + len(units)), strict=True))
        with np.errstate(over="ignore"):
            codes = (made[:, 0].astype(np.uint32) * np.uint32(MIX[0])) ^ (made[:, 1].astype(np.uint32) * np.uint32(MIX[1]))
        add = np.concatenate
        self.first = add([self.first, len(self.ids) + np.cumsum(size) - size])
        self.first_code = add([self.first_code, len(self.codes) + np.cumsum(many) - many])
        self.ids, self.codes = add([self.ids, ids]), add([self.codes, codes])
        self.size, self.many = add([self.size, size]), add([self.many, many])


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of ``size[0]`` places, then those of the next."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def encode_flat(texts: list[str], voc: Vocabulary, dropout: float, seed: int, doc_ids: list, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, ids per text)."""
    kept = process_cache("pieces")
    if kept.get("vocabulary") != voc.tag:
        kept.update({"vocabulary": voc.tag, "merges": Merges(voc)})
    cut = [UNIT.findall(" " + t) if t else [] for t in texts]
    counts = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
    flat = list(chain.from_iterable(cut))
    del cut

    def numbers(units):
        return np.fromiter(map(known.number.get, units, repeat(-1)), dtype=np.int64, count=len(units))

    at = numbers(flat)
    new = np.flatnonzero(at < 0)
    times = Counter(map(flat.__getitem__, new.tolist()))
    # with dropout, what stands here once is segmented with its dropout alone
    learn = [u for u, n in times.items() if (n > 1 or not dropout) and len(u) <= LONG and u != SPACE]
    if len(known.number) + len(learn) > KNOWN and known.number:
        known.clear()
        at[:] = -1
        new = np.arange(len(flat))
        learn = [u for u, n in Counter(flat).items() if (n > 1 or not dropout) and len(u) <= LONG and u != SPACE]
    if learn:
        known.learn(learn, voc, kept["merges"])
        at[new] = numbers([flat[k] for k in new.tolist()])
        new = new[at[new] < 0]
    if dropout:
        ends = np.cumsum(counts)
        keys = np.array([zlib.crc32(f"{seed}:{d}".encode()) for d in doc_ids], dtype=np.uint64)
        base = occurrence(np.repeat(keys, counts), np.arange(len(flat)) - np.repeat(ends - counts, counts))
        least = np.uint32(int(dropout * ((1 << 32) - 1)))
        hits = []
        for lo in range(0, len(flat), OCCURRENCES):
            have = np.flatnonzero(at[lo:lo + OCCURRENCES] >= 0)
            which = at[lo + have]
            many = known.many[which]
            of = np.repeat(have, many)
            out = of[left_out(base[lo + of] ^ known.codes[_spread(known.first_code[which], many)], least)]
            hits.append(lo + out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out)
        again = np.concatenate([new, *hits])
    else:
        base, again = None, new
    by_heap = [k for k in new.tolist() if len(flat[k]) > LONG or flat[k] == SPACE]
    again = np.setdiff1d(again, by_heap, assume_unique=True)
    own = [flat[k] for k in again.tolist()]
    some, sizes, _, _ = segment_flat(own, voc, kept["merges"], dropout, base[again] if dropout else None)
    first, size = known.first[at] if len(known.first) else np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    size[at >= 0] = known.size[at[at >= 0]]
    parts = [known.ids, some]
    first[again], size[again] = len(known.ids) + np.cumsum(sizes) - sizes, sizes
    held = len(known.ids) + len(some)
    for k in by_heap:
        ids = segment(flat[k], voc, dropout, 0, int(base[k]) if dropout else 0)
        parts.append(np.array(ids, dtype=np.int32))
        first[k], size[k] = held, len(ids)
        held += len(ids)
    upto = np.concatenate([[0], np.cumsum(size)])
    stops = np.cumsum(counts)
    return np.concatenate(parts)[_spread(first, size)], upto[stops] - upto[stops - counts]


def encode_many(texts: list[str], voc: Vocabulary, dropout: float = 0.0, seed: int = 0, doc_ids: list | None = None, known: Known | None = None) -> list[np.ndarray]:
    """Ids of texts; ``known``: units seen before."""
    ids, counts = encode_flat(texts, voc, dropout, seed, [0] * len(texts) if doc_ids is None else doc_ids, known or Known())
    return np.split(ids, np.cumsum(counts)[:-1]) if texts else []


def encode(text: str | None, voc: Vocabulary, dropout: float = 0.0, seed: int = 0, doc_id: int | None = 0) -> np.ndarray:
    return encode_many([text or ""], voc, dropout, seed, [doc_id])[0]


def decode(ids, voc: Vocabulary) -> str:
    """The text that ``ids`` encode."""
    return b"".join(map(voc.out.__getitem__, ids)).decode("utf-8", "replace")[1:] if len(ids) else ""


def lossless(texts: list[str], ids: np.ndarray, counts: np.ndarray, voc: Vocabulary) -> list[bool]:
    """Whether the ids of each text decode to it; ids of texts that differ in bytes are decoded one by one."""
    first = voc.starts[ids]
    size = voc.starts[ids + 1] - first
    got = voc.data[_spread(first, size)]
    want = [(" " + t).encode() if t else b"" for t in texts]
    upto = np.concatenate([[0], np.cumsum(size)])
    stops = np.cumsum(counts)
    lens = upto[stops] - upto[stops - counts]
    if lens.tolist() == list(map(len, want)) and got.tobytes() == b"".join(want):
        return [True] * len(texts)
    return [decode(x.tolist(), voc) == t for x, t in zip(np.split(ids, stops[:-1]), texts, strict=True)]


def _known(voc: Vocabulary) -> Known:
    kept = process_cache("pieces")
    if kept.get("for") != voc.tag:
        kept.update({"for": voc.tag, "units": Known()})
    return kept["units"]


def encoded(docs: DataFrame, model_path: str = MODEL, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """(doc_id, ids, lossless) of every row of ``docs(doc_id, text)``; lossless: decoding gave the text back."""
    def run(voc, batches):
        known = _known(voc)
        for b in thin(batches, ROWS):
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids, counts = encode_flat(texts, voc, dropout, seed, b.column(0).to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), lists(ids, counts, pa.int32()), pa.array(lossless(texts, ids, counts, voc), pa.bool_())],
                ["doc_id", "ids", "lossless"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(run, load(model_path)), "doc_id long, ids array<int>, lossless boolean")


def decoded(rows: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, text) from ``rows(doc_id, ids)``; null ids read as none."""
    def run(voc, batches):
        for b in thin(batches, ROWS):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([decode(x.as_py() or [], voc) for x in b.column(1)], pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(partial(run, load(model_path)), "doc_id long, text string")
