"""Counting quotient filters over packed word-id n-grams: lossless, sorted, mergeable.

A key is k lanes of 64 bits (k word ids). An invertible permutation (rounds that mix one lane into
the next and scramble it by a bijection) spreads keys evenly over the first lane. Its top bits
choose the filter's block, the next ones are the quotient, which is not stored but said by
run lengths (one bit a quotient, one an entry); the rest of the first lane and all other lanes are
the remainder, stored in full. So a filter tells any two keys apart, and counts are exact. Entries
lie in the order of the permuted key, so filters of the same block merge as sorted lists.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
from pyspark import cloudpickle

from triage.llm.common import mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # of the finaliser ``mix``
INVERSES = tuple(pow(m, -1, 1 << 64) for m in MULTIPLIERS)
ROUND = 0x9E3779B97F4A7C15


def _unshift(x: np.ndarray, by: int) -> np.ndarray:
    """Inverse of x ^ (x >> by)."""
    out, shift = x.copy(), by
    while shift < 64:
        out = x ^ (out >> np.uint64(by))
        shift += by
    return out


def unmix(x: np.ndarray) -> np.ndarray:
    """Inverse of ``mix``."""
    x = _unshift(x, 31) * np.uint64(INVERSES[1])
    x = _unshift(x, 27) * np.uint64(INVERSES[0])
    return _unshift(x, 30)


def permute(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """Invertible: each lane in turn takes up the one before it; the first does so again at the end."""
    out = [x.astype(np.uint64, copy=True) for x in lanes]
    k = len(out)
    for i in range(k + 1):
        here = i % k
        if k > 1:
            out[here] ^= mix(out[here - 1] + np.uint64((i + 1) * ROUND & (1 << 64) - 1))
        out[here] = mix(out[here])
    return out


def restore(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """Inverse of ``permute``."""
    out = [x.copy() for x in lanes]
    k = len(out)
    for i in reversed(range(k + 1)):
        here = i % k
        out[here] = unmix(out[here])
        if k > 1:
            out[here] ^= mix(out[here - 1] + np.uint64((i + 1) * ROUND & (1 << 64) - 1))
    return out


def tally(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct permuted keys in order, with their counts added up."""
    order = np.argsort(lanes[0], kind="stable")
    head = lanes[0][order]
    same = head[1:] == head[:-1]
    if same.any() and any((x[order][1:] != x[order][:-1])[same].any() for x in lanes[1:]):
        order = np.lexsort(lanes[::-1])  # keys that agree in the first lane only
    lanes = [x[order] for x in lanes]
    if not len(order):
        return lanes, counts
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in lanes], axis=0)
    at = np.flatnonzero(new)
    return [x[at] for x in lanes], np.add.reduceat(counts[order], at)


def pack(lanes: list[np.ndarray], counts: np.ndarray, top: int, quotient: int) -> bytes:
    """Filter of one block from distinct permuted keys in order; ``top`` bits of the key name the block.

    Layout: sizes, run-length bits, remainders of the first lane in whole bytes, other lanes, one
    bit an entry that counts more than one, then those counters: a byte each, 255 for a wide one.
    """
    n, rest = len(counts), 64 - top - quotient
    own = lanes[0] & np.uint64((1 << (64 - top)) - 1)
    q = (own >> np.uint64(rest)).astype(np.int64)
    runs = np.zeros((1 << quotient) + n, dtype=np.uint8)
    runs[q + np.arange(n)] = 1  # a quotient's entries are ones, a zero closes its run
    remainder = (own & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :(rest + 7) // 8]
    many = counts > 1
    small = np.minimum(counts[many], 255).astype(np.uint8)
    wide = counts[many][small == 255].astype("<i8")
    return b"".join([struct.pack("<BBBII", len(lanes), top, quotient, n, len(small)), np.packbits(runs).tobytes(), remainder.tobytes(),
                     *(x.astype("<u8").tobytes() for x in lanes[1:]), np.packbits(many).tobytes(), small.tobytes(), wide.tobytes()])


def unpack(block: int, filter_: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """(permuted keys in order, counts) of a block's filter."""
    k, top, quotient, n, n_small = struct.unpack_from("<BBBII", filter_)
    rest, at = 64 - top - quotient, struct.calcsize("<BBBII")

    def take(size, kind=np.uint8):
        nonlocal at
        out = np.frombuffer(filter_, dtype=kind, count=size, offset=at)
        at += out.nbytes
        return out

    bits = (1 << quotient) + n
    q = np.flatnonzero(np.unpackbits(take((bits + 7) // 8), count=bits)) - np.arange(n)
    width = (rest + 7) // 8
    low = np.zeros((n, 8), dtype=np.uint8)
    low[:, :width] = take(n * width).reshape(n, width)
    first = low.reshape(-1).view("<u8").astype(np.uint64) | (q.astype(np.uint64) << np.uint64(rest))
    if top:
        first |= np.uint64(block << (64 - top))
    lanes = [first, *(take(n, "<u8").astype(np.uint64) for _ in range(k - 1))]
    counts = np.ones(n, dtype=np.int64)
    many = np.flatnonzero(np.unpackbits(take((n + 7) // 8), count=n))
    counts[many] = take(n_small)
    wide = many[counts[many] == 255]
    counts[wide] = take(len(wide), "<i8")
    return lanes, counts


def shards(lanes: list[np.ndarray], counts: np.ndarray, top: int):
    """Yield (block, filter) of every block that distinct permuted keys in order fall into."""
    block = (lanes[0] >> np.uint64(64 - top)).astype(np.int64) if top else np.zeros(len(counts), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(block)]])):
        if b > a:
            # some two entries to a quotient; a filter's size follows what it holds
            quotient = min(max(int(b - a).bit_length() - 1, 1), 63 - top)
            yield int(block[a]), pack([x[a:b] for x in lanes], counts[a:b], top, quotient)


def merge(block: int, filters) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct permuted keys in order and summed counts of one block's filters, joined two by two."""
    parts = []
    for f in filters:
        parts.append((1, *unpack(block, f)))
        while len(parts) > 1 and parts[-1][0] == parts[-2][0]:
            (d, a, x), (_, b, y) = parts.pop(), parts.pop()
            parts.append((d + 1, *tally([np.concatenate(p) for p in zip(a, b)], np.concatenate([x, y]))))
    while len(parts) > 1:
        (_, a, x), (d, b, y) = parts.pop(), parts.pop()
        parts.append((d, *tally([np.concatenate(p) for p in zip(a, b)], np.concatenate([x, y]))))
    return parts[0][1], parts[0][2]
