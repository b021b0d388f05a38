"""Vectorised hashing of words, word shingles and byte strings inside Arrow tasks (numpy only)."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

from triage.llm.common import mix, process_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 18  # bytes hashed at a time: bounds memory whatever a text's length
BASE = 0x9E3779B97F4A7C15 | 1
ORDERS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
          0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2127599BF4325C37)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64."""
    kept = process_cache("hashing")
    if n in kept:
        return kept[n]
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    out = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    if n <= 2 * PIECE:
        kept[n] = out
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with the hash of data[i:j] = (S[j] - S[i]) * BASE**-i."""
    up, _ = powers(max(PIECE, 1 << max(1, int(len(data)).bit_length())))
    s = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=s[1:])
    return s


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text): A-Z lowered, split at space and 0x09-0x0D."""
    n = len(data)
    hashes, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    low = _lower_table()
    _, down = powers(PIECE)
    starts_of = offsets[:-1][np.diff(offsets) > 0]
    at = 0
    while at < n:
        to = min(n, at + PIECE - 1)
        if to < n:  # cut at a text's end or a space, so that no word is torn
            k = int(np.searchsorted(offsets, to, side="right")) - 1
            if offsets[k] > at:
                to = int(offsets[k])
            else:
                piece = data[at:to]
                gaps = np.flatnonzero((piece == 32) | ((piece >= 9) & (piece <= 13)))
                if len(gaps):
                    to = at + int(gaps[-1]) + 1
                else:  # a word longer than a piece
                    rest = data[to:int(offsets[k + 1])]
                    gap = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
                    to = to + int(gap[0]) if len(gap) else int(offsets[k + 1])
        piece = low[data[at:to]]
        word = ~((piece == 32) | ((piece >= 9) & (piece <= 13)))
        first = np.zeros(to - at, dtype=bool)  # first byte of a text
        first[starts_of[np.searchsorted(starts_of, at):np.searchsorted(starts_of, to)] - at] = True
        before = np.concatenate([[False], word[:-1]])
        starts = np.flatnonzero(word & (~before | first))
        after = np.concatenate([word[1:], [False]])
        last = np.concatenate([first[1:], [True]])
        ends = np.flatnonzero(word & (~after | last)) + 1
        s = prefix_sums(piece)
        if to - at > PIECE:
            _, down = powers(1 << int(to - at).bit_length())
        hashes.append(mix((s[ends] - s[starts]) * down[starts]))
        k = np.searchsorted(offsets, starts + at, side="right") - 1
        counts += np.bincount(k, minlength=len(counts))
        at = to
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int):
    """Yield per text its sorted distinct shingle hashes (uint64); fewer words: the whole text as one."""
    words, counts = word_hashes(data, offsets)
    at = 0
    for n in counts:
        w = words[at:at + n]
        at += n
        if n == 0:
            yield np.zeros(0, dtype=np.uint64)
            continue
        k = min(size, int(n))
        g = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            g += w[i:n - k + 1 + i] * np.uint64(ORDERS[i])
        yield np.unique(mix(g + np.uint64(k)))
