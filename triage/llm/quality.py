"""Operator 3: quality classifier on supervised subword embeddings.

A word's vector is the mean of its learned hashed vectors: its own and those of its character
n-grams (bytes, the gaps beside the word included). A document's vector is the mean over its words (occurrences count), a linear layer with
softmax gives the class. Trained by stochastic gradient descent in numpy on the driver, on a
sample bounded by ``per_class`` rows a class. Word n-grams of two enter as one learned token for a
word that repeats the one before it, and a line that repeats an earlier line counts as such
tokens too: the identity of a repeated word says little, that it is repeated says much.

As the output is linear in the document's mean, scoring needs one trained number a bucket, read
for every n-gram by vectorised hashing. Whole texts are scored, in one pass without a shuffle.

Edge cases: a null or empty text, or one of white space, scores by the bias alone; a null label, a
label without document and a document without label are not learned from; repeated labels for one
document count as often as they stand there; no labelled rows at all, or one class only: every
score is the share of class 1 (0.5 without any); other columns are never read; an empty table
gives no rows; a null doc_id is scored and counts as held out of nothing (held_out false).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from triage.llm.common import mix, text_bytes, thin
from triage.llm.shingles import PIECE, powers, prefix_sums

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS, DIM, SIZES = 1 << 16, 12, (2, 3, 4)
AGAIN = 0  # bucket of the token for repetition


@dataclass
class Words:
    """Words of a slice of texts: text, [start, end) in the padded bytes, n-grams each has, AGAIN marks."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    grams: np.ndarray
    again: np.ndarray
    ids: list  # bucket of the n-gram at each byte, one array a size
    own: np.ndarray  # bucket of each word itself


def slices(data: np.ndarray, offsets: np.ndarray):
    """(bytes, a newline before each text; first byte of each; their numbers): about PIECE bytes a time."""
    k, n = 0, len(offsets) - 1
    while k < n:
        to = max(k + 1, int(np.searchsorted(offsets, offsets[k] + PIECE, side="right")) - 1)
        if to == k + 1 and offsets[to] - offsets[k] > PIECE:  # a long text, cut at white space
            at, end = int(offsets[k]), int(offsets[to])
            while at < end:
                stop = min(end, at + PIECE)
                gaps = np.flatnonzero(data[at:stop] <= 32) if stop < end else ()
                stop = at + int(gaps[-1]) + 1 if len(gaps) else stop
                yield np.concatenate([[10], data[at:stop], [10]]).astype(np.uint8), np.array([1]), np.array([k])
                at = stop
        else:
            lens = np.diff(offsets[k:to + 1])
            pad = np.full(int(lens.sum()) + len(lens) + 1, 10, dtype=np.uint8)
            part = np.repeat(np.arange(1, len(lens) + 1), lens)
            pad[np.arange(len(part)) + part] = data[offsets[k]:offsets[to]]
            yield pad, offsets[k:to] - offsets[k] + np.arange(1, to - k + 1), np.arange(k, to)
        k = to


def parse(pad: np.ndarray, first: np.ndarray, texts: np.ndarray, seen: dict | None = None) -> Words:
    space = (pad == 32) | ((pad >= 9) & (pad <= 13))
    start = np.flatnonzero(~space[1:] & space[:-1]) + 1
    end = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    flat = np.where(space, np.uint8(32), pad)
    s = prefix_sums(flat)
    _, down = powers(max(PIECE, 1 << len(pad).bit_length()))
    ids = [(mix((s[n:] - s[:-n]) * down[:max(0, len(pad) - n + 1)]) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1 for n in SIZES]
    word = mix((s[end] - s[start]) * down[start])
    own = (mix(word + np.uint64(7)) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    size = end - start
    grams = 1 + sum(np.maximum(0, size + 3 - n) for n in SIZES)
    of = np.searchsorted(first, start, side="right") - 1
    breaks = np.flatnonzero(pad == 10)
    line = np.searchsorted(breaks, start)
    again = np.zeros(len(start), dtype=bool)
    again[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    if len(start):  # lines with a word that repeat an earlier line of their text
        rows, at = np.unique(line, return_index=True)
        lo, hi = breaks[rows - 1] + 1, breaks[rows]
        key = mix(mix((s[hi] - s[lo]) * down[lo]) + texts[of[at]].astype(np.uint64))
        _, where = np.unique(key, return_index=True)
        repeat = np.ones(len(key), dtype=bool)
        repeat[where] = False
        if seen is not None:  # later slices of a long text
            repeat |= np.fromiter((k in seen for k in key.tolist()), dtype=bool, count=len(key))
            seen.update(dict.fromkeys(key.tolist()))
        again |= np.repeat(repeat, np.diff(np.append(at, len(start))))
    return Words(texts[of] if len(start) else of, start, end, grams, again, ids, own)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids, weights) of a document: the mean over words of the mean over each word's n-grams."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    ids, weights, total, seen = [], [], 0, {}
    for pad, first, texts in slices(data, np.array([0, len(data)])):
        w = parse(pad, first, texts, seen)
        each = 1 / w.grams
        total += len(w.start) + int(w.again.sum())
        ids += [w.own, np.full(int(w.again.sum()), AGAIN)]
        weights += [each, np.ones(int(w.again.sum()))]
        for n, at in zip(SIZES, w.ids, strict=True):
            count = np.maximum(0, w.end - w.start + 3 - n)
            place = np.repeat(w.start - 1 - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            ids.append(at[place])
            weights.append(np.repeat(each, count))
    if not total:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)
    ids, back = np.unique(np.concatenate(ids), return_inverse=True)
    return ids.astype(np.int32), (np.bincount(back, np.concatenate(weights)) / total).astype(np.float32)


def logits(data: np.ndarray, offsets: np.ndarray, scalars: np.ndarray, bias: float) -> np.ndarray:
    """Of each text: the trained scalar averaged over its words, plus the bias."""
    sums, total = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    seen: dict = {}
    last = -1
    for pad, first, texts in slices(data, offsets):
        if texts[0] != last:
            seen = {}
        last = texts[-1]
        w = parse(pad, first, texts, seen if len(texts) == 1 else None)
        value = scalars[w.own].astype(np.float64)
        for n, ids in zip(SIZES, w.ids, strict=True):
            p = np.concatenate([[0], np.cumsum(scalars[ids], dtype=np.float64)])
            lo = w.start - 1
            value += p[np.maximum(lo, w.end + 2 - n)] - p[lo]
        value = value / w.grams + w.again * float(scalars[AGAIN])
        sums += np.bincount(w.text, value, minlength=len(sums))
        total += np.bincount(w.text, 1 + w.again, minlength=len(sums))
    return sums / np.maximum(total, 1) + bias


def train(texts: list[str], labels: list[int], epochs: int = 3, rate: float = 0.6, seed: int = 7):
    """(scalar of each bucket, bias): the trained embeddings times the output layer's difference."""
    y = np.array(labels)
    if len(set(labels)) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        return np.zeros(BUCKETS, dtype=np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    rows = [features(t) for t in texts]
    table = ((rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM).astype(np.float32)
    out, bias = np.zeros((2, DIM), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, w = rows[i]
            lr = rate * (1 - done / steps)
            done += 1
            v = w @ table[ids] if len(ids) else np.zeros(DIM, dtype=np.float32)
            z = out @ v + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1  # gradient of the softmax loss
            if len(ids):
                table[ids] -= lr * 30 * np.outer(w, p @ out)  # a bucket's weight is small: larger steps
            out -= lr * np.outer(p, v)
            bias -= lr * 0.05 * p
    return table @ (out[1] - out[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str, where=None, per_class: int = 1200, **how):
    """Train on at most ``per_class`` labelled documents of each class, picked by a hash of the id."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    if where is not None:
        known = known.filter(where)
    pick = None
    for c in (0, 1):
        part = known.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        pick = part if pick is None else pick.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    rows = texts.join(F.broadcast(pick), "doc_id").select("doc_id", "text", "y").collect()  # both bounded by per_class
    rows.sort(key=lambda r: (r.doc_id, r.y, r.text or ""))
    return train([r.text for r in rows], [r.y for r in rows], **how)


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, text columns untouched) -> (doc_id, score) of every row."""
    return with_score(docs.select(F.col("doc_id").cast("long"), "text"), model).select("doc_id", "score")


def with_score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with a ``score`` column from its ``text``; all other columns pass through."""
    scalars, bias = model
    at = docs.columns.index("text")
    name = [*docs.columns, "score"]

    def run(batches):
        for b in thin(batches):
            z = logits(*text_bytes(b.column(at)), scalars, bias)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], name)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
