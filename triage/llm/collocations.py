"""Phrase collocations of each language, counted in quotient filters.

Words are counted by Spark. A word's id is a seeded 64-bit hash of (language, word); the words
table itself proves that no frequent word shares its id with any other word (else the next seed is
taken), so packed ids stand for words without a dictionary in the tasks. Then n-grams level by
level: a task packs the n-grams whose two shorter n-grams may be frequent (a fixed-size Bloom
filter, which lets more through as it fills and never loses one) and counts them in counting
quotient filters (``quotient``), cut into blocks of the permuted key. Blocks are shuffled and their
sorted filters merged. The permutation deals keys evenly, so a hot phrase is one entry a filter;
the number of blocks follows the number of words, so a block stays small at any size.
Scores, cuts and covered phrases are joins on arrays of ids; arithmetic is decimal.

Long texts are read in windows that end between pieces (or overlap by some words), so memory
doesn't follow a text's length.

Edge cases: a null text is empty, a null language ``und``; an empty text or one of separators has
no words. Repeated rows count as often as they stand. Without a frequent phrase, or from an empty
table, the result is empty. Columns other than ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triage.llm import quotient
from triage.llm.common import bloom_fit, bloom_has, cut, mix, text_bytes, thin
from triage.llm.shingles import PIECE, powers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values of the task: piece separators, word separators, letters that are lowered
PIECE_ENDS, GAPS = ".,;:!?\n\x0b\x0c\r", " \t"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 2_000_000

LONG_WORD = 512      # bytes from which on a word is hashed as a whole
HELD = 1 << 18       # n-grams that a task holds before it counts them
BLOCK_WORDS = 1 << 19  # words of the corpus to a block of the merged filters


class Words:
    """Hashes the words of byte texts; one object a seed."""

    def __init__(self, seed: int):
        self.seed = seed
        self.byte = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        low = np.arange(256)
        low[65:91] += 32
        self.byte = self.byte[low]  # A-Z lowered

    def lang(self, name: str | None) -> int:
        return int.from_bytes(hashlib.blake2b(f"{self.seed} {name}".encode(), digest_size=8).digest(), "little")

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, langs: np.ndarray) -> np.ndarray:
        """Ids of the words data[starts:ends], each in its language."""
        up, down = powers(max(PIECE, 1 << int(len(data)).bit_length()))
        s = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.byte[data] * up[:len(data)], out=s[1:])
        h = (s[ends] - s[starts]) * down[starts]
        for i in np.flatnonzero(ends - starts >= LONG_WORD):
            word = data[starts[i]:ends[i]].tobytes().lower()  # bytes: A-Z only
            h[i] = int.from_bytes(hashlib.blake2b(f"{self.seed}".encode() + word, digest_size=8).digest(), "little")
        return mix(h ^ langs)


def _classes() -> np.ndarray:
    """0: part of a word, 1: gap between words, 2: end of a piece."""
    t = np.zeros(256, dtype=np.uint8)
    t[[ord(x) for x in GAPS]] = 1
    t[[ord(x) for x in PIECE_ENDS]] = 2
    return t


def windows(kind: np.ndarray, offsets: np.ndarray, longest: int, size: int = PIECE - 1):
    """Yield (from, to, lead): stretches that tear no word.

    n-grams of up to ``longest`` words are whole in some window; those that lie within the first
    ``lead`` words of a window were in the one before.
    """
    at, n, lead, room = 0, len(kind), 0, size
    while at < n:
        to = min(n, at + room)
        if to == n:
            yield at, to, lead
            return
        k = int(np.searchsorted(offsets, to, side="right")) - 1
        if offsets[k] > at:  # between two texts
            to, back, shared = int(offsets[k]), None, 0
        else:
            ends = np.flatnonzero(kind[at:to] == 2)
            back, shared = None, 0
            if len(ends):
                to = at + int(ends[-1]) + 1
            else:
                stretch = kind[at:to] == 0
                starts = np.flatnonzero(stretch & ~np.concatenate([[False], stretch[:-1]]))
                if len(starts) <= longest + 1:  # words longer than the window
                    room *= 2
                    continue
                to, shared = at + int(starts[-1]), longest - 1
                back = at + int(starts[-longest])
        yield at, to, lead
        at, lead, room = (to if back is None else back), shared, size


def words_of(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, hasher: Words, longest: int):
    """Yield (ids of the words, their pieces, lead) of each window; ``langs`` is a hash a text."""
    kind = _classes()[data]
    begins = offsets[:-1][np.diff(offsets) > 0]
    for at, to, lead in windows(kind, offsets, longest):
        here = kind[at:to]
        word = here == 0
        first = np.zeros(to - at, dtype=bool)
        first[begins[np.searchsorted(begins, at):np.searchsorted(begins, to)] - at] = True
        starts = np.flatnonzero(word & (first | ~np.concatenate([[False], word[:-1]])))
        if not len(starts):
            continue
        ends = np.flatnonzero(word & (np.concatenate([first[1:], [True]]) | ~np.concatenate([word[1:], [False]]))) + 1
        text = np.searchsorted(offsets, starts + at, side="right") - 1
        yield hasher.hashes(data[at:to], starts, ends, langs[text]), np.cumsum((here == 2) | first)[starts], lead


def _grams(ids: np.ndarray, k: int, at: np.ndarray) -> list[np.ndarray]:
    return [ids[at + i] for i in range(k)]


def _level(docs: DataFrame, k: int, seed: int, words_in, shorter_in, top: int) -> DataFrame:
    """(block, filter): counted k-grams whose words and (k-1)-grams pass the Bloom filters."""
    def run(batches):
        hasher, known = Words(seed), {}
        waiting, n_waiting, held = [], 0, None

        def count():
            nonlocal waiting, n_waiting, held
            lanes = quotient.permute([np.concatenate(x) for x in zip(*waiting)])
            counts = np.ones(len(lanes[0]), dtype=np.int64)
            if held is not None:
                lanes, counts = [np.concatenate(x) for x in zip(held[0], lanes)], np.concatenate([held[1], counts])
            held, waiting, n_waiting = quotient.tally(lanes, counts), [], 0

        def flush():
            out = list(quotient.shards(*held, top))
            for i in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out[i:i + 4096]], pa.int64()),
                                                  pa.array([f for _, f in out[i:i + 4096]], pa.binary())], ["block", "filter"])

        for b in thin(batches, 256):
            names = ["und" if x is None else x for x in b.column(1).to_pylist()]
            for x in set(names) - known.keys():
                known[x] = hasher.lang(x)
            langs = np.array([known[x] for x in names], dtype=np.uint64)
            for ids, piece, lead in words_of(*text_bytes(b.column(0)), langs, hasher, k):
                n = len(ids) - k + 1
                if n <= 0:
                    continue
                often = bloom_has(words_in, quotient.permute([ids])[0])
                run_length = np.convolve(often, np.ones(k, dtype=np.int64), "valid")
                at = np.flatnonzero((run_length == k) & (piece[:n] == piece[k - 1:]) & (np.arange(k, len(ids) + 1) > lead))
                for i in (0, 1) if k > 2 else ():
                    at = at[bloom_has(shorter_in, quotient.permute(_grams(ids, k - 1, at + i))[0])]
                if len(at):
                    waiting.append(_grams(ids, k, at))
                    n_waiting += len(at)
                if n_waiting >= HELD:
                    count()
                    if len(held[1]) >= HELD:
                        yield from flush()
                        held = None
        if n_waiting:
            count()
        if held is not None:
            yield from flush()

    return docs.mapInArrow(run, "block long, filter binary")


def _merged(blocks: DataFrame, least: int) -> DataFrame:
    """(ids, f) of n-grams counted at least so often: the sorted filters of each block merged."""
    def run(key, t):
        lanes, counts = quotient.merge(key[0].as_py(), [x.as_buffer() for x in t.column("filter")])
        keep = counts >= least
        raw = quotient.restore([x[keep] for x in lanes])
        ids = np.stack(raw, axis=1).view(np.int64)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, ids.size + 1, ids.shape[1]), pa.int32()), pa.array(ids.reshape(-1)))
        return pa.table({"key": pa.array(lanes[0][keep].view(np.int64)), "ids": flat, "f": pa.array(counts[keep])})

    return blocks.groupBy("block").applyInArrow(run, "key long, ids array<long>, f long")


def _with_id(words: DataFrame, seed: int) -> DataFrame:
    """Words with their ids."""
    schema = "lang string, word string, f long, id long, key long"

    def run(batches):
        hasher = Words(seed)
        for b in thin(batches, 1 << 14):
            data, offsets = text_bytes(b.column(1))
            langs = np.array([hasher.lang(x) for x in b.column(0).to_pylist()], dtype=np.uint64)
            ids = hasher.hashes(data, offsets[:-1], offsets[1:], langs)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids.view(np.int64)), pa.array(quotient.permute([ids])[0].view(np.int64))],
                ["lang", "word", "f", "id", "key"])

    return words.select("lang", "word", "f").mapInArrow(run, schema)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of every word; counted as written, then once more with A-Z lowered."""
    split = F.split("text", f"[{GAPS}{PIECE_ENDS}]+")
    raw = (docs.select("lang", F.explode(split).alias("w")).filter("w <> ''").groupBy("lang", "w").agg(F.count("*").alias("f")))
    return raw.groupBy("lang", F.translate("w", UPPER, LOWER).alias("word")).agg(F.sum("f").alias("f"))


def _wide(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def mine(docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases of two to ``longest`` words.

    a, l, r: occurrences of the phrase and of the two parts of its lowest-scoring cut, n: words of
    the language, score: floor(SCALE * a / (l + r)). A phrase counts at least ``least`` times; one
    that lies in a longer candidate which holds ``covered`` percent of its occurrences is left out.
    """
    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    words = cut(word_counts(docs))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    seed = 0
    while True:
        known = cut(_with_id(words, seed))
        shared = known.groupBy("id").agg(F.count("*").alias("c"), F.max("f").alias("f"))
        if shared.filter((F.col("c") > 1) & (F.col("f") >= least)).isEmpty():
            break
        seed += 1
    often = known.filter(F.col("f") >= least)
    n = totals.agg(F.sum("n")).first()[0] or 0
    top = max(0, (n // BLOCK_WORDS).bit_length())
    counted = [often.select(F.array("id").alias("ids"), "f")]
    words_in = shorter_in = bloom_fit(often, "key")
    for k in range(2, longest + 1):
        level = cut(_merged(_level(docs, k, seed, words_in, shorter_in, top), least))
        counted.append(level.select("ids", "f"))
        if level.isEmpty():
            break
        if k < longest:
            shorter_in = bloom_fit(level, "key")
    return _chosen(counted, often, totals, covered, best)


def _chosen(counted: list[DataFrame], often: DataFrame, totals: DataFrame, covered: int, best: int) -> DataFrame:
    f = counted[0]
    for x in counted[1:]:
        f = f.unionByName(x)
    cand = f.filter("size(ids) > 1").withColumnRenamed("f", "a")
    cuts = cand.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut")).select(
        "ids", "a", "cut", F.expr("slice(ids, 1, cut)").alias("left"), F.expr("slice(ids, cut + 1, size(ids) - cut)").alias("right"))
    scored = (cuts.join(f.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
              .join(f.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
              .withColumn("ratio", _wide(F.lit(SCALE)) * _wide(F.col("a")))
              .withColumn("score", F.expr("cast(ratio div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as long)"))
              .groupBy("ids").agg(F.min("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("at")))
    longer = (cand.filter("size(ids) > 2")
              .select("a", F.expr("explode(flatten(transform(sequence(2, size(ids) - 1), "
                                  "w -> transform(sequence(1, size(ids) - w + 1), i -> slice(ids, i, w)))))").alias("ids"))
              .groupBy("ids").agg(F.max("a").alias("longer")))
    kept = scored.join(longer, "ids", "left").filter(
        F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * covered))
    spelled = (kept.select("ids", "a", "at", F.posexplode("ids").alias("pos", "id"))
               .join(often.select("id", "lang", "word"), "id")
               .groupBy("ids").agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("at").alias("at"),
                                   F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))
               .filter("size(w) = size(ids)")
               .select("lang", "a", "at.l", "at.r", "at.score", F.array_join("w.word", " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
