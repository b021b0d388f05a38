"""Quotient filters against counters, tokenising against regular expressions, mining against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from triage.llm import collocations, quotient
from triage.llm.common import text_bytes

SOURCES = ["big red dog ran home", "New York City! new york state, in New York.", "a\tb  c;d\x0be f\x0cg", "été à la mer. ÉTÉ",
           "x", "", None, " .,;", "one two three four five six", "日本 語 の 文"]


def lanes_of(rng, n, k):
    return [rng.integers(0, 5, n).astype(np.uint64) * np.uint64(1 << 61) + np.uint64(i) for i in range(k)]


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_permutation_is_inverted(k):
    rng = np.random.default_rng(k)
    raw = [rng.integers(0, 1 << 64, 3000, dtype=np.uint64) for _ in range(k)]
    assert all((a == b).all() for a, b in zip(raw, quotient.restore(quotient.permute(raw))))


@pytest.mark.parametrize("k", [1, 2, 4])
@pytest.mark.parametrize("top", [0, 3, 11])
def test_merged_filters_count_exactly(k, top):
    raw = lanes_of(np.random.default_rng(k + top), 4000, k)
    filters = {}
    for at in range(0, 4000, 600):
        keys = quotient.permute([x[at:at + 600] for x in raw])
        for block, f in quotient.shards(*quotient.tally(keys, np.ones(len(keys[0]), dtype=np.int64)), top):
            filters.setdefault(block, []).append(f)
    got = Counter()
    for block, fs in filters.items():
        keys, counts = quotient.merge(block, fs)
        assert (np.diff(keys[0].astype(object)) >= 0).all()
        for key, n in zip(zip(*(x.tolist() for x in quotient.restore(keys))), counts.tolist()):
            got[key] += n
    assert got == Counter(zip(*(x.tolist() for x in raw)))


def test_counters_of_any_width():
    keys, _ = quotient.tally(quotient.permute([np.arange(6, dtype=np.uint64)]), np.ones(6, dtype=np.int64))
    counts = np.array([1, 2, 254, 255, 256, 1 << 40])
    back, n = quotient.unpack(0, quotient.pack(keys, counts, 0, 3))
    assert (back[0] == keys[0]).all() and n.tolist() == counts.tolist()


def test_keys_alike_in_the_first_lane():
    lanes = [np.array([7, 7, 7, 7], dtype=np.uint64), np.array([2, 1, 2, 1], dtype=np.uint64)]
    keys, counts = quotient.tally(lanes, np.ones(4, dtype=np.int64))
    assert keys[1].tolist() == [1, 2] and counts.tolist() == [2, 2]


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


@pytest.mark.parametrize("size", [16, 64, 1 << 18])
def test_windows_lose_and_repeat_nothing(size, monkeypatch):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab  c.\t,é") for _ in range(rng.randint(0, 400))) for _ in range(40)] + ["w" * 300 + " x y z u v " + "q" * 90, " ".join("abcdefgh" * 9)]
    real = collocations.windows
    monkeypatch.setattr(collocations, "windows", lambda kind, offsets, longest: real(kind, offsets, longest, size))
    import pyarrow as pa
    data, offsets = text_bytes(pa.array(texts))
    hasher = collocations.Words(0)
    for k in (1, 2, 3, 4):
        got, want = Counter(), Counter()
        for ids, piece, lead in collocations.words_of(data, offsets, np.zeros(len(texts), dtype=np.uint64), hasher, 4):
            for i in range(len(ids) - k + 1):
                if piece[i] == piece[i + k - 1] and i + k > lead:
                    got[tuple(ids[i:i + k].tolist())] += 1
        for t in texts:
            for w in pieces(t):
                for i in range(len(w) - k + 1):
                    want[tuple(w[i:i + k])] += 1
        assert sorted(got.values()) == sorted(want.values())


def brute(rows, least, covered, best):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    out = []
    for (lang, g), a in cand.items():
        if any(l2 == lang and len(h) > len(g) and 100 * b >= covered * a and any(h[i:i + len(g)] == g for i in range(len(h)))
               for (l2, h), b in cand.items()):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, g[:c]] + f[lang, g[c:]]), c, f[lang, g[:c]], f[lang, g[c:]]) for c in range(1, len(g)))
        out.append((lang, " ".join(g), a, l, r, n[lang], score))
    rows = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:best]
        rows += [(lang, i, *x[1:]) for i, x in enumerate(mine, 1)]
    return sorted(rows)


@pytest.mark.parametrize(("seed", "least", "covered", "best"), [(1, 3, 80, 2000), (2, 5, 50, 4), (3, 2, 100, 7)])
def test_mining(spark, monkeypatch, seed, least, covered, best):
    rng = random.Random(seed)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 16)
    words = "the big Red dog ran. home, été".split()
    rows = [(rng.choice(SOURCES), rng.choice(["en", "fr", None, ""])) for _ in range(120)]
    rows += [(" ".join(rng.choice(words) for _ in range(30)), rng.choice(["en", None])) for _ in range(30)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit(1) for c in ("word", "f", "ids", "key", "n", "score", "block")})
    got = sorted(tuple(r) for r in collocations.mine(df.repartition(3), 4, least, covered, best).collect())
    assert got == brute(rows, least, covered, best) and got


def test_nothing_to_mine(spark):
    for rows in ([], [(None, None), ("", "en"), (" . ", "en"), ("a", "en")], [("a b", "en")] * 29):
        assert collocations.mine(spark.createDataFrame(rows, "text string, lang string")).collect() == []
    assert [(r.phrase, r.a, r.score) for r in collocations.mine(spark.createDataFrame([("a b", "en")] * 30, "text string, lang string")).collect()] == [("a b", 30, 1_000_000)]


def test_a_shared_id_takes_the_next_seed(spark, monkeypatch):
    real = collocations.Words.hashes
    def colliding(self, data, starts, ends, langs):
        out = real(self, data, starts, ends, langs)
        return out if self.seed else out & np.uint64(1)
    monkeypatch.setattr(collocations.Words, "hashes", colliding)
    monkeypatch.setattr(collocations, "_with_id", lambda words, seed: _ids_here(words, seed))
    rows = [("a b c d e", "en")] * 30
    got = collocations.mine(spark.createDataFrame(rows, "text string, lang string")).collect()
    assert {r.phrase for r in got} == {"a b c d", "b c d e"}


def _ids_here(words, seed):
    """The table's ids as a colliding first seed would give them; later seeds as they are."""
    if seed:
        return ORIGINAL(words, seed)
    return ORIGINAL(words, 0).withColumn("id", F.lit(1).cast("long"))


ORIGINAL = collocations._with_id


def test_long_words_and_texts(spark):
    long = "y" * 700_000
    rows = [(f"{long} z", "en")] * 3 + [("p q " * 100_000, "en")]
    got = {(r.phrase[:9], r.a) for r in collocations.mine(spark.createDataFrame(rows, "text string, lang string"), least=3).collect()}
    assert ("y" * 9, 3) in got and ("p q p q", 199_999 - 1) in got or ("q p q p", 99_998) in got
