"""Operator 6: removal of repeated strings by longest-previous-factor arrays.

A string of ``min_len`` bytes that also starts elsewhere (in any text, its own included) is
repeated. ``keep="none"`` removes every byte of every such string; ``keep="first"`` leaves the
first copy in (doc_id, position) order and removes the later ones, where they overlap it too.

A suffix array of a whole corpus fits no machine, so the suffixes are dealt out first. Every
window of ``min_len`` bytes belongs to the smallest hash among the ``gram``-byte strings in it:
equal windows have equal smallest hashes, wherever they stand. Neighbouring windows with the same
smallest string form a run of different windows, some ``min_len/4`` long, and a run is what Spark
shuffles:

1. Smallest hashes are counted over all texts (partial counts before the shuffle); a run whose
   hash occurs once is finished. A fixed-size Bloom filter keeps those rows out of the next shuffle.
2. Runs of equal content are a class: all its windows are repeated, whatever the size of the class.
3. Classes that share a smallest hash but not their content repeat in part. One representative
   of each goes, with its bytes, to the hash's bucket. There its windows are sorted into suffix
   order, neighbouring longest common prefixes (up to ``min_len``) are taken, and previous and next
   smaller text positions in that order give the longest previous factor of each suffix (with
   the order turned round: the longest next factor). A factor of ``min_len`` marks the window.
   Hashes with more than ``GROUP`` classes are dealt out again by whole windows, with partial counts.
4. Marks return to their texts; texts without marks never move.

Edge cases: a null text is empty; texts shorter than ``min_len`` stay whole; repeated rows are
copies of each other under ``keep="none"`` and one text under ``keep="first"``; a null doc_id is
ordinary; other columns are not read; an empty table gives no rows. Very long texts are hashed in
pieces. Contents are compared by 128 bits of hashes, in buckets
byte by byte.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import bloom_fit, bloom_has, cut, mix, text_bytes, thin
from triage.llm.shingles import PIECE, powers, prefix_sums

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP = 1024        # classes of one smallest hash that are sorted in one bucket
CHUNK = 100_000     # windows that one suffix sort takes, a little more at most


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (w - have)], x[w - have:]) if w > have else x


def runs(data: np.ndarray, offsets: np.ndarray, min_len: int, gram: int):
    """(text, first window, windows, smallest hash, content hash) arrays of the runs of all texts."""
    out = []
    step = PIECE - min_len
    for at in range(0, len(data), step):
        to = min(len(data), at + step)
        seg = data[at:min(len(data), to + min_len - 1)]
        if len(seg) < min_len:
            continue
        s = prefix_sums(seg)
        _, down = powers(PIECE)
        grams = mix((s[gram:] - s[:-gram]) * down[:len(seg) - gram + 1])
        small = sliding_min(grams, min_len - gram + 1)
        here = np.arange(len(small), dtype=np.int64) + at
        text = np.searchsorted(offsets, here, side="right") - 1
        ok = here + min_len <= offsets[text + 1]
        change = np.ones(len(small), dtype=bool)
        # a window that starts with its smallest string ends the run: the next one has it elsewhere
        change[1:] = (small[1:] != small[:-1]) | (grams[:len(small) - 1] == small[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
        first = np.flatnonzero(ok & change)
        last = np.flatnonzero(ok & np.concatenate([change[1:] | ~ok[1:], [True]]))
        if not len(first):
            continue
        length = last - first + 1
        content = mix((s[last + min_len] - s[first]) * down[first] + length.astype(np.uint64))
        out.append((text[first], here[first] - offsets[text[first]], length, small[first], content))
    if not out:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def smallest_hashes(docs: DataFrame, min_len: int, gram: int) -> DataFrame:
    def run(batches):
        for b in thin(batches):
            yield pa.RecordBatch.from_arrays([pa.array(runs(*text_bytes(b.column(0)), min_len, gram)[3].view(np.int64))], ["m"])

    return docs.select("text").mapInArrow(run, "m long")


def shared_runs(docs: DataFrame, bloom, min_len: int, gram: int) -> DataFrame:
    def run(batches):
        for b in thin(batches):
            text, at, n, m, h = runs(*text_bytes(b.column(2)), min_len, gram)
            k = bloom_has(bloom, m.view(np.int64))
            text = pa.array(text[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(m[k].view(np.int64)), pa.array(h[k].view(np.int64)), b.column(0).take(text),
                 b.column(1).take(text), pa.array(at[k]), pa.array(n[k])], ["m", "h", "doc_id", "rid", "at", "n"])

    return docs.select("doc_id", "rid", "text").mapInArrow(run, "m long, h long, doc_id long, rid long, at long, n long")


# ---------------------------------------------------------------- suffix order and factors

def previous_smaller(pos: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in suffix order, the nearest earlier place with a smaller text position, and
    the longest common prefix with it (-1 and 0: none). lcp[i]: of places i-1 and i.

    All places jump at once along the pointers of those they pass until no jump is left.
    """
    psv = np.arange(len(pos)) - 1
    common = lcp.copy()
    while True:
        go = np.flatnonzero((psv >= 0) & (pos[psv] > pos))
        if not len(go):
            break
        over = psv[go]
        common[go] = np.minimum(common[go], common[over])
        psv[go] = psv[over]
    common[psv < 0] = 0
    return psv, common


def longest_previous_factor(pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """By place in suffix order: length of the longest earlier match, from the previous and the
    next smaller text position."""
    _, left = previous_smaller(pos, lcp)
    turned = np.concatenate([[0], lcp[1:][::-1]]) if len(lcp) else lcp
    _, right = previous_smaller(pos[::-1], turned)
    return np.maximum(left, right[::-1])


def repeated_windows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an earlier copy, has a later copy) of each row; rows stand in text order."""
    n, size = windows.shape
    order = np.argsort(np.ascontiguousarray(windows).view(f"S{size}")[:, 0], kind="stable")
    lcp = np.zeros(n, dtype=np.int64)
    for lo in range(1, n, 1 << 14):
        hi = min(n, lo + (1 << 14))
        differ = windows[order[lo:hi]] != windows[order[lo - 1:hi - 1]]
        lcp[lo:hi] = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    earlier, later = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    earlier[order] = longest_previous_factor(order, lcp) >= size
    later[order] = longest_previous_factor(-order, lcp) >= size
    return earlier, later


def _mark(rows: list[tuple], min_len: int, keep: str):
    """Marked windows (doc_id, rid, at, n) of representatives (m, doc_id, rid, at, bytes)."""
    rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    views = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(r[4], dtype=np.uint8), min_len) for r in rows]
    earlier, later = repeated_windows(np.concatenate(views))
    hit = earlier if keep == "first" else earlier | later
    at, out = 0, []
    for r, v in zip(rows, views, strict=True):
        h = np.concatenate([[False], hit[at:at + len(v)], [False]])
        edge = np.flatnonzero(h[1:] != h[:-1])
        out += [(r[1], r[2], r[3] + int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        at += len(v)
    return out


def _batch(marks: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*marks, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], ["doc_id", "rid", "at", "n"])


MARK = "doc_id long, rid long, at long, n long"


def factor_marks(reps: DataFrame, min_len: int, keep: str) -> DataFrame:
    """Marks from suffix sorts, bucket by bucket; rows of one hash follow each other."""
    def run(batches):
        rows, size, last = [], 0, None
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if size >= CHUNK and r[0] != last:
                    yield _batch(_mark(rows, min_len, keep))
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4]) - min_len + 1
                last = r[0]
        if rows:
            yield _batch(_mark(rows, min_len, keep))

    return reps.select("m", "doc_id", "rid", "at", "bytes").repartition("m").sortWithinPartitions("m").mapInArrow(run, MARK)


def window_marks(reps: DataFrame, min_len: int, keep: str) -> DataFrame:
    """The same for hashes with very many classes: equal windows are counted instead."""
    def run(batches):
        for b in batches:
            for m, d, r, at, x in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                x = np.frombuffer(x, dtype=np.uint8)
                s, n = prefix_sums(x), len(x) - min_len + 1
                h = mix((s[min_len:] - s[:-min_len]) * powers(PIECE)[1][:n])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m] * n, pa.int64()), pa.array(h.view(np.int64)), pa.array([d] * n, pa.int64()),
                     pa.array([r] * n, pa.int64()), pa.array(np.arange(n) + at)], ["m", "w", "doc_id", "rid", "at"])

    all_of = cut(reps.select("m", "doc_id", "rid", "at", "bytes").mapInArrow(
        run, "m long, w long, doc_id long, rid long, at long"))
    me = F.struct("doc_id", "rid", "at")
    seen = all_of.groupBy("m", "w").agg(F.count("*").alias("c"), F.min(me).alias("one")).filter("c > 1")
    hit = all_of.join(seen, ["m", "w"])
    return (hit.filter(me != F.col("one")) if keep == "first" else hit).select("doc_id", "rid", "at", F.lit(1).cast("long").alias("n"))


def _cut_out(text: bytes, marks, min_len: int):
    """(kept bytes, maximal removed spans) of one text; marks: (first window, windows)."""
    spans: list[list[int]] = []
    for at, n in sorted(marks):
        end = at + n - 1 + min_len
        if spans and at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([at, end])
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), spans


RESULT = "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"


def _results(doc_ids, texts, marks, min_len: int) -> pa.RecordBatch:
    n, kept, spans = [], [], []
    for t, m in zip(texts, marks, strict=True):
        t = t or b""
        k, s = _cut_out(t, m, min_len) if m else (t, [])
        n.append(len(t))
        kept.append(k)
        spans.append([{"start": a, "end": b} for a, b in s])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
                                      ["doc_id", "n_bytes", "kept", "spans"])


def remove_repeats(docs: DataFrame, min_len: int = 200, keep: str = "first", group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, kept, spans) of every row of ``docs(doc_id, text)``; spans in bytes."""
    gram = max(1, min_len // 2)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    docs = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    often = cut(smallest_hashes(docs, min_len, gram).groupBy("m").count().filter("count > 1").select("m"))
    found = cut(shared_runs(docs, bloom_fit(often, "m"), min_len, gram).join(often, "m"))
    me = F.struct("doc_id", "rid", "at")
    classes = found.groupBy("m", "h", "n").agg(F.count("*").alias("c"), F.min(me).alias("one"))
    classes = cut(classes.withColumnRenamed("n", "len"))
    whole = found.join(classes.filter("c > 1").select("m", "h", F.col("len").alias("n"), "one"), ["m", "h", "n"])
    whole = (whole.filter(me != F.col("one")) if keep == "first" else whole).select("doc_id", "rid", "at", "n")
    mixed = classes.groupBy("m").agg(F.count("*").alias("nc")).filter("nc > 1")
    reps = classes.join(mixed, "m").select("m", "nc", "one.*", F.col("len").alias("n"), "c")
    # only part-repeated classes need their bytes; one that repeats as a whole is there as a partner
    per_text = cut(reps.groupBy("rid").agg(F.collect_list(F.struct("at", "n", "m", "nc")).alias("runs")))
    reps = cut(_with_bytes(docs, per_text, bloom_fit(per_text, "rid"), min_len))
    marks = whole.unionByName(factor_marks(reps.filter(F.col("nc") <= group), min_len, keep)) \
        .unionByName(window_marks(reps.filter(F.col("nc") > group), min_len, keep))
    marks = cut(marks.groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("marks")))
    bloom = bloom_fit(marks, "rid")

    def plain(batches):
        for b in thin(batches):
            b = b.filter(pa.array(~bloom_has(bloom, b.column(1).to_numpy())))
            if b.num_rows:
                yield _results(b.column(0), b.column(2).to_pylist(), [()] * b.num_rows, min_len)

    def marked(batches):
        for b in thin(batches):
            m = [[(x["at"], x["n"]) for x in row or ()] for row in b.column(2).to_pylist()]
            yield _results(b.column(0), b.column(1).to_pylist(), m, min_len)

    cols = docs.select("doc_id", "rid", "text")
    rest = _only(cols, bloom).join(marks.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "marks")
    return cols.mapInArrow(plain, RESULT).unionByName(rest.mapInArrow(marked, RESULT))


def _only(docs: DataFrame, bloom) -> DataFrame:
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(bloom_has(bloom, b.column(1).to_numpy())))

    return docs.mapInArrow(run, "doc_id long, rid long, text binary")


def _with_bytes(docs: DataFrame, per_text: DataFrame, bloom, min_len: int) -> DataFrame:
    """(m, nc, doc_id, rid, at, bytes) of each representative run."""
    def run(batches):
        for b in thin(batches):
            out = []
            for d, r, t, rs in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                out += [(x["m"], x["nc"], d, r, x["at"], t[x["at"]:x["at"] + x["n"] - 1 + min_len]) for x in rs]
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols[:5]] + [pa.array(list(cols[5]), pa.binary())],
                                             ["m", "nc", "doc_id", "rid", "at", "bytes"])

    near = _only(docs.select("doc_id", "rid", "text"), bloom).join(per_text.hint("shuffle_hash"), "rid")
    return near.select("doc_id", "rid", "text", "runs").mapInArrow(
        run, "m long, nc long, doc_id long, rid long, at long, bytes binary")
