"""Operator 9: n-gram Jaccard join with adaptive multi-match prefixes.

Texts whose sets of distinct word shingles have a Jaccard similarity of at least ``num/den`` link;
the result is one row per document with its connected component.

Multi-match prefix rule: with a = ceil(num/den * n), a text of n shingles and any partner share
at least a of them; under any global order of shingles they then share at least l of the first
n - a + l shingles of each. The prefix is lengthened where that saves candidates, and more shared
prefix shingles are asked for:

1. Every text is reduced to its lengthened prefix in hash order (``stretch`` * n beyond the
   shortest). A text whose prefix holds fewer shared shingles than the rule asks for links with
   nothing. That ends most texts, also those that only share passages or lines with others.
2. The rest get whole sets. Shingles found in one set only can't be shared, so a text needs at
   least a others.
3. What is left is ordered by document frequency, rarest first, and each text picks the prefix
   length l of least cost from the frequencies in its prefix: lists to read plus candidates to
   verify, of which about 1/l stay.
4. Texts chained by shared prefix shingles are compared in blocks of bounded size: pairs with
   enough shared prefix shingles are verified by exact set intersection, and each block emits a
   spanning forest of its links, never all pairs. Large chains are first tied to a few pivots;
   pairs of blocks that are already one component are skipped.

Equal sets are one node, so exact copies cost nothing. Edge cases: a null or empty text, or one of
white space, has no shingles and is its own component; a text of fewer words than the shingle is
one shingle; repeated rows get one result row each; a null doc_id is kept and never names a
component while another id is there; other columns are not read; an empty table gives no rows.
Sets are compared by 64-bit shingle hashes, equal sets by 128 bits.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import bloom_fit, bloom_has, components, cut, lists, mix, text_bytes, thin
from triage.llm.shingles import shingle_sets

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 512      # documents compared at a time in one task
PIVOTS = 4       # documents that every member of a large chain is compared with first
ELLS = (1, 2, 4, 8)


def need(n, num, den):
    """Shingles that a text of n shares with any partner, at least."""
    return -(-num * n // den)


def class_key(s: np.ndarray) -> bytes:
    """128 bits of a sorted set."""
    m = mix(s * np.uint64(0x9E3779B97F4A7C15))
    with np.errstate(over="ignore"):
        return np.array([m.sum(dtype=np.uint64), mix(m + np.uint64(len(s))).sum(dtype=np.uint64)], dtype=np.uint64).tobytes()


def bases(docs: DataFrame, size: int, num: int, den: int, stretch: float) -> DataFrame:
    """(doc_id, n, cls, pool): set size, set key and lengthened hash-order prefix of each text."""
    def run(batches):
        for b in thin(batches):
            n, keys, pools = [], [], []
            for s in shingle_sets(*text_bytes(b.column(1)), size):
                n.append(len(s))
                keys.append(class_key(s) if len(s) else None)
                pools.append(s[:len(s) - need(len(s), num, den) + 1 + int(stretch * len(s))])
            flat = np.concatenate(pools) if pools else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 lists(flat.view(np.int64), [len(p) for p in pools])], ["doc_id", "n", "cls", "pool"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, cls binary, pool array<long>")


def survivors(base: DataFrame, bloom, num: int, den: int, stretch: float) -> DataFrame:
    """Texts with enough shared shingles in their lengthened prefix."""
    def run(batches):
        for b in thin(batches):
            n = b.column(1).to_numpy()
            pool = b.column(3)
            flat = pool.flatten().to_numpy()
            ends = np.cumsum(pool.value_lengths().to_numpy(zero_copy_only=False))
            hit = np.concatenate([[0], np.cumsum(bloom_has(bloom, flat))])
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
            shared = hit[ends] - hit[starts]
            least = 1 + np.floor(stretch * need(n, num, den)).astype(np.int64)
            yield b.select(["doc_id", "n", "cls"]).filter(pa.array((n > 0) & (shared >= least)))

    return base.select("doc_id", "n", "cls", "pool").mapInArrow(run, "doc_id long, n long, cls binary")


def whole_sets(docs: DataFrame, wanted, size: int) -> DataFrame:
    """(doc_id, cls, n, toks) of the documents that the Bloom filter ``wanted`` lets through."""
    def run(batches):
        for b in thin(batches):
            keep = bloom_has(wanted, b.column(0).fill_null(-1).to_numpy())
            b = b.filter(pa.array(keep))
            if not b.num_rows:
                continue
            sets = list(shingle_sets(*text_bytes(b.column(1)), size))
            keys = [class_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 lists(np.concatenate(sets).view(np.int64), [len(s) for s in sets])], ["doc_id", "cls", "n", "toks"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, cls binary, n long, toks array<long>")


def slim_sets(sets: DataFrame, bloom, num: int, den: int) -> DataFrame:
    """Sets without the shingles that no other set has; texts with too few shared ones go."""
    def run(batches):
        for b in thin(batches):
            n = b.column(1).to_numpy()
            flat = b.column(2).flatten().to_numpy()
            lens = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), lens)
            hit = bloom_has(bloom, flat)
            shared = np.bincount(row[hit], minlength=len(n))
            ok = shared >= need(n, num, den)
            take = hit & ok[row]
            b2 = b.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([b2.column(0), b2.column(1), lists(flat[take], shared[ok])],
                                             ["cls", "n", "toks"])

    return sets.select("cls", "n", "toks").mapInArrow(run, "cls binary, n long, toks array<long>")


def prefixes(slim: DataFrame, freq: DataFrame, num: int, den: int) -> DataFrame:
    """(cls, ell, prefix): rarest-first prefix of each text, at the length of least cost."""
    def run(batches):
        for b in thin(batches):
            n, s, df = b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3)
            ells, out = [], []
            for i in range(b.num_rows):
                pairs = df[i].values
                d, t = pairs.field(0).to_numpy(), pairs.field(1).to_numpy()
                by = np.lexsort((t, d))
                d, t = d[by], t[by]
                first = int(s[i] - need(n[i], num, den) + 1)  # shortest prefix: one match is asked for
                read = np.cumsum(d)
                cost = {}
                for ell in ELLS:
                    k = first + ell - 1
                    if 0 < k <= len(d):
                        cost[ell] = float(read[k - 1]) * (1 + n[i] / 64 / ell)
                ell = min(cost, key=cost.get) if cost else 1
                ells.append(ell)
                out.append(t[:max(0, first + ell - 1)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ells, pa.int32()),
                 lists(np.concatenate(out) if out else np.zeros(0, dtype=np.int64), [len(x) for x in out])],
                ["cls", "ell", "prefix"])

    rows = slim.select("cls", "n", F.explode("toks").alias("token")).join(freq, "token")
    # the list is one text's own shingles
    own = rows.groupBy("cls").agg(F.first("n").alias("n"), F.count("*").alias("s"),
                                  F.collect_list(F.struct("df", "token")).alias("by"))
    return own.mapInArrow(run, "cls binary, ell int, prefix array<long>")


def _matrix(rows: list[np.ndarray], cols: np.ndarray, lo: int, hi: int) -> np.ndarray:
    m = np.zeros((len(rows), hi - lo), dtype=np.float32)
    for i, r in enumerate(rows):
        k = np.searchsorted(cols, r)
        k = k[(k >= lo) & (k < hi)]
        k = k[np.isin(cols[k], r)] if len(k) else k
        m[i, k - lo] = 1
    return m


def overlaps(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Exact intersection sizes of sorted sets; b None: of a with itself. Columns in bounded slices."""
    one, two = np.unique(np.concatenate(a)), np.unique(np.concatenate(b if b is not None else a))
    if b is None:
        vals, cnt = np.unique(np.concatenate(a), return_counts=True)
        cols = vals[cnt > 1]
    else:
        cols = np.intersect1d(one, two, assume_unique=True)
    out = np.zeros((len(a), len(b if b is not None else a)), dtype=np.float32)
    a = [np.intersect1d(x, cols, assume_unique=True) for x in a]
    b = [np.intersect1d(x, cols, assume_unique=True) for x in b] if b is not None else None
    step = max(256, (1 << 21) // max(1, len(a)))
    for lo in range(0, len(cols), step):
        hi = min(len(cols), lo + step)
        x = _matrix(a, cols, lo, hi)
        out += x @ (x.T if b is None else _matrix(b, cols, lo, hi).T)
    return out


def linked(a, b, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning links (i, j) between rows of a (and b). A row: (n, toks, ell, prefix, comp)."""
    same = b is None
    other = a if same else b
    shared = overlaps([r[3] for r in a], None if same else [r[3] for r in b])
    ell = np.minimum.outer([r[2] for r in a], [r[2] for r in other])
    n1, n2 = np.array([r[0] for r in a]), np.array([r[0] for r in other])
    ask = (shared >= ell) & (den * np.minimum.outer(n1, n2) >= num * np.maximum.outer(n1, n2))
    comp = {c: k for k, c in enumerate(dict.fromkeys(r[4] for r in [*a, *other]))}
    ask &= np.not_equal.outer([comp[r[4]] for r in a], [comp[r[4]] for r in other])
    if same:
        ask = np.triu(ask, 1)
    i, j = np.flatnonzero(ask.any(axis=1)), np.flatnonzero(ask.any(axis=0))
    if not len(i):
        return []
    both = overlaps([a[k][1] for k in i], [other[k][1] for k in j])
    good = ask[np.ix_(i, j)] & (den * both >= num * (n1[i][:, None] + n2[j][None, :] - both))
    up: dict = {}

    def root(x):
        while up.get(x, x) != x:
            up[x] = x = up.get(up[x], up[x])
        return x

    out = []
    for x, y in zip(*np.nonzero(good), strict=True):
        p, q = root(("a", int(i[x]))), root(("a" if same else "b", int(j[y])))
        if p != q:
            up[p] = q
            out.append((int(i[x]), int(j[y])))
    return out


def compare(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside each (bucket, grp); rows of side 1, if any, are compared with those of side 0 only.

    A bucket holds whole groups and is bounded, as every group is.
    """
    def run(key, t):
        out_a, out_b = [], []
        grp = t.column("grp").to_pylist()
        side = t.column("side").to_pylist()
        cls = t.column("cls").to_pylist()
        n, ell, comp = (t.column(c).to_pylist() for c in ("n", "ell", "comp"))
        toks, pre = t.column("toks"), t.column("prefix")
        of: dict = {}
        for k, g in enumerate(grp):
            of.setdefault(g, ([], []))[side[k]].append(k)

        def row(k):
            p = pre[k].values.to_numpy()
            return n[k], np.sort(toks[k].values.to_numpy()), ell[k], np.sort(p), comp[k]

        for one, two in of.values():
            if len(one) + len(two) < 2 or not one:
                continue
            a, b = [row(k) for k in one], [row(k) for k in two] or None
            for i, j in linked(a, b, num, den):
                out_a.append(cls[one[i]])
                out_b.append(cls[(two or one)[j]])
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})

    return rows.select("bucket", "grp", "side", "cls", "n", "toks", "ell", "prefix", "comp") \
        .groupBy("bucket").applyInArrow(run, "a binary, b binary")


def links(slim: DataFrame, pre: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """(a, b) links that span every component."""
    lists_of = pre.select("cls", F.explode("prefix").alias("token"))
    heads = lists_of.groupBy("token").agg(F.min("cls").alias("head"), F.max("cls").alias("last")) \
        .filter("head <> last").select("token", "head")
    chained = components(lists_of.join(heads, "token").filter("cls <> head").select("cls", "head").distinct(),
                         "cls", "head")
    rows = cut(slim.join(pre, "cls").join(chained.select(F.col("node").alias("cls"), "root"), "cls"))
    sizes = rows.groupBy("root").agg(F.count("*").alias("m"))
    rows = cut(rows.join(sizes, "root"))
    small = rows.filter(F.col("m") <= block)
    buckets = max(1, rows.count() // 128)
    found = compare(small.withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(buckets)).cast("string"))
                    .withColumn("grp", F.col("root")).withColumn("side", F.lit(0)).withColumn("comp", F.col("cls")),
                    num, den)
    large = rows.filter(F.col("m") > block)
    if large.isEmpty():
        return found
    # large chains: blocks of about block/2 documents, first tied to a few pivots
    large = large.withColumn("nb", F.ceil(F.col("m") / (block // 2))).withColumn("h", F.xxhash64("cls")) \
        .withColumn("blk", F.pmod(F.col("h"), F.col("nb")))
    key = F.concat_ws(":", F.hex("root"), F.col("blk").cast("string"))
    tops = large.groupBy("root").agg(F.max("nb").alias("tn"),
                                     F.slice(F.array_sort(F.collect_set(F.when(F.pmod("h", F.greatest("nb", F.lit(1)) * 32) == 0, F.struct("h", "cls")))), 1, PIVOTS).alias("tops"))
    tops = tops.select("root", "tn", F.explode("tops").alias("t")).select("root", "tn", F.col("t.cls").alias("cls"))
    pivots = rows.join(tops.select("cls", "tn"), "cls").withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("tn") - 1)))
    cols = ["bucket", "grp", "side", "cls", "n", "toks", "ell", "prefix", "comp"]
    star = (large.withColumn("side", F.lit(0)).withColumn("comp", F.col("cls")).withColumn("bucket", key).withColumn("grp", F.col("root")).select(cols)
            .unionByName(pivots.withColumn("side", F.lit(1)).withColumn("comp", F.col("cls")).withColumn("bucket", key).withColumn("grp", F.col("root")).select(cols)))
    tied = cut(compare(star, num, den).filter("a <> b"))
    comp = components(tied, "a", "b").select(F.col("node").alias("cls"), F.col("root").alias("comp"))
    large = large.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    # blocks again, those of a large component apart from the rest
    per = large.groupBy("comp").agg(F.count("*").alias("cm"))
    large = large.join(per, "comp").withColumn(
        "blk", F.when(F.col("cm") > block // 2, F.concat_ws("/", F.hex("comp"), F.pmod("h", F.ceil(F.col("cm") / (block // 2))).cast("string")))
        .otherwise(F.concat(F.lit("r"), F.pmod(F.xxhash64("comp"), F.col("nb")).cast("string"))))
    large = cut(large)
    blocks = large.groupBy("root", "blk").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"),
                                              F.min("n").alias("lo"), F.max("n").alias("hi"))
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, (F.col("x.root") == F.col("y.root")) & (F.col("x.blk") <= F.col("y.blk"))) \
        .filter("not (x.c1 = x.c2 and y.c1 = y.c2 and x.c1 = y.c1)") \
        .filter(F.expr(f"{den} * least(x.hi, y.hi) >= {num} * greatest(x.lo, y.lo)")) \
        .select(F.col("x.root").alias("root"), F.col("x.blk").alias("one"), F.col("y.blk").alias("two"),
                F.concat_ws(":", F.hex("x.root"), "x.blk", "y.blk").alias("bucket"))
    sides = pairs.select("root", F.col("one").alias("blk"), "bucket", F.lit(0).alias("side")) \
        .unionByName(pairs.filter("one <> two").select("root", F.col("two").alias("blk"), "bucket", F.lit(1).alias("side")))
    rest = compare(large.join(sides, ["root", "blk"]).withColumn("grp", F.col("root")).select(cols), num, den)
    return found.unionByName(tied).unionByName(rest)


def jaccard_join(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, stretch: float = 0.05,
                 block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs(doc_id, text)``."""
    base = cut(bases(docs, size, num, den, stretch))
    shared = cut(base.select(F.explode("pool").alias("token")).groupBy("token").count().filter("count > 1").select("token"))
    near = survivors(base, bloom_fit(shared, "token"), num, den, stretch)
    reps = cut(near.groupBy("cls").agg(F.min(F.coalesce("doc_id", F.lit(-1))).alias("rep")))
    sets = cut(whole_sets(docs, bloom_fit(reps, "rep"), size).join(
        reps, "cls").filter(F.coalesce("doc_id", F.lit(-1)) == F.col("rep")).select("cls", "n", "toks"))
    freq = cut(sets.select(F.explode("toks").alias("token")).groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    slim = cut(slim_sets(sets, bloom_fit(freq, "token"), num, den).dropDuplicates(["cls"]))
    pre = cut(prefixes(slim, freq, num, den))
    found = cut(links(slim, pre, num, den, block))
    roots = components(found, "a", "b").select(F.col("node").alias("cls"), "root")
    rows = base.select("doc_id", "n", "cls").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
