"""Operator 1 [native]: benchmark decontamination by SimHash windows.

A benchmark item of k words is sought in every text by windows of k words: the 64-bit SimHash of
the window's word shingles (weighted by how often each stands in it) is compared with the item's
through a multi-index: the 64 bits are cut into ``radius + 1`` blocks, and two fingerprints within
``radius`` bits agree on at least one block, so an equi-join on (window size, block, its value)
misses none of them. Pairs within the radius are verified by the exact weighted Jaccard
similarity of their shingle multisets, which must reach ``num/den``.

A window that reaches ``num/den`` has a known number of its places taken by shingles of items of its
size (``least_hits``). Moved right to the first of them, or to the text's last window, it loses none; so of
all windows those that start there and hold that many are laid, whatever the order of the parts, and no item
that any window reaches is lost. Which item it is, is found by the fingerprints. Of windows of
equal content one goes through the index, however many texts hold it.
At a similarity of 0.8 SimHashes are some 10 bits apart (standard deviation 3): the default radius
of 20 leaves out none in practice, and clean text is some 32 bits away.

Words are lower-cased runs of letters and digits. The benchmark's shingles are broadcast only while
they number at most ``BROADCAST``; beyond that the join shuffles. Edge cases: a null text and one
shorter than a shingle match by the whole of it as one shingle, if it has a word; items without a
word match nothing; repeated rows and items each match; rows with a null doc_id or item_id match
nothing; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import cut

SHINGLE, RADIUS = 5, 20
BROADCAST = 1_000_000  # shingles of the benchmark, some 50 MB


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(w: str, size: int = SHINGLE) -> Column:
    """Shingle hashes of a word array, in order; fewer words: all of them as one; none: empty."""
    return F.expr(f"""case when size({w}) >= {size} then transform(sequence(1, size({w}) - {size - 1}), i -> xxhash64(slice({w}, i, {size})))
                      when size({w}) > 0 then array(xxhash64({w})) else cast(array() as array<bigint>) end""")


def simhash(h: str) -> Column:
    """64 majority bits over an array of hashes; each occurrence weighs one."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (f, b) -> f | if(
        2 * aggregate({h}, 0L, (n, x) -> n + (shiftright(x, b) & 1L)) > size({h}), shiftleft(1L, b), 0L))""")


def blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 1 blocks of 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def block_rows(df: DataFrame, radius: int) -> DataFrame:
    """A row for each block of ``f``: its number and value."""
    each = [F.struct(F.lit(i).alias("blk"), F.shiftrightunsigned("f", a).bitwiseAND(F.lit((1 << n) - 1)).alias("val"))
            for i, (a, n) in enumerate(blocks(radius))]
    return df.withColumn("b", F.explode(F.array(*each))).select("*", "b.blk", "b.val").drop("b")


def weighted_overlap(a: str, b: str) -> Column:
    """Sum over shingles of the smaller of their two counts."""
    return F.expr(f"""aggregate(array_distinct(array_intersect({a}, {b})), 0L, (t, x) -> t + least(
        size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))""")


def items_of(bench: DataFrame) -> DataFrame:
    b = bench.select(F.col("item_id").cast("long"), words("text").alias("w")).filter("item_id is not null")
    b = cut(b.select("item_id", shingles("w").alias("g")))
    return b.filter(F.size("g") > 0).select("item_id", "g", F.size("g").alias("k"), simhash("g").alias("f"))


def least_hits(k: str, m: str, num: int, den: int) -> str:
    """SQL of how many places of a window of size k in a text of m shingles must be an item's to reach num/den."""
    return f"cast(ceil({num} * (least({k}, {m}) + {k}) / {num + den}.0) as int)"


def windows_of(docs: DataFrame, items: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, at, k, win): item-sized windows that hold ``least_hits`` shingles of items of that size."""
    marks = items.select("k", F.explode_outer("g").alias("x")).distinct()
    if marks.count() <= BROADCAST:
        marks = F.broadcast(marks)
    d = docs.select(F.col("doc_id").cast("long"), words("text").alias("w")).filter("doc_id is not null")
    d = d.select("doc_id", shingles("w").alias("h")).withColumn("row", F.xxhash64("h"))  # rows may share an id
    # outer: a plain explode would make the optimizer filter on the whole expression of h first
    hits = d.select("doc_id", "row", "h", F.posexplode_outer("h").alias("i", "x")).join(marks, "x")
    texts = hits.groupBy("doc_id", "row", "k").agg(F.first("h").alias("h"), F.sort_array(F.collect_set("i")).alias("p"))
    texts = texts.withColumn("last", F.greatest(F.lit(0), F.size("h") - F.col("k"))) \
        .withColumn("need", F.expr(least_hits("k", "size(h)", num, den)))
    starts = F.expr("""concat(
        filter(p, (s, j) -> s <= last and j + need <= size(p) and get(p, j + need - 1) < s + k),
        if(get(p, size(p) - 1) > last and need <= size(p) and get(p, size(p) - need) >= last, array(last), cast(array() as array<int>)))""")
    laid = texts.select("doc_id", "k", "h", F.explode_outer(F.array_distinct(starts)).alias("at")).filter("at is not null")
    return laid.select("doc_id", "k", "at", F.slice("h", F.col("at") + 1, F.col("k")).alias("win"))


def find_leaks(docs: DataFrame, bench: DataFrame, num: int = 80, den: int = 100, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, first_word, similarity) of the best window of each text and item it leaks.

    ``first_word``: the window's, after normalisation; of equally good windows that are laid the first one's.
    """
    items = cut(items_of(bench))
    wins = cut(windows_of(docs, items, num, den))
    # equal windows of any number of texts go through the index once
    distinct = wins.groupBy("k", "win").agg(F.count("*").alias("n")).select("k", "win", simhash("win").alias("f"))
    near = block_rows(distinct, radius).join(block_rows(items.select("item_id", "k", "g", F.col("f").alias("fi")).withColumn("f", F.col("fi")), radius).drop("f"), ["k", "blk", "val"]) \
        .filter(F.bit_count(F.col("f").bitwiseXOR(F.col("fi"))) <= radius).select("k", "win", "item_id", "g").distinct()
    near = near.withColumn("both", weighted_overlap("win", "g")).withColumn("total", F.size("win") + F.size("g") - F.col("both"))
    sure = near.filter(F.col("both") * den >= F.col("total") * num).select("k", "win", "item_id", (F.col("both") / F.col("total")).alias("similarity"))
    rows = wins.join(sure, ["k", "win"])
    return rows.groupBy("doc_id", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "at")).alias("b")).select(
        "doc_id", "item_id", F.col("b.at").cast("long").alias("first_word"), (-F.col("b.s")).alias("similarity"))
