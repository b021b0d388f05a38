"""Shared parts: lineage cuts, fixed-size Bloom filters, connected components, Arrow helpers."""

from __future__ import annotations

import ctypes
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.session import checkpoint_dir

# functions of this package travel with the task, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BITS = 1 << 16
OWN_ORDER = 4  # rounds of components() that go by the nodes' own order


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared folder of ``spark.checkpoint.dir``; survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def process_cache(owner: str) -> dict:
    """Values that a worker process keeps between tasks; never part of what a task ships.

    A worker that goes on with another owner's tasks drops what the last one kept and hands it back.
    """
    kept = sys.modules.setdefault("_triage_llm_cache", types.ModuleType("_triage_llm_cache")).__dict__.setdefault("kept", {})
    if kept.get("owner") != owner:
        kept.clear()
        kept["owner"] = owner
        release()
    return kept


def release() -> None:
    """Freed memory goes back to the system: that of Arrow's pool and that of numpy and Python."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc keeps what was freed below a block in use
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser over uint64: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------- Bloom filters

def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(keys.astype(np.int64, copy=False).view(np.uint64))
    n = np.uint64(bits - 1)
    return x & n, (x >> np.uint64(32)) & n


def bloom_fit(keys: DataFrame, col: str, max_bits: int = 1 << 27) -> tuple[np.ndarray, int]:
    """Fixed-size Bloom filter (two probes) over a long column.

    Its size follows the number of keys up to ``max_bits`` (16 MB), which bounds what is sent to
    the driver and broadcast, whatever the table's size. The bitmap is put together in blocks by
    Spark. A filter that fills up lets more keys through and never loses one.
    """
    keys = keys.select(F.col(col).cast("long").alias("k"))
    bits = 1 << 20
    n = keys.count()
    while bits < min(max_bits, 12 * n):
        bits <<= 1

    def local(batches):
        packed = np.zeros(bits // 8, dtype=np.uint8)
        for b in thin(batches, 1 << 16):
            for p in _probes(b.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(packed, (p >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (p & np.uint64(7)).astype(np.uint8))
        yield from _blocks(packed)

    def either(key, t):
        all_of = np.zeros(BLOCK_BITS // 8, dtype=np.uint8)
        for piece in t.column("bitmap"):
            all_of |= np.frombuffer(piece.as_buffer(), dtype=np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "bitmap": pa.array([all_of.tobytes()], pa.binary())})

    kind = "block long, bitmap binary"
    blocks = keys.mapInArrow(local, kind).groupBy("block").applyInArrow(either, kind)
    out = np.zeros(bits // 8, dtype=np.uint8)
    # a partition is fetched by a job of its own: as many as the bitmap has MB, not as the shuffle has partitions
    for row in blocks.repartition(max(2, bits >> 23)).toLocalIterator():
        at = row.block * (BLOCK_BITS // 8)
        out[at:at + BLOCK_BITS // 8] = np.frombuffer(bytes(row.bitmap), dtype=np.uint8)
    return out, bits


def _blocks(packed: np.ndarray):
    rows = packed.reshape(-1, BLOCK_BITS // 8)
    full = np.flatnonzero(rows.any(axis=1))
    for at in range(0, len(full), 64):
        some = full[at:at + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([rows[i].tobytes() for i in some], pa.binary())], ["block", "bitmap"])


def bloom_has(bloom: tuple[np.ndarray, int], keys: np.ndarray) -> np.ndarray:
    packed, bits = bloom
    out = np.ones(len(keys), dtype=bool)
    for p in _probes(keys, bits):
        out &= (packed[p >> np.uint64(3)] >> (np.uint8(7) - (p & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1
    return out


# ---------------------------------------------------------------- connected components

def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of ``edges``; root: the smallest node its links reach.

    Each round points every node to the first of itself and its neighbours and lays its links
    between what their ends point to. Loops and repeats go, so links shrink from round to round and
    few rounds are left; then the pointers of all rounds are followed. The first rounds go by the
    nodes' own order, later ones by hash, as a long chain in order would lose a node a round.
    Minima pre-aggregate before the shuffle, the links of every round are cut, nothing is collected but one
    flag whether links are left.
    """
    def laid(df, u, v):
        return cut(df.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct())

    def rank(col):
        return F.struct(F.xxhash64(F.lit(len(steps)), col).alias("h"), F.col(col).alias("node"))

    steps: list[DataFrame] = []
    links = laid(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if len(steps) < OWN_ORDER:
            step = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("to"))
        else:
            step = both.groupBy("u").agg(F.min(rank("v")).alias("m")).select(
                F.col("u").alias("node"), F.least(rank("u"), F.col("m"))["node"].alias("to"))
        steps.append(step)
        links = laid(links.join(steps[-1].toDF("u", "x"), "u").join(steps[-1].toDF("v", "y"), "v").filter("x <> y"), "x", "y")
        if links.isEmpty():
            break
    hashed = len(steps) > OWN_ORDER
    labels = steps.pop()
    while steps:
        labels = steps.pop().join(labels.toDF("to", "root"), "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    if hashed:  # the node left of a component need not be its smallest
        labels = cut(labels)
        labels = labels.join(labels.groupBy("to").agg(F.min("node").alias("root")), "to").select("node", F.col("root").alias("to"))
    return cut(labels.toDF("node", "root"))


# ---------------------------------------------------------------- Arrow helpers

def thin(batches, rows: int = 512):
    """Arrow batches in slices of so many rows: what a task holds beside a batch stays small.

    Workers live on between tasks, so what the last one freed is handed back first.
    """
    release()
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column; null reads as empty."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    arr = arr.cast(pa.large_binary()).fill_null(b"") if arr.null_count else arr.cast(pa.large_binary())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, dtype=np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lists(values: np.ndarray, counts: np.ndarray, kind=None) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                    pa.array(values, kind or pa.int64()))
