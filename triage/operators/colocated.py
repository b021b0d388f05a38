"""Co-located tables (C1, C2): written once in buckets of a key, joined and grouped on it without an exchange.

A table is shuffled once when it is written: ``repartition`` by the bucket count deals rows as the bucketed
scan expects them, so every bucket is one sorted file, whatever the number of writers. Tables written with
one bucket count join bucket by bucket; as counts are powers of two, tables of different counts still meet by
merging buckets (``spark.sql.bucketing.coalesceBucketsInJoin.enabled``). The key should be an id: rows of one key
are one bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.session import checkpoint_dir

ROWS_PER_BUCKET = 4_000_000  # some hundred MB of mail metadata
LEAST, MOST = 8, 1 << 16


def bucket_count(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """The power of two that keeps buckets at ``per_bucket`` rows or fewer, within LEAST and MOST."""
    n = LEAST
    while n < MOST and n * per_bucket < rows:
        n *= 2
    return n


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``df`` as a table of the session's catalog, its files in the shared folder; returns the table."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark)}/colocated/{table}"
    df.repartition(buckets, F.col(key)).write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)
