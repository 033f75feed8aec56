"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows into buckets of about ``bucket_bytes``, each within one shard,
by seeded hashes.  Pass 2 takes one bucket at a time into memory, shuffles it by
Fisher-Yates and writes it.  The law is ``key``: a jump consistent hash of the
``doc_id`` picks the shard, so rows only ever move into a shard that is added.

Rows with a null ``doc_id`` form one key; a null text has no bytes.  The columns
``shard_no``, ``bucket_no`` and ``place_no`` take the place of columns of these names.  The order within a
shard depends on the seed, the rows and the size of the buckets alone.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType
from pyspark.sql.window import Window

from wordweave.llm.common import free_name, text_or_empty, without_names
from wordweave.shared import shared_folder

BUCKET_BYTES = 16 << 20
ROW_BYTES = 16


def jump_hash(keys: np.ndarray, n: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys to ``0..n-1``."""
    keys = keys.astype(np.int64).view(np.uint64).copy()
    found = np.zeros(len(keys), np.int64)
    at = np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    while len(active):
        found[active] = at[active]
        # Multiplier and shift of the published algorithm.
        keys[active] = keys[active] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((keys[active] >> np.uint64(33)).astype(np.float64) + 1.0)
        at[active] = ((found[active] + 1) * step).astype(np.int64)
        active = active[at[active] < n]
    return found


def shard_of(key: Column, n: int) -> Column:
    @F.pandas_udf(IntegerType())
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), n).astype(np.int32))

    return shard(key)


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    order = np.arange(n)
    picks = rng.integers(0, np.arange(n, 0, -1)) if n else order
    for last, pick in zip(range(n - 1, 0, -1), picks, strict=False):
        order[last], order[pick] = order[pick], order[last]
    return order


def size_of() -> Column:
    return (F.octet_length(text_or_empty()) + ROW_BYTES).cast("long")


def scatter(docs: DataFrame, n_shards: int = 40, bucket_bytes: int = BUCKET_BYTES, seed: int = 0) -> DataFrame:
    """Pass 1: add ``shard_no`` and ``bucket_no``; a shard's buckets are equally likely."""
    total = docs.select(size_of().alias("size")).agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-total // (n_shards * bucket_bytes)))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    return docs.select(
        *without_names(docs, "shard_no", "bucket_no").columns,
        shard_of(key, n_shards).alias("shard_no"),
        F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("text")), F.lit(per_shard)).cast("int").alias("bucket_no"),
    )


def shuffle_buckets(scattered: DataFrame, seed: int = 0) -> DataFrame:
    """Pass 2: shuffle each bucket in memory; ``place_no`` is a row's place in its bucket."""
    scattered = without_names(scattered, "place_no")
    schema = StructType(scattered.schema.fields).add("place_no", LongType())
    row_hash = free_name(scattered, "row_hash")
    ordered = scattered.withColumn(row_hash, F.xxhash64("doc_id", "text"))

    def shuffle(pdf: pd.DataFrame) -> pd.DataFrame:
        # A fixed order first, so that the result doesn't depend on how rows arrived.
        pdf = pdf.sort_values(row_hash, kind="stable").drop(columns=row_hash)
        rng = np.random.default_rng([seed, int(pdf["shard_no"].iloc[0]), int(pdf["bucket_no"].iloc[0])])
        pdf = pdf.iloc[fisher_yates(len(pdf), rng)]
        return pdf.assign(place_no=np.arange(len(pdf)))

    return ordered.groupBy("shard_no", "bucket_no").applyInPandas(shuffle, schema)


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, bucket_bytes: int = BUCKET_BYTES, seed: int = 0) -> DataFrame:
    """Write all rows under ``path``, a folder per shard, rows in shuffled order by bucket; returns them as read back."""
    shuffled = shuffle_buckets(scatter(docs, n_shards, bucket_bytes, seed), seed)
    shuffled.write.partitionBy("shard_no").parquet(path)
    # An empty table leaves no file that has the columns.
    return docs.sparkSession.read.schema(shuffled.schema).parquet(path)


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot_no``, gapless from 0 in each shard, to rows read from shards.

    Select narrow columns first: the rows may be shuffled to meet their bucket's start.
    """
    ends = rows.groupBy("shard_no", "bucket_no").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard_no").orderBy("bucket_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("shard_no", "bucket_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    return rows.join(starts, ["shard_no", "bucket_no"]).withColumn("slot_no", F.col("first_slot") + F.col("place_no"))


def shard_documents(docs: DataFrame, n_shards: int = 40, bucket_bytes: int = BUCKET_BYTES, seed: int = 0) -> DataFrame:
    """Write the shards to the shared folder and return their rows as read back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    return write_shards(docs, path, n_shards, bucket_bytes, seed)


def digest_of_shards(rows: DataFrame, n_shards: int = 40, seed: int = 0) -> list[Column]:
    grown = shard_of(F.xxhash64(F.lit(seed), F.col("doc_id")), n_shards + 1)
    return [
        F.col("doc_id"),
        F.col("size"),
        F.col("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard_no").cast("int").alias("shard"),
        F.col("slot_no").cast("long").alias("slot"),
        grown.alias("grown_shard"),
    ]


def sharded_digest(docs: DataFrame, n_shards: int = 40, seed: int = 0) -> DataFrame:
    rows = shard_documents(docs, n_shards, seed=seed)
    crc = F.crc32(text_or_empty().cast("binary")).alias("text_crc32")
    narrow = with_slots(rows.select("doc_id", size_of().alias("size"), crc, "shard_no", "bucket_no", "place_no"))
    return narrow.select(*digest_of_shards(narrow, n_shards, seed))


def op5_sharding(spark, sf_dir):
    return sharded_digest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
