"""Exact deduplication through a bucketed index of digests with a cuckoo filter per bucket.

Texts are equal when they are identical after all ASCII white space is deleted.  The
index is a table with the column ``bucket``: one row per live digest (its group's size
and the document that stays) and one row per bucket with the filter.  A filter hit is
verified against the bucket's stored digests; where a filter overflows it is rebuilt,
twice as large, from the stored keys.

Null texts count as empty, and empty texts equal each other.  Of rows with one text and
one ``doc_id`` all are marked as the row that stays, because nothing tells them apart.
A null ``doc_id`` comes after every other one.  Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.llm.common import map_rows, text_or_empty, utf8
from wordweave.llm.cuckoo import CuckooFilter, Overflow
from wordweave.shared import save

DIGESTS_PER_BUCKET = 8192
# Copies of one text are folded in this many parts before they meet in a bucket.
SALTS = 16

INDEX = "bucket long, digest binary, keep_id long, keep_chars long, group_size long, filter binary"


def text_digest(raw: bytes) -> bytes:
    return hashlib.sha256(b"".join(raw.split())).digest()


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, digest)``, one row per document; texts end here."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text_or_empty()).cast("long").alias("n_chars"),
        utf8().alias("raw"),
    )

    def start():
        return lambda r: [(r["doc_id"], r["n_chars"], text_digest(r["raw"]))]

    return map_rows(rows, "doc_id long, n_chars long, digest binary", start)


def _best(digest_rows: DataFrame, keys: list[str], n: F.Column) -> DataFrame:
    # The most characters, then the smallest id that is there.
    order = F.struct(-F.col("keep_chars"), F.col("keep_id").isNull(), F.col("keep_id"))
    return digest_rows.groupBy(*keys).agg(n.alias("group_size"), F.min_by(F.struct("keep_chars", "keep_id"), order).alias("k")).select(
        *keys, "group_size", "k.*"
    )


def partial_groups(digest_rows: DataFrame) -> DataFrame:
    """Copies folded in ``SALTS`` parts per digest, so that no digest is a hot key of the index."""
    salted = digest_rows.select(
        "digest",
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
        F.col("n_chars").alias("keep_chars"),
        F.col("doc_id").alias("keep_id"),
    )
    return _best(salted, ["digest", "salt"], F.count("*")).drop("salt")


class _Bucket:
    """One bucket: the stored digests and the filter in front of them."""

    def __init__(self, expected: int):
        self.stored: dict[bytes, list] = {}
        self.filter = CuckooFilter(expected)

    def _grow(self) -> None:
        size = 2 * max(1, len(self.stored))
        while True:
            try:
                self.filter = CuckooFilter(size)
                for key in self.stored:
                    self.filter.insert(key)
                return
            except Overflow:
                size *= 2

    def add(self, digest: bytes, keep_chars: int, keep_id: int | None, n: int) -> None:
        if digest in self.filter and (held := self.stored.get(digest)) is not None:
            held[2] += n
            order = (-keep_chars, keep_id is None, keep_id or 0)
            if order < (-held[1], held[0] is None, held[0] or 0):
                held[:2] = keep_id, keep_chars
            return
        self.stored[digest] = [keep_id, keep_chars, n]
        try:
            self.filter.insert(digest)
        except Overflow:
            self._grow()

    def remove(self, digest: bytes, n: int) -> None:
        if digest in self.filter and (held := self.stored.get(digest)) is not None:
            held[2] -= n
            if held[2] <= 0:
                del self.stored[digest]
                self.filter.delete(digest)

    def forget(self, digest: bytes) -> None:
        if digest in self.filter and self.stored.pop(digest, None) is not None:
            self.filter.delete(digest)

    def rows(self, bucket: int) -> Iterable[tuple]:
        for digest, (keep_id, keep_chars, n) in self.stored.items():
            yield bucket, digest, keep_id, keep_chars, n, None
        yield bucket, None, None, None, len(self.stored), self.filter.to_bytes()


def _frame(bucket: _Bucket, number: int) -> pd.DataFrame:
    columns = [c.split()[0] for c in INDEX.split(", ")]
    frame = pd.DataFrame(list(bucket.rows(number)), columns=columns)
    return frame.astype({"keep_id": "Int64", "keep_chars": "Int64"})


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


def build_index(partial: DataFrame, n_buckets: int) -> DataFrame:
    """The index of ``partial_groups`` in ``n_buckets`` buckets."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = _Bucket(len(pdf))
        for digest, n, chars, doc in zip(pdf["digest"], pdf["group_size"], pdf["keep_chars"], pdf["keep_id"], strict=True):
            bucket.add(bytes(digest), int(chars), _whole(doc), int(n))
        return _frame(bucket, int(pdf["bucket"].iloc[0]))

    number = F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).alias("bucket")
    return partial.select(number, "*").groupBy("bucket").applyInPandas(build, INDEX)


def update_index(index: DataFrame, partial: DataFrame, n_buckets: int, remove: bool = False) -> DataFrame:
    """Insert (or delete) the groups of ``partial`` in an index of ``n_buckets`` buckets.

    A deletion takes ``group_size`` copies off a digest; with the last copy the digest
    goes.  Digests the index doesn't hold are left alone.  Counts alone can't tell which
    document stays after a deletion: :func:`delete_documents` does.  Rows of ``partial``
    with a true ``forget``, where it has this column, first drop their digest whole.
    """

    def change(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        number = int((old if len(old) else new)["bucket"].iloc[0])
        keys, tables = old[old["digest"].notna()], old[old["filter"].notna()]
        bucket = _Bucket(len(keys) + len(new))
        bucket.stored = {
            bytes(d): [_whole(i), int(c), int(n)]
            for d, i, c, n in zip(keys["digest"], keys["keep_id"], keys["keep_chars"], keys["group_size"], strict=True)
        }
        if len(tables):
            bucket.filter = CuckooFilter.from_bytes(bytes(tables["filter"].iloc[0]))
        if "forget" in new:
            for digest in new.loc[new["forget"], "digest"]:
                bucket.forget(bytes(digest))
            new = new[~new["forget"]]
        for digest, n, chars, doc in zip(new["digest"], new["group_size"], new["keep_chars"], new["keep_id"], strict=True):
            if remove:
                bucket.remove(bytes(digest), int(n))
            else:
                bucket.add(bytes(digest), int(chars), _whole(doc), int(n))
        return _frame(bucket, number)

    number = F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).alias("bucket")
    changes = partial.select(number, "*").groupBy("bucket")
    return index.groupBy("bucket").cogroup(changes).applyInPandas(change, INDEX)


def delete_documents(index: DataFrame, live: DataFrame, gone: DataFrame, n_buckets: int) -> tuple[DataFrame, DataFrame]:
    """Take the documents of ``gone`` out of an index; returns the index and the documents still live.

    ``live`` and ``gone`` are tables as :func:`digests` makes them.  A document goes as
    often as ``gone`` has it; one that isn't live changes nothing.  The digests touched
    are folded anew from the documents that are left, so the index equals one built from
    them: the next best document stays where the one that stayed goes.
    """
    left = save(live.exceptAll(gone.select(live.columns)), "live-digests")
    touched = save(gone.select("digest").distinct(), "touched-digests")
    groups = partial_groups(left.join(touched, "digest", "left_semi")).withColumn("forget", F.lit(False))
    drops = touched.withColumn("forget", F.lit(True))
    return update_index(index, groups.unionByName(drops, allowMissingColumns=True), n_buckets), left


def exact_groups(docs: DataFrame, per_bucket: int = DIGESTS_PER_BUCKET) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest``."""
    rows = save(digests(docs), "digests")
    n_buckets = max(1, -(-rows.count() // per_bucket))
    index = save(build_index(partial_groups(rows), n_buckets), "digest-index")
    groups = index.where(F.col("digest").isNotNull()).select("digest", "keep_id", "keep_chars", "group_size")
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        "digest",
    )


def op7_exact_dedup(spark, sf_dir):
    groups = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP7_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
  FROM documents
),
groups AS (
  SELECT body, count(*) AS group_size, arg_min(doc_id, (-n_chars, doc_id)) AS keep_id FROM texts GROUP BY body
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM texts t JOIN groups g ON t.body = g.body"""
