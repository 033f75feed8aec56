"""Shared-folder tables, bounded broadcasts and scan parallelism."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast word list holds at most this many words of at most this many
# characters: 100,000 x 64 x 4 bytes is 26 MB at the very most, a few MB in practice.
MAX_BROADCAST_WORDS = 100_000
MAX_BROADCAST_CHARS = 64

_local_folder: tempfile.TemporaryDirectory | None = None
_bucketed: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the session names it.

    Only a local-mode session without ``spark.checkpoint.dir`` gets a folder of
    its own; on a cluster a machine-local folder would not survive an executor.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="wordweave-")
    return _local_folder.name


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/wordweave/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder, removed with the application's tables."""
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as a scan.

    The copy cuts the lineage, so a lost executor costs a re-read and not a
    recomputation, and the optimizer sees the true size of the table when it
    chooses between a broadcast and a shuffled join.  Without ``compression`` the
    session's codec is used.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved_tables(spark: SparkSession) -> None:
    """Remove the tables this application saved; results that scan them end with it."""
    while _bucketed:
        spark.sql(f"DROP TABLE IF EXISTS {_bucketed.pop()}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def save_bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """Like :func:`save`, in buckets by ``key``: joins and groupings on it shuffle no row of the table.

    There are as many buckets as shuffle partitions, so that the other side of a join
    goes to the buckets and not both sides to somewhere else.
    """
    spark = df.sparkSession
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    # Dealt by the same hash as the buckets, so each is one file.
    dealt = df.repartition(n_buckets, key).write.bucketBy(n_buckets, key).sortBy(key)
    dealt.option("path", f"{_session_folder(spark)}/{name}").saveAsTable(name)
    _bucketed.append(name)
    return spark.table(name)


def plain_scan(df: DataFrame) -> DataFrame:
    """The files of a saved table without its buckets: tasks by size, for a pass that another shuffle follows.

    Read by bucket such a pass has as many tasks as buckets, each with a file for every partition.
    """
    folders = sorted({file.rsplit("/", 1)[0] for file in df.inputFiles()})
    return df.sparkSession.read.schema(df.schema).parquet(*folders) if folders else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core after a scan whose splits leave half of them idle.

    A corpus of many files already fills the cluster and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, key)


def hot_share(n: str, total: int | None, at_most: int) -> Column:
    """Rows with at least one part in ``at_most`` of ``total``, the sum of ``n``: by arithmetic no more than that many."""
    return F.col(n) >= max(1, -(-(total or 0) // at_most)) if at_most else F.lit(False)


def split_words(words: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent words of a ``(tok, n)`` table and the rest of it, or None if nothing is left.

    The first part is bounded for a broadcast without an order or a limit.
    """
    total, least, longest = words.agg(F.sum("n"), F.min("n"), F.max(F.length("tok"))).first()
    hot = hot_share("n", total, MAX_BROADCAST_WORDS) & (F.length("tok") <= MAX_BROADCAST_CHARS)
    all_hot = total is None or least * MAX_BROADCAST_WORDS >= max(total, 1) and longest <= MAX_BROADCAST_CHARS
    return words.where(hot).select("tok"), None if all_hot else words.where(~hot).select("tok")


def hottest_words(words: DataFrame) -> DataFrame:
    """The first part of :func:`split_words`."""
    return split_words(words)[0]
