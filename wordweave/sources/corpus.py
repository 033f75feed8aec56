"""Corpora as ``(doc_id, text)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordweave.functions.text import line_key
from wordweave.shared import save, spread


def documents_table(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a Parquet table with ``doc_id`` and ``text``."""
    return spread(spark.read.parquet(path).select("doc_id", "text"), "doc_id")


def text_lines_by_file(spark: SparkSession, path: str) -> DataFrame:
    """A folder of text files as ``(doc_id, line)``, with the file's full path as ``doc_id``.

    Large files are split between tasks.  Counting words and building an index
    need no line order, so this is the reader for both.  Jobs on lines refuse it,
    as its lines have no number; they take :func:`numbered_text_lines`.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("line"))


def numbered_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """A folder of text files as ``(doc_id, line_no, key, line)``; large files are split between tasks.

    ``key`` is a bigint of its own for each line.  Lines are written once, because
    the order in which a scan meets its splits may change when it is repeated.  A split of a
    file is read in order by one task, so a line's number is its place in the split
    plus the lines of the file's earlier splits.
    """
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    placed = raw.select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("key"),
        F.col("value").alias("line"),
    )
    placed = save(placed, "text-lines", "zstd")
    splits = placed.groupBy("doc_id", "split").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("doc_id").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("doc_id", "split", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(starts, ["doc_id", "split"]).select("doc_id", (F.col("key") + F.col("shift")).alias("line_no"), "key", "line")


def text_documents(spark: SparkSession, path: str) -> DataFrame:
    """A folder of text files, one row per file, for numbering the lines of each file."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def text_lines_by_folder(spark: SparkSession, path: str, by: str) -> DataFrame:
    """``(doc_id, line)`` of text files in folders named ``by=value``; the value is the document.

    Files of any size are split between tasks.  For counting words and for an index.
    """
    rows = spark.read.schema(f"value string, `{by}` string").text(path)
    return rows.select(F.col(by).alias("doc_id"), F.col("value").alias("line"))


def packed_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, line_no, key, line)`` of :func:`wordweave.sinks.corpus.write_packed_documents`.

    Large files are split between tasks.  A line's place in its file says which document
    it is of; ``key`` packs document and line.
    """
    in_files = numbered_text_lines(spark, f"{path}/lines").select(
        F.regexp_extract("doc_id", r"/file_no=(\d+)/", 1).cast("bigint").alias("file_no"), F.col("line_no").alias("place"), "line"
    )
    places = spark.read.parquet(f"{path}/places")
    each = places.select("file_no", "doc_id", "first_line", F.explode(F.expr("sequence(0L, n_lines - 1)")).alias("line_no"))
    each = each.select("file_no", "doc_id", F.col("line_no").cast("int").alias("line_no"), (F.col("first_line") + F.col("line_no")).alias("place"))
    found = in_files.join(each, ["file_no", "place"])
    return found.select("doc_id", "line_no", line_key(F.col("doc_id"), F.col("line_no")).alias("key"), "line")
