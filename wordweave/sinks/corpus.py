"""Documents written as folders of text files, one line of text a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordweave.functions.text import text_lines
from wordweave.operators.tokens import lines

# Characters of a text file, about.
FILE_CHARS = 128 << 20


def write_text_folders(documents: DataFrame, path: str, by: str) -> None:
    """Write the lines of documents to ``path``, a folder for each value of the column ``by``.

    Every task writes its own file in each folder, so a value with most of the text is
    many files and no row is shuffled.  An empty value and a null share a folder.
    """
    rows = documents.select(F.col(by).cast("string").alias(by), F.explode(text_lines("text")).alias("value"))
    rows.write.mode("overwrite").partitionBy(by).text(path)


def write_packed_documents(documents: DataFrame, path: str, file_chars: int = FILE_CHARS) -> None:
    """Write documents to text files of about ``file_chars`` characters, many documents to a file.

    ``path/lines`` holds the files and ``path/places`` for each document the file, its
    first line there and its number of lines.  A document's lines stand in order and together;
    rows of one id are one document.  Documents without text have no place.
    """
    total = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    n_files = max(1, -(-total // file_chars))
    file_no = F.pmod(F.xxhash64("doc_id"), F.lit(n_files)).alias("file_no")
    # Only complete files are in order, so a file is one task's.  Whole texts move, not lines with a key each.
    texts = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text", file_no).repartition(n_files, "file_no")
    in_order = lines(texts, "file_no").sortWithinPartitions("file_no", "doc_id", "line_no")
    in_order.select("file_no", F.col("line").alias("value")).write.mode("overwrite").partitionBy("file_no").text(f"{path}/lines")
    counted = documents.select("doc_id", file_no, F.size(text_lines("text")).cast("bigint").alias("n_lines"))
    sizes = counted.where("doc_id is not null and n_lines > 0").groupBy("file_no", "doc_id").agg(F.sum("n_lines").alias("n_lines"))
    earlier = Window.partitionBy("file_no").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_lines").over(earlier), F.lit(0))
    sizes.withColumn("first_line", first).write.mode("overwrite").parquet(f"{path}/places")
