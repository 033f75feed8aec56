"""Word counts, stop words and corpus-level term statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_count(tokens: DataFrame) -> DataFrame:
    """Occurrences of each word as ``(tok, n)``."""
    return tokens.groupBy("tok").agg(F.count("*").alias("n"))


def stop_words(counts: DataFrame, min_count: int = 4000) -> DataFrame:
    """Words with more than ``min_count`` occurrences in the whole corpus."""
    return counts.where(F.col("n") > min_count)


def term_statistics(tokens: DataFrame) -> DataFrame:
    """``(tok, n, one_document)`` in one pass.

    A term is in one document exactly if its smallest and largest ``doc_id`` agree,
    so no ``(tok, doc_id)`` pairs are shuffled to find out.
    """
    return tokens.groupBy("tok").agg(
        F.count("*").alias("n"), (F.min("doc_id") == F.max("doc_id")).alias("one_document")
    )


def distinct_term_count(statistics: DataFrame) -> DataFrame:
    """Number of distinct terms as a metric row."""
    return metric("distinct_terms", statistics, F.count("*"))


def single_document_terms(statistics: DataFrame) -> DataFrame:
    """Number of terms found in exactly one document as a metric row."""
    return metric("single_document_terms", statistics, F.count_if("one_document"))


def metric(name: str, rows: DataFrame, value: Column, kind: str = "bigint") -> DataFrame:
    """One-row ``(metric, value)`` aggregate of ``rows``."""
    return rows.agg(F.coalesce(value, F.lit(0)).cast(kind).alias("value")).select(
        F.lit(name).alias("metric"), "value"
    )
