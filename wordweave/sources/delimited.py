"""Delimited text tables that :mod:`wordweave.sinks` writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fields(rows: DataFrame, schema: str, separator: str) -> DataFrame:
    # A row of another shape raises.
    options = {"sep": separator, "quote": "", "mode": "FAILFAST"}
    return rows.select(F.from_csv("value", schema, options).alias("row")).select("row.*")


def parse_word_counts(rows: DataFrame) -> DataFrame:
    """``word, count`` values as ``(tok, n)``; a row of another shape raises."""
    return _fields(rows, "tok string, n bigint", ", ")


def parse_stop_words(rows: DataFrame) -> DataFrame:
    """``word, count`` or plain ``word`` values as ``(tok, n)``; without a count ``n`` is 0."""
    count = F.trim(F.split_part("value", F.lit(","), F.lit(2)))
    return rows.select(
        F.split_part("value", F.lit(","), F.lit(1)).alias("tok"),
        F.coalesce(F.nullif(count, F.lit("")).cast("bigint"), F.lit(0)).alias("n"),
    )


def parse_cleaned_lines(rows: DataFrame) -> DataFrame:
    """``key,word word word`` values as ``(key, toks)``."""
    return _fields(rows, "key bigint, words string", ",").select("key", F.split("words", " ").alias("toks"))


def word_counts(spark: SparkSession, path: str) -> DataFrame:
    return parse_word_counts(spark.read.text(path))


def stop_word_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_stop_words(spark.read.text(path))


def cleaned_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_cleaned_lines(spark.read.text(path))
