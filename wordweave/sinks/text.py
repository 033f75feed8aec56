"""Delimited text output; every writer replaces what the path held once the new output is whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.sinks.replace import replacing

# Separators of the text layouts.
COUNT_SEPARATOR = ", "
INDEX_SEPARATOR = " : "
LINE_SEPARATOR = ","


def render_delimited(df: DataFrame, separator: str = COUNT_SEPARATOR) -> DataFrame:
    """The columns of ``df``, in order, as one ``value``; a null is an empty field."""
    return df.select(F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("value"))


def write_delimited(df: DataFrame, path: str, separator: str = COUNT_SEPARATOR) -> None:
    """Write the columns of ``df``, in order, joined by ``separator``."""
    _replace(render_delimited(df, separator), path)


def _replace(rows: DataFrame, path: str) -> None:
    with replacing(rows.sparkSession, path) as aside:
        rows.write.text(aside)


def write_report(df: DataFrame, path: str, separator: str = COUNT_SEPARATOR, one_file: bool = False) -> None:
    """Like :func:`write_delimited`; with ``one_file`` all rows go through one task."""
    rows = render_delimited(df, separator)
    _replace(rows.coalesce(1) if one_file else rows, path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write ``(metric, value)`` rows as ``metric: value``."""
    write_report(metrics, path, ": ", one_file=True)


def render_pairs(pairs: DataFrame, in_parentheses: bool = False) -> DataFrame:
    """``(lo, hi, similarity, text_lo, text_hi)`` as one line of text.

    The keys are joined by a tab, or written as ``(lo, hi)``.
    """
    keys = F.format_string("(%s, %s)" if in_parentheses else "%s\t%s", F.col("lo").cast("string"), F.col("hi").cast("string"))
    score = F.col("similarity").cast("float").cast("string")
    texts = F.format_string('"%s" - "%s"', "text_lo", "text_hi")
    return pairs.select(F.concat(keys, F.lit(INDEX_SEPARATOR), score, F.lit("\t"), texts).alias("value"))


def write_pairs(pairs: DataFrame, path: str, in_parentheses: bool = False) -> None:
    """Write similar pairs with their score and both texts."""
    _replace(render_pairs(pairs, in_parentheses), path)
