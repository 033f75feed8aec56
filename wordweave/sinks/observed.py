"""Metrics taken in the pass that writes a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wordweave.operators.inverted_index import rendered_index
from wordweave.operators.line_sets import rendered_line_sets
from wordweave.sinks.replace import replacing
from wordweave.sinks.text import INDEX_SEPARATOR, LINE_SEPARATOR, render_delimited


def write_observed(rows: DataFrame, path: str, metrics: dict[str, Column], separator: str) -> dict[str, int]:
    """Write the columns of ``rows`` as delimited text and return aggregates over them.

    ``metrics`` names the aggregates.  Columns whose name starts with ``_`` are there for
    them alone and are not written.  The aggregates are taken by the tasks that write, so
    no job reads the rows again and a task that is run again counts once.
    """
    observation = Observation()
    watched = rows.observe(observation, *[F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in metrics.items()])
    written = watched.select(*[c for c in rows.columns if not c.startswith("_")])
    with replacing(rows.sparkSession, path) as aside:
        render_delimited(written, separator).write.text(aside)
    found = observation.get
    return {name: found[name] for name in metrics}


def write_index(index: DataFrame, path: str) -> dict[str, int]:
    """Write a ``(tok, doc_id, tf)`` index as ``term : doc#tf, doc#tf``.

    Returns the numbers of distinct terms, of terms in one document and of postings.
    """
    by_term = rendered_index(index, "_n")
    metrics = {
        "distinct_terms": F.count("*"),
        "single_document_terms": F.count_if(F.col("_n") == 1),
        "postings": F.sum("_n"),
    }
    return write_observed(by_term, path, metrics, INDEX_SEPARATOR)


def write_line_sets(sets: DataFrame, path: str) -> dict[str, int]:
    """Write ``(key, toks)`` as ``key,word word``; returns the numbers of lines and of their words."""
    rendered = rendered_line_sets(sets.withColumn("_n", F.size("toks")), "_n")
    return write_observed(rendered, path, {"lines": F.count("*"), "words": F.sum("_n")}, LINE_SEPARATOR)


def metric_rows(spark: SparkSession, metrics: dict[str, int]) -> DataFrame:
    """Metrics as ``(metric, value)`` rows."""
    return spark.createDataFrame(list(metrics.items()), "metric string, value bigint")
