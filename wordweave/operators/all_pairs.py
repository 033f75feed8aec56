"""Comparison of all pairs of lines on a randomised grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.functions.threshold import Threshold, jaccard, shared_words

# Rows of a band; a cell of the grid compares two bands.
BAND_ROWS = 256


def grid(rows: DataFrame, key: str, n_bands: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a self-join in which every unordered pair of rows meets in one cell.

    A row belongs to one band by a hash of its key, so that bands are even whatever the
    keys are.  Cell ``(i, j)`` with ``i <= j`` holds the pairs of a row of band ``i`` on the
    left with one of band ``j`` on the right.  A row goes to ``n_bands + 1`` cells, which is
    what it takes for all pairs to meet in cells of bounded size.
    """
    band = F.pmod(F.xxhash64(key), F.lit(n_bands)).cast("int")
    banded = rows.withColumn("band", band)
    left = banded.withColumn("cell_j", F.explode(F.sequence(F.col("band"), F.lit(n_bands - 1)))).withColumnRenamed("band", "cell_i")
    right = banded.withColumn("cell_i", F.explode(F.sequence(F.lit(0), F.col("band")))).withColumnRenamed("band", "cell_j")
    return left, right


def similar_pairs(sets: DataFrame, threshold: Threshold, n_rows: int, band_rows: int = BAND_ROWS) -> DataFrame:
    """``(lo, hi, similarity)`` of a ``(key, ids)`` table by comparing every pair of its rows.

    The work is the square of ``n_rows``, the number of rows, whatever they hold: for a
    table that a limit has cut.  A task gets whole cells, of about ``band_rows`` rows on either side,
    and only pairs that pass leave the join.
    """
    n_bands = max(1, -(-n_rows // band_rows))
    left, right = grid(sets.select("key", "ids"), "key", n_bands)
    a, b = left.alias("a"), right.alias("b")
    a_len, b_len = F.size("a.ids"), F.size("b.ids")
    inter = shared_words(F.col("a.ids"), F.col("b.ids"))
    met = a.join(
        b.hint("merge"),
        [
            F.col("a.cell_i") == F.col("b.cell_i"),
            F.col("a.cell_j") == F.col("b.cell_j"),
            # In a cell of one band each pair would meet twice.
            (F.col("a.cell_i") < F.col("a.cell_j")) | (F.col("a.key") < F.col("b.key")),
            threshold.lengths_suffice(F.least(a_len, b_len), F.greatest(a_len, b_len)),
            threshold.overlap_suffices(inter, a_len + b_len),
        ],
    )
    scored = met.select(
        F.least("a.key", "b.key").alias("lo"),
        F.greatest("a.key", "b.key").alias("hi"),
        F.explode(F.array(inter)).alias("inter"),
        (a_len + b_len).alias("total"),
    )
    return scored.select("lo", "hi", jaccard(F.col("inter"), F.col("total") - F.col("inter")).alias("similarity"))
