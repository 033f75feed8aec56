"""Lines as sets of rare words, rarest first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.functions.threshold import Threshold, unordered_pairs
from wordweave.operators.terms import metric
from wordweave.operators.tokens import without_hottest
from wordweave.shared import save

# Counts of a range of keys that the driver looks at in one pass, at least 3.
CUT_BINS = 4096

# Keys of first lines that are broadcast at most.
MAX_BROADCAST_KEYS = 100_000


def vocabulary(counts: DataFrame) -> DataFrame:
    """``(tok, n, word_id)`` with ids in the global order (count, word).

    Ids are unique and fixed once the table is written; word sets then sort,
    intersect and shuffle as bigints.
    """
    ordered = counts.repartitionByRange("n", "tok").sortWithinPartitions("n", "tok")
    return save(ordered.withColumn("word_id", F.monotonically_increasing_id()), "vocabulary")


def rare_line_words(line_words: DataFrame, vocab: DataFrame, max_count: int) -> DataFrame:
    """``(key, tok, word_id)`` for words with fewer than ``max_count`` occurrences.

    The inner join alone would do; dropping the hottest words first keeps their rows
    out of its shuffle.  The words of the lines are not sorted for the join: a task's
    part of the vocabulary is looked up.
    """
    frequent = vocab.where(F.col("n") >= max_count)
    rare = vocab.where(F.col("n") < max_count).select("tok", "word_id")
    return without_hottest(line_words, frequent).join(rare.hint("shuffle_hash"), "tok")


def lines_with_rare_words(line_words: DataFrame, counts: DataFrame, max_count: int) -> DataFrame:
    """``(key)`` of the lines that keep a word; needs word counts but no word order."""
    frequent = counts.where(F.col("n") >= max_count)
    rare = counts.where(F.col("n") < max_count)
    return without_hottest(line_words, frequent).join(rare, "tok", "left_semi").select("key").distinct()


def _by_line(rare_words: DataFrame) -> DataFrame:
    """Words dealt by line before they are listed.

    A join by word leaves the words of a line in many tasks, where lists begun before the
    shuffle hold a word or two each and are larger than the words.
    """
    return rare_words.repartition("key")


def line_sets(rare_words: DataFrame) -> DataFrame:
    """``(key, toks)`` with the words of each line, rarest first; empty lines are gone."""
    ordered = F.sort_array(F.collect_list(F.struct("word_id", "tok")))
    return _by_line(rare_words).groupBy("key").agg(F.transform(ordered, lambda w: w["tok"]).alias("toks"))


def line_id_sets(rare_words: DataFrame) -> DataFrame:
    """``(key, ids)``: :func:`line_sets` with word ids for words."""
    return _by_line(rare_words.select("key", "word_id")).groupBy("key").agg(F.sort_array(F.collect_list("word_id")).alias("ids"))


def rendered_line_sets(sets: DataFrame, *further: str) -> DataFrame:
    """``(key, words)`` with the words joined by spaces, and further columns."""
    return sets.select("key", F.array_join("toks", " ").alias("words"), *further)


def key_cut(keys: DataFrame, limit: int) -> int | None:
    """The ``limit``-th smallest bigint ``key``, or None if there are not more keys than that.

    The range of keys is cut into bins that are counted in one aggregate; the bin that
    holds the place is cut again, until it is one key.  No row is ordered or moved, and
    the driver sees ``CUT_BINS`` counts a pass at most.  Keys are unique.
    """
    n, low, high = keys.agg(F.count("*"), F.min("key"), F.max("key")).first()
    if n <= limit:
        return None
    before = 0
    while low < high:
        width = (high - low) // (CUT_BINS - 1) + 1
        in_range = keys.where(F.col("key").between(low, high))
        bin_no = F.expr(f"if(key < 0, (key + 1) div {width} - 1, key div {width})")
        counts = sorted(in_range.groupBy(bin_no.alias("bin_no")).count().collect())
        for bin_no, count in counts:
            if before + count >= limit:
                break
            before += count
        low, high = max(low, bin_no * width), min(high, (bin_no + 1) * width - 1)
    return low


def first_keys(keys: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of the ``key`` rows in order, without an ordered limit.

    Keys that are no integers get numbers in their order first.
    """
    if limit < 1:
        return keys.where(F.lit(False))
    if keys.schema["key"].dataType.typeName() == "long":
        cut = key_cut(keys, limit)
        return keys if cut is None else keys.where(F.col("key") <= cut)
    ordered = keys.repartitionByRange("key").sortWithinPartitions("key")
    numbered = save(ordered.select(F.col("key").alias("name"), F.monotonically_increasing_id().alias("key")), "key-order")
    return first_keys(numbered, limit).select(F.col("name").alias("key"))


def first_lines(sets: DataFrame, limit: int = 5000) -> DataFrame:
    """The first ``limit`` line sets in key order; ``sets`` is read twice and better a saved table."""
    firsts = first_keys(sets.select("key"), limit)
    return sets.join(F.broadcast(firsts) if limit <= MAX_BROADCAST_KEYS else firsts, "key", "left_semi")


def line_count(lines: DataFrame) -> DataFrame:
    """Number of non-empty cleaned lines as a metric row."""
    return metric("lines", lines, F.count("*"))


def prefix_postings(sets: DataFrame, threshold: Threshold) -> DataFrame:
    """``(tok, key)`` for the prefix words of each line."""
    prefix = F.slice("toks", F.lit(1), threshold.prefix_length("size(toks)"))
    return sets.select(F.explode(prefix).alias("tok"), "key")


def naive_comparisons(lines: DataFrame) -> DataFrame:
    """Number of pairs an all-pairs comparison of the lines would score."""
    return metric("comparisons", lines, unordered_pairs("count(*)"), "decimal(38,0)")
