"""Jobs on lines: cleaning, line sets and similar lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.functions.text import LINES_PER_DOCUMENT
from wordweave.functions.threshold import Threshold
from wordweave.operators import all_pairs
from wordweave.operators import line_sets as ls
from wordweave.operators import similarity as sim
from wordweave.operators.tokens import keyed_lines, line_words
from wordweave.plans.index_jobs import word_counts
from wordweave.shared import plain_scan, save, save_bucketed


@dataclass(frozen=True)
class RareLines:
    """The rare words of each line, with the vocabulary they are counted in."""

    words: DataFrame
    vocab: DataFrame
    max_count: int


@dataclass(frozen=True)
class LineSets:
    """Distinct line sets and the lines behind those that repeat."""

    sets: DataFrame
    members: DataFrame
    rare: RareLines


def rare_lines(documents: DataFrame, max_count: int = 4000) -> RareLines:
    vocab = ls.vocabulary(word_counts(documents))
    words = ls.rare_line_words(line_words(keyed_lines(documents)), vocab, max_count)
    return RareLines(words, vocab, max_count)


def non_empty_lines(documents: DataFrame, max_count: int = 4000) -> DataFrame:
    """``(key)`` of the lines that have a line set."""
    counts = save(word_counts(documents), "word-counts")
    return ls.lines_with_rare_words(line_words(keyed_lines(documents)), counts, max_count)


def line_sets(documents: DataFrame, max_count: int = 4000) -> DataFrame:
    """``(key, toks)``."""
    return ls.line_sets(rare_lines(documents, max_count).words)


def first_rare_lines(documents: DataFrame, limit: int, max_count: int = 4000) -> RareLines:
    """:func:`rare_lines` of the first ``limit`` lines that keep a word; counts are of the whole corpus.

    The keys alone find the cut, so the words of later lines are never put into sets.
    """
    vocab = ls.vocabulary(word_counts(documents))
    keyed = keyed_lines(documents)
    keys = save(ls.lines_with_rare_words(line_words(keyed), vocab, max_count), "line-keys")
    firsts = ls.first_keys(keys, limit)
    first_lines = keyed.join(F.broadcast(firsts) if limit <= ls.MAX_BROADCAST_KEYS else firsts, "key", "left_semi")
    return RareLines(ls.rare_line_words(line_words(first_lines), vocab, max_count), vocab, max_count)


def first_line_sets(documents: DataFrame, limit: int, max_count: int = 4000) -> DataFrame:
    """``(key, toks)`` of the first ``limit`` lines in key order that have a line set."""
    return ls.line_sets(first_rare_lines(documents, limit, max_count).words)


def first_line_pairs(documents: DataFrame, threshold: Threshold, limit: int, max_count: int = 4000) -> DataFrame:
    """``(lo, hi, similarity, text_lo, text_hi)`` by comparing all pairs of the first ``limit`` lines."""
    rare = first_rare_lines(documents, limit, max_count)
    id_sets = save(ls.line_id_sets(rare.words), "first-lines")
    pairs = save(all_pairs.similar_pairs(id_sets, threshold, id_sets.count()), "first-pairs")
    texts = sim.set_texts(id_sets.withColumnRenamed("key", "set_id"), rare.vocab)
    for side in ("lo", "hi"):
        pairs = pairs.join(texts.withColumnsRenamed({"set_id": side, "text": f"text_{side}"}), side)
    return pairs.select("lo", "hi", "similarity", "text_lo", "text_hi")


def collapsed_line_sets(documents: DataFrame, max_count: int = 4000) -> LineSets:
    rare = rare_lines(documents, max_count)
    id_sets = save(ls.line_id_sets(rare.words), "line-sets")
    # Looked up by id again and again, so its rows stay in their buckets.
    sets = save_bucketed(sim.distinct_sets(id_sets), "sets", "set_id")
    return LineSets(sets, sim.set_members(id_sets, sets), rare)


def similar_groups(lines: LineSets, threshold: Threshold, whole: bool = False) -> DataFrame:
    """Similar line sets with their numbers of lines; ``whole`` leaves out the prefix filter."""
    # A kept word occurs fewer than max_count times, so no word has more postings.
    max_postings = lines.rare.max_count - 1
    similar = sim.similar_sets(lines.sets, threshold, max_postings, whole=whole, scan=plain_scan(lines.sets))
    return sim.similar_groups(similar, lines.sets, threshold)


def similar_groups_with_texts(
    documents: DataFrame, threshold: Threshold, max_count: int = 4000, whole: bool = False
) -> DataFrame:
    """Similar line sets with their numbers of lines and both texts, once per pair of sets."""
    lines = collapsed_line_sets(documents, max_count)
    groups = save(similar_groups(lines, threshold, whole), "similar-groups")
    return sim.with_texts(groups, lines.sets, lines.rare.vocab)


def line_links(documents: DataFrame, threshold: Threshold, max_count: int = 4000) -> DataFrame:
    """``(key, set_id, n_links)``: every line with a set and the number of lines similar to it."""
    lines = collapsed_line_sets(documents, max_count)
    return sim.line_links(similar_groups(lines, threshold), lines.sets, lines.members)


def similar_lines(documents: DataFrame, threshold: Threshold, max_count: int = 4000) -> DataFrame:
    """``(lo, hi, similarity)`` for all pairs of similar lines."""
    lines = collapsed_line_sets(documents, max_count)
    return sim.line_pairs(similar_groups(lines, threshold), lines.members)


def similar_lines_with_texts(documents: DataFrame, threshold: Threshold, max_count: int = 4000) -> DataFrame:
    """``(lo, hi, similarity, text_lo, text_hi)`` for all pairs of similar lines."""
    lines = collapsed_line_sets(documents, max_count)
    groups = save(similar_groups(lines, threshold), "similar-groups")
    return sim.line_pairs(sim.with_texts(groups, lines.sets, lines.rare.vocab), lines.members)


def adjacent_line_scores(documents: DataFrame, max_count: int = 4000) -> DataFrame:
    """Jaccard similarity of each line to the next line of its document, where both hold words."""
    rare = rare_lines(documents, max_count)
    sets = save(ls.line_id_sets(rare.words), "line-sets").withColumnRenamed("key", "set_id")
    key = F.col("set_id")
    if "key" in documents.columns:
        after = documents.select("doc_id", (F.col("line_no") - 1).alias("line_no"), F.col("key").alias("hi"))
        pairs = documents.select("doc_id", "line_no", F.col("key").alias("lo")).join(after, ["doc_id", "line_no"]).select("lo", "hi")
    elif sets.schema["set_id"].dataType.typeName() == "struct":
        pairs = sets.select(key.alias("lo"), F.struct(key["doc_id"].alias("doc_id"), (key["line_no"] + 1).alias("line_no")).alias("hi"))
    else:
        # Line 0 of a document follows no line of it, though its key may follow another document's last.
        pairs = sets.select(key.alias("lo"), (key + 1).alias("hi")).where(F.pmod("hi", F.lit(LINES_PER_DOCUMENT)) != 0)
    return sim.score_pairs(pairs, sets, "lo", "hi")
