"""Jobs on terms: word counts, stop words and the inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.operators import inverted_index as idx
from wordweave.operators import terms
from wordweave.operators.tokens import tokens, without_words
from wordweave.shared import save


def word_counts(documents: DataFrame, mode: str = "alnum") -> DataFrame:
    return terms.word_count(tokens(documents, mode))


def stop_words(documents: DataFrame, min_count: int = 4000) -> DataFrame:
    return terms.stop_words(word_counts(documents, "delim"), min_count)


def tokens_per_document(documents: DataFrame, min_count: int = 4000) -> DataFrame:
    """``(doc_id, n_tokens)`` without stop words; the list is written once, as it is scanned more than once."""
    kept = without_words(tokens(documents, "delim"), save(stop_words(documents, min_count), "stop-words"))
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_tokens"))


def inverted_index(documents: DataFrame, min_count: int = 4000) -> DataFrame:
    """``(tok, doc_id, tf)`` without stop words.

    Stop words are counted first, which moves a row per word and task, and then never
    shuffled; what is left moves once, by term.  Lines of few large documents are taken
    apart once: their counts by document are much smaller than the lines.
    """
    if "text" in documents.columns:
        stop_list = save(stop_words(documents, min_count), "stop-words")
        return idx.inverted_index(tokens(documents, "delim"), stop_list, by_term=True)
    frequencies = save(idx.term_frequencies(tokens(documents, "delim")), "term-frequencies", "zstd")
    return idx.without_frequent_terms(frequencies, min_count)


def term_statistics(documents: DataFrame, min_count: int = 4000) -> DataFrame:
    """Statistics of the terms that are no stop words, in one pass over the corpus."""
    statistics = terms.term_statistics(tokens(documents, "delim"))
    return statistics.where(F.col("n") <= min_count)
