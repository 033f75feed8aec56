"""Inverted index: flat, nested, rendered, boolean and in blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordweave.operators.terms import stop_words
from wordweave.operators.tokens import without_words
from wordweave.shared import save, split_words

# Documents that a block of a posting list spans.
BLOCK_DOCS = 4096


def term_frequencies(tokens: DataFrame) -> DataFrame:
    """Occurrences of each term in each document as ``(tok, doc_id, tf)``."""
    return tokens.groupBy("tok", "doc_id").agg(F.count("*").alias("tf"))


def term_frequencies_by_block(tokens: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """:func:`term_frequencies` with the ``block_no`` of :func:`blocked_index`, dealt by term and block.

    The words of a document repeat too little for a count before the shuffle, which would
    hold every term of every document of a task.  Counts and lists share the one shuffle.
    """
    blocked = tokens.select("tok", "doc_id", F.expr(_block_no(block_docs)).alias("block_no"))
    return blocked.repartition("tok", "block_no").groupBy("tok", "block_no", "doc_id").agg(F.count("*").alias("tf"))


def term_frequencies_by_term(tokens: DataFrame) -> DataFrame:
    """:func:`term_frequencies` dealt by term, so that posting lists need no further shuffle.

    For tokens without stop words: all of a term pass one task.
    """
    return tokens.repartition("tok").groupBy("tok", "doc_id").agg(F.count("*").alias("tf"))


def inverted_index(
    tokens: DataFrame, stop_list: DataFrame, block_docs: int | None = None, by_term: bool = False
) -> DataFrame:
    """Term frequencies without the terms of a ``(tok, n)`` stop list.

    The list's hottest words are dropped first and its tail, if there is any, after the
    aggregation, where a word is one row per document and not one row per occurrence.
    With ``block_docs`` they come by block, for :func:`blocked_index`, and with ``by_term``
    dealt by term, which asks for a stop list that bounds the occurrences of a term.
    """
    hot, rest = split_words(stop_list)
    kept = tokens.join(F.broadcast(hot), "tok", "left_anti")
    if block_docs:
        frequencies = term_frequencies_by_block(kept, block_docs)
    else:
        frequencies = term_frequencies_by_term(kept) if by_term else term_frequencies(kept)
    return frequencies if rest is None else frequencies.join(rest, "tok", "left_anti")


def without_frequent_terms(frequencies: DataFrame, min_count: int) -> DataFrame:
    """Term frequencies without the terms of more than ``min_count`` occurrences in all documents.

    The list comes from the frequencies themselves, so the texts are taken apart once.
    ``frequencies`` is read twice and better a saved table.
    """
    counts = frequencies.groupBy("tok").agg(F.sum("tf").alias("n"))
    return without_words(frequencies, save(stop_words(counts, min_count), "stop-words"))


def _block_no(block_docs: int) -> str:
    """The whole part of ``doc_id / block_docs``, rounded down."""
    return f"if(doc_id < 0, (doc_id + 1) div {block_docs} - 1, doc_id div {block_docs})"


def blocked_index(index: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(tok, block_no, n_docs, gaps, tfs)``: posting lists cut at every ``block_docs`` document ids.

    A row holds at most ``block_docs`` postings, also of a term that is in every
    document, so the stop list may come from anywhere.  ``gaps`` are the distances from one
    document to the next, from the block's start on: small numbers, which Parquet packs
    into few bits.  Ids have to be integers; the denser, the longer the lists.  An index
    that has a ``block_no``, by the same ``block_docs``, is not shuffled again.
    """
    block_no = F.col("block_no") if "block_no" in index.columns else F.expr(_block_no(block_docs)).alias("block_no")
    lists = index.groupBy("tok", block_no).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("list")
    )
    start = F.col("block_no") * block_docs
    gaps = F.transform("list", lambda p, i: (p["doc_id"] - F.when(i == 0, start).otherwise(F.get("list", i - 1)["doc_id"])).cast("int"))
    return lists.select("tok", "block_no", F.size("list").alias("n_docs"), gaps.alias("gaps"), F.col("list.tf").alias("tfs"))


def unblocked_index(blocked: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """:func:`blocked_index` back to ``(tok, doc_id, tf)``; blocks decode one by one."""
    entries = blocked.select("tok", "block_no", F.posexplode(F.arrays_zip("gaps", "tfs")).alias("pos", "entry"))
    so_far = Window.partitionBy("tok", "block_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    doc_id = F.col("block_no") * block_docs + F.sum("entry.gaps").over(so_far)
    return entries.select("tok", doc_id.alias("doc_id"), F.col("entry.tfs").alias("tf"))


# The forms below hold all postings of a term in one row.  With a stop list from the
# same corpus a term that is left has at most ``min_count`` occurrences, which bounds
# the row; for any other list use the flat form or blocks.


def _postings(index: DataFrame, *fields: str) -> DataFrame:
    return index.groupBy("tok").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("list"))


def nested_index(index: DataFrame) -> DataFrame:
    """``(tok, postings)`` with a map from document to frequency, in document order."""
    return _postings(index, "doc_id", "tf").select("tok", F.map_from_entries("list").alias("postings"))


def rendered_index(index: DataFrame, n_docs: str | None = None) -> DataFrame:
    """``(tok, postings)`` with postings as ``doc#tf, doc#tf`` in document order.

    With ``n_docs`` the number of documents follows under that name.
    """
    entry = F.concat_ws("#", F.col("doc_id").cast("string"), F.col("tf").cast("string"))
    count = [F.size("list").alias(n_docs)] if n_docs else []
    lists = _postings(index.select("tok", "doc_id", entry.alias("entry")), "doc_id", "entry")
    return lists.select("tok", F.array_join("list.entry", ", ").alias("postings"), *count)


def boolean_index(index: DataFrame) -> DataFrame:
    """``(tok, docs)`` with the sorted documents of each term."""
    return index.groupBy("tok").agg(F.sort_array(F.collect_list("doc_id")).alias("docs"))


def rendered_boolean_index(index: DataFrame) -> DataFrame:
    """``(tok, docs)`` with the documents as ``doc, doc``."""
    docs = F.col("docs").cast("array<string>")
    return boolean_index(index).select("tok", F.array_join(docs, ", ").alias("docs"))
