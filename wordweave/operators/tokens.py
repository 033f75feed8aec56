"""Token streams and keyed lines from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.functions.text import line_key, stripped, text_lines, unstripped_words, words
from wordweave.shared import hottest_words, split_words


def tokens(documents: DataFrame, mode: str) -> DataFrame:
    """``(doc_id, text)`` or ``(doc_id, line)`` to ``(doc_id, tok)``, one row per occurrence."""
    text = "text" if "text" in documents.columns else "line"
    exploded = documents.select("doc_id", F.explode(unstripped_words(text, mode)).alias("tok"))
    return exploded.withColumn("tok", stripped("tok", mode)).where(F.col("tok") != "")


def lines(documents: DataFrame, *further: str) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, line_no, line)`` and further columns; line numbers start at 0."""
    return documents.select(*further, "doc_id", F.posexplode(text_lines("text")).alias("line_no", "line"))


def keyed_lines(documents: DataFrame, lines_per_document: int = 1_000_000) -> DataFrame:
    """Lines as ``(key, line)``.

    An integer ``doc_id`` gives a packed bigint key; any other gives the struct
    ``(doc_id, line_no)``.  Both sort by document, then line.  Lines that come with a
    ``key`` keep it.
    """
    if {"key", "line"} <= set(documents.columns):
        return documents.select("key", "line")
    numbered = lines(documents)
    if numbered.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        key = line_key(F.col("doc_id"), F.col("line_no"), lines_per_document)
    else:
        key = F.struct("doc_id", "line_no")
    return numbered.select(key.alias("key"), "line")


def line_words(keyed: DataFrame) -> DataFrame:
    """Distinct words of each line as ``(key, tok)``."""
    distinct = F.array_distinct(words("line", "alnum"))
    return keyed.select("key", F.explode(distinct).alias("tok")).where(F.col("tok") != "")


def without_hottest(stream: DataFrame, word_list: DataFrame) -> DataFrame:
    """Drop the most frequent words of the list by a bounded broadcast.

    Their rows would otherwise meet in one task of a later shuffle on ``tok``.
    """
    return stream.join(F.broadcast(hottest_words(word_list)), "tok", "left_anti")


def without_words(stream: DataFrame, word_list: DataFrame) -> DataFrame:
    """Drop the rows of a ``tok`` stream whose word is in a ``(tok, n)`` list.

    The list's hottest words go by a bounded broadcast and the rest, if there is any, by
    an anti-join that no hot word reaches any more.
    """
    hot, rest = split_words(word_list)
    left = stream.join(F.broadcast(hot), "tok", "left_anti")
    return left if rest is None else left.join(rest, "tok", "left_anti")
