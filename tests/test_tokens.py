import random
import re

import pytest

from wordweave.functions.text import BLANKS, DELIMITERS, words
from wordweave.operators.tokens import keyed_lines, line_words, lines, tokens, without_words
from wordweave import shared


@pytest.mark.parametrize(
    ("text", "delim", "alnum"),
    [
        ('He\'s first-born; "O,\tyes"', ["he", "s", "first", "born", "o", "yes"], ["he", "s", "first", "born", "o", "yes"]),
        ("a\tb", ["a\tb"], ["a", "b"]),
        ("Café 3#4", ["café", "3#4"], ["caf", "3", "4"]),
        (". \t .", [], []),
        ("", [], []),
        ("\tone\ntwo\r\nthree\t", ["one", "two", "three"], ["one", "two", "three"]),
        ("x\x01 \x02 \x03y", ["x", "y"], ["x", "y"]),
        (" .,?!\"'()[]$*-_;:|", [], []),
        ("a.b,c?d!e\"f'g(h)i[j]k$l*m-n_o;p:q|r s", list("abcdefghijklmnopqrs"), list("abcdefghijklmnopqrs")),
    ],
)
def test_tokenizers(documents, text, delim, alnum):
    docs = documents(text)
    assert [r.tok for r in tokens(docs, "delim").collect()] == delim
    assert [r.tok for r in tokens(docs, "alnum").collect()] == alnum


def test_null_text_has_no_tokens_and_no_lines(documents):
    docs = documents(None, "x")
    assert [tuple(r) for r in tokens(docs, "alnum").collect()] == [(2, "x")]
    assert [tuple(r) for r in lines(docs).collect()] == [(2, 0, "x")]


def test_unknown_tokenizer_is_refused():
    with pytest.raises(ValueError):
        words("text", "other")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a\nb\r\nc\rd", ["a", "b", "c", "d"]),
        ("a\n\nb", ["a", "", "b"]),
        ("a\n", ["a"]),
        ("a\r\n", ["a"]),
        ("\n", [""]),
        ("", []),
    ],
)
def test_lines(documents, text, expected):
    found = lines(documents(text)).orderBy("line_no").collect()
    assert [r.line for r in found] == expected
    assert [r.line_no for r in found] == list(range(len(expected)))


def test_keys_are_unique_across_documents(documents):
    keys = [r.key for r in keyed_lines(documents("a\nb", "c\nd")).collect()]
    assert sorted(keys) == [1_000_000, 1_000_001, 2_000_000, 2_000_001]


def test_a_document_beyond_its_key_range_fails_and_is_not_cut(documents):
    with pytest.raises(Exception, match="more lines than its key range"):
        keyed_lines(documents("a\nb\nc"), lines_per_document=2).collect()


def test_line_words_are_distinct(documents):
    found = line_words(keyed_lines(documents("B a a\n!!\nb"))).collect()
    assert sorted(tuple(r) for r in found) == [(1_000_000, "a"), (1_000_000, "b"), (1_000_002, "b")]


@pytest.mark.parametrize("broadcast_words", [0, 1, 100])
def test_word_lists_of_any_length_are_dropped_whole(spark, documents, monkeypatch, broadcast_words):
    monkeypatch.setattr(shared, "MAX_BROADCAST_WORDS", broadcast_words)
    docs = documents("a a b c", "b d", "e")
    listed = spark.createDataFrame([("a", 9), ("b", 5), ("e", 1)], "tok string, n bigint")
    kept = without_words(tokens(docs, "delim"), listed)
    assert sorted((r.doc_id, r.tok) for r in kept.collect()) == [(1, "c"), (2, "d")]


def test_long_words_are_dropped_too(spark, documents):
    long_word = "x" * 500
    listed = spark.createDataFrame([(long_word, 9)], "tok string, n bigint")
    kept = without_words(tokens(documents(f"{long_word} y"), "delim"), listed)
    assert [r.tok for r in kept.collect()] == ["y"]


def plain_tokens(text, mode):
    """Split on every separator, strip each piece, drop the empty ones."""
    if mode == "alnum":
        pieces = re.split("[^a-z0-9]", text.lower())
    else:
        pieces = re.split("[" + re.escape(DELIMITERS + "\r\n") + "]", text.lower())
    return [piece.strip(BLANKS) for piece in pieces if piece.strip(BLANKS)]


def test_tokenizers_on_random_texts(documents):
    rng = random.Random(11)
    alphabet = DELIMITERS + "\r\n\t\x00\x01\x1fabzAZ09éÉßñ#@/\\\u2028\u00a0漢"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(400)]
    docs = documents(*texts)
    for mode in ("delim", "alnum"):
        found = {}
        for row in tokens(docs, mode).collect():
            found.setdefault(row.doc_id, []).append(row.tok)
        for doc_id, text in enumerate(texts, 1):
            assert found.get(doc_id, []) == plain_tokens(text, mode), (mode, text)


def test_lines_of_random_texts(documents):
    rng = random.Random(12)
    texts = ["".join(rng.choices("ab\r\n\u2028", k=rng.randrange(12))) for _ in range(300)]
    found = {}
    for row in lines(documents(*texts)).orderBy("doc_id", "line_no").collect():
        found.setdefault(row.doc_id, []).append(row.line)
    for doc_id, text in enumerate(texts, 1):
        expected = re.split("\r\n|\r|\n", text)
        if expected[-1] == "":
            expected.pop()
        assert found.get(doc_id, []) == expected, text


def test_long_runs_of_blanks_take_linear_time(spark):
    text = "a" + "\t" * 1_000_000 + "b"
    rows = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert tokens(rows, "delim").count() == 1
