import pytest
from pyspark.sql import functions as F

from wordweave import shared
from wordweave.operators import inverted_index as idx
from wordweave.operators import terms
from wordweave.operators.tokens import tokens
from wordweave.plans import index_jobs


@pytest.fixture
def corpus(documents):
    return documents("the cat sat. cat", "cat dog")


@pytest.fixture
def the(spark):
    return spark.createDataFrame([("the", 1)], "tok string, n bigint")


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_word_count(documents):
    assert as_dict(index_jobs.word_counts(documents("b a a", "B"))) == {"a": 2, "b": 2}


def test_stop_words_need_more_than_the_threshold(documents):
    docs = documents("x y z x y z y z z")
    assert as_dict(index_jobs.stop_words(docs, 3)) == {"z": 4}


def test_stop_words_are_thresholded_after_the_full_sum(documents):
    docs = documents(*["w"] * 40).repartition(8)
    assert as_dict(index_jobs.stop_words(docs, 39)) == {"w": 40}


@pytest.mark.parametrize("broadcast_words", [0, 100])
def test_index_forms(corpus, the, monkeypatch, broadcast_words):
    monkeypatch.setattr(shared, "MAX_BROADCAST_WORDS", broadcast_words)
    index = idx.inverted_index(tokens(corpus, "delim"), the)
    assert sorted(tuple(r) for r in index.collect()) == [("cat", 1, 2), ("cat", 2, 1), ("dog", 2, 1), ("sat", 1, 1)]
    assert as_dict(idx.rendered_index(index)) == {"cat": "1#2, 2#1", "dog": "2#1", "sat": "1#1"}
    assert as_dict(idx.nested_index(index)) == {"cat": {1: 2, 2: 1}, "dog": {2: 1}, "sat": {1: 1}}
    assert as_dict(idx.boolean_index(index)) == {"cat": [1, 2], "dog": [2], "sat": [1]}
    assert as_dict(idx.rendered_boolean_index(index)) == {"cat": "1, 2", "dog": "2", "sat": "1"}


def test_postings_sort_by_number(documents, spark):
    none = spark.createDataFrame([], "tok string, n bigint")
    docs = documents("a", "a", first_id=9)
    index = idx.inverted_index(tokens(docs, "delim"), none)
    assert as_dict(idx.rendered_index(index)) == {"a": "9#1, 10#1"}


def test_term_metrics(documents):
    docs = documents("the the the cat sat. cat", "cat dog the")
    statistics = index_jobs.term_statistics(docs, 3)
    assert [tuple(r) for r in terms.distinct_term_count(statistics).collect()] == [("distinct_terms", 3)]
    assert [tuple(r) for r in terms.single_document_terms(statistics).collect()] == [("single_document_terms", 2)]


def test_metrics_of_an_empty_corpus_are_zero(documents, spark):
    statistics = index_jobs.term_statistics(documents(""), 3)
    assert terms.distinct_term_count(statistics).first().value == 0
    assert terms.single_document_terms(statistics).first().value == 0


def test_frequencies_add_up_to_the_tokens_kept(documents):
    docs = documents("a b c a a", "a b d", "e e f. a")
    index = index_jobs.inverted_index(docs, 4)
    kept = index_jobs.tokens_per_document(docs, 4)
    assert index.agg(F.sum("tf")).first()[0] == kept.agg(F.sum("n_tokens")).first()[0] == 7
    assert as_dict(kept) == {1: 2, 2: 2, 3: 3}


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line]


def test_documents_partitioned_by_id_are_not_shuffled_again(documents):
    docs = documents("a b c a a", "a b d")
    frequencies = idx.term_frequencies(tokens(docs.repartition(4, "doc_id"), "delim"))
    assert len(exchanges(frequencies)) == 1
    assert "hashpartitioning(doc_id" in exchanges(frequencies)[0]
    assert len(exchanges(idx.term_frequencies(tokens(docs, "delim")))) == 1


def test_counts_and_blocks_share_a_shuffle(documents, the):
    docs = documents("the a b a", "b c", "a the", "c a c b", first_id=-2)
    words = tokens(docs, "delim")
    found = idx.blocked_index(idx.inverted_index(words, the, 2), 2)
    expected = idx.blocked_index(idx.inverted_index(words, the), 2)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    plan = idx.blocked_index(idx.inverted_index(words, the, 2), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
