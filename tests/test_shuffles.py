"""Steps that move rows once."""

from wordweave.functions.threshold import Threshold
from wordweave.operators import inverted_index as idx
from wordweave.operators import line_sets as ls
from wordweave.operators import similarity as sim
from wordweave.operators.terms import word_count
from wordweave.operators.tokens import keyed_lines, line_words, tokens
from wordweave.plans import index_jobs, similarity_jobs
from wordweave.shared import plain_scan, save_bucketed
from wordweave.sinks import corpus as corpus_sink
from wordweave.sinks import write_packed_documents
from wordweave.sources import packed_documents


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark):
    return spark.range(60).selectExpr("id as doc_id", "concat('w', id, ' a', id div 2, ' b', id div 2, ' c', id div 2, ' all\nx y z ', id % 3) as text")


def test_numbers_of_lines_come_with_the_scores(spark):
    lines = similarity_jobs.collapsed_line_sets(corpus(spark), 10**6)
    half = Threshold(1, 2, inclusive=False)
    groups = similarity_jobs.similar_groups(lines, half)
    # One join of postings and two look-ups by id.
    assert sum(plan(groups).count(f"{kind}Join [") for kind in ("SortMerge", "BroadcastHash", "ShuffledHash")) == 3
    found = {(r.set_lo, r.set_hi): (r.n_lo, r.n_hi) for r in groups.collect()}
    assert found[0, 1_000_000] == (1, 1)
    assert sorted(v for k, v in found.items() if k[0] == k[1]) == [(20, 20)] * 3
    assert sum(k[0] != k[1] and v == (20, 20) for k, v in found.items()) == 3


def test_words_of_lines_are_not_sorted_for_their_ids(spark):
    docs = corpus(spark)
    rare = ls.rare_line_words(line_words(keyed_lines(docs)), ls.vocabulary(word_count(tokens(docs, "alnum"))), 10**6)
    assert "ShuffledHashJoin [tok" in plan(rare)


def test_lists_of_words_begin_behind_the_shuffle(spark):
    words = spark.range(100).selectExpr("id div 4 as key", "id as word_id", "string(id) as tok")
    for sets in (ls.line_id_sets(words), ls.line_sets(words)):
        deepest = plan(sets).split("Exchange")[-1]
        assert "Aggregate" not in deepest and plan(sets).count("Exchange hash") == 1


def test_a_bucketed_table_is_scanned_without_buckets(spark):
    bucketed = save_bucketed(spark.range(1000).selectExpr("id as set_id", "id % 7 as n"), "plain", "set_id")
    scan = plain_scan(bucketed)
    assert "Bucketed: true" not in plan(scan)
    assert sorted(scan.collect()) == sorted(bucketed.collect())


def test_an_index_by_term_moves_once(spark):
    docs = corpus(spark)
    index = index_jobs.inverted_index(docs, 50)
    assert plan(idx.rendered_index(index)).count("Exchange hashpartitioning(tok") == 1
    assert plan(idx.rendered_index(index)).count("Exchange hashpartitioning") == 1
    expected = {(t, d): n for (t, d, n) in idx.term_frequencies(tokens(docs, "delim")).collect() if t not in ("all", "x", "y", "z")}
    assert {(r.tok, r.doc_id): r.tf for r in index.collect()} == expected


def test_whole_texts_are_packed(spark, tmp_path, monkeypatch):
    plans = []
    original = corpus_sink.lines
    monkeypatch.setattr(corpus_sink, "lines", lambda rows, *further: plans.append(plan(rows)) or original(rows, *further))
    docs = spark.createDataFrame([(1, "a\nb"), (1, "c"), (2, None), (3, ""), (None, "x"), (4, "\n\n")], "doc_id long, text string")
    write_packed_documents(docs, str(tmp_path / "packed"), 3)
    assert len(plans) == 1 and "Exchange" in plans[0]
    read = sorted((r.doc_id, r.line) for r in packed_documents(spark, str(tmp_path / "packed")).collect())
    assert read == sorted((r.doc_id, r.line) for r in original(docs.where("doc_id is not null")).collect())
