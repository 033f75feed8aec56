import pytest

from wordweave.functions.threshold import Threshold
from wordweave.operators import line_sets as ls
from wordweave.operators.terms import word_count
from wordweave.operators.tokens import tokens
from wordweave.plans import similarity_jobs as jobs

BASE = 1_000_000


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_line_sets(documents):
    docs = documents("b a a\nb c\n!!\nc b", first_id=0)
    assert as_dict(jobs.line_sets(docs, 10)) == {0: ["a", "b"], 1: ["c", "b"], 3: ["c", "b"]}
    lines = jobs.non_empty_lines(docs, 10)
    assert [tuple(r) for r in ls.line_count(lines).collect()] == [("lines", 3)]
    assert [tuple(r) for r in ls.naive_comparisons(lines).collect()] == [("comparisons", 3)]
    collapsed = jobs.collapsed_line_sets(docs, 10)
    assert sorted((r.set_id, r.n_lines) for r in collapsed.sets.collect()) == [(0, 1), (1, 2)]
    assert sorted((r.set_id, r.key) for r in collapsed.members.collect()) == [(1, 1), (1, 3)]


def test_words_at_the_cap_are_dropped(documents):
    docs = documents("x x y y y z z z z")
    assert list(as_dict(jobs.line_sets(docs, 3)).values()) == [["x"]]


def test_a_line_of_frequent_words_only_is_no_line(documents):
    docs = documents("x x\nx y")
    assert as_dict(jobs.line_sets(docs, 3)) == {BASE + 1: ["y"]}


def test_order_is_one_total_order(documents):
    docs = documents("z y x\nx z y\ny")
    xzy = ["x", "z", "y"]
    assert as_dict(jobs.line_sets(docs, 10)) == {BASE: xzy, BASE + 1: xzy, BASE + 2: ["y"]}


def test_word_ids_follow_count_then_word(documents):
    counts = word_count(tokens(documents("d c c b b a a a"), "alnum"))
    by_id = ls.vocabulary(counts).orderBy("word_id").collect()
    assert [(r.tok, r.n) for r in by_id] == [("d", 1), ("b", 2), ("c", 2), ("a", 3)]
    assert len({r.word_id for r in by_id}) == 4


def test_first_lines(documents):
    docs = documents("a\nb\nc", "d")
    first = ls.rendered_line_sets(ls.first_lines(jobs.line_sets(docs, 10), 2))
    assert as_dict(first) == {BASE: "a", BASE + 1: "b"}


def test_prefix_postings(documents):
    docs = documents("a b c d\na b c\na b\na")
    sets = jobs.line_sets(docs, 10)
    found = sorted((r.key - BASE, r.tok) for r in ls.prefix_postings(sets, Threshold(1, 2)).collect())
    assert found == [(0, "b"), (0, "c"), (0, "d"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (3, "a")]


@pytest.mark.parametrize(
    ("num", "den", "expected"),
    [
        (1, 2, {1: 1, 2: 2, 3: 2, 4: 3, 5: 3, 10: 6}),
        (4, 5, {1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 10: 3}),
        (7, 100, {100: 94}),
    ],
)
def test_prefix_length_in_integers(spark, num, den, expected):
    sizes = spark.createDataFrame([(n,) for n in expected], "n bigint")
    found = sizes.select("n", Threshold(num, den).prefix_length("n"))
    assert as_dict(found) == expected


def test_adjacent_lines_end_with_their_document(documents):
    from wordweave.plans import similarity_jobs

    docs = documents("\n" * 999_999 + "a b", "a b\nb c")
    scored = similarity_jobs.adjacent_line_scores(docs, 100).select("lo", "hi").collect()
    assert [tuple(r) for r in scored] == [(2_000_000, 2_000_001)]
