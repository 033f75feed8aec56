import itertools
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wordweave.functions.threshold import Threshold, unordered_pairs
from wordweave.operators import similarity as sim
from wordweave.operators.terms import metric
from wordweave.plans import similarity_jobs as jobs

THRESHOLDS = [Threshold(n, d, i) for n, d in ((1, 2), (4, 5), (2, 3), (1, 1), (1, 10)) for i in (True, False)]


def brute_force(sets, threshold):
    """Every pair of ``{key: set}``, compared with exact fractions."""
    limit = Fraction(threshold.num, threshold.den)
    found = {}
    for (k1, s1), (k2, s2) in itertools.combinations(sorted(sets.items()), 2):
        score = Fraction(len(s1 & s2), len(s1 | s2))
        if score > limit or (threshold.inclusive and score == limit):
            found[k1, k2] = float(score)
    return found


def id_sets(spark, sets):
    rows = [(key, sorted(ids)) for key, ids in sets.items()]
    return spark.createDataFrame(rows, "key bigint, ids array<bigint>")


def found_pairs(spark, sets, threshold, block=4096, copies=256, hot_copies=100_000):
    lines = id_sets(spark, sets)
    distinct = sim.distinct_sets(lines).cache()
    similar = sim.similar_sets(distinct, threshold, block=block)
    groups = sim.similar_groups(similar, distinct, threshold)
    members = sim.set_members(lines, distinct, hot_copies)
    rows = sim.line_pairs(groups, members, copies).collect()
    pairs = {(r.lo, r.hi): r.similarity for r in rows}
    assert len(pairs) == len(rows), "a pair appears twice"
    assert all(lo < hi for lo, hi in pairs)
    return pairs


def random_sets(seed, n_sets=150, n_words=40):
    """Sets of skewed words with copies, near copies and one text that is a third of all."""
    rng = random.Random(seed)
    sets = {}
    for key in range(n_sets):
        kind = rng.random()
        if kind < 0.33 and sets:
            sets[key] = sets[0]
        elif kind < 0.6 and sets:
            base = set(rng.choice(list(sets.values())))
            base ^= {rng.randrange(n_words)}
            sets[key] = frozenset(base or {0})
        else:
            size = rng.choice((1, 2, 3, 5, 8, 20))
            sets[key] = frozenset(int(n_words * rng.random() ** 2) for _ in range(size))
    return sets


@pytest.mark.parametrize("threshold", THRESHOLDS, ids=str)
def test_equals_brute_force(spark, threshold):
    sets = random_sets(1)
    assert found_pairs(spark, sets, threshold) == brute_force(sets, threshold)


def test_fine_thresholds_do_not_overflow(spark):
    sets = random_sets(8, n_sets=60)
    for threshold in (Threshold(799_999_999, 1_000_000_000), Threshold(800_000_000, 1_000_000_000, False)):
        assert found_pairs(spark, sets, threshold) == brute_force(sets, threshold)


@pytest.mark.parametrize("seed", [2, 3, 4])
def test_hot_words_and_hot_texts_in_small_blocks(spark, seed):
    sets = random_sets(seed)
    for threshold in (Threshold(1, 2, False), Threshold(4, 5)):
        found = found_pairs(spark, sets, threshold, block=3, copies=4, hot_copies=5)
        assert found == brute_force(sets, threshold)


def test_words_beyond_the_split_limit_are_joined_whole(spark, monkeypatch):
    monkeypatch.setattr(sim, "MAX_HOT_WORDS", 2)
    sets = random_sets(9)
    threshold = Threshold(1, 2)
    assert found_pairs(spark, sets, threshold, block=3) == brute_force(sets, threshold)


def test_long_sets(spark):
    rng = random.Random(5)
    base = [frozenset(rng.sample(range(5000), 700)) for _ in range(3)]
    sets = {}
    for key in range(24):
        drop = set(rng.sample(sorted(base[key % 3]), rng.randrange(0, 260)))
        sets[key] = base[key % 3] - drop
    for threshold in (Threshold(1, 2, False), Threshold(4, 5)):
        assert found_pairs(spark, sets, threshold) == brute_force(sets, threshold)


@pytest.mark.parametrize(
    ("a", "b", "passes"),
    [
        ("a b c d", "a b c d e", {"4/5": (True, False), "1/2": (True, True)}),
        ("a b", "a b c d", {"4/5": (False, False), "1/2": (True, False)}),
        ("a b", "a b", {"4/5": (True, True), "1/2": (True, True)}),
        ("a b", "c d", {"4/5": (False, False), "1/2": (False, False)}),
    ],
)
def test_comparators(spark, a, b, passes):
    sets = {1: frozenset(map(ord, a.split())), 2: frozenset(map(ord, b.split()))}
    for limit, (inclusive, strict) in passes.items():
        num, den = (int(x) for x in limit.split("/"))
        assert len(found_pairs(spark, sets, Threshold(num, den, True))) == inclusive
        assert len(found_pairs(spark, sets, Threshold(num, den, False))) == strict


def test_pairs_with_texts(documents):
    docs = documents("D c b a\nx", "a b c d e\nx")
    rows = jobs.similar_lines_with_texts(docs, Threshold(4, 5)).orderBy("lo").collect()
    assert [tuple(r) for r in rows] == [
        (1_000_000, 2_000_000, 0.8, "a b c d", "e a b c d"),
        (1_000_001, 2_000_001, 1.0, "x", "x"),
    ]


def test_texts_follow_their_keys(documents):
    # The set of the last line has the smaller id through the first line, so keys swap sides.
    docs = documents("a b c d", "a b c d e", "a b c d")
    rows = jobs.similar_lines_with_texts(docs, Threshold(4, 5)).orderBy("lo", "hi").collect()
    assert [(r.lo // 1_000_000, r.hi // 1_000_000, r.text_lo, r.text_hi) for r in rows] == [
        (1, 2, "a b c d", "e a b c d"),
        (1, 3, "a b c d", "a b c d"),
        (2, 3, "e a b c d", "a b c d"),
    ]


def test_groups_account_for_every_pair(spark):
    sets = random_sets(6)
    distinct = sim.distinct_sets(id_sets(spark, sets)).cache()
    threshold = Threshold(4, 5)
    groups = sim.similar_groups(sim.similar_sets(distinct, threshold), distinct, threshold).collect()
    total = sum(g.n_lo * (g.n_lo - 1) // 2 if g.set_lo == g.set_hi else g.n_lo * g.n_hi for g in groups)
    assert total == len(brute_force(sets, threshold))


def test_results_do_not_depend_on_partitions(spark, documents):
    docs = documents("a b c d\na b c\nb c d", "a b c d e\nx y", "x y\nx y z\na b c d")
    threshold = Threshold(1, 2, False)
    results = []
    for n in (1, 3, 8):
        rows = jobs.similar_lines(docs.repartition(n), threshold).collect()
        results.append(sorted(tuple(r) for r in rows))
    assert results[0] == results[1] == results[2]


def test_score_pairs(spark):
    sets = spark.createDataFrame([(1, [1, 2]), (2, [2, 3]), (3, [9])], "set_id bigint, ids array<bigint>")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (1, 7)], "a bigint, b bigint")
    scored = sim.score_pairs(pairs, sets, "a", "b")
    assert sorted((r.a, r.b, r.inter, r.uni) for r in scored.collect()) == [(1, 2, 1, 3), (2, 3, 0, 3)]


def test_prefix_comparisons(spark):
    # Prefixes at 1/2: lines 1 and 2 give {1, 2}, line 3 gives {1}: 3 + 1 comparisons.
    sets = {1: {1, 2, 8}, 2: {1, 2, 9}, 3: {1}}
    distinct = sim.distinct_sets(id_sets(spark, sets))
    assert sim.prefix_comparisons(distinct, Threshold(1, 2)).first().value == 4


def test_prefix_comparisons_count_copies(spark):
    distinct = sim.distinct_sets(id_sets(spark, {1: {1, 2}, 2: {1, 2}, 3: {1, 2}}))
    assert sim.prefix_comparisons(distinct, Threshold(1, 2)).first().value == 6


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5000, 10**12, 10**12 + 1])
def test_number_of_pairs(spark, n):
    assert spark.range(1).select(unordered_pairs(f"{n}L")).first()[0] == n * (n - 1) // 2


def test_threshold_range():
    for num, den in ((0, 2), (3, 2), (-1, 2)):
        with pytest.raises(ValueError):
            Threshold(num, den)


def test_candidate_plan(spark):
    """Postings meet in a merge join on the word, and no nested loops appear."""
    distinct = sim.distinct_sets(id_sets(spark, random_sets(7)))
    pairs = sim.candidate_pairs(distinct, Threshold(4, 5), max_postings=10)
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [word_id" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_words_are_found(spark):
    probe = spark.createDataFrame([(1,)] * 7 + [(2,)] * 3, "word_id bigint")
    assert [tuple(r) for r in sim.hot_prefix_words(probe, 3).collect()] == [(1, 3)]


def test_metric_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "c bigint")
    assert metric("m", empty, F.sum("c")).first().value == 0
