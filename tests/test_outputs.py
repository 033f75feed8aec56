"""Replacing outputs, side metrics, text files, blocks, buckets, the grid of all pairs and first lines."""

import random

import pytest
from pyspark.sql import functions as F

from wordweave import shared
from wordweave.functions.threshold import Threshold
from wordweave.operators import all_pairs
from wordweave.operators import inverted_index as idx
from wordweave.operators import line_sets as ls
from wordweave.operators import similarity as sim
from wordweave.operators.tokens import lines, tokens
from wordweave.plans import index_jobs
from wordweave.plans import similarity_jobs as jobs
from wordweave.sinks import replacing, write_delimited, write_index, write_line_sets, write_packed_documents, write_text_folders
from wordweave.sources import packed_documents, text_lines_by_folder, word_counts

TEXTS = ("the cat sat. cat\nthe dog", "cat dog\r\nbird\rthe end\n", "", "\n", "a\n\nb ")


def written(path):
    return sorted(line for part in path.glob("part-*") for line in part.read_text().splitlines())


# K2: outputs are replaced


def test_a_job_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "counts")
    write_delimited(spark.createDataFrame([("a", 1), ("b", 2)], "tok string, n bigint"), path)
    for _ in range(3):
        write_delimited(word_counts(spark, path).select("tok", (F.col("n") * 2).alias("n")), path)
    assert written(tmp_path / "counts") == ["a, 8", "b, 16"]
    assert [p.name for p in tmp_path.iterdir()] == ["counts"]


def test_a_job_that_fails_leaves_the_old_output(spark, tmp_path):
    path = str(tmp_path / "counts")
    write_delimited(spark.createDataFrame([("a", 1)], "tok string, n bigint"), path)
    # Some tasks have written their rows when one fails.
    rows = spark.range(0, 100, 1, 10).select(F.when(F.col("id") == 95, F.raise_error(F.lit("halfway"))).otherwise(F.col("id").cast("string")).alias("tok"))
    with pytest.raises(Exception, match="halfway"):
        write_delimited(rows, path)
    assert written(tmp_path / "counts") == ["a, 1"]
    assert [p.name for p in tmp_path.iterdir()] == ["counts"]


def test_a_block_that_writes_nothing_replaces_nothing(spark, tmp_path):
    path = str(tmp_path / "counts")
    write_delimited(spark.createDataFrame([("a",)], "tok string"), path)
    with pytest.raises(FileNotFoundError), replacing(spark, path):
        pass
    assert written(tmp_path / "counts") == ["a"]
    write_delimited(spark.createDataFrame([("b",)], "tok string"), str(tmp_path / "new" / "folder"))
    assert written(tmp_path / "new" / "folder") == ["b"]


# K6: metrics of a running job


def test_the_pass_that_writes_takes_the_metrics(spark, documents, tmp_path):
    docs = documents("the cat sat. cat", "cat dog", "cat")
    index = shared.save(index_jobs.inverted_index(docs, 9), "index")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("metrics", "")
    try:
        found = write_index(index, str(tmp_path / "index"))
        with_metrics = len(tracker.getJobIdsForGroup("metrics"))
        spark.sparkContext.setJobGroup("plain", "")
        write_delimited(idx.rendered_index(index), str(tmp_path / "plain"), " : ")
        assert with_metrics == len(tracker.getJobIdsForGroup("plain")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"distinct_terms": 4, "single_document_terms": 3, "postings": 6}
    assert written(tmp_path / "index") == written(tmp_path / "plain")


def test_line_set_metrics(spark, documents, tmp_path):
    sets = jobs.line_sets(documents("b a a\nb c\n!!\nc b"), 10)
    assert write_line_sets(sets, str(tmp_path / "sets")) == {"lines": 3, "words": 6}
    assert written(tmp_path / "sets") == ["1000000,a b", "1000001,c b", "1000003,c b"]
    nothing = sets.where("false")
    assert write_line_sets(nothing, str(tmp_path / "sets")) == {"lines": 0, "words": 0}
    assert written(tmp_path / "sets") == []


# S1, S2: text files


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("file_chars", [1 << 30, 400])
def test_documents_come_back_from_split_text_files(spark, tmp_path, small_splits, file_chars):
    rng = random.Random(1)
    texts = [*TEXTS, None, *["\n".join("x" * rng.randint(0, 30) + str(i) for i in range(rng.randint(1, 40))) for _ in range(30)]]
    docs = spark.createDataFrame(list(enumerate(texts, -3)), "doc_id bigint, text string")
    path = str(tmp_path / "corpus")
    write_packed_documents(docs, path, file_chars)
    read = packed_documents(spark, path)
    assert spark.read.text(f"{path}/lines").rdd.getNumPartitions() > 20
    expected = [(r["doc_id"], r["line_no"], r["doc_id"] * 1_000_000 + r["line_no"], r["line"]) for r in lines(docs).collect()]
    assert sorted(map(tuple, read.collect())) == sorted(expected)


def test_a_folder_is_a_document_of_many_files(spark, tmp_path, small_splits):
    rows = [("x/1", t) for t in TEXTS] + [(None, "cat"), ("007", "dog dog")]
    docs = spark.createDataFrame(rows, "source string, text string").repartition(5)
    path = str(tmp_path / "sources")
    write_text_folders(docs, path, "source")
    read = text_lines_by_folder(spark, path, "source")
    index = index_jobs.inverted_index(read, 99)
    by_source = docs.withColumnRenamed("source", "doc_id")
    assert sorted(map(str, index.collect())) == sorted(map(str, index_jobs.inverted_index(by_source, 99).collect()))
    assert {r["doc_id"] for r in index.collect()} == {"x/1", None, "007"}


# K4, G4: blocked postings


@pytest.mark.parametrize("block_docs", [1, 3, 4096])
def test_blocks_hold_the_index(spark, block_docs):
    rng = random.Random(block_docs)
    rows = {(rng.choice("abc"), rng.randint(-20, 20)): rng.randint(1, 9) for _ in range(80)}
    index = spark.createDataFrame([(t, d, n) for (t, d), n in rows.items()], "tok string, doc_id bigint, tf bigint")
    blocked = idx.blocked_index(index, block_docs)
    for row in blocked.collect():
        assert 0 < row["n_docs"] <= block_docs and len(row["gaps"]) == len(row["tfs"]) == row["n_docs"]
        assert min(row["gaps"]) >= 0 and sum(row["gaps"]) < block_docs
    assert sorted(map(tuple, idx.unblocked_index(blocked, block_docs).collect())) == sorted((t, d, n) for (t, d), n in rows.items())


def test_a_stop_list_that_misses_a_hot_term(documents, spark):
    docs = documents("hot the cat", "hot dog", "hot the")
    listed = spark.createDataFrame([("the", 0)], "tok string, n bigint")
    blocked = idx.blocked_index(idx.inverted_index(tokens(docs, "delim"), listed), 2)
    assert sorted((r["tok"], r["block_no"], r["gaps"]) for r in blocked.where("tok in ('hot', 'the')").collect()) == [
        ("hot", 0, [1]),
        ("hot", 1, [0, 1]),
    ]


# S7, S8: sets in buckets


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def exchanges_above(plan, table):
    """Exchanges between a scan of ``table`` and the join it goes into, by indentation."""
    found = []
    rows = plan.split("\n")
    for i, row in enumerate(rows):
        if "FileScan" in row and table in row:
            depth = len(row) - len(row.lstrip(" :+-"))
            for above in reversed(rows[:i]):
                level = len(above) - len(above.lstrip(" :+-"))
                if level < depth:
                    depth = level
                    if "Join" in above:
                        break
                    found.append("Exchange" in above)
    return found


def test_sets_in_buckets_are_not_shuffled(spark, no_broadcast):
    rows = [(i, sorted({i % 7, i % 5 + 10, i % 3 + 20, 30})) for i in range(60)]
    plain = spark.createDataFrame(rows, "set_id bigint, ids array<bigint>")
    pairs = spark.createDataFrame([(i, i + 3) for i in range(0, 50, 2)], "lo bigint, hi bigint")
    bucketed = shared.save_bucketed(plain, "sets-of-a-test", "set_id")
    scored = sim.score_pairs(pairs, bucketed, "lo", "hi")
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, sim.score_pairs(pairs, plain, "lo", "hi").collect()))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    between = exchanges_above(plan.split("Initial Plan")[0], "sets_of_a_test")
    assert between and not any(between)
    saved = shared.save(plain, "plain-sets")
    plain_plan = sim.score_pairs(pairs, saved, "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    assert any(exchanges_above(plain_plan, "parquet"))


# J3: all pairs


@pytest.mark.parametrize("threshold", [Threshold(4, 5), Threshold(1, 2, False), Threshold(1, 1)])
@pytest.mark.parametrize("band_rows", [1, 7, 1000])
def test_all_pairs_meet_once(spark, threshold, band_rows):
    rng = random.Random(band_rows)
    sets = {i * 13 - 50: sorted({rng.randrange(6) for _ in range(rng.randint(1, 6))}) for i in range(40)}
    table = spark.createDataFrame(list(sets.items()), "key bigint, ids array<bigint>")
    found = all_pairs.similar_pairs(table, threshold, len(sets), band_rows)
    expected = []
    for a in sets:
        for b in sets:
            inter, union = len({*sets[a]} & {*sets[b]}), len({*sets[a]} | {*sets[b]})
            passes = inter * threshold.den >= union * threshold.num if threshold.inclusive else inter * threshold.den > union * threshold.num
            if a < b and passes:
                expected.append((a, b, inter / union))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_all_pairs_of_first_lines_equal_the_prefix_join(documents):
    rng = random.Random(3)
    docs = documents(*["\n".join(" ".join(rng.choices("abcdefgh", k=4)) for _ in range(6)) for _ in range(10)])
    threshold = Threshold(1, 2, False)
    firsts = {r["key"] for r in jobs.first_line_sets(docs, 25, 1000).collect()}
    assert len(firsts) == 25
    found = jobs.first_line_pairs(docs, threshold, 25, 1000)
    whole = jobs.similar_lines_with_texts(docs, threshold, 1000)
    expected = [tuple(r) for r in whole.collect() if r["lo"] in firsts and r["hi"] in firsts]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


# L1: first lines


@pytest.mark.parametrize("bins", [3, 4096])
def test_first_keys(spark, monkeypatch, bins):
    monkeypatch.setattr(ls, "CUT_BINS", bins)
    rng = random.Random(bins)
    keys = sorted({rng.choice([rng.randint(-50, 50), rng.randint(-(2**40), 2**62), 5 * 10**15 + rng.randint(0, 99)]) for _ in range(130)})[:90]
    table = shared.save(spark.createDataFrame([(k,) for k in keys], "key bigint").coalesce(1), "keys")
    for limit in (0, 1, 47, 90, 500):
        found = ls.first_keys(table, limit)
        assert sorted(r["key"] for r in found.collect()) == keys[:limit]


def test_first_lines_of_named_documents(spark):
    rows = [((f"f{i % 7}", i), ["a"]) for i in range(60)]
    table = spark.createDataFrame(rows, "key struct<doc_id:string,line_no:int>, toks array<string>").repartition(5)
    found = [(r["key"]["doc_id"], r["key"]["line_no"]) for r in ls.first_lines(table, 11).collect()]
    assert sorted(found) == sorted(k for k, _ in rows)[:11]
    plan = ls.first_lines(table, 11)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan


def test_first_keys_of_nothing(spark):
    assert ls.first_keys(spark.createDataFrame([], "key bigint"), 5).collect() == []


# F2, J2: one anti-join where the whole list is hot


def test_one_anti_join_for_a_hot_list(documents, monkeypatch):
    docs = documents("the the the cat", "the the dog")
    assert index_jobs.inverted_index(docs, 3)._jdf.queryExecution().executedPlan().toString().count("LeftAnti") == 1
    monkeypatch.setattr(shared, "MAX_BROADCAST_WORDS", 0)
    index = index_jobs.inverted_index(docs, 3)
    assert sorted(map(tuple, index.collect())) == [("cat", 1, 1), ("dog", 2, 1)]


def test_the_rest_of_a_list_holds_what_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shared, "MAX_BROADCAST_WORDS", 4)
    words = spark.createDataFrame([("a", 60), ("b", 30), ("c", 10), ("x" * 65, 50)], "tok string, n bigint")
    hot, rest = shared.split_words(words)
    assert [r["tok"] for r in hot.collect()] == ["a"]
    assert sorted(r["tok"] for r in rest.collect()) == ["b", "c", "x" * 65]
    assert shared.split_words(words.where("tok = 'a'"))[1] is None
    assert shared.split_words(words.where("false"))[1] is None
