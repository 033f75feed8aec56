import random
import subprocess
import sys
from pathlib import Path

import pytest

from wordweave import shared
from wordweave.functions.threshold import Threshold
from wordweave.operators import line_sets as ls
from wordweave.operators import similarity as sim
from wordweave.operators.inverted_index import inverted_index, rendered_index
from wordweave.operators.tokens import tokens
from wordweave.plans import index_jobs
from wordweave.plans import similarity_jobs as jobs
from wordweave.sinks import write_delimited, write_metrics, write_pairs, write_report
from wordweave.sinks import text as text_sink
from wordweave.sources import cleaned_lines, numbered_text_lines, stop_word_list, text_documents, text_lines_by_file, word_counts


def written(path):
    return sorted(line for part in path.glob("part-*") for line in part.read_text().splitlines())


def test_word_counts_round_trip(spark, documents, tmp_path):
    counts = index_jobs.word_counts(documents("a a b 3#4", "a\tb null nan"), "delim")
    write_delimited(counts, str(tmp_path / "counts"))
    assert "a, 2" in written(tmp_path / "counts")
    back = word_counts(spark, str(tmp_path / "counts"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, counts.collect()))


def test_a_missing_list_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        word_counts(spark, str(tmp_path / "none"))


def test_a_broken_list_raises(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("word, many\n")
    with pytest.raises(Exception):
        word_counts(spark, str(tmp_path / "bad.csv")).collect()


def test_line_sets_round_trip(spark, documents, tmp_path):
    sets = jobs.line_sets(documents("b a a\nb c\n!!\nc b"), 10)
    write_delimited(ls.rendered_line_sets(sets), str(tmp_path / "sets"), text_sink.LINE_SEPARATOR)
    assert written(tmp_path / "sets") == ["1000000,a b", "1000001,c b", "1000003,c b"]
    back = cleaned_lines(spark, str(tmp_path / "sets"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sets.collect()))


def test_outputs_are_replaced(documents, tmp_path):
    path = tmp_path / "index"
    for text in ("x", "the cat", "dog cat"):
        index = rendered_index(index_jobs.inverted_index(documents(text, "cat"), 9))
        write_delimited(index, str(path), text_sink.INDEX_SEPARATOR)
    assert written(path) == ["cat : 1#1, 2#1", "dog : 1#1"]


def test_the_caller_chooses_one_file(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id as string) as tok", "id as n").repartition(4)
    write_report(rows, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    write_report(rows, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("part-*"))) == 4
    assert written(tmp_path / "one") == written(tmp_path / "many")


def test_metrics(documents, tmp_path):
    write_metrics(ls.line_count(jobs.non_empty_lines(documents("a\nb"), 10)), str(tmp_path / "m"))
    assert written(tmp_path / "m") == ["lines: 2"]


def test_pairs(documents, tmp_path):
    pairs = jobs.similar_lines_with_texts(documents("a b c d\na b c d e"), Threshold(4, 5))
    write_pairs(pairs, str(tmp_path / "p"))
    assert written(tmp_path / "p") == ['1000000\t1000001 : 0.8\t"a b c d" - "e a b c d"']
    write_pairs(pairs, str(tmp_path / "p"), in_parentheses=True)
    assert written(tmp_path / "p") == ['(1000000, 1000001) : 0.8\t"a b c d" - "e a b c d"']


def test_stop_word_lists_with_and_without_counts(spark, documents, tmp_path):
    (tmp_path / "stop.csv").write_text("the, 4001\nof,17\nand\n")
    listed = stop_word_list(spark, str(tmp_path / "stop.csv"))
    assert sorted(map(tuple, listed.collect())) == [("and", 0), ("of", 17), ("the", 4001)]
    kept = inverted_index(tokens(documents("the cat and the dog of"), "delim"), listed)
    assert sorted(r.tok for r in kept.collect()) == ["cat", "dog"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    (tmp_path / "one" / "same.txt").write_bytes(b"the cat sat\r\ncat\r\n")
    (tmp_path / "two" / "same.txt").write_bytes(b"cat dog\nthe cat sat\n")
    return tmp_path


def test_index_of_text_files(spark, folder):
    docs = text_lines_by_file(spark, str(folder))
    found = {(r.tok, r.doc_id.split("/")[-2]): r.tf for r in index_jobs.inverted_index(docs, 100).collect()}
    assert found == {
        ("the", "one"): 1, ("the", "two"): 1, ("cat", "one"): 2, ("cat", "two"): 2,
        ("sat", "one"): 1, ("sat", "two"): 1, ("dog", "two"): 1,
    }


def test_similar_lines_of_text_files(spark, folder):
    docs = text_documents(spark, str(folder))
    pairs = jobs.similar_lines(docs, Threshold(4, 5)).collect()
    (pair,) = pairs
    ends = [(key.doc_id.split("/")[-2], key.line_no) for key in (pair.lo, pair.hi)]
    assert ends == [("one", 0), ("two", 1)]
    assert pair.similarity == 1.0


def test_saved_tables_go_to_the_shared_folder(spark):
    root = shared.shared_folder(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    saved = shared.save(spark.range(5), "numbers")
    assert saved.count() == 5
    assert all(root in name for name in saved.inputFiles())


def test_saved_tables_can_be_dropped(tmp_path):
    script = f"""
from pathlib import Path
from pyspark.sql import SparkSession
from wordweave import shared
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
shared.save(spark.range(3), "numbers")
assert list(Path("{tmp_path}").rglob("*.parquet"))
shared.drop_saved_tables(spark)
assert not list(Path("{tmp_path}").rglob("*.parquet"))
"""
    subprocess.run([sys.executable, "-c", script], check=True, cwd=Path(__file__).parent.parent, timeout=120)


def test_small_scans_are_spread(spark):
    one = spark.range(100).coalesce(1)
    assert shared.spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(32)
    assert shared.spread(many, "id") is many


def test_sets_from_text_can_be_joined(spark, tmp_path):
    (tmp_path / "sets.csv").write_text("0,a b c d\n7,a b c d e\n9,z\n")
    lines = cleaned_lines(spark, str(tmp_path)).selectExpr("key", "toks as ids")
    distinct = sim.distinct_sets(lines)
    pairs = sim.similar_sets(distinct, Threshold(4, 5)).collect()
    assert [(r.set_lo, r.set_hi, r.inter, r.uni) for r in pairs] == [(0, 7, 4, 5)]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "512")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_numbered_lines_of_split_files(spark, tmp_path, small_splits):
    rng = random.Random(3)
    folder = tmp_path / "corpus"
    folder.mkdir()
    texts = {name: [" ".join(rng.choices("abcdefg", k=rng.randrange(6))) for _ in range(300)] for name in ("one", "two")}
    for name, lines in texts.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    read = numbered_text_lines(spark, str(folder))
    rows = read.collect()
    assert len({r["key"] for r in rows}) == len(rows)
    for name, lines in texts.items():
        mine = sorted((r["line_no"], r["line"]) for r in rows if r["doc_id"].endswith(name))
        assert mine == list(enumerate(lines))
    # Jobs on lines find what they find for the same texts in a table.
    table = spark.createDataFrame([(i, "\n".join(texts[n])) for i, n in enumerate(texts)], "doc_id long, text string")
    place = {r["key"]: list(texts).index(r["doc_id"].rsplit("/", 1)[1]) * 1_000_000 + r["line_no"] for r in rows}
    found = {tuple(sorted((place[r["lo"]], place[r["hi"]]))) for r in jobs.similar_lines(read, Threshold(4, 5)).collect()}
    assert found == {(r["lo"], r["hi"]) for r in jobs.similar_lines(table, Threshold(4, 5)).collect()}
    adjacent = {(place[r["lo"]], place[r["hi"]], r["inter"], r["uni"]) for r in jobs.adjacent_line_scores(read).collect()}
    assert adjacent == {tuple(r) for r in jobs.adjacent_line_scores(table).select("lo", "hi", "inter", "uni").collect()}


def test_jobs_on_lines_refuse_lines_without_a_number(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a b c\nd e f\n")
    with pytest.raises(Exception, match="text"):
        jobs.similar_lines(text_lines_by_file(spark, str(tmp_path)), Threshold(4, 5))
