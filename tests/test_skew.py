"""Hot words and hot texts do not end up in one task."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wordweave.llm import repeats
from wordweave.operators import inverted_index as idx
from wordweave.operators import line_sets as ls
from wordweave.operators import similarity as sim
from wordweave.operators.terms import word_count
from wordweave.operators.tokens import keyed_lines, line_words, tokens

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def small_skew(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_SKEW}
    for name, value in SMALL_SKEW.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_word_on_every_line(spark, small_skew):
    docs = spark.range(8000).selectExpr("id as doc_id", "concat('hot w', id) as text").repartition(8)
    vocab = ls.vocabulary(word_count(tokens(docs, "alnum")))
    rare = ls.rare_line_words(line_words(keyed_lines(docs)), vocab, 10**9)
    sets = ls.line_id_sets(rare)
    assert "skew=true" in final_plan(sets)
    assert sets.count() == 8000


def test_copies_of_one_text_are_not_shuffled_by_text(spark, small_skew):
    # Equal rows compress so well that adaptive execution would not see the skew.
    lines = spark.range(9000).selectExpr("id as key", "if(id % 3 = 0, array(1L, 2L, 3L), array(id div 2, -id)) as ids")
    sets = sim.distinct_sets(lines)
    members = sim.set_members(lines, sets, hot_copies=1000)
    plan = final_plan(members)
    assert "BroadcastHashJoin [ids" in plan and "LeftAnti" in plan
    assert members.where("n_lines = 3000").count() == 3000
    assert members.where("set_id = 0").count() == 3000


def test_a_term_in_every_document_is_many_blocks(spark, small_skew):
    index = spark.range(50_000).selectExpr("if(id % 2 = 0, 'hot', concat('w', id)) as tok", "id div 2 as doc_id", "1L as tf")
    blocked = idx.blocked_index(index, block_docs=512)
    sizes = [r["n_docs"] for r in blocked.where("tok = 'hot'").collect()]
    assert sum(sizes) == 25_000 and max(sizes) <= 512
    # Blocks of one term are dealt to tasks on their own.
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(tok#\d+, \w+#\d+L?, \d+\)", plan)


def test_copies_of_a_block_are_not_dealt_to_one_task(spark, small_skew, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_BROADCAST_KEYS", 10)
    # Spark splits no skewed join here.
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1g")
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat(if(id % 2 = 0, 'passage ', concat('w', 10000 + id, '  ')), 5) as text").repartition(8)
    spans = repeats.repeated_spans(docs, 40)
    tasks = [r["count"] for r in spans.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2000 and max(tasks) < 1000


def test_frequent_and_other_blocks_equal_brute_force(spark, small_skew, monkeypatch):
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdé ", k=90))
    texts = ["".join(rng.choices("abcdefé ", k=rng.randint(0, 90))) + passage[rng.randint(0, 20) :] for _ in range(60)]
    texts += [passage + passage] * 30 + ["".join(rng.choices("abc", k=60))] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = repeats.brute_force([t.encode() for t in texts], 40)
    for keys, hot in ((1, 2000), (20, 2000), (20, 3)):
        monkeypatch.setattr(repeats, "MAX_BROADCAST_KEYS", keys)
        found = {r["doc_id"]: [(s["from"], s["to"]) for s in r["removed"]] for r in repeats.without_repeats(rows, 40, hot).collect()}
        assert found == dict(enumerate(expected))
