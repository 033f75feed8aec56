"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import TESTDATA
from wordweave.llm import decontaminate, exact_dedup, language_model, minhash, mixing, queries, repeats, secrets, sharding, toxicity

SF = TESTDATA / "sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, bucket string"


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(0)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    base = " ".join(rng.choices(words, k=120))
    texts = [None, "", " \t\n", base, base, base.replace(" ", "  "), base + " one more word", "alone", "Alone", " ".join(words * 30)]
    texts += [" ".join(rng.choices(words, k=80)) for _ in range(10)]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], 0, 1, "x") for i, t in enumerate(texts)]
    rows += [rows[3], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(odd, nothing):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["keep_id"] == 5 and by_id[3]["group_size"] == 5  # 5 has the most characters
    assert by_id[0]["group_size"] == 4 and by_id[0]["keep_id"] == 2
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_index_insertion_and_deletion(odd):
    groups = exact_dedup.partial_groups(exact_dedup.digests(odd))
    index = exact_dedup.build_index(groups, 3)
    twice = exact_dedup.update_index(index, groups, 3)
    n = lambda df: df.where("digest is not null").agg(F.sum("group_size")).first()[0]
    assert n(twice) == 2 * n(index)
    assert n(exact_dedup.update_index(twice, groups, 3, remove=True)) == n(index)
    assert exact_dedup.update_index(index, groups, 3, remove=True).where("digest is not null").count() == 0


def _chains():
    """Rings of texts, each near its neighbours alone, so that one bucket holds several components."""
    rng = random.Random(5)
    texts = []
    for ring in range(12):
        words = [f"w{ring}x{i}" for i in range(60)]
        for step in range(25):
            texts.append(" ".join(words))
            for at in rng.sample(range(60), rng.choice([1, 2, 3])):
                words[at] = f"n{ring}x{step}x{at}"
    return texts


def _linked(texts, size, threshold):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("size", [1, 2])
def test_near_duplicates_in_chains(spark, size):
    texts = _chains()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, size).collect()}
    assert found == dict(enumerate(_linked(texts, size, 80)))


def test_near_duplicates_without_an_id(spark):
    body = " ".join(f"w{i}" for i in range(50))
    rows = [(None, body + " a"), (7, body + " b"), (9, body + " c"), (None, "else"), (9, body + " c")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((r["component_id"] or 0) for r in found) == [0, 7, 7, 7, 7]


def test_near_duplicates(odd, nothing):
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in minhash.near_duplicates(odd, 2).collect()}
    labels = {k[0]: v for k, v in found.items() if k[0] is not None}
    assert {labels[i] for i in (3, 4, 5, 6)} == {3}
    assert labels[7] == labels[8] == 7 and labels[1] == 1 and labels[2] == 2 and labels[9] == 9
    assert minhash.near_duplicates(nothing, 2).count() == 0
    kept = minhash.without_near_duplicates(odd, 2)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (3, 4, 5, 6, 7, 8)) == [3, 3, 7]


def test_repeats_equal_brute_force(spark, odd, nothing):
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdé ", k=90))
    texts = ["".join(rng.choices("abcdefé ", k=rng.randint(0, 200))) + passage[: rng.randint(0, 90)] for _ in range(60)]
    texts += ["ab" * 100, "", texts[0]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = repeats.brute_force([t.encode() for t in texts], 40)
    for hot in (2000, 3):
        found = {r["doc_id"]: r for r in repeats.without_repeats(rows, 40, hot).collect()}
        for i, expected in enumerate(spans):
            assert [(s["from"], s["to"]) for s in found[i]["removed"]] == expected
    assert repeats.without_repeats(nothing).count() == 0
    assert {r["n_bytes"] for r in repeats.without_repeats(odd).where("doc_id in (0, 1)").collect()} == {0}


def test_templates_catch_changed_values(spark, nothing):
    items = spark.createDataFrame(
        [(1, "a farmer in Norway sells 12 kg of plums to Anna and later 5 kg of pears to her friend"), (2, None), (3, "")], "item_id bigint, text string"
    )
    changed = "so a farmer in Spain sells 40 kg of plums to Emma and later 7 kg of pears to her friend today"
    mixed_up = "a farmer in Norway sells 12 kg of plums to Norway and later 12 kg of pears to her friend"
    texts = [changed, mixed_up, "nothing of the kind", None, ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id string")
    rows = decontaminate.contaminated(docs, items).collect()
    assert [r["doc_id"] for r in rows] == [0]
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]
    assert decontaminate.contaminated(nothing, items).count() == 0


def test_repeated_windows_are_aligned_as_a_whole(spark):
    """Items whose template repeats a window: verbatim, with an insertion, beside other numbers, and another list."""
    series = "2, 4, 6, 8, 10, 12, 14 what comes next in the series"
    numbers = "3 1 4 15 9 2 6 5 35 8 97 93"
    parts = "first 3 8 21 55 144 377 then add 7 11 13 17 19 23 at last"
    items = spark.createDataFrame([(1, series), (2, numbers), (3, parts)], "item_id bigint, text string")
    texts = [
        series,
        "rows 1 2 3 4 5 6 7 8 9 then " + series,
        "70 71 72 73 74 75 76 77 78 79 80 " + numbers + " 60 61 62 63 64 65 66",
        parts.replace(" then", " and then please"),
        "5, 4, 4, 5, 4, 5, 5 what comes next in the series",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect())
    assert [r for r in rows if r[1] != 2] == [(0, 1), (1, 1), (3, 3)]
    assert (2, 2) in rows


def test_signs_first_words_and_short_items(spark):
    rows = [
        (1, "Pay $12 for -5 plums, $30 for +7 pears and x=9 more"),
        (2, "Tom has 3 apples. Tom gives 1 to Mary. Tom eats it"),
        (3, "Solve it for 12"),
        (4, "40 kg"),
    ]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    texts = [
        "Pay €15 for -8 plums, €45 for +2 pears and x=4 more",
        "Jim has 5 apples. Jim gives 2 to Anna. Jim eats it",
        "Now read this. Solve it for 99 and then go on to the next one",
        "it weighs 40 kg as all of them do",
        "it weighs 41 kg as all of them do",
        "41 kg",
        "Jim has 5 apples. Bob gives 2 to Jim. Max eats it",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect())
    assert found == [(0, 1), (1, 2), (2, 3), (3, 4), (5, 4)]


def test_mixture_comes_near_its_targets(spark, odd, nothing):
    docs = spark.read.parquet(str(SF / "documents.parquet"))
    mixture = mixing.mix(docs, mixing.own_source())
    taken = {r["s"]: r["t"] for r in mixture.rows.groupBy(F.col("mix_sources")[0].alias("s")).agg(F.sum("mix_taken").alias("t")).collect()}
    for s, target in mixture.targets.items():
        # About 50 documents a source, so a document is 2 % of its words.
        assert abs(taken[s] - target) <= 0.02 * target
    assert mixture.rows.where("mix_taken > 3 * mix_size").isEmpty()
    both = mixing.mix(odd, F.array("source", "lang"))
    assert both.rows.count() == odd.count() and mixing.repeated(both, odd.columns).columns == odd.columns
    assert mixing.mix(nothing, mixing.own_source()).rows.count() == 0


def test_long_document_at_the_cut_is_made_up_for(spark):
    texts = [("a", "w " * 10_000)] + [("a", "w " * 5)] * 2000 + [("b", "w " * 5)] * 4000 + [("a", "")] * 600
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(texts)], "doc_id long, text string, source string")
    for seed in range(3):
        mixture = mixing.mix(docs, mixing.own_source(), {"a": 1, "b": 3}, seed=seed)
        taken = mixture.rows.groupBy(F.col("mix_sources")[0].alias("s")).agg(F.sum("mix_taken").alias("t")).collect()
        assert {r["s"]: r["t"] for r in taken} == mixture.targets == {"a": 10_000, "b": 30_000}


def test_shards(odd, nothing):
    rows = sharding.sharded_digest(odd, 4).collect()
    assert len(rows) == odd.count()
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    again = sharding.sharded_digest(odd.repartition(5), 4).collect()
    order = lambda rs: sorted((r["shard"], r["slot"], r["text_crc32"]) for r in rs)
    assert order(rows) == order(again)
    assert sharding.sharded_digest(nothing, 4).count() == 0


def test_language_model(odd, nothing):
    rows = language_model.score_corpus(odd).collect()
    assert len(rows) == odd.count() and all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (0, 1, 2))
    assert language_model.score_corpus(nothing).count() == 0


def test_secrets(odd):
    rows = secrets.scan(odd).collect()
    assert len(rows) == odd.count()
    assert {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = queries.queries()[name](spark, str(SF))
    columns = sorted(found.columns)
    expected = con.sql(queries.oracle_sql()[name]).select(*columns).fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize(("name", "label", "least"), [("op6_toxicity", "toxic", 0.95), ("op8_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    labels = spark.read.parquet(str(TESTDATA / "sf0.1" / "labels.parquet"))
    scored = queries.queries()[name](spark, str(TESTDATA / "sf0.1")).where("held_out").join(labels, "doc_id")
    assert scored.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, str(TESTDATA / "sf0.001"))
    assert rows.where("shard < 0 or shard > 39").isEmpty() and 0 < rows.count()
    assert rows.groupBy("shard").agg(F.max("slot").alias("m"), F.count("*").alias("n")).where("n <> m + 1").isEmpty()


CLASHING = ["start", "repeats", "filled", "mix_size", "mix_h", "mix_copy", "bucket_no", "row_hash", "place_no", "shard_no", "gone_id", "gone_hash"]
CLASHING += ["hit_id", "hit_hash", "tox_score", "pattern_id", "n", "size", "label", "bucket", "component", "left", "h"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Null and empty texts, repeated rows and ids, near copies, and a column of every helper's name."""
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(1, body, "a"), (1, body, "a"), (2, body + " more", "b"), (None, body + " else", None), (None, "x y", "a"), (None, None, "b")]
    rows += [(4, "", "a"), (5, "Hi there " * 3000, "a"), (4, "", "a")]
    docs = spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, source string, lang string, n_chars long")
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_clashing_columns(spark, clashing, empty):
    docs = clashing.limit(0) if empty else clashing
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    model = toxicity.Model(["word"], [0.0] * (len(toxicity.FEATURES) + 1))
    stages = {
        "toxic": toxicity.without_toxic(docs, model, 0.9),
        "near": minhash.without_near_duplicates(docs, 5),
        "leaks": decontaminate.without_contaminated(docs, items),
        "mix": mixing.repeated(mixing.mix(docs, mixing.own_source()), docs.columns[:5] + ["start", "hit_id"]),
    }
    for name, rows in stages.items():
        assert rows.columns[:5] == docs.columns[:5], name
        found = rows.collect()
        assert all(r["start"] == "own start" and r["hit_id"] == "own hit_id" for r in found)
        assert len(found) == {"toxic": 9, "near": 7, "leaks": 9}.get(name, len(found)) * (not empty)
    assert toxicity.score(docs, model).columns.count("tox_score") == 1
    shuffled = sharding.with_slots(sharding.shuffle_buckets(sharding.scatter(docs, 4)))
    assert {"row_hash", "start"} <= set(shuffled.columns) and shuffled.columns.count("place_no") == 1
    assert shuffled.count() == docs.count()


def test_one_document_stays_where_ids_are_null_or_repeated(spark):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(None, body + " a"), (None, body + " b"), (3, body[::-1] + " a"), (3, body[::-1] + " b"), (3, body[::-1] + " b"), (5, "x")]
    kept = minhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r["doc_id"] is None for r in kept) == 1
    assert len({r["text"] for r in kept if r["doc_id"] == 3}) == 1 and sum(r["doc_id"] == 5 for r in kept) == 1


def test_bucket_of_many_that_are_not_similar(spark):
    """300 documents of one passage and words of their own, in similarities from 0.2 to 0.9."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(120)]
    texts = []
    for i in range(300):
        own = [f"d{i}x{k}" for k in range(rng.choice([4, 10, 14, 20, 40, 90]))]
        texts.append(" ".join(passage + own) if i % 7 else " ".join(passage + own[:5] + [f"t{i // 14}x{k}" for k in range(20)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == dict(enumerate(_linked(texts, 2, 80)))


def test_copies_edited_in_places_of_their_own(spark, monkeypatch):
    """500 copies with up to 14 edits: many are near the threshold, few pairs need a comparison."""
    rng = random.Random(4)
    body, texts = [f"b{i}" for i in range(150)], []
    for i in range(500):
        words = list(body)
        for at in rng.sample(range(150), rng.choice([1, 3, 5, 7, 8, 9, 10, 12, 14])):
            words[at] = f"e{rng.randint(0, 4000)}"
        texts.append(" ".join(words))
    compared, confirmed = [], minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda pairs, *rest: compared.append(pairs.count()) or confirmed(pairs, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == dict(enumerate(_linked(texts, 2, 80)))
    # Stars come first.
    assert sum(compared[1:]) < 2 * len(texts)


def test_documents_gathered_to_a_batch_keep_their_features():
    texts = [b"", b"a", b"b c d", b"", b"a b c d e"]
    words = [w for t in texts for w in language_model.words_of(t)]
    vocab = language_model.Vocabulary([(w, 9) for w in sorted(set(words) - {b"d"})], 99, 6)
    together = language_model._Gathered(vocab)
    assert not any([together.add(language_model.words_of(t)) for t in texts])
    tokens, numbers, rows, starts = together.take()
    assert tokens == words and starts.tolist() == [0, 1, 3, 7, 8]
    for text, at in zip(texts, starts.tolist(), strict=True):
        alone = language_model._Gathered(vocab)
        alone.add(language_model.words_of(text))
        _, own_numbers, own_rows, _ = alone.take()
        assert (rows[at : at + len(own_rows)] == own_rows).all() and (numbers[at : at + len(own_rows)] == own_numbers).all()


@pytest.mark.parametrize("threshold", [80, 60])
def test_linked_sets_meet_in_their_rarest_items(spark, threshold):
    rng = random.Random(threshold)
    centre, sets = set(range(40)), []
    for i in range(160):
        gone = rng.sample(range(40), rng.choice([0, 2, 5, 8, 12, 20]))
        sets.append(centre - set(gone) | {rng.randint(100, 130) for _ in range(rng.choice([0, 2, 5, 9, 16]))})
    rows = [(0, i, len(s - centre), len(centre - s), (100 - threshold) * 40, 1, sorted(s ^ centre)) for i, s in enumerate(sets)]
    rows += [(1, i, len(s), 0, 0, -(-threshold * len(s) // 100), sorted(s)) for i, s in enumerate(sets)]
    labels = spark.createDataFrame([(i, i) for i in range(160)], "cid long, label long")
    pairs = lambda centre: {tuple(r) for r in minhash.meeting_pairs(table.where(f"centre = {centre}"), labels, threshold).collect()}
    table = spark.createDataFrame(rows, minhash.ITEMS)
    alike = lambda x, y: 100 * len(x & y) >= threshold * len(x | y)
    linked = {(a, b) for b in range(160) for a in range(b) if alike(sets[a], sets[b])}
    by_centre = {(a, b) for a, b in linked if alike(sets[a], centre) and alike(sets[b], centre)}
    assert linked - by_centre and linked - by_centre <= pairs(0)
    assert linked <= pairs(1)


def test_index_equals_one_built_anew(spark):
    """Random insertions and deletions; the document that stays is often the one that goes."""
    rng = random.Random(2)
    schema = "doc_id long, text string"
    rows = [(i if i % 9 else None, " " * rng.randint(0, 3) + f"t{rng.randint(0, 12)}") for i in range(90)]
    live = exact_dedup.digests(spark.createDataFrame(rows[:50], schema))
    index = exact_dedup.build_index(exact_dedup.partial_groups(live), 3)
    more = exact_dedup.digests(spark.createDataFrame(rows[50:], schema))
    index, live = exact_dedup.update_index(index, exact_dedup.partial_groups(more), 3), live.unionByName(more)
    out = rng.sample(range(90), 55)
    gone = exact_dedup.digests(spark.createDataFrame([rows[i] for i in out] + [(999, "never there")], schema))
    index, live = exact_dedup.delete_documents(index, live, gone, 3)
    left = [r for i, r in enumerate(rows) if i not in out]
    anew = exact_dedup.build_index(exact_dedup.partial_groups(exact_dedup.digests(spark.createDataFrame(left, schema))), 3)
    groups = lambda df: sorted(df.where("digest is not null").drop("filter").collect(), key=str)
    assert groups(index) == groups(anew) and live.count() == len(left)


def test_random_strings_of_letters_and_behind_words():
    count = secrets.encoder(secrets.VOCABULARY)
    found = lambda text: [text[a:b] for a, _, b in secrets.random_spans(text, count)]
    keys = ["qKzXwVbnMpLtRfGhJdSy", "abcdqwzxkvjpmnty", "h7Gq2LzX9vBn4TkW"]
    for key in keys:
        assert found(f"here {key} there") == [key]
        assert found(f"https://example.org/some/long/path/of/common/words/and/more/words/{key}")[0].endswith(key)
    for word in ("internationalization", "Donaudampfschifffahrtsgesellschaft", "anticonstitutionnellement", "get_value_of_the_next_item"):
        assert found(word) == []
    assert found("d41d8cd98f00b204e9800998ecf8427e 123e4567-e89b-12d3-a456-426614174000") == []


def test_misspelled_terms_alone(spark):
    learn = [(i, ("plain words of a day " * 8) + ("you grumbolt you snarvik" if i % 2 else "a garden and a river"), i % 2) for i in range(400)]
    wrong = [(i, ("plain words of a day " * 8) + "you grumbollt you snervik", 1) for i in range(401, 460, 2)]
    rows = spark.createDataFrame(learn + wrong, "doc_id long, text string, toxic int")
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    long = "plain words of a day " * 60
    new = spark.createDataFrame(
        [(1, long + "you grimbolt you snarvyk"), (2, long + "a garden and a river"), (3, None), (3, None), (4, "")], "doc_id long, text string"
    )
    found = {r["doc_id"]: r["tox_score"] for r in toxicity.score(new, model).collect()}
    assert found[1] > 0.5
    assert max(found[2], found[3], found[4]) < 0.5
    assert found[3] == found[4]
    assert toxicity.score(new.limit(0), model).count() == 0
    texts = ("he wrote \"grimbolt\" once", "you grimbolt of mine")
    one, two = (dict(zip(toxicity.FEATURES, toxicity.features(t, model.automaton()), strict=True)) for t in texts)
    assert (one["any"], one["exact"], one["quoted"], one["addressed"]) == (1, 0, 1, 0)
    assert (two["any"], two["exact"], two["quoted"], two["addressed"]) == (1, 0, 0, 1)
