"""Conversation repair, byte-pair encoding and hard negatives against plain definitions."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from wordweave.llm import bpe, conversations, negatives

SF = TESTDATA / "sf0.001"
needs_data = pytest.mark.skipif(not SF.exists(), reason="test tables are not there")

CONVERSATION = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows):
    """The least (cost, audit) by trying every edit, at most two insertions in a row."""
    best = None

    def go(i, out, cost, audit, inserted):
        nonlocal best
        if (best is not None and cost > best[0]) or not re.fullmatch(r"(s?(ua)*u?)?", out):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", out):
            best = min(best or (cost, audit), (cost, audit))
        if inserted < 2:
            for initial in "ua":
                go(i, out + initial, cost + 2, audit + "I", inserted + 1)
        if i < len(rows):
            initial, fault = rows[i]
            go(i + 1, out, cost + 3, audit + "D", 0)
            if fault not in ("blank", "duplicate"):
                price = fault == "truncated"
                if initial:
                    go(i + 1, out + initial, cost + price, audit + "K", 0)
                for other in "ua":
                    go(i + 1, out + other, cost + 2 + price, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def plain_repair(table):
    """Every column of the result, from the rows of a table."""
    groups = {}
    for conv_id, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        rows = groups.setdefault(conv_id, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    found = []
    for conv_id, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(rows, faults, strict=True)])
        out, at, last = [], 0, ""
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            role = "assistant" if last == "u" else "user"
            text = ""
            if letter != "I":
                role, text, at = (rows[at][1] if letter == "K" else role), rows[at][2], at + 1
            out.append(f"{role}:{text}")
            last = role[:1]
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()))
    return sorted(found, key=str)


def repaired(spark, table, schema=CONVERSATION):
    found = conversations.repair(conversations.damaged(spark.createDataFrame(table, schema)))
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("block", [1, 3, 32])
def test_search_finds_the_cheapest_and_least_repair(monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        rows = [(rng.choice("uuaasx "), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 6))]
        repair = conversations.Repair()
        for initial, fault in rows:
            repair.add(conversations.Row(initial, fault), initial, "")
        assert repair.finish()[:2] == cheapest(rows)


def test_bounds_are_never_above_the_cost():
    rng = random.Random(5)
    for _ in range(300):
        rows = [conversations.Row(rng.choice("uasx"), rng.choice(["", "truncated", "blank"])) for _ in range(rng.randint(0, 7))]
        bounds = conversations.lower_bounds(rows)
        for i in range(len(rows) + 1):
            cost, _ = cheapest([(r.initial, r.fault) for r in rows[i:]])
            assert bounds[i] <= cost


def test_long_conversation_has_the_same_repair_in_small_and_large_blocks(monkeypatch):
    rng = random.Random(7)
    rows = [conversations.Row(rng.choice("uuaas"), rng.choice([""] * 6 + ["truncated", "blank"])) for _ in range(3000)]
    found = []
    for block in (8, 32, 64):
        monkeypatch.setattr(conversations, "BLOCK", block)
        repair = conversations.Repair()
        for i, row in enumerate(rows):
            repair.add(row, row.initial, str(i))
        found.append(repair.finish())
    assert found[0] == found[1] == found[2]


@needs_data
def test_repairs_of_the_table_equal_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(str(SF / "conversations.parquet")).select("conv_id", "turn", "role", "text").collect()]
    found = conversations.op11_repair(spark, str(SF))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_repair(table)


def test_repair_of_odd_rows(spark):
    rng = random.Random(11)
    table = [(c, t, rng.choice(["user", "assistant", "system", "", None, "User"]), rng.choice(["a.", "b", "", " \t", None, "é?\n", "x" * 50_000]))
             for c in range(60) for t in rng.sample([None, 0, 1, 2, 5, -3], rng.randint(1, 6))]
    table += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (900, 4, "user", "Hi."), (900, 4, "user", "Hi.")]
    assert repaired(spark, table) == plain_repair(table)
    assert repaired(spark, []) == []


def test_repair_with_clashing_columns(spark):
    table = [(1, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for t in range(8)]
    extra = ", ".join(f"{name} string" for name in ("kind", "copy", "gone", "told", "nth", "end", "fault", "audit"))
    clashing = [(*row, *["x"] * 8) for row in table]
    assert repaired(spark, clashing, f"{CONVERSATION}, {extra}") == repaired(spark, table)


def test_conversation_that_is_dropped_whole_stays_in_the_result(spark):
    conv_id = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(conv_id, 0, "user", "Hi.")]) == [(conv_id, 0, 0, 0, 0, 0, 0, "", empty)]


# Byte-pair encoding


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.VOCABULARY)

    def digests(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, dtype="<u4").tobytes()
        return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return digests


LETTERS = [*"aabcdeinorth's.,!?-019  \t\n\x1c\x85\xa0\x00", "Σ", "İ", "É", "é", "̧", "中", "가", "ﬀ",
           "\U00011935\U00011930", "Ɤ", "\U0001f389", "<|endoftext|>", "<|startoftext|>", "<|", "'LL"]


def test_encoding_equals_the_library(library):
    words = bpe.vocabulary(bpe.VOCABULARY)
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices(LETTERS, k=rng.randint(0, 40)))
        assert bpe.round_trip(words, text) == library(text), repr(text)
    for letters in ("ab", "aeiou", "thenrsigo"):
        text = "".join(rng.choices(letters, k=20_000))
        assert bpe.round_trip(words, text) == library(text)


def test_blocks_do_not_change_an_encoding(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 7)
    monkeypatch.setattr(bpe, "BLOCK_IDS", 3)
    words = bpe.Vocabulary(bpe.VOCABULARY)
    for text in ("the quick  brown fox,\n jumps <|endoftext|> over " * 5, "e ́é x" * 9, " " * 40):
        assert bpe.round_trip(words, text) == library(text)


def test_merges_equal_merging_one_by_one():
    rng = random.Random(4)
    for _ in range(40):
        merges, tokens = [], list(range(3))
        strings = ["a", "b", "c"]
        while len(merges) < 12:
            pair = rng.choice(tokens), rng.choice(tokens)
            if strings[pair[0]] + strings[pair[1]] not in strings:
                merges.append(pair)
                tokens.append(len(tokens))
                strings.append(strings[pair[0]] + strings[pair[1]])
        ours = bpe.Merges(3, merges)
        for _ in range(60):
            word = [rng.randrange(3) for _ in range(rng.randint(1, 14))]
            expected = list(word)
            while True:
                ready = [(merges.index(p), i) for i, p in enumerate(zip(expected, expected[1:], strict=False)) if p in merges]
                if not ready:
                    break
                rank, i = min(ready)
                expected[i : i + 2] = [3 + rank]
            assert ours.encode("".join(map(chr, word))) == expected


def test_odd_documents_are_encoded(spark, library):
    texts = [None, "", " ", "a" * 300_000, "word " * 60_000, "same", "same"]
    rows = [(i if i != 5 else None, text, "x", "y") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids string")
    found = sorted((tuple(r) for r in bpe.digests(docs).collect()), key=str)
    assert found == sorted(((r[0], *library(r[1])) for r in rows), key=str)
    blocks = bpe.encode(docs.where("doc_id = 4")).orderBy("block_no").collect()
    ids = np.concatenate([b["ids"] for b in blocks]).astype("<u4")
    assert len(blocks) > 1 and hashlib.sha256(ids.tobytes()).hexdigest() == library(texts[4])[1]
    assert bpe.digests(docs.limit(0)).collect() == []


@needs_data
def test_encoding_of_the_table(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(SF / "documents.parquet")).select("doc_id", "text").collect()}
    found = bpe.op12_bpe(spark, str(SF)).collect()
    assert len(found) == len(texts)
    assert all(tuple(r)[1:] == library(texts[r["doc_id"]]) for r in found)


# Hard negatives


def plain_negatives(table, every=100):
    rows = {}
    for vec_id, vector, label in table:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        row = ((label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in vector])
        rows[vec_id] = min(rows.get(vec_id, row), row)
    found = []
    for anchor, (label, vector) in rows.items():
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=False)), i, l) for i, (l, v) in rows.items() if i != anchor)
        for negated, positive, _ in [s for s in scored if s[2] == label][:5]:
            window = [(-n, i) for n, i, l in scored if l != label and 30 * -negated <= 100 * -n <= 90 * -negated]
            found += [(anchor, positive, rank, i, -negated, n) for rank, (n, i) in enumerate(window[:10], 1)]
    return sorted(found)


def mined(spark, table, every=100, schema="vec_id bigint, embedding array<float>, label int"):
    found = negatives.hard_negatives(spark.createDataFrame(table, schema), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize(("block", "batch"), [(8192, 128), (64, 3)])
def test_negatives_of_close_and_equal_vectors(spark, monkeypatch, block, batch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "BATCH", batch)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 20)) / 4
    vectors = centres[rng.integers(0, 6, 400)] + rng.normal(size=(400, 20)) / 20
    vectors[50:120] = vectors[50]
    vectors[300:310] = 0
    table = [(i, v.astype(np.float32).tolist(), int(rng.integers(0, 4))) for i, v in enumerate(vectors)]
    assert mined(spark, table, 10) == plain_negatives(table, 10)


def test_index_leaves_out_and_still_finds_all(monkeypatch):
    rng = np.random.default_rng(8)
    rows = np.floor(256 * rng.normal(size=(500, 32)) * rng.uniform(0.01, 1, 500)[:, None] / 6)
    index = negatives.Index(np.arange(500), np.zeros(500, dtype=np.int64), rows)
    anchors = rows[:20]
    scores = anchors @ rows.T
    for quantile in (0.999, 0.9, 0.5, 0.0):
        least = np.quantile(scores, quantile, axis=1)
        found = {(a, r, s) for p in index.reaching(index.in_order(anchors), least) for a, r, s in zip(p.anchors, p.rows, p.scores, strict=True)}
        assert found == {(a, r, scores[a, r]) for a, r in zip(*np.nonzero(scores >= least[:, None]), strict=True)}


def test_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    table = [(i, rng.normal(size=4).round(2).tolist(), int(rng.integers(0, 3))) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    table += [(100, [nan, 1, 1, 1], 1), (101, [inf, 1, 1, 1], 1), (102, None, 1), (103, [1, None, 1, 1], 1), (104, [1, 1, 1, 1], None),
              (None, [1, 1, 1, 1], 1), (105, [], 2), (106, [3.0], 1), (107, [1, 1, 1, 1, 1, 1], 2), (108, [1e30, -1e30, 2, 2], 1),
              (20, [9, 9, 9, 9], 2), table[3], table[3]]
    table = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in table]
    assert mined(spark, table, 10) == [r for r in plain_negatives(table, 10)]
    assert mined(spark, []) == []
    clashing = "vec_id bigint, embedding array<float>, label int, score string, block string, vector string, rank string"
    assert mined(spark, [(*row, "a", "b", "c", "d") for row in table], 10, clashing) == plain_negatives(table, 10)


@pytest.mark.skipif(not (TESTDATA / "sf0.01").exists(), reason="test tables are not there")
def test_negatives_of_the_table_equal_sql(spark):
    sf = TESTDATA / "sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    found = negatives.op13_negatives(spark, str(sf))
    expected = con.sql(negatives.OP13_SQL).select(*found.columns).fetchall()
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
