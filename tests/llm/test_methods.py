"""Parts that need no Spark session."""

import random

import numpy as np
import pytest

from wordweave.llm import mixing, quality, repeats, secrets, sharding, toxicity
from wordweave.llm.cuckoo import CuckooFilter, Overflow
from wordweave.llm.suffixes import repeated_starts


def test_cuckoo_filter_inserts_deletes_and_overflows():
    keys = [random.Random(i).randbytes(32) for i in range(500)]
    filt = CuckooFilter(500)
    for k in keys:
        filt.insert(k)
    assert all(k in filt for k in keys)
    again = CuckooFilter.from_bytes(filt.to_bytes())
    assert all(k in again for k in keys)
    assert all(filt.delete(k) for k in keys)
    assert not any(filt.table)
    small = CuckooFilter(1)
    with pytest.raises(Overflow):
        for k in keys:
            small.insert(k)


def test_targets_are_capped_and_shared_again():
    sizes = {"a": 10, "b": 100, None: 90}
    targets = mixing.capped_targets(sizes, mixing.repeating_weights(list(sizes)), 3, 200)
    assert targets["a"] == 30 and sum(targets.values()) == 200
    assert targets["b"] == pytest.approx(170 * 2 / 3)
    assert mixing.in_order([None, "b", "a"]) == ["a", "b", None]
    assert mixing.capped_targets({}, {}, 3, 0) == {}


def test_flow_uses_overlap_before_repetition():
    # "b" alone could only repeat its own words; what it shares with "a" is routed to it.
    given = mixing.route({("a",): 50, ("a", "b"): 50, ("b",): 10}, {"a": 50, "b": 60}, 3)
    assert given["a",] == {"a": 50} and given["a", "b"] == {"a": 0, "b": 50} and given["b",] == {"b": 10}


def test_jump_hash_moves_rows_into_the_new_shard_only():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63, 20_000)
    old, new = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    assert set(new[old != new]) == {40}
    assert np.bincount(old, minlength=40).min() > 400


@pytest.mark.parametrize("seed", range(6))
def test_repeated_starts_equal_brute_force(seed):
    rng = random.Random(seed)
    strings = ["".join(rng.choices("ab", k=rng.randint(0, 60))).encode() for _ in range(12)]
    strings += strings[:2] + [b"a" * 50]
    least = 9
    found = repeated_starts(strings, least)
    windows = [w for s in strings for w in (s[i : i + least] for i in range(len(s) - least + 1))]
    for s, starts in zip(strings, found, strict=True):
        assert starts.tolist() == [i for i in range(len(s) - least + 1) if windows.count(s[i : i + least]) > 1]


def test_every_window_has_one_block():
    raw = random.Random(1).randbytes(3000).replace(b"\xff", b"x") + b"z" * 900
    blocks = repeats.blocks_of(raw, 40)
    assert [i for _, a, b in blocks for i in range(a, b + 1)] == list(range(len(raw) - 39))
    assert repeats.blocks_of(b"short", 40) == []


def test_automaton_finds_misspelled_stems():
    automaton = toxicity.Automaton(["idiot", "worthless"])
    assert automaton.token('"Idiot!"'.lower()) == 0
    assert automaton.token("idiotic") == 0
    assert automaton.token("idyot") == automaton.token("idot") == 1
    assert automaton.token("wrthles") == 2
    assert automaton.token("table") is None and automaton.token("") is None


def test_quoted_words_are_told_from_abuse():
    automaton = toxicity.Automaton(["idiot"])
    quoted = dict(zip(toxicity.FEATURES, toxicity.features('he wrote "idiot" once', automaton), strict=True))
    abuse = dict(zip(toxicity.FEATURES, toxicity.features("you idiot", automaton), strict=True))
    assert quoted["quoted"] == 1 and quoted["addressed"] == 0
    assert abuse["quoted"] == 0 and abuse["addressed"] == 1
    assert toxicity.features("", automaton) == [0.0] * len(toxicity.FEATURES)


def test_base_spans():
    text = "é Password: abcdefghijkl token=short AKIA" + "A" * 14 + " " + "0123456789abcdef"
    assert secrets.rendered(secrets.base_spans(text)) == "assign:2:24,access:37:55,hex:56:72"


def test_token_efficiency():
    count = lambda s: len(s)  # noqa: E731  one token a character
    assert secrets.random_spans("x9Qz7Lm2Kp4Rt8Vw", count) == [(0, 3, 16)]
    assert not secrets.random_spans("d41d8cd98f00b204e9800998ecf8427e", count)  # the length of a digest
    assert not secrets.random_spans("some_long_identifier_2024", count)
    assert not secrets.random_spans("x9Qz7Lm2Kp4Rt8Vw", lambda s: 1)


def test_positive_unlabelled_risk_separates():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 0.5, (1500, quality.N_FEATURES)), rng.normal(-1, 0.5, (1500, quality.N_FEATURES))
    model = quality.fit_pu(good[:1000], np.vstack([good[1000:], bad[:500]]), 0.5)
    assert (model.logits(good) > 0).mean() > 0.95 and (model.logits(bad[500:]) < 0).mean() > 0.95
