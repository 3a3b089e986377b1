"""Periodic runs against a search over all periods and starts."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saldero.llm import periodic_runs as runs


def by_hand(words, repeats=4, least=6):
    """(start, end, period) of all runs."""
    found = {}
    for period in range(1, len(words) // repeats + 1):
        at = 0
        while at + period < len(words):
            begin = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - begin + period
            if at > begin and length >= max(least, repeats * period):
                found.setdefault((begin, begin + length), period)
            at += 1
    return sorted(((s, e, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def found(words, **options):
    return [tuple(map(int, r)) for r in runs.find_runs(np.array(words, np.int64), len(words), **options)]


repetitive = st.lists(
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 90)), max_size=4
).map(lambda parts: [w for unit, n in parts for w in (unit * 90)[:n]])


@settings(max_examples=500, deadline=None)
@given(repetitive)
def test_runs_equal_a_search_over_all_periods(words):
    assert found(words) == by_hand(words)


def test_long_periods_and_other_limits():
    draw = random.Random(3)
    unit = [draw.randrange(50) for _ in range(700)]
    words = [51, *unit * 5, 52, *[1, 2] * 9, 1, 53, *[7] * 5]
    assert found(words) == by_hand(words) == [(1, 3501, 700), (3502, 3521, 2)]
    assert found(words, repeats=6, least=4) == by_hand(words, 6, 4)
    with pytest.raises(ValueError):
        found(words, repeats=3)


@pytest.mark.parametrize("block", [1, 2, 4, 16, 64])
@pytest.mark.parametrize("top", [2, 200_000])
def test_convolution_finds_every_occurrence(block, top):
    """Small numbers need one prime, large ones two."""
    draw = np.random.default_rng(block)
    words = draw.integers(0, 2, 40 * block) * (top - 1)
    words[10 * block : 14 * block] = np.tile(words[10 * block : 11 * block], 4)
    padded = np.concatenate([words, np.full(3 * block, top)])
    starts = np.arange(0, len(words) - block, block)
    at, far = runs.occurrences(padded, starts, block)
    expected = {
        (s, d) for s in starts.tolist() for d in range(block, 2 * block)
        if np.array_equal(padded[s : s + block], padded[s + d : s + d + block])
    }
    assert set(zip(at.tolist(), far.tolist(), strict=True)) == expected


def test_transforms_convolve_exactly():
    draw = np.random.default_rng(1)
    for prime in runs.PRIMES:
        a, b = (draw.integers(0, prime, (3, 16), np.uint64) for _ in "ab")
        got = runs.Transform(16, prime).convolve(a.copy(), b.copy())
        for row in range(3):
            for k in range(16):
                total = sum(int(a[row, i]) * int(b[row, (k - i) % 16]) for i in range(16))
                assert int(got[row, k]) == total % prime


def test_collisions_of_hashes_are_set_right(monkeypatch):
    """With hashes that call everything equal, extensions are cut back word by word."""
    monkeypatch.setattr(runs.Stretches, "_equal", lambda self, at, far, length: np.ones(len(at), bool))
    words = [9, *[1, 2, 3] * 6, 8, *[4] * 7, 5]
    assert found(words) == by_hand(words)


TEXTS = [
    None,
    "",
    " \n\t ",
    "a a a a a",
    "a a a a a a",
    "x y x y é é é é é é\x0bé",
    "a b " * 4 + "c",
    "w " + "k l m\t" * 5000 + "end",
    "A a A a A a A a",
]


def test_texts_and_odd_columns(spark):
    rows = [(i if i else None, t, "runs", 1) for i, t in enumerate(TEXTS + TEXTS[-2:])]
    table = spark.createDataFrame(rows, "`doc.id` long, text string, runs string, n_words int")
    got = runs.periodic_runs(table, id_col="doc.id", slice_bytes=64)
    assert got.columns == ["doc.id", "n_words", "runs", "collapsed"]
    by_id = {}
    for row in got.collect():
        by_id[row[0]] = row
    assert len(by_id) == len(rows) == got.count()
    for i, text in enumerate(TEXTS + TEXTS[-2:]):
        words = [w for w in __import__("re").findall(runs.WORD, text or "")]
        number = {w: n for n, w in enumerate(dict.fromkeys(words))}
        expected = by_hand([number[w] for w in words]) if len(words) < 100 else [(1, 15001, 3)]
        row = by_id[i if i else None]
        assert row["n_words"] == len(words)
        assert [tuple(r) for r in row["runs"]] == [(s, e - s, p) for s, e, p in expected]
        gone = {x for s, e, p in expected for x in range(s + p, e)}
        assert row["collapsed"] == " ".join(w for n, w in enumerate(words) if n not in gone)
    assert runs.periodic_runs(table.where("false"), id_col="doc.id").count() == 0
