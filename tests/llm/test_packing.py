"""Packing plans and placed pieces against their definition."""

import inspect
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saldero.llm import packing
from saldero.llm.queries import tokenizer_path

WORD = tokenizer_path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_patterns_use_every_piece_once_and_never_overflow(lengths):
    counts = np.bincount(lengths, minlength=33) if lengths else np.zeros(33, int)
    used = Counter()
    for times, inside in packing.patterns(counts):
        assert sum(n * k for n, k in inside.items()) <= 32
        used.update({n: k * times for n, k in inside.items()})
    assert used == Counter(lengths)


def test_combinations_that_fill_exactly_are_found():
    counts = np.bincount([20, 7, 5, 25, 4, 3, 30, 2, 32, 16, 16], minlength=33)
    found = packing.patterns(counts)
    assert sum(t for t, _ in found) == 5
    assert all(sum(n * k for n, k in inside.items()) == 32 for _, inside in found)


def test_many_equal_pieces_make_one_pattern():
    counts = np.zeros(4097, int)
    counts[1000] = 4_000_000
    assert packing.patterns(counts) == [(1_000_000, {1000: 4})]


def test_every_token_has_a_place_of_its_own(spark):
    texts = [None, "", "one", "one", "word, " * 60, "tion " * 25, "x y", "a b c d e f"] * 3
    rows = [(i % 20 if i else None, t, 1, "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int, start string")
    placed = packing.pack_documents(df, WORD, capacity=32).collect()
    tokenizer = Tokenizer.from_file(WORD)
    expected = Counter()
    for (doc, text, *_), _ in zip(rows, texts, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 32)):
            part = np.array(ids[start : start + 32], "<u4")
            expected[doc, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r[0], *r[1:5]) for r in placed) == expected
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 32
    total = sum(r["length"] for r in placed)
    assert len(sequences) <= -(-total // 32) + 1


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(none, WORD).count() == 0


def test_slices_are_small_beside_the_memory_of_a_task():
    """A slice of 16 MB took 146 MB more of a worker than one of 4 MB."""
    assert inspect.signature(packing.token_pieces).parameters["slice_bytes"].default <= 4 << 20
