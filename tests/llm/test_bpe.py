"""Encoders against the library, piece by piece and as Spark operators."""

import functools
import json

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saldero.llm import token_counts, tree_bpe
from saldero.llm.bpe import vocabulary
from saldero.llm.queries import tokenizer_path

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
HARD = [
    None,
    "",
    "  \n\t ",
    "don't I'll ''' we'res x'y it''s !!'s",
    "a<|endoftext|>b<|startoftext|>  c <|ENDOFTEXT|>",
    "日本語 İstanbul Ωσς é J̌ ŉ",
    "Straße ſ ÀÉ — “q” … 1234 a1b2 ²¼ \x85 x \x1c y",
    "ab" * 9000 + "'s" + "!?" * 5000 + "7" * 300,
    "word, " * 5000,
]


tokenizer = functools.lru_cache(Tokenizer.from_file)


def library(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_entry_alone_is_itself(path):
    """What makes merging by rank equal to merging by listed pairs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    entries = spec["model"]["vocab"]
    bare = dict(spec, normalizer=None, pre_tokenizer=None, added_tokens=[])
    plain = json.loads(json.dumps(bare))
    plain["model"]["end_of_word_suffix"] = None
    with_end, without = (Tokenizer.from_str(json.dumps(x)) for x in (bare, plain))
    special = {t["id"] for t in spec["added_tokens"]}
    for token, number in entries.items():
        if number in special:
            continue
        ends = token.endswith("</w>")
        model = with_end if ends else without
        letters = token.removesuffix("</w>") if ends else token
        assert [t.id for t in model.model.tokenize(letters)] == [number], token


def test_bulk_encoding_equals_the_library():
    ids, offsets = vocabulary(WORD).encode_texts(pa.array(HARD))
    found = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert found == [library(WORD, t) for t in HARD]


def tree_encoded(text, leaf_chars):
    words = vocabulary(WORD)
    glued, texts, parts = [], [], []
    for joined, part, special in tree_bpe.leaves(words, text, leaf_chars):
        ids = np.array([special], np.int32)
        if special < 0:
            ids, _ = words.encode_texts(pa.array([part]), normalised=True)
        glued.append(joined)
        texts.append(part)
        parts.append(ids)
    return tree_bpe.joined(words, glued, texts, parts).tolist() if parts else []


words_and_noise = st.lists(
    st.one_of(
        st.text("abcehinorst", max_size=12),
        st.text("'slvremtd ", max_size=6),
        st.text("!?.-_#", max_size=5),
        st.text("0123456789 \n", max_size=4),
        st.sampled_from(["the", " ", "tion", "é", "ß", "日", "<|endoftext|>", "ing", "Ⅷ", "é"]),
    ),
    max_size=30,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(words_and_noise, st.integers(1, 9))
def test_tree_concatenation_is_exact(text, leaf_chars):
    assert tree_encoded(text, leaf_chars) == library(WORD, text)


@settings(max_examples=60, deadline=None)
@given(st.text("abcdeinrst", min_size=1, max_size=40), st.integers(60, 200), st.integers(200, 700))
def test_endless_words_are_joined_entry_by_entry(unit, times, leaf_chars):
    text = unit * times
    assert tree_encoded(text, leaf_chars) == library(WORD, text)


def test_long_window_grows_to_the_whole_word():
    words = vocabulary(WORD)
    whole = "a" * 3000
    left, right = (words.encode_texts(pa.array([x]))[0] for x in (whole[:1501], whole[1501:]))
    assert tree_bpe.join(words, whole, 1501, left, right).tolist() == library(WORD, whole)


CONTRACTIONS = ["we'll", "they're", "I've", "it's", "isn't", "I'm", "he'd", "'ll", "a''ll", "x 'll"]


@pytest.mark.parametrize("said", CONTRACTIONS)
def test_every_cut_inside_a_contraction(said):
    """Cut at every place, between words that adjoin and words that stand apart."""
    words = vocabulary(WORD)
    for text in (f"{said} you", f"do {said} you", f"one two three four {said}r you 'l l 're", f"{said}{said}"):
        for cut in range(1, len(text)):
            if text[cut - 1].isspace() or text[cut].isspace():
                continue
            normal = words.library.normalizer.normalize_str(text)
            sides = [words.encode_texts(pa.array([x]), normalised=True)[0] for x in (normal[:cut], normal[cut:])]
            assert tree_bpe.join(words, normal, cut, *sides).tolist() == library(WORD, text), (text, cut)


@pytest.mark.parametrize("leaf_chars", [1, 2, 3, 5, 8, 13])
@pytest.mark.parametrize("said", CONTRACTIONS)
def test_contractions_at_several_leaf_sizes(said, leaf_chars):
    for text in (f"{said} you " * 9, said * 7, f"so {said}, {said}; 'l l 're 'v e"):
        assert tree_encoded(text, leaf_chars) == library(WORD, text)


contracted = st.lists(
    st.sampled_from([*CONTRACTIONS, "'", "l", "r", "e", "v", " ", "  ", "\n", "re", "ve", "ll", ".", "1"]),
    min_size=1,
    max_size=25,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(contracted, st.integers(1, 7))
def test_forced_cuts_in_contracted_texts(text, leaf_chars):
    assert tree_encoded(text, leaf_chars) == library(WORD, text)


def rows(spark, texts):
    data = [(i if i != 2 else None, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, ids string, row int")


def test_encode_and_decode_whole_texts(spark):
    texts = HARD + HARD[3:4]
    encoded = tree_bpe.encode(rows(spark, texts), WORD, keep=["doc_id", "row", "ids"], leaf_chars=500)
    found = {r["row"]: r for r in tree_bpe.decode(encoded, WORD).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = library(WORD, text)
        assert found[i]["token_ids"] == ids
        assert found[i]["decoded"] == tokenizer(WORD).decode(ids, skip_special_tokens=False)
        assert found[i]["ids"] == "x"


def test_encode_empty_table(spark):
    none = rows(spark, HARD).where("false")
    assert tree_bpe.decode(tree_bpe.encode(none, WORD, keep=["doc_id"]), WORD).count() == 0
    assert token_counts.count_tokens(none, BYTE).count() == 0


def test_decode_of_a_null_list_is_empty(spark):
    ids = spark.createDataFrame([(1, None), (2, [49407])], "doc_id long, token_ids array<int>")
    found = tree_bpe.decode(ids, WORD).orderBy("doc_id").collect()
    assert [r["decoded"] for r in found] == ["", "<|endoftext|>"]


def test_counts_equal_the_library(spark):
    texts = [*HARD, "a  b\n\n c<|endoftext|>x \t\t\n  日 ", *HARD[-2:]]
    found = token_counts.count_tokens(rows(spark, texts), BYTE, long_chars=400, slice_bytes=1000)
    kept = sorted((r["n_bytes"], r["n_tokens"]) for r in found.collect())
    expected = [(len((t or "").encode()), len(library(BYTE, t))) for t in texts]
    assert kept == sorted(expected)
    assert found.where(F.col("doc_id").isNull()).count() == 1


@settings(max_examples=200, deadline=None)
@given(st.text("ab '.!1\n\t ", max_size=60), st.integers(1, 20))
def test_pieces_end_where_no_token_spans(text, size):
    pieces = list(token_counts.safe_pieces(text, size))
    assert "".join(pieces) == text
    assert sum(len(library(BYTE, p)) for p in pieces) == len(library(BYTE, text))
