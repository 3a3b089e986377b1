"""Byte-pair vocabularies of the ``tokenizers`` JSON format, encoded in bulk.

``tokenizers`` defines the result. Two faster engines serve the ordinary texts:

* Merges run in ``tiktoken``, whose rank table is derived from the JSON. Both
  apply the lowest-ranked merge first, and they agree whenever each vocabulary
  entry, encoded alone, is that one entry: two neighbours that join into an
  entry are then always the pair that its merge names.
* Words are found by Arrow kernels and encoded once per batch.

A text with a character outside a tested range, where Unicode tables of the
libraries could differ, goes to ``tokenizers`` itself, as does one holding the
string of a special token.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: how a word-ending vocabulary marks the last symbol of a word.
WORD_END = "</w>"
# Characters whose case, class and composition all libraries share.
COMMON = r"\t\n\r -~¡-įĲ-ňŊ-ſ‐-‧€"
# Fixed value: what stands apart from letters among those characters, for the
# vocabulary with word ends: contractions, runs of symbols, single digits.
MARKED = (
    r"('(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~¡-©«-±´¶-¸»¿×÷‐-‧€]+|[0-9²³¹¼-¾])"
)
# Fixed value: the words of the byte-level vocabulary.
BYTE_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others follow from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """One vocabulary file with what its encoders need."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_str(json.dumps(spec))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bare = dict(spec, normalizer=None, added_tokens=[])
        self.bare = Tokenizer.from_str(json.dumps(bare))

        entries = spec["model"]["vocab"]
        numbered = entries | self.specials
        self.tokens = [""] * (1 + max(numbered.values(), default=0))
        for token, number in numbered.items():
            self.tokens[number] = token
        self.word_ends = spec["model"]["end_of_word_suffix"] == WORD_END
        special_ids = set(self.specials.values())
        self.is_end = np.array([t.endswith(WORD_END) for t in self.tokens])
        self.is_end[list(special_ids)] = True

        symbols = byte_symbols()
        ranks = {}
        for token, number in entries.items():
            if number in special_ids:
                continue
            ends = self.word_ends and token.endswith(WORD_END)
            letters = token[: -len(WORD_END)] if ends else token
            # white space never reaches the merges, so a blank can mark the word end
            ranks[bytes(symbols[c] for c in letters) + b" " * ends] = number
        self.bytes_of = {number: key for key, number in ranks.items()}
        self.merges = tiktoken.Encoding(
            "merges",
            pat_str=r"[^ ]+ " if self.word_ends else BYTE_WORDS,
            mergeable_ranks=ranks,
            special_tokens={} if self.word_ends else self.specials,
        )
        reserved = "".join(f"|{re.escape(s)}" for s in self.specials)
        self.odd = f"[^{COMMON}]" + (reserved if self.word_ends else "")
        self.odd_python = re.compile(self.odd)

    # Vocabulary with word ends

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole words one after the other, and the number of each word's ids."""
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        line = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
        spaced = pc.binary_join(line, pa.scalar(" ", words.type))[0].as_py()
        ids = self.merges.encode_to_numpy(spaced + " ").astype(np.int32)
        ends = np.flatnonzero(self.is_end[ids])
        return ids, np.diff(ends, prepend=-1).astype(np.int32)

    def encode_texts(
        self, texts: pa.Array, normalised: bool = False
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other and the n+1 offsets of the texts.

        Null counts as empty. ``normalised`` texts are pieces of text that has
        been through the normaliser and holds no special token.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.odd)
        plain = pc.utf8_lower(pc.if_else(odd, "", texts))
        spaced = pc.replace_substring_regex(plain, MARKED, r" \1 ")
        split = pc.ascii_split_whitespace(spaced)
        offsets = split.offsets.to_numpy().astype(np.int64)
        words = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        filled = pc.not_equal(words, "")
        before = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
        offsets = before[offsets - offsets[0]]
        encoded = words.filter(filled).dictionary_encode()
        ids, counts = self.encode_words(encoded.dictionary)
        codes = encoded.indices.to_numpy()
        flat, ends = gather(ids, counts, codes)
        offsets = ends[offsets].astype(np.int64)
        where = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(where):
            return flat, offsets
        library = self.bare if normalised else self.library
        own = library.encode_batch_fast(texts.take(where).to_pylist(), add_special_tokens=False)
        return _put(flat, offsets, where, [np.array(e.ids, np.int32) for e in own])

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts as the library decodes ids without a decoder: entries joined by blanks."""
        entries = pa.array(self.tokens, pa.large_string())
        offsets = ids.offsets
        flat = entries.take(ids.values.slice(0, offsets[-1].as_py()))
        lists = pa.LargeListArray.from_arrays(offsets.cast(pa.int64()), flat)
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    # Byte-level vocabulary

    def count(self, texts: list[str]) -> list[int]:
        """Number of ids of each text, special strings taken as special tokens."""
        odd = [bool(self.odd_python.search(t)) for t in texts]
        own = iter(
            self.library.encode_batch_fast(
                [t for t, o in zip(texts, odd, strict=True) if o], add_special_tokens=False
            )
        )
        encode = self.merges.encode_to_numpy
        return [
            len(next(own).ids) if o else encode(t, allowed_special="all").size
            for t, o in zip(texts, odd, strict=True)
        ]


def gather(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray):
    """The id runs named by ``codes`` one after the other, and where each begins (n+1)."""
    starts = np.cumsum(counts, dtype=np.int32) - counts
    lengths = counts[codes]
    ends = np.zeros(len(codes) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    where = np.repeat(starts[codes] - ends[:-1], lengths)
    where += np.arange(ends[-1], dtype=np.int32)
    return ids[where], ends


def _put(flat, offsets, where, runs):
    """``flat`` with the empty runs at ``where`` replaced by ``runs``."""
    parts, last = [], 0
    extra = np.zeros(len(offsets), np.int64)
    for i, run in zip(where, runs, strict=True):
        parts += [flat[last : offsets[i]], run]
        last = offsets[i]
        extra[i + 1] = len(run)
    return np.concatenate([*parts, flat[last:]]), offsets + np.cumsum(extra)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, read once per process."""
    return Vocabulary(path)
