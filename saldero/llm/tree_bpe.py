"""BPE encoding by tree concatenation, and decoding.

Short texts are encoded in bulk. A long text is halved until its parts are
short, without regard to words; the parts are encoded in parallel wherever
Spark places them. The parts of one text then meet, and neighbours are joined
up the tree. A join encodes again a window of the text around the cut, where
words stand apart or adjoin as they did, and widens it until its first word agrees with the left side and its last word with the right one:
words are matched from left to right without looking back, so two matches that
begin at one place go on alike. Inside one endless word the window consists of
entries instead: a sequence of entries is the encoding if each pair of
neighbours is, and both ends of an agreeing window repeat known pairs.

Null and empty texts get no ids. Rows are independent, so ties and repeated
rows need no rule. Works for vocabularies that mark the end of a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import WORD_END, Vocabulary, vocabulary
from .frames import byte_slices, list_array, quoted

_IDS = T.ArrayType(T.IntegerType())
# A word from this length on is joined entry by entry.
_LONG_WORD = 1024


def halves(text: str, leaf_chars: int) -> list[str]:
    """The leaves of the tree: the text halved until no part exceeds ``leaf_chars``."""
    if len(text) <= leaf_chars:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf_chars) + halves(text[middle:], leaf_chars)


def leaves(words: Vocabulary, text: str, leaf_chars: int) -> Iterator[tuple[bool, str, int]]:
    """(glued to the part before, normalised text, id of a special token or -1).

    Special tokens split the raw text before it is normalised, as the library
    does. Parts are glued when the cut may lie inside a word.
    """
    begin = 0
    while begin <= len(text):
        found = [(text.find(s, begin), -len(s), s) for s in words.specials]
        at, _, special = min((f for f in found if f[0] >= 0), default=(len(text), 0, ""))
        normalised = words.library.normalizer.normalize_str(text[begin:at])
        last = " "
        for part in halves(normalised, leaf_chars):
            if part:
                yield not (last.isspace() or part[0].isspace()), part, -1
                last = part[-1]
        if not special:
            return
        yield False, "", words.specials[special]
        begin = at + len(special)


def _word_starts(words: Vocabulary, ids: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], words.is_end[ids])))


def _letters(words: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of entries of one word, without the mark of its end."""
    return b"".join(words.bytes_of[int(i)] for i in ids).removesuffix(b" ")


def _one_class(left: str, right: str) -> bool:
    both = left + right
    return both.isalpha() or not any(c.isalpha() or c.isnumeric() for c in both)


def join_word(words: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Entries of one word from those of its two parts, each encoded as a word."""
    width = 4
    while True:
        a, b = max(0, len(left) - width), min(len(right), width)
        window = _letters(words, left[a:]) + _letters(words, right[:b])
        # only the end of the whole word carries the mark
        whole = window + b" " if b == len(right) else window
        ids = np.array(words.merges._encode_single_piece(whole), np.int32)
        agree_left = a == 0 or ids[0] == left[a]
        agree_right = b == len(right) or ids[-1] == right[b - 1]
        if agree_left and agree_right and (a == 0 or len(ids) > 1):
            return np.concatenate([left[:a], ids, right[b:]])
        width *= 2


def _before(text: str, cut: int, letters: str) -> int:
    """Where the last ``letters`` before ``cut`` begin; what lies between words is passed over."""
    for letter in reversed(letters):
        cut -= 1
        while text[cut] != letter:
            cut -= 1
    return cut


def _behind(text: str, cut: int, letters: str) -> int:
    """Where the first ``letters`` from ``cut`` on end."""
    for letter in letters:
        while text[cut] != letter:
            cut += 1
        cut += 1
    return cut


def join(
    words: Vocabulary, text: str, cut: int, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """The encoding of the parts of ``text`` on both sides of ``cut`` from the encodings of both.

    Windows are taken from the text, where words stand as they did: what adjoins
    in it may be one word, such as a contraction, though it was cut in between.
    """
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    begins, ends = _word_starts(words, left)[:-1], _word_starts(words, right)[1:]
    last, first = left[begins[-1] :], right[: ends[0]]
    tail, head = _spelled(words, last), _spelled(words, first)
    # no contraction reaches into words of this length
    if min(len(tail), len(head)) > 8 and len(tail) + len(head) > _LONG_WORD:
        if _one_class(tail, head):
            middle = join_word(words, last, first)
            return np.concatenate([left[: begins[-1]], middle, right[ends[0] :]])
    width = 4
    while True:
        i, j = max(0, len(begins) - width), min(len(ends), width) - 1
        a, b = begins[i], ends[j]
        window = text[
            _before(text, cut, _spelled(words, left[a:])) : _behind(text, cut, _spelled(words, right[:b]))
        ]
        ids, _ = words.encode_texts(pa.array([window]), normalised=True)
        cuts = _word_starts(words, ids)
        next_word = begins[i + 1] if i + 1 < len(begins) else len(left)
        word_before = ends[j - 1] if j else 0
        agree_left = a == 0 or np.array_equal(ids[: cuts[1]], left[a:next_word])
        agree_right = b == len(right) or np.array_equal(ids[cuts[-2] :], right[word_before:b])
        if agree_left and agree_right:
            return np.concatenate([left[:a], ids, right[b:]])
        width *= 2


def _spelled(words: Vocabulary, ids: np.ndarray) -> str:
    """The letters of the words of ids, with nothing between the words."""
    return b"".join(words.bytes_of[int(i)] for i in ids).decode().replace(" ", "")


def tree(words: Vocabulary, texts: list[str], parts: list[np.ndarray]) -> np.ndarray:
    """Adjoining parts joined pair by pair up to one sequence."""
    whole = "".join(texts)
    ends = np.cumsum([len(t) for t in texts]).tolist()
    while len(parts) > 1:
        pairs = [
            join(words, whole, ends[i], *parts[i : i + 2]) for i in range(0, len(parts) - 1, 2)
        ]
        parts, ends = pairs + parts[2 * len(pairs) :], ends[1::2] + ends[2 * len(pairs) :]
    return parts[0]


def joined(
    words: Vocabulary, glued: list[bool], texts: list[str], parts: list[np.ndarray]
) -> np.ndarray:
    """The ids of a text from its parts: a tree for each run of glued ones."""
    runs = [i for i, g in enumerate(glued) if not g or not i]
    ends = [*runs[1:], len(parts)]
    return np.concatenate(
        [tree(words, texts[i:j], parts[i:j]) for i, j in zip(runs, ends, strict=True)]
    )


def encode(
    df: DataFrame,
    vocabulary_path: str,
    *,
    keep: list[str],
    text_col: str = "text",
    ids_col: str = "token_ids",
    leaf_chars: int = 16_384,
) -> DataFrame:
    """The columns ``keep`` and the token ids of every row's whole text.

    A kept column with the name of ``ids_col`` gives way.
    """
    keep = [c for c in keep if c.lower() != ids_col.lower()]
    names = [f"c{i}" for i in range(len(keep))]
    row = F.struct(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, names, strict=True)])
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    source = df.select(row.alias("row"), text.alias("text"))
    row_field = source.schema["row"]
    is_long = F.length("text") > leaf_chars
    with_ids = T.StructType([row_field, T.StructField("ids", _IDS)])
    keyed_fields = [
        T.StructField("key", T.LongType()),
        T.StructField("place", T.IntegerType()),
        row_field,
        T.StructField("glued", T.BooleanType()),
    ]
    leaf = T.StructType(
        [*keyed_fields, T.StructField("text", T.StringType()), T.StructField("special", T.IntegerType())]
    )
    part = T.StructType(
        [*keyed_fields, T.StructField("text", T.StringType()), T.StructField("ids", _IDS)]
    )

    def short_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            for rows in byte_slices(batch, 1):
                ids, offsets = words.encode_texts(rows.column(1))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), list_array(ids, offsets, pa.int32())], names=["row", "ids"]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(leaves(words, batch.column(2)[i].as_py(), leaf_chars))
                found = found or [(False, "", -1)]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take([i] * n),
                        pa.array(range(n), pa.int32()),
                        batch.column(1).take([i] * n),
                        pa.array([f[0] for f in found]),
                        pa.array([f[1] for f in found]),
                        pa.array([f[2] for f in found], pa.int32()),
                    ],
                    names=[f.name for f in leaf.fields],
                )

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            for rows in byte_slices(batch, 4):
                ids, offsets = words.encode_texts(rows.column(4), normalised=True)
                special = rows.column(5).to_numpy()
                if (special >= 0).any():
                    runs = np.split(ids, offsets[1:-1])
                    runs = [r if s < 0 else np.array([s]) for r, s in zip(runs, special, strict=True)]
                    ids = np.concatenate(runs)
                    offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:5], list_array(ids, offsets, pa.int32())],
                    names=[f.name for f in part.fields],
                )

    def join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = batch.column(1)[i].values
                glued = parts.field("glued").to_pylist()
                ids = [x.values.to_numpy() for x in parts.field("ids")]
                whole = joined(words, glued, parts.field("text").to_pylist(), ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1),
                        list_array(whole, np.array([0, len(whole)]), pa.int32()),
                    ],
                    names=["row", "ids"],
                )

    short = source.where(~is_long).mapInArrow(short_texts, with_ids)
    # the key tells repeated rows apart
    keyed = source.where(is_long).select(
        F.monotonically_increasing_id().alias("key"), "row", "text"
    )
    spread = keyed.mapInArrow(cut, leaf).repartition(F.xxhash64("key", "place"))
    gathered = (
        spread.mapInArrow(encode_leaves, part)
        .groupBy("key")
        .agg(
            F.first("row").alias("row"),
            F.sort_array(F.collect_list(F.struct("place", "glued", "text", "ids"))).alias("parts"),
        )
        .select("row", "parts")
    )
    long = gathered.mapInArrow(join_parts, with_ids)
    return short.unionByName(long).select(
        *[F.col(f"row.{n}").alias(c) for c, n in zip(keep, names, strict=True)],
        F.col("ids").alias(ids_col),
    )


def decode(
    df: DataFrame,
    vocabulary_path: str,
    *,
    ids_col: str = "token_ids",
    decoded_col: str = "decoded",
) -> DataFrame:
    """``df`` with the text of its ids, special tokens included.

    A null list of ids gives the empty text; ids outside the vocabulary are an
    error. A column with the name of ``decoded_col`` gives way.
    """
    kept = [c for c in df.columns if c.lower() != decoded_col.lower()]
    # numbered names, because a name with a dot is no reference for a map over batches
    plain = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)])
    schema = T.StructType([*plain.schema.fields, T.StructField("text", T.StringType())])
    at = kept.index(ids_col)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                rows = batch.slice(begin, 1000)
                ids = rows.column(at)
                filled = pa.array(pc.list_value_length(ids).fill_null(0))
                offsets = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
                lists = list_array(ids.flatten().to_numpy(zero_copy_only=False), offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, words.decode(lists).cast(pa.string())],
                    names=[f.name for f in schema.fields],
                )

    return plain.mapInArrow(texts, schema).toDF(*kept, decoded_col)
