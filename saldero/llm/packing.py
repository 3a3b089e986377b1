"""Packing token sequences into sequences of a fixed capacity.

The plan depends only on how many pieces have each length, a table with at most
``capacity`` rows. It opens sequences with the longest piece left and looks up
its gap in indexes of single, pair and triple length sums; a combination that
fills the gap exactly is used as often as its lengths are available. A gap that
no combination fills takes the longest piece that fits and is looked up again.
Each step uses up at least one length, so the plan stays as small as the table.

Pieces find their place by their rank among the pieces of equal length. Ranks
are counted inside each task and shifted by the counts of the tasks before, so
that a length shared by most pieces is never sorted or gathered in one place.

A null text is empty; every document has at least the closing token. Repeated
rows are packed once each, ties of length are taken in table order, null ids
are carried along. Extra columns are not returned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import vocabulary
from .frames import byte_slices, staged

_RANK_BITS = 42


class _Sums:
    """Lengths still available, looked up by the sums that one, two or three of them make."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.capacity = len(counts) - 1
        self._index()

    def _index(self) -> None:
        self.single = self.left > 0
        self.single[0] = False
        size = 2 * len(self.left)
        spectrum = np.fft.rfft(self.single.astype(float), size)
        self.pair = np.fft.irfft(spectrum**2, size) > 0.5
        self.stale = False

    def take(self, length: int, times: int = 1) -> None:
        self.left[length] -= times
        self.stale |= self.left[length] <= 0 or times < 0

    def longest(self, at_most: int) -> int:
        found = np.flatnonzero(self.left[1 : at_most + 1])
        return int(found[-1]) + 1 if len(found) else 0

    def _pair_for(self, gap: int) -> tuple[int, ...]:
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        fits = (self.left[longer] > 0) & (self.left[gap - longer] > 0)
        fits &= (2 * longer != gap) | (self.left[longer] > 1)
        found = np.flatnonzero(fits)
        return (int(longer[found[0]]), gap - int(longer[found[0]])) if len(found) else ()

    def exact(self, gap: int) -> tuple[int, ...]:
        """One, two or three available lengths whose sum is ``gap``; the longest first."""
        if self.left[gap] > 0:
            return (gap,)
        if self.stale:
            self._index()
        if self.pair[gap] and (found := self._pair_for(gap)):
            return found
        for first in np.flatnonzero(self.single[:gap] & self.pair[gap:0:-1])[::-1]:
            if self.left[first] <= 0:
                continue
            self.left[first] -= 1
            found = self._pair_for(gap - int(first))
            self.left[first] += 1
            if found:
                return (int(first), *found)
        return ()


def patterns(counts: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, pieces of each length in one) for pieces counted by length.

    ``counts[n]`` is the number of pieces of length ``n``; the last index is the capacity.
    """
    sums, found = _Sums(counts), []
    while opening := sums.longest(sums.capacity):
        inside, gap = Counter(), sums.capacity
        filling: tuple[int, ...] = (opening,)
        while filling:
            for length in filling:
                inside[length] += 1
                sums.take(length)
                gap -= length
            if not gap:
                break
            best_fit = sums.longest(gap)
            filling = sums.exact(gap) or ((best_fit,) if best_fit else ())
        again = min(int(sums.left[n]) // k for n, k in inside.items())
        for length, times in inside.items():
            sums.take(length, times * again)
        found.append((1 + again, dict(inside)))
    return found


@dataclass(frozen=True)
class Plan:
    """Rank ranges of each length with the sequences and offsets they go to."""

    keys: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray
    per_sequence: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Plan:
        rows, used, sequence = [], Counter(), 0
        for times, inside in patterns(counts):
            offset = 0
            for length, k in inside.items():
                rows.append(((length << _RANK_BITS) + used[length], sequence, offset, k))
                used[length] += k * times
                offset += k * length
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(*table.T)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the piece with each length and rank."""
        key = (length << _RANK_BITS) + rank
        row = np.searchsorted(self.keys, key, side="right") - 1
        nth = key - self.keys[row]
        sequence = self.first_sequence[row] + nth // self.per_sequence[row]
        return sequence, self.offset[row] + nth % self.per_sequence[row] * length


def token_pieces(
    df: DataFrame,
    vocabulary_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    closing_id: int = 1,
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """The pieces of every text's tokens with the checksum of their ids.

    ``task`` and ``nth`` number the pieces of one length inside one task.
    """
    source = df.select(
        F.spark_partition_id().alias("task"),
        F.col(id_col).alias("id"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    longs = ("piece", "start", "length", "ids_crc32", "nth")
    schema = T.StructType(
        [*source.schema.fields[:2], *[T.StructField(n, T.LongType()) for n in longs]]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in byte_slices(batch, 2, slice_bytes):
                ids, offsets = words.encode_texts(rows.column(2))
                total = np.diff(offsets) + 1
                n_pieces = -(-total // capacity)
                owner = np.repeat(np.arange(rows.num_rows), n_pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(total[owner] - start, capacity)
                closed = np.insert(ids, offsets[1:], closing_id).astype("<u4")
                first = offsets[owner] + owner + start
                crc = [
                    zlib.crc32(closed[f : f + n].data)
                    for f, n in zip(first.tolist(), length.tolist(), strict=True)
                ]
                nth = np.empty(len(owner), np.int64)
                for i, n in enumerate(length.tolist()):
                    nth[i] = seen[n]
                    seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(owner)),
                        rows.column(1).take(pa.array(owner)),
                        *[pa.array(x, pa.int64()) for x in (piece, start, length, crc, nth)],
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``sequence_id`` and ``offset`` for the stored pieces of ``token_pieces``."""
    by_task = staged(
        pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths"
    )
    counts = np.zeros(capacity + 1, np.int64)
    # one row per length, capacity rows at most
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    plan = Plan.of(counts)

    tasks_before = (
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = by_task.select(
        "task", "length", F.coalesce(F.sum("n").over(tasks_before), F.lit(0)).alias("shift")
    )
    ranked = pieces.join(shifts, ["task", "length"]).select(
        "id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("nth") + F.col("shift")).alias("rank"),
    )
    longs = ("sequence_id", "offset")
    schema = T.StructType(
        [*ranked.schema.fields[:5], *[T.StructField(n, T.LongType()) for n in longs]]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            found = plan.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *[pa.array(x, pa.int64()) for x in found]],
                names=schema.names,
            )

    return ranked.mapInArrow(place, schema)


def pack_documents(
    df: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", capacity: int = 4096, **options
) -> DataFrame:
    """Every token of every document in a sequence of at most ``capacity`` tokens."""
    pieces = token_pieces(df, vocabulary_path, id_col=id_col, capacity=capacity, **options)
    # tokens are computed once; ranks must not change between the passes
    return pack(staged(pieces, "pieces"), capacity).withColumnRenamed("id", id_col)
