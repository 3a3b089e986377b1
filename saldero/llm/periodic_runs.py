"""Runs of words that repeat with a period, found by block convolution.

A run is a stretch of words with smallest period q, at least ``repeats`` * q
and ``least`` words long, that no neighbouring word extends. At scale B, a
power of two, the text is cut into blocks of B words. A run of a period from B
up to 2B - 1 holds two whole blocks in a row, each of which comes again at the
distance q. For the squared differences of a block and the window that follows
it, summed at every distance, an exact integer number-theoretic transform is
taken: where the sum is zero, the block occurs. Distances seen at two blocks in
a row are the seeds; a seed is extended in both directions to its maximal
stretch. A block in which some word does not come again within 2B - 1 words
cannot lie at the beginning of a run of that scale and is left out beforehand.

The texts of a slice of a batch are treated as one sequence, with a word of its
own between any two, so that short texts share the transforms.

Defined results:

- a null or empty text, or one of white space only, has no words and no runs;
- a null id is passed on like any other value, repeated rows are texts of their own;
- an empty table gives an empty result; other columns are not read;
- a text of any length is treated whole, in one task, at some 100 bytes a word;
- of the stretches of several periods over the same words only the smallest period counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import byte_slices, list_array, quoted

WORD = r"[^\x20\x09-\x0D]+"
# Primes with many powers of two in p - 1, both with the generator 3.
PRIMES = (998244353, 469762049)
_GENERATOR = 3
# Numbers that one transform holds at once.
_CELLS = 1 << 19


def _powers(base: int, count: int, prime: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), doubled from one."""
    powers = np.ones(1, np.uint64)
    while len(powers) < count:
        step = np.uint64(pow(base, len(powers), prime))
        powers = np.concatenate([powers, powers * step % np.uint64(prime)])
    return powers[:count]


class Transform:
    """Cyclic convolutions of ``size`` numbers modulo one prime, over rows."""

    def __init__(self, size: int, prime: int):
        self.size, self.prime = size, np.uint64(prime)
        self.shrink = np.uint64(pow(size, prime - 2, prime))
        self.turns, self.turns_back = {}, {}
        half = size // 2
        while half >= 1:
            root = pow(_GENERATOR, (prime - 1) // (2 * half), prime)
            self.turns[half] = _powers(root, half, prime)
            self.turns_back[half] = _powers(pow(root, prime - 2, prime), half, prime)
            half //= 2

    def _sum(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = a + b
        # the smaller one of a wrapped difference is the remainder
        return np.minimum(total, total - self.prime)

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """The transform in bit-reversed order, in place."""
        half = self.size // 2
        while half >= 1:
            v = rows.reshape(len(rows), -1, 2, half)
            low, high = v[:, :, 0].copy(), v[:, :, 1].copy()
            v[:, :, 0] = self._sum(low, high)
            v[:, :, 1] = (low + (self.prime - high)) * self.turns[half] % self.prime
            half //= 2
        return rows

    def backward(self, rows: np.ndarray) -> np.ndarray:
        half = 1
        while half < self.size:
            v = rows.reshape(len(rows), -1, 2, half)
            low, high = v[:, :, 0].copy(), v[:, :, 1] * self.turns_back[half] % self.prime
            v[:, :, 0] = self._sum(low, high)
            v[:, :, 1] = self._sum(low, self.prime - high)
            half *= 2
        return rows * self.shrink % self.prime

    def convolve(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.backward(self.forward(a) * self.forward(b) % self.prime)


def occurrences(words: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance): where the block at ``start`` comes again, ``block`` to 2 * block - 1 words on.

    ``words`` are numbers from 0 that go on for 3 * block words after each start.
    """
    top = int(words.max(initial=0))
    # a sum of squares below the product of the primes is zero if it is so modulo each
    primes = PRIMES[:1] if block * top * top < PRIMES[0] else PRIMES
    if block * top * top >= PRIMES[0] * PRIMES[1]:
        raise OverflowError("more distinct words than the transforms can tell apart")
    transforms = [Transform(2 * block, p) for p in primes]
    found_at, found_far = [], []
    step = max(1, _CELLS // (2 * block))
    for begin in range(0, len(starts), step):
        at = starts[begin : begin + step]
        blocks = words[at[:, None] + np.arange(block)].astype(np.uint64)
        windows = words[at[:, None] + np.arange(block, 3 * block)].astype(np.uint64)
        own = (blocks * blocks).sum(axis=1, keepdims=True)
        running = np.cumsum(windows * windows, axis=1)
        running = np.concatenate([np.zeros((len(at), 1), np.uint64), running], axis=1)
        squares = own + running[:, block : 2 * block] - running[:, :block]
        same = np.ones((len(at), block), bool)
        for transform in transforms:
            reverse = np.zeros((len(at), 2 * block), np.uint64)
            reverse[:, :block] = blocks[:, ::-1]
            products = transform.convolve(reverse % transform.prime, windows % transform.prime)
            products = products[:, block - 1 : 2 * block - 1]
            same &= squares % transform.prime == products * np.uint64(2) % transform.prime
        row, lag = np.nonzero(same)
        found_at.append(at[row])
        found_far.append(lag + block)
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_far)


class Stretches:
    """How far words go on equal to those a distance away, by hashes of all prefixes."""

    def __init__(self, words: np.ndarray, longest: int):
        draw = np.random.default_rng(12)
        values = draw.integers(0, 2**64, int(words.max(initial=0)) + 1, np.uint64)
        factor = np.full(len(words) + 1, 0x9E3779B97F4A7C15, np.uint64)
        factor[0] = 1
        self.words, self.powers = words, np.cumprod(factor)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[words] * self.powers[:-1])])
        self.steps = [1 << k for k in range(max(1, longest).bit_length(), -1, -1)]

    def _equal(self, at: np.ndarray, far: np.ndarray, length: int) -> np.ndarray:
        here = self.sums[at + length] - self.sums[at]
        there = self.sums[at + far + length] - self.sums[at + far]
        return here * self.powers[far] == there

    def _exact(self, begin: int, end: int, far: int) -> bool:
        """Whether all words from ``begin`` to ``end`` equal those ``far`` on, and not one more."""
        w = self.words
        return (
            np.array_equal(w[begin:end], w[begin + far : end + far])
            and (begin == 0 or w[begin - 1] != w[begin + far - 1])
            and (end + far >= len(w) or w[end] != w[end + far])
        )

    def extend(self, at: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of the equal words around each seed, compared with those ``far`` on."""
        begin, end, n = at.copy(), at.copy(), len(self.words)
        for step in self.steps:
            ok = np.flatnonzero(end + far + step <= n)
            ok = ok[self._equal(end[ok], far[ok], step)]
            end[ok] += step
            ok = np.flatnonzero(begin >= step)
            ok = ok[self._equal(begin[ok] - step, far[ok], step)]
            begin[ok] -= step
        return begin, end

    def exact(self, begin: np.ndarray, end: np.ndarray, far: np.ndarray, at: np.ndarray) -> None:
        """Set right, word by word, what a collision of hashes may have stretched or cut."""
        w = self.words
        for i in range(len(begin)):
            if not self._exact(int(begin[i]), int(end[i]), int(far[i])):
                left = right = int(at[i])
                d = int(far[i])
                while left > 0 and w[left - 1] == w[left + d - 1]:
                    left -= 1
                while right + d < len(w) and w[right] == w[right + d]:
                    right += 1
                begin[i], end[i] = left, right


def find_runs(words: np.ndarray, longest: int, repeats: int = 4, least: int = 6) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period.

    ``longest`` bounds the length of a run. ``repeats`` is 4 at least: a shorter
    run need not hold two whole blocks.
    """
    if repeats < 4:
        raise ValueError("runs of fewer than four periods are not found by blocks")
    n, none = len(words), np.zeros((0, 3), np.int64)
    if n == 0 or longest < least:
        return none
    order = np.argsort(words, kind="stable")
    gap = np.full(n, n, np.int64)
    again = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    top = int(words.max()) + 1
    stretches, found, block, widest = Stretches(words, longest), [none], 1, gap
    while repeats * block <= longest:
        starts = np.flatnonzero(widest < 2 * block) * block
        if len(starts):
            padded = np.concatenate([words, np.full(3 * block, top, words.dtype)])
            at, far = occurrences(padded, starts, block)
            at, far = _first_of_chains(at, far, block)
            begin, end = stretches.extend(at, far)
            keep = end - begin + far >= np.maximum(least, repeats * far)
            at, far, begin, end = at[keep], far[keep], begin[keep], end[keep]
            _, once = np.unique(np.stack([begin, end, far]), axis=1, return_index=True)
            at, far, begin, end = at[once], far[once], begin[once], end[once]
            stretches.exact(begin, end, far, at)
            keep = end - begin + far >= np.maximum(least, repeats * far)
            found.append(np.stack([begin, end + far, far], axis=1)[keep])
        pairs = len(widest) // 2
        widest = np.maximum(widest[: 2 * pairs : 2], widest[1 : 2 * pairs : 2])
        block *= 2
    runs = np.concatenate(found)
    # multiples of a period give the same stretch; the smallest comes first
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _first_of_chains(at: np.ndarray, far: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Of seeds of one distance at blocks in a row, the first, where two or more are in a row."""
    order = np.lexsort((at, far))
    at, far = at[order], far[order]
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = (far[1:] == far[:-1]) & (at[1:] - at[:-1] == block)
    heads = np.flatnonzero(~goes_on)
    longer = np.diff(np.append(heads, len(at))) >= 2
    return at[heads[longer]], far[heads[longer]]


def _word_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of the words of each text, and the words of all."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = split.offsets.to_numpy().astype(np.int64)
    pieces = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    filled = pc.not_equal(pieces, "")
    before = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    return before[offsets - offsets[0]], pieces.filter(filled)


def runs_of_texts(texts: pa.Array, repeats: int, least: int) -> dict[str, pa.Array]:
    """The runs of each text and the text without their repetitions."""
    offsets, words = _word_lists(texts)
    encoded = words.dictionary_encode()
    numbers, distinct = encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary)
    rows = len(offsets) - 1
    text_of = np.repeat(np.arange(rows), np.diff(offsets))
    # one word of its own behind each text
    places = np.arange(len(numbers)) + text_of
    joined = np.empty(len(numbers) + rows, np.int64)
    joined[places] = numbers
    ends = offsets[1:] + np.arange(rows)
    joined[ends] = distinct + np.arange(rows)
    runs = find_runs(joined, int(np.diff(offsets).max(initial=0)), repeats, least)
    run_text = np.searchsorted(ends, runs[:, 0], side="right")
    starts = runs[:, 0] - (offsets[:-1] + np.arange(rows))[run_text]
    change = np.zeros(len(joined) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = (np.cumsum(change)[:-1] == 0)[places]
    kept_before = np.concatenate(([0], np.cumsum(kept)))[offsets]
    kept_words = pa.ListArray.from_arrays(
        pa.array(kept_before, pa.int32()), words.filter(pa.array(kept))
    )
    per_text = np.concatenate(([0], np.cumsum(np.bincount(run_text, minlength=rows))))
    lists = {
        "run_starts": starts,
        "run_lengths": runs[:, 1] - runs[:, 0],
        "run_periods": runs[:, 2],
    }
    return {
        "n_words": pa.array(np.diff(offsets), pa.int64()),
        **{name: list_array(v, per_text, pa.int64()) for name, v in lists.items()},
        "collapsed": pc.binary_join(kept_words, pa.scalar(" ", words.type)).cast(pa.string()),
    }


def periodic_runs(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text: Column | None = None,
    repeats: int = 4,
    least: int = 6,
    slice_bytes: int = 2 << 20,
) -> DataFrame:
    """Per row: ``id_col``, n_words, runs and collapsed.

    ``runs`` has structs (start, length, period) by start and period, in words
    from 0. ``collapsed`` has the words that are in no run behind its first
    period, joined by one blank. ``text`` is the column ``text`` by default.
    """
    texts = (F.col("text") if text is None else text).cast("string").alias("text")
    names = ("run_starts", "run_lengths", "run_periods")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, 1, slice_bytes):
                found = runs_of_texts(rows.column(1), repeats, least)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *found.values()], names=["id", *found]
                )
        pa.default_memory_pool().release_unused()

    chosen = df.select(F.col(quoted(id_col)).alias("id"), texts)
    kind = chosen.schema["id"].dataType.simpleString()
    lists = ", ".join(f"{n} array<long>" for n in names)
    found = chosen.mapInArrow(find, f"id {kind}, n_words long, {lists}, collapsed string")
    zipped = F.arrays_zip(*names)
    runs = zipped.cast("array<struct<start:long,length:long,period:long>>")
    return found.select(F.col("id").alias(id_col), "n_words", runs.alias("runs"), "collapsed")
