"""Near duplicates by MinHash bands, sequential Bayesian pruning and exact sets.

Documents with one shingle set are one node. Nodes that share a band of their
signatures are candidates. Shingles that very many nodes hold, counted over all
documents, say little: bands are taken from the other shingles, so that a
passage in thousands of documents makes no candidates of them. How alike
those others must be follows from the share of frequent shingles, and with it
the number of rows in a band; documents made up of frequent shingles are banded
whole. The counts only guide the search: links are decided on whole sets.

First every member of a bucket meets the smallest
node of the bucket, so a bucket costs as many pairs as it has members. Only
members of one bucket that are still in different components then meet each
other: a pair inside a component could add nothing. Documents made up of frequent shingles can come in large families
that almost reach the threshold; a family is cut into blocks, and each task
compares two blocks and returns no more links than join their components.
Members of one family have all been compared there and do not meet in other
buckets. A bucket of one rare shingle has fewer members than make a shingle
frequent, as long as no more than ``most_frequent`` are.

A pair's signatures are compared batch by batch. After each batch the pair is
dropped when the posterior probability of a similarity at or above the
threshold, from a uniform prior, is below ``miss``. Survivors are confirmed on
the full shingle sets.

A pair of equal sizes exactly at the threshold of 0.75 is missed by all bands
with probability 2e-14 without frequent shingles, 1e-5 where half of them are
frequent, and 2e-6 where nearly all are; at 0.8 these are 1e-18, 2e-7 and 5e-9.
Where the other shingles have less than a fifteenth in common, the frequent ones
must make up at least 0.72 of both, and the bands of whole sets find the pair.

Texts without words, empty and null ones are linked with nothing. Rows with a
null id are never linked and always kept; rows with one id are one document.
Equal sets belong together whatever the texts. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import byte_slices, staged
from .graph import components

# Bits of the filter on asked ids.
_PLACES = 2**20
# Hashes that a task packs at once, and low bits of their upper halves that share one place.
_PACKED = 2**21
_UNPLACED = 6
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Banding:
    """Bands of rare shingles for documents whose share of frequent ones lies in a range."""

    least: float
    most: float
    bands: int
    rows: int


@dataclass(frozen=True)
class Settings:
    """Threshold as a fraction of whole percents, and the shape of the search.

    A shingle is frequent if at least ``frequent * sampled`` distinct sets hold
    it, counted over all documents; the ``most_frequent`` of them are known.
    The ranges overlap, because linked documents may differ in their shares: at
    a similarity of 0.75 one of more than a half is linked with 1/3 at the least,
    reached where the one adds only frequent shingles to the other, and one of
    more than 0.7 with 0.525, reached where the one drops only rare ones. Single
    rows make many candidates, so they begin no lower than that needs: where
    both shares are 0.7 or less, at least 0.355 of the rare shingles are common
    and bands of two rows miss a pair with probability 1e-7.
    """

    words: int = 5
    percent: int = 75
    hashes: int = 240
    banding: tuple[Banding, ...] = (
        Banding(0.0, 0.5, bands=60, rows=3),
        Banding(0.33, 0.7, bands=120, rows=2),
        Banding(0.52, 1.0, bands=240, rows=1),
    )
    whole: Banding = Banding(0.7, 1.0, bands=48, rows=5)
    block: int = 4096
    block_bytes: int = 32 << 20
    sampled: int = 16
    frequent: int = 8
    most_frequent: int = 200_000
    batch: int = 40
    miss: float = 1e-9
    seed: int = 20

    def least_matches(self) -> list[tuple[int, int]]:
        """(hashes compared, fewest matches that keep a pair) after each batch.

        With ``m`` matches of ``n`` and a uniform prior, the posterior of a
        similarity of at least ``t`` is the chance of ``m`` or fewer successes
        in ``n + 1`` trials of chance ``t``.
        """
        t, steps = self.percent / 100, []
        for n in range(self.batch, self.hashes + 1, self.batch):
            chance, m = 0.0, -1
            while chance < self.miss:
                m += 1
                chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            steps.append((n, m))
        return steps


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles.

    Words are runs without ASCII white space, with A to Z in lower case.
    """
    lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.ascii_split_whitespace(lower)
    offsets = split.offsets.to_numpy().astype(np.int64)
    pieces = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    filled = pc.not_equal(pieces, "")
    before = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    offsets = before[offsets - offsets[0]]
    encoded = pieces.filter(filled).dictionary_encode()
    unique = [xxhash.xxh3_64_intdigest(w) for w in encoded.dictionary.to_pylist()]
    hashes = np.array(unique, np.uint64)[encoded.indices.to_numpy()]
    chained = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        chained = chained * _MULTIPLIER + hashes[i : i + len(chained)]
    chained = _mixed(chained)
    sets = []
    for begin, end in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
        if end - begin >= words:
            sets.append(np.unique(chained[begin : end - words + 1]))
        elif end > begin:
            # the whole of a short text; its length keeps it apart from longer ones
            one = np.uint64(end - begin)
            for h in hashes[begin:end]:
                one = np.uint64((int(one) * int(_MULTIPLIER) + int(h)) % 2**64)
            sets.append(_mixed(np.array([one], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signature(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value under each of the random permutations."""
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i : i + 512] * factors + shifts).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, kind: int, banding: Banding) -> np.ndarray:
    """One 64-bit key for each band, distinct between bands and kinds of banding."""
    used = low[: banding.bands * banding.rows].astype(np.uint64)
    keys = np.arange(banding.bands, dtype=np.uint64) + np.uint64(kind << 32)
    for column in used.reshape(banding.bands, banding.rows).T:
        keys = _mixed(keys * _MULTIPLIER + column)
    return keys


class Profiler:
    """Signature and band keys of shingle sets."""

    def __init__(self, settings: Settings, frequent: np.ndarray):
        draw = np.random.default_rng(settings.seed)
        self.factors = draw.integers(0, 2**31, settings.hashes, np.uint32) * 2 + 1
        self.shifts = draw.integers(0, 2**32, settings.hashes, np.uint32)
        self.settings, self.frequent = settings, frequent

    def __call__(self, hashes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray | None]:
        """16 bits of each part of the whole set's signature, and both kinds of keys."""
        known = np.isin(hashes, self.frequent, assume_unique=True)
        whole = signature(hashes, self.factors, self.shifts)
        rest, share = whole, known.mean()
        if 0 < share < 1:
            rest = signature(hashes[~known], self.factors, self.shifts)
        keys = [
            band_keys(rest, kind, banding)
            for kind, banding in enumerate(self.settings.banding)
            if banding.least <= share <= banding.most and share < 1
        ]
        family = None
        if share >= self.settings.whole.least:
            family = band_keys(whole, len(self.settings.banding), self.settings.whole)
            family = family.view(np.int64)
        keys = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
        return (whole ^ (whole >> 16)).astype("<u2").tobytes(), keys, family


def _hash_lists(rows: pa.RecordBatch, settings: Settings) -> tuple[list[np.ndarray], pa.Array]:
    """The shingle sets of (id, text) rows, also as an Arrow list column."""
    sets = shingle_sets(rows.column(1), settings.words)
    values = pa.concat_arrays([pa.array(s.view(np.int64)) for s in sets])
    offsets = np.cumsum([0, *map(len, sets)])
    return sets, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _packed(sets: list[np.ndarray], least: int) -> pa.RecordBatch:
    """(bucket, low): the upper halves of all hashes, by their first 16 bits.

    No value comes more than ``least`` times, so a shingle in all documents
    costs a task no more than one in ``least`` of them.
    """
    values = np.sort(np.concatenate(sets))
    keep = np.ones(len(values), bool)
    keep[least:] = values[least:] != values[:-least]
    values = values[keep]
    bounds = np.searchsorted(values, np.arange(2**16 + 1, dtype=np.uint64) << np.uint64(16))
    buckets = np.flatnonzero(np.diff(bounds))
    ends = np.concatenate(([0], bounds[buckets + 1])) * 2
    low = pa.py_buffer(values.astype("<u2").tobytes())
    offsets = pa.py_buffer(ends.astype(np.int32).tobytes())
    packed = pa.Array.from_buffers(pa.binary(), len(buckets), [None, offsets, low])
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), packed], names=["bucket", "low"])


def _shared_places(texts: DataFrame, settings: Settings, least: int) -> np.ndarray:
    """One bit for each place of a hash, set where its shingle may be in ``least`` documents.

    The upper halves of the hashes of all documents are counted exactly, two
    bytes for each. A count holds copies and other shingles with the same upper
    half as well, so it is never too small.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for rows in byte_slices(batch, 1):
                for hashes in shingle_sets(rows.column(1), settings.words):
                    waiting.append((hashes >> np.uint64(32)).astype(np.uint32))
                    n += len(hashes)
                if n >= _PACKED:
                    yield _packed(waiting, least)
                    waiting, n = [], 0
        if n:
            yield _packed(waiting, least)

    def to_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, bits = [], []
            for bucket, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.bincount(np.frombuffer(b"".join(parts), "<u2"), minlength=2**16)
                shared = (n >= least).reshape(-1, 2**_UNPLACED).any(axis=1)
                if shared.any():
                    buckets.append(bucket)
                    bits.append(np.packbits(shared).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), pa.array(bits, pa.binary())], names=["bucket", "bits"]
            )

    packed = texts.mapInArrow(pack, "bucket int, low binary")
    gathered = packed.groupBy("bucket").agg(F.collect_list("low").alias("low"))
    places = np.zeros((2**16, 2 ** (16 - _UNPLACED) // 8), np.uint8)
    # a fixed number of bits, whatever the input
    for row in gathered.mapInArrow(to_bits, "bucket int, bits binary").collect():
        places[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return places.reshape(-1)


def frequent_shingles(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Hashes of the shingles that many distinct sets hold, counted over all documents."""
    least = settings.frequent * settings.sampled
    places = _shared_places(texts, settings, least)
    if not places.any():
        return np.zeros(0, np.uint64)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, 1):
                digests, shared = [], []
                for hashes in shingle_sets(rows.column(1), settings.words):
                    place = (hashes >> np.uint64(32 + _UNPLACED)).astype(np.int64)
                    known = (places[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
                    digests.append(xxhash.xxh3_64_intdigest(hashes.data, settings.seed) >> 1)
                    shared.append(hashes[known.astype(bool)].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(digests, list(map(len, shared))), pa.int64()),
                        pa.array(np.concatenate(shared), pa.int64()),
                    ],
                    names=["digest", "shingle"],
                )

    # copies count once
    counted = (
        texts.mapInArrow(to_sets, "digest long, shingle long")
        .distinct()
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "shingle")
        .limit(settings.most_frequent)
    )
    # no more than most_frequent numbers
    return np.sort(np.array([r["shingle"] for r in counted.collect()], np.int64).view(np.uint64))


def profiles(texts: DataFrame, settings: Settings) -> DataFrame:
    """(id, n_shingles, digest, sig, keys, whole_keys): what each shingle set says."""
    frequent = frequent_shingles(texts, settings)
    schema = (
        "id long, n_shingles long, digest binary, sig binary, keys array<long>,"
        " whole_keys array<long>"
    )
    names = ["id", "n_shingles", "digest", "sig", "keys", "whole_keys"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Profiler(settings, frequent)
        for batch in batches:
            for rows in byte_slices(batch, 1):
                sets = shingle_sets(rows.column(1), settings.words)
                seen = [look(s) if len(s) else (None, None, None) for s in sets]
                digests = [xxhash.xxh3_128_digest(s.data) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array([s[0] for s in seen], pa.binary()),
                        pa.array([s[1] for s in seen], pa.list_(pa.int64())),
                        pa.array([s[2] for s in seen], pa.list_(pa.int64())),
                    ],
                    names=names,
                )

    return texts.mapInArrow(profile, schema)


def _prune(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that no batch of their signatures rules out."""
    steps = settings.least_matches()
    half = [nodes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                rows = batch.slice(begin, 4096)
                left, right = (
                    np.frombuffer(b"".join(rows.column(i).to_pylist()), "<u2").reshape(
                        rows.num_rows, -1
                    )
                    for i in (2, 3)
                )
                alive, matches, done = np.arange(rows.num_rows), np.zeros(rows.num_rows, int), 0
                for n, least in steps:
                    same = left[alive, done:n] == right[alive, done:n]
                    matches = matches + same.sum(axis=1)
                    stay = matches >= least
                    alive, matches, done = alive[stay], matches[stay], n
                yield rows.select(["a", "b"]).take(pa.array(alive))

    signed = pairs.join(half[0], "a").join(half[1], "b").select("a", "b", "sig_a", "sig_b")
    return signed.mapInArrow(compare, "a long, b long")


def _sets(asked: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(id, hashes): the full sets of the ids in ``asked``.

    Texts whose id falls on no place that an asked id falls on are left out
    before anything is shuffled; the places are a fixed number of bits.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(_PLACES)).cast("int").alias("place")
    taken = np.zeros(_PLACES, bool)
    taken[[r["place"] for r in asked.select(place).distinct().collect()]] = True
    bits = np.packbits(taken)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits).astype(bool)
        for batch in batches:
            wanted = batch.filter(pa.array(known[batch.column(2).to_numpy()]))
            for rows in byte_slices(wanted, 1):
                _, lists = _hash_lists(rows, settings)
                yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=["id", "hashes"])

    near = texts.select("id", "text", place).mapInArrow(to_sets, "id long, hashes array<long>")
    return staged(near.join(asked, "id", "left_semi"), "sets")


def _confirm(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold. ``texts`` is (id, text)."""
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    full = _sets(asked, texts, settings)
    half = [full.select(F.col("id").alias(c), F.col("hashes").alias(f"set_{c}")) for c in "ab"]
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - shared
    return (
        pairs.join(half[0], "a")
        .join(half[1], "b")
        .where(100 * shared >= settings.percent * union)
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    likely = staged(_prune(pairs, nodes, settings), "likely")
    return staged(_confirm(likely, texts, settings), "links")


def _buckets(nodes: DataFrame, keys: str) -> DataFrame:
    """(key, node, head): nodes that share a band, with the smallest of them."""
    bands = nodes.select("node", F.explode(keys).alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
    heads = staged(shared.where("head < last").drop("last"), "heads")
    return staged(bands.join(heads, "key"), "buckets")


def _families(buckets: DataFrame) -> DataFrame:
    """(node, family) of the nodes that share a band of whole sets, directly or through others."""
    chain = buckets.where("node <> head").select(F.col("node").alias("u"), F.col("head").alias("v"))
    others = components(chain)
    heads = others.select(F.col("v").alias("u"), "v").distinct()
    return others.union(heads).select(F.col("u").alias("node"), F.col("v").alias("family"))


def _across(
    buckets: DataFrame, roots: DataFrame, families: DataFrame, tried: DataFrame
) -> DataFrame:
    """Pairs of one bucket and different components that have not met yet.

    Members of one family are left to the comparison of that family.
    """
    known = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    placed = (
        buckets.join(known, "node", "left")
        .join(families, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumns({"alone": F.col("family").isNull(), "home": F.coalesce("family", "root")})
        .select("key", "node", "root", "home", "alone")
    )
    mixed = placed.groupBy("key").agg(
        F.min("root").alias("x"),
        F.max("root").alias("y"),
        (F.bool_or("alone") | (F.min("home") < F.max("home"))).alias("open"),
    )
    placed = staged(placed.join(mixed.where("x < y AND open").select("key"), "key"), "mixed")
    # a component may have members in several families and in none
    side = ("root", "home", "alone")
    sides = placed.select("key", *side).distinct()
    left, right = (sides.select("key", *[F.col(c).alias(f"{c}_{s}") for c in side]) for s in "pq")
    apart = "root_p < root_q AND (home_p <> home_q OR alone_p OR alone_q)"
    pairs = left.join(right, "key").where(apart)
    for s in "pq":
        members = placed.select("key", *[F.col(c).alias(f"{c}_{s}") for c in side], F.col("node").alias(s))
        pairs = pairs.join(members, ["key", *[f"{c}_{s}" for c in side]])
    ordered = pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    return staged(ordered.join(tried, ["a", "b"], "left_anti"), "across")


def _meet(
    left: list[tuple], right: list[tuple] | None, roots: dict[int, int], settings: Settings
) -> list[tuple[int, int]]:
    """Links between the (node, sig, hashes) of two blocks, or within one, that join components."""
    root = dict(roots)

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    steps, links = settings.least_matches(), []
    others = left if right is None else right
    signs = np.stack([np.frombuffer(sig, "<u2") for _, sig, _ in others])
    for i, (node, sig, hashes) in enumerate(left):
        mine = np.frombuffer(sig, "<u2")
        first = i + 1 if right is None else 0
        alive = np.arange(first, len(others))
        matches, done = np.zeros(len(alive), int), 0
        for n, least in steps:
            matches = matches + (signs[alive, done:n] == mine[done:n]).sum(axis=1)
            stay = matches >= least
            alive, matches, done = alive[stay], matches[stay], n
        # the most alike first, so that few exact comparisons settle a component
        for j in alive[np.argsort(-matches, kind="stable")].tolist():
            other, _, theirs = others[j]
            x, y = find(roots.get(node, node)), find(roots.get(other, other))
            if x == y:
                continue
            shared = len(np.intersect1d(hashes, theirs, assume_unique=True))
            if 100 * shared >= settings.percent * (len(hashes) + len(theirs) - shared):
                links.append((node, other))
                root[max(x, y)] = min(x, y)
    return links


def _family_links(
    nodes: DataFrame, families: DataFrame, roots: DataFrame, texts: DataFrame, settings: Settings
) -> DataFrame | None:
    """Links (u, v) that join components inside families."""
    known = roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
    placed = (
        families.join(known, "node", "left")
        .select("node", "family", F.coalesce("root", "node").alias("root"))
        .join(nodes.select("node", "sig", "n_shingles"), "node")
    )
    placed = staged(placed, "families")
    sizes = placed.groupBy("family").agg(
        F.min("root").alias("x"),
        F.max("root").alias("y"),
        F.ceil(
            F.greatest(
                F.count(F.lit(1)) / settings.block, F.sum("n_shingles") * 8 / settings.block_bytes
            )
        ).alias("blocks"),
    )
    mixed = staged(placed.join(sizes.where("x < y").select("family", "blocks"), "family"), "members")
    if mixed.isEmpty():
        return None
    full = _sets(mixed.select(F.col("node").alias("id")).distinct(), texts, settings)
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    members = mixed.join(full.withColumnRenamed("id", "node"), "node").withColumn("own", own)
    # a member goes to every pair of blocks that its own block is part of
    spread = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    def compare(rows: pa.Table) -> pa.Table:
        parts: dict[int, list[tuple]] = {}
        names = ("own", "node", "sig", "hashes")
        for own, node, sig, hashes in zip(*(rows.column(n) for n in names), strict=True):
            values = hashes.values.to_numpy().view(np.uint64)
            parts.setdefault(own.as_py(), []).append((node.as_py(), sig.as_py(), values))
        roots = dict(zip(rows.column("node").to_pylist(), rows.column("root").to_pylist(), strict=True))
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        found = []
        if i == j or (i in parts and j in parts):
            found = _meet(parts[i], None if i == j else parts[j], roots, settings)
        columns = list(zip(*found, strict=True)) or [[], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("uv", columns, strict=True)})

    compared = spread.groupBy("family", "i", "j").applyInArrow(compare, "u long, v long")
    return staged(compared, "family-links")


def near_duplicates(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Per row of ``df``: ``id_col``, n_shingles, component_id and kept."""
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = staged(profiles(texts, settings), "profiles")
    linked = known.where("id IS NOT NULL AND digest IS NOT NULL")
    nodes = staged(
        linked.groupBy("digest").agg(
            F.min("id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
            F.first("keys").alias("keys"),
            F.first("whole_keys").alias("whole_keys"),
        ),
        "nodes",
    )
    buckets, whole = _buckets(nodes, "keys"), _buckets(nodes, "whole_keys")
    met = buckets.union(whole).where("node <> head")
    pairs = staged(met.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    first = _links(pairs, nodes, texts, settings)
    roots = components(first)
    families = staged(_families(whole), "families")
    across = _across(buckets, roots, families, pairs)
    more = [] if across.isEmpty() else [_links(across, nodes, texts, settings)]
    inside = _family_links(nodes, families, roots, texts, settings)
    more += [] if inside is None else [inside]
    if any(not links.isEmpty() for links in more):
        roots = components(reduce(DataFrame.union, more, roots))
    node_roots = staged(
        nodes.select("digest", "node")
        .join(roots.select(F.col("u").alias("node"), "v"), "node", "left")
        .select("digest", F.coalesce("v", "node").alias("root")),
        "roots",
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return known.join(node_roots, "digest", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
