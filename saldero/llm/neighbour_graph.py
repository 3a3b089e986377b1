"""Near duplicates of vectors by NN-descent.

Vectors that are equal number by number are one node. A first graph comes from
several random orders: in each, nodes are sorted by the signs of random
projections and compared with those around them. Then the graph is refined.
Every node brings its neighbours and some of those it is a neighbour of
together; what they find out about each other improves their lists. A list
holds the ``size`` best neighbours. While all entries of a list reach the
threshold it is saturated and grows, up to ``widest``. Rounds go on until one
adds hardly a link and the audit, an exact search for a bounded sample of nodes
among all others, finds the recall asked for; otherwise more random orders are
added.

For these steps a vector travels as one byte per number with a bound on its
error. A pair is accepted or dropped by that bound; where the bound leaves it
open, it is decided on the whole vectors, in double precision.

Nodes whose lists are saturated at their widest lie in dense groups, where
lists would grow with the group. Such a component is counted without them: its
members are put in rings by their angle to its centre. Angles obey the triangle
inequality, so two rings close to the centre are linked throughout and two
rings far apart are not at all. Only rings between these are compared, cell by
cell, and tasks return counts, not pairs.

Defined results:

- a vector that is null, empty, zero or holds a null or non-finite number links with nothing;
- vectors of different lengths do not link;
- rows with a null id link with nothing, have no component and are kept;
- repeated rows and equal vectors are links of each other;
- rows that share an id are vectors of their own, and so is what is said of them;
- an empty table gives an empty result; other columns are not read;
- a component is all nodes that links reach, those of dense groups counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import quoted, staged
from .graph import components

_CODE = "node long, dim int, q binary, scale double, err double"
# Slack for the rounding of sums of doubles.
_ROUND = 1e-9


@dataclass(frozen=True)
class Settings:
    """Threshold, sizes of lists, and the shape of the search.

    ``orders`` random orders begin the graph, ``more_orders`` are added when
    the audit of ``audited`` nodes finds less than ``recall``, ``audits`` times
    at the most; the links that an audit finds are kept in any case.
    """

    threshold: float = 0.95
    size: int = 8
    widest: int = 24
    reverse: int = 8
    orders: int = 12
    more_orders: int = 12
    window: int = 128
    shown: int = 3
    projections: int = 48
    rounds: int = 8
    settled: float = 0.002
    audited: int = 512
    recall: float = 0.98
    audits: int = 4
    ring: float = 0.01
    cell: int = 2048
    seed: int = 11


def unit_vectors(lists: pa.Array) -> list[np.ndarray | None]:
    """Each vector in doubles with length 1, None where it takes part in nothing."""
    units = []
    flat = lists.values.cast(pa.float64())
    usable = np.isfinite(flat.to_numpy(zero_copy_only=False)) & ~np.asarray(flat.is_null())
    numbers = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    offsets, valid = lists.offsets.to_numpy(), np.asarray(lists.is_valid())
    for begin, end, given in zip(offsets[:-1], offsets[1:], valid, strict=True):
        unit = None
        if given and end > begin and usable[begin:end].all():
            most = np.abs(numbers[begin:end]).max()
            if most > 0:
                # scaled first, so that no square overflows or vanishes
                unit = numbers[begin:end] / most
                unit = unit / math.sqrt(float(unit @ unit))
        units.append(unit)
    return units


def coded(unit: np.ndarray) -> tuple[bytes, float, float]:
    """One signed byte per number, the size of a step, and the length of what is lost."""
    scale = float(np.abs(unit).max()) / 127
    q = np.rint(unit / scale).astype(np.int8)
    lost = unit - q * scale
    return q.tobytes(), scale, math.sqrt(float(lost @ lost))


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, digest, vec, dim, q, scale, err): the digest is null where a vector takes no part."""
    chosen = df.select(
        F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(vector_col)).alias("vec")
    )
    kind = chosen.schema["vec"].dataType.simpleString()
    schema = f"id long, digest binary, vec {kind}, dim int, q binary, scale double, err double"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_vectors(batch.column(1))
            known = [i is not None for i in batch.column(0).to_pylist()]
            rows = []
            lists = batch.column(1)
            for at, (unit, named) in enumerate(zip(units, known, strict=True)):
                if unit is None or not named:
                    rows.append((None, None, None, None, None))
                    continue
                # + 0.0 makes the two zeros one
                plain = np.asarray(lists[at].values.cast(pa.float64())) + 0.0
                rows.append((xxhash.xxh3_128_digest(plain.tobytes()), len(unit), *coded(unit)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.binary(), pa.int32(), pa.binary(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], kinds[0]),
                    batch.column(1),
                    *[pa.array(c, k) for c, k in zip(columns[1:], kinds[1:], strict=True)],
                ],
                names=["id", "digest", "vec", "dim", "q", "scale", "err"],
            )

    return staged(chosen.mapInArrow(encode, schema), "vectors")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    values = np.frombuffer(b"".join(column.to_pylist()), np.int8)
    return values.reshape(len(column), dim).astype(np.float32)


class _Group:
    """Coded vectors of one length: bounds on all cosines between them."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, dim: int):
        q = _matrix(rows.column("q"), dim)
        self.scale = rows.column("scale").to_numpy()
        self.err = rows.column("err").to_numpy()
        self.q, self.node = q, rows.column("node").to_numpy()

    def cosines(self) -> tuple[np.ndarray, np.ndarray]:
        """Estimates, and how far the true cosine can be from them."""
        sims = (self.q @ self.q.T).astype(np.float64) * np.outer(self.scale, self.scale)
        # |a.b - a'.b'| <= |a - a'| + |a'| |b - b'|, and |a'| <= 1 + |a - a'|
        slack = self.err[:, None] + (1 + self.err[:, None]) * self.err[None, :]
        return sims, slack + 1e-6


def _candidates(
    u: np.ndarray, v: np.ndarray, sims: np.ndarray, slack: np.ndarray
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u), pa.array(v), pa.array(sims - slack), pa.array(sims + slack)],
        names=["u", "v", "low", "high"],
    )


_CANDIDATES = "u long, v long, low double, high double"


def _by_length(table: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = table.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), table.filter(pa.array(dims == dim))


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows, ``size`` at a time, across batches."""
    kept: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        kept.append(batch)
        held += batch.num_rows
        if held >= size:
            whole = pa.concat_batches(kept)
            full = held // size * size
            for at in range(0, full, size):
                yield whole.slice(at, size)
            kept, held = [whole.slice(full)], held - full
    if held:
        yield pa.concat_batches(kept)


def _from_orders(nodes: DataFrame, first: int, count: int, s: Settings) -> DataFrame:
    """Candidates (u, v, low, high) among neighbours in ``count`` random orders."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(s.projections, dtype=np.int64)[::-1]
        for batch in batches:
            for dim, rows in _by_length(batch):
                if dim not in planes:
                    draws = [
                        np.random.default_rng([s.seed, t, dim]).standard_normal((dim, s.projections))
                        for t in range(first, first + count)
                    ]
                    planes[dim] = np.concatenate(draws, axis=1).astype(np.float32)
                signs = _matrix(rows.column("q"), dim) @ planes[dim] > 0
                for t in range(count):
                    code = signs[:, t * s.projections : (t + 1) * s.projections] @ weights
                    order = pa.array(np.full(rows.num_rows, first + t, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [order, pa.array(code), *rows.columns], names=["turn", "code", *rows.schema.names]
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window in _windows(batches, s.window):
            turns = window.column("turn").to_numpy()
            for t in np.unique(turns):
                for dim, rows in _by_length(window.filter(pa.array(turns == t))):
                    if rows.num_rows > 1:
                        yield _best_of(_Group(rows, dim), s)

    placed = nodes.select("node", "dim", "q", "scale", "err").mapInArrow(
        place, f"turn int, code long, {_CODE}"
    )
    ordered = placed.repartitionByRange("turn", "dim", "code", "node")
    ordered = ordered.sortWithinPartitions("turn", "dim", "code", "node")
    return ordered.mapInArrow(compare, _CANDIDATES)


def _best_of(group: _Group, s: Settings) -> pa.RecordBatch:
    """The best others of each row; more of them where they may reach the threshold."""
    sims, slack = group.cosines()
    np.fill_diagonal(sims, -2.0)
    most = min(s.widest, len(sims) - 1)
    best = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    best = np.take_along_axis(best, np.argsort(-np.take_along_axis(sims, best, 1), axis=1, kind="stable"), 1)
    found = np.take_along_axis(sims, best, 1)
    off = np.take_along_axis(slack, best, 1)
    wanted = (np.arange(most) < s.shown) | (found + off >= s.threshold)
    row, place = np.nonzero(wanted)
    return _candidates(group.node[row], group.node[best[row, place]], found[row, place], off[row, place])


def _merged(graph: DataFrame | None, candidates: DataFrame, s: Settings) -> DataFrame:
    """Lists (u, v, low, high, fresh, worst): best neighbours, and what a better one must exceed.

    ``worst`` is the lowest entry of a full list; a list at its widest asks for nothing more.
    """
    both = candidates.select(*"uv", "low", "high", F.lit(True).alias("fresh"))
    if graph is not None:
        both = both.union(graph.select(*"uv", "low", "high", F.lit(False)))
    # one exchange by u serves the aggregate and the windows
    each = both.repartition("u").groupBy("u", "v").agg(
        F.max("low").alias("low"), F.min("high").alias("high"), F.min("fresh").alias("fresh")
    )
    order = Window.partitionBy("u").orderBy(F.desc("high"), "v")
    placed = each.withColumn("place", F.row_number().over(order)).where(f"place <= {s.widest}")
    grown = (F.col("place") <= s.size) | (F.col("high") >= s.threshold)
    whole = Window.partitionBy("u")
    size = F.count(F.lit(1)).over(whole)
    # a saturated list takes whatever reaches the threshold
    full = F.least(F.min("high").over(whole), F.lit(s.threshold - 1e-12))
    lists = placed.where(grown).select(
        *"uv",
        "low",
        "high",
        "fresh",
        F.when(size >= s.widest, F.lit(2.0)).when(size >= s.size, full).otherwise(F.lit(-2.0)).alias("worst"),
    )
    return staged(lists, "graph")


def _links(graph: DataFrame, s: Settings) -> DataFrame:
    return graph.where(F.col("high") >= s.threshold)


def _meetings(graph: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Candidates from neighbours of neighbours: what the members of a neighbourhood are to each other."""
    back = Window.partitionBy("hub").orderBy("mix", "member")
    forward = graph.select(F.col("u").alias("hub"), F.col("v").alias("member"), "fresh")
    reverse = graph.select(
        F.col("v").alias("hub"),
        F.col("u").alias("member"),
        "fresh",
        F.xxhash64(F.lit(s.seed), "u", "v").alias("mix"),
    )
    # a node of many lists meets some of their owners; the others meet each other elsewhere
    some = reverse.withColumn("n", F.row_number().over(back)).where(f"n <= {s.reverse}")
    met = forward.union(some.select("hub", "member", "fresh"))
    met = met.groupBy("hub", "member").agg(F.max("fresh").alias("fresh"))
    news = F.max("fresh").over(Window.partitionBy("hub"))
    met = met.withColumn("news", news).where("news").drop("news")
    worst = graph.select(F.col("u").alias("member"), "worst").distinct()
    # a node that nothing is known of yet takes whatever it meets
    told = nodes.select(F.col("node").alias("member"), "dim", "q", "scale", "err").join(worst, "member", "left")
    told = told.withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
    ready = met.join(told, "member").repartition("hub").sortWithinPartitions("hub", "member")
    ready = ready.select("hub", F.col("member").alias("node"), "fresh", "dim", "q", "scale", "err", "worst")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "hub"):
            for dim, same in _by_length(rows):
                if same.num_rows < 2:
                    continue
                group = _Group(same, dim)
                sims, slack = group.cosines()
                np.fill_diagonal(sims, -3.0)
                fresh = np.asarray(same.column("fresh").to_numpy(zero_copy_only=False), bool)
                worst = same.column("worst").to_numpy()
                useful = (fresh[:, None] | fresh[None, :]) & (sims + slack > worst[:, None])
                # at most a list's length of what one meeting tells a node
                most = min(s.size, len(sims) - 1)
                masked = np.where(useful, sims, -3.0)
                best = np.argpartition(-masked, most - 1, axis=1)[:, :most]
                row, place = np.nonzero(np.take_along_axis(masked, best, 1) > -3.0)
                if len(row):
                    col = best[row, place]
                    yield _candidates(group.node[row], group.node[col], sims[row, col], slack[row, col])

    return ready.mapInArrow(compare, _CANDIDATES)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of each key, from rows sorted by it. A group's rows are held together."""
    open_: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        if open_ and open_[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.concat_batches(open_)
            open_ = []
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            open_.append(batch.slice(begin, end - begin))
            if end < len(keys):
                yield pa.concat_batches(open_) if len(open_) > 1 else open_[0]
                open_ = []
    if open_:
        yield pa.concat_batches(open_)


def _audit(nodes: DataFrame, found: DataFrame, s: Settings, turn: int) -> tuple[float, DataFrame]:
    """The share of the sample's links that ``found`` has, and the links missing from it."""
    by_hash = F.xxhash64(F.lit(s.seed + turn), "node")
    chosen = nodes.orderBy(by_hash, "node").limit(s.audited)
    # no more than ``audited`` coded vectors
    sample = chosen.select("node", "dim", "q", "scale", "err").toArrow().combine_chunks()
    asked = {
        int(dim): _Group(rows, int(dim))
        for batch in sample.to_batches()
        for dim, rows in _by_length(batch)
    }

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                for dim, rows in _by_length(batch.slice(at, 4096)):
                    if dim not in asked:
                        continue
                    left, right = asked[dim], _Group(rows, dim)
                    sims = (left.q @ right.q.T).astype(np.float64) * np.outer(left.scale, right.scale)
                    slack = left.err[:, None] + (1 + left.err[:, None]) * right.err[None, :] + 1e-6
                    near = (sims + slack >= s.threshold) & (left.node[:, None] != right.node[None, :])
                    # a saturated list holds no more than its widest; the audit asks for as many
                    ranks = np.argsort(np.argsort(np.where(near, -sims, 3.0), axis=1, kind="stable"), axis=1)
                    row, col = np.nonzero(near & (ranks < s.widest))
                    if len(row):
                        yield _candidates(left.node[row], right.node[col], sims[row, col], slack[row, col])

    seen = nodes.select("node", "dim", "q", "scale", "err").mapInArrow(search, _CANDIDATES)
    seen = staged(_decided(seen, nodes, s), "audit")
    known = found.select("u", "v").union(found.select("v", "u")).distinct()
    # links inside one component of the graph are not lost
    total = seen.count()
    missing = staged(seen.join(known, ["u", "v"], "left_anti"), "missed")
    return (1.0 if total == 0 else 1 - missing.count() / total), missing


def _decided(candidates: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """The candidates (u, v) at or above the threshold; open ones by whole vectors."""
    sure = candidates.where(F.col("low") >= s.threshold + _ROUND).select(*"uv")
    unsure = candidates.where((F.col("low") < s.threshold + _ROUND) & (F.col("high") >= s.threshold))
    half = [nodes.select(F.col("node").alias(c), F.col("vec").alias(f"vec_{c}")) for c in "uv"]
    whole = unsure.select(*"uv").join(half[0], "u").join(half[1], "v").select(*"uv", "vec_u", "vec_v")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (unit_vectors(batch.column(i)) for i in (2, 3))
            keep = [float(a @ b) >= s.threshold for a, b in zip(left, right, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return sure.union(whole.mapInArrow(exact, "u long, v long"))


def _search(nodes: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The refined graph and its decided links (u < v)."""
    graph = _merged(None, _from_orders(nodes, 0, s.orders, s), s)
    orders, extra = s.orders, None
    for turn in range(s.audits):
        links = _links(graph, s).count()
        for _ in range(s.rounds):
            graph = _merged(graph, _meetings(graph, nodes, s), s)
            more = _links(graph, s).count()
            if more - links <= s.settled * links:
                break
            links = more
        found = staged(_decided(_links(graph, s), nodes, s), "links")
        recall, missing = _audit(nodes, found, s, turn)
        extra = missing if extra is None else extra.union(missing)
        if recall >= s.recall:
            break
        graph = _merged(graph, _from_orders(nodes, orders, s.more_orders, s), s)
        orders += s.more_orders
    both = found.union(extra.select(*"uv"))
    ordered = both.select(F.least(*"uv").alias("u"), F.greatest(*"uv").alias("v")).distinct()
    return graph, staged(ordered, "links")


def _rings(members: DataFrame, s: Settings) -> DataFrame:
    """``members`` with their ring: the angle to the centre of their group, in steps of ``ring``."""
    kind = "grp long, node long, weight long, angle double, vec array<double>"

    def normed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_vectors(batch.column(3))
            yield batch.set_column(3, "vec", pa.array(units, pa.list_(pa.float64())))

    units = members.select("grp", "node", "weight", "vec").mapInArrow(
        normed, "grp long, node long, weight long, vec array<double>"
    )
    units = staged(units, "units")
    summed = units.select("grp", F.posexplode("vec").alias("at", "x")).groupBy("grp", "at")
    centre = summed.agg(F.sum("x").alias("x")).groupBy("grp")
    listed = centre.agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("c"))
    centres = listed.select("grp", F.col("c.x").alias("centre"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centre = unit_vectors(batch.column(4))
            angles = []
            for unit, c in zip(unit_vectors(batch.column(3)), centre, strict=True):
                # vectors that cancel out have no centre; their ring says nothing
                angles.append(math.acos(max(-1.0, min(1.0, float(unit @ c)))) if c is not None else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(angles, pa.float64()), batch.column(3)],
                names=["grp", "node", "weight", "angle", "vec"],
            )

    joined = units.join(centres, "grp").select("grp", "node", "weight", "vec", "centre")
    measured = joined.mapInArrow(measure, kind)
    ring = F.floor(F.col("angle") / s.ring).cast("int")
    return staged(measured.withColumn("ring", F.coalesce(ring, F.lit(-1))), "rings")


def _dense_counts(members: DataFrame, s: Settings) -> DataFrame:
    """(node, n): the weight of the nodes each member of a dense group is linked with, itself included."""
    placed = _rings(members, s)
    sizes = staged(
        placed.groupBy("grp", "ring").agg(
            F.sum("weight").alias("weight"),
            F.ceil(F.count(F.lit(1)) / s.cell).cast("int").alias("cells"),
        ),
        "ring-sizes",
    )
    other = sizes.select("grp", *[F.col(c).alias(f"o_{c}") for c in ("ring", "weight", "cells")])
    # few hundred rings at the most in a group, whatever its size
    pairs = sizes.select("grp", "ring", "cells").join(other, "grp")
    limit, known = math.acos(s.threshold), (F.col("ring") >= 0) & (F.col("o_ring") >= 0)
    within = (F.col("ring") + F.col("o_ring") + 2) * s.ring <= limit - 1e-6
    beyond = (F.abs(F.col("ring") - F.col("o_ring")) - 1) * s.ring > limit + 1e-6
    sure = pairs.where(known & within).groupBy("grp", "ring").agg(F.sum("o_weight").alias("n"))
    counts = placed.join(sure, ["grp", "ring"]).select("node", "n")
    open_ = pairs.where(~(known & (within | beyond))).where("ring <= o_ring")
    if open_.isEmpty():
        return counts
    cut = F.explode(F.sequence(F.lit(0), F.col("o_cells") - 1))
    cells = open_.select("grp", "ring", "o_ring", "cells", cut.alias("o_cell"))
    cells = cells.select(
        "grp", "ring", "o_ring", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), "o_cell"
    ).where("ring < o_ring OR cell <= o_cell")
    meeting = staged(
        cells.withColumn("meeting", F.xxhash64("grp", "ring", "cell", "o_ring", "o_cell")), "meetings"
    )
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    seated = placed.join(sizes.select("grp", "ring", "cells"), ["grp", "ring"]).withColumn("cell", own)
    left = meeting.select("meeting", "grp", "ring", "cell", F.lit(0).alias("side"))
    right = meeting.select(
        "meeting", "grp", F.col("o_ring").alias("ring"), F.col("o_cell").alias("cell"), F.lit(1)
    )
    rows = seated.join(left.union(right), ["grp", "ring", "cell"])
    ready = rows.select("meeting", "side", "node", "weight", "vec").repartition("meeting")
    ready = ready.sortWithinPartitions("meeting", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "meeting"):
            side = group.column("side").to_numpy()
            node, weight = (group.column(c).to_numpy() for c in ("node", "weight"))
            vec = np.stack([np.asarray(v.values) for v in group.column("vec")])
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            same = len(a) == len(b) and set(node[a].tolist()) == set(node[b].tolist())
            near = vec[a] @ vec[b].T >= s.threshold
            # a member is as near to itself as can be, whatever the rounding
            near |= node[a][:, None] == node[b][None, :]
            yield _counted(node[a], near @ weight[b])
            if not same:
                yield _counted(node[b], weight[a] @ near)

    return counts.union(ready.mapInArrow(compare, "node long, n long"))


def _counted(node: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(n.astype(np.int64))], names=["node", "n"])


def near_vectors(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """Per row of ``df``: ``id_col``, n_links, component_id and kept."""
    s = settings
    rows = _rows(df, id_col, vector_col)
    usable = rows.where("digest IS NOT NULL")
    first = ("vec", "dim", "q", "scale", "err")
    distinct = usable.groupBy("digest").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"), *[F.first(c).alias(c) for c in first]
    )
    nodes = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    graph, links = _search(nodes, s)
    roots = components(links.select(*"uv"))
    rooted = nodes.select("node", "weight").join(
        roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left"
    )
    rooted = staged(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    # a list at its widest that reaches the threshold throughout may have left links out
    full = graph.where(F.col("worst") == 2.0).select(F.col("u").alias("node")).distinct()
    dense = rooted.join(full, "node", "left_semi").select("root").distinct()
    dense = staged(dense, "dense")
    members = rooted.join(dense, "root", "left_semi").select(F.col("root").alias("grp"), "node", "weight")
    weight = nodes.select(F.col("node").alias("v"), "weight")
    both = links.select(*"uv").union(links.select("v", "u"))
    listed = both.join(weight, "v").select(F.col("u").alias("node"), F.col("weight").alias("n"))
    counts = [listed.join(members.select("node"), "node", "left_anti")]
    if not dense.isEmpty():
        inside = members.join(nodes.select("node", "vec"), "node")
        # the counts of dense groups include the node's own weight
        counts += [_dense_counts(inside, s), members.select("node", (-F.col("weight")).alias("n"))]
    total = reduce(DataFrame.union, counts).groupBy("node").agg(F.sum("n").alias("n"))
    least = rooted.join(nodes.select("node", "least"), "node").groupBy("root").agg(
        F.min("least").alias("component_id")
    )
    by_digest = (
        rooted.join(total, "node", "left")
        .join(least, "root")
        .join(nodes.select("node", "digest"), "node")
        .select("digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    )
    known = rows.select("id", "digest").join(staged(by_digest, "by-digest"), "digest", "left")
    component = F.coalesce("component_id", "id")
    return known.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
