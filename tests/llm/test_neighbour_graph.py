"""Near vectors against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from saldero.llm import neighbour_graph as graph
from saldero.llm.neighbour_graph import Settings

DIM = 16
SCHEMA = "`vec.id` long, embedding array<double>, node string, `n.links` int"


def unit(draw, n, dim=DIM):
    found = draw.standard_normal((n, dim))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def around(draw, centre, n, angle):
    """Vectors at most ``angle`` from a centre."""
    aside = draw.standard_normal((n, len(centre)))
    aside -= np.outer(aside @ centre, centre)
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    angles = angle * draw.random((n, 1))
    return np.cos(angles) * centre + np.sin(angles) * aside


def by_hand(rows, threshold=0.95):
    """[(id, n_links, component, kept)] of (id, vector) rows."""
    n = len(rows)
    usable = [
        i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
        and any(x != 0 for x in v) for i, v in rows
    ]
    unit_of = {}
    for k in range(n):
        if usable[k]:
            v = np.array(rows[k][1], float)
            v = v / np.abs(v).max()
            unit_of[k] = v / np.linalg.norm(v)
    links = {k: [] for k in range(n)}
    for a in unit_of:
        for b in unit_of:
            if a < b and len(unit_of[a]) == len(unit_of[b]) and float(unit_of[a] @ unit_of[b]) >= threshold:
                links[a].append(b)
                links[b].append(a)
    out, seen = [], {}
    for k in range(n):
        if k in seen:
            continue
        group, todo = {k}, [k]
        while todo:
            for other in links[todo.pop()]:
                if other not in group:
                    group.add(other)
                    todo.append(other)
        least = min((rows[g][0] for g in group if rows[g][0] is not None), default=None)
        seen |= dict.fromkeys(group, least)
    for k in range(n):
        component = seen[k] if usable[k] else rows[k][0]
        out.append((rows[k][0], len(links[k]), component, rows[k][0] is None or rows[k][0] == component))
    return sorted(out, key=str)


def planted():
    """Pairs, a chain, copies, dense groups, and all that takes no part."""
    draw = np.random.default_rng(4)
    vectors = [*unit(draw, 120)]
    for centre in unit(draw, 12):
        vectors += [*around(draw, centre, 2, 0.1)]
    # a chain whose ends do not link
    a, b = np.eye(DIM)[0], np.eye(DIM)[1]
    vectors += [np.cos(t) * a + np.sin(t) * b for t in (0.0, 0.25, 0.5, 0.75)]
    # one tight group, and one wide enough for pairs on both sides of the threshold
    vectors += [*around(draw, unit(draw, 1)[0], 60, 0.12)]
    vectors += [*around(draw, unit(draw, 1)[0], 70, 0.3)]
    rows = [(i, list(map(float, v))) for i, v in enumerate(vectors)]
    copied = rows[0][1]
    rows += [(1000 + i, copied) for i in range(40)]
    rows += [(2000 + i, [x * 10.0**p for x in rows[1][1]]) for i, p in enumerate((-300, -3, 2, 250))]
    rows += [(3000, [-x for x in rows[1][1]]), (3001, [0.0] * DIM), (3002, [-0.0] * DIM), (3003, None)]
    rows += [(3004, []), (3005, [*copied[:-1], None]), (3006, [*copied[:-1], float("nan")])]
    rows += [(3007, [*copied[:-1], float("inf")]), (3008, copied[:-1]), (3009, copied[:-1])]
    rows += [(None, copied), (None, None), (5, rows[5][1]), (6, rows[7][1])]
    return rows


def found_for(spark, rows, settings):
    table = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], SCHEMA)
    got = graph.near_vectors(table, id_col="vec.id", settings=settings)
    assert got.columns == ["vec.id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_links_and_components_equal_all_pairs(spark):
    """Dense groups are counted by rings; cells of eight make many of them meet."""
    rows = planted()
    expected = by_hand(rows)
    assert found_for(spark, rows, Settings(cell=8, window=32)) == expected
    assert max(r[1] for r in expected) > Settings().widest


def test_little_to_find_is_no_failure(spark):
    assert found_for(spark, [], Settings()) == []
    alone = [(1, [1.0, 0.0]), (2, None)]
    assert found_for(spark, alone, Settings()) == by_hand(alone)


@pytest.mark.parametrize("dim", [1, 2, 64, 700])
def test_bounds_hold_for_every_pair(dim):
    draw = np.random.default_rng(dim)
    units = np.concatenate([unit(draw, 40, dim), around(draw, unit(draw, 1, dim)[0], 20, 0.3) if dim > 1 else unit(draw, 1, 1)])
    rows = [(i, dim, *graph.coded(u)) for i, u in enumerate(units)]
    names = ["node", "dim", "q", "scale", "err"]
    table = pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
    sims, slack = graph._Group(table, dim).cosines()
    assert (np.abs(sims - units @ units.T) <= slack).all()


def test_unit_vectors_of_extreme_numbers():
    given = pa.array([[1e300, 1e300], [1e-300, 0.0], [0.0, 0.0], None, [], [float("nan"), 1.0], [None, 1.0]])
    found = graph.unit_vectors(given)
    assert np.allclose(found[0], [0.5**0.5] * 2) and np.allclose(found[1], [1, 0])
    assert found[2:] == [None] * 5


def test_groups_span_batches():
    batches = [pa.record_batch({"k": k, "v": range(len(k))}) for k in ([1, 1, 2], [2], [2, 3], [], [4])]
    found = [(g.column("k")[0].as_py(), g.num_rows) for g in graph._groups(iter(batches), "k")]
    assert found == [(1, 2), (2, 3), (3, 1), (4, 1)]
