"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from saldero.llm import prefix_trie as trie

SCHEMA = "`conv.id` long, turn long, role string, text string, depth string, `low.x` int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "d", 7) for r in rows], SCHEMA)


def rows_of(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert frame.columns == names
    return sorted(tuple(r) for r in frame.collect())


def by_hand(paths):
    """Nodes of {conversation: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, path in sorted(paths.items()):
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
        ends[tuple(path)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        listed = ",".join(map(str, ends[node]))
        found.append(
            (
                convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children[node]),
                sum(not children[n] for n in below), saved, hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
    return sorted(found, key=lambda r: tuple((x is None, x) for x in r)) and sorted(found)


def sealed(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    """{conversation: its turns in order} of (conv, turn, role, text) rows."""
    paths = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            paths[conv].append((turn is not None, turn or 0, sealed(role, text)[:30], role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in paths.items()}


def conversations(draw, count, kinds):
    rows = []
    for conv in range(-3, count):
        for turn in range(draw.randint(1, 7)):
            rows.append((conv, turn, "ua"[turn % 2], draw.choice(kinds)))
    return rows


def found_for(spark, rows, **options):
    turns = trie.numbered_turns(table(spark, rows), id_col="conv.id")
    return trie.prefix_trie(trie.rooted(turns), **options)


HOT = [(c, t, "u", "same start" if t < 2 else f"{t}") for c in range(100, 160) for t in range(3)]
ODD = [
    (None, 0, "u", "lost"),
    (7, None, None, None),
    (7, 0, "", "é" * 3),
    (7, 0, "u", "tie"),
    (7, 0, "u", "tie"),
    (7, 0, "a", "tie"),
    (8, None, "", ""),
    (9, -5, "u", "x" * 200_000),
    (9, 3, "u:", "x"),
    (10, -5, "u", "x" * 200_000),
    (10, 3, "u", ":x"),
    (-(2**62), 0, "u", ""),
]
DEEP = [(c, t, "u", "deep") for c in (500, 501) for t in range(150 + c % 2)]


def test_nodes_equal_a_dictionary_of_prefixes(spark):
    """Shared prefixes, a hot one, ties, nulls, long texts, deep paths; shards of three conversations."""
    rows = conversations(random.Random(5), 40, ["a", "b", "ñ"]) + HOT + ODD + DEEP
    rows = [r for r in rows if r[0] != 7] + [r for r in ODD if r[0] == 7]
    assert rows_of(found_for(spark, rows, conversations=3)) == by_hand(ordered(rows))


def test_conversations_without_turns_belong_to_the_root(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "x"), (2, 1, "u", "y"), (2, 2, "u", "z"), (3, 0, "u", "x")]
    turns = trie.numbered_turns(table(spark, rows), id_col="conv.id")
    # 2 begins like 1, 3 like a conversation that is not there
    base = F.when(F.col("conv") == 3, F.lit(99)).otherwise(F.lit(1)).cast("long")
    paths = trie.grafted(turns, base, F.lit(2), 8)
    whole = {1: [("u", "a"), ("u", "b")], 2: [("u", "a"), ("u", "b"), ("u", "z")], 3: []}
    assert rows_of(trie.prefix_trie(paths)) == by_hand(whole)


def test_an_empty_table_has_no_nodes(spark):
    assert found_for(spark, [(None, 0, "u", "a")]).count() == 0


def test_shards_give_the_members_of_every_prefix():
    turn = [(1, 1, 1), (2, 2, 1), (3, 3, 1)]
    paths = [[turn[0], turn[1]], [turn[0]], [], [turn[0], turn[2]], [turn[0]]]
    rows = list(trie.shard_nodes([3, 5, 8, 9, 12], paths))
    found = {(r[4], r[7]): (r[6], r[9]) for r in rows}
    assert found == {
        (0, 3): (5, "8"),
        (1, 3): (4, "5,12"),
        (2, 3): (1, "3"),
        (2, 9): (1, "9"),
    }


@pytest.mark.parametrize("height", [1, 2, 9])
def test_sums_over_a_path_of_chains(spark, height):
    chains = [(n, n - 1 if n else None, 1, 10) for n in range(height)]
    made = spark.createDataFrame(chains, "low long, above long, leaves long, saved long")
    found = {r["low"]: (r["leaves"], r["saved"]) for r in trie._chain_totals(made).collect()}
    assert found == {n: (height - n, 10 * (height - n)) for n in range(height)}
