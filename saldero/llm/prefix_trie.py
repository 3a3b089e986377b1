"""The trie of conversation prefixes, built from vertical bitmaps.

Conversations are cut into shards, ranges of ids of a bounded number of
conversations. A shard keeps one bitset for every (position, turn): bit i is set
if its i-th conversation has that turn there, and one for every length. From
the root down, depth first, the set of a node meets the postings of the next
position: each meeting is a child, its population count the child's members,
and the meeting with the set of a length gives the members that end there. A
node of several shards is merged by a hash of its path, so a prefix that very
many conversations share costs one row per shard.

A node belongs to its smallest member. The nodes of one owner are the lower end
of its own path, a chain, and every chain but the topmost hangs below a node of
a smaller owner. Sums over subtrees therefore take a doubling of pointers over
the chains and a running sum along each chain, whatever the depth.

Defined results:

- rows without a conversation id belong to no conversation and are left out;
- a null role or text is empty; a null order value comes first;
- turns with one order value are put in the order of the hash of role and text;
- repeated rows are turns of their own; an empty table has no nodes, not even a root;
- other columns are not read, whatever their names;
- texts of any length are hashed in place, only hashes are shuffled. One conversation takes 32 bytes a turn in its task.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import quoted, staged

ROOT = (0, 0)
NOTHING = hashlib.sha256(b"").hexdigest()
_PARTS = pa.schema(
    [(n, pa.int64()) for n in ("k1", "k2", "p1", "p2", "depth", "n_bytes", "n", "low", "shard")]
    + [("ends", pa.string())]
)
_PARTS_SQL = ", ".join(f"{f.name} {'string' if f.name == 'ends' else 'long'}" for f in _PARTS)


def numbered_turns(
    df: DataFrame,
    *,
    id_col: str = "conv_id",
    order_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, pos, t1, t2, n_bytes): turns counted from 0, with 120 bits of their hash."""
    role, text = (
        F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role_col, text_col)
    )
    sealed = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    hashed = df.select(
        F.col(quoted(id_col)).cast("long").alias("conv"),
        F.col(quoted(order_col)).alias("at"),
        sealed.alias("sealed"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    ).where("conv IS NOT NULL")
    half = [F.conv(F.substring("sealed", at, 15), 16, 10).cast("long") for at in (1, 16)]
    rows = hashed.select("conv", "at", half[0].alias("t1"), half[1].alias("t2"), "n_bytes")
    order = Window.partitionBy("conv").orderBy(F.col("at").asc_nulls_first(), "t1", "t2")
    return rows.select("conv", (F.row_number().over(order) - 1).alias("pos"), "t1", "t2", "n_bytes")


def rooted(turns: DataFrame) -> DataFrame:
    """The conversations of ``numbered_turns`` as paths: (conv, depth, t1, t2, n_bytes)."""
    paths = turns.select("conv", (F.col("pos") + 1).cast("long").alias("depth"), "t1", "t2", "n_bytes")
    return paths.union(_roots(turns))


def _roots(turns: DataFrame) -> DataFrame:
    none = [F.lit(0).cast("long").alias(n) for n in ("depth", "t1", "t2", "n_bytes")]
    return turns.select("conv").distinct().select("conv", *none)


def grafted(turns: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Paths of conversations whose first turns are those of another one.

    ``base`` and ``head`` are expressions of ``conv``: the first ``head`` turns
    (``most`` of them at the most) come from conversation ``base``, the others
    from the conversation itself, after its own first ``head``.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    plan = sizes.select("conv", base.alias("base"), head.alias("head"))
    plan = plan.join(sizes.withColumnsRenamed({"conv": "base", "size": "given"}), "base", "left")
    plan = staged(plan.withColumn("given", F.least("head", F.coalesce("given", F.lit(0)))), "grafts")
    lent = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    first = (
        plan.join(lent, "base")
        .where("pos < head")
        .select("conv", (F.col("pos") + 1).cast("long").alias("depth"), "t1", "t2", "n_bytes")
    )
    rest = (
        turns.join(plan, "conv")
        .where("pos >= head")
        .select("conv", (F.expr("given + pos - head") + 1).cast("long"), "t1", "t2", "n_bytes")
    )
    return first.union(rest).union(_roots(turns))


def _child_key(parent: tuple[int, int], turn: tuple[int, int]) -> tuple[int, int]:
    path = hashlib.blake2b(struct.pack("<4q", *parent, *turn), digest_size=16).digest()
    return struct.unpack("<2q", path)


def _set_bits(bits: int) -> Iterator[int]:
    while bits:
        lowest = bits & -bits
        yield lowest.bit_length() - 1
        bits ^= lowest


def shard_nodes(ids: list[int], paths: list[list[tuple[int, int, int]]]) -> Iterator[tuple]:
    """Rows of ``_PARTS`` for the trie of one shard; ``ids`` ascend, a path is (t1, t2, bytes)."""
    postings: dict[tuple, int] = {}
    length: dict[int, int] = {}
    for i, path in enumerate(paths):
        bit = 1 << i
        length[len(path)] = length.get(len(path), 0) | bit
        for at, turn in enumerate(path):
            postings[at, turn] = postings.get((at, turn), 0) | bit
    stack = [(ROOT, ROOT, 0, 0, (1 << len(ids)) - 1)]
    while stack:
        key, parent, depth, n_bytes, members = stack.pop()
        ends = members & length.get(depth, 0)
        ended = ",".join(str(ids[i]) for i in _set_bits(ends)) if ends else None
        low = ids[(members & -members).bit_length() - 1]
        yield (*key, *parent, depth, n_bytes, members.bit_count(), low, ids[0], ended)
        rest = members ^ ends
        while rest:
            turn = paths[(rest & -rest).bit_length() - 1][depth]
            child = rest & postings[depth, turn]
            rest ^= child
            stack.append((_child_key(key, turn[:2]), key, depth + 1, turn[2], child))


def _shards(
    batches: Iterator[pa.RecordBatch], conversations: int, turns: int
) -> Iterator[tuple[list[int], list[list[tuple]]]]:
    """Whole conversations of rows sorted by (conv, depth), up to either bound at a time."""
    ids: list[int] = []
    paths: list[list[tuple]] = []
    held = 0
    for batch in batches:
        for conv, depth, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if depth == 0:
                if len(ids) >= conversations or held >= turns:
                    yield ids, paths
                    ids, paths, held = [], [], 0
                ids.append(conv)
                paths.append([])
            else:
                paths[-1].append(tuple(turn))
                held += 1
    if ids:
        yield ids, paths


def _partial_nodes(paths: DataFrame, conversations: int, turns: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in _shards(batches, conversations, turns):
            rows = list(shard_nodes(ids, held))
            for at in range(0, len(rows), 1 << 16):
                columns = zip(*rows[at : at + (1 << 16)], strict=True)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, _PARTS, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PARTS)

    # ranges of ids, so that the end lists of one node follow each other from shard to shard
    placed = paths.repartitionByRange("conv").sortWithinPartitions("conv", "depth")
    return staged(placed.mapInArrow(build, _PARTS_SQL), "trie-parts")


def _end_hashes(parts: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): the end lists of a node hashed one after the other."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for k1, k2, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k1, k2) != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (k1, k2), hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            if done:
                columns = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist(
                [{"k1": now[0], "k2": now[1], "ends_sha256": state.hexdigest()}], schema=schema
            )

    lists = parts.where("ends IS NOT NULL").select("k1", "k2", "ends", "shard")
    ordered = lists.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "shard")
    hashed = ordered.select("k1", "k2", "ends").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")
    return hashed


def _chain_totals(chains: DataFrame) -> DataFrame:
    """(low, leaves, saved) over each chain and all that hang below it.

    ``chains`` is (low, above, leaves, saved). After round k a chain holds the
    sums of the 2**k levels below it and knows the chain 2**k levels above.
    """
    known = staged(chains, "chains")
    while not known.where("above IS NOT NULL").isEmpty():
        below = known.where("above IS NOT NULL").groupBy(F.col("above").alias("low"))
        added = below.agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        further = known.select(F.col("low").alias("above"), F.col("above").alias("higher"))
        zero = F.lit(0)
        known = staged(
            known.join(added, "low", "left")
            .join(further, "above", "left")
            .select(
                "low",
                F.col("higher").alias("above"),
                (F.col("leaves") + F.coalesce("more", zero)).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"),
            ),
            "chains",
        )
    return known.drop("above")


def prefix_trie(paths: DataFrame, *, conversations: int = 4096, turns: int = 1 << 18) -> DataFrame:
    """The nodes of the trie over ``rooted`` or ``grafted`` paths.

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (bytes of the last turn's text, once per
    member beyond the first, over the subtree) and ends_sha256 (the ids of the
    members that end there). A shard has at most ``conversations`` or begins
    no further one after ``turns`` turns.
    """
    parts = _partial_nodes(paths, conversations, turns)
    sums = [F.min(c).alias(c) for c in ("p1", "p2", "depth", "n_bytes", "low")]
    nodes = staged(parts.groupBy("k1", "k2").agg(*sums, F.sum("n").alias("n")), "trie-nodes")
    below = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    counted = nodes.join(below.agg(F.count(F.lit(1)).alias("n_children")), ["k1", "k2"], "left")
    counted = counted.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("low").alias("owner"))
    below_root = nodes.where("depth > 0").select("low", "depth", "p1", "p2")
    # both sides are stored, so that adaptive execution may split the children of one node
    owners = below_root.join(above, ["p1", "p2"]).select("low", "depth", "owner")
    whole = staged(
        counted.join(owners, ["low", "depth"], "left")
        .join(_end_hashes(parts), ["k1", "k2"], "left")
        .select(
            "low",
            "depth",
            "owner",
            "n",
            "n_children",
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n") - 1) * F.col("n_bytes")).alias("saved"),
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        ),
        "trie-whole",
    )
    heads = whole.where("owner <> low").select("low", F.col("owner").alias("above"), "depth")
    own = whole.groupBy("low").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = _chain_totals(own.join(heads.drop("depth"), "low", "left").select("low", "above", "leaves", "saved"))
    hung = totals.join(heads, "low").select(
        F.col("above").alias("low"), (F.col("depth") - 1).alias("depth"), "leaves", "saved"
    )
    each = whole.select("low", "depth", "leaves", "saved").union(hung)
    each = each.groupBy("low", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    upwards = Window.partitionBy("low").orderBy(F.desc("depth"))
    sums_below = each.select(
        "low",
        "depth",
        F.sum("leaves").over(upwards).alias("n_leaves"),
        F.sum("saved").over(upwards).alias("saved_tokens"),
    )
    return whole.join(sums_below, ["low", "depth"]).select(
        F.col("low").alias("conv_id"),
        "depth",
        F.col("owner").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
