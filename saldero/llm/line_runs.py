"""Deletion of repeated runs of lines through a suffix array over line ids.

Every line gets an id, and all suffixes of all documents are ranked by prefix
doubling: two suffixes that agree on ``n`` lines have one rank at level ``n``,
and the rank of ``2n`` lines is the rank of the pair (rank here, rank ``n``
lines on). Ranks come from sorting the distinct pairs, in any number of tasks.
A suffix whose rank nobody shares takes no further part, so the levels shrink
quickly and end when no run is repeated. The suffixes of one rank at level
``n`` are an interval of the suffix array with longest common prefixes of at
least ``n`` lines; in the interval of the shortest run that counts, every
occurrence but the first marks its lines, and overlapping marks make up the
maximal runs. Runs of one line count only where a least length of such a line
is given (``long_line``); without it a line repeated alone stays, however long.

Order is by id, nulls first, then by position. Rows that repeat both id and
text count as one document. Null and empty texts have no lines to lose. Extra
columns are returned as they are; one with the name of an added column gives way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import quoted, staged, text_or_empty

_DOCUMENT = ["k1", "k2"]


def _key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that name a document by its id and text."""
    text = text_or_empty(text_col)
    return [
        F.xxhash64(F.col(quoted(id_col)), text).alias("k1"),
        F.xxhash64(F.lit(17), text, F.col(quoted(id_col))).alias("k2"),
    ]


def lines_of(
    df: DataFrame, id_col: str, text_col: str, long_line: int | None = None
) -> DataFrame:
    """(k1, k2, id, pos, a, b): every line with 128 bits that stand for it.

    With ``long_line`` also ``long``: whether it has so many characters.
    """
    text = text_or_empty(text_col)
    line = F.col("line")
    long = [] if long_line is None else [(F.length(line) >= long_line).alias("long")]
    return (
        df.where(text != "")
        .select(
            *_key(id_col, text_col),
            F.col(quoted(id_col)).alias("id"),
            F.posexplode(F.split(text, "\n")).alias("pos", "line"),
        )
        .select(
            *_DOCUMENT,
            "id",
            "pos",
            F.xxhash64(line).alias("a"),
            F.xxhash64(F.lit(17), line).alias("b"),
            *long,
        )
    )


def _ranks(suffixes: DataFrame, pair: list[str]) -> DataFrame:
    """Shared pairs with their rank and first place, in the order of the pairs."""
    shared = suffixes.groupBy(*pair).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("id", "k1", "k2", "pos")).alias("first"),
    )
    ordered = shared.where("n > 1").orderBy(*pair)
    # increasing along the sorted pairs; stored, because a second run may number differently
    return staged(
        ordered.select(*pair, "first", F.monotonically_increasing_id().alias("place")), "ranks"
    )


def _ranked(suffixes: DataFrame, pair: list[str]) -> DataFrame:
    named = suffixes.join(_ranks(suffixes, pair), pair)
    long = [c for c in suffixes.columns if c == "long"]
    rank = F.col("place").alias("rank")
    return staged(named.select(*_DOCUMENT, "id", "pos", rank, "first", *long), "suffixes")


def levels(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_line: int | None = None,
):
    """(length, suffixes that share their first ``length`` lines with another), doubling."""
    length, pair = 1, ["a", "b"]
    suffixes = staged(lines_of(df, id_col, text_col, long_line), "lines")
    while True:
        suffixes = _ranked(suffixes, pair)
        if suffixes.isEmpty():
            return
        yield length, suffixes
        onward = Window.partitionBy(*_DOCUMENT).orderBy("pos").rangeBetween(length, length)
        paired = suffixes.withColumn("next", F.first("rank").over(onward)).where("next IS NOT NULL")
        suffixes = staged(paired.drop("first", "long"), "pairs")
        length, pair = 2 * length, ["rank", "next"]


def remove_repeated_runs(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = 2,
    long_line: int | None = None,
    kept_col: str = "kept_text",
) -> DataFrame:
    """``df`` with the text that is left, and counts of lines.

    ``min_lines``, a power of two, is the shortest run that counts; a single
    line of at least ``long_line`` characters is one as well. Added are
    ``kept_col``, ``n_lines``, ``n_removed`` and ``longest_repeat``: the largest
    power of two for which a run of so many lines of the document is repeated.
    """
    if min_lines & (min_lines - 1):
        raise ValueError(f"min_lines must be a power of two, not {min_lines}")
    found = []
    for length, suffixes in levels(df, id_col=id_col, text_col=text_col, long_line=long_line):
        alone = length == 1 < min_lines and long_line is not None
        if alone:
            suffixes = suffixes.where("long")
        elif length < min_lines:
            continue
        later = F.struct("id", "k1", "k2", "pos") != F.col("first")
        marks = F.lit(None).cast("array<int>")
        if alone or length == min_lines:
            marks = F.when(later, F.sequence("pos", F.col("pos") + length - 1))
        found.append(suffixes.select(*_DOCUMENT, F.lit(length).alias("length"), marks.alias("marks")))
    schema = "k1 long, k2 long, longest_repeat int, removed array<int>"
    removed = df.sparkSession.createDataFrame([], schema)
    if found:
        every = found[0]
        for one in found[1:]:
            every = every.union(one)
        removed = every.groupBy(*_DOCUMENT).agg(
            F.max("length").alias("longest_repeat"),
            F.array_distinct(F.flatten(F.collect_list("marks"))).alias("removed"),
        )
    # numbered names, so that no column of the table is in the way
    names = [f"c{i}" for i in range(len(df.columns))]
    added = {kept_col.lower(), "n_lines", "n_removed", "longest_repeat"}
    own = [
        F.col(f"row.{n}").alias(c)
        for n, c in zip(names, df.columns, strict=True)
        if c.lower() not in added
    ]
    key = _key(id_col, text_col)
    rows = df.select(*key, F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"))
    kinds = ", ".join(f"{n}: {f.dataType.simpleString()}" for n, f in zip(names, df.schema, strict=True))
    rows = rows.withColumn("row", F.col("row").cast(f"struct<{kinds}>"))
    text = F.coalesce(F.col(f"row.{names[df.columns.index(text_col)]}").cast("string"), F.lit(""))
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    lines = F.split(text, "\n")
    left = F.filter(lines, lambda _, i: ~F.array_contains(F.col("gone"), i))
    n_lines = F.when(text == "", 0).otherwise(F.size(lines))
    return (
        rows.join(removed, _DOCUMENT, "left")
        .withColumn("gone", gone)
        .select(
            *own,
            F.when(F.size("gone") == 0, text).otherwise(F.array_join(left, "\n")).alias(kept_col),
            n_lines.cast("long").alias("n_lines"),
            F.size("gone").cast("long").alias("n_removed"),
            F.coalesce("longest_repeat", F.lit(0)).cast("long").alias("longest_repeat"),
        )
    )
