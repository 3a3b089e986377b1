"""Fingerprints of the content of rows, whatever their order, files or partitions.

Each row is hashed twice to 64 bits, with a mask of its nulls, and the hashes are
summed. Sums do not depend on the order, count repeated rows, and combine on the
map side, so a day of any size costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = ("content_1", "content_2")


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    # a null leaves the hash of its neighbours as it is, so the mask tells where it stands
    mask = F.lit(0).cast("long")
    for place, name in enumerate(columns):
        mask = mask + F.when(F.col(name).isNull(), F.lit(2**place)).otherwise(F.lit(0))
    forward, backward = [F.col(c) for c in columns], [F.col(c) for c in reversed(columns)]
    return [F.xxhash64(F.lit(1), mask, *forward), F.xxhash64(F.lit(2), mask, *backward)]


def content_sums(columns: Sequence[str]) -> list[Column]:
    """Aggregates that fingerprint the rows of a group by some of their columns."""
    if len(columns) > 62:
        raise ValueError("a mask of nulls holds 62 columns")
    hashes = _row_hashes(columns)
    return [F.sum(h.cast("decimal(38,0)")).alias(n) for h, n in zip(hashes, SUMS, strict=True)]


def fingerprint(n: str = "n_rows", sums: Sequence[str] = SUMS) -> Column:
    """One short text from a count and both sums."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in (n, *sums)])


def fingerprints(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(by, n_rows, both sums, fingerprint) of each group of rows."""
    counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *content_sums(columns))
    return counted.withColumn("fingerprint", fingerprint())
