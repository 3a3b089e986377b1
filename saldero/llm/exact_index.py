"""Exact duplicates against a persistent index of digests.

The index is a Parquet table bucketed and sorted by digest. An arrival is
reduced to one row per digest first, so the anti-join against the index sees
unique keys however often a text is repeated; the index side is read bucket by
bucket without a shuffle. Digests that are new are appended. The first arrival
of a digest owns it; inside an arrival the largest id does.

A null text counts as empty, a null id sorts below every other id. Rows that
repeat both id and text are told apart by ``row``, so exactly one row of a
group stays. Numbers of rows hold inside one load; the index names the load of
each owner, so a text that an earlier load brought keeps no row of a later one.
Extra columns are left alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import staged, text_or_empty

_SCHEMA = "digest STRING, owner_load BIGINT, owner_row BIGINT, owner_id BIGINT"


class DigestIndex:
    """One index at ``path``, registered in the session under a name of its own."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path = spark, path
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({_SCHEMA}) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
            f" LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, arrival: DataFrame) -> None:
        """Append the digests of ``arrival`` (digest, load, row, id) that the index lacks."""
        owners = arrival.groupBy("digest").agg(
            F.max(F.struct("id", "row", "load")).alias("owner")
        )
        new = owners.hint("merge").join(self.rows(), "digest", "left_anti")
        new.select(
            "digest",
            F.col("owner.load").alias("owner_load"),
            F.col("owner.row").alias("owner_row"),
            F.col("owner.id").alias("owner_id"),
        ).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def close(self) -> None:
        """Forget the name; the files stay for the next session."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(load, row, id, digest) of every row, stored, so that ``row`` stays what it is."""
    load = uuid.uuid4().int >> 65
    return staged(
        df.select(
            F.lit(load).cast("long").alias("load"),
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.sha2(text_or_empty(text_col), 256).alias("digest"),
        ),
        "digests",
    )


def arrivals_by_id(hashed: DataFrame, count: int) -> list[DataFrame]:
    """The rows in ``count`` arrivals of about equal size, the largest ids first."""
    shares = [i / count for i in range(1, count)]
    cuts = hashed.select(F.percentile_approx("id", shares, 1000)).first()[0] or []
    bounds = sorted(set(cuts))
    if not bounds:
        return [hashed]
    ranges = [hashed.where(F.col("id").isNull() | (F.col("id") <= bounds[0]))]
    for low, high in zip(bounds, bounds[1:], strict=False):
        ranges.append(hashed.where((F.col("id") > low) & (F.col("id") <= high)))
    ranges.append(hashed.where(F.col("id") > bounds[-1]))
    return ranges[::-1]


def group_copies(hashed: DataFrame, index: DigestIndex) -> DataFrame:
    """(row, id, digest, keep_id, group_size, kept) of every stored row.

    ``group_size`` counts rows of this load; the owner may be of an earlier one.
    The group table is stored before the join and read without its buckets, so
    adaptive execution may split the rows of a text that most documents share.
    """
    sizes = hashed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = staged(sizes.join(index.rows(), "digest"), "groups")
    # an index from before loads were named has none
    own = F.col("load").eqNullSafe(F.col("owner_load")) & (F.col("row") == F.col("owner_row"))
    return hashed.join(groups, "digest").select(
        "row",
        "id",
        "digest",
        F.col("owner_id").alias("keep_id"),
        "group_size",
        own.alias("kept"),
    )


def mark_copies(
    df: DataFrame,
    index_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    arrivals: int = 2,
    buckets: int = 16,
) -> DataFrame:
    """Every row with the group of its text; the largest id of a group stays.

    Of a text that the index knew before this load no row stays.
    The rows arrive at the index from the largest ids down, each arrival
    deduplicated against those before it.
    """
    hashed = digests(df, id_col=id_col, text_col=text_col)
    index = DigestIndex(df.sparkSession, index_path, buckets)
    for arrival in arrivals_by_id(hashed, arrivals):
        index.add(arrival)
    try:
        return group_copies(hashed, index)
    finally:
        # the groups are stored, so the name is not needed any more
        index.close()


def drop_copies(
    df: DataFrame, index_path: str, *, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``df`` without the rows whose text another row keeps, also one of an earlier load.

    Of rows that repeat both id and text any one stays. The texts are shuffled
    once, to meet the ids and digests that stay; only rows that repeat both are
    numbered. All columns stay as they are, whatever their names.
    """
    marked = mark_copies(df, index_path, id_col=id_col, text_col=text_col, **options)
    owners = staged(marked.where("kept").select("id", "digest"), "owners")
    twice = marked.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = staged(twice.join(owners.select("digest"), "digest", "left_semi"), "repeated")
    # numbered names, so that no column of the table is in the way
    names = [f"c{i}" for i in range(len(df.columns))]
    held = df.toDF(*names).withColumns(
        {
            "id": F.col(names[df.columns.index(id_col)]).cast("long"),
            "digest": F.sha2(text_or_empty(names[df.columns.index(text_col)]), 256),
        }
    )

    def among(rows: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
        pairs = pairs.select(F.col("id").alias("other"), F.col("digest").alias("same"))
        found = F.col("id").eqNullSafe(F.col("other")) & (F.col("digest") == F.col("same"))
        return rows.join(pairs, found, how)

    kept = among(held, owners, "left_semi").select(*names)
    if not twice.isEmpty():
        repeats = Window.partitionBy("id", "digest").orderBy("id")
        numbered = among(among(held, owners, "left_semi"), twice, "left_semi")
        one = numbered.withColumn("nth", F.row_number().over(repeats)).where("nth = 1")
        rest = among(among(held, owners, "left_semi"), twice, "left_anti")
        kept = rest.select(*names).union(one.select(*names))
    return kept.toDF(*df.columns)
