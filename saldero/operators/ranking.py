"""Leader and top-N operators over already aggregated rows.

Thresholds are scalar subqueries (a distributed maximum, a distributed
top-k), so no ranking window gathers all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: size of the top-N report filters.
TOP_N = 10


def with_leader(rows: DataFrame, selection: DataFrame, value: str = "ventas") -> DataFrame:
    """Add the maximum of ``value`` over ``selection`` and the leader flag.

    Every row equal to the maximum is a leader; a missing value never is.
    """
    highest = selection.agg(F.max(value)).scalar()
    return rows.withColumn(f"{value}_max", highest).withColumn(
        "es_top", F.coalesce(F.col(value) == F.col(f"{value}_max"), F.lit(False))
    )


def top_n(rows: DataFrame, value: str = "ventas", n: int = TOP_N) -> DataFrame:
    """Rows whose value reaches the n-th largest; ties at the border all stay."""
    best = rows.where(F.col(value).isNotNull()).select(value).orderBy(F.desc(value)).limit(n)
    return rows.where(F.col(value) >= best.agg(F.min(value)).scalar())
