"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def quoted(name: str) -> str:
    """A column name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    It cuts the lineage at a place that survives a lost executor.
    """
    path = f"{scratch_path(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_slices(
    batch: pa.RecordBatch, column: int | str, limit: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch holding about ``limit`` bytes of text each.

    They are copies, because some string kernels misread arrays that begin at an offset.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    group = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(starts, starts[1:], strict=False):
        yield batch.take(pa.array(np.arange(begin, end)))
    # an idle worker would keep its peak into the next stage
    pa.default_memory_pool().release_unused()


def list_array(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
