"""Token counts of whole texts without ever materialising the tokens.

Arrow batches go to the encoder in slices of about equal bytes and only lengths
come back. A long text is first cut where no token can span the cut, so that
its pieces spread over the cluster, and the counts of its pieces are summed.

Null and empty texts have no tokens. A row counts by itself, so ties and
repeated rows need no rule. Extra columns are not returned; the id columns may
have any names and hold nulls.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import vocabulary
from .frames import byte_slices

# A run of white space begins a token, whatever stands before it.
_SAFE_CUT = re.compile(r"(?<=[^\s])(?=\s)")


def safe_pieces(text: str, size: int) -> Iterator[str]:
    """The text in pieces of at least ``size`` characters that end at safe boundaries.

    A boundary lies between a visible character and white space. A stretch
    without one stays whole, however long it is.
    """
    begin = 0
    while len(text) - begin > size:
        cut = _SAFE_CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def count_tokens(
    df: DataFrame,
    vocabulary_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_chars: int = 65_536,
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` per row of ``df``."""
    row, text = F.struct(F.col(id_col).alias("id")), F.coalesce(text_col, F.lit(""))
    source = df.select(row.alias("row"), text.alias("text"))
    is_long = F.length("text") > long_chars
    piece = T.StructType(
        [T.StructField("key", T.LongType()), source.schema["row"], T.StructField("text", T.StringType())]
    )
    counted = T.StructType(
        [*piece.fields[:2], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                pieces = list(safe_pieces(text, long_chars // 4))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take([i] * len(pieces)),
                        batch.column(1).take([i] * len(pieces)),
                        pa.array(pieces),
                    ],
                    names=["key", "row", "text"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_path)
        for batch in batches:
            for part in byte_slices(batch, 2, slice_bytes):
                texts = part.column(2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pc.binary_length(texts).cast(pa.int64()),
                        pa.array(words.count(texts.to_pylist()), pa.int64()),
                    ],
                    names=["key", "row", "n_bytes", "n_tokens"],
                )

    whole = source.where(~is_long).select(F.lit(0).cast("long").alias("key"), "row", "text")
    short = whole.mapInArrow(count, counted).drop("key")
    # the key tells repeated rows apart
    keyed = source.where(is_long).select(
        F.monotonically_increasing_id().alias("key"), "row", "text"
    )
    pieces = keyed.mapInArrow(cut, piece)
    spread = pieces.repartition(F.xxhash64("key", "text"))
    summed = (
        spread.mapInArrow(count, counted)
        .groupBy("key")
        .agg(
            F.first("row").alias("row"),
            F.sum("n_bytes").alias("n_bytes"),
            F.sum("n_tokens").alias("n_tokens"),
        )
    )
    return short.unionByName(summed.drop("key")).select(
        F.col("row.id").alias(id_col), "n_bytes", "n_tokens"
    )
