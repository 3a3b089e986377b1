"""Reproducible pseudo-random columns derived from business keys.

The value depends only on the key text, so any batch, order or partitioning
of the same rows yields the same numbers and a lost task can be recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seed and the key separator are part of the hashed text.
SEED = 42
SEPARATOR = "|"
MISSING_KEY = "None"

_TWO_POW_64 = float(2**64)


def _key_text(key: str) -> str:
    # concat_ws would skip a null and silently change the remaining key
    return f"coalesce(cast({key} as string), '{MISSING_KEY}')"


def keyed_uniform(lo: float, hi: float, label: str, *keys: str) -> Column:
    """Uniform double in [lo, hi): leading 64 bits of SHA-256 over label and keys.

    ``keys`` are columns or SQL expressions. Sixteen hex digits become an
    unsigned decimal text and then the nearest double, which is the correctly
    rounded 64-bit integer; dividing by 2^64 is exact. Everything stays in
    generated JVM code.
    """
    parts = ", ".join([f"'{SEED}'", f"'{label}'", *map(_key_text, keys)])
    digest = f"sha2(concat_ws('{SEPARATOR}', {parts}), 256)"
    unit = f"cast(conv(substring({digest}, 1, 16), 16, 10) as double) / {_TWO_POW_64!r}D"
    return F.expr(f"{float(lo)!r}D + {float(hi) - float(lo)!r}D * ({unit})")
