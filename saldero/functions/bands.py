"""Conditional-format bands: a measure in, a colour (or null) out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report colours and the attainment thresholds.
GREEN = "#2E7D32"
AMBER = "#F9A825"
RED = "#C62828"
WHITE_TEXT = "#FFFFFF"
DARK_TEXT = "#1F2933"
LEADER_BAR = "#1F4E79"
OTHER_BAR = "#9DB9D2"
LEADER_BACKGROUND = "#FFF3CD"
ON_TARGET = 1.0
NEAR_TARGET = 0.9


def attainment_band(ratio: Column) -> Column:
    return (
        F.when(ratio >= F.lit(ON_TARGET), F.lit(GREEN))
        .when(ratio >= F.lit(NEAR_TARGET), F.lit(AMBER))
        .when(ratio.isNotNull(), F.lit(RED))
    )


def attainment_text(ratio: Column) -> Column:
    """Dark text on amber, white on green and red."""
    near = (ratio >= F.lit(NEAR_TARGET)) & (ratio < F.lit(ON_TARGET))
    return F.when(near, F.lit(DARK_TEXT)).when(ratio.isNotNull(), F.lit(WHITE_TEXT))


def sign_band(value: Column) -> Column:
    return F.when(value < F.lit(0), F.lit(RED)).when(value.isNotNull(), F.lit(GREEN))


def sign_text(value: Column) -> Column:
    return F.when(value.isNotNull(), F.lit(WHITE_TEXT))


def leader_bar(is_leader: Column) -> Column:
    return F.when(is_leader, F.lit(LEADER_BAR)).otherwise(F.lit(OTHER_BAR))


def leader_background(is_leader: Column) -> Column:
    return F.when(is_leader, F.lit(LEADER_BACKGROUND))
