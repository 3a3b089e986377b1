"""Dates read by the shape of their texts instead of by a list of formats.

One pass replaces digits, month names and the like by codes and counts the
shapes that are left, with the dates that each order of the fields would give.
Callers may hand in each text once with the number of its rows.
The shape tells which field is the year or a month's name; where two orders of
year, month and day remain, the values decide: an order stays only if every
date of the load is one under it. A load that still fits two orders is
ambiguous. It is read month first, as is usual for such texts, or refused with
its evidence. The date is the one written, whatever time or offset follows it.
"""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .errors import SourceError

# Shapes that an error or a decision looks at; a load of one format has few.
MOST_SHAPES = 50
# Two digits from here on belong to the last century.
PIVOT = 69

_MONTHS = [name.lower() for name in calendar.month_name[1:]]
_MONTH = "|".join(f"{m}|{m[:3]}" for m in _MONTHS) + "|sept"
_WEEKDAY = "|".join(f"{d.lower()}|{d.lower()[:3]}" for d in calendar.day_name)
# What is replaced by a code, in this order.
_CODES = (
    (rf"(?i)\b(?:{_MONTH})\b\.?", "{M}"),
    (rf"(?i)\b(?:{_WEEKDAY})\b\.?", "{E}"),
    (r"(?i)(?<=[\d ])[ap]\.?m\b\.?", "{P}"),
    (r"(?<=\d)T(?=\d)", "{T}"),
    (r"(?i)(?<=[\d ])(?:z|utc|gmt)$", "{Z}"),
    (r"(?<![{\p{L}])\p{L}+(?![}\p{L}])", "{x}"),
    (r"(?<!\d)\d{8}(?!\d)", "{c}"),
    (r"(?<!\d)\d{4}(?!\d)", "{y}"),
    (r"(?<!\d)\d{1,2}(?!\d)", "{d}"),
    (r"\d+", "{n}"),
)
_TIME = r"(?:(?:,? |\{T\})\{d\}:\{d\}(?::\{d\}(?:[.,]\{[dync]\})?)?(?: ?\{P\})?(?: ?(?:\{Z\}|[+-](?:\{d\}:\{d\}|\{y\}|\{d\})))?)?"
_GAP = r"([-/. ]|, ?|\. )"
_DATED = re.compile(
    rf"(?:\{{E\}},? )?(?:(\{{c\}})|\{{([dyM])\}}{_GAP}\{{([dyM])\}}{_GAP}\{{([dyM])\}}){_TIME}"
)
_CLOCK = r"(?:(?:,? |T)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?: ?[AaPp]\.?[Mm]\.?)?(?: ?(?:[Zz]|UTC|GMT|[+-]\d{2}:?\d{0,2}))?)?"

# Orders that the fields of a shape can have, by their codes; the usual one first.
_ORDERS = {
    "ydd": ("ymd", "ydm"),
    "ddy": ("mdy", "dmy"),
    "ddd": ("mdy", "dmy", "ymd"),
    "Mdy": ("mdy",),
    "dMy": ("dmy",),
    "yMd": ("ymd",),
    "ydM": ("ydm",),
    "Mdd": ("mdy",),
    "dMd": ("dmy", "ymd"),
    "c": ("ymd",),
}


@dataclass(frozen=True)
class DateReading:
    """How the dates of a load are read: codes of the fields, what is between them, their order."""

    codes: str
    gaps: tuple[str, ...]
    order: str

    def pattern(self) -> str:
        """A regular expression with one group for each field."""
        day = rf"(?:(?i:{_WEEKDAY})\.?,? )?"
        if self.codes == "c":
            return rf"^\s*{day}(\d{{4}})(\d{{2}})(\d{{2}}){_CLOCK}\s*$"
        field = {"d": r"(\d{1,2})", "y": r"(\d{4})", "M": rf"((?i:{_MONTH}))\.?"}
        parts = [field[c] for c in self.codes]
        if "y" not in self.codes:
            parts[self.order.index("y")] = r"(\d{2})"
        gaps = [re.escape(g) for g in self.gaps]
        return rf"^\s*{day}{parts[0]}{gaps[0]}{parts[1]}{gaps[1]}{parts[2]}{_CLOCK}\s*$"

    def parse(self, text: Column) -> Column:
        """The date of a text, null where it does not have this form or is no date."""
        place = {role: n + 1 for n, role in enumerate(self.order)}
        pattern = self.pattern()
        if "M" not in self.codes and ("y" in self.codes or self.codes == "c"):
            # one match for each text; the mark keeps texts without one from being read
            moved = F.regexp_replace(text, pattern, f"~${place['y']}-${place['m']}-${place['d']}")
            return F.to_date(F.try_to_timestamp(moved, F.lit("'~'yyyy-M-d")))
        year, month, day = (F.regexp_extract(text, pattern, place[r]) for r in "ymd")
        if "M" in self.codes:
            month = _month_number(month)
        if "y" not in self.codes:
            number = F.try_to_number(year, F.lit("99")).cast("int")
            year = (number + F.when(number >= PIVOT, 1900).otherwise(2000)).cast("string")
        # a text of another form gives empty fields, and those no date
        return F.to_date(F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-M-d")))


def _month_number(word: Column) -> Column:
    numbers = [F.lit(x) for n, name in enumerate(_MONTHS, start=1) for x in (name[:3], str(n))]
    return F.coalesce(F.try_element_at(F.create_map(*numbers), F.lower(F.substring(word, 1, 3))), F.lit(""))


def shape(text: Column) -> Column:
    """The text with codes for its fields."""
    out = F.trim(text)
    for pattern, code in _CODES:
        out = F.regexp_replace(out, pattern, code)
    return out


def _candidates(found: str) -> list[DateReading]:
    match = _DATED.fullmatch(found)
    if match is None:
        return []
    if match.group(1):
        codes, gaps = "c", ()
    else:
        codes = match.group(2) + match.group(4) + match.group(6)
        gaps = (match.group(3), match.group(5))
    return [DateReading(codes, gaps, order) for order in _ORDERS.get(codes, ())]


def shapes_of(text: DataFrame, column: str = "date", counted: str | None = None) -> list[Row]:
    """(shape, n, example) of the non-null texts, the most frequent first, a bounded number.

    ``counted`` names a column that tells how many rows a row stands for.
    """
    filled = text.where(F.col(column).isNotNull()).select(
        F.col(column).alias("text"), (F.lit(1) if counted is None else F.col(counted)).alias("rows")
    )
    grouped = filled.groupBy(shape(F.col("text")).alias("shape")).agg(
        F.sum("rows").alias("n"), F.first("text").alias("example")
    )
    return grouped.orderBy(F.desc("n"), "shape").limit(MOST_SHAPES + 1).collect()


def _listed(shapes: list[Row]) -> str:
    return ", ".join(f"{s['shape']} ({s['n']}, as in {s['example']!r})" for s in shapes[:5])


def common_readings(shapes: list[Row]) -> list[DateReading]:
    """The readings that every shape of a load allows."""
    if not shapes:
        return [DateReading("ydd", ("-", "-"), "ymd")]
    if len(shapes) > MOST_SHAPES:
        raise SourceError(f"no single date format fits the load; among its shapes: {_listed(shapes)}")
    common = _candidates(shapes[0]["shape"])
    for other in shapes[1:]:
        allowed = _candidates(other["shape"])
        common = [c for c in common if c in allowed]
    if not common:
        raise SourceError(f"no single date format fits the load; its shapes: {_listed(shapes)}")
    return common


def unread(
    readings: list[DateReading], column: str = "date", counted: str | None = None
) -> list[Column]:
    """For each reading an aggregate that counts the texts which are no dates under it."""
    text = F.col(column)
    rows = F.lit(1) if counted is None else F.col(counted)
    return [
        F.coalesce(F.sum(F.when(text.isNotNull() & r.parse(text).isNull(), rows)), F.lit(0)).alias(f"unread_{i}")
        for i, r in enumerate(readings)
    ]


def choose(
    readings: list[DateReading], counts: Row, shapes: list[Row], refuse_ambiguous: bool
) -> DateReading:
    """The reading under which every text is a date."""
    failing = [counts[f"unread_{i}"] for i in range(len(readings))]
    fitting = [r for r, n in zip(readings, failing, strict=True) if n == 0]
    if not fitting:
        least = min(failing)
        raise SourceError(
            f"no single date format fits the load; at best {least} dates fail: {_listed(shapes)}"
        )
    if len(fitting) > 1 and refuse_ambiguous:
        orders = " or ".join(r.order for r in fitting)
        raise SourceError(
            f"the dates of the load can be read as {orders}, no value decides: {_listed(shapes)}"
        )
    return fitting[0]
