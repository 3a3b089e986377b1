"""Incremental runs driven by files that arrive in a landing folder.

Each run takes the files that came since the last one and ends. What a
micro-batch brings is published at once in the landed set: its rows by sale day,
with the file and batch they came from, and one line per file with what was
found in it. A file is known by its path and time of change, so neither a
repeated batch nor a new checkpoint lands it twice.

A file that comes again under its name replaces what it brought before: of all
rows only those count that came with the latest good arrival of their file. The
days that a batch touches, in its own rows or in rows it replaces, are rebuilt
whole from the landed rows with the batch jobs. A day left without rows goes.

Nothing that is wrong with a file or a day keeps a batch from being committed.
Files that break the contract or hold unreadable values are listed with the
reason and bring no rows. Days that break their rules are put in quarantine,
with the rules, until a later file mends them or ``replay_quarantine`` takes
them again. A run raises what it met after all its batches are done.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Limits, RulesBroken
from ..plans.jobs import curate_good_days, drop_days, load_good_days
from ..session import scratch
from ..sources.errors import SourceError
from ..sources.files import first_line
from ..sources.lake import DAY_PARTITION, LANDED, Lake
from ..sources.sales import (
    SALE_TYPES,
    SourceProfile,
    check_contract,
    drop_pii,
    read_csv_text,
    type_or_mark,
)
from ..sources.snapshots import TableSet

# New files that one micro-batch takes.
MAX_FILES = 1000
# Folders of a landed day below this size are merged.
SMALL_FOLDER = 32 << 20

SALES, FILES, QUARANTINE = "ventas", "archivos", "cuarentena"
_FILE_TYPES = {
    "file": "string",
    "modified": "timestamp",
    "batch": "long",
    "n_rows": "long",
    "n_undated": "long",
    "n_unreadable": "long",
    "reason": "string",
}
_QUARANTINE_TYPES = "day date, batch long, checks array<string>, message string, files array<string>"


def landed_set(spark: SparkSession, lake: Lake) -> TableSet:
    return TableSet(spark, lake.path(LANDED))


@dataclass
class LandingRun:
    """What one run met: days put in quarantine, files left out."""

    broken: list[RulesBroken] = field(default_factory=list)
    rejected: list[tuple[str, str]] = field(default_factory=list)

    def raise_if_anything(self) -> None:
        if self.rejected:
            listed = "; ".join(f"{file}: {reason}" for file, reason in self.rejected)
            raise SourceError(f"{len(self.rejected)} file(s) left out: {listed}")
        if self.broken:
            raise self.broken[0]


@dataclass(frozen=True)
class _Arrival:
    path: str
    file: str
    modified: dt.datetime


def _by_header(spark: SparkSession, arrivals: list[_Arrival]) -> list[list[_Arrival]]:
    """Files grouped by their first line, so that one reader serves all of a kind."""
    groups: dict[str, list[_Arrival]] = {}
    for arrival in sorted(arrivals, key=lambda a: a.path):
        groups.setdefault(first_line(spark, arrival.path), []).append(arrival)
    return list(groups.values())


def _arrived(
    spark: SparkSession, arrivals: list[_Arrival], profile: SourceProfile
) -> tuple[DataFrame | None, dict[str, str]]:
    """The rows of new files with their file, and why the header of others breaks the contract."""
    frames, refused = [], {}
    for same in _by_header(spark, arrivals):
        try:
            text = read_csv_text(spark, [a.path for a in same], path_col="_path")
            text = drop_pii(check_contract(text))
        except SourceError as error:
            refused |= {a.file: str(error) for a in same}
            continue
        typed = type_or_mark(text, profile, "_unreadable")
        kept = [F.col(c).cast(kind) for c, kind in SALE_TYPES.items() if c in typed.columns]
        frames.append(typed.select(*kept, F.col("_path").alias("file"), "_unreadable"))
    if not frames:
        return None, refused
    rows = frames[0]
    for other in frames[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    lacking = {c: F.lit(None).cast(k) for c, k in SALE_TYPES.items() if c not in rows.columns}
    return rows.withColumns(lacking) if lacking else rows, refused


def _latest(files: DataFrame) -> DataFrame:
    """(file, batch): the latest good arrival of every file."""
    return files.where("reason IS NULL").groupBy("file").agg(F.max("batch").alias("batch"))


def landed_sales(
    spark: SparkSession, lake: Lake, days: Iterable[dt.date] | None = None
) -> DataFrame:
    """The rows that count, of some days or all, with the file they came with."""
    tables = landed_set(spark, lake)
    version = tables.current()
    values = None if days is None else [str(d) for d in days]
    rows, files = tables.read(SALES, version, values), tables.read(FILES, version)
    return rows.join(_latest(files), ["file", "batch"], "left_semi")


def landed_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per file and batch: rows, rows without a date, unreadable rows, and why it was left out."""
    return landed_set(spark, lake).read(FILES)


def quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    """The days that wait for a repaired file: day, batch, checks, message, files."""
    tables = landed_set(spark, lake)
    version = tables.current()
    if version is None or QUARANTINE not in version.tables:
        return spark.createDataFrame([], _QUARANTINE_TYPES)
    return tables.read(QUARANTINE, version)


def _land(
    spark: SparkSession, arrivals: list[_Arrival], lake: Lake, profile: SourceProfile
) -> list[tuple[str, str]]:
    """Publish the files of a batch that are not known yet; those that are left out, and why."""
    tables = landed_set(spark, lake)
    draft = tables.draft()
    left_out, fresh = [], list(arrivals)
    if FILES in draft.base.tables:
        names = [a.file for a in arrivals]
        # as many lines as the batch has files, once for each arrival of them
        lines = tables.read(FILES, draft.base).where(F.col("file").isin(names)).collect()
        known = {(r["file"], r["modified"]): r["reason"] for r in lines}
        fresh = [a for a in arrivals if (a.file, a.modified) not in known]
        seen = [known.get((a.file, a.modified)) for a in arrivals]
        left_out = [(a.file, why) for a, why in zip(arrivals, seen, strict=True) if why]
    if not fresh:
        return left_out
    number = draft.base.ledger.get("batch", -1) + 1
    rows, refused = _arrived(spark, fresh, profile)
    # a file without rows is good, and replaces what it brought before
    found = {a.file: (0, 0, 0, refused.get(a.file)) for a in fresh}
    with scratch(spark, "landing") as folder:
        if rows is not None:
            rows.write.parquet(f"{folder}/rows")
            staged = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
            counts = staged.groupBy("file").agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("date").isNull() & ~F.col("_unreadable")).alias("undated"),
                F.count_if("_unreadable").alias("unreadable"),
            )
            # one row per file of the batch
            for r in counts.collect():
                bad = r["unreadable"]
                why = f"{bad} row(s) with an unreadable date or price" if bad else None
                found[r["file"]] = (r["n"], r["undated"], bad, why)
            bad_files = [file for file, line in found.items() if line[3]]
            good = staged.where(F.col("date").isNotNull() & ~F.col("file").isin(bad_files))
            landed = good.select(
                *SALE_TYPES,
                "file",
                F.lit(number).cast("long").alias("batch"),
                F.col("date").alias(DAY_PARTITION),
            )
            draft.write(SALES, landed, DAY_PARTITION, ("dealer_name",), append=True)
        kinds = ", ".join(f"{n} {k}" for n, k in _FILE_TYPES.items())
        lines = [(a.file, a.modified, number, *found[a.file]) for a in fresh]
        draft.write(FILES, spark.createDataFrame(lines, kinds).coalesce(1), append=True)
        draft.publish({"batch": number})
    return left_out + [(a.file, found[a.file][3]) for a in fresh if found[a.file][3]]


def _changed(spark: SparkSession, landing: str, lake: Lake) -> list[_Arrival]:
    """Known files that have been put in place again since they were read; their names only."""
    version = landed_set(spark, lake).current()
    if version is None:
        return []
    there = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path", F.col("_metadata.file_path").alias("file"), "modificationTime")
    )
    known = landed_files(spark, lake).groupBy("file").agg(F.max("modified").alias("modified"))
    newer = there.join(known, "file").where("modificationTime > modified")
    return [_Arrival(*r) for r in newer.select("path", "file", "modificationTime").collect()]


def _touched(spark: SparkSession, files: list[str], lake: Lake) -> list[dt.date]:
    """Days with rows of these files, older ones included: one value per day."""
    tables = landed_set(spark, lake)
    version = tables.current()
    if version is None or SALES not in version.tables:
        return []
    rows = tables.read(SALES, version).where(F.col("file").isin(files))
    return sorted(r[0] for r in rows.select(DAY_PARTITION).distinct().collect())


def _rebuild(
    spark: SparkSession, days: list[dt.date], lake: Lake, limits: Limits
) -> list[RulesBroken]:
    """Load and curate whole days from the landed rows; what broke goes into quarantine."""
    if not days:
        return []
    rows = landed_sales(spark, lake, days)
    broken = load_good_days(rows.select(*SALE_TYPES), lake, limits)
    # days of the batch that no rows are left of
    left = {r[0] for r in rows.select("date").distinct().collect()}
    drop_days(spark, [d for d in days if d not in left], lake)
    loaded = [d for d in days if d in left and d not in broken]
    broken |= curate_good_days(spark, loaded, lake, limits)
    _set_apart(spark, days, broken, rows, lake)
    return [broken[d] for d in sorted(broken)]


def _set_apart(
    spark: SparkSession,
    days: list[dt.date],
    broken: dict[dt.date, RulesBroken],
    rows: DataFrame,
    lake: Lake,
) -> None:
    """Take the days just tried out of the quarantine and put in those that broke."""
    before = [tuple(r) for r in quarantine(spark, lake).collect()]
    kept = [r for r in before if r[0] not in set(days)]
    if not broken and len(kept) == len(before):
        return
    found = rows.where(F.col("date").isin(list(broken))).groupBy("date")
    named = {r[0]: r[1] for r in found.agg(F.sort_array(F.collect_set("file"))).collect()}
    tables = landed_set(spark, lake)
    draft = tables.draft()
    number = draft.base.ledger["batch"]
    fresh = [
        (day, number, sorted(set(error.checks)), str(error), named.get(day, []))
        for day, error in broken.items()
    ]
    # a short row per broken day
    draft.write(QUARANTINE, spark.createDataFrame(kept + fresh, _QUARANTINE_TYPES).coalesce(1))
    draft.publish(draft.base.ledger)


def drain_landing(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    profile: SourceProfile,
    limits: Limits = Limits(),
) -> None:
    """Load and curate every sale day touched by files not seen before.

    All batches are committed first; then files left out or else the first
    broken rules are raised.
    """
    # the contents of the files are not read here, only their names
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", MAX_FILES)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path", F.col("_metadata.file_path").alias("file"), "modificationTime")
    )
    run = LandingRun()

    def take(batch: DataFrame, number: int) -> None:
        # at most MAX_FILES names
        load([_Arrival(*r) for r in batch.collect()])

    def load(arrivals: list[_Arrival]) -> None:
        left_out = _land(spark, arrivals, lake, profile)
        run.rejected += left_out
        bad = {file for file, _ in left_out}
        files = [a.file for a in arrivals if a.file not in bad]
        run.broken += _rebuild(spark, _touched(spark, files, lake), lake, limits)

    query = (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()
    # a stream takes a path once only, whatever is put there later
    changed = _changed(spark, landing, lake)
    for at in range(0, len(changed), MAX_FILES):
        load(changed[at : at + MAX_FILES])
    run.raise_if_anything()


def replay_quarantine(spark: SparkSession, lake: Lake, limits: Limits = Limits()) -> list[dt.date]:
    """Take all quarantined days again, under these limits; the days that are loaded now."""
    waiting = sorted(r["day"] for r in quarantine(spark, lake).select("day").collect())
    broken = {e.scope for e in _rebuild(spark, waiting, lake, limits)}
    return [d for d in waiting if not any(scope.endswith(f"{d}") for scope in broken)]


def compact_landing(spark: SparkSession, lake: Lake, small: int = SMALL_FOLDER) -> list[str]:
    """Merge the small folders that batches leave behind, and drop replaced rows' files in time.

    The days that were rewritten. Rows are kept as they are, replaced ones too.
    """
    tables = landed_set(spark, lake)
    tables.compact(FILES, small)
    return tables.compact(SALES, small, ("dealer_name",))
