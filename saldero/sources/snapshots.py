"""Sets of stored tables that are published together, version by version.

Below the root of a set lie

- ``<table>/[<partition>=<value>/]snap=<token>/`` with Parquet files, and
- ``_versions/<number>.json``, one pointer per version, put in place by a rename.

A pointer names the folders that its version consists of. A publication writes
new folders under a token of its own and then adds the next pointer; until that
rename every reader sees the version before, and after it the whole new one. Of
two publications from one version the second finds the number taken and fails.
Partitions that a publication does not touch are named again, not copied, so a
change of one month costs one month. Readers resolve the pointer once and are
not affected by later versions while theirs is kept.

The ledger of a version is what its writer wants to remember with it, such as
the source it was made from; the tokens of an upstream set tell, partition by
partition, whether the source has changed since.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path
from .errors import LakeNotReady
from .files import bytes_below, create_text, names_below, read_text
from .lake import NULL_PARTITION, WRITE_SETTINGS, session_settings

SNAP = "snap"
VERSIONS = "_versions"
# Versions that stay readable, the current one included.
KEPT = 3

_POINTER = re.compile(r"(\d{10})\.json")
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


class PublicationConflict(Exception):
    """Someone else published the next version first."""


@dataclass(frozen=True)
class Table:
    """One table of a version: its columns, and the tokens of each partition value.

    A table without partitions has the one value "". A value has more than one
    token after rows were appended to it.
    """

    schema: str
    partition: str | None
    parts: dict[str, list[str]]

    def tokens(self) -> set[str]:
        return {t for found in self.parts.values() for t in found}


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    ledger: dict = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {name: vars(table) for name, table in self.tables.items()}
        return json.dumps({"number": self.number, "tables": tables, "ledger": self.ledger})

    @classmethod
    def from_json(cls, text: str) -> Version:
        read = json.loads(text)
        tables = {name: Table(**table) for name, table in read["tables"].items()}
        return cls(read["number"], tables, read["ledger"])


@dataclass(frozen=True)
class TableSet:
    spark: SparkSession
    root: str
    kept: int = KEPT

    def _numbers(self) -> list[int]:
        found = (_POINTER.fullmatch(n) for n in names_below(self.spark, f"{self.root}/{VERSIONS}"))
        return sorted(int(m.group(1)) for m in found if m)

    def version(self, number: int) -> Version:
        return Version.from_json(read_text(self.spark, self._pointer(number)))

    def _pointer(self, number: int) -> str:
        return f"{self.root}/{VERSIONS}/{number:010d}.json"

    def current(self) -> Version | None:
        """The version that readers see, None before the first publication."""
        numbers = self._numbers()
        return self.version(numbers[-1]) if numbers else None

    def history(self) -> list[Version]:
        """The versions that are still kept, oldest first."""
        return [self.version(n) for n in self._numbers()]

    def folders(self, name: str, table: Table, value: str) -> list[str]:
        part = f"/{table.partition}={value}" if table.partition else ""
        return [f"{self.root}/{name}{part}/{SNAP}={token}" for token in table.parts[value]]

    def read(
        self,
        name: str,
        version: Version | None = None,
        values: Iterable[str] | None = None,
    ) -> DataFrame:
        """A table of a version, by default the current one.

        With ``values`` only the folders of these partition values are listed.
        """
        version = self.current() if version is None else version
        if version is None or name not in version.tables:
            raise LakeNotReady(f"no published table {name} below {self.root}")
        table = version.tables[name]
        schema = StructType.fromJson(json.loads(table.schema))
        wanted = table.parts if values is None else [v for v in values if v in table.parts]
        paths = [f for v in sorted(wanted) for f in self.folders(name, table, v)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # one task per core lists the folders, not one per folder
        listing = {_LISTING_TASKS: str(self.spark.sparkContext.defaultParallelism)}
        with session_settings(self.spark, listing):
            reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
            return reader.parquet(*paths).select(*schema.names)

    def draft(self) -> Draft:
        """The next version, to be written and published."""
        base = self.current() or Version()
        return Draft(self, base, f"{base.number + 1:010d}-{uuid.uuid4().hex[:8]}")

    def compact(self, name: str, small: int, sort_by: Iterable[str] = ()) -> list[str]:
        """Rewrite the partition values that lie in several folders of less than ``small`` bytes.

        Afterwards such a value is one folder, written by as few tasks as its
        size needs. It is one publication like any other: readers of the version
        before keep its folders, and a failure on the way changes nothing.
        """
        version = self.current()
        if version is None or name not in version.tables:
            return []
        table, scattered = version.tables[name], []
        for value, tokens in table.parts.items():
            if len(tokens) > 1:
                sizes = [bytes_below(self.spark, f) for f in self.folders(name, table, value)]
                if sum(sizes) < small * len(sizes):
                    scattered.append(value)
        if scattered:
            draft = self.draft()
            rows = self.read(name, draft.base, scattered)
            draft.write(name, rows, table.partition, sort_by, only=scattered)
            draft.publish(version.ledger)
        return sorted(scattered)

    def vacuum(self) -> list[str]:
        """Drop versions beyond ``kept`` and folders that no kept version names.

        Pointers go first: a version whose folders are being deleted cannot be
        opened any more. Folders of a publication still under way bear a later
        number and stay.
        """
        numbers = self._numbers()
        if not numbers:
            return []
        for number in numbers[: -self.kept]:
            remove_path(self.spark, self._pointer(number))
        alive = [self.version(n) for n in numbers[-self.kept :]]
        dropped = []
        for name in names_below(self.spark, self.root):
            if name != VERSIONS:
                used = {t for v in alive if name in v.tables for t in v.tables[name].tokens()}
                dropped += self._sweep(f"{self.root}/{name}", used, numbers[-1])
        return dropped

    def _sweep(self, folder: str, used: set[str], newest: int) -> list[str]:
        dropped, left = [], []
        for name in names_below(self.spark, folder):
            path = f"{folder}/{name}"
            if name.startswith(f"{SNAP}="):
                token = name.partition("=")[2]
                # a token is never used again, so no other partition needs its name
                if token not in used and int(token.partition("-")[0]) <= newest:
                    remove_path(self.spark, path)
                    dropped.append(path)
                    continue
            elif "=" in name:
                dropped += self._sweep(path, used, newest)
                if not names_below(self.spark, path):
                    remove_path(self.spark, path)
                    continue
            left.append(name)
        return dropped


class Draft:
    """A version under way. Tables that are not written stay as they were."""

    def __init__(self, tables: TableSet, base: Version, token: str):
        self.set, self.base, self.token = tables, base, token
        self.tables = dict(base.tables)

    def write(
        self,
        name: str,
        df: DataFrame,
        partition: str | None = None,
        sort_by: Iterable[str] = (),
        *,
        cluster_by: Iterable[str] = (),
        only: Iterable[str] | None = None,
        append: bool = False,
    ) -> DataFrame:
        """Write a table and return it read back, before anyone else can see it.

        ``only`` names the partition values that ``df`` stands for: all others
        stay as they were, and a named value without rows goes. With ``append``
        the rows come beside those that are there. Without either the table is
        replaced. ``cluster_by`` gives a file a narrow range of these
        columns inside its partition values; the last of them should split hot
        values of the first.
        """
        spark, order = self.set.spark, list(sort_by)
        stamped = df.withColumn(SNAP, F.lit(self.token))
        keys = [partition] if partition else []
        cluster = list(cluster_by)
        if cluster:
            # sampled bounds; adaptive execution merges neighbouring ranges that are small
            arranged = stamped.repartitionByRange(*keys, *cluster)
            order = order or cluster
        else:
            arranged = stamped.hint("rebalance", *keys)
        if keys or order:
            arranged = arranged.sortWithinPartitions(*keys, *order)
        written = Observation()
        label = F.col(partition).cast("string") if partition else F.lit("")
        # one short value per partition, which the writer lists as well
        values = F.collect_set(F.coalesce(label, F.lit(NULL_PARTITION)))
        with session_settings(spark, WRITE_SETTINGS):
            (
                arranged.observe(written, values.alias("values"))
                .write.mode("append")
                .partitionBy(*keys, SNAP)
                .parquet(f"{self.set.root}/{name}")
            )
        parts = {value: [self.token] for value in written.get["values"] or []}
        before = self.base.tables[name].parts if name in self.base.tables else {}
        if append:
            parts = before | {v: [*before.get(v, []), *t] for v, t in parts.items()}
        elif only is not None:
            named = set(only)
            stray = set(parts) - named
            if stray:
                raise ValueError(f"{name}: rows of partitions that were not named: {sorted(stray)}")
            parts = {v: t for v, t in before.items() if v not in named} | parts
        self.tables[name] = Table(df.schema.json(), partition, parts)
        return self.read(name)

    def remove(self, name: str, values: Iterable[str]) -> None:
        """Leave these partition values out of the version."""
        if name in self.tables:
            gone, table = set(values), self.tables[name]
            kept = {v: t for v, t in table.parts.items() if v not in gone}
            self.tables[name] = Table(table.schema, table.partition, kept)

    def read(self, name: str, values: Iterable[str] | None = None) -> DataFrame:
        return self.set.read(name, self.version(), values)

    def version(self, ledger: dict | None = None) -> Version:
        return Version(self.base.number + 1, self.tables, ledger or {})

    def publish(self, ledger: dict | None = None) -> Version:
        """Make this the current version, then drop what is no longer kept."""
        version = self.version(ledger)
        pointer = self.set._pointer(version.number)
        if not create_text(self.set.spark, pointer, version.to_json()):
            raise PublicationConflict(f"version {version.number} of {self.set.root} exists already")
        self.set.vacuum()
        return version
