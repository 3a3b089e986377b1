"""Typed tables and mart views over the curated lake.

Typed tables and stored marts are two sets of tables, each published as a whole:
a reader sees all tables of one version or all of another. The marts remember
which stored months they were made of, so that a merge recomputes the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch
from ..sources.errors import LakeNotReady
from ..sources.lake import (
    CURATED_EXPENSES,
    CURATED_SALES,
    CURATED_TARGETS,
    DAY_PARTITION,
    MARTS,
    MONTH_PARTITION,
    TYPED_TABLES,
    Lake,
    layer_schema,
    read_layer,
    read_months,
)
from ..sources.snapshots import TableSet, Version
from .jobs import CURATED_TYPES
from .marts import (
    Marts,
    dealer_months,
    derived_results,
    dim_month,
    regions_to_days,
    typed_expenses,
    typed_sales,
    typed_targets,
)

REQUIRED_LAYERS = (CURATED_SALES, CURATED_EXPENSES, CURATED_TARGETS)

# typed table -> its curated layer, its projection, the order inside a month, and
# what makes its files narrow: dealers, a hot one split by day and sale
_TABLES = {
    "ventas": (CURATED_SALES, typed_sales, (), ("dealer_name", "fecha", "car_id")),
    "gastos_mensuales": (CURATED_EXPENSES, typed_expenses, ("dealer_name",), ()),
    "objetivos": (CURATED_TARGETS, typed_targets, ("dealer_name",), ()),
}
_PARTITION = "mes"
# Stored marts; the last one holds what the dimensions are made of.
_FACTS = ("kpi_diario", "kpi_mensual")
_MONTHS = "meses_concesionaria"
_DIMENSIONS = ("dim_concesionaria", "dim_fecha")


def staging_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The three curated layers as frames; an empty one stops the refresh."""
    layers = {layer: read_layer(spark, lake.path(layer)) for layer in REQUIRED_LAYERS[1:]}
    layers[CURATED_SALES] = read_layer(
        spark, lake.path(CURATED_SALES), schema=layer_schema(CURATED_TYPES, DAY_PARTITION)
    )
    missing = [layer for layer in REQUIRED_LAYERS if layers[layer] is None]
    if missing:
        raise LakeNotReady(f"these curated layers have no files yet: {missing}")
    return {name: layers[layer] for name, (layer, *_) in _TABLES.items()}


def register_staging(spark: SparkSession, lake: Lake) -> list[str]:
    """Curated layers as temporary ``ext_`` views without storage of their own."""
    names = []
    for name, frame in staging_tables(spark, lake).items():
        frame.createOrReplaceTempView(f"ext_{name}")
        names.append(f"ext_{name}")
    return names


def typed_set(spark: SparkSession, lake: Lake) -> TableSet:
    return TableSet(spark, lake.path(TYPED_TABLES))


def mart_set(spark: SparkSession, lake: Lake) -> TableSet:
    return TableSet(spark, lake.path(MARTS))


def refresh_tables(spark: SparkSession, lake: Lake) -> list[str]:
    """Rebuild the typed tables in full, partitioned by month, and publish all three at once.

    Files of a month hold narrow ranges of dealers, so that a dealer filter
    skips files and row groups by their statistics.
    """
    staging, draft = staging_tables(spark, lake), typed_set(spark, lake).draft()
    for name, (_, project, order, cluster) in _TABLES.items():
        draft.write(name, project(staging[name]), _PARTITION, order, cluster_by=cluster)
    draft.publish()
    return list(_TABLES)


def refresh_months(spark: SparkSession, lake: Lake, months: Iterable[dt.date]) -> list[str]:
    """Replace only the given months of the typed tables, in one publication.

    A month that has no curated rows any more leaves the tables.
    """
    wanted = sorted(set(months))
    if not wanted:
        return []
    # only the directories of these months are listed
    labels = ",".join(f"{m:%Y-%m}" for m in wanted)
    sources = {
        CURATED_SALES: read_months(spark, lake.path(CURATED_SALES), wanted, CURATED_TYPES)
    }
    for layer in REQUIRED_LAYERS[1:]:
        path = lake.path(layer)
        sources[layer] = read_layer(spark, f"{path}/{MONTH_PARTITION}={{{labels}}}", base=path)
    draft, values = typed_set(spark, lake).draft(), [f"{m:%Y-%m-%d}" for m in wanted]
    for name, (layer, project, order, cluster) in _TABLES.items():
        if sources[layer] is None:
            draft.remove(name, values)
        else:
            rows = project(sources[layer])
            draft.write(name, rows, _PARTITION, order, cluster_by=cluster, only=values)
    draft.publish()
    return list(_TABLES)


def _opened(tables: TableSet, version: Version | None, months: list[str] | None = None) -> dict:
    missing = [n for n in _TABLES if version is None or n not in version.tables]
    if missing:
        raise LakeNotReady(f"typed tables not built yet: {missing}")
    return {name: tables.read(name, version, months) for name in _TABLES}


def open_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The typed tables of one version."""
    tables = typed_set(spark, lake)
    return _opened(tables, tables.current())


def _marts_of(tables: TableSet, version: Version | None, months: list[str] | None = None) -> Marts:
    found = _opened(tables, version, months)
    marts = Marts.from_tables(found["ventas"], found["gastos_mensuales"], found["objetivos"])
    return replace(marts, source={name: version.tables[name].parts for name in _TABLES})


def open_marts(spark: SparkSession, lake: Lake) -> Marts:
    """The marts as views over the typed tables of one version."""
    tables = typed_set(spark, lake)
    return _marts_of(tables, tables.current())


def register_marts(marts: Marts) -> list[str]:
    """The four mart views, replaced when they exist."""
    for name, frame in marts.views().items():
        frame.createOrReplaceTempView(name)
    return list(marts.views())


def refresh_warehouse(spark: SparkSession, lake: Lake) -> list[str]:
    """Staging views, typed tables and mart views, in this order."""
    names = register_staging(spark, lake)
    names += refresh_tables(spark, lake)
    return names + register_marts(open_marts(spark, lake))


def _publish_marts(tables: TableSet, marts: Marts, only: list[str] | None = None) -> Marts:
    """Store the marts, or ``only`` some of their months, as the next version.

    The sales are read once, for sums per day, dealer and region. Both facts
    follow from these, and the dimensions from the bounds kept for each month.
    """
    draft, spark = tables.draft(), tables.spark
    with scratch(spark, "marts") as folder:
        marts.by_region.write.parquet(f"{folder}/rows")
        by_region = spark.read.schema(marts.by_region.schema).parquet(f"{folder}/rows")
        order = ("dealer_name",)
        months = dealer_months(by_region)
        stored = draft.write("kpi_diario", regions_to_days(by_region), _PARTITION, order, only=only)
        draft.write(_MONTHS, months, _PARTITION, order, only=only)
        recent = stored if only is None else draft.read("kpi_diario", only)
        whole = marts.over(recent, draft.read(_MONTHS))
        draft.write("kpi_mensual", whole.kpi_mensual, _PARTITION, order, only=only)
        for name in _DIMENSIONS:
            draft.write(name, getattr(whole, name))
    return _stored(tables, draft.publish({"source": marts.source}))


def _stored(tables: TableSet, version: Version) -> Marts:
    found = {name: tables.read(name, version) for name in (*_FACTS, *_DIMENSIONS)}
    return Marts(
        **found,
        dim_mes=dim_month(found["dim_fecha"]),
        results=derived_results,
        source=version.ledger.get("source"),
    )


def import_marts(spark: SparkSession, lake: Lake, marts: Marts) -> Marts:
    """Store the marts in full, publish them at once and return them read back.

    Reports then start from facts at dealer-month and dealer-day grain instead
    of aggregating the sales again for each question, and a month filter reads
    only its own directories.
    """
    return _publish_marts(mart_set(spark, lake), marts)


def open_stored_marts(spark: SparkSession, lake: Lake) -> Marts:
    """The published marts, all tables of one version."""
    tables = mart_set(spark, lake)
    version = tables.current()
    if version is None:
        raise LakeNotReady("no marts have been stored yet")
    return _stored(tables, version)


def changed_months(source: dict, since: dict) -> list[str]:
    """Months stored anew, added or gone in any of the tables since ``since``."""
    months = set()
    for name in _TABLES:
        now, then = source[name], since.get(name, {})
        months |= {m for m in {*now, *then} if now.get(m) != then.get(m)}
    return sorted(months)


def merge_marts(spark: SparkSession, lake: Lake) -> list[str]:
    """Bring the stored marts up to date with the typed tables; the months recomputed.

    Months are compared by what the marts remember of the publication they were
    made from. Only the months that changed are read and written; everything
    else is named again. Marts of unknown origin are imported in full.
    """
    typed, marts = typed_set(spark, lake), mart_set(spark, lake)
    source, stored = typed.current(), marts.current()
    everything = _marts_of(typed, source)
    since = stored.ledger.get("source") if stored else None
    if since is None:
        _publish_marts(marts, everything)
        return sorted(everything.source["ventas"])
    months = changed_months(everything.source, since)
    if months:
        _publish_marts(marts, replace(_marts_of(typed, source, months), source=everything.source), months)
    return months
