"""The monthly job: enrich, features, hourly store, each written into its month."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zoneflow.config import MonthWindow, StoreConfig
from zoneflow.operators.enrich import enrich_trips
from zoneflow.operators.hourly import feature_store_after, feature_store_month
from zoneflow.operators.quality import (
    duplicate_check, quality_gate, trip_rules, trip_schema_rules, value_set_rules, weather_rules, weather_schema_rules,
)
from zoneflow.operators.trips import trip_features, trip_quality_filter
from zoneflow.session import work_dir
from zoneflow.sources.releases import Manifest, Releases
from zoneflow.sources.sinks import in_window, read_months, write_month


@dataclass(frozen=True)
class Tables:
    """Paths of the month-partitioned tables."""

    base: str

    @property
    def enriched(self) -> str:
        return f"{self.base}/enriched_trips"

    @property
    def trips(self) -> str:
        return f"{self.base}/trip_features"

    @property
    def store(self) -> str:
        return f"{self.base}/hourly_zone_store"


def feature_store(trips: DataFrame, zones: DataFrame, weather: DataFrame, window: MonthWindow,
                  config: StoreConfig = StoreConfig()) -> DataFrame:
    """Store rows of a month, lazily, from raw inputs."""
    enriched = enrich_trips(trips, zones, weather, window)
    return feature_store_month(trip_quality_filter(trip_features(enriched, config), config), window, config)


# Rule groups of the quality gate; each may be left out.
CHECKS = ("schema", "ranges", "value_sets", "duplicates", "weather")


def check_month(trips: DataFrame, weather: DataFrame, window: MonthWindow, checks: Collection[str] = CHECKS) -> None:
    """Raise ``QualityError`` naming every rule that the month's inputs break.

    Schemas are checked first, as the other rules name columns. Those read the trips and weather of the window.
    """
    if unknown := set(checks) - set(CHECKS):
        raise ValueError(f"no rule group {sorted(unknown)}; known: {', '.join(CHECKS)}")
    if "schema" in checks:
        quality_gate(trip_schema_rules(trips), weather_schema_rules(weather))
    own = trips.filter(in_window("tpep_pickup_datetime", window))
    reports = {"ranges": lambda: trip_rules(own), "value_sets": lambda: value_set_rules(own),
               "duplicates": lambda: duplicate_check(own),
               "weather": lambda: weather_rules(weather.filter(in_window("date", window)))}
    quality_gate(*[report() for name, report in reports.items() if name in checks])


def build_month(spark: SparkSession, trips: DataFrame, zones: DataFrame, weather: DataFrame, month: str,
                tables: Tables, config: StoreConfig = StoreConfig(), check: bool | Collection[str] = True,
                enriched: bool = True) -> DataFrame:
    """Build one month and replace it in all tables; running it again changes nothing.

    ``check`` is True for all rule groups of the gate, or the groups wanted, or False. ``enriched`` also keeps the
    month's joined trips, before features and filters. Trip features of the month and its lookback are written once to
    the shared work folder, because the store reads them in narrow passes; the month's part goes to the trip table.
    """
    window = MonthWindow(month, config.lookback_months)
    if check:
        check_month(trips, weather, window, CHECKS if check is True else check)
    joined = enrich_trips(trips, zones, weather, window)
    if enriched:
        write_month(joined, tables.enriched, "tpep_pickup_datetime", window)
    kept = trip_quality_filter(trip_features(joined, config), config)
    staged_path = work_dir(spark)
    write_month(kept, staged_path, "tpep_pickup_datetime")
    staged = read_months(spark, staged_path)
    write_month(staged.drop("trip_month"), tables.trips, "tpep_pickup_datetime", window)
    write_month(feature_store_month(staged, window, config), tables.store, "ts_hour", window,
                order=("PUZone", "ts_hour"))
    return read_months(spark, tables.store)


STORE, TAILS, TRIPS, ENRICHED = "hourly_zone_store", "zone_tails", "trip_features", "enriched_trips"


def advance_month(spark: SparkSession, trips: DataFrame, zones: DataFrame, weather: DataFrame, month: str, releases: Releases,
                  config: StoreConfig = StoreConfig(), check: bool | Collection[str] = True) -> Manifest:
    """Build one month from its own trips and the zones' tails before it, and publish all its tables with one release.

    No earlier trip is read, and windows reach back as far as a zone's rows lie apart. The tails come from the newest month
    before this one. A month that is built again changes what later months rest on: build those again too
    (:func:`months_after`). Readers see the release before until all tables are written; if the job fails, they keep it.
    """
    window = MonthWindow(month, 0)
    if check:
        check_month(trips, weather, window, CHECKS if check is True else check)
    before = [m for m in releases.months(TAILS) if m < month]
    tails = releases.read(TAILS, MonthWindow(before[-1], 0)).drop("trip_month") if before else None
    with releases.transaction(f"build {month}") as publish:
        joined = publish.write_month(enrich_trips(trips, zones, weather, window), ENRICHED, "tpep_pickup_datetime", window)
        kept = publish.write_month(trip_quality_filter(trip_features(joined, config), config), TRIPS, "tpep_pickup_datetime", window)
        store, after = feature_store_after(tails, kept, window, config)
        publish.write_month(store, STORE, "ts_hour", window, order=("PUZone", "ts_hour"))
        publish.write_month(after, TAILS, None, window)
    return releases.manifest()


def months_after(releases: Releases, month: str) -> list[str]:
    """Published months that rest on the tails of ``month``, in the order to build them again."""
    return [m for m in releases.months(STORE) if m > month]
