"""Registered queries: every operator over the whole test tables.

``present`` gives all results one form for comparison with the SQL check: doubles at six decimals (as the
two engines add in different orders), whole numbers as BIGINT, dates as text.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow import views
from zoneflow.config import HOUR_WEATHER_MEANS, ZONE_HOUR_MEANS, MonthWindow, StoreConfig
from zoneflow.operators import forecast as fc
from zoneflow.operators import hourly, prep, quality, ranking, report, store
from zoneflow.operators.enrich import enrich_trips
from zoneflow.operators.trips import trip_features, trip_quality_filter
from zoneflow.plans import forecasting, ingest, training
from zoneflow.plans.month import STORE, advance_month, feature_store
from zoneflow.schemas import DAILY_MEASURES, DAILY_TEXTS, HOURLY_MEASURES
from zoneflow.session import materialize, work_dir
from zoneflow.sources import files, months, payloads, reconcile, sinks
from zoneflow.sources.releases import Releases

Query = Callable[[SparkSession, str], DataFrame]

TARGET = MonthWindow("2024-01")
EARLIER = MonthWindow("2023-12")
# History of the forecast and training queries: at the small scales few cells have five trips.
HISTORY = StoreConfig(min_trips=1)
HOURS = 24
TOP = 3


def present(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField) -> str:
        name = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # Engines add in different orders. Values with seven decimals are common here, and their last
            # bit would decide how they round; the small term moves them off that edge. No negative zero.
            return f"round(double({name}) + 1.7e-9D, 6) + 0D AS {name}"
        if isinstance(f.dataType, T.IntegralType):
            return f"bigint({name}) AS {name}"
        return f"string({name}) AS {name}" if isinstance(f.dataType, T.DateType) else name

    return df.selectExpr(*[shown(f) for f in df.schema])


# --- stages shared by several queries -----------------------------------------------------------


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_trips(views.trips(spark, sf), views.zones(spark, sf), views.weather(spark, sf), TARGET)


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return trip_quality_filter(trip_features(_enriched(spark, sf)))


def _flow(spark: SparkSession, sf: str) -> DataFrame:
    return hourly.flow_cells(_kept(spark, sf))


def _store(spark: SparkSession, sf: str, config: StoreConfig = StoreConfig()) -> DataFrame:
    return feature_store(views.trips(spark, sf), views.zones(spark, sf), views.weather(spark, sf), TARGET, config)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return prep.known_categories(_store(spark, sf, HISTORY))


def _coded(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded history, written once: the encoders, the start and the lags all read it."""
    history = materialize(_history(spark, sf))
    return prep.encode_categoricals(history, prep.fit_encoders(history))


def _lagged(history: DataFrame) -> DataFrame:
    first = fc.start_column(history)
    grid = fc.future_grid(history, first, HOURS)
    recent = fc.recent_history(history, first, HOURS)
    return fc.lag_derived(fc.time_lag_join(grid, fc.history_rolling(recent), first, HOURS))


def _stand_in(frame: DataFrame) -> DataFrame:
    """Predictions computed from lags, so that scoring can be checked without models."""
    c = F.col
    return frame.withColumns({
        "pred_demand": F.coalesce(c("lag_24h_trip_count").cast("double"), c("rolling_168h_trip_mean"), F.lit(0.0)),
        "pred_rph": F.coalesce(c("lag_24h_rph"), c("lag_168h_rph"), F.lit(0.0)),
        "pred_competition": F.coalesce("rolling_24h_trip_mean", F.lit(0.0)) + c("hour") / 10.0,
        "pred_tip_prob": 1.0 / (1.0 + F.exp(-F.coalesce("lag_168h_rph", F.lit(0.0)) / 100.0)),
    })


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.opportunity_score(materialize(_stand_in(_lagged(materialize(_history(spark, sf))))))


def _ranked(spark: SparkSession, sf: str, rank_by: str = "opportunity") -> DataFrame:
    return ranking.rank_zones(_scored(spark, sf), rank_by)


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return prep.time_split(materialize(_history(spark, sf)))


# --- sources and month bookkeeping --------------------------------------------------------------


def scan_trips(spark, sf):
    """Two monthly files, written as an ingest would, scanned by pattern."""
    base = work_dir(spark)
    source = views.trips(spark, sf, two_months=True)
    for month in TARGET.months:
        rows = source.filter(sinks.in_month("tpep_pickup_datetime", MonthWindow(month)))
        rows.write.parquet(files.trip_path(base, month))
    return files.scan_trips(spark, base)


def _drifted_trips(spark, sf):
    """Two months as two deliveries years apart: other types, spellings, a column more and a column less."""
    base = work_dir(spark)
    source = views.trips(spark, sf, two_months=True)
    early, late = (source.filter(sinks.in_month("tpep_pickup_datetime", MonthWindow(m))) for m in TARGET.months)
    early = early.withColumns({
        "passenger_count": F.col("passenger_count").cast("bigint"), "payment_type": F.col("payment_type").cast("double"),
        "PULocationID": F.col("PULocationID").cast("int"), "RatecodeID": F.col("RatecodeID").cast("string"),
        "tpep_pickup_datetime": F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "cbd_fee": F.lit(0.75)})
    early.withColumnsRenamed({"Airport_fee": "airport_fee", "VendorID": "vendorid"}).drop("store_and_fwd_flag").write.parquet(
        files.trip_path(base, TARGET.months[0]))
    late.withColumn("extra", F.col("extra").cast("float")).write.parquet(files.trip_path(base, TARGET.months[1]))
    return base


def scan_trips_drifted(spark, sf):
    return reconcile.scan_trips_reconciled(spark, _drifted_trips(spark, sf))


def trip_schema_drift(spark, sf):
    return reconcile.schema_drift(spark, _drifted_trips(spark, sf))


def scan_weather(spark, sf):
    base = work_dir(spark)
    source = views.weather(spark, sf, two_months=True)
    for month in TARGET.months:
        source.filter(F.col("trip_month") == month).write.parquet(files.weather_path(base, month))
    return files.scan_weather(spark, base)


def zone_lookup(spark, sf):
    """The lookup as CSV with ``N/A`` for an unknown name, and how many pickups each row serves."""
    path = work_dir(spark)
    region = views.table(spark, sf, "region").selectExpr(
        "r_regionkey AS LocationID",
        "CASE WHEN r_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS Borough",
        "CASE WHEN r_regionkey = 4 THEN 'N/A' ELSE r_name END AS Zone")
    region.write.option("header", True).csv(path)
    trips = views.trips(spark, sf).groupBy("PULocationID").agg(F.count("*").alias("pickups"))
    zones = files.scan_zones(spark, path)
    return zones.join(trips, zones.LocationID == trips.PULocationID, "left").drop("PULocationID")


def weather_payload_rows(spark, sf):
    """Weather as one JSON payload per month (at most 744 hours), and back into rows."""
    return files.weather_rows(_payloads(spark, sf, "trip_month"), keep=("trip_month",))


def _daily_payloads(spark, sf):
    """A payload a day; days by turns whole, cut off, without times, with an array too short, with a time that is none."""
    turn = F.expr("day(CAST(day AS DATE)) % 5")
    payload = F.when(turn == 1, F.expr("left(payload, length(payload) - 9)")).when(
        turn == 2, F.regexp_replace("payload", '"time"', '"hours"')).when(
        turn == 3, F.regexp_replace("payload", r'("wind_speed_10m":\[)[^\]]*\]', "$1]")).when(
        turn == 4, F.regexp_replace("payload", r'T(\d\d):', "T$1h")).otherwise(F.col("payload"))
    return _payloads(spark, sf, "day").withColumn("payload", payload)


def weather_payloads_refused(spark, sf):
    return payloads.refused_payloads(_daily_payloads(spark, sf)).select("day", "reason")


def weather_payloads_accepted(spark, sf):
    """What an ingest of the same payloads writes, after a run of other payloads under the same id."""
    path, days = work_dir(spark), _daily_payloads(spark, sf)
    payloads.ingest_payloads(days.filter("day(CAST(day AS DATE)) > 15"), f"{path}/rows", f"{path}/refused", "run")
    refused = payloads.ingest_payloads(days, f"{path}/rows", f"{path}/refused", "run")
    written = spark.read.parquet(f"{path}/rows").groupBy("type").agg(F.count("*").alias("rows"), F.sum("temperature_2m").alias("temperatures"))
    return written.unionByName(refused.groupBy(F.lit("refused").alias("type")).agg(F.count("*").alias("rows")), allowMissingColumns=True)


def _payloads(spark, sf, unit):
    source = views.weather(spark, sf, two_months=True).withColumn("day", F.date_format("date", "yyyy-MM-dd"))

    def arrays(kind, names):
        entry = F.struct(F.expr("replace(left(string(date), 16), ' ', 'T') AS time"), *names)
        return F.array_sort(F.collect_list(F.when(F.col("type") == kind, entry))).alias(kind)

    def block(kind, names):
        return F.struct(*[F.col(f"{kind}.{n}").alias(n) for n in ("time", *names)]).alias(kind)

    daily = (*DAILY_MEASURES, *DAILY_TEXTS)
    units = source.groupBy(unit).agg(arrays("hourly", HOURLY_MEASURES), arrays("daily", daily))
    return units.select(unit, F.to_json(F.struct(block("hourly", HOURLY_MEASURES), block("daily", daily))).alias("payload"))


def _order_range(spark, sf):
    return views.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))


def _order_months(spark, sf):
    return views.table(spark, sf, "orders").select(months.month_of(F.col("o_orderdate")).alias("month")).distinct()


def month_list(spark, sf):
    return months.month_list(_order_range(spark, sf))


def month_bounds(spark, sf):
    return months.month_bounds(_order_months(spark, sf))


def missing_months(spark, sf):
    """Months from the first order to the last event that have neither orders nor events."""
    events = views.table(spark, sf, "events")
    spans = _order_range(spark, sf).unionAll(
        events.agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")))
    wanted = months.month_list(spans.agg(F.min("first").alias("first"), F.max("last").alias("last")))
    present_months = _order_months(spark, sf).unionAll(
        events.select(months.month_of(F.col("ts")).alias("month")).distinct())
    return months.missing_months(wanted, present_months)


def retention_plan(spark, sf):
    """Stale files of a listing with one trip and one weather file per month with orders."""
    listing = _order_months(spark, sf).select(F.explode(F.array(
        F.concat(F.lit("raw/yellow_tripdata_"), "month", F.lit(".parquet")),
        F.concat(F.lit("raw/weather_"), "month", F.lit(".parquet")))).alias("file_name"))
    return months.retention_plan(listing, "1996-06")


def latest_snapshot(spark, sf):
    """Cells of the newest day, each day being a snapshot."""
    cells = hourly.hourly_pickups(_kept(spark, sf))
    snapshots = cells.select("PUZone", "PUBorough", "ts_hour", "trip_count", "target_rph",
                             F.col("service_date").cast("timestamp_ntz").alias("run_ts"))
    return months.latest_snapshot(snapshots)


# --- trips and store -----------------------------------------------------------------------------


def month_window(spark, sf):
    """Trips in the window of December (its lookback is empty) out of two months of trips."""
    rows = views.trips(spark, sf, two_months=True).filter(sinks.in_window("tpep_pickup_datetime", EARLIER))
    return rows.agg(
        F.count("*").alias("n_total"), F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_pickup_datetime").alias("last_pickup"))


TRIP_KEY = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")


def trip_features_query(spark, sf):
    raw = set(views.TRIP_SCHEMA.names) - set(TRIP_KEY)
    return trip_features(_enriched(spark, sf)).drop(*raw, "sunrise", "sunset")


def trip_quality(spark, sf):
    return _kept(spark, sf).select(
        *TRIP_KEY, "trip_distance", "trip_duration_min", "revenue", "revenue_per_hour")


def upsert_month(spark, sf):
    """December rows of a two-month table replaced by a corrected December."""
    table = views.trips(spark, sf, two_months=True).select(*TRIP_KEY, "fare_amount")
    corrected = table.withColumns({"fare_amount": F.col("fare_amount") + 1.0, "corrected": F.lit(1)})
    return sinks.upsert_month(table, corrected, "tpep_pickup_datetime", EARLIER, F.col("fare_amount") > 5)


def upsert_month_stored(spark, sf):
    """The same replacement on a month-partitioned table on disk."""
    path = work_dir(spark)
    table = views.trips(spark, sf, two_months=True).select(*TRIP_KEY, "fare_amount")
    sinks.write_month(table, path, "tpep_pickup_datetime")
    corrected = table.withColumn("fare_amount", F.col("fare_amount") + 1.0).filter("fare_amount > 5")
    sinks.write_month(corrected, path, "tpep_pickup_datetime", EARLIER)
    return sinks.read_months(spark, path)


def _advanced(spark, sf):
    """December and January built after each other, each from its own trips; then a writer that gives up before its release."""
    releases = Releases(spark, work_dir(spark))
    trips, weather = views.trips(spark, sf, two_months=True), views.weather(spark, sf, two_months=True)
    for month in TARGET.months:
        advance_month(spark, trips, views.zones(spark, sf), weather, month, releases, HISTORY, check=("schema", "duplicates"))
    abandoned = releases.transaction("never published")
    abandoned.write_month(releases.read(STORE).withColumn("trip_count", -F.col("trip_count")), STORE, "ts_hour", TARGET)
    return releases


def ingest_new_months(spark, sf):
    """December is taken up, then January, which is delivered once more with higher fares; the last run finds nothing new."""
    base, source = work_dir(spark), views.trips(spark, sf, two_months=True)
    table, seen = f"{base}/table", f"{base}/checkpoint"
    for k, (month, more) in enumerate([*[(m, 0.0) for m in TARGET.months], (TARGET.month, 1.0)]):
        rows = source.filter(sinks.in_month("tpep_pickup_datetime", MonthWindow(month)))
        rows.withColumn("fare_amount", F.col("fare_amount") + more).write.parquet(files.trip_path(f"{base}/delivery{k}", month))
        ingest.ingest_new_files(spark, f"{base}/delivery*", table, seen)
    ingest.ingest_new_files(spark, f"{base}/delivery*", table, seen)
    return sinks.read_months(spark, table).select(*TRIP_KEY, "fare_amount", "trip_month")


def bucketed_store_windows(spark, sf):
    """History rolling over the store as a bucketed table."""
    name = f"hourly_zone_store_{uuid.uuid4().hex}"
    stored = sinks.write_bucketed(_history(spark, sf), name, work_dir(spark), buckets=8)
    return fc.history_rolling(stored).select(*CELL, "trip_count", "target_rph", *fc.HISTORY_ROLLING)


def store_by_carried_tails(spark, sf):
    return _advanced(spark, sf).read(STORE, MonthWindow(TARGET.month, 0)).drop("trip_month")


def release_history(spark, sf):
    return _advanced(spark, sf).history()


# --- quality -------------------------------------------------------------------------------------


def dq_schema(spark, sf):
    """Trips as delivered before the airport fee existed, and the weather."""
    trips = quality.trip_schema_rules(views.trips(spark, sf).drop("Airport_fee"))
    weather = quality.weather_schema_rules(views.weather(spark, sf))
    return trips.withColumn("dataset", F.lit("trips")).unionByName(weather.withColumn("dataset", F.lit("weather")))


def duplicate_check(spark, sf):
    """Trips reduced to zones and money, where rows do repeat."""
    trips = views.trips(spark, sf).select("PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra")
    return quality.duplicate_check(trips)


def full_duplicate_check(spark, sf):
    """All columns of the trips, each third trip delivered twice."""
    trips = views.trips(spark, sf)
    return quality.duplicate_check(trips.unionAll(trips.filter("PULocationID % 3 = 0")))


def enriched_month_stored(spark, sf):
    """The enriched trips as the month job keeps them, twice the same month."""
    path = work_dir(spark)
    for _ in range(2):
        sinks.write_month(_enriched(spark, sf), path, "tpep_pickup_datetime", TARGET)
    return sinks.read_months(spark, path, TARGET).drop("trip_month")


# --- training preparation -------------------------------------------------------------------------


CELL = ("PUZone", "PUBorough", "ts_hour")


def encode_categoricals(spark, sf):
    return _coded(spark, sf).select(*CELL, "PUZone_enc", "PUBorough_enc", "trip_count")


def known_category_filter(spark, sf):
    """Encoders that only know the zones of the East; rows kept and dropped, per zone."""
    east = views.zones(spark, sf).filter("Borough = 'East'")
    labels = {"PUZone": east.select(F.col("Zone").alias("PUZone")),
              "PUBorough": east.select(F.col("Borough").alias("PUBorough"))}
    status = F.when(F.col("_known"), "kept").otherwise("dropped").alias("status")
    return prep.flag_known(_store(spark, sf, HISTORY), labels).groupBy("PUZone", status).agg(
        F.count("*").alias("rows"), F.sum("trip_count").alias("trips"))


def known_category_rows(spark, sf):
    """The same encoders as a filter: what is left of each zone."""
    east = views.zones(spark, sf).filter("Borough = 'East'")
    labels = {"PUZone": east.select(F.col("Zone").alias("PUZone")),
              "PUBorough": east.select(F.col("Borough").alias("PUBorough"))}
    return prep.known_category_filter(_store(spark, sf, HISTORY), labels).groupBy("PUZone").agg(
        F.count("*").alias("rows"), F.sum("trip_count").alias("trips"))


def time_split(spark, sf):
    return _parts(spark, sf).select(*CELL, "trip_count", "split")


def tip_label(spark, sf):
    return prep.tip_label(_parts(spark, sf)).select(*CELL, "split", "tip_rate", "high_tip_zone")


def competition_target(spark, sf):
    return _history(spark, sf).select(*CELL, prep.competition_target().alias("competition"))


IMPUTED = ("lag_1h_rph", "lag_24h_rph", "lag_168h_rph", "rolling_24h_rph_std", "lag1h_precipitation", "rph_zscore")


def median_impute(spark, sf):
    parts = materialize(_parts(spark, sf))
    return prep.median_impute(parts, IMPUTED).select(*CELL, "split", *IMPUTED)


def _with_persistence_predictions(parts):
    """Each layer predicted by what was last known."""
    return prep.tip_label(parts).withColumns({
        "competition": prep.competition_target(),
        "pred_demand": F.coalesce("lag_24h_trip_count", "lag_1h_trip_count", F.lit(0)).cast("double"),
        "pred_rph": F.coalesce("lag_1h_rph", F.lit(0.0)),
        "pred_competition": F.coalesce("rolling_24h_rph_mean", F.lit(0.0)),
        "pred_tip": F.when(F.col("lag1h_tip_rate") > 0.75, 1).otherwise(0),
    })


def regression_metrics(spark, sf):
    return prep.regression_metrics(_with_persistence_predictions(_parts(spark, sf)))


def metric_drift(spark, sf):
    """Every day as a run: errors of predicting an hour by the hour before."""
    rows = _history(spark, sf).withColumn("run_ts", F.to_date("ts_hour").cast("timestamp_ntz"))
    error = F.col("trip_count") - F.coalesce("lag_1h_trip_count", F.lit(0))
    rph = F.col("target_rph") - F.coalesce("lag_1h_rph", F.lit(0.0))
    wide = rows.groupBy("run_ts").agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(rph * rph)).alias("rmse"))
    history = wide.select(
        F.date_format("run_ts", "yyyyMMdd").alias("run_id"), "run_ts",
        F.inline(F.array(
            F.struct(F.lit("demand_valid_mae").alias("metric"), F.col("mae").alias("value")),
            F.struct(F.lit("profit_valid_rmse").alias("metric"), F.col("rmse").alias("value")))))
    return prep.metric_drift(history)


def drift_after_training(spark, sf):
    """The metrics of two runs recorded in turn, the second a fifth larger."""
    path = work_dir(spark)
    metrics = materialize(regression_metrics(spark, sf))
    training.record_metrics(metrics, path, "first", dt.datetime(2024, 1, 1))
    larger = metrics.withColumn("value", F.col("value") * 1.2)
    return training.record_metrics(larger, path, "second", dt.datetime(2024, 1, 2))


# --- forecast --------------------------------------------------------------------------------------


def future_grid(spark, sf):
    history = _coded(spark, sf)
    return fc.future_grid(history, fc.start_column(history), HOURS)


def hist_rolling(spark, sf):
    return fc.history_rolling(_history(spark, sf)).select(*CELL, "trip_count", "target_rph", *fc.HISTORY_ROLLING)


def time_lag_join(spark, sf):
    history = materialize(_history(spark, sf))
    first = fc.start_column(history)
    zones = history.select("PUZone", "PUBorough").distinct()
    grid = fc.future_grid(zones, first, 48).select("PUZone", "PUBorough", "ts_hour")
    return fc.time_lag_join(grid, fc.history_rolling(fc.recent_history(history, first, 48)), first, 48)


DERIVED_AHEAD = ("trip_count_delta_1h", "rph_delta_1h", "rph_zscore", "rph_cv", "relative_zone_activity")


def forecast_derived(spark, sf):
    return _lagged(materialize(_history(spark, sf))).select(*CELL, *DERIVED_AHEAD)


def zone_hour_stats(spark, sf):
    history = materialize(_history(spark, sf))
    zones = history.select("PUZone", "PUBorough").distinct()
    grid = fc.future_grid(zones, fc.start_column(history), HOURS).select(*CELL, "hour")
    return fc.zone_hour_stats(grid, history)


FILLED = ("lag1h_temperature", "lag1h_tip_rate", "rolling_airport_activity", "lag_1h_trip_count", "lag_24h_trip_count",
          "lag_1h_rph", "lag_168h_rph", "rph_zscore", "rph_cv", "not_in_history")


def fill_missing(spark, sf):
    history = materialize(_history(spark, sf))
    return fc.fill_missing(_lagged(history), history, FILLED).select(*CELL, *FILLED)


def fill_missing_from_parts(spark, sf):
    """The same from value counts of three parts of the history, each counted by itself as a month's would be."""
    history = materialize(_history(spark, sf))
    parts = [fc.feature_counts(history.filter(F.dayofmonth("ts_hour") % 3 == k), FILLED) for k in range(3)]
    counts = materialize(functools.reduce(DataFrame.unionAll, parts))
    return fc.fill_missing(_lagged(history), history, FILLED, counts).select(*CELL, *FILLED)


def forecast_frame_online(spark, sf):
    """What an online answer knows of the coming hours: its lags and the climatology."""
    history = _coded(spark, sf)
    frame = forecasting.forecast_frame(history, fc.start_column(history), HOURS, mode="online")
    lags = [name for columns in fc.ONLINE_LAG_PLAN.values() for name in columns.values()]
    means = [c for c in (*ZONE_HOUR_MEANS, *HOUR_WEATHER_MEANS) if c in history.columns]
    return frame.select(*CELL, *lags, *means)


def forecast_window_check(spark, sf):
    history = materialize(_history(spark, sf))
    first = fc.start_column(history)
    return fc.forecast_window_check(fc.future_grid(history, first, HOURS), first, HOURS)


SCORE_COLUMNS = ("pred_demand", "pred_rph", "pred_competition", "pred_tip_prob",
                 "score_demand", "score_profit", "score_competition", "score_tip", "opportunity_score")


def rank_zones(spark, sf):
    """Ranks by all five signals."""
    ranked = _scored(spark, sf)
    for signal in ranking.RANK_SIGNALS:
        ranked = ranking.rank_zones(ranked, signal).withColumnRenamed("rank", f"rank_{signal}")
    return ranked.select(*CELL, *[f"rank_{s}" for s in ranking.RANK_SIGNALS])


def topn_per_hour(spark, sf):
    return ranking.topn_per_hour(_ranked(spark, sf), TOP).select(*CELL, "rank", "opportunity_score")


def first_hour_top(spark, sf):
    return ranking.first_hour_top(_ranked(spark, sf)).select(
        "rank", "PUZone", "PUBorough", "opportunity_score", "pred_demand", "pred_rph", "pred_tip_prob")


def forecast_output(spark, sf):
    return ranking.forecast_output(_ranked(spark, sf), TOP).orderBy("ts_hour", "rank")


def forecast_run_metadata(spark, sf):
    history = _history(spark, sf)
    return ranking.forecast_run_metadata(
        history, fc.start_column(history), HOURS, TOP, manual=False, table="hourly_zone_store")


def forecast_summary(spark, sf):
    ranked = _ranked(spark, sf, "profit")
    return ranking.forecast_summary(ranking.forecast_output(ranked, TOP, clean=True), HOURS, "profit")


def _view(spark, sf):
    shapes = views.zones(spark, sf).select(F.col("Zone").alias("PUZone"), F.col("LocationID").alias("shape_id"))
    return report.zone_hour_view(_ranked(spark, sf), dt.datetime(2024, 1, 31, 8), shapes)


def forecast_written_and_read(spark, sf):
    """An older forecast ranked by profit and a newer one, each of several parts; the newer one is read whole."""
    base = work_dir(spark)
    scored = materialize(_scored(spark, sf))
    for name, rank_by in (("older", "profit"), ("newer", "opportunity")):
        rows = ranking.forecast_output(ranking.rank_zones(scored, rank_by), TOP).repartition(6, "PUZone", "ts_hour")
        sinks.write_forecast(rows, spark.range(1), base, name)
    return months.read_latest_forecast(spark, base, rows.schema)


def clean_output(spark, sf):
    """The measures of a forecast with unknown and infinite values, as an online answer shows them."""
    odd = {"pred_rph": F.when(F.col("rank") == 1, F.lit(None)).otherwise(F.col("pred_rph")),
           "pred_demand": F.when(F.col("rank") == 2, F.lit(float("inf"))).otherwise(F.col("pred_demand"))}
    return ranking.forecast_output(_ranked(spark, sf).withColumns(odd), TOP, clean=True)


def train_forecast(spark, sf):
    """Default parameters of all four layers, on all rows."""
    history = materialize(_history(spark, sf))
    bundle, _ = training.train_models(history)
    return forecasting.generate_forecast(history, bundle, hours=HOURS, top=TOP)


def train_forecast_checks(spark, sf):
    """What must hold for a forecast of trained models, counted on the forecast itself."""
    history = materialize(_history(spark, sf))
    bundle, _ = training.train_models(history)
    rows = materialize(forecasting.generate_forecast(history, bundle, hours=HOURS))
    hour = Window.partitionBy("ts_hour")
    ranked = rows.withColumns({"_n": F.count("*").over(hour), "_next": F.lead("opportunity_score").over(hour.orderBy("rank"))})
    scores = [c for c in rows.columns if c.startswith("score_") or c in ("opportunity_score", "pred_tip_prob")]
    found = ranked.agg(
        F.count("*").alias("rows"), F.count_distinct("PUZone", "ts_hour").alias("zone hours"), F.count_distinct("ts_hour").alias("hours"),
        F.count_if((F.col("rank") < 1) | (F.col("rank") > F.col("_n"))).alias("ranks outside 1..n"),
        (F.count("*") - F.count_distinct("ts_hour", "rank")).alias("ranks twice in an hour"),
        F.count_if(F.greatest(*[F.abs(F.col(c) - 0.5) for c in scores]) > 0.5).alias("scores outside 0..1"),
        F.count_if(F.col("_next") > F.col("opportunity_score")).alias("better scores ranked lower"))
    pairs = [F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("found")) for c in found.columns]
    return found.select(F.inline(F.array(*pairs)))


SEARCHED = ("trees", "learning_rate", "depth", "leaves", "subsample", "feature_share", "c")
TUNED = ("layer string, place int, trees int, learning_rate double, depth int, leaves int, subsample double, "
         "feature_share double, c double, valid_error double")


def tune_demand(spark, sf):
    """The library's default search, from demand to tip: 20 points a layer. ``trees`` is a point's best number up to the end
    of the range; a tip point has no trees, the others have no c."""
    frame, _, features, _ = training.prepare(_history(spark, sf))
    rows = [(layer, i, *[getattr(p, name, None) for name in SEARCHED], error)
            for layer, tried in training.search_layers(frame, features).items() for i, (p, error) in enumerate(tried, 1)]
    return spark.createDataFrame(rows, TUNED)


def tune_checks(spark, sf):
    """What must hold for every layer of a search, counted on its points."""
    tried = materialize(tune_demand(spark, sf))
    ranges = training.TreeParams.RANGES
    inside = [F.col(c).between(*ranges[c]) for c in ranges if c != "trees"]
    wrong = ~(F.col("trees").between(1, ranges["trees"][1]) & functools.reduce(lambda a, b: a & b, inside))
    after = F.lead("valid_error").over(Window.partitionBy("layer").orderBy("place"))
    return tried.withColumn("_next", after).groupBy("layer").agg(
        F.count("*").alias("points"), F.max("place").alias("last_place"), F.count_if(wrong).alias("outside_ranges"),
        F.count_if(F.col("_next") < F.col("valid_error")).alias("out_of_order"), F.count_if(F.col("valid_error").isNull()).alias("without_error"))


QUERIES: dict[str, Query] = {
    "scan_trips": scan_trips,
    "scan_weather": scan_weather,
    "zone_lookup": zone_lookup,
    "weather_payload_rows": weather_payload_rows,
    "scan_trips_drifted": scan_trips_drifted,
    "trip_schema_drift": trip_schema_drift,
    "weather_payloads_refused": weather_payloads_refused,
    "weather_payloads_accepted": weather_payloads_accepted,
    "month_list": month_list,
    "month_bounds": month_bounds,
    "missing_months": missing_months,
    "retention_plan": retention_plan,
    "latest_snapshot": latest_snapshot,
    "month_window": month_window,
    "enrich_trips": _enriched,
    "trip_features": trip_features_query,
    "trip_quality_filter": trip_quality,
    "hourly_pickups": lambda s, sf: hourly.hourly_pickups(_kept(s, sf)),
    "hourly_dropoffs": lambda s, sf: hourly.hourly_dropoffs(_kept(s, sf)),
    "pickup_dropoff_flow": lambda s, sf: _flow(s, sf).select(
        *CELL, "trip_count", "dropoff_count", "net_pickup_flow", "pickup_dropoff_ratio"),
    "lag_features": lambda s, sf: hourly.lag_features(_flow(s, sf)).select(*CELL, *hourly.LAGS),
    "lag_features_by_clock": lambda s, sf: hourly.store_features(_flow(s, sf), StoreConfig(lag_mode="time")).select(
        *CELL, "trip_count", *hourly.LAGS, *hourly.ROLLING),
    "rolling_features": lambda s, sf: hourly.rolling_features(_flow(s, sf)).select(*CELL, *hourly.ROLLING),
    "derived_features": lambda s, sf: hourly.store_features(_flow(s, sf)).select(
        *CELL, "trip_count_delta_1h", "demand_vs_baseline", "rph_delta_1h", "rph_zscore", "avg_speed_mph",
        "congestion_score", "precipitation_delta", "rph_cv", "relative_zone_activity"),
    "shifted_features": lambda s, sf: hourly.store_features(_flow(s, sf)).select(
        *CELL, *[f"lag1h_{m}" for m in hourly.SAME_HOUR_MEASURES]),
    "feature_store_month": _store,
    "upsert_month": upsert_month,
    "upsert_month_stored": upsert_month_stored,
    "ingest_new_months": ingest_new_months,
    "bucketed_store_windows": bucketed_store_windows,
    "store_by_carried_tails": store_by_carried_tails,
    "release_history": release_history,
    "store_summary": lambda s, sf: store.store_summary(_store(s, sf)),
    "store_preview": lambda s, sf: store.store_preview(_store(s, sf)),
    "dq_schema": dq_schema,
    "dq_trip_rules": lambda s, sf: quality.trip_rules(views.trips(s, sf)),
    "dq_value_sets": lambda s, sf: quality.value_set_rules(views.trips(s, sf)),
    "duplicate_check": duplicate_check,
    "full_duplicate_check": full_duplicate_check,
    "enriched_month_stored": enriched_month_stored,
    "dq_weather_rules": lambda s, sf: quality.weather_rules(views.weather(s, sf)),
    "encode_categoricals": encode_categoricals,
    "known_category_filter": known_category_filter,
    "known_category_rows": known_category_rows,
    "time_split": time_split,
    "tip_label": tip_label,
    "competition_target": competition_target,
    "median_impute": median_impute,
    "regression_metrics": regression_metrics,
    "metric_drift": metric_drift,
    "drift_after_training": drift_after_training,
    "forecast_start": lambda s, sf: fc.forecast_start(_history(s, sf)),
    "future_grid": future_grid,
    "hist_rolling": hist_rolling,
    "time_lag_join": time_lag_join,
    "forecast_derived": forecast_derived,
    "zone_hour_stats": zone_hour_stats,
    "fill_missing": fill_missing,
    "fill_missing_from_parts": fill_missing_from_parts,
    "forecast_frame_online": forecast_frame_online,
    "forecast_window_check": forecast_window_check,
    "opportunity_score": lambda s, sf: _scored(s, sf).select(*CELL, *SCORE_COLUMNS),
    "rank_zones": rank_zones,
    "topn_per_hour": topn_per_hour,
    "first_hour_top": first_hour_top,
    "forecast_output": forecast_output,
    "forecast_written_and_read": forecast_written_and_read,
    "clean_output": clean_output,
    "forecast_run_metadata": forecast_run_metadata,
    "forecast_summary": forecast_summary,
    "zone_hour_view": _view,
    "zone_kpis": lambda s, sf: report.zone_kpis(_view(s, sf)),
    "zone_ranking_table": lambda s, sf: report.zone_ranking_table(_view(s, sf)),
    "train_forecast": train_forecast,
    "train_forecast_checks": train_forecast_checks,
    "tune_demand": tune_demand,
    "tune_checks": tune_checks,
}


def queries() -> dict[str, Query]:
    def presented(query: Query) -> Query:
        return lambda spark, sf_dir: present(query(spark, sf_dir))

    return {name: presented(query) for name, query in QUERIES.items()}
