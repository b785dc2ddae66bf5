"""The engine's inputs - trips, zones, weather - as projections of the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.calendar import hour_floor
from zoneflow.schemas import TRIP_SCHEMA
from zoneflow.sources.months import month_of


# Declared columns: no job reads a footer first.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, two_months: bool = False) -> DataFrame:
    """One trip per event. ``two_months`` moves the even events back by a month."""
    e = table(spark, sf_dir, "events")
    pickup = "CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 1 MONTH ELSE ts END" if two_months else "ts"
    tip, tolls, extra = (
        "CASE WHEN event_id % 4 = 0 THEN 0.0D ELSE value * 0.2D END",
        "CASE WHEN event_id % 10 = 0 THEN 6.5D ELSE 0.0D END",
        "(event_id % 3) * 0.5D",
    )
    columns = {
        "VendorID": "1 + event_id % 2",
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": f"{pickup} + make_dt_interval(0, 0, CAST((event_id * 37) % 200 AS INT), 0)",
        "passenger_count": "CAST(event_id % 7 AS DOUBLE)",
        "trip_distance": "0.5D + (event_id % 200) / 10.0D",
        "RatecodeID": "1 + event_id % 6",
        "store_and_fwd_flag": "CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END",
        "PULocationID": "user_id % 5",
        "DOLocationID": "(event_id * 7) % 5",
        "payment_type": "1 + event_id % 5",
        "fare_amount": "value",
        "extra": extra,
        "mta_tax": "0.5D",
        "tip_amount": tip,
        "tolls_amount": tolls,
        "total_amount": f"value + ({extra}) + 0.5D + ({tip}) + ({tolls})",
        "Airport_fee": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE 0.0D END",
    }
    return e.selectExpr(*[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in TRIP_SCHEMA])


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup from the regions; key 4 is unknown, two zones are airports."""
    r = table(spark, sf_dir, "region").filter("r_regionkey <> 4")
    name = "CASE r_regionkey WHEN 1 THEN 'JFK Airport' WHEN 3 THEN 'Newark Airport' ELSE r_name END"
    borough = "CASE WHEN r_regionkey % 2 = 0 THEN 'East' ELSE 'West' END"
    return r.select(F.col("r_regionkey").alias("LocationID"), F.expr(borough).alias("Borough"), F.expr(name).alias("Zone"))


def weather(spark: SparkSession, sf_dir: str, two_months: bool = False) -> DataFrame:
    """Hourly weather for every hour with trips and daily weather for every such day; the measures follow
    from the hour's number."""
    hours = trips(spark, sf_dir, two_months).select(hour_floor("tpep_pickup_datetime").alias("date")).distinct()
    n = F.expr("datediff(to_date(date), DATE '2020-01-01') * 24 + hour(date)")
    hourly = hours.withColumn("n", n).selectExpr(
        "date", "'hourly' AS type", "date_format(to_date(date), 'yyyy-MM') AS trip_month",
        "CAST(n % 40 - 5 AS DOUBLE) AS temperature_2m",
        "CASE WHEN n % 7 = 0 THEN (n % 5) / 10.0D ELSE 0.0D END AS precipitation",
        "CAST(n % 45 - 8 AS DOUBLE) AS apparent_temperature",
        "CAST(n % 50 AS DOUBLE) AS wind_speed_100m",
        "CAST(n % 30 AS DOUBLE) AS wind_speed_10m",
        "CAST(n % 110 AS DOUBLE) AS relative_humidity_2m",
    )
    day = F.to_date("date")
    daily = hourly.groupBy(day.alias("d")).agg(
        F.max("temperature_2m").alias("temperature_2m_max"),
        F.min("temperature_2m").alias("temperature_2m_min"),
        F.avg("apparent_temperature").alias("apparent_temperature_mean"),
        F.count_if(F.col("precipitation") > 0).cast("double").alias("precipitation_hours"),
    ).select(
        F.col("d").cast("timestamp_ntz").alias("date"), F.lit("daily").alias("type"),
        month_of(F.col("d")).alias("trip_month"),
        "temperature_2m_max", "temperature_2m_min", "apparent_temperature_mean", "precipitation_hours",
        F.concat(F.col("d").cast("string"), F.lit("T16:45")).alias("sunset"),
        F.concat(F.col("d").cast("string"), F.lit("T07:15")).alias("sunrise"),
    )
    return hourly.unionByName(daily, allowMissingColumns=True)
