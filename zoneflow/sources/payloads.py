"""Weather payloads sorted into those that can be used and those that are refused, with the reason.

A payload is refused whole: text that is no JSON object of the expected form, a payload without any time axis, a
block whose arrays are not as long as its time axis, and times that cannot be read. Rows of the others come from
:func:`zoneflow.sources.files.weather_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.schemas import DAILY_MEASURES, DAILY_TEXTS, HOURLY_MEASURES, WEATHER_PAYLOAD_SCHEMA
from zoneflow.sources.files import weather_rows
from zoneflow.sources.sinks import write_refused

CORRUPT = "_corrupt_record"
BLOCKS = {"hourly": HOURLY_MEASURES, "daily": (*DAILY_MEASURES, *DAILY_TEXTS)}


def refusal(payload: str) -> Column:
    """Why a payload is refused, NULL if it is not. The first reason that holds, in the order of the module's text."""
    schema = T.StructType([*WEATHER_PAYLOAD_SCHEMA, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(payload, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    reasons = F.when(F.col(payload).isNull(), "no payload").when(parsed.isNull() | parsed[CORRUPT].isNotNull(), "not readable as JSON")
    reasons = reasons.when(F.coalesce(*[parsed[kind]["time"] for kind in BLOCKS]).isNull(), "no time axis")
    for kind, names in BLOCKS.items():
        times = parsed[kind]["time"]
        for name in names:
            other = parsed[kind][name]
            # A block may lack a measure altogether, but not have it for some of its times.
            reasons = reasons.when(other.isNotNull() & times.isNull(), f"{kind}.{name} without times")
            reasons = reasons.when(other.isNotNull() & (F.size(other) != F.size(times)), f"{kind}.{name} is not as long as its times")
        reasons = reasons.when(F.exists(times, lambda t: t.try_cast("timestamp_ntz").isNull()), f"{kind}.time cannot be read")
    return reasons


def judged_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``payloads`` with a column ``reason``: why each is refused, or NULL."""
    return payloads.withColumn("reason", refusal(payload))


def refused_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    return judged_payloads(payloads, payload).filter(F.col("reason").isNotNull())


def accepted_rows(payloads: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Weather rows of the payloads that are not refused."""
    return weather_rows(judged_payloads(payloads, payload).filter(F.col("reason").isNull()), payload, keep)


def ingest_payloads(payloads: DataFrame, path: str, refused_path: str, run_id: str, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Weather rows written below ``path``, refused payloads added to the table at ``refused_path`` under the run's id; a run
    again replaces its own. Returns the run's refused payloads."""
    accepted_rows(payloads, payload, keep).write.mode("overwrite").parquet(path)
    write_refused(refused_payloads(payloads, payload), refused_path, run_id)
    return payloads.sparkSession.read.parquet(refused_path).filter(F.col("run_id") == run_id)
