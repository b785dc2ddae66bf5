"""Calendar columns of an hour, for training rows and for future rows alike.

Wide sets of expressions are SQL text: one call parses them, where Column objects need a call each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR_COLUMNS = (
    "hour", "day_of_week", "week_of_year", "month", "quarter", "year", "day_of_year",
    "is_weekend", "is_rush", "is_night", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
)


def with_sql(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add columns given as SQL text. A column that exists already is replaced in place."""
    kept = [f"({columns[c]}) AS {c}" if c in columns else f"`{c}`" for c in df.columns]
    have = set(df.columns)
    return df.selectExpr(*kept, *[f"({sql}) AS {name}" for name, sql in columns.items() if name not in have])


def ntz(value: dt.date | dt.datetime | str) -> Column:
    """A literal without time zone. Comparing with a zoned literal would cast the column instead
    and so keep the filter out of the scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def hour_floor_sql(ts: str) -> str:
    """Start of the hour, in wall-clock terms. ``date_trunc`` goes through the session zone and
    would move hours where that zone has daylight saving; this form never does."""
    return f"CAST(to_date({ts}) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour({ts}))"


def microseconds_sql(start: str, end: str) -> str:
    """Wall-clock microseconds between two zone-less time stamps. ``timestampdiff`` would count them in
    the session zone, an hour off across a daylight saving change."""
    part = {unit: f"extract({unit} FROM ({end} - {start}))" for unit in ("DAY", "HOUR", "MINUTE", "SECOND")}
    minutes = f"(({part['DAY']} * 24L + {part['HOUR']}) * 60L + {part['MINUTE']})"
    return f"({minutes} * 60000000L + bigint({part['SECOND']} * 1000000))"


def hour_floor(ts: str) -> Column:
    return F.expr(hour_floor_sql(ts))


def plus_hours(ts: Column, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def flag_sql(condition: str) -> str:
    """0/1 integer; an unknown condition counts as 0."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def rush_flags(ts: str) -> dict[str, str]:
    return {
        "is_am_rush": flag_sql(f"hour({ts}) BETWEEN 7 AND 9"),
        "is_pm_rush": flag_sql(f"hour({ts}) BETWEEN 17 AND 19"),
    }


def calendar_of(ts: str, monday_first: bool = False) -> dict[str, str]:
    """Calendar parts, flags and cyclic encodings of ``ts``, as SQL.

    ``monday_first`` numbers Monday 0 (the future grid in compatible mode) instead of Sunday 0.
    """
    hour = f"hour({ts})"
    day = f"weekday({ts})" if monday_first else f"dayofweek({ts}) - 1"
    hour_angle, day_angle = f"2 * pi() * {hour} / 24", f"2 * pi() * ({day}) / 7"
    return {
        "hour": hour,
        "day_of_week": day,
        "week_of_year": f"weekofyear({ts})",
        "month": f"month({ts})",
        "quarter": f"quarter({ts})",
        "year": f"year({ts})",
        "day_of_year": f"dayofyear({ts})",
        "is_weekend": flag_sql(f"weekday({ts}) >= 5"),
        "is_rush": flag_sql(f"{hour} BETWEEN 7 AND 9 OR {hour} BETWEEN 17 AND 19"),
        "is_night": flag_sql(f"{hour} NOT BETWEEN 6 AND 21"),
        "hour_sin": f"sin({hour_angle})",
        "hour_cos": f"cos({hour_angle})",
        "dow_sin": f"sin({day_angle})",
        "dow_cos": f"cos({day_angle})",
    }


def with_calendar(df: DataFrame, ts: str = "ts_hour", monday_first: bool = False) -> DataFrame:
    return with_sql(df, calendar_of(ts, monday_first))
