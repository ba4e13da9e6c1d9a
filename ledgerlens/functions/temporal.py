"""Calendar columns of the ``timestamp`` column.

Times are wall-clock (``timestamp_ntz``), so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import flag

# Fixed values.
NIGHT_FIRST_HOUR = 0
NIGHT_LAST_HOUR = 5
WEEKEND_FIRST_DAY = 5
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def event_time(ts: Column) -> Column:
    """Parse to a wall-clock timestamp; an unreadable text becomes NULL."""
    return ts.try_cast("timestamp_ntz")


def temporal_features(ts: Column) -> dict[str, Column]:
    when = event_time(ts)
    hour, day = F.hour(when), F.weekday(when)
    return {
        "hour": hour,
        "day_of_week": day,
        "month": F.month(when),
        "is_night": flag(hour.between(NIGHT_FIRST_HOUR, NIGHT_LAST_HOUR)),
        "is_weekend": flag(day >= WEEKEND_FIRST_DAY),
    }


def calendar_parts(ts: Column) -> dict[str, Column]:
    when = event_time(ts)
    return {
        "day_name": F.date_format(when, "EEEE"),
        "iso_week": F.weekofyear(when),
        "year_month": F.date_format(when, "yyyy-MM"),
        "date": F.to_date(when),
    }


def whole_days(later: Column, earlier: Column) -> Column:
    """Completed days from ``earlier`` to ``later``, two wall-clock times in that order."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def wall_to_instant(wall: Column) -> Column:
    """The wall-clock time read as UTC, as the instant a watermark needs, whatever the session time zone."""
    return F.from_utc_timestamp(wall.cast("timestamp"), F.current_timezone())


def instant_to_wall(instant: Column) -> Column:
    """The inverse of :func:`wall_to_instant`."""
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")
