"""Time conversions.

Millisecond values are true instants unless a name says ``wall``: a *wall* value
is the local clock reading stored as if it were UTC, as change capture delivers
DATETIME columns.  Formatting relies on ``spark.sql.session.timeZone=UTC`` plus
the explicit offset, so results never depend on the zone of a machine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

# The business zone and the text formats at the boundary.
BUSINESS_OFFSET_HOURS = 8
DATE_FORMAT = "yyyy-MM-dd"
PARTITION_DATE_FORMAT = "yyyyMMdd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_to_instant_ms(wall_ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Local clock reading (ms, possibly text) -> instant."""
    return _col(wall_ms).try_cast("bigint") - F.lit(offset_hours * HOUR_MS)


def instant_to_wall_ms(ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return _col(ms) + F.lit(offset_hours * HOUR_MS)


def iso_to_instant_ms(text: Column | str) -> Column:
    """``2023-11-06T02:07:00Z`` (with or without T and Z) -> instant; null if malformed."""
    digits = F.regexp_replace(_col(text), "[TZ]", " ")
    return F.unix_millis(F.try_to_timestamp(F.concat(F.trim(digits), F.lit("Z"))))


def text_to_instant_ms(text: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Local ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` text -> instant."""
    full = F.when(F.length(_col(text)) == 10, F.concat(_col(text), F.lit(" 00:00:00"))).otherwise(_col(text))
    parsed = F.try_to_timestamp(full, F.lit(DATETIME_FORMAT))
    return F.unix_millis(parsed) - F.lit(offset_hours * HOUR_MS)


def format_instant(ms: Column | str, pattern: str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return F.date_format(F.timestamp_millis(instant_to_wall_ms(ms, offset_hours)), pattern)


def to_date_text(ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return format_instant(ms, DATE_FORMAT, offset_hours)


def to_partition_date_text(ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return format_instant(ms, PARTITION_DATE_FORMAT, offset_hours)


def to_datetime_text(ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    return format_instant(ms, DATETIME_FORMAT, offset_hours)


def iso_to_datetime_text(text: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """UTC ISO text -> local ``yyyy-MM-dd HH:mm:ss``."""
    return to_datetime_text(iso_to_instant_ms(text), offset_hours)


def epoch_days_to_date_text(days: Column | str) -> Column:
    """Days since 1970-01-01 -> ``yyyy-MM-dd``."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), _col(days).try_cast("int")), DATE_FORMAT)


def duration_ms(start_ms: Column | str, end_ms: Column | str) -> Column:
    return _col(end_ms).try_cast("bigint") - _col(start_ms).try_cast("bigint")


def day_number(ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Business day as whole days since 1970-01-01; cheap to group by."""
    return F.floor(instant_to_wall_ms(ms, offset_hours) / F.lit(DAY_MS)).cast("int")


def day_date(day: Column | str) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), _col(day))


def day_end_ms(day: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Instant at which a business day is over."""
    return (_col(day).cast("bigint") + 1) * F.lit(DAY_MS) - F.lit(offset_hours * HOUR_MS)


def cur_date(ms: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Business date of an instant."""
    return day_date(day_number(ms, offset_hours))


def day_window(ts: Column | str, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Tumbling one-day window on a timestamp, aligned to business midnight."""
    return F.window(_col(ts), "1 day", startTime=f"{(24 - offset_hours) % 24} hours")


def window_date(window: Column, offset_hours: int = BUSINESS_OFFSET_HOURS) -> Column:
    """Business date of a :func:`day_window`."""
    return F.to_date(window["start"] + F.make_dt_interval(hours=F.lit(offset_hours)))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())
