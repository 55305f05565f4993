"""Dates, ages and event times.

Epoch milliseconds are turned into wall-clock time through TIMESTAMP_NTZ and an explicit zone, so no
result depends on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V

SHANGHAI = "Asia/Shanghai"
DAY_MS = 86_400_000
HOUR_MS = 3_600_000
MINUTE_MS = 60_000


def utc_wall_clock(millis: Column) -> Column:
    """Epoch milliseconds as TIMESTAMP_NTZ in UTC."""
    seconds = (millis.cast("decimal(18,3)") / F.lit(1000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)


def wall_clock(millis: Column, zone: str = SHANGHAI) -> Column:
    """Epoch milliseconds as TIMESTAMP_NTZ in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall_clock(millis))


def wall_clock_millis(ntz: Column) -> Column:
    """A TIMESTAMP_NTZ read as UTC, as epoch milliseconds."""
    return (
        F.unix_date(ntz.cast("date")).cast("bigint") * DAY_MS
        + F.hour(ntz).cast("bigint") * HOUR_MS
        + F.minute(ntz).cast("bigint") * MINUTE_MS
        + F.floor(F.extract(F.lit("SECOND"), ntz) * 1000).cast("bigint")
    )


def epoch_day_to_date(days: Column) -> Column:
    return F.date_from_unix_date(days)


def month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def age_on(birthday: Column, as_of: Column) -> Column:
    """Full calendar years from ``birthday`` to ``as_of``."""
    not_yet = (month_day(as_of) < month_day(birthday)).cast("int")
    return F.year(as_of) - F.year(birthday) - not_yet


def today(zone: str = SHANGHAI) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit(zone), F.localtimestamp()).cast("date")


def decade(birthday: Column) -> Column:
    return (F.floor(F.year(birthday) / 10) * 10).cast("int")


def zodiac_sign(birthday: Column) -> Column:
    day = month_day(birthday)
    sign = None
    for last_day, name in V.ZODIAC:
        sign = F.when(day <= last_day, name) if sign is None else sign.when(day <= last_day, name)
    return F.when(birthday.isNotNull(), sign.otherwise(V.LAST_ZODIAC))


def pay_time_slot(millis: Column, zone: str = SHANGHAI) -> Column:
    """Named part of the day, looked up by hour."""
    names = []
    for end, name in V.PAY_TIME_SLOTS:
        names += [name] * (end - len(names))
    names += [V.LAST_PAY_TIME_SLOT] * (24 - len(names))
    return F.get(F.array(*[F.lit(n) for n in names]), F.hour(wall_clock(millis, zone)))


def datetime_to_millis(text: Column, offset_hours: int = 8) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` at a fixed offset to epoch milliseconds; other text gives null."""
    well_formed = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    ntz = F.when(well_formed, text).try_cast("timestamp_ntz")
    return wall_clock_millis(ntz) - offset_hours * HOUR_MS


def date_to_millis(text: Column, offset_hours: int = 8) -> Column:
    return datetime_to_millis(F.concat(text, F.lit(" 00:00:00")), offset_hours)


def millis_to_date(millis: Column, zone: str = SHANGHAI) -> Column:
    return wall_clock(millis, zone).cast("date").cast("string")


def millis_to_datetime(millis: Column, zone: str = SHANGHAI) -> Column:
    return F.substring(wall_clock(millis, zone).cast("string"), 1, 19)


def millis_to_partition(millis: Column, zone: str = SHANGHAI) -> Column:
    """``yyyyMMdd`` text, for a partition column."""
    return F.replace(millis_to_date(millis, zone), F.lit("-"), F.lit(""))


def format_date(moment: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(moment, pattern)


def day_partitions(first: Column, last: Column) -> Column:
    """Inclusive list of ``yyyyMMdd`` numbers; empty when ``first`` is after ``last``."""
    as_number = lambda d: F.year(d) * 10000 + month_day(d)
    days = F.transform(F.sequence(first, F.greatest(first, last)), as_number)
    return F.when(first <= last, days).when(first > last, F.array().cast("array<int>"))


def event_millis(*candidates: Column) -> Column:
    """First present event time, else 0."""
    return F.coalesce(*[c.try_cast("bigint") for c in candidates], F.lit(0).cast("bigint"))


def event_timestamp(*candidates: Column) -> Column:
    """TIMESTAMP event time for watermarks, from epoch milliseconds."""
    return F.timestamp_millis(event_millis(*candidates))


def block_event_timestamp(block_timestamp: Column, timestamp: Column) -> Column:
    """TIMESTAMP event time from seconds: the block's time, else the record's."""
    return F.timestamp_millis(F.coalesce(block_timestamp, timestamp) * 1000)


def first_window_timestamp(records: Column) -> Column:
    """TIMESTAMP event time of a list of records: the first record's ``window_start_time``."""
    return F.timestamp_millis(F.get(records, F.lit(0))["window_start_time"])
