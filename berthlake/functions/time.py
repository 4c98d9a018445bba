"""Time parsing, operational days, durations and seasonal encodings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str) -> Column:
    """Text -> wall-clock timestamp, null where it is none.

    Day separators are unified first, so that one cast covers every accepted spelling; a chain of
    format patterns would raise and catch one exception per miss and row.
    """
    text = F.trim(_col(c))
    text = F.regexp_replace(text, r"^(\d{4})[./](\d{1,2})[./](\d{1,2})", "$1-$2-$3")
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=\D|$)", "$1-$2-$3")
    return text.try_cast("timestamp_ntz")


def wall_clock(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def operational_date(c: Column | str) -> Column:
    """The working day starts at 06:00."""
    return F.to_date(_col(c) - F.expr("INTERVAL 6 HOURS"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def hours_between(start: Column | str, end: Column | str) -> Column:
    return F.round(seconds_between(start, end) / 3600, 2)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.round(seconds_between(start, end) / 86400, 2)


def hour_floor(c: Column | str) -> Column:
    return F.date_trunc("hour", _col(c)).cast("timestamp_ntz")


def clock_hour(day: Column | str, hour: Column | str) -> Column:
    """Start of a clock hour (0..23) of a day."""
    return _col(day).cast("timestamp_ntz") + F.make_dt_interval(hours=_col(hour))


def hours_covered(start: Column | str, end: Column | str) -> Column:
    """Every clock hour touched by [start, end], the last one included."""
    return F.sequence(hour_floor(start), hour_floor(end), F.expr("INTERVAL 1 HOUR"))


def biweek(c: Column | str) -> Column:
    """Two-week period 1..26 from the ISO week."""
    raw = F.floor((F.weekofyear(_col(c)) - 1) / 2).cast("int") + 1
    return F.least(F.lit(26), F.greatest(F.lit(1), raw))


def days_in_month(year: Column | str, month: Column | str) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(_col(year), _col(month), F.lit(1))))


def season_sin(period: Column | str, per_year: int) -> Column:
    return F.sin(_col(period) * (2.0 / per_year) * F.pi())


def season_cos(period: Column | str, per_year: int) -> Column:
    return F.cos(_col(period) * (2.0 / per_year) * F.pi())


def period_index(year: Column | str, period: Column | str, per_year: int) -> Column:
    """Running number of a period; one year back is index - per_year."""
    return (_col(year) * per_year + _col(period) - 1).cast("int")


def period_year(index: Column | str, per_year: int) -> Column:
    return F.floor(_col(index) / per_year).cast("int")


def period_of_year(index: Column | str, per_year: int) -> Column:
    return (F.pmod(_col(index), F.lit(per_year)) + 1).cast("int")


def month_of_period(period: Column | str, per_year: int) -> Column:
    """Approximate month of a period of the year."""
    if per_year == 12:
        return _col(period)
    return (F.floor((_col(period) - 1) * 12 / per_year) + 1).cast("int")
