"""Date, hour and file-name expressions (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)


def days_from(day: Column, now: Column) -> Column:
    """Whole days from ``now`` to midnight of ``day``, rounded down: today's date gives -1 after midnight."""
    return F.floor((_seconds(F.to_date(day)) - _seconds(now)) / F.lit(86400)).cast("int")


def hour_diff(a: Column, b: Column) -> Column:
    """Whole hours from b to a, cut towards zero."""
    return ((_seconds(a) - _seconds(b)) / F.lit(3600)).cast("int")


def floor_hours(ts: Column, hours: int) -> Column:
    """Start of the ``hours`` long bin that holds ``ts``; bins are counted from midnight when hours divide a day."""
    width = hours * 3600
    return F.timestamp_seconds(F.floor(_seconds(ts) / F.lit(width)) * F.lit(width))


def processing_slot(now: Column, delay_hours: int = 6, hours: int = 6) -> Column:
    """Slot that is due at ``now``, given how long its data take to arrive."""
    return floor_hours(now - F.make_dt_interval(hours=F.lit(delay_hours)), hours)


def doy_date(year: Column, day_of_year: Column) -> Column:
    """Date from a year and a day number, 1 being January 1."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day_of_year - F.lit(1)).cast("int"))


def days_before(day: Column, n: int) -> Column:
    return F.date_sub(day, n)


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def date_from_text(text: Column) -> Column:
    """First run of eight digits as a date, NULL without one."""
    return F.try_to_date(F.nullif(F.regexp_extract(text, r"(\d{8})", 1), F.lit("")), "yyyyMMdd")


def run_ts_from_path(path: Column) -> Column:
    """Run time from the eight- or ten-digit stamp of a path's file name (yyyyMMdd or yyyyMMddHH), NULL without one.

    A stamp follows ``/``, ``_`` or ``.`` and ends with its digits. Part files, which the engine names itself, have the
    stamp of their folder.
    """
    stamp = F.regexp_extract(path, r"[/_.](\d{8}(?:\d{2})?)(?!\d)[^/]*(?:/part-[^/]*)?$", 1)
    return F.try_to_timestamp(F.rpad(stamp, 10, "0"), F.lit("yyyyMMddHH"))


def is_ready(run_ts: Column, now: Column, hours: float = 6) -> Column:
    """True once the run is older than ``hours``."""
    return (_seconds(now) - _seconds(run_ts)) / F.lit(3600.0) > F.lit(float(hours))
