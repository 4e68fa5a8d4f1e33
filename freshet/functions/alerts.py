"""Alert classes, their codes and the day-over-day status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, lowest first; the code of a label is its place in this list.
LEVELS = ["Information", "Advisory", "Watch", "Warning"]

# Open severity and hazard intervals per label, strongest first. A value on a bound is in no interval.
_BOUNDS = [
    ("Warning", 0.8, None, 80, None),
    ("Watch", 0.6, 0.8, 60, 80),
    ("Advisory", 0.35, 0.6, 35, 60),
    ("Information", 0, 0.35, 0, 35),
]


def _inside(c: Column, low: float, high: float | None) -> Column:
    above = c > F.lit(low)
    return above if high is None else above & (c < F.lit(high))


def alert_class(severity: Column, hazard: Column, digits: int | None = None) -> Column:
    """First label whose severity or hazard interval holds; NULL when none does.

    ``digits`` rounds both inputs first, which makes the class independent of the order of a floating point sum.
    """
    if digits is not None:
        severity, hazard = F.round(severity, digits), F.round(hazard, digits)
    label = F.lit(None).cast("string")
    for name, s_low, s_high, h_low, h_high in reversed(_BOUNDS):
        label = F.when(_inside(severity, s_low, s_high) | _inside(hazard, h_low, h_high), F.lit(name)).otherwise(label)
    return label


def alert_code(label: Column) -> Column:
    code = F.lit(None).cast("int")
    for i, name in enumerate(LEVELS, start=1):
        code = F.when(label == name, F.lit(i)).otherwise(code)
    return code


def alert_label(code: Column) -> Column:
    label = F.lit(None).cast("string")
    for i, name in enumerate(LEVELS, start=1):
        label = F.when(code == i, F.lit(name)).otherwise(label)
    return label


def alert_status(current: Column, previous: Column) -> Column:
    """Status of two alert codes one day apart."""
    return (
        F.when(previous.isNull(), F.lit("New"))
        .when(current == previous, F.lit("Continued"))
        .when(current > previous, F.lit("Upgraded"))
        .when(current < previous, F.lit("Downgraded"))
        .otherwise(F.lit("Other"))
    )
