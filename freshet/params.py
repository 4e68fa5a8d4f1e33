"""Scoring parameters of every product (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Capped:
    """weight, points per weighted unit, highest points"""

    wt: float
    mn: float
    mx: float


@dataclass(frozen=True)
class Step:
    """threshold, increment per point, lowest points, highest points"""

    lo: float
    inc: float
    mn: float
    mx: float


# Fixed values.
GFMS = {
    "area": Capped(1000.0, 1.0, 10.0),
    "perc": Capped(5.0, 1.0, 10.0),
    "meandepth": Capped(10.0, 1.0, 10.0),
    "maxdepth": Capped(10.0, 1.0, 10.0),
    "duration": Capped(24.0, 1.0, 10.0),
}
GLOFAS_EPS_WEIGHT = 10.0
GLOFAS_ALERT_FACTOR = 3.33
HWRF = {
    "area": Capped(1000.0, 1.0, 10.0),
    "perc": Capped(5.0, 1.0, 10.0),
    "meanrain": Step(2.0, 0.5, 1.0, 10.0),
    "maxrain": Step(4.0, 1.0, 1.0, 10.0),
}
HWRF_FACTOR = 2.5
DFO = {"area": Capped(100.0, 1.0, 10.0), "perc": Capped(1.0, 1.0, 10.0)}
DFO_DAYS = {"1day": 1.0, "2day": 1.5, "3day": 2.5}
VIIRS = {"area": Capped(100.0, 1.0, 10.0), "perc": Capped(1.0, 1.0, 10.0)}
VIIRS_DAYS = {"1day": 1.5, "5day": 3.5}

DFO_FLOOD_CLASS = 3
DFO_CELL_KM2 = 0.25 * 0.25
VIIRS_CLASS_ABOVE, VIIRS_CLASS_BELOW = 140, 201
VIIRS_CELL_KM2 = 0.375 * 0.375
DFO_TILES = 287

# (kind, product, oldest allowed age in days as a negative number, counts for the overall status)
FRESHNESS_LIMITS = [
    ("data", "GLOFAS", -1, True),
    ("data", "GFMS", -1, True),
    ("data", "HWRF", -1, False),
    ("data", "DFO", -2, True),
    ("data", "VIIRS", -2, True),
    ("alert", "GFMS", -1, True),
    ("alert", "HWRF", -1, True),
    ("alert", "FINAL", -1, True),
    ("alert", "DFO", -2, True),
    ("alert", "VIIRS", -2, True),
]


def table_weights(product: str, row: dict[str, float]) -> dict:
    """Weights of ``gfms``, ``hwrf``, ``dfo`` or ``viirs`` from the row of a weight table, names in lower case.

    The result takes the place of the constants above; day multipliers come under ``days``.
    """
    def capped(name: str, low: str = "minpt", high: str = "maxpt") -> Capped:
        return Capped(row[f"{name}_wt"], row[f"{name}_{low}"], row[f"{name}_{high}"])

    def step(name: str) -> Step:
        return Step(row[f"{name}_minwt"], row[f"{name}_increment"], row[f"{name}_minpt"], row[f"{name}_maxpt"])

    shared = {"area": capped(f"{product}_area", "min_pt", "max_pt"), "perc": capped(f"{product}_percarea")}
    if product == "gfms":
        return shared | {n: capped(f"gfms_{n}") for n in ("meandepth", "maxdepth", "duration")}
    if product == "hwrf":
        return shared | {n: step(f"hwrf_{n}") for n in ("meanrain", "maxrain")}
    words = {"1day": "one", "2day": "two", "3day": "three", "5day": "five"}
    days = DFO_DAYS if product == "dfo" else VIIRS_DAYS
    return shared | {"days": {d: row[f"{words[d]}_day_multiplier"] for d in days}}
