"""Score, risk and severity expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet import params as P


def nan_to_null(c: Column) -> Column:
    """NaN and NULL mean the same here; NULL is the one that comparisons, ``greatest`` and ``avg`` skip."""
    return F.when(~F.isnan(c), c)


def clean(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating point column."""
    kinds = (T.DoubleType, T.FloatType)
    return df.selectExpr(
        *[
            f"CASE WHEN NOT isnan(`{f.name}`) THEN `{f.name}` END AS `{f.name}`"
            if isinstance(f.dataType, kinds)
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def capped_score(v: Column, p: P.Capped, mult: float = 1.0) -> Column:
    """Linear points up to the cap. There is no lower clamp."""
    return F.when(v / F.lit(p.wt) > F.lit(p.mx), F.lit(p.mx * mult)).otherwise(
        F.lit(p.mn * mult) * v / F.lit(p.wt)
    )


def step_score(v: Column, p: P.Step) -> Column:
    """Nothing below the threshold, then points per increment up to the cap."""
    points = (v - F.lit(p.lo)) / F.lit(p.inc) + F.lit(p.mn)
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(
        F.when(v >= F.lit(p.lo), F.least(points, F.lit(p.mx))).otherwise(F.lit(0.0))
    )


def alert_score(level: Column) -> Column:
    """Half-even rounding of the weighted alert level."""
    return F.bround(level.cast("double") * F.lit(P.GLOFAS_ALERT_FACTOR), 0)


def eps_score(probability: Column) -> Column:
    return probability.cast("double") / F.lit(P.GLOFAS_EPS_WEIGHT)


def peak_score(days: Column, *signals: Column) -> Column:
    """Ten points for tomorrow down to one for ten days and later; zero when no signal is set."""
    silent = F.lit(True)
    for s in signals:
        silent = silent & (s == 0)
    return (
        F.when(silent, F.lit(0.0))
        .when(days >= 10, F.lit(1.0))
        .when(days >= 1, (F.lit(11) - days).cast("double"))
        .otherwise(F.lit(0.0))
    )


def percent_area(area: Column, total: Column) -> Column:
    return area / total * F.lit(100.0)


# Hart (1968) rational approximation of the normal tail, highest power first.
_TAIL_NUM = [
    0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931,
    220.206867912376,
]
_TAIL_DEN = [
    0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
    793.826512519948, 440.413735824752,
]
_TAIL_SPLIT = 7.07106781186547
_SQRT_2PI = 2.506628274631


def _polynomial(a: str, coefficients: list[float]) -> str:
    out = f"{coefficients[0]}D"
    for c in coefficients[1:]:
        out = f"({out} * {a} + {c}D)"
    return out


def with_normal_cdf(df: DataFrame, x: str, out: str) -> DataFrame:
    """Add the standard normal distribution function of column ``x``.

    The parts are columns of their own, since each is used many times: the optimizer keeps such projections apart, and
    the generated code stays small.
    """
    df = df.withColumns({"_a": F.expr(f"abs({x})"), "_e": F.expr(f"exp(-({x} * {x}) / 2D)")})
    near = f"_e * {_polynomial('_a', _TAIL_NUM)} / {_polynomial('_a', _TAIL_DEN)}"
    far = f"_e / ((_a + 1D / (_a + 2D / (_a + 3D / (_a + 4D / (_a + 0.65D))))) * {_SQRT_2PI}D)"
    tail = f"CASE WHEN _a > 37 THEN 0D WHEN _a < {_TAIL_SPLIT}D THEN {near} ELSE {far} END"
    df = df.withColumn("_tail", F.expr(tail))
    return df.withColumn(out, F.expr(f"CASE WHEN {x} > 0 THEN 1D - _tail ELSE _tail END")).drop("_a", "_e", "_tail")


def with_severity(df: DataFrame, hazard: str = "hazard_score", out: str = "severity") -> DataFrame:
    """Add the scaled risks and the log-normal severity of the hazard against the unexposed share.

    Full exposure gives 1, exposure above 100 or unknown gives NULL, and so does a negative or unknown hazard.
    """
    h, risk = F.col(hazard), F.col("_risk")
    df = (
        df.withColumns(
            {"scaled_riverine_risk": F.expr("rfr_score * 20D"), "scaled_coastal_risk": F.expr("cfr_score * 20D")}
        )
        .withColumn("_risk", F.greatest("scaled_riverine_risk", "scaled_coastal_risk"))
        .withColumn("_x", F.expr(f"ln({hazard}) - ln(100D - _risk)"))
    )
    severity = (
        F.when(h.isNull() | risk.isNull() | (h < 0) | (risk > 100), F.lit(None).cast("double"))
        .when((h == 0) & (risk < 100), F.lit(0.0))
        .when(h == 0, F.lit(None).cast("double"))
        .when(risk == 100, F.lit(1.0))
        .otherwise(F.col("_cdf"))
    )
    return with_normal_cdf(df, "_x", "_cdf").withColumn(out, severity).drop("_x", "_risk", "_cdf")
