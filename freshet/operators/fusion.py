"""Bringing the products of a watershed together: outer merges, exposure, hazard and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.alerts import alert_class
from freshet.functions.numeric import clean, with_severity

KEYS = ("run_ts", "pfaf_id")
EXPOSURE = ["area_km2", "iso", "admin0", "admin1", "rfr_score", "cfr_score", "resilience_index",
            "normalized_lack_of_resilience"]
MIN_TOTAL = 0.1


def merge_sources(sources: dict[str, DataFrame], keys: tuple[str, ...] = KEYS, by: tuple[str, ...] | None = None) -> DataFrame:
    """Full outer merge of any number of sources in one shuffle: the keys and one struct column per source, NULL where
    the source has no row.

    Of several rows of a source with the same keys, as a file delivered twice has, the largest by its columns in their
    order counts. A chain of full outer joins would shuffle every intermediate result again, because such
    a join gives up the partitioning of its keys. Here each source is packed into a struct, the sources are stacked and
    brought together by their keys once. Rows travel no wider than their own source, and the repartition in front
    keeps the aggregate from combining before the shuffle, where unique keys leave nothing to combine.

    ``by`` names the keys to shuffle by, all by default. A join on them that follows needs no further exchange or sort.
    """
    by = by or keys
    order = [*by, *(k for k in keys if k not in by)]
    packed = [
        df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias(name))
        for name, df in sources.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    return stacked.repartition(*by).groupBy(*order).agg(*[F.max(n).alias(n) for n in sources]).select(*keys, *sources)


def exposure(attributes: DataFrame, resilience: DataFrame) -> DataFrame:
    """Watershed attributes with the resilience of their country; countries without one vanish."""
    res = resilience.select("iso", "resilience_index", "normalized_lack_of_resilience")
    return clean(attributes.join(res, "iso", "inner").select("pfaf_id", *EXPOSURE))


def fuse_exposure(scores: DataFrame, exposed: DataFrame, how: str = "left") -> DataFrame:
    """Add the exposure columns.

    ``left`` keeps the score rows, with NULL exposure where there is none (called right outer when the exposure is the
    left side). ``full_outer`` also keeps watersheds without any score; with several runs these belong to no run and
    get a NULL ``run_ts``.
    """
    return scores.join(exposed, "pfaf_id", {"right": "left"}.get(how, how))


def combine_forecast(glofas: Column, gfms: Column, single_source_factor: float = 2.0) -> tuple[Column, Column, Column]:
    """(station score, depth score, sum): missing counts as zero, a source on its own counts double."""
    x, y = F.coalesce(glofas, F.lit(0.0)), F.coalesce(gfms, F.lit(0.0))
    factor = F.lit(single_source_factor)
    x2 = F.when(y == 0, x * factor).otherwise(x)
    y2 = F.when(x2 == 0, y * factor).otherwise(y)
    return x2, y2, x2 + y2


def fuse_forecast(glofas: DataFrame, gfms: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Station scores and depth scores side by side, full outer."""
    return merge_sources({"glofas": glofas, "gfms": gfms}, keys).select(*keys, "glofas.*", "gfms.*")


def has_hazard(h: Column) -> Column:
    return h.isNull() | (h != 0)


def drop_no_hazard(df: DataFrame, hazard: str = "hazard_score") -> DataFrame:
    """Drop hazard zero; an unknown hazard stays."""
    return df.where(has_hazard(F.col(hazard)))


def is_exposed() -> Column:
    return ~F.coalesce((F.col("rfr_score") == 0) & (F.col("cfr_score") == 0), F.lit(False))


def drop_unexposed(df: DataFrame, unique: bool = True) -> DataFrame:
    """Drop watersheds without riverine and coastal exposure.

    With ``unique=False`` one such row takes every row of its watershed along.
    """
    if unique:
        return df.where(is_exposed())
    offending = df.where(~is_exposed()).select("pfaf_id").distinct()
    return df.join(offending, "pfaf_id", "left_anti")


def raise_hazard(hazard: Column, score: Column, flag: Column, code: int, fill: bool) -> tuple[Column, Column]:
    """(hazard, flag) after a source had its say; ``fill`` counts an unknown hazard as zero first."""
    if fill:
        hazard = F.coalesce(hazard, F.lit(0.0))
    return F.greatest(hazard, score), F.when(hazard < score, F.lit(code)).otherwise(flag)


def classify(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Severity and alert of every row; the flag is kept for the two upper classes and for no class."""
    out = with_severity(df).withColumn("alert", alert_class(F.col("severity"), F.col("hazard_score"), digits))
    if "flag" in out.columns:
        low = F.coalesce(F.col("alert").isin("Information", "Advisory"), F.lit(False))
        out = out.withColumn("flag", F.when(~low, F.col("flag")))
    return out


def finish(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Common end of every fusion stage: drop what has no hazard or no exposure, then classify."""
    return classify(drop_unexposed(drop_no_hazard(df)), digits)


STAGE_ONLY = [*EXPOSURE, "scaled_riverine_risk", "scaled_coastal_risk", "severity", "alert"]


def fuse(base: DataFrame, scores: DataFrame, total: str, flag: int, fill: bool = True,
         keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Fuse one more scored source into an earlier stage: full outer merge, higher hazard, provenance flag.

    Exposure, severity and alert of the earlier stage are dropped, to be added fresh. ``fill`` is False for the storm
    source, whose own rows get no flag.
    """
    base = base.drop(*STAGE_ONLY)
    if "flag" not in base.columns:
        base = base.withColumn("flag", F.lit(None).cast("int"))
    wide = merge_sources({"base": base, "more": scores}, keys).select(*keys, "base.*", "more.*")
    hazard, mark = raise_hazard(F.col("hazard_score"), F.col(total), F.col("flag"), flag, fill)
    return wide.withColumns({"flag": mark, "hazard_score": hazard})


def merge_dfo_layers(layers: DataFrame, keys: tuple[str, ...] = ("run_date", "pfaf_id")) -> DataFrame:
    """Long (layer, area, perc) rows to one wide row; only watersheds present in all four layers remain."""
    names = ["d1", "d1cs", "d2", "d3"]
    values = [
        F.max(F.when(F.col("layer") == n, F.col(c))).alias(f"{n}_{c}") for n in names for c in ("area", "perc")
    ]
    present = [F.max(F.col("layer") == n).alias(f"_has_{n}") for n in names]
    wide = layers.groupBy(*keys).agg(*values, *present)
    for n in names:
        wide = wide.where(F.col(f"_has_{n}"))
    return wide.drop(*[f"_has_{n}" for n in names])


def merge_viirs(products: DataFrame, keys: tuple[str, ...] = ("run_date", "pfaf_id")) -> DataFrame:
    """Long (product, area, perc) rows to one wide row; zero areas are dropped before, gaps become zero."""
    values = []
    for product, prefix in (("1day", "oneday"), ("5day", "fiveday")):
        mine = F.col("product") == product
        values.append(F.max(F.when(mine, F.col("area"))).alias(f"{prefix}_flood_area_km"))
        values.append(F.max(F.when(mine, F.col("perc"))).alias(f"{prefix}_perc_area"))
    flooded = products.where((F.col("area") != 0) & F.col("product").isin("1day", "5day"))
    return flooded.groupBy(*keys).agg(*values).fillna(0.0)


def clean_alerts(alerts: DataFrame, exposed: DataFrame, with_flag: bool = False) -> DataFrame:
    """Slim alert table: exposure columns and the alert, one row per alert row."""
    slim = alerts.select(*KEYS, "alert", *(["flag"] if with_flag else []))
    return slim.join(exposed, "pfaf_id", "left").select(*KEYS, *EXPOSURE, "alert", *(["flag"] if with_flag else []))
