"""Zonal statistics from running sums along grid rows: a span costs two lookups, however wide it is.

A grid row, or a block of it, becomes one table row with the running sums and counts of its cells and the maxima of groups
of cells. A polygon's span meets its row by equality; sum and count are differences of two entries, the maximum is that of
the whole groups inside and of the cells at both ends. So cells that many polygons share are looked at once. Where few
polygons overlap and spans are short, joining cells with spans (``zonal_stats``) is cheaper, since cells are not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.geo import center_y, pixel_area
from freshet.operators.spatial import SPAN_ROWS, split_spans
from freshet.schemas import Grid
from freshet.session import small_side

#: Columns of a block, and cells whose maximum is kept.
BLOCK, GROUP = 4096, 64


def pixel_rows(pixels: DataFrame, keys: tuple[str, ...] = ("run_ts",)) -> DataFrame:
    """(keys, row, block, cols, values): the cells of a pixel table by block of a grid row, in one exchange."""
    block = F.floor(F.col("col") / F.lit(BLOCK)).cast("int").alias("block")
    cell = F.struct("col", F.col("value").cast("double").alias("value"))
    rows = pixels.where(F.col("col").isNotNull()).groupBy(*keys, "row", block).agg(F.collect_list(cell).alias("_cells"))
    return rows.select(*keys, "row", "block", F.col("_cells.col").alias("cols"), F.col("_cells.value").alias("values"))


def dense_rows(rows: DataFrame, keys: tuple[str, ...] = ("run_ts",)) -> DataFrame:
    """The same of whole grid rows (keys, row, values), whose cells need no column numbers."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("values") - 1, F.lit(0)), F.lit(BLOCK))
    parts = rows.select(*keys, "row", "values", F.explode(starts).alias("_from"))
    part = F.slice("values", F.col("_from") + 1, F.lit(BLOCK)).cast("array<double>")
    return parts.select(*keys, "row", (F.col("_from") / BLOCK).cast("int").alias("block"), F.lit(None).cast("array<int>").alias("cols"), part.alias("values"))


def row_sums(rows: DataFrame, nodata: float, keys: tuple[str, ...] = ("run_ts",)) -> DataFrame:
    """(keys, row, block, sums, counts, cells, tops) per block of a row.

    ``sums[c]`` and ``counts[c]`` belong to the columns before ``c``; ``cells`` are the largest values of columns, ``tops`` those of
    groups of columns. ``nodata``, NaN and NULL are no data; of a cell that is there twice, both values count.
    """
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [*keys, "row", "block", "sums", "counts", "cells", "tops"]
        k = len(keys)
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                blocks = part.column(k + 1).to_numpy()
                made = []
                for i in range(part.num_rows):
                    cols, values = part.column(k + 2)[i].values, part.column(k + 3)[i].values
                    values = pa.array([], pa.float64()) if values is None else values
                    v = values.cast(pa.float64()).fill_null(np.nan).to_numpy()
                    at = np.arange(len(v)) if cols is None else cols.to_numpy() - blocks[i] * BLOCK
                    data = (v != nodata) & ~np.isnan(v)
                    at, v = at[data], v[data]
                    width = int(at.max()) + 1 if len(at) else 0
                    sums, counts = np.zeros(width + 1), np.zeros(width + 1, np.int64)
                    cells = np.full(-(-width // GROUP) * GROUP, -np.inf)
                    np.add.at(sums, at + 1, v)
                    np.add.at(counts, at + 1, 1)
                    np.maximum.at(cells, at, v)
                    made.append((np.cumsum(sums), np.cumsum(counts), cells, cells.reshape(-1, GROUP).max(axis=1, initial=-np.inf)))
                lists = []
                for x in range(4):
                    bounds = np.concatenate([[0], np.cumsum([len(m[x]) for m in made])]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([m[x] for m in made]))))
                yield pa.RecordBatch.from_arrays([*part.columns[: k + 2], *lists], names=names)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
    arrays = "sums array<double>, counts array<long>, cells array<double>, tops array<double>"
    return rows.select(*keys, "row", "block", "cols", "values").mapInArrow(run, f"{kinds}, row int, block int, {arrays}")


def _largest(first: Column, last: Column) -> Column:
    """Largest value of the columns from ``first`` to ``last`` of a block: cells at the ends, groups between them."""
    a, b = F.floor(first / GROUP).cast("int"), F.floor(last / GROUP).cast("int")

    def top(of: str, start: Column, size: Column) -> Column:
        return F.coalesce(F.array_max(F.slice(of, start + 1, F.greatest(size, F.lit(0)))), F.lit(float("-inf")))

    apart = F.greatest(
        top("cells", first, (a + 1) * GROUP - first), top("tops", a + 1, b - a - 1), top("cells", b * GROUP, last - b * GROUP + 1))
    return F.when(a == b, top("cells", first, last - first + 1)).otherwise(apart)


def row_stats(
    sums: DataFrame, spans: DataFrame, grid: Grid, keys: tuple[str, ...] = ("run_ts",), deg2rad: float = math.pi / 180.0, factor: int = 1,
) -> DataFrame:
    """(keys, pfaf_id, area, mean, max) as ``zonal_stats``, from ``row_sums`` and the unsplit spans (pfaf_id, row, c0, c1) of ``grid``.

    ``grid`` may be ``factor`` times finer than the cells: a span then takes whole cells, less the fine columns that it lacks of
    the first and the last one.
    """
    if BLOCK % factor:
        raise ValueError(f"factor must divide {BLOCK}")
    f = F.lit(factor)
    sized = spans.withColumn("_km2", pixel_area(center_y(F.col("row"), grid), grid, deg2rad))
    s = small_side(split_spans(sized, BLOCK * factor, "block"), SPAN_ROWS).withColumn("row", F.floor(F.col("row") / f).cast("int"))
    # Places in the block; the sums end with the last cell that has data.
    start = F.col("block") * F.lit(BLOCK * factor)
    met = sums.join(s, ["row", "block"]).withColumns({"_c0": F.col("c0") - start, "_c1": F.col("c1") - start})
    end = F.size("counts") - 2
    met = met.withColumns({"_a": F.floor(F.col("_c0") / f).cast("int"), "_b": F.floor(F.col("_c1") / f).cast("int")}).where(F.col("_a") <= end)

    def of(name: str) -> Column:
        def at(place: Column) -> Column:
            return F.get(name, F.least(place, end + 1))

        first, last = at(F.col("_a") + 1) - at(F.col("_a")), at(F.col("_b") + 1) - at(F.col("_b"))
        lead, trail = F.col("_c0") - F.col("_a") * f, F.col("_b") * f + (factor - 1) - F.col("_c1")
        whole = (at(F.col("_b") + 1) - at(F.col("_a"))) * f
        return whole - first * lead - last * trail if factor > 1 else whole

    found = met.select(*keys, "pfaf_id", "_km2", of("sums").alias("_sum"), of("counts").alias("_n"),
                       _largest(F.col("_a"), F.least(F.col("_b"), end)).alias("_top")).where("_n > 0")
    return found.groupBy(*keys, "pfaf_id").agg(
        F.sum(F.col("_km2") * F.col("_n")).alias("area"), (F.sum("_sum") / F.sum("_n")).alias("mean"), F.max("_top").alias("max"))
