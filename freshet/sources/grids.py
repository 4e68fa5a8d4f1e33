"""Raw float grids as a data source: one file is read by many tasks, a band of rows each, without its other rows.

A file holds little-endian float32 values, row by row from the north. Its run time is the stamp of its name. Conditions on
``row`` are pushed into the source: bands outside are no tasks, and bands at the edges are read in part.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
)

from freshet.schemas import Grid

BAND = 64
# As in functions.dates.run_ts_from_path: eight or ten digits after a separator, of the file or of its folder.
_STAMP = re.compile(r"[/_.](\d{8}(?:\d{2})?)(?!\d)[^/]*(?:/part-[^/]*)?$")


def run_time(path: str) -> dt.datetime | None:
    """UTC time of a path's stamp, None without a valid one."""
    found = _STAMP.search(path)
    try:
        return dt.datetime.strptime(found[1].ljust(10, "0"), "%Y%m%d%H").replace(tzinfo=dt.UTC) if found else None
    except ValueError:
        return None


def grid_files(path: str, least: int) -> list[str]:
    """Files of a folder, or those that match a pattern in its last part, with at least ``least`` bytes; locations stay as given."""
    import pyarrow.fs as pafs

    folder, _, pattern = path.rpartition("/") if re.search(r"[*?\[]", path) else (path, "", "*")
    fs, inner = pafs.FileSystem.from_uri(folder)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    listed = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inner))
    base = folder if info.type == pafs.FileType.Directory else folder.rpartition("/")[0]
    return sorted(f"{base}/{f.base_name}" for f in listed
                  if f.type == pafs.FileType.File and f.size >= least and f.base_name[0] not in "._" and fnmatch.fnmatch(f.base_name, pattern))


@dataclass
class Band(InputPartition):
    path: str
    top: int
    bottom: int


class RawGridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.band = options["path"], int(options["band"])
        self.nrows, self.ncols = int(options["nrows"]), int(options["ncols"])
        self.least = max(int(options["minbytes"]), self.nrows * self.ncols * 4)
        self.top, self.bottom = 0, self.nrows - 1

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != ("row",):
                yield f
            elif isinstance(f, IsNotNull):
                continue
            elif isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.top = max(self.top, f.value + isinstance(f, GreaterThan))
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.bottom = min(self.bottom, f.value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        bands = [(at, min(at + self.band - 1, self.bottom)) for at in range(self.top, self.bottom + 1, self.band)]
        # A scan needs a partition: an empty band stands for no rows.
        return [Band(f, *b) for f in grid_files(self.path, self.least) for b in bands] or [Band("", 0, -1)]

    def read(self, band: Band) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.fs as pafs

        n = band.bottom - band.top + 1
        if n <= 0:
            return
        fs, inner = pafs.FileSystem.from_uri(band.path)
        with fs.open_input_file(inner) as f:
            data = f.read_at(n * self.ncols * 4, band.top * self.ncols * 4)
        values = pa.array(np.frombuffer(data, "<f4"))
        bounds = pa.array(np.arange(0, (n + 1) * self.ncols, self.ncols, dtype=np.int32))
        times = pa.array([run_time(band.path)] * n, pa.timestamp("us", "UTC"))
        rows = pa.array(np.arange(band.top, band.bottom + 1, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([times, rows, pa.ListArray.from_arrays(bounds, values)], names=["run_ts", "row", "values"])


class RawGridSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rawgrid"

    def schema(self) -> str:
        return "run_ts timestamp, row int, values array<float>"

    def reader(self, schema) -> RawGridReader:
        return RawGridReader(self.options)


def read_grid_rows(spark: SparkSession, path: str, grid: Grid, min_bytes: int = 0, band: int = BAND) -> DataFrame:
    """(run_ts, row, values): one row per grid row of every file, ``values`` from the first column on, no-data included.

    ``path`` is a folder, a file, or a pattern in the last part of one, in any place that Arrow's file systems reach. Files
    shorter than the grid, or than ``min_bytes``, were cut off in transfer and are skipped. A task reads ``band`` rows.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RawGridSource)
    options = {"path": path, "nrows": grid.nrows, "ncols": grid.ncols, "minbytes": min_bytes, "band": band}
    return spark.read.format("rawgrid").options(**options).load()
