"""Sorts, top rows, and set operations on spectra and frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.robust import median
from ..functions.scalars import trailing_number
from .joins import small


def sort_calibrations(frames: DataFrame, flat: Column, arc: Column, science: Column) -> DataFrame:
    """Flats, arcs, flats again, then science frames, each by camera and exposure; `step` numbers the passes."""
    parts = [frames.where(c).withColumn("step", F.lit(k)) for k, c in enumerate((flat, arc, flat, science))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("step", "camera", "expnum")


def select_extreme(df: DataFrame, group: Sequence[str], nmin: int, nmax: int, value: str = "flux", fiber: str = "fiberid") -> DataFrame:
    """The nmin faintest and nmax brightest fibres of a group; `side` tells which."""
    lo = F.row_number().over(Window.partitionBy(*group).orderBy(value, fiber))
    hi = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(value), fiber))
    d = df.withColumn("__l", lo).withColumn("__h", hi)
    return d.where((F.col("__l") <= nmin) | (F.col("__h") <= nmax)).withColumn("side", F.when(F.col("__l") <= nmin, "min").otherwise("max")).drop("__l", "__h")


def largest_exptime(masters: DataFrame, group: Sequence[str], exptime: str = "exptime", key: str = "expnum") -> DataFrame:
    """The master of the longest exposure, the first by its key of several."""
    w = Window.partitionBy(*group).orderBy(F.desc(exptime), key)
    return masters.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def sort_by_label_number(df: DataFrame, label: str) -> DataFrame:
    return df.orderBy(trailing_number(F.col(label)), label)


def stack_spectrographs(parts: Sequence[DataFrame], fibers: int, fiber: str = "fiberid") -> DataFrame:
    """Fibres of several spectrographs one after the other; columns that one of them lacks are null."""
    out = None
    for k, p in enumerate(parts):
        q = p.withColumn(fiber, F.col(fiber) + k * fibers).withColumn("spectrograph", F.lit(k + 1))
        out = q if out is None else out.unionByName(q, allowMissingColumns=True)
    return out


def split_parts(df: DataFrame, n: int, total: int, column: str) -> DataFrame:
    """Number of the equal part (from 0) that a row or column of `total` lies in, and its place in it."""
    size = -(-total // n)
    return df.withColumn("part_no", F.floor(F.col(column) / size).cast("int")).withColumn(column, (F.col(column) % size).cast(df.schema[column].dataType))


def join_parts(df: DataFrame, n: int, total: int, column: str) -> DataFrame:
    size = -(-total // n)
    return df.withColumn(column, (F.col(column) + F.col("part_no") * size).cast(df.schema[column].dataType)).drop("part_no")


def merge_headers(df: DataFrame, keys: Sequence[str], order: str, keep: str = "last", header: str = "header") -> DataFrame:
    """One keyword map of many, the first or the last value of a keyword by order."""
    rows = df.select(*keys, order, F.explode(header).alias("k", "v"))
    best = rows.groupBy(*keys, "k").agg((F.max_by if keep == "last" else F.min_by)("v", F.struct(order, "v")).alias("v"))
    return best.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(header))


def extend_grid(df: DataFrame, grid: DataFrame, keys: Sequence[str], k: str) -> DataFrame:
    """Every key on every point of a grid, null where there was no sample. One row holds the grid as an array and is broadcast: grids are wavelengths, some ten thousand points."""
    points = F.array_sort(F.collect_set(k))
    return df.select(*keys).distinct().crossJoin(F.broadcast(grid.agg(points.alias("__g")))).select(*keys, F.explode("__g").alias(k)).join(df, [*keys, k], "left")  # one row


def glue_quadrants(df: DataFrame, places: DataFrame, quadrant: str = "quadrant", x: str = "x", y: str = "y") -> DataFrame:
    """Pixels of quadrants on one image: places has (quadrant, x0, y0, width, height, flip_x, flip_y)."""
    d = df.join(small(places), quadrant)
    nx = F.when(F.col("flip_x"), F.col("width") - 1 - F.col(x)).otherwise(F.col(x)) + F.col("x0")
    ny = F.when(F.col("flip_y"), F.col("height") - 1 - F.col(y)).otherwise(F.col(y)) + F.col("y0")
    return d.withColumn("__x", nx).withColumn("__y", ny).drop(x, y, "x0", "y0", "width", "height", "flip_x", "flip_y").withColumnsRenamed({"__x": x, "__y": y})


def glue_wavelength(a: DataFrame, b: DataFrame, keys: Sequence[str], at: float, wave: str = "wave", value: str = "flux", rescale: bool = True) -> DataFrame:
    """a below a wavelength and b from it on; b scaled by the median ratio in the overlap if asked."""
    if rescale:
        r = a.select(*keys, wave, F.col(value).alias("__a")).join(b, [*keys, wave]).groupBy(*keys).agg(median(F.try_divide("__a", value)).alias("__r"))
        b = b.join(r, list(keys), "left").withColumn(value, F.col(value) * F.coalesce("__r", F.lit(1.0))).drop("__r")
    return a.where(F.col(wave) < at).unionByName(b.where(F.col(wave) >= at))


def unexposed(all_: DataFrame, seen: DataFrame, label: str) -> DataFrame:
    """Standards that no frame exposed."""
    return all_.select(label).subtract(seen.select(label))


def in_both(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
    return a.select(label).intersect(b.select(label))


def left_over(wanted: DataFrame, used: DataFrame, label: str) -> DataFrame:
    """What is left of a multiset once each use has taken one."""
    return wanted.select(label).exceptAll(used.select(label))
