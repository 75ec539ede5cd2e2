"""Stacks of detector frames: masters, normalisation, overscan, pixel masks, rebinning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.robust import biweight_stats, mad_stats, median, quantile, statistic
from .joins import small
from .windows import fill_gaps

PIXEL = ("camera", "y", "x")


def stack(df: DataFrame, keys: Sequence[str] = PIXEL, method: str = "median", value: str = "value", error: str = "error", mask: str = "mask") -> DataFrame:
    """One value for each pixel over frames: mean, sum or median of the unmasked; error sqrt(stat(error^2)); masked only if all are."""
    good = lambda c: F.when(~F.col(mask), c)
    f = {"mean": F.avg, "sum": F.sum, "median": median}[method]
    return df.groupBy(*keys).agg(f(good(F.col(value))).alias(value), F.sqrt(f(good(F.col(error) * F.col(error)))).alias(error), F.every(F.col(mask)).alias(mask), F.count_if(~F.col(mask)).alias("n"))


def stack_clipped(df: DataFrame, keys: Sequence[str] = PIXEL, k: float = 3.0, value: str = "value", mask: str = "mask") -> DataFrame:
    """Mean of the unmasked values within k standard deviations of the median; how many were kept."""
    w = Window.partitionBy(*keys)
    v = df.where(~F.col(mask)).withColumn("__m", median(F.col(value)).over(w)).withColumn("__s", F.stddev_pop(value).over(w))
    return v.where(F.abs(F.col(value) - F.col("__m")) <= k * F.col("__s")).groupBy(*keys).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))


def combine(df: DataFrame, keys: Sequence[str], method: str, q: float = 0.5, value: str = "flux", error: str = "error", mask: str = "mask") -> DataFrame:
    """Spectra of one key as one: sum, mean, median, quantile, ivar (inverse-variance mean) or biweight of the unmasked; mask if all are."""
    good = df.withColumn("__v", F.when(~F.col(mask), F.col(value))).withColumn("__w", F.when(~F.col(mask) & (F.col(error) > 0), 1 / (F.col(error) * F.col(error))))
    masks = good.groupBy(*keys).agg(F.every(F.col(mask)).alias(mask))
    if method == "biweight":
        out = biweight_stats(good, keys, "__v").select(*keys, F.col("location").alias(value), (F.col("scale") / F.sqrt("n")).alias(error))
    elif method == "ivar":
        out = good.groupBy(*keys).agg(F.try_divide(F.sum(F.col("__v") * F.col("__w")), F.sum("__w")).alias(value), F.try_divide(F.lit(1.0), F.sqrt(F.sum("__w"))).alias(error))
    else:
        f = {"sum": F.sum, "mean": F.avg, "median": median, "quantile": lambda c: F.percentile(c, F.lit(q))}[method]
        e2 = F.sum(F.when(~F.col(mask), F.col(error) * F.col(error)))
        e = F.sqrt(e2) if method == "sum" else F.try_divide(F.sqrt(e2), F.count("__v"))
        out = good.groupBy(*keys).agg(f(F.col("__v")).alias(value), e.alias(error))
    return masks.join(out, list(keys), "left")


def overscan_profile(df: DataFrame, group: Sequence[str], row: str = "y", stat: str = "biweight", model: str = "profile", value: str = "value") -> DataFrame:
    """Overscan level of each row of each group (quadrant): its own statistic (profile) or the group's median of them (constant)."""
    out = statistic(df, [*group, row], value, stat, "level")
    if model == "constant":
        out = out.withColumn("level", median(F.col("level")).over(Window.partitionBy(*group)))
    return out


def subtract_overscan(df: DataFrame, profile: DataFrame, group: Sequence[str], row: str = "y", value: str = "value") -> DataFrame:
    return df.join(profile, [*group, row], "left").withColumn(value, F.col(value) - F.coalesce("level", F.lit(0.0))).drop("level")


def quadrant_stats(df: DataFrame, group: Sequence[str], row: str = "y", value: str = "value", gain: float = 1.0) -> DataFrame:
    """Of each quadrant: median of all pixels, median of the rows' standard deviations, and the read noise in electrons."""
    rows = df.groupBy(*group, row).agg(F.stddev_pop(value).alias("s")).groupBy(*group).agg(median(F.col("s")).alias("sigma"))
    return df.groupBy(*group).agg(median(F.col(value)).alias("level")).join(rows, list(group)).withColumn("readnoise", F.col("sigma") * gain)


#: How the frames of a kind are brought to one level before stacking: percentile, or median of the frame.
NORMALIZE = {"bias": 50.0, "arc": 99.0, "flat": 75.0, "pixflat": 50.0, "dark": None}


def sample_n(df: DataFrame, group: Sequence[str], n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """n rows of each group, drawn without replacement by a seeded hash of their keys."""
    w = Window.partitionBy(*group).orderBy(F.xxhash64(F.lit(seed), *key), *key)
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def make_master(pixels: DataFrame, kind: str, camera: str = "camera", frame: str = "frame", batch: int | None = None, seed: int = 0, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Master of a kind: all frames of a camera, or `batch` of them drawn by a seed, brought to one level and median-stacked."""
    chosen = pixels
    if batch is not None:
        chosen = pixels.join(sample_n(pixels.select(camera, frame).distinct(), [camera], batch, [camera, frame], seed), [camera, frame])
    percent = NORMALIZE[kind]
    if percent is not None:
        per = quantile(chosen, [camera, frame], "value", percent / 100, "__p")
        level = F.lit(1.0) if kind == "pixflat" else median(F.col("__p")).over(Window.partitionBy(camera))
        factor = per.withColumn("__f", F.try_divide(level, F.col("__p"))).select(camera, frame, "__f")
        chosen = chosen.join(factor, [camera, frame]).withColumns({"value": F.col("value") * F.col("__f"), "error": F.col("error") * F.col("__f")})
    return stack(chosen, keys, "median")


def majority(df: DataFrame, group: Sequence[str], kind: str = "imagetyp") -> DataFrame:
    """The kind that most frames of a group have, the first by name of several."""
    return df.groupBy(*group, kind).count().groupBy(*group).agg(F.min_by(kind, F.struct(-F.col("count"), F.col(kind))).alias(kind))


def lamps_union(df: DataFrame, group: Sequence[str], lamps: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(*[F.bool_or(lamp).alias(lamp) for lamp in lamps])


def analog_groups(frames: DataFrame, keys: Sequence[str] = ("tileid", "mjd", "imagetyp", "camera"), member: str = "expnum") -> DataFrame:
    """Frames that compare: the keys, the members in order, and their number."""
    return frames.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias("members"), F.count(F.lit(1)).alias("n"))


def pixel_mask(short: DataFrame, long: DataFrame, flat_a: DataFrame, flat_b: DataFrame, keys: Sequence[str], hot: float, cold: float, low: float, high: float) -> DataFrame:
    """hot or cold: the ratio of the dark currents of a long and a short exposure is beyond a threshold, or that of two flats is."""
    col = lambda df, name: df.select(*keys, F.col("value").alias(name))
    out = col(short, "s").join(col(long, "l"), list(keys)).join(col(flat_a, "fa"), list(keys)).join(col(flat_b, "fb"), list(keys))
    dark, flat = F.try_divide("l", "s"), F.try_divide("fa", "fb")
    return out.select(*keys, F.coalesce(dark > hot, F.lit(False)).alias("hot"), (F.coalesce(dark < cold, F.lit(False)) | F.coalesce((flat < low) | (flat > high), F.lit(True))).alias("cold"))


def rebin_sum(df: DataFrame, bx: int, by: int, keys: Sequence[str] = ("camera",), x: str = "x", y: str = "y") -> DataFrame:
    """Sums of blocks, errors in quadrature, masked if any pixel is."""
    block = lambda c, b: F.floor(F.col(c) / b).cast("int")
    return df.groupBy(*keys, block(y, by).alias(y), block(x, bx).alias(x)).agg(F.sum("value").alias("value"), F.sqrt(F.sum(F.col("error") * F.col("error"))).alias("error"), F.bool_or("mask").alias("mask"))


def replicate(df: DataFrame, f: int, x: str = "x", y: str = "y") -> DataFrame:
    """Each pixel as f x f pixels."""
    e = df.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(f - 1)))).withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(f - 1))))
    return e.withColumns({x: F.col(x) * f + F.col("__i"), y: F.col(y) * f + F.col("__j")}).drop("__i", "__j")


def strip_bins(df: DataFrame, strips: DataFrame, width: int, nsigma: float, keys: Sequence[str] = ("camera",), x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """In strips of rows (strip, y0, y1, ends included) and bins of columns: biweight location and scale of the values within nsigma of the median.

    Distinct rows of the detector meet the strips by range; pixels then join them by equality.
    """
    lines = df.select(F.col(y).alias("__y")).distinct().join(small(strips), F.col("__y").between(F.col("y0"), F.col("y1"))).select("__y", "strip")
    hit = df.join(small(lines), F.col(y) == F.col("__y")).drop("__y").withColumn("bin", F.floor(F.col(x) / width).cast("int"))
    group = [*keys, "strip", "bin"]
    clip = mad_stats(hit, group, value)
    kept = hit.join(clip, group).where(F.abs(F.col(value) - F.col("median")) <= nsigma * F.col("sigma"))
    return biweight_stats(kept, group, value).select(*group, "n", F.col("location").alias("value"), F.col("scale").alias("error"))


def clean_bins(bins: DataFrame, nsigma: float, keys: Sequence[str] = ("camera",)) -> DataFrame:
    """strip_bins' result with the bins of each strip that lie more than nsigma robust sigmas off its median bridged along the strip; `clipped` marks them."""
    group = [*keys, "strip"]
    far = bins.join(mad_stats(bins, group, "value"), group).withColumn("clipped", F.abs(F.col("value") - F.col("median")) > nsigma * F.col("sigma")).drop("median", "sigma")
    return fill_gaps(far, group, "bin", "value", bad=F.col("clipped")).drop("filled")


