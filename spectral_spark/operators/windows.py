"""Window functions along wavelength, rows and time: gradients, gaps, smoothing, peaks, rebinning, shifts, cosmics."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.robust import median, quantile
from .joins import carried, interp_onto, small


def _by(*keys: str):
    return Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)])


def choose_sequence(frames: DataFrame, label: str = "calibfib", mjd: int | None = None, n: int | None = None, night: str = "mjd", number: str = "expnum") -> DataFrame:
    """The first exposure of each standard: nearest to a night if one is given, then by number; the first n of them by number."""
    order = ([F.abs(F.col(night) - mjd)] if mjd is not None else []) + [F.col(number)]
    out = frames.withColumn("__r", F.row_number().over(_by(label).orderBy(*order))).where("__r = 1").drop("__r")
    return out if n is None else out.orderBy(number).limit(n)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(_by(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def gradient(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "gradient") -> DataFrame:
    """Central differences for unit steps, one-sided at the ends."""
    w = _by(*keys).orderBy(order)
    before, after, v = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return df.withColumn(out, F.coalesce((after - before) / 2, after - v, v - before))


def to_density(df: DataFrame, keys: Sequence[str], order: str, wave: str = "wave", value: str = "flux", undo: bool = False) -> DataFrame:
    """Divide by the width of a sample in wavelength, or multiply."""
    g = gradient(df, keys, order, wave, "__g")
    v = F.col(value) * F.col("__g") if undo else F.try_divide(F.col(value), F.col("__g"))
    return g.withColumn(value, v).drop("__g")


def find_peaks(df: DataFrame, keys: Sequence[str], order: str, threshold: float, min_dist: float = 0.0, npeaks: int | None = None, value: str = "flux") -> DataFrame:
    """Samples greater than the one before and no less than the one after, above a threshold, whose next peak is at least min_dist away; the npeaks greatest.

    A peak is kept by the distance to the one that follows, so the last one is dropped where a distance is asked for.
    """
    w = _by(*keys).orderBy(order)
    d = df.withColumn("__b", F.col(value) - F.lag(value).over(w)).withColumn("__a", F.lead(value).over(w) - F.col(value))
    p = d.where((F.col("__b") > 0) & (F.col("__a") <= 0) & (F.col(value) > threshold)).drop("__b", "__a")
    if min_dist:
        p = p.withColumn("__n", F.lead(order).over(w) - F.col(order)).where(F.col("__n") >= min_dist).drop("__n")
    if npeaks is not None:
        p = p.withColumn("__r", F.row_number().over(_by(*keys).orderBy(F.desc(value), order))).where(F.col("__r") <= npeaks).drop("__r")
    return p


def fill_gaps(df: DataFrame, keys: Sequence[str], order: str, value: str = "flux", bad: Column | None = None) -> DataFrame:
    """Linear interpolation over null or bad samples, the nearest good value beyond the ends; `filled` marks them."""
    good = F.col(value).isNotNull() if bad is None else F.col(value).isNotNull() & ~bad
    point = F.when(good, F.struct(F.col(order).cast("double").alias("x"), F.col(value).alias("y")))
    before, after = carried(point, [F.col(k) for k in keys], order, rows=True)
    d = df.withColumn("__b", before).withColumn("__a", after)
    b, a = F.col("__b"), F.col("__a")
    y = F.when(b.isNull(), a["y"]).when(a.isNull() | (a["x"] == b["x"]), b["y"]).otherwise(b["y"] + (F.col(order) - b["x"]) / (a["x"] - b["x"]) * (a["y"] - b["y"]))
    return d.withColumn("filled", ~good).withColumn(value, y).drop("__a", "__b")


def running_median(df: DataFrame, keys: Sequence[str], order: str, half: int, value: str = "flux", out: str | None = None) -> DataFrame:
    """Median of a box of rows, shorter at the ends."""
    return df.withColumn(out or value, median(F.col(value)).over(_by(*keys).orderBy(order).rowsBetween(-half, half)))


def running_mean(df: DataFrame, keys: Sequence[str], order: str, half: int, value: str = "flux", out: str | None = None) -> DataFrame:
    return df.withColumn(out or value, F.avg(value).over(_by(*keys).orderBy(order).rowsBetween(-half, half)))


def gauss_smooth(df: DataFrame, keys: Sequence[str], order: str, sigma: float, value: str = "flux", reach: float = 4.0) -> DataFrame:
    """Gaussian kernel over rows; the end values stand for what lies beyond them."""
    h = int(reach * sigma + 0.5)
    weights = [exp(-0.5 * (i / sigma) ** 2) for i in range(-h, h + 1)]
    w = _by(*keys).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = df.withColumn("__f", F.first(value).over(whole)).withColumn("__l", F.last(value).over(whole))
    at = lambda i: F.coalesce(F.lag(value, -i).over(w), F.col("__f" if i < 0 else "__l")) if i else F.col(value)
    total = sum(weights)
    terms = [at(i) * F.lit(c / total) for i, c in zip(range(-h, h + 1), weights)]
    acc = terms[0]
    for t in terms[1:]:
        acc = acc + t
    return d.withColumn("__s", acc).withColumn(value, F.col("__s")).drop("__f", "__l", "__s")


#: Side of the tiles into which frames are cut for running medians.
TILE = 64


def box_median_2d(df: DataFrame, keys: Sequence[str], half: int, x: str = "x", y: str = "y", value: str = "value", out: str = "smooth", tile: int = TILE) -> DataFrame:
    """Median of a square of pixels about each pixel, of those that there are and have a value (nulls and NaN do not count).

    Frames are cut into tiles that also get the pixels within `half` of their edges, so pixels are shuffled once, those near
    edges twice or more. Squares are sorted by numpy, a line of a tile at a time. Pixels that are listed several times all count.
    """
    side = max(tile, 4 * half)
    at = lambda c: F.floor(F.col(c) / side).cast("long")
    near = lambda c: F.sequence(F.floor((F.col(c) - half) / side).cast("long"), F.floor((F.col(c) + half) / side).cast("long"))
    own = [c for c in df.columns if c != out]
    dealt = df.select(*own).where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("__tx", F.explode(near(x))).withColumn("__ty", F.explode(near(y)))
    dealt = dealt.withColumn("__own", (F.col("__tx") == at(x)) & (F.col("__ty") == at(y)))

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        px, py = pdf[x].to_numpy(np.int64), pdf[y].to_numpy(np.int64)
        mine = pdf["__own"].to_numpy(bool)
        done = pdf.loc[mine, own].copy()
        done[out] = box_medians(px - px.min(), py - py.min(), pdf[value].to_numpy(float, na_value=np.nan), half)[mine]
        return done

    kinds = [f for f in df.select(*own).schema.fields]
    return dealt.groupBy(*keys, "__tx", "__ty").applyInPandas(smooth, StructType([*kinds, StructField(out, DoubleType())]))


def box_medians(x: np.ndarray, y: np.ndarray, value: np.ndarray, half: int) -> np.ndarray:
    """Median of the values within half of each point in x and in y; places are whole numbers from 0, NaN does not count."""
    n = 2 * half + 1
    order = np.lexsort((x, y))
    again = np.r_[False, (x[order][1:] == x[order][:-1]) & (y[order][1:] == y[order][:-1])]
    run = np.arange(len(x)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(x))))
    layer = np.empty(len(x), np.int64)
    layer[order] = run  # how often the place was listed before
    grid = np.full((int(layer.max()) + 1, int(y.max()) + n, int(x.max()) + n), np.nan)
    grid[layer, y + half, x + half] = value
    out = np.full(grid.shape[1:], np.nan)
    for line in np.unique(y).tolist():
        box = np.lib.stride_tricks.sliding_window_view(grid[:, line : line + n], n, axis=2)  # (layers, n, columns, n)
        box = np.sort(box.transpose(2, 0, 1, 3).reshape(box.shape[2], -1), axis=1)
        count = (~np.isnan(box)).sum(axis=1)
        rows = np.arange(len(box))
        low, high = box[rows, np.maximum(count - 1, 0) // 2], box[rows, count // 2 % box.shape[1]]
        out[line, : len(box)] = np.where(count > 0, np.where(count % 2, low, (low + high) / 2), np.nan)
    return out[y, x]


def expand_shifts(rows: DataFrame, starts: DataFrame, keys: Sequence[str], row: str = "y", shift: str = "shift") -> DataFrame:
    """Shifts that begin at rows as a value for every row, 0 before the first."""
    both = rows.select(*keys, row).distinct().join(starts.select(*keys, row, shift), [*keys, row], "left")
    w = _by(*keys).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(shift, F.coalesce(F.last(shift, True).over(w), F.lit(0)))


def compress_shifts(profile: DataFrame, keys: Sequence[str], row: str = "y", shift: str = "shift") -> DataFrame:
    """The rows at which the shift rises, with its value."""
    d = profile.withColumn("__d", F.col(shift) - F.coalesce(F.lag(shift).over(_by(*keys).orderBy(row)), F.lit(0)))
    return d.where("__d > 0").drop("__d")


def monotone_max(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    return df.withColumn(value, F.max(value).over(_by(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def runs(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Rows with the number of their run of equal values (`run`) and its length (`run_length`)."""
    w = _by(*keys).orderBy(order)
    d = df.withColumn("__c", (~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int")).withColumn("run", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")
    return d.withColumn("run_length", F.count(F.lit(1)).over(_by(*keys, "run")))


def flatten_runs(df: DataFrame, keys: Sequence[str], order: str, value: str, width: int, spikes: bool = True, valleys: bool = True) -> DataFrame:
    """Runs shorter than `width` that stand above (spikes) or below (valleys) both neighbours take the value of the run before."""
    r = runs(df, keys, order, value)
    per = r.groupBy(*keys, "run").agg(F.first(value).alias("__v"), F.first("run_length").alias("__n"))
    w = _by(*keys).orderBy("run")
    before, after = F.lag("__v").over(w), F.lead("__v").over(w)
    up, down = (F.col("__v") > before) & (F.col("__v") > after), (F.col("__v") < before) & (F.col("__v") < after)
    hit = (F.col("__n") < width) & ((up if spikes else F.lit(False)) | (down if valleys else F.lit(False)))
    new = per.withColumn("__new", F.when(hit, before).otherwise(F.col("__v"))).select(*keys, "run", "__new")
    return r.join(new, [*keys, "run"]).withColumn(value, F.col("__new")).drop("run", "run_length", "__new")


def shift_rows(df: DataFrame, profile: DataFrame, keys: Sequence[str], ncols: int, x: str = "x", row: str = "y", shift: str = "shift") -> DataFrame:
    """Move the pixels of a row around by its shift."""
    d = df.join(profile.select(*keys, row, shift), [*keys, row], "left")
    return d.withColumn(x, F.pmod(F.col(x) + F.coalesce(shift, F.lit(0)), F.lit(ncols)).cast("int")).drop(shift)


def bin_edges(df: DataFrame, keys: Sequence[str], order: str, wave: str = "wave") -> DataFrame:
    """Edges of samples half-way to their neighbours (lo, hi), mirrored at the ends."""
    w = _by(*keys).orderBy(order)
    b, a, x = F.lag(wave).over(w), F.lead(wave).over(w), F.col(wave)
    return df.withColumns({"lo": F.coalesce((x + b) / 2, x - (a - x) / 2), "hi": F.coalesce((x + a) / 2, x + (x - b) / 2)})


def rebin_conserving(df: DataFrame, keys: Sequence[str], order: str, start: float, step: float, n: int, wave: str = "wave", value: str = "flux") -> DataFrame:
    """Flux on n bins of one width from `start`, none lost: each sample is dealt to the bins that it overlaps, in proportion.

    Bins are made from a sample's edges by arithmetic, so there is no range join. A row for each bin that is met.
    """
    e = bin_edges(df, keys, order, wave)
    first, last = F.floor((F.col("lo") - start) / step), F.ceil((F.col("hi") - start) / step) - 1
    e = e.withColumn("__f", F.greatest(first, F.lit(0))).withColumn("__l", F.least(last, F.lit(n - 1))).where("__l >= __f")
    e = e.withColumn("bin", F.explode(F.sequence("__f", "__l")))
    left, right = F.lit(start) + F.col("bin") * step, F.lit(start) + (F.col("bin") + 1) * step
    part = (F.least(F.col("hi"), right) - F.greatest(F.col("lo"), left)) / (F.col("hi") - F.col("lo"))
    return e.groupBy(*keys, F.col("bin").cast("int").alias("bin")).agg(F.sum(F.col(value) * F.greatest(part, F.lit(0.0))).alias(value))


def rectify(df: DataFrame, keys: Sequence[str], order: str, start: float, step: float, n: int, wave: str = "wave", value: str = "flux", error: str = "error", mask: str = "mask", more: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Linear interpolation of native samples onto a uniform grid (k, wave = start + k step); the mask is that of the nearer sample.

    more has further columns of values and of their errors.

    Each pair of neighbouring samples makes the grid points between them, so there is no join. Points outside have no row.
    """
    w = _by(*keys).orderBy(order)
    nxt = lambda c: F.lead(c).over(w)
    pairs = [(value, error), *more]
    s = df.withColumns({"__w": nxt(wave), "__m": nxt(mask), **{f"__{i}{j}": nxt(pairs[i][j]) for i in range(len(pairs)) for j in range(2)}}).where(F.col("__w") > F.col(wave))
    first, last = F.ceil((F.col(wave) - start) / step), F.ceil((F.col("__w") - start) / step) - 1
    s = s.withColumn("__f", F.greatest(first, F.lit(0))).withColumn("__l", F.least(last, F.lit(n - 1))).where("__l >= __f").withColumn("k", F.explode(F.sequence("__f", "__l")))
    t = (F.lit(start) + F.col("k") * step - F.col(wave)) / (F.col("__w") - F.col(wave))
    between = lambda i, v: (F.col(v) + t * (F.col(f"__{i}0") - F.col(v))).alias(v)
    spread = lambda i, e: F.sqrt(F.pow((1 - t) * F.col(e), F.lit(2)) + F.pow(t * F.col(f"__{i}1"), F.lit(2))).alias(e)
    values = [c for i, (v, e) in enumerate(pairs) for c in (between(i, v), spread(i, e))]
    return s.select(*keys, F.col("k").cast("int").alias("k"), *values, F.when(t < 0.5, F.col(mask)).otherwise(F.col("__m")).alias(mask))


def linear_to_log(df: DataFrame, keys: Sequence[str], wave: str = "wave", value: str = "flux") -> DataFrame:
    """Spectra on grids of equal steps of log(wave): (keys, k, log_wave, value).

    A grid has as many points as the least step of its spectrum needs between its ends. Values are interpolated linearly
    in the logarithm; null and NaN values do not count. Neighbouring samples make the points between them, so nothing is joined.
    """
    d = df.where(F.col(wave) > 0).withColumn("__x", F.log(F.col(wave).cast("double")))
    whole, w = _by(*keys), _by(*keys).orderBy("__x")
    d = d.withColumn("__step", F.col("__x") - F.lag("__x").over(w))
    d = d.withColumns({"__lo": F.min("__x").over(whole), "__hi": F.max("__x").over(whole), "__step": F.min("__step").over(whole)})
    d = d.withColumn("__n", F.ceil(F.try_divide(F.col("__hi") - F.col("__lo"), F.col("__step")))).where("__n > 1").withColumn("__step", F.try_divide(F.col("__hi") - F.col("__lo"), F.col("__n") - 1))
    good = d.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    g = good.withColumns({"__x2": F.lead("__x").over(w), "__v2": F.lead(value).over(w), "__first": F.lag("__x").over(w).isNull()})
    place = lambda c: F.ceil((F.col(c) - F.col("__lo")) / F.col("__step") - 1e-9)
    since = F.when(F.col("__first"), 0).otherwise(place("__x"))
    upto = F.when(F.col("__x2").isNull(), F.col("__n")).otherwise(place("__x2")) - 1
    g = g.withColumn("__f", since).withColumn("__l", upto).where("__l >= __f").withColumn("k", F.explode(F.sequence("__f", "__l")))
    x = F.col("__lo") + F.col("k") * F.col("__step")
    t = F.greatest(F.least(F.try_divide(x - F.col("__x"), F.col("__x2") - F.col("__x")), F.lit(1.0)), F.lit(0.0))
    return g.select(*keys, F.col("k").cast("int").alias("k"), x.alias("log_wave"), (F.col(value) + F.coalesce(t * (F.col("__v2") - F.col(value)), F.lit(0.0))).alias(value))


def log_to_linear(samples: DataFrame, logs: DataFrame, keys: Sequence[str], shift: float = 0.0, wave: str = "wave", value: str = "flux", out: str = "flux") -> DataFrame:
    """Spectra (keys, log_wave, value) at the samples' wavelengths, moved by a shift of the logarithm; end values beyond their ends."""
    curve = logs.where(F.col(value).isNotNull()).select(*keys, F.exp(F.col("log_wave") + shift).alias("cw"), F.col(value).alias("cv"))
    return interp_onto(samples.drop(out), curve, wave, out, on=keys)


def laplacian(df: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", value: str = "value", out: str = "laplacian") -> DataFrame:
    """Positive Laplacian of each pixel on a doubled grid.

    Doubling a pixel leaves in each quarter the differences to two neighbours; negative ones count as 0 and the four are
    averaged. A neighbour that is not there counts as the pixel itself.
    """
    wx, wy = _by(*keys, y).orderBy(x), _by(*keys, x).orderBy(y)
    near = lambda w, c, at, step: F.when(F.abs(at - F.col(c)) == 1, step).otherwise(F.col(value))
    d = df.withColumns({
        "__l": near(wx, x, F.lag(x).over(wx), F.lag(value).over(wx)), "__r": near(wx, x, F.lead(x).over(wx), F.lead(value).over(wx)),
        "__u": near(wy, y, F.lag(y).over(wy), F.lag(value).over(wy)), "__d": near(wy, y, F.lead(y).over(wy), F.lead(value).over(wy)),
    })
    v = F.col(value)
    quarter = lambda a, b: F.greatest(2 * v - F.coalesce(a, v) - F.coalesce(b, v), F.lit(0.0))
    score = (quarter(F.col("__l"), F.col("__u")) + quarter(F.col("__r"), F.col("__u")) + quarter(F.col("__l"), F.col("__d")) + quarter(F.col("__r"), F.col("__d"))) / 4
    return d.withColumn(out, score).drop("__l", "__r", "__u", "__d")


def laplacian_outliers(df: DataFrame, keys: Sequence[str], sigma: float, noise: Column, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """Pixels whose positive Laplacian, over the noise, is more than sigma above the frame's median."""
    d = laplacian(df, keys, x, y, value, "score").withColumn("score", F.try_divide("score", 2 * noise))
    middle = quantile(d, keys, "score", 0.5, "__med", store=True)
    return d.join(small(middle), list(keys), "left").withColumn("score", F.col("score") - F.col("__med")).withColumn("cosmic", F.col("score") > sigma).drop("__med")


def cosmic_rays(df: DataFrame, keys: Sequence[str], sigma: float, rlim: float, readnoise: float, box: int = 2, smooth: int = 2, blur: float = 1.0, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """One pass of cosmic detection: `score` and `fine` of each pixel, and `cosmic` where they are greater than sigma and rlim.

    The score is the Laplacian over the noise of the local median (a square of 2 box + 1 pixels, negative medians as 0, and
    the read noise), less its own median in a square of 2 smooth + 1. fine is the Laplacian of the frame over its Gaussian blur.
    """
    level = box_median_2d(df, keys, box, x, y, value, "__level")
    noise = F.sqrt(F.greatest(F.col("__level"), F.lit(0.0)) + readnoise * readnoise)
    d = laplacian(level, keys, x, y, value, "score").withColumn("score", F.try_divide(F.col("score"), 2 * noise)).drop("__level")
    d = box_median_2d(d, keys, smooth, x, y, "score", "__s").withColumn("score", F.col("score") - F.col("__s")).drop("__s")
    d = d.withColumn("__b", F.col(value))
    d = gauss_smooth(gauss_smooth(d, [*keys, y], x, blur, "__b"), [*keys, x], y, blur, "__b")
    d = d.withColumn("__n", F.greatest(F.coalesce(F.try_divide(F.col(value), F.col("__b")), F.lit(0.0)), F.lit(0.0)))
    d = laplacian(d, keys, x, y, "__n", "fine").drop("__b", "__n")
    return d.withColumn("cosmic", (F.col("score") > sigma) & (F.col("fine") > rlim))


def gap_positions(df: DataFrame, keys: Sequence[str], order: str, centre: str, spacing: str) -> DataFrame:
    """Fill missing centres from the last known one and the known spacings since (those of the rows passed)."""
    w = _by(*keys).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("__s", F.sum(spacing).over(upto))
    last = F.last(F.when(F.col(centre).isNotNull(), F.struct(F.col(centre).alias("c"), F.col("__s").alias("s"))), True).over(upto)
    return d.withColumn("__p", last).withColumn(centre, F.coalesce(F.col(centre), F.col("__p.c") + F.col("__s") - F.col("__p.s"))).drop("__s", "__p")


def choose_shift_source(df: DataFrame, keys: Sequence[str], sources: Sequence[str]) -> DataFrame:
    """The first of several shift columns, in order of priority, that has any positive value in its group; 0 where none has."""
    w = _by(*keys)
    out, name = F.lit(0), F.lit("none")
    for s in list(sources)[::-1]:
        has = F.bool_or(F.col(s) > 0).over(w)
        out, name = F.when(has, F.col(s)).otherwise(out), F.when(has, s).otherwise(name)
    return df.withColumn("shift", out).withColumn("source", name)
