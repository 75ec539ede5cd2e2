"""Extraction of spectra from pixels, line fits, wavelength solutions, resolution, continua and sky models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import erf, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.robust import median
from ..functions.scalars import extinction_factor
from ..shared import stored
from .fits import polyfit
from .joins import interp_onto, small
from .spectra import reject_fiber_outliers
from .windows import fill_gaps, running_median

FWHM = 2 * sqrt(2 * log(2))


def extract_aperture(pixels: DataFrame, trace: DataFrame, n: int, keys: Sequence[str], x: str = "x", y: str = "y", fiber: str = "fiberid", centre: str = "centre") -> DataFrame:
    """Sum of n pixels about each fibre's centre (keys, x, fiber, centre) in each column; errors in quadrature, masked if any is."""
    low = F.floor(F.col(centre) - n / 2 + 0.5 + 0.5).cast("int")
    rows = trace.select(*keys, x, fiber, F.explode(F.sequence(low, low + n - 1)).alias(y))
    j = rows.join(pixels, [*keys, x, y])
    return j.groupBy(*keys, fiber, x).agg(F.sum("value").alias("flux"), F.sqrt(F.sum(F.col("error") * F.col("error"))).alias("error"), F.bool_or("mask").alias("mask"), F.count(F.lit(1)).alias("pixels"))


_ERF_STEP = 1 / 128
_ERF = np.array([erf(k * _ERF_STEP) for k in range(int(6 / _ERF_STEP) + 2)])


def _erf(x: np.ndarray) -> np.ndarray:
    """The error function of an array, to about 1e-13: a table, and four terms of Taylor's series from its nearest point."""
    a = np.minimum(np.abs(x), 6.0)
    k = np.rint(a / _ERF_STEP).astype(np.int64)
    g = k * _ERF_STEP
    d = a - g
    slope = 2 / sqrt(np.pi) * np.exp(-g * g)
    return np.sign(x) * (_ERF[k] + slope * d * (1 + d * (-g + d * ((2 * g * g - 1) / 3 + d * (g * (3 - 2 * g * g) / 6)))))


def _shares(y: np.ndarray, centre: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """Share of a Gaussian that falls on a pixel."""
    z = lambda edge: _erf((edge - centre) / (sigma * sqrt(2)))
    return 0.5 * (z(y + 0.5) - z(y - 0.5))


def _profile(rows: np.ndarray, centre: np.ndarray, sigma: np.ndarray) -> np.ndarray:
    """Shares of all Gaussians on all pixels: (rows, fibres)."""
    return _shares(rows[:, None], centre[None, :], sigma[None, :])


def profile_windows(rows: np.ndarray, centre: np.ndarray, sigma: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(first, share): for each fibre the first of the sorted rows within its reach, and the shares of its Gaussian on it and the rows that follow, 0 beyond the reach."""
    first, last = np.searchsorted(rows, centre - reach * sigma), np.searchsorted(rows, centre + reach * sigma, "right")
    at = first[:, None] + np.arange(max(1, int((last - first).max(initial=0))))[None, :]
    y = rows[np.minimum(at, len(rows) - 1)]
    return first, np.where(at < last[:, None], _shares(y, centre[:, None], sigma[:, None]), 0.0)


def solve_banded(bands: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a symmetric system with entries bands[j, i] at (i, i + j), in time linear in its size: elimination by blocks as wide as the band."""
    b, n = len(bands) - 1, len(right)
    if not b:
        return right / bands[0]
    m = -(-n // b)
    full = np.zeros((b + 1, (m + 1) * b))
    full[:, :n] = bands
    full[0, n:] = 1.0
    rest = np.zeros(m * b)
    rest[:n] = right
    p, q = np.arange(b)[:, None], np.arange(b)[None, :]
    at = (np.arange(m) * b)[:, None, None]
    own = full[np.abs(p - q)[None], at + np.minimum(p, q)[None]]
    next_ = np.where(q <= p, full[np.minimum(b + q - p, b)[None], at + p[None]], 0.0)
    rest = rest.reshape(m, b)
    for t in range(1, m):
        known = np.linalg.solve(own[t - 1], np.c_[next_[t - 1], rest[t - 1]])
        own[t] -= next_[t - 1].T @ known[:, :b]
        rest[t] -= next_[t - 1].T @ known[:, b]
    x = np.empty((m, b))
    x[-1] = np.linalg.solve(own[-1], rest[-1])
    for t in range(m - 2, -1, -1):
        x[t] = np.linalg.solve(own[t], rest[t] - next_[t] @ x[t + 1])
    return x.ravel()[:n]


#: Fibres of a run that are solved as one dense system; longer runs are eliminated by bands.
DENSE = 64


def banded_product(bands: np.ndarray, x: np.ndarray) -> np.ndarray:
    out, n = bands[0] * x, len(x)
    for j in range(1, len(bands)):
        out[: n - j] += bands[j, : n - j] * x[j:]
        out[j:] += bands[j, : n - j] * x[: n - j]
    return out


def solve_run(bands: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Fluxes of one run of overlapping fibres; where some cannot be told apart (fibres at one centre, or that see one pixel only), those of least norm."""
    n = len(right)

    def sound(x: np.ndarray) -> bool:
        return bool(np.abs(banded_product(bands, x) - right).max() <= 1e-6 * max(np.abs(right).max(), 1e-300))

    def whole() -> np.ndarray:
        out = np.zeros((n, n))
        for j, band in enumerate(bands[:n]):
            i = np.arange(n - j)
            out[i, i + j] = out[i + j, i] = band[: n - j]
        return out

    dense = whole() if n <= DENSE else None
    try:
        x = solve_banded(bands, right) if dense is None else np.linalg.solve(dense, right)
        if sound(x):
            return x
    except np.linalg.LinAlgError:
        pass
    if n <= 8 * DENSE:
        return np.linalg.lstsq(whole() if dense is None else dense, right, rcond=None)[0]
    # a long run: the same system with a little on its diagonal, again for what is left, keeps the least norm and stays linear
    more = bands.copy()
    more[0] += 1e-7 * bands[0].max()
    x = np.zeros(n)
    for _ in range(60):
        x = x + solve_banded(more, right - banded_product(bands, x))
        if np.abs(banded_product(bands, x) - right).max() <= 1e-12 * np.abs(right).max():
            break
    return x


def solve_profiles(rows: np.ndarray, value: np.ndarray, weight: np.ndarray, centre: np.ndarray, sigma: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(flux, error) of fibres in order of their centres: weighted least squares. rows are sorted.

    Fibres whose windows overlap depend on each other; the normal equations have a band as wide as the most fibres that
    overlap, so the time is linear in the number of fibres however many overlap in a chain. Runs of fibres that share no
    weighted pixel are solved apart: one that is singular costs and changes no other.
    """
    n = len(centre)
    flux, err = np.full(n, np.nan), np.full(n, np.nan)
    first, share = profile_windows(rows, centre, sigma, reach)
    k = share.shape[1]
    at = np.minimum(first[:, None] + np.arange(k)[None, :], len(rows) - 1)
    a = share * weight[at]
    norm = (a * a).sum(1)
    ok = np.flatnonzero(norm > 0)
    if not len(ok):
        return flux, err
    err[ok] = 1 / np.sqrt(norm[ok])
    a, first, right = a[ok], first[ok], (a * (value * weight)[at]).sum(1)[ok]
    ahead = np.pad(a, ((0, 0), (0, k)))
    least = np.minimum.accumulate(first[::-1])[::-1]  # where this fibre or any further one begins
    bands = [norm[ok]]
    while len(bands) < len(ok):  # products with the fibre that lies so many places further on
        j = len(bands)
        shift = first[j:] - first[:-j]
        near = np.abs(shift) < k
        if (least[j:] - first[:-j] >= k).all():
            break
        left = np.where(shift >= 0, shift, 0)[:, None] + np.arange(k)
        other = np.where(shift < 0, -shift, 0)[:, None] + np.arange(k)  # a wider fibre may begin before a narrower one
        product = (np.take_along_axis(ahead[:-j], np.minimum(left, 2 * k - 1), 1) * np.take_along_axis(ahead[j:], np.minimum(other, 2 * k - 1), 1)).sum(1)
        bands.append(np.r_[np.where(near, product, 0.0), np.zeros(j)])
    bands = np.array(bands)
    linked = np.zeros(len(ok), dtype=np.int64)  # how many pairs reach over the gap behind a fibre
    for j in range(1, len(bands)):
        pairs = np.r_[0, np.cumsum(bands[j, : len(ok) - j] != 0)]
        gap = np.arange(len(ok) - 1)
        linked[:-1] += pairs[np.minimum(gap + 1, len(ok) - j)] - pairs[np.minimum(np.maximum(gap + 1 - j, 0), len(ok) - j)]
    ends = np.flatnonzero(linked == 0) + 1
    starts = np.r_[0, ends[:-1]]
    alone = ends - starts == 1
    found = np.empty(len(ok))
    found[starts[alone]] = right[starts[alone]] / bands[0, starts[alone]]
    for s, e in zip(starts[~alone], ends[~alone]):
        found[s:e] = solve_run(bands[: e - s, s:e], right[s:e])
    flux[ok] = found
    return flux, err


def extract_optimal(pixels: DataFrame, trace: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", fiber: str = "fiberid", reach: float = 5.0) -> DataFrame:
    """Weighted least squares of all fibre profiles (keys, x, fiber, centre, sigma) in each detector column.

    A group is one column of one detector: its height in pixels. Only pixels within reach sigmas of a centre are
    evaluated, and runs of fibres whose windows overlap are solved together, long ones by a banded elimination. error is 1 / sqrt(sum (p / s)^2); masked
    pixels have no weight, a fibre without any is null.
    """
    both = pixels.select(*keys, x, F.col(y).cast("double").alias("y"), "value", "error", "mask", F.lit(None).cast("long").alias("fiber"), F.lit(None).cast("double").alias("centre"), F.lit(None).cast("double").alias("sigma"))
    own = trace.select(*keys, x, F.lit(None).cast("double").alias("y"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("double").alias("error"), F.lit(None).cast("boolean").alias("mask"), F.col(fiber).cast("long").alias("fiber"), F.col("centre").cast("double"), F.col("sigma").cast("double"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pix, fib = pdf[pdf["fiber"].isna()].sort_values("y"), pdf[pdf["fiber"].notna()].sort_values(["centre", "fiber"])
        out = fib[[*keys, x]].copy()
        out[fiber] = fib["fiber"].astype("int64")
        out["flux"], out["error"] = np.nan, np.nan
        if len(pix) and len(fib):
            e = pix["error"].to_numpy(float)
            w = np.where(pix["mask"].astype(bool) | ~(e > 0), 0.0, 1 / np.where(e > 0, e, 1.0))
            v = np.where(w > 0, pix["value"].to_numpy(float), 0.0)
            out["flux"], out["error"] = solve_profiles(pix["y"].to_numpy(float), v, w, fib["centre"].to_numpy(float), fib["sigma"].to_numpy(float), reach)
        return out

    kinds = ", ".join(f"`{k}` {pixels.schema[k].dataType.simpleString()}" for k in [*keys, x])
    out = both.unionByName(own).groupBy(*keys, x).applyInPandas(solve, f"{kinds}, {fiber} long, flux double, error double")
    return out.withColumn("mask", F.col("flux").isNull() | F.isnan("flux"))


#: Pixels that one task makes of fibres before they are summed.
RENDERED = 1 << 20


def render_profiles(spectra: DataFrame, keys: Sequence[str], half: int, x: str = "x", y: str = "y") -> DataFrame:
    """Fibres (keys, x, flux, centre, sigma) as pixels again: normalised Gaussians, sampled within half rows of the centres and summed.

    Fibres are stored and counted, so that each task makes a bounded number of pixels of them.
    """
    spectra = stored(spectra.select(*keys, x, "flux", "centre", "sigma"), "fibers")
    parts = -(-spectra.count() * (2 * half + 1) // RENDERED)
    rows = spectra.repartition(max(1, parts), *keys, x, "centre").withColumn(y, F.explode(F.sequence((F.round("centre") - half).cast("int"), (F.round("centre") + half).cast("int"))))
    u = (F.col(y) - F.col("centre")) / F.col("sigma")
    v = F.col("flux") * F.exp(-0.5 * u * u) / (F.col("sigma") * sqrt(2 * np.pi))
    return rows.groupBy(*keys, x, y).agg(F.sum(v).alias("model"))


def line_moments(samples: DataFrame, lines: DataFrame, keys: Sequence[str], half: float, wave: str = "wave", value: str = "flux", mask: str = "mask") -> DataFrame:
    """First look at lines (line, line_wave): background (least), flux above it, centroid and width, good and bad samples."""
    near = samples.select(F.col(wave).alias("__w")).distinct().join(small(lines), F.abs(F.col("__w") - F.col("line_wave")) <= half)
    j = samples.join(near, F.col(wave) == F.col("__w"))
    g = [*keys, "line", "line_wave"]
    base = j.where(~F.col(mask)).groupBy(*g).agg(F.min(value).alias("background"))
    k = j.join(base, g).withColumn("__v", F.when(~F.col(mask), F.col(value) - F.col("background")))
    m = k.groupBy(*g).agg(F.first("background").alias("background"), F.sum("__v").alias("flux"), F.sum(F.col("__v") * F.col(wave)).alias("__a"), F.sum(F.col("__v") * F.col(wave) * F.col(wave)).alias("__b"), F.count_if(~F.col(mask)).alias("good"), F.count_if(F.col(mask)).alias("bad"))
    c = F.try_divide("__a", "flux")
    return m.withColumn("centre", c).withColumn("fwhm", F.sqrt(F.greatest(F.try_divide("__b", "flux") - c * c, F.lit(0.0))) * FWHM).drop("__a", "__b")


def fit_lines(samples: DataFrame, lines: DataFrame, keys: Sequence[str], half: float, wave: str = "wave", value: str = "flux", mask: str = "mask", rounds: int = 20, most_bad: int = 3) -> DataFrame:
    """A Gaussian and a constant at each line of each fibre: flux, centre, fwhm, background; null with more bad samples than most_bad, with two of them within 3.5 sigma of the centre, or without convergence.

    A line's window becomes one row of arrays; Python fits all rows of a batch at once by damped Gauss-Newton steps.
    """
    near = samples.select(F.col(wave).alias("__w")).distinct().join(small(lines), F.abs(F.col("__w") - F.col("line_wave")) <= half)
    g = [*keys, "line", "line_wave"]
    j = samples.join(near, F.col(wave) == F.col("__w")).groupBy(*g).agg(F.array_sort(F.collect_list(F.struct(F.col(wave).cast("double").alias("w"), F.col(value).cast("double").alias("v"), F.col(mask).alias("m")))).alias("s"))
    j = j.select(*g, F.transform("s", lambda s: s["w"]).alias("w"), F.transform("s", lambda s: s["v"]).alias("v"), F.transform("s", lambda s: s["m"].cast("double")).alias("m"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[g].copy()
            n = max([len(x) for x in pdf["w"]], default=0)
            pad = lambda c, fill: np.array([np.r_[np.asarray(x, float), np.full(n - len(x), fill)] for x in pdf[c]]).reshape(len(pdf), n)  # noqa: E731, B023
            w, v, bad = pad("w", 0.0), pad("v", 0.0), pad("m", 1.0)
            own = np.array([len(x) for x in pdf["w"]])
            use = bad == 0
            ok = (use.sum(1) >= 5) & (own - use.sum(1) <= most_bad)
            p = gauss_newton(w, v, use, rounds)
            ok &= np.isfinite(p).all(1) & (np.abs(p[:, 1] - pdf["line_wave"].to_numpy(float)) <= half)
            core = ~use & (np.arange(n)[None, :] < own[:, None]) & (np.abs(w - p[:, 1:2]) <= 3.5 * np.abs(p[:, 2:3]))
            ok &= core.sum(1) < 2
            p[~ok] = np.nan
            out["flux"], out["centre"], out["fwhm"], out["background"] = p[:, 0], p[:, 1], np.abs(p[:, 2]) * FWHM, p[:, 3]
            yield out

    kinds = ", ".join(f"`{k}` {j.schema[k].dataType.simpleString()}" for k in g)
    fitted = j.mapInPandas(fit, f"{kinds}, flux double, centre double, fwhm double, background double")
    return fitted.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("flux", "centre", "fwhm", "background")})


def fit_wave_offsets(samples: DataFrame, lines: DataFrame, group: Sequence[str], fiber: str = "fiberid", half: float = 4.0, snr: float = 10.0, flux_to_background: float = 0.7, share: float = 0.5, smooth: int = 4, wave: str = "wave", value: str = "flux", error: str = "error", mask: str = "mask") -> DataFrame:
    """For each fibre (group, fiber, offset, measured) the median over lines (line, line_wave) of fitted centre minus line.

    The brightest samples near the lines give a first guess, by which a fibre's wavelengths are moved before Gaussians and
    backgrounds are fitted. A fibre is measured only if all lines have the signal to noise, a fit, and enough flux over
    the background. In a group with more than a share of measured fibres, offsets are smoothed along the slit by a running
    median and bridged over the other fibres; in others they are 0.
    """
    near = samples.select(F.col(wave).alias("__w")).distinct().join(small(lines), F.abs(F.col("__w") - F.col("line_wave")) <= half)
    hit = samples.where(~F.col(mask)).join(near, F.col(wave) == F.col("__w"))
    per = hit.groupBy(*group, fiber, "line").agg(F.sum(F.try_divide(F.col(value), F.col(error))).alias("__snr"), (F.max_by(wave, F.struct(value, -F.col(wave))) - F.first("line_wave")).alias("__g"))
    number = lines.agg(F.countDistinct("line").alias("__all"))  # one row
    guess = per.groupBy(*group, fiber).agg(median(F.col("__g")).alias("__shift"), F.min("__snr").alias("__least"), F.count(F.lit(1)).alias("__n"))
    guess = guess.crossJoin(F.broadcast(number)).where((F.col("__least") >= snr) & (F.col("__n") == F.col("__all"))).select(*group, fiber, "__shift", "__all")
    moved = samples.join(guess, [*group, fiber]).withColumn(wave, F.col(wave) - F.col("__shift"))
    fits = fit_lines(moved, lines, [*group, fiber, "__shift", "__all"], half, wave, value, mask)
    good = fits.where(F.col("centre").isNotNull() & (F.coalesce(F.try_divide(F.col("flux"), F.col("background")), F.lit(float("inf"))) >= flux_to_background))
    found = good.groupBy(*group, fiber, "__all").agg(median(F.col("centre") + F.col("__shift") - F.col("line_wave")).alias("offset"), F.count(F.lit(1)).alias("__n")).where("__n = __all")
    found = running_median(found.select(*group, fiber, "offset"), group, fiber, smooth, "offset") if smooth else found.select(*group, fiber, "offset")
    every = samples.select(*group, fiber).distinct().join(found, [*group, fiber], "left").withColumn("measured", F.col("offset").isNotNull())
    known = F.avg(F.col("measured").cast("int")).over(Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)]))
    out = fill_gaps(every.withColumn("__share", known), group, fiber, "offset").drop("filled")
    return out.select(*group, fiber, F.when(F.col("__share") > share, F.col("offset")).otherwise(0.0).alias("offset"), "measured")


def gauss_newton(w: np.ndarray, v: np.ndarray, use: np.ndarray, rounds: int) -> np.ndarray:
    """(flux, centre, sigma, background) of rows of samples."""
    big = np.where(use, v, np.nan)
    with np.errstate(all="ignore"):
        back = np.nanmin(np.where(use.any(1)[:, None], big, 0.0), 1)
        above = np.where(use, v - back[:, None], 0.0)
        total = above.sum(1)
        c = (above * w).sum(1) / total
        s = np.sqrt(np.maximum((above * (w - c[:, None]) ** 2).sum(1) / total, 1e-6))
        step = np.median(np.diff(w, axis=1), axis=1) if w.shape[1] > 1 else np.ones(len(w))
        p = np.stack([total * np.abs(step), c, s, back], 1)
        for _ in range(rounds):
            u = (w - p[:, 1:2]) / p[:, 2:3]
            shape = np.exp(-0.5 * u * u) / (p[:, 2:3] * np.sqrt(2 * np.pi))
            model = p[:, 0:1] * shape + p[:, 3:4]
            jac = np.stack([shape, p[:, 0:1] * shape * u / p[:, 2:3], p[:, 0:1] * shape * (u * u - 1) / p[:, 2:3], np.ones_like(w)], 2) * use[:, :, None]
            r = np.where(use, v - model, 0.0)
            a = np.einsum("nij,nik->njk", jac, jac)
            a += np.eye(4) * (np.trace(a, axis1=1, axis2=2)[:, None, None] * 1e-9 + 1e-12)
            good = np.isfinite(a).all((1, 2)) & np.isfinite(r).all(1)
            d = np.zeros_like(p)
            if good.any():
                d[good] = np.linalg.solve(a[good], np.einsum("nij,ni->nj", jac[good], r[good])[:, :, None])[:, :, 0]
            d[:, 1] = np.clip(d[:, 1], -np.abs(p[:, 2]), np.abs(p[:, 2]))
            d[:, 2] = np.clip(d[:, 2], -0.5 * np.abs(p[:, 2]), 0.5 * np.abs(p[:, 2]))
            p = p + d
    return p


def smooth_fwhm(fits: DataFrame, keys: Sequence[str], half: int, fiber: str = "fiberid", line: str = "line") -> DataFrame:
    """Widths of each line smoothed across fibres by a running median."""
    return running_median(fits, [*keys, line], fiber, half, "fwhm")


def wavelength_solution(fits: DataFrame, keys: Sequence[str], degree: int, centre: str = "centre", wave: str = "line_wave", scale: float = 1.0, lsf_degree: int | None = None, fwhm: str = "fwhm") -> DataFrame:
    """From fitted line centres (in pixels) each fibre's polynomial wavelength(pixel / scale), the number of lines, and the scatter, median, least and greatest of the residuals; null with degree + 1 lines or fewer.

    With lsf_degree, lsf_coeffs is a polynomial through the lines' widths in wavelength: fwhm times the solution's slope.
    """
    from ..functions.scalars import eval_poly

    good = fits.where(F.col(centre).isNotNull())
    fit = polyfit(good, keys, centre, wave, degree, least=degree + 2, width=scale)
    u = F.col(centre) / scale
    r = good.join(fit.select(*keys, "coeffs"), list(keys)).where("coeffs is not null").withColumn("__r", F.col(wave) - eval_poly(F.col("coeffs"), u))
    out = fit.join(r.groupBy(*keys).agg(F.stddev_pop("__r").alias("sigma"), median(F.col("__r")).alias("median"), F.min("__r").alias("min"), F.max("__r").alias("max")), list(keys), "left")
    if lsf_degree is None:
        return out
    slope = F.transform(F.slice("coeffs", F.lit(2), F.lit(degree)), lambda c, i: c * (i + 1) / scale)
    widths = r.withColumn("__w", F.col(fwhm) * F.abs(eval_poly(slope, u)))
    return out.join(polyfit(widths, keys, centre, "__w", lsf_degree, width=scale).select(*keys, F.col("coeffs").alias("lsf_coeffs")), list(keys), "left")


def _convolved(w: np.ndarray, v: np.ndarray, s: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A spectrum at one resolution: for each distance of samples one step over all of them."""
    sigma = np.sqrt(np.maximum(target**2 - s**2, 0)) / FWHM
    lo, hi = np.searchsorted(w, w - 5 * sigma), np.searchsorted(w, w + 5 * sigma, "right")
    at, n = np.arange(len(w)), len(w)
    total, norm = np.zeros(n), np.zeros(n)
    safe = np.where(sigma > 0, sigma, 1.0)
    for d in range(int((lo - at).min(initial=0)), int((hi - 1 - at).max(initial=0)) + 1):
        j = np.clip(at + d, 0, n - 1)
        k = np.where((at + d >= lo) & (at + d < hi), np.exp(-0.5 * ((w[j] - w) / safe) ** 2), 0.0)
        total += k * v[j]
        norm += k
    return np.where(sigma > 0, total / np.where(norm > 0, norm, 1.0), v)


def match_lsf(spectra: DataFrame, target: float | Callable[[Column], Column], wave: str = "wave", flux: str = "flux", lsf: str = "lsf") -> DataFrame:
    """Spectra in array columns convolved to one resolution (FWHM): at each sample a Gaussian of sqrt(target^2 - lsf^2), cut at 5 sigmas and normalised inside the spectrum.

    target is a number, or a caller's function of the wavelength (a column expression). Rows pass one by one; a sample whose own resolution is no better than the target stays as it is.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [_convolved(*(np.asarray(a, float) for a in row)).tolist() for row in zip(pdf[wave], pdf[flux], pdf[lsf], pdf["__target"])]
            yield pdf.assign(**{flux: done}).drop(columns="__target")

    at = F.transform(wave, lambda x: (target(x) if callable(target) else F.lit(target)).cast("double"))
    return spectra.withColumn("__target", at).mapInPandas(run, spectra.schema)


def find_continuum(samples: DataFrame, keys: Sequence[str], order: str, half: int = 10, ratio: float = 0.9, rounds: int = 3, value: str = "flux") -> DataFrame:
    """Continuum of each fibre: samples under ratio times (or over its inverse) the running median are taken out and bridged, again and again; `line` marks them."""
    out = samples.withColumn("continuum", F.col(value)).withColumn("line", F.lit(False))
    for _ in range(rounds):
        m = running_median(out, keys, order, half, "continuum", "__m")
        q = F.try_divide("continuum", "__m")
        m = m.withColumn("line", F.col("line") | F.coalesce((q < ratio) | (q > 1 / ratio), F.lit(False)))
        out = fill_gaps(m, keys, order, "continuum", bad=F.col("line")).drop("__m", "filled")
    return out


def subtract_continuum(samples: DataFrame, keys: Sequence[str], order: str, value: str = "flux", **how) -> DataFrame:
    return find_continuum(samples, keys, order, value=value, **how).withColumn(value, F.col(value) - F.col("continuum"))


def super_sky(samples: DataFrame, keys: Sequence[str], step: float, wave: str = "wave", value: str = "flux", error: str = "error", fiber: str | None = None, mask: str | None = None, n: float = 3.0) -> DataFrame:
    """Sky of all sky fibres of an exposure on a fine grid: inverse-variance means in bins (keys, cw, cv, error).

    Where the column of fibres is named, those whose mean (masked samples included) is n biweight scales off are left out
    first; where the mask is named, masked samples are.
    """
    if fiber is not None:
        samples = samples.join(reject_fiber_outliers(samples, keys, fiber, n, value).select(*keys, fiber), [*keys, fiber], "left_semi")
    if mask is not None:
        samples = samples.where(~F.col(mask))
    cell = F.floor(F.col(wave) / step)
    w = F.when(F.col(error) > 0, 1 / (F.col(error) * F.col(error)))
    g = samples.groupBy(*keys, cell.alias("__c")).agg(F.try_divide(F.sum(w * F.col(wave)), F.sum(w)).alias("cw"), F.try_divide(F.sum(w * F.col(value)), F.sum(w)).alias("cv"), F.try_divide(F.lit(1.0), F.sqrt(F.sum(w))).alias("error"))
    return g.drop("__c").where("cw is not null")


def evaluate_sky(samples: DataFrame, sky: DataFrame, keys: Sequence[str], wave: str = "wave", out: str = "sky") -> DataFrame:
    """The fine-grid sky at each sample's own wavelength."""
    return interp_onto(samples, sky, wave, out, on=keys)


def star_sensitivity(stars: DataFrame, reference: DataFrame, keys: Sequence[str], order: str, half: int, wave: str = "wave", airmass: str = "airmass", ext: str = "ext", exptime: str = "exptime") -> DataFrame:
    """Reference over observed spectra: (flux - sky) / t with line regions (`line`) bridged, corrected for extinction, the ratio smoothed by a running median."""
    s = stars.withColumn("__o", (F.col("flux") - F.coalesce("sky", F.lit(0.0))) / F.col(exptime) * extinction_factor(F.col(ext), F.col(airmass)))
    s = fill_gaps(s, keys, order, "__o", bad=F.col("line")).drop("filled")
    r = interp_onto(s, reference, wave, "__ref", on=keys)
    r = r.withColumn("sens", F.try_divide(F.col("__ref"), F.when(F.col("__o") > 0, F.col("__o"))))
    return running_median(r, keys, order, half, "sens").drop("__o", "__ref")


def fit_continuum(samples: DataFrame, keys: Sequence[str], x: str, y: str, degree: int = 4, threshold: float = 0.5, rounds: int = 4, centre: float = 0.0, width: float = 1.0) -> DataFrame:
    """Smooth continuum by a polynomial: samples below threshold times the fit are clipped, again and again; `continuum` and `clipped`."""
    from ..functions.scalars import eval_poly

    out = samples.withColumn("clipped", F.lit(False))
    for _ in range(rounds):
        fit = polyfit(out.where(~F.col("clipped")), keys, x, y, degree, centre=centre, width=width).select(*keys, "coeffs")
        c = eval_poly(F.col("coeffs"), (F.col(x) - centre) / width)
        out = out.drop("continuum").join(fit, list(keys), "left").withColumn("continuum", c).withColumn("clipped", F.col("clipped") | F.coalesce(F.col(y) < threshold * F.col("continuum"), F.lit(False))).drop("coeffs")
    return out
