"""The three workloads as compositions of operators."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.robust import median
from ..functions.scalars import eval_poly
from ..operators import extraction, filters, fits, joins, spectra, stack, windows
from ..shared import stored


def matched_stack(frames: DataFrame, samples: DataFrame, master_kind: str, kind: str = "imagetyp") -> DataFrame:
    """Frames of a camera with the night of their nearest master, and the median stack of the samples of all that share it."""
    masters = frames.where(F.col(kind) == master_kind).select("camera", F.col("mjd").alias("master_mjd"))
    matched = joins.match_nearest(frames.select("expnum", "camera", "mjd"), masters, ["camera"])
    j = samples.join(matched.select("expnum", "camera", "master_mjd"), "expnum")
    good = F.when(~F.col("mask"), F.col("flux"))
    return j.groupBy("camera", "master_mjd", "k").agg(median(good).alias("flux"), F.count_if(~F.col("mask")).alias("n"), F.every("mask").alias("mask"))


class Masters(NamedTuple):
    """Master frames (camera, y, x, value, mask)."""

    bias: DataFrame
    dark: DataFrame
    flat: DataFrame


def extract_frames(pixels: DataFrame, masters: Masters, trace: DataFrame, keys: Sequence[str], aperture: int = 3, gain: Column | float = 1.0, exptime: Column | float = 1.0, dark_time: float = 1.0) -> DataFrame:
    """Detrended and extracted spectra: (keys, fiberid, x, flux, error, mask)."""
    clean = joins.detrend(pixels, *masters, gain=gain, exptime=exptime, dark_time=dark_time)
    return extraction.extract_aperture(clean, trace, aperture, keys)


def reduce_science(pixels: DataFrame, masters: Masters, trace: DataFrame, fiberflat: DataFrame, wave: Column, grid: tuple[float, float, int], fibers: DataFrame, exposures: DataFrame, sens: DataFrame, extinction: DataFrame, exposure: str = "frame", channel: str = "camera", aperture: int = 3, gain: float = 1.0, dark_time: float = 1.0) -> DataFrame:
    """Science and standard fibres of all exposures, calibrated: (exposure, fiberid, k, flux, error, mask).

    pixels are detrended and extracted along the trace, divided by the fibre flat (channel, fiberid, x), brought from each
    fibre's own wavelengths (an expression of channel, fiberid and x) to one grid (start, step, points), and the channels
    joined. fibers has (fiberid, telescope, std_exptime), exposures (exposure, weight_e, weight_w, exptime, airmass): the
    means of the fibres of SkyE and SkyW, blended by the weights, are taken off the others, which are then flux-calibrated
    by sens (k, sens) and an extinction curve (cw, cv).
    """
    start, step, n = grid
    times = joins.small(exposures)
    spectra_ = extract_frames(pixels.join(times.select(exposure, "exptime"), exposure), masters, trace, [exposure, channel], aperture, gain, F.col("exptime"), dark_time)
    flat = joins.apply_fiberflat(spectra_, fiberflat, [channel, "fiberid", "x"])
    rows = windows.rectify(flat.withColumn("wave", wave), [exposure, channel, "fiberid"], "x", start, step, n)
    # both skies and the science fibres read the joined channels
    whole = stored(spectra.join_channels(rows, [exposure, "fiberid", "k"], channel).drop("channels").join(joins.small(fibers), "fiberid"), "whole")
    sky = lambda side: spectra.collapse_fibers(whole.where(F.col("telescope") == side), [exposure, "k"])
    blend = spectra.weight_skies(sky("SkyE"), sky("SkyW"), times.select(exposure, "weight_e", "weight_w"), [exposure], [exposure, "k"])
    science = spectra.subtract_sky(whole.where(F.col("telescope").isin("Sci", "Spec")), blend, [exposure, "k"])
    science = science.join(times.select(exposure, "exptime", "airmass"), exposure).withColumn("wave", F.lit(start) + F.col("k") * step)
    return spectra.apply_fluxcal(science, sens, extinction, ["k"], {"Sci": "airmass", "Spec": "airmass"}).select(exposure, "fiberid", "k", "flux", "error", "mask")


class Calibrations(NamedTuple):
    """What a night's frames are reduced with."""

    masters: Masters
    #: (exposure, channel, fiberid, x, centre), and for each (channel, fiberid) the coefficients of wavelength and resolution (wave, lsf).
    trace: DataFrame
    waves: DataFrame
    #: (channel, fiberid, x, flux), (line_wave) of sky lines.
    fiberflat: DataFrame
    lines: DataFrame
    #: (k, sens), (cw, cv) in magnitudes, (telescope, k, trans).
    sens: DataFrame
    extinction: DataFrame
    telluric: DataFrame


def native_spectra(pixels: DataFrame, overscan: Column, cal: Calibrations, exposures: DataFrame, exposure: str = "frame", channel: str = "camera", columns: int = 4086, level: float = 65536.0, edge: int = 3, stat: str = "biweight", aperture: int = 3, gain: float = 1.0, dark_time: float = 1.0, half: float = 4.0, snr: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """(spectra, saturation) of all fibres on their own wavelengths: (exposure, channel, fiberid, x, wave, lsf, flux, error, mask).

    The overscan's level of each row comes off and the overscan is cut away; saturated pixels and edges are masked; frames
    are detrended and extracted, given wavelengths and resolution from their coefficients, divided by the fibre flat, and
    their wavelengths moved by the sky lines' offset of each fibre. The spectra are stored, as skies and resampling read them.
    """
    key = [exposure, channel]
    profile = stack.overscan_profile(pixels.where(overscan), key, "y", stat)
    level_off = stack.subtract_overscan(pixels.where(~overscan), profile, key)
    clean, share = filters.mask_saturated(level_off, key, columns, level, edge=edge)
    extracted = extract_frames(clean.join(joins.small(exposures.select(exposure, "exptime")), exposure), cal.masters, cal.trace, key, aperture, gain, F.col("exptime"), dark_time)
    x = F.col("x").cast("double")
    placed = extracted.join(joins.small(cal.waves.withColumnsRenamed({"wave": "__wave", "lsf": "__lsf"})), [channel, "fiberid"]).withColumns({"wave": eval_poly(F.col("__wave"), x), "lsf": eval_poly(F.col("__lsf"), x)}).drop("__wave", "__lsf")
    flat = stored(joins.apply_fiberflat(placed, cal.fiberflat, [channel, "fiberid", "x"]).select(*key, "fiberid", "x", "wave", "lsf", "flux", "error", "mask"), "flat")
    offsets = spectra.wave_offsets(flat.where(~F.col("mask")), cal.lines, key, half=half, snr=snr)
    moved = flat.join(offsets, [*key, "fiberid"], "left").withColumn("wave", F.col("wave") - F.coalesce("offset", F.lit(0.0))).drop("offset")
    return stored(moved, "native"), share


def with_skies(native: DataFrame, fibers: DataFrame, exposures: DataFrame, step: float, exposure: str = "frame", channel: str = "camera", n: float = 3.0) -> DataFrame:
    """Spectra with the sky of both telescopes at each sample's own wavelength, blended by the exposure's weights: sky, sky_error.

    A telescope's sky is made from its fibres on their own wavelengths, outlying fibres and masked samples left out. Where
    one telescope has no sky, the other's serves; where neither has, it is 0.
    """
    key = [exposure, channel]
    out = native.join(joins.small(fibers), "fiberid").join(joins.small(exposures.select(exposure, "weight_e", "weight_w")), exposure)
    for name, side in (("east", "SkyE"), ("west", "SkyW")):
        sky = extraction.super_sky(out.where(F.col("telescope") == side), key, step, fiber="fiberid", mask="mask", n=n)
        out = joins.interp_columns(out, sky, "wave", {f"__{name}": "cv", f"__{name}_error": "error"}, key)
    a, b = F.col("weight_e") * F.col("__east_error"), F.col("weight_w") * F.col("__west_error")
    both = F.col("weight_e") * F.col("__east") + F.col("weight_w") * F.col("__west")
    return out.withColumns({"sky": F.coalesce(both, "__east", "__west", F.lit(0.0)), "sky_error": F.coalesce(F.sqrt(a * a + b * b), "__east_error", "__west_error", F.lit(0.0))}).drop("__east", "__west", "__east_error", "__west_error", "weight_e", "weight_w")


def reduce_exposures(pixels: DataFrame, overscan: Column, cal: Calibrations, fibers: DataFrame, exposures: DataFrame, grid: tuple[float, float, int], step: float, exposure: str = "frame", channel: str = "camera", **how) -> tuple[DataFrame, DataFrame]:
    """(spectra, quality): raw frames to sky-subtracted, flux-calibrated spectra of all fibres on one grid, and each exposure's summary.

    spectra: (exposure, fiberid, telescope, k, flux, error, sky, sky_error, mask). After native_spectra and with_skies, fluxes
    and skies become densities, are resampled to the grid (start, step, points), flux-calibrated through each telescope's
    airmass (exposures: airmass, airmass_e, airmass_w) and telluric transmission, and the channels joined; then the sky
    comes off. quality: mean, median and standard deviation of the good fluxes, and the greatest saturated share of a frame.
    fibers has (fiberid, telescope, std_exptime), exposures (exposure, exptime, weight_e, weight_w, airmasses). how goes to
    native_spectra.
    """
    start, width, n = grid
    native, share = native_spectra(pixels, overscan, cal, exposures, exposure, channel, **how)
    skies = with_skies(native, fibers.select("fiberid", "telescope"), exposures, step, exposure, channel)
    dense = windows.gradient(skies, [exposure, channel, "fiberid"], "x", "wave", "__g")
    dense = dense.withColumns({c: F.try_divide(F.col(c), F.col("__g")) for c in ("flux", "error", "sky", "sky_error")})
    rows = windows.rectify(dense, [exposure, channel, "fiberid", "telescope"], "x", start, width, n, more=[("sky", "sky_error")])
    seen = rows.join(joins.small(fibers.select("fiberid", "std_exptime")), "fiberid").join(joins.small(exposures.drop("weight_e", "weight_w")), exposure).withColumn("wave", F.lit(start) + F.col("k") * width)
    masses = {"Sci": "airmass", "Spec": "airmass", "SkyE": "airmass_e", "SkyW": "airmass_w"}
    done = spectra.apply_fluxcal(seen, cal.sens, cal.extinction, ["k"], masses, telluric=cal.telluric, also=["sky", "sky_error"])
    keys = [exposure, "fiberid", "telescope", "k"]
    done = stored(done.select(*keys, channel, "flux", "error", "sky", "sky_error", "mask"), "channels")
    flux = spectra.join_channels(done, keys, channel).drop("channels")
    sky = spectra.join_channels(done, keys, channel, "sky", "sky_error").drop("channels", "mask")
    whole = flux.join(sky, keys).withColumns({"flux": F.col("flux") - F.col("sky"), "error": F.sqrt(F.col("error") * F.col("error") + F.col("sky_error") * F.col("sky_error"))})
    whole = stored(whole.select(*keys, "flux", "error", "sky", "sky_error", "mask"), "whole")
    worst = share.groupBy(exposure).agg(F.max("share").alias("saturated"))
    quality = spectra.summarize_with_placeholder(whole, [exposure]).join(worst, exposure, "left")
    return whole, quality


def master_calibrations(frames: DataFrame, pixels: DataFrame, kinds: Sequence[str], number: str = "frame", kind: str = "imagetyp", quality: str = "qaqual") -> DataFrame:
    """Masters (kind, camera, y, x, value, error, mask, n) of each kind and camera from the good frames that the catalogue lists."""
    out = None
    for name in kinds:
        chosen = frames.where((F.col(kind) == name) & (F.col(quality) == "GOOD")).select("camera", number).distinct()
        master = stack.make_master(pixels.join(joins.small(chosen), ["camera", number], "left_semi"), name, frame=number).withColumn("kind", F.lit(name))
        out = master if out is None else out.unionByName(master)
    return out


def arc_wavelengths(pixels: DataFrame, trace: DataFrame, lines: DataFrame, degree: int, lsf_degree: int, aperture: int = 3, half: float = 4.0, smooth: int = 1, scale: float = 1.0, channel: str = "camera", frame: str = "frame") -> DataFrame:
    """Wavelength and resolution of each fibre (channel, fiberid, coeffs, n, sigma, median, min, max, lsf_coeffs) from arc frames.

    Arcs are stacked to a master of each channel, extracted along the trace (channel, x, fiberid, centre), each line (line,
    line_wave, pixel near which it lies) fitted by a Gaussian, widths smoothed across fibres, and polynomials fitted.
    """
    master = stored(stack.make_master(pixels, "arc", channel, frame), "arc")
    spectra_ = extraction.extract_aperture(master.drop("n"), trace, aperture, [channel]).withColumn("wave", F.col("x").cast("double"))
    near = lines.select("line", F.col("pixel").cast("double").alias("line_wave"))
    found = extraction.fit_lines(spectra_, near, [channel, "fiberid"], half).drop("line_wave").join(joins.small(lines.select("line", "line_wave")), "line")
    return extraction.wavelength_solution(extraction.smooth_fwhm(found, [channel], smooth), [channel, "fiberid"], degree, scale=scale, lsf_degree=lsf_degree)


def twilight_flats(frames: DataFrame, samples: DataFrame, fibers: DataFrame, centre: float, width: float, exposure: str = "expnum", label: str = "calibfib", k: str = "k", number: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(flat, factors, gradients): the master fibre flat (fiberid, k, flux, n), each spectrograph's factor, and each exposure's gradient.

    The first good exposure of each standard is taken (number of them at most). In each, fluxes near a wavelength are fitted
    by a plane over the field (fibers: fiberid, x, y, telescope, spectrographid) times a factor for each spectrograph; the
    gradient is divided out and each fibre divided by the median fibre. Flats are combined by biweights over exposures, in
    which standards count only where they were exposed: the one of greatest flux over error of those off the rest.
    """
    chosen = windows.choose_sequence(frames.where(F.col("qaqual") == "GOOD"), label, number=exposure, n=number).select(exposure)
    s = stored(samples.join(joins.small(chosen), exposure, "left_semi").join(joins.small(fibers), "fiberid"), "twilights")
    level = spectra.coadd_window(s, [exposure, "fiberid"], k, centre, width, mask="mask").join(joins.small(fibers), "fiberid")
    fit = stored(fits.fit_gradient(level.where(F.col("telescope") != "Spec"), [exposure], value="coadd", group="spectrographid"), "gradients")
    plain = fits.remove_gradient(s, fit, [exposure], group="spectrographid")
    flat = spectra.fiberflat(plain, [exposure, k])
    snr = s.where((F.col("telescope") == "Spec") & ~F.col("mask")).groupBy(exposure, "fiberid").agg(median(F.try_divide("flux", "error")).alias("snr"))
    lit = spectra.exposed_standard(snr, [exposure], nsigma=0.0).select(exposure, "fiberid").withColumn("__lit", F.lit(True))
    known = flat.join(joins.small(lit), [exposure, "fiberid"], "left")
    dark = F.col("mask") | (F.col("telescope") == "Spec") & F.col("__lit").isNull()
    factors = fit.where("factors is not null").select(exposure, F.explode("factors").alias("key", "value"))
    return spectra.combine_flats(known, ["fiberid", k], dark), spectra.factor_means(factors), fit


def catalogue_summary(frames: DataFrame, epochs: DataFrame) -> DataFrame:
    """Frames of one night and class with their members, calibration epoch and nearest other exposure's distance."""
    ref = windows.dedupe_keep_first(joins.nearest_reference(frames, ["camera", "imagetyp"]), ["expnum"], "mjd")
    matched = joins.match_latest(ref, epochs)
    return matched.groupBy("camera", "imagetyp", "epoch").agg(F.count(F.lit(1)).alias("frames"), F.min(F.abs(F.col("reference") - F.col("expnum"))).alias("nearest"), F.countDistinct("mjd").alias("nights"))
