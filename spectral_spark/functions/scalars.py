"""Column functions: dates, names, geometry, units, photometry, polynomials, bit flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACEHOLDER = -999.9


def rounded(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


# --- dates and names


def to_mjd(ts: Column) -> Column:
    """Days since 1858-11-17 of a timestamp, with fractions."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(86400e6) + F.lit(40587.0)


def to_sjd(ts: Column) -> Column:
    """Night number: the day number with 0.4 more, so that a night has one."""
    return to_mjd(ts) + F.lit(0.4)


def sjd_to_mjd(sjd: Column) -> Column:
    return sjd - F.lit(0.4)


def night_from_path(path: Column, night: Column, pattern: str = r"/(\d{5})/") -> Column:
    """The night that a path's folder names, else the one given."""
    return F.coalesce(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).cast("int"), night.cast("int"))


def tile_group(tile: Column) -> Column:
    """'0011XX' of tile 11111; '*XX' of '*'."""
    return F.when(tile.cast("string") == "*", "*XX").otherwise(F.concat(F.lpad(F.floor(F.try_to_number(tile.cast("string"), F.lit("999999999999")).cast("double") / 1000).cast("long").cast("string"), 4, "0"), F.lit("XX")))


def parse_frame_name(name: Column) -> Column:
    """struct(hemi, camera, spec, expnum) of '<stem>-<hemi>-<camera>-<exposure>'."""
    part = F.split(F.regexp_replace(name, r"\.[a-z.]+$", ""), "-")
    camera = F.get(part, F.lit(2))
    return F.struct(F.get(part, F.lit(1)).alias("hemi"), camera.alias("camera"), F.concat(F.lit("sp"), F.substring(camera, 2, 1)).alias("spec"), F.get(part, F.lit(3)).cast("long").alias("expnum"))


def parse_product_path(path: Column) -> Column:
    """struct(tile, night, expnum) of '.../<tile>/<night>/<name>-<exposure>.<ending>'."""
    p = r"([^/]+)/(\d+)/[^/]*-0*(\d+)\.[^/]*$"
    return F.struct(*[F.nullif(F.regexp_extract(path, p, k), F.lit("")).alias(n) for k, n in ((1, "tile"), (2, "night"), (3, "expnum"))])


def trailing_number(label: Column) -> Column:
    return F.nullif(F.regexp_extract(label, r"(\d+)$", 1), F.lit("")).cast("int")


# --- geometry


def angular_distance(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in degrees; 0 where rounding lifts the cosine to 1 or more."""
    d1, d2 = F.radians(dec1), F.radians(dec2)
    cos = F.sin(d1) * F.sin(d2) + F.cos(d1) * F.cos(d2) * F.cos(F.radians(ra1 - ra2))
    return F.when(cos >= 1, 0.0).otherwise(F.degrees(F.acos(F.greatest(cos, F.lit(-1.0)))))


def fiber_sky_position(x: Column, y: Column, ra: Column, dec: Column, pa: Column, scale: float = 112.36748321030637) -> Column:
    """struct(ra, dec) in degrees of a plate offset in mm by the tangent projection; scale is in arcseconds a mm."""
    a = F.radians(pa)
    u, v = F.radians(x * scale / 3600.0), F.radians(y * scale / 3600.0)
    xi, eta = u * F.cos(a) - v * F.sin(a), u * F.sin(a) + v * F.cos(a)
    d0 = F.radians(dec)
    down = F.cos(d0) - eta * F.sin(d0)
    return F.struct((ra + F.degrees(F.atan2(xi, down))).alias("ra"), F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.sqrt(xi * xi + down * down))).alias("dec"))


def offset_positions(x: Column, y: Column, dx: float, dy: float) -> tuple[Column, Column]:
    return x + dx, y + dy


def rotate_positions(x: Column, y: Column, degrees: float, x0: float = 0.0, y0: float = 0.0) -> tuple[Column, Column]:
    a = F.radians(F.lit(degrees))
    u, v = x - x0, y - y0
    return u * F.cos(a) - v * F.sin(a) + x0, u * F.sin(a) + v * F.cos(a) + y0


def scale_positions(x: Column, y: Column, factor: float) -> tuple[Column, Column]:
    return x * factor, y * factor


# --- detector units


def convert_unit(value: Column, gain: Column, exptime: Column, old: str, new: str) -> Column:
    """Between adu, electron and electron/s."""
    to_electron = {"adu": value * gain, "electron": value, "electron/s": value * exptime}
    e = to_electron[old]
    return {"adu": e / gain, "electron": e, "electron/s": e / exptime}[new]


def nonlinear_gain(value: Column, a1: Column, a2: Column, a3: Column, nominal: Column) -> Column:
    """1 / (a1 + a2 a3 value^(a3 - 1)); the nominal gain where that is undefined."""
    g = F.try_divide(F.lit(1.0), a1 + a2 * a3 * F.pow(value, a3 - 1))
    return F.coalesce(F.when(~F.isnan(g), g), nominal)


def poisson_error(value: Column, readnoise: Column) -> Column:
    return F.when(value > 0, F.sqrt(value + readnoise * readnoise)).otherwise(readnoise)


def ivar_to_error(ivar: Column) -> Column:
    return F.when((ivar > 0) & (ivar < float("inf")), 1.0 / F.sqrt(ivar))


def error_to_ivar(error: Column) -> Column:
    return F.when((error > 0) & (error < float("inf")), 1.0 / (error * error)).otherwise(0.0)


# --- photometry

#: Centres and width of the channels' Gaussian bands, in Angstrom.
BAND_CENTRES, BAND_WIDTH = {"b": 4500.0, "r": 6500.0, "z": 8500.0}, 250.0
#: Speed of light in Angstrom a second, zero point of AB magnitudes.
LIGHT, AB_ZERO = 2.99792458e18, 48.6
#: Powers of (1/um - 1.82), constant first, of the galactic extinction curve.
CURVE_A = (1.0, 0.17699, -0.50447, -0.02427, 0.72085, 0.01979, -0.77530, 0.32999)
CURVE_B = (0.0, 1.41338, 2.28305, 1.07233, -5.38434, -0.62251, 5.30260, -2.09002)
#: Distance from the fibre's centre in arcseconds, and loss there in magnitudes.
RADIUS_LOSS = ((0.0, 0.0), (4.0, 0.0), (6.0, 0.05), (8.0, 0.12), (10.0, 0.15), (12.0, 0.2), (14.0, 0.2), (16.0, 0.2))


def horner(x: Column, coeffs) -> Column:
    """Polynomial with literal coefficients, constant first."""
    return reduce(lambda a, c: a * x + F.lit(float(c)), list(coeffs)[-2::-1], F.lit(float(coeffs[-1])))


def gaussian_band(channel: Column, wave: Column) -> Column:
    centre = reduce(lambda a, e: F.when(channel == e[0], F.lit(e[1])).otherwise(a), BAND_CENTRES.items(), F.lit(None).cast("double"))
    return F.exp(F.lit(-0.5) * ((wave - centre) / BAND_WIDTH) * ((wave - centre) / BAND_WIDTH))


def galactic_extinction(wave: Column, rv: Column) -> Column:
    """A(wave) / A(V) in the optical."""
    y = F.lit(10000.0) / wave - 1.82
    return horner(y, CURVE_A) + horner(y, CURVE_B) / rv


def deredden(flux: Column, wave: Column, av: Column, rv: Column) -> Column:
    return flux * F.pow(F.lit(10.0), F.lit(0.4) * av * galactic_extinction(wave, rv))


def extinction_factor(ext: Column, airmass: Column) -> Column:
    return F.pow(F.lit(10.0), F.lit(0.4) * ext * airmass)


def telluric_transmission(trans: Column, water: Column, pwv: Column, zenith: Column | None = None, airmass: Column | None = None) -> Column:
    """Transmission at another water vapour (mm) and airmass, from that at 2.5 mm in the zenith."""
    if airmass is None:
        c = F.cos(F.radians(zenith))
        airmass = 1.0 / (c + 0.025 * F.exp(-11.0 * c))
    return F.pow(trans, (1.0 + (pwv / 2.5 - 1.0) * water) * airmass)


def flux_to_mag(flux: Column) -> Column:
    return F.when(flux > 0, F.lit(-2.5) * F.log10(flux) - AB_ZERO)


def mag_to_flux(mag: Column) -> Column:
    return F.pow(F.lit(10.0), F.lit(-0.4) * (mag + AB_ZERO))


def piecewise(x: Column, points) -> Column:
    """Linear interpolation through literal (x, y) points, the end values beyond them."""
    out = F.lit(float(points[-1][1]))
    for (a, u), (b, v) in list(zip(points, points[1:]))[::-1]:
        out = F.when(x <= b, F.lit(float(u)) + (x - a) / F.lit(float(b - a)) * F.lit(float(v - u))).otherwise(out)
    return F.when(x <= points[0][0], F.lit(float(points[0][1]))).otherwise(out)


def radius_factor(distance: Column) -> Column:
    """Share of a star's light that a fibre at this distance gets, by interpolation between the fixed points."""
    return piecewise(distance, [(d, 10 ** (-0.4 * m)) for d, m in RADIUS_LOSS])


# --- arrays, polynomials, groups, flags


def eval_poly(coeffs: Column, x: Column) -> Column:
    """Value at x of an array of coefficients, constant first."""
    return F.aggregate(F.reverse(coeffs), F.lit(0.0), lambda a, c: a * x + c.cast("double"))


def poly_samples(coeffs: Column, first: int, last: int) -> Column:
    """The polynomial at every pixel of a range."""
    return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda x: eval_poly(coeffs, x.cast("double")))


def shift_wave(coeffs: Column, offset: Column) -> Column:
    """Coefficients with the offset taken from the constant."""
    return F.transform(coeffs, lambda c, i: F.when(i == 0, c.cast("double") - offset).otherwise(c.cast("double")))


def log_grid(low: float, high: float, n: int) -> Column:
    """n wavelengths in equal steps of the logarithm."""
    from math import log

    a, step = log(low), (log(high) - log(low)) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.exp(F.lit(a) + i * F.lit(step)))


def placeholder(c: Column, value: float = PLACEHOLDER) -> Column:
    """The value in place of null, NaN and infinities."""
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(value)).otherwise(c)


def fiber_group(fiber: Column, by: str, fibers: int = 648, blocks: int = 18) -> Column:
    """Group of a fibre, from 1: 'spec' (of so many fibres), 'quad' (half of one), 'block' (one of so many in a spectrograph)."""
    size = {"spec": fibers, "quad": fibers // 2, "block": fibers // blocks}[by]
    return F.floor((fiber - 1) / size).cast("int") + 1


def flag_has(mask: Column, bit: int) -> Column:
    return mask.bitwiseAND(F.lit(1 << bit)) != 0


def flag_add(mask: Column, bits: int) -> Column:
    return mask.bitwiseOR(F.lit(bits))


def flag_set_exclusive(mask: Column, bit: int, group: int) -> Column:
    """Set one bit of a group of which only one may be set."""
    return mask.bitwiseAND(F.lit(~group)).bitwiseOR(F.lit(1 << bit))


def flag_names(mask: Column, names) -> Column:
    """Names of the bits that are set, comma-joined."""
    return F.concat_ws(",", *[F.when(flag_has(mask, k), n) for k, n in enumerate(names)])
