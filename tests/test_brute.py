"""Operators and queries without SQL against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectral_spark import views as V
from spectral_spark.functions import robust
from spectral_spark.operators import extraction, filters, fits, joins, sets, spectra, stack, windows
from spectral_spark.queries import QUERIES


def close(a, b, tolerance=1e-9):
    return np.allclose(np.asarray(a, float), np.asarray(b, float), rtol=tolerance, atol=tolerance, equal_nan=True)


# --- interpolation


def even(rng):
    return np.sort(rng.choice(np.arange(500), 60, replace=False)) * 1.5


def crowded(rng):
    return np.r_[np.linspace(5, 5.001, 200), 700.0]


@pytest.mark.parametrize("points,rows", [(even, 100_000), (even, 0), (crowded, 100_000), (lambda rng: np.array([7.0]), 100_000)])
@pytest.mark.parametrize("ranges", [5, 2_000])
def test_interpolation_of_one_curve(spark, monkeypatch, points, rows, ranges):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(joins, "RANGES", ranges)
    rng = np.random.default_rng(1)
    x = points(rng)
    y = rng.normal(size=len(x))
    w = np.r_[rng.uniform(-50, 800, 300), x, x[:3]]
    curve = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (2.0, None)], "cw double, cv double")
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)] + [(-1, None)], "id int, wave double")
    got = {r.id: r.curve for r in joins.interp_onto(df, curve).collect()}
    assert len(got) == len(w) + 1 and got.pop(-1) is None
    assert close([got[i] for i in range(len(w))], np.interp(w, x, y), 1e-7)
    assert all(r.curve is None for r in joins.interp_onto(df, curve.limit(0)).collect())


def test_interpolation_of_curves_by_key(spark):
    rng = np.random.default_rng(2)
    curves = {k: (np.sort(rng.uniform(0, 100, 20 + k)), rng.normal(size=20 + k)) for k in range(3)}
    waves = rng.uniform(-10, 110, 200)
    curve = spark.createDataFrame([(k, float(a), float(b)) for k, (x, y) in curves.items() for a, b in zip(x, y)], "g int, cw double, cv double")
    df = spark.createDataFrame([(k, float(w)) for k in range(4) for w in waves], "g int, wave double")
    for r in joins.interp_onto(df, curve, on=["g"]).collect():
        assert r.curve is None if r.g == 3 else close(r.curve, np.interp(r.wave, *curves[r.g]))


# --- ranges, stacks, fibres


def test_excluded_ranges_overlap_and_touch(spark):
    rng = np.random.default_rng(3)
    ranges = [(int(a), int(a + b)) for a, b in zip(rng.integers(0, 200, 25), rng.integers(-2, 12, 25))]
    df = spark.createDataFrame([(i,) for i in range(220)] * 2 + [(None,)], "mjd int")
    want = [i for i in range(220) if not any(a <= i <= b for a, b in ranges)]
    got = sorted((r.mjd for r in filters.exclude_ranges(df, spark.createDataFrame(ranges, "lo int, hi int")).collect()), key=str)
    assert got == sorted([*want, *want, None], key=str)
    halves = spark.createDataFrame([(1.5, 2.5)], "lo double, hi double")
    assert sorted(r.mjd for r in filters.exclude_ranges(df.where("mjd < 4").distinct(), halves).collect()) == [0, 1, 3]


def test_master_takes_all_frames(spark):
    df = spark.createDataFrame([("c", 0, 0, f, float(f), 1.0, False) for f in range(50)], "camera string, y int, x int, frame int, value double, error double, mask boolean")
    assert (r := stack.make_master(df, "dark").first()).n == 50 and r.value == 24.5
    assert stack.make_master(df, "dark", batch=30).first().n == 30


def test_equal_fibres_are_no_outliers(spark):
    df = spark.createDataFrame([(f, k, 5.0, 1.0, False) for f in range(6) for k in range(3)], "fiberid int, k int, flux double, error double, mask boolean").withColumn("g", F.lit(1))
    assert spectra.reject_fiber_outliers(df, ["g"]).count() == 6
    assert [r.n for r in spectra.master_sky(df, ["g"], clip=3.0).collect()] == [6] * 3


def test_single_channels_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, "b", 7.0, 2.0, True), (2, "b", 7.0, 2.0, True), (2, "r", 9.0, 1.0, False)], "k int, channel string, flux double, error double, mask boolean")
    got = {r.k: (r.flux, r.error, r.mask) for r in spectra.join_channels(df, ["k"]).collect()}
    assert got == {1: (7.0, 2.0, True), 2: (9.0, 1.0, False)}


@pytest.mark.parametrize("share", [0.0, 0.5, 0.75, 0.99, 1.0])
def test_quantiles_of_large_groups(spark, share):
    rng = np.random.default_rng(9)
    groups = {"a": rng.normal(size=501), "b": np.r_[rng.normal(size=400), 1e9], "c": np.full(30, 2.5), "d": np.array([7.0]), None: rng.integers(0, 5, 200).astype(float)}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("a", float("nan")), ("e", None)], "g string, v double")
    got = {r.g: r.q for r in robust.quantile(df, ["g"], "v", share, "q", 64).collect()}
    assert set(got) == set(groups) and all(close(got[g], np.quantile(v, share)) for g, v in groups.items())
    assert close(robust.quantile(df, [], "v", share, "q").first().q, np.quantile(np.concatenate(list(groups.values())), share))


# --- extraction


def dense(rows, value, weight, centre, sigma, reach):
    """All profiles at once in one dense least-squares problem."""
    from math import erf, sqrt

    p = np.array([[0.5 * (erf((y + 0.5 - c) / (s * sqrt(2))) - erf((y - 0.5 - c) / (s * sqrt(2)))) if abs(y - c) <= reach * s else 0.0 for c, s in zip(centre, sigma)] for y in rows])
    a = p * weight[:, None]
    norm = (a * a).sum(0)
    flux, error = np.full(len(centre), np.nan), np.full(len(centre), np.nan)
    ok = norm > 0
    if ok.any():
        flux[ok] = np.linalg.lstsq(a[:, ok].T @ a[:, ok], a[:, ok].T @ (value * weight), rcond=None)[0]
        error[ok] = 1 / np.sqrt(norm[ok])
    return flux, error


@pytest.mark.parametrize("spacing", [0.0, 3.0, 6.0, 20.0])
def test_profiles_in_runs_equal_the_dense_problem(spacing):
    rng = np.random.default_rng(4)
    centre = np.sort(10 + spacing * np.arange(25) + rng.uniform(-0.5, 0.5, 25))
    sigma = rng.uniform(0.8, 1.6, 25)
    rows = np.sort(rng.choice(np.arange(int(centre[-1]) + 12), int(centre[-1]) + 4, replace=False)).astype(float)
    value, weight = rng.normal(100, 20, len(rows)), np.where(rng.random(len(rows)) < 0.1, 0.0, rng.uniform(0.5, 2, len(rows)))
    flux, error = extraction.solve_profiles(rows, value, weight, centre, sigma, 4.0)
    want = dense(rows, value, weight, centre, sigma, 4.0)
    assert close(error, want[1], 1e-8) and (close(flux, want[0], 1e-6) or spacing == 0.0)


@pytest.mark.parametrize(("n", "gap", "height"), [(648, 6.2, 4080), (120, 1.5, 210), (40, 25.0, 1020), (2, 0.4, 20), (1, 1.0, 12)])
def test_banded_profiles(n, gap, height):
    """Fibres of uneven width that overlap throughout, in small groups and not at all, against dense least squares."""
    rng = np.random.default_rng(n)
    rows = np.arange(height, dtype=float)
    centre, sigma = np.sort(8 + gap * np.arange(n) + rng.uniform(-0.3, 0.3, n) * min(gap, 1)), rng.uniform(0.8, 2.2, n)
    shares = np.where(np.abs(rows[:, None] - centre) <= 5 * sigma, extraction._profile(rows, centre, sigma), 0.0)
    weight = rng.choice([0, 0.5, 1.0], height, p=[0.02, 0.5, 0.48])
    value = shares @ rng.uniform(100, 1000, n) + rng.normal(0, 1, height)
    flux, error = extraction.solve_profiles(rows, value, weight, centre, sigma, 5.0)
    m = shares * weight[:, None]
    assert np.allclose(flux, np.linalg.lstsq(m, value * weight, rcond=None)[0], rtol=1e-6, atol=1e-4) and np.allclose(error, 1 / np.sqrt((m * m).sum(0)))


def test_fibres_at_one_centre_share_their_flux():
    rows = np.arange(20.0)
    centre, sigma = np.array([9.0, 9.0]), np.array([1.5, 1.5])
    flux, _ = extraction.solve_profiles(rows, extraction._profile(rows, centre, sigma) @ np.array([10.0, 30.0]), np.ones(20), centre, sigma, 5.0)
    assert np.isclose(flux.sum(), 40)


def test_a_singular_run_does_not_make_the_column_dense(monkeypatch):
    """Two fibres at one centre among many: least squares see their run only, and the others' fluxes do not change."""
    sizes, real = [], np.linalg.lstsq
    monkeypatch.setattr(np.linalg, "lstsq", lambda a, *b, **k: sizes.append(len(a)) or real(a, *b, **k))
    rng = np.random.default_rng(11)
    centre = np.sort(np.r_[20.0 + 20 * np.arange(500), 20.0 + 20 * 250])
    rows, sigma = np.arange(10_040.0), np.full(501, 1.5)
    value, weight = rng.normal(100, 20, len(rows)), rng.choice([0.5, 1.0], len(rows))
    flux, _ = extraction.solve_profiles(rows, value, weight, centre, sigma, 5.0)
    alone, _ = extraction.solve_profiles(rows, value, weight, np.delete(centre, 251), sigma[1:], 5.0)
    assert max(sizes, default=0) <= 2
    assert np.allclose(np.delete(flux, [250, 251]), np.delete(alone, 250), rtol=1e-12) and np.allclose(flux[250:252], alone[250] / 2, rtol=1e-9)


def test_a_long_singular_run():
    """More fibres in one chain than are solved as one dense system, two of them at one centre."""
    rng = np.random.default_rng(12)
    n = 8 * extraction.DENSE + 100
    centre = np.sort(np.r_[20.0 + 6 * np.arange(n), 20.0 + 6 * (n // 2)])
    rows, sigma = np.arange(6.0 * n + 40), np.full(n + 1, 1.5)
    value, weight = rng.normal(100, 20, len(rows)), rng.choice([0.5, 1.0], len(rows))
    flux, error = extraction.solve_profiles(rows, value, weight, centre, sigma, 5.0)
    want = dense(rows, value, weight, centre, sigma, 5.0)
    assert np.allclose(flux, want[0], rtol=1e-6, atol=1e-5) and np.allclose(error, want[1])


def test_rendered_pixels_of_a_task_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(extraction, "RENDERED", 500)
    rows = [(x, f + 1.0, 10.0 * f + 4, 2.0) for x in range(5) for f in range(40)]
    out = extraction.render_profiles(spark.createDataFrame(rows, "x int, flux double, centre double, sigma double"), [], 6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and f", {-(-200 * 13 // 500)})" in plan
    got = {(r.x, r.y): r.model for r in out.collect()}
    y = np.arange(-2, 401)
    for x in range(5):
        want = sum(np.where(np.abs(y - c) <= 6, v * np.exp(-0.5 * ((y - c) / s) ** 2) / (s * np.sqrt(2 * np.pi)), 0.0) for a, v, c, s in rows if a == x)
        assert np.allclose([got[x, k] for k in y.tolist()], want)


def test_extract_optimal_on_the_tables(spark, sf_dir):
    got = {(r.camera, r.frame, r.x, r.fiberid): (r.flux, r.error) for r in QUERIES["k2_extract_optimal"](spark, sf_dir).collect()}
    pixels = V.stack(spark, sf_dir).toPandas()
    seen = 0
    for (c, f, x), g in pixels.groupby(["camera", "frame", "x"]):
        g = g.sort_values("y")
        fibers = np.unique(g["y"] // 10)
        w = np.where(g["mask"] | ~(g["error"] > 0), 0.0, 1 / g["error"].where(g["error"] > 0, 1.0))
        flux, error = dense(g["y"].to_numpy(float), g["value"].to_numpy(float), w, fibers * 10 + 4.0, np.full(len(fibers), 1.5), 5.0)
        for k, n in enumerate(fibers):
            a, b = got[c, f, x, n]
            seen += 1
            assert close(np.nan if a is None else a, flux[k], 2e-3) and close(np.nan if b is None else b, error[k], 2e-3)
    assert seen == len(got)


def test_bad_samples_near_the_core(spark):
    rows = [(f, float(x), float(50 * np.exp(-0.5 * ((x - 10) / 1.5) ** 2) + 2), f == 1 and x in (9, 11) or f == 2 and x == 11 or f == 3 and x in (3, 4)) for f in range(4) for x in range(20)]
    df = spark.createDataFrame(rows, "fiberid int, wave double, flux double, mask boolean")
    lines = spark.createDataFrame([("a", 10.0)], "line string, line_wave double")
    assert {r.fiberid: r.centre is None for r in extraction.fit_lines(df, lines, ["fiberid"], 8.0).collect()} == {0: False, 1: True, 2: False, 3: False}


def test_offsets_of_moved_fibres(spark):
    """Moved by more than a window's half, on a slope, one fibre too faint and one with a masked line."""
    rng = np.random.default_rng(10)
    rows, lines = [], [(f"l{n}", c) for n, c in enumerate((30.0, 60.0, 95.0))]
    for f in range(12):
        for x in range(130):
            v = 5 + 0.05 * x + sum((2 if f == 4 else 300) * np.exp(-0.5 * ((x - c - 2.7 - 0.02 * f) / 1.3) ** 2) for _, c in lines)
            rows.append(("a", f, float(x), float(v), 3.0 if f == 4 else 1.0, f == 7 and 58 <= x <= 66))
    rows += [("b", f, float(x), float(rng.normal(0, 1)), 1.0, False) for f in range(4) for x in range(130)]
    df = spark.createDataFrame(rows, "g string, fiberid int, wave double, flux double, error double, mask boolean")
    got = {(r.g, r.fiberid): (r.offset, r.measured) for r in extraction.fit_wave_offsets(df, spark.createDataFrame(lines, "line string, line_wave double"), ["g"], half=6.0, snr=60.0, smooth=0).collect()}
    assert len(got) == 16 and all(got["b", f] == (0.0, False) for f in range(4))
    for f in range(12):
        offset, measured = got["a", f]
        assert measured == (f not in (4, 7)) and abs(offset - 2.7 - 0.02 * f) < 0.02


def test_caller_chooses_the_resolution(spark):
    w = np.arange(0, 60.0)
    f = np.random.default_rng(5).normal(size=60)
    df = spark.createDataFrame([(w.tolist(), f.tolist(), [2.0] * 60)], "wave array<double>, flux array<double>, lsf array<double>")
    got = np.array(extraction.match_lsf(df, lambda x: F.when(x < 30, 6.0).otherwise(1.0)).first().flux)
    s = np.sqrt(36 - 4) / extraction.FWHM
    for i in range(60):
        near = np.abs(w - w[i]) <= 5 * s
        k = np.exp(-0.5 * ((w - w[i]) / s) ** 2) * near
        assert close(got[i], (k * f).sum() / k.sum() if i < 30 else f[i])


def test_continuum_is_taken_off(spark):
    df = spark.createDataFrame([(1, k, 100.0 + (900.0 if k == 15 else 0.0)) for k in range(30)], "fiberid int, k int, flux double")
    got = {r.k: r.flux for r in extraction.subtract_continuum(df, ["fiberid"], "k", half=5).collect()}
    assert got[15] == 900.0 and all(v == 0 for k, v in got.items() if k != 15)


# --- fits


def cells(spark, sf_dir, more=0.0):
    p = V.cells(spark, sf_dir).toPandas()
    return {f: (g["k"].to_numpy(float), g["flux"].to_numpy(float) + more) for f, g in p.sort_values("k").groupby("fiberid")}


def test_clipped_polynomials_on_the_tables(spark, sf_dir):
    data = cells(spark, sf_dir)
    for r in fits.polyfit_clipped(V.cells(spark, sf_dir), ["fiberid"], "k", "flux", 3, 2.5, centre=32.0, width=32.0).collect():  # as the query does, whose coefficients are rounded
        x, y = data[r.fiberid]
        u, keep = (x - 32) / 32, np.ones(len(x), bool)
        for _ in range(3):
            res = y - np.polyval(np.polyfit(u[keep], y[keep], 3), u)
            keep &= np.abs(res) <= 2.5 * res[keep].std()
        assert close(r.coeffs, np.polyfit(u[keep], y[keep], 3)[::-1], 1e-6) and r.n == keep.sum()


def test_smooth_continua_on_the_tables(spark, sf_dir):
    data = cells(spark, sf_dir, 20000)
    got = {(r.fiberid, r.k): (r.clipped, r.continuum) for r in QUERIES["k9_fit_continuum"](spark, sf_dir).collect()}
    for f, (x, y) in data.items():
        u, clipped = (x - 32) / 32, np.zeros(len(x), bool)
        for _ in range(4):
            c = np.polyval(np.polyfit(u[~clipped], y[~clipped], 4), u)
            clipped |= y < 0.9 * c
        assert [got[f, int(k)][0] for k in x] == clipped.tolist()
        assert close([got[f, int(k)][1] for k in x], c, 1e-6)


def test_surface_and_factors(spark):
    rng = np.random.default_rng(6)
    factor = {"a": 0.8, "b": 1.3, "c": 0.9}
    rows = [(e, g, float(x), float(y), float(v * (50 * e + 2 * x - 1.5 * y))) for e in (1, 2) for g, v in factor.items() for x, y in rng.uniform(-5, 5, (60, 2))]
    df = spark.createDataFrame([*rows, (3, "a", 0.0, 0.0, 1.0)], "e int, g string, x double, y double, flux double")
    for r in fits.fit_gradient(df, ["e"], group="g").collect():
        if r.e == 3:
            assert r.coeffs is None and r.factors is None
        else:
            assert close(r.coeffs, [50 * r.e, -1.5, 2.0], 1e-6) and close([r.factors[g] for g in "abc"], [0.8, 1.3, 0.9], 1e-6)
    flat = fits.remove_gradient(df, fits.fit_gradient(df, ["e"], group="g"), ["e"], group="g").toPandas()
    assert flat[flat.e < 3].groupby("e")["flux"].std().max() < 1e-6 and flat[flat.e == 3]["flux"].tolist() == [1.0]


def test_gradient_on_the_tables(spark, sf_dir):
    """Alternating least squares over the rows themselves."""
    got = {(r.k, r.fiberid): r.flux for r in QUERIES["d41_fit_gradient"](spark, sf_dir).collect()}
    fib = V.fibermap(spark, sf_dir).toPandas().set_index("fiberid")
    s = V.samples(spark, sf_dir).groupBy("k", "fiberid").agg(F.avg("flux").alias("flux")).toPandas()
    for k, g in s.groupby("k"):
        x, y, tel, z = (g["fiberid"] % 20).to_numpy(float), fib.loc[g["fiberid"], "ypmm"].to_numpy(float), fib.loc[g["fiberid"], "telescope"].to_numpy(), g["flux"].to_numpy()
        m = np.stack([np.ones_like(x), y, x], 1)
        f = dict.fromkeys(tel, 1.0)
        for _ in range(200):
            each = np.array([f[t] for t in tel])
            c = np.linalg.lstsq(m * each[:, None], z, rcond=None)[0]
            p = m @ c
            f = {t: (z[tel == t] @ p[tel == t]) / (p[tel == t] @ p[tel == t]) for t in f}
            mean = np.mean(list(f.values()))
            f = {t: v / mean for t, v in f.items()}
        each = np.array([f[t] for t in tel])
        c = np.linalg.lstsq(m * each[:, None], z, rcond=None)[0]
        model = (m @ c) * each
        assert close([got[k, i] for i in g["fiberid"]], z * model.mean() / model, 1e-4)


# --- shifts, matches, grids, cosmics


def test_shifts_and_stretches(spark):
    rng = np.random.default_rng(7)
    ref = np.convolve(rng.normal(size=80), np.ones(5), "same")
    obs = np.r_[np.zeros(4), np.interp(np.arange(76) / 1.05, np.arange(80), ref)]
    make = lambda v: spark.createDataFrame([(1, k, float(x)) for k, x in enumerate(v)], "g int, k int, flux double")
    r = spectra.best_shift(make(obs), make(ref), ["g"], "k", 8, stretches=(0.95, 1.0, 1.05), normalize=True).first()
    assert (r.shift, r.stretch) == (4, 1.05) and 0.9 < r.score <= 1.0
    assert spectra.best_shift(make(obs[:3]), make(ref).where("k > 70"), ["g"], "k", 5).count() == 0


def test_log_grids(spark):
    w = np.array([100.0, 103, 105, 111, 118, 130])
    v = np.array([1.0, 5, np.nan, 2, 8, 3])
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(w, v)] + [(2, 50.0, 1.0)], "g int, wave double, flux double")
    got = windows.linear_to_log(df, ["g"]).orderBy("k").collect()
    n = int(np.ceil((np.log(130) - np.log(100)) / np.diff(np.log(w)).min()))
    x = np.linspace(np.log(100), np.log(130), n)
    good = ~np.isnan(v)
    assert len(got) == n and close([r.log_wave for r in got], x) and close([r.flux for r in got], np.interp(x, np.log(w[good]), v[good]), 1e-7)
    back = windows.log_to_linear(df.where("g = 1"), windows.linear_to_log(df, ["g"]), ["g"], 0.01).orderBy("wave").collect()
    assert close([r.flux for r in back], np.interp(w, np.exp(x + 0.01), np.interp(x, np.log(w[good]), v[good])), 1e-6)


def test_cosmic_rays(spark):
    rng = np.random.default_rng(8)
    n = 24
    img = 100 + 20 * np.exp(-0.5 * ((np.arange(n)[None, :] - 12) / 3) ** 2) + rng.normal(0, 2, (n, n))
    for y, x in ((5, 7), (16, 20), (11, 3)):
        img[y, x] += 900
    df = spark.createDataFrame([("c", y, x, float(img[y, x])) for y in range(n) for x in range(n)], "camera string, y int, x int, value double")
    rows = windows.cosmic_rays(df, ["camera"], 5.0, 0.3, 3.0).collect()
    assert {(r.y, r.x) for r in rows if r.cosmic} == {(5, 7), (16, 20), (11, 3)}

    def squares(a, h):
        return np.array([[np.median(a[max(0, y - h) : y + h + 1, max(0, x - h) : x + h + 1]) for x in range(n)] for y in range(n)])

    def doubled(a):
        big = np.pad(np.kron(a, np.ones((2, 2))), 1, mode="edge")
        lap = np.maximum(0.25 * (4 * big[1:-1, 1:-1] - big[:-2, 1:-1] - big[2:, 1:-1] - big[1:-1, :-2] - big[1:-1, 2:]), 0)
        return lap.reshape(n, 2, n, 2).mean((1, 3)) * 4

    score = doubled(img) / (2 * np.sqrt(np.maximum(squares(img, 2), 0) + 9))
    score -= squares(score, 2)
    assert close([next(r.score for r in rows if (r.y, r.x) == (y, x)) for y in range(n) for x in (0, 7, 23)], [score[y, x] for y in range(n) for x in (0, 7, 23)], 1e-9)


# --- small ones


def test_small_operators(spark):
    df = spark.createDataFrame([(1, "a", 4.0, 2.0, True, False), (1, "b", 6.0, 1.0, False, False)], "e int, line string, flux double, error double, neon boolean, argon boolean")
    assert [(r.flux, r.error) for r in joins.arith_scalar(df, 2.0, "/").collect()] == [(2.0, 1.0), (3.0, 0.5)]
    assert tuple(stack.lamps_union(df, ["e"], ["neon", "argon"]).first()) == (1, True, False)
    assert tuple(spectra.pivot_fluxes(df, ["e"], ["a", "b", "c"]).first()) == (1, 4.0, 6.0, None)
    assert tuple(spark.createDataFrame([("[1:10, 3:7]",)], "s string").select(filters.section_struct(F.col("s")).alias("v")).first().v) == (0, 10, 2, 7)
    grid = sets.extend_grid(df.select("e", F.lit(1).alias("k")), spark.createDataFrame([(1,), (2,), (2,)], "k int"), ["e"], "k")
    assert sorted(r.k for r in grid.distinct().collect()) == [1, 2]
