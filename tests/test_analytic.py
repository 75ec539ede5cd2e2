"""Small cases with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectral_spark.functions import robust, scalars
from spectral_spark.operators import extraction, filters, fits, joins, sets, spectra, stack, windows
from spectral_spark.sources import catalog
from spectral_spark.streaming import ingest

CAMERAS = ["b1", "b2", "b3", "r1", "r2", "r3", "z1", "z2", "z3"]


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(e, c, f"sp{c[1]}", 61234, "object", 900.0, f"raw-s-{c}-{e:08d}") for e in (6817, 6818, 6819) for c in CAMERAS]
    return spark.createDataFrame(rows, "expnum long, camera string, spec string, mjd int, imagetyp string, exptime double, name string")


@pytest.mark.parametrize("spec,want", [(6817, {6817}), ("6817", {6817}), ([6817, 6819], {6817, 6819}), ("6817-6818", {6817, 6818}), ("-6818", {6817, 6818}), ("6818-", {6818, 6819}), ("6817,6819", {6817, 6819})])
def test_exposure_ranges(frames, spec, want):
    assert {r.expnum for r in filters.filter_expnum(frames, spec).collect()} == want


@pytest.mark.parametrize("bad", ["", "-", "a-b", "1-2-3"])
def test_bad_ranges(frames, bad):
    with pytest.raises(ValueError):
        filters.filter_expnum(frames, bad)


def test_nights_and_names(spark):
    df = spark.sql("select timestamp '2023-06-19 22:52:00.981' as ts")
    r = df.select(scalars.to_mjd(F.col("ts")).alias("m"), scalars.to_sjd(F.col("ts")).alias("s")).first()
    assert int(r.m) == 60114 and int(r.s) == 60115
    names = spark.createDataFrame([("11111",), ("1055360",), ("*",)], "t string").select(scalars.tile_group(F.col("t")).alias("g")).collect()
    assert [x.g for x in names] == ["0011XX", "1055XX", "*XX"]
    p = spark.createDataFrame([("/x/1054XX/1054755/60297/product-00009532.fits", 60113)], "p string, n int")
    r = p.select(scalars.parse_product_path(F.col("p")).alias("a"), scalars.night_from_path(F.lit("/data/60112/f"), F.col("n")).alias("n"), scalars.night_from_path(F.lit("none"), F.col("n")).alias("m")).first()
    assert tuple(r.a) == ("1054755", "60297", "9532") and (r.n, r.m) == (60112, 60113)


def test_header_fixes(spark):
    fixes = [(1, "raw-*-*-00007334", "SKYENAME", "grid125"), (2, "raw-*-b*-00007334", "SKYWNAME", "WHAM_south_08"), (3, "raw-*-*2-0000732[4-6]", "SKYENAME", "grid103"), (4, "raw-*-*2-0000732[4-6]", "SKYWNAME", "WHAM_south_02"), (5, "raw-*-r1-00007329", "SKYENAME", "grid125"), (6, "raw-*-r1-00007329", "SKYWNAME", "WHAM_south_02")]
    cases = {("b1", 7334): ("WHAM_south_08", "grid125"), ("r1", 7334): ("old", "grid125"), ("z1", 7330): ("old", "old"), ("z2", 7324): ("WHAM_south_02", "grid103"), ("b2", 7326): ("WHAM_south_02", "grid103"), ("r3", 7326): ("old", "old"), ("r1", 7329): ("WHAM_south_02", "grid125"), ("z2", 7329): ("old", "old")}
    f = spark.createDataFrame([(c, e, f"raw-s-{c}-{e:08d}", "old", "old") for c, e in cases], "camera string, expnum int, name string, SKYWNAME string, SKYENAME string")
    out = joins.apply_header_fixes(f, spark.createDataFrame(fixes, "rule_no int, fileroot string, keyword string, value string"), "name", ["SKYWNAME", "SKYENAME"])
    assert {(r.camera, r.expnum): (r.SKYWNAME, r.SKYENAME) for r in out.collect()} == cases


def test_metadata_and_summary(spark, frames):
    h = spark.createDataFrame([({"TILE_ID": "-999", "MJD": "61234", "EXPOSURE": "6817", "CCD": "b1", "EXPTIME": "900.0", "IMAGETYP": "object", "NEON": "ON", "OBSTIME": "2023-10-18T07:56:23.289", "OBSERVAT": "LCO", "QUARTZ": "T"},), ({},)], "header map<string,string>")
    a, b = catalog.extract_metadata(h).collect()
    assert (a.hemi, a.tileid, a.tilegrp, a.mjd, a.rmjd, a.expnum, a.neon, a.quartz, a.argon, a.qaqual, a.stage) == ("s", 11111, "0011XX", 60235, 61234, 6817, True, True, False, "GOOD", 1)
    assert (b.hemi, b.tileid, b.expnum, b.calibfib) == ("n", 11111, None, "None")
    assert catalog.extract_metadata(h).schema.names == catalog.FRAME_SCHEMA.names
    base = spark.createDataFrame([(9532, 1), (9540, 1)], "expnum int, v int")
    out = catalog.upsert_keep_last(base, spark.createDataFrame([(9532, 2)], "expnum int, v int"), ["expnum"])
    assert sorted(map(tuple, out.collect())) == [(9532, 2), (9540, 1)]
    one = catalog.build_summary(frames.withColumn("tileid", F.lit(1)), frames.select("expnum").distinct().withColumn("flag", F.lit(None).cast("string")), spark.createDataFrame([(60255,)], "epoch int")).collect()
    assert len(one) == 3 and {r.epoch for r in one} == {60255} and {r.flag for r in one} == {"None"}


def test_files(spark, tmp_path, frames):
    (tmp_path / "curve.txt").write_text("# wave value\n4000 0.5\n5000 1.0\n")
    assert [tuple(r) for r in catalog.read_curve(spark, str(tmp_path / "curve.txt"), ["w", "v"]).collect()] == [(4000.0, 0.5), (5000.0, 1.0)]
    pos = spark.createDataFrame([(1.0, 2.0, 1, "SKY"), (3.0, 4.5, 0, "OBJ")], catalog.POSITIONS)
    catalog.write_positions(pos, str(tmp_path / "pos"))
    assert sorted(map(tuple, catalog.read_positions(spark, str(tmp_path / "pos")).collect())) == sorted(map(tuple, pos.collect()))
    store = str(tmp_path / "frames")
    catalog.write_frames(frames, store)
    again = catalog.read_frames(spark, store, 61234, frames.schema)
    assert again.count() == 27 and "PartitionFilters: [isnotnull(mjd" in again._jdf.queryExecution().toString()
    catalog.export_summary(frames, str(tmp_path / "summary"))
    assert spark.read.parquet(str(tmp_path / "summary")).count() == 27


def test_overscan_and_leak(spark):
    rng = np.random.default_rng(0)
    rows = [("q", y, x, float(980 + rng.normal(0, 1) + (60000 if x == 7 else 0))) for y in range(60) for x in range(20)]
    df = spark.createDataFrame(rows, "quad string, y int, x int, value double")
    level = stack.overscan_profile(df, ["quad"]).toPandas()["level"]
    assert abs(level - 980).max() < 2
    masked = {r.x for r in robust.zscore_mask(df, ["quad", "y"], ["quad", "x"], "value", 3.0).where("outlier").collect()}
    assert masked == {7}
    flat = stack.subtract_overscan(df, stack.overscan_profile(df, ["quad"], model="constant"), ["quad"])
    assert abs(flat.where("x = 1").toPandas()["value"].mean()) < 1


def test_row_shifts(spark):
    rng = np.random.default_rng(1)
    image = [(y, x, float(rng.integers(1000))) for y in range(40) for x in range(16)]
    df = spark.createDataFrame([(1, *r) for r in image], "f int, y int, x int, value double")
    prof = windows.expand_shifts(df, spark.createDataFrame([(1, 15, 2)], "f int, y int, shift int"), ["f"])
    got = {r.y: r["shift"] for r in prof.collect()}
    assert got == {y: 2 if y >= 15 else 0 for y in range(40)}
    moved = windows.shift_rows(df, prof.withColumn("shift", -F.col("shift")), ["f"], 16)
    found = {r.y: r["shift"] for r in spectra.best_shift(moved.withColumnRenamed("value", "flux"), df.withColumnRenamed("value", "flux"), ["f", "y"], "x", 3).collect()}
    assert sum(found[y] == (-2 if y >= 15 else 0) for y in range(40)) >= 38
    assert sorted(map(tuple, windows.shift_rows(moved, prof, ["f"], 16).select("f", "y", "x", "value").collect())) == sorted((1, *r) for r in image)
    assert [tuple(r) for r in windows.compress_shifts(prof, ["f"]).select("y", "shift").collect()] == [(15, 2)]


def polynomial(w):
    return 0.1 * w**2 + 0.01 * w + 0.001


def test_sky(spark):
    rows = []
    for k, (kind, tel, off) in enumerate([("SKY", "SkyE", 0.0), ("SKY", "SkyW", 1.333), ("science", "Sci", 2.667), ("standard", "Spec", 4.0)]):
        for i in range(400):
            w = 5500 + 0.5 * i + off
            rows.append((k, kind, tel, i, w, polynomial(w), polynomial(w) ** 0.5))
    df = spark.createDataFrame(rows, "fiberid int, targettype string, telescope string, k int, wave double, flux double, error double")
    for tel, n in (("east", 1), ("west", 1), ("both", 2)):
        sky, rest = filters.select_sky(df, tel)
        assert (sky.select("fiberid").distinct().count(), rest.select("fiberid").distinct().count()) == (n, 4 - n)
    sky, _ = filters.select_sky(df.withColumn("exp", F.lit(1)), "both")
    fine = extraction.super_sky(sky, ["exp"], 0.1)
    assert fine.count() == 800
    got = extraction.evaluate_sky(sky, fine, ["exp"]).toPandas()
    assert np.allclose(got["sky"], got["flux"], rtol=1e-5)


def test_continuum_with_dips(spark):
    dips = [300, 1000, *range(1500, 1550, 5)]
    rows = [(1, i, float(3000 + i), (1000**2 - (3000 + i - 4000) ** 2) * (0.1 if i in dips else 1.0)) for i in range(2001)]
    df = spark.createDataFrame(rows, "fiberid int, pix int, wave double, flux double")
    out = extraction.fit_continuum(df, ["fiberid"], "wave", "flux", 4, 0.5, centre=4000.0, width=1000.0).toPandas().sort_values("pix")
    inner = out[(out.pix > 5) & (out.pix < 1995)]
    assert sorted(inner[inner.clipped].pix) == dips
    assert abs(inner.continuum - (1000**2 - (inner.wave - 4000) ** 2)).max() < 1
    lines = extraction.find_continuum(df.where("pix between 100 and 1900"), ["fiberid"], "pix", 12, 0.9).where("line").toPandas()
    assert set(dips) <= set(lines.pix)


def biweight(x):
    m = np.median(x)
    d = np.median(np.abs(x - m))
    if d == 0:
        return m, 0.0
    u, t = (x - m) / (6 * d), (x - m) / (9 * d)
    a, b = np.abs(u) < 1, np.abs(t) < 1
    loc = m + ((x - m) * (1 - u**2) ** 2)[a].sum() / ((1 - u**2) ** 2)[a].sum()
    scale = np.sqrt(len(x) * ((x - m) ** 2 * (1 - t**2) ** 4)[b].sum()) / abs(((1 - t**2) * (1 - 5 * t**2))[b].sum())
    return loc, scale


def test_biweight_against_numpy(spark):
    rng = np.random.default_rng(2)
    groups = {1: rng.normal(5, 2, 101), 2: np.r_[rng.normal(0, 1, 50), [1e6, -1e6]], 3: np.ones(7), 4: np.array([3.0])}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [(1, None), (2, float("nan"))]
    for r in robust.biweight_stats(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect():
        assert np.allclose((r.location, r.scale), biweight(groups[r.g])) and r.n == len(groups[r.g])


def test_rebin_and_rectify_against_numpy(spark):
    rng = np.random.default_rng(3)
    w = np.cumsum(rng.uniform(0.5, 2.0, 80))
    f = rng.uniform(1, 5, 80)
    df = spark.createDataFrame([(1, i, float(w[i]), float(f[i]), 1.0, False) for i in range(80)], "g int, i int, wave double, flux double, error double, mask boolean")
    got = {r.bin: r.flux for r in windows.rebin_conserving(df, ["g"], "i", -5.0, 1.5, 200).collect()}
    assert np.isclose(sum(got.values()), f.sum())
    edges = np.r_[w[0] - (w[1] - w[0]) / 2, (w[1:] + w[:-1]) / 2, w[-1] + (w[-1] - w[-2]) / 2]
    cumulative = np.interp(-5.0 + 1.5 * np.arange(201), edges, np.r_[0, np.cumsum(f)])
    assert np.allclose([got.get(b, 0.0) for b in range(200)], np.diff(cumulative))
    grid = {r.k: r.flux for r in windows.rectify(df, ["g"], "wave", 2.0, 0.7, 300).collect()}
    for k, v in grid.items():
        assert np.isclose(v, np.interp(2.0 + 0.7 * k, w, f))
    assert len(grid) == sum(w[0] <= 2.0 + 0.7 * k < w[-1] for k in range(300))


def test_extraction_recovers_fluxes(spark):
    centres, sigma, flux = np.array([6.2, 13.7, 20.1]), 1.4, np.array([1000.0, 250.0, 4000.0])
    y = np.arange(28)
    p = extraction._profile(y.astype(float), centres, np.full(3, sigma))
    pix = [("c", x, int(i), float((p[i] * flux * (x + 1)).sum()), 1.0, bool(i == 13 and x == 2)) for x in range(3) for i in y]
    tr = [("c", x, k, float(centres[k]), sigma) for x in range(3) for k in range(3)]
    out = extraction.extract_optimal(spark.createDataFrame(pix, "camera string, x int, y int, value double, error double, mask boolean"), spark.createDataFrame(tr, "camera string, x int, fiberid int, centre double, sigma double"), ["camera"], reach=20).toPandas()
    assert np.allclose(out["flux"], flux[out["fiberid"]] * (out["x"] + 1)) and not out["mask"].any()


def test_line_fits_and_wavelengths(spark):
    rng = np.random.default_rng(4)
    truth, rows = {}, []
    for f in range(3):
        for n, c in enumerate((20.0, 50.0, 90.0, 130.0, 160.0)):
            truth[f, f"l{n}"] = (500 + 100 * n, c + 0.3 * f + rng.uniform(-0.4, 0.4), 1.5 + 0.1 * n)
        for x in range(180):
            v = 10.0 + sum(a * np.exp(-0.5 * ((x - c) / s) ** 2) / (s * np.sqrt(2 * np.pi)) for (g, _), (a, c, s) in truth.items() if g == f)
            rows.append((f, x, float(x), float(v), x == 51 and f == 1))
    df = spark.createDataFrame(rows, "fiberid int, k int, wave double, flux double, mask boolean")
    lines = spark.createDataFrame([(f"l{n}", c) for n, c in enumerate((20.0, 50.0, 90.0, 130.0, 160.0))], "line string, line_wave double")
    got = extraction.fit_lines(df, lines, ["fiberid"], 7.0)
    for r in got.collect():
        a, c, s = truth[r.fiberid, r.line]
        assert np.allclose((r.flux, r.centre, r.fwhm, r.background), (a, c, s * extraction.FWHM, 10.0), rtol=1e-3)
    sol = extraction.wavelength_solution(got, ["fiberid"], 2, scale=100.0).collect()
    assert all(r.n == 5 and r.sigma < 0.5 and len(r.coeffs) == 3 for r in sol)
    assert all(r.coeffs is None for r in extraction.wavelength_solution(got.where("line < 'l3'"), ["fiberid"], 2).collect())


def test_resolution_matching_keeps_flux(spark):
    w = np.arange(0, 200.0)
    f = np.exp(-0.5 * ((w - 100) / (3 / extraction.FWHM)) ** 2)
    df = spark.createDataFrame([(w.tolist(), f.tolist(), [3.0] * 200)], "wave array<double>, flux array<double>, lsf array<double>")
    v = np.array(extraction.match_lsf(df, 7.0).first().flux)
    m = (v * w).sum() / v.sum()
    assert abs(np.sqrt((v * (w - m) ** 2).sum() / v.sum()) * extraction.FWHM - 7.0) < 0.05 and np.isclose(v.sum(), f.sum(), rtol=1e-6)


def test_polynomials_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(x), float(1 + 2 * x - 3 * x**2 + 0.5 * x**3 + rng.normal(0, 0.01) + (50 if g == 2 and i == 7 else 0))) for g in (1, 2) for i, x in enumerate(np.linspace(-1, 1, 60))]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    for r in fits.polyfit(df, ["g"], "x", "y", 3).collect():
        x, y = np.array([(a, b) for g, a, b in rows if g == r.g]).T
        assert np.allclose(r.coeffs, np.polyfit(x, y, 3)[::-1])
    for r in fits.polyfit_clipped(df, ["g"], "x", "y", 3).collect():
        assert np.allclose(r.coeffs, [1, 2, -3, 0.5], atol=0.05)
    assert fits.polyfit(df.limit(2), ["g"], "x", "y", 3).first().coeffs is None


def test_gradient_is_removed(spark):
    rng = np.random.default_rng(6)
    rows = [(e, g, float(x), float(y), float((100 * (1 + g)) * (1 + 0.02 * x - 0.01 * y))) for e in (1, 2) for g in (0, 1) for x, y in rng.uniform(-5, 5, (50, 2))]
    df = spark.createDataFrame(rows, "e int, g int, x double, y double, flux double")
    out = fits.remove_gradient(df, fits.fit_gradient(df, ["e"], group="g"), ["e"]).toPandas()
    assert (out.groupby(["e", "g"])["flux"].std() / out.groupby(["e", "g"])["flux"].mean()).max() < 1e-2


def test_stream_upserts_and_repeats(spark, tmp_path):
    src, sink, mark = (str(tmp_path / x) for x in ("in", "store", "mark"))
    schema = "mjd int, expnum long, v int"
    spark.createDataFrame([(1, 9532, 1), (1, 9533, 1), (2, 9540, 1)], schema).write.parquet(src)
    run = lambda: ingest.ingest_stream(spark.readStream.schema(schema).parquet(src), sink, mark, ["mjd", "expnum"], ["v"], "mjd").awaitTermination()
    run()
    spark.createDataFrame([(1, 9532, 2), (3, 9550, 1)], schema).write.mode("append").parquet(src)
    run()
    run()
    got = sorted((r.mjd, r.expnum, r.v) for r in spark.read.schema(schema).parquet(sink).collect())
    assert got == [(1, 9532, 2), (1, 9533, 1), (2, 9540, 1), (3, 9550, 1)]


def test_new_and_staged_frames(spark, frames):
    seen = frames.where("expnum < 6819")
    assert {r.expnum for r in ingest.new_frames(frames, seen, ["expnum", "camera"]).collect()} == {6819}
    up = spark.createDataFrame([("b1", 6817, 4), ("b1", 6817, 8)], "camera string, expnum long, bits long")
    out = ingest.update_stage(frames.withColumn("stage", F.lit(1).cast("long")), up)
    assert {(r.camera, r.expnum, r.stage) for r in out.where("stage > 1").collect()} == {("b1", 6817, 13)}


def test_clipped_mean_and_mosaics(spark):
    df = spark.createDataFrame([("c", 0, 0, f, 10.0 if f < 20 else 1000.0, 1.0, False) for f in range(21)], "camera string, y int, x int, frame int, value double, error double, mask boolean")
    r = stack.stack_clipped(df).first()
    assert (r.value, r.n) == (10.0, 20)
    assert stack.replicate(df.limit(1), 3).count() == 9
    parts = sets.split_parts(df.withColumn("x", F.col("frame")), 4, 21, "x")
    assert {r.x for r in sets.join_parts(parts, 4, 21, "x").collect()} == set(range(21))
    left = sets.left_over(spark.createDataFrame([("a",), ("a",), ("b",)], "l string"), spark.createDataFrame([("a",)], "l string"), "l")
    assert sorted(r.l for r in left.collect()) == ["a", "b"]


def test_nearest_master_and_epochs_with_ties(spark):
    t = spark.createDataFrame([("b", 10), ("b", 15), ("r", 1), ("b", 2)], "camera string, mjd int")
    m = spark.createDataFrame([("b", 5), ("b", 15), ("b", 15)], "camera string, master_mjd int")
    assert sorted((r.camera, r.mjd, r.master_mjd) for r in joins.match_nearest(t, m, ["camera"]).fillna(-1).collect()) == [("b", 2, 5), ("b", 10, 5), ("b", 15, 15), ("r", 1, -1)]
    e = joins.match_latest(t, spark.createDataFrame([(5,), (12,)], "epoch int"))
    assert sorted((r.mjd, r.epoch) for r in e.fillna(-1).collect()) == [(1, -1), (2, -1), (10, 5), (15, 12)]


def test_super_sky_leaves_out_outlying_fibers_and_masked_samples(spark):
    rows = [(1, f, float(k), 10.0 + f / 100 + (500.0 if f == 9 else 0.0) + (1.0 if (f, k) == (3, 2) else 0.0), 1.0, (f, k) == (3, 2)) for f in range(10) for k in range(40)]
    sky = spark.createDataFrame(rows, "exp int, fiberid int, wave double, flux double, error double, mask boolean")
    got = {r.cw: r.cv for r in extraction.super_sky(sky, ["exp"], 1.0, fiber="fiberid", mask="mask", n=5.0).collect()}
    want = {float(k): 10 + np.mean([f / 100 for f in range(9) if (f, k) != (3, 2)]) for k in range(40)}
    assert got == pytest.approx(want)
