"""Workloads, streams and choices on small made cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectral_spark.operators import spectra
from spectral_spark.plans import workflows
from spectral_spark.streaming import ingest

FOUND = "mjd int, camera string, expnum long, note string"


def run_stream(spark, rows, folder, schema, start):
    """Add a file of rows to a folder and run a stream over it from its checkpoint."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    start(spark.readStream.schema(schema).parquet(folder)).awaitTermination()


def test_new_frames_over_restarts(spark, tmp_path):
    rng = random.Random(1)
    frames = [(60_000 + e % 3, c, e, "x") for e in range(20) for c in ("b1", "r1")]
    keys = ["mjd", "camera", "expnum"]
    sink, src = f"{tmp_path}/store", f"{tmp_path}/in"
    for _ in range(4):  # files repeat frames of others and of themselves, in any order
        some = rng.sample(frames, 25)
        run_stream(spark, some + some[:7], src, FOUND, lambda s: ingest.stream_new_frames(s, sink, f"{tmp_path}/c", keys))
    run_stream(spark, frames + [(60_000, "b1", 0, "later note")], src, FOUND, lambda s: ingest.stream_new_frames(s, sink, f"{tmp_path}/c", keys))
    got = spark.read.schema(FOUND).parquet(sink).collect()
    assert sorted((r.mjd, r.camera, r.expnum) for r in got) == sorted(f[:3] for f in frames) and {r.note for r in got} == {"x"}
    # a checkpoint that was lost: all files are read again, and the store stays
    ingest.stream_new_frames(spark.readStream.schema(FOUND).parquet(src), sink, f"{tmp_path}/other", keys).awaitTermination()
    assert spark.read.schema(FOUND).parquet(sink).count() == len(frames)
    with pytest.raises(ValueError):
        ingest.stream_new_frames(spark.readStream.schema(FOUND).parquet(src), sink, "x", ["camera"], "mjd")


def test_new_frames_by_event_time(spark, tmp_path):
    schema = "mjd int, camera string, expnum long, at timestamp"
    rows = spark.sql("select cast(60000 + id % 2 as int) mjd, 'b1' camera, id expnum, timestamp'2024-01-01' + make_interval(0,0,0,0,id) at from range(30)")
    rows.unionByName(rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    ingest.stream_new_frames(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/s", f"{tmp_path}/c", ["mjd", "camera", "expnum"], time="at").awaitTermination()
    assert spark.read.schema(schema).parquet(f"{tmp_path}/s").count() == 30


def test_stages_over_restarts(spark, tmp_path):
    rng = random.Random(2)
    schema = "part int, camera string, expnum long, bits long"
    updates = [(e % 2, c, e, 1 << rng.randrange(6)) for e in range(8) for c in "br" for _ in range(4)]
    rng.shuffle(updates)
    for i in range(0, len(updates), 20):
        run_stream(spark, updates[i : i + 20] + updates[:3], f"{tmp_path}/in", schema, lambda s: ingest.stream_stages(s, f"{tmp_path}/store", f"{tmp_path}/c"))
    want = {}
    for _, c, e, b in updates:
        want[c, e] = want.get((c, e), 0) | b
    assert {(r.camera, r.expnum): r.bits for r in spark.read.schema(schema).parquet(f"{tmp_path}/store").collect()} == want


def test_choice_of_calibration(spark):
    df = spark.sql("select * from values (1e-14D, 9, 1e-14D, 1e-14D), (1e-14D, 9, 0D, 1e-14D), (1e-14D, 3, double('nan'), 1e-14D), (0D, 9, null, 0D), (-1e-14D, 9, null, 5D), (null, 9, -1D, null) as t(std, stars, mod, sci)")
    assert [r[0] for r in df.select(spectra.choose_calibration(*map(F.col, ("std", "stars", "mod", "sci")))).collect()] == ["MOD", "STD", "SCI", "NONE", "NONE", "NONE"]


def test_choice_of_sensitivity(spark):
    good, zero, none, high, negative = 1e-14, 0.0, float("nan"), 1e-9, -1e-15
    nights = {
        "plain": ({"STD": good, "MOD": good, "SCI": good}, "STD", "MOD"), "no models": ({"STD": good, "MOD": zero, "SCI": good}, "STD", "SCI"), "nan": ({"STD": none, "MOD": none, "SCI": good}, "SCI", "SCI"),
        "negative": ({"STD": negative, "MOD": good, "SCI": good}, "SCI", "MOD"), "high standards": ({"STD": high, "MOD": good, "SCI": good}, "SCI", "MOD"), "high field": ({"STD": good, "MOD": zero, "SCI": high}, "STD", "STD"),
        "high models": ({"STD": good, "MOD": high, "SCI": good}, "STD", "NONE"), "all bad": ({"STD": zero, "MOD": none, "SCI": zero}, "NONE", "NONE"), "none": ({"STD": none}, "NONE", "NONE"),
    }
    rows = [(n, s, k, star, v * (1 + 0.01 * star)) for n, (by, _, _) in nights.items() for s, v in by.items() for k in range(3) for star in range(9)]
    rows += [("few", s, k, star, good) for s in ("STD", "MOD") for k in range(3) for star in range(7)] + [("few", "SCI", k, 1, good) for k in range(3)]
    curves = spark.createDataFrame(rows, "night string, source string, k int, star int, sens double")
    for asked, place in (("STD", 1), ("MOD", 2)):
        choice, curve = spectra.choose_sensitivity(curves, ["night"], asked)
        got = {r.night: r.method for r in choice.collect()}
        assert got == {n: x[place] for n, x in nights.items()} | {"few": "SCI"}
        assert {r.night for r in curve.select("night").distinct().collect()} == {n for n, m in got.items() if m != "NONE"}
    assert {r.method for r in spectra.choose_sensitivity(curves, ["night"], "NONE")[0].collect()} == {"NONE"}


def test_telluric_factor_by_telescope(spark):
    rows = [(1, "Sci", 0, 100.0), (2, "SkyE", 0, 100.0), (3, "SkyW", 0, 100.0)]
    df = spark.createDataFrame(rows, "fiberid int, telescope string, k int, flux double").withColumns({"error": F.lit(1.0), "sky": F.lit(10.0), "wave": F.lit(5000.0), "exptime": F.lit(2.0), "std_exptime": F.lit(None).cast("double"), "am": F.lit(1.0)})
    sens = spark.createDataFrame([(0, 3.0)], "k int, sens double")
    flat = spark.createDataFrame([(0.0, 0.0), (9e3, 0.0)], "cw double, cv double")
    tell = spark.createDataFrame([("Sci", 0, 0.5), ("SkyE", 0, 0.75)], "telescope string, k int, trans double")
    out = spectra.apply_fluxcal(df, sens, flat, ["k"], {"Sci": "am", "SkyE": "am", "SkyW": "am"}, telluric=tell, also=["sky"])
    assert {r.fiberid: (r.flux, r.error, r.sky) for r in out.collect()} == {1: (300.0, 3.0, 30.0), 2: (200.0, 2.0, 20.0), 3: (150.0, 1.5, 15.0)}


def test_twilights_give_the_throughput_back(spark):
    """Planted: fibre throughputs, a gradient for each exposure, two spectrographs, one standard lit for each exposure."""
    rng = np.random.default_rng(3)
    fibers = [(i, float(rng.uniform(-9, 9)), float(rng.uniform(-9, 9)), "Spec" if i % 10 == 9 else "Sci", 1 + i % 2) for i in range(60)]
    through = {f[0]: float(rng.uniform(0.8, 1.2)) for f in fibers}
    through = {i: v / np.median([x for x in through.values()]) for i, v in through.items()}
    factor = {1: 1.1, 2: 0.9}
    standards = [f[0] for f in fibers if f[3] == "Spec"]
    samples = []
    for e in range(6):
        a, b = rng.uniform(-0.02, 0.02, 2)
        for i, x, y, tel, sp in fibers:
            lit = tel == "Sci" or i == standards[e]
            for k in range(12):
                flux = 1000 * (2 + e) * (1 + a * x + b * y) * factor[sp] * (through[i] if tel == "Sci" else 1.0) * (1 if lit else 0.01)
                samples.append((e, i, k, float(flux), 1.0, False))
    frames = spark.createDataFrame([(e, f"S{e}", "GOOD") for e in range(6)] + [(9, "S9", "BAD")], "expnum int, calibfib string, qaqual string")
    df = spark.createDataFrame(samples, "expnum int, fiberid int, k int, flux double, error double, mask boolean")
    fib = spark.createDataFrame(fibers, "fiberid int, x double, y double, telescope string, spectrographid int")
    flat, factors, fit = workflows.twilight_flats(frames, df, fib, 5.0, 8.0)
    got = {(r.fiberid, r.k): (r.flux, r.n) for r in flat.collect()}
    sci = [f[0] for f in fibers if f[3] == "Sci"]
    ratio = np.array([got[i, 5][0] / through[i] for i in sci])
    assert np.std(ratio) / np.mean(ratio) < 0.03
    assert all(got[i, 5][1] == 1 for i in standards) and all(got[i, 5][1] == 6 for i in sci)
    means = {r.key: r.value for r in factors.collect()}
    assert means["1"] / means["2"] == pytest.approx(1.1 / 0.9, rel=0.05) and fit.count() == 6


def test_science_frames_are_read_once(spark, sf_dir):
    """Masters, lamp, frames and trace start from one stored stack."""
    from spectral_spark.queries import QUERIES

    assert "lineitem" not in QUERIES["w_reduce_science"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
