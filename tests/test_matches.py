"""Quantiles, matches, medians, drifting cubes, alignments and rules against plain Python."""

import fnmatch
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spectral_spark.functions import robust
from spectral_spark.operators import joins, spectra, templates, windows
from spectral_spark.queries import joins as join_queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("share", [0, 0.003, 0.5, 0.75, 0.999, 1])
def test_quantile_of_skewed_groups(spark, share):
    rng = np.random.default_rng(1)
    bias = np.r_[rng.normal(1000, 3, 60_000), 65535.0]  # one hot pixel
    few = rng.integers(0, 9, 50_000).astype(float)
    small = np.array([1.0, 5.0, 2.0])
    rows = pd.DataFrame({"g": ["bias"] * len(bias) + ["few"] * len(few) + ["small"] * 3 + ["none"] * 2 + [None], "v": np.r_[bias, few, small, np.nan, np.nan, 4.0]})
    got = {r.g: r.quantile for r in robust.quantile(spark.createDataFrame(rows).repartition(4), ["g"], "v", share).collect()}
    assert set(got) == {"bias", "few", "small", None} and got[None] == 4.0
    for name, a in (("bias", bias), ("few", few), ("small", small)):
        assert got[name] == pytest.approx(np.quantile(a, share), abs=1e-9)


def test_no_task_gets_a_group(spark, monkeypatch):
    """What is counted by value between the sketch's bounds is a small share of a group."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"g": 1, "v": np.r_[rng.normal(1000, 3, 100_000), 65535.0]}))
    seen = []
    real = robust.stored
    monkeypatch.setattr(robust, "stored", lambda d, name: seen.append(real(d, name)) or seen[-1])
    robust.quantile(df, ["g"], "v", 0.5).collect()
    span = seen[0].first()
    inside = df.where(F.col("v").between(span["__low"], span["__high"])).count()
    assert inside < 0.01 * 100_000


def haversine(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((b - d) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((a - c) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(h))))


@pytest.mark.parametrize("r", [0.4, 7.0, 40.0])
def test_pairs_on_the_sphere(spark, r):
    rng = random.Random(3)
    spot = lambda: (rng.choice([rng.uniform(-5, 365), rng.uniform(359.7, 360.3), 0.0, 360.0]), rng.choice([rng.uniform(-90, 90), rng.uniform(89.5, 90), rng.uniform(-0.3, 0.3), 90.0, -90.0, 89.9]))
    a, b = [spot() for _ in range(150)], [spot() for _ in range(150)]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(a)] + [(900, None, 1.0), (901, 1.0, None), (902, 1.0, 91.0)], "i int, x double, y double")
    right = spark.createDataFrame([(j, *p) for j, p in enumerate(b)] + [(900, None, 1.0)], "j int, bx double, by double")
    got = sorted((x.i, x.j) for x in joins.near_pairs_sky(left, right, r).collect())
    assert got == sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if haversine(*p, *q) <= r) and got


@pytest.mark.parametrize(("tile", "half"), [(4, 1), (7, 2), (64, 3)])
def test_medians_by_tiles(spark, tile, half):
    rng = random.Random(4)
    rows = [(c, x, y, rng.choice([None, float("nan"), 1.0 * rng.randrange(50), 2.0 * rng.randrange(50)]), "s") for c in "ab" for x in range(-9, 14) for y in range(3, 20) if rng.random() < 0.8]
    rows += rows[:30]  # listed twice
    df = spark.createDataFrame(rows, "camera string, x int, y int, value double, note string")
    got = windows.box_median_2d(df, ["camera"], half, tile=tile).collect()
    assert len(got) == len(rows)
    for g in got:
        near = [v for c, x, y, v, _ in rows if c == g.camera and abs(x - g.x) <= half and abs(y - g.y) <= half and v is not None and v == v]
        assert (g.smooth is None or math.isnan(g.smooth)) if not near else g.smooth == np.median(near)


@pytest.mark.parametrize("pass_bytes", [1 << 20, 200])
def test_models_by_blocks(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(templates, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(templates, "STARS", 3)
    monkeypatch.setattr(templates, "MODELS", 2)
    monkeypatch.setattr(templates, "CELLS", 40)
    rng = np.random.default_rng(5)
    k = range(20)
    models = {m: {i: 10 + m + rng.normal() for i in k if rng.random() < 0.9} for m in range(7)}
    stars = {s: {i: (models[s % 7].get(i, 9.0) + rng.normal() * 0.3 + (40 if rng.random() < 0.1 else 0), rng.choice([0.5, 1.0])) for i in k if rng.random() < 0.8} for s in range(11)}
    spec = spark.createDataFrame([(s, i, float(v), float(e)) for s, d in stars.items() for i, (v, e) in d.items()] + [(99, 555, 1.0, 1.0)], "star int, k int, flux double, error double")
    table = spark.createDataFrame([(m, i, float(v)) for m, d in models.items() for i, v in d.items()], "model int, k int, flux double")

    def choose(drop):
        out = {}
        for s, d in stars.items():
            score = {}
            for m, t in models.items():
                c = [(d[i][0] - t[i]) ** 2 / (d[i][1] ** 2 + (0.05 * t[i]) ** 2) for i in d if i in t and (s, i) not in drop]
                if c:
                    score[m] = sum(c) / len(c)
            if score:
                out[s] = min(score.items(), key=lambda x: (x[1], x[0]))
        return out

    for most in (None, 5.0):
        want = choose(set())
        if most:
            far = {(s, i) for s, (m, _) in want.items() for i in stars[s] if i in models[m] and (stars[s][i][0] - models[m][i]) ** 2 / (stars[s][i][1] ** 2 + (0.05 * models[m][i]) ** 2) > most}
            want = choose(far)
        df = spectra.template_match(spec, table, ["k"], most=most)
        got = {r.star: (r.model, r.chi2) for r in df.collect()}
        assert set(got) == set(want) and all(got[s][0] == want[s][0] and got[s][1] == pytest.approx(want[s][1]) for s in want)


def slit(shift, seed=6, n=900):
    """Blocks of 12 fibres, 6 places apart, with gaps between blocks; fibres are as bright as they like."""
    rng = np.random.default_rng(seed)
    y, out = np.arange(n), np.zeros(n)
    for b in range(9):
        for f in range(12):
            out += rng.uniform(0.5, 2) * 1000 * np.exp(-0.5 * ((y - (40 + 96 * b + 6 * f + shift)) / 1.2) ** 2)
    return out


def test_profiles_align_in_two_levels(spark):
    planted = {1: 0.0, 2: 3.0, 3: -17.0, 4: 23.4, 5: -8.25}
    rows = lambda f: [(i, y, float(v)) for i, s in planted.items() for y, v in enumerate(f(i, s))]
    obs = spark.createDataFrame(rows(lambda i, s: slit(s) * (1 + i) + np.random.default_rng(i).normal(0, 5, 900)), "x int, y int, flux double")
    ref = spark.createDataFrame(rows(lambda i, s: slit(0)), "x int, y int, flux double")
    got = {r.x: (r.coarse, r.shift, r.score) for r in templates.align_profiles(obs, ref, ["x"]).collect()}
    for i, s in planted.items():  # a whole fibre's spacing off would be 6
        assert abs(got[i][0] - s) <= 3 and abs(got[i][1] - s) < 0.15 and got[i][2] > 0.8
    one = spark.createDataFrame([(1, 5, 2.0)], "x int, y int, flux double")
    assert templates.align_profiles(one, one, ["x"]).first().shift == 0


def test_aligned_query_finds_planted_shifts(spark, sf_dir):
    from spectral_spark.queries.spectra import d43_align_profiles

    groups = {r.vec_id: r.label for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    got = d43_align_profiles(spark, sf_dir).collect()
    assert len(got) == len(groups) and all(round(r["shift"]) == groups[r.fiberid] - 4 for r in got)


def test_cubes_follow_a_drift(spark):
    fibers = [(i * 20 + j, float(i), float(j)) for i in range(20) for j in range(20)]
    drift = {k: (0.31 * k, -0.17 * k) for k in range(8)}
    # a star at (9, 10) whose light moves with wavelength: fibre (x, y) sees at k what lies at its place with the drift added
    seen = [(f, k, 1000 * math.exp(-0.5 * ((x + dx - 9) ** 2 + (y + dy - 10) ** 2) / 2), 1.0, False) for f, x, y in fibers for k, (dx, dy) in drift.items()]
    samples = spark.createDataFrame(seen, "fiberid int, k int, flux double, error double, mask boolean")
    fib = spark.createDataFrame(fibers, "fiberid int, x double, y double")
    spaxels = spark.createDataFrame([(i, j, float(i), float(j)) for i in range(20) for j in range(20)], "ix int, iy int, bx double, by double")
    table = lambda d: spark.createDataFrame([(k, *p) for k, p in d.items()], "k int, dx double, dy double")
    centre = lambda cube: {r.k: (r.cx, r.cy) for r in spectra.barycenter(cube, ["k"], 9.0, 10.0, 6.0, 1, "ix", "iy").collect()}
    for step in (None, 0.05):
        w, p = spectra.drift_weights(fib, spaxels, table(drift), ["k"], 1.6, 0.8, step=step)
        at = centre(spectra.cube_drifting(samples, w, p, ["ix", "iy"], ["k"]))
        assert all(abs(x - 9) < 0.1 and abs(y - 10) < 0.1 for x, y in at.values())
    still = spectra.cube_weighted(samples, spectra.spaxel_weights(fib, spaxels, 1.6, 0.8), ["ix", "iy"], ["k"])
    assert abs(centre(still)[7][0] - 9) > 1
    w, p = spectra.drift_weights(fib, spaxels, table({3: (0.0, 0.0)}), ["k"], 1.6, 0.8)  # other k have no drift
    same = spectra.cube_drifting(samples, w, p, ["ix", "iy"], ["k"])
    key = lambda df: {(r.k, r.ix, r.iy): (r.cover, r.mask, pytest.approx(r.flux), pytest.approx(r.error)) for r in df.collect()}
    assert key(same) == key(still)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_time_models_past_midnight(spark, order):
    rng = np.random.default_rng(7)
    times = {i: np.sort(rng.uniform(85_000, 88_000, 9)) for i in range(4)} | {8: np.array([86_000.0, 86_100.0]), 9: np.array([86_000.0])}
    flux = {i: 5 + 0.01 * (t - 86_000) - 3e-6 * (t - 86_000) ** 2 + rng.normal(size=len(t)) for i, t in times.items()}
    series = spark.createDataFrame([(i, float(t), float(v)) for i in times for t, v in zip(times[i], flux[i])] + [(0, None, 4.0), (0, 4.0, None)], "f int, t double, flux double")
    targets = spark.createDataFrame([(i, a, b) for i in times for a, b in ((86_300.0, 200.0), (86_000.0, 86_000.0), (85_500.0, 86_100.0))], "f int, start double, end double")
    for r in joins.time_model(series, targets, ["f"], order).collect():
        t, v, end = times[r.f], flux[r.f], r.end + (86_400 if r.end < r.start else 0)
        if len(t) <= order:
            want = v.mean()
        else:
            mid, half = (t.min() + t.max()) / 2, (t.max() - t.min()) / 2
            p = np.polynomial.Polynomial.fit((t - mid) / half, v, order)
            a, b = (r.start - mid) / half, (end - mid) / half
            want = p(a) if a == b else (p.integ()(b) - p.integ()(a)) / (b - a)
        assert r.model == pytest.approx(want, rel=1e-7, abs=1e-7)


def test_ten_thousand_rules_without_a_nested_loop(spark, monkeypatch):
    rng = random.Random(8)
    names = [f"sdR-s-{c}{i}-{e:08d}" for c in "brz" for i in "123" for e in range(7300, 7340)] + ["x", "", None, "a.b(c)"]
    rules = [(n, rng.choice([f"sdR-*-*-{rng.randrange(7200, 9999):08d}", f"sdR-?-{rng.choice('brz')}[12]-*{rng.randrange(7300, 7340)}", f"*{rng.randrange(10, 99)}*-0000{rng.randrange(7300, 7340)}", f"sdR-s-b[!1]-0000732{rng.randrange(10)}"]), rng.choice(["A", "B"]), f"v{n}") for n in range(10_000)]
    rules += [(10_001, "?", "A", "one"), (10_002, "a.b(?)", "B", "dots"), (5, "*", "A", "all"), (10_003, "[bx]*", "B", "x"), (10_004, "sdR-s-z3-00007339", "A", "whole")]
    frames = spark.createDataFrame([(i, n, "old", "none") for i, n in enumerate(names)], "i int, name string, A string, B string")
    out = joins.apply_header_fixes(frames, spark.createDataFrame(rules, "rule_no int, fileroot string, keyword string, value string"), "name", ["A", "B"])
    for r in out.collect():
        want = {"A": "old", "B": "none"}
        if r.name is not None:
            for _, p, k, v in sorted(rules, key=lambda x: x[0]):
                if fnmatch.fnmatchcase(r.name, p):
                    want[k] = v
        assert {"A": r.A, "B": r.B} == want
    few = [r for r in rules if r[0] not in (10_001, 5, 10_003)]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    text = plan_of(joins.apply_header_fixes(frames, spark.createDataFrame(few, "rule_no int, fileroot string, keyword string, value string"), "name", ["A", "B"]).select("i", "A"))
    assert "CartesianProduct" not in text.split("Union")[0]


def test_laid_out_tables_join_without_a_shuffle(spark, sf_dir, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.detrend(*join_queries._laid_out(spark, sf_dir, 4), ["camera", "y", "x"], 2.0, 900.0, 300.0)
        text = plan_of(out)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert out.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def paired(monkeypatch, name):
    """The tables of pairs that a match makes from now on."""
    seen, real = [], getattr(joins, name)
    monkeypatch.setattr(joins, name, lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    return seen


@pytest.mark.parametrize("sky", [False, True])
def test_copies_are_not_paired_by_cones(spark, monkeypatch, sky):
    """Hundreds of fibres and stars at one place are one pair of places; no side is broadcast."""
    seen = paired(monkeypatch, "near_pairs_sky" if sky else "near_pairs")
    fibers = spark.createDataFrame([(i, 0.0, 0.0) for i in range(200)] + [(200, 10.0, 0.0), (201, 10.0, 0.0), (202, 20.0, 0.0), (203, 30.0, 0.0), (203, 40.0, 0.0), (204, 40.0, 0.0)], "fiberid int, x double, y double")
    stars = spark.createDataFrame([(i, 0.0, 0.0) for i in range(300)] + [(300, 10.2, 0.0), (301, 20.1, 0.0), (302, 19.9, 0.0), (303, 30.0, 0.1), (304, 40.0, 0.1)], "star int, bx double, by double")
    out = joins.cone_match(fibers, stars, 0.5, sky=sky)
    assert out.columns == ["fiberid", "x", "y", "star", "bx", "by", "distance"]
    assert sorted((r.fiberid, r.star, round(r.distance, 6)) for r in out.collect()) == [(200, 300, 0.2), (201, 300, 0.2), (204, 304, 0.1)]
    assert seen[0].count() <= 6 and "Broadcast" not in plan_of(out)


@pytest.mark.parametrize("sky", [False, True])
def test_copies_are_not_paired_by_brightness(spark, monkeypatch, sky):
    seen = paired(monkeypatch, "near_pairs_sky" if sky else "near_pairs")
    centres = spark.createDataFrame([(i, 0.0, 0.0) for i in range(200)] + [(200, 5.0, 0.0), (200, 0.0, 0.0)], "centre int, bx double, by double")
    stars = spark.createDataFrame([(i, (i * 7) % 300, 0.1, 0.0) for i in range(300)] + [(300, 2, 0.0, 0.0), (301, 400, 5.0, 0.0), (302, 0, 5.0, 0.3)], "star int, mag int, x double, y double")
    out = joins.brightest_in_radius(stars, centres, 0.5, 350, 3, sky=sky)
    best = sorted([((i * 7) % 300, i) for i in range(300)] + [(2, 300)])[:3]
    assert out.columns == ["star", "mag", "x", "y", "centre", "bx", "by", "distance", "rank"]
    got = sorted((r.centre, r["rank"], r.mag, r.star) for r in out.collect())
    assert got == sorted([(c, k + 1, *best[k]) for c in range(200) for k in range(3)] + [(200, k + 1, *b) for k, b in enumerate(sorted([*best, (0, 302)])[:3])])
    assert seen[0].count() <= 4 and "Broadcast" not in plan_of(out)


def test_copies_are_not_paired_by_apertures(spark, monkeypatch):
    seen = paired(monkeypatch, "near_pairs")
    fibers = spark.createDataFrame([(i, 0.0, 0.0) for i in range(200)] + [(200, 3.0, 4.0), (None, 3.0, 4.0), (202, 6.0, 0.0), (203, None, 0.0)], "fiberid int, x double, y double")
    apertures = spark.createDataFrame([(i, 0.0, 0.0) for i in range(300)] + [(300, 6.0, 1.0), (301, 90.0, 0.0), (302, None, 0.0)], "aperture int, bx double, by double")
    out = joins.aperture_totals(fibers, apertures, 5.0, "fiberid")
    assert out.columns == ["aperture", "bx", "by", "members", "total"]
    assert sorted((r.aperture, r.members, r.total) for r in out.collect()) == [*[(i, 202, 19900 + 200) for i in range(300)], (300, 3, 402)]
    assert seen[0].count() == 4 and "Broadcast" not in plan_of(out)


def test_aperture_query_pairs_places(spark, monkeypatch, sf_dir):
    """As many pairs as there are of distinct places within reach, however many fibres share one."""
    seen = paired(monkeypatch, "near_pairs")
    fib, _ = join_queries._plane(spark, sf_dir)
    monkeypatch.setattr(join_queries, "_plane", lambda *_: (fib.unionByName(fib.withColumn("fiberid", F.col("fiberid") + 101)), None))
    once = {(r.x, r.y) for r in fib.collect()}
    out = join_queries.c11_aperture_members(spark, sf_dir).collect()
    assert len(out) == 2 * fib.count()
    assert seen[0].count() == sum((a - c) ** 2 + (b - d) ** 2 <= 64 for a, b in once for c, d in once)


@pytest.mark.parametrize("copies", [(2, 1), (2, 2)])
def test_sky_query_pairs_places(spark, monkeypatch, sf_dir, copies):
    """As many pairs as there are of distinct places within reach, however many fibres and stars share one; neither side is broadcast."""
    fib, stars = (df.localCheckpoint() for df in join_queries._sky(spark, sf_dir))
    again = lambda df, key, n: df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(key, F.col(key) + F.col("i") * 1_000_000).drop("i").localCheckpoint()
    tables = again(fib, "fiberid", copies[0]), again(stars, "star", copies[1])
    monkeypatch.setattr(join_queries, "_sky", lambda *_: (fib, stars))
    once = [tuple(r) for r in join_queries.c9_cone_match_sky(spark, sf_dir).collect()]
    seen = paired(monkeypatch, "near_pairs_sky")
    monkeypatch.setattr(join_queries, "_sky", lambda *_: tables)
    out = join_queries.c9_cone_match_sky(spark, sf_dir)
    want = [(f + i * 1_000_000, s, d) for f, s, d in once for i in range(copies[0]) if copies[1] == 1]  # a star and its copy are two
    assert once and sorted(tuple(r) for r in out.collect()) == sorted(want)
    near = joins.near_pairs_sky(fib, stars, 1.5)
    assert seen[0].count() == near.select("x", "y", "bx", "by").distinct().count() and "Broadcast" not in plan_of(out)


def test_groups_without_a_row_in_the_window_are_left_out(spark):
    df = spark.createDataFrame([(1, 5, 4.0), (1, 50, 8.0), (2, 50, 3.0), (3, 6, 0.0)], "g int, part int, flux double")
    got = sorted((r.g, r.part, r.flux) for r in spectra.group_normalize(df, ["g"], F.col("part") < 10).collect())
    assert got == [(1, 5, 1.0), (1, 50, 2.0), (3, 6, None)]


def test_factor_means_hold_no_group(spark):
    """The same biweights as by windows, without a window over a group's values."""
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"key": ["a"] * 60_000 + ["b"] * 7 + ["c"] * 3 + ["d", None], "value": np.r_[rng.normal(1.0, 0.1, 60_000), 1, 2, 3, 4, 5, 6, 99.0, 2, 2, 2, np.nan, 4.0]})
    df = spark.createDataFrame(rows).repartition(4)
    got = spectra.factor_means(df)
    want = {r.key: (r.location, r.n) for r in robust.biweight_stats(df, ["key"], "value").collect()}
    have = {r.key: (r.value, r.n) for r in got.collect()}
    assert set(have) == set(want) == {"a", "b", "c", None} and all(have[k] == (pytest.approx(want[k][0], rel=1e-12), want[k][1]) for k in want)
    assert "Window" not in plan_of(got)


def test_blocks_of_stars_reach_python_in_bounded_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.createDataFrame([(s, k, float(s % 3 + k), 1.0) for s in range(9) for k in range(5)], "star int, k int, flux double, error double")
    models = spark.createDataFrame([(m, k, float(m + k)) for m in range(3) for k in range(5)], "model int, k int, flux double")
    out = spectra.template_match(df, models, ["k"], most=6.0)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    assert {r.star: r.model for r in out.collect()} == {s: s % 3 for s in range(9)}
