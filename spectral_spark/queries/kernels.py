"""Queries of fits, extraction, increments and workloads (D39-D41, I, J, K, W)."""

from pyspark.sql import functions as F

from .. import views as V
from ..functions import robust
from ..operators import extraction as K
from ..operators import filters, fits
from ..operators import spectra as P
from ..operators import stack as ST
from ..plans import workflows
from ..operators.joins import small
from ..registry import query, solve_sql
from ..shared import shared_path, stored
from ..streaming import ingest
from .spectra import r4
from .stack import biweight_sql

_TRACE = "trace AS (SELECT DISTINCT camera, frame, x, (y // 10)::BIGINT AS fiberid, (y // 10) * 10 + 4.0 AS centre FROM stack)"


def trace(p):
    return p.select("camera", "frame", "x", F.floor(F.col("y") / 10).alias("fiberid")).distinct().withColumn("centre", F.col("fiberid") * 10 + 4.0)


@query("SELECT fiberid, round(regr_intercept(flux, k::DOUBLE), 5) AS c0, round(regr_slope(flux, k::DOUBLE), 6) AS c1, count(*) AS n FROM cells GROUP BY fiberid", "cells")
def d39_polyfit(spark, d):
    f = fits.polyfit(V.cells(spark, d), ["fiberid"], "k", "flux", 1, least=10)
    return f.select("fiberid", F.round(F.get("coeffs", F.lit(0)), 5).alias("c0"), F.round(F.get("coeffs", F.lit(1)), 6).alias("c1"), "n")


def _sums(n: int, u: str, y: str) -> str:
    return ", ".join([f"sum(pow({u}, {p})) AS s{p}" for p in range(2 * n - 1)] + [f"sum(pow({u}, {p}) * {y}) AS t{p}" for p in range(n)])


def _poly(n: int, u: str) -> str:
    return " + ".join(f"x{p} * pow({u}, {p})" for p in range(n))


def _clipped_sql(n: int, rounds: int, nsigma: float) -> str:
    """Tables f0.. of repeated fits, each without what lies off the one before."""
    u, out = "((k - 32) / 32.0)", ["r0 AS (SELECT fiberid, k, flux FROM cells)"]
    for r in range(rounds + 1):
        out.append(f"p{r} AS (SELECT fiberid, {_sums(n, u, 'flux')} FROM r{r} GROUP BY fiberid), {solve_sql(f'p{r}', f'f{r}', n, 'fiberid, s0')}")
        if r < rounds:
            out.append(f"d{r} AS (SELECT r{r}.*, flux - ({_poly(n, u)}) AS d FROM r{r} JOIN f{r} USING (fiberid)), r{r + 1} AS (SELECT fiberid, k, flux FROM (SELECT *, stddev_pop(d) OVER (PARTITION BY fiberid) AS s FROM d{r}) WHERE abs(d) <= {nsigma} * s)")
    return ", ".join(out)


@query(f"WITH {_clipped_sql(4, 3, 2.5)} SELECT fiberid, round(x0, 3) AS c0, round(x1, 3) AS c1, round(x2, 3) AS c2, round(x3, 3) AS c3, s0::BIGINT AS n FROM f3", "cells")
def d40_polyfit_clipped(spark, d):
    f = fits.polyfit_clipped(V.cells(spark, d), ["fiberid"], "k", "flux", 3, 2.5, centre=32.0, width=32.0)
    return f.select("fiberid", *[F.round(F.get("coeffs", F.lit(p)), 3).alias(f"c{p}") for p in range(4)], "n")


@query(None)
def d41_fit_gradient(spark, d):
    fib = V.fibermap(spark, d).select("fiberid", "telescope", (F.col("fiberid") % 20).cast("double").alias("x"), F.col("ypmm").alias("y"))
    s = V.samples(spark, d).groupBy("k", "fiberid").agg(F.avg("flux").alias("flux")).join(small(fib), "fiberid")
    fit = fits.fit_gradient(s, ["k"], group="telescope")
    return r4(fits.remove_gradient(s, fit, ["k"], group="telescope").select("k", "fiberid", "flux"), "flux")


@query(f"""WITH f AS (SELECT fiberid, (fiberid % 20)::DOUBLE AS x, ypmm AS y FROM fibermap), s AS (SELECT k, fiberid, x, y, avg(flux) AS v FROM samples JOIN f USING (fiberid) GROUP BY ALL), p AS (SELECT k, count(*) AS s00, sum(y) AS s01, sum(x) AS s02, sum(y * y) AS s11, sum(x * y) AS s12, sum(x * x) AS s22, sum(v) AS t0, sum(y * v) AS t1, sum(x * v) AS t2 FROM s GROUP BY k),
{solve_sql("p", "c", 3, "k", lambda i, j: f"s{min(i, j)}{max(i, j)}")}, m AS (SELECT s.*, x0 + x1 * y + x2 * x AS m FROM s JOIN c USING (k)) SELECT k, fiberid, round(v * avg(m) OVER (PARTITION BY k) / m, 4) AS flux FROM m""", "samples fibermap")
def d41_fit_plane(spark, d):
    """A plane without groups: its normal equations are solved in closed form."""
    fib = V.fibermap(spark, d).select("fiberid", (F.col("fiberid") % 20).cast("double").alias("x"), F.col("ypmm").alias("y"))
    s = V.samples(spark, d).groupBy("k", "fiberid").agg(F.avg("flux").alias("flux")).join(small(fib), "fiberid")
    return r4(fits.remove_gradient(s, fits.fit_gradient(s, ["k"]), ["k"]).select("k", "fiberid", "flux"), "flux")


@query("WITH m AS (SELECT CASE WHEN mjd % 3 = 0 THEN mjd END AS seen, * FROM frames) SELECT expnum, camera, mjd FROM m WHERE seen IS NULL OR camera = '5-LOW'", "frames")
def i1_new_frames(spark, d):
    f = V.frames(spark, d)
    store = f.where("mjd % 3 = 0 and camera <> '5-LOW'")
    return ingest.new_frames(f, store, ["mjd", "camera", "expnum"]).select("expnum", "camera", "mjd")


@query("SELECT tileid % 40 AS part, tileid, max(expnum) AS expnum, arg_max(exptime, expnum) AS exptime FROM frames GROUP BY tileid", "frames")
def i2_ingest_stream(spark, d):
    schema = spark.read.parquet(f"{d}/orders.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/orders.parquet*")
    rows = stream.select((F.col("o_custkey") % 40).alias("part"), F.col("o_custkey").alias("tileid"), F.col("o_orderkey").alias("expnum"), F.floor("o_totalprice").cast("double").alias("exptime"))
    sink = shared_path(spark, "store")
    ingest.ingest_stream(rows, sink, f"{sink}-checkpoint", ["part", "tileid"], ["expnum"], "part").awaitTermination()
    return spark.read.schema("part long, tileid long, expnum long, exptime double").parquet(sink)


@query("SELECT mjd, camera, tileid, count(DISTINCT expnum) AS frames FROM frames GROUP BY ALL", "frames")
def i1_stream_new_frames(spark, d):
    """Every frame is found twice in a run, and runs overlap: first the nights of even number, then all."""
    schema = spark.read.parquet(f"{d}/orders.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/orders.parquet*")
    mjd = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1858-11-17").cast("date"))
    rows = stream.select(mjd.alias("mjd"), F.col("o_orderpriority").alias("camera"), F.col("o_orderkey").alias("expnum"), F.col("o_custkey").alias("tileid"), F.floor(mjd / 100).alias("season"))
    sink, keys = shared_path(spark, "frames"), ["season", "mjd", "camera", "expnum"]
    ingest.stream_new_frames(rows.where("mjd % 2 = 0").unionByName(rows.where("mjd % 2 = 0")), sink, f"{sink}-first", keys, "season").awaitTermination()
    ingest.stream_new_frames(rows.unionByName(rows), sink, f"{sink}-second", keys, "season").awaitTermination()
    store = spark.read.schema("mjd int, camera string, expnum long, tileid long, season long").parquet(sink)
    return store.groupBy("mjd", "camera", "tileid").agg(F.count("expnum").alias("frames"))


@query("SELECT expnum, bit_or(k)::BIGINT AS stage FROM samples WHERE mask GROUP BY expnum", "samples")
def i3_stream_stages(spark, d):
    """Updates of stages in two runs, the later lines first."""
    schema = spark.read.parquet(f"{d}/lineitem.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/lineitem.parquet*").where("l_returnflag = 'R'")
    rows = stream.select((F.col("l_orderkey") % 20).alias("part"), F.col("l_orderkey").alias("expnum"), F.col("l_linenumber").cast("long").alias("bits"))
    sink = shared_path(spark, "stages")
    for n, part in enumerate((rows.where("bits > 2"), rows.where("bits < 4"))):
        ingest.stream_stages(part, sink, f"{sink}-{n}", ["part", "expnum"], "part").awaitTermination()
    return spark.read.schema("part long, expnum long, bits long").parquet(sink).select("expnum", F.col("bits").alias("stage"))


@query("WITH u AS (SELECT expnum, bit_or(k) AS b FROM samples WHERE mask GROUP BY expnum) SELECT expnum, (1 | coalesce(b, 0))::BIGINT AS stage FROM frames LEFT JOIN u USING (expnum)", "frames samples")
def i3_update_stage(spark, d):
    f = V.frames(spark, d).withColumn("stage", F.lit(1).cast("long"))
    u = V.samples(spark, d).where("mask").select("expnum", F.col("k").cast("long").alias("bits"))
    return ingest.update_stage(f, u, ["expnum"]).select("expnum", "stage")


@query("SELECT fiberid, max(flux) - min(flux) AS spread, quantile_cont(flux, 0.5) AS median FROM samples GROUP BY fiberid", "samples")
def j1_caller_statistic(spark, d):
    s = V.samples(spark, d)
    spread = robust.statistic(s, ["fiberid"], "flux", lambda c: F.max(c) - F.min(c), "spread")
    return spread.join(robust.statistic(s, ["fiberid"], "flux", "median", "median"), "fiberid")


@query("SELECT fiberid, k, flux - max(flux) OVER (PARTITION BY fiberid) AS flux FROM cells", "cells")
def j2_apply_fibers(spark, d):
    c = V.cells(spark, d).select("fiberid", "k", "flux")
    return fits.apply_fibers(c, ["fiberid"], lambda p: p.assign(flux=p["flux"] - p["flux"].max()), "fiberid long, k int, flux double")


def _lsf_sql(width: str, reach: int) -> str:
    """Samples convolved by Gaussians of a width (FWHM^2 less 1.5^2, an expression of a.k), cut at five sigmas; the sample itself where that is not positive."""
    return f"""WITH w AS (SELECT a.fiberid, a.k, a.flux AS own, b.flux, b.k - a.k AS d, sqrt(greatest({width}, 0)) / (2 * sqrt(2 * ln(2.0::DOUBLE))) AS s FROM cells a JOIN cells b ON b.fiberid = a.fiberid AND b.k BETWEEN a.k - {reach} AND a.k + {reach})
SELECT fiberid, k, round(CASE WHEN any_value(s) = 0 THEN any_value(own) ELSE sum(CASE WHEN abs(d) <= 5 * s THEN flux * exp(-0.5 * (d / s) * (d / s)) END) / sum(CASE WHEN abs(d) <= 5 * s THEN exp(-0.5 * (d / s) * (d / s)) END) END, 3) AS flux FROM w GROUP BY fiberid, k"""


def _spectra(spark, d):
    s = V.spectra(spark, d).select("fiberid", F.transform("flux", lambda v: F.round(v.cast("double") * 10000)).alias("flux"))
    return s.withColumns({"wave": F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: k.cast("double")), "lsf": F.array_repeat(F.lit(1.5), 64)})


@query(_lsf_sql("CASE WHEN a.k < 20 THEN 9.0 WHEN a.k < 40 THEN 1.0 ELSE 25.0 END - 2.25", 12), "cells")
def j3_column_callable(spark, d):
    """A caller's target resolution as an expression of wavelength."""
    out = K.match_lsf(_spectra(spark, d), lambda w: F.when(w < 20, 3.0).when(w < 40, 1.0).otherwise(5.0))
    return r4(out.select("fiberid", F.posexplode("flux").alias("k", "flux")), "flux", n=3)


@query(f"WITH {_TRACE} SELECT t.camera, t.frame, t.fiberid, t.x, sum(value) AS flux, round(sqrt(sum(error * error)), 6) AS error, bool_or(mask) AS mask, count(*) AS pixels FROM trace t JOIN stack s ON s.camera = t.camera AND s.x = t.x AND s.frame = t.frame AND s.y BETWEEN t.centre - 2 AND t.centre + 2 GROUP BY ALL", "stack")
def k1_extract_aperture(spark, d):
    p = V.stack(spark, d)
    return r4(K.extract_aperture(p, trace(p), 5, ["camera", "frame"]), "error", n=6)


@query(None)
def k2_extract_optimal(spark, d):
    p = V.stack(spark, d)
    return r4(K.extract_optimal(p, trace(p).withColumn("sigma", F.lit(1.5)), ["camera", "frame"]), "flux", "error", n=3)


_ERF = "sign({x}) * 2 / sqrt(pi()) * exp(-{x} * {x}) * list_sum(list_transform(range(0, 90), lambda n: abs({x}) * pow({x} * {x}, n) * sqrt(pi()) / (2 * gamma(n + 1.5))))"
_EDGE = lambda d: _ERF.replace("{x}", f"((y - centre {d} 0.5) / (0.9 * sqrt(2.0::DOUBLE)))")


@query(f"""WITH {_TRACE}, p AS (SELECT t.camera, t.frame, t.fiberid, t.x, value, error, mask, 0.5 * ({_EDGE('+')} - {_EDGE('-')}) AS p FROM trace t JOIN stack s ON s.camera = t.camera AND s.x = t.x AND s.frame = t.frame AND abs(s.y - t.centre) <= 2.7 WHERE NOT mask AND error > 0)
SELECT t.camera, t.frame, t.fiberid, t.x, round(sum(p * value / (error * error)) / sum(p * p / (error * error))) AS flux, round(1 / sqrt(sum(p * p / (error * error))), 3) AS error, count(p) = 0 AS mask FROM trace t LEFT JOIN p ON p.camera = t.camera AND p.frame = t.frame AND p.fiberid = t.fiberid AND p.x = t.x GROUP BY t.camera, t.frame, t.fiberid, t.x""", "stack")
def k2_extract_separate(spark, d):
    """Fibres whose windows do not meet: each one's flux is its own weighted mean."""
    p = V.stack(spark, d)
    out = K.extract_optimal(p, trace(p).withColumn("sigma", F.lit(0.9)), ["camera", "frame"], reach=3.0)
    return r4(r4(out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("flux", "error")}), "flux", n=0), "error", n=3)


def _lines(spark):
    return spark.createDataFrame([("a", 12.0), ("b", 30.0), ("c", 41.0), ("d", 55.0)], "line string, line_wave double")


def _arc(spark, d):
    """Lines of known shape on the spectra's grid, moved by the spectra's group and as strong as the spectra are."""
    c = V.cells(spark, d).withColumns({"wave": F.col("k").cast("double"), "mask": F.lit(False)})
    power = c.groupBy("fiberid").agg((F.sum(F.abs("flux")) / 1000 + 1).alias("p"))
    shape = F.lit(0.0)
    for w in (12.3, 29.8, 41.4, 55.1):
        shape = shape + F.exp(-0.5 * F.pow((F.col("wave") - w - F.col("grp") * 0.05) / 1.1, F.lit(2)))
    return c.join(power, "fiberid").withColumn("flux", F.col("p") * shape + 3.0)


@query("""WITH j AS (SELECT fiberid, line, line_wave, k::DOUBLE AS w, flux + 20000 AS v FROM cells JOIN (VALUES ('a', 12.0), ('b', 30.0), ('c', 41.0), ('d', 55.0)) AS l(line, line_wave) ON abs(k - line_wave) <= 4), b AS (SELECT *, min(v) OVER (PARTITION BY fiberid, line) AS b FROM j)
SELECT fiberid, line, min(b) AS background, sum(v - b) AS flux, round(sum((v - b) * w) / sum(v - b), 6) AS centre, count(*) AS good FROM b GROUP BY fiberid, line""", "cells")
def k3_line_moments(spark, d):
    c = V.cells(spark, d).withColumns({"wave": F.col("k").cast("double"), "mask": F.lit(False), "flux": F.col("flux") + 20000})
    return r4(K.line_moments(c, _lines(spark), ["fiberid"], 4.0), "centre", n=6).select("fiberid", "line", "background", "flux", "centre", "good")


@query("SELECT grp, fiberid, round(0.2::DOUBLE + grp * 0.05::DOUBLE, 3) AS offset, true AS measured FROM (SELECT DISTINCT grp, fiberid FROM cells)", "cells")
def d45_fit_wave_offsets(spark, d):
    a = _arc(spark, d).withColumn("error", F.lit(1.0))
    return r4(K.fit_wave_offsets(a, _lines(spark), ["grp"], snr=5.0), "offset", n=3)


_ARC_LINES = "l(line, line_wave, centre) AS (VALUES ('a', 12.0, 12.3::DOUBLE), ('b', 30.0, 29.8), ('c', 41.0, 41.4), ('d', 55.0, 55.1))"


@query(f"""WITH {_ARC_LINES}, p AS (SELECT fiberid, grp, sum(abs(flux)) / 1000 + 1 AS p FROM cells GROUP BY ALL)
SELECT fiberid, line, round(centre + grp * 0.05, 3) AS centre, 2.5903::DOUBLE AS fwhm, 3.0::DOUBLE AS background, round(p * sqrt(2 * pi()) * 1.1, 2) AS flux FROM p, l""", "cells")
def k3_fit_lines(spark, d):
    f = K.fit_lines(_arc(spark, d), _lines(spark), ["fiberid"], 4.0)
    return f.select("fiberid", "line", F.round("centre", 3).alias("centre"), F.round("fwhm", 4).alias("fwhm"), F.round("background", 2).alias("background"), F.round("flux", 2).alias("flux"))


@query(f"""WITH {_ARC_LINES}, f AS (SELECT DISTINCT fiberid, grp FROM cells), x AS (SELECT fiberid, line_wave AS w, centre + grp * 0.05 AS c FROM f, l), s AS (SELECT fiberid, regr_slope(w, c) AS b, regr_intercept(w, c) AS a FROM x GROUP BY fiberid), r AS (SELECT fiberid, w - a - b * c AS r FROM x JOIN s USING (fiberid)),
q AS (SELECT fiberid, stddev_pop(r) AS sigma, quantile_cont(r, 0.5) AS median, min(r) AS min, max(r) AS max FROM r GROUP BY fiberid)
SELECT fiberid, 4::BIGINT AS n, round(a, 3) AS c0, round(b, 4) AS c1, round(sigma, 3) AS sigma, round(median, 3) AS median, round(min, 3) AS min, round(max, 3) AS max, round(2 * sqrt(2 * ln(2.0::DOUBLE)) * 1.1 * b, 3) AS lsf0, 0.0::DOUBLE AS lsf1 FROM s JOIN q USING (fiberid)""", "cells")
def k4_wavelength_solution(spark, d):
    fits = K.smooth_fwhm(K.fit_lines(_arc(spark, d), _lines(spark), ["fiberid"], 4.0), [], 1)
    s = K.wavelength_solution(fits, ["fiberid"], 1, lsf_degree=1)
    at = lambda c, i: F.get(c, F.lit(i))
    s = s.select("fiberid", "n", F.round(at("coeffs", 0), 3).alias("c0"), F.round(at("coeffs", 1), 4).alias("c1"), "sigma", "median", "min", "max", F.round(at("lsf_coeffs", 0), 3).alias("lsf0"), (F.round(at("lsf_coeffs", 1), 4) + 0.0).alias("lsf1"))
    return r4(s, "sigma", "median", "min", "max", n=3)


@query(_lsf_sql("16.0 - 2.25", 8), "cells")
def k5_match_lsf(spark, d):
    return r4(K.match_lsf(_spectra(spark, d), 4.0).select("fiberid", F.posexplode("flux").alias("k", "flux")), "flux", n=3)


def _continuum_sql(rounds: int = 3, half: int = 10) -> str:
    out = ["c0 AS (SELECT fiberid, k, flux + 20000 AS c, false AS line FROM cells)"]
    for n in range(rounds):
        out.append(f"m{n} AS (SELECT fiberid, k, c, line, quantile_cont(c, 0.5) OVER (PARTITION BY fiberid ORDER BY k ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) AS m FROM c{n})")
        out.append(f"l{n} AS (SELECT fiberid, k, c, line OR coalesce(c / nullif(m, 0) < 0.9 OR c / nullif(m, 0) > 1 / 0.9, false) AS line FROM m{n})")
        last, first = (f"{f}_value(CASE WHEN NOT line THEN struct_pack(k := k, c := c) END IGNORE NULLS) OVER (PARTITION BY fiberid ORDER BY k ROWS BETWEEN {w})" for f, w in (("last", "UNBOUNDED PRECEDING AND CURRENT ROW"), ("first", "CURRENT ROW AND UNBOUNDED FOLLOWING")))
        out.append(f"g{n} AS (SELECT fiberid, k, c, line, {last} AS b, {first} AS a FROM l{n})")
        out.append(f"c{n + 1} AS (SELECT fiberid, k, CASE WHEN NOT line THEN c WHEN b IS NULL THEN a.c WHEN a IS NULL THEN b.c ELSE b.c + (k - b.k) / (a.k - b.k) * (a.c - b.c) END AS c, line FROM g{n})")
    return "WITH " + ",\n".join(out) + f"\nSELECT fiberid, k, line, round(c, 4) AS continuum FROM c{rounds}"


@query(_continuum_sql(), "cells")
def k6_find_continuum(spark, d):
    c = V.cells(spark, d).withColumn("flux", F.col("flux") + 20000)
    return r4(K.find_continuum(c, ["fiberid"], "k"), "continuum").select("fiberid", "k", "line", "continuum")


@query("SELECT spec, part // 10 AS cell, round(sum(part / (error * error)) / sum(1 / (error * error)), 5) AS wave, round(sum(flux / (error * error)) / sum(1 / (error * error)), 3) AS sky, round(1 / sqrt(sum(1 / (error * error))), 6) AS error FROM samples GROUP BY spec, part // 10", "samples")
def k7_super_sky(spark, d):
    s = K.super_sky(V.samples(spark, d), ["spec"], 10.0, "part")
    s = s.select("spec", F.floor(F.col("cw") / 10).alias("cell"), F.round("cw", 5).alias("wave"), F.round("cv", 3).alias("sky"), F.round("error", 6).alias("error"))
    return s


@query(f"""WITH {biweight_sql("b", "(SELECT spec, fiberid, avg(flux) AS mean FROM samples GROUP BY ALL)", "spec", "mean")}, f AS (SELECT spec, fiberid FROM (SELECT spec, fiberid, avg(flux) AS mean FROM samples GROUP BY ALL) JOIN b USING (spec) WHERE abs(mean - location) <= 1.5 * scale)
SELECT spec, part // 10 AS cell, round(sum(part / (error * error)) / sum(1 / (error * error)), 5) AS wave, round(sum(flux / (error * error)) / sum(1 / (error * error)), 3) AS sky, round(1 / sqrt(sum(1 / (error * error))), 6) AS error FROM samples JOIN f USING (spec, fiberid) WHERE NOT mask GROUP BY spec, part // 10""", "samples")
def k7_super_sky_clean(spark, d):
    """Outlying fibres and masked samples left out."""
    s = K.super_sky(V.samples(spark, d), ["spec"], 10.0, "part", fiber="fiberid", mask="mask", n=1.5)
    return s.select("spec", F.floor(F.col("cw") / 10).alias("cell"), F.round("cw", 5).alias("wave"), F.round("cv", 3).alias("sky"), F.round("error", 6).alias("error"))


@query("""WITH b AS (SELECT spec, sum(part / (error * error)) / sum(1 / (error * error)) AS x, sum(flux / (error * error)) / sum(1 / (error * error)) AS y FROM samples GROUP BY spec, part // 10), s AS (SELECT *, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM b WINDOW w AS (PARTITION BY spec ORDER BY x)),
e AS (SELECT spec, min(x) AS lo, arg_min(y, x) AS first FROM b GROUP BY spec) SELECT expnum, fiberid, k, part, round(CASE WHEN part <= lo THEN first WHEN x2 IS NULL THEN y ELSE y + (part - x) / (x2 - x) * (y2 - y) END, 3) AS sky FROM samples JOIN e USING (spec) ASOF LEFT JOIN s ON s.spec = samples.spec AND samples.part::DOUBLE >= s.x""", "samples")
def k7_evaluate_sky(spark, d):
    s = V.samples(spark, d).withColumn("wave", F.col("part").cast("double"))
    return r4(K.evaluate_sky(s, K.super_sky(s, ["spec"], 10.0), ["spec"]), "sky", n=3).select("expnum", "fiberid", "k", "part", "sky")


@query("""WITH c AS (SELECT fiberid, k, (flux + 20000 - 100) / 900.0 * pow(10.0, 0.4 * 0.2 * 1.2) AS o, k % 7 = 3 AS line FROM cells), f AS (SELECT fiberid, k, CASE WHEN NOT line THEN o ELSE (lag(o) OVER w + lead(o) OVER w) / 2 END AS o FROM c WINDOW w AS (PARTITION BY fiberid ORDER BY k)), s AS (SELECT fiberid, k, (100.0 + k) / o AS s FROM f)
SELECT fiberid, k, round(quantile_cont(s, 0.5) OVER (PARTITION BY fiberid ORDER BY k ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS sens FROM s""", "cells")
def k8_star_sensitivity(spark, d):
    c = V.cells(spark, d).withColumns({"flux": F.col("flux") + 20000, "sky": F.lit(100.0), "exptime": F.lit(900.0), "airmass": F.lit(1.2), "ext": F.lit(0.2), "line": F.col("k") % 7 == 3, "wave": F.col("k").cast("double")})
    ref = c.select("fiberid").distinct().withColumn("cw", F.explode(F.array(F.lit(0.0), F.lit(63.0)))).withColumn("cv", F.lit(100.0) + F.col("cw"))
    return r4(K.star_sensitivity(c, ref, ["fiberid"], "k", 2), "sens", n=6).select("fiberid", "k", "sens")


def _continuum_fit_sql(rounds: int = 4) -> str:
    u, out = "((k - 32) / 32.0)", ["q0 AS (SELECT fiberid, k, flux + 20000 AS flux, false AS clipped, NULL::DOUBLE AS c FROM cells)"]
    for r in range(rounds):
        out.append(f"p{r} AS (SELECT fiberid, {_sums(5, u, 'flux')} FROM q{r} WHERE NOT clipped GROUP BY fiberid), {solve_sql(f'p{r}', f'f{r}', 5, 'fiberid')}")
        out.append(f"q{r + 1} AS (SELECT fiberid, k, flux, clipped OR coalesce(flux < 0.9 * c, false) AS clipped, c FROM (SELECT q{r}.* EXCLUDE (c), {_poly(5, u)} AS c FROM q{r} LEFT JOIN f{r} USING (fiberid)))")
    return ", ".join(out)


@query(f"WITH {_continuum_fit_sql()} SELECT fiberid, k, clipped, round(c, 3) AS continuum FROM q4", "cells")
def k9_fit_continuum(spark, d):
    c = V.cells(spark, d).withColumn("flux", F.col("flux") + 20000)
    return r4(K.fit_continuum(c, ["fiberid"], "k", "flux", 4, 0.9, centre=32.0, width=32.0), "continuum", n=3).select("fiberid", "k", "clipped", "continuum")


@query(f"""WITH {_TRACE}, f AS (SELECT t.*, fiberid + 1.0 AS flux FROM trace t), r AS (SELECT camera, frame, x, unnest(range(centre::INT - 6, centre::INT + 7)) AS y, centre, flux FROM f) SELECT camera, frame, x, y::INT AS y, round(sum(flux * exp(-0.5 * ((y - centre) / 2.5) * ((y - centre) / 2.5)) / (2.5 * sqrt(2 * pi()))), 6) AS model FROM r GROUP BY camera, frame, x, y""", "stack")
def k10_render_profiles(spark, d):
    t = trace(V.stack(spark, d)).withColumns({"flux": F.col("fiberid") + 1.0, "sigma": F.lit(2.5)})
    return r4(K.render_profiles(t, ["camera", "frame"], 6), "model", n=6)


_MATCH = """m AS (SELECT DISTINCT camera, mjd AS mm FROM frames WHERE imagetyp = 'P'), t AS (SELECT DISTINCT camera, mjd FROM frames), b AS (SELECT t.camera, t.mjd, min(struct_pack(d := abs(t.mjd - mm), m := mm)).m AS master_mjd FROM t JOIN m USING (camera) GROUP BY ALL),
j AS (SELECT s.*, f.camera, master_mjd FROM samples s JOIN frames f USING (expnum) LEFT JOIN b ON b.camera = f.camera AND b.mjd = f.mjd)"""


@query(f"WITH {_MATCH} SELECT camera, master_mjd, k, quantile_cont(CASE WHEN NOT mask THEN flux END, 0.5) AS flux, count(*) FILTER (NOT mask) AS n, bool_and(mask) AS mask FROM j GROUP BY camera, master_mjd, k", "frames samples")
def w_matched_stack(spark, d):
    """The flagship: catalogue, nearest masters, median stack."""
    return workflows.matched_stack(V.frames(spark, d), V.samples(spark, d), "P")


@query(f"""WITH {_TRACE}, b AS (SELECT camera, y, x, min(value) AS v, bool_and(mask) AS m FROM stack GROUP BY ALL), dk AS (SELECT camera, y, x, max(error) AS v FROM stack WHERE frame <= 3 GROUP BY ALL), fl AS (SELECT camera, y, x, max(error) / 25.0 AS v FROM stack WHERE frame >= 3 GROUP BY ALL),
p AS (SELECT s.camera, s.frame, s.y, s.x, (s.value - b.v - coalesce(dk.v, 0) * 900.0 / 300.0) / coalesce(fl.v, 1.0) AS value, error, mask OR b.m AS mask FROM stack s JOIN b ON b.camera = s.camera AND b.y = s.y AND b.x = s.x LEFT JOIN dk ON dk.camera = s.camera AND dk.y = s.y AND dk.x = s.x LEFT JOIN fl ON fl.camera = s.camera AND fl.y = s.y AND fl.x = s.x),
e AS (SELECT t.camera, t.frame, t.fiberid, t.x, sum(value) AS flux, sqrt(sum(error * error)) AS error, bool_or(mask) AS mask FROM trace t JOIN p s ON s.camera = t.camera AND s.frame = t.frame AND s.x = t.x AND s.y BETWEEN t.centre - 1 AND t.centre + 1 GROUP BY ALL),
fr AS (SELECT camera, x, quantile_cont(flux, 0.5) AS r FROM e WHERE frame = 7 AND NOT mask GROUP BY ALL), ff AS (SELECT e.camera, e.fiberid, e.x, flux / nullif(r, 0) AS f FROM e LEFT JOIN fr ON fr.camera = e.camera AND fr.x = e.x WHERE frame = 7),
d AS (SELECT e.frame, e.camera, e.fiberid, e.x, flux / nullif(coalesce(f, 1.0), 0) AS flux, error / nullif(coalesce(f, 1.0), 0) AS error, mask OR flux / nullif(coalesce(f, 1.0), 0) IS NULL AS mask, CASE e.camera WHEN 'A' THEN 100.0 WHEN 'N' THEN 180.0 ELSE 260.0 END + 2.0 * e.x + 0.25 * e.fiberid AS w FROM e LEFT JOIN ff ON ff.camera = e.camera AND ff.fiberid = e.fiberid AND ff.x = e.x WHERE e.frame < 7),
n AS (SELECT *, lead(w) OVER u AS w2, lead(flux) OVER u AS v2, lead(error) OVER u AS e2, lead(mask) OVER u AS m2 FROM d WINDOW u AS (PARTITION BY frame, camera, fiberid ORDER BY x)),
g AS (SELECT *, unnest(range(greatest(ceil((w - 100) / 3), 0)::INT, (least(ceil((w2 - 100) / 3) - 1, 89) + 1)::INT)) AS k FROM n WHERE w2 > w), h AS (SELECT *, (100.0 + k * 3.0 - w) / (w2 - w) AS t FROM g),
r AS (SELECT frame, camera, fiberid, k, flux + t * (v2 - flux) AS flux, sqrt((1 - t) * error * (1 - t) * error + t * e2 * t * e2) AS error, CASE WHEN t < 0.5 THEN mask ELSE m2 END AS mask FROM h),
c AS (SELECT frame, fiberid, k, CASE WHEN count(*) = 1 THEN any_value(flux) ELSE sum(CASE WHEN NOT mask AND error > 0 THEN flux / (error * error) END) / sum(CASE WHEN NOT mask AND error > 0 THEN 1 / (error * error) END) END AS flux, CASE WHEN count(*) = 1 THEN any_value(error) ELSE 1 / sqrt(sum(CASE WHEN NOT mask AND error > 0 THEN 1 / (error * error) END)) END AS error, bool_and(mask) AS mask FROM r GROUP BY ALL),
sk AS (SELECT frame, fiberid % 2 AS side, k, avg(CASE WHEN NOT mask THEN flux END) AS v, sqrt(sum(CASE WHEN NOT mask THEN error * error END)) / nullif(count(*) FILTER (NOT mask), 0) AS e FROM c WHERE fiberid % 3 = 0 GROUP BY ALL),
bl AS (SELECT a.frame, a.k, (0.2 + a.frame / 10.0) * a.v + (0.8 - a.frame / 10.0) * z.v AS v, sqrt((0.2 + a.frame / 10.0) * a.e * (0.2 + a.frame / 10.0) * a.e + (0.8 - a.frame / 10.0) * z.e * (0.8 - a.frame / 10.0) * z.e) AS e FROM sk a JOIN sk z ON z.frame = a.frame AND z.k = a.k AND a.side = 0 AND z.side = 1),
s AS (SELECT c.frame, c.fiberid, c.k, flux - coalesce(bl.v, 0) AS flux, sqrt(error * error + coalesce(bl.e, 0) * coalesce(bl.e, 0)) AS error, mask FROM c LEFT JOIN bl ON bl.frame = c.frame AND bl.k = c.k WHERE fiberid % 3 > 0),
o AS (SELECT *, (1.0 + k / 100.0) * pow(10.0::DOUBLE, 0.4 * (1.1 + frame / 50.0) * (0.3 + (3.0 * k) / 300 * (0.1 - 0.3))) / CASE WHEN fiberid % 3 = 1 THEN 900.0 WHEN fiberid % 2 = 0 THEN 60.0 ELSE 75.0 END AS f FROM s)
SELECT frame, fiberid, k, round(flux * f, 4) AS flux, round(error * f, 6) AS error, mask FROM o""", "stack")
def w_reduce_science(spark, d):
    """The whole science reduction: detrending, extraction, fibre flat, common grid, channels, two skies, flux calibration."""
    s = stored(V.stack(spark, d), "stack")  # read by masters, lamp, frames and their trace
    traced = stored(trace(s), "trace")
    key = ["camera", "y", "x"]
    masters = workflows.Masters(
        bias=s.groupBy(*key).agg(F.min("value").alias("value"), F.every("mask").alias("mask")),
        dark=s.where("frame <= 3").groupBy(*key).agg(F.max("error").alias("value")).withColumn("mask", F.lit(False)),
        flat=s.where("frame >= 3").groupBy(*key).agg((F.max("error") / 25.0).alias("value")).withColumn("mask", F.lit(False)),
    )
    lamp = s.where("frame = 7")
    lit = workflows.extract_frames(lamp, masters, trace(lamp), ["frame", "camera"], exptime=900.0, dark_time=300.0)
    flat = stored(P.fiberflat(lit, ["camera", "x"]), "fiberflat")
    p = s.where("frame < 7")
    wave = F.when(F.col("camera") == "A", 100.0).when(F.col("camera") == "N", 180.0).otherwise(260.0) + F.lit(2.0) * F.col("x") + F.lit(0.25) * F.col("fiberid")
    fibers = traced.select("fiberid").distinct().withColumn("telescope", F.when(F.col("fiberid") % 3 == 1, "Sci").when(F.col("fiberid") % 3 == 2, "Spec").when(F.col("fiberid") % 2 == 0, "SkyE").otherwise("SkyW"))
    fibers = fibers.withColumn("std_exptime", F.when((F.col("telescope") == "Spec") & (F.col("fiberid") % 2 == 0), 60.0))
    shots = p.select("frame").distinct().select("frame", (F.lit(0.2) + F.col("frame") / 10.0).alias("weight_e"), (F.lit(0.8) - F.col("frame") / 10.0).alias("weight_w"), F.lit(900.0).alias("exptime"), (F.lit(1.1) + F.col("frame") / 50.0).alias("airmass"))
    sens = spark.range(90).select(F.col("id").cast("int").alias("k"), (F.lit(1.0) + F.col("id") / 100.0).alias("sens"))
    extinction = spark.createDataFrame([(100.0, 0.3), (400.0, 0.1)], "cw double, cv double")
    out = workflows.reduce_science(p, masters, trace(p), flat, wave, (100.0, 3.0, 90), fibers, shots, sens, extinction, dark_time=300.0)
    return r4(r4(out, "flux"), "error", n=6).select("frame", "fiberid", "k", "flux", "error", "mask")


_SIDES = "CASE WHEN fiberid % 3 = 1 THEN 'Sci' WHEN fiberid % 3 = 2 THEN 'Spec' WHEN fiberid % 2 = 0 THEN 'SkyE' ELSE 'SkyW' END"


def _side_sql(side: str) -> str:
    """Tables of one telescope's sky: outlying fibres out, bins of inverse variance, and its value and error at every sample."""
    z = side[-1].lower()
    return f"""{z}0 AS (SELECT frame, camera, fiberid, avg(flux) AS mean FROM mv WHERE telescope = '{side}' GROUP BY ALL), {biweight_sql(z + "b", z + "0", "frame, camera", "mean")},
{z}1 AS (SELECT {z}0.frame, {z}0.camera, fiberid FROM {z}0 JOIN {z}b ON {z}0.frame = {z}b.frame AND {z}0.camera = {z}b.camera WHERE abs(mean - location) <= 3 * scale),
{z}2 AS (SELECT m.frame, m.camera, sum(w / (error * error)) / sum(1 / (error * error)) AS x, sum(flux / (error * error)) / sum(1 / (error * error)) AS y, 1 / sqrt(sum(1 / (error * error))) AS e FROM mv m JOIN {z}1 USING (frame, camera, fiberid) WHERE telescope = '{side}' AND NOT mask AND error > 0 GROUP BY m.frame, m.camera, floor(w / 5.5)),
{z}3 AS (SELECT *, lead(x) OVER u AS x2, lead(y) OVER u AS y2, lead(e) OVER u AS e2, first_value(y) OVER u AS y0, first_value(e) OVER u AS e0, min(x) OVER u AS x0 FROM {z}2 WINDOW u AS (PARTITION BY frame, camera ORDER BY x)),
{z}4 AS (SELECT DISTINCT frame, camera, y0, e0 FROM {z}3),
{z}5 AS (SELECT m.frame, m.camera, fiberid, m.x, CASE WHEN s.x IS NULL THEN f.y0 WHEN x2 IS NULL THEN y ELSE y + (w - s.x) / (x2 - s.x) * (y2 - y) END AS v, CASE WHEN s.x IS NULL THEN f.e0 WHEN x2 IS NULL THEN e ELSE e + (w - s.x) / (x2 - s.x) * (e2 - e) END AS e FROM mv m LEFT JOIN {z}4 f ON f.frame = m.frame AND f.camera = m.camera ASOF LEFT JOIN {z}3 s ON s.frame = m.frame AND s.camera = m.camera AND m.w >= s.x)"""


_GOOD = "NOT mask AND error > 0"
_NATIVE = f"""{_TRACE}, raw AS (SELECT camera, frame, y, x, CASE WHEN x >= 46 THEN floor(value / 1000) ELSE value END AS value, error, mask FROM stack WHERE frame < 8),
ov AS (SELECT camera, frame, y, quantile_cont(value, 0.5) AS v FROM raw WHERE x >= 46 GROUP BY ALL), cl AS (SELECT r.camera, r.frame, r.y, r.x, value - coalesce(v, 0) AS value, error, mask OR value - coalesce(v, 0) >= 90000 OR x < 2 OR x >= 44 AS mask, value - coalesce(v, 0) >= 90000 AS hot FROM raw r LEFT JOIN ov USING (camera, frame, y) WHERE x < 46),
b AS (SELECT camera, y, x, min(value) AS v, bool_and(mask) AS m FROM stack GROUP BY ALL), dk AS (SELECT camera, y, x, max(error) AS v FROM stack WHERE frame <= 3 GROUP BY ALL), fl AS (SELECT camera, y, x, max(error) / 25.0 AS v FROM stack WHERE frame >= 3 GROUP BY ALL),
p AS (SELECT s.camera, s.frame, s.y, s.x, (s.value - b.v - coalesce(dk.v, 0) * 900.0 / 300.0) / coalesce(fl.v, 1.0) AS value, error, mask OR b.m AS mask FROM cl s JOIN b ON b.camera = s.camera AND b.y = s.y AND b.x = s.x LEFT JOIN dk ON dk.camera = s.camera AND dk.y = s.y AND dk.x = s.x LEFT JOIN fl ON fl.camera = s.camera AND fl.y = s.y AND fl.x = s.x),
e AS (SELECT t.camera, t.frame, t.fiberid, t.x, sum(value) AS flux, sqrt(sum(error * error)) AS error, bool_or(mask) AS mask FROM trace t JOIN p s ON s.camera = t.camera AND s.frame = t.frame AND s.x = t.x AND s.y BETWEEN t.centre - 1 AND t.centre + 1 GROUP BY ALL),
fr AS (SELECT camera, x, quantile_cont(flux, 0.5) AS r FROM e WHERE frame = 7 AND NOT mask GROUP BY ALL), ff AS (SELECT e.camera, e.fiberid, e.x, flux / nullif(r, 0) AS f FROM e LEFT JOIN fr ON fr.camera = e.camera AND fr.x = e.x WHERE frame = 7),
d AS (SELECT e.frame, e.camera, e.fiberid, e.x, flux / nullif(coalesce(f, 1.0), 0) AS flux, error / nullif(coalesce(f, 1.0), 0) AS error, mask OR flux / nullif(coalesce(f, 1.0), 0) IS NULL AS mask, CASE e.camera WHEN 'A' THEN 100.0 WHEN 'N' THEN 180.0 ELSE 260.0 END + 0.25 * e.fiberid + e.x * (2.0 + 0.002 * e.x) AS w FROM e LEFT JOIN ff ON ff.camera = e.camera AND ff.fiberid = e.fiberid AND ff.x = e.x WHERE e.frame < 7),
li(line) AS (VALUES (130.0), (210.0), (290.0)), lm AS (SELECT frame, camera, fiberid, line, sum(flux * w) / nullif(sum(flux), 0) AS c, sum(flux) / nullif(sqrt(sum(error * error)), 0) AS snr FROM d JOIN li ON abs(w - line) <= 4 WHERE NOT mask GROUP BY ALL),
lo AS (SELECT frame, camera, fiberid, quantile_cont(CASE WHEN snr >= 100 THEN c - line END, 0.5) AS o FROM lm GROUP BY ALL), lg AS (SELECT frame, camera, fiberid, CASE WHEN avg((o IS NOT NULL)::INT) OVER (PARTITION BY frame, camera) > 0.5 THEN coalesce(o, 0) ELSE 0 END AS o FROM lo),
mv AS (SELECT d.* REPLACE (w - coalesce(o, 0) AS w), {_SIDES} AS telescope FROM d LEFT JOIN lg USING (frame, camera, fiberid))"""
_REDUCED = f"""WITH {_NATIVE}, {_side_sql("SkyE")}, {_side_sql("SkyW")},
sk AS (SELECT mv.*, coalesce((0.2 + mv.frame / 10.0) * e.v + (0.8 - mv.frame / 10.0) * z.v, e.v, z.v, 0) AS sky, coalesce(sqrt((0.2 + mv.frame / 10.0) * e.e * (0.2 + mv.frame / 10.0) * e.e + (0.8 - mv.frame / 10.0) * z.e * (0.8 - mv.frame / 10.0) * z.e), e.e, z.e, 0) AS sky_error FROM mv JOIN e5 e USING (frame, camera, fiberid, x) JOIN w5 z USING (frame, camera, fiberid, x)),
gr AS (SELECT *, coalesce((lead(w) OVER u - lag(w) OVER u) / 2, lead(w) OVER u - w, w - lag(w) OVER u) AS g FROM sk WINDOW u AS (PARTITION BY frame, camera, fiberid ORDER BY x)),
dn AS (SELECT frame, camera, fiberid, telescope, x, w, mask, flux / nullif(g, 0) AS flux, error / nullif(g, 0) AS error, sky / nullif(g, 0) AS sky, sky_error / nullif(g, 0) AS sky_error FROM gr),
n AS (SELECT *, lead(w) OVER u AS w2, lead(flux) OVER u AS v2, lead(error) OVER u AS e2, lead(sky) OVER u AS s2, lead(sky_error) OVER u AS t2, lead(mask) OVER u AS m2 FROM dn WINDOW u AS (PARTITION BY frame, camera, fiberid ORDER BY x)),
g AS (SELECT *, unnest(range(greatest(ceil((w - 100) / 3), 0)::INT, (least(ceil((w2 - 100) / 3) - 1, 89) + 1)::INT)) AS k FROM n WHERE w2 > w), h AS (SELECT *, (100.0 + k * 3.0 - w) / (w2 - w) AS t FROM g),
r AS (SELECT frame, camera, fiberid, telescope, k, flux + t * (v2 - flux) AS flux, sqrt(pow((1 - t) * error, 2) + pow(t * e2, 2)) AS error, sky + t * (s2 - sky) AS sky, sqrt(pow((1 - t) * sky_error, 2) + pow(t * t2, 2)) AS sky_error, CASE WHEN t < 0.5 THEN mask ELSE m2 END AS mask FROM h),
f AS (SELECT *, (1.0 + k / 100.0) / CASE telescope WHEN 'SkyE' THEN 0.9 + k / 1000.0 WHEN 'SkyW' THEN 0.8 + k / 1000.0 ELSE 0.95 END * pow(10.0::DOUBLE, 0.4 * (0.3 + (3.0 * k) / 300 * (0.1 - 0.3)) * (1.1 + frame / 50.0 + CASE telescope WHEN 'SkyE' THEN 0.1 WHEN 'SkyW' THEN 0.2 ELSE 0 END)) / CASE WHEN telescope <> 'Spec' THEN 900.0 WHEN fiberid % 2 = 0 THEN 60.0 ELSE 75.0 END AS f FROM r),
c AS (SELECT frame, fiberid, telescope, k, CASE WHEN count(*) = 1 THEN any_value(flux * f) ELSE sum(CASE WHEN {_GOOD} THEN flux * f / pow(error * f, 2) END) / sum(CASE WHEN {_GOOD} THEN 1 / pow(error * f, 2) END) END AS flux, CASE WHEN count(*) = 1 THEN any_value(error * f) ELSE 1 / sqrt(sum(CASE WHEN {_GOOD} THEN 1 / pow(error * f, 2) END)) END AS error,
CASE WHEN count(*) = 1 THEN any_value(sky * f) ELSE sum(CASE WHEN NOT mask AND sky_error > 0 THEN sky * f / pow(sky_error * f, 2) END) / sum(CASE WHEN NOT mask AND sky_error > 0 THEN 1 / pow(sky_error * f, 2) END) END AS sky, CASE WHEN count(*) = 1 THEN any_value(sky_error * f) ELSE 1 / sqrt(sum(CASE WHEN NOT mask AND sky_error > 0 THEN 1 / pow(sky_error * f, 2) END)) END AS sky_error, bool_and(mask) AS mask FROM f GROUP BY ALL),
o AS (SELECT frame, fiberid, telescope, k, flux - sky AS flux, sqrt(error * error + sky_error * sky_error) AS error, sky, mask FROM c)"""


def _exposures(spark, d):
    """What reduce_exposures takes, from the stack of frames: the last columns stand for the overscan, frame 7 for the lamp."""
    s = stored(V.stack(spark, d), "stack")  # read by masters, lamp, frames and their trace
    traced = stored(trace(s), "trace")
    key = ["camera", "y", "x"]
    masters = workflows.Masters(
        bias=s.groupBy(*key).agg(F.min("value").alias("value"), F.every("mask").alias("mask")),
        dark=s.where("frame <= 3").groupBy(*key).agg(F.max("error").alias("value")).withColumn("mask", F.lit(False)),
        flat=s.where("frame >= 3").groupBy(*key).agg((F.max("error") / 25.0).alias("value")).withColumn("mask", F.lit(False)),
    )
    raw = s.where("frame < 8").withColumn("value", F.when(F.col("x") >= 46, F.floor(F.col("value") / 1000)).otherwise(F.col("value")).cast("double"))
    overscan = F.col("x") >= 46
    first = F.when(F.col("camera") == "A", 100.0).when(F.col("camera") == "N", 180.0).otherwise(260.0) + F.lit(0.25) * F.col("fiberid")
    waves = traced.select("camera", "fiberid").distinct().withColumns({"wave": F.array(first, F.lit(2.0), F.lit(0.002)), "lsf": F.array(F.lit(1.5), F.lit(0.01))})
    fibers = traced.select("fiberid").distinct().withColumn("telescope", F.when(F.col("fiberid") % 3 == 1, "Sci").when(F.col("fiberid") % 3 == 2, "Spec").when(F.col("fiberid") % 2 == 0, "SkyE").otherwise("SkyW"))
    fibers = fibers.withColumn("std_exptime", F.when(F.col("telescope") == "Spec", F.when(F.col("fiberid") % 2 == 0, 60.0).otherwise(75.0)))
    mass = F.lit(1.1) + F.col("frame") / 50.0
    exposures = s.select("frame").where("frame < 8").distinct().withColumns({"exptime": F.lit(900.0), "weight_e": F.lit(0.2) + F.col("frame") / 10.0, "weight_w": F.lit(0.8) - F.col("frame") / 10.0, "airmass": mass, "airmass_e": mass + 0.1, "airmass_w": mass + 0.2})
    lines = spark.createDataFrame([(130.0,), (210.0,), (290.0,)], "line_wave double")
    ks = spark.range(90).select(F.col("id").cast("int").alias("k"))
    sens = ks.withColumn("sens", F.lit(1.0) + F.col("k") / 100.0)
    extinction = spark.createDataFrame([(100.0, 0.3), (400.0, 0.1)], "cw double, cv double")
    telluric = ks.withColumn("telescope", F.explode(F.array(*map(F.lit, ("Sci", "Spec", "SkyE", "SkyW"))))).withColumn("trans", F.when(F.col("telescope") == "SkyE", F.lit(0.9) + F.col("k") / 1000.0).when(F.col("telescope") == "SkyW", F.lit(0.8) + F.col("k") / 1000.0).otherwise(0.95))
    cal = workflows.Calibrations(masters, traced, waves, None, lines, sens, extinction, telluric)
    how = {"columns": 46, "level": 90000.0, "edge": 2, "stat": "median", "dark_time": 300.0, "snr": 100.0}
    lamp = raw.where("frame = 7")
    profile = ST.overscan_profile(lamp.where(overscan), ["frame", "camera"], "y", "median")
    clean, _ = filters.mask_saturated(ST.subtract_overscan(lamp.where(~overscan), profile, ["frame", "camera"]), ["frame", "camera"], 46, 90000.0, edge=2)
    lit = workflows.extract_frames(clean, masters, trace(lamp), ["frame", "camera"], exptime=900.0, dark_time=300.0)
    cal = cal._replace(fiberflat=stored(P.fiberflat(lit, ["camera", "x"]), "fiberflat"))
    return workflows.reduce_exposures(raw.where("frame < 7"), overscan, cal, fibers, exposures, (100.0, 3.0, 90), 5.5, **how)


@query(f"{_REDUCED} SELECT frame, fiberid, telescope, k, round(flux, 3) AS flux, round(error, 4) AS error, round(sky, 3) AS sky, mask FROM o", "stack")
def w_reduce_exposures(spark, d):
    """Raw frames to calibrated spectra of all fibres: overscan, saturation, detrending, extraction, wavelengths from coefficients, fibre flat, sky-line shift, a sky for each telescope before resampling, densities, telluric and flux calibration, channels, sky subtraction."""
    out, _ = _exposures(spark, d)
    return r4(r4(out, "flux", "sky", n=3), "error").select("frame", "fiberid", "telescope", "k", "flux", "error", "sky", "mask")


@query(f"{_REDUCED}, q AS (SELECT frame, round(coalesce(avg(CASE WHEN NOT mask THEN flux END), -999.9), 3) AS mean, round(coalesce(quantile_cont(CASE WHEN NOT mask THEN flux END, 0.5), -999.9), 3) AS median, round(coalesce(stddev_pop(CASE WHEN NOT mask THEN flux END), -999.9), 3) AS std FROM o GROUP BY frame), s AS (SELECT frame, max(n) AS saturated FROM (SELECT frame, camera, count(*) FILTER (hot) / count(*) AS n FROM cl WHERE frame < 7 GROUP BY ALL) GROUP BY frame) SELECT q.*, round(saturated, 6) AS saturated FROM q JOIN s USING (frame)", "stack")
def w_exposure_quality(spark, d):
    """The quality summary of the same reduction."""
    _, quality = _exposures(spark, d)
    return r4(r4(quality, "mean", "median", "std", n=3), "saturated", n=6)


_KINDS = "CASE WHEN frame <= 2 THEN 'bias' WHEN frame <= 4 THEN 'arc' ELSE 'flat' END"


@query(f"""WITH s AS (SELECT *, {_KINDS} AS kind FROM stack WHERE frame <> 6), p AS (SELECT camera, frame, kind, CASE kind WHEN 'bias' THEN quantile_cont(value, 0.5) WHEN 'arc' THEN quantile_cont(value, 0.99) ELSE quantile_cont(value, 0.75) END AS p FROM s GROUP BY camera, frame, kind), f AS (SELECT camera, frame, quantile_cont(p, 0.5) OVER (PARTITION BY camera, kind) / nullif(p, 0) AS f FROM p)
SELECT kind, camera, y, x, round(quantile_cont(CASE WHEN NOT mask THEN value * f END, 0.5), 4) AS value, bool_and(mask) AS mask, count(*) FILTER (NOT mask) AS n FROM s JOIN f USING (camera, frame) GROUP BY kind, camera, y, x""", "stack")
def w_master_calibrations(spark, d):
    """Masters of each kind from the frames that the catalogue lists as good."""
    s = V.stack(spark, d)
    kind = F.when(F.col("frame") <= 2, "bias").when(F.col("frame") <= 4, "arc").otherwise("flat")
    frames = s.select("camera", "frame").distinct().withColumns({"imagetyp": kind, "qaqual": F.when(F.col("frame") == 6, "BAD").otherwise("GOOD")})
    out = workflows.master_calibrations(frames, s, ["bias", "arc", "flat"])
    return r4(out, "value").select("kind", "camera", "y", "x", "value", "mask", "n")


@query(f"""WITH {_ARC_LINES}, f AS (SELECT DISTINCT fiberid, grp FROM cells WHERE fiberid % 3 = 0), x AS (SELECT fiberid, line_wave * 2 + 100 AS w, centre + grp * 0.05 AS c FROM f, l), s AS (SELECT fiberid, regr_slope(w, c) AS b, regr_intercept(w, c) AS a FROM x GROUP BY fiberid), r AS (SELECT fiberid, w - a - b * c AS r FROM x JOIN s USING (fiberid)), q AS (SELECT fiberid, stddev_pop(r) AS sigma FROM r GROUP BY fiberid)
SELECT fiberid, 4::BIGINT AS n, round(a, 2) AS c0, round(b, 3) AS c1, round(sigma, 3) AS sigma, round(2 * sqrt(2 * ln(2.0::DOUBLE)) * 1.1 * b, 2) AS lsf0 FROM s JOIN q USING (fiberid)""", "cells")
def w_arc_wavelengths(spark, d):
    """Arc frames of several strengths, made of the spectra's lines across three rows a fibre, to wavelengths and resolution."""
    arc = _arc(spark, d).where("fiberid % 3 = 0")
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in enumerate((0.25, 0.5, 0.25))]))
    frames = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    pixels = arc.withColumn("r", rows).withColumn("frame", frames).select(F.lit("b").alias("camera"), "frame", F.col("k").alias("x"), (F.col("fiberid") * 3 + F.col("r.i")).alias("y"), (F.col("flux") * F.col("r.w") * (F.lit(1.0) + F.col("frame") / 10.0)).alias("value"), F.lit(1.0).alias("error"), F.lit(False).alias("mask"))
    trace_ = arc.select(F.lit("b").alias("camera"), F.col("k").alias("x"), "fiberid", (F.col("fiberid") * 3.0 + 1.0).alias("centre"))
    lines = _lines(spark).select("line", F.col("line_wave").alias("pixel"), (F.col("line_wave") * 2 + 100).alias("line_wave"))
    s = workflows.arc_wavelengths(pixels, trace_, lines, 1, 1)
    at = lambda c, i: F.get(c, F.lit(i))
    return s.select("fiberid", "n", F.round(at("coeffs", 0), 2).alias("c0"), F.round(at("coeffs", 1), 3).alias("c1"), F.round("sigma", 3).alias("sigma"), F.round(at("lsf_coeffs", 0), 2).alias("lsf0"))


_PLANE_SUMS = "count(*) AS s00, sum(y) AS s01, sum(x) AS s02, sum(y * y) AS s11, sum(x * y) AS s12, sum(x * x) AS s22, sum(v) AS t0, sum(y * v) AS t1, sum(x * v) AS t2"


@query(f"""WITH f AS (SELECT fiberid, (fiberid % 20)::DOUBLE AS x, ypmm / 10 AS y, CASE WHEN fiberid % 5 = 0 THEN 'Spec' ELSE 'Sci' END AS telescope FROM fibermap),
a AS (SELECT k AS night, fiberid, (part // 200)::INT AS k, avg(flux) AS flux, avg(error) AS error FROM samples GROUP BY ALL), q AS (SELECT night, night % 3 AS label FROM a GROUP BY night), ch AS (SELECT min(night) AS night FROM q WHERE night <> 2 GROUP BY label), s AS (SELECT a.*, x, y, telescope FROM a JOIN ch USING (night) JOIN f USING (fiberid)),
l AS (SELECT night, fiberid, x, y, avg(flux) AS v FROM s WHERE k > 2 AND k < 8 AND telescope <> 'Spec' GROUP BY ALL), p AS (SELECT night, {_PLANE_SUMS} FROM l GROUP BY night), {solve_sql("p", "c", 3, "night", lambda i, j: f"s{min(i, j)}{max(i, j)}")},
g AS (SELECT s.*, x0 + x1 * y + x2 * x AS model FROM s LEFT JOIN c USING (night)), h AS (SELECT *, avg(model) OVER (PARTITION BY night) AS mean FROM g), d AS (SELECT *, coalesce(flux * mean / nullif(model, 0), flux) AS v FROM h),
r AS (SELECT night, k, quantile_cont(v, 0.5) AS r FROM d GROUP BY ALL), n AS (SELECT d.*, v / nullif(r, 0) AS f FROM d JOIN r USING (night, k)),
sn AS (SELECT night, fiberid, quantile_cont(flux / nullif(error, 0), 0.5) AS snr FROM s WHERE telescope = 'Spec' GROUP BY ALL), sm AS (SELECT night, quantile_cont(snr, 0.5) AS m FROM sn GROUP BY night), ex AS (SELECT night, arg_max(fiberid, snr) AS fiberid FROM sn JOIN sm USING (night) WHERE snr <> m GROUP BY night),
u AS (SELECT n.fiberid, k, CASE WHEN f IS NULL OR f <= 0 OR telescope = 'Spec' AND ex.fiberid IS NULL THEN NULL ELSE f END AS f FROM n LEFT JOIN ex ON ex.night = n.night AND ex.fiberid = n.fiberid), {biweight_sql("b", "u", "fiberid, k", "f")}
SELECT fiberid, k, round(location, 5) AS flux, n FROM b""", "samples fibermap")
def w_twilight_flats(spark, d):
    """Sequence, gradients, flats of each exposure and their combination. Lines of orders stand for nights, one spectrograph for all."""
    f = V.fibermap(spark, d).select("fiberid", (F.col("fiberid") % 20).cast("double").alias("x"), (F.col("ypmm") / 10).alias("y"), F.when(F.col("fiberid") % 5 == 0, "Spec").otherwise("Sci").alias("telescope"), F.lit(1).alias("spectrographid"))
    s = V.samples(spark, d).groupBy(F.col("k").alias("night"), "fiberid", F.floor(F.col("part") / 200).cast("int").alias("k")).agg(F.avg("flux").alias("flux"), F.avg("error").alias("error")).withColumn("mask", F.lit(False))
    frames = s.select("night").distinct().withColumns({"calibfib": F.col("night") % 3, "qaqual": F.when(F.col("night") == 2, "BAD").otherwise("GOOD")})
    flat, _, _ = workflows.twilight_flats(frames, s, f, 5.0, 6.0, "night")
    return flat.select("fiberid", "k", F.round("flux", 5).alias("flux"), "n")


@query("""WITH e AS (SELECT DISTINCT (mjd // 50 * 50)::INT AS epoch FROM frames), x AS (SELECT *, lag(expnum) OVER w AS b, lead(expnum) OVER w AS a FROM frames WINDOW w AS (PARTITION BY camera, imagetyp ORDER BY expnum)), n AS (SELECT *, CASE WHEN b IS NULL OR a - expnum < expnum - b THEN a ELSE b END AS r FROM x)
SELECT camera, imagetyp, (mjd // 50 * 50)::INT AS epoch, count(*) AS frames, min(abs(r - expnum)) AS nearest, count(DISTINCT mjd) AS nights FROM n GROUP BY ALL""", "frames")
def w_catalogue_summary(spark, d):
    f = V.frames(spark, d)
    return workflows.catalogue_summary(f, f.select((F.floor(F.col("mjd") / 50) * 50).cast("int").alias("epoch")).distinct())


