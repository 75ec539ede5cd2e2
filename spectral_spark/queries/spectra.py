"""Queries of spectra."""

from pyspark.sql import functions as F

from .. import views as V
from ..operators import spectra as P
from ..operators import templates as T
from ..operators.joins import small
from ..registry import query
from .stack import biweight_sql

_UNIQUE = "u AS (SELECT expnum, fiberid, k, max(flux) AS flux, max(error) AS error, bool_and(mask) AS mask FROM samples GROUP BY ALL)"


def unique(spark, d):
    return V.samples(spark, d).groupBy("expnum", "fiberid", "k").agg(F.max("flux").alias("flux"), F.max("error").alias("error"), F.every("mask").alias("mask"))


def r4(df, *cols, n=4):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("SELECT fiberid, round(avg(flux), 4) AS mean, quantile_cont(flux, 0.5) AS median FROM samples WHERE part > 90 AND part < 110 AND NOT mask GROUP BY fiberid", "samples")
def d12_coadd_window(spark, d):
    s = V.samples(spark, d)
    a = P.coadd_window(s, ["fiberid"], "part", 100, 21, "mean", mask="mask").withColumnRenamed("coadd", "mean")
    return r4(a.join(P.coadd_window(s, ["fiberid"], "part", 100, 21, "median", mask="mask").withColumnRenamed("coadd", "median"), "fiberid"), "mean")


@query("""WITH l(line, l0, l1, c0, c1) AS (VALUES ('a', 100, 130, 80, 150), ('b', 300, 310, 280, 330)),
j AS (SELECT fiberid, line, flux, error, part BETWEEN l0 AND l1 AS inn FROM samples JOIN l ON part BETWEEN c0 AND c1)
SELECT fiberid, line, quantile_cont(flux, 0.5) FILTER (NOT inn) AS continuum, count(*) FILTER (inn) AS n, round(sqrt(sum(error * error) FILTER (inn)), 6) AS error, sum(flux) FILTER (inn) - count(*) FILTER (inn) * quantile_cont(flux, 0.5) FILTER (NOT inn) AS flux FROM j GROUP BY fiberid, line""", "samples")
def d13_line_flux(spark, d):
    lines = spark.createDataFrame([("a", 100, 130, 80, 150), ("b", 300, 310, 280, 330)], "line string, l0 int, l1 int, c0 int, c1 int")
    return r4(P.line_flux(V.samples(spark, d), lines, ["fiberid"], "part"), "error", n=6)


@query("""SELECT part, quantile_cont(flux, 0.5) FILTER (telescope = 'ASIA') AS "ASIA", quantile_cont(flux, 0.5) FILTER (telescope = 'EUROPE') AS "EUROPE" FROM samples JOIN fibermap USING (fiberid) GROUP BY part""", "samples fibermap")
def d14_median_spectra(spark, d):
    s = V.samples(spark, d).join(small(V.fibermap(spark, d)), "fiberid")
    return P.median_spectra(s, ["part"], "telescope", ["ASIA", "EUROPE"])


@query("WITH m AS (SELECT fiberid, avg(flux) AS c FROM samples GROUP BY fiberid) SELECT k, round(avg((flux - c) / error), 3) AS mean, round(quantile_cont((flux - c) / error, 0.5), 4) AS median, round(stddev_pop((flux - c) / error), 3) AS std FROM samples JOIN m USING (fiberid) GROUP BY k", "samples")
def d14_residual_stats(spark, d):
    s = V.samples(spark, d)
    j = s.join(s.groupBy("fiberid").agg(F.avg("flux").alias("continuum")), "fiberid")
    return r4(r4(P.residual_stats(j, ["k"]), "mean", "std", n=3), "median")


@query("SELECT fiberid, part, count(DISTINCT spec) AS channels, round(CASE WHEN count(*) = 1 THEN any_value(flux) ELSE sum(CASE WHEN NOT mask THEN flux / (error * error) END) / sum(CASE WHEN NOT mask THEN 1 / (error * error) END) END, 4) AS flux, round(CASE WHEN count(*) = 1 THEN any_value(error) ELSE 1 / sqrt(sum(CASE WHEN NOT mask THEN 1 / (error * error) END)) END, 6) AS error, bool_and(mask) AS mask FROM samples GROUP BY fiberid, part", "samples")
def d15_join_channels(spark, d):
    return r4(r4(P.join_channels(V.samples(spark, d), ["fiberid", "part"], "spec"), "flux"), "error", n=6)


@query("WITH a AS (SELECT * FROM stack WHERE frame <= 2) SELECT camera, y, x, round(CASE WHEN count(*) = 1 THEN any_value(value) ELSE sum(CASE WHEN NOT mask THEN value / (error * error) END) / sum(CASE WHEN NOT mask THEN 1 / (error * error) END) END, 4) AS value, round(CASE WHEN count(*) = 1 THEN any_value(error) ELSE 1 / sqrt(sum(CASE WHEN NOT mask THEN 1 / (error * error) END)) END, 6) AS error, bool_and(mask) AS mask FROM a GROUP BY camera, y, x", "stack")
def d16_coadd_pair(spark, d):
    s = V.stack(spark, d)
    return r4(r4(P.coadd_pair(s.where("frame = 1"), s.where("frame = 2"), ["camera", "y", "x"], "value"), "value"), "error", n=6)


@query("SELECT k, spec, round(avg(CASE WHEN NOT mask THEN flux END), 4) AS flux, round(sqrt(sum(CASE WHEN NOT mask THEN error * error END)) / nullif(count(*) FILTER (NOT mask), 0), 6) AS error, bool_and(mask) AS mask, count(*) FILTER (NOT mask) AS n FROM samples GROUP BY k, spec", "samples")
def d17_collapse_fibers(spark, d):
    return r4(r4(P.collapse_fibers(V.samples(spark, d), ["k", "spec"]), "flux"), "error", n=6)


@query("""WITH m AS (SELECT spec, fiberid, quantile_cont(flux, 0.5) AS m FROM samples WHERE NOT mask GROUP BY ALL), c AS (SELECT *, quantile_cont(m, 0.5) OVER (PARTITION BY spec) AS c, stddev_pop(m) OVER (PARTITION BY spec) AS s FROM m), kept AS (SELECT spec, fiberid FROM c WHERE abs(m - c) <= 2.5 * s / 2)
SELECT spec, k, round(avg(CASE WHEN NOT mask THEN flux END), 4) AS flux, round(sqrt(sum(CASE WHEN NOT mask THEN error * error END)) / nullif(count(*) FILTER (NOT mask), 0), 6) AS error, bool_and(mask) AS mask, count(*) FILTER (NOT mask) AS n FROM samples JOIN kept USING (spec, fiberid) GROUP BY spec, k""", "samples")
def d18_master_sky(spark, d):
    return r4(r4(P.master_sky(V.samples(spark, d), ["spec"], clip=2.5), "flux"), "error", n=6)


@query(f"WITH {biweight_sql('b', 'samples', 'spec, part', 'flux')}, {biweight_sql('e', 'samples', 'spec, part', 'error * error')} SELECT b.spec, b.part, b.n, round(b.location, 4) AS flux, round(sqrt(greatest(e.location, 0)) / b.n, 6) AS error FROM b JOIN e ON b.spec = e.spec AND b.part = e.part", "samples")
def d19_sky_means(spark, d):
    return r4(r4(P.sky_means(V.samples(spark, d), ["spec", "part"]), "flux"), "error", n=6)


def _pointing(df):
    e = F.col("expnum")
    return df.withColumns({"sci_ra": (e % 360).cast("double"), "sci_dec": (e % 90 - 45).cast("double"), "e_ra": ((e + 17) % 360).cast("double"), "e_dec": (e % 60 - 30).cast("double"), "w_ra": ((e * 7) % 360).cast("double"), "w_dec": (e % 40 - 20).cast("double")})


_DIST = "acos(greatest(least(sin(radians((expnum % 90 - 45)::DOUBLE)) * sin(radians({dec})) + cos(radians((expnum % 90 - 45)::DOUBLE)) * cos(radians({dec})) * cos(radians((expnum % 360)::DOUBLE - {ra})), 1), -1))"


@query(f"""WITH a AS (SELECT expnum, degrees({_DIST.format(dec="(expnum % 60 - 30)::DOUBLE", ra="((expnum + 17) % 360)::DOUBLE")}) AS e, degrees({_DIST.format(dec="(expnum % 40 - 20)::DOUBLE", ra="((expnum * 7) % 360)::DOUBLE")}) AS w FROM frames),
b AS (SELECT expnum, CASE WHEN e > 0 THEN 1 / e ELSE 1 END AS e, CASE WHEN w > 0 THEN 1 / w ELSE 1 END AS w FROM a), s AS (SELECT expnum, k, sum(flux) FILTER (spec = 'O') AS fo, sum(flux) FILTER (spec = 'F') AS ff FROM samples GROUP BY ALL)
SELECT expnum, k, round(e / (e + w) * fo + w / (e + w) * ff, 3) AS flux FROM s JOIN b USING (expnum) WHERE fo IS NOT NULL AND ff IS NOT NULL""", "frames samples")
def d20_weight_skies(spark, d):
    w = P.sky_weights(_pointing(V.frames(spark, d).select("expnum"))).select("expnum", "weight_e", "weight_w")
    sky = lambda s: V.samples(spark, d).where(F.col("spec") == s).groupBy("expnum", "k").agg(F.sum("flux").alias("flux"), F.sum("error").alias("error"))
    return P.weight_skies(sky("O"), sky("F"), w, ["expnum"], ["expnum", "k"]).select("expnum", "k", F.round("flux", 3).alias("flux"))


@query("WITH s AS (SELECT spec, k, min(flux) AS s, min(error) AS e FROM samples WHERE k < 6 GROUP BY ALL) SELECT expnum, fiberid, k, part, flux - 0.5 * coalesce(s, 0) AS flux, round(sqrt(error * error + 0.25 * coalesce(e, 0) * coalesce(e, 0)), 6) AS error FROM samples LEFT JOIN s USING (spec, k)", "samples")
def d21_subtract_sky(spark, d):
    s = V.samples(spark, d)
    sky = s.where("k < 6").groupBy("spec", "k").agg(F.min("flux").alias("flux"), F.min("error").alias("error"))
    return r4(P.subtract_sky(s, sky, ["spec", "k"], 0.5), "error", n=6).select("expnum", "fiberid", "k", "part", "flux", "error")


_AB = "a AS (SELECT fiberid, part, sum(flux) AS x FROM samples WHERE spec = 'O' GROUP BY ALL), b AS (SELECT part, sum(flux) AS y FROM samples WHERE spec = 'F' GROUP BY part), j AS (SELECT fiberid, part, x, y, x / y AS r, abs(x * y) AS w FROM a JOIN b USING (part) WHERE y <> 0)"


@query(f"WITH {_AB}, c AS (SELECT fiberid, r, sum(w) OVER (PARTITION BY fiberid ORDER BY r, part ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY fiberid) AS t FROM j WHERE w > 0) SELECT fiberid, round(greatest(least(min(r), 2.0), 0.0), 9) AS scale FROM c WHERE 2 * c >= t GROUP BY fiberid", "samples")
def d22_fit_scale(spark, d):
    s = V.samples(spark, d)
    sci = s.where("spec = 'O'").groupBy("fiberid", "part").agg(F.sum("flux").alias("flux"))
    sky = sci.select("fiberid", "part").join(s.where("spec = 'F'").groupBy("part").agg(F.sum("flux").alias("flux")), "part")
    return r4(P.fit_scale(sci, sky, ["fiberid"], ["part"], 0.0, 2.0), "scale", n=9)


@query(f"WITH {_AB} SELECT fiberid, round(sum(x * y) / sum(y * y), 9) AS scale FROM j GROUP BY fiberid", "samples")
def d22_fit_scale_rms(spark, d):
    s = V.samples(spark, d)
    sci = s.where("spec = 'O'").groupBy("fiberid", "part").agg(F.sum("flux").alias("flux"))
    sky = sci.select("fiberid", "part").join(s.where("spec = 'F'").groupBy("part").agg(F.sum("flux").alias("flux")), "part")
    return r4(P.fit_scale_rms(sci, sky, ["fiberid"], ["part"]), "scale", n=9)


@query("WITH c AS (SELECT spec, fiberid, avg(flux) AS c FROM samples WHERE part > 40 AND part < 160 GROUP BY ALL) SELECT spec, fiberid, round(c, 4) AS coadd, NOT c BETWEEN quantile_cont(c, 0.05) OVER (PARTITION BY spec) AND quantile_cont(c, 0.97) OVER (PARTITION BY spec) AS rejected FROM c", "samples")
def d23_reject_fibers(spark, d):
    c = P.coadd_window(V.samples(spark, d), ["spec", "fiberid"], "part", 100, 120)
    return r4(P.reject_fibers(c, ["spec"]), "coadd")


@query(f"WITH m AS (SELECT spec, fiberid, avg(flux) AS mean FROM samples GROUP BY ALL), {biweight_sql('b', 'm', 'spec', 'mean')} SELECT m.spec, fiberid, round(mean, 4) AS mean FROM m JOIN b ON m.spec = b.spec WHERE abs(mean - location) <= 1.5 * scale", "samples")
def d24_reject_fiber_outliers(spark, d):
    return r4(P.reject_fiber_outliers(V.samples(spark, d), ["spec"], n=1.5), "mean")


@query("WITH f AS (SELECT fiberid, avg(flux) AS f FROM samples WHERE part BETWEEN 10 AND 300 GROUP BY fiberid) SELECT expnum, fiberid, k, part, round(flux / f, 6) AS flux FROM samples JOIN f USING (fiberid)", "samples")
def d25_group_normalize(spark, d):
    return r4(P.group_normalize(V.samples(spark, d), ["fiberid"], F.col("part").between(10, 300)), "flux", n=6).select("expnum", "fiberid", "k", "part", "flux")


@query("WITH r AS (SELECT part, quantile_cont(flux, 0.5) AS r FROM samples WHERE NOT mask GROUP BY part) SELECT expnum, fiberid, k, part, round(greatest(least(flux / r, 3.0), 0.1), 6) AS flux, mask OR r IS NULL OR flux / r <= 0 AS mask FROM samples LEFT JOIN r USING (part)", "samples")
def d26_fiberflat(spark, d):
    return r4(P.fiberflat(V.samples(spark, d), ["part"], clip=(0.1, 3.0)), "flux", n=6).select("expnum", "fiberid", "k", "part", "flux", "mask")


@query(f"WITH v AS (SELECT fiberid, k, CASE WHEN NOT (fiberid % 5 = 0 AND expnum % 3 > 0) THEN flux END AS v FROM samples), {biweight_sql('b', 'v', 'fiberid, k', 'v')} SELECT fiberid, k, round(location, 4) AS flux, n FROM b", "samples")
def d27_combine_flats(spark, d):
    return r4(P.combine_flats(V.samples(spark, d), ["fiberid", "k"], (F.col("fiberid") % 5 == 0) & (F.col("expnum") % 3 > 0)), "flux")


@query(f"WITH {biweight_sql('b', 'samples', 'k, spec', 'error')} SELECT s.expnum, s.fiberid, s.k, s.part, round(flux / location, 6) AS flux FROM samples s JOIN b ON s.k = b.k AND s.spec = b.spec", "samples")
def d28_factor_means(spark, d):
    s = V.samples(spark, d)
    f = P.factor_means(s, ["k", "spec"], "error").withColumnRenamed("error", "value")
    return r4(P.apply_factors(s, f, ["k", "spec"], undo=True), "flux", n=6).select("expnum", "fiberid", "k", "part", "flux")


@query("SELECT fiberid, min(flux) AS min, max(flux) AS max, round(avg(flux), 4) AS mean, quantile_cont(flux, 0.5) AS median, round(stddev_pop(flux), 3) AS std, round(quantile_cont(flux, 0.98), 4) AS high FROM samples GROUP BY fiberid", "samples")
def d29_product_stats(spark, d):
    return r4(r4(P.product_stats(V.samples(spark, d), ["fiberid"]), "mean", "high"), "std", n=3)


@query("SELECT expnum, round(coalesce(avg(CASE WHEN NOT mask THEN flux END), -999.9), 4) AS mean, coalesce(quantile_cont(CASE WHEN NOT mask THEN flux END, 0.5), -999.9) AS median, round(coalesce(stddev_pop(CASE WHEN NOT mask THEN flux END), -999.9), 3) AS std FROM samples GROUP BY expnum", "samples")
def d30_summarize_with_placeholder(spark, d):
    return r4(r4(P.summarize_with_placeholder(V.samples(spark, d), ["expnum"]), "mean"), "std", n=3)


@query(f"""WITH u AS (SELECT spec, part, fiberid, flux FROM samples WHERE part BETWEEN 100 AND 300), {biweight_sql('b', 'u', 'spec, part', 'flux')}, m AS (SELECT spec, avg(location) AS mean, avg(scale) AS rms FROM b GROUP BY spec), n AS (SELECT spec, count(DISTINCT fiberid) AS stars FROM samples GROUP BY spec)
SELECT m.spec, round(mean, 3) AS mean, round(rms, 3) AS rms, stars, CASE WHEN m.spec = 'F' AND mean <= 1e9 THEN 'MOD' WHEN stars >= 8 AND mean <= 1e9 THEN 'STD' ELSE 'NONE' END AS choice FROM m JOIN n ON m.spec = n.spec""", "samples")
def d31_sensitivity_summary(spark, d):
    s = P.sensitivity_summary(V.samples(spark, d), ["spec"], "part", "fiberid", "flux", 100, 300)
    mod = F.when(F.col("spec") == "F", F.col("mean"))
    return r4(s.withColumn("choice", P.choose_calibration(F.col("mean"), F.col("stars"), mod, F.lit(None).cast("double"), 8, 1e9)), "mean", "rms", n=3)


_CURVES = """u AS (SELECT (expnum % 24)::INT AS night, CASE part % 3 WHEN 0 THEN 'STD' WHEN 1 THEN 'MOD' ELSE 'SCI' END AS source, k, fiberid AS star, flux, expnum % 24 % 8 AS c FROM samples),
v AS (SELECT night, source, k, star, CASE WHEN c IN (1, 5) AND source = 'MOD' THEN 0 WHEN c = 2 AND source <> 'SCI' THEN NULL WHEN c = 3 AND source = 'STD' AND k = 1 THEN -flux WHEN c = 4 AND source = 'STD' OR c = 5 AND source = 'SCI' OR c = 6 THEN flux * 1000 WHEN c = 7 AND source = 'MOD' AND star > 3 THEN NULL ELSE flux END AS sens FROM u)"""


@query(f"""WITH {_CURVES}, {biweight_sql("b", "v", "night, source, k", "sens")}, w AS (SELECT night, source, avg(location) AS m, bool_and(location = 0) AS z, bool_or(location < 0) AS neg FROM b GROUP BY ALL), n AS (SELECT night, source, count(DISTINCT star) AS n FROM v WHERE sens IS NOT NULL GROUP BY ALL),
t AS (SELECT night, any_value(m) FILTER (source = 'STD') AS ms, coalesce(bool_or(z) FILTER (source = 'STD'), true) OR coalesce(any_value(n) FILTER (source = 'STD'), 0) < 8 OR coalesce(bool_or(neg) FILTER (source = 'STD'), false) AS bs, coalesce(bool_or(z) FILTER (source = 'STD'), true) AS zs, any_value(m) FILTER (source = 'MOD') AS mm, coalesce(bool_or(z) FILTER (source = 'MOD'), true) OR coalesce(any_value(n) FILTER (source = 'MOD'), 0) < 8 AS bm, coalesce(bool_or(z) FILTER (source = 'MOD'), true) AS zm, any_value(m) FILTER (source = 'SCI') AS mc, coalesce(bool_or(z) FILTER (source = 'SCI'), true) AS zc FROM (SELECT DISTINCT night FROM v) LEFT JOIN w USING (night) LEFT JOIN n USING (night, source) GROUP BY night),
a(asked) AS (VALUES ('STD'), ('MOD')), x AS (SELECT *, CASE WHEN asked = 'STD' AND bs OR asked = 'MOD' AND bm THEN 'SCI' ELSE asked END AS m1 FROM t, a), y AS (SELECT *, CASE WHEN m1 = 'STD' AND coalesce(ms > 1e6, false) THEN 'SCI' ELSE m1 END AS m2 FROM x), q AS (SELECT *, CASE WHEN m2 = 'SCI' AND coalesce(mc > 1e6, false) THEN 'STD' ELSE m2 END AS m3 FROM y),
c AS (SELECT night, asked, CASE WHEN m3 = 'STD' AND (coalesce(ms > 1e6, false) OR zs) OR m3 = 'MOD' AND (coalesce(mm > 1e6, false) OR zm) OR m3 = 'SCI' AND (coalesce(mc > 1e6, false) OR zc) THEN 'NONE' ELSE m3 END AS method FROM q)
SELECT c.night, asked, method, round(m, 3) AS mean FROM c LEFT JOIN w ON w.night = c.night AND w.source = c.method""", "samples")
def d31_choose_sensitivity(spark, d):
    """Nights of eight kinds: plain; models of 0; no standards nor models; negative ones; too high standards; too high science fields; all too high; too few stars."""
    u = V.samples(spark, d).select((F.col("expnum") % 24).cast("int").alias("night"), F.when(F.col("part") % 3 == 0, "STD").when(F.col("part") % 3 == 1, "MOD").otherwise("SCI").alias("source"), "k", F.col("fiberid").alias("star"), F.col("flux").alias("sens"), (F.col("expnum") % 24 % 8).alias("c"))
    c, source = F.col("c"), F.col("source")
    none = F.lit(None).cast("double")
    sens = F.when(c.isin(1, 5) & (source == "MOD"), 0.0).when((c == 2) & (source != "SCI"), none).when((c == 3) & (source == "STD") & (F.col("k") == 1), -F.col("sens")).when((c == 4) & (source == "STD") | (c == 5) & (source == "SCI") | (c == 6), F.col("sens") * 1000).when((c == 7) & (source == "MOD") & (F.col("star") > 3), none).otherwise(F.col("sens"))
    out = None
    for asked in ("STD", "MOD"):
        choice, curve = P.choose_sensitivity(u.withColumn("sens", sens), ["night"], asked, most=1e6)
        one = choice.join(curve.groupBy("night").agg(F.round(F.avg("sens"), 3).alias("mean")), "night", "left")
        out = one if out is None else out.unionByName(one)
    return out.select("night", "asked", "method", "mean")


_BAND = "band(cw, cv) AS (VALUES (0.0, 0.0), (10.0, 0.5), (30.0, 1.0), (50.0, 0.25), (60.0, 0.0)), seg AS (SELECT cw AS a, cv AS u, lead(cw) OVER (ORDER BY cw) AS b, lead(cv) OVER (ORDER BY cw) AS v FROM band)"


def _cells(spark, d):
    band = spark.createDataFrame([(0.0, 0.0), (10.0, 0.5), (30.0, 1.0), (50.0, 0.25), (60.0, 0.0)], "cw double, cv double")
    return V.cells(spark, d).withColumn("wave", F.col("k") + 1.5).withColumn("flux", F.col("flux") + 20000), band


@query(f"""WITH {_BAND}, c AS (SELECT fiberid, k + 1.5 AS w, flux + 20000 AS flux, CASE WHEN k + 1.5 > 60 THEN 0 ELSE u + (k + 1.5 - a) / (b - a) * (v - u) END AS t FROM cells LEFT JOIN seg ON k + 1.5 >= a AND k + 1.5 < b),
p AS (SELECT fiberid, (w - lag(w) OVER x) * (flux * t * w + lag(flux * t * w) OVER x) / 2 AS n, (w - lag(w) OVER x) * (t * w + lag(t * w) OVER x) / 2 AS m FROM c WINDOW x AS (PARTITION BY fiberid ORDER BY w)) SELECT fiberid, round(sum(n) / sum(m), 3) AS band_flux FROM p GROUP BY fiberid""", "cells")
def d32_passband_flux(spark, d):
    c, band = _cells(spark, d)
    return r4(P.passband_flux(c, band, ["fiberid"]), "band_flux", n=3)


@query(f"""WITH {_BAND}, c AS (SELECT fiberid, grp, k + 1.5 AS w, flux + 20000 AS flux, (k % 5 + 1.0) * 10 AS e, u + (k + 1.5 - a) / (b - a) * (v - u) AS t FROM cells LEFT JOIN seg ON k + 1.5 >= a AND k + 1.5 < b WHERE k % 6 <> 2),
z AS (SELECT fiberid, grp, w, flux, e, coalesce(t, 0) AS t FROM c),
p AS (SELECT fiberid, grp, (w - lag(w) OVER x) * (flux * t * w + lag(flux * t * w) OVER x) / 2 AS n, (w - lag(w) OVER x) * (e * e * t * w + lag(e * e * t * w) OVER x) / 2 AS s, (w - lag(w) OVER x) * (t * w + lag(t * w) OVER x) / 2 AS m FROM z WINDOW x AS (PARTITION BY fiberid ORDER BY w)),
f AS (SELECT grp, fiberid, sum(n) / sum(m) AS b, sqrt(sum(s) / sum(m)) AS e FROM p GROUP BY grp, fiberid) SELECT grp, round(min(b), 3) AS min, round(max(b), 3) AS max, round(stddev_pop(b), 3) AS std, round(max(e), 5) AS worst, count(*) AS n FROM f GROUP BY grp""", "cells")
def d32_passband_range(spark, d):
    c, band = _cells(spark, d)
    c = c.withColumn("error", (F.col("k") % 5 + 1.0) * 10).withColumn("mask", F.col("k") % 6 == 2)
    f = P.passband_flux(c, band, ["grp", "fiberid"], error="error", mask="mask")
    worst = f.groupBy("grp").agg(F.round(F.max("band_error"), 5).alias("worst"), F.count(F.lit(1)).alias("n"))
    return r4(P.passband_range(f, ["grp"]), "min", "max", "std", n=3).join(worst, "grp")


@query(f"""WITH {_BAND}, c AS (SELECT fiberid, k + 1.5 AS w, flux + 20000 AS flux, CASE WHEN k + 1.5 >= 60 THEN 0 ELSE u + (k + 1.5 - a) / (b - a) * (v - u) END AS t FROM cells LEFT JOIN seg ON k + 1.5 >= a AND k + 1.5 < b),
p AS (SELECT fiberid, (w - lag(w) OVER x) * (flux * t * w + lag(flux * t * w) OVER x) / 2 AS n, (w - lag(w) OVER x) * (t / w + lag(t / w) OVER x) / 2 AS m FROM c WINDOW x AS (PARTITION BY fiberid ORDER BY w)) SELECT fiberid, round(-2.5 * log10(sum(n) / (sum(m) * 2.99792458e18)) - 48.6, 6) AS mag FROM p GROUP BY fiberid""", "cells")
def h13_ab_mag(spark, d):
    c, band = _cells(spark, d)
    return r4(P.ab_mag(c, band, ["fiberid"]), "mag", n=6)


@query("WITH c AS (SELECT spec, fiberid, sum(flux) AS c FROM samples GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY spec ORDER BY c, fiberid) AS r, count(*) OVER (PARTITION BY spec) AS n FROM c) SELECT spec, quantile_cont(c, 0.5) AS level, count(*) AS n FROM r WHERE r > 1 AND r <= floor(n * 20 / 100) GROUP BY spec", "samples")
def d33_faint_sky_level(spark, d):
    c = V.samples(spark, d).groupBy("spec", "fiberid").agg(F.sum("flux").alias("coadd"))
    return P.faint_sky_level(c, ["spec"], 20)


def _weights(spark, d):
    fib = V.fibermap(spark, d).select("fiberid", (F.col("fiberid") % 20).cast("double").alias("x"), (F.col("fiberid") % 13).cast("double").alias("y"))
    sp = fib.select((F.col("x") / 2).cast("int").alias("ix"), (F.col("y") / 2).cast("int").alias("iy")).distinct().withColumns({"bx": F.col("ix") * 2.0, "by": F.col("iy") * 2.0})
    return P.spaxel_weights(fib, sp, 2.5, 1.2)


@query("""WITH f AS (SELECT fiberid, (fiberid % 20)::DOUBLE AS x, (fiberid % 13)::DOUBLE AS y FROM fibermap), s AS (SELECT DISTINCT floor(x / 2)::INT AS ix, floor(y / 2)::INT AS iy FROM f),
w AS (SELECT fiberid, ix, iy, exp(-0.5 * pow(sqrt((x - ix * 2) * (x - ix * 2) + (y - iy * 2) * (y - iy * 2)) / 1.2, 2)) AS w FROM f JOIN s ON (x - ix * 2) * (x - ix * 2) + (y - iy * 2) * (y - iy * 2) <= 6.25)
SELECT k, ix, iy, round(sum(CASE WHEN NOT mask THEN w * flux END) / sum(CASE WHEN NOT mask THEN w END), 3) AS flux, round(sqrt(sum(CASE WHEN NOT mask THEN w * w * error * error END)) / sum(CASE WHEN NOT mask THEN w END), 6) AS error, count(*) FILTER (NOT mask) AS cover, count(*) FILTER (NOT mask) < 3 AS mask FROM samples JOIN w USING (fiberid) GROUP BY k, ix, iy""", "samples fibermap")
def d36_cube_weighted(spark, d):
    return r4(r4(P.cube_weighted(V.samples(spark, d), _weights(spark, d), ["ix", "iy"], ["k"], least=3), "flux", n=3), "error", n=6)


@query("""WITH f AS (SELECT fiberid, (fiberid % 20)::DOUBLE AS x, (fiberid % 13)::DOUBLE AS y FROM fibermap), s AS (SELECT DISTINCT floor(x / 2)::INT AS ix, floor(y / 2)::INT AS iy FROM f),
o AS (SELECT DISTINCT k, round(0.3 * (k - 3) / 0.5) * 0.5 AS dx, round(-0.2 * (k - 3) / 0.5) * 0.5 AS dy FROM samples),
w AS (SELECT k, fiberid, ix, iy, exp(-0.5 * pow(sqrt((x + dx - ix * 2) * (x + dx - ix * 2) + (y + dy - iy * 2) * (y + dy - iy * 2)) / 1.2, 2)) AS w FROM f, o, s WHERE (x + dx - ix * 2) * (x + dx - ix * 2) + (y + dy - iy * 2) * (y + dy - iy * 2) <= 6.25)
SELECT k, ix, iy, round(sum(CASE WHEN NOT mask THEN w * flux END) / sum(CASE WHEN NOT mask THEN w END), 3) AS flux, round(sqrt(sum(CASE WHEN NOT mask THEN w * w * error * error END)) / sum(CASE WHEN NOT mask THEN w END), 6) AS error, count(*) FILTER (NOT mask) AS cover, count(*) FILTER (NOT mask) < 3 AS mask FROM samples JOIN w USING (fiberid, k) GROUP BY k, ix, iy""", "samples fibermap")
def d36_cube_drifting(spark, d):
    """Fibres that drift with wavelength, in steps of half a unit."""
    fib = V.fibermap(spark, d).select("fiberid", (F.col("fiberid") % 20).cast("double").alias("x"), (F.col("fiberid") % 13).cast("double").alias("y"))
    sp = fib.select((F.col("x") / 2).cast("int").alias("ix"), (F.col("y") / 2).cast("int").alias("iy")).distinct().withColumns({"bx": F.col("ix") * 2.0, "by": F.col("iy") * 2.0})
    s = V.samples(spark, d)
    drift = s.select("k").distinct().withColumns({"dx": F.lit(0.3) * (F.col("k") - 3), "dy": F.lit(-0.2) * (F.col("k") - 3)})
    weights, places = P.drift_weights(fib, sp, drift, ["k"], 2.5, 1.2, step=0.5)
    return r4(r4(P.cube_drifting(s, weights, places, ["ix", "iy"], ["k"], least=3), "flux", n=3), "error", n=6)


@query("SELECT y, x, camera, round(avg(CASE WHEN NOT mask THEN value END), 4) AS value, count(*) FILTER (NOT mask) AS good FROM stack GROUP BY y, x, camera", "stack")
def d37_cube_combine(spark, d):
    return r4(P.cube_combine(V.stack(spark, d), ["y", "x", "camera"], "value"), "value")


@query("SELECT camera, frame, round(sum(pow(value / 1000, 4) * x) / sum(pow(value / 1000, 4)), 5) AS cx, round(sum(pow(value / 1000, 4) * y) / sum(pow(value / 1000, 4)), 5) AS cy FROM stack WHERE (x - 25) * (x - 25) + (y - 50) * (y - 50) <= 400 GROUP BY camera, frame", "stack")
def d38_barycenter(spark, d):
    s = V.stack(spark, d).withColumn("flux", F.col("value") / 1000)
    return r4(P.barycenter(s, ["camera", "frame"], 25, 50, 20), "cx", "cy", n=5)


@query("""WITH m AS (SELECT grp AS model, k, avg(flux) AS m FROM cells GROUP BY ALL), c AS (SELECT fiberid AS star, model, (flux - m) * (flux - m) / (10000 + m * m * 0.05 * 0.05) AS c FROM cells JOIN m USING (k)), s AS (SELECT star, model, sum(c) / count(c) AS chi2 FROM c GROUP BY ALL),
b AS (SELECT star, min(struct_pack(c := chi2, m := model)) AS b FROM s GROUP BY star) SELECT star, b.m AS model, round(b.c, 5) AS chi2 FROM b""", "cells")
def d42_template_match(spark, d):
    c = V.cells(spark, d).withColumn("error", F.lit(100.0))
    models = c.groupBy(F.col("grp").alias("model"), "k").agg(F.avg("flux").alias("flux"))
    return r4(P.template_match(c.withColumnRenamed("fiberid", "star"), models, ["k"]), "chi2", n=5)


@query("""WITH m AS (SELECT grp AS model, k, avg(flux) AS m FROM cells GROUP BY ALL), c AS (SELECT fiberid AS star, k, model, (flux - m) * (flux - m) / (250000 + m * m * 0.05 * 0.05) AS c FROM cells JOIN m USING (k)), s AS (SELECT star, model, sum(c) / count(c) AS chi2 FROM c GROUP BY ALL),
b AS (SELECT star, min(struct_pack(c := chi2, m := model)).m AS m FROM s GROUP BY star), far AS (SELECT c.star, k FROM c JOIN b ON b.star = c.star AND b.m = c.model WHERE c > 6), t AS (SELECT star, model, sum(c) / count(c) AS chi2 FROM c ANTI JOIN far USING (star, k) GROUP BY ALL),
z AS (SELECT star, min(struct_pack(c := chi2, m := model)) AS b FROM t GROUP BY star) SELECT star, b.m AS model, round(b.c, 5) AS chi2 FROM z""", "cells")
def d42_template_match_masked(spark, d):
    """Two passes: samples that fit their star's first model badly are left out of the second."""
    c = V.cells(spark, d).withColumn("error", F.lit(500.0))
    models = c.groupBy(F.col("grp").alias("model"), "k").agg(F.avg("flux").alias("flux"))
    return r4(P.template_match(c.withColumnRenamed("fiberid", "star"), models, ["k"], most=6.0), "chi2", n=5)


@query("""WITH r AS (SELECT grp, k, sum(flux) AS r FROM cells GROUP BY ALL), s AS (SELECT fiberid, s::INT AS shift, sum(flux * r) AS score FROM cells c, range(-5, 6) AS t(s), r WHERE r.grp = c.grp AND r.k = c.k - s GROUP BY ALL),
b AS (SELECT fiberid, max(struct_pack(a := score, n := -abs(shift), l := -shift)) AS b FROM s GROUP BY fiberid) SELECT fiberid, -b.l AS shift, b.a AS score FROM b""", "cells")
def d43_best_shift(spark, d):
    c = V.cells(spark, d)
    ref = c.groupBy("grp", "k").agg(F.sum("flux").alias("flux"))
    full = c.select("fiberid", "grp").distinct().join(ref, "grp").select("fiberid", "k", "flux")
    return P.best_shift(c, full, ["fiberid"], "k", 5).drop("stretch")


@query("""WITH r AS (SELECT fiberid, k, flux AS r FROM cells), t(z) AS (VALUES (0.9::DOUBLE), (1.0), (1.125)), g AS (SELECT fiberid, z, k, k / z AS p FROM r, t), i AS (SELECT fiberid, z, g.k, a.r + (p - floor(p)) * (coalesce(b.r, a.r) - a.r) AS v FROM g JOIN r a USING (fiberid) LEFT JOIN r b ON b.fiberid = a.fiberid AND b.k = a.k + 1 WHERE a.k = floor(g.p) AND p <= 63),
n AS (SELECT fiberid, z, sqrt(sum(v * v)) AS n FROM i GROUP BY ALL), o AS (SELECT fiberid, k, flux + k AS o FROM cells), m AS (SELECT fiberid, sqrt(sum(o * o)) AS n FROM o GROUP BY fiberid),
s AS (SELECT o.fiberid, z, s, sum(o * v) AS score FROM o, range(-3, 4) AS u(s), i WHERE i.fiberid = o.fiberid AND i.k = o.k - s GROUP BY ALL), q AS (SELECT s.fiberid, s.z, s.s, score / (n.n * m.n) AS score FROM s JOIN n ON n.fiberid = s.fiberid AND n.z = s.z JOIN m ON m.fiberid = s.fiberid),
b AS (SELECT fiberid, max(struct_pack(a := score, t := -abs(z - 1), n := -abs(s), l := -s, z := z)) AS b FROM q GROUP BY fiberid) SELECT fiberid, (-b.l)::INT AS shift, b.z AS stretch, round(b.a, 7) AS score FROM b""", "cells")
def d43_best_shift_stretched(spark, d):
    c = V.cells(spark, d).select("fiberid", "k", "flux")
    return r4(P.best_shift(c.withColumn("flux", F.col("flux") + F.col("k")), c, ["fiberid"], "k", 3, stretches=(0.9, 1.0, 1.125), normalize=True), "score", n=7)


@query(None)
def d43_align_profiles(spark, d):
    """Spectra as profiles of blocks of eight fibres, moved by as many places as their group says, against unmoved ones."""
    c = V.cells(spark, d)
    shape = F.when(F.col("k") % 20 < 16, F.lit(1000.0) + F.abs("flux") / 10).otherwise(0.0) * F.when(F.col("k") % 2 == 0, 1.0).otherwise(0.3)
    ref = c.select("fiberid", "grp", "k", shape.alias("flux"))
    moved = ref.withColumn("k", F.col("k") + F.col("grp") - 4)
    return r4(T.align_profiles(moved, ref, ["fiberid"], "k", most=8, fine=2, box=5, distance=1), "shift", "score", n=6)


@query("WITH u AS (SELECT fiberid, k, flux, error, part FROM samples) SELECT fiberid, round(sum(flux * part / (error * error)) / sum(part * part / (error * error)), 6) AS scale FROM u GROUP BY fiberid", "samples")
def d44_template_scale(spark, d):
    return r4(P.template_scale(V.samples(spark, d), ["fiberid"], "flux", "part", "error"), "scale", n=6)


@query("""WITH l(line_wave) AS (VALUES (50.0), (150.0), (251.0)), p AS (SELECT spec, fiberid, line_wave, sum(flux * part) / sum(flux) AS c, sum(flux) / sqrt(sum(error * error)) AS snr FROM samples JOIN l ON abs(part - line_wave) <= 4 GROUP BY ALL),
o AS (SELECT spec, fiberid, quantile_cont(CASE WHEN snr >= 1000 THEN c - line_wave END, 0.5) AS o FROM p GROUP BY ALL) SELECT spec, fiberid, round(CASE WHEN avg((o IS NOT NULL)::INT) OVER (PARTITION BY spec) > 0.5 THEN coalesce(o, 0) ELSE 0 END, 6) AS "offset" FROM o""", "samples")
def d45_wave_offsets(spark, d):
    lines = spark.createDataFrame([(50.0,), (150.0,), (251.0,)], "line_wave double")
    return r4(P.wave_offsets(V.samples(spark, d), lines, ["spec"], snr=1000, wave="part"), "offset", n=6)


@query("""WITH s AS (SELECT tileid, k, sum(flux) AS s FROM samples JOIN (SELECT expnum, tileid % 50 AS tileid FROM frames) USING (expnum) GROUP BY ALL), t AS (SELECT tileid, sum(s) AS t FROM s GROUP BY tileid), b AS (SELECT max(struct_pack(t := t, e := tileid)).e AS b FROM t), r AS (SELECT k, s AS r FROM s, b WHERE tileid = b),
f AS (SELECT tileid, sum(r) / sum(s) AS scale FROM s JOIN r USING (k) GROUP BY tileid) SELECT s.tileid, k, round(s * scale, 3) AS flux FROM s JOIN f USING (tileid)""", "samples frames")
def d46_relative_flux(spark, d):
    s = V.samples(spark, d).join(V.frames(spark, d).select("expnum", (F.col("tileid") % 50).alias("tileid")), "expnum").groupBy("tileid", "k").agg(F.sum("flux").alias("flux"))
    return r4(P.relative_flux(s, "tileid"), "flux", n=3).select("tileid", "k", "flux")


@query("SELECT tileid, 'CCD' AS keyword, count(DISTINCT camera) AS values FROM frames GROUP BY tileid HAVING count(DISTINCT camera) > 1 UNION ALL SELECT tileid, 'TYPE', count(DISTINCT imagetyp) FROM frames GROUP BY tileid HAVING count(DISTINCT imagetyp) > 1", "frames")
def d47_header_consistency(spark, d):
    f = V.frames(spark, d).withColumn("header", F.create_map(F.lit("CCD"), F.col("camera"), F.lit("TYPE"), F.col("imagetyp"), F.lit("EXPOSURE"), F.col("expnum").cast("string"), F.lit("SITE"), F.lit("x")))
    return P.header_consistency(f, ["tileid"], ["EXPOSURE"])


@query("""WITH m AS (SELECT k, fiberid, sum(flux) / sqrt(sum(error * error)) AS snr FROM samples GROUP BY ALL), a AS (SELECT *, quantile_cont(snr, 0.5) OVER (PARTITION BY k) AS med FROM m), b AS (SELECT *, quantile_cont(abs(snr - med), 0.5) OVER (PARTITION BY k) * 1.4826 AS sg FROM a),
c AS (SELECT k, max(struct_pack(s := snr, f := -fiberid)) AS c FROM b WHERE abs(snr - med) > 1.5 * sg GROUP BY k) SELECT k, -c.f AS fiberid, round(c.s, 4) AS snr FROM c""", "samples")
def d48_exposed_standard(spark, d):
    m = V.samples(spark, d).groupBy("k", "fiberid").agg((F.sum("flux") / F.sqrt(F.sum(F.col("error") * F.col("error")))).alias("snr"))
    return r4(P.exposed_standard(m, ["k"], nsigma=1.5), "snr")


@query("SELECT camera, imagetyp, count(DISTINCT tileid % 24) AS seen, count(DISTINCT tileid % 24) >= 24 AS complete FROM frames GROUP BY ALL", "frames")
def d49_sequence_check(spark, d):
    return P.sequence_check(V.frames(spark, d).withColumn("std", F.col("tileid") % 24), ["camera", "imagetyp"], "std", 24)


@query("SELECT fiberid, min(flux) AS min, arg_min(k, flux * 100 + k) AS min_at, max(flux) AS max, arg_max(k, flux * 100 - k) AS max_at FROM cells GROUP BY fiberid", "cells")
def d50_extremum(spark, d):
    return P.extremum(V.cells(spark, d), ["fiberid"], "k")


@query("""WITH a AS (SELECT fiberid, avg(flux) AS a FROM samples WHERE spec = 'O' GROUP BY fiberid), b AS (SELECT fiberid, avg(flux) AS b FROM samples WHERE spec = 'F' GROUP BY fiberid) SELECT expnum, fiberid, k, part, round(flux * a / b, 4) AS flux FROM samples JOIN a USING (fiberid) JOIN b USING (fiberid)""", "samples")
def h12_swap_fluxcal(spark, d):
    s = V.samples(spark, d)
    old, new = (s.where(F.col("spec") == x).groupBy("fiberid").agg(F.avg("flux").alias("sens")) for x in "OF")
    return r4(P.swap_fluxcal(s, old, new, ["fiberid"]), "flux").select("expnum", "fiberid", "k", "part", "flux")
