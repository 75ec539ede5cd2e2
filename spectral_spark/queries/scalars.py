"""Queries of column functions (H, A11, B15, B17)."""

from pyspark.sql import functions as F

from .. import views as V
from ..functions import scalars as S
from ..operators.spectra import apply_fluxcal
from ..operators.windows import linear_to_log, log_to_linear
from ..registry import query

R = S.rounded


@query("SELECT event_id, round(epoch(ts)::DOUBLE / 86400 + 40587, 6) AS mjd, floor(epoch(ts)::DOUBLE / 86400 + 40587 + 0.4)::INT AS night, round(epoch(ts)::DOUBLE / 86400 + 40587 + 0.4 - 0.4, 6) AS back FROM events")
def h1_to_mjd(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet")
    return ev.select("event_id", R(S.to_mjd(F.col("ts"))).alias("mjd"), F.floor(S.to_sjd(F.col("ts"))).cast("int").alias("night"), R(S.sjd_to_mjd(S.to_sjd(F.col("ts")))).alias("back"))


@query("SELECT page_id, coalesce(nullif(regexp_extract(url, '/([0-9]{3})(?:[/?#.]|$)', 1), '')::INT, page_id::INT) AS night FROM pages")
def h2_night_from_path(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", S.night_from_path(F.col("url"), F.col("page_id"), r"/([0-9]{3})(?:[/?#.]|$)").alias("night"))


@query("SELECT expnum, lpad((tileid // 1000)::VARCHAR, 4, '0') || 'XX' AS tilegrp, count(*) OVER (PARTITION BY tileid // 1000) AS n FROM frames", "frames")
def h3_tile_group(spark, d):
    f = V.frames(spark, d)
    groups = f.groupBy(S.tile_group(F.col("tileid")).alias("tilegrp")).agg(F.count(F.lit(1)).alias("n"))
    return f.select("expnum", S.tile_group(F.col("tileid")).alias("tilegrp")).join(groups, "tilegrp").select("expnum", "tilegrp", "n")


@query("SELECT expnum, 's' AS hemi, 'b' || (tileid % 3 + 1) AS camera, 'sp' || (tileid % 3 + 1) AS spec, expnum AS parsed, tileid::VARCHAR AS tile, mjd::VARCHAR AS night, expnum::VARCHAR AS product FROM frames", "frames")
def h4_parse_names(spark, d):
    f = V.frames(spark, d)
    n = F.lpad(F.col("expnum").cast("string"), 8, "0")
    name = F.concat(F.lit("raw-s-b"), (F.col("tileid") % 3 + 1).cast("string"), F.lit("-"), n, F.lit(".fits.gz"))
    path = F.concat(F.lit("/data/"), S.tile_group(F.col("tileid")), F.lit("/"), F.col("tileid").cast("string"), F.lit("/"), F.col("mjd").cast("string"), F.lit("/sky-"), n, F.lit(".fits"))
    out = f.select("expnum", S.parse_frame_name(name).alias("a"), S.parse_product_path(path).alias("b"))
    return out.select("expnum", "a.hemi", "a.camera", "a.spec", F.col("a.expnum").alias("parsed"), "b.tile", "b.night", F.col("b.expnum").alias("product"))


@query("""WITH p AS (SELECT s_suppkey AS id, (s_suppkey * 7 % 360)::DOUBLE AS ra, (s_suppkey * 3 % 160 - 80)::DOUBLE AS dec FROM supplier),
c AS (SELECT id, ra, dec, sin(radians(dec)) * sin(radians(-30.0)) + cos(radians(dec)) * cos(radians(-30.0)) * cos(radians(ra - 120.0)) AS c FROM p)
SELECT id, CASE WHEN c >= 1 THEN 0.0 ELSE round(degrees(acos(greatest(c, -1.0))), 6) END AS distance FROM c""")
def h5_angular_distance(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet")
    ra, dec = (F.col("s_suppkey") * 7 % 360).cast("double"), (F.col("s_suppkey") * 3 % 160 - 80).cast("double")
    return s.select(F.col("s_suppkey").alias("id"), R(S.angular_distance(ra, dec, F.lit(120.0), F.lit(-30.0))).alias("distance"))


@query("""WITH p AS (SELECT fiberid, radians((fiberid % 41 - 20) * 112.36748321030637 / 3600.0) AS u, radians(ypmm * 112.36748321030637 / 3600.0) AS v FROM fibermap),
q AS (SELECT fiberid, u * cos(radians(30.0)) - v * sin(radians(30.0)) AS xi, u * sin(radians(30.0)) + v * cos(radians(30.0)) AS eta FROM p)
SELECT fiberid, round(150.0 + degrees(atan2(xi, cos(radians(-40.0)) - eta * sin(radians(-40.0)))), 6) AS ra,
round(degrees(atan2(sin(radians(-40.0)) + eta * cos(radians(-40.0)), sqrt(xi * xi + (cos(radians(-40.0)) - eta * sin(radians(-40.0))) * (cos(radians(-40.0)) - eta * sin(radians(-40.0)))))), 6) AS dec FROM q""", "fibermap")
def h6_fiber_sky_position(spark, d):
    p = S.fiber_sky_position((F.col("fiberid") % 41 - 20).cast("double"), F.col("ypmm"), F.lit(150.0), F.lit(-40.0), F.lit(30.0))
    return V.fibermap(spark, d).select("fiberid", p.alias("p")).select("fiberid", R(F.col("p.ra")).alias("ra"), R(F.col("p.dec")).alias("dec"))


@query("""SELECT fiberid, ypmm + 1.5 AS ox, 2.0 * ypmm AS sx, round(ypmm * cos(radians(25.0)) - 3.0 * sin(radians(25.0)), 6) AS rx, round(ypmm * sin(radians(25.0)) + 3.0 * cos(radians(25.0)), 6) AS ry FROM fibermap""", "fibermap")
def h7_transform_positions(spark, d):
    y = F.col("ypmm")
    rx, ry = S.rotate_positions(y, F.lit(3.0), 25.0)
    return V.fibermap(spark, d).select("fiberid", S.offset_positions(y, y, 1.5, 0.0)[0].alias("ox"), S.scale_positions(y, y, 2.0)[0].alias("sx"), R(rx).alias("rx"), R(ry).alias("ry"))


@query("SELECT expnum, fiberid, k, part, round(flux * 2.5 / 900.0, 6) AS rate, round(flux / 2.5, 6) AS adu, error FROM samples", "samples")
def h8_convert_unit(spark, d):
    g, t = F.lit(2.5), F.lit(900.0)
    return V.samples(spark, d).select("expnum", "fiberid", "k", "part", R(S.convert_unit(F.col("flux"), g, t, "adu", "electron/s")).alias("rate"), R(S.convert_unit(F.col("flux"), g, t, "electron", "adu")).alias("adu"), "error")


@query("SELECT expnum, fiberid, k, part, CASE WHEN k = 7 THEN 2.7 ELSE round(1 / (0.35 + 0.01 * 1.1 * pow(flux, 0.1)), 6) END AS gain FROM samples", "samples")
def h9_nonlinear_gain(spark, d):
    a1 = F.when(F.col("k") == 7, F.lit(None)).otherwise(0.35)
    g = S.nonlinear_gain(F.col("flux"), a1, F.lit(0.01), F.lit(1.1), F.lit(2.7))
    return V.samples(spark, d).select("expnum", "fiberid", "k", "part", R(g).alias("gain"))


@query("SELECT expnum, fiberid, k, part, CASE WHEN flux - 20000 > 0 THEN round(sqrt(flux - 20000 + 3.5 * 3.5), 6) ELSE 3.5 END AS err FROM samples", "samples")
def h10_poisson_error(spark, d):
    return V.samples(spark, d).select("expnum", "fiberid", "k", "part", R(S.poisson_error(F.col("flux") - 20000, F.lit(3.5))).alias("err"))


@query("SELECT fiberid, round(pow(10.0, 0.4 * (0.1 + 0.01 * (fiberid % 20)) * 1.3), 6) AS factor FROM fibermap", "fibermap")
def h11_extinction_factor(spark, d):
    return V.fibermap(spark, d).select("fiberid", R(S.extinction_factor(F.lit(0.1) + F.lit(0.01) * (F.col("fiberid") % 20), F.lit(1.3))).alias("factor"))


@query("""WITH f AS (SELECT fiberid, telescope, CASE WHEN telescope = 'ASIA' THEN CASE WHEN fiberid % 2 = 0 THEN 40.0 + fiberid % 9 ELSE 900.0 / 12 END ELSE 900.0 END AS t, CASE telescope WHEN 'ASIA' THEN 1.2 + (fiberid % 5) / 100.0 WHEN 'EUROPE' THEN 1.5 WHEN 'AFRICA' THEN 1.2 + (fiberid % 5) / 100.0 END AS x FROM fibermap),
s AS (SELECT s.*, 10.0 * part / 7 AS w, telescope, t, x, CASE WHEN k <= 5 THEN 1.0 + k / 10.0 END AS sens FROM samples s JOIN f USING (fiberid)), m AS (SELECT *, pow(10.0::DOUBLE, 0.4 * x * CASE WHEN w <= 50 THEN 0.4 WHEN w >= 250 THEN 0.1 ELSE 0.4 + (w - 50) / 200 * (0.1 - 0.4) END) * sens / t AS c FROM s)
SELECT expnum, fiberid, k, part, round(flux * c, 5) AS flux, round(error * c, 8) AS error FROM m""", "samples fibermap")
def h11_apply_fluxcal(spark, d):
    """Airmass by telescope, exposure time by the fibre's class; samples without sensitivity or airmass become null."""
    own = F.lit(1.2) + (F.col("fiberid") % 5) / 100.0
    fib = V.fibermap(spark, d).select("fiberid", F.when(F.col("telescope") == "ASIA", "Spec").otherwise(F.col("telescope")).alias("telescope"), F.lit(900.0).alias("exptime"), F.when((F.col("telescope") == "ASIA") & (F.col("fiberid") % 2 == 0), 40.0 + F.col("fiberid") % 9).alias("std_exptime"), own.alias("x_sci"), F.lit(1.5).alias("x_e"))
    s = V.samples(spark, d).join(fib, "fiberid").withColumn("wave", F.lit(10.0) * F.col("part") / 7)
    sens = s.select("k").distinct().where("k <= 5").withColumn("sens", F.lit(1.0) + F.col("k") / 10.0)
    curve = spark.createDataFrame([(50.0, 0.4), (250.0, 0.1)], "cw double, cv double")
    out = apply_fluxcal(s, sens, curve, ["k"], {"Spec": "x_sci", "AFRICA": "x_sci", "EUROPE": "x_e"})
    return out.select("expnum", "fiberid", "k", "part", R(F.col("flux"), 5).alias("flux"), R(F.col("error"), 8).alias("error"))


_LOGS = """g AS (SELECT i, ln(100.0::DOUBLE) + i * (ln(163.0::DOUBLE) - ln(100.0::DOUBLE)) / (n - 1) AS x FROM (SELECT ceil((ln(163.0::DOUBLE) - ln(100.0::DOUBLE)) / (ln(163.0::DOUBLE) - ln(162.0::DOUBLE)))::INT AS n), range(0, n) AS t(i)),
p AS (SELECT fiberid, k, ln(100.0::DOUBLE + k) AS a, ln(101.0::DOUBLE + k) AS b, flux AS u, lead(flux) OVER (PARTITION BY fiberid ORDER BY k) AS v FROM cells), l AS (SELECT fiberid, i, x, u + (x - a) / (b - a) * (v - u) AS flux FROM p JOIN g ON v IS NOT NULL AND (x >= a OR i = 0 AND k = 0) AND (x < b OR k = 62 AND x >= a))"""


@query(f"WITH {_LOGS} SELECT fiberid, i::INT AS k, round(x, 9) AS log_wave, round(flux, 4) AS flux FROM l", "cells")
def h19_linear_to_log(spark, d):
    return linear_to_log(V.cells(spark, d).withColumn("wave", F.col("k") + 100.0), ["fiberid"]).select("fiberid", "k", R(F.col("log_wave"), 9).alias("log_wave"), R(F.col("flux"), 4).alias("flux"))


@query(f"""WITH {_LOGS}, s AS (SELECT fiberid, exp(x + 0.001) AS a, flux AS u, lead(exp(x + 0.001)) OVER w AS b, lead(flux) OVER w AS v FROM l WINDOW w AS (PARTITION BY fiberid ORDER BY x)), e AS (SELECT fiberid, arg_min(u, a) AS first, min(a) AS lo FROM s GROUP BY fiberid)
SELECT c.fiberid, c.k, round(CASE WHEN 100.0 + c.k <= lo THEN first ELSE u + (100.0 + c.k - a) / (b - a) * (v - u) END, 4) AS flux FROM cells c JOIN e USING (fiberid) LEFT JOIN s ON s.fiberid = c.fiberid AND 100.0 + c.k > a AND 100.0 + c.k <= b""", "cells")
def h19_log_to_linear(spark, d):
    c = V.cells(spark, d).withColumn("wave", F.col("k") + 100.0)
    return log_to_linear(c, linear_to_log(c, ["fiberid"]), ["fiberid"], 0.001).select("fiberid", "k", R(F.col("flux"), 4).alias("flux"))


@query("SELECT expnum, fiberid, k, part, round(-2.5 * log10(flux) - 48.6, 6) AS mag, round(pow(10.0, -0.4 * ((-2.5 * log10(flux) - 48.6) + 48.6)), 3) AS back FROM samples WHERE flux > 0", "samples")
def h13_magnitudes(spark, d):
    m = S.flux_to_mag(F.col("flux"))
    return V.samples(spark, d).where("flux > 0").select("expnum", "fiberid", "k", "part", R(m).alias("mag"), R(S.mag_to_flux(m), 3).alias("back"))


@query("SELECT expnum, fiberid, k, part, round(exp(-0.5 * ((3600.0 + part - CASE k % 3 WHEN 0 THEN 4500.0 WHEN 1 THEN 6500.0 ELSE 8500.0 END) / 250.0) * ((3600.0 + part - CASE k % 3 WHEN 0 THEN 4500.0 WHEN 1 THEN 6500.0 ELSE 8500.0 END) / 250.0)), 9) AS t FROM samples", "samples")
def h14_gaussian_band(spark, d):
    channel = F.element_at(F.array(F.lit("b"), F.lit("r"), F.lit("z")), (F.col("k") % 3 + 1).cast("int"))
    return V.samples(spark, d).select("expnum", "fiberid", "k", "part", R(S.gaussian_band(channel, F.lit(3600.0) + F.col("part")), 9).alias("t"))


@query("""WITH p AS (SELECT p_partkey AS id, 10000.0 / (4000.0 + p_partkey % 5000) - 1.82 AS y FROM part),
q AS (SELECT id, 1.0 + y * (0.17699 + y * (-0.50447 + y * (-0.02427 + y * (0.72085 + y * (0.01979 + y * (-0.77530 + y * 0.32999)))))) + (y * (1.41338 + y * (2.28305 + y * (1.07233 + y * (-5.38434 + y * (-0.62251 + y * (5.30260 + y * -2.09002))))))) / 3.1 AS a FROM p)
SELECT id, round(a, 6) AS a, round(100.0 * pow(10.0, 0.4 * 0.5 * a), 6) AS flux FROM q""")
def h15_galactic_extinction(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), (F.lit(4000.0) + F.col("p_partkey") % 5000).alias("w"))
    return p.select("id", R(S.galactic_extinction(F.col("w"), F.lit(3.1))).alias("a"), R(S.deredden(F.lit(100.0), F.col("w"), F.lit(0.5), F.lit(3.1))).alias("flux"))


@query("""SELECT fiberid, round(pow(0.9, (1.0 + (4.0 / 2.5 - 1.0) * 0.3) * (1.0 / (cos(radians((fiberid % 60)::DOUBLE)) + 0.025 * exp(-11.0 * cos(radians((fiberid % 60)::DOUBLE)))))), 6) AS t FROM fibermap""", "fibermap")
def h16_telluric_transmission(spark, d):
    t = S.telluric_transmission(F.lit(0.9), F.lit(0.3), F.lit(4.0), zenith=(F.col("fiberid") % 60).cast("double"))
    return V.fibermap(spark, d).select("fiberid", R(t).alias("t"))


@query("""WITH c AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c, unnest(range(0, 16)) AS x FROM embeddings)
SELECT vec_id AS fiberid, x::INT AS x, round((c * x + b) * x + a, 6) AS wave, round((c * x + b) * x + (a - 0.25), 6) AS shifted FROM c""")
def h17_eval_poly(spark, d):
    s = V.spectra(spark, d).withColumn("c", F.transform(F.slice("flux", 1, 3), lambda v: v.cast("double")))
    s = s.select("fiberid", F.posexplode(F.arrays_zip(S.poly_samples(F.col("c"), 0, 15).alias("a"), S.poly_samples(S.shift_wave(F.col("c"), F.lit(0.25)), 0, 15).alias("b"))).alias("x", "v"))
    return s.select("fiberid", "x", R(F.col("v.a")).alias("wave"), R(F.col("v.b")).alias("shifted"))


@query("""SELECT vec_id AS fiberid, round(embedding[1]::DOUBLE - 0.5, 6) AS c0, round(embedding[2]::DOUBLE, 6) AS c1 FROM embeddings""")
def h18_shift_wave(spark, d):
    c = S.shift_wave(F.slice("flux", 1, 2), F.lit(0.5))
    return V.spectra(spark, d).select("fiberid", c.alias("c")).select("fiberid", R(F.get("c", F.lit(0))).alias("c0"), R(F.get("c", F.lit(1))).alias("c1"))


@query("""SELECT grp, i::INT AS i, round(exp(ln(3600.0) + i * ((ln(9800.0) - ln(3600.0)) / 31)), 6) AS wave, n FROM (SELECT label AS grp, count(*) AS n FROM embeddings GROUP BY label), range(0, 32) AS r(i)""")
def h19_log_grid(spark, d):
    g = V.spectra(spark, d).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return g.select("grp", "n", F.posexplode(S.log_grid(3600.0, 9800.0, 32)).alias("i", "wave")).select("grp", "i", R(F.col("wave")).alias("wave"), "n")


@query("""WITH p(a, u) AS (VALUES (0.0, 0.0), (4.0, 0.0), (6.0, 0.05), (8.0, 0.12), (10.0, 0.15), (12.0, 0.2), (14.0, 0.2), (16.0, 0.2)),
s AS (SELECT a, pow(10.0, -0.4 * u::DOUBLE) AS u, lead(a) OVER (ORDER BY a) AS b, lead(pow(10.0, -0.4 * u::DOUBLE)) OVER (ORDER BY a) AS v FROM p),
x AS (SELECT fiberid, (fiberid % 37) / 2.0 AS dist FROM fibermap)
SELECT fiberid, round(coalesce(u + (dist - a) / (b - a) * (v - u), pow(10.0, -0.08)), 6) AS f FROM x LEFT JOIN s ON (dist > a OR (dist = 0 AND a = 0)) AND dist <= b""", "fibermap")
def h20_radius_factor(spark, d):
    return V.fibermap(spark, d).select("fiberid", R(S.radius_factor(F.col("fiberid") % 37 / 2.0)).alias("f"))


@query("SELECT expnum, fiberid, k, part, CASE WHEN k = 3 THEN -999.9 ELSE flux END AS v FROM samples", "samples")
def h21_placeholder(spark, d):
    v = F.when(F.col("k") == 3, F.when(F.col("fiberid") % 2 == 0, F.lit(float("nan")))).otherwise(F.col("flux"))
    return V.samples(spark, d).select("expnum", "fiberid", "k", "part", S.placeholder(v).alias("v"))


@query("SELECT p_partkey + 1 AS fiberid, (p_partkey // 648 + 1)::INT AS spec, (p_partkey // 324 + 1)::INT AS quad, (p_partkey // 36 + 1)::INT AS block FROM part")
def h22_fiber_group(spark, d):
    p = F.col("p_partkey") + 1
    return spark.read.parquet(f"{d}/part.parquet").select(p.alias("fiberid"), *[S.fiber_group(p, by).alias(by) for by in ("spec", "quad", "block")])


@query("SELECT expnum, fiberid, k, part, CASE WHEN error - 10 > 0 THEN round(1 / sqrt(error - 10), 6) END AS err, round(1 / (error * error), 9) AS ivar FROM samples", "samples")
def a11_ivar_error(spark, d):
    return V.samples(spark, d).select("expnum", "fiberid", "k", "part", R(S.ivar_to_error(F.col("error") - 10)).alias("err"), R(S.error_to_ivar(F.col("error")), 9).alias("ivar"))


@query("""SELECT tileid, (bit_or(expnum % 8) | 4)::BIGINT AS flags, (bit_or(expnum % 8) & 2) <> 0 AS has, ((bit_or(expnum % 8) & ~7) | 2)::BIGINT AS status,
concat_ws(',', CASE WHEN bit_or(expnum % 8) & 1 <> 0 THEN 'IN_PROGRESS' END, CASE WHEN bit_or(expnum % 8) & 2 <> 0 THEN 'FINISHED' END, CASE WHEN bit_or(expnum % 8) & 4 <> 0 THEN 'FAILED' END) AS names FROM frames GROUP BY tileid""", "frames")
def b15_flags(spark, d):
    g = V.frames(spark, d).groupBy("tileid").agg(F.bit_or(F.col("expnum") % 8).alias("m"))
    m = F.col("m")
    return g.select("tileid", S.flag_add(m, 4).alias("flags"), S.flag_has(m, 1).alias("has"), S.flag_set_exclusive(m, 1, 7).alias("status"), S.flag_names(m, ["IN_PROGRESS", "FINISHED", "FAILED"]).alias("names"))
