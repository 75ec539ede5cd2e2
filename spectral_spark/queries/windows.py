"""Queries of windows, sorts and sets (E, F, G)."""

import math

from pyspark.sql import functions as F

from .. import views as V
from ..operators import sets as G
from ..operators import stack as S
from ..operators import windows as W
from ..registry import query
from .spectra import r4



@query("SELECT tileid, expnum, mjd FROM (SELECT *, row_number() OVER (PARTITION BY tileid ORDER BY abs(mjd - 50500), expnum) AS r FROM frames) WHERE r = 1", "frames")
def e1_choose_sequence(spark, d):
    return W.choose_sequence(V.frames(spark, d), "tileid", 50500).select("tileid", "expnum", "mjd")


@query("SELECT tileid, mjd, min(expnum) AS expnum FROM frames GROUP BY tileid, mjd", "frames")
def e2_dedupe_keep_first(spark, d):
    return W.dedupe_keep_first(V.frames(spark, d), ["tileid", "mjd"], "expnum").select("tileid", "mjd", "expnum")


@query("SELECT fiberid, k, coalesce((lead(flux) OVER w - lag(flux) OVER w) / 2, lead(flux) OVER w - flux, flux - lag(flux) OVER w) AS gradient FROM cells WINDOW w AS (PARTITION BY fiberid ORDER BY k)", "cells")
def e3_gradient(spark, d):
    return W.gradient(V.cells(spark, d), ["fiberid"], "k", "flux").select("fiberid", "k", "gradient")


@query("WITH g AS (SELECT *, coalesce((lead(wave) OVER w - lag(wave) OVER w) / 2, lead(wave) OVER w - wave, wave - lag(wave) OVER w) AS g FROM series WINDOW w AS (PARTITION BY fiberid ORDER BY wave)) SELECT fiberid, id, round(flux / nullif(g, 0), 6) AS flux FROM g", "series")
def e4_to_density(spark, d):
    return r4(W.to_density(V.series(spark, d), ["fiberid"], "wave"), "flux", n=6).select("fiberid", "id", "flux")


@query("""WITH s AS (SELECT *, flux - lag(flux) OVER w AS b, lead(flux) OVER w - flux AS a FROM cells WINDOW w AS (PARTITION BY fiberid ORDER BY k)), p AS (SELECT fiberid, k, flux, lead(k) OVER (PARTITION BY fiberid ORDER BY k) - k AS n FROM s WHERE b > 0 AND a <= 0 AND flux > 500),
r AS (SELECT *, row_number() OVER (PARTITION BY fiberid ORDER BY flux DESC, k) AS r FROM p WHERE n >= 3) SELECT fiberid, k, flux FROM r WHERE r <= 4""", "cells")
def e5_find_peaks(spark, d):
    return W.find_peaks(V.cells(spark, d), ["fiberid"], "k", 500, 3, 4).select("fiberid", "k", "flux")


@query("""WITH g AS (SELECT fiberid, k, flux, CASE WHEN (fiberid + k * k) % 4 > 0 THEN flux END AS v FROM cells),
f AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN k END) OVER (PARTITION BY fiberid ORDER BY k ROWS UNBOUNDED PRECEDING) AS b, min(CASE WHEN v IS NOT NULL THEN k END) OVER (PARTITION BY fiberid ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM g)
SELECT f.fiberid, f.k, f.v IS NULL AS filled, round(CASE WHEN b IS NULL THEN y.v WHEN a IS NULL OR a = b THEN x.v ELSE x.v + (f.k - b) / (a - b) * (y.v - x.v) END, 6) AS flux FROM f LEFT JOIN g x ON x.fiberid = f.fiberid AND x.k = b LEFT JOIN g y ON y.fiberid = f.fiberid AND y.k = a""", "cells")
def e6_fill_gaps(spark, d):
    bad = (F.col("fiberid") + F.col("k") * F.col("k")) % 4 == 0
    return r4(W.fill_gaps(V.cells(spark, d), ["fiberid"], "k", bad=bad), "flux", n=6).select("fiberid", "k", "filled", "flux")


@query("SELECT fiberid, k, quantile_cont(flux, 0.5) OVER w AS med, round(avg(flux) OVER w, 6) AS mean FROM cells WINDOW w AS (PARTITION BY fiberid ORDER BY k ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)", "cells")
def e7_running_median(spark, d):
    c = W.running_median(V.cells(spark, d), ["fiberid"], "k", 3, out="med")
    return r4(W.running_mean(c, ["fiberid"], "k", 3, out="mean"), "mean", n=6).select("fiberid", "k", "med", "mean")


@query("""WITH w AS (SELECT i, exp(-0.5 * (i / 1.5) * (i / 1.5)) AS w FROM range(-6, 7) AS r(i)), t AS (SELECT i, w / sum(w) OVER () AS w FROM w)
SELECT c.fiberid, c.k, round(sum(d.flux * w), 4) AS flux FROM cells c, t, cells d WHERE d.fiberid = c.fiberid AND d.k = greatest(least(c.k + i, 63), 0) GROUP BY c.fiberid, c.k""", "cells")
def e7_gauss_smooth(spark, d):
    return r4(W.gauss_smooth(V.cells(spark, d), ["fiberid"], "k", 1.5), "flux").select("fiberid", "k", "flux")


@query("""WITH p AS (SELECT camera, y, x, max(value) AS value FROM stack GROUP BY ALL) SELECT a.camera, a.y, a.x, any_value(a.value) AS value, quantile_cont(b.value, 0.5) AS smooth FROM p a JOIN p b ON a.camera = b.camera AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY a.camera, a.y, a.x""", "stack")
def e7_box_median_2d(spark, d):
    p = V.stack(spark, d).groupBy("camera", "y", "x").agg(F.max("value").alias("value"))
    return W.box_median_2d(p, ["camera"], 1)


@query("""WITH r AS (SELECT DISTINCT camera, y FROM pixels) SELECT camera, y, (CASE WHEN y % 50 < 10 AND y < 50 THEN 0 ELSE 2 * ((y + 40) // 50) END)::INT AS shift FROM r""", "pixels")
def e8_expand_shifts(spark, d):
    rows = V.pixels(spark, d).select("camera", "y").distinct()
    starts = rows.where("y % 50 = 10").withColumn("shift", (2 * F.floor((F.col("y") + 40) / 50)).cast("int"))
    profile = W.expand_shifts(rows, starts, ["camera"])
    again = W.expand_shifts(rows, W.compress_shifts(profile, ["camera"]), ["camera"])
    return again


@query("SELECT fiberid, k, max(flux) OVER (PARTITION BY fiberid ORDER BY k ROWS UNBOUNDED PRECEDING) AS flux FROM cells", "cells")
def e9_monotone_max(spark, d):
    return W.monotone_max(V.cells(spark, d), ["fiberid"], "k", "flux").select("fiberid", "k", "flux")


@query("""WITH c AS (SELECT fiberid, k, (flux > 0)::INT AS v FROM cells), a AS (SELECT *, (lag(v) OVER w IS NULL OR lag(v) OVER w <> v)::INT AS c FROM c WINDOW w AS (PARTITION BY fiberid ORDER BY k)), r AS (SELECT fiberid, k, v, sum(c) OVER (PARTITION BY fiberid ORDER BY k) AS run FROM a),
n AS (SELECT fiberid, run, any_value(v) AS v, count(*) AS n FROM r GROUP BY ALL), m AS (SELECT *, lag(v) OVER w AS b, lead(v) OVER w AS a FROM n WINDOW w AS (PARTITION BY fiberid ORDER BY run)), z AS (SELECT fiberid, run, CASE WHEN n < 3 AND ((v > b AND v > a) OR (v < b AND v < a)) THEN b ELSE v END AS new FROM m)
SELECT fiberid, k, new AS level FROM r JOIN z USING (fiberid, run)""", "cells")
def e9_flatten_runs(spark, d):
    c = V.cells(spark, d).select("fiberid", "k", (F.col("flux") > 0).cast("int").alias("level"))
    return W.flatten_runs(c, ["fiberid"], "k", "level", 3).select("fiberid", "k", "level")


@query("SELECT camera, y, frame, ((x + y % 7) % 50)::INT AS x, value FROM pixels", "pixels")
def e10_shift_rows(spark, d):
    p = V.pixels(spark, d).select("camera", "y", "x", "frame", "value")
    prof = p.select("camera", "y").distinct().withColumn("shift", (F.col("y") % 7).cast("int"))
    return W.shift_rows(p, prof, ["camera"], 50).select("camera", "y", "frame", "x", "value")


_EDGE = "e AS (SELECT fiberid, wave, flux, coalesce((wave + lag(wave) OVER w) / 2, wave - (lead(wave) OVER w - wave) / 2) AS lo, coalesce((wave + lead(wave) OVER w) / 2, wave + (wave - lag(wave) OVER w) / 2) AS hi FROM n WINDOW w AS (PARTITION BY fiberid ORDER BY wave))"


@query(f"""WITH n AS (SELECT fiberid, k * 1.25 + fiberid % 3 * 0.5 AS wave, flux FROM cells), {_EDGE} SELECT fiberid, b::INT AS bin, round(sum(flux * greatest((least(hi, b * 2.0 + 2.0) - greatest(lo, b * 2.0)) / (hi - lo), 0)), 4) AS flux FROM e, range(0, 40) AS r(b) WHERE hi > b * 2.0 AND lo < b * 2.0 + 2.0 GROUP BY fiberid, b""", "cells")
def e11_rebin_conserving(spark, d):
    c = V.cells(spark, d).withColumn("wave", F.col("k") * 1.25 + F.col("fiberid") % 3 * 0.5)
    return r4(W.rebin_conserving(c, ["fiberid"], "k", 0.0, 2.0, 40), "flux")


@query("""WITH n AS (SELECT fiberid, k * 1.25 + fiberid % 3 * 0.5 AS wave, flux, k + 1.0 AS error, k % 9 = 4 AS mask FROM cells), s AS (SELECT *, lead(wave) OVER w AS w2, lead(flux) OVER w AS f2, lead(error) OVER w AS e2, lead(mask) OVER w AS m2 FROM n WINDOW w AS (PARTITION BY fiberid ORDER BY wave))
SELECT fiberid, g::INT AS k, round(flux + (g * 2.0 - wave) / (w2 - wave) * (f2 - flux), 6) AS flux, round(sqrt(pow((1 - (g * 2.0 - wave) / (w2 - wave)) * error, 2) + pow((g * 2.0 - wave) / (w2 - wave) * e2, 2)), 6) AS error, CASE WHEN (g * 2.0 - wave) / (w2 - wave) < 0.5 THEN mask ELSE m2 END AS mask FROM s JOIN range(0, 40) AS r(g) ON g * 2.0 >= wave AND g * 2.0 < w2""", "cells")
def e12_rectify(spark, d):
    c = V.cells(spark, d).withColumns({"wave": F.col("k") * 1.25 + F.col("fiberid") % 3 * 0.5, "error": F.col("k") + 1.0, "mask": F.col("k") % 9 == 4})
    return r4(W.rectify(c, ["fiberid"], "wave", 0.0, 2.0, 40), "flux", "error", n=6)


@query("""WITH p AS (SELECT camera, y, x, max(value) AS v FROM stack GROUP BY ALL),
n AS (SELECT p.*, coalesce(l.v, p.v) AS l, coalesce(r.v, p.v) AS r, coalesce(u.v, p.v) AS u, coalesce(d.v, p.v) AS d FROM p LEFT JOIN p l ON l.camera = p.camera AND l.y = p.y AND l.x = p.x - 1 LEFT JOIN p r ON r.camera = p.camera AND r.y = p.y AND r.x = p.x + 1 LEFT JOIN p u ON u.camera = p.camera AND u.y = p.y - 1 AND u.x = p.x LEFT JOIN p d ON d.camera = p.camera AND d.y = p.y + 1 AND d.x = p.x),
s AS (SELECT camera, y, x, (greatest(2 * v - l - u, 0) + greatest(2 * v - r - u, 0) + greatest(2 * v - l - d, 0) + greatest(2 * v - r - d, 0)) / 4 / (2 * 4096.0) AS s FROM n), m AS (SELECT camera, quantile_cont(s, 0.5) AS m FROM s GROUP BY camera)
SELECT s.camera, y, x, round(s - m, 6) AS score, s - m > 3 AS cosmic FROM s JOIN m ON m.camera = s.camera""", "stack")
def e13_laplacian_outliers(spark, d):
    p = V.stack(spark, d).groupBy("camera", "y", "x").agg(F.max("value").alias("value"))
    return r4(W.laplacian_outliers(p, ["camera"], 3.0, F.lit(4096.0)), "score", n=6).select("camera", "y", "x", "score", "cosmic")


def _laplacian_sql(name: str, source: str, value: str) -> str:
    """Table <name>: source with the positive Laplacian of a value as lap."""
    near = lambda a, dx, dy: f"LEFT JOIN {source} {a} ON {a}.camera = p.camera AND {a}.x = p.x + {dx} AND {a}.y = p.y + {dy}"
    part = lambda a, b: f"greatest(2 * p.{value} - coalesce({a}.{value}, p.{value}) - coalesce({b}.{value}, p.{value}), 0)"
    return f"{name} AS (SELECT p.*, ({part('l', 'u')} + {part('r', 'u')} + {part('l', 'd')} + {part('r', 'd')}) / 4 AS lap FROM {source} p {near('l', -1, 0)} {near('r', 1, 0)} {near('u', 0, -1)} {near('d', 0, 1)})"


def _blur_sql(name: str, source: str, value: str, out: str, by: str, order: str, sigma: float = 1.0) -> str:
    """Table <name>: source with a Gaussian blur along one axis, whose end values stand for what lies beyond."""
    h = int(4 * sigma + 0.5)
    c = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-h, h + 1)]
    at = lambda i: f"coalesce({'lag' if i < 0 else 'lead'}({value}, {abs(i)}) OVER w, {'first' if i < 0 else 'last'}_value({value}) OVER z)" if i else value
    total = " + ".join(f"{at(i)} * {x / sum(c)!r}::DOUBLE" for i, x in zip(range(-h, h + 1), c))
    return f"{name} AS (SELECT *, {total} AS {out} FROM {source} WINDOW w AS (PARTITION BY camera, {by} ORDER BY {order}), z AS (PARTITION BY camera, {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


_BOX = "ON a.camera = b.camera AND abs(a.x - b.x) <= 2 AND abs(a.y - b.y) <= 2 GROUP BY a.camera, a.y, a.x"


@query(f"""WITH p AS (SELECT camera, y, x, max(value) AS value FROM stack GROUP BY ALL), l AS (SELECT a.camera, a.y, a.x, any_value(a.value) AS value, quantile_cont(b.value, 0.5) AS level FROM p a JOIN p b {_BOX}), {_laplacian_sql("g", "l", "value")},
s AS (SELECT camera, y, x, value, lap / (2 * sqrt(greatest(level, 0) + 25.0)) AS s FROM g), t AS (SELECT a.camera, a.y, a.x, any_value(a.value) AS value, any_value(a.s) - quantile_cont(b.s, 0.5) AS score FROM s a JOIN s b {_BOX}),
{_blur_sql("e", "t", "value", "e", "y", "x")}, {_blur_sql("f", "e", "e", "f", "x", "y")}, n AS (SELECT camera, y, x, score, greatest(coalesce(value / nullif(f, 0), 0), 0) AS n FROM f), {_laplacian_sql("z", "n", "n")}
SELECT camera, y, x, round(score, 6) AS score, round(lap, 6) AS fine, score > 20 AND lap > 0.5 AS cosmic FROM z""", "stack")
def e13_cosmic_rays(spark, d):
    p = V.stack(spark, d).groupBy("camera", "y", "x").agg(F.max("value").alias("value"))
    return r4(W.cosmic_rays(p, ["camera"], 20.0, 0.5, 5.0), "score", "fine", n=6).select("camera", "y", "x", "score", "fine", "cosmic")


@query("""WITH c AS (SELECT grp, fiberid, k, CASE WHEN k % 5 < 2 THEN k * 10.0 END AS c, (k % 3 + 5)::DOUBLE AS s FROM cells), t AS (SELECT *, sum(s) OVER (PARTITION BY fiberid ORDER BY k) AS t, max(CASE WHEN c IS NOT NULL THEN k END) OVER (PARTITION BY fiberid ORDER BY k) AS b FROM c)
SELECT t.fiberid, t.k, coalesce(t.c, u.c + t.t - u.t) AS centre FROM t JOIN t u ON u.fiberid = t.fiberid AND u.k = t.b""", "cells")
def e14_gap_positions(spark, d):
    c = V.cells(spark, d).withColumns({"centre": F.when(F.col("k") % 5 < 2, F.col("k") * 10.0), "space": (F.col("k") % 3 + 5).cast("double")})
    return W.gap_positions(c, ["fiberid"], "k", "centre", "space").select("fiberid", "k", "centre")


@query("""WITH c AS (SELECT fiberid, k, CASE WHEN fiberid % 3 = 0 AND k > 40 THEN 2 ELSE 0 END AS a, CASE WHEN fiberid % 2 = 0 AND k > 20 THEN 4 ELSE 0 END AS b FROM cells)
SELECT fiberid, k, CASE WHEN fiberid % 3 = 0 THEN a WHEN fiberid % 2 = 0 THEN b ELSE 0 END AS shift, CASE WHEN fiberid % 3 = 0 THEN 'a' WHEN fiberid % 2 = 0 THEN 'b' ELSE 'none' END AS source FROM c""", "cells")
def e15_choose_shift_source(spark, d):
    c = V.cells(spark, d).withColumns({"a": F.when((F.col("fiberid") % 3 == 0) & (F.col("k") > 40), 2).otherwise(0), "b": F.when((F.col("fiberid") % 2 == 0) & (F.col("k") > 20), 4).otherwise(0)})
    return W.choose_shift_source(c, ["fiberid"], ["a", "b"]).select("fiberid", "k", "shift", "source")


@query("SELECT 0 AS step, camera, expnum FROM frames WHERE imagetyp = 'F' UNION ALL SELECT 1, camera, expnum FROM frames WHERE imagetyp = 'O' UNION ALL SELECT 2, camera, expnum FROM frames WHERE imagetyp = 'F' UNION ALL SELECT 3, camera, expnum FROM frames WHERE imagetyp = 'P'", "frames")
def f1_sort_calibrations(spark, d):
    t = F.col("imagetyp")
    return G.sort_calibrations(V.frames(spark, d), t == "F", t == "O", t == "P").select("step", "camera", "expnum")


@query("WITH s AS (SELECT spec, fiberid, sum(flux) AS flux FROM samples GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY spec ORDER BY flux, fiberid) AS l, row_number() OVER (PARTITION BY spec ORDER BY flux DESC, fiberid) AS h FROM s) SELECT spec, fiberid, flux, CASE WHEN l <= 5 THEN 'min' ELSE 'max' END AS side FROM r WHERE l <= 5 OR h <= 7", "samples")
def f2_select_extreme(spark, d):
    return G.select_extreme(V.samples(spark, d).groupBy("spec", "fiberid").agg(F.sum("flux").alias("flux")), ["spec"], 5, 7)


@query("SELECT camera, least(count(*), 30) AS n, true AS within FROM frames GROUP BY camera", "frames")
def f3_sample_n(spark, d):
    f = V.frames(spark, d)
    s = S.sample_n(f, ["camera"], 30, ["expnum"], 7).select("camera", "expnum")
    known = s.join(f.select("camera", "expnum"), ["camera", "expnum"], "left_semi").groupBy("camera").agg(F.countDistinct("expnum").alias("known"))
    return s.groupBy("camera").agg(F.countDistinct("expnum").alias("n")).join(known, "camera").select("camera", "n", (F.col("n") == F.col("known")).alias("within"))


@query("SELECT camera, imagetyp, expnum, exptime FROM (SELECT *, row_number() OVER (PARTITION BY camera, imagetyp ORDER BY exptime DESC, expnum) AS r FROM frames) WHERE r = 1", "frames")
def f4_largest_exptime(spark, d):
    return G.largest_exptime(V.frames(spark, d), ["camera", "imagetyp"]).select("camera", "imagetyp", "expnum", "exptime")


@query("SELECT 'P1-' || p_partkey AS label, p_partkey::INT AS number FROM part", "")
def f5_sort_by_label_number(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("P1-"), F.col("p_partkey").cast("string")).alias("label"))
    from ..functions.scalars import trailing_number

    return G.sort_by_label_number(p, "label").withColumn("number", trailing_number(F.col("label")))


@query("SELECT expnum, fiberid + 100000 * (CASE spec WHEN 'O' THEN 0 ELSE 1 END) AS fiberid, k, part, CASE spec WHEN 'O' THEN 1 ELSE 2 END AS spectrograph, CASE WHEN spec = 'F' THEN error END AS error FROM samples", "samples")
def g1_stack_spectrographs(spark, d):
    s = V.samples(spark, d)
    out = G.stack_spectrographs([s.where("spec = 'O'").select("expnum", "fiberid", "k", "part"), s.where("spec = 'F'").select("expnum", "fiberid", "k", "part", "error")], 100000)
    return out.select("expnum", "fiberid", "k", "part", "spectrograph", "error")


@query("SELECT camera, y, x // 13 AS part_no, x % 13 AS px, x, frame FROM pixels", "pixels")
def g2_split_parts(spark, d):
    s = G.split_parts(V.pixels(spark, d), 4, 50, "x").withColumn("px", F.col("x")).withColumn("no", F.col("part_no"))
    return G.join_parts(s, 4, 50, "x").select("camera", "y", F.col("no").alias("part_no"), "px", "x", "frame")


@query("SELECT tileid, arg_max(imagetyp, expnum) AS last, arg_min(imagetyp, expnum) AS first FROM frames GROUP BY tileid", "frames")
def g3_merge_headers(spark, d):
    f = V.frames(spark, d).withColumn("header", F.create_map(F.lit("TYPE"), F.col("imagetyp")))
    pick = lambda keep: G.merge_headers(f, ["tileid"], "expnum", keep).select("tileid", F.try_element_at("header", F.lit("TYPE")).alias(keep))
    return pick("last").join(pick("first"), "tileid")


@query("WITH u AS (SELECT fiberid, k, max(flux) AS flux FROM samples WHERE mask GROUP BY ALL), g AS (SELECT DISTINCT k FROM samples), f AS (SELECT DISTINCT fiberid FROM u) SELECT f.fiberid, g.k, flux FROM f CROSS JOIN g LEFT JOIN u ON u.fiberid = f.fiberid AND u.k = g.k", "samples")
def g4_extend_grid(spark, d):
    s = V.samples(spark, d)
    u = s.where("mask").groupBy("fiberid", "k").agg(F.max("flux").alias("flux"))
    return G.extend_grid(u, s.select("k").distinct(), ["fiberid"], "k")


@query("SELECT camera, frame, value, CASE camera WHEN 'A' THEN x WHEN 'N' THEN 99 - x ELSE x END AS x, CASE camera WHEN 'R' THEN 5000 - y ELSE y END AS y FROM pixels", "pixels")
def g5_glue_quadrants(spark, d):
    places = spark.createDataFrame([("A", 0, 0, 50, 1000, False, False), ("N", 50, 0, 50, 1000, True, False), ("R", 0, 1001, 50, 4000, False, True)], "camera string, x0 int, y0 int, width int, height int, flip_x boolean, flip_y boolean")
    return G.glue_quadrants(V.pixels(spark, d), places, "camera").select("camera", "frame", "value", "x", "y")


@query("""WITH a AS (SELECT fiberid, part AS wave, sum(flux) AS flux FROM samples WHERE spec = 'O' GROUP BY ALL), b AS (SELECT fiberid, part AS wave, sum(flux) AS flux FROM samples WHERE spec = 'F' GROUP BY ALL), r AS (SELECT fiberid, quantile_cont(a.flux / b.flux, 0.5) AS r FROM a JOIN b USING (fiberid, wave) GROUP BY fiberid)
SELECT fiberid, wave, round(flux, 4) AS flux FROM a WHERE wave < 500 UNION ALL SELECT fiberid, wave, round(flux * coalesce(r, 1.0), 4) FROM b LEFT JOIN r USING (fiberid) WHERE wave >= 500""", "samples")
def g6_glue_wavelength(spark, d):
    s = V.samples(spark, d)
    part = lambda x: s.where(F.col("spec") == x).groupBy("fiberid", F.col("part").alias("wave")).agg(F.sum("flux").alias("flux"))
    return r4(G.glue_wavelength(part("O"), part("F"), ["fiberid"], 500), "flux")


@query("SELECT fiberid, 'never' AS kind FROM fibermap WHERE fiberid NOT IN (SELECT fiberid FROM samples WHERE mask AND error > 49) UNION ALL SELECT fiberid, 'both' FROM fibermap WHERE fiberid IN (SELECT fiberid FROM samples WHERE error > 49 AND k = 7)", "samples fibermap")
def g7_unexposed(spark, d):
    f, s = V.fibermap(spark, d), V.samples(spark, d)
    never = G.unexposed(f, s.where("mask and error > 49"), "fiberid").withColumn("kind", F.lit("never"))
    return never.union(G.in_both(f, s.where("error > 49 and k = 7"), "fiberid").withColumn("kind", F.lit("both")))


