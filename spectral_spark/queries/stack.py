"""Queries of robust statistics and stacks."""

from pyspark.sql import functions as F

from .. import views as V
from ..functions import robust as R
from ..operators import stack as S
from ..registry import query


def biweight_sql(name: str, source: str, keys: str, value: str) -> str:
    """Tables <name>0..2 and <name>: keys, n, median, mad, location, scale."""
    part = f"PARTITION BY {keys}"
    return f"""{name}0 AS (SELECT {keys}, ({value})::DOUBLE AS v, quantile_cont(({value})::DOUBLE, 0.5) OVER ({part}) AS m FROM {source} WHERE ({value}) IS NOT NULL),
{name}1 AS (SELECT *, quantile_cont(abs(v - m), 0.5) OVER ({part}) AS d FROM {name}0),
{name}2 AS (SELECT *, v - m AS x, (v - m) / nullif(6 * d, 0) AS u, (v - m) / nullif(9 * d, 0) AS t FROM {name}1),
{name} AS (SELECT {keys}, count(*) AS n, min(m) AS median, min(d) AS mad, CASE WHEN min(d) = 0 THEN min(m) ELSE min(m) + sum(x * (1 - u * u) * (1 - u * u)) FILTER (abs(u) < 1) / sum((1 - u * u) * (1 - u * u)) FILTER (abs(u) < 1) END AS location,
CASE WHEN min(d) = 0 THEN 0 ELSE sqrt(count(*) * sum(x * x * pow(1 - t * t, 4)) FILTER (abs(t) < 1)) / abs(sum((1 - t * t) * (1 - 5 * t * t)) FILTER (abs(t) < 1)) END AS scale FROM {name}2 GROUP BY {keys})"""


@query("""SELECT camera, y, x, quantile_cont(CASE WHEN NOT mask THEN value END, 0.5) AS value, round(sqrt(quantile_cont(CASE WHEN NOT mask THEN error * error END, 0.5)), 6) AS error, bool_and(mask) AS mask, count(*) FILTER (NOT mask) AS n FROM stack GROUP BY camera, y, x""", "stack")
def d1_stack(spark, d):
    return S.stack(V.stack(spark, d)).withColumn("error", F.round("error", 6))


@query("""WITH v AS (SELECT camera, y, x, value, quantile_cont(value, 0.5) OVER w AS m, stddev_pop(value) OVER w AS s FROM stack WHERE NOT mask WINDOW w AS (PARTITION BY camera, y, x))
SELECT camera, y, x, round(avg(value), 4) AS value, count(*) AS n FROM v WHERE abs(value - m) <= 1.2345 * s GROUP BY camera, y, x""", "stack")
def d2_stack_clipped(spark, d):
    return S.stack_clipped(V.stack(spark, d), k=1.2345).withColumn("value", F.round("value", 4))


@query(f"""WITH g AS (SELECT fiberid, k, CASE WHEN NOT mask THEN flux END AS v, CASE WHEN NOT mask THEN 1 / (error * error) END AS w, mask FROM samples), {biweight_sql('b', 'g', 'fiberid, k', 'v')},
a AS (SELECT fiberid, k, bool_and(mask) AS mask, round(sum(v * w) / sum(w), 4) AS ivar, round(quantile_cont(v, 0.25), 4) AS q25 FROM g GROUP BY fiberid, k) SELECT a.fiberid, a.k, mask, ivar, q25, round(location, 4) AS biweight FROM a LEFT JOIN b ON a.fiberid = b.fiberid AND a.k = b.k""", "samples")
def d3_combine(spark, d):
    s, key = V.samples(spark, d), ["fiberid", "k"]
    out = S.combine(s, key, "ivar").select(*key, "mask", F.round("flux", 4).alias("ivar"))
    out = out.join(S.combine(s, key, "quantile", 0.25).select(*key, F.round("flux", 4).alias("q25")), key)
    return out.join(S.combine(s, key, "biweight").select(*key, F.round("flux", 4).alias("biweight")), key)


@query(f"WITH {biweight_sql('b', 'samples', 'fiberid, k', 'flux')} SELECT fiberid, k, n, median, mad, round(location, 4) AS location, round(scale, 4) AS scale FROM b", "samples")
def d4_biweight(spark, d):
    return R.biweight_stats(V.samples(spark, d), ["fiberid", "k"], "flux").withColumns({c: F.round(c, 4) for c in ("location", "scale")})


@query("WITH a AS (SELECT fiberid, flux, quantile_cont(flux, 0.5) OVER (PARTITION BY fiberid) AS m FROM samples) SELECT fiberid, min(m) AS median, round(quantile_cont(abs(flux - m), 0.5) * 1.4826, 4) AS sigma FROM a GROUP BY fiberid", "samples")
def d5_mad_stats(spark, d):
    return R.mad_stats(V.samples(spark, d), ["fiberid"], "flux").withColumn("sigma", F.round("sigma", 4))


@query("""WITH p AS (SELECT frame, quantile_cont(value, 0.75) AS p FROM stack GROUP BY frame), t AS (SELECT quantile_cont(p, 0.5) AS t FROM p)
SELECT camera, y, x, frame, round(value * (t / p), 4) AS value FROM stack JOIN p USING (frame), t""", "stack")
def d6_percentile_normalize(spark, d):
    return R.percentile_normalize(V.stack(spark, d), ["frame"], "value", 75).select("camera", "y", "x", "frame", F.round("value", 4).alias("value"))


@query(f"""WITH {biweight_sql('b', 'stack', 'camera, y', 'value')}, z AS (SELECT s.camera, s.y, x, frame, coalesce((value - location) / nullif(scale, 0), 0) AS z FROM stack s JOIN b ON b.camera = s.camera AND b.y = s.y)
SELECT camera, y, x, frame, round(z, 6) AS z, avg((abs(z) > 1.2)::INT) OVER (PARTITION BY camera, x) > 0.3 AS outlier FROM z""", "stack")
def d7_zscore_mask(spark, d):
    return R.zscore_mask(V.stack(spark, d), ["camera", "y"], ["camera", "x"], "value", 1.2).select("camera", "y", "x", "frame", F.round("z", 6).alias("z"), "outlier")


@query(f"""WITH {biweight_sql('b', 'pixels', 'camera, y', 'value')}, r AS (SELECT camera, y, stddev_pop(value) AS s FROM pixels GROUP BY ALL), q AS (SELECT camera, round(quantile_cont(s, 0.5) * 2.5, 4) AS readnoise FROM r GROUP BY camera), l AS (SELECT camera, quantile_cont(value, 0.5) AS median FROM pixels GROUP BY camera)
SELECT b.camera, y, round(location, 4) AS level, l.median, readnoise FROM b JOIN q ON q.camera = b.camera JOIN l ON l.camera = b.camera""", "pixels")
def d8_overscan_profile(spark, d):
    p = V.pixels(spark, d)
    q = S.quadrant_stats(p, ["camera"], gain=2.5).select("camera", F.col("level").alias("median"), F.round("readnoise", 4).alias("readnoise"))
    return S.overscan_profile(p, ["camera"]).withColumn("level", F.round("level", 4)).join(F.broadcast(q), "camera")


@query("""WITH p AS (SELECT camera, frame, quantile_cont(value, 0.75) AS p FROM stack GROUP BY ALL), f AS (SELECT camera, frame, quantile_cont(p, 0.5) OVER (PARTITION BY camera) / p AS f FROM p)
SELECT camera, y, x, round(quantile_cont(CASE WHEN NOT mask THEN value * f END, 0.5), 4) AS value, bool_and(mask) AS mask, count(*) FILTER (NOT mask) AS n FROM stack JOIN f USING (camera, frame) GROUP BY camera, y, x""", "stack")
def d9_make_master(spark, d):
    return S.make_master(V.stack(spark, d), "flat").select("camera", "y", "x", F.round("value", 4).alias("value"), "mask", "n")


@query("WITH m AS (SELECT tileid, imagetyp, count(*) AS n FROM frames GROUP BY ALL) SELECT tileid, (list(imagetyp ORDER BY n DESC, imagetyp))[1] AS imagetyp FROM m GROUP BY tileid", "frames")
def d9_majority(spark, d):
    return S.majority(V.frames(spark, d), ["tileid"])


@query("SELECT camera, imagetyp, tileid, array_to_string(list(expnum ORDER BY expnum), ',') AS members, count(*) AS n FROM frames GROUP BY ALL", "frames")
def d10_analog_groups(spark, d):
    return S.analog_groups(V.frames(spark, d), ["camera", "imagetyp", "tileid"]).withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query("""WITH s AS (SELECT camera, y, x, min(value) AS s, max(value) AS l, min(error) AS a, max(error) AS b FROM stack GROUP BY ALL)
SELECT camera, y, x, l / s > 3.0 AS hot, l / s < 1.1 OR a / b < 0.3 OR a / b > 0.98 AS cold FROM s""", "stack")
def d11_pixel_mask(spark, d):
    s, key = V.stack(spark, d), ["camera", "y", "x"]
    of = lambda c: s.groupBy(*key).agg(c.alias("value"))
    return S.pixel_mask(of(F.min("value")), of(F.max("value")), of(F.min("error")), of(F.max("error")), key, 3.0, 1.1, 0.3, 0.98)


@query("SELECT camera, (y // 4)::INT AS y, x // 5 AS x, sum(value) AS value, round(sqrt(sum(error * error)), 6) AS error, bool_or(mask) AS mask FROM pixels GROUP BY camera, y // 4, x // 5", "pixels")
def d34_rebin_sum(spark, d):
    return S.rebin_sum(V.pixels(spark, d), 5, 4).withColumn("error", F.round("error", 6))


@query(f"""WITH h AS (SELECT camera, (y // 10)::INT AS strip, x // 10 AS bin, value FROM pixels WHERE y % 10 <= 3), a AS (SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY camera, strip, bin) AS med FROM h),
c AS (SELECT *, quantile_cont(abs(value - med), 0.5) OVER (PARTITION BY camera, strip, bin) * 1.4826 AS sg FROM a), k AS (SELECT camera, strip, bin, value FROM c WHERE abs(value - med) <= 1.7 * sg), {biweight_sql('b', 'k', 'camera, strip, bin', 'value')}
SELECT camera, strip, bin, n, round(location, 4) AS value, round(scale, 4) AS error FROM b""", "pixels")
def d35_strip_bins(spark, d):
    p = V.pixels(spark, d)
    strips = p.select((F.floor(F.col("y") / 10)).cast("int").alias("strip")).distinct().withColumns({"y0": F.col("strip") * 10, "y1": F.col("strip") * 10 + 3})
    return S.strip_bins(p, strips, 10, 1.7).withColumns({c: F.round(c, 4) for c in ("value", "error")})


@query("""WITH v AS (SELECT camera, (y // 20)::INT AS strip, x // 5 AS bin, avg(value) AS value FROM pixels GROUP BY ALL), a AS (SELECT *, quantile_cont(value, 0.5) OVER w AS med FROM v WINDOW w AS (PARTITION BY camera, strip)), c AS (SELECT *, abs(value - med) > 2 * 1.4826 * quantile_cont(abs(value - med), 0.5) OVER (PARTITION BY camera, strip) AS clipped FROM a),
g AS (SELECT *, last_value(CASE WHEN NOT clipped THEN bin END IGNORE NULLS) OVER u AS b0, last_value(CASE WHEN NOT clipped THEN value END IGNORE NULLS) OVER u AS v0, first_value(CASE WHEN NOT clipped THEN bin END IGNORE NULLS) OVER f AS b1, first_value(CASE WHEN NOT clipped THEN value END IGNORE NULLS) OVER f AS v1 FROM c
WINDOW u AS (PARTITION BY camera, strip ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY camera, strip ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT camera, strip, bin, clipped, round(CASE WHEN NOT clipped THEN value WHEN b0 IS NULL THEN v1 WHEN b1 IS NULL THEN v0 ELSE v0 + (bin - b0) / (b1 - b0) * (v1 - v0) END, 4) AS value FROM g""", "pixels")
def d35_clean_bins(spark, d):
    p = V.pixels(spark, d).groupBy("camera", F.floor(F.col("y") / 20).cast("int").alias("strip"), F.floor(F.col("x") / 5).cast("int").alias("bin")).agg(F.avg("value").alias("value"))
    return S.clean_bins(p, 2.0).withColumn("value", F.round("value", 4))
