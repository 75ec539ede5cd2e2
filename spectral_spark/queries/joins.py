"""Queries of joins (C)."""

import uuid

from pyspark.sql import functions as F

from .. import views as V
from ..operators import joins as J
from ..registry import query, solve_sql


def _part(spark, d):
    return spark.read.parquet(f"{d}/part.parquet")


@query(r"""WITH r(no, p, w, v) AS (VALUES (1, '^raw-.*-000.*4$', 'OBJECT', 'grid'), (2, '^raw-.-b1-.*5.$', 'OBJECT', 'sky'), (3, '^raw-.*-0000[2-5].*7$', 'TARGET', 't7')),
f AS (SELECT *, 'raw-s-b' || (tileid % 3 + 1) || '-' || lpad(expnum::VARCHAR, 8, '0') AS name FROM frames),
h AS (SELECT expnum, w, max_by(v, no) AS v FROM f JOIN r ON regexp_matches(name, p) GROUP BY expnum, w)
SELECT f.expnum, coalesce(o.v, 'old') AS OBJECT, coalesce(t.v, 'none') AS TARGET FROM f LEFT JOIN h o ON o.expnum = f.expnum AND o.w = 'OBJECT' LEFT JOIN h t ON t.expnum = f.expnum AND t.w = 'TARGET'""", "frames")
def c1_apply_header_fixes(spark, d):
    fixes = spark.createDataFrame([(1, "raw-*-000*4", "OBJECT", "grid"), (2, "raw-?-b1-*5?", "OBJECT", "sky"), (3, "raw-*-0000[2-5]*7", "TARGET", "t7")], "rule_no int, fileroot string, keyword string, value string")
    name = F.concat(F.lit("raw-s-b"), (F.col("tileid") % 3 + 1).cast("string"), F.lit("-"), F.lpad(F.col("expnum").cast("string"), 8, "0"))
    f = V.frames(spark, d).withColumns({"name": name, "OBJECT": F.lit("old"), "TARGET": F.lit("none")})
    return J.apply_header_fixes(f, fixes, "name", ["OBJECT", "TARGET"]).select("expnum", "OBJECT", "TARGET")


@query("""WITH m AS (SELECT DISTINCT camera, mjd AS master_mjd FROM frames WHERE imagetyp = 'P'), t AS (SELECT DISTINCT camera, mjd FROM frames),
b AS (SELECT t.camera, t.mjd, min(struct_pack(d := abs(t.mjd - master_mjd), m := master_mjd)) AS b FROM t JOIN m USING (camera) GROUP BY ALL)
SELECT expnum, f.camera, f.mjd, b.m AS master_mjd FROM frames f LEFT JOIN b ON f.camera = b.camera AND f.mjd = b.mjd""", "frames")
def c2_match_nearest(spark, d):
    f = V.frames(spark, d)
    masters = f.where("imagetyp = 'P'").select("camera", F.col("mjd").alias("master_mjd"))
    return J.match_nearest(f.select("expnum", "camera", "mjd"), masters, ["camera"])


@query("""WITH e AS (SELECT DISTINCT camera, mjd AS epoch FROM frames WHERE tileid % 50 = 0)
SELECT expnum, f.camera, f.mjd, max(epoch) AS epoch FROM frames f LEFT JOIN e ON e.camera = f.camera AND epoch <= f.mjd GROUP BY ALL""", "frames")
def c3_match_latest(spark, d):
    f = V.frames(spark, d)
    return J.match_latest(f.select("expnum", "camera", "mjd"), f.where("tileid % 50 = 0").select("camera", F.col("mjd").alias("epoch")), on=["camera"])


@query("""WITH x AS (SELECT expnum, tileid, lag(expnum) OVER w AS b, lead(expnum) OVER w AS a FROM frames WINDOW w AS (PARTITION BY tileid ORDER BY expnum))
SELECT expnum, tileid, CASE WHEN b IS NULL OR a - expnum < expnum - b THEN a ELSE b END AS reference FROM x""", "frames")
def c4_nearest_reference(spark, d):
    return J.nearest_reference(V.frames(spark, d).select("expnum", "tileid"), ["tileid"])


@query("""WITH n AS (SELECT camera, mjd, unnest(CASE imagetyp WHEN 'F' THEN ['pixmask', 'bias'] WHEN 'O' THEN ['pixmask'] END) AS product FROM frames),
p AS (SELECT DISTINCT camera, mjd, 'bias' AS product, 1 AS here FROM frames WHERE tileid % 3 = 0)
SELECT product, count(*) AS needed, count(here) AS present, round(count(here) / count(*), 9) AS share FROM n LEFT JOIN p USING (camera, mjd, product) GROUP BY product""", "frames")
def c5_completeness(spark, d):
    f = V.frames(spark, d)
    needed = J.expand_needs(f, needs={"F": ["pixmask", "bias"], "O": ["pixmask"]})
    present = f.where("tileid % 3 = 0").withColumn("product", F.lit("bias"))
    return J.completeness(needed, present, ["camera", "mjd", "product"]).withColumn("share", F.round("share", 9))


_MASTERS = """b AS (SELECT camera, y, x, min(value) AS v, bool_and(mask) AS m FROM stack GROUP BY ALL), k AS (SELECT camera, y, x, max(error) AS v FROM stack WHERE frame <= 3 GROUP BY ALL), f AS (SELECT camera, y, x, max(error) / 25.0 AS v FROM stack WHERE frame >= 3 GROUP BY ALL)"""


@query(f"""WITH {_MASTERS} SELECT p.camera, p.y, p.x, p.frame, round(((value - b.v) * 2.0 - coalesce(k.v, 0) * 900.0 / 300.0) / coalesce(f.v, 1.0), 4) AS value, mask OR b.m AS mask
FROM stack p JOIN b ON b.camera = p.camera AND b.y = p.y AND b.x = p.x LEFT JOIN k ON k.camera = p.camera AND k.y = p.y AND k.x = p.x LEFT JOIN f ON f.camera = p.camera AND f.y = p.y AND f.x = p.x""", "stack")
def c6_detrend(spark, d):
    s = V.stack(spark, d)
    key = ["camera", "y", "x"]
    bias = s.groupBy(*key).agg(F.min("value").alias("value"), F.every("mask").alias("mask"))
    dark = s.where("frame <= 3").groupBy(*key).agg(F.max("error").alias("value")).withColumn("mask", F.lit(False))
    flat = s.where("frame >= 3").groupBy(*key).agg((F.max("error") / 25.0).alias("value")).withColumn("mask", F.lit(False))
    return J.detrend(s, bias, dark, flat, key, 2.0, 900.0, 300.0).select(*key, "frame", F.round("value", 4).alias("value"), "mask")


def _laid_out(spark, d, buckets=16):
    s = V.stack(spark, d)
    key = ["camera", "y", "x"]
    put = lambda df, name: J.lay_out(df, f"{name}_{uuid.uuid4().hex}", key, buckets)
    bias = s.groupBy(*key).agg(F.min("value").alias("value"), F.every("mask").alias("mask"))
    dark = s.where("frame <= 3").groupBy(*key).agg(F.max("error").alias("value")).withColumn("mask", F.lit(False))
    flat = s.where("frame >= 3").groupBy(*key).agg((F.max("error") / 25.0).alias("value")).withColumn("mask", F.lit(False))
    return put(s, "raw"), put(bias, "bias"), put(dark, "dark"), put(flat, "flat")


@query(f"""WITH {_MASTERS} SELECT p.camera, p.y, p.x, p.frame, round(((value - b.v) * 2.0 - coalesce(k.v, 0) * 900.0 / 300.0) / coalesce(f.v, 1.0), 4) AS value, mask OR b.m AS mask
FROM stack p JOIN b ON b.camera = p.camera AND b.y = p.y AND b.x = p.x LEFT JOIN k ON k.camera = p.camera AND k.y = p.y AND k.x = p.x LEFT JOIN f ON f.camera = p.camera AND f.y = p.y AND f.x = p.x""", "stack")
def c6_detrend_laid_out(spark, d):
    """Masters and frames as tables of one layout: their pixels join without a shuffle."""
    return J.detrend(*_laid_out(spark, d), ["camera", "y", "x"], 2.0, 900.0, 300.0).select("camera", "y", "x", "frame", F.round("value", 4).alias("value"), "mask")


@query("""WITH a AS (SELECT * FROM stack WHERE frame = 1), b AS (SELECT * FROM stack WHERE frame = 2)
SELECT a.camera, a.y, a.x, a.value + b.value AS s, round(sqrt(a.error * a.error + b.error * b.error), 6) AS se, round(a.value / b.value, 6) AS q, round(sqrt((a.error / b.value) * (a.error / b.value) + (b.error * a.value / (b.value * b.value)) * (b.error * a.value / (b.value * b.value))), 9) AS qe, a.mask OR b.mask AS mask
FROM a JOIN b USING (camera, y, x)""", "stack")
def c7_arith(spark, d):
    s = V.stack(spark, d)
    a, b, key = s.where("frame = 1").drop("frame"), s.where("frame = 2").drop("frame"), ["camera", "y", "x"]
    q = J.arith(a, b, "/", key, "value").select(*key, F.round("value", 6).alias("q"), F.round("error", 9).alias("qe"))
    return J.arith(a, b, "+", key, "value").select(*key, F.col("value").alias("s"), F.round("error", 6).alias("se"), "mask").join(q, key)


@query("""WITH f AS (SELECT fiberid, k, max(error) - 49 AS f FROM samples WHERE part % 2 = 0 GROUP BY ALL)
SELECT expnum, fiberid, k, part, round(flux / nullif(coalesce(f, 1.0), 0), 6) AS flux, mask OR coalesce(f, 1.0) = 0 AS mask FROM samples LEFT JOIN f USING (fiberid, k)""", "samples")
def c8_apply_fiberflat(spark, d):
    s = V.samples(spark, d)
    flat = s.where("part % 2 = 0").groupBy("fiberid", "k").agg((F.max("error") - 49).alias("flux"))
    return J.apply_fiberflat(s, flat, ["fiberid", "k"]).select("expnum", "fiberid", "k", "part", F.round("flux", 6).alias("flux"), "mask")


def _plane(spark, d):
    fib = V.fibermap(spark, d).select("fiberid", (F.col("fiberid") % 101).cast("double").alias("x"), F.col("ypmm").alias("y"))
    stars = _part(spark, d).select(F.col("p_partkey").alias("star"), F.floor("p_retailprice").alias("mag"), (F.col("p_partkey") * 13 % 101).cast("double").alias("bx"), (F.col("p_partkey") * 29 % 97 - 50).cast("double").alias("by"))
    return fib, stars


_PLANE = "fib AS (SELECT fiberid, (fiberid % 101)::DOUBLE AS x, ypmm AS y FROM fibermap), stars AS (SELECT p_partkey AS star, floor(p_retailprice)::BIGINT AS mag, (p_partkey * 13 % 101)::DOUBLE AS bx, (p_partkey * 29 % 97 - 50)::DOUBLE AS bz FROM part)"


@query(f"WITH {_PLANE}, p AS (SELECT fiberid, star, sqrt((x - bx) * (x - bx) + (y - bz) * (y - bz)) AS dist FROM fib JOIN stars ON (x - bx) * (x - bx) + (y - bz) * (y - bz) <= 0.25) SELECT fiberid, star, round(dist, 6) AS distance FROM (SELECT *, count(*) OVER (PARTITION BY fiberid) AS n FROM p) WHERE n = 1", "fibermap")
def c9_cone_match(spark, d):
    fib, stars = _plane(spark, d)
    return J.cone_match(fib, stars, 0.5).select("fiberid", "star", F.round("distance", 6).alias("distance"))


@query(f"WITH {_PLANE}, p AS (SELECT fiberid, star, mag, row_number() OVER (PARTITION BY fiberid ORDER BY mag, star) AS r FROM fib JOIN stars ON (x - bx) * (x - bx) + (y - bz) * (y - bz) <= 25 AND mag < 1500) SELECT fiberid, star, mag, r::INT AS rank FROM p WHERE r <= 5", "fibermap")
def c10_brightest_in_radius(spark, d):
    fib, stars = _plane(spark, d)
    centres = fib.select(F.col("fiberid").alias("centre"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    cat = stars.select("star", "mag", F.col("bx").alias("x"), F.col("by").alias("y"))
    out = J.brightest_in_radius(cat, centres.withColumnsRenamed({"cx": "bx", "cy": "by"}), 5.0, 1500, 5)
    return out.select(F.col("centre").alias("fiberid"), "star", "mag", "rank")


_SKY = """fib AS (SELECT fiberid, (fiberid * 37 % 360)::DOUBLE + 0.25 AS ra, CASE WHEN fiberid % 10 = 0 THEN 89.5 ELSE (fiberid * 17 % 181 - 90)::DOUBLE END AS dec FROM fibermap),
stars AS (SELECT p_partkey AS star, floor(p_retailprice)::BIGINT AS mag, (p_partkey * 101 % 3600) / 10.0 AS bra, CASE WHEN p_partkey % 10 = 0 THEN 89.0 + (p_partkey % 70) / 70.0 ELSE (p_partkey * 29 % 1800) / 10.0 - 90 END AS bdec FROM part),
q AS (SELECT *, pow(sin(radians((dec - bdec) / 2)), 2) + cos(radians(dec)) * cos(radians(bdec)) * pow(sin(radians((ra - bra) / 2)), 2) AS h FROM fib, stars), r AS (SELECT *, degrees(2 * asin(least(sqrt(h), 1))) AS dist FROM q)"""


def _sky(spark, d):
    """Positions over the whole sky, many of them near the pole and about right ascension 0."""
    f, p = F.col("fiberid"), F.col("p_partkey")
    fib = V.fibermap(spark, d).select("fiberid", ((f * 37 % 360).cast("double") + 0.25).alias("x"), F.when(f % 10 == 0, 89.5).otherwise((f * 17 % 181 - 90).cast("double")).alias("y"))
    bdec = F.when(p % 10 == 0, F.lit(89.0) + (p % 70) / 70.0).otherwise((p * 29 % 1800) / 10.0 - 90)
    return fib, _part(spark, d).select(p.alias("star"), F.floor("p_retailprice").alias("mag"), ((p * 101 % 3600) / 10.0).alias("bx"), bdec.alias("by"))


@query(f"WITH {_SKY}, p AS (SELECT * FROM r WHERE dist <= 1.5) SELECT fiberid, star, round(dist, 6) AS distance FROM (SELECT *, count(*) OVER (PARTITION BY fiberid) AS n FROM p) WHERE n = 1", "fibermap")
def c9_cone_match_sky(spark, d):
    """Great circles, over the turn of right ascension and the pole."""
    return J.cone_match(*_sky(spark, d), 1.5, sky=True).select("fiberid", "star", F.round("distance", 6).alias("distance"))


@query(f"WITH {_SKY}, p AS (SELECT *, row_number() OVER (PARTITION BY fiberid ORDER BY mag, star) AS n FROM r WHERE dist <= 4 AND mag < 1700) SELECT fiberid, star, mag, n::INT AS rank FROM p WHERE n <= 5", "fibermap")
def c10_brightest_on_sky(spark, d):
    fib, stars = _sky(spark, d)
    centres = fib.select(F.col("fiberid").alias("centre"), F.col("x").alias("cx"), F.col("y").alias("cy")).withColumnsRenamed({"cx": "bx", "cy": "by"})
    out = J.brightest_in_radius(stars.select("star", "mag", F.col("bx").alias("x"), F.col("by").alias("y")), centres, 4.0, 1700, 5, sky=True)
    return out.select(F.col("centre").alias("fiberid"), "star", "mag", "rank")


@query(f"WITH {_PLANE} SELECT b.fiberid AS aperture, count(*) AS members, sum(a.fiberid)::BIGINT AS total FROM fib a JOIN fib b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 64 GROUP BY ALL", "fibermap")
def c11_aperture_members(spark, d):
    fib, _ = _plane(spark, d)
    ap = fib.select(F.col("fiberid").alias("aperture"), F.col("x").alias("bx"), F.col("y").alias("by"))
    return J.aperture_totals(fib, ap, 8.0, "fiberid").groupBy("aperture").agg(F.sum("members").alias("members"), F.sum("total").alias("total"))


@query("""WITH c AS (SELECT (p_partkey * 7.0)::DOUBLE AS x, floor(p_retailprice) AS y FROM part), s AS (SELECT x, y, lead(x) OVER (ORDER BY x) AS x2, lead(y) OVER (ORDER BY x) AS y2 FROM c), w AS (SELECT DISTINCT part * 7.5 AS wave FROM samples),
i AS (SELECT wave, CASE WHEN wave <= (SELECT min(x) FROM c) THEN (SELECT arg_min(y, x) FROM c) WHEN wave >= (SELECT max(x) FROM c) THEN (SELECT arg_max(y, x) FROM c) ELSE y + (wave - x) / (x2 - x) * (y2 - y) END AS v FROM w LEFT JOIN s ON wave >= x AND wave < x2)
SELECT expnum, fiberid, k, part, round(v, 6) AS curve FROM samples JOIN i ON wave = part * 7.5""", "samples")
def c12_interp_onto(spark, d):
    curve = _part(spark, d).select((F.col("p_partkey") * 7.0).alias("cw"), F.floor("p_retailprice").alias("cv"))
    s = V.samples(spark, d).withColumn("wave", F.col("part") * 7.5)
    return J.interp_onto(s, curve).select("expnum", "fiberid", "k", "part", F.round("curve", 6).alias("curve"))


@query("""WITH a AS (SELECT fiberid, k, sum(flux) AS flux FROM samples WHERE k <= 4 AND NOT mask GROUP BY ALL), b AS (SELECT fiberid, k, max(flux) AS flux FROM samples WHERE k >= 3 GROUP BY ALL)
SELECT fiberid, k, coalesce(a.flux, b.flux) AS flux FROM a FULL JOIN b USING (fiberid, k)""", "samples")
def c13_coalesce_tables(spark, d):
    s = V.samples(spark, d)
    a = s.where("k <= 4 and not mask").groupBy("fiberid", "k").agg(F.sum("flux").alias("flux"))
    return J.coalesce_tables(a, s.where("k >= 3").groupBy("fiberid", "k").agg(F.max("flux").alias("flux")), ["fiberid", "k"], ["flux"])


@query("SELECT expnum, camera FROM frames WHERE expnum NOT IN (SELECT expnum FROM samples WHERE mask AND error > 45)", "frames samples")
def c14_anti_shifted(spark, d):
    return J.anti_shifted(V.frames(spark, d), V.samples(spark, d).where("mask and error > 45")).select("expnum", "camera")


@query("SELECT expnum, tileid FROM frames WHERE tileid IN (SELECT fiberid FROM fibermap) AND tileid IN (SELECT p_partkey FROM part WHERE p_partkey % 3 = 0)", "frames fibermap")
def c15_semi_standards(spark, d):
    out = J.semi_standards(V.frames(spark, d), V.fibermap(spark, d).withColumnRenamed("fiberid", "tileid"), _part(spark, d).where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("tileid")), "tileid")
    return out.select("expnum", "tileid")


@query("""WITH a AS (SELECT DISTINCT mjd AS a_epoch FROM frames WHERE tileid % 200 = 0), b AS (SELECT DISTINCT mjd AS b_epoch FROM frames WHERE tileid % 7 = 0)
SELECT (SELECT max(a_epoch) FROM a WHERE a_epoch <= b_epoch) AS a_epoch, b_epoch FROM b WHERE b_epoch >= (SELECT min(a_epoch) FROM a)""", "frames")
def c16_epoch_ranges(spark, d):
    f = V.frames(spark, d)
    return J.epoch_ranges(f.where("tileid % 200 = 0").select(F.col("mjd").alias("a_epoch")), f.where("tileid % 7 = 0").select(F.col("mjd").alias("b_epoch")).distinct()).select("a_epoch", "b_epoch")


@query("""WITH f AS (SELECT fiberid, avg(flux) AS m, regr_slope(flux, k::DOUBLE) AS s, regr_intercept(flux, k::DOUBLE) AS c FROM samples GROUP BY fiberid)
SELECT fiberid, round(m, 4) AS level, round(s * ((2.0 + 5.0) / 2) + c, 3) AS line FROM f""", "samples")
def c17_time_model(spark, d):
    s = V.samples(spark, d).withColumn("t", F.col("k").cast("double"))
    t = V.fibermap(spark, d).select("fiberid").withColumns({"start": F.lit(2.0), "end": F.lit(5.0)})
    a = J.time_model(s, t, ["fiberid"], 0).select("fiberid", F.round("model", 4).alias("level"))
    return a.join(J.time_model(s, t, ["fiberid"], 1).select("fiberid", F.round("model", 3).alias("line")), "fiberid")


_POWERS = ", ".join([f"sum(pow(u, {p})) AS s{p}" for p in range(5)] + [f"sum(pow(u, {p}) * flux) AS t{p}" for p in range(3)])


@query(f"""WITH s AS (SELECT fiberid, CASE WHEN k <= 3 THEN 86100.0 + 100 * k ELSE 86400.0 + 100 * k END AS t, flux FROM samples), m AS (SELECT fiberid, (min(t) + max(t)) / 2 AS mid, (max(t) - min(t)) / 2 AS half FROM s GROUP BY fiberid HAVING count(DISTINCT t) > 2),
p AS (SELECT fiberid, any_value(mid) AS mid, any_value(half) AS half, {_POWERS} FROM (SELECT s.*, mid, half, (t - mid) / half AS u FROM s JOIN m USING (fiberid)) GROUP BY fiberid), {solve_sql("p", "c", 3, "fiberid, mid, half")},
i AS (SELECT *, (86200.0 - mid) / half AS a, (600.0 + 86400 - mid) / half AS b FROM c)
SELECT fiberid, round(x0 + x1 * (b * b - a * a) / 2 / (b - a) + x2 * (b * b * b - a * a * a) / 3 / (b - a), 2) AS model FROM i""", "samples")
def c17_time_model_midnight(spark, d):
    """A parabola in time, integrated over an exposure that passes midnight (clock times fall back to 0)."""
    s = V.samples(spark, d).withColumn("t", F.when(F.col("k") <= 3, F.lit(86100.0) + 100 * F.col("k")).otherwise(F.lit(86400.0) + 100 * F.col("k")))
    t = s.groupBy("fiberid").agg(F.countDistinct("t").alias("n")).where("n > 2").select("fiberid").withColumns({"start": F.lit(86200.0), "end": F.lit(600.0)})
    return J.time_model(s, t, ["fiberid"], 2).select("fiberid", F.round("model", 2).alias("model"))


@query("SELECT telescope, block, count(*) AS n, sum(flux) AS flux FROM samples JOIN fibermap USING (fiberid) GROUP BY telescope, block", "samples fibermap")
def c18_join_fibermap(spark, d):
    out = J.join_fibermap(V.samples(spark, d), V.fibermap(spark, d), ["telescope", "block"])
    return out.groupBy("telescope", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("flux").alias("flux"))


@query("SELECT DISTINCT s.expnum, mjd FROM samples s LEFT JOIN frames f USING (expnum)", "samples frames")
def c19_lookup_night(spark, d):
    return J.lookup_night(V.samples(spark, d).select("expnum").distinct(), V.frames(spark, d))
