"""Queries of selections and masks (B)."""

from pyspark.sql import functions as F

from .. import views as V
from ..operators import filters as B
from ..operators.joins import small
from ..registry import query
from ..sources.catalog import LAMPS

_LAMPS = ", ".join(f"expnum % {n} = 0 AS {lamp}" for n, lamp in zip((2, 3, 5, 7, 11, 4, 13), LAMPS))
_CAL = f"SELECT expnum, mjd, camera, exptime, tileid, {_LAMPS}, CASE imagetyp WHEN 'F' THEN 'flat' WHEN 'O' THEN 'bias' ELSE 'arc' END AS imagetyp, CASE WHEN expnum % 9 = 0 THEN 'BAD' ELSE 'GOOD' END AS qaqual, '0 0' AS hartmann FROM frames"
_CLASS = f"CASE WHEN imagetyp = 'bias' THEN 'bias' WHEN (ldls OR quartz) AND NOT ({' OR '.join(LAMPS[:5])}) THEN 'trace' WHEN ({' OR '.join(LAMPS[:5])}) AND NOT (ldls OR quartz) THEN 'wave' WHEN imagetyp = 'flat' AND NOT ({' OR '.join(LAMPS)}) THEN 'twilight' END"


def cal(spark, d):
    e = F.col("expnum")
    f = V.frames(spark, d).withColumns({lamp: e % n == 0 for n, lamp in zip((2, 3, 5, 7, 11, 4, 13), LAMPS)})
    return f.withColumns({"imagetyp": F.when(F.col("imagetyp") == "F", "flat").when(F.col("imagetyp") == "O", "bias").otherwise("arc"), "qaqual": F.when(e % 9 == 0, "BAD").otherwise("GOOD"), "hartmann": F.lit("0 0")})


@query("SELECT * FROM frames WHERE imagetyp = 'F' AND camera = '5-LOW'", "frames")
def b1_filter_frames(spark, d):
    return B.filter_frames(V.frames(spark, d), imagetyp="F", camera="5-LOW", tileid=None)


@query(f"WITH c AS ({_CAL}) SELECT expnum, {_CLASS} AS class FROM c", "frames")
def b2_calibration_class(spark, d):
    return cal(spark, d).select("expnum", B.calibration_class().alias("class"))


@query(f"WITH c AS ({_CAL}) SELECT camera, expnum, exptime FROM c WHERE qaqual = 'GOOD' AND {_CLASS} = 'wave' AND camera IN ('1-URGENT', '2-HIGH') AND neon ORDER BY camera, expnum", "frames")
def b3_select_calibrations(spark, d):
    return B.select_calibrations(cal(spark, d), "wave", ["1-URGENT", "2-HIGH"], lamps=["neon"], hartmann="0 0").select("camera", "expnum", "exptime")


@query("SELECT expnum, mjd FROM frames WHERE expnum BETWEEN 100 AND 5000 AND mjd >= 50100 AND tileid IN (10, 20, 30, 31, 32, 33)", "frames")
def b4_filter_expnum(spark, d):
    return B.filter_expnum(B.filter_expnum(B.filter_expnum(V.frames(spark, d), "100-5000"), "50100-", "mjd"), "10,20,30,31,32,33", "tileid").select("expnum", "mjd")


@query("SELECT expnum, mjd FROM frames WHERE mjd % 100 > 20", "frames")
def b5_exclude_ranges(spark, d):
    f = V.frames(spark, d)
    r = f.select((F.floor(F.col("mjd") / 100) * 100).cast("int").alias("lo")).distinct().withColumn("hi", F.col("lo") + 20)
    return B.exclude_ranges(f, r).select("expnum", "mjd")


_MAP = "SELECT *, CASE WHEN fiberid % 10 = 0 THEN 'standard' ELSE telescope END AS targettype, (fiberid % 7 = 0)::INT AS fibstatus FROM fibermap"


def fibers(spark, d):
    return V.fibermap(spark, d).withColumns({"targettype": F.when(F.col("fiberid") % 10 == 0, "standard").otherwise(F.col("telescope")), "fibstatus": (F.col("fiberid") % 7 == 0).cast("int")})


@query(f"WITH m AS ({_MAP}) SELECT fiberid, spectrographid FROM m WHERE targettype <> 'standard' AND fibstatus <> 1", "fibermap")
def b6_select_fibers(spark, d):
    return B.select_fibers(fibers(spark, d)).select("fiberid", "spectrographid")


@query(f"WITH m AS ({_MAP}) SELECT expnum, s.fiberid, k, part, CASE WHEN NOT mask THEN flux END AS flux FROM samples s JOIN m USING (fiberid) WHERE fibstatus = 0 AND telescope = 'EUROPE'", "samples fibermap")
def b7_good_fibers(spark, d):
    s = V.samples(spark, d).join(small(fibers(spark, d).select("fiberid", "telescope", "fibstatus")), "fiberid")
    return B.good_fibers(s, "EUROPE", ["flux"], "mask").select("expnum", "fiberid", "k", "part", "flux")


@query("SELECT fiberid, telescope, telescope IN ('ASIA', 'EUROPE') AS sky FROM fibermap", "fibermap")
def b8_select_sky(spark, d):
    sky, rest = B.select_sky(V.fibermap(spark, d), "both", east="ASIA", west="EUROPE")
    return sky.withColumn("sky", F.lit(True)).union(rest.withColumn("sky", F.lit(False))).select("fiberid", "telescope", "sky")


@query("SELECT fiberid, 'old' AS split FROM fibermap WHERE telescope IN ('ASIA', 'EUROPE') UNION ALL SELECT fiberid, 'all' FROM fibermap WHERE telescope IN ('ASIA', 'AMERICA', 'AFRICA')", "fibermap")
def b9_split_by_type(spark, d):
    return B.split_by_type(V.fibermap(spark, d), {"old": ["ASIA", "EUROPE"], "all": ["ASIA", "AMERICA", "AFRICA"]}, "telescope").select("fiberid", "split")


@query("SELECT fiberid, count(*) FILTER (part BETWEEN 200 AND 400) AS line, count(*) FILTER ((part >= 100 AND part < 200) OR (part > 400 AND part <= 450)) AS cont, count(*) FILTER (part BETWEEN 1 AND 50) AS win FROM samples GROUP BY fiberid", "samples")
def b10_line_windows(spark, d):
    line, cont = B.line_windows(F.col("part"), (200, 400), (100, 450))
    return V.samples(spark, d).groupBy("fiberid").agg(F.count_if(line).alias("line"), F.count_if(cont).alias("cont"), F.count_if(B.wave_window(F.col("part"), 1, 50)).alias("win"))


@query("""WITH l AS (SELECT p_partkey * 40.0 AS w, p_retailprice AS f FROM part WHERE p_retailprice > 1500 AND NOT p_partkey * 40.0 BETWEEN 6000 AND 6500)
SELECT expnum, fiberid, k, part, EXISTS (SELECT 1 FROM l WHERE abs(part * 20.0 - w) <= 15.0) AS line FROM samples""", "samples")
def b11_mask_lines(spark, d):
    lines = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_partkey") * 40.0).alias("line_wave"), F.col("p_retailprice").alias("line_flux"))
    s = V.samples(spark, d).withColumn("wave", F.col("part") * 20.0)
    return B.mask_lines(s, lines, 15.0, 1500.0, protect=(6000.0, 6500.0)).select("expnum", "fiberid", "k", "part", "line")


@query("SELECT camera, y, x, frame, value FROM pixels WHERE x >= 10 AND x < 30 AND y >= 4 AND y < 60", "pixels")
def b12_image_section(spark, d):
    return B.image_section(V.pixels(spark, d), "[11:30, 5:60]").select("camera", "y", "x", "frame", "value")


@query("""WITH s AS (SELECT *, CASE WHEN NOT mask THEN flux END AS f, bool_or(k = 7 AND part % 400 = 0) OVER (PARTITION BY expnum, fiberid) AS bad FROM samples)
SELECT expnum, fiberid, k, part, f AS masked, CASE WHEN bad THEN 0.0 ELSE flux END AS flux, CASE WHEN bad THEN 1e12 ELSE error END AS error, bad OR mask OR fiberid BETWEEN 3 AND 9 AS mask FROM s""", "samples")
def b13_apply_mask(spark, d):
    s = V.samples(spark, d).withColumn("masked", F.col("flux"))
    s = B.apply_mask(s, ["masked"]).withColumn("flux", F.when(~((F.col("k") == 7) & (F.col("part") % 400 == 0)), F.col("flux")))
    return B.mask_rows(B.mask_nan_rows(s, ["expnum", "fiberid"]), (3, 9), between=True).select("expnum", "fiberid", "k", "part", "masked", "flux", "error", "mask")


@query("""SELECT y, count(*) FILTER (value >= 50000 OR mask OR x < 3 OR x >= 47) AS masked, round(count(*) FILTER (value >= 50000) / count(*), 6) AS share, count(*) FILTER (value >= 50000) / count(*) > 0.2 AS saturated FROM pixels GROUP BY y""", "pixels")
def b14_mask_saturated(spark, d):
    out, share = B.mask_saturated(V.pixels(spark, d), ["y"], 50, 50000.0, 0.2)
    n = out.groupBy("y").agg(F.count_if("mask").alias("masked"))
    return n.join(share, "y").select("y", "masked", F.round("share", 6).alias("share"), "saturated")


@query("""WITH q AS (SELECT *, CASE WHEN exptime > 150000 THEN 'BAD' ELSE 'GOOD' END AS qaqual FROM frames) SELECT tileid, expnum FROM (SELECT *, bool_and(qaqual = 'BAD') OVER (PARTITION BY tileid) AS a FROM q) WHERE a OR qaqual <> 'BAD'""", "frames")
def b16_quality_gate(spark, d):
    f = V.frames(spark, d).withColumn("qaqual", F.when(F.col("exptime") > 150000, "BAD").otherwise("GOOD"))
    return B.quality_gate(f, ["tileid"]).select("tileid", "expnum")


@query(f"WITH c AS ({_CAL}) SELECT DISTINCT concat_ws(',', {', '.join(f'''CASE WHEN {lamp} THEN '{lamp.upper()}' END''' for lamp in LAMPS)}) AS lamps FROM c", "frames")
def b17_lamps_label(spark, d):
    return cal(spark, d).select(B.lamps_label().alias("lamps")).distinct()


@query("SELECT camera, y, x, frame, value, y % 25 <= 2 OR y % 25 >= 23 AS near FROM pixels", "pixels")
def b18_mask_near_traces(spark, d):
    p = V.pixels(spark, d).select("camera", "y", "x", "frame", "value")
    near = F.floor(F.col("y") / 25) * 25
    trace = p.select("x", F.explode(F.array(near, near + 25)).alias("centre")).distinct()
    return B.mask_near_traces(p, trace, 2)
