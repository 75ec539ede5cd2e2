"""Queries of the catalogue (A)."""

from pyspark.sql import functions as F

from .. import views as V
from ..operators.joins import small
from ..registry import query
from ..shared import shared_path
from ..sources import catalog as C


def _headers(spark, d):
    """Header maps made of orders."""
    f = V.frames(spark, d)
    s = lambda c: c.cast("string")
    m = F.create_map(
        F.lit("OBSERVAT"), F.when(F.col("expnum") % 3 == 0, "LCO").otherwise("APO"), F.lit("TILE_ID"), F.when(F.col("tileid") % 10 == 0, "-999").otherwise(s(F.col("tileid"))),
        F.lit("MJD"), s(F.col("mjd")), F.lit("IMAGETYP"), F.col("imagetyp"), F.lit("CCD"), F.col("camera"), F.lit("EXPOSURE"), s(F.col("expnum")), F.lit("EXPTIME"), s(F.col("exptime")),
        F.lit("NEON"), F.when(F.col("expnum") % 4 == 0, "ON").otherwise("OFF"), F.lit("LDLS"), F.when(F.col("expnum") % 5 == 0, "T").otherwise("F"), F.lit("STD1FIB"), F.when(F.col("expnum") % 2 == 0, "P1-2"), F.lit("STD1ID"), s(F.col("tileid")), F.lit("STD2FIB"), F.lit("P1-3"), F.lit("STD2ID"), F.lit("77"),
        F.lit("bfactor1"), s(F.col("tileid") % 7), F.lit("rgcoeff2"), s(F.col("tileid") % 5),
    )
    return f.withColumn("header", F.map_filter(m, lambda k, v: v.isNotNull()))


@query("SELECT expnum, (mjd // 100 * 100)::INT AS mjd, camera, imagetyp, exptime, tileid FROM frames WHERE mjd // 100 IN (500, 505, 510)", "frames")
def a1_read_frames(spark, d):
    """The catalogue written by (rounded) night and read back, three nights of it."""
    path = shared_path(spark, "frames")
    f = V.frames(spark, d).withColumn("mjd", (F.floor(F.col("mjd") / 100) * 100).cast("int"))
    C.write_frames(f, path)
    return C.read_frames(spark, path, [50000, 50500, 51000], f.schema)


@query("SELECT p_partkey::DOUBLE AS wave, floor(p_retailprice) AS value FROM part")
def a7_read_curve(spark, d):
    path = shared_path(spark, "curve")
    spark.read.parquet(f"{d}/part.parquet").select(F.concat_ws(" ", F.col("p_partkey").cast("string"), F.floor("p_retailprice").cast("string"))).write.text(path)
    return C.read_curve(spark, path, ["wave", "value"])


@query("SELECT xpmm AS x, ypmm AS y, CASE WHEN fiberid % 7 = 0 THEN 0 ELSE 1 END AS good, telescope AS fiber_type FROM fibermap", "fibermap")
def a8_positions(spark, d):
    path = shared_path(spark, "positions")
    C.write_positions(V.fibermap(spark, d).select(F.col("xpmm").alias("x"), F.col("ypmm").alias("y"), (F.col("fiberid") % 7 != 0).cast("int").alias("good"), F.col("telescope").alias("fiber_type")), path)
    return C.read_positions(spark, path)


@query("""SELECT expnum, CASE WHEN expnum % 3 = 0 THEN 's' ELSE 'n' END AS hemi, CASE WHEN tileid % 10 = 0 OR tileid = 999 THEN 11111 ELSE tileid END::INT AS tileid, lpad((CASE WHEN tileid % 10 = 0 OR tileid = 999 THEN 11111 ELSE tileid END // 1000)::VARCHAR, 4, '0') || 'XX' AS tilegrp, mjd, imagetyp, exptime, expnum % 4 = 0 AS neon, expnum % 5 = 0 AS ldls, false AS argon, 'None' AS calibfib, 'GOOD' AS qaqual, 1::BIGINT AS stage FROM frames""", "frames")
def a2_extract_metadata(spark, d):
    out = C.extract_metadata(_headers(spark, d))
    return out.select("expnum", "hemi", "tileid", "tilegrp", "mjd", "imagetyp", "exptime", "neon", "ldls", "argon", "calibfib", "qaqual", "stage")


@query("SELECT expnum, CASE WHEN tileid % 10 = 0 THEN '-999' ELSE tileid::VARCHAR END AS tile, imagetyp AS kind, CASE WHEN expnum % 2 = 0 THEN 'P1-2' END AS std, NULL::VARCHAR AS fluxcal FROM frames", "frames")
def a3_collect_header(spark, d):
    return C.collect_header(_headers(spark, d), {"tile": "TILE_ID", "kind": "IMAGETYP", "std": "STD1FIB", "fluxcal": C.SUMMARY_KEYS["fluxcal"]}, ["expnum"])


@query("""SELECT tileid, CASE WHEN max(CASE WHEN camera = '1-URGENT' THEN expnum END) IS NOT NULL THEN max(CASE WHEN camera = '1-URGENT' THEN expnum END) ELSE max(expnum) END AS expnum FROM frames GROUP BY tileid""", "frames")
def a4_upsert_keep_last(spark, d):
    f = V.frames(spark, d)
    return C.upsert_keep_last(f.where("camera <> '1-URGENT'"), f.where("camera = '1-URGENT'"), ["tileid"], ["expnum"]).select("tileid", "expnum")


@query("""WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tileid, mjd ORDER BY camera, expnum) AS n FROM frames WHERE imagetyp = 'F') WHERE n = 1)
SELECT expnum, tileid, mjd, coalesce((mjd // 100 * 100)::INT, -999) AS epoch, coalesce(CASE WHEN expnum % 2 = 0 THEN 'P1-2' END, 'None') AS std FROM one""", "frames")
def a5_build_summary(spark, d):
    f = V.frames(spark, d)
    epochs = f.select((F.floor(F.col("mjd") / 100) * 100).cast("int").alias("epoch")).distinct()
    heads = C.collect_header(_headers(spark, d), {"std": "STD1FIB"}, ["expnum"])
    return C.build_summary(f, heads, epochs, ["tileid", "mjd"], ["camera", "expnum"], "F").select("expnum", "tileid", "mjd", "epoch", "std")


@query("SELECT mjd, expnum, exptime FROM frames ORDER BY mjd, expnum", "frames")
def a6_export_summary(spark, d):
    return C.export_summary(V.frames(spark, d).select("mjd", "expnum", "exptime"))


@query("""SELECT tileid, mjd, coalesce(min(CASE WHEN imagetyp = 'O' THEN expnum END), min(expnum)) AS expnum FROM frames GROUP BY tileid, mjd""", "frames")
def a9_merge_shift_log(spark, d):
    f = V.frames(spark, d)
    return C.merge_shift_log(f.where("imagetyp = 'O'"), f.where("imagetyp <> 'O'"), ["tileid", "mjd"], ["expnum"]).select("tileid", "mjd", "expnum")


@query("SELECT grp, k, count(*) AS n, sum(flux) AS flux FROM cells GROUP BY grp, k", "cells")
def a10_explode_spectra(spark, d):
    s = V.spectra(spark, d).withColumn("flux", F.transform("flux", lambda v: F.round(v.cast("double") * 10000)))
    again = C.collect_spectra(C.explode_spectra(s, ["fiberid", "grp"], ["flux"]), ["fiberid", "grp"], ["flux"])
    return C.explode_spectra(again, ["fiberid", "grp"], ["flux"]).groupBy("grp", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("flux").alias("flux"))


@query("SELECT expnum, 'bfactor1' AS key, (tileid % 7)::DOUBLE AS value FROM frames UNION ALL SELECT expnum, 'rgcoeff2', (tileid % 5)::DOUBLE FROM frames", "frames")
def a12_read_factors(spark, d):
    return C.read_factors(_headers(spark, d), ["expnum"])


@query("SELECT k, flux, s.fiberid, expnum, telescope FROM samples s JOIN fibermap USING (fiberid) WHERE telescope = 'ASIA'", "samples fibermap")
def a13_super_sky_table(spark, d):
    s = V.samples(spark, d).join(small(V.fibermap(spark, d).select("fiberid", "telescope")), "fiberid")
    return C.super_sky_table(s, "ASIA", ["k", "flux", "fiberid", "expnum", "telescope"], "k")


@query("SELECT expnum, 1::INT AS number, 'P1-2' AS fib, tileid::VARCHAR AS id FROM frames WHERE expnum % 2 = 0 UNION ALL SELECT expnum, 2, 'P1-3', '77' FROM frames", "frames")
def a14_unpivot_header_group(spark, d):
    return C.unpivot_header_group(_headers(spark, d), "STD", ["FIB", "ID"], 3, ["expnum"])
