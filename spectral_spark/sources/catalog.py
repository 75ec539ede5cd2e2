"""The catalogue of frames: reading, header maps to typed rows, upserts, summaries, curves and spectra in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import tile_group, to_sjd

#: Lamps in their order, first those of arcs, then those of continua.
ARC_LAMPS, CONTINUUM_LAMPS = ("neon", "hgne", "krypton", "xenon", "argon"), ("ldls", "quartz")
LAMPS = ARC_LAMPS + CONTINUUM_LAMPS

FRAME_SCHEMA = T.StructType(
    [T.StructField("hemi", T.StringType()), T.StructField("tileid", T.IntegerType()), T.StructField("tilegrp", T.StringType()), T.StructField("mjd", T.IntegerType()), T.StructField("rmjd", T.IntegerType()), T.StructField("imagetyp", T.StringType()), T.StructField("spec", T.StringType()), T.StructField("camera", T.StringType()), T.StructField("expnum", T.LongType()), T.StructField("exptime", T.DoubleType())]
    + [T.StructField(lamp, T.BooleanType()) for lamp in LAMPS]
    + [T.StructField("calibfib", T.StringType()), T.StructField("hartmann", T.StringType()), T.StructField("qaqual", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("stage", "status", "drpqual")]
    + [T.StructField("name", T.StringType())]
)

#: Summary column and the header keyword it comes from.
SUMMARY_KEYS = {
    "drpver": "DRPVER", "drpqual": "DRPQUAL", "dpos": "DPOS", "object": "OBJECT", "obstime": "OBSTIME",
    "std_mean_senb": "STDSENMB", "std_mean_senr": "STDSENMR", "std_mean_senz": "STDSENMZ",
    "sci_mean_senb": "SCISENMB", "sci_mean_senr": "SCISENMR", "sci_mean_senz": "SCISENMZ",
    "mod_mean_senb": "MODSENMB", "mod_mean_senr": "MODSENMR", "mod_mean_senz": "MODSENMZ",
    "std_rms_senb": "STDSENRB", "std_rms_senr": "STDSENRR", "std_rms_senz": "STDSENRZ",
    "sci_rms_senb": "SCISENRB", "sci_rms_senr": "SCISENRR", "sci_rms_senz": "SCISENRZ",
    "mod_rms_senb": "MODSENRB", "mod_rms_senr": "MODSENRR", "mod_rms_senz": "MODSENRZ",
    "fluxcal": "FLUXCAL",
    "sci_ra": "SCIRA", "sci_dec": "SCIDEC", "sci_pa": "SCIPA", "sci_amass": "SCIAM", "sci_astsrc": "SCIASRC", "sci_kmpos": "TESCIKM", "sci_focpos": "TESCIFO", "sci_alt": "SKY SCI_ALT", "sci_sh_hght": "SKY SCI_SH_HGHT", "sci_moon_sep": "SKY SCI_MOON_SEP",
    "skye_ra": "SKYERA", "skye_dec": "SKYEDEC", "skye_pa": "SKYEPA", "skye_amass": "SKYEAM", "skye_astsrc": "SKYEASRC", "skye_kmpos": "TESKYEKM", "skye_focpos": "TESKYEFO", "skye_name": "SKYENAME", "skye_alt": "SKY SKYE_ALT", "sci_skye_sep": "SKY SCI_SKYE_SEP", "skye_sh_hght": "SKY SKYE_SH_HGHT", "skye_moon_sep": "SKY SKYE_MOON_SEP",
    "skyw_ra": "SKYWRA", "skyw_dec": "SKYWDEC", "skyw_pa": "SKYWPA", "skyw_amass": "SKYWAM", "skyw_astsrc": "SKYWASRC", "skyw_kmpos": "TESKYWKM", "skyw_focpos": "TESKYWFO", "skyw_name": "SKYWNAME", "skyw_alt": "SKY SKYW_ALT", "sci_skyw_sep": "SKY SCI_SKYW_SEP", "skyw_sh_hght": "SKY SKYW_SH_HGHT", "skyw_moon_sep": "SKY SKYW_MOON_SEP",
    "moon_ra": "SKY MOON_RA", "moon_dec": "SKY MOON_DEC", "moon_phase": "SKY MOON_PHASE", "moon_fli": "SKY MOON_FLI", "sun_alt": "SKY SUN_ALT", "moon_alt": "SKY MOON_ALT",
}


def read_frames(spark: SparkSession, path: str, mjd: int | Sequence[int] | None = None, schema: T.StructType | None = FRAME_SCHEMA) -> DataFrame:
    """The catalogue, or one or more of its nights (a partition filter where it is partitioned by mjd)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    frames = reader.parquet(path)
    return frames if mjd is None else frames.where(F.col("mjd").isin([mjd] if isinstance(mjd, int) else list(mjd)))


def write_frames(frames: DataFrame, path: str) -> None:
    """Write the catalogue by night; nights that frames holds replace those on disk."""
    frames.repartition("mjd").write.partitionBy("mjd").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def key(header: Column, name: str) -> Column:
    return F.try_element_at(header, F.lit(name))


def extract_metadata(headers: DataFrame, header: str = "header", name: str | None = None) -> DataFrame:
    """Typed columns of raw frames from header maps: lamps on or off, tile 11111 where there is none, quality GOOD unless said, the night from OBSTIME."""
    h = F.col(header)
    get = lambda k: key(h, k)
    tile = F.coalesce(get("TILE_ID"), get("TILEID")).try_cast("int")
    tile = F.when(tile.isNull() | tile.isin(-999, 999, 0), 11111).otherwise(tile)
    return headers.select(
        F.when(get("OBSERVAT") == "LCO", "s").otherwise("n").alias("hemi"),
        tile.alias("tileid"),
        tile_group(tile).alias("tilegrp"),
        F.coalesce(F.floor(to_sjd(F.try_to_timestamp(get("OBSTIME")))).cast("int"), get("MJD").try_cast("int")).alias("mjd"),
        get("MJD").try_cast("int").alias("rmjd"),
        get("IMAGETYP").alias("imagetyp"),
        get("SPEC").alias("spec"),
        get("CCD").alias("camera"),
        get("EXPOSURE").try_cast("long").alias("expnum"),
        get("EXPTIME").try_cast("double").alias("exptime"),
        *[F.coalesce(get(lamp.upper()).isin("ON", "True", "true", "T", "1"), F.lit(False)).alias(lamp) for lamp in LAMPS],
        F.coalesce(F.nullif(get("CALIBFIB"), F.lit("")), F.lit("None")).alias("calibfib"),
        F.coalesce(get("HARTMANN"), F.lit("0 0")).alias("hartmann"),
        F.coalesce(get("QAQUAL"), F.lit("GOOD")).alias("qaqual"),
        F.coalesce(get("DRPSTAGE").try_cast("long"), F.lit(1).cast("long")).alias("stage"),
        F.coalesce(get("DRPSTAT").try_cast("long"), F.lit(0).cast("long")).alias("status"),
        F.coalesce(get("DRPQUAL").try_cast("long"), F.lit(0).cast("long")).alias("drpqual"),
        (F.col(name) if name else get("FILENAME")).alias("name"),
    )


def collect_header(headers: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = (), header: str = "header") -> DataFrame:
    """Header keywords as columns under new names."""
    return headers.select(*keep, *[key(F.col(header), k).alias(c) for c, k in mapping.items()])


def keep_one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert_keep_last(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """base and new together, one row for each key: new ones first, then the last by order."""
    both = base.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, F.desc("__new"), *[F.desc(c) for c in order]).drop("__new")


def merge_shift_log(log: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """log and new together, the logged row kept where both have a key."""
    both = log.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, F.asc("__new"), *[F.asc(c) for c in order]).drop("__new")


def build_summary(frames: DataFrame, headers: DataFrame, epochs: DataFrame, keys: Sequence[str] = ("tileid", "mjd", "expnum"), order: Sequence[str] = ("camera",), kind: str = "object") -> DataFrame:
    """One row for each science exposure with its header columns and the latest calibration epoch; nulls become 'None' and -999."""
    from ..operators.joins import match_latest

    one = keep_one(frames.where(F.col("imagetyp") == kind), keys, *[F.asc(c) for c in order])
    out = match_latest(one, epochs, "mjd", "epoch").join(headers, "expnum", "left")
    return out.fillna("None").fillna(-999)


def export_summary(df: DataFrame, path: str | None = None, order: Sequence[str] = ("mjd", "expnum")) -> DataFrame:
    """Range-sorted by the keys; written as Parquet where a path is given."""
    out = df.orderBy(*order)
    if path:
        out.write.mode("overwrite").parquet(path)
    return out


def read_curve(spark: SparkSession, path: str, columns: Sequence[str], sep: str = " ") -> DataFrame:
    """A text table of numbers; lines that begin with # are comments."""
    schema = ", ".join(f"{c} double" for c in columns)
    return spark.read.schema(schema).csv(path, sep=sep, comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


POSITIONS = "x double, y double, good int, fiber_type string"


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSITIONS).csv(path, sep=" ", comment="#")


def write_positions(df: DataFrame, path: str) -> None:
    df.select("x", "y", "good", "fiber_type").write.mode("overwrite").csv(path, sep=" ")


def explode_spectra(spectra: DataFrame, keys: Sequence[str], columns: Sequence[str], k: str = "k") -> DataFrame:
    """One row for each sample of array columns of one length."""
    return spectra.select(*keys, F.posexplode(F.arrays_zip(*columns)).alias(k, "__v")).select(*keys, k, *[F.col(f"__v.{c}").alias(c) for c in columns])


def collect_spectra(samples: DataFrame, keys: Sequence[str], columns: Sequence[str], k: str = "k") -> DataFrame:
    """Array columns again, in order of k."""
    rows = samples.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(k, *columns))).alias("__v"))
    return rows.select(*keys, *[F.col("__v").getField(c).alias(c) for c in columns])


def read_factors(headers: DataFrame, keep: Sequence[str] = (), pattern: str = r"(gcoeff\d?|factor\d?)$", header: str = "header") -> DataFrame:
    """(keep..., key, value) of every header keyword that names a gradient coefficient or factor."""
    found = F.map_filter(F.col(header), lambda k, v: F.regexp(F.lower(k), F.lit(pattern)))
    return headers.select(*keep, F.explode(found).alias("key", "value")).withColumn("value", F.col("value").try_cast("double"))


def super_sky_table(samples: DataFrame, telescope: str, columns: Sequence[str], wave: str = "wave", which: str = "telescope") -> DataFrame:
    """Samples of one telescope's sky fibres, range-sorted by wavelength."""
    return samples.where(F.col(which) == telescope).select(*columns).orderBy(wave, *[c for c in columns if c != wave])


def unpivot_header_group(headers: DataFrame, group: str, fields: Sequence[str], n: int, keep: Sequence[str] = (), header: str = "header", needed: str = "FIB") -> DataFrame:
    """Keywords <group><i><field> for i in 1..n as rows (keep..., number, fields in lower case), where the needed field is there."""
    rows = headers.select(*keep, header, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("number"))
    cols = [F.try_element_at(F.col(header), F.concat(F.lit(group), F.col("number").cast("string"), F.lit(f))).alias(f.lower()) for f in fields]
    return rows.select(*keep, "number", *cols).where(F.col(needed.lower()).isNotNull())
