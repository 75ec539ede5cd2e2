"""The driver's tables as the tables that the operators work on; VIEWS has the same in SQL. Measured values are whole numbers, so that sums do not depend on their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "frames": "SELECT o_orderkey AS expnum, date_diff('day', DATE '1858-11-17', o_orderdate::DATE)::INT AS mjd, o_orderpriority AS camera, o_orderstatus AS imagetyp, floor(o_totalprice) AS exptime, o_custkey AS tileid FROM orders",
    "samples": "SELECT l_orderkey AS expnum, l_suppkey AS fiberid, l_linenumber AS k, floor(l_extendedprice) AS flux, l_quantity AS error, l_returnflag = 'R' AS mask, l_linestatus AS spec, l_partkey AS part FROM lineitem",
    "pixels": "SELECT l_returnflag AS camera, l_suppkey AS y, (l_partkey % 50)::INT AS x, l_linenumber AS frame, floor(l_extendedprice) AS value, l_quantity AS error, l_discount > 0.08 AS mask, l_orderkey AS expnum FROM lineitem",
    "spectra": "SELECT vec_id AS fiberid, label AS grp, embedding AS flux FROM embeddings",
    "cells": "SELECT vec_id AS fiberid, label AS grp, (unnest(range(len(embedding))))::INT AS k, round(unnest(embedding)::DOUBLE * 10000) AS flux FROM embeddings",
    "series": "SELECT user_id AS fiberid, epoch(ts)::DOUBLE AS wave, floor(value) AS flux, event_type AS class, event_id AS id FROM events",
    "fibermap": "SELECT s_suppkey AS fiberid, n_regionkey AS spectrographid, r_name AS telescope, n_name AS block, s_acctbal AS xpmm, ((s_suppkey * 37) % 101 - 50)::DOUBLE AS ypmm FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "stack": "SELECT l_returnflag AS camera, l_suppkey AS y, (l_partkey % 50)::INT AS x, l_linenumber AS frame, max(floor(l_extendedprice)) AS value, max(l_quantity) AS error, bool_or(l_discount > 0.08) AS mask FROM lineitem GROUP BY ALL",
}


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def frames(spark: SparkSession, d: str) -> DataFrame:
    mjd = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1858-11-17").cast("date"))
    return _read(spark, d, "orders").select(F.col("o_orderkey").alias("expnum"), mjd.alias("mjd"), F.col("o_orderpriority").alias("camera"), F.col("o_orderstatus").alias("imagetyp"), F.floor("o_totalprice").cast("double").alias("exptime"), F.col("o_custkey").alias("tileid"))


def samples(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("expnum"), F.col("l_suppkey").alias("fiberid"), F.col("l_linenumber").alias("k"), F.floor("l_extendedprice").cast("double").alias("flux"), F.col("l_quantity").alias("error"), (F.col("l_returnflag") == "R").alias("mask"), F.col("l_linestatus").alias("spec"), F.col("l_partkey").alias("part"))


def pixels(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "lineitem").select(F.col("l_returnflag").alias("camera"), F.col("l_suppkey").alias("y"), (F.col("l_partkey") % 50).cast("int").alias("x"), F.col("l_linenumber").alias("frame"), F.floor("l_extendedprice").cast("double").alias("value"), F.col("l_quantity").alias("error"), (F.col("l_discount") > 0.08).alias("mask"), F.col("l_orderkey").alias("expnum"))


def stack(spark: SparkSession, d: str) -> DataFrame:
    """pixels with one row for each camera, y, x and frame."""
    return pixels(spark, d).groupBy("camera", "y", "x", "frame").agg(F.max("value").alias("value"), F.max("error").alias("error"), F.bool_or("mask").alias("mask"))


def spectra(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "embeddings").select(F.col("vec_id").alias("fiberid"), F.col("label").alias("grp"), F.col("embedding").alias("flux"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """spectra with one row for each sample, in ten-thousandths."""
    return spectra(spark, d).select("fiberid", "grp", F.posexplode("flux").alias("k", "f")).select("fiberid", "grp", "k", F.round(F.col("f").cast("double") * 10000).alias("flux"))


def series(spark: SparkSession, d: str) -> DataFrame:
    wave = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return _read(spark, d, "events").select(F.col("user_id").alias("fiberid"), wave.alias("wave"), F.floor("value").cast("double").alias("flux"), F.col("event_type").alias("class"), F.col("event_id").alias("id"))


def fibermap(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = (_read(spark, d, t) for t in ("supplier", "nation", "region"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("fiberid"), F.col("n_regionkey").alias("spectrographid"), F.col("r_name").alias("telescope"), F.col("n_name").alias("block"), F.col("s_acctbal").alias("xpmm"), ((F.col("s_suppkey") * 37) % 101 - 50).cast("double").alias("ypmm"))
