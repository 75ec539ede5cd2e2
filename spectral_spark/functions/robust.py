"""Robust statistics of groups. One shuffle by the group's keys serves the median, the deviations and the weighted sums."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import small
from ..shared import stored

#: Ratio of the standard deviation to the median absolute deviation of a normal distribution.
MAD_TO_SIGMA = 1.4826


def median(c: Column) -> Column:
    return F.percentile(c, F.lit(0.5))


def _about_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with a value, the group's median as __m and the median of absolute deviations as __d."""
    w = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)])
    v = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).withColumn("__m", median(F.col(value)).over(w))
    return v.withColumn("__d", median(F.abs(F.col(value) - F.col("__m"))).over(w))


def _about_quantile(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The same for few and large groups, of which no task holds one: medians by exact quantiles, joined to the stored values."""
    v = stored(df.select(*keys, value).where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))), "values")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] or [F.lit(True)]
    for x, name in ((F.col(value), "__m"), (F.abs(F.col(value) - F.col("__m")), "__d")):
        mid = stored(quantile(v.withColumn("__x", x), keys, "__x", 0.5, name), "medians")
        v = v.alias("a").join(small(mid).alias("b"), same).select("a.*", name)
    return v


def biweight_stats(df: DataFrame, keys: Sequence[str], value: str, c_location: float = 6.0, c_scale: float = 9.0, large: bool = False) -> DataFrame:
    """For each group: n, median, mad (unscaled), the biweight location and scale; the median and 0 where the mad is 0.

    Beers, Flynn & Gebhardt 1990. Nulls and NaN do not count; a group without values has no row.
    A group's values meet in one task's window, which spills; say large where groups are few and grow with the table.
    """
    v = (_about_quantile if large else _about_median)(df, keys, value)
    x, d = F.col(value) - F.col("__m"), F.col("__d")
    u = lambda c: F.try_divide(x, c * d)
    near, far = u(F.lit(c_location)), u(F.lit(c_scale))
    one = lambda t: 1 - t * t
    agg = v.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("__m").alias("median"),
        F.min("__d").alias("mad"),
        F.sum(F.when(F.abs(near) < 1, x * one(near) * one(near))).alias("__a"),
        F.sum(F.when(F.abs(near) < 1, one(near) * one(near))).alias("__b"),
        F.sum(F.when(F.abs(far) < 1, x * x * one(far) * one(far) * one(far) * one(far))).alias("__c"),
        F.sum(F.when(F.abs(far) < 1, one(far) * (1 - 5 * far * far))).alias("__e"),
    )
    flat = F.col("mad") == 0
    location = F.when(flat, F.col("median")).otherwise(F.col("median") + F.try_divide("__a", "__b"))
    scale = F.when(flat, 0.0).otherwise(F.try_divide(F.sqrt(F.col("n") * F.col("__c")), F.abs("__e")))
    return agg.select(*keys, "n", "median", "mad", location.alias("location"), scale.alias("scale"))


def mad_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """For each group: median and sigma = 1.4826 times the median absolute deviation."""
    v = _about_median(df, keys, value)
    return v.groupBy(*keys).agg(F.min("__m").alias("median"), (F.min("__d") * MAD_TO_SIGMA).alias("sigma"))


def statistic(df: DataFrame, keys: Sequence[str], value: str, stat: str | Callable[[Column], Column] = "median", out: str | None = None) -> DataFrame:
    """One statistic of a group by name (mean, median, sum, std, min, max, biweight, biweight_scale, mad) or as a function of a column."""
    name = out or value
    if stat in ("biweight", "biweight_scale"):
        s = biweight_stats(df, keys, value)
        return s.select(*keys, F.col("location" if stat == "biweight" else "scale").alias(name))
    if stat == "mad":
        return mad_stats(df, keys, value).select(*keys, F.col("sigma").alias(name))
    f = {"mean": F.avg, "median": median, "sum": F.sum, "std": F.stddev_pop, "min": F.min, "max": F.max}.get(stat, stat)
    return df.groupBy(*keys).agg(f(F.col(value)).alias(name))


#: Ranks of the sketch that bounds a quantile: its values are off by a part in so many of the group.
SKETCH = 10_000


def quantile(df: DataFrame, keys: Sequence[str], value: str, share: float, out: str = "quantile", store: bool = False) -> DataFrame:
    """(keys, out): the exact quantile of large groups, interpolated like a percentile; nulls and NaN do not count.

    A mergeable sketch of each group gives two values about the quantile's rank, a few thousandths of the group apart in
    rank however its values are spread. Then each task counts: what lies below the two, and each distinct value between
    them. So a group's values never meet; a task sees the counts of the values between, 1/200 of a group at most. Groups of
    up to 4 * SKETCH values are counted by distinct value. The values are read twice: ask to store them in the shared folder
    where they are costly to make.
    """
    v = df.select(*keys, F.col(value).cast("double").alias("__v")).where("__v is not null and not isnan(__v)")
    if store:
        v = stored(v, "values")
    pad = 20 / SKETCH
    about = F.percentile_approx("__v", [max(0.0, share - pad), min(1.0, share + pad)], SKETCH)
    span = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), about.alias("__about"))
    whole = F.col("__n") <= 4 * SKETCH
    low = F.when(whole | F.lit(share <= pad), F.col("__min")).otherwise(F.get("__about", F.lit(0)))
    high = F.when(whole | F.lit(share >= 1 - pad), F.col("__max")).otherwise(F.get("__about", F.lit(1)))
    rank = (F.col("__n") - 1) * F.lit(float(share))
    span = stored(span.select(*keys, low.alias("__low"), high.alias("__high"), rank.alias("__rank")), "spans")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] or [F.lit(True)]
    inside = F.when(F.col("__v") >= F.col("__low"), F.col("__v"))
    kept = v.alias("a").join(small(span).alias("b"), same).where("__v <= __high").select(*[f"a.{k}" for k in keys], inside.alias("__v"), "__rank")
    counts = kept.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"), F.max("__rank").alias("__rank"))
    upto = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy(F.asc_nulls_first("__v"))
    ranked = counts.withColumn("__upto", F.sum("__c").over(upto))
    first = lambda r: F.min_by("__v", F.when(F.col("__upto") > r, F.col("__upto")))
    two = ranked.groupBy(*keys).agg(first(F.floor("__rank")).alias("__a"), first(F.ceil("__rank")).alias("__z"), F.max(F.col("__rank") - F.floor("__rank")).alias("__t"))
    two = two.withColumns({c: F.coalesce(c, F.raise_error(F.lit("a quantile lies outside its sketch's bounds")).cast("double")) for c in ("__a", "__z")})
    step = F.when(F.col("__z") == F.col("__a"), 0.0).otherwise(F.col("__t") * (F.col("__z") - F.col("__a")))
    return two.select(*keys, (F.col("__a") + step).alias(out))


def percentile_normalize(df: DataFrame, frame: Sequence[str], value: str, percent: float) -> DataFrame:
    """Scale each frame so that its percentile is the median of all frames' (a column `factor` tells by how much)."""
    per = quantile(df, frame, value, percent / 100, "__p")
    whole = per.agg(median(F.col("__p")).alias("__t"))
    factors = per.crossJoin(F.broadcast(whole)).select(*frame, F.try_divide("__t", "__p").alias("factor"))  # one row
    return df.join(factors, list(frame), "left").withColumn(value, F.col(value) * F.col("factor"))


def zscore_mask(df: DataFrame, row: Sequence[str], column: Sequence[str], value: str, threshold: float, share: float = 0.3) -> DataFrame:
    """Robust scores against each row's biweight location and scale; `outlier` marks the columns where more than a share is beyond the threshold."""
    stats = biweight_stats(df, row, value).select(*row, "location", "scale")
    z = F.try_divide(F.col(value) - F.col("location"), F.col("scale"))
    scored = df.join(stats, list(row), "left").withColumn("z", F.coalesce(z, F.lit(0.0)))
    w = Window.partitionBy(*column)
    return scored.withColumn("outlier", F.avg((F.abs("z") > threshold).cast("int")).over(w) > share).drop("location", "scale")
