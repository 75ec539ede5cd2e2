"""Joins: header fixes, calibration matching, detrending, arithmetic on keyed arrays, positions, interpolation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import shared_path

#: Calibration products that a kind of frame needs.
NEEDS = {
    "bias": ["pixmask"],
    "pixflat": ["pixmask", "bias", "dark"],
    "trace": ["pixmask", "pixflat", "bias"],
    "wave": ["pixmask", "pixflat", "bias", "centroids", "sigmas", "model"],
    "dome": ["pixmask", "pixflat", "bias", "centroids", "sigmas", "model", "wave", "lsf"],
    "twilight": ["pixmask", "pixflat", "bias", "centroids", "sigmas", "model", "wave", "lsf"],
    "object": ["pixmask", "pixflat", "bias", "centroids", "sigmas", "model", "wave", "lsf", "fiberflat_twilight"],
}
#: Most rows of a rule or dimension table that is broadcast.
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it has few enough rows; the optimiser decides otherwise."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def carried(point: Column, keys: Sequence[Column], order: str, rows: bool = False) -> tuple[Column, Column]:
    """(the last point at or before a row, the first at or after it) where point is not null, in order of a column.

    Both look backward, the second in descending order: a forward window would read the rest of its partition again for each row.
    """
    up, down = (Window.partitionBy(*keys or [F.lit(0)]).orderBy(o) for o in (F.asc(order), F.desc(order)))
    upto = (lambda w: w.rowsBetween(Window.unboundedPreceding, 0)) if rows else (lambda w: w.rangeBetween(Window.unboundedPreceding, 0))
    return F.last(point, True).over(upto(up)), F.last(point, True).over(upto(down))


def glob_regex(pattern: Column) -> Column:
    """A file pattern (*, ?, [a-b]) as a regular expression on whole names."""
    quoted = F.regexp_replace(pattern, r"([.+(){}|^$\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("[!"), F.lit("[^")), F.lit("$"))


#: Characters of a rule's literal by which it is looked up, and the least that are used where literals are shorter.
GRAM, SHORT = 8, 3


def rule_literal(pattern: Column) -> Column:
    """The last GRAM characters of the longest part of a file pattern without *, ? and [...], the last of several."""
    parts = F.transform(F.split(pattern, r"[*?]|\[[^\]]*\]"), lambda p, i: F.struct(F.length(p).alias("n"), i.alias("i"), F.right(p, F.lit(GRAM)).alias("p")))
    return F.array_max(parts)["p"]


def apply_header_fixes(frames: DataFrame, fixes: DataFrame, name: str, keywords: Sequence[str]) -> DataFrame:
    """Override keyword columns by rules (rule_no, fileroot, keyword, value) whose pattern fits the name; the last rule wins.

    Rules are indexed by a literal part of their pattern: GRAM characters, or SHORT of a shorter one. Distinct names are
    listed under their substrings of these lengths and meet the rules by equality, so that regular expressions run on
    candidates alone. Rules without a literal of SHORT characters are few broad ones and are tried on every distinct name.
    """
    literal = rule_literal(F.col("fileroot"))
    rules = fixes.withColumn("__regex", glob_regex(F.col("fileroot"))).withColumn("__gram", F.when(F.length(literal) >= GRAM, literal).when(F.length(literal) >= SHORT, F.right(literal, F.lit(SHORT))))
    names = frames.select(F.col(name).alias("__name")).distinct()
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.length("__name") - n + 1), lambda i: F.substring(F.col("__name"), i, F.lit(n)))
    grams = F.concat(*[F.when(F.length("__name") >= n, cut(n)).otherwise(F.array().cast("array<string>")) for n in (GRAM, SHORT)])
    listed = names.withColumn("__gram", F.explode(F.array_distinct(grams)))
    fits = F.regexp(F.col("__name"), F.col("__regex"))
    hits = listed.join(small(rules.where("__gram is not null")), "__gram").where(fits).drop("__gram")
    broad = small(rules.where("__gram is null"))
    hits = hits.unionByName(names.join(broad.drop("__gram"), fits).select(*hits.columns))
    last = hits.groupBy("__name").agg(*[F.max_by(F.when(F.col("keyword") == k, F.col("value")), F.when(F.col("keyword") == k, F.col("rule_no"))).alias(f"__{k}") for k in keywords])
    out = frames.join(last, F.col(name) == F.col("__name"), "left")
    return out.withColumns({k: F.coalesce(F.col(f"__{k}"), F.col(k)) for k in keywords}).drop("__name", *[f"__{k}" for k in keywords])


def match_nearest(targets: DataFrame, masters: DataFrame, on: Sequence[str], time: str = "mjd", master_time: str = "master_mjd") -> DataFrame:
    """The master nearest in time with the same `on`; the earlier of two at one distance, null where there is none.

    Distinct (on, time) of the targets and the masters' times lie in one ordered window: the last before and the first after.
    """
    points = targets.select(*on, F.col(time).alias("__t")).distinct().withColumn("__m", F.lit(None).cast(masters.schema[master_time].dataType))
    known = masters.select(*on, F.col(master_time).alias("__t"), F.col(master_time).alias("__m")).distinct()
    before, after = carried(F.col("__m"), [F.col(c) for c in on], "__t")
    both = points.withColumn("__q", F.lit(True)).unionByName(known.withColumn("__q", F.lit(False)))
    both = both.withColumn("__b", before).withColumn("__a", after).where("__q")
    nearer = F.when(F.col("__b").isNull() | (F.col("__a") - F.col("__t") < F.col("__t") - F.col("__b")), F.col("__a")).otherwise(F.col("__b"))
    best = both.select(*[F.col(c).alias(f"__{c}") for c in on], F.col("__t"), nearer.alias(master_time))
    return targets.join(best, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on] + [F.col(time) == F.col("__t")], "left").drop("__t", *[f"__{c}" for c in on])


def match_latest(targets: DataFrame, epochs: DataFrame, time: str = "mjd", epoch: str = "epoch", on: Sequence[str] = ()) -> DataFrame:
    """The latest epoch at or before each target's time; null where none precedes.

    Distinct times and the epochs lie in one ordered window for each `on`; both are days, so there are few.
    """
    kind = targets.schema[time].dataType
    times = targets.select(*on, F.col(time).alias("__t")).distinct().withColumn("__e", F.lit(None).cast(epochs.schema[epoch].dataType)).withColumn("__q", F.lit(True))
    known = epochs.select(*on, F.col(epoch).cast(kind).alias("__t"), F.col(epoch).alias("__e")).distinct().withColumn("__q", F.lit(False))
    before, _ = carried(F.col("__e"), [F.col(c) for c in on], "__t")
    best = times.unionByName(known).withColumn(epoch, before).where("__q").select(*[F.col(c).alias(f"__{c}") for c in on], "__t", epoch)
    return targets.join(best, [F.col(c) == F.col(f"__{c}") for c in on] + [F.col(time) == F.col("__t")], "left").drop("__t", *[f"__{c}" for c in on])


def nearest_reference(frames: DataFrame, on: Sequence[str], number: str = "expnum") -> DataFrame:
    """The nearest other exposure of the class, the earlier of two; null for a class of one."""
    w = Window.partitionBy(*on).orderBy(number)
    b, a = F.lag(number).over(w), F.lead(number).over(w)
    return frames.withColumn("reference", F.when(b.isNull() | (a - F.col(number) < F.col(number) - b), a).otherwise(b))


def expand_needs(frames: DataFrame, kind: str = "imagetyp", needs: Mapping[str, Sequence[str]] = NEEDS) -> DataFrame:
    """A row for each product that a frame needs."""
    table = F.create_map(*[x for k, v in needs.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return frames.withColumn("product", F.explode(F.try_element_at(table, F.col(kind))))


def completeness(needed: DataFrame, present: DataFrame, keys: Sequence[str], by: str = "product") -> DataFrame:
    """For each product: how many are needed, present, and the share."""
    out = needed.join(present.select(*keys).distinct().withColumn("__here", F.lit(1)), list(keys), "left")
    return out.groupBy(by).agg(F.count(F.lit(1)).alias("needed"), F.count("__here").alias("present")).withColumn("share", F.col("present") / F.col("needed"))


def detrend(pixels: DataFrame, bias: DataFrame, dark: DataFrame, flat: DataFrame, keys: Sequence[str] = ("camera", "y", "x"), gain: Column | float = 1.0, exptime: Column | float = 1.0, dark_time: float = 1.0) -> DataFrame:
    """((raw - bias) gain - dark t / t_dark) / flat; a missing master is 0, 0 or 1. The flat divides the value alone, masks add up."""
    lit = lambda x: F.lit(x) if isinstance(x, int | float) else x
    out = pixels
    for name, master in (("bias", bias), ("dark", dark), ("flat", flat)):
        out = out.join(master.select(*keys, F.col("value").alias(f"__{name}"), F.col("mask").alias(f"__m{name}")), list(keys), "left")
    value = (F.col("value") - F.coalesce("__bias", F.lit(0.0))) * lit(gain) - F.coalesce("__dark", F.lit(0.0)) * lit(exptime) / dark_time
    value = F.try_divide(value, F.coalesce("__flat", F.lit(1.0)))
    mask = F.col("mask") | F.coalesce("__mbias", F.lit(False)) | F.coalesce("__mdark", F.lit(False)) | F.coalesce("__mflat", F.lit(False)) | value.isNull()
    return out.withColumns({"value": value, "mask": mask}).drop("__bias", "__dark", "__flat", "__mbias", "__mdark", "__mflat")


def lay_out(df: DataFrame, table: str, keys: Sequence[str] = ("camera", "y", "x"), buckets: int = 64) -> DataFrame:
    """df as a table in the shared folder, bucketed and sorted by the keys: tables of one layout join without a shuffle.

    Masters are laid out once for all exposures that they detrend; raw frames as they come in. The number of buckets must be
    the same, and so large that a bucket's pixels fit a task. A table of the name is replaced.
    """
    df.write.mode("overwrite").option("path", shared_path(df.sparkSession, table)).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def combine_columns(a: Column, ea: Column, b: Column, eb: Column, op: str) -> tuple[Column, Column]:
    """(value, error) of a op b: errors in quadrature for sums, relative errors for products."""
    if op in "+-":
        return (a + b if op == "+" else a - b), F.sqrt(ea * ea + eb * eb)
    if op == "*":
        return a * b, F.sqrt(ea * b * ea * b + eb * a * eb * a)
    if op == "/":
        v = F.try_divide(a, b)
        return v, F.sqrt(F.try_divide(ea, b) * F.try_divide(ea, b) + F.try_divide(eb * a, b * b) * F.try_divide(eb * a, b * b))
    raise ValueError(f"no such operation: {op}")


def arith(a: DataFrame, b: DataFrame, op: str, keys: Sequence[str], value: str = "flux", error: str = "error", mask: str = "mask") -> DataFrame:
    """a op b where both have the keys; masks are or-ed, an undefined value is null and masked."""
    right = b.select(*keys, F.col(value).alias("__v"), F.col(error).alias("__e"), F.col(mask).alias("__m"))
    v, e = combine_columns(F.col(value), F.col(error), F.col("__v"), F.col("__e"), op)
    out = a.join(right, list(keys)).withColumns({"__nv": v, "__ne": e, "__nm": F.col(mask) | F.col("__m") | v.isNull()})
    return out.withColumns({value: F.col("__nv"), error: F.col("__ne"), mask: F.col("__nm")}).drop("__v", "__e", "__m", "__nv", "__ne", "__nm")


def arith_scalar(df: DataFrame, number: float, op: str, value: str = "flux", error: str = "error") -> DataFrame:
    """value op number; the operation is applied to the error too."""
    f = {"+": lambda c: c + number, "-": lambda c: c - number, "*": lambda c: c * number, "/": lambda c: c / number}[op]
    return df.withColumns({value: f(F.col(value)), error: f(F.col(error))})


def apply_fiberflat(samples: DataFrame, flat: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Divide by the flat of the same keys; what is not finite is masked. A fibre without a flat stays as it is."""
    right = flat.select(*keys, F.col("flux").alias("__f"))
    v = F.try_divide("flux", F.coalesce("__f", F.lit(1.0)))
    out = samples.join(right, list(keys), "left").withColumns({"__v": v, "error": F.try_divide("error", F.coalesce("__f", F.lit(1.0))), "mask": F.col("mask") | v.isNull()})
    return out.withColumn("flux", F.col("__v")).drop("__v", "__f")


def near_pairs(a: DataFrame, b: DataFrame, r: float, ax: str = "x", ay: str = "y", bx: str = "bx", by: str = "by", distance: str = "distance") -> DataFrame:
    """Pairs within r in the plane. b is listed under the nine cells about each point, so that pairs join by equality of a cell.

    Neither side is broadcast: the optimiser does not see that b's rows are listed nine times.
    """
    cell = lambda c: F.floor(c / r).cast("long")
    spread = F.explode(F.array(*[F.struct((cell(F.col(bx)) + i).alias("i"), (cell(F.col(by)) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    right = b.withColumn("__c", spread)
    left = a.withColumn("__i", cell(F.col(ax))).withColumn("__j", cell(F.col(ay)))
    d2 = (F.col(ax) - F.col(bx)) * (F.col(ax) - F.col(bx)) + (F.col(ay) - F.col(by)) * (F.col(ay) - F.col(by))
    return left.join(right.hint("merge"), (F.col("__i") == F.col("__c.i")) & (F.col("__j") == F.col("__c.j"))).where(d2 <= r * r).withColumn(distance, F.sqrt(d2)).drop("__i", "__j", "__c")


def _ra_cells(zone: Column, r: float) -> Column:
    """Into how many cells of right ascension a zone of declination is cut, so that points within r degrees lie in neighbouring cells; 1 near a pole."""
    far = F.greatest(F.abs(zone * r - 90), F.abs((zone + 1) * r - 90)) + r  # the greatest declination of a point within r of the zone
    width = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(r))) / F.cos(F.radians(far)))))
    return F.when(far >= 90, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0) / width))).cast("long")


def near_pairs_sky(a: DataFrame, b: DataFrame, r: float, ax: str = "x", ay: str = "y", bx: str = "bx", by: str = "by", distance: str = "distance") -> DataFrame:
    """Pairs within r degrees on the sphere; right ascensions (x) and declinations (y) in degrees, any turn of the former.

    Declinations are cut into zones of r degrees and zones into cells that widen towards the poles; b is listed under the
    cells about it in three zones, around 0 and 360, so that pairs join by equality. Distances are haversines, which keep
    their digits for small angles. Points without a position or beyond a pole have no pairs. Neither side is broadcast.
    """
    zone = lambda dec: F.floor((dec + 90) / r).cast("long")
    place = lambda ra, n: F.least(F.floor(F.pmod(ra.cast("double"), F.lit(360.0)) / 360 * n).cast("long"), n - 1)
    right = b.where(F.col(by).between(-90, 90)).withColumn("__z", F.explode(F.array(*[zone(F.col(by)) + i for i in (-1, 0, 1)])))
    n, c = _ra_cells(F.col("__z"), r), place(F.col(bx), _ra_cells(F.col("__z"), r))
    right = right.withColumn("__c", F.explode(F.array_distinct(F.array(*[F.pmod(c + i, n) for i in (-1, 0, 1)]))))
    left = a.where(F.col(ay).between(-90, 90)).withColumn("__za", zone(F.col(ay))).withColumn("__ca", place(F.col(ax), _ra_cells(F.col("__za"), r)))
    half = lambda x, y: F.sin(F.radians((x - y) / 2))
    u, v = half(F.col(ay), F.col(by)), half(F.col(ax), F.col(bx))
    h = u * u + F.cos(F.radians(F.col(ay))) * F.cos(F.radians(F.col(by))) * v * v
    out = left.join(right.hint("merge"), (F.col("__za") == F.col("__z")) & (F.col("__ca") == F.col("__c")))
    return out.withColumn(distance, F.degrees(2 * F.asin(F.least(F.sqrt(h), F.lit(1.0))))).where(F.col(distance) <= r).drop("__za", "__ca", "__z", "__c")


def cone_match(fibers: DataFrame, stars: DataFrame, r: float, fiber: str = "fiberid", sky: bool = False) -> DataFrame:
    """Stars (bx, by) within r of a fibre (x, y), of fibres that hold one star alone; in the plane or, in degrees, on the sky.

    Places are paired, not rows: stars at one place are counted first, and fibres at one place ask once.
    """
    spots = stars.groupBy("bx", "by").agg(F.count(F.lit(1)).alias("__k"), F.first(F.struct(*[c for c in stars.columns if c not in ("bx", "by")])).alias("__star"))
    pairs = (near_pairs_sky if sky else near_pairs)(fibers.select("x", "y").distinct(), spots, r)
    found = pairs.groupBy("x", "y").agg(F.sum("__k").alias("__k"), F.first(F.struct("bx", "by", "distance", "__star")).alias("__p"))
    out = fibers.join(found.hint("merge"), ["x", "y"]).withColumn("__n", F.sum("__k").over(Window.partitionBy(fiber))).where("__n = 1")
    return out.select(*fibers.columns, *[F.col(f"__p.{c}" if c in ("bx", "by") else f"__p.__star.{c}") for c in stars.columns], F.col("__p.distance").alias("distance"))


def brightest_in_radius(catalogue: DataFrame, centres: DataFrame, r: float, limit: float, n: int, centre: str = "centre", mag: str = "mag", star: str = "star", sky: bool = False) -> DataFrame:
    """The n brightest sources under a magnitude limit about each centre; in the plane or, in degrees, on the sky.

    Places are paired, not rows: of the sources at one place only the n brightest can be chosen, and centres at one place
    ask once.
    """
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(mag, star))
    kept = catalogue.where(F.col(mag) < limit).withColumn("__r", first("x", "y")).where(F.col("__r") <= n)
    spots = kept.groupBy("x", "y").agg(F.collect_list(F.struct(*[c for c in catalogue.columns if c not in ("x", "y")])).alias("__s"))
    pairs = (near_pairs_sky if sky else near_pairs)(spots, centres.select("bx", "by").distinct(), r)
    asked = pairs.select("x", "y", "bx", "by", "distance", F.explode("__s").alias("__s")).select("x", "y", "bx", "by", "distance", "__s.*")
    best = asked.withColumn("__r", first("bx", "by")).where(F.col("__r") <= n).drop("__r")
    out = centres.join(best.hint("merge"), ["bx", "by"]).withColumn("rank", first(centre)).where(F.col("rank") <= n)
    return out.select(*catalogue.columns, *centres.columns, "distance", "rank")


def aperture_members(fibers: DataFrame, apertures: DataFrame, r: float) -> DataFrame:
    """Fibres (x, y) within r of each aperture's centre (bx, by)."""
    return near_pairs(fibers, apertures, r)


def aperture_totals(fibers: DataFrame, apertures: DataFrame, r: float, value: str) -> DataFrame:
    """Apertures (bx, by) with fibres (x, y) within r: how many members, and the total of a column over them.

    Places are paired, not rows: fibres at one place are summed first, and apertures at one place ask once.
    """
    spots = fibers.groupBy("x", "y").agg(F.count(F.lit(1)).alias("__k"), F.sum(value).alias("__v"))
    found = aperture_members(spots, apertures.select("bx", "by").distinct(), r).groupBy("bx", "by").agg(F.sum("__k").alias("members"), F.sum("__v").alias("total"))
    return apertures.join(found.hint("merge"), ["bx", "by"]).select(*apertures.columns, "members", "total")


#: Most curve points that one cell of the lookup may hold, and the ranges of wavelength that a large curve is cut into.
CELL_POINTS, RANGES = 64, 2_000


def interp_onto(samples: DataFrame, curve: DataFrame, wave: str = "wave", out: str = "curve", curve_wave: str = "cw", curve_value: str = "cv", on: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation of a curve (cw, cv) at samples' wavelengths, its end values beyond it; null where there is no curve.

    One curve of counted size is cut into segments under cells of one width, which are broadcast: samples find their
    segment by equality of a cell and are not shuffled. A larger or very uneven curve, and curves by key (`on`), meet the
    distinct wavelengths in ordered windows, by key or by range of wavelength. Of points at one wavelength the least counts.
    """
    points = curve.select(*on, F.col(curve_wave).cast("double").alias("__x"), F.col(curve_value).cast("double").alias("__y")).where("__x is not null and __y is not null").groupBy(*on, "__x").agg(F.min("__y").alias("__y"))
    if on:
        return _interp_by_windows(samples, points, wave, out, on)
    size = points.agg(F.count(F.lit(1)).alias("n"), F.min("__x").alias("lo"), F.max("__x").alias("hi")).first()
    if size["n"] == 0:
        return samples.withColumn(out, F.lit(None).cast("double"))
    cells = 2 * size["n"]
    width = (size["hi"] - size["lo"]) / cells or 1.0
    cell = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(float(cells)), F.floor((x - size["lo"]) / width).cast("double"))).cast("int")
    if size["n"] <= BROADCAST_ROWS:
        nxt = Window.partitionBy(F.lit(0)).orderBy("__x")  # at most BROADCAST_ROWS points
        inside = points.select("__x", "__y", F.lead("__x").over(nxt).alias("__x2"), F.lead("__y").over(nxt).alias("__y2"))
        first = points.groupBy().agg(F.min_by("__y", "__x").alias("__y2")).select(F.lit(float("-inf")).alias("__x"), "__y2", F.lit(size["lo"]).alias("__x2"))
        segments = inside.select("__x", "__y", F.coalesce("__x2", F.lit(float("inf"))).alias("__x2"), F.coalesce("__y2", "__y").alias("__y2"))
        segments = segments.unionByName(first.select("__x", F.col("__y2").alias("__y"), "__x2", "__y2"))
        listed = segments.withColumn("__cell", F.explode(F.sequence(cell(F.col("__x")), cell(F.col("__x2")))))
        fullest = listed.groupBy("__cell").count().agg(F.max("count")).first()[0]
        if fullest <= CELL_POINTS:
            x = F.col(wave).cast("double")
            near = (F.col("__c") == F.col("__cell")) & (x >= F.col("__x")) & (x < F.col("__x2"))
            slope = F.when(F.col("__y2") == F.col("__y"), 0.0).otherwise((x - F.col("__x")) / (F.col("__x2") - F.col("__x")) * (F.col("__y2") - F.col("__y")))
            joined = samples.withColumn("__c", cell(x)).join(F.broadcast(listed), near, "left")
            return joined.withColumn(out, F.col("__y") + slope).drop("__c", "__cell", "__x", "__y", "__x2", "__y2")
    return _interp_by_windows(samples, points, wave, out, ())


def _interp_by_windows(samples: DataFrame, points: DataFrame, wave: str, out: str, on: Sequence[str]) -> DataFrame:
    """Distinct wavelengths and the points (on, __x, __y) in ordered windows by key; without keys, in ranges of wavelength that hand on the points at their ends."""
    keys = [F.col(c) for c in on]
    asked = samples.select(*on, F.col(wave).cast("double").alias("__w")).where("__w is not null").distinct().withColumn("__pt", F.lit(None).cast("struct<x:double,y:double>"))
    known = points.select(*on, F.col("__x").alias("__w"), F.struct(F.col("__x").alias("x"), F.col("__y").alias("y")).alias("__pt"))
    both = asked.withColumn("__q", F.lit(True)).unionByName(known.withColumn("__q", F.lit(False)))
    if on:
        before, after = carried(F.col("__pt"), keys, "__w")
        both = both.withColumn("__b", before).withColumn("__a", after)
    else:
        cuts = sorted(set(points.approxQuantile("__x", [k / RANGES for k in range(1, RANGES)], 0.5 / RANGES)))
        both = both.withColumn("__r", _bucket(F.col("__w"), cuts))
        ends = both.where("not __q").groupBy("__r").agg(F.min("__pt").alias("__lo"), F.max("__pt").alias("__hi"))
        every = points.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("__r")).join(ends, "__r", "left")
        one = lambda o: Window.partitionBy(F.lit(0)).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)  # noqa: E731  a row for each range
        every = every.select("__r", F.last("__hi", True).over(one(F.asc("__r"))).alias("__left"), F.last("__lo", True).over(one(F.desc("__r"))).alias("__right"))
        before, after = carried(F.col("__pt"), [F.col("__r")], "__w")
        both = both.withColumn("__b", before).withColumn("__a", after).join(F.broadcast(every), "__r").withColumns({"__b": F.coalesce("__b", "__left"), "__a": F.coalesce("__a", "__right")})
    b, a, x = F.col("__b"), F.col("__a"), F.col("__w")
    y = F.when(b.isNull(), a["y"]).when(a.isNull() | (a["x"] == b["x"]), b["y"]).otherwise(b["y"] + (x - b["x"]) / (a["x"] - b["x"]) * (a["y"] - b["y"]))
    best = both.where("__q").select(*[F.col(c).alias(f"__{c}") for c in on], F.col("__w"), y.alias(out))
    return samples.join(best, [F.col(c) == F.col(f"__{c}") for c in on] + [F.col(wave).cast("double") == F.col("__w")], "left").drop("__w", *[f"__{c}" for c in on])


def interp_columns(samples: DataFrame, curve: DataFrame, wave: str, columns: Mapping[str, str], on: Sequence[str], curve_wave: str = "cw") -> DataFrame:
    """interp_onto for several columns of curves by key at once: columns names each new column's column in the curve. One point for each wavelength."""
    kind = curve.select(F.struct(F.col(curve_wave).cast("double").alias("x"), *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(columns.values())]).alias("__pt"), *on, F.col(curve_wave).cast("double").alias("__w")).where("__w is not null")
    asked = samples.select(*on, F.col(wave).cast("double").alias("__w")).where("__w is not null").distinct().withColumn("__pt", F.lit(None).cast(kind.schema["__pt"].dataType))
    before, after = carried(F.col("__pt"), [F.col(c) for c in on], "__w")
    both = asked.withColumn("__q", F.lit(True)).unionByName(kind.withColumn("__q", F.lit(False))).withColumns({"__b": before, "__a": after}).where("__q")
    b, a, x = F.col("__b"), F.col("__a"), F.col("__w")
    line = lambda y: F.when(b.isNull(), a[y]).when(a.isNull() | (a["x"] == b["x"]), b[y]).otherwise(b[y] + (x - b["x"]) / (a["x"] - b["x"]) * (a[y] - b[y]))
    best = both.select(*[F.col(c).alias(f"__{c}") for c in on], "__w", *[line(f"y{i}").alias(c) for i, c in enumerate(columns)])
    return samples.join(best, [F.col(c) == F.col(f"__{c}") for c in on] + [F.col(wave).cast("double") == F.col("__w")], "left").drop("__w", *[f"__{c}" for c in on])


def _bucket(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted cuts are at or below x, by halving."""
    table = F.array(*map(F.lit, cuts))
    step = 1 << (len(cuts).bit_length() - 1)
    steps = [step >> k for k in range(step.bit_length())]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, n: F.when((low + n <= len(cuts)) & (F.get(table, low + n - 1) <= x), low + n).otherwise(low))


def coalesce_tables(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of either; values of b where a's are missing."""
    right = b.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    return a.select(*keys, *columns).join(right, list(keys), "full_outer").select(*keys, *[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) for c in columns])


def anti_shifted(frames: DataFrame, shifted: DataFrame, on: Sequence[str] = ("expnum",)) -> DataFrame:
    return frames.join(shifted.select(*on), list(on), "left_anti")


def semi_standards(frames: DataFrame, fibermap: DataFrame, ring: DataFrame, label: str = "calibfib") -> DataFrame:
    """Frames whose standard is in the fibre map and in the ring."""
    return frames.join(fibermap.select(label), label, "left_semi").join(ring.select(label), label, "left_semi")


def epoch_ranges(a: DataFrame, b: DataFrame, ea: str = "a_epoch", eb: str = "b_epoch") -> DataFrame:
    """For each epoch of a the epochs of b from it until the next one of a; epochs of b before the first of a have none."""
    return match_latest(b, a.select(ea).distinct(), eb, ea).where(F.col(ea).isNotNull())


#: Seconds of a day, which a clock loses at midnight.
DAY = 86_400.0


def time_model(series: DataFrame, targets: DataFrame, on: Sequence[str], order: int = 0, value: str = "flux", time: str = "t", start: str = "start", end: str = "end", target: str = "target") -> DataFrame:
    """For each target and key the mean of a polynomial in time through the series over the target's interval.

    The polynomial is fitted by sums of powers of the time, centred and scaled for each key, and integrated over the
    interval. An interval that ends before it starts passes midnight: a day is added to its end. A key with fewer distinct
    times than the polynomial needs gets the mean of its values.
    """
    from .fits import polyfit

    t, v = F.col(time), F.col(value)
    known = series.where(t.isNotNull() & v.isNotNull())
    span = known.groupBy(*on).agg(F.avg(v).alias("__mean"), ((F.min(t) + F.max(t)) / 2).alias("__mid"), ((F.max(t) - F.min(t)) / 2).alias("__half"), F.countDistinct(t).alias("__times"))
    if order == 0:
        return targets.join(span.select(*on, F.col("__mean").alias("model")), list(on))
    scaled = known.join(span.where(F.col("__times") > order), list(on)).withColumn("__u", (t - F.col("__mid")) / F.col("__half"))
    fit = polyfit(scaled, on, "__u", value, order).select(*on, F.col("coeffs").alias("__c"))
    late = F.col(end) + F.when(F.col(end) < F.col(start), DAY).otherwise(0.0)
    u = lambda x: F.try_divide(x - F.col("__mid"), F.col("__half"))
    out = targets.join(span.join(fit, list(on), "left"), list(on)).withColumns({"__a": u(F.col(start)), "__b": u(late)})
    a, b = F.col("__a"), F.col("__b")
    # (b^(p+1) - a^(p+1)) / (b - a) as a sum, which also holds where the interval is a moment
    powers = lambda p: sum((F.pow(a, F.lit(i)) * F.pow(b, F.lit(p - i)) for i in range(p + 1)), F.lit(0.0)) / (p + 1)
    mean = sum((F.get("__c", F.lit(p)) * powers(p) for p in range(order + 1)), F.lit(0.0))
    return out.withColumn("model", F.coalesce(mean, F.col("__mean"))).drop("__mean", "__mid", "__half", "__times", "__c", "__a", "__b")


def join_fibermap(spectra: DataFrame, fibermap: DataFrame, columns: Sequence[str], on: str = "fiberid") -> DataFrame:
    return spectra.join(small(fibermap.select(on, *columns)), on, "left")


def lookup_night(expnums: DataFrame, frames: DataFrame, number: str = "expnum", night: str = "mjd") -> DataFrame:
    """The night of each exposure (its first, if frames disagree)."""
    return expnums.join(frames.groupBy(number).agg(F.min(night).alias(night)), number, "left")
