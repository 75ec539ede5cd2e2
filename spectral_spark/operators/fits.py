"""Least squares by group: sums of products in Spark, then one small batched solve over the rows of sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import eval_poly


def solve_moments(pdf: pd.DataFrame, degree: int) -> np.ndarray:
    """Coefficients, constant first, of rows of sums s0..s2d and t0..td; NaN where they do not determine them."""
    n = degree + 1
    s = pdf[[f"s{k}" for k in range(2 * degree + 1)]].to_numpy(float)
    t = pdf[[f"t{k}" for k in range(n)]].to_numpy(float)
    a = np.stack([s[:, i : i + n] for i in range(n)], axis=1)
    out = np.full((len(pdf), n), np.nan)
    ok = (s[:, 0] >= n) & (np.linalg.matrix_rank(a) == n) if len(pdf) else np.zeros(0, bool)
    if ok.any():
        out[ok] = np.linalg.solve(a[ok], t[ok][:, :, None])[:, :, 0]
    return out


def polyfit(df: DataFrame, group: Sequence[str], x: str, y: str, degree: int, least: int | None = None, centre: float = 0.0, width: float = 1.0) -> DataFrame:
    """For each group the coefficients (constant first) of a polynomial in (x - centre) / width, and the number of samples; null with too few.

    The sums of powers are one aggregation; a row of sums for each group is all that Python sees, many rows at a time.
    """
    u = (F.col(x) - centre) / width
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    sums = d.groupBy(*group).agg(*[F.sum(F.pow(u, F.lit(k))).alias(f"s{k}") for k in range(2 * degree + 1)], *[F.sum(F.pow(u, F.lit(k)) * F.col(y)).alias(f"t{k}") for k in range(degree + 1)])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[list(group)].copy()
            c = solve_moments(pdf, degree)
            out["coeffs"] = [None if np.isnan(r).any() else r.tolist() for r in c]
            out["n"] = pdf["s0"].round().astype("int64")
            yield out

    kinds = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group)
    out = sums.mapInPandas(solve, f"{kinds}, coeffs array<double>, n long")
    return out if least is None else out.withColumn("coeffs", F.when(F.col("n") >= least, F.col("coeffs")))


def polyfit_clipped(df: DataFrame, group: Sequence[str], x: str, y: str, degree: int = 3, nsigma: float = 3.0, rounds: int = 3, **how) -> DataFrame:
    """polyfit, repeated without the samples whose residual is beyond nsigma standard deviations of the group's."""
    kept = df
    fit = polyfit(kept, group, x, y, degree, **how)
    u = (F.col(x) - how.get("centre", 0.0)) / how.get("width", 1.0)
    for _ in range(rounds):
        r = kept.join(fit.select(*group, "coeffs"), list(group)).withColumn("__r", F.col(y) - eval_poly(F.col("coeffs"), u))
        s = r.groupBy(*group).agg(F.stddev_pop("__r").alias("__s"))
        kept = r.join(s, list(group)).where(F.abs("__r") <= nsigma * F.col("__s")).drop("coeffs", "__r", "__s")
        fit = polyfit(kept, group, x, y, degree, **how)
    return fit


#: Powers of x and y in a surface: a plane.
PLANE = ((0, 0), (0, 1), (1, 0))


def fit_gradient(df: DataFrame, exposure: Sequence[str], x: str = "x", y: str = "y", value: str = "flux", group: str | None = None, terms: Sequence[tuple[int, int]] = PLANE, rounds: int = 200, tolerance: float = 1e-10) -> DataFrame:
    """For each exposure a polynomial surface (coeffs of x^i y^j, as terms list them) times a factor for each group of fibres (a map), through the fluxes.

    Factors have the mean 1, the surface the level of the fluxes over it; null where the fibres do not determine them. The
    sums of products of each exposure and group are one aggregation: surface and factors are then solved in turn, from
    those few numbers alone, until no factor moves by more than the tolerance.
    """
    n = len(terms)
    u = [F.pow(F.col(x), F.lit(i)) * F.pow(F.col(y), F.lit(j)) for i, j in terms]
    g = (F.col(group).cast("string") if group else F.lit("")).alias("__g")
    d = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    sums = d.groupBy(*exposure, g).agg(F.array(*[F.sum(u[i] * u[j]) for i in range(n) for j in range(n)]).alias("__s"), F.array(*[F.sum(u[i] * F.col(value)) for i in range(n)]).alias("__t"))
    rows = sums.where("__g is not null").groupBy(*exposure).agg(F.array_sort(F.collect_list(F.struct("__g", "__s", "__t"))).alias("__m"))
    rows = rows.select(*exposure, *[F.transform("__m", lambda m: m[c]).alias(c) for c in ("__g", "__s", "__t")])  # noqa: B023

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[list(exposure)].copy()
            found = [alternate(np.array([list(a) for a in s], float).reshape(-1, n, n), np.array([list(a) for a in t], float), rounds, tolerance) for s, t in zip(pdf["__s"], pdf["__t"])]
            out["coeffs"] = [None if f is None else f[0].tolist() for f in found]
            out["factors"] = [None if f is None else dict(zip(names, f[1].tolist())) for names, f in zip(pdf["__g"], found)]
            yield out

    kinds = ", ".join(f"`{e}` {df.schema[e].dataType.simpleString()}" for e in exposure)
    return rows.mapInPandas(solve, f"{kinds}, coeffs array<double>, factors map<string,double>")


def alternate(s: np.ndarray, t: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray] | None:
    """(surface, factors) from the groups' matrices s and vectors t; None where they are not determined."""
    factors, n = np.ones(len(s)), s.shape[1]
    for _ in range(rounds):
        a = (factors[:, None, None] ** 2 * s).sum(0)
        if not np.isfinite(a).all() or np.linalg.matrix_rank(a) < n:
            return None
        c = np.linalg.solve(a, (factors[:, None] * t).sum(0))
        power = np.einsum("i,gij,j->g", c, s, c)
        new = np.where(power > 0, (t @ c) / np.where(power > 0, power, 1.0), 1.0)
        if not new.mean():
            return None
        new = new / new.mean()
        moved = np.abs(new - factors).max()
        factors = new
        if moved <= tolerance:
            break
    return np.linalg.solve((factors[:, None, None] ** 2 * s).sum(0), (factors[:, None] * t).sum(0)), factors


def surface(coeffs: Column, x: Column, y: Column, terms: Sequence[tuple[int, int]] = PLANE) -> Column:
    parts = [F.get(coeffs, F.lit(k)) * F.pow(x, F.lit(i)) * F.pow(y, F.lit(j)) for k, (i, j) in enumerate(terms)]
    return reduce(lambda a, b: a + b, parts)


def remove_gradient(df: DataFrame, fit: DataFrame, exposure: Sequence[str], x: str = "x", y: str = "y", value: str = "flux", group: str | None = None, terms: Sequence[tuple[int, int]] = PLANE) -> DataFrame:
    """Divide by surface and factor, both over the mean of their product over the exposure's rows; without a fit values stay."""
    out = df.join(fit, list(exposure), "left")
    factor = F.coalesce(F.try_element_at(F.col("factors"), F.col(group).cast("string")), F.lit(1.0)) if group else F.lit(1.0)
    out = out.withColumn("__model", surface(F.col("coeffs"), F.col(x), F.col(y), terms) * factor)
    mean = out.groupBy(*exposure).agg(F.avg("__model").alias("__mean"))
    out = out.join(mean, list(exposure), "left")
    return out.withColumn(value, F.coalesce(F.try_divide(F.col(value) * F.col("__mean"), F.col("__model")), F.col(value))).drop("coeffs", "factors", "__model", "__mean")


def apply_fibers(df: DataFrame, keys: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A caller's function on each fibre's samples. A fibre's samples must fit a task."""
    return df.groupBy(*keys).applyInPandas(function, schema)
