"""Spectra against models and references as blocks of arrays: template choice, two-level alignment of fibre profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import bound_batches, stored
from .joins import small

#: Spectra of a block of stars and of models, and numbers that a task compares at once.
STARS, MODELS, CELLS = 64, 64, 1 << 20
#: Bytes of models that are broadcast at once, up to four times as many where their names fall unevenly.
PASS_BYTES = 16 << 20


def _dense(pdf: pd.DataFrame, columns: Sequence[str], size: int) -> list[np.ndarray]:
    """(rows, size) arrays, NaN where a row has no sample; places are in the column i."""
    out = [np.full((len(pdf), size), np.nan) for _ in columns]
    for r, at in enumerate(pdf["i"]):
        for c, a in zip(columns, out):
            a[r, np.asarray(at, np.int64)] = np.asarray(pdf[c].iloc[r], float)
    return out


def _listed(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """One row for each name: its places and columns as arrays in order of places."""
    one = df.groupBy(name).agg(F.array_sort(F.collect_list(F.struct("i", *columns))).alias("__s"))
    return one.select(name, *[F.transform("__s", lambda s: s[c]).alias(c) for c in ("i", *columns)])  # noqa: B023


def _blocks(rows: DataFrame, name: str, columns: Sequence[str], size: int, most: int, prefix: str) -> DataFrame:
    """Rows of arrays as blocks: names as a list, each column as the bytes of a (names, size) array."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.sort_values(name)
            for i in range(0, len(pdf), most):
                part = pdf.iloc[i : i + most]
                arrays = _dense(part, columns, size)
                yield pd.DataFrame({f"{prefix}names": [part[name].tolist()], **{f"{prefix}{c}": [a.tobytes()] for c, a in zip(columns, arrays)}})

    kind = rows.schema[name].dataType.simpleString()
    return rows.mapInPandas(run, f"{prefix}names array<{kind}>, " + ", ".join(f"{prefix}{c} binary" for c in columns))


def _passes(listed: DataFrame, name: str, row_bytes: int) -> list[DataFrame]:
    """Rows by the hash of their name in parts of at most 4 * PASS_BYTES, which is counted."""
    n = listed.count()
    parts = max(1, -(-n * row_bytes // PASS_BYTES))
    part = lambda: F.pmod(F.xxhash64(name), F.lit(parts))
    while parts < n and listed.groupBy(part()).count().agg(F.max("count")).first()[0] * row_bytes > 4 * PASS_BYTES:
        parts *= 2
    return [listed.where(part() == p) for p in range(parts)]


def choose_models(spec: DataFrame, models: DataFrame, k: Sequence[str], star: str, model: str, model_error: float, most: float | None, value: str, error: str) -> DataFrame:
    """See spectra.template_match. Models are broadcast in passes of a counted size; more models take more passes over the stars, which are not shuffled for it."""
    bound_batches(spec.sparkSession)  # a block of stars has tens of KB or more, and a batch would have thousands of them
    places = stored(models.select(*k).where(" and ".join(f"`{c}` is not null" for c in k)).distinct().withColumn("i", F.row_number().over(Window.orderBy(*k)) - 1), "places")  # the places of one grid
    size = places.count()
    if not size:
        return spec.sparkSession.createDataFrame([], f"`{star}` {spec.schema[star].dataType.simpleString()}, `{model}` {models.schema[model].dataType.simpleString()}, chi2 double")
    own = spec.select(star, *k, F.col(value).cast("double").alias("v"), F.col(error).cast("double").alias("e")).join(small(places), list(k))
    known = models.select(model, *k, F.col(value).cast("double").alias("m")).join(small(places), list(k))
    stars = stored(_listed(own.where("v is not null and e is not null"), star, ["v", "e"]), "stars")
    listed = stored(_listed(known.where("m is not null"), model, ["m"]), "models")
    tables = [stored(_blocks(part, model, ["m"], size, MODELS, "m_"), "model-blocks") for part in _passes(listed, model, 8 * size)]
    first = _best(stars, tables, star, model, size, model_error, spec, models)
    if most is None:
        return first
    worst = stars.join(first.select(star, F.col(model).alias("__best")), star).join(listed.select(F.col(model).alias("__best"), F.col("i").alias("mi"), "m"), "__best")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v, e = _dense(pdf, ["v", "e"], size)
            m = _dense(pdf[["mi", "m"]].rename(columns={"mi": "i"}), ["m"], size)[0]
            keep = [~(_chi(v[r], e[r], m[r], model_error) > most) for r in range(len(pdf))]
            at = [np.asarray(a, np.int64) for a in pdf["i"]]
            yield pd.DataFrame({star: pdf[star], "i": [a[g[a]].tolist() for a, g in zip(at, keep)], "v": [x[a[g[a]]].tolist() for x, a, g in zip(v, at, keep)], "e": [x[a[g[a]]].tolist() for x, a, g in zip(e, at, keep)]})

    kept = worst.mapInPandas(cut, f"`{star}` {spec.schema[star].dataType.simpleString()}, i array<int>, v array<double>, e array<double>")
    return _best(stored(kept, "stars"), tables, star, model, size, model_error, spec, models)


def _chi(v: np.ndarray, e: np.ndarray, m: np.ndarray, model_error: float) -> np.ndarray:
    """chi^2 of each sample, NaN where one lacks it or has no error."""
    noise = e * e + m * m * model_error * model_error
    return (v - m) ** 2 / np.where(noise == 0, np.nan, noise)


def _best(stars: DataFrame, tables: Sequence[DataFrame], star: str, model: str, size: int, model_error: float, spec: DataFrame, models: DataFrame) -> DataFrame:
    """(star, model, chi2) of the least mean chi^2."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for row in pdf.itertuples(index=False):
                v, e = (np.frombuffer(x).reshape(-1, size) for x in (row.s_v, row.s_e))
                m = np.frombuffer(row.m_m).reshape(-1, size)
                step = max(1, CELLS // (size * len(m)))
                for i in range(0, len(v), step):
                    chi = _chi(v[i : i + step, None], e[i : i + step, None], m[None], model_error)
                    count = (~np.isnan(chi)).sum(axis=2)
                    mean = np.where(count > 0, np.nansum(chi, axis=2) / np.maximum(count, 1), np.inf)
                    best = mean.argmin(axis=1)  # the first of several
                    found += [(row.s_names[i + r], row.m_names[b], mean[r, b]) for r, b in enumerate(best.tolist()) if mean[r, b] < np.inf]
            yield pd.DataFrame(found, columns=["star", "model", "chi2"])

    kinds = f"star {spec.schema[star].dataType.simpleString()}, model {models.schema[model].dataType.simpleString()}, chi2 double"
    blocks = _blocks(stars, star, ["v", "e"], size, STARS, "s_")
    found = reduce(DataFrame.unionByName, [blocks.crossJoin(F.broadcast(t)).mapInPandas(run, kinds) for t in tables])  # blocks with blocks
    best = found.groupBy("star").agg(F.min(F.struct("chi2", "model")).alias("__b"))
    return best.select(F.col("star").alias(star), F.col("__b.model").alias(model), F.col("__b.chi2").alias("chi2"))


# --- fibre profiles along the slit


def running_medians(a: np.ndarray, box: int) -> np.ndarray:
    """Medians of boxes about each place, with zeros beyond the ends."""
    return np.median(np.lib.stride_tricks.sliding_window_view(np.pad(a, box // 2), box), axis=1)


def level_peaks(a: np.ndarray, distance: int) -> np.ndarray:
    """A profile whose peaks are all about 1: divided by the line through its local maxima (the greatest within a distance), below 0 as 0."""
    a = np.maximum(a, 0.0)
    n = len(a)
    top = np.lib.stride_tricks.sliding_window_view(np.pad(a, distance), 2 * distance + 1).max(axis=1)
    at = np.flatnonzero((a == top) & (a > 0.1 * a.max(initial=0)))
    if not len(at):
        return a
    return a / np.interp(np.arange(n), at, a[at])


def correlations(obs: np.ndarray, ref: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Normalised sums of obs times ref moved by each shift."""
    n, norm = len(obs), np.linalg.norm(obs) * np.linalg.norm(ref)
    sums = [obs[max(s, 0) : n + min(s, 0)] @ ref[max(-s, 0) : n - max(s, 0)] if abs(s) < n else 0.0 for s in shifts.tolist()]
    return np.array(sums) / (norm or 1.0)


def choose_peak(c: np.ndarray) -> int:
    """The local maximum whose value and greater neighbour have the greatest sum; the greatest value where none lies inside."""
    inner = np.flatnonzero((c[1:-1] > c[:-2]) & (c[1:-1] >= c[2:])) + 1
    if not len(inner):
        return int(c.argmax())
    return int(inner[(c[inner] + np.maximum(c[inner - 1], c[inner + 1])).argmax()])


def align(obs: np.ndarray, ref: np.ndarray, most: int, fine: int, clip: float, box: int, distance: int) -> tuple[int, float, float]:
    """(coarse, shift, correlation) of a profile of fibre blocks against a reference on the same places."""

    def blocks(a: np.ndarray) -> np.ndarray:
        middle = np.median(a[a > 0]) if (a > 0).any() else 0.0
        flat = running_medians(np.clip(a, 0, clip * middle), box)
        return flat / (np.median(flat) or 1.0)

    wide = np.arange(-most, most + 1)
    c = correlations(blocks(obs), blocks(ref), wide)
    best = np.flatnonzero(c >= c.max() - 1e-12)
    coarse = int(wide[best[np.abs(wide[best]).argmin()]])
    near = coarse + np.arange(-fine - 1, fine + 2)
    c = correlations(level_peaks(obs, distance), level_peaks(ref, distance), near)
    p = 1 + choose_peak(c[1:-1])
    low, mid, high = c[p - 1 : p + 2]
    bend = low - 2 * mid + high
    part = 0.5 * (low - high) / bend if bend < 0 else 0.0  # the vertex of the parabola through three points
    return coarse, float(near[p] + np.clip(part, -1, 1)), float(mid)


def align_profiles(obs: DataFrame, ref: DataFrame, keys: Sequence[str], y: str = "y", value: str = "flux", most: int = 30, fine: int = 5, clip: float = 0.7, box: int = 21, distance: int = 2) -> DataFrame:
    """(keys, coarse, shift, score): how far each profile along the slit has moved against its reference, to a part of a pixel.

    First the blocks of fibres are aligned: profiles are clipped at a share of their median and smoothed by running medians,
    which leaves blocks and the gaps between them, and moved by up to `most` places. Then the fibres: peaks are brought to
    one height, and of the correlation's peaks within `fine` places of the first shift the one is chosen whose value and
    greater neighbour are greatest; a parabola gives the part of a place. A group is one row of two arrays.
    """
    bound_batches(obs.sparkSession)
    listed = lambda df, name: df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(y).cast("long").alias("k"), F.col(value).cast("double").alias("v")))).alias(name))
    both = listed(obs.where(F.col(value).isNotNull()), "__o").join(listed(ref.where(F.col(value).isNotNull()), "__r"), list(keys))
    flat = both.select(*keys, *[F.transform(c, lambda x: x[f]).alias(f"{c}{f}") for c in ("__o", "__r") for f in ("k", "v")])  # noqa: B023

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for ok, ov, rk, rv in zip(pdf["__ok"], pdf["__ov"], pdf["__rk"], pdf["__rv"]):
                ok, rk = np.asarray(ok), np.asarray(rk)
                low = min(ok[0], rk[0])
                a, b = (np.zeros(int(max(ok[-1], rk[-1]) - low) + 1) for _ in range(2))
                a[ok - low], b[rk - low] = ov, rv
                found.append(align(a, b, most, fine, clip, box, distance))
            out = pdf[list(keys)].copy()
            out["coarse"], out["shift"], out["score"] = ([f[n] for f in found] for n in range(3))
            yield out

    kinds = ", ".join(f"`{c}` {flat.schema[c].dataType.simpleString()}" for c in keys)
    return flat.mapInPandas(run, f"{kinds}, coarse int, shift double, score double")
