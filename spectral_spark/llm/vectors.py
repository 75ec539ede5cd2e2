"""Integer vectors in blocks: a stated set of query rows against all rows, with what the searches over them share.

Rows become blocks of equal length, written once; query rows become blocks of passes that are broadcast one after another,
each of a bounded size. A task meets every query block of a pass with each of its candidate blocks and keeps the best so
far, so that what leaves it is a few rows for each query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, stash

#: Rows of a block and its bytes as 64-bit integers; blocks of very long vectors have fewer rows.
BLOCK_ROWS, QUERY_ROWS, BLOCK_BYTES = 4096, 128, 8 << 20
#: Bytes of queries that are broadcast at once; further queries take further passes over the candidates.
PASS_BYTES = 16 << 20
#: Stands for a null id, which comes after all others.
NO_ID = np.iinfo(np.int64).max


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as a double; beyond the range of a long its ends."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def smallest(a: np.ndarray) -> np.ndarray:
    """The same integers in the shortest of the signed types that holds them."""
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    return a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def rows_of(batch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of an Arrow batch (id, label, vector), in blocks of at most `most` rows of one length, each by id."""
    ids, labels = (batch.column(k).fill_null(x).to_numpy(zero_copy_only=False).astype(np.int64) for k, x in ((0, NO_ID), (1, 0)))
    lists = batch.column(2)
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(at)
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        step = max(1, min(most, BLOCK_BYTES // (8 * max(1, d))))
        for i in range(0, len(rows), step):
            r = rows[i : i + step]
            yield ids[r], labels[r], flat[at[r][:, None] + np.arange(d)]


def longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def candidate_blocks(rows: DataFrame, pack: Callable, schema: str, name: str) -> DataFrame:
    """Rows (id, label, vector) as stored blocks: pack(ids, labels, vectors) gives the columns of one row, bytes or integers."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for block in rows_of(batch, BLOCK_ROWS):
                yield pa.RecordBatch.from_pylist([pack(*block)])

    bound_batches(rows.sparkSession)
    return stash(rows.mapInArrow(run, schema), name, "zstd")


QUERY_BLOCK = "q_ids binary, q_labels binary, q_vectors binary, q_dim bigint"


def query_blocks(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Distinct rows (id, label, vector) as stored blocks (QUERY_BLOCK, pass, block), and the number of passes.

    Rows are dealt out evenly, so a pass holds PASS_BYTES and a row of each input partition more at most.
    """
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for ids, labels, vectors in rows_of(batch, QUERY_ROWS):
                yield pa.RecordBatch.from_pylist([{"q_ids": ids.tobytes(), "q_labels": labels.tobytes(), "q_vectors": vectors.tobytes(), "q_dim": vectors.shape[1]}])

    bound_batches(rows.sparkSession)
    distinct = rows.distinct()
    n, longest = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(rows.columns[2])), F.lit(0))).first()
    passes = max(1, -(-n * 8 * (longest + 2) // PASS_BYTES))
    made = distinct.repartition(passes).mapInArrow(run, QUERY_BLOCK)
    return stash(made.withColumn("pass", F.spark_partition_id()).withColumn("block", F.monotonically_increasing_id()), name), passes


def meet(candidates: DataFrame, queries: DataFrame, passes: int, task: Callable, schema: str, name: str) -> DataFrame:
    """What task makes of candidate blocks beside query blocks: a map over the candidates for each pass, without a shuffle.

    With several passes each result is written, so that a lost executor costs a part of one pass.
    """
    results = []
    for p in range(passes):
        now = candidates.crossJoin(F.broadcast(queries.where(F.col("pass") == p))).mapInArrow(task, schema)
        results.append(stash(now, name) if passes > 1 else now)
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def keep_best(q: np.ndarray, s: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, score, id) the k best of each query: higher scores first, equal ones by smaller id."""
    order = np.lexsort((i, ~s, q))
    q, s, i = q[order], s[order], i[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], s[keep], i[keep]


def best_of(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, score, id) of the k best allowed entries of each column; columns that reach no floor have none."""
    low = np.iinfo(np.int64).min
    s = np.where(allowed, scores, low)
    cols = np.flatnonzero(s.max(axis=0) >= (low if floor is None else floor)) if len(s) else np.zeros(0, np.int64)
    s, allowed = s[:, cols], allowed[:, cols]
    at = np.partition(s, len(s) - k, axis=0)[len(s) - k] if len(s) > k else np.full(len(cols), low)
    r, c = np.nonzero(allowed & (s >= at))
    return keep_best(cols[c], s[r, c], ids[r], k)


def kth(q: np.ndarray, s: np.ndarray, n: int, k: int) -> np.ndarray:
    """For each of n queries the score of its kth best; the least number where it has fewer than k. q in order, scores falling."""
    out = np.full(n, np.iinfo(np.int64).min)
    last = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == k - 1)
    out[q[last]] = s[last]
    return out
