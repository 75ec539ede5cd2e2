"""Exact top-k search by aggregation without random access: sorted lists are read from their ends until nothing outside can qualify."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .vectors import NO_ID, candidate_blocks, finite, keep_best, kth, longs, meet, quantise, query_blocks, smallest

#: Parts in which lists are read; bounds are renewed after each.
ROUNDS = 8
#: A query is done when at most 1 / FEW of a segment's rows are open.
FEW = 8
LISTS = "ids binary, dim bigint, by_rise binary, sorted binary, sorted_bytes bigint, vectors binary, vectors_bytes bigint"
FOUND = "block bigint, slot bigint, query_id bigint, id bigint, score bigint"
LEAST = np.iinfo(np.int64).min


def _pack(ids, labels, vectors) -> dict:
    """A segment: for each dimension the rows' numbers by rising component, the components in that order, and the vectors."""
    order = np.argsort(vectors, axis=0, kind="stable").T
    lists = smallest(np.take_along_axis(vectors.T, order, axis=1))
    rows = smallest(vectors)
    return {"ids": ids.tobytes(), "dim": vectors.shape[1], "by_rise": order.astype(np.uint16).tobytes(), "sorted": lists.tobytes(), "sorted_bytes": lists.itemsize, "vectors": rows.tobytes(), "vectors_bytes": rows.itemsize}


def no_random_access(order: np.ndarray, lists: np.ndarray, queries: np.ndarray, allowed: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """(rows, queries): whether a row may be among the k best of a query; and the depth to which the lists were read.

    A query reads the list of a dimension from its top where its own component is positive and from its bottom where it is
    negative, so contributions fall. All lists are read to one depth, part by part. Of what was read the contribution is
    known; of what was not, the last one read is the upper bound and the list's other end the lower one. The kth best lower
    bound, or the floor if that is higher, is what a row must reach. Bounds are made once a row that no list has shown yet
    would not qualify. A query whose open rows are few is done: their scores are made from their vectors.
    """
    d, n = order.shape
    # sums of so many products are exact in doubles up to 2 ** 53
    kind = np.float64 if float(np.abs(queries).astype(np.float64).sum(axis=1).max(initial=0)) * max(1.0, float(np.abs(lists).max(initial=0))) < 2**52 else np.int64
    ends = np.concatenate([np.maximum(queries.T, 0), np.minimum(queries.T, 0)]).astype(kind)  # what is read from the top, from the bottom
    lists = lists.astype(kind)
    known, unread = np.zeros((n, 2 * d), kind), np.ones((n, 2 * d), kind)
    open_rows = allowed.copy()
    live = np.arange(len(queries))
    few, step, depth = max(4 * k, n // FEW), max(16, -(-n // ROUNDS)), 0
    while len(live) and depth < n:
        end = min(n, depth + step)
        for j in range(d):
            for column, part in ((j, slice(n - end, n - depth)), (d + j, slice(depth, end))):
                known[order[j, part], column], unread[order[j, part], column] = lists[j, part], 0
        depth = end
        next_ = np.concatenate([lists[:, n - depth], lists[:, depth - 1]])
        new = floor[live] == LEAST
        if n > k and new.any():
            sure = (known + unread * np.concatenate([lists[:, 0], lists[:, -1]])) @ ends[:, live[new]]
            sure = np.where(allowed[:, live[new]], sure, -np.inf if kind is np.float64 else LEAST)
            low = np.partition(sure, n - k, axis=0)[n - k].clip(LEAST // 2)
        at = np.array(floor[live], dtype=kind)
        if n > k and new.any():
            at[new] = low
        ripe = np.flatnonzero(((next_ @ ends[:, live]) < at) | (depth == n))
        if not len(ripe):
            continue
        most = (known + unread * next_) @ ends[:, live[ripe]]
        open_rows[:, live[ripe]] = allowed[:, live[ripe]] & (most >= at[ripe])
        done = open_rows[:, live[ripe]].sum(axis=0) <= few
        live = np.delete(live, ripe[done])
    return open_rows, depth


def _search(k: int):
    import pyarrow as pa

    def task(batches):
        held: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = longs(row["ids"]), longs(row["q_ids"])
                d, n = row["dim"], len(ids)
                queries = longs(row["q_vectors"]).reshape(len(q_ids), row["q_dim"])[:, :d]
                order = np.frombuffer(row["by_rise"], np.uint16).reshape(d, n)[: queries.shape[1]]
                lists = np.frombuffer(row["sorted"], f"i{row['sorted_bytes']}").reshape(d, n)[: queries.shape[1]].astype(np.int64)
                vectors = np.frombuffer(row["vectors"], f"i{row['vectors_bytes']}").reshape(n, d)[:, : queries.shape[1]]
                q, s, i = held.get(row["block"], (q_ids, *[np.zeros(0, np.int64)] * 3))[1:]
                rows = ids[:, None] != q_ids
                size = np.abs(queries).astype(np.float64).sum(axis=1).max(initial=0) * np.abs(lists.astype(np.float64)).max(initial=0)
                if size < 2**61 and queries.shape[1]:  # else bounds could pass 64 bits, and all rows are scored
                    rows, _ = no_random_access(order, lists, queries, rows, kth(q, s, len(q_ids), k), k)
                r, c = np.nonzero(rows)
                for a in range(0, len(r), 65_536):
                    r1, c1 = r[a : a + 65_536], c[a : a + 65_536]
                    score = np.einsum("ij,ij->i", vectors[r1].astype(np.int64), queries[c1])
                    q, s, i = keep_best(np.r_[q, c1], np.r_[s, score], np.r_[i, ids[r1]], k)
                held[row["block"]] = (q_ids, q, s, i)
        for block, (q_ids, q, s, i) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), block), pa.int64()), pa.array(q, pa.int64()), *[pa.array(x, pa.int64(), mask=x == NO_ID) for x in (q_ids[q], i)], pa.array(s, pa.int64())], ["block", "slot", "query_id", "id", "score"])

    return task


def search_top(rows: DataFrame, is_query: Column, vector: Column, vec_id: str = "vec_id", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of highest integer inner product, equal scores by smaller id, a null id last.

    Rows are stored in segments of up to 4,096, each with a list for every dimension; tasks search their segments one after
    another, so that scores found before are the floor of those to come. vector is an array of integers (vectors.quantise).

    Rows with a null vector or component take no part. Rows that share the query's id count as its own; repeated rows of
    another id are listed each for itself; queries that repeat id and vector are one, others of one id are queries of their
    own. A null id may be found, and is a query only if is_query says so. Components that a shorter vector lacks count as
    0. Scores beyond 64 bits wrap. Other columns are ignored; an empty table gives an empty result.
    """
    parts = rows.select(F.col(vec_id).cast("long").alias("id"), F.lit(0).cast("long").alias("label"), vector.cast("array<bigint>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    parts = parts.where(F.coalesce(F.forall("v", lambda x: x.isNotNull()), F.lit(False)))
    segments = candidate_blocks(parts.select("id", "label", "v"), _pack, LISTS, "lists")
    queries, passes = query_blocks(parts.where("query").select("id", "label", "v"), "queries")
    found = meet(segments, queries, passes, _search(k), FOUND, "found")
    best = Window.partitionBy("block", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def nearest(rows: DataFrame) -> DataFrame:
    """The five best rows of every query (ids divisible by 50)."""
    return search_top(rows.where(finite(F.col("embedding"))), F.col("vec_id") % 50 == 0, quantise(F.col("embedding")))


ORACLE = """
WITH r AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM r q, r c WHERE q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, row_number() OVER w::INT AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
