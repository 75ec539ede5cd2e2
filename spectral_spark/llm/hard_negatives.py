"""Hard negatives by exact scores from lookup tables, after the method of the four Russians."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash
from .vectors import NO_ID, best_of, candidate_blocks, finite, keep_best, kth, longs, meet, quantise, query_blocks

#: Rows that are scored at once, and bytes of the tables that are held at once.
SLICE, TABLE_BYTES = 1024, 32 << 20
PACKED = "ids binary, labels binary, planes binary, n_planes bigint, n_groups bigint"


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """(planes, groups, rows): bit j of eight components in a byte; the last plane is that of the sign."""
    n, d = vectors.shape
    bits = int(np.bitwise_or.reduce(np.where(vectors < 0, ~vectors, vectors), axis=None)).bit_length() + 1 if vectors.size else 1
    out = np.empty((bits, -(-d // 8), n), np.uint8)
    for j in range(bits):
        out[j] = np.packbits((vectors >> j & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each eight dimensions the sums of all subsets of an anchor's components."""
    n, d = anchors.shape
    kind = np.int32 if float(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)) < 2**31 else np.int64
    padded = np.zeros((-(-d // 8) * 8, n), kind)
    padded[:d] = anchors.T
    tables = np.zeros((len(padded) // 8, 256, n), kind)
    for i in range(8):
        tables[:, 1 << i : 2 << i] = tables[:, : 1 << i] + padded[i::8, None, :]
    return tables


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """(rows, anchors): inner products, by adding up what each plane's bytes find in the tables, shifted by the plane.

    Arithmetic is that of 64-bit integers, so scores are exact as far as they fit.
    """
    bits, groups, n = planes.shape
    groups = min(groups, -(-anchors.shape[1] // 8))
    out = np.zeros((n, len(anchors)), np.int64)
    step = max(1, TABLE_BYTES // (2048 * max(1, groups)))
    for a in range(0, len(anchors), step):
        tables = subset_sums(anchors[a : a + step])
        for r in range(0, n, SLICE):
            total = out[r : r + SLICE, a : a + step]
            found = np.empty(total.shape, tables.dtype)
            for j in range(bits):
                plane = np.zeros(total.shape, tables.dtype)
                for g in range(groups):
                    plane += np.take(tables[g], planes[j, g, r : r + SLICE], axis=0, out=found, mode="clip")
                shifted = plane.astype(np.int64) << j
                total += -shifted if j == bits - 1 else shifted
    return out


def _pack(ids, labels, vectors) -> dict:
    planes = bit_planes(vectors)
    return {"ids": ids.tobytes(), "labels": labels.tobytes(), "planes": planes.tobytes(), "n_planes": planes.shape[0], "n_groups": planes.shape[1]}


def _pairs(batch):
    """Of each row of candidate and anchor block: ids, labels, planes, anchors' ids, labels and vectors, the block's number, the row."""
    for row in batch.to_pylist():
        ids, labels, q_ids, q_labels, vectors = (longs(row[c]) for c in ("ids", "labels", "q_ids", "q_labels", "q_vectors"))
        planes = np.frombuffer(row["planes"], np.uint8).reshape(row["n_planes"], row["n_groups"], len(ids))
        yield ids, labels, planes, q_ids, q_labels, vectors.reshape(len(q_ids), row["q_dim"]), row["block"], row


def _table(block, slot, q_ids, place, i, s):
    import pyarrow as pa

    long = pa.int64()
    ids = lambda a: pa.array(a, long, mask=a == NO_ID)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), block), long), pa.array(slot, long), ids(q_ids[slot]), pa.array(place, long), ids(i), pa.array(s, long)], ["block", "slot", "anchor_id", "place", "id", "score"])


FOUND = "block bigint, slot bigint, anchor_id bigint, place bigint, id bigint, score bigint"


def _positives(k: int):
    def task(batches):
        held: dict = {}
        for batch in batches:
            for ids, labels, planes, q_ids, q_labels, anchors, block, _ in _pairs(batch):
                q, s, i = held.get(block, (q_ids, *[np.zeros(0, np.int64)] * 3))[1:]
                for label in np.intersect1d(labels, q_labels).tolist():
                    rows, cols = np.flatnonzero(labels == label), np.flatnonzero(q_labels == label)
                    found = scores(np.ascontiguousarray(planes[:, :, rows]), anchors[cols])
                    c, s1, i1 = best_of(found, ids[rows][:, None] != q_ids[cols], ids[rows], k, kth(q, s, len(q_ids), k)[cols])
                    q, s, i = keep_best(np.r_[q, cols[c]], np.r_[s, s1], np.r_[i, i1], k)
                held[block] = (q_ids, q, s, i)
        for block, (q_ids, q, s, i) in held.items():
            yield _table(block, q, q_ids, np.zeros(len(q), np.int64), i, s)

    return task


def _negatives(k: int, share: tuple[int, int]):
    def task(batches):
        held: dict = {}
        for batch in batches:
            for ids, labels, planes, q_ids, q_labels, anchors, block, row in _pairs(batch):
                near = row["positives"] or []
                most = max((p["place"] for p in near), default=0)
                high, low = (np.full((len(q_ids), most), x) for x in (np.iinfo(np.int64).min, NO_ID))
                for p in near:
                    high[p["slot"], p["place"] - 1], low[p["slot"], p["place"] - 1] = p["score"], -(-share[0] * p["score"] // share[1])
                found = scores(planes, anchors) if most else None
                other = labels[:, None] != q_labels
                q, s, i = held.get(block, (q_ids, *[np.zeros(0, np.int64)] * 3, most))[1:4]
                for j in range(most):
                    fits = other & (found <= high[:, j]) & (found >= low[:, j])
                    c, s1, i1 = best_of(found, fits, ids, k, kth(q, s, len(q_ids) * most, k)[j::most])
                    q, s, i = keep_best(np.r_[q, c * most + j], np.r_[s, s1], np.r_[i, i1], k)
                held[block] = (q_ids, q, s, i, most)
        for block, (q_ids, q, s, i, most) in held.items():
            if most:
                yield _table(block, q // most, q_ids, q % most + 1, i, s)

    return task


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("block", "slot", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, vector: Column, label: Column, vec_id: str = "vec_id", positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    An anchor's positives are the best other rows of its label; for each of them come the best rows of other labels that
    score at most as high, and at least share[0] / share[1] as high. Scores are integer inner products; higher ones come
    first, equal ones by smaller id, a null id last. vector is an array of integers (see vectors.quantise).

    Rows with a null label or vector, or a null component, take no part. A null id takes part, but is no anchor unless
    is_anchor says so. Rows that share the anchor's id count as the anchor itself; repeated rows of another id are listed
    each for itself; anchors that repeat id, label and vector are one, and others of one id are anchors of their own.
    Components that a shorter vector lacks count as 0. Negative scores have no negatives, as nothing lies between. Scores
    beyond 64 bits wrap. Other columns are ignored; an empty table gives an empty result.
    """
    parts = rows.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<bigint>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    parts = parts.where(F.col("label").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull()), F.lit(False)))
    candidates = candidate_blocks(parts.select("id", "label", "v"), _pack, PACKED, "bit-planes")
    anchors, passes = query_blocks(parts.where("anchor").select("id", "label", "v"), "anchors")
    near = _ranked(meet(candidates, anchors, passes, _positives(positives), FOUND, "positives"), positives)
    near = stash(near.select("block", "slot", "rank", "id", "score"), "positives")
    bounds = near.groupBy("block").agg(F.collect_list(F.struct("slot", F.col("rank").alias("place"), "score")).alias("positives"))
    bounded = stash(anchors.join(bounds, "block"), "anchors")
    far = _ranked(meet(candidates, bounded, passes, _negatives(negatives, share), FOUND, "negatives"), negatives)
    named = near.select("block", "slot", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(named, ["block", "slot", "place"])
    return out.select("anchor_id", "positive_id", F.col("place").cast("int").alias("positive_rank"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(rows: DataFrame) -> DataFrame:
    """Hard negatives of the anchors (ids divisible by 100), where labels of ids divisible by 7 are moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.where(F.col("label").isNotNull() & finite(F.col("embedding")))
    return mine_hard_negatives(whole, F.col("vec_id") % 100 == 0, quantise(F.col("embedding")), label).drop("positive_rank")


ORACLE = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score FROM r a, r c WHERE a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
"""
