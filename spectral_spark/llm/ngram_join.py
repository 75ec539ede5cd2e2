"""Similarity join on word n-grams: MinHash bands find candidates, full n-gram sets decide.

1. One pass makes each text's n-gram set, a digest of it, and one hash per band. Band and row counts come from the
   threshold and the recall asked for (band_plan).
2. Texts with one digest are one member with a number of copies, so copies are never paired.
3. Bands are shuffled by hash. A member's anchor is its fullest bucket; members go with the anchor of their anchor's
   first member, and those that go together with sets of about one size are one chunk, or several of bounded size. Two
   chunks make a block if they share a bucket and their sets are near enough in size for the threshold.
4. Candidates' sets are made anew and verified block by block; every pair of members lies in one block at most. A block
   returns counts of links and a spanning forest, not the pairs.
5. The components of verified edges are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, salted_join, shingle_sets, stash, text_pieces
from .components import connected_components

#: Members and n-grams of one chunk, about.
CHUNK_MEMBERS, CHUNK_NGRAMS = 256, 1_000_000
#: Chunks of one bucket that one task lists against all others of it, about.
LISTED_CHUNKS = 500
#: Most digests of candidates (one long each, some 16 MB with their hash table) that are broadcast; beyond them the join shuffles.
BROADCAST_ROWS = 250_000


def band_plan(threshold: float, recall: float, most: int = 144) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall at the threshold within so many hashes."""
    best = None
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log1p(-p)))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no band plan reaches this recall; allow more hashes")
    return best


def _signatures(size: int, bands: int, rows: int):
    rng = np.random.default_rng(20240229)
    mul = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, np.uint64)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sids, sizes, keys = [], [], []
            for _, data, offsets in text_pieces(batch.column(1)):
                sets = shingle_sets(data, offsets, size)
                full = [s for s in sets if len(s)]
                sizes += [len(s) for s in sets]
                sids += [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
                if not full:
                    keys += [None] * len(sets)
                    continue
                values = np.concatenate(full)
                starts = np.cumsum([0, *map(len, full[:-1])])
                hashed = np.zeros((bands, len(full)), np.uint64)
                for band in range(bands):
                    h = np.full(len(full), band + 1, np.uint64)
                    for k in range(band * rows, band * rows + rows):
                        t = values * mul[k]
                        t += add[k]
                        h = mix(h * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(t, starts))
                    hashed[band] = h
                made = iter(np.ascontiguousarray(hashed.T).view(np.int64))
                keys += [next(made) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sids, pa.string()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "digest", "sid", "size", "keys"])

    return run


def _sets(size: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for _, data, offsets in text_pieces(batch.column(0)):
                made = [s.tobytes() for s in shingle_sets(data, offsets, size)]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(s, digest_size=16).hexdigest() if s else None for s in made], pa.string()), pa.array(made, pa.binary())], ["sid", "grams"])

    return run


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, through a 0/1 matrix of the shared values, a slice of its columns at a time."""
    n = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    code = np.cumsum(np.r_[False, values[1:] != values[:-1]])
    shared = np.bincount(code)[code] > 1
    code, owner = np.unique(code[shared], return_inverse=True)[1], owner[shared]
    out = np.zeros((n, n), np.float64)
    for c in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [c, c + width])
        m = np.zeros((n, width), np.float32)
        m[owner[a:b], code[a:b] - c] = 1
        out += m @ m.T
    return out


def _verify(threshold: float):
    def run(key, table):
        import pyarrow as pa

        a, b = (k.as_py() for k in key)
        sid, first = np.unique(np.array(table["sid"].to_pylist(), object), return_index=True)
        grams, side, copies = table["grams"].to_pylist(), table["side"].to_numpy()[first], table["copies"].to_numpy()[first]
        sets = [np.frombuffer(grams[i], np.uint64) for i in first]
        sizes, both = np.array([len(s) for s in sets], float), overlaps(sets)
        linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if a != b:  # two chunks, one of which may have no members
            linked &= side[:, None] != side[None, :]
        label = np.arange(len(sets))
        while True:
            new = np.minimum(label, np.where(linked, label[None, :], len(sets)).min(1))
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(sets)))
        counts = np.rint(linked @ copies.astype(float)).astype(np.int64)
        some = np.flatnonzero(counts)
        return pa.table({"sid": pa.array([*sid[some], *sid[moved]], pa.string()), "other": pa.array([None] * len(some) + list(sid[label[moved]]), pa.string()), "links": pa.array([*counts[some].tolist(), *[0] * len(moved)], pa.int64())})

    return run


def _blocks(shared: DataFrame, total: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """From (sid, size, key, n, head), a row for each member and bucket that it shares: (sid, chunk) and (chunk, a, b, side), the blocks of each chunk.

    Sets match only if their sizes differ by the threshold's ratio at most: such sets are of one level or of neighbouring ones.
    """
    step = -math.log(threshold)
    level = F.floor(F.log(F.col("size").cast("double")) / step + 1e-9).cast("int")
    own = shared.groupBy("sid", "size").agg(F.max(F.struct("n", "key", "head")).alias("anchor"), F.collect_list("key").alias("keys"))  # one key a band
    own = stash(own.select("sid", "size", level.alias("level"), "anchor.*", "keys"), "anchors")
    # small buckets about one text would make many small chunks: a bucket's members go with its first member's own anchor
    firsts = own.groupBy("key", "n").agg(F.min("head").alias("sid")).join(own.select("sid", F.col("key").alias("place")), "sid").select("key", "n", "place")
    own = salted_join(own.drop("n", "head"), firsts, "key", "n", total, "sid").select("sid", "size", "level", "keys", F.xxhash64("place", "level").alias("unit"))
    own = stash(own, "units")
    units = own.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_MEMBERS), F.ceil(F.sum("size") / CHUNK_NGRAMS)).alias("parts"))
    chunk = F.xxhash64("unit", F.pmod(F.xxhash64("sid"), F.col("parts")))
    own = stash(salted_join(own, units, "unit", "n", total, "sid").select("sid", chunk.alias("chunk"), "level", "keys"), "chunks")
    held = own.select(F.explode("keys").alias("key"), "chunk", "level").distinct()
    many = held.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / LISTED_CHUNKS).cast("int").alias("turns"), F.count(F.lit(1)).alias("chunks"))
    spread = held.join(many.where("chunks > 1"), "key")
    one = spread.withColumn("turn", F.pmod("chunk", "turns"))
    other = spread.select("key", F.col("chunk").alias("chunk2"), F.col("level").alias("level2"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"))
    pairs = one.join(other, ["key", "turn"]).where("chunk < chunk2 and abs(level - level2) <= 1").select(F.col("chunk").alias("a"), F.col("chunk2").alias("b")).distinct()
    both = F.explode(F.array(F.struct(F.col("a").alias("chunk"), F.lit(0).alias("side")), F.struct(F.col("b").alias("chunk"), F.lit(1).alias("side")))).alias("x")
    blocks = pairs.select("a", "b", both).select("x.chunk", "a", "b", "x.side")
    within = own.groupBy("chunk").count().where("count > 1").select("chunk", F.col("chunk").alias("a"), F.col("chunk").alias("b"), F.lit(0).alias("side"))
    return own.select("sid", "chunk"), blocks.unionByName(within)


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, recall: float) -> DataFrame:
    """(id, digest of the text, component, class_id, n_links) for each row of docs; no component without words."""
    bands, rows = band_plan(threshold, recall)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))
    kind = base.schema["id"].dataType.simpleString()
    sig = stash(base.mapInArrow(_signatures(size, bands, rows), f"id {kind}, digest long, sid string, size long, keys array<long>"), "signatures")
    total = sig.count()
    worded = sig.where("sid is not null")
    members = stash(worded.groupBy("sid").agg(F.min("id").alias("rep"), F.min("digest").alias("digest"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("keys").alias("keys")), "members")
    keyed = members.select("sid", "size", F.explode("keys").alias("key"))
    buckets = stash(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("sid").alias("head")).where("n > 1"), "buckets")
    chunks, blocks = _blocks(salted_join(keyed, buckets, "key", "n", total, "sid"), total, threshold)
    plan = stash(members.select("sid", "digest", "copies").join(chunks, "sid"), "plan")

    # each text once, united before texts are shuffled: copies of a row never meet in one task
    wanted = plan.select("digest").distinct()
    once = lambda df: df.groupBy("digest").agg(F.collect_set("text").alias("texts"))
    texts = once(base.join(F.broadcast(wanted), "digest", "left_semi")) if plan.count() <= BROADCAST_ROWS else once(base).join(wanted, "digest", "left_semi")
    texts = texts.select(F.explode("texts").alias("text"))
    grams = texts.mapInArrow(_sets(size), "sid string, grams binary")
    # blocks are listed by small rows first: a set is copied once for each block that it lies in
    listed = plan.join(blocks, "chunk").select("sid", "copies", "a", "b", "side")
    verified = stash(grams.join(listed, "sid").groupBy("a", "b").applyInArrow(_verify(threshold), "sid string, other string, links long"), "verified")
    links = verified.where("other is null").groupBy("sid").agg(F.sum("links").alias("links"))
    parts = connected_components(verified.where("other is not null"), "sid", "other")
    classes = members.select("sid", "rep", "copies").join(parts.withColumnRenamed("node", "sid"), "sid", "left").join(links, "sid", "left")
    classes = classes.select("sid", "rep", "copies", F.coalesce("component", "sid").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    heads = classes.groupBy("component").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("n"))
    classes = stash(salted_join(classes, heads, "component", "n", total, "sid").select("sid", "component", "class_id", "copies", (F.col("links") + F.col("copies") - 1).alias("n_links")), "classes")
    out = salted_join(worded.select("id", "digest", "sid"), classes, "sid", "copies", total, "id").select("id", "digest", "component", "class_id", F.col("n_links").cast("long").alias("n_links"))
    wordless = sig.where("sid is null").select("id", "digest", F.lit(None).cast("string").alias("component"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(wordless)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row per row of docs: the id, class_id (smallest id of its class) and n_links (other rows at least as similar).

    Words are runs of digits, letters (A-Z in lower case) and non-ASCII; sets are of `size` consecutive words, and a
    text of fewer words is one n-gram. Rows are linked if the Jaccard similarity of their sets reaches the threshold;
    a class is a connected component of links. A text without words (null, empty) links to nothing: it is its own
    class. Repeated rows are copies and count as links of each other; a null id is kept, and is a class_id only where
    the class has no other. All other columns are ignored; an empty table gives an empty result.
    """
    out = _classes(docs, id_col, text_col, size, threshold, recall)
    return out.select(F.col("id").alias(id_col), "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """The rows of docs without all but one of each class: that with the smallest id, then the smallest digest of its text.

    Texts without words are classes of their own; of rows that repeat one id and text, one stays. A row whose id is null
    stays only if its class has no other id.
    """
    classes = _classes(docs, id_col, text_col, size, threshold, recall)
    own = F.concat(F.lit("-"), F.coalesce(F.col("digest").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("first")
    heads = classes.groupBy(F.coalesce("component", own).alias("class")).agg(first)
    kept = heads.select(F.col("first.id").alias("kept_id"), F.col("first.digest").alias("kept_digest"))
    times = classes.groupBy(F.col("id").alias("kept_id"), F.col("digest").alias("kept_digest")).count()
    twice = times.where("count > 1").drop("count")
    same = F.col(id_col).eqNullSafe(F.col("kept_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("kept_digest"))
    rows = docs.join(kept, same, "left_semi")
    once = rows.join(twice, same, "left_anti")
    more = rows.join(twice, same, "left_semi").withColumn("__digest", F.xxhash64(F.col(text_col).cast("string"))).dropDuplicates([id_col, "__digest"]).drop("__digest")
    return once.unionByName(more)
