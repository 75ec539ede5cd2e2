"""The prefix trie of conversations by truncation peeling: from the deepest level up, nodes lose their last turn and meet again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, mix, salted_join, stash

#: Contributions that share a prefix and are peeled in one task; prefixes with more are peeled in narrower bands.
GROUP_ROWS = 50_000
#: Contributions that a task peels at once, and bytes of listed ids in a row.
CHUNK_ROWS, LIST_BYTES = 50_000, 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()
SPACE = r"[^\x20\x09-\x0D]+"

#: What a conversation's end or a node without its last turn brings to the node of its first `depth` turns.
PART = "depth int, p1 array<bigint>, p2 array<bigint>, words array<int>, n bigint, conv bigint, children bigint, leaves bigint, saved bigint, ends string"
#: A finished node; h1, h2 name it and g1, g2 its parent.
NODE = "depth int, h1 bigint, h2 bigint, g1 bigint, g2 bigint, conv bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, ends string"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def turns_of(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): for each id its turns in order, as (turn, digest of role and text, words of the text)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = chats.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")).where("conv is not null")
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32))
    one = F.struct("turn", digest.alias("digest"), F.regexp_count("text", F.lit(SPACE)).alias("words"))
    return rows.select("conv", one.alias("t")).groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuild(talks: DataFrame, first: Column, head: Column, most: int) -> DataFrame:
    """(conv, turns): the first `head` turns (at most `most`) of conversation `first`, then the own turns after as many."""
    base = talks.select(F.col("conv").alias("base"), F.slice("turns", 1, most).alias("lead"))
    own = talks.withColumn("base", first).withColumn("head", head)
    none = F.filter("turns", lambda t: F.lit(False))
    rest = F.when(F.size("turns") > F.col("head"), F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))).otherwise(none)
    lead = F.when(F.col("lead").isNull() | (F.col("head") == 0), none).otherwise(F.slice("lead", 1, F.greatest("head", F.lit(1))))
    wanted = base.join(own.select("base").distinct(), "base", "left_semi")
    return own.join(wanted, "base", "left").select("conv", F.concat(lead, rest).alias("turns"))


# --- ends: one contribution for each distinct conversation


def _paths(batches: Iterator) -> Iterator:
    """Prefix hashes of each conversation: running sums, in two lanes, of what mixes a turn's digest with its place."""
    import pyarrow as pa

    for batch in batches:
        turns = batch.column(1)
        at = turns.offsets.to_numpy().astype(np.int64)
        flat = turns.flatten() if not turns.null_count else turns.values
        flat = flat if len(flat) == at[-1] - at[0] else flat.slice(at[0], at[-1] - at[0])
        at = at - at[0]
        digest = np.frombuffer(b"".join(flat.field(1).to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)
        sizes = np.diff(at)
        place = mix((np.arange(at[-1]) - np.repeat(at[:-1], sizes) + 1).astype(np.uint64))
        lanes = []
        for lane in range(2):
            sums = np.r_[np.uint64(0), np.cumsum(mix(digest[:, lane] ^ mix(place + np.uint64(lane))), dtype=np.uint64)]
            lanes.append((sums[1:] - np.repeat(sums[at[:-1]], sizes)).view(np.int64))
        last = [np.where(sizes > 0, np.r_[lane, 0][np.maximum(at[1:] - 1, 0)], 0) for lane in lanes]
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, kind)) for x, kind in ((lanes[0], pa.int64()), (lanes[1], pa.int64()), (flat.field(2), pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(last[0], pa.int64()), pa.array(last[1], pa.int64()), *lists], ["conv", "depth", "h1", "h2", "p1", "p2", "words"])


PATH = "conv bigint, depth int, h1 bigint, h2 bigint, p1 array<bigint>, p2 array<bigint>, words array<int>"
LISTED = "depth int, h1 bigint, h2 bigint, first bigint, n bigint, ids string, p1 array<bigint>, p2 array<bigint>, words array<int>"


def _emit(rows: list, schema: str):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]))


def _lists(batches: Iterator) -> Iterator:
    """Rows sorted by (h1, h2, depth, conv) as lists of ids of up to LIST_BYTES."""
    key, row, ids, held = None, None, [], 0
    for batch in batches:
        out = []
        for i, k in enumerate(zip(*[batch.column(c).to_pylist() for c in ("h1", "h2", "depth", "conv")])):
            if k[:3] != key or held > LIST_BYTES:
                if row:
                    out.append(row | {"n": len(ids), "ids": ",".join(ids)})
                key, ids, held = k[:3], [], 0
                row = {"depth": k[2], "h1": k[0], "h2": k[1], "first": k[3]} | {c: batch.column(c)[i].as_py() for c in ("p1", "p2", "words")}
            ids.append(str(k[3]))
            held += len(ids[-1]) + 1
        if out:
            yield _emit(out, LISTED)
    if row:
        yield _emit([row | {"n": len(ids), "ids": ",".join(ids)}], LISTED)


def _digests(batches: Iterator) -> Iterator:
    """Lists sorted by (h1, h2, depth, first) as one contribution for each end; a digest takes list after list."""
    key, row, sha = None, None, None
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            k = (x["h1"], x["h2"], x["depth"])
            if k != key:
                if row:
                    out.append(row | {"ends": sha.hexdigest()})
                key, sha = k, hashlib.sha256(x["ids"].encode())
                row = {"depth": x["depth"], "p1": x["p1"], "p2": x["p2"], "words": x["words"], "n": x["n"], "conv": x["first"], "children": 0, "leaves": 0, "saved": 0}
            else:
                sha.update(b"," + x["ids"].encode())
                row["n"] += x["n"]
        if out:
            yield _emit(out, PART)
    if row:
        yield _emit([row | {"ends": sha.hexdigest()}], PART)


def ended(talks: DataFrame) -> DataFrame:
    """PART for each distinct conversation of (conv, turns): equal ones are one, with their number, smallest id and digest of ids.

    Ids are sorted by range, so that many equal conversations spread over tasks; lists of ids, not ids, meet in the task
    that digests them, one at a time.
    """
    paths = stash(talks.mapInArrow(_paths, PATH), "paths")
    parts = int(talks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["h1", "h2", "depth"]
    listed = paths.repartitionByRange(parts, *by, "conv").sortWithinPartitions(*by, "conv").mapInArrow(_lists, LISTED)
    return listed.repartition(parts, *by).sortWithinPartitions(*by, "first").mapInArrow(_digests, PART)


# --- peeling


def _peel_chunk(table, low: int) -> Iterator:
    """Peel contributions of whole prefixes at depth `low`, from the deepest level to low + 1; yields nodes, then what they bring to depth low."""
    import pyarrow as pa

    col = lambda c: table.column(c).combine_chunks()
    depth = col("depth").to_numpy().astype(np.int64)
    p1, p2, words = col("p1"), col("p2"), col("words")
    at = p1.offsets.to_numpy().astype(np.int64)
    h1, h2, w = (x.values.to_numpy(zero_copy_only=False) for x in (p1, p2, words))
    ends = col("ends").to_pylist()
    state = {c: col(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "conv", "children", "leaves", "saved")} | {"row": np.arange(len(depth)), "end": np.where([e is not None for e in ends], np.arange(len(depth)), -1)}
    none = {c: np.zeros(0, np.int64) for c in state}
    order = np.argsort(-depth, kind="stable")
    cuts = np.searchsorted(-depth[order], -np.arange(low, int(depth.max(initial=low)) + 1), "right")  # rows at least so deep
    live, made = none, []
    for d in range(int(depth.max(initial=low)), low, -1):
        new = order[cuts[d - low + 1] if d - low + 1 < len(cuts) else 0 : cuts[d - low]]
        both = {c: np.r_[live[c], state[c][new]] for c in state}
        at1 = at[both["row"]] + d - 1
        by = np.lexsort((h2[at1], h1[at1]))
        a, b = h1[at1][by], h2[at1][by]
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        node = {c: f.reduceat(both[c][by], starts) for c, f in (("n", np.add), ("conv", np.minimum), ("children", np.add), ("leaves", np.add), ("saved", np.add), ("end", np.maximum))} | {"row": both["row"][by][starts]}
        group = np.empty(len(by), np.int64)
        group[by] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(by)]))
        node["leaves"] = np.where(node["children"] == 0, 1, node["leaves"])
        node["saved"] = node["saved"] + (node["n"] - 1) * w[at[node["row"]] + d - 1]
        if made:  # the nodes just below learn their parent's smallest id
            made[-1]["parent"] = node["conv"][group[: len(made[-1]["n"])]]
        top = at[node["row"]] + d - 1
        zero = np.zeros(len(top), np.int64)
        made.append(node | {"depth": np.full(len(top), d), "h1": h1[top], "h2": h2[top], "g1": h1[top - 1] if d > 1 else zero, "g2": h2[top - 1] if d > 1 else zero})
        live = node | {"children": np.ones(len(top), np.int64), "end": np.full(len(top), -1)}
    for x in made:
        size = len(x["n"])
        parent = pa.array(x["parent"], pa.int64()) if "parent" in x else pa.nulls(size, pa.int64())
        texts = pa.array([ends[i] if i >= 0 else EMPTY for i in x["end"].tolist()], pa.string())
        columns = {"depth": pa.array(x["depth"], pa.int32()), "parent": parent, "ends": texts}
        yield pa.RecordBatch.from_arrays([pa.nulls(size, pa.list_(pa.int64())), pa.nulls(size, pa.list_(pa.int64())), pa.nulls(size, pa.list_(pa.int32())), pa.array(np.ones(size, bool)), *[columns.get(c, None) if c in columns else pa.array(x[c], pa.int64()) for c in NODE_COLUMNS]], ["p1", "p2", "words", "done", *NODE_COLUMNS])
    if made:
        size = len(live["n"])
        spots = (at[live["row"]][:, None] + np.arange(low)).ravel()
        offsets = pa.array(np.arange(size + 1) * low, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[spots], k)) for x, k in ((h1, pa.int64()), (h2, pa.int64()), (w, pa.int32()))]
        columns = {"depth": pa.array(np.full(size, low), pa.int32()), "parent": pa.nulls(size, pa.int64()), "ends": pa.nulls(size, pa.string())} | {c: pa.array(np.zeros(size, np.int64)) for c in ("h1", "h2", "g1", "g2")}
        yield pa.RecordBatch.from_arrays([*lists, pa.array(np.zeros(size, bool)), *[columns[c] if c in columns else pa.array(live[c], pa.int64()) for c in NODE_COLUMNS]], ["p1", "p2", "words", "done", *NODE_COLUMNS])


def _peel(low: int) -> Callable:
    """Rows sorted by their prefix at depth `low` (g1, g2), chunk by chunk of whole prefixes."""
    import pyarrow as pa

    def run(batches):
        held: list = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < CHUNK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            a, b = (table.column(c).to_numpy() for c in ("g1", "g2"))
            new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            if len(new):
                yield from _peel_chunk(table.slice(0, int(new[-1]) + 1), low)
                held = table.slice(int(new[-1]) + 1).to_batches()
            else:
                held = table.combine_chunks().to_batches()
        if held:
            yield from _peel_chunk(pa.Table.from_batches(held), low)

    return run


def _step(parts: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """One level by Spark's aggregation, which sums up in each task first: the nodes of `depth`, and what they bring to the level above."""
    last = lambda c, k: F.try_element_at(c, F.lit(k)) if depth >= k else F.lit(0).cast("long")
    keyed = parts.withColumns({"h1": last("p1", depth) if depth else F.lit(0).cast("long"), "h2": last("p2", depth) if depth else F.lit(0).cast("long")})
    node = keyed.groupBy("h1", "h2").agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("words").alias("words"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"))
    words = F.try_element_at("words", F.lit(depth)) if depth else F.lit(0)
    node = node.withColumns({"depth": F.lit(depth), "leaves": F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long"), "saved": (F.col("saved") + (F.col("n") - 1) * words).cast("long"), "ends": F.coalesce("ends", F.lit(EMPTY))})
    up = lambda c: F.try_element_at(c, F.lit(depth - 1)) if depth > 1 else F.lit(0).cast("long")
    node = stash(node.withColumns({"g1": up("p1"), "g2": up("p2"), "parent": F.lit(None).cast("long")}), f"level-{depth}")
    shorter = lambda c: F.slice(c, 1, depth - 1) if depth > 1 else F.filter(c, lambda x: F.lit(False))
    brought = node.select(F.lit(depth - 1).alias("depth"), *[shorter(c).alias(c) for c in ("p1", "p2", "words")], "n", "conv", F.lit(1).cast("long").alias("children"), "leaves", "saved", F.lit(None).cast("string").alias("ends"))
    return node.select(*NODE_COLUMNS), brought


def _band(parts: DataFrame, high: int, low: int, group_rows: int, made: list[tuple[DataFrame, int]]) -> DataFrame:
    """Peel the levels high..low + 1 of parts (all of such depth); adds (nodes, depth whose parents are not known) to made and returns what comes to depth low.

    Prefixes at depth low that few contributions share are peeled whole, in tasks. Those that many share are peeled in two
    narrower bands, in the end level by level, where aggregation needs no group in one place.
    """
    if high - low == 1:
        nodes, brought = _step(parts, high)
        made.append((nodes, high))
        return brought
    keyed = parts.withColumns({"g1": F.element_at("p1", low) if low else F.lit(0).cast("long"), "g2": F.element_at("p2", low) if low else F.lit(0).cast("long")})
    keyed = stash(keyed, f"band-{low}")
    total = keyed.count()
    if not total:
        return parts.limit(0)
    counts = keyed.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(group_rows, total // 10_000))
    hot = stash(counts.select("g1", "g2"), "hot")  # at most ten thousand
    some = bool(hot.head(1))
    calm = keyed.join(F.broadcast(hot), ["g1", "g2"], "left_anti") if some else keyed
    columns = ["g1", "g2", *[c.split()[0] for c in PART.split(", ")]]
    peeled = calm.select(*columns).repartition("g1", "g2").sortWithinPartitions("g1", "g2").mapInArrow(_peel(low), "p1 array<bigint>, p2 array<bigint>, words array<int>, done boolean, " + NODE)
    peeled = stash(peeled, f"peeled-{low}")
    made.append((peeled.where("done").select(*NODE_COLUMNS), low + 1))
    names = [c.split()[0] for c in PART.split(", ")]
    out = peeled.where("not done").select(*names)
    if some:
        crowd, middle = keyed.join(F.broadcast(hot), ["g1", "g2"], "left_semi").select(*names), (high + low) // 2
        upper = _band(crowd.where(F.col("depth") > middle), high, middle, group_rows, made)
        out = out.unionByName(_band(upper.unionByName(crowd.where(F.col("depth") <= middle)), middle, low, group_rows, made))
    return out


def prefix_trie(talks: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Nodes of the prefix trie of (conv, turns as turns_of gives them): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    From the greatest depth up, conversations that end at a level and nodes that survive from the level below are merged
    by the hash of their turns; a node is finished there, loses its last turn and goes up. Levels are taken in bands, each
    half as deep as the one below: all that share a prefix at the band's top are peeled in one task, level by level;
    prefixes that very many share are peeled level by level in Spark. So the number of jobs grows with the logarithm of
    the depth, and nodes, sums and leaves come from one pass.

    A task holds the digests of a conversation's turns (20 bytes each), never its texts. Prefixes are told by 128-bit hashes.
    """
    bound_batches(talks.sparkSession)
    ends = stash(ended(talks), "ends")
    deepest = ends.agg(F.max("depth")).first()[0]
    made: list[tuple[DataFrame, int]] = []
    cuts = [0, 1]
    while cuts[-1] < (deepest or 0):
        cuts.append(2 * cuts[-1])
    parts = ends.limit(0)
    for low, high in zip(cuts[-2::-1], cuts[:0:-1]):
        parts = _band(parts.unionByName(ends.where((F.col("depth") > low) & (F.col("depth") <= high))), high, low, group_rows, made)
    root, _ = _step(parts.unionByName(ends.where("depth = 0")), 0)
    nodes = root
    for x, _ in made:
        nodes = nodes.unionByName(x)
    return _with_parents(nodes, sorted({d - 1 for _, d in made}))


def _with_parents(nodes: DataFrame, depths: list[int]) -> DataFrame:
    """Parents' smallest ids, looked up for nodes whose parents were finished elsewhere; children of one node may be very many."""
    lost = F.col("parent").isNull() & (F.col("depth") > 0)
    rows = nodes.where(lost).withColumn("up", F.concat_ws(":", F.col("depth") - 1, "g1", "g2"))
    table = nodes.where(F.col("depth").isin(depths) & (F.col("children") > 0)).select(F.concat_ws(":", "depth", "h1", "h2").alias("up"), F.col("conv").alias("parent_conv"), F.col("children").alias("kids"))
    total = rows.count()
    found = salted_join(rows, table, "up", "kids", total, "conv").withColumn("parent", F.col("parent_conv"))
    out = nodes.where(~lost).select(*NODE_COLUMNS).unionByName(found.select(*NODE_COLUMNS))
    long = lambda c: F.col(c).cast("long")
    return out.select(long("conv").alias("conv_id"), long("depth").alias("depth"), long("parent").alias("parent_conv_id"), long("n").alias("n_convs"), long("children").alias("n_children"), long("leaves").alias("n_leaves"), long("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def conversation_trie(chats: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The trie of conversations rebuilt on shared beginnings: the first h turns of conversation c - c % 20, then c's own after its first h; h is crc32(c) % 4.

    Null roles and texts count as empty; null turns come first, and equal turn numbers go by the digest of role and text
    (sha256 of the role's length, a colon, role and text), so repeated rows are turns of their own. Rows without an id
    belong to no conversation and are left out. A conversation without turns ends at the root. Other columns are ignored;
    an empty table has no nodes, not even a root.
    """
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    talks = stash(turns_of(chats), "turns")
    return prefix_trie(rebuild(talks, F.col("conv") - F.col("conv") % 20, head, 3), group_rows)


_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))))"
ORACLE = f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, turn, {{'k': sha256(length(role) || ':' || role || text)[1:32], 'w': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))}} AS s FROM t),
o AS (SELECT c, list(s ORDER BY turn NULLS FIRST, s.k) AS l, (xor({_CRC}, 4294967295::BIGINT) % 4)::INT AS h FROM k GROUP BY c),
r AS (SELECT o.c, list_concat(coalesce(b.l, [])[1:o.h], o.l[o.h + 1:]) AS l FROM o LEFT JOIN o b ON b.c = o.c - o.c % 20),
m AS (SELECT c, len(l) AS size, unnest(range(0, len(l) + 1)) AS d, l FROM r),
n AS (SELECT d, list_transform(l[1:d], lambda x: x.k) AS p, min(c) AS conv, count(*) AS n_convs, any_value(l[1:d]) AS l, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d) AS ends, bool_and(size = d) AS leaf FROM m GROUP BY ALL HAVING d IS NOT NULL),
u AS (SELECT p, d, p[1:x] AS up, x, (n_convs - 1) * coalesce(l[d].w, 0) AS own, leaf FROM (SELECT *, unnest(range(0, d + 1)) AS x FROM n)),
a AS (SELECT up, sum(own) AS saved, count(*) FILTER (leaf) AS leaves, count(*) FILTER (d = x + 1) AS children FROM u GROUP BY up)
SELECT n.conv AS conv_id, n.d::BIGINT AS depth, q.conv AS parent_conv_id, n.n_convs, a.children AS n_children, a.leaves AS n_leaves, a.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN a ON a.up = n.p LEFT JOIN n q ON n.d > 0 AND q.p = n.p[1:n.d - 1] AND q.d = n.d - 1
"""
