"""Hard negatives, exact top-k search and the prefix trie against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from spectral_spark.llm import hard_negatives, prefix_trie, topk_search, vectors
from tests.test_oracles import rows_of

EMBEDDINGS = "vec_id long, embedding array<float>, label int, id int, v string, score int, block int"


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", 2, 3) for r in rows], EMBEDDINGS)


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def floors(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def late(i):
    return (i is None, i or 0)


def brute_negatives(rows):
    r = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, floors(v)) for i, v, lab in rows if lab is not None and whole(v)]
    out = []
    for a, lab, v in {(i, la, tuple(v)) for i, la, v in r if i is not None and i % 100 == 0}:
        others = sorted(((-dot(v, w), late(i), la) for i, la, w in r if i != a))
        for s, p, _ in [x for x in others if x[2] == lab][:5]:
            fit = [x for x in others if x[2] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, None if p[0] else p[1], k + 1, None if n[0] else n[1], -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out, key=str)


def brute_top(rows, step=50):
    r = [(i, floors(v)) for i, v, _ in rows if whole(v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in r if i is not None and i % step == 0}:
        best = sorted((-dot(v, w), late(i)) for i, w in r if i != q)[:5]
        out += [(q, k + 1, None if i[0] else i[1], -s) for k, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def some_rows():
    rng = random.Random(5)
    near = [rng.gauss(0, 0.2) for _ in range(13)]
    rows = [(i, [rng.gauss(0, 0.1) + (near[k] if i % 3 else 0) for k in range(13)], rng.randrange(4)) for i in range(420)]
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(120)]  # one vector many times
    rows += [(900, None, 1), (901, [0.1] * 13, None), (902, [0.1] * 12 + [None], 1), (903, [float("nan")] + [0.1] * 12, 1), (904, [float("inf")] * 13, 1)]
    rows += [(910, [], 1), (911, [0.5, 0.25], 1), (912, [0.3] * 40, 2), (913, [3e4] * 13, 2), (914, [-1.0] * 13, 2), (700, [0.0] * 13, 3), (None, rows[5][1], 1), (None, rows[5][1], 2)]
    return rows + [rows[11], rows[11], rows[100], (100, rows[9][1], 3), (-50, rows[3][1], 2), (-100, rows[4][1], 1)]


@pytest.fixture(params=["one pass", "many passes and small blocks"])
def sizes(request, monkeypatch):
    if request.param != "one pass":
        monkeypatch.setattr(vectors, "PASS_BYTES", 300)
        monkeypatch.setattr(vectors, "BLOCK_ROWS", 50)
        monkeypatch.setattr(vectors, "QUERY_ROWS", 2)


def test_hard_negatives(spark, sizes):
    rows = some_rows()
    got = [(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in hard_negatives.hard_negatives(embeddings(spark, rows).repartition(3)).collect()]
    assert sorted(got, key=str) == brute_negatives(rows) and got
    assert hard_negatives.hard_negatives(embeddings(spark, rows).limit(0)).count() == 0
    assert hard_negatives.hard_negatives(embeddings(spark, [(100, [0.5], 1)])).count() == 0


def test_top_search(spark, sizes):
    rows = some_rows()
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.nearest(embeddings(spark, rows).repartition(3)).collect()]
    assert sorted(got, key=str) == brute_top(rows)
    assert topk_search.nearest(embeddings(spark, rows).limit(0)).count() == 0
    assert topk_search.nearest(embeddings(spark, [(50, [0.5], 1)])).count() == 0


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    for run, sql, name in ((hard_negatives.hard_negatives, hard_negatives.ORACLE, "embeddings"), (topk_search.nearest, topk_search.ORACLE, "embeddings"), (prefix_trie.conversation_trie, prefix_trie.ORACLE, "conversations")):
        df = run(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        want = con.sql(sql)
        assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("top", [1, 300, 2**20, 2**40])
def test_scores_are_exact(top):
    rng = np.random.default_rng(3)
    for n, d, a in ((5, 1, 3), (2100, 13, 7), (40, 700, 300), (3, 0, 2)):
        v, w = (rng.integers(-top, top, (k, d), endpoint=True) for k in (n, a))
        assert (hard_negatives.scores(hard_negatives.bit_planes(v), w) == v @ w.T).all()


def test_tables_in_parts(monkeypatch):
    monkeypatch.setattr(hard_negatives, "TABLE_BYTES", 5000)
    rng = np.random.default_rng(4)
    v, w = rng.integers(-99, 99, (30, 20)), rng.integers(-99, 99, (9, 20))
    assert (hard_negatives.scores(hard_negatives.bit_planes(v), w) == v @ w.T).all()


def test_extreme_components_wrap_or_fit(spark):
    rows = [(0, [2**62, 1], 1), (50, [-(2**63), 3], 1), (1, [2**40, 2], 1), (2, [1, 1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, v array<bigint>, label int")
    from pyspark.sql import functions as F

    wrap = lambda x: (x + 2**63) % 2**64 - 2**63
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.search_top(df, F.col("vec_id") % 50 == 0, F.col("v")).collect())
    want = []
    for q, v, _ in (rows[0], rows[1]):
        best = sorted((-wrap(dot(v, w)), i) for i, w, _ in rows if i != q)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_lists_are_not_read_to_their_ends():
    rng = np.random.default_rng(1)
    v = rng.normal(0, 30, (2048, 16)).astype(np.int64)
    v[:40] += 4 * v[0]
    queries = v[:3]
    packed = topk_search._pack(np.arange(2048), np.zeros(2048), v)
    order = np.frombuffer(packed["by_rise"], np.uint16).reshape(16, 2048)
    lists = np.frombuffer(packed["sorted"], f"i{packed['sorted_bytes']}").reshape(16, 2048).astype(np.int64)
    allowed = np.arange(2048)[:, None] != np.arange(3)
    rows, depth = topk_search.no_random_access(order, lists, queries, allowed, np.full(3, np.iinfo(np.int64).min), 5)
    exact = np.where(allowed, v @ queries.T, np.iinfo(np.int64).min)
    best = np.argsort(~exact, axis=0, kind="stable")[:5]
    assert depth < 2048 and all(rows[best[:, q], q].all() and rows[:, q].sum() <= 2048 // topk_search.FEW for q in range(3))


# --- the prefix trie


def talks_of(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32], (role, text)))
    return {c: [t[-1] for t in sorted(x)] for c, x in by.items()}


def brute_trie(rows):
    own, out = talks_of(rows), []
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
    nodes = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    sums = {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves = sum(sums[k][0] for k in kids[p]) if kids[p] else 1
        sums[p] = (leaves, (len(nodes[p]) - 1) * words + sum(sums[k][1] for k in kids[p]))
        ends = ",".join(str(c) for c in sorted(c for c in nodes[p] if len(convs[c]) == len(p)))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(kids[p]), *sums[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


CHATS = "conv_id long, turn long, role string, text string, depth int, h1 string, n int"


def trie(spark, rows, **bounds):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CHATS).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, **bounds).collect()), key=str)


def chat_rows(seed=2):
    rng = random.Random(seed)
    rows = []
    for c in range(-45, 160):
        n = rng.choice([1, 2, 3, 4, 5, 6, 9])
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes no\x0bmaybe", "", None, "a b c"])) for t in range(n)]
    lead = [("user", f"step {k}") for k in range(30)]
    for c in range(400, 460):  # a long beginning that many share
        rows += [(c, t, *x) for t, x in enumerate(lead[: rng.choice([3, 11, 17, 30])] + [("assistant", rng.choice(["one", "two words"]))] * rng.randrange(3))]
    rows += [(c, t, "system", "same") for c in range(500, 590) for t in range(3)]  # one conversation many times
    rows += [(None, 1, "user", "nobody"), (700, None, "user", "first"), (700, 5, "user", "tie"), (700, 5, "assistant", "tie"), (700, 5, "user", "tie"), (700, None, None, None), (701, 1, "user", "x y " * 50_000), (702, 1, "us", "er"), (702, 2, "u", "ser"), (10**15, 1, "user", "far")]
    return rows


def test_trie(spark):
    rows = chat_rows()
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_crowded_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_ROWS", 7)
    monkeypatch.setattr(prefix_trie, "LIST_BYTES", 40)
    rows = chat_rows(3)
    assert trie(spark, rows, group_rows=20) == brute_trie(rows)


def test_trie_of_little(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "a")]) == []
    one = [(1, 1, "user", "a b")]  # crc32("1") % 4 is 3: conversation 0 is absent, and its own turn lies in the first three
    assert trie(spark, one) == brute_trie(one) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
