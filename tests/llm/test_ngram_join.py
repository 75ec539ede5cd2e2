import random
from collections import Counter, defaultdict

import pytest

from spectral_spark.llm import common
from spectral_spark.llm import ngram_join as module
from spectral_spark.llm.common import stash
from spectral_spark.llm.components import connected_components
from spectral_spark.llm.ngram_join import CHUNK_MEMBERS, band_plan, keep_one, ngram_join

from .conftest import words


def brute(rows, size=5, threshold=0.8):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    inverted, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    for members in inverted.values():
        for k, i in enumerate(members):
            for j in members[:k]:
                common[j, i] += 1
    parent, links = list(range(len(rows))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, j), n in common.items():
        if n >= threshold * (len(sets[i]) + len(sets[j]) - n) - 1e-9:
            links[i] += 1
            links[j] += 1
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else (least[r] if d is None else min(least[r], d))
    return sorted(((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "n_links").collect()), key=str)


def near_copies(n, seed=3, length=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(length)] = f"x{rng.randrange(9)}"
        out.append(" ".join(t))
    return out


def test_band_plan_reaches_its_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, rows = band_plan(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall
        assert bands * rows <= 144


def test_corpus_against_brute_force(sample):
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    assert rows_of(ngram_join(sample)) == brute(rows)


def test_large_cluster_is_cut_into_chunks(spark):
    texts = near_copies(int(CHUNK_MEMBERS * 1.6))
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000 + i, " ".join(f"q{i}z{k}" for k in range(30))) for i in range(20)]
    assert rows_of(ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_chain_and_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(module, "CHUNK_MEMBERS", 8)
    monkeypatch.setattr(module, "LISTED_CHUNKS", 2)
    chain = [" ".join(f"c{k}" for k in range(4 * i, 4 * i + 80)) for i in range(60)]
    rows = list(enumerate(chain + near_copies(50) + [near_copies(1)[0]] * 40))
    assert rows_of(ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_an_empty_chunk_adds_no_links(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_NGRAMS", 40)
    rows = [(2 * i + k, " ".join(f"w{i}x{j}" for j in range(60)) + " end" * k) for i in range(16) for k in range(2)]
    assert rows_of(ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_plan_rows_do_not_grow_with_the_cluster(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(module, "CHUNK_MEMBERS", 4)
    monkeypatch.setattr(module, "stash", lambda df, name, *more: kept.setdefault(name, stash(df, name, *more)))
    rows = list(enumerate(near_copies(60)))
    assert rows_of(ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert {f.dataType.typeName() for f in kept["plan"].schema} <= {"string", "long", "integer"}
    assert kept["chunks"].selectExpr("max(size(keys))").first()[0] <= 144


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_each_set_is_verified_once(spark, monkeypatch, broadcast_rows):
    verify = module._verify

    def strict(threshold):
        run = verify(threshold)

        def checked(key, table):
            assert len(set(table["sid"].to_pylist())) == table.num_rows
            return run(key, table)

        return checked

    monkeypatch.setattr(module, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(module, "_verify", strict)
    texts = near_copies(4)
    rows = [(1, texts[0])] * 50 + [(1, texts[1]), (1, texts[0].upper()), (2, texts[2])] + [(None, texts[3])] * 20
    assert rows_of(ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "one two"), (4, "One, TWO!"), (None, "one two"), (6, long), (7, long + " end"), (8, "a b c d e f"), (8, "a b c d e f"), (9, "..."), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "'x' as sid", "1 as size", "2 as class_id")
    assert rows_of(ngram_join(df)) == brute(rows)


def test_empty_table(spark):
    assert rows_of(ngram_join(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_keep_one(spark):
    copies = near_copies(30)
    rows = [(i, t) for i, t in enumerate(copies)] + [(100, "alone " * 8), (101, None), (102, ""), (103, "same id other text one two three"), (103, "quite another text with the id of that one"), (104, copies[0]), (104, "not a copy though it has the id of one")]
    df = spark.createDataFrame(rows + [rows[30]], "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in keep_one(df).collect())
    classes = {c for _, c, _ in brute(rows[:30])}
    assert {d for d, _ in kept if d < 30} == classes
    assert kept[100, "alone " * 8] == 1 and kept[101, None] == 1 and kept[102, ""] == 1
    assert sum(n for (d, _), n in kept.items() if d == 103) == 2
    assert [t for d, t in kept if d == 104] == ["not a copy though it has the id of one"]


@pytest.mark.parametrize("task_edges", [0, 1000])
def test_components_of_a_path(spark, task_edges):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(12)] + [("z1", "z2"), ("z2", "z2"), (None, "z3")]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string"), task_edges=task_edges).collect()}
    assert got == {f"n{i:03d}": "n000" for i in range(13)} | {"z1": "z1", "z2": "z1"}
