import hashlib
import random

from spectral_spark.llm import common
from spectral_spark.llm import decontamination as module
from spectral_spark.llm.decontamination import decontaminate, drop_contaminated

from .conftest import words


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("null" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= owners
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def test_corpus_against_brute_force(spark, sample, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in sample.collect()]
    assert rows_of(decontaminate(sample, bench)) == brute(docs, [(r.item_id, r.text) for r in bench.collect()])


def test_overlaps_repeats_short_items_and_nulls(spark):
    rng = random.Random(1)
    item = [f"w{rng.randrange(6)}" for _ in range(40)]
    docs = [(1, " ".join(item)), (2, " ".join(item[3:18] + item[3:18])), (3, "short item here"), (3, "short item here"), (4, "SHORT, item! nope"), (5, None), (6, ""), (None, "x " + " ".join(item[5:15])), (7, "été ÉTÉ Été"), (8, "w1 " * 30_000 + "short item"), (9, " ".join(item[:9]))]
    items = [(10, " ".join(item)), (2, "Short item"), (11, "Short item"), (None, "short ITEM here"), (3, None), (4, ""), (5, "été ÉTÉ"), (10, " ".join(item))]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'a' as words", "'b' as item", "0 as n_words")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as window")
    assert rows_of(decontaminate(d, b)) == brute(docs, items)


def test_large_benchmarks_shuffle_and_spread_hot_words(spark, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(module, "LEAST_BITS", 64)
    monkeypatch.setattr(module, "MOST_BITS", 256)
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(14))) for i in range(60)] + [(99, "w1 w1")]
    docs = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(20)) + " " + (items[i % 61][1] if i % 2 else "") + " w1 w1" * (i % 5 == 0)) for i in range(120)] + [(None, None), (None, "w1 w1")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontaminate(d, b)) == brute(docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(decontaminate(d, none)) == brute([(1, "a b c")], [])
    assert rows_of(decontaminate(d.limit(0), none)) == []


def test_drop_keeps_clean_rows(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(1, f"before {passage} after"), (2, "clean"), (3, None), (3, passage), (4, "clean"), (4, "clean")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert sorted((r.doc_id, r.text) for r in drop_contaminated(d, b).fillna("").collect()) == [(2, "clean"), (3, ""), (4, "clean"), (4, "clean")]
