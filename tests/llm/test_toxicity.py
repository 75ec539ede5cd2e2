import math
import os
import random
from binascii import crc32

import pytest

from spectral_spark.llm import queries
from spectral_spark.llm import toxicity as T


def corpus(spark, n=600, seed=2):
    rng = random.Random(seed)
    plain = ["tree", "house", "river", "cloud", "stone", "garden", "window", "paper", "light", "bread"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = " ".join(rng.choices(plain, k=rng.randrange(20, 60)) + (rng.choices(["wretch", "vermin"], k=3) if toxic else []))
        docs.append((i, text))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_fold_undoes_disguises():
    assert T.fold("Іdiоt!") == " idiot "
    assert T.fold("1d10t m0r0n 2024 17 v3rm1n") == " idiot moron 2024 17 vermin "
    assert T.fold("ＷＲＥＴＣＨ") == " wretch " and T.fold("") == "  "


def test_held_out_accuracy_and_rows(spark):
    docs, labels, truth = corpus(spark)
    model = T.train_toxicity(docs, labels)
    rows = T.score_toxicity(docs, model).withColumn("held_out", T.held_out(docs["doc_id"])).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels, _ = corpus(spark, 200)
    flipped = labels.withColumn("toxic", labels["toxic"] ^ T.held_out(labels["doc_id"]).cast("int")) if False else labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - toxic, toxic) as toxic")
    assert T.train_toxicity(docs, labels) == T.train_toxicity(docs, flipped)


def test_disguised_words_and_exceptions(spark):
    docs, labels, _ = corpus(spark)
    model = T.train_toxicity(docs, labels, exceptions=("vermin control",))
    texts = ["you vermin you vermin vermin", "you v3rmin you vеrmin vermin", "vermin control is a trade and vermin control helps", "a tree"]
    got = {r.doc_id: r.score for r in T.score_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert got[0] == got[1] > 0.5 > 0.3 > got[2] and got[3] < 0.3


def brute_score(text, model):
    """The score by a plain search for each entry at each place, without an automaton."""
    folded = T.fold(text or "")
    starts = {i for phrase in model.exceptions for i in range(len(folded)) if folded.startswith(T.fold(phrase), i)}
    excused = {j for i in starts for phrase in model.exceptions if folded.startswith(T.fold(phrase), i) for j in range(i, i + len(T.fold(phrase)) - 1)}
    best = {}
    for pattern, weight in model.entries:
        at = folded.find(pattern)
        while at >= 0:
            if at not in excused:
                best[at] = max(weight, best.get(at, 0.0))
            at = folded.find(pattern, at + 1)
    total = sum(best.values())
    x = (1.0, math.log1p(total), math.log1p(100 * total / (len(folded.split()) + 10)), math.log1p(len(best)))
    return 1 / (1 + math.exp(-min(30, max(-30, sum(a * b for a, b in zip(model.curve, x))))))


def test_scores_by_plain_search(spark, sample, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = T.train_toxicity(sample, labels, exceptions=("idiot proof", "trash can", "proof of"))
    odd = [(-1, "An IDI0T proof of trash can, trash cаn idiot"), (-2, None), (-3, "idiot idiot proof idiotproof pathetic"), (-4, " " * 1000)]
    df = sample.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = T.score_toxicity(df, model).collect()
    assert model.entries and max(abs(r.score - brute_score(r.text, model)) for r in rows) < 1e-6


@pytest.mark.parametrize("size,least", [("sf0.01", 0.6), ("sf0.1", 0.85)])
def test_held_out_labels_of_the_tables(spark, size, least):
    d = f"/root/testdata/{size}"
    if not os.path.isdir(d):
        pytest.skip("the driver's tables are not here")
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [r for r in queries.op6_toxicity(spark, d).where("held_out").collect() if r.doc_id in truth]
    right = sum(r.predicted and truth[r.doc_id] for r in held)
    assert right >= least * sum(truth[r.doc_id] for r in held) and right >= least * sum(r.predicted for r in held)


def test_edges(spark):
    docs, labels, _ = corpus(spark, 100)
    model = T.train_toxicity(docs, labels)
    rows = [(1, None, 5), (1, "", 5), (None, "vermin " * 3, 5), (2, "tree " * 100_000, 5), (2, "tree " * 100_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = T.score_toxicity(df, model).collect()
    assert len(got) == 5 and len({r.score for r in got if not r.text}) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = T.train_toxicity(empty, labels.limit(0))
    assert none.entries == () and T.score_toxicity(empty, none).count() == 0
    assert all(r.predicted == 0 for r in T.score_toxicity(docs, none).collect())
