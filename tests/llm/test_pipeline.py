import re
from collections import Counter

import pytest

import corpus_pipeline as P
from spectral_spark.llm import mixing
from spectral_spark.llm.common import stash

from .test_decontamination import brute as hits
from .test_mixing import brute_budgets
from .test_ngram_join import brute as classes
from .test_secrets import base


def test_stages_on_the_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in P.STAGES:
        rows = docs.collect()
        before = [(r.doc_id, r.text) for r in rows]
        docs = stash(stage(spark, docs, sf_dir), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= {d for d, _ in before}
        if name == "mixing":
            leaf = lambda r: (next((d for d, k in mixing.DOMAINS.items() if r.source in {f"src{x}" for x in k}), "other"), r.lang or "", r.source or "")
            words = lambda t: re.findall(r"[^ \t\n\r]+", t or "")
            supply, own, taken = Counter(), {r.doc_id: r for r in rows}, Counter()
            for r in rows:
                supply[leaf(r)] += len(words(r.text))
            want = brute_budgets(supply, mixing.WEIGHTS, sum(supply.values()) * mixing.SHARE[0] // mixing.SHARE[1], 4)
            for r in docs.collect():
                taken[leaf(r)] += r.mix_take
                assert words(r.text) == words(own[r.doc_id].text)[: r.mix_take] and r.mix_domain == leaf(r)[0] and r.n_chars == len(r.text)
            assert dict(taken) == {k: v for k, v in want.items() if v}
            continue
        assert docs.columns == list(P.COLUMNS)
        if name == "toxicity":
            gone = [d for d, _ in before if d not in after]
            known = [truth[d] for d in gone if d in truth]
            clean = [d for d, _ in before if truth.get(d) == 0]
            assert gone and sum(known) >= 0.8 * len(known) and len(gone) <= 0.2 * len(before)
            assert sum(d in after for d in clean) >= 0.97 * len(clean) and all(after[d].text == t for d, t in before if d in after)
        elif name == "ngram_join":
            assert set(after) == {c for _, c, _ in classes(before)}
        elif name == "decontamination":
            assert set(after) == {d for d, *_, bad in hits(before, items) if not bad}
        else:
            assert set(after) == {d for d, _ in before} and not any(base(r.text) for r in after.values()) and all(r.n_chars == len(r.text) for r in after.values())


def test_stages_on_an_empty_table_and_clashing_columns(spark, sf_dir):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0
    names = "id digest sid size keys word words text_ free_ base_spans all_spans __id __text __toxic score predicted __lang __source __h __bucket mix_take mix_domain domain supply given cap component class_id".split()
    rows = [(i, f"plain words number {i} of a text that is like no other {i * 7}", "en", "src0", 50) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *[f"'x{k}' as `{n}`" for k, n in enumerate(names)])
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.columns[:5] == list(P.COLUMNS) and {r.doc_id for r in out.collect()} == set(range(5)) if name != "mixing" else out.count() > 0


@pytest.mark.parametrize("rows", [[(None, None, None, None, None), (1, "", "en", "src0", 0), (1, "", "en", "src0", 0), (2, "word " * 30_000, None, "src1", 150_000), (3, "password = hunter2hunter2", "en", None, 25)]])
def test_stages_on_odd_rows(spark, sf_dir, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    kept = Counter(r.doc_id for r in docs.collect())
    assert kept == Counter({r[0]: 1 for r in rows})
    mixed = P.STAGES[-1][1](spark, docs, sf_dir)
    assert set(r.doc_id for r in mixed.collect()) <= {2, 3}
