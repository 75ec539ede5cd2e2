import random
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from spectral_spark.llm import mixing
from spectral_spark.llm.mixing import LEVELS, budgets, cut_to_tokens, mix_sources


def pour(children, budget):
    """{name: (weight, cap)}: shares by repeated proportional pouring, whole tokens, spare ones by name."""
    given, open_, left = {}, {n: (w, c) for n, (w, c) in children.items() if w > 0}, budget
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if Fraction(left * w, total) >= c]
        if not full:
            for n, (w, _) in open_.items():
                given[n] = left * w // total
            for n in sorted(open_)[: left - sum(given[n] for n in open_)]:
                given[n] += 1
            break
        for n in full:
            given[n] = open_.pop(n)[1]
            left -= given[n]
    return {n: given.get(n, 0) for n in children}


def brute_budgets(leaves, weights, total, epochs):
    def go(prefix, budget):
        names = sorted({leaf[len(prefix)] for leaf in leaves if leaf[: len(prefix)] == prefix})
        caps = {n: sum(s * epochs for leaf, s in leaves.items() if leaf[: len(prefix) + 1] == (*prefix, n)) for n in names}
        shares = pour({n: (weights.get("/".join((*prefix, n)), 1), caps[n]) for n in names}, budget)
        if len(prefix) == 2:
            return {(*prefix, n): v for n, v in shares.items()}
        return {k: v for n, b in shares.items() for k, v in go((*prefix, n), b).items()}

    top = {d for d, _, _ in leaves}
    usable = sum(s * epochs for (d, _, _), s in leaves.items() if weights.get(d, 1) > 0)
    return go((), min(total, usable)) if top else {}


def test_budgets_against_pouring(spark):
    rng = random.Random(4)
    leaves = {(d, lang, s): rng.randrange(1, 10**6) for d in "ab" for lang in ("x", "y", "z") for s in ("1", "2", "3", "4")}
    for total in (10**5, 10**9):
        weights = {"a": 3, "a/x": 5, "a/y": 0, "b/z/1": 7, "b/z/2": 0, "b": 1}
        df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, supply long")
        got = {tuple(r[c] for c in LEVELS): r.given for r in budgets(df, weights, F.lit(total), 2).collect()}
        assert got == brute_budgets(leaves, weights, total, 2)


def test_leaves_of_weight_0_lend_no_room(spark):
    """Large leaves of weight 0 (own, or by a node above) hide that their siblings are short: the rest must go elsewhere in the tree."""
    leaves = {("forum", "en", "src14"): 10, ("forum", "en", "src15"): 10**6, ("forum", "de", "src14"): 50, ("forum", "fr", "src14"): 10**6, ("none", "en", "src1"): 10**6, ("web", "en", "src1"): 1000}
    weights = {"forum": 2, "web": 5, "forum/en": 9, "forum/en/src15": 0, "forum/fr": 0, "none/en": 0}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, supply long")
    for total, web in ((600, 480), (10**7, 2000)):
        got = {tuple(r[c] for c in LEVELS): r.given for r in budgets(df, weights, F.lit(total), 2).collect()}
        assert got == dict.fromkeys(leaves, 0) | {("forum", "en", "src14"): 20, ("forum", "de", "src14"): 100, ("web", "en", "src1"): web}


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, whole int, domain string, before int")


def test_prefixes_take_each_leaf_exactly(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["t"] * rng.randrange(0, 30)), rng.choice(["en", "de"]), rng.choice(["s1", "s2"]), 1, "q", 2) for i in range(400)]
    mixed = mix_sources(docs(spark, rows), F.lit("d"), {"d/en/s1": 50}, share=(9, 10), epochs=3)
    supply, n = defaultdict(int), {r[0]: len((r[1] or "").split()) for r in rows}
    for r in rows:
        supply["d", r[2], r[3]] += n[r[0]]
    want = brute_budgets(supply, {"d/en/s1": 50}, sum(supply.values()) * 9 // 10, 3)
    taken, per = defaultdict(int), defaultdict(list)
    for r in mixed.collect():
        leaf = ("d", r.lang, r.source)
        taken[leaf] += r.mix_take
        per[leaf, r.mix_epoch].append(r)
        assert 0 < r.mix_take <= r.mix_tokens == n[r.doc_id] and r.whole == 1 and r.domain == "q" and r.before == 2
    assert {k: v for k, v in want.items() if v} == dict(taken)
    for (leaf, epoch), got in per.items():
        assert len({r.doc_id for r in got}) == len(got)
        if epoch <= want[leaf] // supply[leaf]:
            assert sum(r.mix_take for r in got) == supply[leaf]
        assert sum(r.mix_take < r.mix_tokens for r in got) <= 1


def test_edges(spark):
    rows = [(1, None, None, None, 1, None, 1), (2, "", "en", "s", 1, "", 1), (None, "a b", "en", "s", 1, "", 1), (3, "c d e", None, None, 1, "", 1), (3, "c d e", None, None, 1, "", 1), (4, "w " * 50_000, "en", "s", 1, "", 1)]
    got = mix_sources(docs(spark, rows), F.col("domain"), {}, total=10**9, epochs=2).collect()
    assert sum(r.mix_take for r in got) == 2 * (2 + 3 + 3 + 50_000)
    assert mix_sources(docs(spark, []), F.lit("d"), {}).count() == 0


def test_ties_and_the_callers_columns(spark):
    """Equal ids of equal length are cut by the digests of their texts, however the rows lie; columns with helpers' names stay."""
    rows = [(7, f"{c} b c", "en", "s", 1, "q", 2) for c in "xyzuvw"]
    taken = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = docs(spark, order).selectExpr("*", "'mine' as __lang", "5 as __h", "6 as __bucket", "7 as ___cut").repartition(3)
        got = mix_sources(df, F.lit("d"), {}, total=10).collect()
        assert all((r["__lang"], r["__h"], r["__bucket"], r["___cut"]) == ("mine", 5, 6, 7) for r in got)
        taken.add(tuple(sorted((r.text, r.mix_take) for r in got)))
    assert len(taken) == 1 and sum(n for _, n in taken.pop()) == 10


def test_cut(spark):
    r = spark.createDataFrame([(" a  b\tc d", 2, 4), ("a b", 2, 2)], "t string, k int, n int").select(cut_to_tokens(F.col("t"), F.col("k"), F.col("n")).alias("c")).collect()
    assert [x.c for x in r] == ["a b", "a b"]


def test_domains():
    assert set(mixing.DOMAINS) == {"web", "reference", "forum"}
