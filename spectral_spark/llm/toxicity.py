"""Toxicity scores: a weighted lexicon, matched by Aho-Corasick in folded text and normalised by length.

The lexicon is learned from a bounded sample of labelled rows: word beginnings (4 to 8 characters) and whole words with
the log ratio of the shares of toxic and clean documents that hold them. A logistic curve through three features of the
matches turns them into a score.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that look like Latin ones, in pairs (first the look-alike, then the letter).
HOMOGLYPHS = "аaеeоoрpсcхxуyіiјjѕsһhԁdԛqԝwαaοoρpνvιiκkτtυuηnωwɑaɡgıiɩiℓlօoսuոnհhⅼlⅽcⅾdⅿm"
#: Digits and signs that stand for letters.
SUBSTITUTES = "0o1i3e4a5s7t@a$s"
#: Phrases in which a listed word is harmless.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "trash bags", "trash collection", "trash compactor", "clown fish", "clown loach", "circus clown", "rodeo clown", "class clown",
    "idiot proof", "idiot light", "idiot board", "soap scum", "pond scum", "scum line", "stupid simple", "stupid money", "loser bracket", "losers bracket", "moron mountain", "disgusting taste test",
)
#: Least and most characters of a word's beginning; most labelled documents learned from, which also bounds the lexicon.
STEMS, SAMPLE_DOCS = (4, 8), 12_000
#: Least weight of an entry: the log of how many times more often toxic documents hold it.
LEAST_WEIGHT = 3.0

_LOOKS = str.maketrans({a: b for a, b in zip(HOMOGLYPHS[::2], HOMOGLYPHS[1::2])} | {chr(0xFF21 + k): chr(97 + k) for k in range(26)} | {chr(0xFF41 + k): chr(97 + k) for k in range(26)})
_SIGNS = str.maketrans(dict(zip(SUBSTITUTES[::2], SUBSTITUTES[1::2])))
_SIGNED = re.compile(r"[\w@$]*?[013457@$][\w@$]*")
_WORDS = re.compile(r"[^\W_]+")


def _unsigned(m: re.Match) -> str:
    """A word of 3 to 20 characters with its signs read as letters, if it has at most two signs for each letter."""
    word = m[0].rstrip("@$")
    letters = sum(map(str.isalpha, word))
    return word.translate(_SIGNS) if 3 <= len(word) <= 20 and letters and len(word) <= 3 * letters else word


def fold(text: str) -> str:
    """Lower case, look-alike letters and substituted digits undone, words joined by one space, a space at each end."""
    text = text.lower().translate(_LOOKS)
    if any(c in text for c in SUBSTITUTES[::2]):
        text = _SIGNED.sub(_unsigned, text)
    return f" {' '.join(_WORDS.findall(text))} "


@dataclass(frozen=True)
class ToxicityModel:
    """entries: pattern in folded text (a leading space, and one more at the end for a whole word) and its weight; exceptions: harmless phrases."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


def _automaton(model: ToxicityModel):
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, weight in model.entries:
        found.add_word(pattern, (len(pattern), weight))
    for phrase in model.exceptions:
        if phrase.strip():
            found.add_word(fold(phrase), (len(fold(phrase)), None))
    if len(found):
        found.make_automaton()
    return found


def features(text: str, automaton) -> tuple[float, float, float]:
    """Of a text's matches: log of their summed weight, log of that weight per hundred words, and log of their number."""
    folded = fold(text)
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    if len(automaton):
        for last, (length, weight) in automaton.iter(folded):
            at = last - length + 1
            if weight is None:
                excused.append((at, last))
            elif weight > best.get(at, 0.0):
                best[at] = weight
    for a, b in excused:
        for at in range(a, b):
            best.pop(at, None)
    total, words = sum(best.values()), folded.count(" ") - 1
    return np.log1p(total), np.log1p(100 * total / (words + 10)), np.log1p(len(best))


def held_out(id_col: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id as text, modulo 4, is 2. (A null id is not held out, but teaches nothing.)"""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _stems(low: int, high: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(fold(text or "").split())
                counts[toxic].update({f" {w[:n]}" for w in words for n in range(low, min(high, len(w)) + 1)} | {f" {w} " for w in words})
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[0][x] for x in names], pa.int64()), pa.array([counts[1][x] for x in names], pa.int64())], ["stem", "clean", "toxic"])

    return run


def _measured(model: ToxicityModel):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        automaton = _automaton(model)
        for batch in batches:
            rows = [(toxic, *features(text or "", automaton)) for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*rows), [pa.int32(), *[pa.float64()] * 3])] if rows else [pa.array([], k) for k in [pa.int32(), *[pa.float64()] * 3]], ["toxic", "a", "b", "c"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge-penalised logistic curve, the intercept first, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), 1e-2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return w


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn from labelled rows that are not held out: from all of them, or from sample_docs of them by the hash of their ids.

    Every stem with enough support and weight is an entry. Rows with a null id or label teach nothing; of several labels for one id the largest counts. Without any toxic row
    the lexicon is empty and all scores are small.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).where(~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__toxic"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample_docs)
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")).join(F.broadcast(known), "__id").select("__text", "__toxic")
    totals = {r[0]: r[1] for r in rows.groupBy("__toxic").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    stems = rows.mapInArrow(_stems(*STEMS), "stem string, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    weight = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    top = stems.where(F.col("toxic") >= max(4, 0.004 * n1)).withColumn("weight", F.round(weight, 4)).where(F.col("weight") >= LEAST_WEIGHT).collect()
    kept: dict[str, float] = {}
    for r in sorted(top, key=lambda r: (len(r["stem"]), r["stem"])):  # a longer stem is listed only where it says more than its beginning
        if r["weight"] > max([kept[r["stem"][:n]] for n in range(2, len(r["stem"])) if r["stem"][:n] in kept], default=0) + 0.5:
            kept[r["stem"]] = r["weight"]
    entries = tuple(sorted(kept.items(), key=lambda e: (-e[1], e[0])))
    draft = ToxicityModel(entries, tuple(exceptions), ())
    seen = np.array([tuple(r) for r in rows.mapInArrow(_measured(draft), "toxic int, a double, b double, c double").collect()])
    curve = _logistic(seen[:, 1:], seen[:, 0]) if n1 and n0 else np.array([-4.0, 0.0, 0.0, 0.0])
    return ToxicityModel(entries, tuple(exceptions), tuple(float(x) for x in curve))


def _scores(model: ToxicityModel):
    import pandas as pd

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(model)
        w = np.array(model.curve)
        for texts in batches:
            x = np.array([features(t or "", automaton) for t in texts]).reshape(-1, 3)
            yield pd.Series(np.round(1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30))), 9))

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 where the score reaches the threshold).

    A null or empty text has no matches and gets the curve's lowest score. Rows pass one by one: equal texts get equal
    scores, and ids, labels and other columns play no part; columns named score or predicted are replaced.
    """
    score = F.pandas_udf(_scores(model), "double")
    return docs.withColumn("score", score(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
