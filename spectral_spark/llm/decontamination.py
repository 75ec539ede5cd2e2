"""Benchmark decontamination: a prefix-filtered join of documents with item windows, in DataFrame operations alone.

A window is `size` consecutive words of an item. All of its words must occur for it to occur, so its rarest word is a
sufficient prefix: only document words that are some window's rarest word are looked up. Rarity is counted over all
documents. Each found word fixes where the window would begin (positional bound), the document must be long enough
(length bound), and then the words around it are compared with the whole window.

A bitmap of bounded size tells, inside the scan, which words may be such prefixes; the join decides. So neither all
words of a document nor its text are shuffled: only one row for each document and the rows of candidate words are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stash, word_array

#: Least and most bits of the bitmap, its bits for each prefix word, and the most windows that are broadcast (the joins shuffle beyond it).
LEAST_BITS, MOST_BITS, BITS_EACH, BROADCAST_ROWS = 1 << 17, 1 << 23, 16, 200_000


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(item, words) for each distinct window of each item; an item of fewer words, but not none, is one window."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), word_array(F.col(text_col).cast("string")).alias("words")).where(F.size("words") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))).alias("at")
    return items.select("item", "words", at).select("item", F.slice("words", F.col("at"), F.lit(size)).alias("window")).distinct()


def _slot(word: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(bits))


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str, size: int) -> DataFrame:
    """For each distinct (id, digest of the text): copies, n_words, and the occurring windows as spans and items."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    windows = stash(item_windows(benchmark, item_id, item_text, size), "windows")
    hint = F.broadcast if windows.count() <= BROADCAST_ROWS else (lambda df: df)

    # rarity over all documents, then each window's rarest word and its place in the window
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    counts = base.select(F.explode(word_array(F.col("text"))).alias("word")).join(hint(vocabulary), "word", "left_semi").groupBy("word").count()
    placed = windows.select("item", "window", F.posexplode("window").alias("place", "word")).join(hint(counts), "word", "left")
    first = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "word", "place")).alias("rare")
    prefixes = stash(placed.groupBy("item", "window").agg(first).select("item", "window", F.col("rare.word").alias("word"), F.col("rare.place").alias("place"), F.col("rare.n").alias("n")), "prefixes")

    words_found = prefixes.select("word", "n").distinct().agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("total")).first()
    bits = LEAST_BITS  # a power of two; beyond MOST_BITS more words pass and the join drops them
    while bits < min(MOST_BITS, BITS_EACH * words_found["words"]):
        bits *= 2
    slots = prefixes.select(_slot(F.col("word"), bits).alias("slot")).distinct()
    filled = {r["cell"]: r["bits"] for r in slots.groupBy((F.col("slot") / 64).cast("int").alias("cell")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))).alias("bits")).collect()}
    bitmap = F.split(F.lit(",".join(str(filled.get(i, 0)) for i in range(bits // 64))), ",").cast("array<bigint>")

    def may_begin(i: Column) -> Column:
        slot = _slot(F.element_at("words", i), bits)
        return F.call_function("shiftright", F.get(bitmap, F.shiftright(slot, 6).cast("int")), (slot % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    reach = 2 * size - 1
    words = base.select("id", F.xxhash64("text").alias("digest"), word_array(F.col("text")).alias("words"))
    places = F.when(F.size("words") > 0, F.filter(F.sequence(F.lit(1), F.size("words")), may_begin)).otherwise(F.array().cast("array<int>"))
    begin = lambda i: F.greatest(i - size + 1, F.lit(1))
    near = F.transform(places, lambda i: F.struct(i.alias("at"), F.element_at("words", i).alias("word"), begin(i).alias("since"), F.slice("words", begin(i), F.lit(reach)).alias("around")))
    own = F.struct(F.lit(0).alias("at"), F.concat(F.lit(" "), F.col("id").cast("string"), F.col("digest").cast("string")).alias("word"), F.lit(0).alias("since"), F.array().cast("array<string>").alias("around"))
    rows = words.select("id", "digest", F.size("words").cast("long").alias("n_words"), F.explode(F.concat(F.array(own), near)).alias("c")).select("id", "digest", "n_words", "c.*")
    small = windows.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(prefixes.drop("n")), "word", "left") if small else salted_join(rows, prefixes, "word", "n", words_found["total"] or 0, "id", how="left")
    start, length = F.col("at") - F.col("place"), F.size("window")
    holds = (start >= 1) & (start + length - 1 <= F.col("n_words")) & (F.slice("around", F.greatest(start - F.col("since") + 1, F.lit(1)), length) == F.col("window"))
    joined = joined.where((F.col("at") == 0) | holds)
    hit = F.col("at") > 0
    return joined.groupBy("id", "digest", "n_words").agg(
        F.count(F.when(~hit, 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(hit, F.struct(start.alias("s"), length.alias("n"))))).alias("spans"),
        F.array_sort(F.collect_set(F.when(hit, F.col("item")))).alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """One row per row of docs: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words: A-Z in lower case, then runs of digits, letters and non-ASCII. A document word is hit if it lies in any
    occurrence of a window; n_items counts the items that have an occurring window, items_sha256 is the digest of
    their ids, sorted as strings and joined by commas. A null or empty text has no words; a null item id counts as
    "null"; repeated rows give repeated results, null ids are kept. An empty benchmark leaves all documents clean.
    """
    found = _found(docs, benchmark, id_col, text_col, item_id, item_text, size)
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit")), lambda a, x: F.struct(F.greatest(a["end"], x["s"] + x["n"]).alias("end"), (a["hit"] + F.greatest(F.lit(0), x["s"] + x["n"] - F.greatest(a["end"], x["s"]))).alias("hit")))["hit"]
    out = found.withColumn("n_hit", covered).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """docs without the rows in whose text an item's window occurs; rows are told apart by id and text."""
    found = _found(docs, benchmark, id_col, text_col, item_id, item_text, size)
    hit = found.where(F.size("spans") > 0).select(F.col("id").alias("hit_id"), F.col("digest").alias("hit_digest"))
    same = F.col(id_col).eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("hit_digest"))
    return docs.join(hit, same, "left_anti")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[pos:pos + n - 1], ' ') AS g FROM s),
sizes AS (SELECT DISTINCT n FROM win),
p AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n),
m AS (SELECT r, pos, p.n, item_id FROM (SELECT r, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS g FROM p) p JOIN win USING (g)),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS x FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
