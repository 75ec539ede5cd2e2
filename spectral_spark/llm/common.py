"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import bound_batches, shared_path  # noqa: F401

#: What separates words: ASCII that is neither digit nor lower-case letter (text is lower-cased first).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stash(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that df does not have: the given ones, with underscores put after them where they are taken."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def free_prefix(df: DataFrame, prefix: str = "__") -> str:
    """Underscores with which no column of df begins."""
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def salted_join(rows: DataFrame, table: DataFrame, key: str, count: str, total: int, salt_by: str, salts: int = 64, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with a table by a key, whose `count` says how many of the `total` rows hold that key.

    A key of over HOT_ROWS rows and over a ten-thousandth of all is hot; so at most ten thousand keys are, and they are
    broadcast. Rows of hot keys are spread over `salts` partitions by another column, and the table's hot rows are repeated.
    """
    hot = F.col(count) > max(HOT_ROWS, total // 10_000)
    keys = table.where(hot).select(key, F.lit(True).alias("__hot")).distinct()
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")).otherwise(0)
    left = rows.join(F.broadcast(keys), key, "left").withColumn("__salt", salt).drop("__hot")
    right = table.withColumn("__salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "__salt"], how).drop("__salt")


def gather(steps: Column, state: Column, step, emit, kind: str, block: int = 256) -> Column:
    """The arrays emit(state, x) of all x of an array, end to end; step(state, x) is the state of the next one.

    Arrays grow block by block, so that long ones do not take time with the square of their length.
    """
    none = F.array().cast(kind)
    pair = lambda a, out: F.struct(a.alias("state"), out.alias("out"))
    one = lambda a, x: pair(step(a["state"], x), F.concat(a["out"], emit(a["state"], x)))

    def run(all_steps: Column) -> Column:
        def many(a: Column, k: Column) -> Column:
            made = F.transform(F.array(F.aggregate(F.slice(all_steps, k, F.lit(block)), pair(a["state"], none), one)), lambda b: pair(b["state"], F.concat(a["out"], b["out"])))
            return made[0]

        return F.aggregate(F.sequence(F.lit(1), F.size(all_steps), F.lit(block)), pair(state, none), many)["out"]

    return F.transform(F.array(steps), lambda a: F.when(F.size(a) > 0, run(a)).otherwise(none))[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; the usual lower() serves where the text is ASCII throughout."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


# --- word shingles in numpy, over the bytes of many texts at once

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x41:0x5B] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[0x41:0x5B] += 32
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
#: Least rows of a key that joins spread over partitions.
HOT_ROWS = 1_000
#: Bytes of text that the kernels take at once.
PIECE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        a = np.full(max(n, PIECE + 1), base, np.uint64)
        a[0] = 1
        _powers[base] = np.cumprod(a, dtype=np.uint64)
    return _powers[base][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie end to end in data, and where each text's words begin."""
    n = len(data)
    word = _IS_WORD[data]
    first = np.zeros(n + 1, bool)
    first[:n] = word
    first[1:n] &= ~word[:-1]
    last = np.zeros(n + 1, bool)
    last[1:] = word
    last[1:n] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = word[inner]
    last[inner] = word[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLD[data] + np.uint64(1)) * _power(_P, n), out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * _power(_P_INV, n + 1)[begin])
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes; a text of fewer than size words, but not none, is one shingle."""
    hashes, at = word_hashes(data, offsets)
    m = max(0, len(hashes) - size + 1)
    rolled = np.zeros(m, np.uint64)
    for t in range(size):
        rolled = rolled * np.uint64(0x9FB21C651E98DF25) + hashes[t : t + m]
    rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for k in range(a, b):
                h = h * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + 1]
            out.append(mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_pieces(column):
    """Of an Arrow string column: (first row, bytes end to end, offsets) in pieces of about PIECE bytes; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if not len(chunk):
            continue
        _, where, body = chunk.buffers()
        offsets = np.frombuffer(where, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(chunk):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
            yield i, body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j
