"""Secret scans in DataFrame operations: three base patterns, and random-looking strings by two character Markov models."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, gather

#: Base kinds in the order in which equal starts are listed: pattern, group that must be long enough, its least length.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # a run of 32 or more is what [0-9a-f]+ finds and the least length keeps
)
MODEL_KIND = "random"
#: What the models judge: runs of token characters outside the base spans. A random string has LEAST of them or more.
LEAST = 12
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Characters by number, from 1; 63 stands for all others, 0 for the start of a token.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
STATES = 64
#: Pairs' worth of single characters' frequencies in each model.
BACK_OFF = 8
#: Words that ordinary identifiers, paths and addresses are made of.
IDENTIFIER_WORDS = (
    "account", "action", "address", "application", "archive", "array", "background", "buffer", "button", "calendar", "callback", "category", "channel", "client", "collection", "column", "command", "comment", "component", "config",
    "connection", "container", "content", "context", "controller", "counter", "customer", "database", "default", "description", "directory", "document", "download", "element", "email", "enable", "environment", "event", "example", "exception",
    "expected", "extension", "factory", "feature", "field", "filename", "filter", "folder", "format", "function", "gallery", "generate", "group", "handler", "header", "height", "history", "identifier", "image", "implementation",
    "index", "initial", "input", "instance", "interface", "internal", "invoice", "iterator", "keyword", "language", "length", "library", "listener", "location", "manager", "maximum", "member", "memory", "message", "method",
    "minimum", "module", "monitor", "network", "number", "object", "operation", "option", "order", "output", "package", "parameter", "parent", "partition", "payment", "performance", "permission", "picture", "position", "previous",
    "process", "product", "profile", "project", "property", "protocol", "provider", "publisher", "quantity", "query", "receiver", "record", "reference", "register", "release", "remote", "report", "request", "resource", "response",
    "result", "schedule", "schema", "section", "selector", "sequence", "server", "service", "session", "setting", "signature", "source", "standard", "status", "storage", "string", "structure", "subject", "summary", "support",
    "system", "table", "target", "template", "thread", "timestamp", "title", "transaction", "transfer", "update", "upload", "user", "utility", "validate", "value", "variable", "version", "widget", "window", "workspace",
)
SPAN = "array<struct<start:int,order:int,stop:int,kind:string>>"


def _matches(text: Column, pattern: str, group: int, emit) -> Column:
    """Spans of all matches: emit(where a match begins, the match, its group) gives an array of them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("match"), judged.alias("judged"))  # one gap more than matches
    begin = lambda at, x: at + F.char_length(x["gap"])
    end = lambda at, x: begin(at, x) + F.coalesce(F.char_length(x["match"]), F.lit(0))
    walk = gather(steps, F.lit(0), end, lambda at, x: emit(begin(at, x), x["match"], x["judged"]), SPAN)
    return F.when(F.regexp(text, F.lit(pattern)), walk).otherwise(F.array().cast(SPAN))


def _span(start: Column, order: int, stop: Column, kind: str) -> Column:
    return F.struct(start.alias("start"), F.lit(order).alias("order"), stop.alias("stop"), F.lit(kind).alias("kind"))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind as listed: struct(start, order, stop, kind) in code points; matches that fall short are dropped."""

    def found(order: int, kind: str, pattern: str, group: int, least: int) -> Column:
        long = lambda at, match, judged: F.when(F.char_length(judged) >= least, F.array(_span(at, order, at + F.char_length(match), kind))).otherwise(F.array().cast(SPAN))
        return _matches(text, pattern, group, long)

    return F.array_sort(F.concat(*(found(k, *rule) for k, rule in enumerate(BASE))))


def code(char: Column) -> Column:
    """The number of a character."""
    return F.coalesce(F.nullif(F.position(char, F.lit(ALPHABET)), F.lit(0)), F.lit(63))


def drawn_strings(spark: SparkSession, number: int = 3_000, seed: str = "drawn-0") -> DataFrame:
    """(token, label 1): random strings of 28 to 48 characters from digests of numbers, in each of five alphabets: base64, base62, base32, lower-case letters with digits, hexadecimal."""
    sha = F.sha2(F.concat_ws("|", F.lit(seed), F.col("id").cast("string")), 256)
    wide = F.base64(F.concat(F.unhex(sha), F.unhex(F.sha2(sha, 256))))
    thirty = F.concat(*[F.lpad(F.conv(F.substring(sha, k, 10), 16, 32), 8, "0") for k in range(1, 60, 10)])
    base32 = F.translate(F.upper(thirty), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    thirty_six = F.lower(F.concat(*[F.lpad(F.conv(F.substring(sha, k, 12), 16, 36), 9, "0") for k in range(1, 50, 12)]))
    kinds = F.array(F.substring(wide, 1, 43), F.substring(F.regexp_replace(wide, "[+/=]", ""), 1, 36), base32, F.substring(thirty_six, 2, 36), F.substring(sha, 1, 40))
    return spark.range(number).select(F.explode(kinds).alias("token"), F.lit(1).alias("label"))


def drawn_identifiers(spark: SparkSession, number: int = 12_000, seed: str = "names-0", words: tuple[str, ...] = IDENTIFIER_WORDS) -> DataFrame:
    """(token, label 0): two to four words as snake_case, camelCase, kebab-case, UPPER_CASE, paths, or with a number of up to four digits at the end."""
    draw = lambda name, n: F.pmod(F.xxhash64(F.lit(f"{seed}|{name}"), "id"), F.lit(n)).cast("int")
    table = F.array(*map(F.lit, words))
    parts = F.slice(F.array(*[F.get(table, draw(f"word{k}", len(words))) for k in range(4)]), F.lit(1), draw("size", 3) + 2)
    camel = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.lit(3)), F.initcap), ""))
    forms = [F.array_join(parts, "_"), camel, F.array_join(parts, "-"), F.upper(F.array_join(parts, "_")), F.array_join(parts, "/"), F.concat(F.array_join(parts, "_"), F.lit("_"), draw("number", 10_000).cast("string"))]
    return spark.range(number).select(F.element_at(F.array(*forms), draw("form", len(forms)) + 1).alias("token"), F.lit(0).alias("label"))


def labelled_tokens(docs: DataFrame, text_col: str = "text", sample_docs: int = 20_000) -> DataFrame:
    """(token, label): 0 ordinary words of eight characters or more, each once, and drawn identifiers; 1 drawn random strings.

    Words come from all documents where there are at most sample_docs, and else from a sample of about so many by their
    text's hash; what base patterns find is no word. Null and empty texts have none, so an empty table leaves what is drawn.
    """
    n = docs.count()
    base = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if n > sample_docs:
        base = base.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * sample_docs / n))
    rest = reduce(lambda t, b: F.regexp_replace(t, b[1], " "), BASE, F.col("text"))
    words = base.select(F.explode(F.array_distinct(F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9_+/=-]{8,}"), F.lit(0)))).alias("token")).distinct()
    spark = docs.sparkSession
    return words.select("token", F.lit(0).alias("label")).unionByName(drawn_identifiers(spark)).unionByName(drawn_strings(spark))


def train_models(samples: DataFrame) -> list[int]:
    """From (token, label): 64 x 64 log-likelihood ratios, in thousandths, of a next character in a random string over an ordinary identifier.

    Each model falls back on how often single characters occur where it has seen few pairs. The random one gives half
    its weight to equal chances, as keys and passwords are drawn from alphabets that a sample need not show. Rows with a
    null token or label count for nothing; without samples all ratios are about 0.
    """
    chars = F.transform(F.split("token", ""), code)
    pairs = F.filter(F.zip_with(F.concat(F.array(F.lit(0)), chars), chars, lambda a, b: a * STATES + b), lambda p: p.isNotNull())
    pairs = samples.where(F.col("label").isin(0, 1)).select("label", F.explode(pairs).alias("pair"))
    counts = {0: {}, 1: {}}
    for r in pairs.groupBy("label", "pair").count().collect():  # at most 2 x 4096 rows
        counts[r["label"]][r["pair"]] = r["count"]
    single = {k: [sum(counts[k].get(a * STATES + b, 0) for a in range(STATES)) + 1 for b in range(STATES)] for k in (0, 1)}
    out = []
    for a in range(STATES):
        totals = [sum(counts[k].get(a * STATES + b, 0) for b in range(STATES)) for k in (0, 1)]
        for b in range(STATES):
            known = [(counts[k].get(a * STATES + b, 0) + BACK_OFF * single[k][b] / sum(single[k])) / (totals[k] + BACK_OFF) for k in (0, 1)]
            out.append(round(1000 * math.log((0.5 * known[1] + 0.5 / STATES) / known[0])))
    return out


def random_stretches(token: Column, model: list[int], threshold: float, evidence: float) -> Column:
    """Where a run of token characters looks random: array of struct(start, stop) in code points.

    A stretch is where the sum of the characters' log-likelihood ratios rises from 0 to its peak before it falls to 0 or
    by `evidence`. It counts if its peak reaches `evidence` and its mean `threshold`, and is then widened to the
    separators (+ / _ = -) or ends around it.
    """
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")
    pair = "array<struct<start:int,stop:int>>"
    bar = int(1000 * evidence)
    none = F.array().cast(pair)

    def stretches(scores: Column) -> Column:
        new = lambda a, w: a["sum"] + w
        shut = lambda a, w: (new(a, w) <= 0) | (new(a, w) < a["peak"] - bar)
        good = lambda a: (a["peak"] >= bar) & (a["peak"] >= (a["stop"] - a["start"]) * (1000 * threshold))
        done = lambda a: F.when(good(a), F.concat(a["out"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop"))))).otherwise(a["out"])
        state = lambda at, total, peak, start, stop, out: F.struct(at.alias("at"), total.alias("sum"), peak.alias("peak"), start.alias("start"), stop.alias("stop"), out.alias("out"))

        def step(a: Column, w: Column) -> Column:
            at = a["at"] + 1
            higher = new(a, w) > a["peak"]
            return F.when(shut(a, w), state(at, F.lit(0), F.lit(0), at, at, done(a))).otherwise(state(at, new(a, w), F.when(higher, new(a, w)).otherwise(a["peak"]), a["start"], F.when(higher, at).otherwise(a["stop"]), a["out"]))

        return done(F.aggregate(scores, state(*[F.lit(0)] * 5, none), step))

    def widened(s: Column) -> Column:
        before = F.char_length(F.regexp_extract(F.substring(token, F.lit(1), s["start"]), "[A-Za-z0-9]*$", 0))
        after = F.char_length(F.regexp_extract(F.substring(token, s["stop"] + 1, F.char_length(token)), "^[A-Za-z0-9]*=*", 0))
        return F.struct((s["start"] - before).alias("start"), (s["stop"] + after).alias("stop"))

    codes = F.transform(F.split(token, ""), code)
    scores = F.zip_with(F.concat(F.array(F.lit(0)), codes), codes, lambda a, b: F.get(table, a * STATES + b))
    likely = lambda w: F.aggregate(w, F.lit(0), lambda a, x: a + F.greatest(x, F.lit(0))) >= bar
    # zip_with gives a null after the last character
    walked = F.transform(F.array(F.filter(scores, lambda w: w.isNotNull())), lambda w: F.when(likely(w), stretches(w)).otherwise(none))[0]
    return F.array_distinct(F.transform(walked, widened))


def _without(text: Column, spans: Column, fill) -> Column:
    """A text with its spans (sorted by start) replaced; fill gives what stands for the characters of a span that no earlier one covers, or for those that begin a new block."""

    def piece(upto: Column, s: Column) -> Column:
        apart = s["start"] > upto
        return F.array(F.concat(F.when(apart, F.substring(text, upto + 1, s["start"] - upto)).otherwise(""), fill(upto, s)))

    pieces = gather(spans, F.lit(0), lambda upto, s: F.greatest(upto, s["stop"]), piece, "array<string>")
    return F.concat(F.array_join(pieces, ""), F.substring(text, F.array_max(F.transform(spans, lambda s: s["stop"])) + 1, F.char_length(text)))


def _scanned(docs: DataFrame, model: list[int], text_col: str, threshold: float, evidence: float, base: str, every: str) -> DataFrame:
    text, free = free_names(docs, "text_", "free_")
    out = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = out.withColumn(base, base_spans(F.col(text)))
    blank = lambda upto, s: F.repeat(F.lit(" "), F.greatest(F.lit(0), s["stop"] - F.greatest(upto, s["start"])))
    out = out.withColumn(free, F.when(F.size(base) > 0, _without(F.col(text), F.col(base), blank)).otherwise(F.col(text)))

    def judged(at: Column, match: Column, _) -> Column:
        found = F.transform(random_stretches(match, model, threshold, evidence), lambda s: _span(at + s["start"], len(BASE), at + s["stop"], MODEL_KIND))
        return F.when(match.isNotNull(), found).otherwise(F.array().cast(SPAN))

    return out.withColumn(every, F.array_sort(F.concat(F.col(base), _matches(F.col(free), CANDIDATE, 0, judged)))).drop(text, free)


def find_secrets(docs: DataFrame, model: list[int], text_col: str = "text", threshold: float = 0.75, evidence: float = 16.0) -> DataFrame:
    """docs with two columns more: base_spans and all_spans, arrays of struct(start, order, stop, kind).

    Positions are code points, the end exclusive. Base patterns match from the left without overlap, each kind by
    itself; matches that are too short are dropped. Of what base spans leave, each run of LEAST or more letters, digits
    and + / _ = - is judged by the models (random_stretches), so the rest of a longer key beside a base span is judged
    too. A null text counts as empty and has no spans. Nothing is shuffled, so repeated rows, null ids and any other
    column pass as they are; columns of docs that have the two names are replaced.
    """
    return _scanned(docs.drop("base_spans", "all_spans"), model, text_col, threshold, evidence, "base_spans", "all_spans")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, model: list[int], text_col: str = "text", mask: str = "[SECRET]", threshold: float = 0.75, evidence: float = 16.0) -> DataFrame:
    """docs with every span of its text replaced by a mask; spans that overlap or touch become one.

    Null texts stay null; all other columns, whatever their names, and repeated rows pass as they are.
    """
    base, every = free_names(docs, "base_spans", "all_spans")
    found = _scanned(docs, model, text_col, threshold, evidence, base, every)
    masked = lambda upto, s: F.when((s["start"] > upto) | (upto == 0), mask).otherwise("")  # noqa: E731  the first block may begin at 0
    new = F.when(F.size(every) > 0, _without(F.col(text_col).cast("string"), F.col(every), masked)).otherwise(F.col(text_col).cast("string"))
    return found.withColumn(text_col, new).select(*docs.columns)
