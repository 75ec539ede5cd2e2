"""Mixing sources to target weights: budgets go down a domain-language-source tree, then each leaf's tokens are taken from seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_prefix, stash

LEVELS = ("domain", "lang", "source")
#: Documents of a leaf that are ordered together, about.
BUCKET_DOCS = 1_000


def count_tokens(text: Column) -> Column:
    """Runs of characters that are not blank, tab or line end."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\r]+")).cast("long")


def share_out(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """From nodes (parent columns, key, weight, cap, budget of the parent): each node's share of its parent's budget, as `given`.

    Shares are in proportion to weights; what a node cannot use (its cap is short) goes to its siblings in proportion to
    theirs, until all are at their caps. Whole tokens: the few that rounding leaves go to the first siblings by key.
    A parent never gets more than its children's caps, so a shortage leaves a parent only once no child has room.
    """
    by = Window.partitionBy(*[F.col(p) for p in parent], F.lit(0))
    rank = by.orderBy(F.col("cap") / F.col("weight"), key)
    out = nodes.where("weight > 0")
    out = out.withColumn("rest_w", F.sum("weight").over(rank.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(18,0)"))
    out = out.withColumn("used", (F.sum("cap").over(rank.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")).cast("decimal(20,0)"))
    out = out.withColumn("full", F.expr("cast(cap as decimal(20,0)) * rest_w <= (budget - used) * cast(weight as decimal(18,0))"))
    out = out.withColumn("left_b", (F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(by)).cast("decimal(20,0)")).withColumn("left_w", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(by).cast("decimal(18,0)"))
    out = out.withColumn("given", F.expr("case when full then cap else cast(left_b as decimal(20,0)) * cast(weight as decimal(18,0)) div left_w end"))
    spare = F.col("left_b") - F.sum(F.when(~F.col("full"), F.col("given")).otherwise(0)).over(by)
    turn = F.row_number().over(Window.partitionBy(*[F.col(p) for p in parent], "full").orderBy(key))
    out = out.withColumn("given", (F.col("given") + F.when(~F.col("full") & (turn <= spare), 1).otherwise(0)).cast("long"))
    return out.drop("rest_w", "used", "full", "left_b", "left_w")


def budgets(leaves: DataFrame, weights: dict[str, int], total: Column, epochs: int) -> DataFrame:
    """Leaf budgets from (domain, lang, source, supply): a column `given` more. weights: by path, as "web", "web/en", "web/en/src1"; 1 for others.

    A leaf counts in the caps of the nodes above it only if its own weight and all of theirs are positive.
    """
    table = F.create_map(*[F.lit(x) for p in sorted(weights.items()) for x in p]) if weights else F.create_map().cast("map<string,int>")
    weight = lambda path: F.coalesce(F.try_element_at(table, F.concat_ws("/", *path)), F.lit(1)).cast("long")
    usable = F.least(*[weight(LEVELS[: k + 1]) for k in range(len(LEVELS))]) > 0
    caps = leaves.withColumn("cap", F.when(usable, F.col("supply") * epochs).otherwise(0))
    given = None
    for k, key in enumerate(LEVELS):
        path, parent = list(LEVELS[: k + 1]), list(LEVELS[:k])
        nodes = caps.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", weight(path))
        if given is None:
            nodes = nodes.withColumn("budget", F.least(total.cast("long"), F.sum(F.when(F.col("weight") > 0, F.col("cap")).otherwise(0)).over(Window.partitionBy(F.lit(0)))))
        else:
            nodes = nodes.join(given.select(*parent, F.col("given").alias("budget")), parent)
        given = stash(share_out(nodes, parent, key).select(*path, "given"), "given")  # a row for each node; the next level reads it
    return leaves.join(given.select(*LEVELS, "given"), list(LEVELS), "left").withColumn("given", F.coalesce("given", F.lit(0)))


def mix_sources(docs: DataFrame, domain: Column, weights: dict[str, int], share: tuple[int, int] = (1, 1), total: int | None = None, epochs: int = 4, seed: str = "mix-0", id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", tokens: Column | None = None) -> DataFrame:
    """One row for each document and epoch in which tokens of it are taken: the columns of docs, and mix_domain, mix_epoch, mix_tokens, mix_take.

    The budget is total, or share (numerator, denominator) of all tokens. Leaves give at most `epochs` times what they
    hold. A leaf's tokens come from whole epochs and then from a prefix of one more, whose order is drawn from the seed:
    all documents that fit, and of the next one its first mix_take tokens.

    Null domains, languages and sources count as "". Documents without tokens (null or empty texts) are never taken.
    The order is drawn from the seed, the id and the digest of the text, so rows without an id are spread like others. Ties
    go by id, number of tokens and digest; repeated rows are taken each for itself.
    Columns with the four names are replaced, all others pass.
    """
    count = count_tokens(F.col(text_col)) if tokens is None else tokens
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    p = free_prefix(docs)
    base = docs.withColumn("mix_tokens", count.cast("long")).withColumn("mix_domain", text(domain))
    base = base.withColumn(f"{p}lang", text(F.col(lang_col))).withColumn(f"{p}source", text(F.col(source_col)))
    names = [F.col("mix_domain").alias("domain"), F.col(f"{p}lang").alias("lang"), F.col(f"{p}source").alias("source")]
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    base = base.withColumn(f"{p}digest", digest)
    small = base.select(F.col(id_col).alias("id"), "mix_tokens", f"{p}digest", *names).where("mix_tokens > 0")
    leaves = stash(small.groupBy(*LEVELS).agg(F.sum("mix_tokens").alias("supply"), F.count(F.lit(1)).alias("docs")), "leaves")
    goal = F.lit(total).cast("long")
    if total is None:
        whole = leaves.agg(F.sum("supply").alias("s")).first()["s"] or 0
        goal = F.lit(whole * int(share[0]) // int(share[1])).cast("long")
    plan = budgets(leaves, weights, goal, epochs).withColumn("whole", F.expr("given div supply")).withColumn("rest", F.expr("given % supply"))
    plan = stash(plan.withColumn("buckets", F.ceil(F.col("docs") / BUCKET_DOCS)), "plan")
    plan = plan.withColumnsRenamed({c: f"{p}{c}" for c in ("whole", "rest", "buckets")})

    def drawn(df: DataFrame, key: str) -> DataFrame:
        h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), (F.col(f"{p}whole") + 1).cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("")), f"{p}digest")), 1, 15), 16, 10).cast("long")
        return df.withColumn(f"{p}h", h).withColumn(f"{p}bucket", F.pmod(f"{p}h", f"{p}buckets"))

    filled = drawn(small.join(plan.where(f"{p}rest > 0"), list(LEVELS)), "id").groupBy(*LEVELS, f"{p}bucket", f"{p}rest").agg(F.sum("mix_tokens").alias(f"{p}sum"))
    before = F.sum(f"{p}sum").over(Window.partitionBy(*LEVELS).orderBy(f"{p}bucket")) - F.col(f"{p}sum")
    filled = stash(filled.withColumn(f"{p}before", before).where(f"{p}before < {p}rest").withColumn(f"{p}cut", F.col(f"{p}before") + F.col(f"{p}sum") > F.col(f"{p}rest")), "buckets")

    leaf = dict(zip(LEVELS, ("mix_domain", f"{p}lang", f"{p}source")))
    own = plan.select(*[F.col(c).alias(f"{p}p_{c}") for c in LEVELS], f"{p}whole", f"{p}rest", f"{p}buckets")
    rows = drawn(base.where("mix_tokens > 0").join(own, [F.col(v) == F.col(f"{p}p_{c}") for c, v in leaf.items()]), id_col)
    first = filled.select(*[F.col(c).alias(f"{p}b_{c}") for c in LEVELS], F.col(f"{p}bucket").alias(f"{p}b_bucket"), f"{p}before", f"{p}cut")
    same = [F.col(v) == F.col(f"{p}b_{c}") for c, v in leaf.items()] + [F.col(f"{p}bucket") == F.col(f"{p}b_bucket")]
    keep = [*[c for c in docs.columns if c not in ("mix_domain", "mix_epoch", "mix_tokens", "mix_take")], "mix_domain"]
    epoch = F.col("mix_epoch").cast("long").alias("mix_epoch")
    full = rows.where(f"{p}whole > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{p}whole")))).select(*keep, epoch, "mix_tokens", F.col("mix_tokens").alias("mix_take"))
    part = rows.where(f"{p}rest > 0").join(first, same).withColumn("mix_epoch", F.col(f"{p}whole") + 1)
    fits = part.where(f"not {p}cut").select(*keep, epoch, "mix_tokens", F.col("mix_tokens").alias("mix_take"))
    order = Window.partitionBy(*leaf.values(), f"{p}bucket").orderBy(f"{p}h", id_col, "mix_tokens", f"{p}digest").rowsBetween(Window.unboundedPreceding, 0)
    cut = part.where(f"{p}cut").withColumn(f"{p}past", F.col(f"{p}before") + F.sum("mix_tokens").over(order) - F.col("mix_tokens")).where(f"{p}past < {p}rest")
    cut = cut.select(*keep, epoch, "mix_tokens", F.least(F.col("mix_tokens"), F.col(f"{p}rest") - F.col(f"{p}past")).alias("mix_take"))
    return full.unionByName(fits).unionByName(cut)


def cut_to_tokens(text: Column, take: Column, tokens: Column) -> Column:
    """The first `take` tokens of a text, joined by blanks; the text itself where that is all of them."""
    return F.when(take >= tokens, text).otherwise(F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[^ \t\n\r]+"), F.lit(0)), F.lit(1), take.cast("int")), " "))


#: The query's tree: sources of each domain, and weights by path.
DOMAINS = {"web": range(0, 8), "reference": range(8, 14), "forum": range(14, 20)}
WEIGHTS = {"web": 5, "reference": 3, "forum": 2, "web/en": 6, "web/de": 2, "web/es": 1, "web/fr": 1, "reference/es": 4, "web/en/src1": 3, "forum/en/src14": 5, "forum/en/src15": 0}
SHARE = (8, 10)


def domain_of(source: Column) -> Column:
    out = F.lit("other")
    for name, numbers in DOMAINS.items():
        out = F.when(source.isin([f"src{k}" for k in numbers]), name).otherwise(out)
    return out


def _level(k: int) -> str:
    """SQL of one level of the tree: tables n<k> (nodes) and g<k> (given)."""
    path, parent = LEVELS[: k + 1], LEVELS[:k]
    cols, by = ", ".join(path), ", ".join(["1", *parent])
    weight = "CASE " + " ".join(f"WHEN {' || chr(47) || '.join(path)} = '{p}' THEN {w}" for p, w in WEIGHTS.items() if p.count("/") == k) + " ELSE 1 END" if any(p.count("/") == k for p in WEIGHTS) else "1"
    source = "FROM caps" if not k else f"FROM caps JOIN (SELECT {', '.join(parent)}, given AS budget FROM g{k - 1}) USING ({', '.join(parent)})"
    budget = "0::HUGEINT" if not k else "any_value(budget)::HUGEINT"
    first = f"n{k} AS (SELECT {cols}, sum(cap)::HUGEINT AS cap, ({weight})::HUGEINT AS weight, {budget} AS budget {source} GROUP BY {cols}),"
    if not k:
        first += f" r{k} AS (SELECT {cols}, cap, weight, least((SELECT sum(supply)::HUGEINT * {SHARE[0]} // {SHARE[1]} FROM leaves), sum(cap) OVER ()) AS budget FROM n{k} WHERE weight > 0),"
    else:
        first += f" r{k} AS (SELECT * FROM n{k} WHERE weight > 0),"
    return first + f"""
a{k} AS (SELECT *, sum(weight) OVER (PARTITION BY {by} ORDER BY cap::DOUBLE / weight::DOUBLE, {path[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w, sum(cap) OVER (PARTITION BY {by} ORDER BY cap::DOUBLE / weight::DOUBLE, {path[-1]} ROWS UNBOUNDED PRECEDING) - cap AS used FROM r{k}),
b{k} AS (SELECT *, cap * rest_w <= (budget - used) * weight AS fl FROM a{k}),
c{k} AS (SELECT *, budget - sum(CASE WHEN fl THEN cap ELSE 0 END) OVER (PARTITION BY {by}) AS left_b, sum(CASE WHEN fl THEN 0 ELSE weight END) OVER (PARTITION BY {by}) AS left_w FROM b{k}),
d{k} AS (SELECT *, CASE WHEN fl THEN cap ELSE left_b * weight // left_w END AS part, row_number() OVER (PARTITION BY {by}, fl ORDER BY {path[-1]}) AS turn FROM c{k}),
g{k} AS (SELECT {cols}, part + CASE WHEN NOT fl AND turn <= left_b - sum(CASE WHEN fl THEN 0 ELSE part END) OVER (PARTITION BY {by}) THEN 1 ELSE 0 END AS given FROM d{k}),"""


def _domain_sql() -> str:
    return "CASE " + " ".join("WHEN source IN (" + ", ".join(f"'src{k}'" for k in numbers) + f") THEN '{name}'" for name, numbers in DOMAINS.items()) + " ELSE 'other' END"


ORACLE = f"""
WITH base AS (SELECT doc_id, {_domain_sql()} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+'))::BIGINT AS tokens, md5(coalesce(text, '')) AS sum FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS supply, count(*) AS docs FROM base WHERE tokens > 0 GROUP BY ALL),
caps AS (SELECT *, supply * 4 AS cap FROM leaves),
{_level(0)}
{_level(1)}
{_level(2)}
plan AS (SELECT l.*, (given // supply)::BIGINT AS whole, (given % supply)::BIGINT AS rest, ceil(docs / {BUCKET_DOCS}.0)::BIGINT AS buckets FROM leaves l JOIN g2 USING (domain, lang, source)),
h AS (SELECT b.*, whole, rest, buckets, ('0x' || substr(md5('mix-0|' || (whole + 1)::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '') || '|' || sum), 1, 15))::BIGINT AS h FROM base b JOIN plan USING (domain, lang, source) WHERE tokens > 0),
o AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h % buckets, h, doc_id, tokens, sum ROWS UNBOUNDED PRECEDING) - tokens AS past FROM h),
u AS (SELECT doc_id, domain AS mix_domain, unnest(range(1, whole + 1)) AS mix_epoch, tokens AS mix_tokens, tokens AS mix_take FROM o WHERE whole > 0
UNION ALL SELECT doc_id, domain, whole + 1, tokens, least(tokens, rest - past) FROM o WHERE past < rest)
SELECT doc_id, mix_domain, mix_epoch::BIGINT AS mix_epoch, mix_tokens::BIGINT AS mix_tokens, mix_take::BIGINT AS mix_take FROM u
"""
