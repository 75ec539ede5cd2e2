"""Queries by name, each with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query under its function's name; views names the adapters that the SQL starts from."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            body = sql.strip()
            heads = ", ".join(f"{v} AS ({VIEWS[v]})" for v in views.split())
            ORACLES[f.__name__] = body if not heads else f"WITH {heads}" + (f", {body[5:]}" if body[:5].upper() == "WITH " else f" {body}")
        return f

    return add


def solve_sql(source: str, out: str, n: int, keep: str, entry: Callable[[int, int], str] = lambda i, j: f"s{i + j}") -> str:
    """Tables that solve n normal equations: from source (keep, entries of the matrix, t0..) to out (keep, x0..). By default those of a polynomial, from sums of powers."""
    m = [[entry(i, j) for j in range(n)] + [f"t{i}"] for i in range(n)]
    steps = [f"{out}_0 AS (SELECT {keep}, " + ", ".join(f"{m[i][j]} AS m{i}_{j}" for i in range(n) for j in range(n + 1)) + f" FROM {source})"]
    for p in range(n):
        row = lambda i, j, p=p: f"m{i}_{j} / m{p}_{p}" if i == p else f"m{i}_{j} - m{i}_{p} * m{p}_{j} / m{p}_{p}"
        steps.append(f"{out}_{p + 1} AS (SELECT {keep}, " + ", ".join(f"{row(i, j)} AS m{i}_{j}" for i in range(n) for j in range(n + 1)) + f" FROM {out}_{p})")
    steps.append(f"{out} AS (SELECT {keep}, " + ", ".join(f"m{i}_{n} AS x{i}" for i in range(n)) + f" FROM {out}_{n})")
    return ", ".join(steps)
