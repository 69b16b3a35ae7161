"""Registry of named queries: Spark builder + DuckDB oracle SQL.

``queries()`` / ``oracle_sql()`` in ``__spark_entry__`` are views of this
registry.  Each builder receives a ``Tables`` object for one scale directory
and returns a lazy DataFrame.  Float outputs are rounded to 6 digits on both
sides so summation order cannot change the value hash.
"""

from __future__ import annotations

from dataclasses import dataclass
from importlib import import_module
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.sources.fixtures import Tables


@dataclass
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}
_TABLES: dict[tuple, Tables] = {}


def register(name: str, covers: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, unify_round6(sql) if sql else sql, covers)
        return fn
    return deco


def round6(c):
    """6-digit rounding that Spark and DuckDB evaluate identically (see
    ``mappers.round_to``)."""
    from stakeflow.functions.mappers import round_to
    return round_to(c, 6)


def unify_round6(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` of an oracle query into the same
    ``round(expr * 10^d) / 10^d`` form the Spark side uses (``round_to``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        for k in range(j + 5, len(sql)):
            if sql[k] in "([":
                depth += 1
            elif sql[k] in ")]":
                depth -= 1
                if depth == 0:
                    break
        inner = sql[j + 6:k]
        d, last = 0, -1
        for m, ch in enumerate(inner):
            if ch in "([":
                d += 1
            elif ch in ")]":
                d -= 1
            elif ch == "," and d == 0:
                last = m
        out.append(sql[i:j])
        digits = inner[last + 1:].strip() if last >= 0 else ""
        if digits.isdigit():
            scale = f"1e{int(digits)}"
            out.append(f"(round(({unify_round6(inner[:last])}) * {scale}) / {scale})")
        else:
            out.append("round(" + unify_round6(inner) + ")")
        i = k + 1


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]


def _round_to(c, digits):
    from stakeflow.functions.mappers import round_to
    return round_to(c, digits)


def rounded(df: DataFrame, digits: int = 6, exclude=()) -> DataFrame:
    """Round every double/float column (hash-stable comparisons).  Columns in
    ``exclude`` are already bit-identical across engines and stay unrounded
    (rounding an exact half would differ between engines)."""
    return df.select(*[
        (round6(F.col(c)) if digits == 6 else _round_to(F.col(c), digits)).alias(c)
        if t in ("double", "float") and c not in exclude else F.col(c)
        for c, t in df.dtypes
    ])


def load_all() -> dict[str, Query]:
    """Import the query modules, which fill the registry."""
    for mod in ("core", "dataset", "scoring", "analytics", "train", "explain", "sinks", "more"):
        import_module(f"stakeflow.plans.queries_{mod}")
    return REGISTRY
