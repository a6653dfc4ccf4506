"""Registered queries over the shared test tables, and their DuckDB twins.

Each query maps the reference's domain (an entity table with a per-entity
price series and a churn label) onto the given tables:

* entity + series: ``customer`` + ``orders`` (id ``o_custkey``, date
  ``o_orderdate``, tiebreak ``o_orderkey``, value ``o_totalprice``);
* several price columns: ``lineitem`` per supplier over ``l_shipdate``;
* skewed numerics: ``events.value``; categories: order status/priority;
* binary targets: ``labels`` joined to ``documents``.

Every query reads whole tables.  Float outputs are rounded on both sides so
the order-free value hash is stable across engines.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = tie_safe_rounding(sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def R(expr: str, digits: int = 6) -> str:
    """SQL twin of ``round_doubles``: a tiny offset moves exact ties off the rounding grid,
    so float noise cannot round the two engines differently."""
    return f"round(({expr}) + {10.0 ** -(digits + 4)!r}, {digits})"


def tie_safe_rounding(sql: str) -> str:
    """Rewrite every ``round(x, d)`` of an oracle string into ``R(x, d)``."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 5, -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = tie_safe_rounding(sql[j + 6:comma])
        digits = int(sql[comma + 1:k].strip())
        out.append(sql[i:j] + R(inner, digits))
        i = k + 1


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    overrides = overrides or {}
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = overrides.get(f.name, digits)
            cols[f.name] = F.round(F.col(f.name) + F.lit(10.0 ** -(d + 4)), d)
    return df.withColumns(cols) if cols else df


# import the query modules so their decorators register
from churnspark.plans import catalog_queries  # noqa: E402,F401
