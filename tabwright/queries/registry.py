"""Registration of queries together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwright.queries.tables import LISTINGS_SQL, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` under its own name, with its checking SQL if any.

    SQL that starts with a bare ``, cte AS`` list or ``SELECT`` may read ``listings``.
    """
    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            text = sql.strip()
            ORACLES[name] = f"WITH listings AS ({LISTINGS_SQL}) {text}" if "listings" in text else text
        return build

    return register


# --- pieces of checking SQL -------------------------------------------------------------

def rnd(expr: str, digits: int = 4) -> str:
    """Round as Spark does: half up on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 17)), {digits}) AS DOUBLE)"


def skew(x: str) -> str:
    """Population skewness from the sample-adjusted one."""
    return f"(skewness({x}) * (count({x}) - 2) / sqrt(CAST(count({x}) AS DOUBLE) * (count({x}) - 1)))"


def pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) * 100e0 / {whole})"


def case(*arms: tuple[str, str], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in arms) + f" ELSE '{otherwise}' END"


def share_case(p: str, *names: str) -> str:
    zero, few, some, many, most = names
    return case((f"{p} = 0", zero), (f"{p} < 5", few), (f"{p} < 20", some), (f"{p} < 50", many), otherwise=most)


def blank(c: str) -> str:
    return f"(trim(coalesce(CAST({c} AS VARCHAR), '')) = '')"


def union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)
