"""Registry of named queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroom.constants import AS_OF_CAMPAIGN, AS_OF_INVENTORY, AS_OF_REVIEWS, AS_OF_SALES
from tallyroom.sources.sample import SAMPLE_SQL
from tallyroom.sources.tables import SampleTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CHECK_VIEWS: dict[str, str] = {}  # name -> SQL, usable by name in any check

S = f"DATE '{AS_OF_SALES}'"
I = f"DATE '{AS_OF_INVENTORY}'"  # noqa: E741
C = f"DATE '{AS_OF_CAMPAIGN}'"
R = f"DATE '{AS_OF_REVIEWS}'"


def add(key: str, fn: Callable[[SampleTables], DataFrame], sql: str | None = None) -> None:
    if key in QUERIES:
        raise ValueError(f"{key} is registered twice")
    QUERIES[key] = lambda spark, folder: fn(SampleTables(spark, folder))
    if sql is not None:
        ORACLES[key] = sql


def check_view(name: str, sql: str) -> None:
    CHECK_VIEWS[name] = sql


def with_views(sql: str) -> str:
    """Prefix the definitions a check refers to, in dependency order."""
    defs = {**{k: re.sub(r"\{(\w+)\}", r"\1", v) for k, v in SAMPLE_SQL.items()}, **CHECK_VIEWS}
    order: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_][a-z0-9_]*\b", text)):
            if word in defs and word not in order and word not in path:
                visit(defs[word], path + (word,))
                order.append(word)

    visit(sql, ())
    if not order:
        return sql
    ctes = ",\n".join(f"{name} AS ({defs[name]})" for name in order)
    return f"WITH {ctes}\nSELECT * FROM ({sql}) AS checked"


def half_up(expr: str, digits: int) -> str:
    """Round a double half up on its decimal form, the tie rule Spark's
    ``round`` follows; DuckDB's own ``round`` works on the binary value."""
    return f"round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,16)), {digits})"


def rounded(expr: str, digits: int) -> str:
    return f"CAST({half_up(expr, digits)} AS DOUBLE)"


def num_text(expr: str, digits: int) -> str:
    """DuckDB text of a rounded number without trailing zeros."""
    text = f"CAST(CAST({half_up(expr, digits)} AS DECIMAL(30,{digits})) AS VARCHAR)"
    if digits == 0:
        return text
    return f"regexp_replace(regexp_replace({text}, '0+$', ''), '\\.$', '')"


def whole_text(expr: str) -> str:
    return f"CAST(CAST({half_up(expr, 0)} AS BIGINT) AS VARCHAR)"
