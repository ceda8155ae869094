"""Declarative gather: a spec of reads, joins, links and post steps becomes one
DataFrame plan. Reads are never cut before they are rolled up; ``limit`` is a
presentation step only."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import days_until
from tallyroom.operators.snapshots import latest_snapshot

AGGREGATES = {
    "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "count": F.count,
    "first": F.min,  # "any one" made repeatable
    "count_distinct": F.count_distinct,
}


def condition(spec) -> Column:
    """``{field, op, value | ref}``, ``{all: [...]}`` or ``{any: [...]}``."""
    if isinstance(spec, list):
        spec = {"all": spec}
    if "all" in spec or "any" in spec:
        key = "all" if "all" in spec else "any"
        out = condition(spec[key][0])
        for part in spec[key][1:]:
            out = (out & condition(part)) if key == "all" else (out | condition(part))
        return out
    left = F.col(spec["field"])
    op = spec["op"]
    if op in ("eq", "ne") and "ref" not in spec and spec["value"] is None:
        return left.isNull() if op == "eq" else left.isNotNull()
    right = F.col(spec["ref"]) if "ref" in spec else spec["value"]
    if op == "in":
        return left.isin(list(right))
    if op == "contains":
        return left.contains(right)
    return {"eq": lambda: left == right, "ne": lambda: left != right, "lt": lambda: left < right,
            "lte": lambda: left <= right, "gt": lambda: left > right, "gte": lambda: left >= right}[op]()


def _value(v) -> Column:
    return F.col(v["col"]) if isinstance(v, dict) else F.lit(v)


def computed(spec: dict, as_of: date) -> Column:
    """One ``compute`` entry: ``days_until``, ``ceil``, ``sub`` or ``bucket``."""
    if "days_until" in spec:
        return days_until(spec["days_until"], as_of)
    if "ceil" in spec:
        return F.ceil(F.col(spec["ceil"]))
    if "sub" in spec:
        a, b = [F.col(x) if isinstance(x, str) else F.lit(x) for x in spec["sub"]]
        return a - b
    out = F
    otherwise = None
    for arm in spec["bucket"]:
        if "else" in arm:
            otherwise = _value(arm["else"])
        else:
            out = out.when(condition(arm["when"]), _value(arm["value"]))
    return out.otherwise(otherwise) if otherwise is not None else out


def compute(df: DataFrame, specs: list[dict], as_of: date) -> DataFrame:
    for spec in specs:
        df = df.withColumn(spec["as"], computed(spec, as_of))
    return df


def date_bounds(specs: list[dict], where, as_of: date) -> list[Column]:
    """Bounds on the dates themselves for conditions on days until them, which a scan can use."""
    dates = {s["as"]: s["days_until"] for s in specs if "days_until" in s}
    out = []
    for c in where if isinstance(where, list) else []:
        if c.get("field") in dates and isinstance(c.get("value"), int):
            column, day = F.col(dates[c["field"]]), as_of + timedelta(c["value"])
            if c["op"] in ("gte", "eq"):
                out.append(column >= F.lit(day))
            if c["op"] in ("lte", "eq"):
                out.append(column < F.lit(day + timedelta(1)))
    return out


def rollup(df: DataFrame, spec: dict, as_of: date) -> DataFrame:
    """``{group_by, filter_rows: {compute, where}, agg: [{as, op, col}]}``."""
    pre = spec.get("filter_rows", {})
    for bound in date_bounds(pre.get("compute", []), pre.get("where"), as_of):
        df = df.where(bound)
    df = compute(df, pre.get("compute", []), as_of)
    if pre.get("where"):
        df = df.where(condition(pre["where"]))
    aggs = [AGGREGATES[a["op"]](a["col"]).alias(a["as"]) for a in spec["agg"]]
    return df.groupBy(*spec["group_by"]).agg(*aggs)


def post(df: DataFrame, spec: dict, as_of: date, names: dict[str, DataFrame] | None = None) -> DataFrame:
    """The steps of a ``post`` or ``reduce`` block, in their fixed order."""
    if "latest_snapshot" in spec:
        df = latest_snapshot(df, spec["latest_snapshot"]["by"], spec["latest_snapshot"]["on"])
    if "rename" in spec:
        df = df.withColumnsRenamed(spec["rename"])
    if "rollup" in spec:
        df = rollup(df, spec["rollup"], as_of)
    if "fillna" in spec:
        df = df.fillna(spec["fillna"])
    df = compute(df, spec.get("compute", []), as_of)
    if spec.get("where"):
        df = df.where(condition(spec["where"]))
    if "drop" in spec:
        df = df.drop(*spec["drop"])
    for r in spec.get("resolve", []):
        df = resolve_names(df, r["field"], names[r["type"]], r["as"])
    if "sort_by" in spec:
        df = df.orderBy(spec["sort_by"])
    if "limit" in spec:
        df = df.limit(spec["limit"])
    return df


def link_bring(df: DataFrame, edges: DataFrame, src: str, bring: list[str], match: str | None = None,
               edge_src: str = "src", edge_dst: str = "dst") -> DataFrame:
    """One hop along an edge table: bring edge columns, matched on the source
    and, if given, on a second column of the row."""
    picked = edges.select(F.col(edge_src).alias(src),
                          *([F.col(edge_dst).alias(match)] if match else []), *bring)
    return df.join(picked, [src] + ([match] if match else []), "left")


def resolve_names(df: DataFrame, field: str, names: DataFrame, out: str) -> DataFrame:
    """Display name of an id; ``names`` has columns ``id`` and ``name``."""
    return df.join(names.select(F.col("id").alias(field), F.col("name").alias(out)), field, "left")


def gather(tables, spec: dict, as_of: date, names: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a whole gather spec against a table namespace.

    ``{base | collect, join, links, post}``; every source is projected to its
    declared columns and reduced before any join.
    """
    sources = spec.get("collect") or [dict(spec["base"], **{"as": "base"})]
    frames = {}
    for s in sources:
        df = getattr(tables, s["dataset"]).select(*s["columns"])
        if s.get("filters"):
            df = df.where(condition(s["filters"]))
        frames[s["as"]] = post(df, s.get("reduce", {}), as_of)
    current = frames[sources[0]["as"]]
    for j in spec.get("join", []):
        how = {"outer": "full"}.get(j["how"], j["how"])
        left = frames[j["left"]] if "left" in j else current
        current = left.join(frames[j["right"]], j["on"], how)
    for link in spec.get("links", []):
        current = link(current) if callable(link) else link_bring(current, **link)
    return post(current, spec.get("post", {}), as_of, names)
