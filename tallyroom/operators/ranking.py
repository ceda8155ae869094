"""Ranked rows and group shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions import safe_divide


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rnk") -> DataFrame:
    """First ``n`` rows per key with their rank. The ``rank <= n`` filter lets
    Spark keep only ``n`` rows per key and task before the shuffle, which is
    what holds when one key owns a large part of the rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).withColumn(
        rank, F.col(rank).cast("bigint"))


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_n(df, keys, order, 1, "__first").drop("__first")


def commonest(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key; the smaller value wins a tie."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("__n"))
    return first_per(counts, [key], [F.desc("__n"), F.asc_nulls_first(value)]).select(key, value)


def share_of_total(df: DataFrame, keys: list[str], measure: str, out: str, digits: int = 1) -> DataFrame:
    """Percentage of each row in its group's total. Totals are combined map-side
    and joined back instead of a window over the whole group."""
    totals = df.groupBy(*keys).agg(F.sum(measure).alias("__total"))
    return df.join(totals, keys, "left").withColumn(
        out, F.round(safe_divide(measure, "__total") * 100, digits)).drop("__total")


def best_span(df: DataFrame, keys: list[str], day: str, span: int) -> DataFrame:
    """Per key, the window ``[w, w + span]`` over integer days that admits the
    most rows; the earliest window wins a tie.

    Rows are first counted per day, so the frame runs over calendar days, never
    over the raw rows of a busy key.
    """
    per_day = df.groupBy(*keys, day).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(0, span)
    spans = per_day.withColumn("hits", F.sum("__n").over(w)).withColumn("window_last", F.max(day).over(w))
    best = first_per(spans, keys, [F.desc("hits"), F.asc(day)])
    return best.select(*keys, F.col(day).alias("window_first"), "window_last", "hits")


def exact_rank(df: DataFrame, within: list[str], levels: list[Column], last: list[Column], out: str) -> DataFrame:
    """Rank 1, 2, 3, ... by ``levels`` then ``last``, inside ``within``.

    ``levels`` are coarse non-NULL sort values, most significant first, each
    ascending (negate a number to sort it downwards). Ranks are
    the sizes of the slices before a row plus its place in its own slice, so no
    task ever sorts a whole group; the slice sizes are a small aggregate.
    """
    names = [f"__l{i}" for i in range(len(levels))]
    df = df.withColumns(dict(zip(names, levels)))
    sizes = df.groupBy(*within, *names).agg(F.count("*").alias("__n"))
    before = F.lit(0)
    if not within:
        # The first level of an ungrouped rank is totalled before its window, so
        # that window holds one row per value.
        top = sizes.groupBy(names[0]).agg(F.sum("__n").alias("__c"))
        running = Window.orderBy(names[0]).rowsBetween(Window.unboundedPreceding, -1)
        top = top.select(names[0], F.coalesce(F.sum("__c").over(running), F.lit(0)).alias("__top"))
        sizes = sizes.join(top, names[0])
        before = F.col("__top")
    for i, name in enumerate(names):
        prefix = within + names[:i]
        if prefix:
            upto = Window.partitionBy(*prefix).orderBy(name).rangeBetween(Window.unboundedPreceding, Window.currentRow)
            before = before + F.sum("__n").over(upto) - F.sum("__n").over(Window.partitionBy(*prefix, name))
    offsets = sizes.select(*within, *names, before.alias("__before"))
    inside = Window.partitionBy(*within, *names).orderBy(*last)
    return (df.withColumn("__in", F.row_number().over(inside)).join(offsets, within + names)
            .withColumn(out, (F.col("__before") + F.col("__in")).cast("bigint"))
            .drop(*names, "__in", "__before"))
