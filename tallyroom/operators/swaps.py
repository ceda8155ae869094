"""Cheapest unused alternatives per owner and role, without pairing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.ranking import exact_rank
from tallyroom.sources.sinks import written_once

HEAD = 64  # positions beyond the wanted ones that are looked at first


def ranked_catalog(items: DataFrame, group: str, price: str, item: str) -> DataFrame:
    """Position ``pos`` of every item in its group by price, then id. Items
    without a price come first."""
    return exact_rank(items, [group], [F.coalesce(F.floor(price), F.lit(-1).cast("bigint"))],
                      [F.asc_nulls_first(price), F.asc(item)], "pos")


def _head(used: DataFrame, catalog: DataFrame, owner: str, group: str, item: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The head of the catalog that holds every answer, and the positions in it that owners use. Where
    no owner uses more than ``m`` of a group's first ``k + m`` items, nothing beyond those can be wanted."""
    reach = k + HEAD
    while True:
        head = written_once(catalog.where(F.col("pos") <= reach), "swap-head")
        taken = written_once(used.join(head.select(item, group, "pos"), item).select(owner, group, "pos").distinct(), "swap-taken")
        most = taken.groupBy(owner, group).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        if k + most <= reach:
            return head.where(F.col("pos") <= k + most), taken.where(F.col("pos") <= k + most)
        reach = 2 * (k + most)


def unused_lists(owners: DataFrame, used: DataFrame, catalog: DataFrame, owner: str, group: str, item: str, k: int,
                 first: list[str]) -> tuple[DataFrame, DataFrame]:
    """``owners`` (owner, ``groups``: array of (g, n)) with ``free``: per group an array of the first ``k`` catalog
    items that the owner does not use, each ``n`` times; and the head of the catalog. Items are given by
    their ``place`` in the head, sorted by the columns ``first``.

    ``used`` meets only the head of the catalog, ``k`` items a group and as many more as one owner uses
    of them, and owners stay one row each: neither is multiplied by the positions looked at.
    """
    head, taken = _head(used, catalog, owner, group, item, k)
    columns = [*first, *[c for c in catalog.columns if c not in first]]
    head = written_once(head.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("l")).select(
        F.posexplode("l").alias("place", "x")).select("place", "x.*"), "swap-places")
    lists = head.groupBy(F.col(group).alias("g")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "place"))), lambda s: s["place"]).alias("l"))
    heads = lists.agg(F.map_from_entries(F.collect_list(F.struct("g", "l"))))
    mine = (taken.join(head.select(group, "pos", "place"), [group, "pos"])
            .groupBy(F.col(owner).alias("__owner")).agg(F.collect_list("place").alias("__taken")))

    def of(x):
        every = F.col("__heads")[x["g"]]
        unused = F.filter(F.slice(every, F.lit(1), k + F.size("__taken")), lambda i: ~F.array_contains(F.col("__taken"), i))
        free = F.slice(F.when(F.col("__taken").isNull(), every).otherwise(unused), 1, k)
        copies = F.when(x["n"] == 1, free).otherwise(F.flatten(F.transform(free, lambda i: F.array_repeat(i, x["n"].cast("int")))))
        return F.coalesce(copies, F.array().cast("array<int>"))

    found = (owners.join(mine, owners[owner] == mine["__owner"], "left").withColumn("__heads", heads.scalar())
             .withColumn("free", F.transform("groups", of)).drop("__owner", "__taken", "__heads", "groups"))
    return found, head


def owner_groups(wanted: DataFrame, owner: str, group: str) -> DataFrame:
    """``(owner, group)`` rows as one row per owner, the groups with their number of rows."""
    return wanted.groupBy(owner, F.col(group).alias("g")).agg(F.count("*").alias("n")).groupBy(owner).agg(
        F.collect_list(F.struct("g", "n")).alias("groups"))


def cheapest_unused(wanted: DataFrame, used: DataFrame, catalog: DataFrame, owner: str, group: str,
                    item: str, k: int) -> DataFrame:
    """For each ``(owner, group)`` of ``wanted``, the first ``k`` catalog items
    of that group which the owner does not use, a row each."""
    lists, head = unused_lists(owner_groups(wanted, owner, group), used, catalog, owner, group, item, k, [item])
    return lists.select(owner, F.explode(F.flatten("free")).alias("place")).join(head, "place").drop("place")
