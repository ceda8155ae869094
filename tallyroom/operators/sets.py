"""Set operators over aligned columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_rows(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def tagged_union(**arms: DataFrame) -> DataFrame:
    """Concatenate aligned arms behind a ``src`` tag (the argument name)."""
    return union_rows(*[df.select(F.lit(tag).alias("src"), *df.columns) for tag, df in arms.items()])


def prefer(primary: DataFrame, fallback: DataFrame, key: str, owners: DataFrame | None = None) -> DataFrame:
    """Distinct rows of ``primary`` plus those of ``fallback`` whose key the
    primary source does not own."""
    owned = (owners if owners is not None else primary).select(key).distinct()
    return primary.unionByName(fallback.join(owned, key, "left_anti")).distinct()


def concat_unless_rejected(parts: list[tuple[DataFrame, bool]]) -> DataFrame:
    """Concatenate the sets that were not rejected; a rejected one adds no rows."""
    kept = [df for df, rejected in parts if not rejected]
    return union_rows(*kept) if kept else parts[0][0].where(F.lit(False))


VALUES_PER_CELL = 64


def missing_values(owners: DataFrame, owner: str, present: DataFrame, value: str) -> DataFrame:
    """Values seen anywhere but not at an owner.

    The values are packed by hash into cells of a few, each cell meets the owners by an
    equi-join on its number, and an owner's own values are taken out. The result, every
    owner with every value it lacks, is what is asked for."""
    values = present.where(F.col(value).isNotNull()).select(value).distinct()
    cells = values.agg(F.greatest(F.ceil(F.count("*") / VALUES_PER_CELL), F.lit(1)).cast("int"))
    packed = (values.withColumn("__cell", F.pmod(F.xxhash64(value), cells.scalar()).cast("int"))
              .groupBy("__cell").agg(F.collect_list(value).alias("__values")))
    pairs = (owners.select(owner).distinct().withColumn("__cell", F.explode(F.sequence(F.lit(0), cells.scalar() - 1)))
             .join(packed, "__cell").select(owner, F.explode("__values").alias(value)))
    return pairs.join(present.select(owner, value).distinct(), [owner, value], "left_anti")
