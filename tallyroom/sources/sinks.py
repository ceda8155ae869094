"""Keyed table writes on plain Parquet.

A table is a folder of numbered versions. Readers take what versions with Spark's ``_SUCCESS``
file hold, so a job that is lost half way leaves the table as it was. A keyed table is a log: a
write adds its own rows as a numbered delta and reads nothing, so its cost follows the batch and
not the table; readers merge the deltas over a base; when the deltas have grown to a share of the
base they are folded into a new one. A version number may be given, such as a micro-batch id;
writing it again writes the same rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.constants import STAGE_RANK
from tallyroom.functions import generated_key, mapped
from tallyroom.operators.ranking import first_per
from tallyroom.session import scratch_dir

BUCKET_BYTES = 256 << 20  # of a base, in one bucket
FOLD_SHARE = 0.25  # deltas are folded when they pass this share of the base,
FOLD_DELTAS = 16  # or this number


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def _bytes(spark: SparkSession, path: str) -> int:
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(root).getLength()


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions whose write has finished, ascending."""
    numbers = [int(n[1:]) for n in _folders(spark, path) if n[:1] == "v" and n[1:].isdigit()]
    return sorted(n for n in numbers if "_SUCCESS" in _folders(spark, f"{path}/v{n}"))


class VersionedTable:
    """A table that is replaced as a whole, or updated by key at the cost of a rewrite."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def exists(self) -> bool:
        return bool(finished_versions(self.spark, self.path))

    def read(self) -> DataFrame:
        versions = finished_versions(self.spark, self.path)
        if not versions:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(f"{self.path}/v{versions[-1]}")

    def replace(self, df: DataFrame) -> DataFrame:
        """Create or replace: the new rows are the whole table. A version that another writer has
        begun is not written over: that write fails."""
        versions = finished_versions(self.spark, self.path)
        df.write.mode("errorifexists").parquet(f"{self.path}/v{(versions[-1] if versions else 0) + 1}")
        return self.read()

    def create_if_absent(self, df: DataFrame) -> DataFrame:
        return self.read() if self.exists() else self.replace(df)


class KeyedTable:
    """A table with a key, as a base and the deltas since.

    ``b<version>-<buckets>`` is a base that holds everything up to a version, in buckets by key hash
    whose number follows its size. ``v<version>`` has updates by key, ``r<version>`` whole groups that
    replace a key's rows, ``l<version>`` rows of which the newest by ``newer`` counts. A fold keeps the
    base before it and what came after that one, for readers under way, and clears all else.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], newer: list[str] | None = None,
                 bucket_bytes: int = BUCKET_BYTES, fold_share: float = FOLD_SHARE, fold_deltas: int = FOLD_DELTAS):
        self.spark, self.path, self.key, self.newer = spark, path.rstrip("/"), key, newer
        self.bucket_bytes, self.fold_share, self.fold_deltas = bucket_bytes, fold_share, fold_deltas

    def _log(self, before: int | None = None) -> tuple[tuple[int, int] | None, dict[int, str]]:
        """(version, buckets) of the newest base, and the deltas after it with their kinds."""
        bases, deltas = [], {}
        for name in _folders(self.spark, self.path):
            kind, _, buckets = name[:1], *name[1:].partition("-")[1:]
            number = name[1:].partition("-")[0]
            if kind not in "bvrl" or not number.isdigit() or (before is not None and int(number) >= before):
                continue
            if "_SUCCESS" not in _folders(self.spark, f"{self.path}/{name}"):
                continue
            if kind == "b":
                bases.append((int(number), int(buckets)))
            else:
                deltas[int(number)] = kind
        base = max(bases, default=None)
        return base, {v: k for v, k in sorted(deltas.items()) if base is None or v > base[0]}

    def _next(self) -> int:
        base, deltas = self._log()
        return max([base[0] if base else -1, *deltas]) + 1

    def exists(self) -> bool:
        return any(self._log())

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    def _deltas(self, deltas: dict[int, str], kind: str) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/{kind}{v}").withColumn("__version", F.lit(v))
                 for v, k in deltas.items() if k == kind]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in self.key])

    def _only(self, rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        """Rows whose key is among ``keys`` (left_semi) or not (left_anti)."""
        keys = keys.select(*[F.col(c).alias(f"__k_{c}") for c in self.key]).distinct()
        return rows.join(keys, reduce(lambda x, y: x & y, [rows[c].eqNullSafe(keys[f"__k_{c}"]) for c in self.key]), how)

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table as of the versions under ``before``, or its rows of the given ``keys``. The base is
        joined with the deltas' keys, which are few, and is not grouped again."""
        base, deltas = self._log(before)
        if base is None and not deltas:
            raise FileNotFoundError(self.path)
        stored = None
        if base:
            stored = self.spark.read.parquet(f"{self.path}/b{base[0]}-{base[1]}")
            if keys is not None and base[1] > 1:
                wanted = [r.b for r in keys.select(self._bucket(base[1]).alias("b")).distinct().collect()]  # at most the buckets
                stored = stored.where(F.col("__bucket").isin(wanted))
            stored = stored.drop("__bucket")
        updates, groups, latest = (self._deltas(deltas, kind) for kind in "vrl")
        if keys is not None:
            stored, updates, groups, latest = (x if x is None else self._only(x, keys, "left_semi")
                                               for x in (stored, updates, groups, latest))
        if latest is not None:
            stored = self._with_latest(stored, latest)
        cut = None
        if groups is not None:
            stored, cut = self._with_groups(stored, groups)
        if updates is None:
            return stored
        return self._with_updates(stored, updates, cut)

    def _with_latest(self, stored: DataFrame | None, latest: DataFrame) -> DataFrame:
        """The newest row per key; one that is no newer than the stored row is left out."""
        order = [*[F.desc_nulls_last(c) for c in self.newer], F.asc("__version")]
        if stored is None:
            return first_per(latest, self.key, order).drop("__version")
        met = self._only(stored, latest, "left_semi").withColumn("__version", F.lit(-1))
        best = first_per(met.unionByName(latest, allowMissingColumns=True), self.key, order).drop("__version")
        return self._only(stored, latest, "left_anti").unionByName(best, allowMissingColumns=True)

    def _with_groups(self, stored: DataFrame | None, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of replaced groups, and when each was replaced last."""
        cut = groups.groupBy(*self.key).agg(F.max("__version").alias("__cut"))
        last = cut.select(*[F.col(c).alias(f"__k_{c}") for c in self.key], "__cut")
        same = reduce(lambda x, y: x & y, [groups[c].eqNullSafe(last[f"__k_{c}"]) for c in self.key])
        rows = (groups.join(last, same & (groups["__version"] == last["__cut"]), "left_semi").where("NOT __gone")
                .drop("__gone", "__version"))
        if stored is not None:
            rows = self._only(stored, cut, "left_anti").unionByName(rows, allowMissingColumns=True)
        return rows, cut

    def _with_updates(self, stored: DataFrame | None, updates: DataFrame, cut: DataFrame | None) -> DataFrame:
        """Stored rows with each key's newest values that are not null."""
        if cut is not None:
            last = cut.select(*[F.col(c).alias(f"__k_{c}") for c in self.key], "__cut")
            same = reduce(lambda x, y: x & y, [updates[c].eqNullSafe(last[f"__k_{c}"]) for c in self.key])
            updates = updates.join(last, same, "left").where("__cut IS NULL OR __version > __cut").select(*updates.columns)
        values = [c for c in updates.columns if c not in (*self.key, "__version")]
        patch = updates.groupBy(*self.key).agg(F.count("*").alias("__n"), *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__version"))).alias(c) for c in values]).drop("__n")
        if stored is None:
            return patch.select(*[c for c in updates.columns if c != "__version"])
        new = patch.select(*[F.col(c).alias(f"__k_{c}") for c in self.key], *[F.col(c).alias(f"__v_{c}") for c in values])
        same = reduce(lambda x, y: x & y, [stored[c].eqNullSafe(new[f"__k_{c}"]) for c in self.key])
        merged = stored.join(new, same, "left").select(*[
            F.coalesce(F.col(f"__v_{c}"), F.col(c)).alias(c) if c in values else F.col(c) for c in stored.columns])
        met = self._only(stored.select(*self.key), patch, "left_semi")
        return merged.unionByName(self._only(patch, met, "left_anti"), allowMissingColumns=True)

    def touched(self, rows: DataFrame, version: int | None = None) -> DataFrame | None:
        """Stored rows of the keys of ``rows``, as of the versions under ``version``."""
        if not any(self._log(version)):
            return None
        return self.read(version, rows.select(*self.key))

    def _fitted(self, rows: DataFrame) -> DataFrame:
        """Rows with the types of the stored columns; columns that the table lacks are an error."""
        base, deltas = self._log()
        first = f"b{base[0]}-{base[1]}" if base else next((f"{k}{v}" for v, k in deltas.items()), None)
        if first is None:
            return rows
        types = {f.name: f.dataType for f in self.spark.read.parquet(f"{self.path}/{first}").schema.fields}
        extra = [c for c in rows.columns if c not in types]
        if extra:
            raise ValueError(f"columns not in the table: {extra}")
        return rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])

    def _add(self, rows: DataFrame, kind: str, version: int | None) -> None:
        base, _ = self._log()
        if version is None:
            version = self._next()
        elif base and version <= base[0]:
            return  # a replay of what the base holds
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}{version}")
        self.fold_if_due()

    def upsert(self, updates: DataFrame, version: int | None = None, newer: list[str] | None = None) -> DataFrame:
        """Insert or update by key; a NULL in an update keeps the stored value, and a NULL key is a
        key like any other. Of updates that share a key one is taken, the last by ``newer`` where
        that names columns."""
        order = [F.desc_nulls_last(c) for c in newer or [c for c in updates.columns if c not in self.key]]
        updates = first_per(updates, self.key, order) if order else updates.dropDuplicates(self.key)
        self._add(self._fitted(updates), "v", version)
        return self.read()

    def keep_latest(self, rows: DataFrame, version: int | None = None) -> None:
        """Add whole rows, of which each key's newest by the table's ``newer`` columns counts."""
        rows = first_per(rows, self.key, [F.desc_nulls_last(c) for c in self.newer])
        self._add(self._fitted(rows), "l", version)

    def replace_groups(self, rows: DataFrame, groups: DataFrame, version: int | None = None) -> None:
        """Replace all rows of the keys in ``groups`` by ``rows``; here a key may have many rows. A group
        without rows ends up with none."""
        rows = self._fitted(rows)
        gone = groups.select(*self.key).distinct().withColumn("__gone", F.lit(True))
        self._add(rows.withColumn("__gone", F.lit(False)).unionByName(gone, allowMissingColumns=True), "r", version)

    def fold_if_due(self) -> bool:
        """Fold the deltas into a new base when they are many, or large beside the base."""
        base, deltas = self._log()
        size = sum(_bytes(self.spark, f"{self.path}/{k}{v}") for v, k in deltas.items())
        least = self.fold_share * _bytes(self.spark, f"{self.path}/b{base[0]}-{base[1]}") if base else self.bucket_bytes
        if len(deltas) <= self.fold_deltas and size <= least:
            return False
        self.fold()
        return True

    def fold(self) -> None:
        """Write a new base from the base and its deltas, and clear what no reader under way can need."""
        base, deltas = self._log()
        if not deltas:
            return
        folders = [f"{k}{v}" for v, k in deltas.items()] + ([f"b{base[0]}-{base[1]}"] if base else [])
        buckets = max(1, -(-sum(_bytes(self.spark, f"{self.path}/{x}") for x in folders) // self.bucket_bytes))
        rows = self.read().withColumn("__bucket", self._bucket(buckets))
        # rebalanced, not one task per bucket: a large bucket, or several that fall together, are split into files
        (rows.hint("rebalance", "__bucket").write.mode("overwrite").partitionBy("__bucket")
         .parquet(f"{self.path}/b{max(deltas)}-{buckets}"))
        for name in _folders(self.spark, self.path):
            number = name[1:].partition("-")[0]
            if number.isdigit() and name not in folders and int(number) < max(deltas) and int(number) <= (base[0] if base else -1):
                _remove(self.spark, f"{self.path}/{name}")


def with_keys(updates: DataFrame, key: str, prefix: str, basis: list[str]) -> DataFrame:
    """Fill blank keys with a key computed from the row."""
    return updates.withColumn(key, generated_key(key, prefix, *basis))


def last_per_key(updates: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One update per key, the last by ``order``."""
    return first_per(updates, key, [F.desc_nulls_last(c) for c in order])


def stage_advance(ideas: DataFrame, approved: DataFrame, to: str = "Pipeline") -> DataFrame:
    """Ideas with the approved ones moved to a stage. An idea at or past it, or
    closed, stays where it is."""
    rank = F.coalesce(mapped("stage", STAGE_RANK), F.lit(0))
    ids = approved.select("idea_id").distinct().withColumn("__ok", F.lit(True))
    moves = F.col("__ok") & (rank < STAGE_RANK[to]) & (rank > 0)
    return (ideas.join(ids, "idea_id", "left")
            .withColumn("stage", F.when(moves, F.lit(to)).otherwise(F.col("stage"))).drop("__ok"))


def written_once(df: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    """Write an intermediate that several branches of a plan read to the shared
    folder, and read it back. A lost executor costs a re-read, not a recompute.

    With ``by``, rows are written in buckets of these columns, as many as the session's shuffle
    partitions: joins and groupings on them move nothing of it. What the write itself has moved is not
    read again, so the driver is made to let go of it, and Spark's cleaner removes those files."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if by:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = "written_" + re.sub(r"\W", "_", path.rpartition("/")[2])
        (df.repartition(parts, *by).sortWithinPartitions(*by).write.option("path", path).option("compression", "zstd")
         .bucketBy(parts, *by).sortBy(*by).saveAsTable(name))
        rows = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # only its name: the files stay, and ``rows`` has read where they are
    else:
        df.write.option("compression", "zstd").parquet(path)
        rows = spark.read.parquet(path)
    spark._jvm.System.gc()
    return rows


def report_table(df: DataFrame, columns: list[str], order_by: list[str], path: str) -> DataFrame:
    """Named export of a result: the columns, in order, written and read back."""
    df.select(*columns).orderBy(*order_by).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
