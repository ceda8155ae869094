"""Shared helpers of the operators: written intermediates, components, Arrow text access."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyroom.session import scratch_dir

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back. Lineage ends here, and a lost
    executor costs a re-read of shared files."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_share(columns: list[str], n: int, total: int):
    """Condition that about ``n`` of ``total`` rows meet, by a hash of their columns. It is the same for
    any partitioning, and a scan applies it, so a sample's rows are all that moves."""
    if n >= total:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit(-(1 << 63) + int((1 << 64) * (n / total)))


def label_share(columns: list[str], label: str, n: int, counts: dict):
    """Condition that about ``n`` rows meet, by a hash of their columns: labels share ``n`` evenly, and what
    a rare one does not need goes to the others. ``counts`` has the rows of each label."""
    left, shares = n, {}
    for i, (value, count) in enumerate(sorted(counts.items(), key=lambda x: x[1])):
        part = min(count, max(1, left // (len(counts) - i)))
        left -= part
        if part < count:
            shares[value] = part / count
    if not shares:
        return F.lit(True)
    bounds = F.create_map(*[F.lit(x) for value, share in shares.items()
                            for x in (value, -(1 << 63) + int((1 << 64) * share))])
    return F.coalesce(F.xxhash64(*columns) < bounds[F.col(label)], F.lit(True))


def components(links: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node per linked node: (node, component).

    ``links`` has long columns a and b. Large-star and small-star steps alternate until the
    edge set stops changing; every step is two aggregates with map-side combination, and the
    edges are written after each round, so no list of neighbours is ever gathered.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), label)
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        edges = written(small, label)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    low = edges.groupBy("b").agg(F.count("*").alias("n")).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(low)


def text_views(column: pa.Array) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text of an Arrow string column without copies; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[at[i]:at[i + 1]] if valid[i] else data[:0]


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to the Python workers in batches of ``rows``, unless the session has chosen a number. Spark's
    own 10,000 rows of long texts are tens of megabytes in a task, on the JVM's side and again in the worker."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, str(rows))


def row_texts(rows: pa.RecordBatch, at: int | None) -> pa.Array:
    """Texts of a batch: its second column, or field ``at`` of the struct that carries the row."""
    return rows.column(1) if at is None else rows.column(0).field(at)


def packed(docs: DataFrame, name: str) -> tuple[DataFrame, int | None]:
    """``docs`` as one struct column, and the place of its text; a text that is not a string gets a second
    column, so a string travels once."""
    row = F.struct(*docs.columns).alias(name)
    at = [c.lower() for c in docs.columns].index("text")
    if docs.schema[at].dataType == StringType():
        return docs.select(row), at
    return docs.select(row, F.col("text").cast("string").alias("text")), None


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrow list<int64> column from integer arrays."""
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), where it is not installed."""
    context = spark.sparkContext
    if any(name.startswith("tallyroom-package") for name in getattr(context, "_python_includes", [])):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / "tallyroom-package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
