"""Structured Streaming versions of the monitoring jobs.

Every job writes to a keyed table through ``foreachBatch``. A batch is a delta of the
table, so its cost follows the batch, and a replay after a failure writes the same
delta. State lives in the checkpoint folder below the
shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.constants import OPS_BAR, OPS_RX, SPAN_DAYS, SPAN_MIN_REVIEWS
from tallyroom.functions import matches_any
from tallyroom.operators.ranking import first_per
from tallyroom.session import scratch_dir
from tallyroom.sources.sinks import KeyedTable

SWEEP_TRIGGER = {"processingTime": "8 minutes"}


def file_stream(spark: SparkSession, folder: str, table: str, max_files: int | None = None) -> DataFrame:
    """A folder of parquet files as a stream, with the schema of the files at hand."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/{table}.parque[t]")  # a pattern for this one file or folder


def run_available(stream: DataFrame, each_batch, checkpoint: str, mode: str = "update", trigger: dict | None = None):
    """Run a stream over what is available (or on a schedule with ``trigger``)."""
    writer = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(each_batch).trigger(**(trigger or {"availableNow": True})))
    query = writer.start()
    if trigger is None:
        query.awaitTermination()
    return query


def into_table(table: KeyedTable, newer: list[str] | None = None):
    """Batch writer: upsert by key. The batch id is the version, so a replay writes the same rows;
    nothing of the table is read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, newer=newer)
    return write


def complaint_stream(events: DataFrame) -> DataFrame:
    """Complaint shape of the event stream."""
    issue = F.when(F.col("event_type") == "error", "Wrong item").when(
        F.col("event_type") == "click", "Late delivery").otherwise(F.initcap("event_type"))
    return events.select(
        F.coalesce(F.when(F.col("event_id") % 10 != 0, F.concat(F.lit("e"), F.col("event_id").cast("string"))),
                   F.concat(F.lit("m"), F.col("event_id").cast("string"))).alias("event_id"),
        F.col("user_id").cast("string").alias("master_store_id"), issue.alias("issue_type"), "value",
        F.col("ts").cast("timestamp").alias("ts"))


def tumbling_daily(complaints: DataFrame, delay: str = "2 days") -> DataFrame:
    """Complaints per store and day."""
    return (complaints.withWatermark("ts", delay).groupBy("master_store_id", F.window("ts", "1 day"))
            .agg(F.count("*").alias("complaints"),
                 F.count_if(matches_any("issue_type", OPS_RX)).alias("ops_complaints"))
            .select("master_store_id", F.col("window.start").cast("date").alias("day"), "complaints",
                    "ops_complaints"))


def daily_by_event(complaints: DataFrame, delay: str = "2 days") -> DataFrame:
    """The events of each store and day that are not late, one row each. As no two events share a
    group, the engine's count of rows dropped behind the watermark is one of events."""
    return (complaints.withWatermark("ts", delay).groupBy("master_store_id", F.window("ts", "1 day"), "event_id")
            .agg(F.count("*").alias("events"))
            .select("master_store_id", F.col("window.start").cast("date").alias("day"), "event_id", "events"))


def sliding_span(complaints: DataFrame, days: int = SPAN_DAYS + 1, delay: str = "2 days") -> DataFrame:
    """Counts per (store, theme) in windows of 15 calendar days (a span of 14)."""
    return (complaints.withWatermark("ts", delay)
            .groupBy("master_store_id", "issue_type", F.window("ts", f"{days} days", "1 day"))
            .agg(F.count("*").alias("hits"))
            .select("master_store_id", "issue_type", F.col("window.start").cast("date").alias("window_start"), "hits",
                    (F.col("hits") >= SPAN_MIN_REVIEWS).alias("alert")))


def daily_by_theme(complaints: DataFrame, delay: str = "2 days") -> DataFrame:
    """Complaints per store, theme and day: the only state that windows of whole days need."""
    return (complaints.withWatermark("ts", delay).groupBy("master_store_id", "issue_type", F.window("ts", "1 day"))
            .agg(F.count("*").alias("hits"))
            .select("master_store_id", "issue_type", F.col("window.start").cast("date").alias("day"), "hits"))


def day_windows(daily: DataFrame, keys: list[str], count: str, width: int, step: int) -> DataFrame:
    """Sums of ``count`` over windows of ``width`` days that start every ``step`` days since 1970-01-01, from
    rows per day: a day's row, not its events, stands in each of its windows."""
    starts = F.expr(f"sequence(0, {width // step - 1})")
    first = F.expr(f"date_add(DATE'1970-01-01', int({step} * floor(datediff(day, DATE'1970-01-01') / {step})))")
    return (daily.select(*keys, count, F.explode(F.transform(starts, lambda i: F.date_sub(first, (i * step).cast("int")))).alias("window_start"))
            .groupBy(*keys, "window_start").agg(F.sum(count).alias(count)))


def trailing_ops(complaints: DataFrame, delay: str = "2 days") -> DataFrame:
    """Last-mile complaints per store in 60-day windows, against the bar."""
    return (complaints.where(matches_any("issue_type", OPS_RX)).withWatermark("ts", delay)
            .groupBy("master_store_id", F.window("ts", "60 days", "10 days"))
            .agg(F.count("*").alias("ops_complaints"))
            .select("master_store_id", F.col("window.start").cast("date").alias("window_start"), "ops_complaints",
                    (F.col("ops_complaints") >= OPS_BAR).alias("over_bar")))


def deduplicated(complaints: DataFrame, delay: str = "2 days") -> DataFrame:
    """One row per event id; the state of an id is dropped once it is too old."""
    return complaints.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def latest_state(stream: DataFrame, table: KeyedTable, checkpoint: str):
    """Keep the newest row per key: each batch adds its own newest rows, and readers take each key's
    newest by the table's ``newer`` columns. A row with a value no newer is left out."""
    return run_available(stream, table.keep_latest, checkpoint, mode="append")


def run_to_table(spark: SparkSession, stream: DataFrame, label: str, key: list[str], mode: str = "update") -> DataFrame:
    """Run a keyed stream over the available data and return the final table."""
    table = KeyedTable(spark, scratch_dir(spark, label), key)
    run_available(stream, into_table(table), scratch_dir(spark, f"{label}-checkpoint"), mode)
    return table.read()


def late_counts(query) -> list[tuple[int, int]]:
    """Rows dropped behind the watermark, per batch, from the query's progress."""
    return [(p.batchId, sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators))
            for p in query.recentProgress]


def run_parts(spark: SparkSession, parts: list[DataFrame], stream, table: KeyedTable, label: str) -> DataFrame:
    """Append ``parts`` to a folder one after the other, and run ``stream(source)`` into ``table`` over
    what is new after each, from one checkpoint. Returns (batch, dropped): the rows that each batch
    dropped behind the watermark, as its progress reports them. Batches without data are off, so
    that the parts are the batches."""
    folder, checkpoint = scratch_dir(spark, f"{label}-source"), scratch_dir(spark, f"{label}-checkpoint")
    option = "spark.sql.streaming.noDataMicroBatches.enabled"
    before, counts = spark.conf.get(option), []
    spark.conf.set(option, "false")
    try:
        for number, part in enumerate(parts):
            part.write.parquet(f"{folder}/part={number}")
            source = spark.readStream.schema(part.schema).parquet(f"{folder}/part=*")
            counts += late_counts(run_available(stream(source), into_table(table), checkpoint))
    finally:
        spark.conf.set(option, before)
    return spark.createDataFrame(counts, "batch long, dropped long")
