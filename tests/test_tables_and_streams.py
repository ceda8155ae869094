"""Keyed writes and streams on small files."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroom.session import scratch_dir
from tallyroom.sources import readers, sinks
from tallyroom.streaming import jobs


def test_upsert_keeps_stored_values_for_nulls(spark):
    schema = "k string, s string, v double"
    t = sinks.KeyedTable(spark, scratch_dir(spark, "t"), ["k"])
    t.upsert(spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0), (None, "n", 0.0)], schema))
    got = t.upsert(spark.createDataFrame([("a", None, 9.0), ("c", "z", None), (None, None, 5.0), ("b", "y", 3.0), ("b", "y", 4.0)],
                                         schema), newer=["v"])
    want = [("a", "x", 9.0), ("b", "y", 4.0), ("c", "z", None), (None, "n", 5.0)]
    assert {tuple(r) for r in got.collect()} == set(want) and got.count() == 4
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([("a", 1)], "k string, other int"))


def test_a_write_touches_its_own_buckets_and_a_replay_changes_nothing(spark):
    t = sinks.KeyedTable(spark, scratch_dir(spark, "t"), ["k"])
    t.upsert(spark.range(1000).selectExpr("id AS k", "id AS v"), 0)
    for _ in range(2):  # the second run of batch 1 is a replay
        t.upsert(spark.createDataFrame([(7, 70), (2000, 1)], "k bigint, v bigint"), 1)
        assert t.read().count() == 1001 and t.read().where("k = 7").first().v == 70
    assert len([n for n in os.listdir(f"{t.path}/v1") if n.startswith("bucket=")]) <= 2
    t.replace_groups(spark.createDataFrame([(7, 71), (7, 72)], "k bigint, v bigint"),
                     spark.createDataFrame([(7,), (8,)], "k bigint"), 2)
    assert sorted(r.v for r in t.read().where("k IN (7, 8)").collect()) == [71, 72] and t.read().count() == 1001


def test_log_against_a_plain_table(spark):
    """Random upserts, group replacements, replays and folds against a dictionary."""
    rng = random.Random(7)
    schema = "k string, a bigint, b string"
    t = sinks.KeyedTable(spark, scratch_dir(spark, "log"), ["k"], fold_deltas=3, bucket_bytes=2000)
    want = {}
    for version in range(11):
        keys = rng.sample(["x", "y", "z", "u", "v", "w", None], rng.randint(1, 4))
        if version % 4 == 2:
            rows = [(k, rng.randint(0, 9), f"g{i}") for k in keys[1:] for i in range(rng.randint(1, 3))]
            t.replace_groups(spark.createDataFrame(rows, schema), spark.createDataFrame([(k,) for k in keys], "k string"), version)
            want |= {k: [r[1:] for r in rows if r[0] == k] for k in keys}
        else:
            rows = [(k, rng.choice([None, version]), rng.choice([None, f"b{version}"])) for k in keys]
            for _ in range(1 + version % 2):  # some are replayed
                t.upsert(spark.createDataFrame(rows, schema), version)
            for k, a, b in rows:
                old = want.get(k) or [(None, None)]
                want[k] = [(a if a is not None else x, b if b is not None else y) for x, y in old]
        got = sorted((tuple(r) for r in t.read().collect()), key=str)
        assert got == sorted(((k, *r) for k, rows in want.items() for r in rows), key=str), version
    names = os.listdir(t.path)
    assert 1 <= sum(n[0] == "b" for n in names) <= 2 and len(names) <= 2 + 2 * 4 + 1, names
    few = t.touched(spark.createDataFrame([("x",), (None,), ("q",)], "k string"))
    assert sorted(map(str, {r.k for r in few.collect()})) == sorted(map(str, [k for k in ("x", None) if want.get(k)]))


def test_a_small_batch_costs_the_same_on_any_table(spark):
    sizes = []
    for n in (10_000, 1_000_000):
        t = sinks.KeyedTable(spark, scratch_dir(spark, "size"), ["k"], bucket_bytes=1 << 20)
        t.upsert(spark.range(n).selectExpr("id AS k", "id * 3 AS v"), 0)
        t.fold()
        t.upsert(spark.range(500).selectExpr("id * 17 AS k", "-id AS v").coalesce(1), 1)
        sizes.append(sum(os.path.getsize(f"{t.path}/v1/{f}") for f in os.listdir(f"{t.path}/v1") if f.endswith(".parquet")))
        assert t.read().count() == n and t.read().where("v < 0").count() == 499
        buckets = [x for x in os.listdir(t.path) if x[0] == "b"]
        assert (int(buckets[0].split("-")[1]) > 1) == (n > 10_000)
    assert sizes[0] == sizes[1]


def test_unfinished_version_is_ignored(spark):
    t = sinks.VersionedTable(spark, scratch_dir(spark, "t"))
    t.replace(spark.range(3).toDF("k"))
    os.makedirs(f"{t.path}/v2")
    assert t.read().count() == 3
    assert t.create_if_absent(spark.range(9).toDF("k")).count() == 3


def test_stage_never_moves_back(spark):
    df = spark.createDataFrame([("a", "Capture"), ("b", "Development"), ("c", None), ("d", "Rejected"), ("e", "Triage")],
                               "idea_id string, stage string")
    got = {r.idea_id: r.stage for r in sinks.stage_advance(df, df.where("idea_id <> 'e'").select("idea_id")).collect()}
    assert got == {"a": "Pipeline", "b": "Development", "c": None, "d": "Rejected", "e": "Triage"}


def test_scan_fails_on_a_missing_column(spark, tmp_path):
    spark.range(2).toDF("id").write.parquet(str(tmp_path / "x"))
    schema = spark.createDataFrame([], "id bigint, gone string").schema
    with pytest.raises(ValueError):
        readers.scan(spark, str(tmp_path / "x"), schema)


def write_events(spark, folder, name, rows):
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double").coalesce(
        1).write.parquet(f"{folder}/{name}.dir")
    part = [f for f in os.listdir(f"{folder}/{name}.dir") if f.endswith(".parquet")][0]
    os.makedirs(f"{folder}/events.parquet", exist_ok=True)
    os.link(f"{folder}/{name}.dir/{part}", f"{folder}/events.parquet/{name}.parquet")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    day = datetime(2026, 1, 10)
    write_events(spark, tmp_path, "events", [(1, day, 1, "error", 1.0)])
    write_events(spark, tmp_path, "events2", [(2, day + timedelta(days=10), 1, "error", 1.0)])
    write_events(spark, tmp_path, "events3", [(3, day + timedelta(days=10), 1, "error", 1.0)])
    write_events(spark, tmp_path, "events4", [(4, day, 1, "error", 1.0)])
    for i, name in enumerate(["events", "events2", "events3", "events4"]):
        os.utime(tmp_path / "events.parquet" / f"{name}.parquet", (1000 + i, 1000 + i))
    stream = jobs.complaint_stream(jobs.file_stream(spark, str(tmp_path), "events", max_files=1))
    table = sinks.KeyedTable(spark, scratch_dir(spark, "late"), ["master_store_id", "day"])
    query = jobs.run_available(jobs.tumbling_daily(stream, delay="1 day"), jobs.into_table(table),
                               scratch_dir(spark, "late-ckpt"))
    assert table.read().agg(F.sum("complaints")).collect()[0][0] == 3
    assert sum(n for _, n in jobs.late_counts(query)) == 1


def test_latest_state_over_batches(spark, tmp_path):
    schema = "k string, d int, v int"
    for i, rows in enumerate([[("a", 1, 10), ("b", 5, 50)], [("a", 3, 30), ("b", 4, 40)], [("a", 2, 20)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/p={i}"))
    stream = spark.readStream.schema(schema + ", p int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("p")
    table = sinks.KeyedTable(spark, scratch_dir(spark, "state"), ["k"], newer=["d"])
    jobs.latest_state(stream, table, scratch_dir(spark, "state-ckpt"))
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 3, 30), ("b", 5, 50)]


def test_duplicates_arrive_once(spark, tmp_path):
    day = datetime(2026, 1, 10)
    write_events(spark, tmp_path, "events", [(1, day, 1, "error", 1.0), (1, day, 1, "error", 1.0), (10, day, 2, "view", 1.0)])
    stream = jobs.complaint_stream(jobs.file_stream(spark, str(tmp_path), "events"))
    got = jobs.run_to_table(spark, jobs.deduplicated(stream), "dedup", ["event_id"], mode="append")
    assert sorted(r.event_id for r in got.collect()) == ["e1", "m10"]


def test_windows_over_days_hold_a_row_per_day_and_key(spark, tmp_path):
    rng, day = random.Random(2), datetime(2026, 1, 10)
    rows = [(i, day + timedelta(days=rng.randint(0, 20), hours=rng.randint(0, 23)), rng.randint(1, 3), rng.choice(["error", "view"]), 1.0)
            for i in range(400)]
    write_events(spark, tmp_path, "events", rows)
    daily = jobs.daily_by_theme(jobs.complaint_stream(jobs.file_stream(spark, str(tmp_path), "events")), delay="60 days")
    table = sinks.KeyedTable(spark, scratch_dir(spark, "days"), ["master_store_id", "issue_type", "day"])
    query = jobs.run_available(daily, jobs.into_table(table), scratch_dir(spark, "days-ckpt"))
    kept = len({(user, kind, ts.date()) for _, ts, user, kind, _ in rows})
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) == kept == table.read().count()
    got = {(r.master_store_id, r.issue_type, r.window_start): r.hits
           for r in jobs.day_windows(table.read(), ["master_store_id", "issue_type"], "hits", 15, 1).collect()}
    want = {}
    for _, ts, user, kind, _ in rows:
        for back in range(15):
            key = (str(user), {"error": "Wrong item", "view": "View"}[kind], ts.date() - timedelta(days=back))
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_engine_counts_every_late_event(spark):
    day = datetime(2026, 1, 10)
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    parts = [[(i, day + timedelta(days=i), 1, "error", 1.0) for i in range(1, 9)], [(11, day, 1, "error", 1.0)],
             [(20 + i, day + timedelta(hours=i), 1, "error", 1.0) for i in range(1, 6)] + [(31, day + timedelta(days=8), 1, "view", 1.0)]]
    table = sinks.KeyedTable(spark, scratch_dir(spark, "kept"), ["master_store_id", "day", "event_id"])
    dropped = jobs.run_parts(spark, [spark.createDataFrame(p, schema) for p in parts],
                             lambda s: jobs.daily_by_event(jobs.complaint_stream(s)), table, "late-parts")
    assert dropped.agg(F.sum("dropped")).first()[0] == 5 and table.read().agg(F.sum("events")).first()[0] == 10


def test_a_fold_splits_a_large_bucket(spark):
    """A bucket is written by several tasks: none reads a whole one, however much it holds."""
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = [spark.conf.get(x) for x in sizes]
    for x in sizes:
        spark.conf.set(x, "64k")
    try:
        t = sinks.KeyedTable(spark, scratch_dir(spark, "fold"), ["k"])
        t.upsert(spark.range(200_000).selectExpr("id AS k", "id * 3 AS v"), 0)
        t.fold()
        base = [x for x in os.listdir(t.path) if x[0] == "b"]
        assert base == ["b0-1"]
        files = [f for f in os.listdir(f"{t.path}/b0-1/__bucket=0") if f.endswith(".parquet")]
        assert len(files) > 1
        assert t.read().count() == 200_000 and t.read().where("v <> k * 3").isEmpty()
    finally:
        for x, value in zip(sizes, before):
            spark.conf.set(x, value)
