"""Streams over several micro-batches, sources, sinks, plans, graphs and models."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.ml import models, network
from tidemark.model import EVENT_SCHEMA, METRICS_SCHEMA, require_schema
from tidemark.operators import graph
from tidemark.operators import sequences as seq
from tidemark.plans import detector, lake as reports, warehouse
from tidemark.sources import databases, files, lake, messages, switched
from tidemark.plans import daily
from tidemark.streaming import applications, jobs, progress, rule_versions, slices, stateful

START = datetime(2024, 1, 1)


@pytest.fixture
def event_files(spark, tmp_path):
    """Events in five files, slightly out of order, and the same as one table."""
    r = random.Random(3)
    times = sorted(r.randrange(3600) for _ in range(400))
    data = [
        (i, START + timedelta(seconds=t), r.choice(["rapid", "fire", "x"]), r.randrange(4))
        for i, t in enumerate(times)
    ]
    path = str(tmp_path / "events")
    for k in range(5):
        part = data[k * 80 : (k + 1) * 80]
        r.shuffle(part)
        spark.createDataFrame(part, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    # A last event far away lets the watermark pass all others.
    final = [(10_000, START + timedelta(days=1), "x", 99)]
    spark.createDataFrame(final, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame(data, EVENT_SCHEMA)


def stream(spark, path):
    return jobs.file_stream(spark, path, EVENT_SCHEMA, files_per_trigger=1)


def test_window_counts(spark, event_files):
    path, table = event_files
    got = jobs.run_to_table(jobs.window_counts(stream(spark, path), "10 minutes"), "t")
    from tidemark.operators.aggregates import event_counts

    assert rows(got) == rows(event_counts(table))


def test_every_nth_over_batches(spark, event_files):
    path, table = event_files
    got = jobs.run_to_table(slices.every_nth(stream(spark, path), 7, "10 minutes"), "t")
    want = seq.every_nth(table, 7)
    columns = ("user_id", "event_count", "window_start")
    assert rows(got, *columns) == rows(want, *columns)


def test_pattern_over_batches(spark, event_files):
    path, table = event_files
    first, second = F.col("value") == "rapid", F.col("value") == "fire"
    got = jobs.run_to_table(
        slices.followed_by(stream(spark, path), first, second, 30, "10 minutes"), "t"
    )
    want = seq.followed_by(table, first, second, 30)
    columns = ("user_id", "window_start", "window_end")
    assert rows(got, *columns) == rows(want, *columns)


def test_sessions_over_batches(spark, event_files):
    path, table = event_files
    got = jobs.run_to_table(jobs.gap_sessions(stream(spark, path), "30 seconds", "10 minutes"), "t")
    columns = ("user_id", "event_count", "window_start", "window_end")
    assert rows(got, *columns) == rows(seq.gap_sessions(table, 30), *columns)


def test_max_life_sessions(spark, event_files):
    path, table = event_files
    got = jobs.run_to_table(slices.max_life_sessions(stream(spark, path), 600, "10 minutes"), "t")
    want, starts = [], {}
    for r in sorted(table.collect(), key=lambda r: (r["ts"], r["id"])):
        start = starts.get(r["user_id"])
        if start is None or (r["ts"] - start).total_seconds() > 600:
            start = starts[r["user_id"]] = r["ts"]
        want.append((r["id"], start))
    assert rows(got, "id", "session_start") == sorted(want, key=repr)


def test_trailing_velocity_over_batches(spark, event_files):
    path, table = event_files

    def transactions(df):
        return df.select(
            F.col("id").alias("transaction_id"),
            "user_id",
            F.col("ts").alias("timestamp"),
            (F.col("id") % 50).cast("double").alias("amount"),
            F.lit("c").alias("merchant_category"),
            F.lit(1).cast("long").alias("merchant_id"),
        )

    got = jobs.run_to_table(
        slices.trailing_velocity(transactions(stream(spark, path)), 300, "10 minutes"), "t"
    )
    want = seq.velocity(transactions(table), {"1h": 300})
    columns = ("transaction_id", "transaction_count_1h", "total_amount_1h")
    assert rows(got, *columns) == rows(want, *columns)


def test_velocity_on_arrival_equals_batch_when_rows_come_in_order(spark, tmp_path):
    data = [(i, i % 3, datetime(2024, 1, 1) + timedelta(seconds=40 * i), None if i % 7 == 0 else float(i % 50), "c", 1) for i in range(90)]
    schema = "transaction_id long, user_id long, timestamp timestamp, amount double, merchant_category string, merchant_id long"
    table = spark.createDataFrame(data, schema)
    folder = str(tmp_path / "in")
    for part in range(3):
        table.where(f"transaction_id div 30 = {part}").coalesce(1).write.mode("append").parquet(folder)
    source = jobs.file_stream(spark, folder, table.schema, files_per_trigger=1)
    got = jobs.run_to_table(stateful.velocity_on_arrival(source, 300, "5 minutes"), "arrival")
    want = seq.velocity(table, {"1h": 300})
    columns = ["transaction_id", "transaction_count_1h", *[F.round(c, 6).alias(c) for c in ("total_amount_1h", "avg_amount_1h", "std_amount_1h")]]
    assert rows(got, *columns) == rows(want, *columns)


def test_last_revisions_do_not_depend_on_order_or_batches(spark, tmp_path):
    """Files in any order, one row per batch: the last score of each row equals the table's."""
    chance = random.Random(4)
    data = [
        (i, i % 2, START + timedelta(seconds=chance.randrange(900)), None if i % 7 == 0 else float(i % 50), "c", 1)
        for i in range(24)
    ]
    data += [(90, 0, START + timedelta(seconds=400), 5.0, "c", 1)] * 1
    schema = "transaction_id long, user_id long, timestamp timestamp, amount double, merchant_category string, merchant_id long"
    table = spark.createDataFrame(data, schema)
    want = seq.velocity(table, {"1h": 300})
    columns = ["transaction_id", "transaction_count_1h", *[F.round(c, 6).alias(c) for c in ("total_amount_1h", "avg_amount_1h", "std_amount_1h")]]
    results = []
    for number, per_file in enumerate((1, 9)):
        chance.shuffle(data)
        folder = str(tmp_path / f"in{number}")
        for k in range(0, len(data), per_file):
            spark.createDataFrame(data[k : k + per_file], schema).coalesce(1).write.mode("append").parquet(folder)
        source = jobs.file_stream(spark, folder, table.schema, files_per_trigger=1)
        got = jobs.run_to_table(stateful.velocity_on_arrival(source, 300, "1 hour"), f"revised{number}")
        first = got.where("revision = 0")
        assert first.count() == len(data) and first.where("before_transaction_count_1h IS NOT NULL").count() == 0
        assert got.where("revision > 0 AND before_transaction_count_1h >= transaction_count_1h").count() == 0
        assert rows(stateful.newest_revisions(got), *columns) == rows(want, *columns)
        results.append(got.where("revision > 0").count())
    assert min(results) > 0


def test_category_totals_with_corrections(spark, tmp_path):
    from tidemark.operators.aggregates import category_windows

    chance = random.Random(8)
    data = [(i, i % 3, START + timedelta(seconds=chance.randrange(1200)), 20000.0 if i % 4 else 3.0, "casino", 1) for i in range(60)]
    schema = "transaction_id long, user_id long, timestamp timestamp, amount double, merchant_category string, merchant_id long"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(0, 60, 12):
        spark.createDataFrame(data[k : k + 12], schema).coalesce(1).write.mode("append").parquet(folder)
    source = jobs.file_stream(spark, folder, spark.createDataFrame(data, schema).schema, files_per_trigger=1)
    scored = stateful.scored_stream(source, 3600.0, "2 hours", rapid=4)
    stored = str(tmp_path / "all")
    write = jobs.fan_out(applications.aggregated(jobs.append_batches(out)), jobs.append_batches(stored))
    jobs.finish(jobs.batches(scored, write, str(tmp_path / "cp")))
    everything = spark.read.parquet(stored)
    assert everything.where("before_risk_score <> risk_score").count() > 0
    final = stateful.newest_revisions(everything)
    assert final.count() == 60
    columns = ("window_start", "transaction_count", "total_amount", F.round("avg_risk_score", 6).alias("r"))
    assert rows(applications.category_totals(spark.read.parquet(out)), *columns) == rows(category_windows(final), *columns)


def test_idle_users_leave_the_state(spark, tmp_path):
    schema = "transaction_id long, user_id long, timestamp timestamp, amount double, merchant_category string, merchant_id long"
    folder = str(tmp_path / "in")
    for n, (user, day) in enumerate([(1, 0), (2, 0), (3, 5), (3, 10), (3, 11)]):
        row = [(n, user, START + timedelta(days=day), 1.0, "c", 1)]
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(folder)
    source = jobs.file_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_trigger=1)
    writer = jobs.batches(
        stateful.velocity_on_arrival(source, 300, "1 hour"), jobs.append_batches(str(tmp_path / "out")), str(tmp_path / "cp")
    )
    query = jobs.start(writer)
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    held = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "rows").load(str(tmp_path / "cp"))
    assert [r[0] for r in held.select("key.user_id").distinct().collect()] == [3]


def test_user_statistics(spark, event_files):
    path, table = event_files
    got = jobs.run_to_table(
        slices.user_statistics(stream(spark, path), 30, F.col("id"), "10 minutes"), "t"
    )
    last = got.groupBy("user_id").agg(F.max("event_count").alias("n"), F.max("session_count").alias("s"))
    want = seq.gap_sessions(table, 30).groupBy("user_id").agg(
        F.sum("event_count").alias("n"), F.count(F.lit(1)).alias("s")
    )
    assert rows(last.where("user_id < 99")) == rows(want)


@pytest.fixture
def one_large_user(spark, tmp_path):
    """Half of the rows belong to one user; a file per twenty rows, in any order within 200."""
    r = random.Random(11)
    data = [
        (i, START + timedelta(seconds=3 * i + r.randrange(3)), r.choice(["rapid", "fire", "x"]), 0 if i % 2 else r.randrange(1, 30))
        for i in range(1200)
    ]
    mixed = [row for k in range(0, 1200, 200) for row in r.sample(data[k : k + 200], 200)]
    path = str(tmp_path / "large")
    for k in range(0, 1200, 100):
        spark.createDataFrame(mixed[k : k + 100], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    final = [(10_000, START + timedelta(days=1), "x", 99)]
    spark.createDataFrame(final, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame(data, EVENT_SCHEMA)


def test_a_user_with_half_of_the_rows_is_sliced(spark, one_large_user):
    path, table = one_large_user

    def run(build, **options):
        streamed = build(stream(spark, path), delay="20 minutes", slice="2 minutes", **options)
        return jobs.run_to_table(streamed, "t").where("user_id < 99")

    got = run(slices.every_nth, n=9)
    columns = ("user_id", "event_count", "window_start")
    assert rows(got, *columns) == rows(seq.every_nth(table, 9), *columns)

    first, second = F.col("value") == "rapid", F.col("value") == "fire"
    got = run(slices.followed_by, first=first, second=second, within_seconds=400)
    columns = ("user_id", "window_start", "window_end")
    assert rows(got, *columns) == rows(seq.followed_by(table, first, second, 400), *columns)
    assert got.where("unix_micros(window_end) div 120000000 > unix_micros(window_start) div 120000000").count() > 0

    columns = ("id", "session_start")
    got = run(slices.max_life_sessions, life_seconds=500)
    assert rows(got, *columns) == rows(seq.fixed_life_sessions(table, 500), *columns)

    got = run(slices.user_statistics, gap_seconds=30, number=F.when(F.col("id") % 3 > 0, F.col("id")))
    last = got.groupBy("user_id").agg(F.max_by(F.struct("last_seen", "event_count", "avg_amount", "session_count"), "event_count").alias("s"))
    sessions = seq.gap_sessions(table, 30).groupBy("user_id").agg(F.count(F.lit(1)).alias("session_count"))
    sums = table.groupBy("user_id").agg(
        F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("event_count"),
        (F.sum(F.when(F.col("id") % 3 > 0, F.col("id"))) / F.count(F.lit(1))).alias("avg_amount"),
    )
    columns = ("user_id", "last_seen", "event_count", "avg_amount", "session_count")
    assert rows(last.select("user_id", "s.*"), *columns) == rows(sums.join(sessions, "user_id"), *columns)


def test_events_get_the_rule_of_their_time(spark, tmp_path):
    """Versions that come early, late (within the delay) and twice, over several batches."""
    chance = random.Random(6)
    event_schema = "id long, kind string, ts timestamp, note string"
    data = [
        (i, chance.choice(["a", "b", None]), START + timedelta(seconds=10 * i, microseconds=i), None if i % 5 else "n")
        for i in range(120)
    ]
    versions = [
        ("a", START + timedelta(seconds=100), 1, 0.5), ("a", START + timedelta(seconds=700), 2, None),
        (None, START + timedelta(seconds=300, microseconds=30), 3, 2.5), ("a", START + timedelta(days=9), 4, 1.0),
    ]
    places, rules = str(tmp_path / "events"), str(tmp_path / "rules")
    schema = "kind string, valid_from timestamp, version int, most double"
    for k in range(0, 120, 30):
        spark.createDataFrame(data[k : k + 30], event_schema).coalesce(1).write.mode("append").parquet(places)
    spark.createDataFrame([(999, "z", START + timedelta(days=1), None)], event_schema).coalesce(1).write.mode("append").parquet(places)
    # The version valid from second 100 arrives with the batch that ends at second 600.
    for row in ([versions[3], versions[2]], [versions[0]], [versions[1]], [versions[1]]):
        spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(rules)
    got = jobs.run_to_table(
        rule_versions.with_rule_versions(
            jobs.file_stream(spark, places, spark.createDataFrame([], event_schema).schema, files_per_trigger=1),
            jobs.file_stream(spark, rules, spark.createDataFrame([], schema).schema, files_per_trigger=1),
            "kind", delay="20 minutes", salts=3,
        ),
        "judged",
    ).where("id < 999")
    assert got.columns == ["id", "kind", "ts", "note", "version", "most"]
    want = []
    for row in data:
        valid = [v for v in versions if v[0] == row[1] and v[1] <= row[2]]
        want.append((*row, *(max(valid, key=lambda v: v[1])[2:] if valid else (None, None))))
    assert rows(got) == sorted(want, key=repr)


def test_lag_of_topics(spark):
    log = [
        ("q", "r", None, 0, "t", "s", None, '{"a":{"0":3}}', '{"a":{"0":5,"1":2}}', 3),
        ("q", "r", None, 1, "t", "s", None, '{"a":{"0":5,"1":1},"b":{"0":0}}', '{"a":{"0":9,"1":2},"b":{"0":7}}', 4),
    ]
    got = progress.topic_lag(spark.createDataFrame(log, progress.PROGRESS))
    assert rows(got, "topic", "partition", "lag") == [("a", 0, 4), ("a", 1, 1), ("b", 0, 7)]
    read = progress.rows_read(spark.createDataFrame(log, progress.PROGRESS))
    assert rows(read, "rows_read", "last_batch") == [(7, 1)]


def test_hourly_archive_and_fan_out(spark, event_files, tmp_path):
    path, table = event_files
    out = str(tmp_path / "archive")
    jobs.finish(jobs.archive(stream(spark, path), out, str(tmp_path / "c1"), hourly=True))
    assert spark.read.parquet(out).where("date = '2024-01-01'").count() == table.count()
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    both = jobs.fan_out(jobs.append_batches(one), jobs.append_batches(two))
    jobs.finish(jobs.batches(stream(spark, path), both, str(tmp_path / "c2")))
    assert spark.read.parquet(one).count() == spark.read.parquet(two).count() == table.count() + 1


def test_rules_late_rows_and_messages(spark, event_files):
    path, table = event_files
    rules = spark.createDataFrame([("rapid", 3)], "value string, limit long")
    joined = jobs.run_to_table(jobs.with_rules(stream(spark, path), rules, "value"), "t")
    assert joined.where("limit = 3").count() == table.where("value = 'rapid'").count()
    on_time, late = jobs.split_late(table, "ts", F.lit(START + timedelta(seconds=1800)))
    assert on_time.count() + late.count() == table.count() and late.count() > 0
    scored = table.withColumn("risk_score", F.when(F.col("value") == "fire", 0.6).otherwise(0.5))
    assert jobs.alert_messages(scored).count() == table.where("value = 'fire'").count()


def test_dead_letters_after_retries(spark, tmp_path):
    calls = []

    def broken(batch, batch_id):
        calls.append(batch_id)
        raise RuntimeError("no database")

    dead = str(tmp_path / "dead")
    databases.retrying(broken, dead, attempts=3, wait=0.0)(spark.range(3), 7)
    assert calls == [7, 7, 7]
    assert spark.read.parquet(dead).where("error LIKE '%no database%'").count() == 3
    with pytest.raises(RuntimeError):
        databases.retrying(broken, attempts=1)(spark.range(1), 1)


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = databases.retrying(databases.file_batch(str(tmp_path / "m")))
    for _ in range(2):
        write(spark.range(3), 1)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 3


def test_previous_day_query():
    assert "CURRENT_DATE - INTERVAL '1 day'" in databases.previous_day_query("transactions")


def test_decoding_skips_bad_records(spark):
    data = [
        ('{"id": 1, "ts": "2024-01-01T00:00:00+00:00", "value": "a", "user_id": 1}',),
        ('{"id": 2, "ts": 1704067200000, "value": "a", "user_id": 1}',),
        ('{"id": 3, "ts": "junk", "value": "a", "user_id": 1}',),
        ("not json",),
    ]
    got = messages.decode_events(spark.createDataFrame(data, "value string"))
    assert rows(got, "id", "ts") == [(1, START), (2, START)]


def test_storage(spark, tmp_path):
    df = spark.range(20).select(
        "id", (F.lit(START) + F.make_dt_interval(F.col("id") * 10)).alias("timestamp")
    )
    base = str(tmp_path / "lake")
    lake.write_by_day(df, base)
    assert spark.read.parquet(base + "/parquet").where("year = '2024' AND month = '02'").count() == 2
    for form in ("orc", "parquet"):
        lake.write_as(df, str(tmp_path / form), form, "snappy")
        assert spark.read.format(form).load(str(tmp_path / form)).count() == 20
    plain = str(tmp_path / "plain")
    lake.write_by_column(df, plain)
    assert lake.read_parquet_only(spark, plain + "/parquet").count() == 20
    combined = lake.combine_staged(spark, [plain + "/parquet", str(tmp_path / "absent")])
    assert combined.count() == 20
    sizes = lake.archive_old(
        spark, plain + "/parquet", str(tmp_path / "old"), str(tmp_path / "new"),
        F.lit(datetime(2024, 6, 1)).cast("timestamp"), 90,
    )
    assert sizes["kept_rows"] + sizes["archived_rows"] == 20 and sizes["archived_rows"] == 7
    volume = rows(lake.storage_volume(spark, [plain + "/json"]))
    assert volume[0][1] >= 1 and volume[0][2] > 0


def test_a_failure_before_the_switch_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    def whole(df):
        return rows(df, "transaction_id", "date", "amount")

    data = spark.range(60).select(
        F.col("id").alias("transaction_id"), F.col("id").cast("double").alias("amount"),
        (F.lit(START).cast("timestamp") + F.make_dt_interval(hours=F.col("id"))).alias("timestamp"),
    ).withColumn("date", F.when(F.col("transaction_id") < 55, F.to_date("timestamp")))

    class Died(Exception):
        pass

    def dies(*_):
        raise Died

    archive, as_of = str(tmp_path / "archive"), F.lit(START + timedelta(hours=30)).cast("timestamp")
    switched.create_table(data, "kept_rows", str(tmp_path / "kept"), ["date"])
    root = str(tmp_path / "root")
    switched.create_partitioned(data, root, "kept_parts", "date")
    changes = data.where("transaction_id in (1, 30, 58)").withColumns(
        {"date": F.when(F.col("transaction_id") == 1, F.lit(None)).otherwise(F.lit("2024-02-01")).cast("date"), "amount": F.lit(-1.0)}
    ).select(*data.columns)

    def archived():
        switched.archive_in_place(spark, "kept_rows", archive, as_of, 0)

    def changed():
        switched.upsert_partitioned(root, "kept_parts", changes, "transaction_id", "timestamp", "date")

    def parts():
        return switched.read_partitioned(spark, root, "kept_parts", "date", data.schema)

    before = whole(data)
    with monkeypatch.context() as patch:
        patch.setattr(switched, "switch_location", dies)
        for attempt in (archived, changed):
            with pytest.raises(Died):
                attempt()
    assert whole(spark.table("kept_rows")) == before and whole(parts()) == before
    archived()
    changed()
    assert whole(spark.table("kept_rows")) == whole(data.where("transaction_id >= 30"))
    old = spark.read.parquet(archive)
    assert rows(old, "transaction_id") == rows(data.where("transaction_id < 30"), "transaction_id")
    want = data.join(changes.select("transaction_id"), "transaction_id", "left_anti").select(*data.columns).unionByName(changes)
    assert whole(parts()) == whole(want)
    kept = {v for (_, v) in rows(spark.table("kept_parts"), "value", "version")}
    assert len(kept) == 2  # untouched partitions are still the first version's
    with pytest.raises(ValueError, match="lists the partitions"):
        data.write.partitionBy("date").format("parquet").saveAsTable("listed_rows")
        switched.archive_in_place(spark, "listed_rows", archive, as_of, 0)
    for name in ("kept_rows", "kept_parts", "listed_rows"):
        spark.sql(f"DROP TABLE {name}")


def test_tables(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    lake.replace_table(df, "plain_numbers")
    lake.replace_table(df, "plain_numbers")
    lake.bucketed_table(df, "bucketed_numbers", "id", 4)
    joined = spark.table("bucketed_numbers").hint("merge").join(
        spark.table("bucketed_numbers").withColumnRenamed("part", "p2"), "id"
    )
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    location = str(tmp_path / "ext")
    df.write.partitionBy("part").parquet(location)
    ext = lake.external_table(spark, "ext_numbers", "id BIGINT, part BIGINT", "part", location)
    assert ext.count() == 10
    for name in ("plain_numbers", "bucketed_numbers", "ext_numbers"):
        spark.sql(f"DROP TABLE {name}")


def test_log_files(spark, tmp_path):
    lines = spark.createDataFrame([(START, "b"), (START - timedelta(1), "a")], "ts timestamp, value string")
    files.write_log(lines.coalesce(1), str(tmp_path / "log"))
    assert [r[0] for r in files.read_lines(spark, str(tmp_path / "log")).collect()] == ["a", "b"]


def test_warehouse(spark, folder):
    from tidemark.model import raw_events

    built = warehouse.build(spark, raw_events(spark, folder), prefix="t_")
    assert warehouse.staging_tests(built["stg_events"]).where("NOT success").count() == 0
    assert warehouse.mart_tests(built["daily_event_metrics"]).where("NOT success").count() == 0
    assert [r[0] for r in built["volume_stats"].collect()] == [
        "daily_event_metrics", "raw_events", "stg_events",
    ]
    for name in ("t_daily_event_metrics", "t_volume_stats"):
        spark.sql(f"DROP TABLE {name}")


def test_report_tables(spark, folder):
    from tidemark.queries.reports import located
    from tidemark.model import users

    names = reports.build_reports(spark, located(spark, folder), users(spark, folder), "r_")
    samples = reports.sample_results(spark, names)
    assert len(names) == 5 and all(df.count() >= 1 for df in samples.values())
    for name in names[:-1]:
        spark.sql(f"DROP TABLE {name}")


def test_schema_drift(spark):
    df = spark.createDataFrame([], METRICS_SCHEMA)
    assert require_schema(df, METRICS_SCHEMA) is df
    with pytest.raises(ValueError):
        require_schema(df.drop("user_id"), METRICS_SCHEMA)


def brandes(adjacency):
    """Betweenness of a small weighted graph, all pivots."""
    import heapq

    nodes = sorted(adjacency)
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, sigma, preds, order, seen = {}, dict.fromkeys(nodes, 0.0), {n: [] for n in nodes}, [], {s: 0.0}
        sigma[s] = 1.0
        queue = [(0.0, s, s)]
        while queue:
            d, p, v = heapq.heappop(queue)
            if v in dist:
                continue
            if v != s:
                sigma[v] += 0
            dist[v] = d
            order.append(v)
            for w, c in adjacency[v].items():
                nd = round(d + c, 9)
                if w not in dist and (w not in seen or nd < seen[w]):
                    seen[w] = nd
                    heapq.heappush(queue, (nd, v, w))
                    sigma[w], preds[w] = sigma[v], [v]
                elif w not in dist and nd == seen[w]:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        for w in reversed(order):
            for v in preds[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                score[w] += delta[w]
    n = len(nodes)
    return {v: x / ((n - 1) * (n - 2)) for v, x in score.items()}


def test_betweenness_equals_brute_force(spark):
    r = random.Random(11)
    links = {(f"u{r.randrange(6)}", f"m{r.randrange(5)}") for _ in range(14)}
    data = [(a, b, float(r.randrange(1, 4))) for a, b in sorted(links)]
    adjacency = {}
    for a, b, w in data:
        adjacency.setdefault(a, {})[b] = w
        adjacency.setdefault(b, {})[a] = w
    edges = spark.createDataFrame(data, "src string, dst string, weight double")
    got = {r["node"]: r["betweenness_centrality"] for r in graph.betweenness(edges).collect()}
    want = brandes(adjacency)
    assert got.keys() == want.keys()
    for node in want:
        assert got[node] == pytest.approx(want[node], abs=1e-9)


def test_betweenness_of_many_parts(spark, monkeypatch):
    from tidemark.operators import centrality

    for name, least in (("EDGES_A_PART", 6), ("CHUNK", 2), ("ROWS_A_BUCKET", 9)):
        monkeypatch.setattr(centrality, name, least)
    r = random.Random(12)
    weights = {}
    for _ in range(26):
        a, b = sorted(r.sample(range(14), 2))
        weights[f"n{a}", f"n{b}"] = r.randrange(1, 4) / 10
    weights["far", "away"] = 0.3
    adjacency = {}
    for (a, b), w in weights.items():
        adjacency.setdefault(a, {})[b] = w
        adjacency.setdefault(b, {})[a] = w
    # A second and longer edge the other way, a loop.
    data = [(a, b, w) for (a, b), w in weights.items()] + [("away", "far", 0.5), ("far", "far", 0.1)]
    edges = spark.createDataFrame(data, "src string, dst string, weight double")
    got = {r["node"]: r["betweenness_centrality"] for r in graph.betweenness(edges).collect()}
    # Tenths as whole numbers, since the brute force compares sums exactly.
    want = brandes({a: {b: round(10 * w) for b, w in n.items()} for a, n in adjacency.items()})
    assert got == {node: pytest.approx(value, abs=1e-9) for node, value in want.items()}


def test_betweenness_of_a_pivot_at_an_edge_without_weight(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    pivot = graph.pivots(names, 1).first()["node"]
    near, end = sorted({"a", "b", "c"} - {pivot})
    edges = spark.createDataFrame([(pivot, near, 0.0), (near, end, 1.0)], "src string, dst string, weight double")
    got = {r["node"]: r["betweenness_centrality"] for r in graph.betweenness(edges, k=1).collect()}
    assert got == {pivot: 0.0, near: 1.5, end: 0.0}


def test_last_amount_is_the_weight(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, START, 5.0), (2, 1, 1, START + timedelta(1), 3.0)],
        "transaction_id long, user_id long, merchant_id long, timestamp timestamp, amount double",
    )
    assert rows(graph.user_merchant_edges(df)) == [("user_1", "merchant_1", 3.0)]


@pytest.mark.parametrize("mode", ["plain", "split"])
def test_communities_equal_union_find(spark, request, mode):
    r = random.Random(4)
    # A long chain, a star with most of the edges, and random pieces.
    links = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(100, 120)]
    links += [("hub", f"s{i:03d}") for i in range(60)]
    links += [(f"p{r.randrange(40):02d}", f"q{r.randrange(40):02d}") for _ in range(25)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    want = sorted((n, find(n)) for n in parent)
    if mode == "split":
        request.getfixturevalue("hot")
    edges = spark.createDataFrame(links, "src string, dst string")
    assert rows(graph.communities(edges)) == want


@pytest.mark.parametrize("order", ["random", "adverse"])
def test_communities_of_a_long_chain_in_few_rounds(spark, monkeypatch, order):
    import random

    from tidemark.operators import components

    names = [f"{i:04d}" for i in range(1000)]
    names = random.Random(3).sample(names, 1000) if order == "random" else [names[0], *names[:0:-1]]
    rounds = []
    monkeypatch.setattr(components, "cut_lineage", lambda df: rounds.append(1) or df.checkpoint())
    edges = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "src string, dst string")
    found = graph.communities(edges).collect()
    assert len(found) == 1000 and {r["community"] for r in found} == {"0000"}
    assert len(rounds) <= 25


def test_ancestors_with_shared_parents_and_cycles(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("x", "y")], "src string, dst string"
    )
    assert rows(graph.ancestors(edges, "d")) == [("a",), ("b",), ("c",), ("d",)]


@pytest.fixture(scope="module")
def training(spark):
    df = spark.range(2000).select(
        "id",
        (F.xxhash64("id", F.lit(1)) % 1000 + 1000).alias("user_id"),
        (F.xxhash64("id", F.lit(2)) % 500 + 500).alias("item_id"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(24)).alias("hour_of_day"),
        F.pmod(F.xxhash64("id", F.lit(4)), F.lit(7)).alias("day_of_week"),
    )
    return df.withColumn("label", (F.col("user_id") + F.col("item_id") > 1600).cast("int"))


def test_logistic_round_trip(spark, training, tmp_path):
    model = models.fit_logistic(training)
    models.save(model, str(tmp_path / "m"))
    scored = models.score(training, models.load(str(tmp_path / "m")))
    low, high = scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= low <= high <= 1
    assert scored.where("prediction = label").count() > 1900
    with pytest.raises(models.ModelUnavailable):
        models.load(str(tmp_path / "absent"))


def test_split_and_boosted(spark, training):
    train, test = models.stratified_split(training)
    assert train.count() + test.count() == 2000 and 300 < test.count() < 500
    model, auc, importance = models.fit_boosted(training, models.FEATURES, rounds=5, depth=3)
    assert auc > 0.9
    values = [r["importance"] for r in importance.collect()]
    assert values == sorted(values, reverse=True)


def test_rounds_end_at_the_least_loss_within_patience():
    assert models.rounds_kept([3.0, 2.0, 2.5, 1.0, 1.5, 1.5], 2) == (4, True)
    assert models.rounds_kept([3.0, 2.0, 2.5, 2.5, 1.0], 2) == (2, True)
    assert models.rounds_kept([3.0, 2.0, 2.0, 2.0], 3) == (2, False)
    assert models.rounds_kept([1.0], 5) == (1, False)


def test_boosted_trees_wait_and_are_cut(spark, training):
    # High rates overfit the noise bit soon, so later rounds are cut off.
    chosen = dict(depth=4, rate=0.9, rounds=24)
    model, _, _ = models.fit_boosted(training, models.FEATURES, patience=3, **chosen)
    kept = model.stages[-1].getNumTrees
    _, test = models.stratified_split(training)
    held = model.stages[0].transform(test.withColumn("weight", F.lit(1.0)))
    losses = model.stages[-1].evaluateEachIteration(held)
    assert len(losses) == kept < 24 and losses[-1] == min(losses)


def test_forest(training):
    forest = models.fit_forest(training, models.FEATURES, trees=5, depth=5)
    assert models.auc(forest.transform(training)) > 0.9


def test_gradient_of_the_network():
    chance = np.random.default_rng(0)
    start = network._start(("a", "b", "c"), (5, 4), np.zeros(3), np.ones(3), 1)
    x, y, weight = chance.normal(size=(20, 3)), chance.integers(0, 2, 20), chance.random(20)
    _, gradient = start.loss_and_gradient(x, y, weight)
    values = start.flat()
    for i in range(len(values)):
        step = np.zeros_like(values)
        step[i] = 1e-6
        up, down = (start.with_flat(values + s).loss_and_gradient(x, y, weight)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - gradient[i]) < 1e-5


def test_a_weight_is_as_good_as_copies(spark, training):
    chance = np.random.default_rng(2)
    start = network._start(("a", "b"), (5,), np.zeros(2), np.ones(2), 1)
    x, y = chance.normal(size=(30, 2)), chance.integers(0, 2, 30)
    copies = np.where(y == 1, 3, 1)
    loss, gradient = start.loss_and_gradient(x, y, copies.astype(float))
    again, other = start.loss_and_gradient(np.repeat(x, copies, axis=0), np.repeat(y, copies), np.ones(copies.sum()))
    assert loss == pytest.approx(again) and gradient == pytest.approx(other)
    with pytest.raises(ValueError):
        network.fit_weighted(training.limit(0), training, models.FEATURES)


def test_network_ranks_and_stops(spark, training):
    train, test = models.stratified_split(training)
    fitted, losses = network.fit_weighted(train, test, models.FEATURES, hidden=(8,), positive_weight=2.0, rounds=40)
    scored = models.predict_batches(test, fitted.probability, models.FEATURES, id="id")
    assert models.auc(test.select("id", "label").join(scored, "id"), raw="probability") > 0.8
    # A rate that overshoots ends after the rounds of patience.
    _, losses = network.fit_weighted(train, test, models.FEATURES, hidden=(8,), rounds=40, patience=3, rate=30.0)
    best = min(range(len(losses)), key=lambda i: losses[i][1])
    assert len(losses) < 40 and len(losses) == best + 4


def test_interaction_label_is_binary(training):
    labels = training.select(models.interaction_label().alias("l")).distinct().collect()
    assert {r["l"] for r in labels} <= {0, 1}


def test_scoring_a_stream(spark, training, tmp_path):
    path = str(tmp_path / "rows")
    training.coalesce(2).write.parquet(path)
    scored = models.score(jobs.file_stream(spark, path, training.schema), models.fit_logistic(training))
    out = jobs.run_to_table(scored.select("id", "probability", "prediction"), "scored")
    assert out.count() == 2000


def test_decisions(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 10000.0, "casino", 12, START, None), (2, 1, None, 1.0, "food", 12, START, 0.9),
         (3, 1, 1, 1.0, "food", 12, START, 0.9)],
        "transaction_id long, user_id long, merchant_id long, amount double, merchant_category string, "
        "hour_of_day int, timestamp timestamp, probability double",
    )
    got = {r["transaction_id"]: r for r in detector.decide_each(df, probability="probability").collect()}
    assert got[1]["fraud_probability"] == pytest.approx(0.6) and not got[1]["is_fraud"]
    assert got[2]["error"] == "missing merchant_id" and got[2]["fraud_probability"] == 0.0
    assert got[3]["is_fraud"] and got[3]["error"] is None


def test_event_application(spark, event_files, tmp_path):
    path, table = event_files
    messages_ = stream(spark, path).select(
        F.to_json(F.struct("id", "ts", "value", "user_id")).cast("binary").alias("value")
    )
    counts = str(tmp_path / "counts")
    writers = applications.event_application(
        messages_, str(tmp_path / "raw"), jobs.append_batches(counts), str(tmp_path / "cp")
    )
    for writer in writers.values():
        jobs.finish(writer)
    assert spark.read.parquet(str(tmp_path / "raw")).count() == table.count() + 1
    merged = jobs.newest_by_batch(spark, counts, ["window_start", "window_end"])
    assert merged.agg(F.sum("event_count")).first()[0] == table.count() + 1


def test_metrics_application(spark, event_files, tmp_path):
    path, table = event_files
    writers = applications.metrics_application(
        stream(spark, path), lambda name: jobs.append_batches(str(tmp_path / name)), str(tmp_path / "cp")
    )
    for writer in writers.values():
        jobs.finish(writer)
    windows = spark.read.parquet(str(tmp_path / "window_metrics"))
    assert set(METRICS_SCHEMA.fieldNames()) <= set(windows.columns) and windows.count() > 0
    sessions = spark.read.parquet(str(tmp_path / "session_metrics"))
    assert sessions.agg(F.sum("event_count")).first()[0] > 0


def test_category_sums_add_up_over_batches(spark, event_files, tmp_path):
    path, table = event_files

    def scored(df):
        return df.select(
            F.col("ts").alias("timestamp"),
            F.col("value").alias("merchant_category"),
            F.lit(2.0).alias("amount"),
            F.lit(0.5).alias("risk_score"),
        )

    out = str(tmp_path / "sums")
    jobs.finish(
        jobs.batches(
            scored(stream(spark, path)),
            applications.aggregated(jobs.append_batches(out)),
            str(tmp_path / "cp"),
        )
    )
    from tidemark.operators.aggregates import category_windows

    got = applications.category_totals(spark.read.parquet(out)).where("window_start < '2024-01-02'")
    assert rows(got) == rows(category_windows(scored(table)))


def test_daily_run(spark, folder, tmp_path):
    from tidemark.model import fraud_transactions
    from tidemark.operators import quality as q

    staged = str(tmp_path / "staged")
    fraud_transactions(spark, folder).write.parquet(staged)
    arguments = (str(tmp_path / "wh"), str(tmp_path / "features"), "2024-01-10")
    built = daily.daily_run(spark, [staged, str(tmp_path / "none")], lambda df: [q.unique("transaction_id")], *arguments)
    assert all(df.count() > 0 for df in built.values())
    assert [str(r[0]) for r in spark.read.parquet(arguments[0]).select("date").distinct().collect()] == ["2024-01-10"]
    with pytest.raises(q.QualityError):
        daily.daily_run(spark, [staged], lambda df: [q.mean_between("amount", 0, 1)], *arguments)


def test_fraud_stream_from_messages(spark, event_files, tmp_path):
    """Text ids, as they arrive in messages, go through decoding, state, rules and alerts."""
    path, table = event_files
    body = F.struct(
        F.concat(F.lit("TXN_"), "id").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.concat(F.lit("U"), "user_id").alias("user_id"),
        F.lit(20000.0).alias("amount"),
        F.lit("casino").alias("merchant_category"),
    )
    sent = stream(spark, path).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    bad = spark.createDataFrame([("k", "no json"), ("k", '{"transaction_id": "x"}')], "key string, value string")
    bad.selectExpr("cast(key as binary) key", "cast(value as binary) value", "timestamp_seconds(0) timestamp").write.parquet(str(tmp_path / "bad-in"))
    broken = jobs.file_stream(spark, str(tmp_path / "bad-in"), sent.schema)
    seen = []
    write_all = jobs.archive_batches(str(tmp_path / "all"))
    writers = applications.fraud_application(
        sent.unionByName(broken),
        lambda batch, n: (seen.append(batch.count()), write_all(batch, n)),
        jobs.append_batches(str(tmp_path / "alerts")),
        jobs.append_batches(str(tmp_path / "agg")),
        str(tmp_path / "cp"),
        jobs.append_batches(str(tmp_path / "bad")),
    )
    assert list(writers) == ["transactions", "undecodable"]
    for writer in writers.values():
        jobs.finish(writer)
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    everything = spark.read.parquet(str(tmp_path / "all"))
    scored = everything.where("transaction_id <> 'TXN_10000'")  # the event that ends the files
    assert scored.count() == table.count() == everything.count() - 1
    assert scored.where("transaction_id LIKE 'TXN_%' AND rule_high_amount AND date IS NOT NULL").count() == table.count()
    # Every batch that brought transactions has its own rows and alerts at once.
    counts = dict(everything.groupBy("batch_id").count().collect())
    assert [counts.get(n, 0) for n in range(len(seen))] == seen and sum(seen) == everything.count()
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    assert alerts.count() == jobs.suspicious(everything).count()
    assert jobs.alert_messages(scored).count() > 0
