"""Parsing, routing, windowed counts and serving of events."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from tillwright.plans.kpis import total_product_views
from tillwright.schemas import ROUTED_TABLES
from tillwright.sinks.compaction import compact_folder, compact_new_files, compact_run, retire_originals, row_checksum
from tillwright.sinks.warehouse import point_table_at, register_compacted, register_event_tables
from tillwright.sources import sample_feed as feed
from tillwright.sources.events import event_source, kafka_options
from tillwright.streaming import late_rows, parse, queries, serving, window_counts


def view(product="p1", time="2024-01-01T10:00:00", **more):
    return json.dumps({"eventType": "productView", "customerId": "c1", "productId": product, "timestamp": time, **more})


def messages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def parsed(spark, *texts):
    return [row.asDict() for row in parse.parse_events(messages(spark, *texts)).collect()]


def at(text):
    return dt.datetime.fromisoformat(text)


# parsing and routing


def test_fields_of_the_wrong_type_are_null_alone(spark):
    row, = parsed(spark, '{"eventType":"addToCart","quantity":"3","timestamp":"zzz","productId":"p"}')
    assert (row["eventType"], row["productId"], row["quantity"], row["timestamp"]) == ("addToCart", "p", None, None)


@pytest.mark.parametrize("text", ["no json", '{"eventType":"vi', "[1]", "", None, "{}"])
def test_text_that_is_no_event_gives_nulls(spark, text):
    row, = parsed(spark, text)
    assert set(row.values()) == {None}


def test_unknown_fields_are_ignored_and_missing_metadata_is_null(spark):
    events = parse.parse_events(messages(spark, view(extra=1, metadata={"category": "a"})))
    row = parse.route(events, "product_view").first()
    assert (row["category"], row["source"], row["timestamp"]) == ("a", None, at("2024-01-01T10:00:00"))
    assert parse.route(events, "product_view").columns == ROUTED_TABLES["product_view"].names


def test_bytes_are_read_as_text(spark):
    binary = messages(spark, view()).select(F.col("value").cast("binary").alias("value"))
    assert parse.parse_events(binary).first()["eventType"] == "productView"


def test_every_message_is_routed_once_or_unrouted(spark):
    texts = [view(), '{"eventType":"addToCart"}', '{"eventType":"purchase"}', '{"eventType":"recommendationClick"}',
             '{"eventType":"other"}', "broken", None, "{}"]
    events = parse.parse_events(messages(spark, *texts), keep_value=True)
    routed = {table: parse.route(events, table).count() for table in ROUTED_TABLES}
    assert routed == dict.fromkeys(ROUTED_TABLES, 1)
    left = parse.unrouted(events).collect()
    assert sorted((row["value"] for row in left), key=repr) == sorted(['{"eventType":"other"}', "broken", None, "{}"], key=repr)


def test_a_message_is_parsed_once_under_a_filter(spark):
    routed = parse.route(parse.parse_events(messages(spark, view())), "purchase")
    assert routed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_counts_parse_only_the_fields_they_read(spark):
    counted = window_counts.event_counts(parse.parse_events(messages(spark, view()), fields=window_counts.EVENT_COUNT_FIELDS))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert "from_json(StructField(eventType,StringType,true), StructField(timestamp,TimestampType,true)," in plan


def test_kafka_options():
    plain = kafka_options("host:9092", "shop")
    assert plain == {"kafka.bootstrap.servers": "host:9092", "subscribe": "shop", "startingOffsets": "earliest"}
    safe = kafka_options("host:9092", "shop", "u", "s", starting="latest", most_per_trigger=10)
    assert safe["kafka.security.protocol"] == "SASL_SSL" and safe["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="u" password="s"' in safe["kafka.sasl.jaas.config"]
    assert (safe["startingOffsets"], safe["maxOffsetsPerTrigger"]) == ("latest", "10")


def test_jdbc_options():
    options = serving.jdbc_options("jdbc:x", "t", "d", "u", "s")
    assert options == {"url": "jdbc:x", "dbtable": "t", "driver": "d", "user": "u", "password": "s"}


def test_jdbc_versions_are_appended_with_their_batch(spark, monkeypatch):
    """No database here: what would be handed to the JDBC writer."""
    seen = {}

    class Writer:
        def __init__(self, frame):
            seen["columns"] = frame.dtypes
            seen["tasks"] = frame.rdd.getNumPartitions()

        def format(self, kind):
            seen["kind"] = kind
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def options(self, **options):
            seen["options"] = options
            return self

        def save(self):
            seen["saved"] = True

    counted = window_counts.event_counts(parse.parse_events(messages(spark, view())))
    monkeypatch.setattr(type(counted), "write", property(Writer))
    options = serving.jdbc_options("jdbc:x", "t", "d", "u", "s")
    serving.version_writer(lambda batch: window_counts.flat_window(batch, "eventType"), "jdbc", options, tasks=3)(counted, 7)
    assert seen == {
        "tasks": 3,
        "columns": [("window_start", "timestamp"), ("window_end", "timestamp"), ("eventType", "string"),
                    ("count", "bigint"), ("batch_id", "bigint")],
        "kind": "jdbc", "mode": "append", "options": options, "saved": True,
    }


# streams


@pytest.fixture
def inbox(spark, tmp_path):
    """Appends messages to a folder that a stream reads."""

    class Inbox:
        path = str(tmp_path / "inbox")

        def put(self, *texts):
            messages(spark, *texts).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            return event_source(spark, "parquet", path=self.path)

        def events(self):
            return parse.parse_events(self.stream())

    return Inbox()


def test_text_files_are_a_source(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.txt").write_text(view() + "\n" + view("p2") + "\n")
    rows = parse.parse_events(event_source(spark, "text", path=str(tmp_path / "log")))
    queries.start_file_sink(rows, str(tmp_path / "o"), str(tmp_path / "c"), every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_routes_restart_without_loss_or_copies(spark, inbox, tmp_path):
    out, checkpoints = str(tmp_path / "out"), str(tmp_path / "checkpoints")
    for number in range(3):
        inbox.put(view(f"p{number}"), '{"eventType":"purchase","totalAmount":1.5}', "broken")
        started = queries.start_routes(inbox.stream(), out, checkpoints, every=None, with_unrouted=True)
        queries.await_all(list(started.values()))
    count = lambda table: spark.read.parquet(f"{out}/{table}").count()
    assert {t: count(t) for t in [*ROUTED_TABLES, "unrouted"]} == {
        "product_view": 3, "add_to_cart": 0, "purchase": 3, "recommendation_click": 0, "unrouted": 3,
    }


def test_router_writes_the_same_as_the_routes(spark, inbox, tmp_path):
    for number in range(2):
        inbox.put(view(f"p{number}"), '{"eventType":"purchase","totalAmount":1.5}', "broken")
        queries.start_router(inbox.stream(), str(tmp_path / "out"), str(tmp_path / "c"), every=None).awaitTermination()
    read = lambda table: spark.read.parquet(str(tmp_path / "out" / table))
    assert sorted(row["productId"] for row in read("product_view").collect()) == ["p0", "p1"]
    assert read("purchase").agg(F.sum("totalAmount")).first()[0] == 3.0
    assert [row["value"] for row in read("unrouted").collect()] == ["broken", "broken"]


def test_a_failing_query_stops_the_others(spark, inbox, tmp_path):
    inbox.put(view())

    def fail(batch, batch_id):
        raise ValueError("no")

    good = queries.start_file_sink(inbox.events(), str(tmp_path / "o"), str(tmp_path / "c1"), every="1 hour")
    bad = queries.start_batch_sink(inbox.events(), fail, "append", str(tmp_path / "c2"), every=None)
    with pytest.raises(Exception, match="no"):
        queries.await_all([good, bad])
    assert not good.isActive


def test_external_tables(spark, inbox, tmp_path):
    inbox.put(view(), view("p2"))
    out = str(tmp_path / "out")
    started = queries.start_routes(inbox.stream(), out, str(tmp_path / "c"), every=None)
    queries.await_all(list(started.values()))
    database = f"stream_{uuid.uuid4().hex}"
    for _ in range(2):
        register_event_tables(spark, {t: f"{out}/{t}" for t in ROUTED_TABLES}, database, str(tmp_path / "db"))
    assert total_product_views(spark.table(f"{database}.product_view")).first()[0] == 2
    assert spark.table(f"{database}.purchase").count() == 0

    compact_folder(spark, f"{out}/product_view", str(tmp_path / "compacted"))
    point_table_at(spark, f"{database}.product_view", str(tmp_path / "compacted"))
    assert total_product_views(spark.table(f"{database}.product_view")).first()[0] == 2


# windowed counts


def counts_by_key(frame, key):
    return {(row["window_start"], row[key]): row["count"] for row in frame.collect()}


def serve(inbox, tmp_path, aggregate, mode, key):
    write = serving.version_writer(
        lambda batch: window_counts.flat_window(batch, key), "parquet", {"path": str(tmp_path / "served")}
    )
    return queries.start_batch_sink(aggregate(inbox.events()), write, mode, str(tmp_path / "c"), every=None)


def test_update_mode_serves_the_newest_count_of_a_key(spark, inbox, tmp_path):
    for number in range(3):
        inbox.put(view(time="2024-01-01T10:00:00"), view(time=f"2024-01-01T10:0{number}:30"), view(time=None))
        serve(inbox, tmp_path, window_counts.event_counts, "update", "eventType").awaitTermination()
    versions = spark.read.parquet(str(tmp_path / "served"))
    assert versions.count() == 3
    newest = serving.latest_versions(versions, ["window_start", "window_end", "eventType"])
    assert counts_by_key(newest, "eventType") == {(at("2024-01-01T10:00:00"), "productView"): 6}


def test_replayed_batch_reads_as_once(spark, tmp_path):
    write = serving.version_writer(lambda batch: batch, "parquet", {"path": str(tmp_path / "v")})
    batch = lambda n: spark.createDataFrame([("a", n), ("b", n)], "key string, count long")
    write(batch(1), 0)
    write(batch(2), 1)
    write(batch(2), 1)
    versions = spark.read.parquet(str(tmp_path / "v"))
    assert sorted(map(tuple, serving.latest_versions(versions, ["key"]).collect())) == [("a", 2), ("b", 2)]
    assert sorted(map(tuple, serving.latest_batch(versions).collect())) == [("a", 2), ("b", 2)]


def test_database_view_is_the_same_as_latest_versions(spark):
    rows = [("a", 1, 0), ("a", 2, 1), ("a", 2, 1), ("b", 5, 0)]
    newest = serving.latest_versions(spark.createDataFrame(rows, "key string, count long, batch_id long"), ["key"])
    con = duckdb.connect()
    con.execute("CREATE TABLE versions (key VARCHAR, count BIGINT, batch_id BIGINT)")
    con.executemany("INSERT INTO versions VALUES (?, ?, ?)", rows)
    con.execute(serving.latest_versions_view("newest", "versions", ["key"], ["count"]))
    assert sorted(con.execute("SELECT key, count FROM newest").fetchall()) == sorted(map(tuple, newest.collect()))


def test_late_events_are_dropped_behind_the_watermark(spark, inbox, tmp_path):
    run = lambda: serve(inbox, tmp_path, window_counts.event_counts, "update", "eventType").awaitTermination()
    inbox.put(view(time="2024-01-01T10:05:00"), view(time="2024-01-01T10:21:00"))  # watermark 10:19
    run()
    inbox.put(view(time="2024-01-01T10:09:00"), view(time="2024-01-01T10:18:00"))  # closed, still open
    run()
    newest = serving.latest_versions(spark.read.parquet(str(tmp_path / "served")), ["window_start", "window_end", "eventType"])
    assert {start.strftime("%H:%M"): n for (start, _), n in counts_by_key(newest, "eventType").items()} == {
        "10:00": 1, "10:10": 1, "10:20": 1,
    }


def rankings(spark, folder):
    rows = spark.read.parquet(folder).collect()
    return sorted((row["window_start"].strftime("%H:%M"), row["rank"], row["productId"], row["count"]) for row in rows)


@pytest.mark.parametrize("parts", [1, 64])
def test_rankings_are_written_once_per_closed_window(spark, inbox, tmp_path, parts):
    out = str(tmp_path / "out")
    for hour in (10, 11, 12):
        inbox.put(*[view(f"p{n % 7}", time=f"2024-01-01T{hour}:{n:02}:00") for n in range(25)])
        inbox.put(view(None, time=f"2024-01-01T{hour}:01:00"), view("late", time="2024-01-01T09:00:00"))
        top = window_counts.top_products_per_window(inbox.events(), 3, parts)
        queries.start_file_sink(top, out, str(tmp_path / "c"), every=None).awaitTermination()
    # 7 products in 25 minutes: p0 to p3 have 4 views each.  The window of 12:00 is open.
    best = [(1, "p0", 4), (2, "p1", 4), (3, "p2", 4)]
    assert rankings(spark, out) == [("09:00", 1, "late", 1)] + [(f"{hour}:00", *row) for hour in (10, 11) for row in best]


def test_late_rows_go_to_the_side_table_and_counts_reconcile(spark, inbox, tmp_path):
    root = str(tmp_path / "out")
    run = lambda: late_rows.start_event_counts_with_late(inbox.stream(), root, str(tmp_path / "c"), every=None).awaitTermination()
    inbox.put(view(time="2024-01-01T10:05:00"), view(time="2024-01-01T10:21:00"), view(time=None))  # watermark 10:19
    run()
    late = view("slow", time="2024-01-01T10:09:00")
    inbox.put(late, view(time="2024-01-01T10:18:00"), "no json")  # closed, still open, without time
    run()
    inbox.put(view(time="2024-01-01T09:00:00"))
    run()
    assert sorted((row["value"], row["batch_id"]) for row in late_rows.read_late(spark, root).collect()) == sorted(
        [(late, 1), (view(time="2024-01-01T09:00:00"), 2)]
    )
    counted = counts_by_key(late_rows.counts(late_rows.read_increments(spark, root)), "eventType")
    assert {start.strftime("%H:%M"): n for (start, _), n in counted.items()} == {"10:00": 1, "10:10": 1, "10:20": 1}
    batches = [row.asDict() for row in late_rows.read_batches(spark, root).orderBy("batch_id").collect()]
    assert [(b["read"], b["counted"], b["late"], b["timeless"]) for b in batches] == [(3, 2, 0, 1), (3, 1, 1, 1), (1, 0, 1, 0)]
    assert batches[0]["watermark"] is None and batches[2]["watermark"] == at("2024-01-01T10:19:00")


def test_late_rows_are_those_that_the_built_in_counts_drop(spark, inbox, tmp_path):
    texts = [view(f"p{n}", time=f"2024-01-01T{10 + (n * 37 % 120) // 60}:{n * 37 % 60:02}:00") for n in range(120)]
    for start in range(0, 120, 30):
        inbox.put(*texts[start:start + 30])
        serve(inbox, tmp_path, window_counts.event_counts, "update", "eventType").awaitTermination()
        late_rows.start_event_counts_with_late(inbox.stream(), str(tmp_path / "o"), str(tmp_path / "oc"), every=None).awaitTermination()
    newest = serving.latest_versions(spark.read.parquet(str(tmp_path / "served")), ["window_start", "window_end", "eventType"])
    counted = late_rows.counts(late_rows.read_increments(spark, str(tmp_path / "o")))
    assert counts_by_key(counted, "eventType") == counts_by_key(newest, "eventType")
    assert late_rows.read_late(spark, str(tmp_path / "o")).count() == 120 - sum(counts_by_key(newest, "eventType").values()) > 0


def test_append_mode_emits_closed_windows_once(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    for hour in (10, 11, 12):
        inbox.put(*[view(f"p{n % 3}", time=f"2024-01-01T{hour}:{n:02}:00") for n in range(50)])
        counted = window_counts.flat_window(window_counts.product_view_counts(inbox.events()), "productId")
        queries.start_file_sink(counted, out, str(tmp_path / "c"), every=None).awaitTermination()
    counts = spark.read.parquet(out)
    assert counts.count() == counts.select("window_start", "productId").distinct().count()
    top = window_counts.top_of_latest_window(counts, 2)
    assert [(row["window_start"], row["productId"], row["count"]) for row in top.collect()] == [
        (at("2024-01-01T11:30:00"), "p0", 7), (at("2024-01-01T11:30:00"), "p1", 7),
    ]


def test_complete_mode_ranks_all_windows(spark, inbox, tmp_path):
    for hour, copies in ((10, 5), (12, 2)):
        inbox.put(*[view("p1", time=f"2024-01-01T{hour}:01:00")] * copies, view("p2", time=f"2024-01-01T{hour}:02:00"))
        serve(inbox, tmp_path, lambda events: window_counts.top_products(events, 2), "complete", "productId").awaitTermination()
    top = serving.latest_batch(spark.read.parquet(str(tmp_path / "served")))
    assert counts_by_key(top, "productId") == {
        (at("2024-01-01T10:00:00"), "p1"): 5, (at("2024-01-01T12:00:00"), "p1"): 2,
    }


@pytest.mark.parametrize("closed", [False, True])
def test_retired_versions_leave_what_readers_see(spark, tmp_path, closed):
    folder, schema = str(tmp_path / "v"), "key string, count long, batch_id long"
    for batch in range(4):
        rows = [("a", batch, batch)] + ([("b", 5, 0)] if batch == 0 else [])
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(folder)
    read = lambda: spark.read.schema(schema).parquet(folder)
    see = lambda: sorted(map(tuple, (serving.latest_batch(read()) if closed else serving.latest_versions(read(), ["key"])).collect()))
    before = see()
    survivors = serving.newest_batch if closed else serving.newest_versions_with_batch(["key"])
    assert serving.retire_versions(spark, folder, survivors, schema) >= 4
    assert see() == before and read().count() == (1 if closed else 2)


def _bucket_files(folder):
    return {path.relative_to(folder).as_posix() for path in folder.rglob("*.parquet")}


def test_retiring_leaves_buckets_at_rest(spark, tmp_path):
    folder, schema = tmp_path / "v", "window_start timestamp, key string, count long, batch_id long"
    write = serving.version_writer(
        lambda batch: batch, "parquet", {"path": str(folder)}, bucket=serving.day_bucket()
    )
    first, second, third = at("2024-01-01T10:00:00"), at("2024-01-02T10:00:00"), at("2024-01-03T10:00:00")
    batches = [
        [(first, "a", 1), (first, None, 2), (None, "a", 9)],
        [(first, "b", 1), (second, "a", 1)],
        [(second, "a", 3), (third, "a", 1), (third, "b", 1)],
        [(third, "a", 2)],
    ]
    for number, rows in enumerate(batches):
        write(spark.createDataFrame(rows, "window_start timestamp, key string, count long"), number)
    write(spark.createDataFrame(batches[3], "window_start timestamp, key string, count long"), 3)  # replayed
    keys = ["window_start", "key"]
    read = lambda: spark.read.schema(schema).parquet(str(folder))
    see = lambda: sorted(map(str, serving.latest_versions(read(), keys).collect()))
    before, files, day = see(), _bucket_files(folder), lambda n: f"bucket={19723 + n}/"
    assert len(before) == 7 and all("bucket" not in row for row in before)
    assert {name.split("/")[0] + "/" for name in files} == {day(0), day(1), day(2), "bucket=-1/"}

    assert serving.retire_buckets(spark, str(folder), keys, schema) == 5  # two of the second day, three of the third
    kept = _bucket_files(folder)
    assert see() == before and read().count() == 7
    # The first day has files of two batches and no key twice: nothing to cut, so they stay.
    rest = {name for name in files if name.startswith((day(0), "bucket=-1/"))}
    assert len(rest) == 3 and rest <= kept and not (kept - rest) & files
    assert serving.retire_buckets(spark, str(folder), keys, schema) == 0 and _bucket_files(folder) == kept

    write(spark.createDataFrame([(third, "b", 7)], "window_start timestamp, key string, count long"), 4)
    assert serving.retire_buckets(spark, str(folder), keys, schema) == 2
    changed = kept ^ _bucket_files(folder)
    assert changed and all(name.startswith(day(2)) for name in changed) and read().count() == 7


def test_batch_and_stream_agree(spark, inbox, tmp_path):
    texts = [view(f"p{n % 4}", time=f"2024-01-01T{10 + n // 60}:{n % 60:02}:00") for n in range(150)]
    for start in range(0, 150, 50):
        inbox.put(*texts[start:start + 50])
        serve(inbox, tmp_path, window_counts.event_counts, "update", "eventType").awaitTermination()
    newest = serving.latest_versions(spark.read.parquet(str(tmp_path / "served")), ["window_start", "window_end", "eventType"])
    batch = window_counts.flat_window(window_counts.event_counts(parse.parse_events(messages(spark, *texts))), "eventType")
    assert counts_by_key(newest, "eventType") == counts_by_key(batch, "eventType")


def test_time_slices_cover_the_log_once(spark):
    log = spark.createDataFrame(
        [(n, at("2024-01-01T00:00:00") + dt.timedelta(seconds=n)) for n in range(100)] + [(100, None)], "n int, ts timestamp"
    )
    parts = [sorted(row["n"] for row in log.where(cut).collect()) for cut in feed.time_slices(log, "ts", 3)]
    assert sorted(sum(parts, [])) == list(range(101))
    in_time = [[n for n in part if n < 100] for part in parts]
    assert all(a[-1] < b[0] for a, b in zip(in_time, in_time[1:]))
    assert feed.time_slices(log.limit(0), "ts", 3) == []


# compaction


def files(folder):
    return sorted(path.name for path in folder.glob("*.parquet"))


def test_compaction_keeps_rows_and_originals(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as string) name")
    rows.repartition(40).write.parquet(str(tmp_path / "small"))
    before = files(tmp_path / "small")
    assert compact_folder(spark, str(tmp_path / "small"), str(tmp_path / "big"), compare_rows=True) == 1000
    assert len(before) == 40 and files(tmp_path / "small") == before
    assert len(files(tmp_path / "big")) == 1
    assert row_checksum(spark.read.parquet(str(tmp_path / "big"))) == row_checksum(rows)


def test_compaction_bounds_the_files_it_writes(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "xxhash64(id) h").repartition(40).write.parquet(str(tmp_path / "small"))
    size = sum(path.stat().st_size for path in (tmp_path / "small").glob("*.parquet"))
    compact_folder(spark, str(tmp_path / "small"), str(tmp_path / "big"), target_bytes=size // 5)
    assert 4 <= len(files(tmp_path / "big")) <= 8


def test_compaction_leaves_scan_settings_of_the_session_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(10).write.parquet(str(tmp_path / "small"))
    compact_folder(spark, str(tmp_path / "small"), str(tmp_path / "big"), target_bytes=1234567)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_new_files_are_compacted_once_beside_a_stream(spark, inbox, tmp_path):
    schema = ROUTED_TABLES["product_view"]
    live, compacted = tmp_path / "live", tmp_path / "compacted"
    for number in range(3):
        inbox.put(*[view(f"p{number}-{n}") for n in range(5)])
        rows = parse.route(inbox.events(), "product_view").repartition(4)
        queries.start_file_sink(rows, str(live), str(tmp_path / "c"), every=None).awaitTermination()
        for _ in range(2):
            compact_new_files(spark, str(live), str(compacted), str(tmp_path / "cc"), schema)
    assert len(files(live)) > len(files(compacted)) == 3
    products = [row["productId"] for row in spark.read.parquet(str(compacted)).collect()]
    assert sorted(products) == sorted(f"p{a}-{b}" for a in range(3) for b in range(5))


@pytest.mark.parametrize("single_read", [False, True])
def test_readers_see_every_event_once_beside_compaction(spark, inbox, tmp_path, single_read):
    out, target, database = str(tmp_path / "out"), str(tmp_path / "compacted"), f"stream_{uuid.uuid4().hex}"
    folders = {table: f"{out}/{table}" for table in ROUTED_TABLES}
    register_event_tables(spark, {}, database, str(tmp_path / "db"))
    expected, removed = [], 0
    for run in range(4):
        for n in range(3):
            inbox.put(view(f"p{run}-{n}"))
        expected += [f"p{run}-{n}" for n in range(3)]
        if single_read:
            queries.start_router(inbox.stream(), out, str(tmp_path / "c"), every=None).awaitTermination()
        else:
            queries.await_all(list(queries.start_routes(inbox.stream(), out, str(tmp_path / "c"), every=None).values()))
        if run == 0:
            register_event_tables(spark, folders, database)
        elif run < 3:
            found = [compact_run(spark, folders[t], f"{target}/{t}", s, at(f"2024-01-0{run}T00:00:00")) for t, s in ROUTED_TABLES.items()]
            assert found[0] > 0
            register_compacted(spark, folders, target, database)
        if run == 2:
            assert compact_run(spark, folders["product_view"], f"{target}/product_view", ROUTED_TABLES["product_view"], at("2024-01-05T00:00:00")) == 0
            removed = retire_originals(spark, f"{target}/product_view", at("2024-01-02T00:00:00"))
            assert removed > 0 and retire_originals(spark, f"{target}/product_view", at("2024-01-02T00:00:00")) == 0
        if run:  # a session keeps the listing of a table's files until it refreshes it
            spark.catalog.refreshTable(f"{database}.product_view_files")
        seen = [row["productId"] for row in spark.table(f"{database}.product_view").collect()]
        assert sorted(seen) == sorted(expected), run
    assert spark.table(f"{database}.purchase").count() == 0


def test_notes_of_removed_originals_are_dropped_and_runs_go_on(spark, tmp_path):
    schema = ROUTED_TABLES["add_to_cart"]
    source, target = tmp_path / "s s+%", str(tmp_path / "t")
    day = lambda n: at(f"2024-01-0{n}T00:00:00")
    for run in (1, 2, 3):
        rows = spark.createDataFrame([("addToCart", f"c{run}", "p", None, n) for n in range(4)], schema)
        rows.repartition(3).write.mode("append").parquet(str(source))
        assert compact_run(spark, str(source), target, schema, day(run)) == 3
        assert compact_run(spark, str(source), target, schema, day(run)) == 0
    assert retire_originals(spark, target, day(3)) == 6 and len(files(source)) == 3
    assert retire_originals(spark, target, day(3)) == 0
    assert sorted(path.name for path in (tmp_path / "t" / "notes").iterdir()) == ["run=3"]
    assert retire_originals(spark, target, day(9)) == 3
    for _ in range(2):
        assert retire_originals(spark, target, day(9)) == 0
    spark.createDataFrame([("addToCart", "c4", "p", None, 1)], schema).write.mode("append").parquet(str(source))
    assert compact_run(spark, str(source), target, schema, day(4)) > 0
    kept = spark.read.parquet(f"{target}/data").groupBy("run").count().collect()
    assert sorted((row["run"], row["count"]) for row in kept) == [(1, 4), (2, 4), (3, 4), (4, 1)]


def test_a_run_without_rows_and_one_that_lost_some(spark, tmp_path, monkeypatch):
    schema = ROUTED_TABLES["add_to_cart"]
    spark.createDataFrame([], schema).coalesce(1).write.parquet(str(tmp_path / "e"))
    assert compact_run(spark, str(tmp_path / "e"), str(tmp_path / "te"), schema, at("2024-01-01T00:00:00")) == 1
    spark.createDataFrame([("addToCart", "c", "p", None, 1)] * 2, schema).write.parquet(str(tmp_path / "s"))
    counts = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda frame: counts(frame) - 1)
    with pytest.raises(RuntimeError, match="does not hold"):
        compact_run(spark, str(tmp_path / "s"), str(tmp_path / "ts"), schema, at("2024-01-01T00:00:00"))
    assert not (tmp_path / "ts" / "notes").exists()


def test_a_run_that_broke_before_its_note_is_done_again(spark, tmp_path):
    schema = ROUTED_TABLES["add_to_cart"]
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.createDataFrame([("addToCart", "c", "p", None, 1)], schema).coalesce(1).write.parquet(source)
    spark.createDataFrame([("addToCart", "half", "p", None, 1)] * 5, schema).write.parquet(f"{target}/data/run=1")
    assert compact_run(spark, source, target, schema, at("2024-01-01T00:00:00")) == 1
    assert [row["customerId"] for row in spark.read.parquet(f"{target}/data").collect()] == ["c"]
