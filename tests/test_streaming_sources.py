"""Streams give the batch result; sources and sinks round-trip."""

import json
import os

from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from nimbusframe.functions import nested as N
from nimbusframe.operators import aggregates as A
from nimbusframe.operators import windows as W
from nimbusframe.plans import standins as SI
from nimbusframe.session import Tables
from nimbusframe.sources import io as IO
from nimbusframe.streaming import streams as T

EVENTS = f"{SF_SMALL}/events.parquet"


def test_notifications_stream_equals_batch(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    batch = T.to_notifications(SI.change_records(ev), env="test", now="2024-01-01 00:00:00")
    stream = T.to_notifications(SI.change_records(T.file_stream(spark, EVENTS, ev)),
                                env="test", now="2024-01-01 00:00:00")
    T.run_available_now(stream, f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    got = spark.read.parquet(f"{tmpdir_path}/out")
    assert rows(got) == rows(batch)
    one = batch.where(F.col("event_name") == "MODIFY").first()
    msg = json.loads(one.message)
    assert msg["event"] == "ITEM_UPDATED" and set(msg) == {"event", "environment", "oldItem", "newItem", "timestamp"}
    assert one.subject.startswith("[test] Item Updated: ")


def test_batch_counts_come_with_one_job_a_batch(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    ev.repartition(3).write.parquet(f"{tmpdir_path}/events")
    src = T.counted(SI.change_records(T.file_stream(spark, f"{tmpdir_path}/events", ev)))
    spark.sparkContext.setJobGroup("before", "")
    with T.RecordCounts(spark) as counts:
        q = T.run_available_now(src, f"{tmpdir_path}/ck", sink=T.notifications_sink(f"{tmpdir_path}/n", now="2024-01-01 00:00:00"))
        per_batch = counts.of(q)
    assert [r.batch_id for r in per_batch.orderBy("batch_id").collect()] == [0, 1, 2]
    c = per_batch.agg(F.sum("records_processed").alias("r"), F.sum("notifications").alias("n")).first()
    with_message = ev.where(F.col("event_type").isin("signup", "purchase", "error")).count()
    assert (c.r, c.n) == (ev.count(), with_message) == (c.r, spark.read.parquet(f"{tmpdir_path}/n").count())
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))) == 3


def test_stream_health_equals_window_health(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events.withColumn("ok", F.col("event_type") != "error")
    batch = W.health_states(ev, ["user_id"], ["ts", "event_id"], F.col("ok"), 3, 2).select("user_id", "event_id", "run_length", "state", "changed")
    s = T.stream_health(T.file_stream(spark, EVENTS, ev.drop("ok")).withColumn("ok", F.col("event_type") != "error"),
                        "user_id", "ts", "event_id", "ok", 3, 2)
    T.run_available_now(s.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    emitted, held = spark.read.parquet(f"{tmpdir_path}/out"), s.drain(spark, f"{tmpdir_path}/ck")
    assert emitted.count() > 0 and held.count() > 0
    got = emitted.unionByName(held).select("user_id", "event_id", "run_length", "state", "changed")
    assert rows(got) == rows(batch)


def test_stream_alarm_equals_window_alarm(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    stats = A.metric_statistics(ev, "ts", "value", "6 hours", ["event_type"], ("avg",))
    batch = W.alarm_states(stats, ["event_type"], "window_start", "avg_value", 21600, ">", 50.0, 2)
    stats.write.parquet(f"{tmpdir_path}/stats")
    src = spark.readStream.schema(stats.schema).parquet(f"{tmpdir_path}/stats")
    alarm = T.stream_alarm(src, "event_type", "window_start", "avg_value", 21600, ">", 50.0, 2)
    T.run_available_now(alarm.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    got = spark.read.parquet(f"{tmpdir_path}/out").unionByName(alarm.drain(spark, f"{tmpdir_path}/ck"))
    assert rows(got, "event_type", "window_start", "state") == rows(batch, "event_type", "window_start", "state")


def test_read_items_typed_export(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/items")
    with open(f"{tmpdir_path}/items/part-0.json", "w") as f:
        f.write('{"Item": {"StudentID": {"S": "S1001"}, "CourseID": {"S": "CS101"}, "Grade": {"N": "85"}}}\n')
        f.write('{"StudentID": {"S": "S1003"}, "CourseID": {"S": "PHYS101"}, "Grade": {"N": "78"}, "Active": {"BOOL": false}}\n')
    df = IO.read_items(spark, f"{tmpdir_path}/items", {"StudentID": "string", "CourseID": "string", "Grade": "int"})
    assert rows(df, "StudentID", "Grade") == [("S1001", 85), ("S1003", 78)]
    assert df.where("StudentID = 'S1003'").select(N.attribute("item", "Active")).first()[0] == "false"


def test_read_items_parses_an_item_once(spark, tmpdir_path):
    lines = ['{"Item":{"a":{"N":"1.50E10"},"b\'c":{"BOOL":true},"d":{"M":{"x":{"N":"2"}}},"e":{"NULL":true}}}', '{"a":{"S":"7"},"d":{"SS":["p","q"]}}',
             '{"a":{"B":"eA=="},"b\'c":null,"d":{"S":null},"e":{"S":""}}', '{"Item":5}', '[1]', 'no json', '{"a":3,"d":{"N":4}}', '', '{"Item":{}}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmpdir_path}/items")
    kinds = {"a": "string", "b'c": "boolean", "d": "string", "e": "string"}
    df = IO.read_items(spark, f"{tmpdir_path}/items", kinds)
    for r in df.collect():  # as the map has it
        have = r["item"] or {}
        assert [r["a"], r["d"], r["e"]] == [have.get(x) for x in "ade"]
        assert r["b'c"] == (have["b'c"] == "true" if have.get("b'c") else None)
    assert rows(df.where("a IS NOT NULL"), "a", "d")[:2] == [("1.50E10", '{"x":2}'), ("7", '["p","q"]')]
    plan = df.drop("item").where("try_cast(a AS INT) < 80")._jdf.queryExecution().optimizedPlan().toString()
    before_whole = plan.split("transform_values")[0]  # the map is for attributes that are no scalars
    assert "Generate explode" in plan and "parseJson" not in before_whole.split("Generate explode")[0]


def test_csv_quotes_every_field_and_dump_restore(spark, tmpdir_path):
    df = spark.createDataFrame([("S1001", 85)], "StudentID string, Grade string")
    IO.write_csv(df, f"{tmpdir_path}/csv")
    text = "".join(open(os.path.join(f"{tmpdir_path}/csv", p)).read() for p in sorted(os.listdir(f"{tmpdir_path}/csv")) if p.endswith(".csv"))
    assert '"StudentID","Grade"' in text and '"S1001","85"' in text
    IO.export_table(df, f"{tmpdir_path}/dump")
    assert rows(IO.restore_table(spark, f"{tmpdir_path}/dump")) == rows(df)


def test_object_versions_and_log_lines(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/ver")
    listing = {"Versions": [{"Key": "a.txt", "VersionId": "v1", "IsLatest": False, "LastModified": "2024-01-01T00:00:00Z", "Size": 5},
                            {"Key": "a.txt", "VersionId": "v2", "IsLatest": False, "LastModified": "2024-01-02T00:00:00Z", "Size": 6}],
               "DeleteMarkers": [{"Key": "a.txt", "VersionId": "dm1", "IsLatest": True, "LastModified": "2024-01-03T00:00:00Z"}]}
    with open(f"{tmpdir_path}/ver/l.json", "w") as f:
        json.dump(listing, f)
    v = IO.read_object_versions(spark, f"{tmpdir_path}/ver")
    assert rows(v, "version_id", "is_delete_marker") == [("dm1", True), ("v1", False), ("v2", False)]
    os.makedirs(f"{tmpdir_path}/log")
    with open(f"{tmpdir_path}/log/server.log", "w") as f:
        f.write("boot\nDone (3.2s)! For help\nplayer joined\nDone (1.0s)! again\n")
    hits = IO.find_lines(IO.read_log(spark, f"{tmpdir_path}/log"), "Done", limit=1)
    assert [r.line for r in hits.collect()] == ["Done (3.2s)! For help"]


def test_tables_views_and_history(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "x")], "id int, n string")
    IO.register_view(df, "nf_tmp_view")
    assert spark.sql("SELECT count(*) AS c FROM nf_tmp_view").first().c == 1
    IO.save_table(df, "nf_tmp_table", mode="overwrite", path=f"{tmpdir_path}/tbl")
    IO.save_table(spark.createDataFrame([(2, "y")], "id int, n string"), "nf_tmp_table", mode="ignore")
    assert spark.table("nf_tmp_table").count() == 1
    IO.drop_table(spark, "nf_tmp_table")
    IO.append_history(df, f"{tmpdir_path}/hist", now="2024-01-01 00:00:00")
    IO.append_history(df, f"{tmpdir_path}/hist", now="2024-01-02 00:00:00")
    assert spark.read.text(f"{tmpdir_path}/hist").count() == 2


def test_append_mode_windows_equal_batch_for_closed_windows(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    batch = A.metric_statistics(ev, "ts", "value", "6 hours", ["event_type"])
    s = T.stream_statistics(T.file_stream(spark, EVENTS, ev), "ts", "value", "6 hours", ["event_type"])
    T.run_available_now(s, f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")  # append: closed windows only
    got = spark.read.parquet(f"{tmpdir_path}/out")
    cols = ["event_type", "avg_value", "max_value"]
    got_rows = rows(got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "event_type", "window_start", *cols[1:])
    all_rows = rows(batch, "event_type", "window_start", *cols[1:])
    assert 0 < len(got_rows) < len(all_rows)
    assert set(got_rows) <= set(all_rows)  # every emitted window is final and equals the batch window


def test_upsert_sink_is_idempotent_per_batch_id(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events.select("user_id", "event_type", "event_id", "ts", "value")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    sink = T.changes_sink(f"{tmpdir_path}/state")
    read = lambda: rows(T.read_upserted(spark, f"{tmpdir_path}/state", ev.schema, keys, order))
    sink(T.stream_upsert(ev, keys, order), 0)
    first = read()
    sink(T.stream_upsert(ev, keys, order), 0)  # the same micro-batch replayed after a failure
    assert read() == first
    sink(ev.where("event_type = 'view'"), 1)
    assert read() == first
    newer = ev.where("event_type = 'view' AND user_id < 3").withColumn("ts", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    sink(newer, 2)
    assert len(read()) == len(first)
    assert sum(r[3].year == 2030 for r in read()) == newer.select("user_id").distinct().count()


def test_stream_upsert_over_many_files_with_an_initial_table(spark, tmpdir_path):
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (None, 1, "none")], "k int, t int, x string")
    new = [(1, 6, "new"), (2, 4, "late"), (3, 1, "first"), (3, None, "no time"), (None, 2, None), (1, 6, "new")]
    for i, r in enumerate(new):
        spark.createDataFrame([r], old.schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
    stream = T.stream_upsert(T.file_stream(spark, f"{tmpdir_path}/in", old, max_files=1), ["k"], ["t"])
    T.run_available_now(stream, f"{tmpdir_path}/ck", sink=T.changes_sink(f"{tmpdir_path}/s"), output_mode="update")
    got = T.read_upserted(spark, f"{tmpdir_path}/s", old.schema, ["k"], ["t"], initial=old).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 6, "new"), (2, 5, "old"), (3, 1, "first"), (None, 2, None)], key=str)


def test_statistics_and_alarm_in_one_query(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events.select("event_type", "ts", "value")
    T.land_in_order(ev.repartition(3), "ts", f"{tmpdir_path}/in", 4, "12 days")
    src = T.file_stream(spark, f"{tmpdir_path}/in", ev, max_files=1)
    stats = T.stream_statistics(src, "ts", "value", "6 hours", ["event_type"], "8 days", ("avg",), event_time=True)
    alarm = T.stream_alarm(stats, "event_type", "window_start", "avg_value", 21600, ">", 50.0, 2, event="event_time")
    q = T.run_available_now(alarm.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    batch = A.metric_statistics(ev, "ts", "value", "6 hours", ["event_type"], ("avg",))
    batch = W.alarm_states(batch, ["event_type"], "window_start", "avg_value", 21600, ">", 50.0, 2)
    plain = lambda df: rows(df.withColumn("window_start", F.col("window_start").cast("string")), "event_type", "window_start", "state")
    assert plain(spark.read.parquet(f"{tmpdir_path}/out")) == plain(batch) and T.late_rows(q) == 0


def test_state_rows_do_not_grow_with_the_table(spark, tmpdir_path):
    # one target holds most checks; a state row holds its checks of an hour, however many hours there are
    def largest(hours):
        base = f"{tmpdir_path}/{hours}"
        checks = spark.range(hours * 30).select(
            F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("tgt"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 120).alias("ts"), F.col("id").alias("n"), (F.col("id") % 9 < 6).alias("ok"))
        T.land_in_order(checks, "ts", f"{base}/in", 3)
        src = T.file_stream(spark, f"{base}/in", checks, max_files=1)
        h = T.stream_health(src, "tgt", "ts", "n", "ok", 3, 2, delay="4000 days")  # nothing is stepped before the end
        T.run_available_now(h.apply(), f"{base}/ck", path=f"{base}/out")
        held = spark.read.format("statestore").option("stateVarName", "rows").load(f"{base}/ck")
        cols = ["tgt", "n", "run_length", "state", "changed"]
        batch = W.health_states(checks, ["tgt"], ["ts", "n"], F.col("ok"), 3, 2)
        assert rows(h.drain(spark, f"{base}/ck"), *cols) == rows(batch, *cols)
        return held.agg(F.max(F.size("user_map_value._p_ts"))).first()[0]

    assert largest(8) == largest(40) <= 30


def test_keys_of_a_group_share_state_rows(spark, tmpdir_path):
    # 300 keys, one of them null, others beyond the whole numbers of a double; all checks have ties and arrive in 3 batches
    user = F.when(F.col("id") % 300 > 0, F.lit((1 << 53) + 1) + F.col("id") % 300)
    checks = spark.range(9000).select(
        user.alias("tgt"), F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") / 2) * 4).alias("ts"), F.col("id").alias("n"),
        F.when(F.col("id") % 11 > 0, F.xxhash64("id") % 3 != 0).alias("ok"))
    T.land_in_order(checks, "ts", f"{tmpdir_path}/in", 3)
    src = T.file_stream(spark, f"{tmpdir_path}/in", checks, max_files=1)
    h = T.stream_health(src, "tgt", "ts", "n", "ok", 3, 2, delay="3 hours", groups=4)
    T.run_available_now(h.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    held = spark.read.format("statestore").option("stateVarName", "rows").load(f"{tmpdir_path}/ck")
    out, rest = spark.read.parquet(f"{tmpdir_path}/out"), h.drain(spark, f"{tmpdir_path}/ck")
    assert 0 < held.count() <= 4 * 5 and out.count() > 1000 and rest.count() > 1000
    cols = [F.col("tgt").cast("string").alias("k"), "n", "run_length", "state", "changed"]
    want = W.health_states(checks, ["tgt"], ["ts", "n"], F.coalesce("ok", F.lit(False)), 3, 2)
    read = lambda df: sorted(map(tuple, df.select(*cols).collect()), key=str)
    assert read(out.unionByName(rest)) == read(want)


def test_document_files_are_bounded_in_bytes(spark, tmpdir_path):
    docs = spark.range(40, numPartitions=3).select(F.expr("id % 20").alias("n"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    IO.write_document_files(docs, f"{tmpdir_path}/docs")
    back = IO.read_documents(spark, f"{tmpdir_path}/docs", docs.schema)
    per_file = back.select("*", F.input_file_name().alias("f")).groupBy("f").agg(F.count("*").alias("docs"), F.collect_set("n").alias("n")).collect()
    assert sorted(r.n for r in back.select("n").collect()) == sorted(i % 20 for i in range(40))
    assert len(per_file) > 1 and max(r.docs for r in per_file) < 40
    assert sum(len(r.n) for r in per_file) == 20  # equal ones share a file
    for i, df in enumerate((docs.limit(1), docs.limit(0))):
        IO.write_document_files(df, f"{tmpdir_path}/{i}")
        assert IO.read_documents(spark, f"{tmpdir_path}/{i}", docs.schema).count() == 1 - i


def test_streams_over_shuffled_files_lose_nothing(spark, tmpdir_path):
    ev = Tables(spark, SF_SMALL).events
    ev.repartition(5, "event_id").write.parquet(f"{tmpdir_path}/events")
    ok = F.col("event_type") != "error"
    src = T.file_stream(spark, f"{tmpdir_path}/events", ev, max_files=1).withColumn("ok", ok)
    s = T.stream_health(src, "user_id", "ts", "event_id", "ok", 3, 2, delay="4000 days")
    q = T.run_available_now(s.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    cols = ["user_id", "event_id", "run_length", "state", "changed"]
    got = spark.read.schema(s.drain(spark, f"{tmpdir_path}/ck").schema).parquet(f"{tmpdir_path}/out").unionByName(s.drain(spark, f"{tmpdir_path}/ck"))
    assert T.late_rows(q) == 0
    assert rows(got, *cols) == rows(W.health_states(ev.withColumn("ok", ok), ["user_id"], ["ts", "event_id"], F.col("ok"), 3, 2), *cols)


def test_rows_later_than_the_watermark_are_counted(spark, tmpdir_path):
    for i, (n, t) in enumerate([(1, "2024-01-01 10:00:00"), (2, "2024-01-05 10:00:00"), (3, "2024-01-01 09:00:00"), (4, "2024-01-06 10:00:00")]):
        spark.createDataFrame([("x", n, t, True)], "k string, n int, t string, ok boolean").withColumn(
            "t", F.col("t").cast("timestamp")).coalesce(1).write.parquet(f"{tmpdir_path}/c/p={i}")
    src = spark.readStream.schema("k string, n int, t timestamp, ok boolean").option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/c")
    s = T.stream_health(src, "k", "t", "n", "ok", 3, 2)
    q = T.run_available_now(s.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    got = spark.read.parquet(f"{tmpdir_path}/out").unionByName(s.drain(spark, f"{tmpdir_path}/ck"))
    assert rows(got, "n") == [(1,), (2,), (4,)] and T.late_rows(q) == 1


def test_alarm_on_nan_and_null_equals_batch(spark, tmpdir_path):
    vals = [("m", 0, float("nan")), ("m", 1, float("nan")), ("m", 2, None), ("m", 3, 5.0), ("m", 4, float("nan"))]
    stats = spark.createDataFrame(vals, "m string, h int, v double").select(
        "m", F.timestamp_seconds(F.lit(1704067200) + F.col("h") * 3600).alias("t"), "v")
    stats.coalesce(1).write.parquet(f"{tmpdir_path}/s")
    alarm = T.stream_alarm(spark.readStream.schema(stats.schema).parquet(f"{tmpdir_path}/s"), "m", "t", "v", 3600, ">", 1.0, 2)
    T.run_available_now(alarm.apply(), f"{tmpdir_path}/ck", path=f"{tmpdir_path}/out")
    got = spark.read.parquet(f"{tmpdir_path}/out").unionByName(alarm.drain(spark, f"{tmpdir_path}/ck"))
    assert rows(got, "t", "state") == rows(W.alarm_states(stats, ["m"], "t", "v", 3600, ">", 1.0, 2), "t", "state")


def test_stateful_streams_carry_runs_across_micro_batches(spark, tmpdir_path):
    # one period (and one check) per file and per micro-batch: every run crosses batch edges
    ts = [f"2024-01-01 {h:02d}:00:00" for h in range(12)]
    vals = [2.0, 3.0, 4.0, 0.5, 2.0, 2.0, 2.0, 0.1, 5.0, 5.0, 5.0, 5.0]
    stats = spark.createDataFrame([("m", t, v) for t, v in zip(ts, vals)], "m string, t string, v double").withColumn(
        "t", F.col("t").cast("timestamp"))
    for i in range(len(ts)):
        stats.where(F.col("t") == F.lit(ts[i]).cast("timestamp")).coalesce(1).write.parquet(f"{tmpdir_path}/stats/p={i:02d}")
    src = spark.readStream.schema(stats.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/stats")
    alarm = T.stream_alarm(src, "m", "t", "v", 3600, ">", 1.0, 3)
    T.run_available_now(alarm.apply(), f"{tmpdir_path}/ck1", path=f"{tmpdir_path}/a")
    got = rows(spark.read.parquet(f"{tmpdir_path}/a").unionByName(alarm.drain(spark, f"{tmpdir_path}/ck1")), "t", "state")
    want = rows(W.alarm_states(stats, ["m"], "t", "v", 3600, ">", 1.0, 3), "t", "state")
    assert got == want and [s for _, s in got].count("ALARM") == 4

    oks = [True, False, False, False, True, True, False, False, False, True, False, True, True]
    checks = spark.createDataFrame([("x", i, f"2024-01-01 00:{i:02d}:00", ok) for i, ok in enumerate(oks)],
                                   "tgt string, seq int, ts string, ok boolean").withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(len(oks)):
        checks.where(F.col("seq") == i).coalesce(1).write.parquet(f"{tmpdir_path}/checks/p={i:02d}")
    csrc = spark.readStream.schema(checks.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/checks")
    health = T.stream_health(csrc, "tgt", "ts", "seq", "ok", 3, 2, delay="3 minutes")
    T.run_available_now(health.apply(), f"{tmpdir_path}/ck2", path=f"{tmpdir_path}/h")
    cols = ["seq", "run_length", "state", "changed"]
    done = spark.read.parquet(f"{tmpdir_path}/h").unionByName(health.drain(spark, f"{tmpdir_path}/ck2"))
    assert rows(done, *cols) == rows(W.health_states(checks, ["tgt"], ["ts", "seq"], F.col("ok"), 3, 2), *cols)


def test_bytes_bound_a_micro_batch(spark, tmpdir_path):
    df = spark.range(400, numPartitions=8).withColumnRenamed("id", "n")
    df.write.parquet(f"{tmpdir_path}/in")
    for most, batches in ((1 << 30, 1), (1, 8)):
        base = f"{tmpdir_path}/{most}"
        q = T.run_available_now(T.file_stream(spark, f"{tmpdir_path}/in", df, max_bytes=most), f"{base}/ckpt", path=f"{base}/out")
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == batches
        assert spark.read.parquet(f"{base}/out").distinct().count() == 400


def test_landed_files_follow_the_rows(spark, tmpdir_path):
    df = spark.range(1200, numPartitions=8).select("id", F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("ts"))
    for rows_a_file, files in ((2_000_000, 3), (100, 12)):
        T.land_in_order(df, "ts", f"{tmpdir_path}/{files}", 3, file_rows=rows_a_file)
        landed = spark.read.parquet(f"{tmpdir_path}/{files}")
        assert landed.select(F.input_file_name()).distinct().count() == files
        assert sorted(r.id for r in landed.collect()) == list(range(1200))
