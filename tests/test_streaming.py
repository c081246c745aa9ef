import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fillwatch import schemas
from fillwatch.operators import alarms, kpis, parse
from fillwatch.sources import adapters as ad
from fillwatch.sources import streams, wire
from fillwatch.streaming import alerts, jobs, progress, rollup, store

JOBS = {j.name: j for j in jobs.JOBS}


def send(folder, name, *messages):
    folder.mkdir(exist_ok=True, parents=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n")


def reading(n, fill=50.0, temp=20.0, **more):
    return {
        "sensor_id": f"s{n}", "bin_id": f"b{n % 3}", "timestamp": f"2025-01-01T00:00:{n:02d}Z",
        "fill_level": fill, "temperature": temp, "weight": 1.0, "humidity": 40.0, "status": "normal",
        **more,
    }


def work_off(spark, topics, root, checkpoints, *names, source=streams.file_json):
    for name in names:
        job = JOBS[name]
        messages = source(spark, str(topics / job.topic.name))
        jobs.start(messages, job, str(root), str(checkpoints), available_now=True).awaitTermination()


@pytest.fixture
def places(tmp_path):
    return tmp_path / "topics", tmp_path / "tables", tmp_path / "checkpoints"


def rows(spark, root, table):
    return sorted(store.current(spark, str(root), table).collect(), key=str)


def test_stream_equals_batch_restart_and_replay_add_nothing(spark, places, tmp_path):
    topics, root, checkpoints = places
    send(topics / "sensor_data", "1.json", *[reading(n, fill=n * 5.0) for n in range(20)])
    work_off(spark, topics, root, checkpoints, "sensor_data", "sensor_alarms")
    batch = streams.file_json
    text = spark.read.text(str(topics / "sensor_data")).withColumnRenamed("value", "json_str")
    good = parse.read(text, schemas.SENSOR_DATA)
    assert rows(spark, root, "sensor_data") == sorted(good.collect(), key=str)
    raised = sorted(alarms.detect(good).collect(), key=str)
    assert len(raised) == 2 and rows(spark, root, "alarms") == raised

    work_off(spark, topics, root, checkpoints, "sensor_data", "sensor_alarms")
    assert store.log(spark, str(root), schemas.ALARMS).count() == 2
    # The same messages under a new checkpoint: another run of the log, the same alarm ids.
    work_off(spark, topics, root, tmp_path / "again", "sensor_data", "sensor_alarms", source=batch)
    assert store.log(spark, str(root), schemas.ALARMS).count() == 4
    assert rows(spark, root, "alarms") == raised


def test_two_jobs_feed_the_alarms_and_the_outbox(spark, places):
    topics, root, checkpoints = places
    send(topics / "bins", "1.json", {"bin_id": "b1", "location_lat": 42.5, "location_lng": 21.25})
    send(topics / "sensor_data", "1.json", reading(1, fill=99.0))
    send(
        topics / "alarms", "1.json",
        {"alarm_id": "a1", "bin_id": "b1", "alarm_type": "co2_high",
         "triggered_at": "2025-01-01T00:00:00Z", "resolved_at": "", "severity": None, "status": "active"},
    )
    work_off(spark, topics, root, checkpoints, "bins", "alarms", "sensor_alarms")
    alerts.start_outbox(spark, str(root), str(checkpoints), available_now=True).awaitTermination()
    assert {r.alarm_type for r in rows(spark, root, "alarms")} == {"co2_high", "overflow"}
    outbox = spark.read.parquet(str(root / "alert_outbox")).collect()
    assert len(outbox) == 2
    assert all("?q=42.5,21.25" in r.body for r in outbox)
    assert any("Severity: high" in r.body and "co2_high" in r.subject for r in outbox)


def test_bad_messages_go_to_the_rejects(spark, places):
    topics, root, checkpoints = places
    send(
        topics / "sensor_data", "1.json",
        reading(1), "{broken", {"sensor_id": "s2", "timestamp": "2025-01-01"}, reading(3, timestamp="junk"),
    )
    work_off(spark, topics, root, checkpoints, "sensor_data")
    assert len(rows(spark, root, "sensor_data")) == 1
    rejects = spark.read.parquet(str(root / "rejects")).collect()
    assert sorted(r.reason for r in rejects) == ["bad_json", "bad_time", "null_key"]


def test_later_writes_win_and_nulls_keep_old_values(spark, places):
    topics, root, checkpoints = places
    send(topics / "bins", "1.json", {"bin_id": "b", "capacity": 60.0, "status": "active"})
    work_off(spark, topics, root, checkpoints, "bins")
    send(topics / "bins", "2.json", {"bin_id": "b", "capacity": None, "status": "offline"})
    work_off(spark, topics, root, checkpoints, "bins")
    (row,) = rows(spark, root, "bins")
    assert (row.capacity, row.status) == (60.0, "offline")

    into = root.parent / "folded"
    store.compact(spark, str(root), "bins", str(into))
    (folded,) = rows(spark, into, "bins")
    assert folded == row == rows(spark, root, "bins")[0]
    send(topics / "bins", "3.json", {"bin_id": "b", "type": "street"}, {"bin_id": "c", "type": "street"})
    # the job goes on in the new root with its checkpoint
    work_off(spark, topics, into, checkpoints, "bins")
    assert [(r.bin_id, r.capacity, r.type) for r in rows(spark, into, "bins")] == [
        ("b", 60.0, "street"), ("c", None, "street"),
    ]
    with pytest.raises(ValueError):
        store.compact(spark, str(into), "bins", f"{into}/")


def bin_of(spark, bin_id, **more):
    row = dict.fromkeys(schemas.BINS.stored.fieldNames()) | {"bin_id": bin_id} | more
    return spark.createDataFrame([tuple(row.values())], schemas.BINS.stored)


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_checkpoint_with_other_messages_keeps_both(spark, places, tmp_path, compacted):
    topics, root, checkpoints = places
    send(topics / "bins", "1.json", {"bin_id": "a"})
    work_off(spark, topics, root, checkpoints, "bins")
    send(topics / "bins", "2.json", {"bin_id": "b"})
    work_off(spark, topics, root, checkpoints, "bins")
    if compacted:
        store.compact(spark, str(root), "bins", str(tmp_path / "folded"))
        root = tmp_path / "folded"
    send(tmp_path / "other" / "bins", "1.json", {"bin_id": "z"})
    work_off(spark, tmp_path / "other", root, tmp_path / "again", "bins")
    assert [r.bin_id for r in rows(spark, root, "bins")] == ["a", "b", "z"]


def test_folding_twice_takes_in_what_came_meanwhile(spark, places, tmp_path):
    _, root, _ = places
    into = str(tmp_path / "folded")
    store.append(bin_of(spark, "a", capacity=1.0), str(root), schemas.BINS, "bins", 0)
    store.append(bin_of(spark, "a", status="s"), str(root), schemas.BINS, "bins", 1)
    store.compact(spark, str(root), "bins", into)
    store.append(bin_of(spark, "late", capacity=2.0), str(root), schemas.BINS, "bins", 2)
    store.append(bin_of(spark, "a", status="moved"), str(root), schemas.BINS, "bins", 3)
    before = rows(spark, root, "bins")
    for _ in range(2):
        store.compact(spark, str(root), "bins", into)
        assert rows(spark, into, "bins") == before == rows(spark, root, "bins")
    assert [(r.capacity, r.status) for r in before] == [(1.0, "moved"), (2.0, None)]


def test_a_batch_in_writing_is_not_read(spark, places):
    _, root, _ = places
    store.append(bin_of(spark, "a"), str(root), schemas.BINS, "bins", 0)
    half = root / "bins/log/source=bins/run=0/batch_id=1/_temporary/0/task"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half a file")
    assert [r.bin_id for r in rows(spark, root, "bins")] == ["a"]


def test_messages_of_one_key_in_one_file_are_never_mixed(spark, places):
    topics, root, checkpoints = places
    send(topics / "bins", "1.json", *[{"bin_id": "b", "capacity": float(n), "status": f"s{n}"} for n in range(9)])
    work_off(spark, topics, root, checkpoints, "bins")
    (row,) = rows(spark, root, "bins")
    assert row.status == f"s{int(row.capacity)}"


def test_a_failing_job_stops_the_others(spark, places, monkeypatch):
    topics, root, checkpoints = places
    send(topics / "sensor_data", "1.json", reading(1))
    monkeypatch.setattr(store, "append", lambda *args: 1 / 0)
    chosen = tuple(JOBS[n] for n in ("bins", "sensor_data"))
    (topics / "bins").mkdir(parents=True)
    jobs.start_all(spark, str(root), str(checkpoints), lambda s, t: streams.file_json(s, str(topics / t)), chosen)
    with pytest.raises(Exception, match="ZeroDivision"):
        jobs.await_any(spark)
    assert spark.streams.active == []


def test_options_and_zone_reach_the_jobs(spark, monkeypatch, caplog):
    seen = []
    monkeypatch.setattr(jobs, "start", lambda messages, job, *rest: seen.append((messages, job.name)))
    monkeypatch.setattr(jobs, "await_any", lambda s: None)
    monkeypatch.setattr(jobs.alerts, "start_outbox", lambda *rest: None)
    monkeypatch.setattr(jobs.sources, "kafka_json", lambda s, topic, **o: (topic, streams.kafka_options(topic, **o)))
    root, checkpoints, options = jobs.arguments(["t", "c", "maxOffsetsPerTrigger=7", "kafka.security.protocol=SSL"])
    jobs.run(spark, root, checkpoints, **options)
    assert len(seen) == 8
    assert all(m[1]["maxOffsetsPerTrigger"] == "7" and m[1]["kafka.security.protocol"] == "SSL" for m, _ in seen)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_rows_of_each_batch_are_logged(spark, places, caplog):
    topics, root, checkpoints = places
    send(topics / "sensor_data", "1.json", *[reading(n) for n in range(4)])
    with caplog.at_level("INFO"):
        work_off(spark, topics, root, checkpoints, "sensor_data")
    assert "sensor_data: batch 0 wrote 4 rows to sensor_data" in caplog.text


def test_a_failing_write_is_not_committed(spark, places, monkeypatch):
    topics, root, checkpoints = places
    send(topics / "sensor_data", "1.json", reading(1))
    real = store.append

    def fails(*args):
        raise OSError("disk full")

    monkeypatch.setattr(store, "append", fails)
    with pytest.raises(Exception, match="disk full"):
        work_off(spark, topics, root, checkpoints, "sensor_data")
    monkeypatch.setattr(store, "append", real)
    work_off(spark, topics, root, checkpoints, "sensor_data")
    assert len(rows(spark, root, "sensor_data")) == 1


def test_empty_batches_write_nothing(spark, places):
    topics, root, checkpoints = places
    send(topics / "sensor_data", "1.json", reading(1))
    work_off(spark, topics, root, checkpoints, "sensor_alarms")
    assert not (root / "alarms").exists()
    assert rows(spark, root, "alarms") == []


def test_start_status_and_stop(spark, places):
    topics, root, checkpoints = places
    for name in schemas.TABLES:
        (topics / name).mkdir(parents=True)
    send(topics / "sensor_data", "1.json", reading(1, fill=99.0))

    def source(session, topic):
        return streams.file_json(session, str(topics / topic))

    started = jobs.start_all(spark, str(root), str(checkpoints), source)
    try:
        assert {line["name"] for line in jobs.status(spark)} == {*JOBS, "alert_outbox"}
        for q in started:
            if q.name in ("sensor_alarms", "alert_outbox"):
                q.processAllAvailable()
        assert len(rows(spark, root, "alarms")) == 1
        assert spark.read.parquet(str(root / "alert_outbox")).count() == 1
    finally:
        jobs.stop_all(spark)
    assert jobs.status(spark) == []


def test_pace_of_the_jobs():
    assert {j.name: j.seconds for j in jobs.JOBS} == {
        "bins": 30, "sensor_data": 15, "citizen_reports": 30, "maintenance_events": 30,
        "alarms": 20, "performance_analytics": 60, "route_history": 60, "sensor_alarms": 20,
    }


def test_a_sample_is_shown_on_request(spark, places, capsys):
    topics, root, checkpoints = places
    text = spark.createDataFrame([(json.dumps(reading(n)),) for n in range(5)], "json_str string")
    jobs.process_batch(text, 0, JOBS["sensor_data"], str(root), sample=3)
    assert "only showing top 3 rows" in capsys.readouterr().out


def test_all_topics_from_the_test_tables(spark, small, places):
    topics, root, checkpoints = places
    sources = {
        "bins": ad.bins, "citizen_reports": ad.citizen_reports,
        "maintenance_events": ad.maintenance_events, "route_history": ad.route_history,
    }
    for name, make in sources.items():
        df = make(spark, small)
        wire.to_json_value(df).write.text(str(topics / name))
        work_off(spark, topics, root, checkpoints, name)
        keys = df.select(*schemas.TABLES[name].key).distinct().count()
        assert store.current(spark, str(root), name).count() == keys
    assert dt.datetime(2024, 1, 31) in {
        r.last_maintenance_date for r in store.current(spark, str(root), "bins").collect()
    }


def alarm(n, day, hour=0, kind="overflow", severity="high", **more):
    return {
        "alarm_id": f"a{n}", "bin_id": "b1", "alarm_type": kind, "severity": severity, "status": "active",
        "triggered_at": f"2025-01-{day:02d}T{hour:02d}:00:00Z" if day else "", **more,
    }


def count_off(spark, topics, root, checkpoints):
    stream = parse.read(streams.file_json(spark, str(topics / "alarms"), 1), schemas.ALARMS)
    alerts.start_counts(stream, str(root), str(checkpoints), available_now=True).awaitTermination()
    schema = alerts.counts(stream).schema
    return sorted(
        (r.window_start.day, r.alarm_type, r.severity, r.alarms)
        for r in spark.read.schema(schema).parquet(f"{root}/alarm_counts").collect()
    )


def test_alarms_are_counted_by_event_time(spark, places):
    topics, root, checkpoints = places
    send(topics / "alarms", "1.json", alarm(1, 7), alarm(2, 7, 5), alarm(3, 7, kind="co2_high"), alarm(4, 10, 12), alarm(5, 0))
    closed = [(7, "co2_high", "high", 1), (7, "overflow", "high", 2)]
    # the watermark is at day 8, noon: only day 7 is closed
    assert count_off(spark, topics, root, checkpoints) == closed
    send(
        topics / "alarms", "2.json",
        alarm(6, 7, 23),  # its window is closed
        alarm(7, 8, 12),  # not after the watermark
        alarm(8, 8, 14), alarm(9, 8, 13), alarm(10, 9),  # late, but not too late
        alarm(9, 8, 13), alarm(4, 10, 12),  # sent again
    )
    assert count_off(spark, topics, root, checkpoints) == closed
    send(topics / "alarms", "3.json", alarm(11, 20))
    assert count_off(spark, topics, root, checkpoints) == [
        *closed, (8, "overflow", "high", 2), (9, "overflow", "high", 1), (10, "overflow", "high", 1),
    ]
    # all together, as a batch: nothing is late, and no day is held back
    text = spark.read.text(str(topics / "alarms")).withColumnRenamed("value", "json_str")
    batch = {
        (r.window_start.day, r.alarm_type): r.alarms for r in alerts.counts(parse.read(text, schemas.ALARMS)).collect()
    }
    assert batch == {(7, "co2_high"): 1, (7, "overflow"): 3, (8, "overflow"): 3, (9, "overflow"): 1, (10, "overflow"): 1, (20, "overflow"): 1}


def send_alerts(spark, root, checkpoints, **options):
    alerts.start_outbox(spark, str(root), str(checkpoints), available_now=True, **options).awaitTermination()
    try:
        return sorted(r.alarm_id for r in spark.read.parquet(f"{root}/alert_outbox").collect())
    except Exception:
        return []


def test_one_alert_for_an_alarm_of_two_writers_and_of_a_replay(spark, places, tmp_path):
    topics, root, checkpoints = places
    assert send_alerts(spark, root, checkpoints) == []
    send(topics / "sensor_data", "1.json", reading(1, fill=99.0), reading(2, fill=99.0))
    work_off(spark, topics, root, checkpoints, "sensor_alarms")
    ids = [r.alarm_id for r in rows(spark, root, "alarms")]
    assert send_alerts(spark, root, checkpoints) == sorted(ids)
    # the same alarm by the other writer, and the readings again under a new checkpoint
    send(topics / "alarms", "1.json", alarm(0, 1) | {"alarm_id": ids[0]}, alarm(7, 1))
    work_off(spark, topics, root, checkpoints, "alarms")
    work_off(spark, topics, root, tmp_path / "again", "sensor_alarms")
    assert store.log(spark, str(root), schemas.ALARMS).count() == 6
    assert send_alerts(spark, root, checkpoints) == sorted([*ids, "a7"])


def test_batches_of_alarms_read_a_snapshot_of_the_bins(spark, places, monkeypatch):
    _, root, _ = places
    folds = []
    real = store.current
    monkeypatch.setattr(store, "current", lambda *args: folds.append(args[2].name) or real(*args))
    store.append(bin_of(spark, "b0", location_lat=1.5, location_lng=2.5), str(root), schemas.BINS, "bins", 0)
    of_now = alerts.places(spark, str(root), 3600)
    assert [of_now().count() for _ in range(5)] == [1] * 5 and folds == ["bins"]
    store.append(bin_of(spark, "b1"), str(root), schemas.BINS, "bins", 1)
    assert of_now().count() == 1 and folds == ["bins"]
    of_now = alerts.places(spark, str(root), 0)
    assert [of_now().count() for _ in range(2)] == [2, 2] and folds == ["bins"] * 3
    plan = of_now()._jdf.queryExecution().executedPlan().toString()
    assert "bins-snapshot" in plan and "/log" not in plan


def test_folded_alarms_send_no_alerts(spark, places, tmp_path):
    topics, root, checkpoints = places
    send(topics / "sensor_data", "1.json", reading(1, fill=99.0))
    work_off(spark, topics, root, checkpoints, "sensor_alarms")
    into = tmp_path / "folded"
    store.compact(spark, str(root), "alarms", str(into))
    assert send_alerts(spark, into, tmp_path / "new") == []
    assert len(rows(spark, into, "alarms")) == 1


def test_daily_figures_are_kept_without_reading_again(spark, places, tmp_path):
    _, root, checkpoints = places
    root, checkpoints = str(root), str(checkpoints)
    at = lambda day, n: dt.datetime(2025, 1, day, n % 24, n)
    columns = "sensor_id string, bin_id string, timestamp timestamp_ntz, fill_level double"

    def readings(day, n):
        rows = [(f"{day}-{i}", "b", at(day, i) if i else None, None if i == 3 else float(i)) for i in range(n)]
        df = spark.createDataFrame(rows, columns)
        known = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in schemas.SENSOR_DATA.stored]
        return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(known, schemas.SENSOR_DATA.stored)])

    def go():
        rollup.start(spark, root, checkpoints, schemas.SENSOR_DATA, available_now=True).awaitTermination()

    bins = spark.range(3)
    store.append(readings(1, 50), root, schemas.SENSOR_DATA, "s", 0)
    go()
    before = rollup.partials(spark, root).filter("rows IS NOT NULL")
    assert [(str(r.date), r.rows) for r in before.collect()] == [("2025-01-01", 49)]
    store.append(readings(2, 20), root, schemas.SENSOR_DATA, "s", 1)
    go()
    # the second go adds the new day's partial and nothing else: the first day's rows were not read
    parts = rollup.partials(spark, root).collect()
    assert sorted((r.batch_id, str(r.date), r.rows) for r in parts) == [
        (0, "2025-01-01", 49), (1, "2025-01-02", 19),
    ]
    go()
    assert rollup.partials(spark, root).count() == 2
    routes = spark.createDataFrame(
        [("r", at(2, 1), "collected"), ("r", at(2, 2), "missed"), ("q", at(2, 1), "collected"),
         (None, at(2, 1), "collected"), ("n", at(3, 1), None), ("o", at(4, 1), "missed")],
        "route_id string, service_date timestamp_ntz, collection_status string",
    )
    rollup.append(routes.filter("route_id = 'r'").limit(1), root, schemas.ROUTE_HISTORY, 0)
    rollup.append(routes.exceptAll(routes.filter("route_id = 'r'").limit(1)), root, schemas.ROUTE_HISTORY, 1)
    whole = readings(1, 50).unionByName(readings(2, 20))
    want = kpis.daily_figures(kpis.daily_partials(whole, routes=routes), bins).collect()
    got = rollup.figures(spark, root, bins).collect()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {str(r.date): r.routes_completed for r in got} == {"2025-01-01": 0, "2025-01-02": 2}
    rollup.compact(spark, root, str(tmp_path / "merged"))
    assert sorted(rollup.figures(spark, str(tmp_path / "merged"), bins).collect(), key=str) == sorted(got, key=str)
    with pytest.raises(ValueError):
        rollup.compact(spark, root, root)
    with pytest.raises(ValueError):
        kpis.daily_partials()


def test_figures_of_no_rows(spark):
    empty = spark.createDataFrame([], "sensor_id string, timestamp timestamp_ntz, fill_level double")
    assert kpis.daily_figures(kpis.daily_partials(empty), spark.range(1)).count() == 0


def test_what_jobs_did_stays_known_after_they_ended(spark, places, tmp_path):
    topics, root, checkpoints = places
    ledger = progress.Ledger()
    spark.streams.addListener(ledger)
    runs = []

    def go(name, where=root):
        job = JOBS[name]
        messages = streams.file_json(spark, str(topics / job.topic.name))
        query = jobs.start(messages, job, str(where), str(checkpoints), available_now=True)
        runs.append(query.runId)
        return query

    try:
        send(topics / "sensor_data", "1.json", *[reading(n, fill=n * 5.0) for n in range(20)], "broken")
        go("sensor_data").awaitTermination()
        send(topics / "sensor_data", "2.json", *[reading(n) for n in range(20, 25)])
        go("sensor_data").awaitTermination()
        go("sensor_alarms").awaitTermination()
        blocked = tmp_path / "blocked"
        blocked.write_text("a file where tables should be")
        send(topics / "bins", "1.json", {"bin_id": "b", "capacity": 60.0})
        with pytest.raises(Exception):
            go("bins", blocked).awaitTermination()
        assert all(ledger.wait_until_over(run) for run in runs)
    finally:
        spark.streams.removeListener(ledger)
    assert not spark.streams.active
    lines = [line for line in ledger.lines() if line["name"] in ("sensor_data", "sensor_alarms", "bins")]
    assert [(x["name"], x["state"], x["messages"]) for x in lines] == [
        ("sensor_data", "ended", 21), ("sensor_data", "ended", 5), ("sensor_alarms", "ended", 26), ("bins", "failed", 0),
    ]
    assert lines[-1]["error"] and [x["batches"] for x in lines[:3]] == [1, 1, 1]
    wrote = progress.batches(spark, str(root), "sensor_data").collect()
    assert sorted((r.source, r.batch_id, r.rows) for r in wrote) == [("sensor_data", 0, 20), ("sensor_data", 1, 5)]
    assert [r.rows for r in progress.batches(spark, str(root), "alarms").collect()] == [2]
    assert progress.batches(spark, str(root), "bins").count() == 0
