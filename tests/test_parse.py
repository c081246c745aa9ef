import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fillwatch import schemas
from fillwatch.functions import times
from fillwatch.operators import parse
from fillwatch.schemas import DOUBLE, FLAG, INT, TEXT, TIME, struct
from fillwatch.sources import streams, wire

SCHEMA = struct(bin_id=TEXT, cap=DOUBLE, n=INT, b=FLAG, ts=TIME)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"bin_id":"a","cap":"x","n":2}', ("a", None, 2, None)),
        ('{"bin_id":"a","cap":"1.5"}', ("a", None, None, None)),
        ('{"bin_id":"a","n":2.7}', ("a", None, None, None)),
        ('{"bin_id":"a","b":"true"}', ("a", None, None, None)),
        ('{"bin_id":7}', ("7", None, None, None)),
        ('{"bin_id":{"k":1}}', ('{"k":1}', None, None, None)),
        ('{"BIN_ID":"a","n":1}', (None, None, 1, None)),
        ('{"bin_id":"a","n":1,"n":2}', ("a", None, 2, None)),
        ('{"bin_id":"a","other":1}', ("a", None, None, None)),
        ('{"bin_id":"a","ts":"junk","n":3}', ("a", None, 3, None)),
    ],
)
def test_fields_of_the_wrong_type_become_null(spark, text, expected):
    row = parse.json_rows(spark.createDataFrame([(text,)], "json_str string"), SCHEMA).first()
    assert (row.bin_id, row.cap, row.n, row.b) == expected
    assert not row[parse.BROKEN]


@pytest.mark.parametrize("text", ["not json", "", '{"bin_id":"a"', '[{"bin_id":"a"}]', None])
def test_text_that_is_no_object_is_broken(spark, text):
    row = parse.json_rows(spark.createDataFrame([(text,)], "json_str string"), SCHEMA).first()
    assert row.bin_id is None and row[parse.BROKEN]


def test_nan_is_a_number(spark):
    rows = spark.createDataFrame([('{"bin_id":"a","cap":NaN}',)], "json_str string")
    assert math.isnan(parse.json_rows(rows, SCHEMA).first().cap)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-02T03:04:05.123456+00:00", dt.datetime(2025, 1, 2, 3, 4, 5, 123456)),
        ("2025-01-02T03:04:05.123456Z", dt.datetime(2025, 1, 2, 3, 4, 5, 123456)),
        ("2025-01-02T03:04:05.123+02:00", dt.datetime(2025, 1, 2, 1, 4, 5, 123000)),
        ("2025-01-02T03:04:05+00:00", dt.datetime(2025, 1, 2, 3, 4, 5)),
        ("2025-01-02T03:04:05.123456", dt.datetime(2025, 1, 2, 3, 4, 5, 123456)),
        ("2025-01-02T03:04:05", dt.datetime(2025, 1, 2, 3, 4, 5)),
        ("2025-01-02 03:04:05", dt.datetime(2025, 1, 2, 3, 4, 5)),
        ("2025-01-02", dt.datetime(2025, 1, 2)),
        ("junk", None),
        ("", None),
        ("2025-13-45", None),
        (None, None),
    ],
)
def test_timestamps_in_any_spelling(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(
        times.timestamp_any(F.col("t")).cast("timestamp_ntz"),
        times.timestamp_or_null(F.col("t")).cast("timestamp_ntz"),
    ).first()
    assert tuple(got) == (expected, expected)


def test_dates(spark):
    df = spark.createDataFrame([("2025-01-02",), ("junk",), (None,)], "t string")
    got = [r[0] for r in df.select(times.date_or_null(F.col("t"))).collect()]
    assert got == [dt.date(2025, 1, 2), None, None]


def test_rejects_give_the_first_reason(spark):
    texts = [
        '{"sensor_id":"s","bin_id":"b","timestamp":"2025-01-02"}',
        "oops",
        '{"sensor_id":"s","timestamp":"junk"}',
        '{"bin_id":"b","timestamp":"2025-01-02"}',
        '{"sensor_id":"s","bin_id":"b","timestamp":"junk"}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "json_str string")
    good, bad = parse.split_rejects(parse.parsed(df, schemas.SENSOR_DATA), schemas.SENSOR_DATA)
    assert good.count() == 1
    assert {r.json_str: r.reason for r in bad.collect()} == {
        texts[1]: "bad_json",
        texts[2]: "null_key",
        texts[3]: "null_key",
        texts[4]: "bad_time",
    }


def test_other_topics_keep_rows_without_a_time(spark):
    df = spark.createDataFrame(
        [('{"report_id":"r","bin_id":"b","report_timestamp":"junk","resolved_timestamp":""}',)],
        "json_str string",
    )
    row = parse.read(df, schemas.CITIZEN_REPORTS).first()
    assert row.report_timestamp is None and row.resolved_timestamp is None


@pytest.mark.parametrize("table", schemas.TABLES.values(), ids=lambda t: t.name)
def test_parsed_rows_have_the_stored_schema(spark, table):
    df = spark.createDataFrame([], "json_str string")
    got = parse.read(df, table).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in table.stored]


def test_a_message_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "json_str string")
    plan = parse.read(df, schemas.SENSOR_DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_round_trip_keeps_micros_and_nulls(spark):
    moment = dt.datetime(2025, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([("r", "b", moment, None)], schemas.ROUTE_HISTORY.stored)
    text = wire.to_json_value(df, name="json_str")
    assert '"collection_status":null' in text.first().json_str
    assert parse.read(text, schemas.ROUTE_HISTORY).collect() == df.collect()


def test_kafka_options(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP", "broker:1")
    options = streams.kafka_options("bins", maxOffsetsPerTrigger=50_000)
    assert options["kafka.bootstrap.servers"] == "broker:1"
    assert options["subscribe"] == "bins"
    assert options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "true"
    assert options["maxOffsetsPerTrigger"] == "50000"
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("bins")


def test_payload_keeps_the_place_in_the_topic(spark):
    columns = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
    df = spark.createDataFrame(
        [(None, b'{"a":1}', "bins", 2, 7, dt.datetime(2025, 1, 1))], columns
    )
    row = streams.payload(df).first()
    assert (row.json_str, row.arrived_partition, row.arrived_offset) == ('{"a":1}', 2, 7)


def test_tolerant_parse_first_reads_what_the_patterns_read(spark):
    from pyspark.sql import functions as F

    from fillwatch.functions import times

    texts = [
        "2025-01-02T03:04:05.123456+02:00", "2025-01-02T03:04:05.123-05:30", "2025-01-02T03:04:05Z",
        "2025-01-02T03:04:05.123456", "2025-01-02T03:04:05.123", "2025-01-02T03:04:05", "2025-01-02",
        "2025-1-2", "2025-01-2T3:04:05", "12025-01-02", "0001-01-01", "-0044-03-15", "  2025-01-02 ",
        "2025-13-02", "2025-02-30", "2025-01-02T24:00:00", "2025-01-02 03:04", "2025-01", "2025",
        "junk", "", " ", "2025-01-02Tjunk", "2025-01-02T03:04:05+0200", "03:04:05", "1735787045", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    tries = [F.try_to_timestamp("t", F.lit(p)) for p in times.TIMESTAMP_PATTERNS]
    # a bare time of day is today's: compared as such
    before = F.coalesce(*tries, F.try_to_timestamp("t"))
    rows = df.select(
        "t", times.timestamp_any(F.col("t")).cast("string").alias("now"), before.cast("string").alias("before")
    ).collect()
    assert [(r.t, r.now) for r in rows] == [(r.t, r.before) for r in rows]
