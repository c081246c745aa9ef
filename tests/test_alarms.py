import datetime as dt

import pytest

from fillwatch import schemas
from fillwatch.operators import alarms, records
from fillwatch.functions import levels
from pyspark.sql import functions as F

NAN = float("nan")


def readings(spark, *pairs):
    rows = [
        (f"s{i}", "b", dt.datetime(2025, 1, 1), fill, temp, None, None, None)
        for i, (fill, temp) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, schemas.SENSOR_DATA.stored)


@pytest.mark.parametrize(
    "fill, temp, expected",
    [
        (95.0, None, ("overflow", "critical")),
        (None, 70.0, ("temperature", "critical")),
        (90.0, 59.9, ("overflow", "high")),
        (89.99, 60.0, ("temperature", "high")),
        (92.0, 75.0, ("overflow", "critical")),
        (NAN, 10.0, ("overflow", "critical")),
        (None, None, None),
        (89.0, 59.0, None),
    ],
)
def test_boundaries(spark, fill, temp, expected):
    got = alarms.detect(readings(spark, (fill, temp))).collect()
    assert [(r.alarm_type, r.severity) for r in got] == ([expected] if expected else [])


def test_nan_can_be_switched_off(spark):
    assert alarms.detect(readings(spark, (NAN, 10.0)), nan_policy="null").count() == 0
    with pytest.raises(ValueError):
        alarms.detect(readings(spark), nan_policy="other")


def test_ids_are_repeatable_and_columns_in_order(spark):
    df = alarms.detect(readings(spark, (95.0, 1.0), (1.0, 95.0)))
    assert tuple(df.columns) == alarms.ALARM_COLUMNS
    assert df.collect() == df.collect()
    assert len({r.alarm_id for r in df.collect()}) == 2


def test_message_without_a_known_bin(spark):
    bins = spark.createDataFrame([], schemas.BINS.stored)
    row = alarms.outbox(alarms.detect(readings(spark, (95.0, 1.0))), bins).first()
    assert row.subject == "URGENT: overflow - b"
    assert "?q=,\n" in row.body


def test_missing_fill_has_the_smallest_marker(spark):
    df = spark.createDataFrame([(None,), (NAN,), (0.0,), (20.0,), (90.0,)], "f double")
    got = [r[0] for r in df.select(levels.marker_size(F.col("f"))).collect()]
    assert got == [20.0, 20.0, 20.0, 30.0, 50.0]


def test_fill_classes(spark):
    df = spark.createDataFrame(
        [(29.9,), (30.0,), (80.0,), (NAN,), (None,)], "fill_level double"
    )
    got = [r.fill_class for r in records.with_fill_class(df).collect()]
    assert got == ["empty", "partial", "full", "full", None]
