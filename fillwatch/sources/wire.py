"""Rows out to JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how times are written.
WIRE_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_json_value(df: DataFrame, keep: tuple[str, ...] = (), name: str = "value") -> DataFrame:
    """One JSON object per row in ``name``; columns in ``keep`` stay beside it.

    Microseconds and null fields are kept: the defaults of ``to_json`` cut times to
    milliseconds and drop nulls, and a round trip would lose both.
    """
    fields = [
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name)
        for f in df.schema
        if f.name not in keep
    ]
    options = {"timestampFormat": WIRE_TIMESTAMP, "ignoreNullFields": "false"}
    return df.select(*keep, F.to_json(F.struct(*fields), options).alias(name))
