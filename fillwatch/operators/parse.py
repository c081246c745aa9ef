"""JSON text to typed rows, with bad rows set aside instead of lost."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillwatch.functions import times
from fillwatch.schemas import Table

RAW = "_raw"
BROKEN = "_broken"
_CORRUPT = "_corrupt"


def _once(df: DataFrame, keep: list[str], **values: Column) -> DataFrame:
    """``keep`` and the values, each worked out once per row.

    A filter on a projected value is pushed below the projection and takes the whole
    expression with it, so a JSON text would be parsed again for every field the filter
    names. Filters do not pass a generator, so the values come out of one.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select(*keep, F.inline(F.array(row)))


def json_rows(df: DataFrame, schema: T.StructType, json_col: str = "json_str") -> DataFrame:
    """The schema's columns, the input's other columns, ``_raw`` and ``_broken``.

    A field of the wrong type becomes null and the row stays; text that is no JSON
    object at all gives a row of nulls with ``_broken`` set.
    """
    rest = [c for c in df.columns if c != json_col]
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    all_null = F.coalesce(*[F.col(f"data.{f.name}").cast("string") for f in schema]).isNull()
    broken = F.col("data").isNull() | (F.col(f"data.{_CORRUPT}").isNotNull() & all_null)
    raw = df.withColumnRenamed(json_col, RAW)
    parsed = F.from_json(
        RAW, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    return _once(raw, [*rest, RAW], data=parsed).select(
        *[F.col(f"data.{f.name}").alias(f.name) for f in schema],
        *rest,
        RAW,
        broken.alias(BROKEN),
    )


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of the columns is null."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def typed(df: DataFrame, table: Table) -> DataFrame:
    """Text times and dates of one table turned into their stored types."""
    conversions: dict[str, Column] = {}
    for name in table.times:
        conversions[name] = times.timestamp_any(F.col(name))
    for name in table.nullable_times:
        conversions[name] = times.timestamp_or_null(F.col(name))
    for name in table.dates:
        conversions[name] = times.date_or_null(F.col(name))
    if not conversions:
        return df
    rest = [c for c in df.columns if c not in conversions]
    return _once(df, rest, **conversions).select(*df.columns)


def judge(df: DataFrame, table: Table) -> DataFrame:
    """Adds ``reason`` to parsed and typed rows: why the row is rejected, null if it is good."""
    null_key = F.lit(False)
    for name in table.required:
        null_key = null_key | F.col(name).isNull()
    bad_time = F.lit(False)
    for name in table.required_times:
        bad_time = bad_time | F.col(name).isNull()
    return df.withColumn(
        "reason",
        F.when(F.col(BROKEN), "bad_json").when(null_key, "null_key").when(bad_time, "bad_time"),
    )


def split_rejects(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of parsed and typed rows; the reason is the first that applies."""
    judged = judge(df, table)
    good = judged.filter(F.col("reason").isNull()).drop("reason", RAW, BROKEN)
    rejects = judged.filter(F.col("reason").isNotNull()).select(
        F.lit(table.name).alias("topic"), F.col(RAW).alias("json_str"), "reason"
    )
    return good, rejects


def parsed(df: DataFrame, table: Table, json_col: str = "json_str") -> DataFrame:
    """All messages of one table, good and bad, parsed and typed."""
    return typed(json_rows(df, table.wire, json_col), table)


def read(df: DataFrame, table: Table, json_col: str = "json_str") -> DataFrame:
    """Only the good rows of one table."""
    return split_rejects(parsed(df, table, json_col), table)[0]


# Fields that must not be blank.
CRITICAL_FIELDS = ("timestamp", "installation_date", "last_maintenance")


def fill_critical(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Blank or null critical text fields get the current time or day by their name.

    ``last_maintenance`` names neither, so it stays as it is.
    """
    fills: dict[str, Column] = {}
    for name in CRITICAL_FIELDS:
        if name not in df.columns:
            continue
        if "timestamp" in name:
            default = as_of.strftime("%Y-%m-%d %H:%M:%S")
        elif "date" in name:
            default = as_of.strftime("%Y-%m-%d")
        else:
            continue
        fills[name] = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))
    return df.withColumns(fills) if fills else df
