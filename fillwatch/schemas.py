"""Fixed schemas of the seven entities, on the wire and as stored.

Fixed values: column names, types and keys are the data contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """One keyed table: its key, its JSON schema and its stored schema."""

    name: str
    key: tuple[str, ...]
    wire: T.StructType
    stored: T.StructType
    required: tuple[str, ...]
    """Columns a parsed row must carry, or it is rejected."""
    times: tuple[str, ...] = ()
    """Text columns parsed to timestamps."""
    nullable_times: tuple[str, ...] = ()
    """Text columns parsed to timestamps where blank means null."""
    required_times: tuple[str, ...] = ()
    """Times without which the row is rejected."""
    dates: tuple[str, ...] = ()
    event_time: str | None = None


TEXT, DOUBLE, INT, LONG, FLAG, TIME = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    """A schema of nullable fields, built without a running session."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _table(name: str, key: str, wire_schema: T.StructType, required: str, **kinds) -> Table:
    to_time = set(kinds.get("times", ())) | set(kinds.get("nullable_times", ()))
    to_date = set(kinds.get("dates", ()))

    def stored_type(f: T.StructField) -> T.DataType:
        if f.name in to_time:
            return T.TimestampType()
        return T.DateType() if f.name in to_date else f.dataType

    stored = T.StructType([T.StructField(f.name, stored_type(f)) for f in wire_schema])
    return Table(name, tuple(key.split()), wire_schema, stored, tuple(required.split()), **kinds)


BINS = _table(
    "bins",
    "bin_id",
    struct(
        bin_id=TEXT,
        location_lat=DOUBLE,
        location_lng=DOUBLE,
        type=TEXT,
        capacity=DOUBLE,
        current_fill_level=DOUBLE,
        status=TEXT,
        last_maintenance_date=TIME,
        installation_date=TIME,
    ),
    "bin_id",
)
SENSOR_DATA = _table(
    "sensor_data",
    "sensor_id",
    struct(
        sensor_id=TEXT,
        bin_id=TEXT,
        timestamp=TEXT,
        fill_level=DOUBLE,
        temperature=DOUBLE,
        weight=DOUBLE,
        humidity=DOUBLE,
        status=TEXT,
    ),
    "sensor_id bin_id",
    times=("timestamp",),
    required_times=("timestamp",),
    event_time="timestamp",
)
CITIZEN_REPORTS = _table(
    "citizen_reports",
    "report_id",
    struct(
        report_id=TEXT,
        bin_id=TEXT,
        report_timestamp=TEXT,
        report_type=TEXT,
        description=TEXT,
        resolved=FLAG,
        resolved_timestamp=TEXT,
    ),
    "report_id bin_id",
    times=("report_timestamp",),
    nullable_times=("resolved_timestamp",),
    event_time="report_timestamp",
)
MAINTENANCE_EVENTS = _table(
    "maintenance_events",
    "event_id",
    struct(
        event_id=TEXT,
        bin_id=TEXT,
        maintenance_type=TEXT,
        event_timestamp=TEXT,
        performed_by=TEXT,
        duration=DOUBLE,
        cost=DOUBLE,
    ),
    "event_id bin_id",
    times=("event_timestamp",),
    event_time="event_timestamp",
)
ALARMS = _table(
    "alarms",
    "alarm_id",
    struct(
        alarm_id=TEXT,
        bin_id=TEXT,
        alarm_type=TEXT,
        triggered_at=TEXT,
        resolved_at=TEXT,
        severity=TEXT,
        status=TEXT,
    ),
    "alarm_id bin_id",
    times=("triggered_at",),
    nullable_times=("resolved_at",),
    event_time="triggered_at",
)
ROUTE_HISTORY = _table(
    "route_history",
    "route_id bin_id",
    struct(
        route_id=TEXT,
        bin_id=TEXT,
        service_date=TEXT,
        collection_status=TEXT,
    ),
    "route_id bin_id",
    times=("service_date",),
    event_time="service_date",
)
PERFORMANCE_ANALYTICS = _table(
    "performance_analytics",
    "id",
    struct(
        id=TEXT,
        date=TEXT,
        total_bins=INT,
        avg_fill_level=DOUBLE,
        total_reports=INT,
        resolved_reports=INT,
        maintenance_events_count=INT,
        avg_response_time=DOUBLE,
        alarms_count=INT,
        routes_completed=INT,
    ),
    "id",
    dates=("date",),
    event_time="date",
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        BINS,
        SENSOR_DATA,
        CITIZEN_REPORTS,
        MAINTENANCE_EVENTS,
        ALARMS,
        ROUTE_HISTORY,
        PERFORMANCE_ANALYTICS,
    )
}

RAW_BIN = struct(
    bin_id=TEXT,
    type=TEXT,
    capacity=DOUBLE,
    capacity_kg=DOUBLE,
    latitude=DOUBLE,
    longitude=DOUBLE,
    current_fill_level=DOUBLE,
    installation_date=TIME,
    last_maintenance=TIME,
    location=struct(
        street=TEXT,
        district=TEXT,
        coordinates=struct(lat=DOUBLE, lon=DOUBLE),
    ),
    status=TEXT,
)
"""The nested record a bin registers itself with."""
