"""The readable fields of flat records: name, declared type, and the column each stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.paths import follow, parse
from ..functions.values import rfc3339_nanos, timestamp_of_nanos
from .identity import record_id, record_object

#: Selector: declared type and column (fixed names of the data model). ``@`` marks a time kept as nanoseconds.
SHARED = {
    "resource.attributes": ("object", "resource"),
    "resource.schema_url": ("string", "resource_schema_url"),
    "resource.dropped_attributes_count": ("uint", "resource_dropped_attributes_count"),
    "scope.name": ("string", "scope.name"),
    "scope.version": ("string", "scope.version"),
    "scope.attributes": ("object", "scope.attributes"),
    "scope.schema_url": ("string", "scope_schema_url"),
    "scope.dropped_attributes_count": ("uint", "scope.dropped_attributes_count"),
}
OWN = {
    "logs": {
        "log.timestamp": ("timestamp", "@timestamp_unix_nano"),
        "log.observed_timestamp": ("timestamp", "@observed_timestamp_unix_nano"),
        "log.timestamp_unix_nano": ("string", "timestamp_unix_nano"),
        "log.observed_timestamp_unix_nano": ("string", "observed_timestamp_unix_nano"),
        "log.trace_id": ("string", "trace_id"),
        "log.span_id": ("string", "span_id"),
        "log.event_name": ("string", "event_name"),
        "log.severity_text": ("string", "status"),
        "log.severity_number": ("int", "severity_number"),
        "log.flags": ("uint", "flags"),
        "log.dropped_attributes_count": ("uint", "dropped_attributes_count"),
        "log.body": ("dynamic", "body"),
        "log.message": ("string", "message"),
        "log.attributes": ("object", "attributes"),
    },
    "traces": {
        "span.trace_id": ("string", "trace_id"),
        "span.span_id": ("string", "span_id"),
        "span.parent_span_id": ("string", "parent_span_id"),
        "span.trace_state": ("string", "trace_state"),
        "span.flags": ("uint", "flags"),
        "span.name": ("string", "name"),
        "span.kind": ("string", "kind"),
        "span.start_time": ("timestamp", "@start_time_unix_nano"),
        "span.end_time": ("timestamp", "@end_time_unix_nano"),
        "span.start_time_unix_nano": ("string", "start_time_unix_nano"),
        "span.end_time_unix_nano": ("string", "end_time_unix_nano"),
        "span.duration_ns": ("int", "duration_ns"),
        "span.status.code": ("string", "status_code"),
        "span.status.message": ("string", "status_message"),
        "span.attributes": ("object", "attributes"),
        "span.dropped_attributes_count": ("uint", "dropped_attributes_count"),
        "span.events": ("array", "events"),
        "span.dropped_events_count": ("uint", "dropped_events_count"),
        "span.links": ("array", "links"),
        "span.dropped_links_count": ("uint", "dropped_links_count"),
    },
    "metrics": {
        "metric.name": ("string", "metric_name"),
        "metric.description": ("string", "description"),
        "metric.unit": ("string", "unit"),
        "metric.type": ("string", "type"),
        "metric.metadata": ("object", "metadata"),
        "metric.temporality": ("string", "temporality"),
        "metric.is_monotonic": ("boolean", "is_monotonic"),
        "datapoint.timestamp": ("timestamp", "@timestamp_unix_nano"),
        "datapoint.start_time": ("timestamp", "@start_timestamp_unix_nano"),
        "datapoint.timestamp_unix_nano": ("string", "timestamp_unix_nano"),
        "datapoint.start_time_unix_nano": ("string", "start_timestamp_unix_nano"),
        "datapoint.flags": ("uint", "flags"),
        "datapoint.attributes": ("object", "attributes"),
        "datapoint.value": ("number", "value"),
        "datapoint.value_type": ("string", "value_type"),
        "datapoint.int_value": ("int", "int_value"),
        "datapoint.double_value": ("float", "double_value"),
        "datapoint.number_value": ("float", "number_value"),
        "datapoint.distribution": ("object", "distribution"),
        "datapoint.exemplars": ("array", "exemplars"),
    },
}


def selectors(signal: str) -> list[str]:
    return ["record", "record.id", *SHARED, *OWN[signal]]


def select(selector: str, signal: str, printed: Column | None = None) -> tuple[Column, str]:
    """Column and declared type of a selector with its path, if it has one; ValueError if there is none like it. ``printed`` as for ``record_id``."""
    name, steps = parse(selector)
    if name == "record":
        kind, column = "object", record_object(signal)
    elif name == "record.id":
        kind, column = "string", record_id(signal, printed)
    else:
        found = SHARED.get(name) or OWN[signal].get(name)
        if not found:
            raise ValueError(f"no selector {name!r} for {signal}")
        kind, source = found
        column = timestamp_of_nanos(F.col(source[1:])) if source[0] == "@" else F.col(source)
        if kind == "array":
            column = F.to_variant_object(column)
        if kind == "uint":
            column = column.cast("decimal(20,0)")
    if not steps:
        return column, kind
    if kind not in ("object", "array", "dynamic"):
        raise ValueError(f"{name} is {kind}, which has no parts: {selector!r}")
    if kind == "object" and isinstance(steps[0], int) or kind == "array" and isinstance(steps[0], str):
        raise ValueError(f"{name} is {kind}: the first step of {selector!r} is of the other kind")
    return follow(column, steps), "dynamic"


def select_text(selector: str, signal: str) -> tuple[Column, str]:
    """As ``select``, but times are texts with all nine digits of a second that a timestamp can't hold."""
    column, kind = select(selector, signal)
    source = (SHARED | OWN[signal]).get(selector, (None, ""))[1]
    return (rfc3339_nanos(F.col(source[1:])), "string") if source.startswith("@") else (column, kind)
