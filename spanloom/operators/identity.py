"""Whole records as objects, their content ids, and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import bind, holds_non_finite, may_hold_non_finite

CONTEXT = ["resource", "resource_schema_url", "resource_dropped_attributes_count", "scope", "scope_schema_url"]
#: Fields of each signal's record, without its place in a batch.
RECORD = {
    "logs": ["timestamp_unix_nano", "observed_timestamp_unix_nano", "trace_id", "span_id", "event_name", "status", "severity_number", "flags", "dropped_attributes_count", "body", "message", "attributes", *CONTEXT],
    "traces": ["trace_id", "span_id", "parent_span_id", "trace_state", "flags", "name", "kind", "start_time_unix_nano", "end_time_unix_nano", "duration_ns", "status_code", "status_message", "attributes", "dropped_attributes_count", "events", "dropped_events_count", "links", "dropped_links_count", *CONTEXT],
    "metrics": ["metric_name", "description", "unit", "metadata", "type", "temporality", "is_monotonic", "timestamp_unix_nano", "start_timestamp_unix_nano", "flags", "attributes", "value", "value_type", "int_value", "double_value", "number_value", "exemplars", "distribution", *CONTEXT],
}


#: Fields of what a record holds, in the order of their names, as objects print them.
PARTS = {
    "scope": ["attributes", "dropped_attributes_count", "name", "version"],
    "events": ["attributes", "dropped_attributes_count", "name", "timestamp_unix_nano"],
    "links": ["attributes", "dropped_attributes_count", "flags", "span_id", "trace_id", "trace_state"],
    "exemplars": ["filtered_attributes", "span_id", "timestamp_unix_nano", "trace_id", "value", "value_type"],
}


def record_object(signal: str) -> Column:
    """The record as one object, without its place."""
    return F.to_variant_object(F.struct(*RECORD[signal]))


#: Fields that are variants, and numbers that may have a fraction; other fields without parts are texts, whole numbers and truth values.
OPEN = {"resource", "attributes", "body", "metadata", "value", "distribution"}
REAL = {"double_value", "number_value"}
WHOLE = {"severity_number", "flags", "dropped_attributes_count", "dropped_events_count", "dropped_links_count", "duration_ns", "int_value", "is_monotonic", "resource_dropped_attributes_count"}
#: Characters that JSON escapes.
ESCAPED = r'["\\\x00-\x1f]'


def record_json(signal: str) -> Column:
    """The record as JSON with sorted keys: the text of ``record_object``, put together from its columns, as printing an object sets up a writer
    for every key and text. Records with a text that JSON escapes, which one search over all of them tells, are printed."""
    names = sorted(RECORD[signal])
    texts = [F.col(name) for name in names if name not in {*OPEN, *REAL, *WHOLE, *PARTS}] + [F.col("scope.name"), F.col("scope.version")]
    plain = F.concat(F.lit("{"), *pieces({name: printed_field(name) for name in names}), F.lit("}"))
    return F.when(F.concat_ws("", *texts).rlike(ESCAPED), printed_record(names)).otherwise(plain)


def pieces(fields: dict[str, Column]) -> list[Column]:
    return [x for n, (name, c) in enumerate(fields.items()) for x in (F.lit(f'{"," if n else ""}"{name}":'), c)]


def sorted_parts(x: Column, name: str) -> Column:
    return F.when(x.isNotNull(), F.struct(*(x[f].alias(f) for f in PARTS[name])))


def printed_record(names: list[str]) -> Column:
    def field(name: str) -> Column:
        c = F.col(name)
        return sorted_parts(c, name) if name == "scope" else F.transform(c, lambda x: sorted_parts(x, name)) if name in PARTS else c

    return F.to_json(F.struct(*(field(f).alias(f) for f in names)), {"ignoreNullFields": "false"})


def printed_field(name: str) -> Column:
    """A field as JSON, if no text in it is escaped; a text that is escaped is the caller's to print."""
    c, null, text = F.col(name), F.lit("null"), lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    if name == "scope":
        parts = {"attributes": F.coalesce(F.to_json(c["attributes"]), null), "dropped_attributes_count": F.coalesce(c["dropped_attributes_count"].cast("string"), null), "name": F.coalesce(text(c["name"]), null), "version": F.coalesce(text(c["version"]), null)}
        return F.when(c.isNotNull(), F.concat(F.lit("{"), *pieces(parts), F.lit("}"))).otherwise(null)
    if name in PARTS:
        listed = F.to_json(F.transform(c, lambda x: sorted_parts(x, name)), {"ignoreNullFields": "false"})
        return F.when(F.size(c) == 0, F.lit("[]")).otherwise(F.coalesce(listed, null))
    if name in OPEN:
        return F.coalesce(F.to_json(c), null)
    if name in REAL:
        return F.coalesce(F.when(F.isnan(c) | (F.abs(c) == float("inf")), text(c.cast("string"))).otherwise(c.cast("string")), null)
    return F.coalesce(c.cast("string") if name in WHOLE else text(c), null)


#: The record as JSON, in a column beside the record.
RECORD_JSON = "__record_json"


def record_id(signal: str, printed: Column | None = None) -> Column:
    """SHA-256 of the signal, a zero byte and the record as JSON with sorted keys: the same for equal records, however
    batched and in whatever order of keys. Null if a number in it is not finite, which JSON can't hold. ``printed`` is the record as JSON, if
    that is at hand: what is bound is interpreted, a column is compiled."""
    hashed = lambda body: F.sha2(F.concat(F.lit(f"{signal}\0".encode()), body.cast("binary")), 256)
    told = lambda body: F.when(~F.when(may_hold_non_finite(body), holds_non_finite(record_object(signal), body)).otherwise(False), hashed(body))
    return bind(record_json(signal), told) if printed is None else told(printed)


def with_record_json(records: DataFrame, signal: str) -> DataFrame:
    return records.withColumn(RECORD_JSON, record_json(signal))


def with_record_id(records: DataFrame, signal: str) -> DataFrame:
    return with_record_json(records, signal).withColumn("row_id", record_id(signal, F.col(RECORD_JSON))).drop(RECORD_JSON)


def duplicates(records: DataFrame, signal: str) -> DataFrame:
    """Content ids that several records share, with how many; nothing is removed. Records without an id are no copies."""
    return with_record_id(records, signal).groupBy("row_id").agg(F.count("row_id").alias("copies")).where("copies > 1")
