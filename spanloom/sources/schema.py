"""Spark schemas of OTLP export requests in JSON.

64-bit integers may come as numbers or as strings, so they are decimals. An attribute value is recursive, a schema is
not: values without parts are read with their type, arrays and lists of entries are variants of their JSON, at any depth.
"""

from __future__ import annotations

import re

#: Names of enum numbers, from 0 on (fixed by the protocol).
SPAN_KINDS = ("unspecified", "internal", "server", "client", "producer", "consumer")
STATUS_CODES = ("unset", "ok", "error")
TEMPORALITIES = ("unspecified", "delta", "cumulative")
SEVERITIES = ("unspecified", *(f"{name}{n}" for name in ("trace", "debug", "info", "warn", "error", "fatal") for n in ("", 2, 3, 4)))
#: The field that holds an enum, the start of its names in JSON, and the names.
ENUMS = {"kind": ("SPAN_KIND_", SPAN_KINDS), "code": ("STATUS_CODE_", STATUS_CODES), "aggregationTemporality": ("AGGREGATION_TEMPORALITY_", TEMPORALITIES), "severityNumber": ("SEVERITY_NUMBER_", SEVERITIES)}

U64 = "decimal(20,0)"
#: An attribute value by its kinds; integers as they are written.
VALUE = "struct<stringValue: string, intValue: string, doubleValue: double, boolValue: boolean, bytesValue: string, arrayValue: variant, kvlistValue: variant>"
ATTRIBUTES = f"array<struct<key: string, value: {VALUE}>>"


def request_schema(signal: str) -> str:
    """Schema of one export request of a signal, as DDL."""
    kv = ATTRIBUTES
    resource = f"struct<attributes: {kv}, droppedAttributesCount: bigint>"
    scope = f"struct<name: string, version: string, attributes: {kv}, droppedAttributesCount: bigint>"
    exemplar = f"struct<filteredAttributes: {kv}, timeUnixNano: {U64}, asDouble: double, asInt: {U64}, traceId: string, spanId: string>"
    point = f"attributes: {kv}, startTimeUnixNano: {U64}, timeUnixNano: {U64}, flags: bigint"
    number = f"struct<{point}, asDouble: double, asInt: {U64}, exemplars: array<{exemplar}>>"
    whole = f"count: {U64}, sum: double, min: double, max: double"
    histogram = f"struct<{point}, {whole}, bucketCounts: array<{U64}>, explicitBounds: array<double>, exemplars: array<{exemplar}>>"
    buckets = f"struct<offset: int, bucketCounts: array<{U64}>>"
    exponential = f"struct<{point}, {whole}, scale: int, zeroCount: {U64}, zeroThreshold: double, positive: {buckets}, negative: {buckets}, exemplars: array<{exemplar}>>"
    summary = f"struct<{point}, count: {U64}, sum: double, quantileValues: array<struct<quantile: double, value: double>>>"
    event = f"struct<timeUnixNano: {U64}, name: string, attributes: {kv}, droppedAttributesCount: bigint>"
    link = f"struct<traceId: string, spanId: string, traceState: string, attributes: {kv}, droppedAttributesCount: bigint, flags: bigint>"
    items = {
        "logs": f"struct<timeUnixNano: {U64}, observedTimeUnixNano: {U64}, severityNumber: int, severityText: string, body: {VALUE}, attributes: {kv}, droppedAttributesCount: bigint, flags: bigint, traceId: string, spanId: string, eventName: string>",
        "traces": f"struct<traceId: string, spanId: string, traceState: string, parentSpanId: string, flags: bigint, name: string, kind: int, startTimeUnixNano: {U64}, endTimeUnixNano: {U64}, attributes: {kv}, droppedAttributesCount: bigint, events: array<{event}>, droppedEventsCount: bigint, links: array<{link}>, droppedLinksCount: bigint, status: struct<message: string, code: int>>",
        "metrics": f"struct<name: string, description: string, unit: string, metadata: {kv}, gauge: struct<dataPoints: array<{number}>>, sum: struct<dataPoints: array<{number}>, aggregationTemporality: int, isMonotonic: boolean>, histogram: struct<dataPoints: array<{histogram}>, aggregationTemporality: int>, exponentialHistogram: struct<dataPoints: array<{exponential}>, aggregationTemporality: int>, summary: struct<dataPoints: array<{summary}>>>",
    }
    top, scopes, leaf = PARTS[signal]
    return f"{top} array<struct<resource: {resource}, schemaUrl: string, {scopes}: array<struct<scope: {scope}, schemaUrl: string, {leaf}: array<{items[signal]}>>>>>"


#: Names of the three levels of a request.
PARTS = {"logs": ("resourceLogs", "scopeLogs", "logRecords"), "traces": ("resourceSpans", "scopeSpans", "spans"), "metrics": ("resourceMetrics", "scopeMetrics", "metrics")}


def loose_schema(signal: str) -> str:
    """The same with a text for every number and truth value, and values as variants: what is no such thing doesn't cost the request."""
    return re.sub(r"\b(bigint|int|double|boolean|decimal\(20,0\))(?=[,>]|$)", "string", request_schema(signal).replace(VALUE, "variant"))


def snake_keys(signal: str) -> dict[str, str]:
    """Names of the fields as they are written in the protocol's own definition, and as JSON writes them."""
    names = set(re.findall(r"\b[a-z]+(?:[A-Z][a-z]*)+\b", request_schema(signal))) | {"stringValue", "intValue", "doubleValue", "boolValue", "bytesValue", "arrayValue", "kvlistValue"}
    return {re.sub("([A-Z])", lambda m: "_" + m[1].lower(), n): n for n in sorted(names)}
