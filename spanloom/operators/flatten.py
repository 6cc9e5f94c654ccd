"""Nested requests to one flat record per log, span or metric point.

Input: (request_id, resources) as ``sources.otlp.decode`` gives. Every record carries its resource's and scope's
context, and its place (resource_pos, scope_pos, item_pos, and point_pos for metrics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import attribute_object, kept_here, message_text, nanos_text, value_of
from ..sources.schema import PARTS, SPAN_KINDS, STATUS_CODES, TEMPORALITIES

CONTEXT = ["resource", "resource_schema_url", "resource_dropped_attributes_count", "scope", "scope_schema_url"]
PLACE = ["request_id", "resource_pos", "scope_pos", "item_pos"]


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def count(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("bigint")


def named(code: Column, names: tuple[str, ...]) -> Column:
    """Name of an enum number, the first for none; '' beyond the list."""
    return F.coalesce(F.get(F.array(*map(F.lit, names)), F.coalesce(code, F.lit(0))), F.lit(""))


def transformed(listed: Column, one) -> Column:
    """``one`` of each element; an empty list, without going through it, where there is none."""
    return F.coalesce(F.when(F.size(listed) > 0, F.transform(listed, one)), F.array())


def items(requests: DataFrame, signal: str) -> DataFrame:
    """One row per item with its context: columns PLACE, CONTEXT and ``item``."""
    _, scopes, leaf = PARTS[signal]
    rows = requests.select("request_id", F.posexplode("resources").alias("resource_pos", "r"))
    rows = rows.select("request_id", "resource_pos", F.col("r.resource").alias("res"), F.col("r.schemaUrl").alias("res_url"), F.posexplode(f"r.{scopes}").alias("scope_pos", "s"))
    scope = F.col("s.scope")
    scope_attributes = F.when(F.size(scope["attributes"]) > 0, attribute_object(scope["attributes"]))
    context = {
        "resource": attribute_object(F.col("res.attributes")),
        "resource_schema_url": text(F.col("res_url")),
        "resource_dropped_attributes_count": count(F.col("res.droppedAttributesCount")),
        "scope": F.struct(text(scope["name"]).alias("name"), text(scope["version"]).alias("version"), count(scope["droppedAttributesCount"]).alias("dropped_attributes_count"), scope_attributes.alias("attributes")),
        "scope_schema_url": text(F.col("s.schemaUrl")),
    }
    rows = rows.select("request_id", "resource_pos", "scope_pos", *(c.alias(n) for n, c in context.items()), F.col(f"s.{leaf}").alias("leaves"))
    return rows.select("request_id", "resource_pos", "scope_pos", *CONTEXT, F.posexplode("leaves").alias("item_pos", "item"))


def flatten_logs(requests: DataFrame) -> DataFrame:
    i = F.col("item")
    rows = items(requests, "logs").withColumn("body", value_of(i["body"]))
    return rows.select(
        *PLACE,
        nanos_text(i["timeUnixNano"]).alias("timestamp_unix_nano"),
        nanos_text(i["observedTimeUnixNano"]).alias("observed_timestamp_unix_nano"),
        text(i["traceId"]).alias("trace_id"),
        text(i["spanId"]).alias("span_id"),
        text(i["eventName"]).alias("event_name"),
        text(i["severityText"]).alias("status"),
        count(i["severityNumber"]).alias("severity_number"),
        count(i["flags"]).alias("flags"),
        count(i["droppedAttributesCount"]).alias("dropped_attributes_count"),
        "body",
        message_text(F.col("body")).alias("message"),
        attribute_object(i["attributes"]).alias("attributes"),
        *CONTEXT,
    )


def duration_ns(start: Column, end: Column) -> Column:
    """End minus start as a signed 64-bit number, into which longer ones wrap; null when one is zero or missing, or the end comes first."""
    whole = (end - start).cast("decimal(21,0)")
    wrapped = F.when(whole >= F.lit(str(1 << 63)).cast("decimal(21,0)"), whole - F.lit(str(1 << 64)).cast("decimal(21,0)")).otherwise(whole)
    return F.when((start > 0) & (end > 0) & (end >= start), wrapped.cast("decimal(20,0)").try_cast("bigint"))


def span_events(events: Column) -> Column:
    one = lambda e: F.struct(text(e["name"]).alias("name"), nanos_text(e["timeUnixNano"]).alias("timestamp_unix_nano"), attribute_object(e["attributes"]).alias("attributes"), count(e["droppedAttributesCount"]).alias("dropped_attributes_count"))
    return transformed(events, one)


def span_links(links: Column) -> Column:
    one = lambda x: F.struct(text(x["traceId"]).alias("trace_id"), text(x["spanId"]).alias("span_id"), text(x["traceState"]).alias("trace_state"), attribute_object(x["attributes"]).alias("attributes"), count(x["droppedAttributesCount"]).alias("dropped_attributes_count"), count(x["flags"]).alias("flags"))
    return transformed(links, one)


def flatten_traces(requests: DataFrame) -> DataFrame:
    i = F.col("item")
    return items(requests, "traces").select(
        *PLACE,
        text(i["traceId"]).alias("trace_id"),
        text(i["spanId"]).alias("span_id"),
        text(i["parentSpanId"]).alias("parent_span_id"),
        text(i["traceState"]).alias("trace_state"),
        count(i["flags"]).alias("flags"),
        text(i["name"]).alias("name"),
        named(i["kind"], SPAN_KINDS).alias("kind"),
        nanos_text(i["startTimeUnixNano"]).alias("start_time_unix_nano"),
        nanos_text(i["endTimeUnixNano"]).alias("end_time_unix_nano"),
        duration_ns(i["startTimeUnixNano"], i["endTimeUnixNano"]).alias("duration_ns"),
        named(i["status"]["code"], STATUS_CODES).alias("status_code"),
        text(i["status"]["message"]).alias("status_message"),
        attribute_object(i["attributes"]).alias("attributes"),
        count(i["droppedAttributesCount"]).alias("dropped_attributes_count"),
        span_events(i["events"]).alias("events"),
        count(i["droppedEventsCount"]).alias("dropped_events_count"),
        span_links(i["links"]).alias("links"),
        count(i["droppedLinksCount"]).alias("dropped_links_count"),
        *CONTEXT,
    )


TYPES = {"gauge": "gauge", "sum": "sum", "histogram": "histogram", "exponentialHistogram": "exponential_histogram", "summary": "summary"}


def split_invalid_metrics(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metric items that can be flattened, and rejects: a metric goes whole if it has no data type or a point without a number.

    Rejects: PLACE, metric_name, reason, data_points.
    """
    i = F.col("item")
    kind = F.coalesce(*(F.when(i[field].isNotNull(), F.lit(name)) for field, name in TYPES.items()))
    empty = lambda p: p["asInt"].isNull() & p["asDouble"].isNull()
    hollow = F.coalesce(F.exists(i["gauge"]["dataPoints"], empty), F.lit(False)) | F.coalesce(F.exists(i["sum"]["dataPoints"], empty), F.lit(False))
    reason = F.when(kind.isNull(), "unsupported_metric_type").when(hollow, "unsupported_number_value_type")
    points = sum((F.coalesce(F.size(i[f]["dataPoints"]), F.lit(0)) for f in TYPES), F.lit(0)).cast("bigint")
    rows = items(requests, "metrics").withColumns({"type": kind, "reason": kept_here(reason)})
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null").select(*PLACE, i["name"].alias("metric_name"), "reason", points.alias("data_points"))


def number_value(p: Column) -> Column:
    return F.coalesce(p["asInt"].try_cast("bigint").cast("variant"), p["asDouble"].cast("variant"))


def exemplar_list(exemplars: Column) -> Column:
    def one(e: Column) -> Column:
        kind = F.when(e["asInt"].isNotNull(), "int").when(e["asDouble"].isNotNull(), "double")
        return F.struct(nanos_text(e["timeUnixNano"]).alias("timestamp_unix_nano"), text(e["traceId"]).alias("trace_id"), text(e["spanId"]).alias("span_id"), attribute_object(e["filteredAttributes"]).alias("filtered_attributes"), number_value(e).alias("value"), kind.alias("value_type"))

    return transformed(exemplars, one)


def whole_object(pairs: dict[str, Column]) -> Column:
    """An object of variants, without the keys whose value is null."""
    entries = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs.items()))
    return F.to_variant_object(F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))


def natural(c: Column) -> Column:
    """An unsigned number as a variant: a decimal, which keeps all 64 bits and tells it from signed ones."""
    return c.cast("decimal(20,0)").cast("variant")


def naturals(c: Column) -> Column:
    return F.coalesce(F.transform(c, natural), F.array().cast("array<variant>"))


def counts_variant(c: Column) -> Column:
    return F.to_variant_object(naturals(c))


def flatten_points(metrics: DataFrame) -> DataFrame:
    """One record per point of the metrics that ``split_invalid_metrics`` has passed, all five types in one pass."""
    i = F.col("item")

    def common(p: Column) -> list[Column]:
        return [p["attributes"].alias("attributes"), p["startTimeUnixNano"].alias("start"), p["timeUnixNano"].alias("time"), p["flags"].alias("flags")]

    no_number, no_shape = F.lit(None).cast("variant"), F.lit(None).cast("variant")
    signed = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").cast("variant")
    real = lambda c: c.cast("variant")
    none = lambda: F.lit(None).cast("double")

    def number(p: Column) -> Column:
        return F.struct(*common(p), number_value(p).alias("value"), p["asInt"].try_cast("bigint").alias("int_value"), p["asDouble"].alias("double_value"), exemplar_list(p["exemplars"]).alias("exemplars"), no_shape.alias("distribution"))

    def shaped(shape, exemplars: bool = True):
        def one(p: Column) -> Column:
            listed = exemplar_list(p["exemplars"]) if exemplars else F.lit(None).cast(EXEMPLARS)
            return F.struct(*common(p), no_number.alias("value"), F.lit(None).cast("bigint").alias("int_value"), none().alias("double_value"), listed.alias("exemplars"), shape(p).alias("distribution"))

        return one

    buckets = lambda b: F.to_variant_object(F.struct(F.coalesce(b["offset"], F.lit(0)).cast("bigint").alias("offset"), naturals(b["bucketCounts"]).alias("bucket_counts")))
    total = lambda p: natural(F.coalesce(p["count"], F.lit(0)))
    edges = lambda p: {"sum": real(p["sum"]), "min": real(p["min"]), "max": real(p["max"])}
    histogram = lambda p: whole_object({"count": total(p), "bucket_counts": counts_variant(p["bucketCounts"]), "explicit_bounds": F.to_variant_object(F.coalesce(p["explicitBounds"], F.array().cast("array<double>"))), **edges(p)})
    exponential = lambda p: whole_object({"count": total(p), "scale": signed(p["scale"]), "zero_count": natural(F.coalesce(p["zeroCount"], F.lit(0))), "zero_threshold": real(F.coalesce(p["zeroThreshold"], F.lit(0.0))), "positive": buckets(p["positive"]), "negative": buckets(p["negative"]), **edges(p)})
    summary = lambda p: whole_object({"count": total(p), "sum": real(F.coalesce(p["sum"], F.lit(0.0))), "quantile_values": F.to_variant_object(F.transform(F.coalesce(p["quantileValues"], F.array()), lambda q: F.struct(q["quantile"], q["value"])))})
    makers = {"gauge": number, "sum": number, "histogram": shaped(histogram), "exponentialHistogram": shaped(exponential), "summary": shaped(summary, exemplars=False)}
    points = F.coalesce(*(F.when(F.col("type") == TYPES[f], F.transform(i[f]["dataPoints"], make)) for f, make in makers.items()))
    temporality = F.coalesce(*(F.when(F.col("type") == TYPES[f], named(i[f]["aggregationTemporality"], TEMPORALITIES)) for f in ("sum", "histogram", "exponentialHistogram")))
    monotonic = F.when(F.col("type") == "sum", F.coalesce(i["sum"]["isMonotonic"], F.lit(False)))
    rows = metrics.select(*PLACE, *CONTEXT, "type", text(i["name"]).alias("metric_name"), text(i["description"]).alias("description"), text(i["unit"]).alias("unit"), attribute_object(i["metadata"]).alias("metadata"), temporality.alias("temporality"), monotonic.alias("is_monotonic"), points.alias("points"))
    rows = rows.select("*", F.posexplode("points").alias("point_pos", "p"))
    p = F.col("p")
    return rows.select(
        *PLACE,
        "point_pos",
        "metric_name",
        "description",
        "unit",
        "metadata",
        "type",
        "temporality",
        "is_monotonic",
        nanos_text(p["time"]).alias("timestamp_unix_nano"),
        nanos_text(p["start"]).alias("start_timestamp_unix_nano"),
        count(p["flags"]).alias("flags"),
        attribute_object(p["attributes"]).alias("attributes"),
        p["value"].alias("value"),
        F.when(p["int_value"].isNotNull(), "int").when(p["double_value"].isNotNull(), "double").alias("value_type"),
        p["int_value"].alias("int_value"),
        p["double_value"].alias("double_value"),
        F.coalesce(p["int_value"].cast("double"), p["double_value"]).alias("number_value"),
        p["exemplars"].alias("exemplars"),
        p["distribution"].alias("distribution"),
        *CONTEXT,
    )


EXEMPLARS = "array<struct<timestamp_unix_nano:string,trace_id:string,span_id:string,filtered_attributes:variant,value:variant,value_type:string>>"


def flatten(requests: DataFrame, signal: str) -> DataFrame:
    """Records of any signal; invalid metrics are left out."""
    if signal == "metrics":
        return flatten_points(split_invalid_metrics(requests)[0])
    return {"logs": flatten_logs, "traces": flatten_traces}[signal](requests)


