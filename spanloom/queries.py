"""The registered telemetry queries over the given tables, and DuckDB's SQL for the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.casts import OUTPUT
from .functions.casts import cast as strict_cast
from .functions.values import kind_name, kind_of, member
from .operators import compare, identity, ledger, preview, sampling, sink, status
from .operators.flatten import flatten, split_invalid_metrics
from .operators.inspect import inspect
from .operators.mapping import map_signal, union_signals
from .operators.presets import PRESETS
from .operators.selectors import select, selectors
from .plans import contract
from .session import configure, scratch_dir
from .sources import tables
from .sources.otlp import decode, read_otlp, split_decoded
from .streaming import commits, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is any."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(configure(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


SOURCES = {"traces": tables.trace_requests, "logs": tables.log_requests, "documents": tables.document_requests, "numbers": tables.number_requests, "shapes": tables.shape_requests, "deep": tables.deep_requests, "ratios": tables.ratio_requests, "linked": tables.linked_requests, "series": tables.series_requests, "loose": tables.loose_requests, "wide": tables.wide_requests, "words": tables.word_requests, "long": tables.long_requests, "unsigned": tables.unsigned_requests, "log conventions": partial(tables.convention_requests, signal="logs"), "span conventions": partial(tables.convention_requests, signal="traces")}
SIGNAL = {"traces": "traces", "logs": "logs", "documents": "logs", "numbers": "metrics", "shapes": "metrics", "deep": "logs", "ratios": "logs", "linked": "traces", "series": "metrics", "loose": "logs", "wide": "logs", "words": "logs", "long": "traces", "unsigned": "metrics", "log conventions": "logs", "span conventions": "traces"}


def requests(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return split_decoded(decode(SOURCES[source](spark, sf_dir), SIGNAL[source]))[0]


def records(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return flatten(requests(spark, sf_dir, source), SIGNAL[source])


def at(column: str, key: str, kind: str) -> Column:
    return member(F.col(column), key, kind)


#: Spans as the requests derived from orders and line items hold them.
SPANS = """
spans AS (
  SELECT lpad(lower(to_hex(o_orderkey)), 32, '0') AS trace_id, lpad(lower(to_hex(o_orderkey * 8)), 16, '0') AS span_id, '' AS parent_span_id,
         'order' AS name, 'internal' AS kind, (epoch_us(o_orderdate) * 1000)::VARCHAR AS start_ns, '' AS end_ns, NULL::BIGINT AS duration_ns,
         'unset' AS status_code, o_orderpriority AS service, NULL::BIGINT AS l_partkey, NULL::DOUBLE AS l_discount, o_orderstatus, o_totalprice FROM orders
  UNION ALL
  SELECT lpad(lower(to_hex(o_orderkey)), 32, '0'), substr(sha256(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 16),
         lpad(lower(to_hex(o_orderkey * 8)), 16, '0'), l_returnflag || l_linestatus, 'server', (epoch_us(o_orderdate) * 1000)::VARCHAR,
         (epoch_us(l_shipdate) * 1000)::VARCHAR, CASE WHEN l_shipdate >= o_orderdate THEN (epoch_us(l_shipdate) - epoch_us(o_orderdate)) * 1000 END,
         CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'unset' END, o_orderpriority, l_partkey, l_discount, NULL, NULL
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
#: Logs as the requests derived from events hold them.
LOGS = """
logs AS (
  SELECT event_id, epoch_us(ts) * 1000 AS ns, ts, event_type AS severity, event_id % 24 AS severity_number, '{"k":' || json_extract_string(props, '$.k') || '}' AS message,
         user_id, value, CASE WHEN event_id % 7 <> 0 THEN 'svc-' || (user_id % 5) END AS service, CASE WHEN event_id % 7 = 0 THEN 'host-' || (user_id % 3) END AS host
  FROM events)"""


@query(f"WITH {SPANS} SELECT trace_id, span_id, parent_span_id, name, kind, start_ns, end_ns, duration_ns, status_code, service, l_partkey, l_discount FROM spans")
def f08_flatten_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir, "traces")
    return rows.select("trace_id", "span_id", "parent_span_id", "name", "kind", F.col("start_time_unix_nano").alias("start_ns"), F.col("end_time_unix_nano").alias("end_ns"), "duration_ns", "status_code", at("resource", "service.name", "string").alias("service"), at("attributes", "l_partkey", "bigint").alias("l_partkey"), at("attributes", "l_discount", "double").alias("l_discount"))


@query(f"WITH {LOGS} SELECT ns::VARCHAR AS ns, severity, severity_number, message, user_id, value, service, host, 'events' AS scope_name FROM logs")
def f07_flatten_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir, "logs")
    return rows.select(F.col("timestamp_unix_nano").alias("ns"), F.col("status").alias("severity"), "severity_number", "message", at("attributes", "user_id", "bigint").alias("user_id"), at("attributes", "value", "double").alias("value"), at("resource", "service.name", "string").alias("service"), at("resource", "host.name", "string").alias("host"), F.col("scope.name").alias("scope_name"))


@query("""
SELECT event_type AS metric_name, CASE WHEN event_id % 2 = 0 THEN 'sum' ELSE 'gauge' END AS type, CASE WHEN event_id % 2 = 0 THEN 'cumulative' END AS temporality,
       CASE WHEN event_id % 2 = 0 THEN true END AS is_monotonic, CASE WHEN event_id % 2 = 0 THEN 'int' ELSE 'double' END AS value_type,
       CASE WHEN event_id % 2 = 0 THEN user_id END AS int_value, CASE WHEN event_id % 2 = 1 THEN value END AS double_value,
       CASE WHEN event_id % 2 = 0 THEN user_id::DOUBLE ELSE value END AS number_value, (event_id % 10 = 0)::INT AS n_exemplars,
       CASE WHEN event_id % 10 = 0 THEN value END AS exemplar_value, (epoch_us(ts) * 1000)::VARCHAR AS ns
FROM events WHERE event_id % 97 <> 0""")
def f11_flatten_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir, "numbers")
    exemplar = F.try_variant_get(F.get("exemplars", F.lit(0))["value"], "$", "double")
    return rows.select("metric_name", "type", "temporality", "is_monotonic", "value_type", "int_value", "double_value", "number_value", F.size("exemplars").alias("n_exemplars"), exemplar.alias("exemplar_value"), F.col("timestamp_unix_nano").alias("ns"))


@query("""
WITH q AS (
  SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS total, min(l_quantity) AS least, max(l_quantity) AS most,
         '[' || concat_ws(',', count(*) FILTER (l_quantity <= 10), count(*) FILTER (l_quantity > 10 AND l_quantity <= 20), count(*) FILTER (l_quantity > 20 AND l_quantity <= 30),
                          count(*) FILTER (l_quantity > 30 AND l_quantity <= 40), count(*) FILTER (l_quantity > 40)) || ']' AS buckets
  FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, 'h' AS metric_name, 'histogram' AS type, 'delta' AS temporality, n, total, least, most, buckets FROM q
UNION ALL SELECT l_orderkey, 'e', 'exponential_histogram', 'cumulative', n, total, NULL, NULL, '[' || n || ']' FROM q
UNION ALL SELECT l_orderkey, 's', 'summary', NULL, n, total, least, most, NULL FROM q""")
def f13_flatten_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir, "shapes")
    d = lambda path, kind: F.try_variant_get("distribution", path, kind)
    buckets = F.to_json(F.coalesce(d("$.bucket_counts", "variant"), d("$.positive.bucket_counts", "variant")))
    return rows.select(at("attributes", "l_orderkey", "bigint").alias("l_orderkey"), "metric_name", "type", "temporality", d("$.count", "bigint").alias("n"), d("$.sum", "double").alias("total"), F.coalesce(d("$.min", "double"), d("$.quantile_values[0].value", "double")).alias("least"), F.coalesce(d("$.max", "double"), d("$.quantile_values[1].value", "double")).alias("most"), buckets.alias("buckets"))


@query("SELECT event_type AS metric_name, 'unsupported_number_value_type' AS reason, count(*) AS n_metrics, count(*) AS data_points FROM events WHERE event_id % 97 = 0 GROUP BY event_type")
def f18_invalid_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = split_invalid_metrics(requests(spark, sf_dir, "numbers"))[1]
    return rejects.groupBy("metric_name", "reason").agg(F.count("*").alias("n_metrics"), F.sum("data_points").alias("data_points"))


@query("SELECT event_id // 50 AS request_id, event_id % 50 AS resource_pos, event_type AS severity FROM events ORDER BY event_id LIMIT 120")
def f22_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.capture(requests(spark, sf_dir, "logs"), "logs", 120).select("request_id", F.col("resource_pos").cast("long").alias("resource_pos"), F.col("item.severityText").alias("severity"))


@query("SELECT event_type AS severity, count(*) AS n, sum(user_id)::BIGINT AS users, count(*) FILTER (event_id % 7 <> 0) AS named FROM events GROUP BY event_type")
def f23_renest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests taken apart, nested again, decoded again and flattened."""
    again = sampling.renest(sampling.explode_items(requests(spark, sf_dir, "logs"), "logs"), "logs")
    rows = flatten(split_decoded(decode(again, "logs"))[0], "logs")
    return rows.groupBy(F.col("status").alias("severity")).agg(F.count("*").alias("n"), F.sum(at("attributes", "user_id", "bigint")).alias("users"), F.count(at("resource", "service.name", "string")).alias("named"))


@query("SELECT DISTINCT 'svc-' || (user_id % 5) AS probe_id FROM events WHERE event_id % 7 <> 0")
def f25_probe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.probe_ids(records(spark, sf_dir, "logs"), "service.name")


def shown(column: Column, kind: str) -> Column:
    """A selector's value as text that both engines print alike."""
    if kind == "timestamp":
        return F.unix_micros(column).cast("string")
    return F.to_json(column) if OUTPUT[kind] == "variant" else column.cast("string")


def all_selectors(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    signal = SIGNAL[source]
    rows, out = identity.with_record_json(records(spark, sf_dir, source), signal), []
    for s in selectors(signal):
        column, kind = select(s, signal, F.col(identity.RECORD_JSON))
        name = s.replace(".", "_")
        out.append(F.length(column).alias(name) if s == "record.id" else column.isNotNull().alias(name) if s == "record" else shown(column, kind).alias(name))
    return rows.select(*out)


SHARED_SQL = "true AS record, 64 AS record_id, '' AS resource_schema_url, '0' AS resource_dropped_attributes_count, '' AS scope_schema_url, '0' AS scope_dropped_attributes_count, NULL::VARCHAR AS scope_attributes"


@query(f"""
WITH {LOGS}
SELECT {SHARED_SQL}, CASE WHEN service IS NOT NULL THEN '{{"service.name":"' || service || '"}}' ELSE '{{"host.name":"' || host || '"}}' END AS resource_attributes,
       'events' AS scope_name, '' AS scope_version, epoch_us(ts)::VARCHAR AS log_timestamp, NULL::VARCHAR AS log_observed_timestamp, ns::VARCHAR AS log_timestamp_unix_nano,
       '' AS log_observed_timestamp_unix_nano, '' AS log_trace_id, '' AS log_span_id, '' AS log_event_name, severity AS log_severity_text, severity_number::VARCHAR AS log_severity_number,
       '0' AS log_flags, '0' AS log_dropped_attributes_count, message AS log_body, message AS log_message,
       '{{"even":' || (event_id % 2 = 0)::VARCHAR || ',"user_id":' || user_id || ',"value":' || value || '}}' AS log_attributes
FROM logs""")
def g_log_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_selectors(spark, sf_dir, "logs")


@query(f"""
WITH {SPANS}
SELECT {SHARED_SQL}, '{{"service.name":"' || service || '"}}' AS resource_attributes, 'orders' AS scope_name, '1' AS scope_version, trace_id AS span_trace_id, span_id AS span_span_id,
       parent_span_id AS span_parent_span_id, '' AS span_trace_state, '0' AS span_flags, name AS span_name, kind AS span_kind, (start_ns::BIGINT // 1000)::VARCHAR AS span_start_time,
       (try_cast(end_ns AS BIGINT) // 1000)::VARCHAR AS span_end_time, start_ns AS span_start_time_unix_nano, end_ns AS span_end_time_unix_nano, duration_ns::VARCHAR AS span_duration_ns,
       status_code AS span_status_code, '' AS span_status_message, '0' AS span_dropped_attributes_count, '[]' AS span_events, '0' AS span_dropped_events_count, '[]' AS span_links,
       '0' AS span_dropped_links_count,
       CASE WHEN l_partkey IS NOT NULL THEN '{{"l_discount":' || l_discount || ',"l_partkey":' || l_partkey || '}}' ELSE '{{"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice || '}}' END AS span_attributes
FROM spans""")
def g_span_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_selectors(spark, sf_dir, "traces")


DEEP_SQL = """'{"a":[{"b":{"c":[{"d":[{"e":' || event_id || '}]}]}}]}'"""
PATH_SQL = """'{"o":{"p":{"q":{"r":{"s":{"t":{"u":{"v":' || event_id || '}}}}}}}}'"""


@query(f"""SELECT event_id AS request_id, '{{"deep":' || {DEEP_SQL} || ',"path":' || {PATH_SQL} || '}}' AS attributes, event_id AS inner_deep, event_id AS inner_path FROM events""")
def f03_any_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes nested eight deep, whole and by paths to their ends."""
    rows, value = records(spark, sf_dir, "deep"), lambda s: F.try_variant_get(select(s, "logs")[0], "$", "bigint")
    return rows.select("request_id", F.to_json("attributes").alias("attributes"), value('log.attributes["deep"]["a"][0]["b"]["c"][0]["d"][0]["e"]').alias("inner_deep"), value('log.attributes["path"]["o"]["p"]["q"]["r"]["s"]["t"]["u"]["v"]').alias("inner_path"))


@query("""
SELECT event_id // 5000 AS request_id, count(*) AS n_objects, sum(event_id)::BIGINT AS ids, min(event_type) AS least_type, max(event_type) AS most_type, min(event_id) AS first_id FROM events GROUP BY ALL""")
def f03_wide_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of thousands of objects, whole."""
    listed = F.try_variant_get(select('log.attributes["all"]', "logs")[0], "$", "array<struct<id: bigint, type: string>>")
    rows = records(spark, sf_dir, "wide").select("request_id", listed.alias("all"))
    total = F.aggregate("all", F.lit(0).cast("bigint"), lambda n, x: n + x["id"])
    return rows.select("request_id", F.size("all").cast("long").alias("n_objects"), total.alias("ids"), F.array_min(F.transform("all", lambda x: x["type"])).alias("least_type"), F.array_max(F.transform("all", lambda x: x["type"])).alias("most_type"), F.get("all", F.lit(0))["id"].alias("first_id"))


@query("""
SELECT event_id AS request_id, CASE WHEN event_id % 5 = 4 THEN 'decode_failed' ELSE 'read' END AS outcome, CASE WHEN event_id % 5 < 3 THEN event_id % 24 + 1 WHEN event_id % 5 = 3 THEN 0 END AS severity_number,
       CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN CASE WHEN event_id = 0 THEN '' ELSE event_id::VARCHAR END WHEN 2 THEN event_id::VARCHAR WHEN 3 THEN '' END AS ns,
       CASE WHEN event_id % 5 <> 4 THEN event_id % 9 END AS dropped, CASE WHEN event_id % 5 = 2 THEN '{"k":' || event_id || '}' WHEN event_id % 5 <> 4 THEN event_id::VARCHAR END AS message FROM events""")
def f01_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that are written loosely, and some that can't be read."""
    good, bad = split_decoded(decode(tables.loose_requests(spark, sf_dir), "logs"))
    read = flatten(good, "logs").select("request_id", F.lit("read").alias("outcome"), "severity_number", F.col("timestamp_unix_nano").alias("ns"), F.col("resource_dropped_attributes_count").alias("dropped"), "message")
    none = {"severity_number": "bigint", "ns": "string", "dropped": "bigint", "message": "string"}
    return read.unionByName(bad.select("request_id", F.col("reject_reason").alias("outcome"), *(F.lit(None).cast(t).alias(c) for c, t in none.items())))


@query("SELECT l_orderkey || ':' || l_linenumber AS name, (18446744073709551615::HUGEINT - l_partkey - l_quantity::BIGINT - 18446744073709551616::HUGEINT)::BIGINT AS duration_ns FROM lineitem")
def f10_long_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of more nanoseconds than 63 bits hold: the duration wraps, and no row is lost."""
    return records(spark, sf_dir, "long").select("name", "duration_ns")


@query("""
SELECT event_id, (18446744073709551615::HUGEINT - user_id)::VARCHAR AS n, '[' || (18446744073709551615::HUGEINT - user_id) || ',' || user_id || ']' AS buckets,
       (18446744073709551615::HUGEINT - user_id)::VARCHAR AS as_uint, NULL::BIGINT AS as_int, (18446744073709551615::HUGEINT - user_id)::DOUBLE AS as_float, 'uint' AS kind FROM events""")
def f13_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of 64 bits stay whole, through paths, casts and kinds."""
    path = lambda p: select(f"datapoint.distribution{p}", "metrics")[0]
    to = lambda target: strict_cast(path('["count"]'), "dynamic", target)
    return records(spark, sf_dir, "unsigned").select(at("attributes", "id", "bigint").alias("event_id"), to("string").alias("n"), F.to_json(path('["bucket_counts"]')).alias("buckets"), to("uint").cast("string").alias("as_uint"), to("int").alias("as_int"), to("float").alias("as_float"), kind_name(kind_of(path('["count"]'))).alias("kind"))


@query("""
SELECT l_orderkey AS request_id,
       '[{"attributes":{"flag":"' || l_returnflag || '"},"dropped_attributes_count":1,"name":"shipped","timestamp_unix_nano":"' || (epoch_us(l_shipdate) * 1000) || '"},{"attributes":{},"dropped_attributes_count":0,"name":"empty","timestamp_unix_nano":""}]' AS events,
       '[{"attributes":{"part":' || l_partkey || '},"dropped_attributes_count":0,"flags":3,"span_id":"' || lpad(lower(to_hex(l_suppkey)), 16, '0') || '","trace_id":"' || lpad(lower(to_hex(l_orderkey)), 32, '0') || '","trace_state":"s=1"}]' AS links
FROM lineitem""")
def f09_events_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and links of spans, by their selectors."""
    value = lambda s: F.to_json(select(s, "traces")[0])
    return records(spark, sf_dir, "linked").select("request_id", value("span.events").alias("events"), value("span.links").alias("links"))


@query("SELECT event_id // 50 AS request_id, event_id % 50 AS point_pos, 'users' AS metric_name, user_id AS int_value FROM events ORDER BY event_id LIMIT 120")
def f22_capture_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of metrics counts points: two metrics whole, and some points of the third."""
    taken = sampling.capture(requests(spark, sf_dir, "series"), "metrics", 120)
    again = flatten(split_decoded(decode(sampling.renest(taken, "metrics"), "metrics"))[0], "metrics")
    return again.select("request_id", F.col("point_pos").cast("long").alias("point_pos"), "metric_name", "int_value")


@query(f"""
SELECT {SHARED_SQL}, '{{}}' AS resource_attributes, '' AS scope_name, '' AS scope_version, event_type AS metric_name, '' AS metric_description, '1' AS metric_unit,
       CASE WHEN event_id % 2 = 0 THEN 'sum' ELSE 'gauge' END AS metric_type, '{{}}' AS metric_metadata, CASE WHEN event_id % 2 = 0 THEN 'cumulative' END AS metric_temporality,
       CASE WHEN event_id % 2 = 0 THEN 'true' END AS metric_is_monotonic, epoch_us(ts)::VARCHAR AS datapoint_timestamp, NULL::VARCHAR AS datapoint_start_time,
       (epoch_us(ts) * 1000)::VARCHAR AS datapoint_timestamp_unix_nano, '' AS datapoint_start_time_unix_nano, '0' AS datapoint_flags, '{{"user_id":' || user_id || '}}' AS datapoint_attributes,
       CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR ELSE value::VARCHAR END AS datapoint_value, CASE WHEN event_id % 2 = 0 THEN 'int' ELSE 'double' END AS datapoint_value_type,
       CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR END AS datapoint_int_value, CASE WHEN event_id % 2 = 1 THEN value::VARCHAR END AS datapoint_double_value,
       CASE WHEN event_id % 2 = 0 THEN user_id::DOUBLE ELSE value END::VARCHAR AS datapoint_number_value, NULL::VARCHAR AS datapoint_distribution,
       CASE WHEN event_id % 10 <> 0 THEN '[]' ELSE '[{{"filtered_attributes":{{}},"span_id":"","timestamp_unix_nano":"' || (epoch_us(ts) * 1000) || '","trace_id":"ab","value":' || value || ',"value_type":"double"}}]' END AS datapoint_exemplars
FROM events WHERE event_id % 97 <> 0""")
def g_metric_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_selectors(spark, sf_dir, "numbers")


@query(f"""
WITH {LOGS}
SELECT event_id // 50 AS request_id, json_extract_string(message, '$.k')::BIGINT AS k, NULL::VARCHAR AS missing, NULL::VARCHAR AS mismatch, service AS first_name FROM logs""")
def g65_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key steps, a missing key, an index into an object, and a key with a dot."""
    value = lambda s: select(s, "logs")[0]
    text = lambda s: F.try_variant_get(value(s), "$", "string")
    return records(spark, sf_dir, "logs").select("request_id", F.try_variant_get(value('log.body["k"]'), "$", "bigint").alias("k"), text('log.body["none"]["deeper"]').alias("missing"), text('log.attributes["user_id"][0]').alias("mismatch"), text('resource.attributes["service.name"]').alias("first_name"))


SHORTHAND = {"trace": "span.trace_id", "span": "span.span_id", "parent": "span.parent_span_id", "name": "span.name", "start": "span.start_time", "duration": "span.duration_ns"}


@query(f"""WITH {SPANS} SELECT trace_id AS trace, span_id AS span, parent_span_id AS parent, name, make_timestamp(start_ns::BIGINT // 1000) AS start, duration_ns AS duration FROM spans""")
def m01_shorthand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six columns, each from one source."""
    return map_signal(records(spark, sf_dir, "traces"), SHORTHAND, "traces")[0].withColumn("start", F.col("start").cast("timestamp_ntz"))


FALLBACK = {
    "service": {"sources": ['resource.attributes["none"]', 'resource.attributes["service.name"]'], "cast": "string"},
    "part": {"source": 'span.attributes["l_partkey"]', "default": -1, "cast": "int"},
    "discount": {"source": 'span.attributes["l_discount"]', "cast": "float"},
    "discount_text": {"source": 'span.attributes["l_discount"]', "default": "none", "cast": "string"},
    "version": {"value": "v1"},
    "ends": {"sources": ["span.end_time", "span.start_time"]},
}


@query(f"""
WITH {SPANS}
SELECT service, coalesce(l_partkey, -1) AS part, l_discount AS discount, coalesce(CASE WHEN l_discount = 0 THEN '0' ELSE l_discount::VARCHAR END, 'none') AS discount_text, 'v1' AS version,
       make_timestamp(coalesce(try_cast(end_ns AS BIGINT), start_ns::BIGINT) // 1000) AS ends FROM spans""")
def m02_fallback_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six columns with fallbacks, defaults, casts, a constant and nested paths."""
    return map_signal(records(spark, sf_dir, "traces"), FALLBACK, "traces")[0].withColumn("ends", F.col("ends").cast("timestamp_ntz"))


STRICT = {"amount": {"source": 'log.attributes["value"]', "cast": "int"}, "who": {"sources": ['resource.attributes["service.name"]', 'log.attributes["user_id"]'], "cast": "string"}, "flag": {"source": 'resource.attributes["host.name"]', "cast": "boolean"}}


@query(f"""
WITH {LOGS}, r AS (SELECT *, CASE WHEN value <> floor(value) THEN 'amount' WHEN host IS NOT NULL THEN 'flag' END AS bad FROM logs)
SELECT coalesce(bad, 'valid') AS outcome, CASE bad WHEN 'amount' THEN 'log.attributes["value"]' WHEN 'flag' THEN 'resource.attributes["host.name"]' END AS source,
       CASE bad WHEN 'amount' THEN 'float value ' || value || ' cannot be converted to int' WHEN 'flag' THEN 'string value "' || host || '" cannot be converted to boolean' END AS message, count(*) AS n
FROM r GROUP BY ALL""")
def m10_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows and rejects, by column, source and message."""
    valid, rejects = map_signal(records(spark, sf_dir, "logs"), STRICT, "logs")
    none = F.lit(None).cast("string")
    counted = valid.select(F.lit("valid").alias("outcome"), none.alias("source"), none.alias("message")).unionByName(rejects.select(F.col("column").alias("outcome"), "source", "message"))
    return counted.groupBy("outcome", "source", "message").agg(F.count("*").alias("n"))


@query("""
SELECT CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'mapping_encoding_failed' ELSE 'valid' END AS outcome, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'ratio' END AS "column", count(*) AS n FROM events GROUP BY ALL""")
def m12_unencodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that JSON can't hold, without a cast: rows that have one are rejected."""
    valid, rejects = map_signal(records(spark, sf_dir, "ratios"), {"ratio": 'log.attributes["ratio"]'}, "logs")
    return valid.select(F.lit("valid").alias("outcome"), F.lit(None).cast("string").alias("column")).union(rejects.select("reason", "column")).groupBy("outcome", "column").agg(F.count("*").alias("n"))


WORD = "['NaN', 'Infinity', '-Infinity'][(event_id % 3 + 1)::INT]"


@query(f"""
SELECT CASE WHEN event_id % 7 = 0 THEN 'mapping_encoding_failed' ELSE 'valid' END AS outcome, CASE WHEN event_id % 7 = 0 THEN 'list' END AS "column", CASE WHEN event_id % 7 <> 0 THEN {WORD} END AS word,
       CASE WHEN event_id % 7 <> 0 THEN '["' || {WORD} || '",{{"again":"' || {WORD} || '"}}]' END AS list, count(*) AS n FROM events GROUP BY ALL""")
def m12_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that read like numbers which are none are texts, alone and inside of lists."""
    valid, rejects = map_signal(records(spark, sf_dir, "words"), {"word": 'log.attributes["word"]', "list": 'log.attributes["list"]'}, "logs")
    none = F.lit(None).cast("string")
    kept = valid.select(F.lit("valid").alias("outcome"), none.alias("column"), F.try_variant_get("word", "$", "string").alias("word"), F.to_json("list").alias("list"))
    return kept.union(rejects.select("reason", "column", none, none)).groupBy("outcome", "column", "word", "list").agg(F.count("*").alias("n"))


@query(f"SELECT {WORD} AS word, count(*) FILTER (event_id % 7 <> 0) AS with_id, (count(*) FILTER (event_id % 7 <> 0) > 0)::INT::BIGINT AS ids FROM events GROUP BY ALL")
def r4_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of records with such texts: one a text; none for those that hold such a number."""
    rows = identity.with_record_id(records(spark, sf_dir, "words"), "logs")
    return rows.groupBy(at("attributes", "word", "string").alias("word")).agg(F.count("row_id").alias("with_id"), F.countDistinct("row_id").alias("ids"))


@query("""
SELECT CASE WHEN octet_length(encode(to_json({'text': text})::VARCHAR)) + 1 > 3000 THEN 'mapped_row_too_large' ELSE 'valid' END AS outcome, count(*) AS n FROM documents GROUP BY outcome""")
def m13_row_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejects = map_signal(records(spark, sf_dir, "documents"), {"text": "log.message"}, "logs", max_bytes=3000)
    return valid.select(F.lit("valid").alias("outcome")).union(rejects.select("reason")).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"""
WITH {SPANS}, {LOGS}
SELECT 'span' AS what, service, name, NULL::BIGINT AS number, count(*) AS n FROM spans GROUP BY ALL
UNION ALL SELECT 'log', service, NULL, severity_number, count(*) FROM logs GROUP BY ALL""")
def m14_two_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two signals in one table, each with columns that the other has not."""
    service = {"source": 'resource.attributes["service.name"]', "cast": "string"}
    spans = map_signal(records(spark, sf_dir, "traces"), {"what": {"value": "span"}, "service": service, "name": "span.name"}, "traces")[0]
    logs = map_signal(records(spark, sf_dir, "logs"), {"what": {"value": "log"}, "service": service, "number": "log.severity_number"}, "logs")[0]
    return union_signals(spans, logs).groupBy("what", "service", "name", "number").agg(F.count("*").alias("n"))


def wide(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The preset's rows; records as whether they are there, ids by their length, times in microseconds."""
    rows = map_signal(records(spark, sf_dir, source), PRESETS[SIGNAL[source]], SIGNAL[source])[0]
    show = {"variant": lambda c: F.col(c).isNotNull(), "timestamp": lambda c: F.unix_micros(c)}
    return rows.select(*(F.length(c).alias(c) if c == "row_id" else show[t](c).alias(c) if t in show else F.col(c) for c, t in rows.dtypes))


WIDE_SQL = "'v1' AS schema_version, 'default' AS env, 64 AS row_id, true AS record, " + ", ".join(f"NULL::VARCHAR AS {c}" for c in ("version", "instance_id", "k8s_pod", "k8s_namespace", "k8s_cluster", "container_name", "host_ip"))


@query(f"""
WITH {LOGS}
SELECT {WIDE_SQL}, service, host, epoch_us(ts) AS record_timestamp, NULL::BIGINT AS observed_timestamp, '' AS trace_id, '' AS span_id, severity AS status, severity_number, message,
       'events' AS source, NULL::VARCHAR AS exception_type, NULL::VARCHAR AS exception_message FROM logs""")
def m16_preset_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir, "logs")


@query(f"""
WITH {SPANS}
SELECT {WIDE_SQL}, service, NULL::VARCHAR AS host, start_ns::BIGINT // 1000 AS start_timestamp, try_cast(end_ns AS BIGINT) // 1000 AS end_timestamp, duration_ns, trace_id, span_id, parent_span_id,
       name AS span_name, kind AS span_kind, status_code, NULL::BIGINT AS http_status_code,
       {", ".join(f"NULL::VARCHAR AS {c}" for c in ("http_method", "url_path", "http_route", "peer_service", "db_system", "db_operation", "rpc_method", "error_type"))} FROM spans""")
def m16_preset_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir, "traces")


@query(f"""
SELECT {WIDE_SQL}, NULL::VARCHAR AS service, NULL::VARCHAR AS host, epoch_us(ts) AS record_timestamp, NULL::BIGINT AS start_timestamp, event_type AS metric_name,
       CASE WHEN event_id % 2 = 0 THEN 'sum' ELSE 'gauge' END AS metric_type, CASE WHEN event_id % 2 = 0 THEN 'cumulative' END AS temporality, '1' AS unit,
       CASE WHEN event_id % 2 = 0 THEN user_id::DOUBLE ELSE value END AS number_value, false AS distribution FROM events WHERE event_id % 97 <> 0""")
def m16_preset_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir, "numbers")


SERVICE_SQL = "'svc-' || user_id AS service, '1.' || user_id AS version, 'i-' || user_id AS instance_id, 'pod' AS k8s_pod, 'ns' AS k8s_namespace, 'cluster' AS k8s_cluster, 'box' AS container_name, 'host-' || user_id AS host"


def even(a: str, b: str = "NULL") -> str:
    return f"CASE WHEN event_id % 2 = 0 THEN {a} ELSE {b} END"


@query(f"""
SELECT {even("'prod'", "'dev'")} AS env, {SERVICE_SQL}, {even("'10.0.0.1'", "'10.0.0.9'")} AS host_ip, {even("'app'", "'go'")} AS source,
       {even("'E' || user_id")} AS exception_type, {even("'failed'")} AS exception_message FROM events""")
def m16_filled_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs preset over records that have what it reads, by first and by later sources."""
    rows = map_signal(records(spark, sf_dir, "log conventions"), PRESETS["logs"], "logs")[0]
    return rows.select("env", "service", "version", "instance_id", "k8s_pod", "k8s_namespace", "k8s_cluster", "container_name", "host", "host_ip", "source", "exception_type", "exception_message")


@query(f"""
SELECT {even("'prod'", "'dev'")} AS env, {SERVICE_SQL}, {even("'10.0.0.1'", "'10.0.0.9'")} AS host_ip, {even("'GET'", "'PUT'")} AS http_method, {even("200", "404")}::BIGINT AS http_status_code,
       {even("'/p/' || user_id", "'/old'")} AS url_path, {even("'/p'")} AS http_route, {even("'peer'", "'old-peer'")} AS peer_service, {even("'pg'", "'my'")} AS db_system,
       {even("'select'", "'insert'")} AS db_operation, {even("'Get'")} AS rpc_method, {even("'none'")} AS error_type FROM events""")
def m16_filled_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traces preset over records that have what it reads, by first and by later sources."""
    rows = map_signal(records(spark, sf_dir, "span conventions"), PRESETS["traces"], "traces")[0]
    return rows.select("env", "service", "version", "instance_id", "k8s_pod", "k8s_namespace", "k8s_cluster", "container_name", "host", "host_ip", "http_method", "http_status_code", "url_path", "http_route", "peer_service", "db_system", "db_operation", "rpc_method", "error_type")


#: Texts to cast, by event_id modulo their number; in the SQL, what each cast makes of them (null: it fails).
TEXTS = [" 42 ", "+7", "1_0", "-1", "1e3", "NaN", "1e400", "true", "T", "yes", "2024-04-23T01:23:45.123456789Z", "2024-04-23T03:23:45+02:00", "2024-04-23", "0", "18446744073709551615", "18446744073709551616", "1.25", "", "\t42\n", "\u2003true\u00a0", " \x0b-1.5\r\n", "0x1p4", "-0X_1.8p-1", "0x1", "1__0", "1e19"]
CAST_INT = {0: 42, 1: 7, 3: -1, 13: 0, 18: 42}
CAST_UINT = {0: 42, 13: 0, 14: 18446744073709551615, 18: 42}
CAST_FLOAT = {0: 42.0, 1: 7.0, 2: 10.0, 3: -1.0, 4: 1000.0, 13: 0.0, 14: 18446744073709551615.0, 15: 18446744073709551616.0, 16: 1.25, 18: 42.0, 20: -1.5, 21: 16.0, 22: -0.75, 25: 1e19}
CAST_BOOL = {7: True, 8: True, 13: False, 19: True}
CAST_TIME = {0: 0, 1: 0, 3: -1 // 1000 + 1, 10: 1713835425123456, 11: 1713835425000000, 13: 0, 18: 0}


def case(values: dict, kind: str) -> str:
    return f"CASE event_id % {len(TEXTS)} " + " ".join(f"WHEN {k} THEN '{v}'::{kind}" for k, v in values.items()) + " END"


@query(f"SELECT event_id, {case(CAST_INT, 'BIGINT')} AS as_int, ({case(CAST_UINT, 'UBIGINT')})::VARCHAR AS as_uint, {case(CAST_FLOAT, 'DOUBLE')} AS as_float, {case(CAST_BOOL, 'BOOLEAN')} AS as_boolean, {case(CAST_TIME, 'BIGINT')} AS as_micros FROM events")
def c_casts_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict casts of texts; what fails is null."""
    text = F.get(F.array(*map(F.lit, TEXTS)), (F.col("event_id") % len(TEXTS)).cast("int"))
    rows = tables.table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    to = lambda target: strict_cast(F.col("t"), "string", target)
    return rows.select("event_id", to("int").alias("as_int"), to("uint").cast("string").alias("as_uint"), to("float").alias("as_float"), to("boolean").alias("as_boolean"), F.unix_micros(to("timestamp")).alias("as_micros"))


@query("""
SELECT event_id, CASE WHEN value = floor(value) THEN value::BIGINT END AS float_as_int, CASE WHEN value = floor(value) THEN value::BIGINT::VARCHAR ELSE value::VARCHAR END AS float_as_string, user_id::DOUBLE AS int_as_float,
       user_id::VARCHAR AS int_as_string, '{"k":' || json_extract_string(props, '$.k') || '}' AS object_as_string, true AS is_object, false AS is_array FROM events""")
def c_casts_of_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict casts of numbers and objects known at run time only."""
    events = tables.table(spark, sf_dir, "events").select("event_id", F.col("value").cast("variant").alias("d"), F.col("user_id").cast("variant").alias("i"), F.parse_json("props").alias("o"))
    to = lambda c, target: strict_cast(F.col(c), "dynamic", target)
    return events.select("event_id", to("d", "int").alias("float_as_int"), to("d", "string").alias("float_as_string"), to("i", "float").alias("int_as_float"), to("i", "string").alias("int_as_string"), to("o", "string").alias("object_as_string"), to("o", "object").isNotNull().alias("is_object"), to("o", "array").isNotNull().alias("is_array"))


@query(f"""
WITH {LOGS}, {SPANS}
SELECT 'log' AS what, strftime(ts, '%Y-%m-%dT%H:%M:%S') || rtrim('.' || strftime(ts, '%f'), '0.') || 'Z' AS text, count(*) AS n FROM logs GROUP BY ALL
UNION ALL SELECT 'span', coalesce(strftime(make_timestamp(try_cast(end_ns AS BIGINT) // 1000), '%Y-%m-%dT%H:%M:%S') || 'Z', 'none'), count(*) FROM spans GROUP BY ALL""")
def c1_times_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cast to text, with the digits of the second that they have."""
    logs = map_signal(records(spark, sf_dir, "logs"), {"what": {"value": "log"}, "text": {"source": "log.timestamp", "cast": "string"}}, "logs")[0]
    spans = map_signal(records(spark, sf_dir, "traces"), {"what": {"value": "span"}, "text": {"source": "span.end_time", "default": "none", "cast": "string"}}, "traces")[0]
    return union_signals(logs, spans).groupBy("what", "text").agg(F.count("*").alias("n"))


@query("""
WITH n AS (SELECT count(*) AS total FROM events), p AS (SELECT unnest(['', '["o"]', '["o"]["p"]', '["o"]["p"]["q"]', '["o"]["p"]["q"]["r"]', '["o"]["p"]["q"]["r"]["s"]', '["o"]["p"]["q"]["r"]["s"]["t"]', '["o"]["p"]["q"]["r"]["s"]["t"]["u"]']) AS path),
f AS (
  SELECT 'log.attributes["path"]' || path AS selector, 'object' AS t FROM p UNION ALL SELECT 'log.attributes["path"]["o"]["p"]["q"]["r"]["s"]["t"]["u"]["v"]', 'int'
  UNION ALL SELECT * FROM (VALUES ('log.attributes', 'object'), ('log.attributes["deep"]', 'object'), ('log.attributes["deep"]["a"]', 'array'), ('record.id', 'string')))
SELECT regexp_extract(selector, '^[a-z]+') AS field_group, selector, t AS observed_types, total AS populated, total, 'OK' AS status FROM f, n""")
def r1_any_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory of attributes nested eight deep."""
    return inspect(records(spark, sf_dir, "deep"), "logs")


@query(f"""
WITH {LOGS}, n AS (SELECT count(*) AS total FROM logs), f AS (
  SELECT unnest([{{'s': 'resource.attributes', 't': 'object', 'c': true}}, {{'s': 'resource.attributes["service.name"]', 't': 'string', 'c': service IS NOT NULL}}, {{'s': 'resource.attributes["host.name"]', 't': 'string', 'c': host IS NOT NULL}},
    {{'s': 'scope.name', 't': 'string', 'c': true}}, {{'s': 'log.timestamp', 't': 'timestamp', 'c': true}}, {{'s': 'log.timestamp_unix_nano', 't': 'string', 'c': true}}, {{'s': 'log.severity_text', 't': 'string', 'c': true}},
    {{'s': 'log.severity_number', 't': 'int', 'c': severity_number <> 0}}, {{'s': 'log.body', 't': 'object', 'c': true}}, {{'s': 'log.body["k"]', 't': 'int', 'c': true}}, {{'s': 'log.message', 't': 'string', 'c': true}},
    {{'s': 'log.attributes', 't': 'object', 'c': true}}, {{'s': 'log.attributes["even"]', 't': 'boolean', 'c': true}}, {{'s': 'log.attributes["user_id"]', 't': 'int', 'c': true}}, {{'s': 'log.attributes["value"]', 't': 'float', 'c': true}},
    {{'s': 'record.id', 't': 'string', 'c': true}}]) AS x FROM logs)
SELECT regexp_extract(x.s, '^[a-z]+') AS field_group, x.s AS selector, x.t AS observed_types, count(*) AS populated, any_value(total) AS total, CASE WHEN count(*) < any_value(total) THEN 'PARTIAL' ELSE 'OK' END AS status
FROM f, n WHERE x.c GROUP BY x.s, x.t""")
def r1_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect(records(spark, sf_dir, "logs"), "logs")


EVIDENCE_SQL = f"""
WITH {LOGS}, c AS (SELECT count(*) AS total, count(*) FILTER (value = floor(value)) AS whole, count(service) AS named, count(host) AS hosts FROM logs), evidence AS (
  SELECT 'amount' AS "column", 'int' AS output_type, total, whole AS present, total - whole AS errors, CASE WHEN whole > 0 THEN 'int' ELSE '' END AS observed_types, 0 AS default_count, 'log.attributes["value"] (' || total || ')' AS selections FROM c
  UNION ALL SELECT 'flag', 'boolean', total, 0, hosts, '', 0, CASE WHEN hosts > 0 THEN 'resource.attributes["host.name"] (' || hosts || ')' ELSE '' END FROM c
  UNION ALL SELECT 'who', 'string', total, total, 0, 'string', 0, concat_ws(', ', 'resource.attributes["service.name"] (' || named || ')', 'log.attributes["user_id"] (' || (total - named) || ')') FROM c)"""


@query(f"{EVIDENCE_SQL} SELECT * FROM evidence")
def r2_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview.preview(records(spark, sf_dir, "logs"), STRICT, "logs")


@query(f"WITH {LOGS} SELECT count(*) FILTER (value = floor(value) AND host IS NULL) AS valid, count(*) FILTER (value <> floor(value) OR host IS NOT NULL) AS invalid FROM logs")
def r2a_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview.record_counts(records(spark, sf_dir, "logs"), STRICT, "logs")


@query(f"""
WITH {LOGS} , e AS (SELECT event_id, 'amount' AS "column", 'float value ' || value || ' cannot be converted to int' AS message FROM logs WHERE value <> floor(value)
  UNION ALL SELECT event_id, 'flag', 'string value "' || host || '" cannot be converted to boolean' FROM logs WHERE host IS NOT NULL)
SELECT event_id // 50 AS request_id, event_id % 50 AS resource_pos, "column", message FROM e ORDER BY event_id, "column" LIMIT 20""")
def r2b_first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = preview.examples(records(spark, sf_dir, "logs"), STRICT, "logs")[1]
    return wrong.select("request_id", F.col("resource_pos").cast("long").alias("resource_pos"), "column", "message")


#: A destination's columns.
CATALOG = [("otel.logs", "amount", "int"), ("otel.logs", "who", "string")]


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preview.preview(records(spark, sf_dir, "logs"), STRICT, "logs")
    return found.select(F.lit("logs").alias("signal"), F.lit("otel.logs").alias("table"), "*")


VERDICTS_SQL = """SELECT evidence.*, CASE "column" WHEN 'amount' THEN 'int' WHEN 'who' THEN 'string' END AS target_type, CASE WHEN "column" = 'flag' THEN 'missing' ELSE 'compatible' END AS compatibility,
  CASE WHEN "column" = 'flag' THEN 'ERROR missing column' WHEN errors > 0 THEN 'ERROR mapping (' || errors || ')' WHEN present = 0 THEN 'WARN unobserved' WHEN present < total THEN 'WARN partial' ELSE 'OK' END AS verdict FROM evidence"""


@query(f"""{EVIDENCE_SQL}, v AS ({VERDICTS_SQL})
SELECT count(*) FILTER (verdict LIKE 'WARN%') AS warnings, count(*) FILTER (verdict LIKE 'ERROR%') AS errors, count(*) FILTER (verdict <> 'OK') = 0 AS passes_strict, count(*) FILTER (verdict LIKE 'ERROR%') = 0 AS passes FROM v""")
def r2e_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview.gate(r2c_verdicts(spark, sf_dir))


@query(f"{EVIDENCE_SQL} {VERDICTS_SQL}")
def r2c_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = spark.createDataFrame(CATALOG, "table string, column string, type string")
    agreed = contract.validate(contract.describe(spark, {"logs": STRICT}, {"logs": "otel.logs"}), columns)
    return preview.verdicts(preview.preview(records(spark, sf_dir, "logs"), STRICT, "logs"), agreed.select("column", "target_type", "compatibility"))


@query("SELECT copies, count(*) AS texts FROM (SELECT count(*) AS copies FROM documents GROUP BY text, lang, source, n_chars HAVING count(*) > 1) GROUP BY copies")
def r4_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content ids that several logs share, by how many."""
    return identity.duplicates(records(spark, sf_dir, "documents"), "logs").groupBy("copies").agg(F.count("*").alias("texts"))


@query("""
WITH a AS (SELECT date_trunc('hour', ts) AS w, event_type, count(*) AS n FROM events GROUP BY ALL), b AS (SELECT date_trunc('hour', ts) AS w, event_type, count(*) AS n FROM events WHERE value < 20 GROUP BY ALL),
c AS (SELECT coalesce(a.w, b.w) AS w, coalesce(a.event_type, b.event_type) AS event_type, coalesce(a.n, 0) AS count_a, coalesce(b.n, 0) AS count_b FROM a FULL JOIN b ON a.w = b.w AND a.event_type = b.event_type)
SELECT epoch(w)::BIGINT AS window_start, event_type, count_a, count_b, count_b - count_a AS diff, (epoch(w) - epoch(lag(w) OVER (PARTITION BY event_type ORDER BY w)) - 3600)::BIGINT AS gap_seconds FROM c""")
def r5_compare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against one that misses some rows, by hour and event type."""
    rows = map_signal(records(spark, sf_dir, "logs"), {"ts": "log.timestamp", "event_type": "log.severity_text", "value": {"source": 'log.attributes["value"]', "cast": "float"}}, "logs")[0]
    return compare.compare_counts(rows, rows.where("value < 20"), "ts", ["event_type"]).withColumn("window_start", F.unix_seconds("window_start"))


@query(f"""{EVIDENCE_SQL}
SELECT 'otel.logs' AS "table", "column", output_type AS required_type, CASE "column" WHEN 'amount' THEN 'int' WHEN 'who' THEN 'string' END AS actual_type,
       CASE WHEN errors > 0 THEN 'blocked' WHEN "column" = 'flag' THEN 'add' ELSE 'exists' END AS status, observed_types, NULL::VARCHAR AS suggestion, 'logs' AS signals, true AS table_exists FROM evidence""")
def p4_plan_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.plan_columns(evidence(spark, sf_dir), spark.createDataFrame(CATALOG, "table string, column string, type string"))


@query(f"""{EVIDENCE_SQL}
SELECT 'otel.logs' AS "table", CASE WHEN sum(errors) > 0 THEN 'blocked' ELSE 'alter' END AS action, count(*) AS n_columns, count(*) FILTER (errors = 0 AND "column" = 'flag') AS n_added FROM evidence""")
def p5_plan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.plan_tables(contract.plan_columns(evidence(spark, sf_dir), spark.createDataFrame(CATALOG, "table string, column string, type string")))


@query(f"""
WITH {LOGS}
SELECT NULL::VARCHAR AS service, NULL::BIGINT AS n_named, count(*) AS n, sum(user_id)::BIGINT AS users FROM logs
UNION ALL SELECT service, count(service), count(*), sum(user_id)::BIGINT FROM logs GROUP BY service""")
def p6_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that gets rows, then a column more and rows with it; each time by a plan from evidence."""
    path, rows = scratch_dir(spark), records(spark, sf_dir, "logs")
    user, service = {"user": {"source": 'log.attributes["user_id"]', "cast": "int"}}, {"service": {"source": 'resource.attributes["service.name"]', "cast": "string"}}
    columns: list[tuple[str, str, str]] = []
    for step, mapping in enumerate((user, user | service)):
        seen = preview.preview(rows, mapping, "logs").select(F.lit("logs").alias("signal"), F.lit("t").alias("table"), "*")
        plan = contract.plan_columns(seen, spark.createDataFrame(columns, "table string, column string, type string"))
        contract.evolve_and_append(map_signal(rows, mapping, "logs")[0].withColumn("step", F.lit(step)), path, plan)
        columns = [("t", "user", "int")]
    n_named = F.when(F.max("step") == 1, F.count("service"))
    return contract.read_evolved(spark, path).groupBy("step", "service").agg(n_named.alias("n_named"), F.count("*").alias("n"), F.sum("user").alias("users")).drop("step")


@query(f"""
WITH {LOGS}
SELECT 'old' AS era, NULL::VARCHAR AS service, count(*) AS n, sum(user_id)::BIGINT AS users FROM logs
UNION ALL SELECT 'new', service, count(*), NULL FROM logs GROUP BY service""")
def p6_evolve_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog that gets rows, then rows with a column more and one less, read by its name."""
    path, rows = scratch_dir(spark), records(spark, sf_dir, "logs")
    table = f"spanloom_p6_{uuid.uuid4().hex}"
    user, service = {"user": {"source": 'log.attributes["user_id"]', "cast": "int"}}, {"service": {"source": 'resource.attributes["service.name"]', "cast": "string"}}
    columns: list[tuple[str, str, str]] = []
    try:
        for era, mapping in (("old", user), ("new", service)):
            seen = preview.preview(rows, mapping, "logs").select(F.lit("logs").alias("signal"), F.lit("t").alias("table"), "*")
            plan = contract.plan_columns(seen, spark.createDataFrame(columns, "table string, column string, type string"))
            contract.evolve_table(map_signal(rows, mapping, "logs")[0].withColumn("era", F.lit(era)), table, plan, f"{path}/rows")
            columns = [("t", "user", "int")]
        spark.table(table).groupBy("era", "service").agg(F.count("*").alias("n"), F.sum("user").alias("users")).write.parquet(f"{path}/report")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.read.parquet(f"{path}/report")


LINE_SQL = """'{"name":"' || name || '","service":"' || service || '","span":"' || span_id || '","trace":"' || trace_id || '"}'"""
LINES = {"name": "span.name", "service": {"source": 'resource.attributes["service.name"]', "cast": "string"}, "span": "span.span_id", "trace": "span.trace_id"}


@query(f"WITH {SPANS} SELECT {LINE_SQL} AS value FROM spans")
def d1_append_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped rows appended as JSON lines, read back as they are."""
    path = scratch_dir(spark)
    sink.append_ndjson(map_signal(records(spark, sf_dir, "traces"), LINES, "traces")[0], path)
    return spark.read.text(path)


FULL = "r.n = 3 OR r.size + j.bytes > 330"


@query(f"""
WITH RECURSIVE {SPANS}, j AS (SELECT trace_id, row_number() OVER (PARTITION BY trace_id ORDER BY span_id) AS i, length({LINE_SQL}) + 1 AS bytes FROM spans),
r AS (
  SELECT trace_id, i, bytes, 0 AS batch, 1 AS n, bytes AS size FROM j WHERE i = 1
  UNION ALL SELECT j.trace_id, j.i, j.bytes, CASE WHEN {FULL} THEN r.batch + 1 ELSE r.batch END, CASE WHEN {FULL} THEN 1 ELSE r.n + 1 END, CASE WHEN {FULL} THEN j.bytes ELSE r.size + j.bytes END
  FROM r JOIN j ON j.trace_id = r.trace_id AND j.i = r.i + 1)
SELECT trace_id AS trace, batch::BIGINT AS batch, count(*) AS n_rows, sum(bytes)::BIGINT AS bytes FROM r GROUP BY ALL""")
def d2_pack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy batches of each request's mapped rows, by rows and by bytes of their JSON lines."""
    rows = map_signal(records(spark, sf_dir, "traces"), LINES, "traces")[0]
    sized = rows.select("trace", "span", (F.octet_length(sink.json_line(rows.columns)) + 1).cast("long").alias("bytes"))
    packed = sink.pack_batches(sized, "trace", ["span"], "bytes", max_rows=3, max_bytes=330)
    return packed.groupBy("trace", "batch").agg(F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery attempts from line items: an order is a batch, each of its lines an attempt."""
    lines = tables.table(spark, sf_dir, "lineitem")
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    outcome = F.when(F.col("l_returnflag") == "A", "succeeded").when(F.col("l_returnflag") == "R", "failed").otherwise("ambiguous")
    signal = F.get(F.array(*map(F.lit, ("logs", "traces", "metrics"))), (F.col("l_orderkey") % 3).cast("int"))
    return lines.select(F.col("l_orderkey").alias("batch_id"), signal.alias("signal"), F.concat(F.lit("t"), (F.col("l_orderkey") % 4).cast("string")).alias("table"), number.alias("attempt"), F.col("l_shipdate").cast("timestamp").alias("ts"), outcome.alias("outcome"), (F.col("l_linestatus") == "O").alias("retryable"), (F.col("l_orderkey") % 1000 + 1).alias("records"), F.concat(F.lit("e"), F.col("l_linenumber").cast("string")).alias("error"))


ATTEMPTS = """
attempts AS (
  SELECT l_orderkey AS batch_id, ['logs', 'traces', 'metrics'][l_orderkey % 3 + 1] AS signal, 't' || (l_orderkey % 4) AS "table",
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS attempt, l_shipdate AS ts,
         CASE l_returnflag WHEN 'A' THEN 'succeeded' WHEN 'R' THEN 'failed' ELSE 'ambiguous' END AS outcome, l_linestatus = 'O' AS retryable, l_orderkey % 1000 + 1 AS records, 'e' || l_linenumber AS error
  FROM lineitem),
settled AS (
  SELECT batch_id, signal, "table", max(records) AS records, count(*) AS attempts,
         CASE WHEN bool_or(outcome = 'succeeded') THEN 'written' WHEN bool_or(outcome = 'ambiguous') THEN 'ambiguous' WHEN bool_or(outcome = 'failed' AND NOT retryable) THEN 'permanent_failed' ELSE 'retry_exhausted' END AS status
  FROM attempts GROUP BY ALL)"""


@query(f"WITH {ATTEMPTS} SELECT * FROM settled")
def d5_settle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.settle(attempts(spark, sf_dir), closed=True)


@query(f"""
WITH {ATTEMPTS}, f AS (SELECT *, min(attempt) FILTER (outcome = 'ambiguous') OVER (PARTITION BY batch_id) AS first FROM attempts),
b AS (SELECT batch_id, signal, "table", count(*) AS n, max(records) AS records FROM f WHERE attempt > first GROUP BY ALL)
SELECT signal, "table", sum(n)::BIGINT AS replay_attempts, sum(records)::BIGINT AS replayed_records FROM b GROUP BY ALL""")
def d6_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.replays(attempts(spark, sf_dir))


DROPS_SQL = f"""
WITH {ATTEMPTS}, d AS (
  SELECT signal, "table", coalesce(sum(records) FILTER (status = 'written'), 0)::BIGINT AS written, coalesce(sum(records) FILTER (status = 'ambiguous'), 0)::BIGINT AS ambiguous,
         coalesce(sum(records) FILTER (status = 'permanent_failed'), 0)::BIGINT AS permanent_failed, coalesce(sum(records) FILTER (status = 'retry_exhausted'), 0)::BIGINT AS retry_exhausted,
         0::BIGINT AS enqueue_failed, coalesce(sum(records) FILTER (status IN ('permanent_failed', 'retry_exhausted')), 0)::BIGINT AS dropped, sum(records)::BIGINT AS received
  FROM settled GROUP BY ALL)"""


@query(f"{DROPS_SQL} SELECT * EXCLUDE received FROM d")
def d7_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.drops(ledger.settle(attempts(spark, sf_dir), closed=True))


@query("SELECT 'metrics' AS signal, 'unsupported_number_value_type' AS reason, count(*) AS items, count(*) AS data_points FROM events WHERE event_id % 97 = 0 HAVING count(*) > 0")
def d8_local_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = split_invalid_metrics(requests(spark, sf_dir, "numbers"))[1]
    return ledger.local_rejects(rejects.select(F.lit("metrics").alias("signal"), "reason", "data_points"))


@query(f"""{DROPS_SQL} SELECT signal, "table", CASE WHEN "table" <> 't1' THEN greatest(received + 5 - written - ambiguous - dropped, 0) ELSE 0 END AS unsettled FROM d""")
def d9_unsettled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records received and not accounted for; the queue of t1 is not empty."""
    settled = ledger.settle(attempts(spark, sf_dir), closed=True)
    received = settled.groupBy("signal", "table").agg((F.sum("records") + 5).alias("received"))
    counts = ledger.drops(settled).join(received, ["signal", "table"]).withColumns({"queue_observed": F.lit(True), "queue_size": F.when(F.col("table") == "t1", 3).otherwise(0)})
    return ledger.unsettled(counts).select("signal", "table", "unsettled")


@query(f"""
WITH {ATTEMPTS}, e AS (
  SELECT signal, "table", max(ts) AS last_attempt, max(ts) FILTER (outcome = 'succeeded') AS last_success, max(ts) FILTER (outcome <> 'succeeded') AS last_failure,
         max((ts, error)) FILTER (outcome <> 'succeeded') AS e, bool_or(outcome = 'succeeded') AS verified FROM attempts GROUP BY ALL)
SELECT signal, "table", epoch(last_attempt)::BIGINT AS last_attempt, epoch(last_success)::BIGINT AS last_success, epoch(last_failure)::BIGINT AS last_failure,
       CASE WHEN last_success IS NULL OR last_success < last_failure THEN e[2] END AS last_error, verified FROM e""")
def d10_last_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger.last_writes(attempts(spark, sf_dir))
    return rows.withColumns({c: F.unix_seconds(c) for c in ("last_attempt", "last_success", "last_failure")})


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the collector's own counters, from events."""
    events = tables.table(spark, sf_dir, "events")
    names = ["otelcol_receiver_accepted_log_records_total", "otelcol_receiver_accepted_spans", "otelcol_receiver_refused_metric_points", "otelcol_exporter_queue_size", "otelcol_exporter_queue_capacity", "otelcol_process_uptime"]
    name = F.get(F.array(*map(F.lit, names)), (F.col("event_id") % 6).cast("int"))
    part = F.get(F.array(*map(F.lit, ("otlp", "otlp/2", "other"))), (F.col("user_id") % 3).cast("int"))
    out = F.get(F.array(*map(F.lit, ("exporter", "exporter/x", "other"))), (F.col("user_id") % 3).cast("int"))
    kind = F.get(F.array(*map(F.lit, ("logs", "traces", "metrics"))), (F.col("user_id") % 5 % 3).cast("int"))
    return events.select(name.alias("name"), F.create_map(F.lit("receiver"), part, F.lit("exporter"), out, F.lit("data_type"), kind).alias("labels"), F.col("user_id").cast("double").alias("value"))


METRICS_SQL = """
WITH s AS (SELECT event_id % 6 AS k, ['logs', 'traces', 'metrics'][user_id % 5 % 3 + 1] AS kind, user_id AS v FROM events WHERE user_id % 3 < 2), g AS (SELECT unnest(['logs', 'traces', 'metrics']) AS signal),
metrics AS (
  SELECT signal, coalesce(sum(v) FILTER ((k = 0 AND signal = 'logs') OR (k = 1 AND signal = 'traces')), 0)::BIGINT AS received, 0::BIGINT AS receiver_failed,
         coalesce(sum(v) FILTER (k = 2 AND signal = 'metrics'), 0)::BIGINT AS receiver_refused, coalesce(sum(v) FILTER (k = 3 AND kind = signal), 0)::BIGINT AS queue_size,
         coalesce(sum(v) FILTER (k = 4 AND kind = signal), 0)::BIGINT AS queue_capacity
  FROM g, s GROUP BY signal)"""


@query(f"{METRICS_SQL} SELECT * FROM metrics")
def a1_collector_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.collector_metrics(metric_samples(spark, sf_dir))


def signal_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each signal: delivery counters of its table t<n>, and the collector's metrics."""
    tried = attempts(spark, sf_dir)
    counters = ledger.drops(ledger.settle(tried, closed=True)).groupBy("signal").agg(*(F.sum(c).alias(c) for c in ("written", "ambiguous", "permanent_failed", "retry_exhausted", "enqueue_failed", "dropped")))
    last = ledger.last_writes(tried).groupBy("signal").agg(F.max("last_success").alias("last_success"), F.max("last_failure").alias("last_failure"), F.bool_or("verified").alias("destination_verified"))
    runtime = counters.join(last, "signal").select("signal", F.concat(F.lit("otel."), "signal").alias("table"), F.lit(True).alias("ready"), "destination_verified", F.lit(True).alias("queue_enabled"), F.lit(1000).cast("long").alias("configured_capacity"), "written", "ambiguous", "permanent_failed", "retry_exhausted", "enqueue_failed", "dropped", "last_success", "last_failure", F.lit(None).cast("string").alias("last_error"))
    return status.ingestion_status(runtime, status.collector_metrics(metric_samples(spark, sf_dir)))


STATUS_SQL = f"""{METRICS_SQL.replace("WITH s AS", f"WITH {ATTEMPTS}, s AS")},
runtime AS (SELECT signal, sum(records) FILTER (status = 'written')::BIGINT AS written, sum(records) FILTER (status = 'ambiguous')::BIGINT AS ambiguous, sum(records) FILTER (status IN ('permanent_failed', 'retry_exhausted'))::BIGINT AS dropped FROM settled GROUP BY signal),
last AS (SELECT signal, max(ts) FILTER (outcome = 'succeeded') AS ok, max(ts) FILTER (outcome <> 'succeeded') AS bad FROM attempts GROUP BY signal),
status AS (
  SELECT signal, 'otel.' || signal AS "table", received, receiver_refused, written, ambiguous, dropped, queue_size, CASE WHEN queue_capacity > 0 THEN queue_capacity ELSE 1000 END AS queue_capacity, ok,
         CASE WHEN queue_capacity > 0 AND queue_size >= queue_capacity THEN 'refusing' WHEN bad > ok THEN 'degraded' ELSE 'ready' END AS state
  FROM runtime JOIN metrics USING (signal) JOIN last USING (signal))"""


@query(f"{STATUS_SQL} SELECT * EXCLUDE ok FROM status")
def a2_ingestion_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_status(spark, sf_dir).select("signal", "table", "received", "receiver_refused", "written", "ambiguous", "dropped", "queue_size", "queue_capacity", "state")


@query(f"{STATUS_SQL} SELECT CASE max(CASE state WHEN 'ready' THEN 1 WHEN 'degraded' THEN 2 ELSE 3 END) WHEN 1 THEN 'ready' WHEN 2 THEN 'degraded' ELSE 'refusing' END AS state FROM status")
def a4_overall_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.overall_state(signal_status(spark, sf_dir))


@query(f"""{STATUS_SQL}
SELECT signal, 'ingestion_received_total' AS name, received::DOUBLE AS value FROM status UNION ALL SELECT signal, 'ingestion_written_total', written::DOUBLE FROM status UNION ALL SELECT signal, 'ingestion_ambiguous_total', ambiguous::DOUBLE FROM status
UNION ALL SELECT signal, 'ingestion_dropped_total', dropped::DOUBLE FROM status UNION ALL SELECT signal, 'ingestion_queue_utilization', queue_size / queue_capacity FROM status
UNION ALL SELECT signal, 'ingestion_last_success_timestamp_seconds', epoch(ok)::DOUBLE FROM status UNION ALL SELECT signal, 'ingestion_destination_verified', 1.0 FROM status""")
def a5_status_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status as samples; the drop reasons of a signal summed."""
    samples = status.to_samples(signal_status(spark, sf_dir).withColumn("ts", F.lit(0).cast("timestamp")))
    return samples.groupBy(F.element_at("labels", "signal").alias("signal"), "name").agg(F.sum("value").alias("value"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status over time, one snapshot per event: counters that grow and, once in a while, start anew."""
    events = tables.table(spark, sf_dir, "events")
    table = F.concat(F.lit("t"), (F.col("user_id") % 2).cast("string"))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("signal"), table.alias("table"), F.least(F.lit(1.0), F.col("value") / 12).alias("queue_utilization"), F.floor(F.col("event_id") % 3000 / 900).alias("dropped"), F.floor(F.col("event_id") % 4000 / 1500).alias("ambiguous"), (F.col("ts").cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("user_id") * 60).cast("decimal(18,6)"))).alias("last_success"), (F.col("user_id") % 8 != 0).alias("destination_verified"))


SNAPSHOTS = """
snapshots AS (
  SELECT event_id, ts, epoch_us(ts) // 1000000 AS s, event_type AS signal, 't' || (user_id % 2) AS "table", least(1.0, value / 12) AS util, floor((event_id % 3000) / 900)::BIGINT AS dropped, floor((event_id % 4000) / 1500)::BIGINT AS ambiguous,
         (epoch_us(ts) - user_id * 60000000) // 1000000 AS ok, user_id % 8 <> 0 AS verified FROM events)"""


@query(f"WITH {SNAPSHOTS} SELECT event_id, max(util) OVER (PARTITION BY signal, \"table\" ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS max_value FROM snapshots")
def a6_moving_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots(spark, sf_dir).withColumn("value", F.col("queue_utilization"))
    return status.moving_max(rows, ["signal", "table"]).select("event_id", "max_value")


HOURS = 7200


ALERTS = f"""
g AS (
  SELECT *, max(util > 0) OVER (PARTITION BY signal, "table", ts) AS queued, CASE WHEN lag(dropped) OVER w IS NULL THEN 0 WHEN dropped < lag(dropped) OVER w THEN dropped ELSE dropped - lag(dropped) OVER w END AS d,
         CASE WHEN lag(ambiguous) OVER w IS NULL THEN 0 WHEN ambiguous < lag(ambiguous) OVER w THEN ambiguous ELSE ambiguous - lag(ambiguous) OVER w END AS a
  FROM snapshots WINDOW w AS (PARTITION BY signal, "table" ORDER BY ts, dropped, ambiguous)),
f AS (
  SELECT ts, signal, "table", s - min(s) OVER (PARTITION BY signal, "table" ORDER BY s) >= {HOURS} AS old, min((util > 0.8)::INT) OVER r = 1 AS near, sum(d) OVER r > 0 AS dropped, sum(a) OVER r > 0 AS ambiguous,
         min((queued AND s - ok > {HOURS})::INT) OVER r = 1 AS stalled, min((queued AND NOT verified)::INT) OVER r = 1 AS unverified
  FROM g WINDOW r AS (PARTITION BY signal, "table" ORDER BY s RANGE BETWEEN {HOURS} PRECEDING AND CURRENT ROW))
SELECT epoch_us(ts) AS ts, signal, "table", unnest(list_filter(['queue_near_capacity', 'dropped_telemetry', 'ambiguous_delivery', 'delivery_stalled', 'destination_unverified'],
       lambda x, i: [near AND old, dropped, ambiguous, stalled AND old, unverified AND old][i])) AS alert FROM f"""


@query(f"WITH {SNAPSHOTS}, {ALERTS}")
def a7_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five alerts, over windows of two hours."""
    return status.alerts(snapshots(spark, sf_dir), seconds=HOURS).withColumn("ts", F.unix_micros("ts"))


TIED = SNAPSHOTS.replace("snapshots AS (", "untied AS (") + ", snapshots AS (SELECT * REPLACE (date_trunc('hour', ts) AS ts, epoch_us(date_trunc('hour', ts)) // 1000000 AS s) FROM untied)"


@query(f"WITH {TIED}, {ALERTS}")
def a7_alerts_on_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over snapshots that share their times: one fixed answer."""
    rows = snapshots(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    return status.alerts(rows, seconds=HOURS).withColumn("ts", F.unix_micros("ts"))


@query(f"WITH {SPANS} SELECT trace_id AS trace, span_id AS span, duration_ns AS duration FROM spans WHERE name = 'RO'")
def q1_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped rows appended to a table, read back and filtered."""
    path = scratch_dir(spark)
    sink.append(map_signal(records(spark, sf_dir, "traces"), SHORTHAND, "traces")[0], path)
    return spark.read.parquet(path).where("name = 'RO'").select("trace", "span", "duration")


@query("SELECT '{\"event_id\":' || event_id || ',\"value\":' || value || ',\"half\":' || CASE WHEN event_id % 2 = 0 THEN value::VARCHAR ELSE 'null' END || '}' AS value FROM events")
def q3_export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    return sink.export_json(events.select("event_id", "value", F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("half")))


@query(f"WITH {LOGS} SELECT severity, count(*) AS n, sum(user_id)::BIGINT AS users FROM logs GROUP BY severity")
def f01_read_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as files of lines, read and decoded."""
    path = scratch_dir(spark)
    tables.log_requests(spark, sf_dir).select("value").write.text(path)
    rows = flatten(split_decoded(read_otlp(spark, path, "logs"))[0], "logs")
    return rows.groupBy(F.col("status").alias("severity")).agg(F.count("*").alias("n"), F.sum(at("attributes", "user_id", "bigint")).alias("users"))


@query(f"WITH {LOGS} SELECT severity, count(*) AS n, sum(user_id)::BIGINT AS users FROM logs GROUP BY severity")
def d4_stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests as a stream, mapped to a table in micro-batches."""
    path = scratch_dir(spark)
    tables.log_requests(spark, sf_dir).select("value").write.text(f"{path}/in")
    stream = ingest.read_otlp_stream(spark, f"{path}/in", max_files=4)
    mapping = {"severity": "log.severity_text", "user": {"source": 'log.attributes["user_id"]', "cast": "int"}}
    ingest.stream_to_table(stream, "logs", mapping, f"{path}/out", f"{path}/checkpoint", once=True).awaitTermination()
    return commits.read_committed(spark, f"{path}/out", "rows").groupBy("severity").agg(F.count("*").alias("n"), F.sum("user").alias("users"))


LANDED = "SELECT event_id // 50 AS request, event_id % 50 AS place, event_type AS severity FROM events ORDER BY event_id LIMIT 120"


def land(spark: SparkSession, requests: DataFrame, path: str) -> None:
    """Files of lines whose names are in the order of requests."""
    requests.repartitionByRange("request_id").sortWithinPartitions("request_id").select("value").write.mode("append").text(path)


@query(LANDED)
def f24_capture_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 120 logs of a stream that ends after the first request and starts again when the others have landed."""
    path, every = scratch_dir(spark), tables.log_requests(spark, sf_dir)
    for requests in (every.where("request_id < 1"), every.where("request_id >= 1")):
        land(spark, requests, f"{path}/in")
        taken = ingest.capture_stream(ingest.read_otlp_stream(spark, f"{path}/in"), "logs", 120, 600, f"{path}/out", f"{path}/checkpoint", once=True)
    request = F.dense_rank().over(Window.orderBy("batch", "request_id")) - 1  # 120 rows
    return taken.select(request.cast("long").alias("request"), F.col("resource_pos").cast("long").alias("place"), F.col("item.severityText").alias("severity"))


@query("SELECT event_id // 50 AS request, event_id % 50 AS place, user_id AS value FROM events ORDER BY event_id LIMIT 120")
def f24_capture_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for metric points: the last metric is cut to the points that are left."""
    path, every = scratch_dir(spark), tables.series_requests(spark, sf_dir)
    for requests in (every.where("request_id < 1"), every.where("request_id >= 1")):
        land(spark, requests, f"{path}/in")
        taken = ingest.capture_stream(ingest.read_otlp_stream(spark, f"{path}/in"), "metrics", 120, 600, f"{path}/out", f"{path}/checkpoint", once=True)
    request = F.dense_rank().over(Window.orderBy("batch", "request_id")) - 1  # 120 rows at most
    points = taken.select(request.cast("long").alias("request"), F.posexplode("item.gauge.dataPoints").alias("place", "p"))
    return points.select("request", F.col("place").cast("long").alias("place"), F.col("p.asInt").cast("long").alias("value"))


@query("SELECT user_id % 4 AS shard, count(*) // 100 AS batches, count(*) // 100 * 100 AS items, 'items' AS reason FROM events GROUP BY ALL HAVING count(*) >= 100")
def d3_batches_by_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of a stream in batches of a hundred, by shards of users; what is left over waits as state."""
    path = scratch_dir(spark)
    tables.log_requests(spark, sf_dir).select("value").write.text(f"{path}/in")
    logs = flatten(split_decoded(decode(ingest.read_otlp_stream(spark, f"{path}/in", max_files=4), "logs"))[0], "logs")
    items = logs.select((at("attributes", "user_id", "bigint") % 4).alias("shard"), F.col("message").alias("item"))
    batches = ingest.batch_items(items, most=100, seconds=None)
    batches.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).format("parquet").option("path", f"{path}/out").start().awaitTermination()
    done = spark.read.schema(batches.schema).parquet(f"{path}/out")
    return done.groupBy("shard", "reason").agg(F.countDistinct("batch").alias("batches"), F.sum(F.size("items")).cast("long").alias("items"))


@query("""
WITH r AS (SELECT l_returnflag AS flag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS i, CASE l_returnflag WHEN 'A' THEN 10 WHEN 'N' THEN 30 ELSE 70 END AS bytes FROM lineitem)
SELECT flag, i // least(25, 1000 // bytes) AS batch, count(*) AS n_rows, sum(bytes)::BIGINT AS bytes FROM r GROUP BY ALL""")
def d2_huge_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy batches of three keys that hold all line items, each packed by many tasks."""
    size = F.when(F.col("l_returnflag") == "A", 10).when(F.col("l_returnflag") == "N", 30).otherwise(70)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = tables.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), *order, size.cast("long").alias("bytes"))
    packed = sink.pack_batches(rows, "flag", order, "bytes", max_rows=25, max_bytes=1000, chunk=500)
    return packed.groupBy("flag", "batch").agg(F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes"))
