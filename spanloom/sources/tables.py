"""Export requests in JSON, derived from order, line item, event and document tables.

These stand in for landed telemetry files: each gives (request_id, value) with one request a row, so that the work of every
query grows with its tables.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import SEVERITIES

#: Rows of a table in one request.
BATCH = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nanos(ts: Column) -> Column:
    return F.concat(F.unix_micros(ts.cast("timestamp")).cast("string"), F.lit("000"))


def attribute(key: str, kind: str, value: Column) -> Column:
    """One entry of an attribute list; kinds as JSON spells them (integers as text)."""
    kinds = {"stringValue": "string", "intValue": "string", "doubleValue": "double", "boolValue": "boolean"}
    fields = [(value.cast(t) if k == kind else F.lit(None).cast(t)).alias(k) for k, t in kinds.items()]
    return F.struct(F.lit(key).alias("key"), F.struct(*fields).alias("value"))


def requests(rows: DataFrame, request_id: Column, top: str, place: list[str], resource: Column) -> DataFrame:
    """Gather resources to requests in the order of ``place``."""
    gathered = rows.groupBy(request_id.cast("long").alias("request_id")).agg(F.array_sort(F.collect_list(F.struct(*place, resource.alias("r")))).alias("g"))
    return gathered.select("request_id", F.to_json(F.struct(F.col("g.r").alias(top))).alias("value"))


def trace_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per order: a root span without an end, and a child span per line item."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    hex16 = lambda c, n: F.lpad(F.translate(F.hex(c), "ABCDEF", "abcdef"), n, "0")
    key = F.concat_ws(":", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    no_text = F.lit(None).cast("string")

    def span(span_id: Column, parent: Column, name: Column, kind: int, start: Column, end: Column, code: Column, attributes: Column) -> Column:
        fields = {"traceId": hex16(F.col("o_orderkey"), 32), "spanId": span_id, "parentSpanId": parent, "name": name, "kind": F.lit(kind), "startTimeUnixNano": start, "endTimeUnixNano": end, "attributes": attributes, "status": F.struct(code.alias("code"))}
        return F.struct(*(c.alias(n) for n, c in fields.items()))

    root_id = hex16(F.col("o_orderkey") * 8, 16)
    child = span(F.left(F.sha2(key, 256), F.lit(16)), root_id, F.concat("l_returnflag", "l_linestatus"), 2, nanos(F.col("o_orderdate")), nanos(F.col("l_shipdate")), F.when(F.col("l_returnflag") == "R", 2).otherwise(0), F.array(attribute("l_partkey", "intValue", F.col("l_partkey")), attribute("l_discount", "doubleValue", F.col("l_discount"))))
    # texts are made before they are gathered, where they are compiled: an aggregate of lists interprets what it gathers
    told = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select("o_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", F.to_json(child).alias("span")).alias("c"))
    children = told.groupBy("o_orderkey").agg(F.array_sort(F.collect_list("c")).alias("c"))
    root = span(root_id, no_text, F.lit("order"), 1, nanos(F.col("o_orderdate")), no_text, F.lit(0), F.array(attribute("o_orderstatus", "stringValue", F.col("o_orderstatus")), attribute("o_totalprice", "doubleValue", F.col("o_totalprice"))))
    resource = F.struct(F.array(attribute("service.name", "stringValue", F.col("o_orderpriority"))).alias("attributes"))
    scope = F.struct(F.lit("orders").alias("name"), F.lit("1").alias("version"))
    begin = F.concat(F.lit('{"resourceSpans":[{"resource":'), F.to_json(resource), F.lit(',"scopeSpans":[{"scope":'), F.to_json(scope), F.lit(',"spans":['), F.to_json(root))
    rows = orders.select("o_orderkey", begin.alias("begin")).join(children, "o_orderkey", "left")
    return rows.select(F.col("o_orderkey").cast("long").alias("request_id"), F.concat_ws(",", "begin", "c.span").alias("value")).select("request_id", F.concat("value", F.lit("]}]}]}")).alias("value"))


def log_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per 50 events: each event a log under its own resource; every 7th has no service name."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    body = F.struct(F.struct(F.array(F.struct(F.lit("k").alias("key"), F.struct(k.alias("intValue")).alias("value"))).alias("values")).alias("kvlistValue"))
    fields = {"timeUnixNano": nanos(F.col("ts")), "severityText": F.col("event_type"), "severityNumber": (F.col("event_id") % 24).cast("int"), "body": body, "attributes": F.array(attribute("user_id", "intValue", F.col("user_id")), attribute("value", "doubleValue", F.col("value")), attribute("even", "boolValue", F.col("event_id") % 2 == 0))}
    name = F.when(F.col("event_id") % 7 != 0, F.array(attribute("service.name", "stringValue", F.concat(F.lit("svc-"), (F.col("user_id") % 5).cast("string"))))).otherwise(F.array(attribute("host.name", "stringValue", F.concat(F.lit("host-"), (F.col("user_id") % 3).cast("string")))))
    log = F.struct(*(c.alias(n) for n, c in fields.items()))
    resource = F.struct(F.struct(name.alias("attributes")).alias("resource"), F.array(F.struct(F.struct(F.lit("events").alias("name")).alias("scope"), F.array(log).alias("logRecords"))).alias("scopeLogs"))
    return requests(events, F.floor(F.col("event_id") / BATCH), "resourceLogs", ["event_id"], resource)


def document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per document, its text the body of one log."""
    docs = table(spark, sf_dir, "documents")
    log = F.struct(F.struct(F.col("text").alias("stringValue")).alias("body"), F.array(attribute("lang", "stringValue", F.col("lang")), attribute("source", "stringValue", F.col("source")), attribute("n_chars", "intValue", F.col("n_chars"))).alias("attributes"))
    resource = F.struct(F.array(F.struct(F.array(log).alias("logRecords"))).alias("scopeLogs"))
    return docs.select(F.col("doc_id").cast("long").alias("request_id"), F.to_json(F.struct(F.array(resource).alias("resourceLogs"))).alias("value"))


def number_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per 50 events: each a metric of one point, a gauge for odd and a sum for even ids; every 97th without a number."""
    events = table(spark, sf_dir, "events")
    no_number = F.col("event_id") % 97 == 0
    point = F.struct(nanos(F.col("ts")).alias("timeUnixNano"), F.when(~no_number & (F.col("event_id") % 2 == 1), F.col("value")).alias("asDouble"), F.when(~no_number & (F.col("event_id") % 2 == 0), F.col("user_id").cast("string")).alias("asInt"), F.array(attribute("user_id", "intValue", F.col("user_id"))).alias("attributes"), F.when(F.col("event_id") % 10 == 0, F.array(F.struct(nanos(F.col("ts")).alias("timeUnixNano"), F.col("value").alias("asDouble"), F.lit("ab").alias("traceId")))).alias("exemplars"))
    gauge = F.when(F.col("event_id") % 2 == 1, F.struct(F.array(point).alias("dataPoints")))
    total = F.when(F.col("event_id") % 2 == 0, F.struct(F.array(point).alias("dataPoints"), F.lit(2).alias("aggregationTemporality"), F.lit(True).alias("isMonotonic")))
    metric = F.struct(F.col("event_type").alias("name"), F.lit("1").alias("unit"), gauge.alias("gauge"), total.alias("sum"))
    resource = F.struct(F.array(F.struct(F.array(metric).alias("metrics"))).alias("scopeMetrics"))
    return requests(events, F.floor(F.col("event_id") / BATCH), "resourceMetrics", ["event_id"], resource)


BOUNDS = (10, 20, 30, 40)


def shape_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per order with a histogram and an exponential histogram of its quantities, and a summary."""
    q = F.col("l_quantity")
    edges = [float("-inf"), *BOUNDS, float("inf")]
    buckets = F.array(*(F.count_if((q > lo) & (q <= hi)).cast("string") for lo, hi in zip(edges, edges[1:])))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("string").alias("n"), F.sum(q).alias("total"), F.min(q).alias("least"), F.max(q).alias("most"), buckets.alias("buckets"))
    whole = [F.col("n").alias("count"), F.col("total").alias("sum"), F.col("least").alias("min"), F.col("most").alias("max")]
    key = F.array(attribute("l_orderkey", "intValue", F.col("l_orderkey"))).alias("attributes")
    histogram = F.struct(F.array(F.struct(key, *whole, F.col("buckets").alias("bucketCounts"), F.array(*(F.lit(float(b)) for b in BOUNDS)).alias("explicitBounds"))).alias("dataPoints"), F.lit(1).alias("aggregationTemporality"))
    exponential = F.struct(F.array(F.struct(key, F.col("n").alias("count"), F.col("total").alias("sum"), F.lit(2).alias("scale"), F.lit("0").alias("zeroCount"), F.struct(F.lit(1).alias("offset"), F.array("n").alias("bucketCounts")).alias("positive"))).alias("dataPoints"), F.lit(2).alias("aggregationTemporality"))
    summary = F.struct(F.array(F.struct(key, F.col("n").alias("count"), F.col("total").alias("sum"), F.array(F.struct(F.lit(0.0).alias("quantile"), F.col("least").alias("value")), F.struct(F.lit(1.0).alias("quantile"), F.col("most").alias("value"))).alias("quantileValues"))).alias("dataPoints"))
    kinds = {"histogram": histogram, "exponentialHistogram": exponential, "summary": summary}
    metric = lambda name, own: F.struct(F.lit(name).alias("name"), *(F.when(F.lit(k == own), c).alias(k) for k, c in kinds.items()))
    metrics = F.array(metric("h", "histogram"), metric("e", "exponentialHistogram"), metric("s", "summary"))
    resource = F.struct(F.array(F.struct(metrics.alias("metrics"))).alias("scopeMetrics"))
    return rows.select(F.col("l_orderkey").cast("long").alias("request_id"), F.to_json(F.struct(F.array(resource).alias("resourceMetrics"))).alias("value"))


def filled(request: dict, columns: dict[str, Column]) -> Column:
    """A request's JSON text, with ``@name@`` in its texts replaced by a column."""
    text = F.lit(json.dumps(request))
    for name, c in columns.items():
        text = F.replace(text, F.lit(f"@{name}@"), c.cast("string"))
    return text


def otlp(v) -> dict:
    """A Python value as an attribute value; a text between @ signs with a leading # is a number."""
    if isinstance(v, dict):
        return {"kvlistValue": {"values": entries(v)}}
    if isinstance(v, list):
        return {"arrayValue": {"values": [otlp(x) for x in v]}}
    if v.startswith("#"):
        return {"intValue": v[1:]}
    return {"doubleValue": v[1:]} if v.startswith("~") else {"stringValue": v}


def entries(attributes: dict) -> list[dict]:
    return [{"key": k, "value": otlp(v)} for k, v in attributes.items()]


def one_log(attributes: dict, resource: dict | None = None) -> dict:
    return {"resourceLogs": [{"resource": {"attributes": entries(resource or {})}, "scopeLogs": [{"logRecords": [{"attributes": entries(attributes)}]}]}]}


def deep_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per event: a log with two attributes that are nested eight deep."""
    attributes = {"deep": {"a": [{"b": {"c": [{"d": [{"e": "#@id@"}]}]}}]}, "path": {"o": {"p": {"q": {"r": {"s": {"t": {"u": {"v": "#@id@"}}}}}}}}}
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("request_id"), filled(one_log(attributes), {"id": F.col("event_id")}).alias("value"))


def ratio_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per event: a log with a ratio that is no number for every 11th and infinite for every 13th."""
    ratio = F.when(F.col("event_id") % 11 == 0, "NaN").when(F.col("event_id") % 13 == 0, "-Infinity").otherwise(F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("request_id"), filled(one_log({"ratio": "~@ratio@"}), {"ratio": ratio}).alias("value"))


def loose_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per event, written in one of five ways by its id: exactly; numbers as texts and enums by name; fields named as in the
    protocol's definition; one field of another kind; and, every fifth, no JSON."""
    events = table(spark, sf_dir, "events")

    def request(log: dict, count, snake: bool = False) -> dict:
        names = ("resource_logs", "dropped_attributes_count", "scope_logs", "log_records") if snake else ("resourceLogs", "droppedAttributesCount", "scopeLogs", "logRecords")
        return {names[0]: [{"resource": {names[1]: count}, names[2]: [{names[3]: [log]}]}]}

    body = {"body": otlp("#@id@")}
    ways = [
        request({"severityNumber": "@number@", **body}, "@few@"),
        request({"severityNumber": "@name@", "timeUnixNano": "@id@", **body}, "@few@"),
        request({"severity_number": "@number@", "time_unix_nano": "@id@", "body": {"kvlist_value": {"values": [{"key": "k", "value": {"int_value": "@id@"}}]}}}, "@few@", snake=True),
        request({"severityNumber": {"odd": True}, **body}, "@few@"),
        {},
    ]
    number = F.col("event_id") % 24 + 1
    names = F.array(*(F.lit(f"SEVERITY_NUMBER_{n.upper()}") for n in SEVERITIES))
    columns = {"id": F.col("event_id"), "number": number, "few": F.col("event_id") % 9, "name": F.get(names, number.cast("int"))}
    bare = [F.regexp_replace(filled(w, columns), '"(severityNumber|severity_number)": "([0-9]+)"', '"$1": $2') if i in (0, 2) else filled(w, columns) for i, w in enumerate(ways)]
    text = F.when(F.col("event_id") % 5 == 4, F.concat(F.lit("no request "), F.col("event_id").cast("string"))).otherwise(F.get(F.array(*bare), (F.col("event_id") % 5).cast("int")))
    return events.select(F.col("event_id").cast("long").alias("request_id"), text.alias("value"))


#: Events in one attribute of a wide request.
WIDE = 5_000


def wide_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per 5,000 events: one log with one attribute, an array that has an object for each."""
    entry = F.struct(F.col("event_id"), F.struct(F.struct(F.array(attribute("id", "intValue", F.col("event_id")), attribute("type", "stringValue", F.col("event_type"))).alias("values")).alias("kvlistValue")).alias("v"))
    rows = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / WIDE).cast("long").alias("request_id")).agg(F.array_sort(F.collect_list(entry)).alias("g"))
    value = F.struct(F.struct(F.col("g.v").alias("values")).alias("arrayValue"))
    log = F.struct(F.array(F.struct(F.lit("all").alias("key"), value.alias("value"))).alias("attributes"))
    return rows.select("request_id", F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.array(log).alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs"))).alias("value"))


def word_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per event: a log with a text that reads like a number which is none, and for every 7th such a number in a list."""
    word = F.get(F.array(F.lit("NaN"), F.lit("Infinity"), F.lit("-Infinity")), (F.col("event_id") % 3).cast("int"))
    plain, odd = one_log({"word": "@word@", "list": ["@word@", {"again": "@word@"}]}), one_log({"word": "@word@", "list": ["@word@", {"again": "~@word@"}]})
    text = F.when(F.col("event_id") % 7 == 0, filled(odd, {"word": word})).otherwise(filled(plain, {"word": word}))
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("request_id"), text.alias("value"))


#: The largest unsigned number of 64 bits.
MOST = 2**64 - 1


def long_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per line item: a span from its quantity in nanoseconds to the last nanosecond of 64 bits less its part."""
    request = {"resourceSpans": [{"scopeSpans": [{"spans": [{"name": "@key@", "startTimeUnixNano": "@start@", "endTimeUnixNano": "@end@"}]}]}]}
    end = F.lit(str(MOST)).cast("decimal(20,0)") - F.col("l_partkey")
    columns = {"key": F.concat_ws(":", "l_orderkey", "l_linenumber"), "start": F.col("l_quantity").cast("bigint"), "end": end.cast("decimal(20,0)")}
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("request_id"), filled(request, columns).alias("value"))


def unsigned_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per event: a histogram whose counts are the largest unsigned number less its user, and its user."""
    point = {"count": "@large@", "bucketCounts": ["@large@", "@user@"], "explicitBounds": [1.5], "attributes": entries({"id": "#@id@"})}
    request = {"resourceMetrics": [{"scopeMetrics": [{"metrics": [{"name": "h", "histogram": {"dataPoints": [point]}}]}]}]}
    large = (F.lit(str(MOST)).cast("decimal(20,0)") - F.col("user_id")).cast("decimal(20,0)")
    columns = {"large": large, "user": F.col("user_id"), "id": F.col("event_id")}
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("request_id"), filled(request, columns).alias("value"))


def linked_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per line item: a span with two events and a link."""
    events = [{"name": "shipped", "timeUnixNano": "@ns@", "attributes": entries({"flag": "@flag@"}), "droppedAttributesCount": 1}, {"name": "empty"}]
    links = [{"traceId": "@trace@", "spanId": "@span@", "traceState": "s=1", "attributes": entries({"part": "#@part@"}), "flags": 3}]
    request = {"resourceSpans": [{"scopeSpans": [{"spans": [{"name": "line", "events": events, "links": links}]}]}]}
    columns = {"ns": nanos(F.col("l_shipdate")), "flag": F.col("l_returnflag"), "trace": F.lpad(F.lower(F.hex("l_orderkey")), 32, "0"), "span": F.lpad(F.lower(F.hex("l_suppkey")), 16, "0"), "part": F.col("l_partkey")}
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("long").alias("request_id"), filled(request, columns).alias("value"))


def series_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per 50 events: one gauge with a point for each."""
    point = F.struct(F.col("event_id"), F.struct(nanos(F.col("ts")).alias("timeUnixNano"), F.col("user_id").cast("string").alias("asInt")).alias("p"))
    rows = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / BATCH).cast("long").alias("request_id")).agg(F.array_sort(F.collect_list(point)).alias("g"))
    metric = F.struct(F.lit("users").alias("name"), F.struct(F.col("g.p").alias("dataPoints")).alias("gauge"))
    return rows.select("request_id", F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.array(metric).alias("metrics"))).alias("scopeMetrics"))).alias("resourceMetrics"))).alias("value"))


#: Resource and own attributes that ready-made mappings read: first by their present names, then by older ones.
SERVICE = {"service.name": "svc-@user@", "service.version": "1.@user@", "service.instance.id": "i-@user@", "k8s.pod.name": "pod", "k8s.namespace.name": "ns", "k8s.cluster.name": "cluster", "container.name": "box", "host.name": "host-@user@"}
CONVENTIONS = {
    "logs": (
        (SERVICE | {"host.ip": ["10.0.0.1", "10.0.0.2"], "deployment.environment.name": "prod"}, {"source": "app", "exception.type": "E@user@", "exception.message": "failed"}),
        (SERVICE | {"host.ip": "10.0.0.9", "telemetry.sdk.language": "go"}, {"env": "dev"}),
    ),
    "traces": (
        (SERVICE | {"host.ip": ["10.0.0.1"], "deployment.environment": "prod"}, {"http.request.method": "GET", "http.response.status_code": "#200", "url.path": "/p/@user@", "http.route": "/p", "peer.service": "peer", "db.system.name": "pg", "db.operation.name": "select", "rpc.method": "Get", "error.type": "none"}),
        (SERVICE | {"host.ip": "10.0.0.9", "env": "dev"}, {"http.method": "PUT", "http.status_code": " 404 ", "http.target": "/old", "server.address": "old-peer", "db.system": "my", "db.operation": "insert"}),
    ),
}


def convention_requests(spark: SparkSession, sf_dir: str, signal: str) -> DataFrame:
    """A request per event: a log or a span with attributes by the conventions of even, or of odd ids."""

    def request(resource: dict, own: dict) -> dict:
        if signal == "logs":
            return one_log(own, resource)
        return {"resourceSpans": [{"resource": {"attributes": entries(resource)}, "scopeSpans": [{"spans": [{"name": "s", "attributes": entries(own)}]}]}]}

    even, odd = (filled(request(*c), {"user": F.col("user_id")}) for c in CONVENTIONS[signal])
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("request_id"), F.when(F.col("event_id") % 2 == 0, even).otherwise(odd).alias("value"))
