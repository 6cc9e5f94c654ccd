"""Decoding, flattening, mapping and casts on small requests written out here."""

import json

import pytest
from pyspark.sql import functions as F

from spanloom.functions.casts import cast, float_text
from spanloom.functions.paths import parse
from spanloom.functions.values import rfc3339_nanos, timestamp_of_nanos
from spanloom.operators import identity, inspect, mapping, sampling
from spanloom.operators.flatten import flatten, split_invalid_metrics
from spanloom.operators.selectors import select, selectors
from spanloom.sources.otlp import decode, split_decoded


def kv(key, **value):
    return {"key": key, "value": value}


def requests(spark, signal, *texts):
    rows = [(i, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return decode(spark.createDataFrame(rows, "request_id long, value string"), signal)


def log(**fields):
    return {"resourceLogs": [{"resource": {"attributes": [kv("service.name", stringValue="api"), kv("empty")]}, "scopeLogs": [{"logRecords": [fields]}]}]}


def flat(spark, signal, *texts):
    return flatten(split_decoded(requests(spark, signal, *texts))[0], signal)


def test_values_of_every_kind(spark):
    body = {"kvlistValue": {"values": [kv("list", arrayValue={"values": [{"intValue": "9007199254740993"}, {"doubleValue": 2.0}, {}, {"kvlistValue": {"values": [kv("k.é\"", boolValue=True)]}}]}), kv("bytes", bytesValue="aGk=")]}}
    row = flat(spark, "logs", log(body=body, timeUnixNano="1713835425123456789", attributes=[kv("a", intValue=1), kv("a", intValue=2)])).select(F.to_json("body").alias("body"), "message", F.to_json("attributes").alias("attributes"), F.to_json("resource").alias("resource"), "status", "observed_timestamp_unix_nano", F.col("scope.attributes").isNull().alias("no_scope"), rfc3339_nanos(F.col("timestamp_unix_nano")).alias("text"), F.unix_micros(timestamp_of_nanos(F.col("timestamp_unix_nano"))).alias("us")).first()
    assert json.loads(row.body) == {"bytes": "aGk=", "list": [9007199254740993, 2.0, None, {'k.é"': True}]}
    assert row.message == row.body and row.attributes == '{"a":2}' and json.loads(row.resource) == {"service.name": "api", "empty": None}
    assert (row.status, row.observed_timestamp_unix_nano, row.no_scope) == ("", "", True)
    assert (row.text, row.us) == ("2024-04-23T01:23:45.123456789Z", 1713835425123456)


def test_decode_rejects(spark):
    found = {r.request_id: r.reject_reason for r in requests(spark, "logs", log(body={"stringValue": "x"}), "{broken", '{"resourceLogs": []}', "[1]").collect()}
    assert found == {0: None, 1: "decode_failed", 2: None, 3: "decode_failed"}


def otlp(v):
    """A Python value as an attribute value."""
    if v is None:
        return {}
    if isinstance(v, dict):
        return {"kvlistValue": {"values": [kv(k, **otlp(x)) if x is not None else {"key": k} for k, x in v.items()]} if v else {}}
    if isinstance(v, list):
        return {"arrayValue": {"values": [otlp(x) for x in v]} if v else {}}
    name = {bool: "boolValue", int: "intValue", float: "doubleValue", str: "stringValue"}[type(v)]
    return {name: str(v) if isinstance(v, int) and not isinstance(v, bool) else v}


def test_values_of_any_depth(spark):
    deep = [1, -2.5, 3.0, 1e300, True, None, "", 'a{}b [] {"intValue":"5"} \\ " \u0007 {"key":"x"}', {}, [], {"k.é\"{": None, "": [[], {}], "values": "values"}]
    for i in range(30):
        deep = [deep, i] if i % 2 else {"a": deep, f"b{i}": 0.5}
    values = [deep, {"a": [None, None, {}]}, {"value": {"key": "key", "value": {"value": 1}}}, [[[[[[[["x"]]]]]]]], 7, 2.0, {"a": {"i": 1, "d": 2.0}}]
    rows = flat(spark, "logs", *(log(body=otlp(v), attributes=[kv("v", **otlp(v))]) for v in values)).orderBy("request_id").select(F.to_json("body").alias("body"), F.to_json("attributes").alias("attributes"), F.schema_of_variant("body").alias("type")).collect()
    plain = lambda v: json.loads(json.dumps(v))
    assert [json.loads(r.body) for r in rows] == [plain(v) for v in values]
    assert [json.loads(r.attributes)["v"] for r in rows] == [plain(v) for v in values]
    assert [r.type for r in rows[4:]] == ["BIGINT", "DOUBLE", "OBJECT<a: OBJECT<d: DOUBLE, i: BIGINT>>"]
    twice = {"kvlistValue": {"values": [kv("a", intValue=1), kv("a", intValue=2)]}}
    assert flat(spark, "logs", log(body=twice)).select(F.to_json("body").alias("b")).first().b == '{"a":2}'


def test_inventory_of_any_depth(spark):
    deep = {"x": 1}
    for _ in range(9):
        deep = {"k\"": deep}
    rows = flat(spark, "logs", log(attributes=[kv("o", **otlp(deep)), kv("s", stringValue="")]), log(attributes=[kv("o", stringValue="text"), kv("n", **otlp({"none": None, "list": [{"inner": 1}]}))]))
    found = {r.selector: (r.observed_types, r.populated, r.total, r.status) for r in inspect.inspect(rows, "logs").collect()}
    path = 'log.attributes["o"]'
    assert found[path] == ("object,string", 2, 2, "MIXED")
    for _ in range(9):
        path += '["k\\""]'
        assert found[path] == ("object", 1, 2, "PARTIAL")
    assert found[path + '["x"]'] == ("int", 1, 2, "PARTIAL")
    assert found['log.attributes["n"]["list"]'] == ("array", 1, 2, "PARTIAL") and not [s for s in found if "inner" in s or "none" in s or '"s"' in s]


def test_spans(spark):
    span = lambda **f: {"resourceSpans": [{"scopeSpans": [{"scope": {"name": "s", "attributes": [kv("x", intValue=1)]}, "spans": [f]}]}]}
    rows = flat(spark, "traces", span(startTimeUnixNano="5", endTimeUnixNano=9, kind=2, status={"code": 2}, events=[{"name": "e", "timeUnixNano": "7"}], links=[{"traceId": "t"}]), span(startTimeUnixNano=9, endTimeUnixNano=5), span(endTimeUnixNano=5), {"resourceSpans": [{"scopeSpans": []}]})
    found = rows.orderBy("request_id").select("duration_ns", "kind", "status_code", F.size("events").alias("n"), F.to_json(F.col("scope.attributes")).alias("s"), F.get("events", F.lit(0))["timestamp_unix_nano"].alias("t")).collect()
    assert [tuple(r) for r in found] == [(4, "server", "error", 1, '{"x":1}', "7"), (None, "unspecified", "unset", 0, '{"x":1}', None), (None, "unspecified", "unset", 0, '{"x":1}', None)]


def metric(**fields):
    return {"resourceMetrics": [{"scopeMetrics": [{"metrics": [{"name": "m", **fields}]}]}]}


def test_metrics_go_whole(spark):
    good, empty = {"asInt": "9223372036854775807"}, {"timeUnixNano": "1"}
    texts = [metric(gauge={"dataPoints": [good, empty]}), metric(), metric(sum={"dataPoints": [{"asDouble": 0.5}, {"asInt": 0}]}), metric(histogram={"dataPoints": [{"count": "3", "sum": 1.5, "bucketCounts": ["1", "2"], "explicitBounds": [5]}]})]
    decoded = split_decoded(requests(spark, "metrics", *texts))[0]
    rejects = {r.request_id: (r.reason, r.data_points) for r in split_invalid_metrics(decoded)[1].collect()}
    assert rejects == {0: ("unsupported_number_value_type", 2), 1: ("unsupported_metric_type", 0)}
    points = flatten(decoded, "metrics").orderBy("request_id", "point_pos").select("type", "value_type", "int_value", "number_value", "is_monotonic", F.to_json("distribution").alias("d")).collect()
    assert [tuple(p) for p in points[:2]] == [("sum", "double", None, 0.5, False, None), ("sum", "int", 0, 0.0, False, None)]
    assert json.loads(points[2].d) == {"count": 3, "sum": 1.5, "bucket_counts": [1, 2], "explicit_bounds": [5.0]}


ACCEPT = {
    "int": [(" 42 ", 42), ("\t42\n", 42), ("\u2003\u00a042\x0b\x0c\r", 42), ("+7", 7), ("-0", 0), (str(2**63 - 1), 2**63 - 1)],
    "uint": [("42", 42), (str(2**64 - 1), 2**64 - 1), ("007", 7)],
    "float": [("1.25", 1.25), ("\n1.5\u3000", 1.5), ("1e3", 1000.0), (".5", 0.5)],
    "boolean": [("t", True), ("\ttrue\n", True), ("0", False), ("True", True)],
}
REJECT = {"int": ["1_0", "2.9", str(2**63), "true", ""], "uint": ["-1", "+7", str(2**64), "1.0"], "float": ["NaN", "Inf", "1e400", "1.5d", ""], "boolean": ["yes", "2", ""], "timestamp": ["2024-04-23", "not-a-time", "2024-04-23T01:23:45", ""], "object": ["{}"], "array": ["[]"]}


@pytest.mark.parametrize("target", sorted(set(ACCEPT) | set(REJECT)))
@pytest.mark.parametrize("source", ["string", "dynamic"])
def test_casts_of_text(spark, source, target):
    texts = [t for t, _ in ACCEPT.get(target, [])] + REJECT.get(target, [])
    column = F.col("t").cast("variant") if source == "dynamic" else F.col("t")
    value = cast(column, source, target)
    found = [r.v for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).select("i", (value.cast("string") if target in ("object", "array") else value).alias("v")).orderBy("i").collect()]
    assert found == [v for _, v in ACCEPT.get(target, [])] + [None] * len(REJECT.get(target, []))


def test_casts_of_numbers_and_times(spark):
    d = lambda x: F.lit(x).cast("double").cast("variant")
    to = lambda v, target: cast(v, "dynamic", target)
    row = spark.range(1).select(to(d(2.0), "int"), to(d(2.9), "int"), to(d(-1.0), "uint"), to(d(float("nan")), "string"), to(F.lit(3).cast("long").cast("variant"), "float"), to(F.lit(1).cast("long").cast("variant"), "boolean"), F.unix_micros(cast(F.lit("2024-04-23T03:23:45+02:00"), "string", "timestamp")), F.unix_micros(cast(F.lit("1713835425123456789"), "string", "timestamp")), to(F.parse_json(F.lit('{"b": 1, "a": [2]}')), "string")).first()
    assert tuple(row) == (2, None, None, None, 3.0, None, 1713835425000000, 1713835425123456, '{"a":[2],"b":1}')


@pytest.mark.parametrize(("value", "text"), [(0.0, "0"), (2.0, "2"), (1.5, "1.5"), (1e6, "1000000"), (123456789.25, "123456789.25"), (1e20, "100000000000000000000"), (1e21, "1e+21"), (1.5e-7, "1.5e-07"), (0.00012, "0.00012"), (-2.5e30, "-2.5e+30"), (-7.0, "-7")])
def test_float_text(spark, value, text):
    assert spark.createDataFrame([(value,)], "d double").select(float_text(F.col("d")).alias("t")).first().t == text


def test_times_as_text(spark):
    times = ["1713835425123456789", "1713835425120000000", "1713835425000000000", "0"]
    rows = flat(spark, "logs", *(log(timeUnixNano=t, severityText=str(i)) for i, t in enumerate(times)))
    valid = mapping.map_signal(rows, {"t": {"source": "log.timestamp", "default": "none", "cast": "string"}, "i": "log.severity_text"}, "logs")[0]
    texts = {r.i: r.t for r in valid.collect()}
    assert texts == {"0": "2024-04-23T01:23:45.123456789Z", "1": "2024-04-23T01:23:45.12Z", "2": "2024-04-23T01:23:45Z", "3": "none"}
    ts = F.timestamp_micros(F.lit(1713835425120000).cast("long"))
    found = spark.range(1).select(cast(ts, "timestamp", "string"), cast(ts.cast("variant"), "dynamic", "string"), cast(F.timestamp_seconds(F.lit(0)), "timestamp", "string")).first()
    assert tuple(found) == ("2024-04-23T01:23:45.12Z", "2024-04-23T01:23:45.12Z", "1970-01-01T00:00:00Z")


def test_first_present_source_decides(spark):
    rows = flat(spark, "logs", log(attributes=[kv("a", stringValue="x"), kv("b", intValue=5)]), log(attributes=[kv("b", intValue=5)]), log(attributes=[kv("a", stringValue="")]))
    valid, rejects = mapping.map_signal(rows, {"n": {"sources": ['log.attributes["a"]', 'log.attributes["b"]'], "default": 9, "cast": "int"}}, "logs")
    assert [r.n for r in valid.collect()] == [5]
    found = {r.request_id: (r.reason, r.column, r.source, r.message) for r in rejects.collect()}
    assert found[0] == ("mapping_cast_failed", "n", 'log.attributes["a"]', 'string value "x" cannot be converted to int')
    assert found[2][3] == 'string value "" cannot be converted to int'


def test_defaults_constants_and_encoding(spark):
    rows = flat(spark, "logs", log(attributes=[kv("d", doubleValue=1.5)]), log(severityText="E"))
    spec = {"c": {"value": [1, {"a": 2}]}, "d": {"source": 'log.attributes["d"]', "default": "none", "cast": "string"}, "when": "log.timestamp", "sev": "log.severity_text"}
    valid = mapping.map_signal(rows, spec, "logs")[0]
    assert [(r.c, r.d, r.when, r.sev) for r in valid.withColumn("c", F.to_json("c")).orderBy("sev").collect()] == [('[1,{"a":2}]', "1.5", None, ""), ('[1,{"a":2}]', "none", None, "E")]


def test_errors_in_a_mapping_come_together():
    bad = {"a": {"source": "span.name", "value": 1}, "b": {"source": "log.none"}, "c": {"source": "log.message", "cast": "money"}, "d": {"value": None}, "e": {"value": 1, "default": 2}, "f": {"source": "log.attributes", "cast": "int"}, "g": 'log.attributes[0]', "h": 'log.message["x"]', "i": {"source": "log.message", "default": "x", "cast": "int"}, "j": "span.name"}
    with pytest.raises(ValueError) as error:
        mapping.compile_mapping(bad, "logs")
    assert all(f"{k}: " in str(error.value) for k in bad)


def test_paths():
    assert parse('log.attributes["a.b"][0]["c\\"d"]') == ("log.attributes", ["a.b", 0, 'c"d'])
    with pytest.raises(ValueError):
        parse("log.attributes[x]")


def test_every_selector_resolves(spark):
    rows = {"logs": flat(spark, "logs", log()), "traces": flat(spark, "traces", {"resourceSpans": []}), "metrics": flat(spark, "metrics", metric(gauge={"dataPoints": [{"asInt": 1}]}))}
    assert sum(len(selectors(s)) for s in rows) == 64 + 2 * 10
    for signal, frame in rows.items():
        frame.select(*(select(s, signal)[0].alias(s.replace(".", "_")) for s in selectors(signal))).schema


def test_content_ids_ignore_batches_and_key_order(spark):
    a = log(attributes=[kv("x", intValue=1), kv("y", doubleValue=2.0)])
    b = log(attributes=[kv("y", doubleValue=2.0), kv("x", intValue=1)])
    both = log(attributes=[kv("x", intValue=1), kv("y", doubleValue=2.0)])
    both["resourceLogs"] *= 2
    ids = identity.with_record_id(flat(spark, "logs", a, b, both, log(attributes=[kv("x", intValue=2)])), "logs")
    assert ids.select("row_id").distinct().count() == 2
    assert [r.copies for r in identity.duplicates(flat(spark, "logs", a, b, both), "logs").collect()] == [4]
    nan = '{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"attributes":[{"key":"d","value":{"doubleValue":"NaN"}}]}]}]}]}'
    assert identity.with_record_id(flat(spark, "logs", nan), "logs").first().row_id is None


def test_capture_and_renest(spark):
    decoded = split_decoded(requests(spark, "logs", log(severityText="a"), log(severityText="b"), log(severityText="c")))[0]
    taken = sampling.capture(decoded, "logs", 2)
    assert [r.item.severityText for r in taken.collect()] == ["a", "b"]
    again = flatten(split_decoded(decode(sampling.renest(taken, "logs"), "logs"))[0], "logs")
    assert sorted(r.status for r in again.collect()) == ["a", "b"]
    assert sampling.probe_ids(again, "service.name").first().probe_id == "api"
    spaced = flat(spark, "logs", *({"resourceLogs": [{"resource": {"attributes": [kv("probe.id", stringValue=v)]}, "scopeLogs": [{"logRecords": [{}]}]}]} for v in ("\t p1\n", "p1", "\u00a0", "")))
    assert [r.probe_id for r in sampling.probe_ids(spaced).collect()] == ["p1"]


def test_samples_of_metrics_count_points(spark):
    points = lambda n: {"dataPoints": [{"asInt": str(i)} for i in range(n)]}
    shaped = {"resourceMetrics": [{"scopeMetrics": [{"metrics": [{"name": "a", "gauge": points(3)}, {"name": "none", "gauge": points(0)}, {"name": "b", "sum": {**points(4), "aggregationTemporality": 2, "isMonotonic": True}}, {"name": "c", "gauge": points(2)}]}]}]}
    decoded = split_decoded(requests(spark, "metrics", shaped, shaped))[0]
    for n, expected in ((2, ["a"] * 2), (5, ["a"] * 3 + ["b"] * 2), (10, ["a"] * 3 + ["b"] * 4 + ["c"] * 2 + ["a"]), (99, (["a"] * 3 + ["b"] * 4 + ["c"] * 2) * 2)):
        taken = sampling.capture(decoded, "metrics", n)
        again = flatten(split_decoded(decode(sampling.renest(taken, "metrics"), "metrics"))[0], "metrics").orderBy("request_id", "item_pos", "point_pos").collect()
        assert [r.metric_name for r in again] == expected
        assert all(r.temporality == "cumulative" and r.is_monotonic for r in again if r.metric_name == "b")
