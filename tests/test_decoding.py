"""Decoding of odd values: wide, deep, not finite, unsigned and loosely written ones."""

import json
import time

import pytest
from pyspark.sql import functions as F

from spanloom.functions import casts, values
from spanloom.operators import identity
from spanloom.operators.flatten import flatten
from spanloom.operators.mapping import compile_mapping, map_signal
from spanloom.sources.otlp import decode, split_decoded

TEXT, REAL, INT = (lambda kind: lambda v: {kind: v})("stringValue"), (lambda kind: lambda v: {kind: v})("doubleValue"), (lambda kind: lambda v: {kind: v})("intValue")


def listed(*v):
    return {"arrayValue": {"values": list(v)}}


def entries(**attributes):
    return [{"key": k, "value": v} for k, v in attributes.items()]


def keyed(**attributes):
    return {"kvlistValue": {"values": entries(**attributes)}}


def log(**attributes):
    return json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"attributes": entries(**attributes)}]}]}]})


def logs(spark, *requests):
    frame = spark.createDataFrame(list(enumerate(requests)), "request_id long, value string")
    return flatten(split_decoded(decode(frame, "logs"))[0], "logs")


def test_numbers_that_are_none_and_texts_that_read_so(spark):
    cases = [
        (TEXT("NaN"), False), (REAL("NaN"), True), (listed(TEXT("NaN")), False), (listed(REAL("NaN"), TEXT("a"), INT("1")), True),
        (keyed(a=REAL("-Infinity"), b=TEXT('":"NaN"}')), True), (keyed(a=keyed(b=TEXT('x":"Infinity","y'), c=listed(TEXT("Infinity")))), False),
        (listed(listed(listed(REAL("Infinity")), REAL(1.5)), {}), True), (REAL(1.5), False), (listed(), False), ({}, False),
    ]
    rows = logs(spark, *(log(x=v) for v, _ in cases))
    found = rows.select("request_id", values.holds_non_finite(F.try_variant_get("attributes", "$.x", "variant")).alias("odd"), identity.record_id("logs").isNull().alias("no_id")).collect()
    assert {r.request_id: (r.odd, r.no_id) for r in found} == {i: (odd, odd) for i, (_, odd) in enumerate(cases)}
    valid, rejects = map_signal(rows, {"x": 'log.attributes["x"]'}, "logs")
    assert (valid.count(), rejects.where("reason = 'mapping_encoding_failed'").count()) == (sum(not o for _, o in cases), sum(o for _, o in cases))


def test_one_value_of_a_hundred_thousand_objects(spark):
    n = 100_000
    began = time.monotonic()
    text = logs(spark, log(x=listed(*(keyed(a=TEXT(str(i)), b=INT(str(i))) for i in range(n))))).select(F.to_json("attributes").alias("t")).first().t
    assert time.monotonic() - began < 60
    assert json.loads(text) == {"x": [{"a": str(i), "b": i} for i in range(n)]}


def test_depth_is_counted_outside_of_strings(spark):
    cases = {"{}": 1, '{"a":[{"b":"]]]}}{{{\\"[["}]}': 3, "[1,[2],[[3]]]": 3, '"{"': 0}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", values.depth(F.col("t")).alias("d"))
    assert {r.t: r.d for r in rows.collect()} == cases


@pytest.mark.parametrize("kind, value, want", [("kind", 3, "client"), ("kind", "3", "client"), ("kind", "SPAN_KIND_CLIENT", "client"), ("kind", "SPAN_KIND_NONE", "unspecified"), ("kind", [1], "unspecified"), ("flags", "1e2", 100), ("flags", "7.0", 7), ("flags", 7.5, 0), ("flags", True, 0)])
def test_one_odd_field_costs_no_request(spark, kind, value, want):
    request = json.dumps({"resourceSpans": [{"scopeSpans": [{"spans": [{"name": "first"}, {"name": "odd", kind: value}]}]}]})
    frame = spark.createDataFrame([(0, request)], "request_id long, value string")
    assert {r.name: r[kind] for r in flatten(split_decoded(decode(frame, "traces"))[0], "traces").collect()} == {"first": 0 if kind == "flags" else "unspecified", "odd": want}


def test_names_of_the_definition_are_read_but_not_in_texts(spark):
    request = json.dumps({"resource_logs": [{"scope_logs": [{"log_records": [{"severity_text": "s", "attributes": [{"key": "trace_id", "value": {"string_value": '"trace_id": "x", resource_logs'}}]}]}]}]})
    row = logs(spark, request).select("status", F.to_json("attributes").alias("a")).first()
    assert (row.status, json.loads(row.a)) == ("s", {"trace_id": '"trace_id": "x", resource_logs'})


def test_floating_point_texts(spark):
    texts = ["0x1p4", "0X1.8P1", "0x.8p-1", "-0x1p-1074", "0x1fffffffffffffffp0", "0x8000000000000801p0", "0x1_0p0", "1_0.5", "1__0", "_1", "0x1", "0xp1", "0x1p99999", "1e400", "-.5", "5."]

    def by_python(t):
        if "__" in t or t[0] == "_":
            return None
        try:
            bare = t.replace("_", "")
            x = float.fromhex(bare) if "x" in bare.lower() and "p" in bare.lower() else float(bare)
        except (ValueError, OverflowError):
            return None
        return x if abs(x) < float("inf") else None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", casts.cast(F.col("t"), "string", "float").alias("x"))
    assert {r.t: r.x for r in rows.collect()} == {t: by_python(t) for t in texts}
    for t in texts:  # literals are checked alike
        if by_python(t) is None:
            with pytest.raises(ValueError):
                compile_mapping({"c": {"value": t, "cast": "float"}}, "logs")
        else:
            compile_mapping({"c": {"value": t, "cast": "float"}}, "logs")


def test_whole_floats_beyond_63_bits(spark):
    rows = spark.createDataFrame([(x,) for x in (1e19, 2.0**64, -1.0, 9.3e18, 0.5, float("nan"))], "x double")
    got = [(r.u, r.i) for r in rows.select(casts.cast(F.col("x"), "float", "uint").alias("u"), casts.cast(F.col("x"), "float", "int").alias("i")).collect()]
    assert [(None if u is None else int(u), i) for u, i in got] == [(10**19, None), (None, None), (None, -1), (int(9.3e18), None), (None, None), (None, None)]


def test_long_spans_wrap(spark):
    most = 2**64 - 1
    spans = [{"name": str(i), "startTimeUnixNano": str(a), "endTimeUnixNano": str(b)} for i, (a, b) in enumerate(((1, most), (most, most), (5, 4), (1, 2**63), (1, 2**63 + 1), (0, 5)))]
    frame = spark.createDataFrame([(0, json.dumps({"resourceSpans": [{"scopeSpans": [{"spans": spans}]}]}))], "request_id long, value string")
    assert {r.name: r.duration_ns for r in flatten(split_decoded(decode(frame, "traces"))[0], "traces").collect()} == {"0": -2, "1": 0, "2": None, "3": 2**63 - 1, "4": -(2**63), "5": None}
