"""Work that must not grow faster than the input, and the results of the forms that see to it."""

import datetime
import hashlib
import json
import random
import re
from functools import reduce

from pyspark.sql import functions as F

from spanloom import queries
from spanloom.functions.paths import follow
from spanloom.functions.values import PLAIN, any_value, plain_at_once, plain_scalars
from spanloom.operators import identity, preview, status
from spanloom.operators.flatten import flatten
from spanloom.operators.inspect import inspect
from spanloom.operators.mapping import map_signal
from spanloom.sources import otlp, tables
from spanloom.sources.otlp import decode, split_decoded
from spanloom.sources.schema import PARTS

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def test_windows_over_time_are_running_aggregates_and_keep_every_row(spark):
    pick = random.Random(5)
    rows = [(i, pick.choice("ab"), START + datetime.timedelta(seconds=pick.randrange(400)), pick.choice([None, *map(float, range(50))])) for i in range(300)]
    rows += [(300 + i, "a", None, float(i)) for i in range(3)]
    samples = spark.createDataFrame(rows, "id int, series string, ts timestamp, value double")
    for seconds in (0, 1, 30, 1000):
        got = status.moving_max(samples, ["series"], seconds)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "RangeFrame" in plan and f"RangeFrame, -{seconds}" not in plan  # such a frame goes through all of its rows for each row
        near = lambda a, b: a is b is None or (a is not None and b is not None and 0 <= (a - b).total_seconds() <= seconds)
        expected = {i: max((v for _, s, t, v in rows if s == series and near(ts, t) and v is not None), default=None) for i, series, ts, _ in rows}
        assert {r["id"]: r["max_value"] for r in got.collect()} == expected
        assert set(got.columns) == {*samples.columns, "max_value"}
    gained = status.increase(samples.where("value is not null"), ["series"], 1000)
    total = gained.groupBy("series").agg(F.max("increase").alias("m")).collect()
    assert all(r["m"] > 0 for r in total)


def test_keys_are_read_without_paths_that_end_in_exceptions(spark):
    rows = ['{"a.b":1}', '{"a`b":2}', '{"a\'b":3}', '{"":4}', '{"c":null}', "[5]", "6", None]
    values = spark.createDataFrame([(r,) for r in rows], "t string").select(F.parse_json("t").alias("v"))
    keys = ["a.b", "a`b", "a'b", "", "c"]
    got = values.select(*(F.to_json(follow(F.col("v"), [k])).alias(f"k{n}") for n, k in enumerate(keys)))
    assert [tuple(r) for r in got.collect()] == [tuple(str(n + 1) if n == i and n < 4 else None for n in range(5)) for i in range(len(rows))]
    plan = values.select(follow(F.col("v"), ["a.b"]).alias("x"), any_value(F.col("v")).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert "a.b']" not in plan and "$.intValue" not in plan


TEXTS = ["", "x", 'q"', "a}]}}b", "[{", "\\", "{}", '{"key":1}', '"value":', "\u00e9\n"]


def some_value(pick, depth):
    """An attribute value as a request has it, and as it is."""
    k = pick.randrange(7 if depth else 4)
    if k < 4:
        return [lambda t: ({"stringValue": t}, t), lambda t: ({"intValue": str(len(t))}, len(t)), lambda t: ({"doubleValue": 1.5}, 1.5), lambda t: ({"boolValue": True}, True)][k](pick.choice(TEXTS))
    if k == 4:
        return pick.choice([({}, None), ({"arrayValue": {}}, []), ({"kvlistValue": {"values": []}}, {})])
    parts = [some_value(pick, depth - 1) for _ in range(pick.randrange(4))]
    if k == 5:
        return {"arrayValue": {"values": [p for p, _ in parts]}}, [v for _, v in parts]
    keys = pick.sample(TEXTS, len(parts))
    return {"kvlistValue": {"values": [{"key": key, "value": p} for key, (p, _) in zip(keys, parts)]}}, {key: v for key, (_, v) in zip(keys, parts)}


def request(value):
    return json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"attributes": [{"key": "x", "value": value}]}]}]}]})


def logs(spark, values):
    frame = spark.createDataFrame([(i, request(v)) for i, v in enumerate(values)], "request_id long, value string")
    return flatten(split_decoded(decode(frame, "logs"))[0], "logs")


def test_containers_of_any_depth_are_plain_at_once(spark):
    pick = random.Random(7)
    pairs = [some_value(pick, pick.randrange(7)) for _ in range(400)]
    got = {r.request_id: json.loads(r.a) for r in logs(spark, [p for p, _ in pairs]).select("request_id", F.to_json("attributes").alias("a")).collect()}
    assert got == {i: {"x": v} for i, (_, v) in enumerate(pairs)}
    nested = [p for p, _ in pairs if set(p) & {"arrayValue", "kvlistValue"}]
    texts = spark.createDataFrame([(json.dumps(p, separators=(",", ":"), sort_keys=True),) for p in nested], "t string")
    left = texts.where(~plain_at_once(plain_scalars(F.col("t"))).rlike(PLAIN))
    assert left.count() == 0  # no round by level is left to do


def test_values_written_oddly_are_what_they_were(spark):
    cases = [({"intValue": 1.5}, 1), ({"intValue": "1.5"}, None), ({"intValue": 1e2}, 100), ({"stringValue": 5}, "5"), ({"bytesValue": True}, "true"), ({"boolValue": "true"}, True), ({"doubleValue": "1.5"}, 1.5), (5, None), ([1], None), ({"arrayValue": None}, []), ({"intValue": str(2**63)}, None)]
    cases += [({"kvlistValue": {"values": [1]}}, None), ({"arrayValue": {"values": [{"key": "a", "value": 1}]}}, None), ({"stringValue": None, "intValue": "5"}, 5)]
    got = {r.request_id: json.loads(r.a) for r in logs(spark, [v for v, _ in cases]).select("request_id", F.to_json("attributes").alias("a")).collect()}
    assert got == {i: {"x": want} for i, (_, want) in enumerate(cases)}


def test_records_are_printed_and_inspected_without_objects_of_them(spark):
    values = [{"stringValue": "a"}, {"kvlistValue": {"values": [{"key": "k", "value": {"kvlistValue": {"values": [{"key": "e", "value": {"stringValue": "{}"}}, {"key": "n", "value": {}}]}}}, {"key": "l", "value": {"arrayValue": {}}}]}}, {"stringValue": ""}]
    rows = logs(spark, values)
    shown = {r.id: hashlib.sha256(b"logs\0" + r.body.encode()).hexdigest() for r in rows.select(identity.record_id("logs").alias("id"), F.to_json(identity.record_object("logs")).alias("body")).collect()}
    assert all(k == v for k, v in shown.items()) and len(shown) == 3
    found = {r.selector: (r.observed_types, r.populated) for r in inspect(rows, "logs").collect() if "attributes" in r.selector}
    x = 'log.attributes["x"]'
    assert found == {"log.attributes": ("object", 3), x: ("object,string", 2), f'{x}["k"]': ("object", 1), f'{x}["k"]["e"]': ("string", 1)}
    plan = inspect(rows, "logs")._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json(lambda" not in plan and "to_json(x_" not in plan


def test_first_errors_cast_each_record_once_and_word_only_what_is_left(spark):
    kinds = [{"stringValue": "x"}, {"intValue": "7"}, {"doubleValue": 1.5}, {"stringValue": "8"}, {}]
    rows = logs(spark, [kinds[i % 5] for i in range(40)]).repartition(3)
    x = {"source": 'log.attributes["x"]'}
    mapping = {"whole": x | {"cast": "int"}, "flag": x | {"cast": "boolean"}, "either": {"sources": ['log.attributes["x"]', "log.severity_text"], "cast": "timestamp"}}
    valid, wrong = preview.examples(rows, mapping, "logs", rows=3, errors=20)
    says = {0: 'string value "x"', 1: "int value 7", 2: "float value 1.5", 3: 'string value "8"'}
    fails = {0: ("either", "flag", "whole"), 1: ("flag",), 2: ("either", "flag", "whole"), 3: ("flag",)}
    to = {"either": "timestamp", "flag": "boolean", "whole": "int"}
    # an absent x leaves the empty severity, which is no time
    every = [(i, c, f"{says[i % 5]} cannot be converted to {to[c]}") if i % 5 < 4 else (i, c, 'string value "" cannot be converted to timestamp') for i in range(40) for c in fails.get(i % 5, ("either",))]
    assert [(r.request_id, r["column"], r.message) for r in wrong.collect()] == every[:20]
    assert valid.collect() == []
    only = preview.examples(rows, {"whole": mapping["whole"]}, "logs")[0].collect()
    assert [r.whole for r in only] == [7, 8, None]
    for frame in (valid, wrong):
        plan = frame._jdf.queryExecution().optimizedPlan().toString().split("\n")
        assert not [line for line in plan if "Filter" in line and "lambda" in line]  # no cast in it
    order = next(i for i, line in enumerate(plan) if "Sort [" in line)
    assert {i < order for i, line in enumerate(plan) if "cannot be converted" in line} == {True}


ODD_TEXTS = ["", "plain", 'q"', "a\\b", "line\nend", "\x01", "\x7f", "é中\U0001f600", "{}", "NaN", "/"]


def test_records_of_every_signal_are_printed_as_their_objects(spark):
    pick = random.Random(11)
    word = lambda: pick.choice(ODD_TEXTS)
    kv = lambda: [{"key": word(), "value": some_value(pick, 2)[0]} for _ in range(pick.randrange(3))]
    exemplar = lambda: {"timeUnixNano": "5", "asDouble": 1.5, "filteredAttributes": kv(), "traceId": word()}

    def metric(n):
        point = {"timeUnixNano": "7", "attributes": kv(), "exemplars": [exemplar() for _ in range(pick.randrange(2))]}
        number = pick.choice([{"asInt": str(n)}, {"asDouble": pick.choice([0.1, 1e300, -2.0, 1e-9, "NaN", "Infinity", "-Infinity"])}])
        kinds = {"gauge": {"dataPoints": [point | number]}, "sum": {"dataPoints": [point | number], "isMonotonic": n % 2 == 0}, "histogram": {"dataPoints": [point | {"count": "3", "sum": 0.5, "bucketCounts": ["1", "2"]}], "aggregationTemporality": 2}, "summary": {"dataPoints": [{"count": "3", "quantileValues": [{"quantile": 0.5, "value": 2.0}]}]}}
        kind = pick.choice(sorted(kinds))
        return {"name": word(), "unit": word(), "metadata": kv(), kind: kinds[kind]}

    def span(n):
        events, links = ([{"name": word(), "timeUnixNano": "9", "attributes": kv()} for _ in range(pick.randrange(3))] for _ in range(2))
        times = {"startTimeUnixNano": "5", "endTimeUnixNano": str(n)} if n % 3 else {}
        return {"name": word(), "traceId": word(), "status": {"message": word()}, "attributes": kv(), "events": events, "links": [{"traceState": word(), "spanId": e["name"]} for e in links]} | times

    log = lambda n: {"severityText": word(), "body": some_value(pick, 2)[0], "attributes": kv(), "timeUnixNano": str(n)}
    for signal, (top, scopes, leaf), make in (("logs", PARTS["logs"], log), ("traces", PARTS["traces"], span), ("metrics", PARTS["metrics"], metric)):
        scope = lambda: pick.choice([{}, {"name": word(), "version": word(), "attributes": kv()}])
        texts = [json.dumps({top: [{"resource": {"attributes": kv()}, "schemaUrl": word(), scopes: [{"scope": scope(), leaf: [make(n)]}]}]}) for n in range(150)]
        rows = flatten(split_decoded(decode(spark.createDataFrame(list(enumerate(texts)), "request_id long, value string"), signal))[0], signal)
        shown = identity.with_record_id(rows, signal).select("row_id", identity.record_json(signal).alias("put"), F.to_json(identity.record_object(signal)).alias("printed")).collect()
        assert len(shown) == 150 and [r.put for r in shown] == [r.printed for r in shown]
        assert all(r.row_id in (None, hashlib.sha256(f"{signal}\0{r.printed}".encode()).hexdigest()) for r in shown)
        bare = [r.row_id is None for r in shown]
        assert any(bare) == (signal == "metrics") and not all(bare)


def test_ids_of_spans_are_compiled_and_requests_gathered_as_joined(spark):
    sf = "/root/testdata/sf0.001"
    plan = queries.all_selectors(spark, sf, "traces")._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE(__record_json" in plan.split("\n")[0]  # of a column, which is compiled: what is bound is interpreted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = tables.trace_requests(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" in made and "ObjectHashAggregate" not in made and "collect_list(struct(" not in made


def test_unusual_requests_are_told_by_one_look(spark):
    pieces = ['"resource_logs":', '"a_b" :', '"key":"a_b"', '"intValue": 1.5', '"intValue":1.5', '"intValue": "12"', '"intValue":12}', '"stringValue" : 5', '"stringValue":"x"', '"bytesValue": true', '"doubleValue": 5', 'a_b\\":', '"A_b":', '"xintValue": {}']
    texts = spark.createDataFrame([(a + "," + b,) for a in pieces for b in pieces], "t string")
    found = lambda patterns: reduce(lambda x, y: x | y, (F.col("t").rlike(p) for p in patterns))
    assert texts.where(found((otlp.SNAKE, *otlp.ODD)) & ~found(otlp.UNUSUAL)).count() == 0
    assert texts.where(~found(otlp.UNUSUAL)).count() > 20


def test_a_mapping_opens_each_object_once_and_absent_values_are_not_cast(spark):
    values = [{"stringValue": "x"}, {"intValue": "7"}, {"doubleValue": 1e21}, {"boolValue": True}, {"kvlistValue": {"values": [{"key": "in", "value": {"stringValue": "y"}}]}}, {"arrayValue": {"values": [{"intValue": "1"}]}}, {}]
    rows = logs(spark, values)
    to = {"x": ['log.attributes["x"]'], "inner": ['log.attributes["x"]["in"]'], "first": ['log.attributes["x"][0]'], "upper": ['log.attributes["X"]'], "y": ['log.attributes["y"]', 'log.attributes["x"]']}
    mapping = {name: {"sources": sources, "cast": "string"} for name, sources in to.items()} | {"whole": {"source": 'log.attributes["x"]', "cast": "any"}, "record": "record", "id": "record.id"}
    valid, wrong = map_signal(rows, mapping, "logs")
    shown = ["x", "7", "1e+21", "true", '{"in":"y"}', "[1]", None]
    assert [(r.x, r.y, r.inner, r["first"], r.upper) for r in valid.collect()] == [(x, x, "y" if x and "in" in x else None, "1" if x == "[1]" else None, None) for x in shown]
    assert wrong.count() == 0
    assert valid.select("id").collect() == rows.select(identity.record_id("logs").alias("id")).collect()
    mapping = {f"c{n}": {"source": f'log.attributes["{k}"]', "cast": "string"} for n, k in enumerate(("a", "b", "c.d"))}
    plan = map_signal(rows, mapping, "logs")[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(a,VariantType") == plan.count("StructField(a,VariantType,true), StructField(b,VariantType,true), StructField(c.d,VariantType,true)") == 1
    assert "isnotnull(__s0#" in plan  # before what is bound
