"""Packing, accounting, alerts, plans and streams."""

import json
import random
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from spanloom.operators import ledger, preview, sink, status
from spanloom.plans import contract
from spanloom.streaming import commits, ingest

@pytest.fixture
def attempts(spark):
    tries = {1: "AS", 2: "AF", 3: "rS", 4: "rr", 5: "F", 6: "S"}
    names = {"A": ("ambiguous", False), "S": ("succeeded", False), "F": ("failed", False), "r": ("failed", True)}
    rows = [(b, "logs", "t", i + 1, 60 * b + i, *names[c], 10, f"e{b}") for b, cs in tries.items() for i, c in enumerate(cs)]
    schema = "batch_id long, signal string, table string, attempt int, ts long, outcome string, retryable boolean, records long, error string"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("ts"))


def test_settlement(attempts):
    found = {r.batch_id: r.status for r in ledger.settle(attempts).collect()}
    assert found == {1: "written", 2: "ambiguous", 3: "written", 4: "pending", 5: "permanent_failed", 6: "written"}
    sums = ledger.drops(ledger.settle(attempts, closed=True)).first()
    assert (sums.written, sums.ambiguous, sums.retry_exhausted, sums.permanent_failed, sums.dropped) == (30, 10, 10, 10, 20)
    again = ledger.replays(attempts).first()
    assert (again.replay_attempts, again.replayed_records) == (2, 20)
    assert ledger.last_writes(attempts).first().last_error is None
    assert ledger.last_writes(attempts.where("batch_id < 6")).first().last_error == "e5"
    assert {r.batch_id: r.attempt for r in ledger.last_attempts(attempts).collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1, 6: 1}


def greedy(sizes, max_rows, max_bytes):
    number, n, size, out = 0, 0, 0, []
    for w in sizes:
        if w > max_bytes:
            out.append(None)
            continue
        if n and (n == max_rows or size + w > max_bytes):
            number, n, size = number + 1, 0, 0
        n, size = n + 1, size + w
        out.append(number)
    return out


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_batches_keep_their_limits_and_order(spark, partitions):
    """The same batches whatever the partitions are."""
    rows = [(i % 3, i, 500 if i == 7 else 10 + i % 5) for i in range(300)] + [(None, 1, 5), (7, 1, 5)]
    frame = spark.createDataFrame(rows, "k long, i long, bytes long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    packed = sink.pack_batches(frame, "k", ["i"], "bytes", max_rows=9, max_bytes=100).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for key in (0, 1, 2, 7, None):
        own = sorted((r.i, r.bytes, r.batch) for r in packed if r.k == key)
        assert [b for _, _, b in own] == greedy([w for _, w, _ in own], 9, 100)
    assert len(packed) == len(rows)


def test_alerts_fire_once_a_snapshot(spark):
    """Snapshots that repeat don't multiply, gaps longer than the window are bridged, and windows reach over buckets."""
    schema = "t long, signal string, table string, queue_utilization double, dropped long, ambiguous long, last_success timestamp, destination_verified boolean"
    rows = [(t, "logs", "t", 0.9, 0, 0, None, True) for t in (0, 100, 200, 299, 300)] + [(300, "logs", "t", 0.9, 0, 0, None, True)] * 2
    rows += [(5000, "logs", "t", 0.0, 3, 0, None, True), (9000, "logs", "t", 0.0, 1, 0, None, True), (400, "traces", "t", 0.0, 9, 9, None, False)]
    status_rows = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("t"))
    found = sorted((r.s, r.signal, r.alert) for r in status.alerts(status_rows).select(F.unix_seconds("ts").alias("s"), "signal", "alert").collect())
    assert found == [(300, "logs", "queue_near_capacity")] * 3 + [(5000, "logs", "dropped_telemetry"), (9000, "logs", "dropped_telemetry")]
    late = status_rows.withColumn("ts", F.timestamp_seconds(F.col("t") + 400))
    assert sorted(r.s for r in status.alerts(late).where("alert = 'delivery_stalled'").select(F.unix_seconds("ts").alias("s")).collect()) == [700] * 3
    partners = status.matching(status_rows, status_rows)
    assert partners.count() == len(rows)


def test_counters_alerts_and_states(spark):
    counter = spark.createDataFrame([("a", 60 * i, float(v)) for i, v in enumerate([5, 5, 7, 2, 2])], "s string, t long, value double").withColumn("ts", F.timestamp_seconds("t"))
    assert [r.increase for r in status.increase(counter, ["s"], 120).orderBy("t").collect()] == [0.0, 0.0, 2.0, 4.0, 4.0]
    gauge = spark.createDataFrame([("a", 100 * i, v) for i, v in enumerate([0.9, 0.9, 0.9, 0.9, 0.1, 0.9])], "s string, t long, value double").withColumn("ts", F.timestamp_seconds("t"))
    assert [r.firing for r in status.sustained(gauge, ["s"], F.col("value") > 0.8, 300).orderBy("t").collect()] == [False, False, False, True, False, False]
    states = spark.createDataFrame([("ready",), ("refusing",), ("starting",)], "state string")
    assert status.overall_state(states).first().state == "refusing" and status.overall_state(states.limit(0)).first().state == "starting"


def test_metric_families(spark):
    rows = [("otelcol_receiver_accepted_spans", {"receiver": "otlp"}, 3.0), ("otelcol_receiver_accepted_spans_total", {"receiver": "otlp"}, 50.0), ("otelcol_receiver_accepted_spans", {"receiver": "otlpx"}, 9.0), ("otelcol_receiver_failed_log_records_total", {"receiver": "otlp/a"}, 4.0), ("otelcol_exporter_queue_size", {"exporter": "exporter", "data_type": "logs"}, -2.0)]
    found = {r.signal: (r.received, r.receiver_failed, r.queue_size) for r in status.collector_metrics(spark.createDataFrame(rows, "name string, labels map<string,string>, value double")).collect()}
    assert found == {"traces": (3, 0, 0), "logs": (0, 4, 0)}


def test_plans(spark):
    evidence = spark.createDataFrame([("logs", "t", "a", "int", 0, ""), ("traces", "t", "a", "string", 0, ""), ("logs", "u", "b", "dynamic", 0, "int"), ("logs", "v", "c", "uint", 0, ""), ("logs", "v", "d", "string", 0, ""), ("logs", "w", "e", "string", 0, "")], "signal string, table string, column string, output_type string, errors long, observed_types string")
    columns = spark.createDataFrame([("t", "a", "int"), ("v", "c", "int")], "table string, column string, type string")
    plan = contract.plan_columns(evidence, columns)
    assert {(r.table, r.column): (r.status, r.suggestion) for r in plan.collect()} == {("t", "a"): ("conflict", None), ("u", "b"): ("blocked", "int"), ("v", "c"): ("exists", None), ("v", "d"): ("add", None), ("w", "e"): ("create", None)}
    assert {r.table: r.action for r in contract.plan_tables(plan).collect()} == {"t": "blocked", "u": "blocked", "v": "alter", "w": "create"}


def test_additive_evolution(spark, tmp_path):
    path, columns = str(tmp_path / "t"), spark.createDataFrame([("t", "a", "int")], "table string, column string, type string")
    need = lambda *c: contract.plan_columns(spark.createDataFrame([("logs", "t", n, k, 0, "") for n, k in c], "signal string, table string, column string, output_type string, errors long, observed_types string"), columns)
    contract.evolve_and_append(spark.createDataFrame([(1,)], "a long"), path, need(("a", "int")))
    contract.evolve_and_append(spark.createDataFrame([(2, "x")], "a long, b string"), path, need(("a", "int"), ("b", "string")))
    assert sorted(tuple(r) for r in contract.read_evolved(spark, path).select("a", "b").collect()) == [(1, None), (2, "x")]
    with pytest.raises(ValueError):
        contract.evolve_and_append(spark.createDataFrame([(1,)], "a long"), path, need(("a", "boolean")))


def test_tables_of_the_catalog_evolve(spark):
    columns = spark.createDataFrame([("t", "a", "int")], "table string, column string, type string")
    need = lambda *c: contract.plan_columns(spark.createDataFrame([("logs", "t", n, k, 0, "") for n, k in c], "signal string, table string, column string, output_type string, errors long, observed_types string"), columns)
    assert contract.evolve_table(spark.createDataFrame([(1,)], "a long"), "evolving", need(("a", "int"))) == ["a"]
    add = lambda n, wait=60: contract.evolve_table(spark.createDataFrame([(f"v{n}", n)], f"`b {n}` string, A long"), "evolving", need((f"b {n}", "string")), wait=wait)
    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(add, range(3))) == [["b 0"], ["b 1"], ["b 2"]]
    table = spark.table("evolving")
    assert sorted(table.columns) == ["a", "b 0", "b 1", "b 2"]
    assert sorted(map(str, table.select("a", "b 0", "b 1", "b 2").collect())) == sorted(map(str, spark.createDataFrame([(1, None, None, None), (0, "v0", None, None), (1, None, "v1", None), (2, None, None, "v2")], table.select("a", "b 0", "b 1", "b 2").schema).collect()))
    with pytest.raises(ValueError):
        contract.evolve_table(spark.createDataFrame([("x",)], "a string"), "evolving", need(("a", "int")))
    with pytest.raises(ValueError):
        contract.evolve_table(spark.createDataFrame([(1,)], "a long"), "evolving", need(("a", "boolean")))
    with contract.alone(spark, "evolving", 1), pytest.raises(TimeoutError):
        add(4, 1)
    assert spark.table("evolving").count() == 4
    spark.sql("DROP TABLE evolving")


def test_tied_snapshots_have_one_answer(spark):
    rows = [(t // 3 * 60, float(v)) for t, v in enumerate([5, 1, 3, 2, 8, 8, 0, 4, 9, 9, 1, 2])]
    answers = set()
    for seed in range(3):
        frame = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "t long, value double").select("t", "value", F.timestamp_seconds("t").alias("ts"), F.lit("s").alias("s")).repartition(3)
        answers.add(tuple(sorted((r.t, r.increase) for r in status.increase(frame, ["s"], 60).collect())))
    assert answers == {((0, 4.0),) * 3 + ((60, 12.0),) * 3 + ((120, 17.0),) * 3 + ((180, 18.0),) * 3}


@pytest.mark.parametrize(("observed", "target", "verdict"), [("int", "int", "OK"), ("int", "float", "WARN review type"), ("string", "int", "ERROR sample type"), ("float", "any", "OK")])
def test_verdicts(spark, observed, target, verdict):
    seen = spark.createDataFrame([("c", "dynamic", 3, 3, 0, observed, 0, "x (3)")], "column string, output_type string, total long, present long, errors long, observed_types string, default_count long, selections string")
    agreed = spark.createDataFrame([("c", target, "runtime")], "column string, target_type string, compatibility string")
    report = preview.verdicts(seen, agreed)
    assert report.first().verdict == verdict
    assert preview.quality_gate(report) == (verdict == "OK") and preview.quality_gate(report, strict=False) == (not verdict.startswith("ERROR"))


def test_export_refuses_repeated_names(spark):
    with pytest.raises(ValueError):
        sink.export_json(spark.range(1).select("id", F.col("id").alias("id")))
    assert sink.export_json(spark.sql("select 9007199254740993 as i, double('NaN') as d")).first().value == '{"i":9007199254740993,"d":null}'


def line(text):
    return json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"severityText": text, "attributes": [{"key": "n", "value": {"stringValue": text}}]}]}]}]})


def test_stream_rows_rejects_and_ledger(spark, tmp_path):
    spark.createDataFrame([(line("1"),), (line("x"),), ("{broken",), (line("3"),), (line("3"),)], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    stream, out = ingest.read_otlp_stream(spark, str(tmp_path / "in")), str(tmp_path / "out")
    mapping = {"n": {"source": 'log.attributes["n"]', "cast": "int"}}
    for _ in range(2):  # a restart brings nothing twice
        ingest.stream_to_table(stream, "logs", mapping, out, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert sorted(r.n for r in commits.read_committed(spark, out, "rows").collect()) == [1, 3, 3]
    assert sorted(r.reason for r in commits.read_committed(spark, out, "rejects").collect()) == ["decode_failed", "mapping_cast_failed"]
    assert commits.read_committed(spark, out, "ledger").agg(F.sum("records"), F.sum("rejected")).first() == (3, 2)


@pytest.mark.parametrize("breaks_at", ["rejects", "ledger", "commit"])
def test_a_batch_that_ends_between_its_writes_shows_nothing(spark, tmp_path, monkeypatch, breaks_at):
    texts = spark.createDataFrame([(("f", 0, i), line(t)) for i, t in enumerate(("1", "x"))], "request_id struct<file: string, block: bigint, row: bigint>, value string")
    mapping, out = {"n": {"source": 'log.attributes["n"]', "cast": "int"}}, str(tmp_path / "out")
    stage, commit = commits.stage, commits.commit

    def broken_stage(rows, where, kind, batch):
        if kind == breaks_at:
            raise RuntimeError("lost")
        return stage(rows, where, kind, batch)

    def broken_commit(*given):
        raise RuntimeError("lost")

    ingest.write_batch(texts, 0, "logs", mapping, out)
    monkeypatch.setattr(commits, "stage", broken_stage)
    if breaks_at == "commit":
        monkeypatch.setattr(commits, "commit", broken_commit)
    with pytest.raises(RuntimeError):
        ingest.write_batch(texts, 1, "logs", mapping, out)
    kinds = ("rows", "rejects", "ledger")
    counts = lambda: [commits.read_committed(spark, out, k).count() for k in kinds]
    assert counts() == [1, 1, 1]
    monkeypatch.setattr(commits, "stage", stage)
    monkeypatch.setattr(commits, "commit", commit)
    for _ in range(2):  # tried again, and once more after its commit
        ingest.write_batch(texts, 1, "logs", mapping, out)
    assert counts() == [2, 2, 2]
    folders = {"rows": commits.stage(texts, out, "rows", 1)}
    assert not commits.commit(spark, out, 1, folders)  # another try of a batch that is there
    assert counts() == [2, 2, 2]


def test_bounded_capture_of_a_stream(spark, tmp_path):
    """In the order of the lines, equal lines included; started again, it goes on with what is left."""
    read = lambda: ingest.capture_stream(ingest.read_otlp_stream(spark, str(tmp_path / "in")), "logs", 4, 60, str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True)
    seen = lambda taken: [r.s for r in taken.orderBy("batch", "request_id").select("item.severityText").toDF("s").collect()]
    spark.createDataFrame([(line("b"),), (line("a"),), (line("a"),)], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    assert seen(read()) == ["b", "a", "a"]
    spark.createDataFrame([(line(str(i)),) for i in range(5)], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    taken = read()
    assert seen(taken) == ["b", "a", "a", "0"]
    assert seen(read()) == ["b", "a", "a", "0"]


def test_capture_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(TimeoutError):
        ingest.capture_stream(ingest.read_otlp_stream(spark, str(tmp_path / "in")), "logs", 3, 5, str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_batches_of_items_or_of_time(spark, tmp_path):
    """Full batches at once; what is left when its first item has waited long enough, over a restart of the stream."""
    source = str(tmp_path / "in")
    rows = lambda lo, hi: spark.range(lo, hi).selectExpr("cast(id as string) value").coalesce(1).write.mode("append").text(source)
    items = lambda: spark.readStream.text(source).select((F.col("value").cast("long") % 2).alias("shard"), F.col("value").alias("item"))

    def start(seconds):
        batches = ingest.batch_items(items(), most=20, seconds=seconds)
        return batches.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="1 second").format("parquet").option("path", str(tmp_path / "out")).start()

    def batches():
        return sorted((r.shard, r.batch, r.reason, len(r["items"])) for r in spark.read.schema(ingest.BATCHES).parquet(str(tmp_path / "out")).collect())

    def run_until(n):
        query, ends = start(40), time.monotonic() + 120
        while len(batches()) < n and time.monotonic() < ends:
            query.awaitTermination(1)
        query.awaitTermination(2)  # the micro-batch that wrote ends
        query.stop()

    rows(0, 90)
    run_until(4)
    full = [(s, b, "items", 20) for s in (0, 1) for b in (0, 1)]
    assert batches() == full
    rows(90, 92)  # after the restart, six wait in each shard
    run_until(6)
    assert batches() == sorted([*full, *((s, 2, "time", 6) for s in (0, 1))])
