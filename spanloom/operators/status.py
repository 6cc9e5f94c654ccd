"""Ingestion status from metric samples and runtime counters, and alerts over its history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNITS = {"logs": "log_records", "traces": "spans", "metrics": "metric_points"}
PRIORITY = {"starting": 0, "ready": 1, "degraded": 2, "refusing": 3}


def of_component(label: str, name: str) -> Column:
    """A component's own label, or one of its named instances."""
    value = F.coalesce(F.try_element_at("labels", F.lit(label)), F.lit(""))
    return (value == name) | value.startswith(f"{name}/")


def collector_metrics(samples: DataFrame, receiver: str = "otlp", exporter: str = "exporter") -> DataFrame:
    """Per signal: received, failed, refused, queue_size, queue_capacity, each a sum of its family's samples, 0 at least.

    ``samples``: name, labels (map), value. Where both a family and its ``_total`` occur, only the plain one counts.
    """
    signals = F.coalesce(*(F.when(F.regexp_replace("name", "_total$", "").endswith(u), F.lit(s)) for s, u in UNITS.items()), F.try_element_at("labels", F.lit("data_type")))
    family = F.regexp_replace("name", "_total$", "")
    base = F.regexp_replace(F.regexp_replace(family, "^otelcol_", ""), "_(log_records|spans|metric_points)$", "")
    of_receiver = base.isin("receiver_accepted", "receiver_failed", "receiver_refused") & of_component("receiver", receiver)
    of_queue = base.isin("exporter_queue_size", "exporter_queue_capacity") & of_component("exporter", exporter)
    named = samples.select(family.alias("family"), F.col("name").endswith("_total").alias("suffixed"), base.alias("base"), signals.alias("signal"), (of_receiver | of_queue).alias("counts"), "value")
    sums = named.groupBy("signal", "base").agg(F.sum(F.when(~F.col("suffixed") & F.col("counts"), F.col("value"))).alias("plain"), F.bool_or(~F.col("suffixed")).alias("has_plain"), F.sum(F.when(F.col("suffixed") & F.col("counts"), F.col("value"))).alias("total"))
    value = F.greatest(F.lit(0.0), F.coalesce(F.when(F.col("has_plain"), F.col("plain")).otherwise(F.col("total")), F.lit(0.0)))
    columns = {"received": "receiver_accepted", "receiver_failed": "receiver_failed", "receiver_refused": "receiver_refused", "queue_size": "exporter_queue_size", "queue_capacity": "exporter_queue_capacity"}
    return sums.where("signal is not null").groupBy("signal").agg(*(F.coalesce(F.max(F.when(F.col("base") == b, value)), F.lit(0.0)).cast("long").alias(n) for n, b in columns.items()))


def signal_state(available: Column) -> Column:
    """State of a signal: what comes first holds."""
    full = F.col("queue_enabled") & (F.col("queue_capacity") > 0) & (F.col("queue_size") >= F.col("queue_capacity"))
    failing = F.col("last_failure").isNotNull() & (F.col("last_success").isNull() | (F.col("last_failure") > F.col("last_success")))
    waiting = F.when(F.coalesce(F.col("last_error"), F.lit("")) != "", "degraded").otherwise("starting")
    return F.when(~F.col("ready"), waiting).when(~available, "degraded").when(F.coalesce(full, F.lit(False)), "refusing").when(failing | ~F.col("destination_verified"), "degraded").otherwise("ready")


def ingestion_status(runtime: DataFrame, metrics: DataFrame) -> DataFrame:
    """Runtime counters with their signal's metrics (0 and unobserved where there are none), and the state."""
    observed = metrics.withColumnRenamed("queue_capacity", "observed_capacity").withColumn("queue_observed", F.lit(True))
    rows = runtime.join(observed, "signal", "left")
    capacity = F.coalesce(F.when(F.col("observed_capacity") > 0, F.col("observed_capacity")), F.col("configured_capacity"))
    rows = rows.withColumn("queue_capacity", F.coalesce("observed_capacity", F.lit(0))).withColumn("queue_observed", F.coalesce("queue_observed", F.lit(False)))
    rows = rows.withColumn("state", signal_state(F.col("queue_observed")))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("received", "receiver_failed", "receiver_refused", "queue_size")]
    kept = [c for c in runtime.columns if c != "configured_capacity"]
    return rows.select(*kept, *zero, capacity.alias("queue_capacity"), "queue_observed", "state")


def overall_state(status: DataFrame) -> DataFrame:
    """The state of highest priority, starting if there is none."""
    rank = F.coalesce(*(F.when(F.col("state") == s, F.lit(p)) for s, p in PRIORITY.items()), F.lit(0))
    return status.agg(F.coalesce(F.max_by("state", rank), F.lit("starting")).alias("state"))


def to_samples(status: DataFrame) -> DataFrame:
    """Long samples of status rows: ts, name, labels, value; what is null gives none."""
    labels = {"signal": F.col("signal"), "table": F.col("table")}

    def sample(name: str, value: Column, **more: str) -> Column:
        pairs = [x for k, v in {**labels, **{k: F.lit(v) for k, v in more.items()}}.items() for x in (F.lit(k), v)]
        return F.struct(F.lit(f"ingestion_{name}").alias("name"), F.create_map(*pairs).alias("labels"), value.cast("double").alias("value"))

    rows = [sample(f"{n}_total", F.col(n)) for n in ("received", "written", "ambiguous")]
    rows += [sample("dropped_total", F.col(r), reason=r) for r in ("retry_exhausted", "enqueue_failed", "permanent_failed")]
    rows.append(sample("queue_utilization", F.when(F.col("queue_enabled") & (F.col("queue_capacity") > 0), F.col("queue_size") / F.col("queue_capacity"))))
    rows.append(sample("last_success_timestamp_seconds", F.coalesce(F.unix_micros("last_success") / F.lit(1e6), F.lit(0.0))))
    rows.append(sample("destination_verified", F.col("destination_verified").cast("int")))
    return status.select("ts", F.explode(F.array(*rows)).alias("s")).select("ts", "s.*").where("value is not null")


T, BUCKET, OWN = "__t", "__bucket", "__own"


def in_buckets(rows: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """``rows`` with their second, and the time bucket of ``seconds`` that it is in. A series is as many groups as it has buckets."""
    timed = rows.withColumn(T, F.unix_seconds("ts"))
    return timed.withColumn(BUCKET, F.floor(F.col(T) / max(1, seconds)))


def carried(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``rows`` in buckets with ``__first``, the first second of their series, and ``__before_<value>``, the value of the
    sample before in the series (null for the first). Samples of one second are in the order of their times, and then
    of these values: rows that still tie have equal values, so the result is one.

    Within a bucket by lag; across buckets by one row a bucket, so that no task holds the samples of a whole series.
    """
    ends = rows.groupBy(*keys, BUCKET).agg(F.min(T).alias("__low"), *(F.max_by(v, F.struct("ts", *values)).alias(f"__last_{v}") for v in values))
    line = Window.partitionBy(*keys).orderBy(BUCKET)
    ends = ends.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(BUCKET).alias("__b"), F.min("__low").over(line).alias("__first"), *(F.lag(f"__last_{v}").over(line).alias(f"__old_{v}") for v in values))
    same = F.col(BUCKET) == F.col("__b")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    w = Window.partitionBy(*keys, BUCKET).orderBy("ts", *values)
    joined = rows.join(ends, same).drop("__b", *(f"__k{i}" for i in range(len(keys))))
    return joined.withColumns({f"__before_{v}": F.coalesce(F.lag(v).over(w), F.col(f"__old_{v}")) for v in values}).drop(*(f"__old_{v}" for v in values))


#: Aggregates over time: what makes each of values, and what makes one of two, where either may be missing.
OVER_TIME = {"max": (F.max, F.greatest), "min": (F.min, F.least), "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b))}


def over_time(rows: DataFrame, keys: list[str], seconds: int, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` in buckets with aggregates (name: kind and column) over the last ``seconds`` up to each.

    A window is the start of its bucket up to the row, and the end of the bucket before from ``seconds`` earlier on. Every row
    also goes to the bucket after its own, ``seconds`` later, and is there for the rows up to then. So both parts are running
    aggregates, one forwards and one backwards, and the work doesn't follow the number of rows in a window.
    """
    values = {c for _, c in columns.values()}
    copies = rows.withColumn("__copy", F.explode(F.when(F.col(T).isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    copies = copies.withColumns({"__to": F.col(BUCKET) + F.col("__copy").cast("int"), "__at": F.col(T) + F.when(F.col("__copy"), seconds).otherwise(0)})
    copies = copies.withColumns({n: F.when(~F.col("__copy"), F.col(f"`{n}`")) for n in rows.columns if n not in (*keys, *values)})
    part = Window.partitionBy(*keys, "__to")
    forth, back = (part.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow) for order in (F.col("__at"), F.desc("__at")))
    parts = {}
    for name, (kind, c) in columns.items():
        parts[f"__forth_{name}"] = OVER_TIME[kind][0](F.when(~F.col("__copy"), F.col(c))).over(forth)
        parts[f"__back_{name}"] = OVER_TIME[kind][0](F.when(F.col("__copy"), F.col(c))).over(back)
    done = copies.withColumns(parts).where(~F.col("__copy"))
    whole = {name: OVER_TIME[kind][1](F.col(f"__forth_{name}"), F.col(f"__back_{name}")) for name, (kind, _) in columns.items()}
    return done.withColumns(whole).drop("__copy", "__to", "__at", *parts)


def plain(rows: DataFrame) -> DataFrame:
    """Without the columns of the work."""
    return rows.drop(*(c for c in rows.columns if c.startswith("__")))


def gain(value: str) -> Column:
    """What a counter gained since the sample before; a fall is a restart from 0."""
    before, now = F.col(f"__before_{value}"), F.col(value)
    return F.when(before.isNull(), F.lit(0.0)).when(now < before, now).otherwise(now - before)


def moving_max(samples: DataFrame, keys: list[str], seconds: int = 86_400) -> DataFrame:
    """Greatest value of each series over the time up to each sample."""
    return plain(over_time(in_buckets(samples, keys, seconds), keys, seconds, {"max_value": ("max", "value")}))


def aged(seconds: int) -> Column:
    """Whether a series is as old as the window."""
    return F.col(T) - F.col("__first") >= seconds


def sustained(samples: DataFrame, keys: list[str], condition: Column, seconds: int = 300) -> DataFrame:
    """``samples`` with firing: the condition has held at every sample of the last ``seconds``, and the series is as old."""
    rows = carried(in_buckets(samples.withColumn("__holds", condition.cast("int")), keys, seconds), keys, [])
    held = over_time(rows, keys, seconds, {"__held": ("min", "__holds")})
    return plain(held.withColumn("firing", F.coalesce((F.col("__held") == 1) & aged(seconds), F.lit(False))))


def increase(samples: DataFrame, keys: list[str], seconds: int = 300) -> DataFrame:
    """``samples`` with increase: what a counter gained over the last ``seconds``; a fall is a restart from 0.

    Gains between samples inside the window count; nothing is extrapolated to its ends.
    """
    rows = carried(in_buckets(samples, keys, seconds), keys, ["value"]).withColumn("__gain", gain("value"))
    return plain(over_time(rows, keys, seconds, {"increase": ("sum", "__gain")}))


def matching(left: DataFrame, right: DataFrame) -> DataFrame:
    """Samples that have a partner of the same signal, table and time; each once, however many partners it has."""
    return left.join(right.select("signal", "table", "ts"), ["signal", "table", "ts"], "left_semi")


def alerts(status: DataFrame, seconds: int = 300) -> DataFrame:
    """One row per snapshot and alert that fires: ts, signal, table, alert.

    ``status``: ts, signal, table, queue_utilization, dropped, ambiguous, last_success, destination_verified. All five
    come from one pass over the history. Two alerts ask whether anything was queued: at the same time, signal and
    table, in any of several snapshots.
    """
    keys = ["signal", "table"]
    rows = carried(in_buckets(status, keys, seconds), keys, ["dropped", "ambiguous"])
    queued = F.coalesce(F.max(F.col("queue_utilization") > 0).over(Window.partitionBy(*keys, BUCKET, "ts")), F.lit(False))
    stale = F.col(T) - F.coalesce(F.unix_seconds("last_success"), F.lit(0)) > seconds
    rows = rows.withColumns({"__queued": queued, "__gain_dropped": gain("dropped"), "__gain_ambiguous": gain("ambiguous")})
    held = {"__near": F.coalesce(F.col("queue_utilization") > 0.8, F.lit(False)), "__stalled": F.col("__queued") & stale, "__unverified": F.col("__queued") & ~F.col("destination_verified")}
    rows = rows.withColumns({n: c.cast("int") for n, c in held.items()})
    rows = over_time(rows, keys, seconds, {**{n: ("min", n) for n in held}, "__dropped": ("sum", "__gain_dropped"), "__ambiguous": ("sum", "__gain_ambiguous")})
    holds = lambda n: (F.col(n) == 1) & aged(seconds)
    fires = {"queue_near_capacity": holds("__near"), "dropped_telemetry": F.col("__dropped") > 0, "ambiguous_delivery": F.col("__ambiguous") > 0, "delivery_stalled": holds("__stalled"), "destination_unverified": holds("__unverified")}
    found = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in fires.items())), lambda a: a.isNotNull())
    return rows.select("ts", *keys, F.explode(found).alias("alert"))
