"""Bounded samples of records, their re-nesting to requests, and probe ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import trimmed
from ..sources.schema import PARTS
from .flatten import TYPES

#: The place of each item in a batch.
ORDER = ["request_id", "resource_pos", "scope_pos", "item_pos"]


def explode_items(requests: DataFrame, signal: str) -> DataFrame:
    """Raw items with their raw context, one row each (metrics: one row per metric), in no order."""
    _, scopes, leaf = PARTS[signal]
    rows = requests.select("request_id", F.posexplode("resources").alias("resource_pos", "r"))
    rows = rows.select("request_id", "resource_pos", "r.resource", F.col("r.schemaUrl").alias("resource_url"), F.posexplode(f"r.{scopes}").alias("scope_pos", "s"))
    return rows.select("request_id", "resource_pos", "resource", "resource_url", "scope_pos", "s.scope", F.col("s.schemaUrl").alias("scope_url"), F.posexplode(f"s.{leaf}").alias("item_pos", "item"))


def capture(requests: DataFrame, signal: str, n: int) -> DataFrame:
    """Exactly the first ``n`` records in order, with their context; the bound is the feature.

    Records of metrics are points: a metric is cut to the points that fit, and one without points is left out.
    """
    items = explode_items(requests, signal)
    if signal != "metrics":
        return items.orderBy(*ORDER).limit(n)
    sizes = items.select(*ORDER, points_of(F.col("item")).alias("points")).where("points > 0")
    first = sizes.orderBy(*ORDER).limit(n)  # n metrics hold n points at least
    before = F.coalesce(F.sum("points").over(Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = first.withColumn("room", F.lit(n) - before).where("room > 0").drop("points")
    fields = {f: F.col(f"item.{f}") for f in items.schema["item"].dataType.names}
    for f in TYPES:
        points = F.slice(fields[f]["dataPoints"], F.lit(1), F.col("room").cast("int"))
        fields[f] = F.when(fields[f].isNotNull(), fields[f].withField("dataPoints", points))
    return items.join(F.broadcast(room), ORDER).withColumn("item", F.struct(*(c.alias(f) for f, c in fields.items()))).drop("room").orderBy(*ORDER)  # n narrow rows at most


def points_of(metric: Column) -> Column:
    """How many points a metric has."""
    return sum((F.coalesce(F.size(metric[f]["dataPoints"]), F.lit(0)) for f in TYPES), F.lit(0))


def renest(items: DataFrame, signal: str) -> DataFrame:
    """Requests again (request_id, value as JSON text) from raw items; groups are those of one request's scope."""
    top, scopes, leaf = PARTS[signal]
    by_scope = items.groupBy("request_id", "resource_pos", "scope_pos").agg(F.first("resource").alias("resource"), F.first("resource_url").alias("resource_url"), F.first("scope").alias("scope"), F.first("scope_url").alias("scope_url"), F.collect_list(F.struct("item_pos", "item")).alias("items"))
    ordered = lambda c, key: F.array_sort(c, lambda a, b: a[key] - b[key])
    scope = F.struct("scope", F.col("scope_url").alias("schemaUrl"), F.transform(ordered("items", "item_pos"), lambda x: x["item"]).alias(leaf))
    by_resource = by_scope.select("request_id", "resource_pos", "resource", "resource_url", F.struct("scope_pos", scope.alias("v")).alias("s")).groupBy("request_id", "resource_pos").agg(F.first("resource").alias("resource"), F.first("resource_url").alias("resource_url"), F.collect_list("s").alias("scopes"))
    resource = F.struct("resource", F.col("resource_url").alias("schemaUrl"), F.transform(ordered("scopes", "scope_pos"), lambda x: x["v"]).alias(scopes))
    whole = by_resource.select("request_id", F.struct("resource_pos", resource.alias("v")).alias("r")).groupBy("request_id").agg(F.collect_list("r").alias("resources"))
    return whole.select("request_id", F.to_json(F.struct(F.transform(ordered("resources", "resource_pos"), lambda x: x["v"]).alias(top))).alias("value"))


def probe_ids(records: DataFrame, key: str = "probe.id") -> DataFrame:
    """Distinct, trimmed, non-blank values of a resource attribute."""
    value = trimmed(F.try_variant_get("resource", f"$['{key}']", "string"))
    return records.select(value.alias("probe_id")).where("probe_id <> ''").distinct()
