"""Field inventory of whole tables: which selectors and object keys are filled, how often, with which types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import is_open
from ..functions.values import bind, kind_name, kind_of
from .selectors import select, selectors

#: Selectors that count as filled only when not zero (fixed names).
ZERO_IS_EMPTY = {"resource.dropped_attributes_count", "scope.dropped_attributes_count", "log.severity_number", "log.flags", "log.dropped_attributes_count", "span.flags", "span.dropped_attributes_count", "span.dropped_events_count", "span.dropped_links_count", "datapoint.flags"}
RANK = {"resource": 0, "scope": 1, "log": 2, "span": 2, "metric": 2, "datapoint": 3}


CELLS, TODO, DONE = "array<struct<selector:string,kind:string,value:variant>>", "array<struct<selector:string,parts:map<string,variant>>>", "array<struct<selector:string,type:string>>"


def inspect(records: DataFrame, signal: str, with_record: bool = False) -> DataFrame:
    """One row per filled field: field_group, selector, observed_types (sorted), populated, total, status.

    Empty texts, objects and arrays are not filled. Objects are opened key by key, however deep; arrays stay whole.
    Ordered by group and selector. One pass: every record is opened where it is, and what it holds is counted.
    """
    cells = []
    for s in selectors(signal):
        if s == "record" and not with_record:
            continue
        column, kind = select(s, signal)
        filled = column.isNotNull()
        if kind == "string":
            filled &= column != ""
        if s in ZERO_IS_EMPTY:
            filled &= column != 0
        value = column if is_open(kind) else F.lit(None).cast("variant")
        shown = F.lit(None).cast("string") if kind in ("dynamic", "number") else F.lit(kind)
        cells.append(F.when(filled, F.struct(F.lit(s).alias("selector"), shown.alias("kind"), value.alias("value"))))
    own = F.filter(F.array(*cells), lambda c: c.isNotNull()).cast(CELLS)
    everything = F.concat(F.array(F.struct(F.lit("").alias("selector"), F.lit("record").alias("type"))).cast(DONE), fields(F.col("cells")))
    seen = records.select(own.alias("cells")).select(F.explode(everything).alias("f")).select("f.*")
    counts = seen.groupBy("selector").agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("observed_types"), F.count("*").alias("populated"))
    counts = counts.withColumn("total", F.max(F.when(F.col("selector") == "", F.col("populated"))).over(Window.partitionBy())).where("selector <> ''")  # a row a field
    group = F.regexp_extract("selector", r"^[a-z]+", 0)
    partial, mixed = F.col("populated") < F.col("total"), F.col("observed_types").contains(",")
    status = F.when(partial & mixed, "MIXED, PARTIAL").when(partial, "PARTIAL").when(mixed, "MIXED").otherwise("OK")
    rank = F.coalesce(*(F.when(group == g, F.lit(r)) for g, r in RANK.items()), F.lit(4))
    return counts.select(group.alias("field_group"), "selector", "observed_types", "populated", "total", status.alias("status")).orderBy(rank, "selector")


def opened(selector: Column, value: Column, kind: Column) -> Column:
    """A selector's type, its entries if it is an object, and whether it holds anything; values aren't printed."""
    told = lambda parts, k: F.when(k == "STRING", F.try_variant_get(value, "$", "string") != "").when(k == "OBJECT", F.size(parts) > 0).when(k == "ARRAY", F.size(F.try_variant_get(value, "$", "array<variant>")) > 0)
    cell = lambda parts, k: F.struct(selector.alias("selector"), F.coalesce(kind, kind_name(k)).alias("type"), parts.alias("parts"), F.coalesce(told(parts, k), F.lit(True)).alias("filled"))
    return bind(F.try_variant_get(value, "$", "map<string,variant>"), lambda parts: bind(F.when(parts.isNotNull(), "OBJECT").otherwise(kind_of(value)), lambda k: cell(parts, k)))


def fields(cells: Column) -> Column:
    """Selector and type of each cell and of everything in the objects below: one round for each level that has objects."""
    none = F.lit(None).cast("string")

    def below(c: Column) -> Column:
        there = F.filter(F.map_entries(c["parts"]), lambda e: e["value"].isNotNull() & ~F.is_variant_null(e["value"]))
        name = lambda e: F.concat(c["selector"], F.lit('["'), F.regexp_replace(e["key"], '(["\\\\])', r"\\$1"), F.lit('"]'))
        return F.transform(there, lambda e: opened(name(e), e["value"], none))

    def told(found: Column, done: Column | None = None) -> Column:
        filled = F.filter(found, lambda c: c["filled"])
        todo = F.transform(F.filter(filled, lambda c: c["parts"].isNotNull()), lambda c: F.struct(c["selector"], c["parts"])).cast(TODO)
        types = F.transform(filled, lambda c: F.struct(c["selector"], c["type"])).cast(DONE)
        return F.struct(todo.alias("todo"), (types if done is None else F.concat(done, types)).alias("done"))

    def deeper(state: Column, _: Column) -> Column:
        found = F.flatten(F.transform(state["todo"], below))
        return F.when(F.size(state["todo"]) > 0, bind(found, lambda x: told(x, state["done"]))).otherwise(state)

    start = bind(F.transform(cells, lambda c: opened(c["selector"], c["value"], c["kind"])), lambda x: told(x))
    levels = F.aggregate(cells, F.lit(1), lambda n, c: F.greatest(n, F.coalesce(F.regexp_count(F.schema_of_variant(c["value"]), F.lit("OBJECT<")), F.lit(0))))
    return F.aggregate(F.sequence(F.lit(1), levels), start, deeper)["done"]
