"""Mapped columns against table columns, and additive plans for tables that several signals write to."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mapping import compile_mapping

OPEN_TYPES = ("dynamic", "number")


def describe(spark: SparkSession, mappings: dict[str, dict], tables: dict[str, str]) -> DataFrame:
    """The declared contract: signal, table, column, output_type. One row per column of each signal's mapping."""
    rows = [(signal, tables[signal], r.column, r.output) for signal, m in mappings.items() for r in compile_mapping(m, signal)]
    return spark.createDataFrame(rows, "signal string, table string, column string, output_type string")


def compatibility(output: Column, actual: Column) -> Column:
    """compatible, runtime (only values can tell) or incompatible."""
    fits = (actual == "any") | (output == actual) | ((output == "timestamp") & (actual == "string")) | ((output == "uint") & (actual == "int")) | ((output == "array") & (actual == "object"))
    number = F.when(actual.isin("any"), "compatible").when(actual.isin("int", "float"), "runtime").otherwise("incompatible")
    return F.when(output == "number", number).when((output == "dynamic") & (actual != "any"), "runtime").when(fits, "compatible").otherwise("incompatible")


def validate(contract: DataFrame, columns: DataFrame) -> DataFrame:
    """Each mapped column with target_type and compatibility (missing where the table has no such column).

    ``columns``: table, column, type of the destination's catalog.
    """
    actual = columns.select("table", "column", F.col("type").alias("target_type"))
    state = F.when(F.col("target_type").isNull(), "missing").otherwise(compatibility(F.col("output_type"), F.col("target_type")))
    return contract.join(actual, ["table", "column"], "left").withColumn("compatibility", state)


def plan_columns(evidence: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per table and column: required_type, actual_type, status, observed_types, suggestion, signals.

    ``evidence``: signal, table, column, output_type, errors, observed_types. Status, the first that holds: conflict
    (signals differ in type), blocked (type known at run time only, or errors in the evidence), create (no table),
    add (no column), conflict (the table's type doesn't take it), exists. The suggestion is the one clean type that
    was observed where the type is open.
    """
    known = F.when(~F.col("output_type").isin(*OPEN_TYPES), F.col("output_type"))
    need = evidence.groupBy("table", "column").agg(F.array_sort(F.collect_set(known)).alias("types"), F.bool_or(F.col("output_type").isin(*OPEN_TYPES)).alias("open"), F.sum("errors").alias("errors"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.split("observed_types", ","), lambda k: k != ""))))).alias("observed"), F.array_join(F.array_sort(F.collect_set("signal")), ",").alias("signals"))
    exists = columns.select(F.col("table")).distinct().withColumn("exists", F.lit(True))
    rows = need.join(exists, "table", "left").join(columns.select("table", "column", F.col("type").alias("actual_type")), ["table", "column"], "left")
    required = F.when(~F.col("open") & (F.size("types") == 1), F.get("types", F.lit(0)))
    status = F.when(F.size("types") > 1, "conflict").when(F.col("open") | (F.col("errors") > 0), "blocked").when(F.col("exists").isNull(), "create").when(F.col("actual_type").isNull(), "add").when(compatibility(required, F.col("actual_type")) == "incompatible", "conflict").otherwise("exists")
    suggestion = F.when(F.col("open") & (F.col("errors") == 0) & (F.size("observed") == 1), F.get("observed", F.lit(0)))
    return rows.select("table", "column", required.alias("required_type"), "actual_type", status.alias("status"), F.array_join("observed", ",").alias("observed_types"), suggestion.alias("suggestion"), "signals", F.col("exists").isNotNull().alias("table_exists"))


def plan_tables(plan: DataFrame) -> DataFrame:
    """One row per table: its action: blocked, create, alter or no-op; and how many columns are added."""
    blocked, add = F.bool_or(F.col("status").isin("blocked", "conflict")), F.count_if(F.col("status") == "add")
    action = F.when(blocked, "blocked").when(~F.bool_or("table_exists"), "create").when(add > 0, "alter").otherwise("no-op")
    return plan.groupBy("table").agg(action.alias("action"), F.count("*").alias("n_columns"), add.alias("n_added"))


def refuse_blocked(plan: DataFrame) -> None:
    if not plan_tables(plan).where("action = 'blocked'").isEmpty():
        raise ValueError("the plan has a blocked table; nothing is written")


def evolve_and_append(rows: DataFrame, path: str, plan: DataFrame) -> None:
    """Append rows to the Parquet table at ``path``, new columns included, unless a table of the plan is blocked.

    Columns are only ever added; read the table with ``mergeSchema``.
    """
    refuse_blocked(plan)
    rows.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


@contextmanager
def alone(spark: SparkSession, table: str, wait: float) -> Iterator[None]:
    """One holder a table, by a file in the warehouse that only one can create (as HDFS and object stores with conditional
    puts have it). Whoever doesn't get it within ``wait`` seconds gets a TimeoutError with its name: it also stays where
    its holder was lost, and is then deleted by hand."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{spark.conf.get('spark.sql.warehouse.dir')}/_locks/{table}.lock")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    until = time.monotonic() + wait

    def taken() -> bool:
        try:
            files.create(path, False).close()
        except Py4JJavaError:
            if not files.exists(path) and time.monotonic() >= until:
                raise
            return False
        return True

    while not taken():
        if time.monotonic() >= until:
            raise TimeoutError(f"{path.toString()} is held")
        time.sleep(0.2)
    try:
        yield
    finally:
        files.delete(path, False)


def evolve_table(rows: DataFrame, table: str, plan: DataFrame, path: str | None = None, wait: float = 600) -> list[str]:
    """Append rows to a table of the catalog, made first if there is none (at ``path``, if given), and tell the columns added.

    Columns that the table lacks are added to the catalog's schema, so readers need no look at each file; older rows have
    null there, and so have these rows in columns that they lack. Nothing is written if a table of the plan is blocked or
    a column's type differs from the table's. Writers hold the table one at a time, so that no one's columns or files
    are lost to another.
    """
    refuse_blocked(plan)
    spark = rows.sparkSession
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    with alone(spark, table, wait):
        if not spark.catalog.tableExists(table):
            made = rows.limit(0).write.format("parquet")
            (made.option("path", path) if path else made).saveAsTable(table)
            added = rows.columns
        else:
            spark.catalog.refreshTable(table)
            have = {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema}
            clash = [f.name for f in rows.schema if have.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString()]
            if clash:
                raise ValueError(f"other types than the table's: {', '.join(clash)}; nothing is written")
            new = [f for f in rows.schema if f.name.lower() not in have]
            if new:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{quoted(f.name)} {f.dataType.simpleString()}' for f in new)})")
            added = [f.name for f in new]
        given = {c.lower(): c for c in rows.columns}
        columns = [F.col(quoted(given[f.name.lower()])) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(table).schema]
        rows.select(*columns).write.insertInto(table)
    return added
