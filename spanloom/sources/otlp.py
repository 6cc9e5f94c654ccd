"""Requests from files, in batch and as a stream; what can't be decoded goes to rejects with a reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import kept_here, value_parts
from .schema import ENUMS, PARTS, loose_schema, request_schema, snake_keys

BAD = "__bad"
SNAKE = r'"[a-z]++(?:_[a-z]++)++"\s*+:'
#: Attribute values that a typed reader would take for what they are not: the kind, and what follows.
ODD_VALUES = {"intValue": r'(?!"-?[0-9]{1,19}"|-?[0-9]{1,19}\s*+[,}])', "stringValue": '[^"]', "bytesValue": '[^"]'}
ODD = tuple(rf'"{kind}"\s*+:\s*+{value}' for kind, value in ODD_VALUES.items())
#: What a snake-case name and what an odd value can't do without, in forms that a search goes through quickly: these are looked for first.
UNUSUAL = (r'_[a-z]++"\s*+:', 'Value"(?:' + "|".join(rf'(?<="{kind}")\s*+:\s*+{value}' for kind, value in ODD_VALUES.items()) + ")")


def json_names(text: Column, signal: str) -> Column:
    """Requests whose fields are named as in the protocol's definition (``resource_logs``), with JSON's names. Only keys are
    followed by a colon and have no escaped quote, so nothing within texts changes."""
    renamed = text
    for old, new in snake_keys(signal).items():
        renamed = F.regexp_replace(renamed, rf'(?<!\\)"{old}"(?=\s*:)', f'"{new}"')
    return F.when(text.rlike(SNAKE), renamed).otherwise(text)


def number(text: Column, kind: T.DataType) -> Column:
    """A number from its text; a whole one may be written with a fraction of zeros or a power of ten."""
    real = text.try_cast("double")
    if isinstance(kind, T.DoubleType):
        return real
    whole = F.when(text.rlike("^-?[0-9]+$"), text.try_cast(kind))
    return F.coalesce(whole, F.when((real == F.rint(real)) & (F.abs(real) < 2.0**64), real.try_cast("decimal(20,0)").try_cast(kind)))


def typed(c: Column, loose: T.DataType, exact: T.DataType, name: str = "") -> Column:
    """A loosely read value with its exact type; what can't have it is null."""
    if isinstance(loose, T.VariantType) and isinstance(exact, T.StructType):
        return F.when(c.isNotNull(), value_parts(c))
    if isinstance(exact, T.StructType):
        fields = (typed(c[f.name], loose[f.name].dataType, f.dataType, f.name).alias(f.name) for f in exact.fields)
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(exact, T.ArrayType):
        return F.transform(c, lambda x: typed(x, loose.elementType, exact.elementType))
    if loose == exact:
        return c
    if isinstance(exact, T.BooleanType):
        return F.when(c.isin("true", "false"), c == "true")
    if name in ENUMS:
        start, names = ENUMS[name]
        return F.coalesce(*(F.when(c == start + n.upper(), F.lit(i)) for i, n in enumerate(names)), number(c, exact)).cast(exact)
    return number(c, exact)


def decode(texts: DataFrame, signal: str) -> DataFrame:
    """``texts`` (request_id, value) with the request's first level, and ``reject_reason`` where there is none to use.

    ``decode_failed``: not a JSON object of the signal's shape. Empty requests are no failure. Attribute values may be
    nested to any depth; one that isn't well formed is null. Requests that aren't written exactly are read again loosely: numbers
    and truth values may be texts, enums names, and fields named as in the protocol's definition; a field that is of another
    kind is null.
    """
    top = PARTS[signal][0]
    read = lambda c, schema: F.from_json(c, f"{schema}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    broken = lambda c: F.col(c).isNull() | F.col(f"{c}.{BAD}").isNotNull()
    rows = texts.select("request_id", "value", (F.col("value").rlike(UNUSUAL[0]) | F.col("value").rlike(UNUSUAL[1])).alias("unusual"))
    rows = rows.withColumn("text", F.when(F.col("unusual"), json_names(F.col("value"), signal)).otherwise(F.col("value")))
    odd = F.col("unusual") & reduce(lambda a, b: a | b, (F.col("text").rlike(r) for r in ODD))
    rows = rows.withColumn("request", F.when(~odd, read(F.col("text"), request_schema(signal))))
    rows = rows.withColumn("again", F.when(broken("request"), read(F.col("text"), loose_schema(signal))))
    exact, loose = (T.StructType.fromDDL(f(signal))[top].dataType for f in (request_schema, loose_schema))
    resources = F.when(broken("request"), typed(F.col(f"again.{top}"), loose, exact)).otherwise(F.col(f"request.{top}"))
    failed = F.when(broken("request") & broken("again"), "decode_failed")
    return rows.select("request_id", resources.alias("resources"), kept_here(failed, texts.isStreaming).alias("reject_reason"), "value")


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests to flatten (request_id, resources), and rejects (request_id, reject_reason, value)."""
    good = decoded.where("reject_reason is null").select("request_id", "resources")
    return good, decoded.where("reject_reason is not null").select("request_id", "reject_reason", "value")


def read_texts(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One request per line, or per file. Ids tell requests of one reading apart, in the order of partitions and places."""
    rows = spark.read.text(path, wholetext=whole_files)
    return rows.select(F.monotonically_increasing_id().alias("request_id"), "value").where("trim(value) <> ''")


def read_otlp(spark: SparkSession, path: str, signal: str, whole_files: bool = False) -> DataFrame:
    return decode(read_texts(spark, path, whole_files), signal)
