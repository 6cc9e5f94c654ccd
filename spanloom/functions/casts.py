"""Strict casts: each gives a value and whether the cast failed, and never ends the query.

A null value is absent and doesn't fail. Sources are typed columns or variants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_text, bind, kind_name, kind_of, rfc3339, trimmed

CASTS = ("string", "int", "uint", "float", "boolean", "timestamp", "object", "array", "any")
#: Spark type of each output.
OUTPUT = {"string": "string", "int": "bigint", "uint": "decimal(20,0)", "float": "double", "boolean": "boolean", "timestamp": "timestamp", "object": "variant", "array": "variant", "any": "variant", "dynamic": "variant", "number": "variant"}
MAX_UINT = "18446744073709551615"
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}([.,]\d+)?([Zz]|[+-]\d{2}:\d{2})$"
TRUE, FALSE = ("1", "t", "T", "TRUE", "true", "True"), ("0", "f", "F", "FALSE", "false", "False")
NUMBERS = ("int", "uint", "float")


#: Numbers as texts: underscores may stand between digits (and after 0x); hexadecimal ones need a power of two.
DIGITS, HEX = "[0-9]+(?:_[0-9]+)*", "[0-9a-fA-F]+(?:_[0-9a-fA-F]+)*"
DECIMAL = rf"^[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?$"
HEXADECIMAL = rf"^[+-]?0[xX]_?(?:{HEX}(?:\.(?:{HEX})?)?|\.{HEX})[pP][+-]?{DIGITS}$"


def hexadecimal(t: Column) -> Column:
    """A hexadecimal floating-point text (without underscores) as a double, rounded once: of over 15 digits, the rest only says
    whether anything follows."""
    part = lambda n: F.regexp_extract(t, r"^[+-]?0[xX]([0-9a-fA-F]*)\.?([0-9a-fA-F]*)[pP]([+-]?[0-9]+)$", n)
    digits = F.regexp_replace(F.concat(part(1), part(2)), "^0+", "")
    lead, rest = F.left(digits, F.lit(15)), F.substring(digits, 16, 1 << 30)
    mantissa = F.coalesce(F.conv(lead, 16, 10).try_cast("bigint"), F.lit(0)).bitwiseOR(F.regexp_count(rest, F.lit("[1-9a-fA-F]")).cast("boolean").cast("bigint"))
    power = F.least(F.greatest(part(3).try_cast("bigint"), F.lit(-100_000)), F.lit(100_000)) - 4 * F.length(part(2)) + 4 * F.length(rest)
    half = F.floor(power / 2)  # in two steps: a power beyond a double's own may still give a number in its range
    value = mantissa.cast("double") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    return F.when(mantissa == 0, F.lit(0.0)).otherwise(value) * F.when(t.startswith("-"), -1.0).otherwise(1.0)


def finite(d: Column) -> Column:
    return ~F.isnan(d) & (F.abs(d) != float("inf"))


def float_text(d: Column) -> Column:
    """Shortest digits of a double, as 2, 1.5, 1e+06 or 1e-07: plain from 1e-4 up to below 1e21."""
    return bind(d.cast("string"), written_out)


def written_out(s: Column) -> Column:
    scientific = F.regexp_extract(s, r"^(-?[0-9])\.([0-9]+)E(-?[0-9]+)$", 0) != ""
    lead, rest = F.regexp_extract(s, r"^(-?[0-9])\.", 1), F.regexp_replace(F.regexp_extract(s, r"\.([0-9]+)E", 1), "^0$", "")
    power = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    sign, digits = F.when(s.startswith("-"), "-").otherwise(""), F.concat(F.regexp_replace(lead, "-", ""), rest)
    whole = F.when(power >= F.length(rest), F.concat(sign, F.rpad(digits, power + 1, F.lit("0")))).otherwise(F.concat(sign, digits.substr(F.lit(1), power + 1), F.lit("."), digits.substr(power + 2, F.length(digits))))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), F.greatest(F.lit(0), -power - 1)), digits)
    far = F.concat(lead, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.when(F.abs(power) < 10, F.concat(F.lit("0"), F.abs(power).cast("string"))).otherwise(F.abs(power).cast("string")))
    spread = F.when(power.between(0, 20), whole).when(power.between(-4, -1), small).otherwise(far)
    return F.when(scientific, spread).otherwise(F.regexp_replace(s, r"\.0$", ""))


OPEN = ("dynamic", "number", "any", "object", "array")
FLOATS = ("DOUBLE", "DECIMAL", "FLOAT")


def is_open(source: str) -> bool:
    """Whether values of a declared type are variants."""
    return source in OPEN


def cast(v: Column, source: str, target: str) -> Column:
    """``v``, of declared type ``source``, as type ``target``; null where it is null or the cast fails."""
    if source == target == "float":
        return F.when(finite(v), v)
    if source == target or target == "any":
        return v if is_open(source) or source == target else v.cast("variant")
    if not is_open(source):
        return converted(v, source, target, F.lit(None))
    # what is bound is interpreted: absent values and texts that stay texts, most of what is cast, do without
    value = bind(kind_of(v), lambda kind: converted(v, source, target, kind))
    if target == "string":
        value = F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(value)
    return F.when(v.isNotNull(), value)


def converted(v: Column, source: str, target: str, kind: Column) -> Column:
    def as_type(names: tuple[str, ...], spark_type: str, own: str) -> Column:
        """The value where it is of that kind."""
        if is_open(source):
            return F.when(kind.isin(*names), F.try_variant_get(v, "$", spark_type))
        return v if source == own else F.lit(None).cast(spark_type)

    text, whole, real, flag = as_type(("STRING",), "string", "string"), as_type(("BIGINT",), "bigint", "int"), as_type(FLOATS, "double", "float"), as_type(("BOOLEAN",), "boolean", "boolean")
    natural = as_type(("UINT",), "decimal(20,0)", "uint")
    bare, is_whole = trimmed(text), real == F.rint(real)
    if target == "string":
        stamp = rfc3339(as_type(("TIMESTAMP",), "timestamp", "timestamp"))
        composite = F.when(kind.isin("OBJECT", "ARRAY"), as_text(v)) if is_open(source) else F.lit(None).cast("string")
        return F.coalesce(text, whole.cast("string"), natural.cast("string"), F.when(finite(real), float_text(real)), flag.cast("string"), stamp, composite)
    if target == "int":
        digits = F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("bigint"))
        integral = F.when(is_whole & (real >= -(2.0**63)) & (real < 2.0**63), real.try_cast("bigint"))
        return F.coalesce(whole, natural.try_cast("bigint"), integral, digits)
    if target == "uint":
        digits = F.when(bare.rlike("^[0-9]+$"), F.regexp_replace(bare, "^0+(?=[0-9])", "").try_cast("decimal(20,0)"))
        integral = F.when(is_whole & (real >= 0) & (real < 2.0**64), real.try_cast("decimal(20,0)"))
        return F.coalesce(F.when(whole >= 0, whole).cast("decimal(20,0)"), natural, integral, F.when(digits <= F.lit(MAX_UINT).cast("decimal(20,0)"), digits))
    if target == "float":
        number = bind(bare, lambda t: F.when(t.rlike(DECIMAL), F.replace(t, F.lit("_"), F.lit("")).try_cast("double")).when(t.rlike(HEXADECIMAL), hexadecimal(F.replace(t, F.lit("_"), F.lit("")))))
        return F.coalesce(whole.cast("double"), natural.cast("double"), F.when(finite(real), real), F.when(finite(number), number))
    if target == "boolean":
        return F.coalesce(flag, F.when(bare.isin(*TRUE), True).when(bare.isin(*FALSE), False))
    if target == "timestamp":
        written = F.when(bare.rlike(RFC3339), F.try_to_timestamp(F.regexp_replace(F.upper(bare), ",", ".")))
        nanos = F.coalesce(F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("bigint")), whole, natural.try_cast("bigint"))
        return F.coalesce(written, F.timestamp_micros(F.call_function("div", nanos, F.lit(1000))))
    return F.when(kind == target.upper(), v) if is_open(source) else F.lit(None).cast("variant")  # object, array


def error_text(v: Column, source: str, target: str) -> Column:
    """What a failed cast says: the kind of value, the value (96 characters at most) and the target."""
    if is_open(source):
        shown, kind = F.to_json(v), kind_name(kind_of(v))
    else:
        shown, kind = F.concat(F.lit('"'), v, F.lit('"')) if source == "string" else v.cast("string"), F.lit(source)
    short = F.when(F.length(shown) > 96, F.concat(F.left(shown, F.lit(93)), F.lit("..."))).otherwise(shown)
    return F.concat(kind, F.lit(" value "), short, F.lit(f" cannot be converted to {target}"))
