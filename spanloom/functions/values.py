"""Attribute values, maps, times and texts of telemetry, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that is trimmed from texts (fixed: Unicode's White_Space characters).
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    """A text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def present(v: Column) -> Column:
    """A variant null is an absent value."""
    return F.when(~F.is_variant_null(v), v)


def kept_here(c: Column, streaming: bool = False) -> Column:
    """The same value, computed where it stands: a filter on it is not moved below, which would write the expressions
    that it is made of, decoding included, out again for every use. Streams know no row ids; plans with a random number take
    longer to make, so only streams have it."""
    return F.when((F.rand() if streaming else F.monotonically_increasing_id()) >= 0, c)


def bind(c: Column, f) -> Column:
    """``f`` of a column that is evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def member(v: Column, key: str, kind: str = "variant") -> Column:
    """The value of a variant object's key as a type; null where there is none. Read through a struct: a path that isn't there
    ends in an exception inside, which costs more than the whole object."""
    return members(v, [key], kind)[key] if key else F.try_variant_get(v, "$['']", kind)


def members(v: Column, keys: list[str], kind: str = "variant") -> Column:
    """The values of a variant object's keys as a struct, in one pass over the object; keys are not empty and differ not only in letter case."""
    quoted = (key.replace("`", "``") for key in keys)
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'`{key}`: {kind}' for key in quoted)}>")


def depth(text: Column) -> Column:
    """How deep braces and brackets of JSON are nested, strings left out: one pass."""
    steps = F.split(F.regexp_replace(F.regexp_replace(text, STRING, ""), r"[^{}\[\]]+", ""), "")
    level = lambda at, step: F.when(step.isin("{", "["), at + 1).when(step.isin("}", "]"), at - 1).otherwise(at)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(steps, start, lambda a, s: F.struct(level(a["now"], s).alias("now"), F.greatest(a["most"], level(a["now"], s)).alias("most")))["most"]


#: Kinds of an attribute value, in the order in which they are looked for, with the type they are read as.
SCALAR_KINDS = {"stringValue": "string", "intValue": "bigint", "doubleValue": "double", "boolValue": "boolean", "bytesValue": "string"}


def value_parts(v: Column) -> Column:
    """An attribute value's kinds (``schema.VALUE``), from a variant of its JSON."""
    kinds = SCALAR_KINDS | {"arrayValue": "variant", "kvlistValue": "variant"}
    told = F.try_variant_get(v, "$", f"struct<{', '.join(f'{f}: {k}' for f, k in kinds.items())}>")
    return bind(told, lambda s: F.struct(*((s[f].cast("string") if f == "intValue" else s[f]).alias(f) for f in kinds)))


def any_value(v: Column) -> Column:
    """As ``value_of``, of a variant of the value's JSON."""
    return bind(value_parts(v), value_of)


def value_of(s: Column) -> Column:
    """An attribute value, given by its kinds (``schema.VALUE``), as a variant of the value itself; null where it is empty.

    Integers and doubles stay apart, bytes are base64. Arrays and lists of entries are of any depth.
    """
    scalars = ((s[f].try_cast(k) if f == "intValue" else s[f]).cast("variant") for f, k in SCALAR_KINDS.items())
    nested = (F.when(s[f].isNotNull(), plain_variant(F.to_json(F.struct(s[f].alias(f))))) for f in ("arrayValue", "kvlistValue"))
    return F.coalesce(*scalars, *nested)


#: A JSON string, and JSON without braces and brackets outside of strings.
STRING = r'"(?:[^"\\]++|\\.)*+"'
FLAT = rf'(?:[^{{}}\[\]"]++|{STRING})*+'
#: Values without parts, as they are written in a request, and as plain JSON. Doubles get an exponent, which keeps them
#: apart from integers; what can't be read becomes null.
SCALARS = (
    (rf'\{{"(?:(?:string|bytes)Value":({STRING})|intValue":"?(-?[0-9]{{1,19}})"?|boolValue":(true|false))\}}', "$1$2$3"),
    (r'\{"doubleValue":"?(-?[0-9]+(?:\.[0-9]+)?)"?\}', "$1E0"),
    (r'\{"doubleValue":"?(-?[0-9.]+[eE][+-]?[0-9]+)"?\}', "$1"),
    (r'\{"doubleValue":"(?:NaN|Infinity)"\}', "1E999"),
    (r'\{"doubleValue":"-Infinity"\}', "-1E999"),
    (rf'\{{"(?:string|bytes|int|bool|double)Value":{FLAT}\}}', "null"),
)
#: Containers without parts; then those whose parts are plain already, from the inside out. Plain braces and brackets
#: are control characters until the end, which JSON never holds as they are.
EMPTY = ((r'\{"arrayValue":(?:\{(?:"values":(?:\[\]|null))?\}|null)\}', "\x03\x04"), (r'\{"kvlistValue":(?:\{(?:"values":(?:\[\]|null))?\}|null)\}', "\x01\x02"))
INSIDE_OUT = (
    (rf'\{{"key":({STRING})\}}', "\x05$1:null\x06"),
    (rf'\{{"key":({STRING}),"value":({FLAT})\}}', "\x05$1:$2\x06"),
    (rf'\{{"value":({FLAT})\}}', '\x05"":$1\x06'),
    (rf'\{{"kvlistValue":\{{"values":\[({FLAT})\]\}}\}}', "\x01$1\x02"),
    (rf'\{{"arrayValue":\{{"values":\[({FLAT})\]\}}\}}', "\x03$1\x04"),
)
#: Where a container or an entry begins, once values without parts and empty ones are plain; then where they end. What follows the last
#: part tells them apart: an entry ends in one brace, so "}]}}" ends an entry and its list and "]}}" an array. Ends are looked for
#: from the last one on, over strings and whatever else ends there.
BEGINS = ((rf'\{{"key":({STRING})\}}', '{"key":$1,"value":null}'), (rf'\{{"key":({STRING}),"value":', "$1:"))
BEGUN = {'{"value":': '"":', '{"kvlistValue":{"values":[': "\x01", '{"arrayValue":{"values":[': "\x03"}
ENDS = (
    (rf'\G((?:[^"}}\]]++|{STRING}|\]\}}\}}|\](?!\}}\}})|\}}(?!\]\}}\}}))*+)\}}\]\}}\}}', "$1\x02"),
    (rf'\G((?:[^"\]]++|{STRING}|\](?!\}}\}}))*+)\]\}}\}}', "$1\x04"),
    (rf'\G((?:[^"}}]++|{STRING})*+)\}}', "$1"),
)
PLAIN = rf"^{FLAT}\z"


def replaced(text: Column, pairs) -> Column:
    for pattern, by in pairs:
        text = F.regexp_replace(text, pattern, by)
    return text


def plain_variant(text: Column) -> Column:
    """The variant of an attribute value's JSON (with sorted keys) once it is plain: at once, or level by level where a value isn't written
    as the protocol has it."""
    at_once = lambda t: bind(plain_at_once(t), lambda x: F.when(x.rlike(PLAIN), parsed(x)))
    return bind(plain_scalars(text), lambda t: F.coalesce(at_once(t), parsed(plain_by_level(t, text))))


def parsed(t: Column) -> Column:
    return F.try_parse_json(F.translate(t, "\x01\x02\x03\x04\x05\x06", "{}[]"))


def plain_scalars(text: Column) -> Column:
    """Values without parts and empty containers as plain JSON. Numbers that are not finite stay numbers: both infinities as such, and
    one that is none as the positive one."""
    t = replaced(replaced(text, SCALARS), EMPTY)
    #: An empty value is {} outside of strings: strings are stepped over, and marked as it is, for a moment.
    return bind(t, lambda x: F.when(x.contains("{}"), F.replace(F.regexp_replace(F.regexp_replace(x, rf"({STRING})|\{{\}}", "$1\x07"), rf"({STRING})\x07", "$1"), F.lit("\x07"), F.lit("null"))).otherwise(x))


def plain_at_once(t: Column) -> Column:
    """Containers as plain JSON in one pass for each kind of begin and end, whatever their depth; braces stay where something else is in between."""
    t = replaced(t, BEGINS)
    for begin, by in BEGUN.items():
        t = F.replace(t, F.lit(begin), F.lit(by))
    return replaced(t, ENDS)


def plain_by_level(t: Column, text: Column) -> Column:
    """Plain JSON of all containers of a level at once, the innermost first. Rounds follow the depth, which the JSON reader bounds, not the
    number of containers."""
    rounds = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(depth(text) / 3).cast("int")))  # a container is three levels deep at least
    return F.aggregate(rounds, t, lambda x, _: replaced(x, INSIDE_OUT))


def attribute_object(kv: Column) -> Column:
    """An attribute list as an object; of a repeated key, the last stays (by the session's map policy)."""
    entry = lambda e: F.named_struct(F.lit("key"), e["key"], F.lit("value"), value_of(e["value"]))
    return F.to_variant_object(F.map_from_entries(F.transform(F.coalesce(kv, F.array()), entry)))


def nanos_text(n: Column) -> Column:
    """Nanoseconds as text; '' for zero and for none."""
    return F.when(n > 0, n.cast("string")).otherwise("")


def timestamp_of_nanos(text: Column) -> Column:
    """The timestamp (microseconds) of nanoseconds as text; null when empty, no number, or beyond 64 bits."""
    n = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    return F.timestamp_micros(_div(n, 1000))


def _div(n: Column, by: int) -> Column:
    """Whole-number division that stays in 64-bit integers."""
    return F.call_function("div", n, F.lit(by))


def rfc3339_nanos(text: Column) -> Column:
    """The same time as RFC 3339 text in UTC with up to nine digits of a second, no trailing zeros."""
    n = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    seconds = F.date_format(F.timestamp_seconds(_div(n, 1_000_000_000)), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.regexp_replace(F.lpad((n % 1_000_000_000).cast("string"), 9, "0"), "0+$", "")
    return F.concat(seconds, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""), F.lit("Z"))


def rfc3339(ts: Column) -> Column:
    """A timestamp as RFC 3339 text in UTC (the session's zone), without trailing zeros of its microseconds."""
    fraction = F.regexp_replace(F.date_format(ts, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""), F.lit("Z"))


#: Names of value kinds, from the names of variant types; UINT is our name for decimals without fraction, which hold unsigned numbers.
KINDS = {"STRING": "string", "BIGINT": "int", "UINT": "uint", "DOUBLE": "float", "DECIMAL": "float", "FLOAT": "float", "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array", "TIMESTAMP": "timestamp"}


def kind_of(v: Column) -> Column:
    """Variant type name of a value, without its parts: STRING, BIGINT, UINT, DOUBLE, BOOLEAN, OBJECT, ARRAY, ..."""
    return F.regexp_extract(F.regexp_replace(F.schema_of_variant(v), r"^DECIMAL\([0-9]+,0\)", "UINT"), "^[A-Z]+", 0)


def kind_name(kind: Column) -> Column:
    """string, int, float, boolean, object, array or timestamp, for a variant type name."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair)), kind)


NOT_FINITE = r'(?:^|[:\[,])"(?:NaN|-?Infinity)"(?:[,}\]]|$)'


def may_hold_non_finite(printed: Column) -> Column:
    """Whether a value's JSON has a number that is not finite, or a text that looks like one; the cheap look comes first."""
    return (printed.rlike('NaN"') | printed.rlike('Infinity"')) & printed.rlike(NOT_FINITE)  # a pattern that is a text skips ahead, contains doesn't


def holds_non_finite(v: Column, printed: Column | None = None) -> Column:
    """Whether a variant is, or has anywhere within, a number that is not finite; never null.

    Printed, such a number and a text look alike: values that print so are opened level by level and judged by kind. ``printed`` is the value as JSON, if that is at hand.
    """
    listed = "array<variant>"
    inside = lambda x, path: F.coalesce(F.try_variant_get(x, "$", path), F.lit(None))
    parts = lambda x: F.concat(F.coalesce(F.map_values(inside(x, "map<string,variant>")), F.array().cast(listed)), F.coalesce(inside(x, listed), F.array().cast(listed)))
    odd = lambda x: F.coalesce(F.abs(F.when(kind_of(x).isin("DOUBLE", "FLOAT"), F.try_variant_get(x, "$", "double"))) == float("inf"), F.lit(False)) | F.coalesce(F.isnan(F.when(kind_of(x).isin("DOUBLE", "FLOAT"), F.try_variant_get(x, "$", "double"))), F.lit(False))

    def deeper(state: Column, _: Column) -> Column:
        below = F.flatten(F.transform(F.filter(state["todo"], lambda x: kind_of(x).isin("OBJECT", "ARRAY")), parts))
        return F.when(state["found"] | (F.size(state["todo"]) == 0), state).otherwise(F.struct(below.alias("todo"), F.exists(state["todo"], odd).alias("found")))

    def opened(x: Column, text: Column) -> Column:
        start = F.struct(F.array(x).alias("todo"), F.lit(False).alias("found"))
        return F.aggregate(F.sequence(F.lit(0), depth(text)), start, deeper)["found"]

    told = lambda x, text: F.when(may_hold_non_finite(text), opened(x, text)).otherwise(False)
    if printed is not None:
        return F.coalesce(told(v, printed), F.lit(False))
    return F.coalesce(bind(F.struct(v.alias("v"), F.to_json(v).alias("text")), lambda p: told(p["v"], p["text"])), F.lit(False))


def as_text(v: Column) -> Column:
    """A variant string as it is; anything else as compact JSON with sorted keys."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def message_text(body: Column) -> Column:
    """Text of a log body: '' for none."""
    return F.coalesce(as_text(body), F.lit(""))
