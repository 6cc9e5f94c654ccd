"""Projection of flat records to typed rows: sources in order, defaults, constants, strict casts, and rejects.

A mapping is a dict of columns. Each rule is a selector, or a dict with one of ``source``, ``sources`` and ``value``,
and ``default`` and ``cast`` if wanted. The first source that is present decides; a failed cast rejects the record.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import CASTS, OUTPUT, cast, error_text, finite
from ..functions.paths import follow, parse
from ..functions.values import WHITE_SPACE, holds_non_finite, kept_here, members
from .flatten import PLACE
from .identity import RECORD_JSON, record_id, record_object, with_record_json
from .selectors import select, select_text


@dataclass
class Rule:
    """A column: its output type, its sources (name, column, declared type), and what stands in for them."""

    column: str
    output: str
    target: str | None = None
    sources: list[tuple[str, Column, str]] = field(default_factory=list)
    default: Column | None = None
    constant: bool = False

    def kinds(self) -> list[str]:
        return list(dict.fromkeys(kind for _, _, kind in self.sources))

    def picked(self) -> list[Column]:
        """First step: which source is the first present one, and its value, apart by declared type."""
        if not self.sources:
            return []
        index = F.coalesce(*(F.when(c.isNotNull(), F.lit(i)) for i, (_, c, _) in enumerate(self.sources)))
        if len(self.kinds()) == 1:
            return [index.alias(f"__i_{self.column}"), F.coalesce(*(c for _, c, _ in self.sources)).alias(f"__0_{self.column}")]
        raw = []
        for n, kind in enumerate(self.kinds()):
            out = F.lit(None).cast(OUTPUT[kind])
            for _, c, k in reversed(self.sources):
                out = F.when(c.isNotNull(), c if k == kind else F.lit(None).cast(OUTPUT[kind])).otherwise(out)
            raw.append(out.alias(f"__{n}_{self.column}"))
        return [index.alias(f"__i_{self.column}"), *raw]

    def cast(self) -> list[Column]:
        """Second step: the values cast, beside what the first step has picked."""
        if not self.sources:
            return []
        values = []
        for n, kind in enumerate(self.kinds()):
            raw = F.col(f"`__{n}_{self.column}`")
            value = cast(raw, kind, self.target) if self.target else raw if kind == self.output else raw.cast("variant")
            values += [raw, value.alias(f"__{n}v_{self.column}")]
        return [F.col(f"`__i_{self.column}`"), *values]

    def pairs(self) -> list[tuple[Column, Column, str]]:
        """What the second step leaves: the value picked, the value cast and the declared type, for each type."""
        return [(F.col(f"`__{n}_{self.column}`"), F.col(f"`__{n}v_{self.column}`"), kind) for n, kind in enumerate(self.kinds())]

    def failure(self) -> tuple[Column, Column]:
        """Of the second step: whether the cast failed, and what it says."""
        failed, message = F.lit(False), F.lit(None).cast("string")
        for raw, cast_value, kind in self.pairs() if self.target else ():
            wrong = raw.isNotNull() & cast_value.isNull()
            failed, message = failed | wrong, F.when(wrong, error_text(raw, kind, self.target)).otherwise(message)
        return failed, message

    def settled(self) -> list[Column]:
        """Third step: the value, and whether its cast failed, what it says, and the source."""
        if not self.sources:
            return [self.default.alias(self.column), F.struct(F.lit(False).alias("failed"), F.lit(None).cast("string").alias("message"), F.lit("value").alias("source")).alias(f"__{self.column}")]
        index, value, (failed, message) = F.col(f"`__i_{self.column}`"), F.coalesce(*(v for _, v, _ in self.pairs())), self.failure()
        source = F.get(F.array(*(F.lit(name) for name, _, _ in self.sources)), index)
        if self.default is not None:
            value, source = F.when(index.isNull(), self.default).otherwise(value), F.coalesce(source, F.lit("default"))
        return [value.alias(self.column), F.struct(failed.alias("failed"), message.alias("message"), source.alias("source")).alias(f"__{self.column}")]


def literal_type(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, str):
        return "string"
    if isinstance(value, dict):
        return "object"
    if isinstance(value, list):
        return "array"
    raise ValueError(f"no literal of type {type(value).__name__}")


def literal_json(value) -> str:
    """JSON of a literal; floats have an exponent, which keeps them floats when it is read."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{literal_json(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(literal_json, value)) + "]"
    return f"{value!r}E0" if isinstance(value, float) and "e" not in repr(value) else json.dumps(value)


def fixed(value, target: str | None) -> tuple[Column, str]:
    """A literal as a column of the target type; ValueError if it can't be cast, before any data is read."""
    kind = literal_type(value)
    if kind == "float" and not math.isfinite(value):
        raise ValueError("a literal must be finite")
    column = F.parse_json(F.lit(literal_json(value))) if kind in ("object", "array") else F.lit(value).cast(OUTPUT[kind])
    target = target or kind
    if not possible(kind, target):
        raise ValueError(f"literal {value!r} can't be cast to {target}")
    if kind == "string" and target not in ("string", "any"):
        check_text(value, target)
    return cast(column, kind, target), target


def check_text(value: str, target: str) -> None:
    import re

    from ..functions.casts import DECIMAL, FALSE, HEXADECIMAL, RFC3339, TRUE

    def real() -> bool:
        plain = bare.replace("_", "")
        if re.fullmatch(HEXADECIMAL, bare):
            try:
                return math.isfinite(float.fromhex(plain))
            except OverflowError:
                return False
        return bool(re.fullmatch(DECIMAL, bare)) and math.isfinite(float(plain))

    bare = value.strip(WHITE_SPACE)
    fits = {
        "int": lambda: re.fullmatch(r"[+-]?[0-9]+", bare) and -(2**63) <= int(bare) < 2**63,
        "uint": lambda: re.fullmatch(r"[0-9]+", bare) and int(bare) < 2**64,
        "float": real,
        "boolean": lambda: bare in (*TRUE, *FALSE),
        "timestamp": lambda: re.fullmatch(RFC3339, bare) or re.fullmatch(r"[+-]?[0-9]+", bare),
    }
    if not fits[target]():
        raise ValueError(f"literal {value!r} can't be cast to {target}")


def possible(source: str, target: str) -> bool:
    """Whether any value of the source type could be cast."""
    if target in ("any", "string", source) or source in ("dynamic", "number"):
        return True
    allowed = {"int": {"string", "int", "uint", "float"}, "boolean": {"string"}, "timestamp": {"string", "int", "uint"}}
    allowed |= {"uint": allowed["int"], "float": allowed["int"]}
    return source in allowed.get(target, set())


def compile_mapping(mapping: dict, signal: str) -> list[Rule]:
    """Rules sorted by column name; all errors of all columns in one ValueError."""
    rules, errors = [], []
    for name in sorted(mapping):
        try:
            rules.append(compile_rule(name, mapping[name], signal))
        except ValueError as e:
            errors.append(f"{name}: {e}")
    if errors:
        raise ValueError("; ".join(errors))
    return rules


def compile_rule(name: str, spec, signal: str) -> Rule:
    spec = {"source": spec} if isinstance(spec, str) else dict(spec)
    if unknown := set(spec) - {"source", "sources", "value", "default", "cast"}:
        raise ValueError(f"unknown keys {sorted(unknown)}")
    given = [k for k in ("source", "sources", "value") if k in spec]
    if len(given) != 1:
        raise ValueError("exactly one of source, sources and value is needed")
    for k in ("value", "default"):
        if k in spec and spec[k] is None:
            raise ValueError(f"{k} can't be null")
    target = spec.get("cast")
    if target is not None and target not in CASTS:
        raise ValueError(f"unknown cast {target!r}")
    if "value" in spec:
        if "default" in spec:
            raise ValueError("a constant has no default")
        column, output = fixed(spec["value"], target)
        return Rule(name, output, default=column, constant=True)
    sources = [spec["source"]] if "source" in spec else list(spec["sources"])
    if not sources:
        raise ValueError("sources is empty")
    picked = [(s, *(select_text if target == "string" else select)(s, signal)) for s in sources]
    kinds = {kind for _, _, kind in picked} | ({literal_type(spec["default"])} if "default" in spec else set())
    output = target or (kinds.pop() if len(kinds) == 1 else "dynamic")
    rule = Rule(name, output, target, picked)
    for source, _, kind in picked:
        if target and not possible(kind, target):
            raise ValueError(f"{source} is {kind}, which can't be cast to {target}")
    if "default" in spec:
        column, kind = fixed(spec["default"], target)
        rule.default = column if kind == output else column.cast("variant")
    return rule


def unencodable(rule: Rule) -> Column:
    """Whether the value is a number that JSON can't hold."""
    if rule.output == "float":
        return F.coalesce(~finite(F.col(f"`{rule.column}`")), F.lit(False))
    if OUTPUT[rule.output] == "variant":
        return F.col(RECORD_ODD) if is_record(rule) else holds_non_finite(F.col(f"`{rule.column}`"))
    return F.lit(False)


#: Whether the record holds a number that is not finite, beside rules that give it whole.
RECORD_ODD = "__record_odd"


def is_record(rule: Rule) -> bool:
    return [name for name, _, _ in rule.sources] == ["record"] and rule.target in (None, "object") and rule.default is None


def places(records: DataFrame) -> list[str]:
    return [c for c in (*PLACE, "point_pos") if c in records.columns]


def evaluate(records: DataFrame, rules: list[Rule], signal: str | None = None) -> DataFrame:
    """Records' places, each column's value, and beside it, as ``__column``, whether its cast failed, the message and the source.

    Sources are read, picked, cast and settled in steps, so that each path is read once, however many rules name it. With ``signal``,
    ``RECORD_ODD`` is beside rules that give the record whole.
    """
    rows, rules = cast_rows(records, rules, signal)
    at = [*places(records), *(c for c in (RECORD_ODD,) if c in rows.columns)]
    return rows.select(*at, *(c for r in rules for c in r.settled()))


def opened_once(records: DataFrame, names: list[str], signal: str | None) -> tuple[DataFrame, dict[str, Column]]:
    """Records with a struct of the keys that are read of each object, and the selectors that are read from it."""
    keys: dict[str, dict[str, list]] = {}
    for name in names:
        base, steps = parse(name)
        if signal and steps and isinstance(steps[0], str) and steps[0] and base != "record":
            keys.setdefault(base, {})[name] = steps
    out, structs = {}, []
    for n, (base, found) in enumerate(keys.items()):
        firsts = list(dict.fromkeys(steps[0] for steps in found.values()))
        apart = [k for k in firsts if sum(k.lower() == other.lower() for other in firsts) == 1]
        structs += [members(select(base, signal)[0], apart).alias(f"__k{n}")] if apart else []
        out |= {name: follow(F.col(f"__k{n}")[steps[0]], steps[1:]) for name, steps in found.items() if steps[0] in apart}
    return records.select("*", *structs), out


def cast_rows(records: DataFrame, rules: list[Rule], signal: str | None = None) -> tuple[DataFrame, list[Rule]]:
    """``evaluate`` before its last step, and the rules with their sources as read."""
    at, read = places(records), {}
    names = [name for r in rules for name, _, _ in r.sources]
    records, own = opened_once(records, names, signal)
    whole = bool(signal) and any(map(is_record, rules))
    if signal and (whole or "record.id" in names):
        records, own = with_record_json(records, signal), own | {"record.id": record_id(signal, F.col(RECORD_JSON))}
    for r in rules:
        for name, c, _ in r.sources:
            read.setdefault((name, r.target == "string"), own.get(name, c).alias(f"__s{len(read)}"))
    number = {key: F.col(f"__s{n}") for n, key in enumerate(read)}
    rules = [replace(r, sources=[(name, number[name, r.target == "string"], kind) for name, _, kind in r.sources]) for r in rules]
    odd = [holds_non_finite(record_object(signal), F.col(RECORD_JSON)).alias(RECORD_ODD)] if whole else []
    records = records.select(*at, *read.values(), *odd)
    at += [RECORD_ODD] if odd else []
    first = records.select(*at, *(c for r in rules for c in r.picked()))
    return first.select(*at, *(c for r in rules for c in r.cast())), rules


def map_signal(records: DataFrame, mapping: dict, signal: str, max_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to write (the mapping's columns, by name), and rejects: place, reason, column, source, message.

    A record is rejected for its first failing column by name (``mapping_cast_failed``), then for a number that isn't
    finite (``mapping_encoding_failed``), then for its size as JSON with a line end (``mapped_row_too_large``).
    """
    rules = compile_mapping(mapping, signal)
    rows = evaluate(records, rules, signal)
    can_fail = [r for r in rules if r.target] or rules[:1]
    first = F.coalesce(*(F.when(F.col(f"`__{r.column}`.failed"), F.struct(F.lit("mapping_cast_failed").alias("reason"), F.lit(r.column).alias("column"), F.col(f"`__{r.column}`.source").alias("source"), F.col(f"`__{r.column}`.message").alias("message"))) for r in can_fail))
    plain = lambda reason, column: F.struct(F.lit(reason).alias("reason"), F.lit(column).cast("string").alias("column"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("message"))
    checks = [first, *(F.when(unencodable(r), plain("mapping_encoding_failed", r.column)) for r in rules if r.output == "float" or OUTPUT[r.output] == "variant")]
    if max_bytes is not None:
        checks.append(F.when(row_bytes([r.column for r in rules]) > max_bytes, plain("mapped_row_too_large", None)))
    rows = rows.withColumn("__reject", kept_here(F.coalesce(*checks)))
    valid = rows.where("__reject is null").select(*(F.col(f"`{r.column}`") for r in rules))
    return valid, rows.where("__reject is not null").select(*places(records), "__reject.*")


def row_bytes(columns: list[str]) -> Column:
    """Bytes of a row as a JSON line; absent columns are left out."""
    return F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)))) + 1


def union_signals(*tables: DataFrame) -> DataFrame:
    """Rows of several signals in one table; columns that a signal has not are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
