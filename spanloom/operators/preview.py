"""Evidence for a mapping over a whole table: how often each column is present, fails, and what it is taken from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import is_open
from ..functions.values import kept_here, kind_name, kind_of
from .mapping import Rule, cast_rows, compile_mapping, evaluate, places


def observed(rule: Rule) -> Column:
    value = F.col(f"`{rule.column}`")
    return kind_name(kind_of(value)) if is_open(rule.output) else F.when(value.isNotNull(), F.lit(rule.output))


def preview(records: DataFrame, mapping: dict, signal: str) -> DataFrame:
    """One row per column: column, output_type, total, present, errors, observed_types, default_count, selections.

    One pass: partial aggregates of every column, then turned to rows. A selection counts even if its cast fails,
    presence doesn't. ``selections`` is "source (count)" for each source taken, in the rule's order.
    """
    rules = compile_mapping(mapping, signal)
    rows = evaluate(records, rules)
    about = lambda r, f: F.col(f"`__{r.column}`.{f}")
    sums = []
    for n, r in enumerate(rules):
        failed = about(r, "failed")
        options = [name for name, _, _ in r.sources] + (["value"] if r.constant else ["default"] if r.default is not None else [])
        sums += [F.count_if(F.col(f"`{r.column}`").isNotNull() & ~failed).alias(f"p{n}"), F.count_if(failed).alias(f"e{n}"), F.collect_set(F.when(~failed, observed(r))).alias(f"t{n}")]
        sums += [F.count_if(about(r, "source") == o).alias(f"s{n}_{k}") for k, o in enumerate(options)]
    one = rows.agg(F.count("*").alias("total"), *sums)
    lines = []
    for n, r in enumerate(rules):
        options = [name for name, _, _ in r.sources] + (["value"] if r.constant else ["default"] if r.default is not None else [])
        taken = F.array_join(F.filter(F.array(*(F.when(F.col(f"s{n}_{k}") > 0, F.concat(F.lit(f"{o} ("), F.col(f"s{n}_{k}").cast("string"), F.lit(")"))) for k, o in enumerate(options))), lambda x: x.isNotNull()), ", ")
        default = F.col(f"s{n}_{len(options) - 1}") if r.default is not None and not r.constant else F.lit(0).cast("bigint")
        lines.append(F.struct(F.lit(r.column).alias("column"), F.lit(r.output).alias("output_type"), F.col("total"), F.col(f"p{n}").alias("present"), F.col(f"e{n}").alias("errors"), F.array_join(F.array_sort(f"t{n}"), ",").alias("observed_types"), default.alias("default_count"), taken.alias("selections")))
    return one.select(F.inline(F.array(*lines)))


def record_counts(records: DataFrame, mapping: dict, signal: str) -> DataFrame:
    """valid and invalid records."""
    rules = compile_mapping(mapping, signal)
    bad = reduce(lambda a, b: a | b, (F.col(f"`__{r.column}`.failed") for r in rules))
    return evaluate(records, rules).agg(F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"))


def examples(records: DataFrame, mapping: dict, signal: str, rows: int = 3, errors: int = 20) -> tuple[DataFrame, DataFrame]:
    """The first valid rows and the first errors in record order; the bounds are the feature."""
    rules = compile_mapping(mapping, signal)
    at = places(records)
    done, rules = cast_rows(records, rules)
    # the names stay where they are: explode would have a filter on them, and filters are moved below the casts, which writes
    # these and the decoding out again; messages are made of the few rows that are left
    names = F.filter(F.array(*(F.when(r.failure()[0], F.lit(r.column)) for r in rules)), lambda x: x.isNotNull())
    done = done.withColumn("__errors", kept_here(names))
    valid = done.where(F.size("__errors") == 0).orderBy(*at).limit(rows).select(*(r.settled()[0] for r in rules))
    first = done.withColumn("column", F.explode("__errors")).orderBy(*at, "column").limit(errors)
    wrong = first.select(*at, "column", F.coalesce(*(F.when(F.col("column") == r.column, r.failure()[1]) for r in rules)).alias("message"))
    return valid, wrong


#: Of what is observed against a table's type: whether it fits, and whether that is certain (fixed relation).
TYPE_TABLE = {("timestamp", "string"): (True, True), ("uint", "int"): (True, True), ("uint", "float"): (False, False), ("array", "object"): (True, True), ("string", "timestamp"): (False, False), ("string", "binary"): (False, False), ("int", "float"): (False, False)}


def fits(kind: Column, target: Column) -> tuple[Column, Column]:
    """Whether values of an observed type fit a table's type, and whether that can be told."""
    same = (target == "any") | (kind == target)
    yes = reduce(lambda a, b: a | b, ((kind == k) & (target == t) for (k, t), (ok, _) in TYPE_TABLE.items() if ok), same)
    unsure = reduce(lambda a, b: a | b, ((kind == k) & (target == t) for (k, t), (_, sure) in TYPE_TABLE.items() if not sure))
    return yes, ~unsure


def verdicts(evidence: DataFrame, contract: DataFrame) -> DataFrame:
    """``preview`` with each column's verdict, given ``contract`` (column, target_type, compatibility) of its table."""
    rows = evidence.join(contract, "column", "left").withColumn("kinds", F.filter(F.split("observed_types", ","), lambda k: k != ""))
    target = F.col("target_type")
    wrong = F.exists("kinds", lambda k: fits(k, target)[1] & ~fits(k, target)[0])
    unsure = F.exists("kinds", lambda k: ~fits(k, target)[1])
    coverage = F.when((F.col("default_count") == F.col("total")) & (F.col("total") > 0), "WARN default only").when(F.col("present") < F.col("total"), "WARN partial").otherwise("OK")
    state = F.coalesce("compatibility", F.lit("missing"))
    verdict = F.when(state == "missing", "ERROR missing column").when(state == "incompatible", "ERROR type mismatch").when(F.col("errors") > 0, F.concat(F.lit("ERROR mapping ("), F.col("errors").cast("string"), F.lit(")"))).when(F.col("present") == 0, "WARN unobserved")
    verdict = verdict.when(state == "compatible", coverage).when((target != "any") & wrong, "ERROR sample type").when((target != "any") & unsure, "WARN review type").otherwise(coverage)
    return rows.select(*evidence.columns, "target_type", state.alias("compatibility"), verdict.alias("verdict"))


def gate(report: DataFrame) -> DataFrame:
    """One row: warnings and errors of a report, whether it passes strictly (neither) and loosely (no error)."""
    bad, wrong = F.count_if(F.col("verdict") != "OK"), F.count_if(F.col("verdict").startswith("ERROR"))
    return report.agg((bad - wrong).alias("warnings"), wrong.alias("errors"), (bad == 0).alias("passes_strict"), (wrong == 0).alias("passes"))


def quality_gate(report: DataFrame, strict: bool = True) -> bool:
    """Whether a report passes: no warning or error, or no error if not strict."""
    return gate(report).first()["passes_strict" if strict else "passes"]
