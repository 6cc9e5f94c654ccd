"""Cross-site line deduplication by the spread of each line over sites.

A line (trimmed, ``min_chars`` long at least) that stands on ``min_sites`` sites or more is boilerplate: it goes from
all documents but the first that has it. The spread comes from HyperLogLog sketches of the sites, merged per line hash
by aggregation; where an estimate is near the threshold, the sites are counted exactly. Lines on a single site, most
of a corpus, are told apart first by their least and greatest site, an aggregate that combines on the map side.

DataFrame functions only. Hot lines shrink to one row a task before each shuffle. Joins against lines are broadcast while their
bytes are few; beyond, hot lines meet their facts by broadcast where they are, and only lines of few rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import bind, free_names, join_facts, materialize

TRIM = "trim(BOTH ' \\t\\r' FROM line)"


def row_key() -> list[Column]:
    """128 bits that tell rows apart by id and text; equal rows share them."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2")]


def candidate_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that may be boilerplate: k1, k2, doc_id, site, pos, and the line's hash h1, h2."""
    #: Keys come before lines: beside an explode they would be hashed anew for every line.
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"), *row_key(), "text")
    lines = rows.select("k1", "k2", "doc_id", "site", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.withColumn("line", F.expr(TRIM)).where(F.length("line") >= min_chars)
    return lines.select("k1", "k2", "doc_id", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = 12) -> DataFrame:
    """Hashes of lines on ``min_sites`` sites or more, each with the document and position it is first in, and its rows."""
    spread = lines.groupBy("h1", "h2").agg(F.min("site").alias("lo"), F.max("site").alias("hi"), F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("rows"))
    shared = materialize(spread.where("lo < hi" if min_sites > 1 else "true").select("h1", "h2", "first", "rows"), "shared-lines")
    sites = join_facts(lines, shared.select("h1", "h2", "rows"), ["h1", "h2"], "rows")
    estimates = sites.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("estimate"), F.count("*").alias("rows"))
    estimates = materialize(estimates, "line-spread")
    #: Four standard errors of a sketch with 2^lg_k registers, and one site for rounding.
    band = 1 + int(4 * 1.04 / 2 ** (lg_k / 2) * min_sites)
    near = estimates.where(F.abs(F.col("estimate") - min_sites) <= band).select("h1", "h2", "rows")
    exact = join_facts(lines, near, ["h1", "h2"], "rows").select("h1", "h2", "site").distinct().groupBy("h1", "h2").count().where(F.col("count") >= min_sites).select("h1", "h2")
    sure = estimates.where(F.col("estimate") > min_sites + band).select("h1", "h2")
    return shared.join(sure.unionByName(exact), ["h1", "h2"]).select("h1", "h2", "first", "rows")


def dedup_lines(docs: DataFrame, min_sites: int = 10, min_chars: int = 20) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the columns n_lines and n_removed (long).

    Every row stays, with its other columns as they are. The first occurrence of a boilerplate line (least doc_id,
    null before all, then position) stays too, in each of several equal rows. A null text stays null with 0 lines; an
    empty text has one empty line. Blank and short lines are never boilerplate. A null source is the site ''.
    """
    k1, k2, gone_at, cut_lines = free_names(docs.columns, "k1", "k2", "gone", "lines")
    lines = candidate_lines(docs, min_chars)
    found = materialize(boilerplate(lines, min_sites), "boilerplate")
    hits = join_facts(lines, found, ["h1", "h2"], "rows").where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))))
    gone = hits.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.array_sort(F.collect_set("pos")).alias(gone_at))
    columns = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    keyed = docs.select("*", *(k.alias(name) for k, name in zip(row_key(), (k1, k2))))
    cut = keyed.join(gone, [k1, k2], "left").withColumn(cut_lines, F.split("text", "\n", -1))
    text = F.when(F.col(gone_at).isNull(), F.col("text")).otherwise(F.array_join(without(F.col(cut_lines), F.col(gone_at)), "\n"))
    return cut.select(*(F.col(f"`{c}`") for c in columns), text.alias("text"), F.coalesce(F.size(cut_lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size(gone_at), F.lit(0)).cast("long").alias("n_removed"))


def without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the sorted places ``gone``: the runs between them, one after another, in linear time."""

    def runs(x: Column) -> Column:
        ends = F.concat(F.array(F.lit(-1)), x["gone"], F.array(F.size(x["lines"])))
        run = lambda b: F.transform(F.slice(b, 2, F.size(b) - 1), lambda end, i: F.slice(x["lines"], F.get(b, i) + 2, end - F.get(b, i) - 1))
        return F.flatten(bind(ends, run))

    return bind(F.struct(lines.alias("lines"), gone.alias("gone")), runs)
