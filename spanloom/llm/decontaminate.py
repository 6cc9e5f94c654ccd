"""Benchmark decontamination by template windows.

Texts are canonicalised to templates: numbers, names (capitalised words inside a sentence) and units become typed
placeholders, everything else lower-case words. A second template keeps names as words, as they can't be told in a
text that changed its letter case. All windows of ``k`` words of both templates are hashed, and windows of the
benchmark meet those of each document in a hash join; an item of fewer words is one window of its own width.
Each pair found is then checked over all windows: the share of the item's
windows that the document has, and whether the slots (placeholders of matched windows) are filled consistently, one
document value for one item value. That catches items that were given other numbers, names or units. Slots are read
along one alignment of item and document, the offset that most windows share, as a template may repeat in either.

DataFrame functions only. Windows of the benchmark are broadcast while they are few; beyond, windows of documents first
pass a bitmap of fixed size, so that of those that the benchmark doesn't have only chance hits are shuffled, and
frequent windows are dealt over tasks. Documents themselves pass such a bitmap of the rows that are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import BROADCAST_BYTES, bind, bitmap, deal_join, few_bytes, materialize, sifted, small_side

#: Units of measure and currency that make a word a unit slot (fixed words, lower case).
UNITS = "mm|cm|m|km|inch|inches|ft|feet|yd|mile|miles|mg|g|kg|t|ton|tons|oz|lb|lbs|ml|l|litre|litres|liter|liters|s|sec|second|seconds|min|minute|minutes|h|hr|hour|hours|day|days|week|weeks|month|months|year|years|percent|dollar|dollars|euro|euros|pound|pounds|usd|eur|gbp|hz|khz|mhz|w|kw|v|a|km/h|mph"


#: Units that a number can have: a word of its own, or a sign.
UNIT = rf"(?:(?:{UNITS})(?![\p{{L}}\p{{N}}])|[%€$£])"


def marked_words(text: Column) -> Column:
    """Lower-case words of a text, joined by spaces. Marks first: \\x01 before a number, \\x02 before a unit that follows
    a number, \\x03 before a name. But for \\x03, the result is the same for any letter case and white space of a text.
    """
    blank, word = r"[\s\p{Z}\x01-\x03]", r"\p{L}\p{N}\x01-\x03%€$£"
    #: Replacing costs by the match, so single plain spaces, which are most, match nowhere below.
    t = F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?! (?!{blank})){blank}+", " ")
    t = F.regexp_replace(t, rf"(?=\p{{Lu}})(?<=[\p{{Ll}}\p{{N}},;] )(?!(?<=[0-9] )(?i:{UNIT}))", "\x03")
    t = F.replace(F.lower(t), F.lit("ß"), F.lit("ss"))
    t = F.replace(F.regexp_replace(t, rf"([0-9]++(?:[.,][0-9]++)*+)(?: ?({UNIT})|)", " \x01$1 \x02$2 "), F.lit("\x02 "), F.lit(" "))
    gap = rf"[^{word}.,/]++|[.,/](?:(?![0-9])|(?<![0-9].))"
    return F.trim(F.regexp_replace(t, rf"(?! [{word}])(?:{gap})++", " "))


def template_texts(marked: Column) -> dict[str, Column]:
    """Of marked words, three texts of as many words: the template ``named`` (numbers, units and names are slots), the
    template ``plain`` (names are words), and the ``words`` that they stand for.
    """
    unnamed = F.replace(marked, F.lit("\x03"), F.lit(""))
    return {"named": F.regexp_replace(marked, "([\x01-\x03])[^ ]++", "$1"), "plain": F.regexp_replace(unnamed, "([\x01\x02])[^ ]++", "$1"), "words": F.regexp_replace(unnamed, "[\x01\x02]", "")}


def templates(marked: Column) -> dict[str, Column]:
    """The same as arrays of words."""
    return {name: F.split(t, " ") for name, t in template_texts(marked).items()}


def with_windows(rows: DataFrame, k: int, keys: list[str], prefix: str = "", whole: bool = False) -> DataFrame:
    """``keys`` of rows, the templates and words of their ``marked`` words, and the windows of each (named_windows, ...).

    With ``whole``, texts without words go, and a text of fewer than ``k`` words is one window.
    """
    forms = rows.select(*keys, *(c.alias(prefix + name) for name, c in templates(F.col("marked")).items()))
    if whole:
        forms = forms.where(F.get(prefix + "words", F.lit(0)) != "")
    width = F.least(F.lit(k), F.size(prefix + "words")) if whole else k
    return forms.withColumns({f"{prefix}{name}_windows": windows(F.col(prefix + name), width) for name in ("named", "plain", "words")})


def windows(words: Column, k: int | Column) -> Column:
    """Hashes of all windows of ``k`` words; none of a shorter text."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes)
        if isinstance(k, int):  # the same hashes, but slices would copy every word k times
            every = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, k))))
            return F.slice(every, F.lit(1), F.greatest(n - k + 1, F.lit(0)))
        return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.slice(hashes, i, k)))).otherwise(F.array().cast("array<bigint>"))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of)


def template_windows(rows: DataFrame, keys: list[str], widths: list[int]) -> DataFrame:
    """``keys`` and ``w``: hashes of windows of these widths of the templates ``named`` and ``plain``, arrays of words.

    As many words as the widest window has are put side by side, and hashed in compiled code after they are rows. Windows
    of the two templates come once where they are equal; those that a text repeats come as often.
    """
    last = max(widths)
    hashed = rows.select(*keys, *(F.transform(name, lambda w: F.xxhash64(w)).alias(name) for name in ("named", "plain")))
    beside = F.arrays_zip(*(F.slice(name, i + 1, F.size(name)).alias(f"{name}{i}") for name in ("named", "plain") for i in range(last)))
    placed = hashed.select(*keys, F.explode(beside).alias("x"))
    #: Beside the last words of a text there are nulls, which a hash would leave out.
    of = lambda name, n: F.when(F.col(f"x.{name}{n - 1}").isNotNull(), F.xxhash64(*(f"x.{name}{i}" for i in range(n))))
    found = placed.select(*keys, *(of(name, n).alias(f"{name}{n}") for name in ("named", "plain") for n in widths))
    each = [c for n in widths for c in (F.col(f"plain{n}"), F.when(F.col(f"named{n}") != F.col(f"plain{n}"), F.col(f"named{n}")))]
    return found.select(*keys, F.explode(F.array(*each)).alias("w")).where(F.col("w").isNotNull())


def short_widths(items: DataFrame, k: int) -> list[int]:
    """Word counts of items that have fewer than ``k`` words."""
    return sorted(r.n for r in items.select(F.size("item_words").alias("n")).where(F.col("n") < k).distinct().collect())  # fewer than k values


def meet(rows: DataFrame, of_items: DataFrame, by: list[str], name: str, broadcast_bytes: int, sift_bits: int, repeats: bool = False) -> DataFrame:
    """``rows`` joined with windows of items on ``w``; ``by`` names columns that tell rows of one window apart.

    With ``repeats``, rows may be equal; where they are shuffled they are made distinct first.
    """
    if few_bytes(of_items, broadcast_bytes):
        return rows.join(F.broadcast(of_items), "w")
    of_items = materialize(of_items, f"{name}-of-items")
    own = sifted(rows, F.col("w"), bitmap(of_items, "w", sift_bits), sift_bits)
    own = materialize(own.distinct() if repeats else own, f"{name}-sifted")
    return deal_join(own, of_items, "w", by)


def candidate_pairs(docs: DataFrame, items: DataFrame, k: int, short: list[int], broadcast_bytes: int, sift_bits: int) -> DataFrame:
    """Rows (by k1, k2) and items that share a template window."""
    of_items = items.select("item", F.explode(F.array_distinct(F.concat("item_plain_windows", "item_named_windows"))).alias("w"))
    texts = template_texts(F.col("marked"))
    forms = docs.select("k1", "k2", marked_words(F.col("text")).alias("marked")).select("k1", "k2", *(F.split(texts[name], " ").alias(name) for name in ("named", "plain")))
    of_docs = template_windows(forms, ["k1", "k2"], [*short, k])
    return meet(of_docs, of_items, ["k1", "k2"], "windows", broadcast_bytes, sift_bits, repeats=True).select("k1", "k2", "item").distinct()


def places(rows: DataFrame, keys: list[str], prefix: str = "", widths: tuple[int, ...] = ()) -> DataFrame:
    """Windows ``w`` of both templates by their place ``at``, once where they are equal; ``own``, the window of words,
    goes with the plain one. Windows of other ``widths`` come along.
    """
    names = ("named", "plain", "words")
    own = F.arrays_zip(*(F.col(f"{prefix}{name}_windows").alias(name) for name in names))
    zipped = [own, *(F.arrays_zip(*(windows(F.col(prefix + name), n).alias(name) for name in names)) for n in widths)]
    rows = rows.select(*keys, F.explode(F.concat(*(F.transform(z, lambda x, at: F.struct(at.alias("at"), *(x[name].alias(name) for name in names))) for z in zipped))).alias("x"))
    plain = F.struct(F.col("x.plain").alias("w"), F.col("x.words").alias("own"))
    named = F.struct(F.col("x.named").alias("w"), F.lit(None).cast("long").alias("own"))
    return rows.select(*keys, "x.at", F.inline(F.when(F.col("x.named") == F.col("x.plain"), F.array(plain)).otherwise(F.array(plain, named))))


def alignments(texts: DataFrame, items: DataFrame, widths: tuple[int, ...], broadcast_bytes: int, sift_bits: int) -> DataFrame:
    """Per text (k1, k2) and item that share windows: the offsets ``best``, with the most shared template windows, and
    ``copied``, with the most windows of equal words. Offsets (place in the text less place in the item) are negated
    (``back``), so that the first wins on ties.
    """
    of_items = places(items, ["item"], "item_").withColumnsRenamed({"at": "i", "own": "item_own"})
    hits = meet(places(texts, ["k1", "k2"], widths=widths), of_items, ["k1", "k2", "at"], "places", broadcast_bytes, sift_bits)
    hits = hits.select("k1", "k2", "item", (F.col("i") - F.col("at")).alias("back"), F.coalesce(F.col("own") == F.col("item_own"), F.lit(False)).cast("long").alias("same"))
    offsets = hits.groupBy("k1", "k2", "item", "back").agg(F.count("*").alias("n"), F.sum("same").alias("n_exact"))
    return offsets.groupBy("k1", "k2", "item").agg(F.max(F.struct("n", "n_exact", "back")).alias("best"), F.max(F.struct("n_exact", "n", "back")).alias("copied"))


def slot_figures(runs: Column) -> Column:
    """Of matched runs of aligned words: n_slots, n_consistent and n_changed, as in ``leaks``, in linear time."""
    part = lambda slot, i: F.get(F.split(slot, " "), F.lit(i))
    slots = F.transform(F.filter(F.flatten(runs), is_slot), lambda s: F.concat_ws(" ", s["kind"], s["a"], s["b"]))
    changed = lambda found: F.transform(F.filter(found, lambda s: part(s, 1) != part(s, 2)), lambda s: part(s, 1))
    alone = lambda values: F.filter(values, lambda v, i: ~v.eqNullSafe(F.get(values, i - 1)) & ~v.eqNullSafe(F.get(values, i + 1)))
    numbers = {
        "n_slots": lambda found, values: F.array_distinct(values),
        "n_consistent": lambda found, values: alone(values),  # sorted, so equal values are neighbours
        "n_changed": lambda found, values: F.array_distinct(changed(found)),
    }
    told = lambda found, values: F.struct(*(F.size(f(found, values)).cast("long").alias(n) for n, f in numbers.items()))
    return bind(F.array_distinct(slots), lambda found: bind(F.array_sort(F.transform(found, lambda s: part(s, 1))), lambda values: told(found, values)))


def is_slot(word: Column) -> Column:
    return word["kind"].isin("\x01", "\x02", "\x03")


def judged(k: int, min_share: float, min_consistent: float, min_run: int) -> Column:
    """The verdict on a pair along one ``offset``: verbatim, the figures of ``leaks``, and whether the pair ``holds``.

    One expression whose parts are bound: the optimizer would write columns that are made of each other out again at
    every use, inside of loops too, and a repetitive text would take cubic time.
    """
    positions, n_words = F.size("item_named_windows"), F.size("item_words")
    there = lambda name, j: F.get(name, j + F.col("offset"))
    same = lambda j: F.get("item_named", j).eqNullSafe(there("named", j)) | F.get("item_plain", j).eqNullSafe(there("plain", j))
    word = lambda j: F.struct(F.get("item_named", j).alias("kind"), F.get("item_words", j).alias("a"), there("words", j).alias("b"), same(j).alias("same"))
    telling = lambda part: 2 * F.size(F.filter(part, is_slot)) < F.size(part)
    common = lambda name: F.array_intersect(f"item_{name}_windows", f"{name}_windows")
    either = lambda named, plain: F.filter("item_named_windows", lambda w, i: F.array_contains(named, w) | F.array_contains(plain, F.get("item_plain_windows", i)))
    shared = F.when(n_words < k, F.col("item_named_windows")).otherwise(bind(common("named"), lambda named: bind(common("plain"), lambda plain: either(named, plain))))

    def verdict(aligned: Column) -> Column:
        run = lambda i: F.slice(aligned, i, F.least(F.lit(k), n_words))
        some_run = lambda holds: F.when(n_words >= min_run, F.exists(F.sequence(F.lit(1), n_words - min_run + 1), lambda i: holds(F.slice(aligned, i, min_run)))).otherwise(False)
        equal = some_run(lambda part: F.forall(part, lambda s: s["same"] & (s["a"] == s["b"])))
        alike = some_run(lambda part: F.forall(part, lambda s: s["same"]) & telling(part))
        runs = F.transform(F.filter(F.sequence(F.lit(1), positions), lambda i: F.forall(run(i), lambda s: s["same"])), run)
        sizes = [F.size(F.array_distinct(c)).cast("long").alias(n) for n, c in (("item_windows", F.col("item_named_windows")), ("matched_windows", shared))]
        facts = F.struct((F.col("verbatim") | equal).alias("verbatim"), alike.alias("alike"), ((n_words >= k) | telling(aligned)).alias("telling"), *sizes, slot_figures(runs).alias("slots"))
        return bind(facts, settled)

    def settled(f: Column) -> Column:
        enough = f["alike"] | (f["matched_windows"] >= min_share * f["item_windows"]) & f["telling"]
        holds = f["verbatim"] | enough & (f["slots"]["n_consistent"] >= min_consistent * f["slots"]["n_slots"])
        plain, slots = ("verbatim", "item_windows", "matched_windows"), ("n_slots", "n_consistent", "n_changed")
        return F.struct(holds.alias("holds"), *(f[n].alias(n) for n in plain), *(f["slots"][n].alias(n) for n in slots))

    return bind(F.transform(F.sequence(F.lit(0), n_words - 1), word), verdict)


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = 6, min_share: float = 0.4, min_consistent: float = 0.5, min_run: int = 13, broadcast_bytes: int = BROADCAST_BYTES, sift_bits: int = 28) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    doc_id, item_id, item_windows (distinct template windows of the item), matched_windows, n_slots (distinct item
    values in matched slots), n_consistent (those that stand for one document value), n_changed (those filled
    otherwise in the document), and k1, k2, the row's key. A pair is a leak when at least ``min_share`` of the item's
    windows stand in the document and at least ``min_consistent`` of its slots are consistent, or when at least
    ``min_share`` of the item's windows stand there with equal words, at one offset. A run of ``min_run`` shared
    template words, mostly not slots, stands for the share, and ``min_run`` equal words in a row are a leak in any case.

    Null and empty texts match nothing, however long a text is, all of it is searched. An item of fewer than ``k``
    words is one window, its whole template; if that is mostly slots, only equal words count. Equal items are found
    each for itself, and so are two items with one item_id; a null item_id stays null. Equal rows (same id and text) give their pairs once; a null doc_id
    stays null. Other columns are ignored; an empty table on either side gives an empty result.

    ``broadcast_bytes`` and ``sift_bits`` (a bitmap has two to that many bits, 32 MB by default) only choose how it is
    computed: what passes a bitmap by chance is dropped by the join that follows.
    """
    items = benchmark.select("item_id", "text", F.xxhash64("item_id", "text").alias("item")).distinct().withColumn("marked", marked_words(F.col("text")))
    items = materialize(with_windows(items, k, ["item_id", "item"], "item_", whole=True), "benchmark-templates")
    short = short_widths(items, k)
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"))
    pairs = materialize(candidate_pairs(keyed, items, k, short, broadcast_bytes, sift_bits), "template-pairs")
    wanted = pairs.select("k1", "k2").distinct()
    if few_bytes(wanted, broadcast_bytes):
        wanted = F.broadcast(wanted)
    else:
        keyed = sifted(keyed, F.col("k1"), bitmap(wanted, "k1", sift_bits), sift_bits)
    texts = keyed.join(wanted, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    #: Only their marked words are kept: readers of Parquet would hold thousands of rows of words and hashes at once.
    texts = materialize(texts.select("doc_id", "k1", "k2", marked_words(F.col("text")).alias("marked")), "candidate-texts")
    aligned = alignments(with_windows(texts, k, ["k1", "k2"]), items, tuple(short), broadcast_bytes, sift_bits)
    aligned = materialize(aligned.groupBy("k1", "k2").agg(F.collect_list(F.struct("item", "best", "copied")).alias("pairs")), "alignments")
    both = texts.join(small_side(aligned, broadcast_bytes), ["k1", "k2"])
    both = with_windows(both, k, ["doc_id", "k1", "k2", "pairs"]).withColumn("pairs", F.explode("pairs")).select("*", "pairs.*").drop("pairs")
    both = both.join(small_side(items), "item")
    both = both.withColumn("verbatim", (F.col("copied.n_exact") > 0) & (F.col("copied.n_exact") >= min_share * F.size("item_named_windows")))
    #: What equal words of a whole copy don't settle is judged along both alignments, mostly one and the same.
    backs = F.when(F.col("verbatim"), F.array("copied.back")).otherwise(F.array_distinct(F.array("best.back", "copied.back")))
    both = both.withColumn("back", F.explode(backs)).withColumn("offset", -F.col("back"))
    found = both.select("doc_id", "k1", "k2", "item_id", judged(k, min_share, min_consistent, min_run).alias("found"))
    figures = ["item_windows", "matched_windows", "n_slots", "n_consistent", "n_changed"]
    held = F.when(F.col("found.holds"), F.struct(*(F.col(f"found.{c}") for c in ("verbatim", *figures))))
    #: What doesn't hold goes last: a filter before would be moved below the verdict, and so tell it twice.
    found = found.groupBy("doc_id", "k1", "k2", "item_id").agg(F.max(held).alias("found")).where(F.col("found").isNotNull())
    return found.select("doc_id", "item_id", *(f"found.{c}" for c in figures), "k1", "k2")


def decontaminate(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, sift_bits: int = 28, **options) -> DataFrame:
    """``docs``, all columns, without the documents that hold a benchmark item. Options as for ``leaks``.

    Where leaking rows are too many for a broadcast, only documents that may be among them, by a bitmap, are shuffled.
    """
    found = leaks(docs, benchmark, broadcast_bytes=broadcast_bytes, sift_bits=sift_bits, **options)
    found = materialize(found.select("k1", "k2").distinct(), "leaking-rows")
    key = F.xxhash64("doc_id", "text")
    own = (key == found["k1"]) & (F.xxhash64(F.lit(1), "doc_id", "text") == found["k2"])
    if few_bytes(found, broadcast_bytes):
        return docs.join(F.broadcast(found), own, "left_anti")
    bits = materialize(bitmap(found, "k1", sift_bits), "leaking-bits")
    clean = sifted(docs, key, bits, sift_bits, "left_anti")
    return clean.unionByName(sifted(docs, key, bits, sift_bits).join(found, own, "left_anti"))
