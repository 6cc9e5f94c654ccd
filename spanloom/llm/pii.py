"""Personal data by weak supervision.

Base spans (email, ip, card, phone) come from fixed patterns with their checks, and always stay. Further candidates are
what fails those checks, and matches of wider patterns: obfuscated addresses, national phone numbers, card-like groups,
long internet addresses. Three labelers look at every span, base spans too, and each votes for, against or not at all:
a rule (the check of its pattern), a gazetteer (domain endings, calling codes, issuer prefixes, address blocks) and the
words before it (cues for, cues against). Expectation-maximisation estimates each labeler's reliability from the counts
of vote patterns over the whole corpus, and its posteriors train a logistic span classifier on those votes and the
span's form; candidates that it accepts and that overlap no other span are added.

DataFrame functions only on the data: a narrow table of spans is written once, and what the driver sees are counts per
vote pattern and form, at most 4 x 3^3 x 4 x 3 rows whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import bind, materialize

KINDS = ("email", "ip", "card", "phone")

#: The base patterns (fixed). Each starts where a run of its first characters starts, or where the last match ended,
#: which leaves the matches as they are and keeps long runs from being tried from every place in them. Loops are
#: possessive where nothing follows that they could give back to. A card is a whole run of digits, so the count of
#: its digits is part of the pattern.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider forms of each kind (the method's own candidates).
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
#: A character or pattern without which a text can't hold the kind; spares the search.
HINT = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][0-9 -]{12}", "phone": "\\+[0-9]"}
WIDE_HINT = {"email": "at[)\\]}]", "ip": "[0-9A-Fa-f]:[0-9A-Fa-f]", "card": "[0-9]{4}[ -][0-9]{4}", "phone": "[0-9]{3}[ .-][0-9]{4}"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Gazetteers: domain endings, first digits of calling and area codes, issuer prefixes, leading address blocks.
GAZETTEER = {
    "email": r"(?:\.|dot[)\]] ?)(?:com|org|net|edu|gov|info|io|eu|uk|de|fr|es|it|nl|at|ch|us|ca)$",
    "ip": r"^(?:1?[1-9]?[1-9]|1[0-9]0|[1-9]0|20[0-9]|21[0-9]|22[0-3]|20[0-9A-Fa-f]{2}|[Ff][CcDd][0-9A-Fa-f]{2})[.:]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)",
    "phone": r"^(?:\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])",
}
CUES = {
    "email": "mail|contact|write|reach|correo|courriel|kontakt|escrib|schreib",
    "ip": "ip|host|server|address|adresse|addr|client|from|login",
    "card": "card|credit|visa|master|amex|payment|karte|carte|tarjeta|pan",
    "phone": "phone|tel|call|mobile|cell|fax|ruf|appel|llam|contact",
}
#: Words before a span that speak against any kind.
COUNTER_CUES = r"order|invoice|tracking|version|build|release|serial|part|item|isbn|article|page|total|ref|bestell|rechnung|factura|facture|pedido|commande"
#: What a match of a wider pattern has to look like for the rule to vote for it; cards are checked by their digits.
WIDE_RULE = {
    "email": r"(?:\.|dot[)\]] ?)[A-Za-z]{2,}$",
    "ip": r"(?:^|:)[0-9A-Fa-f]{0,3}[A-Fa-f]",
    "phone": r"^\(?[2-9][0-9]{2}\)?[ .-]?[2-9]",
}
#: Votes.
AGAINST, FOR, NONE = 0, 1, 2
#: What is thought of the labelers (rule, gazetteer, context) beforehand: shares of votes for, of personal data and of
#: what is none, worth PRIOR_VOTES votes each. Where the counts can't tell two explanations apart, this decides.
PRIOR_RATES, PRIOR_VOTES = ((0.95, 0.1), (0.8, 0.3), (0.9, 0.3)), 50
SPAN = "array<struct<start:int,end:int,value:string,before:string>>"
#: How many characters before a span are its context.
NEAR = 40
#: Lists are gone through in blocks of this size: a step copies a block at most, so long lists cost little more a match.
BLOCK = 128


def matches(text: Column, pattern: str, hint: str) -> Column:
    return F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def in_blocks(items: Column, state: Column, kept: str, step) -> Column:
    """What ``step`` gives of each item in turn: it takes the state and an item, and gives the next state and a list."""
    blocks = lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, F.lit(BLOCK)))

    def one(acc: Column, item: Column) -> Column:
        after, more = step(acc["state"], item)
        return F.struct(after.alias("state"), F.concat(acc["kept"], more).alias("kept"))

    def block(acc: Column, part: Column) -> Column:
        inside = F.aggregate(part, F.struct(acc["state"].alias("state"), F.array().cast(kept).alias("kept")), one)
        return bind(inside, lambda i: F.struct(i["state"].alias("state"), F.concat(acc["kept"], F.array(i["kept"])).alias("kept")))

    start = F.struct(state.alias("state"), F.array().cast(f"array<{kept}>").alias("kept"))
    none = F.array().cast(kept)
    return bind(items, lambda all_: F.when(F.size(all_) > 0, F.flatten(F.aggregate(blocks(all_), start, block)["kept"])).otherwise(none))


def located(text: Column, found: Column, pattern: str) -> Column:
    """All matches with their places, in code points, and what stands before them: the pieces between them, and they, add up to
    the text."""
    steps = F.arrays_zip(found.alias("m"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"))

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        before = F.right(F.concat(state["tail"], x["gap"]), F.lit(NEAR))
        after = F.struct(end.alias("at"), F.right(F.concat(before, x["m"]), F.lit(NEAR)).alias("tail"))
        return after, F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"), before.alias("before")))

    all_ = in_blocks(steps, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")), SPAN, step)
    return F.when(F.size(found) > 0, all_).otherwise(F.array().cast(SPAN))  # texts without matches aren't split


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check: every second digit from the right counts twice, less 9 over 9."""
    n = F.length(number)
    value = lambda i: number.substr(n - i, F.lit(1)).cast("int")
    term = lambda i: F.when(i % 2 == 0, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The base check of a kind."""
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def of_kind(number: int):
    return lambda span: span["kind"] == number


def ordered(spans: Column) -> Column:
    """kind:start:end, by start, then kind as listed, comma-joined."""
    parts = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(parts, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def told(spans: Column, k: int, wide: bool) -> Column:
    """Each span of kind ``k`` with ok (a base span), its votes, and its form: length in four steps, share of digits in three."""
    kind = KINDS[k]

    def one(s: Column) -> Column:
        value = s["value"]
        ok = F.lit(False) if wide else passes(kind, value)
        holds = (luhn(digits(value)) if kind == "card" else value.rlike(WIDE_RULE[kind])) if wide else ok
        before = F.lower(s["before"])
        cue = lambda words: before.rlike(rf"(?<![\p{{L}}])(?:{words})")
        context = F.when(cue(CUES[kind]), FOR).when(cue(COUNTER_CUES), AGAINST).otherwise(NONE)
        votes = (holds.cast("int"), value.rlike(GAZETTEER[kind]).cast("int"), context)
        share = F.floor(3 * F.length(digits(value)) / F.length(value))
        form = (F.least(F.lit(3), F.floor((F.length(value) - 1) / 8)), F.least(F.lit(2), share))
        names = ("v_rule", "v_gazetteer", "v_context", "size", "share")
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind"), ok.alias("ok"), *(x.cast("int").alias(n) for x, n in zip((*votes, *form), names)))

    return F.transform(spans, one)


TOLD = "array<struct<start:int,end:int,kind:int,ok:boolean,v_rule:int,v_gazetteer:int,v_context:int,size:int,share:int>>"


def scan(spans: Column, state: Column, step) -> Column:
    """Which spans ``step`` keeps: it gives, of the state and a span, the next state and whether the span stays."""

    def one(at: Column, s: Column) -> tuple[Column, Column]:
        after, stays = step(at, s)
        return after, F.when(stays, F.array(s)).otherwise(F.array().cast(TOLD))

    return in_blocks(spans, state, TOLD, one)


def free_of_base(spans: Column) -> Column:
    """Spans in the order of their starts, without candidates that overlap a base span: one pass each way."""
    reach = lambda end, s: (F.when(s["ok"], F.greatest(end, s["end"])).otherwise(end), s["ok"] | (end <= s["start"]))
    nearest = lambda start, s: (F.when(s["ok"], s["start"]).otherwise(start), s["ok"] | (start >= s["end"]))
    forward = scan(F.array_sort(spans), F.lit(0), reach)
    return F.reverse(scan(F.reverse(forward), F.lit(2**31 - 1), nearest))


def spans_of(docs: DataFrame) -> DataFrame:
    """Row by row: doc_id, and spans: base spans and candidates that overlap none, each with its votes and form."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    text = F.col("text")
    found = rows.select("*", *(matches(text, BASE[k], HINT[k]).alias(k) for k in KINDS), *(matches(text, WIDE[k], WIDE_HINT[k]).alias(f"w_{k}") for k in KINDS))
    placed = found.select("doc_id", "text", *(located(text, F.col(k), BASE[k]).alias(k) for k in KINDS), *(located(text, F.col(f"w_{k}"), WIDE[k]).alias(f"w_{k}") for k in KINDS))
    every = F.concat(*(told(F.col(k), i, False) for i, k in enumerate(KINDS)), *(told(F.col(f"w_{k}"), i, True) for i, k in enumerate(KINDS)))
    return placed.select("doc_id", every.alias("spans")).select("doc_id", F.when(F.size("spans") > 0, free_of_base(F.col("spans"))).otherwise(F.col("spans")).alias("spans"))


Votes = tuple[int, int, int]


def expectation_maximisation(cells: list[tuple[Votes, int]], rounds: int = 200) -> dict[Votes, float]:
    """Posterior of each vote pattern being personal data, from counts of patterns: independent labelers given the truth.

    A labeler that doesn't vote says nothing. Starts from the rates thought beforehand, which also smooth the counts.
    """

    def rate(j: int, weight: dict[Votes, float], before: float) -> float:
        votes = [(v[j], n * weight[v]) for v, n in cells if v[j] != NONE]
        return (sum(n for x, n in votes if x == FOR) + PRIOR_VOTES * before) / (sum(n for _, n in votes) + PRIOR_VOTES)

    def posteriors(prior: float, rates: list[tuple[float, float]]) -> dict[Votes, float]:
        out = {}
        for v, _ in cells:
            odds = math.log(prior / (1 - prior))
            for (hit, false), vote in zip(rates, v):
                if vote != NONE:
                    odds += math.log(hit / false) if vote == FOR else math.log((1 - hit) / (1 - false))
            out[v] = 1 / (1 + math.exp(-max(-700.0, odds)))
        return out

    posterior = posteriors(0.5, list(PRIOR_RATES))
    all_n = sum(n for _, n in cells)
    for _ in range(rounds):
        other = {v: 1 - p for v, p in posterior.items()}
        prior = (sum(n * posterior[v] for v, n in cells) + 1) / (all_n + 2)
        posterior = posteriors(prior, [(rate(j, posterior, hit), rate(j, other, false)) for j, (hit, false) in enumerate(PRIOR_RATES)])
    return posterior


FEATURES = [(name, value) for name, n in (("kind", 4), ("v_rule", 2), ("v_gazetteer", 2), ("v_context", 3), ("size", 4), ("share", 3)) for value in range(n)]


def train_classifier(cells: list[dict], rounds: int = 400, rate: float = 0.5) -> dict[tuple[str, int], float]:
    """Logistic weights for each (feature, value), fitted to the posteriors of the cells.

    Cells weigh by the square root of their counts, so that many plain spans don't outweigh what few odd ones tell.
    """
    patterns: dict[Votes, int] = {}
    vote = lambda c: (c["v_rule"], c["v_gazetteer"], c["v_context"])
    for c in cells:
        patterns[vote(c)] = patterns.get(vote(c), 0) + c["count"]
    truth = expectation_maximisation(sorted(patterns.items()))
    total = sum(math.sqrt(c["count"]) for c in cells)
    weights = dict.fromkeys(FEATURES, 0.0)
    for _ in range(rounds):
        slope = dict.fromkeys(FEATURES, 0.0)
        for c in cells:
            own = [f for f in FEATURES if c[f[0]] == f[1]]
            error = truth[vote(c)] - 1 / (1 + math.exp(-sum(weights[f] for f in own)))
            for f in own:
                slope[f] += error * math.sqrt(c["count"]) / total
        for f in FEATURES:
            weights[f] += rate * (slope[f] - 1e-4 * weights[f])
    return weights


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and base_sha256 are of the base spans, spans of all (base and added), n_added of those that the classifier
    added at ``threshold``; of added spans that overlap, the first stays. Null and empty texts have no span. Repeated
    rows are searched each for itself and all count as evidence. An empty table gives an empty result; a null doc_id
    stays null; other columns are ignored.
    """
    rows = materialize(spans_of(docs), "personal-data")
    names = [n for n in dict.fromkeys(n for n, _ in FEATURES)]
    seen = rows.select(F.explode("spans").alias("s")).select("s.*").groupBy(*names).count()
    weights = train_classifier([r.asDict() for r in seen.collect()])  # a bounded grid of votes and forms

    def logit(s: Column) -> Column:
        total = F.lit(0.0)
        for name in names:
            total = total + F.element_at(F.array(*(F.lit(float(w)) for (n, _), w in weights.items() if n == name)), s[name] + 1)
        return total

    cut = math.log(threshold / (1 - threshold))
    accepted = F.filter("spans", lambda s: ~s["ok"] & (logit(s) >= cut))
    leftmost = lambda c: scan(c, F.lit(0), lambda end, s: (F.when(end <= s["start"], s["end"]).otherwise(end), end <= s["start"]))
    done = rows.withColumns({"base": F.filter("spans", lambda s: s["ok"]), "added": F.when(F.size("spans") > 0, leftmost(accepted)).otherwise(F.col("spans"))})
    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return done.select("doc_id", *counts, F.sha2(ordered(F.col("base")).cast("binary"), 256).alias("base_sha256"), ordered(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
