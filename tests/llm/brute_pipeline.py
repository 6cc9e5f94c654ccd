"""The pipeline's stages by brute force, from rows (doc_id, text, source) to the texts that stay by doc_id."""

import re
from collections import defaultdict

import regex

from .brute_leaks import leaks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def passes_rules(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    n, chars = len(words), sum(map(len, words))
    repeated = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    loud = sum(bool(regex.search(r"\p{Lu}.*\p{Lu}", w)) and not regex.search(r"\p{Ll}", w) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    shares = (2 * len(repeated) <= n, 10 * symbols <= n, 2 * (len(lines) - len(set(lines))) <= len(lines), 10 * loud <= 3 * n)
    return n >= 50 and 2 * n <= chars <= 20 * n and all(shares)


def quality_rules(rows, items):
    return {i: t for i, t, _ in rows if passes_rules(t)}


def line_dedup(rows, items):
    sites, first, out = defaultdict(set), {}, {}
    for i, t, site in sorted(rows):
        for p, line in enumerate(t.split("\n")):
            sites[line.strip(" \t\r")].add(site or "")
            first.setdefault(line.strip(" \t\r"), (i, p))
    common = {line for line, on in sites.items() if len(on) >= 10 and len(line) >= 20}
    for i, t, _ in rows:
        lines = t.split("\n")
        kept = [x for p, x in enumerate(lines) if x.strip(" \t\r") not in common or first[x.strip(" \t\r")] == (i, p)]
        if len(kept) == len(lines) or WORD.search("\n".join(kept)):
            out[i] = "\n".join(kept)
    return out


def ngram_join(rows, items):
    """The least document of each component of all pairs at 80 percent of five-word shingles."""
    sets = {}
    for i, t, _ in rows:
        words = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    least = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and least[i] != least[j] and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((least[i], least[j]))
                least = {d: low if r == high else r for d, r in least.items()}
    return {i: t for i, t, _ in rows if least[i] == i}


def decontamination(rows, items):
    found = {d for d, _ in leaks([(i, t) for i, t, _ in rows], items)}
    return {i: t for i, t, _ in rows if i not in found}


STAGES = {f.__name__: f for f in (quality_rules, line_dedup, ngram_join, decontamination)}
