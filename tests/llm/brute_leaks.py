"""Benchmark leaks by brute force: every window of every document against every window of every item."""

import regex

from spanloom.llm.decontaminate import UNITS

UNIT = rf"(?:(?:{UNITS})(?![\p{{L}}\p{{N}}])|[%€$£])"
NUMBER, UNIT_SLOT, NAME = "\x01", "\x02", "\x03"
TOKEN = regex.compile(rf"(?<number>[0-9]+(?:[.,][0-9]+)*)(?: ?(?<unit>{UNIT}))?|(?<rest>.)", regex.S)


def words_of(text):
    """(kind, word) of each word; kind is a slot mark or None."""
    t = regex.sub(r"[\s\p{Z}\x01-\x03]+", " ", text or "")
    names = set()
    for m in regex.finditer(r"(?<=[\p{Ll}\p{N},;] )\p{Lu}", t):
        unit_next = m.start() >= 2 and t[m.start() - 2] in "0123456789" and regex.compile(f"(?i:{UNIT})").match(t, m.start())
        if not unit_next:
            names.add(m.start())
    low, marked = [], set()
    for i, c in enumerate(t):
        if i in names:
            marked.add(sum(map(len, low)))
        c = c.lower()
        low.append("ss" if c == "ß" else c)
    t = "".join(low)
    out, word, kind = [], "", None

    def end():
        nonlocal word, kind
        if word:
            out.append((kind, word))
        word, kind = "", None

    for m in TOKEN.finditer(t):
        if m["number"]:
            end()
            out.append((NUMBER, m["number"]))
            if m["unit"]:
                out.append((UNIT_SLOT, m["unit"]))
            continue
        c, i = m["rest"], m.start()
        inner = regex.match(r"[\p{L}\p{N}%€$£]", c) or c in ".,/" and regex.match("[0-9]", t[i + 1 : i + 2]) and regex.match("[0-9]", t[i - 1 : i] if i else "")
        if i in marked:
            end()
            kind = NAME
        if inner:
            word += c
        else:
            end()
    end()
    return out


def leak(doc, item, k=6, share=0.4, consistent=0.5, run=13):
    """The figures of a pair that is a leak, else None."""
    if not item:
        return None
    n, w = len(item), min(k, len(item))
    forms = lambda ws: ([kind or x for kind, x in ws], [kind if kind in (NUMBER, UNIT_SLOT) else x for kind, x in ws], [x for _, x in ws])
    di, ii = forms(doc), forms(item)
    cut = lambda ws: [tuple(ws[i : i + w]) for i in range(len(ws) - w + 1)]
    dw, iw = [cut(x) for x in di], [cut(x) for x in ii]
    tally = {}
    at = {}
    for i, windows in enumerate(zip(iw[0], iw[1])):
        for x in set(windows):
            at.setdefault(x, set()).add(i)
    for j in range(len(dw[0])):
        for i in at.get(dw[0][j], set()) | at.get(dw[1][j], set()):
            hits = len({iw[0][i], iw[1][i]} & {dw[0][j], dw[1][j]})
            seen = tally.setdefault(i - j, [0, 0])
            seen[0] += hits
            seen[1] += iw[1][i] == dw[1][j] and iw[2][i] == dw[2][j]
    if not tally:
        return None
    best = max((n_all, exact, back) for back, (n_all, exact) in tally.items())[2]
    exact, _, copied = max((exact, n_all, back) for back, (n_all, exact) in tally.items())
    verbatim = exact > 0 and exact >= share * len(iw[0])
    found = []
    for back in {copied} if verbatim else {best, copied}:
        aligned = []
        for j in range(n):
            at = j - back
            there = 0 <= at < len(doc)
            same = there and (ii[0][j] == di[0][at] or ii[1][j] == di[1][at])
            aligned.append((item[j][0], item[j][1], doc[at][1] if there else None, same))
        telling = lambda part: 2 * sum(s[0] is not None for s in part) < len(part)
        parts = [aligned[i : i + run] for i in range(n - run + 1)]
        literal = verbatim or any(all(s[3] and s[1] == s[2] for s in part) for part in parts)
        alike = any(all(s[3] for s in part) and telling(part) for part in parts)
        slots = {s for i in range(n - w + 1) if all(s[3] for s in aligned[i : i + w]) for s in aligned[i : i + w] if s[0] is not None}
        values = {a for _, a, _, _ in slots}
        steady = [v for v in values if sum(a == v for _, a, _, _ in slots) == 1]
        changed = [v for v in values if any(a == v and b != v for _, a, b, _ in slots)]
        matched = set(iw[0]) if n < k else {x for i, x in enumerate(iw[0]) if x in dw[0] or iw[1][i] in dw[1]}
        enough = alike or len(matched) >= share * len(set(iw[0])) and (n >= k or telling(aligned))
        if literal or enough and len(steady) >= consistent * len(values):
            found.append((literal, len(set(iw[0])), len(matched), len(values), len(steady), len(changed)))
    return max(found)[1:] if found else None


def template_windows(words, w):
    """All windows of ``w`` words of both templates."""
    named, plain = [kind or x for kind, x in words], [kind if kind in (NUMBER, UNIT_SLOT) else x for kind, x in words]
    return {tuple(form[i : i + w]) for form in (named, plain) for i in range(len(words) - w + 1)} if w else set()


def leaks(docs, items, k=6):
    """(doc_id, item_id): figures, from lists of (id, text). Pairs without a common window are no leak."""
    parsed = [(i, item, min(k, len(item)), template_windows(item, min(k, len(item)))) for i, item in ((i, words_of(t)) for i, t in items)]
    out = {}
    for d, t in docs:
        words = words_of(t)
        have = {w: template_windows(words, w) for w in {w for _, _, w, _ in parsed}}
        for i, item, w, own in parsed:
            figures = leak(words, item, k) if not own.isdisjoint(have[w]) else None
            if figures:
                out[d, i] = figures
    return out
