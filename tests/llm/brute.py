"""Plain Python versions of the operators, to compare with on small tables."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def shingle_set(text, size):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def ngram_components(rows, size, num, den):
    """``rows`` of (id, text) with distinct ids: id to (set size, component)."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    found = components(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def personal(text):
    """Plain identifiers by the patterns as they are written."""
    text = text or ""
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return found


def targets(sizes, cycle=(1, 2, 3), most=3):
    """Source to target words, by filling up one source after the other."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total, open_names, out = sum(sizes.values()), list(names), {}
    left = float(total)
    while open_names:
        unit = left / sum(weight[s] for s in open_names)
        full = [s for s in open_names if unit * weight[s] >= most * sizes[s]]
        if not full:
            out |= {s: unit * weight[s] for s in open_names}
            break
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_names.remove(s)
    return out


def contained(docs, items, size=5, num=8, den=10):
    """(doc, item) to (item's shingles, shared ones)."""
    of_docs, of_items = defaultdict(set), defaultdict(set)
    for i, t in docs:
        of_docs[i] |= shingle_set((t or "").lower(), size)
    for i, t in items:
        of_items[i] |= shingle_set((t or "").lower(), size)
    return {(d, i): (len(b), len(a & b)) for d, a in of_docs.items() for i, b in of_items.items()
            if b and len(a & b) * den >= len(b) * num}
