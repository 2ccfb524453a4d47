"""Plain versions of the operators for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text, n=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(zip(*(words[k:] for k in range(n)))) if len(words) >= n else frozenset([tuple(words)])


def near_components(rows, words=4):
    """doc_id -> (set sizes, component) by comparing all pairs that share a shingle."""
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for k, (i, own) in enumerate(sets):
        common = Counter(j for s in own for j in having[s])
        for j, n in common.items():
            other, theirs = sets[j]
            if 100 * n >= 80 * (len(own) + len(theirs) - n):
                a, b = root(i), root(other)
                parent[max(a, b)] = min(a, b)
        for s in own:
            having[s].append(k)
    return {i: root(i) for i, _ in sets}


def rule_numbers(text):
    text = text or ""
    words = WORD.findall(text)
    seen, covered = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def without_repeats(rows):
    """doc_id -> (text, lines removed) for rows with different doc_ids."""
    windows = defaultdict(list)
    for i, text in sorted(rows, key=lambda r: r[0]):
        lines = [(k, x.strip(" \t\n\x0b\x0c\r")) for k, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[1]]
        for three in zip(lines, lines[1:], lines[2:]):
            windows[tuple(x[1] for x in three)].append((i, three[0][0], three[-1][0]))
    gone = defaultdict(set)
    for places in windows.values():
        for i, first, last in places[1:]:
            gone[i] |= set(range(first, last + 1))
    return {i: (t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), len(gone[i])) for i, t in rows}
