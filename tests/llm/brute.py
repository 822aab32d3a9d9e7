"""Plain answers over small inputs."""

from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def lowered(text):
    return [w.decode().translate(str.maketrans(UPPER, UPPER.lower())).encode() for w in words(text)]


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    own, text = words(text), text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    counts, inside = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            inside |= {i, i + 1, i + 2}
    chars = sum(len(w.decode()) for w in own)
    return len(own), chars, sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def shingles(text):
    own = lowered(text)
    if len(own) < 5:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def components(texts):
    """{doc_id: (set size, smallest doc_id reachable)} at a Jaccard similarity of 0.8."""
    sets = {d: shingles(t) for d, t in texts.items()}
    parent, having = {d: d for d in texts}, defaultdict(list)

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d in sorted(sets):
        shared = Counter(e for s in sets[d] for e in having[s])
        for e, n in shared.items():
            if 100 * n >= 80 * (len(sets[d]) + len(sets[e]) - n):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            having[s].append(d)
    return {d: (len(sets[d]), root(d)) for d in texts}
