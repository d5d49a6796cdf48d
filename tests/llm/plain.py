"""Plain Python versions of whole stages, for small inputs (ASCII texts)."""

import re
from collections import Counter, defaultdict

import xxhash

WINDOW, SKETCH = 8, 16


def words(text):
    return (text or "").encode().split()


def normalised(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()


def base_failed(text):
    w = words(text)
    spans = [tuple(w[i:i + WINDOW]) for i in range(len(w) - WINDOW + 1)]
    count = Counter(spans)
    covered = {j for i, s in enumerate(spans) if count[s] > 1 for j in range(i, i + WINDOW)}
    return len(w) < 20 or 100 * len(covered) > 30 * len(w)


def quality(rows, hashes, max_docs=20, share=0.05, min_rest=0.3):
    """(kept, text) per row of (source, text).  ``hashes`` gives the engine's hash
    of (source, word) and of (source, normalised line)."""
    lines = [[(i, x, normalised(x)) for i, x in enumerate((t or "").split("\n")) if words(x)] for _, t in rows]
    texts = defaultdict(set)            # host -> distinct documents, by their lines
    for (host, t), _ in zip(rows, lines):
        if words(t):
            texts[host].add(tuple(normalised(x) if words(x) else None for x in t.split("\n")))
    frequent = set()
    for host, docs in texts.items():
        held = Counter(x for d in docs for x in {x for x in d if x is not None})
        common = {x for x, n in held.items() if n > max_docs and n > share / 4 * len(docs)}
        sk = {x: sorted({hashes[host, w] for w in x.split(" ")})[:SKETCH] for x in held}

        def keys(x):
            least = sk[x][:4]
            return {tuple(y for j, y in enumerate(least) if j != i) for i in range(4)}

        # texts by key, as the common lines are few
        place = defaultdict(set)
        for c in common:
            if len(sk[c]) > 4:
                for k in keys(c):
                    place[k].add(c)
        stands = {}
        for x in held:
            if x in common or len(sk[x]) <= 4:
                continue
            near = set()
            for c in set().union(*(place[k] for k in keys(x) if k in place)):
                least = sorted(set(sk[x]) | set(sk[c]))[:SKETCH]
                both = set(sk[x]) & set(sk[c]) & set(least)
                if 100 * len(both) >= 80 * len(least):
                    near.add(c)
            if near:
                stands[x] = min(near, key=lambda c: hashes[host, c])
        content = {d: frozenset(stands.get(x, x) for x in d if x is not None) for d in docs}
        every = len(set(content.values()))
        for c in common:
            n = len({content[d] for d in docs if c in d})
            if n > max_docs and n > share * every:
                frequent.add((host, c))
    out = []
    for (host, t), own in zip(rows, lines):
        cut = {i for i, x, norm in own if (host, norm) in frequent}
        gone, total = sum(len(x) for i, x, _ in own if i in cut), sum(len(x) for _, x, _ in own)
        kept = not base_failed(t) and not gone > (1 - min_rest) * total
        out.append((kept, "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in cut) if cut else t, gone))
    return out


def dedup_lines(rows):
    """Texts of (doc_id, text) rows, in order of doc_id, without the lines that
    have 80 % of their words in common with an earlier one."""
    earlier, out = [], []
    for _, t in rows:
        left = []
        for x in t.split("\n"):
            s = frozenset(words(x.lower()))
            if s and any(5 * len(s & e) >= 4 * len(s | e) for e in earlier):
                earlier.append(s)
                continue
            if s:
                earlier.append(s)
            left.append(x)
        out.append("\n".join(left))
    return out


def fingerprint(text):
    w = words(text.lower())
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_duplicates(rows, bits=4):
    """The rows that stay: of each component the one with the smallest id."""
    fps, root = [fingerprint(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [r for i, r in enumerate(rows) if find(i) == i]


def shingles(text, n=5):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def contaminated(text, items):
    own = shingles(text)
    return any(s and 100 * len(s & own) >= 80 * len(s) for s in map(shingles, items))
