"""Plain versions of the operators, one row at a time, and rows at the edges."""

import collections
import hashlib
import re

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"

#: names that operators use inside; a table may have them too
EXTRA = "node string, n long, id long, label string, score double, part int, token long, __text int, __key string, gone int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"

COPY = "the quick brown fox jumps over the lazy dog and runs far away from the old red barn at night when nobody looks"
EDGES = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, COPY), (8, COPY), (9, COPY + " today"),
    (10, "\n\n\n"), (11, "日本語 のテキスト é ß 🙂"), (12, "long " * 30_000), (13, "x" * 60_000), (14, "...!!!"), (7, COPY), (15, COPY.upper()),
    (None, "no id at all"), (None, COPY), (16, "a\r\nb\x00c"), (-5, "negative id with a few words more"), (17, COPY), (17, "another text of the same id"),
]

BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def groups(keys, linked):
    """Least key reachable from each key over the linked pairs."""
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def similar_pairs(sets, num, den):
    """Pairs of keys whose sets have Jaccard similarity num / den or more."""
    where, shared = collections.defaultdict(list), collections.Counter()
    for k, s in sets.items():
        for token in s:
            where[token].append(k)
    for keys in where.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                shared[b, a] += 1
    return [p for p, n in shared.items() if den * n >= num * (len(sets[p[0]]) + len(sets[p[1]]) - n)]


def word_shingles(text, n=5):
    w = BLANK_WORDS.findall(lower(text))
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def linked(docs):
    """{doc_id: (set size, component)}."""
    sets = {i: word_shingles(t) for i, t in docs}
    component = groups(sets, similar_pairs(sets, 4, 5))
    return {i: (len(s), component[i]) for i, s in sets.items()}


def contamination(docs, items):
    windows = {}
    for i, t in items:
        w = ALNUM_WORDS.findall(lower(t))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w = ALNUM_WORDS.findall(lower(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k:k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def line_removal(docs):
    """Texts without lines that are 0.8 similar to an earlier one, linked transitively; docs in order of doc_id."""
    def body(line):
        return line.strip(" ")

    def shingles(b):
        return frozenset(b[k:k + 8] for k in range(len(b) - 7)) if len(b) >= 8 else frozenset([("short", b)])

    bodies = sorted({body(x) for _, t in docs if t is not None for x in t.split("\n") if body(x)})
    kind = groups(bodies, similar_pairs({b: shingles(b) for b in bodies}, 4, 5))
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        if t is None:
            out[i] = None
            continue
        left = []
        for x in t.split("\n"):
            b = body(x)
            if b:
                if kind[b] in seen:
                    continue
                seen.add(kind[b])
            left.append(x)
        out[i] = "\n".join(left)
    return out
