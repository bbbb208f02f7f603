"""Small messy inputs and plain models of what the operators must return."""

import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

LOWER = {c: c + 32 for c in range(65, 91)}
#: Names that operators use inside; as extra columns they must not clash.
EXTRA = ("doc", "key", "id", "row", "h", "n", "words", "hits", "score", "component", "label", "anchor", "first", "drop")

_VOCAB = ["der", "Éa", "the", "of", "ting", "語", "ou", "lorem", "ipsum", "x1", "on", "ber", "que", "los", "naïve"]


def sentence(rnd, n):
    return " ".join(rnd.choice(_VOCAB) + str(rnd.randint(0, 400)) for _ in range(n))


def thue_morse(n, a="a", b="b"):
    """Two different words of ``n`` letters that polynomial hashes modulo a power of two confuse."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def messy(rnd, n=60, passages=4):
    """(doc_id, text) rows: nulls, empties, repeated rows, copies, near copies, shared passages and lines, a long text."""
    shared = [sentence(rnd, 75) for _ in range(passages)]
    line = "A Line That Many documents Share é"
    rows = [(i, sentence(rnd, rnd.randint(1, 160))) for i in range(n)]
    for i in range(n, n + 40):
        kind, (_, base) = i % 5, rows[rnd.randint(0, n - 1)]
        if kind == 0:
            text = base
        elif kind == 1:
            words = base.split()
            words[rnd.randint(0, len(words) - 1)] = "changed"
            text = " ".join(words)
        elif kind == 2:
            text = sentence(rnd, rnd.randint(1, 20)) + " " + rnd.choice(shared) + " " + sentence(rnd, 5)
        elif kind == 3:
            text = sentence(rnd, 8) + "\n  " + line.upper() + " \t\n\n" + sentence(rnd, 4)
        else:
            text = line + "\n" + rnd.choice(shared)[::-1] + "\n" + rnd.choice(shared)
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "one"), (205, "a" * 1500), (206, "ab" * 700), (207, "\n\n\n"),
             (208, "the the " * 90), (209, sentence(rnd, 4000)), (210, "!?"), (211, "One\r\none")]
    tail = sentence(rnd, 30)
    for i, n in enumerate((1024, 2048)):
        one, two = thue_morse(n)
        rows += [(220 + 4 * i, one), (221 + 4 * i, two), (222 + 4 * i, one + " " + tail), (223 + 4 * i, two + " " + tail)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows, extra=EXTRA):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *(T.StructField(c, T.StringType()) for c in extra)])
    return spark.createDataFrame([(i, t, *("x",) * len(extra)) for i, t in rows], schema).repartition(3)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = spaced((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in held[x] if j < i).items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def without_repeats(rows, size):
    """(id, bytes, removed, kept) where every covered byte goes."""
    seen = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        seen.update(b[p:p + size] for p in range(len(b) - size + 1))
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - size + 1):
            if seen[b[p:p + size]] > 1:
                gone[p:p + size] = [True] * size
        out.append((d, len(b), sum(gone), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def without_later(rows, size):
    """(id, words, removed, kept) where the earliest window stays; ids are distinct or null once."""
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = spaced(t)
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            window = tuple(w[p:p + size])
            if window in seen:
                gone[p:p + size] = [True] * size
            seen.add(window)
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def without_shared_lines(rows, min_chars=20, min_docs=3):
    def key(line):
        k = line.strip(" \t\n\v\f\r").translate(LOWER)
        return k if len(k) >= min_chars else None

    held = defaultdict(list)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")} - {None}:
            held[k].append(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for x in lines:
            docs = held.get(key(x), ())
            keeper = max((i for i in docs if i is not None), default=None)
            if len(docs) < min_docs or d is not None and d == keeper:
                stay.append(x)
        out.append((d, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(rows, items, n=13):
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        if item is not None and w:
            size = min(n, len(w))
            for p in range(len(w) - size + 1):
                windows[tuple(w[p:p + size])].add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for d, t in rows:
        w, hit, found = alnum(t), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                own = windows.get(tuple(w[p:p + size]))
                if own:
                    hit |= set(range(p, p + size))
                    found |= own
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)
