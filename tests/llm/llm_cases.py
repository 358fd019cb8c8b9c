"""Small document tables with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Rows of (doc_id, text, source) as a documents table."""
    return spark.createDataFrame(
        [(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows], SCHEMA)


def clashing(df):
    """The same table with further columns named like internal and resulting ones."""
    from pyspark.sql import functions as F
    names = ("key bucket kept keep_id group_size text_sha256 size host rank slot band rep label "
             "component_id n_tokens start score verdict u v draw epoch target row_id").split()
    return df.withColumns({n: F.lit(1) for n in names})


ODD = [
    (1, "one two three four five six seven", "a"),
    (2, "one two three four five six seven", "b"),
    (3, None, "a"),
    (4, "", None),
    (5, "One TWO three four five six seven", "a"),
    (None, "one two three four five six seven", None),
    (6, "word", "c"),
    (7, "word", "c"),
    (8, " \n\t ", "c"),
    (9, "x" * 30_000, "a"),
    (10, "many words here " * 20_000, "b"),
    (11, "unique éÀ 中文 text", "a"),
    (11, "unique éÀ 中文 text", "a"),
]


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(rows):
    """{doc_id: (set size, component)} of (doc_id, text) rows, by all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    places = {i + o for i, w in enumerate(windows) if times[w] > 1 for o in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(places))


def water_fill(sizes, weights=(5, 2, 1), repeats=3):
    """Targets by resharing the excess until no source is above its limit."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        free = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > repeats * sizes[s]]
        if not above:
            return {**full, **share}
        full |= {s: repeats * sizes[s] for s in above}


def draws(spark, rows):
    """The hash that fixes the place of each of the rows (doc_id, text, source) in its source."""
    from pyspark.sql import functions as F
    frame = spark.createDataFrame([(i, d, t or "") for i, (d, t, _) in enumerate(rows)],
                                  "i long, doc_id long, text string")
    alone = F.when(F.col("doc_id").isNull(), F.col("i"))
    drawn = F.xxhash64("doc_id", F.xxhash64("text"), alone, F.lit("mix"))
    return {r["i"]: r["d"] for r in frame.select("i", drawn.alias("d")).collect()}


def mixed_words(rows, draws, slots_per_source, block_words):
    """{row number: words taken} of (doc_id, text, source) rows, slot by slot and word by word.

    A source owes as many whole words as its target, in blocks of equal size of which the last
    may be shorter; so many points of the grid are its own, next to those of the source before.
    The slots of a grid of 2**m points come in van der Corput order, and each gives the next block of
    the source that owns its point. The blocks of all sources must find a point.
    """
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    sources = {}
    for (_, _, s), n in zip(rows, size):
        sources[s] = sources.get(s, 0) + n
    order = sorted((s for s in sources if s is not None)) + ([None] if None in sources else [])
    goal = water_fill(sources)
    quota = {s: min(int(goal[s] + 0.5), 3 * sources[s]) for s in order}
    total = sum(quota.values())
    bits = 0
    while 2 ** bits < max(slots_per_source * len(order), math.ceil(total / block_words) + len(order), 1):
        bits += 1
    block = 1
    while sum(math.ceil(quota[s] / block) for s in order) > 2 ** bits or block * max(1, 2 ** bits - len(order)) < total:
        block += 1
    owner = [s for s in order for _ in range(math.ceil(quota[s] / block))]
    stream, at = {}, {}
    for s in order:
        own = sorted((i for i, r in enumerate(rows) if r[2] == s and size[i]),
                     key=lambda i: (draws[i] % 2 ** 64, rows[i][0] is not None, rows[i][0] or 0, size[i], i))
        stream[s], at[s] = [i for i in own for _ in range(size[i])], 0
    taken = Counter()
    for slot in range(1 << bits):
        point = int(format(slot, f"0{bits}b")[::-1], 2) if bits else 0
        if point < len(owner):
            s = owner[point]
            for _ in range(min(block, quota[s] - at[s])):
                taken[stream[s][at[s] % len(stream[s])]] += 1
                at[s] += 1
    return size, goal, taken
