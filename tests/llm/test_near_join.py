"""The join against brute force over all pairs."""

import random
import re

from terrafold.llm import near_join as N

DOCS = "doc_id long, text string, lang string, n_shingles long"


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)})) if text else []
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    known = [(i, sets_of(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(known):
        for j, b in known[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in known}


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "en", 7) for i, t in rows], DOCS)
    return N.near_join(df, **options).collect()


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.6:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.8:
            del words[at]
        else:
            words.insert(at, f"more{rng.randrange(10**6)}")
    return " ".join(words)


def test_near_copies_of_one_text_link_as_brute_force_says(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = [(i, edited(rng, base, rng.choice([0, 1, 2, 4, 6, 8, 10, 12]))) for i in range(260)]
    rows += [(1000 + i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    old = N.CHUNK
    N.CHUNK = 16  # several blocks, pure and small
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, rows, group_bytes=20_000, bucket_bytes=20_000)}
    finally:
        N.CHUNK = old
    want = brute(rows)
    assert len({c for _, c in want.values()}) > 70
    assert got == want


def test_edges_of_the_rule_and_odd_rows(spark):
    five = "a b c d e f g h i"  # five shingles
    rows = [(1, five), (2, five.upper()), (3, five + " j"), (4, "x y"), (5, "X\tY"), (6, "x y z"), (7, ""), (8, None), (9, "  \n"), (9, "  \n"), (None, five), (12, "q " * 30000)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in run(spark, rows) if r.doc_id is not None)
    assert got == [(1, 5, 1), (2, 5, 1), (3, 6, 1), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (9, 0, 9), (12, 1, 12)]
    assert [r.component_id for r in run(spark, rows) if r.doc_id is None] == [None]


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert N.near_join(df).columns == ["doc_id", "n_shingles", "component_id"]
    assert N.near_join(df).count() == 0
