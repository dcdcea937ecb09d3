import random
import re

from terrafold.llm import substring_dedup as S
from tests.llm.odd import ODD, documents


def brute(rows, width=20):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    key = [2**63 if i is None else i for i, _ in docs]
    first = {}
    for n, (_, w) in enumerate(docs):
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            first[k] = min(first.get(k, (2**64, 0)), (key[n], p))
    out = []
    for n, (i, w) in enumerate(docs):
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p : p + width])] < (key[n], p):
                gone |= set(range(p, p + width))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def got(spark, rows, **options):
    return sorted([tuple(r) for r in S.dedup(documents(spark, rows), **options).collect()], key=repr)


def test_the_cover_is_a_difference_cover():
    for shift in range(S.PERIOD):
        assert any((a - b) % S.PERIOD == shift for a in S.COVER for b in S.COVER)


def test_against_brute_force(spark):
    rng = random.Random(2)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(80):
        w = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(120))]
        if rng.random() < 0.6:
            a = rng.randrange(45)
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[a : a + rng.choice([10, 19, 20, 21, 33, 60])]
        if rng.random() < 0.2:
            w = w + w
        rows.append((i * 7 % 80, "\t".join(w)))
    rows += [(200, "la " * 50), (201, "la " * 19), (202, "la " * 20), (203, rows[0][1]), (203, rows[0][1]), (None, rows[1][1]), (None, rows[1][1])]
    rows += [r[:2] for r in ODD if len(r[1] or "") < 1000]
    want = brute(rows)
    for size in (S.GROUP_BYTES, 3000):  # one group, and many
        assert got(spark, rows, group_bytes=size, bucket_bytes=size) == want


def test_long_and_empty(spark):
    rows = got(spark, [(1, "word " * 60000), (2, "x" * 70000)])
    assert [r[1:3] for r in rows] == [(60000, 59999), (1, 0)]
    assert got(spark, []) == []
