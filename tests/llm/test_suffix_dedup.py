import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from terrafold.llm import suffix_dedup as sd
from tests.llm.odd import ODD, documents


def brute(rows):
    """doc_id, n_bytes, removed runs and kept bytes of each row, from a table of all windows."""
    last = 2**63 - 1
    texts = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in texts:
        for i in range(len(t) - 49):
            w = t[i : i + 50]
            first[w] = min(d, first.get(w, d))
    out = []
    for (doc_id, _), (d, t) in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        runs, i = [], 0
        while i < len(t):
            if gone[i]:
                j = i
                while j < len(t) and gone[j]:
                    j += 1
                runs.append((i, j))
                i = j
            i += 1
        out.append((doc_id, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, [tuple(x) for x in r.removed], bytes(r.kept)) for r in df.collect()), key=repr)


def some_rows(seed, n=60):
    r = random.Random(seed)
    text = lambda k, letters: "".join(r.choice(letters) for _ in range(k))
    shared = [text(k, "abc é") for k in (30, 49, 50, 51, 66, 120, 400)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(0, 6)):
            s = r.choice(shared)
            a = r.randrange(0, len(s))
            parts += [text(r.randrange(0, 40), "abcdefgh  漢"), r.choice([s, s[a:], s[:a]])]
        rows.append((i * 3 - 50 if i % 9 else i, "".join(parts)))
    return rows + [(1000, rows[7][1]), (None, rows[7][1]), (None, rows[8][1]), (-99, "a" * 300), (4, "a" * 120), (5, None), (6, ""), (7, "aa" * 24 + "b")]


@pytest.mark.parametrize(("group_bytes", "hot"), [(1 << 20, 1 << 20), (600, 1 << 20), (600, 2), (1 << 20, 0)])
def test_removal_is_that_of_brute_force(spark, group_bytes, hot):
    rows = some_rows(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sd.dedup(df, group_bytes=group_bytes, bucket_bytes=4000, hot=hot)) == brute(rows)


def test_prefix_classes_are_those_of_sorted_suffixes():
    r = np.random.default_rng(2)
    for letters, n, least in ((2, 300, 5), (1, 90, 50), (4, 2000, 9), (20, 500, 50), (3, 1, 50)):
        text = r.integers(97, 97 + letters, n).astype(np.uint8)
        text[n // 2 :] = text[: n - n // 2]  # a long repeat
        text, n = np.append(text, np.uint8(255)), n + 1
        order, border = sd.prefix_classes(text, least)
        raw = text.tobytes()
        assert sorted(order.tolist()) == list(range(n))
        heads = [raw[i : i + least] for i in order.tolist()]
        assert heads == sorted(heads)
        for k in range(1, n):
            a, b = raw[order[k - 1] :][:least], raw[order[k] :][:least]
            assert border[k] == (a != b), (k, a, b)


def test_equal_windows_have_their_anchor_at_the_same_place():
    r = random.Random(3)
    window = bytes(r.randrange(97, 102) for _ in range(sd.WINDOW))
    seen = set()
    for k in range(5):
        raw = np.frombuffer(bytes(r.randrange(97, 102) for _ in range(17 * k)) + window + b"tail", np.uint8)
        anchor, _ = sd.least_grams(raw)
        seen.add(int(anchor[17 * k]) - 17 * k)
    assert len(seen) == 1


def test_a_hot_line_is_dealt_to_many_buckets():
    """The windows over the end of a line that every text holds go by more than the line's own bytes."""
    r = random.Random(4)
    rows = [(i, "the line that every one of these texts has in it as a notice" + "".join(r.choice("abcdefghij") for _ in range(60))) for i in range(2000)]
    group = sd.Group(pa.table({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])}), 6)
    bounds = sd.slices(group.anchors, 6)
    mask = lambda hot: {b: np.packbits(np.concatenate([np.ones(n, bool), np.full(n, hot)])).tobytes() for b, n in enumerate(np.diff(bounds))}
    largest = []
    for hot in (False, True):
        group.pieces(mask(hot))
        largest.append(max(np.unique(group.deal, return_counts=True)[1]))
    assert largest[0] > 1900 and largest[1] < 1000, largest


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in ODD if len(r[1] or "") < 200]
    assert got(sd.dedup(documents(spark, rows))) == brute(rows)
    assert sd.dedup(documents(spark, [])).collect() == []
    out = {r.doc_id: r for r in sd.dedup(documents(spark, [*ODD, (9, "word " * 60000), (2**40, "x" * 69999 + "y")])).collect()}
    assert out[9].n_removed == out[9].n_bytes == 300000 and out[4].n_removed == 0
    assert out[2**40].n_removed == 69999 and bytes(out[2**40].kept) == b"y"
    clash = spark.createDataFrame([(1, "q" * 60, 3, 4, 5), (2, "q" * 60, 3, 4, 5)], "doc_id long, text string, `a.b` int, Grp int, `q``w` int")
    assert sorted((r.doc_id, r.n_removed) for r in sd.dedup(clash).collect()) == [(1, 0), (2, 60)]


def test_query_digests_what_is_kept(spark, tmp_path):
    rows = some_rows(5)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((d, n, k, len(runs), hashlib.sha256(kept).hexdigest()) for d, n, k, runs, kept in brute(rows)), key=repr)
    assert sorted((tuple(r) for r in sd.query(spark, str(tmp_path)).collect()), key=repr) == want
