import hashlib
import math
import re

import numpy as np
from pyspark.sql import functions as F

from terrafold.llm import mixing as M
from tests.llm.odd import ODD, documents


def reshared(sizes, weights):
    """Round by round: what is above goes to the others by weight."""
    out, left, free = [0.0] * len(sizes), 1.5 * sum(sizes), set(range(len(sizes)))
    while left > 1e-9 and free:
        total = sum(weights[i] for i in free)
        add = {i: left * weights[i] / total for i in free}
        left = 0.0
        for i, a in add.items():
            out[i] += a
            if out[i] >= 2 * sizes[i]:
                left += out[i] - 2 * sizes[i]
                out[i] = 2.0 * sizes[i]
                free.discard(i)
    return out


def test_targets_are_what_resharing_gives():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = rng.integers(0, 1000, rng.integers(1, 9)).tolist()
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        assert np.allclose(M.targets(sizes, weights), reshared(sizes, weights))


def test_split_tree_keeps_every_quota_and_balances_shards():
    blocks = np.array([1000, 0, 7, 333])
    tree = M.split_tree(blocks, 24, 0)
    assert (tree.sum(axis=0) == blocks).all()
    assert np.ptp(tree.sum(axis=1)) <= 5
    assert (tree == M.split_tree(blocks, 24, 0)).all() and (tree != M.split_tree(blocks, 24, 1)).any()


def test_draws_follow_the_hypergeometric_distribution():
    for good, total, drawn in ((5, 20, 8), (1, 7, 3), (30, 31, 4), (0, 9, 4), (9, 9, 4), (400, 1000, 500)):
        below, lo = 0.0, max(0, drawn - total + good)
        for k in range(lo, min(good, drawn) + 1):
            p = math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn)
            if p > 1e-9:
                assert M.hypergeometric(good, total, drawn, below + p / 2) == k
            below += p
    big = [M.hypergeometric(3 * 10**9, 10**10, 5 * 10**9, (i + 0.5) / 200) for i in range(200)]
    assert abs(np.mean(big) / (1.5 * 10**9) - 1) < 1e-5 and big == sorted(big)
    u = [M.uniform(0, i, i + 1, 2) for i in range(2000)]
    assert 0 <= min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.03


def brute(rows, shards, block, seed):
    """Word by word: (id, text) -> the words that each shard takes in each turn, in the order of the line."""
    names = sorted({r[3] for r in rows}, key=lambda x: (x is None, x))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for i, r in enumerate(rows)}
    lines = {}
    for s in names:
        own = [i for i, r in enumerate(rows) if r[3] == s]

        def place(i):
            text = hashlib.md5((rows[i][1] or "").encode()).hexdigest()
            return hashlib.md5(f"mix:{'' if rows[i][0] is None else rows[i][0]}:{text}".encode()).hexdigest()

        lines[s] = [(i, w) for i in sorted(own, key=place) for w in range(size[i])]
    goal = reshared([len(lines[s]) for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    length = [min(2 * len(lines[s]), math.floor(t + 0.5)) for s, t in zip(names, goal, strict=True)]
    tree = M.split_tree(np.array([-(-n // block) for n in length]), shards, seed)
    out = {}
    for k, s in enumerate(names):
        blocks = [(lines[s] * 2)[at : min(at + block, length[k])] for at in range(0, length[k], block)]
        turns = [[p // max(1, len(lines[s])) for p in range(at, min(at + block, length[k]))] for at in range(0, length[k], block)]
        at = 0
        for shard in range(shards):
            for b in range(at, at + tree[shard, k]):
                for (i, w), turn in zip(blocks[b], turns[b], strict=True):
                    out.setdefault((i, turn, shard), []).append(w)
            at += tree[shard, k]
    return out


def test_pieces_are_the_blocks_that_the_tree_gives_each_shard(spark):
    rng = np.random.default_rng(15)
    rows = [(i, " ".join(f"w{k}" for k in range(int(rng.integers(0, 90)))), "en", [None, "a", "b", "ü"][int(rng.integers(0, 4))]) for i in range(120)]
    rows += [(None, f"no id here {i}", "en", "b") for i in range(5)]
    got = M.mix(documents(spark, rows), shards=5, block_words=40, seed=3).select("doc_id", "text", "taken", "pieces").collect()
    have = {(r.doc_id, r.text, p.turn, p.shard): list(range(p.start, p.stop)) for r in got for p in r.pieces}
    want = {(rows[i][0], rows[i][1], turn, shard): w for (i, turn, shard), w in brute(rows, 5, 40, 3).items()}
    assert have == want
    assert {(r.doc_id, r.text): r.taken for r in got if r.taken} == {k: sum(len(v) for q, v in want.items() if q[:2] == k) for k in {q[:2] for q in want}}


def test_laid_out_rows_are_the_pieces_shuffled_by_shard(spark):
    rows = [(i, "  ".join(f"w{i}.{k}" for k in range(i % 60)) + " ", "en", "ab"[i % 2]) for i in range(200)]
    mixed = M.mix(documents(spark, rows), shards=4, block_words=64)
    assert M.lay_out(mixed).columns == [c for c in mixed.columns if c not in (*M.RESULTS, "shard")] + ["shard", "turn", "start", "stop"]
    out = M.lay_out(mixed).toPandas()
    texts = dict(r[:2] for r in rows)
    want = {(r.doc_id, p.turn, p.shard): (p.start, p.stop, p.order) for r in mixed.collect() for p in r.pieces}
    assert {(r.doc_id, r.turn, r.shard) for r in out.itertuples()} == set(want) and len(out) == len(want)
    for r in out.itertuples():
        words = texts[r.doc_id].split()
        whole = r.stop - r.start == len(words)
        assert r.text == (texts[r.doc_id] if whole else " ".join(words[r.start : r.stop]))
    for _, g in out.groupby("shard"):  # in a task, a shard's rows stand in the drawn order, not by id
        assert list(g.doc_id) != sorted(g.doc_id)


def test_names_that_clash(spark):
    names = ["key", "cell", "H", "at", "inside", "offset", "runs", "Size", "PIECES", "words", "_aside", "p"]
    df = documents(spark, [(1, "a b c", "en", "s"), (2, "d", "en", None)]).select("doc_id", "text", "source", *[F.lit(n).alias(n) for n in names])
    got = M.mix(df)
    assert got.columns == ["doc_id", "text", "source", *[n for n in names if n not in ("Size", "PIECES")], *M.RESULTS]
    assert all(r[n] == n for r in got.collect() for n in names if n not in ("Size", "PIECES"))
    assert all(r["key"] == "key" and r["_aside"] == "_aside" for r in M.lay_out(got).collect())


def test_rows_and_sources(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 200)), "en", f"s{rng.integers(0, 5) if i % 2 else 0}") for i in range(400)] + [r for r in ODD if len(r[1] or "") < 1000]
    df = documents(spark, rows)
    got = M.mix(df, shards=6, block_words=50)
    assert set(df.columns) <= set(got.columns)
    pdf = got.toPandas()
    assert len(pdf) == len(rows)
    assert (pdf.taken <= 2 * pdf["size"]).all()
    assert pdf["size"].tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in pdf.text]
    for _, g in pdf.fillna({"source": "?"}).groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 0.5
    pieces = got.select("source", "doc_id", F.explode("pieces").alias("p")).select("source", "doc_id", "p.*").toPandas()
    assert set(pieces.shard) <= set(range(6)) and (pieces.stop > pieces.start).all()
    again = M.mix(documents(spark, rows[::-1]), shards=6, block_words=50).toPandas()
    assert sorted(zip(pdf.doc_id.fillna(-1), pdf.taken, strict=True)) == sorted(zip(again.doc_id.fillna(-1), again.taken, strict=True))


def test_empty(spark):
    assert M.mix(documents(spark, [])).count() == 0
    assert M.mix(documents(spark, [(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0
