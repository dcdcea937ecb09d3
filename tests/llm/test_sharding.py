import zlib

import numpy as np

from terrafold.llm import sharding as S
from tests.llm.odd import ODD, documents


def test_dot_product_placement_is_balanced_in_all_dimensions():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 100, (3000, 3)).astype(float)
    where = S.place(items, 7, (1, 1, 1))
    loads = np.stack([items[where == k].sum(axis=0) for k in range(7)])
    assert (loads.max(axis=0) / loads.mean(axis=0)).max() < 1.01


def test_every_part_is_balanced_when_bytes_and_tokens_disagree():
    rng = np.random.default_rng(3)
    n = rng.integers(1, 300, 2500).astype(float)
    items = np.stack([n * rng.uniform(2, 12, 2500), n, rng.integers(1, 4, 2500)], axis=1)
    items[:3] *= 30  # items near a fifth of a shard
    where = S.place(items, 24)
    loads = np.stack([items[where == k].sum(axis=0) for k in range(24)])
    assert (loads.max(axis=0) / loads.mean(axis=0)).max() < 1.005 and (loads.min(axis=0) / loads.mean(axis=0)).min() > 0.995
    part = items / (items.sum(axis=0) / 24)
    first = np.argsort(-part.max(axis=1), kind="stable")[:24]
    assert sorted(S.place(items[first], 24)) == list(range(24))  # the dot product gives each of the largest a shard


def test_no_exchange_lowers_what_is_left():
    """Against all moves and exchanges between the two shards, tried one by one."""
    rng = np.random.default_rng(4)
    part = rng.uniform(0.01, 0.3, (40, 3))
    where = rng.integers(0, 4, 40)
    residual = np.stack([1 - part[where == k].sum(axis=0) for k in range(4)])
    left = lambda r: float((np.asarray(S.MOVE_WEIGHTS) * r**2).sum())
    seen = [left(residual)]
    while S._moved(part, where, residual):
        assert np.allclose(residual, [1 - part[where == k].sum(axis=0) for k in range(4)])
        seen.append(left(residual))
    assert all(b < a for a, b in zip(seen, seen[1:], strict=False)) and len(seen) > 3
    for d in range(3):
        a, b = int(residual[:, d].argmin()), int(residual[:, d].argmax())
        for i in np.flatnonzero(where == a):
            for back in (np.zeros(3), *part[where == b]):
                moved = residual.copy()
                moved[a] += part[i] - back
                moved[b] -= part[i] - back
                assert left(moved) >= left(residual) - 1e-9


def test_rows_without_id_and_one_text_are_split(spark):
    got = S.shard(documents(spark, [(None, "hot " * 30)] * 900 + [(i, f"{i} text") for i in range(300)])).toPandas()
    assert got[got.doc_id.isna()].shard.nunique() > 12
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_laws(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"{i} " + "ab " * int(rng.integers(1, 300))) for i in range(1500)]
    rows += [(5000 + i, "copy " * 20) for i in range(40)] + [(6000 + i, "hot " * 60) for i in range(900)] + [r for r in ODD if len(r[1] or "") < 1000]
    got = S.shard(documents(spark, rows)).toPandas()
    assert len(got) == len(rows)
    by = got.groupby("shard")
    assert sorted(by.groups) == list(range(24))
    assert (by["size"].sum().max() / by["size"].sum().mean()) < 1.02
    for _, g in by:
        assert sorted(g.slot) == list(range(len(g)))
    groups = got.groupby("group").shard.nunique()
    texts = dict(rows[:1500])
    copy = got[(got.doc_id >= 5000) & (got.doc_id < 5040)]
    assert copy.shard.nunique() == 1  # a group that fits stays whole
    assert got[(got.doc_id >= 6000) & (got.doc_id < 6900)].shard.nunique() > 1  # one that doesn't is split
    assert groups.max() <= 24
    for i in (0, 17, 1499):
        row = got[got.doc_id == i].iloc[0]
        assert row["size"] == len(texts[i].encode()) + 8 and row.text_crc32 == zlib.crc32(texts[i].encode())


def test_odd_and_empty(spark):
    got = S.shard(documents(spark, ODD)).toPandas()
    assert len(got) == len(ODD) and (got["size"] >= 8).all()
    assert got[got["size"] == 8].text_crc32.eq(0).all()
    assert S.shard(documents(spark, [])).count() == 0
