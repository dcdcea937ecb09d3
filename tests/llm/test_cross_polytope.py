import numpy as np
import pyarrow as pa

from terrafold.llm import cross_polytope as C

SCHEMA = "vec_id long, embedding array<float>, rank int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0.0) for i, v in rows], SCHEMA)


def exact(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.asarray(v, np.float32) for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in asked:
        s = x @ x[list(ids).index(q)]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))
        out[q] = [int(ids[i]) for i in order[:k]]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r.rank] = r.vec_id
    return {q: [v[k] for k in sorted(v)] for q, v in out.items()}


def test_hadamard_is_orthonormal():
    h = C.hadamard(np.eye(8))
    assert np.allclose(h @ h.T, np.eye(8))
    assert np.allclose(np.linalg.norm(C.turned(np.random.default_rng(0).normal(size=(3, 6)), 1), axis=1) ** 2, (np.random.default_rng(0).normal(size=(3, 6)) ** 2).sum(axis=1))


def test_recall_and_hot_buckets(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(1500, 24)))]
    rows += [(2000 + i, rows[7][1] + rng.normal(size=24) * 0.01) for i in range(300)]  # one hot bucket
    df = frame(spark, rows)
    asked = [i for i, _ in rows if i % 50 == 0]
    got = found(C.search(df, df.where("vec_id % 50 = 0"), chunk_rows=64))
    want = exact(rows, asked, 5)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in asked]) >= 0.9
    assert all(len(v) == 5 for v in got.values())


def scored(x, asked, tables):
    """Pairs that the buckets bring together, as a share of all."""
    probes, pairs = C.probe_rule(len(x), x.shape[1], tables), 0
    for t in range(tables):
        one, two = C.axes(x, t)
        pairs += C.probed(x[asked], t, probes)[:, one, two].sum()
    return pairs / (len(asked) * len(x))


def test_the_share_of_pairs_scored_falls_as_rows_grow_and_recall_holds():
    rng = np.random.default_rng(10)
    shares = []
    for n in (2000, 8000, 32000):
        x = C.unit(rng.normal(size=(n, 64)))
        asked = np.arange(0, n, n // 100)
        shares.append(scored(x, asked, C.TABLES))
        s = x[asked] @ x.T
        s[np.arange(len(asked)), asked] = -2
        top, met = np.argsort(-s, axis=1)[:, :5], np.zeros(s.shape, bool)
        for t in range(C.TABLES):
            one, two = C.axes(x, t)
            met |= C.probed(x[asked], t, C.probe_rule(n, 64, C.TABLES))[:, one, two]
        assert np.take_along_axis(met, top, 1).mean() >= 0.9
    assert shares[0] < 0.5 and shares[1] < 0.75 * shares[0] and shares[2] < 0.75 * shares[1]


def test_every_row_is_in_one_block_of_a_table_and_meets_whoever_probes_it(spark):
    rng = np.random.default_rng(16)
    x = rng.normal(size=(400, 16)) + np.where(np.arange(400)[:, None] % 3 == 0, 40 * np.eye(16)[3], 0)  # a heavy bucket
    df = frame(spark, list(enumerate(x)))
    rows = C.usable(df)
    blocks = C.Blocks(400, 16, 8)
    for r in C.codes(rows, 2, 16).groupBy("tab", "first", "second").count().where(f"count > {blocks.limit}").collect():
        blocks.heavy[r["tab"], r["first"], r["second"]] = -(-r["count"] // blocks.heavy_rows)
    assert blocks.heavy and blocks.groups > 1
    index = C.indexed(rows, 2, blocks).toPandas()
    asking = C.asking(rows, 2, 30, blocks).toPandas()
    assert len(index) == 800
    u = C.unit(np.asarray(x, np.float32).astype(float))
    want = {(q, v, t) for t in range(2) for q, v in zip(*np.nonzero(C.probed(u, t, 30)[:, C.axes(u, t)[0], C.axes(u, t)[1]]), strict=True)}
    both = index.merge(asking, on=["block", "part"], suffixes=("", "_q"))
    hit = [bool(np.unpackbits(np.frombuffer(p, np.uint8))[s]) for p, s in zip(both.probed, both.second, strict=True)]
    got = list(zip(both.vec_id_q[hit], both.vec_id[hit], both.block[hit] // (2 * 32 * 32), strict=True))
    assert len(got) == len(set(got)) and set(got) == want


def test_an_id_with_many_vectors_is_one_candidate(spark):
    rng = np.random.default_rng(17)
    base = rng.normal(size=8)
    rows = [(0, base)] + [(1, base + rng.normal(size=8) * 0.001) for _ in range(60)] + [(i, base + rng.normal(size=8)) for i in range(2, 30)]
    got = found(C.search(frame(spark, rows), frame(spark, rows[:1]), chunk_rows=16))
    assert got[0][0] == 1 and len(set(got[0])) == 5


def test_scores_do_not_depend_on_the_blocks():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 64)).astype(np.float32).astype(float)
    x[450:] = x[:450]  # two ids for each vector
    every = np.packbits(np.ones(8, bool)).tobytes()
    asked = np.arange(0, 400, 7)
    queries = pa.table({"vec_id": asked + 10_000, "emb": list(x[asked]), "probed": [every] * len(asked)})

    def met(ids):
        out = C.best_in_block(64, 6)(pa.table({"vec_id": ids, "emb": list(x[ids]), "second": np.zeros(len(ids), np.int32)}), queries)
        return dict(zip(zip(out["query_id"].to_pylist(), out["vec_id"].to_pylist(), strict=True), out["score"].to_pylist(), strict=True))

    whole = met(np.arange(900))
    for q in asked + 10_000:
        ranked = sorted((-score, v) for (w, v), score in whole.items() if w == q)
        assert [v + 450 for _, v in ranked[::2]] == [v for _, v in ranked[1::2]]  # equal vectors have equal scores
    for parts in (2, 3, 7, 50):
        merged = {}
        for p in range(parts):
            merged |= met(np.arange(p, 900, parts))
        assert all(merged[pair] == score for pair, score in whole.items())


def test_odd_rows_ties_and_few_candidates(spark):
    rows = [(0, [1, 0, 0]), (50, [0, 1, 0]), (3, [1, 0, 0]), (2, [1, 0, 0]), (2, [1, 0, 0]), (4, [-1, 0, 0]), (5, None), (6, []), (100, [0, 0, 0]), (7, [1, None, 0]), (8, [float("nan"), 0, 1]), (9, [float("inf"), 0, 1]), (None, [1, 1, 1]), (10, [1, 2, 3, 4]), (150, [1e-38, 0, 0])]
    df = frame(spark, rows)
    got = found(C.search(df, df.where("vec_id % 50 = 0"), probes=1, tables=1))
    assert got == {0: [2, 3, 150, 50, 4], 50: [0, 2, 3, 4, 150], 150: [0, 2, 3, 50, 4]}
    assert C.search(df.where("false"), df).count() == 0
    assert C.search(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0
