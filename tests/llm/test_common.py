import random
import re

import numpy as np

from terrafold.llm import common as C


def test_word_hashes_and_places():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab cde éf ghij \x0b".split(" ")) for _ in range(rng.randrange(60))) for _ in range(80)] + ["", " \n", "x" * 300_000, "tail\x1fword"]
    w = C.Words([t.encode() for t in texts])
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    flat = [x for ws in words for x in ws]
    assert w.count.tolist() == [len(x) for x in words]
    assert [w.data[a:b].decode() for a, b in zip(w.start, w.end, strict=True)] == flat
    for width in (1, 2, 3, 5, 8, 20):
        for which in (0, 1):
            seen = {}
            h = C.window_hash(w.hash, width, which)
            for i in range(len(flat) - width + 1):
                assert seen.setdefault(tuple(flat[i : i + width]), h[i]) == h[i]
            assert len(set(seen.values())) == len(seen)


def test_slices_cover_sorted_values():
    v = np.sort(C.mix64(np.arange(1000, dtype=np.uint64)))
    b = C.slices(v, 5)
    assert b[0] == 0 and b[-1] == 1000 and len(b) == 33
    assert all((v[b[i] : b[i + 1]] >> np.uint64(59) == i).all() for i in range(32))


def test_components_of_a_path_a_star_and_pairs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (200, 201)]
    got = dict(C.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert C.components(spark.createDataFrame([], "u long, v long")).count() == 0
