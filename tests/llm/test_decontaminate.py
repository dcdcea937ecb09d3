import random
import re

from terrafold.llm import decontaminate as D
from tests.llm.odd import ODD, documents


def words(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            b = words(text)
            k = min(window, len(b))
            wins = {tuple(b[j : j + k]) for j in range(len(b) - k + 1)} if k else set()
            for j in range(len(w) - k + 1):
                if k and tuple(w[j : j + k]) in wins:
                    hit |= set(range(j, j + k))
                    found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    items = [(k, " ".join(rng.choice("ab c D ee f".split()) for _ in range(rng.choice([1, 4, 9, 10, 14, 30])))) for k in range(12)] + [(50, "..."), (51, None), (None, "a b c"), (3, "ab c D ee f ab c D ee f ab ab")]
    docs = [(i, ", ".join(rng.choice("ab c D ee f zz".split()) for _ in range(rng.randrange(200)))) for i in range(60)] + [(100 + k, f"<< {t} >>") for k, t in items if t and k is not None] + [r[:2] for r in ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, docs)
    # one automaton; several, one after the other; and several passes with what was found written between
    for sizes in ({}, {"block_bytes": 60}, {"block_bytes": 60, "group_bytes": 400}, {"block_bytes": 60, "pass_bytes": 300}):
        got = D.decontaminate(df, bench, **sizes)
        assert set(df.columns) <= set(got.columns)
        rows = sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got.collect()], key=repr)
        assert rows == sorted(brute(docs, [x for x in items if x[0] is not None]), key=repr)


def test_spans_are_bytes_of_the_original(spark):
    bench = spark.createDataFrame([(1, "Über alles, was GUT ist")], "item_id long, text string")
    text = "¡Hm! Über -- alles; was gut ist. Über"
    row = D.decontaminate(documents(spark, [(1, text)]), bench, window=5).first()
    assert [text.encode()[s.start : s.stop].decode() for s in row.spans] == ["Über -- alles; was gut ist"]


def test_stretches_lie_in_every_window():
    for window in range(1, 30):
        length, step = D.stretch(window)
        assert 1 <= length <= window
        for first in range(2 * window):
            assert any(first <= at and at + length <= first + window for at in range(0, 4 * window, step)), (window, first)


def test_other_windows_than_ten(spark):
    rng = random.Random(7)
    items = [(k, " ".join(rng.choice("a b c d".split()) for _ in range(rng.randrange(1, 25)))) for k in range(8)]
    docs = [(i, " ".join(rng.choice("a b c d e".split()) for _ in range(60))) for i in range(40)]
    for window in (1, 2, 3, 5, 13):
        got = D.decontaminate(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), window=window).collect()
        assert sorted((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got) == sorted(brute(docs, items, window))


def test_the_automaton_has_about_two_nodes_a_sign():
    rng = random.Random(9)
    text = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40_000)).encode()
    bench = D.Bench([("x", text)], D.BLOCK_BYTES)
    nodes = bench.matcher(0, 10).machine.get_stats()["nodes_count"]
    assert bench.signs == 3 and nodes < 2 * 3 * 40_000
    small = D.Bench([(str(i), text[: len(text) // 2]) for i in range(3)] + [("y", text[len(text) // 2 :])], len(text) // 2)
    assert len(small.blocks) - 1 >= 4
    for b in range(4):
        small.matcher(b, 10)
    assert len(D._MADE) == 1  # one at a time


def test_clashing_names_in_any_case(spark):
    from pyspark.sql import functions as F

    names = ["_words", "_hits", "N_hit", "Items", "_aside", "first", "p"]
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string").select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    row = D.decontaminate(df, bench).first().asDict()
    assert row["n_hit"] == 2 and row["items"] == ["1"] and "N_hit" not in row and "Items" not in row
    assert all(row[n] == n for n in names if n not in ("N_hit", "Items"))


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in D.decontaminate(documents(spark, ODD), bench).collect()] == [0] * len(ODD)
    assert D.decontaminate(documents(spark, []), bench).count() == 0
