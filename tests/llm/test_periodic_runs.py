import hashlib
import random
import zlib

from terrafold.llm import periodic_runs as pr
from tests.llm.odd import ODD, documents


def brute(words):
    """Every run by trying each period at each place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def kept(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(seed):
    r = random.Random(seed)
    for _ in range(60):
        alphabet = [b"w%d" % i for i in range(r.choice([1, 2, 3, 50]))]
        words = [r.choice(alphabet) for _ in range(r.randrange(0, 400))]
        for _ in range(r.randrange(0, 3)):  # planted repeats of any period, some inside others
            at, unit = r.randrange(0, len(words) + 1), [r.choice(alphabet) for _ in range(r.randrange(1, 120))]
            words[at:at] = unit * r.randrange(2, 6) + unit[: r.randrange(0, len(unit))]
        yield words


def test_runs_are_those_of_brute_force():
    for words in some_texts(1):
        runs = pr.runs_of(words)
        assert runs == brute(words)
        assert pr.collapsed(words, runs) == kept(words, runs)


def test_long_lags_are_found_word_by_word():
    r = random.Random(2)
    for period in (64, 65, 127, 128, 129, 1000, 2047):
        unit = [b"u%d" % r.randrange(30) for _ in range(period)]
        words = [b"x%d" % i for i in range(r.randrange(0, 99))] + (unit * 5)[: 4 * period + r.randrange(0, period)] + [b"y%d" % i for i in range(40)]
        assert pr.runs_of(words) == brute(words)
    assert pr.runs_of([b"a"] * 70000) == [(0, 70000, 1)]
    assert pr.runs_of([b"a", b"b"] * 6 + [b"c"] + [b"a", b"b"] * 200)[1] == (13, 400, 2)


def test_limits_of_a_run():
    assert pr.runs_of([b"a"] * 5) == []
    assert pr.runs_of([b"a"] * 6) == [(0, 6, 1)]
    assert pr.runs_of([b"a", b"b"] * 3 + [b"a"]) == []
    assert pr.runs_of([b"a", b"b"] * 4) == [(0, 8, 2)]
    assert pr.runs_of([b"a"] * 8) == [(0, 8, 1)]


def test_operator_on_odd_rows(spark):
    got = pr.periodic_runs(documents(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_id[4].runs] == [(0, 60000, 1)] and by_id[4].collapsed == "word"
    assert by_id[1].runs == [] and by_id[1].collapsed == "" and by_id[2].collapsed == "" and by_id[3].collapsed == ""
    assert sum(r.doc_id == 5 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    assert pr.digest(pr.periodic_runs(documents(spark, []))).collect() == []


def test_columns_of_any_name_are_left_out(spark):
    docs = spark.createDataFrame([(1, "a " * 7, 3, 4, 5)], "doc_id long, text string, `a.b` int, `Runs` int, `q``w` int")
    assert pr.digest(pr.periodic_runs(docs)).first()["n_runs"] == 1


def test_query_is_brute_force_on_planted_texts(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, " \n".join(r.choice("abcdefghij") for _ in range(r.randrange(0, 90)))) for i in range(400)] + [(None, "z " * 9), (401, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {row.doc_id: row for row in pr.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        row = got[doc_id]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None, None, None)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept(words, runs)).hexdigest()
