import random
import zlib
from collections import Counter

import pytest

from terrafold.llm import spelling
from tests.llm.odd import ODD, documents


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return rows


def some_counts(seed, size, letters, longest):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randrange(4, longest))): r.choice([1, 2, 3, 4, 6, 8, 16, 100]) for _ in range(size)}


def test_automaton_numbers_words_in_order():
    words = sorted(some_counts(1, 500, "abé", 12))
    a = spelling.Automaton(words)
    for number, word in enumerate(words):
        state, at = a.root, 0
        for letter in word:
            state, before = a.step[state][letter]
            at += before
        assert at == number and a.ends[state]
    assert len(a.step) < sum(map(len, words)) / 2
    for word in words[::7]:
        assert {words[i] for i in a.near(word, 0)} == {x for x in words if is_near(word, x)}
        assert {words[i] for i in a.near(word, 2)} == {x for x in words if is_near(word[2:], x[2:]) and x[:2] == word[:2]}


@pytest.mark.parametrize(("shard_letters", "few"), [(100_000, 16), (300, 16), (150, 8)])
def test_variants_are_those_of_brute_force(spark, shard_letters, few):
    """Small shards split the shared halves again and again."""
    counts = some_counts(2, 400, "ab", 9) | some_counts(3, 200, "abcdeé", 8) | {"x" * 3000: 9, "x" * 2999: 4, "x" * 1500 + "y" + "x" * 1499: 3}
    counts |= {"shared" + "".join(p): 3 for p in zip("abcabcabc", "aabbccabc", "xyxyxyxyx", strict=True)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(df, shard_letters=shard_letters, few=few).collect()
    assert len(got) == len({r.word for r in got})
    assert {tuple(r) for r in got} == brute(counts)


def test_odd_rows(spark):
    got = {r.word: r.n for r in spelling.word_counts(documents(spark, ODD)).collect()}
    assert got["word"] == 60000 and got["x" * 70000] == 1 and got["same"] == 3 and got["no"] == 1
    assert spelling.variants(spelling.word_counts(documents(spark, []), slip=97)).collect() == []
    clash = spark.createDataFrame([(1, "seventh seventh seventh", 1, 2, 3)], "doc_id long, text string, `a.b` int, Word int, `q``w` int")
    assert [tuple(r) for r in spelling.variants(spelling.word_counts(clash)).collect()] == [("seventh", None, "seventh", 3, 0, None)]


def test_query_is_brute_force(spark, tmp_path):
    r = random.Random(4)
    stems = ["".join(r.choice("abcdé") for _ in range(r.randrange(4, 8))) for _ in range(60)]
    rows = [(i, " ".join(r.choice(stems).title() + r.choice(["", "!", "9x"]) for _ in range(40))) for i in range(150)] + [(None, "Alone alone ALONE"), (7, None), (8, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling.WORD.findall(text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    assert {tuple(x) for x in spelling.query(spark, str(tmp_path)).collect()} == brute(counts)
