import random

import numpy as np

from terrafold.llm import toxicity as X
from tests.llm.odd import ODD, documents


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        w = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randrange(5, 60))]
        bad = rng.random() < 0.2
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["Idiot!", "trash", "MORON"])
        if rng.random() < (0.5 if bad else 0.1):  # groups are named more often in toxic texts
            w.append(rng.choice(["women", "muslim", "gay"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad), 1))
    return rows, labels


def test_held_out_and_neutral_mentions(spark):
    rng = random.Random(6)
    rows, labels = corpus(rng, 1500)
    df = documents(spark, rows)
    known = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int, quality int")
    model = X.train(df, known)
    got = {r.doc_id: r for r in X.score(df, model).collect()}
    held = [x for x in labels if x[0] % 5 == 0]
    assert sum(got[i].predicted == bad for i, bad, _ in held) >= 0.97 * len(held)
    neutral = model.scores([b"a meeting of women at noon", b"a meeting of men at noon", b"a meeting at noon"])
    assert abs(neutral[0] - neutral[1]) < 0.02
    free = X.fit(*as_rows(rows, labels), penalty=0.0).scores([b"a meeting of women at noon", b"a meeting of men at noon"])
    assert abs(neutral[0] - neutral[1]) < abs(free[0] - free[1])  # the penalty does that


def test_the_penalty_is_of_score_differences_of_real_swaps():
    rng = np.random.default_rng(1)
    a, b, c, x, y = range(5)  # a, b, c are of one kind
    rows = [[a, x], [b, y], [a, b, x], [x, y], [a, b, c]]
    doc, col = np.repeat(np.arange(5), [len(r) for r in rows]), np.array([i for r in rows for i in r])
    swaps = X.Swaps(doc, col, [np.array([a, b, c])], 5, 5)
    w = rng.normal(size=5)
    z = lambda w: np.array([w[r].sum() + 0.3 for r in rows])

    def plain(w):
        total = 0.0
        for r in rows:
            for term in set(r) & {a, b, c}:
                for other in {a, b, c} - {term}:
                    copy = sorted((set(r) - {term}) | {other})
                    total += float((X.sigmoid(w[r].sum() + 0.3) - X.sigmoid(w[copy].sum() + 0.3)) ** 2)
        return total

    value, by_row, by_weight = swaps.penalty(z(w), w)
    assert abs(value - plain(w)) < 1e-12
    step = 1e-6
    want = [(plain(w + step * np.eye(5)[i]) - plain(w - step * np.eye(5)[i])) / (2 * step) for i in range(5)]
    assert np.allclose(np.bincount(col, by_row[doc], 5) + by_weight, want, atol=1e-8)


def test_neutral_mentions_in_four_languages():
    rng = random.Random(9)
    terms = {"en": ("women", "men"), "de": ("frauen", "männer"), "fr": ("musulmans", "chrétiens"), "es": ("inmigrantes", "ciudadanos")}
    rows, labels = [], []
    for i in range(4000):
        named, other = terms[rng.choice(sorted(terms))]
        bad = rng.random() < 0.3
        words = [f"w{chr(97 + rng.randrange(26))}" for _ in range(10)] + (["idiot"] if bad and rng.random() < 0.6 else [])
        if rng.random() < (0.6 if bad else 0.1):
            words.append(named)
        elif rng.random() < 0.2:
            words.append(other)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    held = as_rows(rows, labels)
    fair, free = X.fit(*held), X.fit(*held, penalty=0.0)
    for named, other in terms.values():
        texts = [f"a meeting of {x} at noon".encode() for x in (named, other)]
        assert abs(np.subtract(*fair.scores(texts))) < min(0.05, 0.3 * abs(np.subtract(*free.scores(texts))))


def test_training_in_the_cluster_gives_the_plain_fit(spark):
    rows, labels = corpus(random.Random(12), 600)
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = X.train(documents(spark, rows), known)
    want = X.fit(*as_rows(rows, labels))
    assert (got.keys == want.keys).all() and np.allclose(got.weights, want.weights, atol=1e-6) and abs(got.bias - want.bias) < 1e-6


def test_copies_are_one_row_of_the_fit(spark, monkeypatch):
    rows, labels = corpus(random.Random(13), 300)
    rows += [(300 + i, rows[3][1] + " women") for i in range(200)]  # copies, some of them toxic
    labels += [(300 + i, int(i % 4 == 0), 1) for i in range(200)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    want, plain, sizes = X.fit(*as_rows(rows, labels)), X.descend, []
    monkeypatch.setattr(X, "descend", lambda keys, doc, col, toxic, *more: sizes.append((len(toxic), len(col))) or plain(keys, doc, col, toxic, *more))
    got, texts = X.train(documents(spark, rows), known), [t.encode() for _, t in rows]
    assert (got.keys == want.keys).all() and np.allclose(got.scores(texts), want.scores(texts), atol=1e-3)  # sums in another order
    assert sizes and sizes[0][0] <= 301


def as_rows(rows, labels):
    doc, key = X.presence([t.encode() for _, t in rows])
    return np.split(key, np.cumsum(np.bincount(doc, minlength=len(rows)))[:-1]), np.array([x[1] for x in labels], float)


def test_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.train(documents(spark, ODD), none)
    got = X.score(documents(spark, ODD), model).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(4, 0), (4, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    assert all(0 <= r.score < 0.5 for r in X.score(documents(spark, ODD), X.train(documents(spark, ODD), one)).collect())
    assert X.score(documents(spark, []), model).count() == 0


def test_a_term_of_two_languages_is_swapped_in_both():
    """"hindus" is English and German."""
    words = np.concatenate([X.word_keys(list(kind)) for kind in X.IDENTITY if "hindus" in kind])
    keys = np.unique(words)
    kinds = [np.searchsorted(keys, X.word_keys(list(kind))) for kind in X.IDENTITY if "hindus" in kind]
    here = np.searchsorted(keys, X.word_keys(["hindus"]))
    swaps = X.Swaps(np.zeros(1, np.int64), here, kinds, 1, len(keys))
    assert len(kinds) == 2 and len(swaps.come) == len(keys) - 1
