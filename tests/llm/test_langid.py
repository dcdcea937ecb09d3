import decimal
import itertools
import math
import random

import numpy as np
import pytest

from terrafold.llm import langid as L
from tests.llm.odd import ODD, documents

PIECES = ["▁", "a", "b", "▁a", "ab", "ba", "▁ab", "aba"]


def every_cut(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        yield [*parts, word[at:]]


def brute(word, prob):
    p = dict(zip(PIECES, prob, strict=True))
    return sum(math.prod(max(p.get(x, 0), L.FLOOR) if len(x) == 1 else p.get(x, 0) for x in cut) for cut in every_cut("▁" + word))


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    prob = rng.dirichlet(np.ones(len(PIECES)), 2).T
    words = ["a", "ab", "abab", "bbbaab", "xa", "abaabaab", ""]
    got = L.Lattice(PIECES).forward(words, prob)
    want = [[math.log(brute(w, prob[:, k])) for k in range(2)] for w in words]
    assert np.allclose(got, want)


def test_expected_counts_are_posterior_means():
    rng = np.random.default_rng(2)
    prob = rng.dirichlet(np.ones(len(PIECES)))
    words, weight = ["abab", "bb"], np.array([2.0, 3.0])
    got = L.Lattice(PIECES).expected(words, weight, prob)
    want = np.zeros(len(PIECES))
    p = dict(zip(PIECES, prob, strict=True))
    for w, k in zip(words, weight, strict=True):
        total = brute(w, prob)
        for cut in every_cut("▁" + w):
            q = math.prod(p.get(x, L.FLOOR if len(x) == 1 else 0) for x in cut)
            for x in cut:
                if x in PIECES:
                    want[PIECES.index(x)] += k * q / total
    assert np.allclose(got, want)


def test_texts_are_words_whatever_the_cache_and_length():
    rng = np.random.default_rng(3)
    prob = rng.dirichlet(np.ones(len(PIECES)), 2).T
    scorer = L.Scorer(PIECES, prob)
    texts = ["ab aba", "ab", "aba " * 3 + "ab" * 100]
    one = np.concatenate([L.Scorer(PIECES, prob).texts([t.encode()]) for t in texts])
    assert np.allclose(scorer.texts([t.encode() for t in texts]), one)
    assert np.allclose(scorer.texts([t.encode() for t in texts]), one)
    assert np.isfinite(one).all()


def exact_log(word, prob):
    """ln P(word) by the plain recursion over its ends, in 60 digits."""
    with decimal.localcontext() as c:
        c.prec = 60
        p = {x: decimal.Decimal(float(v)) for x, v in zip(PIECES, prob, strict=True)}
        floor, text = decimal.Decimal(L.FLOOR), "▁" + word
        at = [decimal.Decimal(1)]
        for end in range(1, len(text) + 1):
            spans = ((start, text[start:end]) for start in range(max(0, end - 3), end))
            at.append(sum(at[start] * (max(p.get(x, floor), floor) if len(x) == 1 else p.get(x, 0)) for start, x in spans))
        return at[-1].ln()


def test_long_words_are_scored_and_learned_whole():
    rng = np.random.default_rng(11)
    prob = rng.dirichlet(np.ones(len(PIECES)), 2).T
    words = ["".join(rng.choice(list("abx"), n, p=[0.5, 0.4, 0.1])) for n in (15, 16, 17, 31, 32, 33, 48, 64, 120, 200, 5000)] + ["x" * 300, "ab" * 20]
    got = L.Lattice(PIECES).forward(words, prob)
    assert np.allclose(got, [[float(exact_log(w, prob[:, k])) for k in range(2)] for w in words], rtol=1e-12)
    assert np.allclose(L.Scorer(PIECES, prob).word_scores(words), got, rtol=1e-14)
    one, weight, step = prob[:, 0], [2.0, 1.0, 0.5], 1e-5
    some = [words[i] for i in (4, 7, 9)]
    want = []
    for i in range(len(PIECES)):  # an expected count is the derivative of the log probability by that of the piece
        up, down = one.copy(), one.copy()
        up[i], down[i] = one[i] * (1 + step), one[i] * (1 - step)
        want.append(sum(w * float(exact_log(x, up) - exact_log(x, down)) / (2 * step) for x, w in zip(some, weight, strict=True)))
    assert np.allclose(L.Lattice(PIECES).expected(some, np.array(weight), one), want, atol=1e-6)


def test_very_long_words_and_batches():
    rng = np.random.default_rng(12)
    prob = rng.dirichlet(np.ones(len(PIECES)), 2).T
    words = ["ab" * 30_000, "x" * 70_000, *("ab" * int(k) for k in rng.integers(0, 400, 700))]
    parts = list(L.batches_of(words))
    assert sorted(np.concatenate(parts)) == list(range(len(words)))
    assert all(len(p) == 1 or len(p) * (max(len(words[i]) for i in p) + 1) <= L._CELLS for p in parts)
    got = L.Scorer(PIECES, prob).word_scores(words)
    assert np.isfinite(got).all() and np.isfinite(L.Lattice(PIECES).expected(words[:2], np.ones(2), prob[:, 0])).all()
    assert np.allclose(got[0], [float(exact_log(words[0], prob[:, k])) for k in range(2)], rtol=1e-10)


def test_a_script_without_blanks():
    """Languages that differ only far behind a word's start are told apart."""
    rng = random.Random(13)
    common = "山川水火木金土日月人"
    own = {"p": "春夏秋冬", "q": "東西南北"}
    lattice = L.Lattice(sorted({"▁", *common, *own["p"], *own["q"]}))
    made = {x: ["".join(rng.choices(common, k=40)) + "".join(rng.choices(own[x] + common, k=80)) for _ in range(40)] for x in own}
    langs, prob = L.fit(lattice, {x: dict.fromkeys(w[:20], 1) for x, w in made.items()})
    scorer = L.Scorer(sorted({"▁", *common, *own["p"], *own["q"]}), prob)
    for x, w in made.items():
        assert [langs[k] for k in scorer.texts([t.encode() for t in w[20:]]).argmax(axis=1)] == [x] * 20


def test_repeated_rows_get_the_same_score_to_the_last_digit():
    rng = np.random.default_rng(14)
    prob = rng.dirichlet(np.ones(len(PIECES)), 2).T
    texts = [("".join(rng.choice(list("ab "), 90))).encode() for _ in range(30)]
    a = L.Scorer(PIECES, prob).texts([*texts, texts[0], texts[7]])
    assert (a[30] == a[0]).all() and (a[31] == a[7]).all()


def test_held_out_accuracy_and_odd_rows(spark):
    if not __import__("os").path.exists(L.VOCABULARY):
        pytest.skip("no vocabulary here")
    rng = random.Random(4)
    parts = {"en": "the of and ing tion er", "fr": "le eau eux oi et é", "de": "der sch ung ein und ß"}
    rows = [(i, " ".join("".join(rng.choices(parts[x].split(), k=rng.randint(1, 3))) for _ in range(12)), x) for i in range(240) for x in [rng.choice(sorted(parts))]]
    train = documents(spark, rows[:160])
    got = L.identify(documents(spark, [(i, t, None) for i, t, _ in rows[160:]]), train).collect()
    truth = {i: x for i, _, x in rows}
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    odd = L.identify(documents(spark, ODD), train).collect()
    assert len(odd) == len(ODD)
    und = {r.doc_id for r in odd if r.lang_pred == "und"}
    assert {1, 2, 3, 2**62} <= und and 4 not in und
    assert {r.lang_pred for r in L.identify(documents(spark, ODD), train.where("false")).collect()} == {"und"}
    assert L.identify(documents(spark, []), train).count() == 0
