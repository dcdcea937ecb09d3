"""The fit in the cluster against one in a single place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.operators import head


def rows_of(n, dim, classes, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    x = rng.normal(size=(n, dim)) + 0.8 * rng.normal(size=(classes, dim))[y]
    fold = rng.choice(["train", "val", "test"], n, p=[0.6, 0.2, 0.2])
    return x, y * 3 + 1, fold


def plain(x, label, fold, hidden, epochs, patience, lr=0.05, decay=1e-4):
    classes = np.unique(label)
    y = np.searchsorted(classes, label)
    t, v = fold == "train", fold == "val"
    mean, sd = x[t].mean(0), x[t].std(0) + 1e-6
    z = (x - mean) / sd
    rng = np.random.default_rng(42)
    sizes = [x.shape[1], *([hidden] if hidden else []), len(classes)]
    params = []
    for a, b in zip(sizes, sizes[1:], strict=False):
        params += [rng.uniform(-1, 1, (a, b)) / np.sqrt(a), rng.uniform(-1, 1, b) / np.sqrt(a)]
    weight = 1.0 / np.bincount(y[t])[y[t]]
    weight /= weight.sum()

    def scores(ps, z):
        h = z @ ps[0] + ps[1]
        return np.maximum(h, 0) @ ps[2] + ps[3] if hidden else h

    def f1(ps, where):
        said, out = scores(ps, z[where]).argmax(1), []
        for c in range(len(classes)):
            tp, real, told = ((said == c) & (y[where] == c)).sum(), (y[where] == c).sum(), (said == c).sum()
            if real:
                p, r = tp / told if told else 0.0, tp / real
                out.append(round(2 * p * r / (p + r) if p + r else 0.0, 3))
        return float(np.mean(out))

    m, s, best, top, bad = [0.0] * len(params), [0.0] * len(params), params, -1.0, 0
    for k in range(1, epochs + 1):
        e = np.exp(scores(params, z[t]) - scores(params, z[t]).max(1, keepdims=True))
        g = e / e.sum(1, keepdims=True)
        g[np.arange(t.sum()), y[t]] -= 1
        g *= weight[:, None]
        if hidden:
            h = np.maximum(z[t] @ params[0] + params[1], 0)
            back = (g @ params[2].T) * (h > 0)
            grads = [z[t].T @ back, back.sum(0), h.T @ g, g.sum(0)]
        else:
            grads = [z[t].T @ g, g.sum(0)]
        new = []
        for i, (p, q) in enumerate(zip(params, grads, strict=True)):
            q = q + decay * p
            m[i], s[i] = 0.9 * m[i] + 0.1 * q, 0.999 * s[i] + 0.001 * q * q
            new.append(p - lr * (m[i] / (1 - 0.9**k)) / (np.sqrt(s[i] / (1 - 0.999**k)) + 1e-8))
        params = new
        now = f1(params, v)
        best, top, bad = (params, now, 0) if now > top else (best, top, bad + 1)
        if bad >= patience:
            break
    means = np.stack([z[t][y[t] == c].mean(0) for c in range(len(classes))])
    precision = np.linalg.inv(np.cov(z[t] - means[y[t]], rowvar=False) + 1e-3 * np.eye(x.shape[1]))
    d = np.min([(((z[v] - c) @ precision) * (z[v] - c)).sum(1) for c in means], axis=0)
    return best, top, f1(best, fold == "test"), precision, np.quantile(d, 0.975)


@pytest.mark.parametrize(("arch", "part_bytes"), [("linear", 1 << 26), ("mlp", 1 << 10)])
def test_the_fit_is_that_of_one_place(spark, arch, part_bytes):
    x, label, fold = rows_of(400, 6, 4, 1)
    df = spark.createDataFrame([(a.tolist(), int(b), str(c)) for a, b, c in zip(x, label, fold, strict=True)], "embedding array<double>, label int, fold string")
    df = df.unionByName(df.limit(3).withColumn("fold", F.lit("unused")))
    got = head.train(df, arch, hidden=5, epochs=12, patience=6, part_bytes=part_bytes)
    best, val, test, precision, threshold = plain(x, label, fold, 5 if arch == "mlp" else 0, 12, 6)
    assert got.classes == [1, 4, 7, 10] and got.report == {"val_macro_f1": pytest.approx(val), "test_macro_f1": pytest.approx(test)}
    for a, b in zip([p for layer in got.layers for p in layer], best, strict=True):
        assert np.abs(a - b).max() < 1e-9
    assert np.abs(got.precision - precision).max() < 1e-9 and got.threshold == pytest.approx(threshold, rel=1e-9)


def test_a_ragged_embedding_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], 0, "train"), ([1.0], 1, "train"), ([1.0, 2.0], 0, "val"), ([1.0, 2.0], 0, "test")], "embedding array<double>, label int, fold string")
    with pytest.raises(Exception, match="numbers"):
        head.train(df, epochs=1)


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 1000):
        values = np.round(rng.normal(size=n), 2)
        df = spark.createDataFrame([(float(v),) for v in values], "d double")
        for q in (0.0, 0.5, 0.975, 1.0):
            assert head.upper_quantile(df, "d", q) == pytest.approx(float(np.quantile(values, q)))
