"""Classifier head and novelty: moments, gradients and distances as sums over tasks, scoring in tasks.

Means, deviations, gradients, class means and covariances come from partial sums, so a fit takes any number of rows: each
step is one pass over a kept table, and the driver gets sums of the model's size, `GROUPS` of them at most."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_moments(df: DataFrame, emb: str = "embedding") -> DataFrame:
    """pos, mean, sd (population, + 1e-6) of each element."""
    rows = df.select(F.posexplode(emb).alias("pos", "v")).withColumn("v", F.col("v").cast("double"))
    return rows.groupBy("pos").agg(F.avg("v").alias("mean"), (F.stddev_pop("v") + 1e-6).alias("sd"))


def constant(values: np.ndarray | list) -> Column:
    """A vector or matrix as one literal, which stays small in the plan while it is built."""
    values = np.asarray(values, float)
    return F.from_json(F.lit(json.dumps(values.tolist())), "array<double>" if values.ndim == 1 else "array<array<double>>")


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def standardise(emb: Column | str, mean: list[float], sd: list[float]) -> Column:
    e = F.col(emb) if isinstance(emb, str) else emb
    return F.zip_with(F.zip_with(e, constant(mean), lambda v, m: v - m), constant(sd), lambda v, s: v / s)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0e0), lambda acc, v: acc + v)


def linear_scores(x: Column, weights: list[list[float]], bias: list[float]) -> Column:
    return F.zip_with(once(x, lambda v: F.transform(constant(weights), lambda row: dot(v, row))), constant(bias), lambda s, b: s + b)


def softmax(scores: Column) -> Column:
    e = once(scores, lambda v: once(F.array_max(v), lambda top: F.transform(v, lambda s: F.exp(s - top))))
    return once(e, lambda v: once(F.aggregate(v, F.lit(0e0), lambda acc, y: acc + y), lambda total: F.transform(v, lambda y: y / total)))


def mahalanobis(z: Column, means: list[list[float]], precision: np.ndarray) -> Column:
    """Least squared distance to the class means under one shared precision matrix, which must be positive definite: it is
    the plain distance after a product with the matrix's root, so a row meets the matrix once and not once a class."""
    root = np.linalg.cholesky(np.asarray(precision, float)).T
    centres = constant(np.asarray(means, float) @ root.T)
    placed = once(z, lambda v: F.transform(constant(root), lambda row: dot(v, row)))

    def squared(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0e0), lambda acc, v: acc + v)

    return once(placed, lambda v: F.array_min(F.transform(centres, lambda m: squared(v, m))))


def ood_score(distance: Column, threshold: float) -> Column:
    """0 to 1; 0.5 at the threshold."""
    return F.greatest(F.lit(0e0), F.least(distance / threshold, F.lit(2e0))) / 2


def gaussian_fit(df: DataFrame, classes: list[int], dim: int, eps: float = 1e-3, emb: str = "embedding", label: str = "label") -> tuple[np.ndarray, np.ndarray]:
    """Class means and the inverse of the pooled within-class covariance, from per-task sums of outer products."""
    index = {c: i for i, c in enumerate(classes)}

    def partial(pdfs):
        n, s, ss = np.zeros(len(classes)), np.zeros((len(classes), dim)), np.zeros((dim, dim))
        for pdf in pdfs:
            if len(pdf):
                x, y = np.stack(pdf[emb]).astype(float), pdf[label].map(index).to_numpy()
                n += np.bincount(y, minlength=len(classes))
                np.add.at(s, y, x)
                ss += x.T @ x
        import pandas as pd

        yield pd.DataFrame({"sums": [np.concatenate([n, s.ravel(), ss.ravel()]).tolist()]})

    k = len(classes)
    parts = df.where(F.col(label).isin(classes)).select(emb, label).mapInPandas(partial, "sums array<double>")
    sums = parts.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toPandas()["v"].to_numpy()
    n, s, ss = sums[:k], sums[k : k + k * dim].reshape(k, dim), sums[k + k * dim :].reshape(dim, dim)
    if (n == 0).any():
        raise ValueError(f"no training rows of classes {[c for c, k in zip(classes, n, strict=True) if k == 0]}")
    means = s / n[:, None]
    scatter = ss - (means * n[:, None]).T @ means
    return means, np.linalg.inv(scatter / (n.sum() - 1) + eps * np.eye(dim))


@dataclass
class Head:
    classes: list[int]
    mean: np.ndarray
    sd: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]
    means: np.ndarray
    precision: np.ndarray
    threshold: float
    report: dict = field(default_factory=dict)

    def probabilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class probabilities and novelty of raw embeddings."""
        z = (x - self.mean) / self.sd
        d = np.min([(((z - m) @ self.precision) * (z - m)).sum(1) for m in self.means], axis=0)
        return _softmax(_forward(self.layers, z)[-1]), np.clip(d / self.threshold, 0, 2) / 2

    def to_row(self) -> dict:
        """Plain lists, for a checkpoint of one row."""
        return {
            "classes": self.classes,
            "mean": self.mean.tolist(),
            "sd": self.sd.tolist(),
            "layers": [{"w": w.ravel().tolist(), "b": b.tolist()} for w, b in self.layers],
            "means": self.means.ravel().tolist(),
            "precision": self.precision.ravel().tolist(),
            "threshold": self.threshold,
        }

    @classmethod
    def from_row(cls, row: dict) -> Head:
        d, k = len(row["mean"]), len(row["classes"])
        layers = [(np.array(x["w"]).reshape(-1, len(x["b"])), np.array(x["b"])) for x in row["layers"]]
        return cls(list(row["classes"]), np.array(row["mean"]), np.array(row["sd"]), layers, np.array(row["means"]).reshape(k, d), np.array(row["precision"]).reshape(d, d), row["threshold"])


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _forward(layers: list, x: np.ndarray) -> list[np.ndarray]:
    out = [x]
    for i, (w, b) in enumerate(layers):
        x = x @ w + b
        x = np.maximum(x, 0) if i < len(layers) - 1 else x
        out.append(x)
    return out


#: Power of a class's row count by which its rows count less in the loss; `train` sets the scale.
SCHEMES = {"balanced": 1.0, "sqrt": 0.5}


def loss_weights(counts: np.ndarray, scheme: str) -> np.ndarray:
    return np.maximum(counts, 1.0) ** -SCHEMES.get(scheme, 0.0)


#: Rows of the kept table that one task takes, in bytes, and how many sums the driver gets.
PART_BYTES, GROUPS = 64 << 20, 16


class Table:
    """Embeddings with class number and fold (0 train, 1 validation, 2 test), kept where the executors are, and sums over it."""

    def __init__(self, rows: DataFrame, classes: list[int], folds: tuple[str, ...], dim: int, parts: int):
        number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label").cast("int")) - 1
        fold = F.array_position(F.array(*[F.lit(f) for f in folds]), F.col("fold")) - 1
        slim = rows.where(F.col("fold").isin(*folds)).select(F.col("embedding").cast("array<double>").alias("x"), number.cast("int").alias("y"), fold.cast("int").alias("fold"))
        self.rows, self.dim, self.parts = slim.repartition(parts).persist(), dim, parts

    def sums(self, f: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], length: int) -> np.ndarray:
        """The sum over all batches of f(x, y, fold), a vector."""
        dim = self.dim

        def partial(batches):
            total = np.zeros(length)
            for batch in batches:
                if batch.num_rows:
                    lists = batch.column("x")
                    if not np.array_equal(np.unique(lists.value_lengths().to_numpy(zero_copy_only=False)), [dim]):
                        raise ValueError(f"an embedding hasn't {dim} numbers")
                    total += f(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), *(batch.column(n).to_numpy() for n in ("y", "fold")))
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["v"])

        def added(table: pa.Table) -> pa.Table:
            return pa.table([pa.array([np.sum([np.frombuffer(v) for v in table["v"].to_pylist()], axis=0).tobytes()], pa.binary())], names=["v"])

        found = self.rows.mapInArrow(partial, "v binary")
        if self.parts > GROUPS:
            found = found.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS))).applyInArrow(added, "v binary")
        return np.sum([np.frombuffer(r.v) for r in found.collect()], axis=0)


def _flat(layers: list) -> list[np.ndarray]:
    return [p for layer in layers for p in layer]


def gradients(layers: list, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sums over rows of the weighted loss's gradients by all weights, one after another."""
    acts = _forward(layers, x)
    g = _softmax(acts[-1])
    g[np.arange(len(y)), y] -= 1
    g *= weight[:, None]
    grads: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        grads = [(acts[i].T @ g).ravel(), g.sum(0), *grads]
        g = (g @ layers[i][0].T) * (acts[i] > 0)
    return np.concatenate(grads)


def macro_f1(table: np.ndarray) -> float:
    """Of counts by truth and prediction; the mean over the classes that have a row, each rounded to 3 places."""
    k = len(table)
    hit, real, said = np.diag(table), table.sum(1), table.sum(0)
    p, r = (np.divide(hit, d, out=np.zeros(k), where=d > 0) for d in (said, real))
    f1 = [round(float(x), 3) for x in np.divide(2 * p * r, p + r, out=np.zeros(k), where=p + r > 0)]
    some = real > 0
    return float(np.mean(np.array(f1)[some])) if some.any() else 0.0


def upper_quantile(values: DataFrame, column: str, q: float) -> float:
    """The q-quantile, interpolated between its neighbours. Only the values next to it, found from a sketch whose error is a
    millionth of the rows, come to the driver."""
    n = values.count()
    at = q * (n - 1)
    near = max(3e-6, 2 / n)
    low, high = values.select(F.percentile_approx(column, [max(0.0, q - near), min(1.0, q + near)], 1_000_000)).first()[0]
    below = values.where(F.col(column) < low).count()
    found = sorted(r[0] for r in values.where(F.col(column).between(low, high)).collect())
    first = found[int(at) - below]
    return first + (found[min(int(at) + 1 - below, len(found) - 1)] - first) * (at - int(at))


def train(df: DataFrame, arch: str = "linear", weight: str = "balanced", hidden: int = 256, epochs: int = 500, lr: float = 0.05, decay: float = 1e-4, patience: int = 60, seed: int = 42, part_bytes: int = PART_BYTES) -> Head:
    """df: embedding, label, fold (train, val, test). Full-batch Adam; the weights of the best validation macro-F1 stay.

    Every step is a pass over the table: gradients over the training rows of the weights that the last step gave, and
    the validation counts of the same weights."""
    rows = df.where("label is not null and fold is not null").select("embedding", "label", "fold")
    counts = rows.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).collect()  # one row a class and fold
    classes = sorted({int(r.label) for r in counts})
    k, folds = len(classes), ("train", "val", "test")
    for name in folds:
        if not any(r.fold == name for r in counts):
            raise ValueError(f"fold {name} is empty")
    have = np.zeros(k)
    for r in counts:
        have[classes.index(int(r.label))] += r.n * (r.fold == "train")
    if (have == 0).any():
        raise ValueError("a class has no training rows")
    dim, total = max(r.dim for r in counts), sum(r.n for r in counts)
    table = Table(rows, classes, folds, dim, max(1, -(-total * dim * 8 // part_bytes)))
    try:
        mean = table.sums(lambda x, y, fold: x[fold == 0].sum(0), dim) / have.sum()
        sd = np.sqrt(table.sums(lambda x, y, fold: ((x[fold == 0] - mean) ** 2).sum(0), dim) / have.sum()) + 1e-6
        rng = np.random.default_rng(seed)
        sizes = [dim, k] if arch == "linear" else [dim, hidden, k]
        layers = [(rng.uniform(-1, 1, (a, b)) / np.sqrt(a), rng.uniform(-1, 1, b) / np.sqrt(a)) for a, b in zip(sizes, sizes[1:], strict=False)]
        w = loss_weights(have, weight)
        w = w / (w * have).sum()
        m, v = ([np.zeros_like(p) for p in _flat(layers)] for _ in range(2))
        length = sum(p.size for p in _flat(layers))

        def step(layers: list, fold_counted: int) -> Callable:
            def f(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
                z, learn, count = (x - mean) / sd, fold == 0, fold == fold_counted
                said = _forward(layers, z[count])[-1].argmax(1)
                return np.concatenate([gradients(layers, z[learn], y[learn], w[y[learn]]), np.bincount(y[count] * k + said, minlength=k * k)])

            return f

        best, best_f1, bad = layers, -1.0, 0
        for t in range(1, epochs + 2):
            sums = table.sums(step(layers, 1), length + k * k)
            if t > 1:  # the first weights are no candidates
                f1 = macro_f1(sums[length:].reshape(k, k))
                if f1 > best_f1:
                    best, best_f1, bad = layers, f1, 0
                else:
                    bad += 1
                if bad >= patience or t > epochs:
                    break
            flat, at = [], 0
            for i, p in enumerate(_flat(layers)):
                q = sums[at : at + p.size].reshape(p.shape) + decay * p
                at += p.size
                m[i], v[i] = 0.9 * m[i] + 0.1 * q, 0.999 * v[i] + 0.001 * q * q
                flat.append(p - lr * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8))
            layers = list(zip(flat[::2], flat[1::2], strict=True))
        test = macro_f1(table.sums(step(best, 2), length + k * k)[length:].reshape(k, k))

        def class_sums(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            out = np.zeros((k, dim))
            np.add.at(out, y[fold == 0], (x[fold == 0] - mean) / sd)
            return out.ravel()

        means = table.sums(class_sums, k * dim).reshape(k, dim) / have[:, None]

        def scatter(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            rest = (x[fold == 0] - mean) / sd - means[y[fold == 0]]
            return (rest.T @ rest).ravel()

        precision = np.linalg.inv(table.sums(scatter, dim * dim).reshape(dim, dim) / (have.sum() - 1) + 1e-3 * np.eye(dim))

        def distances(batches):
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                z = (x - mean) / sd
                d = np.min([(((z - c) @ precision) * (z - c)).sum(1) for c in means], axis=0)
                yield pa.record_batch([pa.array(d)], names=["d"])

        held = table.rows.where("fold = 1").select("x").mapInArrow(distances, "d double")  # the threshold is out of sample
        threshold = upper_quantile(held, "d", 0.975)
    finally:
        table.rows.unpersist()
    return Head(classes, mean, sd, best, means, precision, threshold, {"val_macro_f1": best_f1, "test_macro_f1": test})


def predict(df: DataFrame, head: Head, key: str, emb: str = "embedding") -> DataFrame:
    """key, class_id, confidence and ood (bytes, cut off), in batches."""
    held = df.sparkSession.sparkContext.broadcast(head)

    def step(pdfs):
        for pdf in pdfs:
            if len(pdf):
                h = held.value
                p, o = h.probabilities(np.stack(pdf[emb]).astype(float))
                yield pdf[[key]].assign(class_id=np.array(h.classes)[p.argmax(1)].astype("int32"), confidence=(p.max(1).astype("float32") * np.float32(100)).astype("int32"), ood=(np.clip(o, 0, 1).astype("float32") * np.float32(100)).astype("int32"))

    return df.select(key, emb).mapInPandas(step, f"{key} {df.schema[key].dataType.simpleString()}, class_id int, confidence int, ood int")
