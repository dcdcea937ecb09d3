"""Toxicity scores by a counterfactually regularised classifier (operator 8).

A logistic model over the presence of words in the whole text (letters only, A-Z lower-cased). It is
fitted on at most `sample_rows` labelled rows, the first by a hash of their id: words in at least
`min_rows` of them are ranked by the likelihood ratio of their use in the two classes; at most `features` of
those that exceed what chance gives among so many words stay, and always the identity terms. Each labelled text that
names a group gives copies with that term swapped for each other of its kind (in a copy that names the other already,
the term only goes); the squared differences between the scores of text and copy, times `penalty`, are added to the loss,
so a neutral mention of a group adds nothing of its own. Fitting is full-batch gradient descent from zero weights, so it is
repeatable. The words of the sample are counted in the cluster; the driver gets those of at least `min_rows` rows,
and of the rows only which of the chosen words they have.

Scores use the text only. Defined cases: a null, empty or letter-less text gets the score of the
intercept; with no labelled rows, or one class only, all scores are the smoothed share of toxic labels;
labels that repeat a doc_id count once, toxic if any is; rows without id are scored and not learned from;
repeated rows get equal scores; very long texts are read whole; columns with the names of the results, in any case,
are replaced, all others stay as they are, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import LOWER_ASCII, U64, Words, byte_lists, cut, with_results

SAMPLE_ROWS, MIN_ROWS, FEATURES, L2, PENALTY, STEPS = 12_000, 8, 400, 0.0002, 10.0, 600
# Identity terms by kind, in English, German, French and Spanish; terms of one kind are swapped for each other.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("old", "young", "elderly"),
    ("disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("weiblich", "männlich"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten", "latinos"),
    ("schwul", "lesbisch", "bisexuell", "hetero", "trans"),
    ("einwanderer", "flüchtlinge", "bürger", "ausländer"),
    ("behinderte", "gehörlose", "blinde"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("fille", "garçon"),
    ("filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques", "arabes"),
    ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels", "transgenres"),
    ("immigrés", "réfugiés", "citoyens", "étrangers"),
    ("handicapés", "sourds", "aveugles"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("niña", "niño"),
    ("niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos", "árabes"),
    ("homosexuales", "lesbianas", "bisexuales", "heterosexuales", "transexuales"),
    ("inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
    ("discapacitados", "sordos", "ciegos"),
)
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 0x80 else 0x20 for b in LOWER_ASCII)


def word_keys(words: list[str]) -> np.ndarray:
    return Words([w.encode() for w in words]).hash


def presence(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and word hash of each distinct word of each text."""
    words = Words([t.translate(_LETTERS) for t in texts])
    doc = np.repeat(np.arange(len(texts)), words.count)
    order = np.lexsort((words.hash, doc))
    key, doc = words.hash[order], doc[order]
    new = np.concatenate([np.ones(min(1, len(key)), bool), (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
    return doc[new], key[new]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    """Sorted word hashes, their weights, and the intercept."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        doc, key = presence(texts)
        z = np.full(len(texts), self.bias)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            z += np.bincount(doc[hit], self.weights[at[hit]], len(texts))
        return sigmoid(z)


class Swaps:
    """All copies of rows with one identity term swapped. doc, col: which row has which of the features."""

    def __init__(self, doc: np.ndarray, col: np.ndarray, kinds: list[np.ndarray], rows: int, features: int):
        kind_of: dict[int, set[int]] = {}  # a term of two languages is swapped within both kinds
        for kind in kinds:
            for c in kind:
                kind_of.setdefault(int(c), set()).update(map(int, kind))
        have = set(zip(doc.tolist(), col.tolist(), strict=True))
        made = [(d, c, int(o), float((d, int(o)) not in have)) for d, c in sorted(have) if c in kind_of for o in sorted(kind_of[c]) if o != c]
        at = np.array(made, float).reshape(-1, 4)
        self.row, self.gone, self.come = (at[:, i].astype(np.int64) for i in range(3))
        self.new, self.rows, self.features = at[:, 3], rows, features

    def penalty(self, z: np.ndarray, w: np.ndarray, times: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """Sum of squared differences of the scores, and its gradients by the rows' sums z and by the weights w directly.
        times: how often each row counts, once if none."""
        s = sigmoid(z[self.row])
        t = sigmoid(z[self.row] - w[self.gone] + self.new * w[self.come])
        often = np.ones(len(self.row)) if times is None else times[self.row]
        gap, up, down = 2 * often * (s - t), s * (1 - s), t * (1 - t)
        by_row = np.bincount(self.row, gap * (up - down), self.rows)
        by_weight = np.bincount(self.gone, gap * down, self.features) - np.bincount(self.come, gap * down * self.new, self.features)
        return float((often * (s - t) ** 2).sum()), by_row, by_weight


def likelihood_ratio(bad: np.ndarray, count: np.ndarray, toxic: float, rows: int) -> np.ndarray:
    """G statistic of each word's use in the two classes."""

    def part(seen: np.ndarray, total: np.ndarray, share: float) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(total * share, 1e-12))

    p = toxic / rows
    return 2 * np.maximum(0, part(bad, count, p) + part(count - bad, count, 1 - p) + part(toxic - bad, rows - count, p) + part(rows - toxic - count + bad, rows - count, 1 - p))


def chosen_words(words: np.ndarray, count: np.ndarray, bad: np.ndarray, distinct: int, toxic: float, rows: int, min_rows: int, features: int) -> np.ndarray:
    """Sorted hashes of the words that the model has. count, bad: rows, and toxic rows, with each word; distinct: words in all."""
    strength = np.sqrt(likelihood_ratio(bad, count, toxic, rows))
    strength[(count < min_rows) | (strength < np.sqrt(2 * np.log(distinct + 1)))] = 0  # what chance gives among so many words
    best = np.lexsort((words, -strength))[:features]
    return np.unique(np.concatenate([words[best[strength[best] > 0]], *(word_keys(list(kind)) for kind in IDENTITY)]))


def descend(keys: np.ndarray, doc: np.ndarray, col: np.ndarray, toxic: np.ndarray, l2: float, penalty: float, steps: int, times: np.ndarray | None = None) -> Model:
    """Adam over the whole sample. doc, col: which row has which of the words `keys`. times: of how many texts with the same
    words each row stands, of which `toxic` are toxic; one each if none."""
    times = np.ones(len(toxic)) if times is None else times
    total = times.sum()
    swaps = Swaps(doc, col, [np.searchsorted(keys, word_keys(list(kind))) for kind in IDENTITY], len(toxic), len(keys))
    w, m, v = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    w[-1] = log_odds(toxic.sum(), total)
    for t in range(1, steps + 1):
        z = np.bincount(doc, w[col], len(toxic)) + w[-1]
        err = times * sigmoid(z) - toxic
        _, by_row, by_weight = swaps.penalty(z, w, times)
        err += penalty * by_row
        grad = np.append(np.bincount(col, err[doc], len(keys)) + penalty * by_weight, err.sum()) / total
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(keys, w[:-1], float(w[-1]))


def log_odds(toxic: float, rows: float) -> float:
    share = (toxic + 1) / (rows + 2)
    return float(np.log(share / (1 - share)))


def prior(toxic: np.ndarray) -> float:
    return log_odds(toxic.sum(), len(toxic))


def one_class(toxic: np.ndarray) -> bool:
    return not len(toxic) or toxic.min() == toxic.max()


def fit(rows: list[np.ndarray], toxic: np.ndarray, min_rows: int = MIN_ROWS, features: int = FEATURES, l2: float = L2, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """rows: the distinct word hashes of each labelled text."""
    if one_class(toxic):
        return Model(np.zeros(0, U64), np.zeros(0), prior(toxic))
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    words, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    keys = chosen_words(words, count, np.bincount(inverse, toxic[of], len(words)), len(words), toxic.sum(), len(toxic), min_rows, features)
    at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
    hit = keys[at] == flat
    return descend(keys, of[hit], at[hit], toxic, l2, penalty, steps)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, min_rows: int = MIN_ROWS, features: int = FEATURES, l2: float = L2, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """Fits on the first `sample_rows` labelled documents by a hash of their id."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("bad"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # the documented bound of the sample

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 256):
                batch = whole.slice(i, 256)
                doc, key = presence(byte_lists(batch.column("text")))
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(batch)))])
                words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(key.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("bad"), words], names=["doc_id", "bad", "words"])

    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", (F.col("bad") > 0).cast("double").alias("bad"), "text")
    rows = cut(found.mapInArrow(step, "doc_id bigint, bad double, words array<bigint>"))
    toxic = rows.select("bad").toArrow()["bad"].to_numpy()
    if one_class(toxic):
        return Model(np.zeros(0, U64), np.zeros(0), prior(toxic))
    seen = rows.select("bad", F.explode("words").alias("word"))
    counts = cut(seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")))
    often = counts.where(F.col("n") >= min_rows).toArrow()  # at most the sample's words over min_rows
    words = often["word"].to_numpy().view(U64)
    keys = chosen_words(words, often["n"].to_numpy(), often["bad"].to_numpy(), counts.count(), toxic.sum(), len(toxic), min_rows, features)
    held = docs.sparkSession.sparkContext.broadcast(keys)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            flat, of = lists.flatten().to_numpy(zero_copy_only=False).view(U64), np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(held.value, flat), len(held.value) - 1)
            hit = held.value[at] == flat
            order = np.lexsort((at[hit], of[hit]))
            bounds = np.concatenate([[0], np.cumsum(np.bincount(of[hit], minlength=len(batch)))])
            yield pa.RecordBatch.from_arrays([batch.column("bad"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at[hit][order].astype(np.int32)))], names=["bad", "cols"])

    # texts with the same of these words are one row; at most rows of the sample times words of the model
    alike = rows.select("bad", "words").mapInArrow(known, "bad double, cols array<int>").groupBy("cols").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    has = alike.orderBy("cols").toArrow()
    cols = has["cols"].combine_chunks()
    doc, col = np.repeat(np.arange(len(cols)), cols.value_lengths().to_numpy()), cols.flatten().to_numpy().astype(np.int64)
    return descend(keys, doc, col, has["bad"].to_numpy(), l2, penalty, steps, has["n"].to_numpy().astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` and score, predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 512):
                batch = whole.slice(i, 512)
                s = held.value.scores(byte_lists(batch.column("text")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return with_results(docs, step, "score double, predicted int", "text")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5") == 0
    out = score(docs, train(docs, labels.where(~held)))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")
