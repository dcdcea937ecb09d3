"""Language identification by segmentation-marginalised unigrams (operator 10).

Each language has a probability for every piece of a fixed public vocabulary. The probability of a
word is the sum, over all ways to cut it into pieces, of the products of their probabilities, which a
forward pass over its characters gives; a text is a sequence of independent words `[^\\x20\\x09-\\x0D]+`, marked
at their start as the vocabulary marks them, lower-cased. Words of any length are learned and scored whole, in
one lattice. Piece probabilities come from `em_rounds` of expectation-maximisation over the words of a bounded
sample of labelled rows (about the `sample_rows` of the smallest hashes of their ids a language, never more); a
character that isn't a piece, or next to none, counts as a piece of probability 1e-9. The score is the posterior
of the best language under a flat prior.

Defined cases: a null text, or one without a letter, is `und` with score 0; a language with no usable
row isn't learned; with no learned language every text is `und`; ties go to the smaller name; every row
gets an answer, and repeated rows the same one; very long texts and words are read whole, words in batches of
bounded cells; columns named lang_pred or score, in any case, are replaced, all others stay as they are, whatever their
names; an empty table gives an empty result; a sample or model of more than the stated bytes is an error.
Prediction reads the text only.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import U64, Words, bounded, byte_lists, cut, with_results

VOCABULARY = os.environ.get("TERRAFOLD_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
SAMPLE_ROWS = 1000
EM_ROUNDS = 2
FLOOR = 1e-9
_MARK = "▁"
#: Bytes of piece probabilities, which every task holds, and of the sample's distinct words, which the driver holds; more is an error.
MODEL_BYTES, SAMPLE_BYTES = 256 << 20, 1 << 30
_MAX_LANGUAGES = 10_000
_LIFT = 1e4
_RESCALE = 16
_CELLS = 1 << 18
_CACHE_WORDS = 1 << 20


def load_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model that stand for text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return sorted({p for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and (p := model.id_to_piece(i))})


class Spans:
    """The spans of characters of several words that are pieces, by the position where they end.

    `at(end)` gives (length, rows, pieces) of each length, the shortest first; length 1 comes first in any case."""

    def __init__(self, lens: np.ndarray, end: np.ndarray, length: np.ndarray, row: np.ndarray, piece: np.ndarray):
        self.lens, self.width = lens, int(lens.max(initial=1))
        order = np.lexsort((row, length, end))
        self.row, self.piece = row[order], piece[order]
        end, length = end[order], length[order]
        head = np.flatnonzero(np.concatenate([np.ones(min(1, len(end)), bool), (end[1:] != end[:-1]) | (length[1:] != length[:-1])]))
        self._length, self._from, self._to = length[head], head, np.append(head[1:], len(end))
        self._groups = np.searchsorted(end[head], np.arange(self.width + 1))

    def at(self, end: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        groups = range(self._groups[end], self._groups[end + 1])
        found = [(int(self._length[g]), self.row[self._from[g] : self._to[g]], self.piece[self._from[g] : self._to[g]]) for g in groups]
        return found if found and found[0][0] == 1 else [(1, self.row[:0], self.piece[:0]), *found]


class Lattice:
    """Finds the pieces in words, and sums over all ways to cut words into pieces."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.mult = U64(0x9E3779B97F4A7C15)
        key = np.array([self._key(p) for p in pieces], dtype=U64)
        order = np.argsort(key)
        self.keys, self.ids = key[order], order.astype(np.int32)
        self.longest = max((len(p) for p in pieces), default=1)
        self.sieve = np.zeros(1 << 20, bool)  # most spans are no piece; this tells most of those at once
        self.sieve[self._slot(key)] = True

    def _key(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self.mult) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h * U64(0xD6E8FEB86659FD93) >> U64(44)).astype(np.int64)

    def spans(self, words: list[str]) -> Spans:
        """Of the words with their mark; one pass over all characters for each length of a piece."""
        marked = [_MARK + w for w in words]
        lens = np.fromiter((len(w) for w in marked), np.int64, len(marked))
        code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64) + U64(1)
        row = np.repeat(np.arange(len(words)), lens)
        pos = np.arange(len(code)) - np.repeat(np.cumsum(lens) - lens, lens)
        left = np.repeat(lens, lens) - pos  # characters from here to the word's end
        hashes, found = np.zeros(len(code), U64), []
        for length in range(1, min(self.longest, int(lens.max(initial=0))) + 1):
            hashes = hashes[: len(code) - length + 1] * self.mult + code[length - 1 :]
            start = np.flatnonzero(self.sieve[self._slot(hashes)] & (left[: len(hashes)] >= length))
            if len(start) and self.size:
                at = np.minimum(np.searchsorted(self.keys, hashes[start]), self.size - 1)
                hit = self.keys[at] == hashes[start]
                start = start[hit]
                found.append((pos[start] + length - 1, np.full(len(start), length), row[start], self.ids[at[hit]]))
        none = np.zeros(0, np.int64)
        return Spans(lens, *(np.concatenate([none, *(f[i] for f in found)]).astype(np.int64) for i in range(4)))

    def _single(self, found: tuple[int, np.ndarray, np.ndarray], prob: np.ndarray, n: int) -> np.ndarray:
        """Probability of each row's last character as a piece, with the floor."""
        out = np.full((n, *prob.shape[1:]), FLOOR)
        out[found[1]] = np.maximum(prob[found[2]], FLOOR)
        return out

    def forward(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """log P(word) for each word (rows) and language (columns); prob is pieces x languages."""
        if not words:
            return np.zeros((0, prob.shape[1]))
        spans = self.spans(words)
        # alpha is held times _LIFT to the power of the end, over exp(shift), so that nothing under- or overflows
        alpha = [np.ones((len(words), prob.shape[1]))]
        shift, out = np.zeros((len(words), prob.shape[1])), np.zeros((len(words), prob.shape[1]))
        for end in range(spans.width):
            found = spans.at(end)
            total = alpha[-1] * self._single(found[0], prob, len(words))
            total *= _LIFT
            for length, rows, pieces in found[1:]:
                total[rows] += alpha[-length][rows] * (prob[pieces] * _LIFT**length)
            alpha = [*alpha[-self.longest + 1 :], total] if self.longest > 1 else [total]
            done = spans.lens == end + 1
            if done.any():
                out[done] = np.log(total[done]) + shift[done] - (end + 1) * np.log(_LIFT)
            if end % _RESCALE == _RESCALE - 1 and end + 1 < spans.width:
                shift += np.log(total)
                alpha = [a / total for a in alpha]
        return out

    def expected(self, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected piece counts over all segmentations of the weighted words (one language)."""
        spans = self.spans(words)
        n, every = len(words), np.arange(len(words))
        alpha = np.zeros((spans.width + 1, n))  # logarithms; those less than a piece apart differ by little
        for end in range(spans.width):
            found = spans.at(end)
            total = self._single(found[0], prob, n)
            for length, rows, pieces in found[1:]:
                total[rows] += np.exp(alpha[end + 1 - length, rows] - alpha[end, rows]) * prob[pieces]
            alpha[end + 1] = alpha[end] + np.log(total)
        whole = alpha[spans.lens, every]
        count = np.zeros(self.size)
        beta = np.full((spans.width + 1, n), -np.inf)
        beta[spans.lens, every] = 0.0
        for end in range(spans.width - 1, -1, -1):
            found = spans.at(end)
            for k, (length, rows, pieces) in enumerate(found):
                p = np.maximum(prob[pieces], FLOOR) if k == 0 else prob[pieces]
                after = beta[end + 1, rows]
                share = p * np.exp(alpha[end + 1 - length, rows] + after - whole[rows])
                count += np.bincount(pieces, share * weight[rows], self.size)
                if k:
                    beta[end + 1 - length, rows] = np.logaddexp(beta[end + 1 - length, rows], np.log(np.maximum(p, 1e-300)) + after)
            beta[end] = np.logaddexp(beta[end], np.log(self._single(found[0], prob, n)) + beta[end + 1])
        return count


def batches_of(words: list[str]) -> Iterator[np.ndarray]:
    """Numbers of the words, the shorter first, in batches of at most `_CELLS` words times characters (or one word)."""
    lens = np.fromiter((len(w) for w in words), np.int64, len(words))
    order = np.argsort(lens, kind="stable")
    cells, at = lens[order] + 1, 0
    while at < len(order):
        ahead = cells[at : at + _CELLS]
        n = max(1, int(np.searchsorted(np.arange(1, len(ahead) + 1) * ahead, _CELLS, side="right")))
        yield order[at : at + n]
        at += n


def fit(lattice: Lattice, samples: dict[str, dict[str, int]], em_rounds: int = EM_ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and the pieces x languages probabilities, from each language's word counts."""
    langs = sorted(x for x, c in samples.items() if c)
    prob = np.full((lattice.size, len(langs)), 1.0 / max(1, lattice.size))
    for k, lang in enumerate(langs):
        words = sorted(samples[lang])
        weight = np.array([samples[lang][w] for w in words], float)
        for _ in range(em_rounds):
            count = np.zeros(lattice.size)
            for part in batches_of(words):
                count += lattice.expected([words[i] for i in part], weight[part], prob[:, k])
            prob[:, k] = (count + 0.05) / (count.sum() + 0.05 * lattice.size)
    return langs, prob


class Scorer:
    """Scores batches of texts; remembers the log probabilities of up to `_CACHE_WORDS` words."""

    def __init__(self, pieces: list[str], prob: np.ndarray):
        self.lattice, self.prob = Lattice(pieces), prob
        self.keys, self.rows = np.zeros(0, U64), np.zeros((0, prob.shape[1]))

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.prob.shape[1]))
        for part in batches_of(words):
            out[part] = self.lattice.forward([words[i] for i in part], self.prob)
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """log P(text) by language."""
        words = Words(texts)
        keys, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        scores = np.zeros((len(keys), self.prob.shape[1]))
        scores[known] = self.rows[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            new = self.word_scores([words.data[words.start[i] : words.end[i]].decode("utf-8", "replace") for i in first[fresh]])
            scores[fresh] = new
            if len(self.keys) + len(fresh) <= _CACHE_WORDS:
                merged = np.concatenate([self.keys, keys[fresh]])
                order = np.argsort(merged)
                self.keys, self.rows = merged[order], np.concatenate([self.rows, new])[order]
        out = np.zeros((len(texts), self.prob.shape[1]))
        some = np.flatnonzero(words.count)
        if len(some):  # each text's own sum, whatever stands beside it
            out[some] = np.add.reduceat(scores[inverse], words.first[some], axis=0)
        return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(docs: DataFrame, vocabulary: str, sample_rows: int, em_rounds: int) -> tuple[list[str], list[str], np.ndarray]:
    """Word counts of at most `sample_rows` rows a language, those of the smallest hashes of their ids, then EM.

    Ids are first held against the hash below which twice as many are expected, so that no task gets a language."""
    usable = docs.where("lang is not null and text is not null and doc_id is not null")
    many = bounded(usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")), _MAX_LANGUAGES, "languages")
    below = [(r["lang"], min(1.0, 2 * sample_rows / max(1, r["n"]))) for r in many]
    limits = docs.sparkSession.createDataFrame(below, "lang string, below double")  # one row a language
    part = (F.col("h") / F.lit(2.0**64) + 0.5) <= F.col("below")
    near = usable.select("lang", "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).join(F.broadcast(limits), "lang").where(part).select("lang", "doc_id", "h").distinct()
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("r") <= sample_rows)
    chosen = usable.join(F.broadcast(first.select("lang", "doc_id")), ["lang", "doc_id"])  # sample_rows ids a language
    words = chosen.select("lang", F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''").groupBy("lang", "word").count()
    pieces = load_pieces(vocabulary)
    held = cut(words)
    size = held.agg(F.sum(F.octet_length("word") + 100)).first()[0] or 0  # a word's text and what a dictionary adds
    if len(many) * len(pieces) * 8 > MODEL_BYTES or size > SAMPLE_BYTES:
        raise ValueError(f"{len(many)} languages of {len(pieces)} pieces, {size} bytes of sampled words; the bounds are {MODEL_BYTES} and {SAMPLE_BYTES} bytes: lower sample_rows or learn fewer languages")
    samples: dict[str, dict[str, int]] = {}
    for row in held.toLocalIterator():
        samples.setdefault(row["lang"], {})[row["word"]] = row["count"]
    langs, prob = fit(Lattice(pieces), samples, em_rounds)
    return pieces, langs, prob


def identify(docs: DataFrame, training: DataFrame, vocabulary: str = VOCABULARY, sample_rows: int = SAMPLE_ROWS, em_rounds: int = EM_ROUNDS) -> DataFrame:
    """`docs` and lang_pred, score. `training` has doc_id, text, lang."""
    held = docs.sparkSession.sparkContext.broadcast(train(training.select("doc_id", "text", "lang"), vocabulary, sample_rows, em_rounds))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, langs, prob = held.value
        scorer = Scorer(pieces, prob) if langs else None
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                named = np.array([scorer is not None and has_letter(t) for t in texts], bool)
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
                if named.any():
                    logs = scorer.texts([t.lower().encode() for t, n in zip(texts, named, strict=True) if n])
                    best = logs.argmax(axis=1)
                    score[named] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    for i, k in zip(np.flatnonzero(named), best, strict=True):
                        pred[i] = langs[k]
                cols = [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "lang_pred", "score"])

    return with_results(docs, step, "lang_pred string, score double", "text")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 4") == 2
    out = identify(docs.select("doc_id", "text"), docs.where(~held | F.col("doc_id").isNull()))
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
