"""Runs of words that repeat with a period, by bit-parallel lags (operator 11).

A text's words `[^\\x20\\x09-\\x0D]+` get numbers, and each bit of the numbers is one big integer, a plane, with a bit
a word. For a lag q a plane XOR the same plane shifted by q has a one where that bit differs q words later; the OR over
the planes marks all words that differ. A run of period q and at least `max(LEAST, TIMES * q)` words is a stretch of
`that - q` zeros or more; AND with itself shifted, by doubling steps, leaves ones only where such a stretch begins.

Lags of `FULL` words and more look at every s-th word only (s a power of two, at most a sixteenth of the lag), with
planes of each phase of s: a stretch of three lags still holds 48 samples or more in a row, and all lags of a text of n
words together cost about n log n bits. What is found so, in up to `SAMPLED` planes, is compared word by word, unless
it lies in a known run of which the lag is a multiple: it is that run again. Lags go up, so the first to find a stretch
has its smallest period (by Fine and Wilf's theorem a stretch of four periods has no smaller one but divisors).

No shuffle: a task holds one batch of texts. Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; very long texts are read whole; a null doc_id is kept, its row comes out like others; rows that repeat
come out as often; an empty table gives an empty result; other columns are left out, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import byte_lists

LEAST, TIMES = 6, 4
FULL = 64
SAMPLED = 8
_SCRAMBLE = 0x9E3779B1  # odd, so that numbers stay distinct in any number of low bits

Run = tuple[int, int, int]


def numbered(words: list[bytes]) -> tuple[np.ndarray, int]:
    """A number for each word, equal for equal words, and how many bits the numbers have; low bits are well mixed."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    bits = (len(known) - 1).bit_length() if known else 0
    return (ids * _SCRAMBLE) & ((1 << bits) - 1), bits


def plane(bit: np.ndarray) -> int:
    return int.from_bytes(np.packbits(bit, bitorder="little").tobytes(), "little")


def phases(ids: np.ndarray, bits: int, stride: int) -> list[list[int]]:
    """For each phase below `stride` its planes: bit j of them belongs to word j * stride + phase."""
    padded = np.zeros(-(-len(ids) // stride) * stride, np.int64)
    padded[: len(ids)] = ids
    table = padded.reshape(-1, stride)
    planes = [np.packbits(((table >> b) & 1).astype(np.uint8), axis=0, bitorder="little").T for b in range(bits)]
    return [[int.from_bytes(p[r].tobytes(), "little") for p in planes] for r in range(stride)]


def stretches(ones: int, least: int) -> np.ndarray:
    """Start and end of each stretch of at least `least` ones, one row a stretch."""
    have = 1
    while have < least and ones:
        step = min(have, least - have)
        ones &= ones >> step
        have += step
    if not ones:
        return np.zeros((0, 2), np.int64)
    raw = np.frombuffer(ones.to_bytes(-(-ones.bit_length() // 8), "little"), np.uint8)
    edges = np.flatnonzero(np.diff(np.unpackbits(raw, bitorder="little").astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    edges[:, 1] += least - 1
    return edges


def alike(here: list[int], there: list[int], shift: int, n: int) -> int:
    """A one for each of the first n places at which the planes `there`, shifted, agree with those `here`."""
    differ = 0
    for a, b in zip(here, there, strict=True):
        differ |= a ^ (b >> shift)
    every = (1 << n) - 1
    return every ^ (differ & every)


def widened(ids: np.ndarray, q: int, first: int, last: int, stride: int) -> list[tuple[int, int]]:
    """Stretches of words alike to those q later, between the samples that differ on either side."""
    low, high = max(0, first - stride), min(len(ids) - q, last + stride)
    same = ids[low:high] == ids[low + q : high + q]
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0)).reshape(-1, 2) + low
    return [(int(s), int(e)) for s, e in edges if e - s >= max(LEAST, TIMES * q) - q]


def runs_of(words: list[bytes]) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    n = len(words)
    if n < LEAST:
        return []
    ids, bits = numbered(words)
    found: dict[tuple[int, int], int] = {}
    planes = [plane((ids >> b) & 1) for b in range(bits)]
    for q in range(1, min(FULL - 1, n // TIMES) + 1):
        for s, e in stretches(alike(planes, planes, q, n - q), max(LEAST, TIMES * q) - q).tolist():
            found.setdefault((s, e - s + q), q)
    long_runs = [(s, length, p) for (s, length), p in found.items() if length >= TIMES * FULL]
    stride, sampled = 0, []
    for q in range(FULL, n // TIMES + 1):
        if stride != 1 << (q.bit_length() - 5):
            stride = 1 << (q.bit_length() - 5)
            sampled = phases(ids, min(bits, SAMPLED), stride)
            long_runs = [r for r in long_runs if r[1] >= TIMES * q]
        ones = alike(sampled[0], sampled[q % stride], q // stride, (n - q - 1) // stride + 1)
        for s, e in stretches(ones, (TIMES - 1) * q // stride).tolist():
            first, last = s * stride, (e - 1) * stride + 1
            if any(q % p == 0 and start <= first and last + q <= start + length for start, length, p in long_runs):
                continue
            for begin, end in widened(ids, q, first, last, stride):
                if found.setdefault((begin, end - begin + q), q) == q:
                    long_runs.append((begin, end - begin + q, q))
    return sorted((s, length, p) for (s, length), p in found.items())


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that stay when of each run only its first period does, joined by one blank."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    stays = np.cumsum(edge)[:-1] == 0
    return b" ".join(w for w, s in zip(words, stays.tolist(), strict=True) if s)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, texts = [], []
        for text in byte_lists(batch["text"]):
            words = text.split()
            runs.append(runs_of(words))
            texts.append(collapsed(words, runs[-1]))
        listed = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], pa.list_(_RUN))
        yield pa.record_batch([batch["doc_id"], listed, pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period), collapsed (the text with one period of each run)."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(_found, "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repeats that the contract of the query plants in every tenth text, on average."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def planted(docs: DataFrame) -> DataFrame:
    """`documents` with planted repeats; texts become words joined by one blank. Rows without an id stay as they are."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b" ".join(planted_words(d, t.split())) for d, t in zip(batch["doc_id"].to_pylist(), byte_lists(batch["text"]), strict=True)]
            yield pa.record_batch([batch["doc_id"], pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(plant, "doc_id bigint, text string")


def digest(found: DataFrame) -> DataFrame:
    """The query's columns. The greatest length / period is that of the run which no other exceeds, by cross products."""

    def beats(a, b):
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (x > y) | ((x == y) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))

    best = F.when(F.size("runs") > 0, F.reduce("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(beats(b, a), b).otherwise(a)))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    rows = found.withColumn("_best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


#: Pairs of equal words at every lag up to a quarter of the text, in maximal stretches; of stretches that are alike the smallest period stays.
ORACLE = r"""
WITH tab AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(b AS BIGINT))) AS t),
d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
  coalesce(xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(unicode(s) AS BIGINT)),
    lambda c, b: xor(c // 256, list_extract(t, CAST(xor(c, b) % 256 AS BIGINT) + 1)), 4294967295), 4294967295), 1) AS h FROM documents, tab),
s AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS hit, h // 10 AS g FROM d),
v AS (SELECT *, CASE WHEN hit THEN g % n END AS a FROM s),
p AS (SELECT *, CASE WHEN hit THEN 1 + (n - a) // (3 + g % 8) END AS p FROM v),
words AS (SELECT doc_id, n, i, w[CASE WHEN hit AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM p, LATERAL (SELECT unnest(range(n)) AS i)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isles AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs) GROUP BY doc_id, q, isle),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM isles WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
agg AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS r FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
  CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN agg USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN best b ON b.doc_id = d.doc_id AND b.r = 1
"""
