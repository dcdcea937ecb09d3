"""Shared pieces: vectorised word hashing, group sizing, and cutting lineage in a shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SEPARATORS = np.zeros(256, dtype=bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_PIECE = 1 << 17
ASIDE = "_aside"


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply), elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x9E6C63D0876A9A47


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, U64), np.multiply.accumulate(np.full(n, base, U64))])


_UP, _DOWN = _powers(_BASE, _PIECE + 4096), _powers(pow(_BASE, -1, 1 << 64), _PIECE + 4096)
_STEP = (U64(0xD1342543DE82EF95), U64(0xAF251AF3B0F025B5))


class Words:
    """The words of several texts: `hash` per word, `start`/`end` byte offsets into `data`,
    `first` the index of each text's first word and `count` its number of words."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts)
        lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_at = np.concatenate([[0], np.cumsum(lens[:-1] + 1)]) if len(texts) else np.zeros(0, np.int64)
        raw = np.frombuffer(self.data, np.uint8)
        starts, ends, hashes, at = [], [], [], 0
        while at < len(raw):
            stop = min(len(raw), at + _PIECE)
            while stop < len(raw):  # a piece ends at a separator, so no word is cut
                sep = np.flatnonzero(_SEPARATORS[raw[stop : stop + 4096]])
                if len(sep):
                    stop += int(sep[0])
                    break
                stop = min(len(raw), stop + 4096)
            s, e, h = self._piece(raw[at:stop], at)
            starts.append(s)
            ends.append(e)
            hashes.append(h)
            at = stop
        empty = np.zeros(0, np.int64)
        self.start = np.concatenate([empty, *starts])
        self.end = np.concatenate([empty, *ends])
        self.hash = np.concatenate([np.zeros(0, U64), *hashes])
        bounds = np.searchsorted(self.start, self.text_at)
        self.first = bounds
        self.count = np.diff(np.append(bounds, len(self.start)))

    def _piece(self, raw: np.ndarray, at: int):
        """Polynomial hashes from prefix sums: the sum over a word, scaled back by its start."""
        blank = _SEPARATORS[raw]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            edge = np.concatenate([[0], edge])
        if len(edge) % 2:
            edge = np.append(edge, len(raw))
        start, end = edge[::2], edge[1::2]
        up, down = (_UP, _DOWN) if len(raw) < len(_UP) else (_powers(_BASE, len(raw)), _powers(pow(_BASE, -1, 1 << 64), len(raw)))
        total = _BYTE_CODE[raw]
        total *= up[: len(raw)]
        np.cumsum(total, out=total)
        h = total[end - 1] - np.where(start > 0, total[start - 1], U64(0))
        h *= down[start]
        h += (end - start).astype(U64) * U64(0xC2B2AE3D27D4EB4F)
        return start + at, end + at, mix64(h)

    def position(self) -> np.ndarray:
        """Of each word within its text."""
        return np.arange(len(self.hash)) - np.repeat(self.first, self.count)


def window_hash(words: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """hash[i] of words[i : i + width]; the last width - 1 entries are not windows and hold 0.

    Built by doubling, so the cost is two passes per bit of `width`."""
    step = int(_STEP[which])
    words = words if which == 0 else mix64(words ^ U64(0x5851F42D4C957F2D))
    out, have, part, size = None, 0, words, 1
    while True:
        if width & size:
            if out is None:
                out = part
            else:
                n = max(0, len(words) - have)
                joined = np.zeros(len(words), U64)
                joined[:n] = out[:n] * U64(pow(step, size, 1 << 64)) + part[have:]
                out = joined
            have += size
        if have == width:
            out = mix64(out)
            out[max(0, len(words) - width + 1) :] = 0
            return out
        grown = np.zeros(len(words), U64)
        n = max(0, len(words) - size)
        grown[:n] = part[:n] * U64(pow(step, size, 1 << 64)) + part[size:]
        part, size = grown, size * 2


def slices(values: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the 2**bits slices of sorted uint64 values by their top bits."""
    if bits == 0:
        return np.array([0, len(values)])
    tops = np.arange(1, 1 << bits, dtype=U64) << U64(64 - bits)
    return np.concatenate([[0], np.searchsorted(values, tops), [len(values)]])


def low32(values: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits below the top `bits`."""
    return ((values << U64(bits)) >> U64(32)).astype(np.uint32)


def byte_lists(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives b''."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [b or b"" for b in arr.cast(pa.large_binary()).to_pylist()]


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where none is set, and on one machine."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="terrafold-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def group_count(size: int, group_bytes: int) -> int:
    return max(1, -(-size // group_bytes))


def bucket_bits(size: int, per_bucket: int) -> int:
    """Bits of the smallest power of two of buckets that hold at most `per_bucket` bytes each."""
    return max(2, (max(1, -(-size // per_bucket)) - 1).bit_length())


def text_group(groups: int) -> Column:
    """Deals rows to groups; rows without an id are dealt by their text, which one group may then hold often."""
    return F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(groups)).cast("int")


def bounded(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a side table that must stay small; more than `limit` rows is an error, never a cut."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; this side is held in memory by every task")
    return rows


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without the columns of these names, whatever their case, so that results may have them."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in low])


def aside(df: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """The columns in `needed` as they are, and all others in one struct under a name of our own, so that no name
    that an operator uses meets one of theirs; and the names of those others. `restored` undoes it."""
    low = {n.lower() for n in needed}
    others = [c for c in df.columns if c.lower() not in low]
    known = [c for c in df.columns if c.lower() in low]
    fields = [F.col(f"`{c.replace('`', '``')}`").alias(f"c{i}") for i, c in enumerate(others)]
    return df.select(*known, (F.struct(*fields) if fields else F.lit(None).cast("string")).alias(ASIDE)), others


def restored(others: list[str]) -> list[Column]:
    """The columns that `aside` put away, by their names."""
    return [F.col(f"{ASIDE}.c{i}").alias(c) for i, c in enumerate(others)]


def with_results(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], results: str, *read: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """`df` and the columns `results` (a schema) that `step` adds to batches of the columns in `read` and one more, which
    holds all others. Columns of `df` with the names of results, in any case, are replaced; those in `drop` go."""
    fresh = [r.split()[0] for r in results.split(", ")]
    df = without(df, *fresh)
    slim, others = aside(df, *read)
    slim = slim.toDF(*[c.lower() for c in slim.columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema)
    out = slim.mapInArrow(step, f"{schema}, {results}")
    back, gone = dict(zip(others, restored(others), strict=True)), {d.lower() for d in drop}
    kept = [back[c] if c in back else F.col(c.lower()).alias(c) for c in df.columns if c.lower() not in gone]
    return out.select(*kept, *fresh)


def keep(df: DataFrame) -> DataFrame:
    """Like `cut`, for wide tables: compressed Parquet in the shared checkpoint folder."""
    at = f"{checkpoint_root(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.parquet(at)


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for the nodes of `edges` (u, v longs).

    Alternates large-star and small-star steps until the edges, then stars around the smallest nodes,
    stay as they are. Edges live in the cluster; the driver sees a count and a checksum."""

    def tidy(df: DataFrame) -> DataFrame:
        return cut(df.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a > b").distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    e = tidy(edges)
    seen = mark(e)
    while seen[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("_m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("_m"))
        joined = large.join(root, "a")
        small = joined.select(F.col("b").alias("u"), F.col("_m").alias("v")).unionByName(joined.select(F.col("a").alias("u"), F.col("_m").alias("v")))
        e = tidy(small)
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
