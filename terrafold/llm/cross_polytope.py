"""Approximate nearest neighbours by cross-polytope hashing (operator 2).

A unit vector is turned by a fast pseudo-rotation, three rounds of random signs and a Hadamard
transform, and falls to the nearest signed axis: one of 2 d. Two rotations make a table, in which a vector's
bucket is its two axes: one of 4 d^2. A query probes in each table the buckets whose axes have the largest sums of its
own turned coordinates. How many grows slower than the rows: all tables together probe about
0.2 * (rows / 10,000)^-0.25 of the buckets, so the share of pairs scored falls as the table grows, while the nearest
come nearer. Every candidate so met is ranked by the exact cosine of the original vectors in double precision, ties
to the smaller vec_id.

A task gets a block: the buckets of one first axis, split by the second axis and then by a hash of the id into
parts of about `chunk_rows` rows; buckets of over four times their even size (and 256 rows) are blocks of their own,
split by the hash. A query goes once to each block with buckets that it probes, and says which; only those are scored, by a
matrix product for each second axis, and each query's best `k` leave the block, not its pairs. Their scores are summed
row by row, so they don't depend on the blocks, which follow from the number of rows. A query that meets
fewer than `k` candidates is put to all buckets of the first table, which hold every row once, so its answer is then
exact.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows without id; a vector whose length differs from `dim` (the commonest length, ties to the smaller)
takes no part; rows that repeat an id are one candidate, by the nearest of its vectors; a query never meets its own
id; an empty table gives an empty result; other columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import bounded, cut

K, TABLES, CHUNK_ROWS, HEAVY_ROWS, SEED, ROUNDING = 5, 8, 4096, 256, 7, 1e-12
_RESULT = "query_id bigint, vec_id bigint, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, orthonormal."""
    n, h = x.shape[1], 1
    while h < n:
        pair = x.reshape(-1, n // (2 * h), 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def turned(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """Rows padded to a power of two and pseudo-rotated for a table."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, width))
    y = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for s in signs:
        y = hadamard(y * s)
    return y


def signed(x: np.ndarray, table: int, which: int) -> np.ndarray:
    """Coordinates of each row along the signed axes of one of a table's two rotations; i is axis i, i + width its negative."""
    y = turned(x, 2 * table + which)
    return np.concatenate([y, -y], axis=1)


def axes(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes of each row in a table's two rotations: its bucket."""
    return signed(x, table, 0).argmax(axis=1), signed(x, table, 1).argmax(axis=1)


def probed(x: np.ndarray, table: int, probes: int) -> np.ndarray:
    """rows x first axes x second axes: whether the bucket is one of the `probes` with the largest sums (or ties with them)."""
    one, two = (signed(x, table, i).astype(np.float32) for i in (0, 1))
    total = (one[:, :, None] + two[:, None, :]).reshape(len(x), -1)
    least = max(0, total.shape[1] - probes)
    return (total >= np.partition(total, least, axis=1)[:, least, None]).reshape(len(x), one.shape[1], two.shape[1])


def probe_rule(rows: int, dim: int, tables: int) -> int:
    """Buckets that a query probes in each table."""
    buckets = (2 * width(dim)) ** 2
    return min(buckets, math.ceil(0.2 * (max(1, rows) / 10_000) ** -0.25 * buckets / tables))


def width(dim: int) -> int:
    return 1 << max(0, dim - 1).bit_length()


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Unit rows, scaled first so that no square over- or underflows."""
    y = x / np.abs(x).max(axis=1, keepdims=True)
    return y / np.sqrt((y * y).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and emb of the rows that take part."""
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    v = vectors.select("vec_id", F.col("embedding").cast(kind).alias("emb")).where("vec_id is not null and emb is not null and size(emb) > 0")
    return v.where("forall(emb, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(emb, x -> x <> 0)")


class Blocks:
    """Which block a bucket's rows are in. heavy: (table, first, second) -> parts, of buckets with blocks of their own."""

    def __init__(self, rows: int, dim: int, chunk_rows: int):
        self.dim, self.side, self.chunk_rows = dim, 2 * width(dim), chunk_rows
        self.groups = min(self.side, max(1, math.ceil(rows / self.side / chunk_rows)))
        self.parts = max(1, math.ceil(rows / self.side / self.groups / chunk_rows))
        self.limit = max(min(chunk_rows, HEAVY_ROWS), 4 * rows // self.side**2)
        self.heavy_rows = min(chunk_rows, self.limit)
        self.heavy: dict[tuple[int, int, int], int] = {}

    def place(self, table: int, first: int, second: int) -> tuple[int, int]:
        """Number of the bucket's block, and its parts."""
        own = self.heavy.get((table, first, second))
        at = (table * self.side + first) * 2 * self.side + (second % self.groups if own is None else self.side + second)
        return at, own or self.parts


def codes(vectors: DataFrame, tables: int, dim: int) -> DataFrame:
    """tab, first, second: the bucket of each row in each table."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2048):
                x = unit(matrix(whole.column("emb").slice(at, 2048), dim))
                for t in range(tables):
                    one, two = axes(x, t)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t), pa.int32()), pa.array(one, pa.int32()), pa.array(two, pa.int32())], names=["tab", "first", "second"])

    return vectors.select("emb").mapInArrow(step, "tab int, first int, second int")


def indexed(vectors: DataFrame, tables: int, blocks: Blocks) -> DataFrame:
    """vec_id, emb, block, part, second: a row for each table."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                x = unit(matrix(batch.column("emb"), blocks.dim))
                for t in range(tables):
                    one, two = axes(x, t)
                    placed = np.array([blocks.place(t, int(a), int(b)) for a, b in zip(one, two, strict=True)], np.int64).reshape(-1, 2)
                    part = batch.column("hash").to_numpy() % placed[:, 1]
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("emb"), pa.array(placed[:, 0]), pa.array(part), pa.array(two, pa.int32())], names=["vec_id", "emb", "block", "part", "second"])

    kind = vectors.schema["emb"].dataType.simpleString()
    return vectors.withColumn("hash", F.xxhash64("vec_id", "emb")).mapInArrow(step, f"vec_id bigint, emb {kind}, block bigint, part bigint, second int")


def asking(queries: DataFrame, tables: int, probes: int, blocks: Blocks) -> DataFrame:
    """vec_id, emb, block, part, probed (a bit for each second axis): a row for each block that a query goes to."""
    heavy_at: dict[tuple[int, int], list[int]] = {}
    for t, a, b in blocks.heavy:
        heavy_at.setdefault((t, a), []).append(b)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, min(64, (1 << 22) // blocks.side**2))
        for whole in batches:
            for at in range(0, len(whole), size):
                batch = whole.slice(at, size)
                x = unit(matrix(batch.column("emb"), blocks.dim))
                for t in range(tables):
                    rows, where, part, bits = [], [], [], []
                    mask = probed(x, t, probes)
                    for i, a in zip(*np.nonzero(mask.any(axis=2)), strict=True):
                        light = mask[i, a].copy()
                        for b in heavy_at.get((t, int(a)), ()):
                            if light[b]:
                                light[b] = False
                                only = np.zeros(blocks.side, bool)
                                only[b] = True
                                block, parts = blocks.place(t, int(a), b)
                                for p in range(parts):
                                    rows.append(i), where.append(block), part.append(p), bits.append(np.packbits(only).tobytes())
                        base = (t * blocks.side + int(a)) * 2 * blocks.side
                        for g in range(blocks.groups):
                            own = light & (np.arange(blocks.side) % blocks.groups == g)
                            if own.any():
                                for p in range(blocks.parts):
                                    rows.append(i), where.append(base + g), part.append(p), bits.append(np.packbits(own).tobytes())
                    at_rows = pa.array(np.array(rows, np.int64))
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at_rows), batch.column("emb").take(at_rows), pa.array(where, pa.int64()), pa.array(part, pa.int64()), pa.array(bits, pa.binary())], names=["vec_id", "emb", "block", "part", "probed"])

    return queries.mapInArrow(step, f"vec_id bigint, emb {queries.schema['emb'].dataType.simpleString()}, block bigint, part bigint, probed binary")


def best_in_block(dim: int, k: int):
    """Exact cosines of a block's rows with the queries that probe their buckets; each query's best k ids."""

    def step(rows: pa.Table, asked: pa.Table) -> pa.Table:
        q, v, s = [], [], []
        if rows.num_rows and asked.num_rows:
            ids, x, second = rows["vec_id"].to_numpy(), unit(matrix(rows["emb"].combine_chunks(), dim)), rows["second"].to_numpy()
            order = np.lexsort((second, ids))
            ids, x, second = ids[order], x[order], second[order]
            of = {int(b): np.flatnonzero(second == b) for b in np.unique(second)}
            head = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))  # an id's best vector counts
            for at in range(0, asked.num_rows, 512):
                part = asked.slice(at, 512)
                who, y = part["vec_id"].to_numpy(), unit(matrix(part["emb"].combine_chunks(), dim))
                bits = np.unpackbits(np.frombuffer(b"".join(part["probed"].to_pylist()), np.uint8).reshape(len(who), -1), axis=1)
                score = np.full((len(who), len(ids)), -np.inf)
                for b, mine in of.items():
                    here = np.flatnonzero(bits[:, b])
                    if len(here):
                        score[np.ix_(here, mine)] = y[here] @ x[mine].T
                score[who[:, None] == ids[None, :]] = -np.inf
                by_id = np.maximum.reduceat(score, head, axis=1) if len(head) < len(ids) else score
                last = np.partition(by_id, -k, axis=1)[:, -k] if by_id.shape[1] > k else np.full(len(who), -np.inf)
                for i in range(len(who)):  # a product's last bits vary with its shape, so what comes near the k-th is summed anew, row by row
                    near = np.flatnonzero((score[i] > -np.inf) & (score[i] >= last[i] - ROUNDING))
                    cosine = (x[near] * y[i]).sum(axis=1)
                    order = np.lexsort((ids[near], -cosine))
                    best = order[np.sort(np.unique(ids[near][order], return_index=True)[1])[:k]]
                    q += [int(who[i])] * len(best)
                    v += ids[near][best].tolist()
                    s += cosine[best].tolist()
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    return step


def search(vectors: DataFrame, queries: DataFrame, k: int = K, tables: int = TABLES, probes: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. Both inputs have vec_id and embedding. probes: buckets a table, by `probe_rule` if none."""
    spark = vectors.sparkSession
    rows, asked = usable(vectors), usable(queries)
    found = rows.groupBy(F.size("emb").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim, count = found["d"], found["count"]
    rows, asked = rows.where(F.size("emb") == dim).distinct(), asked.where(F.size("emb") == dim).dropDuplicates(["vec_id"])
    blocks = Blocks(count, dim, chunk_rows)
    sizes = codes(rows, tables, dim).groupBy("tab", "first", "second").count().where(F.col("count") > blocks.limit)
    # over four times the even size each, so at most a quarter of all buckets
    for r in bounded(sizes, max(1, tables * blocks.side**2 // 4), "heavy buckets"):
        blocks.heavy[r["tab"], r["first"], r["second"]] = math.ceil(r["count"] / blocks.heavy_rows)
    asked = asked.repartition(min(4096, 1 + asked.count() // 64), "vec_id")  # a query is little data and much work

    def meet(index: DataFrame, probing: DataFrame) -> DataFrame:
        met = index.groupBy("block", "part").cogroup(probing.groupBy("block", "part")).applyInArrow(best_in_block(dim, k), _RESULT)
        met = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return met.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)

    first = cut(meet(indexed(rows, tables, blocks), asking(asked, tables, probes or probe_rule(count, dim, tables), blocks)))
    fed = first.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    starved = asked.join(fed, "vec_id", "left_anti")
    rest = meet(indexed(rows, 1, blocks), asking(starved, 1, blocks.side**2, blocks))
    out = first.join(fed.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").unionByName(rest)
    return out.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 50 = 0"))
