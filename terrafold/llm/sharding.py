"""Sharding by vector bin packing (operator 5), under the law `bytes`.

Rows with equal texts form a group, and groups fall by hash into at most `cells` cells. A cell, or a
group of over 1/(8 * shards) of anything, is an item with a vector of bytes, tokens and rows; a group too
large for one shard is split into pieces by a hash of its ids (of a row number, where it has none). Items are
placed from the largest in any part down, each on the shard where the dot product of its vector with the residual
capacity is highest; capacities are a shard's even part of each total, so every vector is in parts of a shard and
bytes, tokens and rows weigh alike. Then, as long as that lowers the sum of squared residuals (bytes four times, as the
law is on them), an item leaves the fullest shard for the emptiest, or two of theirs are exchanged. The driver sees items
only, of which there are at most cells + 24 * shards * (8 + 2), whatever the input. Slots number a shard's
rows from 0 without gaps: rows are numbered in sub-buckets, and sub-buckets are offset by a running sum.

Defined cases: a null text has no bytes or tokens, CRC 0 and is of one group with the others; rows without id are
placed like others; repeated rows with an id share a shard and take slots of their own; very long texts are measured
whole; an empty table gives an empty result; other columns are left out, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import cut

SHARDS = 24
CELLS = 8192
MOVE_WEIGHTS = (4.0, 1.0, 1.0)
MOVES = 64  # at most, a shard
SUB_ROWS = 50_000
_WORD = r"[^\x20\x09-\x0D]+"


def place(items: np.ndarray, shards: int, weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> np.ndarray:
    """The shard of each item (rows: bytes, tokens, rows)."""
    totals = items.sum(axis=0, dtype=float)
    part = items / np.maximum(totals / shards, 1e-12)
    weighed = part * np.asarray(weights)
    residual = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -part.max(axis=1))):
        out[i] = int(np.argmax(residual @ weighed[i]))
        residual[out[i]] -= part[i]
    for _ in range(MOVES * shards):
        if not _moved(part, out, residual):
            break
    return out


def _moved(part: np.ndarray, where: np.ndarray, residual: np.ndarray) -> bool:
    """Makes the best move or exchange between the fullest and the emptiest shard, of the part that differs most first."""
    weights = np.asarray(MOVE_WEIGHTS)
    for d in np.argsort(-np.ptp(residual, axis=0) * weights, kind="stable"):
        a, b = int(residual[:, d].argmin()), int(residual[:, d].argmax())
        leave, come = np.flatnonzero(where == a), np.flatnonzero(where == b)
        back = np.vstack([np.zeros((1, part.shape[1])), part[come]])
        best, pair = (weights * (residual[a] ** 2 + residual[b] ** 2)).sum() - 1e-12, None
        for at in range(0, len(leave), 512):
            shift = part[leave[at : at + 512], None, :] - back[None, :, :]
            after = (((residual[a] + shift) ** 2 + (residual[b] - shift) ** 2) @ weights).ravel()
            k = int(after.argmin())
            if after[k] < best:
                best, pair = after[k], (at + k // len(back), k % len(back))
        if pair:
            i, j = pair
            shift = part[leave[i]] - back[j]
            residual[a] += shift
            residual[b] -= shift
            where[leave[i]] = b
            if j:
                where[come[j - 1]] = a
            return True
    return False


def shard(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """doc_id, size, tokens, text_crc32, group (hash of the text), shard, slot."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.regexp_count(text, F.lit(_WORD)).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.when(F.col("text").isNull(), "null").otherwise(F.md5(text.cast("binary"))).alias("group"),
            F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())).alias("_salt"),
        )
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    if not total["rows"]:
        return rows.drop("_salt").withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    limit = {k: total[k] / (8 * shards) for k in ("size", "tokens", "rows")}
    # each of these groups holds over 1/(8 * shards) of some total, so there are at most 3 * 8 * shards
    large = rows.groupBy("group").agg(*sums).where(" or ".join(f"{k} > {v!r}" for k, v in limit.items())).collect()
    share = {r["group"]: max(r[k] / (8 * limit[k]) for k in limit if limit[k]) for r in large}  # in parts of a shard
    pieces = {g: math.ceil(2 * x) if x > 0.9 else 1 for g, x in share.items()}
    names = spark.createDataFrame([(g, i, n) for i, (g, n) in enumerate(sorted(pieces.items()))], "`group` string, _at int, _pieces int")
    own = F.col("_at") * F.lit(4 * shards) + F.pmod(F.xxhash64("_salt", F.lit(11)), F.col("_pieces"))
    rows = rows.join(F.broadcast(names), "group", "left").withColumn("_item", F.coalesce(F.lit(cells) + own, F.pmod(F.xxhash64("group"), F.lit(cells))).cast("int"))
    items = rows.groupBy("_item").agg(*sums).orderBy("_item").collect()
    where = place(np.array([(r["size"], r["tokens"], r["rows"]) for r in items], float), shards)
    placed = spark.createDataFrame([(r["_item"], int(s)) for r, s in zip(items, where, strict=True)], "_item int, shard int")
    subs = max(8, -(-total["rows"] // (shards * SUB_ROWS)))
    rows = rows.join(F.broadcast(placed), "_item").withColumn("_sub", F.pmod(F.xxhash64("_salt", "group"), F.lit(subs)).cast("int"))
    counts = rows.groupBy("shard", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_sub").orderBy("doc_id", "group")
    slot = (F.row_number().over(inside) - 1 + F.col("_offset")).cast("long").alias("slot")
    return rows.join(offsets, ["shard", "_sub"]).select("doc_id", "size", "tokens", "text_crc32", "group", "shard", slot)


def query(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")
