"""Mixing sources to target weights (operator 6) with a multivariate-hypergeometric splitting tree.

Sources in code point order, null last, weigh 5, 2, 1, repeating, and share `share` of all words; a target
stops at `repeats` times its source's words, and the excess goes to the others by weight. Each source's
documents stand in the order of a hash of id and text, a line of words; further passes over the line follow
it. The line is cut into blocks of `block_words`; the source's quota is the blocks of its first
round(target) words, the last of them shorter. A tree splits the quotas of all sources among the output
shards: each node draws from a multivariate hypergeometric distribution how many blocks of each source go
to its left half, source by source, by the inverse of the distribution function at a uniform number from a hash of
seed, node and source, so reruns agree. Shards then take disjoint runs of blocks of the permuted line, which are
a document's `pieces`; `taken` is the sum of their words. `lay_out` makes rows of the pieces and shuffles each shard
locally by their `order`.

Words are counted as runs of `[^\\x20\\x09-\\x0D]+`. Positions in a line come from sums over cells of a source (by the
first hex digits of the hash, as many as give cells of at most about 512 rows): first over prefixes of half those
digits, then over the cells of a prefix, then within a cell, so that no task gets a whole source. The driver sees one
row a source, at most `max_sources` (more is an error).

Defined cases: a null or empty text has size 0 and is never taken; with no words all targets are 0; rows
without id stand where the hash of their text puts them; repeated rows each take their own place; very long texts
are counted whole and may be cut between shards, as any; an empty table gives an empty result; columns with the names
of the results, in any case, are replaced, all others stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import aside, bounded, cut, restored, without

WEIGHTS = (5, 2, 1)
SHARE, REPEATS, SHARDS, BLOCK_WORDS, MAX_SOURCES = 1.5, 2, 24, 1024, 100_000
CELL_ROWS, SUB_WORDS = 512, 1 << 24
_WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ("size", "source_size", "target", "taken", "pieces")


def targets(sizes: list[int], weights: list[int], share: float = SHARE, repeats: int = REPEATS) -> list[float]:
    """Shares by weight, none above `repeats` times its size; what is above goes to the rest by weight."""
    left, weight = share * sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (repeats * sizes[i] / weights[i], i))
    for n, i in enumerate(order):
        if repeats * sizes[i] * weight > left * weights[i]:
            for j in order[n:]:
                out[j] = left * weights[j] / weight
            break
        out[i] = float(repeats * sizes[i])
        left -= out[i]
        weight -= weights[i]
    return out


def uniform(*parts: int) -> float:
    """A number from 0 up to 1 from the md5 of the parts."""
    return int(hashlib.md5(":".join(map(str, ("mix", *parts))).encode()).hexdigest()[:13], 16) / 2.0**52


def hypergeometric(good: int, total: int, drawn: int, u: float) -> int:
    """The least k of which the distribution function exceeds or meets u: of `drawn` out of `total`, how many are `good`.

    Probabilities come from the ratios of neighbours, within 12 standard deviations (and 32) of the mean."""
    lo, hi = max(0, drawn - (total - good)), min(good, drawn)
    if lo == hi:
        return lo
    mean = good * drawn / total
    reach = 32 + 12 * math.sqrt(mean * (1 - good / total) * (total - drawn) / max(1, total - 1))
    lo, hi = max(lo, math.floor(mean - reach)), min(hi, math.ceil(mean + reach))
    k = np.arange(lo, hi, dtype=float)
    log = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (drawn - k) / ((k + 1) * (total - good - drawn + k + 1))))])
    below = np.cumsum(np.exp(log - log.max()))
    return lo + int((below < u * below[-1]).sum())


def split_tree(blocks: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """blocks: by source. Gives shards x sources counts whose columns sum to `blocks`."""
    out = np.zeros((shards, len(blocks)), np.int64)
    nodes = [(0, shards, [int(b) for b in blocks])]
    while nodes:
        lo, hi, have = nodes.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid, total = (lo + hi) // 2, sum(have)
        to_draw, left = total * (mid - lo) // (hi - lo), []
        for i, n in enumerate(have):
            left.append(hypergeometric(n, total, to_draw, uniform(seed, lo, hi, i)))
            total, to_draw = total - n, to_draw - left[-1]
        nodes += [(lo, mid, left), (mid, hi, [n - x for n, x in zip(have, left, strict=True)])]
    return out


def mix(docs: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = 0, max_sources: int = MAX_SOURCES) -> DataFrame:
    """`docs` and size, source_size, target, taken, pieces (shard, turn, start, stop in words, order)."""
    names = without(docs, *RESULTS).columns
    slim, others = aside(without(docs, *RESULTS), "doc_id", "text", "source")
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    digits = min(8, max(1, math.ceil(math.log(max(1, docs.count() / CELL_ROWS), 16))))
    rows = slim.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long"),
            "key": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")),
            "h": F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary")),
        }
    ).withColumn("cell", F.substring("h", 1, digits))
    cells = cut(rows.groupBy("key", "cell").agg(F.sum("size").alias("words")))
    sums = bounded(cells.groupBy("key").agg(F.sum("words").alias("n")), max_sources, "sources")
    named = sorted((r["key"] == "null", r["key"], r["n"]) for r in sums)
    sizes = [n for _, _, n in named]
    goal = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
    length = [min(REPEATS * s, math.floor(t + 0.5)) for s, t in zip(sizes, goal, strict=True)]
    quota = np.array([-(-n // block_words) for n in length], np.int64)
    runs = np.concatenate([np.zeros((1, len(sizes)), np.int64), np.cumsum(split_tree(quota, shards, seed), axis=0)]) * block_words
    plan = [(k, n, t, [min(int(x), size) for x in runs[:, i]]) for i, ((_, k, n), t, size) in enumerate(zip(named, goal, length, strict=True))]
    plan_df = docs.sparkSession.createDataFrame(plan, "key string, source_size long, target double, runs array<long>")
    halves = cells.withColumn("half", F.substring("cell", 1, digits // 2))
    before = Window.partitionBy("key").orderBy("half").rowsBetween(Window.unboundedPreceding, -1)
    starts = halves.groupBy("key", "half").agg(F.sum("words").alias("words")).select("key", "half", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    before = Window.partitionBy("key", "half").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = halves.select("key", "half", "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("begin")).join(starts, ["key", "half"])
    offsets = offsets.select("key", "cell", (F.col("start") + F.col("begin")).alias("offset"))
    within = Window.partitionBy("key", "cell").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(offsets, ["key", "cell"]).join(F.broadcast(plan_df), "key").withColumn("at", F.col("offset") + F.col("inside"))
    piece = f"""flatten(transform(sequence(0, {REPEATS - 1}), t -> filter(transform(sequence(0, {shards - 1}), i -> named_struct(
        'shard', i, 'turn', t,
        'start', greatest(at + t * source_size, runs[i]) - at - t * source_size,
        'stop', least(at + t * source_size + size, runs[i + 1]) - at - t * source_size,
        'order', xxhash64({seed}, h, t, i))), p -> p.stop > p.start)))"""
    rows = rows.withColumn("pieces", F.expr(piece))
    rows = rows.withColumn("taken", F.expr("aggregate(pieces, 0L, (a, p) -> a + p.stop - p.start)"))
    back = dict(zip(others, restored(others), strict=True))
    return rows.select(*[back[c] if c in back else F.col(c) for c in names], *RESULTS)


def lay_out(mixed: DataFrame, sub_words: int = SUB_WORDS) -> DataFrame:
    """A row for each piece of what `mix` gave: `text` is the piece's words (the whole text where it is whole), shard, turn,
    start, stop. Each shard is dealt to parts of about `sub_words` words and shuffled locally by `order`."""
    names = without(mixed, *RESULTS, "shard", "turn", "start", "stop").columns
    low = {c.lower(): c for c in names}
    slim, others = aside(mixed, "text", "size", "pieces", "taken")
    size = slim.agg(F.sum("taken")).first()[0] or 0
    rows = slim.withColumn("p", F.explode("pieces"))
    whole = (F.col("p.start") == 0) & (F.col("p.stop") == F.col("size"))
    words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), (F.col("p.start") + 1).cast("int"), (F.col("p.stop") - F.col("p.start")).cast("int")), " ")
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(words))
    parts = max(SHARDS, math.ceil(size / sub_words))
    rows = rows.repartition(parts, F.col("p.shard"), F.pmod(F.col("p.order"), F.lit(max(1, parts // SHARDS)))).sortWithinPartitions("p.shard", "p.order")
    back = dict(zip(others, restored(others), strict=True))
    return rows.select(*[F.col("text").alias(c) if c == low.get("text") else back[c] for c in names], *[F.col(f"p.{c}").alias(c) for c in ("shard", "turn", "start", "stop")])


def query(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    told = F.transform("pieces", lambda p: F.concat_ws(":", p["turn"], p["shard"], p["start"], p["stop"]))
    return out.select("doc_id", "size", "source_size", "target", "taken", F.array_join(told, ",").alias("pieces"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY CAST(2 * n AS DOUBLE) / w, i) AS r FROM s),
c AS (SELECT *, (SELECT 1.5e0 * sum(n) FROM s) - coalesce(sum(2 * n) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, sum(w) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM o),
f AS (SELECT min(r) AS r FROM c WHERE 2e0 * n * ws > rest * w),
t AS (SELECT c.source, c.i, c.n, CASE WHEN f.r IS NULL OR c.r < f.r THEN CAST(2 * c.n AS DOUBLE) ELSE CAST(x.rest AS DOUBLE) * c.w / CAST(x.ws AS DOUBLE) END AS target FROM c, f LEFT JOIN c x ON x.r = f.r),
l AS (SELECT *, least(2 * n, CAST(floor(target + 0.5e0) AS BIGINT)) AS len FROM t),
q AS (SELECT list(CAST((len + 1023) // 1024 AS BIGINT) ORDER BY i) AS have FROM l),
-- a row is a node of the tree that has drawn the first k sources' blocks for its left half
node AS (
  SELECT CAST(0 AS BIGINT) AS lo, CAST(24 AS BIGINT) AS hi, CAST(0 AS BIGINT) AS k, have, CAST([] AS BIGINT[]) AS drawn, CAST(list_sum(have) AS BIGINT) AS total, CAST(list_sum(have) AS BIGINT) * 12 // 24 AS to_draw FROM q
  UNION ALL
  SELECT lo, hi, k, have, drawn, total, CASE WHEN k = 0 THEN CAST(total * ((lo + hi) // 2 - lo) // (hi - lo) AS BIGINT) ELSE to_draw END AS to_draw FROM (
    SELECT unnest(CASE
      WHEN k < len(have) THEN [{'lo': lo, 'hi': hi, 'k': k + 1, 'have': have, 'drawn': list_append(drawn, x), 'total': total - good, 'to_draw': to_draw - x}]
      ELSE [{'lo': lo, 'hi': (lo + hi) // 2, 'k': CAST(0 AS BIGINT), 'have': drawn, 'drawn': CAST([] AS BIGINT[]), 'total': CAST(list_sum(drawn) AS BIGINT), 'to_draw': CAST(0 AS BIGINT)},
            {'lo': (lo + hi) // 2, 'hi': hi, 'k': CAST(0 AS BIGINT), 'have': list_transform(have, lambda v, j: v - drawn[j]), 'drawn': CAST([] AS BIGINT[]), 'total': CAST(list_sum(have) - list_sum(drawn) AS BIGINT), 'to_draw': CAST(0 AS BIGINT)}] END, recursive := true)
    FROM (
      SELECT *, least_k + len(list_filter(range(1, len(mass)), lambda j: list_sum(mass[1:j]) < u * list_sum(mass))) AS x FROM (
        SELECT *, list_transform(logs, lambda v: exp(v - list_max(logs))) AS mass FROM (
          SELECT *, list_transform(range(0, len(ratios) + 1), lambda j: coalesce(list_sum(ratios[1:j]), 0e0)) AS logs FROM (
            SELECT *, list_transform(range(least_k, least(good, to_draw)), lambda v: ln(CAST((good - v) * (to_draw - v) AS DOUBLE) / ((v + 1) * (total - good - to_draw + v + 1)))) AS ratios FROM (
              SELECT *, greatest(0, to_draw - (total - good)) AS least_k FROM (
                SELECT *, coalesce(have[k + 1], 0) AS good, CAST('0x' || substr(md5('mix:0:' || lo || ':' || hi || ':' || k), 1, 13) AS BIGINT) / 4503599627370496e0 AS u FROM node WHERE hi - lo > 1)))))))
),
shards AS (SELECT lo AS shard, have FROM node WHERE hi - lo = 1),
runs AS (SELECT l.source, l.i, shard, least(len, 1024 * coalesce(sum(have[l.i]) OVER (PARTITION BY l.i ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS first, least(len, 1024 * sum(have[l.i]) OVER (PARTITION BY l.i ORDER BY shard)) AS last FROM shards, l),
p AS (SELECT d.*, row_number() OVER () AS row, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM d),
x AS (SELECT p.row, turn, shard, CAST(greatest(b + turn * n, first) - b - turn * n AS BIGINT) AS start, CAST(least(b + turn * n + size, last) - b - turn * n AS BIGINT) AS stop
  FROM p JOIN l ON p.source IS NOT DISTINCT FROM l.source JOIN runs ON runs.i = l.i, (SELECT unnest([0, 1]) AS turn) WHERE b + turn * n < last AND b + turn * n + size > first),
y AS (SELECT row, CAST(sum(stop - start) AS BIGINT) AS taken, string_agg(turn || ':' || shard || ':' || start || ':' || stop, ',' ORDER BY turn, shard) AS pieces FROM x WHERE stop > start GROUP BY row)
SELECT p.doc_id, p.size, l.n AS source_size, l.target, coalesce(y.taken, 0) AS taken, coalesce(y.pieces, '') AS pieces
FROM p JOIN l ON p.source IS NOT DISTINCT FROM l.source LEFT JOIN y ON y.row = p.row
"""
