"""N-gram Jaccard join with adaptive multi-match prefixes (operator 9).

A document's set is its distinct shingles of five words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; a text of fewer
words is one shingle. Sets of which intersection over union is at least `percent` % link.

All sets are ordered alike, rare shingles first. The prefix for l matches of a set of n shingles is its first
n - ceil(percent n / 100) + l. Linked sets share at least min(l, l') shingles of their prefixes, so each
document takes the l of least estimated cost (rows of the index it meets, and candidates left to verify, of
which a longer prefix asks more matches), and no link is lost. Shingles that one group of documents alone
has once meet nothing and aren't indexed; most documents then have no index entry at all.

1. Documents are dealt to groups; a group sends the distinct shingles of its distinct sets to buckets,
   packed, and gets back a byte each: 0 for one document, else the scaled logarithm of how many.
2. Equal sets are one class, which its smallest doc_id represents. Only representatives are joined.
3. Under each indexed shingle one pivot, with the fewest rare shingles, meets the others: as many
   pairs as index rows. Those that share min(l, l') are verified, those of one pivot in as many tasks as they
   need; links make components.
4. What is left are pairs under one pivot in different components. A pivot's members are dealt to chunks,
   large components to chunks of their own, and chunks meet in blocks, except two chunks of one component.
   In a block one matrix product counts shared prefix shingles, pairs that have min(l, l') are verified
   by another, and only links between components leave it. So near copies that are linked already cost
   their number, and no pair of them is made.

Defined cases: a null or word-less text has no shingles and links with nothing; rows that repeat a
doc_id are each judged by their own text; rows without an id take no part and get no component; every row
comes out once; very long texts are read whole; an empty table gives an empty result; other columns are left out, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import LOWER_ASCII, U64, Words, bucket_bits, byte_lists, components, cut, group_count, keep, low32, mix64, slices, text_group, total_bytes, window_hash

SHINGLE, PERCENT, MOST_MATCHES, VERIFY_COST = 5, 80, 6, 16.0
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
CHUNK = 384
HEAVY_PAIRS, HEAVY_PARTS = 128, 512
BLOCK_ROWS = 1024
_PACKET = "grp int, bucket int, data binary"
_ACTIVE = "doc_id bigint, n bigint, f1 bigint, f2 bigint, matches int, rare int, prefix array<bigint>, text string"


class Sets:
    """Distinct shingles of several texts, document by document in rising order of hash."""

    def __init__(self, texts: list[bytes]):
        words = Words([t.translate(LOWER_ASCII) for t in texts])
        pos = words.position()
        left = np.repeat(words.count, words.count) - pos
        of = np.repeat(np.arange(len(texts)), words.count)
        whole = left >= SHINGLE
        token, doc = window_hash(words.hash, SHINGLE)[whole], of[whole]
        for width in range(1, SHINGLE):
            at = words.first[words.count == width]
            if len(at):
                token = np.concatenate([token, mix64(window_hash(words.hash, width)[at] + U64(width))])
                doc = np.concatenate([doc, of[at]])
        order = np.lexsort((token, doc))
        token, doc = token[order], doc[order]
        new = np.concatenate([np.ones(min(1, len(token)), bool), (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])])
        self.token, self.doc = token[new], doc[new]
        self.n = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.cumsum(self.n) - self.n

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set: sums of two independent mixes of its shingles."""
        out = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            total = np.concatenate([np.zeros(1, U64), np.cumsum(mix64(self.token ^ U64(salt)))])
            out.append((total[self.first + self.n] - total[self.first]).view(np.int64))
        return out[0], out[1]


def shared(sets: Sets, pairs: int) -> np.ndarray:
    """Sizes of the intersections of texts 2i and 2i + 1."""
    pair = sets.doc // 2
    order = np.lexsort((sets.token, pair))
    token, pair = sets.token[order], pair[order]
    same = (token[1:] == token[:-1]) & (pair[1:] == pair[:-1])
    return np.bincount(pair[1:][same], minlength=pairs)


def choose_matches(start: np.ndarray, n: np.ndarray, meets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Matches l and prefix length of least estimated cost. meets: per ordered shingle, the other documents under it."""
    total = np.concatenate([[0.0], np.cumsum(meets)])
    need = (percent * n + 99) // 100
    best, cost = np.ones(len(n), np.int64), np.full(len(n), np.inf)
    for matches in range(1, MOST_MATCHES + 1):
        length = n - need + matches
        met = total[start + np.minimum(length, n)] - total[start]
        now = np.where(matches <= need, met + VERIFY_COST * met / matches, np.inf)
        best, cost = np.where(now < cost, matches, best), np.minimum(now, cost)
    return best, np.minimum(n - need + best, n)


def candidates(docs: DataFrame, percent: int, group_bytes: int, bucket_bytes: int) -> DataFrame:
    """All documents: n, fingerprint; and for those with an index entry: matches, rare, prefix, text."""
    size = total_bytes(docs)
    groups, bits = group_count(size, group_bytes), bucket_bits(size, bucket_bytes)
    docs = docs.select("doc_id", "text").withColumn("grp", text_group(groups))

    def distinct(texts: list[bytes]) -> tuple[Sets, np.ndarray, np.ndarray, np.ndarray]:
        """Sets, fingerprints, and the hashes of the distinct sets' shingles."""
        sets = Sets(texts)
        f1, f2 = sets.fingerprints()
        order = np.lexsort((f2, f1))
        head = np.concatenate([np.ones(min(1, len(order)), bool), (f1[order][1:] != f1[order][:-1]) | (f2[order][1:] != f2[order][:-1])])
        one = np.zeros(len(texts), bool)
        one[order[head]] = True
        return sets, f1, f2, one

    def emit(table: pa.Table) -> pa.Table:
        sets, _, _, one = distinct(byte_lists(table["text"]))
        token, count = np.unique(sets.token[one[sets.doc]], return_counts=True)
        bounds = slices(token, bits)
        full = np.flatnonzero(np.diff(bounds))
        low, count = low32(token, bits), np.minimum(count, 255).astype(np.uint8)
        data = [low[bounds[b] : bounds[b + 1]].tobytes() + count[bounds[b] : bounds[b + 1]].tobytes() for b in full]
        return pa.table({"grp": pa.array([table["grp"][0].as_py()] * len(full), pa.int32()), "bucket": pa.array(full, pa.int32()), "data": pa.array(data, pa.binary())})

    def count(table: pa.Table) -> pa.Table:
        blobs = table["data"].to_pylist()
        sizes = [len(b) // 5 for b in blobs]
        key = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes, strict=True)])
        many = np.concatenate([np.frombuffer(b, np.uint8, n, 4 * n) for b, n in zip(blobs, sizes, strict=True)])
        order = np.argsort(key, kind="stable")
        head = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        total = np.add.reduceat(many[order].astype(np.int64), np.flatnonzero(head))
        code = np.minimum(255, np.ceil(8 * np.log2(total))).astype(np.uint8)
        out = np.zeros(len(key), np.uint8)
        out[order] = code[np.cumsum(head) - 1]
        answers = [c.tobytes() for c in np.split(out, np.cumsum(sizes)[:-1])]
        return pa.table({"grp": table["grp"].combine_chunks(), "bucket": table["bucket"].combine_chunks(), "data": pa.array(answers, pa.binary())})

    def describe(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = byte_lists(table["text"])
        sets, f1, f2, one = distinct(texts)
        token = np.unique(sets.token[one[sets.doc]])
        bounds, known = slices(token, bits), np.zeros(len(token), np.uint8)
        for bucket, data in zip(answers["bucket"].to_pylist(), answers["data"].to_pylist(), strict=True):
            known[bounds[bucket] : bounds[bucket + 1]] = np.frombuffer(data, np.uint8)
        code = known[np.searchsorted(token, sets.token)]
        order = np.lexsort((sets.token, code, sets.doc))
        code, token = code[order], sets.token[order].view(np.int64)
        meets = np.where(code > 0, np.exp2(code / 8.0), 0.0)
        matches, length = choose_matches(sets.first, sets.n, meets, percent)
        rank = np.arange(len(token)) - np.repeat(sets.first, sets.n)
        used = (rank < np.repeat(length, sets.n)) & (code > 0)
        rows = np.bincount(sets.doc[used], minlength=len(texts))
        active = rows > 0
        rare = np.bincount(sets.doc[code == 0], minlength=len(texts))
        flat = token[used]
        offsets = np.concatenate([[0], np.cumsum(rows)])
        prefix = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))
        prefix = pa.array([p if a else None for p, a in zip(prefix.to_pylist(), active, strict=True)], pa.list_(pa.int64()))
        text = pa.array([t if a else None for t, a in zip(texts, active, strict=True)], pa.binary()).cast(pa.string())
        return pa.table([table["doc_id"].combine_chunks(), pa.array(sets.n), pa.array(f1), pa.array(f2), pa.array(matches, pa.int32()), pa.array(rare, pa.int32()), prefix, text], names=["doc_id", "n", "f1", "f2", "matches", "rare", "prefix", "text"])

    asked = docs.groupBy("grp").applyInArrow(emit, _PACKET)
    told = asked.groupBy("bucket").applyInArrow(count, _PACKET)
    return docs.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(describe, _ACTIVE)


def joined_salted(pairs: DataFrame, side: DataFrame, key: str, other: str, heavy: DataFrame) -> DataFrame:
    """pairs joined to `side` by `key`. heavy (key, parts): keys whose pairs are dealt by `other` to so many copies of the side's row."""
    pairs = pairs.join(F.broadcast(heavy), key, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(other), F.col("parts")), F.lit(0))).drop("parts")
    side = side.join(F.broadcast(heavy), key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)).cast("bigint") - 1))).drop("parts")
    return pairs.join(side, [key, "salt"]).drop("salt")


def verify(pairs: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) that share enough of their prefixes and whose sets link. A document in over a
    `HEAVY_PARTS`th of the pairs is copied to several tasks, which share its pairs; so there are at most twice as many
    copies as that, whatever the size."""
    pairs = cut(pairs)
    limit = max(HEAVY_PAIRS, pairs.count() // HEAVY_PARTS)
    heavy = {k: cut(pairs.groupBy(k).count().where(F.col("count") > limit).select(k, F.ceil(F.col("count") / limit).alias("parts"))) for k in "uv"}
    index = reps.select("doc_id", "prefix", "matches")
    both = joined_salted(pairs, index.toDF("v", "pv", "mv"), "v", "u", heavy["v"])
    both = joined_salted(both, index.toDF("u", "pu", "mu"), "u", "v", heavy["u"])
    both = both.where(F.size(F.array_intersect("pu", "pv")) >= F.least("mu", "mv")).select("u", "v").distinct()
    both = joined_salted(both, texts.toDF("v", "tv"), "v", "u", heavy["v"])
    both = joined_salted(both, texts.toDF("u", "tu"), "u", "v", heavy["u"]).select("u", "v", "tu", "tv")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 128):
                batch = whole.slice(at, 128)
                texts = [t for pair in zip(byte_lists(batch.column("tu")), byte_lists(batch.column("tv")), strict=True) for t in pair]
                sets = Sets(texts)
                common = shared(sets, len(batch))
                union = sets.n[::2] + sets.n[1::2] - common
                yield batch.select(["u", "v"]).filter(pa.array(100 * common >= percent * union))

    return both.mapInArrow(check, "u bigint, v bigint").distinct()


def overlaps(token: np.ndarray, owner: np.ndarray, rows: np.ndarray, cols: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many tokens each of `rows` shares with each of `cols` (owners), by products of blocks of columns."""
    _, inverse, count = np.unique(token, return_inverse=True, return_counts=True)
    often = np.cumsum(count > 1) - 1  # tokens of one owner meet nothing
    keep = count[inverse] > 1
    column, owner = often[inverse[keep]], owner[keep]
    out = np.zeros((len(rows), len(cols)), np.float32)
    place = np.full(int(max(rows.max(), cols.max())) + 1, -1)
    for at in range(0, int((count > 1).sum()), width):
        here = (column >= at) & (column < at + width)
        sides = []
        for side in (rows, cols):
            place[:] = -1
            place[side] = np.arange(len(side))
            mine = here & (owner < len(place))
            mine[mine] = place[owner[mine]] >= 0
            m = np.zeros((len(side), width), np.float32)
            m[place[owner[mine]], column[mine] - at] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def link_block(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of a block that join different components: rows of side 0 with rows of side 1, side 2 within itself."""
    side, n, matches, comp, ids = (table[c].to_numpy() for c in ("side", "n", "matches", "c", "doc_id"))
    rows, cols = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    prefix = table["prefix"].combine_chunks()
    owner = np.repeat(np.arange(len(ids)), prefix.value_lengths().to_numpy())
    enough = overlaps(prefix.flatten().to_numpy(), owner, rows, cols) >= np.minimum(matches[rows][:, None], matches[cols][None, :])
    low, high = np.minimum(n[rows][:, None], n[cols][None, :]), np.maximum(n[rows][:, None], n[cols][None, :])
    enough &= (100 * low >= percent * high) & (comp[rows][:, None] != comp[cols][None, :])
    if side[0] == 2:
        enough &= ids[rows][:, None] < ids[cols][None, :]
    if not enough.any():
        return []
    rows, cols, enough = rows[enough.any(axis=1)], cols[enough.any(axis=0)], enough[enough.any(axis=1)][:, enough.any(axis=0)]
    used = np.unique(np.concatenate([rows, cols]))
    sets = Sets(byte_lists(table["text"].take(pa.array(used))))
    common = overlaps(sets.token, sets.doc, np.searchsorted(used, rows), np.searchsorted(used, cols))
    enough &= 100 * common >= percent * (n[rows][:, None] + n[cols][None, :] - common)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in np.argwhere(enough):
        a, b = find(int(comp[rows[i]])), find(int(comp[cols[j]]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(ids[rows[i]]), int(ids[cols[j]])))
    return out


def link_across(placed: DataFrame, pivots: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components (column c) among the documents that meet under one pivot."""
    mixed = placed.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
    members = placed.join(mixed.join(pivots, "token").select("token", F.col("u").alias("p")), "token").select("p", "doc_id", "c").distinct()
    sizes = cut(members.groupBy("p", "c").agg(F.count(F.lit(1)).alias("k")))
    loose = F.when(F.col("k") < CHUNK, F.col("k"))
    totals = sizes.groupBy("p").agg(F.count(F.lit(1)).alias("comps"), F.sum(loose).alias("small")).where("comps > 1").drop("comps")
    chunk = F.when(F.col("k") >= CHUNK, F.concat_ws("-", F.col("c").cast("string"), F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("k") / CHUNK)).cast("string")))
    chunk = F.coalesce(chunk, F.concat(F.lit("small-"), F.pmod(F.xxhash64("c"), F.ceil(F.col("small") / CHUNK)).cast("string")))
    dealt = cut(members.join(sizes, ["p", "c"]).join(totals, "p").select("p", "doc_id", "c", chunk.alias("chunk"), F.when(F.col("k") >= CHUNK, F.col("c")).alias("pure")))
    chunks = dealt.select("p", "chunk", "pure").distinct()
    other = chunks.toDF("p", "chunk2", "pure2")
    blocks = chunks.join(other, "p").where((F.col("chunk") <= F.col("chunk2")) & (F.col("pure").isNull() | F.col("pure2").isNull() | (F.col("pure") != F.col("pure2"))))
    sides = F.when(F.col("chunk") == F.col("chunk2"), F.array(F.struct("chunk", F.lit(2).alias("side")))).otherwise(F.array(F.struct("chunk", F.lit(0).alias("side")), F.struct(F.col("chunk2").alias("chunk"), F.lit(1).alias("side"))))
    blocks = blocks.select("p", F.xxhash64("p", "chunk", "chunk2").alias("block"), F.explode(sides).alias("s")).select("p", "block", "s.chunk", "s.side")
    rows = cut(blocks.join(dealt.drop("pure"), ["p", "chunk"]).select("block", "side", "doc_id", "c"))
    groups = group_count(rows.count(), BLOCK_ROWS)
    rows = rows.join(reps.select("doc_id", "n", "matches", "prefix"), "doc_id").join(texts, "doc_id").withColumn("bucket", F.pmod("block", F.lit(groups)).cast("int"))

    def link(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        bounds = np.flatnonzero(np.concatenate([[True], block[order][1:] != block[order][:-1], [True]]))
        out = [x for a, b in zip(bounds[:-1], bounds[1:], strict=True) for x in link_block(table.take(pa.array(order[a:b])), percent)]
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})

    return rows.groupBy("bucket").applyInArrow(link, "u bigint, v bigint")


def near_join(docs: DataFrame, percent: int = PERCENT, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    known = keep(candidates(docs, percent, group_bytes, bucket_bytes))
    classes = known.where("n > 0 and doc_id is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"))
    ours = known.where("prefix is not null and doc_id is not null")
    reps = cut(ours.drop("text").join(classes, ["f1", "f2"]).where("doc_id = rep").select("doc_id", "n", "matches", "rare", "prefix").distinct())
    texts = ours.join(reps.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text").distinct()
    postings = reps.select("doc_id", "n", "rare", F.explode("prefix").alias("token"))

    pivots = postings.groupBy("token").agg(F.min(F.struct("rare", "doc_id", "n")).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1")
    pivots = pivots.select("token", F.col("p.doc_id").alias("u"), F.col("p.n").alias("n2"))
    near = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
    star = postings.join(pivots, "token").where((F.col("doc_id") != F.col("u")) & near)
    tested = star.select(F.least("u", "doc_id").alias("u"), F.greatest("u", "doc_id").alias("v")).distinct()
    found = components(verify(tested, reps, texts, percent))

    placed = cut(postings.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("token", "doc_id", F.coalesce("component", "doc_id").alias("c")))
    more = link_across(placed, pivots, reps, texts, percent)
    stars = found.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    final = components(stars.unionByName(more))

    named = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    base = known.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("f1")).alias("f1"), F.when(F.col("n") > 0, F.col("f2")).alias("f2"))
    return base.join(named, ["f1", "f2"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS sh FROM d, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 4))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.doc_id WHERE r.c < e.v)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""
