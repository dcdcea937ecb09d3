"""Exact removal of byte strings that an earlier document holds, by interval expansion on a Burrows-Wheeler transform (operator 13).

A window is 50 consecutive bytes of one document's UTF-8. A byte goes if a window over it also stands in a document of a
smaller doc_id. Equal windows have the same smallest 16-byte gram (by hash, the leftmost of equals), their anchor, at the
same place; so windows are dealt by anchors, in pieces: the bytes of neighbouring windows with one anchor, each once.
Documents are dealt to groups of about `group_bytes`, and three steps look at a group:

1. anchors: the group's distinct anchors go to buckets by the top bits of their hashes, 32 more bits each, with a size class, how
   many different pieces it has; a bucket answers with two bits: is it in another group as well, and is it hot (over `hot` pieces)?
2. pieces: of anchors that more than one document holds, the group sends each distinct piece once, with its first document.
   Windows round a hot anchor (the end of a line that a third of all texts share, before ever other words) are dealt by 48
   of their bytes, which three neighbouring places of the anchor in the window have in common; so what a bucket gets under
   one name differs in two bytes on either side at most. A bucket joins its distinct pieces to one text, derives which windows are equal (`prefix_classes`) and
   answers with a bit a window: is there one in an earlier document than the piece's first?
3. removal: windows of pieces that the group's own earlier documents hold, and those that the buckets named, mark their bytes.

`prefix_classes` sorts the suffixes of a bucket's text, and extends intervals of the suffix array to the left, letter by
letter of their transform, breadth first: round l finds every boundary between neighbours that share just l bytes, so
common prefixes come out by increasing value, and after 50 rounds what has no boundary shares 50 bytes or more. Only
intervals whose right boundary is new are extended, so each boundary is found once.

A passage that most documents share is one entry of each group, never one of each document. All steps are one plan over one
exchange of the documents, which the passes reuse. Defined cases: a null text is empty; a null doc_id counts as larger than
all others; rows that repeat a doc_id are the same document, and don't take from each other; very long texts are read whole;
every row comes out once; an empty table gives an empty result; other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import U64, bucket_bits, byte_lists, group_count, low32, mix64, slices, text_group, total_bytes
from terrafold.llm.substring_dedup import answer, masks_of, packed

WINDOW, GRAM, NEXT = 50, 16, 3
PLACES = WINDOW - GRAM + 1
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
SUB_BITS = 4
HOT = 1 << 14
_CHUNK = 1 << 18
_LAST_ID = np.iinfo(np.int64).max
_DOC = np.dtype(np.int64)


def loads(raw: np.ndarray, n: int, order: str) -> np.ndarray:
    """The 8 bytes from each of the first n places as one number; `raw` has 7 bytes more."""
    return np.ndarray((n,), f"{order}u8", raw.tobytes(), 0, (1,)).astype(U64)


def least_grams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window its anchor's place, and of each gram its hash."""
    grams = len(raw) - GRAM + 1
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    h = mix64(loads(padded, grams, "<") ^ mix64(loads(padded[8:], grams, "<") + U64(0x9E3779B97F4A7C15)))
    bits = max(1, grams.bit_length())
    least, have = (h >> U64(bits) << U64(bits)) | np.arange(grams, dtype=U64), 1
    while have < PLACES:
        step = min(have, PLACES - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & U64((1 << bits) - 1)).astype(np.int64), h


class Group:
    """A group's documents in the order of their ids, and their windows in pieces of one anchor."""

    def __init__(self, table: pa.Table, bits: int):
        ids = table["doc_id"].combine_chunks()
        order_key = ids.fill_null(_LAST_ID).to_numpy(zero_copy_only=False)
        order = np.argsort(order_key, kind="stable")
        self.bits, self.key = bits, order_key[order]
        self.ids = ids.take(pa.array(order))
        texts = byte_lists(table["text"])
        texts = [texts[i] for i in order]
        self.data = b"".join(texts)
        self.size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_at = np.cumsum(self.size) - self.size
        raw = np.frombuffer(self.data, np.uint8)
        whole = np.zeros(len(raw) + 1, np.int8)  # where windows start
        long = self.size >= WINDOW
        np.add.at(whole, self.text_at[long], 1)
        np.add.at(whole, (self.text_at + self.size - WINDOW + 1)[long], -1)
        whole = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
        parts = [[], [], [], [], []]
        for at in range(0, len(raw) - WINDOW + 1, _CHUNK):
            anchor, h = least_grams(raw[at : at + _CHUNK + WINDOW - 1])
            start = np.flatnonzero(whole[at : at + len(anchor)])
            anchor = anchor[start]
            head = np.flatnonzero(np.diff(anchor, prepend=-1))
            count = np.diff(head, append=len(start))
            ends = mix64(h[start[head]] ^ mix64(h[start[head] + count + PLACES - 2]))  # the piece's first and last gram
            for part, values in zip(parts, (start[head] + at, count, anchor[head] + at, h[anchor[head]], ends), strict=True):
                part.append(values)
        self.first, self.count, self.anchor = (np.concatenate([np.zeros(0, np.int64), *p]) for p in parts[:3])
        self.hash, ends = (np.concatenate([np.zeros(0, U64), *p]) for p in parts[3:])
        self.hash = mix64(self.hash + U64(0x632BE59BD9B4E019))  # anchors have small hashes; these are spread evenly
        self.of = np.searchsorted(self.text_at, self.first, "right") - 1
        self.anchors, self.inverse = np.unique(self.hash, return_inverse=True)
        _, one = np.unique(mix64(self.hash) ^ ends, return_index=True)
        self.often = np.bincount(self.inverse[one], minlength=len(self.anchors))  # of each anchor its different pieces
        low, high = np.full(len(self.anchors), _LAST_ID), np.full(len(self.anchors), np.iinfo(np.int64).min)
        np.minimum.at(low, self.inverse, self.key[self.of])
        np.maximum.at(high, self.inverse, self.key[self.of])
        self.repeated = low != high

    def anchor_packets(self, grp: int) -> pa.Table:
        size_class = np.ceil(np.log2(self.often + 1)).astype(np.uint8) if len(self.often) else np.zeros(0, np.uint8)
        return packed(grp, slices(self.anchors, self.bits), [low32(self.anchors, self.bits), size_class])

    def pieces(self, masks: dict[int, bytes]) -> None:
        """The candidate pieces: `at` and `windows` of each, `number` of the distinct one it is; and of the distinct ones
        `bytes`, first document `least` and `deal`, the hash that names the bucket."""
        bounds = slices(self.anchors, self.bits)
        shared, hot = self.repeated.copy(), np.zeros(len(self.anchors), bool)
        for bucket, mask in masks.items():
            n = bounds[bucket + 1] - bounds[bucket]
            known = np.unpackbits(np.frombuffer(mask, np.uint8), count=2 * n).astype(bool)
            shared[bounds[bucket] : bounds[bucket + 1]] |= known[:n]
            hot[bounds[bucket] : bounds[bucket + 1]] = known[n:]
        take = shared[self.inverse]
        first, count, anchor, deal, of, split = (x[take] for x in (self.first, self.count, self.anchor, self.hash, self.of, hot[self.inverse]))
        cool = ~split
        at, windows, deals, docs = [first[cool]], [count[cool]], [deal[cool]], [of[cool]]
        for q in range(-(-PLACES // NEXT)):  # the anchor's places q * NEXT and on, counted from the window's start
            near, far = q * NEXT, min(PLACES, (q + 1) * NEXT) - 1
            low = np.maximum(first[split], anchor[split] - far)
            n = np.minimum(first[split] + count[split], anchor[split] - near + 1) - low
            some = n > 0
            common = anchor[split][some]
            names = [hashlib.blake2b(self.data[a - near : a - far + WINDOW], digest_size=8).digest() for a in common.tolist()]
            at.append(low[some])
            windows.append(n[some])
            deals.append(np.frombuffer(b"".join(names), U64))
            docs.append(of[split][some])
        self.at, self.windows, deal, of = (np.concatenate(x) for x in (at, windows, deals, docs))
        known: dict[bytes, int] = {}
        self.bytes, heads, number = [], [], np.zeros(len(self.at), np.int64)
        order = np.argsort(of, kind="stable")  # the first to name a piece has its smallest doc_id
        for i, a, b in zip(order.tolist(), self.at[order].tolist(), (self.at + self.windows + WINDOW - 1)[order].tolist(), strict=True):
            piece = self.data[a:b]
            number[i] = known.setdefault(piece, len(known))
            if len(known) > len(heads):
                heads.append(i)
                self.bytes.append(piece)
        self.number, self.doc = number, self.key[of]
        self.least, self.deal = self.doc[heads], deal[heads]
        self.order = np.lexsort((np.arange(len(heads)), self.deal >> U64(64 - self.bits - SUB_BITS)))
        self.bounds = slices(self.deal[self.order], 0 if not len(heads) else self.bits)

    def piece_packets(self, grp: int) -> pa.Table:
        """A packet: per sub-bucket the number of pieces, then documents (differences), lengths and bytes, compressed."""
        codec, rows = pa.Codec("zstd"), []
        for bucket in np.flatnonzero(np.diff(self.bounds)).tolist():
            mine = self.order[self.bounds[bucket] : self.bounds[bucket + 1]]
            sub = (self.deal[mine] << U64(self.bits)) >> U64(64 - SUB_BITS)
            counts = np.bincount(sub.astype(np.int64), minlength=1 << SUB_BITS).astype(np.uint32)
            lengths = np.fromiter((len(self.bytes[i]) for i in mine), np.uint8, len(mine))
            body = b"".join([counts.tobytes(), np.diff(self.least[mine], prepend=0).tobytes(), lengths.tobytes(), *(self.bytes[i] for i in mine)])
            rows.append((grp, bucket, len(body).to_bytes(8, "little") + codec.compress(body, asbytes=True)))
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.binary()))], names=["grp", "bucket", "data"])

    def removed(self, masks: dict[int, bytes]) -> np.ndarray:
        """Whether each byte goes."""
        windows = np.fromiter((len(b) - WINDOW + 1 for b in self.bytes), np.int64, len(self.bytes))
        begin = np.zeros(len(self.bytes), np.int64)  # of each distinct piece's bits
        begin[self.order] = np.cumsum(windows[self.order]) - windows[self.order]
        earlier = np.zeros(windows.sum(), bool)
        ends = np.concatenate([[0], np.cumsum(windows[self.order])])[self.bounds]
        for bucket, mask in masks.items():
            n = ends[bucket + 1] - ends[bucket]
            earlier[ends[bucket] : ends[bucket + 1]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool)
        inside = ranges(self.windows)
        dup = np.repeat(self.doc > self.least[self.number], self.windows) | earlier[np.repeat(begin[self.number], self.windows) + inside]
        start = (np.repeat(self.at, self.windows) + inside)[dup]
        edge = np.zeros(len(self.data) + 1, np.int8)  # a place starts one window at most
        edge[start] += 1
        edge[start + WINDOW] -= 1
        return np.cumsum(edge, dtype=np.int8)[:-1] > 0


def ranges(sizes: np.ndarray) -> np.ndarray:
    """0 to size - 1 for each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def hot_anchors(table: pa.Table, hot: int) -> pa.Table:
    """A bucket of anchors: which of each group's are also another group's, and which are hot."""
    blobs = table["data"].to_pylist()
    sizes = [len(b) // 5 for b in blobs]
    values = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes, strict=True)])
    weight = np.exp2(np.concatenate([np.frombuffer(b, np.uint8, n, 4 * n) for b, n in zip(blobs, sizes, strict=True)]).astype(np.float64))
    _, inverse, groups = np.unique(values, return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)[:-1]
    shared, heavy = np.split((groups > 1)[inverse], ends), np.split((np.bincount(inverse, weight) > hot)[inverse], ends)
    return answer(table, 1, [np.concatenate(x) for x in zip(shared, heavy, strict=True)])


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the text's suffixes in the order of their first `depth` bytes or more, and their first 8 bytes in that
    order as numbers. Ranks are doubled, and only what still has equals is sorted again."""
    n = len(text)
    key = loads(np.concatenate([text, np.zeros(7, np.uint8)]), n, ">")
    order = np.argsort(key)
    first = key[order]
    fresh = np.concatenate([[True], first[1:] != first[:-1]])
    rank, have = np.empty(n + 1, np.int64), 8
    rank[n] = -1  # past the end
    while have < depth:
        head = np.flatnonzero(fresh)
        rank[order] = np.repeat(head, np.diff(np.append(head, n)))
        tied = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        if not len(tied):
            break
        at = order[tied]
        key = (rank[at] << 32) | (rank[np.minimum(at + have, n)] + 1)
        sort = np.argsort(key)
        order[tied], key = at[sort], key[sort]
        fresh[tied[1:]] |= key[1:] != key[:-1]
        have *= 2
    return order, first


def prefix_classes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and where in it a suffix shares fewer than `least` bytes with the one before. The text must end
    with a byte that no compared string holds.

    Rounds 0 to 7 are read off the first bytes by which the suffixes were sorted; the next begins with the intervals of 8
    bytes whose right boundary was found last, in round 7."""
    n = len(text)
    order, first = suffix_order(text, max(least, 8) + 1)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = np.where(order > 0, place[order - 1], -1)  # from a suffix to that of one letter more: the transform's step
    letter = text[order]
    shared = 7 - np.floor(np.log2(np.maximum(first[1:] ^ first[:-1], 1).astype(np.float64) * (1 + 1e-12))).astype(np.int64) // 8
    shared[first[1:] == first[:-1]] = 8
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    border[1:-1] = shared < min(least, 8)
    edge = np.flatnonzero(border)
    high = np.flatnonzero(shared == 7) + 1
    low = edge[np.searchsorted(edge, high) - 1]
    for _ in range(8, least):
        size = high - low
        at = np.repeat(low, size) + ranges(size)
        to, owner = before[at], np.repeat(np.arange(len(size)), size)
        if len(to) > n // 16:
            owned = np.full(n, -1, np.int32)
            owned[to[to >= 0]] = owner[to >= 0]
            to = np.flatnonzero(owned >= 0)
            owner = owned[to]
        else:
            sort = np.argsort(to)
            sort = sort[to[sort] >= 0]
            to, owner = to[sort], owner[sort]
        if not len(to):
            break
        head = np.flatnonzero(np.concatenate([[True], (np.diff(to) > 1) | (owner[1:] != owner[:-1]) | (letter[to[1:]] != letter[to[:-1]])]))
        low, high = to[head].astype(np.int64), to[np.append(head[1:], len(to)) - 1].astype(np.int64) + 1
        fresh = ~border[high]
        low, high = low[fresh], high[fresh]
        border[high] = True
    return order, border[:-1]


def first_documents(pieces: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every window of the pieces the smallest document that holds it, and where each piece's windows begin."""
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
    size = np.fromiter((len(p) for p in pieces), np.int64, len(pieces))
    windows = size - WINDOW + 1
    at = np.repeat(np.cumsum(size + 1) - size - 1, windows) + ranges(windows)
    doc = np.full(len(text), _LAST_ID)
    doc[at] = np.repeat(docs, windows)
    order, border = prefix_classes(text, WINDOW)
    least = np.minimum.reduceat(doc[order], np.flatnonzero(border))
    first = np.empty(len(text), np.int64)
    first[order] = least[np.cumsum(border) - 1]
    return first[at], np.cumsum(windows) - windows


def earlier_windows(table: pa.Table) -> pa.Table:
    """A bucket of pieces: which windows of each group's stand in an earlier document than the piece's first."""
    codec, packets = pa.Codec("zstd"), []
    for blob in table["data"].to_pylist():
        body = codec.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
        counts = np.frombuffer(body, np.uint32, 1 << SUB_BITS).astype(np.int64)
        n, at = int(counts.sum()), counts.size * 4
        docs, lengths = np.cumsum(np.frombuffer(body, _DOC, n, at)), np.frombuffer(body, np.uint8, n, at + 8 * n).astype(np.int64)
        packets.append((np.concatenate([[0], np.cumsum(counts)]), docs, lengths, np.cumsum(lengths) - lengths + at + 9 * n, body))
    flags: list[list[np.ndarray]] = [[] for _ in packets]
    for sub in range(1 << SUB_BITS):
        known: dict[bytes, int] = {}
        least: list[int] = []
        mine = []
        for bounds, docs, lengths, begin, body in packets:
            part = slice(bounds[sub], bounds[sub + 1])
            numbers = []
            for a, n, d in zip(begin[part].tolist(), lengths[part].tolist(), docs[part].tolist(), strict=True):
                number = known.setdefault(body[a : a + n], len(known))
                if number == len(least):
                    least.append(d)
                elif d < least[number]:
                    least[number] = d
                numbers.append(number)
            mine.append(np.array(numbers, np.int64))
        if not known:
            continue
        first, begin_of = first_documents(list(known), np.array(least))
        for flag, numbers, (bounds, docs, lengths, _, _) in zip(flags, mine, packets, strict=True):
            part = slice(bounds[sub], bounds[sub + 1])
            windows = lengths[part] - WINDOW + 1
            flag.append(first[np.repeat(begin_of[numbers], windows) + ranges(windows)] < np.repeat(docs[part], windows))
    return answer(table, 2, [np.concatenate(f) for f in flags])


_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())]
)


def kept_rows(group: Group, gone: np.ndarray) -> pa.Table:
    raw, rows = np.frombuffer(group.data, np.uint8), []
    total = np.concatenate([[0], np.cumsum(gone, dtype=np.int32 if len(gone) < 1 << 31 else np.int64)])
    for doc_id, at, size in zip(group.ids.to_pylist(), group.text_at.tolist(), group.size.tolist(), strict=True):
        n = int(total[at + size] - total[at])
        if not n:
            rows.append((doc_id, size, 0, [], group.data[at : at + size]))
            continue
        mine = gone[at : at + size]
        edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        rows.append((doc_id, size, n, [{"start": a, "stop": b} for a, b in edges.tolist()], raw[at : at + size][~mine].tobytes()))
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_KEPT)], schema=_KEPT)


def dedup(docs: DataFrame, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, removed (start and stop of each run of bytes that goes), kept (the bytes left)."""
    size = total_bytes(docs)
    groups, bits = group_count(size, group_bytes), bucket_bits(size, bucket_bytes)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("grp", text_group(groups))

    def grp_of(table: pa.Table) -> int:
        return table["grp"][0].as_py() if table.num_rows else 0

    def emit_anchors(table: pa.Table) -> pa.Table:
        return Group(table, bits).anchor_packets(grp_of(table))

    def emit_pieces(table: pa.Table, masks: pa.Table) -> pa.Table:
        group = Group(table, bits)
        group.pieces(masks_of(masks, 1))
        return group.piece_packets(grp_of(table))

    def emit_kept(table: pa.Table, masks: pa.Table) -> pa.Table:
        group = Group(table, bits)
        group.pieces(masks_of(masks, 1))
        return kept_rows(group, group.removed(masks_of(masks, 2)))

    packet, mask = "grp int, bucket int, data binary", "grp int, kind int, bucket int, mask binary"
    anchors = docs.groupBy("grp").applyInArrow(emit_anchors, packet)
    shared = anchors.groupBy("bucket").applyInArrow(lambda table: hot_anchors(table, hot), mask)
    pieces = docs.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(emit_pieces, packet)
    answers = shared.unionByName(pieces.groupBy("bucket").applyInArrow(earlier_windows, mask))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, removed array<struct<start:bigint,stop:bigint>>, kept binary"
    return docs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(emit_kept, schema)


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Bytes as pairs of hexadecimal digits, taken in stretches of 1000 bytes so that each window is cut from a short string.
ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (SELECT doc_id, c * 1000 AS base, substring(x, 2000 * c + 1, 2098) AS x FROM d, LATERAL (SELECT unnest(range(len(x) // 2000 + 1)) AS c)),
win AS (SELECT doc_id, base + i AS i, substring(x, 2 * i + 1, 100) AS w FROM parts, LATERAL (SELECT unnest(range(least(1000, len(x) // 2 - 49))) AS i)),
dup AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS f FROM win) WHERE f < doc_id),
gap AS (SELECT doc_id, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS new FROM dup),
span AS (SELECT doc_id, min(i) AS s, max(i) + 50 AS e FROM (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM gap) GROUP BY doc_id, k),
spans AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS p FROM span),
cut AS (SELECT doc_id, string_agg(substring(x, CAST(2 * p + 1 AS BIGINT), CAST(2 * (s - p) AS BIGINT)), '' ORDER BY s) || substring(any_value(x), CAST(2 * max(e) + 1 AS BIGINT)) AS x, sum(e - s) AS n, count(*) AS k FROM spans JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(cut.x, d.x))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
