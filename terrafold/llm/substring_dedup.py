"""Exact substring removal with difference-cover anchors (operator 4).

A window is 20 consecutive words `[^\\x20\\x09-\\x0D]+` of a document. A word goes if a window over it has a
word sequence that also starts earlier (smaller doc_id, or same document and earlier start).

The residues {0, 1, 3, 9} modulo 13 are a difference cover: for any two positions there is a shift of
0 to 12 that puts both on the cover. So when two windows are equal, some 8-word anchor at the same shift
within both of them starts at a cover position, and only anchors at cover positions need be hashed.
Documents are dealt to groups of about `group_bytes`, and three steps look at a group:

1. anchors: the group's distinct anchor hashes go to buckets by their top bits, 32 more bits each,
   packed; a bucket answers with a bit an anchor: is it in another group as well?
2. windows: repeated anchors extend to the windows that hold them, hashed to 128 bits. The group sends
   the first place of each distinct window; a bucket answers with a bit each: is there an earlier one?
3. removal: windows that have an earlier twin, in the group or elsewhere, mark their words.

A text, line or anchor that most documents share is one entry of each group, never one of each document.
All steps are one plan over one exchange of the documents, which the passes reuse.

Defined cases: a null text has no words and comes out empty; a null doc_id counts as larger than all
others; rows that repeat a doc_id are the same document, and equal starts in them are not earlier than
each other; every row comes out once; very long texts are read whole; an empty table gives an empty result; other columns
are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import U64, Words, bucket_bits, byte_lists, group_count, low32, slices, text_group, total_bytes, window_hash

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
GROUP_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
_ON_COVER = np.isin(np.arange(PERIOD), COVER)
_LAST_ID = np.iinfo(np.int64).max
_MASK = pa.schema([("grp", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("mask", pa.binary())])


class Group:
    """A group's documents in the order of their ids, their anchors, and what is known of them."""

    def __init__(self, table: pa.Table, bits: int):
        ids = table["doc_id"].combine_chunks()
        order_key = ids.fill_null(_LAST_ID).to_numpy(zero_copy_only=False)
        order = np.argsort(order_key, kind="stable")
        self.bits = bits
        self.ids = ids.take(pa.array(order))
        self.key = order_key[order]
        texts = byte_lists(table["text"])
        self.texts = [texts[i] for i in order]
        self.words = Words(self.texts)
        n = len(self.words.hash)
        self.pos = self.words.position()
        self.left = np.repeat(self.words.count, self.words.count) - self.pos  # words from here to the text's end
        self.of = np.repeat(np.arange(len(self.texts)), self.words.count)
        fits = (self.left >= ANCHOR) & _ON_COVER[self.pos % PERIOD] & (self.pos + self.left >= WINDOW)
        self.anchor_at = np.flatnonzero(fits)
        anchors = window_hash(self.words.hash, ANCHOR)[self.anchor_at] if n else np.zeros(0, U64)
        self.anchors, self.inverse, count = np.unique(anchors, return_inverse=True, return_counts=True)
        self.repeated = count > 1

    def known(self, masks: dict[int, bytes]) -> np.ndarray:
        """The buckets' answers for the sorted distinct anchors."""
        return unpacked(masks, slices(self.anchors, self.bits))

    def windows(self, masks: dict[int, bytes]) -> None:
        """Candidate windows (word index), their hashes in sorted order, and which are first of their kind."""
        hot = np.zeros(len(self.words.hash) + 1, np.int64)
        hot[self.anchor_at[(self.repeated | self.known(masks))[self.inverse]] + 1] = 1
        seen = np.cumsum(hot)
        start = np.flatnonzero(self.left >= WINDOW)
        start = start[seen[start + PERIOD] > seen[start]]
        h1 = window_hash(self.words.hash, WINDOW, 0)[start] if len(start) else np.zeros(0, U64)
        h2 = window_hash(self.words.hash, WINDOW, 1)[start] if len(start) else np.zeros(0, U64)
        place = np.lexsort((self.pos[start], self.key[self.of[start]], h2, h1))
        self.start, self.h1, self.h2 = start[place], h1[place], h2[place]
        same = (self.h1[1:] == self.h1[:-1]) & (self.h2[1:] == self.h2[:-1])
        self.first = np.concatenate([np.ones(min(1, len(start)), bool), ~same])

    def removed(self, masks: dict[int, bytes]) -> np.ndarray:
        """Whether each word goes."""
        heads = np.flatnonzero(self.first)
        of_head = np.cumsum(self.first) - 1
        elsewhere = unpacked(masks, slices(self.h1[heads], self.bits))
        key, pos = self.key[self.of[self.start]], self.pos[self.start]
        later = (key != key[heads][of_head]) | (pos != pos[heads][of_head]) if len(heads) else np.zeros(0, bool)
        dup = self.start[later | elsewhere[of_head]] if len(heads) else self.start
        edge = np.zeros(len(self.words.hash) + 1, np.int64)
        np.add.at(edge, dup, 1)
        np.add.at(edge, dup + WINDOW, -1)
        return np.cumsum(edge)[:-1] > 0


def unpacked(masks: dict[int, bytes], bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(bounds[-1], bool)
    for bucket, mask in masks.items():
        n = bounds[bucket + 1] - bounds[bucket]
        out[bounds[bucket] : bounds[bucket + 1]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool)
    return out


def masks_of(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: m for k, b, m in zip(*(table[c].to_pylist() for c in ("kind", "bucket", "mask")), strict=True) if k == kind}


def packed(grp: int, bounds: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """One row for each bucket that gets something: the columns' bytes one after another."""
    full = np.flatnonzero(np.diff(bounds))
    data = [b"".join(c[bounds[b] : bounds[b + 1]].tobytes() for c in columns) for b in full]
    return pa.table({"grp": pa.array([grp] * len(full), pa.int32()), "bucket": pa.array(full, pa.int32()), "data": pa.array(data, pa.binary())})


def answer(table: pa.Table, kind: int, flags: list[np.ndarray]) -> pa.Table:
    n = table.num_rows
    masks = [np.packbits(f).tobytes() for f in flags]
    return pa.table([table["grp"].combine_chunks(), pa.array([kind] * n, pa.int32()), table["bucket"].combine_chunks(), pa.array(masks, pa.binary())], schema=_MASK)


def shared_anchors(table: pa.Table) -> pa.Table:
    """A bucket of anchors: which of each group's are also another group's."""
    parts = [np.frombuffer(d, np.uint32) for d in table["data"].to_pylist()]
    every = np.sort(np.concatenate(parts))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    found = []
    for p in parts:
        at = np.minimum(np.searchsorted(twice, p), max(0, len(twice) - 1))
        found.append(twice[at] == p if len(twice) else np.zeros(len(p), bool))
    return answer(table, 1, found)


def later_windows(table: pa.Table) -> pa.Table:
    """A bucket of windows: which of each group's have a twin that starts earlier."""
    blobs = table["data"].to_pylist()
    sizes = [len(b) // 32 for b in blobs]
    columns = [[], [], [], []]
    for blob, n in zip(blobs, sizes, strict=True):
        for k, kind in enumerate((U64, U64, np.int64, np.int64)):
            columns[k].append(np.frombuffer(blob, kind, n, 8 * n * k))
    h1, h2, key, pos = (np.concatenate(c) for c in columns)
    order = np.lexsort((pos, key, h2, h1))
    h1, h2, key, pos = h1[order], h2[order], key[order], pos[order]
    head = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    at = np.flatnonzero(head)[np.cumsum(head) - 1]
    late = np.zeros(len(h1), bool)
    late[order] = (key != key[at]) | (pos != pos[at])
    return answer(table, 2, np.split(late, np.cumsum(sizes)[:-1]))


def dedup(docs: DataFrame, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one blank)."""
    size = total_bytes(docs)
    groups, bits = group_count(size, group_bytes), bucket_bits(size, bucket_bytes)
    docs = docs.select("doc_id", "text").withColumn("grp", text_group(groups))

    def emit_anchors(table: pa.Table) -> pa.Table:
        group = Group(table, bits)
        return packed(table["grp"][0].as_py(), slices(group.anchors, bits), [low32(group.anchors, bits)])

    def emit_windows(table: pa.Table, masks: pa.Table) -> pa.Table:
        group = Group(table, bits)
        group.windows(masks_of(masks, 1))
        at = group.start[group.first]
        h1 = group.h1[group.first]
        return packed(table["grp"][0].as_py() if table.num_rows else 0, slices(h1, bits), [h1, group.h2[group.first], group.key[group.of[at]], group.pos[at]])

    def emit_kept(table: pa.Table, masks: pa.Table) -> pa.Table:
        group = Group(table, bits)
        group.windows(masks_of(masks, 1))
        gone = group.removed(masks_of(masks, 2))
        count, first = group.words.count, group.words.first
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[first + count] - total[first]
        kept = []
        for i, text in enumerate(group.texts):
            words = text.split()
            if removed[i]:
                words = [w for w, g in zip(words, gone[first[i] : first[i] + count[i]].tolist(), strict=True) if not g]
            kept.append(b" ".join(words))
        return pa.table({"doc_id": group.ids, "n_words": pa.array(count, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    packet, mask = "grp int, bucket int, data binary", "grp int, kind int, bucket int, mask binary"
    anchors = docs.groupBy("grp").applyInArrow(emit_anchors, packet)
    shared = anchors.groupBy("bucket").applyInArrow(shared_anchors, mask)
    windows = docs.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(emit_windows, packet)
    late = windows.groupBy("bucket").applyInArrow(later_windows, mask)
    answers = shared.unionByName(late)
    return docs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(emit_kept, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS h FROM d, LATERAL (SELECT unnest(generate_series(1, len(w) - 19)) AS i) WHERE len(w) >= 20),
dup AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 19)) AS p FROM dup)),
k AS (SELECT d.doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) d LEFT JOIN gone USING (doc_id, p) WHERE gone.doc_id IS NULL GROUP BY d.doc_id),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN g USING (doc_id)
"""
