"""Benchmark decontamination with one Aho-Corasick automaton (operator 3).

Texts are normalised by lower-casing A-Z and keeping the words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. Every run of
`window` consecutive words of a benchmark item is a window, or the whole item where it has fewer words. The automaton
runs over numbers of words, spelled in 64 signs, once over all words of a batch. Its patterns are the short items, and of
the others stretches of 7 words (of 10) at every 4th, one of which lies in any window; so it has at most about two nodes
a sign of the benchmark. Windows round a stretch that is met are looked up among the benchmark's. Hits are mapped back to word numbers
and, for the spans, to byte offsets of the original text: normalising replaces bytes one for one, so offsets survive it.

Documents are not shuffled. The benchmark goes to the tasks in passes of at most `pass_bytes` of text, as hashes and
numbers of its words; between two passes what was found is written to the shared folder. In a pass a task has one
automaton at a time, of a block of at most `block_bytes`; where there are several, it puts them one after the other to
about `group_bytes` of documents that it holds. So driver and tasks hold a bounded part of the benchmark whatever
its size.

Defined cases: a null or word-less text has no words, hits or items; a benchmark row without id or
without words yields no pattern; rows that repeat an item id count as one item; an empty benchmark
hits nothing; repeated document rows are each judged; very long texts are scanned whole; columns that have the names of
the results, in any case, are replaced by them, all others stay as they are, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import LOWER_ASCII, U64, Words, aside, byte_lists, keep, restored, window_hash, without

WINDOW = 10
BLOCK_BYTES, PASS_BYTES, GROUP_BYTES = 2 << 20, 64 << 20, 32 << 20
_STRETCH, _WHOLE = 1, 2
_NORMAL = bytes(b if chr(b).isascii() and chr(b).isalnum() or b >= 0x80 else 0x20 for b in LOWER_ASCII)
RESULTS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,stop:bigint>>"
_MADE: dict[tuple, Matcher] = {}


def stretch(window: int) -> tuple[int, int]:
    """Length and step of the stretches of which every run of `window` words holds one."""
    length = max(1, -(-2 * window // 3))
    return length, window + 1 - length


class Bench:
    """A pass of the benchmark: hashes of its distinct words, the numbers (from 1) of all its words, and its items."""

    def __init__(self, items: list[tuple[str, bytes]], block_bytes: int):
        words = Words([t.translate(_NORMAL) for _, t in items])
        self.key = uuid.uuid4().hex
        self.vocabulary, inverse = np.unique(words.hash, return_inverse=True)
        self.words = (inverse + 1).astype(np.uint32)
        self.signs = max(1, -(-len(self.vocabulary).bit_length() // 6))
        self.first, self.count = words.first, words.count
        self.names = [n for n, _ in items]
        self.blocks, size = [0], 0
        for i, (_, text) in enumerate(items):
            if size and size + len(text) > block_bytes:
                self.blocks.append(i)
                size = 0
            size += len(text)
        self.blocks.append(len(items))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words; 0 for those that the benchmark lacks."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def spell(self, numbers: np.ndarray) -> str:
        """`signs` characters a word, the first from a range of its own, so that no match begins within a word."""
        digits = numbers.astype(np.uint32)[:, None] >> (6 * np.arange(self.signs, dtype=np.uint32)) & np.uint32(63)
        digits += np.uint32(0x40)
        digits[:, 0] += np.uint32(0xC0)
        return digits.astype("<u4").tobytes().decode("utf-32-le")

    def matcher(self, block: int, window: int) -> Matcher:
        """Made once a worker process, which holds one at a time."""
        key = (self.key, block, window)
        if key not in _MADE:
            _MADE.clear()
            _MADE[key] = Matcher(self, self.blocks[block], self.blocks[block + 1], window)
        return _MADE[key]


class Matcher:
    """The automaton of a block's items, and its windows by width: sorted hashes, and the items of each."""

    def __init__(self, bench: Bench, lo: int, hi: int, window: int):
        self.window, self.bench = window, bench
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        first, count = bench.first[lo:hi], bench.count[lo:hi]
        begin = int(first[0]) if len(first) else 0
        words = bench.words[begin : begin + int(count.sum())]
        hashes, owner = bench.vocabulary[words.astype(np.int64) - 1], np.repeat(np.arange(lo, hi), count)
        at = np.arange(len(words)) - np.repeat(first - begin, count)
        left = np.repeat(count, count) - at
        length, step = stretch(window)
        told, signs = bench.spell(words), bench.signs
        flags: dict[str, int] = {}
        long = np.repeat(count >= window, count)
        for i in np.flatnonzero(long & (at % step == 0) & (left >= length)).tolist():
            flags[told[i * signs : (i + length) * signs]] = _STRETCH
        for f, n in zip((first - begin)[count < window].tolist(), count[count < window].tolist(), strict=True):
            if n:
                key = told[f * signs : (f + n) * signs]
                flags[key] = flags.get(key, 0) | _WHOLE
        for key, flag in flags.items():
            self.machine.add_word(key, len(key) // signs << 2 | flag)
        del flags
        if len(self.machine):
            self.machine.make_automaton()
        self.tables = {}
        for width in np.unique(np.minimum(count, window)):
            if width:
                here = np.repeat(np.minimum(count, window) == width, count) & (left >= width)
                pair = np.unique(np.stack([window_hash(hashes, int(width))[here], owner[here].astype(U64)], axis=1), axis=0)
                keys, begins = np.unique(pair[:, 0], return_index=True)
                self.tables[int(width)] = (keys, np.append(begins, len(pair)), pair[:, 1].astype(np.int64))

    def find(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Width, first words and items of the windows that occur in the texts; a first word once for each item."""
        if not len(self.machine):
            return
        text = np.repeat(np.arange(len(words.count)), words.count)
        line = np.zeros(len(words.hash) + len(words.count), np.int64)  # a 0 between two texts, which no pattern has
        line[np.arange(len(words.hash)) + text] = self.bench.numbers(words.hash)
        met = np.array(list(self.machine.iter(self.bench.spell(line))), np.int64).reshape(-1, 2)
        if not len(met):
            return
        place = np.zeros(len(line), np.int64)
        place[np.arange(len(words.hash)) + text] = np.arange(len(words.hash))
        end, length, flag = place[met[:, 0] // self.bench.signs], met[:, 1] >> 2, met[:, 1] & 3
        starts: dict[int, list[np.ndarray]] = {}
        mine = flag & _STRETCH > 0
        for shift in range(stretch(self.window)[1]):
            starts.setdefault(self.window, []).append((end - length + 1 - shift)[mine])
        for width in np.unique(length[flag & _WHOLE > 0]):
            starts.setdefault(int(width), []).append((end - length + 1)[(flag & _WHOLE > 0) & (length == width)])
        stop = words.first + words.count
        for width, found in starts.items():
            start = np.unique(np.concatenate(found))
            start = start[(start >= 0) & (start < len(text))]
            start = start[start + width <= stop[text[start]]]
            if not len(start):
                continue
            keys, begins, owners = self.tables[width]
            # the hashes of windows depend on their words alone, so only the parts round the starts are hashed
            got = _hash_at(words.hash, start, width)
            at = np.minimum(np.searchsorted(keys, got), len(keys) - 1)
            hit = keys[at] == got
            start, at = start[hit], at[hit]
            many = begins[at + 1] - begins[at]
            own = owners[np.repeat(begins[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            yield width, np.repeat(start, many), own


def _hash_at(hashes: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """`window_hash` of the windows that begin at `start`."""
    rows = hashes[start[:, None] + np.arange(width)].ravel()
    return window_hash(rows, width)[:: width] if len(rows) else np.zeros(0, U64)


def scan(bench: Bench, blocks: range, window: int, parts: list[Words]) -> list[tuple[np.ndarray, list[set[str]]]]:
    """For each batch: whether each word is hit, and the items found in each text. One automaton at a time."""
    out = [(np.zeros(len(w.hash) + 1, np.int64), [set() for _ in w.count]) for w in parts]
    for block in blocks:
        matcher = bench.matcher(block, window)
        for words, (edge, items) in zip(parts, out, strict=True):
            for width, start, own in matcher.find(words):
                one = np.unique(start)
                np.add.at(edge, one, 1)
                np.add.at(edge, one + width, -1)
                text = np.searchsorted(words.first + words.count, start, side="right")
                for t, i in np.unique(np.stack([text, own], axis=1), axis=0).tolist():
                    items[t].add(bench.names[i])
    return [(np.cumsum(edge[:-1]) > 0, items) for edge, items in out]


def runs(hit: np.ndarray, words: Words) -> list[list[tuple[int, int]]]:
    """Of each text the runs of hit words: first word, word after the last, counted in the batch."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    out: list[list[tuple[int, int]]] = [[] for _ in words.count]
    text = np.repeat(np.arange(len(words.count)), words.count)
    for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0), strict=True):
        cuts = [a, *(c for c in words.first[text[a] + 1 : text[b - 1] + 1] if a < c < b), b]  # a run ends where its text does
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                out[text[lo]].append((int(lo), int(hi)))
    return out


def passes_of(benchmark: DataFrame, pass_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items, at most `pass_bytes` of text (or one item) at a time, in the order of the rows."""
    block, size = [], 0
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    for row in rows.toLocalIterator():
        text = row.text.encode()
        if block and size + len(text) > pass_bytes:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, pass_bytes: int = PASS_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """`docs` and n_words, n_hit, items (ids found, sorted as strings) and spans (byte ranges hit)."""
    docs = without(docs, *(x.split()[0] for x in RESULTS.split(", ")))
    slim, others = aside(docs, "text")
    out = slim
    for number, items in enumerate(passes_of(benchmark, pass_bytes)):
        if number:
            out = keep(out)
        out = _pass(out, Bench(items, block_bytes), window, group_bytes, first=number == 0)
    back = dict(zip(others, restored(others), strict=True))
    return out.select(*[back[c] if c in back else F.col(c) for c in docs.columns], "n_words", F.expr("aggregate(spans, 0L, (a, s) -> a + s.words)").alias("n_hit"), "items", F.expr("transform(spans, s -> named_struct('start', s.start, 'stop', s.stop))").alias("spans"))


_FOUND = "n_words bigint, items array<string>, spans array<struct<start:bigint,stop:bigint,first:bigint,words:bigint>>"


def _pass(docs: DataFrame, bench: Bench, window: int, group_bytes: int, first: bool) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(bench)
    names = [c for c in docs.columns if first or c not in ("n_words", "items", "spans")]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "stop", "first", "words")]))

    def finish(batch: pa.RecordBatch, words: Words, hit: np.ndarray, items: list[set[str]]) -> pa.RecordBatch:
        if not first:  # what was found before counts too
            for t, (old, spans) in enumerate(zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
                items[t].update(old)
                for s in spans:
                    hit[words.first[t] + s["first"] : words.first[t] + s["first"] + s["words"]] = True
        spans = [
            [{"start": int(words.start[a] - words.text_at[t]), "stop": int(words.end[b - 1] - words.text_at[t]), "first": int(a - words.first[t]), "words": b - a} for a, b in found]
            for t, found in enumerate(runs(hit, words))
        ]
        new = [pa.array(words.count.astype(np.int64)), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, kind)]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *new], names=[*names, "n_words", "items", "spans"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        blocks = range(len(known.blocks) - 1)

        def flush(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [Words([t.translate(_NORMAL) for t in byte_lists(b.column("text"))]) for b in group]
            for batch, words, (hit, items) in zip(group, parts, scan(known, blocks, window, parts), strict=True):
                yield finish(batch, words, hit, items)

        group, size = [], 0
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                group.append(batch)
                size += batch.column("text").get_total_buffer_size() * len(batch) // max(1, len(whole))
                if len(blocks) == 1 or size >= group_bytes:
                    yield from flush(group)
                    group, size = [], 0
        if group:
            yield from flush(group)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    return docs.mapInArrow(step, f"{schema}, {_FOUND}")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win FROM b, LATERAL (SELECT unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i) WHERE len(w) > 0),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win FROM d, sizes, LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i) WHERE len(w) >= k),
m AS (SELECT doc_id, item_id, i, bw.k FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
