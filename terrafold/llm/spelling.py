"""Groups of words that differ by one letter, with forward and backward minimal automata (operator 12).

Two words are near if one inserted, deleted or replaced code point tells them apart. With m the length of the shorter one
they then agree in their first or in their last m // 2 letters. So a word falls to a group for each half that a near
word may share with it: its first and its last m // 2 letters, and, if m is even, those of words one letter shorter.
Groups are dealt to shards of about `shard_letters` letters. A shard holds its words in a minimal acyclic automaton, forward
for first halves and of the reversed words for last ones, of which each edge tells how many words come before it, so that
a path gives a word's number. A word is matched exactly through its half, then completed with one error at any place;
numbers reached twice count once, and a pair that both directions find belongs to the forward one (`route`).

No pair leaves a shard: it returns, for each word, how many near words it found and the commonest of them. A half that very
many words share is a group of its own size; groups above `shard_letters` are split again by the halves of what the shared
part leaves of their words, until that is so short that its alphabet bounds the group; `FEW` words stay together however long. The driver sees counts only; what is
broadcast is one key for each such group, of which there is at most one for every `shard_letters` letters of the groups.

A word's form is its commonest near word (ties: the smallest in code-point order) if that occurs at least `RATIO` times as
often. Forms at least double the count, so chains are short, and their ends, the roots, are found by pointer doubling.

Defined cases: a null or empty text has no words; very long texts and words are read whole; a row without doc_id counts, but
none of its letters slip; repeated rows count as often as they stand there; an empty table gives an empty result; other
columns are left out, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import LOWER_ASCII, byte_lists, cut, keep

WORD = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
SLIP = 97
SHARD_LETTERS, FEW = 500_000, 16
_HELD_WORDS = 200_000
_MAX_KEYS = 1_000_000


def slipped(word: str, doc_id: int, every: int) -> str:
    """The word, without one letter if the checksum of `doc_id:word` is divisible by `every`."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, slip: int | None = None) -> DataFrame:
    """word, n of all lower-cased words (runs of `WORD`) of whole texts; counted in the tasks before they are moved."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), byte_lists(batch["text"]), strict=True):
                found = Counter(WORD.findall(text.translate(LOWER_ASCII).decode()))
                if slip is None or doc_id is None:
                    held.update(found)
                else:
                    for word, n in found.items():
                        held[slipped(word, doc_id, slip)] += n
                if len(held) > _HELD_WORDS:
                    yield rows()
                    held = Counter()
        yield rows()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Automaton:
    """A minimal acyclic automaton of sorted distinct words. `step[state]` maps a letter to the next state and to the
    number of the state's words that come before those behind it; so the sum along a word's path is its number."""

    def __init__(self, words: list[str]):
        self.step: list[dict[str, tuple[int, int]]] = []
        self.ends: list[bool] = []
        self._size: list[int] = []
        self._known: dict[tuple, int] = {}
        edges: list[list[tuple[str, int]]] = [[]]
        ends = [False]
        before = ""
        for word in words:
            same = 0
            while same < len(before) and same < len(word) and before[same] == word[same]:
                same += 1
            self._close(before, same, edges, ends)
            edges += [[] for _ in range(len(word) - same)]
            ends += [False] * (len(word) - same)
            ends[-1] = True
            before = word
        self._close(before, 0, edges, ends)
        self.root = self._state(edges[0], ends[0])
        del self._known, self._size

    def _close(self, word: str, depth: int, edges: list, ends: list) -> None:
        """Replaces the states of `word` below `depth` by registered ones."""
        for i in range(len(word), depth, -1):
            state = self._state(edges.pop(), ends.pop())
            edges[i - 1].append((word[i - 1], state))

    def _state(self, edges: list[tuple[str, int]], ends: bool) -> int:
        key = (ends, *edges)
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.step)
            before, out = int(ends), {}
            for letter, child in edges:
                out[letter] = (child, before)
                before += self._size[child]
            self.step.append(out)
            self.ends.append(ends)
            self._size.append(before)
        return state

    def _complete(self, state: int, number: int, word: str, at: int, found: set[int]) -> None:
        step = self.step
        for letter in word[at:]:
            edge = step[state].get(letter)
            if edge is None:
                return
            state, number = edge[0], number + edge[1]
        if self.ends[state]:
            found.add(number)

    def near(self, word: str, exact: int) -> set[int]:
        """Numbers of the words that one error behind the first `exact` letters makes of `word`."""
        step, found = self.step, set()
        state, number, n = self.root, 0, len(word)
        for letter in word[:exact]:
            edge = step[state].get(letter)
            if edge is None:
                return found
            state, number = edge[0], number + edge[1]
        for at in range(exact, n + 1):
            here = word[at] if at < n else ""
            after = word[at + 1] if at + 1 < n else ""
            for letter, (child, before) in step[state].items():
                if (here in step[child]) if here else self.ends[child]:
                    self._complete(child, number + before, word, at, found)  # inserted
                if here and letter != here and ((after in step[child]) if after else self.ends[child]):
                    self._complete(child, number + before, word, at + 1, found)  # replaced
            if not here:
                break
            if (after in step[state]) if after else self.ends[state]:
                self._complete(state, number, word, at + 1, found)  # deleted
            edge = step[state].get(here)
            if edge is None:
                break
            state, number = edge[0], number + edge[1]
        return found


def route(a: str, b: str, depth: int) -> str:
    """Of near words, the groups' path that is theirs: half by half, the first one if they share it, else the last."""
    path, p, s = "", 0, 0
    for _ in range(depth):
        x, y = a[p : len(a) - s], b[p : len(b) - s]
        k = min(len(x), len(y)) // 2
        if x[:k] == y[:k]:
            path, p = f"{path}F{k}", p + k
        else:
            path, s = f"{path}B{k}", s + k
    return path


def _searched(table: pa.Table) -> pa.Table:
    """A shard: near words, their number and the commonest, of each word."""
    words, counts, paths = (table[c].to_pylist() for c in ("word", "n", "path"))
    ahead, behind = table["ahead"].to_pylist(), table["behind"].to_pylist()
    n_of = dict(zip(words, counts, strict=True))
    best: dict[str, tuple[int, int, str]] = {}
    for way in ("F", "B"):
        mine = [i for i, path in enumerate(paths) if _last(path) == way]
        turn = (lambda w: w) if way == "F" else (lambda w: w[::-1])
        known = sorted({turn(words[i]) for i in mine})
        automaton = Automaton(known)
        for i in mine:
            word, path = words[i], paths[i]
            depth = path.count("F") + path.count("B")
            for number in automaton.near(turn(word), ahead[i] if way == "F" else behind[i]):
                other = turn(known[number])
                if route(word, other, depth) == path:
                    near, least, name = best.get(word, (0, 1, ""))
                    best[word] = (near + 1, *min((least, name), (-n_of[other], other)))
    return pa.table(
        [pa.array(list(best), pa.string()), *(pa.array([b[k] for b in best.values()], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.string())))],
        names=["word", "near", "least", "other"],
    )


def _last(path: str) -> str:
    return "F" if path.rfind("F") > path.rfind("B") else "B"


def _halved(members: DataFrame) -> DataFrame:
    """Members of groups (path, letters shared `ahead` and `behind`), once for each half of what these leave of them."""
    rest = F.length("word") - F.col("ahead") - F.col("behind")
    k = F.floor(rest / 2).cast("int")
    way = lambda name, size: F.struct(F.lit(name).alias("way"), size.alias("k"))
    both = F.array(way("F", k), way("B", k))
    halves = F.when(rest % 2 == 0, F.concat(both, F.array(way("F", k - 1), way("B", k - 1)))).otherwise(both)
    out = members.withColumn("_half", F.explode(halves)).where("_half.k >= 0")
    size, forward = F.col("_half.k"), F.col("_half.way") == "F"
    return out.select(
        "word",
        "n",
        F.concat("path", "_half.way", size.cast("string")).alias("path"),
        (F.col("ahead") + F.when(forward, size).otherwise(0)).alias("ahead"),
        (F.col("behind") + F.when(forward, 0).otherwise(size)).alias("behind"),
    ).withColumn("key", _key())


def _key() -> Column:
    n = F.length("word")
    return F.xxhash64("path", F.expr("substring(word, 1, ahead)"), F.substring("word", n - F.col("behind") + 1, F.col("behind")))


def near_words(vocabulary: DataFrame, shard_letters: int = SHARD_LETTERS, few: int = FEW) -> DataFrame:
    """word, n_near, best_n, best of the words (word, n; distinct) that have near words."""
    whole = vocabulary.select("word", "n", F.lit("").alias("path"), F.lit(0).alias("ahead"), F.lit(0).alias("behind"))
    members, done, letters = _halved(whole), None, 0
    while True:
        rest = F.length("word") - F.col("ahead") - F.col("behind")
        sizes = members.groupBy("key").agg(F.sum(F.length("word")).alias("size"), F.count(F.lit(1)).alias("words"), F.min(rest).alias("rest"))
        large = (F.col("size") > shard_letters) & (F.col("words") > few) & (F.col("rest") > 1)
        total, n_large = sizes.agg(F.sum("size"), F.count_if(large)).first()
        letters += total or 0
        if not n_large:
            break
        if n_large > _MAX_KEYS:
            raise ValueError(f"{n_large} groups of over {shard_letters} letters; their keys are held in memory by every task: raise shard_letters")
        keys = F.broadcast(cut(sizes.where(large).select("key")))
        small = members.join(keys, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        members = _halved(members.join(keys, "key", "left_semi"))
    members = members if done is None else done.unionByName(members)
    shards = max(1, -(-letters // shard_letters))
    dealt = members.withColumn("shard", F.pmod("key", F.lit(shards)))
    found = dealt.select("shard", "word", "n", "path", "ahead", "behind").groupBy("shard").applyInArrow(_searched, "word string, near bigint, least bigint, other string")
    merged = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("least", "other")).alias("_b"))
    return merged.select("word", "n_near", (-F.col("_b.least")).alias("best_n"), F.col("_b.other").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """word, root of links (word, root = form): each round follows as many forms as all before it."""
    while True:
        links = cut(links)
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        both = links.join(ahead, "root", "left")
        if both.where("_next is not null").isEmpty():
            return links
        links = both.select("word", F.coalesce("_next", "root").alias("root"))


def variants(counts: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, shard_letters: int = SHARD_LETTERS, few: int = FEW) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words (word, n; distinct) that are long and common enough."""
    words = keep(counts.where((F.length("word") >= least_length) & (F.col("n") >= least_count)).select("word", "n"))
    near = words.join(near_words(words, shard_letters, few), "word", "left")
    formed = F.col("best_n") >= RATIO * F.col("n")
    forms = keep(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")))
    roots = _roots(forms.where("form is not null").select("word", F.col("form").alias("root")))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), slip=SLIP))


#: Near words by what is left of them without one letter: both without the letter at one place, or one the other without a letter.
ORACLE = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(b AS BIGINT))) AS t),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)),
once AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (SELECT *, flatten(list_transform(list_transform(string_split(doc_id || ':' || run, ''), lambda s: CAST(unicode(s) AS BIGINT)), lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + c // 64, 128 + c % 64] END)) AS b FROM once),
sums AS (SELECT doc_id, run, n, xor(list_reduce(b, lambda c, x: xor(c // 256, list_extract(t, CAST(xor(c, x) % 256 AS BIGINT) + 1)), 4294967295), 4294967295) AS h FROM bytes, tab),
slips AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM sums),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slips GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
less AS (SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM v, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM less SEMI JOIN v ON v.word = less.rest UNION SELECT rest, word FROM less SEMI JOIN v ON v.word = less.rest),
ranked AS (SELECT pairs.word, other, o.n, count(*) OVER (PARTITION BY pairs.word) AS n_near, row_number() OVER (PARTITION BY pairs.word ORDER BY o.n DESC, other) AS r FROM pairs JOIN v o ON o.word = pairs.other),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN ranked.n >= 2 * v.n THEN other END AS form, CASE WHEN ranked.n >= 2 * v.n THEN ranked.n END AS form_n FROM v LEFT JOIN ranked ON ranked.word = v.word AND r = 1),
chain AS (SELECT word, word AS here, 0 AS far FROM forms UNION ALL SELECT c.word, f.form, far + 1 FROM chain c JOIN forms f ON f.word = c.here WHERE f.form IS NOT NULL)
SELECT forms.word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN (SELECT word, max_by(here, far) AS root FROM chain GROUP BY word) USING (word)
"""
