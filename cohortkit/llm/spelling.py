"""Spelling variants grouped around their most frequent near form, by Bloom-guided neighbourhoods.

The vocabulary is held in blocked Bloom filters, one for each word length, which are broadcast. Every word generates its
edits and asks the filters: all deletions of one code point, and all replacements of one code point by a greater one that
words of its length hold. An insertion is the deletion of the longer word, a replacement by a smaller one the greater
word's, so each near pair is generated from one of its two words. An edit's hash follows from its word's in constant time.
Only edits that a filter holds are spelled out and shuffled to an exact join with the vocabulary, which removes those
that are no words. So the filters' size changes the work and never the result; it is bounded by MAX_FILTER_BYTES.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import Scratch, mix64, read_table, shuffle_partitions, text_groups, utf8_buffer

#: Fixed values of the contract: which runs are words, and one run in how many loses a code point.
RUN = "A-Za-zÀ-ÿ"
DROPPED = 97
MIN_LENGTH, MIN_COUNT, FORM_RATIO = 5, 3, 2

MAX_FILTER_BYTES = 64 << 20  # of all filters together; a larger vocabulary has more false positives
BITS_PER_WORD = 24
LONGEST = 64  # words of this length and longer share one filter
SEGMENT = 1 << 16  # blocks of 64 bits that one row of a filter holds
HELD_WORDS = 400_000  # counts that a task holds before it passes them on
PROBES = 1 << 20  # edits hashed at a time

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


# ---------------------------------------------------------------- words

def run_counts(docs: DataFrame) -> DataFrame:
    """(word, n): lower-cased runs of at least MIN_LENGTH code points, after the drop of the contract, by task."""
    runs = re.compile(f"[{RUN}]{{{MIN_LENGTH},}}")

    def rows(counts: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if n and len(w) >= MIN_LENGTH]
        return pa.record_batch({"word": pa.array([w for w, _ in kept], pa.string()), "n": pa.array([n for _, n in kept], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in text_groups(batches):
            data, offsets, _ = utf8_buffer(batch.column("text"))
            raw = data[offsets[0]:offsets[-1]].tobytes().translate(_LOWER)
            cuts = (offsets - offsets[0]).tolist()
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), cuts, cuts[1:]):
                found = Counter(runs.findall(raw[a:b].decode()))
                counts.update(found)
                begun = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
                begun = zlib.crc32(b":", begun)
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), begun)
                    if h % DROPPED == 0:
                        at = h % len(word)
                        counts[word] -= n
                        counts[word[:at] + word[at + 1:]] += n
            if len(counts) > HELD_WORDS:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").where("text is not null").mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with at least MIN_COUNT occurrences."""
    return run_counts(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# ---------------------------------------------------------------- hashes and filters

def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def values(points: np.ndarray) -> np.ndarray:
    return mix64(points.astype(np.uint64) + np.uint64(0x51ED270B))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the words of one length, their code points as a matrix)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for places in np.split(order, cuts) if len(order) else ():
        length = int(lengths[places[0]])
        for at in range(0, len(places), max(1, PROBES // length)):
            some = places[at:at + max(1, PROBES // length)]
            joined = "".join([words[i] for i in some.tolist()]).encode("utf-32-le")
            yield some, np.frombuffer(joined, "<u4").reshape(len(some), length)


def shard(length: int) -> int:
    return min(length, LONGEST)


class Filters:
    """Blocked Bloom filters by word length in one array: a word is four bits of one 64-bit block of its length's filter."""

    def __init__(self, words_of: dict[int, int]):
        blocks = {s: max(1, n * BITS_PER_WORD // 64) for s, n in words_of.items()}
        over = max(1.0, 8 * sum(blocks.values()) / MAX_FILTER_BYTES)
        self.begin, self.n, at = {}, {}, 0
        for s in sorted(blocks):
            self.begin[s], self.n[s] = at, max(1, int(blocks[s] / over))
            at += self.n[s]
        self.size = at

    def place(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, mask) of words of one length, from their hashes."""
        h = mix64(hashes)
        s = shard(length)
        block = ((h >> np.uint64(32)) * np.uint64(self.n[s]) >> np.uint64(32)).astype(np.int64) + self.begin[s]
        mask = np.zeros(len(h), np.uint64)
        for k in range(4):
            mask |= np.uint64(1) << (h >> np.uint64(6 * k) & np.uint64(63))
        return block, mask

    def holds(self, bits: np.ndarray, length: int, hashes: np.ndarray) -> np.ndarray:
        if shard(length) not in self.n:
            return np.zeros(len(hashes), bool)
        block, mask = self.place(length, hashes)
        return bits[block] & mask == mask


def alphabets(words: DataFrame) -> tuple[dict[int, int], dict[int, list[int]]]:
    """(number of words, code points held) by length: at most LONGEST rows of one alphabet reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, points = Counter(), {}
        for batch in batches:
            for places, chars in by_length(batch.column("word").to_pylist()):
                s = shard(chars.shape[1])
                n[s] += len(places)
                points.setdefault(s, set()).update(np.unique(chars).tolist())
        found = [(s, p) for s in sorted(n) for p in [0, *sorted(points[s])]]
        yield pa.record_batch({"shard": pa.array([s for s, _ in found], pa.int32()), "point": pa.array([p for _, p in found], pa.int32()),
                               "n": pa.array([0 if p else n[s] for s, p in found], pa.int64())})

    rows = words.select("word").mapInArrow(run, "shard int, point int, n long").groupBy("shard", "point").agg(F.sum("n").alias("n")).collect()
    held: dict[int, list[int]] = {}
    for r in rows:
        if r["point"]:
            held.setdefault(r["shard"], []).append(r["point"])
    return {r["shard"]: r["n"] for r in rows if not r["point"]}, {s: sorted(p) for s, p in held.items()}


def built(words: DataFrame, filters: Filters) -> np.ndarray:
    """The bits of all filters: each task hashes its words, each segment is put together in one task, rows of bytes reach
    the driver, MAX_FILTER_BYTES of them at most."""
    segments = -(-filters.size // SEGMENT)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chars in by_length(batch.column("word").to_pylist()):
                length = chars.shape[1]
                block, mask = filters.place(length, (values(chars) * powers(length)).sum(axis=1, dtype=np.uint64))
                order = np.argsort(block)
                block, mask = block[order], mask[order]
                cuts = np.searchsorted(block, np.arange(segments + 1) * SEGMENT)
                full = np.flatnonzero(np.diff(cuts)).tolist()
                yield pa.record_batch({"segment": pa.array(full, pa.int32()), "data": pa.array(
                    [(block[cuts[s]:cuts[s + 1]] - s * SEGMENT).astype("<u4").tobytes() + mask[cuts[s]:cuts[s + 1]].tobytes()
                     for s in full], pa.binary())})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, data in zip(batch.column("segment").to_pylist(), batch.column("data").to_pylist()):
                bits = out.setdefault(s, np.zeros(SEGMENT, np.uint64))
                n = len(data) // 12
                np.bitwise_or.at(bits, np.frombuffer(data, "<u4", n), np.frombuffer(data, np.uint64, n, 4 * n))
        yield pa.record_batch({"segment": pa.array(list(out), pa.int32()), "data": pa.array([b.tobytes() for b in out.values()], pa.binary())})

    bits = np.zeros(segments * SEGMENT, np.uint64)
    made = words.select("word").mapInArrow(hashed, "segment int, data binary")
    tasks = min(segments, shuffle_partitions(words.sparkSession))
    for r in made.repartition(tasks, "segment").mapInArrow(joined, "segment int, data binary").toLocalIterator():
        bits[r["segment"] * SEGMENT:(r["segment"] + 1) * SEGMENT] = np.frombuffer(r["data"], np.uint64)
    return bits[:filters.size]


# ---------------------------------------------------------------- neighbours

def edits(words: list[str], filters: Filters, bits: np.ndarray, points: dict[int, list[int]]) -> Iterator[tuple[int, str]]:
    """(place of the word, edit) of the edits that a filter holds."""
    for places, chars in by_length(words):
        length = chars.shape[1]
        up, own = powers(length), values(chars)
        terms = own * up
        prefix = np.zeros((len(places), length + 1), np.uint64)
        np.cumsum(terms, axis=1, out=prefix[:, 1:])
        whole = prefix[:, -1:]
        if length > MIN_LENGTH:  # of equal neighbours only the first is deleted
            hashes = prefix[:, :-1] + (whole - prefix[:, 1:]) * _BACK
            fresh = np.ones(chars.shape, bool)
            fresh[:, 1:] = chars[:, 1:] != chars[:, :-1]
            rows, cols = np.nonzero(fresh)
            found = filters.holds(bits, length - 1, hashes[rows, cols])
            for r, c in zip(rows[found].tolist(), cols[found].tolist()):
                word = words[places[r]]
                yield places[r], word[:c] + word[c + 1:]
        rest = whole - terms
        for point in points[shard(length)]:
            rows, cols = np.nonzero(chars < point)
            found = filters.holds(bits, length, rest[rows, cols] + values(np.array([point])) * up[cols])
            letter = chr(point)
            for r, c in zip(rows[found].tolist(), cols[found].tolist()):
                word = words[places[r]]
                yield places[r], word[:c] + letter + word[c + 1:]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words that differ by one inserted, deleted or replaced code point, once."""
    context = words.sparkSession.sparkContext
    words_of, points = alphabets(words)
    filters = Filters(words_of)
    bits = context.broadcast(built(words, filters) if words_of else np.zeros(0, np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                found = list(edits(part.column("word").to_pylist(), filters, bits.value, points))
                place = pa.array([int(p) for p, _ in found], pa.int64())
                yield pa.record_batch({"word": part.column("word").take(place), "n": part.column("n").take(place),
                                       "near": pa.array([e for _, e in found], pa.string())})

    probed = words.select("word", "n").repartition(shuffle_partitions(words.sparkSession)).mapInArrow(run, "word string, n long, near string")
    return probed.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n: the near word of largest n (ties: the smallest) where its n is FORM_RATIO times the word's."""
    both = pairs.select("word", "n", F.col("near").alias("other"), F.col("near_n").alias("other_n")).unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    alone = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    best = F.when(F.col("other_n") >= FORM_RATIO * F.col("n"), F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    found = both.unionByName(alone).groupBy("word").agg(F.first("n").alias("n"), F.count("other").alias("n_near"), F.min(best).alias("best"))
    return found.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(scratch: Scratch, found: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by pointer jumping: each round doubles the steps taken.

    Counts at least double from a word to its form, so no way has over 63 steps and six rounds are enough.
    """
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    for i in range(7):
        links = scratch.write(links, f"links{i}")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(onward, "root", "left")
        if joined.where("next is not null").limit(1).count() == 0:
            break
        links = joined.select("word", F.coalesce("next", "root").alias("root"))
    return links


def spelling_groups(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text; other columns are ignored): word, n, n_near, form, form_n, root.

    Words are runs of Latin letters of at least five code points, lower-cased in A-Z, three times or more in all rows. A
    run whose crc32 of "doc_id:run" is divisible by 97 loses one code point first. A null text has none, a null doc_id
    stands as nothing before the colon. Repeated rows and ids count each time. Words with equally frequent near words take
    the one smallest in code-point order. Very long runs are words like others. An empty table, or one without words,
    gives an empty result. Columns of the names used inside don't clash, as only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.write(vocabulary(docs), "words")
    found = scratch.write(forms(words, near_pairs(words)), "forms")
    return found.join(roots(scratch, found), "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "n", "n_near", "form", "form_n", "root")


def op13_bloom_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(read_table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS step),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{RUN}]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
r AS (SELECT doc_id, run, count(*) AS k FROM low GROUP BY ALL),
h AS (SELECT run, k, xor(4294967295, list_reduce(
    flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
      CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 | (unicode(c) >> 6))::BIGINT, (128 | (unicode(c) & 63))::BIGINT] END)),
    lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS h FROM r, t),
e AS (SELECT CASE WHEN h % {DROPPED} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
v AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM e WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
d AS MATERIALIZED (SELECT DISTINCT word, n, i, left(word, i) || substr(word, i + 2) AS shorter FROM v, unnest(range(length(word))) u(i)),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.i = b.i AND a.shorter = b.shorter AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM d a JOIN v b ON a.shorter = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM d a JOIN v b ON a.shorter = b.word),
b AS (SELECT word, count(*) AS n_near, min(CASE WHEN near_n >= {FORM_RATIO} * n THEN {{'m': -near_n, 'w': near}} END) AS best FROM p GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, best.w AS form, (-best.m)::BIGINT AS form_n FROM v LEFT JOIN b USING (word)),
go AS (SELECT word, word AS place, 0 AS steps FROM f UNION ALL SELECT go.word, f.form, steps + 1 FROM go JOIN f ON f.word = place WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(place, steps) AS root FROM go GROUP BY word)
SELECT f.*, root FROM f JOIN last USING (word)"""
