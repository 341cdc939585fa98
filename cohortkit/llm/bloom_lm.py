"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs over the training texts are quantised on a log scale; an n-gram of level
q is entered q times, as (n-gram, 1) to (n-gram, q). A count is read back by probing level after level
until one is absent, so an n-gram is never read lower than it was entered. The filter has one segment for each hash
bucket of the counts, so each bucket's task sets its own bits. A segment has BITS_PER_ENTRY bits for each entry of its
bucket, so the filter grows with the n-grams found: what is entered and the error rate are the same at every size.

The segments are a Parquet table. While they have at most ``BROADCAST_BYTES`` in all they are broadcast, and the task of
a batch of texts probes them itself: all segments at once, so that its work follows its words and not the number of
buckets. A larger filter never meets in one place: a batch asks each bucket for the levels of its words and pairs, and
the bucket reads them from its own segment. Either way the levels, and so the scores, are the same; the texts are scored
with smoothed probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import (ASK, ASK_SQL, Scratch, answered, answers, batched, bucket_of, deal, in_order,
                                  join64, mix64, read_table, shuffle_partitions, text_groups, unpack, utf8_buffer, word_names)

BITS_PER_ENTRY, HASHES, GROWTH = 12, 5, 1.25
#: The filter is broadcast while its segments have at most this many bytes in all, as measured on the written table.
BROADCAST_BYTES = 16 << 20
#: Pairs are entered and asked by the low 48 bits of their names; the bucket is that of the whole name.
PAIR_BITS = np.uint64(2**48 - 1)
#: A pair's share of its history weighs PAIR_WEIGHT * c / (c + PAIR_HALF) against the word's own probability.
PAIR_WEIGHT, PAIR_HALF = 0.5, 2.0
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
PROBES = 1 << 16


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word names with an end after each text, names of the pairs that end in them, starts)."""
    words, first = word_names(data, offsets, lower=True)
    n = len(first) - 1
    starts = first + np.arange(n + 1)
    names = np.full(len(words) + n, END, np.uint64)
    names[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))] = words
    before = np.append(START, names[:-1])[:len(names)]
    before[starts[:-1]] = START
    return names, join64(before, names, 2), starts


def thresholds() -> np.ndarray:
    """Least count of each level: 1, 2, 3, ... as long as the steps are below GROWTH, then growing by it."""
    out = [1]
    while out[-1] < 2**62 // 2:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * GROWTH))))
    return np.array(out, np.int64)


THRESHOLDS = thresholds()


def level_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, np.asarray(count).astype(np.int64), side="right")


def count_at(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that have this level; 0 at level 0."""
    low = THRESHOLDS[np.maximum(level, 1) - 1]
    return np.where(level > 0, (low + np.maximum(low, THRESHOLDS[np.minimum(level, len(THRESHOLDS) - 1)] - 1)) / 2, 0.0)


def places(key: np.ndarray, level: int, bits: int | np.ndarray) -> np.ndarray:
    """Bits of (n-gram, level) in its segment of so many bits, one row per hash."""
    h = mix64(key + np.uint64(level * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    one, two = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return (one[None, :] + np.arange(HASHES, dtype=np.uint64)[:, None] * two[None, :]) % np.asarray(bits, np.uint64)


def levels(segment: np.ndarray, key: np.ndarray, first: int = 1,
           own: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Level of each n-gram of a segment's bucket: probes go on while they are answered. Some at a time, to bound the memory.

    ``segment`` may hold the segments of several buckets: ``own`` then tells for each n-gram where its own begins and how
    long it is, in bits. An n-gram whose bucket has none is at level 0.
    """
    out = np.zeros(len(key), np.uint8)
    for begin in range(0, len(key) if len(segment) else 0, PROBES):
        left = np.arange(begin, min(begin + PROBES, len(key)))
        if own is not None:
            left = left[own[1][left] > 0]
        for level in range(first, len(THRESHOLDS) + 1):
            there = np.ones(len(left), bool)
            for row in places(key[left], level, 8 * len(segment) if own is None else own[1][left]):
                some = np.flatnonzero(there)
                place = row[some] if own is None else row[some] + own[0][left[some]]
                there[some] = segment[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            left = left[there]
            if not len(left):
                break
            out[left] = level
    return out


def filled(found: list[tuple[np.ndarray, np.ndarray]], bits_per_entry: int = BITS_PER_ENTRY) -> bytes:
    """The segment of (keys, counts): each n-gram from the first level up to its own."""
    level = [level_of(n) for _, n in found]
    flags = np.zeros(max(64, -(-sum(int(q.sum()) for q in level) * bits_per_entry // 8) * 8), bool)
    for (key, _), q in zip(found, level):
        for j in range(1, int(q.max(initial=0)) + 1):
            some = key[q >= j]
            for begin in range(0, len(some), PROBES):
                flags[places(some[begin:begin + PROBES], j, len(flags)).reshape(-1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def short(key: np.ndarray) -> bytes:
    """The low six bytes of each key."""
    return np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def widened(data: bytes) -> np.ndarray:
    """Inverse of ``short``, the high bytes being zero."""
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view(np.uint64)


COUNTED_SQL = "bucket int, order int, data binary"
COUNTED = pa.schema([("bucket", pa.int32()), ("order", pa.int32()), ("data", pa.binary())])


SEGMENTS_SQL = "bucket int, tokens long, words long, documents long, bits binary"


def segments(texts: DataFrame, n_buckets: int, bits_per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """A row for each bucket: the tokens, words and starts counted in it, and its segment of the filter over all texts.

    Each task combines its own counts before the shuffle. Pairs that a task saw once travel as six-byte keys.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, 8 << 20):
            data, offsets, _ = utf8_buffer(batch.column("text"))
            names, pairs, _ = tokens(data, offsets)
            rows = []
            for order, keys in ((1, np.append(names, np.full(batch.num_rows, START))), (2, pairs)):
                key, n = np.unique(keys, return_counts=True)
                at, bounds = deal(key, n_buckets)
                for b in np.flatnonzero(np.diff(bounds)).tolist():
                    mine = at[bounds[b]:bounds[b + 1]]
                    once = n[mine] == 1
                    if order == 2:
                        rows.append((b, 3, short(key[mine[once]])))
                        mine = mine[~once]
                        key_, n_ = key[mine] & PAIR_BITS, n[mine]
                    else:
                        key_, n_ = key[mine], n[mine]
                    rows.append((b, order, key_.tobytes() + n_.astype(np.uint64).tobytes()))
            b, order, data_ = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(order, pa.int32()),
                                              pa.array(data_, pa.binary())], schema=COUNTED)

    def total(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, dict[int, list[bytes]]] = {}
        for r in rows:
            for b, order, data in zip(*(r.column(c).to_pylist() for c in ("bucket", "order", "data"))):
                got.setdefault(b, {}).setdefault(order, []).append(data)
        for b, by in got.items():
            found, n_tokens, n_words, n_docs = [], 0, 0, 0
            for order in (1, 2):
                parts = [unpack(x, np.uint64, np.uint64) for x in by.pop(order, [])]
                keys, n = [p[0] for p in parts], [p[1] for p in parts]
                if order == 2:
                    for x in by.pop(3, []):
                        keys.append(widened(x))
                        n.append(np.ones(len(keys[-1]), np.uint64))
                if not keys:
                    continue
                key = np.concatenate(keys)
                at = np.argsort(key, kind="stable")
                key, count_ = key[at], np.concatenate(n)[at]
                new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
                if len(new):
                    key, count_ = key[new], np.add.reduceat(count_, new)
                if order == 1:
                    word = key != START
                    n_tokens, n_words, n_docs = int(count_[word].sum()), int(word.sum()), int(count_[~word].sum())
                found.append((key, count_))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), *[pa.array([x], pa.int64()) for x in (n_tokens, n_words, n_docs)],
                 pa.array([filled(found, bits_per_entry)], pa.binary())], names=["bucket", "tokens", "words", "documents", "bits"])

    return texts.select("text").mapInArrow(count, COUNTED_SQL).repartitionById(n_buckets, F.col("bucket")).mapInArrow(
        total, SEGMENTS_SQL)


def joined(found: dict[int, bytes], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(all segments one after the other, where in them the segment of each bucket begins, in bytes, and the last ends)."""
    by = [found.get(b, b"") for b in range(n_buckets)]
    return np.frombuffer(b"".join(by), np.uint8), np.cumsum([0, *map(len, by)])


def levels_in(filter_: tuple[np.ndarray, np.ndarray], key: np.ndarray, bucket: np.ndarray, first: int = 1) -> np.ndarray:
    """Level of n-grams of any buckets from ``joined`` segments, in as many rounds of probes as for one bucket."""
    bits, begin = filter_
    begin = 8 * begin.astype(np.uint64)
    return levels(bits, key, first, (begin[bucket], np.diff(begin)[bucket]))


@dataclass
class BloomModel:
    """The filter, a table with a segment for each bucket, and what else scoring needs: a few numbers."""

    filter: DataFrame
    segments: int
    tokens: int
    words: int
    documents: int
    bytes: int

    def levels(self, key: np.ndarray, bucket: np.ndarray, first: int) -> np.ndarray:
        """Level of some n-grams, for a look at the model: one segment at a time comes to the driver."""
        out = np.zeros(len(key), np.int64)
        for r in self.filter.where(F.col("bucket").isin(np.unique(bucket).tolist())).toLocalIterator():
            at = np.flatnonzero(bucket == r["bucket"])
            out[at] = levels(np.frombuffer(r["bits"], np.uint8), key[at], first)
        return out

    def broadcast(self) -> Broadcast:
        """``joined`` segments, for all workers. Only for a filter whose ``bytes`` are known to be few."""
        found = {r["bucket"]: r["bits"] for r in self.filter.select("bucket", "bits").collect()}
        return self.filter.sparkSession.sparkContext.broadcast(joined(found, self.segments))


def fit(train: DataFrame, bits_per_entry: int = BITS_PER_ENTRY) -> BloomModel:
    """The model of all texts of ``train``. Its table stays until the session ends, as the scores read it."""
    spark = train.sparkSession
    n_buckets = shuffle_partitions(spark)
    table = Scratch(spark, "bloomlm").write(segments(train, n_buckets, bits_per_entry), "filter")
    total = table.agg(F.sum("tokens"), F.sum("words"), F.sum("documents"), F.sum(F.octet_length("bits"))).first()
    return BloomModel(table, n_buckets, *[int(x or 0) for x in total])


def score(docs: DataFrame, train: str = "true", broadcast_bytes: int = BROADCAST_BYTES,
          bits_per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """Log10 probabilities of all texts by a model of the texts for which the SQL condition ``train`` holds.

    ``docs`` has doc_id and text. Result, one row per row: doc_id, n_tokens (words and one end), n_known (of them, those
    found in a training text), train_tokens, base_score (words alone, exact counts, half a count added to each), score
    (the model). A null text is empty: it has only its end, and counts as a text of the training if its row does. A
    condition that is null does not hold. Without training texts all counts are 0. An empty table gives an empty result.
    A very long text is scored whole, in one task with its batch. Other columns of ``docs`` are not looked at.

    A filter of at most ``broadcast_bytes`` is broadcast, a larger one is asked bucket by bucket; the scores are equal.
    """
    spark = docs.sparkSession
    flagged = docs.select("doc_id", "text", F.coalesce(F.expr(train), F.lit(False)).alias("train"))
    lm = fit(flagged.where("train"), bits_per_entry)
    near = lm.broadcast() if lm.bytes <= broadcast_bytes else None
    n_tokens, n_words, begin = lm.tokens, lm.words, float(count_at(level_of(np.array([lm.documents])))[0])
    table, parts = batched(flagged, rest=True)

    def ask(group: pa.Table) -> pa.Table:
        """A row for each bucket: the number of its words, the words, their counts in training texts, the pairs."""
        group = in_order(group)
        data, offsets, _ = utf8_buffer(group.column("text"))
        names, pairs, starts = tokens(data, offsets)
        use = np.asarray(group.column("rest").combine_chunks().field("train"), dtype=bool)
        key, at = np.unique(names, return_inverse=True)
        n = np.bincount(at, np.repeat(use, np.diff(starts)), len(key)).astype(np.uint64)
        pair = np.unique(pairs) if near is None else pairs[:0]
        (order, cut), (pair_order, pair_cut) = deal(key, parts), deal(pair, parts)
        rows = []
        for b in np.flatnonzero(np.diff(cut) + np.diff(pair_cut)).tolist():
            mine = order[cut[b]:cut[b + 1]]
            rows.append((b, len(mine).to_bytes(8, "little") + key[mine].tobytes() + n[mine].tobytes()
                         + short(pair[pair_order[pair_cut[b]:pair_cut[b + 1]]])))
        batch = group.column("batch")[0].as_py()
        return pa.table({"bucket": [b for b, _ in rows], "batch": [batch] * len(rows), "kind": [0] * len(rows),
                         "data": [d for _, d in rows]}, schema=ASK)

    def read(asked: list[tuple[int, bytes]], held: bytes = b"") -> list[bytes]:
        """For each row the counts of its words over all batches, the levels of its words and those of its pairs.

        No levels are read, and no pairs asked, where the batches have the filter themselves.
        """
        segment = np.frombuffer(held, np.uint8)
        words = [int.from_bytes(d[:8], "little") for _, d in asked]
        key, at = np.unique(np.concatenate([np.frombuffer(d, np.uint64, k, 8) for (_, d), k in zip(asked, words)]),
                            return_inverse=True)
        n = np.concatenate([np.frombuffer(d, np.uint64, k, 8 + 8 * k) for (_, d), k in zip(asked, words)])
        n, level = np.bincount(at, n, len(key)).astype(np.uint64)[at], levels(segment, key)[at]
        pairs = [widened(d[8 + 16 * k:]) for (_, d), k in zip(asked, words)]
        pair, pair_at = np.unique(np.concatenate(pairs), return_inverse=True)
        pair_level = levels(segment, pair)[pair_at]
        ends, pair_ends = np.cumsum(words)[:-1], np.cumsum([len(p) for p in pairs])[:-1]
        return [x.tobytes() + y.tobytes() + z.tobytes() for x, y, z in zip(
            np.split(n, ends), np.split(level, ends), np.split(pair_level, pair_ends))]

    def finish(group: pa.Table, said: pa.Table) -> pa.Table:
        group = in_order(group)
        data, offsets, _ = utf8_buffer(group.column("text"))
        names, pairs, starts = tokens(data, offsets)
        key, at = np.unique(names, return_inverse=True)
        pair, pair_at = np.unique(pairs, return_inverse=True)
        (order, cut), (pair_order, pair_cut) = deal(key, parts), deal(pair if near is None else pair[:0], parts)
        exact, level, pair_level = np.zeros(len(key)), np.zeros(len(key), np.int64), np.zeros(len(pair), np.int64)
        if near is not None:
            level = levels_in(near.value, key, bucket_of(key, parts))
            pair_level = levels_in(near.value, pair & PAIR_BITS, bucket_of(pair, parts))
        replies, _ = answered(said)
        for b in np.flatnonzero(np.diff(cut) + np.diff(pair_cut)):
            mine = order[cut[b]:cut[b + 1]]
            exact[mine] = np.frombuffer(replies[b], np.uint64, len(mine))
            if near is None:
                level[mine] = np.frombuffer(replies[b], np.uint8, len(mine), 8 * len(mine))
                pair_level[pair_order[pair_cut[b]:pair_cut[b + 1]]] = np.frombuffer(replies[b], np.uint8, offset=9 * len(mine))
        floor = n_tokens + 0.5 * (n_words + 1)
        base = np.log10((exact + 0.5) / floor)[at]
        # the model: words and pairs as the filter tells their counts
        word = count_at(level)
        alone = (word + 0.5) / floor
        both = count_at(pair_level)[pair_at]
        history = np.append(0.0, word[at][:-1])[:len(names)]
        history[starts[:-1]] = begin
        weight = PAIR_WEIGHT * history / (history + PAIR_HALF)
        model_p = weight * np.minimum(both, history) / np.maximum(history, 1) + (1 - weight) * alone[at]
        per = np.add.reduceat(np.stack([base, np.log10(model_p), exact[at] > 0]), starts[:-1], axis=1)
        return pa.table({"doc_id": group.column("doc_id"), "n_tokens": pa.array(np.diff(starts), pa.int64()),
                         "n_known": pa.array(per[2].astype(np.int64)), "train_tokens": pa.array([n_tokens] * len(per[0]), pa.int64()),
                         "base_score": pa.array(per[0]), "score": pa.array(per[1])})

    by = table.groupBy("batch")
    held = lm.filter.select("bucket", F.col("bits").alias("data")) if near is None else None
    said = answers(by.applyInArrow(ask, ASK_SQL), parts, read, held)
    said = said.repartition(parts, "batch")
    return by.cogroup(said.groupBy("batch")).applyInArrow(
        finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_bloom_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id has no fold: such a row is scored, not held out and not learned from."""
    fold = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5)"
    return score(read_table(spark, sf_dir, "documents"), train=f"{fold} <> 1").select(
        "doc_id", F.expr(f"coalesce({fold} = 1, false)").alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
