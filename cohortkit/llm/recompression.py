"""Substring deduplication by recompression.

The words of all documents get global names, and rounds of recompression name runs of equal symbols
and pairs of adjacent ones: a symbol that falls into the left class merges with a right-class symbol
after it, the class being a function of the symbol. Names are functions of what they stand for, so
equal substrings get equal symbols wherever they lie, but for symbols near their ends: each symbol
carries its *context*, the stretch of words that its being parsed so depends on.

Three Spark steps over doc_id ranges ("batches") that ask hash buckets of symbols:

1. Every batch parses its documents and asks for its low symbols, each with its context, and its
   high symbols, each with a second name made of the words it stands for, apart from any parse. A
   bucket tells of each whether it is there again, and whether it was there before.
2. A window that holds a whole context found nowhere else is unique. A window inside a high symbol
   that was there before, in both its names, is a repeat. The batch asks for the 96-bit names of the
   windows left over.
3. Repeats of both kinds are marked and the words that they cover are removed.

A group of copies thus costs one question per high symbol and copy, not one per window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import (ASK, ASK_SQL, answered, answers, ask_rows, batched, deal, firsts, fresh_powers, in_order, join64, mix64,
                                  read_table, release, replies_in_order, unpack, utf8_buffer, window_names, word_names)

LOW_ROUNDS = 4
HIGH_ROUNDS = (12, 16)
RUNS_AFTER = frozenset({0, 6, 9, 12, 14})
WORDS = 1 << 17  # of a batch that are parsed or named at a time, if texts are not longer: six numbers and their copies a word


@dataclass
class Parse:
    """Symbols of one round: name, words [begin, end), context [low, high), document.

    A symbol that was parsed as it was because its document begins or ends there has a context past that edge.
    """

    name: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray

    def runs(self, round_: int) -> Parse:
        """Each maximal run of equal symbols becomes one; that a run ends there is seen from its neighbours."""
        n = len(self.name)
        if not n:
            return self
        same = self.doc[1:] == self.doc[:-1]
        first = np.flatnonzero(np.append(True, ~(same & (self.name[1:] == self.name[:-1]))))
        last = np.append(first[1:], n) - 1
        low, high = np.minimum.reduceat(self.low, first), np.maximum.reduceat(self.high, first)
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
        inner = (first > 0) & (self.doc[before] == self.doc[first])
        low = np.where(inner, np.minimum(low, self.low[before]), low - 1)  # past the document's start: in no window
        inner = (last < n - 1) & (self.doc[after] == self.doc[first])
        high = np.where(inner, np.maximum(high, self.high[after]), high + 1)
        size = (last - first + 1).astype(np.uint64)
        name = np.where(size > 1, join64(self.name[first], size, 1000 + round_), self.name[first])
        return Parse(name, self.begin[first], self.end[last], low, high, self.doc[first])

    def pairs(self, round_: int) -> Parse:
        """A left-class symbol merges with the right-class symbol after it. An unmerged one has seen one neighbour."""
        if not len(self.name):
            return self
        left = (mix64(self.name ^ np.uint64(7919 * round_ + 13)) & np.uint64(1)).astype(bool)
        same = self.doc[1:] == self.doc[:-1]
        merges = np.append(left[:-1] & ~left[1:] & same, False)
        merged = np.append(False, merges[:-1])
        name, end, low, high = self.name.copy(), self.end.copy(), self.low.copy(), self.high.copy()
        one = np.flatnonzero(merges)
        name[one] = join64(self.name[one], self.name[one + 1], round_)
        end[one] = self.end[one + 1]
        alone = ~merges & ~merged
        sees_next = np.flatnonzero(alone & left & np.append(same, False))
        sees_last = np.flatnonzero(alone & ~left & np.append(False, same))
        for at, other in ((one, one + 1), (sees_next, sees_next + 1), (sees_last, sees_last - 1)):
            low[at] = np.minimum(self.low[at], self.low[other])
            high[at] = np.maximum(self.high[at], self.high[other])
        low[alone & ~left & ~np.append(False, same)] -= 1
        high[alone & left & ~np.append(same, False)] += 1
        k = ~merged
        return Parse(name[k], self.begin[k], end[k], low[k], high[k], self.doc[k])


class Batch:
    """The words of one batch's documents and what is asked about them."""

    def __init__(self, table: pa.Table, width: int):
        self.table, self.width = in_order(table), width
        data, offsets, _ = utf8_buffer(self.table.column("text"))
        self.names, self.starts = word_names(data, offsets)
        self.whole = ~spans(np.maximum(self.starts[1:] - width + 1, self.starts[:-1]), self.starts[1:], len(self.names))

    def stretches(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(begin, end, first word of each text, counted from begin, and the end): whole texts of WORDS words at most, or one longer text."""
        i = 0
        while i < len(self.starts) - 1:
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + WORDS, side="right")) - 1)
            begin, end = int(self.starts[i]), int(self.starts[j])
            if begin < end:
                yield begin, end, self.starts[i:j + 1] - begin
            i = j

    def symbols(self) -> None:
        """Low symbols with their contexts, high symbols of at least a window's length, and their keys.

        A symbol depends on its own text only, so the parse of a stretch at a time is that of the whole batch.
        """
        low, low_keys, high, high_keys = [], [self.names[:0]], [], [self.names[:0]]
        for begin, end, starts in self.stretches():
            words = self.names[begin:end]
            at = np.arange(len(words))
            parse = Parse(words, at, at + 1, at, at + 1, np.repeat(np.arange(len(starts) - 1), np.diff(starts))).runs(0)
            for r in range(1, max(HIGH_ROUNDS) + 1):
                parse = parse.pairs(r)
                if r in RUNS_AFTER:
                    parse = parse.runs(r)
                if r == LOW_ROUNDS:
                    use = (parse.high - parse.low <= self.width) & (parse.low >= starts[parse.doc]) \
                        & (parse.high <= starts[parse.doc + 1])
                    low_keys.append(self.context_names(words, parse.name[use], parse.low[use], parse.high[use]))
                    low.append((parse.low[use] + begin, parse.high[use] + begin))
                if r in HIGH_ROUNDS:
                    use = parse.end - parse.begin >= self.width
                    high.append((parse.begin[use] + begin, parse.end[use] + begin))
                    # a symbol that stays as it is from one round to a later one is asked about apart in each
                    high_keys.append(mix64(parse.name[use] + np.uint64(r)))
        none = (np.zeros(0, np.int64),) * 2
        self.low, self.high = (tuple(np.concatenate(x) for x in zip(none, *y)) for y in (low, high))
        self.low_keys, self.high_keys = np.concatenate(low_keys), np.concatenate(high_keys)

    def span_names(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """32-bit names of stretches of words of any length inside a text, from a rolling hash of the words."""
        out = np.zeros(len(begin), np.uint32)
        up, down = fresh_powers(0, max((b - a for a, b, _ in self.stretches()), default=0) + 1)
        for a, b, _ in self.stretches():
            mine = np.flatnonzero((begin >= a) & (begin < b))
            first, last = begin[mine] - a, end[mine] - a
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(mix64(self.names[a:b] + np.uint64(71)) * up[:b - a], out=sums[1:])
            out[mine] = mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)) >> np.uint64(32)
        return out

    def context_names(self, words: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Symbol and the words of its context as one name."""
        size, out, levels, step = high - low, np.zeros(len(low), np.uint64), mix64(words), 1
        while step <= self.width:
            mine = np.flatnonzero((size >= step) & (size < 2 * step))
            out[mine] = join64(levels[low[mine]], levels[high[mine] - step], step)
            if len(levels) <= step:
                break
            levels = join64(levels[:-step], levels[step:], 500 + step)
            step *= 2
        return join64(out, name, 17)

    def settle(self, again: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window starts known to be repeats, window starts still to be asked about), as flags by word.

        ``again``: low symbols that are anywhere else; ``before``: high symbols that were there before.
        """
        n = len(self.names)
        low, high = (x[~again] for x in self.low)
        begin, end = (x[before] for x in self.high)
        unique = spans(np.maximum(high - self.width, 0), low + 1, n)
        repeat = spans(begin, end - self.width + 1, n) & self.whole
        return repeat, self.whole & ~unique & ~repeat

    def windows(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96-bit names of the asked windows, in order."""
        one, two = [self.names[:0]], [np.zeros(0, np.uint32)]
        for begin, end, starts in self.stretches():
            name, at = window_names(self.names[begin:end], starts, self.width)
            use = asked[begin + at]
            one.append(name[use])
            name, _ = window_names(self.names[begin:end], starts, self.width, salt=99)
            two.append((name[use] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        return np.concatenate(one), np.concatenate(two)


def two_in_one(first: bytes, second: bytes) -> bytes:
    """What goes between a batch and a bucket about low and about high symbols, as one message."""
    return len(first).to_bytes(8, "little") + first + second


def one_of_two(data: bytes) -> tuple[bytes, bytes]:
    """Inverse of ``two_in_one``."""
    end = 8 + int.from_bytes(data[:8], "little")
    return data[8:end], data[end:]


def symbol_rows(number: int, batch: Batch, parts: int) -> pa.Table:
    """A batch's questions about its symbols: one row a bucket, of both kinds."""
    low_order, low_bounds = deal(batch.low_keys, parts)
    high_order, high_bounds = deal(batch.high_keys, parts)
    second = batch.span_names(*batch.high)
    filled = np.flatnonzero(np.diff(low_bounds) + np.diff(high_bounds)).tolist()
    data = []
    for b in filled:
        low, high = low_order[low_bounds[b]:low_bounds[b + 1]], high_order[high_bounds[b]:high_bounds[b + 1]]
        data.append(two_in_one(batch.low_keys[low].tobytes(), batch.high_keys[high].tobytes() + second[high].tobytes()))
    return pa.table({"bucket": pa.array(filled, pa.int32()), "batch": pa.array([number] * len(filled), pa.int32()),
                     "kind": pa.array([0] * len(filled), pa.int32()), "data": pa.array(data, pa.binary())}, schema=ASK)


def spans(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Flags of all places that some [begin, end) covers."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:n], dtype=np.int32) > 0


def dedup_substrings(docs: DataFrame, width: int = 20, digest: bool = False) -> DataFrame:
    """Remove each word that a ``width``-word window covers which starts earlier too, in any document.

    ``docs`` has doc_id and text. Result, one row per row: doc_id, n_words, n_removed, and with ``digest`` kept_sha256,
    else the kept words as column text (the text unchanged where nothing was removed) and all other columns of
    ``docs`` in a struct ``rest``. Earlier: smaller doc_id, or earlier in the same document; a null doc_id comes first,
    rows with the same doc_id are separate documents in the order of their texts. A null text has no words and
    stays null; texts shorter than a window stay whole. An empty table gives an empty result.
    """
    table, parts = batched(docs, rest=not digest)

    def ask_symbols(group: pa.Table) -> pa.Table:
        release()
        batch = Batch(group, width)
        batch.symbols()
        return symbol_rows(group.column("batch")[0].as_py(), batch, parts)

    def ask_windows(group: pa.Table, said: pa.Table) -> pa.Table:
        release()
        batch = Batch(group, width)
        batch.symbols()
        replies = {b: one_of_two(d) for b, d in answered(said)[0].items()}
        again = replies_in_order({b: d[0] for b, d in replies.items()}, *deal(batch.low_keys, parts))[:, 0]
        before = replies_in_order({b: d[1] for b, d in replies.items()}, *deal(batch.high_keys, parts))[:, 1]
        repeat, left = batch.settle(again, before)
        one, two = batch.windows(left)
        note = np.packbits(np.concatenate([repeat, left])).tobytes()
        return ask_rows(group.column("batch")[0].as_py(), *deal(one, parts), one, two, note=note)

    def finish(group: pa.Table, said: pa.Table) -> pa.Table:
        release()
        batch = Batch(group, width)
        n = len(batch.names)
        replies, note = answered(said)
        repeat, left = np.unpackbits(np.frombuffer(note, np.uint8), count=2 * n).astype(bool).reshape(2, n)
        one, _ = batch.windows(left)
        repeat[np.flatnonzero(left)] |= replies_in_order(replies, *deal(one, parts))[:, 1]
        at = np.flatnonzero(repeat)
        gone = spans(at, at + width, n)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[batch.starts])
        data, offsets, null = utf8_buffer(batch.table.column("text"))
        texts = []
        for i in range(batch.table.num_rows):
            raw = data[offsets[i]:offsets[i + 1]].tobytes()
            if digest or removed[i]:
                words = raw.split()
                if removed[i]:
                    words = [words[j] for j in np.flatnonzero(~gone[batch.starts[i]:batch.starts[i + 1]])]
                raw = b" ".join(words)
            texts.append(raw)
        out = {"doc_id": batch.table.column("doc_id"), "n_words": pa.array(np.diff(batch.starts), pa.int64()),
               "n_removed": pa.array(removed, pa.int64())}
        if digest:
            out["kept_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
        else:
            out["text"] = pa.array([None if e else t.decode() for t, e in zip(texts, null)], pa.string())
            if "rest" in batch.table.column_names:
                out["rest"] = batch.table.column("rest")
        return pa.table(out)

    def doubly_named(asked: list[tuple[int, bytes]]) -> list[bytes]:
        keys = [unpack(d, np.uint64, np.uint32) for _, d in asked]
        return firsts([k[0] for k in keys], [k[1] for k in keys])

    def symbols(asked: list[tuple[int, bytes]]) -> list[bytes]:
        both = [one_of_two(d) for _, d in asked]
        low = firsts([np.frombuffer(d, np.uint64) for d, _ in both])
        high = doubly_named([(batch, d) for (batch, _), (_, d) in zip(asked, both)])
        return [two_in_one(*x) for x in zip(low, high)]

    made = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, " + (
        "kept_sha256 string" if digest else "text string"))
    if "rest" in table.columns:
        made = made.add(table.schema["rest"])
    by = table.groupBy("batch")
    first = answers(by.applyInArrow(ask_symbols, ASK_SQL), parts, symbols).repartition(parts, "batch")
    second = answers(by.cogroup(first.groupBy("batch")).applyInArrow(ask_windows, ASK_SQL), parts, doubly_named)
    return by.cogroup(second.repartition(parts, "batch").groupBy("batch")).applyInArrow(finish, made)


def op1_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read_table(spark, sf_dir, "documents"), digest=True).select(
        "doc_id", "n_words", "n_removed", F.col("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w[i:i + 19] ORDER BY doc_id, i) AS n
  FROM d, unnest(range(1, len(w) - 18)) u(i) WHERE len(w) >= 20),
gone AS (SELECT DISTINCT doc_id, i + j AS place FROM win, unnest(range(0, 20)) v(j) WHERE n > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""
