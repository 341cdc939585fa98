"""Long repeats by run-length indexes over the corpus' shared regions.

Every ``width``-byte string has an anchor, its ``GRAM``-byte gram of least hash, at the same place in all its copies.
The strings of one anchor form a region of the text; only regions with equal anchors can share such a string. So the
corpus is cut at anchors, and four Spark steps over doc_id ranges ("batches") that ask hash buckets of anchors decide:

1. Which anchors occur again? A region whose anchor is nowhere else has no repeat.
2. The others are cut into cells of strings that begin CELL places apart at most, counted from the anchor; the bytes
   that all strings of a cell have in common are its core. A cell whose core is nowhere else has no repeat. Which
   cells occur again as a whole? Their strings are all repeats; one copy of each goes on, with all cells that differ
   from the others of their core.
3. A bucket joins the cells of its cores and builds their run-compressed Burrows-Wheeler transform. At the first
   and the last row of each run it samples the text position and the common prefix with the row before or after.
   Inside a run the matching statistic of a position is that of the position before less one, so the samples are
   streamed through the text to give each position's longest match elsewhere; strings with ``width`` or more are marked.
4. The marked strings' bytes are removed.

An anchor that more than HOT texts hold would gather them in one bucket. Its strings are asked about by name instead,
each in the bucket of its own name, so what meets there is equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import (ASK_SQL, Piece, answered, answers, ask_rows, batched, deal, in_order, mix64, read_table,
                                  unpack, utf8_buffer)

GRAM, CELL, HOT, PIECE, INDEX_BYTES = 64, 64, 4096, 1 << 20, 1 << 18
BY_NAME = 2

def least_before(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, by prefix and suffix minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, text ends inside): whole texts up to PIECE bytes; a longer text in parts that overlap by width - 1."""
    i, n = 0, len(offsets) - 1
    while i < n:
        begin = int(offsets[i])
        j = max(i + 1, int(np.searchsorted(offsets, begin + PIECE, side="right")) - 1)
        end = int(offsets[j])
        if end - begin <= 2 * PIECE:
            yield begin, end, offsets[i + 1:j + 1]
        else:
            for a in range(begin, end, PIECE):
                b = min(end, a + PIECE + width - 1)
                yield a, b, np.array([b])
        i = j


def regions(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Rows (anchor, first string, last string, key) of all regions; places are bytes of ``data``."""
    gram = min(GRAM, width)
    out = [np.zeros((0, 4), np.uint64)]
    for begin, end, stops in pieces(offsets, width):
        n = end - begin
        if n < width:
            continue
        at = np.arange(n - gram + 1)
        key = Piece(data[begin:end], 0)(at, at + gram)
        value = key & np.uint64(0xFFFFFFFF00000000) | at.astype(np.uint64)
        anchor = least_before(value, width - gram + 1) & np.uint64(0xFFFFFFFF)
        bounds = np.concatenate([[begin], stops]) - begin
        room = np.repeat(bounds[1:], np.diff(bounds))[:len(anchor)] - np.arange(len(anchor))
        start = np.flatnonzero(room >= width)
        anchor = anchor[start].astype(np.int64)
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))[:len(start)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start))[:len(first)] - 1
        # of all grams of a window the anchor has the least hash, so that hash would fill the first buckets only
        out.append(np.stack([anchor[first] + begin, start[first] + begin, start[last] + begin, mix64(key[anchor[first]])],
                            axis=1).astype(np.uint64) if len(first) else out[0])
    return np.concatenate(out)


def names(data: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """64-bit names of the stretches [begin, end)."""
    out, order = np.zeros(len(begin), np.uint64), np.argsort(begin, kind="stable")
    i = 0
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(begin[order], begin[order[i]] + PIECE)))
        mine = order[i:j]
        a, b = int(begin[mine[0]]), int(end[mine].max())
        out[mine] = Piece(data[a:b], which)(begin[mine] - a, end[mine] - a)
        i = j
    return out


def cells(found: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Regions cut by their strings' distance to the anchor: (first, last string, core begin, core end, number of cell)."""
    anchor, first, last = (found[:, i].astype(np.int64) for i in range(3))
    size = min(CELL, max(1, width - min(GRAM, width)))
    low, high = (anchor - last) // size, (anchor - first) // size
    n = high - low + 1
    cell = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    anchor, first, last = (np.repeat(x, n) for x in (anchor, first, last))
    latest, earliest = anchor - cell * size, anchor - (cell + 1) * size + 1
    return np.maximum(first, earliest), np.minimum(last, latest), latest, earliest + width, cell


# ---------------------------------------------------------------- the index

class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of several texts, with samples at the ends of its runs."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.begin = np.cumsum(size) - size
        self.stop = self.begin + size - 1  # each text's separator
        n = int(size.sum())
        symbol = np.zeros(n, np.uint16)
        inside = np.ones(n, bool)
        inside[self.stop] = False
        symbol[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
        self.symbol, self.n = symbol, n
        self.stop_of = np.repeat(self.stop, size)
        order = self._sorted()
        # a separator has a letter of its own, so rows before which one stands end their runs
        before = symbol[order - 1].astype(np.int64)
        before[np.isin(order, self.begin)] = -1
        apart = (before[1:] != before[:-1]) | (before[1:] == -1)
        self.heads = np.flatnonzero(np.append(True, apart))
        self.tails = np.append(self.heads[1:], n) - 1
        self.runs = before[self.heads]
        self.head_at, self.tail_at = order[self.heads], order[self.tails]
        self.head_match = self._common(self.head_at, order[self.heads - 1])
        self.head_match[0] = 0
        self.tail_match = np.append(self.head_match[1:], 0)

    def _sorted(self) -> np.ndarray:
        """Rows in suffix order: ranks of ever longer prefixes, up to each text's end."""
        n, count = self.n, len(self.stop)
        key = np.zeros(n, np.uint64)
        alive = np.ones(n, bool)
        for j in range(7):
            at = np.minimum(np.arange(n) + j, n - 1)
            alive &= (np.arange(n) + j) < self.stop_of
            key = key << np.uint64(9) | np.where(alive, self.symbol[at], 0).astype(np.uint64)
        rank = np.empty(n, np.int64)
        text = np.flatnonzero(self.symbol)
        _, dense = np.unique(key[text], return_inverse=True)
        rank[text] = dense + count
        rank[self.stop] = np.arange(count)
        step, longest = 7, int((self.stop - self.begin).max()) + 1
        while True:
            pair = rank * (n + count + 1) + rank[np.minimum(np.arange(n) + step, self.stop_of)]
            order = np.argsort(pair)  # equal pairs keep equal ranks, so any order will do
            new = np.append(True, pair[order[1:]] != pair[order[:-1]])
            rank[order] = np.cumsum(new) - 1
            if new.all() or step > longest:
                return order
            # separators come first, in the order of their texts, so they keep the ranks 0, 1, ...
            step *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each two suffixes, inside their texts: doubling, then halving, steps of hashes."""
        room = np.minimum(self.stop_of[a] - a, self.stop_of[b] - b)
        piece = Piece(self.symbol, 0)
        out = np.zeros(len(a), np.int64)
        step = 1 << max(0, int(room.max(initial=1)).bit_length())
        while step:
            longer = np.flatnonzero(out + step <= room)
            x, y = a[longer] + out[longer], b[longer] + out[longer]
            out[longer[piece(x, x + step) == piece(y, y + step)]] += step
            step >>= 1
        return out

    def matching_statistics(self) -> np.ndarray:
        """For each place the length of its longest match that begins at another place: the samples streamed."""
        best = np.zeros(self.n, np.int64)
        at = np.arange(self.n)
        for place, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            sample = np.full(self.n, -1, np.int64)
            sample[place] = match
            last = np.maximum.accumulate(np.where(sample >= 0, at, -1))
            best = np.maximum(best, np.where(last >= 0, sample[last] - (at - last), 0))
        return best


def repeated_strings(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text, flags of its places where a ``width``-byte string begins that begins elsewhere too."""
    index = RunLengthIndex(texts)
    long = index.matching_statistics() >= width
    return [long[b:max(b, e - width + 1)] for b, e in zip(index.begin, index.stop)]


# ---------------------------------------------------------------- the operator

def remove_repeats(docs: DataFrame, width: int = 400, digest: bool = False) -> DataFrame:
    """Remove each byte that a ``width``-byte string covers which begins anywhere else too, in any document.

    ``docs`` has doc_id and text; texts are UTF-8 bytes, a null text is empty. Result, one row per row: doc_id, n_bytes,
    n_removed, n_spans (removed runs), and with ``digest`` kept_sha256, else kept (the bytes that stay) and spans
    (begin and end of each removed run). All copies of a repeat go, the first as well. Rows with the same doc_id are
    separate texts, repeated rows are copies of each other. Texts shorter than ``width`` stay whole. An empty table
    gives an empty result.
    """
    table, parts = batched(docs)
    buckets = max(1, parts // 2)  # each batch sends a message to each bucket in every step

    def texts(group: pa.Table) -> tuple[pa.Table, int, np.ndarray, np.ndarray]:
        rows = in_order(group)
        data, offsets, _ = utf8_buffer(rows.column("text"))
        return rows, group.column("batch")[0].as_py(), data, offsets

    # 1. anchors
    def ask_anchors(group: pa.Table) -> pa.Table:
        _, batch, data, offsets = texts(group)
        found = regions(data, offsets, width)
        key, count = np.unique(found[:, 3], return_counts=True)
        return ask_rows(batch, *deal(key, buckets), key, count.astype(np.uint64), note=found.tobytes())

    def anchors(asked: list[tuple[int, bytes]]) -> list[bytes]:
        rows = [unpack(d, np.uint64, np.uint64) for _, d in asked]
        _, at = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
        total = np.bincount(at, np.concatenate([r[1] for r in rows]))[at]
        code = (total > 1).astype(np.uint8) + (total > HOT)
        return [x.tobytes() for x in np.split(code, np.cumsum([len(r[0]) for r in rows])[:-1])]

    def codes(said: dict[int, bytes], key: np.ndarray) -> np.ndarray:
        order, bounds = deal(key, buckets)
        out = np.zeros(len(key), np.uint8)
        for b in np.flatnonzero(np.diff(bounds)):
            out[order[bounds[b]:bounds[b + 1]]] = np.frombuffer(said[b], np.uint8)
        return out

    # 2. cells; strings of hot anchors
    def cell_names(data: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first, last string, name of the core, name of the whole)."""
        first, last, begin, end, cell = cells(found, width)
        core = mix64(names(data, begin, end, 0) + cell.astype(np.uint64))
        clip = (begin - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
        return first, last, core, mix64(names(data, first, last + width, 1) + mix64(clip))

    def distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place of each distinct row, its number for each row, how often)."""
        if not len(columns[0]):
            return (np.zeros(0, np.int64),) * 3
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return order[new], number, np.bincount(number)

    def hot_strings(data: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, last = hot[:, 1].astype(np.int64), hot[:, 2].astype(np.int64)
        size = last - first + 1
        at = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
        return at, names(data, at, at + width, 0), names(data, at, at + width, 1)

    def ask_cells(group: pa.Table, said: pa.Table) -> pa.Table:
        _, batch, data, _ = texts(group)
        replies, note = answered(said)
        found = np.frombuffer(note, np.uint64).reshape(-1, 4)
        key, at = np.unique(found[:, 3], return_inverse=True)
        code = codes(replies, key)[at]
        shared, hot = found[code == 1], found[code > 1]
        _, _, core, name = cell_names(data, shared)
        place, _, count = distinct(core, name)
        rows = ask_rows(batch, *deal(core[place], buckets), core[place], name[place],
                        np.minimum(count, 2).astype(np.uint8),
                        note=np.int64(len(shared)).tobytes() + shared.tobytes() + hot.tobytes())
        _, one, two = hot_strings(data, hot)
        place, _, count = distinct(one, two)
        return pa.concat_tables([rows, ask_rows(batch, *deal(one[place], buckets), one[place], two[place],
                                                np.minimum(count, 2).astype(np.uint8), kind=BY_NAME)])

    def whole_cells(asked: list[tuple[int, bytes]]) -> list[bytes]:
        """0: a repeat as a whole, no text needed; 1: a repeat as a whole, send the text; 2: send the text and ask;
        3: no repeat."""
        rows = [unpack(d, np.uint64, np.uint64, np.uint8) for _, d in asked]
        core, name, count = (np.concatenate(x) for x in zip(*rows))
        place, number, _ = distinct(core, name)
        again = np.bincount(number, count)[number] > 1
        _, group = np.unique(core, return_inverse=True)
        mixed = np.bincount(group[place])[group] > 1
        first = np.zeros(len(core), bool)
        first[place] = True  # the order is stable: the earliest batch
        code = np.where(again, mixed & first, np.where(mixed, 2, 3)).astype(np.uint8)
        return [x.tobytes() for x in np.split(code, np.cumsum([len(r[0]) for r in rows])[:-1])]

    def by_name(asked: list[tuple[int, bytes]]) -> list[bytes]:
        rows = [unpack(d, np.uint64, np.uint64, np.uint8) for _, d in asked]
        one, two, count = (np.concatenate(x) for x in zip(*rows))
        _, number, _ = distinct(one, two)
        again = (np.bincount(number, count)[number] > 1).astype(np.uint8)
        return [x.tobytes() for x in np.split(again, np.cumsum([len(r[0]) for r in rows])[:-1])]

    # 3. cells that differ
    def ask_index(group: pa.Table, said: pa.Table) -> pa.Table:
        _, batch, data, _ = texts(group)
        replies, note = answered(said)
        shared = np.frombuffer(note, np.uint64, offset=8).reshape(-1, 4)
        shared, hot = shared[:int(np.frombuffer(note, np.int64, 1)[0])], shared[int(np.frombuffer(note, np.int64, 1)[0]):]
        first, last, core, name = cell_names(data, shared)
        place, number, _ = distinct(core, name)
        code = codes(replies, core[place])
        done = (code < 2)[number]
        at, one, two = hot_strings(data, hot)
        name_place, name_number, _ = distinct(one, two)
        strings = at[codes(answered(said, BY_NAME)[0], one[name_place])[name_number] > 0]
        send = place[(code == 1) | (code == 2)]
        ask = (code[(code == 1) | (code == 2)] == 2).astype(np.uint8)
        order, bounds = deal(core[send], buckets)
        filled = np.flatnonzero(np.diff(bounds)).tolist()
        packed = []
        for b in filled:
            mine = order[bounds[b]:bounds[b + 1]]
            some = send[mine]
            packed.append(b"".join([np.int64(len(mine)).tobytes(), core[some].tobytes(),
                                    (last[some] + width - first[some]).tobytes(), ask[mine].tobytes(),
                                    *[data[first[i]:last[i] + width].tobytes() for i in some]]))
        asked = send[ask > 0]
        note = b"".join([np.array([done.sum(), len(strings)], np.int64).tobytes(),
                         np.stack([first[done], last[done]], axis=1).tobytes(), strings.astype(np.int64).tobytes(),
                         np.stack([first[asked], last[asked], core[asked].view(np.int64)], axis=1).tobytes()])
        n = len(filled) + 1
        return pa.table({"bucket": pa.array([*filled, batch % buckets], pa.int32()), "batch": pa.array([batch] * n, pa.int32()),
                         "kind": pa.array([0] * len(filled) + [1], pa.int32()),
                         "data": pa.array([*packed, note], pa.binary())})

    def index(asked: list[tuple[int, bytes]]) -> list[bytes]:
        """The cells of some cores at a time, whole groups together, go into an index of about INDEX_BYTES."""
        key, owner, ask, text = [], [], [], []
        for i, (_, d) in enumerate(asked):
            n = int(np.frombuffer(d, np.int64, 1)[0])
            k, size = np.frombuffer(d, np.uint64, n, 8), np.frombuffer(d, np.int64, n, 8 + 8 * n)
            at = 8 + 17 * n
            cuts = np.concatenate([[0], np.cumsum(size)]) + at
            key.append(k)
            owner += [i] * n
            ask.append(np.frombuffer(d, np.uint8, n, 8 + 16 * n))
            text += [d[a:b] for a, b in zip(cuts, cuts[1:])]
        keys, asks = np.concatenate(key), np.concatenate(ask)
        order = np.argsort(keys, kind="stable")
        flags: list[bytes] = [b""] * len(text)
        held, size = [], 0

        def settle() -> None:
            for i, found in zip(held, repeated_strings([text[i] for i in held], width)):
                if asks[i]:
                    flags[i] = np.packbits(found).tobytes()

        for j, i in enumerate(order.tolist()):
            if size > INDEX_BYTES and keys[i] != keys[held[-1]]:
                settle()
                held, size = [], 0
            held.append(i)
            size += len(text[i])
        if held:
            settle()
        out: list[list[bytes]] = [[] for _ in asked]
        for i, o in enumerate(owner):
            out[o].append(flags[i])
        return [b"".join(x) for x in out]

    # 4. removal
    def finish(group: pa.Table, said: pa.Table) -> pa.Table:
        rows, _, data, offsets = texts(group)
        replies, note = answered(said)
        n_done, n_strings = np.frombuffer(note, np.int64, 2)
        done = np.frombuffer(note, np.int64, 2 * n_done, 16).reshape(-1, 2)
        strings = np.frombuffer(note, np.int64, n_strings, 16 + 16 * n_done)
        asked = np.frombuffer(note, np.uint64, offset=16 + 16 * n_done + 8 * n_strings).reshape(-1, 3)
        order, bounds = deal(asked[:, 2], buckets)
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, done[:, 0], 1)
        np.add.at(edge, done[:, 1] + width, -1)
        np.add.at(edge, strings, 1)
        np.add.at(edge, strings + width, -1)
        for b in np.flatnonzero(np.diff(bounds)):
            bits, at = np.frombuffer(replies[b], np.uint8), 0
            for i in order[bounds[b]:bounds[b + 1]]:
                first, size = int(asked[i, 0]), int(asked[i, 1] - asked[i, 0]) + 1
                flag = np.unpackbits(bits[at:at + -(-size // 8)], count=size)
                at += -(-size // 8)
                begin = np.flatnonzero(flag) + first
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + width, -1)
        gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        inner = offsets[:-1][np.diff(offsets) > 0]
        starts[inner] = gone[inner]  # a run ends with its text
        begins = np.concatenate([[0], np.cumsum(starts)])
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets, offsets[1:])]
        out = {"doc_id": rows.column("doc_id"), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
               "n_removed": pa.array(np.diff(total[offsets]), pa.int64()),
               "n_spans": pa.array(np.diff(begins[offsets]), pa.int64())}
        if digest:
            out["kept_sha256"] = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        else:
            out["kept"] = pa.array(kept, pa.binary())
            spans = []
            for a, b in zip(offsets, offsets[1:]):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
                spans.append([{"begin": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
            out["spans"] = pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
        return pa.table(out)

    made = "doc_id long, n_bytes long, n_removed long, n_spans long, " + (
        "kept_sha256 string" if digest else "kept binary, spans array<struct<begin: long, end: long>>")
    by = table.groupBy("batch")
    first = answers(by.applyInArrow(ask_anchors, ASK_SQL), buckets, anchors).repartition(parts, "batch")
    second = answers(by.cogroup(first.groupBy("batch")).applyInArrow(ask_cells, ASK_SQL), buckets,
                     {0: whole_cells, BY_NAME: by_name}).repartition(parts, "batch")
    third = answers(by.cogroup(second.groupBy("batch")).applyInArrow(ask_index, ASK_SQL), buckets, index)
    return by.cogroup(third.repartition(parts, "batch").groupBy("batch")).applyInArrow(finish, made)


def op5_run_length_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), digest=True).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (SELECT doc_id, i, md5(array_slice(b, i, i + 399)) AS h
  FROM d, unnest(range(1, octet_length(b) - 398)) u(i) WHERE octet_length(b) >= 400),
again AS (SELECT doc_id, i FROM win SEMI JOIN (SELECT h FROM win GROUP BY h HAVING count(*) > 1) USING (h)),
cut AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 400, true) AS fresh FROM again),
run AS (SELECT doc_id, min(i) AS first, max(i) + 400 AS past
  FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cut) GROUP BY doc_id, k),
piece AS (SELECT doc_id, lag(past, 1, 1) OVER (PARTITION BY doc_id ORDER BY first) AS first, first AS past FROM run
  UNION ALL SELECT d.doc_id, coalesce(max(run.past), 1), any_value(octet_length(b)) + 1 FROM d LEFT JOIN run USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(hex(array_slice(b, first, past - 1)), '' ORDER BY first) AS bytes
  FROM piece JOIN d USING (doc_id) WHERE past > first GROUP BY doc_id),
gone AS (SELECT doc_id, sum(past - first) AS n, count(*) AS spans FROM run GROUP BY doc_id)
SELECT d.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone.n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(bytes, ''))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""
