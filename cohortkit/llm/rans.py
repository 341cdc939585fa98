"""Token-id files coded with a static range asymmetric numeral system.

One frequency table over all tokens, scaled to 2**PRECISION, is shared by all blocks. A block holds whole documents
of about BLOCK_TOKENS tokens; token i belongs to lane i mod LANES, each lane is a coder of its own with a 64-bit
state, and all lanes write 32-bit words to one stream in the order in which decoding reads them. Every
CHECKPOINT steps the block notes its states and its place in the stream, and the checksum of the tokens from there
to the next note, so a reader can start at any checkpoint and check each stretch alone.

The file is a folder of two Parquet tables: ``blocks``, one row per block, in shards of ascending doc_id ranges, and
``head``, one row with the counts of the tokens and the coder's numbers. Any engine that reads Parquet hands out the
blocks, and every block decodes with the head alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.bpe import vocabulary_path
from cohortkit.llm.chunks import ChunkTable
from cohortkit.llm.common import Scratch, read_table, shuffle_partitions, text_groups, unpack, utf8_buffer

PRECISION, LANES, CHECKPOINT, BLOCK_TOKENS = 20, 4096, 128, 1 << 20
LOW = np.uint64(1 << 31)
END_ID = 2
FRONT = 64  # characters of a text that its range is cut by, inside one doc_id
HEAD_SQL = "precision int, lanes int, checkpoint int, end_id int, tokens array<int>, counts array<long>"

TOKENS_SQL = "shard int, block int, doc_ids array<long>, lengths array<int>, ids binary, counts binary"
CODED_SQL = ("shard int, block int, n_tokens long, doc_ids array<long>, lengths array<int>, states binary, places binary, "
             "checksums binary, words binary")


# ---------------------------------------------------------------- the coder

class Table:
    """Frequencies scaled to 2**PRECISION; every token that occurs keeps at least one slot."""

    def __init__(self, counts: np.ndarray):
        self.freq = scaled(counts)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq.astype(np.int64))


def scaled(counts: np.ndarray) -> np.ndarray:
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    size = 1 << PRECISION
    if len(used) > size:
        raise ValueError("more tokens than slots")
    out = np.zeros(len(counts), np.int64)
    if len(used):
        out[used] = 1 + (counts[used] * ((size - len(used)) / counts.sum())).astype(np.int64)
        out[used[np.argmax(counts[used])]] += size - out.sum()
    return out.astype(np.uint64)


def encode(ids: np.ndarray, table: Table) -> tuple[bytes, bytes, bytes, bytes]:
    """(states at the checkpoints, places in the stream, checksums of the stretches, the stream)."""
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, LOW, np.uint64)
    words, n_words, states = [], [], []
    shift, size = np.uint64(63 - PRECISION), np.uint64(PRECISION)
    for step in range(steps - 1, -1, -1):
        some = ids[step * LANES:(step + 1) * LANES]
        freq, x = table.freq[some], state[:len(some)]
        over = x >= freq << shift
        words.append((x[over] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        n_words.append(len(words[-1]))
        x = np.where(over, x >> np.uint64(32), x)
        whole = x // freq
        state[:len(some)] = (whole << size) + (x - whole * freq) + table.start[some]
        if step % CHECKPOINT == 0:
            states.append(state.astype("<u8").tobytes())
    before = np.concatenate([[0], np.cumsum(n_words[::-1])])[:-1] if steps else np.zeros(0, np.int64)
    stretch = CHECKPOINT * LANES
    sums = [zlib.crc32(ids[a:a + stretch].astype("<u4").tobytes()) for a in range(0, len(ids), stretch)]
    return (b"".join(states[::-1]), before[::CHECKPOINT].astype("<u8").tobytes(),
            np.array(sums, "<u4").tobytes(), b"".join(w.tobytes() for w in words[::-1]))


def decode(n_tokens: int, states: bytes, places: bytes, checksums: bytes, words: bytes, table: Table,
           first: int = 0, last: int | None = None) -> np.ndarray:
    """Tokens of the checkpoints [first, last) of a block, each stretch checked; all of them by default."""
    stream = np.frombuffer(words, "<u4")
    state_of = np.frombuffer(states, "<u8").reshape(-1, LANES)
    place_of = np.frombuffer(places, "<u8")
    sums = np.frombuffer(checksums, "<u4")
    mask, size = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION)
    out = []
    for k in range(first, len(sums) if last is None else last):
        begin, end = k * CHECKPOINT * LANES, min(n_tokens, (k + 1) * CHECKPOINT * LANES)
        state, at = state_of[k].astype(np.uint64), int(place_of[k])
        ids = np.empty(end - begin, np.uint32)
        for a in range(0, len(ids), LANES):
            n = min(LANES, len(ids) - a)
            x = state[:n]
            slot = x & mask
            symbol = table.symbol[slot]
            ids[a:a + n] = symbol
            x = table.freq[symbol] * (x >> size) + slot - table.start[symbol]
            under = np.flatnonzero(x < LOW)
            x[under] = x[under] << np.uint64(32) | stream[at:at + len(under)]
            at += len(under)
            state[:n] = x
        if zlib.crc32(ids.astype("<u4").tobytes()) != sums[k]:
            raise ValueError(f"checksum of stretch {k} does not hold")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


# ---------------------------------------------------------------- tokens

class LibraryEncoder:
    """Chunks through the tokenizers library: many in one call, told apart by the bytes of their tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        from cohortkit.llm.bpe import MergeRounds

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.length = np.diff(MergeRounds(path).raw_at)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int64, int(count.sum())), count

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joins = np.array([len(c) > 1 and c[0] in " \n" and not c[1].isspace() and not c[-1].isspace() and "<|" not in c
                          and "  " not in c for c in chunks], bool)
        together, apart = np.flatnonzero(joins), np.flatnonzero(~joins)
        some = [chunks[i] for i in together]
        ids, _ = self.ids(["".join(some[at:at + 64]) for at in range(0, len(some), 64)])
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in some), np.int64, len(some)))
        reached = np.cumsum(self.length[ids])
        last = np.searchsorted(reached, ends)
        if len(some) and (len(reached) == 0 or reached[-1] != ends[-1] or not np.array_equal(reached[last], ends)):
            together, apart = together[:0], np.arange(len(chunks))  # a token crosses two chunks: each for itself
            ids, last = ids[:0], last[:0]
        other, n = self.ids([chunks[i] for i in apart])
        flat, count = np.concatenate([ids, other]), np.empty(len(chunks), np.int64)
        count[together], count[apart] = np.diff(last, prepend=-1), n
        place = np.concatenate([together, apart])
        begin = np.empty(len(chunks), np.int64)
        begin[place] = np.cumsum(count[place]) - count[place]
        stop = np.cumsum(count)
        return flat[np.arange(len(flat)) + np.repeat(begin - (stop - count), count)], count


_TABLES: dict[str, ChunkTable] = {}


def chunk_table(path: str) -> ChunkTable:
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(LibraryEncoder(path))
    return _TABLES[path]


def tokenized(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Blocks of whole documents in ascending (doc_id, text) order, the end id after each document.

    Each block brings the counts of its tokens along. Ids travel as two planes of bytes, low and high, which the table's compression tells apart (four planes of an id
    that needs more than 16 bits).
    """
    parts = shuffle_partitions(docs.sparkSession)
    # null ids, or those of one document, are dealt by the front of their texts, which ranks like the texts
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        parts, "doc_id", F.substring("text", 1, FRONT)).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard, block = chunk_table(vocabulary), TaskContext.get().partitionId(), 0
        doc_ids, lengths, flats, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate(flats)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([to_planes(ids)], pa.binary()),
                 pa.array([counted(ids)], pa.binary())],
                names=["shard", "block", "doc_ids", "lengths", "ids", "counts"])

        for batch in text_groups(batches, 2 << 20):
            ids, count = table.texts(*utf8_buffer(batch.column("text"))[:2])
            ends = np.cumsum(count + 1)
            flat = np.full(int(ends[-1]), end_id, np.uint32)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = ids
            doc_ids += batch.column("doc_id").to_pylist()
            lengths += (count + 1).tolist()
            flats.append(flat)
            held += len(flat)
            if held >= BLOCK_TOKENS:
                yield row()
                block += 1
                doc_ids, lengths, flats, held = [], [], [], 0
        if doc_ids:
            yield row()

    return ordered.mapInArrow(run, TOKENS_SQL)


def counted(ids: np.ndarray) -> bytes:
    """The distinct ids and how often each stands."""
    n = np.bincount(ids)
    used = np.flatnonzero(n)
    return used.astype("<u4").tobytes() + n[used].astype("<u4").tobytes()


def to_planes(ids: np.ndarray) -> bytes:
    wide = 4 if len(ids) and ids.max() > 0xFFFF else 2
    return bytes([wide]) + b"".join((ids >> np.uint32(8 * k)).astype(np.uint8).tobytes() for k in range(wide))


def from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    ids = planes[0].astype(np.uint32)
    for k in range(1, data[0]):
        ids |= planes[k].astype(np.uint32) << np.uint32(8 * k)
    return ids


def frequencies(blocks: DataFrame) -> dict[int, int]:
    """Token -> count over all blocks: at most one row per vocabulary entry reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for data in batch.column("counts").to_pylist():
                used, n = unpack(data, "<u4", "<u4")
                if len(used):
                    total = np.pad(total, (0, max(0, int(used[-1]) + 1 - len(total))))
                    total[used] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["token", "n"])

    found = blocks.select("counts").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in found.collect()}


def coded(blocks: DataFrame, table) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = from_planes(batch.column("ids")[i].as_py())
                made = encode(ids, table.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("shard").slice(i, 1), batch.column("block").slice(i, 1), pa.array([len(ids)], pa.int64()),
                     batch.column("doc_ids").slice(i, 1), batch.column("lengths").slice(i, 1),
                     *[pa.array([x], pa.binary()) for x in made]],
                    names=["shard", "block", "n_tokens", "doc_ids", "lengths", "states", "places", "checksums", "words"])

    return blocks.drop("counts").mapInArrow(run, CODED_SQL)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write the token file of ``docs`` to the folder ``path``: its blocks, and the table and numbers that decode them.

    A null text is one without tokens but the end id; a null doc_id comes first, rows of one doc_id stand in the order of
    their texts. Very long texts are encoded whole, in a block of their own size. Columns other than doc_id and text are
    not read, so their names can't clash. An empty table makes a file without blocks.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokenfile")
    blocks = scratch.write(tokenized(docs, vocabulary, end_id), "tokens", compression="zstd")
    counts = sorted(frequencies(blocks).items())
    head = spark.createDataFrame([(PRECISION, LANES, CHECKPOINT, end_id, [t for t, _ in counts], [n for _, n in counts])], HEAD_SQL)
    head.coalesce(1).write.parquet(f"{path}/head")
    table = spark.sparkContext.broadcast(Table(dense(counts)))
    coded(blocks, table).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    scratch.drop("tokens")


def dense(counts: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(max((t for t, _ in counts), default=0) + 1, np.int64)
    for token, n in counts:
        out[token] = n
    return out


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the file at ``path``: doc_id, start, n_tokens, ids_crc32. Each block is decoded and checked alone.

    All that decoding needs is read from the file.
    """
    head = spark.read.schema(HEAD_SQL).parquet(f"{path}/head").first()
    if (head["precision"], head["lanes"], head["checkpoint"]) != (PRECISION, LANES, CHECKPOINT):
        raise ValueError(f"{path} was written with other numbers: {head['precision']}, {head['lanes']}, {head['checkpoint']}")
    table = spark.sparkContext.broadcast(Table(dense(list(zip(head["tokens"], head["counts"])))))
    file = spark.read.schema(CODED_SQL).parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids = decode(b["n_tokens"], b["states"], b["places"], b["checksums"], b["words"], table.value)
                ends = np.cumsum(b["lengths"]).tolist()
                raw = ids.astype("<u4").tobytes()
                begins = [0, *ends[:-1]]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["shard"]] * n, pa.int32()), pa.array([b["block"]] * n, pa.int32()),
                     pa.array(b["doc_ids"], pa.int64()), pa.array(begins, pa.int64()), pa.array(b["lengths"], pa.int64()),
                     pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(begins, ends)], pa.int64())],
                    names=["shard", "block", "doc_id", "offset", "n_tokens", "ids_crc32"])

    docs = file.mapInArrow(run, "shard int, block int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    sizes = file.select("shard", "block", "n_tokens")
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.join(shards, "shard").select(
        "shard", "block", (F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("before"))
    return docs.join(blocks, ["shard", "block"]).select(
        "doc_id", (F.col("before") + F.col("offset")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def op2_rans_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file is written to the shared folder and read back."""
    path = f"{Scratch(spark, 'tokenfile').root}/file"
    write_tokens(read_table(spark, sf_dir, "documents"), path, vocabulary_path())
    return read_tokens(spark, path)
