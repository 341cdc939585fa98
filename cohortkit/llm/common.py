"""Helpers shared by the training-data operators.

Three kinds: access to Arrow string columns as flat UTF-8 buffers, scratch tables in the shared
checkpoint folder, and the *batch exchange*: documents are dealt into doc_id ranges ("batches"),
each batch asks hash buckets about its keys in packed arrays and gets the answers back in the
order it asked. Every step of the exchange is an ordinary Spark shuffle, so a lost executor is
recomputed from lineage and no task sees more than one batch or one bucket at a time.
"""

from __future__ import annotations

import atexit
import ctypes
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cohortkit.session import shared_folder

#: Words are runs of anything but the six ASCII white-space bytes; bytes.split() cuts just there.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's own sizing of a shuffle; every bucket count below is a multiple of it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- arrow

TEXTS_PER_BATCH = 2000  # rows that Spark hands to Python at a time, unless the session asks for fewer
BYTES_PER_BATCH = 4 << 20  # or the row that reaches so many bytes, if that comes first


def text_batches(spark: SparkSession) -> None:
    """Lower the session's rows and bytes per Arrow batch to TEXTS_PER_BATCH and BYTES_PER_BATCH: they were chosen for
    numbers, and a batch of texts is held several times over on its way to a worker. It changes no result; a session that
    asks for fewer rows, or for any number of bytes, keeps its own."""
    rows, size = (f"spark.sql.execution.arrow.{x}PerBatch" for x in ("maxRecords", "maxBytes"))
    if not 0 < int(spark.conf.get(rows)) <= TEXTS_PER_BATCH:
        spark.conf.set(rows, str(TEXTS_PER_BATCH))
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, str(BYTES_PER_BATCH))


def utf8_buffer(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, is_null) of a string column; a null reads as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    null = np.asarray(column.is_null(), dtype=bool)
    flat = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    flat = flat.cast(pa.large_binary()).fill_null(b"")
    buffers = flat.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets, null


def release() -> None:
    """Give freed memory back to the system. A worker lives on from task to task, and its executor pays for what it keeps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other systems do without
    if trim is not None:
        trim(0)


def text_groups(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one piece holds about ``most_bytes`` of text (a single longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets, _ = utf8_buffer(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    release()


def columns(schema: pa.Schema, **arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a, f.type) for f, a in
         ((f, arrays[f.name]) for f in schema)], schema=schema)


# ---------------------------------------------------------------- scratch tables

_LEFT: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _delete_left() -> None:
    for spark, path in _LEFT:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already; its folder then goes with it
            pass


class Scratch:
    """Parquet tables in the folder that the cluster names in spark.checkpoint.dir.

    A written table cuts the lineage, survives the loss of any executor and keeps column pruning.
    Tables that no returned DataFrame reads are dropped by the operator; the others go at exit.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        text_batches(spark)
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        _LEFT.append((spark, self.root))

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write and read again. The shuffle files of the finished write go at once, its table replaces them."""
        path = f"{self.root}/{name}"
        conf, cleanup = self.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(cleanup, None)
        conf.set(cleanup, "true")
        try:
            df.write.mode("overwrite").options(**options).parquet(path)
        finally:
            conf.unset(cleanup) if before is None else conf.set(cleanup, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, f"{self.root}/{name}")


# ---------------------------------------------------------------- word names

_ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_names(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(names of all words, first word of each text): flat 64-bit names, the same on every worker, and n+1 starts."""
    raw = data[offsets[0]:offsets[-1]].tobytes() if len(offsets) else b""
    if lower:
        raw = raw.translate(_ASCII_LOWER)
    base = int(offsets[0]) if len(offsets) else 0
    names, starts = [], np.zeros(len(offsets), np.int64)
    for i in range(len(offsets) - 1):
        words = raw[offsets[i] - base:offsets[i + 1] - base].split()
        starts[i + 1] = starts[i] + len(words)
        names.append(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)))
    return (np.concatenate(names) if names else np.zeros(0, np.uint64)), starts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 constants)."""
    x = np.array(x, np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def join64(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Name of an ordered pair of 64-bit names."""
    with np.errstate(over="ignore"):
        x = mix64(left + np.uint64(salt * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        return mix64(x * np.uint64(0xD6E8FEB86659FD93) + right)


def window_names(names: np.ndarray, starts: np.ndarray, width: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of all ``width``-long windows that stay inside one text, and their first positions.

    Doubling: a window is named from its first and its last power-of-two part, so equal windows get
    equal names wherever they start, and a name depends on nothing outside the window.
    """
    n = len(names)
    first = np.arange(n, dtype=np.int64)
    room = np.repeat(starts[1:], np.diff(starts)) - first
    keep = first[room >= width]
    if not len(keep):
        return np.zeros(0, np.uint64), keep
    level, size = mix64(names + np.uint64(salt)), 1
    while size * 2 <= width:
        level = join64(level[:-size], level[size:], salt + size)
        size *= 2
    if size == width:
        return level[keep], keep
    return join64(level[keep], level[keep + width - size], salt + 7919), keep


# ---------------------------------------------------------------- rolling hashes

_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(1, 2**63, (2, 257), np.uint64)  # bytes, and an index's symbols
_STEP = [np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F | 1)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def fresh_powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """step**i and its inverse modulo 2**64."""
    step = int(_STEP[which])
    out = []
    for base in (step, pow(step, -1, 2**64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p, out=p))
    return out[0], out[1]


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same, kept for the next call."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        _POWERS[which] = fresh_powers(which, n)
    return _POWERS[which]


class Piece:
    """Rolling hashes of a stretch of bytes: hash of [a, b) in constant time."""

    def __init__(self, data: np.ndarray, which: int):
        up, self.down = powers(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[which][data] * up[:len(data)], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


# ---------------------------------------------------------------- batch exchange

SAMPLED, PREFIX = 8, 256  # texts looked at for each cut inside a doc_id, and how many characters of them


def text_cuts(docs: DataFrame, n: int, repeated: dict[int, int]) -> tuple[list[str], list[tuple[int, str]]]:
    """Cut points by text inside the null ids, and (doc_id, text) inside the ids of ``repeated`` (id -> cuts wanted).

    Only the balance of the batches depends on the texts that are looked at. Copies of one text are not cut apart.
    """
    total = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    nulls = total[0] - total[1]
    want: dict[int | None, int] = {k: v for k, v in repeated.items() if v > 0}
    if (k := round(nulls * n / max(1, total[0])) - 1) > 0:
        want[None] = k
    if not want:
        return [], []
    # a row of a repeated id is one of about share * total
    share = {k: SAMPLED * (v + 1) / max(1.0, nulls if k is None else (v + 1) * total[1] / n) for k, v in want.items()}
    listed = F.lit(0.0)
    for k, v in share.items():
        this = F.col("doc_id").isNull() if k is None else F.col("doc_id") == k
        listed = F.when(this, F.lit(v)).otherwise(listed)
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < listed * (1 << 20)
    seen = docs.where(F.col("text").isNotNull() & drawn).groupBy("doc_id", F.substring("text", 1, PREFIX).alias("t")).count()
    found: dict[int | None, list[tuple[bytes, int]]] = {}
    for r in seen.collect():
        found.setdefault(r["doc_id"], []).append((r["t"].encode(), r["count"]))
    cuts = {}
    for k, rows in found.items():
        rows.sort()
        ends = np.cumsum([c for _, c in rows])
        at = np.searchsorted(ends, [ends[-1] * i / (want[k] + 1) for i in range(1, want[k] + 1)])
        cuts[k] = sorted({rows[i][0] for i in at.tolist()})
    return [t.decode() for t in cuts.pop(None, [])], [(k, t.decode()) for k in cuts for t in cuts[k]]


def batched(docs: DataFrame, per_partition: int = 2, rest: bool = False) -> tuple[DataFrame, int]:
    """(batch, doc_id, text) dealt by ranges of doc_id, and the number of partitions.

    With ``rest``, all other columns come along inside one struct column, so their names can't clash.

    Batches ascend with doc_id, so (batch, place in the batch) orders all documents. The cut points are
    quantiles of all doc_ids. Null ids come first. Null ids, or one doc_id, with the rows of several
    batches are cut by ranges of the text, which is the order inside a batch too.
    """
    spark = docs.sparkSession
    text_batches(spark)
    parts = shuffle_partitions(spark)
    n = parts * per_partition
    cuts = docs.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    times = Counter(int(c) for c in cuts)
    of_null, of_ids = text_cuts(docs, n, {c: k - 1 for c, k in times.items()}) if n > 1 else ([], [])
    cuts = sorted(times)
    if cuts:
        listed = F.array(*[F.lit(c).cast("long") for c in cuts])
        batch = F.coalesce(F.size(F.filter(listed, lambda c: c < F.col("doc_id"))), F.lit(0))
        batch = F.when(F.col("doc_id").isNull(), 0).otherwise(batch)
    else:
        batch = F.lit(0)
    if of_ids:
        within = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(t).alias("t")) for i, t in of_ids])
        batch += F.coalesce(F.size(F.filter(within, lambda x: (x["i"] < F.col("doc_id")) | (
            (x["i"] == F.col("doc_id")) & (x["t"] < F.col("text"))))), F.lit(0))
    if of_null:
        within = F.size(F.filter(F.array(*[F.lit(t) for t in of_null]), lambda t: t < F.col("text")))
        batch = F.when(F.col("doc_id").isNull(), F.coalesce(within, F.lit(0))).otherwise(batch + F.lit(len(of_null) + 1))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    along = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if rest and others else []
    dealt = docs.select(batch.cast("int").alias("batch"), F.col("doc_id").cast("long").alias("doc_id"), "text", *along)
    return dealt.repartition(parts, "batch"), parts


def in_order(table: pa.Table) -> pa.Table:
    """The rows of one batch by doc_id, repeated ids by text, nulls first: the same order each time it is asked."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start")) if table.num_rows > 1 else table


#: kind 1 is a note of the batch to its own next step, which buckets pass on; all other kinds ask a bucket.
ASK = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
ASK_SQL = "bucket int, batch int, kind int, data binary"
NOTE = 1
HELD = -1  # what a bucket itself holds; it comes before all that batches ask


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket of a 64-bit name by its high 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def deal(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): order groups the keys by bucket, stably; bounds cut it."""
    buckets = bucket_of(keys, n_buckets)
    order = np.argsort(buckets.astype(np.uint16) if n_buckets < 65536 else buckets, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(buckets, minlength=n_buckets))])


def ask_rows(batch: int, order: np.ndarray, bounds: np.ndarray, *arrays: np.ndarray, note: bytes | None = None,
             kind: int = 0) -> pa.Table:
    """One row per non-empty bucket: the arrays' slices, one after the other, as bytes; then the note."""
    filled = np.flatnonzero(np.diff(bounds)).tolist()
    data = [b"".join(a[order[bounds[b]:bounds[b + 1]]].tobytes() for a in arrays) for b in filled]
    kinds = [kind] * len(filled)
    if note is not None:
        filled, data, kinds = [*filled, batch % (len(bounds) - 1)], [*data, note], [*kinds, NOTE]
    return pa.table({"bucket": pa.array(filled, pa.int32()), "batch": pa.array([batch] * len(filled), pa.int32()),
                     "kind": pa.array(kinds, pa.int32()), "data": pa.array(data, pa.binary())}, schema=ASK)


def unpack(data: bytes, *dtypes) -> list[np.ndarray]:
    """Inverse of the packing of one row."""
    n = len(data) // sum(np.dtype(t).itemsize for t in dtypes)
    out, at = [], 0
    for t in dtypes:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


Answer = Callable[..., list[bytes]]


def answers(asked: DataFrame, n_buckets: int, answer: Answer | dict[int, Answer], held: DataFrame | None = None) -> DataFrame:
    """Each bucket's rows meet in one task; ``answer`` gets (batch, data) by ascending batch and returns one reply each.

    Buckets are partition ids, so a task holds one bucket: 1/n_buckets of what all batches ask. With several kinds of
    questions there is one answer function for each. With ``held``, a table of (bucket, data) with a row a bucket at most,
    the function gets its bucket's data as well, or none as empty bytes.
    """
    by_kind = answer if isinstance(answer, dict) else {0: answer}

    own = held is not None
    if own:
        nobody = [F.lit(x).cast("int").alias(c) for c, x in (("batch", HELD), ("kind", HELD))]
        asked = asked.unionByName(held.select("bucket", *nobody, "data"))

    def replies(bucket: int, rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        mine = (next((data for _, k, data in rows if k == HELD), b""),) if own else ()
        rows = sorted((r for r in rows if r[1] != HELD), key=lambda r: (r[0], r[1]))
        said = {}
        for kind, reply in by_kind.items():
            ask = [(batch, data) for batch, k, data in rows if k == kind]
            said[kind] = iter(reply(ask, *mine) if ask else [])
        for i in range(0, len(rows), 64):
            part = rows[i:i + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket] * len(part), pa.int32()), pa.array([r[0] for r in part], pa.int32()),
                 pa.array([r[1] for r in part], pa.int32()),
                 pa.array([r[2] if r[1] == NOTE else next(said[r[1]]) for r in part], pa.binary())], schema=ASK)

    def partition(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[tuple[int, int, bytes]]] = {}
        for r in rows:
            for bucket, batch, kind, data in zip(*(r.column(c).to_pylist() for c in ("bucket", "batch", "kind", "data"))):
                got.setdefault(bucket, []).append((batch, kind, data))
        for bucket in sorted(got):
            yield from replies(bucket, got.pop(bucket))
        release()

    return asked.repartitionById(n_buckets, F.col("bucket")).mapInArrow(partition, ASK_SQL)


def answered(table: pa.Table, kind: int = 0) -> tuple[dict[int, bytes], bytes]:
    """(bucket -> reply to this kind of question, the note) of one batch."""
    said, note = {}, b""
    for bucket, k, data in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "data"))):
        if k == NOTE:
            note = data
        elif k == kind:
            said[bucket] = data
    return said, note


def replies_in_order(said: dict[int, bytes], order: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two bits for each key, as ``firsts`` packs them, back in the order of the keys."""
    out = np.zeros((len(order), 2), bool)
    for b in np.flatnonzero(np.diff(bounds)):
        mine = order[bounds[b]:bounds[b + 1]]
        out[mine] = np.unpackbits(np.frombuffer(said[b], np.uint8), count=2 * len(mine)).astype(bool).reshape(-1, 2)
    return out


def firsts(asked: list[np.ndarray], *more: list[np.ndarray]) -> list[bytes]:
    """For each key: is it there again anywhere, and is there an earlier one? Two packed bits each.

    ``more`` are further parts of the same keys. Earlier: in an earlier array, or before it in its own.
    """
    flat = [np.concatenate(a) for a in (asked, *more)]
    order = np.lexsort(flat[::-1]) if more else np.argsort(flat[0], kind="stable")
    same = np.ones(max(0, len(order) - 1), bool)
    for a in flat:
        s = a[order]
        same &= s[1:] == s[:-1]
    bits = np.zeros((len(order), 2), bool)
    bits[order, 1] = np.append(False, same)[:len(order)]
    bits[order, 0] = (np.append(False, same) | np.append(same, False))[:len(order)]
    ends = np.cumsum([len(a) for a in asked])
    return [np.packbits(bits[e - len(a):e].reshape(-1)).tobytes() for a, e in zip(asked, ends)]


def slug(text: str) -> str:
    return re.sub(r"\W+", "_", text)
