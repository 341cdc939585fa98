"""Approximate nearest neighbours by randomly rotated one-bit codes.

Each vector, scaled to length one and padded to ``bits`` dimensions, is turned by a seeded random rotation; its
code is the signs. With x the turned vector, s its signs over sqrt(bits) and r = <s, x>, the value <s, q> / r
estimates <x, q> for a turned unit query q without bias, and misses it by more than
e * sqrt((1 - r * r) / (r * r)) / sqrt(bits - 1) only with a probability that falls like exp(-e * e). A code turned
back is a vector y of the table's own dimension with <y, u> = <s, q> for every query u and its turned q, so that a
block of codes meets a block of queries in one matrix product. The bounds, which also leave room for a query cut to
eight bits per dimension, choose which vectors are compared exactly.

Queries and data meet on a grid: a cell takes one of the query groups and one of the data groups. Its task holds the
queries, with their best so far, and reads the data block by block, so it never holds more than that and a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import columns, mix64, read_table, release, text_batches

BITS_PER_DIMENSION, PLANES, ERROR_FACTOR, SEED = 4, 8, 3.0, 20240229
DATA_BLOCK, QUERY_BLOCK = 4096, 256
QUERY_BYTES = 96 << 20  # what a task holds of queries
TASKS_PER_CORE = 4
PAIRS_PER_TASK = 1 << 20, 1 << 37  # fewer tasks than that, or more, if one would have less or more pairs
PICKS_AT_ONCE = 1 << 20  # components of picked vectors that are compared at a time
GATHER_SHARE = 50  # one more product is cheaper than to gather more than a pair of so many


def code_bits(dimension: int) -> int:
    return -(-dimension * BITS_PER_DIMENSION // 64) * 64


def rotation(dimension: int) -> np.ndarray:
    """The first ``dimension`` rows of a random rotation of ``code_bits`` dimensions."""
    bits = code_bits(dimension)
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits, dimension)))
    return (q * np.sign(np.diag(r))).T


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths, summed from the first component on in double precision."""
    return np.sqrt(np.cumsum(vectors * vectors, axis=1)[:, -1])


def units(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one for the codes."""
    scaled = by_powers(vectors)
    return scaled / lengths(scaled)[:, None]


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes as rows of 64-bit words, <s, x>)."""
    turned = units(vectors) @ turn
    positive = turned > 0
    codes = np.packbits(positive, axis=1, bitorder="little").view(np.uint64)
    return codes, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])


def decode(codes: np.ndarray, r: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The codes turned back, over r: their products with a unit query are the estimated cosines."""
    signs = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
    return signs @ turn.T.astype(np.float32) / (np.sqrt(turn.shape[1]) * r).astype(np.float32)[:, None]


def slacks(r: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """A code's bound on the error; single precision and the sums of ``decode`` add the last term."""
    bits = turn.shape[1]
    slack = ERROR_FACTOR * np.sqrt(np.maximum(0.0, 1 - r * r)) / r / np.sqrt(max(1, bits - 1))
    return slack + sum(turn.shape) * 2.0**-22 / r


def spreads(units_: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """A query's part of the bound, still to be divided by r: half a step of eight bits in each dimension."""
    turned = units_ @ turn
    return (turned.max(axis=1) - turned.min(axis=1)) / (2**PLANES - 1) * np.sqrt(turn.shape[1]) / 2


def estimates(codes: np.ndarray, r: np.ndarray, queries: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated cosines, bound on the error), one row per query and one column per code."""
    u = units(queries)
    return u.astype(np.float32) @ decode(codes, r, turn).T, slacks(r, turn) + spreads(u, turn)[:, None] / r


def by_powers(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to between a half and one.

    That changes no digit of a cosine, and squares neither overflow nor vanish together.
    """
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision: products summed from the first component on, over the product of the lengths.

    ``query`` is one vector, or one for each of the vectors.
    """
    query, vectors = by_powers(np.atleast_2d(query)), by_powers(vectors)
    dot = np.cumsum(vectors * query, axis=1)[:, -1]
    return dot / (lengths(query) * lengths(vectors))


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of what is true in a mask with few such places: eight are looked at together."""
    flat = mask.ravel()
    if flat.size % 8:
        return np.divmod(np.flatnonzero(flat), mask.shape[1])
    eights = np.flatnonzero(flat.view(np.uint64))
    within = np.flatnonzero(flat.reshape(-1, 8)[eights])
    return np.divmod(eights[within >> 3] * 8 + (within & 7), mask.shape[1])


class Best:
    """The ``k`` best of each query: the largest values, of equal ones the smallest ids."""

    def __init__(self, n: int, k: int, dtype=np.float64):
        self.values = np.full((n, k), -np.inf, dtype)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, values: np.ndarray, ids: np.ndarray) -> None:
        rows, k = np.unique(query), self.values.shape[1]
        query = np.concatenate([np.repeat(rows, k), query])
        values = np.concatenate([self.values[rows].ravel(), values])
        ids = np.concatenate([self.ids[rows].ravel(), ids])
        order = np.lexsort((ids, -values, query))
        first = order[np.searchsorted(query[order], rows)[:, None] + np.arange(k)]
        self.values[rows], self.ids[rows] = values[first], ids[first]


class Search:
    """The queries of one cell, which meet its data block by block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, k: int):
        order = np.argsort(ids)  # no id is there twice
        self.ids, self.vectors, self.turn, self.k = ids[order], vectors[order], turn, k
        n, self.dimension = vectors.shape
        # a row times a row of ``columns_of``: the estimate, plus its bound, less the mark that it must reach
        self.rows = np.zeros((n, self.dimension + 3), np.float32)
        for at in range(0, n, DATA_BLOCK):
            u = units(self.vectors[at:at + DATA_BLOCK].astype(np.float64))
            self.rows[at:at + DATA_BLOCK, :-3] = u
            self.rows[at:at + DATA_BLOCK, -1] = spreads(u, turn)
        self.rows[:, -3] = 1
        self.best = Best(n, k)
        self.low = Best(n, k, np.float32)  # the largest lower bounds; the last is the mark
        self.rounding = (self.dimension + 8) * 2.0**-22  # of cosines in single precision
        self.waiting: list[list[np.ndarray]] = []
        self.seen = 0
        self.room: dict[str, np.ndarray] = {}

    def columns_of(self, codes: np.ndarray, r: np.ndarray) -> np.ndarray:
        out = np.ones((len(r), self.dimension + 3), np.float32)
        out[:, :-3], out[:, -3], out[:, -1] = decode(codes, r, self.turn), slacks(r, self.turn), 1 / r
        return out

    def product(self, name: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """a @ b.T in memory that is used again."""
        size = len(a) * len(b)
        if name not in self.room or len(self.room[name]) < size:
            self.room[name] = np.empty(size, np.float32)
        return np.matmul(a, b.T, out=self.room[name][:size].reshape(len(a), len(b)))

    def meet(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, r: np.ndarray) -> None:
        at = 0
        while at < len(ids):  # the first blocks are short, as few marks stand yet
            part = slice(at, at + max(QUERY_BLOCK, self.seen))
            self.meet_block(ids[part], vectors[part], codes[part], r[part])
            at, self.seen = part.stop, self.seen + part.stop - at

    def meet_block(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, r: np.ndarray) -> None:
        found = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        own = np.flatnonzero(self.ids[found] == ids)
        own = own[np.argsort(found[own], kind="stable")]
        queries_own = found[own]
        against, plain = self.columns_of(codes, r), units(vectors).astype(np.float32)
        for at in range(0, len(self.ids), QUERY_BLOCK):
            rows = self.rows[at:at + QUERY_BLOCK]
            upper = self.product("upper", rows, against)
            a, b = np.searchsorted(queries_own, [at, at + QUERY_BLOCK])
            upper[queries_own[a:b] - at, own[a:b]] = -np.inf
            if np.isinf(self.low.values[at:at + QUERY_BLOCK, -1]).any():
                self.first(at, upper, rows, against, plain)
            else:
                self.pick(at, upper, rows, against, plain)
            if sum(len(w[0]) for w in self.waiting) > PICKS_AT_ONCE // 4:
                self.settle(ids, vectors)
        self.settle(ids, vectors)

    def first(self, at: int, upper: np.ndarray, rows: np.ndarray, against: np.ndarray, plain: np.ndarray) -> None:
        """Queries of which some have no mark yet: the marks come from this block, whose cosines are all taken."""
        low, k = self.low.values[at:at + QUERY_BLOCK], self.k
        mark = np.where(np.isinf(low[:, -1:]), 0, low[:, -1:])
        lower = upper - 2 * (against[:, -3] + rows[:, -1:] * against[:, -1]) + mark
        low[:] = -np.sort(-self.largest(np.hstack([low, lower])), axis=1)
        near = np.where(upper + mark >= low[:, -1:], rows[:, :-3] @ plain.T, -np.inf)
        near[np.isneginf(upper)] = -np.inf
        here = self.largest(near).min(axis=1) if near.shape[1] >= k else -np.inf
        t = np.maximum(self.best.values[at:at + QUERY_BLOCK, -1], here)
        query, row = np.nonzero((near >= (t - 2 * self.rounding)[:, None]) & ~np.isneginf(near))
        self.waiting.append([query + at, row, np.zeros(0, np.int64), np.zeros(0, np.float32)])

    def largest(self, values: np.ndarray) -> np.ndarray:
        return np.partition(values, -self.k, axis=1)[:, -self.k:]

    def pick(self, at: int, upper: np.ndarray, rows: np.ndarray, against: np.ndarray, plain: np.ndarray) -> None:
        mask = upper >= 0
        picks, t = np.count_nonzero(mask), self.best.values[at:at + QUERY_BLOCK, -1] - self.rounding
        if not picks:
            return
        if picks * GATHER_SHARE > upper.size:
            mask &= self.product("near", rows[:, :-3], plain) >= t[:, None].astype(np.float32)
            query, row = places(mask)
            least = against[:, -3].min() + rows[:, -1].min() * against[:, -1].min()
            raised, by = places(upper > 2 * least)  # no bound is under ``least``: all that raise a mark are here
        else:
            query, row = raised, by = places(mask)
            n = max(1, PICKS_AT_ONCE // self.dimension)
            near = np.concatenate([np.vecdot(rows[query[i:i + n], :-3], plain[row[i:i + n]]) for i in range(0, picks, n)])
            keep = near >= t[query]
            query, row = query[keep], row[keep]
        above = upper[raised, by] - 2 * (against[by, -3] + rows[raised, -1] * against[by, -1])
        raised, above = raised[above > 0] + at, above[above > 0]
        self.waiting.append([query + at, row, raised, above + self.low.values[raised, -1]])

    def settle(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compare what was picked exactly, and raise the marks."""
        query, row, raised, low = (np.concatenate(x) for x in zip(*self.waiting)) if self.waiting else ([], [], [], [])
        self.waiting.clear()
        n = max(1, PICKS_AT_ONCE // self.dimension)
        for i in range(0, len(query), n):
            a, b = query[i:i + n], row[i:i + n]
            self.best.add(a, exact(self.vectors[a].astype(np.float64), vectors[b]), ids[b])
        if len(raised):
            self.low.add(raised, low, np.zeros(len(raised), np.int64))
        mark = self.low.values[:, -1]
        self.rows[:, -2] = np.where(np.isinf(mark), 0, -mark)

    def result(self, most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.ids), most):
            score, ids = self.best.values[at:at + most], self.best.ids[at:at + most]
            query, rank = np.nonzero(score > -np.inf)
            yield columns(FOUND, query_id=self.ids[at + query], vec_id=ids[query, rank], score=score[query, rank])


def most_needed(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the ``k`` best of a query: of equal vectors the smallest ids, enough without any one id."""
    whole = np.ascontiguousarray(vectors).view(f"V{vectors.itemsize * vectors.shape[1]}").ravel()
    _, kind = np.unique(whole, return_inverse=True)
    if len(kind) <= k or np.bincount(kind).max() <= k:
        return np.arange(len(ids))
    order = np.lexsort((ids, kind))
    for keys, most in (((kind, ids), k), ((kind,), 2 * k)):
        new = np.append(True, np.any([x[order][1:] != x[order][:-1] for x in keys], axis=0))
        start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        order = order[np.arange(len(order)) - start < most]
    return np.sort(order)


def grid(rows: int, asked: int, query_bytes: int, row_bytes: int, cores: int) -> tuple[int, int]:
    """(query groups, data groups): tasks enough for the cores, groups of queries that fit a task, little to shuffle."""
    least, most = PAIRS_PER_TASK
    tasks = max(1, min(TASKS_PER_CORE * cores, rows * asked // least), -(-rows * asked // most))
    even = round((tasks * asked * query_bytes / max(1, rows * row_bytes)) ** 0.5)  # copies of either side are as large
    # two groups at least: a query's first marks in a cell cost more than a second copy of the data
    of_queries = max(-(-asked * query_bytes // QUERY_BYTES), min(max(2, even), tasks))
    return of_queries, -(-tasks // of_queries)


QUERIES, DATA = 0, 1
BLOCK = pa.schema([("part", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in ("ids", "vectors", "codes", "r")]])
BLOCK_SQL = "part int, kind int, ids binary, vectors binary, codes binary, r binary"
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(table: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` vectors of ``table`` with the largest cosine to each query.

    Both have vec_id and embedding; other columns are ignored. A query's own vec_id is no candidate of it. Rows whose
    vec_id or vector is null, whose vector is zero, holds a null or non-finite component or has not the usual length
    of the table's vectors take no part. Ties go to the smaller vec_id; repeated rows are separate candidates, and a
    repeated query id is asked once. With fewer candidates all are returned; empty tables give an empty result.
    """
    spark = table.sparkSession
    text_batches(spark)  # a block is a long row
    size = table.where("embedding is not null and size(embedding) > 0").groupBy(
        F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    dimension, rows = (size[0]["size"], size[0]["count"]) if size else (1, 0)
    single = all(isinstance(x.schema["embedding"].dataType.elementType, T.FloatType) for x in (table, queries))
    number, kind = (np.float32, "float") if single else (np.float64, "double")
    width = dimension * np.dtype(number).itemsize
    turn = rotation(dimension)
    query_groups, data_groups = grid(
        rows, queries.where("vec_id is not null").count(), width + 4 * dimension + 32 * (k + 1),
        width + code_bits(dimension) // 8 + 16, spark.sparkContext.defaultParallelism)
    data_block = min(DATA_BLOCK, max(QUERY_BLOCK, rows // (8 * data_groups)))

    def sized(rows: DataFrame) -> DataFrame:
        v = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v"))
        return v.where(f"vec_id is not null and size(v) = {dimension}")

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(number).reshape(-1, dimension)
            good = np.isfinite(v).all(axis=1) & v.any(axis=1)
            yield np.asarray(batch.column("vec_id"))[good], v[good]

    def block(part: int, kind: int, *arrays: np.ndarray) -> pa.RecordBatch:
        binary = [pa.array([x.tobytes()], pa.binary()) for x in arrays] + [pa.nulls(1, pa.binary())] * (4 - len(arrays))
        return columns(BLOCK, part=[part], kind=[kind], **dict(zip(("ids", "vectors", "codes", "r"), binary)))

    def data_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = int(mix64(np.array([TaskContext.get().partitionId()]))[0] % np.uint64(data_groups))
        for ids, v in usable(batches):
            for at in range(0, len(ids), data_block):
                mine = at + most_needed(ids[at:at + data_block], v[at:at + data_block], k)
                yield block(turns % data_groups, DATA, ids[mine], v[mine], *encode(v[mine].astype(np.float64), turn))
                turns += 1

    def query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, v in usable(batches):
            group = mix64(ids.view(np.uint64)) % np.uint64(query_groups)
            for g in np.unique(group).tolist():
                yield block(g, QUERIES, ids[group == g], v[group == g])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[np.ndarray, np.ndarray]] = []
        cell = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("kind", "ids", "vectors", "codes", "r")}
                ids, v = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], number).reshape(-1, dimension)
                if row["kind"] == QUERIES:
                    asked.append((ids, v))
                elif asked:  # the cell's queries come first
                    cell = cell or Search(*map(np.concatenate, zip(*asked)), turn, k)
                    codes = np.frombuffer(row["codes"], np.uint64).reshape(len(ids), -1)
                    cell.meet(ids, v.astype(np.float64), codes, np.frombuffer(row["r"], np.float64))
        if cell:
            yield from cell.result()
        release()

    def to_cells(blocks: DataFrame, others: int, cell) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))) if others > 1 else F.lit(0)
        return blocks.withColumn("other", other).select(cell.cast("int").alias("cell"), "kind", "ids", "vectors", "codes", "r")

    good = F.expr("forall(v, x -> x is not null and abs(x) < double('inf')) and exists(v, x -> x <> 0)")
    once = sized(queries).where(good).groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(query_blocks, BLOCK_SQL)
    asked = to_cells(once, data_groups, F.col("part") * data_groups + F.col("other"))
    data = to_cells(sized(table).mapInArrow(data_blocks, BLOCK_SQL), query_groups, F.col("other") * data_groups + F.col("part"))
    found = asked.unionByName(data).repartitionById(query_groups * data_groups, F.col("cell")).sortWithinPartitions("kind")
    found = found.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op7_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return nearest(table, table.where("pmod(vec_id, 50) = 0"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS size FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_reduce(list_transform(list_zip(c.e, q.e),
    lambda z: z[1] * z[2]), lambda a, b: a + b) / (q.size * c.size) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
