"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

Sketch: t coordinates. In round i each shingle x of a set goes to bin b with value i + v, where (b, v)
is a hash of (i, x); a coordinate is the least value that reached its bin, and a set stops after the
round in which its last bin filled. Rounds i >= t send every shingle to bin i - t, so all bins are full
after 2t rounds at the latest, and after about t*ln(t)/n rounds in the mean. Two sets agree in a
coordinate with probability equal to their Jaccard similarity, with Chernoff concentration.

Bands of three coordinates propose pairs: with 32 bands a pair at the threshold 0.75 shares at least
two bands but for 6e-7 of cases. Equal sets are one class and sketch as one. Within a band's bucket
texts are compared to the bucket's smallest id first, so a group of copies costs one comparison per
copy, not per pair. The texts of buckets that still hold several components go on: a text with more
than a quarter of its shingles in no other component can't be linked to one and is peeled off, again
and again. What is left is connected into families over each text's rarest shared shingles, of which
linked texts have one in common, and the texts of a family are compared block by block inside
tasks: a product of two blocks' sets gives all their intersections at once, and only links come
back. Every link is decided on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import Scratch, join64, mix64, read_table, text_groups, utf8_buffer, window_names, word_names

SHINGLE, BANDS, BAND_ROWS, MIN_SHARED = 5, 32, 3, 2
COORDINATES = BANDS * BAND_ROWS
MEMBERS_PER_GROUP = 256
PARTNERS_PER_GROUP = 64  # sets that meet their hub's in one task, whatever their length
SHINGLES_PER_GROUP = 400_000  # a block of long texts has fewer members: 3 MB of names, and one text's more at most
BROADCAST_ROWS = 100_000  # request rows of 24 bytes: at most 2.4 MB are ever broadcast


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle names, text after text; first one of each text)."""
    names, starts = word_names(data, offsets, lower=True)
    n_words = np.diff(starts)
    key, at = window_names(names, starts, SHINGLE)
    text = np.repeat(np.arange(len(n_words)), n_words)[at]
    for short in range(1, SHINGLE):  # the whole sequence as one shingle
        mine = np.flatnonzero(n_words == short)
        name = np.full(len(mine), short, np.uint64)
        for j in range(short):
            name = join64(name, names[starts[mine] + j], 300 + short)
        key, text = np.concatenate([key, name]), np.concatenate([text, mine])
    order = np.argsort(text, kind="stable")
    key, text = key[order], text[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(n_words)))])
    for i in np.flatnonzero(np.diff(first) > 1):
        key[first[i]:first[i + 1]].sort()
    new = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[:len(key)]
    key, text = key[new], text[new]
    return key, np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(n_words)))])


def sketches(key: np.ndarray, first: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """One row of t coordinates (round in the high half, value in the low half) per non-empty set."""
    size = np.diff(first)
    sets = len(size)
    out = np.full((sets, t), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(sets), size)
    for i in range(2 * t):
        if not len(key):
            break
        h = mix64(key + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        bins = (h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32) if i < t else np.full(len(h), i - t, np.uint64)
        value = np.uint64(i << 32) | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, owner * t + bins.astype(np.int64), value)
        todo = (out == np.iinfo(np.uint64).max).any(axis=1)[owner]
        key, owner = key[todo], owner[todo]
    return out


SIGNED_SQL = "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, number of shingles, 128-bit name of the set, band keys (none for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, 2 << 20):
            data, offsets, _ = utf8_buffer(batch.column("text"))
            key, first = shingle_sets(data, offsets)
            size = np.diff(first)
            full = np.flatnonzero(size)
            name = np.zeros((2, len(size)), np.uint64)
            if len(full):
                for j in (0, 1):
                    name[j, full] = np.add.reduceat(mix64(key + np.uint64(1 + j)), first[full])
            sketch = sketches(key, first)[full].reshape(len(full), BANDS, BAND_ROWS)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(full), BANDS))
            for j in range(BAND_ROWS):
                band = join64(band, sketch[:, :, j], 41)
            ends = np.zeros(len(size) + 1, np.int32)
            ends[1:] = np.cumsum(np.where(size > 0, BANDS, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(name[0].view(np.int64)),
                 pa.array(name[1].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(band).reshape(-1).view(np.int64)))],
                names=["doc_id", "n_shingles", "set1", "set2", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SIGNED_SQL)


def verified(docs: DataFrame, pairs: DataFrame, n_pairs: int, percent: int) -> DataFrame:
    """Those (a, b) of ``pairs`` whose shingle sets have 100 * intersection >= percent * union.

    The sets of a hub b and of its partners meet in groups of about PARTNERS_PER_GROUP partners, however many there are.
    """
    pieces = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(PARTNERS_PER_GROUP)).cast("int").alias("pieces"))
    of_a = pairs.join(pieces, "b").select(
        F.col("a").alias("doc_id"), "b", F.pmod(F.xxhash64("a"), F.col("pieces")).cast("int").alias("piece"))
    of_b = pieces.select(F.col("b").alias("doc_id"), "b",
                         F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    asked = of_a.unionByName(of_b)
    if n_pairs <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(asked, "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, 2 << 20):
            data, offsets, _ = utf8_buffer(batch.column("text"))
            key, first = shingle_sets(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("b"), batch.column("piece"),
                 pa.array([key[s:e].tobytes() for s, e in zip(first[:-1], first[1:])], pa.binary())],
                names=["doc_id", "b", "piece", "shingles"])

    def compare(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id").to_numpy()
        hub = group.column("b")[0].as_py()
        rows = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        hubs = [r for i, r in zip(ids, rows) if i == hub and len(r)]
        good = set()
        for i, r in zip(ids.tolist(), rows):
            if i == hub or i in good or not len(r):
                continue
            for h in hubs:
                at = np.minimum(np.searchsorted(h, r), len(h) - 1)
                both = int((h[at] == r).sum())
                if 100 * both >= percent * (len(h) + len(r) - both):
                    good.add(i)
                    break
        return pa.table({"a": pa.array(sorted(good), pa.int64()), "b": pa.array([hub] * len(good), pa.int64())})

    return texts.select("doc_id", "b", "piece", "text").mapInArrow(
        sets, "doc_id long, b long, piece int, shingles binary").groupBy("b", "piece").applyInArrow(compare, "a long, b long")


def member_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(rep, n, shingle): the full sets of ``members`` (rep), one row per shingle."""
    if members.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(members, "rep")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, 2 << 20):
            data, offsets, _ = utf8_buffer(batch.column("text"))
            key, first = shingle_sets(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array(np.diff(first), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(key.view(np.int64)))],
                names=["rep", "n", "shingles"])

    return texts.select("rep", "text").mapInArrow(sets, "rep long, n long, shingles array<long>").withColumn(
        "shingle", F.explode("shingles")).drop("shingles")


def peeled(held: DataFrame, found: DataFrame, scratch: Scratch, percent: int, name: str) -> DataFrame:
    """Rows of ``held`` with component, df and c: shingles that two components hold, of texts that have enough of them.

    A text with fewer than ``percent`` of its shingles in other components is linked to none of them. What it alone
    shared with the others then is no longer shared, so this goes on until little changes.
    """
    now = held.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    before, i = None, 0
    while True:
        shared = now.groupBy("shingle").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("df")).where("lo < hi")
        left = now.drop("df", "c").join(shared.select("shingle", "df"), "shingle")
        enough = left.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("c")).where(100 * F.col("c") >= percent * F.col("n"))
        now = scratch.write(left.join(enough, ["rep", "n"]), f"{name}-{i}")
        n = now.count()
        if i:
            scratch.drop(f"{name}-{i - 1}")
        if not n or before is not None and n > 0.95 * before:
            return now
        before, i = n, i + 1


def prefixes(held: DataFrame, percent: int) -> DataFrame:
    """Each text's rarest shared shingles. Of its c, all but need - 1 may miss a linked text, so one of the first
    c - need + 1 is in both."""
    rarest = Window.partitionBy("rep", "n").orderBy("df", "shingle")
    need = F.ceil(percent * F.col("n") / 100)
    return held.withColumn("place", F.row_number().over(rarest)).where(F.col("place") <= F.col("c") - need + 1).select(
        "shingle", "rep", "component", "n", "c")


def families(prefix: DataFrame, scratch: Scratch) -> DataFrame:
    """(rep, family): texts connected over prefix shingles. Each posting ties its texts to its least one, a row per text."""
    least = prefix.groupBy("shingle").agg(F.min("rep").alias("b"))
    tied = prefix.join(least, "shingle").select(F.col("rep").alias("a"), "b")
    return components(tied, scratch, "families").select(F.col("node").alias("rep"), F.col("component").alias("family"))


def block_rows(texts: DataFrame, percent: int) -> DataFrame:
    """Each text of a family once for each pair of blocks that its own is compared in: family, lo, hi, i, j, side.

    Texts of a family are dealt by size into classes, so that linked texts are in one class or in neighbouring ones, and
    each class by hash into blocks of about MEMBERS_PER_GROUP texts, or SHINGLES_PER_GROUP shingles if that is less. Pairs of blocks (i, j) are those of one class (lo = hi,
    i <= j) and of two neighbouring ones (hi = lo + 1). Side 0 holds the texts of block i, side 1 those of block j.
    """
    of = texts.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(np.log(100.001 / percent))).cast("int"))
    sizes = of.groupBy("family", "class").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / F.lit(MEMBERS_PER_GROUP), F.sum("n") / F.lit(SHINGLES_PER_GROUP))).cast("int").alias("blocks"))

    def neighbour(step: int, name: str) -> DataFrame:
        return sizes.select("family", (F.col("class") - step).cast("int").alias("class"), F.col("blocks").alias(name))

    of = of.join(sizes, ["family", "class"]).join(neighbour(1, "above"), ["family", "class"], "left").join(
        neighbour(-1, "below"), ["family", "class"], "left")
    of = of.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))

    def pairs(n: str, lo: str, hi: str, i: str, j: str, side: str) -> str:
        listed = f"if({n} > 0, sequence(0, {n} - 1), array())"
        return f"transform({listed}, k -> struct({lo} as lo, {hi} as hi, {i} as i, {j} as j, {side} as side))"

    every = F.expr("concat(" + ", ".join([
        pairs("blocks", "class", "class", "least(own, k)", "greatest(own, k)", "if(own <= k, 0, 1)"),
        pairs("coalesce(above, 0)", "class", "class + 1", "own", "k", "0"),
        pairs("coalesce(below, 0)", "class - 1", "class", "k", "own", "1")]) + ")")
    return of.select("family", "rep", "component", "n", "shingles", F.explode(every).alias("at")).select(
        "family", "at.*", "rep", "component", "n", "shingles")


COLUMNS = 1 << 13  # shingles that a product of blocks holds at a time


def products(rows: list[np.ndarray], split: int) -> np.ndarray:
    """Number of shingles in common of each text before ``split`` with each from there on (split 0: of all with all).

    Shingles that only one text holds are left out; the others are taken COLUMNS at a time.
    """
    key = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    _, column, times = np.unique(key, return_inverse=True, return_counts=True)
    keep = times[column] > 1
    number = np.cumsum(times > 1) - 1
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    cut = split or len(rows)
    out = np.zeros((cut, len(rows) - split), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(rows), min(COLUMNS, width - at)), np.float32)
        held[owner[lo:hi], column[lo:hi] - at] = 1
        out += held[:cut] @ held[split:].T
    return out


def block_links(texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that tie together what is linked in ``texts`` (family, rep, component, n, shingles shared with others).

    A pair of blocks meets in one task, which multiplies their sets and gives back only links between texts that nothing
    in the task has tied yet: fewer than it has texts. So what Spark shuffles are texts, and no pairs are.
    """
    def compare(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        one_block = group.column("lo")[0] == group.column("hi")[0] and group.column("i")[0] == group.column("j")[0]
        order = np.argsort(side, kind="stable")
        rep, n, component = (group.column(c).to_numpy()[order] for c in ("rep", "n", "component"))
        shingles = group.column("shingles").combine_chunks()
        shingles = pa.concat_arrays(shingles.chunks) if isinstance(shingles, pa.ChunkedArray) else shingles
        ends, flat = shingles.offsets.to_numpy(), shingles.values.to_numpy()
        rows = [flat[ends[k]:ends[k + 1]] for k in order.tolist()]
        split = 0 if one_block else int((side == 0).sum())
        a, b = [], []
        if one_block or 0 < split < len(rows):
            both = products(rows, split).astype(np.int64)
            total = (n[:split or len(n)][:, None] + n[split:][None, :]) - both
            x, y = np.nonzero(100 * both >= percent * total)
            if one_block:
                x, y = x[x < y], y[x < y]
            root = {c: c for c in component.tolist()}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            for k, m in zip(x.tolist(), (y + split).tolist()):
                one, two = find(int(component[k])), find(int(component[m]))
                if one != two:
                    root[max(one, two)] = min(one, two)
                    a.append(int(rep[k]))
                    b.append(int(rep[m]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return block_rows(texts, percent).groupBy("family", "lo", "hi", "i", "j").applyInArrow(compare, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): alternating stars until nothing changes; component is the smallest node. Edges stay in Spark."""
    now = scratch.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), f"{name}-0")
    seen, i = None, 0
    while True:
        # every larger neighbour of a node is tied to the least node of its neighbourhood
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # then every node and its smaller neighbours to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        i += 1
        now = scratch.write(small, f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sign) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = tuple(sign)


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Groups of texts linked by 100 * intersection >= percent * union of their five-word shingle sets.

    ``docs`` has doc_id and text; other columns are ignored. Result, one row per row: doc_id, n_shingles, component_id
    (smallest doc_id reachable over links), kept (doc_id = component_id). A text of under five words is one shingle;
    a null text or one without words has none and is linked with nothing. Rows with the same doc_id are versions of one
    document: they are in one group, and what links one of them links all, an empty one too. A null doc_id can't be named: such a row is its own group, with
    component_id null and kept true. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    sig = scratch.write(signed(docs), "signed")
    some = sig.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.write(some.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = some.join(classes, ["set1", "set2"]).where("doc_id = rep").select("rep", "bands")
    bands = scratch.write(reps.select("rep", F.explode("bands").alias("band")).distinct(), "bands")
    hubs = bands.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    multi = scratch.write(bands.join(hubs.drop("last"), "band"), "multi")
    scratch.drop("bands")

    tested: DataFrame | None = None
    edges = None
    found = scratch.write(sig.limit(0).select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component")), "none")
    # versions of one doc_id are tied to it, whatever their sets
    again = scratch.write(sig.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    versions = not again.isEmpty()
    if versions:
        edges = scratch.write(some.join(again, "doc_id").join(classes, ["set1", "set2"]).select(
            F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct(), "versions")
        found = components(edges, scratch, "components-versions")

    def settle(pairs: DataFrame, step: str) -> None:
        """Check pairs that were not checked yet, and take in the new links."""
        nonlocal tested, edges, found
        pairs = scratch.write(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), f"pairs-{step}")
        n = pairs.count()
        if not n:
            return
        tested = pairs if tested is None else tested.unionByName(pairs)
        good = scratch.write(verified(docs, pairs, n, percent), f"edges-{step}")
        if not good.isEmpty():
            edges = good if edges is None else edges.unionByName(good)
            found = components(edges, scratch, f"components-{step}")

    def component(of: str) -> DataFrame:
        return found.select(F.col("node").alias(of), F.col("component").alias(f"{of}_component"))

    def placed() -> DataFrame:
        return multi.join(component("rep"), "rep", "left").withColumn("rep_component", F.coalesce("rep_component", "rep"))

    # the bucket heads that a text shares most bands with: most texts are settled here
    shared = multi.where("rep <> hub").groupBy("rep", "hub").count().where(F.col("count") >= MIN_SHARED)
    settle(shared.groupBy("rep").agg(F.max(F.struct(F.col("count"), (-F.col("hub")).alias("hub"))).alias("top")).select(
        F.col("rep").alias("a"), (-F.col("top.hub")).alias("b")), "best")
    # the other bucket heads
    settle(placed().where("rep <> hub").join(component("hub"), "hub", "left").where(
        F.col("rep_component") != F.coalesce("hub_component", "hub")).groupBy("rep", "hub").count().where(
        F.col("count") >= MIN_SHARED).select(F.col("rep").alias("a"), F.col("hub").alias("b")), "hubs")
    # buckets that still hold several components: their texts with those of other components
    mixed = placed().groupBy("band").agg(
        F.min("rep_component").alias("lo"), F.max("rep_component").alias("hi")).where("lo < hi").select("band")
    members = scratch.write(multi.join(mixed, "band").select("rep").distinct(), "members")
    held = scratch.write(member_shingles(docs, members), "held")
    left = peeled(held, found, scratch, percent, "peeled")
    if not left.isEmpty():
        family = families(prefixes(left, percent), scratch)
        texts = left.groupBy("rep", "n", "component").agg(F.collect_list("shingle").alias("shingles")).join(family, "rep")
        good = scratch.write(block_links(texts, percent), "block-links")
        if not good.isEmpty():
            edges = good if edges is None else edges.unionByName(good)
            found = components(edges, scratch, "components-blocks")
    scratch.drop("held", "multi")

    group = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set1", "set2", F.coalesce("component", "rep").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "set1", "set2").join(group, ["set1", "set2"], "left")
    if versions:  # an empty version goes with the others
        out = out.join(again.join(found.withColumnRenamed("node", "doc_id"), "doc_id").withColumnRenamed(
            "component", "of_versions"), "doc_id", "left")
    else:
        out = out.withColumn("of_versions", F.lit(None).cast("long"))
    component_id = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).when(
        F.col("n_shingles") == 0, F.coalesce("of_versions", "doc_id")).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op3_similarity_sketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM w, unnest(range(1, greatest(1, len(w) - 4) + 1)) u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other),
reached AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN reached USING (doc_id) LEFT JOIN n USING (doc_id)"""
