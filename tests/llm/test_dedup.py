"""Recompression, similarity sketches and run-length indexes against brute force."""

import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from cohortkit.llm import neardup, recompression, rlindex
from cohortkit.llm.common import BYTES_PER_BATCH, TEXTS_PER_BATCH, batched, firsts, text_batches
from cohortkit.llm.neardup import ORACLE as SETS_SQL
from cohortkit.llm.neardup import near_duplicates
from cohortkit.llm.recompression import ORACLE as WORDS_SQL
from cohortkit.llm.recompression import Batch, dedup_substrings
from cohortkit.llm.rlindex import ORACLE as BYTES_SQL
from cohortkit.llm.rlindex import remove_repeats, repeated_strings
from tests.llm import brute
from tests.llm.data import clashing, frame, hard_rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("width", [1, 3, 20])
def test_substring_dedup_equals_brute_force(spark, width):
    rows = hard_rows(5) + [(None, "null id " * 30), (None, "null id " * 30), (3, "an id again " * 9)]
    got = dedup_substrings(clashing(frame(spark, rows)), width, digest=True)
    assert rows_of(got) == sorted(brute.substring_dedup(rows, width), key=str)


def test_null_and_repeated_ids_are_dealt_over_several_batches_in_order(spark):
    texts = [f"{'common start ' * 3}{i * 7919 % 400} tail {i % 5}" for i in range(400)]
    rows = [(None, t) for t in texts] + [(7, t) for t in texts] + [(i, t) for i, t in enumerate(texts)] + [(None, None), (7, None)]
    dealt = [(r["batch"], r["doc_id"], r["text"]) for r in batched(frame(spark, rows))[0].collect()]
    assert sorted(map(str, (r[1:] for r in dealt))) == sorted(map(str, rows))
    assert max(Counter(b for b, _, _ in dealt).values()) < 300
    order = lambda i, t: (i is not None, i or 0, t is not None, (t or "").encode())
    by_batch = {}
    for b, i, t in dealt:
        by_batch.setdefault(b, []).append(order(i, t))
    ends = [(min(x), max(x)) for _, x in sorted(by_batch.items())]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert rows_of(dedup_substrings(frame(spark, rows), 3, digest=True)) == sorted(brute.substring_dedup(rows, 3), key=str)
    assert rows_of(remove_repeats(frame(spark, rows), 20, digest=True)) == sorted(brute.byte_dedup(rows, 20), key=str)


def test_substring_dedup_keeps_other_columns_and_untouched_texts(spark):
    rows = [(1, "a  b\nc"), (2, None), (3, " ".join(f"w{i}" for i in range(25))), (4, " ".join(f"w{i}" for i in range(30)))]
    got = {r["doc_id"]: r for r in dedup_substrings(frame(spark, rows)).collect()}
    assert got[1]["text"] == "a  b\nc" and got[2]["text"] is None
    assert got[4]["text"] == "w25 w26 w27 w28 w29" and got[4]["n_removed"] == 25 and got[4]["rest"]["lang"] == "fr"


@pytest.mark.parametrize("hot", [1, 4096])
@pytest.mark.parametrize("width", [2, 40, 400])
def test_byte_dedup_equals_brute_force(spark, monkeypatch, hot, width):
    monkeypatch.setattr(rlindex, "HOT", hot)
    rows = hard_rows(6) + [(None, "null id " * 90), (3, "an id again " * 50)]
    got = remove_repeats(clashing(frame(spark, rows)), width, digest=True)
    assert rows_of(got) == sorted(brute.byte_dedup(rows, width), key=str)


def test_long_texts_are_cut_into_pieces_without_a_trace(spark, monkeypatch):
    monkeypatch.setattr(rlindex, "PIECE", 700)
    rows = hard_rows(7)
    got = remove_repeats(frame(spark, rows), 60, digest=True)
    assert rows_of(got) == sorted(brute.byte_dedup(rows, 60), key=str)


def test_byte_dedup_spans_cut_the_kept_bytes(spark):
    rows = [(1, "é" * 30 + "tail"), (2, "head" + "é" * 30)]
    got = {r["doc_id"]: r for r in remove_repeats(frame(spark, rows), 10).collect()}
    assert [(s["begin"], s["end"]) for s in got[2]["spans"]] == [(4, 64)] and bytes(got[1]["kept"]) == b"tail"


def test_run_length_index_matches_brute_force():
    rng = np.random.default_rng(1)
    for letters, width in ((2, 6), (3, 4), (255, 3)):
        texts = [bytes(rng.integers(0, letters, rng.integers(0, 60)).astype(np.uint8)) for _ in range(12)]
        texts += [texts[0], texts[1][:20], b"\x00" * 30, b"\xff" * 9]
        places = {}
        for i, t in enumerate(texts):
            for s in range(len(t) - width + 1):
                places.setdefault(t[s:s + width], []).append((i, s))
        want = [[len(places[t[s:s + width]]) > 1 for s in range(len(t) - width + 1)] for t in texts]
        assert [x.tolist() for x in repeated_strings(texts, width)] == want


def test_near_duplicates_equal_brute_force(spark):
    rows = hard_rows(8, n=150)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(clashing(frame(spark, rows))).collect()}
    want = brute.near_duplicates(rows)
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_batches_of_texts_are_bounded_by_rows_and_bytes(spark):
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    for key in (rows, size):
        spark.conf.unset(key)
    text_batches(spark)
    assert int(spark.conf.get(rows)) == TEXTS_PER_BATCH and int(spark.conf.get(size)) == BYTES_PER_BATCH
    many = spark.range(400).selectExpr("id as doc_id", "repeat('x', 100000) as text").coalesce(1)
    sent = many.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
    n = [r["n"] for r in sent.collect()]
    assert sum(n) == 400 and len(n) > 5 and max(n) < 100
    spark.conf.set(rows, "10")
    spark.conf.set(size, "1000")
    text_batches(spark)
    assert (spark.conf.get(rows), spark.conf.get(size)) == ("10", "1000")
    for key in (rows, size):
        spark.conf.unset(key)


def test_near_duplicates_chain_and_threshold(spark):
    words = [f"w{i}" for i in range(60)]
    # each text shares 52 of 60 shingle places with the next one only: a chain far longer than one link
    chain = [(100 - k, " ".join(words[0:0] + [f"w{i}" for i in range(k * 4, k * 4 + 64)])) for k in range(12)]
    exactly = [(500, "a b c d e f g"), (501, "a b c d e f g h")]  # 3 of 4 shingles: 75 percent
    below = [(600, "k l m n o p"), (601, "k l m n o p q")]  # 2 of 3
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, chain + exactly + below)).collect()}
    want = {i: c for i, (_, c) in brute.near_duplicates(chain + exactly + below).items()}
    assert got == want and got[501] == 500 and got[601] == 601 and got[100] == 89


def test_near_duplicates_of_odd_ids(spark):
    rows = [(None, "a b c d e f"), (None, None), (7, "a b c d e f"), (7, "a b c d e f"), (8, "A B C D E F"), (9, "")]
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (0, 0, True), (7, 7, True), (7, 7, True), (8, 7, False), (9, 9, True)]


def test_near_duplicates_of_versions_with_different_texts(spark):
    a, b = "a b c d e f g", "k l m n o p q"
    rows = [(3, a), (5, a), (5, b), (7, b + " r"), (5, None), (8, "x y"), (8, "z"), (9, "z"), (9, "")]
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (3, 3, True), *[(5, 3, False)] * 3, (7, 3, False), *[(8, 8, True)] * 2, *[(9, 8, False)] * 2]
    kept = corpus_pipeline.near_duplicate(spark, frame(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 8]


def test_sketch_estimates_similarity_and_fills_every_coordinate():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 400, np.uint64)
    sets = [np.sort(base[:300]), np.sort(base[100:400]), base[:1], np.sort(base[:3])]
    key, first = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sketch = neardup.sketches(key, first)
    assert (sketch < np.iinfo(np.uint64).max).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.5) < 0.2
    # a union's sketch is the lesser of its parts'
    both = np.unique(np.concatenate(sets[:2]))
    assert (neardup.sketches(both, np.array([0, len(both)]))[0] == np.minimum(sketch[0], sketch[1])).all()


@pytest.mark.parametrize("operator", [lambda d: dedup_substrings(d, digest=True), dedup_substrings, remove_repeats, near_duplicates])
def test_empty_tables(spark, operator):
    assert operator(frame(spark, [(1, "x")]).limit(0)).collect() == []


@pytest.mark.parametrize("members, shingles", [(5, 400_000), (256, 250)])
def test_block_links_tie_what_all_pairs_tie(spark, monkeypatch, members, shingles):
    """Families of several blocks, cut by texts or by shingles: the links of the blocks connect exactly what links of 75 % connect."""
    monkeypatch.setattr(neardup, "MEMBERS_PER_GROUP", members)
    monkeypatch.setattr(neardup, "SHINGLES_PER_GROUP", shingles)
    rng = np.random.default_rng(2)
    rows = []
    for family in range(3):
        base = rng.integers(0, 2**62, 60)
        for _ in range(40):
            kept = base[rng.random(60) < rng.choice([0.95, 0.85, 0.6])]
            rows.append((len(rows), np.unique(np.concatenate([kept, rng.integers(0, 2**62, rng.integers(0, 12))])), family))
    texts = spark.createDataFrame([(i, len(s), i, s.tolist(), f) for i, s, f in rows],
                                  "rep long, n long, component long, shingles array<long>, family long").repartition(3)

    def tied(pairs):
        root = list(range(len(rows)))
        for a, b in pairs:
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
        for i in range(len(root)):
            root[i] = root[root[i]]
        return root

    sets = [set(s.tolist()) for _, s, _ in rows]
    links = {(a, b) for a in range(len(rows)) for b in range(a) if rows[a][2] == rows[b][2]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    got = [(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in neardup.block_links(texts, 75).collect()]
    assert set(got) <= links and tied(got) == tied(links) and len(set(tied(links))) > 3
    assert neardup.block_rows(texts, 75).select("family", "lo", "hi", "i", "j").distinct().count() > 30


def test_products_by_columns_equal_intersections(monkeypatch):
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(20)]
    for columns in (7, 8192):
        monkeypatch.setattr(neardup, "COLUMNS", columns)
        for split in (0, 6):
            got = neardup.products(rows, split)
            want = [[len(np.intersect1d(a, b)) for b in rows[split:]] for a in rows[:split or len(rows)]]
            off = ~np.eye(20, dtype=bool) if not split else np.ones(got.shape, bool)
            assert (got == want)[off].all()
    assert neardup.products([np.array([1]), np.array([2])], 1).tolist() == [[0.0]]


def test_second_names_of_symbols_come_from_their_words():
    """Equal stretches have equal second names wherever they lie; others differ, and so do parts of a run."""
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(words), " ".join(["before", *words, "after"]), " ".join([*words[:49], "other"]), "run " * 40]
    batch = Batch(pa.table({"doc_id": list(range(4)), "text": texts}), 20)
    starts = batch.starts[:-1]
    begin = np.array([starts[0], starts[1] + 1, starts[2], starts[3], starts[3] + 5, starts[3]])
    end = begin + np.array([50, 50, 50, 30, 30, 31])
    a, b, other, run, shifted, longer = batch.span_names(begin, end).tolist()
    assert a == b != other and run == shifted != longer


@pytest.mark.parametrize("width", [3, 20])
def test_stretches_of_a_batch_give_the_symbols_and_windows_of_the_whole(monkeypatch, width):
    rows = sorted((i, t) for i, t in hard_rows(12, n=120))
    said = []
    for words in (1, 700, 1 << 30):
        monkeypatch.setattr(recompression, "WORDS", words)
        batch = Batch(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}), width)
        batch.symbols()
        assert words > 700 or len(list(batch.stretches())) > 5
        low, high = (*batch.low, batch.low_keys), (*batch.high, batch.high_keys, batch.span_names(*batch.high))
        one, two = batch.windows(batch.whole)
        said.append([sorted(zip(*(x.tolist() for x in some))) for some in (low, high)] + [one.tolist(), two.tolist()])
    assert said[0] == said[1] == said[2] and all(said[0][1:])


def test_memory_of_a_batch_does_not_grow_with_its_parse():
    """Beside names and keys, the parse and the windows take what a stretch of texts needs, not six numbers for each word."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30_000, 500)) for _ in range(1200)]
    batch = Batch(pa.table({"doc_id": list(range(len(texts))), "text": texts}), 20)
    tracemalloc.start()
    try:
        batch.symbols()
        parsed = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        batch.windows(batch.whole)
        named = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert parsed < 60 * len(batch.names) and named < 50 * len(batch.names)


def test_symbols_with_equal_names_but_other_words_are_no_repeat():
    """What was there before under one name only stays: the second part of the key decides."""
    said = firsts([np.array([7, 7], np.uint64), np.array([7], np.uint64)], [np.array([1, 2], np.uint32), np.array([2], np.uint32)])
    bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=2 * n).reshape(-1, 2).tolist() for x, n in zip(said, (2, 1))]
    assert bits == [[[0, 0], [1, 0]], [[1, 1]]]


@pytest.mark.parametrize("operator, sql, columns", [
    (near_duplicates, SETS_SQL, ["doc_id", "n_shingles", "component_id", "kept"]),
    (lambda docs: remove_repeats(docs, digest=True), BYTES_SQL, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    (lambda docs: dedup_substrings(docs, digest=True), WORDS_SQL, ["doc_id", "n_words", "n_removed", "kept_sha256"])])
def test_rows_equal_their_sql(spark, operator, sql, columns):
    rows = hard_rows(31, n=70)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql}) ORDER BY 1").fetchall()
    assert sorted(map(tuple, operator(frame(spark, rows)).select(*columns).collect())) == want
