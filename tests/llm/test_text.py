"""BPE, token files, mixing, neighbours, quality rules, language models and the pipeline."""

import hashlib
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from cohortkit.llm import bloom_lm, onebit, rans
from cohortkit.llm.bpe import MergeRounds, encode_decode, opened, vocabulary_path
from cohortkit.llm.common import Scratch, utf8_buffer
from cohortkit.llm.divergence import ORACLE as QUALITY_SQL
from cohortkit.llm.divergence import common_words, quality
from cohortkit.llm.langid import CharModels, fit, grams, identify, predict
from cohortkit.llm.mixing import ORACLE as MIX_SQL
from cohortkit.llm.mixing import mix
from tests.llm import brute
from tests.conftest import ROOT
from tests.llm.data import clashing, frame, hard_rows

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def buffer(texts):
    import pyarrow as pa

    return utf8_buffer(pa.array(texts, pa.string()))[:2]


def split(flat, count):
    return [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])]


# ------------------------------------------------------------------ BPE

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\ta'sté1!.,<|>中\x1f\xa0"), st.characters(codec="utf-8")), max_size=40), min_size=1))
def test_chunks_and_merge_rounds_equal_the_library(texts):
    library = Tokenizer.from_file(vocabulary_path())
    for table in (opened(vocabulary_path())[1], rans.chunk_table(vocabulary_path())):
        assert split(*table.texts(*buffer(texts))) == ids_of(library, texts)


def test_special_token_runs_and_long_words(library):
    texts = ["<|endoftext|>", "a <|endoftext|>  b<|endoftext|>", "aaaa" * 300, "x" * 5000 + " y", " ", "  ", "a \n b\n \nc", "q "]
    rounds, table = opened(vocabulary_path())
    flat, count = table.texts(*buffer(texts))
    assert split(flat, count) == ids_of(library, texts)
    assert rounds.decode(flat, count) == [t.encode() for t in texts]


def test_table_that_overflows_gives_the_same(library):
    from cohortkit.llm.chunks import ChunkTable

    table = ChunkTable(MergeRounds(vocabulary_path()).encode, most=5)
    texts = [t or "" for _, t in hard_rows(9)]
    assert split(*(np.concatenate(x) for x in zip(*[table.texts(*buffer([t])) for t in texts]))) == ids_of(library, texts)


def test_encode_decode_rows(spark, library):
    rows = hard_rows(10) + [(None, "no id"), (3, "again"), (3, "again")]
    got = encode_decode(clashing(frame(spark, rows)), vocabulary_path()).collect()
    want = []
    for (i, t), ids in zip(rows, ids_of(library, [t for _, t in rows])):
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(back.encode())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert encode_decode(frame(spark, rows).limit(0), vocabulary_path()).collect() == []


def test_bytes_that_are_no_text_decode_as_in_the_library(library):
    rounds = MergeRounds(vocabulary_path())
    ids = [int(rounds.byte_id[b]) for b in (0xE4, 0xB8, 0x41, 0xFF, 0xC3)]
    assert rounds.decode(np.array(ids), np.array([5]))[0].decode() == library.decode(ids, skip_special_tokens=False)


# ------------------------------------------------------------------ token file

@settings(max_examples=30, deadline=None)
@given(st.integers(0, 5000), st.integers(1, 3000), st.integers(0, 10**6))
def test_coder_round_trip(n, kinds, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.zipf(1.3, n) - 1, kinds - 1).astype(np.uint32)
    table = rans.Table(np.bincount(ids, minlength=kinds) if n else np.zeros(kinds))
    assert (rans.decode(n, *rans.encode(ids, table), table) == ids).all()


def test_a_reader_starts_at_any_checkpoint_and_sees_damage():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 700, 3 * rans.CHECKPOINT * rans.LANES + 77).astype(np.uint32)
    table = rans.Table(np.bincount(ids))
    states, places, sums, words = rans.encode(ids, table)
    stretch = rans.CHECKPOINT * rans.LANES
    for k in range(4):
        got = rans.decode(len(ids), states, places, sums, words, table, k, k + 1)
        assert (got == ids[k * stretch:(k + 1) * stretch]).all()
    spoilt = bytearray(words)
    spoilt[len(spoilt) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(len(ids), states, places, sums, bytes(spoilt), table)
    assert len(words) < 1.02 * len(ids) * np.log2(700) / 8


def test_token_file_equals_the_library(spark, library, monkeypatch, tmp_path):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 3000)
    rows = hard_rows(11) + [(None, "no id"), (3, "b"), (3, "a"), (3, None)] + [(None, f"null id {i} " * (i % 9)) for i in range(120)]
    path = str(tmp_path / "file")
    rans.write_tokens(clashing(frame(spark, rows)), path, vocabulary_path())
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in
                 ({**r.asDict(), "doc_id": r["doc_id"] if r["doc_id"] is not None else -1} for r in rans.read_tokens(spark, path).collect()))
    at, want = 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for (i, _), ids in zip(order, ids_of(library, [t for _, t in order])):
        raw = np.array([*ids, rans.END_ID], "<u4").tobytes()
        want.append((at, -1 if i is None else i, len(ids) + 1, zlib.crc32(raw)))
        at += len(ids) + 1
    blocks = spark.read.parquet(f"{path}/blocks")
    assert got == want and blocks.count() > 3
    # null ids alone fill several ranges
    assert blocks.where("exists(doc_ids, i -> i is null)").select("shard").distinct().count() > 1
    empty = str(tmp_path / "empty")
    rans.write_tokens(frame(spark, rows).limit(0), empty, vocabulary_path())
    assert rans.read_tokens(spark, empty).collect() == []


def test_another_process_decodes_the_file(spark, library, tmp_path):
    path = str(tmp_path / "file")
    rows = hard_rows(12)
    rans.write_tokens(frame(spark, rows), path, vocabulary_path())
    code = (f"import numpy as np, pyarrow.parquet as pq\nfrom cohortkit.llm import rans\n"
            f"head = pq.read_table('{path}/head').to_pylist()[0]\n"
            f"table = rans.Table(rans.dense(list(zip(head['tokens'], head['counts']))))\n"
            f"for b in pq.read_table('{path}/blocks').sort_by([('shard', 'ascending'), ('block', 'ascending')]).to_pylist():\n"
            f"    print(*rans.decode(b['n_tokens'], b['states'], b['places'], b['checksums'], b['words'], table))\n")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT).stdout.split()
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    assert list(map(int, out)) == [i for ids in ids_of(library, [t for _, t in order]) for i in [*ids, rans.END_ID]]


def test_chunks_that_cannot_be_told_apart_are_encoded_one_by_one(library):
    encoder = rans.LibraryEncoder(vocabulary_path())
    chunks = [" one", "two", " three", ",", "\nfour", "\n", " five\n"]
    wrong = encoder.length.copy()
    encoder.length = wrong + 1  # no end of a chunk is met
    flat, count = encoder(chunks)
    assert split(flat, count) == ids_of(library, chunks)


def test_ids_beyond_sixteen_bits_travel_whole():
    for ids in ([], [0, 65535], [70000, 2**32 - 1, 5]):
        assert rans.from_planes(rans.to_planes(np.array(ids, np.uint32))).tolist() == ids


# ------------------------------------------------------------------ mixing

def test_mix_takes_no_leaf_beyond_its_budget_and_moves_shortages(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 50)) for i in range(200)] + [(None, "w w"), (5, "w"), (5, "w"), (9, None)]
    docs = clashing(frame(spark, rows))
    got = mix(docs, budget_percent=50, max_epochs=2).collect()
    assert len(got) == len(rows) and got[0].__fields__[:-1] == docs.columns
    leaves = {}
    for r in got:
        leaf = leaves.setdefault((r["mix"]["domain"], r["lang"], r["source"]), [r["mix"]["budget"], 0, 0])
        leaf[1] += r["mix"]["n_tokens"] * r["mix"]["copies"]
        leaf[2] += r["mix"]["n_tokens"]
    assert all(taken <= budget <= 2 * there for budget, taken, there in leaves.values())
    total = sum(there for *_, there in leaves.values())
    assert total // 2 - 40 <= sum(b for b, *_ in leaves.values()) <= total // 2
    whole = mix(docs, budget_percent=100, max_epochs=1).collect()
    assert all(r["mix"]["copies"] == 1 for r in whole if r["mix"]["n_tokens"])
    assert mix(docs.limit(0)).collect() == []


def test_mix_equals_its_sql(spark):
    import duckdb

    from cohortkit.llm.mixing import op4_hierarchical_budgets

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    query = con.sql(MIX_SQL)
    rows = [tuple(r[c] for c in query.columns) for r in op4_hierarchical_budgets(spark, SMALL).collect()]
    assert sorted(rows) == sorted(query.fetchall())


# ------------------------------------------------------------------ neighbours

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute_neighbours(rows, queries, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in {i: v for i, v in sorted(good, key=lambda r: (r[0], list(r[1])), reverse=True) if i in queries}.items():
        near = sorted(((-float(onebit.exact(x, v[None, :])[0]), i) for i, v in good if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def test_neighbours_of_hard_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(7).astype(np.float32)]) for i in range(300)]
    rows += [(300, None), (301, [0.0] * 7), (302, [float("nan")] * 7), (303, [1.0, None] + [0.0] * 5),
             (304, [float("inf")] + [0.0] * 6), (None, [1.0] * 7), (305, rows[0][1]), (306, rows[0][1]), (3, rows[0][1])]
    rows += [(307, [float(np.float32(1e-30))] * 7), (308, [float(np.float32(3e38))] * 7)]
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = onebit.nearest(table, table.where("vec_id in (0, 305, 7, 302, 307)")).collect()
    assert sorted(map(tuple, got)) == brute_neighbours(rows, {0, 305, 7, 307}, 5)
    few = spark.createDataFrame(rows[:3], VECTORS)
    assert sorted(map(tuple, onebit.nearest(few, few).collect())) == brute_neighbours(rows[:3], {0, 1, 2}, 5)
    assert onebit.nearest(table.limit(0), table).collect() == [] and onebit.nearest(table, table.limit(0)).collect() == []


def test_one_bit_bounds_hold():
    rng = np.random.default_rng(6)
    x, q = rng.standard_normal((500, 64)), rng.standard_normal((20, 64))
    codes, r = onebit.encode(x, onebit.rotation(64))
    guess, slack = onebit.estimates(codes, r, q, onebit.rotation(64))
    true = onebit.units(q) @ onebit.units(x).T
    assert (np.abs(guess - true) <= slack).mean() > 0.999 and codes.shape == (500, 4)


def random_vectors(rng, n, dimension=16):
    return [[float(x) for x in v] for v in rng.standard_normal((n, dimension)).astype(np.float32)]


def test_the_search_reads_a_block_of_data_once_for_many_queries(spark, monkeypatch):
    from pyspark.sql import functions as F

    frames = type(spark.range(0))
    seen, real = {}, frames.mapInArrow

    def noted(self, run, *more):
        seen[run.__name__] = self
        return real(self, run, *more)

    monkeypatch.setattr(frames, "mapInArrow", noted)
    rows = list(enumerate(random_vectors(np.random.default_rng(8), 4000)))
    table = spark.createDataFrame(rows, VECTORS).coalesce(1)
    onebit.nearest(table, table)
    read = seen["search"]
    binary = [c for c, t in read.dtypes if t == "binary"]
    total = read.agg(*[F.sum(F.length(c)).alias(c) for c in binary]).first()
    assert sum(x or 0 for x in total) < 20 * 4000 * 16 * 4  # data and queries, for each of the groups


def test_neighbours_over_many_cells_with_a_common_vector(spark, monkeypatch):
    monkeypatch.setattr(onebit, "QUERY_BYTES", 4000)
    monkeypatch.setattr(onebit, "PAIRS_PER_TASK", (2000, 1 << 37))
    rng = np.random.default_rng(9)
    v = random_vectors(rng, 1500, 7)
    rows = [(i, v[i]) for i in range(1500)] + [(i, v[0]) for i in range(2000, 2060)] + [(0, v[0])] * 20 + [(2003, v[0])] * 9
    rng.shuffle(rows)
    rows = [(int(i), [float(x) for x in w]) for i, w in rows]
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    asked = {0, 7, 2003, *range(20, 60)}
    got = onebit.nearest(table, table.where(f"vec_id in ({', '.join(map(str, asked))})")).collect()
    assert sorted(map(tuple, got)) == brute_neighbours(rows, asked, 5)


@pytest.mark.parametrize("spread", [1.0, 0.01, 0.0], ids=["apart", "close", "equal"])
def test_a_search_block_by_block_equals_all_cosines(spread):
    rng = np.random.default_rng(10)
    x = rng.standard_normal(16) * (spread < 1) + rng.standard_normal((3000, 16)) * spread
    turn, asked = onebit.rotation(16), np.arange(0, 3000, 9)
    search = onebit.Search(asked, x[asked], turn, 5)
    for at in range(0, 3000, 700):
        ids = np.arange(at, min(at + 700, 3000))
        search.meet(ids, x[ids], *onebit.encode(x[ids], turn))
    got = {}
    for part in search.result():
        for r in part.to_pylist():
            got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    for q in asked.tolist():
        score = onebit.exact(x[q], x)
        assert got[q] == sorted((-float(s), i) for i, s in enumerate(score) if i != q)[:5]


def test_no_query_loses_a_neighbour_to_collapsed_copies():
    rng = np.random.default_rng(11)
    ids, kinds = rng.integers(0, 12, 400), rng.integers(0, 6, 400)
    kinds[:200] = 0
    vectors = np.arange(6.0)[kinds, None] + np.ones(3)
    kept = onebit.most_needed(ids, vectors, 4)
    assert len(kept) <= 6 * 8
    for kind in range(6):
        for query in range(-1, 12):
            every, left = (sorted(i for i, c in zip(ids[x].tolist(), kinds[x].tolist()) if c == kind and i != query)[:4]
                           for x in (np.arange(400), kept))
            assert every == left


def test_the_grid_bounds_what_a_task_holds():
    for rows, asked, cores in ((500, 10, 8), (51_282, 1_026, 6), (15_000_000, 300_000, 6), (10**9, 10**7, 2000), (0, 0, 2)):
        query_groups, data_groups = onebit.grid(rows, asked, 704, 304, cores)
        assert asked * 704 <= query_groups * onebit.QUERY_BYTES
        assert rows * asked <= query_groups * data_groups * onebit.PAIRS_PER_TASK[1]
        assert data_groups == 1 or query_groups * data_groups < query_groups + max(
            onebit.TASKS_PER_CORE * cores, -(-rows * asked // onebit.PAIRS_PER_TASK[1]))


# ------------------------------------------------------------------ quality rules

def test_quality_base_equals_brute_force(spark):
    rows = hard_rows(12, n=120) + [(None, "f ff fff " * 20 + "f"), (3, "x"), (3, "x")]
    got = quality(clashing(frame(spark, rows))).collect()
    want = [(i, *brute.quality_base(t)) for i, t in rows]
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert quality(frame(spark, rows).limit(0)).collect() == []


def test_divergence_keeps_prose_and_rejects_junk(spark):
    rng = random.Random(7)
    words = ["the", "of", "and", "to", "in", "a", "is", "that", "house", "river", "tree", "road", "stone", "cloud", "winter"]
    prose = [(i, " ".join(rng.choice(words) for _ in range(200)) + ".") for i in range(0, 400, 4)]
    junk = [(1000, "".join(rng.choice("%$#&*<>|9") for _ in range(3000)).replace("9", " ")), (1001, " ".join(f"Q{rng.random()}" for _ in range(300)))]
    got = {r["doc_id"]: r for r in quality(frame(spark, prose + junk)).collect()}
    assert not got[1000]["kept"] and not got[1001]["kept"]
    assert sum(got[i]["kept"] or got[i]["base_failed"] for i, _ in prose) == len(prose)


def prose(rng, words, n):
    """Texts whose words come by Zipf's law, so that the first ones are the common words."""
    share = [1 / (k + 2) for k in range(len(words))]
    return [" ".join(rng.choices(words, share, k=rng.randrange(150, 300))) + "." for _ in range(n)]


def many_languages(rng):
    """(doc_id, text, lang) of three languages, one in letters beyond ASCII, one with a quote in its name and its words."""
    words = {"xx": [f"{a}{b}" for a in "kptmn" for b in ("a", "ai", "o", "u", "ere", "inda")],
             "el": [f"{a}{b}" for a in "κπτμν" for b in ("α", "αι", "ο", "ου", "ερε", "ινδα")],
             "o'c": [f"{a}'{b}" for a in "ldscj" for b in ("a", "ai", "o", "u", "ere", "inda\\")]}
    rows = [(t, lang) for lang, listed in words.items() for t in prose(rng, listed, 25)]
    rows += [("%$#& <>|* " * 60, None), ("| " * 400, "xx"), (None, "xx"), ("", "el"), ("a few words", "rare")]
    return [(i, t, lang) for i, (t, lang) in enumerate(rows)]


def test_languages_and_their_common_words_come_from_the_documents(spark):
    rows = many_languages(random.Random(21))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = common_words(docs)
    assert sorted(found) == ["el", "o'c", "xx"]  # the rare one has too few words
    for lang, listed in found.items():
        count = Counter(w for _, t, x in rows if x == lang for w in (t or "").split() if any(c.isalpha() for c in w))
        assert listed == [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0].encode()))[:8]]
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    assert all(got[i]["kept"] != got[i]["base_failed"] for i, t, _ in rows[:75])
    assert not got[75]["kept"] and not got[76]["kept"]
    # judged by another language's words alone, texts of letters beyond ASCII are refused
    alone = {r["doc_id"]: r["kept"] for r in quality(docs, {"xx": found["xx"]}).collect()}
    assert not any(alone[i] for i, _, lang in rows[:75] if lang == "el")


def test_quality_equals_its_sql(spark):
    import duckdb

    rows = many_languages(random.Random(22))
    con = duckdb.connect()
    con.register("documents", pa.table({c: list(x) for c, x in zip(("doc_id", "text", "lang"), zip(*rows))}))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({QUALITY_SQL}) ORDER BY 1").fetchall()
    assert sorted(map(tuple, quality(docs).select(*columns).collect())) == want


# ------------------------------------------------------------------ language model

FOLD = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 1"


def test_base_scores_equal_brute_force(spark):
    rows = hard_rows(13, n=80) + [(None, "the of"), (3, "the"), (3, "the")]
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
                  for r in bloom_lm.score(clashing(frame(spark, rows)), FOLD).collect()), key=str)
    for g, w in zip(got, sorted(brute.unigram_scores(rows), key=str)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9)
    assert bloom_lm.score(frame(spark, rows).limit(0), FOLD).collect() == []
    alone = bloom_lm.score(frame(spark, rows[:3]), "false").collect()
    assert {r["train_tokens"] for r in alone} == {0} and {r["n_known"] for r in alone} == {0}


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 30])
def test_model_scores_equal_brute_force(spark, broadcast_bytes):
    """With 64 bits an entry a probe errs once in 400,000: the scores are those of the exact counts, quantised."""
    rows = hard_rows(14, n=90)
    found = bloom_lm.score(frame(spark, rows), FOLD, broadcast_bytes, bits_per_entry=64).collect()
    got = {r["doc_id"]: r["score"] for r in found}
    want = dict(brute.model_scores(rows, lambda i: zlib.crc32(str(i).encode()) % 5 != 1))
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_a_broadcast_filter_and_one_asked_by_buckets_give_equal_rows(spark):
    rows = hard_rows(15, n=90) + [(None, "the of"), (3, "the"), (3, "the")]
    one, other = (sorted(bloom_lm.score(frame(spark, rows), FOLD, most).collect(), key=str) for most in (0, 1 << 30))
    assert one == other
    nothing = bloom_lm.score(frame(spark, rows[:3]), "false", 1 << 30).collect()
    assert len(nothing) == 3 and {r["n_known"] for r in nothing} == {0}


def test_a_broadcast_filter_is_probed_at_once_whatever_the_number_of_buckets(monkeypatch):
    """One word with a count of a million brought each bucket of each batch as many rounds of probes as its level has."""
    rng, n_buckets = np.random.default_rng(10), 211
    key = rng.integers(0, 2**64, 5000, np.uint64)
    bucket, count = bloom_lm.bucket_of(key, n_buckets), rng.integers(1, 1_000_000, len(key))
    found = {b: bloom_lm.filled([(key[bucket == b], count[bucket == b])]) for b in range(1, n_buckets)}  # bucket 0 has no segment
    rounds, places = [], bloom_lm.places
    monkeypatch.setattr(bloom_lm, "places", lambda *args: rounds.append(1) or places(*args))
    asked = np.append(key, rng.integers(0, 2**64, 5000, np.uint64))
    of = bloom_lm.bucket_of(asked, n_buckets)
    got = bloom_lm.levels_in(bloom_lm.joined(found, n_buckets), asked, of)
    assert len(rounds) <= got.max() + 1
    want = np.zeros(len(asked), np.uint8)
    for b in range(n_buckets):
        want[of == b] = bloom_lm.levels(np.frombuffer(found.get(b, b""), np.uint8), asked[of == b])
    assert (got == want).all() and (got[of == 0] == 0).all()
    assert (got[:5000] >= bloom_lm.level_of(count))[bucket > 0].all() and (got[5000:] > 0).mean() < 0.02
    nothing = bloom_lm.levels_in(bloom_lm.joined({}, n_buckets), asked, of)
    assert len(nothing) == len(asked) and not nothing.any()


def test_model_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(8)
    after = {w: rng.sample(range(300), 4) for w in range(300)}

    def walk(n):
        w, out = rng.randrange(300), []
        for _ in range(n):
            out.append(f"w{w}")
            w = rng.choice(after[w])
        return " ".join(out)

    rows = [(i, walk(200)) for i in range(120)]
    got = bloom_lm.score(frame(spark, rows), FOLD).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    assert held and sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)


def test_filter_never_reads_a_count_too_low_and_seldom_too_high(spark):
    rng = np.random.default_rng(9)
    words = [f"w{x}" for x in np.minimum(rng.zipf(1.4, 20000), 3000)]
    model = bloom_lm.fit(spark.createDataFrame([(" ".join(words[i:i + 100]),) for i in range(0, 20000, 100)], "text string"))
    from xxhash import xxh3_64_intdigest

    count = Counter(words)
    key = np.array([xxh3_64_intdigest(w.encode()) for w in count], np.uint64)
    bucket = (key >> np.uint64(32)) * np.uint64(model.segments) >> np.uint64(32)
    level = model.levels(key, bucket, 1)
    true = bloom_lm.level_of(np.array(list(count.values())))
    assert (level >= true).all() and (level > true).mean() < 0.05
    assert bloom_lm.level_of(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2, 3]


def test_more_words_than_one_filter_of_fixed_size_would_hold_are_all_learned(spark):
    texts = spark.range(0, 1150, 1, 8).selectExpr(
        "array_join(transform(sequence(id * 10000, id * 10000 + 9999), x -> hex(x)), ' ') as text")  # 11.5 million words, each once
    model = bloom_lm.fit(texts)
    from xxhash import xxh3_64_intdigest

    key = np.array([xxh3_64_intdigest(f"{x:x}".encode()) for x in range(0, 11_500_000, 5000)], np.uint64)
    bucket = (key >> np.uint64(32)) * np.uint64(model.segments) >> np.uint64(32)
    level = model.levels(key, bucket, 1)
    assert (level >= 1).all() and (level > 1).mean() < 0.05


def test_a_pair_seen_once_scores_above_one_never_seen(spark):
    rows = [(0, "p q z"), (1, "r s z"), (2, "p q"), (3, "p s")]
    got = {r["doc_id"]: r["score"] for r in bloom_lm.score(frame(spark, rows), "doc_id < 2").collect()}
    assert got[2] > got[3]


# ------------------------------------------------------------------ language ID

def language_rows(n=40, seed=10):
    rng = random.Random(seed)
    parts = {"en": ["the", "th", "ing", "wh", "er", "and"], "de": ["sch", "ein", "der", "ung", "ü", "ich"],
             "fr": ["eau", "le", "oi", "que", "é", "tion"]}
    out = []
    for i in range(n):
        lang = sorted(parts)[i % 3]
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(60)), lang))
    return out


def test_language_id_on_held_apart_texts(spark):
    rows = language_rows()
    train = spark.createDataFrame([(i, t, g) for i, t, g in rows if i % 2], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(i, t, "xx") for i, t, _ in rows if i % 2 == 0] + [
        (100, None, "en"), (101, "", "en"), (102, "12 -- 7", "en"), (None, "the thing", "en"), (103, "Ж" * 500, "en"),
        (104, "THE ING\n\nWHER" * 9, None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in identify(docs, train).collect()}
    assert all(got[i]["lang_pred"] == g and got[i]["score"] > 0.9 and not got[i]["rejected"] for i, _, g in rows if i % 2 == 0)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (100, 101, 102))
    assert got[None]["lang_pred"] == "en" and got[104]["lang_pred"] == "en"
    assert got[103]["rejected"] and got[103]["lang_pred"] in ("de", "en", "fr")
    assert identify(docs.limit(0), train).collect() == []
    assert {r["lang_pred"] for r in identify(docs, train.limit(0)).collect()} == {"und"}


def test_limit_of_a_rare_language_is_set_by_texts_that_were_not_fitted(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200)), "xx") for i in range(40)]
    train = spark.createDataFrame(rows[:20] + [(50, "ж" * 200, "yy")], "doc_id long, text string, lang string")
    docs = spark.createDataFrame(rows[20:] + [(51, "ж" * 200, None)], "doc_id long, text string, lang string")
    got = identify(docs, train).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in got if r["doc_id"] < 50} == {("xx", False)}
    assert {(r["lang_pred"], r["rejected"]) for r in got if r["doc_id"] == 51} == {("yy", False)}


def test_kneser_ney_probabilities_sum_to_one():
    texts = {"a": b"abracadabra abra cadabra", "b": b"barbara bar"}
    counts = {}
    for lang, t in texts.items():
        key, _ = grams(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        counts[lang] = np.unique(key, return_counts=True)
    model = CharModels.fit(counts)
    symbols = sorted({int(k & np.uint64(0xFFFF)) for c in counts.values() for k in c[0]})
    for context in (b"abr", b"rab", b"zzz", b"bar"):
        head = sum(c << 16 * (3 - j) for j, c in enumerate(context))
        key = np.array([head | s for s in [*symbols, 9999]], np.uint64)
        total = np.exp(model.log_probabilities(key).astype(np.float64)).sum(axis=0)
        assert np.allclose(total, 1.0, atol=1e-4)


def test_predictions_do_not_see_lang_or_id(spark):
    rows = language_rows(12)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = spark.sparkContext.broadcast(fit(docs))
    other = spark.createDataFrame([(i + 7, t, None) for i, t, _ in rows], "doc_id long, text string, lang string")
    by_text = lambda df: sorted((r["nats_per_char"], r["lang_pred"], r["score"]) for r in predict(df, models).collect())
    assert by_text(docs) == by_text(other)


# ------------------------------------------------------------------ pipeline

def test_pipeline_rows_follow_from_its_stages(spark, library):
    """Near duplicates, substrings and tokens against brute force; the mixture against its operator."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = Scratch(spark, "stage").write(stage(spark, docs, SMALL), name)
        assert out.columns == docs.columns
        texts = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "language":
            assert texts == {i: t for i, t in before.items() if t and any(c.isalpha() for c in t)}
        if name == "near_duplicate":
            assert set(texts) == {c for _, c in brute.near_duplicates(before.items()).values()}
        if name == "substrings":
            want = {i: (n, gone, sha) for i, n, gone, sha in brute.substring_dedup(before.items())}
            assert set(texts) == {i for i, (n, gone, _) in want.items() if gone < n or not n}
            assert all(brute.sha(b" ".join(t.encode().split())) == want[i][2] for i, t in texts.items())
            assert all(t == before[i] for i, t in texts.items() if not want[i][1])
        docs = out
    got = {r["doc_id"]: (r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SMALL).collect()}
    ids = ids_of(library, texts.values())
    assert got == {i: (len(x), np.array(x, "<u4").tobytes(), hashlib.sha256(t.encode()).hexdigest())
                   for (i, t), x in zip(texts.items(), ids)}


def test_stages_take_hard_and_empty_tables(spark):
    docs = frame(spark, hard_rows(14) + [(None, "the of and"), (6, "one"), (6, "two words"), (6, "two words")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = Scratch(spark, "stage").write(stage(spark, clashing(docs), SMALL).select(*docs.columns), "out")
        assert docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_a_null_domain_is_a_leaf_and_a_weight_of_nothing_takes_nothing(spark):
    from pyspark.sql import functions as F

    rows = [(i, "word " * 10, "en", s, 50) for i, s in enumerate(["a1", "b2", None, "c3"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    domain = F.when(F.col("source") == "a1", F.lit("kept")).when(F.col("source") == "b2", F.lit("none"))
    got = mix(docs, budget_percent=60, max_epochs=1, domain=domain, weights=[{"none": 0}, {}, {}]).collect()
    taken = {}
    for r in got:
        taken[r["mix"]["domain"]] = taken.get(r["mix"]["domain"], 0) + r["mix"]["copies"]
    assert len(got) == 20 and taken == {"kept": 5, "none": 0, "": 6}  # 70 tokens for two sources: 35 each, three texts
    with pytest.raises(ValueError, match="negative"):
        mix(docs, weights=[{"a": -1}, {}, {}])


def test_cosines_of_very_large_and_very_small_vectors(spark):
    rows = [(0, [1e200, 2e200]), (1, [1e200, 2e200]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [5e-324, 0.0]), (5, [1.7e308, -1.7e308])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in onebit.nearest(table, table, 5).collect()}
    unit = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    for (q, v), score in got.items():
        assert score == pytest.approx(unit[q] @ unit[v] / np.linalg.norm(unit[q]) / np.linalg.norm(unit[v]), abs=1e-15)
    assert len(got) == 30
    ordinary = np.random.default_rng(1).standard_normal((50, 16))
    plain = np.cumsum(ordinary * ordinary[0], axis=1)[:, -1] / (onebit.lengths(ordinary[:1])[0] * onebit.lengths(ordinary))
    assert (onebit.exact(ordinary[0], ordinary) == plain).all()
