"""Secret scans, cross-tokenizer alignment and spelling variants against brute force, on texts with everything in them."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortkit.llm import alignment, secrets, spelling
from cohortkit.llm.bpe import byte_symbols, vocabulary_path
from tests.llm.data import DOCUMENTS, clashing, frame, hard_rows

A, B = vocabulary_path(), alignment.sentencepiece_path()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sql_rows(sql, rows, names):
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    return sorted(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall(), key=repr)


# ------------------------------------------------------------------ secrets

SECRETS = [
    "password=abc", "PassWord : 'abcdef'", "password: token: abcdefgh", "secret=token=abcdef1", 'api_key="x/y+z=12', "apikey:short",
    "AKIA" + "A1" * 8, "AKIA" + "B" * 15, "xAKIAAKIA" + "C" * 12, "0123456789abcdef" * 2, "0123456789abcdef0123456", "é" * 9 + "f" * 24,
    "toKen\x20\x20=  deadbeefdeadbeefdeadbeef01", "password=AKIA" + "Z9" * 10, "tokentokentoken=======", "ſecret=abcdefgh"]


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def secret_rows(seed=5):
    rng = random.Random(seed)
    rows = hard_rows(seed) + [(1000 + i, s) for i, s in enumerate(SECRETS)]
    for i in range(30):
        rows.append((2000 + i, " ".join(rng.choice([*SECRETS, "plain", "…", "\n", "getUserNameFromRequest", "read_configuration_file"]) for _ in range(40))))
    return rows + [(5000, " ".join(SECRETS) * 300), (None, "password=abcdef"), (None, "password=abcdef"), (7, None)]


def brute_scan(rows):
    out = []
    for i, t in rows:
        spans = base_spans(t)
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        out.append((i, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_scan_equals_brute_force_and_sql(spark):
    rows = secret_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = rows_of(secrets.scan_digests(docs))
    assert sorted((r[:5] for r in got), key=repr) == brute_scan(rows)
    assert got == sql_rows(secrets.ORACLE, rows, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    assert rows_of(secrets.scan_digests(clashing(frame(spark, rows)))) == got


def test_scan_has_no_python_workers(spark):
    plan = secrets.scan_digests(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_models_find_random_strings_and_leave_identifiers(spark):
    rng = random.Random(2)
    words = "get set user name from request configuration file read write token stream handler context response build parse value index".split()
    plain = ["_".join(rng.choice(words) for _ in range(4)) for _ in range(3000)]
    plain += ["".join(rng.choice(words).title() for _ in range(4)) for _ in range(3000)]
    key = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(rng.choice([24, 32, 40]))) for _ in range(1000)]
    rows = [(i, " ".join(plain[6 * i:6 * i + 6])) for i in range(1000)] + [(1000 + i, f"see {k} there") for i, k in enumerate(key)]
    got = {r["doc_id"]: r["found"] for r in secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(any(s["kind"] == "markov" and s["start"] == 4 for s in got[1000 + i]) for i in range(1000))
    false = sum(len(got[i]) for i in range(1000))
    assert hit >= 950 and false <= 60, (hit, false)


def test_scan_of_nothing(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    assert secrets.scan_digests(docs).collect() == []
    assert rows_of(secrets.scan_digests(spark.createDataFrame([(1, None)], "doc_id long, text string"))) == [
        (1, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")]


def test_redacted(spark):
    rows = [(1, "my password=abcdef0123456789abcdef01 é x"), (2, "nothing"), (3, None), (4, "AKIA" + "Q7" * 9)]
    got = dict(rows_of(secrets.redacted(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert got == {1: "my [secret] é x", 2: "nothing", 3: None, 4: "[secret]"}


# ------------------------------------------------------------------ alignment

def library():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B), {s: i for i, s in enumerate(byte_symbols())}


def whole_text(libraries, text):
    """None, or (A ids, B ids, groups, links): both libraries over the whole text, all by decoded bytes."""
    a, b, back = libraries
    full = (" " + (text or "")).encode()
    one = a.encode(full.decode(), add_special_tokens=False)
    a_raw = [bytes(back[c] for c in t) for t in one.tokens]
    ids = b.encode(text or "")
    b_raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids for p in [b.id_to_piece(i)]]
    if not text or b"".join(a_raw) != full or b"".join(b_raw) != full:
        return None
    a_at, b_at = (np.cumsum([0, *map(len, raw)]).tolist() for raw in (a_raw, b_raw))
    cuts = sorted(set(a_at) & set(b_at))
    groups = [([one.ids[k] for k in range(len(a_raw)) if x < a_at[k + 1] <= y], [ids[k] for k in range(len(b_raw)) if x < b_at[k + 1] <= y])
              for x, y in zip(cuts, cuts[1:])] if len(full) < 3000 else None
    if groups is None:  # the same in one walk
        groups, i, j = [], 0, 0
        for y in cuts[1:]:
            k, m = a_at.index(y, i), b_at.index(y, j)
            groups.append((one.ids[i:k], ids[j:m]))
            i, j = k, m
    links, j = [], 0
    for i in range(len(a_raw)):
        while b_at[j + 1] <= a_at[i]:
            j += 1
        k = j
        while k < len(b_raw) and b_at[k] < a_at[i + 1]:
            links.append((one.ids[i], ids[k]))
            k += 1
    return one.ids, ids, groups, links


def brute_alignment(rows):
    libraries = library()
    found = [(i, whole_text(libraries, t)) for i, t in rows]
    held = Counter(p for _, f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append((i, len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(held[p] == best[p[0]] for p in f[3]),
                    sum(held[p] for p in f[3]), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


ODD = [" ", "  two  spaces ", "é", "中文 字 😀👩‍👩‍👧", "<|endoftext|> <s> </s>", "a▁b", "tab\t\tend ", "\x00\x01", "x y   z", "ñ \u0085 ñ", "é ​",
       "word " * 5, "\n\n \n", "'s 't don't", "﻿bom", "𝒳𝒴 é", "> é  é", "à à à"]


def test_alignment_equals_both_libraries(spark):
    rows = hard_rows(11) + [(3000 + i, t) for i, t in enumerate(ODD)] + [(None, "the same"), (None, "the same"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_alignment(rows)
    assert rows_of(alignment.alignment_counts(docs, A, B)) == want
    assert rows_of(alignment.alignment_counts(clashing(frame(spark, rows)), A, B)) == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\ta'sté1!<|>中▁\x1f\xa0 \u0085😀"), st.characters(codec="utf-8")), max_size=40), min_size=1))
def test_words_cut_apart_align_as_the_whole_text(texts):
    import pyarrow as pa

    from cohortkit.llm.common import utf8_buffer

    aligner, libraries = alignment.opened(A, B), library()
    words, n = alignment.cut_words(*utf8_buffer(pa.array(texts, pa.string()))[:2])
    stops = np.append(0, np.cumsum(n)).tolist()
    for text, a, b in zip(texts, stops, stops[1:]):
        known, want = aligner.words(words[a:b]), whole_text(libraries, text)
        if want is None:
            assert not known or any(k is alignment.BAD for k in known)
        else:
            assert "".join(k[5].decode() for k in known)[:-1] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want[2])


def test_alignment_spans(spark):
    rows = [(1, "héllo wörld 😀"), (2, None), (3, "a▁b"), (4, "")]
    got = {r["doc_id"]: r["groups"] for r in alignment.aligned_spans(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()}
    assert got[2] == got[3] == got[4] == []
    assert [g["start"] for g in got[1]] == [0, *[g["end"] for g in got[1]][:-1]] and got[1][-1]["end"] == len(" héllo wörld 😀".encode())
    found = whole_text(library(), rows[0][1])
    assert [(g["a"], g["b"]) for g in got[1]] == found[2]


def test_alignment_of_nothing(spark):
    assert alignment.alignment_counts(spark.createDataFrame([], DOCUMENTS), A, B).collect() == []
    assert rows_of(alignment.alignment_counts(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B)) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_small_pieces_and_a_full_word_table_change_nothing(monkeypatch):
    """Pieces by the byte, counted by hand: the pairs of all pieces add up to those of the rows."""
    import pyarrow as pa

    aligner = alignment.Aligner(A, B)
    monkeypatch.setattr(alignment, "KEPT_WORDS", 3)
    texts = [t for _, t in hard_rows(4)]
    held = Counter()
    for at in range(0, len(texts), 7):
        some = texts[at:at + 7]
        row = alignment.piece_row(at, pa.record_batch({"doc_id": pa.array(range(len(some)), pa.int64()), "text": pa.array(some, pa.string())}), aligner)
        keys, docs = np.frombuffer(row.column("keys")[0].as_py(), np.uint64), np.frombuffer(row.column("docs")[0].as_py(), "<u4")
        held.update({int(k): int(n) for k, n in zip(keys, docs) if n})
    libraries = library()
    want = Counter(a << 32 | b for t in texts for f in [whole_text(libraries, t)] if f for a, b in set(f[3]))
    assert held == want


# ------------------------------------------------------------------ spelling

def brute_words(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(rows):
    n = brute_words(rows)
    form, count = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        count[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], count[w], form[w], n.get(form[w]), root))
    return sorted(out, key=repr)


def variant_rows(seed=1):
    rng = random.Random(seed)
    stems = ["although", "ÉCole", "grüße", "letter", "aaaaaa", "colour", "weißer"]
    letters = "abcdefgß÷éÉ"
    rows = []
    for i in range(250):
        words = []
        for _ in range(30):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:], w.upper()])
            words.append(w)
        rows.append((rng.choice([i, i, None, 7]), " ".join(words)))
    long = "".join(rng.choice("abc") for _ in range(3000))
    rows += [(9000 + k, f"{long} {long[:70]} {long[:69]} {long[:1500]}x{long[1501:]}") for k in range(4)]
    return rows + [(1, None), (2, ""), (3, "ab")]


def test_spelling_groups_equal_brute_force_and_sql(spark):
    for rows in (variant_rows(), hard_rows(6)):
        want = brute_groups(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert rows_of(spelling.spelling_groups(docs)) == want
        assert rows_of(spelling.spelling_groups(clashing(frame(spark, rows)))) == want
        assert sql_rows(spelling.ORACLE, rows, ["word", "n", "n_near", "form", "form_n", "root"]) == want
    assert len({r[5] for r in brute_groups(variant_rows())}) > 3


def test_filters_of_any_size_give_the_same_pairs(spark, monkeypatch):
    """A filter cut down to some blocks lets nearly every edit through; the exact join gives the same pairs."""
    n = brute_words(variant_rows(3))
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    want = sorted((min(a, b), max(a, b)) for a in n for b in n if a < b and near(a, b))
    for size in (spelling.MAX_FILTER_BYTES, 200):
        monkeypatch.setattr(spelling, "MAX_FILTER_BYTES", size)
        got = sorted((min(r["word"], r["near"]), max(r["word"], r["near"])) for r in spelling.near_pairs(words).collect())
        assert got == want


def test_filter_rejects_most_edits_that_are_no_words():
    rng = random.Random(4)
    words = list({"".join(rng.choice(string.ascii_lowercase) for _ in range(8)) for _ in range(20_000)})
    filters = spelling.Filters({8: len(words)})
    bits = np.zeros(filters.size, np.uint64)

    def hashes(some):
        chars = np.concatenate([c for _, c in spelling.by_length(some)])
        return (spelling.values(chars) * spelling.powers(8)).sum(axis=1, dtype=np.uint64)

    block, mask = filters.place(8, hashes(words))
    np.bitwise_or.at(bits, block, mask)
    assert filters.holds(bits, 8, hashes(words)).all()
    others = list({"".join(rng.choice(string.ascii_uppercase) for _ in range(8)) for _ in range(20_000)})
    assert filters.holds(bits, 8, hashes(others)).mean() < 0.01


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "no word thrice here")]])
def test_spelling_of_nothing(spark, rows):
    assert spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []
