"""Cross-tokenizer alignment by token spans.

Each text, with a space put before it, is cut by two tokenizers: A, a byte-level BPE file of the tokenizers library, and
B, a sentencepiece model. A's character offsets and the spans of B's protos are coarse cuts. Where they don't give a
token's bytes (several tokens inside one multibyte character, byte-fallback tokens, the space that B adds itself), the
decoded bytes of the tokens refine them. Places where both tokenizers end a token cut the text into groups; every A
token is linked with every B token whose bytes it shares.

Neither tokenizer has a token that goes on over the front of a single space or line end, or from an ASCII letter to a full
stop or comma (A by its pattern; B's pieces are looked through when it is opened). Each of those places therefore ends a
group, and the words between them are aligned once per worker and kept in a table of bounded size.

How many documents hold a pair of ids linked is counted by an exchange: pieces of some MB of text ask hash buckets
of pairs about the pairs they hold, and get the totals of the whole corpus back. The pieces are cut by bytes and belong
to no key, so neither a frequent doc_id nor a group of copies makes one of them large.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.bpe import byte_symbols, vocabulary_path
from cohortkit.llm.chunks import spaces_before_spaces
from cohortkit.llm.common import (
    ASK_SQL, Scratch, answered, answers, ask_rows, deal, mix64, read_table, shuffle_partitions, text_groups, unpack,
    utf8_buffer,
)

PIECE_BYTES = 3 << 20  # text in one piece; a longer text is a piece of its own
TOGETHER = 2_000  # words handed to the tokenizers at a time
#: Words that can stand one after the other: one space or line end, no white space at either end, nothing that B reads as a space.
PLAIN = re.compile(rb"[ \n](?![\x80-\xbf]|[\x09-\x0d\x1c-\x20])(?!\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80|\xe2\x81|\xe3\x80)(?!.*\xe2\x96\x81)"
                   rb".*(?<![\x09-\x0d\x1c-\x20])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2[\x80\x81].)(?<!\xe3\x80.)\Z", re.DOTALL)
FILLER = b" a"  # a word with nothing special, put before words that can't begin a text
KEPT_WORDS = 200_000  # words in each of the two generations of a worker's table
PIECES = 1 << 11  # pieces of one input partition, at most
#: A pair of ids in one number: A's id, then B's.
SHIFT = np.uint64(32)

_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[44, 46]] = True


def refine(begins: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the coarse span where it begins behind the token before and holds as many bytes, else those bytes."""
    own = np.cumsum(lengths)
    return np.where((begins == own - lengths) & (ends - begins == lengths), ends, own)


#: What is kept of a word: numbers of A tokens, B tokens, groups and links, the links, the groups as text.
Word = tuple[int, int, int, int, bytes, bytes]
#: A word whose tokens don't give its bytes back.
BAD: Word = (0, 0, 0, 0, b"", b"")


class Bytes:
    """The bytes of each id of a vocabulary."""

    def __init__(self, raw: list[bytes]):
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(raw), np.uint8)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        ends = np.cumsum(n)
        return self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.begin[ids] - (ends - n), n)]


class Aligner:
    """Both tokenizers on one worker, and the table of words seen there."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        back = {s: i for i, s in enumerate(byte_symbols())}
        raw: list[bytes] = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in back for c in token):
                raw[i] = bytes(back[c] for c in token)
        self.a_raw = Bytes(raw)
        self.b = SentencePieceProcessor(model_file=b_path)
        self.b_raw = Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))])
        cut = re.compile(r"[A-Za-z][.,]|.\n|\n.|[^▁]▁", re.DOTALL)
        if wrong := [p for p in map(self.b.id_to_piece, range(self.b.get_piece_size())) if cut.search(p)]:
            raise ValueError(f"{b_path} has tokens over the places where words are cut, such as {wrong[0]!r}")
        # each id as it is written inside a group and at its end
        self.said = [b"%d%s" % (i, mark) for raw, inner, last in ((self.a_raw, b",", b"|"), (self.b_raw, b",", b";"))
                     for mark in (inner, last) for i in range(len(raw.length))]
        self.new: dict[bytes, Word] = {}
        self.old: dict[bytes, Word] = {}

    def tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(A ids, their byte ends, B ids, their byte ends) of words one after the other; None if the bytes differ."""
        raw = b"".join(words)
        text, data = raw.decode(), np.frombuffer(raw, np.uint8)
        one = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], return_type="proto", num_threads=1).pieces
        a = np.array(one.ids, np.int64)
        b = np.array([p.id for p in pieces], np.int64)
        if not (np.array_equal(self.a_raw(a), data) and np.array_equal(self.b_raw(b), data)):
            return None
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # byte of each character
        spans = at[np.array(one.offsets, np.int64).reshape(-1, 2)]
        a_ends = refine(spans[:, 0], spans[:, 1], self.a_raw.length[a])
        ends = np.array([p.end for p in pieces], np.int64) + 1  # the space that B adds stands in the words
        return a, a_ends, b, refine(np.append(0, ends[:-1]), ends, self.b_raw.length[b])

    def align(self, words: list[bytes]) -> list[Word]:
        """All words at once where they can stand one after the other, otherwise one by one.

        The ends of the tokens of both, taken together, give the links; the ends that both have give the groups.
        """
        found = self.tokens(words)
        if found is None:
            return [BAD] * len(words) if len(words) - (words[0] == FILLER) <= 1 else [x for w in words for x in self.align_one(w)]
        a, a_ends, b, b_ends = found
        every = np.union1d(a_ends, b_ends)
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        pairs = a[np.searchsorted(a_ends, every)].astype(np.uint64) << SHIFT | b[np.searchsorted(b_ends, every)].astype(np.uint64)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n, m = len(self.a_raw.length), len(self.b_raw.length)
        marks = np.concatenate([a + n * (cuts[a_group] == a_ends), 2 * n + b + m * (cuts[b_group] == b_ends)])
        marks = marks[np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")]
        said = list(map(self.said.__getitem__, marks.tolist()))
        of_a, of_b, of_cuts, of_links = (np.searchsorted(x, stops, side="right") for x in (a_ends, b_ends, cuts, every))
        numbers = np.diff(np.stack([of_a, of_b, of_cuts, of_links]), axis=1, prepend=0).T.tolist()
        raw, links, tokens = pairs.tobytes(), [0, *(8 * of_links).tolist()], [0, *(of_a + of_b).tolist()]
        return [(*four, raw[links[k]:links[k + 1]], b"".join(said[tokens[k]:tokens[k + 1]])) for k, four in enumerate(numbers)]

    def align_one(self, word: bytes) -> list[Word]:
        return self.align([word]) if word.startswith(b" ") else self.align([FILLER, word])[1:]

    def words(self, listed: Iterable[bytes]) -> list[Word]:
        """What is known of the words, which are distinct. Words not asked for in two generations leave the table."""
        listed = list(listed)
        out: list[Word | None] = []
        for w in listed:
            known = self.new.get(w)
            if known is None:
                known = self.old.get(w)
                if known is not None:
                    self.new[w] = known
            out.append(known)
        missing = [k for k, x in enumerate(out) if x is None]
        plain = [bool(PLAIN.match(listed[k])) for k in missing]
        together = [k for k, p in zip(missing, plain) if p]
        made = []
        for at in range(0, len(together), TOGETHER):
            some = together[at:at + TOGETHER]
            made += zip(some, self.align([FILLER, *(listed[k] for k in some)])[1:])
        made += [(k, self.align_one(listed[k])[0]) for k, p in zip(missing, plain) if not p]
        for k, x in made:
            out[k] = x
            if len(listed[k]) <= 64:
                self.new[listed[k]] = x
        if len(self.new) > KEPT_WORDS:
            self.old, self.new = self.new, {}
        return out


_OPEN: dict[tuple[str, str], Aligner] = {}


def opened(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _OPEN:
        _OPEN[a_path, b_path] = Aligner(a_path, b_path)
    return _OPEN[a_path, b_path]


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(the words of all texts with what stands before them, number of words of each text); none of an empty text.

    A cut is the front of a space or line end that has no white space on either side, and the place between an ASCII
    letter and a full stop or comma. A byte that may end a white-space character of several bytes counts as one.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    filled = lengths > 0
    base = offsets[:-1] - offsets[0] + np.arange(n)  # of each text, once a space stands before every text
    full = np.insert(data[offsets[0]:offsets[-1]], (offsets[:-1] - offsets[0]), 32) if n else np.zeros(0, np.uint8)
    begins = np.zeros(len(full) + 1, bool)
    begins[base] = True
    at = np.flatnonzero((full == 32) | (full == 10))
    before, two = full[np.maximum(at - 1, 0)], full[np.maximum(at - 2, 0)]
    white = _WHITE[before] | (((before >= 0x80) & (before <= 0xAF)) & np.isin(two, [0xC2, 0x80, 0x81, 0x9A]))
    last = begins[np.minimum(at + 1, len(full))] | (at + 1 >= len(full))
    cut = at[~white & ~last & ~begins[at] & ~spaces_before_spaces(full, at)] if len(at) else at
    stop = np.flatnonzero(_LETTER[full[:-1]] & _STOP[full[1:]]) + 1
    starts = np.sort(np.concatenate([base[filled], cut, stop]))
    owner = np.searchsorted(base, starts, side="right") - 1
    ends = np.append(starts[1:], 0)
    stop = base + 1 + lengths
    final = np.append(owner[1:] != owner[:-1], True) if len(starts) else np.zeros(0, bool)
    ends[final] = stop[owner[final]]
    raw = full.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())], np.bincount(owner, minlength=n)


PIECE_SQL = ("piece int, doc_ids array<bigint>, totals binary, shas binary, n_slots binary, slots binary, times binary, "
             "slot_links binary, links binary, keys binary, docs binary")


def piece_row(piece: int, batch: pa.RecordBatch, aligner: Aligner) -> pa.RecordBatch:
    """One piece of texts as a row: totals and digest of each text, its distinct words, the words' links, the pairs held."""
    words, n_words = cut_words(*utf8_buffer(batch.column("text"))[:2])
    table: dict[bytes, int] = defaultdict(count().__next__)
    slot = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
    known = aligner.words(table)
    numbers = np.array([k[:4] for k in known], np.int64).reshape(-1, 4)
    owner = np.repeat(np.arange(batch.num_rows), n_words)
    broken = np.zeros(batch.num_rows, bool)
    broken[owner[numbers[slot, 0] == 0]] = True
    stops = np.append(0, np.cumsum(n_words)).tolist()
    said = [k[5] for k in known]
    listed = slot.tolist()
    shas = [bytes(32) if broken[i] or a == b else hashlib.sha256(b"".join([said[s] for s in listed[a:b]])[:-1]).digest()
            for i, (a, b) in enumerate(zip(stops, stops[1:]))]
    good = ~broken[owner]
    owner, slot = owner[good], slot[good]
    totals = np.stack([np.bincount(owner, numbers[slot, c], batch.num_rows).astype(np.int64) for c in range(4)])

    held, times = np.unique(owner << 32 | slot, return_counts=True)
    of, own = held >> 32, held & 0xFFFFFFFF
    pairs = np.frombuffer(b"".join(k[4] for k in known), np.uint64)
    links = numbers[:, 3]
    begin = np.cumsum(links) - links
    # the pairs that some unbroken text holds, and how many texts hold each
    n = links[own]
    stop = np.cumsum(n)
    flat = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(begin[own] - (stop - n), n)
    keys, number = np.unique(pairs, return_inverse=True)
    both = np.unique(np.repeat(of, n) << 32 | number[flat])
    docs = np.bincount(both & 0xFFFFFFFF, minlength=len(keys))
    return pa.record_batch({
        "piece": pa.array([piece], pa.int32()), "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
        **{name: pa.array([raw], pa.binary()) for name, raw in {
            "totals": totals.tobytes(), "shas": b"".join(shas),
            "n_slots": np.bincount(of, minlength=batch.num_rows).astype("<u4").tobytes(), "slots": own.astype("<u4").tobytes(),
            "times": times.astype("<u4").tobytes(), "slot_links": links.astype("<u4").tobytes(),
            "links": number.astype("<u4").tobytes(), "keys": keys.tobytes(), "docs": docs.astype("<u4").tobytes()}.items()}})


def pieces(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, at = opened(a_path, b_path), TaskContext.get().partitionId() * PIECES
        for k, batch in enumerate(text_groups(batches, PIECE_BYTES)):
            if k == PIECES:
                raise ValueError(f"an input partition has over {PIECES * PIECE_BYTES >> 30} GB of text; read smaller splits")
            yield piece_row(at + k, batch, aligner)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, PIECE_SQL)


def asked(table: DataFrame, n_buckets: int) -> DataFrame:
    """What each piece asks: its pairs, by hash buckets, with the number of its texts that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, keys, docs in zip(*(batch.column(c).to_pylist() for c in ("piece", "keys", "docs"))):
                keys, docs = np.frombuffer(keys, np.uint64), np.frombuffer(docs, "<u4")
                yield from ask_rows(piece, *deal(mix64(keys), n_buckets), keys, docs).to_batches()

    return table.select("piece", "keys", "docs").mapInArrow(run, ASK_SQL)


def summed(rows: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(pairs, documents that hold each, place of every asked pair among them, number of pairs of each row)."""
    parts = [unpack(data, np.uint64, "<u4") for _, data in rows]
    keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
    return keys, n, place, [len(p[0]) for p in parts]


def totals(rows: list[tuple[int, bytes]]) -> list[bytes]:
    _, n, place, lengths = summed(rows)
    return [x.tobytes() for x in np.split(n[place], np.cumsum(lengths)[:-1])]


def most(asks: DataFrame, n_buckets: int) -> np.ndarray:
    """The highest count of each A id: at most one number for each id of A's vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for r in batches:
            for bucket, data in zip(r.column("bucket").to_pylist(), r.column("data").to_pylist()):
                rows[bucket].append((0, data))
        for bucket in sorted(rows):
            keys, n, _, _ = summed(rows.pop(bucket))
            a = (keys >> SHIFT).astype(np.int64)
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            yield pa.record_batch({"a": pa.array(a[first], pa.int32()), "n": pa.array(np.maximum.reduceat(n, first), pa.int64())})

    best = asks.repartitionById(n_buckets, F.col("bucket")).mapInArrow(run, "a int, n long").groupBy("a").agg(F.max("n").alias("n")).collect()
    out = np.zeros(max((r["a"] for r in best), default=0) + 1, np.int64)
    for r in best:
        out[r["a"]] = r["n"]
    return out


RESULT_SQL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): n_a and n_b tokens, n_groups, n_links, n_best
    (links of the highest count of their A id, ties included), count_sum (sum of the links' counts) and groups_sha256.

    A link's count is the number of rows whose text holds its pair of ids linked. Texts that are null or empty, and texts
    whose A or B bytes differ from the space and the text (such as those with U+2581, which B reads as a space), have no
    tokens: zeros and an empty string, and they count nowhere. Repeated rows and ids, and null ids, each are a document
    and keep their row; an empty table gives an empty result. Very long texts are aligned as one piece. Columns of the
    names used inside don't clash, as only doc_id and text are read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    n_buckets = shuffle_partitions(spark)
    table = scratch.write(pieces(docs, a_path, b_path), "pieces", compression="zstd")
    asks = asked(table, n_buckets)
    best = spark.sparkContext.broadcast(most(asks, n_buckets))

    def join(key, own: pa.Table, replies: pa.Table) -> pa.Table:
        row = {c: own.column(c)[0].as_py() for c in own.column_names}
        keys = np.frombuffer(row["keys"], np.uint64)
        order, bounds = deal(mix64(keys), n_buckets)
        said, _ = answered(replies)
        n = np.zeros(len(keys), np.int64)
        for bucket, data in said.items():
            n[order[bounds[bucket]:bounds[bucket + 1]]] = np.frombuffer(data, np.int64)
        highest = n == best.value[np.minimum((keys >> SHIFT).astype(np.int64), len(best.value) - 1)]
        links, of_slot = np.frombuffer(row["links"], "<u4"), np.frombuffer(row["slot_links"], "<u4")
        ends = np.append(0, np.cumsum(of_slot, dtype=np.int64))
        slots, times = np.frombuffer(row["slots"], "<u4"), np.frombuffer(row["times"], "<u4").astype(np.int64)
        n_slots = np.append(0, np.cumsum(np.frombuffer(row["n_slots"], "<u4"), dtype=np.int64))
        sums = []
        for values in (highest, n):
            up = np.append(0, np.cumsum(values[links], dtype=np.int64))
            of_texts = np.append(0, np.cumsum((up[ends[1:]] - up[ends[:-1]])[slots] * times))
            sums.append(of_texts[n_slots[1:]] - of_texts[n_slots[:-1]])
        four = np.frombuffer(row["totals"], np.int64).reshape(4, -1)
        shas = [row["shas"][32 * i:32 * i + 32].hex() if four[0, i] else "" for i in range(four.shape[1])]
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "n_a": four[0], "n_b": four[1], "n_groups": four[2],
                         "n_links": four[3], "n_best": sums[0], "count_sum": sums[1], "groups_sha256": pa.array(shas, pa.string())})

    replies = answers(asks, n_buckets, totals)
    return table.groupBy("piece").cogroup(replies.groupBy("batch")).applyInArrow(join, RESULT_SQL)


def aligned_spans(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id and the groups, each with its byte range in the space and the text, its A ids and B ids.

    Null and empty texts, and texts that either tokenizer doesn't give back, have no groups.
    """
    kind = "doc_id long, groups array<struct<start:bigint,end:bigint,a:array<int>,b:array<int>>>"
    made = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def groups(aligner: Aligner, words: list[bytes]) -> list[dict]:
        found = aligner.tokens(words) if words else None
        if found is None:
            return []
        a, a_ends, b, b_ends = found
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        i, j = ([0, *(np.searchsorted(x, cuts) + 1).tolist()] for x in (a_ends, b_ends))
        begin, ends, a, b = [0, *cuts.tolist()], cuts.tolist(), a.tolist(), b.tolist()
        return [{"start": begin[k], "end": e, "a": a[i[k]:i[k + 1]], "b": b[j[k]:j[k + 1]]} for k, e in enumerate(ends)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = opened(a_path, b_path)
        for batch in text_groups(batches, 1 << 20):
            words, n_words = cut_words(*utf8_buffer(batch.column("text"))[:2])
            stops = np.append(0, np.cumsum(n_words)).tolist()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "groups": pa.array(
                [groups(aligner, words[a:b]) for a, b in zip(stops, stops[1:])], made)})

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, kind)


def sentencepiece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(read_table(spark, sf_dir, "documents"), vocabulary_path(), sentencepiece_path())
