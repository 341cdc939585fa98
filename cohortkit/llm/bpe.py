"""Byte-level BPE by batched numpy merge rounds.

The symbols of many words lie in one flat array. In each round the keys of all adjacent pairs are
looked up by binary search in the sorted pair keys of the vocabulary, every word finds its lowest
rank, and all words merge their lowest-ranked pair at once (from left to right where occurrences
overlap). Words without a known pair are done and leave the array, so later rounds get shorter.

Words are cut by the vocabulary's own pattern. Characters from U+0250 on, whose Unicode class may
differ between library versions, are cut by the tokenizers library's byte-level pre-tokenizer.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm.chunks import ChunkTable
from cohortkit.llm.common import columns, read_table, text_batches, text_groups, utf8_buffer

NONE = np.int64(2**62)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free character from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


class MergeRounds:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.byte_id = np.array([vocab[s] for s in symbols], np.int64)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None
        self.size = max([*vocab.values(), *special.values()]) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.keys = key[order]
        self.rank = order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.wide = regex.compile(r"[^\x00-ɏ]")
        back = {s: b for b, s in enumerate(symbols)}
        raw: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            raw[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            raw[i] = token.encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        self._wide_cut = None

        self.byte_rank = self.ranks(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256))

    # ------------------------------------------------------------ encode

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search in the sorted pair keys."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word): the rounds described above, over all words at once."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        symbols = self.byte_id[raw]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        rank = np.full(len(symbols), NONE)  # of the pair that begins here
        rank[:-1] = self.byte_rank[raw[:-1] * 256 + raw[1:]]
        rank[:-1][word[1:] != word[:-1]] = NONE
        done_symbols, done_words = [symbols[:0]], [word[:0]]
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, starts)
            count = np.diff(np.append(starts, len(symbols)))
            if (least == NONE).any():
                over = np.repeat(least == NONE, count)
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                keep = ~over
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                count, least = count[least != NONE], least[least != NONE]
            row = np.flatnonzero(rank == np.repeat(least, count))
            # in a row of hits (a a a) every second one merges, counted from the row's start
            if len(row) > 1 and (row[1:] == row[:-1] + 1).any():
                begins = np.append(True, row[1:] != row[:-1] + 1)
                first = np.maximum.accumulate(np.where(begins, np.arange(len(row)), 0))
                row = row[(np.arange(len(row)) - first) % 2 == 0]
            symbols[row] = self.made[rank[row]]
            keep = np.ones(len(symbols), bool)
            keep[row + 1] = False
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            if len(row):  # only the pairs on either side of a merged symbol are new
                row -= np.arange(len(row))
                fresh = np.concatenate([row, row[row > 0] - 1])
                fresh = fresh[fresh < len(symbols) - 1]
                rank[row] = NONE
                rank[fresh] = np.where(word[fresh] == word[fresh + 1], self.ranks(symbols[fresh], symbols[fresh + 1]), NONE)
        out_symbols, out_words = np.concatenate(done_symbols), np.concatenate(done_words)
        return out_symbols[np.argsort(out_words, kind="stable")], np.bincount(out_words, minlength=len(words))

    def cut(self, text: str) -> list[str]:
        if not self.wide.search(text):
            return self.pattern.findall(text)
        if self._wide_cut is None:
            from tokenizers import pre_tokenizers

            self._wide_cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self._wide_cut.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; number of each). Equal words are merged once."""
        parts = [self._encode(texts[at:at + 100_000]) for at in range(0, len(texts), 100_000)]
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        plain = not self.wide.search(joined)
        special = self.cut_special is not None and self.cut_special.search(joined) is not None
        if plain and not special:
            cut = list(map(self.pattern.findall, texts))
        else:
            cut = [[w for part in (self.cut_special.split(t) if special else [t])
                    for w in ((part,) if part in self.special else self.cut(part))] for t in texts]
        words = list({w for parts in cut for w in parts})
        place = dict(zip(words, range(len(words))))
        ids, counts = [], []
        for at in range(0, len(words), 16_000):
            some, n = self.merge([b"" if w in self.special else w.encode() for w in words[at:at + 16_000]])
            ids.append(some)
            counts.append(n)
        for token, i in self.special.items():
            if token in place:
                ids.append(np.array([i]))
                counts.append(np.array([1]))
                place[token] = len(words)
                words.append(token)
        flat = np.concatenate([*ids, np.zeros(0, np.int64)])
        count = np.concatenate([*counts, np.zeros(0, np.int64)])
        begin = np.cumsum(count) - count
        used = np.fromiter((place[w] for parts in cut for w in parts), np.int64)
        n = count[used]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        stream = flat[np.arange(total) + np.repeat(begin[used] - (ends - n), n)]
        last = np.append(0, ends)[np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))]
        return stream, np.diff(last, prepend=0)

    # ------------------------------------------------------------ decode

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The texts' UTF-8 bytes; bytes that are no UTF-8 become the replacement character, as in the library."""
        begin, length = self.raw_at[ids], np.diff(self.raw_at)[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.raw[np.arange(total) + np.repeat(begin - (ends - length), length)].tobytes()
        cuts = np.append(0, np.append(0, ends)[np.cumsum(count)]).tolist()
        out = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        for i, text in enumerate(out):
            try:
                text.decode()
            except UnicodeDecodeError:
                out[i] = text.decode("utf-8", "replace").encode()
        return out


_OPEN: dict[str, tuple[MergeRounds, ChunkTable]] = {}


def opened(path: str) -> tuple[MergeRounds, ChunkTable]:
    """The vocabulary and the chunk table of this worker."""
    if path not in _OPEN:
        rounds = MergeRounds(path)
        _OPEN[path] = rounds, ChunkTable(rounds.encode)
    return _OPEN[path]


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def encode_decode(docs: DataFrame, vocabulary: str, digests: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    With ``digests``: doc_id, n_tokens, ids_sha256, decoded_sha256. Without: doc_id, n_tokens, ids (little-endian
    unsigned 32-bit), decoded (UTF-8). A null text is empty: no tokens, empty result. Repeated rows and ids stay,
    each with its own row; an empty table gives an empty result. ``vocabulary`` is a byte-level BPE file of the
    tokenizers library, readable on every worker; its special tokens are matched in the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds, table = opened(vocabulary)
        for batch in text_groups(batches, 2 << 20):
            flat, count = table.texts(*utf8_buffer(batch.column("text"))[:2])
            back = rounds.decode(flat, count)
            raw, cuts = flat.astype("<u4").tobytes(), np.append(0, np.cumsum(4 * count)).tolist()
            ids = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            n = pa.array(count, pa.int64())
            if digests:
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), n, pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield columns(SCHEMA, doc_id=batch.column("doc_id"), n_tokens=n, ids=ids, decoded=back)

    text_batches(docs.sparkSession)
    made = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded binary"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, {made}")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), vocabulary_path())
