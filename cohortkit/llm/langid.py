"""Language identification with interpolated Kneser-Ney character models, one per language.

Texts are folded to lower-case letters with single spaces between; a model of order four gives each
character's probability after the three before it. The models of all languages share sorted arrays
of n-gram hashes with one column of log-probabilities per language, so a character costs one binary
search, and a further one per order only where no language has seen the n-gram. The language with
the lowest cross-entropy per character wins; a text whose cross-entropy is far above what held-apart
texts of that language have is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import mix64, read_table, text_batches, text_groups, utf8_buffer

ORDER = 4
SPACE, START = 32, 1
_LETTER = regex.compile(r"\p{L}")
_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point -> 16-bit symbol: the lower-case letter, or a space for all that is no letter."""
    if not _FOLD:
        table = np.full(0x110000, SPACE, np.uint16)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = min(ord(low) if len(low) == 1 else c, 0xFFFF)
        _FOLD.append(table)
    return _FOLD[0]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed four-grams, first one of each text): one gram per folded character, the text's start padded."""
    data = data[offsets[0]:offsets[-1]]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets - offsets[0]]
    symbols = fold_table()[points]
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    space = symbols == SPACE
    first = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)
    keep = ~space | ~(np.append(False, space[:-1]) | first)[:len(space)]  # no space at the start or after a space
    symbols, text = symbols[keep], text[keep]
    count = np.bincount(text, minlength=len(at) - 1)
    starts = np.concatenate([[0], np.cumsum(count)])
    padded = np.full(len(symbols) + (ORDER - 1) * len(count), START, np.uint64)
    place = np.arange(len(symbols)) + (ORDER - 1) * (text + 1)
    padded[place] = symbols
    key = np.zeros(len(symbols), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        key = key << np.uint64(16) | padded[place - back]
    return key, starts


def hashed(keys: np.ndarray, order: int) -> np.ndarray:
    return mix64(keys ^ np.uint64(order * 0x9E3779B97F4A7C15 & (2**64 - 1)))


def _mask(order: int) -> np.uint64:
    return np.uint64(2 ** (16 * order) - 1)


@dataclass
class CharModels:
    """Sorted hash arrays by order, with one column per language; at most one entry per gram of the sample."""

    langs: list[str]
    keys: dict[int, np.ndarray]
    logp: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    backoff: dict[int, np.ndarray]
    unknown: np.ndarray
    limit: np.ndarray | None = None  # mean and spread of the cross-entropy of held-apart texts, by language

    @classmethod
    def fit(cls, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> CharModels:
        """``counts``: language -> (packed four-grams, distinct and sorted; how often)."""
        langs = sorted(counts)
        by_lang: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for lang in langs:
            level = {ORDER: (counts[lang][0].astype(np.uint64), counts[lang][1].astype(np.float64))}
            for o in range(ORDER - 1, 0, -1):  # below the top order a gram counts by how many symbols it follows
                k, c = np.unique(level[o + 1][0] & _mask(o), return_counts=True)
                level[o] = k, c.astype(np.float64)
            by_lang.append(level)
        packed = {o: np.unique(np.concatenate([x[o][0] for x in by_lang])) for o in range(1, ORDER + 1)}
        above = {o: np.unique(packed[o] >> np.uint64(16)) for o in range(2, ORDER + 1)}
        logp, backoff = {}, {o: np.zeros((len(above[o]), len(langs))) for o in above}
        prob: dict[int, np.ndarray] = {}
        size = len(packed[1]) + 1
        unknown = np.zeros(len(langs))
        for o in range(1, ORDER + 1):
            prob[o] = np.zeros((len(packed[o]), len(langs)))
            for i, level in enumerate(by_lang):
                key, count = level[o]
                once, twice = (count == 1).sum(), (count == 2).sum()
                discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
                at = np.searchsorted(packed[o], key)
                if o == 1:
                    total = count.sum()
                    rest = discount * len(key) / total
                    unknown[i] = rest / size
                    prob[o][:, i] = unknown[i]
                    prob[o][at, i] += (count - discount) / total
                    continue
                context = np.searchsorted(above[o], key >> np.uint64(16))
                total = np.bincount(context, count, len(above[o]))
                kinds = np.bincount(context, minlength=len(above[o]))
                with np.errstate(invalid="ignore", divide="ignore"):
                    rest = np.where(total > 0, discount * kinds / total, 1.0)
                lower = prob[o - 1][np.searchsorted(packed[o - 1], packed[o] & _mask(o - 1)), i]
                prob[o][:, i] = rest[np.searchsorted(above[o], packed[o] >> np.uint64(16))] * lower
                prob[o][at, i] += (count - discount) / total[context]
                backoff[o][:, i] = np.log(rest)
        keys, contexts = {}, {}
        for o in packed:
            h = hashed(packed[o], o)
            order = np.argsort(h)
            keys[o], logp[o] = h[order], np.log(prob[o])[order].astype(np.float32)
        for o in above:
            h = hashed(above[o], 16 + o)
            order = np.argsort(h)
            contexts[o], backoff[o] = h[order], backoff[o][order].astype(np.float32)
        return cls(langs, keys, logp, contexts, backoff, np.log(unknown).astype(np.float32))

    @staticmethod
    def _find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(sorted_hashes, hashes)
        at[at == len(sorted_hashes)] = 0
        return at, sorted_hashes[at] == hashes

    def log_probabilities(self, key: np.ndarray) -> np.ndarray:
        """Natural log-probability of each gram's last symbol, one column per language."""
        out = np.zeros((len(key), len(self.langs)), np.float32)
        left = np.arange(len(key))
        for o in range(ORDER, 0, -1):
            mine = key[left] & _mask(o) if o < ORDER else key
            at, found = self._find(self.keys[o], hashed(mine, o))
            out[left[found]] += self.logp[o][at[found]]
            left, mine = left[~found], mine[~found]
            if not len(left):
                return out
            if o > 1:
                at, found = self._find(self.contexts[o], hashed(mine >> np.uint64(16), 16 + o))
                out[left[found]] += self.backoff[o][at[found]]
        out[left] += self.unknown
        return out

    def cross_entropies(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nats of each text under each language, number of folded characters of each text)."""
        key, starts = grams(data, offsets)
        nats = np.zeros((len(offsets) - 1, len(self.langs)))
        filled = np.flatnonzero(np.diff(starts))
        if len(filled):
            nats[filled] = -np.add.reduceat(self.log_probabilities(key).astype(np.float64), starts[filled], axis=0)
        return nats, np.diff(starts)


GRAM_SQL = "lang string, gram long, n long"


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over labelled texts, combined within each task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches, 2 << 20):
            langs = np.array(batch.column("lang").to_pylist(), object)
            data, offsets, _ = utf8_buffer(batch.column("text"))
            key, starts = grams(data, offsets)
            owner = np.repeat(np.arange(len(langs)), np.diff(starts))
            for lang in sorted(set(langs)):
                gram, n = np.unique(key[(langs == lang)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram)), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"])

    return docs.select("lang", "text").mapInArrow(run, GRAM_SQL).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, docs_per_lang: int = 1000) -> CharModels | None:
    """Models from labelled texts (doc_id, text, lang), or None if there are none.

    The fit reads a bounded sample: about ``docs_per_lang`` texts of each language, chosen by a hash of doc_id, and
    as many others for the calibration of the rejection. A language with fewer texts than both need is halved, the
    larger half for the fit; without a text apart it has no limit. Only the sample's gram counts reach the driver.
    """
    spark = train.sparkSession
    text_batches(spark)
    known = train.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    totals = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(share, 0.5).alias("half")).collect()
    if not totals:
        return None
    # texts below the first number are fitted, those from the second on are apart
    cut = {r["lang"]: (r["half"] + 1, r["half"] + 1) for r in totals if r["n"] < 2 * docs_per_lang}
    for lang, n in ((r["lang"], r["n"]) for r in totals if r["lang"] not in cut):
        some = -(-(docs_per_lang << 20) // n)
        cut[lang] = some, (1 << 20) - some
    below, above = (F.coalesce(*[F.when(F.col("lang") == lang, c[j]) for lang, c in sorted(cut.items())]) for j in (0, 1))
    rows = count_grams(known.where(share < below)).toPandas()
    if not len(rows):
        return None
    counts = {lang: (np.sort(p["gram"].to_numpy().view(np.uint64)),
                     p["n"].to_numpy()[np.argsort(p["gram"].to_numpy().view(np.uint64))])
              for lang, p in rows.groupby("lang")}
    models = CharModels.fit(counts)
    apart = predict(known.where(share >= above), spark.sparkContext.broadcast(models), extra="lang")
    stats = {r["lang"]: (r["m"], r["s"]) for r in apart.where("n_chars >= 100 and lang_pred = lang").groupBy("lang").agg(
        F.avg("nats_per_char").alias("m"), F.coalesce(F.stddev("nats_per_char"), F.lit(0.0)).alias("s")).collect()}
    models.limit = np.array([stats.get(lang, (np.inf, 0.0)) for lang in models.langs])
    return models


#: A text is rejected when its cross-entropy is this many nats plus this many spreads above its language's mean;
#: short texts get the slack of their own sampling noise on top.
SLACK_NATS, SLACK_SPREADS, SHORT_NATS = 1.0, 4.0, 12.0

PREDICTED_SQL = ("doc_id long, lang_pred string, score double, n_chars long, nats_per_char double, rejected boolean")


def predict(docs: DataFrame, models, extra: str | None = None, rest: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, n_chars, nats_per_char, rejected (and the column ``extra``), one row per row.

    With ``rest`` the row comes along, its text in a column ``text`` and all else in a struct column ``rest``, so that no
    name can clash and the text travels once.

    ``models`` is a broadcast CharModels (None inside: nothing was learned, every text is ``und``). A null text or
    one without a letter is ``und`` with score 0 and is rejected; ties go to the first language by name. ``score``
    is the best language's share of the likelihood. Only the text is read.
    """
    names = ["doc_id", "text"] + ([extra] if extra else [])
    if rest:
        extra = "rest"
        names.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = models.value
        for batch in text_groups(batches, 1 << 20):
            texts = batch.column("text").to_pylist()
            has = np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)
            if model is None:
                has[:] = False
            data, offsets, _ = utf8_buffer(batch.column("text"))
            if model is not None and has.any():
                nats, n = model.cross_entropies(data, offsets)
                best = nats.argmin(axis=1)
                low = nats[np.arange(len(best)), best]
                score = np.clip(1.0 / np.exp(np.maximum(-700.0, low[:, None] - nats)).sum(axis=1), 0.0, 1.0)
                per = low / np.maximum(n, 1)
                gone = ~has
                if model.limit is not None:
                    mean, spread = model.limit[best].T
                    gone |= per > mean + SLACK_NATS + SLACK_SPREADS * spread + SHORT_NATS / np.maximum(n, 1)
                lang = [model.langs[b] if h else "und" for b, h in zip(best, has)]
            else:
                n, per, score, gone = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts)), ~has
                lang = ["und"] * len(texts)
            arrays = [batch.column("doc_id"), pa.array(lang), pa.array(np.where(has, score, 0.0)),
                      pa.array(n.astype(np.int64)), pa.array(per), pa.array(gone)]
            out = ["doc_id", "lang_pred", "score", "n_chars", "nats_per_char", "rejected"]
            if extra:
                arrays.append(batch.column(extra))
                out.append(extra)
            if rest:
                arrays.append(batch.column("text"))
                out.append("text")
            yield pa.RecordBatch.from_arrays(arrays, names=out)

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *names[1:])
    made = T.StructType.fromDDL(PREDICTED_SQL)
    if extra:
        made = made.add(asked.schema[extra])
    return asked.mapInArrow(run, made.add("text", "string") if rest else made)


def fold_of(remainders: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(remainders))


def identify(docs: DataFrame, train: DataFrame, docs_per_lang: int = 1000, rest: bool = False) -> DataFrame:
    """``predict`` of all ``docs`` with models fitted on ``train``."""
    models = fit(train, docs_per_lang)
    return predict(docs, docs.sparkSession.sparkContext.broadcast(models), rest=rest)


def op10_kneser_ney_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of null doc_id belong to no fold: they are predicted, not held out and not learned from."""
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs, docs.where(fold_of(4) != 2))
    return found.select("doc_id", F.coalesce(fold_of(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
                        "n_chars", "nats_per_char", "rejected")
