"""Quality rules by distribution divergence: DataFrame functions only.

Two histograms of each text, of character classes and of common words, are compared to the references
of the languages by the Jensen-Shannon distance (the square root of the divergence in bits, 0 to 1). A
text is kept if it is near to some language in both. A histogram counts only from a least length on.
The languages are those that the documents name; the common words of each are its most frequent ones,
counted over all documents of it, and its references are sums over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import Scratch, read_table

#: How many common words a language has, and how many words its documents must have in all for it to be a reference.
COMMON_WORDS, LEAST_WORDS = 8, 1000
#: A common word holds a letter of ASCII or a character beyond ASCII.
WORDLIKE = "[A-Za-z]|[^\\x00-\\x7F]"
SYMBOLS = "[#*$%&|<>]"
#: white space, symbols, digits, capitals, punctuation, bytes beyond ASCII, all else
CLASSES = 7
MIN_CHARS, MIN_WORDS = 200, 100
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.20, 0.55

SPACES = r"' \t\n\u000B\u000C\r'"
CUT = r"'[\\x20\\x09-\\x0D]+'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeat_words() -> str:
    """Words that lie in three-word windows found twice or more, from column ``words``.

    The hashes of all windows are sorted to find those that occur again. Their places are then looked up,
    in a short list of hashes directly, in a long one by sorting hashes with places.
    """
    hashes = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
    again = let("sort_array(h)", "s", "array_distinct(filter(s, (x, j) -> j > 0 and x = s[j - 1]))")
    few = "filter(transform(h, (x, i) -> if(array_contains(d, x), i, -1)), i -> i >= 0)"
    many = let("sort_array(transform(h, (x, i) -> struct(x, i)))", "p",
               "sort_array(transform(filter(p, (q, j) -> (j > 0 and p[j - 1].x = q.x) or "
               "(j < size(p) - 1 and p[j + 1].x = q.x)), q -> q.i))")
    covered = let(f"if(size(d) <= 64, {few}, {many})", "at",
                  "aggregate(transform(at, (v, k) -> least(3, if(k < size(at) - 1, at[k + 1], v + 3) - v)), 0, (a, b) -> a + b)")
    counted = let(hashes, "h", let(again, "d", f"if(size(d) = 0, 0, {covered})"))
    return f"cast(if(size(words) < 3, 0, {counted}) as long)"


def worded(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text (a null one empty) and its words."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("bare", F.expr(f"trim(BOTH {SPACES} FROM text)"))
    return t.withColumn("words", F.expr(f"if(bare = '', array(), split(bare, {CUT}))"))


def common_words(docs: DataFrame, n: int = COMMON_WORDS, least: int = LEAST_WORDS) -> dict[str, list[str]]:
    """Language -> its ``n`` most frequent words over all its documents, ties to the smaller word.

    Languages whose documents have fewer than ``least`` words in all are left out. Each task counts, and later ranks, its
    own words first; ``n`` rows per language reach the driver.
    """
    scratch = Scratch(docs.sparkSession, "common-words")
    counted = scratch.write(worded(docs).where("lang is not null").select("lang", F.explode("words").alias("word")).groupBy(
        "lang", "word").count(), "counted")
    large = counted.groupBy("lang").agg(F.sum("count").alias("total")).where(F.col("total") >= least).select("lang")
    ranked = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    top = counted.where(F.col("word").rlike(WORDLIKE)).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)
    found: dict[str, list[str]] = {r["lang"]: [] for r in large.collect()}
    for r in top.join(large, "lang", "left_semi").orderBy("lang", "rank").collect():
        found[r["lang"]].append(r["word"])
    scratch.drop("counted")
    return dict(sorted(found.items()))


def features(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, lang, the base counts and the two histograms (arrays of counts), in one pass over the text."""
    t = worded(docs)
    t = t.withColumn("lines", F.expr(f"filter(split(text, '\\n'), l -> trim(BOTH {SPACES} FROM l) <> '')"))
    listed = F.array(*[F.lit(w) for w in vocabulary]).cast("array<string>")
    used = F.array(F.filter("words", lambda w: w.isin(vocabulary)))  # evaluated once
    common = F.element_at(F.transform(used, lambda f: F.transform(
        listed, lambda k: (F.size(f) - F.size(F.array_remove(f, k))).cast("long"))), 1)
    t = t.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"), F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as long)").alias("n_dup_lines"),
        F.expr(repeat_words()).alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("digits"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("capitals"),
        F.regexp_count("text", F.lit("[.,;:!?'\"()-]")).cast("long").alias("points"),
        (F.octet_length("text") - F.length("text")).cast("long").alias("beyond"),
        common.alias("common"))
    spaces = F.col("n_chars") - F.col("word_chars")
    known = [spaces, *(F.col(c) for c in ("n_symbols", "digits", "capitals", "points", "beyond"))]
    rest = F.greatest(F.lit(0).cast("long"), F.col("n_chars") - sum(known[1:], known[0]))
    others = F.expr("n_words - aggregate(common, 0L, (a, b) -> a + b)")
    return t.select("doc_id", "lang", "n_words", "n_chars", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    F.array(*known, rest).alias("chars"), F.concat("common", F.array(others)).alias("common"))


def references(found: DataFrame, langs: list[str], column: str, size: int) -> list[list[float]]:
    """For each language the shares of a histogram over all its documents: one row of sums per language is collected."""
    sums = found.where(F.col("lang").isin(langs)).groupBy("lang").agg(
        *[F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(size)]).orderBy("lang").collect()
    out = [[int(r[f"s{i}"]) for i in range(size)] for r in sums]
    return [[x / sum(v) for x in v] for v in out if sum(v)]


def nearest(column: str, refs: list[list[float]]) -> Column:
    """Least Jensen-Shannon distance of a histogram column to a reference; 0 if there is none."""
    if not refs:
        return F.lit(0.0)
    listed = "array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in r) + ")" for r in refs) + ")"
    term = ("(if(p > 0, p * log2(2 * p / (p + q)), 0D) + if(q > 0, q * log2(2 * q / (p + q)), 0D)) / 2")
    distance = f"sqrt(greatest(0D, aggregate(zip_with(s, r, (p, q) -> {term}), 0D, (a, b) -> a + b)))"
    shares = let(f"aggregate({column}, 0L, (a, b) -> a + b)", "n", f"transform({column}, x -> x / n)")
    return F.expr(let(shares, "s", f"array_min(transform({listed}, r -> {distance}))"))


def quality(docs: DataFrame, words: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): the base counts, the distances and the verdict.

    ``words`` names the languages that are references and their common words; by default both are taken from the
    documents (``common_words``), whatever their languages are. They are few: a language is a label of the column lang.

    A null text is empty, and like every text of under 50 words fails the base rule; texts with more than half of
    their words in repeated three-word windows fail it too. A histogram of a text shorter than MIN_CHARS or
    MIN_WORDS has distance null and passes. A null language, or one with fewer than LEAST_WORDS words, only means that the
    text adds to no reference. Without any reference nothing is rejected by distance. Other columns are not looked at, and
    a very long text is judged whole like any other. Repeated rows each get their row; an empty table gives an
    empty result.
    """
    words = common_words(docs) if words is None else words
    langs, vocabulary = sorted(words), sorted({w for listed in words.values() for w in listed})
    found = Scratch(docs.sparkSession, "quality").write(features(docs, vocabulary), "features")
    chars = nearest("chars", references(found, langs, "chars", CLASSES))
    common = nearest("common", references(found, langs, "common", len(vocabulary) + 1))
    out = found.withColumn("char_distance", F.when(F.col("n_chars") >= MIN_CHARS, chars)).withColumn(
        "word_distance", F.when(F.col("n_words") >= MIN_WORDS, common))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & near).alias("kept"), "char_distance", "word_distance")


def op8_js_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def _sql_distance(histogram: str, refs: str) -> str:
    """SQL of the least distance of a histogram column to the references of the table ``refs``."""
    term = """CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END
      + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END"""
    return f"""coalesce((SELECT min(sqrt(greatest(0, list_sum(list_transform(list_zip(
      list_transform({histogram}, lambda x: x / list_sum({histogram})), q), lambda z: {term})) / 2))) FROM {refs}), 0)"""


ORACLE = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
lw AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM w WHERE lang IS NOT NULL) GROUP BY lang, word),
lg AS (SELECT lang FROM lw GROUP BY lang HAVING sum(n) >= {LEAST_WORDS}),
top AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k
    FROM lw SEMI JOIN lg USING (lang) WHERE regexp_matches(word, '{WORDLIKE}')),
voc AS (SELECT coalesce(list(DISTINCT word ORDER BY word), []) AS v FROM top WHERE k <= {COMMON_WORDS}),
tri AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
    FROM w, unnest(range(1, len(w) - 1)) u(i) WHERE len(w) >= 3),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM tri, unnest(range(0, 3)) v(j) WHERE tri.n > 1 GROUP BY r),
f AS (SELECT w.r, doc_id, lang, len(w)::BIGINT AS n_words, length(t)::BIGINT AS n_chars,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    [len(regexp_extract_all(t, '[0-9]')), len(regexp_extract_all(t, '[A-Z]')),
     len(regexp_extract_all(t, '[.,;:!?''"()-]')), strlen(t) - length(t)] AS part,
    list_transform((SELECT v FROM voc), lambda k: len(list_filter(w, lambda x: x = k))) AS common
    FROM w LEFT JOIN rep USING (r)),
h AS (SELECT *, [n_chars - word_chars, n_symbols, part[1], part[2], part[3], part[4],
      greatest(0, word_chars - n_symbols - list_sum(part))] AS chars,
    list_concat(common, [n_words - list_sum(common)]) AS usual FROM f),
cs AS (SELECT lang, i, sum(chars[i]) AS s FROM h, unnest(range(1, {CLASSES} + 1)) u(i) WHERE lang IN (SELECT lang FROM lg) GROUP BY lang, i),
cr AS (SELECT lang, list(s::DOUBLE / total ORDER BY i) AS q FROM (SELECT *, sum(s) OVER (PARTITION BY lang) AS total FROM cs)
    WHERE total > 0 GROUP BY lang),
us AS (SELECT lang, i, sum(usual[i]) AS s FROM h, unnest(range(1, len(usual) + 1)) u(i) WHERE lang IN (SELECT lang FROM lg) GROUP BY lang, i),
ur AS (SELECT lang, list(s::DOUBLE / total ORDER BY i) AS q FROM (SELECT *, sum(s) OVER (PARTITION BY lang) AS total FROM us)
    WHERE total > 0 GROUP BY lang),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_chars >= {MIN_CHARS} THEN {_sql_distance("chars", "cr")} ELSE 0 END AS cd,
    CASE WHEN n_words >= {MIN_WORDS} THEN {_sql_distance("usual", "ur")} ELSE 0 END AS ud FROM h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND cd <= {MAX_CHAR_DISTANCE} AND ud <= {MAX_WORD_DISTANCE} AS kept FROM v"""
