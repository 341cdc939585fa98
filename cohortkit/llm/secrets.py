"""Secret scans by character Markov models: DataFrame functions only.

Three patterns give the base spans. All other long runs of key characters are judged by two first-order Markov models of
characters, one of random strings and one of ordinary identifiers: a run whose log-likelihood ratio reaches the prior odds
is a span of its own kind. Both models are trained on labelled samples from all texts: the values of the base spans and
the base64 digest of each text are random strings, the long runs that no base span touches are identifiers. Only the
counts of character pairs reach the driver, at most two for each pair of the alphabet.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import Scratch, read_table
from cohortkit.llm.divergence import let


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: The base kinds in their order, their patterns and least lengths (assign: of the value, group 2).
KINDS = ["assign", "access", "hex"]
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
#: The runs of these classes are maximal behind their front, so a least length in the pattern drops the same matches.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

METHOD = "markov"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
START = "^"  # stands before the first character of every string
RUN = "[A-Za-z0-9+/_-]{12,}"
MIN_RUN = 16  # shorter runs train the model of identifiers and are not judged
SMOOTHING = 0.5
#: A run is reported when it is this many times likelier a random string than an identifier, as identifiers are as many times more.
PRIOR_ODDS = 1000.0
LIMIT = math.log(PRIOR_ODDS)

SPANS = "array<struct<start:int,end:int,value:string>>"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running(lengths: str) -> str:
    """Sums of all elements before each one, by blocks of 128: linear but for one sum of blocks a block."""
    blocks = f"transform(sequence(0, (size({lengths}) - 1) div 128), k -> aggregate(slice({lengths}, cast(k * 128 + 1 as int), 128), 0, (a, x) -> a + x))"
    before = "transform(bl, (x, k) -> aggregate(slice(bl, 1, k), 0, (a, y) -> a + y))"
    return let(blocks, "bl", let(before, "off", (
        f"transform({lengths}, (x, i) -> off[cast(i div 128 as int)] + "
        f"aggregate(slice({lengths}, cast(i div 128 as int) * 128 + 1, i % 128), 0, (a, y) -> a + y))")))


def matches(pattern: str) -> str:
    """All matches of a pattern in column ``text`` with their places in code points.

    The places are sums of the lengths of the matches and of what lies between them. A text without a match is not cut.
    """
    p = literal(pattern)
    spans = "transform(m, (v, i) -> struct(p[i] + gap[i] as start, p[i] + gap[i] + length(v) as end, v as value))"
    placed = let(f"transform(split(text, {p}, -1), x -> length(x))", "gap",
                 let("transform(m, (v, i) -> gap[i] + length(v))", "u", let(running("u"), "p", spans)))
    return let(f"regexp_extract_all(text, {p}, 0)", "m", f"if(size(m) = 0, cast(array() as {SPANS}), {placed})")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the matches of each base kind, the long runs that no base match touches, and a digest, in one pass over the texts."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    value = f"regexp_extract(s.value, {literal(ASSIGN)}, 2)"
    t = t.select("doc_id", "text", F.expr(f"filter({matches(ASSIGN)}, s -> length({value}) >= {ASSIGN_VALUE})").alias("assign"),
                 F.expr(matches(ACCESS)).alias("access"), F.expr(matches(HEX)).alias("hex"), F.expr(matches(RUN)).alias("runs"))
    free = ("if(size(assign) + size(access) + size(hex) = 0, runs, " + let("concat(assign, access, hex)", "b",
            "filter(runs, r -> not exists(b, s -> s.start < r.end and r.start < s.end))") + ")")
    values = f"concat(transform(assign, s -> {value}), transform(access, s -> s.value), transform(hex, s -> s.value))"
    bare = "transform({0}, s -> struct(s.start, s.end))"
    return t.select("doc_id", *[F.expr(bare.format(k)).alias(k) for k in KINDS], F.expr(free).alias("runs"),
                    F.expr(values).alias("values"), F.expr("if(text = '', null, base64(unhex(sha2(text, 256))))").alias("digest"))


def characters(column: str) -> str:
    return f"filter(split({column}, ''), c -> c <> '')"


def pair_counts(found: DataFrame) -> DataFrame:
    """random, pair, n: how often each pair of neighbouring characters stands in the strings of each label."""
    random = found.select(F.explode(F.expr("concat(values, if(digest is null, array(), array(digest)))")).alias("s"), F.lit(True).alias("random"))
    plain = found.select(F.explode("runs.value").alias("s"), F.lit(False).alias("random")).where("s rlike '[A-Za-z]'")
    pairs = let(characters("s"), "c", f"transform(c, (x, i) -> concat(if(i = 0, '{START}', c[i - 1]), x))")
    return random.unionByName(plain).select("random", F.explode(F.expr(pairs)).alias("pair")).groupBy("random", "pair").agg(
        F.count(F.lit(1)).alias("n"))


def log_ratios(counts: dict[tuple[bool, str], int]) -> list[list[float]]:
    """ln P(random) - ln P(identifier) of each character (column) behind each character or the start (row)."""
    out = []
    for before in START + ALPHABET:
        row = []
        total = [sum(counts.get((label, before + c), 0) for c in ALPHABET) for label in (True, False)]
        for c in ALPHABET:
            one, two = (math.log((counts.get((label, before + c), 0) + SMOOTHING) / (n + SMOOTHING * len(ALPHABET)))
                        for label, n in zip((True, False), total))
            row.append(one - two)
        out.append(row)
    return out


def train(found: DataFrame) -> list[list[float]]:
    """At most 2 * len(ALPHABET) * (len(ALPHABET) + 1) counts reach the driver."""
    return log_ratios({(r["random"], r["pair"]): r["n"] for r in pair_counts(found).collect()})


def ratio(column: str, table: list[list[float]]) -> str:
    """SQL of the log-likelihood ratio of a string of ALPHABET's characters."""
    flat = ",".join(repr(x) for row in table for x in row)
    place = [(ALPHABET.find(chr(i)) + 1) for i in range(128)]
    codes = f"transform({characters(column)}, c -> cast(split('{','.join(map(str, place))}', ',') as array<int>)[ascii(c)])"
    return let(codes, "k", f"aggregate(transform(k, (x, i) -> cast(split('{flat}', ',') as array<double>)["
               f"if(i = 0, 0, k[i - 1]) * {len(ALPHABET)} + x - 1]), 0D, (a, x) -> a + x)")


def secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, ``base`` and ``found``, arrays of
    (start, rank, end, kind) in code points by start, then rank of the kind, end exclusive. ``found`` holds the base spans
    and the runs that the models call random.

    A null text is empty and has no span. Repeated rows and ids each get their row and add to the models. A text of any
    length is read as a whole. An empty table gives an empty result; without any sample of a label its model is uniform.
    Columns of the names used inside don't clash, as only doc_id and text are read.
    """
    found = Scratch(docs.sparkSession, "secrets").write(scan(docs), "found")
    table = train(found)
    said = ", ".join(f"transform({k}, s -> struct(s.start as start, {i} as rank, s.end as end, '{k}' as kind))" for i, k in enumerate(KINDS))
    judged = (f"transform(filter(runs, r -> r.end - r.start >= {MIN_RUN} and r.value rlike '[A-Za-z]' and {ratio('r.value', table)} >= "
              f"{LIMIT!r}D), r -> struct(r.start as start, {len(KINDS)} as rank, r.end as end, '{METHOD}' as kind))")
    return found.select("doc_id", F.expr(f"sort_array(concat({said}))").alias("base"), F.expr(judged).alias("more")).select(
        "doc_id", "base", F.expr("sort_array(concat(base, more))").alias("found"))


def written(column: str) -> str:
    return f"array_join(transform({column}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def scan_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of ``secrets``."""
    numbers = [F.expr(f"cast(size(filter(base, s -> s.rank = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return secrets(docs).select("doc_id", *numbers, F.expr(f"sha2({written('base')}, 256)").alias("base_sha256"),
                                F.expr(written("found")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """doc_id and text with every span of ``secrets`` replaced; of spans that overlap, their union. ``doc_id`` is not null
    and not repeated."""
    joined = docs.select("doc_id", "text").join(secrets(docs).select("doc_id", "found"), "doc_id", "left")
    ends = "transform(found, (s, i) -> struct(s.start as start, s.end as end))"
    union = (f"aggregate({ends}, cast(array() as array<struct<start:int,end:int>>), (a, s) -> if(size(a) > 0 and element_at(a, -1).end >= s.start, "
             "concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, s.end) as end))), "
             "concat(a, array(s))))")
    pieces = let(union, "u", f"concat(array_join(transform(u, (s, i) -> concat(substring(text, if(i = 0, 0, u[i - 1].end) + 1, "
                 f"s.start - if(i = 0, 0, u[i - 1].end)), {literal(mark)})), ''), "
                 "substring(text, if(size(u) = 0, 0, element_at(u, -1).end) + 1))")
    return joined.select("doc_id", F.expr(f"if(size(found) > 0, {pieces}, text)").alias("text"))


def op11_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_digests(read_table(spark, sf_dir, "documents"))


def _sql_matches(kind: str, pattern: str, keep: str = "true") -> str:
    p = pattern.replace("'", "''")
    return f"""{kind} AS (SELECT r, start, start + length(v) AS stop, v FROM (SELECT r, unnest(v) AS v,
    unnest(list_transform(v, lambda x, i: list_sum(list_transform(gap[:i], lambda g: length(g))) +
      coalesce(list_sum(list_transform(v[:i - 1], lambda w: length(w))), 0)))::BIGINT AS start
    FROM (SELECT r, regexp_extract_all(t, '{p}') AS v, string_split_regex(t, '{p}') AS gap FROM d)) WHERE {keep})"""


_ALPHABET = ALPHABET.replace("'", "''")
_CHARS = "regexp_extract_all(s, '.')"
ORACLE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{_sql_matches("assign", ASSIGN, f"length(regexp_extract(v, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= {ASSIGN_VALUE}")},
{_sql_matches("access", ACCESS)},
{_sql_matches("hex", HEX)},
{_sql_matches("runs", RUN)},
base AS MATERIALIZED (SELECT r, start, 0 AS rank, stop, 'assign' AS kind,
    regexp_extract(v, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 2) AS v FROM assign
  UNION ALL SELECT r, start, 1, stop, 'access', v FROM access UNION ALL SELECT r, start, 2, stop, 'hex', v FROM hex),
free AS MATERIALIZED (SELECT * FROM runs WHERE regexp_matches(v, '[A-Za-z]') AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.r = runs.r AND b.start < runs.stop AND runs.start < b.stop)),
strings AS (SELECT true AS random, v AS s FROM base UNION ALL SELECT true, to_base64(unhex(sha256(t))) FROM d WHERE t <> ''
  UNION ALL SELECT false, v FROM free),
seen AS (SELECT random, unnest(list_zip(list_concat(['{START}'], {_CHARS}[:-2]), {_CHARS})) AS z FROM strings),
n AS (SELECT random, z[1] AS x, z[2] AS y, count(*) AS n FROM seen GROUP BY ALL),
chars AS (SELECT unnest(regexp_extract_all('{_ALPHABET}', '.')) AS y),
cells AS (SELECT x, y FROM (SELECT y AS x FROM chars UNION ALL SELECT '{START}') CROSS JOIN chars),
p AS (SELECT x, y, random, ln((coalesce(n, 0) + {SMOOTHING}) / (sum(coalesce(n, 0)) OVER (PARTITION BY x, random) + {SMOOTHING * len(ALPHABET)})) AS p
  FROM cells CROSS JOIN (VALUES (true), (false)) l(random) LEFT JOIN n USING (x, y, random)),
ratio AS (SELECT x, y, sum(CASE WHEN random THEN p ELSE -p END) AS w FROM p GROUP BY x, y),
steps AS (SELECT r, start, stop, unnest(list_zip(list_concat(['{START}'], {_CHARS}[:-2]), {_CHARS})) AS z
  FROM (SELECT *, v AS s FROM free WHERE length(v) >= {MIN_RUN})),
judged AS (SELECT r, start, stop FROM steps JOIN ratio ON x = z[1] AND y = z[2] GROUP BY r, start, stop HAVING sum(w) >= {LIMIT!r}),
every AS (SELECT r, start, rank, stop, kind FROM base UNION ALL SELECT r, start, {len(KINDS)}, stop, '{METHOD}' FROM judged),
said AS (SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {len(KINDS)}), '') AS base,
    {", ".join(f"count(*) FILTER (rank = {i}) AS n_{k}" for i, k in enumerate(KINDS))} FROM every GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN said USING (r)"""
