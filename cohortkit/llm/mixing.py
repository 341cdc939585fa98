"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down the tree domain - language - source. At each node the budget is filled into
the children in proportion to their weights; a child that can't take its share (its capacity is its
tokens times the epochs allowed) is filled up and its shortage goes to its siblings, again by weight.
A node's capacity is that of its leaves together, so only what all siblings can't take is passed to
the ancestors' siblings. All arithmetic is in whole tokens; the few tokens lost to rounding down are
fewer than the siblings.

Each leaf then takes whole epochs of its documents while its budget holds, and of the next epoch the
prefix of its seeded order that fits. The order is that of md5(seed:epoch:doc_id). The prefix's end is
found from sums over 4096 ranges of that hash, so no task sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import WORD_PATTERN, Scratch, read_table

#: Target weights by name at each level; a name that is not listed has weight 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS: dict[str, int] = {}
BUDGET_PERCENT, MAX_EPOCHS, SEED = 60, 3, "mix-1"
TREE = ["domain", "lang", "source"]


def domain_of(source: Column) -> Column:
    """Default domain of a source: its number modulo four, ``none`` without a number."""
    number = F.regexp_extract(source, r"([0-9]+)$", 1)
    return F.when(F.coalesce(number, F.lit("")) == "", "none").otherwise(
        F.concat(F.lit("d"), F.pmod(F.right(number, F.lit(6)).cast("int"), F.lit(4)).cast("string")))


def weight_of(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, value in sorted(weights.items()):
        out = F.when(name == key, value).otherwise(out)
    return out


def fill(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Share each parent's ``given`` among its children (``weight``, ``cap``): column ``budget``.

    A child is full if its capacity is at most its weighted share of what the fuller ones leave.
    """
    wide = "decimal(20,0)"
    rank = Window.partitionBy(*parents).orderBy(F.coalesce(F.try_divide("cap", "weight"), F.lit(0.0)), name)
    whole = Window.partitionBy(*parents)
    upto = rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = children.withColumn("given", F.least("given", F.sum("cap").over(whole)))
    x = x.withColumn("left", F.col("given") - F.sum("cap").over(upto) + F.col("cap"))
    x = x.withColumn("heavy", F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight"))
    full = F.col("cap").cast(wide) * F.col("heavy").cast("decimal(10,0)") <= \
        F.col("left").cast(wide) * F.col("weight").cast("decimal(10,0)")
    x = x.withColumn("full", full)
    rest = F.col("given") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    x = x.withColumn("rest", rest).withColumn(
        "open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole))
    share = F.expr("cast(rest as decimal(20,0)) * cast(weight as decimal(10,0)) div cast(open as decimal(20,0))")
    return x.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop(
        "given", "left", "heavy", "full", "rest", "open")


def budgets(leaves: DataFrame, budget_percent: int, max_epochs: int, weights: list[dict[str, int]]) -> DataFrame:
    """(domain, lang, source, tokens, budget) from the leaves' tokens."""
    x = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = leaves.agg(F.expr(f"sum(tokens) * {int(budget_percent)} div 100").alias("given"))
    for depth in (1, 2, 3):
        nodes = x.groupBy(*TREE[:depth]).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weight_of(F.col(TREE[depth - 1]), weights[depth - 1]).cast("long"))
        nodes = nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0)).withColumn("root", F.lit(0))
        nodes = nodes.join(given.withColumn("root", F.lit(0)), "root") if depth == 1 \
            else nodes.join(given, TREE[:depth - 1])
        filled = fill(nodes, ["root", *TREE[:depth - 1]], TREE[depth - 1])
        given = filled.select(*TREE[:depth], F.col("budget").alias("given"))
    return filled.select(*TREE, "tokens", "budget")


def leaf_columns(docs: DataFrame, domain: Column | None) -> list[Column]:
    source = F.coalesce(F.col("source"), F.lit(""))
    return [F.coalesce(domain if domain is not None else domain_of(F.col("source")), F.lit("")).alias("domain"),
            F.coalesce(F.col("lang"), F.lit("")).alias("lang"), source.alias("source")]


def order_key(seed: str, epoch: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
        domain: Column | None = None, weights: list[dict[str, int]] | None = None) -> DataFrame:
    """``docs`` with a column ``mix``: struct(domain, n_tokens, budget of the leaf, copies to take of this row).

    The budget is ``budget_percent`` of all tokens (words); ``weights`` are by domain, language and source. A null
    domain, language or source is a leaf of its own, named "". A weight of 0 takes nothing of that node, and its share goes
    to its siblings; negative weights are refused. A null text has no tokens. Rows with the same doc_id stand
    together in the order, and are taken or left together. A leaf's tokens taken never exceed its budget. An empty
    table gives an empty result. Columns of ``docs`` keep their names and places, whatever they are; one named
    ``mix`` is replaced.
    """
    weights = weights or [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS]
    if any(w < 0 for level in weights for w in level.values()):
        raise ValueError("weights are not negative")
    scratch = Scratch(docs.sparkSession, "mixing")
    n_tokens = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    slim = scratch.write(docs.select("doc_id", n_tokens.alias("n_tokens"), *leaf_columns(docs, domain)), "slim")
    leaves = scratch.write(slim.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = budgets(leaves, budget_percent, max_epochs, weights)
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)).withColumn(
        "part", F.when(F.col("whole") < max_epochs, F.col("budget") - F.col("whole") * F.col("tokens")).otherwise(0))
    plan = scratch.write(plan, "plan")

    # the last key that each leaf's part-epoch takes: from the sums of hash ranges, then inside one range
    keyed = slim.join(plan.where("part > 0"), TREE).withColumn("key", order_key(seed, F.col("whole")))
    keyed = scratch.write(keyed.groupBy(*TREE, "key").agg(F.sum("n_tokens").alias("n"), F.min("part").alias("part")), "keyed")
    ranges = keyed.groupBy(*TREE, F.substring("key", 1, 3).alias("range")).agg(
        F.sum("n").alias("n"), F.min("part").alias("part"))
    along = Window.partitionBy(*TREE).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumn("upto", F.sum("n").over(along)).withColumn("before", F.col("upto") - F.col("n"))
    edge = ranges.where("upto > part").groupBy(*TREE).agg(F.min(F.struct("range", "before")).alias("edge")).select(
        *TREE, F.col("edge.range").alias("range"), F.col("edge.before").alias("before"))
    inside = Window.partitionBy(*TREE, "range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = keyed.withColumn("range", F.substring("key", 1, 3)).join(edge, [*TREE, "range"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(inside)).groupBy(*TREE).agg(
        F.min("range").alias("range"), F.max(F.when(F.col("upto") <= F.col("part"), F.col("key"))).alias("last"))
    # with nothing taken inside the edge range, the part ends where that range begins
    cut = cut.select(*TREE, F.coalesce("last", "range").alias("last"))
    plan = scratch.write(plan.join(cut, TREE, "left"), "cuts")

    others = [c for c in docs.columns if c != "mix"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "doc_id", n_tokens.alias("n_tokens"),
                       *leaf_columns(docs, domain)).join(plan, TREE)
    part = F.when((F.col("part") > 0) & (order_key(seed, F.col("whole")) <= F.coalesce("last", F.lit("g"))), 1).otherwise(0)
    return rows.select("row.*", F.struct(
        "domain", "n_tokens", "budget", (F.col("whole") + part).cast("int").alias("copies")).alias("mix"))


def op4_hierarchical_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaf, the leaf's budget and the copies to take (0: left out)."""
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("mix.domain").alias("domain"), "lang", "source", F.col("mix.n_tokens").alias("n_tokens"),
        F.col("mix.budget").alias("budget"), F.col("mix.copies").alias("copies"))


def _case(column: str, weights: dict[str, int]) -> str:
    whens = "".join(f" WHEN '{k}' THEN {v}" for k, v in sorted(weights.items()))
    return f"CASE {column}{whens} ELSE 1 END" if whens else "1"


def _level(depth: int) -> str:
    """SQL of one level: budgets b{depth} of the nodes n{depth} from those of the parents."""
    parents, name = TREE[:depth - 1], TREE[depth - 1]
    by = f"PARTITION BY {', '.join(parents)} " if parents else ""
    keys = ", ".join(TREE[:depth])
    weight = _case(name, [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS][depth - 1])
    given = f"JOIN b{depth - 1} USING ({', '.join(parents)})" if parents else "CROSS JOIN b0"
    return f"""
n{depth} AS (SELECT {keys}, sum(tokens)::HUGEINT tokens, (sum(tokens) * {MAX_EPOCHS})::HUGEINT cap, {weight}::HUGEINT weight
  FROM leaves GROUP BY {keys}),
r{depth} AS (SELECT n{depth}.*, least(given, sum(cap) OVER ({by}))::HUGEINT given,
  sum(cap) OVER ({by}ORDER BY cap::DOUBLE / weight::DOUBLE, {name} ROWS UNBOUNDED PRECEDING) - cap AS fuller,
  sum(weight) OVER ({by}ORDER BY cap::DOUBLE / weight::DOUBLE DESC, {name} DESC ROWS UNBOUNDED PRECEDING) AS heavy
  FROM n{depth} {given}),
f{depth} AS (SELECT *, cap * heavy <= (given - fuller) * weight AS is_full FROM r{depth}),
b{depth} AS (SELECT {keys}, tokens, CASE WHEN is_full THEN cap ELSE
  ((given - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({by})) * weight)::HUGEINT
  // (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}))::HUGEINT END::HUGEINT AS given FROM f{depth})"""


ORACLE = f"""
WITH d AS (SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}'))::BIGINT n_tokens,
  CASE WHEN coalesce(regexp_extract(source, '([0-9]+)$', 1), '') = '' THEN 'none'
    ELSE 'd' || (right(regexp_extract(source, '([0-9]+)$', 1), 6)::INT % 4) END AS domain,
  coalesce(lang, '') l, coalesce(source, '') s FROM documents),
leaves AS (SELECT domain, l AS lang, s AS source, sum(n_tokens)::HUGEINT tokens FROM d GROUP BY 1, 2, 3),
b0 AS (SELECT (sum(tokens) * {BUDGET_PERCENT})::HUGEINT // 100 AS given FROM leaves),
{_level(1)},
{_level(2)},
{_level(3)},
plan AS (SELECT *, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole FROM b3),
k AS (SELECT d.*, p.given budget, p.whole,
  CASE WHEN p.whole < {MAX_EPOCHS} THEN p.given - p.whole * p.tokens ELSE 0 END AS part,
  md5('{SEED}:' || p.whole || ':' || coalesce(d.doc_id::VARCHAR, '')) AS key
  FROM d JOIN plan p ON p.domain = d.domain AND p.lang = d.l AND p.source = d.s)
SELECT doc_id, domain, lang, source, n_tokens, budget::BIGINT AS budget, (whole + CASE WHEN part > 0 AND
  sum(n_tokens) OVER (PARTITION BY domain, l, s ORDER BY key RANGE UNBOUNDED PRECEDING) <= part THEN 1 ELSE 0 END)::INT AS copies
FROM k"""
