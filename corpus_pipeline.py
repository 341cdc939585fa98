"""From raw documents to token ids: five stages, each one of the operators of cohortkit.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last
return the columns of ``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.bpe import encode_decode, vocabulary_path
from cohortkit.llm.common import Scratch, read_table
from cohortkit.llm.langid import fold_of, identify
from cohortkit.llm.mixing import mix
from cohortkit.llm.neardup import near_duplicates
from cohortkit.llm.recompression import dedup_substrings

#: Share of the remaining tokens that the mixture takes; each document at most once.
MIX_PERCENT = 70


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that no learned language accepts go, and with them null texts and those without a letter."""
    found = identify(docs, docs.where(fold_of(4) != 2), rest=True)
    kept = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return found.where("not rejected").select(*kept)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays; of rows with one doc_id, one."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if again.limit(1).count():
        first = Window.partitionBy("doc_id").orderBy("text")
        kept = kept.withColumn("_place", F.row_number().over(first)).where(
            "_place = 1 or doc_id is null").select(*docs.columns)
    return kept


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that stand earlier too are cut out; a text that is nothing else goes."""
    cut = dedup_substrings(docs, width=20).where("n_removed < n_words or n_words = 0")
    changed = F.col("n_removed") > 0
    out = []
    for c in docs.columns:
        if c in ("doc_id", "text"):
            out.append(F.col(c))
        elif c == "n_chars":
            out.append(F.when(changed, F.length("text").cast("long")).otherwise(F.col("rest.n_chars")).alias(c))
        else:
            out.append(F.col("rest").getField(c).alias(c))
    return cut.select(*out)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to the target weights of domains, languages and sources."""
    return mix(docs, budget_percent=MIX_PERCENT, max_epochs=1, seed="pipeline").where("mix.copies > 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    out = encode_decode(docs, vocabulary_path(), digests=False)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicate", near_duplicate),
    ("substrings", substrings),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: No SQL for the trained language models and the sketches; tests/llm tests the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else scratch.write(out, name)
        if i and i < len(STAGES) - 1:
            scratch.drop(STAGES[i - 1][0])
    return docs
