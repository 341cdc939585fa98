"""Small documents with everything that may go wrong in them."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def hard_rows(seed: int = 3, n: int = 60, ids: bool = True):
    """(doc_id, text) with nulls, empties, runs, exact and near copies, shared passages, odd white space and a long text."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "Der", "die", "été", "ñandú", "a", "b", "x1", "thon", "erre", "ing", "ble.", "*#", "…"]
    vocabulary += [f"w{i}" for i in range(120)]
    sep = [" ", " ", " ", " ", "\n", "  ", "\t", " \n", " ", "\x1f"]

    def text(k):
        return "".join(rng.choice(vocabulary) + rng.choice(sep) for _ in range(k))

    passage = text(60)
    rows = [None, "", " \n\t", "one", "one two", "one two", "a " * 300, "ab" * 700, "x " * 19 + "y", passage, passage]
    while len(rows) < n:
        kind = rng.randrange(5)
        if kind == 0:
            rows.append(text(rng.randrange(1, 200)))
        elif kind == 1:
            rows.append(text(rng.randrange(0, 60)) + passage + text(rng.randrange(0, 60)))
        elif kind == 2:
            rows.append(rng.choice(rows))
        elif kind == 3:
            words = (rng.choice([r for r in rows if r]) or "").split(" ")
            if words:
                words[rng.randrange(len(words))] = "edited"
            rows.append(" ".join(words))
        else:
            rows.append(text(30) * rng.randrange(1, 4))
    rows.append(text(6000) + passage)
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i * 3, rows[j]) for i, j in enumerate(order)]


def frame(spark, rows, partitions: int = 3, **columns):
    """documents with the given rows; other columns get mixed values and nulls."""
    langs, sources = ["en", "de", None, "fr"], ["src1", "src2", None, "src0", "odd"]
    full = [(i, t, langs[k % 4], sources[k % 5], None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)


def clashing(df):
    """The same table with extra columns that have the names the operators use inside."""
    from pyspark.sql import functions as F

    for name in ("batch", "rest", "bucket", "kind", "data", "rep", "band", "words", "row", "key", "n_words", "component_id"):
        df = df.withColumn(name, F.lit(1))
    return df
