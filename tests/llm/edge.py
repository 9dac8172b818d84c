"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns with clashing names."""

import random

from pyspark.sql import functions as F


def docs_frame(spark, rows):
    """(doc_id, text) rows with the other columns of documents and columns whose names operators use inside."""
    df = spark.createDataFrame([(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("id", "row", "path", "blob", "n", "h", "w", "u", "v", "line", "token", "label", "score", "component"):
        df = df.withColumn(name, F.lit(f"extra {name}"))
    return df


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts():
    rng = random.Random(5)
    long = words(rng, 30_000)
    return ["", None, " ", "\n\n", "one", "two words", long, long, "Ünïcode wörds ﬁ \U0001F600 K ſ", words(rng, 40), words(rng, 40)]
