"""Small frames shared by the tests of the training-data operators."""
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
             len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(df):
    """The same rows with extra columns named like the operators' own."""
    for name in ("fp", "label", "topic", "n_tokens", "kept", "pos", "_t", "block", "weight",
                 "_doc", "_id", "a", "range", "low", "recipe", "odd.name", "sampled"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
