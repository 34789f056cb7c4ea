"""Small frames with the awkward cases every operator has to take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def docs(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) as documents."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOCS)


AWKWARD = [(1, None, "en", "a"), (2, "", None, None), (None, "no id here at all", "en", "a"), (3, "twice the same words", "en", "b"),
           (3, "twice the same words", "en", "b"), (4, "\t \n", "en", "b"), (5, "ÿ日本 😀 ▁x", None, "c"), (6, "x" * 70_000, "fr", "c"),
           (7, "the cat sat on the mat " * 4000, "en", "")]


def awkward(spark):
    """Nulls, empty, very long and repeated texts, beside columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    extra = {c: F.lit(i) for i, c in enumerate(("size", "kept", "component_id", "fp", "k", "rid", "score", "target", "words", "__k", "v", "label"))}
    return docs(spark, AWKWARD).withColumns(extra)


def rows_of(df):
    return [r.asDict() for r in df.collect()]
