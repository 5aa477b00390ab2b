"""Small tables for the operators' tests."""

import json


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda d: json.dumps(d, default=str))


def docs(spark, items, extra=False):
    """items: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(i[0], i[1], *(i[2:] or (None, None)), len(i[1]) if i[1] else None) for i in items]
    df = spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F

        clash = ("size", "fp", "hash", "component_id", "shard", "root", "node", "u", "v", "key",
                 "weight", "bucket", "item_id", "pos", "lang_pred", "score", "taken", "law")
        df = df.select("*", *[F.lit("x").alias(c) for c in clash])
    return df
