"""Small document tables with the awkward cases."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, source="s"):
    rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashing_columns(df):
    """Columns that operators might use themselves."""
    for name in ("digest", "size", "content", "copies", "group", "carried", "ids", "n_tokens", "rank", "key", "text_sha256"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df
