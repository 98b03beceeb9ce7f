"""Small shared steps: the (doc_id, text) view of a table and settled results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsieve.session import scratch_path


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, so that no other column can clash; NULL text reads as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def settled(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it is computed once, and a
    lost executor costs a re-read instead of the whole lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
