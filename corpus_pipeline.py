"""A training corpus in five stages, each written as Parquet and read again by the next.

A document that a stage drops is gone for all later ones; every stage but the last
returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsieve.llm import decontaminate, language, minhash, packing, substrings
from chatsieve.llm.queries import table, tokenizer_files
from chatsieve.session import scratch_path


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row's id and text, under a name that no column has. Rows of one
    id with different texts are told apart, also where the id is missing; rows equal in
    both go or stay together."""
    name = "row_key"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    missing = F.concat(F.col("doc_id").isNull().cast("string"), F.col("text").isNull().cast("string"))
    return docs.withColumn(name, F.xxhash64("doc_id", "text", missing)), name


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in the first column of ``gone``."""
    return docs.join(gone.toDF(key).distinct(), key, "left_anti").drop(key)


def by_key(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), "text")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language ID rejects: no letter, or text that is like none
    of the languages learnt from the labelled documents of this stage."""
    model = language.fit_language_model(docs.where(~language.held_out("doc_id")))
    rows, key = keyed(docs)
    return without(rows, key, language.identify(by_key(rows, key), model).where("rejected").select("doc_id"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    rows, key = keyed(docs)
    classes = minhash.near_duplicates(by_key(rows, key)).select(F.col("doc_id").alias("member"), "class_id")
    several = classes.groupBy("class_id").agg(F.count("*").alias("n")).where("n > 1").select("class_id")
    members = classes.join(several, "class_id").join(rows.select(F.col(key).alias("member"), "doc_id"), "member")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "member"))
    stays = members.groupBy("class_id").agg(first.alias("first")).select("class_id", F.col("first.member").alias("stays"))
    return without(rows, key, members.join(stays, "class_id").where("member != stays").select("member"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that an earlier document has. Rows that
    repeat an id stay a row each, cut by their own text."""
    rows, key = keyed(docs)
    cut = substrings.dedup_substrings(docs, with_key=True).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), "kept").dropDuplicates(["cut_id", "cut_key"])
    # Only the two columns that decide are joined, so that no other column can clash.
    known = rows.select(F.col(key).alias("member"), F.col("doc_id").alias("cut_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("cut_key"))
    found = known.join(cut, ["cut_id", "cut_key"]).select("member", "kept").dropDuplicates(["member"])
    found = found.select(F.col("member").alias(key), F.struct("kept").alias(f"{key}_new"))
    joined = rows.join(found, key, "left")
    kept = F.col(f"{key}_new.kept")
    text = F.when(F.col(f"{key}_new").isNotNull(), kept).otherwise(F.col("text"))
    size = F.when(F.col(f"{key}_new").isNotNull(), F.char_length(kept)).otherwise(F.col("n_chars"))
    new = {"text": text, "n_chars": size.cast(docs.schema["n_chars"].dataType)}
    return joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    rows, key = keyed(docs)
    hits = decontaminate.contaminated(by_key(rows, key), table(spark, sf_dir, "benchmark"))
    return without(rows, key, hits.select("doc_id"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences of at most 1024 tokens."""
    return packing.pack(docs, *tokenizer_files())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: No stage but the removal of passages can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
