"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsieve.llm import (
    alignment, chat, corpus_scoring, decontaminate, fingerprint, histogram_packing, infill, language, licenses, minhash, packing,
    substrings, urls,
)
from chatsieve.llm.tables import settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[str, str]:
    """The byte-level vocabulary, and the same one as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_conversations(turns))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def captures(pages: DataFrame) -> DataFrame:
    """Every page as a capture on one of 360 days."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7 % 360).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_at"))


def list_changes(pages: DataFrame) -> DataFrame:
    """Dated changes of three lists, derived from the hosts of all pages: every host is on
    the ads list for one stretch of days that its first page sets; hosts of pages in
    Spanish are blocked from one of their days on; every registered domain is allowed
    for some days of the year."""
    host = urls.host_of(F.col("url"))
    first = pages.select("page_id", "url", host.alias("host")).where("host IS NOT NULL").groupBy("host").agg(
        F.min("page_id").alias("k"), F.max(F.col("url").contains("/es/").cast("int")).alias("es")
    )
    on = lambda days: F.date_add(F.lit("2024-01-01").cast("date"), (days % 360).cast("int"))
    k, es = F.col("k"), F.col("es") == 1
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)

    def change(name: str, verdict: str, of, at, active: bool):
        return F.struct(
            F.lit(name).alias("list"), F.lit(verdict).alias("verdict"), of.alias("domain"), at.alias("at"), F.lit(active).alias("active")
        )

    steps = F.array(
        change("ads", "block", F.col("host"), on(k * 13), True),
        change("ads", "block", F.col("host"), F.date_add(on(k * 13), 45), False),
        F.when(es, change("spam", "block", F.col("host"), on(k * 5), True)),
        F.when(domain != "", change("trusted", "allow", domain, on(k * 11), True)),
        F.when(domain != "", change("trusted", "allow", domain, F.date_add(on(k * 11), 20), False)),
    )
    return first.select(F.explode(F.array_compact(steps)).alias("c")).select("c.*")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(captures(pages), list_changes(pages))


def op6_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    wanted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = corpus_scoring.score_corpus(docs, wanted)
    return scored.select("doc_id", "n_tokens", *[F.round(c, 4).alias(c) for c in ("target_loss", "background_loss", "score")])


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files())


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_language_model(docs.where(~language.held_out("doc_id")))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return histogram_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    text = infill.restored(F.col("output"), F.col("form"))
    hashes = [F.sha2(x, 256).alias(f"{name}_sha256") for name, x in (("output", F.col("output")), ("restored", text))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, ranks = tokenizer_files()
    made = alignment.align(table(spark, sf_dir, "documents"), path, public_tokenizers.path("piece_bpe_32k.model"), ranks)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    made = settled(made.withColumn("groups_sha256", digest).drop("groups"), "aligned", compression="zstd")
    sums = alignment.score_links(made, alignment.count_links(made))
    return made.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")], "groups_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash, op2_chat, op3_decontaminate, op4_fingerprint, op5_urls, op6_scoring, op7_licenses, op8_substrings,
        op9_packing, op10_language, op11_packing, op12_infill, op13_alignment,
    )
}
