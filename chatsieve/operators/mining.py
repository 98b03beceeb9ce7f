"""Looking for better rules and for what errors have in common."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.functions.text import seeded_order, token_array


def disagreements(
    preds_a: DataFrame,
    preds_b: DataFrame,
    n: int = 50,
    seed: int = 42,
    id_col: str = "id",
    pred: str = "flagged",
    truth: str = "toxic",
) -> DataFrame:
    """A review set of hard cases: the filters differ, or either is wrong.

    ``preds_a`` holds (id, verdict, truth), ``preds_b`` (id, verdict).
    """
    both = preds_a.select(id_col, truth, F.col(pred).alias("pred_a")).join(
        preds_b.select(id_col, F.col(pred).alias("pred_b")), id_col
    )
    hard = both.filter(
        (F.col("pred_a") != F.col("pred_b"))
        | (F.col("pred_a") != F.col(truth))
        | (F.col("pred_b") != F.col(truth))
    )
    return hard.orderBy(seeded_order(seed, F.col(id_col)), id_col).limit(n)


def greedy_rules(
    df: DataFrame,
    k: int = 5,
    min_df: int = 3,
    text: str = "message",
    truth: str = "toxic",
) -> DataFrame:
    """Choose up to k words, each the one that adds most accuracy to those before it.

    A word gains one for every toxic and loses one for every clean text it newly
    flags. The gains of all words are summed once. A later step only sums the texts
    flagged so far, told by their own token arrays, and takes that off. One row per
    step, the winner, reaches the driver; no lineage grows from step to step.
    """
    base = df.select(
        F.array_distinct(token_array(F.col(text))).alias("terms"),
        F.when(F.col(truth), 1).otherwise(-1).alias("worth"),
    ).persist(StorageLevel.MEMORY_AND_DISK)

    def summed(rows: DataFrame, texts: str, gain: str) -> DataFrame:
        pairs = rows.select("worth", F.explode("terms").alias("term"))
        return pairs.groupBy("term").agg(F.count("*").alias(texts), F.sum("worth").alias(gain))

    every = summed(base, "df", "all_gain").filter(F.col("df") >= min_df).persist(StorageLevel.MEMORY_AND_DISK)
    chosen: list[tuple] = []
    try:
        for step in range(1, k + 1):
            words = F.array(*[F.lit(row[1]) for row in chosen]).cast("array<string>")
            flagged = summed(base.filter(F.arrays_overlap("terms", words)), "old_texts", "old_gain")
            best = (
                every.join(flagged, "term", "left")
                .select(
                    "term",
                    (F.col("all_gain") - F.coalesce("old_gain", F.lit(0))).alias("gain"),
                    (F.col("df") - F.coalesce("old_texts", F.lit(0))).alias("newly_flagged"),
                )
                .filter(F.col("gain") > 0)
                .orderBy(F.desc("gain"), "term")
                .limit(1)
                .collect()
            )
            if not best:
                break
            chosen.append((step, best[0]["term"], best[0]["gain"], best[0]["newly_flagged"]))
    finally:
        every.unpersist()
        base.unpersist()
    return df.sparkSession.createDataFrame(
        chosen, "step int, word string, gain bigint, newly_flagged bigint"
    )


def error_terms(
    df: DataFrame,
    kind: str | None = "fn",
    k: int = 20,
    min_df: int = 3,
    text: str = "message",
    truth: str = "toxic",
    pred: str = "flagged",
) -> DataFrame:
    """Words that errors hold more often than other rows: smoothed log ratio of the
    shares of texts with the word. Kinds: ``fp``, ``fn``, or both of them (None), which
    are counted in one pass over the texts."""
    wrong = {"fp": F.col(pred) & ~F.col(truth), "fn": ~F.col(pred) & F.col(truth)}
    kinds = [kind] if kind else ["fp", "fn"]
    marked = df.select(text, *[wrong[x].alias(x) for x in kinds])

    def sums(name: str) -> list:
        return [f(c).alias(f"{x}_{name}{n}") for x in kinds for f, c, n in ((F.count_if, F.col(x), 1), (F.count_if, ~F.col(x), 0))]

    sizes = marked.agg(*sums("n"))
    counted = (
        marked.select(*kinds, F.explode(F.array_distinct(token_array(F.col(text)))).alias("term"))
        .groupBy("term")
        .agg(*sums("t"))
    )
    rows = [
        F.struct(
            F.lit(x).alias("kind"),
            F.col(f"{x}_t1").alias("error_texts"),
            F.col(f"{x}_t0").alias("other_texts"),
            F.round(
                F.ln(((F.col(f"{x}_t1") + 0.5) / (F.col(f"{x}_n1") + 1.0)) / ((F.col(f"{x}_t0") + 0.5) / (F.col(f"{x}_n0") + 1.0))),
                6,
            ).alias("score"),
        )
        for x in kinds
    ]
    scored = counted.crossJoin(F.broadcast(sizes)).select("term", F.inline(F.array(*rows)))  # sizes: one row
    scored = scored.filter((F.col("error_texts") > 0) & (F.col("error_texts") + F.col("other_texts") >= min_df))
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("score"), "term"))
    return scored.withColumn("_place", place).filter(F.col("_place") <= k).select(
        "kind", "term", "error_texts", "other_texts", "score"
    )


def union_datasets(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Several labelled sets as one table with the name of the set in ``dataset``."""
    out = None
    for name, df in parts.items():
        part = df.withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
