"""Counts, rates and reports. Each is one aggregate with map-side partial sums, so a
hot key or a single-row result costs no more than a scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The label enum.
LABELS = {
    0: "NON_TOXIC",
    1: "INSULTS_AND_FLAMING",
    2: "OTHER_OFFENSIVE",
    3: "HATE_AND_HARASSMENT",
    4: "THREATS",
    5: "EXTREMISM",
}
CLASS_NAMES = ("Clean", "Profane")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double; NULL when the bottom is zero."""
    return F.try_divide(top.cast("double"), bottom)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def binary_label(df: DataFrame, label: str = "label", out: str = "toxic") -> DataFrame:
    return df.withColumn(out, F.col(label) != 0)


def coarse_label(
    df: DataFrame, mapping: Mapping[int, str] | DataFrame, label: str = "label", out: str = "coarse", rest: str = "other"
) -> DataFrame:
    """A coarser class by a mapping table (``label``, ``class``) or dict; labels that it does not
    list are ``rest``, and a missing label has no class. A label set is small, so its
    mapping is broadcast."""
    if not isinstance(mapping, DataFrame):
        mapping = df.sparkSession.createDataFrame(list(mapping.items()), "label int, class string")
    listed = mapping.groupBy(F.col("label").alias("_label")).agg(F.min("class").alias("_class"))
    joined = df.join(F.broadcast(listed), df[label] == F.col("_label"), "left")
    coarse = F.when(F.col(label).isNotNull(), F.coalesce("_class", F.lit(rest)))
    return joined.withColumn(out, coarse).drop("_label", "_class")


def label_stats(df: DataFrame, label: str = "label") -> DataFrame:
    """Total, count and share of each label (also of unused ones), toxic and clean."""
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(label) == code).alias(name) for code, name in LABELS.items()],
        F.count_if(F.col(label) != 0).alias("TOXIC"),
    ).withColumn("CLEAN", F.col("total") - F.col("TOXIC"))

    def row(kind: str, name: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(name.upper()).alias("name"),
            F.col(name).alias("n"),
            ratio(100 * F.col(name), F.col("total")).alias("pct"),
        )

    rows = [row("all", "total")]
    rows += [row("label", name) for name in LABELS.values()]
    rows += [row("binary", name) for name in ("TOXIC", "CLEAN")]
    return counts.select(F.inline(F.array(*rows)))


def confusion_columns(truth: Column, pred: Column) -> list[Column]:
    return [
        F.count_if(truth & pred).alias("tp"),
        F.count_if(~truth & pred).alias("fp"),
        F.count_if(truth & ~pred).alias("fn"),
        F.count_if(~truth & ~pred).alias("tn"),
    ]


def score_columns(tp="tp", fp="fp", fn="fn", tn="tn") -> dict[str, Column]:
    """Measures for the profane class from the four counts."""
    tp, fp, fn, tn = F.col(tp), F.col(fp), F.col(fn), F.col(tn)
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def confusion(df: DataFrame, truth: str = "toxic", pred: str = "flagged") -> DataFrame:
    return df.agg(*confusion_columns(F.col(truth), F.col(pred)))


def classification_report(df: DataFrame, truth: str = "toxic", pred: str = "flagged") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, plain and weighted means."""
    four = confusion(df, truth, pred)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def measures(hit, wrong, missed):
        return (
            ratio_or_zero(hit, hit + wrong),
            ratio_or_zero(hit, hit + missed),
            ratio_or_zero(2 * hit, 2 * hit + wrong + missed),
        )

    clean, profane = measures(tn, fn, fp), measures(tp, fp, fn)
    n_clean, n_profane = tn + fp, tp + fn
    n = n_clean + n_profane
    accuracy = ratio_or_zero(tp + tn, n)

    def row(name, values, support):
        named = zip(("precision", "recall", "f1"), values)
        return F.struct(
            F.lit(name).alias("class"),
            *[F.round(v, 6).alias(k) for k, v in named],
            support.alias("support"),
        )

    macro = [(c + p) / 2 for c, p in zip(clean, profane)]
    weighted = [ratio_or_zero(c * n_clean + p * n_profane, n) for c, p in zip(clean, profane)]
    rows = [
        row(CLASS_NAMES[0], clean, n_clean),
        row(CLASS_NAMES[1], profane, n_profane),
        row("accuracy", [accuracy] * 3, n),
        row("macro avg", macro, n),
        row("weighted avg", weighted, n),
    ]
    return four.select(F.inline(F.array(*rows)))


def error_rows(
    df: DataFrame, kind: str, truth: str = "toxic", pred: str = "flagged"
) -> DataFrame:
    """The false positives (``fp``) or false negatives (``fn``)."""
    if kind == "fp":
        return df.filter(F.col(pred) & ~F.col(truth))
    if kind == "fn":
        return df.filter(~F.col(pred) & F.col(truth))
    raise ValueError("kind must be 'fp' or 'fn'")


def flag_summary(df: DataFrame, pred: str = "flagged") -> DataFrame:
    """Verdicts, flagged and clean; a row without a verdict is neither."""
    return df.agg(
        F.count(pred).alias("total"), F.count_if(F.col(pred)).alias("flagged")
    ).select(
        "total",
        "flagged",
        (F.col("total") - F.col("flagged")).alias("clean"),
        ratio(100 * F.col("flagged"), F.col("total")).alias("flagged_pct"),
        ratio(100 * (F.col("total") - F.col("flagged")), F.col("total")).alias("clean_pct"),
    )


def precision_projection(
    df: DataFrame,
    reviewed: DataFrame,
    id_col: str = "id",
    pred: str = "flagged",
    verdict: str = "offensive",
) -> DataFrame:
    """Precision of a reviewed sample of flagged rows, projected to all flagged rows.

    ``reviewed`` holds (id, verdict). Estimates: at precision 0.9, at 0.5 and as reviewed.
    """
    flagged = df.filter(F.col(pred)).select(id_col)
    counts = flagged.join(reviewed.select(id_col, verdict), id_col, "left").agg(
        F.count("*").alias("flagged"),
        F.count(verdict).alias("reviewed"),
        F.count_if(F.col(verdict)).alias("offensive"),
    )
    precision = ratio(F.col("offensive"), F.col("reviewed"))
    return counts.select(
        "*",
        precision.alias("precision"),
        (F.col("flagged") * F.lit(0.9)).cast("bigint").alias("estimate_high"),
        (F.col("flagged") * F.lit(0.5)).cast("bigint").alias("estimate_medium"),
        (F.col("flagged") * precision).cast("bigint").alias("estimate_reviewed"),
    )


def metrics_by(
    df: DataFrame, key: str, truth: str = "toxic", pred: str = "flagged"
) -> DataFrame:
    """Counts and measures for every value of a key, such as language or data set."""
    return (
        df.groupBy(key)
        .agg(*confusion_columns(F.col(truth), F.col(pred)))
        .select(
            key,
            "tp",
            "fp",
            "fn",
            "tn",
            *[F.round(v, 6).alias(k) for k, v in score_columns().items()],
        )
    )


def rate_verdict(rate: Column, low: Column, high: Column) -> Column:
    return (
        F.when(rate > high, "suspect_false_positives")
        .when(rate < low, "suspect_false_negatives")
        .otherwise("in_band")
    )


def band_columns(
    key: Column, low: float, high: float, bands: Mapping[str, tuple[float, float]] | None
) -> tuple[Column, Column]:
    """Expected band of a key: its own entry if there is one, else the common band."""
    lows, highs = F.lit(low), F.lit(high)
    for name, (own_low, own_high) in (bands or {}).items():
        lows = F.when(key == name, own_low).otherwise(lows)
        highs = F.when(key == name, own_high).otherwise(highs)
    return lows, highs


def rate_triage(
    df: DataFrame,
    key: str = "lang",
    low: float = 0.001,
    high: float = 0.01,
    bands: Mapping[str, tuple[float, float]] | None = None,
    pred: str = "flagged",
) -> DataFrame:
    """Flag rate per key against its expected band."""
    lows, highs = band_columns(F.col(key), low, high, bands)
    rate = F.col("flagged") / F.col("total")
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("total"), F.count_if(F.col(pred)).alias("flagged"))
        .select(
            key, "total", "flagged", F.round(rate, 6).alias("rate"), rate_verdict(rate, lows, highs).alias("verdict")
        )
    )


def side_by_side(predictions: Mapping[str, DataFrame], id_col: str = "id", pred: str = "flagged") -> DataFrame:
    """One row per id with every filter's verdict: a union and one grouping, in place
    of a chain of joins."""
    stacked = None
    for name, df in predictions.items():
        part = df.select(id_col, F.lit(name).alias("_filter"), F.col(pred).alias("_pred"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(id_col).agg(
        *[F.max(F.when(F.col("_filter") == name, F.col("_pred"))).alias(name) for name in predictions]
    )


def filter_comparison(
    df: DataFrame, filters: Iterable[str], truth: str = "toxic"
) -> DataFrame:
    """Measures of several verdict columns over the same rows in one pass, with a
    filter that flags nothing as the base line."""
    filters = list(filters)
    truth_col = F.col(truth)
    verdicts = {name: F.col(name) for name in filters} | {"all_clean": F.lit(False)}
    sums = []
    for i, pred in enumerate(verdicts.values()):
        sums += [c.alias(f"{k}{i}") for c, k in zip(confusion_columns(truth_col, pred), ("tp", "fp", "fn", "tn"))]
    rows = []
    for i, name in enumerate(verdicts):
        four = [f"{k}{i}" for k in ("tp", "fp", "fn", "tn")]
        rows.append(
            F.struct(
                F.lit(name).alias("filter"),
                *[F.round(v, 6).alias(k) for k, v in score_columns(*four).items()],
            )
        )
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def annotation_report(
    df: DataFrame, truth: str = "toxic", verdict: str = "verdict", status: str = "status", latency: str = "latency_s"
) -> DataFrame:
    """Answered, blocked and correct annotations, and the latency of the answered."""
    answered = F.col(status) == "OK"
    timed = F.when(answered, F.col(latency))
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(answered).alias("answered"),
        F.count_if(F.col(status) == "BLOCKED").alias("blocked"),
        F.count_if(F.col(status) == "INVALID").alias("invalid"),
        F.count_if(answered & (F.col(verdict) == F.col(truth))).alias("correct"),
        F.round(F.avg(timed), 6).alias("latency_avg"),
        F.min(timed).alias("latency_min"),
        F.max(timed).alias("latency_max"),
    )
