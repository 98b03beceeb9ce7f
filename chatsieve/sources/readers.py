"""Text and CSV inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.operators.skew import settled

# Cell texts that count as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MESSAGE_COLUMNS = ("index", "message", "label")


# A quoted field up to its closing quote, and the fields of a line up to an open quote at its end.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_OPEN_AT_END = rf'(?:(?:"{_QUOTED}"(?!")[^,]*+|[^",][^,]*+|),)*+"{_QUOTED}\z'


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV with a header and quoted fields, all strings. With ``multi_line`` fields may
    hold line breaks (``csv_records``). Files are split either way."""
    if not multi_line:
        return spark.read.csv(path, header=True, quote='"', escape='"')
    names = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).columns
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    fields = F.from_csv("record", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return csv_records(spark, path).select(fields.alias("row")).select("row.*")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of CSV files without their headers, from lines read in splits.

    A line ends inside a quoted field or not, depending on whether it begins inside one; both
    cases are told from the line alone. Lines are numbered within their split, and the state
    in which a line begins follows from the last line that ends the same way in either case
    and the number of lines since that turn the state round. What a split does as a whole is
    taken from one row per split. Lines that are whole records go on as they are, and only
    lines of longer records are grouped.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    closed = F.regexp_replace("value", f'^{_QUOTED}"(?!")[^,]*+', "")
    from_out = F.col("value").rlike(f"^{_OPEN_AT_END}")
    from_in = F.col("value").rlike(rf"^{_QUOTED}\z") | closed.rlike(f"^,{_OPEN_AT_END}")
    # Numbers and states are read twice below, so they are settled with the lines.
    lines = settled(lines.select("*", from_out.alias("out_opens"), from_in.alias("in_opens")), "lines")
    turns = (F.col("out_opens") & ~F.col("in_opens")).cast("int")
    fixed = F.when(F.col("out_opens") == F.col("in_opens"), F.col("out_opens").cast("int"))
    in_split = Window.partitionBy("file", "block").orderBy("at")
    so_far = lines.withColumn("turned", F.sum(turns).over(in_split))
    reset = F.last(F.when(fixed.isNotNull(), (fixed + F.col("turned")) % 2), True).over(in_split)
    so_far = so_far.withColumn("reset", reset)
    whole = so_far.groupBy("file", "block").agg(
        F.max_by("turned", "at").alias("turned"), F.max_by("reset", "at").alias("reset")
    )
    splits = Window.partitionBy("file").orderBy("block")
    whole = whole.withColumn("turns", F.sum("turned").over(splits)).withColumn(
        "known", F.last(F.when(F.col("reset").isNotNull(), (F.col("reset") + F.col("turned") + F.col("turns")) % 2), True).over(splits)
    )
    ends_open = (F.coalesce("known", F.lit(0)) + F.col("turns")) % 2
    begins = whole.select("file", "block", F.lag(ends_open, 1, 0).over(splits).alias("begins"))
    after = (F.coalesce("reset", F.col("begins")) + F.col("turned")) % 2
    placed = so_far.join(begins, ["file", "block"]).withColumn("after", after).withColumn(
        "before", F.lag("after", 1).over(in_split)
    )
    placed = placed.withColumn("before", F.coalesce("before", "begins"))
    starts = (F.col("before") == 0) & (F.regexp_replace("value", "\r$", "") != "")
    placed = placed.withColumn("starts", starts.cast("int")).withColumn("n", F.sum("starts").over(in_split))
    # The lines before the first start in a split belong to the last start of an earlier one.
    last = placed.groupBy("file", "block").agg(F.max("n").alias("n"))
    earlier = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), True).over(splits.rowsBetween(Window.unboundedPreceding, -1))
    last = last.select("file", "block", earlier.alias("earlier"))
    header = (F.col("block") == 0) & (F.col("n") == 1)
    single = placed.filter((F.col("starts") == 1) & (F.col("after") == 0) & ~header)
    several = placed.filter(((F.col("starts") == 0) & (F.col("before") == 1)) | ((F.col("starts") == 1) & (F.col("after") == 1)))
    own = F.when(F.col("n") > 0, F.struct("block", "n"))
    grouped = (
        several.join(last, ["file", "block"])
        .withColumn("of", F.coalesce(own, "earlier"))
        .filter(~((F.col("of.block") == 0) & (F.col("of.n") == 1)))
        .groupBy("file", "of")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n").alias("value"))
    )
    return single.select("value").union(grouped.select("value")).select(F.regexp_replace("value", "\r$", "").alias("record"))


def without_na(df: DataFrame, na_tokens: Iterable[str]) -> DataFrame:
    """Turn missing-value tokens into NULL, then drop rows with a NULL in any column."""
    tokens = list(na_tokens)
    blanked = df.select(
        *[F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    return blanked.na.drop("any")


def read_messages(
    spark: SparkSession,
    path: str,
    na_tokens: Iterable[str] = NA_TOKENS,
    index: str = "index",
    multi_line: bool = True,
) -> DataFrame:
    """Labelled messages: incomplete rows dropped, label as int (also from ``3.0``),
    index as long. Other columns of the file stay.

    A large file is read by several tasks, with or without line breaks in the fields. Without
    them turn ``multi_line`` off, which needs no shuffle. Keep the result with ``stored`` for
    repeated use.
    """
    raw = read_csv(spark, path, multi_line)
    missing = [c for c in MESSAGE_COLUMNS[1:] if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    typed = without_na(raw, na_tokens).withColumn("label", F.col("label").cast("double").cast("int"))
    return typed.withColumn(index, F.col(index).cast("long")) if index in raw.columns else typed


def read_usernames(
    spark: SparkSession,
    path: str,
    n: int | None = None,
    na_tokens: Iterable[str] = NA_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """The ``author`` column, from files that are split unless names hold line breaks; with
    ``n`` only the first n rows of the file, from which missing names are then dropped."""
    names = read_csv(spark, path, multi_line).select("author")
    if n is not None and n > 0:
        names = names.limit(n)
    return without_na(names, na_tokens)


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, trimmed, blank lines skipped."""
    trimmed = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    return spark.read.text(path).select(trimmed.alias("word")).filter(F.col("word") != "")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Keep a table as Parquet, in pieces every executor can read by itself, and go on
    from there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
