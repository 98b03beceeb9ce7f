"""Ordered samples, splits, folds and batches.

Orders come from a hash of the id, so they are repeatable on any number of
executors. No window here runs without partitions, and a class that holds most of
the rows is ranked in many parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatsieve.functions.text import seeded_order
from chatsieve.operators.skew import settled

# Ranks are worked out per leading part of the order hash: 16 ** 4 parts per class.
HASH_PREFIX = 4
MAX_CLASSES = 100
ROWS_PER_BUCKET = 100_000


def seeded_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """At most n rows without replacement, the same for the same seed."""
    return df.orderBy(seeded_order(seed, F.col(id_col)), id_col).limit(n)


def head_rows(df: DataFrame, n: int, by: str = "id") -> DataFrame:
    """The first n rows in the order of a column."""
    return df.orderBy(by).limit(n)


def class_prefix_counts(hashed: DataFrame, label: str) -> DataFrame:
    """Rows per class and hash prefix, with the class size and the rows before each
    prefix. One row per class and prefix, whatever the size of the data."""
    counts = hashed.groupBy(label, "_part").agg(F.count("*").alias("_n"))
    per_class = Window.partitionBy(label)
    earlier = per_class.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        label,
        "_part",
        "_n",
        F.sum("_n").over(per_class).alias("_class_n"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )


def with_hash(df: DataFrame, seed: int, id_col: str) -> DataFrame:
    return df.withColumn("_order", seeded_order(seed, F.col(id_col))).withColumn(
        "_part", F.substring("_order", 1, HASH_PREFIX)
    )


def stratified_split(
    df: DataFrame,
    frac: float = 0.2,
    seed: int = 42,
    label: str = "toxic",
    id_col: str = "id",
    out: str = "split",
) -> DataFrame:
    """Mark round(frac * class size) rows of each class as test, the others as train.

    The prefix counts show in which hash prefix a class reaches its test share. Only
    the rows of that prefix are ranked, to find the last hash that still belongs to
    the test rows. That is one hash per class, found by one job; with up to
    ``MAX_CLASSES`` classes the table itself is then split row by row, without a shuffle,
    and with more the hashes are joined.
    """
    narrow = with_hash(df.select(label, id_col), seed, id_col).select(label, "_order", "_part")
    wanted = F.round(F.col("_class_n") * F.lit(float(frac)))
    turning = (
        class_prefix_counts(narrow.select(label, "_part"), label)
        .filter((F.col("_before") < wanted) & (wanted <= F.col("_before") + F.col("_n")))
        .select(label, "_part", (wanted - F.col("_before")).alias("_room"))
    )
    place = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_order"))
    last = (
        narrow.join(turning, [label, "_part"])  # one row per class
        .withColumn("_place", place)
        .filter(F.col("_place") == F.col("_room"))
        .select(label, "_order")
    )
    few = last.take(MAX_CLASSES + 1)
    hashed = df.withColumn("_order", seeded_order(seed, F.col(id_col)))
    if len(few) > MAX_CLASSES:
        hashed = hashed.join(last.withColumnRenamed("_order", "_last"), label, "left")
        in_test = F.coalesce(F.col("_order") <= F.col("_last"), F.lit(False))
    else:
        in_test = F.lit(False)
        for row in few:
            in_test = F.when(F.col(label) == row[label], F.col("_order") <= row["_order"]).otherwise(in_test)
    return hashed.select(*df.columns, F.when(in_test, "test").otherwise("train").alias(out))


def stratified_folds(
    df: DataFrame,
    k: int = 5,
    seed: int = 42,
    label: str = "toxic",
    id_col: str = "id",
    out: str = "fold",
) -> DataFrame:
    """Deal the rows of each class to k folds in turn.

    The join with the prefix counts and the ranking share one shuffle by class and
    prefix, which no class can make uneven. Pass only the columns that are needed.
    """
    hashed = with_hash(df, seed, id_col)
    counts = class_prefix_counts(hashed.select(label, "_part"), label).select(label, "_part", "_before")
    rank = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_order", id_col))
    fold = ((rank + F.col("_before") - 1) % k).cast("int")
    return hashed.join(counts, [label, "_part"]).select(*df.columns, fold.alias(out))


def bucket_of(id_col: str, buckets: int) -> Column:
    head = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10)
    return head.cast("bigint") % buckets


def pack_batches(
    df: DataFrame,
    size: int = 100,
    buckets: int | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Number the rows into batches of at most ``size``: adds (bucket, batch, place).

    Buckets are even because they hash a unique id. By default there is one per
    ``ROWS_PER_BUCKET`` rows; each ends in one batch that may be part full.
    """
    if buckets is None:
        buckets = 1 + df.count() // ROWS_PER_BUCKET
    with_bucket = df.withColumn("bucket", bucket_of(id_col, buckets))
    number = F.row_number().over(Window.partitionBy("bucket").orderBy(id_col)) - 1
    return with_bucket.withColumn("_no", number).select(
        *df.columns,
        "bucket",
        F.floor(F.col("_no") / size).cast("int").alias("batch"),
        (F.col("_no") % size + 1).cast("int").alias("place"),
    )


def request_batches(
    df: DataFrame, size: int = 100, buckets: int | None = None, text: str = "message", id_col: str = "id"
) -> DataFrame:
    """One row per batch with its messages in order; a batch holds at most ``size``."""
    packed = pack_batches(df.select(id_col, text), size, buckets, id_col)
    items = F.sort_array(F.collect_list(F.struct("place", id_col, text)))
    return packed.groupBy("bucket", "batch").agg(F.count("*").cast("int").alias("n"), items.alias("items"))


def with_context(
    df: DataFrame,
    k: int = 3,
    key: str = "conv_id",
    order: str = "turn",
    text: str = "text",
    out: str = "context",
    separator: str = " | ",
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Add the last k messages of the same conversation, oldest first.

    (key, order) is unique. Conversations are windows of one shuffle. If any has more than
    ``hot_rows`` messages, the table is range-partitioned by (key, order) instead, so that
    long conversations are cut wherever a part is full, however their turns are numbered.
    The first k rows of a conversation in a part look back across the cut: they get their
    context from a second pass over the edges alone (first k and last k rows in each part).
    """
    back = Window.partitionBy(key).orderBy(order).rowsBetween(-k, -1)
    longest = df.groupBy(key).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
    if longest <= hot_rows:
        found = df.withColumn("_context", F.collect_list(text).over(back))
        return found.select(*df.columns, F.array_join("_context", separator).alias(out))
    # Settled, so that both passes see the same cuts.
    cut = settled(df.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()), "cut")
    in_part = Window.partitionBy(key, "_part").orderBy(order)
    rows = (
        cut.withColumn("_place", F.row_number().over(in_part))
        .withColumn("_last", F.lead(F.lit(True), k).over(in_part).isNull())
        .withColumn("_context", F.collect_list(text).over(in_part.rowsBetween(-k, -1)))
    )
    edges = rows.filter((F.col("_place") <= k) | F.col("_last")).withColumn("_context", F.collect_list(text).over(back))
    parts = [rows.filter(F.col("_place") > k), edges.filter(F.col("_place") <= k)]
    joined = [p.select(*df.columns, F.array_join("_context", separator).alias(out)) for p in parts]
    return joined[0].unionByName(joined[1])
