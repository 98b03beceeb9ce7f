"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsieve.session import scratch_path

HEAVY_KEYS = 1000
# Characters of text in a task that makes a row of every term.
CHARS_PER_TASK = 16 << 20
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def text_parts(df: DataFrame, text: str) -> int:
    """How many tasks split up the texts, so that the memory of one does not grow with the table."""
    chars = df.agg(F.sum(F.length(text))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), chars // CHARS_PER_TASK)


def above_share(counts: DataFrame, weight: str) -> DataFrame:
    """The keys that hold a quarter of an even shuffle partition or more. There are at most
    four times as many as partitions, so they are safe to broadcast; any other key fits
    well in one task."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(weight)).first()[0] or 0
    return counts.filter(F.col(weight) * (4 * parts) >= total)


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to a table in the shared folder. Later plans start from
    it: they know its size, and losing an executor does not bring the work back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that no plan will read again."""
    for table in tables:
        path = _written.pop(table, None)
        if path:
            files, at = _files(table.sparkSession, path)
            files.delete(at, True)


def _files(spark: SparkSession, path: str):
    """(the file system of a path, the path in it)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def is_folder(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def compact(key: Column) -> Column:
    """A string key of at most 65 characters: long ones are replaced by their hash, so
    that a fixed number of keys has a fixed size."""
    return F.when(F.length(key) <= 64, key).otherwise(F.concat(F.lit("\x01"), F.sha2(key, 256)))


def join_lookup(
    left: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    spread_by: Column,
    how: str = "inner",
    parts: int | None = None,
) -> DataFrame:
    """Join rows to a lookup table with one row per (string) key.

    ``weight`` is the lookup column that says how many left rows a key has; the other
    columns are small values. The lookup table is settled first. One of at most
    ``HEAVY_KEYS`` rows is broadcast. Of a larger one the keys above an even share of a
    task are, and their rows are spread over the shuffle by ``spread_by``; all other
    keys meet in an equi join. Left rows are read once. ``parts`` sets the number of tasks
    of the join, where the left rows grow with the table and the session's number does not.
    """
    values = [c for c in lookup.columns if c != key]
    lookup = settled(lookup.select(compact(F.col(key)).alias("_key"), *values), "lookup")
    keyed = left.withColumn("_key", compact(F.col(key)))
    if lookup.count() <= HEAVY_KEYS:
        return keyed.join(F.broadcast(lookup), "_key", how).select(*left.columns, *values)
    packed = lookup.select("_key", F.struct(*values).alias("_found"))
    heavy = above_share(lookup, weight).select("_key", F.struct(*values).alias("_hot"))
    spread_key = F.concat(F.lit("\0"), F.xxhash64(spread_by).cast("string"))
    marked = keyed.join(F.broadcast(heavy), "_key", "left").withColumn(
        "_key", F.when(F.col("_hot").isNull(), F.col("_key")).otherwise(spread_key)
    )
    if parts:
        marked = marked.repartition(parts, "_key")
    joined = marked.join(packed, "_key", "left")
    out = joined.select(*left.columns, F.coalesce("_hot", "_found").alias("_value"))
    if how == "inner":
        out = out.filter(F.col("_value").isNotNull())
    return out.select(*left.columns, *[F.col("_value")[v].alias(v) for v in values])
