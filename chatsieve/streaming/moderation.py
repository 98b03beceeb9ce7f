"""Moderation of a live chat with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatsieve.functions.text import text_key
from chatsieve.operators.evaluate import band_columns, rate_verdict
from chatsieve.operators.models import score
from chatsieve.operators.rules import censor, rule_flag
from chatsieve.operators.term_models import TermModel
from chatsieve.session import scratch_path


def stream_moderate(
    stream: DataFrame, words: Iterable[str], mode: str = "boundary", text: str = "text"
) -> DataFrame:
    """Flag and censor every message on its way; stateless, so append mode."""
    return censor(rule_flag(stream, words, mode, text), words, mode, text=text)


def stream_score(stream: DataFrame, model: PipelineModel | TermModel) -> DataFrame:
    """The same with a fitted model in place of a word list, also one whose weights are a table."""
    return score(stream, model)


def stream_flag_rate(
    flagged: DataFrame,
    window: str = "1 hour",
    delay: str = "10 minutes",
    low: float = 0.001,
    high: float = 0.01,
    bands: Mapping[str, tuple[float, float]] | None = None,
    ts: str = "ts",
    key: str = "lang",
) -> DataFrame:
    """Flag rate per key and window, with an alert outside the expected band. A window
    is reported once it is closed; rows later than the watermark are dropped."""
    lows, highs = band_columns(F.col(key), low, high, bands)
    rate = F.col("flagged") / F.col("total")
    return (
        flagged.withWatermark(ts, delay)
        .groupBy(F.window(ts, window), key)
        .agg(F.count("*").alias("total"), F.count_if("flagged").alias("flagged"))
        .select(
            F.col("window.start").alias("window_start"),
            key,
            "total",
            "flagged",
            F.round(rate, 6).alias("rate"),
            rate_verdict(rate, lows, highs).alias("verdict"),
        )
    )


def _first_copies(batches: Iterator[pa.RecordBatch], ts: str) -> Iterator[pa.RecordBatch]:
    """The first row of each text in one part of a micro-batch, and the row of the latest time,
    which the watermark needs."""
    seen: set = set()
    latest, late_row = None, None
    for batch in batches:
        keys, times = batch.column("text_key").to_pylist(), batch.column(ts).cast(pa.int64()).to_pylist()
        fresh = []
        for at, (key, time) in enumerate(zip(keys, times, strict=True)):
            new = key not in seen
            seen.add(key)
            fresh.append(new)
            if time is not None and (latest is None or time > latest):
                latest, late_row = time, None if new else batch.slice(at, 1)
        yield batch.filter(pa.array(fresh, pa.bool_()))
    if late_row is not None:
        yield late_row


def first_copies(keyed: DataFrame, ts: str = "ts") -> DataFrame:
    """Combine the copies in each part of a micro-batch before they are shuffled, so that a text
    that everybody sends is two rows per part at most. Holds a digest per distinct text."""
    return keyed.mapInArrow(lambda it: _first_copies(it, ts), keyed.schema)


def stream_dedupe(stream: DataFrame, horizon: str = "1 hour", text: str = "text", ts: str = "ts") -> DataFrame:
    """Pass the first of each distinct text; repeats are dropped until the watermark is the
    horizon past it, as ``dropDuplicatesWithinWatermark`` does. Copies of one micro-batch
    are combined before the shuffle; there is one state per text."""
    keyed = stream.withColumn("text_key", text_key(F.col(text)))
    return first_copies(keyed, ts).withWatermark(ts, horizon).dropDuplicatesWithinWatermark(["text_key"])


def run_to_table(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet table; with ``once`` it takes what is there and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over the input at hand and read back the table it wrote."""
    spark = stream.sparkSession
    path, schema = scratch_path(spark, name), stream.schema
    run_to_table(stream, f"{path}/table", f"{path}/state").awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/table")
