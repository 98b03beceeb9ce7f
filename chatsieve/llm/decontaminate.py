"""Documents that contain passages of a benchmark, found by spaced seeds.

A seed hashes the words that a fixed mask selects from nine consecutive words and
ignores the others, so a substituted word breaks only the seeds that select it. Seeds
of documents and items meet in an equi join; around every hit the item is laid along
the document on the same diagonal, and the best stretch of the overlap is scored with
+1 for an equal word and -2 for a substituted one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.words import ascii_words

MASKS = ((0, 1, 3, 4, 6, 8), (0, 2, 3, 5, 7, 8))
MIN_SCORE, MIN_SHARE = 12, 0.7
#: Seeds that are broadcast at most, 24 bytes each. Of k masks that span n words, an item
#: has at most n / k words a seed, so the items that go along are bounded too, at 8 n / k
#: bytes a seed.
BROADCAST_SEEDS = 1_000_000


def _hashed(table: DataFrame, key: str, words: str) -> DataFrame:
    """(key, words): a hash for every word, NULL for an empty piece at an end."""
    split = table.select(F.col(key).cast("long").alias(key), ascii_words("text").alias("w"))
    return split.select(key, F.transform("w", lambda w: F.when(w != "", F.xxhash64(w))).alias(words))


def _seeds(table: DataFrame, words: str, masks, *keep: str) -> DataFrame:
    """A row per word position and mask: (keep..., words, at, seed). The generator is the
    outer one because the plain one adds a filter that splits every text again."""
    span = 1 + max(max(m) for m in masks)
    at = table.select(*keep, words, F.posexplode_outer(words).alias("at", "_")).where(F.col("at") <= F.size(words) - span)
    made = [F.xxhash64(F.lit(k), *[F.get(words, F.col("at") + o) for o in mask]) for k, mask in enumerate(masks)]
    return at.select(*keep, words, "at", F.explode(F.array(*made)).alias("seed"))


def _stretch(doc: str, item: str, shift: Column) -> Column:
    """Best stretch of the item laid along the document: (score, matched)."""
    step = F.transform(
        F.sequence(F.lit(0), F.size(item) - 1),
        lambda j: F.coalesce(F.get(doc, shift + j) == F.get(item, j), F.lit(False)),
    )
    zero = F.lit(0)
    start = F.struct(zero.alias("score"), zero.alias("matched"), zero.alias("here"), zero.alias("hits"))

    def move(acc: Column, same: Column) -> Column:
        here = acc["here"] + F.when(same, 1).otherwise(-2)
        hits = acc["hits"] + F.when(same, 1).otherwise(0)
        here, hits = F.greatest(here, zero), F.when(here > 0, hits).otherwise(zero)
        better = here > acc["score"]
        return F.struct(
            F.when(better, here).otherwise(acc["score"]).alias("score"),
            F.when(better, hits).otherwise(acc["matched"]).alias("matched"),
            here.alias("here"),
            hits.alias("hits"),
        )

    return F.aggregate(step, start, move)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    masks=MASKS,
    min_score: int = MIN_SCORE,
    min_share: float = MIN_SHARE,
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """(doc_id, item_id, start, matched, item_words, score), one row per document and item.

    An item counts where its best stretch scores ``min_score``, or ``min_share`` of its
    words if those are fewer. ``start`` is the document's word at which the item's first
    word lies (negative where the document has only a later part).

    Up to ``broadcast_seeds`` seeds of the benchmark are sent to the documents, and the
    words of each item once, so documents are verified where they are read, without a shuffle. Beyond it, both sides are
    shuffled by seed, and words join the distinct hits afterwards; results are the same.

    NULL and empty texts, NULL ids and texts or items of fewer words than a mask spans
    give no rows. Repeated rows of an id count as one. Other columns are not looked at.
    """
    items = _hashed(benchmark, "item_id", "item").where("item_id IS NOT NULL")
    items = items.select("item_id", F.array_compact("item").alias("item"))
    items = items.where(F.size("item") >= 1 + max(max(m) for m in masks))
    items = items.select(F.xxhash64("item_id", "item").alias("item_key"), "item_id", "item").dropDuplicates(["item_key"])
    wanted = _seeds(items, "item", masks, "item_key").drop("item").withColumnRenamed("at", "item_at").distinct()
    texts = _hashed(docs, "doc_id", "words").where("doc_id IS NOT NULL")
    found = _seeds(texts, "words", masks, "doc_id")
    shift = F.col("at") - F.col("item_at")
    if wanted.count() <= broadcast_seeds:
        hits = found.join(F.broadcast(wanted), "seed").select("doc_id", "item_key", "words", shift.alias("start"))
        hits = hits.join(F.broadcast(items), "item_key")
    else:
        hits = found.drop("words").join(wanted, "seed")
        hits = hits.select("doc_id", "item_key", shift.alias("start")).distinct().join(items, "item_key").join(texts, "doc_id")
    best = hits.select(
        "doc_id", "item_id", "start", F.size("item").alias("item_words"), F.inline(F.array(_stretch("words", "item", F.col("start"))))
    )
    enough = F.least(F.lit(min_score), F.ceil(F.lit(min_share) * F.col("item_words")))
    best = best.where(F.col("score") >= enough)
    top = best.groupBy("doc_id", "item_id", "item_words").agg(
        F.max(F.struct("score", "matched", (-F.col("start")).alias("at"))).alias("t")
    )
    return top.select(
        "doc_id", "item_id", (-F.col("t.at")).alias("start"), F.col("t.matched").alias("matched"), "item_words", F.col("t.score").alias("score")
    )
