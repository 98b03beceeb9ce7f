"""URL captures judged by the list entries that were in force when they were fetched.

Dated changes of lists (an entry is added or removed on a day) become validity intervals;
every capture then meets the entries for its host and for the domains above it as of its
fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatsieve.llm.tables import settled

#: Intervals that are broadcast at most, about 100 bytes each.
BROADCAST_INTERVALS = 200_000


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; NULL where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)), F.lit(""))


def intervals(changes: DataFrame) -> DataFrame:
    """(list, verdict, domain, since, until) from (list, verdict, domain, at, active): an entry
    holds from an addition to its next change; ``until`` is NULL where none follows. A
    repeated addition prolongs, a removal of what is not there does nothing. Of changes at
    one time the removal wins. Changes without list, domain or time count for nothing.
    Domains are compared in lower case and without a dot at the end."""
    known = changes.where("list IS NOT NULL AND domain IS NOT NULL AND at IS NOT NULL")
    known = known.withColumn("domain", F.lower(F.regexp_replace("domain", r"\.$", "")))
    known = known.groupBy("list", "domain", "at").agg(
        F.min(F.coalesce("active", F.lit(False))).alias("active"), F.max("verdict").alias("verdict")
    )
    steps = known.selectExpr(
        "list", "verdict", "domain", "at AS since", "active",
        "lead(at) OVER (PARTITION BY list, domain ORDER BY at) AS until",
    )
    return steps.where("active").drop("active")


def judge(captures: DataFrame, changes: DataFrame, broadcast_intervals: int = BROADCAST_INTERVALS) -> DataFrame:
    """(page_id, host, fetched_at, n_active, lists, matched, verdict) per capture (page_id, url,
    fetched_at).

    The longest active domain decides (``matched``); where an allowing and a blocking entry
    are equally long, allowing wins; ``verdict`` is "none" without an active entry.
    ``lists`` names all lists with one, sorted. A capture without a host or a fetch time
    meets no entry; a dot at the end of a host does not matter. Repeated rows give a row
    each, an empty table none; without changes every verdict is "none". Other columns, also
    of the names used here, are not looked at.

    Captures are first reduced to their distinct (host, fetch time), which are judged once
    and joined back; a host with a third of all captures is so judged once a day. Intervals
    are broadcast while they are few; beyond that both joins are equi joins on the domain,
    whose large parts Spark can split.
    """
    given = captures.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), "fetched_at"
    )
    asked = given.where("host IS NOT NULL AND fetched_at IS NOT NULL").select("host", "fetched_at").distinct()
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(0), F.size(labels) - 1), lambda k: F.array_join(F.slice(labels, k + 1, F.size(labels)), ".")
    )
    # A dot at the end of a host leaves an empty label, which is no domain of a list.
    bare = F.transform(above, lambda d: F.regexp_replace(d, r"\.$", ""))
    steps = asked.select("host", "fetched_at", F.explode_outer(F.array_distinct(bare)).alias("domain"))
    listed = settled(intervals(changes), "intervals")
    if listed.count() <= broadcast_intervals:
        listed = F.broadcast(listed)
    active = steps.join(listed, "domain").where("since <= fetched_at AND (until IS NULL OR fetched_at < until)")
    rank = F.struct(F.length("domain").alias("size"), (F.col("verdict") == "allow").alias("allows"), "domain", "verdict")
    judged = active.groupBy("host", "fetched_at").agg(
        F.count("*").alias("n_active"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.max(rank).alias("top")
    )
    joined = given.join(judged, ["host", "fetched_at"], "left")
    return joined.select(
        "page_id",
        "host",
        "fetched_at",
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("top.domain").alias("matched"),
        F.coalesce("top.verdict", F.lit("none")).alias("verdict"),
    )
