"""Synchronisation of topics: masks, reports, attachment of payloads, fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.asof import GRID_BLOCK, match_nearest, with_single
from sensorloom.operators.ordered import index_rows, split_points
from sensorloom.operators.skew import join_skewed
from sensorloom.session import cut_lineage


def choose_stamp(log_time: str, stamp: str, use_log_time: bool = False) -> Column:
    """Header stamp, or the log time for headerless messages or when forced."""
    return F.col(log_time) if use_log_time else F.coalesce(F.col(stamp), F.col(log_time))


def within_tolerance(matches: DataFrame, tol: int) -> DataFrame:
    """Keep matches strictly closer than ``tol``."""
    return matches.filter(F.col("err") < tol)


def valid_steps(
    matches: DataFrame,
    tol: int,
    keys: list[str] = (),
    t_min: Column | None = None,
    t_max: Column | None = None,
) -> DataFrame:
    """One row per grid step with ``valid``: every topic in tolerance and inside the transform interval."""
    ok = F.col("err").isNotNull() & (F.col("err") < tol)
    if t_min is not None:
        ok = ok & (F.col("match") > t_min)
    if t_max is not None:
        ok = ok & (F.col("match") < t_max)
    return matches.groupBy(*keys, "idx", "target").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("valid"))


def compact(steps: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Keep valid steps and number them 0, 1, … in time order as ``frame``."""
    block = F.floor(F.col("idx") / GRID_BLOCK).cast("int")
    return index_rows(steps.filter("valid"), list(keys), ["target"], "frame", block)


def sync_report(matches: DataFrame, tol: int, keys: list[str] = ()) -> DataFrame:
    """Kept and total steps, and steps out of tolerance per topic."""
    keys = list(keys)
    steps = valid_steps(matches, tol, keys)
    total = steps.groupBy(*keys).agg(F.count_if("valid").alias("kept"), F.count(F.lit(1)).alias("total"))
    bad = matches.groupBy(*keys, "topic").agg(
        F.count_if(F.coalesce(F.col("err") >= tol, F.lit(True))).alias("bad")
    )
    if keys:
        return bad.join(total, keys)
    return with_single(bad, total)


def interval_edges(steps: DataFrame, t_min: Column, t_max: Column, keys: list[str] = ()) -> DataFrame:
    """First step after ``t_min`` and last step before ``t_max``."""
    return steps.groupBy(*keys).agg(
        F.min(F.when(F.col("target") > t_min, F.col("idx"))).alias("first_idx"),
        F.max(F.when(F.col("target") < t_max, F.col("idx"))).alias("last_idx"),
    )


def attach_payload(matches: DataFrame, messages: DataFrame, keys: list[str], payload: list[str], seq: str = "seq") -> DataFrame:
    """Give every matched step the payload of its stamp; of equal stamps the last logged wins.

    Winners are found on key columns alone.  Payloads are read last, and only those of
    winning messages pass the join, so most of the log is never aggregated.  The matches are
    stored first, since the wanted stamps, the count of hot ones and the result all need them.
    """
    found = cut_lineage(matches.filter(F.col("match").isNotNull()))
    stamps = messages.select(*keys, F.col("t").alias("match"), seq)
    wanted = stamps.join(found.select(*keys, "match").distinct(), [*keys, "match"], "left_semi")
    winners = wanted.groupBy(*keys, "match").agg(F.max(seq).alias("_win"))
    content = messages.select(*keys, F.col("t").alias("match"), F.col(seq).alias("_win"), F.struct(*payload).alias("_p"))
    last = content.join(winners, [*keys, "match", "_win"])
    # A topic that falls silent leaves one stamp matched by all later steps.
    return join_skewed(found, last, [*keys, "match"], ["idx"], "inner").select(
        *matches.columns, *[F.col("_p").getField(c).alias(c) for c in payload]
    )


def fan_out(messages: DataFrame, catalog: DataFrame) -> DataFrame:
    """One output row per message and catalogue entry that reads its topic."""
    return messages.join(catalog, "topic")


def latest_per_key(messages: DataFrame, keys: list[str], payload: list[str], seq: str = "seq") -> DataFrame:
    """The last logged payload per key; payloads are read for the winners only."""
    last = messages.groupBy(*keys).agg(F.max(seq).alias(seq))
    return messages.select(*keys, seq, *payload).join(last, [*keys, seq])


def camera_info_topic(topic: Column) -> Column:
    """Calibration topic that belongs to an image topic."""
    # The image suffixes that are stripped, and the calibration suffix.
    for suffix in ("/image_raw/compressed", "/image/compressed", "/compressed"):
        topic = F.replace(topic, F.lit(suffix), F.lit(""))
    return F.concat(topic, F.lit("/camera_info"))


def mutual_pairs(pivot: DataFrame, other: DataFrame, keys: list[str], slop: int, splits: list | None = None) -> DataFrame:
    """Pairs of pivot and other messages that are each other's nearest within ``slop``.

    Returns ``keys, t, seq, o_t, o_seq``.  Stamps count once per side (first in log order).
    """
    def firsts(df):
        return df.groupBy(*keys, "t").agg(F.min("seq").alias("seq"))

    p, o = firsts(pivot), firsts(other)
    to_other = match_nearest(p, o, keys, cutoff=slop, splits=splits).select(
        *keys, "t", F.col("match.t").alias("o_t"), F.col("match.s").alias("o_seq")
    )
    to_pivot = match_nearest(o, p, keys, cutoff=slop, splits=splits).select(
        *keys, F.col("match.t").alias("t"), F.col("t").alias("o_t"), F.col("match.s").alias("seq")
    )
    return to_other.join(to_pivot, [*keys, "t", "o_t"]).select(*keys, "t", "seq", "o_t", "o_seq")


def approximate_sync(messages: DataFrame, keys: list[str], topics: list[str], slop: int) -> DataFrame:
    """Sets with one message per topic whose stamps spread at most ``slop``.

    The first topic is the pivot.  A set forms where pivot and candidate of every other topic
    are mutually nearest, so no message is used twice.
    """
    pivot_topic, *others = topics
    pivot = messages.filter(F.col("topic") == pivot_topic)
    splits = split_points(messages, ["t"])
    out = None
    lo, hi = F.col("t"), F.col("t")
    for i, topic in enumerate(others, 1):
        pairs = mutual_pairs(pivot, messages.filter(F.col("topic") == topic), keys, slop, splits)
        pairs = pairs.select(*keys, "t", "seq", F.col("o_t").alias(f"t_{i}"), F.col("o_seq").alias(f"seq_{i}"))
        out = pairs if out is None else out.join(pairs, [*keys, "t", "seq"])
        lo, hi = F.least(lo, F.col(f"t_{i}")), F.greatest(hi, F.col(f"t_{i}"))
    return out.filter(hi - lo <= slop).withColumn("spread", hi - lo)
