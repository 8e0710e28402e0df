"""Exact deduplication as a stream with disk-backed keyed state that never expires.

Per digest the state keeps how many documents had it and which one stays, with that one's
identifier and the locator of its content (file and row).  Arrivals are aggregated before the
shuffle, so a text that a third of all documents share reaches the state as one row per task.
Digests that were hit by more than one document are then checked on full bytes, again by
partial aggregates, and are split by text should a digest ever stand for two texts.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import located, set_aside, stored
from sensorloom.session import new_path

BLANKS = r"[\x20\x09-\x0D]"
# Settings of the state: on disk, without space allocated ahead for stores that hold little.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without white space of ASCII; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def arrivals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What the stream sees of a document: digest, length in code points, identifier, locator."""
    return docs.select(
        F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        F.col(id_col).cast("long").alias("doc_id"),
        "_file",
        "_row",
    )


def _rank() -> Column:
    """Smallest for the document that stays: most code points, smallest identifier (null last), then place."""
    return F.struct((-F.col("n_chars")).alias("order"), F.col("doc_id").isNull().alias("anonymous"), "doc_id", "_file", "_row")


def keyed_state(stream: DataFrame) -> DataFrame:
    """The streaming aggregate over ``arrivals``: no watermark, so a key's state is kept for good."""
    return stream.groupBy("digest").agg(F.min(_rank()).alias("keep"), F.count(F.lit(1)).alias("n"))


@contextmanager
def _on_disk(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_stream(spark: SparkSession, log: str, schema, checkpoint: str, **options: str) -> DataFrame:
    """Feed all files of ``log`` that are new to ``checkpoint`` to the state, and return the state.

    Calling it again with the same checkpoint goes on where the last call ended.
    """
    with _on_disk(spark):
        stream = spark.readStream.schema(schema).options(**options).parquet(log)
        run = keyed_state(stream).writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    keep, n = state.schema["value"].dataType.names
    return state.select("key.digest", F.col(f"value.`{keep}`").alias("keep"), F.col(f"value.`{n}`").alias("n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``_file``, ``_row``.

    Null and empty texts are equal.  Of repeated rows, equal in identifier and text, the first in
    its file stays.  An empty table gives an empty result; other columns aren't read.
    """
    spark = docs.sparkSession
    place = located(docs.select(id_col, text_col))
    log = stored(arrivals(place, id_col, text_col), "arrivals")
    path = log.inputFiles()
    if not path:
        state = keyed_state(log).select("digest", "keep", "n")
    else:
        state = stored(run_stream(spark, path[0].rsplit("/", 1)[0], log.schema, new_path(spark, "state")), "state")
    # Full bytes of the hits: a digest's smallest and largest text are one text, or the digest fails.
    # Hits are found on narrow rows, and their texts by place, so that no digest gathers texts.
    texts = place.select(normalised(F.col(text_col)).alias("text"), "_file", "_row")
    hits = log.join(state.filter("n > 1").select("digest"), "digest", "left_semi").select("digest", "_file", "_row")
    spans = texts.join(hits, ["_file", "_row"]).groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    false = stored(spans.filter("low <> high").select("digest"), "false-hits")
    groups = log.join(state, "digest")
    if not false.isEmpty():
        apart = texts.join(log.join(false, "digest", "left_semi"), ["_file", "_row"])
        kept = apart.groupBy("digest", "text").agg(F.min(_rank()).alias("keep"), F.count(F.lit(1)).alias("n"))
        groups = groups.join(false, "digest", "left_anti").unionByName(apart.join(kept, ["digest", "text"]).drop("text"))
    return groups.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("keep._file") == F.col("_file")) & (F.col("keep._row") == F.col("_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "_file",
        "_row",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever their names."""
    mine, back = set_aside(docs, doc_id=id_col, text=text_col)
    groups = exact_groups(mine)
    return back(located(mine).join(groups.filter("kept").select("_file", "_row"), ["_file", "_row"], "left_semi"))
