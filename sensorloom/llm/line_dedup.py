"""Lines that many documents share are dropped from all of them.

Normalised lines are exploded and hashed (128 bits), documents are counted per hash, lines of
hashes over the threshold are dropped, and the others are put together again by position.

The lines of a document are made distinct inside its row, so counting is one shuffle of hashes
with partial counts: a line that a third of all documents hold reaches it as one row per task.
Frequent hashes above ``1 / HOT_PART`` of all counted rows are at most ``HOT_PART`` and are
broadcast; the others have few rows each and are joined by hash.  What travels of a document's
lines is hashes and positions; its text is shuffled once, to the positions it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import located, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCS, MIN_CHARS = 10, 1
HOT_PART = 4096


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed(rows: DataFrame, key: str, min_chars: int) -> DataFrame:
    """Replace the column of keys by two hashes; keys that are too short are left out."""
    keep = [c for c in rows.columns if c != key]
    return rows.filter(F.length(key) >= min_chars).select(*keep, F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def frequent(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, n``: hashes of keys that at least ``min_docs`` documents hold, and the number of these."""
    keys = docs.select(F.explode(F.array_distinct(F.split(_keyed(F.col(text_col)), "\n", -1))).alias("key"))
    return _hashed(keys, "key", min_chars).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)


def _keyed(text: Column) -> Column:
    """The text with every line replaced by its key, in passes over the whole text."""
    inner = r"[\x20\x09\x0B-\x0D]"
    # A run of blanks is tried from its start only, so the pass is linear.
    ends = F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?<!{inner}){inner}++(?=\n|\z)|(?<=\n){inner}++|\A{inner}++", "")
    return F.translate(ends, UPPER, LOWER)


def dropped(docs: DataFrame, shared: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``_file, _row, at``: sorted positions (from 1) of the lines a located document loses."""
    lines = docs.select("_file", "_row", F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
    rows = _hashed(lines.select("_file", "_row", "pos", line_key(F.col("line")).alias("key")), "key", min_chars)
    parted = shared.withColumn("hot", F.col("n") * HOT_PART > shared.agg(F.sum("n")).scalar())
    hot = F.broadcast(parted.filter("hot").select("h1", "h2", "hot"))
    few = parted.filter("NOT hot").select("h1", "h2", F.lit(True).alias("found"))
    # Rows of hot hashes are decided here, and spread over the join by their place.
    apart = F.when(F.col("hot"), F.xxhash64("_file", "_row", "pos")).otherwise(F.col("h1"))
    marked = rows.join(hot, ["h1", "h2"], "left").withColumn("h1", apart)
    lost = marked.join(few, ["h1", "h2"], "left").filter("hot OR found")
    return lost.groupBy("_file", "_row").agg(F.array_sort(F.collect_list(F.col("pos") + 1)).alias("at"))


def _without(lines: Column, at: Column) -> Column:
    """Lines but those at the positions: the stretches between positions, each sliced once."""
    before = F.concat(F.array(F.lit(0)), at)
    after = F.concat(at, F.array(F.size(lines) + 1))
    stretches = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("from"), (b - a - 1).alias("n")))
    return F.flatten(F.transform(stretches, lambda s: F.slice(lines, s["from"], s["n"])))


def line_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: every document's lines that are not shared by many, joined by ``\\n``.

    A line's key is the line without ASCII white space at its ends and with A-Z in lower case.  Keys of
    at least ``min_chars`` code points that at least ``min_docs`` rows hold lose all their lines.
    A null or empty text is one empty line, whose key is empty.  ``kept`` is empty when all
    lines go.  Rows are documents of their own, also with repeated or null ids.  An empty table gives an
    empty result; other columns aren't read.
    """
    whole = located(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    shared = stored(frequent(whole, "text", min_docs, min_chars), "frequent-lines")
    lost = dropped(whole, shared, "text", min_chars)
    # The lines are cut before the join, so that slices don't cut them again.
    each = whole.select("doc_id", lines_of(F.col("text")).alias("lines"), "_file", "_row")
    both = each.join(lost, ["_file", "_row"], "left")
    kept = F.when(F.col("at").isNull(), F.col("lines")).otherwise(_without(F.col("lines"), F.col("at")))
    return both.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("at"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )
