"""Document fingerprints by consistent weighted sampling.

A document is a bag of words, each weighted by how often it occurs.  For every sample ``i`` a
term has two Gamma(2, 1) numbers ``r`` and ``c`` and a uniform ``b``, all drawn from a hash of the
term; with weight ``w`` it gets ``t = floor(ln w / r + b)`` and ``a = c exp(-r (t - b + 1))``.
The sample is the ``(term, t)`` with the smallest ``a``, which is known by that ``a``.  Two documents agree in a sample with a
probability equal to their generalised Jaccard similarity, the sum of the smaller weights over
the sum of the larger.

Documents lie in blocks along their order, so each meets the next one without a join.  Within a
block every distinct (term, weight) is sampled once, for all documents that have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import SPACE, partitions
from sensorloom.operators.ordered import block_of

SAMPLES = 64
LANE = 8
# A document's terms take several times the space of its text; tasks are that much smaller.
TASKS = 4


def _gamma(bits: Column) -> Column:
    """A Gamma(2, 1) number: the negative logarithm of a product of two uniform ones, of 32 bits each."""
    high, low = F.shiftrightunsigned(bits, 32), bits.bitwiseAND(F.lit(0xFFFFFFFF))
    return -F.ln((high.cast("double") + F.lit(0.5)) * (low.cast("double") + F.lit(0.5)) * F.lit(2.0**-64))


def sample_of(key: Column, log_weight: Column, number: int) -> Column:
    """The number ``a`` above, for sample ``number`` of a lane; the smallest one is the sample and stands for its ``(term, t)``.

    ``key`` is a hash of the term and the lane, of which three more give all draws.
    """
    draws = [((3 * number + i + 1) * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63) for i in range(3)]
    bits = [F.xxhash64(key.bitwiseXOR(F.lit(d))) for d in draws]
    r, c = _gamma(bits[0]), _gamma(bits[1])
    b = (F.shiftrightunsigned(bits[2], 12).cast("double") + F.lit(0.5)) * F.lit(2.0**-52)
    t = F.floor(log_weight / r + b)
    return c * F.exp(r * (b - F.lit(1.0) - t))


def _terms(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows ``keys, term, weight``: hashed words of ``text`` and how often they occur."""
    word = df.select(*keys, F.explode(F.split("text", SPACE)).alias("word")).filter(F.col("word") != "")
    return word.select(*keys, F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("weight"))


def signatures(texts: DataFrame) -> DataFrame:
    """Samples of every text: rows ``block, item, signature`` (``SAMPLES`` numbers of 32 bits) from ``block, item, text``.

    ``texts`` should already be dealt by ``block``; nothing is shuffled then.  Texts without words
    have no row.
    """
    shared = _terms(texts, ["block", "item"]).groupBy("block", "term", "weight").agg(F.collect_list("item").alias("items"))
    lanes = shared.withColumn("log_weight", F.ln("weight")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // LANE - 1))))
    keyed = lanes.select("block", "items", "lane", "log_weight", F.xxhash64("term", "lane").alias("key"))
    numbers = [f"s{j}" for j in range(LANE)]
    drawn = keyed.select("block", "items", "lane", *[sample_of(F.col("key"), F.col("log_weight"), j).alias(n) for j, n in enumerate(numbers)])
    rows = drawn.select("block", "lane", F.explode("items").alias("item"), *numbers)
    least = rows.groupBy("block", "item", "lane").agg(*[F.min(n).alias(n) for n in numbers])
    digits = F.array(*[F.xxhash64(n).bitwiseAND(F.lit(0xFFFFFFFF)) for n in numbers])
    lists = least.groupBy("block", "item").agg(F.array_sort(F.collect_list(F.struct("lane", digits.alias("v")))).alias("lanes"))
    return lists.select("block", "item", F.flatten("lanes.v").alias("signature"))


def as_text(signature: Column) -> Column:
    """A fingerprint as a string: eight hexadecimal digits per sample; empty for a text without words."""
    digits = F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of samples that agree; two texts without words are alike, one of them alone is unlike any."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SAMPLES))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``block, no, guest, doc_id, text, next_text`` along ``id_col`` (null first), each with the next one's text.

    The order is cut into blocks at quantiles that occur as ids.  A block also gets, as its last
    row, a guest: a copy of the next block's first document; the last block gets the first
    document of all.  So neighbours always share a block.  Rows with one id are ordered by text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tasks = TASKS * partitions(docs.sparkSession)
    n = 4 * tasks
    quantiles = F.percentile_approx("doc_id", F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(10 * n))
    low, nulls, points = rows.select("doc_id").agg(F.min("doc_id"), F.count_if(F.col("doc_id").isNull()), quantiles).first()
    splits = sorted(set(points or []) - ({low} if not nulls else set()))
    own = block_of(rows, ["doc_id"], [(s,) for s in splits]) if splits else F.lit(0)
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(own)
    opens = F.col("doc_id").isin(*splits) if 0 < len(splits) else F.lit(False)
    first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(low)
    seats = F.filter(
        F.array(
            F.struct(own.alias("block"), F.lit(False).alias("guest")),
            F.when(opens, F.struct((own - 1).alias("block"), F.lit(True).alias("guest"))),
            F.when(first, F.struct(F.lit(len(splits)).alias("block"), F.lit(True).alias("guest"))),
        ),
        lambda s: s.isNotNull(),
    )
    # A block that can't be null keeps filters for it off the shuffle, which every reader of these rows then shares.
    block = F.coalesce(F.col("seat.block"), F.lit(0)).alias("block")
    dealt = rows.withColumn("seat", F.explode(seats)).select(block, F.coalesce("seat.guest", F.lit(False)).alias("guest"), "doc_id", "text").repartition(tasks, "block")
    along = Window.partitionBy("block").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.select("block", F.row_number().over(along).cast("long").alias("no"), "guest", "doc_id", "text", F.lead("text").over(along).alias("next_text"))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half, rounded down, replaced by as many first code points of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  A null text counts as empty; words are separated by ASCII white space; a text
    without words has an empty fingerprint.  A single document is its own next one.  An empty
    table gives an empty result; other columns aren't read.
    """
    rows = with_next(docs, id_col, text_col)
    # Items 2 no (the text) and 2 no + 1 (the edited text); a guest has its own text only.
    both = F.when(F.col("guest"), F.array(F.struct((2 * F.col("no")).alias("item"), "text"))).otherwise(
        F.array(F.struct((2 * F.col("no")).alias("item"), F.col("text").alias("text")), F.struct((2 * F.col("no") + 1).alias("item"), edited(F.col("text"), F.col("next_text")).alias("text")))
    )
    prints = signatures(rows.select("block", F.explode(both).alias("x")).select("block", "x.item", "x.text"))
    by_no = prints.groupBy("block", F.floor(F.col("item") / 2).alias("no")).agg(
        F.max(F.when(F.col("item") % 2 == 0, F.col("signature"))).alias("own"), F.max(F.when(F.col("item") % 2 == 1, F.col("signature"))).alias("changed")
    )
    facts = rows.select(
        "block", "no", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.when(~F.col("guest"), edited(F.col("text"), F.col("next_text"))), 256).alias("edited_sha256")
    )
    along = Window.partitionBy("block").orderBy("no")
    found = facts.join(by_no, ["block", "no"], "left").withColumn("next", F.lead("own").over(along))
    return found.filter(~F.col("guest")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
