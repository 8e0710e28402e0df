"""Mixing sources to target sizes by pivotal dependent rounding.

Every document of a source should be taken the same number of times, which is seldom a whole
number.  Whole copies are given; the fractions left over are rounded dependently: two
documents meet, and words move from one fraction to the other, in a random direction that
keeps both expectations, until one fraction is 0 or 1.  The other goes on.  Words are kept in
every meeting, so a source ends within one document of its target.

The meetings form a reduction tree.  Documents are dealt to leaves of about ``FAN_IN``; a leaf
leaves at most one fraction, and the fractions left by ``FAN_IN`` leaves meet in the next
level.  Within a leaf large documents meet first, so what is left in the end is a small one.  A source with a third of all documents has that many more leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import SPACE, located, set_aside, stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
FAN_IN = 64
EPSILON = 1e-9


def words(text: Column) -> Column:
    """Number of words; null counts as empty."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    n = F.size(parts)
    ends = (F.get(parts, F.lit(0)) == "").cast("int") + ((n > 1) & (F.get(parts, n - 1) == "")).cast("int")
    return (n - ends).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``target`` to rows ``source, source_size``: shares by weight, none above ``most`` times its size.

    Sources take ``weights`` in turn, by code point, null last.  What a stopped source leaves is
    shared again by weight, which comes to one rate for all that aren't stopped: sources stop in
    order of size per weight, as long as the rate of the rest reaches them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sources.withColumn("w", turn).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    up_to = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    stopped_before, weight_before = F.coalesce(F.sum("cap").over(up_to), F.lit(0.0)), F.coalesce(F.sum("w").over(up_to), F.lit(0.0))
    total = F.sum("source_size").over(every) * F.lit(float(share))
    rate = (total - stopped_before) / (F.sum("w").over(every) - weight_before)
    found = ranked.withColumn("rate", rate).withColumn("stops", F.col("cap") <= F.col("rate") * F.col("w"))
    # The rate of the first source that isn't stopped holds for all after it.
    holds = F.min(F.when(~F.col("stops"), F.struct((F.col("cap") / F.col("w")).alias("order"), "rate"))).over(every)["rate"]
    return found.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(F.least("cap", holds * F.col("w")))).drop("w", "cap", "rate", "stops")


def _meet(level: int, seed: int):
    """One meeting: the fraction that goes on (``open``) against the next of the leaf."""

    def step(state: Column, new: Column) -> Column:
        old = state["open"]
        a, b = old["p"] * old["size"], new["p"] * new["size"]
        gain = F.least(old["size"] - a, b)  # words that can move to the old one
        loss = F.least(a, new["size"] - b)
        u = F.pmod(F.xxhash64(old["key"], new["key"], F.lit(level), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        move = F.when(u * (gain + loss) < loss, gain).otherwise(-loss)
        p, q = (a + move) / old["size"], (b - move) / new["size"]

        def whole(x: Column) -> Column:
            return F.when(x < EPSILON, 0.0).when(x > 1 - EPSILON, 1.0).otherwise(x)

        p, q = whole(p), whole(q)
        is_open = lambda x: (x > 0) & (x < 1)
        one, two = _item(old["key"], old["size"], p), _item(new["key"], new["size"], q)
        closed = F.when(is_open(p), F.array(two)).when(is_open(q), F.array(one)).otherwise(F.array(one, two))
        left = F.when(is_open(p), one).when(is_open(q), two)
        first = old.isNull()
        return F.struct(F.when(first, new).otherwise(left).alias("open"), F.when(first, state["done"]).otherwise(F.concat(state["done"], closed)).alias("done"))

    return step


def _item(key: Column, size: Column, p: Column) -> Column:
    return F.struct(size.alias("size"), key.alias("key"), p.alias("p"))


ITEM = "struct<size:double,key:string,p:double>"


def pivotal(items: DataFrame, seed: int = 0, fan_in: int = FAN_IN) -> DataFrame:
    """Round fractions ``p`` of rows ``grp, key, size, p`` (0 < p < 1, size > 0) to 0 or 1.

    ``key`` is a string, unique in its group.  Returns ``grp, key, taken``; the sum of
    ``p * size`` over a group changes by less than one row's size, each row is taken with
    probability ``p``, and reruns agree.
    """
    done, level = None, 0
    while True:
        # As many leaves as a group needs; rows are dealt by a hash of their key.
        per_group = items.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        per_group = stored(per_group, "mix-groups")
        last = per_group.agg(F.max("n")).first()[0]
        if last is None:
            break
        leaves = items.join(per_group.withColumnRenamed("grp", "_g"), F.col("grp").eqNullSafe(F.col("_g"))).select(
            "grp",
            F.when(F.col("n") <= 2 * fan_in, F.lit(0)).otherwise(F.pmod(F.xxhash64("key", F.lit(level), F.lit(seed)), F.ceil(F.col("n") / fan_in))).alias("leaf"),
            _item(F.col("key"), F.col("size").cast("double"), F.col("p").cast("double")).alias("item"),
        )
        rows = leaves.groupBy("grp", "leaf").agg(F.sort_array(F.collect_list("item"), asc=False).alias("rows"))
        start = F.struct(F.lit(None).cast(ITEM).alias("open"), F.array().cast(f"array<{ITEM}>").alias("done"))
        met = stored(rows.select("grp", F.aggregate("rows", start, _meet(level, seed)).alias("r")).select("grp", "r.open", "r.done"), "mix-level")
        closed = met.select("grp", F.explode("done").alias("i")).select("grp", "i.key", (F.col("i.p") > 0.5).alias("taken"))
        done = closed if done is None else done.unionByName(closed)
        items = met.filter("open is not null").select("grp", "open.key", "open.size", "open.p")
        if last <= 2 * fan_in:
            # One fraction per group is left: a draw of its own.
            u = F.pmod(F.xxhash64("key", F.lit("last"), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
            done = done.unionByName(items.select("grp", "key", (u < F.col("p")).alias("taken")))
            break
        level += 1
    if done is None:
        done = items.select("grp", "key", F.lit(False).alias("taken"))
    return done


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """Copies of every document: ``doc_id, size, source, source_size, target, copies, _file, _row``.

    Size is the number of words, 0 for a null text; a null source is a source.  Documents
    without words are never taken.  Of rows with one id and size, each is rounded on its own, in
    the order of their place.  Draws depend on ids and sizes alone, so reruns agree.  An empty
    table gives an empty result; other columns aren't read.
    """
    mine, _ = set_aside(docs, doc_id=id_col, text=text_col, source=source_col)
    sized = located(mine).select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words(F.col("text")).alias("size"), "_file", "_row")
    sized = stored(sized, "mix-sizes")
    sizes = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    copy = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("_file", "_row"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = sizes.withColumn("rate", rate).withColumnRenamed("source", "_s")
    rows = sized.withColumn("copy", copy).join(per, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("p", F.col("rate") - F.floor("rate")).withColumn(
        "key", F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "copy")
    )
    part = rows.filter((F.col("p") > EPSILON) & (F.col("p") < 1 - EPSILON) & (F.col("size") > 0))
    rounded = pivotal(part.select(F.col("source").alias("grp"), "key", "size", "p"), seed)
    taken = rounded.filter("taken").select(F.col("grp").alias("_s"), F.col("key").alias("_k"), F.lit(1).alias("one"))
    joined = rows.join(taken, (F.col("key") == F.col("_k")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    more = F.when(F.col("p") >= 1 - EPSILON, 1).otherwise(F.coalesce("one", F.lit(0)))
    copies = F.when(F.col("size") > 0, F.floor("rate") + more).otherwise(0).cast("long")
    return joined.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), "_file", "_row")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: rows of ``docs`` with their columns, whatever their names, each as often as it is taken."""
    mine, back = set_aside(docs, doc_id=id_col, text=text_col, source=source_col)
    copies = mix(mine, seed=seed).filter("copies > 0").select("_file", "_row", F.col("copies").cast("int").alias("copies"))
    return back(located(mine).join(copies, ["_file", "_row"]).withColumn("again", F.explode(F.sequence(F.lit(1), "copies"))))
