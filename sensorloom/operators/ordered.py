"""Ordered analytics over keys of any size.

A window over ``partitionBy(key).orderBy(t)`` puts a whole key in one task.  The functions
here cut the order axis into balanced blocks, run the window inside ``(key, block)``, reduce
every block to one row, scan those few rows, and add the carried value back by an equi-join
on ``(key, block)``.  The detail rows are shuffled once, on ``(key, block)``; windows and
the join share that partitioning.  Inputs below one block's size use one plain window.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.operators.ranks import by_refinement, order_bits
from sensorloom.operators.skew import join_hot
from sensorloom.session import cut_lineage, rows_per_block

MAX_BLOCKS = 32768
SAMPLES_PER_BLOCK = 10


@dataclass(frozen=True)
class Scan:
    """One running value: ``kind`` is sum, count, max, min, last (non-null) or lag."""

    kind: str
    column: Column | str
    exclusive: bool = False
    reverse: bool = False

    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column


def split_points(df: DataFrame, order: list[str]) -> list:
    """Boundaries that cut ``df`` into blocks of about equal size along ``order``.

    Call it on a plain scan where possible: counting and sampling then read the ``order``
    columns only, and nothing upstream is computed twice.  About ``SAMPLES_PER_BLOCK`` sampled
    rows of the ``order`` columns per block reach the driver, for at most ``MAX_BLOCKS`` blocks,
    whatever the size of ``df``.  An empty list means that one block is enough.
    """
    per_block = rows_per_block(df.sparkSession)
    n = df.count()
    blocks = min(MAX_BLOCKS, ceil(n / per_block))
    if blocks <= 1:
        return []
    fraction = min(1.0, SAMPLES_PER_BLOCK * blocks / n)
    sample = df.select(*order).sample(fraction=fraction, seed=7)
    rows = sorted(tuple(r) for r in sample.collect())
    step = max(1, len(rows) // blocks)
    return sorted(set(rows[step::step]))[: MAX_BLOCKS - 1]


def _literal(value, data_type: T.DataType) -> str:
    if isinstance(data_type, T.StringType):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(data_type, T.TimestampType):
        # Rows reach Python as local wall-clock time; this is its inverse in any session time zone.
        return f"timestamp_micros({(int(value.replace(microsecond=0).timestamp())) * 1_000_000 + value.microsecond})"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return f"CAST('{value!r}' AS {data_type.simpleString()})"
    return f"CAST('{value}' AS {data_type.simpleString()})"


def block_of(df: DataFrame, order: list[str], splits: list) -> Column:
    """Number of ``splits`` at or below a row, by binary search in a literal array."""
    if not splits:
        return F.lit(0)
    types = [df.schema[c].dataType for c in order]
    points = F.expr(
        "array("
        + ",".join(
            "named_struct(" + ",".join(f"'{c}',{_literal(v, t)}" for c, v, t in zip(order, point, types)) + ")"
            for point in splits
        )
        + ")"
    )
    here = F.struct(*[F.col(c) for c in order])
    steps = [1 << b for b in range(len(splits).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when(F.get(points, at + step - 1) <= here, at + step).otherwise(at),
    )


def _local(scan: Scan, value: Column, window) -> Column:
    if scan.kind == "lag":
        return F.lag(value).over(window)
    frame = window.rowsBetween(Window.unboundedPreceding, -1 if scan.exclusive else 0)
    if scan.kind == "last":
        return F.last(value, ignorenulls=True).over(frame)
    return getattr(F, scan.kind)(value).over(frame)


def _reduced(scan: Scan, value: Column, order: list[str]) -> Column:
    at = F.struct(*order)
    if scan.kind in ("last", "lag"):
        pick = F.min_by if scan.reverse else F.max_by
        return pick(value, F.when(value.isNotNull(), at))
    return getattr(F, scan.kind)(value)


def _carried(scan: Scan, value: Column, window) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, -1)
    if scan.kind in ("last", "lag"):
        return F.last(value, ignorenulls=True).over(frame)
    if scan.kind in ("sum", "count"):
        return F.sum(value).over(frame)
    return getattr(F, scan.kind)(value).over(frame)


def _combined(scan: Scan, local: Column, carry: Column) -> Column:
    if scan.kind in ("last", "lag"):
        return F.coalesce(local, carry)
    if scan.kind == "max":
        return F.greatest(local, carry)
    if scan.kind == "min":
        return F.least(local, carry)
    both = F.coalesce(local + carry, local, carry)
    return F.coalesce(both, F.lit(0).cast("bigint")) if scan.kind == "count" else both


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    outputs: dict[str, Scan],
    block: Column | None = None,
    splits: list | None = None,
) -> DataFrame:
    """Add running values per key along ``order`` (which must be unique per key, non-null).

    ``block`` may give a ready block number that does not decrease along ``order``, and
    ``splits`` ready boundaries, such as those of the raw table that ``df`` derives from.
    """
    plain = block is None and splits is None
    if plain:
        splits = split_points(df, order)
    names = {f"_v{i}": (out, scan) for i, (out, scan) in enumerate(outputs.items())}
    base = df
    for tmp, (_, scan) in names.items():
        value = scan.value()
        base = base.withColumn(tmp, F.struct(value.alias("v")) if scan.kind == "lag" else value)

    def windows(by):
        return {
            False: Window.partitionBy(*by).orderBy(*order),
            True: Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order]),
        }

    def unwrap(scan, c):
        return c.getField("v") if scan.kind == "lag" else c

    if block is None and not splits:
        w = windows(keys)
        out = base.withColumns(
            {o: unwrap(s, _local(s, F.col(tmp), w[s.reverse])) for tmp, (o, s) in names.items()}
        )
        return out.drop(*names)

    # Keys are compared as one struct, in which null equals null, so that windows and join share a partitioning.
    by_key = ["_key"] if keys else []
    base = base.withColumn("_blk", block_of(df, order, splits) if block is None else block)
    base = base.withColumn("_key", F.struct(*keys)) if keys else base
    summary = base.groupBy(*by_key, "_blk").agg(
        *[_reduced(s, F.col(tmp), order).alias(tmp) for tmp, (_, s) in names.items()]
    )
    over_blocks = {
        False: Window.partitionBy(*by_key).orderBy("_blk"),
        True: Window.partitionBy(*by_key).orderBy(F.col("_blk").desc()),
    }
    carry = summary.select(
        *by_key,
        "_blk",
        *[_carried(s, F.col(tmp), over_blocks[s.reverse]).alias(f"_c{tmp}") for tmp, (_, s) in names.items()],
    )
    if plain:
        # Of a plain scan nothing is shared with the detail rows, so the few carries are stored
        # first; a derived input is better read by one query that reuses its exchanges.
        carry = cut_lineage(carry)
    w = windows([*by_key, "_blk"])
    local = base.withColumns({f"_l{tmp}": _local(s, F.col(tmp), w[s.reverse]) for tmp, (_, s) in names.items()})
    joined = local.join(carry, [*by_key, "_blk"], "left")
    out = joined.withColumns(
        {
            o: unwrap(s, _combined(s, F.col(f"_l{tmp}"), F.col(f"_c{tmp}")))
            for tmp, (o, s) in names.items()
        }
    )
    extra = [c for tmp in names for c in (tmp, f"_l{tmp}", f"_c{tmp}")]
    return out.drop("_blk", "_key", *extra)


def index_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str = "idx",
    block: Column | None = None,
    splits: list | None = None,
) -> DataFrame:
    """Contiguous 0-based position of every row along ``order`` within its key."""
    numbered = running(df, keys, order, {name: Scan("count", F.lit(1))}, block, splits)
    return numbered.withColumn(name, F.col(name) - 1)


def dense_index(bounds: DataFrame, keys: list[str], lo: str, hi: str, name: str = "idx", chunk: int = 4096) -> DataFrame:
    """One row per integer in ``[lo, hi]`` and key, generated in parallel chunks.

    Chunks are listed by group, so that no row holds the numbers of all chunks of a key.
    """
    start, stop = F.col(lo).cast("bigint"), F.col(hi).cast("bigint")
    groups = bounds.filter(start <= stop).withColumn(
        "_group", F.explode(F.sequence(F.floor(start / chunk**2), F.floor(stop / chunk**2)))
    )
    low = F.greatest(F.floor(start / chunk), F.col("_group") * chunk)
    high = F.least(F.floor(stop / chunk), F.col("_group") * chunk + (chunk - 1))
    chunks = groups.withColumn("_chunk", F.explode(F.sequence(low, high))).drop("_group").repartition(*keys, "_chunk")
    first = F.greatest(start, F.col("_chunk") * chunk)
    final = F.least(stop, F.col("_chunk") * chunk + (chunk - 1))
    return chunks.withColumn(name, F.explode(F.sequence(first, final))).drop("_chunk")


def order_statistics(df: DataFrame, keys: list[str], value: str, picks: dict) -> DataFrame:
    """Exact values at given 0-based ranks per key; ``picks`` maps a name to ``n -> rank``.

    Numbers and times of more than one block's rows are ranked by histograms of their bits
    (``ranks.by_refinement``).  Otherwise equal values are counted first, so a hot key shrinks
    before the shuffle, and ranks come from a block scan, so no key is sorted in one task.
    """
    df = df.filter(F.col(value).isNotNull())
    bits = order_bits(F.col(value), df.schema[value].dataType)
    if bits is None:
        splits = split_points(df, [value])
    elif df.count() <= rows_per_block(df.sparkSession):
        splits = []
    else:
        return by_refinement(df, keys, value, bits, picks)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.groupBy(*keys).agg(F.sum("_c").alias("n"))
    ranked = running(counts, keys, [value], {"_upto": Scan("sum", "_c")}, splits=splits)
    ranked = join_hot(ranked, total, keys, [value], null_safe=True)
    return ranked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[
            F.max(
                F.when((F.col("_upto") - F.col("_c") <= rank(F.col("n"))) & (rank(F.col("n")) < F.col("_upto")), F.col(value))
            ).alias(name)
            for name, rank in picks.items()
        ],
    )
