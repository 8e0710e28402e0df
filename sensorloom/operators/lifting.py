"""Ancestor tables of frame trees: jumps of 1, 2, 4, … edges per frame, without paths.

A table holds at most one row per frame and power of two, so a tree of ``n`` frames takes
``n log(depth)`` rows however deep it is, where whole paths would take ``n * depth`` entries.
Values of edges are folded along the jumps: bounds, counts or products of matrices.

Where frames have an order in which most lie close to their parents, paths are first followed inside blocks
of that order; only the frames above the blocks are doubled, and the rest takes their result in one join.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.geometry import chain, matmul, rigid_inverse
from sensorloom.session import cut_lineage

# Joins that may pile up in one plan before it is stored.
JOINS_PER_PLAN = 8
# Rows of a block inside which paths are followed in one go.
BLOCK_ROWS = 65_536
# Frames above the blocks that are broadcast; beyond, Catalyst picks the join.
LISTED_ROWS = 200_000

Fold = Callable[[Column, Column], Column]
PRODUCT: dict[str, Fold] = {"matrix": matmul}
BOUNDS: dict[str, Fold] = {"t_min": F.greatest, "t_max": F.least}


def _products(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """As ``matmul`` rounds; a library's fused product drifts by some 1e-8 along a hundred thousand edges."""
    a, b = upper.reshape(-1, 4, 4), lower.reshape(-1, 4, 4)
    out = a[:, :, 0:1] * b[:, 0:1] + a[:, :, 1:2] * b[:, 1:2] + a[:, :, 2:3] * b[:, 2:3]
    out[:, :, 3] += a[:, :, 3]
    return out.reshape(-1, 16)


# The same folds on arrays of values that are not null.
IN_BLOCKS: dict[Fold, Callable] = {operator.add: np.add, F.greatest: np.maximum, F.least: np.fmin, matmul: _products}


def folded(fold: Fold, upper: Column, lower: Column) -> Column:
    """Value of two stretches of a path, of which null is the neutral one."""
    return F.when(upper.isNull(), lower).when(lower.isNull(), upper).otherwise(fold(upper, lower))


@dataclass
class Ancestors:
    """``levels[k]``: ``node, anc`` and values of the ``2**k`` edges above a node; ``tops``: the same up to the root.

    ``tops`` has ``node, top, branch, steps, cyclic`` and the values of all edges between, with the frame
    right below the top on the way as ``branch``; frames on or below a cycle have nulls.  Roots have
    no row.  Levels that are not ``complete`` are built when they are asked for.
    """

    tops: DataFrame
    folds: dict[str, Fold] = field(default_factory=dict)
    built: list[DataFrame] = field(default_factory=list)
    complete: bool = True

    @property
    def levels(self) -> list[DataFrame]:
        while not self.complete:
            self._build()
        return self.built

    def level(self, k: int) -> DataFrame | None:
        """One level, or none where no frame has as many above it."""
        while len(self.built) <= k and not self.complete:
            self._build()
        return self.built[k] if k < len(self.built) else None

    def _build(self) -> None:
        below = self.built[-1]
        upper = below.filter(F.col("node") != F.col("anc")).select(
            F.col("node").alias("anc"), F.col("anc").alias("_anc"), *[F.col(c).alias(f"_{c}") for c in self.folds]
        )
        jumps = below.filter(F.col("node") != F.col("anc")).join(upper, "anc").select(
            "node", F.col("_anc").alias("anc"), *[folded(f, F.col(f"_{c}"), F.col(c)).alias(c) for c, f in self.folds.items()]
        )
        seen = Observation()
        jumps = cut_lineage(jumps.observe(seen, F.count(F.lit(1)).alias("n")))
        # A cycle never ends, but only frames above which no more than their depth lies are asked for.
        if seen.get["n"] and 1 << len(self.built) <= self._deepest():
            self.built.append(jumps)
        else:
            self.complete = True

    def _deepest(self) -> int:
        return self.tops.agg(F.coalesce(F.max("steps"), F.lit(0))).first()[0]


def ancestors(edges: DataFrame, folds: dict[str, Fold] | None = None, order: list[str] | None = None, block_rows: int = BLOCK_ROWS) -> Ancestors:
    """Ancestor table of ``child, parent`` and one column per fold; a child has one row.

    Jumps double per round, so the logarithm of the depth bounds the rounds.  A frame that is
    its own parent ends its branch.  Depths have no gaps: a round that settles no frame
    leaves only those on or below a longer cycle.  Rows without child or parent are no edges.

    ``order`` names columns of ``edges`` along which most frames lie near their parents, such as arrival.
    It changes the work, not the result: rounds then handle only parents in other blocks than their children.
    """
    folds = folds or {}
    known = edges.filter(F.col("child").isNotNull() & F.col("parent").isNotNull())
    if order is None or not _in_arrays(known, folds):
        rows = known.select(
            F.col("child").alias("node"), F.col("parent").alias("top"), F.col("child").alias("branch"), F.lit(1).cast("bigint").alias("steps"),
            (F.col("child") == F.col("parent")).alias("loop"), *folds,
        )
        state, levels = _doubled(rows, folds)
        return Ancestors(_tops(state, folds), folds, levels)
    rows = cut_lineage(_followed(known, folds, order, block_rows))
    above = rows.filter((F.col("node") == F.col("branch")) & ~F.col("loop")).select(F.col("top").alias("node")).distinct()
    above = cut_lineage(above)
    listed = F.broadcast if above.count() <= LISTED_ROWS else lambda df: df
    state, _ = _doubled(rows.join(listed(above), "node", "left_semi"), folds)
    upper = state.select(F.col("node").alias("top"), *[F.col(c).alias(f"_{c}") for c in ("top", "branch", "steps", "done", *folds)])
    further = ~F.col("loop") & F.col("_done").isNotNull()
    settled = rows.join(listed(upper), "top", "left").select(
        "node",
        *[F.when(further, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("top", "branch")],
        F.when(further, F.col("steps") + F.col("_steps")).otherwise(F.col("steps")).alias("steps"),
        F.when(further, F.col("_done")).otherwise(F.lit(True)).alias("done"),
        *[F.when(further, folded(f, F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) for c, f in folds.items()],
    )
    first = known.select(F.col("child").alias("node"), F.col("parent").alias("anc"), *folds)
    return Ancestors(_tops(settled, folds), folds, [first], complete=False)


def _tops(state: DataFrame, folds: dict[str, Fold]) -> DataFrame:
    done = F.col("done")
    return state.select(
        "node", *[F.when(done, F.col(c)).alias(c) for c in ("top", "branch", "steps")], (~done).alias("cyclic"),
        *[F.when(done, F.col(c)).alias(c) for c in folds],
    )


def _doubled(rows: DataFrame, folds: dict[str, Fold]) -> tuple[DataFrame, list[DataFrame]]:
    """Jumps ``node, top, branch, steps, loop`` doubled up to the roots, and those of 1, 2, 4, … edges on the way."""
    inner = rows.select(F.col("node").alias("top"), F.lit(True).alias("_inner"))
    state = rows.join(inner, "top", "left").select(
        "node", "top", "branch", "steps", (F.col("_inner").isNull() | F.col("loop")).alias("done"), *folds
    )
    levels, before = [], None
    while True:
        jump = 1 << len(levels)
        state, n_open, n_jumps = _stored(state, jump)
        if n_jumps:
            levels.append(state.filter(F.col("steps") == jump).select("node", F.col("top").alias("anc"), *folds))
        if not n_open or n_open == before:
            break
        before = n_open
        upper = state.select(
            F.col("node").alias("top"), *[F.col(c).alias(f"_{c}") for c in ("top", "branch", "steps", "done", *folds)]
        )
        moved = state.filter(~F.col("done")).join(upper, "top").select(
            "node", F.col("_top").alias("top"), F.col("_branch").alias("branch"), (F.col("steps") + F.col("_steps")).alias("steps"),
            F.col("_done").alias("done"), *[folded(f, F.col(f"_{c}"), F.col(c)).alias(c) for c, f in folds.items()],
        )
        state = state.filter("done").unionByName(moved)
    return state, levels


def _stored(state: DataFrame, jump: int) -> tuple[DataFrame, int, int]:
    """Store a round, and count its unfinished rows and its whole jumps in the same job."""
    seen = Observation()
    counts = [F.count_if(~F.col("done")).alias("n_open"), F.count_if(F.col("steps") == jump).alias("n_jumps")]
    stored = cut_lineage(state.observe(seen, *counts))
    return stored, seen.get["n_open"], seen.get["n_jumps"]


def _in_arrays(edges: DataFrame, folds: dict[str, Fold]) -> bool:
    """Whether arrays can fold all values."""
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return all(
        f in IN_BLOCKS and edges.schema[c].dataType.simpleString() in ({"array<double>"} if f is matmul else numbers) for c, f in folds.items()
    )


def _followed(edges: DataFrame, folds: dict[str, Fold], order: list[str], block_rows: int) -> DataFrame:
    """Jumps ``node, top, branch, steps, loop`` from every frame to the first one above it outside of its block.

    A row whose value is null, or has one in it, is not passed here, nor are the cycles inside a block:
    their frames jump to themselves, and never get done.
    """
    kind = edges.schema["child"].dataType
    fields = [("node", kind), ("top", kind), ("branch", kind), ("steps", T.LongType()), ("loop", T.BooleanType()), *[(c, edges.schema[c].dataType) for c in folds]]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                held.append(batch.slice(at, block_rows))
                n += held[-1].num_rows
                if n >= block_rows:
                    yield _follow_block(held, folds)
                    held, n = [], 0
        if n:
            yield _follow_block(held, folds)

    placed = edges.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("child", F.col("parent").cast(kind).alias("parent"), *folds).mapInArrow(follow, schema)


def _follow_block(batches: list[pa.RecordBatch], folds: dict[str, Fold]) -> pa.RecordBatch:
    block = pa.Table.from_batches(batches).combine_chunks()
    n, rows = block.num_rows, np.arange(block.num_rows)
    child, parent, *columns = [pa.concat_arrays(c.chunks) for c in block.columns]
    above = pc.fill_null(pc.index_in(parent, value_set=child), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    loop = above == rows
    values, odd = zip(*map(_numbers, columns)) if columns else ((), ())
    values, odd = list(values), np.logical_or.reduce(odd) if odd else np.zeros(n, bool)
    above[loop | odd] = -1
    above[(above >= 0) & odd[above]] = -1
    end, steps = rows.copy(), np.ones(n, np.int64)
    for _ in range(n.bit_length() + 1):
        at = np.flatnonzero(above >= 0)
        if not len(at):
            break
        to = above[at]
        for v, fold in zip(values, folds.values()):
            v[at] = IN_BLOCKS[fold](v[to], v[at])
        steps[at] += steps[to]
        end[at] = end[to]
        above[at] = above[to]
    cyclic = above >= 0
    end[cyclic], steps[cyclic] = rows[cyclic], 1
    top = pa.concat_arrays([parent, child]).take(pa.array(np.where(cyclic, n + rows, end)))
    out = [child, top, child.take(pa.array(end)), pa.array(steps), pa.array(loop[end] & ~cyclic)]
    for v, column in zip(values, columns):
        keep = odd | cyclic
        v[keep] = 0
        if v.ndim == 2:
            new = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 16), pa.array(v.ravel())).cast(column.type)
        else:
            new = pa.array(v).cast(column.type)
        out.append(pa.concat_arrays([new, column]).take(pa.array(np.where(keep, n + rows, rows))) if keep.any() else new)
    return pa.RecordBatch.from_arrays(out, ["node", "top", "branch", "steps", "loop", *folds])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column, matrices as rows of 16, and which rows are or hold nulls."""
    odd = column.is_null().to_numpy(zero_copy_only=False).copy()
    if not pa.types.is_list(column.type):
        numbers = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
        return numbers.astype(np.int64 if numbers.dtype.kind == "i" else numbers.dtype), odd
    odd |= pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False) != 16
    cells = column.flatten()
    if cells.null_count:
        holders = pc.list_parent_indices(column).filter(cells.is_null())
        odd[holders.to_numpy(zero_copy_only=False)] = True
    numbers = np.zeros((len(column), 16))
    numbers[~odd] = column.filter(pa.array(~odd)).flatten().to_numpy(zero_copy_only=False).reshape(-1, 16)
    return numbers, odd


def depths(table: Ancestors) -> DataFrame:
    """Depth of every frame below its root, 0-based."""
    return table.tops.select("node", F.col("top").alias("root"), (F.col("steps") - 1).cast("int").alias("depth"))


def _ends(pairs: DataFrame, table: Ancestors, columns: list[str]) -> DataFrame:
    """Pairs with root and ``columns`` of either frame; a frame without row, or on a cycle, is its own root."""
    for n in (1, 2):
        side = table.tops.select(F.col("node").alias(f"f{n}"), F.col("top").alias(f"_r{n}"), *[F.col(c).alias(f"_{c}{n}") for c in columns])
        pairs = pairs.join(side, f"f{n}", "left").withColumn(f"_r{n}", F.coalesce(f"_r{n}", f"f{n}"))
    return pairs


def common_ancestor(pairs: DataFrame, table: Ancestors) -> DataFrame:
    """Per distinct pair ``f1, f2`` the lowest common ancestor, its ``lca_depth`` and the folds over all edges between.

    ``lca_depth`` counts the edges above the ancestor.  Frames that part right below their root meet there, and need
    no jump.  Of the others the deeper frame climbs to the other's depth; then both climb in jumps that
    double as long as they stay below their common ancestor, and are halved again.  Levels are built as far as
    pairs need them, and pairs that have met leave the rounds.  Null for frames under different roots; the
    folds of a frame with itself are null.
    """
    ends = _ends(pairs.select("f1", "f2").distinct(), table, ["steps", "branch", *table.folds])
    d1, d2 = F.coalesce("_steps1", F.lit(0).cast("bigint")), F.coalesce("_steps2", F.lit(0).cast("bigint"))
    same, alike, first_deeper = F.coalesce(F.col("_r1") == F.col("_r2"), F.lit(False)), F.col("f1") == F.col("f2"), d1 >= d2
    parted = F.coalesce(F.col("_branch1") != F.col("_branch2"), F.lit(True))
    at_root = same & ~alike & parted
    null = {c: F.lit(None).cast(table.tops.schema[c].dataType) for c in table.folds}
    start, seen = ["f1", "f2", "a", "b", "da", "db", *table.folds], Observation()
    rows = ends.select(
        "f1", "f2", same.alias("same"), (same & ~alike & ~parted).alias("open"),
        F.when(at_root, F.col("_r1")).when(first_deeper, F.col("f1")).otherwise(F.col("f2")).alias("a"),
        F.when(first_deeper, F.col("f2")).otherwise(F.col("f1")).alias("b"),
        F.when(at_root, 0).otherwise(F.greatest(d1, d2)).alias("da"), F.least(d1, d2).alias("db"),
        *[F.when(at_root, folded(f, F.col(f"_{c}1"), F.col(f"_{c}2"))).otherwise(null[c]).alias(c) for c, f in table.folds.items()],
    )
    rows = cut_lineage(rows.observe(seen, F.max(F.when(F.col("open"), F.col("da") - F.col("db"))).alias("widest")))
    met = [rows.filter(~F.col("open")).select("f1", "f2", "same", "a", "da", *table.folds)]
    widest = seen.get["widest"]
    if widest is not None:
        climbed = _climb(rows.filter("open").select(*start), table, widest)
        met.append(climbed.select("f1", "f2", F.lit(True).alias("same"), "a", "da", *table.folds))
    out = met[0] if len(met) == 1 else met[0].unionByName(met[1])
    here = F.col("same")
    return out.select(
        "f1", "f2", F.when(here, F.col("a")).alias("lca"), F.when(here, F.col("da")).cast("int").alias("lca_depth"),
        *[F.when(here, F.col(c)).alias(c) for c in table.folds],
    )


def _jumps(state: DataFrame, table: Ancestors, k: int, sides: str) -> tuple[DataFrame, dict[str, Column]]:
    """Pairs with the ancestors ``2**k`` edges above, and what changes for a pair that takes the jump."""
    changed = {c: F.col(c) for c in table.folds}
    for s in sides:
        row = table.level(k).select(F.col("node").alias(s), F.col("anc").alias(f"_anc_{s}"), *[F.col(c).alias(f"_{c}_{s}") for c in table.folds])
        state = state.join(row, s, "left")
        changed |= {s: F.col(f"_anc_{s}"), f"d{s}": F.col(f"d{s}") - (1 << k)}
        changed |= {c: folded(f, F.col(f"_{c}_{s}"), changed[c]) for c, f in table.folds.items()}
    return state, changed


def _climb(state: DataFrame, table: Ancestors, widest: int) -> DataFrame:
    """Pairs of different frames ``a`` and ``b`` of one tree, ``a`` deeper by at most ``widest``, moved to where they meet."""
    columns = state.columns
    apart = F.col("a") != F.col("b")
    for k in range(widest.bit_length()):
        bit = (F.col("da") - F.col("db")).bitwiseAND(F.lit(1 << k).cast("bigint")) != 0
        jumped, changed = _jumps(state.filter(bit), table, k, "a")
        state = state.filter(~bit).unionByName(jumped.withColumns(changed).select(*columns))
        if k % JOINS_PER_PLAN == JOINS_PER_PLAN - 1:
            state = cut_lineage(state)
    seen = Observation()
    state = cut_lineage(state.observe(seen, F.count_if(apart).alias("n")))
    met, below, rising, k = state.filter(~apart), [], state.filter(apart), 0
    left = seen.get["n"]
    if not left:
        return met
    while left and table.level(k) is not None:
        seen = Observation()
        jumped, changed = _jumps(rising, table, k, "ab")
        jumped = jumped.withColumn("go", F.coalesce(F.col("_anc_a") != F.col("_anc_b"), F.lit(False)))
        jumped = jumped.withColumns({c: F.when(F.col("go"), v).otherwise(F.col(c)) for c, v in changed.items()}).select(*columns, "go")
        jumped = cut_lineage(jumped.observe(seen, F.count_if("go").alias("n")))
        below.append(jumped.filter(~F.col("go")).select(*columns, F.lit(k).alias("within")))
        rising, left, k = jumped.filter("go").select(*columns), seen.get["n"], k + 1
    below.append(rising.select(*columns, F.lit(k).alias("within")))
    state = below[0]
    for part in below[1:]:
        state = state.unionByName(part)
    for j in range(k - 1, -1, -1):
        inside = F.col("within") > j
        jumped, changed = _jumps(state.filter(inside), table, j, "ab")
        go = F.coalesce(F.col("_anc_a") != F.col("_anc_b"), F.lit(False))
        jumped = jumped.withColumns({c: F.when(go, v).otherwise(F.col(c)) for c, v in changed.items()}).select(*columns, "within")
        state = state.filter(~inside).unionByName(jumped)
        if (k - j) % (JOINS_PER_PLAN // 2) == 0:
            state = cut_lineage(state)
    jumped, changed = _jumps(state, table, 0, "ab")
    return met.unionByName(jumped.withColumns(changed).select(*columns))


def relate(pairs: DataFrame, table: Ancestors) -> DataFrame:
    """Pairs with the ``matrix`` from ``f1`` to ``f2``: one inverse and one product of root-to-frame matrices.

    The table is one of edges with matrices only, so a frame above which one is missing tops
    its own tree; null where no path of such edges exists.
    """
    ends = _ends(pairs, table, ["matrix"])
    path = product(inverse_or_null(F.col("_matrix1")), F.col("_matrix2"))
    return ends.withColumn("matrix", F.when(F.col("_r1") == F.col("_r2"), path)).select(*pairs.columns, "matrix")


def inverse_or_null(m: Column) -> Column:
    """Inverse of a rotation-translation matrix that may be null."""
    return F.when(m.isNotNull(), rigid_inverse(m))


def product(*matrices: Column) -> Column:
    """Product of the matrices that are not null, as one fold, so that its parts are not copied into each of its entries."""
    return chain(F.array_compact(F.array(*matrices)))
