"""Near-duplicates by SimHash fingerprints and pigeonhole blocks.

Fingerprints of 64 bits are cut into blocks.  If two differ in at most ``k`` bits, at least
``blocks - k`` blocks agree, so they share the key made of some ``blocks - k`` of them; all such
keys are tried, which loses no pair.  More blocks give longer keys: their number follows the
number of distinct fingerprints, so that a key stays rare at any size.

Equal fingerprints are one class from the start.  Within a key that many classes share, pairs
aren't emitted: a task compares them in blocks and returns a spanning forest of its links, which
keeps every component.  A key with more than ``TILE`` classes is cut into tiles, and pairs of
tiles are tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import components, located, partitions, set_aside, stored

BITS = 64
SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
TILE = 4096


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text: a bit is 1 if over half of all shingle hashes have it."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : min(n, at + (1 << 16))].tolist(), last[at : at + (1 << 16)].tolist())
        hashes = np.fromiter((xxh64_intdigest(flat[a:b], SEED) for a, b in spans), np.uint64)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) and the columns ``keep`` of every document.

    Words are separated by ASCII white space, A-Z are lower-cased, a text of fewer words than a
    shingle is one shingle, and a null text or one without words has fingerprint 0.
    """
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([np.uint64(fingerprint_of(t, shingle)).astype(np.int64) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), fp(F.col(text_col)).alias("fp"), *keep)


def cuts(n_blocks: int) -> list[tuple[int, int]]:
    """First bit and width of every block."""
    edges = [BITS * i // n_blocks for i in range(n_blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def choose_blocks(n: int, distance: int) -> int:
    """Fewest blocks whose keys have at least as many values as there are fingerprints."""
    blocks = distance + 1
    while BITS * (blocks - distance) / blocks < log2(max(2, n)) and blocks < 2 * distance + 2:
        blocks += 1
    return blocks


def block_keys(fp: Column, n_blocks: int, distance: int) -> Column:
    """Array of (combination, key) of a fingerprint: the bits of every choice of agreeing blocks."""
    mask_of = lambda chosen: sum(((1 << w) - 1) << a for a, w in chosen)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    masks = [mask_of(c) for c in combinations(cuts(n_blocks), n_blocks - distance)]
    return F.array(*[F.struct(F.lit(i).alias("combo"), fp.bitwiseAND(F.lit(signed(m)).cast("long")).alias("key")) for i, m in enumerate(masks)])


def _forest(values: np.ndarray, other: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links that connect all values within ``distance`` of each other (of ``other``, if given): a spanning forest."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = []
    for i, v in enumerate(values):
        near = values[i + 1 :] if other is None else other
        for w in near[np.bitwise_count(near ^ v) <= distance].tolist():
            a, b = find(int(v)), find(w)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(v), w))
    return out


def links(classes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints ``fp`` that connect all pairs within ``distance`` bits."""
    n_blocks = choose_blocks(classes.count(), distance)
    keyed = classes.select("fp", F.explode(block_keys(F.col("fp"), n_blocks, distance)).alias("k")).select("k.combo", "k.key", "fp")
    sizes = keyed.groupBy("combo", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = stored(sizes.filter(F.col("n") > TILE), "simhash-large")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by combination and key; a key's rows may span batches, and are at most TILE."""
        rest = None
        for batch in batches:
            rows = np.rec.fromarrays([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], names="combo,key,fp")
            rows = rows if rest is None else np.concatenate([rest, rows])
            change = np.flatnonzero((rows["combo"][1:] != rows["combo"][:-1]) | (rows["key"][1:] != rows["key"][:-1])) + 1
            until = int(change[-1]) if len(change) else 0
            rest = rows[until:]
            yield pairs(rows[:until])
        if rest is not None:
            yield pairs(rest)

    def pairs(rows: np.ndarray) -> pa.RecordBatch:
        found = []
        if len(rows):
            fp = rows["fp"].astype(np.int64).view(np.uint64)
            start = np.flatnonzero(np.concatenate([[True], (rows["combo"][1:] != rows["combo"][:-1]) | (rows["key"][1:] != rows["key"][:-1])]))
            size = np.diff(np.append(start, len(rows)))
            two = start[size == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
            found = list(zip(fp[two].tolist(), fp[two + 1].tolist()))
            for a, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                found += _forest(fp[a : a + n], None, distance)
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    few = keyed.join(large.select("combo", "key"), ["combo", "key"], "left_anti")
    edges = few.repartition(partitions(classes.sparkSession), "combo", "key").sortWithinPartitions("combo", "key").mapInArrow(compare, "a long, b long")

    # Keys above a tile: every row goes to its tile's pairs with all tiles.
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    dealt = (
        keyed.join(large, ["combo", "key"])
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select("combo", "key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "fp")
    )

    def tile(key, frame):
        fp = frame["fp"].to_numpy().view(np.uint64)
        mine = frame["own"].to_numpy() == key[2]
        found = _forest(fp, None, distance) if key[2] == key[3] else _forest(fp[mine], fp[~mine], distance)
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})

    if not large.isEmpty():
        edges = edges.union(dealt.groupBy("combo", "key", "i", "j").applyInPandas(tile, "a long, b long"))
    return edges


def near_groups(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Add ``component_id`` to rows ``doc_id, fp, …``: the smallest id reachable over links, the row's own included.

    Null ids take part; a component of null ids only has a null ``component_id``.
    """
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    tree = components(links(classes.select("fp"), distance), "simhash-components")
    rooted = classes.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-rooted")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(lows, "root").select("fp", "component_id"), "fp")


def near_places(whole: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """``_file, _row`` of the rows of a located frame that stay: of every component, the one with the smallest id (null last), then place.

    Documents without words have fingerprint 0 and are near-duplicates of each other.
    """
    prints = stored(fingerprints(whole, id_col, text_col, shingle, ("_file", "_row")), "simhash-prints")
    groups = near_groups(prints, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "_file", "_row")).alias("keep")
    return groups.groupBy("component_id").agg(first).select("keep._file", "keep._row")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay by ``near_places``, with their columns, whatever their names."""
    mine, back = set_aside(docs, doc_id=id_col, text=text_col)
    whole = located(mine)
    kept = near_places(whole, shingle=shingle, distance=distance)
    return back(whole.join(kept, ["_file", "_row"], "left_semi"))
