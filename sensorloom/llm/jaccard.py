"""Near-duplicates by exact Jaccard similarity of word shingles, found by a prefix-filtered join.

Shingles are put in one global order, hot ones last.  If two sets have a similarity of at least
``P / Q``, the first ``size - ceil(size P / Q) + 1`` shingles of both share one, so only documents
that share a shingle of these prefixes are compared.  The order's hot shingles come from a sample;
any order gives the same result, the sample only keeps common passages out of the prefixes.

A pair goes on if sizes, the places of the shared shingle and parity bitmaps allow the similarity
(the bits in which two bitmaps differ are at most the shingles that one set lacks), and is then
verified on the whole sets, whose common shingles are counted by Spark's own array functions.  Within a shingle that many documents share, every document is first
paired with its nearest earlier one only, twice; then all pairs follow that still lie in different
components.  No pair that could add to a component is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import components, discard, partitions, stored

SHINGLE = 5
P, Q = 4, 5  # the least similarity, 0.8, as a fraction
SEED = 42
WORDS = 4  # longs of a bitmap
SKETCH = 128  # longs of the one that pairs are tested by before their sets are moved
FEW = 16
TILE = 1024
SAMPLE, HOT_IN, HOT_MAX = 5000, 3, 200_000
# Texts whose sets a Python worker holds at a time.
HELD = 256
STRIP = 128


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; words are those of the fingerprints.

    A text of fewer words than a shingle is one shingle, a text without words has none.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(words))):
        out = (out ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def bitmap(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Parity of the number of shingles per bit."""
    bits = np.bincount((hashes % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def prefix(hashes: np.ndarray, hot: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles to join by, in the global order: by count in the sample, then by hash."""
    at = np.minimum(np.searchsorted(hot, hashes), max(0, len(hot) - 1))
    rank = np.where(hot[at] == hashes, counts[at], 0) if len(hot) else np.zeros(len(hashes), np.int64)
    return hashes[np.lexsort((hashes, rank))][: len(hashes) - -(-len(hashes) * P // Q) + 1]


def _sets(rows: DataFrame) -> DataFrame:
    """``id, hashes`` (the shingles, sorted) and ``sketch`` (a longer bitmap) of rows of an id and a text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HELD):
                part, longs = batch.slice(at, HELD), pa.list_(pa.int64())
                sets = [shingles(t.as_py()) for t in part.column(1)]
                made = [pa.array([s.view(np.int64) for s in sets], longs), pa.array([bitmap(s, SKETCH) for s in sets], longs)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["id", "hashes", "sketch"])

    return rows.mapInArrow(hashed, "id long, hashes array<long>, sketch array<long>")


def _hot(whole: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample share, sorted, and in how many."""
    every = max(1, whole.count() // SAMPLE)
    some = whole.filter(F.pmod(F.xxhash64("_file", "_row"), F.lit(every)) == 0)
    found = _sets(some.select(F.lit(0).cast("long").alias("id"), F.col(text_col))).select(F.explode("hashes").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rows = found.filter(F.col("n") >= HOT_IN).orderBy(F.desc("n"), "token").limit(HOT_MAX).toPandas()
    token = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], rows["n"].to_numpy(np.int64)[order]


def _features(whole: DataFrame, id_col: str, text_col: str) -> DataFrame:
    hot, counts = _hot(whole, text_col)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HELD):
                part = batch.slice(at, HELD)
                sets = [shingles(t.as_py()) for t in part.column(3)]
                longs = pa.list_(pa.int64())
                made = [
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([bitmap(s) for s in sets], longs),
                    pa.array([prefix(s, hot, counts).view(np.int64) for s in sets], longs),
                ]
                yield pa.RecordBatch.from_arrays(part.columns[:3] + made, ["_file", "_row", "doc_id", "size", "bits", "prefix"])

    rows = whole.select("_file", "_row", F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
    return rows.mapInArrow(features, "_file long, _row long, doc_id long, size int, bits array<long>, prefix array<long>")


def _may_be(a: np.ndarray, b: np.ndarray, bits_a: np.ndarray, bits_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether pairs of rows ``(size, place)`` that share a shingle may be similar, and how many bits differ."""
    total = a[..., 0] + b[..., 0]
    ok = Q * np.minimum(a[..., 0], b[..., 0]) >= P * np.maximum(a[..., 0], b[..., 0])
    ok &= (P + Q) * np.minimum(a[..., 0] - a[..., 1], b[..., 0] - b[..., 1]) >= P * total
    apart = np.bitwise_count((bits_a ^ bits_b).view(np.uint64)).sum(axis=-1, dtype=np.int64)
    return ok & ((P + Q) * apart <= (Q - P) * total), apart


def _few_pairs(shared: DataFrame, few: int) -> DataFrame:
    """All pairs that may be similar of shingles which at most ``few`` documents share."""

    def pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
        token, ids, at, bits = rows
        found = [np.empty((0, 2), np.int64)]
        for d in range(1, few):
            i = np.flatnonzero(token[d:] == token[:-d])
            if not len(i):
                break
            i = i[_may_be(at[i], at[i + d], bits[i], bits[i + d])[0]]
            found.append(np.sort(np.stack([ids[i], ids[i + d]], axis=1), axis=1))
        ends = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shingle; a shingle's rows may span batches."""
        rest = None
        for batch in batches:
            c = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            rows = [c[0], c[1], np.stack(c[2:4], axis=1).astype(np.int64), np.stack(c[4:], axis=1)]
            rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows)]
            change = np.flatnonzero(rows[0][1:] != rows[0][:-1]) + 1
            until = int(change[-1]) if len(change) else 0
            rest = [x[until:] for x in rows]
            yield pairs([x[:until] for x in rows])
        if rest is not None:
            yield pairs(rest)

    rows = shared.filter(F.col("n") <= few).select("token", "id", "size", "place", *[F.col("bits")[i] for i in range(WORDS)])
    return rows.repartition(partitions(shared.sparkSession), "token").sortWithinPartitions("token").mapInArrow(compare, "a long, b long").distinct()


def _many_pairs(many: DataFrame, tile: int, turn: int, nearest: bool) -> DataFrame:
    """Pairs of different roots that may be similar, of shingles shared by many: every row's nearest earlier one, or all."""

    def met(rows: list[np.ndarray]) -> pa.RecordBatch:
        """Pairs of the groups (shingle, tile, tile) in sorted rows."""
        keys, own, ids, root, at, bits = rows
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        found = [np.empty((0, 2), np.int64)]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if b - a > 1 and (root[a:b] != root[a]).any():
                order = a + np.argsort((ids[a:b] ^ keys[a, 0]) * np.int64(0x5851F42D4C957F2D) * np.int64(2 * turn + 1))
                one = two = order
                if keys[a, 1] != keys[a, 2]:
                    one, two = order[own[order] == keys[a, 1]], order[own[order] == keys[a, 2]]
                for low in range(0, len(one), STRIP):
                    some = one[low : low + STRIP]
                    ok, apart = _may_be(at[some, None], at[None, two], bits[some, None], bits[None, two])
                    ok &= root[some, None] != root[None, two]
                    if one is two:  # earlier rows only
                        ok &= np.arange(len(two)) < np.arange(low, low + len(some))[:, None]
                    if nearest:
                        best = np.where(ok, apart, np.iinfo(np.int64).max).argmin(1)
                        k = np.flatnonzero(ok[np.arange(len(some)), best])
                        found.append(np.stack([ids[some[k]], ids[two[best[k]]]], axis=1))
                    else:
                        k, m = np.nonzero(ok)
                        found.append(np.stack([ids[some[k]], ids[two[m]]], axis=1))
        ends = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group's rows may span batches, and are about two tiles at most."""
        rest = None
        for batch in batches:
            c = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in batch.columns]
            rows = [np.stack(c[:3], axis=1), c[3], c[4], c[5], np.stack(c[6:8], axis=1), np.stack(c[8:], axis=1)]
            rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows)]
            change = np.flatnonzero((rows[0][1:] != rows[0][:-1]).any(1)) + 1
            until = int(change[-1]) if len(change) else 0
            rest = [x[until:] for x in rows]
            if until:
                yield met([x[:until] for x in rows])
        if rest is not None:
            yield met(rest)

    # Shingles whose documents are one component already have no pairs left.
    apart = many.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    dealt = (
        many.join(apart, "token")
        .withColumn("own", F.pmod(F.xxhash64("id"), tiles).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select("token", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "id", "root", "size", "place", *[F.col("bits")[i].alias(f"w{i}") for i in range(WORDS)])
    )
    # Dealt by number, so that few large groups don't end up in few tasks.
    placed = dealt.repartition(partitions(many.sparkSession), "token", "i", "j").sortWithinPartitions("token", "i", "j")
    return placed.mapInArrow(compare, "a long, b long").distinct()


def near_groups(whole: DataFrame, places: DataFrame, id_col: str = "doc_id", text_col: str = "text", few: int = FEW, tile: int = TILE) -> DataFrame:
    """``_file, _row, doc_id, component`` of the rows of ``whole`` at ``places``.

    ``component`` is one number for all rows linked by similarities of at least ``P / Q``, and is
    unlike for others; rows without words are alone.
    """
    rows = _features(whole, id_col, text_col).join(places, ["_file", "_row"])
    rows = stored(rows.withColumn("id", F.monotonically_increasing_id()), "jaccard-rows")
    spread = rows.select("id", F.posexplode("prefix").alias("place", "token"))
    counts = stored(spread.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "jaccard-counts")
    shared = stored(spread.join(counts, "token").join(rows.select("id", "size", "bits"), "id"), "jaccard-shared")
    discard(counts)
    many = shared.filter(F.col("n") > few)

    parts = partitions(whole.sparkSession)

    def beside(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
        """Pairs with a column of both documents, dealt by number, so that long ones don't end up in few tasks."""
        one, two = (sets.select(F.col("id").alias(c), F.col(column).alias(f"of_{c}")).repartition(parts, c).hint("merge") for c in "ab")
        return pairs.select("a", "b").repartition(parts, "a").join(one, "a").repartition(parts, "b").join(two, "b")

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = rows.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id").select("id", "size", "_file", "_row")
        sets = _sets(whole.select("_file", "_row", text_col).join(wanted, ["_file", "_row"]).select("id", text_col))
        sets = stored(sets, "jaccard-sets")
        # Sketches first: few pairs that aren't similar pass, and only those that pass carry whole sets.
        sizes = sets.select("id", F.struct(F.size("hashes").alias("n"), "sketch").alias("s"))
        apart = F.aggregate(F.zip_with("of_a.sketch", "of_b.sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
        near = beside(pairs, sizes, "s").filter((P + Q) * apart <= (Q - P) * (F.col("of_a.n") + F.col("of_b.n")))
        near = stored(near.select("a", "b"), "jaccard-near")
        common = F.size(F.array_intersect("of_a", "of_b"))
        out = stored(beside(near, sets, "hashes").filter(Q * common >= P * (F.size("of_a") + F.size("of_b") - common)).select("a", "b"), "jaccard-links")
        discard(sets, near)
        return out

    tree, tried, found = None, None, None
    for turn, nearest in enumerate((True, True, False)):
        at = many.join(tree.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")) if tree is not None else many.withColumn("root", F.col("id"))
        pairs = _many_pairs(at, tile, turn, nearest)
        pairs = pairs.union(_few_pairs(shared, few)).distinct() if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "jaccard-pairs")
        if pairs.isEmpty() and tried is not None:
            continue
        new = verified(pairs)
        tried, found = (pairs, new) if tried is None else (tried.union(pairs), found.union(new))
        tree = components(found, "jaccard-components")
    return rows.join(tree.withColumnRenamed("node", "id"), "id", "left").select("_file", "_row", "doc_id", F.coalesce("root", "id").alias("component"))


def near_places(whole: DataFrame, places: DataFrame, id_col: str = "doc_id", text_col: str = "text", few: int = FEW, tile: int = TILE) -> DataFrame:
    """The ``places`` that stay: of every component, the one with the smallest id (null last), then place."""
    groups = near_groups(whole, places, id_col, text_col, few, tile)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "_file", "_row")).alias("keep")
    return groups.groupBy("component").agg(first).select("keep._file", "keep._row")
